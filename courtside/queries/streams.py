"""Streaming forms of the news queries, run to the end of the given data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from courtside.queries.league import League
from courtside.queries.registry import ORACLE, query
from courtside.session import fresh_path
from courtside.sources import documents, landing
from courtside.streaming import news


def _polled(lg: League) -> DataFrame:
    """The events as a stream in which every item is delivered twice, as polling does."""
    stream = (
        lg.spark.readStream.schema(lg.table("events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(lg.sf_dir)
    )
    return stream.select(
        "event_id", F.col("user_id").alias("player"), F.col("ts").cast("timestamp").alias("at"), "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("priority"), F.explode(F.lit([1, 2])).alias("_poll"),
    ).drop("_poll")


def _finish(stream) -> None:
    stream.awaitTermination()


_LANDED = "select event_id, user_id as player, ts as at, event_type from events"


@query("streamed_landing", _LANDED)
def streamed_landing(lg: League):
    """Every item lands once, however often it is delivered."""
    root = fresh_path(lg.spark, "news-stream")
    _finish(news.append_unseen(_polled(lg), ["player", "event_id"], f"{root}/rows", f"{root}/checkpoint"))
    return _landed(lg, f"{root}/rows")


@query("streamed_landing_watermark", _LANDED)
def streamed_landing_watermark(lg: League):
    """The same with state bounded by a watermark; the given items come in one batch, so none is late."""
    root = fresh_path(lg.spark, "news-stream")
    unique = news.without_repeats(_polled(lg), ["player", "event_id"], "at")
    _finish(news.append_stream(unique, f"{root}/rows", f"{root}/checkpoint"))
    return _landed(lg, f"{root}/rows")


def _landed(lg: League, path: str) -> DataFrame:
    return lg.spark.read.parquet(path).select(
        "event_id", "player", F.col("at").cast("timestamp_ntz").alias("at"), "event_type"
    )


@query(
    "streamed_latest",
    """select user_id as player, event_id, ts as at, event_type from events
       qualify row_number() over (partition by user_id order by ts desc, cast(props ->> '$.k' as integer), event_id) = 1""",
)
def streamed_latest(lg: League):
    """Newest item per player as running state, published after each batch."""
    root = fresh_path(lg.spark, "latest-news")
    order = F.struct("at", -F.col("priority"), -F.col("event_id"))
    latest = news.latest_per_player(_polled(lg), "player", order, ["event_id", "at", "event_type"])
    _finish(news.publish_stream(latest, f"{root}/view", f"{root}/checkpoint"))
    versions = lg.spark.read.option("basePath", f"{root}/view").parquet(f"{root}/view")
    newest = versions.agg(F.max(F.col("batch").cast("int")).alias("b")).scalar()
    return versions.where(F.col("batch").cast("int") == newest).select(
        "player", "event_id", F.col("at").cast("timestamp_ntz").alias("at"), "event_type"
    )


def _polls(lg: League) -> tuple[DataFrame, DataFrame]:
    """Two polls: one without the items of Mondays, one of all items."""
    events = lg.table("events")
    return events.where(F.dayofweek("ts") != 2), events


@query(
    "streamed_news",
    """select cast(user_id as varchar) as playerid, event_type as headline, cast(event_id as varchar) as listitemcaption,
         strftime(ts, '%Y-%m-%d') as item_day, case when dayofweek(ts) = 1 then 'T' || event_id end as teamcode,
         case when dayofweek(ts) = 1 then date '2001-06-02' else date '2001-06-01' end as landed_on, '2000-01' as _season
       from events""",
)
def streamed_news(lg: League):
    """News landed by a stream: the second poll repeats the first, brings late items, and has a field of its own."""
    root = fresh_path(lg.spark, "news-by-day")
    fields = [
        F.col("user_id").cast("string").alias("PlayerID"), F.col("event_type").alias("Headline"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Date"), F.col("event_id").cast("string").alias("ListItemCaption"),
    ]
    team = F.concat(F.lit("T"), F.col("event_id")).alias("TeamCode")
    for day, (events, more) in enumerate(zip(_polls(lg), ([], [team])), start=1):
        body = F.to_json(F.struct(F.array(F.struct(*fields, *more)).alias("ListItems")))
        events.select(body.alias("value")).write.mode("append").text(f"{root}/polls")
        polled = lg.spark.readStream.schema("value string").text(f"{root}/polls")
        _finish(news.land_unseen(
            documents.news_items(polled, "value"), ["playerid", "date", "listitemcaption"], F.to_timestamp_ntz("date"), f"{root}/rows",
            f"{root}/checkpoint", "2000-01", "Regular Season", lambda: dt.datetime(2001, 6, day),
        ))
    return landing.read_landed(lg.spark, f"{root}/rows").select(
        "playerid", "headline", "listitemcaption", F.col(news.DAY).alias("item_day"), "teamcode",
        F.col("_create_date").cast("date").alias("landed_on"), "_season",
    )


@query("streamed_changes", ORACLE["streamed_latest"])
def streamed_changes(lg: League):
    """Newest item per player, kept by batches that write changed players only; the second poll repeats the first."""
    root = fresh_path(lg.spark, "news-changes")
    order = F.struct("at", -F.col("priority"), -F.col("event_id"))
    for events in _polls(lg):
        events.write.mode("append").parquet(f"{root}/polls")
        polled = lg.spark.readStream.schema(events.schema).parquet(f"{root}/polls").select(
            "event_id", F.col("user_id").alias("player"), F.col("ts").cast("timestamp").alias("at"), "event_type",
            F.get_json_object("props", "$.k").cast("int").alias("priority"),
        )
        latest = news.latest_per_player(polled, "player", order, ["event_id", "at", "event_type"])
        _finish(news.publish_changes(latest, "player", f"{root}/view", f"{root}/checkpoint"))
    return news.read_changes(lg.spark, f"{root}/view", latest.schema, "player").select(
        "player", "event_id", F.col("at").cast("timestamp_ntz").alias("at"), "event_type"
    )
