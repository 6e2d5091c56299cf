"""News as a stream: append what is new, keep the newest item per player."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from courtside.session import settle
from courtside.sources.documents import with_more_fields
from courtside.sources.landing import land, landed_schema, read_landed

# folders of a table that a stream lands: day of the item, then the batch that brought it
DAY, BATCH = "_day", "_batch"
# the day of items without a time
NO_DAY = "none"


def without_repeats(items: DataFrame, keys: Sequence[str], at: str, delay: str = "2 days") -> DataFrame:
    """Drop items a later poll delivers again, with state bounded by the watermark delay.

    ``at`` must be a zoned timestamp column. Items older than the watermark are dropped even
    when they are new; where none may be lost, use ``append_unseen``.
    """
    return items.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def append_unseen(
    items: DataFrame, keys: Sequence[str], path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append every item once, however late it comes and however often it is delivered.

    A batch keeps what no earlier batch landed, and owns the folder ``batch=<id>``: a repeated
    batch overwrites its own folder and compares itself with earlier ones only.
    """
    keys = list(keys)
    # an empty batch, so that the first real one finds a table to compare with
    items.sparkSession.createDataFrame([], items.schema).write.mode("ignore").parquet(f"{path}/batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        landed = batch.sparkSession.read.schema(f"{_ddl(items, keys)}, batch string").parquet(path)
        seen = landed.where(F.col("batch").cast("bigint") < batch_id).select(*keys)
        batch.dropDuplicates(keys).join(seen, keys, "left_anti").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now)


def land_unseen(
    items: DataFrame, keys: Sequence[str], at: Column, path: str, checkpoint: str, season: str, season_type: str,
    clock: Callable[[], dt.datetime] = dt.datetime.now, available_now: bool = True,
) -> StreamingQuery:
    """Land every news item once, stamped, with every field the feed has, however late and often it is delivered.

    ``items`` come from ``documents.news_items``. ``at`` is the time of an item; it must follow from ``keys``, so that an
    item always falls on the same day. The table lies by day and batch: a batch is compared with earlier batches on its own
    days only, and owns its folders, so a repeated batch replaces its rows. The days of a batch reach the driver. Null keys
    are equal to each other; items without a time share a day of their own.
    """
    keys = list(keys)
    day = F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit(NO_DAY))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = settle(batch.withColumn(DAY, day).dropDuplicates(keys), "news-batch")
        days = [r[DAY] for r in rows.select(DAY).distinct().collect()]
        if landed_schema(spark, path) is not None:
            rows = rows.join(landed_on(spark, path, days, batch_id).select(*keys).alias("seen"), _same(rows, keys, "seen"), "left_anti")
        if "more" in rows.columns:
            rows = with_more_fields(rows)
        rows = rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
        land(rows, "league", path, [DAY, BATCH], season=season, season_type=season_type, create_date=F.lit(clock()))

    return _start(items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now)


def landed_on(spark: SparkSession, path: str, days: Sequence[str], before: int) -> DataFrame:
    """Items of the given days that batches before ``before`` landed; no other day is read."""
    return read_landed(spark, path).where(F.col(DAY).isin(list(days)) & (F.col(BATCH) < before))


def _same(rows: DataFrame, keys: Sequence[str], other: str) -> Column:
    return reduce(Column.__and__, [rows[k].eqNullSafe(F.col(f"{other}.{k}")) for k in keys])


def _ddl(items: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` {items.schema[n].dataType.simpleString()}" for n in names)


def _start(writer, available_now: bool) -> StreamingQuery:
    """To the end of what is there, or polling every quarter of an hour."""
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="15 minutes")).start()


def latest_per_player(items: DataFrame, player: str, order: Column, columns: Sequence[str]) -> DataFrame:
    """Newest item per player as running state: one struct per player.

    ``order`` is a struct that grows with recency; an item delivered twice changes nothing.
    Items without a time cannot be ordered and are left out by the caller.
    """
    newest = F.max_by(F.struct(*columns), order).alias("item")
    return items.groupBy(player).agg(newest).select(player, "item.*")


def append_stream(items: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append every poll to a landing table. The file sink commits each batch once, also after a retry."""
    writer = (
        items.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, available_now)


def publish_stream(latest: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the whole latest-news table after each batch, to a path named by the batch.

    A repeated batch overwrites its own path, so a restart leaves no half-written version.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = latest.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def publish_changes(
    latest: DataFrame, player: str, path: str, checkpoint: str, available_now: bool = True, whole_every: int = 96
) -> StreamingQuery:
    """Write, batch by batch, the players whose newest item changed; ``read_changes`` gives the table.

    Batches that only deliver known items again write no rows. Every ``whole_every``-th batch writes the whole table, so a
    reader meets that many batches at most. Batches own their folders: one that is repeated replaces its own rows.
    """
    schema = latest.schema
    spark = latest.sparkSession
    # an empty batch, so that the first real one finds a table to compare with
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{_WHOLE}=true/{BATCH}=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch is read twice, its state once
        rows = settle(batch, "news-changes")
        now = read_changes(batch.sparkSession, path, schema, player, batch_id)
        whole = batch_id % whole_every == whole_every - 1
        if whole:
            rows = rows.unionByName(now.join(rows.select(player).alias("new"), _same(now, [player], "new"), "left_anti"))
        else:
            rows = rows.join(now.alias("old"), _same(rows, schema.names, "old"), "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/{_WHOLE}={str(whole).lower()}/{BATCH}={batch_id}")

    return _start(
        latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint), available_now
    )


# folders of whole tables and of changes
_WHOLE = "_whole"


def read_changes(spark: SparkSession, path: str, schema: T.StructType, player: str, before: int | None = None) -> DataFrame:
    """The table that ``publish_changes`` wrote, or its state before a batch: the last whole table and all changes since."""
    kinds = T.StructType([*schema.fields, T.StructField(_WHOLE, T.BooleanType()), T.StructField(BATCH, T.LongType())])
    rows = spark.read.schema(kinds).parquet(path)
    if before is not None:
        rows = rows.where(F.col(BATCH) < before)
    base = rows.where(_WHOLE).agg(F.max(BATCH)).first()[0]
    others = [n for n in schema.names if n != player]
    newest = rows.where(F.col(BATCH) >= F.lit(-1 if base is None else base)).groupBy(player)
    return newest.agg(F.max_by(F.struct(*others), BATCH).alias("_item")).select(player, "_item.*").select(*schema.names)
