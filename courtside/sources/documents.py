"""Landed JSON documents to typed rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from courtside.sources.catalogue import result_index

RESULT_SETS = (
    "resultSets array<struct<name: string, headers: array<string>, rowSet: array<array<string>>>>"
)

# Landed headers that are reserved words, and the names they land under.
RESERVED = {"to": "tov"}

# Fields of one news item, lower case.
NEWS_FIELDS = (
    "playerid", "firstname", "lastname", "date", "priority", "headline", "injured", "injured_status",
    "injury_detail", "injury_location", "injury_side", "injury_type", "listitemcaption",
)


def read_documents(spark: SparkSession, path: str | list[str], whole: bool = False, **options) -> DataFrame:
    """Landed documents as ``body``: one per line, or with ``whole`` one per file."""
    return spark.read.options(**options).text(path, wholetext=whole).withColumnRenamed("value", "body")


def scrape(
    docs: DataFrame, index: int, schema: T.StructType | str, body: str = "body", keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of the ``index``-th result set of every document.

    Columns are found by header, ignoring case; a header the document lacks gives NULL.
    ``keep`` names document columns (ids, season) to carry along; ``schema`` may be DDL text.
    """
    # whole files cannot be split, and parsing is what takes the time
    docs = docs.select(*keep, body).hint("rebalance")
    # the outer explode keeps the optimizer from testing rowSet first, which would parse every body twice
    parsed = docs.select(*keep, F.get(F.from_json(body, RESULT_SETS)["resultSets"], F.lit(index)).alias("rs"))
    return typed_rows(parsed.select(*keep, "rs.rowSet", F.transform("rs.headers", landed_name).alias("names")), schema, keep)


def typed_rows(named: DataFrame, schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a result set from ``*keep, names, rowSet`` (headers as they land, and rows of texts)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    places = [(F.array_position("names", f.name) - 1).cast("int").alias(f"at{i}") for i, f in enumerate(schema.fields)]
    rows = (
        named.select(*keep, "rowSet", *places)
        .select("*", F.explode_outer("rowSet").alias("row"))
        .where(F.col("row").isNotNull())
    )
    return rows.select(
        *keep, *[F.get("row", F.col(f"at{i}")).cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )


def scrape_measure(
    docs: DataFrame, grain: str, name: str, measure: str, schema: T.StructType | str, **options
) -> DataFrame:
    """``scrape`` with the result set looked up by document type and measure name."""
    return scrape(docs, result_index(grain, name, measure), schema, **options)


def infer_schema(docs: DataFrame, index: int, body: str = "body") -> T.StructType:
    """Column types of a result set by the landing rule.

    All values whole numbers: bigint. All present values numbers: double. Anything else,
    and a column without any value: string. One row per header reaches the driver.
    """
    # a document that cannot be read gives no cells, as it gives no rows
    doc = F.try_parse_json(body)
    sets = docs.select(
        F.variant_get(doc, f"$.resultSets[{index}].headers", "array<string>").alias("headers"),
        F.explode(F.variant_get(doc, f"$.resultSets[{index}].rowSet", "array<array<variant>>")).alias("row"),
    )
    cells = sets.select(F.posexplode("headers").alias("pos", "header"), "row").select(
        "pos", landed_name(F.col("header")).alias("name"), F.schema_of_variant(F.get("row", "pos")).alias("kind")
    )
    kind = F.coalesce(F.col("kind"), F.lit("VOID"))
    whole = kind == "BIGINT"
    number = whole | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    found = (
        cells.groupBy("name")
        .agg(
            F.min("pos").alias("pos"),
            F.bool_and(whole).alias("whole"),
            F.bool_and(number | (kind == "VOID")).alias("number"),
            F.bool_or(kind != "VOID").alias("any"),
        )
        .orderBy("pos")
        .collect()
    )
    return T.StructType([T.StructField(r["name"], _landed_type(r)) for r in found])


def _landed_type(row) -> T.DataType:
    if row["whole"]:
        return T.LongType()
    return T.DoubleType() if row["number"] and row["any"] else T.StringType()


def landed_name(header: Column) -> Column:
    name = F.lower(header)
    for word, stand_in in RESERVED.items():
        name = F.when(name == word, F.lit(stand_in)).otherwise(name)
    return name


def news_items(docs: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """One row per item of the news documents, all fields as text; ``more`` holds those the feed has besides."""
    items = docs.select(
        *keep, F.explode_outer(F.from_json(body, "ListItems array<map<string,string>>")["ListItems"]).alias("item")
    ).where(F.col("item").isNotNull())
    items = items.select(*keep, F.transform_keys("item", lambda k, _: F.lower(k)).alias("item"))
    more = F.map_filter("item", lambda k, _: ~k.isin(*NEWS_FIELDS))
    return items.select(*keep, *[F.col("item")[f].alias(f) for f in NEWS_FIELDS], more.alias("more"))


def with_more_fields(items: DataFrame) -> DataFrame:
    """The fields in ``more`` as columns of their own, in order of name. One name per field reaches the driver."""
    names = items.select(F.explode(F.map_keys("more")).alias("name")).distinct().orderBy("name").collect()
    return items.select("*", *[F.col("more")[r["name"]].alias(r["name"]) for r in names]).drop("more")


def read_news(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    return news_items(read_documents(spark, path, whole))


def read_player_lists(
    spark: SparkSession, root: str, schema: T.StructType | str, seasons: Iterable[str] | None = None, whole: bool = False
) -> DataFrame:
    """Player lists landed under ``root/_season=<season>/``: of the named seasons, or of all there are."""
    docs = read_documents(spark, root if seasons is None else [f"{root}/_season={s}" for s in seasons], whole, basePath=root)
    return scrape_measure(docs, "player", "PlayerList", "info", schema, keep=["_season"])
