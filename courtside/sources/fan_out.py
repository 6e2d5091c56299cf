"""All result sets of landed documents from one parse.

A document is parsed once, into one row per result set it holds, and written with the result sets as partitions. Types and
rows of every measure are then read from their own partition; no body is parsed again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from courtside.session import fresh_path
from courtside.sources.documents import landed_name, typed_rows

_SETS = "resultSets array<struct<headers: array<string>, rowSet: array<array<variant>>>>"

# kinds of a value, as the landing rule tells them apart
WHOLE, NUMBER, NOTHING, OTHER = "wnvo"


def _kind(schema: Column) -> Column:
    kind = F.coalesce(schema, F.lit("VOID"))
    number = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    return F.when(kind == "BIGINT", WHOLE).when(number, NUMBER).when(kind == "VOID", NOTHING).otherwise(OTHER)


def parse_sets(docs: DataFrame, indexes: Sequence[int], keep: Sequence[str] = (), body: str = "body") -> DataFrame:
    """``*keep, found, place, names, cells, kinds``: the result sets asked for, one row per document and set, written.

    ``found`` is the number of result sets the document holds, 0 if it cannot be read; ``names`` are the landed headers,
    ``cells`` the rows as text and ``kinds`` the distinct patterns of value kinds of the rows, one letter a column. A document
    without any set asked for keeps one row with a null ``place``. Documents are rebalanced first: whole files cannot be
    split, and parsing is what takes the time.
    """
    spark, keep = docs.sparkSession, list(keep)
    parsed = docs.select(*keep, body).hint("rebalance").select(*keep, F.from_json(body, _SETS)["resultSets"].alias("sets"))
    asked = F.filter(F.array(*[F.struct(F.lit(i).alias("place"), F.get("sets", F.lit(i)).alias("it")) for i in indexes]), lambda s: s["place"] < F.size("sets"))
    listed = parsed.select(*keep, F.coalesce(F.size("sets"), F.lit(0)).alias("found"), F.explode_outer(asked).alias("s"))
    rows = F.coalesce(F.col("s.it.rowSet"), F.array().cast("array<array<variant>>"))
    # the type of a value is worked out once, and then compared
    patterns = F.transform(rows, lambda row: F.array_join(F.transform(F.transform(row, F.schema_of_variant), _kind), ""))
    sets = listed.select(
        *keep, "found", F.transform("s.it.headers", landed_name).alias("names"),
        F.transform(rows, lambda row: F.transform(row, lambda v: v.cast("string"))).alias("cells"), F.array_distinct(patterns).alias("kinds"),
        F.col("s.place").alias("place"),
    )
    path = fresh_path(spark, "result-sets")
    sets.write.partitionBy("place").parquet(path)
    return spark.read.schema(sets.schema).parquet(path)


def infer_schemas(sets: DataFrame) -> dict[int, T.StructType]:
    """Column types of every parsed result set by the landing rule, in one pass over the patterns of kinds.

    All values whole numbers: bigint. All present values numbers: double. Anything else, and a column without any value:
    string. A set without rows has no columns. One row per set and header reaches the driver.
    """
    # few distinct patterns; what is exploded further is as many as there are, not as there are rows
    patterns = sets.where("place is not null").select("place", "names", F.explode("kinds").alias("pattern")).distinct()
    cells = patterns.select("place", F.posexplode("names").alias("pos", "name"), "pattern").select(
        "place", "pos", "name", F.when(F.col("pos") < F.length("pattern"), F.substring("pattern", F.col("pos") + 1, F.lit(1))).otherwise(NOTHING).alias("kind")
    )
    kind = F.col("kind")
    found = cells.groupBy("place", "name").agg(
        F.min("pos").alias("pos"), F.bool_and(kind == WHOLE).alias("whole"), F.bool_and(kind != OTHER).alias("number"), F.bool_or(kind != NOTHING).alias("any")
    )
    schemas: dict[int, T.StructType] = {}
    for r in found.orderBy("place", "pos").collect():
        type_ = T.LongType() if r["whole"] else T.DoubleType() if r["number"] and r["any"] else T.StringType()
        schemas[r["place"]] = schemas.get(r["place"], T.StructType()).add(r["name"], type_)
    return schemas


def set_rows(sets: DataFrame, index: int, schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """The typed rows of one parsed result set, as ``documents.scrape`` gives them; reads that set's partition alone."""
    named = sets.where(F.col("place") == index).select(*keep, F.col("cells").alias("rowSet"), "names")
    return typed_rows(named, schema, keep)


def found_sets(sets: DataFrame, keys: Sequence[str], indexes: Sequence[int]) -> DataFrame:
    """``*keys, landed``: how many of the result sets asked for a key's documents hold."""
    landed = sum(((F.col("found") > i).cast("int") for i in indexes), F.lit(0))
    return sets.groupBy(*keys).agg(F.max(landed).alias("landed"))
