"""Landing: normalise, watch for schema drift, stamp, append. Publishing: versioned full rewrites."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from courtside.functions.ordering import latest_first
from courtside.operators.windows import latest_by
from courtside.sources.documents import RESERVED

# Lineage columns per grain, in landing order.
LINEAGE = {
    "player": ("_player_id", "_team_id", "_season", "_season_type", "_create_date", "_run_id"),
    "game": ("_game_id", "_season", "_season_type", "_create_date", "_run_id"),
    "team": ("_team_id", "_season", "_season_type", "_create_date", "_run_id"),
    "roster": ("_team_id", "_season", "_create_date", "_run_id"),
    "schedule": ("_season", "_season_type", "_create_date", "_run_id"),
    "league": ("_season", "_season_type", "_create_date"),
    "player_list": ("_season", "_create_date"),
}

# Fixed value: a player-grain column that would clash with another table's.
PLAYER_RENAME = {"stats_value": "_stats_value"}


def normalise(df: DataFrame, grain: str = "game") -> DataFrame:
    """Lower-case names; give reserved names their stand-ins."""
    renames = {**RESERVED, **(PLAYER_RENAME if grain == "player" else {})}
    return df.toDF(*[renames.get(c.lower(), c.lower()) for c in df.columns])


def drift(target: T.StructType, incoming: T.StructType) -> T.StructType:
    """Columns the target lacks, typed by the landing rule: whole, floating, else text."""
    known = {f.name for f in target.fields}
    return T.StructType(
        [T.StructField(f.name, _landing_type(f.dataType)) for f in incoming.fields if f.name not in known]
    )


def _landing_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    return T.StringType()


def widest(old: T.DataType, new: T.DataType) -> T.DataType:
    """A type that holds the values of both: whole, then floating, then text."""
    if old == new:
        return old
    kinds = {type(_landing_type(old)), type(_landing_type(new))}
    if T.StringType in kinds:
        return T.StringType()
    return T.DoubleType() if T.DoubleType in kinds else T.LongType()


def widened(target: T.StructType, incoming: T.StructType) -> T.StructType:
    """The target's columns, wide enough for the incoming values, and every new column behind them."""
    new = {f.name: f.dataType for f in incoming.fields}
    known = [T.StructField(f.name, widest(f.dataType, new.get(f.name, f.dataType))) for f in target.fields]
    return T.StructType([*known, *drift(target, incoming).fields])


def align(incoming: DataFrame, target: T.StructType) -> DataFrame:
    """Rows in the columns of ``widened``; missing ones are NULL. No value is narrowed."""
    have = set(incoming.columns)
    return incoming.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in widened(target, incoming.schema).fields
    ])


def stamp(df: DataFrame, grain: str, **lineage: Column | str | int | None) -> DataFrame:
    """Add the lineage columns of a grain. Arguments are named without the underscore."""
    wanted = LINEAGE[grain]
    given = {f"_{name}": value for name, value in lineage.items()}
    if set(given) != set(wanted):
        raise ValueError(f"{grain} rows need {wanted}, got {tuple(given)}")
    as_column = {k: v if isinstance(v, Column) else F.lit(v) for k, v in given.items()}
    return df.withColumns({name: as_column[name] for name in wanted})


def land(df: DataFrame, grain: str, path: str, replaces: Sequence[str] = (), **lineage) -> DataFrame:
    """Normalise, align to what the table already has, stamp, append. Returns the rows written.

    Drift is judged before the stamps exist, so lineage columns never count as new. Where a known
    column needs a wider type, rows go to a new version folder of the table; readers cast all
    versions to the widest type. A load of several seasons (season given as a column) or folders is
    rebalanced first: each of them gets files of a sensible size, and a large one is split.
    With ``replaces``, columns of ``df`` that name folders above the season, the rows replace what
    lies in their folders, so that a load that is repeated leaves its rows once.
    """
    rows = normalise(df, grain)
    versions = _versions(df.sparkSession, path)
    number = max(versions, default=0)
    own = T.StructType([f for f in versions[number].fields if f.name not in LINEAGE[grain]]) if versions else None
    if own is not None:
        rows = align(rows, own)
        kinds = {f.name: f.dataType for f in own.fields}
        number += any(kinds.get(f.name, f.dataType) != f.dataType for f in rows.schema.fields)
    rows = stamp(rows, grain, **lineage)
    if number not in versions or drift(versions[number], rows.schema).fields:
        _remember(df.sparkSession, path, number, rows.schema)
    if replaces or isinstance(lineage["season"], Column):
        rows = rows.hint("rebalance", *replaces, "_season")
    writer = rows.write.partitionBy(*replaces, "_season")
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if replaces else writer.mode("append")
    writer.parquet(f"{path}/{VERSION}={number}")
    return rows


# folder level of a landing table whose files agree on the types of all columns
VERSION = "_types"


def _columns(path: str) -> str:
    return f"{path.rstrip('/')}__columns"


def _remember(spark: SparkSession, path: str, number: int, schema: T.StructType) -> None:
    """Note the columns a load brings next to the table: one small row per load with new ones."""
    spark.createDataFrame([(number, schema.json())], "version int, body string").coalesce(1).write.mode("append").parquet(_columns(path))


def _versions(spark: SparkSession, path: str) -> dict[int, T.StructType]:
    """Columns of each type version of a landing table, none before its first load.

    Read from the noted columns, so that no footer of the table itself is opened. Equal notes
    are one row; what is left is one row per distinct set of columns.
    """
    try:
        notes = spark.read.schema("version int, body string").parquet(_columns(path)).distinct().collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    found: dict[int, dict[str, T.StructField]] = {}
    for note in sorted(notes, key=lambda n: (n.version, len(n.body))):
        for f in T.StructType.fromJson(json.loads(note.body)).fields:
            found.setdefault(note.version, {}).setdefault(f.name, f)
    return {number: T.StructType(list(fields.values())) for number, fields in sorted(found.items())}


def landed_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Columns a landing table has so far, at their widest types, or None before its first load."""
    merged: T.StructType | None = None
    for schema in _versions(spark, path).values():
        merged = schema if merged is None else widened(merged, schema)
    return merged


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """A landing table with the columns of all loads, every value as it was landed or wider."""
    target, parts = landed_schema(spark, path), None
    for number, schema in _versions(spark, path).items():
        own = spark.read.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])).parquet(path)
        own = own.where(F.col(VERSION) == str(number)).drop(VERSION)
        have = set(own.columns)
        own = own.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields])
        parts = own if parts is None else parts.unionByName(own)
    return parts


def snapshot(df: DataFrame, keys: Sequence[str], *tie: str) -> DataFrame:
    """Latest landed row per key: what the refreshed landing views show."""
    return latest_by(df, keys, latest_first("_create_date", *tie))


def publish(df: DataFrame, root: str, table: str, version: str) -> tuple[str, int]:
    """Write a full table to a new versioned path; returns the path and its row count.

    Readers of the previous version are not disturbed, and a lost task is simply rerun. The
    count comes from the footers of the written files.
    """
    path = f"{root}/{table}/{version}"
    df.write.mode("overwrite").parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path).count()


def clear(spark: SparkSession, schema: T.StructType, root: str, tables: Sequence[str], version: str) -> None:
    """An empty new version of every named table."""
    for table in tables:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{root}/{table}/{version}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns, types and order; ``created_at`` defaults to the current time."""
    def column(f: T.StructField) -> Column:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name == "created_at":
            value = F.coalesce(value, F.current_timestamp())
        return value.cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def null_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: how many rows break each NOT NULL column."""
    return df.agg(
        *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in schema.fields if not f.nullable]
    )
