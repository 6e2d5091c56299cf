"""Published tables kept by part: every run writes the parts it touched, and a list names the current version of each.

A table lies under ``<root>/<table>/_version=<run>/<part column>=<value>``; ``<table>__parts`` lists what each run published.
Files are never changed: a part that a run does not touch keeps its files, and readers of an earlier state still find it. The
list gets a run's entries last, in one small file, and only if what was written passed its checks, so a broken or failed run
leaves the state before it current. A run that is repeated under its version replaces its own files.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T

from courtside.session import freeing_shuffles

VERSION = "_version"
_ENTRY = "at long, version string, part_column string, part string, adds boolean, body string"


class NotPublished(ValueError):
    """Rows that were written but break a rule of their table, and so did not become current."""


def _list(spark: SparkSession, root: str, table: str) -> list[Row]:
    """Entries of the list in order: as many as runs and parts they touched."""
    # asked of the store: a read that fails is reported by every listener of observations
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}__parts")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    return sorted(spark.read.schema(_ENTRY).parquet(path.toString()).collect(), key=lambda e: e.at)


def versions(spark: SparkSession, root: str, table: str) -> list[str]:
    """Versions of a table that were published, oldest first."""
    return list(dict.fromkeys(e.version for e in _list(spark, root, table)))


def publish_parts(
    df: DataFrame, root: str, table: str, version: str, part: str, parts: Sequence[str] | None = None, required: Sequence[str] = (),
    adds: Sequence[str] = (),
) -> int:
    """Publish the rows of ``df`` by the values of the column ``part``; returns how many rows were written.

    ``parts`` names what the run touched: other rows are left out, and a part without rows becomes empty. Without it the run
    touched the whole table. Rows of a part in ``adds`` join those published before instead of replacing them. No value of
    ``required`` and of ``part`` may be null. Rows, breaches and parts are counted by the job that writes.
    """
    spark = df.sparkSession
    if parts is not None:
        df = df.where(F.col(part).cast("string").isin(list(parts)))
    seen = Observation()
    checked = [*dict.fromkeys([*required, part])]
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(part).cast("string")).alias("parts"),
        *[F.count_if(F.col(c).isNull()).alias(f"no {c}") for c in checked],
    )
    with freeing_shuffles(spark):
        observed.write.mode("overwrite").partitionBy(part).parquet(f"{root}/{table}/{VERSION}={version}")
    found = seen.get
    broken = {c: found[f"no {c}"] for c in checked if found[f"no {c}"]}
    if broken:
        raise NotPublished(f"{table} {version}: rows without a value: {broken}")
    earlier = _list(spark, root, table)
    at = 1 + max((e.at for e in earlier), default=0)
    held = set(found["parts"])
    # an entry without a part stands for the whole table before it: what it held is no longer current
    entries = [] if parts is not None else [(at, version, part, None, False, df.schema.json())]
    for name in sorted(held.union(parts or ())):
        if name in held or name not in adds:
            entries.append((at, version, part, name, name in adds, df.schema.json()))
    if parts is not None and not entries:
        entries = [(at, version, part, None, True, df.schema.json())]
    spark.createDataFrame(entries, _ENTRY).coalesce(1).write.mode("append").parquet(f"{root}/{table}__parts")
    return found["rows"]


def current_parts(entries: Sequence[Row]) -> set[tuple[str, str]]:
    """(version, part) of everything that is current after the entries, in order."""
    now: set[tuple[str, str]] = set()
    kept: set[tuple[str, str]] = set()
    for e in entries:
        if e.part is None:
            now = now if e.adds else set()
        elif e.adds:
            kept.add((e.version, e.part))
        else:
            now = {(v, p) for v, p in now if p != e.part} | {(e.version, e.part)}
    return now | kept


def read_parts(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    """The current rows of a table, or those that were current once ``version`` was published. One scan, pruned by part."""
    entries = _list(spark, root, table)
    if version is not None:
        last = max((e.at for e in entries if e.version == version), default=None)
        if last is None:
            raise ValueError(f"{table} has no version {version}")
        entries = [e for e in entries if e.at <= last]
    if not entries:
        raise ValueError(f"{table} was never published")
    part, current = entries[-1].part_column, current_parts(entries)
    alive = sorted({v for v, _ in current})
    # columns of the newest entry, then those that only earlier parts have
    schema = T.StructType()
    for e in reversed(entries):
        if e.version in alive or e is entries[-1]:
            schema = T.StructType([*schema.fields, *[f for f in T.StructType.fromJson(json.loads(e.body)) if f.name not in schema.names]])
    if not alive:
        return spark.createDataFrame([], schema)
    rows = (
        spark.read.option("basePath", f"{root}/{table}")
        .schema(T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())]))
        .parquet(*[f"{root}/{table}/{VERSION}={v}" for v in alive])
    )
    wanted = F.lit(False)
    for v in alive:
        wanted = wanted | ((F.col(VERSION) == v) & F.col(part).cast("string").isin(sorted(p for w, p in current if w == v)))
    return rows.where(wanted).select(*schema.names)
