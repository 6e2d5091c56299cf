"""The night's run: land what is due, take snapshots of the landed tables, refresh the reporting tables.

Every step is noted once its rows are written, so a run that broke is called again under its name and goes on after the last
finished step. A load that broke half-way runs again from its start: rows it landed twice are one row in a snapshot.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from courtside.plans.control import COMPLETED, FAILED
from courtside.plans.refresh import refresh_all
from courtside.sources.landing import snapshot

_STEP = "at long, step string, status string"


@dataclass
class Landed:
    """A landed table: its rows, the keys of which the latest row counts, and what settles rows landed at one time.

    Without keys the table goes on as it is.
    """

    rows: Callable[[], DataFrame]
    keys: Sequence[str] = ()
    tie: Sequence[str] = ()


class Steps:
    """Finished steps of a run, in the shared folder: one small row per step."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.path = spark, f"{root}/steps/{name}"
        # an empty note, so that a reader finds a table
        self.spark.createDataFrame([], _STEP).write.mode("ignore").parquet(f"{self.path}/first")

    def finished(self) -> dict[str, str]:
        """Status of every finished step, in order."""
        notes = self.spark.read.schema(_STEP).option("recursiveFileLookup", "true").parquet(self.path).collect()
        return {n.step: n.status for n in sorted(notes, key=lambda n: n.at)}

    def finish(self, step: str, status: str) -> None:
        number = len(self.finished())
        note = self.spark.createDataFrame([(number, step, status)], _STEP).coalesce(1)
        note.write.mode("overwrite").parquet(f"{self.path}/step-{number}")


def run_night(
    spark: SparkSession, root: str, name: str, as_of: dt.datetime, loads: Mapping[str, Callable[[], DataFrame | None]],
    tables: Mapping[str, Landed], before: str | None = None, seasons: Sequence[str] | None = None, refresh_after_failure: bool = False,
) -> dict[str, str]:
    """Run or go on with the night ``name``; returns the status of its finished steps, in order.

    ``loads`` are the landing runs in order (schedule, games, rosters, news ...); each returns its log events or nothing. The
    events are kept under ``<root>/events/<name>/<load>``; a load is FAILED if one of its events is, which also counts for
    a game's group. As long as a load has failed no snapshot is taken and nothing is refreshed, unless
    ``refresh_after_failure``: the run ends there, and what failed stays pending for the next night. ``tables`` are the
    inputs of ``refresh.refresh_all`` by name; ``before`` names the night whose slowly changing tables this one starts from.
    """
    steps = Steps(spark, root, name)
    finished = steps.finished()
    for step, load in loads.items():
        if step in finished:
            continue
        events, status = load(), COMPLETED
        if events is not None:
            place = f"{root}/events/{name}/{step}"
            events.write.mode("overwrite").parquet(place)
            broken = (F.col("node_status") == FAILED) | (F.col("group_status") == FAILED)
            if not spark.read.schema(events.schema).parquet(place).where(broken).isEmpty():
                status = FAILED
        steps.finish(step, status)
    finished = steps.finished()
    if not refresh_after_failure and any(finished[step] == FAILED for step in loads):
        return finished
    taken = {}
    for table, landed in tables.items():
        step, place = f"snapshot {table}", f"{root}/snapshots/{table}/{name}"
        rows = landed.rows()
        if step not in finished:
            latest = snapshot(rows, list(landed.keys), *landed.tie) if landed.keys else rows
            latest.write.mode("overwrite").parquet(place)
            steps.finish(step, COMPLETED)
        taken[table] = spark.read.schema(rows.schema).parquet(place)
    if "refresh" not in finished:
        refresh_all(spark, taken, f"{root}/reporting", name, as_of, before, seasons, resume=True)
        steps.finish("refresh", COMPLETED)
    return steps.finished()
