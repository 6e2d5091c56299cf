"""What is sent to Python on the executors: values with their code, and rows in batches of bounded size."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession


#: bytes of rows that Spark hands to Python at once; a longer row travels alone
BATCH = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by ``BATCH`` bytes, unless they are smaller already.

    Spark's own bound lets a batch of texts grow to tens of megabytes, which the executor, its Python workers and what
    they make of the batch hold several times over.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now > BATCH:
        spark.conf.set(name, str(BATCH))


def gathered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of small batches in batches of up to ``size`` bytes, for work that repeats something per batch.

    A batch that is larger by itself stays as it is. Rows and their order do not change.
    """
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if held and total + batch.nbytes > size:
            yield _joined(held)
            held, total = [], 0
        held.append(batch)
        total += batch.nbytes
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


class Sent:
    """A broadcast value that travels with the code of its classes, so that no executor needs the package installed.

    For values of a known, bounded size only.
    """

    def __init__(self, spark: SparkSession, value):
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        """The value, unpacked anew: ask once per task."""
        return pickle.loads(self._packed.value)
