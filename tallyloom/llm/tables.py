"""Count tables of a fixed size, added up over tasks.

A table of ``SLOTS`` counters is cut into chunks; tasks send the chunks they touched, compressed, and two rounds
of sums by chunk bring them together. What reaches the driver never grows with the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20
CHUNK = 1 << 13
SALTS = 32
SHAPE = "chunk int, counts binary"


def as_chunks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    used = table.reshape(-1, CHUNK).any(axis=1).nonzero()[0]
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array([zlib.compress(table[c * CHUNK : (c + 1) * CHUNK].tobytes(), 1) for c in used], pa.binary())],
        names=["chunk", "counts"],
    )


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CHUNK, np.int64)
    for part in frame["counts"]:
        total += np.frombuffer(zlib.decompress(part), np.int64)
    return pd.DataFrame({"chunk": frame["chunk"].iloc[:1].to_numpy(), "counts": [zlib.compress(total.tobytes(), 1)]})


def added_up(chunks: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """The sum of all tasks' tables, from rows of ``chunk, counts``."""
    salted = chunks.withColumn("salt", F.spark_partition_id() % SALTS)
    some = salted.groupBy("chunk", "salt").applyInPandas(_add, SHAPE)
    table = np.zeros(slots, np.int64)
    for row in some.groupBy("chunk").applyInPandas(_add, SHAPE).collect():
        table[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(zlib.decompress(row.counts), np.int64)
    return table


def occupied(values: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """Which slots any of the 64-bit values of the only column falls into."""

    def run(batches):
        table = np.zeros(slots, np.int64)
        for batch in batches:
            table[batch.column(0).to_numpy().view(np.uint64) % np.uint64(slots)] = 1
        yield from as_chunks(table)

    return added_up(values.mapInArrow(run, SHAPE), slots) > 0
