"""Stage boundaries of long operators."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from tallyloom.scratch import discard, written


def stored(frame: DataFrame, label: str, *done: DataFrame) -> DataFrame:
    """The frame as a written table. Tables in ``done`` are not read again and go.

    Spark keeps a stage's shuffle files until the driver has collected the objects that name them, so
    the driver collects here: the operator's next stage then needs the disk only once.
    """
    table = written(frame, label)
    for old in done:
        discard(old)
    gc.collect()
    frame.sparkSession.sparkContext._jvm.System.gc()
    return table
