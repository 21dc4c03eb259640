"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import contextlib
import io
import uuid

from pyspark.sql import DataFrame

from salescompass.operators.rows import unused  # noqa: F401  used by the operators
from salescompass.session import run_dir


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write a table once into the shared folder and read it back: later steps neither
    recompute it nor depend on the executors that made it.  ``batch_bytes`` bounds the Arrow
    batches that its tasks hand to Python."""
    conf = df.sparkSession.conf
    path = run_dir(df.sparkSession, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    before = conf.get(_BATCH_BYTES)
    if batch_bytes:
        conf.set(_BATCH_BYTES, str(batch_bytes))
    try:
        df.write.parquet(path)
    finally:
        if batch_bytes:
            conf.set(_BATCH_BYTES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeatable(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it only scans its input, else a stored copy: behind a shuffle the order of
    rows, and with it ``monotonically_increasing_id()``, can differ each time that a task runs."""
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain()
    return stored(df, name) if "Exchange" in plan.getvalue() else df
