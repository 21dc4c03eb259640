"""Hook for a caller's own classifier, run in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescompass.functions import text


def classify(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], columns: list[str], name: str = "label", length: int = 6
) -> DataFrame:
    """Adds ``name``: ``fn`` over batches of ``columns``, trimmed and upper-cased."""

    @F.pandas_udf("string")
    def label(batch: pd.DataFrame) -> pd.Series:
        return fn(batch)

    return df.withColumn(name, text.short_label(label(F.struct(*columns)), length))
