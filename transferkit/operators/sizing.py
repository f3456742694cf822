"""Byte sizes of text columns, measured in one pass, and files filled by size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferkit.operators.project import to_canonical
from transferkit.types import column


def max_byte_length(df: DataFrame, null: str = "{nll}", encoded: bool = False) -> DataFrame:
    """One row: for each column the longest UTF-8 byte length plus the length of the null token.

    All columns are measured in the same pass, with partial aggregation before the only, one-row,
    exchange.  ``encoded`` says the columns are text already.
    """
    if not df.columns:
        raise ValueError("a table without columns has no column to measure")
    text = df if encoded else to_canonical(df, null=None)
    margin = len(null.encode())
    longest = [
        (F.max(F.octet_length(F.coalesce(column(c), F.lit(null)))) + F.lit(margin)).alias(c)
        for c in text.columns
    ]
    # an empty table still needs fields that can hold the token
    return text.agg(*longest).na.fill(margin)


def file_number(size: Column, target_bytes: int) -> Column:
    """The number, within its task, of the file a row of ``size`` bytes goes to: files are filled one after the other.

    A file ends before the row that would take it past ``target_bytes``; a longer row is a file of its own.  The sums
    run along each task, so nothing is shuffled or read twice; only the sizes go through Python.
    """

    @F.pandas_udf("int")
    def number(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, used = 0, 0
        for sizes in batches:
            total = np.concatenate([[0], np.cumsum(sizes.to_numpy(np.int64))])
            out = np.empty(len(sizes), np.int32)
            i = 0
            while i < len(out):
                j = int(np.searchsorted(total, total[i] + target_bytes - used, "right")) - 1
                if j <= i and used:
                    at, used = at + 1, 0
                    continue
                j = max(j, i + 1)
                out[i:j] = at
                used += int(total[j] - total[i])
                i = j
            yield pd.Series(out)

    return number.asNondeterministic()(size)
