"""Helpers that the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoquilt.sources.shared import materialize, new_path

__all__ = ["broadcast_if_small", "materialize", "new_path", "slices", "spans", "uniform", "uniform_sql"]

#: Bytes of text that a task turns into Python strings at once, and characters of a part of a long text.
SLICE_BYTES, SPAN = 4 << 20, 1 << 20
SPACE = re.compile(r"\s")


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of rows with about ``most`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right")))
        yield at, end - at
        at = end


def spans(text: str, most: int = SPAN) -> Iterator[str]:
    """A text in parts of about ``most`` characters that end at white space; what has no white space isn't cut."""
    at = 0
    while len(text) - at > most:
        end = text.rfind(" ", at, at + most) + 1
        if not end:
            found = SPACE.search(text, at + most)
            if not found:
                break
            end = found.end()
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def broadcast_if_small(df: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """Broadcast a narrow table whose counted rows are within a bound; else leave the choice to Spark."""
    return F.broadcast(df) if rows <= most else df


def uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) fixed by the parts: the first 52 bits of the MD5 of the parts joined by colons (null: 'null')."""
    joined = F.concat_ws(":", *(F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts))
    return (F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def uniform_sql(*parts: str) -> str:
    """The same number in DuckDB."""
    joined = ", ".join(f"coalesce(CAST({p} AS VARCHAR), 'null')" for p in parts)
    return f"((CAST(CAST('0x' || substr(md5(concat_ws(':', {joined})), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)"
