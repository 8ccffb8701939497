"""Arrow text columns as flat numpy buffers, and small frame helpers."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: Bytes of text worked on at a time inside a task. Rows are never cut: a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column end to end, and where each row begins. Null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def pieces(starts: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows, first and past-the-last, of at most ``most`` bytes unless one row is longer."""
    row, rows = 0, len(starts) - 1
    while row < rows:
        end = int(np.searchsorted(starts, starts[row] + most, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def plain(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that extra columns cannot clash; no text counts as the empty one."""
    return docs.select(*[F.coalesce(F.col(n), F.lit("")).alias(n) if n == "text" else F.col(n) for n in names])


def all_columns(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions that give rows back with all their columns: those that documents do not have
    themselves go by neutral names meanwhile, so that none clashes with a name used inside."""

    @wraps(run)
    def renamed(docs: DataFrame, *args, **how) -> DataFrame:
        own = ("doc_id", "text", "lang", "source", "n_chars")
        names = [c if c in own else f"extra {i}" for i, c in enumerate(docs.columns)]
        return run(docs.toDF(*names), *args, **how).select(*names).toDF(*docs.columns)

    return renamed


def partitions(df: DataFrame, rows: int, per_task: int) -> int:
    """Enough tasks for ``rows`` rows at ``per_task`` each, at least what the session sets."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


@contextmanager
def without_collector():
    """For work that makes no reference cycles: Python's collector would walk all that is kept again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()
