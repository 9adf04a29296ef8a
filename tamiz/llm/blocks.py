"""All rows of one table against all of another, block by block, without a cross join.

Both sides are dealt into blocks of bounded size by a hash of their row number. Each block of the one
side is sent to every block of the other, and a task holds one block of each side at a time. What
two blocks make of each other is decided inside the task, so no pair is a row unless it is a result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pairing = Callable[[pa.Table, pa.Table], pa.Table]


def block_count(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def block_of(row: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(row)), F.lit(blocks)).cast("int")


def every_block(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def block_pairs(left: DataFrame, right: DataFrame, sizes: tuple[int, int], counts: tuple[int, int], pairing: Pairing, schema: str) -> DataFrame:
    """``pairing`` of each block of ``left`` with each of ``right``. Both have a unique column ``row``; sizes are the
    rows that a block may hold, counts the rows of the two tables."""
    m, n = (block_count(c, s) for c, s in zip(counts, sizes))
    a = left.select("*", block_of("row", m).alias("_i")).select("*", every_block(n).alias("_j"))
    b = right.select("*", block_of("row", n).alias("_j")).select("*", every_block(m).alias("_i"))
    return a.groupBy("_i", "_j").cogroup(b.groupBy("_i", "_j")).applyInArrow(pairing, schema)


def arrays(column: pa.ChunkedArray, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """A column of lists as its values, one behind the other, and the length of each list."""
    lengths = pc.list_value_length(column).to_numpy().astype(np.int64)
    return pc.list_flatten(column).to_numpy().astype(dtype), lengths
