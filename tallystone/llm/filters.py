"""Bit maps of hashes that are small enough to send to every task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import power_of_two, scan, signed

#: 16 bits an entry, up to this size (8 MB); a fuller map only lets more candidates pass.
MOST_BITS = 1 << 26


def bit_filter(rows: DataFrame, hashed, entries: int, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bits set for ``hashed(columns as unsigned arrays)`` of each row; the driver gets bits / 64 rows at most."""
    bits = min(most_bits, max(64, power_of_two(16 * entries)))
    columns = rows.columns

    def work(got, n):
        h = hashed({c: np.array(got[c], np.int64).view(np.uint64) for c in columns}) & np.uint64(bits - 1)
        return [pa.array(signed(h >> np.uint64(6))), pa.array((h & np.uint64(63)).astype(np.int32))]

    words = scan(rows, work, "w long, b int", columns).groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("v")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[words["w"].to_numpy()] = words["v"].to_numpy()
    return table.view(np.uint64)


def in_filter(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(table) * 64 - 1)
    return (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
