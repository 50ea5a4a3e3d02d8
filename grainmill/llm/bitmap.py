"""A bitmap of numbers, of bounded size, that goes to every executor to drop rows before they are shuffled.

It lets through every row whose number it was made of, and few others; what passes meets a join anyway.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each number, and the most bits altogether (as a power of two); a fuller bitmap lets more rows through.
BITS_PER_NUMBER, MOST_BITS = 32, 27


def places(x: np.ndarray, bits: int) -> np.ndarray:
    """The bit of each 64-bit number."""
    return ((x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def has(bitmap: bytes, bits: int, x: np.ndarray) -> np.ndarray:
    """Which of the numbers the bitmap may have been made of."""
    at = places(x, bits)
    return (np.frombuffer(bitmap, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _collected(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = np.zeros(1 << (bits - 3), np.uint8)
        for b in batches:
            at = b["slot"].to_numpy(np.int64)
            np.bitwise_or.at(x, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pd.DataFrame({"x": [x.tobytes()]})

    return run


def _slots(bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"slot": np.unique(places(b["x"].to_numpy(np.int64), bits), return_index=True)[0]})

    return run


def bitmap_of(numbers: DataFrame, column: str) -> tuple:
    """(broadcast of the bytes, bits) for a written table with a column of longs: 2^bits bits, MOST_BITS at most.

    The set bits are reduced by a shuffle; only the finished bitmap reaches one task and the driver.
    """
    bits = min(MOST_BITS, max(16, math.ceil(math.log2(1 + BITS_PER_NUMBER * numbers.count()))))
    slots = numbers.select(F.col(column).cast("long").alias("x")).mapInPandas(_slots(bits), "slot long").distinct()
    row = slots.repartition(1).mapInPandas(_collected(bits), "x binary").first()
    return numbers.sparkSession.sparkContext.broadcast(bytes(row["x"]) if row else bytes(1 << (bits - 3))), bits


def kept(df: DataFrame, column: str, bitmap, bits: int) -> DataFrame:
    """The rows whose number (a long, not null) the bitmap may have been made of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(has(bitmap.value, bits, b.column(column).to_numpy(zero_copy_only=False).astype(np.int64))))

    return df.mapInArrow(run, df.schema)


__all__ = ["bitmap_of", "has", "kept", "places"]
