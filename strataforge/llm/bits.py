"""Filters of 64-bit hashes: bit arrays of a fixed size, whatever they hold, that go to all tasks.

A filter never says no to what it holds. It may say yes to something else, the more often the more it holds, so what it
lets through is always counted or joined again: a full filter costs time and changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import to_tasks
from .shingles import mix

#: Bits of a filter (8 MB).
FILTER_BITS = 1 << 26


def _place(*hashes: np.ndarray) -> np.ndarray:
    """The bit of a filter that stands for a word or for a pair of words."""
    out = np.zeros(len(hashes[0]), np.uint64)
    for h in hashes:
        out = mix(out ^ h)
    return (out % np.uint64(FILTER_BITS)).astype(np.int64)


def _bits(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bit = _place(*(b.column(c).to_numpy().view(np.uint64) for c in columns))
            slot, at = np.unique(bit >> 6, return_inverse=True)
            bits = np.zeros(len(slot), np.int64)
            np.bitwise_or.at(bits, at, np.left_shift(np.int64(1), bit & 63))
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(bits)], names=["slot", "bits"])

    return run


def bit_filter(rows: DataFrame, *columns: str) -> Callable[[], np.ndarray]:
    """A filter of FILTER_BITS bits, whatever the rows: set where one of them may be. For tasks."""
    bits = rows.select(*columns).mapInArrow(_bits(list(columns)), "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[bits.column("slot").to_numpy()] = bits.column("bits").to_numpy()
    return to_tasks(rows.sparkSession, out)


def may_be(bits: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
    place = _place(*hashes)
    return bits[place >> 6] >> (place & 63) & 1 == 1
