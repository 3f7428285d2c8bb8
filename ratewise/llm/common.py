"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.sources import scratch

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * MIX2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
    return text.lower().split()


def held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of text each (one longer text stays whole)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(sizes):
            continue
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    return scratch.stage(df, f"llm-{label}")
