"""Numpy views of Arrow text columns: words, lines and their hashes without a Python loop per word.

Operators that need more than Spark's string functions run inside ``mapInArrow``. A batch is cut
into chunks of about ``CHUNK`` bytes of text, so memory follows the chunk (or one longer document)
and not the batch. Words are the runs ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path

CHUNK = 1 << 21

_BYTES = np.arange(256, dtype=np.uint8)
IS_BLANK = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
ASCII_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over a 64-bit word (invertible)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_WINDOW_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the hash base, or of its inverse modulo 2**64."""
    if len(_powers[kind]) < n:
        steps = np.full(n, _BASE if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def text_chunks(batch: pa.RecordBatch, name: str = "text", limit: int = CHUNK
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them); a null text counts as empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size \
        else np.empty(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low]
        low = high


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of marked bytes, cut at row ends: starts, ends, and the first run of every row."""
    n = len(inside)
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    if n:
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < n]] = False
        after[:-1] = inside[1:]
        cuts = offsets[1:]
        after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray):
    return spans(~IS_BLANK[data], offsets)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums from which the hash of any span follows in constant time."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * _power("up", len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal bytes give equal hashes wherever they stand."""
    down = _power("down", len(sums))
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths)


def window_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes (rows are not told apart here)."""
    n = max(len(hashes) - width + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * _WINDOW_BASE + hashes[k:k + n]
    return mix(total)


def row_of(first: np.ndarray) -> np.ndarray:
    """For each run its row number, from the first run of every row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of flags (or counts) inside each row."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


_temporary: list[list[str]] = []


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once to shared storage and read back: lineage ends here.

    The table goes when the application clears its scratch folder, or at the end of a surrounding
    ``temporary`` block unless it is to be kept.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    if _temporary and not keep:
        _temporary[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession):
    """Tables stored inside are deleted at the end, when nothing that is returned reads them."""
    _temporary.append([])
    try:
        yield
    finally:
        for path in _temporary.pop():
            delete_path(spark, path)


def mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks give freed memory back: the same workers serve later stages."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):   # a C library without it
                pass

    return df.mapInArrow(run, schema)


def id_bucket(buckets: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text modulo ``buckets``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % buckets


def need(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so extra columns never meet ours."""
    return docs.select(*[docs[n] for n in names])
