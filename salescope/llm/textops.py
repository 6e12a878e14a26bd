"""Shared helpers: byte-level text work inside tasks, ranks without a whole group
in one task, and small pieces of every operator's contract.

Task code sees Arrow batches. Texts stay one UTF-8 buffer with offsets, so words,
hashes and shingles of many documents are numpy operations, not Python loops.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.sources.staging import fewer_files, materialize

__all__ = ["fewer_files", "materialize"]

# Bytes of text handled at once in a task; eight-byte arrays over them stay small.
BLOCK_BYTES = 1 << 19
# Rows of one window task when ranks are dealt out over buckets.
BUCKET_ROWS = 20_000


# ---- documents -------------------------------------------------------------


def slim(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: whatever else a table carries cannot clash."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 (held out) for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def sampled(rows: DataFrame, stratum: str, order: Column, bound: int) -> DataFrame:
    """At most about ``bound`` rows of each stratum, the same ones on every run.

    Sizes are counted first, then rows whose hash falls under the share
    ``bound / size`` stay: no stratum meets in one task.
    """
    sizes = rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("stratum_rows"))
    share = F.lit(float(bound)) / F.col("stratum_rows")
    draw = F.pmod(order, F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.join(F.broadcast(sizes), stratum).where(draw < share).drop("stratum_rows")


def running_total(
    df: DataFrame, keys: list[str], weight: Column, spread: Column, order: list[Column], rows: int, name: str,
    first: Column | None = None,
) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` over the rows before this one in its group.

    A group is cut into buckets by ``spread``; a window runs inside each bucket and
    the buckets' totals, one small row each, are summed before them. With weight 1
    the result is a gapless rank. A small whole number ``first`` comes before the buckets
    in order. ``df`` must be a written table.
    """
    buckets = max(1, min(rows // BUCKET_ROWS + 1, 1 << 20))
    bucket = F.pmod(spread, F.lit(buckets))
    bucket = bucket if first is None else first * buckets + bucket
    df = df.withColumns({"_bucket": bucket, "_weight": weight})
    totals = df.groupBy(*keys, "_bucket").agg(F.sum("_weight").alias("_sum"))
    over = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = over.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    return (
        df.join(totals, [*keys, "_bucket"])
        .withColumn(name, (F.col("_base") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_weight", "_base", "_inside")
    )


# ---- Arrow batches ---------------------------------------------------------


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and the offsets of its rows."""
    if array.null_count:
        array = pc.fill_null(array, "")
    if len(array) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``limit`` bytes of text each (whole rows)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = utf8(batch.column(column))
        part = offsets[1:] // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            piece = batch.slice(a, b - a)
            yield (piece, *utf8(piece.column(column)))
    # A worker outlives its task; what the task's batches took goes back to the system.
    pa.default_memory_pool().release_unused()


def byte_table(characters: str, outside_ascii: bool) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    table[128:] = outside_ascii
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
DIGITS, LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALNUM_WORD = byte_table(DIGITS + LETTERS, True)
LETTER_WORD = byte_table(LETTERS, True)
SPACE_WORD = ~byte_table("\x20\x09\x0a\x0b\x0c\x0d", False)


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts and ends (bytes) of the maximal runs of ``table`` in each row, and the
    position of each row's first word among them (one entry more than rows)."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_RANDOM = np.random.default_rng(20240229)
_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_LANES = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            run = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
            run[0] = 1
            _POWERS[k] = np.cumprod(run, dtype=np.uint64)
    return _POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """64-bit hashes of arbitrary byte spans of one buffer (polynomial, then mixed)."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * power[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of each row and each row's first shingle.

    A row with fewer words, but at least one, has its whole sequence as its only one.
    """
    counts = np.diff(first)
    have = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(have)])
    row = np.repeat(np.arange(len(counts)), have)
    start = first[row] + np.arange(at[-1]) - at[row]
    total = np.zeros(len(start), np.uint64)
    length = np.minimum(counts[row], width)
    for k in range(width):
        there = length > k
        total[there] += words[start[there] + k] * _LANES[k]
    return mixed(total + length.astype(np.uint64)), at
