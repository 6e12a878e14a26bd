"""Line dedup by content-defined chunks.

A rolling hash over ``WINDOW`` = 2 line hashes is taken at every line. The corpus decides
where chunks end: two lines stay in one chunk where the hash of the pair repeats anywhere,
and a boundary lies where it does not. Boundaries depend on the lines beside them alone,
so a repeated passage of two lines or more is cut out alike whatever stands around it and
however far it was shifted, and its first and last line belong to it. (Boundaries at every
n-th value of the hash would leave most passages of few lines uncut.)

Repeated chunks are removed, all but the first occurrence, after their bytes were
compared: the lines of repeated pairs are grouped by hash and bytes, and a hash that
stands for different lines, or a pair's hash that stands for different pairs, removes
nothing. A repeated line alone stays, unless it is a paragraph of over ``FOLD_WORDS``
words: such a line is folded, and each fold counts as a line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import SPACE_WORD, blocks, materialize, mixed, slim, word_spans

FOLD_WORDS = 50  # a longer line counts as several
HOT_PAIRS = 1000  # most frequent pairs of lines, joined by broadcast
FILTER_BITS = 1 << 25
NO_ID = (1 << 63) - 1
_LANE = np.uint64(0x9E3779B97F4A7C15)


def line_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each line with a word: its row, where it begins, the span of its words, its hash.

    Blank lines go with the line before them, those at the top of a text with its first.
    """
    starts, ends, _ = word_spans(data, offsets, SPACE_WORD)
    row = np.searchsorted(offsets, starts, side="right") - 1
    line = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
    begin = np.maximum(line[np.searchsorted(line, starts, side="right") - 1], offsets[row])
    opens = np.ones(len(starts), bool)
    opens[1:] = begin[1:] != begin[:-1]
    first = np.flatnonzero(opens)
    place = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
    cut = np.flatnonzero(place % FOLD_WORDS == 0)
    last = np.append(cut[1:], len(starts)) - 1
    begin = np.where(place[cut] == 0, begin[cut], starts[cut])
    row, a, b = row[cut], starts[cut], ends[last] if len(cut) else ends
    top = np.ones(len(row), bool)
    top[1:] = row[1:] != row[:-1]
    begin = np.where(top, offsets[row], begin)
    view = memoryview(data)
    hashes = [xxhash.xxh3_64_intdigest(view[x:y]) for x, y in zip(a.tolist(), b.tolist())]
    return row, begin, a, b, np.array(hashes, np.uint64)


def pairs(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lines that another of the same text follows, and the rolling hash at each."""
    at = np.flatnonzero(row[1:] == row[:-1])
    return at, mixed(hashes[at] * _LANE + hashes[at + 1]).astype(np.int64)


def _pair_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            row, _, _, _, hashes = line_table(data, offsets)
            at, rolling = pairs(row, hashes)
            if len(at):
                own = [batch.column(c).take(pa.array(row[at])) for c in ("key", "digest")]
                lines = hashes.astype(np.int64)
                values = [pa.array(v) for v in (rolling, lines[at], lines[at + 1])]
                yield pa.RecordBatch.from_arrays([*own, *values], ["key", "digest", "pair", "one", "two"])

    return rows.mapInArrow(run, "key long, digest long, pair long, one long, two long")


def _line_bytes(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in blocks(batches):
            _, _, a, b, hashes = line_table(data, offsets)
            pick = np.flatnonzero(may_hold(bits, hashes.astype(np.int64)))
            if len(pick):
                lines = [data[x:y].tobytes() for x, y in zip(a[pick], b[pick])]
                values = [pa.array(hashes[pick].astype(np.int64)), pa.array(lines, pa.binary())]
                yield pa.RecordBatch.from_arrays(values, ["hash", "line"])

    return rows.select("text").mapInArrow(run, "hash long, line binary")


def hash_bits(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A filter of fixed size over the column ``hash``; false hits cost time, not results."""
    words = hashes.select(
        F.shiftright(F.pmod("hash", F.lit(bits)), 6).alias("word"),
        F.expr(f"shiftleft(1L, cast(pmod(hash, {bits}) % 64 as int))").alias("bit"),
    )
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy()] = found["bit"].to_numpy()
    return out


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes % np.int64(64 * len(bits))
    return (bits[slot >> 6] >> (slot & 63)) & 1 == 1


RESULT = "doc_id long, text string, n_lines long, n_chunks long, removed_chunks long, removed_lines long"
_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _counted(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """Texts without a repeated pair: each line is a chunk of its own."""
    lines = np.bincount(line_table(data, offsets)[0], minlength=batch.num_rows)
    arrays = [batch.column("doc_id"), batch.column("text").cast(pa.string())]
    counts = [lines, lines, 0 * lines, 0 * lines]
    return pa.RecordBatch.from_arrays([*arrays, *(pa.array(c, pa.int64()) for c in counts)], _NAMES)


def _rebuilt(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, lists: list) -> pa.RecordBatch:
    row, begin, _, _, hashes = line_table(data, offsets)
    at, rolling = pairs(row, hashes)
    border = np.searchsorted(row, np.arange(batch.num_rows + 1))
    window = np.searchsorted(row[at], np.arange(batch.num_rows + 1))
    end = np.append(begin[1:], 0)
    end[border[1:][np.diff(border) > 0] - 1] = offsets[1:][np.diff(border) > 0]
    texts, counts = batch.column("text").to_pylist(), []
    for i, (drop, once) in enumerate(lists):
        low, high = int(border[i]), int(border[i + 1])
        if not drop and not once:
            counts.append((high - low, high - low, 0, 0))
            continue
        drop, once, met = set(drop), set(once), set()
        gone, joined = np.zeros(high - low, bool), 0
        for k, pair in zip(at[window[i] : window[i + 1]].tolist(), rolling[window[i] : window[i + 1]].tolist()):
            joined += pair in drop or pair in once
            if pair in drop or pair in met:
                gone[k - low : k - low + 2] = True
            elif pair in once:
                met.add(pair)
        if gone.any():
            kept = np.flatnonzero(~gone) + low
            texts[i] = b"".join([data[begin[k] : end[k]].tobytes() for k in kept]).decode()
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        counts.append((high - low, high - low - joined, runs, int(gone.sum())))
    arrays = [batch.column("doc_id"), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays([*arrays, *(pa.array(c, pa.int64()) for c in zip(*counts))], _NAMES)


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in blocks(batches):
        lists = zip(batch.column("drop").to_pylist(), batch.column("once").to_pylist())
        yield _rebuilt(batch, data, offsets, [(d or (), o or ()) for d, o in lists])


def drop_repeated_chunks(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, text`` without repeated chunks, and the numbers of
    its lines, chunks, removed chunks and removed lines.

    The first occurrence of each pair of lines, by smallest id (null last) and then by
    place, stays, so every line stays somewhere. Lines are compared from their first word
    to their last; blank ones are not counted. Rows that share an id, or have none, count
    as one document: none loses its first occurrence to another. Null texts stay null;
    empty and blank ones stay as they are; an empty table gives an empty result.

    Only texts that hold a repeated pair, as a filter of fixed size tells, are shuffled.
    """
    rows = slim(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    # With the digest, rows of one id (or of none) do not meet in one task.
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.lit(NO_ID)), "digest": F.xxhash64("text")})
    found = materialize(_pair_rows(rows.select("key", "digest", "text")), "line-pairs")
    repeated = found.groupBy("pair").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("first"),
        F.min("one").alias("one"), F.max("one").alias("one_too"), F.min("two").alias("two"), F.max("two").alias("two_too"),
    )
    repeated = repeated.where("n > 1 AND one = one_too AND two = two_too").drop("one_too", "two_too")
    repeated = materialize(repeated, "line-repeated")
    hashes = repeated.select(F.explode(F.array("one", "two")).alias("hash"))
    same = _line_bytes(rows, hash_bits(hashes)).groupBy("hash", "line").agg(F.lit(1).alias("line_row"))
    differing = same.groupBy("hash").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("hash")
    differing = materialize(differing, "line-differing")
    verified = repeated.join(differing.withColumnRenamed("hash", "one"), "one", "left_anti")
    verified = verified.join(differing.withColumnRenamed("hash", "two"), "two", "left_anti")
    verified = materialize(verified.select("pair", "n", "first"), "line-verified")
    # A pair of very many documents would meet in one task: the most frequent are broadcast.
    hot = materialize(verified.orderBy(F.desc("n"), "pair").limit(HOT_PAIRS), "line-hot")
    own = found.select("key", "digest", "pair")
    often = own.join(F.broadcast(hot), "pair")
    rest = own.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
    hits = often.unionByName(rest.join(verified.hint("merge"), "pair"))
    lists = hits.groupBy("key", "digest").agg(
        F.collect_set(F.when(F.col("first") != F.col("key"), F.col("pair"))).alias("drop"),
        F.collect_set(F.when(F.col("first") == F.col("key"), F.col("pair"))).alias("once"),
    )
    lists = materialize(lists, "line-lists")
    bits = hash_bits(lists.select(F.col("digest").alias("hash")))

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(bits, batch.column("digest").to_numpy())))

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pa.array(~may_hold(bits, batch.column("digest").to_numpy())))
            for piece, data, offsets in blocks(iter([rest])):
                yield _counted(piece, data, offsets)

    hit = rows.mapInArrow(touched, rows.schema)
    # The lists grow with the corpus: joined by shuffling at every size, never broadcast.
    hit = hit.join(lists.hint("merge"), ["key", "digest"], "left").select("doc_id", "text", "drop", "once")
    return hit.mapInArrow(_rebuild, RESULT).unionByName(rows.mapInArrow(untouched, RESULT))
