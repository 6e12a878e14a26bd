"""Sequence packing: shortest-pack-first over the length histogram.

Documents become token ids and are cut into pieces of at most one sequence. Only the
histogram of piece lengths (at most 4096 numbers, whatever the corpus) reaches the
driver. Lengths are placed longest first, each into the shortest pack so far or into
new ones; a pattern stands for all sequences that look alike, with their count. Then
pieces are ranked within their length and joined to the pattern slots that cover the
rank, so the placement of billions of pieces is one join with a bounded table.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from salescope.llm.textops import blocks, materialize, running_total, slim

SEQUENCE = 4096
END_OF_DOCUMENT = 2
TOKEN_BLOCK = 2 << 20
KNOWN_PARTS = 160_000  # in each of two generations of a worker's memory, some 30 MB
LONGEST_KNOWN = 64
ENCODED_AT_ONCE = 2048


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# Whole runs of ASCII punctuation between ASCII letters, digits, white space or the text's
# ends: the tokenizer cuts before and after them. Other neighbours may belong to the run.
MARK = rb"[!-&(-/:-@\[-`{-~]"
PUNCTUATION = re.compile(MARK + rb"(?<![^A-Za-z0-9\s]" + MARK + rb")" + MARK + rb"*+(?![^A-Za-z0-9\s])")
# Letters whose lower case is one letter, in normal form by themselves; the vocabulary
# writes bytes over 0x7E as other letters, those from 0x7F to 0xA0 and 0xAD in their order.
LATIN = re.compile(r"(?:(?![×÷İŉ])[A-Za-z\u00c0-\u017e])++\Z")
SHIFTED = {b: 0x121 + k for k, b in enumerate([*range(0x7F, 0xA1), 0xAD])}


class Ids:
    """Token ids of texts as little-endian 32-bit integers.

    The tokenizer splits at white space before all else, and between ASCII letters or
    digits and ASCII punctuation, so the ids of a text are those of its parts in turn.
    Every different part of a block is looked up once among those met lately: a full
    generation becomes the earlier one, and what is met again moves to the new one. A new
    part of Latin letters is one word to the tokenizer and goes to its merges directly;
    other parts go through all of it.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.merges = self.tokenizer.model.tokenize
        self.recent: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}

    def _learned(self, new: list[bytes]) -> dict[bytes, bytes]:
        found, rest = {}, []
        for raw in new:
            text = raw.decode()
            if LATIN.match(text):
                letters = text.lower()
                if not raw.isascii():
                    letters = letters.encode().decode("latin-1").translate(SHIFTED)
                found[raw] = pack_ids([t.id for t in self.merges(letters)])
            else:
                rest.append((raw, text))
        # An encoding is a large object; a few thousand at a time are enough.
        for k in range(0, len(rest), ENCODED_AT_ONCE):
            some = rest[k : k + ENCODED_AT_ONCE]
            coded = self.tokenizer.encode_batch_fast([text for _, text in some], add_special_tokens=False)
            found.update((raw, pack_ids(one.ids)) for (raw, _), one in zip(some, coded))
        return found

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [spaced(t).split() for t in texts]
        parts = list(dict.fromkeys(chain.from_iterable(split)))
        table = dict(zip(parts, map(self.recent.get, parts)))
        new = []
        for part in [part for part, ids in table.items() if ids is None]:
            ids = self.earlier.get(part)
            if ids is None:
                new.append(part)
            else:
                table[part] = self.recent[part] = ids
        found = self._learned(new)
        table.update(found)
        self.recent.update((part, ids) for part, ids in found.items() if len(part) <= LONGEST_KNOWN)
        if len(self.recent) > KNOWN_PARTS:
            self.earlier, self.recent = self.recent, {}
        for words in split:
            yield b"".join(map(table.__getitem__, words))


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def spaced(text: bytes) -> bytes:
    """The text with blanks around ASCII punctuation, unless an apostrophe, a special
    token's mark or a neighbour outside ASCII makes that unsafe."""
    if b"<|" in text or b"'" in text:
        return text
    return PUNCTUATION.sub(rb" \g<0> ", text)


@lru_cache(maxsize=1)
def _ids(path: str) -> Ids:
    """One cache for all tasks of a worker."""
    return Ids(path)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``sequence`` ids of every document, its end mark included."""
    end = END_OF_DOCUMENT.to_bytes(4, "little")
    kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(path)
        for batch, data, offsets in blocks(batches, limit=TOKEN_BLOCK):
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(offsets, offsets[1:])]
            rows = []
            for doc_id, coded in zip(batch.column("doc_id").to_pylist(), ids.of(texts)):
                coded += end
                n = len(coded) // 4
                for start in range(0, n, sequence):
                    piece = coded[4 * start : 4 * (start + sequence)]
                    row = (doc_id, start, len(piece) // 4, zlib.crc32(piece), n)
                    rows.append((*row, piece) if with_ids else row)
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = slim(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


Pattern = tuple[tuple[int, int], ...]  # (length, how many of it), in the order of placement


def shortest_pack_first(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, Pattern]]:
    """(count, pattern) for all packs.

    Every step either uses up a length or fills up a group of equal packs, and splits
    one group at most: there are at most two groups per length, however many pieces.
    """
    heap: list[tuple[int, int, int, Pattern]] = []  # used, tie-break, count, pattern
    serial, full = 0, []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and heap[0][0] + length <= sequence:
                used, _, count, pattern = heapq.heappop(heap)
                # As many of this length as level the group, at once.
                taken = min(count, left)
                if taken < count:
                    heapq.heappush(heap, (used, serial, count - taken, pattern))
                    serial += 1
                head, last = pattern[:-1], pattern[-1]
                pattern = (*head, (length, last[1] + 1)) if last[0] == length else (*pattern, (length, 1))
                count, used = taken, used + length
            else:
                count, used, pattern = left, length, ((length, 1),)
            left -= count
            if used == sequence:
                full.append((count, pattern))
            else:
                heapq.heappush(heap, (used, serial, count, pattern))
                serial += 1
    return full + [(count, pattern) for _, _, count, pattern in sorted(heap)]


SLOTS = StructType([StructField(c, LongType()) for c in ("length", "first", "after", "each", "sequence", "at")])


def slots(patterns: list[tuple[int, Pattern]]) -> list[tuple[int, ...]]:
    """Runs of ranks: pieces of ``length`` ranked ``first`` to ``after`` - 1 go, ``each``
    to a sequence, to the sequences from ``sequence`` on, from offset ``at``."""
    ranks: dict[int, int] = {}
    found, sequence = [], 0
    for count, pattern in patterns:
        at = 0
        for length, each in pattern:
            first = ranks.get(length, 0)
            ranks[length] = first + count * each
            found.append((length, first, first + count * each, each, sequence, at))
            at += length * each
        sequence += count
    return found


def pack(docs: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``.

    A null or empty text is one piece, the end mark alone. Null and repeated ids are
    packed like others; each row is a document. An empty table gives no piece. The
    assignment of equal lengths follows a hash of (id, start), then id, start, checksum.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = materialize(token_pieces(docs, tokenizer, sequence, with_ids), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    rows = sum(histogram.values())
    spread = F.xxhash64("doc_id", "start")
    ranked = running_total(
        pieces, ["length"], F.lit(1), spread, [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], rows, "_rank"
    )
    table = docs.sparkSession.createDataFrame(slots(shortest_pack_first(histogram, sequence)), SLOTS)
    table = table.select(*[F.col(c).alias(f"_{c}") for c in table.columns])
    covers = (ranked["length"] == table["_length"]) & (ranked["_rank"] >= table["_first"]) & (ranked["_rank"] < table["_after"])
    placed = ranked.join(F.broadcast(table), covers)  # bounded by the sequence length, not by the corpus
    nth = F.col("_rank") - F.col("_first")
    return placed.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(nth / F.col("_each")).cast("long")).alias("sequence_id"),
        (F.col("_at") + F.pmod(nth, F.col("_each")) * F.col("length")).alias("offset"),
    )
