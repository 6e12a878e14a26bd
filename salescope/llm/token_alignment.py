"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both token sequences cover the same bytes. A byte offset where tokens of both end is a
shared cut. An interval of tokens looks for one near its middle: the end of a token of
the first sequence is looked up among the ends of the second by bisection, first the
middle one, then its neighbours outwards. A cut divides the interval, both halves go on;
an interval without a cut inside is a group. All intervals of a batch take their steps
together, as array operations.

Some cuts are known beforehand, since neither tokenizer joins across them: before a
blank that follows anything but white space, and between ASCII letters, digits and
punctuation. There texts fall into units; each different unit of a batch is tokenized
and divided once, and a worker remembers those it met lately.

Tokenizing is done once. A document's links go to a written table, eight bytes for each
different pair of ids; from there pairs are counted, and the counts come back to the
documents: those of the most frequent pairs, bounded in number, as a broadcast array,
those of all others through a join by pair.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import materialize, slim

BLOCK = 1 << 21  # characters of text handled at once; longer texts are cut at units
KNOWN_UNITS = 150_000  # in each of two generations of a worker's memory, some 70 MB
LONGEST_KNOWN = 48
ENCODED_AT_ONCE = 8192
FREQUENT_PAIRS = 1 << 18  # broadcast counts: 4 MB
WIDE_GROUP = 1 << 12
ID_BITS = 20

# Where a long text may be divided: a unit starts with the blank.
BEFORE_BLANK = re.compile(r"(?<=\S)(?= )")
# Runs of ASCII letters, digits or punctuation (without the apostrophe, which starts
# shortened words) up to another ASCII kind, and single line ends within ASCII; all else
# up to the next blank.
OUTSIDE = "\x80-\U0010ffff"
PUNCTUATION = r"!-&(-/:-@\[-`{-~"
UNITS = re.compile(
    rf" ?[A-Za-z]++(?=[^A-Za-z{OUTSIDE}]|\Z)| ?[0-9]++(?=[^0-9{OUTSIDE}]|\Z)"
    rf"| ?[{PUNCTUATION}]++(?=[A-Za-z0-9 \t\n]|\Z)|(?<=[!-~])\n(?=[!-~])"
    r"|[\s\S]*?\S(?= |\Z)|[\s\S]+"
)


# ---- divide and conquer -------------------------------------------------------


def shared_cuts(a_end: np.ndarray, b_end: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of the first sequence's ends are ends of the second, looked for among the
    tokens ``low`` to ``high`` - 1 of each interval. Ends ascend over all intervals."""
    cut = np.zeros(len(a_end), bool)
    middle = (low + high) // 2
    left = right = middle  # what lies between them has been looked at, without a cut
    while len(low):
        live = (left > low) | (right < high)
        low, high, middle, left, right = (x[live] for x in (low, high, middle, left, right))
        go_left = (left > low) & ((right >= high) | (middle - left <= right - middle))
        at = np.where(go_left, left - 1, right)
        hit = b_end[np.searchsorted(b_end, a_end[at])] == a_end[at]
        cut[at[hit]] = True
        left, right = np.where(go_left, at, left), np.where(go_left, right, at + 1)
        # A cut ends the interval; what it has not looked at is left in two.
        halves = (np.concatenate([low[hit], right[hit]]), np.concatenate([left[hit], high[hit]]))
        low, high = np.concatenate([low[~hit], halves[0]]), np.concatenate([high[~hit], halves[1]])
        centre = (halves[0] + halves[1]) // 2
        middle, left, right = (np.concatenate([x[~hit], centre]) for x in (middle, left, right))
    return cut


# ---- vocabularies -------------------------------------------------------------


def _byte_of() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable ones stand
    for themselves, the others follow from U+0100 on in their order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(shifted)}


class Tokenizers:
    """Ids of units by both tokenizers, and the bytes of every id."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        byte_of, names = _byte_of(), self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            self.a_bytes[k] = bytes(byte_of[c] for c in name)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
            for k, p in enumerate(pieces)
        ]
        kinds = ("[A-Za-z]", "[0-9]", rf"['{PUNCTUATION}]")
        joins = "|".join(
            [r"[^▁]▁|[0-9][0-9]|\n|[A-Za-z0-9][\x00-\x1f]", rf"[{PUNCTUATION}]\t"]
            + [x + y for x in kinds for y in kinds if x != y]
        )
        whole = (k for k in range(len(pieces)) if not (self.b.is_byte(k) or self.b.is_control(k) or self.b.is_unknown(k)))
        if any(re.search(joins, pieces[k]) for k in whole):
            raise ValueError(f"{piece_path} has pieces that join what units divide")
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        if max(len(self.a_size), len(self.b_size)) >> ID_BITS:
            raise ValueError(f"ids need more than {ID_BITS} bits")
        self.blank = self.b.piece_to_id("▁")

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text that starts with a blank, if both sequences spell it."""
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:]) if len(text) > 1 else [self.blank]
        raw = text.encode()
        if b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b]):
            return np.array(a, np.int64), np.array(b, np.int64)
        return None


class Unit:
    """What one unit adds to its document: numbers of tokens, groups, links and pairs,
    the pairs themselves (with their numbers of links, if not all one) and its groups."""

    __slots__ = ("sizes", "pairs", "weights", "text")

    def __init__(self, sizes: bytes, pairs: bytes, weights: bytes, text: str):
        self.sizes, self.pairs, self.weights, self.text = sizes, pairs, weights, text


SIZES = 5
NOT_SPELT = Unit(np.zeros(SIZES, np.int64).tobytes(), b"", b"", "")


def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two ids as one number, ordered by the first."""
    return (a << ID_BITS) | b


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given lengths: the run and the place in it of every element."""
    run = np.repeat(np.arange(len(counts)), counts)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)


def _guard(unit: str) -> str:
    """What may stand before a unit so that the units' borders are cuts."""
    return "" if unit[0] == " " else " ." if unit[0].isalnum() else " x"


class Aligner:
    """Units of one worker; two generations of remembered ones."""

    def __init__(self, byte_path: str, piece_path: str):
        self.tokens = Tokenizers(byte_path, piece_path)
        self.recent: dict[str, Unit] = {}
        self.earlier: dict[str, Unit] = {}
        ids = range(max(len(self.tokens.a_size), len(self.tokens.b_size)))
        # A token within its group, the last of the first sequence, of the second.
        self.names = np.array([[f"{i}{mark}" for i in ids] for mark in ",|;"], object)

    def known(self, keys: list[str]) -> list[Unit]:
        """A unit per key; ``NOT_SPELT`` where the tokens do not spell the key."""
        recent = self.recent
        found = list(map(recent.get, keys))
        new = []
        for at in [i for i, unit in enumerate(found) if unit is None]:
            found[at] = unit = self.earlier.get(keys[at])
            if unit is None:
                new.append(at)
            else:
                recent[keys[at]] = unit
        for at, unit in zip(new, self._learned([keys[i] for i in new])):
            found[at] = unit
            if len(keys[at]) <= LONGEST_KNOWN:
                recent[keys[at]] = unit
        if len(recent) > KNOWN_UNITS:
            self.earlier, self.recent = recent, {}
        return found

    def _learned(self, keys: list[str]) -> Iterator[Unit]:
        """In the keys' order; many keys are tokenized as one text where that is safe."""
        together, size = [], 0
        for key in keys:
            alone = key[-1].isspace() or len(key) > ENCODED_AT_ONCE
            if together and (alone or size > ENCODED_AT_ONCE):
                yield from self._divided(together)
                together, size = [], 0
            if alone:
                yield from self._divided([key])
            else:
                together.append(key)
                size += len(key)
        if together:
            yield from self._divided(together)

    def _divided(self, keys: list[str]) -> Iterator[Unit]:
        t = self.tokens
        parts = list(chain.from_iterable((_guard(key), key) for key in keys))
        coded = t.of("".join(parts))
        if coded is None:
            if len(keys) == 1:
                yield NOT_SPELT
            else:
                for key in keys:
                    yield from self._divided([key])
            return
        a, b = coded
        a_end, b_end = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])
        border = np.cumsum([len(p.encode()) for p in parts])
        a_to, b_to = (np.searchsorted(x, border, side="right") for x in (a_end, b_end))
        low, high = np.concatenate([[0], a_to[:-1]]), a_to - 1
        some = high >= low
        cut = shared_cuts(a_end, b_end, low[some], high[some])
        cut[high[some]] = True
        yield from self._units(a, b, a_end, b_end, cut, a_to, b_to)

    def _units(self, a, b, a_end, b_end, cut, a_to, b_to) -> Iterator[Unit]:
        """The units at the odd places among the parts that end at ``a_to`` and ``b_to``."""
        ends = np.flatnonzero(cut)  # the last token of each group
        a_size = np.diff(ends, prepend=-1)
        b_last = np.searchsorted(b_end, a_end[ends])
        b_size = np.diff(b_last, prepend=-1)
        a_from, b_from = ends + 1 - a_size, b_last + 1 - b_size
        group_to = np.searchsorted(ends, a_to - 1, side="right")

        links = a_size * b_size
        is_wide = links > WIDE_GROUP
        plain = np.where(is_wide, 0, links)
        group, k = _spread(plain)
        pairs = pair_of(a[a_from[group] + k // b_size[group]], b[b_from[group] + k % b_size[group]])
        pair_to = np.concatenate([[0], np.cumsum(plain)])
        link_to = np.concatenate([[0], np.cumsum(links)])
        # Names in the order of the groups: a group's first tokens, then its second ones.
        both = a_size + b_size
        of, place = _spread(both)
        first_side = place < a_size[of]
        ids = np.where(first_side, a[np.minimum(a_from[of] + place, len(a) - 1)], b[np.maximum(b_from[of] + place - a_size[of], 0)])
        mark = np.where(place == a_size[of] - 1, 1, np.where(place == both[of] - 1, 2, 0))
        names = self.names[mark, ids].tolist()
        name_to = np.concatenate([[0], np.cumsum(both)])

        start, stop = group_to[:-1:2], group_to[1::2]
        n_a, n_b = a_to[1::2] - a_to[:-1:2], b_to[1::2] - b_to[:-1:2]
        columns = (n_a, n_b, stop - start, link_to[stop] - link_to[start], pair_to[stop] - pair_to[start])
        sizes, raw, step = np.stack(columns, axis=1).tobytes(), pairs.tobytes(), 8 * SIZES
        wide_to = np.concatenate([[0], np.cumsum(is_wide)])
        has_wide = wide_to[stop] > wide_to[start]
        at = zip(*[c.tolist() for c in (start, stop, 8 * pair_to[start], 8 * pair_to[stop], name_to[start], name_to[stop], has_wide)])
        for k, (g, h, p, q, n, m, some_wide) in enumerate(at):
            size, own, weights = sizes[k * step : (k + 1) * step], raw[p:q], b""
            if some_wide:  # different pairs, each with its number of links
                parts = [(pairs[p // 8 : q // 8], np.ones((q - p) // 8, np.int64))]
                for w in g + np.flatnonzero(is_wide[g:h]):
                    x, i = np.unique(a[a_from[w] : a_from[w] + a_size[w]], return_counts=True)
                    y, j = np.unique(b[b_from[w] : b_from[w] + b_size[w]], return_counts=True)
                    parts.append((pair_of(np.repeat(x, len(y)), np.tile(y, len(x))), np.outer(i, j).ravel()))
                own, weights = (np.concatenate(x).tobytes() for x in zip(*parts))
                size = size[:-8] + np.int64(len(own) // 8).tobytes()
            yield Unit(size, own, weights, "".join(names[n:m]))


@lru_cache(maxsize=1)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


# ---- documents ------------------------------------------------------------------


def segments(text: str) -> Iterator[str]:
    """A blank and the text, in parts of about a block that are cut at units."""
    text, start = " " + text, 0
    while len(text) - start > BLOCK and (cut := BEFORE_BLANK.search(text, start + BLOCK)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def units_of(segment: str) -> list[str]:
    return UNITS.findall(segment)


def _summed(pairs: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs in order, with the sums of their weights."""
    order = np.argsort(pairs, kind="stable")
    pairs, weights = pairs[order], weights[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first], np.add.reduceat(weights, first) if len(pairs) else weights


class Document:
    """One document's result, added up over its segments."""

    def __init__(self) -> None:
        self.sizes, self.good, self.digest = np.zeros(4, np.int64), True, hashlib.sha256()
        self.pairs = self.weights = np.empty(0, np.int64)

    def add(self, sizes: np.ndarray, text: str, pairs: np.ndarray, weights: np.ndarray) -> None:
        if self.sizes[0]:
            self.digest.update(b";")
            pairs, weights = _summed(np.concatenate([self.pairs, pairs]), np.concatenate([self.weights, weights]))
        self.sizes = self.sizes + sizes
        self.digest.update(text[:-1].encode())
        self.pairs, self.weights = pairs, weights

    def row(self) -> tuple:
        if not self.good or not self.sizes[0]:
            return 0, 0, 0, 0, "", b"", b""
        return *self.sizes.tolist(), self.digest.hexdigest(), self.pairs.tobytes(), self.weights.tobytes()


def aligned(aligner: Aligner, parts: list[tuple[Document, str]]) -> None:
    """Adds each segment to its document."""
    split = [units_of(segment) for _, segment in parts]
    counts = np.array([len(x) for x in split])
    number = {key: i for i, key in enumerate(dict.fromkeys(chain.from_iterable(split)))}
    flat = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, counts.sum())
    del split
    units = aligner.known(list(number))
    sizes = np.frombuffer(b"".join([u.sizes for u in units]), np.int64).reshape(-1, SIZES)
    pair = np.frombuffer(b"".join([u.pairs for u in units]), np.int64)
    pair_from = np.cumsum(sizes[:, 4]) - sizes[:, 4]
    weight = None
    if any([u.weights for u in units]):
        one = np.int64(1).tobytes()
        weight = np.frombuffer(b"".join([u.weights or one * (len(u.pairs) // 8) for u in units]), np.int64)
    first = np.cumsum(counts) - counts
    added = np.add.reduceat(sizes[flat], first, axis=0)  # no segment is without a unit
    spelt = np.minimum.reduceat(np.array([u is not NOT_SPELT for u in units])[flat], first)
    unit, k = _spread(sizes[flat, 4])
    taken = pair_from[flat[unit]] + k
    # One number for segment and pair: one sort finds every document's different pairs.
    keys = (np.repeat(np.arange(len(parts)), added[:, 4]) << (2 * ID_BITS)) | pair[taken]
    keys, weights = np.unique(keys, return_counts=True) if weight is None else _summed(keys, weight[taken])
    ends = np.searchsorted(keys, np.arange(len(parts) + 1) << (2 * ID_BITS)).tolist()
    keys &= (1 << (2 * ID_BITS)) - 1
    texts = np.array([u.text for u in units], object)[flat].tolist()
    for s, (document, _) in enumerate(parts):
        if not spelt[s]:
            document.good = False
        if document.good:
            text = "".join(texts[first[s] : first[s] + counts[s]])
            document.add(added[s, :4], text, keys[ends[s] : ends[s + 1]], weights[ends[s] : ends[s + 1]])


LINKS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, weights binary"
KINDS = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]


def document_links(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row per document with its sizes, the digest of its groups, and its links: the
    different pairs of ids and how often each is linked."""

    names = [c.split()[0] for c in LINKS.split(", ")]

    def blocks(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
        """Rows of about a block of text each, with their documents."""
        some, parts, size = [], [], 0
        for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
            document = Document()
            some.append((row, doc_id, document))
            for segment in segments(text) if text else ():
                parts.append((document, segment))
                size += len(segment)
                if size > BLOCK:
                    aligned(aligner_of(), parts)
                    parts, size = [], 0
            if not parts:  # else their last document is not whole yet
                yield some
                some = []
        if parts:
            aligned(aligner_of(), parts)
        yield some

    def aligner_of() -> Aligner:
        return _aligner(byte_path, piece_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in blocks(batch):
                if some:
                    columns = zip(*[(row, doc_id, *document.row()) for row, doc_id, document in some])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KINDS)], names)

    rows = slim(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    # Numbered where it is written, so that nulls and repeated ids stay rows of their own.
    return rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, LINKS)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, a, n, best): in how many documents a pair of ids is linked, and whether no
    other pair of its first id is linked in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column("pairs").to_pylist()), np.int64)
            pairs, n = np.unique(pairs, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n, pa.int64())], ["pair", "n"])

    counted = links.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = materialize(counted.withColumn("a", F.shiftright("pair", ID_BITS)), "alignment-counts")
    highest = counted.groupBy("a").agg(F.max("n").alias("highest"))
    each = counted.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    return materialize(each, "alignment-pairs")


def frequent_from(pairs: DataFrame, bound: int) -> int:
    """The smallest count such that at most ``bound`` pairs have it or more. Counts are
    looked at in steps of an eighth of a power of two: a short table."""
    step = F.floor(F.log2("n") * 8).cast("int")
    held, least = 0, None
    for r in sorted(pairs.groupBy(step.alias("step")).agg(F.count("n").alias("pairs"), F.min("n").alias("n")).collect(), reverse=True):
        held += r["pairs"]
        if held > bound:
            break
        least = r["n"]
    return least if least is not None else 1 << 62


def align_tokens(
    docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, frequent: int = FREQUENT_PAIRS
) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, ``n_best``,
    ``count_sum`` and the digest of its groups.

    A null or empty text, and one whose tokens do not spell it, has no tokens: zeros and
    an empty digest; its pairs are not counted. Null and repeated ids are documents like
    others. An empty table gives no rows. Long texts are handled in parts cut at blanks;
    a text without any blank is one part.
    """
    if byte_path is None or piece_path is None:
        import public_tokenizers

        byte_path = byte_path or public_tokenizers.path("byte_bpe_50k.json")
        piece_path = piece_path or public_tokenizers.path("piece_bpe_32k.model")
    links = materialize(document_links(docs, byte_path, piece_path), "alignment-links")
    pairs = pair_counts(links)
    least = frequent_from(pairs, frequent)
    known = pairs.where(F.col("n") >= least).toArrow()
    order = np.argsort(known.column("pair").to_numpy())
    table = tuple(known.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            raw = batch.column("pairs").to_pylist()
            of = np.repeat(np.arange(len(raw)), [len(x) // 8 for x in raw])
            wanted = np.frombuffer(b"".join(raw), np.int64)
            weight = np.frombuffer(b"".join(batch.column("weights").to_pylist()), np.int64)
            at = np.searchsorted(pair, wanted)
            there = at < len(pair)
            there[there] = pair[at[there]] == wanted[there]
            at, w, to = at[there], weight[there], of[there]
            sums = [np.zeros(len(raw), np.int64) for _ in range(2)]
            np.add.at(sums[0], to, w * best[at])
            np.add.at(sums[1], to, w * n[at])
            rest = np.flatnonzero(~there)
            ends = np.searchsorted(of[rest], np.arange(len(raw) + 1))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[rest], pa.int64())) for x in (wanted, weight)]
            kept = [batch.column(c) for c in batch.schema.names if c not in ("pairs", "weights")]
            arrays = [*kept, *(pa.array(s, pa.int64()) for s in sums), *lists]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = [f.split()[0] for f in LINKS.split(", ")[:7]] + ["best_known", "sum_known", "rare", "times"]
    schema = ", ".join(LINKS.split(", ")[:7]) + ", best_known long, sum_known long, rare array<long>, times array<long>"
    scored = materialize(links.mapInArrow(run, schema), "alignment-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("one"))
    rare = rare.select("row", F.col("one.rare").alias("pair"), F.col("one.times").alias("times"))
    rest = rare.join(pairs.where(F.col("n") < least), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_rare"),
        F.sum(F.col("times") * F.col("n")).alias("sum_rare"),
    )
    both = scored.join(rest, "row", "left")

    def added(known_part: str, rare_part: str) -> F.Column:
        return F.col(known_part) + F.coalesce(F.col(rare_part), F.lit(0))

    return both.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        added("best_known", "best_rare").alias("n_best"),
        added("sum_known", "sum_rare").alias("count_sum"),
        "groups_sha256",
    )
