"""Benchmark decontamination: BM25 with block-max WAND, then overlap.

The benchmark's items are indexed (in blocks of items, so that the index of one pass
has a fixed bound); every passage of every document is a query. A passage is as long
as two of the longest items and starts every item length, so an item lies whole in
some passage. Scores are divided by the item's score for itself: all items with at
least ``threshold`` are found. Passages whose essential terms leave every item short of
it are skipped; for the others, upper bounds of a term's scores, first of the whole list
and then of the list's blocks, skip items that cannot reach it.

A retrieved pair counts if the passage also holds the item's question and its answer. An
item of one or two words has no answer part: its question alone decides.

Document frequencies, the mean and the greatest length are counted once by Spark over all
items and are the same for every block of items, so the blocks change no result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import ALNUM_WORD, LOWER, SpanHash, blocks, materialize, shingles, slim, word_spans

K1, B = 1.2, 0.75
THRESHOLD = 0.5
QUESTION, ANSWER = 0.8, 0.5
WIDTH = 5
POSTING_BLOCK = 32
ITEMS_PER_PASS = 20_000
WORDS_PER_PASS = 2_000_000
# Postings of essential terms laid out at once in a task, in some ten arrays of eight bytes each.
POSTINGS_AT_ONCE = 1 << 19


class Counts(NamedTuple):
    """What BM25 needs to know of all items."""

    items: int
    mean: float  # words of an item
    span: int  # words of the longest item
    terms: np.ndarray  # sorted word hashes, at least those of the items at hand
    df: np.ndarray  # items that hold each of them


@dataclass
class Index:
    items: list[object]
    terms: np.ndarray  # sorted word hashes
    at: np.ndarray  # first posting of each term
    docs: np.ndarray  # item of each posting, ascending in a term
    impact: np.ndarray  # normalised score of each posting
    top: np.ndarray  # largest impact of each term
    span: int  # words of the longest item
    question: list[np.ndarray]  # sorted shingles
    answer: list[np.ndarray]
    unpacked: dict[int, tuple] = field(default_factory=dict)
    needs: dict[float, tuple] = field(default_factory=dict)  # of each threshold, see essential()

    def postings(self, term: int) -> tuple:
        """A term's items, impacts, start, top, block maxima and block ends, as lists."""
        if term not in self.unpacked:
            part = slice(self.at[term], self.at[term + 1])
            docs, impact = self.docs[part].tolist(), self.impact[part].tolist()
            cuts = range(0, len(docs), POSTING_BLOCK)
            most = [max(impact[k : k + POSTING_BLOCK]) for k in cuts]
            last = [docs[min(k + POSTING_BLOCK, len(docs)) - 1] for k in cuts]
            self.unpacked[term] = (docs, impact, 0, float(self.top[term]), most, last)
        return self.unpacked[term]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lower = LOWER[data]
    starts, ends, first = word_spans(lower, offsets, ALNUM_WORD)
    return SpanHash(lower).of(starts, ends), first


def _hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return _words(data, np.array([0, len(data)]))[0]


def _grams(words: np.ndarray) -> np.ndarray:
    return np.unique(shingles(words, np.array([0, len(words)]), WIDTH)[0])


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence answers; of a single sentence, the last third."""
    body = text.rstrip().rstrip(".?!")
    cut = max(body.rfind(mark) for mark in ".?!\n")
    if cut > 0 and _hashes(body[:cut]).size and _hashes(body[cut + 1 :]).size:
        return body[: cut + 1], body[cut + 1 :]
    words = body.split()
    n = len(words) - len(words) // 3
    return " ".join(words[:n]), " ".join(words[n:])


def counts_of(texts: list[str]) -> Counts:
    """The counts of items that are all at hand."""
    words = [w for w in map(_hashes, texts) if w.size]
    found = np.concatenate([np.unique(w) for w in words]) if words else np.empty(0, np.uint64)
    sizes = [len(w) for w in words]
    return Counts(len(words), sum(sizes) / max(len(words), 1), max(sizes, default=1), *np.unique(found, return_counts=True))


def build(rows: list[tuple[object, str]], counts: Counts | None = None) -> Index:
    """Postings with BM25 impacts, each divided by the item's score for itself."""
    counts = counts or counts_of([t for _, t in rows])
    rows = [(i, t) for i, t in rows if t and _hashes(t).size]
    words = [_hashes(t) for _, t in rows]
    found = [np.unique(w, return_counts=True) for w in words]
    terms = np.unique(np.concatenate([t for t, _ in found])) if found else np.empty(0, np.uint64)
    df = counts.df[np.searchsorted(counts.terms, terms)]
    idf = np.log1p((counts.items - df + 0.5) / (df + 0.5))
    term, doc, score = [], [], []
    for d, (t, n) in enumerate(found):
        k = np.searchsorted(terms, t)
        s = idf[k] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words[d]) / counts.mean))
        term.append(k)
        doc.append(np.full(len(k), d))
        score.append(s / s.sum())
    term, doc, score = (np.concatenate(x) if x else np.empty(0) for x in (term, doc, score))
    order = np.lexsort((doc, term))
    term, doc, score = term[order].astype(np.int64), doc[order].astype(np.int64), score[order]
    at = np.searchsorted(term, np.arange(len(terms) + 1))
    top = np.maximum.reduceat(score, at[:-1]) if len(terms) else np.empty(0)
    parts = [split_item(t) for _, t in rows]
    return Index(
        [i for i, _ in rows], terms, at, doc, score, top, counts.span,
        [_grams(_hashes(q)) for q, _ in parts], [_grams(_hashes(a)) for _, a in parts],
    )


def block_max_wand(index: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All (item, score) with a score of at least ``threshold`` for distinct ``terms``."""
    limit = threshold - 1e-9
    # [items, impacts, position, top, block maxima, block ends]
    lists = [[*index.postings(int(t))] for t in terms]
    out = []
    while True:
        lists = [x for x in lists if x[2] < len(x[0])]
        lists.sort(key=lambda x: x[0][x[2]])
        bound, pivot = 0.0, -1
        for i, x in enumerate(lists):
            bound += x[3]
            if bound >= limit:
                pivot = i
                break
        if pivot < 0:
            return out
        doc = lists[pivot][0][lists[pivot][2]]
        while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][2]] == doc:
            pivot += 1
        front = lists[: pivot + 1]
        # The blocks that could hold the pivot item: their maxima, and where they end.
        bound, border = 0.0, doc
        ends = []
        for x in front:
            k = bisect_left(x[5], doc)
            if k < len(x[5]):
                bound += x[4][k]
                ends.append(x[5][k])
        if bound < limit:
            # No item up to the nearest block end can reach the threshold.
            border = min(ends)
            target = border + 1
            if pivot + 1 < len(lists):
                target = min(target, lists[pivot + 1][0][lists[pivot + 1][2]])
        else:
            score = 0.0
            for x in front:
                k = bisect_left(x[0], doc, x[2])
                if k < len(x[0]) and x[0][k] == doc:
                    score += x[1][k]
            if score >= limit:
                out.append((doc, score))
            target = doc + 1
        target = max(target, doc + 1)
        for x in front:
            x[2] = bisect_left(x[0], target, x[2])


def essential(index: Index, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which terms are essential, and what each item needs from its essential terms.

    The most frequent terms are left out while no item has more than 0.6 of the
    threshold from them: an item that reaches the threshold has the rest from others.
    """
    keep = np.ones(len(index.terms), bool)
    common = np.zeros(len(index.items))
    for t in np.argsort(-np.diff(index.at), kind="stable"):
        part = slice(index.at[t], index.at[t + 1])
        more = common[index.docs[part]] + index.impact[part]
        if more.max() > 0.6 * threshold:
            break
        common[index.docs[part]] = more
        keep[t] = False
    return keep, threshold - common - 1e-9


def candidates(
    words: np.ndarray, first: np.ndarray, index: Index, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Passages (row, first word, end) that may reach the threshold for some item, by
    the postings of essential terms alone; and the term of every word (-1: none)."""
    span = index.span
    at = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    term = np.where(index.terms[at] == words, at, -1)
    if threshold not in index.needs:
        index.needs[threshold] = essential(index, threshold)
    keep, need = index.needs[threshold]
    known = np.flatnonzero((term >= 0) & keep[term])
    owner = np.searchsorted(first, known, side="right") - 1
    # Distinct essential terms of each stretch of `span` words; a passage is two stretches.
    base = np.concatenate([[0], np.cumsum(np.diff(first) // span + 1)])
    stretch = base[owner] + (known - first[owner]) // span
    code = np.unique(stretch * len(index.terms) + term[known])
    place, t = code // len(index.terms), code % len(index.terms)
    starts_row = np.zeros(base[-1] + 1, bool)
    starts_row[base] = True
    # Passages in turns, so that the postings laid out at once stay few, however long the lists.
    at = np.searchsorted(place, np.arange(base[-1] + 1))
    done = np.concatenate([[0], np.cumsum(np.diff(index.at)[t])])[at]
    found, low = [np.empty(0, np.int64)], 0
    while low < base[-1]:
        high = int(np.searchsorted(done, done[low] + POSTINGS_AT_ONCE, side="right")) - 1
        high = min(max(high, low + 1), int(base[-1]))
        part = slice(at[low], at[min(high + 1, base[-1])])
        found.append(_enough(place[part], t[part], low, high, starts_row, index, need))
        low = high
    passage = np.concatenate(found)
    row = np.searchsorted(base, passage, side="right") - 1
    begin = first[row] + (passage - base[row]) * span
    return row, begin, np.minimum(begin + 2 * span, first[row + 1]), term


def _enough(
    place: np.ndarray, t: np.ndarray, low: int, high: int, starts_row: np.ndarray, index: Index, need: np.ndarray
) -> np.ndarray:
    """The passages from ``low`` to ``high`` with what some item needs, by the terms ``t``
    of the stretches ``place``: those of the passages and the one behind them."""
    n = np.diff(index.at)[t]
    posting = np.repeat(index.at[t] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(t) else t
    place = np.repeat(place, n)
    own, earlier = place < high, ~starts_row[place] & (place > low)
    pair = np.concatenate([place[own], place[earlier] - 1]) * len(index.items)
    pair += np.concatenate([index.docs[posting[own]], index.docs[posting[earlier]]])
    value = np.concatenate([index.impact[posting[own]], index.impact[posting[earlier]]])
    pair, inverse = np.unique(pair, return_inverse=True)
    total = np.bincount(inverse, value, minlength=len(pair))
    return np.unique(pair[total >= need[pair % len(index.items)]] // len(index.items))


def search(words: np.ndarray, first: np.ndarray, index: Index, threshold: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, passage start, end) for every passage at or above the threshold."""
    if len(index.terms) == 0 or len(words) == 0:
        return
    rows, begins, ends, term = candidates(words, first, index, threshold)
    for row, a, b in zip(rows.tolist(), begins.tolist(), ends.tolist()):
        own = np.unique(term[a:b])
        for item, score in block_max_wand(index, own[own >= 0], threshold):
            yield row, item, score, a, b


def held(part: np.ndarray, grams: np.ndarray) -> float:
    return float(np.isin(part, grams).mean()) if len(part) else 0.0


SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, n_passages long"


def _pass(docs: DataFrame, index: Index, threshold: float, question: float, answer: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.int64()]
        for batch, data, offsets in blocks(batches):
            words, first = _words(data, offsets)
            best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
            grams, mark = None, None
            for row, item, score, a, b in search(words, first, index, threshold):
                if (a, b) != mark:
                    mark, grams = (a, b), _passage_grams(words[a:b])
                q, r = _overlaps(index, item, grams)
                if q >= question and r >= answer:
                    old = best.get((row, item), (0.0, 0.0, 0.0, 0))
                    best[row, item] = (*max(old[:3], (score, q, r)), old[3] + 1)
            if best:
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[row], index.items[item], *x) for (row, item), x in best.items()]
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(run, SCHEMA)


def _passage_grams(words: np.ndarray) -> list[np.ndarray]:
    """Sorted shingles of each width up to five."""
    border = np.array([0, len(words)])
    return [np.unique(shingles(words, border, k)[0]) if len(words) >= k else np.empty(0, np.uint64) for k in range(1, WIDTH + 1)]


def _overlap(part: np.ndarray, grams: list[np.ndarray]) -> float:
    # A short part has fewer words than a shingle: look for it as it stands.
    return max(held(part, g) for g in grams) if len(part) == 1 else held(part, grams[-1])


def _overlaps(index: Index, item: int, grams: list[np.ndarray]) -> tuple[float, float]:
    """How much of the question and of the answer is there; without an answer, the question counts as both."""
    q, answer = _overlap(index.question[item], grams), index.answer[item]
    return q, _overlap(answer, grams) if len(answer) else q


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    question: float = QUESTION,
    answer: float = ANSWER,
    per_pass: int = ITEMS_PER_PASS,
) -> DataFrame:
    """One row per document and item that it holds.

    Null and empty documents and items, and those without a word, match nothing. An item
    of one or two words is held by a text that has these words in a row. Documents without
    a leak have no row; an empty benchmark gives none at all. Null and repeated ids appear
    as they are. A benchmark of more items or words than one pass may hold is searched in
    several passes, each over all documents, with the same results; items are numbered by
    a hash, so a pass has a known size.
    """
    rows = slim(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    result = None
    for index in indexes(benchmark, per_pass):
        one = _pass(rows, index, threshold, question, answer)
        result = one if result is None else result.unionByName(one)
    return result


def _terms(items: DataFrame) -> DataFrame:
    """(part, term, words): each item's distinct words, its number of words beside the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            words, first = _words(data, offsets)
            parts, terms, sizes = [], [], []
            for part, a, b in zip(batch.column("part").to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                own = np.unique(words[a:b]).view(np.int64).tolist()
                parts += [part] * len(own)
                terms += own
                sizes += [b - a, *[None] * (len(own) - 1)] if own else []
            arrays = [pa.array(parts, pa.int32()), pa.array(terms, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "term", "words"])

    return items.select("part", "text").mapInArrow(run, "part int, term long, words long")


def indexes(benchmark: DataFrame, per_pass: int = ITEMS_PER_PASS) -> Iterator[Index]:
    """Indexes of at most about ``per_pass`` items and ``WORDS_PER_PASS`` words each,
    fetched one after another; the counts that their scores need cover all items."""
    items = slim(benchmark, "item_id", "text").where("text IS NOT NULL")
    rows = items.count()
    items = items.dropDuplicates(["item_id", "text"])
    # Parts of a fixed number first: a pass takes some of them, known once they are counted.
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(1 << 20)).cast("int")
    items = materialize(items.withColumn("part", number), "leak-items", rows)
    terms = materialize(_terms(items), "leak-terms")
    counts = F.count("words").alias("n"), F.sum("words").alias("words"), F.max("words").alias("span"), F.count("term").alias("rows")
    total = terms.agg(*counts).first()
    n, words = total["n"], total["words"] or 0
    df = materialize(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "leak-frequencies", total["rows"])
    passes = max(1, -(-n // per_pass), -(-words // WORDS_PER_PASS))
    for k in range(passes):
        mine = F.pmod("part", F.lit(passes)) == k
        known = df.join(terms.where(mine).select("term").distinct(), "term", "left_semi").toArrow()
        term = known["term"].to_numpy().view(np.uint64)
        order = np.argsort(term)
        counts = Counts(n, words / max(n, 1), total["span"] or 1, term[order], known["df"].to_numpy()[order])
        found = items.where(mine).collect()
        yield build(sorted([(r.item_id, r.text) for r in found], key=lambda r: (r[0] is None, r[0], r[1])), counts)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """``docs`` without the rows that hold an item. Rows are judged where they are read,
    so no join by id is needed and rows that share an id are judged one by one."""
    kept = docs
    for index in indexes(benchmark, per_pass):
        kept = _clean(kept, index)
    return kept


def _clean(docs: DataFrame, index: Index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            words, first = _words(data, offsets)
            keep = np.ones(batch.num_rows, bool)
            for row, item, _, a, b in search(words, first, index, THRESHOLD):
                if keep[row]:
                    grams = _passage_grams(words[a:b])
                    q, r = _overlaps(index, item, grams)
                    keep[row] = not (q >= QUESTION and r >= ANSWER)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
