"""Language ID by a linear-chain conditional random field over words.

Each word of a code-switched text gets a distribution over languages. A word's score
sums learned weights of its affixes (1 to 3 bytes at either end), its byte n-grams (2
and 3 within the word) and its lexicon entry (the whole word); transitions between
neighbouring words are learned too. Forward-backward over the whole text gives the
marginals; their mean over the words decides the document.

The field is fitted on a bounded, repeatable sample of labelled documents, of which at
most ``SAMPLE_WORDS`` words of each language are used: windows of several languages are
joined into training sequences, so switches are seen. Prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import (
    LETTER_WORD,
    LOWER,
    SpanHash,
    blocks,
    fold,
    sampled,
    slim,
    word_spans,
)

BUCKETS = 1 << 17
SAMPLE_DOCS = 300  # labelled documents of each language, at most about this many
SAMPLE_WORDS = 30_000  # words of each language in training sequences
SEGMENT = 64
UNKNOWN = "und"


@dataclass
class Field:
    labels: list[str]
    weights: np.ndarray  # (labels, BUCKETS)
    trans: np.ndarray  # (labels, labels)


def letters_only(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes; 0 where no word is."""
    return np.where(LETTER_WORD[data], LOWER[data], np.uint8(0))


def _bucket(key: np.ndarray, salt: int) -> np.ndarray:
    spread = (key + np.uint32(salt * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(2654435761)
    return (((spread ^ (spread >> np.uint32(15))) * np.uint32(2246822519)) >> np.uint32(15)).astype(np.int32)


def _affixes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Bucket of each word's lexicon entry, prefixes and suffixes, one array per kind."""
    whole = SpanHash(lower).of(starts, ends)
    found = [(whole >> np.uint64(47)).astype(np.int32)]
    wide = np.concatenate([lower, np.zeros(3, np.uint8)]).astype(np.uint32)
    size = ends - starts
    for side in (1, 2):
        key = np.zeros(len(starts), np.uint32)
        for k in range(3):
            byte = wide[starts + k] if side == 1 else wide[np.maximum(ends - 1 - k, 0)]
            key |= np.where(size > k, byte, 0).astype(np.uint32) << np.uint32(8 * k)
            found.append(_bucket(key, 10 * side + k))
    return found


def _grams(lower: np.ndarray) -> list[np.ndarray]:
    """Bucket of the byte bigram and trigram that end at each byte; a byte outside
    words is 0, which marks the border of a word."""
    wide = lower.astype(np.uint32)
    two = wide.copy()
    two[1:] |= wide[:-1] << np.uint32(8)
    three = two.copy()
    three[2:] |= np.where(lower[1:-1] > 0, wide[:-2], 0).astype(np.uint32) << np.uint32(16)
    return [_bucket(two, 1), _bucket(three, 2)]


def emissions(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores (words, labels); ``weights`` has one row per label."""
    if len(starts) == 0:
        return np.zeros((0, len(weights)), np.float32)
    affixes, grams = _affixes(lower, starts, ends), _grams(lower)
    outside = lower == 0
    total = np.empty((len(starts), len(weights)), np.float32)
    for c, w in enumerate(weights):
        each = w[grams[0]] + w[grams[1]]
        each[outside] = 0
        column = np.add.reduceat(each, starts)
        for bucket in affixes:
            column += w[bucket]
        total[:, c] = column
    return total


def marginals(scores: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Forward-backward over many chains at once; row i of the chains is
    ``scores[first[i]:first[i + 1]]``.

    Chains are cut into segments of 64 words. All segments advance together: first
    their transfer matrices, then (segment by segment) the messages at their ends,
    then the messages inside. Long texts cost no more per word than short ones.
    """
    n, k = scores.shape
    if n == 0:
        return np.zeros((0, k))
    step = np.exp(trans - trans.max()).astype(np.float32)
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
    counts = np.diff(first)
    pieces = -(-counts // SEGMENT)
    chain = np.repeat(np.arange(len(counts)), pieces)
    at = np.concatenate([[0], np.cumsum(pieces)])
    nth = np.arange(at[-1]) - at[chain]
    begin = first[chain] + nth * SEGMENT
    length = np.minimum(SEGMENT, first[chain + 1] - begin)
    order = np.argsort(-length, kind="stable")
    active = [int(np.searchsorted(-length[order], -t, side="left")) for t in range(SEGMENT)]
    # Transfer matrices of whole segments.
    matrix = np.tile(np.eye(k, dtype=np.float32), (len(order), 1, 1))
    for t in range(SEGMENT):
        m = active[t]
        if m == 0:
            break
        now = (matrix[:m].reshape(-1, k) @ step).reshape(m, k, k) * e[begin[order[:m]] + t][:, None, :]
        matrix[:m] = now if t % 8 else now / now.max(axis=(1, 2), keepdims=True)
    whole = np.empty_like(matrix)
    whole[order] = matrix / matrix.max(axis=(1, 2), keepdims=True)
    # Messages at segment borders, all chains together, one segment at a time.
    left = np.full((len(order), k), 1 / k, np.float32)
    right = left.copy()
    by_chain = np.argsort(-pieces, kind="stable")
    sizes = -pieces[by_chain]
    for j in range(1, int(pieces.max())):
        here = at[by_chain[: int(np.searchsorted(sizes, -j, side="left"))]] + j
        v = np.einsum("si,sij->sj", left[here - 1], whole[here - 1])
        left[here] = v / v.sum(axis=1, keepdims=True)
    for j in range(int(pieces.max()) - 1, 0, -1):
        here = at[by_chain[: int(np.searchsorted(sizes, -j, side="left"))]] + j
        v = np.einsum("sij,sj->si", whole[here], right[here])
        right[here - 1] = v / v.sum(axis=1, keepdims=True)
    # Inside.
    alpha, beta = np.empty((n, k), np.float32), np.empty((n, k), np.float32)
    state = left[order]
    for t in range(SEGMENT):
        m = active[t]
        if m == 0:
            break
        where = begin[order[:m]] + t
        v = (state[:m] @ step) * e[where]
        state[:m] = v if t % 8 else v / v.sum(axis=1, keepdims=True)
        alpha[where] = state[:m]
    state = right[order]
    for t in range(SEGMENT - 1, -1, -1):
        m = active[t]
        if m == 0:
            continue
        where = begin[order[:m]] + t
        beta[where] = state[:m]
        v = (state[:m] * e[where]) @ step.T
        state[:m] = v if t % 8 else v / v.sum(axis=1, keepdims=True)
    alpha *= beta
    alpha /= alpha.sum(axis=1, keepdims=True)
    return alpha


def train(texts: list[tuple[str, str]], words: int = SAMPLE_WORDS, epochs: int = 6, seed: int = 5) -> Field:
    """Maximum likelihood with AdaGrad steps over batches of joined windows."""
    labels = sorted({lang for _, lang in texts})
    rng = np.random.default_rng(seed)
    pools: list[list[bytes]] = []
    for lang in labels:
        pool: list[list[bytes]] = []
        mine = [t for t, own in texts if own == lang]
        size = 0
        for i in rng.permutation(len(mine)):
            data = np.frombuffer(mine[i].encode(), np.uint8)
            a, b, _ = word_spans(data, np.array([0, len(data)]), LETTER_WORD)
            raw = [data[x:y].tobytes() for x, y in zip(a, b)]
            at = 0
            while at < len(raw) and size < words:
                n = int(rng.integers(1, 40))
                pool.append(raw[at : at + n])
                size += len(raw[at : at + n])
                at += n
            if size >= words:
                break
        pools.append(pool)
    pieces = [(k, p) for k, pool in enumerate(pools) for p in pool if p]
    k = len(labels)
    field = Field(labels, np.zeros((k, BUCKETS), np.float32), np.zeros((k, k)))
    if k < 2 or not pieces:
        return field
    past_w, past_t = np.full((k, BUCKETS), 1e-6), np.full((k, k), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(pieces))
        # Three or so windows make a sequence; a batch has about a hundred sequences.
        for batch in np.array_split(order, max(1, len(order) // 300)):
            joined, gold, first = [], [], [0]
            for i in range(0, len(batch), 3):
                for j in batch[i : i + 3]:
                    lab, piece = pieces[j]
                    joined += piece
                    gold += [lab] * len(piece)
                first.append(len(gold))
            data = letters_only(np.frombuffer(b" ".join(joined), np.uint8))
            sizes = np.array([len(x) for x in joined])
            starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
            ends = starts + sizes
            first, gold = np.array(first), np.array(gold)
            scores = emissions(data, starts, ends, field.weights)
            p = marginals(scores, first, field.trans)
            delta = -p.astype(float)
            delta[np.arange(len(gold)), gold] += 1
            # Gradient of the transitions from pair marginals of neighbours.
            inner = np.setdiff1d(np.arange(len(gold)), first[:-1])
            pair = p[inner - 1][:, :, None] * np.exp(field.trans)[None] * p[inner][:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            grad_t = -pair.sum(axis=0)
            np.add.at(grad_t, (gold[inner - 1], gold[inner]), 1)
            grad_w = np.zeros((k, BUCKETS))
            affixes, grams = _affixes(data, starts, ends), _grams(data)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            byte = np.arange(len(owner)) + owner
            for c in range(k):
                mine = delta[:, c]
                for bucket in affixes:
                    grad_w[c] += np.bincount(bucket, mine, BUCKETS)
                for bucket in grams:
                    grad_w[c] += np.bincount(bucket[byte], mine[owner], BUCKETS)
            past_w += grad_w**2
            past_t += grad_t**2
            field.weights += (0.1 * grad_w / np.sqrt(past_w + 1e-8)).astype(np.float32)
            field.trans += 0.1 * grad_t / np.sqrt(past_t)
    return field


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Fits on about ``sample_docs`` documents of each language whose fold is not 0."""
    rows = slim(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.where(fold(F.col("doc_id")) != 0)
    picked = sampled(rows, "lang", F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), sample_docs)
    found = picked.select("text", "lang", "doc_id").collect()
    found.sort(key=lambda r: (r.lang, str(r.doc_id), r.text))
    return train([(r.text, r.lang) for r in found])


def label_words(text: str, field: Field) -> list[tuple[str, str, float]]:
    """Each word of a text with its language and the marginal of it."""
    data = letters_only(np.frombuffer(text.encode(), np.uint8))
    starts, ends, first = word_spans(data, np.array([0, len(data)]), LETTER_WORD)
    p = marginals(emissions(data, starts, ends, field.weights), first, field.trans)
    raw = text.encode()
    return [
        (raw[a:b].decode(), field.labels[int(x.argmax())], float(x.max())) for a, b, x in zip(starts, ends, p)
    ]


SCHEMA = "doc_id long, lang_pred string, score double, n_words long, n_switches long"


def identify(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, n_words, n_switches``.

    ``score`` is the mean marginal of the predicted language over the words. A null
    text, or one without a letter, gets ``und`` and 0; so does every text when nothing
    is labelled. A null id counts as held out. Ties go to the first language by name.
    Equal rows give equal results. The field is one bounded array, sent with the tasks.
    """
    field = field or fit(docs)
    k = len(field.labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            lower = letters_only(data)
            starts, ends, first = word_spans(lower, offsets, LETTER_WORD)
            counts = np.diff(first)
            if k:
                p = marginals(emissions(lower, starts, ends, field.weights), first, field.trans)
                sums = np.zeros((len(p) + 1, k))
                np.cumsum(p, axis=0, out=sums[1:])
                mean = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(counts, 1)[:, None]
                mean = np.round(mean, 9)
                best = mean.argmax(axis=1)
                score = np.clip(mean[np.arange(len(mean)), best], 0, 1)
                tag = p.argmax(axis=1)
                turn = np.zeros(len(tag) + 1, np.int64)
                turn[1:-1] = np.cumsum(tag[1:] != tag[:-1]) if len(tag) > 1 else turn[1:-1]
                if len(tag):
                    turn[-1] = turn[-2]
                switches = np.where(counts > 0, turn[np.maximum(first[1:], 1)] - turn[np.minimum(first[:-1] + 1, len(tag))], 0)
            lettered = counts > 0
            plain = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
            ascii_letters = np.concatenate([[0], np.cumsum(plain)])
            for i in np.flatnonzero(lettered & (ascii_letters[offsets[1:]] == ascii_letters[offsets[:-1]])):
                lettered[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
            known = lettered & bool(k)
            names = [field.labels[best[i]] if ok else UNKNOWN for i, ok in enumerate(known)]
            arrays = [
                batch.column("doc_id"),
                pa.array(names, pa.string()),
                pa.array(np.where(known, score, 0.0) if k else np.zeros(len(known))),
                pa.array(counts.astype(np.int64)),
                pa.array(np.where(known, switches, 0) if k else np.zeros(len(known), np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "n_words", "n_switches"])

    rows = slim(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = rows.mapInArrow(run, SCHEMA)
    return found.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "n_words", "n_switches"
    )


MIN_SCORE = 0.4


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the texts that are ``und`` or have no language with a mean
    marginal of ``min_score``. Rows are judged where they are read: no join by id."""
    field = fit(docs)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            keep = judged(data, offsets, field) >= min_score
            yield batch.filter(pa.array(keep))

    return docs.select(*names).mapInArrow(run, docs.schema)


def judged(data: np.ndarray, offsets: np.ndarray, field: Field) -> np.ndarray:
    """The mean marginal of each row's best language; -1 for rows without a letter."""
    lower = letters_only(data)
    starts, ends, first = word_spans(lower, offsets, LETTER_WORD)
    counts = np.diff(first)
    if not field.labels:
        return np.where(counts > 0, 1.0, -1.0)
    p = marginals(emissions(lower, starts, ends, field.weights), first, field.trans)
    sums = np.zeros((len(p) + 1, p.shape[1]))
    np.cumsum(p, axis=0, out=sums[1:])
    mean = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(counts, 1)[:, None]
    lettered = counts > 0
    for i in np.flatnonzero(lettered):
        text = data[offsets[i] : offsets[i + 1]]
        if not (((text >= 65) & (text <= 90)) | ((text >= 97) & (text <= 122))).any():
            lettered[i] = any(c.isalpha() for c in text.tobytes().decode())
    return np.where(lettered, np.round(mean.max(axis=1), 9), -1.0)
