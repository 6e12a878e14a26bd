"""The whole leak search against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import log1p
from pathlib import Path

import numpy as np
import pytest

from salescope.llm import bm25_leaks
from salescope.llm.bm25_leaks import ANSWER, B, K1, QUESTION, THRESHOLD, WIDTH, build, candidates, drop_leaking, find_leaks, indexes
from salescope.sources import staging


def words_of(text):
    return re.findall("[a-z0-9]+", text.lower())


def grams_of(words, width=WIDTH):
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def parts_of(text):
    """The last sentence answers; of a single sentence, the last third."""
    found = [p for p in re.split(r"(?<=[.?!])", text.rstrip(" .?!")) if words_of(p)]
    if len(found) > 1:
        return words_of(" ".join(found[:-1])), words_of(found[-1])
    words = words_of(text)
    n = len(words) - len(words) // 3
    return words[:n], words[n:]


def share(part, passage):
    grams = grams_of(part)
    if len(grams) == 1:
        width = len(next(iter(grams)))
        return float(width <= len(passage) and grams <= grams_of(passage, width))
    return len(grams & grams_of(passage)) / len(grams) if len(passage) >= WIDTH else 0.0


def brute_force(docs, items):
    items = [(i, t, words_of(t)) for i, t in items if t and words_of(t)]
    df = Counter(w for _, _, ws in items for w in set(ws))
    mean = sum(len(ws) for _, _, ws in items) / len(items)
    span = max(len(ws) for _, _, ws in items)
    out = {}
    for doc, text in docs:
        words = words_of(text or "")
        for a in range(0, len(words), span):
            passage = words[a : a + 2 * span]
            for i, t, ws in items:
                own = {}
                for w, n in Counter(ws).items():
                    idf = log1p((len(items) - df[w] + 0.5) / (df[w] + 0.5))
                    own[w] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * len(ws) / mean))
                score = sum(s for w, s in own.items() if w in set(passage)) / sum(own.values())
                if score < THRESHOLD - 1e-9:
                    continue
                asked, answer = parts_of(t)
                q = share(asked, passage)
                r = share(answer, passage) if answer else q
                if q >= QUESTION and r >= ANSWER:
                    best = out.get((doc, i), (0, 0, 0, 0))
                    out[doc, i] = (max(best[0], score), max(best[1], q), max(best[2], r), best[3] + 1)
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(150)]

    def some(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(k, f"{some(rng.randint(4, 16))}? {some(rng.randint(1, 6))}.") for k in range(60)]
    items += [(60, some(9)), (61, "zyx wvu"), (62, "qqq"), (63, ""), (64, None), (65, "?!"), (None, some(12))]
    docs = []
    for k in range(120):
        text = some(rng.randint(0, 90))
        if k % 2:
            own = (items[k % len(items)][1] or "").split()
            if k % 6 == 1 and own:
                own[rng.randrange(len(own))] = "changed"
            text += " " + " ".join(own) + " " + some(rng.randint(0, 40))
        docs.append((k, text))
    docs += [(200, "Some ZYX wvu, here"), (201, "zyx and wvu"), (202, "a qqq b"), (203, None), (204, "")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return docs, items, *frames


@pytest.mark.parametrize("per_pass", [20_000, 9])
def test_leaks_match_brute_force(case, per_pass):
    docs, items, docs_frame, items_frame = case
    want = brute_force(docs, items)
    found = find_leaks(docs_frame, items_frame, per_pass=per_pass).collect()
    got = {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap, r.n_passages) for r in found}
    assert len(found) == len(got) and set(got) == set(want)
    assert {(200, 61), (202, 62)} <= set(got) and (201, 61) not in got and len(got) > 30
    for pair, values in want.items():
        assert got[pair] == pytest.approx(values), pair


@pytest.mark.parametrize("per_pass", [20_000, 9])
def test_leaking_documents_go(case, per_pass):
    docs, items, docs_frame, items_frame = case
    gone = {doc for doc, _ in brute_force(docs, items)}
    kept = drop_leaking(docs_frame, items_frame, per_pass=per_pass).collect()
    assert sorted(r.doc_id for r in kept) == sorted({d for d, _ in docs} - gone)


def test_few_postings_are_laid_out_at_once(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randint(6, 12))) for _ in range(200)]
    index = build([*enumerate(texts), (200, "w1"), (201, "w2 w3")])
    rows = [" ".join(f"w{rng.randrange(330)}" for _ in range(rng.randint(0, 90))) for _ in range(60)]
    data = np.frombuffer("".join(rows).encode(), np.uint8)
    words, first = bm25_leaks._words(data, np.cumsum([0, *map(len, rows)]))
    counted = []
    one = bm25_leaks._enough

    def spy(place, t, *rest):
        counted.append(int(np.diff(index.at)[t].sum()))
        return one(place, t, *rest)

    monkeypatch.setattr(bm25_leaks, "_enough", spy)
    whole = candidates(words, first, index, 0.4)
    assert len(counted) == 1 and counted[0] > 5000 and 0 < len(whole[0])
    counted.clear()
    monkeypatch.setattr(bm25_leaks, "POSTINGS_AT_ONCE", 500)
    for a, b in zip(candidates(words, first, index, 0.4), whole):
        assert a.tolist() == b.tolist()
    assert max(counted) < 1000 and len(counted) > 5


def test_a_small_benchmark_is_written_in_few_files(spark, case, monkeypatch):
    paths = []
    write = staging.write_staged
    monkeypatch.setattr(staging, "write_staged", lambda df, name: paths.append(write(df, name)) or paths[-1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert len(next(indexes(case[3])).items) == 64
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(paths) == 3
    for path in paths:
        assert len(list(Path(path.removeprefix("file:")).glob("part-*"))) == 1, path
