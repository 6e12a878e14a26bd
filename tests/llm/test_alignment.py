"""Token alignment against whole texts, tokenized at once and cut at all common ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from salescope.llm import token_alignment as T
from salescope.llm.queries import QUERIES, table

DIR = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    return T.Tokenizers(*PATHS)


def groups_of(tokens, text):
    """All groups of a text, without units; None where the tokens do not spell it."""
    if not text:
        return None
    a, b = tokens.a.encode(" " + text, add_special_tokens=False).ids, tokens.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(tokens.a_bytes[i] for i in a) != raw or b"".join(tokens.b_bytes[i] for i in b) != raw:
        return None
    a_end, b_end = np.cumsum(tokens.a_size[a]).tolist(), np.cumsum(tokens.b_size[b]).tolist()
    found, i, j = [], 0, 0
    for cut in sorted(set(a_end) & set(b_end)):
        x, y = a_end.index(cut, i) + 1, b_end.index(cut, j) + 1
        found.append((a[i:x], b[j:y]))
        i, j = x, y
    return found


def digest(groups):
    names = (",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return hashlib.sha256(";".join(names).encode()).hexdigest()


def expected(tokens, texts):
    """A row per text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    all_groups = [groups_of(tokens, t) for t in texts]
    links = [Counter((x, y) for a, b in g or () for x in a for y in b) for g in all_groups]
    documents = Counter(p for c in links for p in c)
    highest = {}
    for (x, _), n in documents.items():
        highest[x] = max(highest.get(x, 0), n)
    rows = []
    for g, c in zip(all_groups, links):
        if g is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b = sum(len(a) for a, _ in g), sum(len(b) for _, b in g)
        best = sum(n for p, n in c.items() if documents[p] == highest[p[0]])
        total = sum(n * documents[p] for p, n in c.items())
        rows.append((n_a, n_b, len(g), sum(c.values()), best, total, digest(g)))
    return rows


def one(aligner, text):
    document = T.Document()
    if text:
        T.aligned(aligner, [(document, part) for part in T.segments(text)])
    return document.row()


def same(tokens, aligner, text):
    row, groups = one(aligner, text), groups_of(tokens, text)
    if groups is None:
        assert row[:5] == (0, 0, 0, 0, ""), text[:100]
        return
    links = Counter((x << T.ID_BITS) | y for a, b in groups for x in a for y in b)
    sizes = sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values())
    assert row[:5] == (*sizes, digest(groups)), text[:100]
    assert dict(zip(np.frombuffer(row[5], np.int64).tolist(), np.frombuffer(row[6], np.int64).tolist())) == links


def test_shared_cuts_are_all_common_ends():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = np.cumsum(rng.integers(1, 5, rng.integers(1, 40)))
        b = np.unique(np.append(rng.choice(a[-1], rng.integers(0, a[-1])) + 1, a[-1]))
        last = len(a) - 1
        cut = T.shared_cuts(a, b, np.array([0]), np.array([last]))
        assert (np.flatnonzero(cut) == np.flatnonzero(np.isin(a[:last], b))).all()


PARTS = ["a", "the ", "ing", " ", "  ", "\n", "\t", " \n", "\r", "\r\n", "é", "ß", "中", "文字", "🎉", " ", "　", "'s", "'"]
PARTS += ["1", "23", "▁", "<s>", "<|endoftext|>", "<0x41>", "\x00", "\x1c", "̸", "...", "$$$", ";", "ﬁ", "﻿", " x", "Zq", "​", "\x85"]


def test_any_text(tokens, monkeypatch):
    rng, aligner = random.Random(2), T.Aligner(*PATHS)
    for _ in range(4000):
        same(tokens, aligner, "".join(rng.choice(PARTS) for _ in range(rng.randrange(15))))
    monkeypatch.setattr(T, "KNOWN_UNITS", 20)  # forgets all the time
    monkeypatch.setattr(T, "BLOCK", 9)  # many segments
    for _ in range(500):
        same(tokens, aligner, "".join(rng.choice(PARTS) for _ in range(rng.randrange(40))))


def test_long_texts(tokens):
    aligner = T.Aligner(*PATHS)
    for text in ("word " * 600_000, "a" * 30_000, "中" * 9_000, "é🎉" * 5_000, " " * 20_000, "\n" * 5_000):
        row = one(aligner, text)
        assert row[0] and row[4]
        if len(text) < 100_000:
            same(tokens, aligner, text)


def test_query_matches_brute_force(spark, tokens):
    docs = table(spark, DIR, "documents").collect()
    wanted = expected(tokens, [r.text for r in docs])
    got = {r.doc_id: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
           for r in QUERIES["op13_token_alignment"](spark, DIR).collect()}
    assert got == {r.doc_id: w for r, w in zip(docs, wanted)}


@pytest.mark.parametrize("frequent", [0, 7, 1 << 18])
def test_odd_documents_whatever_is_broadcast(spark, tokens, frequent):
    texts = [None, "", " ", "▁", "one two", "one two", "One, two; three's 12é", "x  y\n\nz", "wait▁no", "中文 ok", "one two " * 3000]
    rows = [(None if k % 5 == 4 else k % 7, t, 1, "x", "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, pairs string, n string").repartition(3)
    got = [tuple(r) for r in T.align_tokens(docs, frequent=frequent).collect()]
    wanted = [(row[0], *w) for row, w in zip(rows, expected(tokens, texts))]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert T.align_tokens(docs.limit(0), frequent=frequent).collect() == []
