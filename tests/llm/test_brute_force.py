"""Operators against plain Python over the smallest tables, and held-out accuracy."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from salescope.llm import jaccard_join
from salescope.llm.bm25_leaks import build, block_max_wand, _hashes
from salescope.llm.language_crf import marginals
from salescope.llm.license_rules import Rule, rules, suppressed
from salescope.llm.packing import SEQUENCE, shortest_pack_first
from salescope.llm.queries import QUERIES, table
from salescope.sources import staging

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DIR, "documents").collect()


@pytest.fixture(scope="module")
def results(spark):
    return lambda name: QUERIES[name](spark, DIR).collect()


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    scores, trans = rng.normal(size=(150, 3)), rng.normal(size=(3, 3))
    found = marginals(scores, np.array([0, 5, 5, 150]), trans)
    for a, b in ((0, 5), (5, 150)):
        alpha = [np.exp(scores[a] + np.log(np.exp(trans).sum(axis=0)))]
        for t in range(a + 1, b):
            v = (alpha[-1] @ np.exp(trans)) * np.exp(scores[t])
            alpha.append(v / v.sum())
        beta = [np.ones(3)]
        for t in range(b - 1, a, -1):
            v = np.exp(trans) @ (np.exp(scores[t]) * beta[-1])
            beta.append(v / v.sum())
        both = np.array(alpha) * np.array(beta[::-1])
        assert np.allclose(found[a:b], both / both.sum(axis=1, keepdims=True), atol=1e-4)


def test_language_of_held_out_documents(results, docs):
    lang = {r.doc_id: r.lang for r in docs}
    held = [r for r in results("op1_language_crf") if r.held_out]
    assert {r.held_out for r in held} == {True}
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    toxic = {r.doc_id: r.toxic for r in table(spark, folder, "labels").collect()}
    rows = [r for r in QUERIES["op5_toxicity_kn"](spark, folder).collect() if r.held_out and r.doc_id in toxic]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in rows]) > 0.9


def test_secrets(results, docs):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    texts = {r.doc_id: r.text or "" for r in docs}
    for r in results("op4_secret_scan"):
        t = texts[r.doc_id]
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        kinds = Counter(k for _, k, _ in spans)
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds[0], kinds[1], kinds[2])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))


def test_licenses(results, docs):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    texts = {r.doc_id: r.text or "" for r in docs}
    for r in results("op8_license_scan"):
        lower = re.sub("[A-Z]+", lambda m: m[0].lower(), texts[r.doc_id])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        at = [(i, v) for p, v in phrases.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert r.base_labels == ",".join(sorted({v for _, v in at}))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}


def test_suppression_matches_pairs():
    assert len(rules()) > 200
    rng = np.random.default_rng(2)
    some = [Rule(f"r{p}", "", re.compile(""), p) for p in (1, 2, 3)]
    found = list({(int(a), int(a + n), some[int(p)]) for a, n, p in zip(rng.integers(0, 40, 60), rng.integers(1, 15, 60), rng.integers(0, 3, 60))})
    inside = lambda d, e: e[0] <= d[0] and d[1] <= e[1] and e != d and (e[2].priority, e[1] - e[0]) > (d[2].priority, d[1] - d[0])
    plain = {d for d in found if not any(inside(d, e) for e in found)}
    equal = {d for d in plain if any(e[:2] == d[:2] and e[2].priority > d[2].priority for e in found)}
    assert set(suppressed(found)) == plain - equal


def test_packing(results, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in results("op6_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for r in docs:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(pieces.pop(r.doc_id), key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert not pieces and sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= SEQUENCE


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(4)
    histogram = dict(Counter(rng.integers(1, SEQUENCE + 1, 5000).tolist()))
    patterns = shortest_pack_first(histogram)
    back = Counter()
    for count, pattern in patterns:
        assert sum(length * n for length, n in pattern) <= SEQUENCE
        for length, n in pattern:
            back[length] += count * n
    assert back == Counter(histogram) and len(patterns) <= 2 * len(histogram)


def test_shards(results, docs):
    rows = results("op7_sharding")
    texts = {r.doc_id: (r.text or "").encode() for r in docs}
    shards = defaultdict(list)
    for r in rows:
        assert r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        shards[r.shard].append(r.slot)
    assert sorted(shards) == list(range(40))
    sizes = [len(s) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    groups = defaultdict(set)
    for r in rows:
        groups[texts[r.doc_id]].add(r.shard)
    split = sum(len(s) > 1 for s in groups.values())
    assert split <= 0.2 * sum(n > 1 for n in Counter(texts.values()).values())


def test_wand_finds_all():
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary, 12)) for _ in range(120)]
    index = build(list(enumerate(texts)))
    for _ in range(40):
        own = np.unique(_hashes(" ".join(rng.choice(vocabulary, 15))))
        terms = np.searchsorted(index.terms, own[np.isin(own, index.terms)])
        plain = np.zeros(len(texts))
        for t in terms:
            part = slice(index.at[t], index.at[t + 1])
            plain[index.docs[part]] += index.impact[part]
        found = dict(block_max_wand(index, terms, 0.4))
        assert set(found) == set(np.flatnonzero(plain >= 0.4 - 1e-9).tolist())


@pytest.mark.parametrize("width, numerator", [(3, 90), (5, 80), (2, 60)])
def test_jaccard_components(spark, width, numerator):
    rng = np.random.default_rng(9)
    rows, base = [], [rng.integers(0, 400, n).tolist() for n in (5, 8, 12, 20, 40, 90, 200, 200)]
    for i in range(240):
        words = list(base[i % len(base)])
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(0, len(words)))] = int(rng.integers(0, 400))
        rows.append((i, " ".join(f"w{w}" for w in words)))
    found = jaccard_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), width, numerator, 100)
    sets = {i: {tuple(t.split()[k : k + width]) for k in range(max(1, len(t.split()) - width + 1))} for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == {i: (len(s), top(i)) for i, s in sets.items()}


def test_small_tables_of_the_join_are_written_in_few_files(spark, monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{w}" for w in rng.integers(0, 4000, 40)) for _ in range(60)]
    rows = [(i, f"{texts[i % 60]} end{i // 60}") for i in range(180)]
    paths, write = [], staging.write_staged
    monkeypatch.setattr(staging, "write_staged", lambda df, name: paths.append((name, write(df, name))) or paths[-1][1])
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {name: len(list(Path(path.removeprefix("file:")).glob("part-*"))) for name, path in paths}
    few = {"edges", "roots", "lists", "sizes", "tried", "links", "mixed", "classes", "kept"}
    assert {f"jaccard-{name}" for name in few} <= set(files)
    assert all(files[f"jaccard-{name}"] == 1 for name in few), files
