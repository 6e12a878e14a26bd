"""Line dedup against plain Python that shares no code with the operator."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from salescope.llm.line_chunks import drop_repeated_chunks, line_table, pairs
from salescope.llm.queries import QUERIES, table

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string"


def plain_lines(raw: bytes):
    """(begin, end, words' bytes) of each line with a word; blank lines belong to the one before."""
    found, at = [], 0
    for line in raw.split(b"\n"):
        words = list(WORD.finditer(line))
        for k in range(0, len(words), 50):
            some = words[k : k + 50]
            found.append((at if k == 0 else at + some[0].start(), line[some[0].start() : some[-1].end()]))
        at += len(line) + 1
    begins = [b for b, _ in found]
    begins[:1] = [0] * bool(begins)
    return [(b, e, words) for b, e, (_, words) in zip(begins, [*begins[1:], len(raw)], found)]


def plain(rows):
    """{doc_id: (text, lines, removed lines)}, for different ids that are not null."""
    lines = {i: plain_lines((t or "").encode()) for i, t in rows}
    first, count = {}, defaultdict(int)
    for i in sorted(lines):
        for x, y in zip(lines[i], lines[i][1:]):
            first.setdefault((x[2], y[2]), i)
            count[x[2], y[2]] += 1
    out = {}
    for i, t in rows:
        raw, met, gone = (t or "").encode(), set(), set()
        for k, pair in enumerate(zip([x[2] for x in lines[i]], [x[2] for x in lines[i]][1:])):
            if first[pair] != i or pair in met:
                gone |= {k, k + 1}
            met.add(pair)
        kept = b"".join(raw[b:e] for k, (b, e, _) in enumerate(lines[i]) if k not in gone).decode()
        out[i] = (kept if lines[i] else t, len(lines[i]), len(gone))
    return out


def compare(found, rows):
    assert {r.doc_id: (r.text, r.n_lines, r.removed_lines) for r in found} == plain(rows)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in table(spark, f"/root/testdata/{folder}", "documents").collect()]
    compare(QUERIES["op3_line_chunks"](spark, f"/root/testdata/{folder}").collect(), rows)


def test_odd_texts(spark):
    rng, signs = random.Random(8), ["a", "b", "a", "\n", "\n", " ", "\r\n", "\t", "é", "c " * 60, "", " "]
    rows = [(i, "".join(rng.choices(signs, k=rng.randint(0, 14)))) for i in range(400)] + [(400, None), (401, "\n\n")]
    compare(drop_repeated_chunks(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect(), rows)


def test_passages_are_removed_whole_and_lone_lines_stay(spark):
    """Passages of over 50 words on one to four lines, amid lines of their own."""
    rng = random.Random(5)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [[line(60 // k + 1) for _ in range(k)] for k in (1, 1, 2, 2, 3, 4)]
    rows = []
    for i in range(40):
        around = [[line(rng.randint(1, 30)) for _ in range(rng.randint(1, 4))] for _ in range(2)]
        around[0].insert(0, "return to main page")
        rows.append((i, "\n".join(around[0] + passages[i % 6] + around[1])))
    found = drop_repeated_chunks(spark.createDataFrame(rows, SCHEMA)).collect()
    compare(found, rows)
    for r in found:
        assert r.text.startswith("return to main page\n")
        assert all((x in r.text) == (r.doc_id < 6 and r.doc_id % 6 == k) for k, p in enumerate(passages) for x in p)
        assert r.removed_chunks == (r.doc_id >= 6)


def test_every_line_stays_somewhere(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choices("abcde", k=rng.randint(1, 12)))) for i in range(200)]
    found = drop_repeated_chunks(spark.createDataFrame(rows, SCHEMA)).collect()
    compare(found, rows)
    assert set("".join(r.text for r in found)) >= set("abcde")


def test_rows_of_one_id_or_none_lose_nothing_to_each_other(spark):
    text = "one line\nanother line\nand more"
    rows = [(7, text), (7, text), (7, text + "\nx"), (9, text), (None, text), (None, "y\n" + text)]
    found = drop_repeated_chunks(spark.createDataFrame(rows, SCHEMA)).collect()
    kept = sorted((str(r.doc_id), r.text) for r in found)
    assert kept == sorted([("7", text), ("7", text), ("7", text + "\nx"), ("9", ""), ("None", ""), ("None", "y\n")])
    only = [(None, text), (None, text + "\nz")]
    assert sorted(r.text for r in drop_repeated_chunks(spark.createDataFrame(only, SCHEMA)).collect()) == [text, text + "\nz"]


def test_boundaries_resist_shifts():
    lines = [f"line {i} of many" for i in range(200)]

    def rolling(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        row, _, _, _, hashes = line_table(raw, np.array([0, len(raw)]))
        return pairs(row, hashes)[1].tolist()

    assert rolling("\n".join(["new", *lines]))[1:] == rolling("\n".join(lines))
