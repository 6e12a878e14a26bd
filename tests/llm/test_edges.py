"""Every operator on nulls, empty tables, repeated rows, long texts and clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salescope.llm import jaccard_join
from salescope.llm.bm25_leaks import drop_leaking, find_leaks
from salescope.llm.exact_dedup import drop_copies, exact_groups
from salescope.llm.jaccard_join import similar_components
from salescope.llm.language_crf import identify, keep_identified
from salescope.llm.license_rules import scan_licenses
from salescope.llm.line_chunks import drop_repeated_chunks
from salescope.llm.packing import pack
from salescope.llm.secret_tokens import IDENTIFIER, find_secrets
from salescope.llm.sharding import balanced_shards
from salescope.llm.toxicity_kn import score_toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, hash long, n long, key string"
PIPE = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Rows of (doc_id, text, lang), with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, g, None, None, 7, 7, 7, "x") for i, t, g in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    en = ["the", "thing", "over", "house", "water", "under", "light", "stone", "where", "there"]
    de = ["der", "schein", "und", "nicht", "zeit", "auch", "wasser", "licht", "schule", "ganz"]
    rows = []
    for i in range(60):
        pool, lang = ((en, "en"), (de, "de"))[i % 2]
        lines = [" ".join(rng.choice(pool) + rng.choice(["", "s", "en"]) for _ in range(9)) for _ in range(6)]
        rows.append((i, "\n".join(lines), lang))
    rows += [(100, rows[4][1], "en"), (101, rows[4][1] + " ", "en"), (102, rows[4][1], None)]
    rows += [(103, None, None), (104, "", "en"), (105, " \n\t", "en"), (106, "12 ..!", "de"), (107, "one", "en")]
    rows += [(None, rows[6][1], "en"), (None, None, None), (5, rows[5][1], "de"), (5, rows[5][1], "de")]
    rows.append((108, "long text here " * 20_000, "en"))
    return rows


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 3 == 0) for i in range(60)] + [(None, True), (3, None)], "doc_id long, toxic boolean")


@pytest.fixture(scope="module")
def items(spark, corpus):
    rows = [(1, corpus[8][1]), (2, None), (3, ""), (None, "never seen words stand here. nor these ones do.")]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(labels, items):
    return {
        "language": identify,
        "exact": exact_groups,
        "lines": drop_repeated_chunks,
        "secrets": find_secrets,
        "toxicity": lambda d: score_toxicity(d, labels),
        "packing": pack,
        "sharding": lambda d: balanced_shards(d, 4),
        "licenses": scan_licenses,
        "jaccard": similar_components,
    }


def test_every_row_has_a_result_and_empty_tables_have_none(spark, corpus, labels, items):
    docs = frame(spark, corpus)
    for name, operator in operators(labels, items).items():
        found = operator(docs).collect()
        ids = sorted(str(r.doc_id) for r in found if name != "packing" or r.start == 0)
        assert ids == sorted(str(i) for i, _, _ in corpus), name
        assert operator(frame(spark, [])).count() == 0, name


def test_leaks(spark, corpus, items):
    docs = frame(spark, corpus)
    found = find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(8, 1)}
    assert find_leaks(frame(spark, []), items).count() == 0
    assert find_leaks(docs, items.where("false")).count() == 0
    kept = drop_leaking(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1


def test_stages_keep_columns_and_clean_rows(spark, corpus, items):
    docs = frame(spark, corpus)
    kept = keep_identified(docs)
    gone = sorted(str(r.doc_id) for r in docs.exceptAll(kept).collect())
    assert kept.columns == docs.columns and gone == ["103", "104", "105", "106", "None"]
    once = drop_copies(docs)
    assert once.columns == docs.columns
    texts = ["".join((t or "").split()) for _, t, _ in corpus]
    assert once.count() == len(set(texts))
    assert {101} == {r.doc_id for r in once.collect() if (r.text or "").strip() == corpus[4][1]}
    one = jaccard_join.keep_one(docs)
    assert one.columns == docs.columns
    assert [r.doc_id for r in one.collect()].count(5) == 1


def test_pipeline_runs_on_odd_rows_and_on_nothing(spark, tmp_path, corpus, items):
    for name, rows in (("full", corpus), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame([(i, t, g, "s", 1) for i, t, g in rows], PIPE).write.parquet(f"{folder}/documents.parquet")
        items.write.parquet(f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, folder).collect()
        ids = {r.doc_id for r in found}
        if rows:
            assert {0, 1, 2, 3, 107, 108} <= ids and not {8, 103, 104, 105, 106} & ids
        else:
            assert not ids


def test_two_groups_of_repeats_never_share_a_key(spark):
    """Rows that share an id but not a text are judged one by one."""
    docs = frame(spark, [(1, "a b c d e f g h", "en"), (1, "p q r s t u v w", "en"), (2, "p q r s t u v w", "en")])
    assert jaccard_join.keep_one(docs).count() == 2
    assert drop_copies(docs).count() == 2
    assert exact_groups(docs).agg(F.sum(F.col("kept").cast("int"))).first()[0] == 2


def test_long_separator_rows_are_no_trap():
    """A row of separators before a piece that fails is matched in linear time."""
    assert not IDENTIFIER.match("abc1" + "-" * 5000 + "a1b2")
    assert IDENTIFIER.match("abc1" + "-=/" * 2000 + "Word22__")
