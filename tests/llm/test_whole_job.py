"""Whole passages, keys, texts and groups, which a shortcut of an operator could miss."""

from __future__ import annotations

import random
import string
from collections import Counter
from re import _parser

import pytest

from salescope.llm.license_rules import Scanner, rules, suppressed
from salescope.llm.packing import Ids, pack_ids
from salescope.llm.secret_tokens import load_encoder, scan
from salescope.llm.sharding import balanced_shards


def written(tree, rng, space, c):
    """A text that the parsed pattern matches, with the given white space and c or s in licen[sc]e."""
    out = []
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name in ("ANY", "NOT_LITERAL"):
            out.append("x")
        elif name == "IN":
            kinds = [(str(k), v) for k, v in arg]
            if ("CATEGORY", _parser.CATEGORY_SPACE) in kinds:
                out.append(space)
            elif kinds[0][0] == "LITERAL":
                out.append(c if {("LITERAL", 99), ("LITERAL", 115)} == set(kinds) else chr(rng.choice([v for k, v in kinds if k == "LITERAL"])))
            elif kinds[0][0] == "RANGE":
                out.append(chr(kinds[0][1][0]))
            else:
                out.append("1" if kinds[0] == ("CATEGORY", _parser.CATEGORY_DIGIT) else "x")
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            out += [written(inner, rng, space, c) for _ in range(rng.randint(low, max(low, min(int(high), low + 1))))]
        elif name == "SUBPATTERN":
            out.append(written(arg[3], rng, space, c))
        elif name == "BRANCH":
            out.append(written(rng.choice(arg[1]), rng, space, c))
    return "".join(out)


def test_keywords_leave_out_no_rule_that_matches():
    """Filtered and unfiltered scans agree on every rule's texts: wrapped, doubly spaced, both spellings."""
    rng, scanner, every, matched = random.Random(8), Scanner(), rules(), set()
    for rule in every:
        tree = _parser.parse(rule.pattern.pattern)
        for space in (" ", "\n", "  ", "\n    ", "\u00a0", "\t"):
            for c in "cs":
                text = f"({written(tree, rng, space, c)}) "
                plain = [(m.start(), m.end(), r) for r in every for m in r.pattern.finditer(text)]
                matched |= {r for *_, r in plain}
                assert scanner.detections(text) == suppressed(plain), text
    assert matched == set(every)
    labels = lambda t: {r.label for *_, r in scanner.detections(t)}
    assert labels("the gnu general\n    public licence, version 2") == {"gpl-2.0"}
    assert labels("creative commons attribution-non-commercial") == {"cc-by-nc"}


def test_ids_of_texts_with_other_punctuation_are_the_tokenizers():
    import public_tokenizers

    ids = Ids(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["\u201cHello,\u201d she said", "done!\U0001f389 yes", "price (\u20ac5)", "wait.\u2026", "a \u2014, b", "x =\u0338 y", "a=\u0338b", "e\u0301. \u00e9.x", "", " . ", "a\x00.b", "a\x1c.\x1cb", "a\x85.b"]
    rng = random.Random(6)
    signs = [*"abZ09 .,!?=()-<|>\n\t", *"\u201c\u201d\u2026\u2014\u20ac\u00e9\u0338\u0301\u00a0\u3000\u200d\U0001f389\u4e2d", "\x00", "\x0b", "\x1f", "\x85", "the ", "don't "]
    texts += ["".join(rng.choices(signs, k=rng.randint(1, 14))) for _ in range(20_000)]
    plain = ids.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    for text, found, one in zip(texts, ids.of([t.encode() for t in texts]), plain):
        assert found == pack_ids(one.ids), repr(text)


def test_random_keys_of_letters_are_dense_and_words_are_not():
    import public_tokenizers

    tokens = load_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    dense = lambda run: [(a, b) for a, k, b in scan(f"see {run} here", tokens) if k == 3]
    assert dense("qZkVbNmLpWqRtYsDfGhJkXcV") == [(4, 28)]
    rng = random.Random(4)
    for letters in (string.ascii_letters, string.ascii_lowercase, string.ascii_uppercase):
        keys = ["".join(rng.choices(letters, k=28)) for _ in range(200)]
        assert sum(dense(k) == [(4, 32)] for k in keys) >= 198
        assert sum(dense(k + "4711") == [(4, 36)] for k in keys) >= 198
        assert sum(bool(dense("-".join(k[i : i + 7] for i in range(0, 28, 7)))) for k in keys) >= 190
    plain = "antidisestablishmentarianism Rechtsschutzversicherungsgesellschaften anticonstitutionnellement"
    plain += " getUserAccountByIdentifier get_id_of_user_in_db_2 2024-01-02-03-04-05 a-b-c-d-e-f-g-h-i-j-k"
    plain += " ------------------------ =_=-=_=-=_=-=_=-=_=-=_= 123e4567-e89b-12d3-a456-426614174000"
    plain += " d41d8cd98f00b204e9800998ecf8427e src/main/resources/config_v2/README"
    assert not [w for w in plain.split() if dense(w)]


def test_a_group_of_a_third_of_all_rows_fills_few_shards(spark):
    """Its 1000 rows need 7 of 20 shards of 150; by hash all 20 hold about 50 of them."""
    rows = [(i, "hot" if i % 3 == 0 else f"pair {i // 6}" if i % 3 == 1 and i < 1200 else f"one {i}") for i in range(3000)]
    found = balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()
    assert set(Counter(r.shard for r in found).values()) == {150}
    hot = Counter(r.shard for r in found if r.doc_id % 3 == 0)
    # Rows of the group that an average row of it meets in its shard.
    assert sum(n * n for n in hot.values()) / 1000 >= 100


@pytest.mark.parametrize("members", [2, 10])
def test_full_shards_exchange_members(spark, members):
    """All rows are linked, so no shard has free room; dealt by chance 97.5 % of pairs are cut."""
    rows = [(i, f"t{i // members}") for i in range(4000)]
    found = balanced_shards(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()
    assert set(Counter(r.shard for r in found).values()) == {100}
    assert len({(r.shard, r.slot) for r in found}) == 4000 and {r.slot for r in found} == set(range(100))
    groups = {}
    for r in found:
        groups.setdefault(r.doc_id // members, Counter())[r.shard] += 1
    together = sum(n * (n - 1) for shards in groups.values() for n in shards.values())
    assert together > 0.98 * 4000 * (members - 1)
