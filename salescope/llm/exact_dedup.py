"""Exact dedup by a heavy-hitter split.

Misra-Gries (``freqItems``: at most 1/support counters in each task, merged) names
every digest that more than ``support`` of all rows share. A second count verifies
them and finds their winners: at most 1/support rows, broadcast, so rows of large
groups never enter a shuffle. All other digests are shuffled in the ordinary way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import materialize, slim

DROPPED_CHARACTERS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SUPPORT = 0.001


def normalised(text: Column) -> Column:
    """The text without blanks, tabs and line ends; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for c in DROPPED_CHARACTERS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _winners(rows: DataFrame) -> DataFrame:
    """One row per digest: the longest original, then the smallest id (null last),
    then the first of equal rows."""
    best = F.min(F.struct(-F.col("_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row")))
    return rows.groupBy("_digest").agg(best.alias("_best"), F.count(F.lit(1)).alias("group_size"))


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256,
    n_chars`` (code points of the original).

    Null and empty texts form one group. Rows that agree in id and text are separate
    members, one of which stays. A null id sorts after all others; if its row stays,
    ``keep_id`` is null. An empty table gives an empty result.
    """
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    rows = slim(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(F.coalesce("text", F.lit(""))).alias("_chars"),
        digest.alias("_digest"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = materialize(rows, "exact-digests")
    # A few counters per task, merged to one list of at most 1/support digests.
    frequent = rows.select(F.col("_digest").alias("d")).freqItems(["d"], support)
    frequent = frequent.select(F.explode("d_freqItems").alias("_digest"))
    counted = _winners(rows.join(F.broadcast(frequent), "_digest", "left_semi"))
    heavy = materialize(counted.where(F.col("group_size") > 1), "exact-heavy")
    map_side = rows.join(F.broadcast(heavy), "_digest")
    rest = rows.join(F.broadcast(heavy.select("_digest")), "_digest", "left_anti")
    shuffled = rest.join(_winners(rest).hint("shuffle_hash"), "_digest")
    return map_side.unionByName(shuffled).select(
        "doc_id",
        F.col("_best.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("_best._row") == F.col("_row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
        F.col("_chars").cast("long").alias("n_chars"),
    )


def drop_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``docs`` with one row of each group of equal texts, chosen as above.

    Every text meets the short list of winners once, in one shuffle by id, digest and
    length; rows equal in all three are repeats, and one of them stays.
    """
    key = ["_key", "_digest", "_chars"]
    id_text = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("none"))
    winners = exact_groups(docs, support).where("kept")
    winners = winners.select(
        id_text.alias("_key"), F.unhex("text_sha256").alias("_digest"), F.col("n_chars").alias("_chars")
    )
    keyed = docs.withColumns(
        {
            "_key": id_text,
            "_digest": F.unhex(F.sha2(normalised(F.col("text")), 256)),
            "_chars": F.char_length(F.coalesce("text", F.lit(""))).cast("long"),
        }
    )
    return keyed.join(winners, key, "left_semi").dropDuplicates(key).select(*docs.columns)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept,
       h AS text_sha256, n AS n_chars
FROM t
"""
