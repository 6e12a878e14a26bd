"""Hard-negative mining with exact scores by the method of the Four Russians.

Every component becomes ``floor(256 * x)``. A row is stored as bit planes (two's
complement): one byte holds one bit of eight neighbouring dimensions. For an anchor, a
table per group of eight dimensions holds the sums of all 256 subsets of its components.
A plane's byte of a candidate is an index into that table; the looked-up sums of all
groups, shifted by the plane and added up, are the full integer inner product.

Anchors and candidates are dealt into blocks by a hash of the row; a cell is a block of
anchors with a block of candidates, scored by one task in bounded memory. Each cell
keeps the best few rows of an anchor only, so what meets in the end is small. First the
positives are found, then the negatives inside every positive's range of scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.textops import materialize
from salescope.llm.vectors import MATRIX_ROWS, matrix, packed, unpacked, usable

SCALE = 256
RELABEL_EVERY, LABELS = 7, 10
ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOWEST, HIGHEST = 30, 90  # per cent of the positive's score

ANCHOR_BLOCK = 1024
CANDIDATE_BLOCK = 4096
TABLE_ANCHORS = 64  # anchors whose tables are in use at once: half a megabyte
# A score and a place within a block share 63 bits.
SCORE_BITS, PLACE_BITS = 50, 13

ROWS = "vec_id long, label int, planes binary"
POSITIVE = "anchor long, anchor_id long, positive_id long, positive_row long, positive_score long"
NEGATIVE = f"{POSITIVE}, negative_id long, negative_row long, negative_score long"


# ---- bit planes and tables ---------------------------------------------------


def to_planes(numbers: np.ndarray, bits: int) -> np.ndarray:
    """(rows, dims) integers as (rows, bits, dims / 8) bytes, lowest plane first."""
    rows, dims = numbers.shape
    padded = np.zeros((rows, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = numbers
    planes = (padded[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")


def from_planes(planes: np.ndarray) -> np.ndarray:
    """The integers of :func:`to_planes`; the top plane counts negative."""
    bits = planes.shape[1]
    weights = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    weights[-1] = -weights[-1]
    unpacked_bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    return np.tensordot(unpacked_bits, weights, ([1], [0]))


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): the sum of each anchor's components over every subset of
    a group's eight dimensions."""
    count, dims = anchors.shape
    groups = anchors.reshape(count, dims // 8, 8).transpose(1, 2, 0).astype(kind)
    table = np.zeros((dims // 8, 256, count), kind)
    for bit in range(8):  # subsets with this highest member extend all smaller ones
        table[:, 1 << bit : 2 << bit] = table[:, : 1 << bit] + groups[:, bit : bit + 1]
    return table


def scores(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): the inner products, by lookups, shifts and additions."""
    total = np.zeros((len(planes), table.shape[2]), np.int64)
    part = np.empty((len(planes), table.shape[2]), table.dtype)
    looked = np.empty_like(part)
    top = planes.shape[1] - 1
    for plane in range(top, -1, -1):
        np.take(table[0], planes[:, plane, 0], axis=0, out=part, mode="clip")
        for group in range(1, len(table)):
            np.take(table[group], planes[:, plane, group], axis=0, out=looked, mode="clip")
            part += looked
        total = -part.astype(np.int64) if plane == top else (total << 1) + part
    return total


# ---- one cell -----------------------------------------------------------------


class Cell:
    """A block of candidates, ready to be scored against blocks of anchors."""

    def __init__(self, candidates: pa.Table, bits: int, groups: int):
        # Places fall with the id, so that of equal scores the smaller id is larger.
        ids, rows = (candidates.column(f"candidate_{c}").to_numpy() for c in ("vec_id", "row"))
        order = np.lexsort((rows, ids))[::-1]
        taken = candidates.take(pa.array(order))
        self.ids, self.rows = ids[order], rows[order]
        self.labels = taken.column("candidate_label").to_numpy()
        planes = unpacked(taken.column("candidate_planes"), bits * groups, np.uint8)
        self.planes = planes.reshape(-1, bits, groups)

    def ranked(self, table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """(anchors, candidates) keys in ascending order: score, then place; what is not
        wanted comes first, as the smallest number."""
        parts = [scores(table, self.planes[k : k + 1024]) for k in range(0, len(self.planes), 1024)]
        keys = (np.concatenate(parts).T << PLACE_BITS) + np.arange(len(self.planes))
        keys[~wanted] = np.iinfo(np.int64).min
        keys.sort(axis=1)
        return keys


def _blocks(anchors: pa.Table, bits: int, groups: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    for k in range(0, anchors.num_rows, TABLE_ANCHORS):
        some = anchors.slice(k, TABLE_ANCHORS)
        yield some, from_planes(unpacked(some.column("planes"), bits * groups, np.uint8).reshape(-1, bits, groups))


def _split(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return key >> PLACE_BITS, key & ((1 << PLACE_BITS) - 1)


def _positives(anchors: pa.Table, cell: Cell, bits: int, groups: int, kind: type) -> list[tuple]:
    found = []
    anchors = anchors.sort_by("label")  # few labels among the anchors of one table
    for some, numbers in _blocks(anchors, bits, groups):
        labels, own = some.column("label").to_numpy(), some.column("row").to_numpy()
        ids = some.column("vec_id").to_numpy()
        at = np.flatnonzero(np.isin(cell.labels, labels))
        if not len(at):
            continue
        part = Cell.__new__(Cell)
        part.ids, part.rows, part.labels, part.planes = (x[at] for x in (cell.ids, cell.rows, cell.labels, cell.planes))
        wanted = (labels[:, None] == part.labels) & (own[:, None] != part.rows)
        best = part.ranked(subset_sums(numbers, kind), wanted)[:, ::-1][:, :POSITIVES]
        counts = np.minimum(wanted.sum(axis=1), POSITIVES)
        for i, n in enumerate(counts.tolist()):
            score, place = _split(best[i, :n])
            for s, p in zip(score.tolist(), place.tolist()):
                found.append((int(own[i]), int(ids[i]), int(part.ids[p]), int(part.rows[p]), s))
    return found


def _negatives(pairs: pa.Table, cell: Cell, bits: int, groups: int, kind: type) -> list[tuple]:
    """``pairs``: anchors repeated with each of their positives."""
    found = []
    pairs = pairs.sort_by("row")
    own = pairs.column("row").to_numpy()
    firsts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    ends = dict(zip(firsts.tolist(), [*firsts[1:].tolist(), len(own)]))
    positive = [pairs.column(c).to_pylist() for c in ("positive_id", "positive_row", "positive_score")]
    anchors = pairs.take(pa.array(firsts)).append_column("first", pa.array(firsts))
    for some, numbers in _blocks(anchors, bits, groups):
        labels, ids = some.column("label").to_numpy(), some.column("vec_id").to_pylist()
        wanted = labels[:, None] != cell.labels
        keys = cell.ranked(subset_sums(numbers, kind), wanted)
        for i, first in enumerate(some.column("first").to_pylist()):
            for k in range(first, ends[first]):
                score = positive[2][k]
                low, high = -(-LOWEST * score // 100), HIGHEST * score // 100
                if low > high:
                    continue
                after = int(np.searchsorted(keys[i], (high + 1) << PLACE_BITS))
                start = max(after - NEGATIVES, int(np.searchsorted(keys[i], low << PLACE_BITS)))
                head = (int(own[first]), ids[i], positive[0][k], positive[1][k], score)
                got, place = _split(keys[i, start:after])
                found += [(*head, int(cell.ids[p]), int(cell.rows[p]), s) for s, p in zip(got.tolist(), place.tolist())]
    return found


# ---- the operator ---------------------------------------------------------------


def quantized(rows: DataFrame) -> tuple[DataFrame, int, int, type]:
    """Written rows (row, vec_id, label, planes), the number of planes and of groups of
    eight dimensions, and the integers that hold a table's sums."""
    kept, width = usable(rows, "embedding", "vec_id", "label")
    whole = F.transform("embedding", lambda x: F.abs(F.floor(x.cast("double") * SCALE)))
    largest = kept.agg(F.max(F.array_max(whole))).first()[0] or 0
    if (largest * largest * max(width, 1)).bit_length() > SCORE_BITS:
        raise ValueError(f"components reach {largest / SCALE}: scores would leave {SCORE_BITS} bits")
    bits, groups = int(largest).bit_length() + 1, max(1, -(-width // 8))
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    kept = kept.select(F.col("vec_id").cast("long"), label.cast("int").alias("label"), "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, MATRIX_ROWS):
                part = batch.slice(k, MATRIX_ROWS)
                numbers = np.floor(matrix(part.column("embedding"), width) * SCALE).astype(np.int64)
                planes = to_planes(numbers, bits).reshape(part.num_rows, -1) if width else np.zeros((part.num_rows, bits), np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), packed(planes)], ["vec_id", "label", "planes"]
                )

    each = kept.mapInArrow(run, ROWS).dropDuplicates()
    each = materialize(each.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    return each, bits, groups, np.int32 if 8 * largest * groups < 1 << 31 else np.int64


def mine_negatives(rows: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows without vec_id, label or vector, or with a component that is null or not finite,
    take no part; shorter vectors count as padded with zeros. Rows that agree in vec_id,
    label and floored vector are one row; rows that share a vec_id but differ otherwise
    are rows of their own, each an anchor with positives and negatives of its own if the
    id says so (of equal score and id, in no stated order). Ties go to the smaller vec_id.
    An empty table, or one without an anchor, gives no rows. Scores must fit 50 bits
    (components up to some 16,000 with 64 dimensions); larger ones raise an error.
    """
    each, bits, groups, kind = quantized(rows)
    is_anchor = F.col("vec_id") % ANCHOR_EVERY == 0
    counts = each.agg(F.count("row").alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    anchor_blocks = counts["anchors"] // ANCHOR_BLOCK + 1
    candidate_blocks = counts["rows"] // CANDIDATE_BLOCK * 2 + 1  # half full, so that none holds 2^13

    def numbered(blocks: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    anchor_block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(anchor_blocks)).cast("int")
    candidate_block = F.pmod(F.xxhash64("row"), F.lit(candidate_blocks)).cast("int")
    # Other names: both sides of a cell come from one table.
    candidates = each.select(
        *[F.col(c).alias(f"candidate_{c}") for c in each.columns],
        candidate_block.alias("cb"),
        numbered(anchor_blocks).alias("ab"),
    )
    candidates = candidates.groupBy("ab", "cb")
    anchors = each.where(is_anchor)

    def cells(of: DataFrame, score, schema: str) -> DataFrame:
        names = [f.split()[0] for f in schema.split(", ")]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            found = score(left, Cell(right, bits, groups), bits, groups, kind) if left.num_rows and right.num_rows else []
            columns = list(zip(*found)) if found else [[]] * len(names)
            return pa.table([pa.array(c, pa.int64()) for c in columns], names)

        dealt = of.select("*", anchor_block.alias("ab"), numbered(candidate_blocks).alias("cb"))
        return dealt.groupBy("ab", "cb").cogroup(candidates).applyInArrow(run, schema)

    # The best of a cell are among the anchor's best, or nothing is.
    first = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    positives = cells(anchors, _positives, POSITIVE).withColumn("place", F.row_number().over(first))
    positives = positives.where(F.col("place") <= POSITIVES).drop("place")
    found = positives.withColumnRenamed("anchor", "row").drop("anchor_id")
    with_positives = materialize(anchors.join(found, "row"), "negatives-positives")
    pair = Window.partitionBy("anchor", "positive_row").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    negatives = cells(with_positives, _negatives, NEGATIVE).withColumn("rank", F.row_number().over(pair))
    return negatives.where(F.col("rank") <= NEGATIVES).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


ORACLE_SQL = f"""
WITH whole AS (
    SELECT DISTINCT
        vec_id,
        CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
        [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
rows AS (SELECT *, row_number() OVER (ORDER BY vec_id) AS r FROM whole),
scored AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.r <> b.r
),
positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= {POSITIVES}
),
mined AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
           p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
     AND {LOWEST} * p.score <= 100 * n.score AND 100 * n.score <= {HIGHEST} * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM mined WHERE rank <= {NEGATIVES}
"""
