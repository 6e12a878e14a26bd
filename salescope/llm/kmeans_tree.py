"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; its nodes are few whatever the table. For the
largest inner product, vectors get one more component that makes all of them equally
long, so the largest product is the smallest distance. Every row goes down the tree to a
leaf. A query visits leaves best bin first: a priority queue holds the nodes seen so far
by the distance of their centres. How many leaves a query visits is calibrated: a bounded
sample of queries is answered exactly, and visits widen until the wanted share of their
neighbours lies in visited leaves.

Equal vectors are one class, scored once, so a vector that a third of all rows share is
one row of the index. Leaves are dealt into cells of bounded size and a cell's queries
into blocks of bounded size; a task scores one block of queries against one cell.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.textops import materialize
from salescope.llm.vectors import MATRIX_ROWS, matrix, packed, unpacked, usable

QUERY_EVERY, NEIGHBOURS = 20, 20
SAMPLE_ROWS = 16_384  # vectors the tree is fitted on
SAMPLE_QUERIES = 384  # queries that calibrate the visits
RECALL = 0.96  # of their neighbours, so that other queries reach 0.9 with room
BRANCHES, LEAF_SAMPLE, LEAF_ROWS = 8, 16, 256
CELL_ROWS, QUERY_ROWS = 8192, 4096
HOT_COPIES = 1000

SAMPLE_BYTES = 32 << 20  # of the sample, if vectors are long

CLASS = "key binary, vector binary, ids array<long>"
ANSWER = "query binary, vec_id long, score double, leaf int"
CELL_NAMES = ["query", "vec_id", "score", "same"]


# ---- the tree -----------------------------------------------------------------


def augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more component; all rows get the squared length ``longest``."""
    rest = np.sqrt(np.maximum(longest - (vectors * vectors).sum(axis=1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres and each point's nearest; a centre without points takes a random one."""
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        nearest = np.argmin((centres * centres).sum(axis=1) - 2 * points @ centres.T, axis=1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres = sums / np.maximum(counts, 1)[:, None]
        centres[counts == 0] = points[rng.choice(len(points), int((counts == 0).sum()))]
    return centres, np.argmin((centres * centres).sum(axis=1) - 2 * points @ centres.T, axis=1)


@dataclass
class Tree:
    """Nodes by number, the root 0; siblings are neighbours, leaves are numbered in order."""

    longest: float
    centres: list[np.ndarray] = field(default_factory=list)
    children: list[range] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    @classmethod
    def fit(cls, vectors: np.ndarray, longest: float, leaves: int, seed: int = 11) -> Tree:
        tree, rng = cls(longest), np.random.default_rng(seed)
        points = augmented(vectors, longest)
        tree._add(points.mean(axis=0))
        tree._grow(0, points, max(LEAF_SAMPLE, -(-len(points) // leaves)), rng)
        return tree

    def _add(self, centre: np.ndarray) -> None:
        self.centres.append(centre)
        self.children.append(range(0))
        self.leaf.append(-1)

    def _grow(self, node: int, points: np.ndarray, bound: int, rng: np.random.Generator) -> None:
        if len(points) > bound:
            centres, nearest = k_means(points, min(BRANCHES, len(points)), rng)
            sizes = np.bincount(nearest, minlength=len(centres))
            if (sizes > 0).sum() > 1:
                used = np.flatnonzero(sizes)
                first = len(self.centres)
                for k in used:
                    self._add(centres[k])
                self.children[node] = range(first, first + len(used))
                for child, k in zip(self.children[node], used):
                    self._grow(child, points[nearest == k], bound, rng)
                return
        self.leaf[node] = self.leaves
        self.leaves += 1

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf each vector reaches through the nearest centre of every level."""
        points, found = augmented(vectors, self.longest), np.empty(len(vectors), np.int32)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if not self.children[node]:
                found[rows] = self.leaf[node]
                continue
            centres = np.array([self.centres[c] for c in self.children[node]])
            nearest = np.argmin((centres * centres).sum(axis=1) - 2 * points[rows] @ centres.T, axis=1)
            for k, child in enumerate(self.children[node]):
                if len(some := rows[nearest == k]):
                    waiting.append((child, some))
        return found

    def best_bins(self, queries: np.ndarray, visits: int) -> Iterator[list[int]]:
        """For each query the first ``visits`` leaves, best bin first."""
        centres = np.array(self.centres)
        # A query's added component is 0: it looks for large products only.
        away = (centres * centres).sum(axis=1) - 2 * queries @ centres[:, :-1].T
        for row in away:
            distance, queue, found = row.tolist(), [(0.0, 0)], []
            while queue and len(found) < visits:
                node = heapq.heappop(queue)[1]
                if not self.children[node]:
                    found.append(self.leaf[node])
                for child in self.children[node]:
                    heapq.heappush(queue, (distance[child], child))
            yield found


# ---- exact scores of a block -----------------------------------------------------


def nearest_rows(
    queries: np.ndarray, vectors: np.ndarray, ids: pa.Array, keep: int, seen: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, id, score) of the ``keep`` best rows of each query, where a vector
    stands for one row per id. ``seen`` marks the pairs that count."""
    each = np.diff(ids.offsets.to_numpy())
    flat, first = ids.values.to_numpy(), ids.offsets.to_numpy()[:-1]
    rough = queries @ vectors.T
    if seen is not None:
        rough[~seen] = -np.inf
    # The product of matrices adds in any order: take all that may be among the best,
    # then add in one fixed order.
    slack = 1e-9 * (1 + np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1])
    found: list[list[np.ndarray]] = [[], [], [], []]
    at = max(0, len(vectors) - keep)
    bound = np.partition(rough, at, axis=1)[:, at] - slack if len(vectors) else np.zeros(len(queries))
    for q in range(len(queries)):
        may = np.flatnonzero((rough[q] >= bound[q]) & (rough[q] > -np.inf))
        exact = (vectors[may] * queries[q]).sum(axis=1)
        n = each[may]
        row = np.repeat(np.arange(len(may)), n)
        id_ = flat[first[may][row] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        best = np.lexsort((id_, -exact[row]))[:keep]
        for k, part in enumerate((np.full(len(best), q), may[row[best]], id_[best], exact[row[best]])):
            found[k].append(part)
    return tuple(np.concatenate(f) if f else np.empty(0, np.int64) for f in found)


def _list_of(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


# ---- the operator -----------------------------------------------------------------


def classes(kept: DataFrame, width: int, kind: type, keep: int) -> tuple[DataFrame, DataFrame]:
    """Written rows (vec_id, key, vector) and classes of equal vectors (key, vector,
    ids): ``ids`` are the ``keep`` smallest, more cannot be asked for."""
    from xxhash import xxh3_128_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, MATRIX_ROWS):
                part = batch.slice(k, MATRIX_ROWS)
                vectors = matrix(part.column("embedding"), width).astype(kind) + kind(0)  # -0.0 is 0.0
                some = vectors.any(axis=1)
                raw = [v.tobytes() for v in vectors[some]]
                key = pa.array([xxh3_128_digest(v) for v in raw], pa.binary())
                ids = part.column("vec_id").filter(pa.array(some))
                yield pa.RecordBatch.from_arrays([ids, key, pa.array(raw, pa.binary())], ["vec_id", "key", "vector"])

    rows = kept.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "vec_id long, key binary, vector binary")
    rows = materialize(rows, "tree-rows")
    named = rows.groupBy("key", "vec_id").agg(F.first("vector").alias("vector"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    smallest = named.withColumn("place", place).where(F.col("place") <= keep)
    each = smallest.groupBy("key").agg(
        F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids")
    )
    return rows, materialize(each, "tree-classes")


def _draw(rows: DataFrame, key: str, count: int, bound: int) -> pa.Table:
    """At most about ``bound`` rows, the same ones on every run."""
    share = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(1 << 30)) < int(min(1.0, bound / max(count, 1)) * (1 << 30))
    return rows.where(share).toArrow()


def _best(answers: DataFrame, keep: int) -> DataFrame:
    over = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("place", F.row_number().over(over)).where(F.col("place") <= keep)


def _exactly(index: DataFrame, queries: pa.Table, width: int, kind: type, keep: int) -> DataFrame:
    """The best rows of a few queries among all classes."""
    vectors = unpacked(queries.column("vector"), width, kind).astype(np.float64)
    keys = queries.column("query").to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, MATRIX_ROWS):
                part = batch.slice(k, MATRIX_ROWS)
                held = unpacked(part.column("vector"), width, kind).astype(np.float64)
                q, v, ids, score = nearest_rows(vectors, held, _list_of(pa.chunked_array([part.column("ids")])), keep)
                arrays = [pa.array([keys[i] for i in q], pa.binary()), pa.array(ids, pa.int64()), pa.array(score, pa.float64())]
                leaf = part.column("leaf").take(pa.array(v, pa.int64()))
                yield pa.RecordBatch.from_arrays([*arrays, leaf], ["query", "vec_id", "score", "leaf"])

    return _best(index.select("vector", "ids", "leaf").mapInArrow(run, ANSWER), keep)


def calibrated_visits(tree: Tree, vectors: np.ndarray, leaves: list[list[int]], recall: float) -> int:
    """The fewest leaves per query that hold the share ``recall`` of the neighbours, each
    given by its leaf."""
    wanted = sum(map(len, leaves))
    met = np.zeros(tree.leaves + 1, np.int64)
    for order, have in zip(tree.best_bins(vectors, tree.leaves), leaves):
        place = {leaf: k for k, leaf in enumerate(order)}
        np.add.at(met, [place[leaf] + 1 for leaf in have], 1)
    visits, held = 1, met[1]
    while held < recall * wanted and visits < tree.leaves:
        visits += 1
        held += met[visits]
    return visits


def _cells(sizes: dict[int, int], leaves: int) -> list[tuple[int, int]]:
    """For every leaf its first cell and over how many it is dealt: small neighbours
    share a cell, a large leaf has several."""
    dealt, cell, load = [], 0, 0
    for leaf in range(leaves):
        size = sizes.get(leaf, 0)
        parts = -(-size // CELL_ROWS)
        if load and load + size > CELL_ROWS:
            cell, load = cell + 1, 0
        dealt.append((cell, max(1, parts)))
        load += size
        if parts > 1:
            cell, load = cell + parts, 0
    return dealt


def _cell_answers(left: pa.Table, right: pa.Table, width: int, kind: type, keep: int) -> pa.Table:
    """``left``: classes of a cell; ``right``: queries with the leaves they visit there."""
    ids, keys = _list_of(left.column("ids")), left.column("key").to_pylist()
    vectors = unpacked(left.column("vector"), width, kind).astype(np.float64)
    there, leaf_at = np.unique(left.column("leaf").to_numpy(), return_inverse=True)
    parts = []
    for k in range(0, right.num_rows, MATRIX_ROWS // 16):
        some = right.slice(k, MATRIX_ROWS // 16)
        visited = np.zeros((some.num_rows, len(there)), bool)
        for i, leaves in enumerate(some.column("leaves").to_pylist()):
            visited[i] = np.isin(there, leaves)
        queries = unpacked(some.column("vector"), width, kind).astype(np.float64)
        q, v, id_, score = nearest_rows(queries, vectors, ids, keep, visited[:, leaf_at])
        names = some.column("query").to_pylist()
        arrays = [
            pa.array([names[i] for i in q], pa.binary()),
            pa.array(id_, pa.int64()),
            pa.array(score, pa.float64()),
            pa.array([names[i] == keys[j] for i, j in zip(q, v)], pa.bool_()),
        ]
        parts.append(pa.table(arrays, ["query", "vec_id", "score", "same"]))
    return pa.concat_tables(parts)


def nearest_neighbours(rows: DataFrame, neighbours: int = NEIGHBOURS, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the neighbours found for each row whose vec_id is
    divisible by 20, by inner product, ties to the smaller vec_id.

    Rows without vec_id or vector, with a component that is null or not finite, and zero
    vectors take no part; shorter vectors count as padded with zeros. Rows that agree in
    vec_id and vector are one row; rows that share a vec_id only are rows of their own,
    and each may be found for the other. An empty table, or one without a query, gives
    no rows.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kept, width = usable(rows, "embedding", "vec_id")
    if not width:
        return empty
    single = rows.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = np.float32 if single else np.float64  # either way the very numbers of the table
    keep = neighbours + 1  # one place more than wanted, for the query itself
    named, each = classes(kept, width, kind, keep)
    wanted = named.where(F.col("vec_id") % QUERY_EVERY == 0)
    asked = wanted.groupBy(F.col("key").alias("query")).agg(F.first("vector").alias("vector"))
    asked = materialize(asked, "tree-queries")
    count, asking = each.count(), asked.count()
    if not asking:
        return empty

    # The tree.
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = kept.agg(F.max(square)).first()[0]
    bound = max(1024, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
    sample = unpacked(_draw(each, "key", count, bound).column("vector"), width, kind).astype(np.float64)
    leaves = max(1, min(count // LEAF_ROWS, bound // LEAF_SAMPLE))
    tree = Tree.fit(sample if len(sample) else np.zeros((1, width)), longest, leaves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, MATRIX_ROWS):
                part = batch.slice(k, MATRIX_ROWS)
                leaf = tree.leaf_of(unpacked(part.column("vector"), width, kind).astype(np.float64))
                yield part.append_column("leaf", pa.array(leaf, pa.int32()))

    index = each.select("key", "vector", "ids").mapInArrow(place, f"{CLASS}, leaf int")
    index = materialize(index, "tree-index")
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}
    dealt = _cells(sizes, tree.leaves)

    # The visits.
    some = _draw(asked, "query", asking, SAMPLE_QUERIES)
    exact: dict[bytes, list[int]] = {}
    for r in _exactly(index, some, width, kind, keep).select("query", "leaf").collect() if some.num_rows else ():
        exact.setdefault(bytes(r["query"]), []).append(r["leaf"])
    probes = unpacked(some.column("vector"), width, kind).astype(np.float64)
    held = [exact.get(q, []) for q in some.column("query").to_pylist()]
    visits = calibrated_visits(tree, probes, held, recall) if held else tree.leaves

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, MATRIX_ROWS // 16):
                part = batch.slice(k, MATRIX_ROWS // 16)
                queries = unpacked(part.column("vector"), width, kind).astype(np.float64)
                at, cells, seen = [], [], []
                for i, order in enumerate(tree.best_bins(queries, visits)):
                    here: dict[int, list[int]] = {}
                    for leaf in order:
                        first, parts = dealt[leaf]
                        for cell in range(first, first + parts):
                            here.setdefault(cell, []).append(leaf)
                    at += [i] * len(here)
                    cells += here
                    seen += here.values()
                arrays = [c.take(pa.array(at, pa.int64())) for c in part.columns]
                arrays += [pa.array(cells, pa.int64()), pa.array(seen, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names, "cell", "leaves"])

    visited = asked.select("query", "vector").mapInArrow(visit, "query binary, vector binary, cell long, leaves array<int>")
    visited = materialize(visited, "tree-visits")
    parts = visited.groupBy("cell").agg(F.ceil(F.count("cell") / QUERY_ROWS).cast("int").alias("parts"))
    parts = materialize(parts, "tree-parts")
    cells = spark.createDataFrame([(i, *c) for i, c in enumerate(dealt)], "leaf int, first long, over int")
    cell = F.col("first") + F.pmod(F.xxhash64("key"), F.col("over"))
    placed = index.join(F.broadcast(cells), "leaf").select("key", "vector", "ids", "leaf", cell.alias("cell"))
    placed = placed.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asking_at = visited.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("query"), F.col("parts")).cast("int"))
    left = placed.select("cell", "part", "key", "vector", "ids", "leaf").groupBy("cell", "part")
    right = asking_at.select("cell", "part", "query", "vector", "leaves").groupBy("cell", "part")

    def score(one: pa.Table, two: pa.Table) -> pa.Table:
        if one.num_rows and two.num_rows:
            return _cell_answers(one, two, width, kind, keep)
        return pa.table([pa.array([], t) for t in (pa.binary(), pa.int64(), pa.float64(), pa.bool_())], CELL_NAMES)

    answers = left.cogroup(right).applyInArrow(score, "query binary, vec_id long, score double, same boolean")
    lists = _best(answers, keep).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "same"))).alias("best")
    )
    lists = materialize(lists, "tree-lists")

    # Back to the rows that asked. Vectors that very many rows share are few.
    wanted = wanted.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query")).distinct()
    often = F.col("count") > F.greatest(F.lit(HOT_COPIES), F.lit(count // HOT_COPIES))
    hot = materialize(wanted.groupBy("query").count().where(often).select("query"), "tree-hot")
    few = F.broadcast(lists.join(F.broadcast(hot), "query"))
    asked_and_found = wanted.join(few, "query").unionByName(
        wanted.join(F.broadcast(hot), "query", "left_anti").join(lists, "query")
    )
    others = F.filter("best", lambda x: ~(x["same"] & (x["vec_id"] == F.col("query_id"))))
    found = asked_and_found.select("query_id", F.posexplode(F.slice(others, 1, neighbours)).alias("at", "one"))
    return found.select("query_id", (F.col("at") + 1).alias("rank"), "one.vec_id", "one.score")
