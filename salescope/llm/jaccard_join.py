"""N-gram Jaccard join: exact, size-aware, heavy and light sets apart.

A document's set holds the hashes of its distinct word shingles; equal sets form one
class, and only classes are joined. Shingles are ordered from rare to common by a
counting sketch over all documents (a fixed table: any order gives the same result).
Of two sets that are similar enough, the first elements of each must meet:

- small sets enumerate subsets of two among their first elements: many signatures,
  each shared by few sets,
- large sets enter the inverted lists of their first elements, which are scanned,
- the size between the two is where, by the sketch's estimate, subsets begin to cost
  more than lists. Sets near it do both, so no pair falls between.

A list is not expanded into all its pairs. Its centre is compared with every member (one
pair a member); links found are joined to components; then only
members of one list that are still in different components are compared. Every pair of
classes that shares a signature is thus compared or known to be connected. Before two
whole sets meet, their sizes and a table of parities must allow enough common elements.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import LOWER, SPACE_WORD, SpanHash, blocks, fewer_files, materialize, mixed, shingles, slim, word_spans

WIDTH, NUMERATOR, DENOMINATOR = 3, 90, 100
SKETCH_SLOTS = 1 << 22
SKETCH_PARTS = 64
MOST_COUNTED = 255  # of a counter in one task; beyond it a shingle is common anyway
FILTER_BITS = 1 << 25
MOST_BITS = 1 << 14
SUBSET = 2
REMEMBERED = 500_000
WIDE_ROWS = 1_000  # of sets or texts, below which no task is made for them
LIST_SALT, SUBSET_SALT = np.uint64(0x51ED270B9F3C6A11), np.uint64(0xA24BAED4963EE407)


def document_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each row."""
    lower = LOWER[data]
    starts, ends, first = word_spans(lower, offsets, SPACE_WORD)
    found, at = shingles(SpanHash(lower).of(starts, ends), first, width)
    for a, b in zip(at, at[1:]):
        yield np.unique(found[a:b])


def class_of(grams: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def least_overlap(n: int, numerator: int, denominator: int) -> int:
    """The fewest elements that a set of n shares with any set similar enough."""
    return -(-numerator * n // denominator)


def parity(grams: np.ndarray) -> bytes:
    """Parities of the elements' counts over about as many slots as elements."""
    bits = min(max(64, 1 << int(len(grams) - 1).bit_length()), MOST_BITS)
    counts = np.bincount(((grams >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def most_overlap(na: int, nb: int, x: bytes, y: bytes) -> int:
    """No more elements than this are common: every differing parity is an element that
    one of the sets has alone. The longer table folds onto the shorter one."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return (na + nb - int(np.bitwise_count(a ^ b).sum())) // 2


PROFILE = "doc_id long, print long, n long, cls long, parity binary, part int, counts binary"


def _profiles(rows: DataFrame, width: int, slots: int) -> DataFrame:
    """A row per document, and at each task's end the counts of its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PROFILE.split(", ")]
        counts = np.zeros(slots, np.uint16)
        for batch, data, offsets in blocks(batches):
            sets = list(document_sets(data, offsets, width))
            every = np.concatenate(sets)
            if len(every):
                slot, more = np.unique(every & np.uint64(slots - 1), return_counts=True)
                slot = slot.astype(np.int64)
                counts[slot] = np.minimum(counts[slot] + more, MOST_COUNTED)
            n = batch.num_rows
            arrays = [
                batch.column("doc_id"),
                batch.column("print"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([parity(s) if len(s) > 1 else None for s in sets], pa.binary()),
                pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)
        if counts.any():
            parts = np.split(counts.astype(np.uint8), SKETCH_PARTS)
            none = pa.nulls(SKETCH_PARTS, pa.int64())
            arrays = [none] * 4 + [
                pa.nulls(SKETCH_PARTS, pa.binary()),
                pa.array(range(SKETCH_PARTS), pa.int32()),
                pa.array([p.tobytes() for p in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, PROFILE)


LEVELS = 128


def levels_of(counts: np.ndarray) -> np.ndarray:
    """A counter's place in the order, one byte: two levels for each doubling."""
    return np.floor(2 * np.log2(counts + 1)).astype(np.uint8)


def _sketch(profiles: DataFrame, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The level of every counter, and per level the number of counters, their sum and
    the sum of their squares. Counters are summed and levelled in the tasks; a byte for
    each reaches the driver, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(raw, np.uint8).astype(np.int64)
        for part, counts in sums.items():
            level = levels_of(counts)
            value = counts.astype(float)
            sizes = [np.bincount(level, w, LEVELS) for w in (None, value, value * value)]
            row = [part], [level.tobytes()], [np.stack(sizes).astype(float).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.binary(), pa.binary()))], names)

    names = ["part", "levels", "sizes"]
    rows = profiles.where("part IS NOT NULL").select("part", "counts").repartition(SKETCH_PARTS, "part")
    levels = np.zeros((SKETCH_PARTS, slots // SKETCH_PARTS), np.uint8)
    sizes = np.zeros((3, LEVELS))
    for row in rows.mapInArrow(run, "part int, levels binary, sizes binary").collect():
        levels[row.part] = np.frombuffer(row.levels, np.uint8)
        sizes += np.frombuffer(row.sizes, float).reshape(3, LEVELS)
    return levels.ravel(), sizes


def boundary(sizes: np.ndarray, slots: int, numerator: int, denominator: int) -> int:
    """Sets smaller than this enumerate subsets. A subset costs its entry; a list entry
    costs itself and the scan of its list, whose length is that of the rarest shingles
    (a set's first elements are its rarest share). ``sizes``: see :func:`_sketch`."""
    _, sums, squares = sizes[:, 1:]
    total = sums.sum()
    rare = int(np.searchsorted(np.cumsum(sums), (1 - numerator / denominator) * total)) + 1
    length = squares[:rare].sum() / max(sums[:rare].sum(), 1)
    cost = 1 + max(1.0, length - total / slots)
    n = 2
    while n < 4096 and n - least_overlap(n, numerator, denominator) + 2 <= 2 * cost:
        n += 1
    return n


def signatures(
    grams: np.ndarray, ranks: np.ndarray, small: int, numerator: int, denominator: int
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set of two or more, each with the place of its first element in the
    order; two sets similar enough share at least one. (A single element is only similar
    to itself.)"""
    n = len(grams)
    order = (ranks[(grams & np.uint64(len(ranks) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (grams >> np.uint64(8))
    front = n - least_overlap(n, numerator, denominator) + 1
    lead = grams[np.argsort(order, kind="stable")[: front + 1]]
    keys, places = [], []
    if n < small:
        a, b = np.triu_indices(len(lead), 1)
        keys.append(mixed(lead[a] * SUBSET_SALT + lead[b]))
        places.append(a)
    if n * denominator >= small * numerator:
        keys.append(mixed(lead[:front] ^ LIST_SALT))
        places.append(np.arange(front))
    return np.concatenate(keys), np.concatenate(places)


def _signature_rows(rows: DataFrame, width: int, ranks: np.ndarray, small: int, ratio: tuple[int, int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, data, offsets in blocks(batches):
            keys, places, classes = [], [], []
            for grams in document_sets(data, offsets, width):
                if len(grams) < 2 or (own := class_of(grams)) in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(own)
                found, place = signatures(grams, ranks, small, *ratio)
                keys.append(found)
                places.append(place)
                classes.append(np.full(len(found), own, np.int64))
            if keys:
                arrays = [np.concatenate(keys).astype(np.int64), np.concatenate(classes), np.concatenate(places)]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["key", "cls", "place"])

    return rows.select("text").mapInArrow(run, "key long, cls long, place long")


def _bits(classes: DataFrame, bits: int) -> np.ndarray:
    """A bit for each class (a filter of fixed size; false hits only cost work)."""
    slot = F.pmod(F.col("cls"), F.lit(bits))
    words = classes.select(
        F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(cls, {bits}) % 64 as int))").alias("bit")
    )
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy()] = found["bit"].to_numpy()
    return out


def _set_rows(rows: DataFrame, width: int, bits: np.ndarray) -> DataFrame:
    """The sets of the classes in the filter, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, data, offsets in blocks(batches):
            classes, sets = [], []
            for grams in document_sets(data, offsets, width):
                if len(grams) < 2:
                    continue
                own = class_of(grams)
                slot = own % (64 * len(bits))
                if own in seen or not (int(bits[slot >> 6]) >> (slot & 63)) & 1:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(own)
                classes.append(own)
                sets.append(grams.tobytes())
            if classes:
                arrays = [pa.array(classes, pa.int64()), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["cls", "grams"])

    return rows.select("text").mapInArrow(run, "cls long, grams binary").dropDuplicates(["cls"])


def _possible(pairs: DataFrame, classes: DataFrame, ratio: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sizes and parities leave room for enough common elements."""
    numerator, denominator = ratio

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, x, y in zip(*[batch.column(c).to_pylist() for c in ("na", "nb", "x", "y")]):
                both = most_overlap(na, nb, x, y)
                keep.append(denominator * both >= numerator * (na + nb - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sizes = classes.select("cls", "n")
    left = sizes.select(F.col("cls").alias("a"), F.col("n").alias("na"))
    right = sizes.select(F.col("cls").alias("b"), F.col("n").alias("nb"))
    fits = F.least("na", "nb") * denominator >= F.greatest("na", "nb") * numerator
    pairs = pairs.join(left, "a").join(right, "b").where(fits)
    left = classes.select(F.col("cls").alias("a"), F.col("parity").alias("x"))
    right = classes.select(F.col("cls").alias("b"), F.col("parity").alias("y"))
    pairs = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "x", "y")
    return pairs.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, rows: DataFrame, width: int, ratio: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that are similar enough, by their whole sets."""
    numerator, denominator = ratio

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                r, s = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(r, s, assume_unique=True))
                keep.append(denominator * both >= numerator * (len(r) + len(s) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls"))
    sets = materialize(_set_rows(rows, width, _bits(wanted, FILTER_BITS)), "jaccard-sets")
    left = sets.select(F.col("cls").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("grams").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return fewer_files(both, sets.count() + pairs.count(), WIDE_ROWS).mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(cls, root) for every class with a link: the smallest class it can reach.

    Each round takes the least root among the neighbours, then the root's own root; the
    tables are written, so a lost executor costs one round at most.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both, "jaccard-edges", 2 * edges.count())
    labels = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "cls")
    rows = both.count()
    labels = materialize(labels, "jaccard-roots", rows)
    while True:
        near = both.join(labels.select(F.col("cls").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near, labels["cls"] == near["a"]).select("cls", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        parent = labels.select(F.col("cls").alias("via"), F.col("root").alias("up"))
        step = step.join(parent, "via", "left").select("cls", "old", F.least("via", F.coalesce("up", "via")).alias("root"))
        step = materialize(step, "jaccard-roots", rows)
        labels = step.select("cls", "root")
        if step.where("root <> old").isEmpty():
            return labels


def linked_classes(rows: DataFrame, profiles: DataFrame, width: int, ratio: tuple[int, int], slots: int) -> DataFrame:
    """(cls, root) of all classes that have a similar one."""
    numerator, denominator = ratio
    ranks, sizes = _sketch(profiles, slots)
    small = boundary(sizes, slots, numerator, denominator)
    entries = materialize(_signature_rows(rows, width, ranks, small, ratio), "jaccard-keys")
    # A list's centre has the fewest rare elements before the shared one: of near copies,
    # the least edited, which most of the others resemble.
    rank = F.shiftleft("place", 40) + F.shiftrightunsigned("cls", 24)
    lists = entries.groupBy("key").agg(
        F.min("cls").alias("low"), F.max("cls").alias("high"), F.min_by("cls", rank).alias("centre")
    )
    lists = materialize(lists.where("low <> high").select("key", "centre"), "jaccard-lists", entries.count())
    members = materialize(entries.join(lists, "key"), "jaccard-members")
    classes = profiles.where("parity IS NOT NULL").groupBy("cls").agg(F.max("n").alias("n"), F.first("parity").alias("parity"))
    classes = materialize(classes, "jaccard-sizes", profiles.count())
    # What a join of the two reads decides on its tasks, not only what it gives.
    read = members.count() + classes.count()
    # A pair for each member: with the centre of its list.
    ends = members.where("cls <> centre").select(F.least("cls", "centre").alias("a"), F.greatest("cls", "centre").alias("b"))
    ends = ends.distinct()
    tried = materialize(_possible(ends, classes, ratio), "jaccard-tried", read)
    links = materialize(_verified(tried, rows, width, ratio), "jaccard-links")
    roots = components(links)
    # What is left: members of one list in different components, not compared before.
    marked = members.where("cls <> centre").select("key", "cls", "place")
    marked = marked.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    several = marked.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("key")
    marked = marked.join(several, "key").join(classes.select("cls", "n"), "cls")
    # Behind its first common element, a similar pair must still have its overlap: each
    # side alone, with the smallest partner, then both together.
    marked = marked.withColumn("left", F.col("n") - F.col("place"))
    marked = marked.where(F.col("left") * denominator >= F.col("n") * numerator)
    marked = materialize(marked, "jaccard-mixed", read)
    one = marked.select("key", *[F.col(c).alias(d) for c, d in (("cls", "a"), ("n", "na"), ("root", "ra"), ("left", "la"))])
    two = marked.select("key", *[F.col(c).alias(d) for c, d in (("cls", "b"), ("n", "nb"), ("root", "rb"), ("left", "lb"))])
    both = F.least("la", "lb")
    fits = F.least("na", "nb") * denominator >= F.greatest("na", "nb") * numerator
    fits &= both * denominator >= (F.col("na") + F.col("nb") - both) * numerator
    rest = one.join(two, "key").where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & fits)
    rest = rest.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    rest = materialize(_possible(rest, classes, ratio), "jaccard-rest")
    if rest.isEmpty():
        return roots
    more = materialize(_verified(rest, rows, width, ratio), "jaccard-links")
    return roots if more.isEmpty() else components(links.unionByName(more))


def _resolved(docs: DataFrame, width: int, ratio: tuple[int, int], slots: int) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, print, n, cls) and classes (cls, keep): the first document of
    each component by id (null last), then by fingerprint."""
    rows = slim(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print")
    )
    profiles = materialize(_profiles(rows, width, slots), "jaccard-profiles")
    found = profiles.where("part IS NULL").select("doc_id", "print", "n", "cls")
    roots = linked_classes(rows, profiles, width, ratio, slots)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("keep")
    own = found.where("cls IS NOT NULL").groupBy("cls").agg(first)
    documents = found.count()
    own = own.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    own = materialize(own, "jaccard-classes", documents)
    best = own.groupBy("root").agg(F.min("keep").alias("keep"))
    return found, materialize(own.select("cls", "root").join(best, "root").select("cls", "keep"), "jaccard-kept", documents)


def similar_components(
    docs: DataFrame,
    width: int = WIDTH,
    numerator: int = NUMERATOR,
    denominator: int = DENOMINATOR,
    slots: int = SKETCH_SLOTS,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents link when ``denominator * |A ∩ B| >= numerator * |A ∪ B|``. Null, empty
    and wordless texts have no set and are alone: their component is their own id. A
    null id takes part; the component's id is the smallest that is there, else null.
    Sets are compared as sets of 64-bit hashes.
    """
    found, kept = _resolved(docs, width, (numerator, denominator), slots)
    joined = found.join(kept, "cls", "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("keep.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, width: int = 5, numerator: int = 80, denominator: int = 100) -> DataFrame:
    """``docs`` with the first document of each component; documents without words stay.

    Rows equal in id and text are one document and stay once.
    """
    found, kept = _resolved(docs, width, (numerator, denominator), SKETCH_SLOTS)
    id_text = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("none"))
    stay = kept.select("keep.doc_id", "keep.print").unionByName(found.where("n = 0").select("doc_id", "print"))
    stay = stay.select(id_text.alias("_key"), F.col("print").alias("_print")).distinct()
    keyed = docs.withColumns({"_key": id_text, "_print": F.xxhash64(F.coalesce("text", F.lit("")))})
    one = keyed.join(stay, ["_key", "_print"], "left_semi").dropDuplicates(["_key", "_print"])
    return fewer_files(one.select(*docs.columns), found.count(), WIDE_ROWS)


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (SELECT g FROM grams GROUP BY g HAVING count(*) > 1),
few AS (SELECT * FROM grams SEMI JOIN shared USING (g)),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS common
  FROM few x JOIN few y ON x.g = y.g AND x.doc_id <> y.doc_id
   AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
  GROUP BY ALL
),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 90 * (na + nb - common)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a
)
SELECT s.doc_id, len(s.s) AS n_shingles, m.component_id
FROM sets s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""
