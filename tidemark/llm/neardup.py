"""MinHash near-duplicate groups, with table keys made from pairs of smaller hash collections.

Two collections of `collections` sketches each hold `hashes` minhashes a sketch.
A table key is a pair (i-th sketch of the one, j-th of the other), so that
collections * collections tables need only 2 * collections * hashes minhashes:
about a square root of what as many plain bands would compute. Two sets of
similarity s meet in some table with probability (1 - (1 - s^hashes)^collections)^2,
for the defaults 0.9997 at s = 0.75 and above 0.9999 from 0.78 on.

Most pairs that meet are not similar enough. Before full sets are moved to
confirm a pair, both sides' `bins` are compared: the least hash of a set in each
of 256 ranges of the hash space, three bits of each. The bins filled by either
set are a uniform draw without replacement from the union, so equal ones are
hypergeometric; a pair is let go only when they are DEVIATIONS standard
deviations below what the wanted similarity gives (3 of a million pairs at it).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.words import Batch, batch_of, mix, slices, text_rows, window_sums
from tidemark.session import materialise

SHINGLE = 5
COLLECTIONS, HASHES = 16, 3
BINS, PLANES, DEVIATIONS = 256, 4, 4.5


def shingle_sets(batch: Batch, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, as sorted 64-bit hashes of lower-cased words."""
    words = batch.hashes(lower=True)
    windows = window_sums(words, size)
    for first, last in zip(batch.first[:-1], batch.first[1:]):
        if last - first >= size:
            yield np.unique(windows[first:last - size + 1])
        elif last > first:
            yield mix(window_sums(words[first:last], int(last - first)), 77)
        else:
            yield np.zeros(0, np.uint64)


def minhashes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n minhashes of each set that isn't empty, one row a set."""
    sizes = np.array([len(s) for s in sets])
    everything, starts = np.concatenate(sets), np.concatenate(([0], np.cumsum(sizes)[:-1]))
    out = np.empty((len(sets), n), np.uint64)
    rng = np.random.default_rng(20250101)
    factors, shifts = rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)
    for k in range(n):
        out[:, k] = np.minimum.reduceat(everything * factors[k] + shifts[k], starts)
    return out


def bin_words(sets: list[np.ndarray]) -> np.ndarray:
    """Bins of each set as four planes of bits: whether filled, then three bits of the least hash."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hashes = mix(np.concatenate(sets), 21)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    place = owner * BINS + (hashes >> np.uint64(56)).astype(np.int64)
    least = np.concatenate(([True], place[1:] != place[:-1]))
    bins = np.zeros(len(sets) * BINS, np.uint8)
    bins[place[least]] = (hashes[least] & np.uint64(7)).astype(np.uint8) * 2 + 1
    bins = bins.reshape(len(sets), 1, BINS)
    planes = np.concatenate([bins >> k & 1 for k in range(PLANES)], axis=1)
    return np.packbits(planes, axis=2, bitorder="little").reshape(len(sets), -1).view(np.uint64)


def may_link(x: str, y: str, n_x: str, n_y: str, percent: int) -> Column:
    """False where sizes or bins rule out that two sets are similar enough."""
    words = BINS // 64

    def counted(parts: list[Column]) -> Column:
        return reduce(Column.__add__, [F.bit_count(part) for part in parts])

    def differing(k: int) -> Column:
        return reduce(Column.bitwiseOR, [F.col(x)[p * words + k].bitwiseXOR(F.col(y)[p * words + k]) for p in range(PLANES)])

    either = counted([F.col(x)[k].bitwiseOR(F.col(y)[k]) for k in range(words)])
    unlike = counted([differing(k) for k in range(words)])
    p = percent / 100
    union = (F.col(n_x) + F.col(n_y)) / F.lit(1 + p)
    left = F.greatest(union - either, F.lit(0.0)) / F.greatest(union - 1, F.lit(1.0))
    enough = p * either - DEVIATIONS * F.sqrt(either * F.lit(p * (1 - p)) * left) - 1
    return (100 * F.least(n_x, n_y) >= percent * F.greatest(n_x, n_y)) & (either - unlike >= enough)


def _sketcher(collections: int, hashes: int, size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, most=1 << 20):
            sets = list(shingle_sets(batch_of(rows["text"]), size))
            full = [k for k, s in enumerate(sets) if len(s)]
            both = np.zeros((len(sets), 2 * collections), np.uint64)
            prints, bins = np.zeros((len(sets), 2), np.uint64), np.zeros((len(sets), BINS * PLANES // 64), np.uint64)
            if full:
                bins[full] = bin_words([sets[k] for k in full])
                low = minhashes([sets[k] for k in full], 2 * collections * hashes)
                low = low.reshape(len(full), 2 * collections, hashes)
                keys = mix(low[:, :, 0], 3)
                for j in range(1, hashes):
                    keys = mix(keys ^ low[:, :, j], 3 + j)
                both[full] = keys
                for k in full:
                    prints[k] = mix(sets[k], 11).sum(dtype=np.uint64), mix(sets[k], 12).sum(dtype=np.uint64)
            both, prints = both.view(np.int64), prints.view(np.int64)

            def lists(part: np.ndarray) -> pa.Array:
                flat = pa.array(np.ascontiguousarray(part).ravel())
                return pa.FixedSizeListArray.from_arrays(flat, part.shape[1]).cast(pa.list_(pa.int64()))

            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                 lists(both[:, :collections]), lists(both[:, collections:]), lists(bins.view(np.int64))],
                ["doc_id", "n_shingles", "print_a", "print_b", "u", "v", "bins"],
            )

    return sketch


def _set_reader(size: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, most=1 << 20):
            sets = [s.view(np.int64) for s in shingle_sets(batch_of(rows["text"]), size)]
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return read


def _shared(rows: DataFrame, side: str, collections: int) -> DataFrame:
    """(node, sketches): the sketches of a collection that another class has too, by place."""
    each = rows.select("node", F.posexplode(side).alias("i", "key"))
    common = each.groupBy("i", "key").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return each.join(common, ["i", "key"]).groupBy("node").agg(F.collect_list(F.struct("i", "key")).alias(side))


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Those of `pairs` (a, b) whose full sets are similar enough."""
    # Written first: Spark then knows the size of the ids, and moves no texts where it can broadcast them.
    ends = materialise(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct(), "ends")
    wanted = text_rows(docs, "doc_id", "text").join(ends, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    sets = materialise(wanted.mapInArrow(_set_reader(size), "doc_id long, shingles array<long>"), "sets")
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
        .filter(100 * common >= percent * (F.size("x") + F.size("y") - common))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, percent: int = 75, size: int = SHINGLE, collections: int = COLLECTIONS, hashes: int = HASHES
) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts with equal sets form one class, whose smallest doc_id stands for it.
    Classes that share a table key are candidates. First each is held against
    the smallest class of its key; what that links forms groups. Then, within a
    key, classes of *different* groups are held against each other, so no pair
    that shares a key and could still join two groups stays unlooked at, while
    the members of a large group don't meet in pairs. A pair that the bins don't
    rule out is a link if its full sets say so. Sketches that no other class has are dropped before keys
    are paired.

    Texts that are null, empty or white space have no shingles and stay alone.
    Rows with a null doc_id can't be named: they link with nothing, component_id
    is null and kept true. Rows that repeat a doc_id get one row each; if their
    texts differ, each text links the id. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, "doc_id", "text").mapInArrow(
        _sketcher(collections, hashes, size),
        "doc_id long, n_shingles long, print_a long, print_b long, u array<long>, v array<long>, bins array<long>",
    )
    rows = materialise(rows, "sketches")
    named = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    prints = ["n_shingles", "print_a", "print_b"]
    classes = named.groupBy(*prints).agg(F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("u", "v", "bins")])
    classes = materialise(classes, "classes")

    sides = materialise(_shared(classes, "u", collections).join(_shared(classes, "v", collections), "node"), "sides")
    keys = (
        sides.join(classes.select("node", "n_shingles"), "node")
        .withColumn("x", F.explode("u")).select("node", "n_shingles", "v", "x")
        .withColumn("y", F.explode("v"))
        .select(F.xxhash64("x.i", "y.i", "x.key", "y.key").alias("key"), F.col("x.i").alias("i"), F.col("y.i").alias("j"), "node", "n_shingles")
    )
    tables = keys.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1")
    keys = materialise(keys.join(tables.select("key", "least"), "key"), "keys")
    sizes = classes.select("node", "n_shingles", "bins")
    of_a = sizes.toDF("a", "of_a", "bins_a")
    stars = (
        keys.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
        .join(of_a, "a").join(sizes.toDF("b", "of_b", "bins_b"), "b")
        .filter(may_link("bins_a", "bins_b", "of_a", "of_b", percent)).select("a", "b")
    )
    stars = materialise(stars, "stars")
    links = materialise(_confirmed(stars, docs, percent, size), "links")
    # A row with another row's set hangs on its class; an id with several texts on each of theirs.
    copies = named.join(classes.select(*prints, "node"), prints).filter("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    groups = materialise(connected_components(links), "groups")

    grouped = keys.join(groups, "node", "left").select("key", "i", "j", "node", "n_shingles", F.coalesce("component", "node").alias("group"))
    mixed = grouped.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high").select("key")
    # Two classes share a table for each pair of their common sketches: the first of each collection speaks for all.
    upper = lambda part: F.transform(part, lambda x: F.shiftright(x, 32).cast("int")).alias(part)
    sketches = classes.select("node", upper("u"), upper("v"), "bins")
    open_keys = materialise(grouped.join(mixed, "key", "left_semi").join(sketches, "node"), "open")
    names = ["n_shingles", "group", "u", "v", "bins"]
    one = open_keys.select("key", "i", "j", F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in names])
    other = open_keys.select(F.col("key").alias("key_b"), F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in names])

    def first_common(x: str, y: str):
        return F.array_position(F.zip_with(x, y, lambda p, q: p == q), True) - 1

    similar = may_link("bins_a", "bins_b", "n_shingles_a", "n_shingles_b", percent)
    first = (F.col("i") == first_common("u_a", "u_b")) & (F.col("j") == first_common("v_a", "v_b"))
    new = (F.col("key") == F.col("key_b")) & (F.col("group_a") < F.col("group_b")) & similar & first
    rest = one.join(other, new).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct().join(stars, ["a", "b"], "left_anti")
    rest = materialise(rest, "pairs")
    more = _confirmed(rest, docs, percent, size)
    all_links = links.union(more).union(copies)
    reached = materialise(connected_components(all_links), "groups")
    return (
        rows.select("doc_id", "n_shingles").join(reached.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """`docs`, one row of each group of near duplicates; columns as they came.

    Groups are of rows: rows that repeat a doc_id or have none are copies of each
    other if their texts are, and stay if they are not. The row with the smallest
    doc_id is kept, one without an id only if none has one, and of equal ones any
    one. Rows without words stay.
    """
    # Row numbers hold only if everything reads them from the same files.
    numbered = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(numbered.select(F.col("_row").alias("doc_id"), "`text`"), **settings)
    members = numbered.select("_row", F.col("`doc_id`").alias("_id")).join(
        groups.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "_row")
    kept = members.groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_row")).alias("_first"))
    kept = materialise(kept.select(F.col("_first._row").alias("_row")), "kept-rows")
    return _rows_at(numbered, kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def _rows_at(numbered: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of `numbered` whose _row is in `kept`, found without moving the texts.

    Numbers are the task's, shifted by 33 bits, plus a place that counts from 0. A
    bit for each row, in words of 64 by place, is broadcast: 1.5 MB for 12 million rows.
    """
    part, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    marks = numbered.select("_row", F.lit(0).cast("long").alias("mark")).union(kept.select("_row", bit.alias("mark")))
    words = marks.groupBy(part.alias("_part"), F.shiftright(place, 6).alias("word")).agg(F.bit_or("mark").alias("bits"))
    words = words.groupBy("_part").agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("_bits"))
    words = F.broadcast(materialise(words, "kept-bits"))
    own = F.get(F.col("_bits"), F.shiftright(place, 6).cast("int"))
    is_kept = F.call_function("shiftright", own, (place % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
    return numbered.withColumn("_part", part).join(words, "_part").filter(is_kept)
