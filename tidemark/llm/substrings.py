"""Removal of word runs that stand more than once in a corpus, with prefix-partitioned suffix trees.

A window is 35 consecutive words. Its anchor is its least 8-word gram, so equal
windows have equal anchors at equal places, and neighbouring windows share one.
The trees hold the suffixes that start at anchors, one word in fifteen; a suffix
carries the words of all windows it is the anchor of, on both its sides.

Suffixes are dealt out by prefix. A prefix is the anchor gram at first. One that
more suffixes begin with than a task may hold is made longer: to 18 words from
the anchor on for windows that reach so far, and by 18 words before it for the
others. What is too frequent even so is told apart by whole windows; those of
one path are one leaf set, which needs a count and no tree. A task builds the
trees of its prefixes one group after another: the suffixes in order with their
common lengths, and the same for the words before them, read backwards. A window
with d words before its anchor repeats exactly if its suffix hangs below an
inner node at depth 35 - d with another whose last d words before it are the
same: together a repeat that is maximal to both sides where the nodes end.

An anchor that stands nowhere else makes its windows unique; those are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import batch_of, mix, slices, window_sums
from tidemark.session import materialise

WINDOW, GRAM = 35, 8
MOST = 1 << 15  # suffixes of one prefix that a task holds, about 0.5 KB each
KEYS_HELD = 1 << 18  # prefixes of a block of texts, or of a share of all prefixes, on average
SUFFIX = "key long, text_id long, first int, n int, ahead int, words binary"


def anchors_of(grams: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For each window of a text, where its least gram starts (the first of equals)."""
    span = window - gram + 1
    if len(grams) < span:
        return np.zeros(0, np.int64)
    least = np.argmin(np.lib.stride_tricks.sliding_window_view(grams, span), axis=1)
    return least + np.arange(len(least))


def prefixes(level: int, window: int, gram: int) -> list[tuple[int, int, int, int]]:
    """Prefixes of a level: for windows with least to greatest words before the anchor, words of the prefix before it and from it on."""
    last, half = window - gram, window // 2
    return [[(0, last, 0, gram)], [(0, half, 0, window - half), (half + 1, last, half + 1, gram)]][level]


class Suffixes:
    """Anchored suffixes of each text of an Arrow array."""

    def __init__(self, texts: pa.Array, window: int, gram: int) -> None:
        batch = batch_of(texts)
        self.window, self.gram = window, gram
        self.first, self.words = batch.first, batch.hashes()
        self.sums = {gram: window_sums(self.words, gram)}

    def hashes(self, size: int, at: np.ndarray) -> np.ndarray:
        if size not in self.sums:
            self.sums[size] = window_sums(self.words, size)
        return self.sums[size][at]

    def of(self, k: int, level: int, chosen: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """(key, anchor, first window, last window) of text k's suffixes; only those whose anchor gram is `chosen`.

        A suffix stands once for each prefix of its level, with the windows that hold it.
        """
        start, stop = int(self.first[k]), int(self.first[k + 1])
        anchor = anchors_of(self.sums[self.gram][start:max(start, stop - self.gram + 1)], self.window, self.gram)
        new = np.flatnonzero(np.diff(anchor, prepend=-1))
        p, a, b = anchor[new] + start, new + start, np.append(new[1:], len(anchor)) - 1 + start
        out = []
        for part, (least, most, before, after) in enumerate(prefixes(level, self.window, self.gram)):
            low, high = np.maximum(a, p - most), np.minimum(b, p - least)
            some = np.flatnonzero(low <= high)
            at = p[some]
            key = self.hashes(before + after, at - before)
            if level:
                key = mix(key, 40 + part)
            key = key.view(np.int64)
            if chosen is not None:
                kept = np.isin(self.hashes(self.gram, at).view(np.int64), chosen)
                some, key = some[kept], key[kept]
            out.append((key, p[some], low[some], high[some]))
        return tuple(np.concatenate(x) for x in zip(*out))


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(keys, return_counts=True)
    return values, counts.astype(np.int32)


def _prefix_counter(window: int, gram: int):
    """Prefixes of the first level in each text, and how often."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, most=2 << 20):
            found = Suffixes(rows["text"], window, gram)
            counted = [_counted(found.of(k, 0)[0]) for k in range(rows.num_rows)]
            keys, counts = pa.array([c[0] for c in counted], pa.list_(pa.int64())), pa.array([c[1] for c in counted], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([rows["text_id"], keys, counts], ["text_id", "keys", "counts"])

    return read


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    """The values of a column of lists, row after row."""
    return np.concatenate([np.zeros(0, np.int64), *[c.flatten().to_numpy() for c in lists.chunks if len(c)]])


def _ends(lists: pa.ChunkedArray) -> np.ndarray:
    """Where in their values the lists end, but for the last one."""
    return np.cumsum(pc.list_value_length(lists).to_numpy())[:-1]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, with the sums of their counts."""
    values, place = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(values), np.int64)
    np.add.at(sums, place, counts)
    return values, sums


def shared_prefixes(classes: DataFrame, most: int) -> DataFrame:
    """(text_id, copies, fit, longer) of the texts with prefixes that stand more than once in `classes` (text_id, copies, keys, counts).

    `fit` are those that stand `most` times at most, `longer` the others. Texts are
    dealt into blocks and prefixes into shares of all prefixes. A block sends each of its prefixes
    once to its share, however many of its texts have it, and gets back those that
    stand more than once; so rows are of blocks and shares, and those of a prefix
    are as many as blocks that have it.
    """
    n_keys = classes.agg(F.sum(F.size("keys").cast("long"))).first()[0] or 0
    blocks = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_keys // KEYS_HELD + 1)
    dealt = classes.select(F.pmod(F.xxhash64("text_id"), F.lit(blocks)).alias("block"), "text_id", "copies", "keys", "counts")
    pairs = [pa.list_(pa.int64()), pa.list_(pa.int64())]

    def by_place(rows: list[tuple], names: list[str]) -> pa.Table:
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        kinds = [pa.int64()] * (len(names) - 2) + pairs
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    def send(texts: pa.Table) -> pa.Table:
        keys, counts = _summed(_flat(texts["keys"]), _flat(texts["counts"]))
        share = (mix(keys.view(np.uint64), 51) % np.uint64(blocks)).astype(np.int64)
        order = np.argsort(share, kind="stable")
        shares, first = np.unique(share[order], return_index=True)
        block = texts["block"][0].as_py()
        parts = zip(shares.tolist(), np.split(keys[order], first[1:]), np.split(counts[order], first[1:]))
        return by_place([(s, block, k, n) for s, k, n in parts], ["share", "block", "keys", "counts"])

    def total(rows: pa.Table) -> pa.Table:
        keys = _flat(rows["keys"])
        values, sums = _summed(keys, _flat(rows["counts"]))
        sums, ends = sums[np.searchsorted(values, keys)], _ends(rows["keys"])
        parts = zip(rows["block"].to_pylist(), np.split(keys, ends), np.split(sums, ends))
        return by_place([(b, k[n > 1], n[n > 1]) for b, k, n in parts if (n > 1).any()], ["block", "keys", "counts"])

    def choose(texts: pa.Table, totals: pa.Table) -> pa.Table:
        keys, place = np.unique(_flat(texts["keys"]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        sums[np.searchsorted(keys, _flat(totals["keys"]))] = _flat(totals["counts"])
        sums, ends = sums[place], _ends(texts["keys"])
        rows = []
        for text_id, copies, k, n in zip(texts["text_id"].to_pylist(), texts["copies"].to_pylist(), np.split(keys[place], ends), np.split(sums, ends)):
            if (n > 1).any():
                rows.append((text_id, copies, k[(n > 1) & (n <= most)], k[n > most]))
        return by_place(rows, ["text_id", "copies", "fit", "longer"])

    sent = dealt.groupBy("block").applyInArrow(send, "share long, block long, keys array<long>, counts array<long>")
    totals = sent.groupBy("share").applyInArrow(total, "block long, keys array<long>, counts array<long>")
    return dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        choose, "text_id long, copies long, fit array<long>, longer array<long>")


def _chosen_texts(batches: Iterator[pa.RecordBatch], window: int, gram: int):
    """(text id, copies, suffixes, place in them, chosen keys), each copied text once a task."""
    seen: set[int] = set()
    for rows in slices(batches, "_text", most=2 << 20):
        found = Suffixes(rows["_text"], window, gram)
        for k, (text_id, copies, chosen) in enumerate(zip(rows["_id"].to_pylist(), rows["copies"].to_pylist(), rows["chosen"])):
            if copies > 1:
                # Its copies lose all words anyway; one of them is enough to be met by others.
                if text_id in seen:
                    continue
                seen.add(text_id)
            yield text_id, copies, found, k, chosen.values.to_numpy()


def _suffix_reader(window: int, gram: int, level: int):
    """Suffixes (SUFFIX) with prefixes of a level whose anchor grams are chosen; `first` of a copied text is -1 - first."""

    def table(parts: list) -> pa.RecordBatch:
        key, text_id, first, n, ahead, data, sizes = (np.concatenate(x) for x in zip(*parts))
        bounds = np.concatenate(([0], np.cumsum(sizes * 8))).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(text_id), *(pa.array(x.astype(np.int32)) for x in (first, n, ahead)), words], ["key", "text_id", "first", "n", "ahead", "words"],
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for text_id, copies, found, k, chosen in _chosen_texts(batches, window, gram):
            key, p, a, b = found.of(k, level, chosen)
            # A very long text leaves its suffixes in several batches.
            for s in range(0, len(key), 1 << 13):
                some = slice(s, s + (1 << 13))
                low, sizes = a[some], b[some] - a[some] + window
                ends = np.cumsum(sizes)
                data = found.words[np.arange(ends[-1]) + np.repeat(low - (ends - sizes), sizes)]
                first = low - found.first[k]
                parts.append((key[some], np.full(len(low), text_id), first if copies == 1 else -1 - first, b[some] - low + 1, p[some] - low, data, sizes))
                held += len(low)
                if held >= 1 << 13:
                    yield table(parts)
                    parts, held = [], 0
        if parts:
            yield table(parts)

    return read


def _window_reader(window: int):
    """The hash and number of each window in suffixes' words (content, all, words)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch["words"].to_pylist()
            n = np.array([len(w) // 8 - window + 1 for w in words], np.int64)
            paths = window_sums(np.frombuffer(b"".join(words), np.uint64), window)
            number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            # Windows that reach from one suffix into the next are between those of the two.
            at = number + np.repeat(np.cumsum(n + window - 1) - (n + window - 1), n)
            of = [np.repeat(batch[c].to_numpy(), n) for c in ("content", "all")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, of), pa.array(paths[at].view(np.int64)), pa.array(number.astype(np.int32))], ["content", "all", "path", "number"])

    return read


class Tree:
    """A suffix tree of rows of words, as their order and the common lengths of neighbours."""

    def __init__(self, rows: np.ndarray) -> None:
        count, depth = rows.shape
        order = np.argsort(np.ascontiguousarray(rows).view(f"S{8 * depth}")[:, 0], kind="stable") if depth else np.arange(count)
        self.place = np.empty(count, np.int64)
        self.place[order] = np.arange(count)
        unlike = np.ones((max(count - 1, 0), depth + 1), bool)
        unlike[:, :depth] = rows[order[1:]] != rows[order[:-1]]
        self.common = np.argmax(unlike, axis=1)

    def nodes(self, depth: int) -> np.ndarray:
        """For each row, the node that it passes at a depth."""
        return np.concatenate(([0], np.cumsum(self.common < depth)))[self.place]


def repeated_windows(n: np.ndarray, ahead: np.ndarray, words: list[np.ndarray], window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, number of the window in it) of the windows that repeat among these suffixes.

    Suffix i has n[i] windows, ahead[i] words before its anchor, and its words.
    """
    data, sizes = np.concatenate(words), n + window - 1
    anchor = np.cumsum(sizes) - sizes + ahead
    steps = np.arange(window)
    inside = steps < (sizes - ahead)[:, None]
    after = Tree(np.where(inside, data[np.where(inside, anchor[:, None] + steps, 0)], np.uint64(0)))
    steps = np.arange(window - gram)
    inside = steps < ahead[:, None]
    before = Tree(np.where(inside, data[np.where(inside, anchor[:, None] - 1 - steps, 0)], np.uint64(0)))
    found = []
    for d in range(window - gram + 1):
        # Fill beyond a suffix's words is not looked at: a window holds its own depth on both sides.
        some = np.flatnonzero((ahead - n < d) & (d <= ahead))
        if len(some):
            node = after.nodes(window - d)[some] * len(n) + before.nodes(d)[some]
            _, of, counts = np.unique(node, return_inverse=True, return_counts=True)
            some = some[counts[of] > 1]
            found.append((some, ahead[some] - d))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, number = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((number, at))
    return at[order], number[order]


def _subtrees(window: int, gram: int):
    """Repeated windows of suffixes that are sorted by prefix; whole prefixes are held together."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        text_id, first, n, ahead = (rows[c].to_numpy().astype(np.int64) for c in ("text_id", "first", "n", "ahead"))
        words = [np.frombuffer(b"".join(c.to_pylist()), np.uint64) for c in rows["words"].chunks]
        at, number = repeated_windows(n, ahead, words, window, gram)
        own = first[at] >= 0
        at, number = at[own], number[own]
        suffix, start = np.unique(at, return_index=True)
        places = pa.ListArray.from_arrays(pa.array(np.append(start, len(at)).astype(np.int32)), pa.array((first[at] + number).astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(text_id[suffix]), places], ["text_id", "places"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch["key"].to_numpy()
            new = np.flatnonzero(key != key[-1])
            cut = int(new[-1]) + 1 if len(new) else (0 if last is None or key[-1] == last else -1)
            if cut > 0:
                yield settle(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif cut < 0:
                yield settle(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(max(cut, 0)))
            last = key[-1]
        if held:
            yield settle(pa.Table.from_batches(held))

    return read


def _cutter(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "_text", most=4 << 20):
            batch, texts, counts, gone = batch_of(rows["_text"]), [], [], []
            copies, places = rows["_copies"].to_numpy(zero_copy_only=False), rows["_places"]
            for k, (first, last) in enumerate(zip(batch.first[:-1], batch.first[1:])):
                n = int(last - first)
                steps = np.zeros(n + 1, np.int64)
                if n >= window and copies[k] > 1:
                    steps[0] = 1
                elif places[k].is_valid:
                    at = places[k].values.to_numpy()
                    np.add.at(steps, at, 1)
                    np.add.at(steps, at + window, -1)
                kept = np.flatnonzero(np.cumsum(steps[:n]) == 0)
                at, text = batch.offsets[k], batch.text(k)
                starts, ends = batch.starts[first:last] - at, batch.ends[first:last] - at
                texts.append(b" ".join([text[s:e] for s, e in zip(starts[kept].tolist(), ends[kept].tolist())]))
                counts.append(n)
                gone.append(n - len(kept))
            passed = [n for n in rows.schema.names if n not in ("_text", "_copies", "_places")]
            yield pa.RecordBatch.from_arrays(
                [*[rows[n] for n in passed], rows["_text"], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                [*passed, "_whole", "_kept", "_words", "_removed"],
            )

    return cut


def repeats_removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """`docs` with the columns kept_text, n_words and n_removed.

    A run of `window` consecutive words of one row that also starts anywhere
    else, in the same row or another, loses all its words, here and there.
    kept_text are the words left, joined by one space. Judged on the input as it
    is: rows that repeat, whatever their ids, are copies of each other and lose
    everything if they have `window` words. A null, empty or shorter text has no
    windows and keeps its words. Added columns replace columns of these names.
    Texts go by a 64-bit hash of all their bytes, words by one of theirs; a
    prefix that more than `most` suffixes begin with is made longer.
    """
    names = [c for c in docs.columns if c not in ("kept_text", "n_words", "n_removed")]
    text = F.coalesce(F.col("`text`"), F.lit(""))
    # Both joins below take these rows with these columns, so that one exchange moves the texts.
    base = docs.select(
        *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(names) if c != "text"],
        text.alias("_text"), F.col("`text`").isNull().alias("_null"), F.xxhash64(text).alias("_id"),
    )
    classes = materialise(
        docs.select(F.xxhash64(text).alias("text_id"), text.alias("text"))
        .mapInArrow(_prefix_counter(window, gram), "text_id long, keys array<long>, counts array<int>")
        .groupBy("text_id").agg(F.count("*").alias("copies"), F.first("keys").alias("keys"), F.first("counts").alias("counts")),
        "texts",
    )

    prefix = materialise(shared_prefixes(classes, most), "prefixes")

    def suffixes(chosen: DataFrame, level: int) -> DataFrame:
        return base.join(chosen, F.col("_id") == F.col("text_id")).drop("text_id").mapInArrow(_suffix_reader(window, gram, level), SUFFIX)

    def subtrees(rows: DataFrame) -> DataFrame:
        return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_subtrees(window, gram), "text_id long, places array<int>")

    met = subtrees(suffixes(prefix.filter(F.size("fit") > 0).select("text_id", "copies", F.col("fit").alias("chosen")), 0))
    # Lists below are written on their own, so that Spark knows their size and broadcasts what is small.
    longer = materialise(prefix.filter(F.size("longer") > 0).select("text_id", "copies", F.col("longer").alias("chosen")), "longer")
    if not longer.isEmpty():
        rows = materialise(suffixes(longer, 1), "suffixes")
        fits = F.col("all") <= most
        counts = materialise(rows.groupBy("key").agg(F.count("*").alias("all")).filter("all > 1"), "counts")
        met = met.union(subtrees(rows.join(counts.filter(fits), "key").select(rows.columns)))
        # Most suffixes of the rest are the same words over and over: one of each is looked at, with their number.
        over = rows.join(counts.filter(~fits), "key").select("text_id", "first", F.xxhash64("key", "words").alias("content"), "words")
        contents = over.groupBy("content").agg(F.count("*").alias("all"), F.first("words").alias("words"))
        windows = materialise(contents.mapInArrow(_window_reader(window), "content long, all long, path long, number int"), "windows")
        again = materialise(windows.groupBy("path").agg(F.sum("all").alias("n")).filter("n > 1").select("path"), "again")
        numbers = materialise(windows.join(again, "path").groupBy("content").agg(F.collect_list("number").alias("numbers")), "numbers")
        met = met.union(over.filter("first >= 0").join(numbers, "content").select("text_id", F.transform("numbers", lambda x: x + F.col("first")).alias("places")))
    gone = met.groupBy("text_id").agg(F.flatten(F.collect_list("places")).alias("_places")).withColumn("_copies", F.lit(1).cast("long"))
    copied = classes.filter("copies > 1").select("text_id", F.lit(None).cast("array<int>").alias("_places"), F.col("copies").alias("_copies"))
    rest = [c for c in base.columns if c not in ("_text", "_id")]
    cut_texts = (
        base.join(gone.unionByName(copied), F.col("_id") == F.col("text_id"), "left")
        .select(*rest, "_text", "_places", F.coalesce("_copies", F.lit(1)).alias("_copies"))
    )
    kinds = ", ".join(f"{c} {cut_texts.schema[c].dataType.simpleString()}" for c in rest)
    out = cut_texts.mapInArrow(_cutter(window), f"{kinds}, _whole string, _kept string, _words long, _removed long")
    return out.select(
        *[
            (F.when(~F.col("_null"), F.col("_whole")) if c == "text" else F.col(f"_c{k}")).alias(c)
            for k, c in enumerate(names)
        ],
        F.col("_kept").alias("kept_text"), F.col("_words").alias("n_words"), F.col("_removed").alias("n_removed"),
    )


def without_repeats(docs: DataFrame, **settings) -> DataFrame:
    """`docs` with repeated runs cut out of their texts; other texts and all rows stay.

    A text that loses words becomes the words left, joined by one space, and
    n_chars, where it exists, the length of that.
    """
    cut = repeats_removed(docs, **settings)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumns(new).select(*[F.col(f"`{c}`") for c in docs.columns])
