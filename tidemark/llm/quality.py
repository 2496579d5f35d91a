"""Quality of whole texts: random-indexing word vectors, pooled, and a two-layer network.

Random indexing gives every word a fixed sparse vector of +1 and -1, made of its
64-bit hash; a word's context vector is the sum of those of its neighbours over
the whole corpus. A text is the mean and the deviation of its words' context
vectors.

Most words stand in few texts, so texts are written once, in groups of bounded
size, bucketed by group. A word of one group gets its whole sum there and never
moves. Groups first send prefixes of their words' hashes, a few bits over what
tells them apart, and learn which of them another group may have too, and the rank
of each; only for those do sums go to the share of hashes they belong to, with the
rank and the rest of the hash, and totals come back. A prefix that two words share
by chance costs a row and changes no sum. A share holds as many rows as there are
groups for a word that all of them have.

The totals of words that at least half of the groups have would come back as
often as there are groups. They are broadcast once instead, and a group gets their
places only. As a group has a bounded number of words, at most twice as many
are broadcast, whatever the size of the corpus.

A small network trained in numpy on a bounded, hash-chosen set of labelled rows
gives a probability, whose temperature is set on labelled rows that it wasn't
trained on.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.toxicity import TRAIN_CHARS, picked_labels, sigmoid
from tidemark.llm.words import Batch, batch_of, mix, slices, text_rows
from tidemark.session import fresh_folder, materialise

DIMS, ENTRIES, REACH = 32, 4, 2
GROUP_BYTES = 36 << 20  # of text, whose words' vectors are held at once; some 600,000 words of 128 bytes
GROUPS_A_TASK = 3  # that texts of small partitions are read together for
SHARE_BYTES = 16 << 20  # of text, whose words make a share of all hashes
SPARE_BITS = 12  # of a hash's prefix, beyond one bit for each doubling of the corpus
PIECE = 4096  # words whose sums travel in one row
FEW = 16  # words of a batch up to so frequent are added up side by side
BLOCK = 1 << 12  # words whose vectors are added up at once
HIDDEN = 32
TRAIN_ROWS = 4000  # labelled rows of each kind that are learned from
PREFIXES = "share long, group long, prefixes binary"
MARKS = "share long, group long, marks binary, ranks binary"
SUMS = "share long, group long, words binary, places binary, sums binary"
TOTALS = "share long, group long, places binary, sums binary, often binary, at binary"
EVERY_GROUP = -1  # in the place of a group: totals that are broadcast


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """The index vector of each word hash: ENTRIES components are +1 or -1, the others 0."""
    out, row = np.zeros((len(hashes), DIMS), np.int8), np.arange(len(hashes))
    for k in range(ENTRIES):
        h = mix(hashes, 31 + k)
        # Entries of a vector lie in parts of their own, so none meet.
        out[row, k * (DIMS // ENTRIES) + (h % np.uint64(DIMS // ENTRIES)).astype(np.int64)] = np.where(h >> np.uint64(63), 1, -1)
    return out


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0, byte by byte of their width, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return planes.size.to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def packed_words(words: np.ndarray) -> bytes:
    """Sorted hashes or places, as the steps between them."""
    return _packed(np.diff(words, prepend=np.uint64(0)))


def unpacked_words(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def _planes(values: np.ndarray, bits: int) -> bytes:
    """Rows of whole numbers below 2 ** bits: two or four to a byte where they fit, else byte by byte."""
    if bits > 4:
        return b"".join((values >> np.uint64(8 * k)).astype(np.uint8).tobytes() for k in range(-(-bits // 8)))
    step, small = (2 if bits <= 2 else 4), values.astype(np.uint8)
    return np.bitwise_or.reduce([small[:, k::8 // step] << np.uint8(k * step) for k in range(8 // step)]).tobytes()


def _from_planes(data: bytes, n: int, bits: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8)
    if bits > 4:
        return sum(plane.astype(np.uint64) << np.uint64(8 * k) for k, plane in enumerate(planes.reshape(-1, n, DIMS)))
    step, out = (2 if bits <= 2 else 4), np.empty((n, DIMS), np.uint64)
    for k in range(8 // step):
        out[:, k::8 // step] = (planes.reshape(n, -1) >> np.uint8(k * step)) & np.uint8((1 << step) - 1)
    return out


def _planes_size(n: int, bits: int) -> int:
    return n * DIMS * -(-bits // 8) if bits > 4 else n * DIMS // (4 if bits <= 2 else 2)


def packed_sums(sums: np.ndarray) -> bytes:
    """Sums of either sign: the sign goes to the lowest bit, and words whose sums take as many bits are compressed together."""
    wide = sums.astype(np.int64).reshape(-1, DIMS)
    folded = ((wide << 1) ^ (wide >> 63)).view(np.uint64)
    bits = np.frexp(folded.max(1, initial=0).astype(float))[1].astype(np.uint8)
    planes = [_planes(folded[bits == b], int(b)) for b in np.unique(bits)]
    parts = [pa.compress(part, codec="zstd", asbytes=True) for part in (bits.tobytes(), *planes)]
    head = np.array([len(parts), len(bits), *map(len, parts)], "<u4")
    return head.tobytes() + b"".join(parts)


def unpacked_sums(data: bytes) -> np.ndarray:
    n_parts, n = np.frombuffer(data, "<u4", 2)
    ends = np.cumsum([8 + 4 * n_parts, *np.frombuffer(data, "<u4", n_parts, 8)])
    parts = [data[a:b] for a, b in zip(ends, ends[1:])]
    bits, folded = np.frombuffer(pa.decompress(parts[0], int(n), codec="zstd", asbytes=True), np.uint8), np.empty((n, DIMS), np.uint64)
    for b, part in zip(np.unique(bits).tolist(), parts[1:]):
        here = np.flatnonzero(bits == b)
        folded[here] = _from_planes(pa.decompress(part, _planes_size(len(here), b), codec="zstd", asbytes=True), len(here), b)
    return (folded >> np.uint64(1)).astype(np.int64) ^ -(folded & np.uint64(1)).astype(np.int64)


def _leading(words: np.ndarray, bits: int) -> np.ndarray:
    """The first `bits` bits of each hash."""
    return words >> np.uint64(64 - bits) if bits else np.zeros(len(words), np.uint64)


def _by_share(words: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The shares that sorted hashes belong to, with the places of their words."""
    shares, first = np.unique(_leading(words, bits), return_index=True)
    for share, start, end in zip(shares, first, [*first[1:], len(words)]):
        yield int(share), slice(int(start), int(end))


def _first_of_each(ordered: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array starts."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted; `values` are sorted in place."""
    values.sort()
    return values[_first_of_each(values)]


def _group_words(texts: pa.Table) -> np.ndarray:
    """The distinct word hashes of a group, sorted."""
    found = [np.zeros(0, np.uint64)]
    for rows in slices(iter(texts.to_batches()), most=1 << 20):
        found.append(_distinct(batch_of(rows["text"]).hashes()))
        if len(found) > 8:
            found = [_distinct(np.concatenate(found))]
    return _distinct(np.concatenate(found))


def _located(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct hashes, the one at each place, the places by hash, and where each hash starts among those."""
    order = np.argsort(hashes)
    ordered = hashes.take(order)
    first = _first_of_each(ordered)
    place = np.empty(len(hashes), np.int64)
    place[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
    return ordered[first], place, order, first


def _around(own: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each word, the sum of the index vectors of its neighbours in the same text; at most 2 * REACH in size."""
    around = np.zeros_like(own)
    for step in range(1, min(REACH, len(own) - 1) + 1):
        around[step:] += own[:-step]
        around[:-step] += own[step:]
        across = np.flatnonzero(text[step:] != text[:-step])
        around[across + step] -= own[across]
        around[across] -= own[across + step]
    return around


def _summed(rows: np.ndarray, order: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sums of rows[order[f:f + n]] for each first f and count n."""
    by_count = np.argsort(counts)
    first, counts = first[by_count], counts[by_count]
    added, frequent = rows.take(order[first], axis=0).astype(np.int32), int(np.searchsorted(counts, FEW, "right"))
    for k in range(1, FEW):
        more = slice(int(np.searchsorted(counts, k, "right")), frequent)
        added[more] += rows.take(order[first[more] + k], axis=0)
    for k in range(frequent, len(first)):
        # Sums of small whole numbers, exact in float32.
        blocks = [order[start:min(start + BLOCK, first[k] + counts[k])] for start in range(first[k], first[k] + counts[k], BLOCK)]
        added[k] = sum((np.ones(len(b), np.float32) @ rows.take(b, axis=0).astype(np.float32)).astype(np.int32) for b in blocks)
    out = np.empty_like(added)
    out[by_count] = added
    return out


def _add_group_sums(texts: pa.Table, words: np.ndarray, wanted: np.ndarray, sums: np.ndarray) -> None:
    """Add the context sums of a group's texts to `sums`: a row for each of its sorted `words` that is wanted."""
    row = np.cumsum(wanted) - 1
    for rows in slices(iter(texts.to_batches()), most=1 << 20):
        batch = batch_of(rows["text"])
        if not len(batch.starts) or not wanted.any():
            continue
        distinct, place, order, first = _located(batch.hashes())
        around = _around(index_vectors(distinct).take(place, axis=0), batch.of_text())
        at = np.searchsorted(words, distinct)
        asked, counts = wanted[at], np.diff(first, append=len(order))
        sums[row[at[asked]]] += _summed(around, order, first[asked], counts[asked])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the number of their group, the first row marked: runs of a task's rows of GROUP_BYTES, one row at least."""
    group, held, begun = TaskContext.get().partitionId() << 32, 0, False
    for rows in slices(batches, most=min(1 << 20, GROUP_BYTES)):
        size = (pc.sum(pc.binary_length(rows["text"])).as_py() or 0) + 16 * rows.num_rows
        if held and held + size > GROUP_BYTES:
            group, held, begun = group + 1, 0, False
        held += size
        first = np.zeros(rows.num_rows, bool)
        first[:1], begun = not begun, True
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(rows.num_rows, group), pa.int64()), pa.array(first), *rows.columns], ["group", "first", *rows.schema.names])


def grouped_texts(docs: DataFrame, size: int) -> str:
    """The name of a table of the texts, bucketed by group, which the caller drops.

    A task writes whole groups only, so there are about as many files as groups.
    Small partitions are read together, up to a few groups in a task, of which the
    last may be small: the fewer the groups, the fewer have a word in common, and
    the less of its sums travels.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, "doc_id", "text").coalesce(size // (GROUPS_A_TASK * GROUP_BYTES) + 1).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.length("text").cast("long").alias("chars"), F.xxhash64("text").alias("key"))
    buckets = max(size // GROUP_BYTES + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"tidemark_groups_{uuid.uuid4().hex}"
    dealt = rows.mapInArrow(_dealt, "group long, first boolean, doc_id long, text string, chars long, key long")
    dealt.write.bucketBy(min(buckets, 100_000), "group").format("parquet").options(
        **{"path": fresh_folder(spark, "groups"), "compression": "zstd", "parquet.compression.codec.zstd.level": "9"}).saveAsTable(name)
    return name


def _some_rows(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


_ROUTE = [("share", pa.int64()), ("group", pa.int64())]
_SUMS = [*_ROUTE, ("words", pa.binary()), ("places", pa.binary()), ("sums", pa.binary())]
_TOTALS = [*_ROUTE, ("places", pa.binary()), ("sums", pa.binary()), ("often", pa.binary()), ("at", pa.binary())]


def _marks(rows: pa.Table) -> pa.Table:
    """For each group that sent prefixes to a share: which of them were sent more than once, and their ranks among all such."""
    found = [unpacked_words(p) for p in rows["prefixes"].to_pylist()]
    _, place, count = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    rank, ends = (np.cumsum(count > 1) - 1).astype(np.uint64), np.cumsum([len(f) for f in found])[:-1]
    shared, ranks = np.split(count[place] > 1, ends), np.split(rank[place], ends)
    marks = pa.array([np.packbits(s).tobytes() for s in shared], pa.binary())
    ranks = pa.array([packed_words(r[s]) for r, s in zip(ranks, shared)], pa.binary())
    return pa.table([rows["share"], rows["group"], marks, ranks], names=["share", "group", "marks", "ranks"])


def _totals(rows: pa.Table, often: int) -> pa.Table:
    """For each row: the places of its words in its group, and their sums over all rows of the share.

    Words of one row alone are left out. The sums of words of `often` rows or
    more come once, in a row of EVERY_GROUP; the others then hold the places of
    those words, and where in that row each is found.
    """
    pieces = [unpacked_words(w) for w in rows["words"].to_pylist()]
    words = _distinct(np.concatenate(pieces))
    found, sums = [np.searchsorted(words, piece) for piece in pieces], np.zeros((len(words), DIMS), np.int64)
    for place, data in zip(found, rows["sums"].to_pylist()):
        sums[place] += unpacked_sums(data)
    count = np.bincount(np.concatenate(found), minlength=len(words))
    frequent = count >= often
    some, at, out, share = (count > 1) & ~frequent, (np.cumsum(frequent) - 1).astype(np.uint64), [], rows["share"][0].as_py()
    if frequent.any():
        out.append((share, EVERY_GROUP, None, packed_sums(sums[frequent]), None, None))
    for group, place, places in zip(rows["group"].to_pylist(), found, map(unpacked_words, rows["places"].to_pylist())):
        own, sent = some[place], frequent[place]
        out.append((share, group, packed_words(places[own]), packed_sums(sums[place[own]]), packed_words(places[sent]), packed_words(at[place[sent]])))
    return _some_rows(out, _TOTALS)


def word_totals(groups: DataFrame, size: int, often: int | None = None) -> DataFrame:
    """Rows of TOTALS: whole-corpus sums of the words that several groups have, by their places among a group's sorted words.

    Those of words that `often` groups have come once, in rows of EVERY_GROUP.
    """
    share_bits = min(32, (size // SHARE_BYTES).bit_length())
    prefix_bits = min(64, max(share_bits, size.bit_length()) + SPARE_BITS)
    rest = np.uint64(64 - prefix_bits)

    def send_prefixes(texts: pa.Table) -> pa.Table:
        words, group = _group_words(texts), texts["group"][0].as_py()
        rows = [(share, group, packed_words(_leading(words[at], prefix_bits))) for share, at in _by_share(words, share_bits)]
        return _some_rows(rows, [*_ROUTE, ("prefixes", pa.binary())])

    def send_sums(texts: pa.Table, marks: pa.Table) -> pa.Table:
        words = _group_words(texts)
        replies = {share: reply for share, *reply in zip(*(marks[name].to_pylist() for name in ("share", "marks", "ranks")))}
        asked, short = np.zeros(len(words), bool), np.zeros(len(words), np.uint64)
        for share, at in _by_share(words, share_bits):
            shared, ranks = replies[share]
            asked[at] = np.unpackbits(np.frombuffer(shared, np.uint8), count=at.stop - at.start).astype(bool)
            # The rank of the prefix and the rest of the hash: as good as the hash within a share.
            here = at.start + np.flatnonzero(asked[at])
            short[here] = unpacked_words(ranks) << rest | words[here] & ((np.uint64(1) << rest) - np.uint64(1))
        places, rows = np.flatnonzero(asked), []
        sums = np.zeros((len(places), DIMS), np.int32)
        _add_group_sums(texts, words, asked, sums)
        for share, at in _by_share(words[asked], share_bits):
            for start in range(at.start, at.stop, PIECE):
                piece = slice(start, min(start + PIECE, at.stop))
                here = places[piece]
                rows.append((share, texts["group"][0].as_py(), packed_words(short[here]), packed_words(here.astype(np.uint64)), packed_sums(sums[piece])))
        return _some_rows(rows, _SUMS)

    def total(rows: pa.Table) -> pa.Table:
        return _totals(rows, often or 1 << 62)

    texts = groups.select("group", "text")
    marks = texts.groupBy("group").applyInArrow(send_prefixes, PREFIXES).groupBy("share").applyInArrow(_marks, MARKS)
    sums = texts.groupBy("group").cogroup(marks.groupBy("group")).applyInArrow(send_sums, SUMS)
    return sums.groupBy("share").applyInArrow(total, TOTALS)


def unit(sums: np.ndarray) -> np.ndarray:
    """Context vectors of length 1 (or 0)."""
    out = np.empty(sums.shape, np.float32)
    for start in range(0, len(sums), 1 << 15):
        some = sums[start:start + (1 << 15)]
        out[start:start + (1 << 15)] = some / np.maximum(np.linalg.norm(some, axis=1, keepdims=True), 1e-9)
    return out


def pooled(batch: Batch, place: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and deviation of vectors[place] over each text's words; zeros without words."""
    out, wide = np.zeros((len(batch.first) - 1, 2 * DIMS), np.float32), vectors.astype(np.float64)
    both = np.concatenate([wide, wide * wide], 1)
    for k in np.flatnonzero(np.diff(batch.first)):
        start, end = batch.first[k], batch.first[k + 1]
        blocks = [place[s:min(s + BLOCK, end)] for s in range(start, end, BLOCK)]
        total = sum(np.ones(len(b)) @ both.take(b, axis=0) for b in blocks) / (end - start)
        mean, square = total[:DIMS], total[DIMS:]
        out[k, :DIMS], out[k, DIMS:] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
    return out


def _group_features(texts: pa.Table, totals: pa.Table) -> pa.Table:
    """Features of a group's texts: its own sums where a word stands in no other group, else the totals."""
    words = _group_words(texts)
    alone = np.ones(len(words), bool)
    for name in ("places", "often"):
        for places in totals[name].to_pylist():
            alone[unpacked_words(places).astype(np.int64)] = False
    n = np.count_nonzero(alone)
    row = np.where(alone, np.cumsum(alone) - 1, n + np.cumsum(~alone) - 1)
    # Vectors take the place of the sums they are made of; those of words alone come first.
    sums = np.zeros((len(words), DIMS), np.int32)
    _add_group_sums(texts, words, alone, sums)
    vectors = sums.view(np.float32)
    for start in range(0, n, 1 << 15):
        at = slice(start, min(start + (1 << 15), n))
        vectors[at] = unit(sums[at])
    common = pa.concat_arrays([rows.flatten() for rows in texts["common"].drop_null().chunks] or [pa.array([], texts["common"].type.value_type)])
    row_of = {share: k for k, share in enumerate(common.field("share").to_pylist())}
    for rows in totals.to_batches():
        for share, places, data, often, at in zip(*(rows[name] for name in ("share", "places", "sums", "often", "at"))):
            vectors[row[unpacked_words(places.as_py()).astype(np.int64)]] = unit(unpacked_sums(data.as_buffer()))
            there = unpacked_words(often.as_py()).astype(np.int64)
            if len(there):
                everywhere = unpacked_sums(common.field("sums")[row_of[share.as_py()]].as_buffer())
                vectors[row[there]] = unit(everywhere[unpacked_words(at.as_py()).astype(np.int64)])
    out = []
    for rows in slices(iter(texts.to_batches()), most=1 << 19):
        batch = batch_of(rows["text"])
        distinct, place, _, _ = _located(batch.hashes())
        features = [f.tobytes() for f in pooled(batch, place, vectors.take(row[np.searchsorted(words, distinct)], axis=0)).astype("<f4")]
        out.append(pa.RecordBatch.from_arrays(
            [rows["doc_id"], rows["chars"], rows["key"], pa.array(features, pa.binary())], ["doc_id", "chars", "key", "features"],
        ))
    return pa.Table.from_batches(out)


def text_features(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, its text's length (null without a text) and hash, and 2 * DIMS pooled floats; written once."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    name = grouped_texts(docs, size)
    try:
        groups = docs.sparkSession.table(name)
        totals = word_totals(groups, size, max(2, -(-groups.filter("first").count() // 2)))
        # Both uses of the totals read the one shuffle of sums.
        common = totals.filter(F.col("group") == EVERY_GROUP).agg(F.collect_list(F.struct("share", "sums")).alias("common"))
        # One row of a group carries what is broadcast.
        texts = groups.join(F.broadcast(common), F.col("first"), "left")
        own = totals.filter(F.col("group") != EVERY_GROUP)
        features = texts.groupBy("group").cogroup(own.groupBy("group")).applyInArrow(
            _group_features, "doc_id long, chars long, key long, features binary")
        return materialise(features, "features")
    finally:
        docs.sparkSession.sql(f"DROP TABLE {name}")


def _floats(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, 2 * DIMS)


class Network:
    """Two layers on standardised features, with a temperature."""

    def __init__(self, x: np.ndarray, label: np.ndarray, epochs: int = 60, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.spread
        self.weights = [
            rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN),
            rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1),
        ]
        self.temperature = 1.0
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for s in range(0, len(order), 64):
                some, step = order[s:s + 64], step + 1
                hidden, logits = self._forward(x[some])
                up = (sigmoid(logits) - label[some]) / len(some)
                back = np.outer(up, self.weights[2]) * (1 - hidden * hidden)
                grads = [x[some].T @ back, back.sum(0), hidden.T @ up, np.array([up.sum()])]
                for w, g, a, b in zip(self.weights, grads, first, second):
                    g = g + 1e-4 * w
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    w -= 0.005 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.weights[0] + self.weights[1])
        return hidden, hidden @ self.weights[2] + self.weights[3][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.spread)[1]

    def calibrate(self, x: np.ndarray, label: np.ndarray) -> None:
        """The temperature with the least log loss on rows left out of training."""
        logits = self.logits(x)

        def loss(t: float) -> float:
            p = np.clip(sigmoid(logits / t), 1e-7, 1 - 1e-7)
            return float(-(label * np.log(p) + (1 - label) * np.log(1 - p)).mean())

        self.temperature = min(np.geomspace(0.25, 8, 60), key=loss)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.temperature)


def trained(x: np.ndarray, labels: list[int]) -> Network | float:
    """A network calibrated on every fifth example; the only label's value if there is one kind; 0.5 without any."""
    label = np.array(labels, float)
    if not len(label) or label.min() == label.max():
        return float(label[0]) if len(label) else 0.5
    left_out = np.arange(len(label)) % 5 == 4  # examples come in the order of their ids
    if not left_out.any():
        left_out = ~left_out
    network = Network(x[~left_out] if (~left_out).any() else x, label[~left_out] if (~left_out).any() else label)
    network.calibrate(x[left_out], label[left_out])
    return network


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id and the probability that its quality label is 1.

    Word vectors come from all texts. Null and empty texts and texts of white
    space are points without words (all zeros) and scored like others. Repeated
    rows score alike; other columns are ignored. Only the features of training
    rows go to the driver.
    """
    features = text_features(docs)
    short = features.filter(F.col("chars").between(1, TRAIN_CHARS))
    examples = short.join(F.broadcast(picked_labels(labels, "quality", TRAIN_ROWS)), "doc_id").dropDuplicates(["doc_id", "key"])
    examples = sorted(examples.select("doc_id", "key", "label", "features").collect(), key=lambda r: (r["doc_id"], r["key"]))
    network = trained(_floats(pa.array([bytes(r["features"]) for r in examples], pa.binary())), [r["label"] for r in examples])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if isinstance(network, float):
                values = np.full(rows.num_rows, network)
            else:
                values = network.probabilities(_floats(rows["features"]))
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(values, pa.float64())], ["doc_id", "score"])

    return features.select("doc_id", "features").mapInArrow(score, "doc_id long, score double")
