"""Best-fit packing of documents into token sequences, by linear grouping.

How many pieces there are of each length says all that a packing needs, and
there are no more lengths than a sequence has tokens. So the plan is made from
that histogram, of bounded size for any corpus: lengths of large pieces are cut
into groups of equally many pieces and rounded up to their group's largest; the
best mix of configurations of these few sizes is found by column generation; the
actual lengths then take the rounded ones' places; and smaller pieces, with
what rounding down the mix left over, go best-fit, longest first. Pieces meet
the plan by their number among those of their length.
"""

from __future__ import annotations

import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder_of
from tidemark.llm.words import slices, text_rows
from tidemark.session import materialise

CAPACITY = 2048
GROUPS, SMALL = 64, 8  # sizes after rounding; pieces up to 1/8 of a sequence are small
END_ID = 0


def _tokenizer(path: str, capacity: int, end_id: int):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder_of(path), TaskContext.get().partitionId(), defaultdict(int)
        names = ["doc_id", "piece", "start", "length", "part", "rank", "ids"]
        for rows in slices(batches, most=1 << 20):
            out = []
            for doc_id, text in zip(rows["doc_id"].to_pylist(), rows["text"].to_pylist()):
                ids = array.array("I", encode(text or ""))
                ids.append(end_id)
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                data = ids.tobytes()
                for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    out.append((doc_id, piece, a, b - a, part, seen[b - a], data[4 * a:4 * b]))
                    seen[b - a] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return tokenise


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), and its number among its length in its task.

    A text's ids end with `end_id`; only longer ones than `capacity` are cut, the
    first piece being the shorter. Null and empty texts are one piece of one id.
    `tokenizer` is the path of a tokenizer file that executors can read.
    """
    return text_rows(docs, "doc_id", "text").mapInArrow(
        _tokenizer(tokenizer, capacity, end_id), "doc_id long, piece int, start long, length long, part int, rank long, ids binary"
    )


def few_sizes(counts: dict[int, int], groups: int) -> list[dict[int, int]]:
    """Cut lengths into groups of equally many pieces, longest first: per group, length -> pieces."""
    total = sum(counts.values())
    size, out, room = -(-total // groups), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append({})
                room = size
            took = min(left, room)
            out[-1][length] = took
            left, room = left - took, room - took
    return out


def configurations(sizes: np.ndarray, needs: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns (pieces of each size in a sequence) and how often to use each, by column generation.

    Starts from sequences of one size each; a knapsack over the sizes' prices
    finds a pattern that would save sequences, until none does. Numbers are
    rounded down, so no need is exceeded.
    """
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    amounts = inverse @ needs
    for _ in range(50 * k):
        prices = inverse.sum(0)
        best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(int(sizes.min()), capacity + 1):
            fits = sizes <= room
            values = np.where(fits, best[room - np.where(fits, sizes, 0)] + prices, -np.inf)
            at = int(np.argmax(values))
            best[room], taken[room] = (values[at], at) if values[at] > best[room - 1] else (best[room - 1], -1)
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        while room > 0:
            if taken[room] < 0:
                room -= 1
            else:
                column[taken[room]] += 1
                room -= int(sizes[taken[room]])
        step = inverse @ column
        ratios = np.where(step > 1e-9, amounts / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        basis[:, out] = column
        inverse = np.linalg.inv(basis)
        amounts = np.maximum(inverse @ needs, 0)
    whole = np.floor(amounts + 1e-9).astype(int)
    spare = needs.astype(int) - basis.astype(int) @ whole
    if (spare < 0).any():
        whole = np.maximum(whole - 1, 0)
    return [(basis[:, p].astype(int), int(whole[p])) for p in range(k) if whole[p] > 0]


class Plan:
    """Classes of equal sequences: how many there are, what room is left, and the runs of pieces they hold."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.next_rank = capacity, defaultdict(int)
        self.open: dict[int, list[list]] = defaultdict(list)  # room -> [number, [(length, first rank)]]

    def take(self, length: int, number: int) -> tuple[int, int]:
        first = self.next_rank[length]
        self.next_rank[length] += number
        return length, first

    def add(self, number: int, runs: list[tuple[int, int]]) -> None:
        self.open[self.capacity - sum(n for n, _ in runs)].append([number, runs])

    def best_fit(self, length: int, number: int) -> None:
        """Put `number` pieces each where least room is left, as many a sequence as go in."""
        while number:
            room = next((r for r in range(length, self.capacity) if self.open.get(r)), self.capacity)
            have, runs = self.open[room].pop() if room < self.capacity else [number, []]
            each = min(room // length, number)
            used = min(have, number // each)
            if used < have and room < self.capacity:
                self.open[room].append([have - used, [(n, r + used) for n, r in runs]])
            self.open[room - each * length].append([used, runs + [self.take(length, used) for _ in range(each)]])
            number -= used * each

    def rows(self) -> list[tuple[int, int, int, int, int]]:
        """(length, first rank, number, first sequence, offset) of each run."""
        out, sequence = [], 0
        for room in sorted(self.open):
            for number, runs in self.open[room]:
                offset = 0
                for length, first in runs:
                    out.append((length, first, number, sequence, offset))
                    offset += length
                sequence += number
        return out


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> list[tuple[int, int, int, int, int]]:
    """Places for `counts` pieces of each length, at most `capacity` long."""
    plan, rest = Plan(capacity), defaultdict(int)
    large = {n: c for n, c in counts.items() if capacity // small < n < capacity}
    if counts.get(capacity):
        plan.add(counts[capacity], [plan.take(capacity, counts[capacity])])
    for n, c in counts.items():
        if n <= capacity // small:
            rest[n] += c
    if large:
        cut = few_sizes(large, groups)
        # Groups whose largest length is the same are one size.
        merged: list[dict[int, int]] = []
        for group in cut:
            if merged and max(merged[-1]) == max(group):
                for n, c in group.items():
                    merged[-1][n] = merged[-1].get(n, 0) + c
            else:
                merged.append(dict(group))
        sizes, needs = np.array([max(g) for g in merged]), np.array([sum(g.values()) for g in merged])
        queues = [[[n, g[n]] for n in sorted(g, reverse=True)] for g in merged]
        for pattern, number in configurations(sizes, needs, capacity):
            places = [g for g in range(len(sizes)) for _ in range(pattern[g])]
            # The longest actual pieces left of a group take each of its places, `number` of them in turn.
            held = []
            for g in places:
                need, runs = number, []
                while need:
                    length, have = queues[g][0]
                    took = min(need, have)
                    runs.append((length, took))
                    need -= took
                    if took == have:
                        queues[g].pop(0)
                    else:
                        queues[g][0][1] -= took
                held.append(runs)
            ends = sorted({e for runs in held for e in np.cumsum([t for _, t in runs]).tolist()})
            done = 0
            for end in ends:
                lengths = []
                for runs in held:
                    lengths.append(runs[0][0])
                    runs[0] = (runs[0][0], runs[0][1] - (end - done))
                    if not runs[0][1]:
                        runs.pop(0)
                plan.add(end - done, [plan.take(n, end - done) for n in lengths])
                done = end
        for queue in queues:
            for n, c in queue:
                rest[n] += c
    for n in sorted(rest, reverse=True):
        plan.best_fit(n, rest[n])
    return plan.rows()


def placed(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> DataFrame:
    """`pieces` (with length, part and rank, written somewhere) plus sequence_id and offset.

    No sequence holds more than `capacity` tokens; its pieces lie without gaps
    from 0. Pieces are numbered per length by adding up what the tasks before
    them saw, so pieces of one length need not meet. The driver gets one count
    per length and sends back the plan, both bounded by the capacity.
    """
    spark = pieces.sparkSession
    seen = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(seen.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "starts")
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        packing_plan(counts, capacity, groups, small), "length long, first long, number long, sequence long, offset long"
    )
    names = [c for c in pieces.columns if c not in ("part", "rank")]
    at = F.col("rank") + F.col("before")
    inside = (at >= F.col("first")) & (at < F.col("first") + F.col("number"))
    numbered = pieces.join(starts.select("length", "part", "before"), ["length", "part"])
    return numbered.alias("p").join(F.broadcast(plan.withColumnRenamed("length", "of")), (F.col("length") == F.col("of")) & inside).select(
        *names, (F.col("sequence") + at - F.col("first")).alias("sequence_id"), "offset"
    )


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece of `docs` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null and empty texts are one piece of one id; a null doc_id stays null; rows
    that repeat are packed as often as they stand; other columns are ignored; no
    rows give no rows.
    """
    pieces = token_pieces(docs, tokenizer, capacity).withColumn("ids_crc32", F.crc32("ids"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return placed(materialise(pieces.select(*columns, "part", "rank"), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each sequence, from `packed_documents` with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")
    )
