"""Exact search for the best inner products, with bounds from segment statistics.

A vector cut into segments has, per segment, a mean m and a deviation d. For two
vectors the inner product of a segment of n components is n*m*m' plus that of
the two centred segments, which n*d*d' bounds. In terms of distances this is the
lower bound n*((m-m')^2 + (d-d')^2) of a segment's squared distance. Few wide
segments give a coarse bound cheaply, more and narrower ones a finer bound for
what is left; survivors of all levels are scored exactly. Components are put in
the order of their means over all rows first, so that a segment holds like ones.

The score a row must beat is known before blocks meet: each query has its exact
scores against a fixed number of seed rows, and a block raises it by the rows
with the best coarse bounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

SCALE = 256
LEVELS = (4, 16, 32)  # segments at each resolution, coarse to fine
QUERIES_PER_BLOCK, ROWS_PER_BLOCK = 4096, 1 << 14
SEEDS = 2048  # rows, chosen by hash, that give each query a first score to beat
FOUND = "query_row long, query_id long, vec_id long, score long"


def segment_features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per vector, sqrt(n) * mean and sqrt(n) * deviation of each segment: their products sum to the bound."""
    cuts = np.linspace(0, vectors.shape[1], segments + 1).astype(int)
    parts = [vectors[:, a:b] for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
    if not parts:
        return np.zeros((len(vectors), 1))
    root = [np.sqrt(p.shape[1]) for p in parts]
    return np.stack([r * p.mean(1) for r, p in zip(root, parts)] + [r * p.std(1) for r, p in zip(root, parts)], 1)


def seed_scores(queries: np.ndarray, query_rows: np.ndarray, seeds: np.ndarray, seed_rows: np.ndarray, k: int) -> np.ndarray:
    """For each query its k-th best score among the seeds: a score that its k-th best row reaches. -inf if there are fewer."""
    width = min(queries.shape[1], seeds.shape[1])
    scores = (queries[:, :width] @ seeds[:, :width].T).astype(float)
    scores[query_rows[:, None] == seed_rows[None, :]] = -np.inf
    return np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(queries), -np.inf)


def best_of_block(queries: np.ndarray, query_rows: np.ndarray, rows: np.ndarray, row_numbers: np.ndarray, beat: np.ndarray, k: int, levels: Sequence[int]):
    """((query place, row place, score) of rows that may be among the k best of each query, pairs left after each level).

    `beat` are scores known to be reached by k rows of each query.
    """
    width = max(queries.shape[1], rows.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, rows))
    qf, xf = q.astype(float), x.astype(float)
    # Rounding moves a bound by far less than this share of the vectors' lengths.
    slack = 1e-9 * (1 + np.linalg.norm(qf, axis=1)[:, None] * max(1.0, np.linalg.norm(xf, axis=1).max(initial=0)))
    coarse = segment_features(qf, levels[0]) @ segment_features(xf, levels[0]).T
    own = query_rows[:, None] == row_numbers[None, :]
    coarse[own] = -np.inf
    n = min(len(x), 4 * k + 1)
    near = np.argpartition(-coarse, n - 1, axis=1)[:, :n]
    exact = np.einsum("qd,qnd->qn", q, x[near])
    valid = ~np.take_along_axis(own, near, 1)
    if n >= k:
        beat = np.maximum(beat, np.sort(np.where(valid, exact.astype(float), -np.inf), axis=1)[:, -k])
    a, b = np.nonzero((coarse + slack >= beat[:, None]) & ~own)
    left = [len(a)]
    for segments in levels[1:]:
        bound = segment_features(qf, segments) @ segment_features(xf, segments).T
        keep = bound[a, b] + slack[a, 0] >= beat[a]
        a, b = a[keep], b[keep]
        left.append(len(a))
    scores = np.concatenate([
        np.einsum("ij,ij->i", q[a[s:s + 65536]], x[b[s:s + 65536]]) for s in range(0, len(a), 65536)
    ] or [np.zeros(0, np.int64)])
    keep = scores >= beat[a]
    return (a[keep], b[keep], scores[keep]), left


def _best(of: np.ndarray, ids: np.ndarray, missing: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each `of`, ties to smaller ids, missing ids last."""
    ranked = np.lexsort((ids, missing, -scores, of))
    first = np.searchsorted(of[ranked], of[ranked])
    return ranked[np.arange(len(ranked)) - first < k]


def _matrix(values: pa.Array) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = pc.list_flatten(values).to_numpy(zero_copy_only=False)
    return out


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    """The columns as integers, 0 for null."""
    return [pc.fill_null(table[n].combine_chunks(), 0).to_numpy(zero_copy_only=False) for n in names]


def _vectors(table: pa.Table, order: np.ndarray) -> np.ndarray:
    out = _matrix(table["v"].combine_chunks())
    return np.pad(out, ((0, 0), (0, max(0, len(order) - out.shape[1]))))[:, order]


def _searcher(k: int, levels: Sequence[int], order: np.ndarray):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            (query_rows, beat), (numbers, ids) = _columns(left, "row", "beat"), _columns(right, "row", "vec_id")
            q, x, missing = _vectors(left, order), _vectors(right, order), right["vec_id"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
            step = 128
            for s in range(0, len(q), step):
                (a, b, scores), _ = best_of_block(q[s:s + step], query_rows[s:s + step], x, numbers, beat[s:s + step], k, levels)
                top = _best(a, ids[b], missing[b], scores, k)
                found.append((s + a[top], b[top], scores[top]))
        a, b, scores = (np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (zip(*found) if found else ([], [], [])))
        return pa.table([left["row"].take(pa.array(a)), left["vec_id"].take(pa.array(a)), right["vec_id"].take(pa.array(b)), pa.array(scores)], ["query_row", "query_id", "vec_id", "score"])

    return search


def _seeder(k: int, seeds: np.ndarray, seed_rows: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                rows = batch.slice(s, 1024)
                beat = seed_scores(_matrix(rows["v"]), rows["row"].to_numpy(), seeds, seed_rows, k)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(beat)], [*rows.schema.names, "beat"])

    return score


def whole_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, v): a number for each row, its id, and floor(256 * x) of each component; written once, so that numbers stay."""
    sound = F.col(f"`{vector}`").isNotNull() & F.forall(
        F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return materialise(
        df.filter(sound).select(
            F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").cast("long").alias("vec_id"),
            F.transform(F.col(f"`{vector}`"), lambda x: F.floor(SCALE * x.cast("double"))).alias("v"),
        ),
        "vectors",
    )


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, levels: Sequence[int] = LEVELS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best inner products of each query row.

    `vectors` and `queries` are (row, vec_id, v) as from `whole_vectors`. Both are
    cut into blocks of bounded size by hash, and each task holds one block of
    each. A query leaves k rows per block at most, which are ranked together. A
    query isn't held against its own row, but against others that repeat its id;
    queries that repeat an id have k ranks each. Fewer than k rows give fewer
    ranks. Rows without an id take part and come last among equal scores. Vectors
    that are null or hold null or non-finite components take no part; shorter
    vectors count as filled up with zeros; empty ones score 0.

    To the driver go SEEDS rows, as near as their hashes give, and the mean of
    each component.
    """
    n_rows = vectors.count()
    row_blocks, query_blocks = max(1, -(-n_rows // ROWS_PER_BLOCK)), max(1, -(-queries.count() // QUERIES_PER_BLOCK))
    picked = F.pmod(F.xxhash64(F.lit("seed"), "row"), F.lit(max(1, n_rows // SEEDS))) == 0
    seeds = vectors.filter(picked).select("row", "v").limit(2 * SEEDS).toArrow()
    means = vectors.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("mean")).toArrow()
    order = means["at"].to_numpy()[np.argsort(means["mean"].to_numpy(), kind="stable")]
    seeded = queries.mapInArrow(_seeder(k, _matrix(seeds["v"].combine_chunks()), seeds["row"].to_numpy()), "row long, vec_id long, v array<long>, beat double")
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    left = seeded.withColumn("qb", block(query_blocks)).withColumn("xb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    right = vectors.withColumn("xb", block(row_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    found = left.groupBy("qb", "xb").cogroup(right.groupBy("qb", "xb")).applyInArrow(_searcher(k, levels, order), FOUND)
    by = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
