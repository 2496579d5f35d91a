"""Runs of repeated word groups in whole texts, by maximal pairs of an LCP-interval tree.

A run of period p from word i on is a maximal pair: the words from i and those
from i + p agree for l words, and differ just before and just after. So pairs of
equal stretches whose distance is at most a (REPEATS - 1)-th of their length are
the runs, with nothing left to extend.

Per text the suffixes that can take part are sorted, and their LCP-interval tree
is walked from the deepest intervals up. An interval carries the places of its
suffixes in lists by left word: lists of one and the same left word are merged
without a look at their pairs, which can't be maximal; else each place that
comes from the smaller list meets its neighbours in the larger one. Neighbours
are enough: a third occurrence between the two of a pair that overlap so much
would mean a shorter period of the whole run.

A suffix can take part only if the nearest other place of its first words is
near against its longest common prefix with any other suffix. Texts without
such places, nearly all prose, are done after one sort of their grams.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.words import batch_of, slices, text_rows, window_sums

LEAST, REPEATS = 6, 4  # words in a run, and whole periods in it
SLICE_BYTES = 1 << 20
RUN = "struct<start:long,length:long,period:long>"


def ranked(words: np.ndarray) -> list[np.ndarray]:
    """Ranks of the stretches of 1, 2, 4, ... words from each place, until all differ. `words` must end in a unique one."""
    levels = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
    size, n = 1, len(words)
    while levels[-1].max(initial=0) + 1 < n:
        after = np.full(n, -1, np.int64)
        after[:n - size] = levels[-1][size:]
        levels.append(np.unique(levels[-1] * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words two suffixes share, for pairs of different places."""
    done, n = np.zeros(len(a), np.int64), len(levels[0])
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + done, b + done
        inside = (x < n) & (y < n)
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        done += np.where(same, 1 << k, 0)
    return done


def nearest_equal(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Per key the distance from its place (ascending) to the nearest other place with the same key; 0 for none."""
    order = np.argsort(keys, kind="stable")
    near, far = np.zeros(len(keys), np.int64), np.iinfo(np.int64).max
    same = keys[order[1:]] == keys[order[:-1]]
    steps = np.where(same, places[order[1:]] - places[order[:-1]], far)
    least = np.minimum(np.append(steps, far), np.insert(steps, 0, far))
    near[order] = np.where(least == far, 0, least)
    return near


def _merged(low: list, high: list, lefts: list, depth: int, most: int, out: list) -> list:
    """Two lists of places (left word or -1 for several, places in order), whose suffixes share `depth` words and no more."""
    if len(low[1]) > len(high[1]):
        low, high = high, low
    few, many = low[1], high[1]
    one_class = low[0] == high[0] and low[0] >= 0
    if not one_class:
        for place in few:
            at = bisect_left(many, place)
            for other in many[max(0, at - 1):at + 1]:
                if abs(place - other) <= most and lefts[place] != lefts[other]:
                    out.append((min(place, other), depth, abs(place - other)))
    if 8 * len(few) > len(many):
        many = sorted(many + few)
    else:
        for place in few:
            insort(many, place)
    return [low[0] if one_class else -1, many]


def maximal_pairs(places: np.ndarray, shared: np.ndarray, lefts: np.ndarray, least: int, repeats: int) -> list[tuple[int, int, int]]:
    """(first place, common words, distance) of the maximal pairs that are runs.

    `places` are suffixes in order, `shared` the words each has in common with
    the next one, `lefts` the word before each place.
    """
    out: list[tuple[int, int, int]] = []
    lefts_of = dict(zip(places.tolist(), lefts.tolist()))
    stack: list[tuple[int, list]] = []  # depth at which a list meets what comes before it
    depths = shared.tolist()
    for k, place in enumerate(places.tolist()):
        current = [lefts_of[place], [place]]
        depth = depths[k] if k < len(depths) else 0
        while stack and stack[-1][0] >= depth:
            above, before = stack.pop()
            if above + above // (repeats - 1) < least:
                # No pair from here up is long enough.
                stack.clear()
                break
            current = _merged(before, current, lefts_of, above, above // (repeats - 1), out)
        if depth:
            stack.append((depth, current))
    return [(at, common, step) for at, common, step in out if common + step >= least]


def runs_of(words: np.ndarray, texts: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Rows (start, length, period) of all runs in a row of words; `texts` numbers the text of each word, ascending.

    Of several periods of one stretch only the smallest is kept. Runs do not
    reach over texts.
    """
    none = np.zeros((0, 3), np.int64)
    # The shortest stretch that a pair of any run has in common.
    gram = min(c for c in range(1, least + 1) if c + c // (repeats - 1) >= least)
    if len(words) <= gram:
        return none
    grams = window_sums(words, gram)
    whole = texts[:len(grams)] == texts[gram - 1:]
    near = np.zeros(len(words), np.int64)
    at = np.flatnonzero(whole)
    # Grams of different texts get different keys, so a gram's twin is in its own text.
    with np.errstate(over="ignore"):
        keys = grams[at] ^ (texts[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    near[at] = nearest_equal(keys, at)
    active = np.unique(texts[near > 0])
    if not len(active):
        return none
    # Only texts with a gram that stands twice go on, each followed by a sign of its own.
    member = np.isin(texts, active)
    kept = np.flatnonzero(member)
    number = np.searchsorted(active, texts[kept])
    spot = np.arange(len(kept)) + number
    ids = np.unique(words[kept], return_inverse=True)[1].astype(np.int64)
    line = np.empty(len(kept) + len(active), np.int64)
    ends = np.searchsorted(number, np.arange(len(active)), "right") + np.arange(len(active))
    line[ends] = ids.max() + 1 + np.arange(len(active))
    line[spot] = ids
    before = np.concatenate(([line[-1] + 1], line[:-1]))
    levels = ranked(line)
    gaps = np.zeros(len(line), np.int64)
    gaps[spot] = near[kept]
    candidates = np.flatnonzero(gaps)
    candidates = candidates[np.argsort(levels[-1][candidates], kind="stable")]
    shared = common_prefixes(levels, candidates[:-1], candidates[1:])
    longest = np.maximum(np.append(shared, 0), np.insert(shared, 0, 0))
    alive = (repeats - 1) * gaps[candidates] <= longest
    if alive.sum() < 2:
        return none
    # What two kept suffixes share is the least of what lies between them.
    picked = np.flatnonzero(alive)
    pairs = maximal_pairs(
        candidates[picked], np.minimum.reduceat(shared[:picked[-1]], picked[:-1]), before[candidates[picked]], least, repeats,
    )
    if not pairs:
        return none
    found = np.array(pairs, np.int64)
    found = np.stack((found[:, 0], found[:, 1] + found[:, 2], found[:, 2]), 1)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1])
    found = found[first]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    found[:, 0] = kept[np.searchsorted(spot, found[:, 0])]
    return found



def _collapse(data: bytes, runs: np.ndarray) -> bytes:
    """Words joined by single spaces, without those that a run repeats."""
    words = data.split()
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(compress(words, (np.cumsum(steps[:-1]) == 0).tolist()))


def repeated_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """Per row of `docs`: doc_id, runs (start, length, period; by start, then period), collapsed.

    A run is a stretch of at least `least` words and `repeats` whole periods, as
    long as its smallest period holds. `collapsed` is the words joined by single
    spaces, without those a run has after its first period. Null and empty texts
    have no runs and an empty `collapsed`; a null doc_id stays null; rows that
    repeat stay; other columns are left out. A task holds about 100 bytes for
    each word of its longest text.
    """
    if least < 2 or repeats < 2:
        raise ValueError("a run has two words and two periods at least")
    shape = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, most=SLICE_BYTES):
            batch = batch_of(rows["text"])
            found = runs_of(batch.hashes(), batch.of_text(), least, repeats)
            cuts = np.searchsorted(found[:, 0], batch.first)
            texts = []
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                found[a:b, 0] -= batch.first[k]
                texts.append(_collapse(batch.text(k), found[a:b]))
            fields = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), fields)
            yield pa.RecordBatch.from_arrays([rows["doc_id"], runs.cast(shape), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return text_rows(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, runs array<{RUN}>, collapsed string")
