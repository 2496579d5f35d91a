"""Runs by maximal pairs against all periods of all stretches."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periods


def brute_runs(words, least=6, repeats=4):
    """Stretches with a period, for every period and place; the smallest period of each."""
    found = {}
    for p in range(1, len(words) // repeats + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, repeats * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def got_runs(texts, least=6, repeats=4):
    """Runs of all texts in one go, each numbered from its text's first word."""
    words = np.array([hash(w) % (1 << 62) for t in texts for w in t], np.uint64)
    number = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first = np.cumsum([0, *map(len, texts)])
    out = [[] for _ in texts]
    for s, n, p in periods.runs_of(words, number, least, repeats).tolist():
        k = int(np.searchsorted(first, s, "right")) - 1
        out[k].append((s - int(first[k]), n, p))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.lists(st.sampled_from("ab"), max_size=40), st.lists(st.sampled_from("abc"), max_size=60),
    st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=5), st.integers(1, 12), st.lists(st.sampled_from("abcd"), max_size=4)).map(lambda x: x[2] + x[0] * x[1] + x[2]),
), max_size=4), st.sampled_from([(6, 4), (2, 2), (5, 3), (9, 2)]))
def test_runs_of_any_texts(texts, limits):
    texts = [t for t in texts if t]
    assert got_runs(texts, *limits) == [brute_runs(t, *limits) for t in texts]


def test_runs_of_long_texts():
    rng = random.Random(3)
    texts = [["on"] * 3000, list("ab") * 900]
    for _ in range(20):
        words = [f"w{rng.randrange(50)}" for _ in range(300)]
        for _ in range(4):
            a, p = rng.randrange(len(words)), rng.randrange(1, 40)
            words[a:a] = words[a:a + p] * rng.randrange(2, 9)
        texts.append(words)
    assert got_runs(texts) == [brute_runs(t) for t in texts]


def test_many_equal_lines_with_different_first_words():
    words = [x for k in range(3000) for x in (f"n{k}", "a", "b", "a", "b", "a", "b", "a", "b")]
    assert got_runs([words])[0] == [(9 * k + 1, 8, 2) for k in range(3000)]


def words_of(text):
    return (text or "").encode().split()


def digest(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def test_query_against_brute_force(spark, tmp_path):
    from tidemark.llm.queries import REGISTRY

    rng = random.Random(8)
    texts = [None, "", "  \n", "one", "x " * 70, "a b c a b c a b c a b c", "été\t" * 6 + " z", "a b c a b c a b c a b"]
    texts += [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 200))) for _ in range(150)]
    texts += ["no run here " + "tick tock " * 5000]
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)] + [(None, "x " * 9, "x", 1), (4, texts[4], "y", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int").write.parquet(str(tmp_path / "documents.parquet"))
    out = REGISTRY["op11_periodic_runs"](spark, str(tmp_path)).collect()
    want = []
    for doc_id, text, *_ in rows:
        words, h = words_of(text), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = brute_runs(words)
        gone = {i for s, m, p in runs for i in range(s + p, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     digest("".join(f"{s},{m},{p}\n" for s, m, p in runs)), digest(b" ".join(w for i, w in enumerate(words) if i not in gone))))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    assert sum(r.n_runs for r in out) > 5


def test_no_rows_and_bad_limits(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert periods.repeated_runs(none).count() == 0
    with pytest.raises(ValueError):
        periods.repeated_runs(none, repeats=1)
