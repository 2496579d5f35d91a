"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, no rows, clashing columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, mixing, neardup, packing, quality, substrings, topk, toxicity, urls, warc
from tidemark.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    passage = prose(2, 50)
    return [
        None, "", " \n\t ", "one", "one two three four", base, base, " ".join(near), base.upper(), prose(3, 60) + "\n" + passage + "\n" + prose(4, 60),
        prose(5, 70) + " " + passage, prose(6, 34), prose(7, 3000), ("on " * 300).strip(), "line a b\nline a b\n\n" + prose(8, 90),
        "one two three four", "#$ %% " + prose(9, 80),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, [None, "en", "de"][k % 3], [None, "s1", "s2", "s10"][k % 4], None) for k, t in enumerate(texts)]
    rows += [(None, "no id here at all", "en", "s1", 3), (16, texts[16], "en", "s1", 3)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return WORD.findall(text or "")


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(30)] + [(None, 1), (3, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_against_all_pairs(spark, docs, texts, none):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = words((t or "").translate(low))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    least = list(range(len(sets)))
    for _ in sets:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    least[a] = min(least[a], least[b])
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), least[r.doc_id], least[r.doc_id] == r.doc_id)
    assert least[7] == least[6] == least[8] == 5
    assert neardup.near_duplicates(none).count() == 0
    assert neardup.without_near_duplicates(docs).columns == docs.columns


def brute_cut(texts, size=35):
    starts = Counter(tuple(w[k:k + size]) for w in map(words, texts) for k in range(len(w) - size + 1))
    out = []
    for w in map(words, texts):
        gone = {j for k in range(len(w) - size + 1) if starts[tuple(w[k:k + size])] > 1 for j in range(k, k + size)}
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_repeats_against_all_windows(spark, texts, none):
    many = texts + [prose(2, 50) + f" {k}" for k in range(30)] + [texts[5]] * 20
    rows = spark.createDataFrame(list(enumerate(many)), "kept_text long, text string").withColumn("_id", F.lit(1))
    got = {r._c: (r.n_words, r.n_removed, r.kept_text) for r in substrings.repeats_removed(rows.withColumnRenamed("kept_text", "_c")).collect()}
    assert [got[k] for k in range(len(many))] == brute_cut(many)
    kept = substrings.without_repeats(spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, n_chars int"))
    want = brute_cut(texts)
    for r in kept.collect():
        cut = want[r.doc_id][1] > 0
        assert r.text == (want[r.doc_id][2] if cut else texts[r.doc_id]) and r.n_chars == (len(r.text) if cut else 7)
    assert substrings.repeats_removed(none).count() == 0


@pytest.mark.parametrize("most", [1, 3, 40])
def test_frequent_prefixes_are_made_longer(spark, most):
    rng = random.Random(8)
    passage = prose(80, 60)
    many = [" ".join([prose(1000 + k, rng.randrange(40), 9), passage, prose(2000 + k, rng.randrange(40), 9)]) for k in range(50)]
    many += ["the " * 300, "the " * 34, "the " * 36 + "end", passage, passage, " ".join(passage.split()[:35]), None, ""]
    rows = spark.createDataFrame(list(enumerate(many)), "k long, text string").repartition(5)
    got = {r.k: (r.n_words, r.n_removed, r.kept_text) for r in substrings.repeats_removed(rows, most=most).collect()}
    assert [got[k] for k in range(len(many))] == brute_cut([t or "" for t in many])


def suffix_rows(texts, level=0):
    found = substrings.Suffixes(pa.array(texts), 35, 8)
    keys = np.unique(np.concatenate([found.of(k, 0)[0] for k in range(len(texts))]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array(range(len(texts)), pa.int64()), pa.array([1] * len(texts), pa.int64()), pa.array([keys] * len(texts))], ["_text", "_id", "copies", "chosen"],
    )
    table = pa.Table.from_batches(substrings._suffix_reader(35, 8, level)(iter([batch])))
    return table.sort_by("key").combine_chunks().to_batches()[0]


@pytest.mark.parametrize("size", [1, 2, 7, 10000])
@pytest.mark.parametrize("level", [0, 1])
def test_subtrees_over_batches_of_any_size(size, level):
    texts = [prose(5, 20) + " " + prose(6, 50 + k) + " " + prose(7 + k, 40) for k in range(6)] + ["a b " * 60, prose(1, 30)]
    rows = suffix_rows(texts, level)
    got = {k: set() for k in range(len(texts))}
    for batch in substrings._subtrees(35, 8)(rows.slice(s, size) for s in range(0, rows.num_rows, size)):
        for r in batch.to_pylist():
            got[r["text_id"]] |= set(r["places"])
    windows = [[tuple(w[k:k + 35]) for k in range(len(w) - 34)] for w in map(words, texts)]
    starts = Counter(x for w in windows for x in w)
    assert got == {k: {j for j, x in enumerate(w) if starts[x] > 1} for k, w in enumerate(windows)}


def test_tree_nodes():
    tree = substrings.Tree(np.array([[1, 2, 3], [1, 2, 4], [2, 2, 3], [1, 2, 3]], np.uint64))
    alike = lambda depth: [[int(a == b) for b in tree.nodes(depth)] for a in tree.nodes(depth)]
    assert alike(0) == [[1] * 4] * 4
    assert alike(2) == [[1, 1, 0, 1], [1, 1, 0, 1], [0, 0, 1, 0], [1, 1, 0, 1]]
    assert alike(3) == [[1, 0, 0, 1], [0, 1, 0, 0], [0, 0, 1, 0], [1, 0, 0, 1]]


def test_mixture(spark, docs, none):
    rows = mixing.mixture(docs.withColumn("target", F.lit("x"))).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
        assert r.size == len(words(r.text)) and 0 <= r.copies <= 3
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3 * sizes[s] for s in over}
        free -= over
    target |= share
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)
    again = mixing.mixture(docs.repartition(7)).select("doc_id", "copies")
    assert sorted(map(repr, again.collect())) == sorted(repr(r) for r in mixing.mixture(docs).select("doc_id", "copies").collect())
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mixture(none).count() == 0


def test_packing_round_trip(spark, docs, none):
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(90, prose(20, 4000))], "doc_id long, text string"))
    encode = packing.encoder_of(PATH)
    packed = packing.packed_documents(rows, PATH, with_ids=True)
    got = sorted(packed.collect(), key=lambda r: (r.sequence_id, r.offset))
    whole = {}
    end = {}
    for r in got:
        assert r.offset == end.get(r.sequence_id, 0) and zlib.crc32(r.ids) == r.ids_crc32
        end[r.sequence_id] = r.offset + r.length
        whole.setdefault((r.doc_id, r.piece), []).append(r)
    assert max(end.values()) <= 2048
    long = [r for r in sorted(got, key=lambda r: r.start) if r.doc_id == 90]
    assert np.frombuffer(b"".join(r.ids for r in long), "<u4").tolist() == [*encode(prose(20, 4000)), 0]
    assert all(r.length == 2048 for r in long[1:]) and len(long) > 2
    assert len(whole[(16, 0)]) == 2 and whole[(0, 0)][0].length == 1
    joined = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(packed).collect()}
    assert joined == end
    assert packing.packed_documents(none, PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    counts = Counter(min(2048, max(1, int(rng.lognormvariate(6, 1.2)))) for _ in range(5000))
    rows = packing.packing_plan(counts)
    taken, used = Counter(), {}
    for length, first, number, sequence, offset in rows:
        taken[length] += number
        for s in range(sequence, sequence + number):
            used.setdefault(s, []).append((offset, length))
    assert taken == counts
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(n * c for n, c in counts.items())
    assert len(used) <= 1.03 * -(-total // 2048) + 2


def test_top_k_against_all_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (rng.standard_normal(8) if k % 7 else np.ones(8)).tolist()) for k in range(300)]
    rows += [(400, None), (450, [1.0, None]), (500, [float("nan")] * 8), (550, [float("inf")] * 8), (600, [2.0]), (650, []), (None, [9.0]), (1, rows[1][1]), (50, rows[50][1]), (50, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("score", F.lit(2))
    vectors = topk.whole_vectors(df)
    got = topk.exact_top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5).collect()
    whole = [(k, np.floor(256 * np.pad(np.array(v), (0, 8 - len(v)))).astype(int)) for k, v in rows if k is None or k < 400 or k in (600, 650)]
    want = Counter()
    for at, (q, v) in enumerate(whole):
        if q is not None and q % 50 == 0:
            best = sorted((-int(v @ w), c is None, c or 0) for k, (c, w) in enumerate(whole) if k != at)[:5]
            want.update((q, n, None if none else c, -s) for n, (s, none, c) in enumerate(best, 1))
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    assert topk.exact_top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_segment_bounds_prune_and_lose_nothing():
    """Clustered vectors: few pairs are left for exact scores, the best among them; on noise most are left, and the best too."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 64)).cumsum(1)
    for x, share in ((centres[rng.integers(0, 40, 4000)] + 0.1 * rng.standard_normal((4000, 64)), 0.1), (rng.standard_normal((4000, 64)), 1.0)):
        x = np.floor(256 * x).astype(np.int64)
        q, numbers = x[::50], np.arange(len(x))
        beat = topk.seed_scores(q, numbers[::50], x[:1000], numbers[:1000], 5)
        (a, b, scores), left = topk.best_of_block(q, numbers[::50], x, numbers, beat, 5, topk.LEVELS)
        top = topk._best(a, b, np.zeros(len(b), bool), scores, 5)
        want = [sorted((-int(s), c) for c, s in enumerate(row) if c != 50 * k)[:5] for k, row in enumerate(q @ x.T)]
        assert [list(zip((-scores[top[a[top] == k]]).tolist(), b[top[a[top] == k]].tolist())) for k in range(len(q))] == want
        assert sorted(left, reverse=True) == left and left[-1] <= share * len(q) * len(x)


def test_archives_round_trip(spark):
    long = "<p>" + prose(30, 9000)
    rows = [(1, "http://a/1", "x"), (2, "http://a/2", "x"), (3, None, "x"), (4, "u\r\nWARC/1.1", None), (5, "u", ""), (6, "u", long), (7, "u", long),
            (8, "u", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (None, "u", "y"), (10, "u", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = warc.write_archives(pages, chunk=1000)
    chunks = warc.read_chunks(spark, folder)
    got = {r.page_id: r for r in warc.page_records(chunks).collect()}
    first = {"x": 3, "": 5, long: 7}
    for page, _, html in rows:
        body = (html or "").encode()
        r = got[page]
        assert r.intact and r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        of = first.get(html or "")
        assert r.refers_to == (of if page is not None and of and page < of else None)
        assert r.record_type == ("revisit" if r.refers_to else "response")
    parts = sorted((r.chunk_no, bytes(r.chunk)) for r in chunks.filter("page_id = 7").collect())
    assert len(parts) > 10 and b"".join(p for _, p in parts).decode() == long and max(len(p) for _, p in parts) == 1000
    small = warc.page_records(warc.read_chunks(spark, warc.write_archives(pages, least_bytes=2))).filter("record_type = 'revisit'").collect()
    assert [r.page_id for r in small] == [6]
    assert warc.read_chunks(spark, warc.write_archives(pages.limit(0))).count() == 0


def test_long_rows_with_one_page_id_or_none_stay_apart(spark):
    long, other = "<p>" + prose(70, 900), "<q>" + prose(71, 800)
    rows = [(9, "u", long), (9, "u", long), (3, "u", long), (None, "u", long), (None, "u", other), (None, "u", other), (None, "v", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    chunks = warc.read_chunks(spark, warc.write_archives(pages, chunk=500))
    got = warc.page_records(chunks).collect()
    of = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert Counter((r.page_id, r.payload_digest) for r in got) == Counter((p, of(t)) for p, _, t in rows)
    assert all(r.intact for r in got)
    assert [r.refers_to for r in got if r.page_id == 3] == [9]
    assert chunks.filter("page_id IS NULL").select("record_id").distinct().count() == 4


def test_url_rules(spark):
    rows = [
        (0, "http://x.net/a", "net/", "block"), (1, "https://A.Example.NET/en/x?q#f", "example.net/en/", "allow"), (2, "http://example.net/fr", "net/", "block"),
        (3, "http://x.net?a", None, "allow"), (4, None, None, "allow"), (5, "no scheme", None, "allow"), (6, "http://b.org/fr/", "org/fr/", "allow"),
        (7, "https://www.bad.com/p/?u=1", None, "block"), (8, "ftp://bad.com/p#x", None, "block"), (9, "http://bad.com/pp", None, "allow"),
        (10, "http://notexample.com/de/", None, "allow"), (11, "x://m.example.com/de/1", "example.com/de/", "block"), (11, "x://m.example.com/de/1", "example.com/de/", "block"),
    ]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").withColumn("host", F.lit(5)).withColumn("lane1", F.lit("z"))
    pages = pages.drop("lane1")
    listed = spark.createDataFrame([("http://bad.com/p",), ("http://bad.com/p",), (None,), ("nothing",)], "url string")
    got = urls.judged_urls(pages, listed).select("page_id", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], r[2], r[3]) for r in rows), key=repr)
    assert urls.judged_urls(pages.limit(0), listed).count() == 0 and urls.judged_urls(pages, listed.limit(0)).filter("verdict = 'block' AND rule IS NULL").count() == 0


def test_filter_of_any_size_leaves_the_verdicts_alike(spark):
    """A listed url decides for itself alone, not for its host; a filter of one block passes much, one by shuffle as much as a broadcast one."""
    of = lambda k: f"http://h{k % 9}.com/p/{k}"
    pages = spark.createDataFrame([(k, of(k % 300)) for k in range(600)] + [(None, None), (700, None), (701, "net")], "page_id long, url string")
    listed = spark.createDataFrame([(of(k),) for k in range(0, 300, 3)], "url string")
    for most in (0, urls.BROADCAST_BLOCKS):
        got = urls.judged_urls(pages, listed, broadcast_blocks=most).collect()
        assert len(got) == 603
        for r in got:
            assert r.verdict == ("block" if r.url and "://" in r.url and int(r.url.rsplit("/", 1)[1]) % 3 == 0 else "allow")
    assert [urls.n_blocks(n) for n in (0, 1, 16, 17, 33, 10**8)] == [1, 1, 1, 2, 4, 1 << 23]


def test_divergence_counts(spark, docs, texts, none):
    odd = ["a b c a b c", "x x x x", "a b c d a b c e a b", prose(40, 200, 12), ("p q r " * 40).strip()]
    rows = spark.createDataFrame(list(enumerate(texts + odd)), "doc_id long, text string").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en")).withColumn("n_words", F.lit("clash"))
    for r in divergence.judged_texts(rows).collect():
        text = (texts + odd)[r.doc_id] or ""
        w, again = words(text), Counter()
        again.update(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if again[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert divergence.judged_texts(none).count() == 0


def test_divergence_drops_what_is_far(spark):
    rng = random.Random(3)
    common = divergence.COMMON_WORDS["en"]
    plain = [" ".join(rng.choice(common) if rng.random() < 0.4 else f"word{'abcdefgh'[rng.randrange(8)]}" + "xyz"[rng.randrange(3)] for _ in range(400)) for _ in range(30)]
    shout = " ".join(w.upper() + "!!" for w in prose(50, 400).replace("w", "QX").split())
    rows = spark.createDataFrame([(k, t, "en") for k, t in enumerate([*plain, shout])], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in divergence.judged_texts(rows).collect()}
    assert not kept[30]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    rows = []
    for k in range(400):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 200))]
        if k % 4 == 0:
            for _ in range(3):
                w[rng.randrange(len(w))] = "zorg" + rng.choice("abcdefgh") + rng.choice("xyz")
        if k % 5 == 0:
            w = [x + "%%" for x in w]
        rows.append((k, " ".join(w), int(k % 5 != 0), int(k % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(1000, None), (1001, ""), (None, "w1 w2"), (1002, "w1 " * 50_000)], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2], r[3]) for r in rows] + [(None, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")


def accuracy(scores, labels, name, at):
    rows = scores.join(labels.dropDuplicates(["doc_id"]), "doc_id").filter("doc_id % 3 = 1").collect()
    assert rows
    return sum((r.score >= at) == bool(r[name]) for r in rows) / len(rows)


def test_toxicity_on_held_out_rows(labelled, none):
    docs, labels = labelled
    scores = toxicity.toxicity(docs.withColumn("score", F.lit("clash")), labels.filter("doc_id % 3 <> 1"))
    assert scores.count() == docs.count() and accuracy(scores, labels, "toxic", 0.7) > 0.95
    assert all(0 <= r.score <= 1 for r in scores.collect())
    assert {r.score for r in scores.filter("doc_id IN (1000, 1001)").collect()} == {0.0}
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(docs, labels.filter("toxic = 0")).collect()} == {0.0}


def test_toxic_stem_after_64_bytes_of_a_word():
    known = np.zeros(1 << toxicity.GRAM_BITS)
    known[toxicity.words_of(toxicity.batch_of(pa.array(["zorg"]))).grams[1]] = 5
    model = toxicity.Model(np.zeros(1 << toxicity.WORD_BITS), known)
    for n in (*range(0, 140), 1000, 20_000):
        for text, most in (("q_" * (n // 2) + "-" * (n % 2) + "zorg_" + "q" * 100, 5), ("q_" * (n // 2) + "-" * (n % 2) + "zor_" + "q" * 100, 0)):
            batch = toxicity.in_pieces(toxicity.batch_of(pa.array([text])))
            assert model.evidence_of(toxicity.words_of(batch))[:, 1].max() == most


def test_a_passage_scores_alike_at_all_offsets():
    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.standard_normal(1 << toxicity.WORD_BITS), rng.standard_normal(1 << toxicity.GRAM_BITS))
    passage = prose(60, 30)
    texts = [("the " * (100 + k)) + passage + " the" * (130 - k) for k in range(24)] + ["", "the", passage, prose(61, 32), prose(62, 33)]
    batch = toxicity.in_pieces(toxicity.batch_of(pa.array(texts)))
    got, words = model.scores(batch), toxicity.words_of(batch)
    for k in range(len(texts)):
        low, high = batch.first[k], batch.first[k + 1]
        starts = np.arange(low, max(low + 1, high - toxicity.WINDOW + 1)) if high > low else np.zeros(0, int)
        want = model.window_logits(words, starts, np.minimum(starts + toxicity.WINDOW, high)).max(initial=-np.inf)
        assert got[k] == pytest.approx(want, abs=1e-4)
    assert np.ptp(got[:24]) < 1e-4


def test_pieces_hold_every_gram():
    texts = [prose(50, 300).replace(" ", "_"), "short", "a" * 64, "b" * 65, None, "\u6bd2" * 500, "x" * 112 + "end y"]
    batch = toxicity.in_pieces(toxicity.batch_of(pa.array(texts)))
    for k, text in enumerate(texts):
        own = range(batch.first[k], batch.first[k + 1])
        pieces = [batch.data[batch.starts[j]:batch.ends[j]].tobytes() for j in own]
        assert all(len(p) <= 64 for p in pieces)
        for w in (text or "").encode().split():
            assert all(any(w[i:i + 4] in p for p in pieces) for i in range(max(1, len(w) - 3)))
    assert len(toxicity.words_of(batch).place) == len(batch.starts)


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    model = toxicity.Model(np.zeros(1 << toxicity.WORD_BITS), np.zeros(1 << toxicity.GRAM_BITS))
    for k in ("w", "u", "c"):
        setattr(model, k, {d: v.astype(np.float64) for d, v in getattr(model, k).items()})
    table, mask = rng.standard_normal((5, 3, toxicity.INPUTS)), np.array([[1, 1, 1]] * 3 + [[1, 0, 1], [1, 0, 0]], float)
    label, buckets = np.array([1.0, 0, 1]), np.zeros((5, 3), np.int64)

    def loss():
        p = toxicity.sigmoid(model.run({d: table @ model.w[d] + model.c[d] for d in "fb"}, mask).astype(float))
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    grads = model._gradients(table, {d: table @ model.w[d] + model.c[d] for d in "fb"}, mask, label, buckets)
    for w, g in list(zip(model.weights(), grads))[1:]:
        at = tuple(rng.integers(0, n) for n in w.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = loss()
        w[at] = old - 1e-2
        down = loss()
        w[at] = old
        assert (up - down) / 2e-2 == pytest.approx(float(g[at]), rel=0.05, abs=2e-4)


def test_quality_on_held_out_rows(labelled, none):
    docs, labels = labelled
    scores = quality.quality(docs, labels.filter("doc_id % 3 <> 1"))
    assert scores.count() == docs.count() and accuracy(scores, labels, "quality", 0.3) > 0.9
    assert all(0 <= r.score <= 1 for r in scores.collect())
    assert quality.quality(none, labels).count() == 0
    assert {r.score for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("group_bytes,share_bytes", [(1 << 20, 1 << 20), (20_000, 10_000), (2_000, 500)])
def test_word_sums_are_those_of_single_words(spark, monkeypatch, group_bytes, share_bytes):
    texts = [prose(40 + k, 300, 30_000) for k in range(40)] + ["alone", None, "on on on"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    vocabulary = sorted({w for t in texts for w in words(t)})
    assert len(vocabulary) > 8192
    hashes = quality.batch_of(pa.array([" ".join(vocabulary)])).hashes()
    index = dict(zip(vocabulary, quality.index_vectors(hashes).astype(int)))
    want = {w: np.zeros(quality.DIMS, int) for w in vocabulary}
    for t in texts:
        w = words(t)
        for i, one in enumerate(w):
            for j in range(max(0, i - quality.REACH), min(len(w), i + quality.REACH + 1)):
                if i != j:
                    want[one] += index[w[j]]
    monkeypatch.setattr(quality, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(quality, "SHARE_BYTES", share_bytes)
    size = sum(len(t or "") for t in texts)
    name = quality.grouped_texts(docs, size)
    groups, word_of = spark.table(name), dict(zip(hashes.tolist(), vocabulary))
    held = {}
    for r in groups.collect():
        held.setdefault(r.group, set()).update(words(r.text))
    shared = {(g, w) for g, some in held.items() for w in some if any(w in other for h, other in held.items() if h != g)}
    got = {}
    for r in quality.word_totals(groups, size).collect():
        of_group = np.sort(np.array([h for h, w in word_of.items() if w in held[r.group]], np.uint64))
        for h, sums in zip(of_group[quality.unpacked_words(r.places).astype(int)].tolist(), quality.unpacked_sums(r.sums)):
            assert (r.group, h) not in got
            got[r.group, h] = sums
            assert (sums == want[word_of[h]]).all()
    assert {(g, word_of[h]) for g, h in got} == shared  # no word of one group alone has moved
    spark.sql(f"DROP TABLE {name}")
    for r in quality.text_features(docs).collect():
        rows = quality.unit(np.array([want[w] for w in words(texts[r.doc_id])]).reshape(-1, quality.DIMS)).astype(float)
        whole = np.concatenate([rows.mean(0), rows.std(0)]) if len(rows) else np.zeros(2 * quality.DIMS)
        assert np.allclose(np.frombuffer(r.features, "<f4"), whole, atol=1e-5)


@pytest.mark.parametrize("held", [5, 1 << 18])
def test_shared_prefixes_are_sent_once_a_block(spark, monkeypatch, held):
    """A prefix that all texts have is a row's entry for each block of texts, not a row for each text."""
    from tidemark.llm import substrings

    monkeypatch.setattr(substrings, "KEYS_HELD", held)
    texts = [(k, 1 + k % 2, [7, k % 9 - 4, 100 + k], [1, 2 if k == 5 else 1, 1]) for k in range(60)] + [(60, 1, [500], [2]), (61, 3, [], [])]
    classes = spark.createDataFrame(texts, "text_id long, copies long, keys array<long>, counts array<int>")
    all_ = Counter()
    for _, _, keys, counts in texts:
        for key, n in zip(keys, counts):
            all_[key] += n
    want = {}
    for text_id, copies, keys, _ in texts:
        fit, longer = [k for k in keys if 1 < all_[k] <= 10], [k for k in keys if all_[k] > 10]
        if fit or longer:
            want[text_id] = (copies, sorted(fit), sorted(longer))
    found = substrings.shared_prefixes(classes, 10)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.text_id: (r.copies, sorted(r.fit), sorted(r.longer)) for r in found.collect()} == want
    assert substrings.shared_prefixes(classes.limit(0), 10).count() == 0


def test_windows_take_the_states_of_the_next_ones(monkeypatch):
    """The same logits as one window at a time, for fewer steps than one per word and window."""
    from tidemark.llm.words import batch_of

    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 300, n)) for n in (5, 32, 33, 700, 40, 2500)]
    batch = toxicity.in_pieces(batch_of(pa.array(texts, pa.large_string())))
    words = toxicity.words_of(batch)
    model = toxicity.Model(rng.standard_normal(1 << toxicity.WORD_BITS).astype("f4"), rng.standard_normal(1 << toxicity.GRAM_BITS).astype("f4"))
    for d in "fb":
        model.c[d][:toxicity.HIDDEN] = 4  # states that forget
    starts = [np.arange(a, max(a, b - toxicity.WINDOW + 1)) for a, b in zip(batch.first[:-1], batch.first[1:])]
    want = [model.window_logits(words, s, s + toxicity.WINDOW).max() if len(s) else -np.inf for s in starts]

    class Counting:
        steps = 0

        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, x, **settings):
            Counting.steps += x.size
            return np.exp(x, **settings)

        def tanh(self, x, **settings):
            Counting.steps += x.size
            return np.tanh(x, **settings)

    monkeypatch.setattr(toxicity, "np", Counting())
    for most in (16384, 300):
        Counting.steps = 0
        assert np.allclose(model.slid_logits(words, batch.first, most), want, atol=1e-4)
        every = 2 * toxicity.WINDOW * 3 * toxicity.HIDDEN * len(words.place)
        assert Counting.steps < 0.8 * every


def test_small_partitions_make_one_group(spark):
    """Words of texts from many small files travel no further than the group that holds all texts."""
    texts = [(k, " ".join(f"w{k * i % 50}" for i in range(30))) for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    size = sum(len(t) for _, t in texts)
    name = quality.grouped_texts(docs, size)
    try:
        groups = spark.table(name)
        assert groups.select("group").distinct().count() == 1
        assert groups.count() == 40
        assert quality.word_totals(groups, size).count() == 0
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_totals_of_words_of_many_groups_come_once(spark, monkeypatch):
    """What comes back for words that at least half of the groups have doesn't grow with the groups; features need no more."""
    rng = random.Random(3)
    common = [f"c{k}" for k in range(400)]
    texts = [" ".join([*rng.sample(common, 400), *(f"own{j}x{k}" for k in range(20)), *(f"some{j % 9}x{k}" for k in range(20))]) for j in range(36)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(quality, "GROUP_BYTES", 2_000)
    monkeypatch.setattr(quality, "SHARE_BYTES", 20_000)
    size = sum(map(len, texts))
    name = quality.grouped_texts(docs, size)
    groups = spark.table(name)
    n = groups.select("group").distinct().count()
    assert n > 20 and groups.filter("first").count() == n
    whole, once = quality.word_totals(groups, size).collect(), quality.word_totals(groups, size, n // 2).collect()
    spark.sql(f"DROP TABLE {name}")
    want, seen = {}, 0
    for r in whole:
        want.setdefault(r.group, {}).update(zip(quality.unpacked_words(r.places).tolist(), quality.unpacked_sums(r.sums).tolist()))
    everywhere = {r.share: quality.unpacked_sums(r.sums).tolist() for r in once if r.group == quality.EVERY_GROUP}
    assert sum(map(len, everywhere.values())) == len(common)
    for r in once:
        if r.group != quality.EVERY_GROUP:
            got = dict(zip(quality.unpacked_words(r.places).tolist(), quality.unpacked_sums(r.sums).tolist()))
            got.update((p, everywhere[r.share][a]) for p, a in zip(quality.unpacked_words(r.often).tolist(), quality.unpacked_words(r.at).tolist()))
            assert all(want[r.group].get(p) == s for p, s in got.items())
            seen += len(got)
    assert seen == sum(map(len, want.values()))
    assert sum(len(r.sums) for r in once if r.sums) < 0.4 * sum(len(r.sums) for r in whole)


def test_packed_sums_take_few_bits():
    rng = np.random.default_rng(1)
    rare = rng.integers(-1, 2, (4000, quality.DIMS)) * rng.integers(0, 2, (4000, quality.DIMS))
    wide = np.concatenate([rare, rng.integers(-9, 9, (50, quality.DIMS)), rng.integers(-1 << 45, 1 << 45, (50, quality.DIMS)), np.zeros((3, quality.DIMS), int)])
    for sums in (wide[rng.permutation(len(wide))], wide[:1], wide[:0], wide[-3:]):
        assert (quality.unpacked_sums(quality.packed_sums(sums)) == sums).all()
    mixed = np.concatenate([rare, rng.integers(-3000, 3000, (400, quality.DIMS))])
    assert len(quality.packed_sums(mixed)) < len(quality.packed_sums(rare)) + 400 * quality.DIMS * 2 + 1000
    assert len(quality.packed_sums(rare)) < 4000 * quality.DIMS * 1.6 / 8


def test_sums_and_features_of_long_texts(monkeypatch):
    """Frequent words and texts longer than a block, beside texts of one word and without any."""
    monkeypatch.setattr(quality, "BLOCK", 100)
    texts = ["w " * 1500, "", "a", " ".join(f"v{k % 37}" for k in range(700)), "a b", "w v1 w"]
    batch = quality.batch_of(pa.array(texts))
    names = sorted({w for t in texts for w in words(t)}, key=lambda w: quality.batch_of(pa.array([w])).hashes()[0])
    hashes = quality.batch_of(pa.array(names)).hashes()
    index, want = quality.index_vectors(hashes).astype(int), np.zeros((len(names), quality.DIMS), int)
    for t in texts:
        w = [names.index(x) for x in words(t)]
        for i, one in enumerate(w):
            want[one] += sum(index[w[j]] for j in range(max(0, i - quality.REACH), min(len(w), i + quality.REACH + 1)) if i != j)
    wanted, got = np.array([n != "a" for n in names]), np.zeros((len(names) - 1, quality.DIMS), np.int32)
    quality._add_group_sums(pa.table({"text": texts}), hashes, wanted, got)
    assert (got == want[wanted]).all()
    vectors = quality.unit(want)
    _, place, _, _ = quality._located(batch.hashes())
    features = quality.pooled(batch, place, vectors)
    for t, f in zip(texts, features):
        rows = vectors[[names.index(x) for x in words(t)]].astype(float).reshape(-1, quality.DIMS)
        assert np.allclose(f, np.concatenate([rows.mean(0), rows.std(0)]) if len(rows) else np.zeros(2 * quality.DIMS), atol=1e-5)
