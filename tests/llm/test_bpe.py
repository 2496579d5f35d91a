"""Tree encoding against tiktoken on whole texts."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WHOLE = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}).encode_ordinary
CODECS = {leaf: bpe.Codec(PATH, True, leaf) for leaf in (1, 2, 3, 7, 40)}
SAFE_ONLY = bpe.Codec(PATH, False, 2)


def test_merges_make_every_token():
    assert bpe.all_by_merges(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aabcelrstv'  \n\t.!9é字 😀́", max_size=90), st.sampled_from(sorted(CODECS)))
def test_tree_equals_whole(text, leaf):
    ids = CODECS[leaf].encode(text)
    assert list(ids) == WHOLE(text)
    assert list(SAFE_ONLY.encode(text)) == WHOLE(text)
    assert CODECS[leaf].decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_characters(text):
    assert list(CODECS[2].encode(text)) == WHOLE(text)


@pytest.mark.parametrize("text", [
    "a" * 5001, " " * 5001, " " * 4000 + "x", "it'll they're o'clock 'tis" * 90, "ab" * 3001, "字" * 2500, "9" * 4099, "!" * 4097 + "'s", "'" * 999 + "ll",
    "😀" * 1500, "\n \n" * 1700, "kk'l" * 800, "",
])
def test_long_runs(text):
    for leaf in (40, 64, 2048):
        codec = CODECS.setdefault(leaf, bpe.Codec(PATH, True, leaf))
        assert list(codec.encode(text)) == WHOLE(text)


def test_long_mixed_texts():
    rng = random.Random(5)
    for _ in range(30):
        text = "".join(rng.choice(["the ", "of", "'ll", "'", " ", "  ", "\n", "été", "12", "--", "字字", "ing", "l", "s"]) for _ in range(2000))
        for leaf in (7, 40):
            assert list(CODECS[leaf].encode(text)) == WHOLE(text)


def test_query_rows(spark):
    texts = [None, "", " ", "one two", "x" * 5000, "it'll be 字字 " * 700, "one two"]
    docs = spark.createDataFrame(
        [(k, t, "b", "d") for k, t in enumerate(texts)] + [(None, "no id", "b", "d"), (3, "one two", "b", "d")], "doc_id long, text string, ids string, data string"
    )
    rows = bpe.decoded(bpe.encoded(docs, PATH), PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.data)) for r in rows) == sorted((d.doc_id is None, d.doc_id or 0, (d.text or "").encode()) for d in docs.collect())
    for r in rows:
        assert list(bpe._ids(bytes(r.ids))) == WHOLE(bytes(r.data).decode())
    assert bpe.encoded(docs.limit(0), PATH).count() == 0


def test_query(spark, tmp_path):
    from tidemark.llm.queries import REGISTRY

    texts = ["a bc", None, "né 字" * 3000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in REGISTRY["op13_byte_bpe"](spark, str(tmp_path)).collect():
        data = (texts[r.doc_id] or "").encode()
        ids = WHOLE(data.decode())
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(data).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
