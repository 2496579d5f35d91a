import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.tokens import encoder_of
from tidemark.llm.words import batch_of, slices

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé \n\t\x1c字", max_size=30)), max_size=6))
def test_words_of_a_batch(texts):
    batch = batch_of(pa.array(texts, pa.string()))
    want = [WORD.findall((t or "").encode()) for t in texts]
    got = [[batch.data[s:e].tobytes() for s, e in zip(batch.starts[a:b], batch.ends[a:b])] for a, b in zip(batch.first[:-1], batch.first[1:])]
    assert got == want
    flat, hashes = [w for ws in want for w in ws], batch.hashes()
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    lower = batch.hashes(lower=True)
    assert len(set(lower.tolist())) == len({w.lower() for w in flat})


def test_hashes_do_not_depend_on_slices(monkeypatch):
    texts = pa.array([" ".join(f"w{k % 97}" for k in range(5000)), "x" * 3000])
    whole = batch_of(texts).hashes()
    monkeypatch.setattr("tidemark.llm.words.SLICE_BYTES", 64)
    assert np.array_equal(batch_of(texts).hashes(), whole)


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "", "b" * 100, "c"])], ["text"])
    assert [t for s in slices(iter([batch]), most=5) for t in s["text"].to_pylist()] == batch["text"].to_pylist()


@pytest.mark.parametrize("text", ["", " ", "a ", "a  b", "a \nb", "\n", "it's a  dog's\r\n life", "<|endoftext|> x", "été 12 ---\t!", "a\x1c b", "字字 字"])
def test_ids_are_the_tokenizers(text):
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    assert list(encoder_of(PATH)(text)) == own.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab'st \n\t1é.字", max_size=40))
def test_ids_of_any_text(text):
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    assert list(encoder_of(PATH)(text)) == own.encode(text, add_special_tokens=False).ids
