"""Byte-level BPE of whole texts as a reduction over a binary tree.

Encoding is a homomorphism up to what happens at a boundary: the ids of a text
are those of its halves, but for a window of tokens where they meet. So halves
are encoded on their own, down to leaves of LEAF characters, and neighbours are
joined by encoding a window of FIRST tokens on each side again, twice as many
tokens each time, until the tokens outside it are known to stay:

- at a cut where every text of this pattern ends a piece whatever stands further
  left or right (a letter before a space, say): both sides are independent; or
- inside a run of one kind of character, where the window's outermost token came
  out as it was. A sequence of tokens is what the merges make of a piece if each
  two neighbours are what they make of the two: the first merge across a border
  would also happen in the pair alone. All pairs in the window and outside it
  hold, and the outermost token belongs to both.

Decoding concatenates the bytes of halves up the same tree.

One text is read and its ids are written by one task, as one cell each; other
texts go to other tasks. Memory is a small multiple of the longest text.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from tidemark.llm.tokens import PATTERN
from tidemark.llm.words import slices, text_rows

LEAF, FIRST = 2048, 8
SLICE_BYTES = 1 << 20
# What \s stands for in the pattern.
SPACES = frozenset(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each token, from lines of its bytes in base 64 and the rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens of a piece by merges alone: the least rank first, the leftmost of equals."""
    parts = [piece[k:k + 1] for k in range(len(piece))]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return parts
        at = min(found)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


@lru_cache(maxsize=4)
def all_by_merges(path: str) -> bool:
    """Whether merges alone make every token of the vocabulary from its bytes."""
    ranks = read_ranks(path)
    return all(len(merged(token, ranks)) == 1 for token in ranks)


def kind(char: str) -> str:
    """Letter, number, space or other sign, as the pattern tells them apart; '' for what no version has assigned yet."""
    if char in SPACES:
        return "S"
    category = unicodedata.category(char)
    return "" if category == "Cn" else category[0] if category[0] in "LN" else "O"


def parts_any_text(before: str, after: str) -> bool:
    """Whether a piece ends between these two characters in every text."""
    left, right = kind(before), kind(after)
    if not (left and right) or left in (right, "S"):
        return False
    return left != "O" or right != "L" or before != "'"


def same_run(before: str, after: str) -> bool:
    """Whether `after` goes on a run of the last of `before` (three characters, if there are), with no contraction about."""
    here = kind(after)
    if not here or here != kind(before[-1]):
        return False
    return "'" not in before if here == "L" else after != "'"


class Codec:
    """Ids of a text by the tree, and bytes of ids."""

    def __init__(self, path: str, by_merges: bool, leaf: int = LEAF) -> None:
        ranks = read_ranks(path)
        self.encode_leaf = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.by_merges, self.leaf = by_merges, leaf

    def encode(self, text: str) -> array:
        if len(text) <= self.leaf:
            return array("I", self.encode_leaf(text))
        half = -(-len(text) // self.leaf) // 2 * self.leaf
        return self.join(self.encode(text[:half]), self.encode(text[half:]))

    def decode(self, ids: array) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join([self.tokens[i] for i in ids])
        return self.decode(ids[:len(ids) // 2]) + self.decode(ids[len(ids) // 2:])

    def _inside_char(self, ids: array, at: int) -> bool:
        return 0 < at < len(ids) and self.tokens[ids[at]][0] & 0xC0 == 0x80

    def join(self, left: array, right: array) -> array:
        """Ids of a text from those of its two parts."""
        size = FIRST
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            while self._inside_char(left, a):
                a -= 1
            while self._inside_char(right, b):
                b += 1
            window = self.decode(left[a:] + right[:b]).decode()
            # A character has four bytes at most, a token one at least.
            before = self.decode(left[max(0, a - 16):a]).decode(errors="ignore")[-3:]
            after = self.decode(right[b:b + 4]).decode(errors="ignore")[:1]
            ids = array("I", self.encode_leaf(window))
            fixed_left = not before or parts_any_text(before[-1], window[0]) or (
                self.by_merges and same_run(before, window[0]) and ids[0] == left[a])
            tail = (before + window)[-3:]
            fixed_right = not after or parts_any_text(tail[-1], after) or (
                self.by_merges and same_run(tail, after) and ids[-1] == right[b - 1])
            if fixed_left and fixed_right:
                return left[:a] + ids + right[b:]
            size *= 2


def _little(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def _ids(data: bytes) -> array:
    ids = array("I")
    ids.frombytes(data)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


def _field(df: DataFrame, column: str) -> str:
    return f"`{column}` {df.schema[column].dataType.simpleString()}"


def encoded(docs: DataFrame, ranks: str, leaf: int = LEAF) -> DataFrame:
    """Per row of `docs`: doc_id, ids (little-endian unsigned 32-bit, as one binary).

    `ranks` is the path of a rank file that driver and executors can read. Each
    match of the pattern is encoded separately, without special tokens. A null
    text has no ids, as an empty one; a null doc_id stays null; rows that repeat
    stay; other columns are left out.
    """
    by_merges = all_by_merges(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, by_merges, leaf)
        for rows in slices(batches, most=SLICE_BYTES):
            ids = pa.array([_little(codec.encode(text or "")) for text in rows["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([rows["doc_id"], ids], ["doc_id", "ids"])

    return text_rows(docs, "doc_id", "text").mapInArrow(run, f"{_field(docs, 'doc_id')}, ids binary")


def decoded(tokens: DataFrame, ranks: str, leaf: int = LEAF) -> DataFrame:
    """Per row of `tokens` (doc_id, ids as `encoded` gives them): doc_id, ids, data (the decoded bytes). Null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks, False, leaf)
        for rows in slices(batches, "ids", SLICE_BYTES):
            data = pa.array([codec.decode(_ids(ids or b"")) for ids in rows["ids"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["ids"], data], ["doc_id", "ids", "data"])

    return text_rows(tokens, "doc_id", "ids").mapInArrow(run, f"{_field(tokens, 'doc_id')}, ids binary, data binary")
