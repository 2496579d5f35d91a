"""Words of whole texts: as Spark columns, and as hashes of whole Arrow batches in numpy.

A word is a maximal run of bytes other than space, tab, \\n, \\v, \\f and \\r. A
null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES.encode())] = True
_SAME = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER = _SAME.copy()
_LOWER[65:91] += np.uint64(32)

_BASE = 0x9E3779B97F4A7C15 | 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the hash base and of its inverse; a copy sent to a task starts empty."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(max(n, SLICE_BYTES + (1 << 16)), _BASE, np.uint64)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = _BASE_INVERSE
            self.down = np.multiply.accumulate(steps)
        return self.up, self.down


_powers = _Powers()


def words_column(text: Column) -> Column:
    """The words of a text in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN, -1), "")


def n_words_column(text: Column) -> Column:
    """The number of words, without an array of them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass
class Batch:
    """Texts of an Arrow batch: bytes, their bounds, and the words in them."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # words[first[k]:first[k + 1]] are those of text k

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever the word stands."""
        values, out = (_LOWER if lower else _SAME), np.empty(len(self.starts), np.uint64)
        done = 0
        while done < len(out):
            # Slices end between words, so texts of any length need little memory.
            at = int(self.starts[done])
            upto = max(done + 1, int(np.searchsorted(self.ends, at + SLICE_BYTES, "right")))
            part = values[self.data[at:int(self.ends[upto - 1])]]
            powers, inverses = _powers.upto(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * powers[:len(part)], out=sums[1:])
            s, e = self.starts[done:upto] - at, self.ends[done:upto] - at
            out[done:upto] = (sums[e] - sums[s]) * inverses[s]
            done = upto
        return mix(out, 1)

    def of_text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, k: int) -> bytes:
        return self.data[self.offsets[k]:self.offsets[k + 1]].tobytes()


def batch_of(texts: pa.Array) -> Batch:
    """Find the words of all texts of an Arrow string array at once."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, bounds, data = texts.buffers()
    offsets = np.frombuffer(bounds, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~_IS_SPACE[data]
    before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    after[:-1] = inside
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Batch(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about `most` bytes of text, one row at least."""
    for batch in batches:
        lengths = np.cumsum([0, *(n or 0 for n in pc.binary_length(batch[column]).to_pylist())])
        done = 0
        while done < batch.num_rows:
            upto = max(done + 1, int(np.searchsorted(lengths, lengths[done] + most, "right")) - 1)
            yield batch.slice(done, upto - done)
            done = upto


def window_sums(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` consecutive word hashes (also across texts)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += hashes[j:j + n] * np.uint64((0xD6E8FEB86659FD93 * (2 * j + 1) ** 3) % (1 << 64) | 1)
    return mix(total, size)


def text_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that Arrow moves nothing else."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
