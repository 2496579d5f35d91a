"""Token ids of whole texts."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import tiktoken
from tokenizers import Tokenizer

# Fixed value: how a byte-level vocabulary of this kind cuts texts before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The same pieces where no two white space characters meet, without a look ahead.
SINGLE_SPACED = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
RUN = re.compile(r"\s\s")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in seen)
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder_of(path: str) -> Callable[[str], list[int]]:
    """A function from text to ids, special tokens' strings being ordinary text.

    Where a byte-level file's ids are in the order of its merges, they are ranks,
    which tiktoken encodes several times faster to the same ids; else the file's
    own library does.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    letters, added = byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
    plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) and not spec.get("normalizer")
    if plain and all(c in letters for t in vocabulary for c in t) and all(vocabulary.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)):
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
        exact = tiktoken.Encoding("exact", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        quick = tiktoken.Encoding("quick", pat_str=SINGLE_SPACED, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda text: (exact if RUN.search(text) else quick)(text)
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return lambda text: own.encode(text, add_special_tokens=False).ids
