"""Byte-level pair encoding by a tokenizer file: ids, and the bytes of each id."""

from __future__ import annotations

import functools
import json
import re
from typing import NamedTuple

import numpy as np
import public_tokenizers
import tiktoken

#: The byte-level pattern (fixed values), possessive so that long runs need no stack.
PIECE = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


class ByteBpe(NamedTuple):
    path: str
    encoding: tiktoken.Encoding
    pieces: list[bytes]   # the bytes of each id
    added: re.Pattern | None  # strings that are ids of their own

    def ordinary(self, text: str) -> np.ndarray:
        """Ids; strings of added tokens are ordinary text."""
        return self._encode(text, False)

    def whole(self, text: str) -> np.ndarray:
        """Ids; an added token's string is its id, wherever it stands."""
        return self._encode(text, self.added is not None and self.added.search(text) is not None)

    def _encode(self, text: str, added: bool) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all" if added else set(), disallowed_special=())
        except ValueError:  # about a million blanks in a row are too many for the pattern's engine; the other library takes them
            return np.array(_library(self.path, not added).encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(4)
def _library(path: str, ordinary: bool):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = ordinary
    return t


def byte_letters() -> dict[int, str]:
    """Byte -> the visible character that stands for it in a byte-level
    vocabulary: printable ones stand for themselves, the others follow from
    256 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


@functools.lru_cache(4)
def byte_bpe(path: str) -> ByteBpe:
    """The tokenizer of a file whose ids are in the order of its merges, as a
    rank encoding needs it; any other file is an error."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {c: b for b, c in byte_letters().items()}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]) or spec["normalizer"]:
        raise ValueError(f"{path}: only plain added tokens and no normalizer are known here")
    vocab = {v: i for v, i in spec["model"]["vocab"].items() if v not in added}
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    if made != sorted(made) or (made and made[0] < 256):
        raise ValueError(f"{path}: ids are not in the order of the merges")
    ranks = {bytes(byte_of[c] for c in v): i for v, i in vocab.items()}
    pieces = [b""] * (max([*ranks.values(), *added.values()]) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    for text, i in added.items():
        pieces[i] = text.encode()
    return ByteBpe(path, tiktoken.Encoding(path, pat_str=PIECE, mergeable_ranks=ranks, special_tokens=added), pieces,
                   re.compile("|".join(map(re.escape, added))) if added else None)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)
