"""Token ids of whole texts, exactly as the tokenizer file gives them, with words looked up instead of merged anew."""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken

CACHE_WORDS = 500_000

# How byte-level vocabularies split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where printable, else 256 and on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class _Irregular(Exception):
    """A text whose white space does not stand alone between words."""


class _Words(dict):
    """Ids of a word with what comes before it (a blank, or nothing); starts anew at ``CACHE_WORDS`` words."""

    def __init__(self, encode, before: str) -> None:
        super().__init__()
        self.encode, self.before = encode, before

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Irregular
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = self[word] = self.encode(self.before + word)
        return ids


class Ids:
    """Ids of texts as little-endian unsigned 32-bit numbers, by a byte-level vocabulary file.

    The vocabulary's pieces never join a word to the blank after it, so a text may be cut at each single blank or
    line feed between words.  Texts with any other run of white space are encoded as a whole.  Texts are split first where the
    file's added tokens stand, the longest of those that begin at one place, and these take their own ids.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_letters()
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(letters[c] for c in w): i for w, i in model["model"]["vocab"].items() if w not in special}
        self.merge = tiktoken.Encoding("ids", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.first, self.later = _Words(self._whole, ""), _Words(self._whole, " ")
        self.feed = self._whole("\n")
        if any(token[flag] for token in model["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take in what stands around them")
        self.added = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in model["added_tokens"]}
        names = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(map(re.escape, names))})").split if names else lambda text: [text]

    def _whole(self, text: str) -> bytes:
        return np.array(self.merge(text), dtype="<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        plain, *rest = self.split(text)
        if not rest:
            return self._plain(plain)
        return b"".join(self.added[part] if i % 2 else self._plain(part) for i, part in enumerate([plain, *rest]))

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        try:
            ids: list[bytes] = []
            for i, line in enumerate(text.split("\n")):
                if i:
                    ids.append(self.feed)
                head, *rest = line.split(" ")
                ids.append(self.first[head])
                ids.extend(map(self.later.__getitem__, rest))
            return b"".join(ids)
        except _Irregular:
            return self._whole(text)
