"""Token ids of texts by a given byte-level vocabulary, one task at a time."""

from __future__ import annotations

import json
import os
import sys
from array import array
from collections.abc import Iterable
from functools import cached_property

from tallyloom.llm.common import held

# How byte-level vocabularies of this kind split texts before merging (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 20_000  # characters of a text past which its longest stretch is looked at
STRETCH = 2_000  # characters without a change between blank and visible that are left to the library


def byte_names() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself if visible, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks(vocabulary: dict) -> dict[bytes, int] | None:
    """Ids by bytes, if ids rise in the order of merges, so that ids alone tell which merge comes first; else None."""
    model, splitter = vocabulary["model"], vocabulary.get("pre_tokenizer") or {}
    plain = splitter.get("type") == "ByteLevel" and not splitter.get("add_prefix_space") and splitter.get("use_regex", True)
    if model.get("type") != "BPE" or not plain or vocabulary.get("normalizer"):
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids, names = model["vocab"], byte_names()
    made = [ids.get(a + b, -1) for a, b in merges]
    added = {t["content"] for t in vocabulary.get("added_tokens", [])}
    words = {w: i for w, i in ids.items() if w not in added}
    if made != sorted(set(made)) or min(made, default=0) < 0 or not all(c in words for c in names) or not all(c in names for w in words for c in w):
        return None
    if len(made) + len(names) != len(words):  # ids that no merge makes
        return None
    return {bytes(names[c] for c in w): i for w, i in words.items()}


class Encoder:
    """Encodes whole texts to the ids that the vocabulary's own library gives without its special tokens around them.

    Where ids rank the merges, texts are encoded by their ranks, which is several times as fast. Left
    to the library are other vocabularies, texts that hold a string of an added token, which is that token's
    id, and texts with a very long stretch of blanks or without any.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)
        self.added = [t["content"] for t in vocabulary.get("added_tokens", [])]
        self.ranked = None
        if found := ranks(vocabulary):
            import tiktoken

            self.ranked = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=found, special_tokens={})

    @cached_property
    def tokenizer(self):
        """The library's own, loaded for the first text that needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def whole(self, text: str) -> bool:
        """Whether the library has to encode a text."""
        if self.ranked is None or any(t in text for t in self.added):
            return True
        if len(text) <= LONG:
            return False
        # A stretch of blanks of twice the length holds one of these steps whole.
        steps = range(0, len(text), STRETCH)
        return max(map(len, text.split()), default=0) > STRETCH or any(not text[at:at + STRETCH].strip() for at in steps)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        found = []
        for text in texts:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids if self.whole(text) else self.ranked.encode_ordinary(text))
            if sys.byteorder == "big":
                ids.byteswap()
            found.append(ids.tobytes())
        return found


def encoder(path: str) -> Encoder:
    return held(("encoder", path), lambda: Encoder(path))
