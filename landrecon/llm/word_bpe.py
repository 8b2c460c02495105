"""Ids of a tokenizer file of the kind "BPE with word ends; lower case, white space dropped".

Words are independent of each other there, so each distinct word is encoded once per process and
remembered. The word end is written as a zero byte: with the merges of (byte, word end) ranked
first, a plain byte-pair encoder over the file's merges gives the file's own ids. Texts with
characters outside the Latin blocks, or with control characters, and texts that hold the string of an
added token, are given to the tokenizer library as they are; it gives such a string the token's own id.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import defaultdict
from itertools import count

import numpy as np

from landrecon.llm.common import cached

REMEMBERED_WORDS = 250_000
LATIN_END = 0x250


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for the 256 bytes in byte-level vocabularies."""
    shown = {b for b in range(256) if 33 <= b <= 126 or (b >= 161 and b != 173)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordIds:
    def __init__(self, path: str):
        import tiktoken

        self.path, self.library = path, None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        self.added = re.compile("|".join(map(re.escape, sorted(special))) or "(?!)", re.IGNORECASE).search
        of_char = _byte_alphabet()
        tokens = {}
        for token, number in spec["model"]["vocab"].items():
            if token not in special:
                ended = token.endswith("</w>") and token != "</w>"
                body = token[:-4] if ended else token
                tokens[bytes(of_char[c] for c in body) + (b"\0" if ended else b"")] = number
        single = [b for b in tokens if len(b) == 1]
        ends = [b for b in tokens if len(b) == 2 and b.endswith(b"\0")]
        first = set(single) | set(ends)
        merged = sorted((b for b in tokens if b not in first), key=tokens.get)
        order = single + ends + merged
        self.number = np.array([tokens[b] for b in order], dtype=np.uint32)
        self.ends_word = np.array([b.endswith(b"\0") and len(b) > 1 for b in order])
        self.encoder = tiktoken.Encoding(
            "words", pat_str=r"[^\x00]+\x00", special_tokens={},
            mergeable_ranks={b: rank for rank, b in enumerate(order)},
        )
        chars = [chr(c) for c in range(LATIN_END)]
        letters = "".join(c for c in chars if unicodedata.category(c)[0] == "L")
        numbers = "".join(c for c in chars if unicodedata.category(c)[0] == "N")
        self.split = re.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+"
        ).findall
        self.unusual = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]").search
        self.forget()

    def forget(self) -> None:
        """Drop the remembered words."""
        self.index: dict[str, int] = defaultdict(count().__next__)
        self.flat = np.zeros(0, dtype=np.uint32)
        self.offsets = np.zeros(1, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        ranks = self.encoder.encode_to_numpy("\0".join(words) + "\0")
        stops = np.flatnonzero(self.ends_word[ranks]) + 1
        self.flat = np.concatenate([self.flat, self.number[ranks]])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + stops])

    def whole(self, text: str) -> list[int]:
        """Ids of a text by the tokenizer library, which is loaded for the first such text."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return self.library.encode(text, add_special_tokens=False).ids

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        codes: list[np.ndarray | None] = []
        if len(self.index) > REMEMBERED_WORDS:
            self.forget()
        known = len(self.index)
        look_up = self.index.__getitem__
        for text in texts:
            plain = text if text.isascii() else unicodedata.normalize("NFC", text)
            plain = plain.lower()
            if self.unusual(text) or self.unusual(plain) or self.added(text):
                codes.append(None)
            else:
                codes.append(np.fromiter(map(look_up, self.split(plain)), dtype=np.int64))
        if len(self.index) > known:
            self._learn(list(self.index)[known:])
        out = []
        for text, words in zip(texts, codes):
            if words is None:
                out.append(np.array(self.whole(text), dtype=np.uint32))
                continue
            sizes = self.offsets[words + 1] - self.offsets[words]
            shift = np.cumsum(sizes) - sizes
            total = int(sizes.sum())
            out.append(self.flat[np.arange(total) + np.repeat(self.offsets[words] - shift, sizes)])
        return out


def word_ids(path: str) -> WordIds:
    return cached(("word ids", path), lambda: WordIds(path))
