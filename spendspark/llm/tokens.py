"""Token ids of whole texts, with each distinct unit of text encoded once per worker.

Some tokenizers split a text before every run of white space (or drop the white space) and encode
the parts on their own, so the ids of a text are the ids of its units in a row. Units repeat a lot;
a worker keeps the ids of those it has seen, up to a fixed number, and the tokenizer only sees new
ones. A tokenizer's file says whether it is of a kind for which this holds; any other one encodes
whole texts. Ids stay little-endian unsigned 32-bit bytes throughout.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from spendspark.llm import bpe

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the characters with the Unicode property White_Space.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
UNIT_PATTERNS = {
    # White space belongs to the unit that follows it.
    "leading": f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+",
    # White space is dropped by the tokenizer.
    "dropped": f"[^{WHITE_SPACE}]+",
}
# Letters of one case pair each, the same under Unicode normalisation; most words have no others.
LETTERS = "A-Za-zÀ-ÖØ-Þà-öø-þ"
_PLAIN = re.compile(f" ?[{LETTERS}]+([,.;:!?*$%&#|]*)").fullmatch
# How the files of the two kinds describe what comes before the model.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
WORD_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
KINDS = {
    "leading": (None, {**BYTE_LEVEL, "use_regex": True}, None),
    "dropped": (
        {"type": "Sequence", "normalizers": NORMALIZERS},
        {"type": "Sequence", "pretokenizers": [WORD_SPLIT, {**BYTE_LEVEL, "use_regex": False}]},
        "</w>",
    ),
}
# Units, and parts of units, that a worker remembers in each of two generations: about 60 MB each.
REMEMBERED = 300_000
# Longer units (and unbroken texts) are encoded each time.
LONGEST_REMEMBERED = 64
# Characters that are encoded at a time: distinct words are encoded once among them.
CHARS_AT_ONCE = 4_000_000


def kind_of(path: str) -> str | None:
    """Which kind of white space rule a tokenizer's file describes; None if units are not sure to be apart."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model = described["model"]
    plain = model["type"] == "BPE" and not any(
        model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
    )
    # Added tokens are looked for in whole texts; within a unit the tokenizer still finds them.
    inside = all(
        not (token["lstrip"] or token["rstrip"] or token["single_word"])
        and not re.search(f"[{WHITE_SPACE}]", token["content"])
        and not _PLAIN(token["content"])
        for token in described.get("added_tokens", [])
    )
    if not plain or not inside or described.get("truncation") or described.get("padding"):
        return None
    found = (described["normalizer"], described["pre_tokenizer"], model.get("end_of_word_suffix"))
    return next((kind for kind, wanted in KINDS.items() if found == wanted), None)


class _Memory(dict):
    """Up to twice a number of values by key, made when first asked for; what was not asked for lately goes first."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class _Units:
    """A tokenizer and the ids of units it has seen."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.kind = kind_of(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.find = re.compile(UNIT_PATTERNS[self.kind]).findall if self.kind else None
        self.known = _Memory(self._unit_ids)
        # Words and marks of which units consist; far fewer than units.
        self.parts = _Memory(self._part_ids)
        self.spaced = self.kind == "leading"
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # The character that stands for each byte, for those in UTF-8 of the letters and the space.
        alphabet = ["\ufffe"] * 256
        for char in [" ", *(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha()), *map(chr, range(0x21, 0x7F))]:
            for byte, as_char in zip(char.encode(), spelt(char)[0][0], strict=True):
                alphabet[byte] = as_char
        self.alphabet = "".join(alphabet)
        self.space = self.alphabet[0x20]
        self.words = self._words(path) if self.kind else None

    def _words(self, path: str) -> bpe.Words:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        made = bpe.Merges(
            np.array([(vocab[a], vocab[b]) for a, b in pairs], dtype=np.int64).reshape(-1, 2),
            np.array([vocab[a + b] for a, b in pairs], dtype=np.int64),
        )
        first, last = (np.array([vocab.get(c + end, -1) for c in self.alphabet]) for end in ("", suffix))
        return bpe.Words(made, first, last, self.spaced, self.known.__getitem__)

    def _part_ids(self, part: str) -> bytes:
        return array("I", [token.id for token in self.tokenize(part)]).tobytes()

    def _unit_ids(self, unit: str) -> bytes:
        """Words of plain letters and the marks after them go straight to the model; other units take the tokenizer's whole way."""
        if unit.isascii():  # most units are one word of plain letters
            if unit.isalpha():
                return self.parts[unit if self.spaced else unit.lower()]
            if unit[0] == " " and unit[1:].isalpha():
                return self.parts[self.space + unit[1:]]
        found = _PLAIN(unit)
        if not found:
            return array("I", self.tokenizer.encode_batch_fast([unit], add_special_tokens=False)[0].ids).tobytes()
        marks = found[1]
        word = unit[: -len(marks)] if marks else unit
        if not self.spaced:
            word = word.lower()
        ids = self.parts[charmap_decode(word.encode(), "strict", self.alphabet)[0]]
        return ids + self.parts[marks] if marks else ids

    def texts(self, texts: list[str]) -> list[bytes]:
        if self.find is None:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [array("I", encoding.ids).tobytes() for encoding in found]
        raw = [text.encode() for text in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        if bpe.has_wide_space(data):
            # Texts that may hold white space beyond ASCII are cut by the pattern.
            wide = [bpe.has_wide_space(np.frombuffer(text, np.uint8)) for text in raw]
            others = iter(self.texts([text for text, w in zip(texts, wide, strict=True) if not w]) if not all(wide) else [])
            find, ids = self.find, self.known.__getitem__
            return [b"".join(map(ids, find(text))) if w else next(others) for text, w in zip(texts, wide, strict=True)]
        ids, at = self.words.texts(data, np.cumsum([0, *map(len, raw)]))
        return [ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids as bytes.

    Tokenizer and remembered units are kept in a module of the process, so that tasks share them.
    """
    held = sys.modules.setdefault("_token_units", types.ModuleType("_token_units")).__dict__
    if path not in held:
        held[path] = _Units(path)
    return held[path].texts


def encoded(column: pa.Array, encode: Callable[[list[str]], list[bytes]]) -> Iterator[tuple[int, bytes]]:
    """(row, ids) of a text column, null as empty, a bounded number of characters at a time."""
    waiting: list[str] = []
    chars = start = 0
    for row, value in enumerate(column):
        text = value.as_py() or ""
        waiting.append(text)
        chars += len(text)
        if chars >= CHARS_AT_ONCE:
            yield from enumerate(encode(waiting), start)
            waiting, chars, start = [], 0, row + 1
    yield from enumerate(encode(waiting), start)
