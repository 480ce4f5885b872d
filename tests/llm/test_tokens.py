from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from spendspark.llm import tokens

KINDS = {"byte_bpe_50k.json": "leading", "word_bpe_49k.json": "dropped"}
TOKENIZERS = {name: Tokenizer.from_file(public_tokenizers.path(name)) for name in KINDS}
ODD = [
    "", " ", "\n\n", "a  b", "\ta  b", "don't I'LL we've", "x<|endoftext|>y <|startoftext|>", "ça va, Éa! ß ẞ İI ſt ÿŸ µ",
    "é ́x", "a\x1cb !\x1c!", "word,. word... (word) 12ab 3.5", "日本語 текст 🙂👍🏽", "foo** bar*** ###x", "end ",
    " wide 　space", "Ö,", " É.", "ﬁ ½ ²", "​ zero", "x" * 500, "the.The THE,the",
]


def check(texts):
    for name in KINDS:
        encode = tokens.encoder(public_tokenizers.path(name))
        for text, ids in zip(texts, encode(texts), strict=True):
            expected = TOKENIZERS[name].encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected, (name, text)


def test_units_give_the_ids_of_whole_texts():
    check(ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab É'ßs\n\t ,.!* ́İ1ſ<|>x"), max_size=40), max_size=5))
def test_any_mixture_of_characters(texts):
    check(texts)


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check([text])


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    rng = random.Random(1)
    for _ in range(5):
        check(["".join(rng.choice("abc dE,") for _ in range(200)) for _ in range(4)])


@pytest.mark.parametrize("limit", [1, 7, 10**6])
def test_rows_keep_their_numbers(monkeypatch, limit):
    monkeypatch.setattr(tokens, "CHARS_AT_ONCE", limit)
    column = pa.array(["one two", None, "", "three", "four five"])
    found = list(tokens.encoded(column, lambda texts: [t.encode() for t in texts]))
    assert found == [(0, b"one two"), (1, b""), (2, b""), (3, b"three"), (4, b"four five")]


def test_kinds_are_read_from_the_files():
    assert {name: tokens.kind_of(public_tokenizers.path(name)) for name in KINDS} == KINDS


def other_tokenizers():
    """Kinds without short cuts: cased words, a prefix space, and an added token of letters."""
    cased = Tokenizer(models.WordLevel({"[UNK]": 0, "Paris": 1, "paris": 2, "is": 3, "BIG": 4, "big": 5}, unk_token="[UNK]"))
    cased.pre_tokenizer = pre_tokenizers.Whitespace()
    spaced = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    spaced.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    lettered = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lettered.add_tokens(["paris", "big b"])
    return [cased, spaced, lettered]


@pytest.mark.parametrize("number", range(3))
def test_any_other_tokenizer_encodes_whole_texts(tmp_path, number):
    tokenizer, path = other_tokenizers()[number], str(tmp_path / "other.json")
    tokenizer.save(path)
    assert tokens.kind_of(path) is None
    texts = ["Paris is BIG", "paris is big", "big big bad", "", *ODD]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in tokens.encoder(path)(texts)]
    assert got == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_many_words_at_once():
    rng = random.Random(3)
    letters = "aaeeiioonrstlcdmpuABÉéüßñÿþÀ"

    def unit():
        word = "".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 7, 9, 12, 15, 23, 24, 25, 40])))
        return rng.choice([" ", " ", " ", "", "\n", "  ", " \t"]) + word + rng.choice(["", "", "", ".", ",.", "$$$", "'s", "3", "÷", "’"])

    texts = ["".join(unit() for _ in range(rng.randint(0, 200))) for _ in range(200)]
    check(texts)
    # Texts with white space beyond ASCII stand between others.
    check([text + rng.choice(["", " ", "   x", "\x85y"]) for text in texts])
    check(["", *texts[:3], ""])
    check([])


def test_repeated_and_long_words():
    check(["a" * n for n in range(30)] + [" " + "ab" * n + "!" * n for n in range(20)] + ["É" * n + " ééé" * n for n in range(14)])
