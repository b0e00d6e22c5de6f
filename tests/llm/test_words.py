"""Token ids of the packing operator are those of the tokenizer itself, whatever the spelling."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest

from wattframe.llm import packing
from wattframe.llm.queries import tokenizer_path

SIGNS = list("aAzZ'sStTdDmMlLrRvVeE09 .!?<|>\t\n\x0b\x1c  \u0085ÀéßÿŸǰ̱̌̈́İıΣσς漢字²½ª×÷😀’“\x00\x7fJHTWY")
WORDS = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "'re", "'LL", "J̌", "H̱", "T̈", "W̊", "é"]


@pytest.fixture
def words():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return packing.WordIds(file.read())


def own(words, text):
    ids = words.tokenizer.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("stretch", [1 << 20, 40])
def test_ids_of_any_spelling(words, monkeypatch, stretch):
    monkeypatch.setattr(packing, "STRETCH_BYTES", stretch)
    pick = random.Random(stretch)
    texts = ["", " ", *WORDS, *("".join(pick.choices(SIGNS + WORDS, k=pick.randint(0, 60))) for _ in range(1500))]
    assert words.texts([t.encode() for t in texts]) == [own(words, t) for t in texts]


def test_ids_after_the_cache_was_emptied(words, monkeypatch):
    monkeypatch.setattr(packing, "WORD_ENTRIES", 5)
    for text in ("some plain words", "other plain words, again", "some plain words") * 3:
        assert words.texts([text.encode()]) == [own(words, text)]


def test_frequent_words_stay(words, monkeypatch):
    monkeypatch.setattr(packing, "WORD_ENTRIES", 20)
    monkeypatch.setattr(packing, "ENCODED_WORDS", 3)
    encoded = []
    learn = words._learn
    monkeypatch.setattr(words, "_learn", lambda new: encoded.extend(new) or learn(new))
    for i in range(40):
        text = f"frequent new{i} other{i}x".encode()
        assert words.texts([text]) == [words.encode(text)]
        assert len(words) <= packing.WORD_ENTRIES
    assert encoded.count(b"frequent") == 1


def test_plain_words_need_no_pass_of_the_whole_tokenizer(words):
    text = "It's plain, isn't it?! 12 'TIS ÀÉ: we'll sea're don''t 'really 'é.\n(and)\t'"
    found = own(words, text)
    words.tokenizer = None
    assert words.texts([text.encode(), b"", b" ", text.encode()]) == [found, b"", b"", found]


def test_parts_are_looked_up_once_for_many_texts(words, monkeypatch):
    asked = []
    learn = words.learn
    monkeypatch.setattr(words, "learn", lambda parts: asked.extend(parts) or learn(parts))
    words.texts([b"the same words, the same"] * 50)
    assert sorted(asked) == sorted([b"the", b"same", b"words", b","])


def test_bytes_that_are_no_utf_8(words):
    text = b"plain \x80\xff word\xc3 caf\xc3\xa9 \xc3"
    assert words.texts([text, b"plain"]) == [own(words, text.decode("utf-8", "replace")), own(words, "plain")]


def test_a_tokenizer_that_divides_in_another_way():
    with open(tokenizer_path(), encoding="utf-8") as file:
        definition = json.load(file)
    definition["pre_tokenizer"]["pretokenizers"][0] = {"type": "WhitespaceSplit"}
    words = packing.WordIds(json.dumps(definition))
    texts = ["some words, others don't", "", "12 é"]
    assert words.texts([t.encode() for t in texts]) == [own(words, t) for t in texts]
