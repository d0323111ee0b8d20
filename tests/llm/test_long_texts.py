"""Texts of about a million characters against the libraries."""

import random

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from visitlake.llm import packing, pieces, token_counts

CHOICE = random.Random(3).choices
TEXTS = {
    "blanks": " " * 1_000_000 + "x",
    "blanks at the end": "a" + " " * 1_000_000,
    "line breaks": "\n" * 1_000_000 + "b",
    "blanks around a special string": "a" + " \n\t " * 20_000 + "<|endoftext|>" + "　" * 20_000 + " y",
    "one word": "".join(CHOICE("abcdefghijklmnopqrstuvwxyz", k=1_000_000)),
    "one letter": "a" * 1_000_000,
    "digits": "".join(CHOICE("0123456789", k=1_000_000)),
    "one line": "some words, " * 83_000,
    "other letters": "".join(CHOICE("éàüñ日本", k=300_000)),
}


@pytest.mark.parametrize("name", TEXTS)
def test_long_texts(name):
    text = TEXTS[name]
    known = Tokenizer.from_file(path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.encoder(path("byte_bpe_50k.json")).encode([text])[0], "<u4").tolist() == [*known, 1]
    known = Tokenizer.from_file(path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
    assert token_counts.counter(path("word_bpe_49k.json")).count([text]) == [len(known)]
    part = text[:200_000]
    if name != "one letter":  # for which the library needs minutes
        known = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model")).encode(part)
        assert np.frombuffer(pieces.coder(path("piece_bpe_32k.model")).code(part), "<i4").tolist() == known


def test_long_words_are_merged_as_short_ones_are():
    own = token_counts.counter(path("word_bpe_49k.json"))
    draw = random.Random(5)
    words = ["".join(draw.choice(draw.choice(["abcdefghijklmnop", "ab", "aé", "the"])) for _ in range(draw.randint(1, 80))) for _ in range(1500)]
    words += ["a" * n for n in range(1, 200)]
    coded = [w.encode() for w in words]
    assert own.merge(coded).tolist() == [own.merge_long(w) for w in coded]


def test_answers_on_pairs_are_forgotten_beyond_a_bound(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_PAIRS", 100)
    small, large = pieces.PieceCoder(path("piece_bpe_32k.model")), pieces.coder(path("piece_bpe_32k.model"))
    text = TEXTS["one word"][:20_000]
    assert small.code(text) == large.code(text) and len(small.model.pairs) <= 100
