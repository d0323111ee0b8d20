"""Piece encoding, token counts and packing against the libraries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from visitlake.llm import packing, pieces, token_counts

ALPHABET = "abcSTΣ'é𝒳ſ日 \n\t.,-=<|>1   "


@pytest.fixture(scope="module")
def texts(documents):
    rng = random.Random(7)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    made += ["", " ", "   x", "x   ", " " * 40 + "y", "a▁b ▁", "<|endoftext|> a<|startoftext|>", "ab" * 4000, "\x00\x1c\x85", "Á Å", "\U000190c5\U00016ea0"]
    return made + [r[0] for r in documents.select("text").limit(60).collect()]


def test_pieces_are_those_of_the_library(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    own = pieces.coder(path("piece_bpe_32k.model"))
    for text, ids in zip(texts, library.encode(texts), strict=True):
        found = np.frombuffer(own.code(text), "<i4").tolist()
        assert found == ids, text
        assert own.model.decode(found) == library.decode(ids)


def test_words_do_not_depend_on_what_is_remembered(texts, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    small = pieces.PieceCoder(path("piece_bpe_32k.model"))
    large = pieces.coder(path("piece_bpe_32k.model"))
    assert [small.code(t) for t in texts[:500]] == [large.code(t) for t in texts[:500]]


def test_every_piece_is_taken_apart_as_it_was_made():
    model = pieces.coder(path("piece_bpe_32k.model")).model
    for i in range(300, 3000, 7):
        halves = model.split(i)
        if halves and halves[0] >= 0:
            assert model.pieces[halves[0]] + model.pieces[halves[1]] == model.pieces[i]


def test_encode_rows(spark, odd, none):
    rows = pieces.encode(odd, path("piece_bpe_32k.model")).collect()
    assert len(rows) == odd.count() and all(r.piece_ids == [] for r in rows if r.doc_id in (0, 1))
    assert {r.decoded for r in rows if r.doc_id == 8} == {"the " * 3000}
    assert pieces.digests(none, path("piece_bpe_32k.model")).count() == 0


def test_counts_are_those_of_the_library(texts):
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    own = token_counts.counter(path("word_bpe_49k.json"))
    assert own.count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.merge([b"a" * 999]).tolist() == [len(library.encode("a" * 999, add_special_tokens=False).ids)]


def test_count_rows(odd, none):
    rows = {r.doc_id: r for r in token_counts.count_tokens(odd, path("word_bpe_49k.json")).collect()}
    assert (rows[0].n_bytes, rows[0].n_tokens, rows[0].over_limit) == (0, 0, False)
    assert rows[8].n_tokens == 3000 and rows[8].over_limit and rows[7].n_bytes == len("é𝒳 日本".encode())
    assert token_counts.count_tokens(none, path("word_bpe_49k.json")).count() == 0


def test_packing_ids_are_those_of_the_library(texts):
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    found = packing.encoder(path("byte_bpe_50k.json")).encode(texts)
    for ids, known in zip(found, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [*known.ids, 1]


@pytest.mark.parametrize("sizes", [[], [5], [1500] * 300, [1, 2, 3] * 400, [2048, 4096, 5000], list(range(1, 900))])
def test_windows_hold_every_id_once_without_padding(sizes):
    packer = packing.LevelPacker(2048, open_windows=50)
    whole = {k: np.arange(k, k + n, dtype="<u4").tobytes() for k, n in enumerate(sizes)}
    for k, ids in whole.items():
        packer.add(k, ids)
    packer.finish()
    parts = defaultdict(list)
    for window in packer.closed:
        fill = sum(len(p[3]) for p in window) // 4
        assert fill == 2048 or fill & (fill - 1) == 0
        for document, start, total, ids in window:
            assert total == sizes[document] and ids
            parts[document].append((start, ids))
    for k, ids in whole.items():
        at = 0
        for start, piece in sorted(parts[k]):
            assert start == at
            at += len(piece) // 4
        assert b"".join(p for _, p in sorted(parts[k])) == ids
    assert len(packer.closed) <= sum(sizes) // 2048 + 11


def test_level_choice_is_the_least_sum_of_squares():
    rng = random.Random(3)
    for _ in range(300):
        packer = packing.LevelPacker(12)
        packer.counts[1:12] = [rng.choice([0, 0, 1, 2, 5]) for _ in range(11)]
        size = rng.randint(1, 11)

        def after(level, packer=packer, size=size):
            counts = packer.counts.copy()
            if level:
                counts[level] -= 1
            if level + size < 12:
                counts[level + size] += 1
            return int((counts[1:12] ** 2).sum())

        allowed = [0, *[h for h in range(1, 12 - size + 1) if packer.counts[h]]]
        best = min(map(after, allowed))
        assert packer.best_level(size) == max(h for h in allowed if after(h) == best)


def test_pack_rows(odd, none):
    rows = packing.pack(odd, path("byte_bpe_50k.json")).collect()
    by_place = defaultdict(list)
    for r in rows:
        assert len(r.piece_ids) == 4 * r.length
        by_place[r.sequence_id].append((r.offset, r.length))
    for pieces_of in by_place.values():
        at = 0
        for offset, length in sorted(pieces_of):
            assert offset == at
            at += length
    assert {r.doc_tokens for r in rows if r.doc_id in (0, 1)} == {1}
    assert sum(r.length for r in rows if r.doc_id == 11) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 11)
    assert packing.pack(none, path("byte_bpe_50k.json")).count() == 0
    shown = packing.placed(odd, path("byte_bpe_50k.json")).where("doc_id = 0").first()
    assert shown.ids_crc32 == zlib.crc32(b"\x01\0\0\0")
