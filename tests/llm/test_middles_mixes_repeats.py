"""Fill-in-the-middle, best-fit packing and periodic runs against brute force and the library."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visitlake.llm import best_packing, middles, mixes, repeats, word_ids
from visitlake.llm.extensions import Extensions

VOCABULARY = path("word_bpe_49k.json")
MILLION = {"blanks": " " * 1_000_000 + "x", "one word": "ab" * 500_000, "one line": "some words, " * 83_333, "lines": "é1\n" * 333_333}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill in the middle -----------------------------------------------------


def middle_of(doc_id, text):
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, len(p), len(m), sha(out), sha(text)


def test_middles_by_brute_force(spark, documents, odd, none):
    marked = [(5000 + k, t) for k, t in enumerate(["a<P>b", "<M>", "<P", "x<S", "<<P>", ">S<M", "😀é\n" * 40, *MILLION.values()])]
    rows = documents.select("doc_id", "text").union(odd.select("doc_id", "text")).union(spark.createDataFrame(marked, "doc_id long, text string"))
    want = Counter((r.doc_id, *middle_of(r.doc_id, r.text or "")) for r in rows.collect())
    assert Counter(map(tuple, middles.digests(rows).collect())) == want
    assert len({k[2] for k in want}) == 3
    assert middles.digests(none).count() == 0 and middles.digests(odd).count() == odd.count()


def test_other_units_and_texts_that_are_not_made_of_them():
    words = regex.compile(r"(\s*\S+\s*)*")
    n, prefix, middle, out = middles.arranged(words, "one two  three four", "psm", 3, 1)
    assert (n, out) == (4, "<P>one <S>four<M>two  three ") and prefix == 4 and middle == 11
    with pytest.raises(ValueError):
        middles.arranged(regex.compile("(a)*"), "ab", "psm", 0, 0)


# --- best-fit packing -------------------------------------------------------


def test_word_ids_are_those_of_the_library(documents, monkeypatch):
    rng = random.Random(7)
    letters = "abcSTΣ'é𝒳ſ日 \n\t.,-=<|>1   ́ \x1c\x85Å\r\x0b᷶"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["a<|endoftext|>b <|startoftext|>", "<|endoftext|><|endoftext|>", "\U000190c5\U00016ea0", "", *MILLION.values()]
    texts += [r[0] for r in documents.select("text").limit(60).collect()]
    want = [e.ids for e in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in word_ids.coder(VOCABULARY).code(texts)] == want
    monkeypatch.setattr(word_ids, "REMEMBERED", 5)
    monkeypatch.setattr(word_ids, "TOGETHER", 50)
    small = word_ids.WordCoder(VOCABULARY)
    assert [np.frombuffer(x, "<u4").tolist() for x in small.code(texts[:500])] == want[:500]


def best_content(lengths, values, window):
    best = [0.0] * (window + 1)
    for room in range(1, window + 1):
        best[room] = max([best[room - 1], *[best[room - k] + v for k, v in zip(lengths, values, strict=True) if k <= room]])
    return best


def test_knapsack_by_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        window = rng.randint(5, 60)
        lengths = sorted(rng.sample(range(1, window), rng.randint(1, min(8, window - 1))))
        values = np.array([rng.random() for _ in lengths])
        knapsack = mixes.Knapsack(np.array(lengths), window)
        knapsack.solve(values)
        assert np.allclose(knapsack.best, best_content(lengths, values, window))
        content = knapsack.content(window)
        assert sum(lengths[k] * n for k, n in content.items()) <= window
        assert np.isclose(sum(values[k] * n for k, n in content.items()), knapsack.best[window])


@pytest.mark.parametrize(
    ("low", "high", "items", "slack"), [(1, 900, 20_000, 0.001), (1300, 2800, 20_000, 0.008), (2049, 4000, 500, 9), (4096, 4097, 7, 0), (1, 2, 9000, 0.2), (1, 4000, 0, 0)]
)
def test_mixes_hold_every_length_as_often_as_it_occurs(low, high, items, slack):
    counts = Counter(np.random.default_rng(1).integers(low, high, items).tolist())
    found = mixes.mixes(counts, 4096)
    got = Counter()
    for mix in found:
        assert mix.copies > 0 and sum(k * n for k, n in mix.lengths) <= 4096
        for k, n in mix.lengths:
            got[k] += n * mix.copies
    assert got == counts
    least = max(-(-sum(k * n for k, n in counts.items()) // 4096), sum(n for k, n in counts.items() if 2 * k > 4096))
    assert sum(m.copies for m in found) <= least * (1 + slack) + (1 if slack else 0)


def test_most_windows_come_from_the_program(monkeypatch):
    counts = Counter(np.random.default_rng(1).integers(1300, 2800, 200_000).tolist())
    left = []
    plain = mixes.best_fit
    monkeypatch.setattr(mixes, "best_fit", lambda c, w: left.append(sum(c.values())) or plain(c, w))
    mixes.mixes(counts, 4096)
    assert left[0] < 20_000


def test_best_fit_pieces(spark, documents, odd, none):
    rows = odd.select("doc_id", "text").union(documents.select("doc_id", "text")).union(
        spark.createDataFrame([(9000 + k, t) for k, t in enumerate(MILLION.values())], "doc_id long, text string")
    )
    library = Tokenizer.from_file(VOCABULARY)
    texts = defaultdict(list)
    for r in rows.collect():
        texts[r.doc_id].append([*library.encode(r.text or "", add_special_tokens=False).ids, 1])
    found = best_packing.pack(rows.repartition(7), VOCABULARY).collect()
    windows, parts, total = defaultdict(list), defaultdict(list), 0
    for r in found:
        assert len(r.piece_ids) == 4 * r.length and r.ids_crc32 == zlib.crc32(r.piece_ids)
        windows[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append((r.piece, r.start, np.frombuffer(r.piece_ids, "<u4").tolist()))
        total += r.length
    for placed in windows.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    for doc_id, whole in texts.items():
        want = Counter((k, s, tuple(ids[s : s + 4096])) for ids in whole for k, s in enumerate(range(0, len(ids), 4096)))
        assert Counter((k, s, tuple(ids)) for k, s, ids in parts[doc_id]) == want
    assert len(windows) <= -(-total // 4096) * 1.02 + 1
    assert best_packing.placed(none, VOCABULARY).count() == 0


# --- periodic runs ----------------------------------------------------------


def runs_by_definition(words, exponent=4, least=6):
    found, n = {}, len(words)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, exponent * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, p, b) for (a, b), p in found.items())


def test_extensions_by_brute_force():
    rng = random.Random(5)
    for size in [1, 2, 13, 14, 40, 200, 300]:
        for kinds in (1, 2, 5):
            numbers = [rng.randrange(kinds) for _ in range(size)]
            one, two = (np.array([rng.randrange(size) for _ in range(60)]) for _ in range(2))
            one, two = one[one != two], two[one != two]

            def common(a, b, numbers=numbers):
                k = 0
                while max(a, b) + k < len(numbers) and numbers[a + k] == numbers[b + k]:
                    k += 1
                return k

            assert Extensions(np.array(numbers)).between(one, two).tolist() == [common(a, b) for a, b in zip(one.tolist(), two.tolist(), strict=True)]


@pytest.mark.parametrize("together", [1_500_000, 50])
def test_runs_by_definition(monkeypatch, together):
    monkeypatch.setattr(repeats, "GRID_PLACES", together)
    rng = random.Random(together)

    def made():
        words, size = [], rng.randint(0, 200)
        while len(words) < size:
            words += [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 9))] * rng.choice([1, 1, 2, 3, 4, 5, 9])
        return np.array(words[:size], np.int64)

    for _ in range(60):
        texts = [made() for _ in range(rng.randint(1, 6))]
        for exponent, least in ((4, 6), (2, 2), (3, 7)):
            for words, found in zip(texts, repeats.runs_of(texts, exponent, least), strict=True):
                assert [(int(a), int(p), int(b)) for a, b, p in zip(*found, strict=True)] == runs_by_definition(words.tolist(), exponent, least)


def looped_words(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_run_digests_by_brute_force(documents, odd, none):
    rows = documents.select("doc_id", F.substring("text", 1, 3000).alias("text")).union(odd.select("doc_id", "text"))
    want = Counter()
    for r in rows.collect():
        words = looped_words(r.doc_id, r.text)
        runs = runs_by_definition(words)
        dropped = {i for a, p, b in runs for i in range(a + p, b)}
        best = min(((-(b - a), a, p) for a, p, b in runs), default=None)
        top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        told = "".join(f"{a},{b - a},{p}\n" for a, p, b in runs)
        want[r.doc_id, len(runs), *top, sha(told), sha(" ".join(w for i, w in enumerate(words) if i not in dropped))] += 1
    assert Counter(map(tuple, repeats.digests(rows).collect())) == want
    assert sum(n for k, n in want.items() if k[1]) > 10
    assert repeats.digests(none).count() == 0


def test_very_long_texts(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(["the " * 1_000_000, *MILLION.values()])], "doc_id long, text string")
    found = {r.doc_id: r for r in repeats.collapse(rows).collect()}
    assert [tuple(x) for x in found[0].runs] == [(0, 1_000_000, 1)] and found[0].collapsed == "the"
    assert found[1].collapsed == "x" and found[2].runs == [] and found[3].collapsed == "some words,"
    assert [tuple(x) for x in found[4].runs] == [(0, 333_333, 1)]
