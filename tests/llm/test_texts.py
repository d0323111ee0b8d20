"""Licences, quality, fingerprints, personal data and the shingle join."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlake.llm import fingerprints, licenses, pii, quality, shingle_join
from visitlake.llm.components import components
from visitlake.llm.license_bodies import PUBLISHED
from visitlake.llm.license_texts import TEMPLATES


# --- licences ---------------------------------------------------------------


def bigrams(text):
    words = re.findall(r"[^\W_]+", text.lower())
    return Counter(zip(words, words[1:], strict=False))


def best_of(unit):
    mine = bigrams(unit)
    scored = []
    for name, text in TEMPLATES:
        theirs = bigrams(text)
        total = sum(mine.values()) + sum(theirs.values())
        if mine and 200 * sum((mine & theirs).values()) >= 80 * total:
            scored.append((-2 * sum((mine & theirs).values()) / total, name))
    return min(scored, default=None)


def best_passages(text):
    """(-score, name) of each template's part with the largest sum, of overlapping ones the best."""
    words = re.findall(r"[^\W_]+", text.lower())
    pairs = list(zip(words, words[1:], strict=False))
    found = []
    for number, (name, body) in enumerate(TEMPLATES):
        theirs = bigrams(body)
        size = sum(theirs.values())
        sums = np.cumsum([0, *[120 if p in theirs else -80 for p in pairs]])
        low = np.minimum.accumulate(sums)[:-1]
        gain = sums[1:] - low
        if len(gain) and gain.max() >= 80 * size:
            last = int(gain.argmax())
            first = int(np.flatnonzero(sums[: last + 1] == low[last])[-1])
            part = Counter(pairs[first : last + 1])
            shared = sum((part & theirs).values())
            if 200 * shared >= 80 * (last + 1 - first + size):
                found.append((-2 * shared / (last + 1 - first + size), name, number, first, last))
    return [f[:2] for f in found if not any(g < f and g[3] <= f[4] and f[3] <= g[4] for g in found)]


def test_licences_by_brute_force(spark, documents, none, odd):
    extra = [
        (900, "Intro.\nLicensed under the Apache License, Version 2.0.\nEnd."), (901, TEMPLATES[-3][1].upper()), (902, "MIT"), (903, None),
        (904, "licensed under the mit license, licensed under the mit license"), (905, "x\n\n" + TEMPLATES[-5][1].replace(" ", "\n", 20) + "\n \ny"),
        (906, "This work is licensed under the GNU General Public License, version 2.\nReleased under the MIT License."),
        (907, "Some prose. Licensed under the MIT License. More prose follows here, and licensed under CC BY 4.0. too"),
        (908, "## License\n\n" + PUBLISHED.get("MIT", TEMPLATES[-3][1]).replace(": The above", ":\n\nThe above").replace("Software. THE", "Software.\n\nTHE") + "\n\n## Usage\n\nrun it"),
    ]
    rows = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in licenses.scan(rows).collect():
        text = texts[r.doc_id]
        units = {text, *re.split(r"\n\s*\n", text), *text.split("\n")}
        found = [b for b in map(best_of, units) if b]
        inside = best_passages(text)
        assert (r.n_units, r.n_passages) == (len(found), len(inside)), r
        found += inside
        assert r.licenses == ",".join(sorted({name for _, name in found}))
        assert (r.license, r.score) == ((min(found)[1], round(-min(found)[0], 6)) if found else (None, None))
    assert licenses.scan(none).count() == 0 and licenses.scan(odd).count() == odd.count()


def test_published_texts_are_found(spark):
    """Whole texts under a copyright line; the BSD ones end with the liability part."""
    whole = {name: text for name, text in TEMPLATES if len(text) > 600}
    wanted = {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"}
    assert wanted <= set(whole)
    liability = "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT"
    assert all(liability in whole[n] and whole[n].endswith("OF SUCH DAMAGE.") for n in ("BSD-2-Clause", "BSD-3-Clause"))
    rows = [(name, f"Copyright (c) 2001, Ann Author\n\n{PUBLISHED.get(name, whole[name])}") for name in sorted(wanted)]
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect():
        assert r.license == r.doc_id and r.score > 0.95, r


def test_published_texts_are_found_between_prose(spark):
    """Paragraphs of a licence in a document of other paragraphs, wrapped anywhere, and the words on every side."""
    prose = " ".join(f"word{k % 37} and{k % 11}" for k in range(400))
    whole = {name: text for name, text in TEMPLATES if len(text) > 600}
    bodies = {name: PUBLISHED.get(name, text) for name, text in whole.items()}
    rows = [(name, f"{prose}\n\n## License\n\n{body}\n\n{prose}") for name, body in sorted(bodies.items())]
    rows += [(f"{name} wrapped", f"{prose} " + re.sub(r"(\S+\s+\S+\s+\S+)\s+", r"\1" "\n\n", body) + f" {prose}") for name, body in sorted(bodies.items())]
    rows += [("none", prose)]
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect():
        if r.doc_id == "none":
            assert (r.license, r.n_passages, r.licenses) == (None, 0, "")
        else:
            assert r.license == r.doc_id.split()[0] and r.score > 0.95, r


def test_prose_asks_for_no_template(spark):
    """Words of any text leave no template to be looked for, and each one named is asked for."""
    prose = "this work was released to the public by people under the general terms of a version that is in use, and the source is subject to them"
    words = set(licenses.template_words(prose))
    for name, text in TEMPLATES:
        chosen, need = licenses.rare_words(licenses.template_words(text), 80)
        assert len(words & set(chosen)) < need, (name, text[:60])
    rows = [(0, prose), *((n, f"{prose} {text}") for n, (_, text) in enumerate(TEMPLATES, start=1))]
    texts = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", licenses.words_of(F.col("text")).alias("words"))
    asked = {r.doc_id: r.asked for r in licenses.with_asked(texts, TEMPLATES, 80).collect()}
    assert asked.pop(0) == [] and all(n in numbers for n, numbers in asked.items())


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_a_text_that_reaches_a_template_has_its_rare_words(percent):
    """Drop words and parts at random: whatever reaches the coefficient has as many rare words as asked for."""
    rng, reached = np.random.default_rng(11), 0
    for text in [t for _, t in TEMPLATES if len(t) < 2500] + ["a b a b a b a", "the of the", "x y"]:
        words = licenses.template_words(text)
        theirs = Counter(zip(words, words[1:], strict=False))
        chosen, need = licenses.rare_words(words, percent)
        for trial in range(60):
            gone = set(rng.choice(sorted(set(words)), rng.integers(0, len(set(words)) // 3 + 1), replace=False)) if trial % 2 else set()
            first, last = sorted(rng.integers(0, len(words) + 1, 2)) if trial % 3 == 0 else (0, len(words))
            kept = [w for w in words[first:last] if w not in gone]
            mine = Counter(zip(kept, kept[1:], strict=False))
            if mine and 200 * sum((mine & theirs).values()) >= percent * (sum(mine.values()) + len(words) - 1):
                reached += 1
                assert len(set(kept) & set(chosen)) >= need, (text[:60], kept)
    assert reached > 100


# --- quality ----------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 90
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_quality_labels_do_not_leak(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.fit(documents, x) for x in (labels, turned))
    assert np.array_equal(one.gains, two.gains) and one.offset == two.offset


def test_rare_class_is_sampled_up_to_the_bound_and_its_odds_are_put_back(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda samples: seen.append([s[2] for s in samples]) or quality.Model(np.zeros(quality.BUCKETS, np.float32), 0.5))
    rows = [(k, f"text {k}", int(k % 20 > 0)) for k in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    repeated = frame.union(frame.where("doc_id < 60"))
    learned = [label for k, _, label in rows if zlib.crc32(str(k).encode()) % 3 != 1]
    rare = learned.count(0)
    assert 15 < rare < 25
    model = quality.fit(repeated, frame, per_class=50)
    # every row of the rare class, 50 of the other, and one row of an id
    assert seen[0].count(0) == rare and seen[0].count(1) == 50
    assert model.offset == pytest.approx(0.5 + math.log((len(learned) - rare) / 50))


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (6, None), (7, 7), (None, 1), (8, 1)], "doc_id long, quality int")
    rows = quality.scored(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2, 3)}) == 1
    assert quality.scored(none, labels).count() == 0
    assert quality.scored(odd, labels.where("1 = 0")).count() == odd.count()
    kept = quality.kept(odd, quality.fit(odd, labels))
    assert kept.columns == odd.columns


def test_training_uses_the_text():
    good, bad = [f"fine words {k}" for k in range(40)], [f"xx{k} !!! ###" for k in range(40)]
    model = quality.train([(*quality.features(t), label) for texts, label in ((good, 1), (bad, 0)) for t in texts])
    scorer = quality.Scorer(model)
    assert scorer.score("fine words 77") > 0.5 > scorer.score("yy !!! ###")
    places, counts = quality.features("fine words fine")
    total = sum(float(model.gains[p]) * c for p, c in zip(places, counts, strict=True)) / counts.sum() + model.offset
    assert scorer.score("fine words fine") == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-6)


# --- fingerprints -----------------------------------------------------------


def test_edited_texts(documents, odd, none):
    rows = documents.select("doc_id", "text").where("doc_id >= 20").union(odd.select("doc_id", "text"))
    keyed = sorted(((r.doc_id, r.text or "") for r in rows.collect() if r.doc_id is not None), key=lambda r: (-r[0], r[1]))
    want = Counter()
    for k, (i, text) in enumerate(keyed):
        half, after = len(text) // 2, keyed[(k + 1) % len(keyed)][1]
        want[i, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()] += 1
    found = fingerprints.edited(rows).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found if r.doc_id is not None) == want
    by_text = {}
    for r in found:
        if r.doc_id is not None and r.doc_id not in (10, 11):
            text = next(t for i, t in keyed if i == r.doc_id)
            assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    large = [r for r in found if r.n_chars > 800]
    assert np.mean([r.near_edited for r in large]) > 0.06 > 0.02 > np.mean([r.near_next for r in large])
    assert fingerprints.edited(none).count() == 0


def test_fingerprints_follow_edit_distance(spark):
    words = [f"w{k}" for k in range(400)]
    shuffled = [*words[200:], *words[:200]]
    texts = [words, [*words[:390], *"a b c d e f g h i j".split()], [*words[:200], *[f"v{k}" for k in range(200)]], shuffled[::-1], words]
    rows = fingerprints.fingerprints(spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id int, text string"))
    told = {r.doc_id: r.places for r in rows.collect()}
    alike = [np.mean([a == b for a, b in zip(told[0], told[k], strict=True)]) for k in range(5)]
    assert alike[0] == alike[4] == 1 and alike[1] > 0.7 > alike[2] > alike[3] == 0


def test_repeats_count(spark):
    rows = spark.createDataFrame([(1, "a b " * 50), (2, "a b " * 100)], "doc_id int, text string")
    told = [r.places for r in fingerprints.fingerprints(rows).orderBy("doc_id").collect()]
    assert told[0] != told[1]


def test_all_kmers_compete(spark):
    """Each function's least k-mers by brute force over all of them."""
    texts = [" ".join(f"w{(k * k) % 700}" for k in range(n)) for n in (2, 3, 5, 40, 65, 300, 1500)] + ["b a " * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    told = {r.doc_id: r.places for r in fingerprints.fingerprints(docs).collect()}
    kmer = F.shiftright("x", fingerprints.POSITION_BITS)
    rows = docs.select("doc_id", F.explode(fingerprints.numbered(fingerprints.kmers(F.col("text")))).alias("x")).crossJoin(spark.range(1, 33).select(F.col("id").cast("int").alias("n")))
    made = rows.select("doc_id", "n", "x", F.xxhash64(kmer, "n").alias("h")).collect()
    by_place = {}
    for r in made:
        by_place.setdefault((r.doc_id, r.n), []).append((fingerprints.RANKS[r.n - 1][r.x >> 57], (r.h % 2**64) >> 33, r.x))
    picked = [(d, n, [x >> 26 for _, _, x in sorted(sorted(v)[:2], key=lambda t: t[2] % 2**26)]) for (d, n), v in by_place.items()]
    want = spark.createDataFrame(picked, "doc_id int, n int, h array<bigint>").select("doc_id", "n", F.xxhash64("h", "n").alias("place")).collect()
    assert len(want) == 32 * len(texts)
    for r in want:
        assert told[r.doc_id][r.n - 1] == r.place


@pytest.mark.parametrize("more", [200, 1000, 2000])
def test_likeness_of_a_text_and_a_longer_one(spark, more):
    """Two of a function's minima are shared with the chance that two k-mers of the longer text are of the shorter one."""
    pairs = [[" ".join(f"{k}x{j}" for j in range(n)) for n in (2000, 2000 + more)] for k in range(24)]
    rows = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, one string, two string")
    alike = rows.select(fingerprints.likeness(fingerprints.signature(F.col("one")), fingerprints.signature(F.col("two"))).alias("s")).collect()
    assert np.mean([r.s for r in alike]) == pytest.approx((2000 / (2000 + more)) ** 2, abs=0.07)
    assert np.std([r.s for r in alike]) < 0.11


# --- personal data ----------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, shown):
    digits = re.sub("[^0-9]", "", shown)
    if kind == "ip":
        return all(int(p) <= 255 for p in shown.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def base_of(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m.group())]


def test_base_spans_by_the_given_patterns(spark, documents, odd, none):
    rng = np.random.default_rng(5)
    made = ["".join(rng.choice(list("aA01259@@..++--() %_é𝒳\n"), rng.integers(1, 60))) for _ in range(1500)]
    made += ["".join(rng.choice(list("4111 -1+0.\x01"), rng.integers(1, 80))) for _ in range(1500)]
    made += ["a@b.c%d@e.f", "a@b.c.d..e", "4111 1111 1111 1111 4111 1111 1111 1111", "1 " * 20000, "a@" + "b." * 20000, "+1" + "(" * 20000, "1" * 3000, "001.2.3.4 +0000000001"]
    rows = spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(made)], "doc_id long, text string")
    rows = rows.union(documents.select("doc_id", "text")).union(odd.select(F.col("doc_id") + 5000, "text"))
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in pii.digests(rows).collect():
        known = base_of(texts[r.doc_id])
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in known)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest(), texts[r.doc_id][:200]
        counts = Counter(k for k, _, _ in known)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in PATTERNS]
        assert set(filter(None, told.split(","))) <= set(filter(None, r.spans.split(",")))
    assert pii.digests(none).count() == 0


def test_candidates_are_added_and_clean_texts_left_alone(spark):
    base = [(k, f"call +1 (713) 555-{1000 + k} or write ann{k}@host.com now") for k in range(300)]
    hidden = [(1000, "write to bob [at] host (dot) org today"), (1001, "meet at noon. dot com boom (at) 5"), (1002, "room 12 345 678 of 9"), (1003, "plain words at a dot")]
    found = {r.doc_id: r.spans for r in pii.digests(spark.createDataFrame(base + hidden, "doc_id long, text string")).collect()}
    assert found[1000] == "email:9:32" and found[1001] == found[1003] == ""


@pytest.mark.parametrize("beside", ["tel", "see"])
@pytest.mark.parametrize("size", [1, 100_000])
@pytest.mark.parametrize("rare", [1, 10_000])
def test_trust_does_not_depend_on_sizes(spark, beside, size, rare):
    """Labelled national numbers are added, unlabelled and malformed ones are not, whatever the counts."""
    base = [(f"{beside} +1 (713) 555-1000 now", 1, 5, 23, size * 10), (f"{beside} +44 20 7946 0000, 5", 1, 4, 20, size)]
    wide = {"tel: 555 123 4567": (5, 17), "room 12 345 678 of 9": (5, 15), "made 212 345 6789 of it": (5, 17), "tel 12 345 678": (4, 14)}
    for common in wide:
        rows = base + [(t, 0, *at, rare if t == common else 1) for t, at in wide.items()]
        frame = spark.createDataFrame(rows, "text string, certain int, at int, end int, n int")
        span = F.struct(F.lit("phone").alias("kind"), "at", "end", "certain")
        votes = frame.select("text", "n", "certain", pii.voted(F.col("text"), span).alias("told"))
        model = pii.fit(votes.select("told.*", F.explode(F.sequence(F.lit(1), "n"))))
        sure = {r.text: r.sure for r in votes.where("certain = 0").select("text", pii.sure(F.col("told"), model).alias("sure")).collect()}
        assert [t for t in wide if sure[t] >= pii.ACCEPT] == ["tel: 555 123 4567"], (common, sure, model)


def test_labelled_national_numbers_are_added(spark):
    base = [(k, f"see +1 (713) 555-{1000 + k} or write ann{k}@host.com now") for k in range(300)]
    hidden = [(1000, "tel: 555 123 4567"), (1002, "room 12 345 678 of 9"), (1003, "made 212 345 6789 of it")]
    found = {r.doc_id: r.spans for r in pii.digests(spark.createDataFrame(base + hidden, "doc_id long, text string")).collect()}
    assert found[1000] == "phone:5:17" and found[1002] == found[1003] == ""


def fitted(spark, rows):
    """The model of spans given as (kind, certain, form, gazetteer, closed, plain, how many)."""
    layout = "kind string, certain int, form int, gazetteer int, closed int, plain int, n int"
    spans = spark.createDataFrame(rows, layout).select("*", F.lit(10).alias("digits"), F.lit("gaps").alias("look"))
    return pii.fit(spans.select("*", F.explode(F.sequence(F.lit(1), "n")).alias("k")))


def odds_of(model, name, vote, kind="phone"):
    none, some = model.trust[kind, name]
    return some[pii.VOTES.index(vote)] / none[pii.VOTES.index(vote)]


@pytest.mark.parametrize("size", [1, 1000])
def test_every_labeler_is_estimated(spark, size):
    """A labeler's say follows the data, up and down, and does not rest at a limit."""
    base = [("phone", 1, 1, 1, 1, 0, 8 * size), ("phone", 1, 1, 0, 1, 0, 2 * size)]
    # beside look-alikes stands a word as often as beside base spans, or nearly never
    useless = base + [("phone", 0, -1, 1, -1, -1, 8 * size), ("phone", 0, -1, 0, -1, -1, 2 * size)]
    useful = base + [("phone", 0, -1, 1, -1, -1, 1), ("phone", 0, -1, 0, -1, -1, 10 * size)]
    without, with_it = fitted(spark, useless), fitted(spark, useful)
    believed = pii.BELIEF["gazetteer"]
    assert odds_of(without, "gazetteer", 1) < 2 < 20 < believed[1][2] / believed[0][2]
    assert odds_of(with_it, "gazetteer", 1) > 4 * odds_of(without, "gazetteer", 1)
    # numbers beside a span tell the classes apart in one input, and nothing in another
    mixed = [("phone", 1, 1, 1, 1, 0, size), ("phone", 1, 1, 1, 1, -1, size), ("phone", 0, -1, 0, -1, 0, size), ("phone", 0, -1, 0, -1, -1, size)]
    before = pii.BELIEF["plain"][1][0] / pii.BELIEF["plain"][0][0]
    # the belief holds half of the weight, so that votes that tell nothing leave 0.4 of a belief of 0.25
    assert 2 * odds_of(with_it, "plain", -1) < before < odds_of(fitted(spark, mixed), "plain", -1) / 1.5
    for name in pii.LABELERS:
        told = {tuple(model.trust["phone", name]) for model in (without, with_it, fitted(spark, mixed))}
        assert len(told) == 3, name


def test_the_share_of_candidates_follows_the_votes(spark):
    base = [("phone", 1, 1, 1, 1, 0, 10)]
    many = fitted(spark, base + [("phone", 0, 1, 1, 1, 0, 90), ("phone", 0, -1, 0, -1, -1, 10)])
    few = fitted(spark, base + [("phone", 0, 1, 1, 1, 0, 10), ("phone", 0, -1, 0, -1, -1, 90)])
    assert many.share["phone"] > 0.5 > 0.3 > few.share["phone"] and many.share.keys() == {"phone"}


def test_redaction_keeps_columns(spark, odd):
    rows = odd.withColumn("text", F.when(F.col("doc_id") == 4, "é ann@host.com, 1.2.3.4 é").otherwise(F.col("text")))
    out = pii.redact(rows)
    assert out.columns == rows.columns and out.count() == rows.count()
    changed = out.where("doc_id = 4").first()
    assert (changed.text, changed.n_chars) == ("é <email>, <ip> é", 17)
    assert out.where("doc_id = 0").first().text is None


# --- shingle join -----------------------------------------------------------


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute_components(sets, percent):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_shingle_join_by_brute_force(spark, documents, odd, none, size, percent):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(500)]
    base = list(rng.choice(vocabulary, 120))
    near = []
    for k in range(120):  # a chain of edits: neighbours are linked, ends are not
        base = base.copy()
        base[rng.integers(0, 120)] = f"new{k}"
        near.append((2000 + k, " ".join(base)))
    shared = [(3000 + k, "a passage that all of these documents share in full " * 2 + " ".join(rng.choice(vocabulary, 80))) for k in range(60)]
    rows = documents.select("doc_id", "text").union(odd.where("doc_id <> 11").select(F.col("doc_id") + 1000, "text"))
    rows = rows.union(spark.createDataFrame(near + shared, "doc_id long, text string"))
    sets = {r.doc_id: shingles(r.text, size) for r in rows.collect()}
    want = brute_components(sets, percent)
    found = shingle_join.similar_classes(rows, size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), want[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("near_block", "block", "near_bands"), [(8, 8, 1), (40, 1000, 4)])
def test_shingle_join_in_small_blocks(spark, monkeypatch, near_block, block, near_bands):
    """Groups that fall into many blocks, of copies of one text and in a chain, are found whole in every round."""
    monkeypatch.setattr(shingle_join, "NEAR_BLOCK", near_block)
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join, "NEAR_BANDS", near_bands)
    rng = np.random.default_rng(4)
    vocabulary = [f"w{k}" for k in range(900)]
    texts, base = [], list(rng.choice(vocabulary, 150))
    for k in range(80):
        copy = base.copy()
        copy[rng.integers(0, 150)] = f"new{k}"
        texts.append(copy)
    for k in range(60):
        base = base.copy()
        base[rng.integers(0, 150)] = f"next{k}"
        texts.append(base)
    texts += [list(rng.choice(vocabulary, rng.integers(1, 90))) for _ in range(60)]
    rows = [(int(i), " ".join(t)) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]
    sets = {i: shingles(t, 5) for i, t in rows}
    found = shingle_join.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(sets, 80)


def test_shingle_join_odd_rows(odd, none):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in shingle_join.similar_classes(odd).collect()}
    assert {(0, 0, 0), (1, 0, 1), (11, 2, 10), (10, 2, 10)} <= rows and (None, 1, None) in rows
    assert shingle_join.similar_classes(none).count() == 0
    kept = shingle_join.first_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, *range(11)]


def test_trees_lose_no_pair():
    rng = np.random.default_rng(8)
    for own in (True, False):
        groups = []
        for _ in range(2):
            base = rng.integers(0, 2**63, 60, dtype=np.uint64)
            groups.append([np.unique(np.r_[base[: rng.integers(20, 60)], rng.integers(0, 2**63, rng.integers(0, 30), dtype=np.uint64)]) for _ in range(150)])
        if not own:
            groups[1] = groups[1] + [g[: max(5, len(g) - 2)] for g in groups[0][:40]]
        trees = []
        for group in groups:
            marks = [shingle_join.bitmap(g) for g in group]
            excess = np.array([len(g) - int.from_bytes(m, "big").bit_count() for g, m in zip(group, marks, strict=True)])
            trees.append(shingle_join.SignatureTree(np.array([len(g) for g in group]), excess, np.frombuffer(b"".join(marks), np.uint64).reshape(len(group), -1)))
        other = groups[0] if own else groups[1]
        i, j = shingle_join.tree_pairs(trees[0], None if own else trees[1], 80)
        found = {(min(a, b), max(a, b)) if own else (a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
        for a, x in enumerate(groups[0]):
            for b, y in enumerate(other):
                common = len(np.intersect1d(x, y))
                if (not own or a < b) and 100 * common >= 80 * (len(x) + len(y) - common):
                    assert (a, b) in found


def test_components_of_paths_stars_and_rings(spark):
    pairs = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(200, 260)] + [(300, 301), (301, 302), (302, 300), (7, 7), (None, 5)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert roots == {k: 100 for k in range(101, 161)} | {k: 1 for k in range(200, 260)} | {301: 300, 302: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
