"""Personal data in texts: exact patterns, and weak labelers that vote on the doubtful rest (operator 7).

The base spans are those of four fixed patterns and their checks; they always stay.
Candidates beyond them come from wider patterns of email and phone. Labelers vote
on base spans and candidates alike: patterns of form, gazetteers of words beside the
span, and the context; none of them sees whether a span is a base span.
Expectation-maximisation finds, for every kind, how often each labeler votes against,
abstains and votes for on spans that are personal data and on those that are none, and
what share of the candidates is; a span classifier is trained on its outcome for the
candidates, from features of form and surroundings. What it accepts is added if it
overlaps no base span.

Base spans and candidates of a kind have the same weight in the estimates, however many
there are, so that the answer depends on shares, not on the size of the input. Nothing
but a belief held beforehand, of a stated weight (BELIEF, EXPECTED, HELD), stands beside
the data: a labeler whose votes do not tell the two classes apart loses its say.

All text work is native expressions. Only numbers per combination of votes and
features come to the driver, whose count is bounded by the labelers, not the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.fingerprints import let

KINDS = ("email", "ip", "card", "phone")
#: Code points before and after a span that labelers see.
AROUND = 40
ROUNDS = 60
#: A classifier's answer from which on a candidate is added.
ACCEPT = 0.9

LOCAL = "[A-Za-z0-9._%+-]"
LABEL = "[A-Za-z0-9-]"
#: The base patterns, written so that the matcher neither recurses per repetition nor
#: tries again inside a run it has left: a match may begin at the end of the last one
#: or where a run begins. The card pattern is applied to a prepared text, see below.
BASE = {
    "email": (rf"(?<!{LOCAL})", rf"{LOCAL}++@{LABEL}++\.(?={LABEL})[A-Za-z0-9.-]*?(?=\.(?!{LABEL})|[^A-Za-z0-9.-]|\z)"),
    "ip": (r"(?<![0-9])", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"(?<![0-9\x01])", r"[0-9][0-9\x01]++"),
    "phone": (r"", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Wider patterns: obfuscated addresses, and numbers that a labeler has to vouch for.
WIDE = {
    "email": (r"(?<![A-Za-z0-9._%+-])", r"[A-Za-z0-9._%+-]{1,64}\x20?[\[({]?\x20?(?:at|AT|@)\x20?[\])}]?\x20?[A-Za-z0-9-]{1,63}\x20?[\[({]\x20?(?:dot|DOT)\x20?[\])}]\x20?[A-Za-z]{2,24}(?![A-Za-z0-9])"),
    "phone": (r"(?<![0-9A-Za-z+.-])", r"\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z]|[.-][0-9])"),
}
#: Words that stand beside personal data, in the languages of the corpus.
GAZETTEER = {
    "email": "mail|e-mail|email|contact|write|correo|courriel|schreiben",
    "ip": "ip|host|server|address|addr|adresse|dirección",
    "card": "card|visa|mastercard|amex|credit|tarjeta|carte|karte|kreditkarte",
    "phone": "phone|tel|call|mobile|cell|fax|teléfono|téléphone|telefon|appelez|anrufen",
}
LABELERS = ("form", "gazetteer", "closed", "plain")
VOTES = (-1, 0, 1)
#: Share of a kind's candidates believed to be personal data before any vote is seen.
EXPECTED = {"email": 0.95, "phone": 0.2}
#: How often a labeler is believed to vote against, abstain and vote for, on spans that are none and that are.
BELIEF = {
    "form": ((0.5, 0.0, 0.5), (0.1, 0.0, 0.9)), "gazetteer": ((0.0, 0.995, 0.005), (0.0, 0.6, 0.4)),
    "closed": ((0.4, 0.0, 0.6), (0.2, 0.0, 0.8)), "plain": ((0.4, 0.6, 0.0), (0.1, 0.9, 0.0)),
}
#: What a belief weighs, and all base spans of a kind, where all its candidates weigh 1. Base
#: spans weigh less, as what stands around them need not stand around candidates.
HELD, ANCHOR = 1.0, 0.25
#: Added to every outcome, so that one never seen says nothing.
FLOOR = 1e-6

Reliability = dict[tuple[str, str], tuple[tuple[float, ...], tuple[float, ...]]]


@dataclass(frozen=True)
class LabelModel:
    """For a kind and labeler, how often it votes each way on spans that are none and that are; the share of
    a kind's candidates that are personal data; and the classifier's weights."""

    trust: Reliability
    share: dict[str, float]
    weights: dict[str, float]


def _prepared(text: Column, kind: str) -> Column:
    """The text a pattern is applied to, of the same length in code points.

    For cards, a single blank or hyphen between two digits becomes a mark and all else
    that is no digit is blanked, so that a card is a run of digits and marks.
    """
    if kind != "card":
        return text
    plain = F.regexp_replace(text, r"[^0-9\x20-]", "/")
    return F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", "\x01")


def _present(text: Column, kind: str) -> Column:
    return F.instr(text, {"email": "@", "phone": "+"}[kind]) > 0 if kind in ("email", "phone") else text.rlike("[0-9]")


def located(text: Column, start: str, pattern: str) -> Column:
    """Structs (at, end) of the leftmost matches that do not overlap, in code points.

    Each match is taken with the text before it since the last one, and the lengths are
    added up. The anchor to the last match's end keeps this linear.
    """
    found = rf"\G(|(?s:.)*?{start})({pattern})"
    gaps, hits = F.regexp_extract_all(text, F.lit(found), 1), F.regexp_extract_all(text, F.lit(found), 2)
    sizes = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("size")))
    empty = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<at:int,end:int>>").alias("spans"))
    return F.aggregate(
        sizes, empty,
        lambda state, x: F.struct(
            (state["end"] + x["gap"] + x["size"]).alias("end"),
            F.concat(state["spans"], F.array(F.struct((state["end"] + x["gap"]).alias("at"), (state["end"] + x["gap"] + x["size"]).alias("end")))).alias("spans"),
        ),
        lambda state: state["spans"],
    )


def cut(text: Column, span: Column) -> Column:
    return F.substring(text, span["at"] + 1, span["end"] - span["at"])


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a text of digits is right."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
    ))
    return F.aggregate(each, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0))) % 10 == 0


def valid(kind: str, shown: Column) -> Column:
    """The check a match of a base pattern has to pass."""
    count = F.length(digits(shown))
    if kind == "ip":
        # leading zeros aside, a part has three digits at most before it is read as a number
        parts = F.transform(F.split(shown, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) > 3, F.lit(False)).otherwise(p.cast("int") <= 255))
    if kind == "card":
        return F.when(count.between(13, 19), luhn(digits(shown))).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    spans = F.filter(located(_prepared(text, kind), *BASE[kind]), lambda s: valid(kind, cut(text, s)))
    return F.when(_present(text, kind), spans).otherwise(F.array().cast("array<struct<at:int,end:int>>"))


def wide_spans(text: Column, kind: str, base: Column) -> Column:
    """Candidates of a kind that overlap no base span."""
    present = text.rlike(r"(?i)[\[({]\x20?dot\x20?[\])}]") if kind == "email" else text.rlike(r"[0-9][\x20.-][0-9]{3}")
    found = F.filter(located(text, *WIDE[kind]), lambda s: ~F.exists(base, lambda b: (b["at"] < s["end"]) & (s["at"] < b["end"])))
    return F.when(present, found).otherwise(F.array().cast("array<struct<at:int,end:int>>"))


def kinded(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["at"].alias("at"), s["end"].alias("end")))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``base``: all base spans by kind and place."""
    for kind in KINDS:
        docs = docs.withColumn(f"__{kind}", base_spans(F.col(text), kind))
    every = F.concat(*[kinded(F.col(f"__{kind}"), kind) for kind in KINDS])
    return docs.withColumn("base", every).drop(*[f"__{kind}" for kind in KINDS])


def with_candidates(rows: DataFrame, text: str) -> DataFrame:
    every = F.concat(*[kinded(wide_spans(F.col(text), kind, F.col("base")), kind) for kind in WIDE])
    return rows.withColumn("wide", every)


def voted(text: Column, span: Column) -> Column:
    """A span (kind, at, end, certain) with the labelers' votes and the features."""

    def told(seen: Column) -> Column:
        kind, shown, left, right = span["kind"], seen["shown"], seen["left"], seen["right"]
        count = F.length(digits(shown))
        form = (
            F.when(kind == "email", F.when(shown.rlike(r"\.[A-Za-z]{2,24}$|(?i)dot"), 1).otherwise(-1))
            .when(kind == "ip", F.when(~shown.rlike(r"(^|\.)0[0-9]"), 1).otherwise(-1))
            .when(kind == "card", F.when(shown.rlike("^[3-6]"), 1).otherwise(-1))
            .otherwise(F.when(count.between(9, 15) & F.forall(F.filter(F.split(shown, "[^0-9]+"), lambda g: g != ""), lambda g: F.length(g) <= 5), 1).otherwise(-1))
        )
        near = F.lit(0)
        for name, words in GAZETTEER.items():
            beside = left.rlike(rf"(?iu)(^|[^\p{{L}}])({words})[.:\x20]*[^\p{{L}}]*$")
            near = F.when(kind == name, beside.cast("int")).otherwise(near)
        # a word beside what is malformed vouches for nothing
        near = F.when(form > 0, near).otherwise(0)
        numbers = left.rlike(r"[0-9][\x20.,/-]*$") | right.rlike(r"^[\x20.,/-]*[0-9]")
        closed = left.rlike(r"(^|[\s(\[<:;,])$") & right.rlike(r"^($|[\s)\]>:;,.!?])")
        return F.struct(
            kind.alias("kind"), span["at"].alias("at"), span["end"].alias("end"), span["certain"].alias("certain"),
            form.alias("form"), near.alias("gazetteer"), F.when(closed, 1).otherwise(-1).alias("closed"),
            F.when(numbers & (kind != "email"), -1).otherwise(0).alias("plain"), F.least(count, F.lit(20)).alias("digits"),
            F.when(shown.rlike("[()]"), "brackets").when(shown.rlike(r"[\x20-]"), "gaps").otherwise("solid").alias("look"),
        )

    seen = F.struct(
        cut(text, span).alias("shown"),
        F.substring(text, F.greatest(span["at"] - AROUND + 1, F.lit(1)), F.least(span["at"], F.lit(AROUND))).alias("left"),
        F.substring(text, span["end"] + 1, F.lit(AROUND)).alias("right"),
    )
    return let(seen, told)


def marked(spans: Column, certain: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["at"].alias("at"), s["end"].alias("end"), F.lit(certain).alias("certain")))


FEATURES = ("kind", "digits", "look", "certain")


def fit(voted: DataFrame) -> LabelModel:
    """Reliabilities by expectation-maximisation, then a classifier's weights on its outcome.

    The driver sees how often each combination of votes and features occurs: at most
    3 ** labelers * kinds * 21 digit counts * 3 looks * 2 numbers, whatever the input.
    """
    rows = voted.groupBy(*LABELERS, *FEATURES).agg(F.count("*").alias("n")).collect()
    rows = sorted(rows, key=lambda r: tuple(map(str, r)))
    unsure = [r for r in rows if not r["certain"]]
    total: dict[tuple, int] = {}
    for r in rows:
        total[r["kind"], r["certain"]] = total.get((r["kind"], r["certain"]), 0) + r["n"]
    doubtful = sorted({r["kind"] for r in unsure})
    seen = [r for r in rows if r["kind"] in doubtful]
    share = {kind: EXPECTED[kind] for kind in doubtful}
    trust: Reliability = {(kind, name): _normal(BELIEF[name]) for kind in doubtful for name in LABELERS}
    truth: list[float] = []
    for _ in range(ROUNDS):
        before, truth = truth, [_believed(r, trust, share) for r in seen]
        if before and max((abs(a - b) for a, b in zip(before, truth, strict=True)), default=0) < 1e-9:
            break
        # what the beliefs and then the spans weigh, by labeler, class and vote
        mass = {key: [[HELD * x for x in side] for side in BELIEF[key[1]]] for key in trust}
        found = {kind: HELD * EXPECTED[kind] for kind in doubtful}
        for r, t in zip(seen, truth, strict=True):
            n = r["n"] / total[r["kind"], r["certain"]] * (ANCHOR if r["certain"] else 1)
            for name in LABELERS:
                vote = VOTES.index(r[name])
                mass[r["kind"], name][0][vote] += n * (1 - t)
                mass[r["kind"], name][1][vote] += n * t
            if not r["certain"]:
                found[r["kind"]] += n * t
        trust = {key: _normal(sides) for key, sides in mass.items()}
        share = {kind: value / (1 + HELD) for kind, value in found.items()}
    weights: dict[str, float] = {}
    for _ in range(200):
        slope: dict[str, float] = {}
        mass: dict[str, float] = {}
        for r in unsure:
            t, names = _believed(r, trust, share), _names(r)
            guess = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights.get(x, 0.0) for x in names)))))
            for x in names:
                slope[x] = slope.get(x, 0.0) + r["n"] * (t - guess)
                mass[x] = mass.get(x, 0.0) + r["n"]
        for x in slope:
            weights[x] = weights.get(x, 0.0) + slope[x] / (mass[x] + 1.0) - 0.002 * weights.get(x, 0.0)
    return LabelModel(trust, share, weights)


def _normal(sides) -> tuple[tuple[float, ...], ...]:
    """Weights of outcomes as probabilities, for each class."""
    return tuple(tuple((x + FLOOR) / (sum(side) + len(side) * FLOOR) for x in side) for side in sides)


def _believed(row, trust: Reliability, share: dict[str, float]) -> float:
    """How likely a span is personal data by its votes; a base span is one by definition."""
    if row["certain"]:
        return 0.999
    part = share[row["kind"]]
    odds = math.log(part / (1 - part))
    for name in LABELERS:
        none, some = trust[row["kind"], name]
        vote = VOTES.index(row[name])
        odds += math.log(some[vote] / none[vote])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def _names(row) -> list[str]:
    """Features the classifier knows: form of the span with its kind, and what stands around it."""
    return ["", f"{row['kind']} digits {row['digits']}", f"{row['kind']} {row['look']}", f"near {row['gazetteer']}", f"closed {row['closed']}", f"numbers {row['plain']}", f"form {row['form']}"]


def sure(told: Column, model: LabelModel) -> Column:
    """The classifier's answer for a span with its votes and features."""
    if not model.weights:
        return F.lit(0.0)
    table = F.create_map(*[x for name, w in sorted(model.weights.items()) for x in (F.lit(name), F.lit(w))])
    said = F.array(
        F.lit(""), F.concat(told["kind"], F.lit(" digits "), told["digits"].cast("string")), F.concat_ws(" ", told["kind"], told["look"]),
        F.concat(F.lit("near "), told["gazetteer"].cast("string")), F.concat(F.lit("closed "), told["closed"].cast("string")),
        F.concat(F.lit("numbers "), told["plain"].cast("string")), F.concat(F.lit("form "), told["form"].cast("string")),
    )
    total = F.aggregate(said, F.lit(0.0), lambda s, x: s + F.coalesce(F.try_element_at(table, x), F.lit(0.0)))
    return 1 / (1 + F.exp(-total))


def accepted(text: Column, wide: Column, model: LabelModel) -> Column:
    """The candidates that the classifier accepts."""
    told = F.transform(marked(wide, 0), lambda s: voted(text, s))
    good = F.filter(told, lambda x: sure(x, model) >= ACCEPT)
    return F.transform(good, lambda s: F.struct(s["kind"].alias("kind"), s["at"].alias("at"), s["end"].alias("end")))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep``, ``base`` and ``spans`` (arrays of kind, at, end) of every row.

    Places are code points, the end exclusive. ``spans`` holds all base spans and the
    accepted candidates, by kind and then place. A null text counts as empty. Repeated
    rows are kept. Other columns of ``docs`` are not read. An empty table gives no rows.

    The model is fitted over all rows in a first pass; the second judges each row's
    candidates where they stand, so that texts are never shuffled.
    """
    rows = docs.select(F.col(key), *keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    rows = with_candidates(with_base(rows, "__text"), "__text")
    spans = F.explode(F.concat(marked(F.col("base"), 1), marked(F.col("wide"), 0))).alias("span")
    model = fit(rows.select("__text", spans).select(voted(F.col("__text"), F.col("span")).alias("told")).select("told.*"))
    added = F.when(F.size("wide") > 0, accepted(F.col("__text"), F.col("wide"), model)).otherwise(F.array().cast("array<struct<kind:string,at:int,end:int>>"))
    every = F.concat("base", added)
    return rows.select(key, *keep, "base", in_order(every).alias("spans"))


def in_order(spans: Column) -> Column:
    """By kind as listed, then by place."""
    return F.concat(*[F.sort_array(of_kind(spans, kind)) for kind in KINDS])


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = find(docs)
    count = lambda kind: F.size(of_kind(F.col("base"), kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans count as one, of the first kind."""
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("parts"))
    placed = F.sort_array(F.transform(spans, lambda s: F.struct(s["at"].alias("at"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        end = -s["end"]
        kept = F.struct(F.greatest(state["end"], end).alias("end"), state["parts"].alias("parts"))
        new = F.struct(end.alias("end"), F.concat(state["parts"], F.array(
            F.substring(text, state["end"] + 1, s["at"] - state["end"]), F.concat(F.lit("<"), s["kind"], F.lit(">"))
        )).alias("parts"))
        return F.when(s["at"] < state["end"], kept).otherwise(new)

    done = F.aggregate(placed, start, step, lambda state: F.concat(F.array_join(state["parts"], ""), F.substring(text, state["end"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; a column n_chars is set to the new length. A null text stays null."""
    others = tuple(c for c in docs.columns if c not in (key,))
    found = find(docs.withColumn("__whole", F.struct(*[F.col(c) for c in docs.columns])), key, text, ("__whole",))
    new = F.when(F.col(f"__whole.{text}").isNotNull(), redacted(F.coalesce(F.col(f"__whole.{text}"), F.lit("")), F.col("spans")))
    out = found.select("__whole.*", new.alias("__new")).withColumn(text, F.col("__new")).drop("__new")
    if "n_chars" in others:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
