"""Licence scans: normalised text against licence templates, by Dice's coefficient of word bigrams (operator 1).

A document is looked at as a whole, by its paragraphs and by its lines. Normalised,
each such unit is a list of words, whose bigrams count as often as they occur. As the
coefficient of two bags of sizes a and b is at most 2 min(a, b) / (a + b), the size of
a unit alone rules out all templates much shorter or longer, before a bigram is made.

Licences also stand inside other words, or in several paragraphs of a longer document.
A passage of a bigrams, h of them the template's, reaches a coefficient of p against b
bigrams only if (2 / p - 1) h - (a - h) >= b. So in the sequence of a document's bigrams,
where one of the template's counts 2 / p - 1 and any other -1, the part of the largest
sum is looked at, wherever it begins and ends.

Few documents get that far: a template whose less common words are mostly absent has too
many bigrams missing, for the text and so for each part of it. Those words are counted in
every text, and its units and passages are only held against the templates that are left.

Everything is expressions over one row: no shuffle, no join, no Python.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.fingerprints import let
from visitlake.llm.license_texts import TEMPLATES

#: Coefficient from which on a unit counts as a licence, in hundredths.
PERCENT = 80
#: Words of any English text. They are not counted, as they tell a licence from nothing; this is for speed only.
COMMON = frozenset(
    "a about all also an and any are as at be been but by can do for from had has have he her his if in into is it its may more no not of on one or other our "
    "out she so such than that the their them then there these they this to up was we were what when which who will with work would you your under".split()
)
#: Sizes from which on templates are looked for together: longer texts hold more of the longer templates' words.
LONGER = (40, 400)
#: What is not a letter or a digit separates words.
BETWEEN = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """Words of the normalised text: lower case, everything but letters and digits left out."""
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def templates(rows: list[tuple[str, str]], percent: int) -> list[dict]:
    """Per template: name, number of bigrams, sizes a unit must have, distinct bigrams, and those that repeat with their counts."""
    told = []
    for name, text in rows:
        words = template_words(text)
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        size, counts = len(pairs), {p: pairs.count(p) for p in sorted(pairs)}
        least, most = -(-percent * size // (200 - percent)), (200 - percent) * size // percent
        often = {p: n for p, n in counts.items() if n > 1}
        told.append({"name": name, "size": size, "least": least, "most": most, "keys": [*counts], "often": [*often], "times": [*often.values()]})
    return told


def rare_words(words: list[str], percent: int) -> tuple[list[str], int]:
    """Words of a template, and how many of them a text must have to reach the coefficient with any unit or passage.

    As many bigrams of the template may be missing as its size is above the least number
    shared. Each absent word takes the bigrams that touch it along, and a word that is there
    saves those that touch it at most. Absent words also take as many bigrams as they occur,
    at least. Of all lower limits to the length of words that are not common that which asks
    for the largest share of its words.
    """
    size, times = len(words) - 1, Counter(words)
    spare = size - -(-percent * size // (200 - percent))
    told: tuple[list[str], int] = (sorted(set(words)), 0)
    for length in range(1, 10):
        chosen = {w for w in words if len(w) >= length and w not in COMMON}
        touched = Counter(frozenset(pair) & chosen for pair in zip(words, words[1:], strict=False))
        missing = sum(n for pair, n in touched.items() if pair)
        saves = sorted((sum(n for pair, n in touched.items() if w in pair) for w in chosen), reverse=True)
        need = 0
        while need < len(saves) and missing - sum(saves[:need]) > spare:
            need += 1
        absent = sum(n <= spare for n in accumulate(sorted(times[w] for w in chosen)))
        need = max(need, len(chosen) - absent) if size > 0 else 0
        if need * max(1, len(told[0])) > told[1] * max(1, len(chosen)):
            told = sorted(chosen), need
    return told


def _listed(words: Iterable[str]) -> str:
    return ", ".join(f"'{w}'" for w in sorted(words)) or "NULL"


def with_asked(texts: DataFrame, rows: list[tuple[str, str]], percent: int) -> DataFrame:
    """``texts``, whose ``words`` are arrays, with ``asked``: the numbers, from 1, of the templates that a text has enough words of."""
    told = [(t["least"], *rare_words(template_words(text), percent)) for t, (_, text) in zip(templates(rows, percent), rows, strict=True)]
    groups = [bisect_right(LONGER, t["size"]) for t in templates(rows, percent)]
    there = sorted(set(groups))
    hits = []
    for g in there:
        least = min(t[0] for t, group in zip(told, groups, strict=True) if group == g)
        rare = {w for t, group in zip(told, groups, strict=True) if group == g for w in t[1]}
        hits.append(F.expr(f"if(size(words) > {least}, array_distinct(filter(words, w -> w IN ({_listed(rare)}))), cast(array() AS array<string>))").alias(f"hits{g}"))
    numbers = ", ".join(
        f"if(size(words) > {least} AND size(hits{g}) >= {need} AND size(filter(hits{g}, w -> w IN ({_listed(rare)}))) >= {need}, {n}, NULL)"
        for n, ((least, rare, need), g) in enumerate(zip(told, groups, strict=True), start=1)
    )
    asked = F.expr(f"array_compact(cast(array({numbers}) AS array<int>))")
    return texts.select("*", *hits).select(*texts.columns, asked.alias("asked"))


def units(text: Column) -> Column:
    """The whole text, its paragraphs and its lines, equal ones once."""
    return F.array_distinct(F.concat(F.array(text), F.split(text, r"\n\s*\n"), F.split(text, "\n")))


def _table(told: list[dict]) -> Column:
    kind = "array<struct<name:string,size:int,least:int,most:int,keys:array<string>,often:array<string>,times:array<int>>>"
    return F.from_json(F.lit(json.dumps(told)), kind)


def _pairs(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))


def matches(words: Column, asked: Column, told: list[dict], percent: int) -> Column:
    """Structs of score and licence for the templates asked for that a unit's words reach."""
    table, size = _table(told), F.size(words) - 1

    def common(pairs: Column, t: Column, shared: Column) -> Column:
        """Shared bigrams once each, and those that the template repeats as often again as both do."""
        again = F.zip_with(t["often"], t["times"], lambda k, n: F.greatest(F.least(n, F.size(F.filter(pairs, lambda p: p == k))) - 1, F.lit(0)))
        return F.aggregate(again, shared, lambda s, n: s + n)

    def reached(pairs: Column, sized: Column) -> Column:
        met = F.transform(sized, lambda n: let(F.element_at(table, n), lambda t: F.struct(t.alias("t"), F.size(F.array_intersect(t["keys"], pairs)).alias("shared"))))
        # each distinct bigram of the template that is not shared is missing at least once
        most = lambda m: m["t"]["size"] - F.size(m["t"]["keys"]) + m["shared"]
        near = F.filter(met, lambda m: (m["shared"] > 0) & (200 * most(m) >= percent * (F.size(pairs) + m["t"]["size"])))
        scored = F.transform(near, lambda m: F.struct((2 * common(pairs, m["t"], m["shared"]) / (F.size(pairs) + m["t"]["size"])).alias("score"), m["t"]["name"].alias("license")))
        return F.filter(scored, lambda m: m["score"] * 100 >= percent)

    sized = F.filter(asked, lambda n: size.between(F.element_at(table, n)["least"], F.element_at(table, n)["most"]))
    nothing = F.array().cast("array<struct<score:double,license:string>>")
    return let(sized, lambda s: F.when((F.size(s) > 0) & (size > 0), let(_pairs(words), lambda p: reached(p, s))).otherwise(nothing))


def passages(words: Column, asked: Column, told: list[dict], percent: int) -> Column:
    """Structs of less (the negative score) and licence for the templates asked for that the best passage of a text reaches.

    Of passages that overlap only the best counts, as near relations of a licence match too.
    """
    table = _table(told)
    nothing = F.array().cast("array<struct<less:double,license:string>>")

    def best(pairs: Column, keys: Column) -> Column:
        """Place of the first bigram and number of bigrams of the part with the largest sum; of equal ones the first to end."""

        def step(state: Column, pair: Column) -> Column:
            fresh = state["sum"] <= 0
            sum_ = F.when(fresh, 0).otherwise(state["sum"]) + F.when(F.array_contains(keys, pair), 200 - percent).otherwise(-percent)
            start = F.when(fresh, state["at"]).otherwise(state["start"])
            better = sum_ > state["most"]
            return F.struct(
                (state["at"] + 1).alias("at"), sum_.cast("long").alias("sum"), start.alias("start"),
                F.when(better, sum_).otherwise(state["most"]).cast("long").alias("most"),
                F.when(better, start).otherwise(state["first"]).alias("first"),
                F.when(better, state["at"] - start + 1).otherwise(state["length"]).alias("length"),
            )

        zero = F.struct(*[F.lit(0).cast(t).alias(n) for n, t in (("at", "int"), ("sum", "long"), ("start", "int"), ("most", "long"), ("first", "int"), ("length", "int"))])
        return F.aggregate(pairs, zero, step)

    def scored(part: Column, n: Column, t: Column, b: Column) -> Column:
        shared = F.size(F.array_intersect(t["keys"], part))
        again = F.zip_with(t["often"], t["times"], lambda k, n: F.greatest(F.least(n, F.size(F.filter(part, lambda p: p == k))) - 1, F.lit(0)))
        less = -2 * F.aggregate(again, shared, lambda s, n: s + n) / (F.size(part) + t["size"])
        return F.struct(
            F.struct(less.alias("less"), t["name"].alias("license"), n.alias("number")).alias("rank"),
            b["first"].alias("first"), (b["first"] + b["length"]).alias("end"),
        )

    def better(other: Column, m: Column) -> Column:
        return (other["rank"] < m["rank"]) & (other["first"] < m["end"]) & (m["first"] < other["end"])

    def reached(pairs: Column) -> Column:
        """Of the templates asked for, those that the text has enough of, each with its best passage."""
        known = F.transform(asked, lambda n: let(F.element_at(table, n), lambda t: F.struct(n.alias("n"), t.alias("t"), F.array_intersect(t["keys"], pairs).alias("shared"))))
        near = F.filter(known, lambda k: (200 - percent) * (k["t"]["size"] - F.size(k["t"]["keys"]) + F.size(k["shared"])) >= percent * k["t"]["size"])
        found = F.transform(near, lambda k: let(best(pairs, k["shared"]), lambda b: F.when(
            b["most"] >= percent * k["t"]["size"], let(F.slice(pairs, b["first"] + 1, b["length"]), lambda part: scored(part, k["n"], k["t"], b)))))
        good = F.filter(found, lambda m: -m["rank"]["less"] * 100 >= percent)
        kept = let(good, lambda all_: F.filter(all_, lambda m: ~F.exists(all_, lambda other: better(other, m))))
        return F.transform(kept, lambda m: F.struct(m["rank"]["less"].alias("less"), m["rank"]["license"].alias("license")))

    return F.when((F.size(asked) > 0) & (F.size(words) > 1), let(_pairs(words), reached)).otherwise(nothing)


def scan(docs: DataFrame, rows: list[tuple[str, str]] | None = None, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``license`` (the best, null if none), ``score``, ``n_units``, ``n_passages`` and ``licenses`` of every row.

    A unit counts for its best template; of equal scores the first name. ``n_units`` is
    the number of different units that are a licence, ``n_passages`` that of passages
    that are one, be they units or not; of overlapping ones the best. ``licenses`` are the names of both, distinct
    and in order, and ``license`` and ``score`` the best of all. A template has one passage
    a text; where copies of it follow each other closely, that may be too long to be one. A null or empty text, or
    one of a single word, matches nothing. Repeated rows are kept. Other columns of
    ``docs`` are not read. An empty table gives no rows.
    """
    rows = TEMPLATES if rows is None else rows
    told = templates(rows, percent)
    best = lambda found: F.array_min(F.transform(found, lambda m: F.struct((-m["score"]).alias("less"), m["license"].alias("license"))))
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = with_asked(docs.select(F.col(key), whole.alias("whole"), words_of(whole).alias("words")), rows, percent)
    asked = F.col("asked")
    found = F.transform(units(F.col("whole")), lambda u: let(words_of(u), lambda w: best(matches(w, asked, told, percent))))
    none = F.array().cast("array<struct<less:double,license:string>>")
    found = F.when(F.size(asked) > 0, F.filter(found, lambda b: b.isNotNull())).otherwise(none)
    out = texts.select(key, found.alias("found"), passages(F.col("words"), asked, told, percent).alias("inside"))
    out = out.select(key, F.size("found").alias("n_units"), F.size("inside").alias("n_passages"), F.concat("found", "inside").alias("all"))
    return out.select(
        key, F.array_min("all")["license"].alias("license"), F.round(-F.array_min("all")["less"], 6).alias("score"),
        F.col("n_units").cast("long"), F.col("n_passages").cast("long"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("all", lambda b: b["license"]))), ",").alias("licenses"),
    )


def statement(rows: list[tuple[str, str]] | None = None, percent: int = PERCENT) -> str:
    """The same scan as SQL over bags of bigrams in rows."""
    quoted = ",\n        ".join("({}, '{}', '{}')".format(k, n, t.replace("'", "''")) for k, (n, t) in enumerate(TEMPLATES if rows is None else rows))
    longest = max(t["most"] for t in templates(TEMPLATES if rows is None else rows, percent)) + 1
    return f"""
WITH notices(template, license, text) AS (
    VALUES {quoted}
), unit_texts AS (
    SELECT DISTINCT doc_id, unnest([coalesce(text, '')] || string_split_regex(coalesce(text, ''), '\\n\\s*\\n') || string_split(coalesce(text, ''), chr(10))) AS unit
    FROM documents
), unit_words AS (
    SELECT doc_id, unit, [w FOR w IN string_split_regex(lower(unit), '[^\\p{{L}}\\p{{N}}]+') IF w <> ''] AS words FROM unit_texts
), unit_pairs AS (
    SELECT doc_id, unit, len(words) - 1 AS size, unnest([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS pair
    FROM unit_words WHERE len(words) BETWEEN 2 AND {longest}
), unit_counts AS (
    SELECT doc_id, unit, size, pair, count(*) AS times FROM unit_pairs GROUP BY ALL
), notice_words AS (
    SELECT template, license, [w FOR w IN string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+') IF w <> ''] AS words FROM notices
), notice_pairs AS (
    SELECT template, license, len(words) - 1 AS size, unnest([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS pair FROM notice_words
), notice_counts AS (
    SELECT template, license, size, pair, count(*) AS times FROM notice_pairs GROUP BY ALL
), scores AS (
    SELECT doc_id, unit, license, 2.0 * sum(least(u.times, n.times)) / (any_value(u.size) + any_value(n.size)) AS score
    FROM unit_counts u JOIN notice_counts n USING (pair) GROUP BY doc_id, unit, template, license
), best AS (
    SELECT doc_id, unit, arg_min(license, (-score, license)) AS license, max(score) AS score
    FROM scores WHERE score * 100 >= {percent} GROUP BY doc_id, unit
), text_words AS (
    SELECT DISTINCT doc_id, coalesce(text, '') AS text, [w FOR w IN string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+') IF w <> ''] AS words FROM documents
), text_pairs AS (
    SELECT doc_id, text, unnest(range(1, len(words))) AS place, unnest([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS pair
    FROM text_words WHERE len(words) >= 2
), hits AS (
    SELECT doc_id, text, template, license, n.size, place, row_number() OVER (PARTITION BY doc_id, text, template ORDER BY place) AS nth
    FROM text_pairs JOIN notice_counts n USING (pair)
), sums AS (
    SELECT *, 200 * nth - {percent} * place AS upto,
           min(200 * (nth - 1) - {percent} * (place - 1)) OVER (PARTITION BY doc_id, text, template ORDER BY place) AS before
    FROM hits
), ends AS (
    SELECT *, 200 * (nth - 1) - {percent} * (place - 1) AS start_sum FROM sums
), tops AS (
    SELECT doc_id, text, template, any_value(license) AS license, any_value(size) AS size,
           max(upto - before) AS most, arg_max(place, (upto - before, -place)) AS last, arg_max(before, (upto - before, -place)) AS low
    FROM ends GROUP BY doc_id, text, template HAVING max(upto - before) >= {percent} * any_value(size)
), parts AS (
    SELECT t.doc_id, t.text, t.template, any_value(t.license) AS license, any_value(t.size) AS size, any_value(t.last) AS last, max(e.place) AS first
    FROM tops t JOIN ends e ON t.doc_id IS NOT DISTINCT FROM e.doc_id AND t.text = e.text AND t.template = e.template AND e.start_sum = t.low AND e.place <= t.last
    GROUP BY t.doc_id, t.text, t.template
), part_counts AS (
    SELECT s.doc_id, s.text, s.template, any_value(s.license) AS license, any_value(s.size) AS size, any_value(s.last - s.first + 1) AS length, any_value(s.first) AS first, p.pair, count(*) AS times
    FROM parts s JOIN text_pairs p ON s.doc_id IS NOT DISTINCT FROM p.doc_id AND s.text = p.text AND p.place BETWEEN s.first AND s.last
    GROUP BY s.doc_id, s.text, s.template, p.pair
), passages AS (
    SELECT c.doc_id, c.text, c.template, any_value(c.license) AS license, any_value(c.first) AS first, any_value(c.first + c.length) AS "end",
           2.0 * sum(least(c.times, n.times)) / (any_value(c.length) + any_value(c.size)) AS score
    FROM part_counts c JOIN notice_counts n ON c.template = n.template AND c.pair = n.pair GROUP BY c.doc_id, c.text, c.template
), all_found AS (
    SELECT doc_id, license, score, 1 AS unit, 0 AS passage FROM best
    UNION ALL
    SELECT doc_id, license, score, 0, 1 FROM passages m
    WHERE score * 100 >= {percent} AND NOT EXISTS (
        SELECT 1 FROM passages o
        WHERE o.doc_id IS NOT DISTINCT FROM m.doc_id AND o.text = m.text AND o.first < m."end" AND m.first < o."end" AND o.score * 100 >= {percent}
          AND (o.score > m.score OR o.score = m.score AND (o.license < m.license OR o.license = m.license AND o.template < m.template))
    )
), per_document AS (
    SELECT doc_id, arg_min(license, (-score, license)) AS license, round(max(score), 6) AS score, sum(unit)::BIGINT AS n_units, sum(passage)::BIGINT AS n_passages,
           string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
    FROM all_found GROUP BY doc_id
)
SELECT d.doc_id, p.license, p.score, coalesce(p.n_units, 0) AS n_units, coalesce(p.n_passages, 0) AS n_passages, coalesce(p.licenses, '') AS licenses
FROM documents d LEFT JOIN per_document p USING (doc_id)
"""
