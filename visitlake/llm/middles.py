"""Fill-in-the-middle form of documents (operator 11).

One match of a repeated unit over a whole text retains where every repetition ended, so
that the number of units and both cuts are read off without a loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit of a text: one code point.
CODE_POINT = r"(?s:.)"
#: Marks before prefix, suffix and middle. A text that holds one stays plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
SEED = "1:"
TEXTS_PER_PART = 500


def _draws(key: Column, seed: str) -> list[Column]:
    """Four numbers of 32 bits by document: the first groups of eight digits of a digest."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, unit: str = CODE_POINT, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    seed: str = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
) -> DataFrame:
    """``keep`` columns with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``fim_text``.

    ``unit`` is a pattern of the ``regex`` library without groups; a text is the longest
    sequence of whole units from its beginning, and one that is not made of units alone
    is refused by an error, since a part would be lost. Prefix and middle are counted in
    code points. A null text counts as an empty one, which is plain, as is a text that
    holds a mark; counts are NULL then. A null ``key`` is drawn for as an empty text.
    Repeated rows give equal rows each, an empty table none, and other columns are not
    read. A text of any length is one match, which holds about 60 bytes a unit while it
    is looked at.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    first, second, third, fourth = _draws(F.col(key), seed)
    marked = whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE)
    form = F.when((whole == "") | marked | (third % 100 >= plain_from), "plain").when(fourth % 100 < spm_below, "spm").otherwise("psm")
    rows = docs.select(
        *[F.col(c) for c in keep], whole.alias("__text"), form.alias("__form"), first.alias("__one"), second.alias("__two")
    )
    kept = docs.select(*keep).schema
    schema = ", ".join(
        [*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields],
         "n bigint", "form string", "prefix_chars bigint", "middle_chars bigint", "fim_text string"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*")
        width = len(kept)
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS_PER_PART):
                part = batch.slice(begin, TEXTS_PER_PART)
                told = [arranged(units, *row) for row in zip(*(c.to_pylist() for c in part.columns[width:]), strict=True)]
                sizes, prefixes, middles, outputs = zip(*told, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:width], pa.array(sizes, pa.int64()), part.column(width + 1),
                     pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.string())],
                    [*kept.names, "n", "form", "prefix_chars", "middle_chars", "fim_text"],
                )

    return rows.mapInArrow(run, schema)


def arranged(units: regex.Pattern, text: str, form: str, one: int, two: int) -> tuple[int, int | None, int | None, str]:
    """Units of a text, lengths of prefix and middle, and the text in its form."""
    found = units.fullmatch(text)
    if found is None:
        raise ValueError("a text is not made of units alone")
    ends = found.ends(1)
    if form == "plain":
        return len(ends), None, None, text
    low, high = sorted((one % (len(ends) + 1), two % (len(ends) + 1)))
    start, end = (ends[k - 1] if k else 0 for k in (low, high))
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if form == "psm":
        return len(ends), start, end - start, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return len(ends), start, end - start, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def restored(form: Column, output: Column) -> Column:
    """The text again. Marks occur only where they were put, as texts that hold one stay plain."""
    parts = F.split(F.substring(output, 4, 2**31 - 1), f"{PREFIX}|{SUFFIX}|{MIDDLE}")

    def joined(*order: int) -> Column:
        return F.concat(*[F.get(parts, k) for k in order])

    return F.when(form == "plain", output).when(form == "psm", joined(0, 2, 1)).otherwise(joined(1, 2, 0))


def digests(docs: DataFrame) -> DataFrame:
    """Form and cuts of every document, with digests of the text in its form and of the text rebuilt from it."""
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("fim_text")), 256).alias("restored_sha256"),
    )


#: The same in SQL. Empty ids and texts as stated above.
STATEMENT = f"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS body, length(coalesce(text, '')) AS n,
           sha256('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), cut AS (
    SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS two,
           CASE WHEN n = 0 OR contains(body, '{PREFIX}') OR contains(body, '{SUFFIX}') OR contains(body, '{MIDDLE}')
                     OR CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 >= {PLAIN_FROM} THEN 'plain'
                WHEN CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, substr(body, 1, least(one, two)) AS prefix, substr(body, least(one, two) + 1, abs(one - two)) AS middle,
           substr(body, greatest(one, two) + 1) AS suffix
    FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(least(one, two) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(abs(one - two) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
