"""Registered queries of this package, and their check statements."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession

from visitlake.llm import (
    best_packing, fingerprints, licenses, middles, packing, pieces, pii, quality, repeats, shingle_join, token_counts, vectors, warc,
)
from visitlake.llm.workers import importable
from visitlake.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_table(spark, sf_dir, table))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(prepare(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Query]:
    return {
        "op1_licenses": _over("documents", licenses.scan),
        "op2_warc": _over("pages", warc.archived),
        "op3_quality": lambda s, d: quality.scored(_table(s, d, "documents"), _table(s, d, "labels")),
        "op4_fingerprints": _over("documents", fingerprints.edited),
        "op5_embedding_dedup": _over("embeddings", vectors.near_duplicates),
        "op6_sentencepiece": _over("documents", lambda d: pieces.digests(d, vocabulary("piece_bpe_32k.model"))),
        "op7_pii": _over("documents", pii.digests),
        "op8_shingle_join": _over("documents", lambda d: shingle_join.similar_classes(d, words=4, percent=85)),
        "op9_packing": _over("documents", lambda d: packing.placed(d, vocabulary("byte_bpe_50k.json"))),
        "op10_token_counts": _over("documents", lambda d: token_counts.count_tokens(d, vocabulary("word_bpe_49k.json"))),
        "op11_fill_in_middle": _over("documents", middles.digests),
        "op12_best_fit_packing": _over("documents", lambda d: best_packing.placed(d, vocabulary("word_bpe_49k.json"))),
        "op13_periodic_runs": _over("documents", repeats.digests),
    }


WARC = """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_page
    FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
FROM firsts
"""


def statements() -> dict[str, str]:
    return {"op1_licenses": licenses.statement(), "op2_warc": WARC, "op11_fill_in_middle": middles.STATEMENT}
