"""Archives, embeddings and the pipeline."""

import gzip
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from visitlake.llm import vectors, warc
from visitlake.session import fresh_path

ODD_PAGES = [
    (1, "u", None), (2, None, ""), (3, "a\r\nb: c", "é" * 60), (4, "u", "é" * 60), (None, "u", "é" * 60), (5, "u", "short"), (6, "u", "short"),
    (7, "u", "WARC/1.1\r\n\r\n" * 30), (8, "u", "z" * 2_000_000), (9, "u", "z" * 2_000_000), (4, "u", "é" * 60),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(ODD_PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(F.col("page_id") + 100, "url", "html", F.lit("x"))
    return rows.union(given).repartition(3)


def test_archives_round_trip(pages):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = {}
    for i, payload in rows:
        if len(payload) >= 100 and i is not None:
            first[payload] = min(first.get(payload, i), i)
    want = Counter()
    for i, payload in rows:
        leader = first.get(payload, i)
        revisit = i is not None and leader != i
        want[i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", leader if revisit else None] += 1
    found = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived(pages).collect())
    assert found == want
    assert warc.archived(pages.where("1 = 0")).count() == 0


@pytest.mark.parametrize("compressed", ["true", "false"])
def test_archives_are_plain_gzip_and_filters_are_pushed(spark, pages, compressed):
    warc.register(spark)
    folder = fresh_path(spark, "warc-test")
    warc.page_records(pages).write.format("warc").option("compressed", compressed).option("archivebytes", "20000").mode("append").save(folder)
    read = spark.read.format("warc").load(folder)
    assert read.count() == pages.count() and read.select("file").distinct().count() > 2
    revisits = read.where("record_type = 'revisit' and payload_digest like 'sha256:%'")
    plan = read.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter isnotnull" not in plan and "BatchScan warc" in plan
    assert revisits.count() == warc.page_records(pages).where("record_type = 'revisit'").count()
    bare = spark.read.format("warc").option("payload", "false").load(folder)
    assert bare.where("payload is not null").count() == 0
    name = read.select("file").first()[0]
    raw = open(name, "rb").read()
    data = gzip.decompress(raw) if compressed == "true" else raw
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")


def test_payloads_are_not_decoded_when_headers_fail(monkeypatch, tmp_path):
    big = warc.record_bytes([("WARC-Type", "response")], b"y" * 5_000_000, True)
    small = warc.record_bytes([("WARC-Type", "request")], b"x", True)
    (tmp_path / "a.warc.gz").write_bytes(big + small + big)
    reader = warc.ArchiveReader({"path": str(tmp_path)}, warc.SCHEMA)
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("record_type",), "request"), GreaterThan(("content_length",), 0)]))
    assert len(left) == 1
    read = []

    class Counted:
        def __init__(self, data):
            self.data = data

        def size(self):
            return len(self.data)

        def read_at(self, size, offset):
            read.append(min(size, len(self.data) - offset))
            return self.data[offset : offset + size]

    found = list(warc.records(Counted(big + small + big), reader.tests, True))
    assert [(o, p) for o, _, p in found] == [(len(big), b"x")] and sum(read) <= 3 * warc.HEAD_BYTES


def test_members_without_a_length_are_read_too(tmp_path):
    plain = [gzip.compress(warc.record_bytes([("WARC-Type", t)], t.encode() * 9000, False)) for t in ("response", "request", "metadata")]
    (tmp_path / "b.warc.gz").write_bytes(b"".join(plain))
    reader = warc.ArchiveReader({"path": str(tmp_path)}, warc.SCHEMA)
    rows = [row for part in reader.partitions() for row in reader.read(part)]
    assert [(r[0], len(r[7])) for r in rows] == [("response", 72000), ("request", 63000), ("metadata", 72000)]


# --- embeddings -------------------------------------------------------------


def test_links_by_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=64)
    rows = [(int(r.vec_id), [float(x) for x in r.embedding]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    rows += [(2000 + k, (base + 0.05 * rng.normal(size=64)).tolist()) for k in range(200)]  # one dense group
    rows += [(3000 + k, (base + 0.22 * rng.normal(size=64)).tolist()) for k in range(200)]  # around the threshold
    rows += [(4000, rows[0][1]), (4001, rows[0][1]), (4001, rows[0][1]), (4002, [3 * x for x in rows[1][1]])]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 64), (5003, [None, 1.0]), (5004, [float("nan")] * 64), (5005, [float("inf")] * 64), (5006, [1.0, 2.0]), (5007, [2.0, 4.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("digest", F.lit("clash"))
    given = frame.where("vec_id < 5000").collect()
    units = np.array([np.array(r.embedding, np.float64) for r in given])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= 0.95
    sure = (units @ units.T >= 0.95 + 1e-9) | ~(units @ units.T >= 0.95 - 1e-9)
    assert sure.all()
    ids = [r.vec_id for r in given]
    root = list(range(len(ids)))
    for _ in range(20):
        root = [min(root[j] for j in np.flatnonzero(near[k])) for k in range(len(ids))]
    label = {}
    for k, r in enumerate(root):
        label[r] = min(label.get(r, ids[k]), ids[k])
    want = Counter((ids[k], int(near[k].sum()) - 1, label[root[k]]) for k in range(len(ids)))
    found = vectors.near_duplicates(frame).collect()
    mine = Counter((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id < 5000)
    assert mine == want
    rest = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found if r.vec_id >= 5000}
    assert all(rest[i] == (0, i, True) for i in range(5000, 5006)) and rest[5007] == (1, 5006, False)
    assert vectors.near_duplicates(frame.where("1 = 0")).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    units = rng.normal(size=(400, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    code, along, rest = vectors.encode(units, 192)
    turn = vectors.rotations(64, 192)
    estimates = (np.where(code, 1.0, -1.0) @ (units @ turn.T).T) / (np.sqrt(192) * along[:, None])
    exact = units @ units.T
    off = ~np.eye(400, dtype=bool)
    error = estimates - exact
    spread = (rest[:, None] / np.sqrt(63)) * np.sqrt(1 - np.minimum(exact**2, 1))
    assert abs(error[off].mean()) < 0.003
    assert (np.abs(error[off]) <= vectors.SPREAD * spread[off]).mean() > 0.9999


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 20)
    rng = np.random.default_rng(1)
    base = rng.normal(size=16)
    rows = [(k, (base + 0.01 * rng.normal(size=16)).tolist()) for k in range(150)]
    found = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(149, 0)}


# --- pipeline ---------------------------------------------------------------


def test_pipeline_stages_keep_columns_and_take_effect(spark, documents):
    counts, docs = [documents.count()], documents
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, "/root/testdata/sf0.001")
        path = fresh_path(spark, f"test-{name}")
        rows.write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.select("doc_id").distinct().count())
        if name != "packing":
            assert docs.columns == documents.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "packing"]
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4]


def test_pipeline_handles_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.count() <= odd.count()
