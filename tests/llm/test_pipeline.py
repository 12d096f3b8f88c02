"""The registered queries and the pipeline, stage by stage, on the smallest tables."""

import os
import re
from collections import Counter

import pytest
from helpers import tokens as _tokens

import compare
import corpus_pipeline
from jobstrata.llm import queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_registry():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {re.match(r"op\d+_|", n)[0] for n in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_url_filters_agree_with_sql(spark):
    con = compare.connect(FOLDER)
    got, want, _, _ = compare.run_pair(spark, con, queries.QUERIES["op6_url_filters"], queries.ORACLE["op6_url_filters"], FOLDER)
    assert got == want and any(r[0] for r in got[1])


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    names = ["quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    bench = [" ".join(_tokens(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER), "test_stage")
        after = docs.collect()
        counts.append(len(after))
        ids = {r.doc_id for r in after}
        if k < 4:
            assert docs.columns == columns
        if name == "quality rules":
            assert all(r.doc_id not in ids for r in before if labels.get(r.doc_id) == 0)
            good = [r for r in before if labels.get(r.doc_id) == 1 and len(r.text.split()) >= 50]
            assert sum(r.doc_id in ids for r in good) >= 0.95 * len(good)
        if name == "SimHash near-dedup":
            assert max(Counter(r.text for r in after).values()) == 1
        if name == "benchmark decontamination":
            dirty = {r.doc_id for r in before if any(b in " ".join(_tokens(r.text)) for b in bench)}
            assert not dirty & ids and ids >= {r.doc_id for r in before} - dirty
        if name == "secret scans":
            assert len(after) == len(before)
            assert not any(re.search(r"AKIA[A-Z0-9]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}\"", r.text) for r in after)
    assert {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} == set(docs.columns)
    assert counts == sorted(counts, reverse=True)
