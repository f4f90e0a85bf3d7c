"""The pipeline's stages against plain Python, each on what its predecessor kept."""

from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline
import pytest
from test_texts import shingles

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    find, low = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), {c: c + 32 for c in range(65, 91)}
    windows = {tuple(w[k:k + 10]) for w in (find.findall((t or "").translate(low)) for t in bench) for k in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "decontamination", "packing"]
    for name, apply in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text or "" for r in docs.collect()}
        docs = corpus_pipeline.stage(apply(spark, docs, SF), "test")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == columns and docs.count() == len(after)
        if name == "quality classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            good, bad = ([i in after for i, q in labels.items() if q == want] for want in (1, 0))
            assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.2
        if name == "exact dedup":
            first = defaultdict(list)
            for i, t in before.items():
                first[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
            assert after == {min(ids) for ids in first.values()}
        if name == "near dedup":
            sets, kept = {i: shingles(t) for i, t in before.items()}, set()
            group = {i: i for i in sets}
            for i in sorted(sets):
                for j in sorted(sets):
                    if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                        a, b = sorted((group[i], group[j]))
                        group = {k: a if g == b else g for k, g in group.items()}
            kept = {i for i in sets if group[i] == i}
            assert after == kept
        if name == "decontamination":
            words = {i: find.findall(t.translate(low)) for i, t in before.items()}
            assert after == {i for i, w in words.items() if not any(tuple(w[k:k + s]) in windows for s in sizes for k in range(len(w) - s + 1))}
        if name == "packing":
            assert after == set(before)


def test_run_is_registered_and_carries_through(spark):
    got = contract.queries()["pipeline"](spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count()


@pytest.mark.parametrize("number", range(1, 14))
def test_each_operator_has_its_query(number):
    assert sum(name.startswith(f"op{number}_") for name in contract.queries()) == 1
