"""Quality, toxicity and language operators: held-out accuracy, invariants, awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom.llm.language import LanguageModel, features, held_out, identify, linear_svm, train
from scoreloom.llm.quality import QualityModel, best_cut, kth_largest, log_weights, sample_good
from scoreloom.llm.toxicity import SeverityModel, fit_cumulative, fit_severity, grade_severity

SF = "/root/testdata/sf0.01"
ODD = [(9_000_001, None), (9_000_002, ""), (9_000_003, " \n "), (9_000_004, "123 ..."), (9_000_005, "x" * 300_000), (None, "the and of"),
       (9_000_006, "the and of"), (9_000_006, "the and of")]


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(*r, None, None, None) for r in ODD], docs.schema)
    return docs.unionByName(odd).withColumn("score", F.lit("s")).withColumn("kept", F.lit(1)).withColumn("toxic", F.lit("t")).cache()


@pytest.fixture(scope="module")
def labels(spark):
    got = spark.read.parquet(f"{SF}/labels.parquet")
    return got.unionByName(spark.createDataFrame([(None, 1, 1), (5, None, None), (10**9, 1, 0)], got.schema)).cache()


def test_quality_parts_good_from_bad(spark, documents, labels):
    out = sample_good(documents, labels).select("row.doc_id", F.col("row.text").alias("text"), "score", "sample_key", "kept")
    assert out.count() == documents.count()
    judged = out.join(labels, "doc_id").filter("quality is not null").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(judged)
    assert share[1] > 0.97 and share[0] < 0.05
    assert not out.filter("coalesce(trim(text), '') = '' and kept").count()
    assert sample_good(documents, labels, keep=100).filter("kept").count() == 100
    assert sample_good(documents.limit(0), labels).count() == 0
    assert sample_good(documents, labels.limit(0)).filter("kept").count() == documents.count()


def test_log_weights_equal_a_plain_sum(spark):
    from scoreloom.llm.common import WordHash
    from scoreloom.llm.quality import buckets

    ratio = np.random.RandomState(1).randn(1024)
    texts = ["", "a", "a a a", "The cat, the CAT!!", None, "é" * 50]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r.row.doc_id: r for r in log_weights(docs, QualityModel(ratio)).collect()}
    for i, text in enumerate(texts):
        spots = buckets((text or "").encode(), WordHash(), 1024)
        assert got[i].n_grams == len(spots) and got[i].log_weight == pytest.approx(sum(ratio[s] for s in spots))


def test_kth_largest_is_exact(spark):
    draw = random.Random(4)
    values = [draw.gauss(0, 1) ** 3 for _ in range(3000)] + [0.25] * 500 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(7).cache()
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 700, 900, 1500, 3502, 9999):
        assert kth_largest(df, "v", k, at_once=50, bins=16) == ordered[min(k, len(ordered)) - 1]
    assert kth_largest(df, "v", 0) is None and kth_largest(df.limit(0), "v", 3) is None


def test_best_cut_lies_between(spark):
    df = spark.createDataFrame([(-1.0, 0), (-0.5, 0), (0.5, 1), (0.9, 1)], "score double, good int")
    assert -0.5 < best_cut(df) < 0.5
    assert best_cut(df.filter("good = 1")) == -10.0


def test_cumulative_link_fit_orders_grades():
    draw = np.random.RandomState(2)
    n, width = 900, 12
    x = draw.poisson(0.4, (n, width)).astype(float)
    s = x[:, 0] * 2 + x[:, 1] * 1.5 + draw.logistic(size=n)
    grades = np.digitize(s, [1.0, 3.0])
    rows, columns = np.nonzero(x)
    w, thresholds = fit_cumulative(rows, columns, x[rows, columns], grades, width, np.full(n, 1 / n), l1=1e-4, steps=800, rate=0.5)
    assert w[0] > w[1] > 1 and np.abs(w[2:]).max() < 0.5
    assert np.all(np.diff(thresholds) > 0) and abs(thresholds[0] - 1) < 0.5 and abs(thresholds[1] - 3) < 0.7


def test_toxicity(spark, documents, labels):
    marked = [(20_000_000 + i, f"the and of {w} in {w} was", 1) for i, w in enumerate(["idiot", "scum", "moron", "trash"] * 10)]
    docs = documents.select("doc_id", "text", "toxic").unionByName(spark.createDataFrame([(i, t, "x") for i, t, _ in marked], "doc_id long, text string, toxic string"))
    more = labels.unionByName(spark.createDataFrame([(i, 1, 1) for i, _, _ in marked], labels.schema))
    model = fit_severity(docs, more)
    assert model.weights[b"idiot"] > 0.5 and np.all(np.diff(model.thresholds) >= 0)
    got = grade_severity(docs, model)
    assert got.columns == ["doc_id", "severity", "grade", "toxic"] and got.count() == docs.count()
    rows = got.join(more.withColumnRenamed("toxic", "label"), "doc_id").filter("label is not null").collect()
    bad, good = [r for r in rows if r.label], [r for r in rows if not r.label]
    assert np.mean([r.toxic for r in bad]) > 0.7 and np.mean([r.toxic for r in good]) < 0.03
    assert all(0 <= r.severity <= len(model.thresholds) for r in rows)
    fresh = spark.createDataFrame([(1, "you are a moron and an idiot scum"), (2, "a fine day in the park"), (3, None), (4, "")], "doc_id int, text string")
    flags = {r.doc_id: r.toxic for r in grade_severity(fresh, model).collect()}
    assert flags == {1: True, 2: False, 3: False, 4: False}
    assert grade_severity(docs.limit(0), model).count() == 0
    assert not grade_severity(docs, SeverityModel()).filter("toxic or severity > 0").count()
    assert fit_severity(docs, labels.limit(0)).weights == {}


def test_languages(spark, documents):
    model = train(documents, rows=800)
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    out = identify(documents, model)
    assert out.count() == documents.count()
    checked = out.filter(held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("lang_pred") == 2)).agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("lang")).first()
    assert checked[0] > 0.97 and checked[1] > 100
    odd = {r.doc_id: (r.lang_pred, r.score) for r in out.filter("doc_id > 9000000").collect()}
    assert [odd[9_000_000 + k][0] for k in (1, 2, 3, 4)] == ["und"] * 4 and odd[9_000_006][0] in ("de", "en", "es", "fr")
    assert not out.filter("not score between 0 and 1").count()
    assert identify(documents.limit(0), model).count() == 0
    assert train(documents.limit(0)) == LanguageModel(4096)
    assert set(r[0] for r in identify(documents, LanguageModel(64)).select("lang_pred").distinct().collect()) == {"und"}


def test_held_out_follows_crc32(spark):
    import zlib

    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_features_do_not_depend_on_the_cut():
    text = b"abc def " * 300_000
    raw = features(text, 4096)
    assert abs(float(raw @ raw) - 1) < 1e-3 and np.count_nonzero(raw) < 60


def test_linear_svm_separates():
    draw = np.random.RandomState(0)
    x = draw.randn(300, 5).astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.2, 1.0, -1.0)
    w = linear_svm(x, y)
    assert np.mean(np.sign(x @ w[:-1] + w[-1]) == y) > 0.97


def test_sample_shares_at_any_size(spark):
    from pyspark.sql import functions as F

    from scoreloom.llm import samples

    for n in (2, 1_000, 3_000_000_000, 10**13):
        assert abs((samples.share(1000, n) + 1) * n / 2**63 - min(n, 1000)) < 1
    rows = spark.range(40_000).withColumn("label", (F.col("id") < 50).cast("int"))
    got = {r.label: r["count"] for r in samples.bounded_sample(rows, F.col("label"), F.col("id"), 1000).groupBy("label").count().collect()}
    assert got[1] == 50 and 850 < got[0] < 1150


def test_shares_of_target_and_raw_text_equal_plain_counts(spark, labels):
    from collections import Counter

    from scoreloom.llm.common import WordHash
    from scoreloom.llm.quality import buckets, fit_ratio

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in labels.filter("quality = 1 and doc_id is not null").collect()}
    raw, target, width = Counter(), Counter(), 512
    for r in docs.collect():
        found = buckets((r.text or "").encode(), WordHash(), width).tolist()
        raw.update(found)
        if r.doc_id in good:
            target.update(found)
    share = [np.array([c[b] + 1.0 for b in range(width)]) for c in (target, raw)]
    want = np.log(share[0] / share[0].sum()) - np.log(share[1] / share[1].sum())
    assert fit_ratio(docs, labels, width=width).ratio == pytest.approx(want, abs=1e-12)


def test_gumbel_sample_follows_the_weights(spark, monkeypatch):
    """Two kinds of documents, of which the heavier is e times as likely to be drawn; the sample differs from the plain top."""
    from scoreloom.llm import quality
    from scoreloom.llm.common import WordHash

    width = 1 << 14
    ratio = np.zeros(width)
    ratio[quality.buckets(b"heavy", WordHash(), width)] = 1.0
    monkeypatch.setattr(quality, "fit_ratio", lambda *a, **k: QualityModel(ratio))
    n, k = 4000, 2000
    docs = spark.createDataFrame([(i, "heavy" if i % 2 else "light") for i in range(2 * n)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    # The share drawn of weight w by the time the sample is full is 1 - exp(-t w), for the t that fills it.
    t = max(x / 10000 for x in range(1, 20000) if n * (2 - np.exp(-x / 10000) - np.exp(-x / 10000 * np.e)) <= k)
    want = n * (1 - np.exp(-t * np.e))
    samples = []
    for seed in (1, 2, 3):
        kept = quality.sample_good(docs, labels, keep=k, seed=seed).filter("kept").select("row.*").collect()
        samples.append({r.doc_id for r in kept})
        heavy = sum(r.text == "heavy" for r in kept)
        assert len(kept) == k and abs(heavy - want) < 5 * np.sqrt(want * (1 - want / n))
    assert len(samples[0] & samples[1]) < k and k / 4 < len([i for i in samples[0] if i % 2 == 0])
