"""Quality classifier: calibration, held-out accuracy, what it may not look at."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from personweave.llm.quality import STATISTICS, Settings, fit, fourier, held_out, isotonic, quality_scores, statistics, training_rows
from tests.llm.common import clashing, documents

SF = "/root/testdata/sf0.01"


def test_isotonic_is_the_closest_non_decreasing_fit():
    x, y, w = np.arange(8.0), np.array([0, 1, 0, 0, 1, 0, 1, 1.0]), np.ones(8)
    knots, values = isotonic(x, y, w)
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all()
    assert np.allclose(values, [0, 1 / 3, 0.5, 1])


def test_statistics_of_odd_texts():
    for text in (None, "", " \n", "a", "é" * 10, "x" * 300_000, "word " * 100_000):
        stats = statistics(text)
        assert len(stats) == len(STATISTICS) and np.isfinite(stats).all()


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    out = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    good, bad = out.score[out.quality == 1], out.score[out.quality == 0]
    auc = np.mean([(g > bad).mean() + (g == bad).mean() / 2 for g in good])
    assert auc > 0.95
    assert (out.predicted == out.quality).mean() > 0.9
    assert out.predicted[out.quality == 1].mean() > 0.97
    assert out.score.between(0, 1).all()


def test_every_row_once_and_held_out_rows(spark, tables):
    docs, labels = tables
    out = quality_scores(docs, labels).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(r.predicted == int(r.score >= 0.3) for r in out)


def test_held_out_labels_and_other_columns_do_not_matter(spark, tables):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy"), "n_chars": F.lit(0)})
    a = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_scores(other, flipped).collect()}
    assert max(abs(a[i] - b[i]) for i in a) < 1e-6


def test_odd_rows(spark, tables):
    docs, labels = tables
    odd = documents(spark, [(10_001, None), (10_002, ""), (None, "some words"), (10_003, "word " * 100_000), (10_003, "word " * 100_000)])
    more = clashing(docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd))
    extra = spark.createDataFrame([(None, 1, 0), (10_001, None, 0), (1, 7, 0)], labels.schema)
    out = quality_scores(more, labels.unionByName(extra), carry=True)
    rows = out.where("doc_id > 10000 or doc_id is null").select("doc_id", "held_out", "score").collect()
    score = {r.doc_id: r.score for r in rows}
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert score[10_001] == score[10_002]
    assert next(r for r in rows if r.doc_id is None).held_out
    assert out.select("record.*").columns == more.columns


def test_without_labels(spark, tables):
    docs, labels = tables
    out = quality_scores(docs.limit(3), labels.where("false")).collect()
    assert [r.score for r in out] == [0.5] * 3
    assert quality_scores(docs.where("false"), labels).collect() == []


def test_sample_is_bounded(spark, tables):
    docs, labels = tables
    out = quality_scores(docs, labels, settings=Settings(max_rows=100, features=32)).collect()
    assert len(out) == docs.count()


def test_weights_against_direct_ridge(spark, tables):
    """Summed normal equations of tasks and folds give what one ridge regression over all labelled rows gives."""
    docs, labels = tables
    s = Settings(features=24, tasks=3)
    model = fit(training_rows(docs, labels, ~held_out(F.col("doc_id")), s, "doc_id", "text", "quality"), s)
    rows = docs.join(labels, "doc_id").where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("text", "quality").collect()
    stats, y = np.stack([statistics(r.text) for r in rows]), np.array([r.quality for r in rows], float)
    assert np.allclose(model.mean, stats.mean(0))
    z = fourier(stats, stats.mean(0), np.sqrt(np.maximum(stats.var(0), 1e-6)), s)
    # Ridge as least squares with a row per penalised weight.
    extra = np.sqrt(s.ridge) * np.eye(s.features, s.features + 1)
    direct = np.linalg.lstsq(np.vstack([z, extra]), np.concatenate([y, np.zeros(s.features)]), rcond=None)[0]
    assert np.allclose(z @ model.weights[-1], z @ direct, atol=1e-4)
