"""Quality rules at several sizes: the buckets follow the n-grams, and joined ratios equal listed ones."""

import math

import brute
import pytest
from llm_rows import FEW, prose

from tidemart.llm import quality_rules
from tidemart.session import settings


@pytest.mark.parametrize("size, listed", [(40, True), (320, True), (40, False)])
def test_scores_at_two_loads(spark, monkeypatch, size, listed):
    if not listed:
        monkeypatch.setattr(quality_rules, "MOST_LISTED", 0)
    rows = [(k, " ".join(prose(k, 80))) for k in range(size)] + [(None, None), (3, "repeated id")]
    docs = spark.createDataFrame(rows, FEW)
    grams = {g for _, t in rows for w in [(t or "").split()] for g in [*w, *zip(w, w[1:])]}
    buckets = quality_rules.bucket_number(docs)
    assert abs(len(grams) / buckets / quality_rules.PER_BUCKET - 1) < 0.1
    trusted = spark.createDataFrame([(k,) for k in range(0, size, 4)], "doc_id long")
    got = [(r.doc_id, r.n_words, r.score) for r in quality_rules.quality_rules(docs, trusted).collect()]
    scores = brute.quality_scores(rows, set(range(0, size, 4)), buckets, quality_rules.PRIOR)
    want = [(d, len((t or "").split()), s) for (d, t), s in zip(rows, scores, strict=True)]
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert a[:2] == b[:2] and (a[2] is None) == (b[2] is None) and abs((a[2] or 0) - (b[2] or 0)) < 1e-9


def test_windows_of_equal_hashes_are_compared_as_text(spark, monkeypatch):
    rows = [(k, " ".join([*prose(k, 60), *prose(k, 60)[: 7 * (k % 3)]])) for k in range(12)]
    whole = quality_rules.F.xxhash64
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *c: whole(*c) % 40)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality_rules.base_counts(
        spark.createDataFrame(rows, FEW)).collect()}
    assert got == {d: brute.base_counts(t) for d, t in rows}


def test_buckets_are_counted_in_few_tasks(spark, tmp_path):
    """What the counting tasks send follows their number times the buckets: small files do not make more tasks."""
    docs = spark.createDataFrame([(k, " ".join(prose(k, 20))) for k in range(64)], FEW)
    docs.repartition(64).write.parquet(f"{tmp_path}/docs")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "512"}):
        many = spark.read.parquet(f"{tmp_path}/docs")
        assert many.rdd.getNumPartitions() > 32
        few = quality_rules.in_large_tasks(many)
        assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and few.count() == 64


def test_ratios_are_listed_in_pieces(spark, monkeypatch):
    """In the order of their buckets, and also for as many buckets as 6 GB of documents ask for."""
    assert quality_rules.MOST_LISTED >= 10_000_000
    monkeypatch.setattr(quality_rules, "PIECE", 16)
    counts = {b: (b % 7 + 1, b % 2) for b in range(0, 100, 3)}
    rows = spark.createDataFrame([(b, *c) for b, c in counts.items()], "bucket int, raw long, target long")
    raws, targets = (sum(c[k] for c in counts.values()) for k in (0, 1))
    got = quality_rules.weights(rows, 100).first()["ratio"]
    prior = quality_rules.PRIOR
    for b, ratio in enumerate(got):
        raw, target = counts.get(b, (0, 0))
        assert abs(ratio - math.log((target + prior) / (raw / raws * targets + prior))) < 1e-12
    assert len(got) == 100
    assert quality_rules.weights(rows.withColumn("target", rows.target * 0), 100).first()["ratio"] is None
