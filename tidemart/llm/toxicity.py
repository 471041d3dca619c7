"""Toxicity: boosted trees over dense features of whole texts, calibrated by isotonic regression.

The features are densities of two lexicons (words, and beginnings of words), the share of lexicon words
close to a second-person word, and rates of capitals, punctuation, exclamation marks and obfuscated
words (symbols or digits inside letters; they are also looked up with the usual letters put back).

The labels are learned on a bounded sample (``SAMPLE_ROWS``) outside the held-out third. The lexicons are
words whose share of toxic texts is far above the usual. Each half of the sample (by a hash of the id)
gets its features from the lexicons of the other half, so no text is scored by its own words; the
trees are fitted on 14 of 20 parts and calibrated on the others. Scoring uses the lexicons of both halves.

Null, empty and wordless texts have all features 0 and are scored like any other. Without labels of
both kinds every score is the share of toxic labels (0 without labels). Every row is returned with its
columns; columns of the same names as the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm import boosting, common
from tidemart.session import stored

SAMPLE_ROWS = 20_000
LEXICON_ROWS = 4_000
LEAST_TOXIC_TEXTS = 4
LEAST_LOG_ODDS = 2.0
PREFIX = 4
NEAR = 5
CUT = 0.7
WORD = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"[^\W\d_]+(?:[0-9@$*!]+[^\W\d_]+)+")
LETTERS = str.maketrans("013457@$!", "oleastasi", "*")
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch tu te toi ton ta tes vous "
    "votre vos tú ti contigo usted ustedes vosotros".split())
CAPITALS = bytes(range(65, 91))
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"
N_FEATURES = 12


class Lexicon(dict):
    """Weight of a word: its log odds, or else those of its beginning; remembered for many words."""

    LIMIT = 500_000

    def __init__(self, listed: dict[str, float]):
        super().__init__()
        self.words = {k[1:]: v for k, v in listed.items() if k[0] == "w"}
        self.starts = {k[1:]: v for k, v in listed.items() if k[0] == "p"}

    def __missing__(self, word: str) -> tuple[float, float, bool]:
        if len(self) >= self.LIMIT:
            self.clear()
        start = self.starts.get(word[:PREFIX], 0.0) if len(word) > PREFIX else 0.0
        value = self[word] = (self.words.get(word, 0.0), start, word in SECOND_PERSON)
        return value


def features(text: str, lexicon: Lexicon) -> list[float]:
    if not text:
        return [0.0] * N_FEATURES
    low, raw = text.lower(), text.encode("utf-8", "replace")
    words = WORD.findall(low)
    if not words:
        return [0.0] * N_FEATURES
    seen = np.array([lexicon[w] for w in words], np.float32)
    hit = np.flatnonzero((seen[:, 0] > 0) | (seen[:, 1] > 0))
    you = np.flatnonzero(seen[:, 2])
    near = 0.0
    if len(hit) and len(you):
        at = np.searchsorted(you, hit)
        gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hit), np.abs(you[np.maximum(at - 1, 0)] - hit))
        near = float((gap <= NEAR).mean())
    masked = OBFUSCATED.findall(low)
    plain = [lexicon[w.translate(LETTERS)] for w in masked]
    n, size = len(words), len(raw)
    by_word = seen[:, 0][seen[:, 0] > 0]
    by_start = seen[:, 1][seen[:, 1] > 0]
    return [len(by_word) / n, float(by_word.sum()) / n, min(len(by_word), 50.0),
            len(by_start) / n, float(by_start.sum()) / n, min(len(by_start), 50.0),
            near, len(you) / n,
            (size - len(raw.translate(None, CAPITALS))) / size,
            (size - len(raw.translate(None, PUNCTUATION))) / size,
            raw.count(b"!") / size,
            (len(masked) + 10 * sum(p[0] > 0 or p[1] > 0 for p in plain)) / n]


def lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """Log odds of words ("w...") and beginnings ("p...") that mark toxic texts.

    The first lexicon is of part 0 of the sample, the second of part 1, the third of both; each has at
    most ``LEXICON_ROWS`` entries.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0)))
    marked = sample.select("label", "half", words.alias("w")).select("label", "half", F.explode(F.array_union(
        F.transform("w", lambda w: F.concat(F.lit("w"), w)),
        F.transform(F.filter("w", lambda w: F.length(w) > PREFIX),
                    lambda w: F.concat(F.lit("p"), F.substring(w, 1, PREFIX))))).alias("entry"))

    def sums() -> list:
        return [f(F.when(F.col("half") == h, F.col("label") if f is F.sum else F.lit(1))).alias(f"{n}{h}")
                for h in (0, 1) for n, f in (("t", F.sum), ("n", F.count))]

    totals = sample.agg(*sums()).na.fill(0).first()
    counts = stored(marked.groupBy("entry").agg(*sums()).na.fill(0).where(
        F.col("t0") + F.col("t1") >= LEAST_TOXIC_TEXTS), "lexicon")
    found = []
    for halves in ((0,), (1,), (0, 1)):
        t, n = (sum((F.col(f"{k}{h}") for h in halves), F.lit(0)) for k in "tn")
        toxic = sum(totals[f"t{h}"] for h in halves)
        fine = sum(totals[f"n{h}"] for h in halves) - toxic
        odds = F.log(((t + 0.5) / (toxic + 1.0)) / ((n - t + 0.5) / (fine + 1.0)))
        picked = counts.where(t >= LEAST_TOXIC_TEXTS).select("entry", odds.alias("odds")).where(
            F.col("odds") >= LEAST_LOG_ODDS).orderBy(F.desc("odds"), "entry").limit(LEXICON_ROWS)
        found.append({r.entry: r.odds for r in picked.collect()})
    return found


class Model:
    def __init__(self, lexicon: dict[str, float], trees: boosting.Trees | None, knots, rates, share: float):
        self.lexicon, self.trees, self.knots, self.rates, self.share = lexicon, trees, knots, rates, share

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(rows), self.share)
        return np.interp(self.trees.raw(rows), self.knots, self.rates)


def _feature_rows(first: dict[str, float], second: dict[str, float]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Lexicon(first), Lexicon(second)]
        for batch in batches:
            # A text's features come from the lexicon of the half that it is not in.
            found = [features(x.as_py() or "", known[1 - h.as_py()])
                     for x, h in zip(batch.column(0), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.float64()))],
                ["label", "part", "x"])
    return rows


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``rows`` labelled texts; only their features come to the driver."""
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(20)).cast("int")
    sample = common.labelled_sample(docs, labels, "toxic", rows).withColumn("part", place).withColumn(
        "half", F.col("part") % 2)
    first, second, both = lexicons(sample)
    found = sample.select("text", "label", "part", "half").mapInArrow(
        _feature_rows(first, second), "label int, part int, x array<double>").toPandas()
    y = found["label"].to_numpy(float)
    x = np.array(found["x"].tolist(), float).reshape(-1, N_FEATURES)
    held = found["part"].to_numpy() >= 14
    share = float(y.mean()) if len(y) else 0.0
    if not (0 < y[~held].sum() < (~held).sum() and 0 < y[held].sum() < held.sum()):
        return Model(both, None, None, None, share)
    trees = boosting.fit(x[~held], y[~held])
    return Model(both, trees, *boosting.isotonic(trees.raw(x[held]), y[held]), share)


def _score(column: int, model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lexicon(model.lexicon)
        for batch in batches:
            x = np.array([features(t.as_py() or "", known) for t in batch.column(column)], float)
            found = model.score(x.reshape(-1, N_FEATURES))
            yield common.with_arrays(batch, {
                "score": pa.array(found, pa.float64()),
                "predicted": pa.array((found >= CUT).astype(np.int32), pa.int32())})
    return score


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``."""
    common.arrow_rows(docs.sparkSession)
    schema = common.with_fields(docs.schema, T.StructField("score", T.DoubleType()),
                                T.StructField("predicted", T.IntegerType()))
    return docs.mapInArrow(_score(docs.columns.index(text), model), schema)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    common.arrow_rows(spark)
    found = scored(docs, fit(docs, common.table(spark, sf_dir, "labels")))
    return found.select("doc_id", (common.fold(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")
