"""Quality classifier: hashed word and character n-gram vectors, averaged, with a softmax output.

A text's units are its lower-cased words and their character n-grams with word ends marked, and for each
word that follows itself one bigram unit, whatever the word, which counts ``REPEAT_WEIGHT`` times. Each
unit has a learned vector in one of ``BUCKETS`` rows. The mean vector goes through a softmax. Vectors and
output are trained by plain stochastic gradient descent in numpy on at most ``SAMPLE_ROWS`` whole labelled
texts outside the held-out third; the tasks send these texts' unit counts, not the texts.

For scoring, the output layer is applied to each vector once, so a word adds two numbers, remembered for
many words.

Null, empty and blank texts have no units and get the share of label 1 in the sample as score, as has
every text when labels of one kind are missing (0 without labels). Every row is returned with its
columns; columns of the same names as the results are replaced.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm import common

SAMPLE_ROWS = 3_000
BUCKETS = 1 << 16
WIDTH = 16
SIZES = (3, 4, 5)
REPEATED = zlib.crc32(b"= =") % BUCKETS
REPEAT_WEIGHT = 4
EPOCHS = 8
RATE = 0.5
CUT = 0.5


def units(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams."""
    found = [zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS]
    marked = f"<{word}>"
    for size in SIZES:
        found += [zlib.crc32(marked[i:i + size].encode("utf-8", "replace")) % BUCKETS
                  for i in range(len(marked) - size + 1)]
    return found


def repeats(words: list[str]) -> int:
    return sum(map(operator.eq, words, words[1:]))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, counts = [], []
        for text in batch.column(0):
            found: Counter[int] = Counter()
            words = (text.as_py() or "").lower().split()
            if again := repeats(words):
                found[REPEATED] += again * REPEAT_WEIGHT
            for word, n in Counter(words).items():
                for unit in units(word):
                    found[unit] += n
            ids.append(np.fromiter(found.keys(), np.uint16, len(found)).tobytes())
            counts.append(np.fromiter(found.values(), np.float32, len(found)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
            ["doc_id", "label", "ids", "counts"])


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS,
          rate: float = RATE) -> np.ndarray:
    """Logits (buckets x 2) of each vector after training; samples are (buckets, shares, label)."""
    draw = np.random.default_rng(7)
    vectors = draw.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    output = draw.normal(0, 0.1, (WIDTH, 2)).astype(np.float32)
    steps, done = epochs * len(samples), 0
    # Kinds weigh alike, so a rare kind is learned too.
    share = np.bincount([s[2] for s in samples], minlength=2) / len(samples)
    for _ in range(epochs):
        for k in draw.permutation(len(samples)):
            ids, shares, label = samples[k]
            hidden = shares @ vectors[ids]
            logits = hidden @ output
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[label] -= 1
            error *= rate * (1 - done / steps) * 0.5 / share[label]
            change = output @ error
            output -= np.outer(hidden, error)
            # The unit shares are small; scaled by their norm a step moves the mean by about its rate.
            vectors[ids] -= np.outer(shares / max(float(shares @ shares), 1e-3) * 0.05, change)
            done += 1
    return vectors @ output


class Model:
    def __init__(self, logits: np.ndarray | None, share: float):
        self.logits, self.share = logits, share


class WordLogits(dict):
    """(sum of logit differences, number of units) of a word, remembered for many words."""

    LIMIT = 500_000

    def __init__(self, logits: np.ndarray):
        super().__init__()
        self.difference = (logits[:, 1] - logits[:, 0]).tolist()

    def __missing__(self, word: str) -> tuple[float, int]:
        if len(self) >= self.LIMIT:
            self.clear()
        found = units(word)
        value = self[word] = (sum([self.difference[u] for u in found]), len(found))
        return value


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``rows`` labelled texts."""
    sample = common.labelled_sample(docs, labels, "quality", rows)
    found = sample.select("text", "doc_id", "label").mapInArrow(
        _counts, "doc_id long, label int, ids binary, counts binary").collect()
    samples = []
    for row in sorted(found, key=lambda r: r.doc_id):
        counts = np.frombuffer(row.counts, np.float32)
        if len(counts):
            samples.append((np.frombuffer(row.ids, np.uint16), counts / counts.sum(), int(row.label)))
    ones = sum(s[2] for s in samples)
    if not 0 < ones < len(samples):
        return Model(None, ones / len(samples) if samples else 0.0)
    return Model(train(samples), ones / len(samples))


def _score(column: int, model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordLogits(model.logits) if model.logits is not None else None
        for batch in batches:
            found = []
            for text in batch.column(column):
                words = (text.as_py() or "").lower().split()
                if known is None or not words:
                    found.append(model.share)
                    continue
                total, n = np.array([known[w] for w in words]).sum(axis=0)
                again = repeats(words) * REPEAT_WEIGHT
                mean = (total + again * known.difference[REPEATED]) / (n + again)
                found.append(float(1 / (1 + np.exp(-mean))))
            yield common.with_arrays(batch, {
                "score": pa.array(found, pa.float64()),
                "predicted": pa.array([int(s >= CUT) for s in found], pa.int32())})
    return score


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``."""
    common.arrow_rows(docs.sparkSession)
    schema = common.with_fields(docs.schema, T.StructField("score", T.DoubleType()),
                                T.StructField("predicted", T.IntegerType()))
    return docs.mapInArrow(_score(docs.columns.index(text), model), schema)


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    common.arrow_rows(spark)
    found = scored(docs, fit(docs, common.table(spark, sf_dir, "labels")))
    return found.select("doc_id", (common.fold(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")
