"""MinHash near-duplicates: universal hash minima, banding, verification, connected components.

1. A text becomes its set of 5-word shingles (64-bit hashes). Equal sets are one class.
2. ``BANDS * ROWS`` minima of universal hashes (multiply, add, take high bits) sign one text per class;
   a pair at the threshold 0.75 shares one of 40 bands of 4 with probability 1 - 2.6e-7.
3. Each bucket pairs its texts with two leaders (its least id and its least hash of an id), so a bucket of n
   texts makes at most 2n pairs. Signatures that agree in less than ``LEAST_AGREEMENT`` drop a pair (a
   pair at the threshold falls below with probability 4e-6); the rest is confirmed on the full sets.
4. Components are built. Buckets whose texts then lie in several components have pairs left. Those of at
   most ``SMALL_BUCKET`` texts are paired across components; the texts of larger ones are paired by their
   rarest shingles, which loses no link (``prefix_pairs``). These pairs are checked in the same way.

Null, empty and blank texts have no shingles and are linked with nothing. Rows with the same id are one
document; each row is returned. A row without id is kept and linked with nothing. Further columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm import common, shingles
from tidemart.llm.components import connected
from tidemart.session import stored

BANDS, ROWS = 40, 4
THRESHOLD_PERCENT = 75
LEAST_AGREEMENT = 0.6
SMALL_BUCKET = 16
_CHUNK = 512
_HIGH = np.uint64(32)


def hash_family(n: int = BANDS * ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and addends of ``n`` multiply-add hashes, the same in every task."""
    draw = np.random.default_rng(20240301)
    return (draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1),
            draw.integers(0, 1 << 63, n, np.uint64))


def minima(values: np.ndarray, factors: np.ndarray, addends: np.ndarray) -> np.ndarray:
    """The least high half of each hash over a set, in blocks that stay in the cache."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), _CHUNK):
        block = values[None, at:at + _CHUNK] * factors[:, None]
        block += addends[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return (least >> _HIGH).astype(np.uint32)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of the key."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        keys = shingles.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return keys.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, (factors, addends) = shingles.WordHashes(), hash_family()
    for batch in batches:
        sets = [shingles.shingle_set(x.as_py(), known) for x in batch.column(1)]
        signed = np.array([minima(s, factors, addends) for s in sets], np.uint32).reshape(-1, BANDS * ROWS)
        keys = band_keys(signed)
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([int(s.sum().view(np.int64)) for s in sets], pa.int64()),
            pa.array([int(np.bitwise_xor.reduce(shingles.mixed(s)).view(np.int64)) for s in sets], pa.int64()),
            pa.array([x.tobytes() for x in signed], pa.binary()),
            pa.array(list(keys), pa.list_(pa.int64())),
        ], ["doc_id", "n_shingles", "f1", "f2", "sig", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = shingles.WordHashes()
    for batch in batches:
        sets = [shingles.shingle_set(x.as_py(), known).tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = shingles.WordHashes()
    for batch in batches:
        for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = shingles.shingle_set(raw.as_py(), known).view(np.int64)
            for at in range(0, len(found), 1 << 16):
                part = found[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(part), doc_id)), pa.array(np.full(len(part), len(found), np.int32)),
                    pa.array(part)], ["doc_id", "n", "h"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.array([np.frombuffer(x.as_py(), np.uint32) for x in batch.column(k)], np.uint32)
                .reshape(-1, BANDS * ROWS) for k in (2, 3))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(
            pa.array((a == b).mean(axis=1) >= LEAST_AGREEMENT))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            common_n = len(np.intersect1d(a, b, assume_unique=True))
            held.append(100 * common_n >= THRESHOLD_PERCENT * (len(a) + len(b) - common_n))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(
            pa.array(held, pa.bool_()))


def signed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sig, bands); f1 and f2 are a 128-bit print of the set."""
    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("binary").alias("raw")).mapInArrow(
        _sign, "doc_id long, n_shingles long, f1 long, f2 long, sig binary, bands array<long>")


def _beside(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """(u, v, a, b): pairs with the column of both ends."""
    left = values.select(F.col("doc_id").alias("u"), F.col(column).alias("a"))
    right = values.select(F.col("doc_id").alias("v"), F.col(column).alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")


def _of(docs: DataFrame, ids: DataFrame, text: str) -> DataFrame:
    """(doc_id, raw) of the documents named in ``ids``."""
    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("binary").alias("raw")).join(
        common.broadcast_if_small(ids.distinct()), "doc_id", "left_semi")


def confirmed(pairs: DataFrame, base: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The pairs whose signatures agree well enough and whose full sets reach the threshold."""
    likely = stored(_beside(pairs, base, "sig").mapInArrow(_agreeing, "u long, v long"), "likely")
    ends = likely.select(F.explode(F.array("u", "v")).alias("doc_id"))
    sets = _of(docs, ends, text).mapInArrow(_sets, "doc_id long, shingles binary")
    return _beside(likely, sets, "shingles").mapInArrow(_linked, "u long, v long")


def _set_rows(docs: DataFrame, ids: DataFrame, text: str) -> DataFrame:
    """(doc_id, n, h): one row per shingle of the named documents, n of them each."""
    return _of(docs, ids, text).mapInArrow(_exploded, "doc_id long, n int, h long")


def _ordered(u: str, v: str) -> list:
    return [F.least(u, v).alias("u"), F.greatest(u, v).alias("v")]


def met_leaders(bands: DataFrame) -> DataFrame:
    """(key, doc_id, n, first, picked) of buckets of two or more: their size and their leaders.

    Both leaders are least in an order of all texts, so the buckets of one group mostly have the same two.
    """
    leaders = bands.groupBy("key").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"),
        F.min_by("doc_id", F.xxhash64("doc_id")).alias("picked")).where("n > 1")
    return bands.join(leaders, "key")


def leader_pairs(met: DataFrame) -> DataFrame:
    """Each text of a bucket with the bucket's least id and with its least hash of an id."""
    return met.select(F.explode(F.array(
        F.struct(*_ordered("doc_id", "first")), F.struct(*_ordered("doc_id", "picked")))).alias("p")
    ).select("p.u", "p.v").where("u < v").distinct()


def open_rows(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, doc_id, n, component) of buckets of three or more whose texts lie in several components."""
    placed = met.where("n > 2").select("key", "doc_id", "n").join(
        nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    several = placed.groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("key")
    return placed.join(several, "key", "left_semi")


def _pairs_by(rows: DataFrame, key: str, *more: str) -> DataFrame:
    other = rows.select(key, F.col("doc_id").alias("v"), F.col("component").alias("other"),
                        *[F.col(m).alias(f"{m}_v") for m in more])
    return rows.withColumnRenamed("doc_id", "u").join(other, key).where("u < v AND component <> other")


def prefix_pairs(placed: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """Every pair across components of (doc_id, component) that can reach the threshold.

    Two sets of at least 75 % overlap share one of the n - ceil(0.75 n) + 1 rarest shingles of either,
    rarity counted over the given texts and ties broken by the hash. Copies that differ too much have
    rare shingles of their own there and meet nobody, so a group of them makes no square of pairs.
    """
    ids = placed.select("doc_id", "component").distinct()
    sets = _set_rows(docs, ids.select("doc_id"), text).dropDuplicates(["doc_id", "h"])
    rarity = sets.groupBy("h").agg(F.count("*").alias("df"))
    order = W.partitionBy("doc_id").orderBy("df", "h")
    ranked = sets.join(rarity, "h").withColumn("k", F.row_number().over(order))
    least = F.col("n") - F.ceil(F.col("n") * THRESHOLD_PERCENT / 100) + 1
    # A shingle of one text only fills a place of the prefix but can meet nobody.
    prefix = ranked.where((F.col("k") <= least) & (F.col("df") > 1)).join(ids, "doc_id").select(
        "doc_id", "h", "n", "k", "component")
    # Of the first shingle that two texts share, at most the rest of either is shared too.
    shared = 1 + F.least(F.col("n") - F.col("k"), F.col("n_v") - F.col("k_v"))
    return _pairs_by(prefix, "h", "n", "k").where(
        (100 + THRESHOLD_PERCENT) * shared >= THRESHOLD_PERCENT * (F.col("n") + F.col("n_v"))
    ).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    common.arrow_rows(docs.sparkSession)
    base = stored(signed(docs, text), "signed")
    known = base.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    equal = known.select("doc_id", "f1", "f2", "n_shingles").join(
        classes, ["f1", "f2", "n_shingles"]).select(*_ordered("doc_id", "rep")).where("u < v")
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    texts = known.join(common.broadcast_if_small(reps), "doc_id", "left_semi")
    met = stored(met_leaders(texts.select("doc_id", F.explode("bands").alias("key")).distinct()), "met")
    checked = stored(leader_pairs(met), "pairs")
    links = stored(equal.unionByName(confirmed(checked, texts, docs, text)), "links")
    nodes = connected(links)
    left = stored(open_rows(met, nodes), "open")
    if not left.isEmpty():
        few = _pairs_by(left.where(F.col("n") <= SMALL_BUCKET), "key").select("u", "v").distinct()
        many = prefix_pairs(left.where(F.col("n") > SMALL_BUCKET), docs, text)
        more = few.unionByName(many).distinct().join(checked, ["u", "v"], "left_anti")
        links = links.unionByName(stored(confirmed(stored(more, "more"), texts, docs, text), "links"))
        nodes = connected(links)
    return base.select("doc_id", "n_shingles").join(
        nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op3_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))
