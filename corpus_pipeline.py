"""The corpus pipeline: each stage works on what the one before it has kept.

Rows with nulls pass every stage that has no reason to reject them: a null text has no words, so the
quality rules reject it; a null id is linked with nothing. Further columns stay, but for the last stage.
Where a further column bears the name of a stage's own result, the stage leaves it as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import byte_bpe, common, decontaminate, near_dedup, quality_rules, secrets
from tidemart.session import stored

_OWN = "_stage_"


def _hidden(docs: DataFrame) -> DataFrame:
    """Columns besides id and text under names that no operator uses."""
    return docs.select(*[F.col(c).alias(c if c in ("doc_id", "text") else _OWN + c) for c in docs.columns])


def _shown(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*[F.col(c if c in ("doc_id", "text") else _OWN + c).alias(c) for c in columns])


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go."""
    trusted = quality_rules.trusted_documents(common.table(spark, sf_dir, "labels"))
    return _shown(quality_rules.quality_rules(_hidden(docs), trusted).where("kept"), docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: the document with the least id of each group stays."""
    found = near_dedup.near_duplicates(docs.select("doc_id", "text"))
    gone = found.where("NOT kept").select("doc_id").distinct()
    return docs.join(common.broadcast_if_small(gone), "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a passage of the benchmark go."""
    found = decontaminate.benchmark_hits(_hidden(docs), common.table(spark, sf_dir, "benchmark"))
    return _shown(found.where(F.size("hits") == 0), docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: documents stay, secrets in them become a mark; n_chars follows the new text."""
    found = secrets.secret_scan(_hidden(docs), clean=True)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("spans") != "", F.length("text").cast(docs.schema["n_chars"].dataType))
        found = found.withColumn(_OWN + "n_chars", F.coalesce(changed, _OWN + "n_chars"))
    return _shown(found, docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: ids of each document, and whether they decode to its bytes."""
    coded = byte_bpe.encode_decode(docs.select("doc_id", "text"))
    return coded.select("doc_id", "n_tokens", "ids", (
        F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("quality rules", good_text),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE encoding and decoding", tokens),
]
# The first stage hashes n-grams as Spark does and the last merges bytes until a fixpoint; tests compare
# the pipeline with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
