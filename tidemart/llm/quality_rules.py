"""Quality rules: plain text rules, then a hashed n-gram likelihood ratio of trusted and raw text.

Units are runs of letters and digits or runs of other visible characters; unigrams and bigrams of
units are hashed to ``buckets``, whose number follows the distinct n-grams of the corpus: about
``PER_BUCKET`` share one at every size, so the threshold keeps its meaning. Over all documents, one multinomial counts the raw corpus and one the
trusted documents. A document's score is the mean log ratio of its n-grams,
``log((target + prior) / (expected + prior))`` with ``expected`` the raw share times the target total:
the prior shrinks rarely seen buckets to 0. A fixed threshold decides for every document.

Built from DataFrame functions only. Null, empty or blank texts have no words and fail the base rules.
Without trusted documents every score is null and only the base rules decide. Repeated rows and
further columns pass through; a null id is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common
from tidemart.operators.joins import planned_bytes
from tidemart.session import stored

SYMBOL = "[#*$%&|<>]"
# A unit is `[\p{L}\p{N}_]+` or `[^\p{L}\p{N}_\s\p{Z}]+`. Runs of ASCII that no other letter or digit follows are
# taken first, and the negated class comes behind a look at the character: categories are slow to look up.
UNIT = r"\w++(?![\p{L}\p{N}])|(?!\s)(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]+)"
# Distinct n-grams that share a bucket, and their count's relative error.
PER_BUCKET = 37.5
COUNT_ERROR = 0.02
# Up to so many buckets (128 MB) the ratios are one array in the plan. Beyond that they are a table to join, and each
# n-gram of each text is shuffled.
MOST_LISTED = 1 << 24
# Buckets of which one task lists the ratios.
PIECE = 1 << 14
# Planned input of one task that counts buckets.
TASK_BYTES = 256 << 20
PRIOR = 5.0
THRESHOLD = -0.5
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    The repeated windows of a text are found by sorting the hashes of its own windows, only where some hash
    repeats. Equal hashes are compared as text, and where two windows clash, the windows are sorted as text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(common.SPACES)) != "")
    rows = docs.withColumns({"_w": F.array_remove(F.split(whole, common.SPACE_RUN), ""), "_l": lines})

    def windows(made: Callable[..., Column]) -> Column:
        return F.when(F.size("_w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_w") - 3),
            lambda i: made(F.col("_w")[i], F.col("_w")[i + 1], F.col("_w")[i + 2], i)))

    rows = rows.withColumn("_g", windows(lambda a, b, c, i: F.xxhash64(a, b, c)))
    hashed = F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("k"), i.alias("i"))))
    rows = rows.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), hashed))

    def same(j: Column) -> Column:
        return F.col("_s")[j]["k"] == F.col("_s")[j - 1]["k"]

    def differ(j: Column) -> Column:
        i, other = F.col("_s")[j]["i"], F.col("_s")[j - 1]["i"]
        return (F.col("_w")[i] != F.col("_w")[other]) | (F.col("_w")[i + 1] != F.col("_w")[other + 1]) | (
            F.col("_w")[i + 2] != F.col("_w")[other + 2])

    clash = F.exists(F.sequence(F.lit(1), F.size("_s") - 1), lambda j: F.when(same(j), differ(j)).otherwise(False))
    texts = F.sort_array(windows(lambda a, b, c, i: F.struct(F.concat_ws(" ", a, b, c).alias("k"), i.alias("i"))))
    # Only equal hashes of different windows need the windows themselves.
    rows = rows.withColumn("_x", F.when(F.col("_s").isNotNull() & clash, texts))

    def covered(column: str) -> Column:
        """Words in windows whose key in the sorted ``column`` stands beside an equal one."""
        key = F.col(column)
        last = F.size(column) - 1
        twice = F.filter(column, lambda s, j: F.when(j > 0, s["k"] == key[j - 1]["k"]).otherwise(False)
                         | F.when(j < last, s["k"] == key[j + 1]["k"]).otherwise(False))
        return F.size(F.array_distinct(F.flatten(F.transform(
            twice, lambda s: F.sequence(s["i"], s["i"] + 2)))))

    rows = common.computed(rows, {
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOL)).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.when(F.col("_s").isNull(), F.lit(0)).when(
            F.col("_x").isNull(), covered("_s")).otherwise(covered("_x")).cast("long")})
    return rows.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    ).drop("_w", "_l", "_g", "_s", "_x")


def bucket_of(buckets: int) -> Callable[..., Column]:
    """The bucket of an n-gram from its units."""
    return lambda *units: F.pmod(F.xxhash64(*units), F.lit(buckets)).cast("int")


def _with_units(docs: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("_u", F.regexp_extract_all(whole, F.lit(UNIT), F.lit(0)))


def _grams(docs: DataFrame, text: str, name: str, hashed: Callable[..., Column]) -> DataFrame:
    """A row with the hash ``name`` for each unigram and bigram; other columns of ``docs`` stay.

    Units are unnested with the unit before them, so the hashes are computed in compiled code.
    """
    kept = [c for c in docs.columns if c != text]
    before = F.concat(F.array(F.lit(None).cast("string")), F.col("_u"))
    pairs = _with_units(docs, text).where(F.size("_u") > 0).select(
        *kept, F.inline(F.arrays_zip(F.slice(before, F.lit(1), F.size("_u")).alias("_p"), F.col("_u"))))
    two = F.when(F.col("_p").isNotNull(), hashed(F.col("_p"), F.col("_u")))
    each = pairs.select(*kept, F.explode(F.array(hashed(F.col("_u")), two)).alias(name))
    return each.where(F.col(name).isNotNull())


def bucket_number(docs: DataFrame, text: str = "text") -> int:
    """How many buckets give ``PER_BUCKET`` distinct n-grams each."""
    grams = _grams(docs.select(text), text, "h", F.xxhash64)
    count = grams.agg(F.approx_count_distinct("h", COUNT_ERROR)).first()[0]
    return max(1, round(count / PER_BUCKET))


def in_large_tasks(docs: DataFrame) -> DataFrame:
    """``docs`` in fewer partitions: as many as there are cores, or more of ``TASK_BYTES`` planned each.

    A task sends on each bucket it meets once. Many small tasks all meet most buckets, whose number grows with the
    input, so what they send would grow with its square.
    """
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-planned_bytes(docs) // TASK_BYTES))
    return docs.coalesce(min(tasks, (1 << 31) - 1))


def bucket_counts(docs: DataFrame, trusted: Column, text: str, buckets: int) -> DataFrame:
    """(bucket, raw, target): counts over all documents, and over those where ``trusted`` holds."""
    flagged = docs.select(F.col(text), trusted.cast("int").alias("_t"))
    return _grams(flagged, text, "bucket", bucket_of(buckets)).groupBy("bucket").agg(
        F.count("*").alias("raw"), F.sum("_t").alias("target"))


def weights(counts: DataFrame, buckets: int, prior: float = PRIOR) -> DataFrame:
    """One row with an array of ``buckets`` log ratios, null if there is no trusted text.

    The ratios are listed in pieces, so that the task that puts them together holds no more than the array.
    """
    spark = counts.sparkSession
    counts = stored(counts, "buckets")
    raws, targets = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not targets:
        return spark.range(1).select(F.lit(None).cast("array<double>").alias("ratio"))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(
        counts, "bucket", "left").na.fill(0, ["raw", "target"])
    ratio = F.log((F.col("target") + prior) / (F.col("raw") / F.lit(raws) * F.lit(targets) + prior))
    pieces = every.select("bucket", ratio.alias("ratio")).groupBy(F.floor(F.col("bucket") / PIECE).alias("piece")).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "ratio")))["ratio"].alias("ratios"))
    listed = pieces.agg(F.sort_array(F.collect_list(F.struct("piece", "ratios"))).alias("p"))
    return listed.select(F.flatten("p.ratios").alias("ratio"))


def score(docs: DataFrame, ratio: Column, text: str, buckets: int) -> DataFrame:
    """``docs`` with ``score``: the mean log ratio of the n-grams; null without n-grams or ratios.

    The ratios are read in one place only: the optimizer then puts them there instead of their column,
    which would otherwise be copied into every row.
    """
    def bucket(*units: Column) -> Column:
        # As ``bucket_of``, but for the cast: any whole number can be an index.
        return F.pmod(F.xxhash64(*units), F.lit(buckets))

    units = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(UNIT), F.lit(0))
    both = F.concat(
        F.transform("_u", lambda u: bucket(u)),
        F.transform(F.slice("_u", 2, F.size("_u")), lambda u, i: bucket(F.col("_u")[i], u)))
    rows = common.computed(docs.withColumn("_u", units), {"_n": both}).withColumn("_r", ratio)
    total = F.aggregate("_n", F.lit(0.0), lambda acc, n: acc + F.col("_r")[n])
    kept = [c for c in docs.columns if c != "score"]
    return rows.select(*kept, F.when(F.size("_n") > 0, total / F.size("_n")).alias("score"))


def joined_score(docs: DataFrame, counts: DataFrame, text: str, buckets: int, prior: float = PRIOR) -> DataFrame:
    """As ``score``, with the ratios joined by bucket; each text's buckets are counted before."""
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "scored")
    counts = stored(counts, "buckets")
    sums = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets")).where("targets > 0")
    ratios = counts.join(F.broadcast(sums)).select("bucket", F.log(
        (F.col("target") + prior) / (F.col("raw") / F.col("raws") * F.col("targets") + prior)).alias("ratio"))
    each = _grams(rows.select("_row", text), text, "bucket", bucket_of(buckets))
    scores = each.groupBy("_row", "bucket").agg(F.count("*").alias("n")).join(ratios, "bucket").groupBy("_row").agg(
        (F.sum(F.col("n") * F.col("ratio")) / F.sum("n")).alias("score"))
    return rows.drop("score").join(scores, "_row", "left").drop("_row")


def quality_rules(docs: DataFrame, trusted: DataFrame, text: str = "text",
                  buckets: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the base counts, ``score`` and ``kept``; ``trusted`` has the ids of target texts.

    Without ``buckets``, their number follows the distinct n-grams.
    """
    buckets = buckets or bucket_number(docs, text)
    ids = common.broadcast_if_small(
        trusted.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct())
    joined = in_large_tasks(docs.select("doc_id", text)).join(ids, F.col("doc_id") == F.col("_id"), "left")
    counts = bucket_counts(joined, F.col("_id").isNotNull(), text, buckets)
    based = base_counts(docs, text)
    rows = (score(based, weights(counts, buckets).scalar(), text, buckets) if buckets <= MOST_LISTED
            else joined_score(based, counts, text, buckets))
    fine = F.coalesce(F.col("score") >= threshold, F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & fine)


def trusted_documents(labels: DataFrame) -> DataFrame:
    """Ids labelled as good text, without the held-out third."""
    return labels.where((F.col("quality") == 1) & (common.fold(F.col("doc_id")) != 1)).select("doc_id")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels")
    return quality_rules(docs, trusted_documents(labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score")
