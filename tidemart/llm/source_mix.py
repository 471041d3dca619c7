"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

The mix is ``share`` times all words. Each source asks for a part by its weight; one that would be repeated
more than ``epochs`` times is clamped there, and the words it leaves go to the open sources by weight, until
no further source is above its cap. The level of the water (words per weight) is all that passes from one
round to the next: a round is one aggregate over the table of sources, which gives the driver three numbers.

A source's target is a number of whole repetitions of each of its documents and a rest. The rest goes to the
documents that come first in a seeded order, up to one place where words reach it; the documents at that
place share what is left, as fractions. The place is found digit by digit (``DIGITS`` of ``BITS`` bits): words
are added up per source and digit value, so no task sorts or gathers a source, however large, and rows with
equal ids and texts, however many, are at one place and treated alike.

A null text has no words, and takes none; a null source is a source of its own, the last one; null and
repeated ids are documents like others. An empty table stays empty. Results replace columns of the same name;
further columns stay. Sources are numbered by a sort over ranges, not in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemart.llm import common
from tidemart.operators.joins import small_lookup
from tidemart.session import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 1
BITS = 12
DIGITS = 3
_ROW = 33  # low bits of monotonically_increasing_id that number the rows of one partition


def n_words(text: Column) -> Column:
    """Number of words: the parts between runs of white space, less the empty ones at both ends."""
    def blank(at: int) -> Column:
        return F.substring(text, at, 1).isin(*common.SPACES).cast("int")

    parts = F.size(F.split(text, common.SPACE_RUN))
    found = F.when(text == "", 0).otherwise(parts - blank(1) - blank(-1))
    return F.coalesce(found, F.lit(0)).cast("long")


def place(seed: int, doc_id: str, text: str) -> Column:
    """A document's place in the seeded order, of ``BITS * DIGITS`` bits."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(doc_id).cast("string"), F.col(text)).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS * DIGITS // 4), 16, 10).cast("long")


def numbered(sources: DataFrame, weights: Sequence[int], epochs: float) -> DataFrame:
    """Sources in code point order, null last, with their number, weight and cap."""
    ranked = sources.orderBy(F.col("_known").desc(), "_name").withColumn("_id", F.monotonically_increasing_id())
    ranked = stored(ranked, "mix-ranked")
    part = F.shiftright("_id", _ROW)
    # One row per range of the sort: as many as shuffle partitions.
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranked.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).select("_part", before.alias("_before"))
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW) - 1))
    table = F.array(*[F.lit(float(w)) for w in weights])
    return (ranked.join(F.broadcast(ranges), part == F.col("_part"))
            .withColumn("_sid", F.col("_before") + row)
            .withColumn("_weight", F.get(table, F.pmod("_sid", F.lit(len(weights))).cast("int")))
            .withColumn("_cap", F.lit(float(epochs)) * F.col("source_size"))
            .select("_known", "_name", "_sid", "source_size", "_weight", "_cap"))


def water_level(sources: DataFrame, share: float) -> float:
    """Words per weight at which the targets add up to the mix; a clamped source is full below it."""
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("_cap") <= F.col("_weight") * F.lit(level)
        clamped, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0))).first()
        if not open_weight:
            return level
        higher = (share * words - clamped) / open_weight
        if higher <= level:
            return level
        level = higher


def cut_places(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """Per source the place up to which documents are taken once more, and the share at that place.

    ``rows`` has (_sid, _place, size), ``needs`` has (_sid, _rest); sources without a word have no cut.
    """
    state = needs.select("_sid", "_rest", F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_done"))
    for digit in range(DIGITS):
        below = BITS * (DIGITS - 1 - digit)
        prefix = F.shiftright("_place", below + BITS) if digit else F.lit(0).cast("long")
        sums = (rows.withColumn("_prefix", prefix)
                .join(common.broadcast_if_small(state.select("_sid", "_prefix")), ["_sid", "_prefix"])
                .groupBy("_sid", F.shiftright("_place", below).alias("_next")).agg(F.sum("size").alias("_words")))
        # At most 2 ** BITS rows of a source in a window.
        so_far = F.sum("_words").over(Window.partitionBy("_sid").orderBy("_next"))
        reached = F.col("_done") + F.col("_so_far")
        state = (sums.withColumn("_so_far", so_far).join(state.select("_sid", "_rest", "_done"), "_sid")
                 .where((reached > F.col("_rest")) & (reached - F.col("_words") <= F.col("_rest")) & (F.col("_words") > 0))
                 .select("_sid", "_rest", F.col("_next").alias("_prefix"),
                         (reached - F.col("_words")).alias("_done"), "_words"))
        state = stored(state, f"mix-digit-{digit}")
    return state.select("_sid", F.col("_prefix").alias("_cut"),
                        ((F.col("_rest") - F.col("_done")) / F.col("_words")).alias("_part"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS,
        seed: int = SEED, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target (both of the source), whole (repetitions) and taken (words)."""
    own = ("size", "source_size", "target", "whole", "taken")
    kept = [c for c in docs.columns if c not in own]
    rows = docs.select(
        *kept, n_words(F.col(text)).alias("size"), place(seed, doc_id, text).alias("_place"),
        F.col(source).isNotNull().alias("_known"), F.coalesce(F.col(source), F.lit("")).alias("_name"))
    narrow = stored(rows.select("_known", "_name", "_place", "size"), "mix-rows")
    sizes = narrow.groupBy("_known", "_name").agg(F.sum("size").alias("source_size"))
    sources = stored(numbered(sizes, weights, epochs), "mix-sources")
    target = F.least("_cap", F.col("_weight") * F.lit(water_level(sources, share)))
    sources = (sources.withColumn("target", target)
               .withColumn("whole", F.coalesce(F.floor(F.try_divide("target", F.col("source_size").cast("double"))), F.lit(0)))
               .withColumn("_rest", F.col("target") - F.col("whole") * F.col("source_size")))
    sources = stored(sources, "mix-targets")
    on, spread = ["_known", "_name"], ["_place"]
    placed = small_lookup(narrow, sources.select(*on, "_sid"), on, spread).select("_sid", "_place", "size")
    cuts = cut_places(stored(placed, "mix-places"), sources.select("_sid", "_rest"))
    answers = sources.join(cuts, "_sid", "left").select(*on, "source_size", "target", "whole", "_cut", "_part")
    again = (F.when(F.col("_place") < F.col("_cut"), F.col("size"))
             .when(F.col("_place") == F.col("_cut"), F.floor(F.col("size") * F.col("_part"))).otherwise(0))
    return small_lookup(rows, stored(answers, "mix-answers"), on, spread).select(
        *kept, "size", "source_size", "target", "whole",
        (F.col("whole") * F.col("size") + again).cast(T.LongType()).alias("taken"))


def op13_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


# The same by one sort per source: words in the seeded order up to and at each place.
SQL = r"""
WITH rows_ AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        CAST('0x' || substr(md5(concat_ws(':', '1', CAST(doc_id AS VARCHAR), text)), 1, 9) AS BIGINT) AS place
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS DOUBLE) AS words, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid
    FROM rows_ GROUP BY source),
weighed AS (
    SELECT *, CASE sid % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2 ELSE 1 END AS weight, sum(words) OVER () * 1.5 AS mix
    FROM sources),
filled AS (
    SELECT *, coalesce(sum(2 * words) OVER before_, 0) AS full_words,
        sum(weight) OVER () - coalesce(sum(weight) OVER before_, 0) AS open_weight
    FROM weighed WINDOW before_ AS (ORDER BY 2 * words / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
    SELECT max((mix - full_words) / open_weight) AS level FROM filled),
targets AS (
    SELECT source, words, least(2 * words, weight * level) AS target,
        coalesce(floor(least(2 * words, weight * level) / nullif(words, 0)), 0) AS whole
    FROM weighed, level),
placed AS (
    SELECT r.*, t.words, target, whole, target - whole * words AS rest,
        sum(size) OVER (PARTITION BY r.source ORDER BY place RANGE UNBOUNDED PRECEDING) AS reached,
        sum(size) OVER (PARTITION BY r.source, place) AS here
    FROM rows_ r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(words AS BIGINT) AS source_size, target,
    CAST(whole * size + CASE WHEN reached <= rest THEN size WHEN reached - here <= rest AND here > 0
        THEN floor(size * ((rest - (reached - here)) / here)) ELSE 0 END AS BIGINT) AS taken
FROM placed"""
