"""Personal data: fixed patterns, and contexts learned from what they find.

Base spans are e-mail addresses, IP addresses, card and phone numbers. They seed a bootstrap: a base span,
or else a token with a digit or an at sign, is an instance; the two words before it are its pattern. There
every word with a digit or an at sign counts as ``#``, and the start of a text as a word. A pattern's
confidence is the sum of its instances' confidences over all its occurrences in the corpus, followed by
whatever token; an instance's confidence is 1 for seeds, else the noisy-or of its accepted patterns. After
``ROUNDS`` rounds, instances behind patterns of at least ``LEAST_CONFIDENCE`` with
``LEAST_SUPPORT`` different trusted instances are spans of kind ``context``.

DataFrame functions only. Java's possessive loops make the patterns linear and free of recursion; they
match what the plain ones match, because no loop may give back a character that the rest needs. Offsets
are sums of the lengths between and within matches (code points, ends exclusive).

A null text counts as empty and has no spans. Every row is returned; rows of one id are told apart. Texts and
words of any length are kept whole; tokens of fewer than ``LEAST_TOKEN`` characters are no instances. Columns besides
id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.llm import common
from tidemart.session import stored

KINDS = ("email", "ip", "card", "phone", "context")
# \G lets a match begin right behind the one before, inside a run that the look-behind would skip.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "context": r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+",
}
# The last two words of a text that ends where a match begins, and what stands before the match in its own word.
LAST_WORDS = r"(?<!\S)(?:\S++\s++){0,2}\S*+\z"
ROUNDS = 3
LEAST_SUPPORT = 3
LEAST_TOKEN = 4
LEAST_CONFIDENCE = 0.8
BITS = 1 << 22
SHARES = (1024, 128, 16)


def _found(text: str, kind: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(PATTERNS[kind]), F.lit(0))


def _placed(text: str, kind: str, values: str) -> Column:
    """Structs (kind, i, gap, len, value, left) of the matches in order; gap is the length before one."""
    zipped = F.arrays_zip(
        F.col(values).alias("value"), F.split(F.col(text), PATTERNS[kind], -1).alias("gap"))

    def left(z: Column, i: Column) -> Column:
        # From the fourth match before this one on, so that words which are matches themselves count too.
        before = F.flatten(F.transform(F.slice(zipped, F.greatest(i - 3, F.lit(1)), F.least(i, F.lit(4))),
                                       lambda m: F.array(m["gap"], m["value"])))
        return F.lower(F.regexp_extract(F.concat(F.array_join(before, ""), z["gap"]), LAST_WORDS, 0))

    return F.when(F.size(values) > 0, F.transform(
        F.filter(zipped, lambda z: z["value"].isNotNull()),
        lambda z, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(z["gap"]).alias("gap"),
            F.length(z["value"]).alias("len"), z["value"].alias("value"), left(z, i).alias("left"))))


def matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, doc_id, found): all pattern matches of each row, valid or not."""
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.withColumns({"_d": F.col("_t").rlike("[0-9]"), "_a": F.contains("_t", F.lit("@"))})
    gate = {"email": F.col("_a"), "ip": F.col("_d"), "card": F.col("_d"),
            "phone": F.col("_d") & F.contains("_t", F.lit("+")), "context": F.col("_d") | F.col("_a")}
    rows = rows.withColumns({f"_{k}": F.when(gate[k], _found("_t", k)) for k in KINDS})
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,value:string,left:string>>")
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.concat(*[F.coalesce(_placed("_t", k, f"_{k}"), none) for k in KINDS]).alias("found"))


def _luhn(digits: str) -> Column:
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when(
        i % 2 == 1, F.substring(F.col(digits), n - i + 1, F.lit(1)).cast("int")).otherwise(
        2 * F.substring(F.col(digits), n - i + 1, F.lit(1)).cast("int")
        - F.when(F.substring(F.col(digits), n - i + 1, F.lit(1)) > "4", 9).otherwise(0)))
    return F.when(n.between(16, 19), total % 10 == 0).otherwise(False)


def spans(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, left) of valid base matches and of all tokens of kind ``context``."""
    each = found.select("row", F.inline("found"))
    before = W.partitionBy("row", "kind").orderBy("i")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before)).select(
        "row", "kind", (F.col("end") - F.col("len")).cast("int").alias("start"),
        F.col("end").cast("int").alias("end"), "value", "left")
    placed = placed.withColumn("_n", F.regexp_replace("value", "[^0-9]", ""))
    parts = F.split("value", r"\.")
    # As text without leading zeros: at most 255 means three digits up to "255", or fewer digits.
    small = F.forall(F.transform(parts, lambda p: F.ltrim(p, F.lit("0"))), lambda p: F.length(p) <= F.when(
        p > "255", 2).otherwise(3))
    fine = (F.when(F.col("kind") == 1, small).when(F.col("kind") == 2, _luhn("_n"))
            .when(F.col("kind") == 3, F.length("_n").between(8, 15)).otherwise(F.lit(True)))
    return placed.where(fine).drop("_n")


def _marked(word: Column) -> Column:
    return F.when(word.rlike("[0-9@]"), F.lit("#")).otherwise(word)


def instances(placed: DataFrame) -> DataFrame:
    """(row, start, end, token, pattern, seed): base spans, and tokens beside them, with their two words before."""
    context = KINDS.index("context")
    # A span may begin within a word; its pattern are the words before that word, which counts once.
    inner = F.length(F.regexp_extract("left", r"(\S*)\z", 1))
    seeds = placed.where(F.col("kind") < context).withColumn("at", F.col("start") - inner)
    seeds = seeds.groupBy("row", "at").agg(F.min(F.struct(
        "start", (-F.col("end")).alias("back"), "value", "left")).alias("s")).select(
        "row", "s.start", (-F.col("s.back")).alias("end"), F.col("s.value").alias("token"), "s.left",
        F.lit(True).alias("seed"))
    tokens = placed.where(F.col("kind") == context)
    base = placed.where(F.col("kind") < context).groupBy("row").agg(
        F.collect_list(F.struct("start", "end")).alias("base"))
    tokens = tokens.join(base, "row", "left")
    # Punctuation at the ends of a token is no part of it.
    bare = F.regexp_extract("value", r"""^["('\[{<]*(.*?)[)"'\]}>.,;:!?]*$""", 1)
    lead = F.length(F.regexp_extract("value", r"""^([("'\[{<]*)""", 1))
    tokens = tokens.withColumns({"token": bare, "start": F.col("start") + lead})
    tokens = tokens.withColumn("end", F.col("start") + F.length("token")).where(~F.coalesce(F.exists(
        "base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"])), F.lit(False)))
    every = seeds.unionByName(tokens.select("row", "start", "end", "token", "left", F.lit(False).alias("seed")))
    words = F.filter(F.split(F.regexp_replace("left", r"\S+\z", ""), r"\s+"), lambda w: w != "")
    every = every.withColumn("_w", F.transform(F.concat(F.array(F.lit("^")), words), _marked))
    return every.where(F.length("token") >= LEAST_TOKEN).select(
        "row", "start", "end", "token",
        F.when(F.size("_w") >= 2, F.concat_ws(" ", F.slice("_w", -2, 2))).alias("pattern"), "seed")


def _bits(patterns: DataFrame) -> DataFrame:
    """One row: an array of ``BITS`` bits in longs, set at the hashes of the patterns."""
    at = F.pmod(F.col("h"), F.lit(BITS))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    words = patterns.groupBy(F.floor(at / 64).alias("id")).agg(F.bit_or(mask).alias("bits"))
    every = patterns.sparkSession.range(BITS // 64).join(words, "id", "left").na.fill(0, ["bits"])
    return every.agg(F.sort_array(F.collect_list(F.struct("id", "bits"))).alias("b")).select(
        F.transform("b", lambda x: x["bits"]).alias("bits"))


def occurrences(docs: DataFrame, patterns: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, total): how often the two words stand before any token, over all documents.

    A bit array of fixed size lets only hashes of patterns through, and a few others; these are counted,
    and the counts, not the occurrences, are joined with the patterns.
    """
    parts = F.split("pattern", " ")
    hashed = patterns.withColumn("h", F.xxhash64(parts[0], parts[1]))
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")
    words = F.transform(F.concat(F.array(F.lit("^")), words), _marked)
    rows = docs.select(words.alias("_w")).where("size(_w) > 2").withColumn("_b", _bits(hashed).scalar())
    pairs = F.transform(F.sequence(F.lit(0), F.size("_w") - 3),
                        lambda i: F.xxhash64(F.col("_w")[i], F.col("_w")[i + 1]))

    def known(h: Column) -> Column:
        at = F.pmod(h, F.lit(BITS))
        return F.getbit(F.col("_b")[F.floor(at / 64).cast("int")], (at % 64).cast("int")) == 1

    each = rows.select(F.explode(F.filter(pairs, known)).alias("h"))
    counts = each.groupBy("h").agg(F.count("*").alias("total"))
    return hashed.join(counts, "h").select("pattern", "total")


def refuted(docs: DataFrame, patterns: DataFrame, text: str, least: float) -> DataFrame:
    """Those of ``patterns`` (pattern, instances) that occur too often for any trust in their instances.

    Occurrences in a part of the documents are at most those in all of them, so a part can refute a pattern but never
    accept one. Frequent patterns fall to small parts; each part counts only what the smaller ones left over, so few
    occurrences are counted one by one. What is left is counted over all documents.
    """
    out = patterns.select("pattern").where("false")
    for share in SHARES:
        left = patterns.join(out, "pattern", "left_anti")
        part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
        often = occurrences(part, left, text).join(patterns, "pattern").where(
            F.col("total") * least > F.col("instances"))
        out = out.unionByName(stored(often.select("pattern"), "refuted"))
    return out


def trusted_patterns(docs: DataFrame, edges: DataFrame, text: str = "text", rounds: int = ROUNDS,
                     least: float = LEAST_CONFIDENCE, support: int = LEAST_SUPPORT) -> DataFrame:
    """(pattern, confidence) after ``rounds`` rounds over edges (pattern, token, n, seed).

    A round counts in the corpus only the patterns that it could accept and no round before has counted: those
    with enough trusted instances and, as a pattern has at least as many occurrences as instances, with
    enough trust among its instances alone. Of these, ``refuted`` names those that no round can accept.
    """
    sure = edges.where("seed").select("token", F.lit(1.0).alias("trust")).distinct()
    trust, accepted = sure, None
    totals = edges.sparkSession.createDataFrame([], "pattern string, total bigint")
    hopeless = edges.sparkSession.createDataFrame([], "pattern string")
    instances_of = stored(edges.groupBy("pattern").agg(F.sum("n").alias("instances")), "instances-of")
    for _ in range(rounds):
        sums = edges.join(trust, "token").groupBy("pattern").agg(
            F.sum(F.col("n") * F.col("trust")).alias("mass"),
            F.sum((F.col("trust") >= 0.5).cast("int")).alias("trusted"))
        likely = stored(sums.where(F.col("trusted") >= support).join(instances_of, "pattern").where(
            F.col("mass") >= least * F.col("instances")).select("pattern", "mass"), "likely")
        new = likely.join(totals, "pattern", "left_anti").join(hopeless, "pattern", "left_anti").join(
            instances_of, "pattern").select("pattern", "instances")
        out = refuted(docs, new, text, least)
        new, hopeless = new.join(out, "pattern", "left_anti"), hopeless.unionByName(out)
        if not new.isEmpty():
            totals = totals.unionByName(stored(occurrences(docs, new, text), "totals"))
        accepted = stored(likely.join(totals, "pattern").select(
            "pattern", F.least(F.col("mass") / F.col("total"), F.lit(1.0)).alias("confidence")
        ).where(F.col("confidence") >= least), "patterns")
        reached = edges.join(accepted, "pattern").groupBy("token").agg(
            (1 - F.exp(F.sum(F.log(1.0001 - F.col("confidence"))))).alias("trust"))
        trust = stored(sure.unionByName(reached).groupBy("token").agg(F.max("trust").alias("trust")), "trust")
    return accepted


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, doc_id, found): sorted structs (kind, start, end, value) of each row, base and learned."""
    rows = stored(matches(docs, text), "matches")
    placed = stored(spans(rows.select("row", "found")), "spans")
    tokens = stored(instances(placed), "instances")
    edges = tokens.where("pattern IS NOT NULL").groupBy("pattern", "token").agg(
        F.count("*").alias("n"), F.max("seed").alias("seed"))
    several = edges.groupBy("pattern").agg(F.count("*").alias("k")).where(F.col("k") >= LEAST_SUPPORT)
    edges = stored(edges.join(several.select("pattern"), "pattern"), "edges")
    base = placed.where(F.col("kind") < KINDS.index("context")).select("row", "kind", "start", "end", "value")
    if not edges.where("seed").isEmpty():
        accepted = trusted_patterns(docs, edges, text)
        learned = tokens.where("NOT seed").join(accepted, "pattern").select(
            "row", F.lit(KINDS.index("context")).alias("kind"), "start", "end", F.col("token").alias("value"))
        base = base.unionByName(learned)
    per_row = base.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", "end", "value"))).alias("found"))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    return rows.select("row", "doc_id").join(per_row, "row", "left").withColumn(
        "found", F.coalesce("found", none))


def _text(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


def op10_pii(spark, sf_dir: str) -> DataFrame:
    rows = personal_data(common.table(spark, sf_dir, "documents"))
    counts = [_count(k).alias(f"n_{KINDS[k]}") for k in range(4)]
    base = F.filter("found", lambda s: s["kind"] < 4)
    return rows.select("doc_id", *counts, F.sha2(_text(base), 256).alias("base_sha256"),
                       _text(F.col("found")).alias("spans"))
