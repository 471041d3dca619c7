"""The fast form of the unit pattern against the plain one, and what is not computed per unit any more."""

import random

from llm_rows import FEW

from tidemart.llm import quality_rules
from tidemart.llm.quality_rules import F

PLAIN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}]+"


def test_units_are_those_of_the_plain_pattern(spark):
    draw = random.Random(5)
    some = "aZ_09 \t\n\x0b\r\x1c\x85\xa0 　-.,#é€ß中٣①²́​😀𝒜\x00"
    rows = [(k, "".join(draw.choice(some) for _ in range(draw.randrange(40)))) for k in range(3000)]
    rows += [(-1, "a" * 20_000 + "é"), (-2, "-" * 20_000 + " x"), (-3, None), (-4, "")]
    texts = quality_rules._with_units(spark.createDataFrame(rows, FEW), "text")
    plain = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(PLAIN), F.lit(0))
    assert texts.where(~F.col("_u").eqNullSafe(plain)).isEmpty()
    assert quality_rules.UNIT != PLAIN


def test_no_lambda_per_word_and_no_cast_per_bucket(spark):
    docs = spark.createDataFrame([(1, " b  c ")], FEW)
    plan = quality_rules.base_counts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(split(coalesce(text" not in plan.replace("\\n", "").split("_w#")[0]
    assert [r.n_words for r in quality_rules.base_counts(docs).collect()] == [2]
    scored = quality_rules.score(docs, F.array(F.lit(0.5), F.lit(1.0)), "text", 2)
    assert "as int)" not in scored._jdf.queryExecution().optimizedPlan().toString()
    assert all(0.5 <= r.score <= 1.0 for r in scored.collect())
