"""Near-dedup, substring dedup, decontamination, WARC, the two classifiers and the pipeline."""

import random
import sys

import brute
import compare
import numpy as np
import pytest
from llm_rows import FEW, SMALL, odd_rows, prose

import corpus_pipeline
from tidemart.llm import (boosting, components, decontaminate, near_dedup, quality_classifier, quality_rules,
                          substring_dedup, tokenizer, toxicity, warc)
from tidemart.session import shared_dir


def changed(words: list[str], n: int, seed: int) -> str:
    words, draw = list(words), random.Random(seed)
    for k in draw.sample(range(len(words)), n):
        words[k] = f"new{draw.randint(0, 10**6)}"
    return " ".join(words)


def near_rows():
    """Copies at many distances of one text: their links are a chain of cases around the threshold."""
    text = prose(77, 200)
    rows = [(100 + k, changed(text, k % 12, k)) for k in range(60)]
    return rows + [(200, " ".join(text).upper()), (201, "one two"), (202, "ONE two"), (203, "one")]


def test_near_duplicates_as_brute_force(spark, none):
    rows = near_rows() + [r for r in odd_rows() if r[0] not in (1, 6)]
    named = [r for r in rows if r[0] is not None]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, FEW)).collect()
    want = brute.near_duplicates(named)
    assert {r.doc_id: tuple(r)[1:] for r in got if r.doc_id is not None} == want
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None) and len(got) == len(rows)
    assert near_dedup.near_duplicates(none).isEmpty()


def test_rarest_shingles_lose_no_pair(spark, monkeypatch):
    """With leaders that find almost nothing, the later steps alone must find every link."""
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 2)
    monkeypatch.setattr(near_dedup, "leader_pairs", lambda met: met.selectExpr("first AS u", "doc_id AS v").where(
        "v = 200 AND u < v").distinct())
    rows = near_rows()
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, FEW)).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: v[1] for d, v in brute.near_duplicates(rows).items()}


def test_components_of_a_long_path(spark):
    order = list(range(40))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[k], order[k + 1]) for k in range(39)] + [(100, 101)], "u long, v long")
    got = {r.node: r.component for r in components.connected(edges).collect()}
    assert got == {**dict.fromkeys(range(40), 0), 100: 100, 101: 100}


def test_repeated_passages(spark, odd, none):
    shared, draw = prose(5, 70), random.Random(3)
    fuzzy = list(shared)
    fuzzy[30:31] = ["other", "words"]
    rows = [(k, " ".join(prose(1000 + k, 80) + (shared if k % 2 else fuzzy) + prose(2000 + k, 60)))
            for k in range(6)]
    rows += [(50, " ".join(prose(50, 300))), (51, rows[0][1]), (52, " ".join(shared[:40])), (53, "De " * 90),
             (54, "x " + "De " * 80)]
    draw.shuffle(rows)
    got = substring_dedup.passages(spark.createDataFrame(rows, FEW)).collect()
    texts = dict(rows)
    found = {r.doc_id for r in got} | {r.other_id for r in got}
    assert found == {0, 1, 2, 3, 4, 5, 51, 53, 54}
    for r in got:
        a = texts[r.doc_id].lower().split()[r.start:r.end]
        b = texts[r.other_id].lower().split()[r.other_start:r.other_end]
        assert len(a) == r.n_words >= 50 and substring_dedup.edit_distance(a, b) <= r.distance
    assert substring_dedup.passages(odd).where("doc_id = other_id").isEmpty()
    assert substring_dedup.passages(none).isEmpty()


def test_chains_take_the_best_order():
    x, y = [0, 10, 20, 30, 12], [5, 15, 25, 35, 500]
    assert substring_dedup.chains(x, y)[0] == [0, 1, 2, 3]
    draw = random.Random(2)
    for _ in range(30):
        n = draw.randint(1, 9)
        x, y = [draw.randint(0, 20) for _ in range(n)], [draw.randint(0, 20) for _ in range(n)]

        def worth(chain, x=x, y=y):
            return 10 * len(chain) - 0.25 * sum(
                x[b] - x[a] + y[b] - y[a] for a, b in zip(chain, chain[1:]))

        rising = [[i for i in range(n) if m >> i & 1] for m in range(1, 1 << n)]
        rising = [sorted(c, key=lambda i: (x[i], y[i])) for c in rising]
        rising = [c for c in rising if all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:]))]
        assert abs(worth(substring_dedup.chains(x, y)[0]) - max(map(worth, rising))) < 1e-9


def test_benchmark_hits_as_brute_force(spark, odd, none):
    items = [(k, " ".join(prose(300 + k, 12 + 3 * k))) for k in range(8)] + [(8, None), (9, "too short"), (None, "x")]
    rows = []
    for k in range(40):
        words = items[k % 8][1].split()
        edits = (k // 8) % 6
        part = changed(words, edits, k).split()
        rows.append((k, " ".join(prose(k, 30) + part + prose(900 + k, 20)).replace(" ", ", ", 3).upper()))
    rows += [(90, items[3][1]), (91, " ".join(items[4][1].split()[2:])), (92, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, h.item_id): h.distance for r in decontaminate.benchmark_hits(
        spark.createDataFrame(rows, FEW), benchmark).collect() for h in r.hits}
    want = {}
    for doc_id, text in rows:
        words = decontaminate.WORD.findall((text or "").lower())
        for item_id, item in items[:8]:
            pattern = item.split()
            distance = brute.least_word_distance(pattern, words)
            if distance <= decontaminate.budget(len(pattern)):
                want[doc_id, item_id] = distance
    assert got == want
    assert decontaminate.benchmark_hits(odd, benchmark).count() == odd.count()
    assert decontaminate.benchmark_hits(none, benchmark).isEmpty()
    empty = decontaminate.benchmark_hits(odd, spark.createDataFrame([], "item_id long, text string"))
    assert empty.where("size(hits) > 0").isEmpty()


def test_benchmark_in_blocks(spark, monkeypatch):
    items = [(k, " ".join(prose(300 + k, 20))) for k in range(9)]
    docs = spark.createDataFrame([(k, t) for k, t in items] + [(50, " ".join(t for _, t in items))], FEW)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    rows = decontaminate.benchmark_hits(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: sorted(h.item_id for h in r.hits) for r in rows} == {
        **{k: [k] for k in range(9)}, 50: list(range(9))}


def test_warc_round_trip(spark, con):
    big = "é" * 40_000
    pages = [(k, f"http://a/{k}", html) for k, html in enumerate([
        None, "", "<p>x</p>", "<p>x</p>", big, big, "WARC/1.1\r\n\r\n" * 100, "y" * 999, "y" * 999, big, "z" * 1000,
        "z" * 1000])] + [(11, "http://a/11", "z" * 1000), (None, None, big)]
    folder = shared_dir(spark, "warc")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), folder)
    got = warc.read_archives(spark, folder)
    named = got.where("page_id IS NOT NULL")
    frame = spark.createDataFrame([p for p in pages if p[0] is not None], "page_id long, url string, html string")
    con.register("pages_here", frame.toPandas())
    sql = warc.SQL.replace("FROM pages)", "FROM pages_here)")
    assert compare.differences(named, con, sql) == ""
    assert [r.record_type for r in got.where("page_id IS NULL").collect()] == ["response"]
    empty = shared_dir(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), empty)
    assert warc.read_archives(spark, empty).isEmpty()


def test_warc_faults_are_errors():
    payload = bytes(range(256)) * 300
    assert warc.unchunked(warc.chunked(payload)) == payload
    parts = [{"number": 1, "total": None, "block": b"ab"}, {"number": 2, "total": 4, "block": b"cd"}]
    assert warc.joined(parts[::-1]) == b"abcd"
    for bad in (parts[1:], [parts[0]], [parts[0], {**parts[1], "total": 5}]):
        with pytest.raises(ValueError):
            warc.joined(bad)
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_isotonic_rises_and_trees_learn():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.fit(x[:1500], y[:1500])
    assert ((trees.raw(x[1500:]) > 0) == y[1500:]).mean() > 0.95
    knots, rates = boosting.isotonic(trees.raw(x), y)
    assert (np.diff(rates) >= 0).all() and (np.diff(knots) > 0).all() and 0 <= rates.min() <= rates.max() <= 1


@pytest.mark.parametrize("operator", [toxicity, quality_classifier])
def test_classifiers_on_odd_and_empty_tables(spark, odd, none, operator):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = operator.fit(odd, labels)
    rows = operator.scored(odd, model).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {0.0}
    assert operator.scored(none, model).isEmpty()


@pytest.mark.parametrize("name, column, least", [
    ("op1_toxicity", "toxic", 0.93), ("op6_quality_classifier", "quality", 0.95)])
def test_held_out_accuracy(spark, name, column, least):
    import __spark_entry__ as entry_points

    folder = "/root/testdata/sf0.01"
    rows = entry_points.queries()[name](spark, folder).collect()
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= least


def test_pipeline_as_brute_force(spark, tmp_path):
    docs = [(k, " ".join(prose(k, 90)), "en", "s", 1) for k in range(12)]
    docs += [(20, docs[3][1] + " end", "en", "s", 1), (21, docs[3][1], "en", "s", 1), (22, "short", "en", "s", 1)]
    docs += [(23, None, "en", "s", 1), (24, "x y z " * 60, None, None, None)]
    item = " ".join(prose(400, 30))
    docs += [(30, docs[5][1][::-1] + " " + item, "en", "s", 1),
             (31, " ".join(prose(31, 80)) + " password=abcdefgh12", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").limit(0).write.parquet(
        f"{tmp_path}/labels.parquet")
    kept = [(d, t) for d, t, *_ in docs if not brute.base_counts(t)[-1]]
    groups = brute.near_duplicates(kept)
    kept = [(d, t) for d, t in kept if groups[d][2] and item not in t]
    library = tokenizer.library(tokenizer.default_path())
    want = {d: library.encode_ordinary(t.replace("password=abcdefgh12", "[SECRET]")) for d, t in kept}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want and all(r.round_trip for r in got)
    assert 31 in want and 30 not in want and 20 not in want


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).withColumn("kept", quality_rules.F.lit("own"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name != "MinHash near-dedup":
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns and out.where("kept <> 'own'").isEmpty(), name


def test_nothing_else_imports_this_subpackage():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for path in (root / "tidemart").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text().split(), path
    assert "corpus_pipeline" in sys.modules
