"""Periodic runs, conversation repair and source mixing against plain versions, and on odd tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import pytest
from llm_rows import FEW, SMALL, odd_rows
from pyspark.sql import functions as F

from tidemart.llm import conversation_repair as repairs
from tidemart.llm import periodic_runs as runs
from tidemart.llm import source_mix as mixes


# ------------------------------------------------------------ periodic runs

def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            start = i - q
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - start >= max(6, 4 * q):
                found.setdefault((start, i - start), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def nested(draw, depth, letters):
    if depth == 0 or draw.random() < 0.3:
        return draw.choices(letters, k=draw.randint(1, 6))
    part = nested(draw, depth - 1, letters)
    if draw.random() < 0.4:
        part = part + nested(draw, depth - 1, letters)
    part = part * draw.randint(1, 7)
    return part[:draw.randint(max(1, len(part) - 5), len(part))]


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_nested_repetitions(seed):
    draw = random.Random(seed)
    for _ in range(60):
        letters = [b"a", b"b", b"c", b"d"][:draw.randint(1, 4)]
        words = sum((nested(draw, 3, letters) for _ in range(draw.randint(1, 5))), [])[:400]
        assert runs.find_runs(words) == plain_runs(words)


def test_long_texts_of_few_words_stay_cheap():
    assert runs.find_runs([b"a"] * 50_000) == [(0, 50_000, 1)]
    block = ([b"a"] * 100 + [b"b"]) * 100
    found = runs.find_runs(block)
    assert (0, 10_100, 101) in found and len(found) == 101


def test_known_runs_and_collapsed_text(spark, odd, none):
    rows = [(1, "x a b a b a b a b a b y"), (2, "a a a a a"), (3, " a a\na a a\ta "), (4, None), (5, "")]
    got = {r.doc_id: r for r in runs.periodic_runs(spark.createDataFrame(rows, FEW)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 10, 2)] and got[1].collapsed == "x a b y"
    assert got[2].runs == [] and got[2].collapsed == "a a a a a"
    assert [tuple(x) for x in got[3].runs] == [(0, 6, 1)] and got[3].collapsed == "a"
    assert got[4].runs == got[5].runs == [] and got[4].collapsed == got[5].collapsed == ""
    clash = odd.withColumn("runs", F.lit("own"))
    assert runs.periodic_runs(clash).count() == odd.count() and runs.periodic_runs(none).isEmpty()
    assert runs.periodic_runs(odd, digest=True).where("runs_sha256 IS NULL OR collapsed_sha256 IS NULL").isEmpty()


def test_registered_runs_as_brute_force(spark):
    import __spark_entry__ as entry_points

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = entry_points.queries()["op11_periodic_runs"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for row in got:
        words = (texts[row.doc_id] or "").encode().split()
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue  # the plain version takes the square of the length
        want = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        assert row.n_runs == len(want)
        assert row.runs_sha256 == brute.sha("".join(f"{s},{m},{q}\n" for s, m, q in want))
        gone = {i for s, m, q in want for i in range(s + q, s + m)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        if want:
            best = min(want, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (*best, 1000 * best[1] // best[2])
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4


# ------------------------------------------------------------ conversation repair

CONV = "conv_id long, turn long, role string, text string, copies int"
STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def plain_repair(lines):
    """Cheapest edits by dynamic programming over all rows at once; ``lines`` has (role, text) in order."""
    def with_insertions(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                after = "a" if state == "u" else "u"
                best[after] = min(best.get(after, (10**9, "")), (cost + 3, audit + "I"))
        return best

    best, seen = with_insertions({"": (0, "")}), set()
    for role, text in lines:
        body = text.strip(" \t\n\x0b\x0c\r")
        goes = not body or (role, text) in seen
        cut = 3 * (not body.endswith((".", "!", "?")))
        seen.add((role, text))
        new = defaultdict(list)
        for state, (cost, audit) in best.items():
            new[state].append((cost + 4, audit + "D"))
            if not goes:
                if role[:1] in STEPS[state]:
                    new[STEPS[state][role[:1]]].append((cost + cut, audit + "K"))
                for after in "ua":
                    if after in STEPS[state]:
                        new[after].append((cost + 3 + cut, audit + "R"))
        best = with_insertions({state: min(ways) for state, ways in new.items()})
    cost, audit = min(best[s] for s in ("", "a") if s in best)
    out, i, state = [], 0, ""
    for letter in audit:
        role = {"u": "assistant"}.get(state, "user")
        if letter != "I":
            if letter == "K":
                role = lines[i][0]
            text = lines[i][1]
            i += 1
        else:
            text = ""
        if letter != "D":
            out.append((role, text))
            state = role[0]
    return cost, audit, out


def conversation(draw, length):
    said = [(draw.choice(["user", "assistant", "user", "assistant", "system", "tool", " "]),
             draw.choice(["One.", "Two?", "Three!", "four", "", " \t", f"No. {draw.randint(0, 99)}."]))
            for _ in range(length)]
    return [(turn, *x) for turn, x in enumerate(said)]


def expected(rows):
    found, lines = {}, defaultdict(list)
    for conv, turn, role, text, copies in rows:
        lines[conv] += [(turn, role, text)] * copies
    for conv, said in lines.items():
        said = sorted(said, key=lambda x: x[0])
        cost, audit, out = plain_repair([x[1:] for x in said])
        found[conv] = (cost, audit, brute.sha("\n".join(f"{r}:{t}" for r, t in out)), out)
    return found


@pytest.mark.parametrize("piece_rows", [3, 512])
def test_repairs_as_brute_force(spark, piece_rows):
    """Small pieces join to the same repairs, also of a conversation that holds most rows."""
    draw, rows = random.Random(piece_rows), []
    for conv in [*range(60), None]:
        rows += [(conv, *x, draw.choice([1, 1, 1, 2, 0])) for x in conversation(draw, draw.randint(0, 9))]
    rows += [(99, *x, 1) for x in conversation(draw, 700)] + [(98, 0, "user", "gone.", 0)]
    draw.shuffle(rows)
    table = spark.createDataFrame(rows, CONV).repartition(5)
    want = expected(rows)
    got = repairs.repair(table, copies="copies", piece_rows=piece_rows).collect()
    assert sorted(((r.conv_id, r.cost, r.audit, r.repaired_sha256) for r in got), key=repr) == sorted(
        ((c, *x[:3]) for c, x in want.items()), key=repr)
    lines = defaultdict(list)
    for r in repairs.repaired_rows(table, copies="copies", piece_rows=piece_rows).collect():
        lines[r.conv_id].append((r.position, r.role, r.text))
    for conv, (*_, out) in want.items():
        assert sorted(lines[conv]) == [(k, *x) for k, x in enumerate(out)]


def test_faults_counted_across_pieces(spark):
    rows = [(1, t, r, x, 1) for t, r, x in [
        (None, "user", "Hi."), (0, "user", "Hi."), (0, "user", "Hi."), (4, "assistant", "cut"), (4, "tool", " "),
        (9, "assistant", "So.\n"), (9, None, None)]]
    for piece_rows in (1, 2, 512):
        row, = repairs.repair(spark.createDataFrame(rows, CONV), piece_rows=piece_rows).collect()
        assert (row.gaps, row.blank, row.duplicate, row.truncated) == (7, 2, 2, 1)


def test_repairs_of_odd_tables(spark):
    none = spark.createDataFrame([], CONV)
    assert repairs.repair(none).isEmpty() and repairs.repaired_rows(none).isEmpty()
    wide = [(1, -(1 << 63), "user", "x" * 100_000 + ".", 1), (1, (1 << 63) - 1, "assistant", "Yes.", 1)]
    clash = spark.createDataFrame(wide, CONV).selectExpr("*", "'own' AS audit", "'own' AS gaps", "1 AS conv")
    row, = repairs.repair(clash).collect()
    assert (row.audit, row.cost, row.gaps) == ("KK", 0, (1 << 63) - 1)


# ------------------------------------------------------------ mixing sources

DOCS = "doc_id long, source string, text string"


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        rest = total - sum(epochs * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in names if s not in capped)
        target = {s: epochs * sizes[s] if s in capped else weight[s] * rest / open_ for s in names}
        over = {s for s in names if s not in capped and target[s] > epochs * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing_meets_its_targets(spark):
    draw = random.Random(3)
    rows = [(d, draw.choice(["a", "b", "ä", "z", None, "hot", "hot", "hot"]), "w " * draw.choice([0, 1, 5, 40, 900]))
            for d in range(3000)]
    rows += [(7, "one id", "same text here")] * 800 + [(None, "no id", f"text {k} x") for k in range(300)]
    rows += [(5000 + k, f"src{k:03d}", " a b ") for k in range(120)] + [(6000, "empty", None), (6001, "blank", " \n")]
    got = mixes.mix(spark.createDataFrame(rows, DOCS).repartition(7)).collect()
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += len((text or "").split())
    want = plain_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(got) == len(rows)
    for source, target in want.items():
        ties = 800 if source == "one id" else 1
        assert target - ties <= taken[source] <= target + 1e-6


def test_mixing_agrees_with_itself_and_follows_the_seed(spark):
    rows = [(d, "s%d" % (d % 3), "w " * (d % 17)) for d in range(400)]
    docs = spark.createDataFrame(rows, DOCS)

    def taken(frame, **options):
        return {r.doc_id: r.taken for r in mixes.mix(frame, **options).collect()}

    assert taken(docs) == taken(docs.repartition(5)) != taken(docs, seed=2)
    assert taken(docs, share=0.5) != taken(docs)


def test_mixing_without_broadcast_and_on_odd_tables(spark, odd, none, monkeypatch):
    docs = odd.withColumn("taken", F.lit("own")).withColumn("size", F.lit("own"))
    whole = sorted((repr(r.doc_id), r.taken) for r in mixes.mix(docs).collect())
    assert mixes.mix(none).isEmpty()
    monkeypatch.setattr(mixes, "small_lookup", lambda *a: mixes_lookup(*a, limit=0))
    assert whole == sorted((repr(r.doc_id), r.taken) for r in mixes.mix(docs).collect())


def mixes_lookup(*rest, limit):
    from tidemart.operators.joins import small_lookup

    return small_lookup(*rest, limit)


def test_mixing_has_no_python_in_its_plan(spark):
    import __spark_entry__ as entry_points

    plan = entry_points.queries()["op13_source_mix"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
