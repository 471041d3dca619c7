"""Contexts of spans of several words, and of tokens with one word between them."""

import math
import random
import re
from collections import Counter

import brute
import pytest
from llm_rows import FEW, prose

from tidemart.llm import pii


def test_contexts_of_phones_and_between_tokens(spark):
    rows = [(k, f"{' '.join(prose(k, 9))} call us: +1 ({300 + k}) 555-77{k}3 {' '.join(prose(k + 50, 9))}") for k in range(8)]
    rows += [(20 + k, f"{' '.join(prose(k + 20, 9))} SSN 123-45-678{k} mail u{k}@x.org") for k in range(8)]
    rows += [(50, "please call us: desk-77x, today"), (51, "SSN 999-45-6789 mail agent-5 end")]
    docs = spark.createDataFrame(rows, FEW)
    found = {r.doc_id: [(s["kind"], s["value"]) for s in r.found] for r in pii.personal_data(docs).collect()}
    assert found[50] == [(4, "desk-77x")] and found[51] == [(4, "agent-5")]
    assert all([k for k, _ in found[d]] == [3] for d in range(8))
    assert all([k for k, _ in found[d]] == [0] for d in range(20, 28))


def plain_contexts(rows):
    """The bootstrap by dictionaries, for texts whose tokens with digits stand alone between spaces."""
    def marked(word):
        return "#" if re.search(r"[0-9@]", word) else word

    edges, totals, places = Counter(), Counter(), []
    seeds = set()
    for doc_id, text in rows:
        words = text.split()
        low = ["^", *[marked(w) for w in text.lower().split()]]
        totals.update(" ".join(low[i:i + 2]) for i in range(len(low) - 2))
        at = 0
        for i, word in enumerate(words):
            at = text.index(word, at)
            if re.search(r"[0-9@]", word):
                token = word.rstrip(".,")
                pattern = " ".join(low[i - 1:i + 1]) if i else None
                if brute.personal(token):
                    seeds.add(token)
                if pattern and len(token) >= 4:
                    edges[pattern, token] += 1
                    places.append((doc_id, at, at + len(token), token, pattern))
            at += len(word)
    trust = dict.fromkeys(seeds, 1.0)
    for _ in range(pii.ROUNDS):
        accepted = {}
        for pattern in {p for p, _ in edges}:
            mine = {t: n for (p, t), n in edges.items() if p == pattern}
            mass = sum(n * trust.get(t, 0) for t, n in mine.items())
            sure = sum(trust.get(t, 0) >= 0.5 for t in mine)
            if sure >= pii.LEAST_SUPPORT and mass / totals[pattern] >= pii.LEAST_CONFIDENCE:
                accepted[pattern] = min(1.0, mass / totals[pattern])
        trust = dict.fromkeys(seeds, 1.0)
        for token in {t for _, t in edges} - seeds:
            missed = math.prod(1.0001 - accepted[p] for p, t in edges if t == token and p in accepted)
            trust[token] = 1 - missed
    return sorted((d, s, e, t) for d, s, e, t, p in places if t not in seeds and p in accepted)


def planted(seed):
    """Seeds behind known words; unknown tokens behind the same, and behind words that only these lead to."""
    draw = random.Random(seed)
    rows, hidden = [], []

    def add(*words):
        rows.append((len(rows), " ".join([*prose(1000 * seed + len(rows), 6), *words, *prose(len(rows) + 7, 5)])))

    # 90 seeds beside 10 unknown tokens: a confidence of 0.9, and of 18 in 22 for the words these lead to.
    for k in range(90):
        add("write", "to", draw.choice([f"u{k}@mail.org", f"10.0.{k}.7"]))
    names = [f"agent-{k}x" for k in range(12)]
    for name in names[:10]:
        add("write", "to", name)
        hidden.append((rows[-1][0], name))
    for name in [*names, *names[:10]]:
        add("handle", "is", name)
        hidden.append((rows[-1][0], name))
    for k in range(40):
        add("page", "number", f"{k}00"), add("write", "it", f"v{k}.{k}")
    add("x" * 5000, "to", "agent-1x")
    return rows, hidden


@pytest.mark.parametrize("seed", [1, 2])
def test_the_bootstrap_as_brute_force(spark, seed):
    rows, hidden = planted(seed)
    found = pii.personal_data(spark.createDataFrame(rows, FEW).repartition(3)).collect()
    got = sorted((r.doc_id, s["start"], s["end"], s["value"]) for r in found for s in r.found if s["kind"] == 4)
    assert got == plain_contexts(rows)
    named = {(d, t) for d, _, _, t in got}
    assert len(named & set(hidden)) >= 0.9 * len(set(hidden)) and len(named & set(hidden)) >= 0.9 * len(named)


def test_long_words_before_a_match_count_whole(spark):
    """The pattern of a match is its last two words, however long they are."""
    word = "w" * 900
    rows = [(k, f"{word} is u{k}@mail.org") for k in range(5)] + [(9, f"{word} is desk-77x")]
    found = {r.doc_id: r.found for r in pii.personal_data(spark.createDataFrame(rows, FEW)).collect()}
    assert [(s["kind"], s["value"]) for s in found[9]] == [(4, "desk-77x")]
