"""Benchmark decontamination: pigeonhole pieces, exact piece hits, Myers' bit-parallel distance.

Texts and items become lower-case runs of letters, digits and underscores. An item of n words may differ
in ``n * ERROR_PERCENT / 100`` words (inserted, deleted or replaced); cut into one piece more than that,
one piece of every match stays whole. Windows of a text whose hash is a piece's are hits; around each hit
the item is searched with Myers' bit-parallel distance over words, which decides.

The items are the stated query set: they are dealt into blocks of about ``BLOCK_CHARS`` characters, each
block is given to every task and the texts pass through block after block. Items of fewer than
``LEAST_WORDS`` words are too common to name a leak and are not searched; null texts have no words. Every
row is returned with its columns and ``hits`` (a column of that name is replaced), one hit per item: the
first of least distance. Items that repeat are reported each.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm import common, shingles

ERROR_PERCENT = 20
LEAST_WORDS = 8
BLOCK_CHARS = 8 << 20
WORD = re.compile(r"\w+")
HITS = "array<struct<item_id: long, start: int, end: int, distance: int>>"
ARROW_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                                 ("distance", pa.int32())]))


def budget(n: int) -> int:
    return n * ERROR_PERCENT // 100


def pieces(n: int) -> list[tuple[int, int]]:
    """(offset, length) of the budget-plus-one pieces of an item of n words."""
    cuts = [k * n // (budget(n) + 1) for k in range(budget(n) + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def masks(words: list[str]) -> dict[str, int]:
    found: dict[str, int] = defaultdict(int)
    for k, w in enumerate(words):
        found[w] |= 1 << k
    return dict(found)


def search(item: dict[str, int], n: int, words: list[str]) -> tuple[int, int]:
    """(least distance, number of words up to its first end) of an item anywhere in ``words``."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, at = n, 0
    for j, w in enumerate(words, 1):
        eq = item.get(w, 0)
        vertical = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, at = score, j
    return best, at


class Index:
    """The pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[tuple[int, list[str], dict, dict]] = []
        self.known = shingles.WordHashes()
        places: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = WORD.findall(text.lower())
            if len(words) < LEAST_WORDS:
                continue
            self.items.append((item_id, words, masks(words), masks(words[::-1])))
            hashes = shingles.word_hashes(words, self.known)
            for offset, length in pieces(len(words)):
                key = int(shingles.windows(hashes[offset:offset + length], length)[0])
                places[length][key].append((len(self.items) - 1, offset))
        self.places = {k: dict(v) for k, v in places.items()}
        self.seen = {}
        for length, keys in self.places.items():
            self.seen[length] = np.zeros(1 << 16, bool)
            self.seen[length][np.fromiter(keys, np.uint64, len(keys)) & np.uint64(0xFFFF)] = True

    def candidates(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """(item, place where it would start) of each piece hit, over many texts at once."""
        found = set()
        for length, keys in self.places.items():
            values = shingles.windows(hashes, length)
            for at in np.flatnonzero(self.seen[length][(values & np.uint64(0xFFFF)).astype(np.intp)]).tolist():
                found.update((item, at - offset) for item, offset in keys.get(int(values[at]), ()))
        return found

    def best(self, item: int, start: int, words: list[str]) -> tuple[int, int, int] | None:
        """(distance, first word, end word) of the item near ``start``, or None beyond the budget."""
        _, pattern, forward, backward = self.items[item]
        n = len(pattern)
        low, high = max(0, start - budget(n)), min(len(words), start + n + budget(n))
        distance, end = search(forward, n, words[low:high])
        if distance > budget(n):
            return None
        _, back = search(backward, n, words[low:low + end][::-1])
        return distance, low + end - back, low + end

    def hits(self, texts: list[str]) -> list[list[dict]]:
        split = [WORD.findall(t.lower()) for t in texts]
        gap = np.zeros(1, np.uint64)
        parts = [p for words in split for p in (shingles.word_hashes(words, self.known), gap)]
        ends = np.cumsum([len(words) + 1 for words in split])
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        for item, start in sorted(self.candidates(np.concatenate([*parts, gap]))):
            # A start before the first word belongs to the text in which the piece lies.
            row = int(np.searchsorted(ends, start + len(self.items[item][1]) // 2, "right"))
            for k in {row - 1, row, row + 1} & set(range(len(texts))):
                begin = int(ends[k]) - len(split[k]) - 1
                reach = budget(len(self.items[item][1])) + len(self.items[item][1])
                if not begin - reach < start < int(ends[k]):
                    continue
                seen = self.best(item, start - begin, split[k])
                if seen and seen < found[k].get(item, (1 << 30, 0, 0)):
                    found[k][item] = seen
        return [self._spans(t, f) for t, f in zip(texts, found, strict=True)]

    def _spans(self, text: str, found: dict[int, tuple[int, int, int]]) -> list[dict]:
        if not found:
            return []
        # Lower case may change a text's length; the places then are those of the lower-case text.
        spans = [m.span() for m in WORD.finditer(text if len(text.lower()) == len(text) else text.lower())]
        if len(spans) < max(e for _, _, e in found.values()):
            spans = [m.span() for m in WORD.finditer(text.lower())]
        return [{"item_id": self.items[i][0], "start": spans[a][0], "end": spans[max(a, b - 1)][1],
                 "distance": d} for i, (d, a, b) in sorted(found.items())]


def _find(column: int, hits_column: int | None, items: list[tuple[int, str]]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items)
        for batch in batches:
            found = index.hits([x.as_py() or "" for x in batch.column(column)])
            if hits_column is not None:
                found = [a.as_py() + b for a, b in zip(batch.column(hits_column), found, strict=True)]
            yield common.with_arrays(batch, {"hits": pa.array(found, ARROW_HITS)})
    return find


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``hits``: item_id, start, end (code points, end exclusive) and distance."""
    common.arrow_rows(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    schema = common.with_fields(docs.schema, T.StructField("hits", T._parse_datatype_string(HITS)))
    rows = docs.drop("hits")
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        held = sorted((r.item_id, r.text) for r in block.where("item_id IS NOT NULL").toLocalIterator())
        rows = rows.mapInArrow(
            _find(rows.columns.index(text), rows.columns.index("hits") if k else None, held), schema)
    return rows


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_hits(docs, common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("hits"))
