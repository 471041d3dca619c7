"""Periodic runs of words by an online sparse diagonal program, and texts with the repetitions taken out.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and ``POWERS * q`` long, that no
neighbouring word extends. Words equal at lag q make a streak on the diagonal q; a stretch of period q is a
streak and the q words before it. Going through the words once, each word's earlier occurrences continue or
start streaks at their lags, and a streak that ends long enough emits its stretch at once.

Only lags that can still matter are kept, without losing a run:

* the shortest useful streak has ``SEED`` words, so occurrences are those of the last ``SEED`` words together;
* a lag must still fit ``POWERS`` times into the text, and where it starts, the last words of its shortest
  useful streak are compared first;
* while a run of period q is open, a longer lag that starts inside it is left out: if q divides it, it is
  the same stretch; else a streak of q words would give the stretch a smaller period (Fine and Wilf), so it
  can only outlive the run. Where a run ends, all lags of that place are looked at again, and the start of
  each streak is found by going back along its diagonal.

Tasks hold one text at a time. A null text has no words; an empty or blank one too: no runs, and the collapsed
text is empty. Repeated and null ids do not matter: each row is a text of its own. Results replace columns of
the same names; further columns stay. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm import common

LEAST = 6
POWERS = 4
# A stretch of period 1 has a streak of LEAST - 1 words, all others have longer ones.
SEED = LEAST - 1

Run = tuple[int, int, int]  # start, length, period

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def seed_numbers(words: list[bytes]) -> np.ndarray:
    """A number for the ``SEED`` words that end at each word: equal numbers, equal words; -1 where too few."""
    known: dict[bytes, int] = {}
    single = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))

    def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * (len(words) + 1) + right, return_inverse=True)[1]

    two = pair(single[:-1], single[1:])
    four = pair(two[:-2], two[2:])
    return np.concatenate([[-1] * (SEED - 1), pair(four[:-1], single[SEED - 1:])])


def shortest(lag: int) -> int:
    """Words of the shortest useful streak at a lag."""
    return max(LEAST, POWERS * lag) - lag


def find_runs(words: list[bytes]) -> list[Run]:
    """All runs by start, then period."""
    n = len(words)
    if n < LEAST:
        return []
    numbers = seed_numbers(words)
    seeds = numbers.tolist()
    order = np.argsort(numbers[SEED - 1:], kind="stable") + SEED - 1
    bounds = np.concatenate([[0], np.cumsum(np.bincount(numbers[SEED - 1:]))]).tolist()
    met = [0] * (len(bounds) - 1)  # how many places of each seed are behind
    places = [i for i in range(SEED - 1, n) if bounds[seeds[i] + 1] - bounds[seeds[i]] > 1]
    streaks: dict[int, int] = {}  # lag -> where its streak's first seed ends
    open_runs: dict[int, int] = {}  # period -> start of its stretch
    found: dict[tuple[int, int], int] = {}  # (start, length) -> least period

    def lags(i: int, farthest: int, probed: bool) -> list[int]:
        """Lags of the earlier occurrences; with ``probed``, of those whose streak from here may be useful."""
        begin = bounds[seeds[i]]
        last = begin + met[seeds[i]]
        met[seeds[i]] += 1
        if farthest < 1 or last == begin or order[last - 1] < i - farthest:
            return []
        near = i - order[begin + np.searchsorted(order[begin:last], i - farthest):last]
        if probed:
            probe = i + np.maximum(LEAST, POWERS * near) - near - SEED
            near = near[numbers[probe] == numbers[probe - near]]
        return near.tolist()

    def end(lag: int, first: int, last: int) -> bool:
        start = first - SEED + 1 - lag
        length = last + 1 - start
        if length < max(LEAST, POWERS * lag):
            return False
        found[start, length] = min(lag, found.get((start, length), lag))
        return True

    def left_out(lag: int, first: int) -> bool:
        return any(lag > q and first - SEED + 1 >= start for q, start in open_runs.items())

    before = -1
    for i in places:
        seed = seeds[i]
        ended = []
        if i != before + 1:
            for lag, first in streaks.items():
                end(lag, first, before)
            streaks.clear()
            open_runs.clear()
        else:
            ended = [lag for lag in streaks if seeds[i - lag] != seed]
        again = False
        for lag in ended:
            end(lag, streaks.pop(lag), i - 1)
            again |= open_runs.pop(lag, None) is not None
        if again:
            for lag in lags(i, n // POWERS, False):
                if lag in streaks or any(lag % q == 0 and i - lag - SEED + 1 >= at for q, at in open_runs.items()):
                    continue
                first = i
                while first - 1 >= lag and seeds[first - 1] >= 0 and seeds[first - 1] == seeds[first - 1 - lag]:
                    first -= 1
                probe = first + shortest(lag) - SEED
                if probe < n and seeds[probe] == seeds[probe - lag] and not left_out(lag, first):
                    streaks[lag] = first
        else:
            # A lag must fit from here, and be shorter than every open run's.
            fitting = (n - i + SEED - 1) // (POWERS - 1)
            for lag in lags(i, min([fitting, *[q - 1 for q in open_runs]]), True):
                streaks.setdefault(lag, i)
        for lag, first in list(streaks.items()):
            start = first - SEED + 1 - lag
            if lag not in open_runs and i + 1 - start >= max(LEAST, POWERS * lag):
                open_runs[lag] = start
                for other, began in list(streaks.items()):
                    if other > lag and began - SEED + 1 >= start:
                        del streaks[other]
                        open_runs.pop(other, None)
        before = i
    for lag, first in streaks.items():
        end(lag, first, before)
    return sorted((start, length, lag) for (start, length), lag in found.items())


def by_start_and_period(runs: list[Run]) -> list[Run]:
    return sorted(runs, key=lambda run: (run[0], run[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run repeated most often; ties by start, then period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words that no run holds behind its first period."""
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    inside = np.cumsum(edges[:-1])
    return [w for w, k in zip(words, inside.tolist()) if not k]


def _digest(words: list[bytes], runs: list[Run]) -> tuple:
    best = strongest(runs)
    start, length, period = best or (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    collapsed = b" ".join(kept_words(words, runs) if runs else words)
    return (len(runs), start, length, period, 1000 * length // period if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest())


def _find(column: int, digest: bool):
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(column).cast(pa.binary()):
                words = (text.as_py() or b"").split()  # bytes know only the six white space characters of the rule
                runs = by_start_and_period(find_runs(words))
                if digest:
                    out.append(_digest(words, runs))
                else:
                    keys = ("start", "length", "period")
                    out.append(([dict(zip(keys, run)) for run in runs], b" ".join(kept_words(words, runs)).decode()))
            if digest:
                kinds = [pa.int64()] * 5 + [pa.string()] * 2
                cells = {c: pa.array([row[k] for row in out], kind) for k, (c, kind) in enumerate(zip(names, kinds))}
            else:
                cells = {"runs": pa.array([row[0] for row in out], pa.list_(_RUN)),
                         "collapsed": pa.array([row[1] for row in out], pa.string())}
            yield common.with_arrays(batch, cells)
    return find


def periodic_runs(docs: DataFrame, text: str = "text", digest: bool = False) -> DataFrame:
    """``docs`` with runs and collapsed text; with ``digest`` the number of runs, the strongest one and hashes."""
    common.arrow_rows(docs.sparkSession)
    new = T._parse_datatype_string(
        "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
        "collapsed_sha256 string" if digest else
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return docs.mapInArrow(_find(docs.columns.index(text), digest), common.with_fields(docs.schema, *new.fields))


def _repeated(words: Column, g: Column) -> Column:
    """Words from number a = g % n on repeat the p words there, p = 1 + (n - a) div (3 + g % 8)."""
    n = F.size(words)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    number = F.sequence(F.lit(0), n - 1)
    return F.transform(number, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))


def planted(docs: DataFrame) -> DataFrame:
    """The contract's texts: where crc32 of the id ends in 0, a part of the words repeats; null ids stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = common.computed(docs.select("doc_id", "text"), {
        "_g": F.floor(h / 10), "_words": F.when(h % 10 == 0, common.words(F.col("text")))})
    changed = F.when(F.size("_words") > 0, F.array_join(_repeated(F.col("_words"), F.col("_g")), " "))
    return rows.select("doc_id", F.coalesce(changed, "text").alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(common.table(spark, sf_dir, "documents")), digest=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                        "collapsed_sha256")
