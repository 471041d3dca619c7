"""Byte-level BPE: recursive DuckDB queries inside each partition.

Each task splits its texts into the pattern's pieces. Distinct pieces become rows (piece, position, token), one
per byte at first, or one in all where the piece is a vocabulary entry. A recursive query joins neighbouring
tokens with the merge table and contracts each piece's leftmost pair of least rank until a piece has no pair
left; ordered aggregations over the merged rows give a piece's ids and, joined with the vocabulary, the bytes that
these decode to. A text's ids and bytes are those of its pieces in order.

A task works on about ``BLOCK_BYTES`` of text at a time, a query on pieces whose steps are at most ``QUERY_ROWS`` rows,
and a task remembers at most ``KNOWN_BYTES`` of encoded pieces. Its connection ends with it, so a reused worker
keeps nothing but the vocabulary. DuckDB keeps to its memory limit and writes no files.

A recursion needs as many steps as its longest piece has merges, each over all rows of the piece. Pieces over
``LONGEST`` bytes (one "word" of thousands of letters) would take minutes to hours and are merged by the tokenizer
library instead, which gives the same ids; their bytes are decoded by the vocabulary as well.

A null text counts as empty: no ids, and decoded to empty bytes. Every row is returned with further
columns; columns of the same names as the results are replaced.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Collection, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemart.llm import common, tokenizer

BLOCK_BYTES = 4 << 20
KNOWN_BYTES = 24 << 20
QUERY_ROWS = 2_000_000
LONGEST = 2048

MERGE = """
WITH RECURSIVE state(w, p, t, live) AS (
    SELECT w, p, t, true FROM bytes_
    UNION ALL
    (WITH pairs AS (
        SELECT w, p, t, lead(t) OVER next_ AS t2, lead(p) OVER next_ AS p2
        FROM state WHERE live WINDOW next_ AS (PARTITION BY w ORDER BY p)),
    best AS (
        SELECT w, min(r::BIGINT << 32 | p) AS rank_at, arg_min(p2, r::BIGINT << 32 | p) AS gone
        FROM pairs JOIN merges ON ab = (t::BIGINT << 32 | t2)
        WHERE t2 IS NOT NULL GROUP BY w)
    SELECT x.w, x.p, CASE WHEN x.p = (rank_at & 4294967295) THEN (rank_at >> 32)::INT ELSE x.t END,
        rank_at IS NOT NULL
    FROM pairs x LEFT JOIN best USING (w) WHERE rank_at IS NULL OR x.p <> gone)
)
SELECT w, string_agg(t::VARCHAR, ' ' ORDER BY p) AS ids, unhex(string_agg(hex(b), '' ORDER BY p)) AS decoded
FROM state JOIN vocabulary USING (t) WHERE NOT live GROUP BY w ORDER BY w"""

# The same answer for rows that are merged already.
MERGED = """
SELECT w, string_agg(t::VARCHAR, ' ' ORDER BY p) AS ids, unhex(string_agg(hex(b), '' ORDER BY p)) AS decoded
FROM bytes_ JOIN vocabulary USING (t) GROUP BY w ORDER BY w"""


@lru_cache(maxsize=1)
def merge_rows(path: str) -> pa.Table:
    """(ab, r): two tokens, packed in one number, whose bytes together are the token of rank r."""
    ranks = tokenizer.ranks(path)
    left, right, rank = [], [], []
    for token, r in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(r)
    pairs = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
    return pa.table({"ab": pairs, "r": np.array(rank, np.int32)})


class Encoder:
    """Encodes pieces through a DuckDB connection of its own, one thread, and remembers some of them."""

    def __init__(self, path: str):
        import duckdb
        import regex

        self.path, self.ranks = path, tokenizer.ranks(path)
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self.con.register("given", merge_rows(path))
        self.con.execute("CREATE TABLE merges AS FROM given")
        self.con.register("given", pa.table({
            "t": pa.array(self.ranks.values(), pa.int32()), "b": pa.array(self.ranks, pa.binary())}))
        self.con.execute("CREATE TABLE vocabulary AS FROM given")
        self.con.unregister("given")
        self.known: dict[str, tuple[str, bytes]] = {}  # piece -> its ids as text, and the bytes they decode to
        self.size = 0

    def close(self) -> None:
        self.con.close()

    def learn(self, pieces: set[str]) -> None:
        """Encode and decode the pieces that are not known yet."""
        if self.size > KNOWN_BYTES:
            self.known.clear()
            self.size = 0
        words: list[str] = []
        raws: list[bytes] = []
        merged: dict[str, list[int]] = {}
        rows = 0
        # Pieces of like length need about as many steps, so short ones do not wait for long ones.
        for piece in sorted(pieces.difference(self.known), key=len):
            raw = piece.encode()
            one = self.ranks.get(raw)
            if one is not None:
                merged[piece] = [one]
            elif len(raw) > LONGEST:
                merged[piece] = tokenizer.library(self.path).encode_ordinary(piece)
            else:
                # A piece of n bytes has at most n steps of n, n - 1, ... rows.
                rows += len(raw) * (len(raw) + 1) // 2
                words.append(piece)
                raws.append(raw)
                if rows >= QUERY_ROWS:
                    self._merge(words, raws)
                    words, raws, rows = [], [], 0
        if words:
            self._merge(words, raws)
        if merged:
            self._query(merged.keys(), merged.values(), np.array(list(chain(*merged.values())), np.int32), MERGED)

    def _merge(self, words: list[str], raws: list[bytes]) -> None:
        self._query(words, raws, self.bytes[np.frombuffer(b"".join(raws), np.uint8)], MERGE)

    def _query(self, pieces: Collection[str], sized: Collection, tokens: np.ndarray, sql: str) -> None:
        """Rows of ``tokens``, of which each piece has as many as its entry in ``sized`` is long, through ``sql``."""
        lengths = np.fromiter(map(len, sized), np.int64, len(sized))
        starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.con.register("bytes_", pa.table({
            "w": np.repeat(np.arange(len(lengths), dtype=np.int32), lengths),
            "p": (np.arange(len(starts)) - starts).astype(np.int32), "t": tokens}))
        found = self.con.sql(sql).to_arrow_table()
        self.con.unregister("bytes_")
        answers = zip(found["ids"].to_pylist(), found["decoded"].to_pylist(), strict=True)
        self.known.update(zip(pieces, answers, strict=True))
        self.size += found["ids"].nbytes + 2 * found["decoded"].nbytes


def _results(rows: list[list[str]], coder: Encoder, digest: bool) -> dict[str, pa.Array]:
    texts, decoded = [], []
    for row in rows:
        known = [coder.known[piece] for piece in row]
        texts.append(" ".join([ids for ids, _ in known]))
        decoded.append(b"".join([parts for _, parts in known]))
    counts = pa.array([t.count(" ") + 1 if t else 0 for t in texts], pa.int64())
    if digest:
        return {"n_tokens": counts,
                "ids_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())}
    return {"n_tokens": counts,
            "ids": pa.array([np.fromstring(t, np.int32, sep=" ") for t in texts], pa.list_(pa.int32())),
            "decoded": pa.array(decoded, pa.binary())}


def _encode(column: int, path: str, digest: bool):
    def work(held: list[pa.RecordBatch], coder: Encoder) -> Iterator[pa.RecordBatch]:
        pieces = [[coder.find(x.as_py() or "") for x in batch.column(column)] for batch in held]
        coder.learn(set(chain.from_iterable(chain.from_iterable(pieces))))
        for batch, rows in zip(held, pieces, strict=True):
            yield common.with_arrays(batch, _results(rows, coder, digest))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, size = Encoder(path), [], 0
        # Millions of pieces, none of them in a cycle: the collector would walk them again and again.
        collects = gc.isenabled()
        gc.disable()
        try:
            for batch in batches:
                held.append(batch)
                size += batch.column(column).nbytes
                if size >= BLOCK_BYTES:
                    yield from work(held, coder)
                    held, size = [], 0
            if held:
                yield from work(held, coder)
        finally:
            coder.close()
            if collects:
                gc.enable()
    return encode


def encode_decode(docs: DataFrame, text: str = "text", path: str | None = None,
                  digest: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids and decoded bytes; with ``digest`` their hashes instead."""
    common.arrow_rows(docs.sparkSession)
    new = [T.StructField("n_tokens", T.LongType())] + ([
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
        if digest else [
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])
    return docs.mapInArrow(_encode(docs.columns.index(text), path or tokenizer.default_path(), digest),
                           common.with_fields(docs.schema, *new))


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, digest=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
