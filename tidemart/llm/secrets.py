"""Secret scans: fixed patterns, and strings that a token vocabulary encodes badly.

Prose has several characters per token because its words are in the vocabulary; random keys have few.
A run of ``LEAST_LENGTH`` or more key characters that holds letters and digits and has fewer than
``MOST_CHARS_PER_TOKEN`` characters per token is a span of kind ``random``, unless it is a known digest
(hex of a usual digest length), an identifier (UUID, number) or overlaps a span of a pattern.

A null text counts as empty and has no spans. Every row is returned, with further columns; columns of
the same names as the results are replaced. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemart.llm import common, tokenizer

KINDS = ("assign", "access", "hex", "random")
HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST_LENGTH = 20
MOST_CHARS_PER_TOKEN = 2.0
RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_LENGTH},}}+")
# Known digests and identifiers: hex digests of usual lengths in either case, UUIDs, plain numbers.
KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9+/_=-]+)")

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(hint in low for hint in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(text: str, base: list[Span], encoder) -> list[Span]:
    if not any(len(w) >= LEAST_LENGTH and not w.isalpha() for w in text.split()):
        return []
    found: list[Span] = []
    for m in RUN.finditer(text):
        run = m[0]
        if not (re.search("[0-9]", run) and re.search("[A-Za-z]", run)) or KNOWN.fullmatch(run):
            continue
        if any(s < m.end() and m.start() < e for s, _, e in base):
            continue
        # Token counts of pieces add up to at most one token more per cut, and bound the work per call.
        tokens = sum(len(encoder.encode_ordinary(run[i:i + 4096])) for i in range(0, len(run), 4096))
        if len(run) < MOST_CHARS_PER_TOKEN * tokens:
            found.append((m.start(), 3, m.end()))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with each covered stretch replaced by ``mark``."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def _scan(column: int, path: str, clean: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.library(path)
        for batch in batches:
            base, every, texts = [], [], []
            for value in batch.column(column):
                text = value.as_py() or ""
                base.append(base_spans(text))
                every.append(sorted(base[-1] + random_spans(text, base[-1], encoder)))
                if clean:
                    texts.append(redacted(text, every[-1]) if every[-1] else value.as_py())
            counts = [[sum(k == kind for _, k, _ in spans) for spans in every] for kind in range(4)]
            yield common.with_arrays(batch, {
                **({batch.schema.names[column]: pa.array(texts, pa.string())} if clean else {}),
                **{f"n_{KINDS[k]}": pa.array(counts[k], pa.int64()) for k in range(4)},
                "base_sha256": pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base],
                                        pa.string()),
                "spans": pa.array([joined(x) for x in every], pa.string())})
    return scan


def secret_scan(docs: DataFrame, text: str = "text", path: str | None = None, clean: bool = False) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, n_random, base_sha256 and spans.

    ``clean`` replaces the spans in the text, which then is the first of the new columns.
    """
    common.arrow_rows(docs.sparkSession)
    new = [T.StructField(text, T.StringType())] if clean else []
    new += [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    new += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    scan = _scan(docs.columns.index(text), path or tokenizer.default_path(), clean)
    return docs.mapInArrow(scan, common.with_fields(docs.schema, *new))


def op4_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")
