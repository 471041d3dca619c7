"""Rows that the tests of this folder share."""

import random

SMALL = "/root/testdata/sf0.001"
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, score string, kept string, "
           "spans string, hits string, n_tokens string, ids string, found string, label string, n_words string")
FEW = "doc_id long, text string"


def prose(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(["an", "be", "cor", "du", "el", "fi", "gar"]) for _ in range(draw.randint(1, 4)))
            for _ in range(n)]


def odd_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, repeated rows, one long word, a long text and plain prose."""
    rows = [(1, " ".join(prose(1, 90))), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "), (None, "no id here"),
            (None, None), (5, "x" * 30_000), (6, " ".join(prose(6, 30_000))), (7, " café \U0001f600\n\n"),
            (8, "1" * 5000 + " " + "1 " * 5000), (9, "a@" * 3000), (10, "9.9." * 3000 + "+" * 2000)]
    return rows + [rows[0], (1, " ".join(prose(1, 90)) + " more")]
