from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text[, source]) rows, with an extra column whose name clashes with produced ones."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
EDGE = [
    (0, None),
    (1, ""),
    (2, " \t\n\v\f\r "),
    (3, "one"),
    (4, "one"),
    (5, "Two words"),
    (6, LONG),
    (7, LONG + " tail"),
    (8, "a b   café \x1c \x85 naïve"),
    (9, "\n".join(["same line here"] * 5)),
    (None, "no key at all"),
]


@pytest.fixture(scope="session")
def edge():
    """Nulls, empty and word-free texts, ties, long texts, odd white space."""
    return EDGE
