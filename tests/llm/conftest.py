from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text[, source]) rows, with extra columns named like added ones."""

    def build(rows):
        clashing = ["size", "kept", "keep_id", "target", "score", "hash", "key", "copy", "n", "id", "word"]
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), *["x"] * len(clashing))
            for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENT + "".join(f", {c} string" for c in clashing))

    return build


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, repeated rows, ties."""
    long = " ".join(f"w{i % 977}x{i % 89}" for i in range(60_000))
    return [
        (1, None, None),
        (2, "", "a"),
        (3, " \t\n ", "a"),
        (4, "One  two\nthree", "a"),
        (4, "One  two\nthree", "a"),
        (5, "one two three", "b"),
        (6, long, "b"),
        (7, long + " end", "b"),
        (None, "no id here at all", None),
        (None, "no id here at all", None),
        (8, "x" * 50_000, "é"),
        (9, "One two three", "b"),
    ]
