"""Rows and helpers that the tests share."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
LONG = "Ünder wave " + " ".join(f"word{i % 700}" for i in range(60_000))
#: Nulls in every column, empty and very long texts, repeated rows, names that the operators use themselves.
ODD = [
    (1, "the river runs over the old stones and under the bridge of the town", "en", "a", 1, "x"),
    (2, None, None, None, None, None),
    (3, "", "en", "", 0, ""),
    (None, "la rivière passe sur les pierres et sous le pont de la ville", "fr", "b", 1, "x"),
    (4, LONG, "en", "b", 1, "x"),
    (5, "la rivière passe sur les pierres et sous le pont de la ville", "fr", "b", 1, "x"),
    (5, "la rivière passe sur les pierres et sous le pont de la ville", "fr", "b", 1, "x"),
    (6, "12 !! 34", "en", "c", 1, "x"),
    (7, "one", "en", "c", 1, "x"),
    (8, "  ONE\t", "en", "c", 1, "x"),
]


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
