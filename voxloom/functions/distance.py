"""Edit distances between token lists, by the built-in Levenshtein on one code point per distinct token, and over
Arrow where a pair has more distinct tokens than code points are set apart."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_DISTINCT = 20_000  # distinct tokens of a pair that fit between U+4E00 and the surrogates, with room


def _steps(reference: list, hypothesis: list) -> int:
    """Levenshtein of two lists of any size, a row of the table at a time."""
    number: dict = {}
    a, b = (np.array([number.setdefault(w, len(number)) for w in x], np.int64) for x in (reference, hypothesis))
    if len(a) > len(b):
        a, b = b, a
    at = np.arange(len(b) + 1, dtype=np.int64)
    row = at.copy()
    for w in a:
        new = row + 1  # a token of the shorter list left out
        np.minimum(new[1:], row[:-1] + (b != w), out=new[1:])
        row = np.minimum.accumulate(new - at) + at  # or tokens of the longer one put in, one after another
    return int(row[-1])


def _long_distance(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    return pd.Series([None if r is None else _steps(list(r), list(h)) for r, h in zip(reference, hypothesis, strict=True)], dtype="Int32")


def token_distance(reference: Column, hypothesis: Column) -> Column:
    """Insertions, deletions and substitutions between two arrays of strings.

    Null arrays count as empty; null items as a token of their own. Pairs with more than
    MOST_DISTINCT distinct tokens go through an Arrow function, which gets nulls for all others.
    """
    clean = lambda a: F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda w: F.coalesce(w, F.lit("\u0000")))
    r, h = clean(reference), clean(hypothesis)
    known = F.array_distinct(F.concat(r, h))
    coded = lambda a: F.decode(F.unhex(F.concat_ws("", F.transform(a, lambda w: F.hex(F.lit(19968) + F.array_position(known, w))))), "UTF-16BE")
    many = F.size(known) > MOST_DISTINCT
    long = F.pandas_udf(_long_distance, "int")(F.when(many, r), F.when(many, h))
    return F.when(many, long).otherwise(F.levenshtein(coded(r), coded(h)))


def character_distance(reference: Column, hypothesis: Column) -> Column:
    """Levenshtein over code points, blanks left out."""
    return F.levenshtein(F.replace(reference, F.lit(" "), F.lit("")), F.replace(hypothesis, F.lit(" "), F.lit("")))


def error_rate(errors: Column, length: Column) -> Column:
    return errors / F.greatest(F.lit(1), length)


def _counts(reference: list, hypothesis: list) -> tuple[int, int, int]:
    n, m = len(reference), len(hypothesis)
    table = [list(range(m + 1))]
    for i in range(1, n + 1):
        row, above = [i], table[-1]
        for j in range(1, m + 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (reference[i - 1] != hypothesis[j - 1])))
        table.append(row)
    s = d = i = 0
    a, b = n, m
    while a or b:
        same = a and b and table[a][b] == table[a - 1][b - 1] + (reference[a - 1] != hypothesis[b - 1])
        if same:
            s += reference[a - 1] != hypothesis[b - 1]
            a, b = a - 1, b - 1
        elif a and table[a][b] == table[a - 1][b] + 1:
            d, a = d + 1, a - 1
        else:
            i, b = i + 1, b - 1
    return s, d, i


def _edit_kinds(reference: pd.Series, hypothesis: pd.Series) -> pd.DataFrame:
    rows = [_counts(list(r) if r is not None else [], list(h) if h is not None else []) for r, h in zip(reference, hypothesis, strict=True)]
    return pd.DataFrame(rows, columns=["substitutions", "deletions", "insertions"])


def edit_kinds(reference: Column, hypothesis: Column) -> Column:
    """``struct(substitutions, deletions, insertions)`` of one best alignment. The trace back through the
    table has no built-in form, so it runs over Arrow."""
    return F.pandas_udf(_edit_kinds, "substitutions int, deletions int, insertions int")(reference, hypothesis)
