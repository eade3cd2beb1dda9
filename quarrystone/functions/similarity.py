"""Similarity of names by matching blocks (H16), as an Arrow-batched function."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


#: From this length on the library leaves out common characters.
LONG = 200


def ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """Twice the matching characters by the length of both, ``b`` searched for in ``a``; null where the letters of a long
    pair alone show that it is below ``least``."""

    def matching(s: str, t: str) -> int:
        """Characters in matching blocks, as the library counts them in texts that are not long: those of the longest block
        (of several the first in ``s``, then in ``t``), and of the texts before it and after it."""
        size = at = 0
        for i in range(len(s)):
            while i + size < len(s) and s[i : i + size + 1] in t:
                size, at = size + 1, i
        if not size:
            return 0
        to = t.index(s[at : at + size])
        return size + matching(s[:at], t[:to]) + matching(s[at + size :], t[to + size :])

    def of(p: str, q: str) -> float | None:
        if len(p) < LONG:
            return 2.0 * matching(q, p) / (len(p) + len(q)) if p or q else 1.0
        pair = difflib.SequenceMatcher(None, q, p)
        return pair.ratio() if not least or pair.quick_ratio() >= least else None

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else of(p, q) for p, q in zip(x, y)], dtype="float64")

    return run(a, b)
