"""Normalised indel similarity: 200 * LCS / (length + length), on sorted tokens and token sets.

The longest common subsequence has no built-in function, so scores are an
Arrow-batched UDF over bit-parallel integers.  Callers score distinct pairs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one column of the table per integer."""
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & at.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 - 100.0 * (total - 2 * lcs(a, b)) / total if total else 100.0


def _sort_ratio(a: str | None, b: str | None) -> float:
    if not a or not b:
        return 0.0
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _set_ratio(a: str | None, b: str | None) -> float:
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (x <= y or y <= x):
        return 100.0
    only_x, only_y = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    common = len(" ".join(sorted(both)))
    gap = 1 if common else 0
    left, right = common + gap + len(only_x), common + gap + len(only_y)
    apart = len(only_x) + len(only_y) - 2 * lcs(only_x, only_y)
    best = 100.0 - 100.0 * apart / (left + right)
    if not common:
        return best
    return max(best, 100.0 - 100.0 * (gap + len(only_x)) / (common + left), 100.0 - 100.0 * (gap + len(only_y)) / (common + right))


@F.pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of the texts with their words in order; case counts."""
    return pd.Series([_sort_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity that forgives words only one text has; case counts."""
    return pd.Series([_set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def fuzzy_score(a, b):
    """0 to 100 on lower-case texts; 0 if either is empty or null."""
    return F.coalesce(token_set_ratio(F.lower(a), F.lower(b)), F.lit(0.0))
