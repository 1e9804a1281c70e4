"""String likeness. The one Python function of the engine; it runs on distinct candidate pairs only."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def jaro_winkler_text(a: str | None, b: str | None, prefix_weight: float = 0.1, boost_from: float = 0.7) -> float | None:
    """Jaro likeness with Winkler's bonus for a common prefix of up to four characters."""
    if a is None or b is None:
        return None
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = [True] * len(b)
    common_a: list[str] = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == ch:
                free[j] = False
                common_a.append(ch)
                break
    m = len(common_a)
    if m == 0:
        return 0.0
    common_b = [ch for ch, unused in zip(b, free) if not unused]
    half_moves = sum(x != y for x, y in zip(common_a, common_b)) // 2
    jaro = (m / len(a) + m / len(b) + (m - half_moves) / m) / 3.0
    if jaro <= boost_from:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * prefix_weight * (1.0 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler_text(x, y) for x, y in zip(a, b)], dtype="float64")


def edit_likeness(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance over the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longest)
