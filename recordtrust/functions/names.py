"""Fuzzy agreement of names: built-in tests first, an Arrow UDF for what they leave open."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from recordtrust.functions.comparators import tri_state

PREFIX = 4
BOOST = 0.1


def _may_exceed(subject: Column, target: Column, threshold: float) -> Column:
    """False only where Jaro-Winkler cannot exceed the threshold.

    With r = shorter/longer length, Jaro is at most (2 + r) / 3, and a common prefix of p
    characters lifts it by 0.1 * p of what is missing to 1.
    """
    size_s, size_t = F.length(subject), F.length(target)
    r = F.least(size_s, size_t) / F.greatest(size_s, size_t, F.lit(1))
    jaro = (2 + r) / 3
    prefix = sum(
        (F.when(F.left(subject, F.lit(i)) == F.left(target, F.lit(i)), 1).otherwise(0) for i in range(1, PREFIX + 1)),
        F.lit(0),
    )
    return (F.least(size_s, size_t) > 0) & (jaro + F.lit(BOOST) * prefix * (1 - jaro) > F.lit(threshold - 1e-9))


def similar_udf(threshold: float):
    """Arrow UDF: is Jaro-Winkler above the threshold? Null inputs are skipped.

    Everything the workers need is defined inside, so the function travels by value and the
    package need not be installed on the executors.
    """

    def jaro_winkler(a: str, b: str) -> float:
        if not a or not b:
            return 0.0
        reach = max(max(len(a), len(b)) // 2 - 1, 0)
        places: dict[str, int] = {}
        for j, ch in enumerate(b):
            places[ch] = places.get(ch, 0) | 1 << j
        free = (1 << len(b)) - 1
        from_a = []
        for i, ch in enumerate(a):
            start = max(i - reach, 0)
            open_places = (places.get(ch, 0) & free & ((1 << i + reach + 1) - 1)) >> start << start
            if open_places:
                free ^= open_places & -open_places
                from_a.append(ch)
        if not from_a:
            return 0.0
        from_b = [ch for j, ch in enumerate(b) if not free >> j & 1]
        m = len(from_a)
        swaps = sum(x != y for x, y in zip(from_a, from_b)) // 2
        jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
        if jaro <= 0.7:
            return jaro
        prefix = 0
        for x, y in zip(a[:4], b[:4]):
            if x != y:
                break
            prefix += 1
        return jaro + prefix * 0.1 * (1 - jaro)

    def similar(subject: pd.Series, target: pd.Series) -> pd.Series:
        seen: dict[tuple[str, str], bool] = {}
        out = []
        for pair in zip(subject, target):
            if pair[0] is None or pair[1] is None:
                out.append(False)
                continue
            verdict = seen.get(pair)
            if verdict is None:
                verdict = seen[pair] = jaro_winkler(*pair) > threshold
            out.append(verdict)
        return pd.Series(out, dtype="bool")

    similar.__annotations__ = {"subject": pd.Series, "target": pd.Series, "return": pd.Series}
    return F.pandas_udf(similar, "boolean")


def names_agree(subject: Column, target: Column, threshold: float = 0.9) -> Column:
    """Equal, or Jaro-Winkler strictly above the threshold; case counts.

    Only pairs that are unequal and pass the length bound reach Python: the others are sent as
    nulls, since Spark evaluates a Python UDF for every row whatever branch it sits in.
    """
    open_pair = (subject != target) & _may_exceed(subject, target, threshold)
    similar = similar_udf(threshold)(F.when(open_pair, subject), F.when(open_pair, target))
    return tri_state(subject, target, (subject == target) | similar)
