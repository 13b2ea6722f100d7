"""Join helpers: key conditions with explicit NULL semantics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def key_match(left: DataFrame, right: DataFrame, keys: Sequence[str],
              null_safe: bool = False) -> Column:
    """AND of ``left[k] = right[k]`` over ``keys``.

    With plain ``=`` a NULL key never matches anything (SQL semantics); with
    ``null_safe`` two NULLs match (``<=>``).
    """
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    return reduce(lambda acc, k: acc & eq(left[k], right[k]),
                  keys[1:], eq(left[keys[0]], right[keys[0]]))
