"""Dimension lookups (J1-J8): semi and anti joins without hints.

Dimensions grow with the data, so nothing here forces a broadcast or probes
sizes with extra jobs. The planner picks a broadcast from estimated sizes,
adaptive execution from measured ones; otherwise both sides are shuffled on
the key and a skewed partition (one store holding a third of the sales) is
split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def key_set(dim: DataFrame, keys: Sequence[str], distinct: bool = True) -> DataFrame:
    keys_df = dim.select(*keys)
    return keys_df.distinct() if distinct else keys_df


def semi_join(facts: DataFrame, dim: DataFrame, keys: Sequence[str], distinct: bool = True) -> DataFrame:
    """Facts whose key exists in the dimension (J1-J3). ``distinct`` is
    redundant for a semi join; pass False when keys are already unique."""
    return facts.join(key_set(dim, keys, distinct), list(keys), "left_semi")


def orphans(facts: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts whose key is missing from the dimension (J8, anti join)."""
    return facts.join(key_set(dim, keys, distinct=False), list(keys), "left_anti")
