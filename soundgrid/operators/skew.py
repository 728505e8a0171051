"""Joins on keys of which a few may hold much of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_by_key(rows: DataFrame, facts: DataFrame, key: str, total: int, share: int = 1000) -> DataFrame:
    """Join ``rows`` on ``key`` with ``facts``: one row a key, whose ``n`` is the number of ``rows`` that have the key. ``n`` stays.

    A key with over a ``share``-th of all ``total`` rows is hot. There are fewer than ``share`` such keys, which bounds what the driver sees and
    what is broadcast; rows of hot keys stay where they are, and only the others are dealt by the key, so no task gets a hot key's rows. ``facts``
    and, with hot keys, ``rows`` are read twice. Null keys match nothing.
    """
    hot = [r[0] for r in facts.filter(F.col("n") * share > total).select(key).collect()]
    if not hot:
        return rows.join(facts, key)
    few = F.col(key).isin(hot)
    return rows.filter(few).join(F.broadcast(facts.filter(few)), key).unionByName(rows.filter(~few).join(facts.filter(~few), key))
