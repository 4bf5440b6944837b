"""Joining many fact rows with a table that has one row per key.

The lookup side is measured before it is broadcast. Past the limit the join is
shuffled, and keys holding a large share of the fact rows are joined apart so
that no reduce task receives a hot key.
"""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textweft.scratch import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_BYTES = 1024 * 1024  # hot rows are broadcast in parts of this size at least
HOT_SHARE = 20_000  # a key is hot when it holds more than 1/HOT_SHARE of the facts


def row_bytes(df: DataFrame) -> Column:
    """An estimate of the bytes one row takes in memory."""
    total = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + 8 + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            total = total + 8 + 8 * F.greatest(F.size(field.name), F.lit(0))
        else:
            total = total + 8
    return total


def measured_bytes(df: DataFrame) -> int:
    return int(df.agg(F.sum(row_bytes(df).cast("long"))).first()[0] or 0)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "inner",
    weight: str | None = None,
    limit: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """``facts.join(table, key, how)`` for ``how`` in inner, left, left_semi, left_anti.

    ``weight`` names the column of ``table`` holding how often a key occurs in the
    facts. At most ``HOT_SHARE`` keys can hold more than ``1/HOT_SHARE`` of the
    total each; their rows are measured too and broadcast in as many parts as their size
    asks for. Rows without a key never reach a shuffle. ``small`` hands on the outcome of
    an earlier measurement.
    """
    if fits_broadcast(table, limit) if small is None else small:
        return facts.join(F.broadcast(table), key, how)
    if weight is None or how == "left_anti":
        return facts.join(table, key, how)
    total = table.agg(F.sum(weight).alias("_total")).first()["_total"] or 0
    is_hot = F.col(weight) * HOT_SHARE > F.lit(total)
    hot, cold = table.filter(is_hot), table.filter(~is_hot)
    hot = materialize(hot, "hot-keys")
    most = max(BROADCAST_BYTES if limit is None else limit, HOT_BYTES)
    parts = max(1, math.ceil(measured_bytes(hot) / most))
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    kind = "left_semi" if how == "left_semi" else "inner"
    hot_rows = reduce(
        DataFrame.unionByName, [facts.join(F.broadcast(hot.filter(part == i)), key, kind) for i in range(parts)]
    )
    keyed = facts.filter(F.col(key).isNotNull())
    other_rows = keyed.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    joined = hot_rows.unionByName(other_rows)
    if how == "left":
        joined = joined.unionByName(facts.filter(F.col(key).isNull()), allowMissingColumns=True)
    return joined


def attach(facts: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``facts.join(table, key)`` where ``facts`` may be small, or hold some keys many times.

    Facts that fit a broadcast travel to the table, which then is not shuffled. Beyond that only the
    table's rows that are asked for are joined, with hot keys apart.
    """
    facts = materialize(facts, "facts")
    if fits_broadcast(facts):
        return table.join(F.broadcast(facts), key)
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_facts"))
    asked = materialize(table.join(counts, key), "asked-rows")
    return lookup_join(facts, asked, key, weight="_facts").drop("_facts")
