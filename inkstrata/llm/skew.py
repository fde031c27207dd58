"""Joins to a table with one row a key, where some keys have very many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.llm.store import small

HOT = 500  # rows of a key that one task takes


def join_by_key(rows: DataFrame, per_key: DataFrame, keys: list[str], n: str, tie: Column, *, how: str = "inner", broadcast_rows: int = 1_000_000) -> DataFrame:
    """rows joined by keys to per_key, a written table with a row for each key, of narrow columns.

    Up to broadcast_rows it is broadcast. Beyond, both are shuffled, and a key with more than HOT rows, as column n of per_key says,
    is dealt over tasks by a hash of tie, with a copy of its row for each. n is not in the result."""
    if per_key.count() <= broadcast_rows:
        return rows.join(F.broadcast(per_key.drop(n)), keys, how)
    hot = small(per_key.filter(F.col(n) > HOT).select(*keys, F.ceil(F.col(n) / HOT).cast("int").alias("parts")), broadcast_rows)
    dealt = rows.join(hot, keys, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64(tie), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    copies = per_key.drop(n).join(hot, keys, "left").withColumn("salt", F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)"))).drop("parts")
    return dealt.join(copies, [*keys, "salt"], how).drop("salt")
