"""Connected components by alternating large and small stars, each written to the shared folder: attach() names its rows three
times, so a round in one query would have nine plans of what it reads, which the driver holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, partitions, release


def attach(rows: DataFrame, key: str, spread: str, **aggregates: tuple[Column, str]) -> DataFrame:
    """rows with aggregates over each key, a pair each of what to aggregate and the name of a function that aggregates
    its own results too (min, max, sum, bit_xor).

    No task gets a hot key's rows together: they are dealt by the column `spread` over as many shares as there are
    partitions, shares are aggregated, and each share gets its key's result before its rows do.
    """
    n = partitions(rows.sparkSession)
    dealt = rows.withColumn("share_", F.pmod(F.xxhash64(spread), F.lit(n)).cast("int"))
    shares = dealt.groupBy(key, "share_").agg(*(F.call_function(how, what).alias(name) for name, (what, how) in aggregates.items()))
    whole = shares.groupBy(key).agg(*(F.call_function(how, F.col(name)).alias(name) for name, (_, how) in aggregates.items()))
    return dealt.join(shares.select(key, "share_").join(whole, key), [key, "share_"]).drop("share_")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node of edges (a, b); a component is named by its least node. Loops and repeats are harmless."""
    now = Scratch(edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    least = (F.col("v"), "min")
    for _ in range(rounds):
        e = now.read()
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = Scratch(attach(both, "u", "v", m=least).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large")
        small = attach(large.read(), "u", "v", m=least)
        after = Scratch(small.select("v", "m").union(small.select("u", "m")).toDF("u", "v").filter("u <> v").distinct(), "edges")
        done = after.read().exceptAll(e).limit(1).count() == 0
        now.drop()
        large.drop()
        del e, both, large, small
        now = after
        release(edges.sparkSession)  # the driver's heap stays near what it needs
        if done:
            e = now.read()
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError("components don't settle")
