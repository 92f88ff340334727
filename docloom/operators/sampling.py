"""Which results a person should look at next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def unannotated(results: DataFrame, golden: DataFrame) -> DataFrame:
    """Results without golden data."""
    return results.join(golden.select("doc_id").distinct(), "doc_id", "left_anti")


def least_sure(results: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` results of least confidence (a missing one is 0), earlier ones first if equal."""
    return results.orderBy(F.coalesce("confidence", F.lit(0.0)), "pos").limit(k)


def borderline(results: DataFrame, k: int = 10, low: float = 0.6, high: float = 0.95) -> DataFrame:
    """The first ``k`` results of middling confidence, both bounds included."""
    return results.filter(F.col("confidence").between(low, high)).orderBy("pos").limit(k)


def random_rest(results: DataFrame, taken: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """``k`` other results in the order of a seeded hash."""
    rest = results.join(taken.select("doc_id"), "doc_id", "left_anti")
    return rest.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), "pos").limit(k)


def active_sample(results: DataFrame, n: int = 30, k: int = 10, seed: int = 42) -> DataFrame:
    """Least sure, then borderline, then random results; each once, in that order, ``n`` at most.

    Every branch is bounded by its limit, so the window sees ``3 k`` rows.
    """
    low, mid = least_sure(results, k), borderline(results, k)
    rest = random_rest(results, low.select("doc_id").unionByName(mid.select("doc_id")), k, seed)
    by_conf = W.orderBy(F.coalesce("confidence", F.lit(0.0)), "pos")
    parts = [
        low.withColumn("rank", F.row_number().over(by_conf)).withColumn("reason", F.lit("low_confidence")).withColumn("part", F.lit(0)),
        mid.withColumn("rank", F.row_number().over(W.orderBy("pos"))).withColumn("reason", F.lit("borderline")).withColumn("part", F.lit(1)),
        rest.withColumn("rank", F.row_number().over(W.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), "pos"))).withColumn("reason", F.lit("random")).withColumn("part", F.lit(2)),
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    first = every.withColumn("_n", F.row_number().over(W.partitionBy("doc_id").orderBy("part", "rank"))).filter("_n = 1")
    return first.orderBy("part", "rank").limit(n).drop("_n")


def progress(golden: DataFrame, goal: int = 50) -> DataFrame:
    """Annotated documents, and their share of the goal (1 at most)."""
    n = F.count_distinct("doc_id")
    return golden.agg(n.alias("annotated"), F.least(n / goal, F.lit(1.0)).alias("progress"), (n >= goal).alias("enough"))
