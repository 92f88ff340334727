"""Rolling costs over the invocation log, and documents as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CostConfig
from ..operators import cost


def arriving(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_trigger).load(path)


def first_arrival(docs: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Each document once, within the time that late repeats are waited for."""
    return docs.withWatermark(ts, late).dropDuplicatesWithinWatermark(["doc_id"])


def rolling(log: DataFrame, width: str = "1 hour", late: str = "10 minutes", c: CostConfig = CostConfig(), slide: str | None = None) -> DataFrame:
    """Cost, calls and vision-judge rate per time window; works on batches and streams alike."""
    rows = cost.price(log, c).withWatermark("ts", late)
    at = F.window("ts", width, slide) if slide else F.window("ts", width)
    out = rows.groupBy(at).agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("calls"), F.count_if(F.col("component") == "tier3_vlm").alias("vlm_calls"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "cost", "calls", "vlm_calls", (F.col("vlm_calls") / F.col("calls")).alias("vlm_share"))


def sessions(log: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", c: CostConfig = CostConfig()) -> DataFrame:
    """Cost and calls per document and burst of activity."""
    rows = cost.price(log, c).withWatermark("ts", late)
    out = rows.groupBy("doc_id", F.session_window("ts", gap).alias("w")).agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("calls"))
    return out.select("doc_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "cost", "calls")
