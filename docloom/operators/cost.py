"""Cost and latency over an append-only log of component calls.

Log: ``doc_id, component, latency, ts`` (and ``cost``, see ``price``).  Runs:
``doc_id, start_ts, end_ts``, one row per processing of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CostConfig

MONEY, SECONDS = "decimal(10,4)", "decimal(18,6)"


def price(log: DataFrame, c: CostConfig = CostConfig()) -> DataFrame:
    """The log with each call's ``cost``; components without a price are free."""
    cost = F.lit(0.0)
    for component, value in c.prices.items():
        cost = F.when(F.col("component") == component, value).otherwise(cost)
    return log.withColumn("cost", cost.cast(MONEY))


def invocations(answers: DataFrame, found: DataFrame, final: DataFrame) -> DataFrame:
    """The component calls that processing documents made, with what the log says of each.

    ``answers``: a reader's lines and mean confidence per document (``doc_id,
    engine, lines, avg_confidence``); ``found``: detections per document and class;
    ``final``: fields with the ``cost`` that the ladder states for them.
    """
    note = lambda *cols: F.to_json(F.struct(*cols))
    read = answers.select("doc_id", F.concat("engine", F.lit("_ocr")).alias("component"), F.lit(None).cast("string").alias("field_name"), note(F.col("lines").alias("word_count"), "avg_confidence").alias("metadata"))
    marked = found.select("doc_id", F.concat(F.lit("yolo_"), "class_name").alias("component"), F.col("class_name").alias("field_name"), note("detections", "verified").alias("metadata"))
    # the ladder's cost states which judges a field went through
    fees = F.bround(F.col("cost") * 1000).cast("int")
    tiers = F.concat(
        F.when((F.coalesce("source", F.lit("")).startswith("tier1") & (F.col("source") != "tier1_consensus")) | (fees > 0), F.array(F.lit("tier1_rules"))).otherwise(F.array().cast("array<string>")),
        F.when(fees % 20 != 0, F.array(F.lit("tier2_slm"))).otherwise(F.array().cast("array<string>")),
        F.when(fees >= 20, F.array(F.lit("tier3_vlm"))).otherwise(F.array().cast("array<string>")),
    )
    judged = final.select("doc_id", F.explode(tiers).alias("component"), "field_name", F.lit("{}").alias("metadata"))
    return read.unionByName(marked).unionByName(judged)


def of_document(log: DataFrame, doc_id) -> DataFrame:
    """The calls and cost of one document."""
    return log.filter(F.col("doc_id") == F.lit(doc_id))


def by_document(log: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """``doc_id, cost, latency, calls``; latency is the run's elapsed time where known, else the calls' sum."""
    out = log.groupBy("doc_id").agg(F.sum("cost").alias("cost"), F.sum(F.col("latency").cast(SECONDS)).alias("latency"), F.count(F.lit(1)).alias("calls"))
    if runs is not None:
        last = runs.groupBy("doc_id").agg(F.max_by(F.struct("start_ts", "end_ts"), "start_ts").alias("r"))
        elapsed = (F.unix_micros(F.col("r.end_ts").cast("timestamp")) - F.unix_micros(F.col("r.start_ts").cast("timestamp"))) / 1e6
        out = out.join(last, "doc_id", "left").withColumn("latency", F.coalesce(elapsed.cast(SECONDS), F.col("latency"))).drop("r")
    return out


def breakdown(log: DataFrame, *by: str) -> DataFrame:
    """Cost, latency and calls per component (and ``by``)."""
    return log.groupBy(*by, "component").agg(F.sum("cost").alias("cost"), F.sum(F.col("latency").cast(SECONDS)).alias("latency"), F.count(F.lit(1)).alias("calls"))


def summary(log: DataFrame, runs: int | None = None, c: CostConfig = CostConfig()) -> DataFrame:
    """One row: totals, averages per document, the vision-judge rate and whether the targets are met.

    The rate is calls over runs (documents if ``runs`` is not given); it may exceed one.
    """
    docs = by_document(log)
    total = docs.agg(F.count(F.lit(1)).alias("documents"), F.sum("cost").alias("total_cost"), F.sum("latency").alias("total_latency"))
    vlm = log.agg(F.count_if(F.col("component") == "tier3_vlm").alias("vlm_calls"))
    base = F.lit(runs) if runs is not None else F.col("documents")
    out = total.crossJoin(vlm)  # one row each
    rate = F.coalesce(F.try_divide(F.col("vlm_calls"), base), F.lit(0.0))
    cost, latency = F.try_divide(F.col("total_cost").cast("double"), F.col("documents")), F.try_divide(F.col("total_latency").cast("double"), F.col("documents"))
    return out.select(
        "documents", "total_cost", "total_latency", "vlm_calls",
        cost.alias("average_cost"), latency.alias("average_latency"), rate.alias("vlm_rate"),
        (cost < c.max_cost).alias("cost_ok"), (latency < c.max_latency).alias("latency_ok"), (rate < c.max_vlm_rate).alias("vlm_ok"),
    )
