"""Confidence calibration: binned and isotonic maps, expected calibration error.

Samples are ``field_name, confidence, correct``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FIELDS
from ..sources import readers, writers
from . import evaluation

LEAST_SAMPLES = 10


def _bin(n: int):
    """The equal-width bin of a confidence, the last one closed."""
    return F.least(F.floor(F.col("confidence") * n), F.lit(n - 1)).cast("int")


def samples(predicted: DataFrame, golden: DataFrame) -> DataFrame:
    """Every predicted field with a confidence whose truth is known, and whether it is right."""
    rows = evaluation.join_sides(predicted, golden).filter("confidence is not null")
    return rows.select("field_name", "confidence", evaluation.correct(None).alias("correct"))


def train(predicted: DataFrame, golden: DataFrame, fields: tuple[str, ...] = FIELDS, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Knots per field and the metrics of its samples; the knots are saved if a path is given."""
    own = samples(predicted, golden).filter(F.col("field_name").isin(*fields))
    knots = fit_isotonic(own)
    if path is not None:
        writers.calibrator(knots, path)
        knots = readers.calibrator(own.sparkSession, path)
    return knots, calibration_error(own).filter(F.col("samples") >= LEAST_SAMPLES)


def calibrate_fields(fields: DataFrame, knots: DataFrame | None) -> DataFrame:
    """Final fields with ``calibrated_confidence``: the map of their field, or the confidence without one."""
    if knots is None:
        return fields.withColumn("calibrated_confidence", F.col("confidence"))
    return apply_isotonic(fields, knots).withColumnRenamed("calibrated", "calibrated_confidence")


def at_points(knots: DataFrame, points: int = 11) -> DataFrame:
    """The maps at evenly spaced confidences, as a calibrator file states them."""
    grid = knots.select("field_name").distinct().withColumn("confidence", F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: i / F.lit(points - 1))))
    return apply_isotonic(grid, knots).select("field_name", F.col("confidence").alias("x"), F.col("calibrated").alias("y"))


def fit_bins(samples: DataFrame, n: int = 10, least: int = LEAST_SAMPLES) -> DataFrame:
    """``field_name, bin, samples, value``: the share that was right per bin, an empty bin's centre.

    Fields with fewer than ``least`` samples are left out.
    """
    counted = samples.groupBy("field_name", _bin(n).alias("bin")).agg(F.count(F.lit(1)).alias("samples"), F.count_if("correct").alias("right"))
    fields = samples.groupBy("field_name").agg(F.count(F.lit(1)).alias("all")).filter(F.col("all") >= least).select("field_name")
    grid = fields.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    value = F.coalesce(F.col("right") / F.col("samples"), (F.col("bin") + 0.5) / n)
    return grid.join(counted, ["field_name", "bin"], "left").select("field_name", "bin", F.coalesce("samples", F.lit(0).cast("long")).alias("samples"), value.alias("value"))


def fit_isotonic(samples: DataFrame, least: int = LEAST_SAMPLES) -> DataFrame:
    """Knots ``field_name, x, y`` of the increasing least-squares fit per field, clipped to 0 and 1.

    Equal confidences are averaged by a grouped sum first, so what meets in a
    field's group are its distinct confidences (rounded to 9 places).
    """
    import pandas as pd

    def pool(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("x")
        blocks: list[list[float]] = []
        for x, n, right in zip(own["x"], own["n"], own["right"], strict=True):
            blocks.append([right / n, n, 1])
            while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
                v, w, k = blocks.pop()
                blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + v * w) / (blocks[-1][1] + w), blocks[-1][1] + w, blocks[-1][2] + k]
        y = [min(1.0, max(0.0, v)) for v, _, k in blocks for _ in range(k)]
        return pd.DataFrame({"field_name": own["field_name"].iloc[0], "x": own["x"], "y": y})

    enough = samples.groupBy("field_name").agg(F.count(F.lit(1)).alias("all")).filter(F.col("all") >= least).select("field_name")
    tied = samples.groupBy("field_name", F.round("confidence", 9).alias("x")).agg(F.count(F.lit(1)).alias("n"), F.count_if("correct").alias("right"))
    return tied.join(enough, "field_name").groupBy("field_name").applyInPandas(pool, "field_name string, x double, y double")


def apply_isotonic(rows: DataFrame, knots: DataFrame) -> DataFrame:
    """``rows`` with ``calibrated``: linear between knots, flat outside, unchanged for fields without knots.

    A field's knots travel as one sorted array (distinct confidences only).
    """
    packed = knots.groupBy("field_name").agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("_k"))
    c, k = F.col("confidence"), F.col("_k")
    below = F.filter(k, lambda z: z["x"] <= c)
    above = F.filter(k, lambda z: z["x"] >= c)
    lo, hi = F.get(below, F.size(below) - 1), F.get(above, F.lit(0))
    line = lo["y"] + (hi["y"] - lo["y"]) * F.try_divide(c - lo["x"], hi["x"] - lo["x"])
    value = F.when(k.isNull(), c).when(lo.isNull(), hi["y"]).when(hi.isNull(), lo["y"]).when(hi["x"] == lo["x"], lo["y"]).otherwise(line)
    return rows.join(packed, "field_name", "left").withColumn("calibrated", value).drop("_k")


def apply_bins(rows: DataFrame, bins: DataFrame, n: int = 10) -> DataFrame:
    """``rows`` with ``calibrated``: the bin's value, unchanged for fields without bins."""
    table = bins.select("field_name", F.col("bin").alias("_bin"), F.col("value").alias("_v"))
    out = rows.withColumn("_bin", _bin(n)).join(table, ["field_name", "_bin"], "left")
    return out.withColumn("calibrated", F.coalesce("_v", "confidence")).drop("_bin", "_v")


def calibration_error(samples: DataFrame, n: int = 10, strict: bool = True) -> DataFrame:
    """``field_name, samples, accuracy, ece``: the bins' gaps between accuracy and confidence, by their share.

    With ``strict`` a confidence of exactly 1 is in no bin (but counts as a sample).
    """
    binned = samples.withColumn("bin", F.floor(F.col("confidence") * n) if strict else _bin(n))
    one = F.col("confidence").cast("decimal(18,9)")
    per = binned.groupBy("field_name", "bin").agg(F.count(F.lit(1)).alias("k"), F.count_if("correct").alias("right"), F.sum(one).alias("total"))
    inside = (F.col("bin") >= 0) & (F.col("bin") < n)
    gap = F.when(inside, F.abs(F.col("right") - F.col("total")).cast("decimal(28,9)")).otherwise(F.lit(0).cast("decimal(28,9)"))
    out = per.groupBy("field_name").agg(F.sum("k").alias("samples"), F.sum("right").alias("right"), F.sum(gap).alias("gap"))
    return out.select("field_name", "samples", (F.col("right") / F.col("samples")).alias("accuracy"), (F.col("gap").cast("double") / F.col("samples")).alias("ece"))
