"""Projections of results, and the reports on cost, evaluation, errors and calibration.

A report is one JSON text; what it lists is bounded (per field, component or
class, or the first errors), except the documents of a cost report, which
``writers.single`` refuses beyond its bound.
"""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import VISUAL_FIELDS, CostConfig
from . import calibration, cost, evaluation

MOST_ERRORS, MOST_SKIPPED, SHOWN = 100, 10, 100


def simple_documents(documents: DataFrame) -> DataFrame:
    """Confidence, time and cost as short records state them; ties round to the even digit."""
    return documents.withColumns(
        {
            "confidence": F.bround("confidence", 2),
            "processing_time_sec": F.bround("processing_time_sec", 1),
            "cost_estimate_usd": F.bround("cost_estimate_usd", 4),
        }
    )


def detailed_documents(fields: DataFrame, totals: DataFrame) -> DataFrame:
    """Documents with every field's record in a map, and what ``totals`` knows of them by ``doc_id``.

    A document without fields has none, confidence 0 and counts as failed.
    """
    record = F.struct(*(c for c in ("field_name", "value", "confidence", "calibrated_confidence", "source", "bbox") if c in fields.columns))
    packed = fields.groupBy("doc_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field_name", record.alias("record"))))).alias("fields"),
        F.min("confidence").alias("document_confidence"),
    )
    out = totals.join(packed, "doc_id", "left")
    return out.withColumns({"document_confidence": F.coalesce("document_confidence", F.lit(0.0)), "success": F.col("fields").isNotNull()})


def outcomes(documents: DataFrame) -> DataFrame:
    """How many documents have fields and how many failed."""
    return documents.agg(F.count(F.lit(1)).alias("documents"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"))


def shown(value: Column, missing: Column | None = None) -> Column:
    """The first 100 characters of a value's text; an empty value or zero is ``missing`` (null)."""
    text = value.cast("string")
    empty = text.isNull() | (text == "") | F.coalesce(text.try_cast("double") == 0, F.lit(False)) | (text == "false")
    return F.when(~empty, F.substring(text, 1, SHOWN)).otherwise(F.lit(None).cast("string") if missing is None else missing)


def side(name: str) -> Column:
    """The predicted (``p``) or golden (``g``) value of a joined row as text."""
    mark = F.to_json(F.struct(F.col(f"{name}_p").alias("present"), F.col(f"{name}_b").alias("bbox")))
    return F.when(F.col("field_name").isin(*VISUAL_FIELDS) & F.col(f"{name}_p").isNotNull(), mark).otherwise(F.coalesce(F.col(f"{name}_s"), F.col(f"{name}_n").cast("string")))


def first_errors(joined: DataFrame, most: int = MOST_ERRORS) -> DataFrame:
    """The first wrong fields in order of document and field, with values cut for a report."""
    rows = evaluation.errors(joined)
    cut = lambda s: F.substring(F.coalesce(side(s), F.lit("None")), 1, SHOWN)
    return rows.select("doc_id", F.col("field_name").alias("field"), "category", cut("p").alias("predicted"), cut("g").alias("ground_truth"), "confidence").orderBy("doc_id", "field").limit(most)


def field_details(joined: DataFrame, iou_threshold: float = 0.5) -> DataFrame:
    """Every field's verdict with values cut for a report."""
    return joined.select("doc_id", "field_name", evaluation.correct(iou_threshold).alias("correct"), shown(side("p")).alias("predicted"), shown(side("g")).alias("ground_truth"))


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _rows(df: DataFrame) -> list[dict]:
    return [{k: _plain(v) for k, v in r.asDict(recursive=True).items()} for r in df.collect()]


def text(report: dict) -> str:
    return json.dumps(report, indent=2, default=str, ensure_ascii=False)


def cost_metrics(summary: dict) -> dict:
    """What an error report says about cost."""
    return {"cost_per_document": summary["average_cost"], "vlm_invocation_rate": summary["vlm_rate"], "within_budget": summary["cost_ok"]}


def cost_report(log: DataFrame, runs: DataFrame | None = None, most: int = 100_000, c: CostConfig = CostConfig()) -> dict:
    """Totals of a priced log, and each document's cost with its components."""
    per = cost.breakdown(log, "doc_id").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("component", "cost", "latency", "calls"))).alias("components"))
    docs = _rows(cost.by_document(log, runs).join(per, "doc_id").orderBy("doc_id").limit(most + 1))
    if len(docs) > most:
        raise ValueError(f"more than {most} documents: write cost.by_document with json_lines")
    for d in docs:
        d["components"] = [{k: _plain(v) for k, v in x.items()} for x in d["components"]]
    return {"summary": _rows(cost.summary(log, c=c))[0], "documents": docs}


def evaluation_report(joined: DataFrame, iou_threshold: float = 0.5) -> dict:
    """Document and field accuracy."""
    return {
        "documents": _rows(evaluation.evaluate_documents(joined, iou_threshold))[0],
        "fields": _rows(evaluation.evaluate_fields(joined, iou_threshold).orderBy("field_name")),
    }


def strict_report(joined: DataFrame, skipped: DataFrame | None = None, fuzzy: float = 80.0, iou_threshold: float = 0.5) -> dict:
    """Accuracy in percent per field and overall, and the first skipped documents with their reasons."""
    out = {"accuracy": _rows(evaluation.strict_summary(evaluation.strict_scores(joined, fuzzy, iou_threshold)).orderBy("field_name"))}
    if skipped is not None:
        left = skipped.filter("skip_reason is not null")
        out |= {"skipped": left.count(), "first_skipped": _rows(left.orderBy("doc_id").limit(MOST_SKIPPED))}
    return out


def diagnostics_report(predicted: DataFrame, golden: DataFrame, log: DataFrame | None = None) -> dict:
    """Accuracy, errors by class and field, the first errors, and cost if a priced log is given."""
    joined = evaluation.join_sides(predicted, golden)
    wrong = evaluation.errors(joined)
    fields = joined.groupBy("field_name").agg((F.count_if(evaluation.correct(None)) / F.count(F.lit(1))).alias("accuracy"))
    out = {
        "accuracy": _rows(evaluation.diagnostics_accuracy(predicted, golden))[0],
        "field_accuracy": _rows(fields.orderBy("field_name")),
        "error_breakdown": _rows(wrong.groupBy("category").agg(F.count(F.lit(1)).alias("errors")).orderBy("category")),
        "field_error_breakdown": _rows(wrong.groupBy("field_name", "category").agg(F.count(F.lit(1)).alias("errors")).orderBy("field_name", "category")),
        "errors": _rows(first_errors(joined)),
    }
    return out if log is None else out | {"cost_metrics": cost_metrics(_rows(cost.summary(log))[0])}


def calibration_report(samples: DataFrame) -> list[dict]:
    """Per field with enough samples: their number, accuracy and calibration error."""
    return _rows(calibration.calibration_error(samples).filter(F.col("samples") >= calibration.LEAST_SAMPLES).orderBy("field_name"))
