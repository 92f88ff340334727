"""Result records: source names, simple values, documents and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import VISUAL_FIELDS

# Source labels by reader kind.
SOURCES = {
    "ocr": ("tier1", "tier1_rules", "tier1_dealer_match", "tier1_hp_pattern", "tier1_confidence", "consensus", "paddle", "deepseek", "quality_fallback", "confidence_fallback"),
    "slm": ("tier2", "tier2_slm", "slm_judge", "slm_document_extraction", "tier2_slm_document_extraction"),
    "vlm": ("tier3", "tier3_vlm", "vlm_judge", "vlm_document_extraction", "tier3_vlm_document_extraction"),
}


def normal_source(source: Column, strict: bool = True) -> Column:
    """The reader kind of a source label: by list, else itself in lower case; a part "slm" or "vlm" decides.

    Otherwise than strictly, every ``tier1_`` label is the plain readers'.
    """
    low = F.lower(source)
    known = low
    for kind, labels in SOURCES.items():
        known = F.when(low.isin(*labels), kind).otherwise(known)
    if not strict:
        known = F.when(low.startswith("tier1_"), "ocr").otherwise(known)
    return F.when(F.contains(low, F.lit("slm")), "slm").when(F.contains(low, F.lit("vlm")), "vlm").otherwise(known)


def source_statistics(fields: DataFrame, strict: bool = True) -> DataFrame:
    """Fields per reader kind; other labels are not counted."""
    kind = normal_source(F.col("source"), strict)
    return fields.select(kind.alias("k")).agg(*(F.count_if(F.col("k") == k).alias(f"{k}_fields") for k in SOURCES))


def simple_value() -> Column:
    """A field's value for a report, as text; marks as presence and box."""
    mark = F.to_json(F.struct(F.coalesce("p", F.lit(False)).alias("present"), F.col("b").alias("bbox")))
    return F.when(F.col("field_name").isin(*VISUAL_FIELDS), mark).otherwise(F.coalesce(F.col("s"), F.col("n").cast("string")))


def visual_defaults(docs: DataFrame, detections: DataFrame) -> DataFrame:
    """Best verified detection per document and mark, or its absence at confidence 0.7."""
    best = best_detection(detections.filter("verified"))
    grid = docs.select("doc_id").distinct().withColumn("field_name", F.explode(F.array(*(F.lit(f) for f in VISUAL_FIELDS))))
    out = grid.join(best, ["doc_id", "field_name"], "left")
    return out.select("doc_id", "field_name", F.col("bbox").isNotNull().alias("p"), F.col("bbox").alias("b"), F.coalesce("confidence", F.lit(0.7)).alias("confidence"))


def best_detection(detections: DataFrame) -> DataFrame:
    """The surest detection per document and class, the first one if equal."""
    best = F.max_by(F.struct("bbox", "confidence", "det_no"), F.struct("confidence", F.negative(F.col("det_no"))))
    return detections.groupBy("doc_id", F.col("class_name").alias("field_name")).agg(best.alias("d")).select("doc_id", "field_name", F.col("d.bbox").alias("bbox"), F.col("d.confidence").alias("confidence"), F.col("d.det_no").alias("det_no"))


def documents(fields: DataFrame, confidence: DataFrame, costs: DataFrame) -> DataFrame:
    """One record per document: fields and sources as maps, and rounded confidence, time and cost."""
    packed = fields.groupBy("doc_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field_name", "value")))).alias("fields"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("field_name"), normal_source(F.col("source")).alias("source"))))).alias("field_sources"),
    )
    out = packed.join(confidence, "doc_id", "left").join(costs.select("doc_id", "cost", "latency"), "doc_id", "left")
    return out.select(
        "doc_id", "fields", "field_sources",
        F.round("document_confidence", 4).alias("confidence"),
        F.round("latency", 3).alias("processing_time_sec"),
        F.round("cost", 6).alias("cost_estimate_usd"),
    )


def audit_log(lines: DataFrame, agreed: DataFrame, final: DataFrame) -> DataFrame:
    """What happened to every document as ``doc_id, stage, field_name, message``."""
    read = lines.groupBy("doc_id", "engine").agg(F.count(F.lit(1)).alias("k")).select("doc_id", F.lit("OCR_EXTRACTION").alias("stage"), F.lit(None).cast("string").alias("field_name"), F.format_string("%s read %d lines", "engine", "k").alias("message"))
    checked = agreed.select("doc_id", F.lit("CONSENSUS_CHECK").alias("stage"), "field_name", F.when(F.col("conflict"), F.concat(F.lit("conflict: "), F.coalesce("conflict_type", F.lit("unknown")))).otherwise("agreement").alias("message"))
    ended = final.select("doc_id", F.lit("FINAL_RESULT").alias("stage"), "field_name", F.format_string("%s by %s at %.2f", F.coalesce("value", F.lit("None")), "source", "confidence").alias("message"))
    return read.unionByName(checked).unionByName(ended)
