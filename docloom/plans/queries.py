"""Registered queries: one or more per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NUMERIC_FIELDS, LadderConfig
from ..functions import geometry, numeric, responses, text
from ..operators import calibration, consensus, cost, detection, evaluation, ladder, matching, reports, results, sampling
from ..sources import readers, synthetic
from . import tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)



# ---- text -------------------------------------------------------------------


@query
def native_digits(spark, sf_dir):
    return tables.invoices(spark, sf_dir).select("doc_id", text.native_digits(F.col("deepseek")).alias("text"))


def _money(spark, sf_dir):
    p, k = F.col("price").cast("string"), F.col("k") % 6
    shown = F.when(k == 0, F.concat(F.lit("₹ "), p)).when(k == 1, F.concat(F.lit("Rs. "), p)).when(k == 2, F.concat(F.lit("$"), p)).when(k == 3, F.concat(p, F.lit("/-"))).when(k == 4, F.concat(F.lit("INR "), p)).otherwise(F.concat(p, F.lit(" rupees")))
    return tables.invoices(spark, sf_dir).select("doc_id", shown.alias("raw"))


@query
def strip_currency(spark, sf_dir):
    return _money(spark, sf_dir).select("doc_id", text.strip_currency(F.col("raw")).alias("text"))


@query
def strip_suffix(spark, sf_dir):
    k = F.col("k") % 4
    tail = F.when(k == 0, " Pvt. Ltd.").when(k == 1, " & Co.").when(k == 2, " Enterprises LLP").otherwise(" and Sons Limited")
    return tables.invoices(spark, sf_dir).select("doc_id", text.strip_suffixes(F.concat("dealer", tail)).alias("text"))


def _amount(spark, sf_dir):
    return tables.invoices(spark, sf_dir).select("doc_id", F.regexp_extract(F.coalesce("deepseek", F.lit("")), "Total: (.*)", 1).alias("raw"))


@query
def normalize_numeric(spark, sf_dir):
    n = text.numeric(F.col("raw"))
    return _amount(spark, sf_dir).select("doc_id", n["value"].alias("value"), n["confidence"].alias("confidence"))


@query
def parse_model(spark, sf_dir):
    raw = F.when(F.col("k") % 3 == 0, F.concat("model", F.lit(" DI"))).when(F.col("k") % 3 == 1, F.concat("model", F.lit(": "), F.col("hp").cast("string"), F.lit(" HP"))).otherwise(F.concat(F.lit("Tractor "), F.col("hp").cast("string"), F.lit("HP")))
    m = text.model_name(F.col("raw"))
    return tables.invoices(spark, sf_dir).select("doc_id", raw.alias("raw")).select("doc_id", m["value"].alias("value"), m["confidence"].alias("confidence"))


@query
def parse_hp(spark, sf_dir):
    k, h = F.col("k") % 4, F.col("hp").cast("string")
    raw = F.when(k == 0, F.concat(h, F.lit(" HP"))).when(k == 1, F.concat(h, F.lit("-"), (F.col("hp") + 10).cast("string"), F.lit(" BHP"))).when(k == 2, h).otherwise(F.concat(F.lit("power "), h, F.lit(" H.P.")))
    v = text.horse_power(F.col("raw"))
    return tables.invoices(spark, sf_dir).select("doc_id", raw.alias("raw")).select("doc_id", v["value"].alias("value"), v["confidence"].alias("confidence"))


@query
def parse_cost(spark, sf_dir):
    v = text.asset_cost(F.col("raw"))
    return _amount(spark, sf_dir).select("doc_id", v["value"].alias("value"), v["confidence"].alias("confidence"))


@query
def extract_fields(spark, sf_dir):
    return tables.extracted(tables.readings(tables.invoices(spark, sf_dir))).select("doc_id", "engine", "field_name", "s", "n", "confidence")


def _sellers(spark, sf_dir):
    i = tables.invoices(spark, sf_dir)
    return i.select("doc_id", F.col("dealer").alias("a"), text.dealer_text(F.col("deepseek")).alias("b"))


@query
def token_overlap(spark, sf_dir):
    return _sellers(spark, sf_dir).select("doc_id", text.token_overlap(F.col("a"), F.col("b")).alias("overlap"))


@query
def char_agree(spark, sf_dir):
    return _sellers(spark, sf_dir).select("doc_id", text.texts_agree(F.col("a"), F.col("b")).alias("agree"))


@query
def fuzzy_score(spark, sf_dir):
    return matching.score_pairs(_sellers(spark, sf_dir), "a", "b").select("doc_id", "fuzzy", "overlap")


@query
def token_sort(spark, sf_dir):
    from ..functions.fuzzy import token_sort_ratio

    pairs = _sellers(spark, sf_dir).select("a", "b").distinct().filter("a is not null and b is not null")
    return pairs.select("a", "b", token_sort_ratio("a", "b").alias("score"))


@query
def dealer_match(spark, sf_dir):
    return matching.match_dealers(_sellers(spark, sf_dir), "b").select("doc_id", "value", "confidence", "matched", "score")


@query
def dealer_prefilter(spark, sf_dir):
    return matching.prefilter_dealers(_sellers(spark, sf_dir), "b", "a").select("doc_id", "locked", "locked_confidence")


@query
def clean_grounded(spark, sf_dir):
    head = F.when(F.col("k") % 2 == 0, "=====\nBASE: torch.Size([1, 256])\nPATCHES: 4\n").otherwise("image size: 3\n")
    raw = F.concat(head, F.lit("<|ref|>"), "dealer", F.lit("</ref><|det|>[[1, 2,3,4]]</det>\n\n  <|grounding|>"), "model", F.lit("  \n\t\nsize"))
    return tables.invoices(spark, sf_dir).select("doc_id", text.clean_grounded(raw).alias("text"))


@query
def normalize_text(spark, sf_dir):
    d = tables.read(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(text.normalize_text(F.regexp_replace("text", r"[^\x00-\x7F]", ""))).alias("digest"))


@query
def number_text(spark, sf_dir):
    return _amount(spark, sf_dir).select("doc_id", text.normalize_number_text(F.col("raw")).alias("plain"), text.normalize_number_text(text.undo_misreadings(F.col("raw"))).alias("undone"))


@query
def quality_pipeline(spark, sf_dir):
    c = tables.read(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", text.quality_pipeline(F.col("text"), F.lit(0.8)).alias("score"))


@query
def quality_ladder(spark, sf_dir):
    rows = tables.extracted(tables.readings(tables.invoices(spark, sf_dir)))
    v = F.coalesce(F.col("n").cast("string"), F.col("s"))
    return rows.select("doc_id", "engine", "field_name", text.quality_ladder(v, F.col("confidence"), F.col("field_name")).alias("score"))


# ---- numbers and boxes --------------------------------------------------------


@query
def numeric_diff(spark, sf_dir):
    li = tables.read(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", numeric.relative_diff(F.col("l_extendedprice"), F.col("l_quantity") * 1000).alias("diff"))


def _box_pairs(spark, sf_dir):
    d = tables.detections(tables.invoices(spark, sf_dir))
    a = d.filter("det_no = 0").select("doc_id", "class_name", F.col("bbox").alias("p"))
    b = d.filter("det_no = 1").select("doc_id", "class_name", F.transform("bbox", lambda x, i: F.when(i < 2, (x / 40).cast("int")).otherwise(x)).alias("q"))
    return a.withColumn("p", F.transform("p", lambda x, i: F.when(i < 2, (x / 40).cast("int")).otherwise(x))).join(b, ["doc_id", "class_name"])


@query
def iou_xywh(spark, sf_dir):
    return _box_pairs(spark, sf_dir).select("doc_id", "class_name", geometry.iou(F.col("p"), F.col("q")).alias("iou"))


@query
def iou_xyxy(spark, sf_dir):
    return _box_pairs(spark, sf_dir).select("doc_id", "class_name", geometry.iou(geometry.to_xyxy(F.col("p")), geometry.to_xyxy(F.col("q")), "xyxy").alias("iou"))


@query
def poly_to_box(spark, sf_dir):
    x, y = F.col("doc_id") % 700 + 0.75, F.col("doc_id") % 900 + 0.25
    polygon = F.array(F.array(x, y), F.array(x + 50.5, y + 1), F.array(x + 49, y + 20.9), F.array(x - 1, y + 19))
    box = geometry.polygon_to_xywh(F.col("polygon"))
    return tables.invoices(spark, sf_dir).select("doc_id", polygon.alias("polygon")).select("doc_id", *(box[i].alias(n) for i, n in enumerate("xywh")))


# ---- lines and marks ----------------------------------------------------------


def _lines(spark, sf_dir):
    return tables.lines(tables.readings(tables.invoices(spark, sf_dir)))


@query
def full_text(spark, sf_dir):
    return readers.full_text(_lines(spark, sf_dir))


@query
def merge_lines(spark, sf_dir):
    return matching.merge_lines(_lines(spark, sf_dir))


@query
def words_in_box(spark, sf_dir):
    found = tables.detections(tables.invoices(spark, sf_dir))
    return detection.words_in_boxes(found, _lines(spark, sf_dir)).select("doc_id", "class_name", "det_no", "words")


@query
def best_detection(spark, sf_dir):
    return results.best_detection(tables.detections(tables.invoices(spark, sf_dir))).select("doc_id", "field_name", "det_no", "confidence")


@query
def suppressed(spark, sf_dir):
    d = tables.detections(tables.invoices(spark, sf_dir))
    near = d.withColumn("bbox", F.transform("bbox", lambda x, i: F.when(i < 2, (x / 40).cast("int")).otherwise(x)))
    return detection.suppress(near.select("doc_id", "class_name", "det_no", "bbox", "confidence"), confidence=0.6).select("doc_id", "class_name", "det_no")


@query
def detection_counts(spark, sf_dir):
    found = tables.detections(tables.invoices(spark, sf_dir))
    return detection.counts(detection.verify(found.withColumn("words", F.lit(0).cast("long"))))


@query
def invocations(spark, sf_dir):
    i = tables.invoices(spark, sf_dir)
    found = detection.counts(tables.detections(i).withColumn("verified", F.col("confidence") >= 0.7))
    calls = cost.invocations(readers.full_text(tables.lines(tables.readings(i))).select("doc_id", "engine", "lines", "avg_confidence"), found, _ladder(spark, sf_dir, "full"))
    return calls.groupBy("component").agg(F.count(F.lit(1)).alias("calls"), F.count_distinct("doc_id").alias("documents"))


@query
def verify_detection(spark, sf_dir):
    found = tables.detections(tables.invoices(spark, sf_dir))
    return detection.verify(detection.words_in_boxes(found, _lines(spark, sf_dir))).select("doc_id", "class_name", "det_no", "verified", "reason")


@query
def contours(spark, sf_dir):
    found = tables.detections(tables.invoices(spark, sf_dir))
    w, h = F.col("bbox")[2], F.col("bbox")[3]
    rows = found.select("doc_id", "class_name", F.col("det_no").alias("contour_no"), (w * h).alias("area"), w.alias("width"), h.alias("height"), F.lit(800 * 1100).alias("image_area"))
    return detection.filter_contours(rows).select("doc_id", "class_name", "contour_no")


# ---- consensus and ladder -----------------------------------------------------


@query
def conflicts(spark, sf_dir):
    return tables.detected(spark, sf_dir).select("doc_id", "field_name", "conflict", "conflict_type", "metric")


@query
def consensus_fields(spark, sf_dir):
    return tables.agreed(spark, sf_dir).select("doc_id", "field_name", "s", "n", "p", "confidence", "source", "resolution")


_QUERIES["consensus"] = _QUERIES.pop("consensus_fields")


def _conflicting(spark, sf_dir):
    rows = tables.detected(spark, sf_dir).filter("conflict")
    rows = rows.withColumns({"v1": ladder._value("1"), "v2": ladder._value("2")})
    return rows.join(tables.contexts(spark, sf_dir), "doc_id").select("doc_id", "field_name", "conflict_type", "v1", "v2", "c1", "c2", "context")


@query
def tier1(spark, sf_dir):
    rows = _conflicting(spark, sf_dir)
    rule = ladder.tier1(*(F.col(c) for c in ("field_name", "conflict_type", "v1", "v2", "c1", "c2")), F.substring("context", 1, 500))
    return rows.select("doc_id", "field_name", rule["value"].alias("value"), rule["confidence"].alias("confidence"), rule["method"].alias("method"))


@query
def slm_fallback(spark, sf_dir):
    rows = ladder.slm_fallback(_conflicting(spark, sf_dir).withColumn("context", F.substring("context", 1, 1500)))
    return rows.select("doc_id", "field_name", "judgment.value", "judgment.confidence", "judgment.status")


def _answers(spark, sf_dir):
    i = tables.invoices(spark, sf_dir).filter("dealer is not null")
    k = F.col("k") % 6
    answer = (
        F.when(k == 0, F.concat(F.lit('Sure: ```json\n{"answer": "'), "dealer", F.lit('", "confidence": 0.9}\n```')))
        .when(k == 1, F.concat(F.lit('{"answer": "'), "model", F.lit('", "confidence": "0.75",}')))
        .when(k == 2, F.lit('{"answer": "UNCERTAIN", "confidence": 0.2}'))
        .when(k == 3, F.concat(F.lit("I think it is "), "dealer"))
        .when(k == 4, F.concat(F.lit('{"answer": "'), "dealer", F.lit('", "confidence": 3}')))
        .otherwise(F.lit("no idea"))
    )
    return i.select("doc_id", "k", answer.alias("answer"), F.col("dealer").alias("v1"), F.col("model").alias("v2"))


@query
def slm_parse(spark, sf_dir):
    j = responses.slm(F.col("answer"), F.col("v1"), F.col("v2"))
    return _answers(spark, sf_dir).select("doc_id", j.alias("j")).select("doc_id", "j.value", "j.confidence", "j.status")


@query
def vlm_choice(spark, sf_dir):
    k = F.col("k") % 5
    said = F.when(k == 0, "Choice: A\nREASON: sharp").when(k == 1, "CHOICE: B").when(k == 2, "CHOICE: NEITHER").when(k == 3, F.concat(F.lit("the text says "), "v2")).otherwise("cannot tell")
    j = responses.vlm_choice(F.col("answer"), F.col("v1"), F.col("v2"))
    return _answers(spark, sf_dir).withColumn("answer", said).select("doc_id", j.alias("j")).select("doc_id", "j.value", "j.confidence", "j.status")


def _shown(rows: DataFrame, *more: str) -> DataFrame:
    """Ladder results with numbers as numbers."""
    number = F.col("field_name").isin(*NUMERIC_FIELDS)
    return rows.select("doc_id", "field_name", F.when(~number, F.col("value")).alias("s"), F.when(number, F.col("value").try_cast("double")).alias("n"), "confidence", "source", *more)


def _ladder(spark, sf_dir, mode):
    return ladder.pipeline_ladder(tables.agreed(spark, sf_dir), tables.contexts(spark, sf_dir), LadderConfig(mode=mode))


@query
def ladder_full(spark, sf_dir):
    return _shown(_ladder(spark, sf_dir, "full"), "cost")


@query
def ladder_cpu_lite(spark, sf_dir):
    return _shown(_ladder(spark, sf_dir, "cpu-lite"), "cost")


@query
def ladder_library(spark, sf_dir):
    return _shown(ladder.library_ladder(_conflicting(spark, sf_dir)), "tier", "cost")


@query
def doc_confidence_min(spark, sf_dir):
    return ladder.document_confidence(tables.agreed(spark, sf_dir))


@query
def doc_confidence_geomean(spark, sf_dir):
    return ladder.document_confidence(tables.agreed(spark, sf_dir), "geomean").select("doc_id", F.round("document_confidence", 6).alias("document_confidence"))


@query
def source_stats(spark, sf_dir):
    return results.source_statistics(_ladder(spark, sf_dir, "full"))


@query
def result_documents(spark, sf_dir):
    fields = _ladder(spark, sf_dir, "full")
    costs = fields.groupBy("doc_id").agg(F.sum(F.col("cost").cast("decimal(10,4)")).alias("cost"), F.sum(F.lit(1.0)).alias("latency"))
    out = results.documents(fields, ladder.document_confidence(fields), costs)
    return out.select("doc_id", F.size("fields").alias("n_fields"), F.element_at("field_sources", "dealer_name").alias("dealer_source"), "confidence", F.col("cost_estimate_usd").cast("double").alias("cost"))


# ---- cost ---------------------------------------------------------------------


def _log(spark, sf_dir):
    return cost.price(tables.cost_log(spark, sf_dir))


@query
def cost_by_doc(spark, sf_dir):
    return cost.by_document(_log(spark, sf_dir)).select("doc_id", F.col("cost").cast("double").alias("cost"), F.col("latency").cast("double").alias("latency"), "calls")


@query
def cost_breakdown(spark, sf_dir):
    return cost.breakdown(_log(spark, sf_dir), "doc_id").select("doc_id", "component", F.col("cost").cast("double").alias("cost"), F.col("latency").cast("double").alias("latency"), "calls")


@query
def cost_summary(spark, sf_dir):
    return cost.summary(_log(spark, sf_dir)).withColumns({c: F.col(c).cast("double") for c in ("total_cost", "total_latency")})


@query
def cost_windows(spark, sf_dir):
    from ..streaming.costs import rolling

    return rolling(tables.cost_log(spark, sf_dir), "1 day").select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("cost").cast("double").alias("cost"), "calls", "vlm_calls")


@query
def log_metadata(spark, sf_dir):
    got = F.from_json("props", "k int")["k"]
    return tables.cost_log(spark, sf_dir).select("call_id", F.coalesce(got, F.lit(0)).alias("k"))


# ---- evaluation ---------------------------------------------------------------


def _joined(spark, sf_dir):
    return evaluation.join_sides(tables.predictions(spark, sf_dir), tables.golden(spark, sf_dir))


@query
def eval_fields(spark, sf_dir):
    return evaluation.evaluate_fields(_joined(spark, sf_dir)).withColumn("mean_iou", F.round("mean_iou", 6))


@query
def eval_docs(spark, sf_dir):
    return evaluation.evaluate_documents(_joined(spark, sf_dir))


@query
def eval_strict(spark, sf_dir):
    return evaluation.strict_scores(_joined(spark, sf_dir), form="xywh").select("doc_id", "field_name", "correct", "score")


@query
def eval_overall(spark, sf_dir):
    return evaluation.strict_summary(evaluation.strict_scores(_joined(spark, sf_dir), form="xywh"))


@query
def eval_skips(spark, sf_dir):
    o = tables.read(spark, sf_dir, "orders")
    d = F.col("doc_id")
    g = o.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("doc_id")).select("doc_id", F.when(d % 5 == 0, "failed").alias("error"), (d % 11 != 0).alias("has_fields"))
    p = o.filter("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("doc_id")).select("doc_id", F.when(d % 13 == 0, "failed").alias("error"), (d % 17 != 0).alias("has_fields"))
    return evaluation.skip_reason(p, g)


@query
def diagnostics_accuracy(spark, sf_dir):
    return evaluation.diagnostics_accuracy(tables.predictions(spark, sf_dir), tables.golden(spark, sf_dir))


@query
def error_breakdown(spark, sf_dir):
    return evaluation.errors(_joined(spark, sf_dir)).groupBy("category").agg(F.count(F.lit(1)).alias("errors"))


@query
def error_by_field(spark, sf_dir):
    return evaluation.errors(_joined(spark, sf_dir)).groupBy("field_name", "category").agg(F.count(F.lit(1)).alias("errors"))


@query
def ablation(spark, sf_dir):
    configs = {"consensus": tables.predictions(spark, sf_dir), "paddle_only": tables.predictions(spark, sf_dir, "paddle"), "deepseek_only": tables.predictions(spark, sf_dir, "deepseek")}
    return evaluation.ablation({k: v.select("doc_id", "field_name", "s", "n", "p", "b") for k, v in configs.items()}, tables.golden(spark, sf_dir))


@query
def error_report(spark, sf_dir):
    return reports.first_errors(_joined(spark, sf_dir)).select("doc_id", "field", "category", "confidence")


@query
def report_values(spark, sf_dir):
    rows = reports.field_details(_joined(spark, sf_dir).filter(~F.col("field_name").isin("signature", "stamp")))
    return rows.select("doc_id", "field_name", "correct", "predicted", "ground_truth").withColumns({c: F.coalesce(F.col(c).try_cast("double").cast("decimal(18,3)").cast("string"), F.col(c)) for c in ("predicted", "ground_truth")})


@query
def plain_similarity(spark, sf_dir):
    return _sellers(spark, sf_dir).select("doc_id", F.round(evaluation.plain_similarity(F.col("a"), F.col("b")), 9).alias("score"))


@query
def simple_documents(spark, sf_dir):
    fields = _ladder(spark, sf_dir, "full")
    costs = fields.groupBy("doc_id").agg(F.sum(F.col("cost").cast("decimal(10,4)")).alias("cost"), F.sum(F.lit(0.25)).alias("latency"))
    out = reports.simple_documents(results.documents(fields, ladder.document_confidence(fields), costs))
    return out.select("doc_id", F.col("processing_time_sec").cast("double").alias("processing_time_sec"), F.col("cost_estimate_usd").cast("double").alias("cost_estimate_usd"))


@query
def outcomes(spark, sf_dir):
    known = tables.agreed(spark, sf_dir).filter("s is not null or n is not null").select("doc_id", "field_name", F.coalesce("s", F.col("n").cast("string")).alias("value"), "confidence", "source")
    return reports.outcomes(reports.detailed_documents(known, tables.invoices(spark, sf_dir).select("doc_id")))


# ---- calibration and sampling -------------------------------------------------


@query
def calibration_bins(spark, sf_dir):
    return calibration.fit_bins(tables.scored_labels(spark, sf_dir))


@query
def calibration_apply(spark, sf_dir):
    samples = tables.scored_labels(spark, sf_dir)
    out = calibration.apply_bins(samples, calibration.fit_bins(samples))
    return out.groupBy("field_name", "confidence").agg(F.min("calibrated").alias("calibrated"), F.count(F.lit(1)).alias("samples"))


@query
def isotonic(spark, sf_dir):
    samples = tables.scored_labels(spark, sf_dir)
    return calibration.apply_isotonic(samples, calibration.fit_isotonic(samples)).groupBy("field_name", "confidence").agg(F.min("calibrated").alias("calibrated"))


@query
def calibration_samples(spark, sf_dir):
    rows = calibration.samples(tables.predictions(spark, sf_dir), tables.golden(spark, sf_dir))
    return rows.groupBy("field_name").agg(F.count(F.lit(1)).alias("samples"), F.count_if("correct").alias("right"))


@query
def calibrated_fields(spark, sf_dir):
    fields = tables.agreed(spark, sf_dir).select("doc_id", "field_name", "confidence")
    knots = spark.createDataFrame([("horse_power", 0.5, 0.4), ("horse_power", 1.0, 0.9), ("asset_cost", 0.25, 0.0), ("asset_cost", 0.75, 1.0)], "field_name string, x double, y double")
    return calibration.calibrate_fields(fields, knots).select("doc_id", "field_name", F.round("calibrated_confidence", 9).alias("calibrated_confidence"))


@query
def ece(spark, sf_dir):
    return calibration.calibration_error(tables.scored_labels(spark, sf_dir)).withColumn("ece", F.round("ece", 9))


@query
def al_lowconf(spark, sf_dir):
    return sampling.least_sure(tables.result_rows(spark, sf_dir))


@query
def al_borderline(spark, sf_dir):
    return sampling.borderline(tables.result_rows(spark, sf_dir))


@query
def al_sample(spark, sf_dir):
    return sampling.active_sample(tables.result_rows(spark, sf_dir)).select("doc_id", "reason", "rank")


@query
def unannotated(spark, sf_dir):
    return sampling.unannotated(tables.result_rows(spark, sf_dir), tables.golden(spark, sf_dir)).select("doc_id")


@query
def annotation_progress(spark, sf_dir):
    return sampling.progress(tables.golden(spark, sf_dir))


# ---- synthetic pages ----------------------------------------------------------


@query
def synthetic_docs(spark, sf_dir):
    ids = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    rows = synthetic.marks(ids)
    return rows.select("doc_id", "class_name", "present", *(F.col("bbox")[i].alias(n) for i, n in enumerate("xywh")))


@query
def mock_invoices(spark, sf_dir):
    ids = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return readers.mock_invoice(spark, ids)


@query
def image_metrics(spark, sf_dir):
    """Metrics of drawn marks, for every supplier."""
    ids = tables.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc_id"))
    marks = synthetic.draw_marks(synthetic.marks(ids))
    return detection.image_metrics(marks.select(F.concat_ws(":", "doc_id", "class_name").alias("doc_id"), "content"))


