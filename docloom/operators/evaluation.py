"""Predictions against golden data: accuracy by field and document, error categories, ablation.

Both sides are long: ``doc_id, field_name, s, n, p, b`` (text, number,
presence, box).  A side without a field simply has no row or only nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import FIELDS, NUMERIC_FIELDS, VISUAL_FIELDS
from ..functions.fuzzy import fuzzy_score
from ..functions.geometry import iou
from ..functions.numeric import matches_exactly, within
from ..functions.text import jaccard, strip, tokens


def latest(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The last row per key, as when later entries overwrite earlier ones."""
    at = W.partitionBy(*keys).orderBy(F.desc(position))
    return rows.withColumn("_n", F.row_number().over(at)).filter("_n = 1").drop("_n")


def join_sides(predicted: DataFrame, golden: DataFrame, how: str = "inner") -> DataFrame:
    """Both values of every document and field that the predicted side holds; ``has_golden`` tells missing truth."""
    p = predicted.select("doc_id", "field_name", *(F.col(c).alias(f"p_{c}") for c in ("s", "n", "p", "b")), *(c for c in ("source", "confidence", "config", "conflict") if c in predicted.columns))
    g = golden.select("doc_id", "field_name", *(F.col(c).alias(f"g_{c}") for c in ("s", "n", "p", "b")), F.lit(True).alias("has_golden"))
    return p.join(g, ["doc_id", "field_name"], how)


def _kinds() -> tuple[Column, Column]:
    name = F.col("field_name")
    return name.isin(*NUMERIC_FIELDS), name.isin(*VISUAL_FIELDS)


def _null(side: str) -> Column:
    return F.coalesce(F.col(f"{side}_s"), F.col(f"{side}_n").cast("string"), F.col(f"{side}_p").cast("string")).isNull()


def correct(threshold: float | None = 0.5, form: str = "xywh") -> Column:
    """Tolerant correctness; with a threshold, boxes that both sides have must overlap.

    Two nulls are right, one is wrong.  Numbers may differ by less than 5 %,
    unreadable ones must be equal as text.
    """
    numeric, visual = _kinds()
    number = F.when(F.col("p_n").isNotNull() & F.col("g_n").isNotNull(), within(F.col("p_n"), F.col("g_n"))).otherwise(F.coalesce(F.col("p_s") == F.col("g_s"), F.lit(False)))
    same = F.col("p_p") == F.col("g_p")
    if threshold is not None:
        same = same & F.coalesce(~F.col("p_p") | ~has_boxes() | (box_iou(form) >= threshold), F.lit(True))
    text = F.lower(strip(F.col("p_s"))) == F.lower(strip(F.col("g_s")))
    value = F.when(numeric, number).when(visual, same).otherwise(text)
    return F.when(_null("p") & _null("g"), True).when(_null("p") | _null("g"), False).otherwise(F.coalesce(value, F.lit(False)))


def has_boxes() -> Column:
    return F.coalesce((F.size("p_b") > 0) & (F.size("g_b") > 0), F.lit(False))


def box_iou(form: str = "xywh") -> Column:
    return iou(F.col("p_b"), F.col("g_b"), form)


def evaluate_fields(joined: DataFrame, iou_threshold: float = 0.5, by: tuple[str, ...] = ()) -> DataFrame:
    """Per field (and ``by``): correct, total, accuracy, and mean IoU with its sample size."""
    shown = F.when(F.col("field_name").isin(*VISUAL_FIELDS) & F.col("p_p") & F.col("g_p") & has_boxes(), box_iou())
    rows = joined.withColumns({"correct": correct(iou_threshold), "iou": shown})
    return rows.groupBy(*by, "field_name").agg(
        F.count_if("correct").alias("correct"),
        F.count(F.lit(1)).alias("total"),
        (F.count_if("correct") / F.count(F.lit(1))).alias("accuracy"),
        F.count("iou").alias("iou_samples"),
        F.round(F.avg("iou"), 9).alias("mean_iou"),
    )


def evaluate_documents(joined: DataFrame, iou_threshold: float = 0.5, by: tuple[str, ...] = (), fields: int = len(FIELDS)) -> DataFrame:
    """Document-level accuracy (all fields right) per ``by``."""
    docs = joined.withColumn("correct", correct(iou_threshold)).groupBy(*by, "doc_id").agg((F.count_if("correct") >= fields).alias("right"))
    return docs.groupBy(*by).agg(F.count_if("right").alias("correct_documents"), F.count(F.lit(1)).alias("documents"), (F.count_if("right") / F.count(F.lit(1))).alias("accuracy"))


def skip_reason(documents: DataFrame, golden: DataFrame) -> DataFrame:
    """Why a golden document is not evaluated, null if it is.

    ``golden``: ``doc_id, error, has_fields``; ``documents`` the same of the
    predictions.  The first reason that holds counts.
    """
    p = documents.select("doc_id", F.col("error").alias("p_error"), F.col("has_fields").alias("p_fields"), F.lit(True).alias("p_there"))
    reason = (
        F.when(F.col("error").isNotNull(), "golden_error")
        .when(F.col("p_there").isNull(), "not_in_results")
        .when(F.col("p_error").isNotNull(), "prediction_error")
        .when(~F.col("has_fields") | ~F.col("p_fields"), "missing_fields")
    )
    return golden.join(p, "doc_id", "left").select("doc_id", reason.alias("skip_reason"))


def strict_scores(joined: DataFrame, fuzzy: float = 80.0, iou_threshold: float = 0.5, form: str = "xyxy") -> DataFrame:
    """Strict evaluator per field: ``correct, score`` (0 to 100).

    Dealers by similarity, models exactly but for case, numbers exactly, marks
    by presence and IoU (a missing box counts half).  A null on either side of
    a text or number is wrong; a null mark is an absent one.
    """
    distinct = joined.filter("field_name = 'dealer_name'").select(F.lower(strip(F.col("p_s"))).alias("_a"), F.lower(strip(F.col("g_s"))).alias("_b")).distinct()
    scored = distinct.withColumn("fuzzy", fuzzy_score(F.col("_a"), F.col("_b")))
    rows = joined.withColumns({"_p": F.lower(strip(F.col("p_s"))), "_g": F.lower(strip(F.col("g_s")))})
    rows = rows.join(scored, (F.col("field_name") == "dealer_name") & (F.col("_p") == F.col("_a")) & (F.col("_g") == F.col("_b")), "left")
    numeric, visual = _kinds()
    p, g = F.coalesce("p_p", F.lit(False)), F.coalesce("g_p", F.lit(False))
    overlap = box_iou(form)
    no_box = F.col("p_b").isNull() | F.col("g_b").isNull()
    mark = F.when(p != g, 0.0).when(~p, 1.0).when(no_box, 0.5).otherwise(overlap)
    mark_ok = F.when(p != g, False).when(~p | no_box, True).otherwise(overlap >= iou_threshold)
    dealer = F.coalesce("fuzzy", F.lit(0.0))
    exact = F.coalesce(F.when(numeric, matches_exactly(F.col("p_n"), F.col("g_n"))).otherwise(F.col("_p") == F.col("_g")), F.lit(False))
    is_dealer = F.col("field_name") == "dealer_name"
    ok = F.when(is_dealer, dealer >= fuzzy).when(visual, mark_ok).otherwise(exact)
    score = F.when(is_dealer, dealer).when(visual, mark * 100).otherwise(F.when(exact, 100.0).otherwise(0.0))
    return rows.withColumns({"correct": ok, "score": score}).drop("_p", "_g", "_a", "_b", "fuzzy")


def plain_similarity(a: Column, b: Column) -> Column:
    """Similarity without a fuzzy library: 100 if equal, 80 if one holds the other, else the share of common words."""
    x, y = F.lower(strip(a)), F.lower(strip(b))
    score = F.when(x == y, 100.0).when(x.contains(y) | y.contains(x), 80.0).otherwise(100 * jaccard(tokens(x), tokens(y)))
    return F.when(a.isNull() | b.isNull(), 0.0).otherwise(score)


def strict_summary(scored: DataFrame) -> DataFrame:
    """Correct, total and accuracy in percent per field and, as field ``overall``, of all."""
    out = scored.rollup("field_name").agg(F.count_if("correct").alias("correct"), F.count(F.lit(1)).alias("total"), F.grouping("field_name").alias("_all"))
    return out.select(F.when(F.col("_all") == 1, "overall").otherwise(F.col("field_name")).alias("field_name"), "correct", "total", (F.col("correct") * 100.0 / F.col("total")).alias("accuracy"))


def error_category() -> Column:
    """The class of a wrong value; the first rule that holds counts.

    Looks at ``source``, ``conflict``, ``confidence`` and ``note`` (null where unknown).
    """
    source, note = F.lower(F.coalesce("source", F.lit(""))), F.lower(F.coalesce("note", F.lit("")))
    return (
        F.when(_null("p"), "Missing_Value")
        .when(F.col("field_name") == "signature", F.when(F.contains(note, F.lit("handwriting")), "Handwriting_Noise").otherwise("OCR_Mismatch"))
        .when(F.col("field_name") == "stamp", F.when(F.contains(note, F.lit("overlap")), "Stamp_Overlap").otherwise("OCR_Mismatch"))
        .when(F.contains(source, F.lit("tier2")) & F.contains(source, F.lit("uncertain")), "SLM_Uncertain")
        .when(F.contains(source, F.lit("tier3")) | F.contains(source, F.lit("vlm")), "VLM_Error")
        .when(F.coalesce("conflict", F.lit(False)), "OCR_Mismatch")
        .when(F.coalesce("confidence", F.lit(1.0)) < 0.6, "Low_Confidence")
        .otherwise("Parse_Error")
    )


def errors(joined: DataFrame, note: Column | None = None) -> DataFrame:
    """Wrong fields with their category.  Presence alone decides marks here."""
    rows = joined.withColumn("note", F.lit(None).cast("string") if note is None else note)
    for c, kind in (("source", "string"), ("conflict", "boolean"), ("confidence", "double")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(kind))
    return rows.filter(~correct(None)).withColumn("category", error_category())


def diagnostics_accuracy(predicted: DataFrame, golden: DataFrame) -> DataFrame:
    """Document accuracy over all predicted documents; those without truth count as wrong."""
    joined = join_sides(predicted, golden, "left")
    docs = joined.groupBy("doc_id").agg(F.bool_and(F.coalesce("has_golden", F.lit(False)) & correct(None)).alias("right"))
    return docs.agg(F.count_if("right").alias("correct_documents"), F.count(F.lit(1)).alias("documents"), (F.count_if("right") / F.count(F.lit(1))).alias("accuracy"))


def ablation(configs: dict[str, DataFrame], golden: DataFrame, iou_threshold: float = 0.5) -> DataFrame:
    """Document accuracy per named configuration, in one grouped pass."""
    rows = None
    for name, df in configs.items():
        df = df.withColumn("config", F.lit(name))
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    return evaluate_documents(join_sides(rows, golden), iou_threshold, ("config",))


def exit_code(accuracy: float, strict: bool = False) -> int:
    """0 when the target is met; the strict evaluator knows a middle grade."""
    if strict:
        return 0 if accuracy >= 90 else 1 if accuracy >= 70 else 2
    return 0 if accuracy >= 0.95 else 1
