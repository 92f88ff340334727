"""The resolution ladder: rules first, then judges, then the better-looking value.

Judges are functions from a DataFrame with ``field_name, v1, v2, context`` to
the same rows with ``judgment`` (a struct of value, confidence and status).
The defaults need no model and are expressions, so all tiers are columns of one
pass.  A judge that runs a model must see open rows only, and a condition would
not keep a UDF from running on every row: with such a judge the rows are
persisted, those that earlier tiers left open are filtered out for it, and the
parts are unioned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NUMERIC_FIELDS, VISUAL_FIELDS, LadderConfig
from ..functions import responses, text
from ..sources.staging import staged
from .matching import prefilter_dealers

Judge = Callable[[DataFrame], DataFrame]


def _hit(value: Column, confidence: Column, method: str) -> Column:
    return F.struct(value.alias("value"), confidence.alias("confidence"), F.lit(method).alias("method"))


def tier1(field: Column, kind: Column, v1: Column, v2: Column, c1: Column, c2: Column, context: Column, c: LadderConfig = LadderConfig()) -> Column:
    """The rule's result as a struct, null where no rule decides.

    Numbers arrive as text.  With ``strict_compat`` their text form is that of
    a double ("450000.0"), which seldom occurs in a context; otherwise whole
    numbers lose the fraction first.
    """
    top = F.greatest(c1, c2)
    shown = (lambda v: v) if c.strict_compat else (lambda v: F.regexp_replace(v, r"\.0$", ""))
    plain = lambda v: text.normalize_number_text(shown(v))
    undone = lambda v: text.normalize_number_text(text.undo_misreadings(shown(v)))
    forms = F.struct(plain(v1).alias("a"), plain(v2).alias("b"), undone(v1).alias("a2"), undone(v2).alias("b2"))

    def number(x: Column) -> Column:
        in1, in2, said = F.contains(context, x["a"]), F.contains(context, x["b"]), context != ""
        return (
            F.when(x["a"] == x["b"], _hit(x["a"], top, "numeric_normalization"))
            .when(x["a2"] == x["b2"], _hit(x["a2"], top * 0.9, "ocr_correction"))
            .when(said & in1 & ~in2, _hit(v1, c1 * 0.95, "context_match"))
            .when(said & in2 & ~in1, _hit(v2, c2 * 0.95, "context_match"))
        )

    bare = lambda v: text.normalize_text(text.strip(F.lower(v)))
    longer = F.when(F.length(v1) >= F.length(v2), v1).otherwise(v2)
    longer_bare = F.when(F.length(text.strip(v1)) >= F.length(text.strip(v2)), v1).otherwise(v2)

    def words(x: Column) -> Column:
        return (
            F.when(x["x"] == x["y"], _hit(longer, top, "text_normalization"))
            .when(x["j"] >= c.jaccard, _hit(longer_bare, top * x["j"], "jaccard_similarity"))
            .when(F.contains(x["y"], x["x"]), _hit(v2, c2 * 0.95, "subset_match"))
            .when(F.contains(x["x"], x["y"]), _hit(v1, c1 * 0.95, "subset_match"))
        )

    compared = text.let(F.struct(bare(v1).alias("x"), bare(v2).alias("y")), lambda z: F.struct(z["x"].alias("x"), z["y"].alias("y"), text.jaccard(text.tokens(z["x"]), text.tokens(z["y"])).alias("j")))
    number, words = text.let(forms, number), text.let(compared, words)
    one = F.when(v1.isNull() & v2.isNotNull(), _hit(v2, c2 * 0.8, "prefer_non_null")).when(v2.isNull() & v1.isNotNull(), _hit(v1, c1 * 0.8, "prefer_non_null"))
    return F.coalesce(one, F.when(v1.isNotNull() & v2.isNotNull(), F.when(kind == "numeric", number).when(kind == "textual", words)))


def slm_fallback(rows: DataFrame) -> DataFrame:
    """The judge without a model: the number that the context holds, else the much longer value.

    Nulls read as the word None, as a formatted prompt shows them.
    """
    v1, v2 = F.coalesce("v1", F.lit("None")), F.coalesce("v2", F.lit("None"))
    first = lambda v: F.regexp_extract(F.replace(v, F.lit(","), F.lit("")), r"[\d,]+\.?\d*", 0).try_cast("double")
    whole = lambda v: first(v).cast("long").cast("string")
    in1, in2 = F.contains("context", whole(v1)), F.contains("context", whole(v2))
    number = F.col("field_name").isin(*NUMERIC_FIELDS) & (F.col("context") != "") & whole(v1).isNotNull() & whole(v2).isNotNull()
    long1, long2 = F.length(v1) > F.length(v2) * 1.5, F.length(v2) > F.length(v1) * 1.5
    value = F.when(number & in1 & ~in2, v1).when(number & in2 & ~in1, v2).when(long1, v1).when(long2, v2)
    sure = F.coalesce(number & (in1 != in2), F.lit(False))
    confidence = F.when(sure, 0.7).when(long1 | long2, 0.6).otherwise(0.0)
    return rows.withColumn("judgment", responses.judgment(value, confidence, F.when(value.isNotNull(), "RESOLVED").otherwise("UNCERTAIN")))


def vlm_unavailable(rows: DataFrame) -> DataFrame:
    """The vision judge without a model: never certain."""
    return rows.withColumn("judgment", responses.judgment(F.lit(None).cast("string"), F.lit(0.0), F.lit("UNCERTAIN")))


def _judged(rows: DataFrame, open_: Column, judge: Judge, native: Judge, name: str) -> DataFrame:
    """``rows`` with the judge's verdict on open rows in column ``name``."""
    if judge is native:
        found = judge(rows).withColumnRenamed("judgment", name)
        return found.withColumn(name, F.when(open_, F.col(name)))
    # written once: a judge's model must not run again for a lost executor or a second reader
    rows = staged(rows.withColumn("_open", open_), "judge")
    seen = staged(judge(rows.filter("_open").drop("_open")).withColumnRenamed("judgment", name), "judged")
    rest = rows.filter(~F.col("_open")).drop("_open")
    return seen.unionByName(rest, allowMissingColumns=True)


def _outcome(*tiers: tuple[Column, Column, Column, Column, Column]) -> Column:
    """The first tier whose condition holds, as a struct; tiers are (condition, value, confidence, source, cost)."""
    out = None
    for condition, value, confidence, source, cost in tiers:
        row = F.struct(value.cast("string").alias("value"), confidence.cast("double").alias("confidence"), source.alias("source"), cost.cast("double").alias("cost"))
        condition = F.coalesce(condition, F.lit(False))
        out = F.when(condition, row) if out is None else out.when(condition, row)
    return out


def _value(i: str) -> Column:
    """A pair's or consensus' value as text."""
    return (
        F.when(F.col("field_name").isin(*NUMERIC_FIELDS), F.coalesce(F.col(f"n{i}").cast("string"), F.col(f"s{i}")))
        .when(F.col("field_name").isin(*VISUAL_FIELDS), F.col(f"p{i}").cast("string"))
        .otherwise(F.col(f"s{i}"))
    )


def pipeline_ladder(agreed: DataFrame, contexts: DataFrame, c: LadderConfig = LadderConfig(), slm: Judge = slm_fallback, vlm: Judge = vlm_unavailable, dealers=None) -> DataFrame:
    """Field-level escalation over consensus rows: ``doc_id, field_name, value, confidence, source, cost``.

    ``contexts`` holds ``doc_id, context`` (the engines' texts).  Agreement,
    dealer lock, rules (``tier1`` or surer), the text judge (``slm`` or surer),
    in full mode the vision judge, and last the better-looking value at half
    its confidence.
    """
    kwargs = {} if dealers is None else {"names": dealers}
    visual = F.col("field_name").isin(*VISUAL_FIELDS)
    rows = agreed.withColumns({"v1": _value("1"), "v2": _value("2"), "value0": _value("")})
    # only conflicts need the context and the dealer list
    clash = F.coalesce("conflict", F.lit(False))
    texts = contexts.select(F.col("doc_id").alias("_doc"), F.substring("context", 1, 3000).alias("context"))
    rows = rows.join(texts, clash & (F.col("doc_id") == F.col("_doc")), "left").withColumn("context", F.coalesce("context", F.lit(""))).drop("_doc")
    dealer = clash & (F.col("field_name") == "dealer_name")
    rows = rows.withColumns({"_d1": F.when(dealer, F.col("v1")), "_d2": F.when(dealer, F.col("v2"))})
    rows = prefilter_dealers(rows, "_d1", "_d2", threshold=c.prefilter, **kwargs)
    rule = tier1(F.col("field_name"), F.col("conflict_type"), F.col("v1"), F.col("v2"), F.col("c1"), F.col("c2"), F.substring("context", 1, 500), c)
    rows = rows.withColumn("rule", F.when(clash & F.col("locked").isNull(), rule))
    ruled = F.coalesce(F.col("rule.confidence") >= c.tier1, F.lit(False))
    open_ = clash & F.col("locked").isNull() & ~ruled
    # the text judge reads half of the context
    rows = rows.withColumn("_all", F.col("context")).withColumn("context", F.substring("context", 1, 1500))
    rows = _judged(rows, open_ & ~visual, slm, slm_fallback, "slm").withColumn("context", F.col("_all"))
    judged = F.coalesce((F.col("slm.status") == "RESOLVED") & (F.col("slm.confidence") >= c.slm), F.lit(False))
    seen, spent = F.lit(False), 0.001
    if c.mode == "full":
        rows = _judged(rows, open_ & ~judged, vlm, vlm_unavailable, "vlm")
        seen, spent = F.coalesce(F.col("vlm.status") == "RESOLVED", F.lit(False)), 0.021
    else:
        rows = rows.withColumn("vlm", F.lit(None).cast("struct<value:string,confidence:double,status:string>"))
    first = text.quality_pipeline(F.col("v1"), F.col("c1")) >= text.quality_pipeline(F.col("v2"), F.col("c2"))
    better, its = F.when(first, F.col("v1")).otherwise(F.col("v2")), F.when(first, F.col("c1")).otherwise(F.col("c2"))
    out = _outcome(
        (~clash, F.col("value0"), F.col("confidence"), F.lit("tier1_consensus"), F.lit(0.0)),
        (F.col("locked").isNotNull(), F.col("locked"), F.col("locked_confidence"), F.lit("tier1_fuzzy_match"), F.lit(0.0)),
        (ruled, F.col("rule.value"), F.col("rule.confidence"), F.concat(F.lit("tier1_"), F.col("rule.method")), F.lit(0.0)),
        (judged, F.col("slm.value"), F.col("slm.confidence"), F.lit("tier2_slm"), F.lit(0.001)),
        (seen, F.col("vlm.value"), F.col("vlm.confidence"), F.lit("tier3_vlm"), F.lit(0.021)),
        (F.lit(True), better, its * c.fallback, F.lit("tier_fallback"), F.lit(spent)),
    )
    return rows.select("doc_id", "field_name", out.alias("_o")).select("doc_id", "field_name", "_o.*")


def library_ladder(conflicts: DataFrame, c: LadderConfig = LadderConfig(), slm: Judge = slm_fallback, vlm: Judge = vlm_unavailable) -> DataFrame:
    """Adjudicates conflicts ``doc_id, field_name, conflict_type, v1, v2, c1, c2, context`` (``has_image`` optional).

    Any rule result counts; then the text judge, then, where it was uncertain
    and there is an image, the vision judge; then the better-looking value.
    Result: ``doc_id, field_name, value, confidence, source, tier, cost``.
    """
    image = F.col("has_image") if "has_image" in conflicts.columns else F.lit(False)
    rule = tier1(F.col("field_name"), F.col("conflict_type"), F.col("v1"), F.col("v2"), F.col("c1"), F.col("c2"), F.col("context"), c)
    rows = conflicts.withColumns({"_image": image, "rule": rule})
    ruled = F.col("rule").isNotNull()
    rows = _judged(rows, ~ruled, slm, slm_fallback, "slm")
    judged = F.coalesce(F.col("slm.status") == "RESOLVED", F.lit(False))
    last, spent, seen = 2, 0.001, F.lit(False)
    if c.mode == "full":
        rows = _judged(rows, ~ruled & ~judged & F.coalesce(F.col("slm.status") == "UNCERTAIN", F.lit(False)) & F.col("_image"), vlm, vlm_unavailable, "vlm")
        last, spent, seen = 3, 0.021, F.coalesce(F.col("vlm.status") == "RESOLVED", F.lit(False))
    else:
        rows = rows.withColumn("vlm", F.lit(None).cast("struct<value:string,confidence:double,status:string>"))
    q1, q2 = (text.quality_ladder(F.col(f"v{i}"), F.col(f"c{i}"), F.col("field_name")) for i in (1, 2))
    rows = rows.withColumns({"_q1": q1, "_q2": q2})
    out = _outcome(
        (ruled, F.col("rule.value"), F.col("rule.confidence"), F.col("rule.method"), F.lit(0.0)),
        (judged, F.col("slm.value"), F.col("slm.confidence"), F.lit("slm_judge"), F.lit(0.001)),
        (seen, F.col("vlm.value"), F.col("vlm.confidence"), F.lit("vlm_judge"), F.lit(0.021)),
        (F.lit(True), F.when(F.col("_q1") >= F.col("_q2"), F.col("v1")).otherwise(F.col("v2")), F.greatest("_q1", "_q2") * c.fallback, F.lit("quality_fallback"), F.lit(spent)),
    )
    tier = F.when(ruled, 1).when(judged, 2).when(seen, 3).otherwise(last)
    return rows.select("doc_id", "field_name", out.alias("_o"), tier.alias("tier")).select("doc_id", "field_name", "_o.*", "tier")


def mark_resolved(agreed: DataFrame, resolved: DataFrame) -> DataFrame:
    """Consensus rows with the adjudicated value, confidence and method where there is one."""
    got = resolved.select("doc_id", "field_name", F.col("value").alias("resolved_value"), F.col("confidence").alias("resolved_confidence"), F.col("source").alias("method"))
    out = agreed.join(got, ["doc_id", "field_name"], "left")
    return out.withColumn("conflict_resolved", F.coalesce(F.col("conflict") & F.col("method").isNotNull(), F.lit(False)))


def document_confidence(fields: DataFrame, how: str = "min", column: str = "confidence") -> DataFrame:
    """Per document the least confidence, or with ``geomean`` the geometric mean; 0 without fields."""
    value = F.exp(F.avg(F.log(F.col(column) + 1e-10))) if how == "geomean" else F.min(column)
    return fields.groupBy("doc_id").agg(F.coalesce(value, F.lit(0.0)).alias("document_confidence"))


def layout_hint(name: Column) -> Column:
    """Where a field usually stands on an invoice."""
    hints = {
        "dealer_name": "the seller's own name heads the sheet, often in the largest letters",
        "model_name": "the line of the table that says what was bought",
        "horse_power": "a small number beside the tractor's model, with its unit",
        "asset_cost": "the last and largest sum of the table",
        "signature": "handwriting in the lower third, usually over a ruled line",
        "stamp": "a coloured ring or frame that may lie over other text",
    }
    found = F.create_map(*(F.lit(x) for kv in hints.items() for x in kv))
    return F.coalesce(F.try_element_at(found, name), F.lit(""))


def verification_prompt(name: Column, v1: Column, v2: Column) -> Column:
    """The question put to a vision judge; empty values show as NOT_FOUND."""
    shown = lambda v: F.coalesce(F.nullif(v, F.lit("")), F.lit("NOT_FOUND"))
    return F.format_string("Which value of %s does the document show?\nA: %s\nB: %s\nAnswer with CHOICE: A, B or NEITHER and REASON: one line.\nThe field is usually at: %s", name, shown(v1), shown(v2), layout_hint(name))


