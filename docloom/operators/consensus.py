"""Conflicts between two engines' values, and their weighted consensus.

Pairs are one row per document and field: ``doc_id, field_name, s1, n1, p1,
b1, c1, has1`` and the same for the second engine (``s`` text, ``n`` number,
``p`` presence and ``b`` box of a visual mark, ``c`` confidence, ``has``
whether the engine reported the field at all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ENGINES, NUMERIC_FIELDS, VISUAL_FIELDS, ConflictConfig, ConsensusConfig
from ..functions.geometry import iou
from ..functions.numeric import relative_diff
from ..functions.text import strip
from .matching import score_pairs

VALUE = ("s", "n", "p", "b", "c")


def pair(values: DataFrame, engines: tuple[str, str] = ENGINES) -> DataFrame:
    """Pivots ``doc_id, engine, field_name, s, n, p, b, confidence`` to one row per document and field.

    Of several values of an engine the surest counts, then the largest.
    """
    value = F.struct(F.col("confidence").alias("c"), "s", "n", "p", "b")
    wide = values.groupBy("doc_id", "field_name").pivot("engine", list(engines)).agg(F.max(value))
    cols = [F.col(f"`{e}`.{v}").alias(f"{v}{i}") for i, e in enumerate(engines, 1) for v in VALUE]
    has = [F.col(f"`{e}`").isNotNull().alias(f"has{i}") for i, e in enumerate(engines, 1)]
    return wide.select("doc_id", "field_name", *cols, *has)


def _kind(name: Column) -> tuple[Column, Column]:
    return name.isin(*NUMERIC_FIELDS), name.isin(*VISUAL_FIELDS)


def detect(pairs: DataFrame, c: ConflictConfig = ConflictConfig()) -> DataFrame:
    """``pairs`` with ``conflict, conflict_type, metric``.

    Two nulls agree, one null is a missing value.  Numbers conflict beyond the
    relative difference, texts below either similarity, marks by presence and
    then by IoU where both have a box.  Other fields compare as texts.
    """
    numeric, visual = _kind(F.col("field_name"))
    scored = pairs.withColumns({"_t1": strip(F.col("s1")), "_t2": strip(F.col("s2"))})
    scored = score_pairs(scored, "_t1", "_t2")
    null = lambda i: F.when(numeric, F.col(f"n{i}").isNull() & F.col(f"s{i}").isNull()).when(visual, F.col(f"p{i}").isNull()).otherwise(F.col(f"s{i}").isNull())
    none1, none2 = null(1), null(2)
    diff = relative_diff(F.col("n1"), F.col("n2"))
    unparsed = F.col("n1").isNull() | F.col("n2").isNull()
    overlap = iou(F.col("b1"), F.col("b2"))
    boxes = F.coalesce((F.size("b1") > 0) & (F.size("b2") > 0), F.lit(False))
    apart = F.col("p1") != F.col("p2")
    kind = (
        F.when(none1 & none2, F.lit(None))
        .when(none1 | none2, "missing_value")
        .when(numeric, F.when(unparsed, "numeric_parse_error").otherwise("numeric"))
        .when(visual, F.when(apart, "visual_presence").when(F.col("p1") & boxes, "visual_bbox"))
        .otherwise("textual")
    )
    metric = (
        F.when(F.col("conflict_type").isin("missing_value", "visual_presence"), 1.0)
        .when(F.col("conflict_type") == "numeric", diff)
        .when(F.col("conflict_type") == "visual_bbox", 1.0 - overlap)
        .when(F.col("conflict_type") == "textual", 1.0 - F.col("fuzzy") / 100.0)
        .otherwise(0.0)
    )
    conflict = (
        F.when(F.col("conflict_type").isin("missing_value", "visual_presence", "numeric_parse_error"), True)
        .when(F.col("conflict_type") == "numeric", diff > c.numeric)
        .when(F.col("conflict_type") == "visual_bbox", overlap < c.iou)
        .when(F.col("conflict_type") == "textual", (F.col("fuzzy") < c.fuzzy) | (F.col("overlap") < c.overlap))
        .otherwise(False)
    )
    return scored.withColumn("conflict_type", kind).withColumn("metric", metric).withColumn("conflict", conflict).drop("_t1", "_t2", "fuzzy", "overlap")


def weights(c: ConsensusConfig, engines: tuple[str, str] = ENGINES) -> tuple[float, float]:
    return tuple(float(c.weights.get(e, c.unknown_weight)) for e in engines)


def normalized(weights: dict[str, float]) -> dict[str, float]:
    """Weights that add up to one."""
    total = sum(weights.values())
    return {k: v / total for k, v in weights.items()}


def consensus(detected: DataFrame, c: ConsensusConfig = ConsensusConfig(), engines: tuple[str, str] = ENGINES) -> DataFrame:
    """``detected`` with ``s, n, p, b, confidence, source, resolution``.

    One engine passes through.  Agreeing values are weighted (numbers by weight
    and confidence, others the stronger one); if both confidences are 0 the
    number is the first value.  Conflicts keep the surer value at a penalty and
    ask for adjudication.
    """
    w1, w2 = weights(c, engines)
    numeric, _ = _kind(F.col("field_name"))
    both = F.col("has1") & F.col("has2")
    alone = F.col("has1") != F.col("has2")
    agree = both & ~F.col("conflict")
    clash = both & F.col("conflict")
    first = F.when(clash, F.col("c1") >= F.col("c2")).when(agree, F.col("c1") * w1 >= F.col("c2") * w2).otherwise(F.col("has1"))
    mean = F.try_divide(F.col("n1") * w1 * F.col("c1") + F.col("n2") * w2 * F.col("c2"), F.col("c1") * w1 + F.col("c2") * w2)
    weighted = agree & numeric & mean.isNotNull()
    pick = lambda v: F.when(first, F.col(f"{v}1")).otherwise(F.col(f"{v}2"))
    confidence = (
        F.when(clash, F.greatest("c1", "c2") * c.penalty)
        .when(agree, (F.col("c1") * w1 + F.col("c2") * w2) / (w1 + w2))
        .when(alone, pick("c"))
        .otherwise(0.0)
    )
    source = F.when(weighted, "weighted").when(first, engines[0]).when(F.col("has2"), engines[1]).otherwise("none")
    return detected.withColumns(
        {
            "s": pick("s"),
            "n": F.when(weighted, mean).otherwise(pick("n")),
            "p": pick("p"),
            "b": pick("b"),
            "confidence": confidence,
            "source": source,
            "resolution": F.when(clash, "needs_adjudication"),
        }
    )
