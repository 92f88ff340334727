"""Fuzzy joins against a dealer list, and scores of value pairs.

Scores need a UDF, so it runs on distinct values or pairs only; the list side
is a dimension of a few thousand names at most (checked), which is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEALERS, ENGINES
from ..functions import fuzzy, text

#: A longer dealer list is not broadcast against every distinct name.
MOST_DEALERS = 20_000


def dealer_table(spark: SparkSession, names: Sequence[str] = DEALERS) -> DataFrame:
    """The dealer list in order: ``pos, name``."""
    if len(names) > MOST_DEALERS:
        raise ValueError(f"a dealer list holds {MOST_DEALERS} names at most")
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos int, name string")


def match_dealers(values: DataFrame, column: str, names: Sequence[str] = DEALERS, threshold: float = 90.0, strict: bool = True) -> DataFrame:
    """``values`` with ``value, confidence, matched, score`` of the best dealer by token-set similarity.

    Names that are equal without suffixes stand for the last of them in the
    list; ties in score go to the first in the list.
    """
    spark = values.sparkSession
    master = dealer_table(spark, names).withColumn("bare", text.strip_suffixes(F.col("name"), strict))
    original = master.groupBy("bare").agg(F.max_by("name", "pos").alias("name"), F.min("pos").alias("pos"))
    found = values.select(F.col(column).alias("_raw")).filter(F.col("_raw") != "").distinct().withColumn("_bare", text.strip_suffixes(F.col("_raw"), strict))
    scored = found.crossJoin(F.broadcast(original)).withColumn("score", fuzzy.token_set_ratio("_bare", "bare"))
    best = scored.groupBy("_raw").agg(F.max_by(F.struct("score", "name"), F.struct("score", F.negative(F.col("pos")))).alias("best"))
    matched = F.col("best.score") >= threshold
    best = best.select(
        "_raw",
        F.when(matched, F.col("best.name")).otherwise(F.col("_raw")).alias("value"),
        F.when(matched, F.col("best.score") / 100.0).otherwise(F.col("best.score") / 100.0 * 0.5).alias("confidence"),
        matched.alias("matched"),
        F.col("best.score").alias("score"),
    )
    out = values.join(best, values[column] == best["_raw"], "left").drop("_raw")
    return out.withColumns({"confidence": F.coalesce("confidence", F.lit(0.0)), "matched": F.coalesce("matched", F.lit(False)), "score": F.coalesce("score", F.lit(0.0))})


def prefilter_dealers(pairs: DataFrame, first: str, second: str, names: Sequence[str] = DEALERS, threshold: float = 90.0) -> DataFrame:
    """``pairs`` with ``locked, locked_confidence``: the dealer that the first value, else the second, all but equals.

    Word order is forgiven, case is not.
    """
    spark = pairs.sparkSession
    both = pairs.select(F.explode(F.array(first, second)).alias("_raw")).filter(F.col("_raw") != "").distinct()
    scored = both.crossJoin(F.broadcast(dealer_table(spark, names))).withColumn("score", fuzzy.token_sort_ratio("_raw", "name"))
    best = scored.groupBy("_raw").agg(F.max_by(F.struct("score", "name"), F.struct("score", F.negative(F.col("pos")))).alias("best"))
    best = best.filter(F.col("best.score") >= threshold)
    one, two = (best.select(F.col("_raw").alias(f"_k{i}"), F.col("best").alias(f"_b{i}")) for i in (1, 2))
    out = pairs.join(one, F.col(first) == F.col("_k1"), "left").join(two, F.col(second) == F.col("_k2"), "left")
    hit = F.coalesce("_b1", "_b2")
    return out.withColumns({"locked": hit["name"], "locked_confidence": hit["score"] / 100.0}).drop("_k1", "_k2", "_b1", "_b2")


def score_pairs(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """``pairs`` with ``fuzzy`` (0 to 100) and ``overlap`` (0 to 1) of two text columns."""
    distinct = pairs.select(F.col(first).alias("_a"), F.col(second).alias("_b")).filter("_a is not null and _b is not null").distinct()
    scored = distinct.withColumns({"fuzzy": fuzzy.fuzzy_score(F.col("_a"), F.col("_b")), "overlap": text.token_overlap(F.col("_a"), F.col("_b"))})
    return pairs.join(scored, (F.col(first) == F.col("_a")) & (F.col(second) == F.col("_b")), "left").drop("_a", "_b")


def merge_lines(lines: DataFrame, least_iou: float = 0.5) -> DataFrame:
    """Greedy one-to-one merge of two engines' lines per document.

    Every first-engine line, in order, takes the free second-engine line with
    the largest IoU of ``least_iou`` or more (the earlier one if equal).
    Lines: ``doc_id, engine, line_no, text, bbox (x, y, w, h), confidence``.
    Greedy matching depends on order, so a document's lines (one page) travel
    as one array; Python sees many documents per batch.
    Result: ``doc_id, line1, line2, iou, text, agree``.
    """

    def merge(page: list) -> Iterator[tuple]:
        first, free = ([r for r in page if r["engine"] == e] for e in ENGINES)
        for a in first:
            best, at = 0.0, None
            for b in free:
                score = _box_iou(a["bbox"], b["bbox"])
                if score >= least_iou and score > best:
                    best, at = score, b
            if at is None:
                yield a["line_no"], None, 0.0, a["text"], False
            else:
                free.remove(at)
                yield a["line_no"], at["line_no"], best, (a if a["confidence"] >= at["confidence"] else at)["text"], _agree(a["text"], at["text"])
        for b in free:
            yield None, b["line_no"], 0.0, b["text"], False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, *row) for doc, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for row in merge(page)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.string(), pa.bool_())
            names = ("doc_id", "line1", "line2", "iou", "text", "agree")
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))

    pages = lines.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "engine", "bbox", "text", "confidence"))).alias("page"))
    return pages.mapInArrow(run, "doc_id long, line1 int, line2 int, iou double, text string, agree boolean")


def _box_iou(p: list[int], q: list[int]) -> float:
    across = min(p[0] + p[2], q[0] + q[2]) - max(p[0], q[0])
    down = min(p[1] + p[3], q[1] + q[3]) - max(p[1], q[1])
    inter = max(0, across) * max(0, down)
    union = p[2] * p[3] + q[2] * q[3] - inter
    return inter / union if union > 0 else 0.0


def _agree(a: str, b: str) -> bool:
    x, y = a.strip().lower(), b.strip().lower()
    return x == y or (bool(x and y) and len(set(x) & set(y)) / len(set(x) | set(y)) >= 0.8)
