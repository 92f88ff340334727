"""Visual marks: lines over a box, verification by image metrics, and what is drawn in an image."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import VerifyConfig
from ..functions import vision
from ..functions.geometry import clamp, iou, touches


def words_in_boxes(detections: DataFrame, lines: DataFrame) -> DataFrame:
    """Words of all lines that touch a detection's box; a line counts whole.

    Detections: ``doc_id, class_name, det_no, bbox``; lines: ``doc_id, bbox, text``.
    """
    near = lines.select("doc_id", F.col("bbox").alias("_box"), F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("_words"))
    key = ["doc_id", "class_name", "det_no"]
    on = (detections["doc_id"] == near["doc_id"]) & touches(detections["bbox"], near["_box"])
    hits = detections.join(near, on).groupBy(*(detections[k] for k in key)).agg(F.sum("_words").alias("words"))
    return detections.join(hits, key, "left").withColumn("words", F.coalesce("words", F.lit(0).cast("long")))


def verify(detections: DataFrame, c: VerifyConfig = VerifyConfig()) -> DataFrame:
    """``verified, reason`` from box, words and image metrics.

    Columns: ``bbox, width, height, words, density, components, color,
    circularity, rectangularity``.  Unknown classes stay as they are.
    """
    box = clamp(F.col("bbox"), F.col("width"), F.col("height"))
    rows = detections.withColumn("clamped", box)
    empty = (F.get("clamped", F.lit(2)) <= 0) | (F.get("clamped", F.lit(3)) <= 0)
    dense = F.col("density").between(*c.density)
    inked, strokes = dense, F.col("components") >= c.components
    colored = F.col("color") >= c.color
    shaped = (F.col("circularity") >= c.circularity) | (F.col("rectangularity") >= c.rectangularity)
    reason = (
        F.when(empty, "invalid_bbox")
        .when(F.col("words") > c.words, "too_many_words")
        .when(F.col("class_name") == "signature", F.when(~inked, "stroke_density").when(~strokes, "few_components").otherwise("verified"))
        .when(F.col("class_name") == "stamp", F.when(~colored, "color").when(~shaped, "shape").otherwise("verified"))
        .otherwise("unknown_class")
    )
    before = F.col("verified") if "verified" in detections.columns else F.lit(False)
    rows = rows.withColumn("reason", reason)
    return rows.withColumn("verified", F.when(F.col("reason") == "unknown_class", before).otherwise(F.col("reason") == "verified"))


def filter_contours(contours: DataFrame) -> DataFrame:
    """Contours of plausible area and shape: the first five signatures and three stamps per document.

    Columns: ``doc_id, class_name, contour_no, area, width, height, image_area``.
    """
    from pyspark.sql import Window as W

    share, ratio = F.col("area") / F.col("image_area"), F.try_divide(F.col("width"), F.col("height"))
    signature = (F.col("class_name") == "signature") & (share > 0.001) & (share < 0.15) & (ratio > 1.5) & (ratio < 8)
    stamp = (F.col("class_name") == "stamp") & (share > 0.002) & (share < 0.10)
    at = W.partitionBy("doc_id", "class_name").orderBy("contour_no")
    most = F.when(F.col("class_name") == "signature", 5).otherwise(3)
    return contours.filter(signature | stamp).withColumn("_n", F.row_number().over(at)).filter(F.col("_n") <= most).drop("_n")


def suppress(detections: DataFrame, confidence: float = 0.5, overlap: float = 0.45) -> DataFrame:
    """Detections that are sure enough and that no surer one of their document and class overlaps.

    Greedy in order of confidence, then of ``det_no``; those of one image meet in
    one array, which a detector bounds.
    """
    least = (-F.col("confidence")).alias("c"), F.col("det_no").isNull().alias("n"), F.col("det_no").alias("d")
    rows = F.struct(F.struct(*least).alias("key"), F.col("bbox").cast("array<double>").alias("box"), F.struct(*detections.columns).alias("row"))
    surest = F.array_sort("_own", lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))

    def keep(kept: Column, x: Column) -> Column:
        free = F.forall(kept, lambda k: iou(k["box"], x["box"]) <= overlap)
        return F.when(free, F.concat(kept, F.array(x))).otherwise(kept)

    sure = detections.filter((F.col("confidence") >= confidence) & F.col("bbox").isNotNull())
    own = sure.groupBy("doc_id", "class_name").agg(F.collect_list(rows).alias("_own"))
    kept = F.aggregate(surest, F.filter("_own", lambda x: F.lit(False)), keep)
    return own.select(F.explode(kept).alias("_kept")).select("_kept.row.*")


def _overlap(p: list[float], q: list[float]) -> float:
    """Intersection over union of xywh boxes."""
    w, h = min(p[0] + p[2], q[0] + q[2]) - max(p[0], q[0]), min(p[1] + p[3], q[1] + q[3]) - max(p[1], q[1])
    both = max(0.0, w) * max(0.0, h)
    union = p[2] * p[3] + q[2] * q[3] - both
    return both / union if union > 0 else 0.0


def counts(verified: DataFrame) -> DataFrame:
    """Detections and verified ones per document and class."""
    return verified.groupBy("doc_id", "class_name").agg(F.count(F.lit(1)).alias("detections"), F.count_if("verified").alias("verified"))


def find(images: DataFrame, lines: DataFrame | None = None, detector=None, c: VerifyConfig = VerifyConfig(), classes: tuple[str, ...] = ("signature", "stamp")) -> DataFrame:
    """Marks of the classes in ``images``, suppressed and, with their crops' metrics and the lines over them, verified."""
    found = suppress(detect_heuristically(images, detector).filter(F.col("class_name").isin(*classes)))
    measured = crop_metrics(images, found)
    rows = found.join(measured, ["doc_id", "class_name", "det_no"])
    rows = words_in_boxes(rows, lines) if lines is not None else rows.withColumn("words", F.lit(0).cast("long"))
    return verify(rows, c)


def crop_metrics(images: DataFrame, found: DataFrame) -> DataFrame:
    """Page size and the metrics of every detection's crop; an image is decoded once."""
    boxes = found.groupBy("doc_id").agg(F.collect_list(F.struct("class_name", "det_no", "bbox")).alias("boxes"))
    schema = "doc_id string, class_name string, det_no int, width int, height int, density double, components int, color double, circularity double, rectangularity double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, data, own in zip(b["doc_id"], b["content"], b["boxes"], strict=True):
                img = vision.decode(bytes(data))
                for x in own:
                    part = vision.crop(img, [int(v) for v in x["bbox"]])
                    if not part.size:
                        continue
                    circle, rect = vision.shape_scores(part)
                    out.append((doc, x["class_name"], x["det_no"], img.shape[1], img.shape[0], vision.stroke_density(part), vision.components(part), vision.color_score(part), circle, rect))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])

    return images.select("doc_id", "content").join(boxes, "doc_id").mapInPandas(run, schema)


METRICS = "doc_id string, width int, height int, density double, components int, color double, circularity double, rectangularity double, error string"
FOUND = "doc_id string, class_name string, det_no int, bbox array<int>, confidence double"


def image_metrics(images: DataFrame) -> DataFrame:
    """Metrics of whole images ``doc_id, content``; an unreadable image gives an error and nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, data in zip(b["doc_id"], b["content"], strict=True):
                try:
                    img = vision.decode(bytes(data))
                    h, w = img.shape[:2]
                    circle, rect = vision.shape_scores(img)
                    out.append((doc, w, h, vision.stroke_density(img), vision.components(img), vision.color_score(img), circle, rect, None))
                except Exception as e:  # one bad image must not fail the job
                    out.append((doc, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in METRICS.split(", ")]).astype({"width": "Int32", "height": "Int32", "components": "Int32"})

    return images.select("doc_id", "content").mapInPandas(run, METRICS)


def detect_heuristically(images: DataFrame, detector=None) -> DataFrame:
    """Marks found in images ``doc_id, content``; ``detector`` (image -> [(class, box, confidence)]) comes first if given.

    Without it, or where it finds nothing, edges and colours decide.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, data in zip(b["doc_id"], b["content"], strict=True):
                try:
                    img = vision.decode(bytes(data))
                except Exception:
                    continue
                found = list(detector(img)) if detector is not None else []
                for name, boxes in () if found else (("signature", vision.signature_boxes(img)), ("stamp", vision.stamp_boxes(img))):
                    found += [(name, box, 0.5) for box in boxes]
                out += [(doc, name, i, [int(v) for v in box], float(conf)) for i, (name, box, conf) in enumerate(found)]
            yield pd.DataFrame(out, columns=[f.split()[0] for f in FOUND.split(", ")])

    return images.select("doc_id", "content").mapInPandas(run, FOUND)


