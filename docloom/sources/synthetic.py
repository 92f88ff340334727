"""Synthetic invoices with marks, from a seed."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vision

WIDTH, HEIGHT = 800, 600


def plan(spark: SparkSession, count: int = 100, signatures: bool = True, stamps: bool = True) -> DataFrame:
    """Which document carries which mark where: ``doc_id, class_name, present, bbox``.

    A signature with probability 0.7, a stamp with 0.6; all by a hash of id and class.
    """
    return marks(spark.range(count).withColumnRenamed("id", "doc_id"), signatures, stamps)


def marks(docs: DataFrame, signatures: bool = True, stamps: bool = True) -> DataFrame:
    kinds = [k for k, on in (("signature", signatures), ("stamp", stamps)) if on]
    rows = docs.select("doc_id", F.explode(F.array(*(F.lit(k) for k in kinds)).cast("array<string>")).alias("class_name"))
    draw = lambda what: F.conv(F.substring(F.md5(F.concat_ws(":", "class_name", F.lit(what), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long")
    sign = F.col("class_name") == "signature"
    w, h = F.when(sign, 200).otherwise(100), F.when(sign, 60).otherwise(100)
    x, y = (draw("x") % (WIDTH - w)).cast("int"), (HEIGHT // 2 + draw("y") % (HEIGHT // 2 - h)).cast("int")
    present = draw("present") % 100 < F.when(sign, 70).otherwise(60)
    return rows.select("doc_id", "class_name", present.alias("present"), F.when(present, F.array(x, y, w, h)).alias("bbox"))


def draw(marked: DataFrame, seed: int = 0, augmented: bool = False) -> DataFrame:
    """PNG pages ``doc_id, content`` for the marks of ``plan``."""

    def page(own: pd.DataFrame) -> pd.DataFrame:
        doc = int(own["doc_id"].iloc[0])
        rng = np.random.default_rng((seed, doc))
        img = np.full((HEIGHT, WIDTH, 3), 255, np.uint8)
        for y in range(30, HEIGHT // 2, 24):
            img[y : y + 2, 40 : 40 + int(rng.integers(200, 700))] = 60
        for name, present, box in zip(own["class_name"], own["present"], own["bbox"], strict=True):
            if present:
                mark = vision.draw_signature(rng, box[2], box[3]) if name == "signature" else vision.draw_stamp(rng, box[2])
                img = vision.blend(img, vision.augment(mark, rng) if augmented else mark, int(box[0]), int(box[1]))
        return pd.DataFrame({"doc_id": [str(doc)], "content": [vision.encode_png(img)]})

    return marked.orderBy("class_name").groupBy("doc_id").applyInPandas(page, "doc_id string, content binary")


def draw_marks(marked: DataFrame, seed: int = 0) -> DataFrame:
    """PNG crops ``doc_id, class_name, content`` of the marks of ``plan`` that are present; no shuffle."""

    def crops(batches):
        for b in batches:
            rows = []
            for doc, name, box in zip(b["doc_id"], b["class_name"], b["bbox"], strict=True):
                rng = np.random.default_rng((seed, int(doc)))
                mark = vision.draw_signature(rng, box[2], box[3]) if name == "signature" else vision.draw_stamp(rng, box[2])
                rows.append((str(doc), name, vision.encode_png(mark)))
            yield pd.DataFrame(rows, columns=["doc_id", "class_name", "content"])

    return marked.filter("present").select("doc_id", "class_name", "bbox").mapInPandas(crops, "doc_id string, class_name string, content binary")


def write(spark: SparkSession, path: str, count: int = 100, signatures: bool = True, stamps: bool = True, seed: int = 0) -> None:
    """Pages (Parquet with PNG bytes) and annotations (JSON lines)."""
    marked = plan(spark, count, signatures, stamps)
    marked.write.mode("error").json(f"{path}/annotations")
    draw(marked, seed).write.mode("error").parquet(f"{path}/pages")


