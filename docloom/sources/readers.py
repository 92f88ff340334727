"""Images, OCR answers, dealer lists, golden sets and result files as DataFrames."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEALERS, NUMERIC_FIELDS, TEXT_FIELDS, VISUAL_FIELDS
from ..functions.geometry import polygon_to_xywh
from . import schemas

EXTENSIONS = ("png", "jpg", "jpeg", "tiff", "bmp", "pdf")


def images(spark: SparkSession, path: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """Image files of a folder: ``doc_id, path, content`` (the file's stem is the id)."""
    each = ",".join(x for e in extensions for x in dict.fromkeys((e.lower(), e.upper())))
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{each}}}").load(path)
    return found.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("doc_id"), "path", "content")


def service_urls() -> dict[str, str]:
    """OCR services from the environment."""
    return {"paddle": os.environ.get("PADDLE_OCR_URL", "http://localhost:8001"), "deepseek": os.environ.get("DEEPSEEK_OCR_URL", "http://localhost:8002")}


def http_ocr(url: str, timeout: float | None = None) -> Callable[[bytes, str], dict]:
    """A call that posts one image to ``<url>/ocr`` and returns the decoded answer."""

    def call(content: bytes, name: str) -> dict:
        import urllib.request
        import uuid

        mark = uuid.uuid4().hex
        body = b"".join(
            (f'--{mark}\r\nContent-Disposition: form-data; name="image"; filename="{name}"\r\nContent-Type: application/octet-stream\r\n\r\n'.encode(), content, f"\r\n--{mark}--\r\n".encode())
        )
        request = urllib.request.Request(f"{url}/ocr", body, {"Content-Type": f"multipart/form-data; boundary={mark}"})
        with urllib.request.urlopen(request, timeout=timeout or float(os.environ.get("OCR_TIMEOUT", "120"))) as answer:
            return json.loads(answer.read())

    return call


def ocr_answers(pictures: DataFrame, engines: dict[str, Callable[[bytes, str], dict]], services: int = 1) -> DataFrame:
    """``doc_id, engine, answer`` (JSON) of every engine for every image.

    A service takes one page at a time, so ``services`` partitions call each;
    any failure is an empty answer, never a failed job.
    """
    parts = []
    for engine, call in engines.items():

        def run(batches: Iterator[pd.DataFrame], engine: str = engine, call: Callable = call) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for doc, content in zip(b["doc_id"], b["content"], strict=True):
                    try:
                        answer = call(bytes(content), doc)
                        answer = answer if answer.get("success") else {"success": False, "results": []}
                    except Exception as e:
                        answer = {"success": False, "error": str(e), "results": []}
                    out.append((doc, engine, json.dumps(answer)))
                yield pd.DataFrame(out, columns=["doc_id", "engine", "answer"])

        parts.append(pictures.select("doc_id", "content").coalesce(services).mapInPandas(run, "doc_id string, engine string, answer string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ocr_lines(answers: DataFrame) -> DataFrame:
    """Lines of OCR answers: ``doc_id, engine, line_no, text, bbox (x, y, w, h), confidence``."""
    parsed = answers.withColumn("_a", F.from_json("answer", schemas.OCR_ANSWER)).filter(F.coalesce(F.col("_a.success"), F.lit(False)))
    lines = parsed.select("doc_id", "engine", F.posexplode("_a.results").alias("line_no", "_r"))
    box = F.when(F.size("_r.bbox_points") > 0, polygon_to_xywh(F.col("_r.bbox_points"))).otherwise(F.array(*(F.lit(0),) * 4))
    return lines.select("doc_id", "engine", "line_no", F.coalesce("_r.text", F.lit("")).alias("text"), box.alias("bbox"), F.coalesce("_r.confidence", F.lit(0.0)).alias("confidence"))


def full_text(lines: DataFrame) -> DataFrame:
    """Per document and engine: the lines' text joined by spaces in order, and their mean confidence."""
    ordered = F.sort_array(F.collect_list(F.struct("line_no", "text")))
    mean = F.round(F.avg("confidence"), 9)
    return lines.groupBy("doc_id", "engine").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("full_text"), mean.alias("avg_confidence"), F.count(F.lit(1)).alias("lines"))


def dealers(spark: SparkSession, path: str | None) -> list[str]:
    """A dealer list (a JSON array of names); the default list without a path, none if the file is missing."""
    if path is None:
        return list(DEALERS)
    try:
        rows = spark.read.text(path, wholetext=True).collect()  # a list of names: one small file
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
    return list(json.loads(rows[0][0])) if rows else []


def _long(docs: DataFrame, fields: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Struct fields as long rows."""
    none = lambda kind: F.lit(None).cast(kind)
    f = lambda name: F.col(f"{fields}.{name}")

    def one(name: str) -> Column:
        s = f(name) if name in TEXT_FIELDS else none("string")
        n = f(name) if name in NUMERIC_FIELDS else none("double")
        p = f(f"{name}.present") if name in VISUAL_FIELDS else none("boolean")
        b = f(f"{name}.bbox") if name in VISUAL_FIELDS else none("array<int>")
        return F.struct(F.lit(name).alias("field_name"), s.alias("s"), n.alias("n"), p.alias("p"), b.alias("b"))

    rows = docs.withColumn("_f", F.explode(F.array(*(one(n) for n in (*TEXT_FIELDS, *NUMERIC_FIELDS, *VISUAL_FIELDS)))))
    return rows.select("doc_id", *keep, "_f.*")


def _last(docs: DataFrame) -> DataFrame:
    from ..operators.evaluation import latest

    return latest(docs.filter("doc_id is not null and doc_id <> ''"), ["doc_id"], "pos").drop("pos")


def golden_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The golden file with results: documents (``doc_id, error, has_fields``) and long values; the last entry of an id counts."""
    docs = spark.read.option("multiLine", True).schema(schemas.GOLDEN_RESULTS).json(path).select(F.posexplode("results").alias("pos", "r")).select("pos", "r.*")
    docs = _last(docs)
    return docs.select("doc_id", "error", F.col("fields").isNotNull().alias("has_fields")), _long(docs.filter("fields is not null"), "fields")


def golden_documents(spark: SparkSession, path: str) -> DataFrame:
    """The golden file with ground truth, as long values with ``layout_cluster`` (0 if missing)."""
    docs = spark.read.option("multiLine", True).schema(schemas.GOLDEN_DOCUMENTS).json(path).select(F.posexplode("documents").alias("pos", "d")).select("pos", "d.*")
    docs = _last(docs).filter("ground_truth is not null").withColumn("layout_cluster", F.coalesce("layout_cluster", F.lit(0)))
    return _long(docs, "ground_truth", ("layout_cluster",))


def results(spark: SparkSession, path: str) -> DataFrame:
    """Simple records (one object or an array per file, or one per line) as long values."""
    docs = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").schema(schemas.RESULT).json(path)
    return _long(docs.filter("fields is not null"), "fields", ("confidence", "processing_time_sec", "cost_estimate_usd"))


def results_with_sources(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.option("multiLine", True).schema(schemas.RESULTS_WITH_SOURCES).json(path).select(F.explode("results").alias("r")).select("r.*")
    rows = _long(docs, "fields", ("confidence", "field_sources"))
    return rows.withColumn("source", F.try_element_at("field_sources", F.col("field_name"))).drop("field_sources")


def detailed_results(spark: SparkSession, path: str) -> DataFrame:
    """Detailed records as long values; numbers are parsed from their text."""
    docs = spark.read.option("multiLine", True).schema(schemas.DETAILED).json(path)
    rows = docs.select("doc_id", F.explode("fields").alias("field_name", "v"))
    mark = F.col("field_name").isin(*VISUAL_FIELDS)
    value = F.from_json("v.value", schemas.MARK.removeprefix("struct<").removesuffix(">").replace("present boolean", "present boolean"))
    return rows.select(
        "doc_id", "field_name",
        F.when(~mark, F.col("v.value")).alias("s"),
        F.when(F.col("field_name").isin(*NUMERIC_FIELDS), F.col("v.value").try_cast("double")).alias("n"),
        F.when(mark, F.coalesce(value["present"], present(F.get_json_object("v.value", "$.present")) | present(F.col("v.value")))).alias("p"),
        F.when(mark, F.coalesce(F.col("v.bbox"), value["bbox"])).alias("b"),
        F.col("v.confidence").alias("confidence"), F.col("v.source").alias("source"),
    )


def calibrator(spark: SparkSession, path: str) -> DataFrame:
    """Knots ``field_name, x, y`` that ``writers.calibrator`` saved, or of a calibrator file in JSON.

    A binned entry of the file becomes the centres of its bins, an approximated one its points.
    """
    if not path.endswith(".json"):
        return spark.read.schema("field_name string, x double, y double").parquet(path)
    entry = "struct<type string, bins array<double>, bin_means array<double>, points array<double>, values array<double>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{entry}>")).alias("field_name", "e"))
    centres = F.transform(F.sequence(F.lit(0), F.size("e.bin_means") - 1), lambda i: (F.get("e.bins", i) + F.get("e.bins", i + 1)) / 2)
    binned = F.col("e.type") == "binned"
    knots = F.arrays_zip(F.when(binned, centres).otherwise(F.col("e.points")).alias("x"), F.when(binned, F.col("e.bin_means")).otherwise(F.col("e.values")).alias("y"))
    return rows.select("field_name", F.explode(knots).alias("k")).select("field_name", "k.x", "k.y")


def golden_or_none(spark: SparkSession, path: str) -> DataFrame:
    """The golden values of a file, none if it is missing."""
    try:
        return golden_results(spark, path)[1]
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schemas.LONG_VALUE)
        raise


def present(value: Column) -> Column:
    """Whether a mark is there, from a flag or a word: yes, true or 1 in any case."""
    return F.coalesce(F.upper(F.trim(value.cast("string"))).isin("YES", "TRUE", "1"), F.lit(False))


def mock_invoice(spark: SparkSession, ids: DataFrame) -> DataFrame:
    """Deterministic invoice texts for ids ``doc_id``, drawn from a hash of the id."""
    # What mock invoices name.
    models = ("Mahindra 575 DI", "John Deere 5050D", "Swaraj 744 FE", "Sonalika DI 745", "New Holland 3630")
    h = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long")
    pick = lambda options, by: F.element_at(F.array(*(F.lit(o) for o in options)), (F.floor(h / by) % len(options) + 1).cast("int"))
    hp, cost = (35 + F.floor(h / 7) % 41).cast("string"), (500000 + F.floor(h / 11) % 700001).cast("string")
    text = F.concat(F.lit("TAX INVOICE\nDealer: "), pick(DEALERS, 3), F.lit("\nModel: "), pick(models, 5), F.lit("\nHorse Power: "), hp, F.lit(" HP\nTotal Amount: Rs. "), cost)
    return ids.select("doc_id", text.alias("text"), F.lit(0.85).alias("confidence"))
