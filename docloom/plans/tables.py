"""Invoices, readings, marks, golden data and the cost log, derived from the star schema.

An invoice is an order; its model, price and dealer come from the order's
first line.  The second reader's text carries deterministic damage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEALERS, ENGINES, NUMERIC_FIELDS, TEXT_FIELDS, VISUAL_FIELDS
from ..functions import text
from ..operators import consensus, results
from ..sources.staging import staged

COMPONENTS = {"view": "paddle_ocr", "click": "deepseek_ocr", "signup": "tier1_rules", "purchase": "tier2_slm", "error": "tier3_vlm"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(options: tuple[str, ...], at: Column) -> Column:
    return F.when(at.isNotNull(), F.element_at(F.array(*(F.lit(o) for o in options)), (at % len(options) + 1).cast("int")))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, k, dealer, model, hp, price, paddle, deepseek``; all null but the keys for orders without lines."""
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")).alias("l")).select("l_orderkey", "l.*")
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    rows = orders.join(lines, orders["doc_id"] == lines["l_orderkey"], "left")
    rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left").join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    k = F.col("doc_id") % 12
    dealer = F.when(F.col("l_suppkey") % 10 == 9, F.col("s_name")).otherwise(_pick(DEALERS, F.col("l_suppkey")))
    brand = _pick(text.BRANDS, F.col("l_partkey"))
    rows = rows.select(
        "doc_id", k.alias("k"), dealer.alias("dealer"), brand.alias("brand"), _pick(text.BRANDS, F.col("l_partkey") + 1).alias("brand2"),
        F.col("l_partkey").cast("string").alias("no"), F.col("p_size").cast("long").alias("hp"), F.floor("l_extendedprice").cast("long").alias("price"),
    )
    native = F.when(F.col("k") == 1, F.translate(F.col("price").cast("string"), text.ASCII[:10], text.NATIVE[:10])).when(
        F.col("k") == 2, F.translate(F.col("price").cast("string"), text.ASCII[:10], text.NATIVE[10:])
    )
    lakh = F.concat(F.floor(F.col("price") / 100000).cast("string"), F.lit("."), F.lpad((F.col("price") % 100000).cast("string"), 5, "0"), F.lit(" lakh"))
    amount = (
        F.when(F.col("k").isin(1, 2), native)
        .when(F.col("k") == 3, F.floor(F.col("price") * 103 / 100).cast("string"))
        .when(F.col("k") == 4, F.floor(F.col("price") * 108 / 100).cast("string"))
        .when(F.col("k") == 7, lakh)
        .when(F.col("k") == 11, F.concat(F.lit("Rs. "), F.col("price").cast("string")))
        .otherwise(F.col("price").cast("string"))
    )
    seller = F.when(F.col("k") == 6, F.concat(F.upper("dealer"), F.lit(" Pvt Ltd"))).when(F.col("k") == 10, F.translate("dealer", "o", "0")).otherwise(F.col("dealer"))
    power = F.when(F.col("k") == 8, F.concat(F.col("hp").cast("string"), F.lit("-"), (F.col("hp") + 10).cast("string"))).otherwise(F.col("hp").cast("string"))
    name = lambda b: F.concat(F.initcap(b), F.lit(" "), F.col("no"))
    first = F.concat(F.lit("Dealer: "), "dealer", F.lit("\nModel: "), name("brand"), F.lit("\nHP: "), F.col("hp").cast("string"), F.lit(" HP\nTotal: "), F.col("price").cast("string"))
    head = F.when(F.col("k") == 5, F.lit("")).otherwise(F.concat(F.lit("Dealer: "), seller, F.lit("\n")))
    second = F.concat(head, F.lit("Model: "), name(F.when(F.col("k") == 9, F.col("brand2")).otherwise(F.col("brand"))), F.lit("\nHP: "), power, F.lit(" HP\nTotal: "), amount)
    return rows.select("doc_id", "k", "dealer", name("brand").alias("model"), "hp", "price", first.alias("paddle"), second.alias("deepseek"))


def readings(invoice: DataFrame) -> DataFrame:
    """Text per document and engine."""
    pairs = F.array(*(F.struct(F.lit(e).alias("engine"), F.coalesce(F.col(e), F.lit("")).alias("text")) for e in ENGINES))
    return invoice.select("doc_id", F.explode(pairs).alias("r")).select("doc_id", "r.*")


def _field_row(name: str):
    """The long row of a parsed value."""

    def row(got: Column) -> Column:
        none = F.lit(None)
        s, n = (got["value"], none.cast("double")) if name in TEXT_FIELDS else (none.cast("string"), got["value"])
        return F.struct(F.lit(name).alias("field_name"), s.alias("s"), n.alias("n"), got["confidence"].alias("confidence"))

    return row


def extracted(texts: DataFrame) -> DataFrame:
    """Field values per document, engine and text field."""
    none = lambda kind: F.lit(None).cast(kind)
    cols = []
    for name in (*TEXT_FIELDS, *NUMERIC_FIELDS):
        cols.append(text.let(text.extract(F.col("text"), name), _field_row(name)))
    rows = texts.select("doc_id", "engine", F.explode(F.array(*cols)).alias("f")).select("doc_id", "engine", "f.*")
    return rows.withColumns({"p": none("boolean"), "b": none("array<int>")})


def detections(invoice: DataFrame) -> DataFrame:
    """Two candidate marks per class with boxes and image metrics from integer arithmetic on the key."""
    d = F.col("doc_id")
    rows = invoice.select("doc_id", F.explode(F.array(*(F.struct(F.lit(c).alias("class_name"), F.lit(i).alias("det_no")) for c in VISUAL_FIELDS for i in (0, 1)))).alias("m")).select("doc_id", "m.*")
    j = F.when(F.col("class_name") == "signature", 1).otherwise(2) + 2 * F.col("det_no")
    box = F.array((d * 7 * j % 900 - 20).cast("int"), (d * 11 * j % 1100).cast("int"), (60 + d % 90).cast("int"), (20 + d * j % 40).cast("int"))
    part = lambda a, m: (d * a * j % m) / 100.0
    return rows.select(
        "doc_id", "class_name", "det_no", box.alias("bbox"), F.lit(800).alias("width"), F.lit(1100).alias("height"),
        (0.5 + (d * 13 * j % 50) / 100.0).alias("confidence"), part(3, 45).alias("density"), (d * j % 14).cast("int").alias("components"),
        part(5, 40).alias("color"), part(7, 100).alias("circularity"), part(9, 100).alias("rectangularity"),
    )


def lines(texts: DataFrame) -> DataFrame:
    """Lines of the readings with boxes down the page."""
    rows = texts.select("doc_id", "engine", F.posexplode(F.split("text", "\n")).alias("line_no", "text")).filter("text <> ''")
    shift = F.when(F.col("engine") == "paddle", 0).otherwise(F.col("doc_id") % 30)
    box = F.array((F.lit(50) + shift).cast("int"), (F.lit(100) + F.col("line_no") * 220).cast("int"), (F.length("text") * 9).cast("int"), F.lit(24))
    return rows.withColumn("bbox", box).withColumn("confidence", (F.lit(90) - F.col("doc_id") % 20 - F.col("line_no")) / 100.0)


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six fields of both engines; the one detection of a mark is every engine's."""
    invoice = invoices(spark, sf_dir)
    texts = extracted(readings(invoice))
    found = detections(invoice).withColumn("verified", F.col("confidence") >= 0.7)
    marks = results.visual_defaults(invoice.select("doc_id"), found)
    marks = marks.withColumn("engine", F.explode(F.array(*(F.lit(e) for e in ENGINES)))).withColumns({"s": F.lit(None).cast("string"), "n": F.lit(None).cast("double")})
    return texts.unionByName(marks)


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    # pairs are scored against their own distinct values: the texts are parsed once
    return consensus.detect(staged(consensus.pair(values(spark, sf_dir)), "pairs"))


def agreed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus.consensus(detected(spark, sf_dir))


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoices(spark, sf_dir).select("doc_id", F.concat_ws(" ", F.coalesce("paddle", F.lit("")), F.coalesce("deepseek", F.lit(""))).alias("context"))


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean values of the invoices that have lines, without every seventh."""
    none = lambda kind: F.lit(None).cast(kind).alias
    rows = invoices(spark, sf_dir).filter("price is not null and doc_id % 7 <> 0")
    d = F.col("doc_id")
    mark = lambda j: F.struct((d % (2 + j) == 0).alias("p"), F.when(d % (2 + j) == 0, F.array((d * 7 * j % 900 - 20).cast("int"), (d * 11 * j % 1100).cast("int"), (60 + d % 90).cast("int"), (20 + d * j % 40 + d % 9).cast("int"))).alias("b"))
    each = [
        F.struct(F.lit("dealer_name").alias("field_name"), F.col("dealer").alias("s"), none("double")("n"), none("boolean")("p"), none("array<int>")("b")),
        F.struct(F.lit("model_name").alias("field_name"), F.col("model").alias("s"), none("double")("n"), none("boolean")("p"), none("array<int>")("b")),
        F.struct(F.lit("horse_power").alias("field_name"), none("string")("s"), F.col("hp").cast("double").alias("n"), none("boolean")("p"), none("array<int>")("b")),
        F.struct(F.lit("asset_cost").alias("field_name"), none("string")("s"), F.col("price").cast("double").alias("n"), none("boolean")("p"), none("array<int>")("b")),
    ]
    for i, name in enumerate(VISUAL_FIELDS, 1):
        each.append(F.struct(F.lit(name).alias("field_name"), none("string")("s"), none("double")("n"), mark(i)["p"].alias("p"), mark(i)["b"].alias("b")))
    return rows.select("doc_id", F.explode(F.array(*each)).alias("g")).select("doc_id", "g.*")


def predictions(spark: SparkSession, sf_dir: str, engine: str | None = None) -> DataFrame:
    """Consensus values as predictions, or one engine's."""
    if engine is not None:
        return values(spark, sf_dir).filter(F.col("engine") == engine).select("doc_id", "field_name", "s", "n", "p", "b", "confidence", F.col("engine").alias("source"))
    return agreed(spark, sf_dir).select("doc_id", "field_name", "s", "n", "p", "b", "confidence", "source", "conflict")


def cost_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    component = F.lit(None).cast("string")
    for event, name in COMPONENTS.items():
        component = F.when(F.col("event_type") == event, name).otherwise(component)
    return read(spark, sf_dir, "events").select(F.col("event_id").alias("call_id"), F.col("user_id").alias("doc_id"), component.alias("component"), F.col("value").alias("latency"), "ts", "props")


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary outcomes with a made-up confidence, for calibration."""
    rows = read(spark, sf_dir, "labels")
    c = lambda a: ((F.col("doc_id") * a + 13) % 101) / 100.0
    return rows.select(F.explode(F.array(F.struct(F.lit("quality").alias("field_name"), c(37).alias("confidence"), (F.col("quality") == 1).alias("correct")), F.struct(F.lit("toxic").alias("field_name"), c(53).alias("confidence"), (F.col("toxic") == 1).alias("correct")))).alias("s")).select("s.*")


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a confidence and their input order."""
    conf = F.when(F.col("o_orderkey") % 17 != 0, ((F.col("o_orderkey") * 29) % 100) / 100.0)
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), conf.alias("confidence"), F.col("o_orderkey").alias("pos"))
