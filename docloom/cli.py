"""Command line: ``python -m docloom <command>``, also under ``spark-submit``.

Exit codes: 0 done or target met, 1 target missed or documents failed, 2 far
below the strict target or wrong arguments.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import LadderConfig
from .operators import calibration, consensus, cost, detection, evaluation, ladder, reports, results
from .plans import tables
from .sources import readers, synthetic, writers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("process", help="documents from reader lines, images or both to result records")
    p.add_argument("--lines", help="reader lines (Parquet: doc_id, engine, line_no, text, bbox, confidence)")
    p.add_argument("--images", help="folder of images")
    p.add_argument("--output", required=True)
    p.add_argument("--detailed", action="store_true", help="every field's record instead of values")
    p.add_argument("--mode", choices=("full", "cpu-lite"), default="full")
    p.add_argument("--dealers", help="dealer list (JSON array)")
    p.add_argument("--calibrator", help="saved calibrator (Parquet folder or JSON file)")
    p.add_argument("--costs", help="where to write the cost report")
    e = sub.add_parser("evaluate", help="accuracy of results against a golden file")
    e.add_argument("--results", required=True)
    e.add_argument("--golden", required=True)
    e.add_argument("--output")
    e.add_argument("--strict", action="store_true", help="fuzzy dealers, exact models and numbers")
    e.add_argument("--fuzzy-threshold", type=float, default=80.0)
    e.add_argument("--iou-threshold", type=float, default=0.5)
    e.add_argument("--quiet", action="store_true")
    d = sub.add_parser("diagnose", help="errors by class and field")
    d.add_argument("--results", required=True)
    d.add_argument("--golden", required=True)
    d.add_argument("--output")
    t = sub.add_parser("train-calibrator", help="confidence maps from results and a golden file")
    t.add_argument("--results", required=True)
    t.add_argument("--golden", required=True)
    t.add_argument("--output", required=True)
    s = sub.add_parser("synthesise", help="pages with signatures and stamps")
    s.add_argument("--output", required=True)
    s.add_argument("--count", type=int, default=100)
    s.add_argument("--no-signatures", action="store_true")
    s.add_argument("--no-stamps", action="store_true")
    s.add_argument("--seed", type=int, default=0)
    return top


def process(lines: DataFrame | None, images: DataFrame | None, c: LadderConfig = LadderConfig(), knots: DataFrame | None = None, dealers: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Final fields, every document's id, and the calls made, from reader lines and images."""
    if lines is None and images is None:
        raise ValueError("lines or images are needed")
    spark = (lines if lines is not None else images).sparkSession
    if lines is None:
        lines = spark.createDataFrame([], "doc_id string, engine string, line_no int, text string, bbox array<int>, confidence double")
    ids = lines.select(F.col("doc_id").cast("string").alias("doc_id"))
    ids = ids.unionByName(images.select("doc_id")).distinct() if images is not None else ids.distinct()
    found = detection.find(images, lines) if images is not None else spark.createDataFrame([], "doc_id string, class_name string, det_no int, bbox array<int>, confidence double, verified boolean")
    whole = lines.groupBy("doc_id", "engine").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n").alias("text"))
    values = tables.extracted(whole)
    marks = results.visual_defaults(ids, found).withColumns({"s": F.lit(None).cast("string"), "n": F.lit(None).cast("double")})
    engines = F.array(*(F.lit(e) for e in ("paddle", "deepseek")))
    values = values.unionByName(marks.withColumn("engine", F.explode(engines)), allowMissingColumns=True)
    agreed = consensus.consensus(consensus.detect(consensus.pair(values)))
    contexts = whole.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("engine", "text"))), lambda x: x["text"]), " ").alias("context"))
    final = ladder.pipeline_ladder(agreed, contexts, c, dealers=dealers)
    final = calibration.calibrate_fields(final, knots).join(marks.select("doc_id", "field_name", F.col("b").alias("bbox")), ["doc_id", "field_name"], "left")
    calls = cost.invocations(readers.full_text(lines).select("doc_id", "engine", "lines", "avg_confidence"), detection.counts(found), final)
    return final, ids, calls


def _process(spark: SparkSession, a: argparse.Namespace) -> int:
    lines = spark.read.parquet(a.lines).withColumn("doc_id", F.col("doc_id").cast("string")) if a.lines else None
    images = readers.images(spark, a.images) if a.images else None
    knots = readers.calibrator(spark, a.calibrator) if a.calibrator else None
    final, ids, calls = process(lines, images, LadderConfig(mode=a.mode), knots, readers.dealers(spark, a.dealers) if a.dealers else None)
    per = final.groupBy("doc_id").agg(F.sum("cost").alias("cost"))
    totals = ids.join(per, "doc_id", "left").select("doc_id", F.coalesce("cost", F.lit(0.0)).alias("cost"), F.lit(0.0).alias("latency"))
    if a.detailed:
        out = reports.detailed_documents(final, totals.withColumnsRenamed({"cost": "total_cost", "latency": "total_latency"}))
    else:
        confidence = ladder.document_confidence(final, column="calibrated_confidence")
        out = reports.simple_documents(results.documents(final, confidence, totals))
    writers.json_lines(out, a.output)
    if a.costs:
        log = cost.price(calls.withColumns({"latency": F.lit(0.0), "ts": F.current_timestamp()}))
        writers.report(reports.text(reports.cost_report(log)), a.costs)
    done = spark.read.json(a.output)
    n, wanted = done.count(), ids.count()
    print(f"{n} of {wanted} documents have results, run {spark.range(1).select(writers.run_id()).first()[0]}")
    return 0 if n == wanted else 1


def _sides(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    return readers.results(spark, a.results), readers.golden_or_none(spark, a.golden)


def _done(report: dict | list, a: argparse.Namespace) -> None:
    shown = reports.text(report)
    if a.output:
        writers.report(shown, a.output)
    if not getattr(a, "quiet", False):
        print(shown)


def _evaluate(spark: SparkSession, a: argparse.Namespace) -> int:
    predicted, golden = _sides(spark, a)
    joined = evaluation.join_sides(predicted, golden)
    if joined.isEmpty():
        print("no document is in both files")
        return 2
    if a.strict:
        report = reports.strict_report(joined, fuzzy=a.fuzzy_threshold, iou_threshold=a.iou_threshold)
        overall = next(r["accuracy"] for r in report["accuracy"] if r["field_name"] == "overall")
    else:
        report = reports.evaluation_report(joined, a.iou_threshold)
        overall = report["documents"]["accuracy"]
    _done(report, a)
    return evaluation.exit_code(overall, a.strict)


def _diagnose(spark: SparkSession, a: argparse.Namespace) -> int:
    _done(reports.diagnostics_report(*_sides(spark, a)), a)
    return 0


def _train(spark: SparkSession, a: argparse.Namespace) -> int:
    predicted, golden = _sides(spark, a)
    _, metrics = calibration.train(predicted, golden, path=a.output)
    print(reports.text([r.asDict() for r in metrics.orderBy("field_name").collect()]))
    return 0


def _synthesise(spark: SparkSession, a: argparse.Namespace) -> int:
    synthetic.write(spark, a.output, a.count, not a.no_signatures, not a.no_stamps, a.seed)
    return 0


COMMANDS = {"process": _process, "evaluate": _evaluate, "diagnose": _diagnose, "train-calibrator": _train, "synthesise": _synthesise}


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("docloom").getOrCreate()
    return COMMANDS[a.command](spark, a)
