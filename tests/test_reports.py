"""Reports, calibration wiring, suppression, decoders and the command line."""

from __future__ import annotations

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom import cli
from docloom.functions import vision
from docloom.operators import calibration, consensus, cost, detection, evaluation, ladder, reports
from docloom.sources import readers, staging, synthetic, writers

BOX = "present boolean, bbox array<int>"


def _document(i, dealer="ABC Motors", power=45.0, price=450000.0, signed=True):
    mark = {"present": signed, "bbox": [10, 20, 60, 50] if signed else None}
    return {"dealer_name": dealer, "model_name": "Mahindra 575 DI", "horse_power": power, "asset_cost": price, "signature": mark, "stamp": {"present": False, "bbox": None}}


@pytest.fixture
def files(tmp_path):
    golden = {"metadata": {}, "results": [{"doc_id": f"d{i}", "filename": f"d{i}.png", "fields": _document(i)} for i in range(12)]}
    (tmp_path / "golden.json").write_text(json.dumps(golden))
    rows = [{"doc_id": f"d{i}", "fields": _document(i, dealer="Other" if i % 4 == 0 else "abc motors ", power=45.0 + i % 2, signed=i != 3), "confidence": 0.05 * i + 0.3, "processing_time_sec": 1.0, "cost_estimate_usd": 0.001} for i in range(12)]
    (tmp_path / "results").mkdir()
    (tmp_path / "results" / "r.json").write_text(json.dumps(rows))
    return tmp_path


def test_evaluate_and_diagnose(spark, files, capsys):
    both = ["--results", str(files / "results"), "--golden", str(files / "golden.json")]
    assert cli.main(["evaluate", *both, "--output", str(files / "e.json"), "--quiet"], spark) == 1
    report = json.loads((files / "e.json").read_text())
    by = {r["field_name"]: r["accuracy"] for r in report["fields"]}
    assert by["dealer_name"] == 0.75 and by["model_name"] == 1 and by["horse_power"] == 1 and by["signature"] == pytest.approx(11 / 12)
    assert report["documents"]["correct_documents"] == 8 and capsys.readouterr().out == ""
    assert cli.main(["evaluate", *both, "--strict", "--output", str(files / "s.json")], spark) == 1
    strict = {r["field_name"]: r["accuracy"] for r in json.loads((files / "s.json").read_text())["accuracy"]}
    assert strict["horse_power"] == 50 and strict["dealer_name"] == 75
    assert cli.main(["diagnose", *both, "--output", str(files / "d.json")], spark) == 0
    found = json.loads((files / "d.json").read_text())
    assert {(e["doc_id"], e["field"]) for e in found["errors"]} == {("d0", "dealer_name"), ("d4", "dealer_name"), ("d8", "dealer_name"), ("d3", "signature")}
    assert sum(r["errors"] for r in found["error_breakdown"]) == 4
    assert cli.main(["evaluate", "--results", str(files / "results"), "--golden", str(files / "none.json")], spark) == 2


def test_train_save_load_and_apply(spark, files):
    assert cli.main(["train-calibrator", "--results", str(files / "results"), "--golden", str(files / "golden.json"), "--output", str(files / "maps")], spark) == 0
    knots = readers.calibrator(spark, str(files / "maps"))
    assert {r["field_name"] for r in knots.select("field_name").distinct().collect()} == {"dealer_name", "model_name", "horse_power", "asset_cost", "signature", "stamp"}
    fields = spark.createDataFrame([("dealer_name", 0.3), ("model_name", 0.5), ("colour", 0.4)], "field_name string, confidence double")
    got = {r["field_name"]: r["calibrated_confidence"] for r in calibration.calibrate_fields(fields, knots).collect()}
    assert got == {"dealer_name": 0.0, "model_name": 1.0, "colour": 0.4}
    assert calibration.calibrate_fields(fields, None).filter("calibrated_confidence = confidence").count() == 3
    grid = calibration.at_points(knots).filter("field_name = 'model_name'").collect()
    assert len(grid) == 11 and {r["y"] for r in grid} == {1.0}
    saved = {"a": {"type": "binned", "bins": [0, 0.5, 1.0], "bin_means": [0.2, 0.8]}, "b": {"type": "isotonic_approx", "points": [0, 1], "values": [0.1, 0.9]}}
    (files / "maps.json").write_text(json.dumps(saved))
    loaded = sorted(tuple(r) for r in readers.calibrator(spark, str(files / "maps.json")).collect())
    assert loaded == [("a", 0.25, 0.2), ("a", 0.75, 0.8), ("b", 0.0, 0.1), ("b", 1.0, 0.9)]


def test_process_from_lines_and_images(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    marked = synthetic.plan(spark, 2)
    for r in synthetic.draw(marked).collect():
        (tmp_path / "pages" / f"{r['doc_id']}.png").write_bytes(r["content"])
    rows = []
    for engine, price in (("paddle", "450000"), ("deepseek", "900000")):
        for i, line in enumerate(["Dealer: ABC Motors", "Model: Mahindra 575 DI", "HP: 45 HP", f"Total: {price}"]):
            rows.append(("0", engine, i, line, [10, 20 + 30 * i, 200, 20], 0.9))
    spark.createDataFrame(rows, "doc_id string, engine string, line_no int, text string, bbox array<int>, confidence double").write.parquet(str(tmp_path / "lines"))
    args = ["process", "--lines", str(tmp_path / "lines"), "--images", str(tmp_path / "pages")]
    assert cli.main([*args, "--output", str(tmp_path / "out"), "--costs", str(tmp_path / "costs.json")], spark) == 0
    got = {r["doc_id"]: r for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert set(got) == {"0", "1"} and got["0"]["fields"]["dealer_name"] == "ABC Motors" and got["0"]["fields"]["horse_power"] == "45.0"
    assert 0 < got["0"]["cost_estimate_usd"] < 0.1
    costs = json.loads((tmp_path / "costs.json").read_text())
    assert costs["summary"]["documents"] >= 1 and any(x["component"] == "paddle_ocr" for d in costs["documents"] for x in d["components"])
    assert cli.main([*args, "--output", str(tmp_path / "more"), "--detailed", "--mode", "cpu-lite"], spark) == 0
    detailed = spark.read.json(str(tmp_path / "more")).filter("doc_id = '0'").first()
    assert detailed["success"] and detailed["fields"]["model_name"]["source"] == "tier1_consensus"
    assert cli.main(["synthesise", "--output", str(tmp_path / "made"), "--count", "3", "--no-stamps"], spark) == 0
    assert spark.read.json(str(tmp_path / "made" / "annotations")).select("class_name").distinct().collect()[0][0] == "signature"


def test_suppression_keeps_the_surest(spark):
    rng = np.random.default_rng(0)
    rows = [(i % 5, "stamp" if i % 2 else "signature", i, [int(v) for v in (*rng.integers(0, 60, 2), 40, 40)], round(float(rng.random()), 2)) for i in range(80)]
    got = {r["det_no"] for r in detection.suppress(spark.createDataFrame(rows, "doc_id long, class_name string, det_no int, bbox array<int>, confidence double")).collect()}
    want = set()
    for key in {r[:2] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[:2] == key and r[4] >= 0.5), key=lambda r: (-r[4], r[2])):
            if all(detection._overlap(r[3], k[3]) <= 0.45 for k in kept):
                kept.append(r)
        want |= {r[2] for r in kept}
    assert got == want


def test_suppression_is_one_plan_without_python_groups(spark):
    box = [0, 0, 10, 10]
    rows = [
        (1, "stamp", 0, box, 0.9, {"a": 1}),
        (1, "stamp", 1, box, 0.9, None),  # the earlier of equal ones stays
        (1, "stamp", 2, [20, 0, 10, 10], 0.6, None),
        (1, "signature", 3, box, 0.5, None),
        (1, "signature", None, box, 0.5, None),  # without a number last
        (2, "stamp", 4, [0, None, 10, 10], 0.8, None),  # a damaged box overlaps nothing
        (2, "stamp", 5, box, 0.7, None),
        (2, "stamp", 6, box, 0.4, None),
        (2, "stamp", 7, None, 0.9, None),
        (None, "stamp", 8, box, None, None),
        (None, "stamp", 9, box, 0.7, None),
        (3, "stamp", 10, box, float("nan"), None),  # no number is no surer than any
        (3, "stamp", 11, box, 0.6, None),
    ]
    found = spark.createDataFrame(rows, "doc_id long, class_name string, det_no int, bbox array<int>, confidence double, more map<string,int>")
    out = detection.suppress(found)
    assert "Pandas" not in out._jdf.queryExecution().toString() and out.schema.names == found.schema.names
    assert sorted(r["det_no"] for r in out.collect()) == [0, 2, 3, 4, 5, 9, 11]


def test_decoders():
    img = np.random.default_rng(1).integers(0, 256, (5, 7, 3)).astype(np.uint8)
    assert (vision.decode(vision.encode_png(img)) == img).all()
    rows = b"".join(r[:, ::-1].tobytes() + b"\0" * 3 for r in img[::-1])
    head = struct.pack("<2sIHHI", b"BM", 54 + len(rows), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 7, 5, 1, 24, 0, len(rows), 0, 0, 0, 0)
    assert (vision.decode(head + rows) == img).all()
    for order, mark in (("<", b"II*\0"), (">", b"MM\0*")):
        body = img.tobytes()
        entries = [(256, 3, 1, 7), (257, 3, 1, 5), (258, 3, 1, 8), (259, 3, 1, 1), (262, 3, 1, 2), (273, 4, 1, 8), (277, 3, 1, 3), (279, 4, 1, len(body))]
        table = struct.pack(order + "H", len(entries))
        for tag, kind, n, value in entries:
            table += struct.pack(order + "HHI", tag, kind, n) + (struct.pack(order + "HH", value, 0) if kind == 3 else struct.pack(order + "I", value))
        assert (vision.decode(mark + struct.pack(order + "I", 8 + len(body)) + body + table) == img).all()
    with pytest.raises(ValueError):
        vision.decode(b"nonsense")


def test_rules_of_reports(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first()["v"]
    assert one(reports.shown(F.lit("x" * 150))) == "x" * 100 and one(reports.shown(F.lit(0.0))) is None and one(reports.shown(F.lit(""))) is None
    assert [one(readers.present(F.lit(v))) for v in ("yes", "TRUE", "1", "no", "")] == [True, True, True, False, False]
    assert one(evaluation.plain_similarity(F.lit("ABC Motors"), F.lit("abc motors "))) == 100 and one(evaluation.plain_similarity(F.lit("ABC"), F.lit("abc motors"))) == 80
    assert one(evaluation.plain_similarity(F.lit("a b c"), F.lit("b c d"))) == pytest.approx(50)
    assert one(writers.iso(F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))) == "2024-01-02T03:04:05.000000"
    docs = spark.createDataFrame([("a", 0.125, 0.25, 0.00125), ("b", 0.375, 0.35, 0.1)], "doc_id string, confidence double, processing_time_sec double, cost_estimate_usd double")
    assert [(r["confidence"], r["processing_time_sec"]) for r in reports.simple_documents(docs).collect()][0] == (0.12, 0.2)
    log = cost.price(spark.createDataFrame([("a", "tier2_slm", 1.0), ("b", "tier3_vlm", 2.0)], "doc_id string, component string, latency double"))
    assert cost.of_document(log, "a").count() == 1
    metrics = reports.cost_metrics(reports.cost_report(log)["summary"])
    assert metrics["cost_per_document"] == pytest.approx(0.0105) and not metrics["within_budget"] and metrics["vlm_invocation_rate"] == 0.5


def test_two_values_of_an_engine(spark):
    rows = [(1, "paddle", "horse_power", None, v, None, None, c) for v, c in ((40.0, 0.5), (50.0, 0.9), (45.0, 0.9))]
    got = consensus.pair(spark.createDataFrame(rows, "doc_id long, engine string, field_name string, s string, n double, p boolean, b array<int>, confidence double")).first()
    assert (got["n1"], got["c1"], got["has2"]) == (50.0, 0.9, False)


def test_a_model_judge_runs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def judge(rows):
        def run(batches):
            for b in batches:
                seen.add(len(b))
                yield b.assign(value="45", confidence=0.9, status="RESOLVED")

        said = rows.mapInPandas(run, "doc_id long, v1 string, v2 string, value string, confidence double, status string")
        return said.withColumn("judgment", F.struct("value", "confidence", "status")).drop("value", "confidence", "status")

    rows = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "doc_id long, v1 string, v2 string")
    out = ladder._judged(rows, F.col("doc_id") == 1, judge, ladder.slm_fallback, "slm")
    assert out.count() == 2 and out.filter("slm.value = '45'").count() == 1 and seen.value == 1


def test_staging_needs_a_shared_folder(spark):
    assert staging.shared_folder(spark)
    df = staging.staged(spark.range(3), "test")
    assert df.count() == 3 and "docloom-test" in df.inputFiles()[0]
