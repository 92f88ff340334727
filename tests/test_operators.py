"""Consensus, ladder, evaluation, calibration, marks and sources on small rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.config import LadderConfig
from docloom.functions import responses, vision
from docloom.operators import calibration, consensus, cost, detection, evaluation, ladder, matching, results, sampling
from docloom.sources import readers, synthetic, writers

VALUE = "doc_id long, engine string, field_name string, s string, n double, p boolean, b array<int>, confidence double"


def _values(spark, *rows):
    return spark.createDataFrame(list(rows), VALUE)


def _pairs(spark):
    rows = []
    cases = [
        ("horse_power", None, 45.0, None, None, 46.0, None), ("asset_cost", None, 450000.0, None, None, 500000.0, None), ("horse_power", None, 100.0, None, None, 105.0, None),
        ("model_name", "Mahindra 575 DI", None, None, "John Deere 5050D", None, None), ("dealer_name", "ABC Motors", None, None, "ABC Motors", None, None),
        ("stamp", None, None, (True, [1, 2, 3, 4]), None, None, (False, None)), ("signature", None, None, (True, [10, 10, 100, 50]), None, None, (True, [12, 11, 98, 48])),
        ("signature", None, None, (False, None), None, None, (False, None)), ("dealer_name", None, None, None, None, None, None), ("model_name", "Mahindra 575", None, None, None, None, None),
    ]
    for i, (f, s1, n1, m1, s2, n2, m2) in enumerate(cases):
        for e, s, n, m, c in (("paddle", s1, n1, m1, 0.9), ("deepseek", s2, n2, m2, 0.8)):
            rows.append((i, e, f, s, n, m and m[0], m and m[1], c))
    return consensus.pair(_values(spark, *rows))


def test_conflicts(spark):
    got = {r["doc_id"]: (r["conflict"], r["conflict_type"]) for r in consensus.detect(_pairs(spark)).collect()}
    assert got == {
        0: (False, "numeric"), 1: (True, "numeric"), 2: (False, "numeric"), 3: (True, "textual"), 4: (False, "textual"),
        5: (True, "visual_presence"), 6: (False, "visual_bbox"), 7: (False, None), 8: (False, None), 9: (True, "missing_value"),
    }


def test_consensus_by_number_of_engines(spark):
    rows = _values(
        spark,
        (1, "paddle", "horse_power", None, 45.0, None, None, 0.9),
        (2, "paddle", "horse_power", None, 45.0, None, None, 0.9), (2, "deepseek", "horse_power", None, 46.0, None, None, 0.8),
        (3, "paddle", "asset_cost", None, 450000.0, None, None, 0.9), (3, "deepseek", "asset_cost", None, 500000.0, None, None, 0.8),
        (4, "paddle", "horse_power", None, 45.0, None, None, 0.0), (4, "deepseek", "horse_power", None, 45.0, None, None, 0.0),
    )
    got = {r["doc_id"]: r for r in consensus.consensus(consensus.detect(consensus.pair(rows))).collect()}
    assert (got[1]["n"], got[1]["source"]) == (45, "paddle")
    assert 45 < got[2]["n"] < 46 and got[2]["source"] == "weighted"
    assert (got[3]["n"], got[3]["resolution"]) == (450000, "needs_adjudication") and abs(got[3]["confidence"] - 0.63) < 1e-9
    assert (got[4]["n"], got[4]["source"]) == (45, "paddle")
    assert consensus.normalized({"a": 3, "b": 1}) == {"a": 0.75, "b": 0.25}


def _open(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, field_name string, conflict_type string, v1 string, v2 string, c1 double, c2 double, context string")


def test_rules(spark):
    rows = _open(
        spark,
        (1, "asset_cost", "numeric", "4,500", "4500", 0.9, 0.8, ""), (2, "asset_cost", "numeric", "45O0", "4500", 0.9, 0.8, ""), (3, "asset_cost", "numeric", "100", "250", 0.9, 0.8, "sum 250"),
        (4, "dealer_name", "textual", "ABC-Motors", "abcmotors", 0.9, 0.8, ""), (5, "dealer_name", "textual", "ABC", "ABC Motors", 0.9, 0.8, ""), (6, "dealer_name", "missing_value", None, "X", 0.9, 0.8, ""),
        (7, "dealer_name", "textual", "ABC", "XYZ", 0.9, 0.8, ""),
    )
    rule = ladder.tier1(*(F.col(c) for c in ("field_name", "conflict_type", "v1", "v2", "c1", "c2", "context")))
    got = {r["doc_id"]: r["r"] and (r["r"]["value"], round(r["r"]["confidence"], 3), r["r"]["method"]) for r in rows.select("doc_id", rule.alias("r")).collect()}
    assert got == {
        1: ("4500", 0.9, "numeric_normalization"), 2: ("4500", 0.81, "ocr_correction"), 3: ("250", 0.76, "context_match"), 4: ("ABC-Motors", 0.9, "text_normalization"),
        5: ("ABC Motors", 0.76, "subset_match"), 6: ("X", 0.64, "prefer_non_null"), 7: None,
    }


def test_judges_see_open_rows_only(spark):
    rows = _open(spark, *((i, "dealer_name", "textual", "ABC", "ABC Motors" if i % 2 else "XYZ", 0.9, 0.8, "") for i in range(20)))
    seen = spark.sparkContext.accumulator(0)

    def judge(open_):
        @F.pandas_udf("string")
        def ask(v):
            seen.add(len(v))
            return v

        return open_.withColumn("judgment", responses.judgment(ask("v2"), F.lit(0.9), F.lit("RESOLVED")))

    got = {r["doc_id"]: r["source"] for r in ladder.library_ladder(rows, LadderConfig(), slm=judge).collect()}
    assert set(got.values()) == {"subset_match", "slm_judge"} and len(got) == 20
    assert seen.value == 10
    with pytest.raises(ValueError):
        LadderConfig(mode="fast")


def test_dealer_joins(spark):
    rows = spark.createDataFrame([(1, "ABC Motor"), (2, "Completely Different Name"), (3, ""), (4, None), (5, "Dealers TAFE")], "doc_id long, raw string")
    names = ["ABC Motors Pvt Ltd", "XYZ Traders", "TAFE Dealers"]
    got = {r["doc_id"]: r for r in matching.match_dealers(rows, "raw", names).collect()}
    assert got[1]["matched"] and got[1]["value"] == "ABC Motors Pvt Ltd" or got[1]["score"] > 80
    assert not got[2]["matched"] and got[2]["value"] == "Completely Different Name"
    assert got[3]["value"] is None and got[4]["value"] is None and got[4]["confidence"] == 0
    locked = {r["doc_id"]: r["locked"] for r in matching.prefilter_dealers(rows.withColumn("other", F.lit(None).cast("string")), "raw", "other", names).collect()}
    assert locked[5] == "TAFE Dealers" and locked[2] is None
    with pytest.raises(ValueError):
        matching.dealer_table(spark, ["x"] * (matching.MOST_DEALERS + 1))


def test_line_merge_and_words(spark):
    line = "doc_id long, engine string, line_no int, text string, bbox array<int>, confidence double"
    lines = spark.createDataFrame([(1, "paddle", 0, "Total 5", [0, 0, 100, 20], 0.9), (1, "deepseek", 0, "total 5", [2, 0, 100, 20], 0.8), (1, "deepseek", 1, "x", [500, 500, 9, 9], 0.7)], line)
    got = sorted(((r["line1"], r["line2"], r["text"], r["agree"]) for r in matching.merge_lines(lines).collect()), key=str)
    assert got == [(0, 0, "Total 5", True), (None, 1, "x", False)]
    found = spark.createDataFrame([(1, "stamp", 0, [0, 0, 80, 40]), (1, "stamp", 1, [700, 0, 5, 5])], "doc_id long, class_name string, det_no int, bbox array<int>")
    assert {r["det_no"]: r["words"] for r in detection.words_in_boxes(found, lines).collect()} == {0: 4, 1: 0}


def test_evaluation(spark):
    long = "doc_id long, field_name string, s string, n double, p boolean, b array<int>"
    gold = spark.createDataFrame([(1, "horse_power", None, 100.0, None, None), (1, "model_name", "A 1", None, None, None), (1, "stamp", None, None, True, [0, 0, 10, 10])], long)
    pred = spark.createDataFrame([(1, "horse_power", None, 104.0, None, None), (1, "model_name", "a 1 ", None, None, None), (1, "stamp", None, None, True, [8, 8, 10, 10])], long)
    joined = evaluation.join_sides(pred, gold)
    got = {r["field_name"]: r["correct"] for r in evaluation.evaluate_fields(joined).collect()}
    assert got == {"horse_power": 1, "model_name": 1, "stamp": 0}
    strict = {r["field_name"]: (r["correct"], round(r["score"])) for r in evaluation.strict_scores(joined, form="xywh").collect()}
    assert strict == {"horse_power": (False, 0), "model_name": (True, 100), "stamp": (False, 2)}
    assert evaluation.evaluate_documents(joined, fields=3).first()["accuracy"] == 0
    assert [evaluation.exit_code(0.96), evaluation.exit_code(0.9), evaluation.exit_code(75, True), evaluation.exit_code(10, True)] == [0, 1, 1, 2]


def test_calibration(spark):
    rows = [("f", round(0.05 + 0.1 * (i % 10), 2), i % 10 >= 5) for i in range(100)] + [("few", 0.5, True)]
    samples = spark.createDataFrame(rows, "field_name string, confidence double, correct boolean")
    knots = calibration.fit_isotonic(samples)
    ys = [r["y"] for r in knots.orderBy("x").collect()]
    assert ys == sorted(ys) and set(ys) == {0.0, 1.0}
    assert {r["field_name"] for r in calibration.fit_bins(samples).collect()} == {"f"}
    got = {(r["field_name"], r["confidence"]): r["calibrated"] for r in calibration.apply_isotonic(samples, knots).collect()}
    assert got["f", 0.05] == 0 and got["f", 0.95] == 1 and got["few", 0.5] == 0.5
    one = spark.createDataFrame([("f", 1.0, True), ("f", 0.05, False)], "field_name string, confidence double, correct boolean")
    assert abs(calibration.calibration_error(one).first()["ece"] - 0.025) < 1e-9


def test_isotonic_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    x, y = np.round(rng.random(40), 2), rng.random(40) < 0.5
    samples = spark.createDataFrame([("f", float(a), bool(b)) for a, b in zip(x, y, strict=True)], "field_name string, confidence double, correct boolean")
    got = {r["x"]: r["y"] for r in calibration.fit_isotonic(samples).collect()}
    xs = np.unique(x)
    mean, mass = np.array([y[x == v].mean() for v in xs]), np.array([(x == v).sum() for v in xs])
    avg = lambda i, j: (mean[i : j + 1] * mass[i : j + 1]).sum() / mass[i : j + 1].sum()
    for k, v in enumerate(xs):
        want = max(min(avg(i, j) for j in range(k, len(xs))) for i in range(k + 1))
        assert abs(got[v] - want) < 1e-9


def test_costs_and_sources(spark):
    log = cost.price(spark.createDataFrame([(1, "tier2_slm", 1.0), (1, "tier3_vlm", 2.0), (2, "paddle_ocr", 3.0)], "doc_id long, component string, latency double"))
    row = cost.summary(log).first()
    assert float(row["total_cost"]) == 0.021 and row["vlm_rate"] == 0.5 and not row["vlm_ok"]
    by_doc, parts = ({r["doc_id"]: r["c"] for r in d.groupBy("doc_id").agg(F.sum("cost").alias("c")).collect()} for d in (cost.by_document(log), cost.breakdown(log, "doc_id")))
    assert by_doc == parts
    fields = spark.createDataFrame([("Paddle",), ("tier2_slm",), ("my_vlm_x",), ("tier1_consensus",)], "source string")
    assert list(results.source_statistics(fields).first()) == [1, 1, 1] and results.source_statistics(fields, strict=False).first()["ocr_fields"] == 2


def test_sampling(spark):
    rows = spark.createDataFrame([(i, None if i == 3 else i / 40, i) for i in range(40)], "doc_id long, confidence double, pos long")
    got = sampling.active_sample(rows).collect()
    assert len(got) == len({r["doc_id"] for r in got}) == 30 and got[0]["doc_id"] == 0 and got[1]["doc_id"] == 3
    assert sampling.unannotated(rows, rows.filter("doc_id < 30")).count() == 10


def test_pixels():
    cross = np.full((100, 100), 255, np.uint8)
    cross[48:52], cross[:, 48:52] = 0, 0
    assert 0 < vision.stroke_density(cross) < 1
    blobs = np.full((60, 200), 255, np.uint8)
    for i in range(6):
        blobs[20:40, 10 + 30 * i : 25 + 30 * i] = 0
    assert vision.components(blobs) == 6
    red = np.zeros((50, 50, 3), np.uint8)
    red[..., 0] = 200
    assert vision.color_score(red) > 0.5 and vision.color_score(red[..., ::-1]) > 0.5
    y, x = np.mgrid[:100, :100]
    disc = np.where((x - 50) ** 2 + (y - 50) ** 2 <= 1600, 255, 0).astype(np.uint8)
    assert vision.shape_scores(disc)[0] > 0.85
    # a dark disc is measured by the bright frame around it, which is a square
    assert abs(vision.shape_scores(255 - disc)[0] - np.pi / 4) < 0.01 and vision.shape_scores(255 - disc)[1] > 0.95
    frame = np.zeros((100, 100), np.uint8)
    frame[20:80, 10:90] = 255
    assert vision.shape_scores(frame)[1] > 0.8
    # the outline runs through pixel centres: a 60 by 80 block has 59 by 79
    assert [(b, a) for b, _, a in vision._parts(frame > 0)] == [([10, 20, 80, 60], 59.0 * 79.0)]
    pale = np.full((50, 50, 3), 255, np.uint8)
    pale[:25] = (200, 170, 170)
    pale[25:30], pale[30:40] = (200, 0, 0), (20, 20, 20)
    assert abs(vision.color_score(pale) - 15 / 50) < 1e-9
    ring = np.full((100, 100, 3), 255, np.uint8)
    ring[(np.hypot(x - 50, y - 50) < 12)] = (180, 0, 0)
    assert vision.stamp_boxes(ring) == [[39, 39, 23, 23]]
    noise = np.random.default_rng(0).integers(0, 256, (7, 9, 3)).astype(np.uint8)
    assert (vision.decode_png(vision.encode_png(noise)) == noise).all()
    with pytest.raises(ValueError):
        vision.decode_png(b"nonsense")


def test_pages_and_readers(spark, tmp_path):
    pages = synthetic.draw(synthetic.plan(spark, 3))
    got = detection.image_metrics(pages.unionByName(spark.createDataFrame([("bad", bytearray(b"x"))], "doc_id string, content binary"))).collect()
    assert {r["doc_id"]: r["error"] is None for r in got} == {"0": True, "1": True, "2": True, "bad": False}
    (tmp_path / "a.png").write_bytes(b"1"), (tmp_path / "b.PNG").write_bytes(b"2"), (tmp_path / "c.txt").write_bytes(b"3")
    found = readers.images(spark, str(tmp_path))
    assert {r["doc_id"] for r in found.collect()} == {"a", "b"}

    def ocr(content, name):
        if name == "b":
            raise OSError("down")
        return {"success": True, "results": [{"text": "HP 45", "bbox_points": [[0.9, 1.2], [10, 1], [10, 5.9], [0, 5]], "confidence": 0.9}, {"text": None, "confidence": None}]}

    lines = readers.ocr_lines(readers.ocr_answers(found, {"paddle": ocr}))
    assert {(r["doc_id"], r["text"], tuple(r["bbox"]), r["confidence"]) for r in lines.collect()} == {("a", "HP 45", (0, 1, 10, 4), 0.9), ("a", "", (0, 0, 0, 0), 0.0)}
    golden = tmp_path / "golden.json"
    fields = {"dealer_name": "A", "horse_power": 49.5, "stamp": {"present": True, "bbox": [1, 2, 3, 4]}}
    golden.write_text(json.dumps({"metadata": {}, "results": [{"doc_id": "1", "error": "x"}, {"doc_id": "1", "fields": fields}, {"doc_id": ""}]}))
    docs, values = readers.golden_results(spark, str(golden))
    assert [(r["doc_id"], r["error"], r["has_fields"]) for r in docs.collect()] == [("1", None, True)] and values.count() == 6
    assert readers.dealers(spark, str(tmp_path / "none.json")) == [] and len(readers.dealers(spark, None)) == 8
    writers.json_lines(docs, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1 and json.loads(writers.single(docs))["doc_id"] == "1"
