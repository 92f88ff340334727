"""Scalar fixtures of the extraction functions."""

import pytest
from pyspark.sql import functions as F

from docloom.functions import fuzzy, geometry, numeric, responses, text


@pytest.fixture(scope="module")
def one(spark):
    row = spark.range(1)

    def run(*columns):
        return list(row.select(*columns).first())

    return run


def test_digits_and_currency(one):
    assert one(text.native_digits(F.lit("१23૪5")), text.native_digits(F.lit("Hello"))) == ["12345", "Hello"]
    raw = ["₹ 1,23,456", "Rs. 45000", "$ 1234", "INR 45000", "45000/-"]
    assert one(*(text.strip_currency(F.lit(r)) for r in raw)) == ["1,23,456", "45000", "1234", "45000", "45000"]


def test_numeric(one):
    raw = ["45000", "₹४,५०,०००", "4.5 lakh", "4.5 lac", "450000-480000", "2 crore", "none", ""]
    got = one(*(text.numeric(F.lit(r)) for r in raw))
    assert [g["value"] for g in got] == [45000, 450000, 450000, 450000, 465000, 20000000, None, None]
    assert got[0]["confidence"] > 0.9 > got[4]["confidence"] and got[6]["confidence"] == 0
    strict, intended = one(text.numeric(F.lit("12 Ltd")), text.numeric(F.lit("12 Ltd"), strict=False))
    assert (strict["value"], intended["value"]) == (1200000, 12)


def test_suffixes(one):
    assert one(text.strip_suffixes(F.lit("XYZ Traders Pvt Ltd")), text.strip_suffixes(F.lit("Tractors Agency"))) == ["xyz", "agency"]
    assert one(text.strip_suffixes(F.lit("ABC Motors Pvt. Ltd."), False), text.strip_suffixes(F.lit("Dealers & Enterprises"), False)) == ["abc", "dealers"]


def test_horse_power_cost_and_model(one):
    hp = one(*(text.horse_power(F.lit(r)) for r in ("45 HP", "50 BHP", "40-50 HP", "45", "5", None)))
    assert [h["value"] for h in hp] == [45, 50, 45, 45, None, None] and hp[3]["confidence"] < 0.8 < 0.9 < hp[0]["confidence"]
    cost = one(*(text.asset_cost(F.lit(r)) for r in ("450000", "₹4,50,000", "4.5 Lakh", "100", "0")))
    assert [c["value"] for c in cost] == [450000, 450000, 450000, 100, None] and cost[3]["confidence"] < 0.7
    model = one(*(text.model_name(F.lit(r)) for r in ("mahindra 575 DI", "john deere, 45 HP", "Tractor", "")))
    assert [(m["value"], m["confidence"]) for m in model] == [("Mahindra 575 DI", 0.9), ("john deere, 45 HP", 0.85), ("Tractor", 0.5), (None, 0.0)]


def test_extraction_and_cleaning(one):
    page = F.lit("Dealer: ABC Motors\nModel: Mahindra 575 DI\nHP: 45 HP\nTotal: 450000")
    got = one(*(text.extract(page, f) for f in ("dealer_name", "model_name", "horse_power", "asset_cost")))
    assert [g["value"] for g in got] == ["ABC Motors", "Mahindra 575 DI", 45, 450000]
    rupees = F.lit("Total Amount: Rs. 500000")
    assert one(text.extract(rupees, "asset_cost")["value"], text.extract(rupees, "asset_cost", strict=False)["value"]) == [None, 500000]
    grounded = "=====\nBASE: torch.Size([1, 256])\nPATCHES: 3\n<|ref|>x</ref><|det|>[[1, 2,3,4]]</det>\n\n<|grounding|> y \nimage size: [[1]]"
    assert one(text.clean_grounded(F.lit(grounded))) == ["=====\nx\ny\nimage size: [[1]]"]


def test_similarity(one):
    assert fuzzy._set_ratio("abc motors", "abc motors") == 100 and fuzzy._set_ratio("abc motors", "abc motor") > 80
    assert fuzzy._set_ratio("abc", "xyz") < 50 and fuzzy._set_ratio("", "x") == 0 and fuzzy._set_ratio("a b", "a b c") == 100
    assert fuzzy._sort_ratio("b a", "a b") == 100 and fuzzy.lcs("kitten", "sitting") == 4
    same, part, none = one(text.token_overlap(F.lit("a b"), F.lit("A b")), text.token_overlap(F.lit("abc def"), F.lit("abc xyz")), text.token_overlap(F.lit("abc"), F.lit("xyz")))
    assert same == 1 and 0.2 < part < 0.6 and none == 0


def test_lcs_by_random_comparison():
    import random

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert fuzzy.lcs(a, b) == table[-1][-1]


def test_numbers_and_boxes(one):
    d = lambda a, b: numeric.relative_diff(F.lit(a), F.lit(b))
    assert one(d(0.0, 0.0), d(100.0, 105.0) < 0.05) == [0.0, True]
    box = lambda *v: F.array(*(F.lit(x) for x in v))
    assert one(geometry.iou(box(0, 0, 10, 10), box(0, 0, 10, 10)), geometry.iou(box(0, 0, 10, 10), box(20, 20, 5, 5)), geometry.iou(box(1, 2), box(0, 0, 1, 1))) == [1.0, 0.0, 0.0]
    assert one(geometry.iou(box(0, 0, 0, 0), box(0, 0, 2, 2), "xyxy"), geometry.to_xyxy(box(1, 2, 3, 4)), geometry.to_xywh(box(1, 2, 4, 6))) == [0.0, [1, 2, 4, 6], [1, 2, 3, 4]]


def test_model_answers(one):
    v1, v2 = F.lit("ABC"), F.lit("XYZ")
    got = one(*(responses.slm(F.lit(r), v1, v2) for r in ('```json\n{"answer": "ABC", "confidence": 0.9}\n```', '{"answer": "XYZ", "confidence": "0.8",}', '{"answer": null}', "surely xyz", "abc or xyz")))
    assert [(g["value"], g["confidence"]) for g in got] == [("ABC", 0.9), ("XYZ", 0.8), (None, 0.0), ("XYZ", 0.6), (None, 0.0)]
    got = one(*(responses.vlm_choice(F.lit(r), v1, v2) for r in ("CHOICE: A", "choice: b", "CHOICE: NEITHER", "it reads abc", "?")))
    assert [(g["value"], g["confidence"]) for g in got] == [("ABC", 0.9), ("XYZ", 0.9), (None, 0.3), ("ABC", 0.75), (None, 0.0)]
    fields = one(responses.all_fields(F.lit('{"dealer_name": "ABC", "horse_power": "UNCERTAIN"}')))[0]
    assert fields["dealer_name"] == "ABC" and fields["horse_power"] is None and fields["stamp"] is None
