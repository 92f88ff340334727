"""Answers of judge models, parsed as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

ANSWER = "answer string, confidence string, reasoning string"


def json_object(c: Column) -> Column:
    """The JSON object of a model's answer: fenced, else the first without inner braces, else that without trailing commas."""
    valid = lambda s: F.when(F.try_parse_json(s).isNotNull(), s)
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    plain = F.regexp_extract(c, r"(?s)\{[^{}]*\}", 0)
    mended = F.regexp_replace(F.regexp_replace(plain, r",\s*\}", "}"), r",\s*\]", "]")
    return F.coalesce(*(valid(F.nullif(s, F.lit(""))) for s in (fenced, plain, mended)))


def judgment(value: Column, confidence: Column, status: Column) -> Column:
    return F.struct(value.alias("value"), confidence.alias("confidence"), status.alias("status"))


def _mentioned(response: Column, v1: Column, v2: Column) -> tuple[Column, Column]:
    text = F.lower(response)
    has = lambda v: F.coalesce((v != "") & F.contains(text, F.lower(v)), F.lit(False))
    return has(v1), has(v2)


def slm(response: Column, v1: Column, v2: Column) -> Column:
    """A small model's choice: JSON first, else the one value that the text mentions."""
    got = F.from_json(json_object(response), ANSWER)
    found = json_object(response).isNotNull()
    answer = got["answer"]
    unsure = answer.isNull() | (answer == "null") | (F.upper(answer) == "UNCERTAIN")
    confidence = F.least(F.coalesce(got["confidence"].try_cast("double"), F.lit(0.5)), F.lit(1.0))
    in1, in2 = _mentioned(response, v1, v2)
    value = F.when(found, F.when(~unsure, answer)).when(in1 & ~in2, v1).when(in2 & ~in1, v2)
    conf = F.when(found, F.when(~unsure, confidence).otherwise(0.0)).when(in1 != in2, 0.6).otherwise(0.0)
    return judgment(value, conf, F.when(value.isNotNull(), "RESOLVED").otherwise("UNCERTAIN"))


def slm_legacy(response: Column) -> Column:
    """The ANSWER / CONFIDENCE form."""
    answer = strip(F.regexp_extract(response, r"(?i)ANSWER:\s*(.+?)(?:\n|$)", 1))
    level = F.lower(F.regexp_extract(response, r"(?i)CONFIDENCE:\s*(high|medium|low)", 1))
    known = (answer != "") & (F.upper(answer) != "UNCERTAIN")
    confidence = F.when(level == "high", 0.9).when(level == "low", 0.5).otherwise(0.7)
    return judgment(F.when(known, answer), F.when(known, confidence).otherwise(0.0), F.when(known, "RESOLVED").otherwise("UNCERTAIN"))


def vlm_choice(response: Column, v1: Column, v2: Column) -> Column:
    """A vision model's CHOICE of A, B or neither, else the value its text contains."""
    choice = F.regexp_extract(F.upper(response), r"CHOICE:\s*([ABN]|NEITHER)", 1)
    in1, in2 = _mentioned(response, v1, v2)
    value = F.when(choice == "A", v1).when(choice == "B", v2).when(choice != "", F.lit(None)).when(in1, v1).when(in2, v2)
    conf = F.when(choice.isin("A", "B"), 0.9).when(choice != "", 0.3).when(in1 | in2, 0.75).otherwise(0.0)
    status = F.when(choice.isin("A", "B") | ((choice == "") & (in1 | in2)), "RESOLVED").otherwise("UNCERTAIN")
    return judgment(value, conf, status)


def vlm_text(response: Column, v1: Column, v2: Column, visual: Column) -> Column:
    """A vision model's free text: presence for visual fields, else the value it agrees with."""
    up, plain = F.upper(strip(response)), strip(response)
    unsure = F.contains(up, F.lit("UNCERTAIN")) | F.contains(up, F.lit("UNCLEAR"))
    clean = lambda v: F.regexp_replace(F.lower(v), r"\s+", "")
    same = lambda v: F.coalesce(F.contains(clean(plain), clean(v)) | F.contains(clean(v), clean(plain)), F.lit(False))
    yes = F.contains(up, F.lit("YES"))
    value = F.when(unsure, F.lit(None)).when(visual, F.when(yes, "true").otherwise("false")).when(same(v1), v1).when(same(v2), v2).otherwise(plain)
    conf = F.when(unsure, 0.0).when(visual, F.when(yes, 0.85).otherwise(0.8)).when(same(v1) | same(v2), 0.9).otherwise(0.8)
    return judgment(value, conf, F.when(unsure, "UNCERTAIN").otherwise("RESOLVED"))


def all_fields(response: Column) -> Column:
    """All six fields of one answer as a map; UNCERTAIN, NOT_FOUND and missing ones are null."""
    got = F.from_json(json_object(response), "map<string,string>")
    line = lambda f: strip(F.regexp_extract(response, rf"(?im)^\s*{f}\s*[:=]\s*(.+?)\s*$", 1))
    names = ("dealer_name", "model_name", "horse_power", "asset_cost", "signature", "stamp")
    value = lambda f: F.coalesce(F.try_element_at(got, F.lit(f)), line(f))
    known = lambda v: F.when((v != "") & ~F.upper(v).isin("UNCERTAIN", "NOT_FOUND", "NULL", "NONE"), v)
    return F.create_map(*(x for f in names for x in (F.lit(f), known(value(f)))))
