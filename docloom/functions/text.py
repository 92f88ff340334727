"""Parsing of fields from multilingual invoice text, as Column expressions.

Every function takes and returns Columns.  ``strict=True`` keeps quirks of the
documented behaviour (see README); ``False`` applies the intended rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Devanagari and Gujarati digits.
NATIVE, ASCII = "०१२३४५६७८९૦૧૨૩૪૫૬૭૮૯", "01234567890123456789"
# Currency marks, removed in this order.
CURRENCY = (r"₹\s*", r"\$\s*", r"Rs\.?\s*", r"INR\s*", r"USD\s*", r"rupees?\s*", r"/-")
# Company suffixes, removed in this order.
SUFFIXES = (
    r"\bpvt\.?\b", r"\bprivate\b", r"\bltd\.?\b", r"\blimited\b", r"\btraders\b", r"\bmotors\b", r"\btractors\b", r"\bagencies\b",
    r"\benterprises\b", r"\bco\.?\b", r"\binc\.?\b", r"\bcorp\.?\b", r"\bllc\b", r"\bllp\b", r"\b&\b", r"\band\b",
)
# Tractor brands, searched in this order.
BRANDS = (
    "mahindra", "john deere", "eicher", "massey ferguson", "swaraj", "sonalika", "tafe", "farmtrac", "new holland",
    "kubota", "escorts", "preet", "force", "captain", "vst", "indo farm", "ace", "powertrac",
)
# Where a field's value starts in the text; the first pattern that matches wins.
DEALER_AT = (r"(?:dealer|seller|vendor|from|supplier)[:\s]+([^\n]+)", r"(?:name of dealer|dealer name)[:\s]+([^\n]+)", r"(?:sold by|authorized dealer)[:\s]+([^\n]+)")
MODEL_AT = (r"(?:model|tractor model|vehicle model)[:\s]+([^\n]+)", r"(?:description|product)[:\s]+([^\n]+)")
COST_AT = (
    r"(?:total|amount|price|cost|value)[:\s]*([₹$]?\s*[\d,\.]+(?:\s*(?:lakh|lac|crore|cr))?)",
    r"(?:invoice value|asset cost|asset value)[:\s]*([₹$]?\s*[\d,\.]+)",
    r"(?:grand total|net amount)[:\s]*([₹$]?\s*[\d,\.]+)",
)
COST_AT_INTENDED = tuple(p.replace("[₹$]?", r"(?:₹|\$|Rs\.?|INR)?") for p in COST_AT)
# Letters read for digits.
MISREAD, READ = "OolISBZGqg", "0011582699"
HP_RANGE = r"(\d+)\s*[-–—to]+\s*(\d+)\s*(?:HP|BHP|H\.?P\.?)"
HP_ONE = r"(\d+)\s*(?:HP|BHP|H\.?P\.?)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _found(c: Column, pattern: str, group: int = 1, ignore_case: bool = True) -> Column:
    """The group of the first match, null without one."""
    got = F.regexp_extract(c, ("(?i)" if ignore_case else "") + pattern, group)
    return F.get(F.filter(F.array(got), lambda g: g != ""), F.lit(0))


def _ends(c: Column, span: str, ignore_case: bool = True) -> Column:
    """Both ends of the first range; the pattern is searched once where there is none."""
    return let(_found(c, span, 0, ignore_case), lambda r: F.struct(*(F.when(r.isNotNull(), _found(r, span, g, ignore_case).try_cast("double")).alias(n) for g, n in ((1, "low"), (2, "high")))))


def parsed(value: Column, confidence: Column) -> Column:
    return F.struct(value.alias("value"), confidence.alias("confidence"))


def native_digits(c: Column) -> Column:
    return F.translate(c, NATIVE, ASCII)


def strip_currency(c: Column) -> Column:
    for p in CURRENCY:
        c = F.regexp_replace(c, "(?i)" + p, "")
    return strip(c)


def strip_suffixes(c: Column, strict: bool = True) -> Column:
    """Lower-case company name without suffixes; the intended form drops the marks they leave behind as well."""
    c = F.lower(c)
    for p in SUFFIXES:
        c = F.regexp_replace(c, p, "")
    if not strict:
        c = F.regexp_replace(c, r"[.&]", " ")
    return strip(F.regexp_replace(c, r"\s+", " "))


def numeric(c: Column, strict: bool = True) -> Column:
    """Amount and confidence: lakh, crore, range mean, then the first number."""
    number = r"(\d+\.?\d*)"
    span = number + r"\s*[-–—to]+\s*" + number

    def parts(t: Column) -> Column:
        lakh = _found(t, number + (r"\s*(?:lakh|lac|l)" if strict else r"\s*(?:lakh|lac|l)s?\b"))
        crore = _found(t, number + r"\s*(?:crore|cr)")
        found = (("lakh", lakh), ("crore", crore), ("one", _found(t, number)))
        return F.struct(_ends(t, span, False).alias("range"), *(x.try_cast("double").alias(n) for n, x in found))

    def choose(x: Column) -> Column:
        value = F.coalesce(x["lakh"] * 100000, x["crore"] * 10000000, (x["range"]["low"] + x["range"]["high"]) / 2, x["one"])
        big = x["lakh"].isNotNull() | x["crore"].isNotNull()
        return parsed(value, F.when(big, 0.9).when(x["range"]["low"].isNotNull(), 0.85).when(x["one"].isNotNull(), 0.95).otherwise(0.0))

    plain = F.replace(strip_currency(native_digits(c)), F.lit(","), F.lit(""))
    return let(let(plain, parts), choose)


def _has(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def model_name(c: Column) -> Column:
    """Brand and model tail, with the horse power added if the name lacks it."""

    def parts(c: Column, lower: Column) -> Column:
        brand, tail = F.lit(None).cast("string"), F.lit(None).cast("string")
        for b in reversed(BRANDS):
            brand = F.when(lower.contains(b), b.title()).otherwise(brand)
            tail = F.when(lower.contains(b), _found(c, b + r"\s*([A-Z0-9\-\s]+(?:DI|HP|XT|XL|TURBO)?)")).otherwise(tail)
        hp = _found(c, r"(\d+)\s*(?:HP|BHP|H\.P\.)")
        return F.struct(brand.alias("brand"), tail.alias("tail"), hp.alias("hp"), strip(c).alias("all"))

    def name(x: Column) -> Column:
        own = F.when(x["tail"].isNotNull(), F.concat(x["brand"], F.lit(" "), strip(x["tail"]))).otherwise(x["all"])
        return F.struct(x["brand"].alias("brand"), x["tail"].alias("tail"), x["hp"].alias("hp"), own.alias("name"))

    def choose(x: Column) -> Column:
        base = F.when(x["tail"].isNotNull(), 0.9).when(x["brand"].isNotNull(), 0.8).otherwise(0.5)
        add = x["brand"].isNotNull() & x["hp"].isNotNull() & ~x["name"].contains(x["hp"])
        full = F.when(add, F.concat(x["name"], F.lit(" "), x["hp"], F.lit("HP"))).otherwise(x["name"])
        return parsed(full, F.when(x["hp"].isNotNull(), F.greatest(base, F.lit(0.85))).otherwise(base))

    def of(c: Column) -> Column:
        found = let(let(let(F.lower(c), lambda lower: parts(c, lower)), name), choose)
        return F.when(_has(c), found).otherwise(parsed(F.lit(None).cast("string"), F.lit(0.0)))

    return let(c, of)


def horse_power(c: Column) -> Column:
    def parts(t: Column) -> Column:
        found = (("one", _found(t, HP_ONE)), ("any", _found(t, r"(\d+)")))
        return F.struct(_ends(t, HP_RANGE).alias("range"), *(x.try_cast("double").alias(n) for n, x in found))

    def choose(x: Column) -> Column:
        plausible = F.when(x["any"].between(10, 200), x["any"])
        value = F.coalesce((x["range"]["low"] + x["range"]["high"]) / 2, x["one"], plausible)
        return parsed(value, F.when(x["range"]["low"].isNotNull(), 0.85).when(x["one"].isNotNull(), 0.95).when(plausible.isNotNull(), 0.5).otherwise(0.0))

    return let(let(native_digits(c), parts), choose)


def asset_cost(c: Column, strict: bool = True) -> Column:
    def choose(n: Column) -> Column:
        value, confidence = n["value"], n["confidence"]
        typical, positive = value.between(50000, 5000000), value > 0
        return parsed(F.when(positive, value), F.when(typical, confidence).when(positive, confidence * 0.7).otherwise(0.0))

    return let(numeric(c, strict), choose)


def _first(c: Column, patterns: tuple[str, ...]) -> Column:
    return F.coalesce(*(_found(c, p) for p in patterns))


def dealer_text(c: Column) -> Column:
    """The dealer's name as written, null if none is stated."""
    return strip(_first(c, DEALER_AT))


def extract(c: Column, name: str, strict: bool = True) -> Column:
    """``value, confidence`` of one field of a whole text, without a dealer list."""
    if name == "dealer_name":
        return let(dealer_text(c), lambda raw: parsed(raw, F.when(raw.isNotNull(), 0.7).otherwise(0.0)))
    if name == "model_name":
        return model_name(F.coalesce(strip(_first(c, MODEL_AT)), c))
    if name == "horse_power":
        return horse_power(c)
    if name == "asset_cost":
        return asset_cost(strip(_first(c, COST_AT if strict else COST_AT_INTENDED)), strict)
    raise ValueError(f"no text field is named {name}")


def normalize_number_text(c: Column) -> Column:
    """The first number of a text as written, or the cleaned text."""
    return let(F.regexp_replace(strip_currency(native_digits(c)), r"[,\s]", ""), lambda t: F.coalesce(_found(t, r"(\d+\.?\d*)"), t))


def undo_misreadings(c: Column) -> Column:
    return F.translate(c, MISREAD, READ)


def normalize_text(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", ""), r"\s+", " "))


def tokens(c: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two sets; 0 if either is empty."""
    sets = F.struct(a.alias("a"), b.alias("b"))
    return let(sets, lambda x: F.when((F.size(x["a"]) > 0) & (F.size(x["b"]) > 0), F.size(F.array_intersect(x["a"], x["b"])) / F.size(F.array_union(x["a"], x["b"]))).otherwise(0.0))


def token_overlap(a: Column, b: Column) -> Column:
    return F.when(_has(a) & _has(b), jaccard(tokens(a), tokens(b))).otherwise(0.0)


def texts_agree(a: Column, b: Column, least: float = 0.8) -> Column:
    """Equal when trimmed and lower-case, or similar sets of characters."""
    x, y = strip(F.lower(a)), strip(F.lower(b))
    chars = lambda c: F.array_distinct(F.filter(F.split(c, ""), lambda z: z != ""))
    return (x == y) | (jaccard(chars(x), chars(y)) >= least)


def special_ratio(v: Column) -> Column:
    """Share of characters that are neither letters, digits nor spaces."""
    return F.length(F.regexp_replace(v, r"[\p{L}\p{N} ]", "")) / F.greatest(F.length(v), F.lit(1))


def quality_pipeline(v: Column, confidence: Column) -> Column:
    """Score of a value in the pipeline's fallback."""
    score = confidence * F.when(F.length(v) > 100, 0.5).otherwise(1.0) * F.when(special_ratio(v) > 0.3, 0.6).otherwise(1.0)
    return F.when(v.isNull(), 0.0).otherwise(score)


def quality_ladder(v: Column, confidence: Column, name: Column) -> Column:
    """Score of a value in the library ladder's fallback."""
    n, special, number = F.length(v), special_ratio(v), v.try_cast("double")
    first = F.substring(v, 1, 1)
    upper = (F.upper(v) == v) & (F.lower(v) != v)
    lower = (F.lower(v) == v) & (F.upper(v) != v) & (n > 3)
    text = name.isin("dealer_name", "model_name")
    plausible = (
        F.when((name == "horse_power") & number.between(15, 120), 1.2)
        .when((name == "horse_power") & ((number > 500) | (number < 5)), 0.3)
        .when((name == "asset_cost") & number.between(100000, 2000000), 1.2)
        .when((name == "asset_cost") & ((number < 1000) | (number > 10000000)), 0.3)
        .otherwise(1.0)
    )
    score = (
        confidence
        * F.when(n > 100, 0.3).when(n > 50, 0.6).when(n > 30, 0.8).otherwise(1.0)
        * F.when(special > 0.3, 0.4).when(special > 0.15, 0.7).otherwise(1.0)
        * plausible
        * F.when(text & (first.rlike(r"\p{Lu}")), 1.1).otherwise(1.0)
        * F.when(text & (upper | lower), 0.8).otherwise(1.0)
    )
    return F.when(v.isNull(), 0.1).otherwise(F.least(score, F.lit(1.0)))


# Log lines and markup in the output of a grounded reader.
LOG_LINE = r"PATCHES:|torch\.Size"
MARKUP = (r"<\|ref\|>|</ref>|<\|det\|>|</det>|<\|grounding\|>", r"\[\[\d+,\s*\d+,\s*\d+,\s*\d+\]\]")


def clean_grounded(c: Column) -> Column:
    """Text of a grounded reader without its markup, log lines and blank lines."""

    def clean(line: Column) -> Column:
        for pattern in MARKUP:
            line = F.regexp_replace(line, pattern, "")
        return strip(line)

    kept = F.filter(F.split(c, "\n"), lambda x: ~x.rlike(LOG_LINE))
    return F.array_join(F.filter(F.transform(kept, clean), lambda x: x != ""), "\n")
