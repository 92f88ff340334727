"""DuckDB SQL for the registered queries, written against the driver's tables."""

from __future__ import annotations

from ..config import DEALERS, FIELDS
from ..functions.text import BRANDS, COST_AT, CURRENCY, DEALER_AT, HP_ONE, HP_RANGE, MARKUP, MISREAD, MODEL_AT, NATIVE, READ, SUFFIXES
from ..functions.text import ASCII as DIGITS
from .tables import COMPONENTS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


def native(x: str) -> str:
    return f"translate({x}, {q(NATIVE)}, {q(DIGITS)})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def currency(x: str) -> str:
    for p in CURRENCY:
        x = f"regexp_replace({x}, {q(p)}, '', 'gi')"
    return strip(x)


def suffixes(x: str) -> str:
    x = f"lower({x})"
    for p in SUFFIXES:
        x = f"regexp_replace({x}, {q(p)}, '', 'g')"
    return strip(f"regexp_replace({x}, '\\s+', ' ', 'g')")


def found(x: str, p: str, group: int = 1, case: bool = False) -> str:
    return f"nullif(regexp_extract({x}, {q(p)}, {group}{'' if case else ', ' + q('i')}), '')"


def first(x: str, patterns) -> str:
    return "coalesce(" + ", ".join(found(x, p) for p in patterns) + ")"


def dbl(x: str) -> str:
    return f"try_cast({x} AS DOUBLE)"


NUM = r"(\d+\.?\d*)"
SPAN = NUM + r"\s*[-–—to]+\s*" + NUM


def numeric_ctes(src: str, keys: str, raw: str, out: str) -> str:
    """CTEs that parse ``raw`` of ``src`` into ``value, confidence``."""
    return f"""
    {out}_t AS (SELECT {keys}, replace({currency(native(raw))}, ',', '') AS t FROM {src}),
    {out}_p AS (SELECT {keys}, {dbl(found('t', NUM + r'\s*(?:lakh|lac|l)'))} AS lakh, {dbl(found('t', NUM + r'\s*(?:crore|cr)'))} AS crore,
      {dbl(found('t', SPAN, 1, True))} AS low, {dbl(found('t', SPAN, 2, True))} AS high, {dbl(found('t', NUM))} AS one FROM {out}_t),
    {out} AS (SELECT {keys}, coalesce(lakh * 100000, crore * 10000000, (low + high) / 2, one) AS value,
      CASE WHEN lakh IS NOT NULL OR crore IS NOT NULL THEN 0.9::DOUBLE WHEN low IS NOT NULL THEN 0.85::DOUBLE WHEN one IS NOT NULL THEN 0.95::DOUBLE ELSE 0::DOUBLE END AS confidence FROM {out}_p)"""


def cost_ctes(src: str, keys: str, raw: str, out: str) -> str:
    return numeric_ctes(src, keys, raw, out + "_n") + f""",
    {out} AS (SELECT {keys}, CASE WHEN value > 0 THEN value END AS value,
      CASE WHEN value BETWEEN 50000 AND 5000000 THEN confidence WHEN value > 0 THEN confidence * 0.7::DOUBLE ELSE 0::DOUBLE END AS confidence FROM {out}_n)"""


def hp_ctes(src: str, keys: str, raw: str, out: str) -> str:
    return f"""
    {out}_t AS (SELECT {keys}, {native(raw)} AS t FROM {src}),
    {out}_p AS (SELECT {keys}, {dbl(found('t', HP_RANGE, 1))} AS low, {dbl(found('t', HP_RANGE, 2))} AS high, {dbl(found('t', HP_ONE))} AS one, {dbl(found('t', '(\\d+)'))} AS a FROM {out}_t),
    {out} AS (SELECT {keys}, coalesce((low + high) / 2, one, CASE WHEN a BETWEEN 10 AND 200 THEN a END) AS value,
      CASE WHEN low IS NOT NULL THEN 0.85::DOUBLE WHEN one IS NOT NULL THEN 0.95::DOUBLE WHEN a BETWEEN 10 AND 200 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS confidence FROM {out}_p)"""


def model_ctes(src: str, keys: str, raw: str, out: str) -> str:
    brand = "CASE " + " ".join(f"WHEN contains(lower({raw}), {q(b)}) THEN {q(b.title())}" for b in BRANDS) + " END"
    tail = "CASE " + " ".join(f"WHEN contains(lower({raw}), {q(b)}) THEN {found(raw, b + r'\s*([A-Z0-9\-\s]+(?:DI|HP|XT|XL|TURBO)?)')}" for b in BRANDS) + " END"
    return f"""
    {out}_p AS (SELECT {keys}, {raw} AS raw_, {brand} AS brand, {tail} AS tail, {found(raw, r'(\d+)\s*(?:HP|BHP|H\.P\.)')} AS php FROM {src}),
    {out}_n AS (SELECT *, CASE WHEN tail IS NOT NULL THEN brand || ' ' || {strip('tail')} ELSE {strip('raw_')} END AS nm,
      CASE WHEN tail IS NOT NULL THEN 0.9::DOUBLE WHEN brand IS NOT NULL THEN 0.8::DOUBLE ELSE 0.5::DOUBLE END AS base FROM {out}_p),
    {out} AS (SELECT {keys},
      CASE WHEN coalesce(raw_, '') = '' THEN NULL WHEN brand IS NOT NULL AND php IS NOT NULL AND NOT contains(nm, php) THEN nm || ' ' || php || 'HP' ELSE nm END AS value,
      CASE WHEN coalesce(raw_, '') = '' THEN 0::DOUBLE WHEN php IS NOT NULL THEN greatest(base, 0.85::DOUBLE) ELSE base END AS confidence FROM {out}_n)"""


def tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split_regex(lower({x}), '\\s+'), lambda w: w <> ''))"


def jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) ELSE 0::DOUBLE END"


def lcs(a: str, b: str) -> str:
    """Longest common subsequence: a row of the table per character of ``a``."""
    row = f"lambda r, c: list_transform(range(1, len({b}) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(r[k], CASE WHEN k > 1 AND unicode({b}[k - 1]) = c[1] THEN r[k - 1] + 1 ELSE 0 END))))"
    start = f"[list_transform(range(len({b}) + 1), lambda x: 0)]"
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 ELSE list_max(list_reduce(list_concat({start}, list_transform(string_split({a}, ''), lambda c: [unicode(c)])), {row})) END"


def set_ratio_ctes(src: str, out: str, fold: bool = True) -> str:
    """CTEs scoring distinct ``a, b`` of ``src`` by token sets: ``a, b, score``."""
    words = (lambda x: f"list_sort({tokens(x)})") if fold else (lambda x: f"list_sort(list_distinct(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')))")
    return f"""
    {out}_w AS (SELECT DISTINCT a, b, {words('a')} AS ta, {words('b')} AS tb FROM {src} WHERE a IS NOT NULL AND b IS NOT NULL),
    {out}_d AS (SELECT a, b, ta, tb, len(list_intersect(ta, tb)) AS n_both, len(array_to_string(list_sort(list_intersect(ta, tb)), ' ')) AS common,
      array_to_string(list_filter(ta, lambda w: NOT list_contains(tb, w)), ' ') AS da, array_to_string(list_filter(tb, lambda w: NOT list_contains(ta, w)), ' ') AS db FROM {out}_w),
    {out}_l AS (SELECT *, CASE WHEN n_both > 0 THEN 1 ELSE 0 END AS gap, CASE WHEN n_both > 0 AND (da = '' OR db = '') THEN 0 ELSE {lcs('da', 'db')} END AS l FROM {out}_d),
    {out}_r AS (SELECT *, common + gap + len(da) AS x, common + gap + len(db) AS y FROM {out}_l),
    {out} AS (SELECT a, b, CASE
      WHEN len(ta) = 0 OR len(tb) = 0 THEN 0::DOUBLE
      WHEN n_both > 0 AND (da = '' OR db = '') THEN 100::DOUBLE
      WHEN n_both = 0 THEN 100::DOUBLE - 100::DOUBLE * (len(da) + len(db) - 2 * l) / (x + y)
      ELSE greatest(100::DOUBLE - 100::DOUBLE * (len(da) + len(db) - 2 * l) / (x + y), 100::DOUBLE - 100::DOUBLE * (gap + len(da)) / (common + x), 100::DOUBLE - 100::DOUBLE * (gap + len(db)) / (common + y)) END AS score FROM {out}_r)"""


def sort_ratio_ctes(src: str, out: str) -> str:
    words = lambda x: f"array_to_string(list_sort(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')), ' ')"
    return f"""
    {out}_w AS (SELECT DISTINCT a, b, {words('a')} AS sa, {words('b')} AS sb FROM {src} WHERE a IS NOT NULL AND b IS NOT NULL),
    {out} AS (SELECT a, b, CASE WHEN a = '' OR b = '' THEN 0::DOUBLE ELSE 100::DOUBLE - 100::DOUBLE * (len(sa) + len(sb) - 2 * ({lcs('sa', 'sb')})) / (len(sa) + len(sb)) END AS score FROM {out}_w)"""


def pick(options, at: str) -> str:
    return f"{lst(options)}[({at}) % {len(options)} + 1]"


TITLES = tuple(b.title() for b in BRANDS)
INV = f"""
    fl AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice) AS rn FROM lineitem),
    base AS (
      SELECT o_orderkey AS doc_id, o_orderkey % 12 AS k, CASE WHEN l_suppkey % 10 = 9 THEN s_name ELSE {pick(DEALERS, 'l_suppkey')} END AS dealer,
        {pick(TITLES, 'l_partkey')} || ' ' || l_partkey AS model, {pick(TITLES, 'l_partkey + 1')} || ' ' || l_partkey AS model2,
        p_size::BIGINT AS hp, floor(l_extendedprice)::BIGINT AS price
      FROM orders LEFT JOIN (SELECT * FROM fl WHERE rn = 1) ON o_orderkey = l_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey),
    inv AS (
      SELECT doc_id, k, dealer, model, hp, price,
        'Dealer: ' || dealer || chr(10) || 'Model: ' || model || chr(10) || 'HP: ' || hp || ' HP' || chr(10) || 'Total: ' || price AS paddle,
        (CASE WHEN k = 5 THEN '' ELSE 'Dealer: ' || (CASE WHEN k = 6 THEN upper(dealer) || ' Pvt Ltd' WHEN k = 10 THEN replace(dealer, 'o', '0') ELSE dealer END) || chr(10) END)
        || 'Model: ' || (CASE WHEN k = 9 THEN model2 ELSE model END) || chr(10)
        || 'HP: ' || (CASE WHEN k = 8 THEN hp || '-' || (hp + 10) ELSE hp::VARCHAR END) || ' HP' || chr(10) || 'Total: '
        || (CASE WHEN k = 1 THEN translate(price::VARCHAR, '0123456789', {q(NATIVE[:10])}) WHEN k = 2 THEN translate(price::VARCHAR, '0123456789', {q(NATIVE[10:])})
              WHEN k = 3 THEN (price * 103 // 100)::VARCHAR WHEN k = 4 THEN (price * 108 // 100)::VARCHAR
              WHEN k = 7 THEN (price // 100000) || '.' || lpad((price % 100000)::VARCHAR, 5, '0') || ' lakh'
              WHEN k = 11 THEN 'Rs. ' || price ELSE price::VARCHAR END) AS deepseek
      FROM base)"""
AMOUNT = f"amt AS (SELECT doc_id, regexp_extract(coalesce(deepseek, ''), 'Total: (.*)', 1) AS raw FROM inv)"
SELL = f"sell AS (SELECT doc_id, dealer AS a, {strip(first('deepseek', DEALER_AT))} AS b FROM inv)"
READS = "rd AS (SELECT doc_id, 'paddle' AS engine, coalesce(paddle, '') AS text FROM inv UNION ALL SELECT doc_id, 'deepseek', coalesce(deepseek, '') FROM inv)"
EXT = f"""
    raws AS (SELECT doc_id, engine, text, {strip(first('text', DEALER_AT))} AS r_dealer, coalesce({strip(first('text', MODEL_AT))}, text) AS r_model, {strip(first('text', COST_AT))} AS r_cost FROM rd),
    {model_ctes('raws', 'doc_id, engine', 'r_model', 'xm')},
    {hp_ctes('raws', 'doc_id, engine', 'text', 'xh')},
    {cost_ctes('raws', 'doc_id, engine', 'r_cost', 'xc')},
    ext AS (
      SELECT doc_id, engine, 'dealer_name' AS field_name, r_dealer AS s, NULL::DOUBLE AS n, CASE WHEN r_dealer IS NOT NULL THEN 0.7::DOUBLE ELSE 0::DOUBLE END AS confidence FROM raws
      UNION ALL SELECT doc_id, engine, 'model_name', value, NULL, confidence FROM xm
      UNION ALL SELECT doc_id, engine, 'horse_power', NULL, value, confidence FROM xh
      UNION ALL SELECT doc_id, engine, 'asset_cost', NULL, value, confidence FROM xc)"""
DET = """
    dj AS (SELECT doc_id, c AS class_name, i::INTEGER AS det_no, (CASE WHEN c = 'signature' THEN 1 ELSE 2 END) + 2 * i AS j FROM inv, (VALUES ('signature'), ('stamp')) t(c), (VALUES (0), (1)) u(i)),
    det AS (SELECT doc_id, class_name, det_no, [(doc_id * 7 * j % 900 - 20)::INTEGER, (doc_id * 11 * j % 1100)::INTEGER, (60 + doc_id % 90)::INTEGER, (20 + doc_id * j % 40)::INTEGER] AS bbox,
      0.5::DOUBLE + (doc_id * 13 * j % 50) / 100::DOUBLE AS confidence, (doc_id * 3 * j % 45) / 100::DOUBLE AS density, (doc_id * j % 14)::INTEGER AS components,
      (doc_id * 5 * j % 40) / 100::DOUBLE AS color, (doc_id * 7 * j % 100) / 100::DOUBLE AS circularity, (doc_id * 9 * j % 100) / 100::DOUBLE AS rectangularity FROM dj)"""
LINES = """
    ln AS (SELECT doc_id, engine, (i - 1)::INTEGER AS line_no, string_split(text, chr(10))[i] AS text FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM rd)),
    lines AS (SELECT *, [(50 + CASE WHEN engine = 'paddle' THEN 0 ELSE doc_id % 30 END)::INTEGER, (100 + line_no * 220)::INTEGER, (len(text) * 9)::INTEGER, 24] AS bbox,
      (90 - doc_id % 20 - line_no) / 100::DOUBLE AS confidence FROM ln WHERE text <> '')"""
MARKS = """
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, class_name ORDER BY confidence DESC, det_no) AS r FROM det WHERE confidence >= 0.7::DOUBLE) WHERE r = 1),
    marks AS (SELECT g.doc_id, g.c AS field_name, b.doc_id IS NOT NULL AS p, b.bbox AS b, coalesce(b.confidence, 0.7::DOUBLE) AS confidence
      FROM (SELECT doc_id, c FROM inv, (VALUES ('signature'), ('stamp')) t(c)) g LEFT JOIN best b ON b.doc_id = g.doc_id AND b.class_name = g.c)"""
PAIRS = """
    pr AS (
      SELECT x.doc_id, x.field_name, x.s AS s1, y.s AS s2, x.n AS n1, y.n AS n2, NULL::BOOLEAN AS p1, NULL::BOOLEAN AS p2, NULL::INTEGER[] AS b1, NULL::INTEGER[] AS b2, x.confidence AS c1, y.confidence AS c2
      FROM ext x JOIN ext y ON x.doc_id = y.doc_id AND x.field_name = y.field_name AND x.engine = 'paddle' AND y.engine = 'deepseek'
      UNION ALL SELECT doc_id, field_name, NULL, NULL, NULL, NULL, p, p, b, b, confidence, confidence FROM marks)"""


def iou(p: str, r: str) -> str:
    inter = f"(greatest(0, least({p}[1] + {p}[3], {r}[1] + {r}[3]) - greatest({p}[1], {r}[1])) * greatest(0, least({p}[2] + {p}[4], {r}[2] + {r}[4]) - greatest({p}[2], {r}[2])))"
    union = f"({p}[3] * {p}[4] + {r}[3] * {r}[4] - {inter})"
    return f"CASE WHEN {p} IS NOT NULL AND {r} IS NOT NULL AND {union} > 0 THEN {inter}::DOUBLE / {union} ELSE 0::DOUBLE END"


FOUND = f"""
    sp AS (SELECT DISTINCT {strip('s1')} AS a, {strip('s2')} AS b FROM pr WHERE s1 IS NOT NULL AND s2 IS NOT NULL),
    {set_ratio_ctes('sp', 'sc')},
    dt0 AS (SELECT pr.*, sc.score AS fuzzy, {jaccard(tokens('sc.a'), tokens('sc.b'))} AS overlap, field_name IN ('horse_power', 'asset_cost') AS num, field_name IN ('signature', 'stamp') AS vis,
        CASE WHEN n1 = 0 AND n2 = 0 THEN 0::DOUBLE ELSE abs(n1 - n2) / ((abs(n1) + abs(n2)) / 2) END AS diff, {iou('b1', 'b2')} AS biou
      FROM pr LEFT JOIN sc ON {strip('s1')} = sc.a AND {strip('s2')} = sc.b),
    dt1 AS (SELECT *, CASE WHEN num THEN n1 IS NULL WHEN vis THEN p1 IS NULL ELSE s1 IS NULL END AS x1, CASE WHEN num THEN n2 IS NULL WHEN vis THEN p2 IS NULL ELSE s2 IS NULL END AS x2 FROM dt0),
    dt2 AS (SELECT *, CASE WHEN x1 AND x2 THEN NULL WHEN x1 OR x2 THEN 'missing_value' WHEN num THEN 'numeric'
        WHEN vis THEN (CASE WHEN p1 <> p2 THEN 'visual_presence' WHEN p1 AND b1 IS NOT NULL AND b2 IS NOT NULL THEN 'visual_bbox' END) ELSE 'textual' END AS conflict_type FROM dt1),
    dtd AS (SELECT *, CASE conflict_type WHEN 'missing_value' THEN 1::DOUBLE WHEN 'visual_presence' THEN 1::DOUBLE WHEN 'numeric' THEN diff WHEN 'visual_bbox' THEN 1::DOUBLE - biou WHEN 'textual' THEN 1::DOUBLE - fuzzy / 100::DOUBLE ELSE 0::DOUBLE END AS metric,
        CASE conflict_type WHEN 'missing_value' THEN true WHEN 'visual_presence' THEN true WHEN 'numeric' THEN diff > 0.05::DOUBLE WHEN 'visual_bbox' THEN biou < 0.5::DOUBLE WHEN 'textual' THEN fuzzy < 90 OR overlap < 0.7::DOUBLE ELSE false END AS conflict FROM dt2)"""
AGREED = """
    ag0 AS (SELECT *, (n1 * 0.55::DOUBLE * c1 + n2 * 0.45::DOUBLE * c2) / nullif(c1 * 0.55::DOUBLE + c2 * 0.45::DOUBLE, 0) AS mean,
        CASE WHEN conflict THEN c1 >= c2 ELSE c1 * 0.55::DOUBLE >= c2 * 0.45::DOUBLE END AS f1 FROM dtd),
    agr AS (SELECT doc_id, field_name, conflict, conflict_type, s1, s2, n1, n2, p1, p2, b1, b2, c1, c2, num, vis,
        CASE WHEN f1 THEN s1 ELSE s2 END AS s, CASE WHEN NOT conflict AND num AND mean IS NOT NULL THEN mean WHEN f1 THEN n1 ELSE n2 END AS n, CASE WHEN f1 THEN p1 ELSE p2 END AS p, CASE WHEN f1 THEN b1 ELSE b2 END AS b,
        CASE WHEN conflict THEN greatest(c1, c2) * 0.7::DOUBLE ELSE (c1 * 0.55::DOUBLE + c2 * 0.45::DOUBLE) / (0.55::DOUBLE + 0.45::DOUBLE) END AS confidence,
        CASE WHEN NOT conflict AND num AND mean IS NOT NULL THEN 'weighted' WHEN f1 THEN 'paddle' ELSE 'deepseek' END AS source, CASE WHEN conflict THEN 'needs_adjudication' END AS resolution FROM ag0)"""
VALUES = ", ".join((INV, READS, EXT, DET, MARKS, PAIRS, FOUND))
ALL = f"{VALUES}, {AGREED}"
CONF = """
    cf AS (SELECT a.doc_id, field_name, conflict_type, num, vis, CASE WHEN num THEN n1::VARCHAR WHEN vis THEN p1::VARCHAR ELSE s1 END AS v1, CASE WHEN num THEN n2::VARCHAR WHEN vis THEN p2::VARCHAR ELSE s2 END AS v2, c1, c2,
        concat_ws(' ', coalesce(i.paddle, ''), coalesce(i.deepseek, '')) AS context FROM agr a JOIN inv i ON a.doc_id = i.doc_id WHERE conflict)"""


def plain_number(x: str) -> str:
    t = f"regexp_replace({currency(native(x))}, '[,\\s]', '', 'g')"
    return f"coalesce({found(t, NUM)}, {t})"


def undone(x: str) -> str:
    return plain_number(f"translate({x}, {q(MISREAD)}, {q(READ)})")


def normal_text(x: str) -> str:
    return strip(f"regexp_replace(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g')")


def tier1_ctes(src: str, out: str, chars: int) -> str:
    bare = lambda v: normal_text(strip(f"lower({v})"))
    return f"""
    {out}_a AS (SELECT *, {plain_number('v1')} AS a, {plain_number('v2')} AS b, {undone('v1')} AS a2, {undone('v2')} AS b2, {bare('v1')} AS x, {bare('v2')} AS y, substr(context, 1, {chars}) AS ctx FROM {src}),
    {out}_b AS (SELECT *, {jaccard(tokens('x'), tokens('y'))} AS jc, greatest(c1, c2) AS top FROM {out}_a),
    {out}_r AS (SELECT *, CASE
        WHEN v1 IS NULL AND v2 IS NOT NULL THEN 'null1' WHEN v2 IS NULL AND v1 IS NOT NULL THEN 'null2' WHEN v1 IS NULL THEN NULL
        WHEN conflict_type = 'numeric' THEN (CASE WHEN a = b THEN 'numeric_normalization' WHEN a2 = b2 THEN 'ocr_correction' WHEN ctx <> '' AND contains(ctx, a) AND NOT contains(ctx, b) THEN 'ctx1' WHEN ctx <> '' AND contains(ctx, b) AND NOT contains(ctx, a) THEN 'ctx2' END)
        WHEN conflict_type = 'textual' THEN (CASE WHEN x = y THEN 'text_normalization' WHEN jc >= 0.85::DOUBLE THEN 'jaccard_similarity' WHEN contains(y, x) THEN 'sub2' WHEN contains(x, y) THEN 'sub1' END) END AS hit FROM {out}_b),
    {out} AS (SELECT * EXCLUDE (hit), CASE hit WHEN 'null1' THEN v2 WHEN 'null2' THEN v1 WHEN 'numeric_normalization' THEN a WHEN 'ocr_correction' THEN a2 WHEN 'ctx1' THEN v1 WHEN 'ctx2' THEN v2
          WHEN 'text_normalization' THEN (CASE WHEN len(v1) >= len(v2) THEN v1 ELSE v2 END) WHEN 'jaccard_similarity' THEN (CASE WHEN len({strip('v1')}) >= len({strip('v2')}) THEN v1 ELSE v2 END) WHEN 'sub2' THEN v2 WHEN 'sub1' THEN v1 END AS t_value,
        CASE hit WHEN 'null1' THEN c2 * 0.8::DOUBLE WHEN 'null2' THEN c1 * 0.8::DOUBLE WHEN 'numeric_normalization' THEN top WHEN 'ocr_correction' THEN top * 0.9::DOUBLE WHEN 'ctx1' THEN c1 * 0.95::DOUBLE WHEN 'ctx2' THEN c2 * 0.95::DOUBLE
          WHEN 'text_normalization' THEN top WHEN 'jaccard_similarity' THEN top * jc WHEN 'sub2' THEN c2 * 0.95::DOUBLE WHEN 'sub1' THEN c1 * 0.95::DOUBLE END AS t_conf,
        CASE WHEN hit IN ('null1', 'null2') THEN 'prefer_non_null' WHEN hit IN ('ctx1', 'ctx2') THEN 'context_match' WHEN hit IN ('sub1', 'sub2') THEN 'subset_match' ELSE hit END AS t_method FROM {out}_r)"""


def slm_ctes(src: str, out: str, chars: str) -> str:
    one = lambda v: f"try_cast(regexp_extract(replace({v}, ',', ''), '[\\d,]+\\.?\\d*', 0) AS DOUBLE)"
    return f"""
    {out}_a AS (SELECT *, coalesce(v1, 'None') AS w1, coalesce(v2, 'None') AS w2, {chars} AS sctx FROM {src}),
    {out}_b AS (SELECT *, trunc({one('w1')})::BIGINT::VARCHAR AS i1, trunc({one('w2')})::BIGINT::VARCHAR AS i2 FROM {out}_a),
    {out}_c AS (SELECT *, coalesce(num AND sctx <> '' AND i1 IS NOT NULL AND i2 IS NOT NULL AND contains(sctx, i1) <> contains(sctx, i2), false) AS sure FROM {out}_b),
    {out} AS (SELECT * EXCLUDE (sure), CASE WHEN sure AND contains(sctx, i1) THEN w1 WHEN sure THEN w2 WHEN len(w1) > len(w2) * 1.5 THEN w1 WHEN len(w2) > len(w1) * 1.5 THEN w2 END AS j_value,
        CASE WHEN sure THEN 0.7::DOUBLE WHEN len(w1) > len(w2) * 1.5 OR len(w2) > len(w1) * 1.5 THEN 0.6::DOUBLE ELSE 0::DOUBLE END AS j_conf FROM {out}_c)"""


def special(v: str) -> str:
    return f"(len(regexp_replace({v}, '[\\p{{L}}\\p{{N}} ]', '', 'g'))::DOUBLE / greatest(len({v}), 1))"


def q_pipe(v: str, c: str) -> str:
    return f"CASE WHEN {v} IS NULL THEN 0::DOUBLE ELSE {c} * (CASE WHEN len({v}) > 100 THEN 0.5::DOUBLE ELSE 1::DOUBLE END) * (CASE WHEN {special(v)} > 0.3::DOUBLE THEN 0.6::DOUBLE ELSE 1::DOUBLE END) END"


def q_ladder(v: str, c: str) -> str:
    n = dbl(v)
    return f"""CASE WHEN {v} IS NULL THEN 0.1::DOUBLE ELSE least(1::DOUBLE, {c}
      * (CASE WHEN len({v}) > 100 THEN 0.3::DOUBLE WHEN len({v}) > 50 THEN 0.6::DOUBLE WHEN len({v}) > 30 THEN 0.8::DOUBLE ELSE 1::DOUBLE END)
      * (CASE WHEN {special(v)} > 0.3::DOUBLE THEN 0.4::DOUBLE WHEN {special(v)} > 0.15::DOUBLE THEN 0.7::DOUBLE ELSE 1::DOUBLE END)
      * (CASE WHEN field_name = 'horse_power' AND {n} BETWEEN 15 AND 120 THEN 1.2::DOUBLE WHEN field_name = 'horse_power' AND ({n} > 500 OR {n} < 5) THEN 0.3::DOUBLE
              WHEN field_name = 'asset_cost' AND {n} BETWEEN 100000 AND 2000000 THEN 1.2::DOUBLE WHEN field_name = 'asset_cost' AND ({n} < 1000 OR {n} > 10000000) THEN 0.3::DOUBLE ELSE 1::DOUBLE END)
      * (CASE WHEN field_name IN ('dealer_name', 'model_name') AND regexp_matches(substr({v}, 1, 1), '^[A-Z]') THEN 1.1::DOUBLE ELSE 1::DOUBLE END)
      * (CASE WHEN field_name IN ('dealer_name', 'model_name') AND ((upper({v}) = {v} AND lower({v}) <> {v}) OR (lower({v}) = {v} AND upper({v}) <> {v} AND len({v}) > 3)) THEN 0.8::DOUBLE ELSE 1::DOUBLE END)) END"""


SHOWN = "doc_id, field_name, CASE WHEN NOT num THEN value END AS s, CASE WHEN num THEN try_cast(value AS DOUBLE) END AS n, confidence, source"
LOCK = f"""
    lk0 AS (SELECT v.raw AS a, d.name AS b, d.pos FROM (SELECT DISTINCT unnest([v1, v2]) AS raw FROM cf WHERE field_name = 'dealer_name') v, (SELECT unnest({lst(DEALERS)}) AS name, unnest(range({len(DEALERS)})) AS pos) d WHERE v.raw <> ''),
    {sort_ratio_ctes('lk0', 'lk1')},
    lk AS (SELECT a AS raw, b AS name, score FROM (SELECT lk1.*, row_number() OVER (PARTITION BY lk1.a ORDER BY score DESC, pos) AS r FROM lk1 JOIN lk0 USING (a, b)) WHERE r = 1 AND score >= 90)"""


def ladder_sql(mode: str) -> str:
    spent = "0.021::DOUBLE" if mode == "full" else "0.001::DOUBLE"
    return f"""WITH {ALL}, {CONF}, {LOCK},
    op AS (SELECT cf.* REPLACE (substr(context, 1, 3000) AS context), coalesce(x.name, y.name) AS locked, CASE WHEN x.name IS NOT NULL THEN x.score ELSE y.score END AS lscore
      FROM cf LEFT JOIN lk x ON field_name = 'dealer_name' AND cf.v1 = x.raw LEFT JOIN lk y ON field_name = 'dealer_name' AND cf.v2 = y.raw),
    free AS (SELECT * EXCLUDE (locked, lscore) FROM op WHERE locked IS NULL),
    {tier1_ctes('free', 't1', 500)},
    rest AS (SELECT doc_id, field_name, conflict_type, num, vis, v1, v2, c1, c2, context FROM t1 WHERE NOT coalesce(t_conf >= 0.7::DOUBLE, false)),
    {slm_ctes('rest', 'sl', 'substr(context, 1, 1500)')},
    fin AS (
      SELECT doc_id, field_name, num, CASE WHEN num THEN n::VARCHAR WHEN vis THEN p::VARCHAR ELSE s END AS value, confidence, 'tier1_consensus' AS source, 0::DOUBLE AS cost FROM agr WHERE NOT conflict
      UNION ALL SELECT doc_id, field_name, num, locked, lscore / 100::DOUBLE, 'tier1_fuzzy_match', 0 FROM op WHERE locked IS NOT NULL
      UNION ALL SELECT doc_id, field_name, num, t_value, t_conf, 'tier1_' || t_method, 0 FROM t1 WHERE t_conf >= 0.7::DOUBLE
      UNION ALL SELECT doc_id, field_name, num, j_value, j_conf, 'tier2_slm', 0.001::DOUBLE FROM sl WHERE NOT vis AND j_value IS NOT NULL AND j_conf >= 0.6::DOUBLE
      UNION ALL SELECT doc_id, field_name, num, CASE WHEN {q_pipe('v1', 'c1')} >= {q_pipe('v2', 'c2')} THEN v1 ELSE v2 END, (CASE WHEN {q_pipe('v1', 'c1')} >= {q_pipe('v2', 'c2')} THEN c1 ELSE c2 END) * 0.5::DOUBLE, 'tier_fallback', {spent}
        FROM sl WHERE vis OR j_value IS NULL OR j_conf < 0.6::DOUBLE)"""


GOLD = """
    gd AS (SELECT doc_id, dealer, model, hp, price FROM inv WHERE price IS NOT NULL AND doc_id % 7 <> 0),
    gold AS (
      SELECT doc_id, 'dealer_name' AS field_name, dealer AS gs, NULL::DOUBLE AS gn, NULL::BOOLEAN AS gp, NULL::INTEGER[] AS gb FROM gd
      UNION ALL SELECT doc_id, 'model_name', model, NULL, NULL, NULL FROM gd UNION ALL SELECT doc_id, 'horse_power', NULL, hp, NULL, NULL FROM gd UNION ALL SELECT doc_id, 'asset_cost', NULL, price, NULL, NULL FROM gd
      UNION ALL SELECT doc_id, f, NULL, NULL, doc_id % (2 + j) = 0, CASE WHEN doc_id % (2 + j) = 0 THEN [(doc_id * 7 * j % 900 - 20)::INTEGER, (doc_id * 11 * j % 1100)::INTEGER, (60 + doc_id % 90)::INTEGER, (20 + doc_id * j % 40 + doc_id % 9)::INTEGER] END
        FROM gd, (VALUES ('signature', 1), ('stamp', 2)) t(f, j))"""


def judged(src: str, out: str, iou_too: bool = True) -> str:
    box = f" AND coalesce(NOT p OR b IS NULL OR gb IS NULL OR {iou('b', 'gb')} >= 0.5::DOUBLE, true)" if iou_too else ""
    return f"""
    {out} AS (SELECT *, CASE WHEN pnull AND gnull THEN true WHEN pnull OR gnull THEN false
        WHEN num THEN coalesce(abs(n - gn) / greatest(abs(gn), 1) < 0.05::DOUBLE, false)
        WHEN vis THEN coalesce(p = gp{box}, false)
        ELSE lower({strip('s')}) = lower({strip('gs')}) END AS ok
      FROM (SELECT p.*, g.gs, g.gn, g.gp, g.gb, g.doc_id IS NOT NULL AS has_g, p.s IS NULL AND p.n IS NULL AND p.p IS NULL AS pnull, g.gs IS NULL AND g.gn IS NULL AND g.gp IS NULL AS gnull FROM {src} p LEFT JOIN gold g ON p.doc_id = g.doc_id AND p.field_name = g.field_name))"""


STRICT = f"""
    jn AS (SELECT a.doc_id, a.field_name, num, vis, s, n, p, b, gs, gn, gp, gb FROM agr a JOIN gold g ON a.doc_id = g.doc_id AND a.field_name = g.field_name),
    dp AS (SELECT DISTINCT lower({strip('s')}) AS a, lower({strip('gs')}) AS b FROM jn WHERE field_name = 'dealer_name' AND s IS NOT NULL AND gs IS NOT NULL),
    {set_ratio_ctes('dp', 'ds')},
    st AS (SELECT jn.doc_id, jn.field_name,
        CASE WHEN jn.field_name = 'dealer_name' THEN coalesce(score, 0) >= 80
          WHEN vis THEN (CASE WHEN coalesce(p, false) <> coalesce(gp, false) THEN false WHEN NOT coalesce(p, false) OR jn.b IS NULL OR gb IS NULL THEN true ELSE {iou('jn.b', 'gb')} >= 0.5::DOUBLE END)
          WHEN num THEN coalesce(CASE WHEN gn = 0 THEN n = 0 ELSE abs(n - gn) / abs(gn) <= 0 END, false) ELSE coalesce(lower({strip('s')}) = lower({strip('gs')}), false) END AS correct,
        CASE WHEN jn.field_name = 'dealer_name' THEN coalesce(score, 0)::DOUBLE
          WHEN vis THEN 100::DOUBLE * (CASE WHEN coalesce(p, false) <> coalesce(gp, false) THEN 0::DOUBLE WHEN NOT coalesce(p, false) THEN 1::DOUBLE WHEN jn.b IS NULL OR gb IS NULL THEN 0.5::DOUBLE ELSE {iou('jn.b', 'gb')} END)
          WHEN num THEN (CASE WHEN coalesce(CASE WHEN gn = 0 THEN n = 0 ELSE abs(n - gn) / abs(gn) <= 0 END, false) THEN 100::DOUBLE ELSE 0::DOUBLE END)
          ELSE (CASE WHEN coalesce(lower({strip('s')}) = lower({strip('gs')}), false) THEN 100::DOUBLE ELSE 0::DOUBLE END) END AS score
      FROM jn LEFT JOIN ds ON jn.field_name = 'dealer_name' AND lower({strip('s')}) = ds.a AND lower({strip('gs')}) = ds.b)"""
CATEGORY = """CASE WHEN pnull THEN 'Missing_Value' WHEN vis THEN 'OCR_Mismatch' WHEN coalesce(conflict, false) THEN 'OCR_Mismatch' WHEN coalesce(confidence, 1) < 0.6::DOUBLE THEN 'Low_Confidence' ELSE 'Parse_Error' END"""
_COMPONENT = "CASE event_type " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in COMPONENTS.items()) + " END"
LOG = f"lg AS (SELECT event_id AS call_id, user_id AS doc_id, {_COMPONENT} AS component, value AS latency, ts, props, CASE event_type WHEN 'purchase' THEN 0.001 WHEN 'error' THEN 0.02 ELSE 0 END::DECIMAL(10,4) AS cost FROM events)"
SAMPLES = """
    sm AS (SELECT 'quality' AS field_name, ((doc_id * 37 + 13) % 101) / 100::DOUBLE AS confidence, quality = 1 AS correct FROM labels
      UNION ALL SELECT 'toxic', ((doc_id * 53 + 13) % 101) / 100::DOUBLE, toxic = 1 FROM labels)"""
BINS = """
    bc AS (SELECT field_name, least(floor(confidence * 10), 9)::INTEGER AS bin, count(*) AS samples, count(*) FILTER (WHERE correct) AS yes FROM sm GROUP BY ALL),
    bins AS (SELECT g.field_name, g.bin, coalesce(samples, 0)::BIGINT AS samples, coalesce(yes::DOUBLE / samples, (g.bin + 0.5::DOUBLE) / 10) AS value
      FROM (SELECT f.field_name, b.bin FROM (SELECT field_name FROM sm GROUP BY field_name HAVING count(*) >= 10) f, (SELECT unnest(range(10))::INTEGER AS bin) b) g LEFT JOIN bc ON bc.field_name = g.field_name AND bc.bin = g.bin)"""
ROWS = "rs AS (SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 17 <> 0 THEN ((o_orderkey * 29) % 100) / 100::DOUBLE END AS confidence, o_orderkey AS pos FROM orders)"
SAMPLE = """
    lo AS (SELECT *, row_number() OVER (ORDER BY coalesce(confidence, 0), pos) AS rank FROM rs QUALIFY rank <= 10),
    mi AS (SELECT *, row_number() OVER (ORDER BY pos) AS rank FROM rs WHERE confidence BETWEEN 0.6::DOUBLE AND 0.95::DOUBLE QUALIFY rank <= 10),
    ra AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), pos) AS rank FROM rs WHERE doc_id NOT IN (SELECT doc_id FROM lo UNION ALL SELECT doc_id FROM mi) QUALIFY rank <= 10),
    un AS (SELECT doc_id, 'low_confidence' AS reason, rank, 0 AS part FROM lo UNION ALL SELECT doc_id, 'borderline', rank, 1 FROM mi UNION ALL SELECT doc_id, 'random', rank, 2 FROM ra)"""


def _draw(what: str, c: str = "c") -> str:
    return f"('0x' || substr(md5({c} || ':{what}:' || o_orderkey), 1, 8))::BIGINT"


def oracle_sql() -> dict[str, str]:
    d = "doc_id"
    i = f"WITH {INV}"
    money = "CASE k % 6 WHEN 0 THEN '₹ ' || price WHEN 1 THEN 'Rs. ' || price WHEN 2 THEN '$' || price WHEN 3 THEN price || '/-' WHEN 4 THEN 'INR ' || price ELSE price || ' rupees' END"
    tail = "CASE k % 4 WHEN 0 THEN ' Pvt. Ltd.' WHEN 1 THEN ' & Co.' WHEN 2 THEN ' Enterprises LLP' ELSE ' and Sons Limited' END"
    mraw = "CASE k % 3 WHEN 0 THEN model || ' DI' WHEN 1 THEN model || ': ' || hp || ' HP' ELSE 'Tractor ' || hp || 'HP' END"
    hraw = "CASE k % 4 WHEN 0 THEN hp || ' HP' WHEN 1 THEN hp || '-' || (hp + 10) || ' BHP' WHEN 2 THEN hp::VARCHAR ELSE 'power ' || hp || ' H.P.' END"
    chars = lambda x: f"list_distinct(string_split({strip(f'lower({x})')}, ''))"
    ascii_ = lambda x: f"regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g')"
    answer = """CASE k % 6 WHEN 0 THEN dealer WHEN 1 THEN model WHEN 3 THEN dealer WHEN 4 THEN dealer END"""
    shrink = "[trunc({0}[1] / 40::DOUBLE)::INTEGER, trunc({0}[2] / 40::DOUBLE)::INTEGER, {0}[3], {0}[4]]"
    boxes = f"WITH {INV}, {DET}, bp AS (SELECT x.doc_id, x.class_name, {shrink.format('x.bbox')} AS p, {shrink.format('y.bbox')} AS r FROM det x JOIN det y ON x.doc_id = y.doc_id AND x.class_name = y.class_name AND x.det_no = 0 AND y.det_no = 1)"
    masters = f"ms AS (SELECT unnest({lst(DEALERS)}) AS name, unnest(range({len(DEALERS)})) AS pos), mb AS (SELECT {suffixes('name')} AS bare, arg_max(name, pos) AS name, min(pos) AS pos FROM ms GROUP BY 1)"
    words = f"""wd AS (SELECT x.doc_id, x.class_name, x.det_no, sum(len(list_filter(string_split_regex(l.text, '\\s+'), lambda w: w <> ''))) AS words FROM det x JOIN lines l ON x.doc_id = l.doc_id
        AND NOT (x.bbox[1] + x.bbox[3] < l.bbox[1] OR x.bbox[1] > l.bbox[1] + l.bbox[3] OR x.bbox[2] + x.bbox[4] < l.bbox[2] OR x.bbox[2] > l.bbox[2] + l.bbox[4]) GROUP BY ALL)"""
    marks = f"{INV}, {READS}, {DET}, {LINES}, {words}"
    joined = f"{ALL}, {GOLD}, {judged('agr', 'jd')}"
    return {
        "native_digits": f"{i} SELECT doc_id, {native('deepseek')} AS text FROM inv",
        "strip_currency": f"{i} SELECT doc_id, {currency(money)} AS text FROM inv",
        "strip_suffix": f"{i} SELECT doc_id, {suffixes(f'dealer || ({tail})')} AS text FROM inv",
        "normalize_numeric": f"{i}, {AMOUNT}, {numeric_ctes('amt', d, 'raw', 'o')} SELECT * FROM o",
        "parse_model": f"{i}, mr AS (SELECT doc_id, {mraw} AS raw FROM inv), {model_ctes('mr', d, 'raw', 'o')} SELECT * FROM o",
        "parse_hp": f"{i}, hr AS (SELECT doc_id, {hraw} AS raw FROM inv), {hp_ctes('hr', d, 'raw', 'o')} SELECT * FROM o",
        "parse_cost": f"{i}, {AMOUNT}, {cost_ctes('amt', d, 'raw', 'o')} SELECT * FROM o",
        "extract_fields": f"{i}, {READS}, {EXT} SELECT * FROM ext",
        "token_overlap": f"{i}, {SELL} SELECT doc_id, CASE WHEN a <> '' AND b <> '' THEN {jaccard(tokens('a'), tokens('b'))} ELSE 0::DOUBLE END AS overlap FROM sell",
        "char_agree": f"{i}, {SELL} SELECT doc_id, ({strip('lower(a)')} = {strip('lower(b)')}) OR ({jaccard(chars('a'), chars('b'))}) >= 0.8::DOUBLE AS agree FROM sell",
        "fuzzy_score": f"{i}, {SELL}, {set_ratio_ctes('sell', 'sc')} SELECT doc_id, sc.score AS fuzzy, CASE WHEN sc.a IS NOT NULL THEN {jaccard(tokens('sc.a'), tokens('sc.b'))} END AS overlap FROM sell LEFT JOIN sc ON sell.a = sc.a AND sell.b = sc.b",
        "token_sort": f"{i}, {SELL}, {sort_ratio_ctes('sell', 'sc')} SELECT a, b, score FROM sc",
        "dealer_match": f"""{i}, {SELL}, {masters}, cand AS (SELECT DISTINCT sell.b AS raw, {suffixes('sell.b')} AS a, mb.bare AS b, mb.name, mb.pos FROM sell, mb WHERE sell.b <> ''),
            {set_ratio_ctes('cand', 'sc', False)}, bs AS (SELECT * FROM (SELECT cand.raw, cand.name, score, row_number() OVER (PARTITION BY cand.raw ORDER BY score DESC, pos) AS r FROM cand JOIN sc USING (a, b)) WHERE r = 1)
            SELECT doc_id, CASE WHEN score >= 90 THEN name ELSE raw END AS value, coalesce(CASE WHEN score >= 90 THEN score / 100::DOUBLE ELSE score / 100::DOUBLE * 0.5::DOUBLE END, 0) AS confidence, coalesce(score >= 90, false) AS matched, coalesce(score, 0)::DOUBLE AS score FROM sell LEFT JOIN bs ON sell.b = bs.raw""",
        "dealer_prefilter": f"""{i}, {SELL}, {masters}, cand AS (SELECT v.raw AS a, ms.name AS b, pos FROM (SELECT DISTINCT unnest([a, b]) AS raw FROM sell) v, ms WHERE v.raw <> ''),
            {sort_ratio_ctes('cand', 'sc')}, lk AS (SELECT * FROM (SELECT cand.a AS raw, cand.b AS name, score, row_number() OVER (PARTITION BY cand.a ORDER BY score DESC, pos) AS r FROM cand JOIN sc USING (a, b)) WHERE r = 1 AND score >= 90)
            SELECT doc_id, coalesce(x.name, y.name) AS locked, CASE WHEN x.name IS NOT NULL THEN x.score ELSE y.score END / 100::DOUBLE AS locked_confidence FROM sell LEFT JOIN lk x ON sell.b = x.raw LEFT JOIN lk y ON sell.a = y.raw""",
        "clean_grounded": f"{i}, g AS (SELECT doc_id, CASE WHEN k % 2 = 0 THEN '=====' || chr(10) || 'BASE: torch.Size([1, 256])' || chr(10) || 'PATCHES: 4' || chr(10) ELSE 'image size: 3' || chr(10) END || '<|ref|>' || dealer || '</ref><|det|>[[1, 2,3,4]]</det>' || chr(10) || chr(10) || '  <|grounding|>' || model || '  ' || chr(10) || chr(9) || chr(10) || 'size' AS raw FROM inv) SELECT doc_id, array_to_string(list_filter(list_transform(list_filter(string_split(raw, chr(10)), lambda x: NOT contains(x, 'PATCHES:') AND NOT contains(x, 'torch.Size')), lambda x: {strip(f"regexp_replace(regexp_replace(x, {q(MARKUP[0])}, '', 'g'), {q(MARKUP[1])}, '', 'g')")}), lambda x: x <> ''), chr(10)) AS text FROM g",
        "normalize_text": f"SELECT doc_id, md5({normal_text(ascii_('text'))}) AS digest FROM documents",
        "number_text": f"{i}, {AMOUNT} SELECT doc_id, {plain_number('raw')} AS plain, {undone('raw')} AS undone FROM amt",
        "quality_pipeline": f"WITH c AS (SELECT conv_id, turn, substr({ascii_('text')}, 1, 120) AS v FROM conversations) SELECT conv_id, turn, {q_pipe('v', '0.8::DOUBLE')} AS score FROM c",
        "quality_ladder": f"{i}, {READS}, {EXT}, e AS (SELECT doc_id, engine, field_name, confidence, coalesce(n::VARCHAR, s) AS v FROM ext) SELECT doc_id, engine, field_name, {q_ladder('v', 'confidence')} AS score FROM e",
        "numeric_diff": "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_extendedprice = 0 AND l_quantity * 1000 = 0 THEN 0::DOUBLE ELSE abs(l_extendedprice - l_quantity * 1000) / ((abs(l_extendedprice) + abs(l_quantity * 1000)) / 2) END AS diff FROM lineitem",
        "iou_xywh": f"{boxes} SELECT doc_id, class_name, {iou('p', 'r')} AS iou FROM bp",
        "iou_xyxy": f"{boxes} SELECT doc_id, class_name, {iou('p', 'r')} AS iou FROM bp",
        "poly_to_box": f"{i} SELECT doc_id, trunc(doc_id % 700 - 0.25)::INTEGER AS x, trunc(doc_id % 900 + 0.25)::INTEGER AS y, (trunc(doc_id % 700 + 51.25) - trunc(doc_id % 700 - 0.25))::INTEGER AS w, (trunc(doc_id % 900 + 21.15) - trunc(doc_id % 900 + 0.25))::INTEGER AS h FROM inv",
        "full_text": f"{i}, {READS}, {LINES} SELECT doc_id, engine, string_agg(text, ' ' ORDER BY line_no) AS full_text, round(avg(confidence), 9) AS avg_confidence, count(*) AS lines FROM lines GROUP BY doc_id, engine",
        "words_in_box": f"WITH {marks} SELECT x.doc_id, x.class_name, x.det_no, coalesce(words, 0)::BIGINT AS words FROM det x LEFT JOIN wd USING (doc_id, class_name, det_no)",
        "best_detection": f"{i}, {DET} SELECT doc_id, class_name AS field_name, det_no, confidence FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, class_name ORDER BY confidence DESC, det_no) AS r FROM det) WHERE r = 1",
        "verify_detection": f"""WITH {marks}, c AS (SELECT x.*, coalesce(words, 0) AS words, least(bbox[1] + bbox[3], 800) - greatest(0, bbox[1]) AS w, least(bbox[2] + bbox[4], 1100) - greatest(0, bbox[2]) AS h FROM det x LEFT JOIN wd USING (doc_id, class_name, det_no)),
            r AS (SELECT *, CASE WHEN w <= 0 OR h <= 0 THEN 'invalid_bbox' WHEN words > 10 THEN 'too_many_words'
              WHEN class_name = 'signature' THEN (CASE WHEN density < 0.05::DOUBLE OR density > 0.3::DOUBLE THEN 'stroke_density' WHEN components < 5 THEN 'few_components' ELSE 'verified' END)
              ELSE (CASE WHEN color < 0.1::DOUBLE THEN 'color' WHEN circularity < 0.5::DOUBLE AND rectangularity < 0.7::DOUBLE THEN 'shape' ELSE 'verified' END) END AS reason FROM c)
            SELECT doc_id, class_name, det_no, reason = 'verified' AS verified, reason FROM r""",
        "contours": f"""{i}, {DET}, c AS (SELECT doc_id, class_name, det_no AS contour_no, bbox[3] * bbox[4] / 880000::DOUBLE AS share, bbox[3] / bbox[4]::DOUBLE AS ratio FROM det),
            f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, class_name ORDER BY contour_no) AS r FROM c WHERE (class_name = 'signature' AND share > 0.001 AND share < 0.15 AND ratio > 1.5 AND ratio < 8) OR (class_name = 'stamp' AND share > 0.002 AND share < 0.1))
            SELECT doc_id, class_name, contour_no FROM f WHERE r <= CASE class_name WHEN 'signature' THEN 5 ELSE 3 END""",
        "conflicts": f"WITH {VALUES} SELECT doc_id, field_name, conflict, conflict_type, metric FROM dtd",
        "consensus": f"WITH {ALL} SELECT doc_id, field_name, s, n, p, confidence, source, resolution FROM agr",
        "tier1": f"WITH {ALL}, {CONF}, {tier1_ctes('cf', 't1', 500)} SELECT doc_id, field_name, t_value AS value, t_conf AS confidence, t_method AS method FROM t1",
        "slm_fallback": f"WITH {ALL}, {CONF}, {slm_ctes('cf', 'sl', 'substr(context, 1, 1500)')} SELECT doc_id, field_name, j_value AS value, j_conf AS confidence, CASE WHEN j_value IS NOT NULL THEN 'RESOLVED' ELSE 'UNCERTAIN' END AS status FROM sl",
        "slm_parse": f"{i}, a AS (SELECT doc_id, k, {answer} AS value FROM inv WHERE dealer IS NOT NULL) SELECT doc_id, value, CASE k % 6 WHEN 0 THEN 0.9::DOUBLE WHEN 1 THEN 0.75::DOUBLE WHEN 3 THEN 0.6::DOUBLE WHEN 4 THEN 1::DOUBLE ELSE 0::DOUBLE END AS confidence, CASE WHEN value IS NOT NULL THEN 'RESOLVED' ELSE 'UNCERTAIN' END AS status FROM a",
        "vlm_choice": f"{i} SELECT doc_id, CASE k % 5 WHEN 0 THEN dealer WHEN 1 THEN model WHEN 3 THEN model END AS value, CASE k % 5 WHEN 0 THEN 0.9::DOUBLE WHEN 1 THEN 0.9::DOUBLE WHEN 2 THEN 0.3::DOUBLE WHEN 3 THEN 0.75::DOUBLE ELSE 0::DOUBLE END AS confidence, CASE WHEN k % 5 IN (0, 1, 3) THEN 'RESOLVED' ELSE 'UNCERTAIN' END AS status FROM inv WHERE dealer IS NOT NULL",
        "ladder_full": f"{ladder_sql('full')} SELECT {SHOWN}, cost FROM fin",
        "ladder_cpu_lite": f"{ladder_sql('cpu-lite')} SELECT {SHOWN}, cost FROM fin",
        "ladder_library": f"""WITH {ALL}, {CONF}, {tier1_ctes('cf', 't1', 1000000)}, rest AS (SELECT doc_id, field_name, conflict_type, num, vis, v1, v2, c1, c2, context FROM t1 WHERE t_method IS NULL),
            {slm_ctes('rest', 'sl', 'context')}, fin AS (
              SELECT doc_id, field_name, num, t_value AS value, t_conf AS confidence, t_method AS source, 1 AS tier, 0::DOUBLE AS cost FROM t1 WHERE t_method IS NOT NULL
              UNION ALL SELECT doc_id, field_name, num, j_value, j_conf, 'slm_judge', 2, 0.001::DOUBLE FROM sl WHERE j_value IS NOT NULL
              UNION ALL SELECT doc_id, field_name, num, CASE WHEN q1 >= q2 THEN v1 ELSE v2 END, greatest(q1, q2) * 0.5::DOUBLE, 'quality_fallback', 3, 0.021::DOUBLE FROM (SELECT *, {q_ladder('v1', 'c1')} AS q1, {q_ladder('v2', 'c2')} AS q2 FROM sl WHERE j_value IS NULL))
            SELECT {SHOWN}, tier, cost FROM fin""",
        "doc_confidence_min": f"WITH {ALL} SELECT doc_id, coalesce(min(confidence), 0) AS document_confidence FROM agr GROUP BY doc_id",
        "doc_confidence_geomean": f"WITH {ALL} SELECT doc_id, round(exp(avg(ln(confidence + 1e-10::DOUBLE))), 6) AS document_confidence FROM agr GROUP BY doc_id",
        "source_stats": f"{ladder_sql('full')} SELECT count(*) FILTER (WHERE source IN ('consensus', 'paddle', 'deepseek', 'quality_fallback')) AS ocr_fields, count(*) FILTER (WHERE contains(source, 'slm')) AS slm_fields, count(*) FILTER (WHERE contains(source, 'vlm')) AS vlm_fields FROM fin",
        "result_documents": f"""{ladder_sql('full')}, g AS (SELECT doc_id, count(*)::INTEGER AS n_fields, max(CASE WHEN field_name = 'dealer_name' THEN (CASE WHEN contains(source, 'slm') THEN 'slm' ELSE source END) END) AS dealer_source, round(min(confidence), 4) AS confidence, sum(cost::DECIMAL(10,4))::DOUBLE AS cost FROM fin GROUP BY doc_id) SELECT * FROM g""",
        "cost_by_doc": f"WITH {LOG} SELECT doc_id, sum(cost)::DOUBLE AS cost, sum(latency::DECIMAL(18,6))::DOUBLE AS latency, count(*) AS calls FROM lg GROUP BY doc_id",
        "cost_breakdown": f"WITH {LOG} SELECT doc_id, component, sum(cost)::DOUBLE AS cost, sum(latency::DECIMAL(18,6))::DOUBLE AS latency, count(*) AS calls FROM lg GROUP BY ALL",
        "cost_summary": f"""WITH {LOG}, t AS (SELECT count(DISTINCT doc_id) AS documents, sum(cost)::DOUBLE AS total_cost, sum(latency::DECIMAL(18,6))::DOUBLE AS total_latency, count(*) FILTER (WHERE component = 'tier3_vlm') AS vlm_calls FROM lg)
            SELECT *, total_cost / documents AS average_cost, total_latency / documents AS average_latency, vlm_calls::DOUBLE / documents AS vlm_rate, total_cost / documents < 0.01::DOUBLE AS cost_ok, total_latency / documents < 30 AS latency_ok, vlm_calls::DOUBLE / documents < 0.1::DOUBLE AS vlm_ok FROM t""",
        "cost_windows": f"WITH {LOG} SELECT date_trunc('day', ts)::TIMESTAMP AS start, sum(cost)::DOUBLE AS cost, count(*) AS calls, count(*) FILTER (WHERE component = 'tier3_vlm') AS vlm_calls FROM lg GROUP BY ALL",
        "log_metadata": "SELECT event_id AS call_id, coalesce(json_extract(props, '$.k')::INTEGER, 0) AS k FROM events",
        "eval_fields": f"""WITH {joined}, v AS (SELECT *, CASE WHEN vis AND p AND gp AND b IS NOT NULL AND gb IS NOT NULL THEN {iou('b', 'gb')} END AS i FROM jd WHERE has_g)
            SELECT field_name, count(*) FILTER (WHERE ok) AS correct, count(*) AS total, count(*) FILTER (WHERE ok)::DOUBLE / count(*) AS accuracy, count(i) AS iou_samples, round(avg(i), 6) AS mean_iou FROM v GROUP BY field_name""",
        "eval_docs": f"WITH {joined}, v AS (SELECT doc_id, count(*) FILTER (WHERE ok) >= {len(FIELDS)} AS r FROM jd WHERE has_g GROUP BY doc_id) SELECT count(*) FILTER (WHERE r) AS correct_documents, count(*) AS documents, count(*) FILTER (WHERE r)::DOUBLE / count(*) AS accuracy FROM v",
        "eval_strict": f"WITH {ALL}, {GOLD}, {STRICT} SELECT doc_id, field_name, correct, score FROM st",
        "eval_overall": f"WITH {ALL}, {GOLD}, {STRICT} SELECT coalesce(field_name, 'overall') AS field_name, count(*) FILTER (WHERE correct) AS correct, count(*) AS total, count(*) FILTER (WHERE correct) * 100::DOUBLE / count(*) AS accuracy FROM st GROUP BY ROLLUP (field_name)",
        "eval_skips": """SELECT g.o_orderkey AS doc_id, CASE WHEN g.o_orderkey % 5 = 0 THEN 'golden_error' WHEN p.o_orderkey IS NULL THEN 'not_in_results' WHEN p.o_orderkey % 13 = 0 THEN 'prediction_error' WHEN g.o_orderkey % 11 = 0 OR p.o_orderkey % 17 = 0 THEN 'missing_fields' END AS skip_reason
            FROM (SELECT * FROM orders WHERE o_orderkey % 3 = 0) g LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 4 <> 0) p ON g.o_orderkey = p.o_orderkey""",
        "diagnostics_accuracy": f"WITH {ALL}, {GOLD}, {judged('agr', 'jd', False)}, v AS (SELECT doc_id, bool_and(has_g AND ok) AS r FROM jd GROUP BY doc_id) SELECT count(*) FILTER (WHERE r) AS correct_documents, count(*) AS documents, count(*) FILTER (WHERE r)::DOUBLE / count(*) AS accuracy FROM v",
        "error_breakdown": f"WITH {ALL}, {GOLD}, {judged('agr', 'jd', False)} SELECT {CATEGORY} AS category, count(*) AS errors FROM jd WHERE has_g AND NOT ok GROUP BY 1",
        "error_by_field": f"WITH {ALL}, {GOLD}, {judged('agr', 'jd', False)} SELECT field_name, {CATEGORY} AS category, count(*) AS errors FROM jd WHERE has_g AND NOT ok GROUP BY ALL",
        "error_report": f"WITH {ALL}, {GOLD}, {judged('agr', 'jd', False)} SELECT doc_id, field_name AS field, {CATEGORY} AS category, confidence FROM jd WHERE has_g AND NOT ok ORDER BY doc_id, field_name LIMIT 100",
        "report_values": f"WITH {joined}, v AS (SELECT doc_id, field_name, ok AS correct, coalesce(s, n::DECIMAL(18,3)::VARCHAR) AS p_, coalesce(gs, gn::DECIMAL(18,3)::VARCHAR) AS g_, n, gn FROM jd WHERE has_g AND NOT vis) SELECT doc_id, field_name, correct, CASE WHEN coalesce(n, 1) <> 0 THEN substr(nullif(p_, ''), 1, 100) END AS predicted, CASE WHEN coalesce(gn, 1) <> 0 THEN substr(nullif(g_, ''), 1, 100) END AS ground_truth FROM v",
        "plain_similarity": f"{i}, {SELL}, l AS (SELECT doc_id, lower({strip('a')}) AS x, lower({strip('b')}) AS y FROM sell) SELECT doc_id, round(CASE WHEN x IS NULL OR y IS NULL THEN 0::DOUBLE WHEN x = y THEN 100::DOUBLE WHEN contains(x, y) OR contains(y, x) THEN 80::DOUBLE ELSE 100::DOUBLE * ({jaccard(tokens('x'), tokens('y'))}) END, 9) AS score FROM l",
        "simple_documents": f"{ladder_sql('full')} SELECT doc_id, round_even(count(*) * 0.25::DOUBLE, 1) AS processing_time_sec, round_even(sum(cost::DECIMAL(10,4))::DOUBLE, 4) AS cost_estimate_usd FROM fin GROUP BY doc_id",
        "outcomes": f"WITH {ALL}, ok_ AS (SELECT DISTINCT doc_id FROM agr WHERE s IS NOT NULL OR n IS NOT NULL) SELECT count(*) AS documents, count(o.doc_id) AS succeeded, count(*) - count(o.doc_id) AS failed FROM inv LEFT JOIN ok_ o ON inv.doc_id = o.doc_id",
        "calibration_samples": f"WITH {ALL}, {GOLD}, {judged('agr', 'jd', False)} SELECT field_name, count(*) AS samples, count(*) FILTER (WHERE ok) AS right FROM jd WHERE has_g AND confidence IS NOT NULL GROUP BY field_name",
        "calibrated_fields": f"WITH {ALL} SELECT doc_id, field_name, round(CASE field_name WHEN 'horse_power' THEN 0.4::DOUBLE + 0.5::DOUBLE * greatest(0, least(1, (confidence - 0.5::DOUBLE) / 0.5::DOUBLE)) WHEN 'asset_cost' THEN greatest(0, least(1, (confidence - 0.25::DOUBLE) / 0.5::DOUBLE)) ELSE confidence END, 9) AS calibrated_confidence FROM agr",
        "suppressed": f"""{boxes}, s AS (SELECT x.doc_id, x.class_name, x.confidence AS c0, y.confidence AS c1, {iou('bp.p', 'bp.r')} AS o FROM det x JOIN det y ON x.doc_id = y.doc_id AND x.class_name = y.class_name AND x.det_no = 0 AND y.det_no = 1 JOIN bp ON bp.doc_id = x.doc_id AND bp.class_name = x.class_name)
            SELECT doc_id, class_name, 0 AS det_no FROM s WHERE c0 >= 0.6::DOUBLE AND NOT (c1 > c0 AND o > 0.45::DOUBLE) UNION ALL SELECT doc_id, class_name, 1 FROM s WHERE c1 >= 0.6::DOUBLE AND NOT (c0 >= c1 AND o > 0.45::DOUBLE)""",
        "detection_counts": f"""{i}, {DET}, c AS (SELECT *, least(bbox[1] + bbox[3], 800) - greatest(0, bbox[1]) AS w, least(bbox[2] + bbox[4], 1100) - greatest(0, bbox[2]) AS h FROM det)
            SELECT doc_id, class_name, count(*) AS detections, count(*) FILTER (WHERE w > 0 AND h > 0 AND CASE class_name WHEN 'signature' THEN density BETWEEN 0.05::DOUBLE AND 0.3::DOUBLE AND components >= 5 ELSE color >= 0.1::DOUBLE AND (circularity >= 0.5::DOUBLE OR rectangularity >= 0.7::DOUBLE) END) AS verified FROM c GROUP BY ALL""",
        "invocations": f"""{ladder_sql('full')}, {LINES}, f AS (SELECT doc_id, source, round(cost * 1000)::INTEGER AS fee FROM fin),
            c AS (SELECT DISTINCT doc_id, engine, engine || '_ocr' AS component FROM lines UNION ALL SELECT DISTINCT doc_id, class_name, 'yolo_' || class_name FROM det
              UNION ALL SELECT doc_id, '', 'tier1_rules' FROM f WHERE fee > 0 OR (source LIKE 'tier1%' AND source <> 'tier1_consensus') UNION ALL SELECT doc_id, '', 'tier2_slm' FROM f WHERE fee % 20 <> 0 UNION ALL SELECT doc_id, '', 'tier3_vlm' FROM f WHERE fee >= 20)
            SELECT component, count(*) AS calls, count(DISTINCT doc_id) AS documents FROM c GROUP BY component""",
        "ablation": f"""WITH {ALL}, {GOLD}, pv AS (
              SELECT 'consensus' AS config, doc_id, field_name, s, n, p, b, num, vis FROM agr UNION ALL SELECT 'paddle_only', doc_id, field_name, s1, n1, p1, b1, num, vis FROM agr UNION ALL SELECT 'deepseek_only', doc_id, field_name, s2, n2, p2, b2, num, vis FROM agr),
            {judged('pv', 'jd')}, v AS (SELECT config, doc_id, count(*) FILTER (WHERE ok) >= {len(FIELDS)} AS r FROM jd WHERE has_g GROUP BY ALL)
            SELECT config, count(*) FILTER (WHERE r) AS correct_documents, count(*) AS documents, count(*) FILTER (WHERE r)::DOUBLE / count(*) AS accuracy FROM v GROUP BY config""",
        "calibration_bins": f"WITH {SAMPLES}, {BINS} SELECT field_name, bin, samples, value FROM bins",
        "calibration_apply": f"WITH {SAMPLES}, {BINS} SELECT sm.field_name, sm.confidence, min(coalesce(value, sm.confidence)) AS calibrated, count(*) AS samples FROM sm LEFT JOIN bins b ON b.field_name = sm.field_name AND b.bin = least(floor(sm.confidence * 10), 9) GROUP BY ALL",
        "ece": f"""WITH {SAMPLES}, b AS (SELECT field_name, floor(confidence * 10) AS bin, count(*) AS k, count(*) FILTER (WHERE correct) AS yes, sum(confidence::DECIMAL(18,9)) AS total FROM sm GROUP BY ALL)
            SELECT field_name, sum(k)::BIGINT AS samples, sum(yes)::DOUBLE / sum(k) AS accuracy, round(sum(CASE WHEN bin >= 0 AND bin < 10 THEN abs(yes - total) ELSE 0 END)::DOUBLE / sum(k), 9) AS ece FROM b GROUP BY field_name""",
        "al_lowconf": f"WITH {ROWS} SELECT * FROM rs ORDER BY coalesce(confidence, 0), pos LIMIT 10",
        "al_borderline": f"WITH {ROWS} SELECT * FROM rs WHERE confidence BETWEEN 0.6::DOUBLE AND 0.95::DOUBLE ORDER BY pos LIMIT 10",
        "al_sample": f"WITH {ROWS}, {SAMPLE} SELECT doc_id, reason, rank::INTEGER AS rank FROM (SELECT * FROM un QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY part, rank) = 1) ORDER BY part, un.rank LIMIT 30".replace("ORDER BY part, un.rank", "ORDER BY part, 3"),
        "unannotated": f"WITH {INV}, {GOLD}, {ROWS} SELECT doc_id FROM rs WHERE doc_id NOT IN (SELECT doc_id FROM gd)",
        "annotation_progress": f"WITH {INV}, {GOLD} SELECT count(DISTINCT doc_id) AS annotated, least(count(DISTINCT doc_id) / 50::DOUBLE, 1::DOUBLE) AS progress, count(DISTINCT doc_id) >= 50 AS enough FROM gold",
        "synthetic_docs": f"""WITH m AS (SELECT o_orderkey AS doc_id, c AS class_name, {_draw('present')} % 100 < CASE c WHEN 'signature' THEN 70 ELSE 60 END AS present,
              ({_draw('x')} % (800 - CASE c WHEN 'signature' THEN 200 ELSE 100 END))::INTEGER AS x, (300 + {_draw('y')} % (300 - CASE c WHEN 'signature' THEN 60 ELSE 100 END))::INTEGER AS y FROM orders, (VALUES ('signature'), ('stamp')) t(c))
            SELECT doc_id, class_name, present, CASE WHEN present THEN x END AS x, CASE WHEN present THEN y END AS y, CASE WHEN present THEN (CASE class_name WHEN 'signature' THEN 200 ELSE 100 END) END AS w, CASE WHEN present THEN (CASE class_name WHEN 'signature' THEN 60 ELSE 100 END) END AS h FROM m""",
        "mock_invoices": f"""WITH m AS (SELECT o_orderkey AS doc_id, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT AS h FROM orders)
            SELECT doc_id, 'TAX INVOICE' || chr(10) || 'Dealer: ' || {pick(DEALERS, 'h // 3')} || chr(10) || 'Model: ' || {pick(('Mahindra 575 DI', 'John Deere 5050D', 'Swaraj 744 FE', 'Sonalika DI 745', 'New Holland 3630'), 'h // 5')} || chr(10) || 'Horse Power: ' || (35 + (h // 7) % 41) || ' HP' || chr(10) || 'Total Amount: Rs. ' || (500000 + (h // 11) % 700001) AS text, 0.85::DOUBLE AS confidence FROM m""",
    }
