"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are token counts.  Targets share ``share`` of all tokens by weight, no
source above ``most`` times its own size, the excess reshared by weight among
the rest until none is above.  A source's documents are dealt to shards of
about ``shard_docs`` documents by a hash of the id.  Tokens are counted in equal
blocks; Sainte-Laguë (highest quotients t / (2k + 1)) turns targets into
integer block quotas per source and then per shard.  The divisor form of the
rule is used, so quotas cost a few vector operations and not one step per
block.  Within a shard, documents stand in seeded order and a seeded systematic
draw selects exactly the quota of blocks; what each document contributes
follows in closed form from its running total, so blocks are never expanded.

Only one row per shard reaches the driver (one per 8,192 documents); the
running totals are windows over one shard each, so a source that holds a third
of all rows is as many tasks as it has shards.  Rows with equal id, source and
text are one entry with a count until the end, so no key holds more than one
row however often a row repeats or an id is null.

``draw`` turns the blocks into whole documents: within a shard, in its order, a
document is taken so often that the words drawn so far stay nearest to the words
of the blocks selected so far.

Defined cases: null text has size 0 and a null source is a source of its own,
last in order.  Documents of size 0 take 0 words; ``draw`` drops them.  Rows with equal
ids are separate documents; those with equal texts too share their words evenly.
Texts of any length count whole.  Ties in order go to the smaller id.  An empty
table gives no rows.  Other columns pass through ``draw`` and are else ignored,
whatever their names.  Reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._util import Scratch

#: A token of the size rule: a run without space, tab, newline, vertical tab, form feed or return.
TOKEN = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class MixParams:
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: float = 2.0
    block: int = 16
    shard_docs: int = 8192
    seed: int = 11


def targets(sizes: np.ndarray, weights: np.ndarray, total: float, most: float) -> np.ndarray:
    """Shares of ``total`` by weight, none above ``most`` times its size."""
    cap = most * sizes.astype(np.float64)
    out = np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    rest = total
    while free.any():
        w = np.where(free, weights, 0.0)
        share = rest * w / w.sum()
        over = free & (share > cap)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = cap[over]
        rest -= float(cap[over].sum())
        free &= ~over
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients votes / (2k + 1), none above ``most``; ties to the earlier entry.

    A divisor is found by bisection such that rounding votes / divisor gives at
    most ``seats``; the few seats then missing go to the next quotients.
    """
    votes, most = votes.astype(np.float64), most.astype(np.int64)
    seats = int(min(seats, most[votes > 0].sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)
    lo, hi = 0.0, 4.0 * float(votes.max()) + 1.0
    at = lambda d: np.where(votes > 0, np.minimum(np.floor(votes / d + 0.5), most), 0).astype(np.int64)
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        if int(at(mid).sum()) <= seats:
            hi = mid
        else:
            lo = mid
    out = at(hi)
    while (missing := seats - int(out.sum())) > 0:
        quotient = np.where((out < most) & (votes > 0), votes / (2 * out + 1), -1.0)
        best = np.argsort(-quotient, kind="stable")[:missing]
        out[best[quotient[best] > 0]] += 1
    return out


def _sized(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per distinct id, source and text: ``doc_id, source, h1, h2, size, rows``."""
    text, doc, source = F.col(text_col).cast("string"), F.col(id_col).cast("long"), F.col(source_col).cast("string")
    sized = docs.select(doc.alias("doc_id"), source.alias("source"), *_keys(doc, source, text), F.coalesce(F.regexp_count(text, F.lit(TOKEN)).cast("long"), F.lit(0).cast("long")).alias("size"))
    return scratch.table(sized.groupBy("doc_id", "source", "h1", "h2", "size").agg(F.count(F.lit(1)).alias("rows")), "sizes")


def _keys(doc, source, text) -> list:
    """128 bits of an id, a source and a text; nulls are kept apart from empty values."""
    parts = [F.coalesce(c.cast("string"), F.lit("none")) for c in (doc, source, text)] + [c.isNull() for c in (doc, source, text)]
    return [F.xxhash64(F.lit(salt), *parts).alias(name) for salt, name in ((1, "h1"), (2, "h2"))]


def mix(docs: DataFrame, p: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``source`` per document."""
    scratch = Scratch(docs.sparkSession, "mix")
    mixed = apportion(_sized(docs, scratch, id_col, text_col, source_col), p, scratch)
    each = mixed.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    taken = F.expr("taken div rows + if(one <= taken % rows, 1L, 0L)")
    return each.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def apportion(sized: DataFrame, p: MixParams, scratch: Scratch) -> DataFrame:
    """The words that the mix takes of each entry of ``sized(doc_id, source, h1, h2, size, rows)``, with its shard and place there."""
    spark = sized.sparkSession
    mass = F.col("size") * F.col("rows")
    # one row per source: few numbers
    totals = sized.groupBy("source").agg(F.sum(mass).alias("size"), F.count(F.lit(1)).alias("docs")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    names = [r["source"] for r in totals]
    size = np.array([r["size"] for r in totals], np.int64)
    weight = np.array([p.weights[i % len(p.weights)] for i in range(len(totals))], np.float64)
    target = targets(size, weight, p.share * float(size.sum()), p.most) if len(totals) else np.zeros(0)
    of = spark.createDataFrame(
        [(n, int(s), float(t), max(1, -(-r["docs"] // p.shard_docs))) for n, s, t, r in zip(names, size, target, totals, strict=True)],
        "of_source string, source_size long, target double, shards int",
    )
    dealt = sized.join(of, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("h1", F.lit(p.seed)), F.col("shards")).cast("int"))
    dealt = scratch.table(dealt, "dealt")
    rows = dealt.groupBy("source", "shard").agg(F.sum(mass).alias("size")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or "", r["shard"]))
    blocks = np.array([-(-r["size"] // p.block) for r in rows], np.int64)
    words = np.array([r["size"] for r in rows], np.int64)
    which = {n: i for i, n in enumerate(names)}
    home = np.array([which[r["source"]] for r in rows], np.int64)
    in_source = np.bincount(home, blocks, len(names)).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    cap = int(np.ceil(p.most)) * in_source
    quota = sainte_lague(target, round(float(target.sum()) / p.block), cap) if len(rows) else np.zeros(0, np.int64)
    given = np.zeros(len(rows), np.int64)
    for i in range(len(names)):
        own = np.flatnonzero(home == i)
        # a source at its bound takes every block as often as the bound says
        seats = int(cap[i]) if len(own) and target[i] >= p.most * size[i] > 0 else int(quota[i])
        given[own] = sainte_lague(words[own], seats, int(np.ceil(p.most)) * blocks[own])
    rng = np.random.default_rng(p.seed)
    plan = [(r["source"], r["shard"], int(b), int(q), int(rng.integers(0, max(1, b)))) for r, b, q in zip(rows, blocks, given, strict=True)]
    shards = spark.createDataFrame(plan, "source_ string, shard_ int, blocks long, quota long, phase long")
    order = W.partitionBy("source", "shard").orderBy(F.xxhash64("h1", F.lit(p.seed + 1)), "doc_id", "size", "h2")
    placed = dealt.withColumns({"place": F.row_number().over(order), "begin": F.coalesce(F.sum(mass).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))})
    placed = placed.join(shards, placed["source"].eqNullSafe(shards["source_"]) & (placed["shard"] == shards["shard_"]))
    # words selected among a shard's first x: whole blocks before x, then the part of its block
    upto = "((({x} div {b}) * quota + phase) div blocks) * {b} + ((((({x} div {b}) + 1) * quota + phase) div blocks) - ((({x} div {b}) * quota + phase) div blocks)) * ({x} % {b})"
    first = upto.format(x="begin", b=f"{p.block}L")
    last = upto.format(x="(begin + size * rows)", b=f"{p.block}L")
    taken = F.expr(f"CASE WHEN blocks = 0 THEN 0L ELSE {last} - ({first}) END")
    return placed.select("doc_id", "source", "h1", "h2", "size", "rows", "source_size", "target", taken.cast("long").alias("taken"), "shard", "place")


def whole(size: np.ndarray, rows: np.ndarray, taken: np.ndarray, most: int) -> np.ndarray:
    """How often each entry is drawn, in order, so that the words drawn so far stay nearest to the words taken so far."""
    out, due = np.zeros(len(size), np.int64), 0
    for i, (s, r, t) in enumerate(zip(size.tolist(), rows.tolist(), taken.tolist(), strict=True)):
        due += t
        if s:
            out[i] = min(max((2 * due + s) // (2 * s), 0), most * r)
            due -= int(out[i]) * s
    return out


_DRAWN = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("_rows", pa.int64()), ("_times", pa.int64())])


def _draw(p: MixParams):
    def run(table):
        table = table.sort_by("place")
        times = whole(*(table[c].to_numpy() for c in ("size", "rows", "taken")), int(np.ceil(p.most)))
        return pa.table([table["h1"], table["h2"], table["rows"], pa.array(times)], schema=_DRAWN).filter(pa.array(times > 0))

    return run


def draw(docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """``docs`` as the mix takes them: each row zero, one or two times, whole.

    The words of every shard of a source stay within half a document of its quota
    of blocks.  Rows that are equal but for their columns share their draws.
    """
    scratch = Scratch(docs.sparkSession, "draw")
    mixed = apportion(_sized(docs, scratch, "doc_id", "text", "source"), p, scratch)
    drawn = mixed.groupBy("source", "shard").applyInArrow(_draw(p), "h1 long, h2 long, _rows long, _times long")
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    at = {c: F.col(n) for c, n in zip(docs.columns, names, strict=True)}
    keyed = rows.select(*names, *_keys(at["doc_id"].cast("long"), at["source"].cast("string"), at["text"].cast("string")), F.monotonically_increasing_id().alias("_row"))
    # equal rows differ by their row number alone
    offset = F.when(F.col("_rows") == 1, F.lit(0.0)).otherwise(F.pmod(F.xxhash64("_row", F.lit(p.seed + 2)), F.lit(1 << 40)) / F.lit(float(1 << 40)))
    taken = keyed.join(drawn, ["h1", "h2"]).withColumn("_copies", F.floor(F.col("_times") / F.col("_rows") + offset).cast("int")).filter("_copies > 0")
    taken = taken.select(*names, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
    return taken.select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)))
