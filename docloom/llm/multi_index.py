"""Embedding near-duplicates through an inverted multi-index.

Unit vectors are cut in halves; each half has a codebook of its own (k-means on
a bounded sample), and the pairs of codewords form a product grid of cells that
grows with the rows of a label (one word per sampled vector and half at most).
Every vector lies in one cell and visits the grid's cells in multi-sequence
order, nearest first, until the visits reach the target recall: the number of
visits is the quantile, over sampled vectors, of the rank at which a neighbour
at exactly the threshold is met.  Rows meet in ``(label, cell)`` groups, cut in
blocks so that a crowded cell is many tasks, and cosines in double precision
decide.  Exact copies (equal label and components) collapse to one row with a
count first.  A pair met from both sides counts once: the side that is met
second is recognised from its visit list.  Vectors travel in the type they are
stored in, and are scaled to unit length where they meet.

The output is one row per vector with its number of links and its component;
link lists are never expanded, since within a block only a spanning set of the
links leaves the task (links of equal components inside a block add nothing).

Defined cases: null or zero vectors, vectors with null or non-finite
components, or with a null label or id, link with nothing; their component is
their own id.  Vectors of another length than the most common one (ties: the
longer) link with nothing either.  Labels of any type compare by their text.  Rows
of a repeated id are separate vectors, each with its own links and component.  An
empty table gives no rows and other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import Scratch, connected_components
from .vafile import usable


@dataclass(frozen=True)
class MultiIndexParams:
    cosine: float = 0.93
    recall: float = 0.995
    sample: int = 4096
    rows_per_cell: int = 256
    block: int = 2048
    seed: int = 5


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)
        for i in range(k):
            own = x[near == i]
            if len(own):
                c[i] = own.mean(0)
    return c


@dataclass(frozen=True)
class Codebooks:
    first: np.ndarray
    second: np.ndarray
    visits: int

    def visit(self, x: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The nearest cells of each row in multi-sequence order (cell = i * words + j)."""
        half = len(self.first[0])
        # squared distances but for the length of the row itself, which changes no order
        da = (self.first**2).sum(1) - 2 * x[:, :half] @ self.first.T
        db = (self.second**2).sum(1) - 2 * x[:, half:] @ self.second.T
        want = min(visits or self.visits, da.shape[1] * db.shape[1])
        # of the sorted distance lists only pairs with (i + 1)(j + 1) <= want can be among the first ``want`` sums
        ia, ib = np.argsort(da, 1, kind="stable"), np.argsort(db, 1, kind="stable")
        pairs = np.array([(i, j) for i in range(min(want, da.shape[1])) for j in range(min(want // (i + 1), db.shape[1]))])
        sums = np.take_along_axis(da, ia, 1)[:, pairs[:, 0]] + np.take_along_axis(db, ib, 1)[:, pairs[:, 1]]
        order = np.argsort(sums, 1, kind="stable")[:, :want]
        return ia[np.arange(len(x))[:, None], pairs[order, 0]] * db.shape[1] + ib[np.arange(len(x))[:, None], pairs[order, 1]]


def fit(x: np.ndarray, rows: int, labels: int, p: MultiIndexParams) -> Codebooks:
    """Codebooks from sampled unit vectors, and the visits that reach the target recall at the threshold."""
    rng = np.random.default_rng(p.seed)
    words = int(np.clip(np.ceil(np.sqrt(rows / max(1, labels) / p.rows_per_cell)), 1, len(x)))
    half = x.shape[1] // 2
    books = Codebooks(_kmeans(x[:, :half], words, rng), _kmeans(x[:, half:], words, rng), words * words)
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    y = p.cosine * x + np.sqrt(1 - p.cosine**2) * y
    rank = []
    for at in range(0, len(x), 256):
        a, b = books.visit(x[at : at + 256]), books.visit(y[at : at + 256])
        rank.append(np.minimum((a == b[:, :1]).argmax(1), (b == a[:, :1]).argmax(1)) + 1)
    rank = np.concatenate(rank)
    return Codebooks(books.first, books.second, int(np.quantile(rank, p.recall, method="higher")))


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length, by their largest component first so that the norm stays finite."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _place(books: Codebooks):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = units(np.asarray(b.column("v").flatten()).reshape(b.num_rows, -1))
            cells = np.concatenate([books.visit(x[i : i + 256]) for i in range(0, len(x), 256)]).astype(np.int32)
            visits = pa.ListArray.from_arrays(np.arange(0, cells.size + 1, cells.shape[1], dtype=np.int32), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays(
                [b.column("gid"), b.column("label"), b.column("mult"), pa.array(cells[:, 0]), visits, b.column("v")],
                names=["gid", "label", "mult", "cell", "visits", "v"],
            )

    return run


def _rows(t: pa.Table, name: str) -> np.ndarray:
    flat = t[name].combine_chunks()
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


_FOUND = pa.schema([("gid", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def _verify(p: MultiIndexParams):
    """Link counts, and a spanning set of links, of one block of a cell against one block of its visitors."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _FOUND.empty_table()
        rid, rm, rv, rvis = np.asarray(left["gid"]), np.asarray(left["mult"]), units(_rows(left, "v")), _rows(left, "visits")
        qid, qm, qv, qcell = np.asarray(right["gid"]), np.asarray(right["mult"]), units(_rows(right, "v")), np.asarray(right["cell"])
        order = np.argsort(rid, kind="stable")
        rid, rm, rv, rvis = rid[order], rm[order], rv[order], rvis[order]
        count_r, count_q = np.zeros(len(rid), np.int64), np.zeros(len(qid), np.int64)
        us, vs = [], []
        for at in range(0, len(qid), 1024):
            # unit vectors: the product is the cosine
            qi, ri = np.nonzero(qv[at : at + 1024] @ rv.T >= p.cosine)
            qi = qi + at
            other = qid[qi] != rid[ri]
            qi, ri = qi[other], ri[other]
            if not len(qi):
                continue
            np.add.at(count_q, qi, rm[ri])
            # the resident meets the visitor on its own visits, unless the visitor's cell is not among them
            alone = ~(rvis[ri] == qcell[qi][:, None]).any(1)
            np.add.at(count_r, ri[alone], qm[qi[alone]])
            u, v = _spanning(qid[qi], rid[ri])
            us.append(u), vs.append(v)
        n = sum(map(len, us))
        ids = np.concatenate([rid, qid, *us]) if n else np.concatenate([rid, qid])
        links = np.concatenate([count_r, count_q, np.zeros(n, np.int64)])
        other = np.concatenate([rid, qid, *vs]) if n else np.concatenate([rid, qid])
        keep = (links > 0) | (np.arange(len(ids)) >= len(rid) + len(qid))
        return pa.table([pa.array(ids[keep]), pa.array(links[keep]), pa.array(other[keep])], schema=_FOUND)

    return run


def _spanning(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node linked to the smallest node of its component among the links ``u - v``."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def near_duplicates(
    vectors: DataFrame, p: MultiIndexParams = MultiIndexParams(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "imi")
    vector, label = F.col(vector_col), F.col(label_col).cast("string")
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.transform(vector, lambda x: x + F.lit(0).cast("float")).alias("v"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")) & F.exists("v", lambda x: x != 0)
    sizes = rows.filter(good).groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dim = sizes["d"] if sizes else 2
    good = good & (F.size("v") == dim)
    # 128 bits stand for a label and its components wherever the components need not travel
    both = [F.xxhash64(F.lit(salt), "label", "v").alias(f"h{salt}") for salt in (1, 2)]
    unique = rows.filter(good).groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("mult"))
    # the group number is fixed once it is written
    groups, groups_path = scratch.named(unique.select(F.monotonically_increasing_id().alias("gid"), "label", "least", "mult", *both, "v"), "groups")
    n, labels = groups.agg(F.count(F.lit(1)), F.approx_count_distinct("label")).first()
    if n < 2 or dim < 2:
        found = scratch.table(groups.select("gid").limit(0).selectExpr("gid", "0L as links", "gid as other"), "found")
    else:
        share = min(1.0, p.sample / n)
        draw = groups.filter(F.pmod(F.xxhash64("h1", F.lit(p.seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("v").limit(2 * p.sample).collect()
        books = fit(units(np.array([r["v"] for r in draw] or [groups.first()["v"]])), n, labels, p)
        schema = f"gid long, label string, mult long, cell int, visits array<int>, v {groups.schema['v'].dataType.simpleString()}"
        placed, placed_path = scratch.named(groups.mapInArrow(_place(books), schema), "placed")
        crowd = placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / p.block).cast("int").alias("rb"))
        visitors = placed.select("gid", "label", "mult", "v", "cell", F.explode("visits").alias("at"))
        # a cell of rb resident blocks has its visitors dealt to as many blocks
        at = crowd.withColumnRenamed("cell", "at")
        visitors = visitors.join(at, ["label", "at"]).withColumn("qblock", F.pmod(F.xxhash64("gid"), F.col("rb")).cast("int"))
        visitors = visitors.withColumn("rblock", F.explode(F.sequence(F.lit(0), F.col("rb") - 1))).select("label", "at", "rblock", "qblock", "gid", "mult", "v", "cell")
        residents = spark.read.schema(placed.schema).parquet(placed_path).join(crowd, ["label", "cell"]).withColumn("rblock", F.pmod(F.xxhash64("gid"), F.col("rb")).cast("int"))
        residents = residents.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.col("rb") - 1)))
        residents = residents.select("label", F.col("cell").alias("at"), "rblock", "qblock", "gid", "mult", "v", "visits")
        meet = ["label", "at", "rblock", "qblock"]
        found = residents.groupBy(*meet).cogroup(visitors.groupBy(*meet)).applyInArrow(_verify(p), "gid long, links long, other long")
        found = scratch.table(found, "found")
        scratch.drop(placed_path)
    counts = found.filter("links > 0").groupBy("gid").agg(F.sum("links").alias("links"))
    edges = found.filter("gid <> other").select(F.col("gid").alias("u"), F.col("other").alias("v"))
    parts = connected_components(edges, scratch).withColumnRenamed("id", "gid")
    groups = groups.select("gid", "least", "mult", "h1", "h2").join(counts, "gid", "left").join(parts, "gid", "left").withColumn("component", F.coalesce("component", "gid"))
    smallest = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = groups.join(smallest, "component").select("h1", "h2", (F.coalesce("links", F.lit(0).cast("long")) + F.col("mult") - 1).alias("n_links"), "component_id")
    # rows that link with nothing have no hash to meet
    keyed = rows.select("vec_id", *(F.when(good, F.xxhash64(F.lit(salt), "label", "v")).alias(f"h{salt}") for salt in (1, 2)))
    out = keyed.join(groups, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
