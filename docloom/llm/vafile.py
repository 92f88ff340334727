"""Exact top-k inner-product search with a vector-approximation file.

Vectors become integers, floor(scale * component).  Every dimension is cut into
``cells`` cells at quantiles of a bounded sample; the file holds one byte per
component, the cell it falls in, and the smallest and largest value that each
cell holds in the whole table.  These bound every inner product from both sides
(an upper bound on the score is a lower bound on the distance).

The file is written once and scanned in blocks of rows against blocks of
queries; exact vectors do not travel there.  A block keeps, per query, the rows
whose upper bound reaches the block's kth largest lower bound; the kth largest
of all blocks then leaves the candidates.  Exact vectors are read in order of
the bound: first the ``k`` candidates with the largest upper bounds, then those
whose bound still reaches the kth exact score, which makes the kth result
certain.  Every merge is a ranked window that keeps ``k`` rows per query, so no
task holds a list that grows with the table.

Defined cases: vectors that are null or hold null or non-finite components, or
whose length differs from the most common length of the table (ties: the
longer), take no part; so do rows with a null id.  Ties in score go to the
smaller id; a large group of equal vectors gives ``k`` candidates per block.
Repeated ids are separate candidates, except that a query's own id is never its
candidate; a repeated query id is asked once, with its smallest vector.  An
empty table gives no rows and other columns are ignored, whatever their names.
Scores that could leave 2^53 are computed with Python integers and must fit a
long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._util import Scratch


@dataclass(frozen=True)
class VaParams:
    k: int = 20
    scale: float = 64.0
    cells: int = 64
    sample: int = 16_384
    block: int = 32_768
    query_block: int = 4096
    seed: int = 7


def usable(vector: Column) -> Column:
    """Whether a vector is present and all its components are finite."""
    return F.coalesce(
        vector.isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))),
        F.lit(False),
    )


@dataclass(frozen=True)
class Cells:
    """Cut points per dimension, and the smallest and largest value in each cell (0 where it is empty)."""

    edges: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def code(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, d], side="right") for d, e in enumerate(self.edges)], 1).astype(np.uint8)

    def bounds(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.arange(codes.shape[1])
        return self.low[d, codes], self.high[d, codes]


def cut_points(x: np.ndarray, cells: int) -> np.ndarray:
    return np.quantile(x, np.linspace(0, 1, cells + 1)[1:-1], axis=0, method="higher").T


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = flat if isinstance(flat, pa.ListArray) else pa.concat_arrays(flat.chunks)
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


def _codes(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, dim)


def candidates(ids: np.ndarray, codes: np.ndarray, query_ids: np.ndarray, q: np.ndarray, cells: Cells, k: int, slack: float = 0.0):
    """Per query, the rows that may be among its best ``k`` by the bounds alone: ``(query, row, lower, upper)``, a query at a time.

    ``ids`` ascend.  Left out are rows that ``k`` others are certain to beat, by score or by id.
    """
    lo, hi = cells.bounds(codes)
    for at in range(0, len(q), 64):
        up, down = np.maximum(q[at : at + 64], 0), np.minimum(q[at : at + 64], 0)
        upper, lower = up @ hi.T + down @ lo.T + slack, up @ lo.T + down @ hi.T - slack
        for i, own in enumerate(query_ids[at : at + 64]):
            u, v = upper[i], lower[i]
            other = ids != own
            v = np.where(other, v, -np.inf)
            if int(other.sum()) <= k:
                keep = np.flatnonzero(other)
            else:
                least = np.partition(v, len(v) - k)[len(v) - k]
                above = v > least
                tied = np.flatnonzero(v == least)[: k - int(above.sum())]
                sure = above
                sure[tied] = True
                keep = np.flatnonzero(other & (sure | (u > least) | ((u == least) & (ids < ids[tied[-1]]))))
            yield own, keep, v[keep], u[keep]


_FOUND = pa.schema([("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])


def _scan(cells: Cells, p: VaParams):
    """The candidates of one block of the file for one block of queries."""

    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return _FOUND.empty_table()
        left = left.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        ids, rows, codes, q = np.asarray(left["vec_id"]), np.asarray(left["row"]), _codes(left["code"], len(cells.edges)), _matrix(right["x"])
        top = max(float(np.abs(cells.low).max()), float(np.abs(cells.high).max())) * float(np.abs(q).max(initial=0)) * q.shape[1]
        # sums of products below 2^52 are exact
        found = list(candidates(ids, codes, np.asarray(right["vec_id"]), q, cells, p.k, 0.0 if top < 2**52 else top * 1e-9))
        at = np.concatenate([k for _, k, _, _ in found])
        cols = [np.repeat([o for o, *_ in found], [len(k) for _, k, _, _ in found]), rows[at], ids[at], np.concatenate([v for *_, v, _ in found]), np.concatenate([u for *_, u in found])]
        return pa.table([pa.array(c) for c in cols], schema=_FOUND)

    return run


def _exact(batches):
    for b in batches:
        if not b.num_rows:
            continue
        q, x = _matrix(b.column(2)), _matrix(b.column(3))
        if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2**52:
            s = np.einsum("ij,ij->i", q, x).astype(np.int64)
        else:
            s = [sum(int(a) * int(c) for a, c in zip(u, v, strict=True)) for u, v in zip(q, x, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.int64())], names=["query_id", "vec_id", "score"])


def _fit(rows: DataFrame, n: int, dim: int, p: VaParams) -> Cells:
    """Cells from a bounded sample; their extents from every row."""
    share = min(1.0, p.sample / max(1, n))
    draw = rows.filter(F.pmod(F.xxhash64("row", F.lit(p.seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("x").limit(2 * p.sample).toArrow()
    x = _matrix(draw["x"]) if draw.num_rows else np.zeros((1, dim))
    plain = Cells(cut_points(x, p.cells), np.empty(0), np.empty(0))

    def extents(batches):
        low, high = np.full((dim, p.cells), np.inf), np.full((dim, p.cells), -np.inf)
        d = np.arange(dim)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0))
                codes = plain.code(x)
                np.minimum.at(low, (d, codes), x)
                np.maximum.at(high, (d, codes), x)
        d, c = np.nonzero(low <= high)
        yield pa.RecordBatch.from_arrays([pa.array(d.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(low[d, c]), pa.array(high[d, c])], names=["d", "c", "low", "high"])

    # a row per dimension and cell
    held = rows.select("x").mapInArrow(extents, "d int, c int, low double, high double").groupBy("d", "c").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    low, high = np.zeros((dim, p.cells)), np.zeros((dim, p.cells))
    at = (held["d"].to_numpy(), held["c"].to_numpy())
    low[at], high[at] = held["low"].to_numpy(), held["high"].to_numpy()
    return Cells(plain.edges, low, high)


def top_k(vectors: DataFrame, is_query: Column, p: VaParams = VaParams(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best other rows for every row that ``is_query`` marks.

    ``is_query`` is an expression over the id column.
    """
    scratch = Scratch(vectors.sparkSession, "va")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("_v"), is_query.alias("q"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("_v")))
    rows = rows.select("vec_id", F.transform(F.col("_v").cast("array<double>"), lambda c: F.floor(c * F.lit(p.scale)).cast("double")).alias("x"), "q")
    # the row number is fixed once it is written
    rows = scratch.table(rows.withColumn("row", F.monotonically_increasing_id()), "exact")
    # row counts and vector length only: a handful of numbers
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).orderBy(F.desc("n"), F.desc("d")).first()
    dim, n, nq = (sizes["d"], sizes["n"], sizes["q"]) if sizes else (1, 1, 1)
    rows = rows.filter(F.size("x") == dim)
    cells = _fit(rows, n, dim, p)

    def approximate(batches):
        for b in batches:
            if b.num_rows:
                codes = cells.code(_matrix(b.column(2)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in codes], pa.binary())], names=["row", "vec_id", "code"])

    file = scratch.table(rows.select("row", "vec_id", "x").mapInArrow(approximate, "row long, vec_id long, code binary"), "approximation")
    blocks, query_blocks = -(-n // p.block), max(1, -(-nq // p.query_block))
    dealt = lambda c, salt, m: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(m)).cast("int")
    data = file.select("row", "vec_id", "code", dealt("row", "block", blocks).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    asked = rows.filter("q").groupBy("vec_id").agg(F.min("x").alias("x"))
    queries = asked.select("vec_id", "x", dealt("vec_id", "query", query_blocks).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    found = data.groupBy("b", "qb").cogroup(queries.groupBy("b", "qb")).applyInArrow(_scan(cells, p), "query_id long, row long, vec_id long, lower double, upper double")
    found = scratch.table(found, "candidates")
    ranked = lambda df, *by: df.withColumn("at", F.row_number().over(W.partitionBy("query_id").orderBy(*by)))
    exact = rows.select("row", F.col("x").alias("xv"))
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("x").alias("xq"))
    read = lambda c: c.join(exact, "row").join(asked, "query_id").select("query_id", "vec_id", "xq", "xv").mapInArrow(_exact, "query_id long, vec_id long, score long")
    # no more than k others are certain to reach this bound
    bar = ranked(found, F.desc("lower"), "vec_id").filter(F.col("at") <= p.k).groupBy("query_id").agg(F.min("lower").alias("bar"))
    found = found.join(bar, "query_id").filter(F.col("upper") >= F.col("bar")).select("query_id", "row", "vec_id", "upper")
    first = scratch.table(ranked(found, F.desc("upper"), "vec_id", "row").filter(F.col("at") <= p.k).drop("at"), "first")
    scores = scratch.table(read(first), "scores")
    kth = scores.groupBy("query_id").agg(F.min("score").alias("kth"))
    rest = found.join(first.select("query_id", "row"), ["query_id", "row"], "left_anti").join(kth, "query_id").filter(F.col("upper") >= F.col("kth"))
    scores = scores.unionByName(read(rest))
    best = ranked(scores, F.desc("score"), "vec_id").filter(F.col("at") <= p.k)
    return best.select("query_id", F.col("at").cast("int").alias("rank"), "vec_id", "score")
