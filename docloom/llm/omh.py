"""Near-duplicate documents by Order MinHash with banded alignment.

Every document gets ``sketches`` sketches.  For each, the ``ell`` smallest
occurrence-labelled shingles under one permutation are sampled and kept *in
text order*, which makes a shared sketch evidence of small edit distance and
not only of shared vocabulary.  Texts of ``short`` words or fewer get ``extra``
sketches more, as a single edit spoils most of their shingles.  Documents that share a sketch are candidates; a banded bit-parallel
alignment of their words decides.

Plan: texts are read once into narrow signatures (written to the shared
folder); exact copies collapse to one representative per distinct word
sequence; each sketch bucket links its members to the bucket's smallest
member, which needs a grouped minimum and an equi-join, both linear in the
rows.  A member with many partners is copied once per ``block`` of them, so that
no task holds all.  After alignment, buckets that still hold several components
are compared across components in fixed-size blocks: large buckets by bands of
length that overlap so that every pair within the similarity shares one, an
exact lower bound of the distance discards most pairs before they are aligned,
and a pair is looked at in one bucket only.  So a chain of near copies whose
middle was taken by another member is not lost.

Defined cases: words are lower-case runs of letters and digits.  Null, empty
and word-less texts take no part: each row is its own class.  Texts with fewer
words than a shingle use their whole word sequence as the only shingle.  Texts of
any length are read whole.  Ties go to the smaller id.  Rows with equal ids share a
class, and each of their texts finds its own partners.  Rows with a null doc_id
take no part in matching and keep a null class.  An empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import Scratch, connected_components, in_parts, mix, strings, word_hashes

#: Cells of the word counts that bound a distance; longer texts than a cell can count are not bounded.
HIST, COUNTED = 128, 65_535


@dataclass(frozen=True)
class OmhParams:
    shingle: int = 5
    ell: int = 2
    sketches: int = 40
    extra: int = 24
    short: int = 80
    similarity: float = 0.8
    block: int = 512
    seed: int = 17


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    if len(words) <= k:
        out = np.full(1, 0x51ED, np.uint64)
        for w in words:
            out = mix(out * np.uint64(31) + w)
        return out
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n]
    return mix(out)


def _occurrence_labels(shingles: np.ndarray) -> np.ndarray:
    """Shingle hashes made distinct by their occurrence number."""
    order = np.sort(shingles)
    if not (order[1:] == order[:-1]).any():
        return shingles
    by = np.argsort(shingles, kind="stable")
    run = shingles[by]
    first = np.concatenate([[True], run[1:] != run[:-1]])
    at = np.arange(len(run))
    occurrence = at - np.maximum.accumulate(np.where(first, at, 0))
    out = np.empty_like(shingles)
    out[by] = mix(run + occurrence.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return out


def sketch(words: np.ndarray, p: OmhParams) -> np.ndarray:
    """The order-preserving sketches of one document; 0 for those that only short texts have."""
    shingles = _shingles(words, p.shingle)
    labels = _occurrence_labels(shingles)
    many = p.sketches + (p.extra if len(words) <= p.short else 0)
    rng = np.random.default_rng(p.seed)
    factors = rng.integers(0, 1 << 63, p.sketches + p.extra, dtype=np.uint64)[:many] * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, p.sketches + p.extra, dtype=np.uint64)[:many]
    out = np.zeros(p.sketches + p.extra, np.uint64)
    out[:many] = np.arange(many)
    ell = min(p.ell, len(labels))
    step = max(1, (1 << 20) // len(labels))
    for at in range(0, many, step):
        part = slice(at, min(at + step, many))
        v = (labels ^ shifts[part, None]) * factors[part, None]
        rows = np.arange(len(v))
        chosen = np.empty((len(v), ell), np.int64)
        for j in range(ell):
            chosen[:, j] = v.argmin(1)
            v[rows, chosen[:, j]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        chosen.sort(1)
        for j in range(ell):
            out[part] = mix(out[part] * np.uint64(0x9FB21C651E98DF25) + shingles[chosen[:, j]])
    return out


def _content(words: np.ndarray) -> tuple[int, int]:
    """128 bits of a word sequence."""
    at = np.arange(1, len(words) + 1, dtype=np.uint64)
    h1 = mix(words * (at * np.uint64(2) + np.uint64(1))).sum(dtype=np.uint64)
    h2 = mix(words ^ (at * np.uint64(0x9E3779B97F4A7C15))).sum(dtype=np.uint64)
    return int(h1.view(np.int64)), int(h2.view(np.int64))


def _histogram(words: np.ndarray) -> bytes:
    """Word counts in hashed cells."""
    return np.minimum(np.bincount((words >> np.uint64(40)).astype(np.int64) % HIST, minlength=HIST), COUNTED).astype("<u2").tobytes()


_SIGNATURE = "doc_id long, n int, h1 long, h2 long, hist binary, sk array<long>"
_SIGNATURE_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("hist", pa.binary()), ("sk", pa.list_(pa.int64()))]
)


def _sign(p: OmhParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches):
            cols: list[list] = [[] for _ in _SIGNATURE_ARROW]
            for doc, text in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
                words = word_hashes(text)
                if not len(words):
                    continue
                row = (doc, len(words), *_content(words), _histogram(words), sketch(words, p).view(np.int64).tolist())
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SIGNATURE_ARROW, strict=True)], schema=_SIGNATURE_ARROW)

    return run


def aligned_distance(a: list[int], b: list[int], most: int) -> int | None:
    """Edit distance of two word sequences inside a diagonal band, or None if it exceeds ``most``.

    Bit-parallel dynamic programming (Myers 1999, in Hyyrö's formulation): the
    cells of a column that lie in the band are the bits of one integer, which
    slides down by one word per column.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return None
    lead = 0
    while lead < len(a) and a[lead] == b[lead]:
        lead += 1
    a, b = a[lead:], b[lead:]
    tail = 0
    while tail < len(a) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    if tail:
        a, b = a[:-tail], b[:-tail]
    if not a:
        return len(b) if len(b) <= most else None
    # columns run over b; the band holds rows j-most .. j+most of a
    width = 2 * most + 1
    mask = (1 << width) - 1
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | (1 << (i + most))
    m, n = len(a), len(b)
    # bit k of column j is row j + k - most (rows from 1); rows below 1 act as matching nothing with vertical +1
    vp, vn = mask & ~((1 << most) - 1), 0
    # D[0][j] seen on the diagonal bit ``most``; the score follows the diagonal, then the last row
    score = 0
    diagonal = 1 << most
    for j in range(1, n + 1):
        pm = (places.get(b[j - 1], 0) >> (j - 1)) & mask
        x = pm | vn
        d0 = ((((x & vp) + vp) ^ vp) | x) & mask
        hp = vn | (mask & ~(d0 | vp))
        hn = d0 & vp
        if j <= m:
            if not d0 & diagonal:
                score += 1
        else:
            row = most - (j - m)
            if row < 0:
                return None
            bit = 1 << row
            if hp & bit:
                score += 1
            elif hn & bit:
                score -= 1
        if score > most + max(0, n - j):
            return None
        x = d0 >> 1
        vn = x & hp
        vp = hn | (mask & ~(x | hp))
    return score if score <= most else None


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> float | None:
    """1 - distance / longer length if that reaches ``similarity``, else None."""
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    found = aligned_distance(a.tolist(), b.tolist(), most)
    return None if found is None else 1 - found / longer


_LINK = "u long, v long, similarity double"
_LINK_ARROW = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("similarity", pa.float64())])


def _verify(p: OmhParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last = None, None
        for b in in_parts(batches):
            u, v, s = [], [], []
            for x, y, tx, ty in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strings(b.column(2)), strings(b.column(3)), strict=True):
                if ty != last_text:
                    last_text, last = ty, word_hashes(ty)
                found = similar(word_hashes(tx), last, p.similarity)
                if found is not None:
                    u.append(x), v.append(y), s.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], schema=_LINK_ARROW)

    return run


def _align(pairs: DataFrame, texts: DataFrame, p: OmhParams) -> DataFrame:
    """Links among candidate pairs ``(u, v)``; texts travel only for documents in a pair.

    A ``v`` of many pairs is copied once per ``block`` of them.
    """
    crowd = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / p.block).cast("int").alias("copies"))
    left = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("tu"))
    right = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("tv")).join(crowd.hint("merge"), "v")
    right = right.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    dealt = pairs.join(crowd.hint("merge"), "v").withColumn("copy", F.pmod(F.xxhash64("u"), F.col("copies")).cast("int")).drop("copies")
    joined = dealt.hint("merge").join(left, "u").join(right.hint("merge"), ["v", "copy"]).select("u", "v", "tu", "tv")
    return joined.mapInArrow(_verify(p), _LINK)


_WORDS = "doc_id long, h1 long, h2 long, words binary"


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_parts(batches):
        words = [word_hashes(t) for t in strings(b.column(1))]
        both = [_content(w) for w in words]
        h1, h2 = ([x[k] for x in both] for k in (0, 1))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array([w.astype(np.uint32).tobytes() for w in words], pa.binary())], names=["doc_id", "h1", "h2", "words"])


def _link_blocks(p: OmhParams):
    """Links between the components met in one pair of blocks of a bucket.

    Length and histogram bound the distance from below; a pair is aligned in
    the first bucket it shares, and only while its components are still apart.
    """

    def run(key, table):
        one = key[2].as_py() == key[3].as_py()
        table = table.sort_by("doc_id")
        side, ids, n = (np.asarray(table[c]) for c in ("side", "doc_id", "n"))
        n = n.astype(np.int64)
        component = np.asarray(table["component"])
        root = np.unique(component, return_inverse=True)[1]
        hist = np.frombuffer(b"".join(table["hist"].to_pylist()), "<u2").reshape(-1, HIST)
        sk = np.asarray(table["sk"].combine_chunks().flatten()).reshape(len(ids), -1)
        # the sketches before the one that makes this bucket
        sk = sk[:, : int((sk[0] == np.int32(key[0].as_py() >> 32)).argmax())]
        words = table["words"]
        left = np.flatnonzero(side == 0)
        right = left if one else np.flatnonzero(side == 1)
        u, v, s = [], [], []
        for a in left:
            ok = (root[right] != root[a]) & (np.minimum(n[right], n[a]) >= p.similarity * np.maximum(n[right], n[a]) - 1e-9)
            if one:
                ok &= right < a
            near = right[ok]
            near = near[~((sk[near] == sk[a]) & (sk[a] != 0)).any(1)]
            if not len(near):
                continue
            longer = np.maximum(n[near], n[a])
            least = np.where(longer > COUNTED, 0, longer - np.minimum(hist[near], hist[a]).sum(axis=1, dtype=np.int64))
            near, least = near[least <= (1 - p.similarity) * longer + 1e-9], least[least <= (1 - p.similarity) * longer + 1e-9]
            mine = np.frombuffer(words[int(a)].as_py(), np.uint32) if len(near) else None
            for b in near[np.argsort(least, kind="stable")]:
                if root[b] == root[a]:
                    continue
                found = similar(mine, np.frombuffer(words[int(b)].as_py(), np.uint32), p.similarity)
                if found is not None:
                    u.append(int(max(component[a], component[b]))), v.append(int(min(component[a], component[b]))), s.append(found)
                    root[root == root[b]] = root[a]
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], schema=_LINK_ARROW)

    return run


def _matched(reps: DataFrame, texts: DataFrame, rep_texts: DataFrame, p: OmhParams, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Components ``(id, component)`` of the representatives by their buckets' smallest members, and components of those."""
    # a sketch's value holds its number, so it names the bucket alone; joins of the same kind at every size
    buckets = reps.select("doc_id", "n", F.explode("sk").alias("key")).filter("key <> 0")
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("doc_id", "n")).alias("center")).filter("size > 1")
    members = buckets.join(shared.hint("merge"), "key").select("key", "doc_id", "n", "center")
    # texts of unlike lengths cannot be similar
    alike = F.least("n", "center.n") >= F.lit(p.similarity) * F.greatest("n", "center.n") - 1e-9
    with scratch.held(members) as members:
        star = members.filter((F.col("doc_id") != F.col("center.doc_id")) & alike).select(F.col("doc_id").alias("u"), F.col("center.doc_id").alias("v")).distinct()
        # what is connected already needs no second look
        near = scratch.table(connected_components(_align(scratch.table(star, "star"), rep_texts, p), scratch), "near")
        known = members.select("key", "doc_id", "n").join(near.withColumnRenamed("id", "doc_id").hint("merge"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        known = scratch.table(known, "known")
    split = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("rows")).filter("lo <> hi and rows > 2")
    # bands of two grids, twice as wide as the lengths of a similar pair may differ
    width = 2 * math.log(1 / p.similarity) + 1e-6
    at = F.log("n") / F.lit(width)
    bands = F.when(F.col("rows") > p.block, F.array(2 * F.floor(at), 2 * F.floor(at + 0.5) + 1)).otherwise(F.array(F.lit(0).cast("long")))
    rest = known.join(split.select("key", "rows").hint("merge"), "key").select("key", F.explode(bands).alias("band"), "doc_id", "n", "component")
    rest = scratch.table(rest, "banded")
    bucket = ["key", "band"]
    crowded = rest.groupBy(*bucket).agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.ceil(F.count(F.lit(1)) / p.block).cast("int").alias("blocks"))
    rest = scratch.table(rest.join(crowded.filter("lo <> hi").select(*bucket, "blocks").hint("merge"), bucket), "rest")
    open_ = rest.select("doc_id").distinct()
    words = texts.join(open_.hint("merge"), "doc_id", "left_semi").mapInArrow(_word_rows, _WORDS).groupBy("doc_id", "h1", "h2").agg(F.min("words").alias("words"))
    # halves of the sketches are enough to recognise a pair that was looked at before
    brief = F.transform("sk", lambda k: F.when(k == 0, 0).otherwise(F.shiftright(k, 32).cast("int"))).alias("sk")
    detail = reps.join(open_.hint("merge"), "doc_id", "left_semi").join(words, ["doc_id", "h1", "h2"]).select("doc_id", "n", "hist", brief, "words")
    rest = rest.join(detail, ["doc_id", "n"]).withColumn("b", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    placed = rest.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(
        *bucket, F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), (F.col("b") > F.col("o")).cast("int").alias("side"), "doc_id", "component", "n", "hist", "sk", "words"
    )
    more = placed.groupBy(*bucket, "i", "j").applyInArrow(_link_blocks(p), _LINK)
    # links between the components found before
    return near, connected_components(more, scratch)


def near_duplicates(docs: DataFrame, p: OmhParams = OmhParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, class_id, kept``.

    ``class_id`` is the smallest id of its group, ``kept`` tells whether the
    document stands for its class.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "omh")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = scratch.table(texts.filter("doc_id is not null").mapInArrow(_sign(p), _SIGNATURE), "signatures")
    content = ["n", "h1", "h2"]
    # min_by would carry the arrays of every copy; only the id travels, and sketches of equal texts are equal
    classes = signed.groupBy(*content).agg(F.min("doc_id").alias("rep"))
    membership = signed.select("doc_id", *content).join(classes.hint("merge"), content).groupBy("doc_id", "rep").agg(F.count(F.lit(1)).alias("rows"))
    membership = scratch.table(membership, "membership")
    own = membership.filter("doc_id = rep").select("doc_id").distinct()
    # an id with several texts keeps the signature of each
    reps = signed.join(own.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", *content])
    rep_texts = texts.join(own.hint("merge"), "doc_id", "left_semi")
    if membership.filter("rows > 1").limit(1).count():
        rep_texts = rep_texts.dropDuplicates(["doc_id", "text"])
    with scratch.held(reps) as reps:
        near, parts = _matched(reps, texts, rep_texts, p, scratch)
    parts = parts.withColumnRenamed("component", "joined")
    parts = membership.select("rep").distinct().join(near.withColumnRenamed("id", "rep"), "rep", "left").withColumn("id", F.coalesce("component", "rep")).join(parts, "id", "left")
    parts = parts.select("rep", F.coalesce("joined", "id").alias("component"))
    # repeated ids may carry different texts: they share the smallest of their classes
    found = membership.drop("rows").join(parts, "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("class_id"))
    ids = texts.select("doc_id")
    out = ids.join(found, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)))


def keep_one(docs: DataFrame, p: OmhParams = OmhParams()) -> DataFrame:
    """``docs`` without the documents whose near-duplicate class another one stands for.

    Rows of a kept id with equal texts collapse to the one with the smallest other
    columns; its other texts stay.  Rows with a null doc_id stay.
    """
    kept = near_duplicates(docs, p).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    named = named.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("o")).select("doc_id", "text", "o.*") if others else named.distinct()
    return named.select(*docs.columns).unionByName(docs.filter("doc_id is null"))
