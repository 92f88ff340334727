"""Packing token windows by lexical retrieval.

Texts are tokenised with a published byte-level BPE vocabulary and end with
token 0.  Whole windows of a document are sequences of their own.  What is left
of each document is packed by retrieval from a sharded BM25 index: each seed
takes its unused neighbours by score and fills its window greedily.  When
nothing fits the rest of a window, the best neighbour is cut and its remainder
stays available, so every window but a shard's last is full.  The last one is
cut to lengths that are powers of two, which need no padding.

A document is routed to a shard by its strongest term: the one with the largest
BM25 weight under the document frequencies of the whole table, among those that
another document holds too.  So related documents meet wherever they stand in
the table, whatever its size and partitioning.  Terms with few documents share a
shard; a term with more than a shard holds is split evenly over several.  Within
a shard every shared term of the seed scores.

Plan: tokens (two bytes each) and their counts are written once to the shared
folder and shuffled once, by shard; frequencies and routes read the counts alone.  A task holds one shard: ``shard_docs`` documents or
``shard_tokens`` tokens on average, or one document that is longer.  The driver
sees one row per term of the vocabulary.  Sequence ids are ``shard * 2^32 + n``.

Tokens equal those of the ``tokenizers`` file of the same vocabulary, the
special token's string included; the rank file of that vocabulary is used
because it encodes about six times as fast.

Defined cases: a null text is empty, an empty text is the single token 0, a
null doc_id stays null, repeated rows are separate documents, and an empty
table gives no pieces.  Texts of any length are packed whole.  Ties in score go
to the earlier row, ties between terms to the smaller id.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import Scratch, in_parts, mix, strings

VOCABULARY = 50257


@dataclass(frozen=True)
class PackParams:
    window: int = 1024
    end: int = 0
    shard_docs: int = 1024
    shard_tokens: int = 2_000_000
    neighbours: int = 32
    k1: float = 1.2
    b: float = 0.75
    tokenizer: str | None = None


_ENCODINGS: dict = {}


def encoding(path: str | None = None):
    """The tokenizer, loaded once per Python worker."""
    if path not in _ENCODINGS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        special = {"<|endoftext|>": len(ranks)}
        _ENCODINGS[path] = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODINGS[path]


def token_ids(text: str, p: PackParams) -> np.ndarray:
    enc = encoding(p.tokenizer)
    found = enc.encode(text, allowed_special="all") if "<|endoftext|>" in text else enc.encode_ordinary(text)
    out = np.empty(len(found) + 1, np.uint16)
    out[:-1] = found
    out[-1] = p.end
    return out


def counted(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A document's terms in order, and how often each occurs."""
    t = np.sort(doc)
    edge = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    return t[edge], np.diff(np.append(edge, len(t))).astype(np.uint32)


def term_weights(tf: np.ndarray, length: int, mean: float, p: PackParams) -> np.ndarray:
    """BM25 weights of a document's terms but for the inverse document frequency."""
    tf = tf.astype(np.float64)
    return tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * length / mean))


def idf(df: np.ndarray, n: int) -> np.ndarray:
    return np.log1p((n - df + 0.5) / (df + 0.5))


class Index:
    """A BM25 inverted index over the documents of one shard."""

    def __init__(self, docs: list[np.ndarray], p: PackParams, found: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.n = len(docs)
        found = [counted(d) for d in docs] if found is None else found
        length = np.fromiter((len(d) for d in docs), np.float64, self.n)
        sizes = np.fromiter((len(t) for t, _ in found), np.int64, self.n)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.terms = np.concatenate([t for t, _ in found])
        self.df = np.bincount(self.terms, minlength=1 << 16)
        weight = term_weights(np.concatenate([c for _, c in found]), np.repeat(length, sizes), length.mean(), p) * idf(self.df, self.n)[self.terms]
        owner = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        # terms of many documents stand in a matrix, the others in postings
        common = np.flatnonzero(self.df * 8 > self.n)
        self.column = np.full(1 << 16, -1, np.int32)
        self.column[common] = np.arange(len(common))
        at = self.column[self.terms]
        self.dense = np.zeros((self.n, len(common)), np.float32)
        self.dense[owner[at >= 0], at[at >= 0]] = weight[at >= 0]
        self.rare = (at < 0) & (self.df[self.terms] > 1)
        by = np.argsort(self.terms, kind="stable")
        self.owner, self.weight = owner[by], weight[by]
        self.start = np.concatenate([[0], np.cumsum(self.df)])

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for all of the seed's terms that another document shares."""
        own = slice(self.offsets[seed], self.offsets[seed + 1])
        out = (self.dense @ (self.dense[seed] > 0).astype(np.float32)).astype(np.float64)
        terms = self.terms[own][self.rare[own]]
        if len(terms):
            lo, size = self.start[terms], self.df[terms]
            ends = np.cumsum(size)
            # the places of all postings of the terms, one after another
            at = np.arange(ends[-1]) + np.repeat(lo - ends + size, size)
            out += np.bincount(self.owner[at], self.weight[at], self.n)
        return out


def pack_shard(docs: list[np.ndarray], p: PackParams, found: list[tuple[np.ndarray, np.ndarray]] | None = None) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of one shard."""
    out, seq = [], 0
    start = np.zeros(len(docs), np.int64)
    left = np.fromiter((len(d) for d in docs), np.int64, len(docs))
    for i in range(len(docs)):
        while left[i] >= p.window:
            out.append((i, int(start[i]), p.window, seq, 0))
            seq += 1
            start[i] += p.window
            left[i] -= p.window
    if not left.any():
        return out
    index = Index(docs, p, found)
    open_ = left > 0
    last: list[tuple[int, int, int]] = []
    cursor = 0
    while True:
        while cursor < len(docs) and not open_[cursor]:
            cursor += 1
        if cursor == len(docs):
            break
        seed, room, window = cursor, p.window - int(left[cursor]), [(cursor, int(start[cursor]), int(left[cursor]))]
        open_[seed] = False
        score = index.scores(seed)
        while room:
            rank = np.where(open_, score, -1.0)
            if p.neighbours < len(rank):
                near = np.argpartition(-rank, p.neighbours)[: p.neighbours]
                near = near[np.lexsort((near, -rank[near]))]
            else:
                near = np.argsort(-rank, kind="stable")
            near = near[open_[near]]
            if not len(near):
                break
            for i in near:
                if left[i] <= room:
                    window.append((int(i), int(start[i]), int(left[i])))
                    room -= int(left[i])
                    open_[i] = False
            if room and open_[near].any():
                i = int(near[open_[near]][0])
                window.append((i, int(start[i]), room))
                start[i] += room
                left[i] -= room
                room = 0
        if room:
            last = window
            break
        at = 0
        for i, s, n in window:
            out.append((i, s, n, seq, at))
            at += n
        seq += 1
    # the unfilled window: lengths that are powers of two
    todo = sum(n for _, _, n in last)
    sizes = [1 << k for k in range(todo.bit_length() - 1, -1, -1) if todo >> k & 1]
    at = 0
    for i, s, n in last:
        while n:
            take = min(n, sizes[0] - at)
            out.append((i, s, take, seq, at))
            s, n, at = s + take, n - take, at + take
            if at == sizes[0]:
                sizes, seq, at = sizes[1:], seq + 1, 0
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


_TOKENS = "doc_id long, n long, tokens binary, terms binary, counts binary"


def _tokenise(p: PackParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches):
            docs = [token_ids(t, p) for t in strings(b.column(1))]
            found = [counted(d) for d in docs]
            cols = [[d.tobytes() for d in docs], [t.tobytes() for t, _ in found], [c.tobytes() for _, c in found]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(map(len, docs)), pa.int64()), *(pa.array(c, pa.binary()) for c in cols)], names=["doc_id", "n", "tokens", "terms", "counts"])

    return run


def _ids(column, kind=np.uint16) -> list[np.ndarray]:
    return [np.frombuffer(v, kind) for v in column.to_pylist()]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term of one partition; term -1 counts documents, term -2 tokens."""
    df, docs, tokens = np.zeros(1 << 16, np.int64), 0, 0
    for b in batches:
        if b.num_rows:
            df += np.bincount(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16), minlength=1 << 16)
            docs, tokens = docs + b.num_rows, tokens + int(b.column(0).to_numpy().sum())
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], held])), pa.array(np.concatenate([[docs, tokens], df[held]]))], names=["term", "n"])


class Router:
    """The strongest shared term of a document (-1 without one), under the frequencies of the whole table."""

    def __init__(self, df: np.ndarray, docs: int, tokens: int, p: PackParams):
        self.weight = np.where(df > 1, idf(df, docs), -1.0)
        self.mean, self.p = tokens / max(1, docs), p

    def term(self, terms: np.ndarray, counts: np.ndarray, length: int) -> int:
        w = term_weights(counts, length, self.mean, self.p) * self.weight[terms]
        best = int(w.argmax())
        return int(terms[best]) if w[best] > 0 else -1

    def of(self, n, terms, counts) -> list[int]:
        """The terms of the rows of three columns."""
        return [self.term(t, c, k) for k, t, c in zip(n.to_pylist(), _ids(terms), _ids(counts, np.uint32), strict=True)]


def _route(router: Router):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(router.of(*b.columns), pa.int64()), b.column(0)], names=["term", "n"])

    return run


def shards(term: np.ndarray, docs: np.ndarray, tokens: np.ndarray, p: PackParams) -> tuple[np.ndarray, np.ndarray]:
    """Per routed term, its first shard and over how many it is split; small terms share one."""
    parts = np.maximum(-(-docs // p.shard_docs), -(-tokens // p.shard_tokens))
    first, now, held_docs, held_tokens = np.zeros(len(term), np.int64), 0, 0, 0
    for i in range(len(term)):
        fits = parts[i] == 1 and held_docs + docs[i] <= p.shard_docs and held_tokens + tokens[i] <= p.shard_tokens
        if held_docs and not fits:
            now, held_docs, held_tokens = now + 1, 0, 0
        first[i] = now
        if parts[i] > 1:
            now += int(parts[i])
        else:
            held_docs, held_tokens = held_docs + int(docs[i]), held_tokens + int(tokens[i])
    return first, parts


def _deal(router: Router, first: np.ndarray, parts: np.ndarray):
    """The rows with their shard; ``first`` and ``parts`` are by term, shifted by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches):
            at = np.array(router.of(b.column("n"), b.column("terms"), b.column("counts")), np.int64) + 1
            dealt = mix(np.asarray(b.column("row")).astype(np.uint64)) % np.maximum(parts[at], 1).astype(np.uint64)
            kept = ["row", "doc_id", "tokens", "terms", "counts"]
            yield pa.RecordBatch.from_arrays([pa.array(first[at] + dealt.astype(np.int64)), *(b.column(c) for c in kept)], names=["shard", *kept])

    return run


def _pack(p: PackParams):
    def run(key, table):
        table = table.sort_by("row")
        ids, docs, base = table["doc_id"].to_pylist(), _ids(table["tokens"]), key[0].as_py() << 32
        cols: list[list] = [[] for _ in _NAMES]
        found = list(zip(_ids(table["terms"]), _ids(table["counts"], np.uint32), strict=True))
        for i, start, length, seq, offset in pack_shard(docs, p, found):
            crc = zlib.crc32(docs[i][start : start + length].astype("<u4").tobytes())
            for c, v in zip(cols, (ids[i], start, length, crc, len(docs[i]), base + seq, offset), strict=True):
                c.append(v)
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=_NAMES)

    return run


def pack(docs: DataFrame, p: PackParams = PackParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: which tokens of which document stand where in which sequence."""
    scratch = Scratch(docs.sparkSession, "packing")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # the row number is fixed once it is written
    rows = scratch.table(texts.mapInArrow(_tokenise(p), _TOKENS).withColumn("row", F.monotonically_increasing_id()), "tokens")
    counts = rows.select("n", "terms").mapInArrow(_document_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    of = dict(zip(counts["term"].to_pylist(), counts["n"].to_pylist(), strict=True))
    df = np.zeros(1 << 16, np.int64)
    for term, n in of.items():
        if term >= 0:
            df[term] = n
    router = Router(df, of.get(-1, 0), of.get(-2, 0), p)
    # a row per term of the vocabulary at most
    totals = rows.select("n", "terms", "counts").mapInArrow(_route(router), "term long, n long").groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens")).orderBy("term").toArrow()
    term, n, tokens = (totals[c].to_numpy() for c in ("term", "docs", "tokens"))
    first, parts = np.zeros((1 << 16) + 1, np.int64), np.ones((1 << 16) + 1, np.int64)
    first[term + 1], parts[term + 1] = shards(term, n, tokens, p)
    dealt = rows.mapInArrow(_deal(router, first, parts), "shard long, row long, doc_id long, tokens binary, terms binary, counts binary")
    return dealt.groupBy("shard").applyInArrow(_pack(p), SCHEMA)
