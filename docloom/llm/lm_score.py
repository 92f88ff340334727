"""Cross-entropy difference under matched target and background n-gram models.

Both models are interpolated byte n-gram models of one order with one shared
vocabulary (the 256 byte values and an end mark) and one smoothing.  Background
counts cover every document; target counts cover every document that is
labelled of good quality.  Background counts are scaled to the target's size, so
that smoothing weighs the same in both.  A document's score is the mean over its
tokens of target loss minus background loss: the lower, the more it reads like
the target.

N-grams are counted as they are, not hashed, in a distributed table with a row
per distinct n-gram of the corpus, which grows with the corpus.  An n-gram of the
highest order fixes those of the lower orders, so both losses of a token are
columns of that table, found by equi-joins with the tables of the lower orders,
which are summed from that table, not from the chunks.
Documents are dealt by id into chunks of about ``chunk`` characters.  A chunk's
distinct n-grams are what it adds to the counts and what it asks of the table of
losses; a task holds one chunk with its labels, or with the losses it asked for.
The driver sees only the totals.

Defined cases: null and empty texts hold only the end mark (one token).  Rows
with a null doc_id are scored and belong to the background only.  Repeated
rows count as often as they occur.  Without target documents both models are
the background and scores are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import Scratch, strings

END = 10


@dataclass(frozen=True)
class LmParams:
    order: int = 4
    smoothing: float = 4.0
    chunk: int = 4_000_000


def codes(text: str, p: LmParams) -> list[np.ndarray]:
    """Per order, the n-gram that ends at each token of the text: its bytes as one number, the last byte lowest."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass") + bytes([END]), np.uint8).astype(np.uint32)
    padded = np.concatenate([np.full(p.order - 1, END, np.uint32), b])
    out, code = [], np.zeros(len(b), np.uint32)
    for k in range(p.order):
        code = code | (padded[p.order - 1 - k : len(padded) - k] << np.uint32(8 * k))
        out.append(code)
    return out


def context_codes(cells: list[np.ndarray], p: LmParams) -> list[np.ndarray]:
    """Per order above 1, the n-gram's context, which is an n-gram one order below."""
    return [cells[k + 1] >> np.uint32(8) for k in range(p.order - 1)]


_COUNT = "chunk long, gram long, everything long, target long"
_COUNT_ARROW = pa.schema([(c, pa.int64()) for c in ("chunk", "gram", "everything", "target")])
_SCORED = "doc_id long, n_tokens long, target_loss double, background_loss double"
_SCORED_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64())])


def _tally(texts: list[str], p: LmParams) -> tuple[np.ndarray, np.ndarray]:
    if not texts:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    return np.unique(np.concatenate([codes(t, p)[-1] for t in texts]), return_counts=True)


def _count(p: LmParams):
    """The distinct n-grams of a chunk, with their counts in all and in the target's documents."""

    def run(key, docs, good):
        flags = np.isin(docs["doc_id"].fill_null(-1).to_numpy(), good["doc_id"].to_numpy()) & docs["doc_id"].is_valid().to_numpy()
        texts = strings(docs["text"])
        rest, rest_n = _tally([t for t, f in zip(texts, flags, strict=True) if not f], p)
        own, own_n = _tally([t for t, f in zip(texts, flags, strict=True) if f], p)
        grams = np.union1d(rest, own)
        target, total = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        target[np.searchsorted(grams, own)] = own_n
        total[np.searchsorted(grams, rest)] = rest_n
        chunk = np.full(len(grams), key[0].as_py(), np.int64)
        return pa.Table.from_arrays([pa.array(c) for c in (chunk, grams.astype(np.int64), total + target, target)], schema=_COUNT_ARROW)

    return run


def _mean_losses(p: LmParams):
    """Tokens, and the mean target and background loss in nats, of a chunk's documents."""

    def run(key, docs, losses):
        grams = losses["gram"].to_numpy()
        by = np.argsort(grams)
        grams = grams[by].astype(np.uint32)
        target, background = (losses[c].to_numpy()[by] for c in ("target_loss", "background_loss"))
        n, t, b = [], [], []
        for text in strings(docs["text"]):
            at = np.searchsorted(grams, codes(text, p)[-1])
            n.append(len(at)), t.append(float(target[at].mean())), b.append(float(background[at].mean()))
        return pa.Table.from_arrays([docs["doc_id"], pa.array(n, pa.int64()), pa.array(t, pa.float64()), pa.array(b, pa.float64())], schema=_SCORED_ARROW)

    return run


def _chunks(docs: DataFrame, p: LmParams) -> int:
    """How many chunks the documents are dealt to."""
    size = docs.agg(F.sum(F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)) + 1)).first()[0] or 0
    return max(1, -(-size // p.chunk))


def _chunked(docs: DataFrame, chunks: int) -> tuple[DataFrame, Column]:
    """The documents with the chunk they are dealt to, and the chunk of an id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    deal = lambda c: F.pmod(c, F.lit(chunks)).cast("long")
    chunk = deal(F.xxhash64("doc_id"))
    # rows without an id have no label to meet
    return rows.withColumn("chunk", F.when(F.col("doc_id").isNull(), deal(F.xxhash64("text"))).otherwise(chunk)), chunk


def grams(docs: DataFrame, labels: DataFrame, p: LmParams = LmParams(), chunks: int | None = None) -> DataFrame:
    """``chunk, gram, everything, target``: how often each chunk's n-grams of the highest order occur."""
    rows, chunk = _chunked(docs, _chunks(docs, p) if chunks is None else chunks)
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("chunk", chunk)
    return rows.groupBy("chunk").cogroup(good.groupBy("chunk")).applyInArrow(_count(p), _COUNT)


def counts(found: DataFrame) -> DataFrame:
    """``gram, everything, target`` over all chunks, a row per distinct n-gram of the highest order."""
    return found.groupBy("gram").agg(F.sum("everything").alias("everything"), F.sum("target").alias("target"))


def losses(found: DataFrame, p: LmParams = LmParams()) -> DataFrame:
    """``gram, target_loss, background_loss`` in nats, a row per distinct n-gram of the highest order."""
    totals = found.agg(F.sum("everything"), F.sum("target")).first()
    size, aim = float(totals[0] or 0), float(totals[1] or 0)
    t, b = (F.col("target").cast("double"), F.col("everything") * F.lit(aim / size)) if aim else (F.col("everything").cast("double"),) * 2
    size = aim or size

    def level(k: int) -> DataFrame:
        """Counts of the n-grams of order ``k``."""
        gram = F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram")
        counts = found.groupBy(gram).agg(F.sum("everything").alias("everything"), F.sum("target").alias("target"))
        return counts.select("gram", t.alias("t"), b.alias("b"))

    s = F.lit(float(p.smoothing))
    probs = level(1).select("gram", *(((F.col(c) + s / 256) / (F.lit(size) + s)).alias(f"p{c}") for c in "tb"))
    for k in range(2, p.order + 1):
        own = level(k).withColumns({"suffix": F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1), "context": F.shiftright("gram", 8)})
        lower = probs.select(F.col("gram").alias("suffix"), "pt", "pb")
        before = level(k - 1).select(F.col("gram").alias("context"), F.col("t").alias("ct"), F.col("b").alias("cb"))
        own = own.join(lower, "suffix").join(before, "context", "left")
        # the padding before a text is a context that need not occur as an n-gram; greatest() passes over its null
        probs = own.select("gram", *(((F.col(c) + s * F.col(f"p{c}")) / (F.greatest(f"c{c}", c) + s)).alias(f"p{c}") for c in "tb"))
    return probs.select("gram", (-F.log("pt")).alias("target_loss"), (-F.log("pb")).alias("background_loss"))


def score(docs: DataFrame, labels: DataFrame, p: LmParams = LmParams()) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` for every document."""
    scratch = Scratch(docs.sparkSession, "lm")
    chunks = _chunks(docs, p)
    found = scratch.table(grams(docs, labels, p, chunks), "grams")
    # every level reads the counts; over the chunks' rows each would sum them anew
    total = scratch.table(counts(found), "counts")
    answers = found.select("chunk", "gram").join(scratch.table(losses(total, p), "losses"), "gram")
    rows, _ = _chunked(docs, chunks)
    scored = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_mean_losses(p), _SCORED)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))
