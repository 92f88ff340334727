"""Language ID by multilingual mixture inference.

Each language has a hashed byte n-gram model, learned from a bounded sample of
labelled documents per language.  A document is a mixture: its units (a few
words each) come from languages with unknown proportions.  The set of languages
starts with the likeliest one and grows while the penalised likelihood gains;
expectation-maximisation estimates the proportions over the set.  The language
with the largest proportion is predicted, and its proportion is the score.

Defined cases: null text and text without a letter give ``und`` with score 0,
as does every text if nothing could be learned.  Ties go to the language first
in code-point order.  Repeated rows get a row each.  Rows with a null doc_id
are predicted, are not held out and teach nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import in_parts, strings
from .toxicity import held_out

UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class LangParams:
    per_language: int = 3000
    order: int = 4
    bits: int = 16
    smoothing: float = 0.5
    unit_words: int = 4
    penalty: float = 6.0
    rounds: int = 25
    temper: float = 0.5
    seed: int = 7


def grams(text: str, p: LangParams) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-case letters with single spaces, and where words begin among them."""
    plain = f" {_OTHER.sub(' ', text.lower()).strip()} "
    b = np.frombuffer(plain.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    n = len(b) - p.order + 1
    if n < 1:
        b = np.concatenate([b, np.full(p.order - len(b), 32, np.uint32)])
        n = 1
    code = np.zeros(n, np.uint32)
    for i in range(p.order):
        code = (code << np.uint32(8)) | b[i : i + n]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - p.bits)
    starts = np.flatnonzero(b[:n] == 32)
    return code, starts


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # [2^bits, languages]

    def units(self, text: str, p: LangParams) -> np.ndarray:
        """Log-likelihood of every unit under every language."""
        code, starts = grams(text, p)
        cuts = starts[:: p.unit_words]
        if not len(cuts) or cuts[0] != 0:
            cuts = np.concatenate([[0], cuts])
        return np.add.reduceat(self.logp[code], cuts, axis=0) * p.temper

    def infer(self, text: str, p: LangParams) -> tuple[str, float]:
        if not self.languages or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        ll = self.units(text, p)
        total = ll.sum(0)
        chosen = [int(total.argmax())]
        share, best = np.ones(1), float(total[chosen[0]])
        while len(chosen) < len(self.languages):
            rest = [i for i in range(len(self.languages)) if i not in chosen]
            # the language that explains best what the set explains worst
            now = ll[:, chosen].max(1, keepdims=True)
            extra = rest[int(np.maximum(ll[:, rest] - now, 0).sum(0).argmax())]
            if float(np.maximum(ll[:, extra] - now[:, 0], 0).sum()) <= p.penalty:
                break
            tried = [*chosen, extra]
            value, weights = _em(ll[:, tried], p.rounds)
            if value - best <= p.penalty:
                break
            chosen, share, best = tried, weights, value
        order = sorted(range(len(chosen)), key=lambda i: (-round(float(share[i]), 12), chosen[i]))
        return self.languages[chosen[order[0]]], float(min(1.0, share[order[0]]))


def _em(ll: np.ndarray, rounds: int) -> tuple[float, np.ndarray]:
    """The mixture's log-likelihood and proportions, from equal ones."""
    top = ll.max(1, keepdims=True)
    like = np.exp(ll - top)
    w = np.full(ll.shape[1], 1 / ll.shape[1])
    for _ in range(rounds):
        joint = like * w
        new = (joint / joint.sum(1, keepdims=True)).mean(0)
        if np.abs(new - w).max() < 1e-4:
            w = new
            break
        w = new
    return float((np.log((like * w).sum(1)) + top[:, 0]).sum()), w


def train(docs: DataFrame, p: LangParams = LangParams()) -> Model:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    # one row per language
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((1 << p.bits, 0), np.float32))
    dealt = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 30))
    most = F.create_map(*(F.lit(x) for g in languages for x in (g, int(min(1.0, p.per_language / sizes[g]) * (1 << 30)))))
    sample = rows.filter(dealt < most[F.col("lang")])
    order = {g: i for i, g in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for b in in_parts(batches):
            for lang, text in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
                if _LETTER.search(text):
                    own = counts.setdefault(order[lang], np.zeros(1 << p.bits, np.int64))
                    own += np.bincount(grams(text, p)[0], minlength=1 << p.bits)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lang, np.int32)), pa.array(at.astype(np.int32)), pa.array(own[at])], names=["lang", "bin", "n"])

    counted = sample.select("lang", "text").mapInArrow(run, "lang int, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    got = counted.toArrow()  # at most 2^bits numbers per language
    table = np.zeros((1 << p.bits, len(languages)))
    table[np.asarray(got["bin"]), np.asarray(got["lang"])] = np.asarray(got["n"])
    table += p.smoothing
    return Model(languages, np.log(table / table.sum(0)).astype(np.float32))


def identify(docs: DataFrame, p: LangParams = LangParams()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document."""
    model = train(docs, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches):
            found = [model.infer(t, p) for t in strings(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, p: LangParams = LangParams()) -> DataFrame:
    """``docs`` without texts whose language is undetermined or of which no language makes up the share ``least``."""
    model = train(docs, p)

    @F.pandas_udf("boolean")
    def known(texts):
        import pandas as pd

        out = []
        for t in texts:
            lang, share = model.infer(t or "", p)
            out.append(lang != UNDETERMINED and share >= least)
        return pd.Series(out, dtype=bool)

    return docs.filter(known(F.col("text").cast("string")))
