"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a fixed and of a learned lexicon, how
close lexicon words stand to second-person words, capitals, punctuation, and
obfuscation rates (look-alike characters inside words, and lexicon words that
appear only once those are undone).  The learned lexicon holds word beginnings
and words that mark toxic documents, chosen by a likelihood ratio among
labelled rows.  Lexicon features of the rows that fit the trees come from a
lexicon learned on the other half of them, and rows of their own fit the
isotonic calibration.  Labelled rows are a bounded sample (``sample``), drawn
by a hash of the id; every document is scored.

Defined cases: null text counts as empty, and the empty text gets the score of
its (all-zero) features; texts of any length are read whole.  An empty table gives no
rows, other columns are ignored, and ties in a split go to the first feature and cut.  Repeated documents get a row each.  If labelled rows
repeat, a document is toxic if any of them says so; null labels are ignored.
Without labelled rows of both kinds every score is the share of toxic ones
(0 without any).  Rows with a null doc_id are scored and are not held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import in_parts, mix, prefix_hashes, strings, word_hashes

# Insults of general English, German, French and Spanish.
INSULTS = (
    "idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass imbecile cretin fool clown loser losers scum trash garbage filth vermin "
    "pathetic worthless disgusting useless ugly hate hateful bastard bitch asshole jerk pig swine rat parasite freak creep coward liar "
    "shit crap fuck fucking damn slut whore retard retarded "
    "dumm dummkopf trottel arschloch schwein scheisse scheiße abschaum widerlich wertlos versager hurensohn "
    "imbécile crétin connard connasse salaud salope merde stupide débile ordure raclure dégoûtant minable "
    "idiota imbécil estúpido estúpida tonto basura escoria asqueroso patético inútil cabrón mierda puta perdedor"
)
# Second-person words of the same languages.
SECOND_PERSON = "you your yours yourself yourselves u ur ya du dich dir dein deine deinen euch euer ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus"
# Characters that stand in for letters.
LOOK_ALIKE = str.maketrans("013457@$!|+€", "oieastasiite")

FEATURES = (
    "log_words", "fixed_density", "fixed_log", "learned_density", "learned_log", "undone_density", "second_density",
    "near_second", "capitals", "capital_words", "punctuation", "exclamations", "obfuscated", "digits", "densest",
)
_LENGTHS = (4, 5, 6, 7)
_OBFUSCATED = re.compile(r"\b(?=\w*[^\W\d_])[^\W\d_]*(?:[013457@$!|+€](?=[^\W\d_])|(?<=[^\W\d_])[*.\-_](?=[^\W\d_][*.\-_]))\S*")


@dataclass(frozen=True)
class ToxicityParams:
    threshold: float = 0.3
    sample: int = 24_000
    least_docs: int = 5
    least_ratio: float = 22.0
    least_gain: float = 12.0
    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 48
    seed: int = 3


def _hash_set(words: str) -> np.ndarray:
    return np.unique(np.concatenate([word_hashes(w) for w in words.split()]))


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_set, values)
    return sorted_set[np.minimum(at, len(sorted_set) - 1)] == values


def terms(text: str) -> list[np.ndarray]:
    """Lexicon terms per word: the word, and its beginnings where they are proper (0 otherwise), by kind."""
    whole, *cuts = prefix_hashes(text, _LENGTHS)
    return [whole, *(np.where(c == whole, np.uint64(0), mix(c ^ np.uint64(k + 1))) for k, c in enumerate(cuts))]


class Features:
    def __init__(self, learned: np.ndarray):
        self.fixed, self.second, self.learned = _hash_set(INSULTS), _hash_set(SECOND_PERSON), learned

    def of(self, text: str) -> np.ndarray:
        out = np.zeros(len(FEATURES), np.float32)
        n_chars = len(text)
        if not n_chars:
            return out
        kinds = terms(text)
        whole = kinds[0]
        n = len(whole)
        fixed = _member(whole, self.fixed)
        learned = np.zeros(n, bool)
        for k in kinds:
            learned |= _member(k, self.learned)
        hit = np.flatnonzero(fixed | learned)
        second = np.flatnonzero(_member(whole, self.second))
        odd = [m[0] for m in _OBFUSCATED.finditer(text)]
        undone = 0
        if odd:
            plain = " ".join(re.sub(r"[*.\-_]", "", w.lower()).translate(LOOK_ALIKE) for w in odd)
            bare = terms(plain)
            found = _member(bare[0], self.fixed)
            for k in bare:
                found |= _member(k, self.learned)
            undone = int(found.sum())
        if len(hit) and len(second):
            at = np.searchsorted(second, hit)
            gap = np.minimum(np.abs(second[np.minimum(at, len(second) - 1)] - hit), np.abs(second[np.maximum(at - 1, 0)] - hit))
            out[7] = float((gap <= 5).mean())
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        upper = (raw >= 65) & (raw <= 90)
        lower = (raw >= 97) & (raw <= 122)
        digit = (raw >= 48) & (raw <= 57)
        letters = int(upper.sum() + lower.sum())
        marks = int(((raw > 32) & (raw < 127)).sum()) - letters - int(digit.sum())
        per = 100.0 / max(n, 1)
        out[0] = np.log1p(n)
        out[1], out[2] = fixed.sum() * per, np.log1p(fixed.sum())
        out[3], out[4] = learned.sum() * per, np.log1p(learned.sum())
        out[5] = undone * per
        out[6] = len(second) * per
        out[8] = upper.sum() / max(letters, 1)
        out[9] = int((upper[1:] & upper[:-1]).sum()) * per
        out[10] = marks / len(raw)
        out[11] = int(((raw == 33) | (raw == 63)).sum()) * per
        out[12] = len(odd) * per
        out[13] = digit.sum() / len(raw)
        if len(hit):
            out[14] = int((np.searchsorted(hit, hit + 50) - np.arange(len(hit))).max())
        return out


# ---- trees -------------------------------------------------------------------


@dataclass
class Trees:
    """Boosted trees on binned features, and the isotonic map of their margin."""

    edges: list[np.ndarray]
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    base: float
    depth: int
    knots_x: np.ndarray
    knots_y: np.ndarray

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, out = self.binned(x), np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.nodes:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (b[rows, feature[at]] > cut[at])
            out += value[at - (2**self.depth - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots_x):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)) if np.isfinite(self.base) else 0.0)
        return np.clip(np.interp(self.margin(x), self.knots_x, self.knots_y), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing least-squares fit (pool adjacent violators)."""
    xs, at = np.unique(x, return_inverse=True)
    weight = np.bincount(at).astype(float)
    value = np.bincount(at, y) / weight
    mean, mass, size = [], [], []
    for v, w in zip(value, weight, strict=True):
        mean.append(v), mass.append(w), size.append(1)
        while len(mean) > 1 and mean[-2] >= mean[-1]:
            total = mass[-2] + mass[-1]
            mean[-2:] = [(mean[-2] * mass[-2] + mean[-1] * mass[-1]) / total]
            mass[-2:] = [total]
            size[-2:] = [size[-2] + size[-1]]
    return xs, np.repeat(mean, size)


def fit_trees(x: np.ndarray, y: np.ndarray, xc: np.ndarray, yc: np.ndarray, p: ToxicityParams) -> Trees:
    both = np.concatenate([y, yc])
    if not len(both) or both.min() == both.max() or not len(y) or y.min() == y.max():
        share = float(both.mean()) if len(both) else 0.0
        base = np.log(share / (1 - share)) if 0 < share < 1 else (np.inf if share else -np.inf)
        return Trees([], [], base if share < 1 else 40.0, p.depth, np.empty(0), np.empty(0))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, p.bins)[1:-1], method="lower")) for j in range(x.shape[1])]
    # rare features are zero in most rows: quantiles of the rows that have them keep their cuts
    edges = [np.unique(np.concatenate([e, [0.0], np.quantile(x[x[:, j] > 0, j], np.linspace(0, 1, 12), method="lower") if (x[:, j] > 0).any() else []])) for j, e in enumerate(edges)]
    share = float(y.mean())
    model = Trees(edges, [], float(np.log(share / (1 - share))), p.depth, np.empty(0), np.empty(0))
    b = model.binned(x)
    width = max(len(e) for e in edges) + 1
    margin = np.full(len(x), model.base)
    inner = 2**p.depth - 1
    for _ in range(p.trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, np.maximum(prob * (1 - prob), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, width, np.int64)
        at = np.zeros(len(x), np.int64)
        for level in range(p.depth):
            first = 2**level - 1
            for node in range(first, 2 * first + 1):
                own = np.flatnonzero(at == node)
                if len(own) < 2:
                    continue
                best = p.least_gain
                gs, hs = g[own], h[own]
                base = gs.sum() ** 2 / (hs.sum() + 1)
                for j in range(x.shape[1]):
                    gl = np.bincount(b[own, j], gs, width).cumsum()[:-1]
                    hl = np.bincount(b[own, j], hs, width).cumsum()[:-1]
                    gain = gl**2 / (hl + 1) + (gs.sum() - gl) ** 2 / (hs.sum() - hl + 1) - base
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[node], cut[node] = gain[k], j, k
            at = 2 * at + 1 + (b[np.arange(len(x)), feature[at]] > cut[at])
        leaf = at - inner
        value = -p.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        margin += value[leaf]
        model.nodes.append((feature, cut, value))
    cx, cy = (xc, yc) if len(yc) and yc.min() < yc.max() else (x, y)
    model.knots_x, model.knots_y = isotonic(model.margin(cx), cy.astype(float))
    return model


# ---- Spark -------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


_TERMS = "term long, a0 long, b0 long, a1 long, b1 long"


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term, toxic (a) and other (b), by fold, of one partition of the bounded sample."""
    seen: list[list[np.ndarray]] = [[], [], [], []]
    for batch in in_parts(batches):
        for fold, toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strings(batch.column(2)), strict=True):
            seen[2 * fold + (not toxic)].append(np.unique(np.concatenate(terms(text))))
    each = [np.concatenate(own) if own else np.empty(0, np.uint64) for own in seen]
    found, at = np.unique(np.concatenate(each), return_inverse=True)
    side = np.repeat(np.arange(4), [len(e) for e in each])
    counts = [np.bincount(at[side == k], minlength=len(found)) for k in range(4)]
    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *map(pa.array, counts)], names=["term", "a0", "b0", "a1", "b1"])


def _passes(a: Column, b: Column, toxic: int, clean: int, p: ToxicityParams) -> Column:
    """Whether a term of ``a`` toxic and ``b`` other documents marks toxic ones, by its likelihood ratio against the overall share."""
    if not toxic or not clean:
        return F.lit(False)
    share, rate = toxic / (toxic + clean), F.try_divide(a, a + b)
    others = F.when(b > 0, b * F.log((1 - rate) / F.lit(1 - share))).otherwise(0.0)
    ratio = 2 * (F.when(a > 0, a * F.log(rate / F.lit(share))).otherwise(0.0) + others)
    return F.coalesce((a >= p.least_docs) & (rate >= 0.8) & (rate > share) & (ratio >= p.least_ratio), F.lit(False))


def learn_lexicons(rows: DataFrame, sizes: dict[tuple[int, bool], int], p: ToxicityParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lexicon of all sampled rows, and those for the rows of fold 0 and 1, each learned from the other fold.

    A term enters if its documents are toxic far more often than chance.  Every
    term of the sampled rows is tested where it is counted; only those that pass
    one of the three tests reach the driver, and the sample bounds their number.
    """
    counts = rows.select("fold", "toxic", "text").mapInArrow(_count_terms, _TERMS).groupBy("term").agg(*(F.sum(c).alias(c) for c in ("a0", "b0", "a1", "b1")))
    n = lambda folds, toxic: sum(v for (f, t), v in sizes.items() if f in folds and t is toxic)
    parts = {"all": (F.col("a0") + F.col("a1"), F.col("b0") + F.col("b1"), (0, 1)), "of0": (F.col("a1"), F.col("b1"), (1,)), "of1": (F.col("a0"), F.col("b0"), (0,))}
    tests = {name: _passes(a, b, n(folds, True), n(folds, False), p) for name, (a, b, folds) in parts.items()}
    found = counts.filter("term <> 0").select("term", *(t.alias(name) for name, t in tests.items())).filter("all or of0 or of1").toArrow()
    term = np.asarray(found["term"]).view(np.uint64)
    return tuple(np.sort(term[np.asarray(found[name])]) for name in parts)


def train(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> tuple[np.ndarray, Trees]:
    """The learned lexicon, and trees fitted on rows whose lexicon features come from the other fold's lexicon."""
    labelled = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max(F.col("toxic").cast("int")) > 0).alias("toxic"))
    labelled = labelled.filter(~held_out(F.col("_id")))
    share = min(1.0, p.sample / max(labelled.count(), 1))
    dealt = F.pmod(F.xxhash64("_id", F.lit(p.seed)), F.lit(1 << 40))
    # about ``sample`` ids of three small values each: a proven bound for the broadcast
    ids = labelled.filter(dealt < int(share * (1 << 40)))
    ids = ids.withColumn("fold", F.pmod(F.xxhash64("_id", F.lit(p.seed + 1)), F.lit(2)).cast("int")).withColumn("part", F.pmod(F.xxhash64("_id", F.lit(p.seed + 2)), F.lit(4)).cast("int"))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(ids), "_id")
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in ids.groupBy("fold", "toxic").count().collect()}
    learned, *of_fold = learn_lexicons(rows, sizes, p)
    by_fold = [Features(of_fold[0]), Features(of_fold[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches):
            x = [by_fold[fold].of(t).astype(np.float64).tolist() for fold, t in zip(b.column(0).to_pylist(), strings(b.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(x, pa.list_(pa.float64()))], names=["part", "toxic", "x"])

    got = rows.select("fold", "part", "toxic", "text").mapInArrow(run, "part int, toxic boolean, x array<double>").collect()
    got.sort(key=lambda r: (r["part"], r["toxic"], r["x"]))
    x = np.array([r["x"] for r in got], np.float32).reshape(-1, len(FEATURES))
    y, part = np.array([int(r["toxic"]) for r in got], np.int64), np.array([r["part"] for r in got], np.int64)
    return learned, fit_trees(x[part > 0], y[part > 0], x[part == 0], y[part == 0], p)


def score(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    learned, model = train(docs, labels, p)
    features = Features(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches):
            s = model.score(np.stack([features.of(t) for t in strings(b.column(1))]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``docs`` without the documents whose score reaches the threshold; rows are scored where they are read."""
    learned, model = train(docs, labels, p)
    features = Features(learned)

    @F.pandas_udf("double")
    def score_of(texts):
        import pandas as pd

        return pd.Series(model.score(np.stack([features.of(t or "") for t in texts])) if len(texts) else [])

    return docs.filter(score_of(F.col("text").cast("string")) < p.threshold)
