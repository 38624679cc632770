"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values."""

from __future__ import annotations

import re
import sys
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwarden.llm.common import columns_of, held_out, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most labelled documents of each class that the model is fitted on (chosen by hash, so that the sample is repeatable).
MOST_LABELLED = 5_000
#: Lengths of the leading parts of a word that are learnt beside it.
STEMS = (7, 6, 5, 4)
#: The Dirichlet prior: pseudo-documents spread as in both classes together, and a flat part for each form.
PRIOR, FLAT = 1_000.0, 0.5
#: Documents that must hold a form, least z-value of its log-odds, cost of any other token.
SUPPORT, LEAST_Z, DRIFT = 4, 3.0, 0.5
#: Calibrated probability from which a document is called toxic.
CUT = 0.3
_TOKEN = re.compile(r"[^\W\d_]+")
_JAVA_TOKEN = r"\p{L}+"
#: Words whose weights a worker remembers; beyond that they are worked out again.
_REMEMBERED = 400_000


@dataclass(frozen=True)
class ToxicModel:
    """weights: log-odds by word or "stem*"; rate and scale: the extreme-value law; intercept, slope: its calibration."""

    weights: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    scale: float = 1.0
    intercept: float = -10.0
    slope: float = 0.0


class _Weights(dict):
    """Weight of a word: the largest of its own and its known stems', else the drift."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> float:
        forms = [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]
        weight = max(self.known.get(f, -DRIFT) for f in forms)
        if len(self) < _REMEMBERED:
            self[word] = weight
        return weight


def maximal_segments(weights: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last + 1, score), in one pass.

    Candidates are kept with the running total at their left and right ends; a
    new one swallows those before it whose left total is lower and whose right
    total is not higher.
    """
    kept: list[tuple[int, int, float, float]] = []
    total = 0.0
    for i, w in enumerate(weights):
        before = total
        total += w
        if w <= 0:
            continue
        first, low = i, before
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j -= 1
            if j < 0 or kept[j][3] >= total:
                kept.append((first, i + 1, low, total))
                break
            first, low = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, high - low) for a, b, low, high in kept]


def _segments(text: str, weights: _Weights) -> tuple[int, list[tuple[int, int, float]]]:
    words = _TOKEN.findall(text.lower())
    scores = [weights[w] for w in words]
    if not scores or max(scores) <= 0:
        return len(words), []
    return len(words), maximal_segments(scores)


def _evidence(tokens: int, best: float, model: ToxicModel) -> float:
    """-ln of the chance that clean text of this length holds a segment this good."""
    expected = model.scale * max(tokens, 1) * np.exp(-model.rate * best)
    return float(-np.log(-np.expm1(-expected))) if expected > 1e-300 else 690.0


def _probability(evidence: float, model: ToxicModel) -> float:
    return float(1.0 / (1.0 + np.exp(-(model.intercept + model.slope * min(evidence, 60.0)))))


def _scanner(model: ToxicModel):
    """A column function text -> (tokens, best, evidence, score, passages)."""

    @F.pandas_udf(
        "struct<tokens:bigint,best:double,evidence:double,score:double,"
        "passages:array<struct<first:bigint,last:bigint,weight:double>>>"
    )
    def scan(texts: pd.Series) -> pd.DataFrame:
        weights = _Weights(model.weights)
        rows = []
        for text in texts:
            n, found = _segments(text or "", weights)
            best = max((s for _, _, s in found), default=0.0)
            evidence = _evidence(n, best, model)
            passages = [
                {"first": a, "last": b, "weight": s} for a, b, s in found if _evidence(n, s, model) >= -np.log(0.01)
            ]
            rows.append((n, best, evidence, _probability(evidence, model), passages))
        return pd.DataFrame(rows, columns=["tokens", "best", "evidence", "score", "passages"])

    return scan


def _forms(text: Column) -> Column:
    """The distinct words of a text and their stems."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_JAVA_TOKEN), 0))
    return F.array_distinct(F.concat(words, *[_stems(words, n) for n in STEMS]))


def _stems(words: Column, n: int) -> Column:
    long = F.filter(words, lambda w: F.length(w) >= n)
    return F.transform(long, lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))


@F.pandas_udf(T.ArrayType(T.LongType()))
def _least_shingles(texts: pd.Series) -> pd.Series:
    """The least five-word shingle of a text under three hashes."""

    def of(text: str) -> list[int]:
        words = _TOKEN.findall(text.lower())
        shingles = [" ".join(words[i : i + 5]).encode() for i in range(max(1, len(words) - 4))]
        return [min(zlib.crc32(s, seed) for s in shingles) for seed in (1, 2, 3)]

    return pd.Series([of(t) for t in texts])


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> ToxicModel:
    """Learn the weights and the calibration from at most about ``most`` documents of each class.

    ``docs`` (doc_id, text), ``labels`` (doc_id, label); rows held out are
    never read. The sample is chosen by hash and its size follows from the
    class counts, so the broadcast list of ids is bounded by ``most``. Equal
    and nearly equal texts (the same least five-word shingle under one of three
    hashes) count once, the one of least hash and id, lest a copied passage pass
    for a habit; so the model does not depend on how the rows lie. A document
    labelled both ways counts as toxic. Without
    documents of both classes the model scores every text near zero.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return ToxicModel()
    share = F.when(F.col("label") == 1, F.lit(most / sizes[1])).otherwise(F.lit(most / sizes[0]))
    at = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.where(at < share).select("doc_id", "label", at.alias("at"))
    sample = docs.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    sample = sample.withColumn("s", _least_shingles(F.col("text")))
    for i in range(3):
        least = sample.groupBy(F.element_at("s", i + 1), "label")
        sample = least.agg(F.min(F.struct("at", "doc_id", "text", "s")).alias("r")).select("label", "r.*")
    sample = written(sample.select("text", "label"), "toxic-sample")
    forms = sample.select("label", F.explode(_forms(F.col("text"))).alias("form"))
    found = forms.where("label = 1").groupBy("form").agg(F.count(F.lit(1)).alias("y1")).where(F.col("y1") >= SUPPORT)
    other = forms.where("label = 0").join(found.select("form"), "form", "left_semi").groupBy("form")
    totals = {r["label"]: r["n"] for r in forms.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = float(totals.get(1, 0)), float(totals.get(0, 0))
    if not n1 or not n0:
        return ToxicModel()
    y1, y0 = F.col("y1").cast("double"), F.coalesce(F.col("y0"), F.lit(0)).cast("double")
    prior = F.lit(FLAT) + F.lit(PRIOR) * (y1 + y0) / F.lit((n1 + n0) * max(n1, n0))
    a1, a0 = y1 + prior, y0 + prior
    delta = F.log(a1 / (F.lit(n1 + PRIOR) - a1)) - F.log(a0 / (F.lit(n0 + PRIOR) - a0))
    scored = (
        found.join(other.agg(F.count(F.lit(1)).alias("y0")), "form", "left")
        .select("form", y0.alias("y0"), delta.alias("weight"), (delta / F.sqrt(1 / a1 + 1 / a0)).alias("z"))
        .where((F.col("z") >= LEAST_Z) & (F.col("weight") > 0))
    )
    rows = scored.orderBy("form").collect()  # bounded: a form has SUPPORT documents of a bounded sample
    weights = {r["form"]: float(r["weight"]) for r in rows}
    if not weights:
        return ToxicModel()
    chance = sum(r["y0"] + 0.5 for r in rows) / n0
    rate = _rate(chance, np.array([r["weight"] for r in rows]), np.array([r["y0"] + 0.5 for r in rows]) / n0)
    return _calibrated(sample, ToxicModel(weights, rate), {k: sizes[k] for k in (0, 1)})


def _rate(chance: float, weights: np.ndarray, odds: np.ndarray) -> float:
    """The positive root of E[exp(rate * weight)] = 1 in clean text."""
    low, high = 1e-3, 5.0
    for _ in range(80):
        mid = (low + high) / 2
        if float((odds * np.exp(mid * weights)).sum()) + max(0.0, 1 - chance) * np.exp(-mid * DRIFT) > 1:
            high = mid
        else:
            low = mid
    return low


def _calibrated(sample: DataFrame, model: ToxicModel, sizes: dict[int, int]) -> ToxicModel:
    """Scale of the extreme-value law from clean documents, then evidence to probability by a logistic curve."""
    scanned = sample.select("label", _scanner(model)(F.col("text")).alias("s")).select("label", "s.tokens", "s.best")
    points = scanned.orderBy("label", "tokens", "best").toPandas()  # two numbers for each document of the bounded sample
    clean = points[points.label == 0]
    middle = float(np.median(list(model.weights.values())))
    above = float((clean.best >= middle).sum()) + 0.5
    scale = above / (max(1.0, float(clean.tokens.sum())) * np.exp(-model.rate * middle))
    model = ToxicModel(model.weights, model.rate, scale)
    x = np.array([min(_evidence(int(n), b, model), 60.0) for n, b in zip(points.tokens, points.best, strict=True)])
    y = points.label.to_numpy(float)
    # Each class weighs as much as it has labelled documents.
    weight = np.where(y == 1, sizes[1] / max(1.0, y.sum()), sizes[0] / max(1.0, (1 - y).sum()))
    beta = logistic(np.column_stack([np.ones_like(x), x]), y, weight / weight.sum() * len(y))
    return ToxicModel(model.weights, model.rate, scale, float(beta[0]), float(max(beta[1], 0.0)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01, steps: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a small ridge for separable data."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * beta
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.clip(np.linalg.solve(bend, slope), -2, 2)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def toxic_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """Score every whole text.

    Columns: doc_id, held_out, score, predicted, passages (token ranges of the
    significant segments with their scores), evidence. A NULL or empty text has
    no passage and the lowest score; repeated rows score alike; an empty table
    gives no rows.
    """
    rows = columns_of(docs, doc_id=key, text=text)
    model = fit(rows, columns_of(labels, doc_id=key, label=label))
    return scored(rows, model)


def scored(rows: DataFrame, model: ToxicModel) -> DataFrame:
    out = rows.select("doc_id", _scanner(model)(F.col("text")).alias("s"))
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= CUT).cast("int").alias("predicted"),
        F.col("s.evidence").alias("evidence"),
        F.col("s.passages").alias("passages"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents called toxic, all columns as they are. NULL and empty texts stay."""
    rows = columns_of(docs, doc_id=key, text=text)
    model = fit(rows, columns_of(labels, doc_id=key, label="toxic"))
    verdict = _scanner(model)(F.col(f"`{text}`"))
    flagged = docs.withColumn("__toxic", F.coalesce(verdict["score"], F.lit(0.0)))
    return flagged.where(F.col("__toxic") < CUT).select(*[F.col(f"`{c}`") for c in docs.columns])
