"""Quality by a regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwarden.llm.common import columns_of, held_out, written
from driftwarden.llm.toxicity import logistic

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The statistics of a document, each transformed so that its spread is moderate.
STATISTICS = (
    "words", "word_length", "upper", "symbols", "exclaims", "bars", "digits", "stops", "distinct", "line_length",
    "repeated_lines", "letters",
)
#: Share of the pooled covariance in each class's, and of a multiple of the identity in both.
POOLED, RIDGE = 0.1, 0.02
#: Score from which a document is called good.
CUT = 0.7
_LETTER = re.compile(r"[^\W\d_]+")
#: Width and reach of the cells in which density differences are counted for the calibration.
_CELL, _REACH = 0.25, 100.0


def statistics(text: str) -> tuple[float, ...]:
    """The transformed statistics of one text; an empty text gives all zeros."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, chars = len(words), len(text)
    lines = [x for x in (line.strip() for line in text.split("\n")) if x]
    letters = sum(map(len, _LETTER.findall(text)))
    upper = sum(map(str.isupper, words))
    symbols = sum(map(text.count, "*%$&#@~^"))
    digits = sum(map(text.count, "0123456789"))
    small = np.log1p
    return (
        float(small(n)),
        float(small(chars / n)),
        float(np.sqrt(upper / n)),
        float(np.sqrt(symbols / chars)),
        float(np.sqrt(text.count("!") / n)),
        float(np.sqrt(text.count("|") / n)),
        float(np.sqrt(digits / chars)),
        float(np.sqrt((text.count(".") + text.count(",")) / n)),
        float(len({w.lower() for w in words}) / n * small(n)),
        float(small(n / len(lines))),
        float(np.sqrt(1 - len(set(lines)) / len(lines))),
        float(np.sqrt(max(0.0, 1 - letters / chars))),
    )


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([list(statistics(t or "")) for t in texts])


@dataclass(frozen=True)
class QualityModel:
    """Per class: prior log-probability, mean, inverse Cholesky factor, half log-determinant; then the calibration."""

    priors: tuple[float, float]
    means: np.ndarray
    roots: np.ndarray
    halves: tuple[float, float]
    intercept: float = 0.0
    slope: float = 1.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0."""
        sides = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.roots[k].T
            sides.append(self.priors[k] - self.halves[k] - 0.5 * (z * z).sum(axis=1))
        return sides[1] - sides[0]


def moments(rows: DataFrame, width: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products per label, in one partial aggregation over all labelled rows."""
    x = [F.element_at("x", i + 1) for i in range(width)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(width)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(width) for j in range(i, width)]
    out = {}
    for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect():  # two rows
        second = np.zeros((width, width))
        for i in range(width):
            for j in range(i, width):
                second[i, j] = second[j, i] = r[f"p{i}_{j}"]
        out[r["label"]] = (float(r["n"]), np.array([r[f"s{i}"] for i in range(width)]), second)
    return out


def discriminant(found: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> QualityModel:
    """Shrunken class covariances and their Cholesky factors from the moments of both classes."""
    total = found[0][0] + found[1][0]
    means = np.array([found[k][1] / found[k][0] for k in (0, 1)])
    own = [found[k][2] / found[k][0] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (found[0][0] * own[0] + found[1][0] * own[1]) / total
    width = len(pooled)
    floor = np.diag(np.maximum(np.diag(pooled), 1e-4))
    roots, halves = [], []
    for k in (0, 1):
        cov = (1 - RIDGE) * ((1 - POOLED) * own[k] + POOLED * pooled) + RIDGE * floor
        factor = np.linalg.cholesky(cov + 1e-6 * np.eye(width))
        roots.append(np.linalg.inv(factor))
        halves.append(float(np.log(np.diag(factor)).sum()))
    priors = tuple(float(np.log(found[k][0] / total)) for k in (0, 1))
    return QualityModel(priors, means, np.array(roots), tuple(halves))


def _with_score(rows: DataFrame, model: QualityModel) -> DataFrame:
    @F.pandas_udf("struct<difference:double,score:double>")
    def score(x: pd.Series) -> pd.DataFrame:
        d = model.difference(np.stack(x.to_numpy())) if len(x) else np.zeros(0)
        p = 1 / (1 + np.exp(-np.clip(model.intercept + model.slope * d, -500, 500)))
        return pd.DataFrame({"difference": d, "score": p})

    return rows.withColumn("s", score(F.col("x"))).select("*", "s.difference", "s.score").drop("s")


def _calibrated(rows: DataFrame, model: QualityModel) -> QualityModel:
    """A logistic curve over the density differences of all labelled rows, counted in cells."""
    cell = F.round(F.least(F.greatest("difference", F.lit(-_REACH)), F.lit(_REACH)) / _CELL)
    cells = _with_score(rows, model).groupBy(cell.alias("cell"), "label").count().toPandas()
    x = cells["cell"].to_numpy(float) * _CELL
    design = np.column_stack([np.ones_like(x), np.clip(x, -20, 20)])
    beta = logistic(design, cells["label"].to_numpy(float), cells["count"].to_numpy(float))
    return QualityModel(model.priors, model.means, model.roots, model.halves, float(beta[0]), float(max(beta[1], 0.0)))


def quality_documents(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """Score every whole text for quality.

    Columns: doc_id, held_out, score, predicted, difference (log density of the
    good class minus that of the bad one, with priors). The statistics of every
    document are written once; the labels meet that narrow table, so no text is
    shuffled, and the model is fitted on all labelled rows that are not held
    out. A NULL text counts as empty: all its statistics are zero and it is
    scored like any other. With one class missing from the labels every score is
    that class's value (0.5 without labels). A document labelled both ways counts
    as good. Repeated rows score alike; an empty
    table gives no rows.
    """
    rows = columns_of(docs, doc_id=key, text=text)
    table = written(rows.select("doc_id", _statistics_of(F.col("text")).alias("x")), "statistics")
    known = columns_of(labels, doc_id=key, label=label).where(
        ~held_out(F.col("doc_id")) & F.col("label").isin(0, 1)
    )
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    train = written(table.join(known, "doc_id"), "labelled")
    found = moments(train, len(STATISTICS))
    if len(found) < 2:
        flat = 0.5 if not found else float(next(iter(found)))
        out = table.select("doc_id", F.lit(flat).alias("score"), F.lit(0.0).alias("difference"))
    else:
        out = _with_score(table, _calibrated(train, discriminant(found)))
    return out.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
        "difference",
    )
