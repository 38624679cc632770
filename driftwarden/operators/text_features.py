"""Token counts and tf-idf in long form, and cleaned review tables."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import written
from driftwarden.functions.scalars import recode_values
from driftwarden.functions.text import clean_text
from driftwarden.operators.windows import keep_first, row_surrogate_id

# Send the helper functions themselves: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: a token is a run of at least two word characters.
TOKEN = r"[\p{L}\p{N}_]{2,}"
# Vectors worked on at a time, so that a batch needs no working arrays of its own length.
_AT_ONCE = 1024


def token_counts(df: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, token, tf``, the tokens of a text counted inside its row.

    What a task holds is one text, however many it reads. Only documents that
    lie in several rows are added up by document and token; NULL is a document.
    """
    ids = df.groupBy(F.col(doc).alias("__id")).agg(F.count(F.lit(1)).alias("__rows"))
    several = ids.where("__rows > 1").select("__id")
    same = F.col(doc).eqNullSafe(F.col("__id"))
    rows = df.select(doc, text)
    repeated = _counted(rows.join(several, same, "left_semi"), doc, text).groupBy(doc, "token").agg(F.sum("tf").alias("tf"))
    return _counted(rows.join(several, same, "left_anti"), doc, text).unionByName(repeated)


def _counted(rows: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, token, tf`` of every row: the lengths of the runs of its sorted tokens."""
    return rows.select(doc, runs(F.sort_array(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)))))


def runs(tokens: Column) -> Column:
    """``token, tf`` lines of a sorted array of tokens."""

    def counted(found: Column) -> Column:
        n = F.size(found)
        places = F.sequence(F.lit(0), n - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(found, i) != F.get(found, i - 1)))
        # Bound to a variable, as the tokens are: an outer expression would be computed once per element.
        lengths = F.transform(F.array(starts), lambda at: _lengths(found, at, n))
        return F.when(n > 0, F.get(lengths, F.lit(0)))

    return F.inline(F.get(F.transform(F.array(tokens), counted), F.lit(0)))


def _lengths(found: Column, starts: Column, n: Column) -> Column:
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(n))
    return F.zip_with(starts, ends, lambda a, b: F.struct(F.get(found, a).alias("token"), (b - a).cast("bigint").alias("tf")))


def vocabulary(counts: DataFrame, min_df: int = 1) -> DataFrame:
    """Tokens with the number of documents that hold them, rare ones left out."""
    return counts.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)


def bag_of_words(df: DataFrame, doc: str, text: str, min_df: int = 1) -> DataFrame:
    counts = token_counts(df, doc, text)
    if min_df <= 1:
        return counts
    counts = written(counts, "token-counts")  # split the texts once, not once per use
    return counts.join(vocabulary(counts, min_df).select("token"), "token", "left_semi").select(doc, "token", "tf")


def tfidf(
    df: DataFrame,
    doc: str,
    text: str,
    min_df: int = 1,
    sublinear: bool = True,
    use_idf: bool = True,
    n_docs: int | None = None,
) -> DataFrame:
    """``doc, token, weight``: 1+ln(tf) or tf, times ln((1+n)/(1+df))+1, rows scaled to length one."""
    total = float(df.count() if n_docs is None else n_docs)
    counts = written(token_counts(df, doc, text), "token-counts")  # split the texts once, not once per use
    terms = counts.join(vocabulary(counts, min_df), "token")
    tf = F.lit(1.0) + F.ln(F.col("tf").cast("double")) if sublinear else F.col("tf").cast("double")
    idf = F.ln(F.lit(1.0 + total) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0) if use_idf else F.lit(1.0)
    raw = terms.select(doc, "token", (tf * idf).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(doc)))
    return raw.select(doc, "token", (F.col("raw") / length).alias("weight"))


class LogTermFrequency(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Counts ``n`` of a vector column as ``1 + ln(n)``; places without a count stay empty, NULL stays NULL.

    Vectors keep their sparse form, and a batch stays the few Arrow arrays that
    it travels as: no object per document or number, never an array as long as
    the vocabulary.
    """

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        @F.arrow_udf(VectorUDT())
        def damped(counts: pa.Array) -> pa.Array:
            return pa.concat_arrays([_damped(counts[i : i + _AT_ONCE]) for i in range(0, max(len(counts), 1), _AT_ONCE)])

        return df.withColumn(self.getOutputCol(), damped(F.col(f"`{self.getInputCol()}`")))


def _damped(vectors: pa.StructArray) -> pa.StructArray:
    """Sparse vectors of ``1 + ln(n)`` for the counts above zero of a batch of vectors."""
    _, size, indices, values = vectors.flatten()
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    counts = values.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    dense = pc.and_(vectors.is_valid(), pc.is_null(indices)).to_numpy(zero_copy_only=False)
    place = np.arange(len(counts)) - np.repeat(np.cumsum(lengths) - lengths, lengths)  # of a dense vector
    place[~dense[row]] = indices.flatten().to_numpy(zero_copy_only=False)
    held = counts > 0
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[held], minlength=len(lengths)))]).astype(np.int32)
    fields = list(vectors.type)
    return pa.StructArray.from_arrays(
        [
            pa.array(np.zeros(len(lengths), np.int8)),
            pa.array(np.where(dense, lengths, pc.fill_null(size, 0).to_numpy(zero_copy_only=False)).astype(np.int32)),
            pa.ListArray.from_arrays(ends, place[held].astype(np.int32), type=fields[2].type),
            pa.ListArray.from_arrays(ends, 1.0 + np.log(counts[held]), type=fields[3].type),
        ],
        fields=fields,
        mask=vectors.is_null(),
    )


def term_weights(model: PipelineModel, df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """``key, token, weight``: the sparse features that a trained text model gives to each row."""
    if hasattr(model.stages[-1], "weights"):  # a model whose vocabulary is a table
        return model.stages[-1].weights(df, key)
    counter = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(counter.vocabulary)), "place int, token string")
    prepared = PipelineModel(model.stages[:-1]).transform(df)
    parts = prepared.select(key, F.unwrap_udt(features).alias("v"))
    terms = parts.select(key, F.inline(F.arrays_zip(F.col("v.indices").alias("place"), F.col("v.values").alias("weight"))))
    return terms.join(names, "place").select(key, "token", "weight")


def review_table(
    df: DataFrame, key: str, text: str, score: str, score_map: Mapping, words: Sequence[str], exact: bool = False
) -> DataFrame:
    """Distinct cleaned texts with a dense row id and the recoded score; empty texts are dropped."""
    cleaned = df.withColumns(
        {text: clean_text(F.col(text), words, exact), score: recode_values(F.col(score), score_map)}
    ).where(F.col(text).isNotNull() & (F.col(text) != ""))
    return row_surrogate_id(keep_first(cleaned, [text], [key]), [key], "id_review")
