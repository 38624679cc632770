"""Training, tuning, scoring and tree attribution on the orders and documents tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from driftwarden.catalog.registry import query, rounded
from driftwarden.common import scratch_path, written
from driftwarden.functions.scalars import argmax_label
from driftwarden.operators import metrics as M
from driftwarden.operators import split as S
from driftwarden.operators import text_features as TF
from driftwarden.operators import training as T
from driftwarden.operators.chain import encode_preprocess
from driftwarden.plans.scored import ORDERS_SPEC, read, scored_frame
from driftwarden.sources import models

FEATURES = ["o_totalprice", "c_acctbal", "month", "o_orderpriority", "c_mktsegment"]
BINARY = ORDERS_SPEC.with_(sub_cols=("q0", "q1"), name_target="finished", cat_features=("o_orderpriority", "c_mktsegment"),
                           cont_features=("o_totalprice", "c_acctbal", "month"))
SMALL = {"n_estimators": 5, "max_depth": 3, "l_rate": 0.3}


def encoded_orders(spark, sf_dir):
    """Orders with coded features, a binary and a three-class label, and a validation flag."""
    rows = scored_frame(spark, sf_dir).select("row_id", "segment", "target", "set_analysis", "periodo", *FEATURES[:2], *FEATURES[3:])
    rows = rows.withColumns(
        {
            "month": F.months_between("periodo", F.lit("1995-01-01").cast("date")),
            "finished": (F.col("target") == 0).cast("int"),
        }
    )
    split = written(S.stratified_split(rows, "row_id", "finished", 0.33), "split")
    fitted = encode_preprocess(split.where("split = 'train'"), FEATURES[3:], FEATURES[:3], steps_cat=("null", "le"))
    coded = fitted.transform(split).withColumn("validation", F.col("split") == "validation")
    return written(coded.drop("split"), "coded"), fitted


def binary_model(rows):
    return T.train_tabular(rows, FEATURES, "finished", 2, SMALL, "validation")


def quality(scored, spec):
    """Log-loss and AUC on training and validation rows."""
    side = F.when(F.col("validation"), "validation").otherwise("training")
    sides = written(scored.select(side.alias("side"), spec.name_target, *spec.sub_cols), "scores")
    loss = M.metric_log_loss(sides, spec, ["side"])
    return loss.join(M.metric_auc(sides, spec, ["side"]), "side")


@query("train_tabular")
def _train(spark, sf_dir):
    rows, _ = encoded_orders(spark, sf_dir)
    return quality(T.score(binary_model(rows), rows, BINARY.sub_cols), BINARY)


@query("train_tabular_multiclass")
def _train_multi(spark, sf_dir):
    rows, _ = encoded_orders(spark, sf_dir)
    model = T.train_tabular(rows, FEATURES, "target", 3, SMALL, "validation")
    spec = ORDERS_SPEC.with_(sub_cols=("q0", "q1", "q2"))
    return quality(T.score(model, rows, spec.sub_cols), spec)


def labelled_documents(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    return read(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")


@query("train_text")
def _train_text(spark, sf_dir):
    rows = written(S.stratified_split(labelled_documents(spark, sf_dir), "doc_id", "quality", 0.33), "documents")
    model = T.train_text(rows.where("split = 'train'"), "text", "quality", min_df=2, max_iter=20, sublinear=True)
    spec = BINARY.with_(name_target="quality")
    scored = T.score(model, rows.withColumn("validation", F.col("split") == "validation"), spec.sub_cols)
    return quality(scored, spec)


@query(
    "text_model_weights",
    f"""WITH labelled AS (SELECT doc_id, text FROM documents JOIN labels USING (doc_id)),
    tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TF.TOKEN}')) AS token FROM labelled),
    counts AS (SELECT doc_id, token, count(*) AS tf FROM tokens GROUP BY ALL),
    vocabulary AS (SELECT token, count(*) AS df FROM counts GROUP BY token HAVING count(*) >= 3),
    raw AS (SELECT doc_id, token, (1 + ln(tf)) * (ln((1.0::DOUBLE + (SELECT count(*) FROM labelled)) / (1 + df)) + 1) AS raw
      FROM counts JOIN vocabulary USING (token))
    SELECT doc_id, token, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def _text_weights(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    path = scratch_path(spark, "text-model")
    T.train_text(rows, "text", "quality", min_df=3, max_iter=20, sublinear=True).save(path)
    return rounded(TF.term_weights(PipelineModel.load(path), rows, "doc_id"))


@query("tune")
def _tune(spark, sf_dir):
    rows, _ = encoded_orders(spark, sf_dir)
    _, study = T.tune(rows, FEATURES, "finished", 2, "XGB", 3, SMALL)
    _, again = T.tune(rows, FEATURES, "finished", 2, "XGB", 2, SMALL, previous=study)
    first = T.trials_table(spark, study).withColumn("study", F.lit(1))
    return first.unionByName(T.trials_table(spark, again).withColumn("study", F.lit(2)))


@query(
    "trials_table",
    """SELECT CAST(p_partkey AS BIGINT) AS trial, p_type AS state_trial, p_retailprice AS value_trial, 'params_size' AS parameter,
    CAST(p_size AS DOUBLE) AS value FROM part
    UNION ALL SELECT p_partkey, p_type, p_retailprice, 'params_rate', p_retailprice / 100 FROM part""",
)
def _trials(spark, sf_dir):
    trials = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("number"),
        F.col("p_retailprice").alias("value"),
        F.col("p_type").alias("state"),
        F.col("p_size").alias("params_size"),
        (F.col("p_retailprice") / 100).alias("params_rate"),
        F.col("p_brand").alias("params_text"),
    )
    return T.melt_trials(trials)


@query("training_history")
def _history(spark, sf_dir):
    rows, _ = encoded_orders(spark, sf_dir)
    model = binary_model(rows)
    return T.training_history(model, rows.where("NOT validation"), rows.where("validation"))


@query("cross_validate")
def _cross(spark, sf_dir):
    rows, _ = encoded_orders(spark, sf_dir)
    folded = written(S.kfold(rows, ["periodo", "row_id"], 3, "own_fold"), "folds")
    fits = T.cross_validate(folded, FEATURES, "finished", 2, "own_fold", 3, SMALL)
    scored = T.score_folds(fits, folded, "own_fold", BINARY.sub_cols)
    labelled = written(scored.withColumn("prediction", argmax_label(BINARY.sub_cols)), "fold-scores")
    return M.fold_metrics(labelled, BINARY)


@query("score")
def _score(spark, sf_dir):
    rows, _ = encoded_orders(spark, sf_dir)
    return rounded(T.score(binary_model(rows), rows, BINARY.sub_cols).select("row_id", *BINARY.sub_cols))


@query("gain_importance")
def _gain(spark, sf_dir):
    rows, _ = encoded_orders(spark, sf_dir)
    return T.gain_importance(binary_model(rows), spark, FEATURES)


@query("shap_values_tree")
def _tree_shap(spark, sf_dir):
    rows, _ = encoded_orders(spark, sf_dir)
    return T.tree_shap(binary_model(rows), rows, "row_id", FEATURES, BINARY.sub_cols, ["segment"])


@query("save_load_model")
def _save_load(spark, sf_dir):
    rows, fitted = encoded_orders(spark, sf_dir)
    model = binary_model(rows)
    root = scratch_path(spark, "models")
    path = models.save_model(models.SavedModel(model, fitted, BINARY), root)
    loaded = models.load_models(spark, path.rsplit("/", 1)[0])
    again = next(iter(loaded.values()))
    before = T.score(model, rows, ("a0", "a1")).select("row_id", "a1")
    after = T.score(again.model, rows, ("b0", "b1")).select("row_id", "b1")
    return before.join(after, "row_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("a1") - F.col("b1"))).alias("largest_gap")
    )
