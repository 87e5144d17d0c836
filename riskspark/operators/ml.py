"""Model training with Spark ML (O-71, O-72) and evaluation with the metric operators.

Splits are deterministic hash splits of the entity id, stratified by class where a label is given,
class imbalance is handled with a balanced weight column, and the resolved label is
always removed from the feature list (D4). A training set with fewer than two classes is
rejected by counting distinct classes (D5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import FeatureHasher, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.coerce import align_features
from riskspark.functions.quantiles import exact_quantiles
from riskspark.operators import metrics as M

HASHED_CATEGORIES = 512
#: Rows that one task of a training works on: the boosted trees hold four bytes for each row and slot of the features.
TRAIN_ROWS = 100_000


def hash_split(df: DataFrame, id_col: str, test_pct: int = 25, seed: int = 42, label: str | None = None) -> DataFrame:
    """Adds ``is_test`` by a stable hash of (seed, id). With ``label`` the cut is the class's own
    quantile of the hash (one exact quantile per class), so every class gives the same share;
    distinct ids only: rows of one id stay on one side of their class's cut."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string")), 11).cast("double") / F.lit(float(1 << 53))
    if label is None:
        return df.withColumn("is_test", h < F.lit(test_pct / 100))
    d = df.withColumn("_h", h)
    cut = exact_quantiles(d.select(F.col(label).alias("_y"), "_h"), "_h", [test_pct / 100], by=["_y"], out="_q")
    return d.join(F.broadcast(cut), d[label].eqNullSafe(cut["_y"]), "left").withColumn("is_test", F.col("_h") <= F.col("_q")[0]) \
        .drop("_h", "_y", "_q")  # one row for each class


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly to tasks of at most about TRAIN_ROWS rows; a table of so few stays as it is."""
    n = df.count()
    return df.repartition(-(-n // TRAIN_ROWS)) if n > TRAIN_ROWS else df


def balanced_weights(df: DataFrame, label: str, out: str = "w") -> DataFrame:
    """w = N / (classes * n_class): one small aggregate joined back (broadcast: one row per class)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n_classes = c.count()  # at most a handful of rows
    if n_classes < 2:
        raise ValueError(f"training data has {n_classes} class(es); need 2")
    tot = c.agg(F.sum("_nc").alias("_n"))
    c = c.crossJoin(tot).select(label, (F.col("_n") / (F.lit(n_classes) * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(c), label, "left")


def train_pd_logistic(train: DataFrame, features: Sequence[str], label: str, reg: float = 0.0):
    """O-71: standardise + class-balanced logistic regression."""
    feats = [f for f in features if f != label]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="_x", handleInvalid="keep"),
                            StandardScaler(inputCol="_x", outputCol="_xs", withMean=True, withStd=True),
                            LogisticRegression(featuresCol="_xs", labelCol=label, weightCol="w", regParam=reg)])
    return pipe.fit(balanced_weights(train, label))


def train_gbt(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str,
              max_iter: int = 20, max_depth: int = 4, seed: int = 42):
    """O-72: boosted trees with class weights; categorical values are hashed into a fixed number
    of one-hot slots, so neither the driver nor the feature width grows with them and unseen
    values need no special case."""
    numeric = [f for f in numeric if f != label]
    stages, cats = [], [c for c in categorical if c != label]
    if cats:
        stages.append(FeatureHasher(inputCols=cats, outputCol="_cats", numFeatures=HASHED_CATEGORIES, categoricalCols=cats))
    stages.append(VectorAssembler(inputCols=[*numeric, *(["_cats"] if cats else [])], outputCol="_x", handleInvalid="keep"))
    stages.append(GBTClassifier(featuresCol="_x", labelCol=label, weightCol="w", maxIter=max_iter,
                                maxDepth=max_depth, seed=seed))
    return Pipeline(stages=stages).fit(balanced_weights(spread(train), label))


def score_with(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Positive-class probability as a plain double column."""
    return model.transform(df).withColumn(out, vector_to_array(F.col("probability"))[1])


def calibrate_sigmoid(scored: DataFrame, label: str, score: str = "score"):
    """O-71: a sigmoid over the logit of a score, fitted on rows the model has not seen; returns
    a function that replaces the score column by the calibrated one."""
    p = F.least(F.greatest(F.col(score), F.lit(1e-6)), F.lit(1 - 1e-6))
    logit = F.log(p / (F.lit(1.0) - p))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["_logit"], outputCol="_l"), LogisticRegression(featuresCol="_l", labelCol=label)])
    lr = pipe.fit(scored.select(label, logit.alias("_logit"))).stages[-1]
    a, b = float(lr.coefficients[0]), float(lr.intercept)
    return lambda df: df.withColumn(score, F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * logit + F.lit(b)))))


def evaluate(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: n, AUC, Gini, KS, Brier, average precision (exact metric operators)."""
    a = M.roc_auc(scored, score, label)
    k = M.ks_stat(scored, score, label)
    b = M.brier(scored, score, label)
    ap = M.average_precision(scored, score, label)
    n = scored.agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(a).crossJoin(k).crossJoin(b).crossJoin(ap)


def prepare_matrix(df: DataFrame, features: Sequence[str], keep: Sequence[str], fill: str = "median") -> DataFrame:
    """O-21 before training (the same imputation is used at scoring time, D9)."""
    return align_features(df, list(features), fill=fill, keep=list(keep))
