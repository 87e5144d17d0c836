"""Models from training to scoring (O-70, O-71): safe splits, cross-fitted calibration, saved models.

A cross-fitted model is one logistic pipeline per fold, fitted on the other folds, with a sigmoid
fitted on that fold's own scores, which its pipeline has not seen. Its probability is the mean
of the calibrated folds. It is saved as a folder (a pipeline per fold and ``model.json`` with the
features, their order and the sigmoids) and scores batches and streams alike.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.coerce import finite
from riskspark.functions.quantiles import exact_quantiles
from riskspark.operators import ml as ML
from riskspark.session import stage_table

# ---- fixed values --------------------------------------------------------------------
TEST_SHARES = (25, 20, 15, 10)
MAX_FOLDS = 3
# --------------------------------------------------------------------------------------
_EPS = 1e-6


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows of each of the two classes; one aggregate."""
    r = df.agg(*[F.count_if(F.col(label).cast("int") == y).alias(f"n{y}") for y in (0, 1)]).first()
    return {0: r["n0"], 1: r["n1"]}


def test_share(counts: dict[int, int]) -> int:
    """The largest test share (percent) that leaves every class a row to train on; the smallest one if none does.

    The stratified cut gives the test side ``floor((n - 1) share) + 1`` of a class's n ids."""
    if min(counts.values()) == 0:
        raise ValueError(f"training data has one class only: {counts}")
    left = lambda n, s: n - ((n - 1) * s // 100 + 1)
    return next((s for s in TEST_SHARES if min(left(n, s) for n in counts.values()) >= 1), TEST_SHARES[-1])


def stratified_split(df: DataFrame, id_col: str, label: str, seed: int = 42) -> DataFrame:
    """``is_test`` by the hash of the id, each class cut at the same share: 25 percent, or less where a class is rare."""
    return ML.hash_split(df, id_col, test_share(class_counts(df, label)), seed, label)


def fold_count(counts: dict[int, int]) -> int:
    """Three folds, two where the rarer class has two rows, none below."""
    rare = min(counts.values())
    return MAX_FOLDS if rare >= MAX_FOLDS else 2 if rare == 2 else 0


def with_folds(df: DataFrame, id_col: str, label: str, folds: int, seed: int = 11) -> DataFrame:
    """``fold`` 0 .. folds-1 by the hash of the id, cut per class so that every class is spread evenly."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string")), 11).cast("double") / F.lit(float(1 << 53))
    d = df.withColumn("_h", h)
    cuts = exact_quantiles(d.select(F.col(label).alias("_y"), "_h"), "_h", [i / folds for i in range(1, folds)], by=["_y"], out="_q")
    d = d.join(F.broadcast(cuts), d[label].eqNullSafe(cuts["_y"]), "left")  # one row for each class
    return d.withColumn("fold", F.size(F.filter("_q", lambda q: q < F.col("_h"))).cast("int")).drop("_h", "_y", "_q")


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_EPS)), F.lit(1 - _EPS))
    return F.log(p / (F.lit(1.0) - p))


def clip_pd(p: Column) -> Column:
    """O-22: a probability of default is a number in [0, 1]."""
    return F.least(F.greatest(p.cast("double"), F.lit(0.0)), F.lit(1.0))


def _sigmoid(scored: DataFrame, label: str, score: str) -> tuple[float, float]:
    """Slope and intercept of a logistic fit of the label on the logit of the score."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    pipe = Pipeline(stages=[VectorAssembler(inputCols=["_l"], outputCol="_lv"), LogisticRegression(featuresCol="_lv", labelCol=label)])
    lr = pipe.fit(scored.select(F.col(label).cast("double").alias(label), _logit(F.col(score)).alias("_l"))).stages[-1]
    return float(lr.coefficients[0]), float(lr.intercept)


@dataclass
class ScoreModel:
    """Fitted pipelines with their sigmoids; ``folds`` 0 is one pipeline without calibration."""

    features: list[str]
    pipelines: list[PipelineModel]
    sigmoids: list[tuple[float, float] | None]
    folds: int
    notes: dict = field(default_factory=dict)

    def matrix(self, df: DataFrame) -> DataFrame:
        """The model's features by name, in its order, as numbers: absent, NULL, NaN and infinite values are 0; other columns go by."""
        have = {c.lower(): c for c in df.columns}
        x = [F.coalesce(finite(F.col(f"`{have[f.lower()]}`").try_cast("double")), F.lit(0.0)) if f.lower() in have else F.lit(0.0)
             for f in self.features]
        return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(f) for f, c in zip(self.features, x, strict=True)])

    def score(self, df: DataFrame, out: str = "PD") -> DataFrame:
        """``df`` (a batch or a stream) with the probability, clipped to [0, 1]."""
        d = self.matrix(df)
        parts: list[Column] = []
        for k, (model, sigmoid) in enumerate(zip(self.pipelines, self.sigmoids, strict=True)):
            before = d.columns
            d = model.transform(d).withColumn(f"_p{k}", vector_to_array("probability")[1])
            d = d.select(*before, f"_p{k}")
            p = F.col(f"_p{k}")
            parts.append(p if sigmoid is None else F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(sigmoid[0]) * _logit(p) + F.lit(sigmoid[1])))))
        mean = sum(parts[1:], parts[0]) / F.lit(float(len(parts)))
        names = d.schema["_row"].dataType.names
        return d.select(*[F.col(f"_row.`{c}`").alias(c) for c in names if c != out], clip_pd(mean).alias(out))

    def save(self, path: str) -> None:
        """Write the pipelines and, last, ``model.json``: a folder without it is no model."""
        spark = SparkSession.active()
        for k, model in enumerate(self.pipelines):
            model.write().overwrite().save(f"{path}/fold={k}")
        meta = {"features": self.features, "sigmoids": self.sigmoids, "folds": self.folds, "notes": self.notes}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model.json")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ScoreModel:
        meta = json.loads("".join(r["value"] for r in spark.read.text(f"{path}/model.json").collect()))  # one line
        models = [PipelineModel.load(f"{path}/fold={k}") for k in range(len(meta["sigmoids"]))]
        return ScoreModel(meta["features"], models, [s and tuple(s) for s in meta["sigmoids"]], meta["folds"], meta["notes"])


def train_calibrated(train: DataFrame, features: Sequence[str], label: str, id_col: str) -> tuple[ScoreModel, DataFrame]:
    """The model, and the training rows with their ``fold`` and out-of-fold ``oof`` score.

    ``train`` should be a table (or staged): every fold reads it."""
    feats = [f for f in features if f != label]
    folds = fold_count(class_counts(train, label))
    if not folds:
        one = ScoreModel(feats, [ML.train_pd_logistic(train, feats, label)], [None], 0)
        return one, train.withColumns({"fold": F.lit(None).cast("int"), "oof": F.lit(None).cast("double")})
    d = stage_table(with_folds(train, id_col, label, folds))  # read some six times a fold: the cuts are found once
    pipelines, sigmoids, scored = [], [], []
    for k in range(folds):
        model = ML.train_pd_logistic(d.where(F.col("fold") != k), feats, label)
        held = ML.score_with(model, d.where(F.col("fold") == k), "oof").select(*d.columns, "oof")
        pipelines.append(model)
        sigmoids.append(_sigmoid(held, label, "oof"))
        scored.append(held)
    out = scored[0]
    for s in scored[1:]:
        out = out.unionByName(s)
    return ScoreModel(feats, pipelines, sigmoids, folds), out
