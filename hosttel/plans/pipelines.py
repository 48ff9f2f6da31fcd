"""Feature pipelines and tree classifiers.

index (StringIndexer) → one-hot (OneHotEncoder) → assemble (VectorAssembler)
→ tree (DecisionTree / GBT), all Spark ML. Improvements over the reference's
flow, same models:

* the feature stages are fitted once and shared by both classifiers (the
  reference fits them twice per table);
* the transformed training set is cached only for the iterative tree fits
  and released afterwards;
* evaluation scans the predictions once for all metrics (see
  ``operators.metrics``) instead of one job per metric;
* no row is lost: missing numbers are imputed and flagged, unseen or missing
  categories get a place of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as MT
from ..operators import sample as S
from ..operators.clean import with_label


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are categories and which are numbers."""

    categorical: list[str]
    numeric: list[str]
    label: str = "attack"
    handle_invalid: str = "keep"

    @property
    def index_cols(self) -> list[str]:
        return [f"{c}_index" for c in self.categorical]

    @property
    def vec_cols(self) -> list[str]:
        return [f"{c}_vec" for c in self.categorical]

    @property
    def number_cols(self) -> list[str]:
        return [f"{c}_number" for c in self.numeric]

    @property
    def missing_cols(self) -> list[str]:
        return [f"{c}_missing" for c in self.numeric]


# fixed values: the reference's feature choices per table
PROCESS_FEATURES = FeatureSpec(["Status", "State", "CMD"], ["TSLPI", "CPU", "CPUNR"])
MEMORY_FEATURES = FeatureSpec(["CMD"], ["VSTEXT", "RSIZE", "MINFLT", "MAJFLT"])


def feature_stages(spec: FeatureSpec) -> list:
    """Numbers → imputer → indexer → encoder → assembler (M4, M5, M6).

    No row is dropped, in fitting or in scoring: a category that is null or
    was not seen gets a place of its own (``handleInvalid="keep"``), a number
    that is null or NaN gets the training mean and a flag as a feature.
    """
    numbers = [f"CAST({c} AS DOUBLE) AS {n}, CAST({c} IS NULL OR isnan(CAST({c} AS DOUBLE)) AS DOUBLE) AS {m}"
               for c, n, m in zip(spec.numeric, spec.number_cols, spec.missing_cols, strict=True)]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(numbers)} FROM __THIS__"),
                    Imputer(inputCols=spec.number_cols, outputCols=[f"{c}_filled" for c in spec.numeric], strategy="mean")]
    if spec.categorical:
        stages += [StringIndexer(inputCols=spec.categorical, outputCols=spec.index_cols, handleInvalid=spec.handle_invalid),
                   OneHotEncoder(inputCols=spec.index_cols, outputCols=spec.vec_cols)]
    return [*stages, VectorAssembler(
        inputCols=spec.vec_cols + [f"{c}_filled" for c in spec.numeric] + spec.missing_cols,
        outputCol="features", handleInvalid="error")]


def classifier(kind: str, spec: FeatureSpec, **params):
    """Decision tree or gradient-boosted trees with Spark defaults (M7, M8)."""
    common = dict(featuresCol="features", labelCol=spec.label)
    if kind == "dt":
        return DecisionTreeClassifier(**common, **params)
    if kind == "gbt":
        return GBTClassifier(**common, **params)
    raise ValueError(kind)


def tree_pipeline(spec: FeatureSpec, kind: str = "gbt", **params) -> Pipeline:
    """The reference's four-stage pipeline (M9)."""
    return Pipeline(stages=feature_stages(spec) + [classifier(kind, spec, **params)])


def fit_models(train: DataFrame, spec: FeatureSpec, kinds=("dt", "gbt"),
               params: dict | None = None) -> dict[str, PipelineModel]:
    """Fit the feature stages once, then each classifier on the shared
    features; returns one ``PipelineModel`` per kind (M9)."""
    params = params or {}
    # the sample's columns once: the feature stages and the trees each read it again
    sample = train.where(F.col(spec.label).isNotNull()).select(*spec.categorical, *spec.numeric, spec.label).cache()
    feats = Pipeline(stages=feature_stages(spec)).fit(sample)
    prepared = feats.transform(sample).select("features", F.col(spec.label).cast("double").alias(spec.label)).cache()
    try:
        out = {}
        for kind in kinds:
            model = classifier(kind, spec, **params.get(kind, {})).fit(prepared)
            out[kind] = PipelineModel(stages=list(feats.stages) + [model])
        return out
    finally:
        prepared.unpersist()
        sample.unpersist()


def train_test(df: DataFrame, spec: FeatureSpec, key: str | None = None,
               seed: int = S.SEED, balance: bool = True) -> tuple[DataFrame, DataFrame]:
    """80/20 split (stable by ``key`` when given, else ``randomSplit``) and the
    class-balanced training sample (M1, M3)."""
    if key is not None:
        split = S.hash_split(df, key, seed=seed, name="_split")
        train = split.where(F.col("_split") == "train").drop("_split")
        test = split.where(F.col("_split") == "test").drop("_split")
    else:
        train, test = S.random_split(df, seed=seed)
    if balance:
        method = "hash" if key is not None else "bernoulli"
        train = S.balance(train, spec.label, seed=seed, method=method, key=key)
    return train, test


def predict(model: PipelineModel, df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Score rows; adds ``label`` = int copy of the class column."""
    return with_label(model.transform(df), spec.label)


def evaluate(pred: DataFrame, spec: FeatureSpec) -> DataFrame:
    """AUC (from the class-1 probability) and the four multiclass metrics, one row."""
    return MT.scored_metrics(pred, MT.class_probability("probability", 1), spec.label, "prediction")


def final_model(df: DataFrame, spec: FeatureSpec, path: str | None = None, kind: str = "gbt",
                seed: int = S.SEED, key: str | None = None, **params) -> PipelineModel:
    """Balance the *whole* cleaned table, fit, optionally save.
    With ``key`` the sample is a function of the rows, however they are
    partitioned; without, rows are drawn at random as by ``sampleBy``."""
    sample = S.balance(df, spec.label, seed=seed, method="hash" if key else "bernoulli", key=key)
    model = fit_models(sample, spec, (kind,), {kind: params})[kind]
    if path:
        model.write().overwrite().save(path)
    return model


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline."""
    return PipelineModel.load(path)
