"""Model training, search, ensembles, importance and batch scoring on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ordering
from ..functions.columns import as_numbers, evenly, hash_unit
from ..session import cut_lineage

CLASSIFIERS = {
    "decision_tree": lambda: DecisionTreeClassifier(maxDepth=5, seed=42),
    "random_forest": lambda: RandomForestClassifier(numTrees=50, maxDepth=5, seed=42),
    "gbt": lambda: GBTClassifier(maxIter=20, maxDepth=3, seed=42),
    "logistic_l1": lambda: LogisticRegression(elasticNetParam=1.0, regParam=0.01),
    "logistic": lambda: LogisticRegression(),
    "linear_svm": lambda: LinearSVC(maxIter=50),
    "naive_bayes": lambda: NaiveBayes(modelType="gaussian"),
}
REGRESSORS = {
    "decision_tree": lambda: DecisionTreeRegressor(maxDepth=5, seed=42),
    "random_forest": lambda: RandomForestRegressor(numTrees=50, maxDepth=5, seed=42),
    "gbt": lambda: GBTRegressor(maxIter=20, maxDepth=3, seed=42),
    "linear": lambda: LinearRegression(),
    "elastic_net": lambda: LinearRegression(elasticNetParam=0.5, regParam=0.01),
}


def estimator(family: str, task: str = "class", n_features: int | None = None, n_classes: int = 2):
    if family == "mlp":
        return MultilayerPerceptronClassifier(layers=[n_features, 50, n_classes], maxIter=50, seed=42)
    return (CLASSIFIERS if task == "class" else REGRESSORS)[family]()


def stages(numeric: Sequence[str], categorical: Sequence[str] = (), target: str | None = None, scale: bool = True) -> list:
    """Impute, scale and one-hot steps ending in ``features``; a text target becomes ``label``."""
    out = []
    if target:
        out.append(StringIndexer(inputCol=target, outputCol="label", handleInvalid="skip", stringOrderType="alphabetAsc"))
    parts = []
    if numeric:
        out.append(Imputer(strategy="mean", inputCols=list(numeric), outputCols=[f"__i_{c}" for c in numeric]))
        out.append(VectorAssembler(inputCols=[f"__i_{c}" for c in numeric], outputCol="__num"))
        if scale:
            out.append(StandardScaler(inputCol="__num", outputCol="__scaled", withMean=True))
        parts.append("__scaled" if scale else "__num")
    for c in categorical:
        out.append(StringIndexer(inputCol=c, outputCol=f"__x_{c}", handleInvalid="keep"))
        out.append(OneHotEncoder(inputCol=f"__x_{c}", outputCol=f"__o_{c}"))
        parts.append(f"__o_{c}")
    out.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return out


def doubles(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in numeric})


def train(df: DataFrame, numeric: Sequence[str], target: str, family: str = "random_forest", categorical: Sequence[str] = (), task: str = "class") -> PipelineModel:
    """Fitted preparation and model as one savable object."""
    steps = stages(numeric, categorical, target if task == "class" else None)
    n_classes = df.select(target).distinct().count() if family == "mlp" else 2
    model = estimator(family, task, len(numeric), n_classes)
    data = doubles(df, numeric)
    if task != "class":
        data = data.withColumn("label", F.col(target).cast("double"))
    return Pipeline(stages=[*steps, model]).fit(data)


def score(df: DataFrame, model: PipelineModel, numeric: Sequence[str]) -> DataFrame:
    """Batch scoring; class models add the probability of class 1 as ``score``. Rows need no label."""
    unlabelled = lambda s: isinstance(s, StringIndexerModel) and s.getOutputCol() == "label" and s.getInputCol() not in df.columns
    out = PipelineModel([s for s in model.stages if not unlabelled(s)]).transform(doubles(df, numeric))
    if "probability" in out.columns:
        out = out.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    drop = [c for c in out.columns if c.startswith("__") or c in ("features", "rawPrediction", "probability")]
    return out.drop(*drop)


def batch_predict(df: DataFrame, path: str, numeric: Sequence[str]) -> DataFrame:
    return score(df, PipelineModel.load(path), numeric)


def search(df: DataFrame, numeric: Sequence[str], target: str, family: str, grid: Mapping[str, Sequence], folds: int = 3, task: str = "class", parallelism: int = 4, seed: int = 42) -> tuple[object, DataFrame]:
    """Best model (refitted on all rows) and the trial table ``(family, params, score)``; one fold means a single hold-out."""
    steps = Pipeline(stages=stages(numeric, (), target if task == "class" else None))
    data = doubles(df, numeric)
    if task != "class":
        data = data.withColumn("label", F.col(target).cast("double"))
    ready = steps.fit(data).transform(data).select("features", "label").cache()
    model = estimator(family, task, len(numeric))
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    params = builder.build()
    judge = MulticlassClassificationEvaluator(metricName="accuracy") if task == "class" else RegressionEvaluator(metricName="r2")
    if folds > 1:
        fit = CrossValidator(estimator=model, estimatorParamMaps=params, evaluator=judge, numFolds=folds, parallelism=parallelism, seed=seed).fit(ready)
        scores = fit.avgMetrics
    else:
        fit = TrainValidationSplit(estimator=model, estimatorParamMaps=params, evaluator=judge, trainRatio=0.8, parallelism=parallelism, seed=seed).fit(ready)
        scores = fit.validationMetrics
    ready.unpersist()
    rows = [(family, ", ".join(f"{p.name}={v}" for p, v in m.items()), float(s)) for m, s in zip(params, scores)]
    return fit.bestModel, df.sparkSession.createDataFrame(rows, "family string, params string, score double")


def draw_trials(spaces: Mapping[str, Mapping[str, tuple]], trials: int, seed: int = 42) -> list[tuple[str, dict]]:
    """``(family, params)`` of each trial; a trial's draw depends on the seed and its number alone.

    A parameter is ``("uniform", low, high)``, ``("log", low, high)`` (uniform in the logarithm), ``("int", low, high)``
    with both ends, or ``("choice", values)``.
    """
    out = []
    families = sorted(spaces)
    for trial in range(trials):
        rng = np.random.default_rng([seed, trial])
        family = families[int(rng.integers(len(families)))]
        params = {}
        for name, (kind, *range_) in spaces[family].items():
            if kind == "uniform":
                params[name] = float(rng.uniform(*range_))
            elif kind == "log":
                params[name] = float(np.exp(rng.uniform(*np.log(range_))))
            elif kind == "int":
                params[name] = int(rng.integers(range_[0], range_[1] + 1))
            elif kind == "choice":
                params[name] = range_[0][int(rng.integers(len(range_[0])))]
            else:
                raise ValueError(f"unknown kind of parameter {kind}")
        out.append((family, params))
    return out


def random_search(
    train_df: DataFrame, valid: DataFrame, numeric: Sequence[str], target: str, spaces: Mapping[str, Mapping[str, tuple]], trials: int = 20,
    store: str | None = None, task: str = "class", parallelism: int = 4, seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Random search over families and their parameters: the model refitted on train and validation rows, and the trials.

    Every trial is fitted on ``train_df`` and judged on ``valid`` (accuracy or R2); ``parallelism`` trials run at a time as
    Spark jobs. Preparation is fitted on the training rows alone for the trials, and on both parts for the refit. The trial table ``(trial, family, params,
    score, chosen)`` is written to ``store`` if given; of equal scores the first trial wins.
    """
    label = lambda d: doubles(d, numeric) if task == "class" else doubles(d, numeric).withColumn("label", F.col(target).cast("double"))
    judge = MulticlassClassificationEvaluator(metricName="accuracy") if task == "class" else RegressionEvaluator(metricName="r2")
    steps = Pipeline(stages=stages(numeric, (), target if task == "class" else None)).fit(label(train_df))
    ready, held = (cut_lineage(steps.transform(label(d)).select("features", "label")) for d in (train_df, valid))
    drawn = draw_trials(spaces, trials, seed)

    def made(family: str, params: dict):
        model = estimator(family, task, len(numeric))
        return model.copy({model.getParam(n): v for n, v in params.items()})

    def judged(trial: tuple[str, dict]) -> float:
        return float(judge.evaluate(made(*trial).fit(ready).transform(held)))

    with ThreadPool(parallelism) as pool:
        scores = pool.map(inheritable_thread_target(train_df.sparkSession)(judged), drawn)
    best = max(range(trials), key=lambda i: (scores[i], -i))
    rows = [(i, family, json.dumps(params, sort_keys=True), s, i == best) for i, ((family, params), s) in enumerate(zip(drawn, scores, strict=True))]
    table = train_df.sparkSession.createDataFrame(rows, "trial int, family string, params string, score double, chosen boolean")
    if store is not None:
        table.write.parquet(store)
        table = train_df.sparkSession.read.parquet(store)
    both = train_df.unionByName(valid)
    final = Pipeline(stages=[*stages(numeric, (), target if task == "class" else None), made(*drawn[best])]).fit(label(both))
    return final, table


def coefficient_ranking(model, names: Sequence[str], spark) -> DataFrame:
    """Non-zero coefficients of a linear model by absolute value."""
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray()) if c != 0.0]
    return spark.createDataFrame(sorted(rows, key=lambda r: -abs(r[1])), "feature string, coefficient double")


def right_share(scored: DataFrame) -> float:
    """Accuracy, as one aggregate."""
    return float(scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] or 0.0)


def vectors(df: DataFrame, cols: Sequence[str], target: str, task: str = "class", keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, features, label)``; classes become indices in order."""
    data = evenly(as_numbers(df, cols, [*[k for k in keep if k not in cols], F.col(target)]).dropna())
    out = VectorAssembler(inputCols=list(cols), outputCol="features").transform(data)
    if task == "class":
        out = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(out).transform(out)
    else:
        out = out.withColumn("label", F.col(target).cast("double"))
    return out.select(*keep, "features", "label")


def tree_importance(df: DataFrame, cols: Sequence[str], target: str, family: str = "random_forest", task: str = "class") -> DataFrame:
    """``(feature, importance)`` by impurity decrease."""
    model = estimator(family, task).fit(vectors(df, cols, target, task))
    rows = [(c, float(v)) for c, v in zip(cols, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def permutation_importance(df: DataFrame, cols: Sequence[str], target: str, key: str, task: str = "class", repeats: int = 10, family: str = "random_forest", seed: int = 42, parallelism: int = 4) -> DataFrame:
    """``(feature, importance)``: mean loss of score when one column is shuffled.

    Per repeat the rows are numbered twice (by key and by a keyed hash) and joined
    on the number, which gives every row one partner; all columns take their
    shuffled value from that same partner. ``parallelism`` repeats run at a time.
    """
    names = list(cols)
    data = cut_lineage(evenly(as_numbers(df, names, [F.col(key), F.col(target)]).dropna()))
    fitted = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features")]).fit(data)
    indexer = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(data) if task == "class" else None
    prep = lambda d: (indexer.transform(d) if indexer else d.withColumn("label", F.col(target).cast("double")))
    model = estimator(family, task).fit(prep(fitted.transform(data)))
    judge = RegressionEvaluator(metricName="r2")
    judged = lambda d: right_share(d) if task == "class" else judge.evaluate(d)
    base = judged(model.transform(prep(fitted.transform(data))))
    first = cut_lineage(prep(ordering.row_index(data, key, None)).drop("__rn__all"))

    def loss(r: int) -> list[float]:
        other = ordering.row_index(data.withColumn("__u", hash_unit(key, seed=seed + r)), "__u", key)
        other = other.select(F.col("__rn").alias("__at"), *[F.col(f"`{c}`").alias(f"__s_{c}") for c in names])
        pair = cut_lineage(first.join(other, F.col("__rn") == F.col("__at")).select("label", *[F.col(f"`{c}`") for c in names], *[F.col(f"`__s_{c}`") for c in names]))
        return [base - judged(model.transform(fitted.transform(pair.withColumn(c, F.col(f"`__s_{c}`"))))) for c in names]

    with ThreadPool(parallelism) as pool:
        lost = pool.map(inheritable_thread_target(df.sparkSession)(loss), range(repeats))
    rows = [(c, sum(per[i] for per in lost) / repeats) for i, c in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def stack(df: DataFrame, cols: Sequence[str], target: str, key: str, families: Sequence[str] = ("logistic", "random_forest"), folds: int = 3, seed: int = 42) -> DataFrame:
    """``(key, label, prediction, score)`` of a logistic meta model on out-of-fold base scores plus the features.

    The meta model too is fitted once a fold, on the other folds, so no row is scored by a model that saw its label.
    """
    data = vectors(df, cols, target, keep=[key]).withColumn("fold", F.floor(hash_unit(key, seed=seed) * folds).cast("int"))
    data = cut_lineage(data)
    meta = data
    for f in families:
        parts = None
        for k in range(folds):
            model = estimator(f).fit(data.filter(F.col("fold") != k))
            out = model.transform(data.filter(F.col("fold") == k)).select(key, F.get(vector_to_array("probability"), F.lit(1)).alias(f"__p_{f}"))
            parts = out if parts is None else parts.unionByName(out)
        meta = meta.join(parts, key)
    wide = VectorAssembler(inputCols=["features", *[f"__p_{f}" for f in families]], outputCol="__meta").transform(meta)
    wide = cut_lineage(wide)
    final = None
    for k in range(folds):
        out = LogisticRegression(featuresCol="__meta").fit(wide.filter(F.col("fold") != k)).transform(wide.filter(F.col("fold") == k))
        final = out if final is None else final.unionByName(out)
    return final.select(key, "label", "prediction", F.get(vector_to_array("probability"), F.lit(1)).alias("score"))


def residual_blend(df: DataFrame, cols: Sequence[str], target: str, key: str, clip: tuple[float, float] | None = None) -> DataFrame:
    """``(key, label, prediction)``: a tree model plus a linear model of its residual, clipped."""
    data = vectors(df, cols, target, task="regression", keep=[key])
    base = estimator("random_forest", "regression").fit(data).transform(data).withColumnRenamed("prediction", "__base")
    left = base.withColumn("label2", F.col("label") - F.col("__base"))
    fixed = LinearRegression(labelCol="label2").fit(left).transform(left)
    total = F.col("__base") + F.col("prediction")
    if clip is not None:
        total = F.least(F.greatest(total, F.lit(float(clip[0]))), F.lit(float(clip[1])))
    return fixed.select(key, "label", total.alias("prediction"))
