"""Training, tuning, scoring and inspection of root-cause classifiers."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..functions import text
from ..functions.columns import computed_once, sparse
from ..functions.scalar import TIME_FEATURES
from ..rules.stop_words import ENGLISH
from ..rules import DEFAULT_PACKS, RulePacks
from ..session import materialize
from . import evaluate, features, permuted, prefixes
from .stages import BoostedTrees, LogColumns, UnseenAsMinusOne, few_parts

RANDOM_FOREST, LOGISTIC, BOOSTED = "random_forest", "logistic_regression", "boosted_trees"
# Spark's limit; stands for "no limit".
DEEPEST = 30


@dataclass(frozen=True)
class ModelConfig:
    """What to train and how. The defaults are fixed values."""

    model_type: str = RANDOM_FOREST
    seed: int = 42
    balanced: bool = True
    logistic_c: float = 1.0
    logistic_max_iter: int = 1000
    forest_trees: int = 100
    forest_max_depth: int | None = None
    forest_min_split: int = 2
    forest_min_leaf: int = 1
    boost_rounds: int = 100
    boost_max_depth: int = 6
    boost_rate: float = 0.1
    boost_subsample: float = 1.0
    folds: int = 5
    tune: bool = True
    scoring: str = "macro_f1"
    grid: dict[str, list] | None = None
    parallelism: int = 4


@dataclass(frozen=True)
class FeatureConfig:
    max_features: int = 1000
    min_df: int | float = 1
    max_df: int | float = 1.0
    stop_words: list[str] | None = None
    label: str = "root_cause_label"
    message: str = "log_message"
    service: str = "service"
    severity: str = "severity"
    timestamp: str = "timestamp"


CATEGORICAL = ["service_encoded", "severity_encoded", "error_class_encoded"]


def fit_features(df: DataFrame, config: FeatureConfig = FeatureConfig(),
                 packs: RulePacks = DEFAULT_PACKS) -> tuple[PipelineModel, list[str]]:
    """Fit vocabulary and category codes on ``df``; returns the fitted stages and the feature names.

    One pipeline serves training and scoring, so both see the same codes.
    """
    words = list(ENGLISH if config.stop_words is None else config.stop_words)
    columns = LogColumns(packs=packs.to_json(), stopWords=words, messageCol=config.message,
                         serviceCol=config.service, severityCol=config.severity, timestampCol=config.timestamp)
    derived = columns.transform(df)
    vocabulary = features.fit_vocabulary(derived, "terms", config.max_features, config.min_df, config.max_df,
                                         n_docs=df.count())
    stages: list = [columns]
    if vocabulary.terms:
        stages += features.tfidf_stages(vocabulary, "terms", "tfidf")
    classed = df.select(config.service, text.classify_error(F.col(config.message), packs).alias("error_class"))
    for source, out in ((config.service, "service"), ("error_class", "error_class")):
        known = features.fit_categories(classed, source)
        stages.append(StringIndexerModel.from_labels(known, inputCol=source, outputCol=f"_{out}_index",
                                                     handleInvalid="keep"))
        stages.append(UnseenAsMinusOne(inputCol=f"_{out}_index", outputCol=f"{out}_encoded", known=len(known)))
    parts = (["tfidf"] if vocabulary.terms else []) + CATEGORICAL + TIME_FEATURES
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return PipelineModel(stages), vocabulary.terms + CATEGORICAL + TIME_FEATURES


def assemble_features(df: DataFrame, fitted: PipelineModel) -> DataFrame:
    """Add the sparse ``features`` vector: TF-IDF, three category codes, four time features."""
    extra = [c for s in fitted.stages for c in _outputs(s)]
    return fitted.transform(df).drop(*extra)


def _outputs(stage) -> list[str]:
    if isinstance(stage, LogColumns):
        return ["terms", "error_class", "severity_encoded", *TIME_FEATURES]
    if isinstance(stage, VectorAssembler):
        return []
    return [stage.getOrDefault("outputCol")]


def index_labels(df: DataFrame, labels: list[str], label: str = "root_cause_label") -> DataFrame:
    """Add ``label_index``: the position of the label in ``labels``."""
    return StringIndexerModel.from_labels(labels, inputCol=label, outputCol="label_index",
                                          handleInvalid="error").transform(df)


def fit_random_forest(df: DataFrame, config: ModelConfig = ModelConfig(), weight: str | None = None):
    """Forest on (features, label_index); unlimited depth means Spark's deepest trees."""
    return _forest(config, weight).fit(df)


def fit_logistic(df: DataFrame, config: ModelConfig = ModelConfig(model_type=LOGISTIC), weight: str | None = None):
    """Multinomial logistic model whose penalty corresponds to strength 1 / C on the summed loss."""
    total = df.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    return _logistic(config, weight, float(total)).fit(df)


def fit_boosted_trees(df: DataFrame, config: ModelConfig = ModelConfig(model_type=BOOSTED), weight: str | None = None):
    """One boosted-tree model per class, combined to class probabilities."""
    return _boosted(config, weight).fit(df)


def _forest(config: ModelConfig, weight: str | None) -> RandomForestClassifier:
    # A node below the split size stays whole: the smallest leaf of a split node is half of it.
    leaf = max(config.forest_min_leaf, config.forest_min_split // 2)
    return RandomForestClassifier(
        labelCol="label_index", featuresCol="features", numTrees=config.forest_trees, seed=config.seed,
        maxDepth=DEEPEST if config.forest_max_depth is None else min(config.forest_max_depth, DEEPEST),
        minInstancesPerNode=leaf, featureSubsetStrategy="sqrt", weightCol=weight)


def _logistic(config: ModelConfig, weight: str | None, total: float) -> LogisticRegression:
    return LogisticRegression(
        labelCol="label_index", featuresCol="features", family="multinomial", maxIter=config.logistic_max_iter,
        regParam=1.0 / (config.logistic_c * max(total, 1.0)), standardization=False, weightCol=weight)


def _boosted(config: ModelConfig, weight: str | None) -> BoostedTrees:
    return BoostedTrees(weightCol=weight, maxIter=config.boost_rounds, maxDepth=config.boost_max_depth,
                        stepSize=config.boost_rate, subsamplingRate=config.boost_subsample, seed=config.seed)


def estimator(config: ModelConfig, weight: str | None, total: float) -> Estimator:
    if config.model_type == RANDOM_FOREST:
        return _forest(config, weight)
    if config.model_type == LOGISTIC:
        return _logistic(config, weight, total)
    if config.model_type == BOOSTED:
        return _boosted(config, weight)
    raise ValueError(f"unknown model type {config.model_type}")


# The parameter grids.
GRIDS = {
    LOGISTIC: {"logistic_c": [0.01, 0.1, 1.0, 10.0], "balanced": [False, True]},
    RANDOM_FOREST: {"forest_trees": [50, 100, 200], "forest_max_depth": [None, 10, 20],
                    "forest_min_split": [2, 5, 10], "balanced": [False, True]},
    BOOSTED: {"boost_rounds": [50, 100, 200], "boost_max_depth": [3, 6, 9], "boost_rate": [0.01, 0.1, 0.3],
              "boost_subsample": [0.8, 1.0]},
}


def parameter_grid(config: ModelConfig) -> dict[str, list]:
    return GRIDS[config.model_type] if config.grid is None else config.grid


class MacroF1(Evaluator):
    """Unweighted mean of the class F1 scores."""

    def _evaluate(self, dataset: DataFrame) -> float:
        cm = evaluate.confusion(dataset, "label_index", "prediction")
        return evaluate.overall_metrics(cm).filter("metric = 'macro_f1'").first()["value"]

    def isLargerBetter(self) -> bool:
        return True


# Grid fields that one fitted ensemble answers for: its first trees or rounds, the tops of its trees.
PREFIXES = {RANDOM_FOREST: ("forest_trees", "forest_max_depth"), BOOSTED: ("boost_rounds",), LOGISTIC: ()}


@dataclass
class Tuned:
    """The refitted best model, its configuration and score, and the whole grid."""

    model: object
    best: ModelConfig
    best_score: float
    results: DataFrame


def _depth(limit: int | None) -> int:
    return DEEPEST if limit is None else min(limit, DEEPEST)


def _fold_scores(train_rows: DataFrame, test_rows: DataFrame, points: list[ModelConfig], n_classes: int,
                 total: float) -> list[dict[str, float]]:
    """The scores of grid points that differ in prefixes alone, from one fit on the training rows of a fold."""
    first = points[0]
    weight = "weight" if first.balanced else "unit_weight"
    if first.model_type == RANDOM_FOREST:
        sizes = sorted({p.forest_trees for p in points})
        depths = sorted({_depth(p.forest_max_depth) for p in points})
        fitted = _forest(replace(first, forest_trees=sizes[-1], forest_max_depth=depths[-1]), weight).fit(train_rows)
        counts = prefixes.forest_confusions(test_rows, fitted, sizes, depths, n_classes)
        at = [sizes.index(p.forest_trees) * len(depths) + depths.index(_depth(p.forest_max_depth)) for p in points]
    elif first.model_type == BOOSTED:
        rounds = sorted({p.boost_rounds for p in points})
        fitted = _boosted(replace(first, boost_rounds=rounds[-1]), weight).fit(train_rows)
        classes = [m for m in fitted.stages if hasattr(m, "treeWeights")]
        counts = prefixes.boosted_confusions(test_rows, classes, rounds, n_classes)
        at = [rounds.index(p.boost_rounds) for p in points]
    else:
        scored = estimator(first, weight, total).fit(train_rows).transform(test_rows)
        counts = scored.groupBy(F.lit(0).alias("point"), F.col("label_index").cast("int").alias("truth"),
                                F.col("prediction").cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
        at = [0]
    tables: dict[int, np.ndarray] = {}
    for r in counts.collect():  # at most classes x classes rows for each point
        tables.setdefault(r["point"], np.zeros((n_classes, n_classes), np.int64))[r["truth"], r["prediction"]] = r["n"]
    empty = np.zeros((n_classes, n_classes), np.int64)
    return [prefixes.scores_of(tables.get(i, empty)) for i in at]


def tune(df: DataFrame, config: ModelConfig, label: str = "root_cause_label", key: str = "log_id") -> Tuned:
    """Exhaustive grid search over stratified folds by ``config.scoring`` (macro F1 unless another mean is named).

    ``df`` has features, label_index and weight. Points that differ only in the
    number of trees or rounds, or in the depth of a forest, are scored from one
    fit: a forest of 200 trees holds one of 50 as its first trees, and a deep tree a
    shallow one as its top. The fits run as concurrent Spark jobs on cached folds.
    """
    grid = parameter_grid(config)
    names = list(grid)
    points = [dict(zip(names, values)) for values in itertools.product(*grid.values())]
    alike: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        alike.setdefault(tuple((k, v) for k, v in p.items() if k not in PREFIXES[config.model_type]), []).append(i)
    folded = (features.stratified_folds(df, label, config.folds, config.seed, key)
              .withColumn("unit_weight", F.lit(1.0))
              .select("features", "label_index", "weight", "unit_weight", "fold").persist())
    try:
        facts = folded.agg(F.count(F.lit(1)).alias("n"), F.max("fold").alias("last"), F.max("label_index").alias("top")).first()
        folds, n_classes, total = facts["last"] + 1, int(facts["top"]) + 1, float(facts["n"])

        rows = few_parts(folded, facts["n"])

        def one(job: tuple[int, list[int]]) -> tuple[list[int], list[dict[str, float]]]:
            fold, which = job
            return which, _fold_scores(rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold),
                                       [replace(config, **points[i]) for i in which], n_classes, total)

        jobs = [(fold, which) for which in alike.values() for fold in range(folds)]
        sums = [0.0] * len(points)
        with ThreadPoolExecutor(config.parallelism) as pool:
            for which, found in pool.map(inheritable_thread_target(df.sparkSession)(one), jobs):
                for i, scores in zip(which, found):
                    sums[i] += scores[config.scoring] / folds
        best = max(range(len(points)), key=lambda i: sums[i])
        chosen = replace(config, **points[best])
        model = estimator(chosen, "weight" if chosen.balanced else "unit_weight", total).fit(rows)
    finally:
        folded.unpersist()
    rows = [(config.model_type, json.dumps(p), folds, s) for p, s in zip(points, sums)]
    results = df.sparkSession.createDataFrame(rows, f"model_type string, params string, n_folds int, {config.scoring} double")
    return Tuned(model, chosen, sums[best], results)


@dataclass
class LogModel:
    """Feature stages and classifier as one pipeline, with the label and feature names."""

    pipeline: PipelineModel
    labels: list[str]
    feature_names: list[str]
    config: ModelConfig
    notes: dict = field(default_factory=dict)

    @property
    def classifier(self):
        return self.pipeline.stages[-1]

    @property
    def feature_stages(self) -> PipelineModel:
        return PipelineModel(self.pipeline.stages[:-1])


def save_pipeline(model: LogModel, path: str, spark: SparkSession) -> str:
    """Write the pipeline and its description to storage all executors reach."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    text_ = json.dumps({"labels": model.labels, "feature_names": model.feature_names,
                        "config": asdict(model.config), "notes": model.notes})
    spark.createDataFrame([(text_,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/description")
    return path


def load_pipeline(path: str, spark: SparkSession) -> LogModel:
    raw = json.loads(spark.read.text(f"{path}/description", wholetext=True).first()["value"])
    return LogModel(PipelineModel.load(f"{path}/pipeline"), raw["labels"], raw["feature_names"],
                    ModelConfig(**raw["config"]), raw["notes"])


def train(df: DataFrame, config: ModelConfig = ModelConfig(), feature_config: FeatureConfig = FeatureConfig(),
          packs: RulePacks = DEFAULT_PACKS, fit_on: DataFrame | None = None, key: str = "log_id") -> LogModel:
    """Fit features, weights and classifier on labelled rows, with the grid search if asked for.

    ``fit_on`` names other rows for the feature statistics (all rows, say). Rows
    without a label take no part in the fit.
    """
    df = df.filter(F.col(feature_config.label).isNotNull())
    fitted, names = fit_features(df if fit_on is None else fit_on, feature_config, packs)
    label = feature_config.label
    labels = features.fit_categories(df, label)
    ready = index_labels(features.with_class_weight(assemble_features(df, fitted), label), labels, label)
    ready = ready.select(key, label, "features", "label_index", "weight").persist()
    notes: dict = {}
    try:
        if config.tune:
            tuned = tune(ready, config, label, key)
            model, config = tuned.model, tuned.best
            notes = {"best_score": tuned.best_score,
                     "grid": [r.asDict() for r in tuned.results.collect()]}
        else:
            weight = "weight" if config.balanced else None
            total = float(ready.agg(F.sum("weight")).first()[0])
            model = estimator(config, weight, total).fit(ready)
    finally:
        ready.unpersist()
    return LogModel(PipelineModel([*fitted.stages, model]), labels, names, config, notes)


def score(df: DataFrame, model: LogModel) -> DataFrame:
    """Add ``prediction`` (label), ``probability`` (array in label order) and ``confidence``
    (probability of the predicted label). No shuffle."""
    kept = df.columns
    scored = model.pipeline.transform(df)
    position = F.col("prediction").cast("int")
    once = computed_once(
        scored.withColumn("_scores", vector_to_array(F.col("probability"))).withColumn("_position", position),
        _label=F.get(text.string_array(model.labels), F.col("_position")), _probability=F.col("_scores"),
        _confidence=F.get("_scores", F.col("_position")))
    return once.select(*kept, F.col("_label").alias("prediction"), F.col("_probability").alias("probability"),
                       F.col("_confidence").alias("confidence"))


def _forest_like(model) -> list:
    if isinstance(model, PipelineModel):
        return [s for s in model.stages if hasattr(s, "featureImportances")]
    return [model] if hasattr(model, "featureImportances") else []


def feature_importance(model: LogModel, spark: SparkSession, top: int | None = None) -> DataFrame:
    """Rows (feature, importance): impurity importance of trees (mean over the class models of
    boosted trees), mean absolute coefficient over the classes of a linear model."""
    trees = _forest_like(model.classifier)
    if trees:
        values = [sum(t.featureImportances[i] for t in trees) / len(trees) for i in range(len(model.feature_names))]
    else:
        matrix = model.classifier.coefficientMatrix.toArray()
        values = [float(v) for v in abs(matrix).mean(axis=0)]
    table = spark.createDataFrame([(n, float(v)) for n, v in zip(model.feature_names, values)],
                                  "feature string, importance double")
    ordered = table.orderBy(F.desc("importance"), F.asc("feature"))
    return ordered.limit(top) if top else ordered


def compare_models(train_df: DataFrame, test_df: DataFrame, configs: list[ModelConfig],
                   feature_config: FeatureConfig = FeatureConfig(), packs: RulePacks = DEFAULT_PACKS,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Rows (model_type, accuracy, macro_f1, weighted_f1, error): every configuration on the same
    rows, with the feature statistics of ``fit_on`` where given; a failure becomes a row instead of ending the comparison."""
    spark, label, parts = train_df.sparkSession, feature_config.label, []
    for config in configs:
        try:
            model = train(train_df, config, feature_config, packs, fit_on)
            cm = evaluate.confusion(score(test_df, model), label, "prediction")
            values = {r["metric"]: r["value"] for r in evaluate.overall_metrics(cm).collect()}
            parts.append((config.model_type, values["accuracy"], values["macro_f1"], values["weighted_f1"], None))
        except Exception as err:  # noqa: BLE001 - reported in the row
            parts.append((config.model_type, None, None, None, f"{type(err).__name__}: {err}"))
    return spark.createDataFrame(
        parts, "model_type string, accuracy double, macro_f1 double, weighted_f1 double, error string")


def inference_check(df: DataFrame, model: LogModel, label: str = "root_cause_label",
                    key: str = "log_id") -> DataFrame:
    """Score the first log of each label: rows (log_id, label, prediction, confidence, correct)."""
    by = Window.partitionBy(label).orderBy(key)
    first = df.withColumn("_rank", F.row_number().over(by)).filter("_rank = 1").drop("_rank")
    return score(first, model).select(key, F.col(label).alias("label"), "prediction", "confidence",
                                      (F.col(label) == F.col("prediction")).alias("correct"))


def permutation_importance(df: DataFrame, model: LogModel, names: list[str], repeats: int = 10, seed: int = 42,
                           label: str = "root_cause_label", key: str = "log_id",
                           per_class: bool = True, digits: int | None = None) -> DataFrame:
    """Rows (label, feature, importance): the mean drop of the score when one feature is shuffled.

    ``per_class`` uses the one-vs-rest area of each class; otherwise accuracy,
    with an empty label. Each repeat passes every row's values on to the next
    row in a random order of all rows. Only the entries that change are scored
    anew, features the model does not use not at all, and an area changes by
    the scores that have moved: the area counts pairs, so the change is the
    moved scores against all, all against the moved, and the moved against each other.
    """
    spark = df.sparkSession
    judge = permuted.scorer(spark, model.classifier)
    listed = {model.feature_names.index(n): n for n in names}
    used = judge.used & np.isin(np.arange(judge.width), list(listed))
    truth = F.array_position(text.string_array(model.labels), F.col(label)).cast("int") - 1
    rows = assemble_features(df.select(key, label, *_inputs(df, model)), model.feature_stages).select(
        key, F.coalesce(truth, F.lit(-1)).alias("truth"), *sparse("features"))
    coded = StructType([*(rows.schema[n] for n in (key, "truth")), StructField("code", BinaryType())])
    base = materialize(rows.mapInArrow(lambda batches: permuted.packed(batches, judge), coded), "permuted")
    # The place of a row splits what many rows have in common; within a part equal rows lie together.
    moved = _given(base, key, repeats, seed).repartitionByRange("code", "place").sortWithinPartitions("code").select("repeat", "truth", "code", "given")

    alike = base.groupBy("code", "truth").agg(F.count(F.lit(1)).alias("n"))
    counts = "label int, score double, pos long, neg long"
    whole = materialize(alike.mapInArrow(lambda batches: permuted.plain(batches, judge, per_class, digits), counts)
                        .groupBy("label", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "scores")
    splits = _splits(whole)
    parts = "label int, range int, whole boolean, counts binary"
    dealt = moved.mapInArrow(lambda batches: permuted.changed(batches, judge, used, repeats, splits, per_class, digits), parts).unionByName(
        whole.mapInArrow(lambda batches: permuted.graded(batches, splits), parts))
    totals, drops = _drops(whole, dealt, splits, repeats, per_class)
    return spark.createDataFrame(
        [(n, g, drops.get((k, p), 0.0) / repeats if not per_class or all(totals[k]) else None)
         for k, n in enumerate(model.labels if per_class else [""]) if k in totals for p, g in listed.items()],
        "label string, feature string, importance double")


def _splits(whole: DataFrame) -> dict[int, list[float]]:
    """For each label the scores at which a new range begins, so that a range has some thousand of its different scores."""
    sizes = whole.groupBy("label").count().collect()
    parts = -(-max((r["count"] for r in sizes), default=1) // permuted.IN_RANGE)
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = whole.groupBy("label").agg(F.percentile_approx("score", shares).alias("at")).collect() if parts > 1 else []
    return {r["label"]: [] for r in sizes} | {r["label"]: sorted(set(r["at"])) for r in found}


def _given(base: DataFrame, key: str, repeats: int, seed: int) -> DataFrame:
    """Each row for each repeat, with the entries ``given`` by the next row in a random order; the last gets the first's.

    Ranges of the order are dealt to parts; a part's last row gets the first row of the next part.
    """
    place = F.xxhash64(key, F.col("repeat") + F.lit(seed), F.lit("place"))
    many = base.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("place", place)
    order = ["repeat", "place", key]
    dealt = many.repartitionByRange(*order).sortWithinPartitions(*order).select("repeat", "place", "truth", "code")
    passed = materialize(dealt.mapInArrow(permuted.passed_on, "repeat int, place long, truth int, code binary, given binary, part int, head boolean"), "order")
    heads = passed.filter("head").select("repeat", "part", "code")
    parts = Window.partitionBy("repeat").orderBy("part")
    heads = heads.select("repeat", "part", F.coalesce(F.lead("code").over(parts), F.first("code").over(
        parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("given"))
    kept = ["repeat", "place", "truth", "code", "given"]
    last = passed.filter("given is null").drop("given").join(heads, ["repeat", "part"])
    return passed.filter("given is not null").select(kept).unionByName(last.select(kept))


def _drops(whole: DataFrame, dealt: DataFrame, splits: dict[int, list[float]], repeats: int,
           per_class: bool) -> tuple[dict[int, tuple[int, int]], dict[tuple[int, int], float]]:
    """label -> (positives, negatives); (label, feature) -> by how much the areas of all repeats together fall, or the shares
    of right predictions.

    Ranges of the scores are settled one by one; between ranges the moved positives of one meet the moved negatives of those below.
    """
    sums = whole.mapInArrow(lambda batches: permuted.range_sums(batches, splits), "label int, range int, pos long, neg long")
    pos, neg = ({k: np.zeros(len(cuts) + 1, np.int64) for k, cuts in splits.items()} for _ in range(2))
    for r in sums.groupBy("label", "range").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect():  # one of some thousand scores
        pos[r["label"]][r["range"]], neg[r["label"]][r["range"]] = r["pos"], r["neg"]
    totals = {k: (int(pos[k].sum()), int(neg[k].sum())) for k in splits}
    below, above = {k: np.cumsum(neg[k]) - neg[k] for k in splits}, {k: totals[k][0] - np.cumsum(pos[k]) for k in splits}

    def settled(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, part = (v.as_py() for v in key)
        yield permuted.settled(batches, k, part, int(below[k][part]), int(above[k][part]), repeats)

    found = dealt.groupBy("label", "range").applyInArrow(settled, "label int, range int, feature int, repeat int, twice long, pos long, neg long")
    lower = Window.partitionBy("label", "feature", "repeat").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    met = found.withColumn("met", F.col("pos") * F.coalesce(F.sum("neg").over(lower), F.lit(0).cast("long")))
    gains = met.groupBy("label", "feature").agg(F.sum(F.col("twice") / 2.0 + F.col("met")).alias("pairs"), F.sum("pos").alias("right")).collect()
    if per_class:  # classes x features
        return totals, {(r["label"], r["feature"]): -r["pairs"] / (totals[r["label"]][0] * totals[r["label"]][1]) for r in gains if all(totals[r["label"]])}
    return totals, {(r["label"], r["feature"]): -r["right"] / sum(totals[r["label"]]) for r in gains}


def _inputs(df: DataFrame, model: LogModel) -> list[str]:
    stage = model.pipeline.stages[0]
    used = [stage.getOrDefault(p) for p in (stage.messageCol, stage.serviceCol, stage.severityCol, stage.timestampCol)]
    return [c for c in used if c in df.columns]


# The plain form: every row scored again for every feature. Tests hold the patches above against it.

def _shuffled(base: DataFrame, key: str, positions: list[int], names: list[str], groups: int, seed: int,
              changed: bool = False) -> DataFrame:
    """One row per source row and feature, with that feature's value taken from another row.

    ``changed`` leaves out the rows whose value stays the same; the columns of
    the earlier prediction, if any, are kept.
    """
    kept = [n for n in ("_probability", "_prediction") if n in base.columns]
    values = base.withColumn("_values", vector_to_array("features"))
    picked = F.array(*[F.get("_values", F.lit(p)) for p in positions])
    by = Window.partitionBy("_group").orderBy("_place", key)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moved = (values.withColumn("_picked", picked)
             .withColumn("_group", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(groups)))
             .withColumn("_place", F.xxhash64(key, F.lit(seed), F.lit("place")))
             .withColumn("_given", F.coalesce(F.lead("_picked").over(by), F.first("_picked").over(whole))))
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(p).alias("_at"), F.get("_given", F.lit(i)).alias("_new"))
                      for i, (n, p) in enumerate(zip(names, positions))])
    if changed:
        cells = F.filter(cells, lambda x: F.get("_values", x["_at"]) != x["_new"])
    rows = moved.select(key, "truth", *kept, "_values", F.inline(cells))
    replaced = F.transform("_values", lambda v, i: F.when(i == F.col("_at"), F.col("_new")).otherwise(v))
    return rows.select(key, "truth", *kept, "feature", array_to_vector(replaced).alias("features"))


def _predicted(df: DataFrame, model: LogModel) -> DataFrame:
    return model.classifier.transform(df).withColumn("probability", vector_to_array("probability"))


def _points(df: DataFrame, model: LogModel, by: list[str], per_class: bool, digits: int | None) -> DataFrame:
    """Rows (by…, label, score, pos, neg): counts of rows by score, each counted ``_n`` times.

    Without ``per_class`` right and wrong predictions are counted, under one empty label.
    """
    if not per_class:
        names = F.array(*[F.lit(k) for k in model.labels])
        own = F.get(names, F.col("prediction").cast("int")) == F.col("truth")
        rows = df.select(*by, "truth", "_n", own.alias("_own"), F.lit("").alias("label"), F.lit(0.0).alias("score"))
    else:
        cells = F.array(*[F.struct(F.lit(k).alias("label"), F.get("probability", F.lit(i)).alias("score"))
                          for i, k in enumerate(model.labels)])
        rows = df.select(*by, "truth", "_n", F.inline(cells)).withColumn("_own", F.col("truth") == F.col("label"))
    if digits is not None:
        rows = rows.withColumn("score", F.round("score", digits))
    return rows.groupBy(*by, "label", "score").agg(
        F.sum(F.when(F.col("_own"), F.col("_n")).otherwise(0)).alias("pos"),
        F.sum(F.when(~F.col("_own"), F.col("_n")).otherwise(0)).alias("neg"))


def _values(points: DataFrame, by: list[str], per_class: bool) -> DataFrame:
    """Rows (by…, label, value): the area of each class, or the share of right predictions."""
    if not per_class:
        right, wrong = F.sum("pos"), F.sum("neg")
        return points.groupBy(*by, "label").agg(F.try_divide(right.cast("double"), right + wrong).alias("value"))
    return evaluate.area(points, [*by, "label"]).withColumnRenamed("auc", "value")
