"""ML pipeline stages: log features, class probabilities of boosted trees."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Normalizer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar, text
from ..functions.columns import computed_once
from ..rules import RulePacks


# A tree level is one pass over the rows: below so many in a task, starting the task costs more than the pass.
ROWS_PER_TASK = 2_000


def few_parts(df: DataFrame, n_rows: int) -> DataFrame:
    """``df`` in as many parts as ``n_rows`` rows are worth, if those are fewer; no shuffle."""
    return df.coalesce(max(1, -(-n_rows // ROWS_PER_TASK)))


class LogColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Derives from a log row: ``terms``, ``error_class``, ``severity_encoded`` and the time features.

    The rule packs and the stop words are stored with the stage, so a reloaded
    pipeline derives exactly what it was fitted on.
    """

    packs = Param(Params._dummy(), "packs", "rule packs as JSON", TypeConverters.toString)
    stopWords = Param(Params._dummy(), "stopWords", "words left out of the terms", TypeConverters.toListString)
    messageCol = Param(Params._dummy(), "messageCol", "message column", TypeConverters.toString)
    serviceCol = Param(Params._dummy(), "serviceCol", "service column", TypeConverters.toString)
    severityCol = Param(Params._dummy(), "severityCol", "severity column", TypeConverters.toString)
    timestampCol = Param(Params._dummy(), "timestampCol", "time column, may be absent", TypeConverters.toString)

    @keyword_only
    def __init__(self, packs: str | None = None, stopWords: list[str] | None = None, messageCol: str = "log_message",
                 serviceCol: str = "service", severityCol: str = "severity", timestampCol: str = "timestamp"):
        super().__init__()
        self._setDefault(stopWords=[], messageCol="log_message", serviceCol="service",
                         severityCol="severity", timestampCol="timestamp")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        packs = RulePacks.from_json(self.getOrDefault(self.packs))
        message, service = F.col(self.getOrDefault(self.messageCol)), F.col(self.getOrDefault(self.serviceCol))
        time_col = self.getOrDefault(self.timestampCol)
        time = F.col(time_col) if time_col in dataset.columns else F.lit(None).cast("string")
        error_class = text.classify_error(message, packs)
        tokens = text.tokenize(text.combined_message(service, message, packs))
        derived = computed_once(dataset, error_class=error_class,
                                _tokens=text.remove_stop_words(tokens, self.getOrDefault(self.stopWords)))
        derived = computed_once(derived, terms=text.ngrams(F.col("_tokens"), 1, 2)).drop("_tokens")
        columns = {"severity_encoded": scalar.encode_severity(F.col(self.getOrDefault(self.severityCol)), packs),
                   **scalar.time_features(time)}
        return derived.withColumns({k: v.cast("double") for k, v in columns.items()})


class UnseenAsMinusOne(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Turns the index Spark gives to unseen categories (the number of known ones) into −1."""

    inputCol = Param(Params._dummy(), "inputCol", "index column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "code column", TypeConverters.toString)
    known = Param(Params._dummy(), "known", "number of known categories", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, known: int | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        index = F.col(self.getOrDefault(self.inputCol))
        code = F.when(index == self.getOrDefault(self.known), F.lit(-1.0)).otherwise(index)
        return dataset.withColumn(self.getOrDefault(self.outputCol), code)


class MostProbable(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``: the position of the largest probability, the first on ties."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scores = vector_to_array(F.col("probability"))
        return (dataset.withColumn("_scores", scores)
                .withColumn("prediction", (F.array_position("_scores", F.array_max("_scores")) - 1).cast("double"))
                .drop("_scores"))


class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol):
    """Multi-class boosting: one binary boosted-tree model per class, probabilities scaled to sum 1.

    The result is a pipeline of built-in stages, so it saves and loads like any other.
    """

    maxIter = Param(Params._dummy(), "maxIter", "boosting rounds", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "tree depth", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows per tree", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    parallelism = Param(Params._dummy(), "parallelism", "classes fitted at a time", TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol: str = "features", labelCol: str = "label_index", weightCol: str | None = None,
                 maxIter: int = 100, maxDepth: int = 6, stepSize: float = 0.1, subsamplingRate: float = 1.0,
                 seed: int = 42, parallelism: int = 8):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label_index", maxIter=100, maxDepth=6, stepSize=0.1,
                         subsamplingRate=1.0, seed=42, parallelism=8)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        label, features = self.getLabelCol(), self.getFeaturesCol()
        weight = self.getWeightCol() if self.isSet(self.weightCol) else None
        used = dataset.select(features, label, *([weight] if weight else [])).persist()
        try:
            facts = used.agg(F.max(label).alias("last"), F.count(F.lit(1)).alias("n")).first()
            classes = int(facts["last"]) + 1
            rows = few_parts(used, facts["n"])

            def fit_one(k: int):
                gbt = GBTClassifier(featuresCol=features, labelCol="_is_class", predictionCol=f"_prediction_{k}",
                                    maxIter=self.getOrDefault(self.maxIter), maxDepth=self.getOrDefault(self.maxDepth),
                                    stepSize=self.getOrDefault(self.stepSize), seed=self.getOrDefault(self.seed),
                                    subsamplingRate=self.getOrDefault(self.subsamplingRate), weightCol=weight)
                gbt.setRawPredictionCol(f"_raw_{k}").setProbabilityCol(f"_probability_{k}")
                return gbt.fit(rows.withColumn("_is_class", (F.col(label) == k).cast("double")))

            with ThreadPoolExecutor(self.getOrDefault(self.parallelism)) as pool:
                models = list(pool.map(fit_one, range(classes)))
        finally:
            used.unpersist()
        stages: list = list(models)
        for k in range(classes):
            stages.append(VectorSlicer(inputCol=f"_probability_{k}", outputCol=f"_share_{k}", indices=[1]))
        stages.append(VectorAssembler(inputCols=[f"_share_{k}" for k in range(classes)], outputCol="_shares"))
        stages.append(Normalizer(p=1.0, inputCol="_shares", outputCol="probability"))
        stages.append(MostProbable())
        return PipelineModel(stages)
