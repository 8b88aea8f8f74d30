"""Classification of molecules by a random forest over their row of signals."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dyelake.operators.calls import subsample_per_class


def _vectors(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.col("vec").cast("array<double>")))


def rf_train(train: DataFrame, n_subsample: int | None = None, trees: int = 10, min_leaf: int = 50, depth: int = 10, seed: int = 7) -> PipelineModel:
    """A forest of ``trees`` over ``train`` (true_pep_i, vec), at most ``n_subsample`` rows of each peptide, ``min_leaf`` rows a leaf.

    Peptides are the classes; their names are the model's, so they are taken to be few thousand.
    """
    rows = train if n_subsample is None else subsample_per_class(train, n_subsample)
    index = StringIndexer(inputCol="true_pep_i", outputCol="label", stringOrderType="alphabetAsc")
    forest = RandomForestClassifier(numTrees=trees, minInstancesPerNode=min_leaf, maxDepth=depth, seed=seed)
    return Pipeline(stages=[index, forest]).fit(_vectors(rows.select(F.col("true_pep_i").cast("string").alias("true_pep_i"), "vec")))


def rf_classify(rows: DataFrame, model: PipelineModel, keep_all: bool = False) -> DataFrame:
    """``rows`` (vec, ...) with pred_pep_i and score, the greatest probability of a class; with ``keep_all`` also all of them, in scores, by the model's order of labels.

    A row of another number of columns than the model's is an error.
    """
    index, forest = model.stages
    wrong = F.raise_error(F.format_string("a row has %d columns, the model %d", F.size("vec"), F.lit(forest.numFeatures)))
    fit = rows.withColumn("vec", F.when(F.size("vec") == forest.numFeatures, F.col("vec")).otherwise(wrong))
    out = forest.transform(_vectors(fit)).withColumn("scores", vector_to_array("probability")).withColumn("score", F.array_max("scores"))
    labels = F.array(*(F.lit(int(x)) for x in index.labels))
    out = out.withColumn("pred_pep_i", F.element_at(labels, F.array_position("scores", F.col("score")).cast("int")))
    return out.drop("features", "rawPrediction", "probability", "prediction", *([] if keep_all else ["scores"]))
