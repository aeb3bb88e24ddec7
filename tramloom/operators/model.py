"""A boosted-tree regression on features, its nodes as a table, and its batch scoring.

Missing numbers become a value outside the range beside a mark; a category that is null or that training never saw is a
category of its own. Categories are split as sets, not as ordered numbers. Trees are read as rows (tree, node, feature,
threshold or set, children, value), so that scoring is a native expression and anybody can check a score.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tramloom.config import DEFAULT, Settings
from tramloom.operators import baselines, encode
from tramloom.sources.tables import shared_folder

#: What stands for a missing number: below all that occurs.
OUTSIDE = -1e6


@dataclass(frozen=True)
class Model:
    """Fitted trees, codes, the columns in their order, and the mean by which targets exceed predictions."""

    trees: PipelineModel
    codes: DataFrame
    columns: tuple[str, ...]
    categories: tuple[str, ...]
    offset: float = 0.0


def _sizes(codes: DataFrame | None) -> dict[str, int]:
    return {} if codes is None else {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count("*").alias("n")).collect()}


def _inputs(columns: Sequence[str], categories: Sequence[str]) -> list[tuple[str, str, str]]:
    """(input, column, what it tells: value, missing or category), in the order of the trees' features."""
    return [x for c in columns for x in ([(f"m_{c}", c, "category")] if c in categories else [(f"m_{c}", c, "value"), (f"n_{c}", c, "missing")])]


def _numbers(rows: DataFrame, codes: DataFrame | None, columns: Sequence[str], categories: Sequence[str], sizes: dict[str, int]) -> DataFrame:
    """rows with m_* for every column and n_* for every number."""
    rows = encode.matrix(rows, codes, columns, categories, "e_")
    for c in columns:
        own = F.col(f"e_{c}").cast("double")
        if c in categories:
            n = sizes.get(c, 0)
            kind = {"ml_attr": {"type": "nominal", "num_vals": n + 1, "name": c}}
            rows = rows.withColumn(f"m_{c}", F.when(own < 0, float(n)).otherwise(own).alias(f"m_{c}", metadata=kind))
        else:
            rows = rows.withColumn(f"m_{c}", F.coalesce(own, F.lit(OUTSIDE))).withColumn(f"n_{c}", own.isNull().cast("double"))
    return rows.drop(*[f"e_{c}" for c in columns])


def fit(
    train: DataFrame, columns: Sequence[str], target: str = "actual_duration_sec", rounds: int = 20, depth: int = 5, bins: int = 64, seed: int = 17,
    valid: DataFrame | None = None, tolerance: float = 0.001, loss: str = "absolute", step: float = 0.1,
) -> Model:
    """Trees that lessen the error. With ``valid`` rows, rounds end when these gain less than the tolerance; codes know training alone."""
    categories = encode.categorical_columns(train, columns)
    codes = encode.fit_codes(train, categories) if categories else None
    sizes = _sizes(codes)
    marked = train.withColumn("__valid", F.lit(False))
    if valid is not None:
        marked = marked.unionByName(valid.withColumn("__valid", F.lit(True)))
    rows = _numbers(marked.where(F.col(target).isNotNull()), codes, columns, categories, sizes).withColumn("__y", F.col(target).cast("double"))
    trees = GBTRegressor(featuresCol="__x", labelCol="__y", predictionCol="prediction", lossType=loss, maxIter=rounds, stepSize=step, maxDepth=depth, maxBins=max([bins, *[n + 2 for n in sizes.values()]]), seed=seed)
    if valid is not None:
        trees = trees.setValidationIndicatorCol("__valid").setParams(validationTol=tolerance)
    assembler = VectorAssembler(inputCols=[x for x, _, _ in _inputs(columns, categories)], outputCol="__x")
    fitted = trees.fit(assembler.transform(rows))
    return Model(PipelineModel([assembler, fitted]), codes, tuple(columns), tuple(categories))


def predict(model: Model, rows: DataFrame) -> DataFrame:
    """rows with prediction."""
    names = rows.columns
    return model.trees.transform(_numbers(rows, model.codes, model.columns, model.categories, _sizes(model.codes))).select(*names, "prediction")


#: (tree, weight, node, column, tells, threshold, categories, left, right, value, gain, rows). A row goes left if its value is
#: at most the threshold (of ``missing``: if it is not missing), or if its category is in the set, where null stands for
#: all that training never saw. A leaf has no column.
NODES = "tree int, weight double, node int, column string, tells string, threshold double, categories array<string>, left int, right int, value double, gain double, rows long"


def nodes(model: Model) -> DataFrame:
    """The fitted trees as a table of nodes, by what their writer saves."""
    spark = SparkSession.active()
    path = f"{shared_folder(spark)}/trees-{uuid.uuid4().hex}"
    model.trees.stages[-1].write().save(path)
    kept = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").join(F.broadcast(spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("treeID"), F.col("_3").alias("weight"))), "treeID")  # a row a tree
    inputs = spark.createDataFrame([(i, c, tells) for i, (_, c, tells) in enumerate(_inputs(model.columns, model.categories))], "i int, column string, tells string")
    rows = kept.join(F.broadcast(inputs), F.col("split.featureIndex") == F.col("i"), "left")
    split, leaf = F.col("split.leftCategoriesOrThreshold"), F.col("leftChild") < 0
    rows = rows.select(
        F.col("treeID").alias("tree"), "weight", F.col("id").alias("node"), "column", "tells", F.when(F.col("tells") != "category", split[0]).alias("threshold"), F.when(F.col("tells") == "category", split).alias("codes"),
        F.when(~leaf, F.col("leftChild")).alias("left"), F.when(~leaf, F.col("rightChild")).alias("right"), F.col("prediction").alias("value"), F.when(~leaf, F.col("gain")).alias("gain"), F.col("rawCount").alias("rows"),
    )
    own = rows.where("codes is not null").select("tree", "node", "column", F.explode(F.col("codes").cast("array<int>")).alias("code"))
    known = spark.createDataFrame([], _CODES) if model.codes is None else model.codes
    sets = own.join(known, ["column", "code"], "left").groupBy("tree", "node").agg(F.collect_list(F.struct("value")).alias("sets"))  # a list of structs keeps nulls
    return rows.join(sets, ["tree", "node"], "left").select(*[F.col("sets.value").alias("categories") if c == "categories" else F.col(c) for c in (x.split()[0] for x in NODES.split(", "))])


def by_nodes(rows: DataFrame, table: DataFrame, categories: dict[str, Sequence[str]], name: str = "prediction") -> DataFrame:
    """rows scored by a table of nodes, without any model: one native expression. categories: each one's known values.

    The table is as large as the trees (rounds times two to the depth), whatever the rows.
    """
    held: dict[tuple[int, int], Row] = {(n["tree"], n["node"]): n for n in table.collect()}

    def walk(n: Row) -> Column:
        if n["column"] is None:
            return F.lit(n["value"])
        c = F.col(n["column"])
        if n["tells"] == "missing":
            left = c.isNotNull() == F.lit(n["threshold"] < 1)
        elif n["tells"] == "value":
            left = F.coalesce(c.cast("double"), F.lit(OUTSIDE)) <= n["threshold"]
        else:
            inside = [x for x in n["categories"] if x is not None]
            left = F.coalesce(c.cast("string").isin(inside), F.lit(False))
            if len(inside) < len(n["categories"]):
                left = left | ~F.coalesce(c.cast("string").isin(list(categories[n["column"]])), F.lit(False))
        return F.when(left, walk(held[n["tree"], n["left"]])).otherwise(walk(held[n["tree"], n["right"]]))

    total = functools.reduce(lambda a, b: a + b, (F.lit(n["weight"]) * walk(n) for (_, node), n in sorted(held.items()) if node == 0), F.lit(0.0))
    return rows.withColumn(name, total)


def known_values(model: Model) -> dict[str, list[str]]:
    """The categories' values that training saw; as many as there are codes."""
    found: dict[str, list[str]] = {c: [] for c in model.categories}
    for r in [] if model.codes is None else model.codes.collect():
        found[r["column"]].append(r["value"])
    return found


def calibrate(model: Model, rows: DataFrame, target: str = "actual_duration_sec") -> Model:
    """The model with the offset that its predictions of rows lack on average."""
    found = baselines.residual_offset(predict(model, rows), "prediction", target).first()["offset"]
    return replace(model, offset=float(found or 0.0))


def predict_calibrated(model: Model, rows: DataFrame) -> DataFrame:
    """rows with prediction and calibrated."""
    return predict(model, rows).withColumn("calibrated", F.col("prediction") + F.lit(model.offset))


_ABOUT = "columns array<string>, categories array<string>, offset double"
_CODES = "column string, value string, code int"


def save(model: Model, spark: SparkSession, path: str) -> None:
    """Write all that scoring needs into the folder path, in place of what is there."""
    model.trees.write().overwrite().save(f"{path}/trees")
    spark.createDataFrame([(list(model.columns), list(model.categories), model.offset)], _ABOUT).write.mode("overwrite").parquet(f"{path}/about")
    codes = spark.createDataFrame([], _CODES) if model.codes is None else model.codes.select("column", "value", F.col("code").cast("int").alias("code"))
    codes.write.mode("overwrite").parquet(f"{path}/codes")


def load(spark: SparkSession, path: str) -> Model:
    about = spark.read.schema(_ABOUT).parquet(f"{path}/about").first()
    return Model(PipelineModel.load(f"{path}/trees"), spark.read.schema(_CODES).parquet(f"{path}/codes"), tuple(about["columns"]), tuple(about["categories"]), about["offset"])


def gains(model: Model) -> DataFrame:
    """(feature, gain): each column's value and mark together. As many rows as the model has columns."""
    weights, found = model.trees.stages[-1].featureImportances.toArray(), dict.fromkeys(model.columns, 0.0)
    for w, (_, c, _) in zip(weights, _inputs(model.columns, model.categories), strict=True):
        found[c] += float(w)
    return SparkSession.active().createDataFrame(list(found.items()), "feature string, gain double")


def scoring_warnings(n_segments: Column | str, recent: Column | str = "recent_deviation", settings: Settings = DEFAULT) -> Column:
    """What a caller should know of a prediction: it reaches beyond training, or recent conditions are unknown."""
    n, r = (F.col(c) if isinstance(c, str) else c for c in (n_segments, recent))
    return F.array_compact(F.array(F.when(n > settings.max_trained_segments, F.lit("beyond_training")), F.when(r.isNull(), F.lit("no_recent_conditions"))))
