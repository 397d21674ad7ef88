"""Comparison of three classifiers by stratified cross-validation, on pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Parts that the rows of a label are dealt to.
PARTS = 16


def profile(df: DataFrame) -> DataFrame:
    """(name, dtype, null_share, distinct_share, min, max) of every column.

    Values are counted per column, all columns in one aggregation that combines before it moves; then they are counted as
    distinct. No row is multiplied by distinct aggregates, and no task sees all values of a column.
    """
    named = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value")) for name in df.columns])).alias("c")
    counts = df.select(named).groupBy("c.name", "c.value").agg(F.count(F.lit(1)).alias("k"))
    shares = counts.groupBy("name").agg(F.sum("k").alias("n"), F.count("value").alias("distinct"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("k"))), F.lit(0)).alias("nulls"))
    ends = df.agg(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(kind).alias("dtype"), F.min(name).cast("string").alias("min"), F.max(name).cast("string").alias("max")) for name, kind in df.dtypes]).alias("c"))
    out = ends.select(F.explode("c").alias("c")).select("c.*").join(F.broadcast(shares), "name", "left")  # a row per column
    return out.select("name", "dtype", (F.col("nulls") / F.col("n")).alias("null_share"), (F.col("distinct") / F.col("n")).alias("distinct_share"), "min", "max")


def with_fold(df: DataFrame, label: str, folds: int, seed: int) -> DataFrame:
    """Rows dealt to folds in turn within each label and hash part, in an order by hash: every label is spread evenly, and
    a frequent label is not one task's."""
    order = F.xxhash64(F.lit(seed), *df.columns)
    part = F.pmod(F.xxhash64(F.lit(seed + 1), *df.columns), F.lit(PARTS))
    rank = F.row_number().over(Window.partitionBy(label, "_part").orderBy(order, *df.columns))
    return df.withColumn("_part", part).withColumn("fold", F.pmod(rank + F.xxhash64("_part"), F.lit(folds)).cast("int")).drop("_part")


def split(df: DataFrame, label: str, test_share: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the same shares of labels."""
    cut = round(test_share * 10)
    dealt = with_fold(df, label, 10, seed)
    return dealt.where(F.col("fold") >= cut).drop("fold"), dealt.where(F.col("fold") < cut).drop("fold")


def stages(label: str, features: list[str], standard: list[str], min_max: list[str], one_hot: list[str]) -> list:
    plain = [f for f in features if f not in {*standard, *min_max, *one_hot}]
    out = [StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip")]
    parts = list(plain)
    for name, columns, scaler in (("standard", standard, StandardScaler(withMean=True)), ("min_max", min_max, MinMaxScaler())):
        if columns:
            out += [VectorAssembler(inputCols=columns, outputCol=f"{name}_raw", handleInvalid="skip"), scaler.copy().setInputCol(f"{name}_raw").setOutputCol(f"{name}_scaled")]
            parts.append(f"{name}_scaled")
    for c in one_hot:
        out += [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="error"), OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_hot", dropLast=True)]
        parts.append(f"{c}_hot")
    return [*out, VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="skip")]


def compare(df: DataFrame, label: str, features: list[str], standard: list[str] = (), min_max: list[str] = (), one_hot: list[str] = (), folds: int = 5, seed: int = 42) -> DataFrame:
    """(classifier, fold, accuracy) of naive Bayes, a decision tree and logistic regression over the training part."""
    train, _ = split(df.select(label, *features).dropna(), label, seed=seed)
    dealt = with_fold(train, label, folds, seed).persist()
    models = {"naive_bayes": NaiveBayes(modelType="gaussian"), "decision_tree": DecisionTreeClassifier(seed=seed), "logistic_regression": LogisticRegression(maxIter=200)}
    score, rows = MulticlassClassificationEvaluator(metricName="accuracy"), []
    for fold in range(folds):
        fit, test = dealt.where(F.col("fold") != fold), dealt.where(F.col("fold") == fold)
        prepared = Pipeline(stages=stages(label, list(features), list(standard), list(min_max), list(one_hot))).fit(fit)
        seen, unseen = prepared.transform(fit).persist(), prepared.transform(test).persist()
        rows += [(name, fold, float(score.evaluate(model.fit(seen).transform(unseen)))) for name, model in models.items()]
        seen.unpersist()
        unseen.unpersist()
    dealt.unpersist()
    return df.sparkSession.createDataFrame(rows, "classifier string, fold int, accuracy double")
