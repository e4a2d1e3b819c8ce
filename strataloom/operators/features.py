"""Features of commits by file type, their statistics, clusters and classifiers."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.functions.exprs import percent


def type_rows(log: DataFrame) -> DataFrame:
    """One row per commit and normalised file type: log_id, type, inserts, deletes, occurrences; nulls are 0."""
    rows = log.dropDuplicates(["log_id"]).select("log_id", F.explode("filetypes").alias("type", "v"))
    type_ = F.regexp_replace(F.lower("type"), "^[.]", "")
    return rows.groupBy("log_id", type_.alias("type")).agg(*[F.sum(F.coalesce(f"v.{c}", F.lit(0))).alias(c) for c in ("inserts", "deletes", "occurrences")])


def type_popularity(rows: DataFrame) -> DataFrame:
    return rows.groupBy("type").agg(F.count("*").alias("n_commits"), F.sum("inserts").alias("inserts"), F.sum("occurrences").alias("occurrences"))


def main_types(rows: DataFrame, per_thousand: int) -> DataFrame:
    """Types in more than so many of a thousand commits."""
    total = rows.agg(F.countDistinct("log_id")).scalar()
    return type_popularity(rows).where(F.col("n_commits") * 1000 > total * per_thousand).select("type", "n_commits")


def type_matrix(rows: DataFrame, types: list[str]) -> DataFrame:
    """Commits by types, the inserts of each, 0 if absent."""
    return rows.groupBy("log_id").pivot("type", types).agg(F.sum("inserts")).na.fill(0, types)


def type_correlations(matrix: DataFrame, types: list[str], above: float) -> DataFrame:
    """Pairs of types whose inserts correlate by more than ``above``; one aggregation for all pairs."""
    pairs = list(combinations(sorted(types), 2))
    wide = matrix.agg(*[F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("left_type"), F.lit(b).alias("right_type"), F.round(f"c{i}", 6).alias("correlation")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(rows)).where(F.col("correlation") > above)


def main_type_inserts(rows: DataFrame, per_thousand: int) -> DataFrame:
    """log_id, type, inserts of the types in more than so many of a thousand commits; a type that is absent is 0."""
    return rows.join(main_types(rows, per_thousand).select("type"), "type").select("log_id", "type", "inserts")


def all_type_correlations(rows: DataFrame, per_thousand: int, above: float) -> DataFrame:
    """``type_correlations`` of every pair of main types, from sums in long form over all commits."""
    total = rows.agg(F.countDistinct("log_id")).scalar().cast("double")
    main = main_type_inserts(rows, per_thousand).withColumn("v", F.col("inserts").cast("double"))
    each = main.groupBy("type").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("ss"))
    left, right = (main.select("log_id", F.col("type").alias(f"{x}_type"), F.col("v").alias(x)) for x in ("left", "right"))
    both = left.join(right, "log_id").where("left_type < right_type").groupBy("left_type", "right_type").agg(F.sum(F.col("left") * F.col("right")).alias("p"))
    # a pair that never meets can't correlate positively, as inserts aren't negative
    pairs = both.join(each.select(F.col("type").alias("left_type"), F.col("s").alias("ls"), F.col("ss").alias("lss")), "left_type").join(each.select(F.col("type").alias("right_type"), F.col("s").alias("rs"), F.col("ss").alias("rss")), "right_type")
    pairs = pairs.withColumn("n", total)
    corr = F.expr("try_divide(n * p - ls * rs, sqrt(n * lss - ls * ls) * sqrt(n * rss - rs * rs))")
    return pairs.select("left_type", "right_type", F.round(corr, 6).alias("correlation")).where(F.col("correlation") > above)


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal bins between the least and the greatest value; the last bin is closed."""
    low, high = rows.agg(F.min(value)).scalar(), rows.agg(F.max(value)).scalar()
    at = F.when(high == low, F.lit(0)).otherwise(F.least(F.floor((F.col(value) - low) * bins / (high - low)), F.lit(bins - 1)))
    return rows.where(F.col(value).isNotNull()).select(at.cast("int").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


def commit_features(rows: DataFrame, actions: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Per commit: files in all, text and binary, text lines, and for each action (encoding, types) its files and their
    share, of a text action its lines and their share too.

    A type is text if lines were inserted or deleted; lines are the inserted ones.
    """
    text = (F.col("inserts") > 0) | (F.col("deletes") > 0)
    files, lines = F.col("occurrences"), F.when(text, F.col("inserts")).otherwise(0)
    sums = [F.sum(files).alias("total_files"), F.sum(F.when(text, files).otherwise(0)).alias("text_files"), F.sum(F.when(~text, files).otherwise(0)).alias("bin_files"), F.sum(lines).alias("text_lines")]
    shares = {}
    for name, (encoding, types) in actions.items():
        own = F.col("type").isin(types)
        for unit, value, whole in (("file", files, "total_files"), ("line", lines, "text_lines"))[: 2 if encoding == "text" else 1]:
            sums.append(F.sum(F.when(own, value).otherwise(0)).alias(f"{name}_{unit}s"))
            shares[f"{name}_{unit}_pct"] = percent(F.col(f"`{name}_{unit}s`"), F.col(whole))
    return rows.groupBy("log_id").agg(*sums).withColumns(shares)


def log_vectors(features: DataFrame, columns: list[str], id_col: str = "log_id") -> DataFrame:
    """id and the vector of log1p of the columns."""
    return features.select(id_col, array_to_vector(F.array(*[F.log1p(F.col(c).cast("double")) for c in columns])).alias("features"))


def label_histories(rows: DataFrame, who: str, label: str) -> DataFrame:
    """Labels of each author with counts, most frequent first, and the total."""
    per = rows.groupBy(who, label).agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(label).alias("label"), F.col("n").alias("n"))))
    return per.groupBy(who).agg(F.sum("n").alias("total"), F.transform(ordered, lambda x: F.struct(x["label"].alias("label"), x["n"].alias("n"))).alias("history"))


def clusters(vectors: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """Input with the k-means cluster of each vector."""
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vectors).transform(vectors)


def cluster_medians(clustered: DataFrame, values: list[str]) -> DataFrame:
    """Members and rounded medians (half to even) of each cluster."""
    return clustered.groupBy("cluster").agg(F.count("*").alias("n"), *[F.bround(F.percentile(v, 0.5)).cast("bigint").alias(v) for v in values])


def sample_per_group(rows: DataFrame, group: str, n: int, seed: int) -> DataFrame:
    """A seeded sample of n rows of each group without replacement: the n smallest of a random number per row."""
    from pyspark.sql.window import Window

    numbered = rows.withColumn("_draw", F.rand(seed))
    return numbered.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy("_draw"))).where(F.col("_k") <= n).drop("_draw", "_k")


def classified(rows: DataFrame, label: str = "label", test_share: float = 0.33, seed: int = 0, layers: list[int] | None = None) -> DataFrame:
    """Held-out rows with the prediction of a multinomial logistic regression, or of a perceptron with ``layers``."""
    train, test = rows.randomSplit([1 - test_share, test_share], seed)
    if layers:
        model = MultilayerPerceptronClassifier(layers=layers, labelCol=label, seed=seed, maxIter=60)
    else:
        model = LogisticRegression(labelCol=label, maxIter=60)
    return model.fit(train).transform(test)


def confusion(predicted: DataFrame, label: str = "label") -> DataFrame:
    return predicted.groupBy(F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")).agg(F.count("*").alias("n"))


def scores(predicted: DataFrame, id_col: str, label: str = "label") -> DataFrame:
    return predicted.select(id_col, F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), F.array_max(vector_to_array("probability")).alias("score"))


def shares(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the share of ``value`` in its sum over the keys."""
    from pyspark.sql.window import Window

    return rows.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy(*keys)))


def training_rows(features: DataFrame, labels: DataFrame, columns: list[str], on: str = "commit_id") -> DataFrame:
    """Labelled vectors: the log1p vectors of the features of each labelled row; labels without features are left out."""
    return labels.select(on, "label").join(log_vectors(features, columns, on), on)


def cross_validated(rows: DataFrame, regularisations: list[float], label: str = "label", folds: int = 5, seed: int = 0) -> DataFrame:
    """Mean accuracy of a logistic regression over so many folds, per regularisation."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    model = LogisticRegression(labelCol=label, maxIter=30)
    grid = ParamGridBuilder().addGrid(model.regParam, regularisations).build()
    fitted = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"), numFolds=folds, seed=seed).fit(rows)
    return rows.sparkSession.createDataFrame([(float(r), float(a)) for r, a in zip(regularisations, fitted.avgMetrics)], "regularisation double, accuracy double")


def saved(model, path: str):
    """Writes a fitted model and reads it again, whatever its class."""
    model.write().overwrite().save(path)
    return type(model).load(path)


def author_histories(vectors: DataFrame, models: dict, who: str = "author") -> DataFrame:
    """Labels that each model (name -> fitted model) gives an author's rows, with counts, most frequent first: model, who,
    total, history."""
    parts = [label_histories(model.transform(vectors).select(who, F.col("prediction").cast("int").alias("label")), who, "label").withColumn("model", F.lit(name)) for name, model in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
