"""Words of texts, their weights, and the dependencies that source texts name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataloom.functions.exprs import file_extension

#: How each language names what a file depends on; the first group is the name.
IMPORTS = {
    "java": r"(?m)^\s*import\s+(?:static\s+)?([\w.]+(?:\.\*)?)\s*;",
    "python": r"(?m)^import[ \t]+([A-Za-z_][\w.]*(?:[ \t]*,[ \t]*[A-Za-z_][\w.]*)*)(?:[ \t]+as[ \t]+\w+)?[ \t]*$",
    "python_from": r"(?m)^from[ \t,]+([\w.]+)[ \t,]+import[ \t]+([\w., \t]+?)(?:[ \t]+as[ \t]+\w+)?[ \t]*(?://[^\n]*)?$",
    "javascript": r"""(?m)^[ \t]*import\b[^'"\n]*['"]([^'"\n]+)['"]""",
    "javascript_require": r"""\brequire\s*\(\s*['"]([^'"\n]+)['"]\s*\)""",
    "scala": r"(?m)^\s*import[ \t]+([^\s{;]+)[^;\n]*$",
    "c": r"""(?m)^[ \t]*#[ \t]*include[ \t]*[<"]([^>"\n]+)[>"]""",
    "rust": r"(?m)^[ \t]*(?:pub[ \t]+)?use[ \t]+(?:::)?((?:std|core|alloc|[a-z_]\w*)(?:::\w+)*)",
    "go": r"""(?m)^[ \t]*import[ \t]+(?:[\w.]+[ \t]+)?"([^"\n]+)\"""",
}
GO_GROUP = r"(?s)\bimport\s*\(([^)]*)\)"


def imports(text: Column, language: str) -> Column:
    """Names that a source text imports, in order, as an array; Go's grouped imports are read too, and members that Python
    imports from a module come out as module.member, without their new names."""
    found = F.regexp_extract_all(text, F.lit(IMPORTS[language]), F.lit(1))
    if language == "python_from":
        members = F.regexp_extract_all(text, F.lit(IMPORTS[language]), F.lit(2))
        named = F.zip_with(found, members, lambda module, names: F.transform(F.split(names, ","), lambda m: F.concat(module, F.lit("."), F.regexp_replace(F.trim(m), r"[ \t]+as[ \t].*$", ""))))
        return F.flatten(named)
    if language != "go":
        return found
    groups = F.array_join(F.regexp_extract_all(text, F.lit(GO_GROUP), F.lit(1)), "\n")
    return F.concat(found, F.regexp_extract_all(groups, F.lit('"([^"\\n]+)"'), F.lit(1)))


def import_counts(docs: DataFrame, languages: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How many documents name a dependency in a language's way."""
    per = F.array(*[F.struct(F.lit(x).alias("language"), F.array_distinct(imports(F.col(text_col), x)).alias("names")) for x in languages])
    rows = docs.select(id_col, F.explode(per).alias("p")).select(id_col, "p.language", F.explode("p.names").alias("dependency")).distinct()
    return rows.groupBy("language", "dependency").agg(F.count("*").alias("n_docs"))


def words(docs: DataFrame, group: str, text_col: str = "text") -> DataFrame:
    """Words of each group: pieces between spaces cut to their leading letters and hyphens, empty ones dropped."""
    pieces = docs.select(group, F.explode(F.split(text_col, " ")).alias("piece"))
    return pieces.select(group, F.regexp_extract("piece", r"^([a-zA-Z\-]*)", 1).alias("word")).where("word <> ''")


def word_counts(docs: DataFrame, group: str, text_col: str = "text") -> DataFrame:
    return words(docs, group, text_col).groupBy(group, "word").agg(F.count("*").alias("n"))


def tfidf(counts: DataFrame, group: str, term: str, n: str, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """Weights (1 + ln tf) * (ln((1 + N) / (1 + df)) + 1), scaled to length 1 per group, of the terms that at least
    ``min_df`` groups and at most the share ``max_df`` of them have."""
    total = counts.agg(F.countDistinct(group)).scalar()
    df = counts.groupBy(term).agg(F.countDistinct(group).alias("df")).where((F.col("df") >= min_df) & (F.col("df") <= max_df * total))
    weight = (1 + F.log(n)) * (F.log((1 + total) / (1 + F.col("df"))) + 1)
    rows = counts.join(df, term).select(group, term, weight.alias("_weight"))
    norm = rows.groupBy(group).agg(F.sqrt(F.sum(F.col("_weight") * F.col("_weight"))).alias("norm"))
    return rows.join(norm, group).select(group, term, F.round(F.col("_weight") / F.col("norm"), 6).alias("tfidf"))


def top_terms(weights: DataFrame, group: str, term: str, k: int, above: float) -> DataFrame:
    """The k heaviest terms of each group above a weight, ties by term; a top-k report."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("tfidf"), term))
    return weights.where(F.col("tfidf") > above).withColumn("rank", rank).where(F.col("rank") <= k)


#: The suffixes of the languages whose imports can be read.
LANGUAGE_OF = {
    ".java": ["java"], ".py": ["python", "python_from"], ".js": ["javascript", "javascript_require"], ".jsx": ["javascript", "javascript_require"], ".ts": ["javascript", "javascript_require"],
    ".tsx": ["javascript", "javascript_require"], ".go": ["go"], ".scala": ["scala"], ".c": ["c"], ".h": ["c"], ".cc": ["c"], ".cpp": ["c"], ".rs": ["rust"],
}


def file_imports(files: DataFrame, path_col: str = "file_path", text_col: str = "text") -> DataFrame:
    """``files`` with ``dependencies``, read by the analyzer of each path's suffix in lower case; an empty array where there
    is none, null where the text is."""
    suffix = F.lower(file_extension(path_col))
    read = F.when(F.col(text_col).isNull(), F.lit(None))
    for language in IMPORTS:
        suffixes = [s for s, languages in LANGUAGE_OF.items() if languages[0] == language]
        if suffixes:
            read = read.when(suffix.isin(suffixes), F.concat(*[imports(F.col(text_col), x) for x in LANGUAGE_OF[suffixes[0]]]))
    return files.withColumn("dependencies", read.otherwise(F.array().cast("array<string>")))


def bayes_confusion(docs: DataFrame, features: int = 1 << 16, test_share: float = 0.33, seed: int = 0) -> DataFrame:
    """Held-out confusion (label, prediction, n) of a multinomial naive Bayes over hashed TF-IDF words of labelled texts."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer

    index = StringIndexer(inputCol="label", outputCol="label_no").fit(docs)
    train, test = index.transform(docs).randomSplit([1 - test_share, test_share], seed)
    steps = [RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[^\p{L}\p{N}]+"), HashingTF(inputCol="words", outputCol="counts", numFeatures=features), IDF(inputCol="counts", outputCol="features"), NaiveBayes(labelCol="label_no")]
    found = Pipeline(stages=steps).fit(train).transform(test)
    named = IndexToString(inputCol="prediction", outputCol="told", labels=index.labels).transform(found)
    return named.groupBy("label", F.col("told").alias("prediction")).agg(F.count("*").alias("n"))
