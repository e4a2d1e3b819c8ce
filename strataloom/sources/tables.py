"""Readers and writers of delimited, JSON and nested files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions.exprs import file_extension


def contracts(spark: SparkSession, path: str, columns: dict[str, str], dates: list[str], date_format: str = "yyyy-MM-dd", key: str = "description") -> DataFrame:
    """CSV with a header: the columns wanted (new name -> header), dates parsed (null if they can't be), and the md5 of
    ``key`` as an identity."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"').select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])
    for name in dates:
        rows = rows.withColumn(name, F.try_to_timestamp(name, F.lit(date_format)))
    return rows.withColumn("key_md5", F.md5(key))


def labels(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated labels: commit_id, label, cluster; further columns are ignored."""
    return spark.read.csv(path, sep="\t", header=True).select("commit_id", "label", F.col("cluster").cast("int").alias("cluster"))


def label_template(rows: DataFrame, path: str) -> None:
    """Writes rows to be labelled, with an empty label column after the commit."""
    rest = [c for c in rows.columns if c != "commit_id"]
    rows.select("commit_id", F.lit("").alias("label"), *rest).write.mode("overwrite").csv(path, sep="\t", header=True)


def name_value_stats(lines: DataFrame, names: list[str], source: str = "source", column: str = "value") -> DataFrame:
    """``name value`` lines of each source -> one row with the named integers, null where absent."""
    part = F.split(F.trim(F.col(column)), r"\s+")
    pairs = lines.where(F.size(part) == 2).select(source, part[0].alias("name"), F.try_to_number(part[1], F.lit("999999999999999999")).cast("bigint").alias("n"))
    return pairs.groupBy(source).pivot("name", names).agg(F.max("n"))


def verses(lines: DataFrame, column: str = "value") -> DataFrame:
    """``Book ch:v<tab>text`` lines: book, chapter, verse, text; other lines are left out."""
    pattern = r"^(.+?)\s+(\d+):(\d+)\t(.*)$"
    rows = lines.where(F.col(column).rlike(pattern))
    return rows.select(F.regexp_extract(column, pattern, 1).alias("book"), F.regexp_extract(column, pattern, 2).cast("int").alias("chapter"), F.regexp_extract(column, pattern, 3).cast("int").alias("verse"), F.regexp_extract(column, pattern, 4).alias("text"))


#: Schema of the repository documents that are read.
REPO_INFO = """id bigint, name string, owner struct<login:string,id:bigint,type:string>, description string, size bigint, stargazers_count int, watchers_count int,
forks_count int, open_issues_count int, language string, has_issues boolean, created_at string, updated_at string, pushed_at string,
license struct<key:string,name:string,spdx_id:string,url:string>"""


def repo_info(documents: DataFrame, column: str = "value") -> DataFrame:
    """Repository JSON -> typed flat rows; owner and licence may be missing, a document of another shape gives nulls and
    is left out if it has no name."""
    rows = documents.select(F.from_json(column, REPO_INFO).alias("r")).where("r.name is not null")
    plain = ["size", "stargazers_count", "watchers_count", "forks_count", "open_issues_count", "language", "has_issues", "description"]
    return rows.select(
        F.col("r.id").alias("repo_id"), F.col("r.owner.login").alias("owner"), F.col("r.name").alias("repo_name"), F.col("r.owner.id").alias("owner_id"), F.col("r.owner.type").alias("owner_type"),
        *[F.col(f"r.{c}") for c in plain],
        *[F.try_to_timestamp(F.col(f"r.{c}")).alias(c) for c in ("created_at", "updated_at", "pushed_at")],
        *[F.col(f"r.license.{c}").alias(f"license_{c}") for c in ("key", "name", "spdx_id", "url")],
    )


def json_lines(df: DataFrame, path: str, codec: str = "bzip2") -> None:
    df.write.mode("overwrite").json(path, compression=codec)


def is_binary(content: Column | str) -> Column:
    """Whether the first 1024 bytes hold a control character other than tab, line feed or carriage return."""
    head = F.decode(F.substring(content, 1, 1024), "ISO-8859-1")
    return head.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def file_stats(files: DataFrame, suffixes: dict[str, list[str]]) -> DataFrame:
    """One row over ``binaryFile`` rows (path, length, content): files, lines, binary files and bytes, and the files and
    lines of each named group of suffixes."""
    binary = is_binary("content")
    lines = F.when(binary, 0).otherwise(F.length(F.decode("content", "ISO-8859-1")) - F.length(F.replace(F.decode("content", "ISO-8859-1"), F.lit("\n"), F.lit(""))))
    rows = files.select(file_extension("path").alias("ext"), "length", binary.alias("b"), lines.alias("lines"))
    out = [F.count("*").alias("num_files"), F.sum("lines").alias("num_locs"), F.count_if("b").alias("num_binary_files"), F.coalesce(F.sum(F.when(F.col("b"), F.col("length"))), F.lit(0)).alias("num_binary_bytes")]
    for name, exts in suffixes.items():
        own = F.col("ext").isin(exts) & ~F.col("b")
        out += [F.count_if(own).alias(f"num_{name}_files"), F.coalesce(F.sum(F.when(own, F.col("lines"))), F.lit(0)).alias(f"num_{name}_locs")]
    return rows.agg(*out)


def catalog_view(spark: SparkSession, database: str, name: str, view: str) -> DataFrame:
    """A table of the session's catalog, under the name of a view."""
    df = spark.table(f"`{database}`.`{name}`")
    df.createOrReplaceTempView(view)
    return df


def jdbc_table(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A table of a relational database, read by ranges of an integer key in so many tasks. Rows outside of the bounds are
    read by the outer tasks; the driver's class, user and the like are options."""
    return spark.read.jdbc(url, name, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=options)


def jdbc_insert(df: DataFrame, url: str, name: str, batch: int = 100, **options: str) -> None:
    """Inserts rows into a table of a relational database, so many a statement."""
    df.write.jdbc(url, name, mode="append", properties={"batchsize": str(batch)} | options)
