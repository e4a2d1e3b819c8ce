"""Session settings, table access and lineage cuts shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings that the operators count on: UTC, AQE, skew joins and Arrow."""
    builder = SparkSession.builder.master(master).appName("strataloom")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; the schema comes from the Parquet footers, filters and columns reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables: below spark.checkpoint.dir, or a temporary one in local mode.
    It is removed when the application's JVM ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="strataloom-")
        _LOCAL[spark.sparkContext.applicationId] = shared
    folder = f"{shared.rstrip('/')}/strataloom-{spark.sparkContext.applicationId}"
    if folder not in _KNOWN:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _KNOWN.add(folder)
    return folder


_LOCAL: dict[str, str] = {}
_KNOWN: set[str] = set()


def checkpointed(df: DataFrame, replaces: Sequence[DataFrame] = ()) -> DataFrame:
    """Cuts lineage by a table written to the shared folder, so that lost executors cost no recomputation and what is
    read several times is computed once.

    A table and not ``checkpoint()``: that keeps the estimated size of the plan, which joins multiply round by round
    until the number itself is too long to compute with, while a table has the size of its files, and joins with small
    ones are planned as such. Columns need distinct names. Tables of this kind that the new one ``replaces``, so that
    nothing reads them any more, are removed once it is written.
    """
    path = f"{_shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _TABLES[out] = path
    jvm = df.sparkSession.sparkContext._jvm
    for old in replaces:
        if (folder := _TABLES.pop(old, None)) is not None:
            gone = jvm.org.apache.hadoop.fs.Path(folder)
            gone.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    return out


#: Folders of the tables that are still referred to.
_TABLES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def parallelism(spark: SparkSession) -> int:
    """Number of reduce partitions to aim at: the configured shuffle width, at least the number of cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """Rows for costly per-row work: dealt out anew if the scan has fewer partitions than there are tasks to run, so that
    a small table of heavy rows doesn't run on a core or two. A large scan has enough splits and isn't shuffled."""
    wanted = parallelism(df.sparkSession)
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(2 * wanted)


def tokenizer_dir(path: str | None = None) -> str:
    """Folder of the public tokenizer files: the parameter, $STRATALOOM_TOKENIZERS or /opt/tokenizers."""
    return path or os.environ.get("STRATALOOM_TOKENIZERS", "/opt/tokenizers")
