"""Intermediate tables in the folder every executor can reach.

Lineage is cut by writing a parquet table under ``spark.checkpoint.dir`` and
reading it back, so lost executors cost nothing but a re-read, and the table's
size is known to Catalyst and to :mod:`textweft.lookup`. What was shuffled for a written
table goes once it is written, and a step that made a table for itself releases it.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="textweft-")
    return _own_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/textweft/{app}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files behind."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def is_written(df: DataFrame) -> bool:
    """Whether ``df`` is a table as :func:`materialize` gave it."""
    return getattr(df, "_written", None) is not None


def release(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more; others are left alone."""
    for table in filter(is_written, tables):
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._written)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        table._written = None


def spread_groups(df: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Partition by ``keys`` for work that is heavy per group though its rows are few.

    The number of partitions is fixed, as adaptive coalescing would put the groups of a
    small table into one task.
    """
    spark = df.sparkSession
    most = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(min(groups, most), *keys)
