"""Session settings the operators are written for, and the one way they cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings worth carrying over to a cluster submit.  Nothing in the package depends on them for
# right results, apart from the UTC session zone.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys are split at run time, also where that costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sedimart") -> SparkSession:
    """A session for tests and the bench; on a cluster bring your own and use ``RECOMMENDED``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Rows that one task takes of a table dealt out by its size.
ROWS_A_TASK = 500_000


def deal(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys``, to more tasks the more rows it has, so that none grows with the table.

    ``rows`` tells about how many there are. Where the session's own tasks are enough, Spark may merge small ones.
    """
    spark = df.sparkSession
    parts = -(-rows // ROWS_A_TASK)
    own = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *keys) if parts > own else df.repartition(*keys)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: what the session names in ``spark.checkpoint.dir``.

    Only a session whose executors run inside the driver may go without; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "").partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sedimart-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Spark's setting for dropping a job's shuffle files as the job ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders of the scopes that are open, the innermost last.
_scopes: list[str] = []


@contextmanager
def stages_that_go(spark: SparkSession) -> Iterator[str]:
    """Stages written inside go when the block ends: write or collect what depends on them before that.

    They lie in one folder under the shared one, whose path the block gets.  Blocks may be nested.
    """
    folder = f"{shared_folder(spark)}/scope-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str = "stage", split_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Later jobs read the files with column pruning and survive the loss of executors.  With
    ``split_by``, each value of that column has a folder of its own, which readers of one value keep to.
    """
    folder = _scopes[-1] if _scopes else shared_folder(df.sparkSession)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    with _shuffles_that_go(df.sparkSession):
        (writer.partitionBy(split_by) if split_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_that_go(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffles of a job that runs inside as it ends, not when the driver next collects garbage.

    Nothing reads them again: what follows a stage reads its files.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def materialize(df: DataFrame) -> DataFrame:
    """``stage`` for what a mart computes once and reads more than once."""
    return stage(df, "materialized")
