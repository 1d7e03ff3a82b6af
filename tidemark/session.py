"""Session defaults and the shared scratch folder."""
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app="tidemark", master=None, shuffle_partitions=None, memory="8g") -> SparkSession:
    """A session for tests and benchmarks. On a cluster the deployment's own settings win: only the
    adaptive features that the operators count on are stated here."""
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
         .config("spark.ui.enabled", "false"))
    if master:
        # small local files: let a few megabytes still fill every core
        b = (b.master(master).config("spark.driver.memory", memory).config("spark.sql.files.openCostInBytes", "262144")
             .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


_LOCAL_ROOT = []


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this machine; a cluster
    session without it is refused, because executors could not see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if not _LOCAL_ROOT:
            _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="tidemark-"))
        root = _LOCAL_ROOT[0]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A setting of the session for the queries that start inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def freed(spark: SparkSession):
    """Queries inside drop their shuffle files as they end, not when the driver happens to collect its garbage. Spark before 4.1
    does not know the setting and goes on as it did."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage with a table that survives lost executors, and frees the disk that
    the way to it took."""
    path = scratch_folder(df.sparkSession, label)
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unmeasured(side: DataFrame) -> DataFrame:
    """``side`` marked for a sort-merge join. What Spark assumes of a join side's size is what its files take; behind an explode, or
    where columns pack well, the rows are many times that, and a broadcast chosen by it passes through the driver whole."""
    return side.hint("merge")


def table_path(folder: str, name: str) -> str:
    return os.path.join(folder, f"{name}.parquet")
