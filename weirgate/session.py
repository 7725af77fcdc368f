"""Session helpers: defaults for local runs and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Whether an execution deletes its shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weirgate")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. A cluster session
    without it is refused, because executors could not read one machine's folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    root = sc.getCheckpointDir()
    if root is None:
        if not configured:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            configured = tempfile.mkdtemp(prefix="weirgate-")
        sc.setCheckpointDir(configured)
        root = sc.getCheckpointDir()
    return configured or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for tables a job writes and reads back."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts the lineage, survives lost executors, and the result has no Python work left
    in its plan, so reading it twice does not compute it twice. The shuffle files of the write
    go with its end; else they would stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, *keys: str, placed: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder, bucketed and sorted by ``keys``, and read it back.

    Joins on them shuffle the other side only, in every job that reads the table. With
    ``placed``, ``df`` already has the buckets' partitioning and is not shuffled for it. The
    table is external: dropping its name leaves the files.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"weirgate_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(n, *keys)
    rows.sortWithinPartitions(*keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", scratch_path(spark, "buckets")).saveAsTable(name)
    return spark.table(name)


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`materialise` that no later step reads."""
    spark = df.sparkSession
    root = f"{checkpoint_root(spark).rstrip('/')}/"
    plain = lambda path: path.split(":", 1)[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if plain(folder).startswith(f"{plain(root)}table-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
