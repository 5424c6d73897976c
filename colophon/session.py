"""Session settings and the shared scratch folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Settings every job of this package wants; a cluster may override any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even if that costs the plan one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lists of up to so many keys reach the statistics and bloom filters of Parquet files.
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
}


def get_session(app_name: str = "colophon", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or get) a session with the package's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or where that is not set a folder
    in the warehouse, which a cluster shares as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def read_line(spark: SparkSession, path: str) -> str:
    """The only line of a small file."""
    files, where = _file_system(spark, path)
    stream = files.open(where)
    try:
        return stream.readLine()
    finally:
        stream.close()


def replace_line(spark: SparkSession, path: str, line: str) -> None:
    """Make a file hold one line, in one step: readers see the old line or the new one."""
    fresh = f"{path}.{uuid.uuid4().hex}"
    files, where = _file_system(spark, fresh)
    stream = files.create(where)
    stream.writeBytes(f"{line}\n")
    stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(where), files.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)


def remove_before(spark: SparkSession, folder: str, name: str, kept: set[str]) -> None:
    """Delete the folders below a folder whose names come before ``name``, but for those that are kept."""
    files, where = _file_system(spark, folder)
    for entry in files.listStatus(where):
        own = entry.getPath().getName()
        if own < name and own not in kept:
            files.delete(entry.getPath(), True)


# The folders that are not removed yet, and their sessions.
_paths: dict[str, SparkSession] = {}


def close_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of a session. Results that still read them must be written."""
    for path in [p for p, owner in _paths.items() if owner is spark]:
        files, where = _file_system(spark, path)
        files.delete(where, True)
        del _paths[path]


class Scratch:
    """A unique folder below the shared one that holds the intermediate tables of one job.

    Writing a table cuts the lineage, survives lost executors, and gives the next plan real
    sizes to choose joins by. A long-lived driver calls ``close_scratch`` once the results of
    its jobs are written; the folder goes with the driver's JVM in any case. Tables that are
    no longer needed can be dropped earlier.
    """

    def __init__(self, spark: SparkSession, purpose: str = "job"):
        self.spark = spark
        self.rows: dict[str, int] = {}
        self.path = f"{shared_folder(spark)}/colophon-{purpose}-{uuid.uuid4().hex}"
        files, where = _file_system(spark, self.path)
        files.mkdirs(where)
        files.deleteOnExit(where)
        _paths[self.path] = spark

    def close(self) -> None:
        """Remove the folder."""
        files, where = _file_system(self.spark, self.path)
        files.delete(where, True)
        _paths.pop(self.path, None)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return a scan of what was written. Its number of rows,
        counted while writing, is then in ``rows[name]``."""
        where = f"{self.path}/{name}"
        schema = df.schema
        written = Observation()
        df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(where)
        self.rows[name] = written.get["rows"]
        return self.spark.read.schema(schema).parquet(where)

    def drop(self, name: str) -> None:
        files, where = _file_system(self.spark, f"{self.path}/{name}")
        files.delete(where, True)
