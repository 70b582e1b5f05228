"""Session construction and the shared scratch location."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC wall clock (all stored times are
# timestamp_ntz in UTC), AQE for runtime coalescing and skew splits.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "strata", shuffle_partitions: int = 8, **extra) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        builder = builder.config(k.replace("_", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share for intermediate data: the
    one set with ``setCheckpointDir``, else the one named in
    ``spark.checkpoint.dir``. Without either this is an error: a folder of
    the driver's machine would be out of reach for executors elsewhere."""
    set_dir = spark.sparkContext.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir is None and not named:
        raise RuntimeError(
            "No shared folder for intermediate data: start the session with spark.checkpoint.dir, "
            "or call spark.sparkContext.setCheckpointDir(<folder all executors reach>)."
        )
    if set_dir is None:
        spark.sparkContext.setCheckpointDir(named)
    return named or set_dir


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder of this application under the shared location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API, by the path's own scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to its final name, replacing what an earlier attempt left there."""
    fs, src = hadoop_path(spark, source)
    _, dst = hadoop_path(spark, target)
    fs.mkdirs(dst.getParent())
    fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"{source} could not be moved to {target}")
