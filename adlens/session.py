"""SparkSession settings and the shared work folder.

On a cluster the folder for written intermediate tables and stream
checkpoints is the one the cluster names in ``spark.checkpoint.dir``; it
must be shared storage. Only when that setting is absent and the master is
local (tests) does ``work_dir`` pick a fresh local folder and set it; on any
other master a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library's plans are written for. AQE re-plans joins and
# coalesces or splits shuffle partitions at run time; the skew-join settings
# let it split a hot partition of a sort-merge join.
SPARK_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small exchanges still use all cores; large ones go by the advisory size
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    # tables kept by month have many small folders: list them on the driver, not by a job for each read
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1024",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "adlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SPARK_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (set here if unset)."""
    sc = spark.sparkContext
    d = (sc.getConf().get("spark.checkpoint.dir", None)
         or spark.conf.get("spark.checkpoint.dir", None)
         or sc.getCheckpointDir())
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="adlens-work-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder of the shared work folder."""
    base = work_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked through the cluster's file system."""
    try:
        jvm = spark.sparkContext._jvm
        hconf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM handle (e.g. Spark Connect)
        try:
            spark.read.format("parquet").load(path).schema  # noqa: B018
            return True
        except Exception:  # noqa: BLE001
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(hconf).exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, in order, asked through the cluster's file system; [] if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not exist yet; it is there as a whole or not at all."""
    jvm, (p, fs) = spark.sparkContext._jvm, _fs(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(beside), fs.makeQualified(p), options)
    except Exception:
        fs.delete(beside, False)
        raise


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time, by which a file stream takes its files."""
    p, fs = _fs(spark, path)
    fs.setTimes(p, millis, -1)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


__all__ = ["SPARK_CONF", "build_session", "work_dir", "fresh_dir", "exists", "list_names", "read_text", "write_new", "delete", "set_time", "local_path"]
