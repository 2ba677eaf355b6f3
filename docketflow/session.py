"""Session settings and the shared working folder."""

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name="docketflow", master=None, initial_partitions=None, **conf):
    """A session with adaptive execution, skew handling and UTC dates switched on.

    Adaptive execution merges shuffle partitions but never adds any, so start high:
    `initial_partitions` near the largest shuffle in bytes over 128 MB, 20,000 or so
    where pages of 2-3 TB are shuffled. Small jobs merge them again. Other settings are
    keywords with `__` for dots.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "snappy",
    }
    if initial_partitions:
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        settings[key] = str(initial_partitions)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root = None


def work_path(spark, label):
    """A new, unique folder for intermediate tables.

    It lies under the shared folder the cluster names in `spark.checkpoint.dir`.
    Only where that is unset, as in local tests, is a temporary folder made.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _local_root = _local_root or tempfile.mkdtemp(prefix="docketflow-")
        root = _local_root
    return f"{root.rstrip('/')}/docketflow/{label}-{uuid.uuid4().hex}"


def staged(df, label):
    """`df` written once to the shared working folder and read again.

    What is computed from it reads files instead of computing again, also after an
    executor is lost, and a join sees a plain scan, whose skew Spark can split.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables, part=""):
    """Remove what `staged` has written, or only its folder `part`, once nothing reads it any more."""
    for df in tables:
        for file in sorted({name.rsplit("/", 1)[0] + "/x" for name in df.inputFiles()}):
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if "/docketflow/" in folder.toString() and part in ("", folder.getName()):
                folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def settings(spark, **conf):
    """Settings of the session that hold for a while; `__` stands for dots."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def dropping_shuffles(spark):
    """While this holds, a job's shuffle files go when it ends: what it has written is read instead."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")
