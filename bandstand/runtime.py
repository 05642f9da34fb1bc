"""Session, shared scratch space and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(app: str = "bandstand", cores: str = "*", **extra: str) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: what the session names, else one of our own.

    The machine-local folder is only for a local master; elsewhere the fallback lies beside the
    warehouse, which every executor can reach.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    own = spark.conf.get("spark.bandstand.sharedDir", None)
    if own is None:
        if spark.sparkContext.master.startswith("local"):
            own = tempfile.mkdtemp(prefix="bandstand-")
        else:
            own = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_bandstand"
        spark.conf.set("spark.bandstand.sharedDir", own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at)
    return path


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def folder_names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders in ``path`` that begin with ``prefix``; none where the path does not exist."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory() and s.getPath().getName().startswith(prefix))


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a file that readers do not skip."""
    fs, at = _file_system(spark, path)
    return any(s.isFile() and s.getLen() > 0 and not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(at))


class Scratch:
    """Tables written to the shared folder between the steps of a job.

    A written table cuts the lineage, survives lost executors and tells the optimizer its size.
    """

    def __init__(self, spark: SparkSession, name: str):
        self._spark, self._name, self._paths = spark, name, {}

    def write(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self._spark, self._name)
        df.write.parquet(path)
        out = self._spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables written here; nothing may read them any more."""
        for table in tables:
            if id(table) in self._paths:
                remove_path(self._spark, self._paths.pop(id(table))[1])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows live in shared storage, so a lost executor costs nothing."""
    spark = df.sparkSession
    ensure_checkpoints(spark)
    return df.checkpoint()


def ensure_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
