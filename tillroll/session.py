"""Session settings the results depend on, and where shared data may be written."""

from __future__ import annotations

import pathlib
import posixpath
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

_CODE = "code"
_local_dir: tempfile.TemporaryDirectory | None = None
_databases: dict[str, list[str]] = {}
_shipped: set[str] = set()


def build_session(app_name: str = "tillroll", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Create (or get) a session; ``conf`` wins over the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer takes ``df`` for small enough to be sent to every executor, by its own estimate and limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return 0 <= int(str(size)) <= limit


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.TemporaryDirectory(prefix="tillroll-")
    return _local_dir.name


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared root that no other run uses. It is not created."""
    return posixpath.join(_own_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def _own_root(spark: SparkSession) -> str:
    return posixpath.join(shared_root(spark), "tillroll", spark.sparkContext.applicationId)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared root and read it back.

    What builds on it neither computes ``df`` again nor depends on the executors
    that did. The data stays until ``cleanup``: results that are read later build on it.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``df`` staged for the length of a block, and removed after it, also after an error.

    Filters on the ``partition_by`` columns then read the files of those values only.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    try:
        df.write.partitionBy(*partition_by).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it; a missing one is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cleanup(spark: SparkSession) -> None:
    """Drop the databases made with ``new_database`` and delete all this application has staged.

    Call it when no result that was returned is read any more. What ``ship`` has sent stays, as
    executors that start later fetch it.
    """
    for database in _databases.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    root = spark._jvm.org.apache.hadoop.fs.Path(_own_root(spark))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.listStatus(root) if files.exists(root) else []:
        if not found.getPath().getName().startswith(f"{_CODE}-"):
            files.delete(found.getPath(), True)


def new_database(spark: SparkSession) -> tuple[str, str]:
    """Name and folder of a database no other run uses; ``cleanup`` drops it."""
    folder = new_folder(spark, "db")
    name = "tillroll_" + folder.rsplit("-", 1)[1]
    _databases.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name, folder


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not find it where the driver does.

    Once per application; a package that came as a zip with ``--py-files`` is there already.
    """
    app = spark.sparkContext.applicationId
    package = pathlib.Path(__file__).resolve().parent
    if app in _shipped or not package.is_dir():
        return
    with tempfile.TemporaryDirectory(prefix="tillroll-") as folder:
        archive = pathlib.Path(folder, f"{package.name}.zip")
        with zipfile.ZipFile(archive, "w") as packed:
            for file in sorted(package.rglob("*.py")):
                packed.write(file, file.relative_to(package.parent))
        # Spark reads the file once more when an executor asks for it, so it is kept in the shared folder.
        target = new_folder(spark, _CODE) + f"/{archive.name}"
        path = spark._jvm.org.apache.hadoop.fs.Path
        files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
        files.copyFromLocalFile(path(f"file://{archive}"), path(target))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
