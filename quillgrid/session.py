"""What a session needs: this package on the executors, and tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors once for each application; they may have no copy of their own."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():
        archive = Path(tempfile.mkdtemp(prefix="quillgrid-")) / "quillgrid.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent).as_posix())
        context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the cluster shares; a temporary one only where it is unset and all runs on
    one machine (tests). On a cluster without the setting this is an error: executors don't share local folders."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="quillgrid-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        found = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder; what is there goes when the session's process ends."""
    path = f"{shared_folder(spark)}/quillgrid-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return f"{path}/{name}"


def files(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    try:
        fs, at = files(spark, path)
        fs.delete(at, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit; the folder is scratch
        pass


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and lost executors cost nothing that came before."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
