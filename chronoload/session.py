"""Session settings and the shared folder that staged tables live in."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Every timestamp in this package is wall-clock UTC; the workers can import the package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, whatever folder the driver runs in."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="chronoload-package-")) / "chronoload_package.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, as named by ``spark.checkpoint.dir``.

    A local master without the setting gets a folder of its own; a cluster without it is refused,
    because a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        app = context.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="chronoload-")
        folder = _LOCAL_DIRS[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/chronoload/{name}-{uuid.uuid4().hex}"


def is_missing(error: Exception) -> bool:
    """Does an analysis error say that a path is not there? Any other error must reach the caller."""
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    The lineage ends at the files, so a lost executor costs a re-read and not a recomputation, and
    Catalyst knows the table's real size: small ones are broadcast, large ones are not.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
