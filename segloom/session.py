"""Session helpers: table access and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(app: str = "segloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a UTC clock; further settings as keywords."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC"}
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a Spark context, so that their Python can import it."""
    context = spark.sparkContext
    if getattr(context, "_segloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="segloom-")) / "segloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, Path(root.name) / file.relative_to(root))
    context.addPyFile(str(archive))
    context._segloom_shipped = True


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table ``name`` (a file or a folder) of ``directory``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session in one machine (master ``local``) that doesn't name one gets
    a temporary folder; on a cluster each executor would write to its own.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or getattr(spark.sparkContext, "_segloom_shared", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share; intermediate results are written there")
        folder = "file://" + tempfile.mkdtemp(prefix="segloom-")
        spark.sparkContext._segloom_shared = folder
    return folder.rstrip("/")


def file_system(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of the JVM for a path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that a result used more than once is computed once,
    and survives the loss of executors. An application's results lie in a
    folder of its own, which goes when the application ends.
    """
    spark = df.sparkSession
    own = f"{shared_dir(spark)}/segloom/{spark.sparkContext.applicationId}"
    if getattr(spark.sparkContext, "_segloom_written", None) != own:
        fs, at = file_system(spark, own)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        spark.sparkContext._segloom_written = own
    path = f"{own}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, keys: list[str], bound: int, total: int) -> DataFrame:
    """At most ``bound`` of the ``total`` rows, chosen by a hash of ``keys``: the same rows each time.

    The share is set before the rows are read, so that no task sends more than
    its part of the sample.
    """
    scale = 1 << 30
    share = min(1.0, 0.95 * bound / max(1, total))
    chosen = df.where(F.pmod(F.xxhash64(*keys), F.lit(scale)) < int(share * scale)) if share < 1 else df
    return chosen.limit(bound)
