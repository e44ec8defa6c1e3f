"""Session settings and the shared folder for intermediate tables."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root = None


def get_session(app_name="vereda", master=None, **settings):
    """A session with adaptive execution and UTC; ``settings`` override.

    Call sites per column are off, because they make plans slow to build, and the cache of
    compiled code is large enough for the many stages of a forest.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.codegen.cache.maxEntries": "1000",
    }
    options.update({name.replace("__", "."): value for name, value in settings.items()})
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="vereda-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def fixed_table(spark: SparkSession, rows, columns) -> DataFrame:
    """A short list from the program as an inline table.

    Spark knows the size of an inline table, so it broadcasts a small one on its own, and
    does not shuffle the other side of the join to find out.
    """
    width = len(columns)
    cells = {f"cell{i}": cell for i, cell in enumerate(cell for row in rows for cell in row)}
    marks = [f":{name}" for name in cells]
    entries = [f"({', '.join(marks[i:i + width])})" for i in range(0, len(marks), width)]
    return spark.sql(
        f"SELECT * FROM VALUES {', '.join(entries)} AS fixed({', '.join(columns)})", args=cells
    )


def _application_folder(spark):
    application = spark.conf.get("spark.app.id", "application")
    return f"{shared_folder(spark)}/vereda-{application}"


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder nobody has used yet, below the shared folder."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def park(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The returned frame has no lineage beyond the files, so a lost executor cannot change
    values that came from sampling, partition numbers or row numbers.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_parked(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
