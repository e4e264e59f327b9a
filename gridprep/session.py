"""Spark session settings shared by the bench, the tests and interactive use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "gridprep", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share, of spark.checkpoint.dir. Where it is unset, one of our own on a single machine
    (tests); on a cluster that is an error, since executors can't see the driver's folders."""
    import tempfile

    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        where = tempfile.mkdtemp(prefix="gridprep-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(where)
    return where


def reliable_cut(df):
    """The same rows, computed now and kept in the shared checkpoint folder, so that losing executors loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df):
    """The same rows, written to the shared folder as Parquet and read again: like ``reliable_cut``, and the plan starts
    afresh with a table of known size and without what Spark knew about its columns."""
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Folders of tables that this process has stored.
_FOLDERS: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, which ``release`` deletes."""
    import uuid

    _FOLDERS.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def release(spark: SparkSession, *folders: str) -> int:
    """Deletes the tables stored so far, or those in these ``folders``, and returns their number: results that aren't written
    yet can't be read any more."""
    jvm, n = spark._jvm, 0
    for folder in folders or tuple(_FOLDERS):
        _FOLDERS.remove(folder)
        path = jvm.org.apache.hadoop.fs.Path(folder)
        n += int(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def arrow_rows(spark: SparkSession, most: int = 10_000) -> None:
    """Arrow batches of at most so many rows: few for tables whose rows hold long arrays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(most))
