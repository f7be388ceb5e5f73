"""Tables in the cluster's shared folder, and what tasks need to run our code."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_SHIPPED = "marketprep.llm.shipped"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/marketprep-llm/{name}-{uuid.uuid4().hex}"


# Spark removes the shuffle files of a query when it ends, not when the driver
# happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query made inside go when it ends."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: after a lost executor Spark rereads the files
    instead of running everything before them again.  The shuffle files behind
    the table are not needed any more and go at once.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return of_table(spark.read.schema(df.schema).parquet(path), path)


_PATH = "_marketprep_table"


def of_table(df: DataFrame, table: DataFrame | str) -> DataFrame:
    """``df`` as the frame by which :func:`drop_tables` knows a table, or its path."""
    setattr(df, _PATH, table if isinstance(table, str) else getattr(table, _PATH))
    return df


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of :func:`write_table` that nothing reads any more.

    A step's tables would else stay on the disk until the session ends.  What
    was made of them must be written already: frames that read them can't be run
    any more, and a lost executor's work is redone from the later tables.
    """
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(getattr(t, _PATH))
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


# Bytes of an Arrow batch, which the JVM and a Python worker both hold; Spark's
# own default is eight times as much.
_BATCH_BYTES, _BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, and bound the Arrow
    batches they get, unless the session sets its own bound.

    Does nothing where the launcher already put it on PYTHONPATH; else the
    package is sent once per session as a Python file, as ``--py-files`` does.
    """
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, _BATCH)
    if _ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep) or os.getcwd() == _ROOT:
        return
    if spark.conf.get(_SHIPPED, "") == spark.sparkContext.applicationId:
        return
    import tempfile
    import zipfile
    target = os.path.join(tempfile.mkdtemp(prefix="marketprep-code-"), "marketprep_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        top = os.path.join(_ROOT, "marketprep")
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, _ROOT))
    spark.sparkContext.addPyFile(target)
    spark.conf.set(_SHIPPED, spark.sparkContext.applicationId)
