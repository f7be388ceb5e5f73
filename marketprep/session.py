"""Session helpers: building a session, literal tables, the shared folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every plan in this package assumes. AQE re-plans joins from real
# shuffle sizes (broadcast only when a side measured small, skew splitting),
# and coalesces small post-shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "marketprep",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with this package's defaults.

    On a cluster pass ``master=None`` and let the launcher decide; the shuffle
    partition count should then be sized to the data (AQE coalesces down).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; only when none is configured and the
    master is local (tests, a laptop) do we pick a scratch folder of our own.
    On a cluster no machine-local folder would do, so that raises.  The
    context's checkpoint directory is set once, not on every call.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not (sc.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="marketprep-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/marketprep/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: what it holds is fixed
    then, and a lost executor rereads it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table built JVM-side from constant expressions.

    ``createDataFrame`` over a Python list yields a Python RDD, which executors
    must unpickle in Python workers and which carries no size statistics.  This
    is one ``inline`` of a constant array of structs: plain JVM expressions,
    sized by the planner, whose own size check decides how it is joined.  A NaN
    among the values becomes NULL.
    """
    struct = T.StructType.fromDDL(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in struct.fields])

    def const(v, f: T.StructField):
        return F.lit(None if isinstance(v, float) and math.isnan(v) else v).cast(f.dataType).alias(f.name)

    consts = [F.struct(*[const(v, f) for v, f in zip(row, struct.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*consts)))
