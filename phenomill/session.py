"""Session settings and the shared scratch folder.

Operators never set session options themselves; ``get_session`` is a
convenience for scripts, tests and the bench.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback_dirs: dict[str, str] = {}


def get_session(app: str = "phenomill", master: str | None = None, **conf: str) -> SparkSession:
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A skewed join is worth one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Group-bys with a percentile keep hashing beyond the default of 128 groups per task.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app_id = spark.sparkContext.applicationId
    if app_id not in _fallback_dirs:
        _fallback_dirs[app_id] = tempfile.mkdtemp(prefix="phenomill-")
    return _fallback_dirs[app_id]


def scratch_path(spark: SparkSession, label: str) -> str:
    app_id = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app_id}/{label}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediate tables; frames that still read them can't be used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_intermediate(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as a fresh scan.

    Cuts the lineage of a step whose result must not change between two uses (a
    sampled range partitioning), of loops, and of small tables that are read several times.
    Survives the loss of executors, and the optimizer knows the size of what was written.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, bytes_per_row: int, limit: int = 256 << 20) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit ``limit``, else as it is, for a shuffled join.

    For tables that are larger than Spark's own threshold but small next to the other side, whose
    shuffle the hint saves. ``df`` should be a scan, as it is counted.
    """
    return F.broadcast(df) if df.count() * bytes_per_row <= limit else df


def small_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A literal table whose size the optimizer knows, so that joins with it are broadcast."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return "TRUE" if value else "FALSE"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{value!r}D" if isinstance(value, float) else str(value)

    names = [field.split()[0] for field in schema.split(",")]
    types = [field.split()[1] for field in schema.split(",")]
    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    columns = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in zip(names, types))
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t(`{'`, `'.join(names)}`)")
