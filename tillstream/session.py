"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job wants, whatever the cluster size.  They only switch on
# Spark's own adaptive machinery; sizes (partitions, memory) stay with the
# deployment.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Deployment setting: tables are stored as few large row groups, so a scan must
# be dealt anew before row-local work (off unless set; the local session sets it
# because its tables are single files).  Spark decides on the partitions.
SPREAD_SCANS = "spark.tillstream.spreadScans"


def build_session(master: str = "local[8]", app: str = "tillstream",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local / test session.  On a cluster use the submitted session and only
    call :func:`apply_defaults`."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.session.timeZone", "UTC"))
    for k, v in {**SCALE_DEFAULTS, SPREAD_SCANS: "true", **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in SCALE_DEFAULTS.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session
                pass
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application).

    Functions of the package are pickled by name, so a worker must be able to
    import it even when the job was not started from the repository folder.
    The archive goes through Spark's own file distribution."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tillstream-py-"), "tillstream.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it to a shared file system: a folder
    of one machine would lose the rows other machines write, so an unset folder
    is an error there.  Only a local master gets a private scratch folder.
    """
    sc = spark.sparkContext
    cur = sc._jsc.sc().getCheckpointDir()
    if cur.isDefined():
        return cur.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tillstream-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables
    and streaming checkpoints (never a machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def fixed_table(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A small fixed table (configuration, dictionaries, rule weights) as an
    inline ``VALUES`` relation: Catalyst knows its exact size, so size-checked
    broadcasts apply to it, and it needs no driver-side RDD."""
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(ddl)
    names = [f.name for f in schema.fields]
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(`c{i}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(schema.fields))
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({aliases})")


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder
    (``spark.checkpoint.dir``) and read it back.

    A plan that feeds several branches is then computed once (an eager
    ``Dataset.checkpoint`` would compute it twice: once to count, once to
    save), and a lost executor re-reads files instead of re-running the
    lineage.  This is the batch counterpart of a DWD topic."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
