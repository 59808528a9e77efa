"""Session settings, table access and lineage cuts shared by every plan."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lociflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and Arrow transfer; ``conf`` overrides any of it."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app).config(map=settings)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` (a file or a folder) under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only where it is unset (tests) take a local one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="lociflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that what follows never recomputes it.

    Used where an iteration would grow the lineage or where two jobs must see the very same
    partitioning; the files survive the loss of an executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{kind}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again.

    Like ``cut``, for loops: what is read again carries no constraints of the plan before it, which
    a checkpointed frame keeps and which would double every round.
    """
    path = shared_path(df.sparkSession, "tables")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
