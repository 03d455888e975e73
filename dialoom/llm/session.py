"""Session helpers: checkpoint folder, partition counts, guarded broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only on one machine, where the session names none (tests), a temporary
    folder is made and set; a cluster must name one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="dialoom-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", path)
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Have the driver collect garbage, so that Spark's cleaner drops shuffles and checkpoints of rounds that nothing holds any more."""
    spark.sparkContext._jvm.System.gc()


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def positional(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns renamed by place (c0, c1, ...), and the new names of ``names``, so that no name of its own can clash with another."""
    folded = [c.lower() for c in docs.columns]
    places = [docs.columns.index(n) if n in docs.columns else folded.index(n.lower()) for n in names]
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))]), [f"c{k}" for k in places]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
