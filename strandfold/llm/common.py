"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.sparkContext.getCheckpointDir() or f"file://{tempfile.mkdtemp(prefix='llm-')}"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder: they survive lost executors and are read, not redone."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the folder of a frame that stored() made and that nothing reads any more."""
    spark = df.sparkSession
    for path in {name.rpartition("/")[0] for name in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_key(text: str | Column) -> Column:
    """A hash that tells apart rows which share a doc_id."""
    text = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` but those named by doc_id and text_key in ``gone``, whatever other columns ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    own = {}
    for name in ("doc_id", "text_key"):
        own[name] = f"_gone_{name}"
        while own[name] in taken:
            own[name] += "_"
    named = gone.select(*(F.col(name).alias(alias) for name, alias in own.items())).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(own["doc_id"])) & (text_key("text") == F.col(own["text_key"]))
    return docs.join(named, same, "left_anti")


def words(text: Column) -> Column:
    """Array of the words of a text: everything between blanks (space, tab to carriage return)."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
