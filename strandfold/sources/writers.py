"""Files handed to people and other programs, and stage tables for restarts."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandfold import __version__
from strandfold.operators import skew
from strandfold.session import shared_folder, shuffles_dropped


def write_bedgraph(coverage: DataFrame, path: str, half_open: bool = False) -> tuple[str, str]:
    """Methylation and coverage tracks, tab-separated without header, per sample.

    Both ends are the 1-based position of the C, as published; ``half_open``
    gives BED's zero-based start instead.
    """
    tracks = coverage.withColumn("pos_start", F.col("pos_start") - 1) if half_open else coverage
    targets = []
    for name, value in (("methyperc", "meth_perc"), ("CpGcov", "cov")):
        target = f"{path}/{name}.bedgraph"
        tracks.select("sample_id", "chr", "pos_start", "pos_end", value).write.mode(
            "overwrite"
        ).partitionBy("sample_id").csv(target, sep="\t", header=False)
        targets.append(target)
    return targets[0], targets[1]


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").csv(path, header=header)
    return path


def write_ndjson(df: DataFrame, path: str) -> str:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").json(path, ignoreNullFields=False)
    return path


def write_partitioned(df: DataFrame, path: str, replace: bool = True) -> str:
    """Parquet by sample and chromosome; replacing touches the written partitions only.

    Rows are spread over ``pos`` ranges inside each partition folder by the
    caller's layout; no folder is funnelled through one task here.
    """
    writer = df.write.partitionBy("sample_id", "chr")
    if replace:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)
    return path


# Stage tables hold many equal texts, which this takes less than half the space for that the default does.
STAGE_CODEC = "zstd"

# Column that stage tables kept per sample are cut by.
SAMPLE_FOLDER = "_sample"

# Leaves of a plan whose rows no file or parameter tells, and functions whose code is not in the plan.
_UNKNOWN = ("LogicalRDD", "ExternalRDD", "InMemoryRelation", "PythonUDF", "ScalaUDF")


def _plan_text(df: DataFrame) -> str:
    """The optimised plan with names and ids made equal, all columns and conditions spelled out."""
    spark, setting = df.sparkSession, "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(1 << 30))
    try:
        return df._jdf.queryExecution().optimizedPlan().canonicalized().toString()
    finally:
        spark.conf.set(setting, before)


def inputs_key(params: object, *inputs: DataFrame, sample: str | None = None) -> str:
    """What tells a run from another: parameters, how each input is made, and its files with sizes and times.

    Inputs whose rows cannot be told, such as tables in memory, give a new key each time. With ``sample``, the key
    of that sample: scans and partition folders of others do not count. Where one file holds several samples, it does.
    """
    if sample is not None:
        inputs = tuple(df.filter(F.col("sample_id") == sample) for df in inputs)
    seen = [repr(params)]
    for df in inputs:
        spark, plan = df.sparkSession, _plan_text(df)
        files = {f for f in df.inputFiles() if sample is None or f"/sample_id={sample}/" in unquote(f) or "/sample_id=" not in f}
        names = {unquote(f.rpartition("/")[2]) for f in files}
        for folder in sorted({f.rpartition("/")[0] for f in files}):
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where):
                if f.getPath().getName() in names:
                    seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        seen += [f"{len(files)} files, {df.schema.simpleString()}", plan]
        if "LocalRelation" in plan:
            seen.append(str(df.semanticHash()))
        if any(kind in plan for kind in _UNKNOWN):
            seen.append(uuid.uuid4().hex)
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()


class Stages:
    """Named tables between the steps of a run, in the shared folder.

    A written table cuts the lineage: losing executors later costs no more
    than re-reading it. The shuffle files that made it go as soon as it is written. ``reuse`` takes up a finished stage of an earlier run
    under the same ``name``, if that was written with the same ``key`` after the same stages;
    the first that differs is built anew, and so are all that follow it. Frequent keys of what a stage reads or
    writes can be watched on the way; their sketches lie beside the stage and are taken up with it.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, reuse: bool = False, key: str = ""):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/strandfold/{name or uuid.uuid4().hex}"
        self.reuse = reuse
        self.key = key
        self._written: list[str] = []
        self._watched: dict[str, list[Observation]] = {}

    def path(self, stage: str) -> str:
        return f"{self.root}/{stage}"

    def _path(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _exists(self, folder: str) -> bool:
        system, where = self._path(folder)
        return system.exists(where)

    def fingerprint(self, stage: str) -> str:
        """Of the code's version, the run's key, the stages so far and this one."""
        before = [s for s in self._written if s != stage]
        return hashlib.sha256("\n".join([__version__, self.key, *before, stage]).encode()).hexdigest()

    def finished(self, stage: str) -> bool:
        """Whether the stage's marker, written after the table, holds a row."""
        return self._marked(stage) is not None

    def _marked(self, stage: str) -> str | None:
        return self._note(stage, "finished") or None

    def _mark(self, stage: str, mark: str = "") -> None:
        self._put_note(stage, "finished", mark)

    def _note(self, stage: str, kind: str) -> str:
        """A small text beside a stage's table; empty if there is none."""
        system, where = self._path(f"{self.path(stage)}.{kind}")
        if not system.exists(where):
            return ""
        stream = system.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _put_note(self, stage: str, kind: str, text: str) -> None:
        system, where = self._path(f"{self.path(stage)}.{kind}")
        stream = system.create(where, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def watch(self, stage: str, df: DataFrame, **key_sets: Sequence[str]) -> DataFrame:
        """The table, with sketches of its frequent keys taken while ``stage`` is written from it."""
        df, observation = skew.watched(df, key_sets)
        self._watched.setdefault(stage, []).append(observation)
        return df

    def hot_keys(self, stage: str, name: str) -> skew.HotKeys:
        """The frequent keys of a key set that was watched while the stage was written."""
        kept = json.loads(self._note(stage, "sketches") or "[]")
        return skew.hot_keys(self.spark, [sketch for key_set, sketch in kept if key_set == name])

    def _keep_sketches(self, stage: str, others: Sequence[tuple[str, str]] = ()) -> None:
        found = [(name, sketch) for o in self._watched.pop(stage, []) for name, sketch in skew.gathered(o).items()]
        if found:
            self._put_note(stage, "sketches", json.dumps([*others, *found]))

    def write(self, stage: str, build: Callable[[], DataFrame],
              watch: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
        """Write a stage, or take the finished one, and return it as a scan; ``watch`` names key sets of its rows."""
        wanted, found = self.fingerprint(stage), self._marked(stage)
        if not (self.reuse and found == wanted):
            if found is not None:  # a broken rewrite must not pass for the old table
                self._mark(stage)
            df = build()
            if watch:
                df = self.watch(stage, df, **watch)
            with shuffles_dropped(self.spark):
                df.write.mode("overwrite").parquet(self.path(stage), compression=STAGE_CODEC)
            self._keep_sketches(stage)
            self._mark(stage, wanted)
        self._written.append(stage)
        return self.read(stage)

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self.path(stage))

    def delete(self) -> None:
        """Remove the tables of a run whose results have been taken elsewhere."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


class SampleStages(Stages):
    """Stages kept per sample, so that one more sample builds that sample's part only.

    ``keys`` has each sample's ``inputs_key``. A stage is a folder per sample; those whose sample was
    finished with the same key after the same stages are taken up, all others are built together in one go
    and replaced one by one. ``build`` gives the rows of all samples; the filter on those
    that are wanted reaches down to the inputs, for the sample is part of every key.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Mapping[str, str]):
        super().__init__(spark, name, reuse=True)
        self.keys = dict(keys)

    def _folder(self, stage: str, sample: str) -> str:
        return f"{self.path(stage)}/{SAMPLE_FOLDER}={hashlib.sha256(sample.encode()).hexdigest()[:32]}"

    def _fingerprint_of(self, stage: str, sample: str) -> str:
        return hashlib.sha256(f"{self.fingerprint(stage)} {self.keys[sample]}".encode()).hexdigest()

    def pending(self, stage: str) -> list[str]:
        """Samples whose part of the stage is missing or was made otherwise."""
        marks = json.loads(self._note(stage, "samples") or "{}")
        return [s for s in self.keys if marks.get(s) != self._fingerprint_of(stage, s)]

    def finished(self, stage: str) -> bool:
        return not self.pending(stage)

    def write(self, stage: str, build: Callable[[], DataFrame],
              watch: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
        todo = self.pending(stage)
        if todo:
            df = build()
            df = df.filter(F.col("sample_id").isin(todo))
            if watch:
                df = self.watch(stage, df, **watch)
            done = {s: self._fingerprint_of(stage, s) for s in self.keys if s not in todo}
            self._mark_samples(stage, done, df.schema)  # a broken rewrite must not pass for the old parts
            for sample in todo:  # a sample without rows leaves no folder to replace
                self._remove(self._folder(stage, sample))
            own = F.left(F.sha2(F.col("sample_id"), 256), F.lit(32))
            with shuffles_dropped(self.spark):
                df.withColumn(SAMPLE_FOLDER, own).write.partitionBy(SAMPLE_FOLDER).mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").parquet(self.path(stage), compression=STAGE_CODEC)
            # Of the samples built now; those of the others are there.
            self._keep_sketches(stage, json.loads(self._note(stage, "sketches") or "[]"))
            self._mark_samples(stage, {s: self._fingerprint_of(stage, s) for s in self.keys}, df.schema)
        else:
            self._watched.pop(stage, None)
        self._written.append(stage)
        return self.read(stage)

    def read(self, stage: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self._note(stage, "schema")))
        there = [f for f in (self._folder(stage, s) for s in self.keys) if self._exists(f)]
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*there)

    def _mark_samples(self, stage: str, marks: Mapping[str, str], schema: T.StructType) -> None:
        """Replaces the marks of the samples asked for; those of others stay."""
        there = json.loads(self._note(stage, "samples") or "{}")
        there = {s: mark for s, mark in there.items() if s not in self.keys}
        self._put_note(stage, "samples", json.dumps({**there, **marks}))
        self._put_note(stage, "schema", schema.json())

    def _remove(self, folder: str) -> None:
        system, where = self._path(folder)
        system.delete(where, True)
