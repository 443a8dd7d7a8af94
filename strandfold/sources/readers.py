"""Text inputs with declared layouts; nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F

from strandfold import schemas
from strandfold.params import AsmParams

Paths = str | Sequence[str]
# Fixed value: where the common variants of a genome build lie below a folder, as published for download.
COMMON_SNP_FILE = "{genome}/database/snp151Common.txt*"


def _list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


class LineCount:
    """Lines read and rejected by a scan, counted while something else reads it: no pass of its own.

    Given to a reader, it is filled by the first action on the whole of what that returns; a
    later action does not change it. ``rejected`` and ``lines`` wait for that.
    """

    def __init__(self) -> None:
        self._observation = Observation()

    def on(self, lines: DataFrame, bad: Column) -> DataFrame:
        return lines.observe(self._observation, F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("rejected"))

    @property
    def lines(self) -> int:
        return self._observation.get["lines"]

    @property
    def rejected(self) -> int:
        return self._observation.get["rejected"]


def _fields(spark: SparkSession, paths: Paths) -> DataFrame:
    lines = spark.read.text(_list(paths)).withColumn("_file", F.col("_metadata.file_path"))
    # Exploding keeps the filters from splitting a line again for each field that they look at.
    return lines.select("*", F.explode(F.array(F.split("value", "\t", -1))).alias("_f"))


def _only(lines: DataFrame, good: Column, strict: bool, count: LineCount | None) -> DataFrame:
    """The good lines; any other is an error that names its file, or left out unless ``strict``."""
    if count:
        lines = count.on(lines, ~good)
    if not strict:
        return lines.filter(good)
    told = F.concat(F.lit("malformed line in "), "_file", F.lit(": "), F.left("value", F.lit(200)))
    return lines.filter(F.when(good, True).otherwise(F.raise_error(told).cast("boolean")))


def _typed(layout: schemas.Columns):
    """Columns for split fields, and whether each number parses."""
    columns, parses = [], F.lit(True)
    for i, (name, kind) in enumerate(layout.items()):
        text = F.get("_f", F.lit(i))
        if kind == "string":
            columns.append(text.alias(name))
            continue
        text = F.nullif(F.trim(text), F.lit(""))
        value = text.try_cast(kind)
        parses = parses & (text.isNull() | value.isNotNull())
        columns.append(value.alias(name))
    return columns, parses


def _mode(strict: bool) -> str:
    return "FAILFAST" if strict else "DROPMALFORMED"


def _parsed(reader: DataFrameReader, layout: schemas.Columns, scan: Callable[[DataFrameReader], DataFrame],
            strict: bool, count: LineCount | None) -> DataFrame:
    """Rows that Spark's own parser reads; counted, the rows it can not parse are told apart first."""
    if strict or not count:
        rows = scan(reader.schema(schemas.ddl(layout)).option("mode", _mode(strict)))
        return count.on(rows, F.lit(False)) if count else rows
    bad = reader.schema(f"{schemas.ddl(layout)}, _bad string").option("columnNameOfCorruptRecord", "_bad")
    rows = scan(bad)
    # Spark parses the columns that a query needs: a condition that always holds makes it all of them.
    rows = rows.filter(F.xxhash64(*rows.columns) >= -(1 << 63))
    return count.on(rows, F.col("_bad").isNotNull()).filter("_bad is null").drop("_bad")


def _context_options() -> dict[str, object]:
    return {"sep": "\t", "header": True, "quote": "", "enforceSchema": True}


def scan_cpg_context(spark: SparkSession, paths: Paths, sample_id: str, strict: bool = True,
                     count: LineCount | None = None) -> DataFrame:
    """Methylation calls: tab-separated, one header line in each file."""
    reader = spark.read.options(**_context_options())
    return _parsed(reader, schemas.CPG_CONTEXT, lambda r: r.csv(_list(paths)), strict, count).withColumn("sample_id", F.lit(sample_id))


def _good_sam() -> Column:
    return (F.size("_f") == len(schemas.SAM)) & _typed(schemas.SAM)[1]


def _good_vcf() -> Column:
    """Any number of samples may follow the first; that one's column is read. A quality of ``.`` is null."""
    return F.col("value").startswith("#") | (F.size("_f") >= len(schemas.VCF))


def _good_common_snps() -> Column:
    return (F.size("_f") == len(schemas.COMMON_SNPS)) & _typed(schemas.COMMON_SNPS)[1]


def scan_sam(spark: SparkSession, paths: Paths, sample_id: str, strict: bool = False,
             count: LineCount | None = None) -> DataFrame:
    """Aligned reads: the rows with all 19 fields and parsable numbers.

    Split as text, since quality strings may hold quote characters. Other lines
    are left out, as in the published load; ``rejected_lines`` has them.
    """
    columns, _ = _typed(schemas.SAM)
    lines = _only(_fields(spark, paths), _good_sam(), strict, count)
    return lines.select(F.lit(sample_id).alias("sample_id"), *columns)


def scan_vcf(spark: SparkSession, paths: Paths, sample_id: str, strict: bool = True,
             count: LineCount | None = None) -> DataFrame:
    """Variant calls; header lines are told by their first character in every file."""
    columns, _ = _typed(schemas.VCF)
    lines = _only(_fields(spark, paths), _good_vcf(), strict, count).filter(~F.col("value").startswith("#"))
    return lines.select(F.lit(sample_id).alias("sample_id"), *columns)


def scan_common_snps(spark: SparkSession, paths: Paths, sample_id: str, strict: bool = True,
                     count: LineCount | None = None) -> DataFrame:
    """The 26-column common-variant dump.

    ``common_snp_path`` says where it lies for a genome build.
    """
    columns, _ = _typed(schemas.COMMON_SNPS)
    lines = _only(_fields(spark, paths), _good_common_snps(), strict, count)
    return lines.select(F.lit(sample_id).alias("sample_id"), *columns)


def common_snp_path(folder: str, params: AsmParams) -> str:
    """The common-variant dump of the run's genome build below a folder laid out as published."""
    return f"{folder.rstrip('/')}/{COMMON_SNP_FILE.format(genome=params.genome)}"


def scan_cpg_asm(spark: SparkSession, paths: Paths, sample_id: str, strict: bool = True,
                 count: LineCount | None = None) -> DataFrame:
    """CpG test results written as CSV without a header."""
    return _parsed(spark.read, schemas.CPG_ASM, lambda r: r.csv(_list(paths)), strict, count).withColumn("sample_id", F.lit(sample_id))


def scan_region_pvalue(spark: SparkSession, paths: Paths, sample_id: str, strict: bool = True,
                       count: LineCount | None = None) -> DataFrame:
    """Region test results written as one JSON object per line."""
    return _parsed(spark.read, schemas.REGION_PVALUE, lambda r: r.json(_list(paths)), strict, count).withColumn("sample_id", F.lit(sample_id))


def rejected_lines(spark: SparkSession, paths: Paths, layout: str) -> DataFrame:
    """(file, value) of the lines that the reader of a layout would not read.

    Layouts: cpg_context, sam, vcf, common_snps, cpg_asm, region_pvalue.
    """
    split = {"sam": _good_sam, "vcf": _good_vcf, "common_snps": _good_common_snps}
    if layout in split:
        return _fields(spark, paths).filter(~split[layout]()).select(F.col("_file").alias("file"), "value")
    table = {"cpg_context": schemas.CPG_CONTEXT, "cpg_asm": schemas.CPG_ASM, "region_pvalue": schemas.REGION_PVALUE}[layout]
    reader = spark.read.schema(f"{schemas.ddl(table)}, _bad string").option("columnNameOfCorruptRecord", "_bad")
    if layout == "region_pvalue":
        rows = reader.json(_list(paths))
    else:
        rows = reader.options(**(_context_options() if layout == "cpg_context" else {})).csv(_list(paths))
    # Spark parses the columns that a query needs: a condition that always holds makes it all of them.
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"))
    return rows.filter(F.col("_bad").isNotNull() & (F.xxhash64(*rows.columns) >= -(1 << 63))).select("file", F.col("_bad").alias("value"))


def append_chromosomes(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Per-chromosome or per-sample tables as one, matched by column name."""
    for df in more:
        first = first.unionByName(df)
    return first
