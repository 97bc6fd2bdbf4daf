"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldcast import schema as S

CSV_DELIMITER = "\t"
_FORMATS = {".csv": "csv", ".tsv": "csv", ".parquet": "parquet"}


def resolve_format(path) -> str:
    """File format from the extension, with the source loader's errors."""
    if not isinstance(path, str):
        raise TypeError(f"expected a path string, got {type(path).__name__}")
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if "." not in name:
        raise ValueError(f"path has no file extension: {path}")
    ext = "." + name.rsplit(".", 1)[-1].lower()
    if ext not in _FORMATS:
        raise ValueError(f"unsupported file extension {ext!r}: {path}")
    return _FORMATS[ext]


def _first_line(spark: SparkSession, path: str) -> str:
    """First line of a (possibly compressed) file, through the Hadoop file system that holds it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(conf).open(hpath)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hpath)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def header_groups(spark: SparkSession, paths: Sequence[str], sep: str = CSV_DELIMITER,
                  parallelism: int = 64) -> dict[tuple[str, ...], list[str]]:
    """Files under ``paths`` grouped by their header's column names; empty files are left out.

    One line is read of each file, ``parallelism`` files at a time; no data pass is needed for it.
    """
    files = sorted(spark.read.text(list(paths)).inputFiles())
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f).lstrip("\ufeff"), files))
    for f, line in zip(files, lines):
        if line:
            names = tuple(n.strip().strip('"') for n in line.split(sep))
            groups.setdefault(names, []).append(f)
    return groups


def require_equal_columns(groups: dict[tuple[str, ...], list[str]]) -> None:
    """S3: files that are stacked must hold the same columns, in any order; else an error that names the file and the columns."""
    first, files = next(iter(groups.items()), ((), []))
    for names, others in groups.items():
        lacking, extra = sorted(set(first) - set(names)), sorted(set(names) - set(first))
        if lacking or extra:
            raise ValueError(f"{others[0]} lacks columns {lacking} and has columns {extra} beyond those of {files[0]}")


def typed_columns(present: Sequence[str], schema: T.StructType) -> list:
    """Declared columns cast from text by name; ones that are not present are null."""
    return [(F.col(f"`{f.name}`").cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields]


def read_raw_csv(spark: SparkSession, paths: str | Sequence[str], sep: str = CSV_DELIMITER,
                 schema: T.StructType = S.RAW_SCHEMA, allow_missing: bool = False) -> DataFrame:
    """Delimited files with a header, declared schema (no inference).

    Every file's header line is read first. Files with one header form a
    reader of their own, whose columns are matched to the declared ones by
    name and cast (ANSI: malformed numbers fail the job); a declared column that all
    headers lack is null. Files with other columns than the rest are an error, unless ``allow_missing``: then
    what a file lacks is null in it. The parts are stacked. Columns are pruned at parse time.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    groups, out = header_groups(spark, paths, sep), None
    if not allow_missing:
        require_equal_columns(groups)
    for names, files in groups.items():
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        part = (spark.read.schema(text).option("header", True).option("sep", sep).option("mode", "FAILFAST")
                .csv(files).select(typed_columns(names, schema)))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def read_parquet(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet scan (pushdown and pruning by Catalyst)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*paths)


def load(spark: SparkSession, paths: str | Sequence[str], sep: str = CSV_DELIMITER,
         schema: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """Read one or many files, per format, stacked by name.

    Parts must have the same columns; a part that lacks one fails the load.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no paths given")
    by_format: dict[str, list[str]] = {}
    for p in paths:
        by_format.setdefault(resolve_format(p), []).append(p)
    frames = [read_raw_csv(spark, ps, sep, schema) if fmt == "csv" else read_parquet(spark, ps)
              for fmt, ps in by_format.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = (S.YEAR,),
                mode: str = "errorifexists") -> None:
    """Parquet sink, partitioned by year so later year filters prune files."""
    w = df.write.mode(mode)
    cols = [c for c in (partition_by or []) if c in df.columns]
    if cols:
        w = w.partitionBy(*cols)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = CSV_DELIMITER, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metrics / parameter tables as JSON lines."""
    df.write.mode(mode).json(path)
