"""Vendor files: CSV and JSON in their several shapes."""

from __future__ import annotations

import csv
import re
import zlib
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators import attach

# The date that ends a file name: …_2025-01-31.csv or …_20250131.json.
FILE_DATE = r"(\d{4})-?(\d{2})-?(\d{2})\.[A-Za-z]+(?:\.gz)?$"
# What a header line needs of a file, and how many files are asked at a time.
HEAD_BYTES = 16 << 10
HEAD_READERS = 16
LINE_END = re.compile(rb"\r\n|\n|\r")


def file_date(pattern: str = FILE_DATE) -> Column:
    """'YYYYMMDD' from the name of the file a row comes from."""
    name = F.col("_metadata.file_name")
    digits = F.concat(*[F.regexp_extract(name, pattern, i) for i in (1, 2, 3)])
    return F.when(digits != "", digits)


def file_manifest(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = FILE_DATE, col: str = "file_version_date"
) -> DataFrame:
    """The date in a file's name, file, length and modification time of each dated file. No content is read.

    A folder that does not exist has no files.
    """
    try:
        listed = spark.read.format("binaryFile").load(_paths(paths))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{col} string, file string, length bigint, modified timestamp")
    digits = F.concat(*[F.regexp_extract("path", pattern, i) for i in (1, 2, 3)])
    named = listed.select(
        digits.alias(col), F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified")
    )
    return named.where(F.col(col) != "")


def dated_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = FILE_DATE
) -> dict[str, list[str]]:
    """Files by the date in their names, from a listing; a file without a date is left out."""
    found: dict[str, list[str]] = defaultdict(list)
    for date, file in file_manifest(spark, paths, pattern).select("file_version_date", "file").collect():
        found[date].append(file)
    return dict(found)


def read_head(spark: SparkSession, file: str, size: int) -> bytes:
    """The first ``size`` bytes of a file; the rest is not asked for."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size))
    finally:
        stream.close()


def _first_line(spark: SparkSession, file: str, length: int) -> str:
    size = min(length, HEAD_BYTES)
    while True:
        head = read_head(spark, file, size)
        if file.endswith(".gz"):
            head = zlib.decompressobj(wbits=31).decompress(head)
        lines = LINE_END.split(head, maxsplit=1)
        if len(lines) > 1 or size == length:
            return lines[0].decode().lstrip("\ufeff")
        size = min(length, 4 * size)


def csv_headers(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The column names that each file's own first line has; empty files have none.

    Of a file ``HEAD_BYTES`` are read, more only where its first line is longer.
    """
    listed = spark.read.format("binaryFile").load(_paths(paths)).where("length > 0").select("path", "length").collect()
    with ThreadPoolExecutor(HEAD_READERS) as pool:
        lines = pool.map(lambda r: _first_line(spark, r["path"], r["length"]), listed)
        return {r["path"]: tuple(next(csv.reader([line]))) for r, line in zip(listed, lines, strict=True) if line}


def read_csv_by_header(
    spark: SparkSession,
    paths: str | Sequence[str],
    null_as_empty: bool = False,
    date_col: str | None = "file_version_date",
    multiline: bool = False,
) -> DataFrame | None:
    """CSV files of any layouts as text, each read by its own header.

    Files of one layout are read together, layouts are united by name. A
    row that does not fit its header fails the read; a line break inside quotes
    is such a row unless ``multiline`` is on, which reads each file in one
    task. None where there is no file with a header.
    """
    layouts: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, header in csv_headers(spark, paths).items():
        layouts[header].append(file)
    frames = []
    for header, files in sorted(layouts.items()):
        if len(set(header)) < len(header):
            raise ValueError(f"columns repeat in the header of {files[0]}: {', '.join(header)}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        reader = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
        reader = reader.option("enforceSchema", False).option("mode", "FAILFAST").option("encoding", "UTF-8")
        frame = reader.option("columnPruning", False).option("multiLine", multiline).csv(files)
        frames.append(frame.select("*", file_date().alias(date_col)) if date_col else frame)
    if not frames:
        return None
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return _absent_as_empty(df, [c for c in df.columns if c != date_col]) if null_as_empty else df


def _absent_as_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """'' for NULL; vendor column names may hold dots."""
    chosen = set(columns)
    return df.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns]
    )


def _paths(paths: str | Sequence[str]) -> str | list[str]:
    return paths if isinstance(paths, str) else list(paths)


def read_csv_strings(
    spark: SparkSession,
    paths: str | Sequence[str],
    null_as_empty: bool = False,
    date_col: str | None = "file_version_date",
    schema: T.StructType | None = None,
) -> DataFrame:
    """CSV with every column as text, exactly as written.

    Without a schema only the header line is looked at. All files of one call
    share that header; read files of different layout in separate calls.
    ``null_as_empty`` keeps '' where a field is absent.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    reader = reader.option("inferSchema", False).option("encoding", "UTF-8")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(_paths(paths))
    columns = df.columns
    if date_col:
        df = df.select("*", file_date().alias(date_col))
    if null_as_empty:
        df = _absent_as_empty(df, columns)
    return df


def read_json_strings(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    date_col: str | None = "file_version_date",
) -> DataFrame:
    """JSON array of flat objects in the declared schema, absent fields as ''."""
    df = spark.read.schema(schema).option("multiLine", True).json(_paths(paths))
    if date_col:
        df = df.select("*", file_date().alias(date_col))
    return _absent_as_empty(df, [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)])


def read_json_envelope(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    date_col: str | None = None,
) -> DataFrame:
    """JSON array of nested structs, or one object, one row each."""
    df = spark.read.schema(schema).option("multiLine", True).json(_paths(paths))
    return df.select("*", file_date().alias(date_col)) if date_col else df


def read_envelope_rows(
    spark: SparkSession,
    paths: str | Sequence[str],
    envelope: str,
    row: T.StructType,
    date_col: str | None = "file_version_date",
) -> DataFrame:
    """Rows inside ``{envelope: [...]}``; a file without it gives none."""
    schema = T.StructType().add(envelope, T.ArrayType(row))
    df = spark.read.schema(schema).option("multiLine", True).json(_paths(paths))
    keep = [file_date().alias(date_col)] if date_col else []
    return df.select(F.inline(envelope), *keep)


def read_header_rows(
    spark: SparkSession,
    paths: str | Sequence[str],
    row: T.StructType,
    header_field: str = "date",
    date_col: str | None = "file_version_date",
) -> DataFrame:
    """JSON array whose first element is a header: its field goes to each row."""
    text = spark.read.text(_paths(paths), wholetext=True)
    keep = [file_date().alias(date_col)] if date_col else []
    return header_rows(text.select("value", *keep), "value", row, header_field, [date_col] if date_col else [])


def header_rows(
    df: DataFrame,
    text: str,
    row: T.StructType,
    header_field: str = "date",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Header-plus-rows JSON text to rows."""
    element = T.StructType([T.StructField(header_field, T.StringType())])
    for field in row.fields:
        if field.name != header_field:
            element.add(field)
    parsed = df.select(*keep, F.from_json(text, T.ArrayType(element)).alias("__all"))
    rows = parsed.select(
        *keep,
        F.col("__all")[0][header_field].alias(f"__{header_field}"),
        F.posexplode("__all").alias("__pos", "__row"),
    )
    return rows.where(F.col("__pos") > 0).select(
        *keep,
        F.col(f"__{header_field}").alias(header_field),
        *[F.col(f"__row.{f.name}").alias(f.name) for f in element.fields if f.name != header_field],
    )


def with_row_id(df: DataFrame, name: str = "rowid") -> DataFrame:
    """A unique id per row, without moving any row."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_dense_row_id(df: DataFrame, name: str = "rowid") -> DataFrame:
    """0..N-1 per file, in file order, for frames read straight from files.

    The position inside a task comes with the generated id; what is missing is
    how many rows of the file the earlier tasks hold. Those counts are one row
    per file split, so only they are shuffled.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.spark_partition_id().alias("__task"),
        F.monotonically_increasing_id().alias("__id"),
    )
    splits = tagged.groupBy("__file", "__task").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    earlier = Window.partitionBy("__file").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    numbered = attach(tagged, splits, ["__file", "__task"])
    number = F.col("__id") - F.col("__first") + F.col("__offset")
    return numbered.select(*df.columns, number.alias(name))
