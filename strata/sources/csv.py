"""CSV scan under a contract.

Quoting follows RFC 4180: fields may be quoted, a quote inside is doubled,
a backslash is an ordinary character, and a quoted field may hold line
breaks. Every file has its own header, the first line that is not empty;
columns are matched by name, so files of one folder may order them
differently. Records with too few or too many fields are flagged, not
dropped.

A field with line breaks can only be found by reading its file from the
start, so each file is one task; with ``multi_line=False`` (no field holds a
line break) large files are split by byte ranges.
"""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.model import Contract, ErrorType
from strata.operators.normalize import MALFORMED
from strata.operators.validate import quoted
from strata.session import hadoop_path

CORRUPT = "_corrupt_record"
HEADER_READERS = 16

Header = tuple[str, ...]


def csv_options(reader_or_writer):
    """RFC 4180 quoting, for readers and writers alike."""
    return reader_or_writer.option("header", "true").option("quote", '"').option("escape", '"')


def source_files(spark: SparkSession, path: str) -> list[str]:
    """The files a source path (a file, a folder or a pattern) stands for."""
    fs, pattern = hadoop_path(spark, path)
    found = fs.globStatus(pattern)
    if not found:
        raise FileNotFoundError(path)
    out = []
    for entry in found:
        inside = fs.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
        out += [f.getPath().toString() for f in inside if not f.isDirectory() and f.getPath().getName()[0] not in "._"]
    return sorted(out)


def file_header(spark: SparkSession, path: str) -> Header | None:
    """The first line that is not empty; None for a file without one. Reads no
    further than that line, through the file system of the path."""
    jvm, fs_path = spark.sparkContext._jvm, hadoop_path(spark, path)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    codec = codecs.getCodec(fs_path[1])
    stream = fs_path[0].open(fs_path[1])
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = lines.readLine()
        while line is not None and not line.strip("\ufeff\r"):
            line = lines.readLine()
    finally:
        lines.close()
    return None if line is None else tuple(h.strip() for h in next(csv.reader(io.StringIO(line.lstrip("\ufeff")))))


def read_headers(spark: SparkSession, path: str) -> dict[Header, list[str]]:
    """The distinct headers of a source with the files that carry each. One
    short read per file, several at a time; files without any line are left out."""
    groups = headers_of(spark, source_files(spark, path))
    if not groups:
        raise ValueError(f"no header line in '{path}'")
    return groups


def headers_of(spark: SparkSession, files: list[str]) -> dict[Header, list[str]]:
    """``read_headers`` of these files; nothing if none has a line."""
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda f: file_header(spark, f), files))
    groups: dict[Header, list[str]] = {}
    for file, header in zip(files, headers, strict=True):
        if header is not None:
            groups.setdefault(header, []).append(file)
    return groups


def header_errors(headers, contract: Contract, strict_columns: bool) -> list[tuple[str, str, str]]:
    """(column, error_type, details), once for each distinct finding."""
    out: dict[tuple[str, str], str] = {}
    for header in headers:
        for name in contract.names:
            if name not in header:
                out.setdefault((name, ErrorType.MISSING_COLUMN.value), f"declared column is not in the header {list(header)}")
        for name in sorted(set(header)):
            if header.count(name) > 1:
                out.setdefault((name, ErrorType.UNEXPECTED_COLUMN.value), f"header {list(header)} names the column twice")
            elif strict_columns and name not in contract.names:
                out.setdefault((name, ErrorType.UNEXPECTED_COLUMN.value), "the file has this column, the contract does not declare it")
    return [(c, t, d) for (c, t), d in out.items()]


def csv_scan(spark: SparkSession, paths: str | list[str], header, multi_line: bool = True) -> DataFrame:
    """Files with one and the same header: all columns as raw text plus a
    ``_malformed`` flag (normalisation trims)."""
    schema = T.StructType([T.StructField(h, T.StringType(), True) for h in header] + [T.StructField(CORRUPT, T.StringType(), True)])
    reader = (
        csv_options(spark.read.schema(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")
        .option("multiLine", str(multi_line).lower())
    )
    return reader.csv(paths).select(*[quoted(h) for h in header], F.col(CORRUPT).isNotNull().alias(MALFORMED))


def csv_source(spark: SparkSession, headers: dict[Header, list[str]], contract: Contract, multi_line: bool = True) -> DataFrame:
    """The contract's columns of all files, each file's own header deciding which
    of its columns is which."""
    columns = [quoted(n) for n in contract.names]
    scans = [csv_scan(spark, files, header, multi_line).select(*columns, MALFORMED) for header, files in headers.items()]
    return reduce(DataFrame.unionByName, scans)
