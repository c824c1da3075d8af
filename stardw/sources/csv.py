"""CSV source of the raw tables.

* Header CSV read as strings (no schema inference pass), then columns are
  selected **by name** and converted with ``try_cast`` to the fixed raw types,
  so an unparsable value becomes NULL instead of failing the job.
* Null tokens a pandas reader treats as missing (``NA``, ``None``, ``n/a``,
  ``NaN``, empty, ...) are mapped to NULL before the cast, exactly as written:
  a token with blanks around it is text.
* A whole number in float form (``5.0``) is that number; times beyond the
  range of 64-bit nanoseconds are NULL.
* A missing file gives a typed empty table (later joins still resolve); a
  missing column gives a typed NULL column.
* Every file of a folder is read by its own header, so columns may stand in
  another order in each.
* Quoted line breaks are looked for per table, only where free text can hold
  them; such files are split like others (``quoted.py``).
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.functions.exprs import lenient_timestamp
from stardw.functions.lookups import CSV_NULL_TOKENS
from stardw.sources.quoted import quoted_records
from stardw.sources.raw import RAW_SCHEMAS, RawTables

log = logging.getLogger(__name__)

DEFAULT_FILES = {name: f"{name}.csv" for name in RAW_SCHEMAS}
MULTILINE_TABLES = {"reviews"}


def clean_null_tokens(c: Column) -> Column:
    return F.when(~c.isin(CSV_NULL_TOKENS), c)


def typed(c: Column, kind: T.DataType) -> Column:
    """A cleaned CSV string as ``kind``; NULL where it is none."""
    if isinstance(kind, T.IntegralType):
        number = F.trim(c).try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), F.floor(number)).try_cast(kind)
    if isinstance(kind, T.TimestampNTZType):
        return lenient_timestamp(c)
    return c.try_cast(kind)


def _natural_schema(name: str, id_type: T.DataType | None) -> T.StructType:
    schema = RAW_SCHEMAS[name]
    if id_type is None:
        return schema
    ids = {"customer_id", "order_id", "product_id", "seller_id"}
    return T.StructType([T.StructField(f.name, id_type if f.name in ids else f.dataType)
                         for f in schema.fields])


def typed_empty(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    return spark.createDataFrame([], schema or RAW_SCHEMAS[name])


#: How CSV text is taken apart: no blank is trimmed, and an empty field stays ""
#: until the tokens are cleaned.
CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}


def csv_files(spark: SparkSession, path: str) -> list[str] | None:
    """The files under ``path``; None if there is no such path."""
    try:
        return sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The column names in a file's first record (none if it is empty), read
    through the file system that holds it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        text = reader.readLine()
        while text is not None and text.count('"') % 2:
            more = reader.readLine()
            if more is None:
                break
            text += "\n" + more
    finally:
        reader.close()
    return tuple(next(csv.reader([text.removeprefix("\ufeff")]), ())) if text else ()


def files_by_header(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files with the same columns in the same order, together."""
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for header, file in zip(headers, files, strict=True):
        if header:
            out.setdefault(header, []).append(file)
    return out


def _fields(spark: SparkSession, header: tuple[str, ...], files: Sequence[str], multi_line: bool) -> DataFrame:
    """Rows of files with this header, as strings ``c0, c1, ...``."""
    schema = ", ".join(f"c{k} string" for k in range(len(header)))
    if not multi_line:
        return spark.read.options(**CSV_OPTIONS).option("header", True).schema(schema).csv(list(files))
    records = quoted_records(spark, files).where("record > 1 AND text <> ''")
    return records.select(F.from_csv("text", schema, CSV_OPTIONS).alias("row")).select("row.*")


def read_csv_table(spark: SparkSession, path: str, name: str,
                   schema: T.StructType | None = None, multi_line: bool | None = None) -> DataFrame | None:
    """One raw table from a header CSV (file or folder, each file by its own
    header); None if absent.  ``multi_line``: whether fields hold line breaks."""
    schema = schema or RAW_SCHEMAS[name]
    files = csv_files(spark, path)
    if files is None:
        return None
    multi_line = name in MULTILINE_TABLES if multi_line is None else multi_line
    out = None
    for header, group in files_by_header(spark, files).items():
        cols = []
        for f in schema.fields:
            c = F.col(f"c{header.index(f.name)}") if f.name in header else None
            cols.append((F.lit(None).cast(f.dataType) if c is None else typed(clean_null_tokens(c), f.dataType)).alias(f.name))
        df = _fields(spark, header, group, multi_line).select(*cols)
        out = df if out is None else out.unionByName(df)
    return typed_empty(spark, name, schema) if out is None else out


def read_optional(spark: SparkSession, path: str, name: str,
                  schema: T.StructType | None = None) -> DataFrame:
    """A missing source becomes a typed empty table (with a warning)."""
    df = read_csv_table(spark, path, name, schema)
    if df is None:
        log.warning("missing source %s at %s: using an empty table", name, path)
        return typed_empty(spark, name, schema)
    return df


def read_raw_csv(spark: SparkSession, csv_dir: str, files: dict[str, str] | None = None,
                 id_type: T.DataType | None = None) -> RawTables:
    """All seven raw tables from ``csv_dir`` (file names configurable)."""
    files = {**DEFAULT_FILES, **(files or {})}
    tables = {name: read_optional(spark, f"{csv_dir.rstrip('/')}/{files[name]}", name,
                                  _natural_schema(name, id_type))
              for name in RAW_SCHEMAS}
    return RawTables(**tables)


def write_csv_table(df: DataFrame, path: str, null_token: str = "NA") -> None:
    """Header CSV with an explicit null token (used for round trips); values
    keep their blanks and line breaks."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", null_token)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
