"""Lenient readers for the file shapes that reference datasets come in."""

from __future__ import annotations

import gzip
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of a debug run; None reads all.
DEBUG_ROWS: int | None = None


def _limited(df: DataFrame, rows: int | None) -> DataFrame:
    rows = rows if rows is not None else DEBUG_ROWS
    return df.limit(rows) if rows is not None else df


def delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "\t",
    schema: StructType | str | None = None,
    header: bool = True,
    quote: str | None = '"',
    null: str | None = None,
    malformed: str = "pad",
    rows: int | None = None,
) -> DataFrame:
    """CSV, TSV or pipe-separated files.

    ``quote=None`` turns quoting off; ``null`` is a token read as null.
    ``malformed``: "pad" fills short rows with nulls, "drop" leaves bad rows
    out, "fail" stops. Headerless files need a schema; without one all columns
    are text.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("quote", quote or "").option("mode", {"pad": "PERMISSIVE", "drop": "DROPMALFORMED", "fail": "FAILFAST"}[malformed])
    if null is not None:
        reader = reader.option("nullValue", null)
    if schema is not None:
        reader = reader.schema(schema)
    return _limited(reader.csv(path), rows)


def headerless(spark: SparkSession, path: str, names: list[str], sep: str = "\t", **how) -> DataFrame:
    """A file without a header, all columns text."""
    return delimited(spark, path, sep, ", ".join(f"`{n}` string" for n in names), header=False, **how)


def bulk_copy(spark: SparkSession, path: str, schema: str, rows: int | None = None) -> DataFrame:
    """Dumps whose fields end in tab, pipe, tab and whose lines end in tab, pipe."""
    types = [field.strip().rsplit(" ", 1) for field in schema.split(",")]
    lines = spark.read.text(path).select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t").alias("f"))
    return _limited(lines.select(*[F.nullif(F.get("f", i), F.lit("")).try_cast(kind).alias(name.strip("`")) for i, (name, kind) in enumerate(types)]), rows)


def ndjson(spark: SparkSession, path: str, schema: str, starts: str | None = None, key: str = "id", rows: int | None = None) -> DataFrame:
    """One JSON object a line, commas after objects and array brackets tolerated; bad lines are left out.

    The schema is explicit: inferring it would read everything. ``starts``
    keeps objects whose key starts with it.
    """
    text = spark.read.text(path).select(F.regexp_replace(F.trim("value"), r",$", "").alias("line")).filter(F.col("line").startswith("{"))
    parsed = text.select(F.from_json("line", schema, {"mode": "PERMISSIVE"}).alias("o")).filter("o is not null").select("o.*")
    kept = parsed.filter(F.col(key).isNotNull())
    return _limited(kept.filter(F.col(key).startswith(starts)) if starts else kept, rows)


def json_array(spark: SparkSession, path: str, schema: str | None = None, rows: int | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return _limited((reader.schema(schema) if schema else reader).json(path), rows)


def parquet(spark: SparkSession, path: str | list[str], view: str | None = None, rows: int | None = None) -> DataFrame:
    """Parquet files or folders (globs too); ``view`` registers a temporary view."""
    df = _limited(spark.read.parquet(*([path] if isinstance(path, str) else path)), rows)
    if view:
        df.createOrReplaceTempView(view)
    return df


def zip_lines(spark: SparkSession, path: str, member: str, encoding: str = "utf-8") -> DataFrame:
    """(file, member, line): lines of the members of zip archives whose name ends in ``member``.

    One task an archive; members are streamed, never unpacked to disk.
    """

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in sorted(archive.namelist()):
                        if name.endswith(member):
                            with archive.open(name) as raw:
                                held: list[str] = []
                                for line in io.TextIOWrapper(raw, encoding=encoding, newline=""):
                                    held.append(line.rstrip("\r\n"))
                                    if len(held) == 10_000:
                                        yield pd.DataFrame({"file": file, "member": name, "line": held})
                                        held = []
                                yield pd.DataFrame({"file": file, "member": name, "line": pd.Series(held, dtype=str)})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(lines, "file string, member string, line string")


def zip_delimited(spark: SparkSession, path: str, member: str, names: list[str], sep: str = "\t", header: bool = True) -> DataFrame:
    """A separated member of a zip archive, all columns text, short rows padded."""
    lines = zip_lines(spark, path, member)
    if header:
        lines = lines.filter(F.col("line") != sep.join(names))
    schema = ", ".join(f"`{n}` string" for n in names)
    return lines.select(F.from_csv("line", schema, {"sep": sep, "quote": "", "mode": "PERMISSIVE"}).alias("r")).select("r.*")


def zip_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet members of zip archives, one task an archive."""
    import pyarrow.parquet as pq

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in sorted(archive.namelist()):
                        if name.endswith(".parquet"):
                            for part in pq.ParquetFile(io.BytesIO(archive.read(name))).iter_batches():
                                yield part.to_pandas()

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, schema)


def gzip_members(content: bytes) -> list[int]:
    """Offsets at which members of a multi-member gzip start (each verified by its header and first bytes)."""
    found, at = [], content.find(b"\x1f\x8b\x08")
    while at >= 0:
        try:
            gzip.GzipFile(fileobj=io.BytesIO(content[at:])).read(1)
            found.append(at)
        except (OSError, EOFError):
            pass
        at = content.find(b"\x1f\x8b\x08", at + 1)
    return found


def filtered_lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Lines of text files, gzipped ones too, that match a pattern; the filter runs while reading."""
    return spark.read.text(path).filter(F.col("value").rlike(pattern))


def language_files(spark: SparkSession, glob: str, schema: str, languages: list[str]) -> DataFrame:
    """All files of a glob at once, with the language from the row, kept if wanted."""
    return spark.read.option("header", True).schema(schema).csv(glob).withColumn("file", F.input_file_name()).filter(F.lower("language").isin(languages))


def spreadsheet(spark: SparkSession, path: str, sheet: int | str = 0) -> DataFrame:
    """An XLSX sheet as text columns, read by the driver; needs openpyxl."""
    try:
        import openpyxl  # noqa: F401
    except ImportError as missing:
        raise RuntimeError("reading XLSX needs openpyxl") from missing
    frame = pd.read_excel(path, sheet_name=sheet, dtype=str)
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"`{c}` string" for c in frame.columns))


def values(spark: SparkSession, rows: list[tuple], schema: str, view: str | None = None) -> DataFrame:
    """An inline relation."""
    df = spark.createDataFrame(rows, schema)
    if view:
        df.createOrReplaceTempView(view)
    return df
