"""Delimited record files: ``||`` ends a record, the four characters ``\\x01`` end a field.

Records are split first, so line breaks inside a field survive. The first non-empty record of each
file names its columns; every column is text.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import storage

# Fixed values of the export format: the separator is four printable characters, not one control byte.
FIELD_SEP = "\\x01"
RECORD_SEP = "||"
_FITS = "_fits"

# Bytes of a file read at first to find its header; more only if the first record is longer.
HEADER_BYTES = 1 << 16


def record_text(value: Column) -> Column:
    """Line ends as ``\\n``, and none at the end of a record (the file's own final line end)."""
    unix = F.replace(F.replace(value, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.rtrim(unix, F.lit("\n"))


def split_fields(value: Column, field_sep: str = FIELD_SEP) -> Column:
    return F.split(value, re.escape(field_sep), -1)


def _records(reader, paths: str | list[str]) -> DataFrame:
    return reader.text(paths).select(record_text(F.col("value")).alias("value")).where(F.col("value") != "")


def file_header(spark: SparkSession, path: str, record_sep: str = RECORD_SEP) -> str | None:
    """The first non-empty record of a file, from its first bytes; None for a file without records."""
    size = HEADER_BYTES
    while True:
        raw = storage.first_bytes(spark, path, size)
        *whole, rest = raw.split(record_sep.encode())
        if len(raw) < size:  # the file ends here, and so does its last record
            whole.append(rest)
        for record in whole:
            text = record.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n").rstrip("\n")
            if text:
                return text
        if len(raw) < size:
            return None
        size *= 16


def file_layouts(spark: SparkSession, paths: str | list[str], record_sep: str = RECORD_SEP) -> dict[str, list[str]]:
    """Header -> files that have it, in the order of the files; files without records are left out.

    One small read per file, several at a time, as listing the files takes.
    """
    named = [f for p in ([paths] if isinstance(paths, str) else paths) for f in storage.files_at(spark, p)]
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: file_header(spark, f, record_sep), named))
    out: dict[str, list[str]] = {}
    for file, header in zip(named, headers):
        if header is not None:
            out.setdefault(header, []).append(file)
    return out


def fields_to_columns(records: DataFrame, header: str, columns: list[str], field_sep: str = FIELD_SEP) -> DataFrame:
    """Records of files with one ``header`` to ``columns`` by name, and whether a record has as many fields as the header.

    Header records are dropped by comparison; a column the header lacks is null.
    """
    names = header.split(field_sep)
    body = records.where(F.col("value") != header).select(split_fields(F.col("value"), field_sep).alias("f"))
    value = {n: F.get("f", F.lit(k)) for k, n in reversed(list(enumerate(names)))}
    return body.select(
        *[value.get(c, F.lit(None).cast("string")).alias(c) for c in columns], (F.size("f") == len(names)).alias(_FITS)
    )


def counted_records(rows: DataFrame, observation: Observation | None, fits: Column | None = None) -> DataFrame:
    """``rows`` that fit, with ``bad_records`` and ``good_records`` counted by the ``observation`` as they are read."""
    fits = F.lit(True) if fits is None else fits
    if observation is not None:
        rows = rows.observe(observation, F.count_if(~fits).alias("bad_records"), F.count_if(fits).alias("good_records"))
    return rows


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    field_sep: str = FIELD_SEP,
    record_sep: str = RECORD_SEP,
    observation: Observation | None = None,
) -> DataFrame:
    """Scan delimited files, each byte once, after a look at the first bytes of each.

    Fields are mapped by the header of their own file, so files may differ in the order of their columns. Without
    ``columns`` files of different layouts are united by column name. With ``columns`` (the feed's known layout) a
    file that has other names is an error. Records with another number of fields than their header are dropped and,
    with an ``observation``, counted as ``bad_records``.
    """
    layouts = file_layouts(spark, paths, record_sep)
    if columns is not None:
        for header, named in layouts.items():
            if sorted(header.split(field_sep)) != sorted(columns):
                raise ValueError(f"{named[0]} has the columns {header.split(field_sep)} instead of {columns}")
    names = columns or list(dict.fromkeys(c for header in layouts for c in header.split(field_sep)))
    if not layouts:
        empty = StructType([StructField(c, StringType()) for c in names])
        return counted_records(spark.createDataFrame([], empty), observation)
    reader = lambda: spark.read.option("lineSep", record_sep)
    parts = [fields_to_columns(_records(reader(), named), header, names, field_sep) for header, named in layouts.items()]
    united = reduce(DataFrame.unionByName, parts)
    return counted_records(united, observation, F.col(_FITS)).where(_FITS).drop(_FITS)
