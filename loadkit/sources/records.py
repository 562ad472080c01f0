"""Record sources: schema'd scans, unit metadata, file listings and the drain-the-queue stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT = "_unit"
UNIT_SIZE = "_unit_size"
MALFORMED = "_malformed"

# Formats whose reader can keep the raw text of a malformed record.
_TEXT_FORMATS = frozenset({"csv", "json", "xml"})


class SchemaMissing(ValueError):
    """A unit does not carry the schema or the fields that the load needs."""


def _with_malformed(fmt: str, schema: T.StructType) -> T.StructType:
    if fmt in _TEXT_FORMATS and MALFORMED not in schema.fieldNames():
        return T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    return schema


def _reader_options(fmt: str, options: dict) -> dict:
    if fmt not in _TEXT_FORMATS:
        return options
    fixed = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    if fmt == "csv":
        # With pruning on, the parser no longer sees that a record has too few or too many fields.
        fixed["columnPruning"] = False
    return {**fixed, **options}


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    schema: T.StructType | None,
    **options,
) -> DataFrame:
    """Scan record-oriented files with a declared schema.

    Text formats keep malformed records: their raw text lands in `_malformed`. Each row also carries
    the file it came from and its size.
    """
    if schema is None:
        raise SchemaMissing(f"no schema given for {fmt} records")
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(fmt).schema(_with_malformed(fmt, schema))
    return with_unit(reader.options(**_reader_options(fmt, options)).load(paths))


def with_unit(df: DataFrame) -> DataFrame:
    """Add the identity and the byte size of the file each row was read from."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(UNIT),
        F.col("_metadata.file_size").alias(UNIT_SIZE),
    )


def require_schema(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Fail before any work when a unit lacks fields that the load needs."""
    missing = [name for name in fields if name not in df.columns]
    if missing:
        raise SchemaMissing(f"missing fields {missing}, found {df.columns}")
    return df


def list_units(spark: SparkSession, directory: str, pattern: str | None = None) -> DataFrame:
    """The waiting files of a directory with their sizes; file contents are not read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(directory).select(
        F.col("path").alias(UNIT),
        F.col("length").alias(UNIT_SIZE),
        F.col("modificationTime").alias("modified"),
    )


def read_unit_stream(
    spark: SparkSession,
    directory: str,
    fmt: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
    **options,
) -> DataFrame:
    """Stream the files of a directory, at most `max_files` or `max_bytes` of them per batch."""
    reader = spark.readStream.format(fmt).schema(_with_malformed(fmt, schema))
    reader = reader.options(**_reader_options(fmt, options))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return with_unit(reader.load(directory))
