"""Delimited bulk data: a header with target column names, no quoting, no escaping."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.text import blank_delimiters
from loadkit.session import setting
from loadkit.sources.records import MALFORMED, UNIT, UNIT_SIZE, SchemaMissing, read_records

# An empty quote option switches quoting off, so quote characters are data.
_NO_QUOTES = {"quote": "", "header": True}


def read_header(spark: SparkSession, path: str, sep: str, charset: str = "UTF-8") -> list[str]:
    """The column names in the header of the first file."""
    return spark.read.options(sep=sep, encoding=charset, **_NO_QUOTES).csv(path).columns


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a part of a file if the file begins there; the rest is not read."""
    for batch in batches:
        if batch.num_rows:
            if batch.column("start")[0].as_py() == 0:
                yield batch.slice(0, 1).select(["path", "line"])
            return


def read_headers(
    spark: SparkSession, paths: Sequence[str], charset: str = "UTF-8"
) -> list[tuple[str, list[str]]]:
    """The headers of delimited files, each with the paths of its files.

    First lines are read by tasks, one for a part of a file, which end behind the first batch of lines.
    The driver gets the paths, which are those of one read, and the headers.
    """
    # A separator that ends no field: lines come whole, in any charset.
    options = {"sep": "\x01", "encoding": charset, "quote": "", "header": False}
    alone = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with setting(spark, "spark.sql.files.openCostInBytes", alone):
        lines = spark.read.schema("line string").options(**options).csv(list(paths))
        firsts = lines.select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "line"
        ).mapInArrow(_first_lines, "path string, line string")
        found = firsts.groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return sorted((row["line"], [unquote(p) for p in row["paths"]]) for row in found)


def read_mixed(
    spark: SparkSession, paths: Sequence[str], sep: str = "|", charset: str = "UTF-8"
) -> DataFrame:
    """Read delimited files whose headers differ in names or order as one frame.

    Files of a header are one scan; columns are put together by name in the order in which headers give
    them, and are null in files without them. An empty file has no header and adds nothing.
    """
    parts = [
        read_delimited(spark, files, sep, charset, header.split(sep))
        for header, files in read_headers(spark, paths, charset)
    ]
    if not parts:
        raise SchemaMissing(f"{paths} have no header")
    added = {MALFORMED, UNIT, UNIT_SIZE}
    names = dict.fromkeys(c for part in parts for c in part.columns if c not in added)
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.select(*[F.col(f"`{c}`") for c in names], MALFORMED, UNIT, UNIT_SIZE)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = "|",
    charset: str = "UTF-8",
    columns: Sequence[str] | None = None,
    mixed: bool = False,
) -> DataFrame:
    """Read delimited files as text columns named by the header.

    Every file must have the same header: a file whose header differs raises instead of loading its
    values into the wrong columns; with `mixed`, see `read_mixed`, it is read by its own. Records with
    too few or too many fields keep their raw text in `_malformed`. An empty field is null.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if mixed:
        return read_mixed(spark, paths, sep, charset)
    names = list(columns) if columns else read_header(spark, paths[0], sep, charset)
    if not names:
        raise SchemaMissing(f"{paths[0]} has no header")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return read_records(
        spark,
        paths,
        "csv",
        schema,
        sep=sep,
        encoding=charset,
        enforceSchema=False,
        **_NO_QUOTES,
    )


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "|",
    replacement: str = " ",
    charset: str = "UTF-8",
    target_bytes: int | None = None,
) -> None:
    """Write records as delimited text; reserved characters in strings are replaced.

    `target_bytes` gathers small packages into units of about that size and splits larger ones; it
    costs a shuffle. Null and the empty string are the same in this format.
    """
    texts = {
        f.name: blank_delimiters(F.col(f"`{f.name}`"), sep, replacement)
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    cleaned = df.withColumns(texts) if texts else df
    # The writer trims fields unless told not to.
    options = {
        "sep": sep,
        "encoding": charset,
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        **_NO_QUOTES,
    }
    if not target_bytes:
        cleaned.write.options(**options).csv(path)
        return
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with setting(df.sparkSession, size, str(target_bytes)):
        cleaned.hint("rebalance").write.options(**options).csv(path)
