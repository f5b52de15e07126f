"""Landing files: CSV with a header, every column text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lendscope.sources.schemas import STAGING_COLUMNS, staging_schema

# An unquoted empty field is NULL, a quoted one is the empty string; blanks
# around a value belong to it (the loaders trim).
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# On reading, the word for NULL must differ from the empty string: it then
# stands for unquoted empty fields only. Rows are always parsed in full, so that a
# malformed one is found whatever columns are asked for.
READ_OPTIONS = {**CSV_OPTIONS, "nullValue": "\u0000", "emptyValue": "", "columnPruning": "false"}
WRITE_OPTIONS = {**CSV_OPTIONS, "nullValue": "", "emptyValue": '""'}


#: The text of a line that does not have the table's columns, else NULL.
MALFORMED = "_malformed"
_CORRUPT = "_corrupt"


def landing_options(line_breaks: bool = True, strict: bool = False) -> dict[str, str]:
    """How landing files are read. Where quoted fields may hold line breaks, a file is parsed
    as a whole, by one task: deliver many files of moderate size, or declare that there are
    none (``line_breaks=False``), and a large file is read by many tasks. A malformed line
    comes as such, with its text in ``MALFORMED``; ``strict`` fails the read instead."""
    mode = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return {**READ_OPTIONS, **mode, "multiLine": str(line_breaks).lower()}


def landing_schema(table: str, strict: bool = False) -> StructType:
    schema = staging_schema(table)
    return schema if strict else StructType([*schema.fields, StructField(_CORRUPT, StringType())])


def stamped(raw: DataFrame) -> DataFrame:
    """Add when the row's file landed and its path. The file's own time, not
    that of the read, tells which of two deliveries is newer, and stays the
    same when a task is repeated."""
    columns = [F.col(c) for c in raw.columns if c != _CORRUPT]
    if _CORRUPT in raw.columns:
        # Spark reads no file for this column alone, so another one is named beside it
        columns.append(F.concat(F.col(_CORRUPT), F.left(F.coalesce(columns[0], F.lit("")), F.lit(0))).alias(MALFORMED))
    return raw.select(
        *columns,
        F.col("_metadata.file_modification_time").alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def read_staging(spark: SparkSession, path: str, table: str, line_breaks: bool = True, strict: bool = False) -> DataFrame:
    """One landing table, stamped with load time and source file. Malformed lines are among
    the rows, with their text in ``MALFORMED``; a load rejects them and goes on."""
    reader = spark.read.schema(landing_schema(table, strict)).options(**landing_options(line_breaks, strict))
    return stamped(reader.csv(path))


def write_staging(frame: DataFrame, path: str, table: str) -> None:
    """Write the business columns of a landing table as CSV files."""
    (
        frame.select(*STAGING_COLUMNS[table])
        .write.mode("overwrite")
        .options(**WRITE_OPTIONS)
        .csv(path)
    )
