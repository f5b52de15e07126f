"""Published tables: files written by Spark, shown through views of the catalog.

A table that is replaced as a whole is written to a new folder, and its view is switched to
it last; readers see the old rows or the new ones. Facts lie in month folders of one
place: Spark's dynamic overwrite replaces the months that a load touches and leaves the
others. One writer at a time: who begins creates a view that the catalog grants only once.

The views live as long as the catalog: with a metastore they outlast the session.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

WRITER = "writer"


class WriterBusy(RuntimeError):
    """Another writer has begun and not ended."""


class TableStore:
    """Tables under one root folder on shared storage, shown in one database."""

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.database = database or "lendscope_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]
        place = self.root.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{place}'")

    def _view(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    @contextmanager
    def writing(self) -> Iterator[None]:
        """Only one writer is between these lines; a second one gets ``WriterBusy`` before it does anything.

        A writer that died leaves its mark: ``unlock`` once it is known to be dead.
        """
        run = uuid.uuid4().hex
        try:
            self.spark.sql(f"CREATE VIEW {self._view(WRITER)} AS SELECT '{run}' AS run")
        except AnalysisException as problem:
            if problem.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
            raise WriterBusy(f"another writer is at work on {self.root}; see the view {self.database}.{WRITER}") from problem
        try:
            yield
        finally:
            self.unlock()

    def unlock(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self._view(WRITER)}")

    def stage(self, frame: DataFrame, table: str) -> tuple[DataFrame, str]:
        """The rows that are to replace a table, as read back, and the folder they lie in. Nobody sees them before ``show``."""
        folder = f"{self.root}/{table}/{uuid.uuid4().hex}"
        frame.write.parquet(folder)
        return self.spark.read.schema(frame.schema).parquet(folder), folder

    def show(self, table: str, folder: str, schema: StructType) -> None:
        """Switch the view of a table to a folder."""
        try:
            self.spark.read.parquet(folder)
            rows = "SELECT * FROM parquet.`{}`".format(folder.replace("`", "``"))
        except AnalysisException as problem:
            # a table in month folders that has no rows has no files either
            if problem.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
                raise
            columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
            rows = f"SELECT {columns} WHERE false"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._view(table)} AS {rows}")

    def overwrite_folders(self, table: str, frame: DataFrame, folder: str) -> None:
        """Replace the folders that ``frame`` has rows for; all others keep their files."""
        writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(folder).parquet(f"{self.root}/{table}")
        self.show(table, f"{self.root}/{table}", frame.schema)

    def append(self, table: str, frame: DataFrame, *folders: str) -> None:
        frame.write.mode("append").partitionBy(*folders).parquet(f"{self.root}/{table}")
        self.show(table, f"{self.root}/{table}", frame.schema)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def read(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise ValueError(f"table {table} was never published under {self.root}")
        return self.spark.table(self._view(table))

    def read_or_empty(self, table: str, schema: StructType) -> DataFrame:
        # the optimizer knows that a limit of 0 has no rows, and leaves out what is joined to them
        return self.read(table) if self.exists(table) else self.spark.createDataFrame([], schema).limit(0)
