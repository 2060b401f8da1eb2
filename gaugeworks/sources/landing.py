"""Idempotent ingest: a file content lands once per machine, whatever its name."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.contracts import ContractError, check_columns, check_header
from gaugeworks.operators.quality import find_index_column
from gaugeworks.sources.files import (
    FILE,
    file_of_row,
    fingerprint_files,
    having_header,
    list_files,
    listed_file,
    read_headers,
    rows_of_header,
    with_inferred_types,
)
from gaugeworks.sources.scratch import written

LINEAGE = ("machine_id", "_source_file", "_source_file_sha256", "_ingested_at", "_run_id")
LOG_SCHEMA = "machine_id string, source_file string, sha256 string, row_count long, ingested_at timestamp, run_id string"


def with_lineage(
    df: DataFrame, machine_id: str, source_file: str | Column, sha256: str | Column, run_id: str
) -> DataFrame:
    """Add machine, source file, content hash, ingest time and run; names may be literals or columns."""
    return df.withColumns(
        {
            "machine_id": F.lit(machine_id),
            "_source_file": F.lit(source_file),
            "_source_file_sha256": F.lit(sha256),
            "_ingested_at": F.current_timestamp(),
            "_run_id": F.lit(run_id),
        }
    )


def append_once(df: DataFrame, path: str) -> None:
    """Write a batch into the partition of its machine and content hash.

    A retry replaces its own partition, so a batch is never there twice and
    other batches are not touched.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("machine_id", "_source_file_sha256")
        .parquet(path)
    )


def not_yet_ingested(found: DataFrame, log: DataFrame, keys: tuple[str, ...] = ("machine_id", "sha256")) -> DataFrame:
    return found.join(log.select(*keys).distinct(), list(keys), "left_anti")


def ingest_history(log: DataFrame) -> DataFrame:
    """Landings, newest first."""
    return log.orderBy(F.col("ingested_at").desc(), "run_id", "sha256")


@dataclass(frozen=True)
class Landing:
    """A bronze table and its ingest log under one root folder."""

    spark: SparkSession
    root: str

    @property
    def table_path(self) -> str:
        return f"{self.root}/bronze"

    @property
    def log_path(self) -> str:
        return f"{self.root}/ingest_log"

    def log(self) -> DataFrame:
        empty = self.spark.createDataFrame([], LOG_SCHEMA)
        try:
            return self.spark.read.schema(empty.schema).parquet(self.log_path)
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return empty
            raise

    def table(self) -> DataFrame:
        """The bronze table; machine and hash are text even where they look like numbers."""
        found = self.spark.read.parquet(self.table_path).schema
        text = {"machine_id", "_source_file_sha256"}
        fields = [T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in found]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.table_path)

    def _check_columns_match(self, df: DataFrame) -> None:
        """A batch has the columns of the table it joins."""
        try:
            existing = {f.name: f.dataType for f in self.table().schema}
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return
            raise
        arriving = {f.name: f.dataType for f in df.schema}
        if arriving != existing:
            different = sorted(name for name in {*arriving, *existing} if arriving.get(name) != existing.get(name))
            raise ContractError(f"columns differ from those of the table: {different}")

    def ingest(self, path: str, machine_id: str, schema: T.StructType | None = None) -> int:
        """Land every new content under ``path``; returns the number of files landed.

        Files with the same header are read and written by one job, whatever
        their number.  Their names and hashes stay in Spark; the driver sees
        the different headers.
        """
        if list_files(self.spark, path).isEmpty():
            raise ContractError(f"no file with content under {path}")
        fresh = written(read_headers(self.fresh_files(fingerprint_files(self.spark, path), machine_id)), "fresh-files")
        kinds = fresh.groupBy("header").agg(
            F.count("*").alias("files"),
            F.min("modificationTime").alias("since"),
            F.min(F.when(~F.col("has_rows"), F.col("path"))).alias("empty"),
        )
        found = kinds.collect()
        for kind in found:
            check_header(kind["header"])
            if kind["empty"] is not None:
                raise ContractError(f"{kind['empty']} has no rows")
        for kind in found:
            rows = rows_of_header(self.spark, path, kind["header"], schema)
            # Readers leave out files by their time without opening them.
            recent = rows.withColumn(FILE, file_of_row()).filter(F.col("_metadata.file_modification_time") >= F.lit(kind["since"]))
            self.land(recent, having_header(fresh, kind["header"]), machine_id, str(uuid.uuid4()), infer=schema is None)
        return sum(kind["files"] for kind in found)

    def fresh_files(self, found: DataFrame, machine_id: str, run_id: str | None = None) -> DataFrame:
        """One file of each content that the machine has not landed, but for what this very run has."""
        log = self.log() if run_id is None else self.log().filter(F.col("run_id") != run_id)
        named = found.withColumn("machine_id", F.lit(machine_id))
        first = F.min_by(F.struct("path", "modificationTime"), F.col("path"))
        return not_yet_ingested(named, log).groupBy("sha256").agg(first.alias("f")).select("sha256", "f.path", "f.modificationTime")

    def land(self, rows: DataFrame, fresh: DataFrame, machine_id: str, run_id: str, infer: bool = False) -> None:
        """Append the rows that come from fresh files and log these files.

        ``rows`` name their file in the column ``__file``.  A repeated run of
        the same name replaces its own rows and entries.
        """
        names = fresh.select(
            listed_file(F.col("path")).alias(FILE),
            F.element_at(F.split("path", "/"), -1).alias("__name"),
            F.col("sha256").alias("__sha256"),
        )
        located = rows.join(names, FILE).drop(FILE)
        if infer:
            located = with_inferred_types(located)
        raw = [name for name in located.columns if name not in ("__name", "__sha256")]
        check_columns(raw)
        index = find_index_column(raw)
        if index is not None:
            located = located.withColumnRenamed(index, "seq")
        landed = with_lineage(located, machine_id, F.col("__name"), F.col("__sha256"), run_id).drop("__name", "__sha256")
        self._check_columns_match(landed)
        append_once(landed, self.table_path)
        # Partition values only: row counts come from the footers of the files just written.
        counted = (
            self.table()
            .filter(F.col("machine_id") == machine_id)
            .join(fresh.select(F.col("sha256").alias("_source_file_sha256")), "_source_file_sha256", "left_semi")
            .groupBy("_source_file_sha256")
            .agg(F.count("*").alias("row_count"))
        )
        entries = fresh.join(counted, F.col("sha256") == F.col("_source_file_sha256")).select(
            F.lit(machine_id).alias("machine_id"),
            F.element_at(F.split("path", "/"), -1).alias("source_file"),
            "sha256",
            "row_count",
            F.current_timestamp().alias("ingested_at"),
            F.lit(run_id).alias("run_id"),
        )
        entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(self.log_path)
