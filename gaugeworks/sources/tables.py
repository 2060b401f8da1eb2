"""Writers and named tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import check_identifier, ref, refs


def table_name(*parts: str) -> str:
    """Dotted name from checked identifiers."""
    return ".".join(check_identifier(part, "table name part") for part in parts)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def overwrite_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table, schema included."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    writer = df.write.mode("append").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def table_detail(spark: SparkSession, name: str, count_rows: bool = False) -> DataFrame:
    """Columns, place and kind of a table; ``count_rows`` brings its statistics up to date first."""
    if count_rows:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def write_chronological(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> None:
    """Time-ordered files: file statistics then let readers skip by time range."""
    ranged = df.repartitionByRange(files, *refs(order)) if files else df.repartitionByRange(*refs(order))
    overwrite_parquet(ranged.sortWithinPartitions(*refs(order)), path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One directory per split from one write; readers of a split prune the others."""
    overwrite_parquet(df, path, [split])


def read_split(spark: SparkSession, path: str, part: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).filter(F.col(split) == part).drop(split)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Table bucketed by ``keys``: later joins and windows on them need no shuffle."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*order)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def content_marks(df: DataFrame) -> dict[str, Column]:
    """Row count and a checksum of the rows whatever their order: sum and exclusive or of two hashes of a row.

    Columns come in the order of their names, maps as sorted entries.
    """
    def comparable(field: T.StructField) -> Column:
        column = ref(field.name)
        return F.sort_array(F.map_entries(column)) if isinstance(field.dataType, T.MapType) else column

    columns = [comparable(field) for field in sorted(df.schema.fields, key=lambda field: field.name)]
    first = F.xxhash64(F.lit(0), *columns) if columns else F.lit(0).cast("long")
    second = F.xxhash64(F.lit(1), *columns) if columns else F.lit(0).cast("long")
    return {
        "n": F.count(F.lit(1)),
        "total": F.coalesce(F.sum(first.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")),
        "parity": F.coalesce(F.bit_xor(second), F.lit(0).cast("long")),
    }


def verify_saved(written: DataFrame, expected: DataFrame) -> DataFrame:
    """Row counts of both sides, and whether counts, column types and contents agree."""
    same_schema = [(f.name, f.dataType) for f in written.schema] == [
        (f.name, f.dataType) for f in expected.schema
    ]

    def marked(df: DataFrame, side: str) -> DataFrame:
        return df.agg(*[mark.alias(name) for name, mark in content_marks(df).items()]).withColumn("side", F.lit(side))

    both = marked(written, "saved").unionByName(marked(expected, "expected"))
    wide = both.agg(
        *[
            F.max(F.when(F.col("side") == side, F.col(name))).alias(f"{side}_{name}")
            for side in ("saved", "expected")
            for name in ("n", "total", "parity")
        ]
    )
    return _verdict(wide, same_schema)


def overwrite_verified(df: DataFrame, path: str) -> DataFrame:
    """Write a table and compare what is read back with what was written, as ``verify_saved`` does.

    The rows are marked while they are written: the plan behind ``df`` runs once.
    """
    seen = Observation()
    overwrite_parquet(df.observe(seen, *[mark.alias(name) for name, mark in content_marks(df).items()]), path)
    expected = seen.get
    saved = df.sparkSession.read.parquet(path)
    same_schema = [(f.name, f.dataType) for f in saved.schema] == [(f.name, f.dataType) for f in df.schema]
    marks = content_marks(saved)
    wide = saved.agg(
        *[mark.alias(f"saved_{name}") for name, mark in marks.items()],
        F.lit(expected["n"]).cast("long").alias("expected_n"),
        F.lit(str(expected["total"])).cast("decimal(38,0)").alias("expected_total"),
        F.lit(expected["parity"]).cast("long").alias("expected_parity"),
    )
    return _verdict(wide, same_schema)


def _verdict(wide: DataFrame, same_schema: bool) -> DataFrame:
    same = (F.col("saved_total") == F.col("expected_total")) & (F.col("saved_parity") == F.col("expected_parity"))
    return wide.select(
        F.col("saved_n").alias("saved_rows"),
        F.col("expected_n").alias("expected_rows"),
        (F.col("saved_n") == F.col("expected_n")).alias("same_count"),
        F.lit(same_schema).alias("same_schema"),
        ((F.col("saved_n") == F.col("expected_n")) & same).alias("same_content"),
    )
