"""Quality reports of a growing table from one small row per landed batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref
from gaugeworks.operators.quality import duplicate_metric, null_count_metrics, report_metric
from gaugeworks.operators.shape import rows_from_wide
from gaugeworks.sources.scratch import written

BATCH = "batch"


def _portable(value: Column, kind: T.DataType) -> Column:
    """A value in a form that the driver can hand back unchanged in any time zone."""
    return F.unix_micros(value).cast("string") if isinstance(kind, T.TimestampType) else value.cast("string")


def _literal(value: str, kind: T.DataType) -> Column:
    return F.timestamp_micros(F.lit(int(value))) if isinstance(kind, T.TimestampType) else F.lit(value).cast(kind)


class BatchReports:
    """What the batches of a table add to its quality report, in ``path/batch=<number>``.

    A partial row holds exact sums (rows, nulls per column), the range of the
    time and the index, how many of their values no earlier batch has, and a
    mergeable sketch of them.  Reports read partial rows only and equal the
    reports over the whole table.  Numbers grow as batches land; a batch that is
    added again replaces its row.
    """

    def __init__(self, spark: SparkSession, path: str, time: str, index: str | None = None):
        self.spark, self.path = spark, path
        self.keys = {"time": time} | ({"index": index} if index is not None else {})

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def partials(self) -> DataFrame:
        stored = self._stored()
        if stored is None:
            raise ValueError(f"no batch was added to {self.path}")
        return stored

    def add(self, data: DataFrame, number: int, batch_col: str = BATCH) -> None:
        """Add the batch ``number`` of ``data``, whose ``batch_col`` names the batch of a row.

        The batch is read for its sums, and once more per key for its new
        values.  Earlier rows are read only if the range of a key overlaps with
        that of an earlier batch, and then only the key inside that range.
        """
        stored = self._stored()
        if stored is not None:
            last = stored.agg(F.max(BATCH), F.count_if(F.col(BATCH) == number)).first()
            if last[0] > number and not last[1]:
                raise ValueError(f"batch {number} after batch {last[0]}: what later batches added is counted already")
        own, earlier = data.filter(ref(batch_col) == number), data.filter(ref(batch_col) < number)
        names = [name for name in data.columns if name != batch_col]
        measures = [F.count("*").alias("total"), *[F.count_if(ref(name).isNull()).alias(f"null_{i}") for i, name in enumerate(names)]]
        for role, name in self.keys.items():
            hashed = F.when(ref(name).isNotNull(), F.xxhash64(ref(name)))
            measures += [F.min(ref(name)).alias(f"{role}_min"), F.max(ref(name)).alias(f"{role}_max"), F.hll_sketch_agg(hashed).alias(f"{role}_sketch")]
        sums = written(own.agg(*measures), "batch-report")
        fresh = {
            f"{role}_fresh": F.lit(self._fresh(own, earlier, sums, stored, role, name, number)).cast("long")
            for role, name in self.keys.items()
        }
        counts = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(f"null_{i}") for i in range(len(names))]))
        kept = [name for name in sums.columns if not name.startswith("null_")]
        partial = sums.select(*kept, counts.alias("nulls"), *[value.alias(name) for name, value in fresh.items()])
        partial.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{BATCH}={number}")

    def _fresh(
        self, own: DataFrame, earlier: DataFrame, sums: DataFrame, stored: DataFrame | None, role: str, name: str, number: int
    ) -> int:
        """Values of a key that occur in the batch and in none before it."""
        kind = own.schema[name].dataType
        ends = sums.select(*[_portable(F.col(f"{role}_{end}"), kind) for end in ("min", "max")]).first()
        if ends[0] is None:
            return 0
        low, high = (_literal(end, kind) for end in ends)
        rows = own.filter(ref(name).isNotNull()).select(ref(name).alias("value"), F.lit(True).alias("own"))
        if stored is not None:
            before = stored.filter((F.col(BATCH) < number) & (F.col(f"{role}_min") <= high) & (F.col(f"{role}_max") >= low))
            if not before.isEmpty():
                rows = rows.unionByName(earlier.filter(ref(name).between(low, high)).select(ref(name).alias("value"), F.lit(False).alias("own")))
        return rows.groupBy("value").agg(F.bool_and("own").alias("fresh")).agg(F.count_if("fresh")).first()[0]

    def index_statistics(self) -> DataFrame:
        """``index_statistics`` of the whole table, beside the estimate from the merged sketches."""
        nulls = F.col("nulls")[self.keys["index"]]
        return self.partials().agg(
            F.sum(F.col("total") - nulls).alias("total_rows"),
            F.sum("index_fresh").alias("distinct_indexes"),
            F.min("index_min").alias("min_index"),
            F.max("index_max").alias("max_index"),
            F.hll_sketch_estimate(F.hll_union_agg("index_sketch")).alias("estimated_indexes"),
        )

    def quality_report(self, run_id: str) -> DataFrame:
        """``quality_report`` of the whole table."""
        partials = self.partials()
        excess = {}
        for role, name in self.keys.items():
            nulls = F.sum(F.col("nulls")[name])
            excess[role] = F.sum("total") - F.sum(f"{role}_fresh") - (nulls > 0).cast("long")
        wide = partials.agg(
            F.sum("total").alias("total"),
            F.sum(F.col("nulls")[self.keys["time"]]).alias("null_times"),
            *[value.alias(f"{role}_excess") for role, value in excess.items()],
        )
        rows = [
            report_metric("total_rows", F.col("total"), F.lit("INFO")),
            report_metric("null_timestamp_rows", F.col("null_times")),
            *[duplicate_metric(role, F.col(f"{role}_excess")) for role in self.keys],
        ]
        counts = partials.select(F.explode("nulls").alias("column_name", "n")).groupBy("column_name").agg(F.sum("n").alias("null_count"))
        report = rows_from_wide(wide, rows).unionByName(null_count_metrics(counts))
        return report.withColumns({"run_id": F.lit(run_id), "checked_at": F.current_timestamp()})
