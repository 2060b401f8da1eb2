"""What the operators share: input columns, packed records, running totals over a sorted table."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.sources.scratch import written

Batches = Iterator[pa.RecordBatch]


def text_bytes(name: str) -> Column:
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(ref(name).cast("string").cast("binary"), F.lit(bytearray(b"")))


def whole_text(name: str) -> Column:
    """A text column, null as empty."""
    return F.coalesce(ref(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores behind it until no column has that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def batches_of(schema: pa.Schema, rows: Iterator[tuple], size: int = 2_000, max_bytes: int = 16 << 20) -> Batches:
    """Record batches of bounded rows and bytes from row tuples."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(value) for value in row if isinstance(value, (bytes, str, list)))
        if len(held) >= size or weight >= max_bytes:
            yield _batch(schema, held)
            held, weight = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema
    )


def pack_planes(values: np.ndarray) -> bytes:
    """Integers as byte planes: planes that are alike compress to almost nothing in a shuffle."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def unpack_planes(data: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def forget_shuffles(spark: SparkSession) -> None:
    """Let the executors delete shuffle files that no plan can read any more.

    Spark removes them when the driver's garbage is collected, which a driver
    with little to do may put off while step after step fills the disks.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        # The scheduler lets go of the last job only when it has seen another.
        spark.range(1).count()


@contextmanager
def batches_up_to(spark: SparkSession, size: str) -> Iterator[None]:
    """Jobs started inside hand Python batches of about so many bytes at most.

    A batch exists in the JVM, in the pipe and in the worker at once, per task.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def add_shards(parts: Iterator[tuple[int, np.ndarray]], into: Callable[[np.ndarray | None, np.ndarray], np.ndarray]):
    """Fold the arrays of equal consecutive shard numbers; one shard is in memory at a time."""
    current, total = None, None
    for shard, values in parts:
        if shard != current:
            if current is not None:
                yield current, total
            current, total = shard, None
        total = into(total, values)
    if current is not None:
        yield current, total


def with_running_totals(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    name: str,
    group: str | None = None,
    label: str = "sorted",
) -> DataFrame:
    """Add the sum of ``value`` over the rows before each row, in a total order, without a single-task window.

    Rows are range-sorted by ``order`` (which begins with ``group`` where one is
    given) and summed inside their partition; a partition starts from what the
    earlier partitions hold, of the same group if there are groups.  The driver
    sees one row per partition.  The sorted table is written, so the partition
    of a row is settled once.
    """
    part, local, first = "__part", "__local", "__first"
    ordered = df.repartitionByRange(*[ref(column) for column in order]).sortWithinPartitions(
        *[ref(column) for column in order]
    )
    base = ordered.withColumns(
        {part: F.lit(0), local: F.lit(0).cast("long"), first: F.lit(False)}
    )

    def number(batches: Batches) -> Batches:
        index = TaskContext.get().partitionId()
        held, current, began = 0, None, False
        only_first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.cumsum(values)
            if group is None:
                starts = held + total - values
                held += int(total[-1])
                firsts = np.ones(len(values), bool)
            else:
                keys = batch.column(group)
                changed = _changes(keys, current, began)
                starts, held, firsts, only_first = _grouped(values, total, changed, held, only_first)
                current, began = keys[len(keys) - 1].as_py(), True
            columns = dict(zip(batch.schema.names, batch.columns))
            columns[part] = pa.array(np.full(len(values), index, np.int32))
            columns[local] = pa.array(starts)
            columns[first] = pa.array(firsts)
            yield pa.RecordBatch.from_arrays([columns[n] for n in batch.schema.names], batch.schema.names)

    placed = written(base.mapInArrow(number, base.schema), label, compression="zstd")
    sums = placed.groupBy(part).agg(
        F.sum(F.when(F.col(first), ref(value))).alias("first_total"),
        F.min(F.col(first)).alias("one_group"),
        *(
            []
            if group is None
            else [
                F.min_by(F.struct(ref(group).alias("key")), F.struct(~F.col(first), F.col(local))).alias("first_key"),
                F.max_by(F.struct(ref(group).alias("key")), F.struct(*[ref(c).alias(f"o{i}") for i, c in enumerate(order)])).alias("last_key"),
                F.max_by(F.col(local) + ref(value), F.struct(*[ref(c).alias(f"o{i}") for i, c in enumerate(order)])).alias("last_total"),
            ]
        ),
    )
    offsets, carried, key = {}, 0, None
    for row in sorted(sums.collect(), key=lambda r: r[part]):
        if group is None:
            offsets[row[part]] = carried
            carried += row["first_total"] or 0
            continue
        same = key is not None and row["first_key"]["key"] == key[0]
        offsets[row[part]] = carried if same else 0
        # A partition that is one group adds to what it continues.
        carried = (offsets[row[part]] if row["one_group"] else 0) + row["last_total"]
        key = (row["last_key"]["key"],)
    mapping = placed.sparkSession.createDataFrame(
        [(part_id, int(offset)) for part_id, offset in offsets.items()], f"{part} int, __offset long"
    )
    # One row per partition: small by construction.
    return (
        placed.join(F.broadcast(mapping), part)
        .withColumn(name, F.col(local) + F.when(F.col(first), F.col("__offset")).otherwise(0))
        .drop(part, local, first, "__offset")
    )


def _changes(keys: pa.Array, current, began: bool) -> np.ndarray:
    """True where a row's group differs from the row before it (nulls are one group)."""
    values = keys.to_pylist()
    before = [current, *values[:-1]]
    changed = np.fromiter((a != b for a, b in zip(values, before)), bool, len(values))
    if not began:
        changed[0] = False
    return changed


def _grouped(values, total, changed, held, only_first):
    """Sums before each row inside its group; what is held after the last row; rows of the first group."""
    before = total - values
    group = np.cumsum(changed)
    at = np.flatnonzero(changed)
    base = np.concatenate([[-held], before[at]])
    starts = before - base[group]
    firsts = (group == 0) & only_first
    return starts, int(starts[-1] + values[-1]), firsts, only_first and not len(at)
