"""Cases that once went wrong: column order, key types, lost rows, cancelled spreads, colliding keys."""

from __future__ import annotations

import os
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import seeded_digest
from gaugeworks.operators import quality, splits
from gaugeworks.operators.contracts import ContractError
from gaugeworks.operators.ranges import with_group_row_number
from gaugeworks.operators.sequence import ROLLING_ROWS, time_rolling, with_rolling
from gaugeworks.plans import medallion
from gaugeworks.roles import SeriesRoles
from gaugeworks.sources.files import classify_files, fingerprint_files, read_csv, write_text_files
from gaugeworks.sources.landing import Landing
from gaugeworks.sources.scratch import drop_written, scratch_folder, written

SCHEMA = T.StructType([T.StructField("seq", T.LongType()), T.StructField("TP2", T.DoubleType()), T.StructField("TP3", T.DoubleType())])


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        file.write(text)


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    folder = str(tmp_path / "raw files")
    write(folder, "plain.csv", "seq,TP2,TP3\n1,2.0,3.0\n")
    write(folder, "other order [1].csv", "TP3,Unnamed: 0,TP2\n3.5,2,2.5\nbad,3,2.75\n")
    rows = read_csv(spark, folder, SCHEMA).orderBy("seq").collect()
    assert [(r.seq, r.TP2, r.TP3) for r in rows] == [(1, 2.0, 3.0), (2, 2.5, 3.5), (3, 2.75, None)]
    assert rows[2]._corrupt_record == "bad,3,2.75"
    for header in ("seq,TP2\n1,2\n", "seq,TP2,TP3,TP9\n1,2,3,4\n"):
        write(str(tmp_path / "wrong"), "a.csv", header)
        with pytest.raises(ContractError):
            read_csv(spark, str(tmp_path / "wrong"), SCHEMA).collect()


def test_landing_of_reordered_files_and_names_with_spaces(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(folder, "a b+c.csv", "seq,TP3,timestamp,TP2\n1,3.0,2024-01-01 00:00:00,2.0\n")
    write(folder, "d.csv", "seq,timestamp,TP2,TP3\n2,2024-01-01 00:00:01,2.0,3.0\n")
    timed = T.StructType([SCHEMA.fields[0], T.StructField("timestamp", T.TimestampType()), *SCHEMA.fields[1:]])
    store = Landing(spark, str(tmp_path / "root"))
    assert store.ingest(folder, "m1", timed) == 2
    assert {(r.seq, r.TP2, r.TP3, r._source_file) for r in store.table().collect()} == {(1, 2.0, 3.0, "a b+c.csv"), (2, 2.0, 3.0, "d.csv")}
    assert store.ingest(folder, "m1", timed) == 0
    assert classify_files(spark, folder).count() == 2


@pytest.mark.parametrize("kind", ["decimal(30,10)", "boolean", "binary", "double", "string"])
@pytest.mark.parametrize("rows_per_range", [10, 1000])
def test_ordered_ranges_take_the_same_keys_at_any_size(spark, kind, rows_per_range):
    frame = spark.range(100).select(((F.col("id") * 37 % 100) / 7).cast("decimal(30,10)").alias("k"), "id")
    key = (F.col("k") > 5) if kind == "boolean" else F.col("k").cast("string").cast("binary") if kind == "binary" else F.col("k").cast(kind)
    frame = frame.withColumn("k", key).withColumn("g", F.lit(1))
    found = with_group_row_number(frame, ["g"], ["k", "id"], rows_per_range=rows_per_range)
    keyed = sorted(((r.k if not isinstance(r.k, bytearray) else bytes(r.k)), r.id) for r in frame.collect())
    assert [r.row_number for r in sorted(found.collect(), key=lambda r: ((r.k if not isinstance(r.k, bytearray) else bytes(r.k)), r.id))] == list(range(1, len(keyed) + 1))


def test_unfit_keys_are_refused_at_any_size(spark):
    frame = spark.range(5).select("id", F.array("id").alias("k"))
    for rows_per_range in (2, 100):
        with pytest.raises(TypeError):
            with_group_row_number(frame, ["id"], ["k"], rows_per_range=rows_per_range)


def test_rows_without_a_class_or_a_time_are_rejected_not_lost(spark):
    frame = spark.range(40).select("id", F.when(F.col("id") < 20, F.col("id") % 2).when(F.col("id") < 30, F.lit(2)).alias("label"))
    found = splits.stratified_split(frame, "label", ["id"])
    assert found.filter("split IS NULL").isEmpty()
    assert found.filter(F.col("split") == splits.REJECTED).count() == 20
    times = spark.range(40).select("id", F.when(F.col("id") % 4 != 0, F.timestamp_seconds(F.col("id"))).alias("ts"))
    found = splits.chronological_split(times, "ts")
    assert found.filter(F.col("split") == splits.REJECTED).count() == 10


def test_spread_of_values_with_a_large_offset(spark):
    rows = [(i, 1e9 + (i % 7) / 300) for i in range(100)]
    frame = spark.createDataFrame(rows, "id long, v double").withColumn("ts", F.timestamp_seconds("id"))
    roles = SeriesRoles(time="ts", seq=("id",), analog=("v",))
    found = {r.epoch: r.v_rolling_std_5m for r in time_rolling(frame, roles).collect()}
    values = [(i % 7) / 300 for i in range(100)]
    mean = sum(values) / 100
    expected = (sum((v - mean) ** 2 for v in values) / 99) ** 0.5
    assert found[99] == pytest.approx(expected, rel=1e-3)


def test_spreads_at_different_levels_and_with_drift(spark):
    """Machines at 0 and a billion, a drift over days, several readings in a second, gaps in time."""
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        machine, second = i % 3, rng.randrange(20_000) if i % 2 else 30_000 + i // 5
        rows.append((i, machine, second, machine * 1e9 / 2 + second / 50 + rng.random() / 100))
    frame = spark.createDataFrame(rows, "id long, machine int, second long, v double").withColumn("ts", F.timestamp_seconds("second"))
    roles = SeriesRoles(time="ts", seq=("id",), machine=("machine",), analog=("v",))
    for rows_per_range in (10**9, 200):
        found = {(r.machine, r.epoch): r.v_rolling_std_5m for r in time_rolling(frame, roles, rows_per_range=rows_per_range).collect()}
        for (machine, epoch), spread in found.items():
            values = [Fraction(v) for _, m, s, v in rows if m == machine and epoch - 290 <= s <= epoch]
            if len(values) == 1:
                assert spread is None
                continue
            mean = sum(values) / len(values)
            expected = float(sum((v - mean) ** 2 for v in values) / (len(values) - 1)) ** 0.5
            assert spread == pytest.approx(expected, rel=1e-5, abs=2e-6)


def test_composite_keys_do_not_collide(spark):
    rows = [("a", "b:c0"), ("a:b", "c0"), ("a", None), ("a", ""), ("1:a", "b")]
    frame = spark.createDataFrame(rows, "x string, y string")
    assert frame.select(seeded_digest(42, ["x", "y"])).distinct().count() == len(rows)
    nulls = spark.createDataFrame([(None,), ("",)], "x string")
    assert nulls.select(seeded_digest(42, ["x"])).distinct().count() == 2
    many = spark.createDataFrame([(f"k{'' if i % 2 else ':'}", f"{':' if i % 2 else ''}{i // 2}", 0) for i in range(40)], "x string, y string, label int")
    counts = {0: 40}
    assert splits.take_per_class(many, "label", ["x", "y"], {0: 5}, counts).count() == 5


def test_readings_of_overlapping_files_count_once(spark):
    rows = [("m1", 1, 2.0, "a", "2024-01-01 00:00:00"), ("m1", 1, 2.0, "b", "2024-01-02 00:00:00"), ("m2", 1, 2.0, "c", "2024-01-01 00:00:00"), ("m1", 2, None, "b", "2024-01-02 00:00:00")]
    frame = spark.createDataFrame(rows, "machine_id string, seq long, v double, _source_file string, at string").withColumn("_ingested_at", F.col("at").cast("timestamp")).drop("at")
    kept = quality.remove_exact_duplicates(frame, medallion.LANDED).collect()
    assert sorted((r.machine_id, r.seq, r._source_file) for r in kept) == [("m1", 1, "a"), ("m1", 2, "b"), ("m2", 1, "c")]
    assert kept[0].__fields__ == frame.columns


def test_fractional_index_is_no_sequence(spark):
    frame = spark.createDataFrame([(1.0,), (2.4,), (2.6,), (4.0,)], "i double")
    assert quality.arithmetic_sequence_check(frame, "i").first().is_sequence is False
    assert quality.arithmetic_sequence_check(spark.range(1, 5), "id").first().is_sequence is True


def test_scratch_tables_lie_in_the_shared_folder(spark):
    assert scratch_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = written(spark.range(3), "probe")
    assert kept.count() == 3 and all(scratch_folder(spark).rstrip("/") in name for name in kept.inputFiles())
    drop_written(kept)
    with pytest.raises(ValueError):
        drop_written(spark.read.parquet("/root/testdata/sf0.001/region.parquet"))


def test_decimals_keep_their_digits_in_cut_points(spark):
    big = Decimal("12345678901234567890.1234567891")
    frame = spark.createDataFrame([(big + i * Decimal("0.0000000001"), i) for i in range(60)], "k decimal(38,10), id long")
    found = with_group_row_number(frame.withColumn("g", F.lit(0)), ["g"], ["k"], rows_per_range=7)
    assert all(r.row_number == r.id + 1 for r in found.collect())


def test_time_rolling_costs_the_same_in_a_dense_series(spark):
    roles = SeriesRoles(time="t", analog=("v",))
    frame = spark.range(1200).select(
        F.timestamp_seconds(F.col("id") + 1_700_000_000 + F.when(F.col("id") > 700, 400).otherwise(0)).alias("t"),
        F.when(F.col("id") % 11 != 0, F.sin(F.col("id") * 1.7) * 50).alias("v"),
    )
    rolled = time_rolling(frame, roles)
    # Running aggregates only: no frame is summed up again for every row.
    plan = rolled._jdf.queryExecution().optimizedPlan().toString()
    assert "-290" not in plan and "unboundedpreceding" in plan
    values = {int(r.epoch): r.v for r in frame.select(F.unix_seconds("t").alias("epoch"), "v").collect()}
    for row in rolled.collect():
        own = [values[e] for e in range(row.epoch - 290, row.epoch + 1) if values.get(e) is not None]
        if not own:
            assert row.v_rolling_mean_5m is None and row.v_rolling_min_5m is None
            continue
        assert (row.v_rolling_min_5m, row.v_rolling_max_5m) == (min(own), max(own))
        assert row.v_rolling_mean_5m == pytest.approx(sum(own) / len(own), abs=1e-9)
        if len(own) > 1:
            mean = sum(own) / len(own)
            assert row.v_rolling_std_5m == pytest.approx((sum((v - mean) ** 2 for v in own) / (len(own) - 1)) ** 0.5, rel=1e-9, abs=1e-9)
        else:
            assert row.v_rolling_std_5m is None


def test_many_text_files_are_written_in_place(spark, tmp_path):
    """Tasks leave nothing for the driver to move, and every key has its one file, in order."""
    rows = [(k % 40 if k % 41 else None, 1000 - k) for k in range(400)] + [(7, 990), (7, None)]
    folder = str(tmp_path / "a b")
    write_text_files(spark.createDataFrame(rows, "owner long, n long").repartition(9), folder, "owner", "n", ["n"])
    found = sorted(os.path.relpath(os.path.join(at, name), folder) for at, _, names in os.walk(folder) for name in names)
    names = {"__HIVE_DEFAULT_PARTITION__" if owner is None else str(owner): owner for owner, _ in rows}
    assert found == sorted(f"owner={name}/lines.txt" for name in names)
    for name, owner in names.items():
        own = sorted((n for k, n in rows if k == owner), key=lambda n: (n is not None, n))
        with open(f"{folder}/owner={name}/lines.txt") as file:
            assert file.read() == "".join(f"{'' if n is None else n}\n" for n in own)
    assert fingerprint_files(spark, folder, whole_file_bytes=40).count() == len(names)


def test_rolling_rows_are_looked_up_not_aggregated_anew(spark):
    """Levels of a billion, nulls, infinities and NaN; decimals keep their digits."""
    rng = random.Random(11)
    odd = {5: float("nan"), 60: float("inf"), 100: float("-inf")}
    rows = [(k % 3, k, None if k % 13 == 0 or 300 < k < 420 else odd.get(k, 1e9 * (k % 3) + rng.random())) for k in range(600)]
    frame = spark.createDataFrame(rows, "machine int, id long, v double").withColumns(
        {"ts": F.timestamp_seconds("id"), "d": F.col("id").cast("decimal(20,3)") / 7, "same": F.lit(0.1), "w": F.lit(2.5)}
    )
    roles = SeriesRoles(time="ts", seq=("id",), machine=("machine",), analog=("v", "d", "same", "w"))
    rolled = with_rolling(frame, roles)
    assert rolled.columns == [*frame.columns, *[f"{n}_rolling_{k}_5m" for n in roles.analog for k in ("mean", "std", "min", "max")]]
    assert rolled.schema["d_rolling_mean_5m"].dataType.simpleString().startswith("decimal")
    assert "stddev(v" not in rolled._jdf.queryExecution().optimizedPlan().toString()
    for row in rolled.collect():
        own = [v for m, k, v in rows if m == row.machine and row.id - 3 * (ROLLING_ROWS - 1) <= k <= row.id and v is not None]
        found = (row.v_rolling_mean_5m, row.v_rolling_std_5m, row.v_rolling_min_5m, row.v_rolling_max_5m)
        assert row.same_rolling_std_5m in (None, 0.0)
        if not own:
            assert found == (None,) * 4
            continue
        assert (found[1] is None) == (len(own) == 1)
        if any(v != v or v in (float("inf"), float("-inf")) for v in own):
            assert found[1] is None or found[1] != found[1]
            continue
        assert found[2:] == (min(own), max(own)) and found[0] == pytest.approx(sum(own) / len(own), rel=1e-15)
        if len(own) > 1:
            exact = [Fraction(v) for v in own]
            mean = sum(exact) / len(exact)
            assert found[1] == pytest.approx(float(sum((v - mean) ** 2 for v in exact) / (len(exact) - 1)) ** 0.5, rel=1e-9)
