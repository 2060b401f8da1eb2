from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.contracts import ContractError
from gaugeworks.operators.quality import missing_time_rule
from gaugeworks.sources import files, tables
from gaugeworks.sources.landing import Landing, ingest_history
from gaugeworks.sources.scratch import scratch_path
from gaugeworks.streaming import ingest as streaming

SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("v", T.DoubleType()),
    ]
)


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


def test_formats_come_from_content(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"PK\x03\x04rest")
    (tmp_path / "b.csv").write_bytes(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1rest")
    (tmp_path / "c.xlsx").write_text("x,y\n1,2\n")
    (tmp_path / "d.txt").write_bytes(b"PAR1....")
    formats = {r["path"].rsplit("/", 1)[1]: r["file_format"] for r in files.classify_files(spark, str(tmp_path)).collect()}
    assert formats == {"a.csv": "excel", "b.csv": "excel", "c.xlsx": "csv", "d.txt": "parquet"}


def test_fingerprints_equal_hashlib_for_small_and_large_files(spark, tmp_path):
    contents = {"small": b"abc", "large": b"x" * 5000}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    found = files.fingerprint_files(spark, str(tmp_path), whole_file_bytes=100).collect()
    assert {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in found} == {
        name: hashlib.sha256(content).hexdigest() for name, content in contents.items()
    }


def test_bad_values_become_null_and_keep_their_line(spark, tmp_path):
    path = write(tmp_path / "x.csv", ",timestamp,v", "0,2024-01-01 00:00:00,1.5", "1,never,2.5", "2,2024-01-01 00:00:10,oops")
    rows = files.read_csv(spark, path, SCHEMA).orderBy("seq").collect()
    assert [r["timestamp"] is None for r in rows] == [False, True, False]
    assert rows[2]["v"] is None
    assert [r[files.CORRUPT] is not None for r in rows] == [False, True, True]


def test_landing_is_idempotent(spark, tmp_path):
    first = write(tmp_path / "in" / "a.csv", ",timestamp,v", "0,2024-01-01 00:00:00,1.5", "1,2024-01-01 00:00:10,2.5")
    store = Landing(spark, str(tmp_path / "store"))
    assert store.ingest(first, "m1") == 1
    assert store.ingest(first, "m1") == 0
    same_content = tmp_path / "in" / "renamed.csv"
    same_content.write_text((tmp_path / "in" / "a.csv").read_text())
    write(tmp_path / "in" / "b.csv", ",timestamp,v", "2,2024-01-01 00:00:20,3.5")
    assert store.ingest(str(tmp_path / "in"), "m1") == 1
    assert store.ingest(first, "m2") == 1
    rows = store.table().groupBy("machine_id").agg(F.collect_set("seq").alias("s"), F.count("*").alias("n")).collect()
    assert {r["machine_id"]: (sorted(r["s"]), r["n"]) for r in rows} == {"m1": ([0, 1, 2], 3), "m2": ([0, 1], 2)}
    history = ingest_history(store.log()).collect()
    assert [r["row_count"] for r in history] == [2, 1, 2]
    assert {"_source_file", "_ingested_at", "_run_id", "_source_file_sha256"} <= set(store.table().columns)


def test_batches_keep_the_columns_of_the_table(spark, tmp_path):
    store = Landing(spark, str(tmp_path / "store"))
    store.ingest(write(tmp_path / "in" / "a.csv", ",timestamp,v", "0,2024-01-01 00:00:00,1.5"), "007")
    assert store.table().first()["machine_id"] == "007"
    other = write(tmp_path / "in" / "b.csv", ",timestamp,w", "0,2024-01-01 00:00:00,1.5")
    with pytest.raises(ContractError):
        store.ingest(other, "007")
    assert store.table().count() == 1 and store.log().count() == 1


def test_files_with_different_headers_land_together(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", ",timestamp,v", "0,2024-01-01 00:00:00,1.5")
    write(tmp_path / "in" / "b.csv", "Unnamed: 0,timestamp,v", "7,2024-01-01 00:00:20,3.5")
    store = Landing(spark, str(tmp_path / "store"))
    assert store.ingest(str(tmp_path / "in"), "m1") == 2
    assert sorted(r["seq"] for r in store.table().collect()) == [0, 7]


@pytest.mark.parametrize(
    "lines",
    [
        ("a,timestamp,a", "1,2024-01-01 00:00:00,2"),
        ("a,b", "1,2"),
        ("a,timestamp",),
        ("machine_id,timestamp", "m,2024-01-01 00:00:00"),
        (),
    ],
)
def test_landing_refuses_broken_sources(spark, tmp_path, lines):
    path = write(tmp_path / "in" / "a.csv", *lines)
    with pytest.raises(ContractError):
        Landing(spark, str(tmp_path / "store")).ingest(path, "m1")


def test_table_names():
    assert tables.table_name("a", "b_1") == "a.b_1"
    with pytest.raises(ValueError):
        tables.table_name("a b")


def test_bucketed_tables_need_no_shuffle_for_their_key(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 10).alias("machine"), "id")
    name = "bucketed_" + tmp_path.name.replace("-", "_")
    tables.write_bucketed(df, name, ["machine"], ["machine", "id"], 4, str(tmp_path / "t"))
    counted = tables.read_table(spark, name).groupBy("machine").count()
    assert "Exchange hashpartitioning" not in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_splits_are_pruned(spark, tmp_path):
    df = spark.range(30).withColumn("split", F.when(F.col("id") < 20, "train").otherwise("test"))
    tables.write_splits(df, str(tmp_path / "s"))
    part = tables.read_split(spark, str(tmp_path / "s"), "test")
    assert part.count() == 10 and part.columns == ["id"]
    assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()


def test_registry_entries(spark, tmp_path):
    document = {
        "model": "forest", "selection_metric": "pr", "pr_auc": 0.5, "rows": 7, "ok": True,
        "note": "text", "feature_columns": ["a", "b", "c"], "parameters": {"trees": 80, "depth": None}, "list": [1],
    }
    (tmp_path / "forest.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "other.json").write_text(json.dumps({"pr_auc": 0.25}))
    found = files.registry_entries(files.read_metric_documents(spark, str(tmp_path))).collect()
    entries = {(r["run"], r["kind"], r["key"]): r["value"] for r in found}
    assert entries == {
        ("forest", "param", "model_name"): "forest",
        ("forest", "param", "model"): "forest",
        ("forest", "param", "selection_metric"): "pr",
        ("forest", "metric", "pr_auc"): "0.5",
        ("forest", "metric", "rows"): "7.0",
        ("forest", "param", "trees"): "80",
        ("forest", "param", "feature_count"): "3",
        ("other", "param", "model_name"): "other",
        ("other", "metric", "pr_auc"): "0.25",
    }


def test_scratch_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if base:
        assert path.startswith(base)


def test_incremental_ingest_reads_each_file_once(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "seq,timestamp,v", "0,2024-01-01 00:00:00,1.5", "1,broken,2.5")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream = streaming.stream_csv(spark, str(tmp_path / "in"), SCHEMA)
        streaming.run_available(stream, out, state, lambda df: streaming.with_stream_lineage(df, "m1"))

    run()
    run()
    assert spark.read.parquet(out).count() == 2
    write(tmp_path / "in" / "b.csv", "seq,timestamp,v", "2,2024-01-01 00:00:10,1.5")
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted((r["seq"], r["_source_file"]) for r in rows) == [(0, "a.csv"), (1, "a.csv"), (2, "b.csv")]


def test_stream_quarantine(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "seq,timestamp,v", "0,2024-01-01 00:00:00,1.5", "1,broken,2.5")
    out = str(tmp_path / "out")
    stream = streaming.stream_csv(spark, str(tmp_path / "in"), SCHEMA)
    streaming.run_quarantine(stream, missing_time_rule("timestamp"), out, str(tmp_path / "state"))
    rows = spark.read.parquet(out).orderBy("seq").collect()
    assert [(r["seq"], r["route"], r["reject_reasons"]) for r in rows] == [
        (0, "accepted", []),
        (1, "rejected", ["missing_timestamp"]),
    ]


def stream_into(spark, store, folder, state):
    streaming.run_landing(streaming.stream_csv(spark, folder, SCHEMA), store, "m1", state)


def test_stream_lands_each_content_once(spark, tmp_path):
    lines = [(",timestamp,v", f"{i},2024-01-01 00:00:00,1.5", f"{i + 100},broken,2.5") for i in range(4)]
    folder, state = tmp_path / "in", str(tmp_path / "state")
    store = Landing(spark, str(tmp_path / "store"))
    write(folder / "a.csv", *lines[0])
    write(folder / "copy of a.csv", *lines[0])
    stream_into(spark, store, str(folder), state)
    assert sorted((r["seq"], r["_source_file"]) for r in store.table().collect()) == [(0, "a.csv"), (100, "a.csv")]
    # A copy in a later batch, a new file, one that a batch ingest has landed before.
    write(folder / "later.csv", *lines[0])
    write(folder / "b.csv", *lines[1])
    other = write(tmp_path / "elsewhere" / "c.csv", *lines[2])
    assert store.ingest(other, "m1", SCHEMA) == 1
    write(folder / "c again.csv", *lines[2])
    stream_into(spark, store, str(folder), state)
    stream_into(spark, store, str(folder), state)
    assert sorted(r["seq"] for r in store.table().collect()) == [0, 1, 2, 100, 101, 102]
    log = sorted((r["source_file"], r["row_count"]) for r in store.log().collect())
    assert log == [("a.csv", 2), ("b.csv", 2), ("c.csv", 2)]
    assert store.table().filter("_corrupt_record IS NOT NULL").count() == 3


@pytest.mark.parametrize("lost", ["after the log", "before the log"])
def test_a_replayed_batch_replaces_itself(spark, tmp_path, monkeypatch, lost):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    store = Landing(spark, str(tmp_path / "store"))
    write(folder / "a.csv", "seq,timestamp,v", "0,2024-01-01 00:00:00,1.5")
    stream_into(spark, store, str(folder), state)
    write(folder / "b.csv", "seq,timestamp,v", "1,2024-01-01 00:00:00,1.5", "2,2024-01-01 00:00:00,1.5")
    write(folder / "copy.csv", "seq,timestamp,v", "1,2024-01-01 00:00:00,1.5", "2,2024-01-01 00:00:00,1.5")
    with monkeypatch.context() as patch:
        if lost == "after the log":
            land = Landing.land

            def failing(self, *args, **options):
                land(self, *args, **options)
                raise RuntimeError("executor lost")

            patch.setattr(Landing, "land", failing)
        else:
            patch.setattr(Landing, "log_path", property(lambda self: f"{self.root}/bronze/_nowhere/\0"))
        with pytest.raises(Exception):
            stream_into(spark, store, str(folder), state)
    stream_into(spark, store, str(folder), state)
    assert sorted(r["seq"] for r in store.table().collect()) == [0, 1, 2]
    assert sorted((r["source_file"], r["row_count"]) for r in store.log().collect()) == [("a.csv", 1), ("b.csv", 2)]


def test_many_small_files_without_their_names_on_the_driver(spark, tmp_path, monkeypatch):
    for i in range(1200):
        header = ",timestamp,v" if i % 3 else "v,timestamp,"
        row = f"{i},2024-01-01 00:00:00,{i}.5" if i % 3 else f"{i}.5,2024-01-01 00:00:00,{i}"
        write(tmp_path / "in" / f"{i // 100}" / f"f {i}.csv", header, row)
    collected = []
    plain = type(spark.range(1)).collect

    def collect(df):
        rows = plain(df)
        collected.append(len(rows))
        return rows

    monkeypatch.setattr(type(spark.range(1)), "collect", collect)
    store = Landing(spark, str(tmp_path / "store"))
    assert store.ingest(str(tmp_path / "in"), "m1", SCHEMA) == 1200
    assert store.ingest(str(tmp_path / "in"), "m1", SCHEMA) == 0
    monkeypatch.undo()
    assert max(collected) <= 2
    found = store.table().agg(F.count("*").alias("n"), F.sum("seq").alias("s"), F.sum("v").alias("v")).first()
    assert (found["n"], found["s"], found["v"]) == (1200, sum(range(1200)), sum(range(1200)) + 600.0)
    assert store.log().agg(F.sum("row_count")).first()[0] == 1200


def test_types_are_inferred_as_a_reader_would(spark, tmp_path):
    path = write(
        tmp_path / "x.csv", "i,l,d,t,b,s,n", "1,3000000000,1.5,2024-01-01 00:00:00,true,x,", "-2,1,2,2024-01-01 00:00:10,false,1,", ",,,,,,",
    )
    read = files.with_inferred_types(files.rows_of_header(spark, path, ["i", "l", "d", "t", "b", "s", "n"], None))
    expected = spark.read.option("header", True).option("inferSchema", True).csv(path)
    assert read.dtypes == expected.dtypes and read.collect() == expected.collect()


def test_checksums_see_what_counts_do_not(spark, tmp_path):
    rows = [(i, float(i % 5), f"x{i % 3}", {"k": i, "a": 1}) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v double, s string, m map<string,int>")
    assert tables.overwrite_verified(df, str(tmp_path / "t")).first()["same_content"]
    shuffled = df.repartition(7, "s").select("m", "s", "v", "id")
    assert tables.verify_saved(shuffled.select(*df.columns), df).first()["same_content"]
    for changed in (
        df.withColumn("v", F.when(F.col("id") == 7, 9.0).otherwise(F.col("v"))),
        df.withColumn("s", F.when(F.col("id") == 7, None).otherwise(F.col("s"))),
        df.withColumn("v", F.col("id") % 5 + 0.0).filter("id > 0").unionByName(df.filter("id = 1")),
        df.withColumn("m", F.when(F.col("id") == 3, F.create_map(F.lit("k"), F.lit(4))).otherwise(F.col("m"))),
    ):
        row = tables.verify_saved(changed, df).first()
        assert row["same_count"] and not row["same_content"]
    empty = tables.verify_saved(df.limit(0), df.limit(0)).first()
    assert empty["same_content"] and empty["saved_rows"] == 0


def unique_into(spark, folder, out, state, lateness=60):
    streaming.run_unique(streaming.stream_csv(spark, folder, SCHEMA), "timestamp", ["seq", "timestamp", "v"], out, state, lateness)


def routed(spark, out):
    return sorted((r["seq"], r["route"]) for r in spark.read.parquet(out).collect())


def test_stream_without_copies_and_with_late_rows(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    head, at = "seq,timestamp,v", "2024-01-01 00:0"
    write(folder / "a.csv", head, f"1,{at}1:00,1.5", f"2,{at}2:00,", f"1,{at}1:00,1.5", f"2,{at}2:00,", "3,never,1.0", "3,never,1.0")
    unique_into(spark, str(folder), out, state)
    assert routed(spark, out) == [(1, "accepted"), (2, "accepted"), (3, "rejected"), (3, "rejected")]
    # The newest is 2:00, so 1:00 is the oldest that is not late: a copy of it is found, an older reading is routed.
    write(folder / "b.csv", head, f"1,{at}1:00,1.5", f"2,{at}2:00,", f"4,{at}0:59,9.0", f"5,{at}1:00,9.0", f"6,{at}9:00,1.0")
    unique_into(spark, str(folder), out, state)
    expected = [(1, "accepted"), (2, "accepted"), (3, "rejected"), (3, "rejected"), (4, "late"), (5, "accepted"), (6, "accepted")]
    assert routed(spark, out) == expected
    unique_into(spark, str(folder), out, state)
    assert routed(spark, out) == expected
    write(folder / "c.csv", head, f"6,{at}9:00,1.0", f"2,{at}2:00,", f"7,{at}8:30,1.0")
    unique_into(spark, str(folder), out, state)
    assert routed(spark, out) == sorted([*expected, (2, "late"), (7, "accepted")])


def test_a_replayed_batch_of_unique_rows_replaces_itself(spark, tmp_path, monkeypatch):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write(folder / "a.csv", "seq,timestamp,v", "1,2024-01-01 00:01:00,1.5")
    unique_into(spark, str(folder), out, state)
    write(folder / "b.csv", "seq,timestamp,v", "1,2024-01-01 00:01:00,1.5", "2,2024-01-01 00:01:10,1.5")
    plain, calls = streaming._earlier, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return plain(*args)

    with monkeypatch.context() as patch:
        patch.setattr(streaming, "_earlier", failing)
        with pytest.raises(Exception):
            unique_into(spark, str(folder), out, state)
    unique_into(spark, str(folder), out, state)
    assert routed(spark, out) == [(1, "accepted"), (2, "accepted")]
