"""Sources and sinks: data written to scratch, read back, compared with the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import SCORES_SQL, SPLIT_SQL, Registry, events, labelled, scores
from gaugeworks.functions.columns import epoch_seconds
from gaugeworks.operators import quality, runs, splits
from gaugeworks.operators.evaluation import compare_models
from gaugeworks.sources import files, landing, tables
from gaugeworks.sources.scratch import scratch_path, written
from gaugeworks.streaming import ingest as streaming

checks = Registry()

CSV_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def csv_copy(spark, sf_dir, broken: bool = False, parts: int | None = None) -> str:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    if broken:
        text = F.when(F.col("event_id") % 97 == 0, F.lit("no time")).otherwise(text)
    source = events(spark, sf_dir).select(
        F.col("event_id").alias("_c0"), text.alias("timestamp"), "user_id", "value"
    )
    if parts:
        source = source.repartition(parts, "_c0")
    path = scratch_path(spark, "csv")
    source.write.option("header", True).csv(path)
    return path


def copy_file(spark, source: str, target: str) -> None:
    """Copy a file inside the shared folder."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    come, go = path(source), path(target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(come.getFileSystem(conf), come, go.getFileSystem(conf), go, False, conf)


@checks.add(
    "src1_csv_scan",
    """SELECT event_id AS seq, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, user_id, value FROM events""",
)
def _(spark, sf_dir):
    read = files.read_csv(spark, csv_copy(spark, sf_dir), CSV_SCHEMA)
    return read.select("seq", epoch_seconds(F.col("timestamp")).alias("epoch"), "user_id", "value")


@checks.add(
    "src1_reordered_header",
    """SELECT event_id AS seq, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, user_id, value FROM events""",
)
def _(spark, sf_dir):
    """Half of the files have their columns in another order."""
    path = csv_copy(spark, sf_dir, parts=4)
    both = spark.read.option("header", True).csv(path)
    even = F.col("_c0").cast("long") % 2 == 0
    folder = scratch_path(spark, "mixed")
    both.filter(even).write.option("header", True).csv(f"{folder}/a")
    both.filter(~even).select("value", "timestamp", "_c0", "user_id").write.option("header", True).csv(f"{folder}/b")
    read = files.read_csv(spark, [f"{folder}/a", f"{folder}/b"], CSV_SCHEMA)
    return read.select("seq", epoch_seconds(F.col("timestamp")).alias("epoch"), "user_id", "value")


@checks.add(
    "src1_csv_scan_permissive",
    """SELECT count(*) AS row_count, count(*) FILTER (event_id % 97 = 0) AS null_times,
              count(*) FILTER (event_id % 97 = 0) AS kept_lines, round(sum(value), 4) AS value_sum FROM events""",
)
def _(spark, sf_dir):
    read = files.read_csv(spark, csv_copy(spark, sf_dir, broken=True), CSV_SCHEMA)
    return read.select("timestamp", "value", files.CORRUPT).agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("timestamp").isNull()).alias("null_times"),
        F.count(files.CORRUPT).alias("kept_lines"),
        F.round(F.sum("value"), 4).alias("value_sum"),
    )


@checks.add(
    "src2_parquet_scan",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
              epoch_us(l_shipdate) AS ship_micros FROM lineitem""",
)
def _(spark, sf_dir):
    source = files.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return source.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship_micros"),
    )


def _fresh_table(prefix: str) -> str:
    return tables.table_name(f"{prefix}_{uuid.uuid4().hex}")


@checks.add("src3_table_scan", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf_dir):
    name = _fresh_table("events")
    tables.overwrite_table(events(spark, sf_dir), name, scratch_path(spark, "table"))
    return tables.read_table(spark, name).select("event_id", "user_id", "event_type", "value")


@checks.add(
    "src4_file_formats",
    """SELECT * FROM (VALUES ('csv', 4), ('parquet', 3), ('excel', 2)) AS t(file_format, files),
         (SELECT count(*) AS row_count FROM events)""",
)
def _(spark, sf_dir):
    """Files of known first bytes, all named alike."""
    folder, lines = scratch_path(spark, "formats"), events(spark, sf_dir).select(F.col("event_id").cast("string").alias("line"))
    lines.repartition(4).write.text(f"{folder}/a")
    lines.repartition(3).write.option("compression", "none").parquet(f"{folder}/b")
    sealed = lines.limit(2).repartition(2).select(F.concat(F.lit("PK\u0003\u0004"), "line"))
    sealed.write.text(f"{folder}/c")
    found = files.classify_files(spark, folder).groupBy("file_format").agg(F.count("*").cast("int").alias("files"))
    return found.withColumn("row_count", F.lit(lines.count()).cast("long"))


def text_per_user(spark, sf_dir) -> str:
    """One text file for each user: the ids of the user's events in ascending order."""
    path = scratch_path(spark, "texts")
    files.write_text_files(events(spark, sf_dir).select("user_id", "event_id"), path, "user_id", "event_id", ["event_id"])
    return path


@checks.add(
    "src5_file_fingerprints",
    """SELECT user_id, strlen(content) AS length, sha256(content) AS sha256
       FROM (SELECT user_id, string_agg(event_id::VARCHAR || chr(10), '' ORDER BY event_id) AS content
             FROM events GROUP BY user_id)""",
)
def _(spark, sf_dir):
    """Some files are hashed as one value, the others in chunks."""
    path = text_per_user(spark, sf_dir)
    middle = files.list_files(spark, path).agg(F.avg("length").cast("long")).first()[0]
    found = files.fingerprint_files(spark, path, whole_file_bytes=middle)
    return found.select(F.regexp_extract("path", "user_id=([^/]*)", 1).cast("long").alias("user_id"), "length", "sha256")


COMPARED_SQL = f"""
WITH s AS ({SCORES_SQL}),
cells AS (
  SELECT model, count(*) FILTER (label = 0 AND probability < 0.5) AS tn,
         count(*) FILTER (label = 0 AND probability >= 0.5) AS fp,
         count(*) FILTER (label = 1 AND probability < 0.5) AS fn,
         count(*) FILTER (label = 1 AND probability >= 0.5) AS tp
  FROM s GROUP BY model),
g AS (SELECT model, probability, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER w AS tp_cum, sum(pos + neg) OVER w AS n_cum FROM g
      WINDOW w AS (PARTITION BY model ORDER BY probability DESC)),
r AS (SELECT model, sum(neg * (tp_cum - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS roc_auc,
             sum(pos::DOUBLE * tp_cum / n_cum) / sum(pos) AS pr_auc FROM c GROUP BY model)
SELECT model, 0.5::DOUBLE AS threshold,
       round((tp + tn)::DOUBLE / (tn + fp + fn + tp), 6) AS accuracy,
       round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, tn, fp, fn, tp
FROM cells JOIN r USING (model)
"""
MEASURES = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
CELLS = ("tn", "fp", "fn", "tp")


def compared(spark, sf_dir, **options):
    table = compare_models(scores(spark, sf_dir), **options)
    return table.select("model", "threshold", *[F.round(m, 6).alias(m) for m in MEASURES], *CELLS)


def write_documents(documents) -> str:
    """One JSON file per model."""
    path = scratch_path(documents.sparkSession, "metrics")
    kept = written(documents, "documents")
    for model in "ab":
        kept.filter(F.col("model") == model).coalesce(1).write.mode("append").json(path)
    return path


@checks.add("src6_metric_documents", f"SELECT model, f1, roc_auc, tp FROM ({COMPARED_SQL})")
def _(spark, sf_dir):
    path = write_documents(compared(spark, sf_dir))
    return files.read_metric_documents(spark, path).select("model", "f1", "roc_auc", "tp")


@checks.add(
    "met15_run_registry",
    f"""WITH c AS ({COMPARED_SQL}),
    m AS (UNPIVOT (SELECT model, threshold, accuracy, precision, recall, f1, roc_auc, pr_auc,
                          tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tp::DOUBLE AS tp FROM c)
          ON COLUMNS(* EXCLUDE model) INTO NAME key VALUE value)
    SELECT model AS run, 'metric' AS kind, key, round(value, 6) AS number, NULL::VARCHAR AS text FROM m
    UNION ALL SELECT model, 'param', 'model_name', NULL, model FROM c
    UNION ALL SELECT model, 'param', 'model', NULL, model FROM c
    UNION ALL SELECT model, 'param', 'step', NULL, '1' FROM c
    UNION ALL SELECT model, 'param', 'feature_count', NULL, '2' FROM c""",
)
def _(spark, sf_dir):
    documents = compared(spark, sf_dir).withColumns(
        {
            "parameters": F.struct(F.lit(1).alias("step")),
            "features": F.array(F.lit("x"), F.lit("y")),
            "finished": F.lit(True),
        }
    )
    path = write_documents(documents)
    entries = files.registry_entries(files.read_metric_documents(spark, path))
    is_metric = F.col("kind") == "metric"
    return entries.select(
        "run", "kind", "key",
        F.round(F.when(is_metric, F.col("value").cast("double")), 6).alias("number"),
        F.when(~is_metric, F.col("value")).alias("text"),
    )


@checks.add("snk1_parquet_overwrite", "SELECT event_id, user_id, event_type, value, props FROM events")
def _(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    source = events(spark, sf_dir)
    tables.overwrite_parquet(source.select("event_id"), path)
    tables.overwrite_parquet(source, path)
    return files.read_parquet(spark, path).drop("ts")


def landed(spark, sf_dir):
    store = landing.Landing(spark, scratch_path(spark, "landing"))
    path = csv_copy(spark, sf_dir, parts=4)
    schema = T.StructType([T.StructField("seq", T.LongType()), *CSV_SCHEMA.fields[1:]])
    first = store.ingest(path, "m1", schema)
    again = store.ingest(path, "m1", schema)
    other = store.ingest(path, "m2", schema)
    return store, first, again, other


@checks.add(
    "snk2_idempotent_append",
    """SELECT m.machine_id, 4 AS landed, 0 AS landed_again, count(*) AS row_count,
              count(DISTINCT event_id) AS distinct_rows, round(sum(value), 4) AS value_sum
       FROM events, (VALUES ('m1'), ('m2')) AS m(machine_id) GROUP BY m.machine_id""",
)
def _(spark, sf_dir):
    store, first, again, _ = landed(spark, sf_dir)
    return (
        store.table()
        .groupBy("machine_id")
        .agg(
            F.lit(first).alias("landed"),
            F.lit(again).alias("landed_again"),
            F.count("*").alias("row_count"),
            F.count_distinct("seq").alias("distinct_rows"),
            F.round(F.sum("value"), 4).alias("value_sum"),
        )
    )


@checks.add(
    "snk5_ingest_history",
    """SELECT m.machine_id, 4 AS files, 4 AS hashes, count(*) AS row_count
       FROM events, (VALUES ('m1'), ('m2')) AS m(machine_id) GROUP BY m.machine_id""",
)
def _(spark, sf_dir):
    store, *_ = landed(spark, sf_dir)
    history = landing.ingest_history(store.log())
    return history.groupBy("machine_id").agg(
        F.count("*").cast("int").alias("files"),
        F.count_distinct("sha256").cast("int").alias("hashes"),
        F.sum("row_count").alias("row_count"),
    )


@checks.add(
    "snk5_table_detail",
    """SELECT * FROM (VALUES ('event_id', 'bigint'), ('ts', 'timestamp_ntz'), ('user_id', 'bigint'), ('event_type', 'string'),
         ('value', 'double'), ('props', 'string'), ('Provider', 'parquet'), ('Type', 'EXTERNAL')) AS t(col_name, data_type)
       UNION ALL SELECT 'rows', count(*)::VARCHAR FROM events""",
)
def _(spark, sf_dir):
    name = _fresh_table("detailed")
    tables.overwrite_table(events(spark, sf_dir), name, scratch_path(spark, "table"))
    detail = tables.table_detail(spark, name, count_rows=True).select("col_name", "data_type")
    rows = detail.filter(F.col("col_name") == "Statistics").select(
        F.lit("rows").alias("col_name"), F.regexp_extract("data_type", "(\\d+) rows", 1).alias("data_type")
    )
    return detail.filter(F.col("col_name").isin("Provider", "Type", *events(spark, sf_dir).columns)).unionByName(rows)


STREAM_SCHEMA = T.StructType([CSV_SCHEMA.fields[0], T.StructField("timestamp", T.TimestampType()), *CSV_SCHEMA.fields[2:]])


@checks.add(
    "snk2_incremental_stream",
    """SELECT 'm1' AS machine_id, 4 AS files, 2 AS runs, sum(n)::BIGINT AS logged_rows, sum(n)::BIGINT AS row_count, sum(ids)::BIGINT AS distinct_rows,
              round(sum(total), 4) AS value_sum
       FROM (SELECT count(*) AS n, count(DISTINCT event_id) AS ids, sum(value) AS total FROM events)""",
)
def _(spark, sf_dir):
    """Two files arrive, then copies of them under other names beside two more."""
    source, state = csv_copy(spark, sf_dir, parts=4), scratch_path(spark, "state")
    arrived, store = scratch_path(spark, "arrived"), landing.Landing(spark, scratch_path(spark, "landing"))
    names = sorted(row["path"] for row in files.list_files(spark, source).select("path").collect())
    for step, arriving in enumerate((names[:2], names)):
        for number, name in enumerate(arriving):
            copy_file(spark, name, f"{arrived}/{step}-{number}.csv")
        stream = streaming.stream_csv(spark, arrived, STREAM_SCHEMA)
        streaming.run_landing(stream, store, "m1", state)
    log = store.log().groupBy("machine_id").agg(
        F.count("*").cast("int").alias("files"),
        F.count_distinct("run_id").cast("int").alias("runs"),
        F.sum("row_count").alias("logged_rows"),
    )
    rows = store.table().groupBy("machine_id").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("seq").alias("distinct_rows"),
        F.round(F.sum("value"), 4).alias("value_sum"),
    )
    return log.join(rows, "machine_id")


@checks.add(
    "set1_stream_without_copies",
    """SELECT 'accepted' AS route, count(*) AS row_count, count(DISTINCT event_id) AS distinct_rows FROM events WHERE event_id % 97 != 0
       UNION ALL SELECT 'rejected', 2 * count(*), count(*) FROM events WHERE event_id % 97 = 0
       UNION ALL SELECT 'late', count(*), count(DISTINCT event_id) FROM events WHERE event_id % 50 = 0""",
)
def _(spark, sf_dir):
    """All readings arrive twice, in batches of files; with the second lot come readings of a year before."""
    arrived, out, state = (scratch_path(spark, label) for label in ("arrived", "unique", "state"))
    first = csv_copy(spark, sf_dir, broken=True, parts=4)
    names = sorted(row["path"] for row in files.list_files(spark, first).select("path").collect())
    old = spark.read.option("header", True).csv(csv_copy(spark, sf_dir)).filter(F.col("_c0").cast("long") % 50 == 0)
    past = F.date_format(F.col("timestamp").cast("timestamp") - F.expr("INTERVAL 365 DAYS"), "yyyy-MM-dd HH:mm:ss")
    late = scratch_path(spark, "late")
    old.withColumns({"timestamp": past, "_c0": -F.col("_c0").cast("long")}).write.option("header", True).csv(late)
    lots = (names, [*names, *sorted(row["path"] for row in files.list_files(spark, late).select("path").collect())])
    for step, lot in enumerate(lots):
        for number, name in enumerate(lot):
            copy_file(spark, name, f"{arrived}/{step}-{number}.csv")
        stream = streaming.stream_csv(spark, arrived, STREAM_SCHEMA)
        streaming.run_unique(stream, "timestamp", ["seq", "timestamp", "user_id", "value"], out, state, 100 * 86_400)
    found = spark.read.parquet(out).groupBy("route")
    return found.agg(F.count("*").alias("row_count"), F.count_distinct("seq").alias("distinct_rows"))


@checks.add(
    "flt2_stream_quarantine",
    """SELECT event_id AS seq, CASE WHEN event_id % 97 = 0 THEN 'rejected' ELSE 'accepted' END AS route FROM events""",
)
def _(spark, sf_dir):
    source, out = csv_copy(spark, sf_dir, broken=True, parts=4), scratch_path(spark, "judged")
    streaming.run_quarantine(
        streaming.stream_csv(spark, source, STREAM_SCHEMA),
        quality.missing_time_rule("timestamp"),
        out,
        scratch_path(spark, "state"),
    )
    return spark.read.parquet(out).select("seq", "route")


@checks.add(
    "jn2_not_yet_ingested",
    """SELECT event_type, count(*) AS row_count FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1""",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir).withColumns(
        {"machine_id": F.lit("m1"), "sha256": F.sha2("event_type", 256)}
    )
    log = source.filter(F.col("event_type").isin("click", "view")).select("machine_id", "sha256")
    return landing.not_yet_ingested(source, log).groupBy("event_type").agg(F.count("*").alias("row_count"))


@checks.add(
    "snk3_table_overwrite",
    "SELECT event_id, user_id, value, value * 2 AS doubled FROM events",
)
def _(spark, sf_dir):
    name, path = _fresh_table("silver"), scratch_path(spark, "table")
    source = events(spark, sf_dir)
    tables.overwrite_table(source.select("event_id", "user_id"), name, path)
    wider = source.select("event_id", "user_id", "value", (F.col("value") * 2).alias("doubled"))
    tables.overwrite_table(wider, name, path)
    return tables.read_table(spark, name)


@checks.add(
    "snk4_append_metrics",
    """SELECT 'null_count_' || c AS metric_name, 2 AS runs, 0::BIGINT AS metric_value, 'PASS' AS status
       FROM (VALUES ('event_id'), ('ts'), ('user_id'), ('event_type'), ('value'), ('props')) AS t(c)
       UNION ALL SELECT 'total_rows', 2, count(*), 'INFO' FROM events
       UNION ALL SELECT 'null_timestamp_rows', 2, 0, 'PASS'
       UNION ALL SELECT 'duplicate_timestamp_rows', 2, count(*) - count(DISTINCT ts), 
                 CASE WHEN count(*) = count(DISTINCT ts) THEN 'PASS' ELSE 'WARNING' END FROM events
       UNION ALL SELECT 'duplicate_index_rows', 2, count(*) - count(DISTINCT event_id), 'PASS' FROM events""",
)
def _(spark, sf_dir):
    name, path = _fresh_table("metrics"), scratch_path(spark, "table")
    for run in ("run-1", "run-2"):
        tables.append_table(quality.quality_report(events(spark, sf_dir), "ts", "event_id", run), name, path)
    return (
        tables.read_table(spark, name)
        .groupBy("metric_name", "metric_value", "status")
        .agg(F.count_distinct("run_id").cast("int").alias("runs"))
    )


@checks.add(
    "snk6_verify_saved",
    "SELECT count(*) AS saved_rows, count(*) AS expected_rows, true AS same_count, true AS same_schema, true AS same_content FROM events",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir)
    return tables.verify_saved(written(source, "saved"), source)


@checks.add(
    "snk6_verified_write",
    """SELECT part, count(*) AS saved_rows, count(*) AS expected_rows, true AS same_count, true AS same_schema,
              part = 'unchanged' AS same_content
       FROM events, (VALUES ('unchanged'), ('one value changed'), ('two values exchanged')) AS p(part) GROUP BY part""",
)
def _(spark, sf_dir):
    """Tables that differ from what was to be saved in one value, and in two that changed places."""
    source = events(spark, sf_dir)
    path = scratch_path(spark, "verified")
    results = [tables.overwrite_verified(source, path).withColumn("part", F.lit("unchanged"))]
    last = source.agg(F.max("event_id")).first()[0]
    changed = {
        "one value changed": F.when(F.col("event_id") == last, F.col("value") + 1).otherwise(F.col("value")),
        "two values exchanged": F.when(F.col("event_id") == last, F.lit(-1.5)).when(F.col("event_id") == last - 1, F.lit(-2.5)).otherwise(F.col("value")),
    }
    exchanged = source.withColumn(
        "value", F.when(F.col("event_id") == last, F.lit(-2.5)).when(F.col("event_id") == last - 1, F.lit(-1.5)).otherwise(F.col("value"))
    )
    for part, value in changed.items():
        expected = source if part.startswith("one") else exchanged
        saved = written(source.withColumn("value", value), "changed")
        results.append(tables.verify_saved(saved, expected).withColumn("part", F.lit(part)))
    return results[0].unionByName(results[1]).unionByName(results[2])


@checks.add(
    "snk7_split_directories",
    f"""SELECT split, count(*) AS row_count, sum(fault_label)::BIGINT AS faults, sum(event_id)::BIGINT AS id_sum
        FROM ({SPLIT_SQL}) GROUP BY split""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "splits")
    tables.write_splits(splits.stratified_split(labelled(spark, sf_dir), "fault_label", ["event_id"]), path)
    parts = [
        tables.read_split(spark, path, part).agg(
            F.lit(part).alias("split"),
            F.count("*").alias("row_count"),
            F.sum("fault_label").alias("faults"),
            F.sum("event_id").alias("id_sum"),
        )
        for part in splits.SPLITS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@checks.add(
    "ord1_chronological_files",
    "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, value FROM events",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "chronological")
    tables.write_chronological(events(spark, sf_dir), path, ["ts", "event_id"])
    return files.read_parquet(spark, path).select("event_id", epoch_seconds(F.col("ts")).alias("epoch"), "value")


# --- run state: users as runs, event types as stages -------------------------------------


@checks.add(
    "run1_latest_status",
    """SELECT user_id, event_type, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, sf_dir):
    latest = runs.latest_status(
        events(spark, sf_dir), ["user_id", "event_type"], "ts", ["event_id", "value"], tie=["event_id"]
    )
    return latest.drop("ts")


@checks.add(
    "run2_stage_durations",
    """SELECT user_id, event_type, round(seconds, 3) AS seconds FROM (
         SELECT user_id, event_type, event, lag(event) OVER w AS previous,
                (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6::DOUBLE AS seconds
         FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'Starting' ELSE 'Completed' END AS event FROM events)
         WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
       WHERE event = 'Completed' AND previous = 'Starting'""",
)
def _(spark, sf_dir):
    log = events(spark, sf_dir).withColumn(
        "event", F.when(F.col("event_id") % 2 == 0, "Starting").otherwise("Completed")
    )
    found = runs.stage_durations(log, "user_id", "event_type", "event", "ts", ["event_id"])
    return found.select("user_id", "event_type", F.round("seconds", 3).alias("seconds"))


@checks.add(
    "run3_resume_gate",
    """SELECT user_id, event_type AS mode, 'h' || (user_id % 7) AS input_hash,
              bool_or(event_type = 'view' AND logged.user_id % 7 = logged.event_id % 7) AS reuse
       FROM (SELECT DISTINCT user_id, 'view' AS event_type FROM events) AS wanted
       JOIN events AS logged USING (user_id, event_type) GROUP BY ALL
       UNION ALL
       SELECT user_id, 'view', 'h' || (user_id % 7), false FROM (SELECT DISTINCT user_id FROM events)
       WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'view')""",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir)
    hashed = F.concat(F.lit("h"), (F.col("event_id") % 7).cast("string"))
    log = source.select("user_id", F.col("event_type").alias("mode"), hashed.alias("input_hash"))
    current = source.select("user_id").distinct().select(
        "user_id",
        F.lit("view").alias("mode"),
        F.concat(F.lit("h"), (F.col("user_id") % 7).cast("string")).alias("input_hash"),
    )
    return runs.with_resume_decision(current, log, ["user_id"], "mode", "input_hash")
