"""Readers for raw files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref, refs
from gaugeworks.operators.contracts import ContractError
from gaugeworks.roles import COMPRESSOR_ANALOG, COMPRESSOR_FLAGS, INDEX_ALIASES
from gaugeworks.sources.scratch import written

# Time pattern of the raw files and file signatures.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
ZIP_SIGNATURE = "504B0304"
OLE_SIGNATURE = "D0CF11E0A1B11AE1"
PARQUET_SIGNATURE = "50415231"

CORRUPT = "_corrupt_record"
FILE = "__file"
# Files up to this size are hashed in the JVM as one value.
WHOLE_FILE_BYTES = 256 * 1024 * 1024
CHUNK_BYTES = 8 * 1024 * 1024


def compressor_schema(index: str = "seq") -> T.StructType:
    fields = [T.StructField(index, T.LongType()), T.StructField("timestamp", T.TimestampType())]
    fields += [T.StructField(name, T.DoubleType()) for name in (*COMPRESSOR_ANALOG, *COMPRESSOR_FLAGS)]
    return T.StructType(fields)


def in_header_order(header: Sequence[str], schema: T.StructType) -> T.StructType:
    """The fields of ``schema`` as a file's header names them; the index column may go by an alias.

    Raises ``ContractError`` for a name that the schema lacks or the header
    lacks.
    """
    known = {field.name: field for field in schema.fields}
    spare = [field for field in schema.fields if field.name not in header and isinstance(field.dataType, T.IntegralType)]
    fields = []
    for name in header:
        if name in known:
            fields.append(known.pop(name))
        elif name in ("", *INDEX_ALIASES) and len(spare) == 1 and spare[0].name in known:
            fields.append(known.pop(spare[0].name))
        else:
            raise ContractError(f"unknown column in the header: {name!r}")
    if known:
        raise ContractError(f"columns missing from the header: {sorted(known)}")
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, time_pattern: str = TIME_PATTERN) -> DataFrame:
    """CSV with header.

    With a schema, columns are bound by the names in each file's header,
    whatever their order; the result has the order of the schema.  A malformed
    value becomes null and the raw line is kept in ``_corrupt_record``;
    inference would read the file twice and turn a whole column into text for
    one bad value.
    """
    reader = spark.read.option("header", True).option("timestampFormat", time_pattern).option("timestampNTZFormat", time_pattern)
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None:
        return reader.option("inferSchema", True).csv(paths)
    headers = written(read_headers(list_files(spark, paths).select("path", "length")), "headers")
    # Different headers are few, whatever the number of files.
    kinds = [tuple(row["header"]) for row in headers.select("header").distinct().collect()] or [tuple(schema.names)]
    parts = [
        rows_of_header(spark, paths, header, schema, time_pattern)
        if len(kinds) == 1
        else rows_of_files(rows_of_header(spark, paths, header, schema, time_pattern), having_header(headers, header))
        for header in sorted(kinds)
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select(*refs(schema.names), CORRUPT)


def rows_of_header(
    spark: SparkSession, path: str | Sequence[str], header: Sequence[str], schema: T.StructType | None, time_pattern: str = TIME_PATTERN
) -> DataFrame:
    """All files under a path read as if they had this header; see ``rows_of_files`` for those that do.

    Without a schema every column is text (see ``with_inferred_types``).
    """
    if schema is None:
        full = T.StructType([T.StructField(name or f"_c{i}", T.StringType()) for i, name in enumerate(header)])
    else:
        full = T.StructType([*in_header_order(header, schema).fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.option("header", True)
        .option("timestampFormat", time_pattern)
        .option("timestampNTZFormat", time_pattern)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", True)
        .option("recursiveFileLookup", True)
    )
    return reader.schema(full).csv([path] if isinstance(path, str) else list(path))


def having_header(files: DataFrame, header: Sequence[str]) -> DataFrame:
    return files.filter(F.col("header") == F.array(*[F.lit(name) for name in header]).cast("array<string>"))


def file_of_row() -> Column:
    """The file a row was read from, as listings name it: the reader's names are percent-encoded."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def listed_file(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def rows_of_files(rows: DataFrame, files: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Rows just read that come from the listed files, with columns of the list.

    Names of files meet the rows in a join, so the driver sees none of them;
    whether the list is broadcast is decided by its bytes.
    """
    listed = files.select(listed_file(F.col("path")).alias(FILE), *columns)
    return rows.withColumn(FILE, file_of_row()).join(listed, FILE, "inner" if columns else "left_semi").drop(FILE)


def with_inferred_types(df: DataFrame, time_pattern: str = TIME_PATTERN) -> DataFrame:
    """Text columns in the first type that all their values have: int, long, double, timestamp, boolean, text.

    One aggregation over all columns; a column without values stays text.
    """
    kinds = {
        "int": lambda c: c.try_cast("int"),
        "bigint": lambda c: c.try_cast("bigint"),
        "double": lambda c: c.try_cast("double"),
        "timestamp": lambda c: F.try_to_timestamp(c, F.lit(time_pattern)),
        "boolean": lambda c: c.try_cast("boolean"),
    }
    found = df.agg(
        *[
            (F.count(ref(name)) == F.count(convert(ref(name)))).alias(f"{kind}{i}")
            for i, name in enumerate(df.columns)
            for kind, convert in kinds.items()
        ],
        *[F.count(ref(name)).alias(f"n{i}") for i, name in enumerate(df.columns)],
    ).first()
    typed = []
    for i, name in enumerate(df.columns):
        kind = next((kind for kind in kinds if found[f"{kind}{i}"]), None) if found[f"n{i}"] else None
        typed.append(kinds[kind](ref(name)).alias(name) if kind else ref(name))
    return df.select(*typed)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(path, length, modificationTime)`` of files that are not empty; contents are not read."""
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(paths)
        .select("path", "length", "modificationTime")
    )


def _located(uri: str):
    """The file system of a path and the path inside it.  Listed paths are not percent-encoded."""
    from urllib.parse import quote

    from pyarrow import fs

    scheme, mark, rest = uri.partition(":")
    if not mark or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    known = {"s3a": "s3", "s3n": "s3", "s3": "s3", "hdfs": "hdfs", "viewfs": "viewfs", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
    if scheme not in known:
        raise ValueError(f"cannot open {scheme}: files from a task: {uri}")
    return fs.FileSystem.from_uri(f"{known[scheme]}:{quote(rest)}")


def _open(uri: str):
    """The bytes of a listed file."""
    system, inner = _located(uri)
    return system.open_input_stream(inner)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        heads = []
        for uri in batch["path"]:
            with _open(uri) as stream:
                heads.append(stream.read(8).hex().upper())
        yield batch.assign(signature=heads)


def classify_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Format of every file by its first bytes, never by its extension.

    Tasks open the files they are given and read eight bytes of each.
    """
    listed = list_files(spark, path).select("path", "length")
    with_head = listed.mapInPandas(_signatures, "path string, length long, signature string")
    signature = F.col("signature")
    return with_head.withColumn(
        "file_format",
        F.when(signature.startswith(ZIP_SIGNATURE) | (signature == OLE_SIGNATURE), "excel")
        .when(signature.startswith(PARQUET_SIGNATURE), "parquet")
        .otherwise("csv"),
    )


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import csv
    import io

    for batch in batches:
        headers, filled = [], []
        for uri in batch["path"]:
            with _open(uri) as stream:
                text = io.TextIOWrapper(io.BufferedReader(stream), encoding="utf-8-sig", errors="replace", newline="")
                rows = csv.reader(text)
                headers.append(next(rows, []))
                filled.append(next(rows, None) is not None)
        yield batch.assign(header=headers, has_rows=filled)


def read_headers(files: DataFrame) -> DataFrame:
    """Header of every listed CSV file as written, before Spark renames duplicates,
    and whether a row follows it.  Tasks read the first lines of their files only."""
    schema = T.StructType(
        [
            *files.schema.fields,
            T.StructField("header", T.ArrayType(T.StringType())),
            T.StructField("has_rows", T.BooleanType()),
        ]
    )
    return files.mapInPandas(_first_lines, schema)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    for batch in batches:
        digests = []
        for uri in batch["path"]:
            digest = hashlib.sha256()
            with _open(uri) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


def fingerprint_files(spark: SparkSession, path: str | Sequence[str], whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """SHA-256 of every file.

    Small files are hashed by a built-in over their content; the content of a
    large file is streamed in chunks by the task that owns it, so no file has
    to fit in memory.
    """
    paths = [path] if isinstance(path, str) else list(path)
    # Listed once for both kinds.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    names = ("path", "length", "modificationTime")
    small = listed.filter(F.col("length") <= whole_file_bytes).select(*names, F.sha2("content", 256).alias("sha256"))
    return small.unionByName(hashed_files(listed.select(*names).filter(F.col("length") > whole_file_bytes)))


def hashed_files(files: DataFrame) -> DataFrame:
    """Listed files with the SHA-256 of each, read in chunks by the task that has its name."""
    return files.mapInPandas(_digests, T.StructType([*files.schema.fields, T.StructField("sha256", T.StringType())]))


def write_text_files(lines: DataFrame, folder: str, key: str, line: str, order: Sequence[str]) -> None:
    """One text file for each value of ``key``, ``folder/key=value/lines.txt``: its lines in the given order.

    Tasks write the files of their keys where they stay, line by line: no file
    is moved by the driver afterwards, whose time would grow with the number of
    files.  A task that runs again writes the same files.  A null line is
    empty; a null key has Spark's name for it.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, stream = None, None
        try:
            for batch in batches:
                for name, text in zip(batch.column("name").to_pylist(), batch.column("line").to_pylist()):
                    if name != current:
                        if stream is not None:
                            stream.close()
                        system, inner = _located(f"{folder}/{name}")
                        system.create_dir(inner, recursive=True)
                        current, stream = name, system.open_output_stream(f"{inner}/lines.txt")
                    stream.write(((text or "") + "\n").encode())
        finally:
            if stream is not None:
                stream.close()
        yield from ()

    value = F.coalesce(ref(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    named = lines.withColumn(FILE, F.concat(F.lit(f"{key}="), value))
    ordered = named.repartition(ref(FILE)).sortWithinPartitions(ref(FILE), *[ref(name) for name in order])
    ordered.select(ref(FILE).alias("name"), ref(line).cast("string").alias("line")).mapInArrow(put, "name string").count()


def artifact_size(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes under a path."""
    return list_files(spark, path).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def read_metric_documents(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """One row per JSON document, with its file name."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    documents = reader.json([path] if isinstance(path, str) else list(path))
    return documents.withColumn("source_file", F.element_at(F.split(F.input_file_name(), "/"), -1))


# Document fields recorded as parameters, or only counted.
PARAMETER_FIELDS = ("model", "selection_metric")
FEATURE_FIELDS = ("feature_columns", "features")


def registry_entries(documents: DataFrame, name: str = "model") -> DataFrame:
    """Flatten metric documents to ``(run, kind, key, value)``.

    Numbers become metrics; model, selection metric and the nested parameters
    become params; of the feature list only the length is kept.  Booleans and
    other lists are dropped.
    """
    run = F.coalesce(ref(name), F.regexp_replace("source_file", r"\.json$", "")) if name in documents.columns else F.regexp_replace("source_file", r"\.json$", "")
    entries = [F.struct(F.lit("param").alias("kind"), F.lit("model_name").alias("key"), run.alias("value"))]

    def entry(kind: str, key: str, value) -> None:
        entries.append(
            F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), value.cast("string").alias("value"))
        )

    for field in documents.schema.fields:
        value = ref(field.name)
        if field.name in FEATURE_FIELDS:
            continue
        if field.name == "parameters" and isinstance(field.dataType, T.StructType):
            for nested in field.dataType.names:
                entry("param", nested, value.getField(nested))
        elif field.name in PARAMETER_FIELDS:
            entry("param", field.name, value)
        elif isinstance(field.dataType, T.NumericType):
            entry("metric", field.name, value.cast("double"))
    lists = [F.size(ref(name)) for name in FEATURE_FIELDS if name in documents.columns]
    if lists:
        size = F.coalesce(*[F.when(size > 0, size) for size in lists])
        entry("param", "feature_count", size)
    return documents.select(run.alias("run"), F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
