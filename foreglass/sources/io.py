"""Readers and writers: files by extension, directories, JDBC, score files, datasets."""

from __future__ import annotations

import json
from collections.abc import Iterable
from fnmatch import fnmatch
from functools import reduce
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from foreglass.session import file_system
from foreglass.sources import schemas

#: CSV cells hold JSON with quotes and line breaks.
CSV = {"header": "true", "multiLine": "true", "escape": '"', "enforceSchema": "false"}


#: Beside the parts of a CSV table: its schema, so that it comes back as it was.
SCHEMA_FILE = "_schema.json"


def exists(spark: SparkSession, path: str) -> bool:
    """True if the path, a pattern allowed, leads to anything on its file system."""
    system, place = file_system(spark, path)
    return bool(system.globStatus(place))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file on the path's own file system."""
    system, place = file_system(spark, path)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as one text."""
    system, place = file_system(spark, require(spark, path))
    stream = system.open(place)
    try:
        whole = spark._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
        return whole.next() if whole.hasNext() else ""
    finally:
        stream.close()


def require(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return path


def read_frame(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet, JSON lines or CSV by extension; CSV needs a schema or is read as strings."""
    path = require(spark, path).rstrip("/")
    if path.endswith(".parquet") or any(exists(spark, f"{path}/{below}.parquet") for below in ("*", "*=*/*")):
        return spark.read.parquet(path)
    if schema is None and exists(spark, f"{path}/{SCHEMA_FILE}"):
        own = StructType.fromJson(json.loads(read_text(spark, f"{path}/{SCHEMA_FILE}")))
        nested = {f.name: f.dataType for f in own if _is_nested(f.dataType.simpleString())}
        flat = StructType([f if f.name not in nested else StructField(f.name, StringType()) for f in own])
        rows = spark.read.schema(flat).options(**CSV).csv(path)
        return rows.withColumns({n: F.from_json(n, t) for n, t in nested.items()}) if nested else rows
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.endswith((".json", ".jsonl")):
        return reader.json(path)
    return reader.options(**CSV).csv(path)


def read_jdbc(spark: SparkSession, url: str | None, table: str | None = None, query: str | None = None, **options: str) -> DataFrame:
    """A database table or the result of the caller's own SQL; filters and columns are pushed down.

    A table is read by several tasks if ``partitionColumn`` and its bounds are given.
    """
    if not url:
        raise ValueError("a database URL or file paths are needed")
    if (table is None) == (query is None):
        raise ValueError("either a table or a query")
    source = {"dbtable": table} if query is None else {"query": query}
    return spark.read.format("jdbc").options(url=url, **source, **options).load()


def read_directory(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """(predictions, submissions) of a directory with both files."""
    return tuple(read_frame(spark, f"{directory}/{name}.csv", schemas.BY_NAME[name]) for name in ("predictions", "submissions"))


def read_many(spark: SparkSession, paths: Iterable[str], schema: str | None = None, strict: bool = True) -> DataFrame:
    """Several files as one table, columns matched by name; missing files are an error or skipped."""
    paths = list(paths)
    found = [p for p in paths if exists(spark, p)]
    if strict and len(found) < len(paths):
        raise FileNotFoundError(sorted(set(paths) - set(found)))
    if not found:
        raise ValueError("no input file")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read_frame(spark, p, schema) for p in found])


def read_dataset(spark: SparkSession, path: str, needed: Iterable[str] = ("messages", "event_ticker", "submission_id", "market_outcome")) -> DataFrame:
    """A chat dataset, checked for its columns."""
    df = spark.read.parquet(require(spark, path))
    if missing := sorted(set(needed) - set(df.columns)):
        raise ValueError(f"columns missing: {missing}")
    return df


def read_scores(spark: SparkSession, directory: str, pattern: str = "*brier_score.csv") -> DataFrame:
    """All score files below a directory, or tables of that name, with the ``file`` each row came from."""
    system, place = file_system(spark, require(spark, directory))
    files, found = system.listFiles(place, True), []
    while files.hasNext():
        path = files.next().getPath()
        if fnmatch(path.getName(), pattern) or (path.getName().startswith("part-") and fnmatch(path.getParent().getName(), pattern)):
            found.append(path.toString())
    if not found:
        raise FileNotFoundError(f"{directory}/**/{pattern}")
    rows = spark.read.schema(schemas.SCORED_OUTPUTS).options(**CSV).csv(found)
    return rows.withColumn("file", F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", ""))


def read_yaml(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def write_yaml(value: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(value, f, sort_keys=False, allow_unicode=True)


def write_frame(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite", partition: Iterable[str] = ()) -> str:
    """A table as parquet, JSON lines or CSV; nested columns become JSON text in CSV."""
    if form == "csv":
        schema = df.schema.json()
        nested = {c: F.to_json(c) for c, t in df.dtypes if _is_nested(t)}
        df = df.withColumns(nested) if nested else df
    writer = df.write.mode(mode).partitionBy(*partition)
    getattr(writer.options(**({k: CSV[k] for k in ("header", "escape")} if form == "csv" else {})), form)(path)
    if form == "csv":
        write_text(df.sparkSession, f"{path}/{SCHEMA_FILE}", schema)
    return path


def _is_nested(kind: str) -> bool:
    return kind.startswith(("array", "map", "struct"))


def write_splits(tables: dict[str, DataFrame], path: str) -> str:
    """Several tables of the same columns as the splits of one dataset."""
    named = [df.withColumn("split", F.lit(name)) for name, df in tables.items()]
    return write_dataset(reduce(lambda a, b: a.unionByName(b), named), path)


def write_dataset(df: DataFrame, path: str) -> str:
    """A dataset with its ``split`` as directories."""
    return write_frame(df, path, partition=["split"])


def write_scores(df: DataFrame, folder: str, name: str) -> str:
    """Scored rows as the table ``<name>_brier_score.csv``, which ``read_scores`` finds."""
    return write_frame(df.select(*(F.col(f.name) for f in StructType.fromDDL(schemas.SCORED_OUTPUTS))), f"{folder}/{name}_brier_score.csv", "csv")


def write_summary(df: DataFrame, path: str) -> str:
    """A summary, some rows, as one JSON array of records."""
    write_text(df.sparkSession, path, "[" + ",\n ".join(df.toJSON().collect()) + "]")
    return path


def append_batch(df: DataFrame, path: str, batch: int) -> str:
    """One batch of results; writing a batch again replaces it."""
    return write_frame(df, f"{path}/batch_id={batch}")
