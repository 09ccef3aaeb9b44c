"""File sources and sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tapewire.session import checkpoint_folder

KEY_FROM_FILE = r"([^/]+)\.csv[^/]*$"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, on storage all executors reach."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, folder: str, columns: Sequence[str], partition: str | None = None) -> str:
    """CSV with a header and a fixed column order; quotes are doubled."""
    writer = df.select(*columns, *([partition] if partition else [])).write.option("header", True)
    writer = writer.option("quote", '"').option("escape", '"').option("emptyValue", '""')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (writer.partitionBy(partition) if partition else writer).csv(folder)
    return folder


def read_csv(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """CSV with a header by explicit schema; quoted cells may span lines.

    A byte-order mark only ever precedes the header line, which is skipped.
    """
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True)
    reader = reader.option("quote", '"').option("escape", '"').option("enforceSchema", True)
    reader = reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    return reader.options(**options).csv(path)


def read_keyed_csv(spark: SparkSession, folder: str, schema: StructType | str, key: str = "ticker") -> DataFrame:
    """Many CSV files whose key is the file or folder name; absent keys are absent files."""
    rows = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(folder)
    folder_key = F.regexp_extract(F.col("_metadata.file_path"), rf"{key}=([^/]+)/", 1)
    file_key = F.regexp_extract(F.col("_metadata.file_name"), KEY_FROM_FILE, 1)
    # Folder names are escaped once by the writer and once more in the path.
    name = F.when(folder_key != "", F.url_decode(F.url_decode(folder_key))).otherwise(F.url_decode(file_key))
    return rows.withColumn(key, name)


def read_url_list(arrays: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """JSON arrays of strings to one row per url: trimmed, non-empty, first occurrence kept."""
    exploded = arrays.select(*order, F.posexplode(F.from_json(text, "array<string>")).alias("at", "url"))
    trimmed = exploded.select(F.struct(*order, "at").alias("pos"), F.trim("url").alias("url")).where("url <> ''")
    return trimmed.groupBy("url").agg(F.min("pos").alias("pos")).select("url", "pos.*")


def read_source_list(lists: DataFrame, text: str) -> DataFrame:
    """Source names from a JSON list of names, a list of {source, count}, or the keys of an object."""
    body = F.ltrim(F.col(text))
    entries = F.from_json(body, "array<struct<source:string>>")
    names = F.from_json(body, "array<string>")
    is_list, of_objects = body.startswith("["), body.rlike(r"^\[\s*\{")
    found = (
        F.when(of_objects, F.transform(entries, lambda e: e["source"])).when(is_list, names).otherwise(F.json_object_keys(body))
    )
    return lists.select(*[c for c in lists.columns if c != text], F.posexplode(found).alias("at", "source"))


ARTICLE = "struct<title:string,link:string,decoded_url:string,google_link:string>"


def flatten_snapshot(snapshots: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """Nested {metadata, articles: {source: [article]}} to rows in source and array order."""
    parsed = snapshots.select(*order, F.from_json(text, f"struct<articles:map<string,array<{ARTICLE}>>>").alias("s"))
    sources = parsed.select(*order, F.posexplode(F.map_entries("s.articles")).alias("source_at", "e"))
    rows = sources.select(*order, "source_at", F.col("e.key").alias("source"), F.posexplode("e.value").alias("at", "a"))
    blank = F.lit("")
    url = F.coalesce(*[F.nullif(F.col(f"a.{c}"), blank) for c in ("decoded_url", "link")], F.col("a.google_link"))
    return rows.select(*order, "source_at", "at", "source", F.col("a.title").alias("title"), url.alias("url"))


def write_split(df: DataFrame, flag: str, folder: str) -> str:
    """Success and failure outputs of one result in one write."""
    df.write.partitionBy(flag).parquet(folder)
    return folder


def write_lines(df: DataFrame, folder: str) -> str:
    """One row per line as JSON text."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    return folder


def export_metadata(df: DataFrame, as_of: str, version: str = "1.0") -> DataFrame:
    """The one-row header of a JSON export."""
    return df.agg(
        F.count("*").alias("total_articles"), F.lit(as_of).alias("generated_at"), F.lit(version).alias("format_version")
    )


def write_json(df: DataFrame, folder: str, as_of: str) -> str:
    """Rows and their one-row metadata as JSON lines in two folders."""
    df.write.json(f"{folder}/articles")
    export_metadata(df, as_of).write.json(f"{folder}/metadata")
    return folder


def write_reports(reports: dict[str, DataFrame], folder: str) -> str:
    """Several report tables under one folder, each as CSV with a header in a folder of its name."""
    for name, rows in reports.items():
        write_csv(rows, f"{folder}/{name}", rows.columns)
    return folder


def write_run_record(spark: SparkSession, folder: str, record: dict) -> str:
    """What a run was given and what it found, as one JSON row; nested values stay nested."""
    spark.createDataFrame([(json.dumps(record, sort_keys=True),)], "value string").write.text(folder)
    return folder
