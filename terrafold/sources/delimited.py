"""Delimited files with configured column names, and the configured small tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.operators.ingest import BAD_KEY, SOURCE, with_source


def read_mapped(spark: SparkSession, path: str, columns: dict[str, str], encoding: str = "utf-8", header: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """The mapped columns of a delimited file under our names, all as strings.

    ``columns``: our name to the file's. The file's header gives the order (read from its first
    line, no inference); ``header`` gives it where it is known. Quotes and line breaks in quotes
    are read as CSV has them, for which a file is one task; without ``multi_line`` (only for files
    that have no line breaks in quotes) it is split. Empty fields are empty strings. Two more
    columns say where a row is from (``ingest.SOURCE``).
    """
    names = header or spark.read.csv(path, header=True, encoding=encoding, inferSchema=False, multiLine=False).columns
    names = [n.lstrip("﻿") for n in names]
    lacking = set(columns.values()) - set(names)
    if lacking:
        raise ValueError(f"columns not in {path}: {sorted(lacking)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.csv(path, header=True, schema=schema, encoding=encoding, enforceSchema=True, quote='"', escape='"', emptyValue="", nullValue=None, multiLine=multi_line)
    return with_source(raw).select(*SOURCE, *[F.coalesce(F.col(f"`{theirs}`"), F.lit("")).alias(ours) for ours, theirs in columns.items()])


def load_yaml(path: str | Path) -> dict:
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def district_codes(spark: SparkSession, config: dict[str, dict[str, str]]) -> DataFrame:
    """(code, county, district) of a configuration of codes."""
    rows = [(str(code), x["county"], x["district"]) for code, x in config.items()]
    return spark.createDataFrame(rows, "code string, county string, district string")


def known_bad(spark: SparkSession, config: dict, source: str, county: str, data_date: str) -> DataFrame:
    """The configured bad rows of a source, county and date, by their match fields."""
    entries = ((config.get(source) or {}).get(county) or {}).get(data_date) or []
    rows = [tuple(str(e.get("match", {}).get(k, "") or "") for k in BAD_KEY) for e in entries]
    return spark.createDataFrame(rows, ", ".join(f"{k} string" for k in BAD_KEY))


def exceptions_of(config: dict, release: str | None) -> list[dict]:
    """The boundary exceptions of a release."""
    return list(config.get(str(release)) or []) if release else []


def region(config: dict, name: str) -> dict:
    if name not in config:
        raise KeyError(f"unknown region {name}; there are {sorted(config)}")
    return config[name]


def write_audit(df: DataFrame, path: str, *order: str) -> None:
    """An ordered audit as one CSV file with a header (audits are small; for people)."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, header=True, encoding="utf-8")
