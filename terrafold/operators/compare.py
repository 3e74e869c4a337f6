"""Differences between two releases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.operators import profile as P

ROW = ("lat", "lon", "display_name")


def only_in(left: DataFrame, right: DataFrame, columns: tuple[str, ...] = ROW) -> DataFrame:
    """Distinct values of ``columns`` that the right side lacks; nulls are equal."""
    return left.select(*columns).subtract(right.select(*columns))


def in_both(left: DataFrame, right: DataFrame, columns: tuple[str, ...] = ROW) -> DataFrame:
    return left.select(*columns).intersect(right.select(*columns))


def overlap_counts(old: DataFrame, new: DataFrame, columns: tuple[str, ...] = ROW) -> DataFrame:
    """One row: distinct values only in the old, only in the new, and in both; one pass over each."""
    sides = old.select(*columns, F.lit(1).alias("side")).unionByName(new.select(*columns, F.lit(2).alias("side")))
    each = sides.groupBy(*columns).agg(F.max(F.col("side") == 1).alias("o"), F.max(F.col("side") == 2).alias("n"))
    return each.agg(F.count_if(F.col("o") & ~F.col("n")).alias("removed"), F.count_if(F.col("n") & ~F.col("o")).alias("added"), F.count_if(F.col("n") & F.col("o")).alias("common"))


def moved(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: rows with the same id and name but another coordinate, and the largest differences."""
    pair = new.alias("n").join(old.alias("o"), F.expr("n.id = o.id and n.display_name = o.display_name")).where("n.lat <> o.lat or n.lon <> o.lon")
    largest = lambda c: F.coalesce(F.max(F.abs(F.col(f"n.{c}") - F.col(f"o.{c}"))), F.lit(0.0)).alias(f"max_d{c}")
    return pair.agg(F.count("*").alias("moved"), largest("lat"), largest("lon"))


def artifact_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name, status) of artifacts (name, bytes, sha256): added, removed, changed or same."""
    o = old.select("name", F.col("sha256").alias("old_sha"), F.col("bytes").alias("old_bytes"), F.lit(True).alias("in_old"))
    n = new.select("name", F.col("sha256").alias("new_sha"), F.col("bytes").alias("new_bytes"), F.lit(True).alias("in_new"))
    same = F.col("old_sha").eqNullSafe(F.col("new_sha")) & F.col("old_bytes").eqNullSafe(F.col("new_bytes"))
    status = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(same, "same").otherwise("changed")
    return o.join(n, "name", "full_outer").select("name", "old_bytes", "new_bytes", status.alias("status"))


def inspect(places: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """One row with the figures of a release: counts of rows and coordinates, floors that are left,
    addresses that are double, and ids in the search index."""
    out = P.coordinate_counts(places).crossJoin(P.residual_floors(places)).crossJoin(P.duplicate_addresses(places))
    if index is not None:
        out = out.crossJoin(index.agg(F.count_distinct("id").alias("indexed_ids")))
    return out


def accepted(figures: DataFrame) -> DataFrame:
    """Whether a release may go out: every row is indexed, no floor and no double is left."""
    indexed = F.col("indexed_ids") == F.col("rows") if "indexed_ids" in figures.columns else F.lit(True)
    return figures.withColumn("accepted", indexed & (F.col("floor_rows") == 0) & (F.col("duplicate_groups") == 0))


def report(figures: DataFrame) -> DataFrame:
    """The figures as one JSON text."""
    return figures.select(F.to_json(F.struct(*figures.columns)).alias("report"))


def markdown(row: dict, title: str = "Comparison") -> str:
    """A table of one row's figures."""
    return "\n".join([f"# {title}", "", "| figure | value |", "|---|---|", *[f"| {k} | {v} |" for k, v in row.items()], ""])
