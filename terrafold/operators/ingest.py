"""From mapped source rows to address places: cleansing, rejects, names, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.functions import geo as G
from terrafold.functions import text as T

# Text fields of a source row, and the key of the list of known bad rows.
FIELDS = ("district_code", "village", "neighbor", "street", "area", "lane", "alley", "number")
BAD_KEY = ("district_code", "village", "neighbor", "street", "lane", "alley", "number")


def stripped(raw: DataFrame) -> DataFrame:
    """Text fields without white space at their ends; missing ones are empty."""
    return raw.withColumns({c: T.blank(T.strip_space(c)) if c in raw.columns else F.lit("") for c in FIELDS})


def located(raw: DataFrame, grid: bool) -> DataFrame:
    """lat and lon as numbers: from lat and lon, or from x and y on the 121 E grid. Null where the
    source has no number (or no finite one)."""
    names = ("x", "y") if grid else ("lon", "lat")
    value = {n: F.expr(f"try_cast(trim(`{n}`) as double)") for n in names}
    good = {n: F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v) for n, v in value.items()}
    if not grid:
        return raw.withColumns(good)
    lat, lon = G.grid_to_wgs84(good["x"], good["y"])
    return raw.withColumn("lat", lat).withColumn("lon", lon)


def _matches_bad(bad: DataFrame) -> DataFrame:
    """The list of bad rows by key; fields that an entry leaves out must be empty in the row."""
    return bad.select(*[(T.blank(c) if c in bad.columns else F.lit("")).alias(f"bad_{c}") for c in BAD_KEY]).distinct().withColumn("is_bad", F.lit(True))


#: Rows that a configured list may have: it is broadcast to every task.
LISTED = 100_000


def _listed(rows: DataFrame) -> DataFrame:
    if rows.limit(LISTED + 1).count() > LISTED:
        raise ValueError(f"a configured list has more than {LISTED} rows")
    return F.broadcast(rows)


def judged(rows: DataFrame, codes: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """Rows with county, district and reject_reason: the first of no_coordinate, empty_number,
    unknown_code and dirty that holds, or null for rows to keep.

    ``codes`` (code, county, district) and ``bad`` are configured lists of at most ``LISTED`` rows.
    """
    known = _listed(codes.select(F.col("code").alias("district_code"), F.col("county"), F.col("district"), F.lit(True).alias("known")))
    out = rows.join(known, "district_code", "left")
    if bad is not None:
        listed = _listed(_matches_bad(bad))
        same = None
        for c in BAD_KEY:
            test = F.col(c) == F.col(f"bad_{c}")
            same = test if same is None else same & test
        out = out.join(listed, same, "left").drop(*[f"bad_{c}" for c in BAD_KEY])
    else:
        out = out.withColumn("is_bad", F.lit(None).cast("boolean"))
    reason = (
        F.when(F.col("lat").isNull() | F.col("lon").isNull(), "no_coordinate")
        .when(F.col("number") == "", "empty_number")
        .when(F.col("known").isNull(), "unknown_code")
        .when(F.col("is_bad"), "dirty")
    )
    return out.withColumn("reject_reason", reason).drop("known", "is_bad")


def reject_counts(rows: DataFrame) -> DataFrame:
    """(reject_reason, rows): what is rejected and why; rows without a coordinate aren't counted."""
    return rows.where("reject_reason is not null and reject_reason <> 'no_coordinate'").groupBy("reject_reason").agg(F.count("*").alias("rows"))


#: Ranges that an order is cut into, from this many sampled keys at most.
_RANGES, _SAMPLED = 256, 20_000


#: Columns that say where a row is from: its file, and where in it its split begins.
SOURCE = ("_file", "_split")


def with_source(scan: DataFrame) -> DataFrame:
    """A scan of files with the columns ``SOURCE``, which ``with_ids`` goes by (and drops)."""
    return scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"))


def with_ids(rows: DataFrame, name: str = "id") -> DataFrame:
    """Rows numbered from 1 in the order of their source: file by path, then place in it.

    A scan deals the splits of files to tasks by size, so the order comes from the columns
    ``SOURCE``; rows without them are numbered by partition. Each split is numbered by itself and
    gets the rows of those before it added, so no task sees all rows. ``rows`` must be a scan with
    filters, projections and broadcast joins only: then each of the passes has the same partitions.
    Others have ``numbered``.
    """
    marked = rows.withColumn("_m", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m") % (1 << 33))
    order = [c for c in SOURCE if c in rows.columns]
    keys = ["_p", *order]
    sizes = marked.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    before = Window.orderBy(*order, "_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = marked.join(offsets, keys)
    return placed.withColumn(name, F.col("_before") + F.col("_i") - F.col("_first") + 1).drop("_m", "_i", "_before", "_first", *keys)


def numbered(rows: DataFrame, key: str, *more: str, name: str = "id") -> DataFrame:
    """Rows numbered from 1 by a numeric key (nulls first), then by further columns.

    The key's range is cut at quantiles of a bounded sample, which are literals from then on: each
    range is ranked by itself and gets the rows of those before it added. The result doesn't
    depend on how rows are partitioned.
    """
    total = rows.count()
    share = min(1.0, _SAMPLED / max(total, 1))
    drawn = sorted(r[0] for r in (rows if share == 1.0 else rows.sample(share, seed=7)).select(key).where(F.col(key).isNotNull()).collect())
    cuts = sorted({drawn[i * len(drawn) // _RANGES] for i in range(1, _RANGES)}) if drawn else []
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(key))) if cuts else F.lit(0)
    ranged = rows.withColumn("_p", F.when(F.col(key).isNull(), -1).otherwise(part))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_p").orderBy(key, *more))
    return ranged.join(F.broadcast(offsets), "_p").withColumn(name, (F.col("_before") + own).cast("long")).drop("_p", "_before")


def places(rows: DataFrame, source: str = "tgos") -> DataFrame:
    """Kept rows as places (without ids): composed names, empty parts null."""
    parts = ("county", "district", "village", "street", "area", "lane", "alley", "number")
    kept = rows.where("reject_reason is null")
    return kept.select(
        F.lit(source).alias("source"), F.lit(None).cast("long").alias("osm_id"), "lat", "lon", "district_code", "county", F.col("district").alias("township"),
        *[T.none_if_blank(c).alias(c) for c in ("village", "neighbor", "street", "area", "lane", "alley")], "number",
        T.short_name("street", "area", "lane", "alley", "number").alias("name"),
        T.display_name(*parts).alias("display_name"), T.display_name(*parts, half=True).alias("display_name_halfwidth"), *[c for c in SOURCE if c in rows.columns],
    )


def ingest(raw: DataFrame, codes: DataFrame, bad: DataFrame | None = None, grid: bool = False, source: str = "tgos") -> tuple[DataFrame, DataFrame]:
    """(places with ids, counts of rejects) of mapped source rows."""
    rows = judged(stripped(located(raw, grid)), codes, bad)
    return with_ids(places(rows, source)), reject_counts(rows)
