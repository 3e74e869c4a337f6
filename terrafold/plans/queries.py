"""The registered queries over the driver's tables, each with its SQL twin.

The tables have no addresses: an address view is derived from ``orders`` by the same arithmetic on
both sides, areas and roads are literal shapes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import geo as G
from terrafold.functions import text as T
from terrafold.operators import compare as C
from terrafold.operators import ingest as I
from terrafold.operators import metadata as M
from terrafold.operators import profile as P
from terrafold.operators import quality as Q
from terrafold.operators import reduction as R
from terrafold.operators import search as X
from terrafold.operators import spatial as S
from terrafold.plans import build as B
from terrafold.sources import osm as O

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

_ADDR = """
SELECT o_orderkey AS id,
       cast(23.55 as double) + cast(o_custkey % 40 as double) / cast(100 as double) AS lat,
       cast(120.2 as double) + cast(o_custkey % 25 as double) / cast(100 as double) AS lon,
       o_orderstatus AS village,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('S', cast(o_custkey % 3 as {STR})) END AS street,
       CASE WHEN o_orderkey % 10 = 0 THEN concat('A', cast(o_custkey % 3 as {STR})) END AS area,
       concat(translate(cast(o_custkey % 7 + 1 as {STR}), '0123456789', '０１２３４５６７８９'), '號',
              CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN '二樓' ELSE '地下一層' END) AS number
FROM {orders}"""
_ADDR_SQL = _ADDR.format(STR="varchar", orders="orders")


def query(sql: str = "") -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql.replace("{ADDR}", f"addr AS ({_ADDR_SQL})")
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address view, with the columns of places that it lacks."""
    return spark.sql(_ADDR.format(STR="string", orders="{orders}"), orders=table(spark, sf_dir, "orders"))


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = addresses(spark, sf_dir).withColumn("county", F.lit("台中市")).withColumn("township", F.lit("中區"))
    parts = ("county", "township", "village", "street", "area", F.lit(""), F.lit(""), "number")
    return a.withColumn("display_name", T.display_name(*parts)).withColumn("display_name_halfwidth", T.display_name(*parts, half=True)).withColumn("name", T.short_name(*parts[3:]))


_HALF = "translate({x}, '０１２３４５６７８９－．', '0123456789-.')"
_HYPHEN = "replace(translate({x}, '０１２３４５６７８９－．', '0123456789-.'), '之', '-')"
_IS_FLOOR = "(instr({n}, '號') > 0 AND greatest(instr({n}, '樓'), instr({n}, '層')) > instr({n}, '號'))"
_FLOOR = _IS_FLOOR.format(n="number")
_BASE = f"CASE WHEN {_FLOOR} THEN substring(number, 1, instr(number, '號')) ELSE number END"
_HEAD = "coalesce(street, area, '')"
_NAMED_SQL = f"""named AS (SELECT *, '台中市' AS county, '中區' AS township,
  concat('台中市中區', coalesce(village,''), {_HEAD}, number) AS display_name,
  concat('台中市中區', coalesce(village,''), {_HALF.format(x=_HEAD)}, {_HYPHEN.format(x='number')}) AS display_name_halfwidth,
  concat({_HALF.format(x=_HEAD)}, {_HYPHEN.format(x='number')}) AS name FROM addr)"""
_RANKED = f"""flagged AS (SELECT *, CASE WHEN {_FLOOR} THEN 1 ELSE 0 END AS is_floor, {_BASE} AS base_number FROM {{src}}),
 counted AS (SELECT *, cast(sum(CASE WHEN is_floor = 0 THEN 1 ELSE 0 END) OVER w AS bigint) AS ground_count,
   min(CASE WHEN is_floor = 0 THEN id END) OVER w AS lowest_ground_id, min(CASE WHEN is_floor = 1 THEN id END) OVER w AS lowest_floor_id
   FROM flagged WINDOW w AS (PARTITION BY lat, lon, coalesce(village,''), {_HEAD}, base_number)),
 ranked AS (SELECT *, coalesce(lowest_ground_id, lowest_floor_id) AS kept_id,
   CASE WHEN is_floor = 1 AND (ground_count > 0 OR id <> lowest_floor_id) THEN 1 ELSE 0 END AS to_drop,
   CASE WHEN is_floor = 1 AND ground_count = 0 AND id = lowest_floor_id THEN 1 ELSE 0 END AS to_synthesize FROM counted)"""
_R_ADDR = _RANKED.replace("{src}", "addr")
_R_NAMED = _RANKED.replace("{src}", "named")
_STAGE1 = "stage1 AS (SELECT id, lat, lon, village, street, area, CASE WHEN to_synthesize = 1 THEN base_number ELSE number END AS number FROM ranked WHERE to_drop = 0)"


# --- scalar functions -------------------------------------------------------------------------
@query(f"WITH {{ADDR}} SELECT id, {_HALF.format(x='number')} AS half, {_HYPHEN.format(x='number')} AS hyphen FROM addr")
def number_forms(spark, sf_dir):
    return addresses(spark, sf_dir).select("id", T.half_width("number").alias("half"), T.hyphen_number("number").alias("hyphen"))


@query(f"WITH {{ADDR}}, {_NAMED_SQL} SELECT id, display_name, display_name_halfwidth, name FROM named")
def compose_display(spark, sf_dir):
    return named(spark, sf_dir).select("id", "display_name", "display_name_halfwidth", "name")


@query(f"WITH {{ADDR}} SELECT id, {_FLOOR} AS is_floor, {_BASE} AS base_number FROM addr")
def base_numbers(spark, sf_dir):
    return addresses(spark, sf_dir).select("id", T.is_floor("number").alias("is_floor"), T.base_number("number").alias("base_number"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def sha256_rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


_HAV = "2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({d} - {c}) / 2), 2))))"


@query(f"WITH {{ADDR}} SELECT id, round({_HAV.format(a='lat', b='cast(24.14 as double)', c='lon', d='cast(120.68 as double)')}, 3) AS metres FROM addr")
def haversine(spark, sf_dir):
    return addresses(spark, sf_dir).select("id", F.round(G.haversine_m("lat", "lon", F.lit(24.14), F.lit(120.68)), 3).alias("metres"))


def _tm2_sql() -> str:
    r = G._K0 * G._RECTIFYING
    xi1, eta1 = "xi", "eta"
    for j, b in enumerate(G._BETA, 1):
        xi1 += f" - {b!r}::double * sin({2 * j} * xi) * cosh({2 * j} * eta)"
        eta1 += f" - {b!r}::double * cos({2 * j} * xi) * sinh({2 * j} * eta)"
    lat = "chi" + "".join(f" + {d!r}::double * sin({2 * j} * chi)" for j, d in enumerate(G._DELTA, 1))
    return f"""WITH g AS (SELECT o_orderkey AS id, cast(210000 + o_custkey % 30000 as double) AS x, cast(2660000 + o_custkey % 20000 as double) AS y FROM orders),
      a AS (SELECT id, y / {r!r}::double AS xi, (x - 250000.0) / {r!r}::double AS eta FROM g),
      b AS (SELECT id, {xi1} AS xi1, {eta1} AS eta1 FROM a), c AS (SELECT id, xi1, eta1, asin(sin(xi1) / cosh(eta1)) AS chi FROM b)
      SELECT id, round(degrees({lat}), 7) AS lat, round(121.0 + degrees(atan2(sinh(eta1), cos(xi1))), 7) AS lon FROM c"""


@query(_tm2_sql())
def grid_to_wgs84(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    x, y = (210000 + F.col("o_custkey") % 30000).cast("double"), (2660000 + F.col("o_custkey") % 20000).cast("double")
    lat, lon = G.grid_to_wgs84(x, y)
    return o.select(F.col("o_orderkey").alias("id"), F.round(lat, 7).alias("lat"), F.round(lon, 7).alias("lon"))


# --- ingest -----------------------------------------------------------------------------------
_RAW_SQL = """raw AS (SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 37 = 0 THEN 'bad' ELSE cast(120.5 as varchar) END AS lon, '24.1' AS lat,
   cast(o_custkey % 30 as varchar) AS district_code, concat(' v', cast(o_custkey % 5 as varchar), '　') AS village,
   CASE WHEN o_orderkey % 11 = 0 THEN '  ' ELSE concat(cast(o_custkey % 9 as varchar), '號') END AS number FROM orders),
  codes AS (SELECT cast(n_nationkey as varchar) AS code, n_name AS district, concat('C', cast(n_regionkey as varchar)) AS county FROM nation),
  judged AS (SELECT seq, r.district_code, trim(r.village, ' 　') AS village, trim(r.number) AS number, c.county, c.district,
    CASE WHEN r.lon = 'bad' THEN 'no_coordinate' WHEN trim(r.number) = '' THEN 'empty_number' WHEN c.code IS NULL THEN 'unknown_code'
         WHEN r.district_code = '7' AND trim(r.village, ' 　') = 'v2' AND trim(r.number) = '7號' THEN 'dirty' END AS reject_reason
    FROM raw r LEFT JOIN codes c ON c.code = r.district_code)"""


def _raw(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    raw = o.select(
        k.alias("seq"), F.when(k % 37 == 0, "bad").otherwise("120.5").alias("lon"), F.lit("24.1").alias("lat"), (c % 30).cast("string").alias("district_code"),
        F.concat(F.lit(" v"), (c % 5).cast("string"), F.lit("　")).alias("village"), F.when(k % 11 == 0, "  ").otherwise(F.concat((c % 9).cast("string"), F.lit("號"))).alias("number"),
    )
    codes = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("district"), F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("county"))
    bad = spark.createDataFrame([("7", "v2", "", "", "", "", "7號")], ", ".join(f"{c} string" for c in I.BAD_KEY))
    return I.judged(I.stripped(I.located(raw, grid=False)), codes, bad)


@query(f"WITH {_RAW_SQL} SELECT seq, district_code, village, number, county, district FROM judged WHERE reject_reason IS NULL")
def ingest_clean(spark, sf_dir):
    return _raw(spark, sf_dir).where("reject_reason is null").select("seq", "district_code", "village", "number", "county", "district")


@query(f"WITH {_RAW_SQL} SELECT reject_reason, count(*) AS rows FROM judged WHERE reject_reason <> 'no_coordinate' GROUP BY reject_reason")
def ingest_reject_counts(spark, sf_dir):
    return I.reject_counts(_raw(spark, sf_dir))


@query("SELECT row_number() OVER (ORDER BY c_custkey) AS id, c_custkey FROM customer")
def source_order_ids(spark, sf_dir):
    return I.numbered(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("id", "c_custkey")


# --- reduction --------------------------------------------------------------------------------
@query(f"WITH {{ADDR}}, {_R_ADDR} SELECT id, is_floor, base_number, ground_count, kept_id, to_drop, to_synthesize FROM ranked")
def floor_stage1_flags(spark, sf_dir):
    return R.floor_flags(addresses(spark, sf_dir)).select("id", "is_floor", "base_number", "ground_count", "kept_id", "to_drop", "to_synthesize")


@query(f"WITH {{ADDR}}, {_R_ADDR}, {_STAGE1} SELECT * FROM stage1")
def floor_stage1_result(spark, sf_dir):
    return R.consolidate_floors(addresses(spark, sf_dir))


@query(
    f"""WITH {{ADDR}}, {_NAMED_SQL}, {_R_NAMED} SELECT r.id AS removed_id, r.lat, r.lon, r.number, r.base_number, r.display_name, r.kept_id, k.display_name AS kept_display_name,
    CASE WHEN r.ground_count > 0 THEN 'matched-existing-base' ELSE 'merged-floor-variants' END AS reason FROM ranked r LEFT JOIN named k ON k.id = r.kept_id WHERE r.to_drop = 1"""
)
def floor_removal_audit(spark, sf_dir):
    return R.floor_removals(named(spark, sf_dir))


@query(
    f"""WITH {{ADDR}}, {_NAMED_SQL}, {_R_NAMED} SELECT id AS kept_id, lat, lon, number AS original_number, base_number, display_name AS original_display_name,
    concat('台中市中區', coalesce(village,''), {_HEAD}, base_number) AS new_display_name FROM ranked WHERE to_synthesize = 1"""
)
def floor_synthesis_audit(spark, sf_dir):
    return R.floor_syntheses(named(spark, sf_dir))


@query(
    f"""WITH {{ADDR}}, {_R_ADDR} SELECT count(*) AS total_rows, cast(sum(to_drop) as bigint) AS to_drop, cast(sum(to_synthesize) as bigint) AS to_synthesize,
    cast(sum(CASE WHEN is_floor = 0 AND (number LIKE '%樓%' OR number LIKE '%層%') THEN 1 ELSE 0 END) as bigint) AS ambiguous_markers FROM ranked"""
)
def floor_summary(spark, sf_dir):
    return R.floor_summary(addresses(spark, sf_dir))


_STAGE2 = f"""twice AS (SELECT *, row_number() OVER (PARTITION BY lat, lon, coalesce(village,''), {_HEAD}, number ORDER BY id) AS rn,
   count(*) OVER (PARTITION BY lat, lon, coalesce(village,''), {_HEAD}, number) AS group_size,
   min(id) OVER (PARTITION BY lat, lon, coalesce(village,''), {_HEAD}, number) AS kept_id FROM stage1)"""


@query(f"WITH {{ADDR}}, {_R_ADDR}, {_STAGE1}, {_STAGE2} SELECT id, lat, lon, village, street, area, number FROM twice WHERE rn = 1")
def reduced_addresses(spark, sf_dir):
    return R.reduce_addresses(addresses(spark, sf_dir))


@query(f"WITH {{ADDR}}, {_R_ADDR}, {_STAGE1}, {_STAGE2} SELECT id, cast(rn as bigint) AS rn, group_size, kept_id FROM twice")
def collapse_stage2(spark, sf_dir):
    return R.duplicate_ranks(R.consolidate_floors(addresses(spark, sf_dir))).select("id", F.col("rn").cast("long").alias("rn"), "group_size", "kept_id")


@query(f"WITH {{ADDR}}, {_R_ADDR}, {_STAGE1}, {_STAGE2} SELECT id AS removed_id, lat, lon, number, kept_id FROM twice WHERE rn > 1")
def collapse_audit(spark, sf_dir):
    return R.duplicate_removals(R.consolidate_floors(addresses(spark, sf_dir))).select("removed_id", "lat", "lon", "number", "kept_id")


@query(f"WITH {{ADDR}}, {_R_ADDR}, {_STAGE1}, {_STAGE2} SELECT count(*) AS total_rows, cast(sum(CASE WHEN rn > 1 THEN 1 ELSE 0 END) as bigint) AS removed FROM twice")
def collapse_summary(spark, sf_dir):
    return R.duplicate_summary(R.consolidate_floors(addresses(spark, sf_dir)))


# --- profiles ---------------------------------------------------------------------------------
_GROUPS = f"groups AS (SELECT lat, lon, count(*) AS c, cast(sum(CASE WHEN {_FLOOR} THEN 1 ELSE 0 END) as bigint) AS floor_c FROM addr GROUP BY lat, lon HAVING count(*) > 1)"


@query(f"WITH {{ADDR}}, {_GROUPS} SELECT * FROM groups")
def duplicate_groups(spark, sf_dir):
    return P.duplicate_groups(addresses(spark, sf_dir))


@query(
    f"""WITH {{ADDR}}, {_GROUPS} SELECT count(*) AS groups, cast(coalesce(sum(c),0) as bigint) AS rows_in_groups, cast(coalesce(sum(floor_c),0) as bigint) AS floor_rows,
    (SELECT count(*) FROM addr) AS total_rows, cast(coalesce(sum(c),0) - count(*) as bigint) AS redundant,
    round(cast(100 as double) * cast(coalesce(sum(c),0) - count(*) as double) / cast((SELECT count(*) FROM addr) as double), 4) AS redundant_percent FROM groups"""
)
def duplicate_totals(spark, sf_dir):
    return P.group_totals(addresses(spark, sf_dir))


_BUCKET = "CASE WHEN c <= 2 THEN '2' WHEN c <= 5 THEN '3-5' WHEN c <= 10 THEN '6-10' WHEN c <= 50 THEN '11-50' WHEN c <= 200 THEN '51-200' ELSE '200+' END"


@query(f"WITH g AS (SELECT l_partkey, l_suppkey, count(*) AS c FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) SELECT {_BUCKET} AS bucket, count(*) AS groups, cast(sum(c) as bigint) AS rows FROM g GROUP BY 1")
def duplicate_histogram(spark, sf_dir):
    return P.group_histogram(table(spark, sf_dir, "lineitem"), ("l_partkey", "l_suppkey"))


@query(f"WITH {{ADDR}}, {_GROUPS} SELECT * FROM groups ORDER BY c DESC, lat, lon LIMIT 10")
def duplicate_top(spark, sf_dir):
    return P.largest_groups(addresses(spark, sf_dir), 10)


@query(
    f"""WITH {{ADDR}}, {_GROUPS}, top AS (SELECT * FROM groups ORDER BY c DESC, lat, lon LIMIT 10),
    r AS (SELECT a.lat, a.lon, a.id, a.number, t.c, row_number() OVER (PARTITION BY a.lat, a.lon ORDER BY a.id) AS rn FROM addr a JOIN top t ON a.lat = t.lat AND a.lon = t.lon)
    SELECT lat, lon, id, number, c FROM r WHERE rn <= 3"""
)
def duplicate_samples(spark, sf_dir):
    return P.group_samples(addresses(spark, sf_dir), 10, 3).select("lat", "lon", "id", "number", "c")


@query(f"WITH {{ADDR}}, {_GROUPS} SELECT g.lat, g.lon, g.c, (SELECT min(id) FROM addr a WHERE a.lat = g.lat AND a.lon = g.lon) AS first_id FROM groups g")
def duplicate_export(spark, sf_dir):
    return P.group_export(addresses(spark, sf_dir), "number").select("lat", "lon", "c", "first_id")


@query(f"WITH {{ADDR}}, {_GROUPS} SELECT a.id, a.lat, a.lon, a.number, g.c AS address_count FROM addr a JOIN groups g ON a.lat = g.lat AND a.lon = g.lon")
def shared_coordinates(spark, sf_dir):
    return P.shared_coordinates(addresses(spark, sf_dir)).select("id", "lat", "lon", "number", "address_count")


@query(
    """WITH {ADDR}, s AS (SELECT lat, lon, count(*) AS c FROM addr GROUP BY lat, lon) SELECT cast(sum(c) as bigint) AS rows, count(*) AS unique_coordinates,
    cast(sum(CASE WHEN c > 1 THEN 1 ELSE 0 END) as bigint) AS shared_coordinates, cast(max(c) as bigint) AS max_rows_per_coordinate FROM s"""
)
def coordinate_counts(spark, sf_dir):
    return P.coordinate_counts(addresses(spark, sf_dir))


@query(f"WITH {{ADDR}}, d AS (SELECT 1 FROM addr GROUP BY lat, lon, coalesce(village,''), {_HEAD}, number HAVING count(*) > 1) SELECT count(*) AS duplicate_groups FROM d")
def duplicate_addresses(spark, sf_dir):
    return P.duplicate_addresses(addresses(spark, sf_dir))


@query(f"WITH {{ADDR}} SELECT count(*) AS floor_rows FROM addr WHERE {_FLOOR}")
def residual_floors(spark, sf_dir):
    return P.residual_floors(addresses(spark, sf_dir))


# --- comparison -------------------------------------------------------------------------------
_OLD_NEW = f"""{_NAMED_SQL}, old AS (SELECT * FROM named WHERE id % 5 <> 0),
  new AS (SELECT id, CASE WHEN id % 7 = 0 THEN lat + cast(0.001 as double) ELSE lat END AS lat, lon, display_name FROM named WHERE id % 4 <> 0)"""


def _old_new(spark, sf_dir):
    a = named(spark, sf_dir)
    return a.where("id % 5 <> 0"), a.where("id % 4 <> 0").withColumn("lat", F.when(F.col("id") % 7 == 0, F.col("lat") + 0.001).otherwise(F.col("lat")))


@query(f"WITH {{ADDR}}, {_OLD_NEW} SELECT lat, lon, display_name FROM new EXCEPT SELECT lat, lon, display_name FROM old")
def snapshot_except(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return C.only_in(new, old)


@query(f"WITH {{ADDR}}, {_OLD_NEW} SELECT lat, lon, display_name FROM new INTERSECT SELECT lat, lon, display_name FROM old")
def snapshot_intersect(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return C.in_both(new, old)


@query(
    f"""WITH {{ADDR}}, {_OLD_NEW} SELECT (SELECT count(*) FROM (SELECT display_name FROM old EXCEPT SELECT display_name FROM new)) AS removed,
    (SELECT count(*) FROM (SELECT display_name FROM new EXCEPT SELECT display_name FROM old)) AS added,
    (SELECT count(*) FROM (SELECT display_name FROM new INTERSECT SELECT display_name FROM old)) AS common"""
)
def snapshot_overlap(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return C.overlap_counts(old, new, ("display_name",))


@query(
    f"""WITH {{ADDR}}, {_OLD_NEW} SELECT count(*) AS moved, round(coalesce(max(abs(n.lat - o.lat)), 0), 9) AS max_dlat, round(coalesce(max(abs(n.lon - o.lon)), 0), 9) AS max_dlon
    FROM new n JOIN old o ON n.id = o.id AND n.display_name = o.display_name WHERE n.lat <> o.lat OR n.lon <> o.lon"""
)
def snapshot_delta(spark, sf_dir):
    return C.moved(*_old_new(spark, sf_dir)).select("moved", F.round("max_dlat", 9).alias("max_dlat"), F.round("max_dlon", 9).alias("max_dlon"))


@query(
    """WITH o AS (SELECT c_name AS name, c_mktsegment AS sha, c_nationkey AS b FROM customer WHERE c_custkey % 3 <> 0),
    n AS (SELECT c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE c_mktsegment END AS sha, c_nationkey AS b FROM customer WHERE c_custkey % 4 <> 0)
    SELECT coalesce(o.name, n.name) AS name, coalesce(o.b, -1) AS old_bytes, coalesce(n.b, -1) AS new_bytes, CASE WHEN o.name IS NULL THEN 'added' WHEN n.name IS NULL THEN 'removed' WHEN o.sha = n.sha THEN 'same' ELSE 'changed' END AS status
    FROM o FULL OUTER JOIN n ON o.name = n.name"""
)
def artifact_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    shape = lambda df, sha: df.select(F.col("c_name").alias("name"), sha.alias("sha256"), F.col("c_nationkey").alias("bytes"))
    old = shape(c.where("c_custkey % 3 <> 0"), F.col("c_mktsegment"))
    new = shape(c.where("c_custkey % 4 <> 0"), F.when(F.col("c_custkey") % 5 == 0, "x").otherwise(F.col("c_mktsegment")))
    return C.artifact_changes(old, new).fillna(-1, ["old_bytes", "new_bytes"])


@query(
    f"""WITH {{ADDR}}, {_R_ADDR}, {_STAGE1}, {_STAGE2}, final AS (SELECT * FROM twice WHERE rn = 1), s AS (SELECT lat, lon, count(*) AS c FROM final GROUP BY lat, lon)
    SELECT cast(sum(c) as bigint) AS rows, count(*) AS unique_coordinates, cast(sum(CASE WHEN c > 1 THEN 1 ELSE 0 END) as bigint) AS shared_coordinates, cast(max(c) as bigint) AS max_rows_per_coordinate,
    (SELECT count(*) FROM final WHERE {_FLOOR}) AS floor_rows, cast(0 as bigint) AS duplicate_groups, (SELECT count(*) FROM final WHERE {_FLOOR}) = 0 AS accepted FROM s"""
)
def release_figures(spark, sf_dir):
    return C.accepted(C.inspect(R.reduce_addresses(addresses(spark, sf_dir))))


# --- metadata ---------------------------------------------------------------------------------
_META = """old AS (SELECT r_name AS artifact, 'data_version' AS key, concat('v', cast(r_regionkey as varchar)) AS value FROM region),
  new AS (SELECT r_name AS artifact, k AS key, 'v2' AS value FROM region CROSS JOIN (SELECT unnest(['data_version', 'stamped']) AS k) WHERE r_regionkey > 1)"""


def _meta(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    old = r.select(F.col("r_name").alias("artifact"), F.lit("data_version").alias("key"), F.concat(F.lit("v"), F.col("r_regionkey").cast("string")).alias("value"))
    new = r.where("r_regionkey > 1").select(F.col("r_name").alias("artifact"), F.explode(F.array(F.lit("data_version"), F.lit("stamped"))).alias("key"), F.lit("v2").alias("value"))
    return old, new


@query(f"WITH {_META} SELECT coalesce(o.artifact, n.artifact) AS artifact, coalesce(o.key, n.key) AS key, coalesce(n.value, o.value) AS value FROM old o FULL OUTER JOIN new n ON o.artifact = n.artifact AND o.key = n.key")
def metadata_upsert(spark, sf_dir):
    return M.upsert(*_meta(spark, sf_dir))


@query(f"WITH {_META} SELECT n.artifact, n.key, n.value AS expected, o.value AS actual FROM new n LEFT JOIN old o ON o.artifact = n.artifact AND o.key = n.key WHERE o.value IS NULL OR o.value <> n.value")
def metadata_mismatch(spark, sf_dir):
    return M.mismatches(*_meta(spark, sf_dir))


# --- spatial ----------------------------------------------------------------------------------
#: Literal areas (id, level, name, county, rings): one with a hole, overlapping levels, a county.
_AREAS = [
    (1, 8, "甲鄉", "東縣", [[(120.2, 23.55), (120.3, 23.55), (120.3, 23.75), (120.2, 23.75), (120.2, 23.55)]]),
    (2, 7, "乙區", None, [[(120.25, 23.6), (120.42, 23.6), (120.42, 23.92), (120.25, 23.92), (120.25, 23.6)], [(120.3, 23.65), (120.35, 23.65), (120.35, 23.7), (120.3, 23.7), (120.3, 23.65)]]),
    (3, 8, "丙鎮", "西縣", [[(120.3, 23.7), (120.45, 23.7), (120.4, 23.95), (120.3, 23.7)]]),
    (4, 4, "東縣", None, [[(120.19, 23.5), (120.33, 23.5), (120.33, 24.0), (120.19, 24.0), (120.19, 23.5)]]),
]
#: Literal roads (id, name, highway, points).
_ROADS = [
    (1, "中山路", "primary", [(120.2, 23.553), (120.3, 23.603), (120.45, 23.603)]),
    (2, "中正路", "secondary", [(120.263, 23.5), (120.263, 24.0)]),
    (3, "和平路", "residential", [(120.3, 23.8), (120.4, 23.81), (120.41, 23.9)]),
]


def _edge_rows(shapes):
    return [(i, *a, *b) for i, rings in shapes for r in rings for a, b in zip(r, r[1:], strict=False)]


_AREA_EDGES, _ROAD_EDGES = _edge_rows([(x[0], x[4]) for x in _AREAS]), _edge_rows([(x[0], [x[3]]) for x in _ROADS])


def _values(rows) -> str:
    lit = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"cast({v!r} as double)" if isinstance(v, float) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


_SHAPES_SQL = f"""areas(area_id, level, name, county) AS ({_values([x[:4] for x in _AREAS])}), edges(area_id, x1, y1, x2, y2) AS ({_values(_AREA_EDGES)}),
 roads(line_id, name, highway) AS ({_values([x[:3] for x in _ROADS])}), redges(line_id, x1, y1, x2, y2) AS ({_values(_ROAD_EDGES)})"""
_COVERS = """tested AS (SELECT p.id, e.area_id, sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) AS crossings,
   max(CASE WHEN abs((x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1)) <= 1e-12 AND lon >= least(x1, x2) AND lon <= greatest(x1, x2) AND lat >= least(y1, y2) AND lat <= greatest(y1, y2) THEN 1 ELSE 0 END) AS touches
   FROM addr p CROSS JOIN edges e GROUP BY p.id, e.area_id), covers AS (SELECT id, area_id FROM tested WHERE crossings % 2 = 1 OR touches = 1)"""
_TOWN = """hits AS (SELECT c.id, a.* FROM covers c JOIN areas a ON a.area_id = c.area_id), own AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE level WHEN 8 THEN 0 ELSE 1 END, area_id) AS rn FROM hits WHERE level IN (7, 8)),
 town AS (SELECT o.id, o.area_id, o.level, coalesce(o.county, (SELECT min(h.name) FROM hits h WHERE h.id = o.id AND h.level = 4)) AS county, o.name FROM own o WHERE rn = 1)"""


def _shapes(spark):
    areas = spark.createDataFrame([x[:4] for x in _AREAS], "area_id int, level int, name string, county string")
    edges = spark.createDataFrame(_AREA_EDGES, "area_id int, x1 double, y1 double, x2 double, y2 double")
    roads = spark.createDataFrame([x[:3] for x in _ROADS], "line_id int, name string, highway string")
    return areas, edges, roads, spark.createDataFrame(_ROAD_EDGES, "line_id int, x1 double, y1 double, x2 double, y2 double")


@query(f"WITH {{ADDR}}, {_SHAPES_SQL}, {_COVERS} SELECT id, area_id FROM covers")
def point_in_polygon(spark, sf_dir):
    return S.covering(addresses(spark, sf_dir), _shapes(spark)[1])


@query(f"WITH {{ADDR}}, {_SHAPES_SQL}, {_COVERS}, {_TOWN} SELECT * FROM town")
def township_priority(spark, sf_dir):
    areas, edges, _, _ = _shapes(spark)
    return S.containing_area(addresses(spark, sf_dir), areas, edges).select("id", "area_id", "level", "county", "name")


@query(f"WITH {{ADDR}}, {_SHAPES_SQL}, {_COVERS} SELECT id, lat, lon FROM addr WHERE id NOT IN (SELECT c.id FROM covers c JOIN areas a ON a.area_id = c.area_id WHERE a.name IN ('東縣'))")
def spatial_anti(spark, sf_dir):
    areas, edges, _, _ = _shapes(spark)
    return S.outside(addresses(spark, sf_dir).select("id", "lat", "lon"), areas, edges, ["東縣"])


_SEG = "seg AS (SELECT id, {key}, lat, lon, x1 + t * (x2 - x1) AS qx, y1 + t * (y2 - y1) AS qy FROM (SELECT p.id, p.lat, p.lon, e.*, greatest(0.0, least(1.0, coalesce(((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0.0))) AS t FROM addr p CROSS JOIN {edges} e) z), planar AS (SELECT *, row_number() OVER (PARTITION BY id, {key} ORDER BY pow(lon - qx, 2) + pow(lat - qy, 2), qx, qy) AS rp FROM seg), metres AS (SELECT id, lat, lon, {key}, " + _HAV.format(a="lat", b="qy", c="lon", d="qx") + " AS m FROM planar WHERE rp = 1)"
_NEAR_ROAD = _SEG.format(key="line_id", edges="redges") + """, boxes AS (SELECT line_id, min(least(y1, y2)) AS s, max(greatest(y1, y2)) AS n, min(least(x1, x2)) AS w, max(greatest(x1, x2)) AS e FROM redges GROUP BY line_id),
 nearest AS (SELECT m.*, row_number() OVER (PARTITION BY id ORDER BY m, m.line_id) AS r FROM metres m JOIN boxes b ON b.line_id = m.line_id AND b.n >= lat - 0.01 AND b.s <= lat + 0.01 AND b.e >= lon - 0.01 AND b.w <= lon + 0.01)"""


@query(f"WITH {{ADDR}}, {_SHAPES_SQL}, {_NEAR_ROAD} SELECT id, line_id, round(m, 3) AS distance_m FROM nearest WHERE r = 1")
def nearest_line(spark, sf_dir):
    return S.nearest_line(addresses(spark, sf_dir), _shapes(spark)[3]).select("id", "line_id", F.round("distance_m", 3).alias("distance_m"))


_AREA_BOXES = "abox AS (SELECT area_id, min(least(y1, y2)) AS s, max(greatest(y1, y2)) AS n, min(least(x1, x2)) AS w, max(greatest(x1, x2)) AS e FROM {edges} GROUP BY area_id)"
_SNAPPED = "snap AS (SELECT m.*, row_number() OVER (PARTITION BY id ORDER BY m, m.area_id) AS r FROM {metres} m JOIN abox b ON b.area_id = m.area_id AND b.n >= lat - {d} AND b.s <= lat + {d} AND b.e >= lon - {d} AND b.w <= lon + {d} WHERE m <= {tolerance})"


@query(f"WITH {{ADDR}}, {_SHAPES_SQL}, {_SEG.format(key='area_id', edges='edges')}, {_AREA_BOXES.format(edges='edges')}, {_SNAPPED.format(metres='metres', d='(900.0 / 111000)', tolerance='900')} SELECT id, area_id, round(m, 3) AS distance_m FROM snap WHERE r = 1")
def snap_nearest(spark, sf_dir):
    return S.snapped_area(addresses(spark, sf_dir), _shapes(spark)[1], 900.0).select("id", "area_id", F.round("distance_m", 3).alias("distance_m"))


_POINTS_SQL = "q AS (SELECT s_suppkey AS id, cast(23.55 as double) + cast(s_suppkey % 397 as double) / cast(1000 as double) AS lat, cast(120.2 as double) + cast(s_suppkey % 243 as double) / cast(1000 as double) AS lon FROM supplier)"
_NEAR_POINT = f"""cand AS (SELECT q.id, a.id AS place_id, {_HAV.format(a="q.lat", b="a.lat", c="q.lon", d="a.lon")} AS m,
   CASE WHEN abs(a.lat - q.lat) <= 0.001 AND abs(a.lon - q.lon) <= 0.001 THEN 1 WHEN abs(a.lat - q.lat) <= 0.005 AND abs(a.lon - q.lon) <= 0.005 THEN 2 ELSE 3 END AS step
   FROM q JOIN addr a ON abs(a.lat - q.lat) <= 0.025 AND abs(a.lon - q.lon) <= 0.025),
 hit AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step, m, place_id) AS r FROM cand)"""


def _points(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    part = lambda n: (F.col("s_suppkey") % n).cast("double") / F.lit(1000.0)
    return s.select(F.col("s_suppkey").alias("id"), (F.lit(23.55) + part(397)).alias("lat"), (F.lit(120.2) + part(243)).alias("lon"))


@query(f"WITH {{ADDR}}, {_POINTS_SQL}, {_NEAR_POINT} SELECT id, place_id, round(m, 3) AS distance_m FROM hit WHERE r = 1")
def nearest_point(spark, sf_dir):
    places = addresses(spark, sf_dir).select(F.col("id").alias("place_id"), "lat", "lon")
    return S.nearest_point(_points(spark, sf_dir), places).select("id", "place_id", F.round("distance_m", 3).alias("distance_m"))


_ANSWER = """SELECT q.id, coalesce(t.county, c.county{own}) AS county, {town} AS town, {approx}r.name AS road, round(n.m, 3) AS road_m, p0.number AS address, round(h.m, 3) AS address_m,
      CASE WHEN h.m < 50 THEN p0.number ELSE concat(coalesce(t.county, c.county{own}, ''), coalesce({town}, ''), ' ', coalesce(r.name, ''), ' 附近') END AS shown
    FROM q LEFT JOIN town t ON t.id = q.id LEFT JOIN (SELECT id, min(name) AS county FROM hits WHERE level = 4 GROUP BY id) c ON c.id = q.id
    LEFT JOIN (SELECT * FROM nearest WHERE r = 1) n ON n.id = q.id LEFT JOIN roads r ON r.line_id = n.line_id
    LEFT JOIN (SELECT * FROM hit WHERE r = 1) h ON h.id = q.id LEFT JOIN p0 ON p0.id = h.place_id"""
_TIERS = f"""WITH p0 AS ({_ADDR_SQL}), {_POINTS_SQL}, {_SHAPES_SQL}, addr AS (SELECT * FROM q), {_COVERS}, {_TOWN}, {_NEAR_ROAD}, {_NEAR_POINT.replace("addr a", "p0 a")}"""
_SNAP_M = 1500.0


def _located(spark, sf_dir, snap_m):
    areas, edges, roads, road_edges = _shapes(spark)
    places = addresses(spark, sf_dir).select(F.col("id").alias("place_id"), "lat", "lon", F.col("number").alias("display_name"))
    out = S.reverse_geocode(_points(spark, sf_dir), areas, edges, roads, road_edges, places, snap_m)
    return out.withColumn("road_m", F.round("road_m", 3)).withColumn("address_m", F.round("address_m", 3))


@query(f"{_TIERS} {_ANSWER.format(own='', town='t.name', approx='')}")
def reverse_geocode(spark, sf_dir):
    return _located(spark, sf_dir, 0.0).select("id", "county", "town", "road", "road_m", "address", "address_m", "shown")


@query(
    f"""{_TIERS}, towns AS (SELECT * FROM edges WHERE area_id IN (SELECT area_id FROM areas WHERE level IN (7, 8))), {_AREA_BOXES.format(edges="towns")},
    {_SEG.replace("seg AS", "aseg AS").replace("FROM seg", "FROM aseg").replace("planar AS", "aplanar AS").replace("FROM planar", "FROM aplanar").replace("metres AS", "ametres AS").format(key="area_id", edges="towns")},
    {_SNAPPED.format(metres="ametres", d=f"({_SNAP_M} / 111000)", tolerance=_SNAP_M)}, z AS (SELECT s.id, a.name, a.county FROM snap s JOIN areas a ON a.area_id = s.area_id WHERE s.r = 1 AND s.id NOT IN (SELECT id FROM town))
    """
    + _ANSWER.format(own=", z.county", town="coalesce(t.name, z.name)", approx="z.name IS NOT NULL AS approx, ") + " LEFT JOIN z ON z.id = q.id"
)
def reverse_geocode_snapped(spark, sf_dir):
    return _located(spark, sf_dir, _SNAP_M).select("id", "county", "town", "approx", "road", "road_m", "address", "address_m", "shown")


# --- search -----------------------------------------------------------------------------------
_TOKENS_SQL = r"t AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(translate(lower(text), 'àáâãäåāăąçćčďèéêëēęěìíîïīłñńňòóôõöøōőŕřśšşťţùúûüūůűýÿžźż', 'aaaaaaaaacccdeeeeeeeiiiiilnnnoooooooorrssstt' || 'uuuuuuuyyzzz'), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents)"


def _index(spark, sf_dir):
    return X.postings(table(spark, sf_dir, "documents").withColumnRenamed("text", "name"), "doc_id", ("name",))


@query(f"WITH {_TOKENS_SQL} SELECT id, cast(len(w) as bigint) AS n FROM t WHERE len(w) > 0")
def fts_tokens(spark, sf_dir):
    return _index(spark, sf_dir).groupBy("id").agg(F.count("*").alias("n"))


@query(f"WITH {_TOKENS_SQL} SELECT id FROM t WHERE contains(concat(' ', array_to_string(w, ' '), ' '), ' of the ')")
def fts_phrase(spark, sf_dir):
    return X.phrase_ids(_index(spark, sf_dir), "of the")


@query(f"WITH {_TOKENS_SQL} SELECT id FROM t WHERE len(list_filter(w, lambda x: starts_with(x, 'thanon'))) > 0")
def fts_prefix(spark, sf_dir):
    return X.prefix_ids(_index(spark, sf_dir), "thanon")


@query(f"WITH {_TOKENS_SQL} SELECT id FROM t WHERE list_contains(w, 'ingor')")
def fts_token(spark, sf_dir):
    return X.token_ids(_index(spark, sf_dir), "ingor", ("name",))


@query(f"WITH {_TOKENS_SQL} SELECT d.doc_id, d.source FROM documents d JOIN t ON t.id = d.doc_id WHERE list_contains(w, 'the') ORDER BY d.doc_id LIMIT 50")
def fts_page(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
    return X.search(docs, X.phrase_ids(_index(spark, sf_dir), "the")).select(F.col("id").alias("doc_id"), "source")


@query(f"WITH {{ADDR}}, {_NAMED_SQL} SELECT id, display_name_halfwidth FROM named WHERE village = 'F' AND display_name_halfwidth LIKE '%S1%' ORDER BY id LIMIT 50")
def like_fallback(spark, sf_dir):
    rows = named(spark, sf_dir).withColumn("district_code", F.col("village"))
    return X.contains_fallback(rows, "S1", "F").select("id", "display_name_halfwidth")


@query("SELECT p_partkey AS id FROM part WHERE contains(p_name, 'e giz')")
def trigram_substring(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return X.substring_ids(parts, X.trigrams(parts, "p_name", "p_partkey"), "e giz", "p_name", "p_partkey")


# --- quality ----------------------------------------------------------------------------------
_EXTREMES = " UNION ALL ".join(
    f"SELECT * FROM (SELECT id, lat, lon, '{d}' AS direction FROM addr WHERE number NOT LIKE '%樓%' AND number NOT LIKE '%層%' ORDER BY {o} LIMIT 50) s{i}"
    for i, (d, o) in enumerate({"north": "lat DESC, id DESC", "south": "lat, id", "east": "lon DESC, id DESC", "west": "lon, id"}.items())
)


@query(f"WITH {{ADDR}} {_EXTREMES}")
def extreme_samples(spark, sf_dir):
    return Q.extreme_samples(addresses(spark, sf_dir)).select("id", "lat", "lon", "direction")


_RULES = [{"reason": "first", "match": {"street_prefix": ["S1", "A"], "village": ["F", "P"]}}, {"reason": "second", "match": {"street": "S2"}}]


@query("WITH {ADDR} SELECT id, CASE WHEN (starts_with(coalesce(street,''), 'S1') OR starts_with(coalesce(street,''), 'A')) AND village IN ('F', 'P') THEN 'first' WHEN street = 'S2' THEN 'second' END AS reason FROM addr")
def rule_exceptions(spark, sf_dir):
    return addresses(spark, sf_dir).select("id", Q.first_exception(_RULES).alias("reason"))


@query(
    f"""WITH {{ADDR}}, samples AS ({_EXTREMES}), results AS (SELECT s.direction, 'even' AS "check", CASE WHEN id % 2 = 0 THEN true WHEN id % 3 = 0 THEN NULL ELSE false END AS ok FROM samples s)
    SELECT "check", """
    + ", ".join(f"count(*) FILTER (WHERE direction = '{d}' AND ok) AS {d}_passed, count(*) FILTER (WHERE direction = '{d}' AND NOT ok) AS {d}_failed, count(*) FILTER (WHERE direction = '{d}' AND ok IS NULL) AS {d}_info" for d in Q.DIRECTIONS)
    + ' FROM results GROUP BY "check"'
)
def check_matrix(spark, sf_dir):
    s = Q.extreme_samples(addresses(spark, sf_dir))
    ok = F.when(F.col("id") % 2 == 0, True).when(F.col("id") % 3 == 0, None).otherwise(False)
    return Q.matrix(s.select("direction", F.lit("even").alias("check"), ok.alias("ok")))


_CHECKS_SQL = f"""extremes AS ({_EXTREMES}), s AS (SELECT e.direction, n.* FROM extremes e JOIN named n ON n.id = e.id),
  p AS (SELECT id, CASE WHEN id % 5 = 0 THEN lat + cast(0.00002 as double) ELSE lat END AS lat, lon, village, street, area, number FROM named WHERE id % 6 <> 0),
  m AS (SELECT s.id AS sample_id, s.direction, s.village, p.id AS found, {_HAV.format(a='s.lat', b='p.lat', c='s.lon', d='p.lon')} AS err FROM s LEFT JOIN p
    ON s.village = p.village AND coalesce(s.street, '') = coalesce(p.street, '') AND coalesce(s.area, '') = coalesce(p.area, '') AND s.number = p.number),
  best AS (SELECT *, row_number() OVER (PARTITION BY sample_id, direction ORDER BY coalesce(err, 1e12), found) AS r FROM m),
  one AS (SELECT sample_id, direction, found IS NOT NULL AS there, coalesce(err <= 1.0, false) AS near, village IN ('F', 'O') AS known FROM best WHERE r = 1)"""


@query(
    f"""WITH {{ADDR}}, {_NAMED_SQL}, {_CHECKS_SQL} SELECT sample_id, direction, 'coverage' AS "check", there AS ok FROM one UNION ALL SELECT sample_id, direction, 'coord_match', there AND near FROM one
    UNION ALL SELECT sample_id, direction, 'display_name', there AND known FROM one UNION ALL SELECT sample_id, direction, 'fts5_search', there AND known FROM one"""
)
def verify_checks(spark, sf_dir):
    none = F.lit(None).cast("string")
    rows = named(spark, sf_dir).withColumn("district_code", F.col("village")).withColumn("neighbor", none).withColumn("lane", none).withColumn("alley", none)
    stored = rows.where("id % 6 <> 0").withColumn("lat", F.when(F.col("id") % 5 == 0, F.col("lat") + 0.00002).otherwise(F.col("lat")))
    codes = spark.createDataFrame([("F", "台中市", "中區"), ("O", "台中市", "中區")], "code string, county string, district string")
    return Q.checks(Q.extreme_samples(rows), stored, codes).select("sample_id", "direction", "check", "ok")


@query(
    f"""WITH p0 AS ({_ADDR_SQL}), addr0 AS (SELECT * FROM p0), {_NAMED_SQL.replace("FROM addr", "FROM addr0")}, {_CHECKS_SQL.replace("FROM addr", "FROM addr0")}, {_SHAPES_SQL}, addr AS (SELECT DISTINCT id, lat, lon FROM s), {_COVERS}, {_TOWN},
    w AS (SELECT b.sample_id, b.direction, b.village, b.found IS NOT NULL AS there, CASE b.village WHEN 'F' THEN '東縣' ELSE '西縣' END AS want_county, CASE b.village WHEN 'F' THEN '甲鄉' ELSE '丙鎮' END AS want_town FROM best b WHERE r = 1 AND village IN ('F', 'O')),
    j AS (SELECT w.*, EXISTS (SELECT 1 FROM hits h WHERE h.id = w.sample_id AND h.level IN (7, 8) AND h.name = w.want_town) AS inside, t.name AS got_town, t.county AS got_county FROM w LEFT JOIN town t ON t.id = w.sample_id),
    r AS (SELECT sample_id, direction, village, there, 'polygon_in' AS "check", there AND inside AS good FROM j UNION ALL SELECT sample_id, direction, village, there, 'reverse_township', there AND coalesce(got_town = want_town, false) FROM j
      UNION ALL SELECT sample_id, direction, village, there, 'county_match', there AND coalesce(got_county = want_county, false) FROM j)
    SELECT sample_id, direction, "check", CASE WHEN NOT good AND there AND village = 'O' THEN NULL ELSE good END AS ok FROM r"""
)
def verify_area_checks(spark, sf_dir):
    none = F.lit(None).cast("string")
    rows = named(spark, sf_dir).withColumn("district_code", F.col("village")).withColumn("neighbor", none).withColumn("lane", none).withColumn("alley", none)
    stored = rows.where("id % 6 <> 0").withColumn("lat", F.when(F.col("id") % 5 == 0, F.col("lat") + 0.00002).otherwise(F.col("lat")))
    codes = spark.createDataFrame([("F", "東縣", "甲鄉"), ("O", "西縣", "丙鎮")], "code string, county string, district string")
    areas, edges, _, _ = _shapes(spark)
    samples = Q.extreme_samples(rows).where(F.col("village").isin("F", "O"))
    found = Q.checks(samples, stored, codes, areas, edges, [{"reason": "known", "match": {"village": "O"}}])
    return found.where(F.col("check").isin("polygon_in", "reverse_township", "county_match")).select("sample_id", "direction", "check", "ok")


@query("SELECT o_orderkey AS k, row_number() OVER () AS id FROM orders")
def source_row_ids(spark, sf_dir):
    return I.with_ids(I.with_source(table(spark, sf_dir, "orders")).select("o_orderkey", *I.SOURCE)).select(F.col("o_orderkey").alias("k"), "id")


@query(f"WITH {{ADDR}}, {_SHAPES_SQL}, {_COVERS}, {_TOWN} SELECT a.id, t.name AS found_township FROM addr a LEFT JOIN town t ON t.id = a.id WHERE t.name IS NULL OR t.name <> '甲鄉'")
def outlier_scan(spark, sf_dir):
    areas, edges, _, _ = _shapes(spark)
    return Q.outliers(addresses(spark, sf_dir).withColumn("township", F.lit("甲鄉")), areas, edges).select("id", "found_township")


@query(
    """WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k, event_type FROM events) SELECT event_id, coalesce(nullif(CASE WHEN event_id % 2 = 0 THEN k END, ''), nullif(event_type, '')) AS name
    FROM e WHERE event_type IN ('click', 'view', 'purchase')"""
)
def tag_filter_name_priority(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.from_json("props", "map<string,string>")["k"]
    tags = F.map_from_arrays(F.array(F.lit("name:zh"), F.lit("name")), F.array(F.when(F.col("event_id") % 2 == 0, k), F.col("event_type")))
    return e.where(F.col("event_type").isin("click", "view", "purchase")).select("event_id", T.tag_name(tags).alias("name"))


# --- map extracts -----------------------------------------------------------------------------
_MAP_SQL = """nodes AS (SELECT c_custkey AS id, cast(23.55 as double) + cast(c_custkey % 40 as double) / cast(100 as double) AS lat, cast(120.2 as double) + cast(c_custkey % 25 as double) / cast(100 as double) AS lon FROM customer WHERE c_custkey % 11 <> 0),
  ways AS (SELECT s_suppkey AS id, unnest([s_suppkey * 3, s_suppkey * 5 + 1, s_suppkey * 2, s_suppkey * 7]) AS ref, unnest([0, 1, 2, 3]) AS seq FROM supplier),
  points AS (SELECT w.id, w.seq, n.lat, n.lon FROM ways w JOIN nodes n ON n.id = w.ref)"""


def _map_objects(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer").where("c_custkey % 11 <> 0"), F.col("s_suppkey")
    part = lambda n: (F.col("c_custkey") % n).cast("double") / F.lit(100.0)
    tags = F.create_map(F.lit("addr:housenumber"), F.concat((F.col("c_custkey") % 9).cast("string"), F.lit("之２號")), F.lit("addr:city"), F.lit("臺北市"), F.lit("addr:street"), F.col("c_mktsegment"))
    nodes = c.select(F.lit("node").alias("kind"), F.col("c_custkey").alias("id"), tags.alias("tags"), (F.lit(23.55) + part(40)).alias("lat"), (F.lit(120.2) + part(25)).alias("lon"), F.lit(None).cast("array<long>").alias("refs"))
    none = F.lit(None).cast("double")
    ways = table(spark, sf_dir, "supplier").select(F.lit("way").alias("kind"), s.alias("id"), F.lit(None).cast("map<string,string>").alias("tags"), none.alias("lat"), none.alias("lon"), F.array(s * 3, s * 5 + 1, s * 2, s * 7).alias("refs"))
    return nodes.unionByName(ways)


@query(f"WITH {_MAP_SQL}, e AS (SELECT id AS line_id, seq, lon AS x1, lat AS y1, lead(lon) OVER (PARTITION BY id ORDER BY seq) AS x2, lead(lat) OVER (PARTITION BY id ORDER BY seq) AS y2 FROM points) SELECT * FROM e WHERE y2 IS NOT NULL")
def way_edges(spark, sf_dir):
    return O.way_edges(O.way_points(_map_objects(spark, sf_dir)))


@query(
    f"""WITH {_MAP_SQL}, inside AS (SELECT id FROM nodes WHERE lat BETWEEN 23.6 AND 23.7 AND lon BETWEEN 120.25 AND 120.3), kept AS (SELECT DISTINCT id FROM ways WHERE ref IN (SELECT id FROM inside))
    SELECT 'way' AS kind, id FROM kept UNION ALL SELECT 'node', id FROM nodes WHERE id IN (SELECT id FROM inside) OR id IN (SELECT ref FROM ways WHERE id IN (SELECT id FROM kept))"""
)
def map_clip(spark, sf_dir):
    return O.clip(_map_objects(spark, sf_dir), 120.25, 23.6, 120.3, 23.7).select("kind", "id")


@query(
    f"""WITH {_MAP_SQL}, {_SHAPES_SQL}, addr AS (SELECT * FROM nodes), {_COVERS}, free AS (SELECT n.*, c_mktsegment AS street, concat(cast(n.id % 9 as varchar), '之２號') AS number FROM nodes n JOIN customer ON c_custkey = n.id
      WHERE n.id NOT IN (SELECT c.id FROM covers c JOIN areas a ON a.area_id = c.area_id WHERE a.level = 4 AND a.name = '東縣'))
    SELECT id AS osm_id, '台北市' AS county, concat('台北市', street, number) AS display_name, concat('台北市', street, replace(replace(number, '２', '2'), '之', '-')) AS display_name_halfwidth,
      row_number() OVER (ORDER BY id) AS id FROM free"""
)
def map_addresses(spark, sf_dir):
    areas, edges, _, _ = _shapes(spark)
    return B.map_places(_map_objects(spark, sf_dir), areas, edges, ("東縣",)).select("osm_id", "county", "display_name", "display_name_halfwidth", "id")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
