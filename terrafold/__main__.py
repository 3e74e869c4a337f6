"""python -m terrafold COMMAND: county builds, reductions, checks and searches from a shell.

Sources, codes, bad rows and versions come from YAML files; tables are Parquet. Commands that change
a table are dry runs unless --apply is given.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.operators import metadata as M
from terrafold.operators import profile as P
from terrafold.operators import reduction as R
from terrafold.operators import search as X
from terrafold.operators import spatial as S
from terrafold.plans import build, release
from terrafold.sources import delimited as D
from terrafold.sources.osm import read_extract
from terrafold.sources.shapefile import read_shapes


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="terrafold", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, help_: str, *options: tuple) -> None:
        p = sub.add_parser(name, help=help_)
        for flags, kw in options:
            p.add_argument(*flags, **kw)

    o = lambda *flags, **kw: (flags, kw)
    places, out, apply = o("--places", required=True), o("--out", required=True), o("--apply", action="store_true")
    config = (o("--sources", required=True), o("--codes", required=True), o("--bad"))
    command("county", "ingest a county and reduce it", o("id"), *config, out, apply)
    command("dedup", "floors to base addresses", places, out, apply)
    command("collapse", "exact duplicates", places, out, apply)
    layers = o("--layers", help="folder of areas, area_edges, roads and road_edges")
    command("base", "the area, road and landmark layers", o("--sources", required=True), out, apply)
    command("all", "the layers, if the sources have them, all counties and the search index", *config, out, apply)
    command("verify", "check a table against its source", o("id"), *config, places, layers, o("--index"), o("--exceptions"), o("--release"), o("-n", type=int, default=50))
    command("compare", "an old and a new table", o("--old", required=True), o("--new", required=True), o("--index"))
    command("pack", "a kit with its manifest", o("--data-version", required=True), o("--policy-version", required=True), out, o("tables", nargs="+"))
    command("check-version", "versions, and what text files say of one", o("data_version"), o("policy_version"), o("--text"), o("--pattern"), o("--expected"))
    command("reverse", "area, road and address of a point", o("--layers", required=True), o("--places"), o("--snap-m", type=float, default=0.0), o("--no-tier3", action="store_true"), o("lat", type=float), o("lon", type=float))
    command("inspect", "shared coordinates", places, o("--top", type=int, default=10))
    command("index", "build the search index", places, out)
    command("search", "find places", places, o("--index", required=True), o("text"), o("--prefix", action="store_true"))
    command("nearest", "nearest address of a point", places, o("lat", type=float), o("lon", type=float))
    return top


def _county(spark: SparkSession, a: argparse.Namespace) -> tuple[dict, DataFrame, DataFrame | None]:
    source = D.region(D.load_yaml(a.sources), a.id)
    codes = D.district_codes(spark, D.load_yaml(a.codes))
    bad = D.known_bad(spark, D.load_yaml(a.bad), "tgos", a.id, str(source.get("data_date"))) if a.bad else None
    return source, codes, bad


def _reduce(a: argparse.Namespace, removed: DataFrame, summary: DataFrame, result: DataFrame) -> None:
    summary.show(truncate=False)
    D.write_audit(removed, f"{a.out}.removed", "removed_id")
    if a.apply:
        release.publish(result, a.out)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("terrafold").getOrCreate()
    read = spark.read.parquet
    if a.command == "county":
        made = build.county(spark, *_county(spark, a))
        made["rejects"].show(truncate=False)
        made["floor_summary"].show(truncate=False)
        D.write_audit(made["floor_removals"], f"{a.out}.floors", "removed_id")
        D.write_audit(made["floor_syntheses"], f"{a.out}.synthesised", "kept_id")
        D.write_audit(made["duplicate_removals"], f"{a.out}.duplicates", "removed_id")
        if a.apply:
            release.publish(made["places"], a.out)
    elif a.command == "dedup":
        df = read(a.places)
        flags = R.floor_flags(df)
        _reduce(a, R.floor_removals(df, flags), R.floor_summary(df, flags), R.consolidate_floors(df, flags))
    elif a.command == "collapse":
        df = read(a.places)
        _reduce(a, R.duplicate_removals(df), R.duplicate_summary(df), R.collapse_duplicates(df))
    elif a.command == "verify":
        source, codes, bad = _county(spark, a)
        made = build.county(spark, source, codes, bad)
        layers = [read(f"{a.layers}/{n}") for n in ("areas", "area_edges")] if a.layers else [None, None]
        rules = D.exceptions_of(D.load_yaml(a.exceptions), a.release) if a.exceptions else None
        matrix, failed = release.verify(made["ingested"], read(a.places), codes, a.n, *layers, rules, read(a.index) if a.index else None)
        matrix.show(truncate=False)
        failed.show(20, truncate=False)
        return int(not failed.isEmpty())
    elif a.command == "compare":
        figures, text = release.compare(read(a.old), read(a.new), read(a.index) if a.index else None)
        print(text)
        return int(not figures.first()["accepted"])
    elif a.command == "inspect":
        df = read(a.places)
        P.group_totals(df).show(truncate=False)
        P.group_histogram(df).show(truncate=False)
        P.group_samples(df, a.top).show(3 * a.top, truncate=False)
    elif a.command == "index":
        release.write_index(read(a.places), a.out)
    elif a.command == "search":
        find = X.prefix_ids if a.prefix else X.phrase_ids
        X.search(read(a.places), find(read(a.index), X.user_query(a.text))).select("id", "display_name").show(50, truncate=False)
    elif a.command == "nearest":
        point = spark.createDataFrame([(1, a.lat, a.lon)], "id long, lat double, lon double")
        df = build.around(read(a.places), a.lat, a.lon)
        near = S.nearest_point(point, df.select(F.col("id").alias("place_id"), "lat", "lon"))
        near.join(df.select(F.col("id").alias("place_id"), "display_name"), "place_id").show(truncate=False)
    elif a.command == "base":
        _base(spark, D.load_yaml(a.sources)["base"], a.out, a.apply)
    elif a.command == "all":
        _all(spark, a)
    elif a.command == "pack":
        print(release.pack([Path(t) for t in a.tables], Path(a.out), a.data_version, a.policy_version))
    elif a.command == "check-version":
        return _versions(spark, a)
    elif a.command == "reverse":
        point = spark.createDataFrame([(1, a.lat, a.lon)], "id long, lat double, lon double")
        layers = [read(f"{a.layers}/{n}") for n in ("areas", "area_edges", "roads", "road_edges")]
        third = a.places and not a.no_tier3
        df = build.around(read(a.places), a.lat, a.lon).select(F.col("id").alias("place_id"), "lat", "lon", "display_name") if third else None
        S.reverse_geocode(point, *layers, df, a.snap_m, bool(third)).drop("id").show(truncate=False, vertical=True)
    return 0


def _base(spark: SparkSession, config: dict, out: str, apply: bool) -> None:
    """The layers of ``config``: counties, towns (and detached) shapes, an extract, and its box and
    covered counties."""
    shapes = {k: read_shapes(spark, config[k]) for k in ("counties", "towns", "detached") if k in config}
    areas, edges = build.townships(shapes["counties"], shapes["towns"], shapes.get("detached"), config.get("box"))
    objects = read_extract(spark, config["extract"])
    roads, road_edges = build.roads(objects)
    made = {"areas": areas, "area_edges": edges, "roads": roads, "road_edges": road_edges, "map_places": build.map_places(objects, areas, edges, tuple(config.get("covered", ())))}
    for name, df in made.items():
        if apply:
            release.publish(df, f"{out}/{name}")
        else:
            print(name, df.count())


def _all(spark: SparkSession, a: argparse.Namespace) -> None:
    sources = D.load_yaml(a.sources)
    if "base" in sources:
        _base(spark, sources["base"], a.out, a.apply)
    made = {}
    for name in sorted(set(sources) - {"base"}):
        a.id = name
        parts = build.county(spark, *_county(spark, a))
        parts["rejects"].show(truncate=False)
        parts["floor_summary"].show(truncate=False)
        made[name] = parts["places"]
    if a.apply and made:
        release.publish(build.clustered(build.counties(made)), f"{a.out}/places")
        release.write_index(spark.read.parquet(f"{a.out}/places"), f"{a.out}/index")


def _versions(spark: SparkSession, a: argparse.Namespace) -> int:
    try:
        M.check_version(a.data_version, a.policy_version)
    except ValueError as e:
        print(e)
        return 1
    wrong = release.stale_anchors(spark, a.text, a.pattern, a.expected) if a.text else []
    print("\n".join(wrong) or "good")
    return int(bool(wrong))


if __name__ == "__main__":
    sys.exit(main())
