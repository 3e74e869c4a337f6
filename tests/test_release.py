from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_reduction import places

from terrafold.__main__ import main
from terrafold.operators import metadata as M
from terrafold.operators import search as X
from terrafold.operators import spatial as S
from terrafold.plans import build, release
from terrafold.sources import delimited as D


def test_publish_swaps(spark, tmp_path):
    target = str(tmp_path / "t")
    for n in (2, 3):
        release.publish(spark.range(n), target)
        assert spark.read.parquet(target).count() == n
    assert spark.read.parquet(f"{target}.bak").count() == 2


def test_index_and_migration(spark, tmp_path):
    df = places(spark).withColumn("street", F.lit(None).cast("string")).withColumn("area", F.lit("庚段"))
    target = str(tmp_path / "index")
    release.write_index(df, target, ("name",))
    meta = M.as_frame(spark, {"schema_version": "2"}, "places")
    done, meta = release.migrate_index(df, spark.read.parquet(target), meta, target)
    assert done and M.value_of(meta, "schema_version") == "3" and X.phrase_ids(spark.read.parquet(target), "庚段").count() == 9
    assert release.migrate_index(df, spark.read.parquet(target), meta, target)[0] is False


def test_comparison_and_gate(spark):
    df = places(spark).withColumn("display_name", F.concat("number", F.lit("x")))
    figures, text = release.compare(df, df.where("id <> 11").withColumn("lat", F.when(F.col("id") == 30, 24.5).otherwise(F.col("lat"))))
    row = figures.first()
    assert row["moved"] == 1 and row["accepted"] is False and row["names_added"] == 0 and "| moved | 1 |" in text


def test_preflight(spark):
    meta = M.as_frame(spark, {"schema_version": "3", "data_version": "2026.01.01.1", "source": "tgos"}, "places")
    wrong = release.preflight(spark, meta, ["places"], "2026.01.01.1", "2")
    assert wrong == ["missing: roads", "missing: townships", "places: address_policy_version is None, not 2"]
    assert release.preflight(spark, meta, [], "x", "2")[0].startswith("bad data_version")


def test_routes(spark):
    df = spark.createDataFrame([("tgos", "台中市"), ("osm", None)], "source string, county string")
    assert build.route(df, "台中市", ("台中市",)).first()["source"] == "tgos" and build.route(df, "南投縣", ("台中市",)).first()["source"] == "osm"
    assert build.counties({"a": df, "b": df.withColumn("more", F.lit(1))}).count() == 4


def test_configured_tables(spark):
    assert D.exceptions_of({"1": [{"reason": "r"}]}, "1") and D.exceptions_of({}, None) == []
    with pytest.raises(KeyError):
        D.region({"a": {}}, "b")


def test_commands(spark, tmp_path, capsys):
    source, out = str(tmp_path / "p"), str(tmp_path / "q")
    places(spark).write.parquet(source)
    assert main(["dedup", "--places", source, "--out", out], spark) == 0 and not (tmp_path / "q").exists()
    assert main(["dedup", "--places", source, "--out", out, "--apply"], spark) == 0 and spark.read.parquet(out).count() == 6
    assert main(["collapse", "--places", out, "--out", out + "2", "--apply"], spark) == 0
    assert main(["index", "--places", out, "--out", out + "i"], spark) == 0
    assert main(["search", "--places", out, "--index", out + "i", "丁街"], spark) == 0
    assert main(["nearest", "--places", out, "23.5", "121.0"], spark) == 0
    assert main(["inspect", "--places", source], spark) == 0
    assert main(["compare", "--old", source, "--new", out], spark) == 0
    assert main(["compare", "--old", source, "--new", out, "--index", out + "i"], spark) == 0
    release.write_index(spark.read.parquet(out).limit(2), out + "j")
    assert main(["compare", "--old", source, "--new", out, "--index", out + "j"], spark) == 1
    assert "５８號" not in capsys.readouterr().err


def layers(spark, top):
    """A township at the coast of its county, both with the same edge in the west, and a road."""
    ring = [(121.0, 23.0), (121.2, 23.0), (121.2, 23.2), (121.0, 23.2), (121.0, 23.0)]
    edges = [(i, *a, *b) for i in (1, 2) for a, b in zip(ring, ring[1:], strict=False)]
    tables = {
        "areas": ([(1, 4, "甲縣", None), (2, 8, "乙鎮", "甲縣")], "area_id long, level int, name string, county string"),
        "area_edges": (edges, "area_id long, x1 double, y1 double, x2 double, y2 double"),
        "roads": ([(5, "丁街", "primary")], "line_id long, name string, highway string"),
        "road_edges": ([(5, 120.99, 23.1, 121.1, 23.1)], "line_id long, x1 double, y1 double, x2 double, y2 double"),
        "places": ([(1, "tgos", "甲縣", 23.1001, 121.05, "丁街１號")], "id long, source string, county string, lat double, lon double, display_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{top}/{name}")
    return top


def test_reverse_command(spark, tmp_path, capsys):
    top = layers(spark, str(tmp_path))
    read = {n: spark.read.parquet(f"{top}/{n}") for n in ("areas", "area_edges", "roads", "road_edges", "places")}
    places_ = read["places"].withColumnRenamed("id", "place_id")
    points = spark.createDataFrame([(1, 23.1, 121.05), (2, 23.1, 120.9995), (3, 23.1, 120.9)], "id long, lat double, lon double")
    got = {r["id"]: r for r in S.reverse_geocode(points, read["areas"], read["area_edges"], read["roads"], read["road_edges"], places_, snap_m=100.0).collect()}
    assert got[1]["town"] == "乙鎮" and not got[1]["approx"] and got[1]["shown"] == "丁街１號"
    assert got[2]["town"] == "乙鎮" and got[2]["county"] == "甲縣" and got[2]["approx"]
    assert got[3]["town"] is None and got[3]["road"] is None
    assert {r["id"]: r["town"] for r in S.reverse_geocode(points, read["areas"], read["area_edges"], read["roads"], read["road_edges"], places_).collect()} == {1: "乙鎮", 2: None, 3: None}
    assert main(["reverse", "--layers", top, "--places", f"{top}/places", "--snap-m", "100", "23.1", "120.9995"], spark) == 0
    assert "甲縣乙鎮 丁街 附近" in capsys.readouterr().out
    assert main(["reverse", "--layers", top, "--no-tier3", "23.1", "121.05"], spark) == 0
    assert "丁街１號" not in capsys.readouterr().out


def test_point_in_a_county_only(spark, tmp_path):
    top = layers(spark, str(tmp_path))
    read = {n: spark.read.parquet(f"{top}/{n}") for n in ("areas", "area_edges", "roads", "road_edges")}
    points = spark.createDataFrame([(1, 23.1, 121.05)], "id long, lat double, lon double")
    got = S.reverse_geocode(points, read["areas"].where("level = 4"), read["area_edges"].where("area_id = 1"), read["roads"], read["road_edges"], None, with_addresses=False).first()
    assert got["county"] == "甲縣" and got["town"] is None


def test_stored_places_lie_by_cell(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "'tgos' as source", "'x' as county", "22 + (id * 37 % 997) / 500.0D as lat", "120 + (id * 91 % 1009) / 500.0D as lon")
    build.write_places(df, str(tmp_path / "p"))
    near = build.around(spark.read.parquet(str(tmp_path / "p")), 22.5, 120.5, 0.2)
    assert near.count() == df.where(F.col("lat").between(22.5 - 0.2, 22.5 + 0.2) & F.col("lon").between(120.5 - 0.2, 120.5 + 0.2)).count() > 0
    assert "PushedFilters: [IsNotNull(lat)" in near._jdf.queryExecution().executedPlan().toString()


def test_pack_and_versions(spark, tmp_path, capsys):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t"))
    kit = tmp_path / "kit.zip"
    assert main(["pack", "--data-version", "2026.01.01.1", "--policy-version", "2", "--out", str(kit), str(tmp_path / "t")], spark) == 0
    assert M.check_manifest((tmp_path / "kit.zip.manifest").read_text(encoding="utf-8"), kit, "2026.01.01.1") == []
    assert main(["check-version", "2026.01.01.1", "2"], spark) == 0 and main(["check-version", "1", "2"], spark) == 1
    (tmp_path / "app.txt").write_text("EXPECTED = 3\n", encoding="utf-8")
    anchors = ["--text", str(tmp_path / "app.txt"), "--pattern", r"EXPECTED = (\d+)"]
    assert main(["check-version", "2026.01.01.1", "2", *anchors, "--expected", "3"], spark) == 0
    assert main(["check-version", "2026.01.01.1", "2", *anchors, "--expected", "4"], spark) == 1


def test_county_command(spark, tmp_path):
    import yaml

    header = ["c", "v", "n", "s", "a", "l", "al", "no", "lon", "lat"]
    names = ["district_code", "village", "neighbor", "street", "area", "lane", "alley", "number", "lon", "lat"]
    (tmp_path / "in.csv").write_text("\n".join([",".join(header), "1,里,1,路,,,,１號,120.1,24.1", "1,里,1,路,,,,１號二樓,120.1,24.1", "1,里,1,路,,,,２號,120.2,24.2"]) + "\n", encoding="utf-8")
    for name, value in {"s": {"x": {"path": str(tmp_path / "in.csv"), "columns": dict(zip(names, header, strict=True)), "data_date": "115-01"}}, "c": {"1": {"county": "某縣", "district": "某鎮"}}}.items():
        (tmp_path / f"{name}.yaml").write_text(yaml.safe_dump(value, allow_unicode=True), encoding="utf-8")
    config = ["x", "--sources", str(tmp_path / "s.yaml"), "--codes", str(tmp_path / "c.yaml")]
    assert main(["county", *config, "--out", str(tmp_path / "out"), "--apply"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert main(["verify", *config, "--places", str(tmp_path / "out")], spark) == 0
    assert main(["index", "--places", str(tmp_path / "out"), "--out", str(tmp_path / "i")], spark) == 0
    assert main(["verify", *config, "--places", str(tmp_path / "out"), "--index", str(tmp_path / "i")], spark) == 0
    spark.read.parquet(str(tmp_path / "i")).where("false").write.parquet(str(tmp_path / "stale"))
    assert main(["verify", *config, "--places", str(tmp_path / "out"), "--index", str(tmp_path / "stale")], spark) == 1
    top = layers(spark, str(tmp_path / "layers"))
    assert main(["verify", *config, "--places", str(tmp_path / "out"), "--layers", top], spark) == 1  # no area covers the places
    assert main(["all", "--sources", str(tmp_path / "s.yaml"), "--codes", str(tmp_path / "c.yaml"), "--out", str(tmp_path / "whole"), "--apply"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "whole" / "places")).count() == 2 and spark.read.parquet(str(tmp_path / "whole" / "index")).count() > 0
