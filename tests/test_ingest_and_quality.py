from __future__ import annotations

import zipfile

import pytest

from terrafold.operators import ingest as I
from terrafold.operators import metadata as M
from terrafold.operators import quality as Q
from terrafold.plans import build
from terrafold.sources import delimited as D
from terrafold.sources import download
from terrafold.streaming import ingest as stream

HEADER = ["鄉鎮市區代碼", "村里", "鄰", "街、路段", "地區", "巷", "弄", "號", "橫座標", "縱座標"]
COLUMNS = dict(zip(["district_code", "village", "neighbor", "street", "area", "lane", "alley", "number", "x", "y"], HEADER, strict=True))
LINES = [
    ["10007210", "新生村", "8", "富農路一段", "", "", "", "１９０之１號", "217897.28", "2653132.75"],
    ["10007210", "新生村　", "8", "富農路一段", "", "", "", "１９０號", "204322.09", "2642533.80"],
    ["10007210", "新生村", "8", "富農路一段", "", "", "", "１９０號二樓", "204322.09", "2642533.80"],
    ["99999999", "x", "", "", "", "", "", "１號", "204322.09", "2642533.80"],
    ["10007210", "x", "", "", "", "", "", "　", "204322.09", "2642533.80"],
    ["10007210", "x", "", "", "", "", "", "２號", "abc", "2642533.80"],
    ["10007210", "x", "", "", "", "", "", "２號", "nan", "2642533.80"],
]
BAD = {"tgos": {"changhua": {"114-05": [{"match": {"district_code": "10007210", "village": "新生村", "neighbor": "8", "street": "富農路一段", "number": "１９０之１號"}}]}}}
CODES = {"10007210": {"county": "彰化縣", "district": "田尾鄉"}}


@pytest.fixture()
def source(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(",".join(r) for r in [HEADER, *LINES]) + "\n", encoding="utf-8")
    return str(path)


def test_county_build(spark, source):
    made = build.county(spark, {"path": source, "columns": COLUMNS, "crs": "EPSG:3826"}, D.district_codes(spark, CODES), D.known_bad(spark, BAD, "tgos", "changhua", "114-05"))
    assert {r["reject_reason"]: r["rows"] for r in made["rejects"].collect()} == {"dirty": 1, "unknown_code": 1, "empty_number": 1}
    rows = made["places"].collect()
    assert [(r["id"], r["display_name"], r["village"], r["street"], r["lane"]) for r in rows] == [(1, "彰化縣田尾鄉新生村富農路一段１９０號", "新生村", "富農路一段", None)]
    assert abs(rows[0]["lat"] - 23.887) < 0.01
    assert made["floor_removals"].count() == 1


def test_bad_rows_need_empty_fields(spark):
    bad = D.known_bad(spark, BAD, "tgos", "changhua", "114-05")
    raw = spark.createDataFrame([("10007210", "新生村", "8", "富農路一段", lane, "１９０之１號", "1", "2") for lane in ("", "３巷")], "district_code string, village string, neighbor string, street string, lane string, number string, lat string, lon string")
    got = I.judged(I.stripped(I.located(raw, False)), D.district_codes(spark, CODES), bad).collect()
    assert {r["lane"]: r["reject_reason"] for r in got} == {"": "dirty", "３巷": None}


def test_ids_follow_the_source(spark):
    df = spark.range(0, 100, 1, 5).withColumnRenamed("id", "n").where("n % 3 > 0 or n >= 0")
    got = I.with_ids(df).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 101)) and [r["n"] for r in got] == list(range(100))


def test_ids_follow_files_and_places(spark, tmp_path):
    for name, n in (("a", 5), ("b", 2000), ("c", 50)):
        (tmp_path / f"{name}.csv").write_text("v,w\n" + "".join(f"{name}{i},1\n" for i in range(n)), encoding="utf-8")
    df = D.read_mapped(spark, str(tmp_path), {"v": "v"})
    got = [r["v"] for r in I.with_ids(df.where("v <> 'b7'")).orderBy("id").collect()]
    assert got == [f"{name}{i}" for name, n in (("a", 5), ("b", 2000), ("c", 50)) for i in range(n) if (name, i) != ("b", 7)]
    split = I.with_ids(D.read_mapped(spark, str(tmp_path), {"v": "v"}, multi_line=False))
    assert split.count() == 2055 and set(split.columns) == {"v", "id"}


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n1,"x\ny"\n2,"say ""z"""\n', encoding="utf-8")
    got = D.read_mapped(spark, str(tmp_path / "q.csv"), {"n": "a", "t": "b"})
    assert [(r["n"], r["t"]) for r in I.with_ids(got).orderBy("id").collect()] == [("1", "x\ny"), ("2", 'say "z"')]


def test_configured_lists_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(I, "LISTED", 2)
    with pytest.raises(ValueError):
        I.judged(spark.range(1), spark.createDataFrame([(str(i), "c", "d") for i in range(3)], "code string, county string, district string"))


def test_numbers_by_key(spark):
    df = spark.createDataFrame([((i * 7919) % 1000 if i else None, i) for i in range(1000)], "k long, v long").repartition(7)
    got = I.numbered(df, "k", "v").orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 1001))
    assert [(r["k"] is not None, r["k"], r["v"]) for r in got] == sorted((r["k"] is not None, r["k"], r["v"]) for r in got)
    assert I.numbered(df.where("false"), "k").count() == 0


def test_stream_is_the_batch(spark, tmp_path, source):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.csv").write_text(open(source, encoding="utf-8").read(), encoding="utf-8")
    raw = stream.read_stream(spark, str(inbox), COLUMNS, HEADER)
    out = stream.places_stream(raw, D.district_codes(spark, CODES), D.known_bad(spark, BAD, "tgos", "changhua", "114-05"), grid=True)
    job = stream.write_stream(out, str(tmp_path / "out"), str(tmp_path / "check"))
    job.awaitTermination(60)
    assert {r["number"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"１９０號", "１９０號二樓"}


def test_missing_columns_are_told(spark, source):
    with pytest.raises(ValueError):
        D.read_mapped(spark, source, {"a": "沒有"})


def test_checks_and_matrix(spark):
    codes = D.district_codes(spark, CODES)
    schema = "id long, lat double, lon double, district_code string, village string, neighbor string, street string, area string, lane string, alley string, number string"
    rows = [(1, 24.0, 120.0, "10007210", "里", "1", "路", "", "", "", "１號"), (2, 24.1, 120.1, "10007210", "里", "1", "環港路", "", "", "", "２號"), (3, 24.2, 120.2, "10007210", "里", "1", "路", "", "", "", "９號"), (4, 24.2, 120.2, "10007210", "里", "1", "路", "", "", "", "９號二樓")]
    source = spark.createDataFrame(rows, schema)
    samples = Q.extreme_samples(source, 2)
    assert samples.count() == 8 and samples.where("id = 4").count() == 0
    raw = source.where("id < 3").withColumn("lat", source.lat.cast("string")).withColumn("lon", source.lon.cast("string"))
    places = I.with_ids(I.places(I.judged(I.stripped(I.located(raw, False)), codes)))
    areas = spark.createDataFrame([(1, 8, "田尾鄉", "彰化縣")], "area_id long, level int, name string, county string")
    edges = spark.createDataFrame([(1, 119.9, 23.9, 120.05, 23.9), (1, 120.05, 23.9, 120.05, 24.05), (1, 120.05, 24.05, 119.9, 24.05), (1, 119.9, 24.05, 119.9, 23.9)], "area_id long, x1 double, y1 double, x2 double, y2 double")
    rules = [{"reason": "harbour", "match": {"street_prefix": ["環港路"]}}]
    got = {(r["sample_id"], r["check"]): r["ok"] for r in Q.checks(samples, places, codes, areas, edges, rules).collect()}
    for check in ("coverage", "coord_match", "display_name", "fts5_search", "polygon_in", "reverse_township", "county_match"):
        assert got[1, check] is True and got[3, check] is False
    assert got[2, "coverage"] is True and got[2, "polygon_in"] is None and got[2, "county_match"] is None
    assert Q.matrix(Q.checks(samples, places, codes)).count() == 4


def test_versions_and_kits(spark, tmp_path):
    M.check_version("2026.07.23.1", "2")
    for bad in (("v1.2.3", "2"), ("2026.07.23.1", "0")):
        with pytest.raises(ValueError):
            M.check_version(*bad)
    assert len(M.expected("2026.07.23.1", "2", "tgos")) == 2 and len(M.expected("2026.07.23.1", "2", "osm")) == 1
    wanted = M.as_frame(spark, M.expected("2026.07.23.1", "2", "tgos"), "places")
    old = M.as_frame(spark, {"schema_version": "3"}, "places")
    same, differ = M.stamp(old, wanted)
    assert same.count() == 1 and differ.count() == 2
    done, _ = M.stamp(old, wanted, apply=True)
    assert done.count() == 3 and M.stamp(done, wanted)[1].count() == 0
    M.require_current(done, wanted)
    with pytest.raises(ValueError):
        M.require_current(old, wanted)
    assert M.value_of(done, "schema_version") == "3" and M.value_of(done, "none", "1") == "1"
    file = tmp_path / "places.parquet"
    file.write_bytes(b"x")
    kit = M.write_kit([file], {"DATA_DATE.txt": "2026\r\n"}, tmp_path / "kit.zip")
    assert M.check_kit(kit, {"DATA_DATE.txt": "2026\n"}) == [] and len(M.check_kit(kit, {"DATA_DATE.txt": "1", "B": ""})) == 2
    text = M.manifest(kit, [file], {"places.parquet": {"data_version": "2026.07.23.1"}}, {})
    assert M.check_manifest(text, kit, "2026.07.23.1") == [] and M.check_manifest(text, kit, "2027.01.01.1")
    assert M.file_hashes(spark, str(tmp_path), "*.parquet").first()["sha256"] == M.sha256_file(file)
    assert zipfile.ZipFile(kit).namelist() == ["places.parquet", "DATA_DATE.txt"]
    assert M.schema_version_ok("roads.parquet", None) and not M.schema_version_ok("places-x", "2")


def test_refresh(tmp_path):
    import io

    class Answer(io.BytesIO):
        headers = {"Last-Modified": "today"}

    opener = lambda request, timeout: Answer(b"data")
    target = tmp_path / "x.pbf"
    assert download.refresh("http://x", target, opener=opener) and target.read_bytes() == b"data"
    assert not download.refresh("http://x", target, opener=opener)
    assert download.refresh("http://x", target, force=True, opener=opener) and (tmp_path / "x.pbf.bak").exists()
