from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from terrafold.functions import geo as G
from terrafold.functions import sql
from terrafold.functions import text as T
from terrafold.streaming import ingest as stream


def test_functions_by_name(spark):
    sql.register(spark)
    df = spark.createDataFrame([("３２之５號二樓",), ("合作大樓１號",), ("臺",), (None,)], "n string")
    df.createOrReplaceTempView("numbers")
    got = spark.sql("SELECT half_width(n) a, hyphen_number(n) b, usual_glyphs(n) c, is_floor(n) d, base_number(n) e FROM numbers").collect()
    want = df.select(T.half_width("n"), T.hyphen_number("n"), T.usual_glyphs("n"), T.is_floor("n"), T.base_number("n")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    row = spark.sql("SELECT haversine_m(24D, 120D, 24.1D, 120.1D) a, grid_cell(-0.01D, 0.05D) b").first()
    assert abs(row["a"] - spark.range(1).select(G.haversine_m(*map(F.lit, (24.0, 120.0, 24.1, 120.1)))).first()[0]) < 1e-6 and row["b"] == -1


def test_rejects_by_window(spark, tmp_path):
    rows = [(datetime(2026, 1, 1, 0, m), r) for m, r in ((1, "dirty"), (2, "dirty"), (3, None), (15, "empty_number"))]
    spark.createDataFrame(rows, "arrived timestamp, reject_reason string").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("arrived timestamp, reject_reason string").parquet(str(tmp_path / "in"))
    job = stream.windowed_rejects(rows).writeStream.format("memory").queryName("rejects").outputMode("complete").trigger(availableNow=True).start()
    job.awaitTermination(60)
    assert sorted((r["reject_reason"], r["rows"]) for r in spark.table("rejects").collect()) == [("dirty", 2), ("empty_number", 1)]
