from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from terrafold.functions import text as T


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row.asDict()


@pytest.mark.parametrize(
    ("number", "base"),
    [
        ("６號八樓", "６號"), ("７０號十樓之９", "７０號"), ("４號地下三層", "４號"), ("８之１號五樓", "８之１號"), ("臨２０之７號六樓", "臨２０之７號"),
        ("９１之３號", "９１之３號"), ("新光大樓５之２號", "新光大樓５之２號"), ("地下三層", "地下三層"), ("新光大樓８號四樓", "新光大樓８號四樓"), ("", ""), (None, None),
    ],
)
def test_base_number(spark, number, base):
    assert one(spark, b=T.base_number(F.lit(number).cast("string")))["b"] == base


@pytest.mark.parametrize(("full", "half", "hyphen"), [("６之７之８號", "6之7之8號", "6-7-8號"), ("臨９０之５號", "臨90之5號", "臨90-5號"), ("４１弄", "41弄", "41弄"), ("Ｂ７－．", "Ｂ7-.", "Ｂ7-."), ("", "", "")])
def test_widths(spark, full, half, hyphen):
    assert one(spark, a=T.half_width(F.lit(full)), b=T.hyphen_number(F.lit(full))) == {"a": half, "b": hyphen}


def test_display_names(spark):
    parts = [F.lit(x) for x in ("甲縣", "乙鎮", "丙里", "丁街", None, "１６巷", None, "６之７之８號")]
    got = one(spark, full=T.display_name(*parts), half=T.display_name(*parts, half=True), short=T.short_name(*parts[3:]))
    assert got == {"full": "甲縣乙鎮丙里丁街１６巷６之７之８號", "half": "甲縣乙鎮丙里丁街16巷6-7-8號", "short": "丁街16巷6-7-8號"}
    parts = [F.lit(x) for x in ("甲縣", "戊鄉", "己村", "", "庚段", None, None, "９號")]
    assert one(spark, half=T.display_name(*parts, half=True))["half"] == "甲縣戊鄉己村庚段9號"


def test_strip_takes_ideographic_space(spark):
    assert one(spark, a=T.strip_space(F.lit("　 a b　\t")))["a"] == "a b"


def test_synthesised(spark):
    parts = [F.lit(x) for x in ("甲縣", "乙鎮", "丙里", "丁街", None, None, "４弄", "７之１號")]
    got = one(spark, s=T.synthesised(*parts))["s"].asDict()
    assert got == {"number": "７之１號", "name": "丁街4弄7-1號", "display_name": "甲縣乙鎮丙里丁街４弄７之１號", "display_name_halfwidth": "甲縣乙鎮丙里丁街4弄7-1號"}


def test_tags(spark):
    tags = lambda **k: F.create_map(*[F.lit(x) for p in k.items() for x in (p[0].replace("_", ":"), p[1])])
    assert one(spark, n=T.tag_name(tags(name_zh="", name="b")))["n"] == "b"
    a = one(spark, a=T.map_address(tags(addr_city="臺東市", addr_suburb="北里", addr_street="海街", addr_housenumber="８之６號")))["a"].asDict()
    assert a["display_name"] == "台東市北里海街８之６號" and a["display_name_halfwidth"] == "台東市北里海街8-6號" and a["name"] == "海街8-6號"


def test_queries_are_plain():
    assert T.quoted_phrase('a"b') == '"a""b"' and T.plain_query("a*(b)-'c':\\") == "abc"
