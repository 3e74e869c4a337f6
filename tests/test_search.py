from __future__ import annotations

import pytest

from terrafold.operators import search as X


@pytest.fixture(scope="module")
def index(spark):
    rows = [
        (7, "丁街16巷6-7-8號", "甲縣乙鎮丙里丁街１６巷６之７之８號", "甲縣乙鎮丙里丁街16巷6-7-8號", "丁街", None, "乙鎮"),
        (8, "庚段9號", "甲縣戊鄉己村庚段９號", "甲縣戊鄉己村庚段9號", None, "庚段", "戊鄉"),
        (9, "Église Ångström", None, None, None, None, None),
        (10, "\ue123橋路3號", None, None, "\ue123橋路", None, None),
    ]
    df = spark.createDataFrame(rows, "id long, name string, display_name string, display_name_halfwidth string, street string, area string, township string")
    return X.postings(df), df


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize(("phrase", "found"), [("丁街", [7]), ("庚段", [8]), ("丙里", []), ("丁 街", []), ("甲縣乙鎮丙里丁街16巷6-7-8號", [7]), ("eglise angstrom", [9]), ("angstrom eglise", []), ("\ue123橋路", [10]), ("", [])])
def test_phrases(index, phrase, found):
    assert ids(X.phrase_ids(index[0], phrase)) == found


def test_prefix_and_tokens(index):
    assert ids(X.prefix_ids(index[0], "庚段")) == [8] and ids(X.token_ids(index[0], "乙鎮")) == [7] and ids(X.token_ids(index[0], "\ue123橋路")) == [10]
    assert X.query_tokens(index[0].sparkSession, "甲縣丁街16巷6-7-8號_İx") == ["甲縣丁街16巷6", "7", "8號", "i", "x"]


def test_many_phrases_at_once(index):
    wanted = index[0].sparkSession.createDataFrame([(1, "甲縣乙鎮丙里丁街16巷6-7-8號"), (2, "丁街16巷6-8"), (3, "Eglise"), (4, ""), (5, "7-8號"), (6, "8號-7")], "k long, t string")
    assert sorted(r["k"] for r in X.phrases_found(index[0], wanted, "k", "t").collect()) == [1, 3, 5]


def test_substring(index):
    _, df = index
    assert ids(X.substring_ids(df, X.trigrams(df), "乙鎮丙里")) == [7]
    assert ids(X.contains_fallback(df, "己村庚")) == [8]
    with pytest.raises(ValueError):
        X.substring_ids(df, X.trigrams(df), "丙里")
