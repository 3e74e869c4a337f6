"""Full-text search over address columns: positional postings, phrases, prefixes, fallbacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import text as T

# The columns of the index.
INDEXED = ("name", "display_name", "display_name_halfwidth", "street", "area", "township")
# Accented Latin letters and what they are folded to.
_ACCENTED = "àáâãäåāăąçćčďèéêëēęěìíîïīłñńňòóôõöøōőŕřśšşťţùúûüūůűýÿžźż"
_PLAIN = "aaaaaaaaacccdeeeeeeeiiiiilnnnoooooooorrsssttuuuuuuuyyzzz"


def tokens(x: str | Column) -> Column:
    """Runs of letters and digits, in lower case without accents. A run of CJK characters and the
    digits in it is one token; full-width forms stay as they are."""
    c = F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))
    folded = F.translate(F.lower(c), _ACCENTED, _PLAIN)
    return F.filter(F.split(folded, r"[^\p{L}\p{N}\p{Co}]+"), lambda t: t != "")


def query_tokens(spark: SparkSession, text: str) -> list[str]:
    """The tokens of a query: the index's own expression on one row."""
    return list(spark.range(1).select(tokens(F.lit(text)).alias("t")).first()["t"])


def postings(places: DataFrame, id_col: str = "id", columns: tuple[str, ...] = INDEXED) -> DataFrame:
    """(token, id, col, pos): the inverted index. Columns that the table lacks have no postings."""
    parts = [places.select(F.col(id_col).alias("id"), F.lit(c).alias("col"), F.posexplode(tokens(c)).alias("pos", "token")) for c in columns if c in places.columns]
    return reduce(DataFrame.unionByName, parts).select("token", "id", "col", "pos")


def phrase_ids(index: DataFrame, text: str) -> DataFrame:
    """Distinct ids with the query's tokens one after another in one column. A query without tokens
    finds nothing. One filtered scan and one aggregation, whatever the length."""
    wanted = query_tokens(index.sparkSession, text)
    if not wanted:
        return index.where("false").select("id").distinct()
    if len(wanted) == 1:
        return index.where(F.col("token") == wanted[0]).select("id").distinct()
    places = [F.struct(F.lit(t).alias("token"), F.lit(i).alias("i")) for i, t in enumerate(wanted)]
    hits = index.where(F.col("token").isin(*set(wanted)))
    starts = hits.select("id", "col", "pos", F.explode(F.filter(F.array(*places), lambda p: p["token"] == F.col("token"))).alias("p"))
    runs = starts.groupBy("id", "col", (F.col("pos") - F.col("p.i")).alias("start")).agg(F.count("*").alias("n"))
    return runs.where(F.col("n") == len(wanted)).select("id").distinct()


def phrases_found(index: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """The keys of ``wanted`` whose text the index has as a phrase: many queries in one join by token.
    A text without tokens is not found."""
    own = wanted.select(F.col(key).alias("key"), tokens(text).alias("w")).select("key", F.size("w").alias("n"), F.posexplode("w").alias("i", "token"))
    met = own.join(index, "token").groupBy("key", "n", "id", "col", (F.col("pos") - F.col("i")).alias("start")).agg(F.count_distinct("i").alias("found"))
    return met.where("found = n").select(F.col("key").alias(key)).distinct()


def prefix_ids(index: DataFrame, prefix: str) -> DataFrame:
    """Distinct ids with a token that begins so."""
    wanted = query_tokens(index.sparkSession, prefix)
    return index.where(F.col("token").startswith(wanted[0]) if len(wanted) == 1 else F.lit(False)).select("id").distinct()


def token_ids(index: DataFrame, token: str, columns: tuple[str, ...] = ("street", "area", "township")) -> DataFrame:
    """Distinct ids with exactly this token in one of the short columns."""
    return index.where(F.col("col").isin(*columns) & (F.col("token") == "".join(query_tokens(index.sparkSession, token)))).select("id").distinct()


def search(places: DataFrame, ids: DataFrame, limit: int | None = 50) -> DataFrame:
    """The places found, by id; ``limit`` is a page of results."""
    found = places.join(ids, "id", "left_semi").orderBy("id")
    return found.limit(limit) if limit else found


def contains_fallback(places: DataFrame, fragment: str, district_code: str | None = None, limit: int | None = 50) -> DataFrame:
    """Places whose half-width display name has a fragment, within a district if one is given."""
    found = F.contains(F.col("display_name_halfwidth"), F.lit(fragment))
    if district_code is not None:
        found = (F.col("district_code") == district_code) & found
    page = places.where(found).orderBy("id")
    return page.limit(limit) if limit else page


def trigrams(places: DataFrame, column: str = "display_name", id_col: str = "id") -> DataFrame:
    """(gram, id): every three characters of a column, for substring search without tokens."""
    c = F.col(column)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(0))), lambda i: F.substring(c, i, F.lit(3)))
    return places.where(F.length(c) >= 3).select(F.explode(F.array_distinct(grams)).alias("gram"), F.col(id_col).alias("id"))


def substring_ids(places: DataFrame, grams: DataFrame, fragment: str, column: str = "display_name", id_col: str = "id") -> DataFrame:
    """Ids whose column has a fragment of three or more characters: those with all its trigrams, checked."""
    wanted = sorted({fragment[i : i + 3] for i in range(len(fragment) - 2)})
    if not wanted:
        raise ValueError("a fragment needs three characters")
    near = grams.where(F.col("gram").isin(*wanted)).groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(wanted))
    checked = places.join(near.select(F.col("id").alias(id_col)), id_col, "left_semi")
    return checked.where(F.contains(F.col(column), F.lit(fragment))).select(F.col(id_col).alias("id")).distinct()


def user_query(text: str) -> str:
    return T.plain_query(text)
