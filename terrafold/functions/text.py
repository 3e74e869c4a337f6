"""Address text as Column expressions: widths, display names, floors and base numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width digits and signs with their half-width forms; letters stay as they are.
FULL_WIDTH = "０１２３４５６７８９－．"
HALF_WIDTH = "0123456789-."
# Number, floor and storey marks of an address, the sub-number mark, glyph variants.
NUMBER_MARK, FLOOR_MARK, LAYER_MARK, SUB_MARK = "號", "樓", "層", "之"
GLYPH_FROM, GLYPH_TO = "臺", "台"
# The six special municipalities, whose districts are of level 7.
SPECIAL_MUNICIPALITIES = ("台北市", "新北市", "桃園市", "台中市", "台南市", "高雄市")
# Name tags by priority.
NAME_TAGS = ("name:zh", "name:zh-Hant", "name")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank(x: str | Column) -> Column:
    """Null as the empty string."""
    return F.coalesce(_c(x), F.lit(""))


def none_if_blank(x: str | Column) -> Column:
    return F.nullif(_c(x), F.lit(""))


def strip_space(x: str | Column) -> Column:
    """Without white space at the ends, the ideographic space included (which ``trim`` keeps)."""
    return F.regexp_replace(_c(x), r"^[\s\p{Z}\x1C-\x1F\x85]+|[\s\p{Z}\x1C-\x1F\x85]+$", "")


def half_width(x: str | Column) -> Column:
    return F.translate(_c(x), FULL_WIDTH, HALF_WIDTH)


def hyphen_number(x: str | Column) -> Column:
    """Half-width, with sub-numbers after hyphens."""
    return F.replace(half_width(x), F.lit(SUB_MARK), F.lit("-"))


def usual_glyphs(x: str | Column) -> Column:
    return F.translate(_c(x), GLYPH_FROM, GLYPH_TO)


def is_floor(number: str | Column) -> Column:
    """Whether the first floor or storey mark stands behind the first number mark (false for null).
    A mark that is also before the number hides a later one: only first marks count."""
    n = blank(number)
    at = F.instr(n, NUMBER_MARK)
    return (at > 0) & (F.greatest(F.instr(n, FLOOR_MARK), F.instr(n, LAYER_MARK)) > at)


def base_number(number: str | Column) -> Column:
    """The number without its floor; others are unchanged, null included."""
    n = _c(number)
    return F.when(is_floor(n), F.substring(n, F.lit(1), F.instr(n, NUMBER_MARK))).otherwise(n)


def has_marks(number: str | Column) -> Column:
    """Whether a floor or storey mark stands anywhere."""
    n = blank(number)
    return F.contains(n, F.lit(FLOOR_MARK)) | F.contains(n, F.lit(LAYER_MARK))


def with_suffix(part: str | Column, suffix: str = "") -> Column:
    """A part and its suffix, or nothing if the part is blank."""
    return F.when(blank(part) != "", F.concat(_c(part), F.lit(suffix))).otherwise(F.lit(""))


def street_or_area(street: str | Column, area: str | Column) -> Column:
    """The street; where it is blank, the area."""
    return F.when(blank(street) != "", _c(street)).otherwise(blank(area))


def display_name(county, district, village, street, area, lane, alley, number, half: bool = False) -> Column:
    """The whole address in writing order. The half-width form changes digits from the street on and
    hyphenates the number only."""
    tail = [street_or_area(street, area), blank(lane), blank(alley)]
    tail = [half_width(x) for x in tail] + [hyphen_number(blank(number))] if half else [*tail, blank(number)]
    return F.concat(blank(county), blank(district), blank(village), *tail)


def short_name(street, area, lane, alley, number) -> Column:
    """Street or area, lane, alley and number in half width."""
    return F.concat(*[half_width(x) for x in (street_or_area(street, area), blank(lane), blank(alley))], hyphen_number(blank(number)))


def synthesised(county, township, village, street, area, lane, alley, number) -> Column:
    """struct<number, name, display_name, display_name_halfwidth> of a base address."""
    full = (county, township, village, street, area, lane, alley, number)
    return F.struct(
        _c(number).alias("number"),
        short_name(street, area, lane, alley, number).alias("name"),
        display_name(*full).alias("display_name"),
        display_name(*full, half=True).alias("display_name_halfwidth"),
    )


def tag_name(tags: str | Column) -> Column:
    """The first name tag that isn't blank, or null."""
    return F.coalesce(*[none_if_blank(F.try_element_at(_c(tags), F.lit(k))) for k in NAME_TAGS])


def admin_level(county: str | Column) -> Column:
    return F.when(_c(county).isin(*SPECIAL_MUNICIPALITIES), 7).otherwise(8)


def map_address(tags: str | Column) -> Column:
    """struct<city, district, street, number, display_name, display_name_halfwidth, name> of a map
    object's address tags. Sub-numbers are hyphenated in the whole half-width form."""
    tag = lambda k: blank(F.try_element_at(_c(tags), F.lit(k)))
    city = usual_glyphs(tag("addr:city"))
    sub = reduce(lambda a, b: F.when(a != "", a).otherwise(b), (tag("addr:district"), tag("addr:suburb")))
    street, number = tag("addr:street"), tag("addr:housenumber")
    whole = F.concat(city, sub, street, number)
    half = hyphen_number(whole)
    short = hyphen_number(F.concat(street, number))
    return F.struct(
        none_if_blank(city).alias("county"),
        none_if_blank(sub).alias("township"),
        none_if_blank(street).alias("street"),
        number.alias("number"),
        whole.alias("display_name"),
        half.alias("display_name_halfwidth"),
        F.when(short != "", short).otherwise(half).alias("name"),
    )


def quoted_phrase(text: str) -> str:
    """A full-text phrase for any text."""
    return '"' + text.replace('"', '""') + '"'


def plain_query(text: str) -> str:
    """User input without characters that full-text queries give a meaning."""
    return "".join(c for c in text if c not in "\"*()-:'\\")
