"""Personal data in texts: proposals by pattern, checksums, context; native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.shared import in_steps, let, running

# Kinds in the order in which spans at one place are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "local")
BASE = KINDS[:4]

#: A pattern never has to step back into a run of its own characters: repeats are possessive, and a
#: match starts where a run does (or where the last match ended, \G). So a long run is read once,
#: and the matches are those of the plain pattern from the left.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of digits with single separators; a run is whole or nothing, so only 12 to 19 digits count.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # A telephone number without its country: only what stands near tells it from other numbers.
    "local": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
}
#: What a text must have for the pattern to be worth a search.
_NEEDS = {"email": "@", "phone": "+"}

# Words near a span that make its kind likelier.
CONTEXT = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "fax", "mobile"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "local": ("phone", "call", "tel", "fax", "mobile"),
}
#: Score of a span before its context, what a context word adds, and what a span needs if its kind isn't a base one.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "local": 0.45}
CONTEXT_BONUS, CONTEXT_REACH, LEAST_SCORE = 0.1, 40, 0.5


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number (upper case, no spaces) leaves 1 after division by 97."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        c = F.substring(moved, i, F.lit(1))
        value = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _confirmed(kind: str, span: Column) -> Column:
    s = span["value"]
    if kind == "local":  # not part of a longer number, nor of one with its country
        return ~F.rlike(span["before"], F.lit(r"[0-9][ ().-]*$")) & ~F.rlike(span["after"], F.lit(r"^[ .-]?[0-9]"))
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda part: part.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(_digits(s))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    if kind == "iban":
        bare = F.regexp_replace(s, " ", "")
        return F.length(bare).between(15, 34) & mod97(bare)
    return F.lit(True)


_SPANS = "cast(array() as array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double>>)"


def _placed(text: Column, kind: str) -> Column:
    """array<struct<start, rank, kind, end, score>> of a kind's confirmed matches.

    The text between matches and the matches alternate, so their lengths add up to the places.
    """
    matches, between = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), F.split(text, PATTERNS[kind], -1)

    def spans(cut: Column) -> Column:
        ends = running(F.zip_with(cut["m"], F.slice(cut["b"], F.lit(1), F.size(cut["m"])), lambda m, b: (F.length(m) + F.length(b)).cast("bigint")), lambda x, y: x + y)
        each = F.transform(
            F.arrays_zip(cut["m"].alias("value"), ends.alias("end"), cut["b"].alias("before"), F.slice(cut["b"], F.lit(2), F.size(cut["m"])).alias("after")),
            lambda x: F.struct(x["value"].alias("value"), (x["end"] - F.length(x["value"])).alias("start"), x["end"].alias("end"), F.right(x["before"], F.lit(CONTEXT_REACH)).alias("before"), F.left(x["after"], F.lit(CONTEXT_REACH)).alias("after")),
        )
        right = F.filter(each, lambda x: x["value"].isNotNull() & _confirmed(kind, x))
        shaped = lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end"), _score(kind, x).alias("score"))
        return F.transform(right, shaped)

    need = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else F.rlike(text, F.lit(PATTERNS[kind]))
    return F.when(need, let(F.struct(matches.alias("m"), between.alias("b")), spans)).otherwise(F.expr(_SPANS))


def _score(kind: str, span: Column) -> Column:
    """A context word counts on either side, up to the next match of the kind."""
    words = F.lit(r"(?:^|[^\p{L}])(?:" + "|".join(CONTEXT[kind]) + ")")
    near = F.rlike(F.lower(span["before"]), words) | F.rlike(F.lower(span["after"]), words)
    return F.lit(SCORES[kind]) + F.when(near, CONTEXT_BONUS).otherwise(0.0)


def find(docs: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = KINDS, least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` and a column pii: array<struct<start, rank, kind, end, score>> by start, then kind.

    Places are code points, the end exclusive. Base kinds (email, ip, card, phone) are all kept;
    others need ``least_score``, which the local numbers only reach by a context word. Null and empty texts have no spans. Rows and the other columns
    stay as they are; a column named pii is replaced.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = F.concat(*[_placed(text, k) for k in kinds])
    return docs.withColumn("pii", F.array_sort(F.filter(found, lambda s: (s["rank"] < len(BASE)) | (s["score"] >= least_score))))


def redact(docs: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, as ``[EMAIL]``.

    Spans that overlap are one, named after the first. A null text stays null. Columns named
    n_chars follow the new text.
    """
    spans = find(docs.select("*"), text_col, kinds)
    text = F.col(text_col)

    def redacted(pii: Column) -> Column:
        ends = running(F.transform(pii, lambda s: s["end"]), F.greatest)
        return let(ends, lambda upto: F.concat(F.array_join(let(cuts(pii, upto), lambda c: in_steps(c, joined)), ""), F.substring(text, (F.element_at(upto, -1) + 1).cast("int"), F.length(text))))

    def cuts(pii: Column, upto: Column) -> Column:
        """What comes before each span that begins after all spans before it, and its kind."""
        each = F.transform(pii, lambda s, i: F.struct(F.coalesce(F.get(upto, i - 1), F.lit(0).cast("bigint")).alias("from"), s["start"].alias("to"), s["kind"].alias("kind")))
        return F.filter(each, lambda c: c["to"] >= c["from"])

    def joined(part: Column) -> Column:
        """Places in a text are counted from its start, so a step's part of the text is cut out first."""
        first = F.get(part, F.lit(0))["from"]
        own = F.substring(text, (first + 1).cast("int"), (F.element_at(part, -1)["to"] - first).cast("int"))
        one = lambda own, c: F.concat(F.substring(own, (c["from"] - first + 1).cast("int"), (c["to"] - c["from"]).cast("int")), F.lit("["), F.upper(c["kind"]), F.lit("]"))
        return let(own, lambda o: F.array_join(F.transform(part, lambda c: one(o, c)), ""))

    clean = F.when(F.size("pii") > 0, let(F.col("pii"), redacted)).otherwise(text)
    out = spans.withColumn(text_col, clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("pii") > 0, F.length(text_col).cast("long")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
