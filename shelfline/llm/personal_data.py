"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts.

All of it is SQL functions. A pattern gives its matches and the text between them; running sums of
their lengths are the spans. The patterns use possessive repeats, so that the engine neither backs up
nor recurses however long a run of digits or letters is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

BASE_KINDS = ["email", "ip", "card", "phone"]
# The patterns of the contract. `\G` and the look-behind only skip starts inside a run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Added kinds: an IBAN has its country's length and has to pass mod 97; an identity number has no checksum
# and needs context.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_LISTED = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
# Other countries: as far as it goes, but not into a number of a listed one.
_OTHER = (rf"(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20(?:{_LISTED})[0-9]{{2}})[\x20]?[A-Z0-9]){{11,30}}+")
IBAN = (r"(?<![A-Za-z0-9])(?:" + "|".join(
    rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[\x20]?[A-Z0-9]){{{length - 4}}}+"
    for length, countries in IBAN_LENGTHS.items()) + "|" + _OTHER + r")(?![A-Za-z0-9])")
IDENTITY = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"


@dataclass(frozen=True)
class Kind:
    """Base score, words that raise it, words that lower it, and the characters of context looked at."""

    name: str
    score: float
    raising: str = ""
    lowering: str = r"\b(?:example|sample|test|dummy|placeholder|version|order|isbn)\b"


KINDS = [
    Kind("email", 0.9, r"\b(?:mail|email|e-mail|contact|write|reach)\b"),
    Kind("ip", 0.6, r"\b(?:ip|host|server|address|login)\b"),
    Kind("card", 0.8, r"\b(?:card|visa|mastercard|credit|payment|cvv)\b"),
    Kind("phone", 0.7, r"\b(?:phone|tel|call|mobile|fax)\b"),
    Kind("iban", 0.9, r"\b(?:iban|bank|account|transfer)\b"),
    Kind("identity", 0.4, r"\b(?:ssn|social|security|identity|taxpayer)\b"),
]
CONTEXT = 40
CONFIRMED = 0.6   # an added span needs this score; base spans stay whatever it is
SPAN = "struct<start:int,stop:int,kind:string,rank:int,score:double>"


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, found>> in code points, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, gap: F.struct(
        F.length(gap).alias("gap"), F.length(m).alias("long"), m.alias("found")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,found:string>>").alias("out"))

    def step(acc, m):
        start = acc["at"] + m["gap"]
        return F.struct((start + m["long"]).alias("at"), F.array_append(acc["out"], F.struct(
            start.alias("start"), (start + m["long"]).alias("stop"), m["found"].alias("found"))).alias("out"))

    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Every second digit from the right is doubled, less 9 over 9; the sum has to end in 0."""
    each = F.split(F.reverse(number), "")
    total = F.aggregate(
        F.transform(each, lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, F.lit(9)).otherwise(F.lit(0)))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """The first four characters go last, letters count from 10; the number leaves 1 modulo 97."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda a, c: (
        a * F.when(c.rlike("^[0-9]$"), F.lit(10)).otherwise(F.lit(100)) + value(c)) % 97)
    return F.length(plain).between(15, 34) & (rest == 1)


def proposals(text: Column) -> dict[str, Column]:
    """Confirmed matches by kind. A text that cannot match is not searched."""
    some = lambda can, found: F.when(can, found).otherwise(
        F.array().cast("array<struct<start:int,stop:int,found:string>>"))
    part = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(
        F.right(p, F.lit(4)).cast("int"), F.lit(0)) <= 255)
    number = lambda low, high: lambda m: F.length(digits(m["found"])).between(low, high)
    digit = text.rlike("[0-9]")
    return {
        "email": some(text.contains("@"), matches(text, EMAIL)),
        "ip": F.filter(some(digit & text.rlike(r"[0-9]\.[0-9]"), matches(text, IP)),
                       lambda m: F.forall(F.split(m["found"], r"\."), part)),
        "card": F.filter(some(digit, matches(text, CARD)),
                         lambda m: number(12, 19)(m) & luhn(digits(m["found"]))),
        "phone": F.filter(some(text.rlike(r"\+[0-9]"), matches(text, PHONE)), number(9, 15)),
        "iban": F.filter(some(text.rlike("[A-Z]{2}[0-9]{2}"), matches(text, IBAN)), lambda m: mod97(m["found"])),
        "identity": some(text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), matches(text, IDENTITY)),
    }


def scored(text: Column, kind: Kind, rank: int, found: Column) -> Column:
    def one(m):
        near = F.lower(F.concat(
            F.substring(text, F.greatest(m["start"] - CONTEXT, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT))),
            F.lit(" "), F.substring(text, m["stop"] + 1, F.lit(CONTEXT))))
        score = (F.lit(kind.score) + F.when(near.rlike(kind.raising), 0.3).otherwise(0.0)
                 - F.when(near.rlike(kind.lowering), 0.2).otherwise(0.0))
        return F.struct(m["start"].alias("start"), m["stop"].alias("stop"), F.lit(kind.name).alias("kind"),
                        F.lit(rank).alias("rank"), F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 2).alias("score"))

    spans = F.transform(found, one)
    return spans if kind.name in BASE_KINDS else F.filter(spans, lambda s: s["score"] >= CONFIRMED)


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind in the listed order, joined by commas."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def personal_data(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with `spans`: array of (start, stop, kind, rank, score) in code points, end exclusive.

    A null or empty text has none. Rows are looked at one by one, so repeated rows and ids give a row
    each. Spans of different kinds may overlap. A column of `docs` named spans is replaced.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = docs.withColumn("spans", F.lit(None))
    for name, column in proposals(text).items():
        found = found.withColumn(f"_pii_{name}", column)
    every = [scored(text, kind, rank, F.col(f"_pii_{kind.name}")) for rank, kind in enumerate(KINDS)]
    return found.withColumn("spans", F.flatten(F.array(*every)).cast(f"array<{SPAN}>")).drop(
        *[f"_pii_{k.name}" for k in KINDS])


def redacted(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Replaces the spans that `personal_data` has found by their kind in brackets; of overlapping ones
    the first to start counts."""
    text = F.col(text_column)
    ordered = F.array_sort(F.transform(F.col("spans"), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        skip = s["start"] < acc["at"]
        return F.struct(F.when(skip, acc["at"]).otherwise(s["stop"]).alias("at"), F.when(skip, acc["out"]).otherwise(
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"],
                     F.lit("]"))).alias("out"))

    cut = F.aggregate(ordered, zero, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return docs.withColumn(text_column, F.when(F.size("spans") > 0, cut).otherwise(text))
