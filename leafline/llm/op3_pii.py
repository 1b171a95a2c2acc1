"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Built-in functions only; one pass over the rows and no shuffle. Null texts count as empty and have no
spans; repeated rows and nulls in other columns change nothing. The patterns are written so that a
match is found in time linear in the text and without recursion, whatever the text holds: quantifiers
are possessive, and a look-behind or the end of the last match stands where a run may begin.

Base kinds are email, ip, card (Luhn) and phone; the method adds iban (mod 97), ssn, and secret (a long string of
letters and digits that passes a test of its variety); the last two count only with a context word nearby. Each span has a score from 0 to 1: what its kind is worth by itself,
more for a checksum, more or less for context words within 40 code points before it or 20 behind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import read

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
CONTEXT_BEFORE, CONTEXT_AFTER = 40, 20


@dataclass(frozen=True)
class Kind:
    """hint: without this in a text the pattern isn't tried. score: before the context is looked at."""

    name: str
    pattern: str
    hint: str
    context: str
    score: float
    base: bool = True
    needs_context: bool = False


#: Length of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """By country, so that a match ends with the number whatever follows: compact, in groups of four, or with single spaces elsewhere."""
    one = lambda n: rf"(?:[A-Z0-9]{{{n}}}|(?:\x20[A-Z0-9]{{4}}){{{n // 4}}}{rf'\x20[A-Z0-9]{{{n % 4}}}' * (n % 4 > 0)}|(?:\x20?[A-Z0-9]){{{n}}}+)(?![A-Za-z0-9])"
    numbers = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}{one(n - 4)}" for n, names in IBAN_LENGTHS.items())
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{numbers})"


KINDS = (
    Kind("email", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++", "@", "mail|contact|write|address", 0.8),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", "ip|host|server|login|client", 0.6),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])", "", "card|visa|credit|debit|payment", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", "phone|tel|call|mobile|fax", 0.6),
    Kind("iban", _iban(), "", "iban|bank|account|konto", 0.8, base=False),
    Kind("secret", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+", "", "token|secret|passw|pwd|credential|bearer|api.?key|access.?key|private.?key|auth", 0.6, base=False, needs_context=True),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", "ssn|social", 0.4, base=False, needs_context=True),
)
BASE = tuple(k for k in KINDS if k.base)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the digit string passes Luhn's test."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, F.try_to_number(d, F.lit("9")).cast("int")).otherwise(F.try_to_number(d, F.lit("9")).cast("int") * 2)),
        F.lit(0),
        lambda sum_, d: sum_ + F.when(d > 9, d - 9).otherwise(d),
    )
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """True where the account number, country and check digits moved behind, leaves 1 modulo 97."""
    plain = F.regexp_replace(account, r"\x20", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    step = lambda rest, c: F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def varied(match: Column) -> Column:
    """True where letters, digits and eight different signs are in the string: words and rulers are not secrets."""
    return F.regexp_like(match, F.lit("[0-9]")) & F.regexp_like(match, F.lit("[A-Za-z]")) & (F.size(F.array_distinct(F.split(match, ""))) >= 8)


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        small = lambda part: (F.length(F.ltrim(part, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(part, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod97(match)
    if kind == "secret":
        return varied(match)
    return F.lit(True)


def _starts(lengths: Column) -> Column:
    """Sums of all before each element, exclusive. Blocks of 256 are summed apart, so that a text with very
    many matches costs no copy of all sums for each."""
    block = 256
    count = F.ceil(F.size(lengths) / F.lit(block)).cast("int")
    grow = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    zero = F.array(F.lit(0).cast("bigint"))
    blocks = F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda b: F.aggregate(F.slice(lengths, (b - 1) * block + 1, block), zero, grow))).otherwise(F.array(zero))
    bases = F.aggregate(blocks, zero, lambda sums, b: grow(sums, F.element_at(b, -1)))
    return F.flatten(F.zip_with(blocks, F.slice(bases, 1, F.size(blocks)), lambda b, base: F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: x + base)))


def _with_matches(df: DataFrame, kind: Kind, text: str = "text") -> DataFrame:
    """Adds _match (what the pattern matches) and _between (the text around: one more)."""
    none = F.array().cast("array<string>")
    hinted = F.contains(text, F.lit(kind.hint)) if kind.hint else F.lit(True)
    # An attribute of its own for each array: both are read more than once below.
    return df.withColumns({"_match": F.when(hinted, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(none)}).withColumns({"_between": F.when(F.size("_match") > 0, F.split(text, kind.pattern, -1)).otherwise(none)})


def _context(kind: Kind, before: Column, after: Column) -> Column:
    near = F.concat_ws(" ", F.right(F.coalesce(before, F.lit("")), F.lit(CONTEXT_BEFORE)), F.left(F.coalesce(after, F.lit("")), F.lit(CONTEXT_AFTER)))
    return F.regexp_like(F.lower(near), F.lit(rf"\b(?:{kind.context})"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and found: an array of (start, rank, kind, end, score), in order of start and then of kind.

    start and end count code points, end is exclusive, rank is the kind's place in KINDS.
    """
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    for rank, kind in enumerate(KINDS):
        df = _with_matches(df, kind)
        df = df.withColumn("_at", F.when(F.size("_match") > 0, _starts(F.transform(F.arrays_zip("_match", "_between"), lambda z: (F.length(z["_match"]) + F.length(z["_between"])).cast("bigint")))).otherwise(F.array().cast("array<bigint>")))
        df = df.withColumn("_after", F.slice("_between", 2, F.greatest(F.size("_between"), F.lit(1))))
        spans = F.transform(F.slice(F.arrays_zip("_match", "_between", "_after", "_at"), 1, F.size("_match")), lambda z: _span(kind, rank, z))
        df = df.withColumn(f"_{kind.name}", F.when(F.size("_match") > 0, F.filter(spans, lambda s: s["ok"]))).drop("_match", "_between", "_at", "_after")
    every = [F.coalesce(F.col(f"_{k.name}"), F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double,ok:boolean>>")) for k in KINDS]
    return df.select("doc_id", F.array_sort(F.flatten(F.array(*every))).alias("found"))


def _span(kind: Kind, rank: int, z: Column) -> Column:
    near = _context(kind, z["_between"], z["_after"])
    start = z["_at"] + F.length(z["_between"])
    ok = confirmed(kind.name, z["_match"])
    return F.struct(
        start.cast("bigint").alias("start"),
        F.lit(rank).alias("rank"),
        F.lit(kind.name).alias("kind"),
        (start + F.length(z["_match"])).cast("bigint").alias("end"),
        F.when(near, F.lit(min(1.0, kind.score + 0.2))).otherwise(F.lit(round(kind.score - 0.1, 2))).alias("score"),
        (ok & near if kind.needs_context else ok).alias("ok"),
    )


def report(found: DataFrame) -> DataFrame:
    """The counts, digest and list of spans of each row of found."""
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda name: F.size(F.filter("found", lambda s: s["kind"] == name)).cast("long")
    return found.select(
        "doc_id",
        *[count(k.name).alias(f"n_{k.name}") for k in KINDS],
        F.sha2(line(F.filter("found", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        line(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


#: Order in which redact() replaces kinds: a phone number may hold what looks like a card, never the reverse.
REDACTED = ("email", "phone", "ip", "card", "iban", "secret", "ssn")


def _replaced(kind: Kind):
    """The text before a match and what stands in the match's place; only the text for the last."""

    def one(z: Column) -> Column:
        ok = confirmed(kind.name, z["_match"])
        if kind.needs_context:
            ok = ok & _context(kind, z["_between"], z["_after"])
        return F.concat(z["_between"], F.when(z["_match"].isNull(), "").when(ok, f"[{kind.name.upper()}]").otherwise(z["_match"]))

    return one


def _fenced(text: Column) -> Column:
    """text, marked as not to be put into what reads it: each kind reads the text of the last one several times,
    and a filter pushed below would repeat the whole chain at each of these."""
    return F.when(F.monotonically_increasing_id() >= 0, text)


def redact(docs: DataFrame) -> DataFrame:
    """docs with every confirmed span replaced by the name of its kind, and n_chars counted anew.

    Kinds are replaced one after another, each found in what the ones before have left.
    """
    kinds = {k.name: k for k in KINDS}
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    # In one struct, so that no column of docs clashes with those of this function.
    changed = docs.select(F.struct(F.lit(0).alias("text"), *[F.col(f"`{c}`") for c in others]).alias("row"), F.col("text").alias("_text"))
    for name in REDACTED:
        kind = kinds[name]
        changed = _with_matches(changed, kind, "_text").withColumn("_after", F.slice("_between", 2, F.greatest(F.size("_between"), F.lit(1))))

        text = F.array_join(F.transform(F.arrays_zip("_between", "_match", "_after"), _replaced(kind)), "")
        changed = changed.withColumn("_text", _fenced(F.when(F.size("_match") > 0, text).otherwise(F.col("_text")))).drop("_match", "_between", "_after")
    out = [F.col("_text").alias(c) if c == "text" else F.length("_text").cast(t).alias(c) if c == "n_chars" else F.col(f"row.`{c}`") for c, t in docs.dtypes]
    return changed.select(*out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(find(read(spark, sf_dir, "documents")))
