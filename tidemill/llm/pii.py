"""Personal data: expressions propose spans, checksums confirm them, context adjusts a score.

All of it is column expressions. Patterns are written so that Java's matcher neither goes back nor
recurses on long runs: quantifiers are possessive where what follows cannot begin inside the run,
and a match may only begin at the start of a run or where the last match ended, which leaves the
leftmost matches the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import let

#: Code points before a span in which a context word counts, what it adds, and the least score of
#: a span of the added kinds.
CONTEXT_CHARS = 40
CONTEXT_ADDS = 0.3
LEAST_SCORE = 0.6


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str | None  # a text without this has no match
    score: float
    context: str
    base: bool = True


def _runs(chars: str) -> str:
    """Where a match over a run of ``chars`` may begin."""
    return rf"(?:\G|(?<![{chars}]))"


#: Length of an IBAN by country (registry of ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """In groups of four or without blanks; a known country ends it where its numbers end."""
    known = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        known.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}" + r"(?:\x20?[A-Z0-9]{4})"
                     + f"{{{groups}}}" + (rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""))
    listed = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    other = (rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}"
             r"(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?")
    return (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join([*known, other])
            + r")(?![A-Za-z0-9])")


KINDS = (
    Kind("email", _runs("A-Za-z0-9._%+-")
         + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 0.9, "mail|contact|write to"),
    Kind("ip", _runs("0-9") + r"[0-9]++(?:\.[0-9]++){3}", ".", 0.6, "ip|host|server|address"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", None, 0.8, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "tel|phone|call|mobile|fax"),
    # added by checksum (IBAN) and by context (social security number)
    Kind("iban", _iban(), None, 0.9, "iban|account|bank", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.4,
         "ssn|social security", base=False),
)

_BLOCK = 256


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _starts(pieces: Column, found: Column) -> Column:
    """Code point at which each match begins; ``pieces`` is the text between the matches.

    Sums run over blocks, so a text with very many matches is not summed anew for each.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int"))

    def steps(p: Column) -> Column:
        return F.transform(found, lambda _, i: F.length(F.get(p, i))
                           + F.coalesce(F.length(F.get(found, i - 1)), F.lit(0)))

    def totals(s: Column) -> Column:
        return F.transform(blocks, lambda b: _sum(F.slice(s, b * _BLOCK + 1, F.lit(_BLOCK))))

    def start(s: Column, t: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        return _sum(F.slice(t, F.lit(1), block)) + _sum(
            F.slice(s, block * _BLOCK + 1, i - block * _BLOCK + 1))

    return let(pieces, lambda p: let(steps(p), lambda s: let(
        totals(s), lambda t: F.transform(found, lambda _, i: start(s, t, i)))))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn's check of a digit string."""

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, at, F.lit(1)).cast("int")
        twice = digit * 2
        folded = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when((F.length(digits) - at) % 2 == 1, folded).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """ISO 7064 check of an IBAN without blanks."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        digits = _digits(match)
        return let(digits, lambda d: F.when(F.length(d).between(13, 19), luhn(d))
                    .otherwise(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        account = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(False)
    if kind == "ssn":
        return ~match.rlike(r"^(?:000|666|9..)|-00-|-0000$")
    return F.lit(True)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row: array of ``kind, start, stop, score``.

    Places are code points, the end exclusive; kinds come as listed, then by start. Spans of one
    kind never overlap. Base kinds keep every confirmed match whatever its score; added kinds need
    ``LEAST_SCORE``. Null and empty texts have no spans. Repeated rows are judged each.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    found = rows.select("*", *[
        F.when(text.contains(k.needs) if k.needs else F.lit(True),
               F.regexp_extract_all(text, F.lit(k.pattern), 0)).otherwise(none).alias(k.name)
        for k in KINDS])
    no_spans = F.array().cast("array<struct<start:int,match:string>>")
    placed = found.select("doc_id", "text", *[
        F.when(F.size(k.name) > 0, F.arrays_zip(
            _starts(F.split(text, k.pattern, -1), F.col(k.name)).alias("start"),
            F.col(k.name).alias("match"))).otherwise(no_spans).cast(
                "array<struct<start:int,match:string>>").alias(k.name)
        for k in KINDS])

    def spans(kind: Kind) -> Column:
        def scored(m: Column) -> Column:
            begin = F.greatest(m["start"] - CONTEXT_CHARS, F.lit(0))
            near = F.lower(F.substr(text, begin + 1, m["start"] - begin))
            return F.struct(
                F.lit(kind.name).alias("kind"), m["start"].alias("start"),
                (m["start"] + F.length(m["match"])).alias("stop"),
                F.least(F.lit(1.0), F.lit(kind.score) + F.when(
                    near.rlike(rf"\b(?:{kind.context})"), F.lit(CONTEXT_ADDS)).otherwise(0.0))
                .alias("score"))

        good = F.filter(F.col(kind.name), lambda m: _valid(kind.name, m["match"]))
        out = F.transform(good, scored)
        return out if kind.base else F.filter(out, lambda s: s["score"] >= LEAST_SCORE)

    return placed.select("doc_id", F.concat(*[spans(k) for k in KINDS]).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    base = [k.name for k in KINDS if k.base]

    def of(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")

    return found.select(
        "doc_id", *[of(name).alias(f"n_{name}") for name in base],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256)
        .alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))
