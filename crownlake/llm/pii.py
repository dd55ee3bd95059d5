"""Personal data: patterns propose spans, check sums confirm them, context words adjust their score.

All of it is built-in column expressions. A pattern's matches are set between
marks by one replacement and cut out by one split; the lengths of the pieces
give the spans' places in code points, and the pieces beside a match are its
context. Patterns run only on texts that a cheap test lets through, and none of
them repeats a group without bound or starts anew within a run, so their time
is linear in the text and their stack is flat:

- a dot before a label, and a separator between two digits, are first replaced
  by a mark of the same length, so domains and card numbers become plain runs;
- a local part, or an address's first number, starts only where its run starts
  or where the last match ended.

An account number may be followed, or preceded, by words in capitals and figures
that its pattern takes in as well. So it is looked for from each word that can
begin one: of that run's beginnings that end with a word and pass the check sum,
the one with the length of its country counts, else the longest. Numbers found
from different words may overlap; both pass the check sum, and both are given.

Defined cases: null text is empty text and has no span. Rows with a null or
repeated ``doc_id`` are scanned like any other. An empty table gives an empty
result. Texts of any length are scanned whole. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownlake.llm.common import texts

# Marks; control characters of the text that look like them read as another one of the same length.
CUT, JOIN, OTHER = "\x01", "\x03", "\x02"
CONTEXT = 40
BLOCK = 64

# Context words that speak for a kind, and those that speak against any.
DOUBT = "example|sample|dummy|test|beispiel|ejemplo|exemple"


@dataclass(frozen=True)
class Kind:
    """``candidate``: a text without a match of it has no span. ``joined``: what JOIN replaces, if anything.

    ``runs``: the pattern is a place, with the run from there and what follows as its groups; a span is a beginning of the run.
    """

    name: str
    candidate: str
    pattern: str
    valid: Callable[[Column], Column]
    score: int
    words: str
    joined: str | None = None
    base: bool = True
    runs: bool = False


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def between(value: Column, low: int, high: int) -> Column:
    return F.length(digits(value)).between(low, high)


def luhn(value: Column) -> Column:
    """Luhn's check sum: from the right, every second digit counts twice, less nine if over nine."""
    figures = F.reverse(F.split(digits(value), ""))
    weighed = F.transform(
        figures,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod_97(value: Column) -> Column:
    """The account number with its first four characters last, letters as 10 to 35, leaves 1 by 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


# Lengths of account numbers by country, and the least of any.
LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 "
    "GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 "
    "MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 "
    "UA29 VA22 VG24 XK20 YE30"
)
LEAST = 15


def account(run: Column) -> Column:
    """The account number that a run begins with; null if none of its beginnings passes the check sum."""

    def plain(value: Column) -> Column:
        return F.replace(value, F.lit(" "), F.lit(""))

    words = F.split(run, " ")
    beginnings = F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, F.lit(1), k), " "))
    valid = F.filter(beginnings, lambda v: F.when(F.length(plain(v)) >= LEAST, mod_97(v)).otherwise(False))
    return F.aggregate(
        valid,
        F.lit(None).cast("string"),
        lambda a, v: F.when(F.contains(F.lit(LENGTHS), F.concat(F.left(a, F.lit(2)), F.length(plain(a)).cast("string"))), a).otherwise(v),
    )


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LOCAL = r"[A-Za-z0-9._%+\x03-]"

KINDS = [
    Kind(
        "email", "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++\x03[A-Za-z0-9\x03-]++",
        lambda v: F.lit(True), 80, "mail|contact|kontakt|correo|courriel", joined=r"\.(?=[A-Za-z0-9-])",
    ),
    Kind(
        "ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), 60, "ip|host|server|address|adresse",
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?[0-9]){12}", r"[0-9][0-9\x03]++",
        lambda v: between(v, 13, 19) & luhn(v), 80, "card|visa|credit|karte|tarjeta|carte", joined=r"(?<=[0-9])[\x20-](?=[0-9])",
    ),
    Kind(
        "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda v: between(v, 9, 15), 60, "phone|tel|call|mobile|fax|anruf|llama",
    ),
    Kind(
        "iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11}",
        rf"(?<![A-Za-z0-9])(?=([A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9]))((?s:.{{0,{CONTEXT}}})))",
        mod_97, 90, "iban|bank|account|konto|cuenta|compte", base=False, runs=True,
    ),
]


def placed(pieces: Column) -> Column:
    """(value, start) of each piece. In blocks, so that the work stays far below the square of their number."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, v: a + F.length(v))

    # Lambdas use only their own variables and stored columns: an outer expression would be computed anew for each element.
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int")), lambda b: F.slice(pieces, b * BLOCK + 1, BLOCK))
    none = F.array().cast("array<struct<part:array<string>,before:int>>")
    summed = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("before"), none.alias("out")),
        lambda a, part: F.struct(
            (a["before"] + total(part)).alias("before"),
            F.concat(a["out"], F.array(F.struct(part.alias("part"), a["before"].alias("before")))).alias("out"),
        ),
        lambda a: a["out"],
    )

    def place(block: Column) -> Column:
        return F.transform(
            block["part"],
            lambda v, i: F.struct(v.alias("value"), (block["before"] + total(F.slice(block["part"], F.lit(1), i))).alias("start")),
        )

    return F.flatten(F.transform(summed, place))


def _pieces(text: Column, kind: Kind) -> Column:
    """The text cut before and after each match; null where it has none. Matches are at odd places, counted from 0.

    Of a kind with runs, cut at each place, with the run and what follows it in between: every third piece is text.
    """
    plain = F.when(text.rlike("[\x01\x03]"), F.translate(text, CUT + JOIN, OTHER * 2)).otherwise(text)
    ready = F.regexp_replace(plain, kind.joined, JOIN) if kind.joined else plain
    marked = f"{CUT}$1{CUT}$2{CUT}" if kind.runs else f"{CUT}$0{CUT}"
    return F.when(text.rlike(kind.candidate), F.split(F.regexp_replace(ready, kind.pattern, marked), CUT))


def _span(kind: Kind, value: Column, start: Column, before: Column, after: Column, ok: Column) -> Column:
    near = F.lower(F.concat(F.right(before, F.lit(CONTEXT)), F.lit(" "), F.left(after, F.lit(CONTEXT))))
    score = F.lit(kind.score) + F.when(near.rlike(kind.words), 15).otherwise(0) - F.when(near.rlike(DOUBT), 20).otherwise(0)
    return F.struct(
        F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"),
        F.least(F.lit(100), score).alias("score"), ok.alias("ok"),
    )


def _found(pieces: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind: (kind, start, end, score)."""

    def span(piece: Column, i: Column) -> Column:
        value = piece["value"]
        return _span(kind, value, piece["start"], F.get(pieces, i - 1), F.get(pieces, i + 1), (i % 2 == 1) & kind.valid(value))

    return F.filter(F.transform(placed(pieces), span), lambda s: s["ok"])


def _found_in_runs(pieces: Column, kind: Kind) -> Column:
    """The same of a kind with runs. Places are at least five characters apart, so a few pieces of text hold the context before."""
    starts = placed(F.filter(pieces, lambda _, i: i % 3 == 0))
    runs = F.filter(pieces, lambda _, i: i % 3 == 1)
    numbers = F.concat(F.array(F.lit(None).cast("string")), F.transform(runs, account))

    def span(at: Column, i: Column) -> Column:
        value = at["number"]
        before = F.concat_ws("", *[F.right(F.get(pieces, (i - j) * 3), F.lit(CONTEXT)) for j in range(CONTEXT // 5, 0, -1)])
        after = F.concat(F.substr(F.get(pieces, i * 3 - 2), F.length(value) + 1), F.get(pieces, i * 3 - 1))
        return _span(kind, value, at["place"]["start"], before, after, F.lit(True))

    both = F.zip_with(starts, numbers, lambda place, number: F.struct(place.alias("place"), number.alias("number")))
    found = F.transform(both, lambda at, i: F.when(at["number"].isNotNull(), span(at, i)))
    return F.filter(found, lambda s: s.isNotNull())


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, found`` of every row: an array of (kind, start, end, score), by kind as listed, then start."""
    cut = texts(docs).select("doc_id", *[_pieces(F.col("text"), k).alias(f"p_{k.name}") for k in KINDS])
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:int,ok:boolean>>")
    found = [F.coalesce((_found_in_runs if k.runs else _found)(F.col(f"p_{k.name}"), k), none) for k in KINDS]
    return cut.select("doc_id", F.concat(*found).alias("found"))


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, digest of the base spans, all spans, and their scores in the same order."""
    found = find_personal_data(docs)
    base = [k.name for k in KINDS if k.base]

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in base],
        F.sha2(written(F.filter("found", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
