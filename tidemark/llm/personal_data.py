"""Personal data: patterns propose, checksums confirm, nearby words adjust the score. DataFrame functions only.

Spark gives the matches of a pattern but not where they are. `split` by the same pattern gives the text between
them, and the running sum of both lengths gives the offsets, in code points. The text before and after a match
is also what its context words are looked for in.

The patterns are written so that they take linear time on any text: repetitions are possessive, and a match may
start only where a run of its characters starts (or where the last match ended). They match exactly what the
plain forms in the comments match.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, names

SPAN = "array<struct<kind: string, start: int, stop: int, score: double>>"
#: Characters on each side of a match in which context words count.
NEAR = 40
#: Spans of kinds that need support are reported from this score on.
LEAST = 0.7


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check; every second digit from the right is doubled."""
    turned = F.reverse(digits)
    each = F.transform(
        F.sequence(F.lit(1), F.length(turned)),
        lambda i: F.substring(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.floor(x / 10).cast("int") + x % 10) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number passes the mod-97 check: its first four characters count last, letters as 10 to 35."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    each = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substring(turned, i, F.lit(1))))
    step = lambda s, a: F.when(a >= 65, (s * 100 + a - 55) % 97).otherwise((s * 10 + a - 48) % 97)
    return F.length(plain).between(15, 34) & (F.aggregate(each, F.lit(0), step) == 1)


def _ip(found: Column) -> Column:
    short = F.transform(F.split(found, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
    return F.forall(short, lambda x: (F.length(x) <= 3) & (F.right(x, F.lit(3)).cast("int") <= 255))


def _count(found: Column, low: int, high: int) -> Column:
    return F.length(_digits(found)).between(low, high)


@dataclass(frozen=True)
class Kind:
    """`some`: pattern that a text must match to be worth cutting up. `score`: of a confirmed match; `words`:
    a pattern of words near it that add `support`. A kind in `base` is reported whatever its score."""

    name: str
    pattern: str
    some: str
    confirm: object
    words: str
    score: float = 0.8
    support: float = 0.2
    base: bool = True
    languages: dict = field(default_factory=dict)


# What a match is, by kind; the plain form of each pattern is above it.
_CARD = r"[0-9](?:[\x20-]?+[0-9])++"
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda found: F.lit(True),
        r"mail|contact|kontakt|courriel|correo",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", _ip, r"\bip\b|address|adresse|server|host", score=0.6),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", _CARD, r"[0-9](?:[\x20-]?[0-9]){15}", lambda m: _count(m, 16, 19) & luhn(_digits(m)), r"card|karte|carte|tarjeta|visa"),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", lambda m: _count(m, 8, 15), r"tel|phone|call|mobil|llame|appel"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
        mod97,
        r"iban|account|konto|compte|cuenta|bank",
        base=False,
    ),
    # shorter card numbers: the checksum alone passes one number in ten, so a word nearby must support them
    Kind(
        "account",
        _CARD,
        r"[0-9](?:[\x20-]?[0-9]){12}",
        lambda m: _count(m, 13, 15) & luhn(_digits(m)),
        r"card|karte|carte|tarjeta|visa|amex|account|konto|compte|cuenta",
        score=0.4,
        support=0.4,
        base=False,
    ),
)


def _spans(text: Column, kind: Kind) -> Column:
    none = F.array().cast(SPAN)
    pattern = F.lit(kind.pattern)
    pieces, found = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    after = F.concat(F.slice(F.split(text, kind.pattern, -1), 2, 2_000_000_000), F.array(F.lit("")))
    both = F.zip_with(pieces, F.arrays_zip(found.alias("m"), after.alias("a")), lambda x, y: F.struct(x.alias("gap"), y["m"].alias("m"), y["a"].alias("a")))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        stop = start + F.length(x["m"])
        near = F.lower(F.concat(F.right(x["gap"], F.lit(NEAR)), F.lit(" "), F.left(x["a"], F.lit(NEAR))))
        score = F.lit(kind.score) + F.when(near.rlike(kind.words), kind.support).otherwise(0.0)
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), stop.alias("stop"), score.alias("score"))
        good = kind.confirm(x["m"]) if kind.base else kind.confirm(x["m"]) & (score >= LEAST)
        spans = F.when(x["m"].isNotNull() & good, F.concat(state["spans"], F.array(span).cast(SPAN)))
        return F.struct(F.coalesce(stop, start).alias("at"), F.coalesce(spans, state["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(text.rlike(kind.some), F.aggregate(both, start, add, lambda s: s["spans"])).otherwise(none)


def find_personal_data(docs: DataFrame, text: str = "text", into: str = "spans", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """All columns of `docs` and the array `into` of (kind, start, stop, score): by kind as listed, then by start.

    Offsets are in code points, the end is exclusive. Within a kind, matches are taken from the left and do not
    overlap; one that is not confirmed is dropped with all its characters. Spans of different kinds may overlap.
    Each row is worked on where it is, whole; nothing is shuffled. A null or empty text has no spans; repeated
    rows each give theirs. A column of the name `into` is replaced; other columns play no part.
    """
    whole = F.coalesce(col(text), F.lit(""))
    return docs.withColumn(into, F.concat(*[_spans(whole, kind) for kind in kinds]))


def base_kinds(kinds: tuple[Kind, ...] = KINDS) -> list[str]:
    return [k.name for k in kinds if k.base]


def described(spans: Column) -> Column:
    """`kind:start:stop` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(found: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one, named after
    the one that starts first. A null text stays null; no spans, no change."""
    ordered = F.array_sort(
        F.transform(F.coalesce(col(spans), F.array().cast(SPAN)), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    )

    def add(state: Column, s: Column) -> Column:
        new = s["start"] >= state["at"]
        piece = F.concat(F.substr(col(text), state["at"] + 1, s["start"] - state["at"]), F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"),
            F.when(new, F.concat(state["out"], F.array(piece))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    joined = F.aggregate(ordered, start, add, lambda s: F.concat(F.array_join(s["out"], ""), F.substr(col(text), s["at"] + 1)))
    return found.withColumn(text, F.when(F.size(col(spans)) > 0, joined).otherwise(col(text)))
