"""Personal data: spans by patterns, confirmed by checksums, weighed by the words around them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Possessive runs keep the patterns linear and off the stack: what a run could give back can never
#: be matched by what follows it. Where a match could only start inside a run after the run's own
#: start has failed, the look-behind skips the try; ``\\G`` is the end of the match before.
_MAIL = r"[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its pattern, the score of a confirmed span, and words that raise it."""

    name: str
    pattern: str
    score: float
    words: str
    base: bool = True


#: Characters of an account number by country, as registered.
IBAN_LONG = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """A number of a listed country has exactly its length, so what follows behind a blank is left out.

    Other countries' numbers have any length; their run ends before a listed country's number.
    """
    listed = "|".join(c for n in IBAN_LONG for c in IBAN_LONG[n].split())
    exact = "|".join(rf"(?:{IBAN_LONG[n].replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n in IBAN_LONG)
    other = rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20(?:{listed})[0-9]{{2}})\x20?[A-Z0-9]){{11,30}}+"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{exact}|{other})(?![A-Za-z0-9])"


KINDS = (
    Kind("email", rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", 0.7, "ip|host|server|address|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.7, "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|call|tel|mobile|fax|whatsapp"),
    Kind("iban", _iban(), 0.7, "iban|bank|account|konto|cuenta|compte", False),
    Kind("ssn", r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])", 0.3, "ssn|social security", False),
)
#: Characters before and after a span whose words count, what such a word adds, and what a span needs.
NEAR, CONTEXT, ENOUGH = 40, 0.3, 0.5
#: Entries that are folded into one array before arrays are joined; characters of a part of a text. Both
#: keep the work in proportion to the text: no array grows by single entries, no place is counted from the start.
BLOCK, PART = 128, 256
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of up to 19 digits passes the Luhn check."""
    value = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(value, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number passes the mod-97 check: four characters moved to the end, letters as 10 to 35."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, 5, 60), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        letter = F.instr(F.lit(_LETTERS), c)
        return F.when(letter > 0, (rest * 100 + letter + 9) % 97).otherwise((rest * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _confirmed(kind: str, text: Column) -> Column:
    n = F.length(_digits(text))
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
        return text.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return n.between(12, 19) & F.when(n <= 19, luhn(_digits(text))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return mod97(text)
    return F.lit(True)


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, the value being worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _folded(items: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What ``step(end, item)`` gives for each item, as one array of ``kind``, and the last end.

    ``step`` returns the end after the item and an array of what it adds. Items are folded in blocks,
    and the arrays of all blocks are joined at once.
    """
    none = F.array().cast(f"array<{kind}>")

    def add(state: Column, item: Column) -> Column:
        end, new = step(state["end"], item)
        return F.struct(end.alias("end"), F.concat(state["out"], new).alias("out"))

    def block(state: Column, b: Column) -> Column:
        got = F.aggregate(b, F.struct(state["end"].alias("end"), none.alias("out")), add)
        return _with(got, lambda g: F.struct(g["end"].alias("end"), F.concat(state["out"], F.array(g["out"])).alias("out")))

    def whole(items: Column) -> Column:
        last = F.greatest(F.ceil(F.size(items) / BLOCK).cast("int") - 1, F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))
        start = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        done = F.aggregate(blocks, start, block)
        return _with(done, lambda d: F.struct(d["end"].alias("end"), F.flatten(d["out"]).alias("out")))

    return _with(items, whole)


def _parts(text: Column) -> Column:
    """A text in parts of ``PART`` characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}+"), F.lit(0))


def _between(parts: Column, low: Column, high: Column) -> Column:
    """The characters from ``low`` up to ``high``, which may lie behind the end, of a text in ``parts``."""
    first, last = F.floor(low / PART).cast("int"), F.floor(high / PART).cast("int")
    # taking a slice copies the array, so up to two parts are taken by themselves
    two = F.concat(F.coalesce(F.get(parts, first), F.lit("")), F.coalesce(F.get(parts, first + 1), F.lit("")))
    some = F.when(last - first <= 1, two).otherwise(F.array_join(F.slice(parts, first + 1, last - first + 1), ""))
    return F.substring(some, (low - first * PART + 1).cast("int"), (high - low).cast("int"))


def _spans(text: Column, parts: Column, kind: Kind, order: int) -> Column:
    """Confirmed spans of a kind: the gaps between matches and the matches themselves add up to their places."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    pairs = F.zip_with(found, gaps, lambda m, g: F.struct(F.char_length(g).alias("gap"), F.char_length(m).alias("long"), m.alias("match")))
    pairs = F.filter(pairs, lambda p: p["match"].isNotNull())
    span = "struct<start:int,end:int>"

    def add(end: Column, p: Column) -> tuple[Column, Column]:
        start = end + p["gap"]
        own = F.array(F.struct(start.alias("start"), (start + p["long"]).alias("end"))).cast(f"array<{span}>")
        return start + p["long"], F.when(_confirmed(kind.name, p["match"]), own).otherwise(F.array().cast(f"array<{span}>"))

    spans = F.when(F.size(found) > 0, _folded(pairs, span, add)["out"]).otherwise(F.array().cast(f"array<{span}>"))

    def scored(s: Column) -> Column:
        near = F.concat_ws(" ", _between(parts, F.greatest(s["start"] - NEAR, F.lit(0)), s["start"]), _between(parts, s["end"], s["end"] + NEAR))
        helped = F.lower(near).rlike(rf"\b(?:{kind.words})")
        score = F.lit(kind.score) + F.when(helped, F.lit(CONTEXT)).otherwise(F.lit(0.0))
        return F.struct(s["start"], F.lit(order).alias("order"), F.lit(kind.name).alias("kind"), s["end"], F.least(score, F.lit(1.0)).alias("score"))

    spans = F.transform(spans, scored)
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= ENOUGH)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: array of (start, order, kind, end, score), by start, then kind as listed in ``KINDS``.

    Places are code points, ends exclusive. Spans of the base kinds need their check only; the kinds
    beyond them need their check and a score of ``ENOUGH``, which context words within ``NEAR``
    characters help to reach. Null and empty texts have no spans; texts are searched whole; rows are
    judged each on their own, so repeated rows and clashing column names (but ``pii``) change nothing.
    All of it are column functions: no shuffle, no Python, and work in proportion to the text.
    """
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def every(parts: Column) -> Column:
        return F.array_sort(F.concat(*[_spans(column, parts, kind, i) for i, kind in enumerate(KINDS)]))

    return docs.withColumn("pii", _with(_parts(column), every))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) of every document."""
    found = find(docs.select("doc_id", "text"))
    kinds = F.transform("pii", lambda s: s["kind"])
    count = [(F.size("pii") - F.size(F.array_remove(kinds, k.name))).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base]
    n_base = sum(k.base for k in KINDS)
    base = F.sha2(listed(F.filter("pii", lambda s: s["order"] < n_base)), 256)
    scores = F.transform("pii", lambda s: s["score"])
    return found.select("doc_id", *count, base.alias("base_sha256"), listed(F.col("pii")).alias("spans"), scores.alias("scores"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; overlapping spans count as one.

    Columns stay as they are; a null text stays null.
    """
    text = F.col("whole.text")
    found = find(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col("text")))
    cut = "struct<low:int,high:int,kind:string>"

    def add(end: Column, s: Column) -> tuple[Column, Column]:
        # a span that starts before the end of the one before lengthens it
        own = F.array(F.struct(end.alias("low"), s["start"].alias("high"), s["kind"].alias("kind"))).cast(f"array<{cut}>")
        return F.greatest(end, s["end"]), F.when(s["start"] >= end, own).otherwise(F.array().cast(f"array<{cut}>"))

    def clean(parts: Column) -> Column:
        def joined(done: Column) -> Column:
            pieces = F.transform(done["out"], lambda c: F.concat(_between(parts, c["low"], c["high"]), F.lit("<"), c["kind"], F.lit(">")))
            return F.concat(F.array_join(pieces, ""), _between(parts, done["end"], F.size(parts) * PART))

        return _with(_folded(F.col("pii"), cut, add), joined)

    masked = F.when(F.size("pii") == 0, text).otherwise(_with(_parts(text), clean))
    return found.withColumn("_clean", masked).select(*[(F.col("_clean") if c == "text" else F.col(f"whole.`{c}`")).alias(c) for c in docs.columns])
