"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a column expression. Patterns use possessive repeats and start
only at the head of a run (or right after the previous match), which finds the
same leftmost matches as the plain patterns but never rescans a run, so time
stays linear in the text and no repeat recurses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.common import col, unused

SPAN = "array<struct<rank:int,start:int,stop:int,kind:string,score:double>>"
# Code points on either side of a span in which context words count.
WINDOW = 40
# Code points of the blocks a text is cut into to read windows, and matches taken at a time.
BLOCK = 1000
CHUNK = 256


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``hint`` is a cheap test that every matching text passes. ``base`` kinds are
    kept whatever their score; others need ``floor``.
    """

    name: str
    pattern: str
    hint: str
    prior: float
    context: str
    base: bool = True
    floor: float = 0.5


# The kinds in their order, their patterns and context words.
EMAIL_PART = "A-Za-z0-9._%+-"
KINDS = [
    Kind("email", rf"(?:(?<![{EMAIL_PART}])|\G)[{EMAIL_PART}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "mail|contact|write|kontakt|correo|courriel"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.5, r"\bip\b|address|host|server|login|adresse"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.7, "card|visa|credit|payment|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, r"\btel|phone|call|fax|mobile|anruf|appel|llama"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", "", 0.6, "iban|account|bank|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])", "-", 0.3, r"\bssn\b|social security|tax id|steuer", base=False),
]
DECIMAL_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn's check of a string of digits: every second digit from the right counts double, less 9 above 9."""
    chars = F.split(F.reverse(number), "")

    def add(total: Column, place: Column) -> Column:
        digit = F.element_at(chars, place).cast("int")
        doubled = F.when(place % 2 == 0, digit * 2).otherwise(digit)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """ISO 7064 check of an account number: the first four characters moved to the end, letters as 10 to 35, leave 1 modulo 97."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        number = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), char) - 1
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def confirmed(kind: str, found: Column) -> Column:
    """The checksum or range test of a proposed span."""
    number = digits(found)
    if kind == "ip":
        return found.rlike(rf"^{DECIMAL_PART}(?:\.{DECIMAL_PART}){{3}}$")
    if kind == "card":
        return F.length(number).between(16, 19) & luhn(number)
    if kind == "phone":
        return F.length(number).between(8, 15)
    if kind == "iban":
        return mod97(found)
    if kind == "ssn":
        return ~found.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def cut_out(blocks: Column, start: Column, size: Column) -> Column:
    """At most WINDOW code points of a text from ``start``, read from the two blocks that can hold them."""
    first = F.floor(start / BLOCK).cast("int") + 1
    near = F.concat(F.coalesce(F.get(blocks, first - 1), F.lit("")), F.coalesce(F.get(blocks, first), F.lit("")))
    return F.substring(near, start % BLOCK + 1, size)


def pairs_of(kind: Kind, text: Column, found: Column) -> Column:
    """The matches of one kind, each with the piece of text between it and the one before."""
    between = F.split(text, kind.pattern, -1)
    return F.when(F.size(found) > 0, F.zip_with(F.slice(between, 1, F.size(found)), found, lambda p, m: F.struct(p.alias("piece"), m.alias("match"))))


def spans_of(kind: Kind, rank: int, pairs: Column, blocks: Column) -> Column:
    """Confirmed, scored spans of one kind from its matches and the blocks of the text.

    The text between matches gives the places: match i starts after the first
    i + 1 pieces and the first i matches. A fold copies its state at every step,
    so spans are gathered chunk by chunk and windows read from blocks: a step
    costs about the same however long the text is.
    """

    def place(state: Column, item: Column) -> Column:
        start = state["at"] + F.length(item["piece"])
        stop = start + F.length(item["match"])
        window = F.concat(
            cut_out(blocks, F.greatest(start - WINDOW, F.lit(0)), F.least(start, F.lit(WINDOW))), F.lit("\n"), cut_out(blocks, stop, F.lit(WINDOW))
        )
        score = F.lit(kind.prior) + F.when(F.lower(window).rlike(kind.context), 0.2).otherwise(0.0)
        keep = confirmed(kind.name, item["match"]) if kind.base else confirmed(kind.name, item["match"]) & (score >= kind.floor)
        span = F.struct(
            F.lit(rank).alias("rank"), start.alias("start"), stop.alias("stop"), F.lit(kind.name).alias("kind"), score.alias("score")
        )
        more = F.when(keep, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(stop.alias("at"), more.alias("spans"))

    def chunk(state: Column, first: Column) -> Column:
        begin = F.struct(state["at"].alias("at"), F.from_json(F.lit("[]"), SPAN).alias("spans"))
        # The fold is run once: it is the only element that the transform sees.
        folded = F.array(F.aggregate(F.slice(pairs, first, CHUNK), begin, place))
        return F.element_at(
            F.transform(folded, lambda f: F.struct(f["at"].alias("at"), F.concat(state["done"], F.array(f["spans"])).alias("done"))), 1
        )

    begin = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), f"array<{SPAN}>").alias("done"))
    firsts = F.sequence(F.lit(1), F.size(pairs), F.lit(CHUNK))
    return F.when(F.size(pairs) > 0, F.aggregate(firsts, begin, chunk, lambda s: F.flatten(s["done"])))


def find_personal_data(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Add ``out``: an array of (rank, start, stop, kind, score) of all spans, by kind and start.

    Places are in code points, ``stop`` exclusive. Matches of one kind do not
    overlap; spans of different kinds may. A failing match is dropped and not
    tried again shorter. A null or empty text has an empty array; a column
    named like ``out`` is replaced, all others stay.
    """
    body, cuts, *names = unused(docs, "pii_text", "pii_blocks", *[f"pii_{k.name}" for k in KINDS], *[f"pii_{k.name}_pairs" for k in KINDS])
    lists, pairs = names[: len(KINDS)], names[len(KINDS) :]
    full = docs.withColumn(body, F.coalesce(col(text), F.lit("")))
    found = {}
    for kind, name in zip(KINDS, lists):
        hint = F.contains(F.col(body), F.lit(kind.hint)) if kind.hint else F.col(body).rlike("[0-9]{2}|[0-9][ -][0-9]")
        found[name] = F.when(hint, F.regexp_extract_all(F.col(body), F.lit(kind.pattern), F.lit(0)))
    full = full.withColumns(found)
    some = sum((F.coalesce(F.size(n), F.lit(0)) for n in lists), F.lit(0)) > 0
    blocks = F.when(some, F.regexp_extract_all(F.col(body), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    full = full.withColumns({cuts: blocks, **{p: pairs_of(k, F.col(body), F.col(n)) for k, n, p in zip(KINDS, lists, pairs)}})
    empty = F.from_json(F.lit("[]"), SPAN)
    spans = [F.coalesce(spans_of(k, i, F.col(p), F.col(cuts)), empty) for i, (k, p) in enumerate(zip(KINDS, pairs))]
    return full.withColumn(out, F.array_sort(F.concat(*spans))).drop(body, cuts, *names)


def digest(spans: Column) -> Column:
    """Spans as text: kind:start:stop joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(docs: DataFrame, text: str = "text", spans: str = "spans", out: str = "text") -> DataFrame:
    """Replace each span by its kind in angle brackets; of overlapping spans the first to start wins."""
    ordered = F.array_sort(F.transform(col(spans), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        grown = F.concat(state["done"], F.substring(col(text), state["at"] + 1, s["start"] - state["at"]), F.lit("<"), s["kind"], F.lit(">"))
        fits = s["start"] >= state["at"]
        return F.struct(F.when(fits, grown).otherwise(state["done"]).alias("done"), F.when(fits, s["stop"]).otherwise(state["at"]).alias("at"))

    begin = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    return docs.withColumn(out, F.aggregate(ordered, begin, step, lambda s: F.concat(s["done"], F.substring(col(text), s["at"] + 1, F.length(col(text))))))
