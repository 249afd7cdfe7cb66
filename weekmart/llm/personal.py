"""Personal data: patterns propose spans, checks of their digits confirm them, words nearby adjust their score.

DataFrame functions only. A pattern's matches and the texts between them give the places of the matches by running sums
of their lengths, and what stands beside a match is the end of one such text and the beginning of the next, so no text is
cut once more for each match. The sums are made in blocks of BLOCK matches; a text full of matches costs little more than
its length. The patterns need no backtracking over long runs and no recursion: a text of one endless run of letters or
digits is read once.

Base kinds (email, ip, card, phone) stay whatever their score. Kinds that the method adds stay from MIN_SCORE on:

* ``iban``: length by country, remainder 1 when divided by 97
* ``account``: card numbers of 13 to 15 digits by the Luhn sum, which need a word nearby
* ``ssn``: a number that can have been issued, which needs a word nearby
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "account", "ssn")
SPAN = "struct<kind: string, start: int, end: int, score: int>"
MIN_SCORE, CONTEXT_SCORE = 50, 30
BEFORE, AFTER, BLOCK = 40, 20, 512
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Lengths of account numbers by country.
IBAN_LENGTHS = {
    15: ("NO",), 16: ("BE",), 18: ("DK", "FI", "NL"), 19: ("SI",), 20: ("AT", "BA", "EE", "LT", "LU"), 21: ("CH", "HR", "LI", "LV"),
    22: ("BG", "DE", "GB", "GE", "IE", "ME", "RS"), 23: ("AE", "GI", "IL"), 24: ("AD", "CZ", "ES", "PK", "RO", "SA", "SE", "SK", "TN"),
    25: ("PT",), 26: ("IS", "TR"), 27: ("FR", "GR", "IT", "MC", "SM"), 28: ("CY", "HU", "PL"), 29: ("BR",), 31: ("MT",),
}
IBAN_BODY = "|".join(rf"(?:{'|'.join(c)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

#: Words that make a kind likelier beside it. They stand between other signs than letters.
WORDS = {
    "email": "email|e-mail|mail|contact|write|reply|kontakt|correo|courriel",
    "ip": "ip|address|host|server|client|gateway|login|logged|from",
    "card": "card|credit|debit|visa|mastercard|maestro|payment|karte|tarjeta|carte",
    "phone": "phone|tel|telephone|mobile|cell|call|fax|whatsapp|telefon|telefono|portable",
    "iban": "iban|account|bank|transfer|konto|cuenta|compte",
    "account": "card|credit|debit|amex|visa|diners|payment|karte|tarjeta|carte",
    "ssn": "ssn|social|security|taxpayer|tin",
}
#: Words that make it unlikelier.
OTHER_WORDS = {"ip": "version|release|section|chapter|build"}
SCORES = {"email": 70, "ip": 50, "card": 60, "phone": 40, "iban": 60, "account": 25, "ssn": 25}


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a text of digits ends in 0."""
    back = F.reverse(digits)
    values = F.transform(F.sequence(F.lit(1), F.length(back)), lambda i: F.when(
        i % 2 == 0, F.try_element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substr(back, i, F.lit(1)).cast("int") + 1))
        .otherwise(F.substr(back, i, F.lit(1)).cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod_97(number: Column) -> Column:
    """Remainder of an account number, its first four signs moved to the end and letters counted from 10, divided by 97."""
    turned = F.concat(F.substr(number, F.lit(5)), F.substr(number, F.lit(1), F.lit(4)))
    values = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.instr(
        F.lit("0123456789" + UPPER), F.substr(turned, i, F.lit(1))) - 1)
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


class Proposal(NamedTuple):
    """A pattern; a sign without which it has no match; the kind of a match (null: none) by its text."""

    pattern: str
    sign: str | None
    kind: Callable[[Column], Column]


def _card(hit: Column) -> Column:
    number = digits(hit)
    return F.when(luhn(number), F.when(F.length(number) >= 16, "card").otherwise("account"))


def _issued(hit: Column) -> Column:
    return F.when(~hit.rlike("^(000|666|9)|-00-|0000$"), "ssn")


BYTE = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

#: Matches begin where a leftmost search can begin: not inside a run of signs whose beginning has failed already.
PROPOSALS = (
    Proposal(r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++", "@", lambda hit: F.lit("email")),
    Proposal(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++", ".",
             lambda hit: F.when(hit.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"), "ip")),
    Proposal(r"[0-9](?<![0-9][0-9])(?<![0-9][\x20\-][0-9])(?>(?:[\x20\-]?[0-9]){12,18})(?![\x20\-]?[0-9])", None, _card),
    Proposal(r"\+[0-9][\x20().0-9\-]+[0-9]", "+", lambda hit: F.when(F.length(digits(hit)).between(8, 15), "phone")),
    Proposal(rf"(?<![A-Za-z0-9_])(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN_BODY})(?![A-Za-z0-9_])", None,
             lambda hit: F.when(mod_97(F.replace(hit, F.lit(" "), F.lit(""))) == 1, "iban")),
    Proposal(r"[0-9](?<![0-9A-Za-z_\-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z_\-])", "-", _issued),
)


def _word(words: str) -> str:
    return rf"(^|[^a-z])({words})([^a-z]|$)"


def context_score(kind: Column, beside: Column) -> Column:
    """Score of a span by its kind and the words beside it, from 0 to 100."""
    score = F.lit(0)
    for name in KINDS:
        own = F.lit(SCORES[name]) + F.when(beside.rlike(_word(WORDS[name])), CONTEXT_SCORE).otherwise(0)
        if name in OTHER_WORDS:
            own = own - F.when(beside.rlike(_word(OTHER_WORDS[name])), CONTEXT_SCORE).otherwise(0)
        score = F.when(kind == name, own).otherwise(score)
    return F.least(F.lit(100), score)


def match_ends(hits: str, gaps: str) -> Column:
    """Where each match ends in code points, from the matches and the texts around them; sums in blocks of BLOCK."""
    cells = f"zip_with({hits}, slice({gaps}, 1, size({hits})), (h, g) -> length(h) + length(g))"
    return F.expr(f"""
        transform(array({cells}), cells ->
          transform(array(transform(sequence(0, (size(cells) - 1) div {BLOCK}), b -> slice(cells, b * {BLOCK} + 1, {BLOCK}))), blocks ->
            flatten(zip_with(
              blocks,
              slice(aggregate(blocks, array(0), (a, c) -> array_append(a, element_at(a, -1) + aggregate(c, 0, (n, x) -> n + x))), 1, size(blocks)),
              (c, f) -> slice(aggregate(c, array(f), (a, x) -> array_append(a, element_at(a, -1) + x)), 2, size(c))
            )))[0])[0]""")


def _unused(columns: Sequence[str], name: str) -> str:
    """A name like ``name`` that no column has, in any case."""
    while name.lower() in (c.lower() for c in columns):
        name = f"_{name}"
    return name


def with_spans(docs: DataFrame, text: str = "text", spans: str = "spans", min_score: int = MIN_SCORE) -> DataFrame:
    """``docs`` with an array of personal-data spans: kind, start and end in code points (end exclusive), score (0 to 100).

    They are ordered by kind as listed in KINDS, then start. Spans of one kind never overlap, those of different kinds may.
    Null or empty text has an empty array. Repeated rows get equal arrays; a column called ``spans`` is replaced, other
    columns stay. Nothing is shuffled.
    """
    hits, gaps, ends, found = (_unused([*docs.columns, spans], name) for name in ("hits", "gaps", "ends", "found"))
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    work = docs.withColumn(hits, F.struct(*[
        F.when(F.lit(True) if p.sign is None else F.contains(body, F.lit(p.sign)), F.regexp_extract_all(body, F.lit(p.pattern), F.lit(0)))
        .otherwise(none).alias(f"h{k}") for k, p in enumerate(PROPOSALS)]))
    # the texts between the matches, cut only where there are some
    work = work.withColumn(gaps, F.struct(*[
        F.when(F.size(f"{hits}.h{k}") > 0, F.split(body, p.pattern, -1)).otherwise(none).alias(f"g{k}") for k, p in enumerate(PROPOSALS)]))
    work = work.withColumn(ends, F.struct(*[
        F.when(F.size(f"{hits}.h{k}") > 0, match_ends(f"{hits}.h{k}", f"{gaps}.g{k}")).otherwise(F.array().cast("array<int>")).alias(f"e{k}")
        for k in range(len(PROPOSALS))]))

    def cells(k: int) -> Column:
        hit, gap = F.col(f"{hits}.h{k}"), F.col(f"{gaps}.g{k}")
        return F.arrays_zip(
            hit.alias("hit"), F.col(f"{ends}.e{k}").alias("end"), F.slice(gap, 1, F.size(hit)).alias("before"), F.slice(gap, 2, F.size(hit)).alias("after"))

    def judged(k: int) -> Column:
        def span(x: Column) -> Column:
            beside = F.concat(F.right(x["before"], F.lit(BEFORE)), F.lit(" | "), F.left(x["after"], F.lit(AFTER)))
            return F.struct(
                PROPOSALS[k].kind(x["hit"]).alias("kind"), (x["end"] - F.length(x["hit"])).alias("start"), x["end"].alias("end"),
                F.translate(beside, UPPER, LOWER).alias("beside"))

        return F.filter(F.transform(cells(k), span), lambda s: s["kind"].isNotNull())

    work = work.withColumn(found, F.concat(*[
        F.when(F.size(f"{hits}.h{k}") > 0, judged(k)).otherwise(F.array().cast("array<struct<kind: string, start: int, end: int, beside: string>>"))
        for k in range(len(PROPOSALS))]))
    scored = F.transform(found, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), context_score(s["kind"], s["beside"]).alias("score")))
    work = work.withColumn(found, F.when(F.size(found) > 0, F.filter(
        scored, lambda s: s["kind"].isin(list(BASE)) | (s["score"] >= min_score))).otherwise(F.array().cast(f"array<{SPAN}>")))
    ordered = F.concat(*[of_kinds(F.col(found), [kind]) for kind in KINDS])
    out = work.withColumn(spans, F.when(F.size(found) > 0, ordered).otherwise(F.col(found)).cast(f"array<{SPAN}>"))
    return out.drop(hits, gaps, ends, found)


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(list(kinds)))


def joined(spans: Column, kinds: Sequence[str] = KINDS) -> Column:
    """The spans of the given kinds as kind:start:end, comma-joined."""
    return F.array_join(F.transform(of_kinds(spans, kinds), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
