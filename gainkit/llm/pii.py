"""Operator 4: personal data, with DataFrame functions only.

Regular expressions propose spans; validators confirm them (octets of an
address, digits of a phone number, Luhn for cards, mod-97 for account numbers,
reserved ranges for social security numbers); context words near a span, up to
the neighbouring proposals, raise its score. The base kinds (email, ip, card,
phone) stay whenever their validator holds; the kinds added by the method
(iban, ssn) stay from ``THRESHOLD`` on.

The patterns are written so that a long run of fitting characters is walked
once: possessive repetition, and a start only where a run starts (or where the
last match ended). They find the same leftmost matches as the plain forms.

Defined results: null and empty texts hold nothing; texts of any length are
searched whole; repeated rows each give their row; an empty table gives an
empty one; other columns are kept by ``redact`` and ignored by ``detect``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.6
NEAR = 40  # code points on either side that are searched for context words


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str      # a cheap test that any match fulfils
    score: float
    context: str
    base: bool


# Patterns of the contract, and of the added kinds: fixed values.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         r"e-?mail|contact|write to|kontakt|correo|courriel", True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", 0.6, r"\bip\b|address|host|server|login", True),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", r"[0-9]", 0.8, r"card|visa|master|amex|credit|payment|karte|tarjeta|carte", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, r"phone|call|tel|mobile|fax|whatsapp", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}", 0.8, r"iban|account|konto|cuenta|compte|bank", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]", 0.4,
         r"ssn|social security|tax id|security number", False),
)


def _possible(text: Column, kind: Kind) -> Column:
    return F.contains(text, F.lit(kind.needs)) if len(kind.needs) == 1 else text.rlike(kind.needs)


def mod97(account: Column) -> Column:
    """True where the account number's rearranged digits leave 1 on division by 97."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))

    def step(acc, c):
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


def confirmed(kind: Kind, hit: Column) -> Column:
    """The validator of a proposed span."""
    if kind.name == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.coalesce(p.try_cast("bigint"), F.lit(256)) <= 255)
    if kind.name == "card":
        digits = F.regexp_replace(hit, r"[\x20-]", "")
        return F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind.name == "phone":
        return F.length(F.regexp_replace(hit, "[^0-9]", "")).between(9, 15)
    if kind.name == "iban":
        return mod97(hit)
    if kind.name == "ssn":
        return ~hit.rlike(r"^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _score(kind: Kind, before: Column, after: Column) -> Column:
    near = F.concat(F.right(before, F.lit(NEAR)), F.lit(" "), F.left(F.coalesce(after, F.lit("")), F.lit(NEAR)))
    bonus = F.when(F.lower(near).rlike(kind.context), F.lit(0.3)).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), F.round(F.lit(kind.score) + bonus, 2))


def _proposals(text: Column, kind: Kind) -> Column:
    """array<struct<h, p, q>>: each match with the text between it and the
    match before (p) and after it (q)."""
    pieces = F.split(text, kind.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    zipped = F.arrays_zip(hits.alias("h"), pieces.alias("p"), F.slice(pieces, F.lit(2), F.size(pieces)).alias("q"))
    empty = F.filter(zipped, lambda x: F.lit(False))
    return F.when(_possible(text, kind), F.filter(zipped, lambda x: x["h"].isNotNull())).otherwise(empty)


def _accepted(kind: Kind, x: Column) -> Column:
    ok = confirmed(kind, x["h"])
    return ok if kind.base else ok & (_score(kind, x["p"], x["q"]) >= THRESHOLD)


def _located(kind: Kind, order: int, proposals: Column) -> Column:
    """array<struct<start, kind order, end, label, score>> of the accepted spans."""
    def step(acc, x):
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["h"])
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"),
                        F.concat(F.lit(kind.name + ":"), start.cast("string"), F.lit(":"), end.cast("string")).alias("label"),
                        _score(kind, x["p"], x["q"]).alias("score"))
        return F.struct(end.alias("at"), F.when(_accepted(kind, x), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    none = "cast(array() as array<struct<start:int,kind:int,end:int,label:string,score:double>>)"
    zero = F.struct(F.lit(0).alias("at"), F.expr(none).alias("out"))
    return F.aggregate(proposals, zero, step, lambda acc: acc["out"])


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts and digest of the base spans, all spans, scores.
    Positions are code points, ends exclusive."""
    d = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    d = d.select("_key", *[_proposals(F.col("_text"), k).alias("_p_" + k.name) for k in KINDS])
    d = d.select("_key", *[_located(k, i, F.col("_p_" + k.name)).alias("_s_" + k.name) for i, k in enumerate(KINDS)])
    base = F.array_sort(F.concat(*[F.col("_s_" + k.name) for k in KINDS if k.base]))
    every = F.array_sort(F.concat(*[F.col("_s_" + k.name) for k in KINDS]))
    counts = [F.size("_s_" + k.name).cast("long").alias("n_" + k.name) for k in KINDS]
    return d.select(
        F.col("_key").alias(key), *counts[:4],
        F.sha2(F.array_join(F.transform(base, lambda s: s["label"]), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(every, lambda s: s["label"]), ",").alias("spans"),
        F.array_join(F.transform(every, lambda s: s["score"].cast("string")), ",").alias("scores"), *counts[4:])


def _masked(text: Column, kind: Kind) -> Column:
    """The text with the accepted spans of one kind replaced by its name."""
    tag = F.lit(f"[{kind.name.upper()}]")
    pieces = F.split(text, kind.pattern, -1)
    first = F.element_at(pieces, 1)
    parts = F.transform(_proposals(text, kind), lambda x: F.concat(
        F.when(_accepted(kind, x), tag).otherwise(x["h"]), F.coalesce(x["q"], F.lit(""))))
    return F.when(_possible(text, kind), F.concat(first, F.array_join(parts, ""))).otherwise(text)


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with every accepted span replaced by its kind in brackets, kind
    after kind (email, phone, card, iban, ssn, ip: a wider kind goes before one
    that could lie within it). ``length``, where there is such a column, is
    the new text's number of code points. Null texts stay null."""
    by_name = {k.name: k for k in KINDS}
    out = docs
    for name in ("email", "phone", "card", "iban", "ssn", "ip"):
        out = out.withColumn(text, _masked(F.col(text), by_name[name]))
    if length in docs.columns:
        out = out.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return out
