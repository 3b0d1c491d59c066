"""Personal data: patterns propose spans, checksums confirm them, context words
nearby adjust their score.  Built-in column functions only.

Kinds, in order: ``email``, ``ip`` (four parts of at most 255), ``card`` (14 to 19
digits that pass Luhn), ``phone`` (10 to 15 digits after a plus); added to these:
``iban`` (mod-97 remainder 1), ``key`` (access keys of fixed form), ``secret`` (16 and
more key characters, letters and digits among them, 8 of them different),
``national`` (social security numbers in their valid ranges) and ``routing`` (bank
numbers with the 3-7-1 checksum).  A span's score is its kind's prior, lifted where
a context word stands within 40 characters.  Added kinds need ``LEAST_SCORE``: a
secret, national or routing number without a context word is none, as any long
identifier has its form.  Matches are leftmost and do not overlap within a kind; a
match that fails its check is dropped.  Offsets count code points, end
exclusive.

Positions come from splitting the text by the pattern: a match starts after the
pieces and matches before it.  The running sums go by blocks, so that a text
with very many matches costs about as many steps; the patterns have no nested
backtracking, so that a long run of one character class is read once.

Defined results: a null text counts as empty; repeated rows are each judged
alone; extra columns pass through unless one is named ``pii``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Order of the kinds that every report lists.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "key", "secret", "national", "routing")

_EDGE = "(?<![A-Za-z0-9_])"
# A match may start where its first class starts, or where the last match ended.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "key": rf"{_EDGE}(?:AKIA|ASIA)[0-9A-Z]{{16}}(?![A-Za-z0-9_])",
    "secret": r"[A-Za-z0-9+/_-]{16,}+",
    "national": rf"{_EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![A-Za-z0-9_])",
    "routing": rf"{_EDGE}[0-9]{{9}}(?![A-Za-z0-9_])",
}
#: A cheap test that any match must pass.
_HINT = {"email": "@", "phone": "+"}
_CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|address)",
    "ip": r"(?i)\b(ip|host|server|address|login|client)",
    "card": r"(?i)\b(card|credit|visa|master|debit|payment|cvv)",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax|contact|cell)",
    "iban": r"(?i)\b(iban|bank|account|transfer|swift|bic)",
    "key": rf"(?i){_EDGE}(key|aws|access|credential|secret)",
    "secret": rf"(?i){_EDGE}(token|password|passwd|pwd|secret|api.?key|auth|bearer|credential)",
    "national": rf"(?i){_EDGE}(ssn|social|security|taxpayer|tin)",
    "routing": rf"(?i){_EDGE}(routing|aba|rtn|bank|transit)",
}
_PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "key": 0.8, "secret": 0.4, "national": 0.4, "routing": 0.35}
_LIFT = 0.2
#: What an added kind needs: the prior itself, or a lower one with its context.
LEAST_SCORE = 0.5
_NEAR = 40
_BLOCK = 256
SPAN = "struct<start:bigint,kind_no:int,end:bigint,kind:string,value:string,score:double>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _mod97(value: Column) -> Column:
    bare = F.regexp_replace(value, " ", "")
    chars = F.split(F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4))), "")
    step = lambda acc, c: F.when(c.rlike("[0-9]"), acc * 10 + F.ascii(c) - 48).otherwise(
        F.when(c == "", acc).otherwise(acc * 100 + F.ascii(c) - 55)) % 97
    return F.aggregate(chars, F.lit(0), step)


def _weighted(value: Column) -> Column:
    """The digits times 3, 7, 1, 3, 7, 1 and so on, summed."""
    weights = F.array(*(F.lit(w) for w in (3, 7, 1) * 3))
    products = F.zip_with(F.split(value, ""), weights, lambda c, w: (F.ascii(c) - 48) * w)
    return F.aggregate(F.slice(products, F.lit(1), F.lit(9)), F.lit(0), lambda acc, x: acc + x)


_CHECK: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"),
    "card": lambda v: F.length(_digits(v)).between(14, 19) & F.call_function("luhn_check", _digits(v)),
    "phone": lambda v: F.length(_digits(v)).between(10, 15),
    "iban": lambda v: F.length(F.regexp_replace(v, " ", "")).between(15, 34) & (_mod97(v) == 1),
    "key": lambda v: F.lit(True),
    "secret": lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(v, ""))) >= 8),
    "national": lambda v: v.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"),
    "routing": lambda v: (v != "000000000") & (_weighted(v) % 10 == 0),
}


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _offsets(step: Column, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``body`` with a function: the sum of the first i elements of ``step``."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(step) - 1) / _BLOCK).cast("int")),
                         lambda b: _sum(F.slice(step, b * _BLOCK + 1, F.lit(_BLOCK))))
    def before(totals: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.size(totals) - 1),
                           lambda b: _sum(F.slice(totals, F.lit(1), b)))
        return _let(sums, lambda off: body(lambda i: F.get(off, F.floor(i / _BLOCK).cast("int")) + _sum(
            F.slice(step, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK))))
    return _let(blocks, before)


def spans_of(text: Column, kind: str) -> Column:
    """Array of the spans of one kind, in order."""
    pattern, none = _PATTERNS[kind], F.array().cast(f"array<{SPAN}>")

    def place(found: Column, pieces: Column) -> Column:
        step = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found,
                          lambda p, m: (F.length(p) + F.length(m)).cast("long"))

        def span(upto, i):
            value = F.get(found, i)
            around = F.concat_ws(" ", F.right(F.get(pieces, i), F.lit(_NEAR)), F.left(F.get(pieces, i + 1), F.lit(_NEAR)))
            score = F.least(F.lit(1.0), F.lit(_PRIOR[kind]) + F.when(around.rlike(_CONTEXT[kind]), _LIFT).otherwise(0.0))
            start = upto(i) + F.length(F.get(pieces, i))
            return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"),
                            (start + F.length(value)).alias("end"), F.lit(kind).alias("kind"), value.alias("value"),
                            score.alias("score"))

        return _let(step, lambda s: _offsets(s, lambda upto: F.transform(
            F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda i: _CHECK[kind](F.get(found, i))),
            lambda i: span(upto, i))))

    every = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.exists(found, _CHECK[kind]), _let(F.split(text, pattern, -1), lambda pieces: place(found, pieces))).otherwise(none))
    if kind in _HINT:
        every = F.when(F.contains(text, F.lit(_HINT[kind])), every).otherwise(none)
    return every.cast(f"array<{SPAN}>")


def find_pii(docs: DataFrame, *, text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` with ``pii``: all spans, by start and then kind.  Added kinds need
    ``least_score``; base kinds always stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = F.concat(*(spans_of(text, kind) for kind in BASE),
                     *(F.filter(spans_of(text, kind), lambda s: s["score"] >= least_score) for kind in KINDS[len(BASE):]))
    return docs.withColumn("pii", F.array_sort(found))


def _listing(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def pii_digest(docs: DataFrame) -> DataFrame:
    """The per-document report of the registered query."""
    found = find_pii(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(kind) for kind in BASE),
        F.sha2(_listing(F.filter("pii", lambda s: s["kind_no"] < len(BASE))), 256).alias("base_sha256"),
        _listing(F.col("pii")).alias("spans"), *(count(kind) for kind in KINDS[len(BASE):]))
