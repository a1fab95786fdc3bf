"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Everything is built from SQL functions; no Python runs on the executors.

Pattern notes.  A regular-expression loop over a *group* recurses in the JVM and
overflows its stack on very long runs, and a loop that can start anywhere in a
run costs its square.  The patterns below match exactly the same text as the
plain definitions in ``DEFINITIONS`` with single-character loops only: before
matching, separators that continue a run are replaced by a marker character of
the same length, so that offsets do not move.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbiscope.llm.common import let

# The kinds in their order and the plain definitions they follow.
BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn", "phone_local")
DEFINITIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Words that raise or lower the score of a span near them, and the starting scores.
CONTEXT_UP = {
    "email": r"\b(e-?mail|contact|write|mailto|address)\b",
    "ip": r"\b(ip|host|server|address|login|client)\b",
    "card": r"\b(card|visa|mastercard|amex|credit|debit|pay|payment|cvv)\b",
    "phone": r"\b(tel|phone|call|fax|mobile|cell|whatsapp)\b",
    "iban": r"\b(iban|bank|account|konto|bic|swift)\b",
    "ssn": r"\b(ssn|social security|taxpayer)\b",
    "phone_local": r"\b(tel|phone|call|fax|mobile|cell|whatsapp)\b",
}
CONTEXT_DOWN = {
    "email": r"\b(example|noreply)\b",
    "ip": r"\b(version|release|section|chapter)\b",
    "card": r"\b(order|invoice|tracking|serial|isbn)\b",
    "phone": r"\b(order|invoice|serial|isbn)\b",
    "iban": r"\b(serial|part number)\b",
    "ssn": r"\b(order|invoice|serial|part number)\b",
    "phone_local": r"\b(order|invoice|serial|isbn)\b",
}
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "phone_local": 0.4}
SCORE_STEP = 0.2
CONTEXT_CHARS = 48
MARK = "\u0001"


#: Running totals are taken in levels of this many (a power of two).
RUN = 32
RUN_BITS = 5
#: Code points of a piece of a text (a power of two): what is cut out of a text comes from its pieces.
PIECE = 128
PIECE_BITS = 7


def running(array: Column, join: Callable[[Column, Column], Column], zero: Column) -> Column:
    """The running totals of an array that is not empty, each with its own value.

    Totals of RUN values and of RUN * RUN values are taken first, so an element
    costs a few RUN steps however long the array is (up to many millions).
    """

    def fold(of: Column, start: Column, end: Column) -> Column:
        return F.aggregate(F.slice(of, start + 1, end - start), zero, join)

    def totals(of: Column) -> Column:
        last = F.shiftright(F.size(of) - 1, RUN_BITS)
        return F.transform(F.sequence(F.lit(0), last), lambda b: fold(of, b * RUN, (b + 1) * RUN))

    def before(i: Column) -> Column:
        return i - i % RUN

    def joined(values: Column, small: Column, large: Column) -> Column:
        heads = F.transform(large, lambda _, b: fold(large, F.lit(0), b))

        def elements(tops: Column) -> Column:
            starts = F.transform(small, lambda _, b: join(tops[F.shiftright(b, RUN_BITS)], fold(small, before(b), b)))
            return let(
                starts,
                lambda begun: F.transform(
                    values, lambda _, i: join(begun[F.shiftright(i, RUN_BITS)], fold(values, before(i), i + 1))
                ),
            )

        return let(heads, elements)

    return let(
        array,
        lambda values: let(totals(values), lambda small: let(totals(small), lambda large: joined(values, small, large))),
    )


def pieces(text: Column) -> Column:
    """The text in pieces of PIECE code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(of: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text given in pieces; costs the length of what is cut out."""
    first = F.shiftright(start, PIECE_BITS)
    part = F.array_join(F.slice(of, first + 1, F.shiftright(end, PIECE_BITS) - first + 1), "")
    return F.substring(part, start % PIECE + 1, end - start)


def _proposals(text: Column, pattern: str) -> Column:
    """All leftmost matches of ``pattern`` as array<struct<start, end, value>>, in code points.

    Offsets are the running totals of the lengths of the matches and of the gaps between them.
    """

    def spans(found: Column) -> Column:
        steps = let(
            F.split(text, pattern, -1),
            lambda gaps: F.transform(
                found,
                lambda _, i: F.char_length(gaps[i]) + F.when(i > 0, F.char_length(found[i - 1])).otherwise(F.lit(0)),
            ),
        )

        def located(starts: Column) -> Column:
            return F.transform(
                found,
                lambda m, i: F.struct(starts[i].alias("start"), (starts[i] + F.char_length(m)).alias("end"), m.alias("value")),
            )

        return let(running(steps, lambda x, y: x + y, F.lit(0)), located)

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) > 0, spans(found)).otherwise(none),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _digit(text: Column, i: Column) -> Column:
    return F.ascii(F.substring(text, i, F.lit(1))) - 48


def luhn_valid(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    return let(
        digits,
        lambda d: F.aggregate(
            F.sequence(F.lit(1), F.char_length(d)),
            F.lit(0),
            lambda acc, i: acc
            + let(
                _digit(d, F.char_length(d) - i + 1) * F.when(i % 2 == 0, 2).otherwise(1),
                lambda v: v - F.when(v > 9, 9).otherwise(0),
            ),
        )
        % 10
        == 0,
    )


def mod97_valid(value: Column) -> Column:
    """Whether an account number without separators has remainder 1 modulo 97 (first four characters last)."""
    return let(
        F.concat(F.substring(value, F.lit(5), F.char_length(value)), F.substring(value, 1, 4)),
        lambda s: F.aggregate(
            F.sequence(F.lit(1), F.char_length(s)),
            F.lit(0),
            lambda acc, i: let(
                F.ascii(F.substring(s, i, F.lit(1))),
                lambda c: F.when(c < 58, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97),
            ),
        )
        == 1,
    )


def _parts_within_255(value: Column) -> Column:
    return F.forall(
        F.split(value, r"\."),
        lambda p: let(
            F.regexp_replace(p, "^0+", ""),
            lambda q: (F.char_length(q) < 3) | ((F.char_length(q) == 3) & (q <= F.lit("255"))),
        ),
    )


def _valid(spans: Column, test) -> Column:
    return F.filter(spans, lambda s: test(s["value"]))


def _emails(text: Column) -> Column:
    # a dot between two label characters becomes the mark; the domain is then one run of characters
    marked = F.regexp_replace(F.translate(text, MARK, "#"), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", MARK)
    local = rf"A-Za-z0-9._%+{MARK}-"
    pattern = rf"(?:(?<![{local}])|\G)[{local}]++@[A-Za-z0-9-]++{MARK}[A-Za-z0-9{MARK}-]++"
    return F.when(F.contains(text, F.lit("@")), let(marked, lambda t: _proposals(t, pattern)))


def _ips(text: Column) -> Column:
    pattern = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
    return F.when(text.rlike(r"[0-9]\.[0-9]"), _valid(_proposals(text, pattern), _parts_within_255))


def _cards(text: Column) -> Column:
    marked = F.regexp_replace(F.translate(text, MARK, "#"), r"(?<=[0-9])[\x20-](?=[0-9])", MARK)
    pattern = rf"[0-9][0-9{MARK}]*[0-9]"

    def test(value: Column) -> Column:
        return let(_digits(value), lambda d: F.char_length(d).between(14, 19) & luhn_valid(d))

    found = let(marked, lambda t: _valid(_proposals(t, pattern), test))
    return F.when(text.rlike(r"(?:[0-9][\x20-]?){13}[0-9]"), found)


def _phones(text: Column) -> Column:
    def test(value: Column) -> Column:
        return F.char_length(_digits(value)).between(10, 15)

    return F.when(text.rlike(r"\+[0-9]"), _valid(_proposals(text, r"\+[0-9][\x20().0-9-]+[0-9]"), test))


def _ibans(text: Column) -> Column:
    pattern = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"

    def test(value: Column) -> Column:
        return let(F.replace(value, F.lit(" "), F.lit("")), lambda v: F.char_length(v).between(15, 34) & mod97_valid(v))

    return F.when(text.rlike(r"[A-Z]{2}[0-9]{2}"), _valid(_proposals(text, pattern), test))


def _ssns(text: Column) -> Column:
    pattern = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
    return F.when(text.rlike(r"[0-9]-[0-9]{2}-[0-9]"), _proposals(text, pattern))


def _local_phones(text: Column) -> Column:
    pattern = r"(?<![0-9+(.-])(?<!\+[0-9]{1,3}[\x20-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20-])[0-9]{3}-[0-9]{4}(?![0-9-])"
    return F.when(text.rlike(r"[0-9]{3}-[0-9]{4}"), _proposals(text, pattern))


FINDERS = {
    "email": _emails,
    "ip": _ips,
    "card": _cards,
    "phone": _phones,
    "iban": _ibans,
    "ssn": _ssns,
    "phone_local": _local_phones,
}


KINDS = (*BASE_KINDS, *EXTRA_KINDS)
SPANS = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _named(spans: Column, order: int) -> Column:
    """The spans of a kind without their values, empty where there are none."""
    named = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("ord"), s["end"].alias("end"), F.lit(KINDS[order]).alias("kind")
        ),
    )
    return F.coalesce(named, F.array().cast(SPANS))


def _score(near: Column, order: Column) -> Column:
    """A span's score from its kind and the lower-cased words near it."""

    def of(kind: str) -> Column:
        return (
            F.lit(START_SCORE[kind])
            + F.when(near.rlike(CONTEXT_UP[kind]), SCORE_STEP).otherwise(0.0)
            - F.when(near.rlike(CONTEXT_DOWN[kind]), SCORE_STEP).otherwise(0.0)
        )

    score = F.when(order == 0, of(KINDS[0]))
    for k, kind in enumerate(KINDS[1:], 1):
        score = score.when(order == k, of(kind))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def _scored(text: Column, spans: Column) -> Column:
    """The spans with a score from the words within CONTEXT_CHARS on either side."""

    def one(of: Column, s: Column) -> Column:
        near = F.lower(
            F.concat(
                between(of, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["start"]),
                F.lit(" "),
                between(of, s["end"], s["end"] + CONTEXT_CHARS),
            )
        )
        return F.struct(
            s["start"].alias("start"),
            s["ord"].alias("ord"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            let(near, lambda n: _score(n, s["ord"])).alias("score"),
        )

    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string,score:double>>")
    return F.when(F.size(spans) > 0, let(pieces(text), lambda of: F.transform(spans, lambda s: one(of, s)))).otherwise(none)


def pii_spans(text: Column, min_score: float = 0.5) -> Column:
    """array<struct<start, ord, end, kind, score>> of personal data in ``text``, by start, then kind.

    Base kinds (email, ip, card, phone) are kept whatever their score; the added
    kinds (iban, ssn, phone_local) need ``min_score``.  Spans of different kinds
    may overlap.  Null text counts as empty and gives an empty array.
    """

    def of(t: Column) -> Column:
        found = F.concat(*(_named(FINDERS[kind](t), order) for order, kind in enumerate(KINDS)))
        scored = let(found, lambda spans: _scored(t, spans))
        return F.array_sort(F.filter(scored, lambda s: (s["ord"] < len(BASE_KINDS)) | (s["score"] >= min_score)))

    return let(F.coalesce(text, F.lit("")), of)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """One row (``id_col``, ``found``) per input row; ``found`` is the array of ``pii_spans``.

    Null or empty text: an empty array.  Repeated rows and null ids: one result
    row each.  Texts are scanned whole.  Map-side only, no shuffle.
    """
    return docs.select(F.col(id_col), pii_spans(F.col(text_col), min_score).alias("found"))


def span_digest(found: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined ('' for none)."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask_pii(docs: DataFrame, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """``docs`` with every span of its text replaced by ``<KIND>``.

    Overlapping spans are merged and carry the first one's kind.  A text without
    spans, an empty one and a null stay as they are; all other columns too.
    """

    def masked(text: Column, spans: Column) -> Column:
        def joined(ends: Column, of: Column) -> Column:
            # ends[i] is where the spans up to the i-th end; a span that begins before that is part of an earlier one
            def piece(s: Column, i: Column) -> Column:
                past = F.when(i > 0, ends[i - 1]).otherwise(F.lit(0))
                sign = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
                return F.when((i > 0) & (s["start"] < past), F.lit("")).otherwise(
                    F.concat(between(of, past, s["start"]), sign)
                )

            tail = between(of, F.element_at(ends, -1), F.char_length(text))
            return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

        ends = running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y), F.lit(0))
        return let(ends, lambda e: let(pieces(text), lambda of: joined(e, of)))

    text = F.col(text_col)
    new = let(
        pii_spans(text, min_score),
        lambda found: F.when(F.size(found) > 0, masked(text, found)).otherwise(text),
    )
    return docs.withColumn(text_col, new)


def digest_query(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of the base spans, and all spans."""
    found = find_pii(docs)
    base = F.filter(F.col("found"), lambda s: s["ord"] < len(BASE_KINDS))

    def count(order: int) -> Column:
        return F.size(F.filter(F.col("found"), lambda s: s["ord"] == order)).cast("long")

    counts = [count(order).alias(f"n_{kind}") for order, kind in enumerate(BASE_KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(span_digest(base), 256).alias("base_sha256"),
        span_digest(F.col("found")).alias("spans"),
        F.array_join(F.transform(F.col("found"), lambda s: F.format_string("%.1f", s["score"])), ",").alias("scores"),
    )
