"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, schemes, plus signs
before digits, joined digits, and cue words for identifiers. A local parser at
each anchor expands to the left and right, validates, and yields a span, so a
text without anchors costs one pass.

``email``, ``ip``, ``card`` and ``phone`` are the leftmost non-overlapping
matches of their patterns over the whole text, validated. The anchors add
``address`` (scheme, host and the rest of a web address) and ``account`` (the
whole identifier after a cue word: letters, digits and ``_ . / + = -``, however
many; one shaped like an IBAN must pass its checksum).

Defined results: a null or empty text has no spans. Positions are code points,
ends exclusive. A text costs time in proportion to its length, whatever it holds.
Spans are ordered by start, then by kind in the order above;
spans of different kinds may overlap, and redaction replaces their union.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import common

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")
SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_BLOCK = re.compile(r"[0-9.]*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
CARD_BLOCK = re.compile(r"[0-9\x20-]*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
SCHEME_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
ADDRESS_REST = re.compile(r"[A-Za-z0-9\[][^\s<>\"']*")
IDENTIFIER = re.compile(r"[\s\"'#:=(]{1,4}(?:(?:is|number|no\.?|id)[\s\"'#:=(]{1,4})?([\w./+-][\w./+=-]{5,})")
# one with more characters of an identifier behind it is none
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?!\.*[\w/+=-])")
IBAN_START = re.compile(r"[\s\"'#:=(]{1,4}(?:(?:is|number|no\.?|id)[\s\"'#:=(]{1,4})?(?=[A-Z]{2}[0-9]{2})")
CUES = ("account", "acct", "iban", "ssn", "passport", "token", "secret", "password", "licence", "license")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    digits = "0123456789"
    anchors = {"@": "email", "://": "address"}
    anchors |= {f"+{d}": "phone" for d in digits}
    anchors |= {f"{a}.{b}": "ip" for a in digits for b in digits}
    anchors |= {f"{a}{gap}{b}": "card" for a in digits for b in digits for gap in ("", " ", "-")}
    anchors |= {form: "account" for cue in CUES for form in (cue, cue.capitalize(), cue.upper())}
    for anchor, kind in anchors.items():
        found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * (1 + place % 2)
        total += doubled - 9 * (doubled > 9)
    return total % 10 == 0


def iban(text: str) -> bool:
    compact = text.replace(" ", "")
    turned = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _left(text: str, at: int, least: int, letters: frozenset[str]) -> int:
    """The leftmost start of the run of ``letters`` that ends before ``at``."""
    while at > least and text[at - 1] in letters:
        at -= 1
    return at


def _quads(block: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping places of four dotted numbers in a run of digits and dots, in one walk."""
    found, at, place = [], 0, 0
    parts = block.split(".")
    while at + 4 <= len(parts):
        empty = next((k for k in (3, 2, 1, 0) if not parts[at + k]), None)
        step = 4 if empty is None else empty + 1
        size = sum(map(len, parts[at : at + step])) + step
        if empty is None:
            found.append((place, place + size - 1))
        at, place = at + step, place + size
    return found


DIGITS_DOT, DIGITS_GAP = frozenset("0123456789."), frozenset("0123456789 -")


def find(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of one text."""
    spans: list[tuple[str, int, int]] = []
    ends = dict.fromkeys(KINDS, 0)  # where the search of each kind goes on
    for last, (kind, size) in automaton.iter(text):
        at = last + 1 - size
        if kind == "card":
            if at < ends["card"]:
                continue
            start = _left(text, at, ends["card"], DIGITS_GAP)
            ends["card"] = end = CARD_BLOCK.match(text, at).end()
            for match in CARD.finditer(text, start, end):
                digits = NOT_DIGIT.sub("", match[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", match.start(), match.end()))
        elif kind == "ip":
            if at < ends["ip"]:
                continue
            start = _left(text, at, ends["ip"], DIGITS_DOT)
            ends["ip"] = end = IP_BLOCK.match(text, at).end()
            for first, last_end in _quads(text[start:end]):
                parts = [part.lstrip("0") for part in text[start + first : start + last_end].split(".")]
                if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
                    spans.append(("ip", start + first, start + last_end))
        elif kind == "email":
            start = _left(text, at, ends["email"], LOCAL_PART)
            domain = DOMAIN.match(text, at + 1)
            if start < at and domain:
                ends["email"] = domain.end()
                spans.append(("email", start, domain.end()))
        elif kind == "phone":
            match = PHONE.match(text, at)
            if match and 10 <= len(NOT_DIGIT.sub("", match[0])) <= 15:
                spans.append(("phone", at, match.end()))
        elif kind == "address":
            if at < ends["address"]:
                continue
            start = _left(text, at, ends["address"], SCHEME_LETTERS)
            rest = ADDRESS_REST.match(text, at + size)
            if start < at and text[start].isalpha() and rest:
                end = start + len(text[start : rest.end()].rstrip(".,;:!?)"))
                ends["address"] = rest.end()
                spans.append(("address", start, end))
        elif at >= ends["account"] and not (at and text[at - 1].isalnum()):
            lead = IBAN_START.match(text, last + 1)
            shaped = IBAN.match(text, lead.end()) if lead else None
            match = shaped or IDENTIFIER.match(text, last + 1)
            if match:
                if not shaped:  # a cue inside an identifier starts no other one
                    ends["account"] = match.end()
                start, end = shaped.span() if shaped else match.span(1)
                if not shaped:
                    end = start + len(text[start:end].rstrip("."))
                if end - start >= 6 and (iban(shaped[0]) if shaped else sum(map(str.isdigit, text[start:end])) >= 4):
                    spans.append(("account", start, end))
    spans.sort(key=lambda span: (span[1], KINDS.index(span[0])))
    return spans


@F.arrow_udf(SPANS)
def _spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    automaton = _automaton()
    names = [pa.field("kind", pa.string()), pa.field("start", pa.int32()), pa.field("end", pa.int32())]
    for batch in batches:
        kinds, starts, ends, offsets = [], [], [], [0]
        for text in batch:
            for kind, start, end in find(text.as_py() or "", automaton):
                kinds.append(kind)
                starts.append(start)
                ends.append(end)
            offsets.append(len(kinds))
        values = pa.StructArray.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], fields=names
        )
        yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def spans(text: str | Column = "text") -> Column:
    """The spans of a text column, as an array of (kind, start, end)."""
    return _spans(F.col(text) if isinstance(text, str) else text)


def redact(text: str, found: str) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, of the first's kind."""
    step = (
        "named_struct('at', greatest(acc.at, s.end), 'out', if(s.start >= acc.at,"
        " concat(acc.out, substring(t, acc.at + 1, s.start - acc.at), '[', s.kind, ']'), acc.out))"
    )
    return F.expr(
        f"transform(array(coalesce({text}, '')), t -> aggregate({found}, named_struct('at', 0, 'out', ''),"
        f" (acc, s) -> {step}, acc -> concat(acc.out, substring(t, acc.at + 1))))[0]"
    )


def op1_personal(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts, digest of the base spans, all spans."""
    documents = common.table(spark, folder, "documents")
    found = documents.select("doc_id", spans("text").alias("s"))

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("s", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *map(number, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))
