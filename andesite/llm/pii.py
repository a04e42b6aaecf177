"""Personal data in texts: patterns propose spans, checksums confirm them, context moves scores.

Base kinds are taken as their patterns find them, leftmost and without overlap within a kind:

email  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
ip     four dotted numbers of at most 255
card   13 to 19 digits, single blanks or hyphens between them, that pass Luhn
phone  ``+`` and 9 to 15 digits with blanks, brackets, dots and hyphens between them

A match that fails its test is dropped and the search goes on behind it.  The further kinds need
more evidence than their pattern.  A span of theirs that overlaps a base span is dropped, unless mod 97
or the fixed form of a key confirms it:

iban   two letters, two digits and a rest that pass mod 97; the longest end that passes counts, and
       the search goes on behind it, or one character after a start that fails
key    access keys and signed tokens of a fixed form, and private key blocks
secret a run of 16 to 200 characters with letters and digits, whose characters have an entropy of at
       least ``LEAST_ENTROPY`` bits, with a word of its context nearby
ssn    ``ddd-dd-dddd`` with a word of its context nearby
local  a ten-digit phone number without ``+`` with a word of its context nearby

Every span has a score: what its pattern and checksum are worth, and more if a context word of its
kind stands within ``CONTEXT`` characters on either side.  Scores never remove base spans.

Null and empty texts have no spans.  Rows are independent, so ties, repeated rows, null ids and
further columns of any name change nothing; an empty table gives an empty result.  Searches are
linear in the text: runs that could be scanned again from each of their characters are not, and
where a proposal is tried again from its next character its length is bounded.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "key", "secret", "ssn", "local")
CONTEXT = 40
# Score of the pattern with its checksum, what a context word adds, and the least score that stays.
PATTERN_SCORE = {
    "email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "key": 0.9,
    "secret": 0.4, "ssn": 0.4, "local": 0.4,
}
CONTEXT_SCORE = 0.2
LEAST_SCORE = 0.5
LEAST_ENTROPY = 3.0
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "payment", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "key": ("key", "token", "secret", "credential"),
    "secret": ("key", "token", "secret", "credential", "password", "passwd", "pwd", "bearer"),
    "ssn": ("ssn", "social security", "tax id"),
    "local": ("phone", "tel", "call", "mobile", "fax"),
}
NEARBY = {
    kind: re.compile(r"(?<![a-z])(?:" + "|".join(map(re.escape, words)) + r")", re.I)
    for kind, words in CONTEXT_WORDS.items()
}
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits does: from within the run the rest is the same.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![a-z0-9])")
KEY_MARKS = ("AKIA", "ASIA", "AIza", "eyJ", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "_live_", "_test_", "PRIVATE KEY")
KEY = re.compile(
    r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|AIza[A-Za-z0-9_-]{35}|gh[pousr]_[A-Za-z0-9]{36,250}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,250}|[prs]k_(?:live|test)_[A-Za-z0-9]{16,250}"
    r"|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)(?![A-Za-z0-9_-])"
    r"|-----BEGIN (?:[A-Z0-9]{1,20}\x20){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+"
    r"(?:-----END (?:[A-Z0-9]{1,20}\x20){0,3}PRIVATE KEY-----)?"
)
SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,200}={0,2}(?![A-Za-z0-9+/_=-])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
NOT_DIGIT = re.compile(r"[^0-9]+")

SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()),
])
ARROW_SPAN = pa.struct([
    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()),
])


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(text: str) -> bool:
    """Whether letters and digits are an account number with a right check number."""
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@`` back over the local part and on over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_PART:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _card_ok(s: str) -> bool:
    digits = NOT_DIGIT.sub("", s)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(s: str) -> bool:
    return 9 <= len(NOT_DIGIT.sub("", s)) <= 15


def _iban_end(m: re.Match) -> int | None:
    """The longest end behind a group of the match at which mod 97 holds."""
    s = m.group()
    for end in range(len(s), 14, -1):
        compact = s[:end].replace(" ", "")
        if (end == len(s) or s[end] == " ") and 15 <= len(compact) <= 34 and mod97(compact):
            return m.start() + end
    return None


def ibans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := IBAN.search(text, at):
        end = _iban_end(m)
        if end:
            yield m.start(), end
        at = end or m.start() + 1


def _secret_ok(s: str) -> bool:
    if s.isalpha() or s.isdigit() or not any(map(str.isdigit, s)) or not any(map(str.isalpha, s)):
        return False
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) >= LEAST_ENTROPY


def _apart(added: list[tuple[str, int, int]], taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The added spans that overlap none of the taken ones."""
    borders = sorted((start, end) for _, start, end in taken)
    starts = [start for start, _ in borders]
    furthest = list(accumulate((end for _, end in borders), max))
    # Of the spans that start before x ends, none may end behind the start of x.
    return [x for x in added if not (n := bisect_left(starts, x[2])) or furthest[n - 1] <= x[1]]


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """The spans of a text by kind as listed, then start; code points, end exclusive."""
    if not text:
        return []
    proposed = [("email", *e) for e in emails(text)]
    proposed += [("ip", *m.span()) for m in IP.finditer(text) if _ip_ok(m.group())]
    proposed += [("card", *m.span()) for m in CARD.finditer(text) if _card_ok(m.group())]
    if "+" in text:
        proposed += [("phone", *m.span()) for m in PHONE.finditer(text) if _phone_ok(m.group())]
    sure = [("iban", *s) for s in ibans(text)]
    if any(mark in text for mark in KEY_MARKS):
        sure += [("key", *m.span()) for m in KEY.finditer(text)]
    added = [("secret", *m.span()) for m in SECRET.finditer(text) if _secret_ok(m.group())]
    added += [("ssn", *m.span()) for m in SSN.finditer(text)]
    added += [("local", *m.span()) for m in LOCAL.finditer(text)]
    proposed += sure
    if added:
        proposed += _apart(added, proposed)
    found = []
    for kind, start, end in proposed:
        before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        near = NEARBY[kind].search(before) or NEARBY[kind].search(after)
        score = min(1.0, PATTERN_SCORE[kind] + (CONTEXT_SCORE if near else 0.0))
        if kind in BASE_KINDS or score >= LEAST_SCORE:
            found.append((kind, start, end, round(score, 2)))
    return found


def redact(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """The text with each span replaced by its kind in brackets; overlaps become one."""
    if not spans:
        return text
    parts, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def pii_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of each document, ``spans`` an array of kind, start, end and score."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("spans", T.ArrayType(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(text.as_py())]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(ARROW_SPAN))], ["doc_id", "spans"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def redact_pii(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced in ``text``; ``n_chars`` follows if it is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            at = names.index("text")
            texts = [redact(t, find_spans(t)) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    cleaned = docs.mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.char_length("text").cast(kind))


def _joined(spans):
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(text, ",")


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts and a digest of the base spans, and all spans as text with their scores."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
        for kind in BASE_KINDS
    ]
    scores = F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",")
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined("spans").alias("spans"), scores.alias("scores"),
    )
