"""Personal data: patterns propose spans, checksums confirm, context words move the score.

Kinds and what confirms them:

* ``email``, ``ip``, ``card``, ``phone``: the base scan, always reported.  Cards pass
  Luhn, address parts are at most 255, phones hold 10 to 15 digits.
* ``iban``: country code, check digits and account, confirmed by mod-97.
* ``ssn``, ``local`` (a phone number without a country code): no checksum exists, so
  the pattern alone stays below the threshold and a context word nearby decides.

score = prior of the kind + ``CHECKED`` if a checksum holds + ``CONTEXT`` if one of the
kind's words stands within ``WINDOW`` code points, at most 1.  Spans of the additional
kinds are reported from ``THRESHOLD`` on, and only where they overlap no other span of
a higher kind.

Every search is linear in the text: addresses are grown from each ``@``, runs of digits
are entered at their start only.  Null text counts as empty; empty texts and tables give
no spans.  Rows are independent, so null or repeated ids and hot sources need no care.
An input column named like an output column is replaced.
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_text

# Kinds in the order in which they are listed, base kinds first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local")

PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "ssn": 0.3, "local": 0.3}
CHECKED, CONTEXT, THRESHOLD, WINDOW = 0.4, 0.3, 0.5, 40
WORDS = {
    "email": ("mail", "contact"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "visa", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "taxpayer"),
    "local": ("phone", "call", "tel", "mobile", "fax", "whatsapp"),
}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_SEPARATORS = str.maketrans("", "", " ().+-")
_LOCAL_PART = string.ascii_letters + string.digits + "._%+-"


# context words count at word ends only: neither "hotel" nor "recall" speaks of a telephone
_WORDS = {kind: re.compile("(?<![^\\W_])(?:" + "|".join(map(re.escape, words)) + ")(?![^\\W_])") for kind, words in WORDS.items()}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: first four characters to the end, letters as 10..35, remainder 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at, since = 0, text.find("@"), 0
    while at >= 0:
        since = max(since, done)
        start = since + len(text[since:at].rstrip(_LOCAL_PART))
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        since, at = at + 1, text.find("@", max(at + 1, done))


def _digits(span: str) -> str:
    return span.translate(_SEPARATORS)


def _near(lower: str, start: int, end: int, kind: str) -> bool:
    around = lower[max(0, start - WINDOW):start] + " " + lower[end:end + WINDOW]
    return _WORDS[kind].search(around) is not None


def find_pii(text: str) -> list[tuple[int, int, int, float]]:
    """(start, kind index, end, score) by start, then kind."""
    found: list[tuple[int, int, int, bool]] = []
    if "@" in text:
        found += [(s, 0, e, False) for s, e in _emails(text)]
    found += [(m.start(), 1, m.end(), False) for m in _IP.finditer(text)
              if all(int(p) <= 255 if len(p) < 5 else int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end(), True))
    if "+" in text:
        found += [(m.start(), 3, m.end(), False) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    n_base = len(found)
    for m in _IBAN.finditer(text):
        # a following upper-case word may have been drawn in: the longest confirmed prefix counts
        words = m[0].split(" ")
        for k in range(len(words), 0, -1):
            packed = "".join(words[:k])
            if 15 <= len(packed) <= 34 and mod97(packed):
                found.append((m.start(), 4, m.start() + len(" ".join(words[:k])), True))
                break
    found += [(m.start(), 5, m.end(), False) for m in _SSN.finditer(text)]
    found += [(m.start(), 6, m.end(), False) for m in _LOCAL.finditer(text)]
    if not found:
        return []
    lower = text.lower()
    lower = lower if len(lower) == len(text) else text
    kept: list[tuple[int, int, int, float]] = []
    weak = []
    for i, (start, kind, end, checked) in enumerate(found):
        name = KINDS[kind]
        score = PRIOR[name] + CHECKED * checked + CONTEXT * _near(lower, start, end, name)
        (kept if i < n_base else weak).append((start, kind, end, round(min(score, 1.0), 3)))
    for kind in range(len(BASE_KINDS), len(KINDS)):
        taken = sorted((s, e) for s, _, e, _ in kept)
        starts = [s for s, _ in taken]
        reach = [0, *accumulate((e for _, e in taken), max)]
        kept += [w for w in weak if w[1] == kind and w[3] >= THRESHOLD and reach[bisect_left(starts, w[2])] <= w[0]]
    return sorted(kept)


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                 T.StructField("kind", T.StringType()), T.StructField("score", T.DoubleType())]))
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                  ("kind", pa.string()), ("score", pa.float64())]))


def scan_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``pii_spans``: array of (start, end, kind, score) in code points, end exclusive."""
    def make():
        def run(texts):
            return [pa.array([[{"start": s, "end": e, "kind": KINDS[k], "score": x} for s, k, e, x in find_pii(t or "")]
                              for t in texts], type=_SPAN_ARROW)]
        return run
    return map_text(df, text_col, [T.StructField("pii_spans", SPAN)], make)


def mask_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every found span of ``text_col`` replaced by its kind in brackets."""
    def make():
        def clean(text):
            if text is None:
                return None
            out, at = [], 0
            for start, kind, end, _ in find_pii(text):
                if end > at:
                    out += [text[at:start], f"[{KINDS[kind].upper()}]" if start >= at else ""]
                    at = end
            return "".join(out) + text[at:]
        return lambda texts: [pa.array([clean(t) for t in texts], type=pa.string())]
    columns = df.columns
    return map_text(df, text_col, [T.StructField(text_col, T.StringType())], make).select(*columns)


def pii_report(df: DataFrame) -> DataFrame:
    """Digest columns of the scan, one row per input row."""
    counts = [f"n_{k}" for k in BASE_KINDS]
    fields = ([T.StructField(c, T.LongType()) for c in counts]
              + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                 T.StructField("min_score", T.DoubleType())])

    def make():
        names = [f"{k}:" for k in KINDS]

        def run(texts):
            cols: list[list] = [[] for _ in fields]
            for text in texts:
                spans = find_pii(text or "")
                shown = [(f"{names[k]}{s}:{e}", k) for s, k, e, _ in spans]
                base = ",".join(x for x, k in shown if k < len(BASE_KINDS))
                row = [sum(k == i for _, k in shown) for i in range(len(BASE_KINDS))]
                row += [hashlib.sha256(base.encode()).hexdigest(), ",".join(x for x, _ in shown),
                        min((x for *_, x in spans), default=None)]
                for col, value in zip(cols, row):
                    col.append(value)
            return [pa.array(c, type=pa.int64()) for c in cols[:4]] + [
                pa.array(c, type=pa.string()) for c in cols[4:6]] + [pa.array(cols[6], type=pa.float64())]
        return run

    return map_text(df.select("doc_id", "text"), "text", fields, make, keep=["doc_id"])
