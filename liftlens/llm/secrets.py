"""Secret scan with multipart credential linking (DataFrame functions only).

Strong spans are reported wherever they occur:

* ``assign``  a keyword (password, token, ...), ``:`` or ``=``, a value of 6+ characters
* ``access``  ``AKIA`` identifiers of 20+ characters
* ``hex``     lower-case hexadecimal runs of 24+ characters

Weak candidates are reported only when the parts that complete a credential lie
in their scope (same document, at most ``scope`` code points away):

* ``user``      a named identifier: needs a secret (assign, hex or opaque)
* ``opaque``    a mixed-case token of 32+ characters: needs an identifier or endpoint
* ``endpoint``  a service URL: needs an identifier and a secret

The same text is never both parts: what overlaps an ``opaque`` token does not complete it,
nor does such a token complete the ``user`` whose value it is.  A token inside a URL (the
path of a link) needs an identifier; further links around it do not count.

Spans are found by ``split``: the pieces between matches and the matches
themselves give every offset through one prefix sum.  The interval join of
candidates with parts is a sort and a running maximum inside the row, so it
neither shuffles nor emits pairs, and a document with very many parts costs
n log n.  Nothing is keyed by ``doc_id``: null, repeated or hot ids need no care.

Null text counts as empty.  Empty text and empty tables give no spans.  An input
column named like an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scan, set_aside

# Fixed values (contract of the base scan), in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Weak candidates of the linking step.  A name inside a longer word is dropped like any failing match;
# what an underscore joins to it (DB_USER) is part of the name.
USER = (r"""(?i:user(?:name)?|login|account|client_?id|access_?key_?id)"""
        r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""")
OPAQUE = r"[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = r"(?i:https?|ftp|s3|jdbc|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9][^\x00-\x20\"'<>]{3,}"

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "user", "opaque", "endpoint")
SCOPE = 200
MASK = "[SECRET]"

_SPAN = "array<struct<start:bigint,end:bigint,kind:int>>"


def _no_spans() -> Column:
    return F.array().cast(_SPAN)


def find_spans(text: Column, pattern: str, kind: int, accept=None, ahead=None) -> Column:
    """Leftmost non-overlapping matches as (start, end, kind) in code points, end exclusive.

    ``accept`` decides on a match and the text between it and the match before; refused
    matches are dropped, not retried.  ``ahead`` tells how many code points at the end of
    that text belong to the span.
    """
    rx = F.lit(pattern)
    matches = F.regexp_extract_all(text, rx, F.lit(0))
    pieces = F.split(text, pattern, -1)
    widths = F.zip_with(matches, F.slice(pieces, 1, F.size(matches)),
                        lambda m, p: (F.length(m) + F.length(p)).cast("bigint"))
    ends = scan(widths, lambda a, b: a + b, F.lit(0).cast("bigint"))
    both = F.arrays_zip(ends.alias("end"), matches.alias("m"), pieces.alias("p"))
    both = F.slice(both, 1, F.size(matches))
    if accept is not None:
        both = F.filter(both, lambda x: accept(x["m"], x["p"]))
    spans = F.transform(both, lambda x: F.struct(
        (x["end"] - F.length(x["m"]) - (ahead(x["p"]) if ahead else 0)).alias("start"), x["end"].alias("end"),
        F.lit(kind).alias("kind")))
    # most documents hold no match at all: one search decides
    return F.when(text.rlike(pattern), spans.cast(_SPAN)).otherwise(_no_spans())


_MARKED = "array<struct<start:bigint,end:bigint,kind:int,hit:boolean>>"


def _marked(spans: Column, hit: bool = False) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.lit(hit).alias("hit"))).cast(_MARKED)


def _hits(marked: Column, hit: bool = True) -> Column:
    chosen = F.filter(marked, lambda x: x["hit"] if hit else ~x["hit"])
    return F.transform(chosen, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))).cast(_SPAN)


def _meet(marked: Column, parts: Column, at, need, part_at, reach) -> Column:
    """Marks candidates for which a part with ``part_at(part) <= at(c)`` has ``reach(part) >= need(c)``.

    With both sorted by that left side, the largest reach so far decides.
    """
    side = "array<struct<at:bigint,query:int,reach:bigint,start:bigint,end:bigint,kind:int,hit:boolean>>"
    none = F.lit(-2 ** 62).cast("bigint")

    def event(x: Column, at: Column, query: int, reach: Column, hit: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(query).alias("query"), reach.alias("reach"), x["start"].alias("start"),
                        x["end"].alias("end"), x["kind"].alias("kind"), hit.alias("hit"))
    right = F.transform(parts, lambda p: event(p, part_at(p), 0, reach(p), F.lit(False))).cast(side)
    left = F.transform(marked, lambda c: event(c, at(c), 1, none, c["hit"])).cast(side)
    events = F.array_sort(F.concat(right, left))
    best = scan(F.transform(events, lambda e: e["reach"]), lambda a, b: F.greatest(a, b), none)
    joined = F.filter(F.zip_with(events, best, lambda e, r: F.struct(e.alias("e"), r.alias("r"))),
                      lambda x: x["e"]["query"] == 1)
    out = F.transform(joined, lambda x: F.struct(
        x["e"]["start"].alias("start"), x["e"]["end"].alias("end"), x["e"]["kind"].alias("kind"),
        (x["e"]["hit"] | (x["r"] >= need(x["e"]))).alias("hit")))
    return F.when((F.size(marked) > 0) & (F.size(parts) > 0), out.cast(_MARKED)).otherwise(marked)


def _near(marked: Column, parts: Column, scope: int) -> Column:
    """Marks candidates that have a part at most ``scope`` code points away."""
    return _meet(marked, parts, lambda c: c["end"] + scope, lambda c: c["start"] - scope,
                 lambda p: p["start"], lambda p: p["end"])


def _overlapped(marked: Column, parts: Column) -> Column:
    """Marks candidates that share text with a part."""
    return _near(marked, parts, -1)


def _after(marked: Column, parts: Column, scope: int) -> Column:
    """Marks candidates that stand at most ``scope`` code points after the end of a part."""
    return _meet(marked, parts, lambda c: c["start"], lambda c: c["start"] - scope,
                 lambda p: p["end"], lambda p: p["end"])


def _before(marked: Column, parts: Column, scope: int) -> Column:
    """Marks candidates that end at most ``scope`` code points before a part."""
    return _meet(marked, parts, lambda c: -c["end"], lambda c: -c["end"] - scope,
                 lambda p: -p["start"], lambda p: -p["start"])


def in_scope(candidates: Column, parts: Column, scope: int) -> Column:
    """Candidates that have a part at most ``scope`` code points away."""
    return _hits(_near(_marked(candidates), parts, scope))


def _mixed(m: Column, before: Column) -> Column:
    return m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")


def _prefix(before: Column) -> Column:
    """Length of the part of a name that an underscore joins to what follows."""
    return F.length(F.regexp_extract(F.reverse(before), "^(?:_[A-Za-z0-9_]*)?", 0))


def scan_secrets(df: DataFrame, text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """``df`` with ``secret_spans``: array of (start, end, kind), by start, then kind as in ``KINDS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    steps = ("ids", "keys", "u", "o", "e", "e2")
    mine = [f"__secret_{k}" for k in (*KINDS, *steps)]
    k = dict(zip((*KINDS, *steps), mine))
    out = df.select(
        *[c for c in df.columns if c not in mine],
        find_spans(text, ASSIGN, 0, 
                   lambda m, _: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_VALUE).alias(k["assign"]),
        # in a run of one class the minimal length can stand in the pattern itself
        find_spans(text, ACCESS[:-1] + f"{{{MIN_ACCESS - 4},}}", 1).alias(k["access"]),
        find_spans(text, HEX[:-1] + f"{{{MIN_HEX},}}", 2).alias(k["hex"]),
        find_spans(text, USER, 3, lambda _, before: ~F.right(before, F.lit(1)).rlike("[A-Za-z0-9]"),
                   _prefix).alias(k["user"]),
        find_spans(text, OPAQUE, 4, _mixed).alias(k["opaque"]),
        find_spans(text, ENDPOINT, 5).alias(k["endpoint"]))
    out = out.withColumns({k["ids"]: F.concat(k["access"], k["user"]),
                           k["keys"]: F.concat(k["assign"], k["hex"], k["opaque"])})
    c = {x: F.col(name) for x, name in k.items()}
    out = out.withColumns({k["u"]: _near(_marked(c["user"]), F.concat(c["assign"], c["hex"]), scope),
                           k["o"]: _overlapped(_marked(c["opaque"]), c["endpoint"]),
                           k["e"]: in_scope(c["endpoint"], c["ids"], scope)})
    # a token outside every URL overlaps no endpoint
    out = out.withColumns({k["u"]: _after(c["u"], c["opaque"], scope),
                           k["o"]: F.concat(_marked(_hits(c["o"])),
                                            _near(_marked(_hits(c["o"], False)), c["endpoint"], scope)),
                           k["e2"]: in_scope(c["e"], c["keys"], scope)})
    out = out.withColumns({k["u"]: _before(c["u"], c["opaque"], scope), k["o"]: _after(c["o"], c["ids"], scope)})
    out = out.withColumn(k["o"], _before(c["o"], c["ids"], scope))
    linked = F.concat(_hits(c["u"]), _hits(c["o"]), c["e2"])
    spans = F.array_sort(F.concat(k["assign"], k["access"], k["hex"], linked),
                         lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int"))
                         .otherwise(a["kind"] - b["kind"]))
    return out.withColumn("secret_spans", spans).drop(*mine)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(x) for x in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(df: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Digest columns of the scan, one row per input row."""
    found = scan_secrets(df.select("doc_id", "text"), scope=scope).drop("text")

    def count(kind: int) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("secret_spans", lambda s: s["kind"] < len(BASE_KINDS))
    return found.select(
        "doc_id", *[count(i).alias(f"n_{name}") for i, name in enumerate(BASE_KINDS)],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secret_spans")).alias("spans"),
        F.size(F.filter("secret_spans", lambda s: s["kind"] >= len(BASE_KINDS))).cast("bigint").alias("n_linked"))


def redact_secrets(df: DataFrame, text_col: str = "text", scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """``df`` with every found span of ``text_col`` replaced by ``mask`` (overlapping spans by one).

    Rows without spans keep their text, null included.
    """
    plain, restore = set_aside(df, ("secret_spans",))
    found = scan_secrets(plain, text_col, scope)
    spans = F.col("secret_spans")
    reach = scan(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), F.lit(0).cast("bigint"))
    before = F.slice(F.concat(F.array(F.lit(-1).cast("bigint")), F.col("__secret_reach")), 1, F.size(spans))
    found = found.withColumn("__secret_reach", reach)
    # a merged span starts where nothing before reaches, and its predecessor's reach is an end
    joined = F.zip_with(spans, before, lambda s, r: F.struct(s["start"].alias("start"), r.alias("r")))
    first = F.filter(joined, lambda x: x["start"] > x["r"])
    starts = F.transform(first, lambda x: x["start"])
    ends = F.concat(F.slice(F.transform(first, lambda x: x["r"]), 2, F.greatest(F.size(first) - 1, F.lit(0))),
                    F.slice(F.col("__secret_reach"), -1, 1))
    found = found.withColumns({"__secret_starts": starts, "__secret_ends": ends})
    text, one = F.col(text_col), F.lit(1).cast("bigint")
    gaps = F.zip_with(F.concat(F.array(F.lit(0).cast("bigint")), F.col("__secret_ends")),
                      F.concat(F.col("__secret_starts"), F.array(F.length(text).cast("bigint"))),
                      lambda a, b: F.substring(text, (a + one).cast("int"), (b - a).cast("int")))
    clean = F.when(F.size(spans) > 0, F.array_join(gaps, mask)).otherwise(text)
    return restore(found.withColumn(text_col, clean))
