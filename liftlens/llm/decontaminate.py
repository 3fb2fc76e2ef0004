"""Benchmark decontamination: a broadcast set of benchmark n-grams against token windows.

Texts are normalised (A-Z lower-cased; a word is a run of ASCII letters, digits and
characters beyond ASCII).  A benchmark item gives its windows of ``window`` words; an
item of fewer words, but not none, is one window of its own length.  A document word
inside any occurrence of any window is hit.

The set goes out in blocks of at most ``block_words`` benchmark words, so what is
broadcast is bounded by that parameter whatever the benchmark's size; with several
blocks the documents are scanned once per block and written in between.  Words are
mapped to numbers exactly and a window is compared in full, so there are no false hits.

Null text has no words, and neither has empty text; an item without words hits nothing.
Null item ids hit words but name no item.  Items with the same id count once.  An empty
benchmark leaves every document clean.  Rows are independent: null, repeated or hot
document ids need no care.  An input column named like an output column is replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import map_text, set_aside

WINDOW = 10
BLOCK_WORDS = 2_000_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """Normalised words (UTF-8); bytes.lower() touches ASCII only."""
    return _WORD.findall((text or "").encode().lower())


class WindowSet:
    """The windows of one block of items, looked up by word numbers."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.word_no: dict[bytes, int] = {}
        self.ids: list[str | None] = []
        self.by_length: dict[int, dict[bytes, list[int]]] = {}
        for item_id, text in items:
            tokens = words(text)
            if not tokens:
                continue
            numbers = np.array([self.word_no.setdefault(w, len(self.word_no) + 1) for w in tokens], np.int32)
            length = min(window, len(tokens))
            table = self.by_length.setdefault(length, {})
            for i in range(len(tokens) - length + 1):
                holders = table.setdefault(numbers[i:i + length].tobytes(), [])
                if not holders or holders[-1] != len(self.ids):
                    holders.append(len(self.ids))
            self.ids.append(item_id)

    def hits(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged [start, end) word ranges that are hit, and the ids of the items found."""
        get = self.word_no.get
        numbers = np.array([get(w, 0) for w in tokens], np.int32)
        known = np.concatenate([[0], np.cumsum(numbers > 0)])
        ranges, found = [], set()
        for length, table in self.by_length.items():
            if len(tokens) < length:
                continue
            for i in np.flatnonzero(known[length:] - known[:-length] == length).tolist():
                holders = table.get(numbers[i:i + length].tobytes())
                if holders:
                    ranges.append((i, i + length))
                    found.update(self.ids[h] for h in holders if self.ids[h] is not None)
        return merge(ranges), found


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_RANGES = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_RANGES_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
HIT_COLUMNS = ("n_words", "hit_ranges", "hit_items")


def find_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_ranges`` (merged word ranges) and ``hit_items`` (sorted ids)."""
    spark = docs.sparkSession
    # copies of a row have one hash, so only distinct rows keep a block to its size
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    # a word and its separator take two characters at least
    n_words = items.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    n_blocks = int(n_words // block_words) + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("__ranges", _RANGES),
              T.StructField("__items", T.ArrayType(T.StringType()))]
    plain = [c for c in docs.columns if c not in ("__ranges", "__items", "__ranges_0", "__items_0", *HIT_COLUMNS)]
    state = docs.select(*plain)
    for b in range(n_blocks):
        rows = [(r.item_id, r.text) for r in items.where(block == b).collect()]
        shared = spark.sparkContext.broadcast(rows)

        def make(shared=shared):
            known = WindowSet(shared.value, window)

            def run(texts):
                out = [(len(t := words(x)), *known.hits(t)) for x in texts]
                return [pa.array([x[0] for x in out], type=pa.int64()),
                        pa.array([[{"start": s, "end": e} for s, e in x[1]] for x in out], type=_RANGES_ARROW),
                        pa.array([sorted(x[2]) for x in out], type=pa.list_(pa.string()))]
            return run

        state = map_text(state, text_col, fields, make)
        if b:
            state = state.withColumns({"__ranges": F.concat("__ranges_0", "__ranges"),
                                       "__items": F.concat("__items_0", "__items")}).drop("__ranges_0", "__items_0")
        if b + 1 < n_blocks:
            state = materialize(state.withColumnsRenamed({"__ranges": "__ranges_0", "__items": "__items_0"}),
                                "decontaminate")
    ranges = F.array_sort("__ranges")
    return state.withColumns({
        "hit_ranges": _merged(ranges) if n_blocks > 1 else ranges,
        "hit_items": F.array_sort(F.array_distinct("__items"))}).drop("__ranges", "__items")


def _merged(ranges):
    """Union of sorted ranges found by several blocks."""
    empty = F.array().cast(_RANGES)

    def add(acc, r):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1),
                          F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))))
        touching = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= r["start"])
        return F.when(touching, joined).otherwise(F.concat(acc, F.array(r)))
    return F.aggregate(ranges, empty, add)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "document", text_col: str = "text",
                  window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without benchmark passages; same columns.

    ``remove="document"`` drops every document with a hit; ``remove="span"`` cuts the
    hit words (with what stands between them) out of the text and keeps the document.
    """
    if remove not in ("document", "span"):
        raise ValueError("remove: document or span")
    plain, restore = set_aside(docs, (*HIT_COLUMNS, "__cut"))
    found = find_hits(plain, benchmark, text_col, window, block_words)
    if remove == "document":
        return restore(found.where(F.size("hit_ranges") == 0))
    def make():
        return lambda texts, ranges: [pa.array([_cut(x, r) for x, r in zip(texts, ranges)], type=pa.string())]
    cut = map_text(found, text_col, [T.StructField("__cut", T.StringType())], make, extra=["hit_ranges"])
    return restore(cut.withColumn(text_col, F.col("__cut")))


def _cut(text, ranges):
    if not ranges:
        return text
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.lower())]
    out, since = [], 0
    for r in ranges:
        out.append(raw[since:at[r["start"]][0]])
        since = at[r["end"] - 1][1]
    return b"".join([*out, raw[since:]]).decode()


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest columns, one row per document."""
    found = find_hits(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("hit_ranges", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
