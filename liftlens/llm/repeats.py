"""Repeated passages by looking up every window of words, by hash, in the whole corpus.

The reference of a document is everything before it: all windows of ``WINDOW`` words that
start earlier, in order of (doc_id, start).  This stands in for a greedy relative Lempel-Ziv
parse: no factors are copied from one place of the reference; runs of windows that start
earlier, each anywhere, are what is cut.  Every window is looked up itself, so none across
the boundary of two factors has to be checked afterwards, and words are removed if and only
if a window that covers them starts earlier.  Windows are judged on the input, not on what
is left.

Words are compared by a 64-bit hash, windows by 96 bits or more made from the hashes of their
words.  Neither is checked on the words themselves: two words of equal hash count as equal.

The index is built in reference blocks, one per anchor:

1. Anchors.  Of every window the 8-word gram with the smallest hash (the leftmost of them)
   is its anchor, so equal windows have equal anchors.  Consecutive windows with the same
   anchor place form a group of about seven; its span are the words that they cover.
2. Blocks.  A group travels to the block of its anchor as one row with the hashes of its
   windows, whatever the size of the input: rows sent per byte stay flat.  There the groups
   are sorted by place.  An anchor met once has no repeats.  A group equal to the first of its
   anchor is a repeat as a whole.  Where other groups of the anchor exist, they and the first
   are spread into windows and sorted again: the first window of a hash is the reference, the
   others are repeats of it.
3. Frequent anchors, those of more than about 1 / ``HOT`` of all groups, would make one block
   large.  There are at most ``HOT`` of them; their windows are sent to blocks of their own hash.

Occurrences after the first within one slice of a task are known repeats already: they
travel as ranges, so a passage that every document shares reaches its block once per slice,
not once per document.

Repeats return to their document as ranges and are cut out.  At most ``HOT`` anchors reach the
driver, and no partition holds more than sorted rows that it streams.

Null and empty texts have no words; texts shorter than a window keep all of theirs.  Null
ids sort last and count as one id; rows that repeat an id count as one document: equal
places are not earlier than each other, so exact repeats of a row get the same result.
Empty tables give empty results.  Input columns named like output columns are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, set_aside
from .tokens import Words, mix, range_hash

WINDOW = 20
GRAM = 8
HOT = 20_000
SLICE_BYTES = 4 << 20
LAST = np.iinfo(np.int64).max


class _Windows:
    """All windows of a slice of documents, and the groups of windows that share an anchor."""

    def __init__(self, texts: pa.Array, window: int, gram: int):
        self.words = Words(texts)
        n = np.maximum(np.diff(self.words.first) - window + 1, 0)
        doc = np.repeat(np.arange(len(n)), n)
        ahead = np.concatenate([[0], np.cumsum(n)])
        pos = np.arange(len(doc)) - ahead[doc]
        at = self.words.first[doc] + pos
        self.hash, self.window = self.words.hashes(), window
        grams = np.arange(max(len(self.hash) - gram + 1, 0))
        value = range_hash(self.hash, grams, grams + gram, 1)
        # leftmost smallest gram of every window
        place, done, width = grams, 1, window - gram + 1
        while done < width and len(value):
            step = min(done, width - done)
            left = max(len(value) - step, 0)  # nothing is left where no window fits
            right = value[step:] < value[:left]
            place = np.where(right, place[step:], place[:left])
            value = np.where(right, value[step:], value[:left])
            done += step
        place = place[at] if len(at) else at
        new = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(doc) != 0)])[:len(at)]
        lead = np.flatnonzero(new)
        #: of every group: document, first window, first word, number of windows, anchor
        self.doc, self.pos, self.at = doc[lead], pos[lead], at[lead]
        self.size = np.diff(np.append(lead, len(at)))
        self.anchor = value[self.at] if len(at) else value[:0]

    def span_hash(self, start: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits for word ranges, as two longs; both are made from the same 64-bit word hashes."""
        return (range_hash(self.hash, start, start + words, 2).view(np.int64),
                (range_hash(mix(self.hash), start, start + words, 3) >> np.uint64(32)).astype(np.int64))

    def spread(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, number of the window, first word) of every window of the chosen groups, in page order."""
        times = self.size[chosen]
        group = np.repeat(chosen, times)
        step = np.arange(len(group)) - np.repeat(np.cumsum(times) - times, times)
        return self.doc[group], self.pos[group] + step, self.at[group] + step


def frequent_anchors(texts: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> np.ndarray:
    """Anchors of more than about 1 / ``hot`` of the groups that a one-column DataFrame sends, sorted.

    Slices report the anchors frequent in them; an anchor missed here costs balance and never a result.
    """
    if hot < 1:
        return np.empty(0, np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, batch.schema.names[0], SLICE_BYTES):
                found = _Windows(part.column(0), window, gram)
                span = found.span_hash(found.at, found.size + window - 1)[0]
                order = np.lexsort((span, found.anchor))
                anchor, span = found.anchor[order].view(np.int64), span[order]
                fresh = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(span) != 0)])[:len(anchor)]
                value, n = np.unique(anchor[fresh], return_counts=True)
                often = n >= max(2, fresh.sum() / (2 * hot))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None, *value[often].tolist()], pa.int64()),
                     pa.array([int(fresh.sum()), *n[often].tolist()], pa.int64())], names=["anchor", "n"])

    counted = texts.mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    # the null row counts all groups; no more than ``hot`` anchors can reach the share
    top = counted.orderBy(F.desc("n")).limit(hot + 1).collect()
    total = next((r.n for r in top if r.anchor is None), 0)
    return np.array(sorted(r.anchor for r in top if r.anchor is not None and r.n * hot >= total), np.int64)


#: ``windows``: 6 bytes of hash for every window of the group; a known repeat has none and a ``width``
_SENT = "key long, doc long, tag long, pos int, width int, windows binary"
_LOOKED_UP = "h1 long, h2 long, doc long, tag long, pos int, width int, known boolean"
_FOUND = "doc long, tag long, start int, end int"


def _ids(column: pa.Array) -> np.ndarray:
    return np.array([LAST if x is None else x for x in column.to_pylist()], np.int64)


def _compare(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, tag: np.ndarray,
             pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of equal (h1, h2) start after the first of them, and which of the others to send (equal ones once)."""
    order = np.lexsort((tag, pos, doc, h2, h1))
    new = np.concatenate([[True], (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)])
    lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    repeat, fresh = np.zeros(len(order), bool), np.zeros(len(order), bool)
    repeat[order] = (doc[order] != doc[lead]) | (pos[order] != pos[lead])
    fresh[order] = new | np.concatenate([[True], np.any([np.diff(x[order]) != 0 for x in (doc, pos, tag)], axis=0)])
    return repeat, fresh & ~repeat


def _packed(hashes: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The low 48 bits of the hashes, ``sizes`` of them to a value."""
    data = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :6])
    offsets = (6 * np.concatenate([[0], np.cumsum(sizes)])).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``_packed``: all hashes, and where those of each value start."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(-1, 6)
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, :6] = data
    return wide.view(np.int64)[:, 0], (offsets - offsets[0]).astype(np.int64) // 6


def _send(part: pa.RecordBatch, window: int, gram: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of one slice (doc, tag, text) for the blocks."""
    found = _Windows(part.column(2), window, gram)
    ids, tags = _ids(part.column(0)), part.column(1).to_numpy(zero_copy_only=False)
    by_window = np.isin(found.anchor.view(np.int64), frequent)

    def rows(h1, h2, row, pos, width, windows) -> Iterator[pa.RecordBatch]:
        if not len(row):
            return
        doc, tag = ids[row], tags[row]
        repeat, send = _compare(h1, h2, doc, tag, pos)
        yield _sent(h1[send], doc[send], tag[send], pos[send], np.zeros(send.sum(), int), windows(send))
        # known repeats: runs of consecutive windows of one row
        r, p, end = row[repeat], pos[repeat], pos[repeat] + width[repeat]
        if len(r):
            begins = np.flatnonzero(np.concatenate([[True], (np.diff(r) != 0) | (p[1:] != end[:-1])]))
            ends = end[np.append(begins[1:], len(p)) - 1]
            d, t = doc[repeat][begins], tag[repeat][begins]
            spread = mix((d ^ t ^ p[begins]).view(np.uint64)).view(np.int64)
            none = pa.array([b""] * len(d), pa.binary())
            yield _sent(spread, d, t, p[begins], ends - p[begins], none)

    whole = np.flatnonzero(~by_window)
    span = found.span_hash(found.at[whole], found.size[whole] + window - 1)[0]

    def of_groups(send: np.ndarray) -> pa.Array:
        at = found.spread(whole[send])[2]
        return _packed(range_hash(found.hash, at, at + window, 2), found.size[whole[send]])

    yield from rows(found.anchor[whole].view(np.int64), span, found.doc[whole], found.pos[whole], found.size[whole],
                    of_groups)
    row, pos, at = found.spread(np.flatnonzero(by_window))
    h1, h2 = found.span_hash(at, np.full(len(at), window))
    one = np.ones(len(at), np.int64)
    yield from rows(h1, h2, row, pos, one, lambda send: _packed(h2[send], one[send]))


def _sent(key, doc, tag, pos, width, windows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(doc), pa.array(tag), pa.array(pos.astype(np.int32)), pa.array(width.astype(np.int32)),
         windows], names=["key", "doc", "tag", "pos", "width", "windows"])


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks, sorted by (key, doc, pos): known repeats, and the windows that are still to be compared."""
    first, first_out = None, False  # the first group of the last key; whether its windows were given out
    for batch in batches:
        known = batch.column("width").to_numpy() > 0
        if known.any():
            done = batch.filter(pa.array(known))
            key, doc, tag, pos, width = (c.to_numpy() for c in done.columns[:5])
            yield _rows(key, np.zeros(len(key), np.int64), doc, tag, pos, width, True)
        look = batch.filter(pa.array(~known))
        if not look.num_rows:
            continue
        carried = first is not None
        if carried:
            look = pa.concat_batches([first, look])
        key, doc, tag, pos = (c.to_numpy() for c in look.columns[:4])
        value, start = _unpacked(look.column("windows"))
        size = np.diff(start)
        new = np.concatenate([[True], np.diff(key) != 0])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        row = np.repeat(np.arange(len(key)), size)
        step = np.arange(len(value)) - start[row]
        fits = step < size[lead[row]]
        equal = fits & (value == value[np.where(fits, start[lead[row]] + step, 0)])
        same = (size == size[lead]) & np.logical_and.reduceat(equal, start[:-1])
        repeat = same & ((doc != doc[lead]) | (pos != pos[lead]))
        if repeat.any():
            yield _rows(key[repeat], np.zeros(repeat.sum(), np.int64), doc[repeat], tag[repeat], pos[repeat],
                        size[repeat], True)
        # all else is compared by window, with the first group of its key
        out = ~repeat & ~new
        out[lead[out]] = True
        last = lead[-1]
        given = out[last] or (carried and first_out and last == 0)
        if carried and first_out:
            out[0] = False
        w = out[row]
        if w.any():
            at = row[w]
            yield _rows(key[at], value[w], doc[at], tag[at], pos[at] + step[w], np.ones(len(at), int), False)
        first, first_out = look.slice(last, 1), given


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of windows that start after the first of their hash, of rows sorted by (known, h1, h2, doc, pos)."""
    carry = None
    for batch in batches:
        h1, h2, doc, tag, pos, width, known = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(h1):
            continue
        new = np.concatenate([[True], (np.diff(h1) != 0) | (np.diff(h2) != 0) | (known[1:] != known[:-1])])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        doc0, pos0 = doc[lead], pos[lead]
        if carry is not None and not known[0] and carry[:2] == (h1[0], h2[0]):
            group = lead == 0
            doc0, pos0 = np.where(group, carry[2], doc0), np.where(group, carry[3], pos0)
        if not known[-1]:
            carry = (h1[-1], h2[-1], doc0[-1], pos0[-1])
        out = known | (doc != doc0) | (pos != pos0)
        start = pos[out]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[out]), pa.array(tag[out]), pa.array(start), pa.array(start + width[out])],
            names=["doc", "tag", "start", "end"])


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc, tag, start, end): ranges of window starts in ``docs`` (doc, tag, text) that occur earlier.

    ``doc`` is the id (null: the largest long), ``tag`` a 64-bit hash of the text.
    """
    frequent = frequent_anchors(docs.select("text"), window, gram, hot)  # 160 kB at most

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE_BYTES):
                yield from _send(part, window, gram, frequent)

    sent = docs.select("doc", "tag", "text").mapInArrow(send, _SENT)
    blocks = sent.repartition("key").sortWithinPartitions("key", "doc", "pos")
    # windows of one hash share their key, hence their partition: the second sort moves nothing
    windows = blocks.mapInArrow(_look_up, _LOOKED_UP).sortWithinPartitions("known", "h1", "h2", "doc", "pos")
    return windows.mapInArrow(_find, _FOUND)


def _rows(h1, h2, doc, tag, pos, width, known: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (h1, h2, doc, tag, pos.astype(np.int32), width.astype(np.int32), np.full(len(h1), known))],
        names=["h1", "h2", "doc", "tag", "pos", "width", "known"])


def with_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``df`` with ``repeat_starts``: ranges [start, end) of word numbers at which a repeated window starts."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST)))
    # rows without ids, or with one id, are told apart by 64 bits of text and length
    text = F.coalesce(F.col(text_col), F.lit(""))
    tag = F.xxhash64(text, F.length(text))
    found = repeated_windows(df.select(doc.alias("doc"), tag.alias("tag"), F.col(text_col).alias("text")),
                             window, gram, hot)
    # rows that repeat id and text send the same ranges: each counts once, also before the shuffle
    ranges = found.groupBy(F.col("doc").alias("__doc"), F.col("tag").alias("__tag")).agg(
        F.collect_set(F.struct("start", "end")).alias("repeat_starts"))
    keyed = df.drop("repeat_starts").withColumns({"__d": doc, "__t": tag})
    joined = keyed.join(ranges, (F.col("__d") == F.col("__doc")) & (F.col("__t") == F.col("__tag")), "left")
    return joined.drop("__d", "__t", "__doc", "__tag")


def _kept(part: pa.RecordBatch, text_col: str, window: int) -> tuple[Words, np.ndarray]:
    """The words of a batch and which of them stay."""
    words = Words(part.column(text_col))
    edge = np.zeros(len(words.start) + 1, np.int32)
    lists = part.column("repeat_starts")
    inner = lists.flatten()
    if len(inner):
        n = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        base, last = np.repeat(words.first[:-1], n), np.repeat(words.first[1:], n)
        # a range never reaches into the next document
        np.add.at(edge, np.minimum(base + inner.field("start").to_numpy(), last), 1)
        np.add.at(edge, np.minimum(base + inner.field("end").to_numpy() + window - 1, last), -1)
    return words, np.cumsum(edge)[:-1] == 0


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with repeated passages cut out of ``text_col``; what stays is joined by one space where a text was cut."""
    plain, restore = set_aside(df, ("repeat_starts",))
    found = with_repeats(plain, id_col, text_col, window)
    columns, schema = plain.columns, plain.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text_col, SLICE_BYTES):
                words, keep = _kept(part, text_col, window)
                old = part.column(text_col).to_pylist()
                new = [t.decode() for t in words.texts(keep)]
                cut = np.add.reduceat(np.append(~keep, False), words.first[:-1]) * (np.diff(words.first) > 0) > 0
                text = pa.array([b if c else a for a, b, c in zip(old, new, cut)], type=pa.string())
                yield pa.RecordBatch.from_arrays([text if c == text_col else part.column(c) for c in columns],
                                                 names=columns)
    return restore(found.mapInArrow(run, schema))


def repeat_report(df: DataFrame) -> DataFrame:
    """Digest columns, one row per document."""
    found = with_repeats(df.select("doc_id", "text"))
    schema = T.StructType([found.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE_BYTES):
                words, keep = _kept(part, "text", WINDOW)
                gone = np.concatenate([[0], np.cumsum(~keep)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(words.first)), pa.array(np.diff(gone[words.first])),
                     pa.array([hashlib.sha256(t).hexdigest() for t in words.texts(keep)])], names=schema.names)
    return found.mapInArrow(run, schema)
