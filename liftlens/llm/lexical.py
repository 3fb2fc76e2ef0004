"""Ranked lexical search over bit-sliced Bloom signatures.

Index (``build_index``, one pass over the texts, written below the shared folder).  Every
document has a Bloom signature of its terms, one entry for each of the ``LEVELS`` that a term's
count reaches, so the signature tells about how often a term occurs.  Documents with about
equally many entries share a block, whose signatures are stored transposed: slice s is a
bitmap of the documents with bit s set.  The index also holds exact document frequencies.

Search, for blocks of items:

1. For every term and level the slices of its bits are combined by AND: bitmaps of the
   documents that may hold the term so often.  They overestimate, never underestimate, so
   term weight times the score of the largest count still possible, summed over an item's
   terms, bounds a document's score from above.
2. The ``k`` documents with the highest bounds of every item are scored exactly on their
   texts; the k-th best (score, doc_id) is the floor of the item.
3. All documents whose bound does not put them behind the floor are scored exactly, whatever
   their number, and the best ``k`` by (score, doc_id) are returned.

Signatures and hashes decide only which texts are scored again; results come from the terms
themselves.  Texts are fetched by (doc_id, hash of the text), which may bring further
documents along: they are scored like the others.

Null texts and texts without terms match nothing and count in no statistic.  Null ids are
results like others and come last among equal scores; rows that repeat an id count each.
Items are the distinct rows of the items table; items without terms have no results.  Empty
tables give no rows, further columns are ignored, and very long texts get long signatures
(up to ``MAX_WIDTH`` bits; denser ones beyond, which costs work and no result).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import by_bytes
from .tokens import mix, range_hash

K = 50
LEVELS = np.array([1, 2, 3, 4, 6, 9, 14, 24, 48])
BITS_PER_ENTRY = 10
HASHES = 3
MAX_WIDTH = 1 << 21
BLOCK_CELLS = 1 << 24
BLOCK_DOCS = 4096
BLOCK_ITEMS, BLOCK_TERMS = 256, 1 << 15
CHUNK = 256
BROADCAST_ROWS = 1_000_000
LAST = np.iinfo(np.int64).max
_U = np.uint64

# A-Z, a-z, 0-9 and everything beyond ASCII belong to terms; A-Z are lower-cased.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INNER = np.zeros(256, bool)
_INNER[48:58] = _INNER[97:123] = _INNER[128:] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


class Terms:
    """Terms of every text of an Arrow string array: distinct (document, term) pairs with counts."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.string())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, np.uint8)
        bounds, data = offsets - offsets[0], _LOWER[data]
        here = _INNER[data]
        inside = np.concatenate([[False], here, [False]])
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        start = np.flatnonzero(here & (cut[:-1] | ~inside[:-2]))
        end = np.flatnonzero(here & (cut[1:] | ~inside[2:])) + 1
        first = np.searchsorted(start, bounds)
        #: number of terms of every document, repeats included
        self.n = np.diff(first)
        # without the separators the terms stand one behind the other
        at = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(start), [
            None, pa.py_buffer(at.tobytes()), pa.py_buffer(data[here].tobytes())]).dictionary_encode()
        #: the distinct terms
        self.terms = coded.dictionary
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(self.n)), self.n)
        pairs, self.tf = np.unique(doc * max(len(self.terms), 1) + codes, return_counts=True)
        #: of every pair: document, number of the term, count
        self.doc, self.term = np.divmod(pairs, max(len(self.terms), 1))


def term_hashes(terms: pa.Array) -> np.ndarray:
    if not len(terms):
        return np.empty(0, np.uint64)
    at = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
    return range_hash(np.frombuffer(terms.buffers()[2], np.uint8), at[:-1], at[1:], 0, _BYTE)


def slice_numbers(hashes: np.ndarray, level: np.ndarray | int, width: int) -> np.ndarray:
    """Slices of (term, level) entries in a signature of ``width`` bits, one column per hash function."""
    x = mix(hashes + np.asarray(level).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    y = mix(x) | _U(1)
    return np.stack([((x + _U(j) * y) >> _U(8)) % _U(width) for j in range(HASHES)], axis=-1).astype(np.int64)


def _width(size_class: int) -> int:
    return min(BITS_PER_ENTRY << size_class, MAX_WIDTH)


def _block_docs(width: int) -> int:
    return max(8, min(BLOCK_DOCS, BLOCK_CELLS // width) // 8 * 8)


_INDEX = ("ids array<long>, tags array<long>, n array<long>, width int, slices binary, "
          "terms array<binary>, df array<long>, docs long, total long")
_NAMES = [c.split()[0] for c in _INDEX.split(", ")]
_TYPES = [pa.list_(pa.int64())] * 3 + [pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.int64(),
                                       pa.int64()]


def _index_row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(c)], t) for c, t in zip(_NAMES, _TYPES)], names=_NAMES)


class _Block:
    """Documents of one size class that wait for a full block."""

    def __init__(self, width: int):
        self.width, self.parts, self.docs = width, [], 0

    def add(self, ids, tags, n, doc, hashes, levels):
        """``doc`` numbers the documents 0, 1, ...; entries are (doc, hash, number of levels)."""
        self.parts.append((ids, tags, n, doc + self.docs, hashes, levels))
        self.docs += len(ids)

    def rows(self, everything: bool) -> Iterator[pa.RecordBatch]:
        full = _block_docs(self.width)
        if not self.docs or (self.docs < full and not everything):
            return
        ids, tags, n, doc, hashes, levels = (np.concatenate(x) for x in zip(*self.parts))
        end = self.docs if everything else self.docs // full * full
        for a in range(0, end, full):
            b = min(a + full, end)
            low, high = np.searchsorted(doc, [a, b])
            d, h, many = doc[low:high] - a, hashes[low:high], levels[low:high]
            entry = np.repeat(np.arange(len(d)), many)
            level = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many)
            cells = np.zeros((self.width, -(-(b - a) // 8) * 8), bool)
            at = slice_numbers(h[entry], level, self.width)
            for j in range(HASHES):
                cells[at[:, j], d[entry]] = True
            yield _index_row(ids=ids[a:b].tolist(), tags=tags[a:b].tolist(), n=n[a:b].tolist(), width=self.width,
                             slices=np.packbits(cells, axis=1, bitorder="little").tobytes())
        rest = np.searchsorted(doc, end)
        self.parts, self.docs = [(ids[end:], tags[end:], n[end:], doc[rest:] - end, hashes[rest:], levels[rest:])], \
            self.docs - end


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"))


def _id_key(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id), F.lit(int(LAST)))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index of all documents: blocks of signatures, and rows of exact term statistics."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = Terms(part.column("text"))
                if not len(found.doc):
                    continue
                yield _index_row(terms=found.terms.to_pylist(), df=np.bincount(found.term, minlength=len(found.terms)).tolist(),
                                 docs=int((found.n > 0).sum()), total=int(found.n.sum()))
                ids = part.column("key").to_numpy(zero_copy_only=False)
                tags = part.column("tag").to_numpy(zero_copy_only=False)
                levels = np.searchsorted(LEVELS, found.tf, "right")
                entries = np.bincount(found.doc, levels, minlength=len(ids))
                hashes = term_hashes(found.terms)[found.term]
                size_class = np.where(found.n > 0, np.ceil(np.log2(np.maximum(entries, 16))), -1).astype(np.int64)
                for c in np.unique(size_class[size_class >= 0]).tolist():
                    mine = size_class == c
                    number = np.cumsum(mine) - 1
                    of = mine[found.doc]
                    block = blocks.setdefault(c, _Block(_width(c)))
                    block.add(ids[mine], tags[mine], found.n[mine], number[found.doc[of]], hashes[of], levels[of])
                    yield from block.rows(False)
        for block in blocks.values():
            yield from block.rows(True)

    keyed = _keyed(docs, id_col, text_col).select(_id_key().alias("key"), "tag", "text")
    return materialize(keyed.mapInArrow(build, _INDEX), "lexical-index")


class Queries:
    """A block of items: their distinct terms, with weights once the statistics are known."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.item_ids = [i for i, _ in items]
        self.terms = sorted({t for _, terms in items for t in terms})
        number = {t: i for i, t in enumerate(self.terms)}
        self.holds = np.zeros((len(self.terms), len(items)))
        for i, (_, terms) in enumerate(items):
            self.holds[[number[t] for t in terms], i] = 1.0
        self.hashes = term_hashes(self.value_set())

    def value_set(self) -> pa.Array:
        return pa.array(self.terms, pa.binary())

    def weigh(self, n_docs: int, n_terms: int, df: np.ndarray) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        # sums of products below 2^53 are exact in doubles
        self.exact = float((self.holds * self.weight[:, None]).sum(axis=0).max(initial=0)) * 1e6 < 2.0 ** 53

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """m of documents with ``n`` terms."""
        sizes, at = np.unique(n, return_inverse=True)
        return np.array([100 - 50 + 50 * int(x) * self.n_docs // self.n_terms for x in sizes], np.int64)[at]

    def gains(self, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))

    def sums(self, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, docs: int) -> np.ndarray:
        """Per document and item: gains summed over the item's terms."""
        used, column = np.unique(term, return_inverse=True)
        if self.exact:
            dense = np.zeros((docs, len(used)))
            dense[doc, column] = gain
            return dense @ self.holds[used]
        dense = np.zeros((docs, len(used)), np.int64)
        dense[doc, column] = gain
        return dense @ self.holds[used].astype(np.int64)

    def bounds(self, width: int, n: np.ndarray, slices: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """(first document, matrix document x item of upper bounds) for chunks of a block's documents."""
        bits = np.frombuffer(slices, np.uint8).reshape(width, -1)
        count = np.zeros((0, bits.shape[1] * 8), np.uint8)
        alive, bitmap = np.arange(len(self.terms)), None
        for level in range(len(LEVELS)):
            at = slice_numbers(self.hashes[alive], level, width)
            here = bits[at[:, 0]]
            for j in range(1, HASHES):
                here &= bits[at[:, j]]
            here = here if bitmap is None else here & bitmap
            some = here.any(axis=1)
            alive, bitmap = alive[some], here[some]
            if level == 0:
                first, row = alive, np.full(len(self.terms), -1)
                row[alive] = np.arange(len(alive))
                count = np.zeros((len(alive), bits.shape[1] * 8), np.uint8)
            if not len(alive):
                break
            count[row[alive]] += np.unpackbits(bitmap, axis=1, bitorder="little")
        m = self.lengths(n)
        most = np.append(LEVELS[1:] - 1, LAST)
        for a in range(0, len(n), CHUNK):
            b = min(a + CHUNK, len(n))
            at, doc = np.nonzero(count[:, a:b])
            tf = np.minimum(most[count[at, a + doc] - 1], n[a + doc])
            yield a, self.sums(doc, first[at], self.gains(first[at], tf, m[a + doc]), b - a)


class _Best:
    """The k best (score, id) of every item, each with a payload."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)
        self.id = np.full((items, k), LAST)
        self.extra = np.zeros((items, k), np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, extra: np.ndarray) -> None:
        """``scores``: matrix document x item; 0 never counts."""
        floor, last = self.score[:, -1], self.id[:, -1]
        better = (scores > 0) & ((scores > floor) | ((scores == floor) & (ids[:, None] <= last)))
        for i in np.flatnonzero(better.any(axis=0)).tolist():
            mine = better[:, i]
            score = np.concatenate([self.score[i], scores[mine, i].astype(np.int64)])
            vec, more = np.concatenate([self.id[i], ids[mine]]), np.concatenate([self.extra[i], extra[mine]])
            order = np.lexsort((vec, -score))[:self.k]
            self.score[i], self.id[i], self.extra[i] = score[order], vec[order], more[order]

    def rows(self, names: list[str]) -> pa.RecordBatch:
        item, place = np.nonzero(self.score > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (item, self.score[item, place], self.id[item, place], self.extra[item, place])], names=names)


def _blocks_of(index: DataFrame) -> DataFrame:
    return index.where(F.col("slices").isNotNull()).select("ids", "tags", "n", "width", "slices")


def _numbers(lists: pa.Array, i: int) -> np.ndarray:
    return lists[i].values.to_numpy(zero_copy_only=False)


def _highest_bounds(index: DataFrame, shared, k: int) -> DataFrame:
    """(item, bound, id, tag): every task's k documents with the highest bounds of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best = _Best(len(queries.item_ids), k)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, tags, n = (_numbers(batch.column(c), i) for c in ("ids", "tags", "n"))
                for a, bound in queries.bounds(batch.column("width")[i].as_py(), n, batch.column("slices")[i].as_buffer()):
                    b = a + len(bound)
                    best.add(bound, ids[a:b], tags[a:b])
        yield best.rows(["item", "bound", "id", "tag"])
    found = _blocks_of(index).mapInArrow(run, "item long, bound long, id long, tag long")
    order = Window.partitionBy("item").orderBy(F.col("bound").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _not_excluded(index: DataFrame, shared, floors) -> DataFrame:
    """(id, tag): documents that may be among the best of an item, given the items' floors (score, id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, (score, last) = shared.value, floors.value
        slack = 0.0 if queries.exact else 1e-9
        for batch in batches:
            for i in range(batch.num_rows):
                ids, tags, n = (_numbers(batch.column(c), i) for c in ("ids", "tags", "n"))
                held = np.zeros(len(ids), bool)
                for a, bound in queries.bounds(batch.column("width")[i].as_py(), n, batch.column("slices")[i].as_buffer()):
                    b = a + len(bound)
                    bound = bound * (1 + slack)
                    maybe = (bound > score) | ((bound == score) & (ids[a:b, None] <= last))
                    held[a:b] = (maybe & (bound > 0)).any(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[held]), pa.array(tags[held])], names=["id", "tag"])
    return _blocks_of(index).mapInArrow(run, "id long, tag long")


def _score(docs: DataFrame, wanted: DataFrame, shared, k: int) -> DataFrame:
    """(item, score, id, missing): every task's k best of the documents ``wanted`` (id, tag), scored on their texts.

    ``missing`` tells null ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        best, known = _Best(len(queries.item_ids), k), queries.value_set()
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = Terms(part.column("text"))
                number = pc.index_in(found.terms, value_set=known)
                term = np.asarray(pc.fill_null(number, -1)).astype(np.int64)[found.term]
                hit = term >= 0
                m = queries.lengths(found.n)[found.doc[hit]]
                gain = queries.gains(term[hit], found.tf[hit], m)
                missing = np.asarray(pc.is_null(part.column("doc_id"))).astype(np.int64)
                ids = np.asarray(pc.fill_null(part.column("doc_id"), LAST))
                for a in range(0, len(ids), CHUNK):
                    low, high = np.searchsorted(found.doc[hit], [a, a + CHUNK])
                    docs_here = min(CHUNK, len(ids) - a)
                    scores = queries.sums(found.doc[hit][low:high] - a, term[hit][low:high], gain[low:high], docs_here)
                    best.add(scores, ids[a:a + docs_here], missing[a:a + docs_here])
        yield best.rows(["item", "score", "id", "missing"])

    few = wanted.count() <= BROADCAST_ROWS
    wanted = wanted.withColumnsRenamed({"id": "__id", "tag": "__tag"})
    texts = docs.join(F.broadcast(wanted) if few else wanted,
                      (_id_key() == F.col("__id")) & (F.col("tag") == F.col("__tag")), "left_semi")
    found = texts.select("doc_id", "text").mapInArrow(run, "item long, score long, id long, missing long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "id", "missing")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _frequencies(index: DataFrame, shared) -> DataFrame:
    """(term, df) of the queries' terms that occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.binary())
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            number = pc.index_in(batch.column("terms").flatten(), value_set=known)
            held = np.asarray(pc.is_valid(number))
            at = np.asarray(pc.drop_null(number)).astype(np.int64)
            np.add.at(total, at, batch.column("df").flatten().to_numpy(zero_copy_only=False)[held])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])
    parts = index.where(F.col("terms").isNotNull()).select("terms", "df").mapInArrow(run, "term long, df long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"))


def _items(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, terms): the distinct rows of the items table that have terms, with their distinct terms."""
    rows = items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = Terms(part.column("text"))
                cuts = np.searchsorted(found.doc, np.arange(part.num_rows + 1))
                terms = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), found.terms.take(pa.array(found.term)))
                yield pa.RecordBatch.from_arrays([part.column("item_id"), terms], names=["item_id", "terms"])
    found = rows.mapInArrow(run, f"item_id {kind}, terms array<binary>").where(F.size("terms") > 0)
    return found.withColumn("at", F.xxhash64("item_id", "terms"))


def search(docs: DataFrame, items: DataFrame, k: int = K, index: DataFrame | None = None, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of every item.

    ``index``: the result of ``build_index`` for the same documents; built here if missing.
    Items go out in blocks of about ``block_items`` items and ``block_terms`` terms (an item
    with more goes with few others), and each block scans the index twice.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col) if index is None else index
    keyed = _keyed(docs, id_col, text_col)
    queries = materialize(_items(items, item_col, item_text_col), "lexical-items")
    n_docs, n_terms = index.agg(F.sum("docs"), F.sum("total")).first()
    n_items, n_query_terms = queries.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    kind = queries.schema["item_id"].dataType.simpleString()
    if not n_docs or not n_items:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    blocks = max(-(-n_items // block_items), -(-n_query_terms // block_terms))
    out = None
    for b in range(blocks):
        mine = queries.where(F.pmod("at", F.lit(blocks)) == b).select("item_id", "terms").collect()
        if not mine:
            continue
        block = Queries([(r.item_id, [bytes(t) for t in r.terms]) for r in mine])
        df = np.zeros(len(block.terms), np.int64)
        for row in _frequencies(index, spark.sparkContext.broadcast(block.terms)).collect():  # one row per query term
            df[row.term] = row.df
        block.weigh(n_docs, n_terms, df)
        shared = spark.sparkContext.broadcast(block)

        first = materialize(_highest_bounds(index, shared, k).select("id", "tag").distinct(), "lexical-first")
        floors = np.zeros(len(mine), np.int64), np.full(len(mine), LAST)
        for row in _score(keyed, first, shared, k).where(F.col("rank") == k).collect():  # one row per item
            floors[0][row.item], floors[1][row.item] = row.score, row.id
        rest = materialize(_not_excluded(index, shared, spark.sparkContext.broadcast(floors)).distinct(), "lexical-rest")
        ids = spark.createDataFrame([(i, x) for i, x in enumerate(block.item_ids)], f"__item long, item_id {kind}")
        part = _score(keyed, rest, shared, k).join(F.broadcast(ids), F.col("item") == F.col("__item")).select(
            "item_id", "rank", F.when(F.col("missing") == 0, F.col("id")).alias("doc_id"), "score")
        out = part if out is None else out.unionByName(part)
    return out


def search_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Contract columns: the 50 best documents of every benchmark item."""
    return search(docs.select("doc_id", "text"), items)
