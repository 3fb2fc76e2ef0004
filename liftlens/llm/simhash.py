"""SimHash near-duplicates: fingerprints, then tiled exact comparison.

Fingerprint: words (runs without white space, A-Z lower-cased) in shingles of
``shingle`` words, each hashed with XXH64 (seed 42); a bit is 1 if it is set in over
half of the shingle hashes.  Fingerprints at ``radius`` or fewer differing bits link.

Comparison is exact and covers all pairs of distinct fingerprints:

1. Copies share a fingerprint; the distinct ones are range-sorted by population counts
   (whole word, then its halves, quarters and bytes) and packed into tiles of ``TILE``.
2. A tile knows the smallest and largest population count of each segment.  Two
   fingerprints differ in at least the sum over disjoint segments of the differences
   of their counts, so tile pairs whose counts differ beyond the radius are skipped:
   first between tiles, then between the small blocks inside a tile pair.
3. ``GROUP`` neighbouring tiles form a square's side: a tile travels once to each square in
   which it has a partner, not once per pair.
4. Surviving blocks are compared with exclusive-or and bit counts.  A square returns
   a spanning forest of its links, never all pairs of a group.
5. Links become components (``components.connected_components``).

Nothing but counts reaches the driver.  The largest group, and the largest number of
copies of a fingerprint, only add rows to plain joins that Spark can split.

Null or empty text has fingerprint zero, which links like any other.  Repeated rows get
the same result each.  A null ``doc_id`` never names a component unless it is alone in it
(then the component is null).  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import map_text
from .components import connected_components

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE = 8192
GROUP = 4
BLOCK = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and space and \x09-\x0D
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:len(words) - k] + 1]).tolist()
    hash_of = xxhash.xxh64_intdigest
    h = np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())], np.uint64)
    return _majority(h)


def _majority(h: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for part in np.array_split(h, len(h) // 8192 + 1):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, text_col: str = "text", shingle: int = SHINGLE, keep=None) -> DataFrame:
    """``df`` with ``simhash``: the fingerprint as a signed long."""
    def make():
        def run(texts):
            values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            return [pa.array(values.view(np.int64))]
        return run
    return map_text(df, text_col, [T.StructField("simhash", T.LongType())], make, keep=keep)


# Segments of a fingerprint as (first bit, bits): whole, halves, quarters, bytes.
LEVELS = [[(0, 64)], [(i, 32) for i in (0, 32)], [(i, 16) for i in range(0, 64, 16)], [(i, 8) for i in range(0, 64, 8)]]
SEGMENTS = [s for level in LEVELS for s in level]


def segment_counts(fps: np.ndarray) -> np.ndarray:
    """Population count of every segment: one row per fingerprint."""
    return np.stack([np.bitwise_count((fps >> np.uint64(a)) & np.uint64((1 << n) - 1)) for a, n in SEGMENTS],
                    axis=1).astype(np.int16)


def _count(fp: Column, first: int, bits: int) -> Column:
    part = F.shiftrightunsigned(fp, first)
    return F.bit_count(part if bits == 64 else part.bitwiseAND(F.lit((1 << bits) - 1)))


def _gap(low_a, high_a, low_b, high_b) -> np.ndarray:
    """Least number of differing bits between boxes of counts, from the best level."""
    apart = np.maximum(np.maximum(low_a - high_b, low_b - high_a), 0)
    out, at = None, 0
    for level in LEVELS:
        total = apart[..., at:at + len(level)].sum(axis=-1)
        out = total if out is None else np.maximum(out, total)
        at += len(level)
    return out


class _Tile:
    """Fingerprints in blocks of similar population counts."""

    def __init__(self, raw: bytes):
        fps = np.frombuffer(raw, np.uint64)
        counts = segment_counts(fps)
        # halves and quarters lead: they separate the blocks of a tile best
        order = np.lexsort(counts[:, ::-1].T) if len(fps) > 1 else np.arange(len(fps))
        self.fps, counts = fps[order], counts[order]
        self.cuts = list(range(0, len(fps), BLOCK)) + [len(fps)]
        self.low = np.minimum.reduceat(counts, self.cuts[:-1], axis=0)
        self.high = np.maximum.reduceat(counts, self.cuts[:-1], axis=0)


class _Forest:
    """Keeps the links that join two trees, drops the others."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while (up := self.parent.setdefault(x, x)) != x:
            self.parent[x] = x = self.parent[up]
        return x

    def add(self, u: int, v: int) -> None:
        ru, rv = self.root(u), self.root(v)
        if ru != rv:
            self.parent[ru] = rv
            self.links.append((u, v))


def _compare(a: _Tile, b: _Tile, radius: int, forest: _Forest) -> None:
    same = a is b
    near = _gap(a.low[:, None], a.high[:, None], b.low[None], b.high[None]) <= radius
    if same:
        near = np.triu(near)
    for i, j in zip(*np.nonzero(near)):
        x, y = a.fps[a.cuts[i]:a.cuts[i + 1]], b.fps[b.cuts[j]:b.cuts[j + 1]]
        close = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
        if same and i == j:
            close = np.triu(close, 1)
        if close.any():
            p, q = np.nonzero(close)
            for u, v in zip(x[p].tolist(), y[q].tolist()):
                forest.add(u, v)


def tile_links(raw_a: bytes, raw_b: bytes, same: bool, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two tiles (or inside one)."""
    forest, a = _Forest(), _Tile(raw_a)
    _compare(a, a if same else _Tile(raw_b), radius, forest)
    return forest.links


def square_links(left: list[bytes], right: list[bytes] | None, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two sides of tiles (``right`` None: among the tiles of one side)."""
    forest, tiles = _Forest(), [_Tile(raw) for raw in left]
    others = tiles if right is None else [_Tile(raw) for raw in right]
    for i, a in enumerate(tiles):
        for b in others[i:] if right is None else others:
            if _gap(a.low.min(axis=0), a.high.max(axis=0), b.low.min(axis=0), b.high.max(axis=0)) <= radius:
                _compare(a, b, radius, forest)
    return forest.links


_TILES = T.StructType([T.StructField("tile", T.LongType()), T.StructField("side", T.LongType()),
                       T.StructField("fps", T.BinaryType())]
                      + [T.StructField(x, T.ArrayType(T.IntegerType())) for x in ("low", "high")])


def _pack(size: int, group: int):
    """Sorted fingerprints to tiles of at most ``size``, ``group`` tiles to a side; the first fingerprint names both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, made, side = np.empty(0, np.int64), 0, 0

        def tile(fps: np.ndarray) -> pa.RecordBatch:
            nonlocal made, side
            if made % group == 0:
                side = int(fps[0])
            made += 1
            counts = segment_counts(fps.view(np.uint64))
            return pa.RecordBatch.from_arrays([
                pa.array([int(fps[0])], pa.int64()), pa.array([side], pa.int64()), pa.array([fps.tobytes()], pa.binary()),
                pa.array([counts.min(axis=0).tolist()], pa.list_(pa.int32())),
                pa.array([counts.max(axis=0).tolist()], pa.list_(pa.int32()))], names=_TILES.names)

        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy(zero_copy_only=False)])
            while len(held) >= size:
                yield tile(held[:size])
                held = held[size:]
        if len(held):
            yield tile(held)
    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, tile: int | None = None,
                      group: int | None = None) -> DataFrame:
    """Links (u, v) that connect all fingerprints of ``distinct`` (one column) within ``radius``."""
    spark, tile, group = distinct.sparkSession, tile or TILE, group or GROUP
    fp = F.col(distinct.columns[0])
    n = distinct.count()
    if n < 2:
        return spark.createDataFrame([], "u long, v long")
    counts = [_count(fp, *s) for level in LEVELS[:3] for s in level]
    keys = [c.alias(f"c{i}") for i, c in enumerate(counts)]
    names = [f"c{i}" for i in range(len(keys))]
    ranged = distinct.select(fp.alias("fp"), *keys).repartitionByRange(
        -(-n // (tile * group)), *names, "fp").sortWithinPartitions(*names, "fp").select("fp")
    tiles = materialize(ranged.mapInArrow(_pack(tile, group), _TILES), "tiles")
    pairs = tile_pairs(tiles, radius)
    # a square is a pair of sides; a tile goes once to each square where it has a partner
    squares = pairs.select(
        F.least("side", "side_b").alias("p"), F.greatest("side", "side_b").alias("q"),
        F.explode(F.array(F.struct("tile", "side"), F.struct(F.col("tile_b").alias("tile"),
                                                                F.col("side_b").alias("side")))).alias("t"))
    squares = materialize(squares.select("p", "q", "t.tile", "t.side").distinct(), "tile-squares")
    work = squares.join(tiles.select("tile", "fps"), "tile").select("p", "q", "side", "tile", "fps")
    # about the fingerprints of one square of full tiles (64 KB each) a task, however small the tiles are
    sent = squares.join(tiles.select("tile", (F.octet_length("fps") / 8).cast("long").alias("n")), "tile").agg(
        F.sum("n")).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-sent // (2 * group * tile)))
    work = work.repartition(tasks, "p", "q").sortWithinPartitions("p", "q", "tile")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(square, held) -> pa.RecordBatch:
            p, q = square
            right = None if p == q else [raw for side, raw in held if side == q]
            found = square_links([raw for side, raw in held if side == p], right, radius)
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])

        square, held = None, []
        for batch in batches:
            for p, q, side, raw in zip(*(batch.column(c).to_pylist() for c in ("p", "q", "side", "fps"))):
                if (p, q) != square and held:
                    yield links(square, held)
                    held = []
                square = (p, q)
                held.append((side, raw))
        if held:
            yield links(square, held)

    return work.mapInArrow(compare, "u long, v long")


def tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """(tile, side, tile_b, side_b): each pair of tiles, equal ones too, whose population counts come within ``radius``."""
    meta = tiles.select("tile", "side", "low", "high")

    def counts(half: int, margin: int) -> Column:
        return F.explode(F.sequence(F.col("low")[half] - margin, F.col("high")[half] + margin))

    # pairs meet where both reach first, at one count of the left and one of the right half: an
    # equi-join on up to 33 x 33 keys, one row per pair
    left, right = (meta.withColumn("at_1", counts(1, margin)).withColumn("at_2", counts(2, margin))
                   for margin in (0, radius))
    right = right.withColumnsRenamed({c: f"{c}_b" for c in ("tile", "side", "low", "high")})
    once = F.lit(True)
    for half in (1, 2):
        once = once & (F.col(f"at_{half}") == F.greatest(F.col("low")[half], F.col("low_b")[half] - radius))
    return left.join(right, ["at_1", "at_2"]).where(
        (F.col("tile") <= F.col("tile_b")) & once & _near_boxes(radius)).select("tile", "side", "tile_b", "side_b")


def _near_boxes(radius: int) -> Column:
    apart = F.zip_with(
        F.zip_with("low", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0)))
    ok, at = F.lit(True), 1
    for level in LEVELS:
        ok = ok & (F.aggregate(F.slice(apart, at, len(level)), F.lit(0), lambda s, x: s + x) <= radius)
        at += len(level)
    return ok


def _grouped(df: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """(id, text hash, simhash, root, component_id) of every row."""
    prints = with_fingerprint(df.select(id_col, text_col, F.xxhash64(text_col).alias("text_hash")), text_col, shingle,
                              keep=[id_col, "text_hash"])
    prints = materialize(prints, "simhash")
    smallest = materialize(prints.groupBy("simhash").agg(F.min(id_col).alias("low")), "simhash-distinct")
    roots = connected_components(fingerprint_links(smallest.select("simhash"), radius))
    named = smallest.join(roots, smallest["simhash"] == roots["node"], "left").select(
        "simhash", F.coalesce("root", "simhash").alias("root"), "low")
    component = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of_print = materialize(named.select("simhash", "root").join(component, "root"), "simhash-components")
    return prints.join(of_print, "simhash", "left")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(id, simhash, component_id): smallest id reachable over links, for every row."""
    return _grouped(df, id_col, text_col, shingle, radius).select(id_col, "simhash", "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """``df`` with one row of each group: that of the smallest id (null last), of repeated ids one text.

    Texts travel once, to meet the (id, text hash) of the rows that stay.
    """
    found = _grouped(df, id_col, text_col, shingle, radius)
    first = found.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull(), id_col, "text_hash")).alias("first"))

    def keyed(out: DataFrame, id_: Column, text_hash: Column) -> DataFrame:
        # plain equality on these lets the join's partitioning serve the last step too
        return out.withColumns({"__no_id": id_.isNull(), "__id": F.coalesce(id_.cast("string"), F.lit("")),
                                "__hash": text_hash})

    keys = ["__no_id", "__id", "__hash"]
    first = keyed(first, F.col(f"first.{id_col}"), F.col("first.text_hash")).select(*keys).distinct()
    kept = keyed(df, F.col(id_col), F.xxhash64(text_col)).join(first, keys, "left_semi")
    return kept.dropDuplicates(keys).select(*df.columns)


def near_duplicate_report(df: DataFrame) -> DataFrame:
    found = near_duplicates(df)
    return found.select("doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")
