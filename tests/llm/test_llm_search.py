"""SimHash groups, top-k and repeated passages against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from liftlens.llm import components, queries, repeats, simhash, topk
from llm import brute


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


ODD = [(None, None), (None, ""), (3, " \n"), (4, "Hello World a b c d"), (4, "Hello World a b c d"),
       (None, "zz yy xx ww vv"), (6, "zz yy xx ww vv"), (8, "one"), (None, "alone in the world this one is"), (9, "w " * 5000)]


def test_simhash_odd_rows(spark):
    got = simhash.near_duplicate_report(docs(spark, ODD)).collect()
    assert brute.key(map(tuple, got)) == brute.key(brute.near_duplicates(ODD))
    kept = simhash.keep_first(docs(spark, ODD).withColumn("simhash", F.lit(1))).collect()
    assert brute.key(r.doc_id for r in kept) == brute.key([3, 4, 6, 8, 9, None])
    assert kept[0].simhash == 1
    assert simhash.near_duplicate_report(docs(spark, [])).count() == simhash.keep_first(docs(spark, [])).count() == 0


def test_simhash_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 96)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    got = queries.QUERIES["op7_simhash"](spark, SF_MID).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    assert brute.key(map(tuple, got)) == brute.key(brute.near_duplicates(rows))


def test_squares_of_tiles_find_every_link_and_move_tiles_once(spark):
    rng = np.random.default_rng(8)
    seeds = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    near = [s ^ np.uint64((1 << int(a)) | (1 << int(b))) for s in seeds for a, b in rng.integers(0, 64, (4, 2))]
    fps = np.unique(np.array([*near, 0, 2 ** 64 - 1, *rng.integers(0, 2 ** 63, 500, dtype=np.uint64)], np.uint64))
    distinct = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    bits = np.bitwise_count(fps[:, None] ^ fps[None])
    want = {}
    for i in range(len(fps)):  # smallest member of each group by plain search
        if i not in want:
            stack, group = [i], {i}
            while stack:
                new = set(np.flatnonzero(bits[stack.pop()] <= 4).tolist()) - group
                group |= new
                stack += new
            want.update(dict.fromkeys(group, min(int(fps.view(np.int64)[x]) for x in group)))
    for tile, group in ((64, 4), (50, 1), (16, 100), (5000, 2)):
        links = simhash.fingerprint_links(distinct, 4, tile, group)
        roots = {r.node: r.root for r in components.connected_components(links).collect()}
        assert all(roots.get(int(f), int(f)) == want[i] for i, f in enumerate(fps.view(np.int64))), (tile, group)


def test_small_tiles_and_few_links_leave_few_tasks_and_files(spark, monkeypatch):
    kind, cores = type(spark.range(0)), spark.sparkContext.defaultParallelism
    parts, ranged = 4 * cores + 32, kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda self, n, *cols: ranged(self, max(n, parts), *cols))
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    rng = np.random.default_rng(10)
    fps = np.unique(np.array([1 << int(a) | 1 << int(b) for a, b in rng.integers(0, 62, (2000, 2))], np.int64))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        links = simhash.fingerprint_links(spark.createDataFrame([(int(x),) for x in fps], "fp long"))
        assert links.rdd.getNumPartitions() <= cores
        roots = components.connected_components(links)
        assert len(set(roots.inputFiles())) <= cores
        assert {tuple(r) for r in roots.collect()} == {(int(x), int(fps[0])) for x in fps}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_tile_pairs_are_those_of_the_plain_bound(spark):
    rng = np.random.default_rng(9)
    boxes = []
    for i in range(40):
        counts = simhash.segment_counts(rng.integers(0, 2 ** 63, rng.integers(1, 4), dtype=np.uint64))
        boxes.append((i, i // 3, counts.min(axis=0).tolist(), counts.max(axis=0).tolist()))
    tiles = spark.createDataFrame(boxes, "tile long, side long, low array<int>, high array<int>")
    got = [tuple(r) for r in simhash.tile_pairs(tiles, 4).select("tile", "tile_b").collect()]
    want = [(a[0], b[0]) for a in boxes for b in boxes if a[0] <= b[0] and simhash._gap(
        *(np.array(x) for x in (a[2], a[3], b[2], b[3]))) <= 4]
    assert sorted(got) == want and len(want) > 40


def test_tile_links_span_the_groups(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 2 ** 63, 30, dtype=np.uint64)
    fps = np.unique(np.array([s ^ np.uint64(1 << int(b)) for s in seeds for b in rng.integers(0, 64, 12)], np.uint64))
    links = simhash.tile_links(fps.tobytes(), fps.tobytes(), True, 4)
    parent = {int(f): int(f) for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in links:
        assert bin(u ^ v).count("1") <= 4
        parent[root(u)] = root(v)
    assert len(links) < len(fps)
    for a in fps.tolist():
        for b in fps.tolist():
            if bin(a ^ b).count("1") <= 4:
                assert root(a) == root(b)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 200)] + [(7, 7), (None, 3), (-5, 100)]
    got = {r.node: r.root for r in components.connected_components(
        spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == -5 for i in range(100, 161)) and all(got[i] == 500 for i in range(501, 700)) and 7 not in got


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]),
            (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (100, []), (None, [1.0, 2.0]), (7, [1.0, 2.0, 3.0]),
            (150, [1.0, -2.0, 3.0]), (-50, [-1.0, .3]), (8, [0.0, 0.0]), (9, [1e9, -1e9]), (200, [1e8, 1e8])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    want = brute.key(brute.top_k(rows))
    assert brute.key(map(tuple, topk.top_k_report(df).collect())) == want
    blocks = topk.top_k(df, lambda v: v % 50 == 0, block_bytes=32)
    assert brute.key(map(tuple, blocks.collect())) == want
    assert topk.top_k_report(df.limit(0)).count() == 0


def test_top_k_testdata(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    got = queries.QUERIES["op2_topk"](spark, SF_MID).collect()
    assert brute.key(map(tuple, got)) == brute.key(brute.top_k(rows))


def test_segment_bounds_hold_and_prune():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 64))
    x = np.floor(256 * np.vstack([c + 0.1 * rng.normal(size=(50, 64)) for c in centres]))
    exact = x[:10] @ x.T
    last = None
    for a, b in zip(topk.statistics(x[:10]), topk.statistics(x)):
        bound = a @ b.T
        assert (bound >= exact - 1e-6 * np.abs(exact).max()).all()
        kept = (bound >= np.sort(exact, axis=1)[:, -6][:, None]).mean()
        assert last is None or kept <= last + 0.05
        last = kept
    assert last < 0.2


PASSAGE = " ".join(f"w{i}" for i in range(45))


@pytest.mark.parametrize("hot", [repeats.HOT, 0])  # 0: no anchor counts as frequent
def test_repeats_odd_rows(spark, hot):
    rng = random.Random(2)
    rows = [(5, PASSAGE + " x " + PASSAGE), (3, "q " + PASSAGE), (None, PASSAGE), (None, "zz " + PASSAGE), (9, "a " * 100),
            (9, "a " * 100), (1, None), (2, ""), (2, " \n"), (10, " ".join(rng.choice("ab") for _ in range(3000))),
            (11, " ".join(rng.choice("ab") for _ in range(3000))), (12, "é𝒳 " + " ".join(f"w{i}" for i in range(19))),
            (-4, "one\ntwo\t" + PASSAGE), (13, "w1 " * 19), (14, " ".join(f"w{i}" for i in range(10, 40)) + " end")]
    found = repeats.with_repeats(docs(spark, rows).repartition(3), hot=hot)
    got = []
    for r in found.collect():
        gone = {i for a in r.repeat_starts or [] for i in range(a.start, a.end + 19)}
        w = brute.WORD.findall(r.text or "")
        got.append((r.doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert brute.key(got) == brute.key(brute.repeats(rows))


@pytest.mark.parametrize("hot,batch", [(repeats.HOT, 10_000), (0, 2), (40, 3)])
def test_repeats_of_groups_that_meet_in_blocks(spark, hot, batch):
    # texts of pieces that recur in many contexts; small batches cut the groups of an anchor
    rng = random.Random(hot + batch)
    pieces = [" ".join(f"p{i}_{j}" for j in range(rng.randint(8, 40))) for i in range(6)]
    rows = [(rng.choice([None, *range(60)]), " ".join(rng.choice([*pieces, f"u{rng.random()}"]) for _ in range(rng.randint(1, 7))))
            for _ in range(90)]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    spark.conf.set(size, batch)
    try:
        got = repeats.repeat_report(docs(spark, rows).repartition(4)) if hot == repeats.HOT else None
        found = repeats.with_repeats(docs(spark, rows).repartition(4), hot=hot).collect()
        report = got.collect() if got is not None else []
    finally:
        spark.conf.set(size, old)
    cut = []
    for r in found:
        gone = {i for a in r.repeat_starts or [] for i in range(a.start, a.end + 19)}
        words = brute.WORD.findall(r.text or "")
        cut.append((r.doc_id, len(words), len(gone), " ".join(x for i, x in enumerate(words) if i not in gone)))
    want = brute.repeats(rows)
    assert brute.key(cut) == brute.key(want)
    assert not report or brute.key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in report) == brute.key(
        (d, n, g, brute.sha(k)) for d, n, g, k in want)


def test_frequent_anchors_are_few_and_rows_follow_the_input(spark):
    line = " ".join(f"l{i}" for i in range(12))
    rng = random.Random(5)

    def texts(n):
        return [(i, " ".join(f"{rng.random()}" for _ in range(30)) + f" {line} " + " ".join(
            f"{rng.random()}" for _ in range(30))) for i in range(n)]

    few, many = texts(150), texts(1500)
    for rows in (few, many):
        frequent = repeats.frequent_anchors(docs(spark, rows).select("text").coalesce(1), hot=100)
        assert 0 < len(frequent) <= 100
        assert list(frequent) == sorted(frequent)

    def rows_sent(rows):
        part = pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows]), pa.array([0] * len(rows)), pa.array([t for _, t in rows])],
            names=["doc", "tag", "text"])
        return sum(b.num_rows for b in repeats._send(part, repeats.WINDOW, repeats.GRAM, np.empty(0, np.int64)))
    assert rows_sent(many) / rows_sent(few) < 10.5
    assert repeats.frequent_anchors(docs(spark, many).select("text").limit(0)).size == 0


def test_repeats_across_factor_boundaries(spark):
    # the last text is two copied factors; windows across their boundary occur nowhere else
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a + b)), (4, " ".join(a[10:] + b[:15]))]
    got = repeats.repeat_report(docs(spark, rows)).collect()
    assert brute.key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute.key(
        (d, n, g, brute.sha(k)) for d, n, g, k in brute.repeats(rows))
    assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: 0, 3: 60, 4: 35}


def test_repeats_testdata(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op10_repeats"](spark, SF_MID).collect()
    assert brute.key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute.key(
        (d, n, g, brute.sha(k)) for d, n, g, k in brute.repeats(rows))


def test_remove_repeats_keeps_other_columns(spark):
    df = docs(spark, [(1, PASSAGE), (2, f"head {PASSAGE} tail"), (3, None)]).withColumn("repeat_starts", F.lit("mine"))
    out = {r.doc_id: r for r in repeats.remove_repeats(df).collect()}
    assert out[1].text == PASSAGE and out[2].text == "head tail" and out[3].text is None
    assert out[2].repeat_starts == "mine"
    assert repeats.repeat_report(df.limit(0)).count() == 0


def test_slices_of_few_words():
    for n in range(26):
        text = " ".join(f"v{i}" for i in range(n))
        found = repeats._Windows(pa.array([text]), repeats.WINDOW, repeats.GRAM)
        assert found.size.sum() == max(n - repeats.WINDOW + 1, 0), n


@pytest.mark.parametrize("n", [13, 18, 20])
def test_tables_of_one_short_document(spark, n):
    text = " ".join(f"v{i}" for i in range(n))
    got = repeats.repeat_report(docs(spark, [(1, text)]).coalesce(1)).collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in got] == [(n, 0, brute.sha(text))]


def test_ranges_of_repeated_rows_count_once(spark):
    rows = [(1, PASSAGE)] + [(None, "head " + PASSAGE)] * 60
    found = repeats.with_repeats(docs(spark, rows).repartition(5)).where("doc_id is null").collect()
    for r in found:
        ranges = [(x.start, x.end) for x in r.repeat_starts]
        assert len(ranges) == len(set(ranges)) <= len(PASSAGE.split())
    got = repeats.repeat_report(docs(spark, rows).repartition(5)).collect()
    assert sorted((r.n_words, r.n_removed) for r in got) == [(45, 0)] + [(46, 45)] * 60


def test_top_k_of_large_components(spark):
    """Exact beyond 2^53, refused beyond a long."""
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1e6, 1e6]), (1, [1e6, 1e6 + 1 / 256]), (2, [1e6, -1e6]), (3, [3e6, 0.5]), (50, [-1e6, 1e6])]
    assert brute.key(map(tuple, topk.top_k_report(spark.createDataFrame(rows, schema)).collect())) == brute.key(brute.top_k(rows))
    for bad in ([1e17, 1e17], [1e300, 0.0], [1e308, 1e308]):
        with pytest.raises(Exception, match="too large|range of a long"):
            topk.top_k_report(spark.createDataFrame([(0, bad), (1, bad)], schema)).collect()


def test_repeats_of_rows_without_ids_whose_tags_agree(spark, monkeypatch):
    """Even if the hash tells no two texts apart, no range reaches into another document."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (None, long), (None, "two words"), (5, " ".join(f"v{i}" for i in range(82))), (None, None)]
    monkeypatch.setattr(repeats.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    got = repeats.repeat_report(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    removed = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got)
    assert (1, 60, 0) in removed and (5, 82, 0) in removed and (0, 60, 60) in removed
    monkeypatch.undo()
    got = repeats.repeat_report(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 0, 0, 60]
