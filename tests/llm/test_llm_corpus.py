"""Classifier, mix, archives, page text and the pipeline."""

import random
import zlib

import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from liftlens.llm import dom, html_text, mixing, quality, queries, training_pages, warc
from liftlens.session import fresh_dir
from llm import brute


# ---- quality

def test_quality_held_out(spark):
    got = queries.QUERIES["op1_quality"](spark, SF_MID).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    again = queries.QUERIES["op1_quality"](spark, SF_MID).collect()
    assert brute.key(map(tuple, got)) == brute.key(map(tuple, again))


def test_quality_ignores_held_out_labels_and_other_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(
        F.col("quality")))
    noisy = docs.withColumns({"source": F.lit("x"), "lang": F.lit("y")})
    one = quality.quality_report(docs, labels).collect()
    two = quality.quality_report(noisy, flipped).collect()
    assert brute.key(map(tuple, one)) == brute.key(map(tuple, two))


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "x y"), (2, "a " * 20000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 0), (None, 1, 0), (2, None, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.quality_report(docs, labels).count() == 4
    assert {r.score for r in quality.quality_report(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_report(docs.limit(0), labels).count() == 0
    kept = quality.keep_good(docs.withColumn("Score", F.lit("mine")), labels.limit(0))
    assert kept.columns == ["doc_id", "text", "Score"] and kept.count() == 4


# ---- mix

def test_mix_targets_and_words(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = queries.QUERIES["op5_mix"](spark, SF_MID).collect()
    sizes, taken, target = {}, {}, {}
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        assert r.size == len(brute.WORD.findall(text[r.doc_id])) and r.taken in (0, r.size, 2 * r.size)
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    want = brute.targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9) and abs(taken[s] - want[s]) <= 0.02 * want[s]
    again = queries.QUERIES["op5_mix"](spark, SF_MID).collect()
    assert brute.key(map(tuple, got)) == brute.key(map(tuple, again))


def test_mix_odd_rows(spark):
    rows = [(1, None, "a b c"), (None, "x", None), (2, "x", "a b"), (2, "x", "a b"), (3, "", ""), (4, "y", " z " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix_report(docs).collect()
    assert len(got) == 6 and all(r.taken <= 2 * r.size for r in got)
    want = brute.targets({None: 3, "x": 4, "": 0, "y": 50})
    assert all(r.target == pytest.approx(want[r.source]) for r in got)
    assert mixing.mix_report(docs.limit(0)).count() == 0
    sized = docs.withColumns({"size": mixing.word_count(F.col("text")), "part": F.lit(1), "Target": F.lit("mine"),
                              "weight": F.lit(2), "need": F.lit(3), "bar": F.lit(4)})
    out = mixing.mix_sources(sized).collect()
    assert len(out) == 6 and out[0].part == 1 and out[0].bar == 4


def test_mix_hot_source_and_random_targets(spark):
    rng = random.Random(9)
    rows = [(i, "hot" if rng.random() < 0.4 else f"s{rng.randrange(40)}", rng.choice((0, 1, 5, 50, 3000)))
            for i in range(4000)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    want = brute.targets(sizes)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1501  # half of the largest document


# ---- archives

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def pages(spark):
    big = "é<p>" * 400
    rows = [(1, "http://a/ x\n", big), (2, None, big), (3, "u", big), (3, "u", big), (None, "n", big), (4, "é", None),
            (5, "", ""), (6, "x", "a" * 999), (7, "x", "a" * 999), (8, "q", "z" * 3_000_000), (None, None, "k" * 1000),
            (None, None, "k" * 1000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


def test_archive_odd_rows(spark):
    df, rows = pages(spark)
    got = warc.archive_report(df.withColumn("digest", F.lit("x"))).collect()
    assert brute.key(tuple(r[c] for c in COLUMNS) for r in got) == brute.key(brute.archive(rows))
    assert brute.key((r.page_id, r.url) for r in got) == brute.key((p, u) for p, u, _ in rows)
    assert warc.archive_report(df.limit(0)).count() == 0


def test_archive_round_trip_and_rolling(spark):
    df, rows = pages(spark)
    root = fresh_dir(spark, "warc-test")
    warc.write_archive(df, root, roll_bytes=500)
    back = warc.read_archive(spark, root).collect()
    assert len({r.file for r in back}) > 5
    html = {p: h or "" for p, _, h in rows}
    for r in back:
        if r.record_type == "response" and r.page_id is not None:
            assert r.payload == html[r.page_id]
    again = fresh_dir(spark, "warc-test")
    warc.write_archive(df, again, roll_bytes=500)

    def manifest(at):
        return brute.key(map(tuple, spark.read.parquet(f"{at}/manifest").collect()))
    assert manifest(root) == manifest(again)


def test_archive_ignores_uncommitted_files_and_sees_damage(spark):
    df, _ = pages(spark)
    root = fresh_dir(spark, "warc-test")
    warc.write_archive(df, root)
    fs, base = warc._fs(root)
    with fs.open_output_stream(f"{base}/_temporary-part-000000-00000.warc.gz.lost", compression=None) as out:
        out.write(b"half a file")
    assert warc.read_archive(spark, root).count() == 12
    name = spark.read.parquet(f"{root}/manifest").first().file
    with fs.open_input_file(f"{base}/{name}") as f:
        raw = f.read()
    with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
        out.write(raw[:-20])
    with pytest.raises(Exception, match="differs from its manifest"):
        warc.read_archive(spark, root).count()


def test_archive_testdata(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/pages.parquet").select("page_id", "url", "html").collect()]
    got = queries.QUERIES["op4_warc"](spark, SF_MID).collect()
    assert brute.key(tuple(r[c] for c in COLUMNS) for r in got) == brute.key(brute.archive(rows))


# ---- page text

def test_layouts_never_seen_in_training():
    model, same, shared = html_text.trained(), 0, []
    for seed in range(10 ** 6, 10 ** 6 + 150):
        page = training_pages.Page(seed).html()
        _, texts = dom.parse(page)
        want = " ".join(t for _, t in texts if dom.MARK in t).replace(dom.MARK, "")
        got = html_text.extract([page.replace(dom.MARK, "")], model)[0]
        a, b = want.split(), got.split()
        left = list(a)
        both = sum(1 for w in b if w in left and not left.remove(w))
        shared.append(2 * both / max(1, len(a) + len(b)))
        same += want == got
    assert sum(shared) / len(shared) > 0.95 and same > 0.65 * len(shared)


def test_decoding_is_consistent_and_markup_goes():
    page = ('<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><div id="cookie-notice">'
            '<p>We use cookies.</p></div><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>'
            '<div class="sidebar"><p>Popular: <a href=/c>other story</a></p></div>'
            '<article><h1>A &amp; B</h1><p>First <b>bold</b>ly  said.\n Next<br>line.</p><div class="ad"><p>Buy now!</p></div>'
            '<p>Second&nbsp;one, quite long enough to be a paragraph of text.<p>Third &lt;tag&gt; here.</article>'
            '<div id="comments"><h3>Comments</h3><div class="comment"><p>Nice article, thanks for it.</p></div></div>'
            '<form class="newsletter"><p>Subscribe.</p><button>Go</button></form><footer>&copy; x</footer></body></html>')
    assert html_text.extract([page], html_text.trained()) == [
        "A & B First boldly said. Next line. Second one, quite long enough to be a paragraph of text. Third <tag> here."]


def test_pages_of_testdata_give_their_article(spark):
    import html as htmllib
    import re
    got = {r.page_id: r for r in queries.QUERIES["op8_html_text"](spark, SF_MID).collect()}
    for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [re.sub(r"<[^>]*>|<[^>]*$", "", x) for x in re.split(r"</?(?:p|h1|br|article)>", inner)]
        want = " ".join(" ".join(htmllib.unescape(x).split()) for x in blocks if x.strip())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_page_text_odd_rows(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "u", "<!-- open"), (3, "u", '<a b="'), (4, "u", "<p>" * 20000),
            (5, "u", "</div></p>" * 1000), (6, "u", "<" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.main_text_report(df).collect()
    assert len(got) == 8 and all(r.n_chars == len(r.text) for r in got) and got[0].text == ""
    out = html_text.main_text(df.withColumn("Text", F.lit(1)))
    assert out.columns.count("text") == 1 and out.count() == 8
    assert html_text.main_text_report(df.limit(0)).count() == 0


# ---- pipeline

def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontaminate", "secret_scan", "mix"]

    def rows(df):
        return {r.doc_id: r for r in df.collect()}
    good = stages["quality"](spark, docs, SF_MID)
    scores = {r.doc_id: r.score for r in queries.QUERIES["op1_quality"](spark, SF_MID).collect()}
    assert good.columns == docs.columns and set(rows(good)) == {d for d, s in scores.items() if s >= 0.3}
    good.write.parquet(path := fresh_dir(spark, "stage"))
    good = spark.read.parquet(path)
    unique = stages["near_duplicates"](spark, good, SF_MID)
    pairs = [(r.doc_id, r.text) for r in good.collect()]
    assert unique.columns == docs.columns
    assert set(rows(unique)) == {d for d, _, c in brute.near_duplicates(pairs) if d == c}
    clean = stages["decontaminate"](spark, unique, SF_MID)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    held = [(r.doc_id, r.text) for r in unique.collect()]
    assert set(rows(clean)) == {d for d, _, hit, _ in brute.contamination(held, items) if not hit}
    masked = stages["secret_scan"](spark, clean, SF_MID)
    before, after = rows(clean), rows(masked)
    assert masked.columns == docs.columns and set(before) == set(after)
    for d, r in after.items():
        assert not brute.secret_base(r.text) and r.n_chars == len(r.text)
        assert (r.text == before[d].text) == (not brute.secret_base(before[d].text)) or "[SECRET]" in r.text
    mix = rows(stages["mix"](spark, masked, SF_MID))
    assert set(mix) <= set(after) and all(r.copies in (1, 2) and r.taken == r.copies * r.size for r in mix.values())
    whole = rows(corpus_pipeline.run(spark, SF_MID))
    assert {d: (r.copies, r.text) for d, r in whole.items()} == {d: (r.copies, r.text) for d, r in mix.items()}


def test_pipeline_stages_take_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, Score double, simhash int, secret_spans int"
    rows = [(None, None, None, None, None, 1.0, 1, 1), (1, "", "en", "s", 0, None, 2, 2), (1, "", "en", "s", 0, None, 2, 2),
            (2, 'token = "abcdefgh" x', "en", None, 5, 0.0, 3, 3)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        out.collect()
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL).count() >= 1


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
