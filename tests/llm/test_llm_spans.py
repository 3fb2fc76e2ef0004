"""Secrets, personal data, benchmark windows: span results against plain regular expressions."""

import random

import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from liftlens.llm import decontaminate, pii, secrets
from llm import brute

ODD = [(None, None), (1, ""), (1, ""), (2, " \n\t"), (3, "é𝒳 " * 2000), (4, 'token = "0123456789abcdef0123456789abcdef"')]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def kinds(spans, names, base):
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans if k < base)


# ---- secrets

def test_secret_base_spans(spark):
    rng = random.Random(3)
    pieces = ["token", "=", ":", " ", '"', "abc", "Secret", "AKIA", "ABCDEFGHIJKLMNOPQRST", "deadbeef" * 3, "\n", "é", "𝒳",
              "api_key", "x" * 9, "password='", "="]
    rows = ODD + [(10 + i, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 40)))) for i in range(300)]
    table = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    sample = [(r.doc_id + 10 ** 6, r.text) for r in table.collect()]
    got = secrets.secret_report(docs(spark, rows + sample)).collect()
    want = [brute.secret_base(t) for _, t in rows + sample]
    expected = [(d, *(sum(k == i for _, k, _ in w) for i in range(3)), brute.sha(kinds(w, secrets.KINDS, 3)))
                for (d, _), w in zip(rows + sample, want)]
    assert brute.key((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == brute.key(expected)


def test_weak_parts_need_their_complement(spark):
    far = "z" * 500
    opaque = "Ab1" + "xY9" * 12
    rows = [(1, f"user=alice {opaque} https://db.example.com/x"), (2, f"{opaque}"), (3, "https://db.example.com/x"),
            (4, f"user=alice {far} {opaque}"), (5, f"user=alice {far} token=secret12345"), (6, "user=alice token=secret12345")]
    got = {r.doc_id: r.spans for r in secrets.secret_report(docs(spark, rows)).collect()}
    assert [k.split(":")[0] for k in got[1].split(",")] == ["user", "opaque", "endpoint"]
    assert got[2] == got[3] == got[4] == ""
    assert [k.split(":")[0] for k in got[5].split(",")] == ["assign"]
    assert [k.split(":")[0] for k in got[6].split(",")] == ["user", "assign"]


def test_names_at_line_starts_and_with_prefix(spark):
    cases = {1: ("host=db1\nusername=alice\npassword=hunter22", "username=alice"),
             2: ("host=db1\r\nlogin: alice\r\npassword=hunter22", "login: alice"),
             3: ("end_\u2028user=alice token=secret12345", "user=alice"),
             4: ("DB_USER=alice\nDB_PASSWORD=hunter22", "DB_USER=alice"),
             5: ("é=x\nMY_APP_2_client_id=alice token=secret12345", "MY_APP_2_client_id=alice"),
             6: ("x-_user=alice token=secret12345", "_user=alice"),
             7: ("superuser=alice token=secret12345", None), 8: ("db_superuser=alice token=secret12345", None),
             9: ("user=bob token=secret12345 a_user=eve", "user=bob|a_user=eve")}
    df = docs(spark, [(i, t) for i, (t, _) in cases.items()])
    got = {r.doc_id: r.spans for r in secrets.secret_report(df).collect()}
    for i, (text, want) in cases.items():
        found = [x.split(":") for x in got[i].split(",")]
        assert [text[int(s):int(e)] for k, s, e in found if k == "user"] == (want.split("|") if want else []), text
    url = "https://db.example.com/x"
    df = docs(spark, [(1, f"host=db1\nusername=alice\npassword=hunter22\n{url}\nend")])
    assert [x.split(":")[0] for x in secrets.secret_report(df).first().spans.split(",")] == ["user", "assign", "endpoint"]
    assert secrets.redact_secrets(df).first().text == "host=db1\n[SECRET]\n[SECRET]\n[SECRET]\nend"


def test_links_are_no_complement_of_their_own_path(spark):
    link = "https://www.example.com/2024/01/15/World/some-long-article-title"
    other = link.replace("some", "another").replace("15", "16")
    opaque = "Ab1" + "xY9" * 12
    clean = [link, f"Read {link} and\n{other}, both.", f"{link} {link}", f"see https://a.example.com and {other}",
             f"account={opaque}"]
    df = docs(spark, list(enumerate(clean)))
    assert [r.spans for r in secrets.secret_report(df).orderBy("doc_id").collect()] == [""] * len(clean)
    assert [r.text for r in secrets.redact_secrets(df).orderBy("doc_id").collect()] == clean
    linked = [(f"{opaque} at https://db.example.com", ["opaque"]), (f"https://db.example.com {opaque}", ["opaque"]),
              (f"user=alice https://db.example.com/{opaque}", ["user", "endpoint", "opaque"]),
              (f"https://db.example.com/{opaque} user=alice", ["endpoint", "opaque", "user"]),
              (f"https://db.example.com/?user=alice&sig={opaque}", ["endpoint", "user", "opaque"]),
              (f"{link} {opaque}", ["opaque"]), (f"account={opaque} user=alice", ["opaque", "user"])]
    got = secrets.secret_report(docs(spark, [(i, t) for i, (t, _) in enumerate(linked)])).orderBy("doc_id").collect()
    assert [[x.split(":")[0] for x in r.spans.split(",")] for r in got] == [k for _, k in linked]


def test_linking_against_all_pairs(spark):
    rng = random.Random(8)
    opaque = "Ab1" + "xY9" * 12
    pieces = ["user=alice", "account=" + opaque, opaque, "https://db.example.com/x", "https://a.example.com/v1/" + opaque,
              "token=secret12345", "deadbeef" * 3, "AKIA" + "B" * 20, "z" * 60, "z" * 150, "DB_USER=bob"]
    rows = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randint(1, 9)))) for i in range(200)]
    names = [f"k{i}" for i in range(6)]
    raw = docs(spark, rows).select("doc_id", secrets.find_spans(F.col("text"), secrets.ENDPOINT, 5).alias("k5"),
                                   secrets.find_spans(F.col("text"), secrets.OPAQUE, 4, secrets._mixed).alias("k4"),
                                   secrets.find_spans(F.col("text"), secrets.USER, 3, None, secrets._prefix).alias("k3"),
                                   secrets.find_spans(F.col("text"), secrets.HEX[:-1] + "{24,}", 2).alias("k2"),
                                   secrets.find_spans(F.col("text"), secrets.ACCESS[:-1] + "{16,}", 1).alias("k1"),
                                   secrets.find_spans(F.col("text"), secrets.ASSIGN, 0).alias("k0"))
    want = {}
    for r in raw.collect():
        spans = [tuple(s) for n in names for s in r[n]]

        def near(c, *kinds, apart=False):
            return any(p[2] in kinds and p[0] <= c[1] + 200 and p[1] >= c[0] - 200
                       and not (apart and p[0] < c[1] and p[1] > c[0]) for p in spans)

        def keep(c):
            inside = any(p[2] == 5 and p[0] < c[1] and p[1] > c[0] for p in spans)
            return [True, True, True, near(c, 0, 2) or near(c, 4, apart=True),
                    near(c, 1, 3, apart=True) or not inside and near(c, 5),
                    near(c, 1, 3) and near(c, 0, 2, 4)][c[2]]
        want[r.doc_id] = sorted((s, k, e) for s, e, k in spans if keep((s, e, k)))
    got = {r.doc_id: [(int(s), secrets.KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
           for r in secrets.secret_report(docs(spark, rows)).collect()}
    assert got == want


def test_interval_join_against_all_pairs(spark):
    rng = random.Random(5)
    span = "array<struct<start:bigint,end:bigint,kind:int>>"

    def some(kind):
        starts = [rng.randrange(3000) for _ in range(rng.randrange(12))]
        return [(s, s + rng.randint(1, 60), kind) for s in starts]
    rows = [(i, some(1), some(2)) for i in range(200)]
    df = spark.createDataFrame(rows, f"i int, c {span}, p {span}")
    got = {r.i: r.x for r in df.select("i", secrets.in_scope(F.col("c"), F.col("p"), 50).alias("x")).collect()}
    for i, c, p in rows:
        want = [x for x in c if any(q[0] <= x[1] + 50 and q[1] >= x[0] - 50 for q in p)]
        assert sorted(map(tuple, got[i])) == sorted(want)


def test_many_matches_and_redaction(spark):
    text = 'token="aaaaaa ' * 5000 + "é AKIA" + "B" * 20
    df = docs(spark, [(1, text), (2, "clean"), (3, None), (4, "token=deadbeefdeadbeefdeadbeef12 end")])
    r = {x.doc_id: x for x in secrets.secret_report(df).collect()}
    assert r[1].n_assign == 5000 and r[1].n_access == 1
    out = {x.doc_id: x.text for x in secrets.redact_secrets(df.withColumn("secret_spans", F.lit(1))).collect()}
    assert out[1] == "[SECRET] " * 5000 + "é [SECRET]"
    assert out[2] == "clean" and out[3] is None
    assert out[4] == "[SECRET] end"


# ---- personal data

def test_pii_base_spans_fuzz():
    rng = random.Random(1)
    for i in range(20000):
        text = "".join(rng.choice("a.@1-2 +0(é" if i % 3 else "0123456789 -") for _ in range(rng.randint(0, 40)))
        assert [(s, k, e) for s, k, e, _ in pii.find_pii(text) if k < 4] == brute.pii_base(text), text


def test_pii_report(spark):
    table = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    rows = ODD + [(r.doc_id + 100, r.text) for r in table.collect()]
    got = pii.pii_report(docs(spark, rows)).collect()
    want = []
    for d, t in rows:
        b = brute.pii_base(t or "")
        want.append((d, *(sum(k == i for _, k, _ in b) for i in range(4)), brute.sha(kinds(b, pii.KINDS, 4))))
    assert brute.key((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == brute.key(want)


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB83WEST12345698765432")

    def found(text):
        return [pii.KINDS[k] for _, k, _, _ in pii.find_pii(text)]
    assert found("IBAN GB82 WEST 1234 5698 7654 32 TODAY") == ["iban"]
    assert found("IBAN GB83 WEST 1234 5698 7654 32") == []
    assert found("my ssn 123-45-6789") == ["ssn"] and found("part 123-45-6789") == []
    assert found("call 555-123-4567") == ["local"] and found("lot 555-123-4567") == []
    near, plain = pii.find_pii("visa card 4111 1111 1111 1111")[0][3], pii.find_pii("4111 1111 1111 1111")[0][3]
    assert near > plain


def test_pii_long_runs_are_linear():
    for text in ("a" * 300_000, "@" * 300_000, "1." * 150_000, "1" * 300_000, "+1 " * 100_000, "a@" * 150_000):
        pii.find_pii(text)


def test_pii_mask(spark):
    df = docs(spark, [(1, "write to a.b@c.org now"), (2, None)]).withColumn("pii_spans", F.lit(7))
    out = {r.doc_id: r for r in pii.mask_pii(df).collect()}
    assert out[1].text == "write to [EMAIL] now" and out[2].text is None and out[1].pii_spans == 7


# ---- decontamination

def bench(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu".split()
    rows = [(1, " ".join(words)), (2, "one two"), (2, "three"), (3, ""), (None, "null id item"), (4, None),
            (5, "É 123 " + " ".join(words[:9]))]
    return spark.createDataFrame(rows, "item_id long, text string"), rows, words


@pytest.mark.parametrize("block_words", [2_000_000, 5])
def test_contamination(spark, block_words):
    benchmark, items, words = bench(spark)
    rows = ODD + [(20, "x " + " ".join(words) + " y"), (21, "ALPHA, Beta; gamma!"), (22, " ".join(words[:10])),
                  (23, "say one-two three"), (24, "null ID item and é 123 " + " ".join(words[:9]))]
    rows += [(25, " ".join(words[:9])), (26, " ".join(words) + " one two " + " ".join(words[1:]))]
    found = decontaminate.find_hits(docs(spark, rows), benchmark, block_words=block_words)
    got = [(r.doc_id, r.n_words, {i for a in r.hit_ranges for i in range(a.start, a.end)}, set(r.hit_items))
           for r in found.collect()]
    assert brute.key(map(repr, got)) == brute.key(map(repr, brute.contamination(rows, items)))


def test_copies_of_an_item_are_broadcast_once(spark, monkeypatch):
    benchmark, items, words = bench(spark)
    many = spark.createDataFrame(items + [items[0]] * 300, benchmark.schema).repartition(4)
    sent, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: sent.append(x) or send(x))
    rows = [(20, "x " + " ".join(words) + " y"), (21, "one two"), (22, "clean")]
    found = decontaminate.find_hits(docs(spark, rows), many, block_words=2000).collect()
    assert {r.doc_id: list(r.hit_items) for r in found} == {20: ["1"], 21: ["2"], 22: []}
    assert sorted(map(repr, sum((x for x in sent if isinstance(x, list)), []))) == sorted(
        {repr((None if i is None else str(i), t)) for i, t in items})


def test_contamination_report_on_testdata(spark):
    table = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    want = brute.contamination([tuple(r) for r in table.collect()], [tuple(r) for r in benchmark.collect()])
    got = decontaminate.contamination_report(table, benchmark).collect()
    assert brute.key((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == brute.key(
        (d, n, len(h), len(x), brute.sha(",".join(sorted(x))), bool(h)) for d, n, h, x in want)


def test_removal_of_spans_and_documents(spark):
    benchmark, _, words = bench(spark)
    passage = " ".join(words)
    df = docs(spark, [(1, f"before {passage}, after"), (2, "clean text"), (3, None)]).withColumn("Hit_Ranges", F.lit("x"))
    cut = {r.doc_id: r for r in decontaminate.decontaminate(df, benchmark, remove="span").collect()}
    assert cut[1].text == "before , after" and cut[2].text == "clean text" and cut[3].text is None
    left = decontaminate.decontaminate(df, benchmark).collect()
    assert sorted(r.doc_id for r in left) == [2, 3] and left[0].Hit_Ranges == "x"
    assert decontaminate.decontaminate(df, benchmark.limit(0)).count() == 3
    assert decontaminate.contamination_report(df.limit(0), benchmark).count() == 0


def test_empty_tables(spark):
    empty = docs(spark, [])
    assert secrets.secret_report(empty).count() == 0
    assert pii.pii_report(empty).count() == 0
