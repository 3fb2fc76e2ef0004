"""DuckDB SQL for the registered queries that SQL can express (used only for checking).

Missing: the classifier and the page text (learned), the fingerprints (XXH64), personal
data (checksums and context scores), whitening (eigenvectors) and the pipeline, which starts
with the classifier.
Those are tested against brute-force versions.
"""

from __future__ import annotations

from . import lexical, mixing, secrets, url_filter


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM s QUALIFY rank <= 5"""


def op3() -> str:
    patterns = [secrets.ASSIGN, secrets.ACCESS, secrets.HEX, secrets.USER, secrets.OPAQUE, secrets.ENDPOINT]
    found = " UNION ALL ".join(
        f"SELECT rid, {i} AS kind, regexp_extract_all(t, {_q(p)}) AS ms, string_split_regex(t, {_q(p)}) AS ps FROM d"
        for i, p in enumerate(patterns))
    keep = (f"CASE kind WHEN 0 THEN length(regexp_extract(m, {_q(secrets.ASSIGN)}, 2)) >= {secrets.MIN_VALUE} "
            f"WHEN 1 THEN length(m) >= {secrets.MIN_ACCESS} WHEN 2 THEN length(m) >= {secrets.MIN_HEX} "
            "WHEN 3 THEN NOT regexp_matches(right(p, 1), '[A-Za-z0-9]') "
            "WHEN 4 THEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') "
            "ELSE true END")
    # what an underscore joins to a name belongs to it
    ahead = "CASE kind WHEN 3 THEN length(regexp_extract(p, '[A-Za-z0-9_]*_$')) ELSE 0 END"

    def some(kinds: str, where: str) -> str:
        return f"EXISTS (SELECT 1 FROM spans p WHERE p.rid = c.rid AND p.kind IN ({kinds}) AND ({where}))"

    def near(kinds: str) -> str:
        return some(kinds, f"p.s <= c.e + {secrets.SCOPE} AND p.e >= c.s - {secrets.SCOPE}")

    def beside(kinds: str) -> str:
        return some(kinds, f"p.e BETWEEN c.s - {secrets.SCOPE} AND c.s OR p.s BETWEEN c.e AND c.e + {secrets.SCOPE}")
    inside = some("5", "p.s < c.e AND p.e > c.s")
    names = ", ".join(_q(k) for k in secrets.KINDS)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(secrets.BASE_KINDS))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
parts AS (
  SELECT rid, kind, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p, generate_subscripts(ms, 1) AS i FROM found),
placed AS (
  SELECT *, CAST(sum(length(m) + length(p)) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS e FROM parts),
spans AS (SELECT rid, kind, e - length(m) - {ahead} AS s, e FROM placed WHERE {keep}),
kept AS (
  SELECT * FROM spans c WHERE kind < 3 OR (kind = 3 AND ({near('0, 2')} OR {beside('4')}))
    OR (kind = 4 AND (({near('5')} AND NOT {inside}) OR {beside('1, 3')}))
    OR (kind = 5 AND {near('1, 3')} AND {near('0, 2, 4')})),
shown AS (SELECT *, [{names}][kind + 1] || ':' || s || ':' || e AS x FROM kept),
per AS (
  SELECT rid, {counts}, string_agg(x, ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS base,
    string_agg(x, ',' ORDER BY s, kind) AS spans, count(*) FILTER (WHERE kind >= 3) AS n_linked
  FROM shown GROUP BY rid)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in secrets.BASE_KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM d LEFT JOIN per USING (rid)"""


OP4 = """
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1),
j AS (
  SELECT p.*, CASE WHEN p.payload_bytes >= 1000 AND o.original IS NOT NULL AND p.page_id IS DISTINCT FROM o.original
    THEN o.original END AS refers_to FROM p LEFT JOIN o USING (payload_digest))
SELECT page_id, url, payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j"""


def op5() -> str:
    weights = ", ".join(f"CAST({w} AS DOUBLE)" for w in mixing.WEIGHTS)
    word = r"'[^\x20\x09-\x0D]+'"
    upto = "sum(size) OVER (PARTITION BY source, big ORDER BY rank_key, doc_id NULLS FIRST, size)"
    return f"""
WITH d AS (
  SELECT doc_id, source, size, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text_md5 || '|'
      || row_number() OVER (PARTITION BY doc_id, source, text_md5) || '|{mixing.SEED}'), 1, 8) AS BIGINT) AS DOUBLE)
      / CAST(4294967296 AS DOUBLE) AS u
  FROM (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {word})) AS size,
    md5(coalesce(text, '')) AS text_md5 FROM documents)),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [{weights}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
  FROM d GROUP BY source),
caps AS (SELECT *, source_size * CAST({mixing.MOST} AS DOUBLE) AS cap FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER () * CAST({mixing.SHARE} AS DOUBLE) - coalesce(sum(cap) OVER ahead, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER ahead, 0)) AS one_level
  FROM caps WINDOW ahead AS (ORDER BY cap / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (SELECT source, source_size, least(cap, weight * max(one_level) OVER ()) AS target FROM levels),
plan AS (
  SELECT *, floor(c) AS whole, c - floor(c) AS part, target - floor(c) * source_size AS missing FROM (
    SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, CAST({mixing.MOST} AS DOUBLE)) ELSE 0 END AS c
    FROM goal)),
keyed AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.part, p.missing, d.size * {mixing.LARGE} > p.source_size AS big,
    CASE WHEN p.part > 0 THEN u * (1 - part) / ((1 - u) * part) / (1 + u * (1 - part) / ((1 - u) * part)) END AS rank_key
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
ranked AS (SELECT *, {upto} AS upto, part * sum(size) OVER (PARTITION BY source, big) AS own FROM keyed),
bigs AS (
  SELECT *, rank_key IS NOT NULL AND (upto <= own OR (upto - size < own AND upto - own <= own - (upto - size))) AS chosen
  FROM ranked WHERE big),
need AS (
  SELECT p.source, p.missing - coalesce(b.words, 0) AS need FROM plan p LEFT JOIN
    (SELECT source, sum(size) AS words FROM bigs WHERE chosen GROUP BY source) b
    ON p.source IS NOT DISTINCT FROM b.source),
smalls AS (
  SELECT r.*, r.rank_key IS NOT NULL AND (upto <= need OR (upto - size < need AND upto - need <= need - (upto - size)))
    AS chosen FROM ranked r JOIN need n ON r.source IS NOT DISTINCT FROM n.source WHERE NOT r.big)
SELECT doc_id, size, source_size, target, CAST((whole + CAST(chosen AS INTEGER)) * size AS BIGINT) AS taken, source
FROM (SELECT doc_id, source, size, source_size, target, whole, chosen FROM bigs UNION ALL
      SELECT doc_id, source, size, source_size, target, whole, chosen FROM smalls)"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _tokens(text: str) -> str:
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), {word})"


OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_tokens('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_tokens('text')} AS w FROM benchmark),
items AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
grams AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
windows AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT rid, i, n, g FROM windows WHERE (n, g) IN (SELECT n, g FROM grams)),
hit_words AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY rid),
hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT h.rid, g.item FROM hits h JOIN grams g ON h.n = g.n AND h.g = g.g WHERE g.item IS NOT NULL)
  GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)"""

OP10 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT rid, place, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
repeats AS (
  SELECT rid, i FROM windows QUALIFY (place, i) > min((place, i)) OVER (PARTITION BY g)),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS pos FROM repeats),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN gone USING (rid, pos) GROUP BY rid),
counts AS (SELECT rid, count(*) AS n_removed FROM gone GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid) LEFT JOIN counts USING (rid)"""

def _terms(text: str) -> str:
    term = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), {term})"


OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_terms('text')} AS w FROM documents),
tf AS (
  SELECT rid, doc_id, n, term, count(*) AS tf
  FROM (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
st AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (
  SELECT iid, item_id, unnest(list_distinct({_terms('text')})) AS term
  FROM (SELECT row_number() OVER () AS iid, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))),
g AS (
  SELECT iid, item_id, rid, doc_id,
    CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll))) AS gain
  FROM i JOIN df USING (term) JOIN tf USING (term), st),
s AS (SELECT iid, item_id, rid, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM g GROUP BY ALL HAVING sum(gain) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
  doc_id, score
FROM s QUALIFY rank <= {lexical.K}"""


def op12() -> str:
    rules = ", ".join(f"({_q(r.host)}, {_q(r.path)}, {_q(r.verdict)})" for r in url_filter.RULES)
    terms = ", ".join(f"({_q(t)}, {int(strict)})" for strict, ts in ((True, url_filter.STRICT), (False, url_filter.SOFT))
                      for t in ts)
    return f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {rules}), terms(term, strict) AS (VALUES {terms}),
p AS (
  SELECT row_number() OVER () AS rid, page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
    CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT rid, page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM p),
fits AS (
  SELECT rid, rhost || rpath AS rule, rverdict FROM u JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) = 1),
hits AS (
  SELECT rid, count(*) FILTER (WHERE strict = 1) AS n_strict, count(*) FILTER (WHERE strict = 0) AS n_soft
  FROM u JOIN terms ON regexp_matches(low, '(^|[^a-z0-9])' || term || '($|[^a-z0-9])') GROUP BY rid),
j AS (
  SELECT u.*, rule, rverdict, coalesce(n_strict, 0) AS n_strict, coalesce(n_soft, 0) AS n_soft,
    {url_filter.LIMIT} * coalesce(n_strict, 0) + coalesce(n_soft, 0) AS weight
  FROM u LEFT JOIN fits USING (rid) LEFT JOIN hits USING (rid))
SELECT page_id, host, path, rule,
  coalesce(rverdict, CASE WHEN weight >= {url_filter.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, n_strict, n_soft, weight
FROM j"""


ORACLE = {"op2_topk": OP2, "op3_secret_scan": op3(), "op4_warc": OP4, "op5_mix": op5(), "op9_decontaminate": OP9,
          "op10_repeats": OP10, "op11_lexical": OP11, "op12_url_filter": op12()}
