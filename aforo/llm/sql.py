"""SQL counterparts of the queries that SQL can express."""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY ALL) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.c >= 75 * (na.n + nb.n - p.c)
), reach AS (
  SELECT doc_id AS a, doc_id AS c FROM d
  UNION
  SELECT l.a, r.c FROM links l JOIN reach r ON l.b = r.a AND r.c < l.a
), best AS (SELECT a, min(c) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN best ON best.a = d.doc_id
"""

REPEATED_PASSAGES = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)
), gone AS (
  SELECT DISTINCT s.doc_id, unnest(range(p, p + 50)) AS p
  FROM s JOIN (SELECT h, min(doc_id) AS first FROM s GROUP BY h) f ON f.h = s.h WHERE f.first < s.doc_id
), cut AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(
    list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
"""

URL_FILTER = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(a, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules(h, r, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fit AS (
  SELECT page_id, max_by(struct_pack(rule := h || r, verdict := verdict), length(h || r)) AS best
  FROM p JOIN rules ON starts_with(path, r) AND (host = h OR ends_with(host, '.' || h)) GROUP BY page_id
)
SELECT p.page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM p LEFT JOIN fit ON fit.page_id = p.page_id
"""

# The remainder of crc32, bit by bit: DuckDB has no function for it.
PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id AS c, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
  SELECT c, list(x ORDER BY pos) AS xs, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 9 AS h
  FROM turns GROUP BY c),
rebuilt AS (
  SELECT w.c, list_concat(coalesce(b.xs[1:w.h], []), w.xs[w.h + 1:]) AS xs
  FROM whole w LEFT JOIN whole b ON b.c = w.c - w.c % 5),
prefixes AS (SELECT c, xs, unnest(range(0, len(xs) + 1)) AS d FROM rebuilt),
nodes AS (
  SELECT d, xs[1:d] AS p, min(c) AS c, count(*) AS n,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(xs) = d), '') AS ends
  FROM prefixes GROUP BY ALL),
families AS (
  SELECT n.*, CASE WHEN n.d > 0 THEN (n.n - 1) * strlen(n.p[n.d].t) ELSE 0 END AS own, coalesce(k.n_children, 0) AS n_children
  FROM nodes n LEFT JOIN (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL) k
    ON k.d = n.d AND k.p = n.p),
above AS (SELECT p, own, n_children, unnest(range(0, d + 1)) AS a FROM families),
subtrees AS (
  SELECT p[1:a] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved FROM above GROUP BY ALL)
SELECT f.c AS conv_id, f.d AS depth, u.c AS parent_conv_id, f.n AS n_convs, f.n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM families f JOIN subtrees s ON s.p = f.p
LEFT JOIN nodes u ON u.d = f.d - 1 AND u.p = f.p[1:f.d - 1]
"""
