"""DuckDB SQL of the corpus queries that SQL expresses: URL filters, vector links, n-gram groups, top-k, archives, clusters."""

from __future__ import annotations

from .url_filter import REFERENCES, Rule


def rule_sql(host: str, path: str, rules: list[Rule], what: str) -> str:
    ordered = sorted(rules, key=lambda r: -len(r.name))
    whens = " ".join(f"WHEN ({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}') THEN '{getattr(r, what)}'" for r in ordered)
    return f"CASE {whens} END"


def url_filter_sql(rules: list[Rule]) -> str:
    """Own rules by text functions, aliases by a recursive closure over links that are resolved segment by segment."""

    def lower(h: str) -> str:
        return f"translate({h}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def rest(u: str) -> str:
        return f"substr({u}, strpos({u}, '://') + 3)"

    def plain(path: str) -> str:
        return f"""CASE WHEN NOT regexp_matches({path}, '(^|/)[.][.]?(/|$)') THEN {path} ELSE (SELECT '/' || array_to_string(k, '/') || CASE WHEN w[-1] IN ('.', '..') AND len(k) > 0 THEN '/' ELSE '' END FROM (
  SELECT w, list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(w, lambda x: [x])), lambda a, x: CASE x[1] WHEN '.' THEN a WHEN '..' THEN a[:len(a) - 1] ELSE a || x END) AS k FROM (SELECT string_split(regexp_replace({path}, '^/', ''), '/') AS w))) END"""

    def attribute(tag: str, name: str) -> str:
        return f"""trim(regexp_extract({tag}, '(?is)[\\s"''/]{name}\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1), '"''')"""

    names = "MAP {" + ", ".join("'" + k + "': " + ("chr(9)" if v == "\t" else "chr(10)" if v == "\n" else "'" + v.replace("'", "''") + "'") for k, v in REFERENCES.items()) + "}"
    number = "coalesce(TRY_CAST('0x' || nullif(regexp_extract(x, '^&#[xX]([0-9a-fA-F]+)', 1), '') AS BIGINT), TRY_CAST(regexp_extract(x, '^&#([0-9]+)', 1) AS BIGINT))"

    def decode(t: str) -> str:
        char = f"CASE WHEN {number} BETWEEN 1 AND 55295 OR {number} BETWEEN 57344 AND 1114111 THEN chr(CAST({number} AS INTEGER)) ELSE chr(65533) END"
        return f"""array_to_string(list_transform(regexp_extract_all({t}, '&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z]+;|[^&]+|&'), lambda x: CASE WHEN starts_with(x, '&#') AND length(x) > 2 THEN {char} ELSE coalesce({names}[regexp_extract(x, '^&([A-Za-z]+);$', 1)], x) END), '')"""

    def clean(t: str) -> str:
        return f"regexp_replace(regexp_replace({t}, '^\\s+|\\s+$|[\\t\\n\\r]', '', 'g'), '(?s)#.*$', '')"

    def against(link: str, base: str) -> str:
        head = f"substr({base}, 1, strpos({base}, '://') + 2) || regexp_extract({rest(base)}, '^[^/?#]*')"
        path = f"regexp_extract({rest(base)}, '^[^/?#]*([^?#]*)', 1)"
        return f"""CASE WHEN {link} = '' THEN regexp_replace({base}, '(?s)#.*$', '') WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN CASE WHEN regexp_matches({link}, '(?i)^https?://[^/?#]') THEN {link} END
  WHEN starts_with({link}, '//') THEN CASE WHEN regexp_matches({link}, '^//[^/?#]') THEN substr({base}, 1, strpos({base}, '://')) || {link} END WHEN starts_with({link}, '/') THEN {head} || {link}
  WHEN starts_with({link}, '?') THEN {head} || {path} || {link} ELSE {head} || CASE WHEN contains({path}, '/') THEN regexp_extract({path}, '^(.*/)', 1) ELSE '/' END || {link} END"""

    def host(u: str) -> str:
        return lower(f"regexp_extract({rest(u)}, '^[^/?#]*')")

    def node(u: str) -> str:
        path = f"regexp_extract({rest(u)}, '^[^/?#]*([^?#]*)', 1)"
        return f"{host(u)} || CASE WHEN {path} = '' THEN '/' ELSE {plain(path)} END || regexp_extract({rest(u)}, '^[^?#]*([?][^#]*)', 1)"

    first_base = "list_filter(tags, lambda t: regexp_matches(t, '(?is)^<base\\b.*\\shref\\s*='))[1]"
    is_link, is_refresh = "regexp_matches(tag, '(?i)^<link')", f"regexp_matches(tag, '(?i)^<meta') AND lower({attribute('tag', 'http-equiv')}) = 'refresh'"
    target = f"""CASE WHEN {is_link} THEN CASE WHEN regexp_matches({attribute('tag', 'rel')}, '(?i)(^|\\s)canonical(\\s|$)') THEN {attribute('tag', 'href')} END WHEN {is_refresh} THEN regexp_extract({attribute('tag', 'content')}, '(?is)url\\s*=\\s*[''"]?([^''"\\s]+)', 1) END"""
    return f"""WITH RECURSIVE sources AS (SELECT url, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>', ' ', 'g'), '(?is)<(?:link|meta|base)\\b(?:[^>"'']|"[^"]*"|''[^'']*'')*>') AS tags FROM pages WHERE contains(url, '://') AND regexp_matches(html, '(?i)canonical|refresh')),
 bases AS (SELECT url, tags, {clean(decode(attribute(first_base, 'href')))} AS base FROM sources),
 placed AS (SELECT url, coalesce({against('base', 'url')}, url) AS base, unnest(tags) AS tag FROM bases),
 links AS (SELECT url, base, {target} AS raw FROM placed), cleaned AS (SELECT url, base, {clean(decode('raw'))} AS link FROM links WHERE raw <> ''), ends AS (SELECT url, {against('link', 'base')} AS target FROM cleaned),
 pairs AS (SELECT {node('url')} AS u, {node('target')} AS v FROM ends WHERE target IS NOT NULL), far AS (SELECT u, v FROM pairs WHERE u <> v AND NOT starts_with(u, '/') AND NOT starts_with(v, '/')),
 both_ways AS (SELECT u, v FROM far UNION SELECT v, u FROM far), reach(node, root) AS (SELECT u, u FROM both_ways UNION SELECT b.v, r.root FROM reach r JOIN both_ways b ON b.u = r.node),
 classes AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
 own AS (SELECT node, root, {rule_sql("regexp_extract(node, '^[^/?#]*')", "regexp_extract(node, '^[^/?#]*([^?#]*)', 1)", rules, 'verdict')} AS verdict FROM classes),
 decided AS (SELECT root, coalesce(max(CASE WHEN verdict = 'allow' THEN verdict END), max(verdict)) AS alias_verdict FROM own GROUP BY root),
 judged AS (SELECT page_id, CASE WHEN contains(url, '://') THEN {host('url')} ELSE '' END AS host, CASE WHEN contains(url, '://') THEN regexp_extract({rest('url')}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path, CASE WHEN contains(url, '://') THEN {node('url')} END AS node FROM pages)
SELECT page_id, host, path, {rule_sql('host', 'path', rules, 'name')} AS rule, coalesce({rule_sql('host', 'path', rules, 'verdict')}, alias_verdict, 'allow') AS verdict, alias_verdict FROM judged LEFT JOIN own USING (node) LEFT JOIN decided USING (root)"""


VECTORS_SQL = """WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
 ok AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
 reach(id, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.id WHERE r.root < l.v),
 roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id), n AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept FROM v JOIN roots ON id = vec_id LEFT JOIN n ON u = vec_id"""

TOP_K_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


def groups_sql(k: int, percent: int) -> str:
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {k - 1}], ' ') AS sh FROM w, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS t(i) WHERE len(w) > 0),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 both_ways AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 links AS (SELECT u, v FROM both_ways JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= {percent} * (x.n + y.n - c)),
 reach(id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.id WHERE r.root < l.v),
 roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, root AS component_id FROM w JOIN roots ON id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id"""


WARC_SQL = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
 f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""


def centroids_sql(k: int, rounds: int) -> str:
    """Full search, one table a round."""
    parts = [
        "v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS e FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, e) - 1 AS INTEGER) AS c, e FROM (SELECT e, sha256('2:' || vec_id) AS h FROM v ORDER BY h, e LIMIT {k}))",
    ]
    for i in range(rounds + 1):
        parts.append(f"d{i} AS (SELECT r, c, CAST(list_sum(list_transform(list_zip(v.e, c{i}.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{i}), a{i} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{i} GROUP BY r)")
        if i < rounds:
            parts.append(
                f"s{i} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, unnest(range(1, 65)) AS i FROM v JOIN a{i} USING (r)) GROUP BY c, i), "
                f"m{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e FROM s{i} GROUP BY c), c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} ON m{i}.c = c{i}.c)"
            )
    return f"""WITH {', '.join(parts)}
SELECT vec_id, a{rounds}.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.e, ',')) AS centroid_sha256 FROM v JOIN a{rounds} USING (r) JOIN c{rounds} ON c{rounds}.c = a{rounds}.c"""
