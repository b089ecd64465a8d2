"""DuckDB SQL of the registered queries that SQL can express."""

from .line_chunks import FACTOR, LONG_CHARS, MIN_WORDS, SEED_CHARS
from .mixing import Mixture
from .near_vectors import MIN_COSINE
from .warc import MIN_REVISIT


def _common(a: str, b: str) -> str:
    """How many elements at the start of two lists are equal."""
    same = f"list_transform(list_zip({a}, {b}, true), lambda x: x[1] = x[2])"
    return f"coalesce(nullif(list_position({same}, false), 0) - 1, len({same}), 0)"


OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
l AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 12))::BIGINT % 65536 AS h, length(line) AS size FROM l),
e AS (SELECT *, coalesce((lag(h) OVER w * {FACTOR} + h) % {LONG_CHARS} < size, false) OR size >= {LONG_CHARS}
                OR coalesce(lead(size) OVER w >= {LONG_CHARS}, false) AS ends FROM h WINDOW w AS (PARTITION BY rid ORDER BY pos)),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM e),
k AS (SELECT rid, any_value(doc_id) AS doc_id, min(pos) AS start, max(pos) AS stop, list(line ORDER BY pos) AS lines,
             string_agg(line, chr(10) ORDER BY pos) AS passage FROM c GROUP BY rid, chunk),
b AS (SELECT *, list_reverse(CASE WHEN lag(lines) OVER w IS NOT NULL THEN list_concat(list_slice(lag(lines, 2) OVER w, -1, NULL), lag(lines) OVER w) END) AS before, lead(lines) OVER w AS after FROM k WINDOW w AS (PARTITION BY rid ORDER BY start)),
s AS (SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, start) AS nth FROM b WHERE length(passage) >= {SEED_CHARS}),
m AS (SELECT s.rid, f.rid AS of, s.start - f.start AS distance, s.start - {_common("s.before", "f.before")} AS lo,
             s.stop + {_common("s.after", "f.after")} AS hi FROM s JOIN s f ON f.passage = s.passage AND f.nth = 1 WHERE s.nth > 1),
i AS (SELECT *, coalesce(lo > max(hi) OVER (PARTITION BY rid, of, distance ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, true) AS new FROM m),
j AS (SELECT *, sum(new::INT) OVER (PARTITION BY rid, of, distance ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM i),
r AS (SELECT DISTINCT rid, lo, hi FROM (SELECT rid, min(lo) AS lo, max(hi) AS hi FROM j GROUP BY rid, of, distance, run)),
w AS (SELECT r.rid, lo, hi FROM r JOIN d USING (rid)
      WHERE len(regexp_extract_all(array_to_string(string_split(text, chr(10))[lo:hi], chr(10)), '[^\x20\x09-\x0D]+')) >= {MIN_WORDS}),
g AS (SELECT DISTINCT rid, pos FROM (SELECT rid, unnest(range(lo, hi + 1)) AS pos FROM w)),
t AS (SELECT l.rid, string_agg(line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL) AS text, count(g.pos) AS lines_removed
      FROM l LEFT JOIN g ON g.rid = l.rid AND g.pos = l.pos GROUP BY l.rid)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text,
       coalesce(lines_removed, 0) AS lines_removed FROM d LEFT JOIN t USING (rid)"""

OP10 = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
      WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
      ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0
      AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {MIN_COSINE}),
reach AS (SELECT vec_id AS id, vec_id AS node FROM embeddings UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.node),
root AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = x.vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings x JOIN root ON root.id = x.vec_id"""

OP1 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND first < page_id THEN first END AS refers_to FROM f"""


def _case(column: str, weights: dict) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in weights.items()) + " ELSE 1 END" if weights else "1"


def _deal(name: str, nodes: str, parent: str, child: str) -> str:
    """Deal each parent's ``of`` to its children; as the operator, by full children and one level for the others."""
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""{name}_a AS (SELECT *, coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above
      FROM ({nodes}) WINDOW w AS ({by} ORDER BY cap / weight::DOUBLE, {child})),
{name}_f AS (SELECT *, cap * above <= (of - below) * weight AS filled FROM {name}_a),
{name} AS (SELECT *, CASE WHEN filled THEN cap ELSE
             (weight * (of - coalesce(sum(cap) FILTER (filled) OVER ({by}), 0))) // (sum(weight) FILTER (NOT filled) OVER ({by})) END AS budget FROM {name}_f)"""


_M = Mixture()
OP2 = f"""
WITH p AS (SELECT doc_id, coalesce('d' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4), 'other') AS domain,
             coalesce(lang, 'und') AS lang, coalesce(source, 'und') AS source,
             coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {_M.max_epochs} AS cap FROM p GROUP BY ALL HAVING sum(n_tokens) > 0),
{_deal("one", f"SELECT domain, sum(cap) AS cap, {_case('domain', _M.domains)} AS weight, (SELECT least(sum(tokens) * {_M.percent} // 100, sum(cap)) FROM leaf) AS of FROM leaf GROUP BY domain", "", "domain")},
{_deal("two", f"SELECT l.*, {_case('lang', _M.languages)} AS weight, one.budget AS of FROM (SELECT domain, lang, sum(cap) AS cap FROM leaf GROUP BY ALL) l JOIN one USING (domain)", "domain", "lang")},
{_deal("three", f"SELECT leaf.*, {_case('source', _M.sources)} AS weight, two.budget AS of FROM leaf JOIN two USING (domain, lang)", "domain, lang", "source")},
b AS (SELECT domain, lang, source, (budget // tokens)::INT AS whole, (budget % tokens)::BIGINT AS rest FROM three),
h AS (SELECT p.*, whole, rest, md5(concat_ws(':', '{_M.seed}', whole::VARCHAR, doc_id::VARCHAR)) AS h FROM p JOIN b USING (domain, lang, source) WHERE n_tokens > 0),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h) <= rest AS more FROM h)
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(1, whole + 1 + more::INT))::INT AS epoch FROM s"""

OP12 = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT doc_id, sha256(body) AS text_sha256, max(doc_id) OVER (PARTITION BY body) AS keep_id,
             count(*) OVER (PARTITION BY body) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""

ORACLE: dict[str, str] = {"op1_warc_archive": OP1, "op2_hierarchical_mixing": OP2, "op9_line_chunk_dedup": OP9, "op10_embedding_near_dedup": OP10,
                          "op12_exact_dedup": OP12}
