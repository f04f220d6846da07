"""The dealt operators as queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm import (chat, codebooks, itq, minhash, mixing, packing, prefix_trie, quality_fm, quality_rules, secret_scan,
                            shards, suffix_repeats, toxicity)
from ledgerloom.llm.common import table


def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op2_mix(spark, sf_dir):
    mixed = mixing.allocation(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


def op3_minhash(spark, sf_dir):
    return minhash.duplicates(table(spark, sf_dir, "documents"))


def op4_secrets(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_quality_fm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_fm.score(docs, quality_fm.train(docs, table(spark, sf_dir, "labels")))


def op7_itq(spark, sf_dir):
    return itq.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_shards(spark, sf_dir):
    return shards.assign(table(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_chat(spark, sf_dir):
    return chat.digests(chat.format_turns(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op11_codebooks(spark, sf_dir):
    return codebooks.compress(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_suffix_repeats(spark, sf_dir):
    return suffix_repeats.digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_mix, op3_minhash, op4_secrets, op5_packing, op6_quality_fm, op7_itq, op8_shards,
                                   op9_toxicity, op10_chat, op11_codebooks, op12_prefix_trie, op13_suffix_repeats)}

_MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS place, md5(coalesce(text, '')) AS text_md5
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         (source_size * 3)::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE AS words
  FROM s),
c AS (
  SELECT *, sum(cap) OVER o - cap AS caps_before, sum(weight) OVER o - weight AS weight_before, sum(weight) OVER () AS weight_sum
  FROM r WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
u AS (SELECT *, (words - caps_before) / (weight_sum - weight_before) AS unit FROM c),
t AS (
  SELECT source, source_size, weight,
         CASE WHEN cap <= unit * weight THEN cap
              ELSE (SELECT arg_min(unit, caps_before) FROM u WHERE cap > unit * weight) * weight END AS target
  FROM u),
o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.weight,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.text_md5
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, greatest(0, least(size, round(target)::BIGINT - start))
          + greatest(0, least(size, round(target)::BIGINT - source_size - start))
          + greatest(0, least(size, round(target)::BIGINT - source_size * 2 - start)) AS taken,
         least(1.0::DOUBLE, start::DOUBLE / target) * 2.0::DOUBLE / 2.0::DOUBLE AS need,
         CASE weight WHEN 5 THEN [1.5, 1.0, 0.5] WHEN 2 THEN [1.0, 1.0, 1.0] ELSE [0.5, 1.0, 1.5] END::DOUBLE[] AS w
  FROM o),
n AS (
  SELECT *, (w[1] + w[2]) / 4 AS first, need * ((w[1] + w[2]) / 4 + (w[2] + w[3]) / 4) AS x FROM k)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       round(CASE WHEN taken = 0 THEN NULL
            WHEN x <= first THEN CASE WHEN x <= 0 THEN 0.0::DOUBLE
                 ELSE 2.0::DOUBLE * x / (w[1] + sqrt(greatest(w[1] * w[1] + (w[2] - w[1]) * 4.0::DOUBLE * x, 0.0::DOUBLE))) END
            ELSE 0.5::DOUBLE + CASE WHEN x - first <= 0 THEN 0.0::DOUBLE
                 ELSE 2.0::DOUBLE * (x - first) / (w[2] + sqrt(greatest(w[2] * w[2] + (w[3] - w[2]) * 4.0::DOUBLE * (x - first), 0.0::DOUBLE))) END
       END, 9) AS position
FROM n
"""

# Positions of matches: each match is taken together with the text before it, and the lengths add up.
_SECRET_RULES = (
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""",
     r"""(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?""", 0, 6),
    ("access", "AKIA[A-Z0-9]+", "", 20, 0),
    ("hex", "[0-9a-f]+", "", 24, 0),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_", 0, 36),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-", 0, 10),
    ("jwt", "eyJ[A-Za-z0-9_.-]+", "", 40, 0),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-+", "-----BEGIN [A-Z ]*PRIVATE KEY", 0, 5),
)


def _secrets_sql() -> str:
    parts = []
    for kind, (name, regex, head, least, tail) in enumerate(_SECRET_RULES):
        value = f"length(hit) - length(regexp_extract(hit, '^{head}'))" if head else "length(hit)"
        parts.append(f"""
  SELECT doc_id, {kind} AS kind, '{name}' AS name, finish - length(hit) AS start, finish FROM (
    SELECT doc_id, hit, (sum(length(before) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS finish FROM (
      SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS before, unnest(m) AS hit FROM (
        SELECT doc_id, regexp_extract_all(text, '((?s:.*?))({regex})', 1) AS p, regexp_extract_all(text, '((?s:.*?))({regex})', 2) AS m
        FROM documents WHERE text IS NOT NULL)))
  WHERE length(hit) >= {least} AND {value} >= {tail}""")
    union = "\n  UNION ALL".join(parts)
    return f"""
WITH s AS ({union}),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(name || ':' || start || ':' || finish, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
         string_agg(name || ':' || start || ':' || finish, ',' ORDER BY start, kind) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id
"""


_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(text, '(<|\[)(\\*)(/?s>|/?(?:SYS|INST|OUT|ROLE)\])', '\1\\\2\3', 'g')) AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 16 + length(role) END)::BIGINT
         AS formatted_chars
FROM e GROUP BY conv_id
"""

_MINHASH = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                                 ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)),
r(node, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.reached FROM r JOIN e ON r.node = e.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
r(node, reached) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.b, r.reached FROM r JOIN e ON r.node = e.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM embeddings v JOIN c ON c.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""



def _codebooks_sql(rounds: int = 4) -> str:
    """Every part against every entry; integers up to 2^53 are exact in the doubles used."""
    ctes = ["""k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda c: floor(c::DOUBLE * 1024)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS MATERIALIZED (
  SELECT rid, part, x[(part * len(x) // 4 + 1):((part + 1) * len(x) // 4)] AS v FROM k, range(4) t(part)),
b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, v FROM p WHERE rid <= 256)"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, part, any_value(p.v) AS v, min((list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v) + list_inner_product(b.v, b.v)) * 256 + entry) AS m
  FROM p JOIN b{r} b USING (part) GROUP BY rid, part)""")
        if r < rounds:
            ctes.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(n.v, b.v) AS v FROM b{r} b LEFT JOIN (
    SELECT part, entry, list(s ORDER BY i) AS v FROM (
      SELECT part, (m % 256)::BIGINT AS entry, i, floor(sum(x) / count(*)) AS s
      FROM (SELECT part, m, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY ALL) GROUP BY ALL) n USING (part, entry))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda c: c::BIGINT), ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM (SELECT rid, string_agg(printf('%02x', (m % 256)::INT), '' ORDER BY part) AS code, sum(floor(m / 256))::BIGINT AS error FROM a{rounds} GROUP BY rid)
JOIN k USING (rid)
"""


# The CRC-32 of a string, bit by bit: each byte is XORed in and followed by eight shifts.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda d: [ascii(d)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda s, b: xor(xor(s, b) >> 1, (xor(s, b) & 1) * 3988292384)))"""

_TRIE = f"""
WITH t AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(t ORDER BY p) AS own, {_CRC32.format('conv_id::VARCHAR')} % 9 AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, coalesce(b.own[1:c.h], []) || c.own[c.h + 1:] AS path FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 5),
m AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM r),
n AS MATERIALIZED (
  SELECT path[1:depth] AS node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM m GROUP BY path[1:depth]),
k AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.node[n.depth].text) END AS saved
      FROM n LEFT JOIN k ON n.node = k.node),
s AS (SELECT node[1:d] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved
      FROM (SELECT node, n_children, saved, unnest(range(0, depth + 1)) AS d FROM w) GROUP BY node[1:d])
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN s ON s.node = w.node LEFT JOIN n p ON w.depth > 0 AND p.node = w.node[1:w.depth - 1]
"""

# Two hex digits a byte; every 200-byte string by its hash.
_REPEATS = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS MATERIALIZED (
  SELECT rid, i, hash(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT rid, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d)),
s AS (SELECT rid, i FROM k WHERE k IN (SELECT k FROM k GROUP BY k HAVING count(*) > 1)),
g AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM s),
r AS (SELECT rid, min(i) AS a, max(i) + 200 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY i) AS n FROM g) GROUP BY rid, n),
q AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM r),
t AS (
  SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM q JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN t USING (rid)
"""

ORACLE = {"op13_suffix_repeats": _REPEATS, "op11_codebooks": _codebooks_sql(), "op12_prefix_trie": _TRIE, "op2_mix": _MIX, "op3_minhash": _MINHASH, "op4_secrets": _secrets_sql(), "op7_itq": _VECTORS, "op10_chat": _CHAT}
