"""DuckDB SQL for the operators that SQL can express."""

# Words per document, per-source sums, water filling, and the seeded draw.
OP7 = r"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  CAST('0x' || substr(md5('20011|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 13) AS BIGINT)::DOUBLE
                    / 4503599627370496.0 AS draw FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
wgt AS (SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS BIGINT)]::DOUBLE AS weight,
               source_size * 3.0::DOUBLE AS ceiling FROM per),
lvl AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(ceiling) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                  / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM wgt WINDOW f AS (ORDER BY ceiling / weight, source IS NULL, source)),
fre AS (SELECT min(ceiling / weight) AS r, arg_min(level, ceiling / weight) AS level FROM lvl WHERE ceiling > level * weight),
tgt AS (SELECT l.source, l.source_size, CASE WHEN l.ceiling <= l.level * l.weight THEN l.ceiling
                                             ELSE least(f.level * l.weight, l.ceiling) END AS target FROM lvl l, fre f),
rat AS (SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
        FROM s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rat
"""

_ESC = r"replace(replace({c}, '\', '\\'), '<|', '<\|')"
_ROLE, _TEXT = _ESC.format(c="role"), _ESC.format(c="text")

OP9 = rf"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (
  SELECT *, row_number() OVER w AS rn, lag(role) OVER w AS before, lead(role) OVER w AS after FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (
  SELECT *, length({_TEXT}) + CASE WHEN before IS NULL OR before <> role
              THEN length({_ROLE}) + length('<|turn|><|text|>') ELSE length('<|next|>') END
            + CASE WHEN after IS NULL OR after <> role THEN length('<|end|>') ELSE 0 END AS n
  FROM r)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

_FIELD = "coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
_FIELDS = " || ".join(_FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars"))
# CRC-32 (reflected polynomial 0xEDB88320), byte by byte and bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

# Levels of every tree bottom up, the same for the subroots, then each leaf's
# climb through both.
OP11 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256({_FIELDS} || {_FIELD.format(c="text")}) AS leaf,
         sha256({_FIELDS} || {_FIELD.format(c="(CASE WHEN " + _CRC + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")}) AS claim FROM documents),
g AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)),
p AS (SELECT g.tree, d.doc_id, d.leaf, d.claim, row_number() OVER (PARTITION BY g.tree ORDER BY d.doc_id NULLS FIRST, d.leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY g.tree) AS n FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
low AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM p
  UNION ALL SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
high AS (
  SELECT 0 AS lvl, tree AS pos, count(*) OVER () AS n, h FROM low WHERE n = 1
  UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
runs AS (
  SELECT tree, lvl, pos // 3 AS run, n, list(h ORDER BY pos) AS hs FROM low GROUP BY tree, lvl, pos // 3, n
  UNION ALL SELECT -1, lvl, pos // 3, n, list(h ORDER BY pos) FROM high GROUP BY lvl, pos // 3, n),
climb AS (
  SELECT tree AS own, pos AS own_pos, CASE WHEN n = 1 THEN -1 ELSE tree END AS tree, 0 AS lvl, CASE WHEN n = 1 THEN tree ELSE pos END AS pos,
         claim AS h, '' AS proof, 0 AS step FROM p
  UNION ALL
  SELECT c.own, c.own_pos, CASE WHEN c.tree >= 0 AND r.n <= 3 THEN -1 ELSE c.tree END,
         CASE WHEN c.tree >= 0 AND r.n <= 3 THEN 0 ELSE c.lvl + 1 END, CASE WHEN c.tree >= 0 AND r.n <= 3 THEN c.own ELSE c.pos // 3 END,
         sha256(array_to_string(r.hs[:c.pos % 3] || [c.h] || r.hs[c.pos % 3 + 2:], '')),
         c.proof || array_to_string(r.hs[:c.pos % 3] || r.hs[c.pos % 3 + 2:], ''), c.step + 1
  FROM climb c JOIN runs r ON r.tree = c.tree AND r.lvl = c.lvl AND r.run = c.pos // 3 WHERE r.n > 1),
last AS (SELECT own, own_pos, arg_max(h, step) AS folded, arg_max(proof, step) AS proof FROM climb GROUP BY own, own_pos)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(l.proof) AS proof_sha256, l.folded AS folded_root, l.folded = r.h AS verified
FROM p JOIN last l ON l.own = p.tree AND l.own_pos = p.pos JOIN (SELECT tree, h FROM low WHERE n = 1) s ON s.tree = p.tree
CROSS JOIN (SELECT h FROM high WHERE n = 1) r
"""

OP12 = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= 10
"""

OP13 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, list_transform(regexp_extract_all(t, '[^\n]*\n|[^\n]+'), lambda x: length(x)) AS units,
             list_transform(range(4), lambda i: ('0x' || substr(h, 8 * i + 1, 8))::BIGINT) AS r FROM t),
c AS (SELECT *, len(units)::BIGINT AS n, least(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS a,
             greatest(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
                  WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
k AS (SELECT *, coalesce(list_sum(units[:a]), 0)::BIGINT AS pre, coalesce(list_sum(units[a + 1:b]), 0)::BIGINT AS mid FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN pre END AS prefix_chars, CASE WHEN form <> 'plain' THEN mid END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || substring(t, 1, pre) || '<S>' || substring(t, pre + mid + 1) || '<M>' || substring(t, pre + 1, mid)
              ELSE '<S>' || substring(t, pre + mid + 1) || '<P>' || substring(t, 1, pre) || '<M>' || substring(t, pre + 1, mid) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM k
"""

ORACLE = {"op7_mixing": OP7, "op9_chat": OP9, "op11_merkle": OP11, "op12_topk": OP12, "op13_fim": OP13}
