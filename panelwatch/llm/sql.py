"""DuckDB SQL for the rows of the operators that SQL can express."""

from __future__ import annotations

from panelwatch.llm.mixing import SEED
from panelwatch.llm.sharding import RADIX_CHOICES, ROUND_KEYS, scramble

_WORDS = r"[^\x20\x09-\x0D]+"


def _escaped(column: str) -> str:
    out = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for c in ("<s>", "</s>", "[INST]", "[/INST]"):
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<s>') + length(replace({_escaped('role')}, chr(10), '<\\n>')) + 1 + length({_escaped('text')})
      + CASE WHEN role = 'assistant' THEN length('</s>') ELSE length('[INST] ') + length(' [/INST]') END + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

MIX = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size,
    md5('{SEED}:' || doc_id || ':' || md5(coalesce(text, ''))) AS key
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), leveled AS (
  SELECT *, 3 * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER fill, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER fill, 0))::DOUBLE AS level
  FROM per
  WINDOW fill AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targeted AS (
  SELECT source, source_size,
    CASE WHEN cap <= weight * level THEN cap::DOUBLE
      ELSE weight * max(level) FILTER (cap > weight * level) OVER () END AS target
  FROM leveled
), placed AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS past
  FROM sized JOIN targeted ON sized.source IS NOT DISTINCT FROM targeted.source
)
SELECT doc_id, size, source_size, target,
  (coalesce(budget // nullif(source_size, 0), 0) * size
    + greatest(0, least(size, budget - coalesce(budget // nullif(source_size, 0), 0) * source_size - past)))::BIGINT AS taken
FROM placed
"""


def _network(x: str, a: str, b: str) -> str:
    """A subquery that sends column ``x`` of ``from_rows`` through all rounds, one select per round."""
    inner = f"SELECT *, {x} // {b} AS l, {x} % {b} AS r FROM from_rows"
    for i, k in enumerate(ROUND_KEYS):
        new_l = f"(l + {scramble('r', k, 'duckdb')}) % {a}" if i % 2 == 0 else "l"
        new_r = "r" if i % 2 == 0 else f"(r + {scramble('l', k, 'duckdb')}) % {b}"
        inner = f"SELECT * REPLACE ({new_l} AS l, {new_r} AS r) FROM ({inner})"
    return inner


_BYTE = "list_transform(range(256), lambda v: list_reduce(list_concat([v], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END))"

SHARD = f"""
WITH RECURSIVE hexed AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), crc_table AS (
  SELECT {_BYTE} AS t
), sized AS (
  SELECT doc_id, (n + 1)::BIGINT AS size,
    xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(n), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
      lambda c, v: xor(t[(xor(c, v) % 256 + 1)::BIGINT], c // 256)))::BIGINT AS text_crc32
  FROM hexed, crc_table
), total AS (
  SELECT count(*) AS n, floor(sqrt(count(*)))::BIGINT AS root FROM sized
), side AS (
  SELECT n, a, (n + a - 1) // a AS b FROM total, range(greatest(1, root - {RADIX_CHOICES}), root + 1) g(a)
  ORDER BY (a - n % a) % a, a DESC LIMIT 1
), walk AS (
  SELECT doc_id, size, text_crc32, row_number() OVER (ORDER BY doc_id NULLS LAST, text_crc32, size) - 1 AS p, n, a, b, 0 AS steps FROM sized, side
  UNION ALL
  SELECT doc_id, size, text_crc32, l * b + r AS p, n, a, b, steps + 1
  FROM ({_network('p', 'a', 'b').replace('from_rows', '(SELECT * FROM walk WHERE steps = 0 OR p >= n)')})
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % 16)::INT AS shard, (p // 16)::BIGINT AS slot, NULL::INT AS grown_shard
FROM walk WHERE steps > 0 AND p < n
"""


def _clusters(rounds: int) -> str:
    ctes = """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS w FROM kept ORDER BY c LIMIT 16
)"""
    for i in range(rounds + 1):
        ctes += f""", a{i} AS MATERIALIZED (
  SELECT rid, min(struct_pack(d := list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, c := c)) AS best
  FROM kept, c{i} GROUP BY rid
)"""
        if i < rounds:
            ctes += f""", s{i} AS (
  SELECT best.c AS c, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM kept) JOIN a{i} USING (rid) GROUP BY best.c, pos
), c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.w, c{i}.w) AS w
  FROM c{i} LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS w FROM s{i} GROUP BY c) m USING (c)
)"""
    return f"""
WITH {ctes}
SELECT vec_id, best.c::INT AS cluster, best.d AS distance,
  sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(w, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (rid) JOIN c{rounds} ON best.c = c
"""


CLUSTERS = _clusters(3)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), f AS MATERIALIZED (
  SELECT lang, p, count(*) AS f FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p FROM split, range(1, 5) t(k)
  ) GROUP BY lang, p
), total AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(p) = 1 GROUP BY lang
), candidates AS MATERIALIZED (
  SELECT lang, p, f AS a FROM f WHERE len(p) >= 2 AND f >= 30
), cuts AS (
  SELECT c.lang, c.p, c.a, min(struct_pack(score := 2000000::HUGEINT * c.a // (x.f + y.f), k := k, l := x.f, r := y.f)) AS best
  FROM candidates c JOIN range(1, 4) t(k) ON k < len(c.p)
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:]
  GROUP BY c.lang, c.p, c.a
), longer AS (
  SELECT lang, p[i:i + k - 1] AS p, max(a) AS a FROM candidates, range(2, 4) s(k), range(1, 4) t(i)
  WHERE len(p) > k AND i + k - 1 <= len(p) GROUP BY ALL
), ranked AS (
  SELECT cuts.lang, array_to_string(cuts.p, ' ') AS phrase, cuts.a, best.l AS l, best.r AS r, best.score::BIGINT AS score
  FROM cuts LEFT JOIN longer USING (lang, p) WHERE longer.a IS NULL OR 100 * longer.a < 80 * cuts.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked
) JOIN total USING (lang) WHERE rank <= 2000
"""
