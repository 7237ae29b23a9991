"""SQL twins (DuckDB) of the queries that SQL can express.

Without one: op1 (merge agendas), op4 (alignment), op7 (trees), op8 and op9 (trained models); these are
tested by round trips, brute force and held-out accuracy in tests/llm.
"""

from __future__ import annotations

from tickerloom.llm import mixing, topk, urlfilter

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
win AS (
  SELECT rid, i, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)
),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win WHERE c IS NOT NULL),
pos AS (SELECT rid, count(DISTINCT i + k) AS n_repeat FROM rep, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY rid),
top AS (SELECT rid, max(n) AS top_n FROM (SELECT rid, count(*) AS n FROM w GROUP BY rid, word) GROUP BY rid),
per AS (
  SELECT rid, sum(length(word)) AS word_chars,
    count(*) FILTER (WHERE regexp_matches(word, '[A-Z]') AND NOT regexp_matches(word, '[a-z]')) AS shouted,
    count(*) FILTER (WHERE NOT regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS plain
  FROM w GROUP BY rid
),
f AS (
  SELECT d.rid, doc_id, len(ws) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(n_repeat, 0) AS n_repeat_words, coalesce(shouted, 0) AS shouted, coalesce(plain, 0) AS plain, coalesce(top_n, 0) AS top_n
  FROM d LEFT JOIN per USING (rid) LEFT JOIN pos USING (rid) LEFT JOIN top USING (rid)
),
g AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM f
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 20 * n_words OR 2 * shouted > n_words OR 2 * n_dup_lines > len(lines)
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 5 * plain > 2 * n_words OR 10 * top_n > 3 * n_words) AS kept
FROM g
"""


def topk_sql() -> str:
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({topk.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.rid <> v.rid AND len(q.e) = len(v.e) WHERE q.vec_id % 100 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {topk.K}
"""


def url_sql() -> str:
    rules = sorted(urlfilter.SITE_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"('.' || host) LIKE '%.{host}' AND starts_with(path, '{path}')", f"{host}{path}", verdict) for verdict, host, path in rules]
    rule = " ".join(f"WHEN {fit} THEN '{name}'" for fit, name, _ in fits)
    verdict = " ".join(f"WHEN {fit} THEN '{says}'" for fit, _, says in fits)
    words = " OR ".join(f"host LIKE '%{word}%'" for word in urlfilter.HOST_WORDS)
    return rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM u
)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN {words} OR path LIKE '%/ads/%' OR path LIKE '/%.exe' THEN 'block' ELSE 'allow' END AS verdict
FROM h
"""


def _seats(votes: str, seats: str) -> str:
    """Low and high numbers of seats between which the cut lies."""
    at = f"CASE WHEN all_v > 0 THEN CAST(floor({votes} * {{house}} / all_v + 0.5) AS BIGINT) ELSE 0 END"
    return f"{at.format(house=f'greatest({seats} - n_v, 0)')} AS low, {at.format(house=f'({seats} + n_v)')} AS high"


def mix_sql() -> str:
    m = mixing
    weights = "[" + ", ".join(map(str, m.WEIGHTS)) + "]"

    def key(part: str, *cols: str) -> str:
        return f"CAST('0x' || substr(md5(concat_ws(':', '{m.SEED}/{part}', {', '.join(f'coalesce(CAST({c} AS VARCHAR), {chr(39) * 2})' for c in cols)})), 1, 15) AS BIGINT)"

    turns = " + ".join(
        f"greatest(0, least(starts + {k} * around + size, lead_ + drawn) - greatest(starts + {k} * around, lead_))" for k in range(m.MAX_EPOCHS + 1)
    )
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_rows FROM d GROUP BY source),
w AS (SELECT *, CAST({weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(m.WEIGHTS)} + 1] AS DOUBLE) AS weight FROM s),
f AS (
  SELECT *, source_size * {float(m.MAX_EPOCHS)}::DOUBLE AS lim,
    CAST(sum(source_size) OVER () AS DOUBLE) * {m.TOTAL_PCT / 100}::DOUBLE
      - coalesce(sum(source_size * {float(m.MAX_EPOCHS)}::DOUBLE) OVER p, 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS open_w, source_size / weight AS fill
  FROM w WINDOW p AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
r AS (SELECT rest AS at_rest, open_w AS at_open FROM f WHERE weight * rest / open_w <= lim ORDER BY fill, rest, open_w LIMIT 1),
t AS (SELECT source, source_size, least(weight * at_rest / at_open, lim) AS target FROM f, r),
t2 AS (SELECT *, sum(target) OVER () AS all_v, count(*) OVER () AS n_v, CAST(round(sum(target) OVER () / {m.BLOCK_WORDS}) AS BIGINT) AS seats FROM t),
t3 AS (SELECT *, {_seats('target', 'seats')} FROM t2),
t4 AS (SELECT *, seats - CAST(sum(low) OVER () AS BIGINT) AS open_s FROM t3),
q AS (SELECT source, target, open_s, unnest(range(low + 1, high + 1)) AS seat FROM t4),
won AS (
  SELECT source, count(*) AS n FROM (SELECT *, row_number() OVER (ORDER BY target / (2 * seat - 1) DESC, source NULLS LAST, seat) AS place FROM q)
  WHERE place <= open_s GROUP BY source
),
g AS (
  SELECT t4.source, source_size, target, low + coalesce(won.n, 0) AS source_quota,
    least({m.MAX_SHARDS}, greatest(1, CAST(ceil((source_size + (SELECT n_rows FROM s WHERE s.source IS NOT DISTINCT FROM t4.source)) / {m.SHARD_WORDS}) AS BIGINT))) AS shards
  FROM t4 LEFT JOIN won ON t4.source IS NOT DISTINCT FROM won.source
),
e AS (
  SELECT d.*, g.source_size, g.target, source_quota, {key('shard', 'doc_id')} % shards AS shard FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
),
a AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS around, any_value(source_quota) AS seats FROM e GROUP BY source, shard),
a2 AS (SELECT *, CAST(sum(around) OVER (PARTITION BY source) AS DOUBLE) AS all_v, count(*) OVER (PARTITION BY source) AS n_v FROM a),
a3 AS (SELECT *, {_seats('around', 'seats')} FROM a2),
a4 AS (SELECT *, seats - CAST(sum(low) OVER (PARTITION BY source) AS BIGINT) AS open_s FROM a3),
aq AS (SELECT source, shard, around, open_s, unnest(range(low + 1, high + 1)) AS seat FROM a4),
awon AS (
  SELECT source, shard, count(*) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY around / (2 * seat - 1) DESC, shard, seat) AS place FROM aq)
  WHERE place <= open_s GROUP BY source, shard
),
c AS (
  SELECT a4.source, a4.shard, around,
    ({key('lead', 'a4.source', 'a4.shard')} % greatest(1, CAST(ceil(around / {m.BLOCK_WORDS}) AS BIGINT)) * {m.BLOCK_WORDS}) % greatest(1, around) AS lead_,
    least((low + coalesce(awon.n, 0)) * {m.BLOCK_WORDS}, around * {m.MAX_EPOCHS}) AS drawn
  FROM a4 LEFT JOIN awon ON a4.source IS NOT DISTINCT FROM awon.source AND a4.shard = awon.shard
),
o AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source, shard ORDER BY {key('doc', 'doc_id')}, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS starts FROM e
)
SELECT doc_id, size, source_size, target, CAST({turns} AS BIGINT) AS taken
FROM o JOIN c ON o.source IS NOT DISTINCT FROM c.source AND o.shard = c.shard
"""


NEARDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM d
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""


FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM d),
k AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2,
    ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4
  FROM u
),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h IS NULL OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k
),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:n], '') AS suf
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

CONTROL = r"[<\[]\\*(\||/?s>|/?INST\])"

CHAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, r, x) AS k,
    length('<|im_start|>') + length(r) + len(regexp_extract_all(r, '{CONTROL}')) + length('<|im_sep|>')
      + length(x) + len(regexp_extract_all(x, '{CONTROL}')) + length('<|im_end|>') + 1 AS piece_len
  FROM t
),
c AS (
  SELECT *, sum(piece_len) OVER (PARTITION BY conv_id ORDER BY k) AS cum, max(k) OVER (PARTITION BY conv_id) AS nt FROM e
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY k) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(cum) FILTER (WHERE r = 'assistant'), 0) + coalesce(max(CASE WHEN k = nt AND r <> 'assistant' THEN cum END), 0) AS BIGINT)
    AS formatted_chars
FROM c GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mix_sources": mix_sql(),
        "op3_exact_topk": topk_sql(),
        "op5_minhash_neardup": NEARDUP,
        "op6_url_filter": url_sql(),
        "op10_quality_rules": QUALITY,
        "op11_fill_in_middle": FIM,
        "op13_chat_format": CHAT,
    }
