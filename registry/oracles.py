"""The SQL twin of every query that plain SQL can express, for DuckDB.

Written against the tables, not against the library: each statement is a chain
of common table expressions, picked from the blocks below.
"""

from __future__ import annotations

from tickerloom import lexicon as lx
from tickerloom.sources import feed

W = lx.WORD
B = f"[{lx.BLANKS}]"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def members(values: list[str]) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def array(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def r6(expr: str) -> str:
    return f"(CASE WHEN round({expr}, 6) = 0 THEN 0e0 ELSE round({expr}, 6) END)"


def at(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


AS_OF = "(SELECT max(ts) FROM events)"

POSTS = f"""posts AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id, e.event_id AS feed_pos,
    CASE WHEN e.user_id % 3 = 0 THEN 'trader_' || e.event_type ELSE 'user_' || e.user_id END AS username,
    CASE WHEN e.event_id % 17 = 0 THEN 'ok ' || e.event_type
      ELSE coalesce(d.text, '') || ' ' || ({array(feed.PHRASES)})[e.user_id % 10 + 1] || ' #' || e.event_type
        || CASE WHEN e.event_id % 7 = 0 THEN ' @user_' || e.user_id ELSE '' END
        || CASE WHEN e.event_id % 11 = 0 THEN ' https://ex.com/a?b=1#frag' ELSE '' END
        || CASE WHEN e.event_id % 13 = 0 THEN ' #a #b #c #d #e #f #g #h' ELSE '' END
    END AS content,
    e.ts AS timestamp,
    CAST(floor(e.value) AS BIGINT) AS likes,
    CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS retweets,
    e.user_id % 5 AS replies,
    '#' || e.event_type AS hashtag_source,
    {AS_OF} + INTERVAL 1 MINUTE AS scraped_at
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT max(doc_id) + 1 FROM documents))"""

FLAWED = """flawed AS (
  SELECT * REPLACE (CASE WHEN retweets = 7 THEN '' ELSE username END AS username,
                    CASE WHEN retweets <> 11 THEN content END AS content) FROM posts)"""

VALID_FLAWED = """valid AS (SELECT * FROM flawed WHERE username <> '' AND content <> '' AND timestamp IS NOT NULL)"""

REPEATED = """repeated AS (
  SELECT * FROM posts
  UNION ALL SELECT * REPLACE ('#click' AS hashtag_source, feed_pos + 1000000000 AS feed_pos)
    FROM posts WHERE hashtag_source = '#error'
  UNION ALL SELECT * REPLACE (likes + 1 AS likes, feed_pos + 2000000000 AS feed_pos)
    FROM posts WHERE hashtag_source = '#view')"""

HASH = f"""md5(coalesce(username, '') || '_' || {at('timestamp')} || '_' || coalesce(content, ''))"""


def clean(expr: str) -> str:
    out = f"regexp_replace({expr}, {text(lx.URL_PATTERN)}, '', 'g')"
    out = f"regexp_replace({out}, '@{W}+', '', 'g')"
    out = f"regexp_replace({out}, '#({W}+)', '\\1', 'g')"
    out = f"regexp_replace({out}, '{B}+', ' ', 'g')"
    return f"lower(trim({out}))"


TAGS = f"regexp_extract_all(content, '#({W}+)', 1)"
MENTIONS = f"regexp_extract_all(content, '@({W}+)', 1)"

CLEANED = f"""cleaned AS MATERIALIZED (
  SELECT *, string_split(content_cleaned, ' ') AS tokens
  FROM (SELECT *, {clean('content')} AS content_cleaned FROM posts))"""

SENTIMENT = (
    f"CASE WHEN content_cleaned = '' THEN 0e0 ELSE greatest(-1e0, least(1e0, "
    f"(len(list_filter(tokens, lambda t: t IN {members(lx.POSITIVE_TERMS)}))"
    f" - len(list_filter(tokens, lambda t: t IN {members(lx.NEGATIVE_TERMS)})))::DOUBLE / len(tokens))) END"
)
RELEVANT = f"list_has_any(tokens, {array(lx.MARKET_TERMS)})"
WORDS = f"list_filter(regexp_split_to_array(content, '{B}+'), lambda w: w <> '')"

ENRICHED_ALL = f"""enriched_all AS MATERIALIZED (
  SELECT *, least(1e0, 1e0 * (CASE WHEN is_potential_bot THEN 0.5e0 ELSE 1e0 END)
      * (CASE WHEN has_market_keywords THEN 1.2e0 ELSE 1e0 END)
      * (CASE WHEN total_engagement > 10 THEN 1.1e0 ELSE 1e0 END)
      * (CASE WHEN content_length < 20 OR content_length > 250 THEN 0.8e0 ELSE 1e0 END)
      * (CASE WHEN hashtag_count BETWEEN 1 AND 5 THEN 1.1e0 WHEN hashtag_count > 8 THEN 0.7e0 ELSE 1e0 END)
    ) AS quality_score
  FROM (
    SELECT *, total_engagement / (content_length + 1)::DOUBLE AS engagement_rate,
      (CASE WHEN length(username) > 15 OR regexp_matches(right(username, 3), '\\d') THEN 1 ELSE 0 END
       + CASE WHEN content_length < 10 OR content_length > 280 THEN 1 ELSE 0 END
       + CASE WHEN content_length > 0 AND total_engagement / content_length::DOUBLE > 5 THEN 1 ELSE 0 END
       + CASE WHEN len(words) > 5 AND len(list_distinct(words)) < len(words) * 0.5e0 THEN 1 ELSE 0 END) >= 2
        AS is_potential_bot
    FROM (
      SELECT *, length(content)::INTEGER AS content_length, length(content_cleaned)::INTEGER AS cleaned_length,
        hour(timestamp)::INTEGER AS hour, dayname(timestamp) AS day_of_week,
        likes + retweets + replies AS total_engagement,
        len({TAGS})::INTEGER AS hashtag_count, len({MENTIONS})::INTEGER AS mention_count,
        array_to_string({TAGS}, ',') AS hashtags_str, array_to_string({MENTIONS}, ',') AS mentions_str,
        {RELEVANT} AS has_market_keywords, {SENTIMENT} AS sentiment_score, {WORDS} AS words
      FROM cleaned)))"""

ENRICHED = "enriched AS (SELECT * FROM enriched_all WHERE quality_score >= 0.3e0)"

# The blocks' only non-ASCII characters are letters; as 'z' they bound words
# for this engine just as letters do.
PLAIN = "regexp_replace(content_cleaned, '[^\\x00-\\x7F]', 'z', 'g')"


def leaning(groups: list[list[str]], words: list[str]) -> str:
    parts = ["0e0"]
    for group in groups:
        choices = "|".join(p.replace(" ", " +") for p in group)
        parts.append(f"len(regexp_extract_all(plain, '\\b(?:{choices})\\b')) * 0.2e0")
    parts += [f"CASE WHEN contains(content_cleaned, {text(w)}) THEN 0.1e0 ELSE 0e0 END" for w in words]
    return f"least(1e0, {' + '.join(parts)})"


BULLISH = leaning(lx.BULLISH_PHRASES, lx.BULLISH_WORDS)
BEARISH = leaning(lx.BEARISH_PHRASES, lx.BEARISH_WORDS)
VOLATILITY = "least(1e0, 0e0 + " + " + ".join(
    f"CASE WHEN contains(content_cleaned, {text(w)}) THEN 0.15e0 ELSE 0e0 END" for w in lx.VOLATILITY_WORDS
) + ")"


def age(expr: str = "timestamp") -> str:
    return f"((epoch_us({AS_OF}) - epoch_us({expr})) / 3.6e9)"


LEXICON = f"""lexicon AS MATERIALIZED (
  SELECT *, composite_sentiment * ln(1e0 + total_engagement) AS weighted_sentiment,
    composite_sentiment * time_decay AS time_weighted_sentiment
  FROM (SELECT *, (bullish_score - bearish_score + sentiment_score) / 3e0 AS composite_sentiment
    FROM (SELECT * EXCLUDE (words, tokens), {BULLISH} AS bullish_score, {BEARISH} AS bearish_score,
        {VOLATILITY} AS volatility_score, exp(-{age()} / 12e0) AS time_decay
      FROM (SELECT *, {PLAIN} AS plain FROM enriched))))"""

SIGNALS = [n for n in lx.SIGNAL_WEIGHTS if n != "tfidf_momentum"]


def unit(name: str) -> str:
    return (
        f"CASE WHEN b.{name}_max <> b.{name}_min THEN 2e0 * ({name} - b.{name}_min)"
        f" / (b.{name}_max - b.{name}_min) - 1e0 ELSE 0e0 END AS {name}_normalized"
    )


def composite(source: str, names: list[str], out: str) -> str:
    bounds = ", ".join(f"min({n}) AS {n}_min, max({n}) AS {n}_max" for n in names)
    norms = [f"{n}_normalized" for n in names]
    primary = "0e0 + " + " + ".join(f"{lx.SIGNAL_WEIGHTS[n]}e0 * {n}_normalized" for n in names)
    mean = f"(({' + '.join(norms)}) / {len(norms)})"
    squares = " + ".join(f"({n} - {mean}) * ({n} - {mean})" for n in norms)
    return f"""{out}_bounds AS (SELECT {bounds}, max(total_engagement) AS highest FROM {source}),
{out} AS MATERIALIZED (
  SELECT *, abs(primary_signal) AS signal_strength, sign(primary_signal)::DOUBLE AS signal_direction,
    CASE WHEN primary_signal > 0.3e0 AND confidence_score > 0.5e0 THEN 'BUY'
         WHEN primary_signal < -0.3e0 AND confidence_score > 0.5e0 THEN 'SELL' ELSE 'HOLD' END AS trading_signal
  FROM (SELECT *, {primary} AS primary_signal,
      (1e0 - row_std) * ln(1e0 + total_engagement) / ln(1e0 + (highest + 1)) AS confidence_score
    FROM (SELECT *, sqrt(({squares}) / {len(norms) - 1}) AS row_std
      FROM (SELECT s.*, b.highest, {', '.join(unit(n) for n in names)} FROM {source} s, {out}_bounds b))))"""


SCORED = composite("lexicon", SIGNALS, "scored")

TERMS = f"""texts AS (
  SELECT id, content_cleaned, lower(trim(regexp_replace(regexp_replace(
    content_cleaned, '{lx.NOT_WORD_OR_BLANK}', ' ', 'g'), '{B}+', ' ', 'g'))) AS feature_text FROM cleaned),
eligible AS (
  SELECT * FROM texts WHERE length(content_cleaned) >= 10
    AND feature_text <> '' AND len(string_split(feature_text, ' ')) >= 3),
singles AS (
  SELECT t.id, e.id IS NOT NULL AS ok, CASE WHEN e.id IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_filter(string_split(t.feature_text, ' '),
    lambda w: regexp_full_match(w, '[a-zA-Z][a-zA-Z0-9]*') AND w NOT IN {members(lx.STOP_WORDS)}) END AS s
  FROM texts t LEFT JOIN eligible e ON e.id = t.id),
terms AS MATERIALIZED (
  SELECT id, ok, list_concat(s, list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1])) AS terms FROM singles)"""

VOCABULARY = """pairs AS MATERIALIZED (
  SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(terms) AS term FROM terms) GROUP BY id, term),
vocabulary AS MATERIALIZED (
  SELECT term, sum(tf)::BIGINT AS corpus_count, count(*) AS doc_count, n AS texts
  FROM pairs, (SELECT count(*) AS n FROM terms WHERE ok)
  GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.8e0 * n
  ORDER BY corpus_count DESC, term LIMIT 1000)"""

WEIGHTS = """raw_weights AS (
  SELECT id, term, tf * (ln((texts + 1e0) / (doc_count + 1e0)) + 1e0) AS w FROM pairs JOIN vocabulary USING (term)),
norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM raw_weights GROUP BY id),
weights AS MATERIALIZED (SELECT id, term, w / norm AS weight FROM raw_weights JOIN norms USING (id))"""

GRAM = """gram AS MATERIALIZED (
  SELECT x.term AS a, y.term AS b, sum(x.weight * y.weight) AS product FROM weights x JOIN weights y ON y.id = x.id GROUP BY x.term, y.term)"""

# Each step shrinks what is not the first component by the ratio of the first two eigenvalues, about one half.
POWER_STEPS = 80
MOMENTUM = f"""power AS (
  SELECT 0 AS step, term, 1e0 AS v FROM vocabulary
  UNION ALL
  SELECT step, term, v / sqrt(sum(v * v) OVER ()) FROM (
    SELECT p.step + 1 AS step, g.a AS term, sum(g.product * p.v) AS v
    FROM power p JOIN gram g ON g.b = p.term WHERE p.step < {POWER_STEPS} GROUP BY p.step, g.a)),
loadings AS MATERIALIZED (SELECT term, v * (SELECT sign(max_by(v, abs(v))) FROM power WHERE step = {POWER_STEPS}) AS v FROM power WHERE step = {POWER_STEPS}),
projected AS (
  SELECT t.id, t.ok, coalesce(p.value, 0e0) AS value FROM terms t
  LEFT JOIN (SELECT id, sum(weight * v) AS value FROM weights JOIN loadings USING (term) GROUP BY id) p ON p.id = t.id),
momentum AS MATERIALIZED (
  SELECT id, CASE WHEN ok THEN (value - mean) / std ELSE 0e0 END AS tfidf_momentum
  FROM projected, (SELECT avg(value) AS mean, stddev_pop(value) AS std FROM projected WHERE ok))"""

# Two singular values by power iteration, the second on the Gram matrix deflated by the first.
SPECTRUM_STEPS = 150
SPECTRUM = f"""first_power AS (
  SELECT 0 AS step, term, 1e0 AS v FROM vocabulary
  UNION ALL
  SELECT step, term, v / sqrt(sum(v * v) OVER ()) FROM (
    SELECT p.step + 1 AS step, g.a AS term, sum(g.product * p.v) AS v
    FROM first_power p JOIN gram g ON g.b = p.term WHERE p.step < {SPECTRUM_STEPS} GROUP BY p.step, g.a)),
first_vector AS MATERIALIZED (SELECT term, v FROM first_power WHERE step = {SPECTRUM_STEPS}),
first_value AS MATERIALIZED (
  SELECT sum(x.v * g.product * y.v) AS lam FROM first_vector x JOIN gram g ON g.a = x.term JOIN first_vector y ON y.term = g.b),
deflated AS MATERIALIZED (
  SELECT x.term AS a, y.term AS b, coalesce(g.product, 0e0) - (SELECT lam FROM first_value) * x.v * y.v AS product
  FROM first_vector x CROSS JOIN first_vector y LEFT JOIN gram g ON g.a = x.term AND g.b = y.term),
second_power AS (
  SELECT 0 AS step, term, (hash(term) % 1000)::DOUBLE / 1000e0 - 0.5e0 AS v FROM vocabulary
  UNION ALL
  SELECT step, term, v / sqrt(sum(v * v) OVER ()) FROM (
    SELECT p.step + 1 AS step, g.a AS term, sum(g.product * p.v) AS v
    FROM second_power p JOIN deflated g ON g.b = p.term WHERE p.step < {SPECTRUM_STEPS} GROUP BY p.step, g.a)),
second_vector AS MATERIALIZED (SELECT term, v FROM second_power WHERE step = {SPECTRUM_STEPS}),
second_value AS MATERIALIZED (
  SELECT sum(x.v * g.product * y.v) AS lam FROM second_vector x JOIN deflated g ON g.a = x.term JOIN second_vector y ON y.term = g.b),
energy AS (SELECT coalesce(sum(weight * weight), 0e0) AS e FROM weights)"""

ATTENTION = "attention AS (SELECT id, sqrt(sum(weight * weight)) AS attention FROM weights GROUP BY id)"
FEATURED = """featured AS MATERIALIZED (
  SELECT l.*, m.tfidf_momentum, coalesce(a.attention, 0e0) AS market_attention
  FROM lexicon l JOIN momentum m ON m.id = l.id LEFT JOIN attention a ON a.id = l.id)"""

UP_TO_CLEANED = [POSTS, CLEANED]
UP_TO_ENRICHED = [*UP_TO_CLEANED, ENRICHED_ALL, ENRICHED]
UP_TO_LEXICON = [*UP_TO_ENRICHED, LEXICON]
UP_TO_SCORED = [*UP_TO_LEXICON, SCORED]
UP_TO_TERMS = [*UP_TO_CLEANED, TERMS]
UP_TO_VOCABULARY = [*UP_TO_TERMS, VOCABULARY]
UP_TO_WEIGHTS = [*UP_TO_VOCABULARY, WEIGHTS]
UP_TO_MOMENTUM = [*UP_TO_WEIGHTS, GRAM, MOMENTUM]
# The full run draws its terms from the posts that pass the quality cut.
UP_TO_FULL = [
    *UP_TO_LEXICON, TERMS.replace("FROM cleaned", "FROM enriched"), VOCABULARY, WEIGHTS, GRAM, MOMENTUM, ATTENTION, FEATURED,
    composite("featured", list(lx.SIGNAL_WEIGHTS), "full_scored"),
]


def statement(blocks: list[str], body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(blocks) + "\n" + body


MEANS = ["primary_signal", "confidence_score", "signal_strength", "composite_sentiment"]
SUMS = ["total_engagement", "likes", "retweets", "replies"]


def trend(seconds: int, source: str = "scored", name: str = "trend") -> str:
    """Gap-filled series of one bucket width, from midnight of the first day."""
    means = ", ".join(f"avg({m}) AS {m}" for m in MEANS)
    sums = ", ".join(f"sum({s})::BIGINT AS {s}" for s in SUMS)
    width = f"{seconds} * INTERVAL 1 SECOND"
    filled = ", ".join([*MEANS, *(f"coalesce({s}, 0) AS {s}" for s in [*SUMS, "tweet_count"])])
    return f"""{name}_grid AS (
  SELECT unnest(generate_series(
    (SELECT min(b) FROM {name}_buckets), (SELECT max(b) FROM {name}_buckets), {width})) AS b),
{name} AS (
  SELECT b AS bucket, {', '.join(MEANS + SUMS)}, tweet_count,
    CASE WHEN n > 3 AND count(primary_signal) OVER near = 3 THEN avg(primary_signal) OVER near END AS signal_trend,
    CASE WHEN n > 3 THEN primary_signal - lag(primary_signal) OVER (ORDER BY b) END AS momentum_change
  FROM (SELECT g.b, {filled}, count(*) OVER () AS n FROM {name}_grid g LEFT JOIN {name}_buckets k ON k.b = g.b)
  WINDOW near AS (ORDER BY b ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))""", f"""{name}_buckets AS MATERIALIZED (
  SELECT day0 + ((epoch(timestamp)::BIGINT - epoch(day0)::BIGINT) // {seconds}) * {seconds} * INTERVAL 1 SECOND AS b,
    {means}, {sums}, count(username) AS tweet_count
  FROM (SELECT *, (SELECT date_trunc('day', min(timestamp)) FROM {source})::TIMESTAMP AS day0,
      date_trunc('second', timestamp) AS whole FROM {source})
  GROUP BY 1)"""


def trend_blocks(seconds: int, name: str = "trend") -> list[str]:
    filled, buckets = trend(seconds, name=name)
    buckets = buckets.replace("epoch(timestamp)::BIGINT", "epoch(whole)::BIGINT")
    return [buckets, filled]


TREND_COLUMNS = ", ".join(
    [f"{at('bucket')} AS bucket", *(f"{r6(m)} AS {m}" for m in MEANS), *SUMS, "tweet_count",
     f"{r6('signal_trend')} AS signal_trend", f"{r6('momentum_change')} AS momentum_change"]
)


def histogram(source: str, value: str, bins: int) -> str:
    return f"""SELECT bin::INTEGER AS bin, {r6(f'low + bin * ((high - low) / {bins}e0)')} AS bin_start,
    coalesce(n, 0)::BIGINT AS posts
  FROM (SELECT unnest(range({bins})) AS bin),
    (SELECT min({value}) AS low, max({value}) AS high FROM {source})
  LEFT JOIN (SELECT least(floor((v - low) / ((high - low) / {bins}e0)), {bins - 1}) AS slot, count(*) AS n
    FROM (SELECT {value} AS v, min({value}) OVER () AS low, max({value}) OVER () AS high FROM {source})
    GROUP BY 1) ON slot = bin"""


STATISTICS = f"""count(*) AS total_tweets, count(DISTINCT username) AS unique_users,
  strftime(min(timestamp), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS range_start,
  strftime(max(timestamp), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS range_end,
  sum(likes)::BIGINT AS total_likes, sum(retweets)::BIGINT AS total_retweets, sum(replies)::BIGINT AS total_replies,
  {r6('avg(engagement_rate)')} AS avg_engagement_rate, {r6('avg(content_length)')} AS avg_length,
  {r6('avg(hashtag_count)')} AS avg_hashtags, {r6('avg(mention_count)')} AS avg_mentions,
  {r6('avg(quality_score)')} AS avg_quality_score,
  count(*) FILTER (is_potential_bot) AS potential_bots, count(*) FILTER (has_market_keywords) AS market_relevant,
  {r6('avg(sentiment_score)')} AS avg_sentiment,
  count(*) FILTER (sentiment_score > 0.1e0) AS positive_tweets,
  count(*) FILTER (sentiment_score < -0.1e0) AS negative_tweets,
  count(*) FILTER (abs(sentiment_score) <= 0.1e0) AS neutral_tweets"""

MARKET = f"""{r6('avg(primary_signal)')} AS mean_signal, {r6('stddev_samp(primary_signal)')} AS signal_std,
  count(*) FILTER (primary_signal > 0.1e0) AS bullish_tweets,
  count(*) FILTER (primary_signal < -0.1e0) AS bearish_tweets,
  count(*) FILTER (abs(primary_signal) <= 0.1e0) AS neutral_signal_tweets,
  {r6('avg(confidence_score)')} AS avg_confidence,
  count(*) FILTER (confidence_score > 0.7e0) AS high_confidence_signals,
  count(*) FILTER (trading_signal = 'BUY') AS buy_signals,
  count(*) FILTER (trading_signal = 'SELL') AS sell_signals,
  count(*) FILTER (trading_signal = 'HOLD') AS hold_signals,
  strftime({AS_OF}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp"""

INFLUENCE = (
    "(signal_strength + confidence_score"
    " + total_engagement / ((SELECT max(total_engagement) FROM scored) + 1)::DOUBLE + quality_score) / 4e0"
)

ENGAGED = "engaged AS (SELECT *, likes + retweets + replies AS total_engagement FROM posts)"


def sampled(source: str, stratum: str, maximum: int, name: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (pick, total, strata) FROM (
    SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5(id || '_42'), id) AS pick,
      count(*) OVER () AS total, (SELECT count(DISTINCT {stratum}) FROM {source}) AS strata FROM {source})
  WHERE pick <= CASE WHEN total > {maximum} THEN {maximum} // strata ELSE {maximum} END)"""


def recent(hours: int, source: str) -> str:
    return f"""prefix AS (
  SELECT * EXCLUDE (cut) FROM (
    SELECT *, min(CASE WHEN NOT (timestamp >= {AS_OF} - INTERVAL {hours} HOUR) THEN feed_pos END)
      OVER (PARTITION BY hashtag_source) AS cut FROM {source})
  WHERE cut IS NULL OR feed_pos < cut)"""


def first_per(keys: str, order: str, source: str, name: str) -> str:
    return f"""{name} AS (SELECT * EXCLUDE (pick) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pick FROM {source}) WHERE pick = 1)"""


SOURCE_RANK = f"list_position({array(feed.SOURCES)}, hashtag_source)"
REVERSED = "reversed AS (SELECT * REPLACE (-feed_pos AS feed_pos) FROM {})"


def per_post(columns: str) -> str:
    return statement([POSTS], f"SELECT id, {columns} FROM posts")


def per_text(columns: str) -> str:
    return statement(UP_TO_CLEANED, f"SELECT id, {columns} FROM cleaned")


def summary_rows() -> str:
    """(section, key, number, text) of one row of facts."""
    rows = []
    sections = {
        "timestamp": [("timestamp", None)],
        "overall_sentiment": [
            ("mean_signal", None), ("signal_std", None), ("bullish_tweets", None),
            ("bearish_tweets", None), ("neutral_tweets", "neutral_signal_tweets"),
        ],
        "confidence_metrics": [("avg_confidence", None), ("high_confidence_signals", None)],
        "trading_recommendations": [("buy_signals", None), ("sell_signals", None), ("hold_signals", None)],
        "total_tweets": [("total_tweets", None)],
        "unique_users": [("unique_users", None)],
        "date_range": [("start", "range_start"), ("end", "range_end")],
        "engagement": [("total_likes", None), ("total_retweets", None), ("total_replies", None), ("avg_engagement_rate", None)],
        "content": [("avg_length", None), ("avg_hashtags", None), ("avg_mentions", None)],
        "quality": [("avg_quality_score", None), ("potential_bots", None), ("market_relevant", None)],
        "sentiment": [("avg_sentiment", None), ("positive_tweets", None), ("negative_tweets", None), ("neutral_tweets", "neutral_tweets")],
    }
    for section, keys in sections.items():
        for key, column in keys:
            value = column or key
            if section in ("date_range", "timestamp"):
                number, words = "NULL::DOUBLE", value
            else:
                number, words = f"{value}::DOUBLE", "NULL::VARCHAR"
            rows.append(f"SELECT '{section}' AS section, '{key}' AS key, {number} AS number, {words} AS text FROM facts")
    return "\nUNION ALL ".join(rows)


def correlations() -> str:
    names = lx.CORRELATION_COLUMNS
    cells = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': corr({a}::DOUBLE, {b}::DOUBLE)}}" for a in names for b in names)
    return statement(UP_TO_SCORED, f"""SELECT cell.a AS a, cell.b AS b,
  CASE WHEN isnan(cell.r) THEN NULL ELSE {r6('cell.r')} END AS r
  FROM (SELECT unnest([{cells}]) AS cell FROM scored)""")


def trend_periods() -> str:
    blocks = list(UP_TO_SCORED)
    parts = []
    for hours in lx.TREND_HOURS:
        blocks += trend_blocks(hours * 3600, f"trend_{hours}")
        parts.append(f"SELECT {TREND_COLUMNS}, {hours}::INTEGER AS period_hours FROM trend_{hours}")
    return statement(blocks, "\nUNION ALL ".join(parts))


CLOUD = f"""cloud AS (
  SELECT term, count(*) AS uses FROM (
    SELECT regexp_replace(w, '''s$', '') AS term
    FROM (SELECT unnest(regexp_extract_all(content_cleaned, '{W}(?:{W}|'')*')) AS w FROM cleaned))
  WHERE term <> '' AND NOT regexp_full_match(term, '\\p{{Nd}}+') AND term NOT IN {members(lx.STOP_WORDS)}
  GROUP BY term)"""


def oracle_sql() -> dict[str, str]:
    posts_text = f"id, username, content, {at('timestamp')} AS timestamp, likes, retweets, replies"
    tags = f"array_to_string({TAGS}, ',') AS hashtags, array_to_string({MENTIONS}, ',') AS mentions"
    url = f"'https://twitter.com/' || username || '/status/' || id"
    total = "likes + retweets + replies AS total_engagement"
    renamed = "named AS (SELECT * REPLACE (CASE WHEN username = 'trader_view' THEN 'unknown' ELSE username END AS username) FROM posts)"
    out = {
        "src_posts": statement([POSTS], f"SELECT {posts_text}, {total}, hashtag_source, {url} AS url, {tags} FROM posts WHERE hashtag_source IN ('#click', '#error', '#view')"),
        "src_normalize": statement([POSTS, renamed], f"""SELECT {posts_text}, {HASH} AS hash, {total}, hashtag_source, {url} AS url,
          {at(AS_OF)} AS scraped_at, length(content)::INTEGER AS content_length,
          len({TAGS})::INTEGER AS hashtag_count, len({MENTIONS})::INTEGER AS mention_count, {tags} FROM named"""),
        "src_parquet": "SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY event_type",
        "sink_parquet": statement([POSTS], f"SELECT {posts_text}, hashtag_source FROM posts"),
        "narrow_types": statement([POSTS], "SELECT id, feed_pos, likes, retweets, replies, " + ", ".join(
            f"(SELECT CASE WHEN max({n}) < 128 THEN 'tinyint' WHEN max({n}) < 32768 THEN 'smallint' ELSE 'int' END FROM posts) AS {n}_type"
            for n in ("likes", "retweets", "replies")) + " FROM posts"),
        "encode_categories": statement([POSTS], """SELECT id, CAST(dense_rank() OVER (ORDER BY username) - 1 AS BIGINT) AS username_code,
          CAST(dense_rank() OVER (ORDER BY hashtag_source) - 1 AS BIGINT) AS hashtag_source_code, username, hashtag_source,
          (SELECT count(DISTINCT content) < 0.5 * count(*) FROM posts) AS content_encoded FROM posts"""),
        "sink_json_raw": statement([POSTS, FLAWED, VALID_FLAWED], f"SELECT id, username, content, {at('timestamp')} AS timestamp, likes, {at('scraped_at')} AS scraped_at FROM valid"),
        "sink_json_report": statement([*UP_TO_SCORED, *trend_blocks(3600)], f"""SELECT count(*) AS total_tweets,
          {r6('avg(primary_signal)')} AS mean_signal, count(*) FILTER (abs(primary_signal) <= 0.1e0) AS neutral_tweets,
          count(*) FILTER (trading_signal = 'HOLD') AS hold_signals, 50::INTEGER AS top_posts,
          {r6(f'max({INFLUENCE})')} AS best_influence,
          (SELECT count(*) FROM trend)::INTEGER AS hours,
          (SELECT tweet_count FROM trend ORDER BY bucket LIMIT 1) AS first_hour_posts FROM scored"""),
        "sink_text_summary": statement([*UP_TO_SCORED, f"facts AS (SELECT {MARKET}, {STATISTICS} FROM scored)"], summary_rows()),
        "export_formats": statement([POSTS], "\nUNION ALL ".join(
            f"SELECT '{fmt}' AS format, id, username, md5(content) AS content_md5, likes, {tags} FROM posts" for fmt in lx.EXPORT_FORMATS)),
        "validate_posts": statement([POSTS, FLAWED, VALID_FLAWED], "SELECT id, username, length(content)::INTEGER AS content_length FROM valid"),
        "filter_recent": statement([POSTS], f"SELECT id, {at('timestamp')} AS timestamp FROM posts WHERE timestamp >= {AS_OF} - INTERVAL 24 HOUR"),
        "recent_prefix": statement([POSTS, REVERSED.format("posts"), recent(72, "reversed")], f"SELECT id, hashtag_source, {at('timestamp')} AS timestamp FROM prefix"),
        "filter_quality": statement(UP_TO_ENRICHED, f"SELECT id, {r6('quality_score')} AS quality_score FROM enriched"),
        "clean_and_process": statement(UP_TO_ENRICHED, f"""SELECT id, username, md5(content_cleaned) AS cleaned_md5, content_length, cleaned_length, hour,
          day_of_week, total_engagement, {r6('engagement_rate')} AS engagement_rate, hashtag_count, mention_count, hashtags_str, mentions_str,
          has_market_keywords, {r6('sentiment_score')} AS sentiment_score, is_potential_bot, {r6('quality_score')} AS quality_score FROM enriched"""),
        "filter_text_eligible": statement(UP_TO_TERMS, "SELECT id, md5(feature_text) AS text_md5 FROM eligible"),
        "engagement_columns": statement([POSTS, ENGAGED], f"SELECT id, total_engagement, {r6('total_engagement / (length(content) + 1)::DOUBLE')} AS engagement_rate FROM engaged"),
        "length_columns": per_text("length(content)::INTEGER AS content_length, length(content_cleaned)::INTEGER AS cleaned_length"),
        "scatter_points": statement([*UP_TO_SCORED,
            sampled("scored", "trading_signal", 5000, "s5000"), sampled("scored", "trading_signal", 3000, "s3000"), sampled("scored", "trading_signal", 2000, "s2000")],
            f"""SELECT 'signal_vs_confidence' AS chart, id, {r6('primary_signal')} AS primary_signal, {r6('confidence_score')} AS confidence_score,
              total_engagement::DOUBLE AS total_engagement, NULL::DOUBLE AS log_engagement, NULL::VARCHAR AS timestamp FROM s5000
            UNION ALL SELECT 'engagement_vs_signal', id, {r6('primary_signal')}, NULL, NULL, {r6('ln(1e0 + total_engagement)')}, NULL FROM s3000
            UNION ALL SELECT 'signal_over_time', id, {r6('primary_signal')}, NULL, NULL, NULL, {at('timestamp')} FROM s2000
            UNION ALL SELECT 'sentiment_vs_engagement', id, {r6('primary_signal')}, {r6('confidence_score')}, total_engagement::DOUBLE, NULL, NULL FROM s2000"""),
        "drop_null_rows": statement([POSTS, FLAWED], "SELECT id, length(content)::INTEGER AS content_length FROM flawed WHERE content IS NOT NULL"),
        "fill_defaults": per_post("likes AS favorite_count, replies AS reply_count"),
        "empty_guard": "SELECT unnest(['scored', 'hourly', 'summary', 'statistics', 'histogram']) AS stage, 0::BIGINT AS rows",
        "optional_columns": statement([*UP_TO_LEXICON, composite("(SELECT id, total_engagement, bullish_score, bearish_score FROM lexicon)", ["bullish_score", "bearish_score"], "pair")],
            f"SELECT id, {r6('primary_signal')} AS primary_signal, {r6('confidence_score')} AS confidence_score, trading_signal FROM pair"),
        "attach_features": statement(UP_TO_WEIGHTS, f"""SELECT p.id, p.username, {r6('coalesce(a.attention, 0e0)')} AS market_attention FROM posts p
          LEFT JOIN (SELECT id, sqrt(sum(weight * weight)) AS attention FROM weights GROUP BY id) a ON a.id = p.id"""),
        "attach_global_stats": statement([POSTS, "measured AS (SELECT id, likes + retweets + replies AS total_engagement, (likes + retweets + replies) / (length(content) + 1)::DOUBLE AS engagement_rate FROM posts)"],
            f"""SELECT id, {r6('total_engagement / ((SELECT max(total_engagement) FROM measured) + 1)::DOUBLE')} AS share,
              {r6('engagement_rate - (SELECT min(engagement_rate) FROM measured)')} AS above_lowest FROM measured"""),
        "vocab_match": statement(UP_TO_VOCABULARY, "SELECT id, sum(tf)::BIGINT AS matches, count(*) AS terms FROM pairs JOIN vocabulary USING (term) GROUP BY id"),
        "content_hash": per_post(f"{HASH} AS hash"),
        "dedup_by_id": statement([POSTS, REPEATED, first_per("hashtag_source, id", "feed_pos", "repeated", "once")], "SELECT id, hashtag_source, feed_pos, likes FROM once"),
        "dedup_first": statement([POSTS, REPEATED, f"hashed AS (SELECT *, {HASH} AS hash FROM repeated)", first_per("hash", f"{SOURCE_RANK}, feed_pos, id", "hashed", "once")],
            "SELECT id, hash, hashtag_source, feed_pos, likes FROM once"),
        "merge_keep_last": statement([POSTS, REPEATED, f"hashed AS (SELECT *, {HASH} AS hash FROM repeated)", first_per("hash", "(feed_pos >= 1000000000) DESC, feed_pos DESC, id DESC", "hashed", "once")],
            f"SELECT id, hash, hashtag_source, feed_pos, likes, {at('timestamp')} AS timestamp FROM once"),
        "union_sources": statement([POSTS], "SELECT id, hashtag_source, likes FROM posts"),
        "merge_summaries": statement(UP_TO_SCORED, f"SELECT count(*) AS scored_tweets, {MARKET}, {STATISTICS} FROM scored"),
        "collect_posts": statement([POSTS, REPEATED, "spoilt AS (SELECT * REPLACE (CASE WHEN NOT (feed_pos >= 2000000000 AND retweets % 3 = 0) THEN content END AS content) FROM repeated)",
            REVERSED.format("spoilt"), recent(24, "reversed"), VALID_FLAWED.replace("flawed", "prefix"),
            first_per("hashtag_source, id", "feed_pos", "valid", "once"),
            "limited AS (SELECT * EXCLUDE (pick) FROM (SELECT *, row_number() OVER (PARTITION BY hashtag_source ORDER BY timestamp DESC, id) AS pick FROM once) WHERE pick <= 100)",
            f"hashed AS (SELECT *, {HASH} AS hash FROM limited)", first_per("hash", f"{SOURCE_RANK}, feed_pos, id", "hashed", "kept")],
            f"SELECT id, hash, hashtag_source, feed_pos, likes, {at('timestamp')} AS timestamp FROM kept"),
        "data_statistics": statement(UP_TO_ENRICHED, f"SELECT {STATISTICS} FROM enriched"),
        "market_summary": statement(UP_TO_SCORED, f"SELECT count(*) AS scored_tweets, {MARKET} FROM scored"),
        "hourly_trends": statement([*UP_TO_SCORED, *trend_blocks(3600)], f"SELECT {TREND_COLUMNS} FROM trend"),
        "hourly_sentiment": statement(UP_TO_CLEANED, f"""SELECT {at("date_trunc('hour', timestamp)::TIMESTAMP")} AS bucket, {r6('avg(s)')} AS sentiment_score,
          sum(likes)::BIGINT AS likes, count(username) AS tweet_count FROM (SELECT *, {SENTIMENT} AS s FROM cleaned) GROUP BY 1"""),
        "sentiment_timeline": statement(UP_TO_SCORED, f"""SELECT {at("date_trunc('hour', timestamp)::TIMESTAMP")} AS bucket, {r6('avg(primary_signal)')} AS primary_signal,
          {r6('avg(composite_sentiment)')} AS composite_sentiment, {r6('avg(confidence_score)')} AS confidence_score, sum(total_engagement)::BIGINT AS total_engagement FROM scored GROUP BY 1"""),
        "signal_counts": statement(UP_TO_SCORED, "SELECT trading_signal, count(*) AS posts FROM scored GROUP BY 1"),
        "sentiment_by_hour": statement(UP_TO_SCORED, f"SELECT hour, {r6('avg(primary_signal)')} AS mean_signal FROM scored GROUP BY hour"),
        "engagement_by_user": statement([POSTS, ENGAGED], "SELECT username, sum(total_engagement)::BIGINT AS engagement FROM engaged GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
        "influence_by_user": statement(UP_TO_SCORED, f"SELECT username, {r6('m')} AS mean_influence FROM (SELECT username, avg({INFLUENCE}) AS m FROM scored GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)"),
        "engagement_breakdown": statement([POSTS], "\nUNION ALL ".join(f"SELECT '{n}' AS kind, sum({n})::BIGINT AS total FROM posts" for n in ("likes", "retweets", "replies"))),
        "signal_histogram": statement(UP_TO_SCORED, histogram("scored", "primary_signal", 50)),
        "engagement_histogram": statement([POSTS, ENGAGED], histogram("engaged", "ln(1e0 + total_engagement)", 30)),
        "term_frequency": statement([*UP_TO_CLEANED, CLOUD], """SELECT term, uses FROM (
          SELECT c.term, (c.uses + coalesce(p.uses, 0))::BIGINT AS uses FROM cloud c
          LEFT JOIN cloud p ON p.term = c.term || 's' AND c.term NOT LIKE '%s'
          WHERE NOT (c.term LIKE '%s' AND c.term NOT LIKE '%ss' AND c.term[:-2] IN (SELECT term FROM cloud)))
          ORDER BY uses DESC, term LIMIT 200"""),
        "correlation_matrix": correlations(),
        "stage_metrics": statement([POSTS, FLAWED, VALID_FLAWED, *[b.replace("FROM posts))", "FROM valid))") for b in (CLEANED, ENRICHED_ALL, ENRICHED)]],
            """SELECT 'completed' AS status, (SELECT count(*) FROM flawed) AS collected, count(*) AS processed,
              count(*) AS signals, count(*) AS signals_written FROM enriched"""),
        "signal_trend": statement([*UP_TO_SCORED, *trend_blocks(300)], f"SELECT {at('bucket')} AS bucket, tweet_count, {r6('primary_signal')} AS primary_signal, {r6('signal_trend')} AS signal_trend FROM trend"),
        "momentum_change": statement([*UP_TO_SCORED, *trend_blocks(25200)], f"SELECT {at('bucket')} AS bucket, tweet_count, {r6('primary_signal')} AS primary_signal, {r6('momentum_change')} AS momentum_change FROM trend"),
        "minmax_normalize": statement(UP_TO_SCORED, "SELECT id, " + ", ".join(f"{r6(n + '_normalized')} AS {n}_normalized" for n in SIGNALS) + " FROM scored"),
        "stratified_sample": statement([POSTS, sampled("posts", "hashtag_source", 5000, "picked")], "SELECT id, hashtag_source, likes FROM picked"),
        "union_samples": statement([*UP_TO_SCORED, sampled("scored", "trading_signal", 1000, "picked")], "SELECT trading_signal, count(*) AS posts, min(id) AS first_id FROM picked GROUP BY 1"),
        "per_source_limit": statement([POSTS], f"""SELECT id, hashtag_source, {at('timestamp')} AS timestamp FROM (
          SELECT *, row_number() OVER (PARTITION BY hashtag_source ORDER BY timestamp DESC, id) AS pick FROM posts) WHERE pick <= 100"""),
        "rolling_sentiment": statement(UP_TO_CLEANED, f"""SELECT hashtag_source, {at('minute')} AS minute, {r6('sum(s) OVER w / sum(n) OVER w')} AS rolling_sentiment, (sum(n) OVER w)::BIGINT AS posts_in_window
          FROM (SELECT hashtag_source, date_trunc('minute', timestamp)::TIMESTAMP AS minute, sum({SENTIMENT}) AS s, count(*) AS n FROM cleaned GROUP BY ALL)
          WINDOW w AS (PARTITION BY hashtag_source ORDER BY minute RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW)"""),
        "trend_periods": trend_periods(),
        "sort_recent": statement([POSTS], f"SELECT id, {at('timestamp')} AS timestamp FROM posts ORDER BY posts.timestamp DESC, id"),
        "influence_score": statement(UP_TO_SCORED, f"SELECT id, {r6(INFLUENCE)} AS influence_score FROM scored"),
        "top_influential": statement(UP_TO_SCORED, f"""SELECT username, content, {at('timestamp')} AS timestamp, trading_signal, {r6('primary_signal')} AS primary_signal,
          {r6('confidence_score')} AS confidence_score, {r6('influence')} AS influence_score, likes, retweets, replies
          FROM (SELECT *, {INFLUENCE} AS influence FROM scored ORDER BY influence DESC, id LIMIT 50)"""),
        "top_k_generic": statement([POSTS], "SELECT username, sum(likes)::BIGINT AS likes FROM posts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
        "clean_text": per_text("content_cleaned"),
        "extract_hashtags": per_post(f"array_to_string({TAGS}, ',') AS hashtags"),
        "extract_mentions": per_post(f"array_to_string({MENTIONS}, ',') AS mentions"),
        "tag_strings": per_post(f"array_to_string({TAGS}, ',') AS hashtags_str, array_to_string({MENTIONS}, ',') AS mentions_str"),
        "list_length": per_post(f"len({TAGS})::INTEGER AS hashtag_count, len({MENTIONS})::INTEGER AS mention_count"),
        "market_relevance": per_text(f"{RELEVANT} AS has_market_keywords"),
        "lexicon_match": statement(UP_TO_CLEANED, f"SELECT term, count(*) AS posts FROM (SELECT unnest(list_distinct(tokens)) AS term FROM cleaned) WHERE term IN {members(lx.MARKET_TERMS)} GROUP BY 1"),
        "keyword_intersection": per_text(f"array_to_string(list_sort(list_filter(list_distinct(tokens), lambda t: t IN {members(lx.MARKET_TERMS)})), ',') AS common, {RELEVANT} AS any_common"),
        "basic_sentiment": per_text(f"{r6(SENTIMENT)} AS sentiment_score"),
        "bullish_score": statement(UP_TO_CLEANED, f"SELECT id, {r6(BULLISH)} AS bullish_score FROM (SELECT *, {PLAIN} AS plain FROM cleaned)"),
        "bearish_score": statement(UP_TO_CLEANED, f"SELECT id, {r6(BEARISH)} AS bearish_score FROM (SELECT *, {PLAIN} AS plain FROM cleaned)"),
        "volatility_score": per_text(f"{r6(VOLATILITY)} AS volatility_score"),
        "neutral_terms": per_text("(" + " + ".join(f"contains(content_cleaned, {text(w)})::INTEGER" for w in lx.NEUTRAL_WORDS) + ")::INTEGER AS neutral_words"),
        "india_terms": per_text(f"list_has_any(tokens, {array(lx.INDIA_TERMS)}) AS has_india_terms"),
        "distinct_words": per_post(f"len({WORDS})::INTEGER AS words, len(list_distinct({WORDS}))::INTEGER AS distinct_words"),
        "bot_flag": statement(UP_TO_ENRICHED, "SELECT id, is_potential_bot FROM enriched_all"),
        "quality_score": statement(UP_TO_ENRICHED, f"SELECT id, is_potential_bot, has_market_keywords, {r6('quality_score')} AS quality_score FROM enriched_all"),
        "parse_engagement_text": statement([POSTS, "lines AS (SELECT id, content || ' ' || format('{:,}', likes * 1000) || ' Likes ' || retweets || ' rts, ' || replies || CASE WHEN replies > 2 THEN ' reply' ELSE ' comments' END AS line FROM posts)"],
            "SELECT id, " + ", ".join(
                f"coalesce(try_cast(replace(regexp_extract(line, '(?i)(\\p{{Nd}}+(?:,\\p{{Nd}}+)*){B}*(?:{words})', 1), ',', '') AS BIGINT), 0) AS {name}"
                for name, words in (("likes", "likes?|hearts?"), ("retweets", "retweets?|rts?"), ("replies", "replies?|comments?"))) + " FROM lines"),
        "post_url": per_post(f"{url} AS url"),
        "tfidf_clean": statement(UP_TO_TERMS, "SELECT id, feature_text FROM texts"),
        "time_parts": per_post("hour(timestamp)::INTEGER AS hour, dayname(timestamp) AS day_of_week"),
        "parse_timestamp": per_post(f"{at('timestamp')} AS timestamp"),
        "age_hours": per_post(f"{r6(age())} AS age_hours"),
        "relative_time": per_post(f"""retweets || (['s', 'M', 'h', 'd ago', 'y'])[replies + 1] AS text,
          {at(f"CASE WHEN replies < 4 THEN {AS_OF} - retweets * ([1, 60, 3600, 86400])[replies + 1] * INTERVAL 1 SECOND END")} AS time"""),
        "time_decay": per_post(f"{r6(f'exp(-{age()} / 12e0)')} AS time_decay"),
        "market_session": per_post("CASE WHEN (hour(timestamp) + 5) % 24 < 9 THEN 'PRE_MARKET' WHEN (hour(timestamp) + 5) % 24 < 15 THEN 'MARKET_HOURS' ELSE 'AFTER_MARKET' END AS session"),
        "strength_category": statement(UP_TO_SCORED, "SELECT CASE " + " ".join(f"WHEN {r6('signal_strength')} >= {v}e0 THEN '{k}'" for k, v in lx.STRENGTH_LEVELS.items()) + " END AS category, count(*) AS posts FROM scored GROUP BY 1"),
        "composite_sentiment": statement(UP_TO_LEXICON, f"SELECT id, {r6('composite_sentiment')} AS composite_sentiment, {r6('time_weighted_sentiment')} AS time_weighted_sentiment FROM lexicon"),
        "weighted_sentiment": statement(UP_TO_LEXICON, f"SELECT id, {r6('weighted_sentiment')} AS weighted_sentiment FROM lexicon"),
        "primary_signal": statement(UP_TO_SCORED, f"SELECT id, {r6('primary_signal')} AS primary_signal FROM scored"),
        "signal_strength": statement(UP_TO_SCORED, f"SELECT id, {r6('signal_strength')} AS signal_strength, {r6('signal_direction')} AS signal_direction FROM scored"),
        "row_std": statement(UP_TO_SCORED, f"SELECT id, {r6('row_std')} AS row_std FROM scored"),
        "confidence_score": statement(UP_TO_SCORED, f"SELECT id, {r6('confidence_score')} AS confidence_score FROM scored"),
        "trading_signal": statement(UP_TO_SCORED, f"""SELECT id, CASE WHEN {r6('primary_signal')} > 0.3e0 AND {r6('confidence_score')} > 0.5e0 THEN 'BUY'
          WHEN {r6('primary_signal')} < -0.3e0 AND {r6('confidence_score')} > 0.5e0 THEN 'SELL' ELSE 'HOLD' END AS trading_signal FROM scored"""),
        "json_encode": per_post("json_object('id', id, 'username', username, 'likes', likes, 'retweets', retweets, 'replies', replies)::VARCHAR AS record"),
        "tokenize_terms": statement(UP_TO_TERMS, "SELECT id, len(terms)::INTEGER AS terms, md5(array_to_string(terms, ',')) AS terms_md5 FROM terms"),
        "build_vocabulary": statement(UP_TO_VOCABULARY, "SELECT term, corpus_count, doc_count, texts FROM vocabulary"),
        "tfidf_weights": statement(UP_TO_WEIGHTS, f"SELECT term, count(*) AS posts, {r6('avg(weight)')} AS mean_weight, {r6('max(weight)')} AS top_weight FROM weights GROUP BY term"),
        "market_attention": statement(UP_TO_WEIGHTS, f"SELECT t.id, {r6('coalesce(a.attention, 0e0)')} AS market_attention FROM terms t LEFT JOIN (SELECT id, sqrt(sum(weight * weight)) AS attention FROM weights GROUP BY id) a ON a.id = t.id"),
        "svd_spectrum": statement([*UP_TO_WEIGHTS, GRAM, SPECTRUM], """SELECT * FROM (
  SELECT 0 AS component, round(sqrt(greatest(lam, 0e0)), 4) AS singular_value, round(e, 4) AS energy FROM first_value, energy
  UNION ALL SELECT 1, round(sqrt(greatest(lam, 0e0)), 4), round(e, 4) FROM second_value, energy)"""),
        "gram_matrix": statement([*UP_TO_WEIGHTS, GRAM], "SELECT a, b, round(product, 3) AS product FROM gram WHERE a <= b"),
        "standard_scale": statement(UP_TO_VOCABULARY, f"""SELECT unnest(range(least({lx.SVD_COMPONENTS}, count(*), max(texts))))::INTEGER AS component,
          0e0 AS mean, 1e0 AS std FROM vocabulary"""),
        "tfidf_momentum": statement(UP_TO_MOMENTUM, f"SELECT id, {r6('tfidf_momentum')} AS tfidf_momentum FROM momentum"),
        "topic_coverage": statement(UP_TO_TERMS, f"""SELECT ok AS clustered, count(*) AS posts,
          CASE WHEN ok THEN least({lx.MAX_CLUSTERS}, count(*) // {lx.TEXTS_PER_CLUSTER}) ELSE 1 END::BIGINT AS clusters FROM terms GROUP BY ok"""),
        "full_signals": statement(UP_TO_FULL, f"""SELECT id, {', '.join(f'{r6(n)} AS {n}' for n in ['tfidf_momentum', 'market_attention', 'primary_signal', 'confidence_score'])},
          trading_signal FROM full_scored"""),
        "stream_score_model": statement(UP_TO_FULL, f"""SELECT id, {', '.join(f'{r6(n)} AS {n}' for n in ['tfidf_momentum', 'market_attention', 'primary_signal', 'confidence_score'])},
          trading_signal FROM full_scored"""),
        "min_corpus_guard": statement(UP_TO_VOCABULARY, "SELECT max(texts) AS texts, count(*) AS terms, least(5, max(texts) // 20)::BIGINT AS clusters, max(texts) >= 10 AS enough_texts FROM vocabulary"),
        "stream_posts": per_post(f"username, {at('timestamp')} AS timestamp, likes, md5(content) AS content_md5"),
        "stream_enrich": statement(UP_TO_ENRICHED, f"SELECT id, {r6('sentiment_score')} AS sentiment_score, is_potential_bot, {r6('quality_score')} AS quality_score FROM enriched"),
        "stream_dedup": per_post(f"{HASH} AS hash"),
        "stream_dedup_state": statement([POSTS, REPEATED, f"hashed AS (SELECT *, {HASH} AS hash FROM repeated)", first_per("hash", "feed_pos, id", "hashed", "once")],
            "SELECT id, hash, feed_pos, likes, hashtag_source FROM once"),
        "stream_hourly": statement(UP_TO_CLEANED, f"""SELECT {at('h')} AS bucket, {r6('avg(s)')} AS mean_sentiment_score, sum(likes + retweets + replies)::BIGINT AS total_engagement,
          sum(likes)::BIGINT AS likes, sum(retweets)::BIGINT AS retweets, sum(replies)::BIGINT AS replies, count(username) AS tweet_count
          FROM (SELECT *, date_trunc('hour', timestamp)::TIMESTAMP AS h, {SENTIMENT} AS s FROM cleaned) GROUP BY h"""),
        "stream_merge": statement([POSTS, REPEATED, f"hashed AS (SELECT *, {HASH} AS hash FROM repeated)", first_per("hash", "feed_pos DESC", "hashed", "once")],
            "SELECT id, hash, feed_pos, likes FROM once"),
        "stream_merge_bucketed": statement([POSTS, REPEATED, f"hashed AS (SELECT *, {HASH} AS hash FROM repeated)", first_per("hash", "feed_pos DESC", "hashed", "once")],
            "SELECT id, hash, feed_pos, likes FROM once"),
        "stream_score": statement(UP_TO_SCORED, f"SELECT id, {r6('primary_signal')} AS primary_signal, {r6('confidence_score')} AS confidence_score FROM scored"),
    }
    return out
