"""Word lists, phrases, weights, thresholds and formats.

Results depend on these exact values. Most functions that use one take it as a
parameter whose default is the value below.
"""

# --- fixed values: feeds and collection limits -----------------------------
FOLLOWED_HASHTAGS = ["#nifty50", "#sensex", "#intraday", "#banknifty"]
TARGET_POSTS = 500
MIN_POSTS_PER_SOURCE = 100
RECENCY_HOURS = 24
UNKNOWN_USER = "unknown"
POST_URL_FORMAT = "https://twitter.com/%s/status/%s"

# --- fixed values: character classes and patterns --------------------------
# Word and blank characters are written out as explicit classes: what counts as
# one must not depend on the pattern engine. Each class starts with plain ranges
# that decide for ordinary characters before a Unicode property is looked up.
WORD_CHARACTERS = r"a-zA-Z0-9_\p{L}\p{N}"
WORD = f"[{WORD_CHARACTERS}]"
CLOUD_WORD = f"[{WORD_CHARACTERS}][{WORD_CHARACTERS}']*"
BLANKS = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
BLANK = r"[\x{09}-\x{20}\x{85}-\x{3000}&&[" + BLANKS + "]]"
NOT_WORD = f"[^{WORD_CHARACTERS}]"
NOT_WORD_OR_BLANK = "[^" + WORD_CHARACTERS + BLANKS + "]"
URL_PATTERN = r"https?://[!$-_a-z]+"
LIKES_PATTERN = r"(?i)(\p{Nd}+(?:,\p{Nd}+)*)" + BLANK + r"*(?:likes?|hearts?)"
RETWEETS_PATTERN = r"(?i)(\p{Nd}+(?:,\p{Nd}+)*)" + BLANK + r"*(?:retweets?|rts?)"
REPLIES_PATTERN = r"(?i)(\p{Nd}+(?:,\p{Nd}+)*)" + BLANK + r"*(?:replies?|comments?)"

# --- fixed values: whole-token lexicons ------------------------------------
MARKET_TERMS = [
    "nifty", "sensex", "intraday", "banknifty", "stock", "market",
    "trading", "trader", "investment", "profit", "loss", "buy", "sell",
    "bull", "bear", "trend", "analysis", "chart", "support", "resistance",
]
POSITIVE_TERMS = [
    "bull", "bullish", "up", "rise", "gain", "profit", "green", "high",
    "moon", "rocket", "surge", "rally", "breakout", "strong", "good",
]
NEGATIVE_TERMS = [
    "bear", "bearish", "down", "fall", "loss", "red", "low", "crash",
    "dump", "drop", "weak", "bad", "sell", "short", "resistance",
]
INDIA_TERMS = [
    "nifty", "sensex", "bse", "nse", "rupee", "inr", "indian",
    "mumbai", "delhi", "bangalore", "chennai", "kolkata",
    "reliance", "tcs", "infosys", "hdfc", "icici", "sbi",
    "adani", "bajaj", "tata", "mahindra", "wipro", "ongc",
]

# --- fixed values: substring lexicons --------------------------------------
BULLISH_WORDS = [
    "bull", "bullish", "moon", "rocket", "up", "rise", "high", "gain",
    "profit", "buy", "long", "green", "surge",
]
BEARISH_WORDS = [
    "bear", "bearish", "crash", "down", "fall", "low", "loss", "sell",
    "short", "red", "dump", "drop",
]
NEUTRAL_WORDS = ["sideways", "flat", "range", "consolidation", "wait", "watch", "hold"]
VOLATILITY_WORDS = [
    "volatile", "swing", "range", "whipsaw", "choppy",
    "uncertain", "unclear", "mixed", "conflicted",
]

# --- fixed values: phrase groups, each group counted on its own ------------
BULLISH_PHRASES = [
    ["moon", "rocket", "surge", "rally", "breakout", "pump"],
    ["strong buy", "bullish trend", "upward momentum"],
    ["resistance broken", "support holding"],
    ["target achieved", "profit booking"],
]
BEARISH_PHRASES = [
    ["crash", "dump", "fall", "drop", "correction"],
    ["strong sell", "bearish trend", "downward pressure"],
    ["support broken", "resistance holding"],
    ["stop loss", "cut losses"],
]
PHRASE_STEP = 0.2
WORD_STEP = 0.1
VOLATILITY_STEP = 0.15

# --- fixed values: quality and automation rules ----------------------------
QUALITY_FLOOR = 0.3
BOT_NAME_LENGTH = 15
BOT_LENGTH_RANGE = (10, 280)
BOT_ENGAGEMENT_RATIO = 5
BOT_MIN_WORDS = 5
BOT_DISTINCT_SHARE = 0.5
BOT_INDICATORS = 2

# --- fixed values: signals --------------------------------------------------
DECAY_HOURS = 12
SIGNAL_WEIGHTS = {
    "composite_sentiment": 0.3,
    "weighted_sentiment": 0.25,
    "time_weighted_sentiment": 0.2,
    "tfidf_momentum": 0.15,
    "bullish_score": 0.05,
    "bearish_score": 0.05,
}
BUY_ABOVE = 0.3
SELL_BELOW = -0.3
MIN_CONFIDENCE = 0.5
STRENGTH_LEVELS = {
    "VERY_STRONG": 0.7,
    "STRONG": 0.5,
    "MODERATE": 0.3,
    "WEAK": 0.1,
    "VERY_WEAK": 0.0,
}
MARKET_OPEN_HOUR = 9
MARKET_CLOSE_HOUR = 15
MARKET_UTC_OFFSET_HOURS = 5

# --- fixed values: trends and reports --------------------------------------
ROLLING_HOURS = 4
TREND_HOURS = [1, 3, 6, 12, 24]
REPORT_TOP_POSTS = 50
SAMPLE_SEED = 42
CORRELATION_COLUMNS = [
    "primary_signal", "confidence_score", "composite_sentiment",
    "bullish_score", "bearish_score", "total_engagement",
    "likes", "retweets", "replies", "content_length",
    "hashtag_count", "mention_count", "quality_score",
]
EXPORT_FORMATS = ["json", "parquet", "csv"]

# --- fixed values: text features -------------------------------------------
MAX_TERMS = 1000
MIN_DOC_COUNT = 2
MAX_DOC_SHARE = 0.8
MIN_TEXT_LENGTH = 10
MIN_TEXT_WORDS = 3
MIN_TEXTS = 10
SVD_COMPONENTS = 50
MAX_CLUSTERS = 5
TEXTS_PER_CLUSTER = 20
CLUSTER_RESTARTS = 10
CLUSTER_ITERATIONS = 300
CLUSTER_TOLERANCE = 1e-4
CLOUD_TERMS = 200
STOP_WORDS = [
    "rt", "via", "amp", "quot", "gt", "lt", "https", "http", "www",
    "com", "co", "in", "the", "and", "or", "but", "for", "with",
    "twitter", "tweet", "follow", "retweet", "share", "like",
    "today", "now", "will", "get", "can", "may", "should", "would",
    "one", "two", "first", "second", "new", "old", "good", "bad",
    "big", "small", "high", "low", "more", "less", "most", "much",
    "many", "some", "all", "any", "no", "not", "only", "just",
    "time", "day", "week", "month", "year", "hour", "minute",
]
