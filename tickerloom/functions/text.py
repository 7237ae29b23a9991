"""Text functions, all ``Column -> Column``: built-in expressions, and Arrow kernels (``batches``) for whole texts.

``cleaned`` parameters expect the output of :func:`clean_text`: lower case and
single-spaced, which makes one plain ``split`` enough to tokenise it.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom import lexicon as lx
from tickerloom.functions import batches


def clean_text(raw: Column) -> Column:
    """Drop links and mentions, unwrap hashtags, collapse blanks, lower-case."""
    return batches.cleaned(F.coalesce(raw, F.lit("")))


def hashtags(raw: Column) -> Column:
    return batches.tagged(raw, "#")


def mentions(raw: Column) -> Column:
    return batches.tagged(raw, "@")


def joined(tags: Column) -> Column:
    """Comma-joined tags; '' for a null or empty list."""
    return F.coalesce(F.array_join(tags, ","), F.lit(""))


def list_length(values: Column) -> Column:
    return F.coalesce(F.size(values), F.lit(0))


def tokens(cleaned: Column) -> Column:
    return F.when(cleaned == "", F.array().cast("array<string>")).otherwise(F.split(cleaned, " "))


def raw_words(raw: Column) -> Column:
    """Blank-separated words of text that has not been cleaned."""
    return F.array_remove(F.split(batches.single_blanks(raw), " "), "")


def has_any_term(words: Column, terms: list[str] = lx.MARKET_TERMS) -> Column:
    """True when some word equals a term (whole words only)."""
    return F.arrays_overlap(words, F.array(*[F.lit(t) for t in terms]))


def terms_held(cleaned: Column, terms: list[str] = lx.MARKET_TERMS) -> Column:
    """The terms that some word equals (whole words only), each once, in alphabetical order."""
    return batches.words_held(cleaned, terms)


def basic_sentiment(
    words: Column,
    positive: list[str] = lx.POSITIVE_TERMS,
    negative: list[str] = lx.NEGATIVE_TERMS,
) -> Column:
    """(positive - negative words) / words, within [-1, 1]; 0 without words."""
    net = F.aggregate(
        words,
        F.lit(0),
        lambda total, w: total + w.isin(positive).cast("int") - w.isin(negative).cast("int"),
    )
    return net_share(net, F.size(words))


def net_share(net: Column, words: Column) -> Column:
    """Net hits per word within [-1, 1]; 0 without words."""
    share = net / words
    return F.when(words == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), share))
    )


#: What ``word_marks`` counts, and the words that it looks for inside the text: those of all lexicon scores.
COUNTED = [lx.MARKET_TERMS, lx.POSITIVE_TERMS, lx.NEGATIVE_TERMS]
PHRASES = [*lx.BULLISH_PHRASES, *lx.BEARISH_PHRASES]
INSIDE = list(dict.fromkeys([*lx.BULLISH_WORDS, *lx.BEARISH_WORDS, *lx.VOLATILITY_WORDS]))


def word_marks(cleaned: Column) -> Column:
    """All that the lexicon scores ask of a text's words, found in one pass (see ``batches.marks``)."""
    return batches.marks(cleaned, COUNTED, INSIDE, PHRASES)


def held(marks: Column, word: str) -> Column:
    """Whether a word of ``INSIDE`` occurs in the text."""
    return marks["inside"].bitwiseAND(F.lit(1 << INSIDE.index(word)).cast("bigint")) != 0


def marked_relevance(marks: Column) -> Column:
    """``has_any_term`` of the market terms."""
    return marks["count0"] > 0


def marked_sentiment(marks: Column) -> Column:
    """``basic_sentiment`` by the default lists."""
    return net_share(marks["count1"] - marks["count2"], marks["words"])


def phrase_count(cleaned: Column, phrases: list[str]) -> Column:
    """Non-overlapping whole-word matches of any of the phrases.

    Case needs no folding, since cleaned text is lower-case. The pattern engine
    runs only on rows that hold the first word of some phrase; a byte-wise
    ``contains`` rules out all others.
    """
    # The left boundary is tested behind the first word, not in front of it:
    # most positions then fail on one character instead of on a look-behind.
    alternatives = []
    for phrase in phrases:
        first, *rest = phrase.split(" ")
        bounded = f"{first}(?<!{lx.WORD}{first})"
        alternatives.append(f"{lx.BLANK}+".join([bounded, *rest]))
    pattern = f"(?:{'|'.join(alternatives)})(?!{lx.WORD})"
    first_words = dict.fromkeys(p.split(" ")[0] for p in phrases)
    possible = reduce(or_, [cleaned.contains(w) for w in first_words])
    return F.when(possible, F.regexp_count(cleaned, F.lit(pattern))).otherwise(F.lit(0))


def words_present(cleaned: Column, words: list[str]) -> Column:
    """How many of the words occur as substrings."""
    return reduce(add, [cleaned.contains(w).cast("int") for w in words])


def stepwise(cleaned: Column, words: list[str], step: float) -> Column:
    """Add ``step`` once per word present, one after the other, capped at 1.

    Added term by term because 0.1 + 0.1 + 0.1 and 3 * 0.1 differ in the last bit.
    """
    return stepped([cleaned.contains(w) for w in words], step)


def stepped(present: list[Column], step: float) -> Column:
    steps = [F.when(p, F.lit(step)).otherwise(F.lit(0.0)) for p in present]
    return F.least(F.lit(1.0), reduce(add, steps, F.lit(0.0)))


def leaning(
    cleaned: Column,
    phrase_groups: list[list[str]],
    words: list[str],
    phrase_step: float = lx.PHRASE_STEP,
    word_step: float = lx.WORD_STEP,
) -> Column:
    """Phrase hits plus words present, capped at 1."""
    return leaned(
        [phrase_count(cleaned, group) for group in phrase_groups], [cleaned.contains(w) for w in words], phrase_step, word_step
    )


def leaned(hits: list[Column], present: list[Column], phrase_step: float, word_step: float) -> Column:
    parts = [n * F.lit(phrase_step) for n in hits]
    parts += [F.when(p, F.lit(word_step)).otherwise(F.lit(0.0)) for p in present]
    return F.least(F.lit(1.0), reduce(add, parts, F.lit(0.0)))


def marked_leaning(marks: Column, phrase_groups: list[list[str]], words: list[str]) -> Column:
    """``leaning`` by the default steps, from the marks of a text."""
    hits = [marks[f"phrases{PHRASES.index(group)}"] for group in phrase_groups]
    return leaned(hits, [held(marks, w) for w in words], lx.PHRASE_STEP, lx.WORD_STEP)


def bullish_score(cleaned: Column) -> Column:
    return leaning(cleaned, lx.BULLISH_PHRASES, lx.BULLISH_WORDS)


def bearish_score(cleaned: Column) -> Column:
    return leaning(cleaned, lx.BEARISH_PHRASES, lx.BEARISH_WORDS)


def volatility_score(cleaned: Column) -> Column:
    return stepwise(cleaned, lx.VOLATILITY_WORDS, lx.VOLATILITY_STEP)


def marked_bullish(marks: Column) -> Column:
    return marked_leaning(marks, lx.BULLISH_PHRASES, lx.BULLISH_WORDS)


def marked_bearish(marks: Column) -> Column:
    return marked_leaning(marks, lx.BEARISH_PHRASES, lx.BEARISH_WORDS)


def marked_volatility(marks: Column) -> Column:
    return stepped([held(marks, w) for w in lx.VOLATILITY_WORDS], lx.VOLATILITY_STEP)


def feature_text(cleaned: Column) -> Column:
    """Second cleaning before tokenising: a run of blanks and punctuation becomes one blank."""
    return F.lower(F.trim(F.regexp_replace(cleaned, f"{lx.NOT_WORD}+", " ")))


def _counted(text: Column, pattern: str) -> Column:
    digits = F.regexp_replace(F.regexp_extract(text, pattern, 1), ",", "")
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def engagement_counts(text: Column) -> Column:
    """Struct of the first 'N likes', 'N retweets' and 'N replies' in a text."""
    return F.struct(
        _counted(text, lx.LIKES_PATTERN).alias("likes"),
        _counted(text, lx.RETWEETS_PATTERN).alias("retweets"),
        _counted(text, lx.REPLIES_PATTERN).alias("replies"),
    )


def post_url(username: Column, post_id: Column, pattern: str = lx.POST_URL_FORMAT) -> Column:
    return F.format_string(pattern, username, post_id)


def content_hash(username: Column, timestamp: Column, content: Column) -> Column:
    """md5 of user, time (fixed-width microseconds, UTC) and content."""
    when = F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    blank = F.lit("")
    return F.md5(
        F.concat_ws(
            "_", F.coalesce(username, blank), F.coalesce(when, blank), F.coalesce(content, blank)
        )
    )
