"""Column expressions shared by the operators.

Everything here is a built-in Spark expression, so it stays inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original job's for equal results.
RATING_LOG_PREFIX = "PRODUCT_RATING_PREFIX:"
LIKE_ABOVE = 3.0            # a recent rating counts as a like when score > 3
MIN_SCORING_SIM = 0.4       # neighbours used for scoring need sim >= 0.4
MIN_STORED_SIM = 0.6        # similarity lists keep sim > 0.6
RECENT_RATINGS = 21         # list range 0..20 is inclusive -> 21 items
CANDIDATES = 20             # unrated similar products per message
USER_RECS = 20              # top-k of the factor model per user
ITEM_NEIGHBOURS = 10        # top-k of the co-occurrence model per product
HASHED_FEATURES = 300       # buckets of the hashed term frequency

# Characters removed by a JVM String.trim(): every code point <= U+0020.
_TRIM = "[\\x00-\\x20]"
# Whitespace class of a JVM regex "\s" written out so that every engine
# reads it the same way.
WS = "[ \\t\\n\\x0B\\f\\r]"
WS_CHARS = " \t\n\x0b\f\r"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def jvm_trim(x) -> Column:
    """Trim like String.trim(): control characters and space at both ends."""
    return F.regexp_replace(_c(x), f"^{_TRIM}+|{_TRIM}+$", "")


def split_fields(x, delim_regex: str) -> Column:
    """Split like String.split(regex): trailing empty fields are dropped."""
    return F.split(F.regexp_replace(_c(x), f"(?:{delim_regex})+$", ""), delim_regex)


def field(arr: Column, i: int) -> Column:
    """0-based element, NULL when the row is too short."""
    return F.get(arr, i)


def epoch_seconds(ts) -> Column:
    """Seconds since the epoch (session zone is UTC) as INT."""
    return F.unix_timestamp(_c(ts)).cast("int")


def year_month(epoch_s) -> Column:
    """Epoch seconds -> yyyyMM as INT, in the session time zone."""
    return F.date_format(F.timestamp_seconds(_c(epoch_s)), "yyyyMM").cast("int")


def cooccurrence_sim(co, n1, n2) -> Column:
    """co / sqrt(n1 * n2), multiplied as doubles so large counts cannot overflow."""
    return _c(co) / F.sqrt(_c(n1).cast("double") * _c(n2).cast("double"))


def recommendation_level(mean_weighted, likes, dislikes) -> Column:
    """avg(sim*score) + log10(max(likes,1)) - log10(max(dislikes,1))."""
    return (_c(mean_weighted)
            + F.log10(F.greatest(_c(likes), F.lit(1)).cast("double"))
            - F.log10(F.greatest(_c(dislikes), F.lit(1)).cast("double")))


def text_after_prefix(x, prefix: str = RATING_LOG_PREFIX) -> Column:
    """Text between the first and a possible second prefix, trimmed.

    NULL when the prefix is absent or nothing but blanks follows it.
    """
    quoted = "\\Q" + prefix + "\\E"
    piece = jvm_trim(field(F.split(_c(x), quoted), 1))
    return F.when(F.instr(_c(x), prefix) > 0, F.nullif(piece, F.lit("")))


def tag_tokens(tags) -> Column:
    """Tokens of a '|'-separated tag string, as the ML Tokenizer makes them.

    '|' becomes a space, text is lower-cased and split on single whitespace
    characters: inner runs give empty tokens, trailing ones vanish, an empty
    string gives one empty token and a blank-only string gives none.
    """
    s = F.lower(F.translate(_c(tags), "|", " "))
    stripped = F.rtrim(s, F.lit(WS_CHARS))
    return (F.when((stripped == "") & (s != ""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, WS)))


def round6(x) -> Column:
    return F.round(_c(x), 6)


def rank_key(x) -> Column:
    """Similarity rounded to 9 places, used for thresholds and ordering so that
    last-bit differences between engines cannot reorder ties."""
    return F.round(_c(x), 9)
