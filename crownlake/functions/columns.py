"""Column expressions shared by the jobs (all JVM-side, no UDFs).

Each helper takes and returns a ``Column`` so Catalyst can fold, push down
and code-generate it like any built-in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for results to
# match; they are listed here together, in their natural order.
# ---------------------------------------------------------------------------
RESULT_WIN = "win"
RESULT_LOSS = "loss"
RESULT_DRAW = "draw"
DEFAULT_BATTLE_TYPE = "unknown"
LEADERBOARD_BATTLE_TYPES = ("Ladder", "PvP")
PVP_BATTLE_TYPE = "PvP"
# Outcome labels of the saved elixir query: win -> Winner, anything else -> Loser.
OUTCOME_LABELS_SAVED = ("Winner", "Loser")
# Outcome labels of the dashboard elixir panel: win -> Vitória, anything else -> Derrota.
OUTCOME_LABELS_DASHBOARD = ("Vitória", "Derrota")
# Timestamp text of the API, e.g. 20240115T123456.000Z (offset parsed, not quoted).
API_TIME_PATTERN = "yyyyMMdd'T'HHmmss.SSSX"
# Pattern used to render a UTC instant back into API text.
API_TIME_RENDER = "yyyyMMdd'T'HHmmss.SSS'Z'"
BATTLE_ID_SEPARATOR = "_"
DECK_HASH_SEPARATOR = "|"
TAG_MARK = "#"
SOURCE_NAME = "game-api"
PIPELINE_VERSION = "1.0"
# ---------------------------------------------------------------------------


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_tag(c: Column | str) -> Column:
    """Remove every ``#``, upper-case, strip surrounding whitespace."""
    no_mark = F.regexp_replace(col_(c), TAG_MARK, "")
    return F.regexp_replace(F.upper(no_mark), r"^\s+|\s+$", "")


def strip_mark(c: Column | str) -> Column:
    """Remove every ``#`` only (profile and opponent tags)."""
    return F.regexp_replace(col_(c), TAG_MARK, "")


def parse_api_time(c: Column | str) -> Column:
    """API time text -> UTC wall-clock ``timestamp_ntz``; bad text -> NULL.

    The offset is parsed (``X``), so the instant does not depend on the session
    zone, and the conversion to ``timestamp_ntz`` goes through epoch micros,
    which is zone-independent too.
    """
    instant = F.try_to_timestamp(col_(c), F.lit(API_TIME_PATTERN))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch_ntz())


def parse_iso_instant(c: Column | str) -> Column:
    """ISO-8601 text (offset optional, UTC assumed) -> UTC ``timestamp_ntz``."""
    instant = F.try_to_timestamp(col_(c))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch_ntz())


def ntz_to_instant(c: Column | str) -> Column:
    """UTC wall-clock ``timestamp_ntz`` -> ``timestamp`` instant (zone-independent)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), col_(c)))


def render_api_time(c: Column | str) -> Column:
    """UTC wall-clock timestamp -> API time text."""
    return F.date_format(col_(c).cast("timestamp_ntz"), API_TIME_RENDER)


def battle_id(player_tag: Column | str, battle_time: Column | str) -> Column:
    """md5 of ``player_tag _ battle_time-as-text`` (nulls skipped by concat_ws)."""
    return F.md5(F.concat_ws(BATTLE_ID_SEPARATOR, col_(player_tag), col_(battle_time).cast("string")))


def deck_hash(deck: Column | str) -> Column:
    """Order-insensitive deck key: md5 of the sorted card names joined by ``|``."""
    return F.md5(F.array_join(F.sort_array(col_(deck)), DECK_HASH_SEPARATOR))


def is_win(result: Column | str = "result") -> Column:
    return col_(result) == F.lit(RESULT_WIN)


def count_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """``round(cast(num as double) / den * 100, digits)`` — one rule everywhere."""
    return F.round(col_(num).cast("double") / col_(den) * F.lit(100.0), digits)


def guarded_pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """Percentage, 0.0 when the denominator is not > 0."""
    return F.when(col_(den) > 0, pct(num, den, digits)).otherwise(F.lit(0.0))


def result_from_crowns(player: Column | str, opponent: Column | str) -> Column:
    p, o = col_(player), col_(opponent)
    return (
        F.when(p > o, F.lit(RESULT_WIN))
        .when(p < o, F.lit(RESULT_LOSS))
        .otherwise(F.lit(RESULT_DRAW))
    )


def outcome_label(result: Column | str, labels: tuple[str, str] = OUTCOME_LABELS_SAVED) -> Column:
    return F.when(is_win(result), F.lit(labels[0])).otherwise(F.lit(labels[1]))


def card_names(cards: Column | str) -> Column:
    """``[c.name for c in cards]``; a missing list gives an empty array."""
    return F.transform(F.coalesce(col_(cards), F.array()), lambda c: c["name"])


def first_or_null(arr: Column | str) -> Column:
    """``arr[0]`` that yields NULL (not an error) for empty or null arrays."""
    return F.get(col_(arr), 0)


def multiplicity(arr: Column | str, value: Column | str) -> Column:
    """How many elements of ``arr`` are (null-safely) equal to ``value``."""
    v = col_(value)
    return F.size(F.filter(col_(arr), lambda x: x.eqNullSafe(v)))


def to_json_text(c: Column | str) -> Column:
    """Record -> JSON text (non-ASCII kept as is)."""
    return F.to_json(col_(c))


def from_json_text(c: Column | str, schema) -> Column:
    """JSON text -> record with a declared schema (bad text -> NULL fields)."""
    return F.from_json(col_(c), schema)


def render_deck(deck: Column | str) -> Column:
    """Array -> ``[a, b, c]`` text, the way SQL result pages render arrays."""
    return F.concat(F.lit("["), F.array_join(col_(deck), ", "), F.lit("]"))


def parse_deck(text: Column | str) -> Column:
    """``[a, b]`` text -> array of trimmed names; other text or NULL -> empty array.

    Brackets are stripped from both ends, the rest is split on ``,`` and each
    piece is whitespace-trimmed, so ``[]`` gives one empty string.
    """
    t = col_(text)
    inner = F.regexp_replace(t, r"^[\[\]]+|[\[\]]+$", "")
    pieces = F.transform(F.split(inner, ","), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.when(t.startswith("["), pieces).otherwise(F.array().cast("array<string>"))


def to_number(c: Column | str) -> Column:
    """Text -> double; bad or empty text -> NULL."""
    return F.regexp_replace(col_(c).cast("string"), r"^\s+|\s+$", "").try_cast("double")


def to_date_or_null(c: Column | str) -> Column:
    return col_(c).cast("string").try_cast("date")


def clamp_at_zero(c: Column | str) -> Column:
    return F.greatest(F.lit(0), col_(c))


def falsy_default(c: Column | str, default) -> Column:
    """``x or default``: NULL and 0 both fall back to the default."""
    x = col_(c)
    return F.when(x.isNull() | (x == 0), F.lit(default)).otherwise(x)


def thousands(c: Column | str) -> Column:
    """Integer text with thousands separators (``1,234``)."""
    return F.format_number(col_(c).cast("bigint"), 0)


def percent_text(c: Column | str) -> Column:
    return F.concat(col_(c).cast("string"), F.lit("%"))
