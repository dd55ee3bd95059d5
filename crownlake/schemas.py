"""Declared schemas for every layer. Nothing is inferred.

Inference breaks on real landings: a battle log holding ``[]`` infers as an
empty struct and an empty card list infers as ``array<string>``. Reading with
these schemas keeps the first ``select`` of every job valid.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, F = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType()
TS, TS_NTZ, DATE = T.TimestampType(), T.TimestampNTZType(), T.DateType()
STR_ARRAY = T.ArrayType(S, containsNull=True)


def _fields(*specs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in specs])


# --- raw API payloads (camelCase, as returned by the game API) -------------

RAW_CARD_NAME = _fields(("name", S))

RAW_PROFILE_CARD = _fields(
    ("id", I),
    ("name", S),
    ("level", I),
    ("maxLevel", I),
    ("rarity", S),
    ("elixirCost", I),
    ("count", I),
)

RAW_CLAN = _fields(("tag", S), ("name", S))

RAW_PROFILE = _fields(
    ("tag", S),
    ("name", S),
    ("expLevel", I),
    ("trophies", I),
    ("bestTrophies", I),
    ("wins", I),
    ("losses", I),
    ("battleCount", I),
    ("cards", T.ArrayType(RAW_PROFILE_CARD)),
    ("clan", RAW_CLAN),
)

RAW_TEAM_MEMBER = _fields(
    ("tag", S),
    ("crowns", I),
    ("startingTrophies", I),
    ("elixirLeaked", D),
    ("cards", T.ArrayType(RAW_CARD_NAME)),
)

# One element of a battle-log array.
RAW_BATTLE = _fields(
    ("battleTime", S),
    ("type", S),
    ("team", T.ArrayType(RAW_TEAM_MEMBER)),
    ("opponent", T.ArrayType(RAW_TEAM_MEMBER)),
)

# --- bronze (flat records, snake_case) -------------------------------------

BRONZE_CARD = _fields(
    ("id", I),
    ("name", S),
    ("level", I),
    ("max_level", I),
    ("rarity", S),
    ("elixir_cost", I),
    ("count", I),
)

BRONZE_BATTLES = _fields(
    ("battle_time", S),
    ("battle_type", S),
    ("result", S),
    ("player_tag", S),
    ("player_trophies", L),
    ("player_deck", STR_ARRAY),
    ("player_elixir_avg", D),
    ("crowns_player", I),
    ("crowns_opponent", I),
    ("opponent_tag", S),
    ("opponent_deck", STR_ARRAY),
)

BRONZE_PROFILE = _fields(
    ("tag", S),
    ("name", S),
    ("level", I),
    ("trophies", I),
    ("best_trophies", I),
    ("wins", I),
    ("losses", I),
    ("battle_count", I),
    ("cards", T.ArrayType(BRONZE_CARD)),
    ("clan_name", S),
    ("clan_tag", S),
)

# Provenance columns carried next to every bronze record. In the per-player
# layout they are object metadata; here they are plain columns.
PROVENANCE = _fields(
    ("ingestion_date", DATE),   # the landing day (from the path)
    ("ingested_at", TS_NTZ),    # when the pull landed (UTC wall clock)
    ("source", S),
    ("pipeline_version", S),
    ("source_seq", L),          # landing order inside a day, when known
)

# --- silver ------------------------------------------------------------------

SILVER_BATTLE_COLUMNS = [
    "player_tag", "battle_time", "battle_type", "result", "player_trophies",
    "player_deck", "player_elixir_avg", "crowns_player", "crowns_opponent",
    "opponent_tag", "opponent_deck", "ingestion_date", "battle_id", "deck_hash",
]

SILVER_PROFILE_COLUMNS = [
    "player_tag", "player_name", "level", "trophies", "best_trophies", "wins",
    "losses", "battle_count", "clan_name", "clan_tag", "win_rate", "snapshot_at",
    "ingestion_date",
]

FACT_BATTLE_COLUMNS = [
    "battle_id", "player_tag", "battle_time", "battle_type", "result",
    "crowns_player", "crowns_opponent", "player_elixir_avg", "deck_hash",
    "opponent_tag", "ingestion_date",
]

DIM_PLAYER_COLUMNS = [
    "player_tag", "player_name", "level", "trophies", "best_trophies", "wins",
    "losses", "battle_count", "win_rate", "clan_name", "clan_tag", "snapshot_at",
]
