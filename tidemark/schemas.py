"""Fixed column contracts of the snapshot, raw, cleaned, staging and history tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names and their order are the data contract ---------

MATCH_COUNTS = [
    "goals", "assists", "own_goals", "yellow_cards", "second_yellow_red_cards", "red_cards",
]
MATCH_MINUTES = ["subbed_on_minute", "subbed_off_minute"]

MATCH_COLUMNS = [
    "player_name", "player_id", "season", "competition_code",
    "matchday", "match_date", "venue", "home_team", "away_team",
    "result", "position",
    "goals", "assists", "own_goals", "yellow_cards", "second_yellow_red_cards", "red_cards",
    "subbed_on_minute", "subbed_off_minute", "performance_rating", "minutes_played", "note",
]

CLEAN_COLUMNS = [
    "season", "season_label", "bronze_scrape_date", "transformed_at", "club",
    "player_name", "player_id", "competition_code",
    "matchday", "match_date", "match_date_iso", "venue",
    "home_team", "home_team_name", "home_team_rank",
    "away_team", "away_team_name", "away_team_rank",
    "result", "position",
    "goals", "assists", "own_goals", "yellow_cards", "second_yellow_red_cards", "red_cards",
    "subbed_on_minute", "subbed_off_minute", "performance_rating", "minutes_played", "note",
]

INT_COLUMNS = [
    "matchday", "home_team_rank", "away_team_rank",
    "goals", "assists", "own_goals", "yellow_cards", "second_yellow_red_cards", "red_cards",
    "subbed_on_minute", "subbed_off_minute", "minutes_played",
]
FLOAT_COLUMNS = ["performance_rating"]

NATURAL_KEY = ["team", "season", "player_id", "competition_code", "matchday"]
SLICE = ["team", "season"]
STAGING_PARTITIONS = ["team", "season", "bronze_scrape_date"]
SNAPSHOT_PARTITIONS = ["source", "team", "artifact", "season", "scrape_date"]

# --- schemas built from the contract ------------------------------------------


def text_schema(columns: list[str]) -> T.StructType:
    """All-text schema, for CSV input and the forgiving staging table."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def _typed(columns: list[str], integer: T.DataType) -> T.StructType:
    def of(name: str) -> T.DataType:
        if name in INT_COLUMNS:
            return integer
        return T.DoubleType() if name in FLOAT_COLUMNS else T.StringType()

    return T.StructType([T.StructField(name, of(name)) for name in columns])


MATCH_ROW = _typed(MATCH_COLUMNS, T.LongType())
CLEAN_ROW = _typed(CLEAN_COLUMNS, T.LongType())
RAW_COLUMNS = MATCH_COLUMNS + ["scrape_date", "scraped_at"]
RAW_ROW = text_schema(RAW_COLUMNS)

# Staging carries the team: without it, two teams staged on one date would be
# merged into each other.
STAGING_ROW = text_schema(["team"] + CLEAN_COLUMNS)
HISTORY_ROW = T.StructType(
    text_schema(["team"] + CLEAN_COLUMNS).fields + [T.StructField("ingested_at", T.TimestampType())]
)

CLUB = text_schema(["team_key", "club_name", "club_slug", "club_id", "team_url"])
PLAYER = text_schema(["player_name", "player_slug", "player_id", "player_url"])

LEAGUE_SNAPSHOT = T.StructType(
    text_schema(["league_id", "season", "season_label", "scraped_at"]).fields
    + [T.StructField("teams", T.ArrayType(CLUB)), T.StructField("teams_found", T.LongType())]
)
ROSTER_SNAPSHOT = T.StructType(
    text_schema(["team", "season", "season_label", "club", "club_id", "scraped_at"]).fields
    + [T.StructField("players", T.ArrayType(PLAYER))]
)
PLAYER_SNAPSHOT = T.StructType(
    text_schema(
        ["team", "season", "season_label", "club", "player_name", "player_id", "scraped_at"]
    ).fields
    + [T.StructField("player_stats", T.ArrayType(MATCH_ROW))]
)
