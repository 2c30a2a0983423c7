"""Small configured dimensions. Everything larger is a DataFrame."""

from __future__ import annotations

# --- fixed values ---------------------------------------------------------------

SEASON_LABELS = {str(year): f"{year}/{year + 1}" for year in range(2021, 2026)}
LEAGUE_SLUGS = {"GB1": "premier-league"}
DEFAULT_COMPETITION = "GB1"
DEFAULT_CLUB_ID = "985"
CONFIGURED_TEAMS = {
    "manchester_united": {
        "club_name": "Manchester United",
        "club_slug": "manchester-united",
        "club_id": "985",
    },
}

RAW_ARTIFACTS = [
    "league_teams",
    "team_roster",
    "player_detailed_stats_individual",
    "player_detailed_stats_combined",
]
RAW_PREFIX = "raw"
CLEANED_PREFIX = "cleaned"

MINIMUM_ROWS = 50
RETENTION_DAYS = 14
SPOT_CHECK_ROWS = 25
