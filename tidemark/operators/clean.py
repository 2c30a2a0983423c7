"""Raw text rows to the cleaned column contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import SEASON_LABELS
from tidemark.functions.dates import iso_match_date
from tidemark.functions.nulls import missing_to_null
from tidemark.functions.numbers import parse_float, parse_int
from tidemark.functions.text import split_name_rank
from tidemark.operators.lookups import label
from tidemark.schemas import CLEAN_ROW, FLOAT_COLUMNS, INT_COLUMNS, MATCH_COLUMNS

REJECTED = "_rejected"


def normalize_nulls(df: DataFrame, columns: list[str] | None = None, tokens: bool = True) -> DataFrame:
    """Blank text and missing-value words become null, in every text column by default."""
    texts = columns or [
        field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)
    ]
    return df.withColumns({c: missing_to_null(F.col(c), tokens) for c in texts})


def blanks_for_nulls(df: DataFrame) -> DataFrame:
    """The other reading of the same file: missing fields as empty text."""
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])


def typed_columns(
    df: DataFrame, ints: list[str] = INT_COLUMNS, floats: list[str] = FLOAT_COLUMNS,
    strict: bool = False,
) -> DataFrame:
    """Long and double columns from text.

    ``strict`` fails the job on a text that is no number. Otherwise the field is
    null, its name is added to ``_rejected``, and all other rows go on.
    """
    casts = {c: parse_int(F.col(c)) for c in ints if c in df.columns}
    casts |= {c: parse_float(F.col(c)) for c in floats if c in df.columns}
    # a column that already has its type cannot hold a bad text
    texts = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.NullType))
    }
    casts = {c: cast for c, cast in casts.items() if c in texts}

    # each number is read once, beside its text, and takes the text's place afterwards
    read = df.withColumns({f"_{c}": cast for c, cast in casts.items()})

    def bad(name: str) -> Column:
        return F.col(name).isNotNull() & F.col(f"_{name}").isNull()

    def settled(name: str) -> Column:
        if not strict:
            return F.col(f"_{name}")
        refused = F.raise_error(F.concat(F.lit(f"{name} is no number: "), F.col(name)))
        kind = "double" if name in floats else "bigint"
        return F.when(bad(name), refused.cast(kind)).otherwise(F.col(f"_{name}"))

    changed = {c: settled(c) for c in casts}
    if not strict:
        changed[REJECTED] = F.array_compact(F.array(*[F.when(bad(c), F.lit(c)) for c in casts]))
    return read.withColumns(changed).drop(*[f"_{c}" for c in casts])


def project(df: DataFrame, schema: T.StructType, extra: list[str] | None = None) -> DataFrame:
    """Exactly the columns of the contract, in order; missing ones are null, others go."""
    return df.select(
        *(extra or []),
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
    )


def match_columns(
    df: DataFrame, season: Column, club: Column, labels: dict[str, str] = SEASON_LABELS
) -> DataFrame:
    """Adds season label, club, ISO date and the name/rank parts of both teams."""
    home, away = split_name_rank(F.col("home_team")), split_name_rank(F.col("away_team"))
    return df.withColumns({"_home": home, "_away": away}).withColumns(
        {
            "season_label": label(season, labels),
            "club": club,
            "match_date_iso": iso_match_date(F.col("match_date")),
            "home_team_name": F.col("_home.name"),
            "home_team_rank": F.col("_home.rank"),
            "away_team_name": F.col("_away.name"),
            "away_team_rank": F.col("_away.rank"),
        }
    ).drop("_home", "_away")


def changed_row(row: Column, season_label: Column, club: Column) -> Column:
    """The same columns added to a row inside a nested snapshot."""
    home, away = split_name_rank(row["home_team"]), split_name_rank(row["away_team"])
    added = {
        "season_label": season_label,
        "club": club,
        "match_date_iso": iso_match_date(row["match_date"]),
        "home_team_name": home["name"],
        "home_team_rank": home["rank"],
        "away_team_name": away["name"],
        "away_team_rank": away["rank"],
    }
    return reduce(lambda r, item: r.withField(*item), added.items(), row)


def clean_matches(
    raw: DataFrame, transformed_at: Column, club: Column, scrape_date: Column | None = None,
    labels: dict[str, str] = SEASON_LABELS, strict: bool = False, keep: list[str] | None = None,
) -> DataFrame:
    """Raw match rows of any number of slices to cleaned rows, as one projection chain.

    ``keep`` lists columns carried besides the contract, such as the team.
    """
    texts = [
        f.name for f in raw.schema.fields
        if f.name in MATCH_COLUMNS and isinstance(f.dataType, T.StringType)
    ]
    stamped = normalize_nulls(raw, texts).withColumns(
        {
            "bronze_scrape_date": F.col("scrape_date") if scrape_date is None else scrape_date,
            "transformed_at": transformed_at,
        }
    )
    changed = match_columns(stamped, F.col("season"), club, labels)
    typed = typed_columns(changed, strict=strict)
    extra = list(keep or []) + ([] if strict else [REJECTED])
    return project(typed, CLEAN_ROW, extra)
