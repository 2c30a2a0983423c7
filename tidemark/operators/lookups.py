"""Lookups with defaults, and the team dimension."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_CLUB_ID
from tidemark.functions.text import blank_to_null, capitalize_words, team_key_to_slug

def label(value: Column, labels: dict[str, str], default: Column | None = None) -> Column:
    """Configured label, else the default (the value itself).

    The dictionary becomes one literal of the plan; a dimension that grows with the data is a
    DataFrame and goes through ``lookup_default``.
    """
    fallback = value if default is None else default
    if not labels:
        return fallback
    table = F.from_json(F.lit(json.dumps(labels)), "map<string,string>")
    return F.coalesce(F.try_element_at(table, value), fallback)


def lookup_default(
    df: DataFrame, dimension: DataFrame, on: str, column: str, default: Column
) -> DataFrame:
    """Left lookup of ``column``; a key without entry gets the default.

    No broadcast hint: the planner broadcasts a dimension whose measured size
    is below the threshold, and AQE splits hot keys of the fact side beyond it.
    """
    entry = dimension.select(F.col(on), F.col(column).alias("_found"))
    return (
        df.join(entry, on, "left")
        .withColumn(column, F.coalesce("_found", default))
        .drop("_found")
    )


def resolve_teams(requests: DataFrame, known: DataFrame, strict: bool = False) -> DataFrame:
    """Identity of each requested team (team, club_name, club_slug, club_id).

    A known team wins. Otherwise all three given fields are taken together;
    with fewer, the missing ones are derived from the key, or in ``strict``
    mode the request is an error.
    """
    dimension = known.select(
        F.col("team_key").alias("team"),
        *[F.col(c).alias(f"_{c}") for c in ("club_name", "club_slug", "club_id")],
        F.lit(True).alias("_known"),
    )
    given = {
        c: blank_to_null(F.col(c).cast("string")) for c in ("club_name", "club_slug", "club_id")
    }
    complete = given["club_name"].isNotNull() & given["club_slug"].isNotNull() & given[
        "club_id"].isNotNull()
    derived = {
        "club_name": F.coalesce(given["club_name"], capitalize_words(F.col("team"), "_")),
        "club_slug": F.coalesce(given["club_slug"], team_key_to_slug(F.col("team"))),
        "club_id": F.coalesce(given["club_id"], F.lit(DEFAULT_CLUB_ID)),
    }
    refused = F.raise_error(F.concat(F.lit("team without identity: "), F.col("team")))

    def resolved(name: str) -> Column:
        fallback = refused.cast("string") if strict else derived[name]
        return (
            F.when(F.col("_known"), F.col(f"_{name}")).when(complete, given[name]).otherwise(fallback)
        )

    origin = F.when(F.col("_known"), "known").when(complete, "given").otherwise("derived")
    joined = requests.join(dimension, "team", "left")
    return joined.withColumns(
        {**{name: resolved(name) for name in given}, "origin": origin}
    ).drop("_known", "_club_name", "_club_slug", "_club_id")


def first_name(*candidates: Column) -> Column:
    """First non-blank name."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])
