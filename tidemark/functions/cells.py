"""From the cell texts of one table row to a typed match row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import is_match_date
from tidemark.functions.html import Apart
from tidemark.functions.numbers import parse_minutes, parse_stat, to_float, to_int
from tidemark.functions.text import bind, blank_to_null, first_index
from tidemark.schemas import MATCH_COUNTS, MATCH_MINUTES

# --- fixed values ---------------------------------------------------------------
RESULT = r"^[0-9]+:[0-9]+\z"
VENUES = ["H", "A"]
STATUS_WORDS = ["injury", "problems", "absence", "suspended", "calf", "thigh", "ankle"]
STAT_CELLS = MATCH_COUNTS + MATCH_MINUTES + ["performance_rating", "minutes_played"]
MINIMUM_CELLS = 6
PROBED_ROWS = 8
DATED_ROWS = 2


def at(values: Column, index: int) -> Column:
    """Cell by position, '' behind the end of the row; cell texts are already stripped."""
    return F.coalesce(F.get(values, F.lit(index)), F.lit(""))


def joined_note(values: Column) -> Column:
    return bind(F.array_join(F.filter(values, lambda cell: cell != ""), " "), blank_to_null)


def tail(values: Column, start: Column | int) -> Column:
    """Everything from a zero-based position on."""
    return F.slice(values, F.lit(start) + 1 if isinstance(start, int) else start + 1, F.size(values))


# --- row shape --------------------------------------------------------------------


def starts_dated(first: Column, second: Column) -> Column:
    """A whole number first (zero counts), a date second."""
    return to_int(first).isNotNull() & is_match_date(second)


def is_dated(values: Column) -> Column:
    """Six cells, a whole number first, a date second."""
    return (F.size(values) >= MINIMUM_CELLS) & starts_dated(F.get(values, F.lit(0)), F.get(values, F.lit(1)))


def is_candidate(values: Column) -> Column:
    """A dated row with a matchday; zero is dropped like a missing one."""
    return is_dated(values) & (to_int(F.get(values, F.lit(0))) != 0)


def match_table(page: Apart) -> Column:
    """Zero-based number of the first table with at least two dated rows among its first eight."""
    return page.first_table(PROBED_ROWS, DATED_ROWS, MINIMUM_CELLS, starts_dated)


def is_status_row(values: Column) -> Column:
    words = "|".join(STATUS_WORDS)
    return (
        (F.size(values) >= MINIMUM_CELLS)
        & at(values, 2).isin(VENUES)
        & ((at(values, 3) == "") | (at(values, 5) == ""))
        & F.lower(F.array_join(values, " ")).rlike(words)
    )


def result_index(values: Column) -> Column:
    """Zero-based position of the first score cell, null without one."""
    return first_index(values, lambda cell: F.contains(cell, F.lit(":")) & cell.rlike(RESULT))


# --- contents -----------------------------------------------------------------------


def before_result(values: Column, index: Column) -> Column:
    """Non-blank cells between the date and the score."""
    return F.filter(
        F.slice(values, F.lit(3), F.greatest(index - 2, F.lit(0))), lambda cell: cell != ""
    )


def match_context(before: Column) -> Column:
    """struct(venue, home_team, away_team) from the cells before the score."""

    def parts(cells: Column) -> Column:
        first = F.get(cells, F.lit(0))
        names = F.size(cells) - F.when(first.isin(VENUES), 1).otherwise(0)
        return F.struct(
            F.when(first.isin(VENUES), first).alias("venue"),
            F.when(names >= 2, F.try_element_at(cells, F.lit(-2))).alias("home_team"),
            F.when(names >= 2, F.try_element_at(cells, F.lit(-1))).alias("away_team"),
        )

    return bind(before, parts)


def stat_texts(stats: Column) -> Column:
    """The ten cells behind the position by name, and all later texts as the note."""

    def by_name(cells: Column) -> Column:
        named = [
            blank_to_null(F.get(cells, F.lit(number))).alias(name)
            for number, name in enumerate(STAT_CELLS)
        ]
        return F.struct(*named, joined_note(tail(cells, len(STAT_CELLS))).alias("note"))

    return bind(stats, by_name)


def match_rows(rows: Column, head: dict[str, Column] | None = None) -> Column:
    """array<struct> of match and status rows of a table, typed, in document order.

    Works in steps over the array of rows; each step's value is computed once
    per row and handed on, as the later fields all hang on the score position.
    """
    located = F.transform(
        rows,
        lambda values, number: F.struct(
            number.alias("row_no"),
            values.alias("values"),
            F.when(F.size(values) >= MINIMUM_CELLS, to_int(F.get(values, F.lit(0)))).alias("matchday"),
        ),
    )
    candidates = F.filter(
        located, lambda row: (row["matchday"] != 0) & is_match_date(F.get(row["values"], F.lit(1)))
    )
    shaped = F.transform(
        candidates,
        lambda row: F.struct(
            row["row_no"].alias("row_no"),
            row["values"].alias("values"),
            row["matchday"].alias("matchday"),
            is_status_row(row["values"]).alias("status"),
            result_index(row["values"]).alias("index"),
        ),
    )
    kept = F.filter(shaped, lambda row: row["status"] | row["index"].isNotNull())
    parted = F.transform(
        kept,
        lambda row: F.struct(
            row["row_no"].alias("row_no"),
            row["values"].alias("values"),
            row["matchday"].alias("matchday"),
            row["status"].alias("status"),
            row["index"].alias("index"),
            match_context(before_result(row["values"], row["index"])).alias("context"),
            stat_texts(tail(row["values"], row["index"] + 2)).alias("stats"),
        ),
    )

    def typed(row: Column) -> Column:
        values, status, stats = row["values"], row["status"], row["stats"]

        def played(value: Column) -> Column:
            return F.when(~status, value)

        venue = F.when(status, at(values, 2)).otherwise(row["context"]["venue"])
        note = F.when(status, joined_note(tail(values, 6))).otherwise(stats["note"])
        return F.struct(
            row["row_no"].alias("row_no"),
            *[value.alias(name) for name, value in (head or {}).items()],
            row["matchday"].alias("matchday"),
            at(values, 1).alias("match_date"),
            venue.alias("venue"),
            played(row["context"]["home_team"]).alias("home_team"),
            played(row["context"]["away_team"]).alias("away_team"),
            played(F.get(values, row["index"])).alias("result"),
            played(F.get(values, row["index"] + 1)).alias("position"),
            *[played(parse_stat(stats[name])).alias(name) for name in MATCH_COUNTS],
            *[played(parse_minutes(stats[name])).alias(name) for name in MATCH_MINUTES],
            played(to_float(stats["performance_rating"])).alias("performance_rating"),
            played(parse_minutes(stats["minutes_played"])).alias("minutes_played"),
            note.alias("note"),
        )

    return F.transform(parted, typed)
