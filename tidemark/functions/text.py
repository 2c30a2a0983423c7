"""Text rules: stripping, slugs, selectors, name/rank splitting."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Python calls white space; Spark's trim only knows the blank.
SPACES = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def _class(chars: str) -> str:
    """Character class of sorted characters.

    The matcher tests every range of a class in turn, but single characters below 256 by one look into a
    table. So these stand alone, and the ranges above come behind one test that most characters fail.
    """
    low = [ord(c) for c in chars if c < "\u0100"]
    runs: list[list[int]] = []
    for code in (ord(c) for c in chars if c >= "\u0100"):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    high = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in runs)
    span = rf"\x{{{runs[0][0]:x}}}-\x{{{runs[-1][1]:x}}}"
    return "[" + "".join(rf"\x{{{code:x}}}" for code in low) + f"[{span}&&[{high}]]]"


SPACE = _class(SPACES)


def _ranges(chars: str) -> str:
    """The same class without an intersection, which other engines do not have."""
    runs: list[list[int]] = []
    for code in map(ord, chars):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in runs) + "]"


SPACE_SQL = _ranges(SPACES)

NAME_RANK = r"(?d)^(.*?)" + SPACE + r"*\(([0-9]+)\.\)\z"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_index(values: Column, test: Callable[[Column], Column]) -> Column:
    """Zero-based position of the first element that passes, null if none does."""
    return F.array_min(F.transform(values, lambda value, at: F.when(test(value), at)))


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(SPACES))


def blank_to_null(value: Column) -> Column:
    return F.when(value != "", value)


def clean_value(value: Column) -> Column:
    """Null becomes the empty text, outer white space goes."""
    return strip(F.coalesce(value, F.lit("")))


def collapse_spaces(value: Column) -> Column:
    return F.regexp_replace(clean_value(value), SPACE + "+", " ")


def capitalize_words(value: Column, separator: str) -> Column:
    """Each part gets one capital and lower-case rest; digits and brackets stay."""
    parts = F.split(value, f"\\Q{separator}\\E")
    return F.array_join(
        F.transform(
            parts,
            lambda part: F.concat(
                F.upper(F.substring(part, 1, 1)), F.lower(F.substr(part, F.lit(2)))
            ),
        ),
        " ",
    )


def slug_to_name(slug: Column) -> Column:
    return capitalize_words(slug, "-")


def team_key(club_name: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(club_name), "[^a-z0-9]+", "_"), F.lit("_"))


def team_key_to_slug(key: Column) -> Column:
    return F.replace(key, F.lit("_"), F.lit("-"))


def entity_key(name: Column, entity_id: Column) -> Column:
    """Folder name of one player: the id, and the slug of the name if there is any."""
    slug = F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-"))
    head = F.concat(F.lit("player_id="), entity_id)
    return F.when(slug != "", F.concat(head, F.lit("_"), slug)).otherwise(head)


def selector(value: Column) -> Column:
    return F.regexp_replace(F.lower(value), "[^a-z0-9]+", "")


def matches_selector(name: Column, slug: Column, wanted: str | None) -> Column:
    """True for every row when nothing is selected."""
    if not wanted:
        return F.lit(True)
    key = selector(F.lit(wanted))
    return (selector(name) == key) | (selector(slug) == key)


def strip_shirt_number(heading: Column) -> Column:
    name = strip(F.regexp_replace(heading, r"^#[0-9]+" + SPACE + "+", ""))
    return bind(name, blank_to_null)


def split_name_rank(value: Column) -> Column:
    """``Leverkusen (6.)`` becomes (Leverkusen, 6); without a rank the text stays whole."""

    def parts(text: Column) -> Column:
        ranked = text.rlike(NAME_RANK)
        return F.struct(
            F.when(ranked, strip(F.regexp_extract(text, NAME_RANK, 1)))
            .otherwise(blank_to_null(text))
            .alias("name"),
            F.when(ranked, F.regexp_extract(text, NAME_RANK, 2).try_cast("bigint")).alias("rank"),
        )

    return bind(strip(value), parts)
