"""From crawled pages to links, clubs, players and match rows, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import html as H
from tidemark.functions import urls as U
from tidemark.functions.cells import match_rows, match_table
from tidemark.functions.text import (
    bind, clean_value, collapse_spaces, slug_to_name, team_key,
)
from tidemark.operators.lookups import first_name
from tidemark.operators.nest import each_row, flatten_rows


def _others(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every anchor: pos, href, title, text."""
    kept = _others(pages, html)
    return flatten_rows(pages.withColumn("_found", H.anchors(F.col(html))), "_found", kept)


def _first_by_id(df: DataFrame, found: str) -> DataFrame:
    """Of structs (id, pos, …) in an array, the first of each id, in document order.

    Sorted by (id, pos), the first of an id is the one whose left neighbour has
    another id: linear after the sort, and the page never leaves its row.
    """
    sorted_ = df.withColumn(found, F.array_sort(found))
    firsts = F.filter(
        F.col(found),
        lambda x, i: (i == 0) | (F.get(F.col(found), i - 1)["id"] != x["id"]),
    )
    by_position = F.transform(firsts, lambda x: F.struct(x["pos"].alias("pos"), x.alias("link")))
    return sorted_.withColumn(found, F.array_sort(by_position))


def _located(pages: DataFrame, base_url: str, html: str, wanted, parts, titled: bool) -> DataFrame:
    """``_found``: array of (id, pos, slug, url, title, text) of the links of each page with a wanted address, if ``titled``
    those with a title; only their titles and texts are read."""
    found = F.filter(H.links(F.col(html), "href"), lambda a: wanted(a["href"]))
    if titled:
        with_title = F.transform(found, lambda a: F.struct(
            a["pos"].alias("pos"), a["href"].alias("href"), H.attribute(a["anchor"], "title").alias("title"), a["anchor"].alias("anchor")))
        found = F.filter(with_title, lambda a: a["title"].isNotNull())
    links = pages.withColumn("_found", found)
    joined = links.withColumn(
        "_found",
        F.transform(
            "_found",
            lambda a: F.struct(
                a["pos"].alias("pos"), (a["title"] if titled else F.lit(None).cast("string")).alias("title"),
                H.text_of(a["anchor"]).alias("text"), U.join_url(base_url, a["href"]).alias("url"),
            ),
        ),
    )
    parted = joined.withColumn(
        "_found",
        F.transform("_found", lambda a: F.struct(parts(a["url"]).alias("parts"), a.alias("link"))),
    )
    good = F.filter("_found", lambda a: a["parts"].isNotNull())
    found = F.transform(
        good,
        lambda a: F.struct(
            a["parts"]["id"].alias("id"), a["link"]["pos"].alias("pos"),
            a["parts"]["slug"].alias("slug"), a["link"]["url"].alias("url"),
            a["link"]["title"].alias("title"), a["link"]["text"].alias("text"),
        ),
    )
    return parted.withColumn("_found", found)


def _first_links(pages: DataFrame, base_url: str, html: str, wanted, parts, fields, titled: bool = False) -> DataFrame:
    """``_found``: of each id the first link, as (pos, ...``fields``), in document order."""
    found = _first_by_id(_located(pages, base_url, html, wanted, parts, titled), "_found")
    named = F.transform("_found", lambda x, at: F.struct(at.alias("pos"), *[v.alias(k) for k, v in fields(x["link"]).items()]))
    return found.withColumn("_found", named)


def _player(link: Column) -> dict[str, Column]:
    return {
        "player_name": first_name(collapse_spaces(link["text"]), slug_to_name(link["slug"])),
        "player_slug": link["slug"], "player_id": link["id"], "player_url": link["url"],
    }


def _club(link: Column) -> dict[str, Column]:
    name = first_name(clean_value(link["title"]), collapse_spaces(link["text"]), slug_to_name(link["slug"]))
    return {
        "team_key": team_key(name), "club_name": name, "club_slug": link["slug"], "club_id": link["id"],
        "team_url": link["url"],
    }


def squad_links(pages: DataFrame, base_url: str, html: str = "html") -> DataFrame:
    """``_found``: players linked from each roster page, each once, in document order; no page leaves its row."""
    return _first_links(
        pages, base_url, html, lambda href: F.contains(href, F.lit(U.PLAYER_LINK)), U.player_parts, _player
    )


def club_links(pages: DataFrame, base_url: str, season: str = "season", html: str = "html") -> DataFrame:
    """``_found``: clubs of exactly the page's season, from titled links, each once, in document order."""
    return _first_links(
        pages, base_url, html,
        lambda href: F.contains(href, F.lit(U.CLUB_LINK))
        & F.contains(href, F.lit(U.SEASON_LINK))
        & (U.club_link_season(href) == F.col(season)),
        U.club_parts, _club, titled=True,
    )


def squad_players(pages: DataFrame, base_url: str, html: str = "html") -> DataFrame:
    """Players linked from roster pages, one per line."""
    return flatten_rows(squad_links(pages, base_url, html), "_found", _others(pages, html))


def league_clubs(
    pages: DataFrame, base_url: str, season: str = "season", html: str = "html"
) -> DataFrame:
    """Clubs of exactly the page's season, one per line."""
    return flatten_rows(club_links(pages, base_url, season, html), "_found", _others(pages, html))


def table_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every table row of every page: table_no, row_no, cells."""
    kept = _others(pages, html)
    by_table = each_row(
        pages.withColumn("_tables", H.tables(F.col(html))), "_tables", kept, "table_no"
    )
    rows = each_row(by_table, "_row", [*kept, "table_no"], "row_no")
    return rows.select(*kept, "table_no", "row_no", F.col("_row").alias("cells"))


def match_table_numbers(pages: DataFrame, html: str = "html") -> DataFrame:
    """table_no of the first table that looks like a match table; null without one."""
    at = H.with_tables(H.visible(F.col(html)), match_table)
    return pages.select(*_others(pages, html), at.alias("table_no"))


def read_match_pages(
    pages: DataFrame, player_name: Column, player_id: Column, season: Column, competition: Column,
    html: str = "html",
) -> DataFrame:
    """Adds player_name, player_stats (array of match rows with row_no) and page_outcome.

    A page that cannot be read is an outcome and an empty array, not a failed run.
    The name is the page's heading, else the given one.
    """
    seen = pages.withColumn("_page", H.visible(F.col(html)))

    def first_match(page: H.Apart) -> Column:
        return bind(F.get(page.tables(), match_table(page)), page.rows)

    staged = seen.withColumns(
        {
            "_table": H.with_tables(F.col("_page"), first_match),
            "player_name": first_name(H.page_heading(F.col("_page")), player_name),
        }
    )
    head = {
        "player_name": F.col("player_name"), "player_id": player_id,
        "season": season, "competition_code": competition,
    }
    read = staged.withColumn("player_stats", match_rows(F.col("_table"), head))
    return read.withColumns(
        {
            "page_outcome": F.when(F.col("_table").isNull(), "no_table")
            .when(F.size("player_stats") == 0, "no_rows")
            .otherwise("ok"),
            "player_stats": F.coalesce("player_stats", F.array()),
        }
    ).drop("_table", "_page")


def match_rows_of(
    pages: DataFrame, player_name: Column, player_id: Column, season: Column, competition: Column,
    keep: list[str], html: str = "html",
) -> DataFrame:
    """Match rows of every page, one per line."""
    read = read_match_pages(pages, player_name, player_id, season, competition, html)
    return flatten_rows(read, "player_stats", keep)


def player_snapshots(
    read: DataFrame, team: Column, season: Column, season_label: Column, club: Column,
    fallback_name: Column, player_id: Column, scraped_at: Column, keep: list[str],
) -> DataFrame:
    """Snapshot document per page that ``read_match_pages`` has read."""
    rows = F.transform("player_stats", lambda row: row.dropFields("row_no"))
    first = F.get(F.col("player_stats"), F.lit(0))["player_name"]
    return read.select(
        *keep,
        team.alias("team"), season.alias("season"), season_label.alias("season_label"),
        club.alias("club"),
        F.coalesce(first, fallback_name).alias("player_name"),
        player_id.alias("player_id"), scraped_at.alias("scraped_at"),
        rows.alias("player_stats"),
    )
