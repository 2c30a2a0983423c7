import html as python_html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cells as C
from tidemark.functions import dates as D
from tidemark.functions import html as H
from tidemark.functions import numbers as N
from tidemark.operators import pages as P
from tidemark.operators.dedup import keep_first, keep_first_across

SITE = "https://stats.example.com"


def cells(*texts):
    return "<tr>" + "".join(f"<td>{t}</td>" for t in texts) + "</tr>"


REGULAR = cells("1", "Aug 22, 2025", "Bayern Munich", "Leipzig", "6:0", "CF", "3", "", "", "", "",
                "", "", "86'", "1.1", "86'")
SECOND = cells("2", "Aug 30, 2025", "Augsburg (4.)", "Bayern Munich (1.)", "2:3", "CF", "", "2", "",
               "", "", "", "", "", "1.7", "90'")
STATUS = cells("1", "Mar 6, 2026", "H", "", "", "", "Calf problems")
CAMEO = cells("2", "Mar 14, 2026", "Leverkusen (6.)", "Bayern Munich (1.)", "1:1", "CF", "", "", "",
              "", "", "", "61'", "", "2.8", "29'")


def page(*rows, heading=""):
    return f"<html><body>{heading}<table><tbody>{''.join(rows)}</tbody></table></body></html>"


@pytest.fixture
def read(spark):
    def run(*pages):
        df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
        out = P.read_match_pages(
            df, F.lit("Harry Kane"), F.lit("132098"), F.lit("2025"), F.lit("GB1"))
        return [r.asDict(recursive=True) for r in out.orderBy("page_id").collect()]

    return run


def test_regular_rows(read):
    (got,) = read(page(REGULAR, SECOND))
    first, second = got["player_stats"]
    assert got["page_outcome"] == "ok"
    assert (first["home_team"], first["away_team"], first["result"]) == (
        "Bayern Munich", "Leipzig", "6:0")
    assert (first["goals"], first["subbed_off_minute"], first["performance_rating"],
            first["minutes_played"]) == (3, 86, 1.1, 86)
    assert first["position"] == "CF" and first["venue"] is None and first["note"] is None
    assert second["assists"] == 2 and second["matchday"] == 2


def test_status_row_keeps_note(read):
    (got,) = read(page(STATUS, CAMEO))
    status, cameo = got["player_stats"]
    assert status["note"] == "Calf problems" and status["venue"] == "H"
    assert status["home_team"] is None and status["goals"] is None
    assert cameo["subbed_on_minute"] == 61 and cameo["minutes_played"] == 29


def test_outcomes(read):
    no_date = cells("1", "soon", "a", "b", "1:0", "CF")
    zero = cells("0", "Aug 22, 2025", "a", "b", "1:0", "CF")
    got = read(page(REGULAR), page(no_date, no_date), page(zero, zero), "", page(REGULAR, SECOND))
    assert [g["page_outcome"] for g in got] == ["no_table", "no_table", "no_rows", "no_table", "ok"]
    assert got[2]["player_stats"] == []


def test_a_rows_parts_are_worked_out_once(spark):
    """In a lambda every mention of an expression is evaluated; before, the cells before the score were gathered ten times."""
    cells, at = F.col("cells"), F.col("at")
    assert str(C.match_context(C.before_result(cells, at))).count("slice(cells") == 1
    assert str(C.stat_texts(C.tail(cells, at))).count("slice(cells") == 1
    assert str(C.match_rows(F.col("rows"))).count("(?i)^(jan|") == str(D.is_match_date(F.col("cell"))).count("(?i)^(jan|")


def test_match_rows_of_odd_cells(read):
    """Too few cells, no number, zero, no date, no score: no row. A score right behind the date leaves no names."""
    day = "Aug 22, 2025"
    odd = [cells("1", day, "a", "b", "1:0"), cells("x", day, "a", "b", "1:0", "CF"), cells("0", day, "a", "b", "1:0", "CF"),
           cells("1", "soon", "a", "b", "1:0", "CF"), cells("1", day, "a", "b", "c", "CF")]
    (got,) = read(page(REGULAR, cells("3.7", day, "1:0", "CF", "1,000", "5'", "x"), *odd, SECOND))
    rows = got["player_stats"]
    assert [(r["row_no"], r["matchday"]) for r in rows] == [(0, 1), (1, 3), (7, 2)]
    assert [rows[1][c] for c in ("venue", "home_team", "away_team", "goals", "assists", "own_goals", "note")] == [
        None, None, None, 1000, 5, None, None]


def test_first_match_table_wins_and_only_eight_rows_count(read):
    late = page(*([cells("x")] * 7), REGULAR, SECOND)
    other = "<table>" + cells("a", "b") + "</table>"
    got = read(late, other + page(STATUS, CAMEO) + page(REGULAR, SECOND))
    assert got[0]["page_outcome"] == "no_table"
    assert got[1]["player_stats"][0]["note"] == "Calf problems"


def test_name_comes_from_heading(read):
    got = read(page(REGULAR, SECOND, heading="<h1>#9 <b>Harry</b> Kane &amp; Co</h1>"),
               page(REGULAR, SECOND, heading="<h1> </h1>"))
    assert [g["player_name"] for g in got] == ["Harry Kane & Co", "Harry Kane"]
    assert got[0]["player_stats"][0]["player_name"] == "Harry Kane & Co"


def test_snapshot_document(spark):
    df = spark.createDataFrame([(0, page(REGULAR, SECOND)), (1, "")], "page_id long, html string")
    read = P.read_match_pages(df, F.lit("Harry Kane"), F.lit("1"), F.lit("2025"), F.lit("GB1"))
    got = P.player_snapshots(
        read, F.lit("bayern"), F.lit("2025"), F.lit("2025/2026"), F.lit("Bayern"),
        F.lit("Fallback"), F.lit("1"), F.lit("now"), ["page_id"],
    ).orderBy("page_id").collect()
    assert [r["player_name"] for r in got] == ["Harry Kane", "Fallback"]
    assert len(got[0]["player_stats"]) == 2 and got[1]["player_stats"] == []
    assert "row_no" not in got[0]["player_stats"][0].asDict()


def test_squad_players(spark):
    html = """<a href="/harry/profil/spieler/1"> Harry   <b>Kane</b> </a>
      <a href='/harry/profil/spieler/1'>again</a> <a href="/jo-hart/profil/spieler/2"></a>
      <a href="/profil/spieler/">bad</a> <!-- <a href="/x/profil/spieler/9">no</a> -->
      <script>var a = '<a href="/y/profil/spieler/8">no</a>';</script>"""
    df = spark.createDataFrame([(5, html), (6, "<p>none</p>")], "page_id long, html string")
    got = [tuple(r) for r in P.squad_players(df, SITE).orderBy("page_id", "pos").collect()]
    assert got == [
        (5, 0, "Harry Kane", "harry", "1", f"{SITE}/harry/profil/spieler/1"),
        (5, 1, "Jo Hart", "jo-hart", "2", f"{SITE}/jo-hart/profil/spieler/2"),
    ]


def club(name, number, season, title=True):
    titled = f'title="{name}" ' if title else ""
    slug = name.lower().replace(" ", "-")
    return f'<a {titled}href="/{slug}/startseite/verein/{number}/saison_id/{season}">x</a>'


def test_league_clubs_of_exact_season(spark):
    html = (club("Manchester United", 985, 2025) + club("Manchester United", 985, 2025)
            + club("Old Club", 7, 2024) + club("No Title", 8, 2025, title=False)
            + club("Arsenal FC", 11, 2025))
    df = spark.createDataFrame([("2025", html)], "season string, html string")
    got = P.league_clubs(df, SITE).orderBy("pos").collect()
    assert [(r.team_key, r.club_id) for r in got] == [("manchester_united", "985"), ("arsenal_fc", "11")]


def test_clubs_across_seasons(spark):
    df = spark.createDataFrame(
        [("2025", club("United", 985, 2025)), ("2024", club("United", 985, 2024) + club("Arsenal", 11, 2024))],
        "season string, html string",
    )
    clubs = P.league_clubs(df, SITE)
    got = keep_first_across(clubs, ["club_id"], "season", ["2025", "2024"], ["pos"]).collect()
    assert sorted((r.club_id, r.season) for r in got) == [("11", "2024"), ("985", "2025")]


def test_in_row_dedup_equals_window(spark):
    links = "".join(f'<a href="/p{i % 7}/profil/spieler/{i % 7}">n{i}</a>' for i in range(40))
    df = spark.createDataFrame([(1, links), (2, links)], "page_id long, html string")
    inside = P.squad_players(df, SITE).select("page_id", "player_id", "player_name")
    every = P.page_links(df).select(
        "page_id", "pos", F.regexp_extract("href", r"([0-9]+)$", 1).alias("player_id"),
        F.col("text").alias("player_name"))
    window = keep_first(every, ["page_id", "player_id"], ["pos"]).select(*inside.columns)
    assert sorted(map(tuple, inside.collect())) == sorted(map(tuple, window.collect()))


def test_markup_corners(values):
    assert values(
        ["<h1>A &#8364;&#128;&eacute;&amp;lt;&nbsp;</h1>", "<h1>&unknown; x</h1>", "<H1 a='>'>y</H1>"],
        H.heading,
    ) == ["A €€é&lt;", "&unknown x", "y"]
    (got,) = values(
        ["<table><tr><td>a<td> b <tr><td><table><tr><td>1 &lt; 2</td></tr></table>"], H.tables)
    assert got == [[["a", "b"], ["1 < 2", "1 < 2"], ["1 < 2"]], [["1 < 2"]]]
    (anchors,) = values(["<a class=x href=/y/>t</a><A HREF='/w?a=1&amp;b' title>w</A><abbr>"], H.anchors)
    assert [(a.href, a.title, a.text) for a in anchors] == [("/y/", None, "t"), ("/w?a=1&b", "", "w")]


def test_table_inside_a_table_loses_no_row(values):
    inner = "<table><tr><td>in</td></tr></table>"
    rows = "".join(f"<tr><td>{n}</td><td>x{inner if n == 2 else ''}y</td><td>z</td></tr>" for n in range(4))
    (got,) = values([f"<table>{rows}</table>"], H.tables)
    assert got == [
        [["0", "xy", "z"], ["1", "xy", "z"], ["2", "x in y", "in", "z"], ["in"], ["3", "xy", "z"]], [["in"]],
    ]
    (got,) = values([f"<table><tr><td>a</td></tr>{inner}<tr><td>b</td></tr></table></table><table><tr><td>c"], H.tables)
    assert got == [[["a"], ["in"], ["b"]], [["in"]], [["c"]]]
    deep = "<table><tr><td>1<table><tr><td>2<table><tr><td>3</td></tr></table></td></tr></table>4</td></tr></table>"
    (got,) = values([deep], H.tables)
    assert got[0][0][0] == "1 2 3 4" and got[2] == [["3"]] and len(got) == 3


def test_nul_cuts_nothing(values):
    page = "\0<table><tr><td>a\0b</td>\0<td>c</td></tr>\0<tr><td>d</td></tr></table>\0"
    assert values([page], H.tables) == [[[["ab", "c"], ["d"]]]]


def test_long_tags_and_digits_kill_no_task(values):
    many = " ".join(f'a{n}="{n}>"' for n in range(5000))
    (got,) = values([f"<table {many}><tr><td {many}>x</td></tr></table><h1 {many}>n</h1>"], H.tables)
    assert got == [[["x"]]]
    (found,) = values([f"<a {many} href='/y'>t</a>"], H.anchors)
    assert (found[0].href, found[0].text) == ("/y", "t")
    long = "7" * 20_000
    assert values([long, long + "x", "1_000", "1__0", "1_", "_1"], N.to_int) == [None, None, 1000, None, None, None]


def test_unescape_knows_the_names(values):
    names = ["&quot;", "&euro;", "&Auml;", "&copy;", "&#x41;", "&#65", "&lt", "a & b", "&", "&;"]
    assert values(names, H.unescape) == [python_html.unescape(n) for n in names]


def test_reading_a_page_needs_no_shuffle(spark):
    df = spark.createDataFrame([(0, page(REGULAR, SECOND))], "page_id long, html string")
    rows = P.match_rows_of(df, F.lit("x"), F.lit("1"), F.lit("2025"), F.lit("GB1"), ["page_id"])
    for plan in (rows, P.squad_players(df, SITE), P.table_cells(df)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Python" not in text
        # the page is taken apart once, not again in a filter pushed below
        assert text.count("(?:!--") <= 2  # once for the heading, once for the tables


def walked(page):
    """Tables of a page by a plain walk over its marks: a stack of what is open."""
    marks = re.split(r"<(?=/?(?i:table|tr|td)[\s>])", page)[1:]
    texts = []
    for mark in marks:
        body = re.match(r"""(?s)[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>(.*)""", mark).group(1)
        texts.append(" ".join(t.strip() for t in re.split("<[^>]*>", body) if t.strip()))
    found, stack = {"table": [], "tr": [], "td": []}, []

    def close(*kinds):
        while stack and stack[-1]["kind"] in kinds:
            stack.pop()["end"] = at

    for at, mark in enumerate(marks):
        kind = re.match("/?[a-zA-Z]+", mark).group().lower()
        close(*{"table": [], "td": ["td"], "tr": ["td", "tr"]}[kind.lstrip("/")])
        if kind == "/table":
            close("td", "tr")
            if stack:
                stack.pop()["end"] = at
        elif kind == "table" or stack and not kind.startswith("/"):
            stack.append({"kind": kind, "start": at, "end": len(marks)})
            found[kind].append(stack[-1])
    inside = lambda outer, kind: [x for x in found[kind] if outer["start"] < x["start"] < outer["end"]]
    text = lambda cell: " ".join(t for t in texts[cell["start"]:cell["end"]] if t)
    return [[[text(c) for c in inside(r, "td")] for r in inside(t, "tr")] for t in found["table"]]


def test_tables_equal_a_plain_walk(values):
    rng = random.Random(3)
    parts = ["<table>", "<table class='a>b'>", "<tr>", "<TR x>", "<td>", "<td>", '<td title="q>">', "</td>", "</tr>",
             "</table>", "a", " b ", "<b>c</b>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(500)]
    assert values(pages, H.tables) == [walked(page) for page in pages]


def test_many_open_tables_cost_no_copies(spark):
    """4,000 tables in each other, none closed: rows and cells are there once, tables are stretches of them."""
    df = spark.createDataFrame([(0, "<table><tr><td>x" * 4000), (1, page(REGULAR, SECOND))], "page_id long, html string")
    P.match_table_numbers(df).collect()
    started = time.time()
    got = {r.page_id: r.table_no for r in P.match_table_numbers(df).collect()}
    assert got == {0: None, 1: 0} and time.time() - started < 15


def test_documents_of_repeated_and_missing_page_ids(spark):
    """A page's links stay in its row: equal or missing ids change nothing, and nothing is shuffled."""
    from tidemark.operators import discovery

    pages = spark.createDataFrame(
        [(5, "GB1", "2025", club("Arsenal FC", 11, 2025)), (5, "GB1", "2025", club("United", 985, 2025)),
         (None, "GB1", "2025", club("Leeds", 3, 2025) * 2), (6, "GB1", "2025", "<p>none</p>")],
        "page_id long, league_id string, season string, html string")
    got = discovery.league_documents(pages, SITE, F.lit("now"))
    rows = sorted((str(r.page_id), [t.club_id for t in r.teams], r.teams_found) for r in got.collect())
    assert rows == [("5", ["11"], 1), ("5", ["985"], 1), ("6", [], 0), ("None", ["3"], 1)]
    rosters = spark.createDataFrame(
        [(None, "u", "2025", "U", "1", "<a href='/p/profil/spieler/1'>P</a>")] * 2,
        "page_id long, team string, season string, club string, club_id string, html string")
    found = discovery.roster_documents(rosters, SITE, F.lit("now"))
    assert [[p.player_id for p in r.players] for r in found.collect()] == [["1"], ["1"]]
    for df in (got, found):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_tables_are_read_as_one_text(spark):
    """The texts of all cells are cleaned together: what is done cell by cell, Spark interprets."""
    df = spark.createDataFrame([(0, page(REGULAR, SECOND))], "page_id long, html string")
    for found, most in ((P.table_cells(df), 60), (P.match_table_numbers(df), 60), (P.page_links(df), 22)):
        assert found._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction") <= most


def test_cell_texts_equal_those_of_single_fragments(values):
    """Blanks, references and tags in cells, cleaned for the whole page, are what ``text_of`` makes of each cell."""
    rng = random.Random(5)
    parts = ["a", " ", "\u00a0", "\n", "&nbsp;", "&amp;lt;", "&#0;", "&#x41", "&", "-", "<b>", "</b>", "<i title='<td>x'>", "<!>",
             "<", ">", '"', "r", "/d", "\u3000", "<br/>", "\u00e9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(400)]
    texts = [t for t in texts if "<td" not in t and t.count("<") == len(re.findall("<[^<>]*>", t))]
    got = values([f"<table><tr><td>{t}</td></tr></table>" for t in texts], H.tables)
    nested = values([f"<table><tr><td>{t}<table></table></td></tr></table>" for t in texts], H.tables)
    want = values(texts, H.text_of)
    assert [g[0][0][0] for g in got] == want and [g[0][0][0] for g in nested] == want


def test_last_attribute_of_a_name_counts(values):
    tags = ['<a HREF=x data-href="y" href = "z" href2=1>t</a>', "<a xhref='q' title>t</a>", "<a title='href=1' href>t</a>"]
    got = values(tags, H.anchors)
    assert [(a[0].href, a[0].title) for a in got] == [("z", None), (None, ""), ("", "href=1")]


def test_links_come_with_their_anchor_unread(values):
    (found,) = values(["<a href='/x' title=y> t <b>u</b></a>"], H.links)
    assert [tuple(a) for a in found] == [(0, "/x", "y", "<a href='/x' title=y> t <b>u</b></a>")]


def test_plain_numbers_need_nothing_taken_out(values):
    texts = ["7", "+7", "-7.5", "7.", ".5", "1e3", " 7 ", "1_0", "1_0.5", "", "+", "7" * 400, "9" * 19 + ".9", "nan", "7d", "7\n", "-0"]
    got = values(texts, N.parse_float)

    def plain(text):
        try:
            return None if text.endswith("d") else float(text)
        except ValueError:
            return None

    assert [repr(v) for v in got] == [repr(plain(t)) for t in texts]


def test_clubs_and_players_are_joined_without_a_broadcast(spark):
    """Spark counts the exploded clubs and seasons of a page as one row, so they would pass for small at any number."""
    from tidemark.operators import discovery

    leagues = spark.createDataFrame(
        [(5, "GB1", "2025", club("Arsenal FC", 11, 2025))], "page_id long, league_id string, season string, html string")
    rosters = spark.createDataFrame(
        [(5, "u", "2025", "U", "11", "<a href='/p-q/profil/spieler/1'>P</a>")],
        "page_id long, team string, season string, club string, club_id string, html string")
    work = discovery.discover(
        discovery.league_documents(leagues, SITE, F.lit("now")), discovery.roster_documents(rosters, SITE, F.lit("now")),
        ["2025", "2024"])
    assert [(r.team, r.season, r.player_id) for r in work.collect()] == [("arsenal_fc", "2025", "1")]
    assert "Broadcast" not in work._jdf.queryExecution().executedPlan().toString()


def test_pages_are_dealt_by_their_number(spark):
    """A task gets a bounded share of the pages, however many there are."""
    from tidemark.session import ROWS_PER_TASK, spread

    many = spread(spark.range(ROWS_PER_TASK * 20 + 1))
    assert many.rdd.getNumPartitions() == 21 and many.count() == ROWS_PER_TASK * 20 + 1
    assert spread(spark.range(3)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_white_space_is_looked_up(values):
    """Low characters of the class stand alone, so the matcher looks into a table; the class is Python's white space."""
    from tidemark.functions.text import SPACE

    assert "-" not in SPACE[: SPACE.index("[", 1)]
    every = "".join(chr(n) for n in range(1, 0x3100))
    (left,) = values([every], lambda v: F.regexp_replace(v, SPACE, ""))
    assert left == "".join(c for c in every if not c.isspace())


def test_dates_are_told_by_one_search(values):
    """The pattern knows which days there are: it is true of exactly the texts that are read as a date."""
    months = ["jan", "FEB", "Apr", "jun", "Jul", "sep", "nov", "dec", "foo", "0", "1", "02", "2", "04", "9", "11", "12", "13"]
    years = ["2025", "2024", "1900", "2000", "0000", "0004", "0400", "00", "68", "69", "96", "99", "5"]
    texts = [t for m in months for d in ("0", "1", "01", "28", "29", "30", "31", "32") for y in years
             for t in (f"{m} {d}, {y}", f"{m}/{d}/{y}")] + ["jan  3,\t2024", "jan 3,2024", " jan 3, 2024", "jan 3, 2024\n", "", None]
    got = values(texts, lambda v: D.match_date(v).isNotNull(), D.is_match_date)
    assert [a for a, _ in got] == [b for _, b in got] and {a for a, _ in got} == {True, False}
    assert "split" not in str(D.is_match_date(F.col("v")))


def test_short_numbers_are_cast_at_once(values):
    texts = ["7", "007", "9" * 15, "9" * 16, "86'", "86''", "'86", "1,000", "1,000'", "+5", "3.7", "", "x", None]
    assert values(texts, N.to_int) == [7, 7, 10**15 - 1, 10**16, None, None, None, 1000, None, 5, 3, None, None, None]
    assert values(texts, N.parse_minutes) == [7, 7, 10**15 - 1, 10**16, 86, 86, 86, 1000, 1000, 5, 3, None, None, None]
    assert values(texts, N.parse_stat) == [7, 7, 10**15 - 1, 10**16, 86, None, None, 1000, None, 5, 3, None, None, None]


def test_only_wanted_attributes_are_read(spark, values):
    """Each attribute takes a search of its own: players need no title, clubs that of the links to a club only."""
    (found,) = values(["<a href='/x' title=y>t</a>"], lambda v: H.links(v, "href"))
    assert [tuple(a) for a in found] == [(0, "/x", "<a href='/x' title=y>t</a>")]
    df = spark.createDataFrame([(1, "2025", club("United", 985, 2025) + club("No", 8, 2025, title=False))], "page_id long, season string, html string")
    assert "(?i:title)" not in P.squad_players(df, SITE)._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.pos, r.club_name) for r in P.league_clubs(df, SITE).collect()] == [(0, "United")]
