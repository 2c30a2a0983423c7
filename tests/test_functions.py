import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import dates, nulls, numbers, paths, text, urls

SITE = "https://stats.example.com"


def test_split_name_rank(values):
    got = values(
        ["Leverkusen (6.)", "Manchester United (1.)", "Plain", "(3.)", "A (b) (12.)", " ", None,
         " Padded  (4.) "],
        text.split_name_rank,
    )
    assert [tuple(r) for r in got] == [
        ("Leverkusen", 6), ("Manchester United", 1), ("Plain", None), ("", 3), ("A (b)", 12),
        (None, None), (None, None), ("Padded", 4),
    ]


def test_dates(values):
    got = values(
        ["Sep 3, 2025", "9/13/25", "Aug 2, 25", "Jan 5, 70", "1/5/69", "1/5/68", "Feb 30, 2025",
         " Sep 3, 2025 ", "garbage", None, "", "13/1/25", "Sept 3, 2025", "Jan 1, 0000"],
        dates.iso_match_date, dates.is_match_date,
    )
    assert [r[0] for r in got] == [
        "2025-09-03", "2025-09-13", "2025-08-02", "1970-01-05", "1969-01-05", "2068-01-05", None,
        "2025-09-03", None, None, None, None, None, None,
    ]
    # the predicate does not strip
    assert [r[1] for r in got][7:9] == [False, False] and got[0][1]


def test_numbers(values):
    texts = ["1,234", "3.7", "86'", "", "abc", "1e3", "inf", None, "-3.7", "1d", ".5", "5.", " 7 "]
    got = values(texts, numbers.to_int, numbers.parse_minutes, numbers.parse_stat)
    assert [r[0] for r in got] == [
        1234, 3, None, None, None, 1000, None, None, -3, None, 0, 5, 7]
    assert got[2][1] == 86 and got[2][2] == 86
    assert values(["1.5", "inf", "x"], numbers.to_float) == [1.5, math.inf, None]
    assert values(["3", "3.0", "3.7", "x", None], numbers.parse_int) == [3, None, None, None, None]


def test_numbers_agree_with_python(values):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.text("0123456789.,eE+-_ '", max_size=8), min_size=30, max_size=60))
    def check(texts):
        def python(value):
            cleaned = value.replace(",", "").strip()
            try:
                return int(float(cleaned)) if cleaned else None
            except (ValueError, OverflowError):
                return None

        expected = [python(t) for t in texts]
        got = values(texts, numbers.to_int)
        for value, want, have in zip(texts, expected, got):
            if want is not None and abs(want) >= 2**63:
                want = None
            assert want == have, value

    check()


def test_spaces_are_pythons(values):
    padded = ["\x1c a b 　", " x\x85"]
    assert values(padded, text.strip) == [p.strip() for p in padded]
    assert values(["a \n b"], text.collapse_spaces) == ["a b"]


def test_slugs(values):
    assert values(["bruno-fernandes", "o'neil-3rd"], text.slug_to_name) == [
        "Bruno Fernandes", "O'neil 3rd"]
    assert values(["Arsenal FC", "  1. FC Köln!"], text.team_key) == ["arsenal_fc", "1_fc_k_ln"]
    assert values(["Bruno Fernandes", "!"], lambda c: text.entity_key(c, F.lit("7"))) == [
        "player_id=7_bruno-fernandes", "player_id=7"]
    assert values(["#10 Bruno", "Bruno", "#8"], text.strip_shirt_number) == ["Bruno", "Bruno", "#8"]


def test_selector(values):
    test = lambda wanted: lambda c: text.matches_selector(c, F.lit("a-slug"), wanted)
    assert values(["Bruno Fernandes", "x"], test("bruno-fernandes")) == [True, False]
    assert values(["x"], test("A Slug")) == [True]
    assert values(["x"], test(None)) == [True]


def test_missing(values):
    texts = ["", " \t", "NA", "null", "None", "nan", " NA ", "x", None, "#N/A"]
    assert values(texts, nulls.missing_to_null) == [
        None, None, None, None, None, None, " NA ", "x", None, None]
    assert values(["NA", " "], lambda c: nulls.missing_to_null(c, tokens=False)) == ["NA", None]


def test_urls(values):
    from urllib.parse import urljoin

    hrefs = ["/a/b", "x/y", "?q=1", "#f", "//h.com/x", "http://a.b/c", "/a/../b", "/a/./b/", "../x",
             "/a/..", "mailto:x"]
    assert values(hrefs, lambda c: urls.join_url(SITE, c)) == [urljoin(SITE, h) for h in hrefs]
    parts = values(
        [f"{SITE}/bruno/profil/spieler/240306?x=1", f"{SITE}/spieler/1", f"{SITE}/a/b/spieler",
         f"{SITE}/a/profil/spieler/9/extra;p=1"],
        urls.player_parts,
    )
    assert [p and tuple(p) for p in parts] == [("bruno", "240306"), None, None, ("a", "9")]
    clubs = values(
        [f"{SITE}/arsenal/startseite/verein/11/saison_id/2025", f"{SITE}/verein/11", f"{SITE}/x"],
        urls.club_parts,
    )
    assert [c and tuple(c) for c in clubs] == [("arsenal", "11"), None, None]
    built = values(["2025"], lambda s: urls.roster_url(F.lit(SITE), F.lit("arsenal-fc"), F.lit("11"), s))
    assert built == [f"{SITE}/arsenal-fc/kader/verein/11/saison_id/2025/plus/1"]


def test_paths(values):
    assert values(
        ["a/scrape_date=2026-03-26.csv", "a/scrape_date=2026-03-26/part-0.json",
         "a/scrape_date=latest.csv", "a/scrape_date=2026-03-26.csv.bak"],
        paths.scrape_date,
    ) == ["2026-03-26", "2026-03-26", None, None]
    key = lambda c: paths.storage_key(c, "site", "data/raw", "data/cleaned")
    got = values(
        ["data/raw/site/united/team_roster/2025/roster.json",
         "data/raw/site/united/player_detailed_stats_combined/2025/stats.csv",
         "data/cleaned/site/united/player_stats/2025/scrape_date=2026-03-23.csv",
         "data/raw/site/united/other/x.json", "data/raw/elsewhere/u/team_roster/x.json",
         "tmp/x.json", "data/raw/site/u"],
        key,
    )
    assert [r["key"] for r in got] == [
        "raw/site/united/team_roster/2025/roster.json",
        "raw/site/united/player_detailed_stats_combined/2025/stats.csv",
        "cleaned/site/united/player_stats/2025/scrape_date=2026-03-23.csv",
        None, None, None, None,
    ]
    assert [r["reason"] for r in got][3:] == [
        "unsupported artifact", "unsupported source", "unsupported base path", "unsupported artifact"]
