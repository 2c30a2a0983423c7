import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.dates import utc_stamp
from tidemark.operators import audit, clean, gates, lookups, nest, selection
from tidemark.operators.dedup import keep_latest, top_n
from tidemark.operators.fanout import work_list
from tidemark.operators import upsert as upsert_module
from tidemark.operators.upsert import merge_metrics, read_history, upsert, upsert_table
from tidemark.plans import season_load
from tidemark.schemas import CLEAN_COLUMNS, HISTORY_ROW, RAW_ROW
from tidemark.session import workspace

NOW = dt.datetime(2026, 3, 27, 12, tzinfo=dt.timezone.utc)
KEYS = ["team", "season", "player_id", "matchday"]
ROW = "team string, season string, player_id string, matchday string, goals int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- cleaning ---------------------------------------------------------------------


def raw_row(**changes):
    base = {c: None for c in RAW_ROW.fieldNames()}
    base |= dict(
        season="2025", player_name="Latest Snapshot", player_id="240306", competition_code="GB1",
        matchday="3", match_date="Sep 13, 2025", home_team="Leverkusen (6.)",
        away_team="Manchester United (1.)", result="1:2", position="AM", goals="1", assists="1",
        subbed_off_minute="88", performance_rating="1.2", minutes_played="88",
        scrape_date="2026-03-27", scraped_at="x",
    )
    return tuple((base | changes).values())


def test_clean_contract(spark):
    raw = spark.createDataFrame([raw_row(note="NA", venue=" ")], RAW_ROW)
    got = clean.clean_matches(raw, utc_stamp(NOW), F.lit("Manchester United"))
    assert got.columns == [clean.REJECTED] + CLEAN_COLUMNS
    row = got.first()
    assert row.season_label == "2025/2026" and row.match_date_iso == "2025-09-13"
    assert (row.home_team_name, row.home_team_rank) == ("Leverkusen", 6)
    assert (row.away_team_name, row.away_team_rank) == ("Manchester United", 1)
    assert row.bronze_scrape_date == "2026-03-27" and row.transformed_at == "2026-03-27T12:00:00+00:00"
    assert row.note is None and row.venue is None and row.own_goals is None
    assert (row.goals, row.performance_rating) == (1, 1.2) and row._rejected == []


def test_bad_numbers_are_named_or_fatal(spark):
    raw = spark.createDataFrame([raw_row(goals="many", matchday="3.5"), raw_row()], RAW_ROW)
    got = clean.clean_matches(raw, F.lit("t"), F.lit("c")).collect()
    assert sorted(got[0]._rejected) == ["goals", "matchday"] and got[0].goals is None
    assert got[1]._rejected == [] and got[1].goals == 1
    with pytest.raises(PySparkException):
        clean.clean_matches(raw, F.lit("t"), F.lit("c"), strict=True).collect()
    assert clean.clean_matches(
        spark.createDataFrame([raw_row()], RAW_ROW), F.lit("t"), F.lit("c"), strict=True
    ).first().goals == 1


def test_unknown_season_keeps_its_name(spark):
    raw = spark.createDataFrame([raw_row(season="1999")], RAW_ROW)
    assert clean.clean_matches(raw, F.lit("t"), F.lit("c")).first().season_label == "1999"


# --- snapshot choice ----------------------------------------------------------------


def test_latest_and_requested(spark):
    df = spark.createDataFrame(
        [("u", "2026-03-26", 1), ("u", "2026-03-27", 2), ("v", "2026-03-01", 3), ("v", "zzz", 4)],
        "team string, scrape_date string, n int")
    by = ["team"]
    assert rows_of(selection.requested_snapshot(df, by, "scrape_date").select("n")) == [(2,), (3,)]
    early = selection.requested_snapshot(df, by, "scrape_date", "2026-03-26")
    assert rows_of(early.select("n")) == [(1,)]
    assert selection.requested_snapshot(df, by, "scrape_date", "2020-01-01").count() == 0


# --- dedup and upsert -----------------------------------------------------------------


def test_keep_latest(spark):
    df = spark.createDataFrame(
        [("a", "2", "x"), ("a", "1", "y"), ("b", None, "p"), ("b", "9", "q"), (None, "1", "m"),
         (None, "1", "n")], "k string, v string, w string")
    assert rows_of(keep_latest(df, ["k"], "v").select("k", "w")) == [
        ("a", "x"), ("b", "p"), (None, "m")]


def test_upsert_rules(spark):
    target = spark.createDataFrame(
        [("u", "1", "p", "1", 0), ("u", "1", "p", "2", 0), ("u", "1", "p", None, 0)], ROW)
    source = spark.createDataFrame(
        [("u", "1", "p", "2", 5), ("u", "1", "p", "3", 5), ("u", "1", "p", None, 5)], ROW)
    merged = upsert(target, source, KEYS)
    # a null key matches nothing: the old row stays and the new one is added
    assert rows_of(merged) == sorted([
        ("u", "1", "p", "1", 0), ("u", "1", "p", "2", 5), ("u", "1", "p", "3", 5),
        ("u", "1", "p", None, 0), ("u", "1", "p", None, 5)], key=str)
    assert tuple(merge_metrics(target, source, KEYS).first()) == (2, 1, 3)


def test_upsert_twice_changes_nothing_and_leaves_other_slices(spark):
    path = workspace(spark, "history")
    schema = spark.createDataFrame([], ROW).schema
    old = spark.createDataFrame(
        [("u", "1", "p", "1", 0), ("v", "1", "p", "1", 0), ("u", "2024", "p", "1", 0)], ROW)
    upsert_table(spark, path, old, KEYS, ["team", "season"], schema)
    def files(team):
        rows = read_history(spark, path, schema).filter(F.col("team") == team)
        return {r.f for r in rows.select(F.input_file_name().alias("f")).collect()}

    before = files("v")
    new = spark.createDataFrame([("u", "1", "p", "1", 9), ("u", "1", "q", "1", 9)], ROW)
    counted = [
        rows_of(upsert_table(spark, path, new, KEYS, ["team", "season"], schema)) for _ in range(2)
    ]
    assert counted == [[("u", "1", 1, 1, 2)], [("u", "1", 0, 2, 2)]]
    got = read_history(spark, path, schema)
    assert rows_of(got.select(*schema.fieldNames())) == sorted([
        ("u", "1", "p", "1", 9), ("u", "1", "q", "1", 9), ("u", "2024", "p", "1", 0),
        ("v", "1", "p", "1", 0)], key=str)
    assert files("v") == before


def test_upsert_reads_touched_slices_only(spark, monkeypatch):
    path = workspace(spark, "history")
    schema = spark.createDataFrame([], ROW).schema
    old = spark.range(50).select(
        F.concat(F.lit("t"), F.col("id")).alias("team"), F.lit("1").alias("season"), F.lit("p").alias("player_id"),
        F.lit("1").alias("matchday"), F.lit(0).alias("goals"))
    upsert_table(spark, path, old, KEYS, ["team", "season"], schema)
    read = []
    real = upsert_module._read_slices
    monkeypatch.setattr(upsert_module, "_read_slices", lambda s, p, slices, k: read.append(slices) or real(s, p, slices, k))
    new = spark.createDataFrame([("t7", "1", "p", "1", 9), ("new", "1", "p", "1", 9)], ROW)
    upsert_table(spark, path, new, KEYS, ["team", "season"], schema)
    assert [list(r) for r in read] == [["team=t7/season=1"]]
    plan = read_history(spark, path, schema).filter("team = 't7'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(team" in plan


def test_load_lost_before_the_switch_changes_nothing(spark, monkeypatch):
    path = workspace(spark, "history")
    schema = spark.createDataFrame([], ROW).schema
    old = spark.createDataFrame([("u", "1", "p", "1", 0), ("a b", None, "p", "1", 0)], ROW)
    upsert_table(spark, path, old, KEYS, ["team", "season"], schema)
    new = spark.createDataFrame([("u", "1", "p", "1", 9)], ROW)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as at_switch:
        at_switch.setattr(upsert_module, "_switch", lost)
        with pytest.raises(RuntimeError):
            upsert_table(spark, path, new, KEYS, ["team", "season"], schema)
    assert rows_of(read_history(spark, path, schema)) == rows_of(old)
    upsert_table(spark, path, new, KEYS, ["team", "season"], schema)
    upsert_table(spark, path, new, KEYS, ["team", "season"], schema)
    assert rows_of(read_history(spark, path, schema)) == rows_of(
        spark.createDataFrame([("u", "1", "p", "1", 9), ("a b", None, "p", "1", 0)], ROW))
    # slices that no present or previous list names are gone
    assert len(list(Path(path).glob("data/load=*/team=*/season=*"))) == 3


def test_two_loads_at_once_both_count(spark, monkeypatch):
    """A load that ends while another is under way: of other slices both stay, of the same one the later merges again."""
    path, by = workspace(spark, "history"), ["team", "season"]
    schema = spark.createDataFrame([], ROW).schema
    load = lambda *rows: spark.createDataFrame(list(rows), ROW)
    upsert_table(spark, path, load(("u", "1", "p", "1", 0), ("v", "1", "p", "1", 0)), KEYS, by, schema)
    real, meanwhile = upsert_module._switch, [
        load(("v", "1", "p", "1", 7), ("w", "1", "p", "1", 7)), load(("u", "1", "q", "1", 7)),
    ]

    def overtaken(*args):
        while meanwhile:
            with monkeypatch.context() as plain:
                plain.setattr(upsert_module, "_switch", real)
                upsert_table(spark, path, meanwhile.pop(0), KEYS, by, schema)
        return real(*args)

    monkeypatch.setattr(upsert_module, "_switch", overtaken)
    counted = upsert_table(spark, path, load(("u", "1", "p", "1", 9)), KEYS, by, schema)
    assert rows_of(read_history(spark, path, schema)) == [
        ("u", "1", "p", "1", 9), ("u", "1", "q", "1", 7), ("v", "1", "p", "1", 7), ("w", "1", "p", "1", 7)]
    assert rows_of(counted) == [("u", "1", 0, 1, 1)]
    # a version that is there is not written again
    assert not upsert_module._new_version(spark, path, 1 + upsert_module._versions(spark, path)[-2], "x")


def test_slices_are_pruned_while_the_query_runs(spark):
    """10,000 wanted slices: the plan has a dynamic condition, and does not grow with them."""
    path = workspace(spark, "history")
    schema = spark.createDataFrame([], ROW).schema
    old = spark.range(40).select(
        F.concat(F.lit("t"), F.col("id")).alias("team"), F.lit("1").alias("season"), F.lit("p").alias("player_id"),
        F.lit("1").alias("matchday"), F.lit(0).alias("goals"))
    upsert_table(spark, path, old, KEYS, ["team", "season"], schema)
    upsert_table(spark, path, old.filter("team = 't3'"), KEYS, ["team", "season"], schema)
    wanted = spark.range(3, 10_003).select(F.concat(F.lit("t"), F.col("id")).alias("team"), F.lit("1").alias("season"))
    got = read_history(spark, path, schema, wanted)
    assert sorted(r.team for r in got.collect()) == sorted(f"t{n}" for n in range(3, 40))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and len(plan) < 20_000


def test_older_rows_stay_out_where_asked(spark):
    path, by = workspace(spark, "history"), ["team", "season"]
    kind = "team string, season string, player_id string, v string, goals int"
    schema = spark.createDataFrame([], kind).schema
    load = lambda *rows: spark.createDataFrame([("u", "1", *r) for r in rows], kind)
    keys = ["team", "season", "player_id"]
    upsert_table(spark, path, load(("p", "2", 2), ("q", "2", 2), ("r", None, 2)), keys, by, schema)
    late = load(("p", "1", 1), ("q", "3", 3), ("r", "9", 3), ("s", "1", 1), (None, "1", 1))
    counted = upsert_table(spark, path, late, keys, by, schema, newer_wins="v")
    assert rows_of(read_history(spark, path, schema).select("player_id", "goals")) == [
        ("p", 2), ("q", 3), ("r", 2), ("s", 1), (None, 1)]
    assert rows_of(counted) == [("u", "1", 2, 1, 3)]


def test_hot_key_and_null_keys_beyond_broadcast(spark):
    """A third of the rows on one key, a third with a null key; joins may not broadcast."""
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id")))
    base = spark.range(n).select(
        F.lit("u").alias("team"), F.lit("1").alias("season"), hot.alias("player_id"),
        F.when(F.col("id") % 3 != 1, F.lit("1")).alias("matchday"), F.col("id").cast("int").alias("goals"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        newest = keep_latest(base, KEYS, "goals")
        assert newest.count() == 1 + 2 * n // 3
        assert newest.filter("player_id = 'hot'").first().goals == n - 3
        merged = upsert(base, newest, KEYS)
        # nulls: a third stays and is added again; keyed rows are replaced
        assert merged.count() == n // 3 + newest.count()
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "_spread" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_window_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    plan = keep_latest(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


# --- gates, audit, lookups ---------------------------------------------------------------


def test_gate_and_outcomes(spark):
    rows = spark.range(53).select(
        F.when(F.col("id") < 50, "big").otherwise("small").alias("team"), "id")
    assert gates.min_rows_gate(rows, ["team"]).count() == 50
    asked = spark.createDataFrame([("big",), ("small",), ("none",)], "team string")
    got = {r.team: (r.rows, r.status) for r in gates.slice_outcomes(asked, rows, ["team"]).collect()}
    assert got == {"big": (50, "ok"), "small": (3, "too few rows"), "none": (0, "no output")}


def test_a_failing_slice_stops_no_other(spark):
    raw = spark.createDataFrame(
        [("u", *raw_row(goals="many", matchday="3.5")), ("u", *raw_row()), ("v", *raw_row()), (None, *raw_row(goals="x"))],
        "team string, " + ", ".join(f"{c} string" for c in RAW_ROW.fieldNames()))
    cleaned = clean.clean_matches(raw, utc_stamp(NOW), F.lit("c"), keep=["team"])
    errors = gates.slice_errors(cleaned, ["team"])
    good = gates.without_slices(cleaned, errors, ["team"])
    assert [r.team for r in good.collect()] == ["v"]
    asked = spark.createDataFrame([("u",), ("v",), ("w",)], "team string")
    got = {r.team: (r.rows, r.status, r.error) for r in gates.slice_outcomes(asked, good, ["team"], 1, errors).collect()}
    assert got["v"] == (1, "ok", None) and got["w"] == (0, "no output", None)
    assert got["u"][:2] == (0, "failed") and got["u"][2].startswith("not a number: ")


def test_retention_keeps_unknown_dates(spark):
    df = spark.createDataFrame([("2026-03-12",), ("2026-03-13",), (None,), ("soon",)], "d string")
    assert rows_of(gates.retained(df, "d", dt.date(2026, 3, 27))) == sorted(
        [("2026-03-13",), (None,), ("soon",)], key=str)


def test_audits(spark):
    df = spark.createDataFrame(
        [("u", "1", "p", "GB1", None), ("u", "1", "p", "GB1", None), ("u", "1", "q", "GB1", "2")],
        "team string, season string, player_id string, competition_code string, matchday string")
    assert [tuple(r) for r in audit.duplicate_keys(df).collect()] == [("u", "1", "p", "GB1", None, 2)]
    assert tuple(audit.null_audit(df, ["player_id", "matchday"]).first()) == (3, 0, 2)
    empty = audit.null_audit(df.filter("false"), ["player_id"]).first()
    assert tuple(empty) == (0, 0)


def test_resolve_teams(spark):
    known = spark.createDataFrame(
        [("manchester_united", "Manchester United", "manchester-united", "985")],
        "team_key string, club_name string, club_slug string, club_id string")
    asked = spark.createDataFrame(
        [("manchester_united", "x", "y", "z"), ("arsenal_fc", "Arsenal FC", "arsenal-fc", "11"),
         ("leeds_united", None, "", None)],
        "team string, club_name string, club_slug string, club_id string")
    got = {r.team: (r.club_name, r.club_slug, r.club_id, r.origin)
           for r in lookups.resolve_teams(asked, known).collect()}
    assert got == {
        "manchester_united": ("Manchester United", "manchester-united", "985", "known"),
        "arsenal_fc": ("Arsenal FC", "arsenal-fc", "11", "given"),
        "leeds_united": ("Leeds United", "leeds-united", "985", "derived"),
    }
    with pytest.raises(PySparkException):
        lookups.resolve_teams(asked, known, strict=True).collect()
    whole = asked.filter("team <> 'leeds_united'")
    assert lookups.resolve_teams(whole, known, strict=True).count() == 2


def test_large_label_tables(spark):
    labels = {str(i): f"label \"{i}\"" for i in range(3000)}
    got = spark.range(2999, 3001).select(lookups.label(F.col("id").cast("string"), labels).alias("l"))
    assert rows_of(got) == sorted([('label "2999"',), ("3000",)], key=str)


def test_work_list_and_top_n(spark):
    teams = spark.createDataFrame([("u",), ("v",)], "team string")
    rosters = spark.createDataFrame(
        [("u", "2024", "p"), ("u", "2025", "p"), ("v", "2023", "q")],
        "team string, season string, player_id string")
    got = work_list(teams, ["2024", "2025"], rosters)
    assert rows_of(got.select("team", "season", "player_id", "competition_code")) == [
        ("u", "2024", "p", "GB1"), ("u", "2025", "p", "GB1")]
    assert top_n(rosters, ["team"], ["season"], 1).count() == 2


# --- nesting ------------------------------------------------------------------------------


def test_large_documents_are_cut_and_come_back_whole(spark):
    rows = spark.range(2600).select(F.lit("one").alias("k"), "id", (F.col("id") * 2).alias("v"))
    assert [r[0] for r in nest.nest_rows(rows, ["k"], "id", ["id"], "rows").select(F.size("rows")).collect()] == [2600]
    documents = nest.nest_rows(rows, ["k"], "id", ["id", "v"], "rows", 500)
    sizes = sorted(r[0] for r in documents.select(F.size("rows")).collect())
    assert sizes == [100, 500, 500, 500, 500, 500]
    assert nest.flatten_rows(documents, "rows", ["k"]).exceptAll(rows).count() == 0
    first = (F.col("part_no") == 0) & (F.col("piece_no") == 0)
    found = audit.run_counters(documents, "rows", first_part=first).first()
    assert tuple(found) == (1, 2600)


def test_documents_with_repeated_positions_are_cut_too(spark):
    """A third of all rows in one document, at few positions; many of them equal."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 8).alias("pos"),
        F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    documents = nest.nest_rows(rows, ["k"], "pos", ["pos", "v"], "rows", rows_per_part=100)
    largest = documents.agg(F.max(F.size("rows"))).first()[0]
    assert largest < 1000
    back = nest.flatten_rows(documents, "rows", ["k"])
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
    keys = documents.groupBy("k", "part_no", "piece_no").count()
    assert keys.filter("count > 1").count() == 0


# --- the whole load ----------------------------------------------------------------------


def match_page(days):
    body = "".join(
        f"<tr><td>{day}</td><td>Aug {day % 28 + 1}, 2025</td><td>Home (1.)</td><td>Away</td>"
        f"<td>1:0</td><td>CF</td><td>{day}</td></tr>" for day in days)
    return f"<table>{body}</table>"


PAGE = ("team string, club string, season string, competition_code string, player_id string, "
        "player_name string, scrape_date string, html string")


def test_load_end_to_end(spark):
    tables = season_load.Tables(workspace(spark, "end"))

    def load(now, date, *pages):
        return season_load.run(
            spark, spark.createDataFrame(list(pages), PAGE), tables, "site", now, date)

    big = match_page(range(1, 38))
    summary, outcomes, _ = load(
        NOW, "2026-03-27",
        ("u", "United", "2025", "GB1", "1", "One", "2026-03-27", big),
        ("u", "United", "2025", "GB1", "2", "Two", "2026-03-27", big),
        ("v", "Vale", "2025", "GB1", "1", "One", "2026-03-27", big),
        ("w", "Wanderers", "2025", "GB1", "3", "Three", "2026-03-27", "<p>nothing</p>"),
    )
    # v staged the same date but is below the gate, and is not merged into u
    assert rows_of(summary) == [("u", "2025", 74, 2, "2026-03-27")]
    assert {r.team: r.status for r in outcomes.collect()} == {
        "u": "ok", "v": "too few rows", "w": "no output"}

    later = dt.datetime(2026, 4, 20, tzinfo=dt.timezone.utc)
    summary, _, _ = load(
        later, "2026-04-20",
        ("u", "United", "2025", "GB1", "1", "One", "2026-04-20", match_page(range(1, 39))),
        ("u", "United", "2025", "GB1", "2", "Two", "2026-04-20", big),
    )
    assert rows_of(summary) == [("u", "2025", 75, 2, "2026-04-20")]
    history = read_history(spark, tables.history, HISTORY_ROW)
    assert audit.duplicate_keys(history).count() == 0
    row = history.filter("player_id = '1' and matchday = '5'").first()
    assert (row.season_label, row.match_date_iso, row.home_team_name, row.home_team_rank,
            row.goals, row.ingested_at) == (
        "2025/2026", "2025-08-06", "Home", "1", "5", dt.datetime(2026, 4, 20))
    # the first date is older than two weeks now and left the staging table
    from tidemark.sources.staging import read_staging

    dates = read_staging(spark, tables.staging).select("bronze_scrape_date").distinct()
    assert rows_of(dates) == [("2026-04-20",)]


def small_load(spark, tables, date, *pages, now=NOW):
    frame = spark.createDataFrame([(t, t.upper(), "2025", "GB1", p, p, date, h) for t, p, h in pages], PAGE)
    return season_load.run(spark, frame, tables, "site", now, date)


def test_gate_counts_this_load_only(spark):
    """A slice below the gate stays out however often it comes, and other slices are not staged again."""
    from tidemark.sources.staging import read_staging

    tables = season_load.Tables(workspace(spark, "twice"))
    small_load(spark, tables, "2026-03-27", ("a", "1", match_page(range(1, 61))))
    for _ in range(2):
        result = small_load(spark, tables, "2026-03-27", ("b", "1", match_page(range(1, 31))))
        assert rows_of(result.outcomes) == [("b", "2025", 30, "too few rows")]
        assert rows_of(result.ingest) == [("b", "2025", 30, 0, 0, 0, 0)]
        assert result.summary.count() == 0
    staged = read_staging(spark, tables.staging).groupBy("team").count()
    assert rows_of(staged) == [("a", 60), ("b", 60)]
    assert rows_of(read_history(spark, tables.history).groupBy("team").count()) == [("a", 60)]


def test_older_date_is_reported(spark):
    tables = season_load.Tables(workspace(spark, "late"))
    result = small_load(spark, tables, "2026-03-01", ("a", "1", match_page(range(1, 61))))
    assert rows_of(result.outcomes) == [("a", "2025", 60, "ok")]
    assert rows_of(result.ingest) == [("a", "2025", 60, 60, 0, 60, 60)]


def test_players_delivered_one_after_the_other(spark):
    tables = season_load.Tables(workspace(spark, "players"))
    small_load(spark, tables, "2026-03-27", ("a", "1", match_page(range(1, 41))))
    result = small_load(spark, tables, "2026-03-27", ("a", "2", match_page(range(1, 41))))
    assert rows_of(result.ingest) == [("a", "2025", 80, 80, 0, 80, 80)]
    again = small_load(spark, tables, "2026-03-27", ("a", "2", match_page(range(1, 42))))
    assert rows_of(again.ingest) == [("a", "2025", 81, 1, 80, 81, 81)]
    assert rows_of(again.summary) == [("a", "2025", 81, 2, "2026-03-27")]


def test_newest_snapshot_where_no_date_is_given(spark):
    """Each slice by its own newest date; older snapshots of it are not staged."""
    tables = season_load.Tables(workspace(spark, "undated"))
    pages = [("a", "1", "2026-03-20", 55), ("a", "1", "2026-03-27", 60), ("a", "2", "2026-03-20", 50), ("b", "3", "2026-03-25", 51)]
    frame = spark.createDataFrame(
        [(t, t.upper(), "2025", "GB1", p, p, date, match_page(range(1, n + 1))) for t, p, date, n in pages], PAGE)
    result = season_load.run(spark, frame, tables, "site", NOW)
    assert rows_of(result.outcomes) == [("a", "2025", 60, "ok"), ("b", "2025", 51, "ok")]
    assert rows_of(result.summary) == [("a", "2025", 60, 1, "2026-03-27"), ("b", "2025", 51, 1, "2026-03-25")]


def test_strict_load_without_errors(spark):
    tables = season_load.Tables(workspace(spark, "strict"))
    good = match_page(range(1, 61))
    frame = spark.createDataFrame(
        [(t, t.upper(), "2025", "GB1", "1", "1", "2026-03-27", good) for t in ("a", "b")], PAGE)
    result = season_load.run(spark, frame, tables, "site", NOW, "2026-03-27", strict=True)
    assert [(r.team, r.status, r.error) for r in result.outcomes.orderBy("team").collect()] == [("a", "ok", None), ("b", "ok", None)]
    assert rows_of(result.ingest) == [("a", "2025", 60, 60, 0, 60, 60), ("b", "2025", 60, 60, 0, 60, 60)]


def test_newest_snapshot_reads_its_pages_once(spark, tmp_path):
    """The rows are written before the newest date is chosen, as both sides of the choice read them."""
    from tidemark.plans.queries.documents import clean_latest_snapshot

    day = [dt.date(1995, 2, 3), dt.date(1995, 8, 9), dt.date(1995, 8, 9)]
    spark.createDataFrame(
        [(n, 7 + n, "O", d, "1-URGENT") for n, d in zip((2, 3, 6), day)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date, o_orderpriority string",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    got = clean_latest_snapshot(spark, str(tmp_path))
    assert "(?:!--" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.player_id, r.bronze_scrape_date) for r in got.collect()) == [("10", "1995-07-01")] * 2 + [("13", "1995-07-01")] * 2
