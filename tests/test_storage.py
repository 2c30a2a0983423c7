import datetime as dt
import json
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upsert import read_history, read_table
from tidemark.schemas import PLAYER_SNAPSHOT, RAW_COLUMNS, ROSTER_SNAPSHOT, text_schema
from tidemark.session import workspace
from tidemark.sources import manifest, snapshots, staging, tables
from tidemark.streaming.incremental import append_batch, load_new_files, upsert_batch

TODAY = dt.date(2026, 3, 27)


def put(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload, indent=2))


def player(name, rows):
    return {"team": "u", "season": "2025", "season_label": "2025/2026", "club": "United",
            "player_name": name, "player_id": "1", "scraped_at": "x", "player_stats": rows}


def test_snapshot_tree(spark, tmp_path):
    base = tmp_path / "raw" / "site" / "u" / "player_detailed_stats_individual"
    row = {"player_name": "One", "matchday": 3, "performance_rating": 1.2, "goals": None}
    put(base / "player_id=1_one" / "2025" / "scrape_date=2026-03-26.json", player("One", [row]))
    put(base / "player_id=1_one" / "2025" / "scrape_date=2026-03-27.json", player("One", [row, row]))
    put(base / "player_id=2_two" / "2025" / "scrape_date=2026-03-27.json", player("Two", []))
    put(base / "player_id=2_two" / "2024" / "scrape_date=2026-03-27.json", player("Two", [row]))
    got = snapshots.read_snapshot_tree(
        spark, str(tmp_path / "raw"), PLAYER_SNAPSHOT, "site", "u",
        "player_detailed_stats_individual", "2025", "2026-03-27")
    rows = {r.path_entity: (len(r.player_stats), r.path_season, r.path_scrape_date, r.path_team)
            for r in got.collect()}
    assert rows == {
        "player_id=1_one": (2, "2025", "2026-03-27", "u"),
        "player_id=2_two": (0, "2025", "2026-03-27", "u"),
    }
    none = snapshots.read_snapshot_tree(spark, str(tmp_path / "raw"), PLAYER_SNAPSHOT, season="1999")
    assert none.schema == got.schema and none.count() == 0


def test_roster_metadata(spark, tmp_path):
    put(tmp_path / "site" / "u" / "team_roster" / "2025" / "scrape_date=2026-03-27.json",
        {"team": "u", "club": "United", "club_id": "985", "players": [{"player_name": "One"}]})
    put(tmp_path / "site" / "v" / "team_roster" / "2025" / "scrape_date=2026-03-27.json",
        {"team": "v", "club": "", "club_id": "7", "players": []})
    rosters = snapshots.read_snapshot_tree(spark, str(tmp_path), ROSTER_SNAPSHOT, artifact="team_roster")
    assert [tuple(r) for r in snapshots.roster_metadata(rosters, ["team"]).collect()] == [
        ("u", "United", "985")]
    with pytest.raises(Exception):
        snapshots.roster_metadata(rosters, ["team"], strict=True).collect()


def documents(spark, *rows):
    df = spark.createDataFrame(list(rows), "team string, scrape_date string, club string")
    return df.withColumns({"source": F.lit("site"), "artifact": F.lit("team_roster"),
                           "season": F.lit("2025")})


def test_same_date_replaces_other_dates_stay(spark):
    root = workspace(spark, "snap")
    snapshots.write_snapshots(documents(spark, ("u", "2026-03-26", "old"), ("u", None, "first")), root, TODAY)
    snapshots.write_snapshots(documents(spark, ("u", None, "second")), root, TODAY)
    got = snapshots.read_snapshots(spark, root, ROSTER_SNAPSHOT)
    assert sorted((r.scrape_date, r.club) for r in got.collect()) == [
        ("2026-03-26", "old"), ("2026-03-27", "second")]
    pruned = got.filter("scrape_date = '2026-03-27'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scrape_date" in pruned


def test_csv_keeps_quotes_breaks_and_order(spark, tmp_path):
    text = 'He said "no",\nthen left'
    columns = ["player_id", "note", "goals"]
    put(tmp_path / "a.csv", 'player_id,note,goals\n7,"He said ""no"",\nthen left",NA\n8,,\n')
    got = tables.read_csv(spark, str(tmp_path / "a.csv"), columns).drop("_path").collect()
    assert [tuple(r) for r in got] == [("7", text, None), ("8", None, None)]
    plain = tables.read_csv(spark, str(tmp_path / "a.csv"), columns, missing=False)
    assert [tuple(r)[:3] for r in plain.collect()] == [("7", text, "NA"), ("8", "", "")]
    # another column order is found by name, or refused; never shifted
    put(tmp_path / "b.csv", "goals,player_id,note\n1,7,x\n")
    assert tables.read_csv(spark, str(tmp_path / "b.csv")).first().player_id == "7"
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path / "b.csv"), columns).collect()


def test_csv_round_trip_writes_nothing_for_no_rows(spark, tmp_path):
    root = workspace(spark, "csv")
    row = tuple("x" if c == "note" else " NA" if c == "venue" else None for c in RAW_COLUMNS)
    df = spark.createDataFrame([row], text_schema(RAW_COLUMNS)).withColumns(
        {"team": F.lit("u"), "scrape_date": F.lit("2026-03-27")})
    tables.write_csv(df, root, ["team", "scrape_date"])
    stored = [c for c in RAW_COLUMNS if c != "scrape_date"]
    got = tables.read_csv(spark, root, stored, ["team", "scrape_date"]).first()
    assert (got.note, got.venue, got.team, got.goals) == ("x", " NA", "u", None)
    tables.write_csv(df.filter("false"), f"{root}-empty", ["team", "scrape_date"])
    listed = manifest.list_files(spark, root, "*.csv")
    assert listed.count() == 1


def test_staging_matches_by_name_and_counts(spark):
    path = workspace(spark, "staging")
    df = spark.createDataFrame([("u", "2025", "2026-03-27", 1)], "TEAM string, Season string, "
                               "bronze_scrape_date string, GOALS int")
    assert staging.append_staging(df, path) == 1
    assert staging.append_staging(df, path) == 1
    got = staging.read_staging(spark, path)
    assert got.count() == 2 and got.first().goals == "1" and got.first().note is None
    assert got.first().season == "2025"


def test_manifest(spark):
    files = spark.createDataFrame(
        [(f"data/{p}",) for p in (
            "raw/site/u/team_roster/2025/b.json", "raw/site/u/team_roster/2024/a.json",
            "raw/site/u/team_roster/2025/x.txt", "raw/site/v/team_roster/2025/c.json",
            "raw/site/u/league_teams/2025/l.json",
            "raw/site/u/player_detailed_stats_combined/2025/a.csv",
            "cleaned/site/u/player_stats/2025/scrape_date=2026-03-23.csv")], "path string")
    got = manifest.manifest(files, "site", "data/raw", "data/cleaned", season="2025", team="u")
    assert [r.path[5:] for r in got.collect()] == [
        "cleaned/site/u/player_stats/2025/scrape_date=2026-03-23.csv",
        "raw/site/u/player_detailed_stats_combined/2025/a.csv",
        "raw/site/u/team_roster/2025/b.json"]
    raw = manifest.manifest(files, "site", "data/raw", "data/cleaned", "2025", "u", False)
    assert raw.count() == 2
    plan = manifest.upload_plan(got, "site", "data/raw", "data/cleaned")
    assert [r.key.split("/")[0] for r in plan.orderBy("path").collect()] == ["cleaned", "raw", "raw"]


def test_new_files_are_loaded_once(spark):
    root = workspace(spark, "stream")
    schema = T.StructType([T.StructField("id", T.LongType())])
    seen = []

    def catch_up():
        def each(batch, number):
            seen.append(number)
            append_batch(f"{root}/out")(batch, number)

        load_new_files(spark, f"{root}/in", schema, f"{root}/checkpoint", each)

    spark.range(5).write.mode("append").parquet(f"{root}/in")
    catch_up()
    catch_up()
    assert seen == [0]
    spark.range(5, 9).write.mode("append").parquet(f"{root}/in")
    catch_up()
    assert seen == [0, 1]
    out = read_table(spark, f"{root}/out", schema)
    assert sorted(r.id for r in out.collect()) == list(range(9))
    # a batch handed over again replaces itself
    append_batch(f"{root}/out")(spark.range(5, 9), 1)
    assert read_table(spark, f"{root}/out", schema).count() == 9


def test_stream_upsert(spark):
    root = workspace(spark, "stream-upsert")
    row = "team string, season string, player_id string, transformed_at string, goals int"
    schema = spark.createDataFrame([], row).schema
    each = upsert_batch(
        f"{root}/history", keys=["team", "season", "player_id"], by=["team", "season"], schema=schema)
    for stamp, goals in (("1", 1), ("2", 2)):
        spark.createDataFrame([("u", "2025", "p", stamp, goals)], row).write.mode("append").parquet(
            f"{root}/in")
        load_new_files(spark, f"{root}/in", schema, f"{root}/checkpoint", each)
    got = read_history(spark, f"{root}/history", schema)
    assert [(r.player_id, r.goals) for r in got.collect()] == [("p", 2)]


def test_no_file_of_another_season_is_opened(spark, tmp_path):
    """Broken files that are not asked for do no harm, as their paths rule them out."""
    base = tmp_path / "raw" / "site" / "u" / "team_roster"
    for season in ("2024", "2025"):
        for day in ("2026-03-26", "2026-03-27"):
            put(base / season / f"scrape_date={day}.json", {"club": f"{season} {day}", "players": []})
    put(base / "2023" / "scrape_date=2026-03-27.json", "{broken")
    put(base / "2025" / "notes.json", "{broken")
    schema = T.StructType([f for f in ROSTER_SNAPSHOT.fields if f.name in ("club", "players")])
    got = snapshots.read_snapshot_tree(spark, str(tmp_path / "raw"), schema, "site", season="2025")
    assert sorted(r.club for r in got.collect()) == ["2025 2026-03-26", "2025 2026-03-27"]
    execution = got._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    found = re.search(r"number of files read[^0-9]*([0-9]+)", scan_metrics(execution.executedPlan()))
    assert found and found.group(1) == "2"


def scan_metrics(plan) -> str:
    while plan.children().size():
        plan = plan.children().apply(0)
    return f"number of files read: {plan.metrics().apply('numFiles').value()}"


def test_three_deliveries_become_one_file_set(spark):
    root, day = workspace(spark, "folded"), "2026-03-27"
    kind = "team string, player_id string, club string"
    common = {"source": F.lit("site"), "artifact": F.lit("x"), "season": F.lit("2025"), "scrape_date": F.lit(day)}

    def deliver(number, *rows):
        df = spark.createDataFrame([("u", *r) for r in rows], kind).withColumns(common)
        snapshots.write_snapshots(df, root, TODAY, delivered=F.lit(f"{number:04d}"))

    every = F.lit(True)
    read = lambda: sorted(tuple(r) for r in snapshots.read_newest(
        spark, root, PLAYER_SNAPSHOT, every).select("player_id", "club").collect())
    deliver(1, ("p", "first"), ("p", "first, row two"))
    deliver(2, ("q", "second"))
    deliver(3, ("p", "third"))
    expected = [("p", "third"), ("q", "second")]
    assert read() == expected
    replaced = snapshots.compact_snapshots(spark, root, PLAYER_SNAPSHOT, every)
    assert len(replaced) >= 3 and read() == expected  # readers see old and new files together
    deliver(4, ("q", "fourth"))
    assert read() == [("p", "third"), ("q", "fourth")]
    manifest.remove(spark, replaced)
    assert read() == [("p", "third"), ("q", "fourth")]
    manifest.remove(spark, snapshots.compact_snapshots(spark, root, PLAYER_SNAPSHOT, every))
    manifest.remove(spark, replaced)  # once more does no harm
    assert read() == [("p", "third"), ("q", "fourth")]
    assert len(list(Path(root).rglob("part-*.json"))) == 1
    assert snapshots.compact_snapshots(spark, root, PLAYER_SNAPSHOT, F.lit(False)) == []


@pytest.mark.parametrize("by", [["d"], ["team", "d"], ["team", "season", "kind", "d"]])
def test_retention_at_any_depth(spark, by):
    path = workspace(spark, "expiring")
    df = spark.range(600).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("team"), F.lit("a b+c").alias("season"), F.lit("x").alias("kind"),
        F.when(F.col("id") % 100 != 7, F.date_sub(F.lit(TODAY), (F.col("id") % 40).cast("int")).cast("string")).alias("d"))
    df.write.partitionBy(*by).parquet(path)
    gone = staging.drop_expired(spark, path, TODAY, 14, "d")
    assert gone and staging.drop_expired(spark, path, TODAY, 14, "d") == []
    left = {r.id for r in read_table(spark, path, df.schema).select("id").collect()}
    assert left == {n for n in range(600) if n % 100 == 7 or n % 40 <= 14}
    assert staging.drop_expired(spark, path + "-none", TODAY) == []


@pytest.mark.parametrize("block", ["64", "1000", "128m"])
def test_csv_by_blocks_equals_the_whole(spark, tmp_path, block):
    """Blocks that end inside quotes, between doubled quotes, and in the middle of a record of many lines."""
    rng = random.Random(6)
    parts = ["a", 'say ""x""', "\n", ",", "line\n\nline", "é", '""', "  "]
    lines = ["player_id,note,goals\n"]
    for n in range(400):
        note = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        lines.append(f'{n},"{note}",{rng.choice(["", "1", "NA"])}\n')
        lines += ["\n"] * (n % 50 == 0)
    lines.append('400,"' + "long\n" * 500 + '",7')
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("".join(lines), newline="")
    columns = ["player_id", "note", "goals"]
    expected = Counter(tuple(r) for r in tables.read_csv(spark, str(tmp_path), columns).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = tables.read_csv_blocks(spark, str(tmp_path), columns)
        assert Counter(tuple(r) for r in got.collect()) == expected and sum(expected.values()) == 802
        with pytest.raises(Exception):
            tables.read_csv_blocks(spark, str(tmp_path), columns[::-1]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
