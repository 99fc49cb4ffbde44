"""Published tables: merges by key, audits, conflicts, killed writers, pinned
readers, deltas and folds, compaction."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from roadpulse.plans import daily
from roadpulse.sinks import (AuditFailed, Conflict, Published, publish_daily_report, read_daily_reports,
                             upsert_daily_report)

DAY = dt.date(2024, 1, 15)


def rows(telemetry, day, sensors="AB", bump=0):
    return telemetry([(i, s, f"{day} {h:02d}:10:00", 10 + i + bump, 40)
                      for i, (s, h) in enumerate((s, h) for s in sensors for h in (1, 2))])


def values(df):
    return {(str(r.report_date), r.sensor_id): r.total_daily_vehicles for r in df.collect()}


def test_upsert_of_one_sensor_keeps_the_others(spark, telemetry, tmp):
    path = f"{tmp}/reports"
    upsert_daily_report(daily.daily_report(rows(telemetry, "2024-01-14")), path)
    upsert_daily_report(daily.daily_report(rows(telemetry, "2024-01-15")), path)
    before = values(read_daily_reports(spark, path))
    upsert_daily_report(daily.daily_report(rows(telemetry, "2024-01-15", "A", 100)), path)
    after = values(read_daily_reports(spark, path))
    assert after == before | {("2024-01-15", "A"): before["2024-01-15", "A"] + 200}
    upsert_daily_report(daily.daily_report(rows(telemetry, "2024-01-15", "C")), path)
    assert set(values(read_daily_reports(spark, path))) == set(before) | {("2024-01-15", "C")}


def test_only_touched_dates_are_rewritten(spark, telemetry, tmp):
    path = f"{tmp}/reports"
    for day in ("2024-01-14", "2024-01-15"):
        upsert_daily_report(daily.daily_report(rows(telemetry, day)), path)
    table = Published(spark, path)
    first = table.manifest()["slices"]
    upsert_daily_report(daily.daily_report(rows(telemetry, "2024-01-15", "A", 1)), path)
    second = table.manifest()["slices"]
    assert first["2024-01-14"] == second["2024-01-14"] and first["2024-01-15"] != second["2024-01-15"]
    late = read_daily_reports(spark, path, DAY)
    assert values(late).keys() == {("2024-01-15", "A"), ("2024-01-15", "B")}
    assert all("2024-01-14" not in f for f in late.inputFiles())


def test_a_key_given_twice_stops_the_publish(spark, telemetry, tmp):
    path = f"{tmp}/reports"
    report = daily.daily_report(rows(telemetry, "2024-01-15"))
    upsert_daily_report(report, path)
    before = values(read_daily_reports(spark, path))
    with pytest.raises(AuditFailed, match="more than once"):
        upsert_daily_report(report.unionByName(report), path)
    with pytest.raises(AuditFailed):
        publish_daily_report(report.unionByName(report), path, DAY)
    assert values(read_daily_reports(spark, path)) == before and Published(spark, path).versions() == [1]


def test_a_day_is_replaced_also_by_nothing(spark, telemetry, tmp):
    path = f"{tmp}/reports"
    for day in ("2024-01-14", "2024-01-15"):
        publish_daily_report(daily.daily_report(rows(telemetry, day)), path, dt.date.fromisoformat(day))
    publish_daily_report(daily.daily_report(rows(telemetry, "2024-01-14")), path, DAY)
    assert {k[0] for k in values(read_daily_reports(spark, path))} == {"2024-01-14"}


def test_a_killed_write_leaves_the_old_table(spark, telemetry, tmp, monkeypatch):
    path = f"{tmp}/reports"
    upsert_daily_report(daily.daily_report(rows(telemetry, "2024-01-15")), path)
    before = values(read_daily_reports(spark, path))

    def die(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Published, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            upsert_daily_report(daily.daily_report(rows(telemetry, "2024-01-15", bump=7)), path)
    assert values(read_daily_reports(spark, path)) == before
    upsert_daily_report(daily.daily_report(rows(telemetry, "2024-01-15", bump=9)), path)
    assert values(read_daily_reports(spark, path))["2024-01-15", "A"] == before["2024-01-15", "A"] + 18


def test_two_writers_of_one_version(spark, telemetry, tmp):
    path = f"{tmp}/reports"
    a = daily.daily_report(rows(telemetry, "2024-01-14"))
    table = Published(spark, path)
    base = table.manifest()
    aside = table.write_aside(a, F.col("report_date"))
    table.publish(base, aside, a.schema)
    with pytest.raises(Conflict):
        table.publish(base, aside, a.schema)
    threads = [threading.Thread(target=upsert_daily_report, args=(
        daily.daily_report(rows(telemetry, "2024-01-15", s)), path)) for s in "ABCD"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = values(read_daily_reports(spark, path))
    assert {k for k in got if k[0] == "2024-01-15"} == {("2024-01-15", s) for s in "ABCD"}
    assert not [n for n in os.listdir(f"{path}/_versions") if not n.endswith((".json", ".crc"))]


def log_rows(spark, k, n=3):
    return spark.range(n).select(F.lit(dt.date(2024, 1, 1 + k % 2)).alias("day"), F.col("id").alias("key"),
                                 F.lit(k).cast("long").alias("v"))


def test_deltas_fold_and_replays_change_nothing(spark, tmp):
    table = Published(spark, f"{tmp}/log", keep=3)
    for k in range(12):
        for _ in range(2):   # every batch twice
            table.append(log_rows(spark, k), "w", k)
        table.fold(F.col("day"), ["day", "key"], 4)
        m = table.manifest()
        assert len(table.deltas(m)) < 4
        assert table.read(manifest=m).count() <= 6 + 3 * 4
    got = sorted(tuple(r)[:3] for r in table.newest(["day", "key"]).collect())
    assert got == sorted((dt.date(2024, 1, 1 + k % 2), i, k) for k in (10, 11) for i in range(3))
    assert len(table.versions()) == 3
    held = {f.split("/")[1] for n in table.versions() for s in table.manifest(n)["slices"].values() for f in s}
    assert set(os.listdir(f"{tmp}/log/data")) == held      # data of forgotten versions went


def test_versions_that_another_writer_forgot(spark, tmp, monkeypatch):
    table = Published(spark, f"{tmp}/log", keep=2)
    for k in range(4):
        table.append(log_rows(spark, k), "w", k)
    known = table.versions()
    assert known == [3, 4]
    look = Published.versions

    def stale(gone):
        """The first look of a publish still shows versions that went."""
        seen = []

        def versions(self):
            seen.append(1)
            return sorted({*gone, *look(self)}) if len(seen) == 1 else look(self)
        return versions

    manifest = table.manifest()
    for gone in ([1, 2], [8, 9]):     # forgotten ones went; versions to keep went
        with monkeypatch.context() as m:
            m.setattr(Published, "versions", stale(gone))
            table._forget(manifest)
        assert table.versions() == known and table.read().count() == 12
    table.append(log_rows(spark, 4), "w", 4)
    assert table.versions() == [4, 5] and table.read().count() == 15


def test_a_log_without_keys_keeps_every_row(spark, tmp):
    table = Published(spark, f"{tmp}/log")
    for k in range(5):
        table.append(log_rows(spark, k), "w", k)
        table.fold(F.col("day"), None, 2)
    assert table.read().count() == 15


def test_compaction_keeps_rows_and_readers(spark, tmp):
    table = Published(spark, f"{tmp}/log", keep=200)
    for k in range(40):
        table.append(log_rows(spark, k), "w", k)
    table.fold(F.col("day"), None)
    many = {"x": [f for fs in table.manifest()["slices"].values() for f in fs]}
    reader = table.read()
    assert len(reader.inputFiles()) > 4
    want = sorted(map(tuple, reader.collect()))
    assert set(table.compact(lambda s: True)) <= {"2024-01-01", "2024-01-02"}
    now = table.read()
    assert len(now.inputFiles()) == 2 and sorted(map(tuple, now.collect())) == want
    assert sorted(map(tuple, reader.collect())) == want and many     # an earlier reader goes on
    assert table.compact(lambda s: True) == []


def test_reading_what_was_never_published(spark, tmp):
    with pytest.raises(FileNotFoundError):
        Published(spark, f"{tmp}/none").read()
