"""Loads of changed periods, interrupted runs and resumed jobs, each against a full run."""

from collections import Counter
from dataclasses import replace

import pytest
from data import gold, plan_of
from farevalue import __main__ as command
from farevalue.contracts import AWARD, BRONZE_CASH, GOLD, SILVER_CASH
from farevalue.operators import publish, quality, search, valuation
from farevalue.plans import medallion
from farevalue.plans.medallion import STEPS, UP_TO_DATE, Layout, Options, read_layer, run_job
from farevalue.plans.star_schema import single_fare_envelopes
from farevalue.sources.files import Contents
from farevalue.sources.readers import read_serving
from farevalue.sources.versions import Versions
from pyspark.sql import functions as F


def raw_fares(spark, path, *changes):
    single_fare_envelopes(gold(spark, *changes)).write.json(path)


def done(spark, layout, steps=STEPS, options=Options()):
    results = run_job(spark, layout, steps, options)
    assert [r.error for r in results if not r.ok] == []
    return results


def snapshot(spark, at):
    """What every table of a job holds, as counted rows."""
    layers = {
        "bronze": read_layer(spark, at.bronze_cash, BRONZE_CASH),
        "silver": read_layer(spark, at.silver_cash, SILVER_CASH),
        "award": read_layer(spark, at.bronze_award, AWARD),
        "gold": read_layer(spark, at.gold, GOLD),
        "flags": quality.read_flags(spark, at.quality).drop("run_id", "detected_at"),
        "metrics": quality.read_metrics(spark, at.quality).drop("run_id", "measured_at"),
        "serving": read_serving(spark, at.serving),
        "documents": publish.read_documents(spark, at.serving),
        "facets": search.summed_facets(publish.read_facets(spark, at.serving)),
    }
    return {name: Counter(map(str, df.collect())) for name, df in layers.items()}


def day(n):
    return f"2026-07-0{n}T00:00:00Z"


FIRST = [
    {"flight_id": "same", "ingestion_timestamp": day(1), "cash_price": 100.0},
    {"flight_id": "same", "ingestion_timestamp": day(2), "cash_price": 200.0},
    {"flight_id": "goes", "ingestion_timestamp": day(2)},
    {"flight_id": "stays", "ingestion_timestamp": day(3), "currency": " "},
    {"flight_id": "moves", "ingestion_timestamp": day(2), "departure_datetime": "2026-08-01T10:00:00Z",
     "arrival_datetime": "2026-08-01T09:00:00Z"},
    {"flight_id": "undated", "ingestion_timestamp": "soon"},
]
SECOND = [
    {"flight_id": "same", "ingestion_timestamp": day(2), "cash_price": 300.0, "airline": "Frontier"},
    {"flight_id": "moves", "ingestion_timestamp": day(2), "departure_datetime": "2026-09-01T10:00:00Z",
     "arrival_datetime": "2026-09-01T19:00:00Z"},
    {"flight_id": "comes", "ingestion_timestamp": day(2), "currency": ""},
]


def both_loads(spark, tmp_path, **settings):
    """A layout after two loads, the second of one day, and one after a full load of the same."""
    parts = Layout(str(tmp_path / "r1"), str(tmp_path / "parts"), keep_other_days=True, **settings)
    raw_fares(spark, parts.raw, *FIRST)
    raw_fares(spark, str(tmp_path / "r2"), *SECOND)
    done(spark, parts)
    parts = replace(parts, raw=str(tmp_path / "r2"))
    done(spark, parts)
    whole = Layout(str(tmp_path / "r3"), str(tmp_path / "whole"), **settings)
    stay = [f for f in FIRST if f["ingestion_timestamp"] != day(2)]
    raw_fares(spark, whole.raw, *stay, *SECOND)
    done(spark, whole)
    return parts, whole


@pytest.mark.parametrize("unit", ["day", "year"])
def test_a_reloaded_day_equals_a_full_load(spark, tmp_path, unit):
    parts, whole = both_loads(spark, tmp_path, period=unit, buckets=2)
    found, wanted = snapshot(spark, parts), snapshot(spark, whole)
    for name in wanted:
        assert found[name] == wanted[name], name
    if unit == "day":
        second = {"2026-07-02"}
        for path in (parts.bronze_cash, parts.silver_cash, parts.bronze_award):
            assert set(Versions(spark, path).newest.periods) == second, path
        # The first day has a fare of a flight whose prices of the second day changed.
        assert set(Versions(spark, parts.gold).newest.periods) == second | {"2026-07-01"}
        assert set(Versions(spark, parts.quality).newest.periods) == second | {"2026-07-01"}
        assert not Versions(spark, parts.serving).newest.complete


def test_a_day_that_loses_all_its_rows(spark, tmp_path):
    at = Layout(str(tmp_path / "r1"), str(tmp_path / "t"), keep_other_days=True, period="day", buckets=2)
    raw_fares(spark, at.raw, {"ingestion_timestamp": day(1)}, {"flight_id": "f2", "ingestion_timestamp": day(2)})
    done(spark, at)
    raw_fares(spark, str(tmp_path / "r2"), {"flight_id": "f2", "airline": None, "ingestion_timestamp": day(2)})
    done(spark, replace(at, raw=str(tmp_path / "r2")))
    assert [r["flight_id"] for r in read_layer(spark, at.gold, GOLD).collect()] == ["f1"]
    assert [r["flight_id"] for r in read_serving(spark, at.serving).collect()] == ["f1"]
    assert publish.read_documents(spark, at.serving).count() == 1


def test_nothing_is_read_of_other_days(spark, tmp_path, monkeypatch):
    """Metrics of all days are the sum of stored counts; gold is read for the changed day."""
    at = Layout(str(tmp_path / "r1"), str(tmp_path / "t"), keep_other_days=True, period="day", buckets=2)
    raw_fares(spark, at.raw, *FIRST)
    done(spark, at)
    raw_fares(spark, str(tmp_path / "r2"), {"flight_id": "new", "ingestion_timestamp": day(9)})
    at = replace(at, raw=str(tmp_path / "r2"))
    done(spark, at, STEPS[:4])
    seen = []

    def watched(df, contract, run, keep=()):
        seen.append(df.select("flight_id").collect())
        return quality_row_flags(df, contract, run, keep)

    quality_row_flags = quality.row_flags
    monkeypatch.setattr(quality, "row_flags", watched)
    done(spark, at, STEPS[4:5])
    assert [r["flight_id"] for rows in seen for r in rows] == ["new"]
    totals = {r["total_records"] for r in quality.read_metrics(spark, at.quality).collect()}
    assert totals == {read_layer(spark, at.gold, GOLD).count()}


@pytest.mark.parametrize("step", ["gold-analytics", "validate-gold", "index-search"])
def test_a_stopped_run_leaves_the_old_tables(spark, tmp_path, monkeypatch, step):
    """The run stops between the writes of its parts."""
    at = Layout(str(tmp_path / "r1"), str(tmp_path / "t"), period="year", buckets=2)
    raw_fares(spark, at.raw, *FIRST)
    done(spark, at)
    before = snapshot(spark, at)
    raw_fares(spark, str(tmp_path / "r2"), *SECOND)
    later = replace(at, raw=str(tmp_path / "r2"))
    names = [name for name, _ in STEPS]
    done(spark, later, STEPS[: names.index(step)])
    write, calls = Versions.write, []

    def failing(self, *args, **kwargs):
        calls.append(args)
        if len(calls) > 1:
            raise OSError("disk full")
        return write(self, *args, **kwargs)

    monkeypatch.setattr(Versions, "write", failing)
    results = run_job(spark, later, STEPS[names.index(step) :])
    assert [r.name for r in results] == [step] and "disk full" in str(results[0].error)
    monkeypatch.undo()
    tables = {
        "gold-analytics": ["gold"],
        "validate-gold": ["flags", "metrics"],
        "index-search": ["serving", "documents", "facets"],
    }
    now = snapshot(spark, at)
    for table in tables[step]:
        assert now[table] == before[table]
    # And the job goes on at that step.
    resumed = done(spark, later, options=Options(resume=True))
    outcomes = [r.outcome == UP_TO_DATE for r in resumed]
    assert outcomes == [n < names.index(step) for n in range(len(STEPS))]
    assert snapshot(spark, later)["gold"] != before["gold"]


def test_resume_without_changes_does_nothing_and_parameters_count(spark, tmp_path):
    at = Layout(str(tmp_path / "r1"), str(tmp_path / "t"), period="year", buckets=2)
    raw_fares(spark, at.raw, *FIRST)
    done(spark, at)
    again = done(spark, at, options=Options(resume=True))
    assert {r.outcome for r in again} == {UP_TO_DATE}
    stricter = done(spark, at, options=Options(resume=True, threshold=0.0, run_id="r7"))
    assert [r.name for r in stricter if r.outcome != UP_TO_DATE] == ["validate-gold"]
    assert {r["run_id"] for r in quality.read_metrics(spark, at.quality).collect()} == {"r7"}


def test_own_prices_reach_gold(spark, tmp_path):
    at = Layout(str(tmp_path / "r1"), str(tmp_path / "t"), period="year", buckets=2)
    raw_fares(spark, at.raw, {})
    done(spark, at, options=Options(points=lambda origin, destination, airline, cabin: F.lit(12.9)))
    assert [r["points_required"] for r in read_layer(spark, at.gold, GOLD).collect()] == [12]


def heavy_job(spark, tmp_path, name):
    at = Layout(str(tmp_path / "raw"), str(tmp_path / name), period="year", buckets=4)
    if not (tmp_path / "raw").exists():
        copies = [{"flight_id": "hot", "cash_price": float(n)} for n in range(60)]
        raw_fares(spark, at.raw, *copies, *({"flight_id": f"f{n}"} for n in range(90)), {"flight_id": None})
    done(spark, at)
    return at


def test_a_flight_that_outgrows_a_bucket_is_stored_apart(spark, tmp_path, monkeypatch):
    at = heavy_job(spark, tmp_path, "apart")
    parts = medallion.stored_fares(spark, at.silver_cash, SILVER_CASH)
    assert [p.select("flight_id").distinct().count() for p in parts] == [91, 1]
    monkeypatch.setattr(medallion, "MISSED", 1e9)  # no id is frequent enough
    plain = heavy_job(spark, tmp_path, "plain")
    assert medallion.stored_fares(spark, plain.silver_cash, SILVER_CASH)[1].count() == 0
    assert snapshot(spark, at) == snapshot(spark, plain)
    assert read_layer(spark, at.gold, GOLD).count() == 60 * 60 + 90


def test_stored_layers_need_no_shuffle_by_flight(spark, tmp_path, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    at = Layout(str(tmp_path / "r1"), str(tmp_path / "t"), period="year", buckets=2)
    raw_fares(spark, at.raw, *FIRST)
    done(spark, at)
    cash, _ = medallion.stored_fares(spark, at.silver_cash, SILVER_CASH)
    awards, _ = medallion.stored_fares(spark, at.bronze_award, AWARD)
    curated, _ = medallion.stored_fares(spark, at.gold, GOLD)
    plans = {
        "J1": valuation.value_fares(cash, awards),
        "hot ids": valuation.find_hot(cash, awards),
        "Q5": quality.duplicate_flags(curated, GOLD, quality.Run.now("r")),
        "S9": publish.latest_per_key(publish.serving_rows(curated.drop("period"))),
    }
    for name, df in plans.items():
        assert "Exchange" not in plan_of(df), name


def test_command_line_parameters(spark, tmp_path, capsys, settings):
    settings("spark.sql.shuffle.partitions", "4")
    raw, root = str(tmp_path / "raw"), str(tmp_path / "tables")
    raw_fares(spark, raw, {}, {"flight_id": "f2", "airline": None})
    rates = tmp_path / "rates"
    rates.mkdir()
    (rates / "routes.csv").write_text("origin,destination,tier\nLAX,JFK,LONG\n")
    (rates / "tiers.csv").write_text("tier,multiplier\nLONG,3.0\nMEDIUM_HAUL,2.0\n")
    (rates / "cabins.csv").write_text("cabin,multiplier\n")
    (rates / "airlines.csv").write_text("airline,multiplier\nDelta,1.5\n")
    given = [raw, root, "--rates", str(rates), "--threshold", "0.4", "--run-id", "mine", "--period", "year"]
    assert command.main([*given, "--buckets", "2", "--strict"]) == 0
    at = Layout(raw, root)
    assert [r["points_required"] for r in read_layer(spark, at.gold, GOLD).collect()] == [36_000]
    (metric,) = quality.read_metrics(spark, at.quality).where("field_name = 'airline'").collect()
    assert (metric["run_id"], metric["threshold"]) == ("mine", 0.4)
    capsys.readouterr()
    assert command.main([*given, "--resume"]) == 0
    assert capsys.readouterr().out.count(" ok (") == len(STEPS)
    assert len(Versions(spark, at.gold).log) == 1
    (rates / "airlines.csv").write_text("airline,multiplier\nDelta,2.0\n")
    assert command.main([*given, "--resume"]) == 0
    assert [r["points_required"] for r in read_layer(spark, at.gold, GOLD).collect()] == [48_000]
    (tmp_path / "raw" / "bad.json").write_text("garbage\n")
    assert command.main([raw, root, "--strict"]) == 1


def test_raw_data_is_measured(spark, tmp_path, monkeypatch, settings):
    settings("spark.sql.shuffle.partitions", "4")
    monkeypatch.setattr(command, "contents", lambda spark, path: Contents(1024**4, 1, 1))
    monkeypatch.setattr(command, "run_job", lambda *given: [])
    assert command.main([str(tmp_path), str(tmp_path)]) == 0
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 4096
