"""Integration of three layouts, load modes, and tables replaced by a swap."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from starloom.operators.integration import Layout, candidates, integrate_load
from starloom.sources import layouts
from starloom.sources.files import list_folder
from starloom.sources.survey import stage_health_survey, stage_longitudinal, stage_workplace
from starloom.sources.versions import VersionedTable


def sha(*slots):
    return hashlib.sha256("|".join("" if s is None else str(s) for s in slots).encode()).hexdigest()


@pytest.fixture(scope="module")
def sources(spark):
    health = stage_health_survey(spark.createDataFrame(
        [("b'1152024'", "25.0", "1.0", "3.0", "88.0"), ("b'1152024'", "25.0", "1.0", "3.0", "88.0"), ("13452024", " ", None, "x", "7")],
        "IDATE string, _STATE string, _SEX string, _AGE_G string, MENTHLTH string"))
    work = stage_workplace(spark.createDataFrame(
        [("17", "M", "U.S.A.", "CA", "Y"), ("65", "F", "", None, "0"), ("32.0", "F", "Canada", "zz", "maybe")],
        "Age string, Gender string, Country string, state string, family_history string"))
    long = stage_longitudinal(spark.createDataFrame(
        [("1", "2024", "4", "Male", "31"), ("1", "2024", "4", "Male", "31"), ("2", "2024", "4", "Male", "12")],
        "SourcePersonID string, Year string, Month string, Gender string, MentalHealthDays string"))
    return [(health, layouts.health_layout()), (work, layouts.workplace_layout()), (long, layouts.longitudinal_layout())]


def test_each_layout_hashes_its_own_slots(sources):
    rows = candidates(sources, layouts.INTEGRATED).collect()
    assert len(rows) == 9
    for r in rows:
        attributes = [r[a] for a in layouts.ATTRIBUTES]
        lead = {layouts.HEALTH_SYSTEM: [r.FullDate], layouts.WORKPLACE_SYSTEM: [""], layouts.LONGITUDINAL_SYSTEM: [r.SourcePersonID, r.FullDate]}[r.SourceSystem]
        assert r.row_hash == sha(r.SourceSystem, *lead, *attributes)
    health = [r for r in rows if r.SourceSystem == layouts.HEALTH_SYSTEM]
    assert sorted((str(r.FullDate), r.Country, r.State, r.Gender, r.MentalHealthDays, r.RemoteWork) for r in health) == [
        ("2024-01-15", "United States", "25.0", "1.0", None, "Not Found"), ("2024-01-15", "United States", "25.0", "1.0", None, "Not Found"),
        ("None", "United States", "Not Found", "Not Found", 7, "Not Found")]
    work = [r for r in rows if r.SourceSystem == layouts.WORKPLACE_SYSTEM]
    assert sorted((r.AgeGroup, r.Country, r.FamilyHistory, r.AwarenessLevel) for r in work) == [
        ("65+", "Not Found", "No", "Not Found"), ("Not Found", "Canada", "Maybe", "Not Found"), ("Not Found", "U.S.A.", "Yes", "Not Found")]
    long = [r for r in rows if r.SourceSystem == layouts.LONGITUDINAL_SYSTEM]
    assert {(r.SourcePersonID, r.FullDate, r.MentalHealthDays) for r in long} == {(1, dt.date(2024, 4, 1), None), (2, dt.date(2024, 4, 1), 12)}


def test_full_and_delta_loads(spark, sources, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/integrated")
    load = lambda some, mode: integrate_load(table, some, layouts.INTEGRATED, mode, ["SourceSystem", "SourcePersonID", "FullDate"])
    assert (r := load(sources[:2], "delta")) and (r.candidates, r.distinct, r.inserted) == (6, 5, 5)
    assert (r := load(sources, "delta")) and (r.candidates, r.distinct, r.inserted) == (9, 7, 2)
    first = table.read().select("row_hash", "load_timestamp").collect()
    assert (r := load(sources, "delta")) and r.inserted == 0
    assert sorted(table.read().select("row_hash", "load_timestamp").collect()) == sorted(first)
    assert len({r.load_timestamp for r in first}) == 2 and all(r.load_timestamp for r in first)
    assert (r := load(sources, "full")) and r.inserted == 7
    assert table.read().count() == 7 and len({r.load_timestamp for r in table.read().collect()}) == 1
    with pytest.raises(ValueError):
        load(sources, "merge")


def test_equal_rows_of_different_systems_stay_apart(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "kind string")
    target = [("source_system", "string"), ("kind", "string")]
    same = {"kind": F.col("kind")}
    table = VersionedTable(spark, f"{tmp_path}/t")
    assert integrate_load(table, [(df, Layout("x", same, ["kind"])), (df, Layout("y", same, ["kind"]))], target).inserted == 2


def test_readers_see_whole_versions(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/dim")
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.swap(spark.range(10).withColumn("v", F.lit(1)))
    before = table.read()
    # the next version may read the one that it replaces
    assert table.swap(table.read().withColumn("v", F.lit(2)).filter("id < 4")) == 2
    assert before.agg(F.count("v"), F.sum("v")).first()[:] == (10, 10)
    assert table.read().agg(F.count("v"), F.sum("v")).first()[:] == (4, 8)
    table.swap(spark.range(1).withColumn("v", F.lit(3)))
    assert len([f for f in list_folder(spark, table.path) if f.startswith("v")]) == 2


def test_a_failed_swap_leaves_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/dim")
    table.swap(spark.range(3))
    with pytest.raises(Exception, match="(?i)boom"):
        table.swap(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")))
    assert table.read().count() == 3
    table.swap(spark.range(5))
    assert table.read().count() == 5
