"""Staging of survey-shaped files (invented rows): rename, fill, order and clean."""

import csv
import datetime as dt
import os

from starloom.session import scratch_path
from starloom.sources.files import read_csv_text
from starloom.sources.survey import (HEALTH_SURVEY_COLUMNS, LONGITUDINAL_COLUMNS, WORKPLACE_COLUMNS,
                                     stage_health_survey, stage_longitudinal, stage_workplace)
from starloom.sources.xport import local_path


def _csv(spark, name, header, rows):
    folder = local_path(scratch_path(spark, name))
    os.makedirs(folder)
    path = os.path.join(folder, f"{name}.csv")
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)
    return read_csv_text(spark, path)


def test_health_survey_staging(spark):
    raw = _csv(spark, "health", ["IDATE", "_STATE", "_SEX", "MENTHLTH", "EXTRA", "GENHLTH"], [
        ["b'01152024'", "25.0", "1.0", "88.0", "x", " 2 "],
        ["1152024", " ", "2", "abc", "y", "nan"],
    ])
    out = stage_health_survey(raw)
    assert out.columns == list(HEALTH_SURVEY_COLUMNS.values())
    r = [r.asDict() for r in out.orderBy("Gender").collect()]
    assert r[0]["Date"] == "01152024" and r[0]["State"] == "25.0" and r[0]["MentalHealthDays"] == 88
    assert r[0]["GeneralHealthStatus"] == "2" and r[0]["Month"] is None
    assert r[1]["Date"] == "1152024" and r[1]["State"] is None and r[1]["MentalHealthDays"] is None
    assert r[1]["GeneralHealthStatus"] is None


def test_workplace_staging(spark):
    header = [c for c in WORKPLACE_COLUMNS if c != "supervisor_support"]
    row1 = {c: "" for c in header} | {"Age": "32.0", "Country": "U.S.A.", "benefits": "Don't know",
                                       "treatment": "Y", "family_history": "maybe", "remote_work": "N/A",
                                       "tech_company": " TRUE "}
    out = stage_workplace(_csv(spark, "workplace", header, [[row1[c] for c in header]]))
    assert out.columns == list(WORKPLACE_COLUMNS.values())
    r = out.first().asDict()
    assert r["Age"] == "32.0" and r["Country"] == "U.S.A." and r["ManagerSupport"] is None
    assert (r["Benefits"], r["Treatment"], r["FamilyHistory"], r["RemoteWork"], r["TechCompany"]) == \
        ("Don't know", "Yes", "Maybe", None, "Yes")


def test_longitudinal_staging(spark):
    header = ["SourcePersonID", "Year", "Month", "RemoteWork", "FullDate", "TreatmentFlag"]
    out = stage_longitudinal(_csv(spark, "longitudinal", header, [
        ["7.0", "2024", "4", "yes", "", "1"],
        ["8", "2024", "13", "no", "", "0"],
        ["9", "2024", "1", "", "2024-02-03", "1"],
    ]))
    assert out.columns == LONGITUDINAL_COLUMNS
    got = [(r.SourcePersonID, r.FullDate, r.RemoteWork, r.Treatment) for r in out.orderBy("SourcePersonID").collect()]
    assert got == [(7, dt.date(2024, 4, 1), "Yes", None), (8, None, "No", None), (9, dt.date(2024, 2, 3), None, None)]
