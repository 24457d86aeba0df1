"""Staging of the three survey-style source files.

Each file is read as text (``files.read_csv_text``), its known columns are
renamed to the staging names, absent ones are added as NULL, the column
order is fixed, and the loader's cleaning rules are applied as native
column expressions.  Splits of the files replace the loader's chunks; the
result is a plain DataFrame to write with ``files.overwrite_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.codes import to_nullable_number
from starloom.functions.dates import date_from_parts, to_nullable_date
from starloom.functions.text import clean_special_text, clean_text, yes_no
from starloom.operators.conform import conform_columns

# ---------------------------------------------------------------------------
# Source column -> staging column, per file (the longitudinal
# file has the staging names already).
# ---------------------------------------------------------------------------
HEALTH_SURVEY_COLUMNS = {
    "IDATE": "Date",
    "IMONTH": "Month",
    "IDAY": "Day",
    "_STATE": "State",
    "_SEX": "Gender",
    "_AGE_G": "AgeGroup",
    "EDUCA": "Education",
    "INCOME3": "IncomeLevel",
    "MENTHLTH": "MentalHealthDays",
    "GENHLTH": "GeneralHealthStatus",
    "SMOKE100": "SmokingStatus",
    "EXERANY2": "ExerciseStatus",
    "CHECKUP1": "CheckUpStatus",
}
WORKPLACE_COLUMNS = {
    "Age": "Age",
    "Gender": "Gender",
    "Country": "Country",
    "state": "State",
    "family_history": "FamilyHistory",
    "work_interfere": "WorkInterference",
    "remote_work": "RemoteWork",
    "benefits": "Benefits",
    "seek_help": "SeekHelp",
    "treatment": "Treatment",
    "no_employees": "NumEmployees",
    "tech_company": "TechCompany",
    "care_options": "CareOptions",
    "wellness_program": "WellnessProgram",
    "awareness_of_options": "AwarenessLevel",
    "know_resources": "KnowledgeLevel",
    "anonymity_protected": "ComfortLevel",
    "supervisor_support": "ManagerSupport",
}
LONGITUDINAL_COLUMNS = ["SourcePersonID", "Year", "Month", "Gender", "AgeGroup", "Education", "IncomeLevel",
                        "FamilyHistory", "Country", "State", "NumEmployees", "TechCompany", "CareOptions",
                        "WellnessProgram", "RemoteWork", "Benefits", "WorkInterference", "AwarenessLevel",
                        "KnowledgeLevel", "ComfortLevel", "ManagerSupport", "MentalHealthDays",
                        "SmokingStatus", "ExerciseStatus", "GeneralHealthStatus", "SeekHelp", "Treatment",
                        "FullDate"]
# Yes/No-style attributes normalised at staging.
YES_NO_ATTRIBUTES = ["FamilyHistory", "RemoteWork", "Benefits", "SeekHelp", "Treatment",
                     "TechCompany", "CareOptions", "WellnessProgram"]
# ---------------------------------------------------------------------------

_TEXT = "string"


def _nullable_int(c: str):
    return to_nullable_number(c).try_cast("int")


def stage_health_survey(raw: DataFrame) -> DataFrame:
    """Health-survey file -> staging (13 columns; day count as INT)."""
    s = conform_columns(raw, HEALTH_SURVEY_COLUMNS, [(t, _TEXT) for t in HEALTH_SURVEY_COLUMNS.values()])
    wrapped, counted = ["Date", "Month", "Day"], ["MentalHealthDays"]
    cols = {c: clean_special_text(c) if c in wrapped else clean_text(c)
            for c in HEALTH_SURVEY_COLUMNS.values() if c not in counted}
    cols.update({c: _nullable_int(c) for c in counted})
    return s.withColumns(cols)


def stage_workplace(raw: DataFrame) -> DataFrame:
    """Workplace-survey file -> staging (18 text columns)."""
    s = conform_columns(raw, WORKPLACE_COLUMNS, [(t, _TEXT) for t in WORKPLACE_COLUMNS.values()])
    cols = {c: clean_text(c) for c in WORKPLACE_COLUMNS.values()}
    cols.update({c: yes_no(c) for c in YES_NO_ATTRIBUTES})
    return s.withColumns(cols)


def stage_longitudinal(raw: DataFrame) -> DataFrame:
    """Longitudinal file -> staging (28 columns); a missing FullDate is the
    first day of Year/Month."""
    ints = ["SourcePersonID", "Year", "Month", "MentalHealthDays"]
    target = [(t, "int" if t in ints else ("date" if t == "FullDate" else _TEXT))
              for t in LONGITUDINAL_COLUMNS]
    text = conform_columns(raw, {c: c for c in LONGITUDINAL_COLUMNS}, [(t, _TEXT) for t, _ in target])
    cols = {c: _nullable_int(c) for c in ints}
    cols["FullDate"] = date_from_parts("Year", "Month", to_nullable_date("FullDate"))
    texts = [t for t, kind in target if kind == _TEXT]
    cols.update({c: clean_text(c) for c in texts})
    staged = text.withColumns(cols)
    staged = staged.withColumns({c: yes_no(c) for c in YES_NO_ATTRIBUTES})
    return staged.select(*[F.col(t).cast(kind).alias(t) for t, kind in target])
