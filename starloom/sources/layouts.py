"""The survey warehouse's integrated table and the layouts of its three staged sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.codes import band, range_guard, try_int
from starloom.functions.dates import date_from_digits, iso_date_text
from starloom.functions.text import NOT_FOUND, not_found_default
from starloom.operators.integration import Layout, Target

# ---------------------------------------------------------------------------
# The integrated attributes in the order in which they are
# hashed, the systems' names, and which attributes each source supplies.
# ---------------------------------------------------------------------------
ATTRIBUTES = ["Gender", "AgeGroup", "Education", "IncomeLevel", "FamilyHistory", "Country", "State", "WorkInterference", "RemoteWork", "Benefits",
              "GeneralHealthStatus", "MentalHealthDays", "CheckUpStatus", "SmokingStatus", "ExerciseStatus", "SeekHelp", "Treatment", "NumEmployees",
              "TechCompany", "CareOptions", "WellnessProgram", "AwarenessLevel", "KnowledgeLevel", "ComfortLevel", "ManagerSupport"]
HEALTH_SYSTEM = "MentalHealth_Staging"
WORKPLACE_SYSTEM = "MentalHealthWorkPlace_Staging"
LONGITUDINAL_SYSTEM = "AI_Staging"
HEALTH_SUPPLIES = ["Gender", "AgeGroup", "Education", "IncomeLevel", "State", "GeneralHealthStatus", "CheckUpStatus", "SmokingStatus", "ExerciseStatus"]
WORKPLACE_SUPPLIES = ["Gender", "FamilyHistory", "Country", "State", "WorkInterference", "RemoteWork", "Benefits", "SeekHelp", "Treatment",
                      "NumEmployees", "TechCompany", "CareOptions", "WellnessProgram"]
LONGITUDINAL_LACKS = ["CheckUpStatus"]
HEALTH_COUNTRY = "United States"
# ---------------------------------------------------------------------------

DAYS = "MentalHealthDays"
INTEGRATED: Target = [("SourceSystem", "string"), ("SourcePersonID", "int"), ("FullDate", "date"),
                      *[(a, "int" if a == DAYS else "string") for a in ATTRIBUTES]]


def _supplied(names: list[str]) -> dict[str, Column]:
    return {a: not_found_default(a) for a in names}


def _days() -> Column:
    return range_guard(try_int(DAYS), 0, 30)


def health_layout() -> Layout:
    """Health survey: a date of digits, one country, no person."""
    columns = _supplied(HEALTH_SUPPLIES) | {"FullDate": date_from_digits("Date"), "Country": F.lit(HEALTH_COUNTRY), DAYS: _days()}
    return Layout(HEALTH_SYSTEM, columns, [iso_date_text("FullDate"), *ATTRIBUTES], NOT_FOUND)


def workplace_layout() -> Layout:
    """Workplace survey: neither person nor date (an empty slot), an age that becomes a band."""
    columns = _supplied(WORKPLACE_SUPPLIES) | {"AgeGroup": band("Age")}
    return Layout(WORKPLACE_SYSTEM, columns, [F.lit(""), *ATTRIBUTES], NOT_FOUND)


def longitudinal_layout() -> Layout:
    """Longitudinal file: persons and dates as they are."""
    columns = _supplied([a for a in ATTRIBUTES if a != DAYS and a not in LONGITUDINAL_LACKS])
    columns |= {"SourcePersonID": F.col("SourcePersonID"), "FullDate": F.col("FullDate"), DAYS: _days()}
    return Layout(LONGITUDINAL_SYSTEM, columns, ["SourcePersonID", iso_date_text("FullDate"), *ATTRIBUTES], NOT_FOUND)
