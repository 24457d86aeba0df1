"""Seeds of the survey warehouse's lookups: what each attribute's raw codes and spellings stand for.

A domain's standard labels get ids from 1 in the order given.  Its map holds
its numeric codes and its ``BLANK`` code, the spellings listed, and 'Not
Found'; a blank raw value stands for the label ``blank``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from starloom.functions.text import BLANK, NOT_FOUND


@dataclass(frozen=True)
class Domain:
    """One attribute: its labels, the codes that name them and the spellings that name them."""

    name: str
    labels: Sequence[str]
    spellings: Mapping[str, Sequence[str]]
    codes: Mapping[str, str] = field(default_factory=dict)
    blank: str = NOT_FOUND
    keep_raw: bool = False

    @property
    def masters(self) -> list[tuple[int, str | None, str]]:
        """Id, code and label of every standard value, 'Not Found' first."""
        code_of = {label: code for code, label in self.codes.items()}
        return [(i + 1, code_of.get(x), x) for i, x in enumerate([NOT_FOUND, *self.labels])]

    @property
    def raw_values(self) -> list[tuple[str, str]]:
        """Raw value and label of every entry of the map, before normalisation."""
        coded = [(c, x) for c, x in self.codes.items() if c.isdigit() or c == BLANK]
        spelled = [(raw, x) for x, raws in self.spellings.items() for raw in raws]
        return [*coded, *spelled, ("", self.blank), (NOT_FOUND, NOT_FOUND)]


# ---------------------------------------------------------------------------
# Codes, labels and spellings of the survey's attributes.
# ---------------------------------------------------------------------------
MISSING = "Not asked or Missing"
UNSURE = "Dont know/Not sure"
REFUSED = "Refused"

YES = {"Yes": ["Yes", "Y", "1", "true"], "No": ["No", "N", "0", "false"]}
YES_UNSURE = {"Yes": ["Yes", "Y", "1"], "No": ["No", "N", "0"], "Dont know": ["Dont know", "Don't know", "Not sure"]}
LEVELS = {"High": ["High"], "Medium": ["Medium"], "Low": ["Low"]}

GENDER = {"1": "Male", "2": "Female"}
AGE_GROUP = {"1": "18-24", "2": "25-34", "3": "35-44", "4": "45-54", "5": "55-64", "6": "65+"}
EDUCATION = {
    "1": "Never attended school or only kindergarten",
    "2": "Grades 1 through 8 (Elementary)",
    "3": "Grades 9 through 11 (Some high school)",
    "4": "Grade 12 or GED (High school graduate)",
    "5": "College 1 year to 3 years (Some college or technical school)",
    "6": "College 4 years or more (College graduate)",
    "9": REFUSED,
    BLANK: MISSING,
}
INCOME_LEVEL = {
    "1": "Less than $10,000",
    "2": "Less than $15,000 ($10,000 to < $15,000)",
    "3": "Less than $20,000 ($15,000 to < $20,000)",
    "4": "Less than $25,000 ($20,000 to < $25,000)",
    "5": "Less than $35,000 ($25,000 to < $35,000)",
    "6": "Less than $50,000 ($35,000 to < $50,000)",
    "7": "Less than $75,000 ($50,000 to < $75,000)",
    "8": "Less than $100,000 ($75,000 to < $100,000)",
    "9": "Less than $150,000 ($100,000 to < $150,000)",
    "10": "Less than $200,000 ($150,000 to < $200,000)",
    "11": "$200,000 or more",
    "77": UNSURE,
    "99": REFUSED,
    BLANK: MISSING,
}
GENERAL_HEALTH = {"1": "Excellent", "2": "Very good", "3": "Good", "4": "Fair", "5": "Poor", "7": UNSURE, "9": REFUSED, BLANK: MISSING}
SMOKING = {"1": "Yes", "2": "No", "7": UNSURE, "9": REFUSED, BLANK: MISSING, "AI1": "Smoker", "AI2": "Former Smoker", "AI3": "Non-Smoker"}
EXERCISE = {"1": "Yes", "2": "No", "7": UNSURE, "9": REFUSED, BLANK: MISSING, "AI1": "Active", "AI2": "Moderate", "AI3": "Inactive"}
CHECK_UP = {"1": "Within past year", "2": "Within past 2 years", "3": "Within past 5 years", "4": "5 or more years ago",
            "7": UNSURE, "8": "Never", "9": REFUSED, BLANK: MISSING}

DOMAINS = [
    Domain("Gender", list(GENDER.values()), {"Male": ["M", "Male"], "Female": ["F", "Female"]}, GENDER),
    Domain("AgeGroup", list(AGE_GROUP.values()), {
        "18-24": ["18-24", "Age 18 to 24"], "25-34": ["25-34", "Age 25 to 34"], "35-44": ["35-44", "Age 35 to 44"],
        "45-54": ["45-54", "Age 45 to 54"], "55-64": ["55-64", "Age 55 to 64"],
        "65+": ["65+", "65 or older", "65 and over", "Age 65 or older"]}, AGE_GROUP),
    Domain("Education", list(EDUCATION.values()), {}, EDUCATION, blank=MISSING, keep_raw=True),
    Domain("IncomeLevel", list(INCOME_LEVEL.values()), {}, INCOME_LEVEL, blank=MISSING, keep_raw=True),
    Domain("GeneralHealthStatus", list(GENERAL_HEALTH.values()), {
        "Excellent": ["Excellent"], "Very good": ["Very good"], "Good": ["Good"], "Fair": ["Fair"], "Poor": ["Poor"]}, GENERAL_HEALTH, blank=MISSING),
    Domain("SmokingStatus", list(SMOKING.values()), {
        "Yes": ["Yes", "Y", "true"], "No": ["No", "N", "false"], "Smoker": ["Smoker"],
        "Former Smoker": ["Former Smoker", "Ex-smoker", "Ex smoker"],
        "Non-Smoker": ["Non-Smoker", "Non Smoker", "Nonsmoker", "Never Smoked"]}, SMOKING, blank=MISSING),
    Domain("ExerciseStatus", list(EXERCISE.values()), {
        "Yes": ["Yes", "Y", "true"], "No": ["No", "N", "false"], "Active": ["Active"],
        "Moderate": ["Moderate", "Moderately Active"], "Inactive": ["Inactive", "Not Active", "Sedentary"]}, EXERCISE, blank=MISSING),
    Domain("CheckUpStatus", list(CHECK_UP.values()), {
        "Within past year": ["Within past year", "Within past year anytime less than 12 months ago"],
        "Within past 2 years": ["Within past 2 years"], "Within past 5 years": ["Within past 5 years"],
        "5 or more years ago": ["5 or more years ago"]}, CHECK_UP, blank=MISSING),
    Domain("FamilyHistory", ["Yes", "No"], YES),
    Domain("WorkInterference", ["Often", "Sometimes", "Rarely", "Never"], {
        "Often": ["Often"], "Sometimes": ["Sometimes"], "Rarely": ["Rarely"], "Never": ["Never"]}),
    Domain("RemoteWork", ["Yes", "No"], YES),
    Domain("Benefits", ["Yes", "No", "Dont know"], YES_UNSURE),
    Domain("SeekHelp", ["Yes", "No", "Dont know"], YES_UNSURE),
    Domain("Treatment", ["Yes", "No"], YES),
    Domain("NumEmployees", ["6-25", "26-100", "100-500", "More than 1000"], {
        "6-25": ["6-25", "6 to 25"], "26-100": ["26-100", "26 to 100"], "100-500": ["100-500", "100 to 500"],
        "More than 1000": ["More than 1000", "1000+", "Over 1000"]}),
    Domain("TechCompany", ["Yes", "No"], YES),
    Domain("CareOptions", ["Yes", "No", "Not sure"], {"Yes": ["Yes", "Y"], "No": ["No", "N"], "Not sure": ["Not sure", "Unsure", "Don't know"]}),
    Domain("WellnessProgram", ["Yes", "No", "Dont know"], {"Yes": ["Yes", "Y"], "No": ["No", "N"], "Dont know": ["Dont know", "Don't know", "Not sure"]}),
    *[Domain(name, list(LEVELS), LEVELS) for name in ("AwarenessLevel", "KnowledgeLevel", "ComfortLevel", "ManagerSupport")],
]

COUNTRIES = ["Not Found", "United States", "Canada", "United Kingdom"]
COUNTRY_SPELLINGS = {
    "United States": ["United States", "USA", "US", "U.S.A.", "U.S.", "America"],
    "Canada": ["Canada"],
    "United Kingdom": ["United Kingdom", "UK", "England", "Great Britain"],
    "Not Found": ["Not Found", ""],
}
STATES = {
    1: "Alabama", 2: "Alaska", 4: "Arizona", 5: "Arkansas", 6: "California", 8: "Colorado", 9: "Connecticut", 10: "Delaware",
    11: "District of Columbia", 12: "Florida", 13: "Georgia", 15: "Hawaii", 16: "Idaho", 17: "Illinois", 18: "Indiana", 19: "Iowa",
    20: "Kansas", 21: "Kentucky", 22: "Louisiana", 23: "Maine", 24: "Maryland", 25: "Massachusetts", 26: "Michigan", 27: "Minnesota",
    28: "Mississippi", 29: "Missouri", 30: "Montana", 31: "Nebraska", 32: "Nevada", 33: "New Hampshire", 34: "New Jersey",
    35: "New Mexico", 36: "New York", 37: "North Carolina", 38: "North Dakota", 39: "Ohio", 40: "Oklahoma", 41: "Oregon",
    42: "Pennsylvania", 44: "Rhode Island", 45: "South Carolina", 46: "South Dakota", 48: "Texas", 49: "Utah", 50: "Vermont",
    51: "Virginia", 53: "Washington", 54: "West Virginia", 55: "Wisconsin", 56: "Wyoming", 66: "Guam", 72: "Puerto Rico", 78: "Virgin Islands",
}
STATES_WITHOUT_CODE = ["IL", "TN", "TX"]
STATE_COUNTRY = "United States"
STATE_SPELLINGS = {
    "Illinois": ["Illinois"], "IL": ["IL"], "Tennessee": ["Tennessee"], "TN": ["TN"], "Texas": ["Texas"], "TX": ["TX"],
    "California": ["California", "CA"], "New York": ["New York", "NY"], "Connecticut": ["Connecticut", "CT"],
    "Massachusetts": ["Massachusetts", "MA"],
}
# ---------------------------------------------------------------------------

BY_NAME = {d.name: d for d in DOMAINS}


def country_rows() -> list[tuple[int, str]]:
    """Id and name of every country."""
    return [(i + 1, name) for i, name in enumerate(COUNTRIES)]


def state_rows() -> list[tuple[int, str | None, str, int]]:
    """Id, code, name and country id of every state, the Not-Found one first."""
    country = dict((name, i) for i, name in country_rows())
    named = [(None, NOT_FOUND, NOT_FOUND)]
    named += [(str(code), name, STATE_COUNTRY) for code, name in STATES.items()]
    named += [(None, name, STATE_COUNTRY) for name in STATES_WITHOUT_CODE]
    return [(i + 1, code, name, country[c]) for i, (code, name, c) in enumerate(named)]


def country_raw() -> list[tuple[str, int]]:
    """Raw spelling and country id."""
    ids = dict((name, i) for i, name in country_rows())
    return [(raw, ids[name]) for name, raws in COUNTRY_SPELLINGS.items() for raw in raws]


def state_raw() -> list[tuple[str, int]]:
    """Raw spelling and state id; a spelling of a state without a master row ('Tennessee') has no entry, as in an inner join."""
    ids = {name: i for i, _, name, _ in state_rows()}
    return [(raw, ids[name]) for name, raws in STATE_SPELLINGS.items() if name in ids for raw in raws] + [("", ids[NOT_FOUND]), (NOT_FOUND, ids[NOT_FOUND])]
