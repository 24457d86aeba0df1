"""Resolution of all attributes, and of countries and states by priority."""

import pytest
from pyspark.sql import functions as F

from starloom.functions.text import normalize_country, normalize_text, normalized, normalized_country
from starloom.operators import resolution
from starloom.operators.hierarchy import Hierarchy, resolve_hierarchy
from starloom.operators.lookups import DuplicateMapKey
from starloom.plans import QUERIES, load_all
from starloom.sources import catalogue
from starloom.sources.tables import read_table, spread
from tests.conftest import SMALL

# domain -> (master rows, map rows)
SIZES = {
    "Gender": (3, 8), "AgeGroup": (7, 22), "Education": (9, 9), "IncomeLevel": (15, 15), "GeneralHealthStatus": (9, 14), "SmokingStatus": (9, 20),
    "ExerciseStatus": (9, 18), "CheckUpStatus": (9, 14), "FamilyHistory": (3, 10), "WorkInterference": (5, 6), "RemoteWork": (3, 10), "Benefits": (4, 11),
    "SeekHelp": (4, 11), "Treatment": (3, 10), "NumEmployees": (5, 11), "TechCompany": (3, 10), "CareOptions": (4, 9), "WellnessProgram": (4, 9),
    "AwarenessLevel": (4, 5), "KnowledgeLevel": (4, 5), "ComfortLevel": (4, 5), "ManagerSupport": (4, 5),
}
# domain -> raw value, label: a code as a float, a noisy spelling, something unknown, a blank
CASES = {
    "Gender": [("1.0", "Male"), (" female ", "Female"), ("x", "Not Found"), (None, "Not Found")],
    "AgeGroup": [("3.0", "35-44"), ("age 65 or OLDER", "65+"), ("17", "Not Found"), ("", "Not Found")],
    "Education": [("6", "College 4 years or more (College graduate)"), ("Refused", "Refused"), (" PhD ", "PhD"), (None, "Not asked or Missing")],
    "IncomeLevel": [("77.0", "Dont know/Not sure"), ("11", "$200,000 or more"), ("lots", "lots"), (" ", "Not asked or Missing")],
    "GeneralHealthStatus": [("2.0", "Very good"), ("very  good.", "Very good"), ("8", "Not Found"), ("blank", "Not asked or Missing")],
    "SmokingStatus": [("9", "Refused"), ("Ex-Smoker", "Former Smoker"), ("AI1", "Not Found"), (None, "Not asked or Missing")],
    "ExerciseStatus": [("2", "No"), ("sedentary", "Inactive"), ("0", "Not Found"), ("", "Not asked or Missing")],
    "CheckUpStatus": [("8.0", "Never"), ("5 OR MORE YEARS AGO;", "5 or more years ago"), ("10", "Not Found"), (None, "Not asked or Missing")],
    "FamilyHistory": [("TRUE", "Yes"), ("0", "No"), ("1.0", "Not Found"), (None, "Not Found")],
    "WorkInterference": [("often", "Often"), ("always", "Not Found")],
    "RemoteWork": [("y", "Yes"), ("maybe", "Not Found")],
    "Benefits": [("don’t know", "Dont know"), ("Not sure", "Dont know"), ("true", "Not Found")],
    "SeekHelp": [("Don`t know", "Dont know"), ("n", "No")],
    "Treatment": [("1", "Yes"), ("No", "No"), ("?", "Not Found")],
    "NumEmployees": [("6 to 25", "6-25"), ("1000+", "More than 1000"), ("1-5", "Not Found")],
    "TechCompany": [("false", "No"), ("", "Not Found")],
    "CareOptions": [("unsure", "Not sure"), ("1", "Not Found")],
    "WellnessProgram": [("Not sure", "Dont know"), ("0", "Not Found")],
    "AwarenessLevel": [("HIGH", "High"), ("higher", "Not Found")],
    "KnowledgeLevel": [(" medium", "Medium"), (None, "Not Found")],
    "ComfortLevel": [("low.", "Low"), ("", "Not Found")],
    "ManagerSupport": [("Low", "Low"), ("Yes", "Not Found")],
}


def test_constants_are_normalised_as_columns_are(spark):
    texts = [r for d in catalogue.DOMAINS for r, _ in d.raw_values] + [r for r, _ in catalogue.country_raw()] + [
        None, "  \t a  b \n", "a" + " " * 17 + "b", "U.S.A.", "(x) [y]: \"z\";", "l’a `b`", "..", "école"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", normalize_text("t").alias("n"), normalize_country("t").alias("c")).collect()
    assert [(r.n, r.c) for r in rows] == [(normalized(r.t), normalized_country(r.t)) for r in rows]


def test_masters_and_maps_have_the_expected_rows_and_unique_keys(spark):
    masters = {r.domain: r["count"] for r in resolution.lookup_masters(spark).groupBy("domain").count().collect()}
    maps = resolution.lookup_maps(spark)
    counts = {r.domain: r["count"] for r in maps.groupBy("domain").count().collect()}
    assert {d: (masters[d], counts[d]) for d in masters} == SIZES
    assert maps.groupBy("domain", "raw_key").count().filter("count > 1").count() == 0
    assert len(catalogue.state_rows()) == 57 and len(catalogue.country_rows()) == 4
    assert len({normalized_country(r) for r, _ in catalogue.country_raw()}) == 5


@pytest.fixture(scope="module")
def resolved(spark):
    """Every case of every attribute, in one table: row k holds each attribute's case k."""
    longest = max(map(len, CASES.values()))
    names = list(CASES)
    rows = [(k, *[CASES[n][k % len(CASES[n])][0] for n in names], None, None, None) for k in range(longest)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"{n} string" for n in [*names, "Country", "State", "MentalHealthDays"]))
    return {r.k: r for r in resolution.resolve_all(df).collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_attribute(resolved, name):
    assert [resolved[k][name] for k in range(len(CASES[name]))] == [label for _, label in CASES[name]]


def test_flag_days_and_places(spark):
    names = list(CASES)
    rows = [("1", "U.S.", "6.0", "30"), ("no", "Canada", "Texas", "31"), ("?", "France", "IL", "88"), (None, None, "78", "5.0"), ("Y", "usa", "Ontario", None)]
    df = spark.createDataFrame([(*[None] * len(names), *r) for r in rows], ", ".join(f"{n} string" for n in [*names, "t", "Country", "State", "MentalHealthDays"]))
    got = resolution.resolve_all(df, {"Treatment": "t"}).collect()
    assert [(r.TreatmentFlag, r.Country, r.State, r.MentalHealthDays) for r in got] == [
        (1, "United States", "California", 30), (0, "Canada", "Not Found", None), (0, "United States", "IL", None),
        # a blank country is 'Not Found' by its spelling, before the state is asked
        (0, "Not Found", "Not Found", None), (1, "United States", "Not Found", None)]
    assert got[1].StateID == 1 and got[1].CountryID == 3  # the Not-Found state belongs to the Not-Found country


def test_no_join_and_no_shuffle_for_any_number_of_attributes(spark):
    df = spark.createDataFrame([], ", ".join(f"{n} string" for n in [*CASES, "Country", "State", "MentalHealthDays"]))
    plan = resolution.resolve_all(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_rows_of_one_file_are_dealt_out_before_they_are_resolved(spark):
    load_all()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert read_table(spark, SMALL, "part").rdd.getNumPartitions() < n
    sizes = QUERIES["resolve_all"](spark, SMALL).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) >= n and max(sizes) < 2 * sum(sizes) / n
    many = spark.range(0, 40, 1, n + 3)
    assert spread(many) is many


def test_blank_text_has_the_label_of_blank_where_there_is_one(spark):
    df = spark.createDataFrame([(t,) for t in ("blank", "", " \t. ", None, "A", "?")], "t string")
    some, none = catalogue.Domain("some", ["A", "B"], {"A": ["a"]}, blank="B"), catalogue.Domain("none", ["A"], {"A": ["a"]})
    got = df.select(resolution.label_of(some, "t").alias("some"), resolution.label_of(none, "t").alias("none")).collect()
    assert [tuple(r) for r in got] == [("B", "Not Found")] * 4 + [("A", "A"), ("Not Found", "Not Found")]


def test_two_values_for_one_spelling_are_an_error(spark):
    bad = catalogue.Domain("bad", ["A", "B"], {"A": ["x"], "B": [" X. "]})
    with pytest.raises(DuplicateMapKey):
        resolution.label_of(bad, F.lit("x"))


def test_relations_and_constants_choose_alike(spark):
    countries, states = ["United States", "USA", "Canada", "Narnia", "", None, "england"], ["25", "4.0", "TX", "Tennessee", "NY", "zz", None, "99"]
    df = spark.createDataFrame([(a, b) for a in countries for b in states], "c string, s string")
    by_join = resolve_hierarchy(df, resolution.survey_hierarchy(spark), "c", "s", ("country", "state")).collect()
    by_map = resolution.with_location(df, "c", "s").select("row.*", "parent", "parent_way", "child", "child_way").collect()
    assert sorted(((r.c, r.s, r.country_id, r.country_way, r.state_id, r.state_way) for r in by_join), key=str) == \
        sorted(((r.c, r.s, r.parent.parent_id, r.parent_way, r.child.child_id, r.child_way) for r in by_map), key=str)


@pytest.fixture(scope="module")
def places(spark):
    """Two countries with a 'Springfield' each; only the second has a Not-Found place of its own."""
    return Hierarchy(
        spark.createDataFrame([(1, "Not Found"), (2, "Ardia"), (3, "Bern")], "id int, name string"),
        spark.createDataFrame([(10, None, "Not Found", 1), (20, "7", "Springfield", 2), (21, "8", "Alba", 2), (30, "9", "Springfield", 3),
                               (31, None, "Not Found", 3), (32, None, "Bora", 3)], "id int, code string, name string, parent_id int"),
        spark.createDataFrame([("ardia", 2), ("Land of B", 3)], "raw string, id int"),
        spark.createDataFrame([("springfield", 20), ("SPRINGFIELD.", 30), ("alba", 21), ("bora", 32)], "raw string, id int"))


@pytest.mark.parametrize("country, state, want", [
    ("Ardia", "9", ("Ardia", 1, 10, 4)),             # exact name; the coded place is elsewhere, Ardia has no unknown place
    ("land of b.", "9.0", ("Bern", 2, 30, 1)),       # spelling; code inside
    (None, "8", ("Ardia", 3, 21, 1)),                # the code's country
    ("", " Bora ", ("Bern", 4, 32, 2)),              # the spelled place's country
    ("?", "?", ("Not Found", 5, 10, 3)),             # nothing; the unknown country's own unknown place
    ("Bern", "springfield", ("Bern", 1, 30, 2)),     # a shared name goes to the resolved country
    ("Ardia", "springfield", ("Ardia", 1, 20, 2)),
    ("?", "Springfield", ("Ardia", 4, 20, 2)),       # without a country, the smallest id
    ("Bern", "Alba", ("Bern", 1, 31, 3)),            # a place of another country: Bern's own unknown place
    ("Bern", None, ("Bern", 1, 31, 3)),
])
def test_each_way(spark, places, country, state, want):
    df = spark.createDataFrame([(country, state, 5), (country, state, 6)], "c string, s string, row int")
    got = resolve_hierarchy(df, places, "c", "s").collect()
    assert [(r.parent_name, r.parent_way, r.child_id, r.child_way) for r in got] == [want, want]
    assert sorted(r.row for r in got) == [5, 6]
