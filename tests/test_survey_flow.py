"""End-to-end composition on invented longitudinal rows: staging -> value
resolution -> SCD-2 person versions -> date dimension -> monthly fact ->
person-weighted monthly report."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starloom.functions import decimal_avg, weighted_avg
from starloom.operators.dims import dim_date
from starloom.operators.joins import period_start_join
from starloom.operators.lookups import Resolution, assert_unique, build_map, resolve, seed_frame
from starloom.operators.scd import scd2_versions
from starloom.sources.survey import stage_longitudinal

# person, month, remote work, benefits, mental health days
ROWS = [
    ("1", "1", "Yes", "Yes", "4"), ("1", "4", "Yes", "Yes", "6"), ("1", "7", "yes", "Yes", "8"), ("1", "10", "Y", "Yes", ""),
    ("2", "1", "No", "No", "10"), ("2", "4", "No", "No", "12"), ("2", "7", "Yes", "Yes", "2"), ("2", "10", "Yes", "Yes", "3"),
    ("3", "1", "no", "Dont know", "0"), ("3", "4", "N", "Dont know", "1"), ("3", "7", "false", "Dont know", "1"),
    ("3", "10", "No", "Dont know", "2"),
]


def test_longitudinal_flow(spark):
    raw = spark.createDataFrame([(p, "2024", m, r, b, d) for p, m, r, b, d in ROWS],
                                "SourcePersonID string, Year string, Month string, RemoteWork string, "
                                "Benefits string, MentalHealthDays string")
    staged = stage_longitudinal(raw)

    yes_no_master = seed_frame(spark, [(0, "Not Found"), (1, "Yes"), (2, "No")], "id int, value string")
    benefits_master = seed_frame(spark, [(0, "Not Found"), (1, "Yes"), (2, "No"), (3, "Dont know")],
                                 "id int, value string")

    def label_map(master, extra=()):
        seed = master.select(F.col("value").alias("raw"), F.col("value").alias("final"))
        if extra:
            seed = seed.unionByName(seed_frame(spark, list(extra), "raw string, final string"))
        return assert_unique(build_map(seed, "raw", "final", master, "value", "id"), ["raw_key"])

    resolved = resolve(staged, [
        Resolution("RemoteWork", "remote_work", text_map=label_map(yes_no_master)),
        Resolution("Benefits", "benefits", text_map=label_map(benefits_master, [("Don't know", "Dont know")])),
    ])
    assert resolved.filter(F.col("remote_work") == "Not Found").count() == 0

    versions = scd2_versions(resolved.select(F.col("SourcePersonID").alias("person"), "FullDate",
                                             "remote_work", "benefits"),
                             "person", "FullDate", ["remote_work", "benefits"])
    per_person = {r.person: r.n for r in versions.groupBy("person").agg(F.count("*").alias("n")).collect()}
    assert per_person == {1: 1, 2: 2, 3: 1}
    p2 = versions.filter("person = 2").orderBy("start_date").collect()
    assert (p2[0].end_date, p2[1].start_date, p2[1].is_current) == (dt.date(2024, 6, 30), dt.date(2024, 7, 1), True)

    dd = dim_date(resolved, "FullDate")
    assert dd.count() == 4
    monthly = (period_start_join(resolved, dd, "FullDate", "month", "month_key")
               .groupBy("remote_work", "month_key")
               .agg(F.countDistinct("SourcePersonID").alias("persons"),
                    decimal_avg("MentalHealthDays").alias("avg_days")))
    report = (monthly.groupBy("month_key")
              .agg(F.sum("persons").alias("persons"), weighted_avg("avg_days", "persons").alias("avg_days")))
    got = {r.month_key: (r.persons, r.avg_days) for r in report.collect()}
    # month 10: person 1 has no day count, so the remote group's average is 3.00 over the one
    # known value, yet the group still weighs 2 persons: (3.00 * 2 + 2.00 * 1) / 3 = 2.67
    assert got == {20240101: (3, Decimal("4.67")), 20240401: (3, Decimal("6.33")),
                   20240701: (3, Decimal("3.67")), 20241001: (3, Decimal("2.67"))}
