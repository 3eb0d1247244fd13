"""Share of planned staff that did not come."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callops import schema
from callops.functions.numbers import percent
from callops.plans.shifts import attended, planned_shifts


def shrinkage_report(roster: DataFrame, logins: DataFrame) -> DataFrame:
    present = attended(planned_shifts(roster), logins)
    planned, came = F.count(F.lit(1)), F.count("first_login_date")
    return present.groupBy("date").agg(
        planned.alias("planned"), percent(planned - came, planned).alias("shrinkage_per"),
    ).select(*schema.SHRINKAGE_REPORT)
