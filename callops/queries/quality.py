"""Quality audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from callops import schema
from callops.operators.windows import quartile_category
from callops.plans import quality as plan
from callops.plans.people import with_leader_names
from callops.plans.star import Star
from callops.queries.registry import query
from callops.queries.sql import column_list, with_views


@query(with_views(f"""
    , pkt AS (SELECT o_custkey::varchar AS id, o_orderdate::date AS d, max(floor(o_totalprice)) AS score
              FROM orders GROUP BY 1, 2),
    tni AS (SELECT l_suppkey::varchar AS id, l_shipdate::date AS d, max(l_quantity) AS score
            FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
    bq AS (SELECT l_suppkey::varchar AS id, l_shipdate::date AS d, max(round(l_tax * 100)) AS score
           FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
    SELECT {column_list([c for c in schema.QUALITY_REPORT[:-10]], 'a.')}, s.role_fit,
           pkt.score::double AS pkt_scores, s.manager, s.sr__manager, s.grid,
           tni.score::double AS tni_assessment_score, bq.score::double AS bq_scores, s.team_lead, s.team_lead_name,
           s.manager_name
    FROM audits a
    ASOF LEFT JOIN pkt ON pkt.id = a.emp_id AND pkt.d <= a.date
    ASOF LEFT JOIN tni ON tni.id = a.emp_id AND tni.d <= a.date
    ASOF LEFT JOIN bq ON bq.id = a.emp_id AND bq.d <= a.date
    LEFT JOIN staff s ON s.employeeid = a.emp_id""", "audits", "staff"))
def quality_report(star: Star):
    return plan.quality_report(
        star.quality(), star.knowledge(), star.training(), star.refresher(), with_leader_names(star.employees()))


@query(with_views("""
    , months AS (SELECT date_trunc('month', date)::date AS month, emp_id, count(*) AS audits,
                        sum(overall_score)::double / count(*) AS m
                 FROM audits GROUP BY 1, 2)
    SELECT month, emp_id, audits, 'ABCD'[((rank() OVER (PARTITION BY month ORDER BY m DESC) - 1) * 4
                       // count(*) OVER (PARTITION BY month)) + 1] AS categorie
    FROM months""", "audits"))
def quality_category(star: Star):
    """Monthly A–D letter of each audited agent by mean score."""
    months = star.quality().groupBy(F.trunc("date", "MM").alias("month"), F.col("agent_id").alias("emp_id")).agg(
        F.count(F.lit(1)).alias("audits"),
        (F.sum("overall_score").cast("double") / F.count(F.lit(1))).alias("score"))
    return quartile_category(months, ["month"], "score").drop("score")
