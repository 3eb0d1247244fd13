"""Contact-centre views over a sales star schema with an event stream.

They let every operator run on whole tables of any size: events act as calls, logins, rosters and
agent days, orders as survey answers and score files, line items as quality audits, customers as
employees. All expressions are per row or plain aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callops import schema
from callops.operators.reshape import forecast_wide
from callops.operators.skew import lookup_join
from callops.plans.calls import CallRules

#: Event types as call outcomes.
RULES = CallRules(abandoned=("error",), outbound=("signup",))

#: Event types that take part in rosters and in logins; they overlap in part, so both planned
#: people without login and logins without plan exist.
ROSTER_EVENTS = ("click", "view", "error")
LOGIN_EVENTS = ("click", "purchase", "signup")


class Star:
    """The tables of one folder and the views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def calls(self) -> DataFrame:
        """Call export, staging columns."""
        customer = F.get_json_object("props", "$.k")
        user = F.col("user_id").cast("string")
        kind = F.col("event_type")
        columns = {
            "date": F.to_date("ts"),
            "user": user,
            "full_name": F.concat(F.lit("Agent "), user),
            "call_date": F.col("ts"),
            "status": kind,
            "campaign_id": F.when(kind == "signup", "OUTBOUND").otherwise("INBOUND"),
            "query_typelevel_1": F.when(F.col("value") >= 5, kind),
            "call_transferred_to_survey_ivr": F.when(kind == "purchase", "Yes").otherwise("No"),
            "emp_id": user,
            "phone_number": customer,
            "cust_talk_sec": F.round(F.col("value") * 100).cast("bigint"),
            "customer_hold_time": F.minute("ts").cast("bigint"),
            "wrap_up_time": F.second("ts").cast("bigint"),
            "queue_seconds": F.floor("value"),
            "query_type_level_2": F.col("props"),
            "subquery_type_level_2": F.when(F.col("value") >= 100, "long"),
            "lead_id": F.col("event_id").cast("string"),
            "customer_number": customer,
        }
        return self.table("events").select(*[columns[c].alias(c) for c in schema.EXPORT_CALL_STAGING])

    def agent_days(self) -> DataFrame:
        """Agent feed in seconds: event values summed per type, breaks split by time of day."""
        seconds = F.round(F.col("value") * 100).cast("bigint")
        hour = F.hour("ts")

        def total(*conditions):
            condition = conditions[0]
            for c in conditions[1:]:
                condition = condition & c
            return F.coalesce(F.sum(F.when(condition, seconds)), F.lit(0))

        kind = F.col("event_type")
        user = F.col("user_id").cast("string")
        return self.table("events").groupBy(F.to_date("ts").alias("date"), user.alias("agent_id")).agg(
            F.count(F.lit(1)).alias("call_attended"),
            F.sum(seconds).alias("login_duration"),
            total(kind == "click").alias("total_talk_time"),
            total(kind == "error").alias("total_break"),
            total(kind == "purchase").alias("total_wrap_time"),
            total(kind == "view").alias("total_hold_time"),
            total(kind == "error", hour < 12).alias("bio"),
            total(kind == "error", hour.between(12, 14)).alias("lunch"),
            total(kind == "error", hour >= 15).alias("tea"),
            total(kind == "signup").alias("total_idle_time"),
        ).withColumns({
            "emp_name": F.concat(F.lit("Agent "), "agent_id"), "emp_id": F.col("agent_id"),
        }).select(*schema.AGENT_STAGING)

    def surveys_raw(self) -> DataFrame:
        """Survey feed with the answer inside a bracketed list."""
        digit = F.when(F.col("o_orderstatus") == "P", "x").otherwise(F.substring("o_orderpriority", 1, 1))
        customer = F.col("o_custkey").cast("string")
        return self.table("orders").select(
            F.to_date("o_orderdate").alias("date"),
            customer.alias("user_id"),
            F.col("o_orderdate").alias("call_date"),
            customer.alias("phone_number"),
            F.concat(F.lit("["), "o_orderstatus", F.lit(", "), digit, F.lit(", 9z]")).alias("ivr_flow"),
            F.concat(F.lit("customer "), customer).alias("user_full_name"),
            F.col("o_orderkey").cast("string").alias("lead_id"),
        )

    def contacts(self) -> DataFrame:
        """Orders as contacts of a customer."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("contact_id"), F.col("o_custkey").alias("customer_number"),
            F.to_date("o_orderdate").alias("date"))

    def orders_by_customer(self) -> DataFrame:
        """Orders with their customer's nation and segment; one customer may hold most orders."""
        customers = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", F.lit(True).alias("_known"))
        joined = lookup_join(self.table("orders"), customers, ["o_custkey"], ["o_orderkey"])
        return joined.where("_known").drop("_known")

    def csat_scores(self) -> DataFrame:
        """Score file: the customer's market segment acts as the agent."""
        rating = F.when(F.col("o_orderstatus") == "P", "NoResponse").otherwise(F.substring("o_orderpriority", 1, 1))
        nation = F.col("c_nationkey").cast("string")
        return (
            self.orders_by_customer()
            .select(
                F.to_date("o_orderdate").alias("date"),
                nation.alias("user_id"),
                F.col("c_mktsegment").alias("emp_code"),
                F.lower("c_mktsegment").alias("agentname"),
                F.lit("INBOUND").alias("campaign_id"),
                rating.alias("survey_rating"),
                F.col("o_orderpriority").alias("category"),
                F.lit(1).alias("surveycount"),
                nation.alias("tl"),
                F.lit(None).cast("string").alias("tenure"),
                F.weekofyear("o_orderdate").alias("week"),
            )
        )

    def ftr_ivr(self) -> DataFrame:
        """Resolution file of the same agents."""
        status = F.col("o_orderstatus")
        return (
            self.orders_by_customer()
            .select(
                F.to_date("o_orderdate").alias("date"),
                F.lower("c_mktsegment").alias("full_name"),
                status.alias("status"),
                F.when(status == "O", "Yes").otherwise("No").alias("call_transferred_to_survey_ivr"),
                F.when(status == "F", 1).otherwise(0).alias("ftr"),
                F.when(status == "O", 1).otherwise(0).alias("survey_transfer"),
                F.col("c_nationkey").cast("string").alias("tl"),
                F.col("c_mktsegment").alias("emp_id"),
                F.col("o_custkey").cast("string").alias("user___sip_id"),
            )
        )

    def employees(self) -> DataFrame:
        """Customers as employees; the lowest customer ids are team leads and managers."""
        joined = self.table("orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("doj"))
        key = F.col("c_custkey").cast("string")
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .join(joined, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(
                F.col("c_custkey").alias("sl_no"),
                F.col("c_mktsegment").alias("lob"),
                key.alias("employeeid"),
                F.col("c_name").alias("employeename"),
                F.concat(F.lit("sip"), key).alias("sip"),
                F.when(F.col("c_acctbal") >= 0, "F").otherwise("M").alias("gender"),
                F.col("c_nationkey").cast("string").alias("team_lead"),
                "doj",
                F.lit("ACTIVE").alias("current_status"),
                F.col("c_mktsegment").alias("designation"),
                F.when(F.col("c_acctbal") >= 5000, "fit").otherwise("open").alias("role_fit"),
                F.col("n_name").alias("grid"),
                F.col("n_regionkey").cast("string").alias("manager"),
                F.col("r_name").alias("sr__manager"),
            )
        )

    def staff_snapshots(self) -> DataFrame:
        """Monthly snapshots of the customers that order in a month; the order tells lead and designation."""
        return self.table("orders").select(
            F.trunc("o_orderdate", "MM").alias("snapshot"), F.col("o_custkey").cast("string").alias("employeeid"),
            F.col("o_orderpriority").alias("team_lead"), F.col("o_orderstatus").alias("designation"))

    def sessions(self, kinds: tuple[str, ...], minutes: int) -> DataFrame:
        """Events of some kinds as spans that last ``minutes`` and a minute per whole unit of their value."""
        start = F.date_trunc("second", "ts")
        seconds = F.unix_timestamp(start) + 60 * (minutes + F.floor("value"))
        return self.table("events").where(F.col("event_type").isin(*kinds)).select(
            F.col("user_id").cast("string").alias("employeeid"), start.alias("start"), F.timestamp_seconds(seconds).alias("end"))

    def quality(self) -> DataFrame:
        """Line items as audits of the supplier as agent."""
        agent = F.col("l_suppkey").cast("string")
        score = F.lit(100) - F.round(F.col("l_discount") * 100).cast("int")
        returned = F.col("l_returnflag") == "R"
        marks = [
            F.when((F.col("l_linenumber") + i) % 4 == 0, "No").otherwise("Yes").alias(mark)
            for i, mark in enumerate(schema.QUALITY_MARKS)
        ]
        return self.table("lineitem").select(
            F.to_date("l_shipdate").alias("date"),
            F.concat(F.lit("agent "), agent).alias("agent_name"),
            agent.alias("agent_id"),
            F.col("l_shipdate").alias("call_date"),
            score.alias("overall_score"),
            F.lit(100).alias("scorable"),
            score.alias("scored"),
            F.when(returned, "Yes").otherwise("No").alias("fatal"),
            F.lit(None).cast("string").alias("tenure"),
            F.month("l_shipdate").alias("month"),
            F.weekofyear("l_shipdate").alias("week"),
            F.col("l_linestatus").alias("qa_name"),
            F.col("l_linenumber").cast("string").alias("tl_name"),
            F.when(returned, "returned").alias("fatal_reason"),
            *marks,
            F.col("l_quantity").cast("int").cast("string").alias("customer_number"),
        )

    def knowledge(self) -> DataFrame:
        return self.table("orders").select(
            F.to_date("o_orderdate").alias("date"), F.col("o_custkey").cast("string").alias("Emp_Code_"),
            F.concat(F.lit("employee "), F.col("o_custkey").cast("string")).alias("Employee_Name_"),
            F.floor("o_totalprice").alias("Assessment_Scores"))

    def training(self) -> DataFrame:
        return self.table("lineitem").where("l_returnflag = 'R'").select(
            F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").cast("string").alias("emp_id"),
            F.col("l_quantity").alias("same_day_assessment_score"))

    def refresher(self) -> DataFrame:
        return self.table("lineitem").where("l_linestatus = 'O'").select(
            F.to_date("l_shipdate").alias("date_of_refresher"), F.col("l_suppkey").cast("string").alias("emp_id"),
            F.round(F.col("l_tax") * 100).alias("assessment_scores"))

    def forecast(self) -> DataFrame:
        """Hourly forecast: the call counts of the same weekday a week earlier."""
        rows = self.table("events").groupBy(
            F.date_add(F.to_date("ts"), 7).alias("date"), F.hour("ts").alias("hour"),
        ).agg(F.count(F.lit(1)).alias("forecast"))
        return forecast_wide(rows)

    def roster(self) -> DataFrame:
        """Weekly roster: nine hours from the weekday's first hour of activity, else week off."""
        events = self.table("events").where(F.col("event_type").isin(*ROSTER_EVENTS)).select(
            F.col("user_id").cast("string").alias("employeeid"),
            F.date_trunc("week", "ts").cast("date").alias("date"),
            F.weekday("ts").alias("_d"), F.hour("ts").alias("_h"))
        first = events.groupBy("employeeid", "date").agg(
            *[F.min(F.when(F.col("_d") == i, F.col("_h"))).alias(d) for i, d in enumerate(schema.WEEKDAYS)])
        cells = {
            d: F.when(F.col(d).isNotNull(), F.format_string("%02d:00-%02d:00", d, (F.col(d) + 9) % 24)).otherwise("WO")
            for d in schema.WEEKDAYS
        }
        off = sum((F.when(F.col(d) == "WO", 1).otherwise(0) for d in schema.WEEKDAYS), F.lit(0))
        none = F.lit(None).cast("string")
        return first.withColumns(cells).withColumns({
            "employeename": F.concat(F.lit("Agent "), "employeeid"), "current_status": F.lit("ACTIVE"),
            "shift": none, "shifts_timings": F.lit("9h"), "wo": off, "ph": F.lit(0), "leaves": F.lit(0),
            "total_planned_": 7 - off, "team_lead": none,
        }).select(*schema.ROSTER)

    def logins(self) -> DataFrame:
        user = F.col("user_id").cast("string")
        return self.table("events").where(F.col("event_type").isin(*LOGIN_EVENTS)).groupBy(
            user.alias("user_id"), F.to_date("ts").alias("date"),
        ).agg(F.min("ts").alias("first_login_date"), F.max("ts").alias("last_logout_date")).withColumns({
            "user_name": F.concat(F.lit("Agent "), "user_id"), "campaign_id": F.lit("INBOUND"),
        }).select(*schema.LOGIN)

    def attrition(self) -> DataFrame:
        """Leavers' list with dates as text, some of them not dates."""
        customer = F.col("o_custkey").cast("string")
        none = F.lit(None).cast("string")
        left_on = F.when(F.col("o_orderstatus") == "P", "not yet").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd"))
        return (
            self.orders_by_customer()
            .select(
                customer.alias("employeeid"), F.concat(F.lit("employee "), customer).alias("employeename"),
                F.lit("supervisor").alias("supervisor"), none.alias("attrited_from_"), left_on.alias("date"),
                F.col("o_orderpriority").alias("attrition_type"), none.alias("reasons"), none.alias("category_"),
                none.alias("resons"), none.alias("ielevate_updated"), F.col("c_mktsegment").alias("lob"),
            )
        )

    # --- pairs of tables to compare -----------------------------------------------------------
    def landed(self) -> DataFrame:
        return self.table("orders").select(
            F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderkey").alias("id"))

    def staged(self) -> DataFrame:
        return self.landed().where("status <> 'P'")

    def shipped(self) -> DataFrame:
        return self.table("lineitem").select(
            F.to_date("l_shipdate").alias("date"), F.col("l_linestatus").alias("status"),
            F.col("l_orderkey").alias("id"))

    # --- raw texts ----------------------------------------------------------------------------
    def durations(self) -> DataFrame:
        """Durations whose minutes and seconds overflow, some of them unreadable."""
        parts = F.concat_ws(
            ":", F.hour("ts").cast("string"), F.get_json_object("props", "$.k"), F.floor("value").cast("string"))
        return self.table("events").select(
            "event_id", F.when(F.col("event_type") == "error", "n/a").otherwise(parts).alias("duration"))

    def notes(self) -> DataFrame:
        """Documents with apostrophes in place of é."""
        return self.table("documents").select(
            "doc_id", F.replace(F.col("text"), F.lit("é"), F.lit("'")).alias("text"), "source", "lang")

    # --- feeds -------------------------------------------------------------------------------
    def call_envelopes(self) -> DataFrame:
        """One envelope per event with one call object: mixed-case and unknown keys, a key twice."""
        person = F.when(F.col("event_type") == "purchase", "O'Neil").otherwise("Ann")
        body = F.format_string(
            '{"message": "Total 1 rows for lead %s", "data": [{"Lead_ID": "%s", "STATUS": "old", '
            '"status": "%s", "Cust_Talk_Sec": %s, "Full_Name": "%s \\"%s\\"", "colour": "red"}]}',
            F.col("event_id").cast("string"), F.col("event_id").cast("string"), "event_type",
            F.floor(F.col("value")).cast("string"), person, F.col("user_id").cast("string"))
        return self.table("events").select(F.to_date("ts").alias("date"), body.alias("body"))

    def survey_envelopes(self) -> DataFrame:
        """One envelope per order with one survey object."""
        name = F.when(F.col("o_orderstatus") == "F", "O'Neil").otherwise("Ann")
        customer = F.col("o_custkey").cast("string")
        body = F.format_string(
            '{"message": "1 answer", "data": [{"Lead_ID": "%s", "Call_Date": "%s", "PHONE_NUMBER": "%s", '
            '"user_id": "%s", "IVR_flow": "[%s, %s, \\"9z\\"]", "user_full_name": "customer %s", "extra": null}]}',
            F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"), customer, customer, name,
            F.substring("o_orderpriority", 1, 1), customer)
        return self.table("orders").select(F.to_date("o_orderdate").alias("date"), body.alias("body"))

    def agent_envelopes(self) -> DataFrame:
        """One envelope per event with one agent object; breaks come filled, as {} or as []."""
        breaks = (
            F.when(F.col("event_type") == "error", F.lit("[]"))
            .when(F.col("event_type") == "signup", F.lit("{}"))
            .otherwise(F.format_string(
                '{"TEA": "0:%d:75", "Lunch": "00:%02d:30", "Smoke": "x"}', F.minute("ts"), F.hour("ts"))))
        body = F.format_string(
            '{"message": "%s agents, 1 row", "data": [{"agent_id": "%s", "Agent_Id": "no", '
            '"call_attended": %s, "tea": "own", "breaks": %s}]}',
            "event_type", F.col("user_id").cast("string"), F.floor(F.col("value")).cast("string"), breaks)
        return self.table("events").select(
            F.to_date("ts").alias("date"), F.col("event_id"), body.alias("body"))
