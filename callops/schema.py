"""Frozen column lists of every table, by layer.

Fixed values: names and order are the contract with the data that is already landed.
"""

from __future__ import annotations

# --- landing ---------------------------------------------------------------------------------
EXPORT_CALL_LANDING = """
    project_id project_name lead_entry_date source customer_name call_date status user full_name
    campaign_id list_id phone_number cust_talk_sec lead_id call_type list_name main_disposition
    customer_hold_time wrap_up_time queue_seconds customer_number uic_id ingroup_name
    registered_number_of_the_customer caller_name uhid corporate_name claim_type claim_no
    claim_status caller_type query_typelevel_1 query_type_level_2 subquery_type_level_2
    additional_comments callbacks_required call_transferred_to_survey_ivr ingroup_list resolution
    mobilenumber states emailid reasonfornotselectedifno rightparty campaignname currentlocation
    phonenumber altnumber selected customername folionumber pannumber casetype typesubtype
    paymentstatus paymentstatuskfin documentstatus assignedteam remarks
""".split()

AGENT_LANDING = """
    agent_id process_name call_attended login_duration total_talk_time total_break total_wrap_time
    total_hold_time breaks emp_name undefined bio lagged login lunch manual meet qa tea traux tlbrf
    precal total_idle_time
""".split()

AGENT_LANDING_DURATIONS = """
    login_duration total_talk_time total_break total_wrap_time total_hold_time undefined bio lagged
    login lunch manual meet qa tea traux tlbrf precal total_idle_time
""".split()

SURVEY_LANDING = "lead_id call_date phone_number user_id inbound_group ivr_flow user_full_name".split()

STATUS = "table_name json_rows inserted_rows db_name timestamp".split()

# --- staging ---------------------------------------------------------------------------------
EXPORT_CALL_STAGING = """
    date user full_name call_date status campaign_id query_typelevel_1
    call_transferred_to_survey_ivr emp_id phone_number cust_talk_sec customer_hold_time wrap_up_time
    queue_seconds query_type_level_2 subquery_type_level_2 lead_id customer_number
""".split()

AGENT_STAGING = """
    date agent_id emp_name call_attended emp_id login_duration total_talk_time total_break
    total_wrap_time total_hold_time bio lunch tea total_idle_time
""".split()
AGENT_DURATIONS = AGENT_STAGING[5:]

SURVEY_STAGING = "date user_id call_date phone_number survey_rating user_full_name lead_id".split()

FORECAST_HOURS = [str(hour) for hour in range(24)]
FORECAST = [*FORECAST_HOURS, "Total", "date"]

CSAT_SCORES = """
    date user_id emp_code agentname campaign_id survey_rating category surveycount tl tenure week
""".split()

FTR_IVR = """
    date full_name status call_transferred_to_survey_ivr ftr survey_transfer tl emp_id user___sip_id
""".split()

QUALITY_MARKS = """
    greetings1_binary greeting2_binary authentication1_binary authentication2_binary
    issue_identification1_binary issue_identification2_binary probing1_binary probing2_binary
    call_etiquette1_binary call_etiquette2_binary call_etiquette3_binary call_etiquette4_binary
    call_etiquette5_binary call_etiquette6_binary empathy_and_sympathy1_binary
    empathy_and_sympathy1_binary1 ownership1_binary resolution1_binary resolution2_binary
    resolution3_binary resolution4_binary resolution5_binary resolution6_binary resolution7_binary
    tagging_and_documentation_binary summarization1_binary summarization2_binary
    summarization3_binary closing__binary zero_tolerance1_binary zero_tolerance2_binary
    zero_tolerance3_binary zero_tolerance4_binary zero_tolerance5_binary compliance1_binary
    compliance2_binary compliance3_binary compliance4_binary
""".split()
QUALITY = [
    *"""date agent_name agent_id call_date overall_score scorable scored fatal tenure month week
        qa_name tl_name fatal_reason""".split(),
    *QUALITY_MARKS,
    "customer_number",
]

KNOWLEDGE_TEST = "date Emp_Code_ Employee_Name_ Assessment_Scores".split()
TRAINING = """
    date emp_id name status_ training_date_ training_start_time training_end_time
    same_day_assessment_score
""".split()
REFRESHER = "date_of_refresher emp_id agent_name assessment_scores".split()

WEEKDAYS = "mon tue wed thu fri sat sun".split()
ROSTER = [
    *"employeeid employeename current_status shift shifts_timings".split(),
    *WEEKDAYS,
    *"wo ph leaves total_planned_ date team_lead".split(),
]
LOGIN = "user_name user_id first_login_date last_logout_date campaign_id date".split()

EMPLOYEES_SHORT = """
    sl_no lob employeeid employeename sip gender team_lead doj current_status designation role_fit
    grid
""".split()
EMPLOYEES = [*EMPLOYEES_SHORT, "manager", "sr__manager"]

ATTRITION = """
    employeeid employeename supervisor attrited_from_ date attrition_type reasons category_ resons
    ielevate_updated lob
""".split()

# --- reporting -------------------------------------------------------------------------------
PRODUCT_REPORT = """
    date agent_id emp_name call_attended login_duration total_talk_time total_break total_wrap_time
    total_hold_time bio lunch tea total_idle_time avg_time_hold_daily avg_wrap_time_daily
    avg_talk_time_daily avg_handling_time_daily utilization occupancy wrap_perc hold_perc taged
    emp_id
""".split()

PRODUCT_CSAT_REPORT = """
    date agent_id emp_name call_attended emp_id login_duration total_talk_time total_break
    total_wrap_time total_hold_time bio lunch tea total_idle_time avg_time_hold_daily
    avg_wrap_time_daily avg_talk_time_daily avg_handling_time_daily utilization occupancy wrap_perc
    hold_perc taged cumulative_score avg_handling_cumulative_score ftr total_calls survey_ivr csat
    dsat neutral response_count great_service csat_per dsat_per neutral_per great_service_per
    first_call_resolution ivr_transfer categorie
""".split()

PEOPLE_ATTRIBUTES = """
    team_lead designation role_fit tenure manager sr_manager grid team_lead_name manager_name
""".split()

CALL_REPORT = """
    date user full_name call_date status campaign_id query_typelevel_1 ans tagging ftr
    call_transferred_to_survey_ivr survey_ivr emp_id extracted_time extracted_interval count abandon
    outbound phone_number cust_talk_sec customer_hold_time wrap_up_time queue_seconds sl ht
    query_type_level_2 subquery_type_level_2 lead_id customer_number csat survey_feedback
    quality_score repeat_same_day repeat_7days repeat_3days
""".split()

CSAT_AGENT_REPORT = """
    date user full_name ftr total_calls survey_ivr csat dsat neutral response_count great_service
""".split()

CSAT_SCORE_REPORT = """
    agentname csat_date emp_code user_id csat csat_per dsat dsat_per neutral neutral_per
    response_count great_score great_score_percen ftr survey_ivr first_call_resolution
""".split()

EMPLOYEE_REPORT = """
    employeeid employeename team_lead designation role_fit doj manager sr__manager grid
    team_lead_name manager_name
""".split()

SHRINKAGE_REPORT = "date planned shrinkage_per".split()

INTERVAL_REPORT = """
    date interval roster_emp_count extracted_interval count ans sl sl_per abn aht asa forecast
    repeat_same_day repeat_3days repeat_7days
""".split()

QUALITY_REPORT = [
    *"""date agent_name emp_id call_date overall_score scorable scored fatal tenure month week
        qa_name tl_name fatal_reason""".split(),
    *[f"{mark}_count" for mark in QUALITY_MARKS],
    *"""role_fit pkt_scores manager sr__manager grid tni_assessment_score bq_scores team_lead
        team_lead_name manager_name""".split(),
]

ADHERENCE_REPORT = """
    first_login_date last_logout_date employeeid employeename shift shifts_timings mon tue wed thu
    fri sat sun wo ph leaves total_planned_ login_details logout_details attendance_present log_date
    sip late_minutes bio lunch tea week_number date team_lead non_rosted_count roster_count manager
    tl sr__manager emp_deatail_id user_name total_working_hours total_break_hours
    schedule_adherence_percentage total_hours emp_id login_adherence_percentage team_lead_name
    manager_name
""".split()
