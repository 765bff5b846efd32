"""DuckDB SQL for every registered query, written independently of the Spark plans."""

from __future__ import annotations

import re

from .bindings import NATION_STATES, TABLES

LO, HI = "date '1990-01-01'", "date '2099-12-31'"

# Shared table expressions; `_sql` puts in front only those a statement uses.
BASE: dict[str, str] = {
    "leads": f"""
        select case when o_orderkey % 29 = 0 then '  ' else split_part(c_name,'#',1) end first_name,
          case when o_orderkey % 31 = 0 then null else split_part(c_name,'#',2) end last_name,
          case when o_orderkey % 17 = 0 then null
               else concat(case when o_orderkey % 5 = 0 then upper(c_name) else lower(c_name) end, '@example.com') end email,
          case when o_orderkey % 23 = 0 then '' else cast(o_custkey as varchar) end phone_number,
          case when o_orderkey % 37 = 0 then null
               when o_orderkey % 41 = 0 then o_custkey % 60 + 16 else o_custkey % 60 + 15 end::integer age,
          concat(o_custkey % 900, ' Main St') address,
          case when o_custkey % 3 = 0 then concat('Apt ', o_orderkey % 2) end apartment_no,
          case when o_custkey % 43 = 0 then ' ' else concat('City', o_custkey % 50) end city,
          substr('{NATION_STATES}', c_nationkey * 2 + 1, 2) state,
          lpad(cast(o_custkey % 1000 as varchar), 5, '0') zip_code,
          o_orderstatus in ('F','O') patient_consent,
          case o_orderstatus when 'F' then 'TRUE' when 'O' then ' true ' else 'no' end consent_text,
          o_orderpriority channel,
          o_orderdate + to_seconds(o_orderkey % 86400) submitted_exact,
          case when o_orderkey % 3 = 0 then date_trunc('minute', o_orderdate + to_seconds(o_orderkey % 86400))
               else o_orderdate + to_seconds(o_orderkey % 86400) end submission_timestamp,
          case when o_orderkey % 19 = 0 then 'bad' when o_orderkey % 7 = 1 then strftime(o_orderdate,'%Y-%m-%dT10:00:00Z')
               when o_orderkey % 7 = 2 then strftime(o_orderdate,'%Y-%m-%d 23:30:00.5+00:00')
               when o_orderkey % 7 = 3 then strftime(o_orderdate,'%-m/%-d/%Y') when o_orderkey % 7 = 4 then strftime(o_orderdate,'%d-%b-%Y')
               when o_orderkey % 2 = 0 then strftime(o_orderdate,'%d-%m-%Y')
               else strftime(o_orderdate,'%Y-%m-%d') end file_date_text,
          case when o_orderkey % 19 = 0 then null else o_orderdate::date end lead_date,
          o_orderkey lead_id, o_custkey custkey, c_mktsegment segment, o_orderdate ordered
        from orders join customer on o_custkey = c_custkey""",
    "checked": """
        select *, case when trim(first_name) = '' then 'NULL_FIRST_NAME'
                       when last_name is null then 'NULL_LAST_NAME'
                       when email is null then 'NULL_EMAIL'
                       when trim(phone_number) = '' then 'NULL_PHONE_NUMBER'
                       when lead_date is null then 'INVALID_FILE_DATE' end rejection_reason
        from leads""",
    "prospects": """
        select cast(lead_id as varchar) record_id, 'FIP' || lpad(cast(custkey as varchar), 10, '0') master_patient_id,
          first_name, last_name, lower(email) email, phone_number, age, address, apartment_no, city, state, zip_code,
          patient_consent, channel, submission_timestamp, lead_date file_date,
          ordered + interval 1 day phi_loaded_at, segment <> 'MACHINERY' is_active
        from checked where rejection_reason is null
        qualify row_number() over (partition by custkey, lead_date order by lead_id) = 1""",
    "xref": """
        select upper(first_name) || '|' || upper(last_name) || '|' || lower(email) identity_key,
          'FIP' || lpad(cast(custkey as varchar), 10, '0') master_patient_id,
          min(first_name) first_name, min(last_name) last_name, min(lower(email)) email
        from checked where rejection_reason is null group by 1, 2""",
    "regions": """
        select *, case when state in ('CT','ME','MA','NH','RI','VT','NJ','NY','PA') then 'Northeast'
          when state in ('IL','IN','IA','KS','MI','MN','MO','NE','ND','OH','SD','WI') then 'Midwest'
          when state in ('AL','AR','DE','FL','GA','KY','LA','MD','MS','NC','OK','SC','TN','TX','VA','WV','DC') then 'South'
          when state in ('AZ','CO','ID','MT','NV','NM','UT','WY','AK','CA','HI','OR','WA') then 'West'
          else 'Other' end region
        from (select distinct city, state, zip_code from prospects
              where trim(city) <> '' and trim(state) <> '' and trim(zip_code) <> '')""",
    "dim_prospect": """
        select c.master_patient_id, c.first_name, c.last_name, c.email, c.phone_number, c.age,
          case when c.age < 18 then 'Under 18' when c.age between 18 and 25 then '18-25'
               when c.age between 26 and 35 then '26-35' when c.age between 36 and 45 then '36-45'
               when c.age between 46 and 55 then '46-55' when c.age between 56 and 65 then '56-65'
               when c.age > 65 then '65+' else 'Unknown' end age_group,
          c.city, c.state, c.zip_code, c.patient_consent, s.first_intake_date, s.last_intake_date, s.intake_count,
          f.channel primary_channel, c.is_active
        from (select * from prospects
              qualify row_number() over (partition by master_patient_id order by file_date desc, record_id desc) = 1) c
        join (select master_patient_id, min(file_date) first_intake_date, max(file_date) last_intake_date,
                     count(*) intake_count from prospects group by 1) s using (master_patient_id)
        join (select master_patient_id, channel from prospects
              qualify row_number() over (partition by master_patient_id order by submission_timestamp, record_id) = 1) f
          using (master_patient_id)""",
    "kevents": """
        select *, cast(json_extract_string(props, '$.k') as integer) k,
          case event_type when 'signup' then 'SENT' when 'view' then 'OPEN' when 'click' then 'CLICK'
               when 'error' then 'BOUNCE' else case when event_id % 5 = 0 then 'SPAM' else 'UNSUBSCRIBE' end end kind
        from events""",
    "fact": """
        select event_id, 'FIP' || lpad(cast(user_id as varchar), 10, '0') subscriber_key,
          cast(event_id % 9 * 7 + 107 as integer) job_id,
          case when event_id % 50 <> 0 then cast(event_id % 9 + 1 as integer) end job_key,
          ts event_timestamp, cast(strftime(ts, '%Y%m%d') as integer) date_key, kind event_type, k % 2 = 0 is_unique,
          kind in ('UNSUBSCRIBE','SPAM') is_suppressed,
          case kind when 'UNSUBSCRIBE' then 'UNSUBSCRIBE_EVENT' when 'SPAM' then 'SPAM_EVENT' end suppression_reason,
          case when kind = 'UNSUBSCRIBE' and k % 4 <> 0 then concat('reason_', k % 3) end reason,
          value, k
        from kevents""",
    "jobs": """
        select * from (values
          (1,'J01_Welcome','Welcome Email','Prospect_Welcome_01_Welcome_Email'),
          (2,'J01_Welcome','Education Email','Prospect_Welcome_02_Education_Email'),
          (3,'J02_Nurture','Education Email 1','Prospect_Nurture_01_Education_Email_1'),
          (4,'J02_Nurture','Education Email 2','Prospect_Nurture_02_Education_Email_2'),
          (5,'J02_Nurture','Prospect Story Email','Prospect_Nurture_03_Patient_Story_Email'),
          (6,'J03_Conversion','Conversion Email','Prospect_Conversion_01_Conversion_Email'),
          (7,'J03_Conversion','Reminder Email','Prospect_Conversion_02_Reminder_Email'),
          (8,'J04_ReEngagement','Re-engagement Email','Prospect_ReEngagement_01_ReEngagement_Email'),
          (9,'J04_ReEngagement','Final Reminder Email','Prospect_ReEngagement_02_Final_Reminder_Email'))
          t(job_key, journey_type, mapped_stage, email_name)""",
    "unsubs": """
        select subscriber_key, job_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') event_date, reason
        from fact where event_type = 'UNSUBSCRIBE'""",
    "journey": """
        select subscriber_key prospect_id, uid, loaded,
          """ + ", ".join(f"d{n}" for n in range(1, 10)) + """,
          """ + ", ".join(
              f"case when uid % 11 = {n} then null when d{n} is not null then 'True' else 'False' end s{n}"
              for n in range(1, 10)) + """,
          case when unsubs > 0 then list_extract(['Yes','Y','True','1',' yes '], cast(uid % 5 + 1 as integer))
               else 'False' end suppression_flag,
          unsubs > 0 suppressed
        from (select subscriber_key, cast(substr(subscriber_key, 4) as bigint) uid, max(event_timestamp) loaded,
                """ + ", ".join(
                    f"max(case when event_type = 'SENT' and job_id = {n * 7 + 100} then event_timestamp::date end) d{n}"
                    for n in range(1, 10)) + """,
                count(*) filter (event_type = 'UNSUBSCRIBE' and job_id <= 114) unsubs
              from fact group by 1)""",
    "stages": """
        select prospect_id, suppressed, n stage_number, upper(trim(flag)) = 'TRUE' sent, d sent_date from (
        """ + " union all ".join(
            f"select prospect_id, suppressed, {n} n, s{n} flag, d{n} d from journey" for n in range(1, 10)) + ")",
    "waits": """
        select * from (values (1,2,3),(2,3,5),(3,4,8),(4,5,3),(5,6,2),(6,7,2),(7,8,2),(8,9,2)) t(from_stage, to_stage, wait_days)""",
    "rejects": """
        select 'L' || lead_id rejection_id, 'PHI_PROSPECT_MASTER' table_name, rejection_reason,
          ordered + interval 3 days rejected_at, lead_date, file_date_text j_file_date, first_name j_first, last_name j_last,
          email j_email, phone_number j_phone, channel j_channel, consent_text j_consent, null::varchar j_prospect
        from checked where rejection_reason is not null
        union all
        select 'S' || prospect_id, 'FACT_SFMC_ENGAGEMENT', 'SUPPRESSED_PROSPECT', loaded, null, null, null, null, null, null,
          null, null, prospect_id from journey where suppressed
        union all
        select 'F' || event_id, 'FACT_SFMC_ENGAGEMENT', 'FATAL_ERROR', event_timestamp, null, null, null, null, null, null,
          null, null, subscriber_key from fact where event_type = 'BOUNCE' and k % 10 = 0""",
    "snapshot": """
        select 'FIP' || lpad(cast(id as varchar), 10, '0') prospect_id,
          case when id % 2 = 0 then 'True' else 'False' end marketing_consent,
          case when c_acctbal > 5000 then 'True' else 'False' end high_engagement
        from (select c_custkey id, c_acctbal from customer where c_custkey % 13 <> 0
              union all select c_custkey + 1000000000, c_acctbal from customer where c_custkey % 97 = 0)""",
    "runs": """
        select lpad(cast(o_orderkey as varchar), 12, '0') run_id,
          list_extract(['SP_LOAD_PHI_PROSPECT','SP_LOAD_BRONZE_PROSPECT','SP_LOAD_SILVER_PROSPECT'], cast(o_orderkey % 3 + 1 as integer)) pipeline_name,
          list_extract(['PHI_PROSPECT_MASTER','BRZ_PROSPECT_MASTER','SLV_PROSPECT_MASTER'], cast(o_orderkey % 3 + 1 as integer)) table_name,
          case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'FAILED' else 'STARTED' end status,
          o_custkey rows_loaded, case when o_orderstatus = 'O' then 'load failed' end error_message,
          o_orderdate + to_seconds(o_orderkey % 86400) started_at,
          case when o_orderstatus in ('F','O') then o_orderdate + to_seconds(o_orderkey % 86400) + interval 1 minute end completed_at
        from orders""",
    "blocked": """select * from rejects where upper(rejection_reason) in ('SUPPRESSED_PROSPECT','FATAL_ERROR','SUPPRESSED')""",
    "refused": """select * from rejects where upper(rejection_reason) not in ('SUPPRESSED_PROSPECT','FATAL_ERROR','SUPPRESSED')""",
    "percounts": """
        select subscriber_key, count(*) filter (event_type = 'SENT') sends, count(*) filter (event_type = 'OPEN') opens,
          count(*) filter (event_type = 'CLICK') clicks, count(*) filter (event_type = 'BOUNCE') bounces,
          count(*) filter (event_type = 'UNSUBSCRIBE') unsubscribes, count(*) filter (event_type = 'SPAM') spam
        from fact group by 1""",
    "pe_day": """
        select master_patient_id, count(*) filter (event_type = 'SENT') sends, count(*) filter (event_type = 'OPEN') opens,
          count(*) filter (event_type = 'CLICK') clicks, count(*) filter (event_type = 'BOUNCE') bounces,
          count(*) filter (event_type = 'UNSUBSCRIBE') unsubscribes
        from (select distinct master_patient_id from prospects where is_active) p
        join fact on subscriber_key = master_patient_id and event_timestamp::date = date '2024-01-10' group by 1""",
    "pe": """
        select master_patient_id, count(*) filter (event_type = 'SENT') sends, count(*) filter (event_type = 'OPEN') opens,
          count(*) filter (event_type = 'CLICK') clicks, count(*) filter (event_type = 'BOUNCE') bounces,
          count(*) filter (event_type = 'UNSUBSCRIBE') unsubscribes
        from (select distinct master_patient_id from prospects where is_active) p
        join fact on subscriber_key = master_patient_id group by 1""",
}


def _sql(body: str) -> str:
    """The statement with the shared expressions it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in BASE:
            if name not in needed and re.search(rf"(?<![\w.'])\b{name}\b(?!['.(])", text):
                visit(BASE[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    text = body.strip()
    if not needed:
        return text
    shared = ",\n".join(f"{n} as ({BASE[n].strip()})" for n in needed)
    if text.lower().startswith("with "):
        return f"with {shared},\n{text[5:]}"
    return f"with {shared}\n{text}"


def _segment(sends: bool = True, short: bool = False) -> str:
    names = ["High Engagement — Conversion Candidate", "Mid Engagement — Nurture Needed",
             "At Risk — Drop-off Signal", "Low Engagement — Re-engagement Candidate", "No Activity"]
    if short:
        names = [n.split(" — ")[0] for n in names]
    tail = f"when sends > 0 and opens = 0 then '{names[3]}' else '{names[4]}'" if sends else f"else '{names[3]}'"
    return (f"case when clicks > 0 then '{names[0]}' when opens > 0 and clicks = 0 then '{names[1]}' "
            f"when bounces > 0 or unsubscribes > 0 then '{names[2]}' {tail} end")


def _pct(n: str, d: str, digits: int) -> str:
    return f"round(cast({n} as double) * 100.0 / nullif(cast({d} as double), 0), {digits})"


def _tri(reason: str = "lead_date") -> str:
    return f"({reason} between {LO} and {HI} or ({reason} is null and rejected_at::date between {LO} and {HI}))"


RAW: dict[str, str] = {
    # --- funnel -------------------------------------------------------------
    "funnel_metrics": f"""
        with l as (select count(*) n from leads where lead_date between {LO} and {HI}),
        p as (select count(*) n from prospects where file_date between {LO} and {HI}),
        e as (select count(*) filter (event_type='SENT') s, count(*) filter (event_type='BOUNCE') b,
                count(*) filter (event_type='OPEN') o, count(*) filter (event_type='OPEN' and is_unique) uo,
                count(*) filter (event_type='CLICK') c, count(*) filter (event_type='CLICK' and is_unique) uc,
                count(*) filter (event_type='UNSUBSCRIBE') u
              from fact where event_timestamp::date between {LO} and {HI}),
        x as (select count(*) n from blocked where rejected_at::date between {LO} and {HI})
        select l.n lead_count, l.n - p.n invalid_lead_count, p.n prospect_count, {_pct('p.n','l.n',2)} lead_to_prospect_pct,
          p.n prospect_intake_events, s sent_count, x.n suppressed_count, s - b estimated_delivered, b bounce_count,
          o open_count, uo unique_open_count, c click_count, uc unique_click_count, u unsubscribe_count,
          {_pct('o','(s - b)',2)} open_rate_pct, {_pct('c','(s - b)',2)} click_rate_pct
        from l, p, e, x""",
    "funnel_chart_data": f"""
        with s as (
          select 1 stage_order, 'F01 Lead Intake' stage, count(*) cnt from leads where lead_date between {LO} and {HI}
          union all select 2, 'F02 Valid Prospects', count(*) from prospects
          union all select 3, 'F04 SFMC Sent', count(*) from fact where event_type = 'SENT'
          union all select 4, 'F06 Opened', count(*) from fact where event_type = 'OPEN'
          union all select 5, 'F06 Clicked', count(*) from fact where event_type = 'CLICK')
        select stage_order, stage, cnt, {_pct('cnt','(select cnt from s where stage_order = 1)',2)} pct_of_initial from s""",
    "drop_analysis": """
        with d as (select date '2024-01-15' x)
        select 'Lead Intake' signal, count(*) count, '2024-01-15' date from leads, d where lead_date = x
        union all select 'Valid Prospects Mastered', count(*), '2024-01-15' from prospects, d where file_date = x
        union all select 'Rejected Leads - ' || rejection_reason, count(*), '2024-01-15' from rejects, d
          where rejected_at::date = x and table_name = 'PHI_PROSPECT_MASTER' group by rejection_reason
        union all select 'SFMC - ' || event_type, count(*), '2024-01-15' from fact, d where event_timestamp::date = x group by event_type
        union all select 'SFMC Suppression - ' || rejection_reason, count(*), '2024-01-15' from blocked, d
          where rejected_at::date = x group by rejection_reason""",
    "drop_analysis_intake": """
        with d as (select date '1996-03-15' x)
        select 'Lead Intake' signal, count(*) count, '1996-03-15' date from leads, d where lead_date = x
        union all select 'Valid Prospects Mastered', count(*), '1996-03-15' from prospects, d where file_date = x
        union all select 'Rejected Leads - ' || rejection_reason, count(*), '1996-03-15' from rejects, d
          where rejected_at::date = x and table_name = 'PHI_PROSPECT_MASTER' group by rejection_reason""",
    "kpis": """
        with a as (select count(*) leads_n from leads), b as (select count(*) valid_n from prospects),
        e as (select count(*) rows_n, count(*) filter (event_type='SENT') s, count(*) filter (event_type='BOUNCE') bo,
               count(*) filter (event_type='OPEN') o, count(*) filter (event_type='CLICK') c,
               count(*) filter (event_type='UNSUBSCRIBE') u, count(*) filter (is_suppressed) sup from fact),
        r as (select count(*) filter (rejection_reason = 'SUPPRESSED_PROSPECT') sp, count(*) filter (rejection_reason = 'FATAL_ERROR') fe,
               count(*) filter (rejection_reason not in ('SUPPRESSED_PROSPECT','FATAL_ERROR')) inv from rejects),
        h as (select count(*) filter (coalesce(s1,'') = 'True') ent,
               count(*) filter (s1='True' and s2='True' and s3='True' and s4='True' and s5='True' and s6='True' and s7='True') comp from journey),
        v as (select * from a, b, e, r, h)
        select 'lead_count' kpi, leads_n::double "value" from v union all
        select 'invalid_lead_count', inv::double from v union all
        select 'valid_prospect_count', valid_n::double from v union all
        select 'lead_to_prospect_conversion_rate', valid_n::double / leads_n from v union all
        select 'rejection_rate', inv::double / leads_n from v union all
        select 'suppressed_send_count', sp::double from v union all
        select 'fatal_error_count', fe::double from v union all
        select 'expected_send_count', (s + sp + fe)::double from v union all
        select 'actual_send_count', s::double from v union all
        select 'delivery_rate', (s - bo)::double / s from v union all
        select 'open_rate', o::double / (s - bo) from v union all
        select 'click_rate', c::double / (s - bo) from v union all
        select 'bounce_rate', bo::double / s from v union all
        select 'unsubscribe_rate', u::double / (s - bo) from v union all
        select 'journey_completion_rate', comp::double / ent from v union all
        select 'data_quality_issue_rate', inv::double / leads_n from v union all
        select 'signal_trust_score', 1.0::double - sup::double / rows_n from v""",
    # --- rejections -----------------------------------------------------------
    "rejection_analysis": f"""
        select coalesce(lead_date, rejected_at::date) lead_file_date, table_name, rejection_reason, count(*) rejected_count,
          count(distinct j_email) emails
        from rejects where {_tri()} group by 1, 2, 3 order by 1 desc, 4 desc, 3, 2 limit 100""",
    "rejection_analysis_intake": f"""
        select coalesce(lead_date, rejected_at::date) lead_file_date, table_name, rejection_reason, count(*) rejected_count,
          count(distinct j_email) emails
        from refused where {_tri()} and rejection_reason = 'NULL_PHONE_NUMBER' group by 1, 2, 3 order by 1 desc, 4 desc, 3, 2 limit 100""",
    "rejection_emails": f"""
        select distinct coalesce(lead_date, rejected_at::date) lead_file_date, table_name, rejection_reason, j_email email
        from rejects where {_tri()} and j_email is not null""",
    "rejected_details": f"""
        select rejection_id, rejected_at::date rejected_at_date, table_name, rejection_reason, j_file_date lead_file_date,
          j_first first_name, j_last last_name, j_email email, j_phone phone_number, j_channel channel, j_consent consent_flag
        from refused where {_tri()}
        order by j_file_date desc nulls last, 2 desc, 1 limit 100""",
    "rejected_details_sfmc": f"""
        select rejection_id, rejected_at::date rejected_at_date, table_name, rejection_reason, j_file_date lead_file_date,
          j_first first_name, j_last last_name, j_email email, j_phone phone_number, j_channel channel, j_consent consent_flag
        from blocked where {_tri()} order by j_file_date desc nulls last, 2 desc, 1 limit 100""",
    "rejection_chart_data": f"""
        select rejection_reason, count(*) cnt, {_pct('count(*)', 'sum(count(*)) over ()', 2)} share_pct
        from rejects where {_tri()} group by 1""",
    "suppression_counts": f"""
        select rejection_reason suppression_type, count(*) count, min(rejected_at::date) first_seen, max(rejected_at::date) last_seen
        from blocked where rejected_at::date between {LO} and {HI} group by 1""",
    "suppression_share": f"""
        select rejection_reason, count(*) count, {_pct('count(*)', '(select count(*) from prospects)', 2)} pct_of_prospects
        from blocked where rejected_at::date between {LO} and {HI} group by 1""",
    "rejects_by_table": f"""
        select table_name, rejection_reason, count(*) rejection_count, min(rejected_at::date)::varchar first_seen,
          max(rejected_at::date)::varchar last_seen
        from rejects where rejected_at::date between {LO} and {HI} group by 1, 2""",
    "daily_rejects": "select rejected_at::date \"day\", count(*) rejected_count from rejects group by 1",
    # --- engagement -------------------------------------------------------------
    "engagement_stats": """
        select coalesce(journey_type, 'Unknown Journey') journey_type, coalesce(mapped_stage, 'Unknown Stage') stage, event_type,
          count(*) event_count, count(*) filter (is_unique) unique_event_count, min(event_timestamp) first_event, max(event_timestamp) last_event
        from fact left join jobs using (job_key) where event_timestamp::date between date '2024-01-01' and date '2024-01-30' group by 1, 2, 3""",
    "engagement_stats_nurture": """
        select journey_type, mapped_stage stage, event_type,
          count(*) event_count, count(*) filter (is_unique) unique_event_count, min(event_timestamp) first_event, max(event_timestamp) last_event
        from fact join jobs using (job_key) where event_timestamp::date between date '2024-01-05' and date '2024-01-12'
          and upper(journey_type) like '%NURTURE%' group by 1, 2, 3""",
    "engagement_stats_raw": """
        select coalesce(journey_type, 'Unknown Journey') journey_type, coalesce(mapped_stage, 'Unknown Stage') stage, event_type,
          count(*) event_count, count(distinct subscriber_key) unique_subscribers
        from fact f left join jobs j on f.job_id = j.job_key * 7 + 100 group by 1, 2, 3""",
    "engagement_stats_fallback": """
        select coalesce(journey_type, 'Unknown Journey') journey_type, coalesce(mapped_stage, 'Unknown Stage') stage, event_type,
          count(*) event_count, count(distinct subscriber_key) unique_subscribers
        from fact f left join jobs j on f.job_id = j.job_key * 7 + 100 group by 1, 2, 3""",
    "engagement_pivot": """
        select event_type, count(*) filter (journey_type = 'J01_Welcome') "J01_Welcome", count(*) filter (journey_type = 'J02_Nurture') "J02_Nurture",
          count(*) filter (journey_type = 'J03_Conversion') "J03_Conversion", count(*) filter (journey_type = 'J04_ReEngagement') "J04_ReEngagement"
        from fact join jobs using (job_key) group by 1""",
    "engagement_pivot_fallback": "select event_type, count(*) cnt from fact group by 1",
    "distinct_from_sketches": """
        select event_type, count(distinct subscriber_key) unique_subscribers, true within_tolerance from fact
        where event_timestamp::date between date '2024-01-03' and date '2024-01-25' group by 1""",
    "raw_event_totals": "select event_type, count(*) cnt from fact group by 1",
    "journey_rates": f"""
        select journey_type, count(*) filter (event_type='SENT') sends, count(*) filter (event_type='OPEN') opens,
          count(*) filter (event_type='CLICK') clicks, count(*) filter (event_type='BOUNCE') bounces,
          {_pct("count(*) filter (event_type='OPEN')", "count(*) filter (event_type='SENT')", 2)} open_rate_pct,
          {_pct("count(*) filter (event_type='CLICK')", "count(*) filter (event_type='SENT')", 2)} click_rate_pct,
          {_pct("count(*) filter (event_type='BOUNCE')", "count(*) filter (event_type='SENT')", 2)} bounce_rate_pct
        from fact join jobs using (job_key) group by 1""",
    # --- scoring ------------------------------------------------------------------
    "conversion_scores": f"""
        with g as (
          select master_patient_id, first_name, last_name, email, channel, file_date,
            count(*) filter (event_type='SENT') sends, count(*) filter (event_type='OPEN') opens, count(*) filter (event_type='CLICK') clicks,
            count(*) filter (event_type='BOUNCE') bounces, count(*) filter (event_type='UNSUBSCRIBE') unsubscribes, count(*) filter (event_type='SPAM') spam
          from prospects join fact on subscriber_key = master_patient_id
          where is_active and event_timestamp::date between date '2024-01-01' and date '2024-01-30' group by 1, 2, 3, 4, 5, 6),
        s as (
          select master_patient_id master_prospect_id, first_name, last_name, email, channel, file_date intake_date,
            sends, opens, clicks, bounces, unsubscribes, {_pct('(opens + clicks)', 'sends', 1)} engagement_rate_pct,
            case when sends > 0 then round(least(100.0::double, (clicks * 2.0 + opens)::double / sends::double * 50), 1) end conversion_signal_score,
            case when sends > 0 then round(least(100.0::double, (bounces * 1.5 + unsubscribes * 2.0 + spam * 3.0)::double / sends::double * 50), 1) end dropoff_risk_score,
            {_segment()} engagement_segment
          from g)
        select * from s order by conversion_signal_score desc nulls last, dropoff_risk_score asc nulls last,
          master_prospect_id, intake_date, channel limit 100""",
    "segment_summary": f"""
        with s as (select {_segment()} segment, cast(opens + clicks as double) * 100.0 / nullif(sends, 0) rate from pe_day)
        select segment, count(*) prospect_count, round(avg(rate), 1) avg_engagement_rate_pct,
          {_pct('count(*)', 'sum(count(*)) over ()', 1)} pct_of_total from s group by 1""",
    "segment_chart_data": f"""
        select 'segment' chart, {_segment(short=True)} label, count(*) cnt from pe group by 2
        union all select 'status', case when is_active then 'Active' else 'Inactive / Dropped' end, count(*) from prospects group by 2""",
    "raw_engagement_scores": f"""
        with d as (
          select subscriber_key, count(distinct job_id) filter (event_type='SENT') sends, count(distinct job_id) filter (event_type='OPEN') opens,
            count(distinct job_id) filter (event_type='CLICK') clicks, count(distinct job_id) filter (event_type='BOUNCE') bounces,
            count(distinct job_id) filter (event_type='UNSUBSCRIBE') unsubscribes, count(*) filter (event_type='SENT') any_sent from fact group by 1)
        select subscriber_key, sends total_sends, opens total_opens, clicks total_clicks, bounces total_bounces, unsubscribes total_unsubscribes,
          {_pct('opens','sends',1)} open_rate_pct, {_pct('clicks','sends',1)} click_rate_pct, {_segment(sends=False)} engagement_segment
        from d where any_sent > 0 order by click_rate_pct desc nulls last, open_rate_pct desc nulls last, subscriber_key limit 100""",
    "conversion_scores_fallback": f"""
        with d as (
          select subscriber_key, count(distinct job_id) filter (event_type='SENT') sends, count(distinct job_id) filter (event_type='OPEN') opens,
            count(distinct job_id) filter (event_type='CLICK') clicks, count(distinct job_id) filter (event_type='BOUNCE') bounces,
            count(distinct job_id) filter (event_type='UNSUBSCRIBE') unsubscribes, count(*) filter (event_type='SENT') any_sent from fact group by 1)
        select subscriber_key, sends total_sends, opens total_opens, clicks total_clicks, bounces total_bounces, unsubscribes total_unsubscribes,
          {_pct('opens','sends',1)} open_rate_pct, {_pct('clicks','sends',1)} click_rate_pct, {_segment(sends=False)} engagement_segment
        from d where any_sent > 0 order by click_rate_pct desc nulls last, open_rate_pct desc nulls last, subscriber_key limit 100""",
    "channel_consent_activity": f"""
        select channel, patient_consent consent_status, count(*) total_prospects, count(*) filter (is_active) active_prospects,
          count(*) filter (not is_active) inactive_prospects, {_pct('count(*) filter (is_active)', 'count(*)', 1)} active_rate_pct,
          {_pct('count(*) filter (not is_active)', 'count(*)', 1)} dropoff_rate_pct
        from prospects group by 1, 2""",
    "never_opened": """
        select subscriber_key, count(*) sends from fact where event_type = 'SENT'
          and subscriber_key not in (select subscriber_key from fact where event_type = 'OPEN') group by 1""",
    # --- journeys ---------------------------------------------------------------------
    "stage_send_summary": """
        select case stage_number when 1 then 'Stage 1 — Welcome Email (J01)' when 2 then 'Stage 2 — Education Email (J01)'
            when 3 then 'Stage 3 — Nurture Edu Email 1 (J02)' when 4 then 'Stage 4 — Nurture Edu Email 2 (J02)'
            when 5 then 'Stage 5 — Prospect Story Email (J02)' when 6 then 'Stage 6 — Conversion Email (J03)'
            when 7 then 'Stage 7 — Reminder Email (J03)' when 8 then 'Stage 8 — Re-engagement Email (J04)'
            else 'Stage 9 — Final Reminder Email (J04)' end stage,
          count(*) total_prospects, count(*) filter (sent) sent, count(*) filter (not sent) not_sent, count(*) filter (suppressed) suppressed
        from stages group by stage_number""",
    "stage_send_summary_day": """
        select case stage_number when 1 then 'Stage 1 — Welcome Email (J01)' when 2 then 'Stage 2 — Education Email (J01)'
            when 3 then 'Stage 3 — Nurture Edu Email 1 (J02)' when 4 then 'Stage 4 — Nurture Edu Email 2 (J02)'
            when 5 then 'Stage 5 — Prospect Story Email (J02)' when 6 then 'Stage 6 — Conversion Email (J03)'
            when 7 then 'Stage 7 — Reminder Email (J03)' when 8 then 'Stage 8 — Re-engagement Email (J04)'
            else 'Stage 9 — Final Reminder Email (J04)' end stage,
          count(*) total_prospects, count(*) filter (sent) sent, count(*) filter (not sent) not_sent, count(*) filter (suppressed) suppressed
        from stages where sent_date = date '2024-01-28' group by stage_number""",
    "suppressed_last_stage": """
        with j as (select prospect_id,
            case when s9='True' then 'Stage 9 — Final Reminder' when s8='True' then 'Stage 8 — Re-engagement' when s7='True' then 'Stage 7 — Reminder'
                 when s6='True' then 'Stage 6 — Conversion' when s5='True' then 'Stage 5 — Prospect Story' when s4='True' then 'Stage 4 — Nurture Edu2'
                 when s3='True' then 'Stage 3 — Nurture Edu1' when s2='True' then 'Stage 2 — Education Email' when s1='True' then 'Stage 1 — Welcome Email'
                 else 'No emails sent yet' end last_stage_reached,
            coalesce(greatest(d1,d2,d3,d4,d5,d6,d7,d8,d9), date '1900-01-01') last_email_date from journey where suppressed)
        select prospect_id, last_stage_reached, last_email_date, nullif(last_email_date, date '1900-01-01') last_email,
          event_date unsubscribe_date, reason unsubscribe_reason, job_id unsubscribe_job_id,
          case when subscriber_key is not null then 'Unsubscribed' else 'Suppressed (non-unsubscribe reason)' end suppression_type
        from j left join unsubs on subscriber_key = prospect_id
        order by last_email_date desc nulls last, prospect_id, event_date nulls first, job_id""",
    "unsubscribe_reasons": """
        select coalesce(reason, '(no reason provided)') unsubscribe_reason, count(distinct subscriber_key) prospect_count,
          min(event_date) first_unsubscribe_date, max(event_date) last_unsubscribe_date from unsubs group by 1""",
    "expected_next_stage": """
        select prospect_id, suppressed, from_stage, to_stage, sent_date stage_date, cast(sent_date + wait_days as date) expected_date
        from stages join waits on stage_number = from_stage where sent and sent_date is not null""",
    "missed_sends": """
        with due as (select prospect_id, suppressed, to_stage, cast(sent_date + wait_days as date) expected_date
                     from stages join waits on stage_number = from_stage where sent and sent_date is not null),
        m as (select to_stage, expected_date, suppressed,
            exists (select 1 from fact f where f.event_type='SENT' and f.subscriber_key = due.prospect_id and f.job_id = due.to_stage * 7 + 100
                    and f.event_timestamp::date = due.expected_date) was_sent,
            exists (select 1 from rejects r where r.rejection_reason = 'FATAL_ERROR' and r.j_prospect = due.prospect_id) fatal,
            exists (select 1 from fact f where f.event_type='BOUNCE' and f.subscriber_key = due.prospect_id and f.event_timestamp::date <= due.expected_date) bounced,
            exists (select 1 from fact f where f.event_type='UNSUBSCRIBE' and f.subscriber_key = due.prospect_id and f.event_timestamp::date <= due.expected_date) unsub
          from due)
        select to_stage stage_number, expected_date, count(*) expected_count, count(*) filter (was_sent) actual_count,
          count(*) filter (not was_sent) missed_count, count(*) filter (not was_sent and suppressed) missed_suppressed,
          count(*) filter (not was_sent and not suppressed and fatal) missed_fatal,
          count(*) filter (not was_sent and not suppressed and not fatal and bounced) missed_bounce,
          count(*) filter (not was_sent and not suppressed and not fatal and not bounced and unsub) missed_unsubscribed,
          count(*) filter (not was_sent and not suppressed and not fatal and not bounced and not unsub) missed_unknown
        from m group by 1, 2""",
    "suppressed_between_stages": """
        with l as (select prospect_id, case when s9='True' then 9 when s8='True' then 8 when s7='True' then 7 when s6='True' then 6 when s5='True' then 5
              when s4='True' then 4 when s3='True' then 3 when s2='True' then 2 when s1='True' then 1 else 0 end last_stage,
            coalesce(greatest(d1,d2,d3,d4,d5,d6,d7,d8,d9), date '1900-01-01') last_email_date from journey where suppressed),
        u as (select subscriber_key, min(event_date)::timestamp::date unsubscribe_day from unsubs group by 1)
        select prospect_id, last_stage, to_stage suppressed_before_stage, last_email_date, cast(last_email_date + wait_days as date) next_due, unsubscribe_day
        from l join waits on last_stage = from_stage join u on subscriber_key = prospect_id where unsubscribe_day <= last_email_date + wait_days""",
    "path_membership": """
        with f as (select prospect_id, coalesce(s1='True',false) t1, coalesce(s2='True',false) t2, coalesce(s3='True',false) t3, coalesce(s4='True',false) t4,
            coalesce(s5='True',false) t5, coalesce(s6='True',false) t6, coalesce(s7='True',false) t7, coalesce(s8='True',false) t8, coalesce(s9='True',false) t9,
            d1,d2,d3,d4,d5,d6,d7,d8,d9 from journey),
        hi as (select 'HIGH' path, count(*) filter (t1 or t2 or t3 or t4 or t5 or t6 or t7) entered, count(*) filter (t1 and t2 and t3 and t4 and t5 and t6 and t7) completed,
            avg(date_diff('day', least(case when t1 then d1 end, case when t2 then d2 end, case when t3 then d3 end, case when t4 then d4 end, case when t5 then d5 end, case when t6 then d6 end, case when t7 then d7 end),
              greatest(case when t1 then d1 end, case when t2 then d2 end, case when t3 then d3 end, case when t4 then d4 end, case when t5 then d5 end, case when t6 then d6 end, case when t7 then d7 end))) avg_days from f),
        lo as (select 'LOW' path, count(*) filter (t8 or t9) entered, count(*) filter (t8 and t9) completed,
            avg(date_diff('day', least(case when t8 then d8 end, case when t9 then d9 end), greatest(case when t8 then d8 end, case when t9 then d9 end))) avg_days from f),
        st as (select 'HIGH' path, 1 stage_number, count(*) filter (t1) reached, count(*) filter (t1 and not t2) dropped from f
          union all select 'HIGH', 2, count(*) filter (t2), count(*) filter (t2 and not t3) from f
          union all select 'HIGH', 3, count(*) filter (t3), count(*) filter (t3 and not t4) from f
          union all select 'HIGH', 4, count(*) filter (t4), count(*) filter (t4 and not t5) from f
          union all select 'HIGH', 5, count(*) filter (t5), count(*) filter (t5 and not t6) from f
          union all select 'HIGH', 6, count(*) filter (t6), count(*) filter (t6 and not t7) from f
          union all select 'HIGH', 7, count(*) filter (t7), 0 from f
          union all select 'LOW', 8, count(*) filter (t8), count(*) filter (t8 and not t9) from f
          union all select 'LOW', 9, count(*) filter (t9), 0 from f)
        select st.path, stage_number, reached, dropped, entered, completed, avg_days avg_days_in_journey
        from st join (select * from hi union all select * from lo) p on p.path = st.path""",
    "map_email_to_stage": """
        select cast(job_key * 7 + 100 as integer) job_id, email_name, journey_type journey_code, mapped_stage stage_name, job_key stage_number,
          email_name like '%\\_Resend' escape '\\' is_resend, n event_count
        from jobs join (select job_id, count(*) n from fact group by 1) on job_id = job_key * 7 + 100""",
    # --- prospects, outbound -------------------------------------------------------------
    "trace_prospect": """
        select * from (
        select 'A_Intake' layer, email, first_name, last_name, channel,
          case when lead_id % 3 = 0 then strftime(submitted_exact, '%d-%m-%Y %H:%M') else strftime(submitted_exact, '%Y-%m-%d %H:%M:%S') end ts, 'Lead' lifecycle_label
        from leads where lower(email) = 'customer#000000007@example.com'
        union all select 'B_Rejected', j_email, j_first, j_last, rejection_reason, strftime(rejected_at, '%Y-%m-%d %H:%M:%S'), 'Invalid Lead'
        from rejects where lower(j_email) = 'customer#000000007@example.com'
        union all select 'C_Prospect', email, first_name, last_name, channel, strftime(submission_timestamp, '%Y-%m-%d %H:%M:%S'), 'Prospect'
        from prospects where lower(email) = 'customer#000000007@example.com'
        union all select 'D_Identity_Xref', email, first_name, last_name, identity_key, null, 'Identity Bridge'
        from xref where lower(email) = 'customer#000000007@example.com') order by layer, ts, channel""",
    "trace_prospect_id": """
        select 'A_Intake' layer, email, first_name, last_name, channel,
          case when lead_id % 3 = 0 then strftime(submitted_exact, '%d-%m-%Y %H:%M') else strftime(submitted_exact, '%Y-%m-%d %H:%M:%S') end ts, 'Lead' lifecycle_label
        from leads where upper(trim(first_name)) || '|' || upper(trim(last_name)) || '|' || lower(trim(email)) in (select identity_key from xref where master_patient_id = 'FIP0000000007')
        union all select 'C_Prospect', email, first_name, last_name, channel, strftime(submission_timestamp, '%Y-%m-%d %H:%M:%S'), 'Prospect'
        from prospects where master_patient_id = 'FIP0000000007'
        union all select 'D_Identity_Xref', email, first_name, last_name, identity_key, null, 'Identity Bridge' from xref where master_patient_id = 'FIP0000000007'""",
    "trace_prospect_name": """
        select 'A_Intake' layer, email, first_name, last_name, channel,
          case when lead_id % 3 = 0 then strftime(submitted_exact, '%d-%m-%Y %H:%M') else strftime(submitted_exact, '%Y-%m-%d %H:%M:%S') end ts, 'Lead' lifecycle_label
        from leads where contains(lower(first_name) || ' ' || lower(last_name), 'customer 000000007')""",
    "trace_engagement": """
        select event_type, event_timestamp, journey_type, mapped_stage, subscriber_key, is_suppressed, suppression_reason
        from (select distinct master_patient_id from prospects where master_patient_id = 'FIP0000000007') join fact on subscriber_key = master_patient_id
        left join jobs using (job_key) order by event_timestamp, event_type""",
    "prospect_details": """
        select master_patient_id master_prospect_id, record_id, first_name, last_name, email, phone_number, patient_consent consent_flag, channel,
          file_date, strftime(submission_timestamp, '%Y-%m-%d %H:%M:%S') submitted_at, is_active
        from prospects where upper(channel) = '2-HIGH' and state = 'NY' order by file_date desc, submission_timestamp desc, record_id limit 100""",
    "outbound_view": """
        select master_patient_id, first_name, last_name, email, phone_number, age, age_group, city, state, zip_code, primary_channel, patient_consent,
          first_intake_date, last_intake_date from dim_prospect where is_active and patient_consent and trim(email) <> '' and upper(trim(email)) <> 'N/A'""",
    "outbound_reconciliation": """
        select count(distinct d.master_patient_id) dim_prospect_total, count(distinct s.prospect_id) sfmc_prospect_c_total,
          count(distinct case when s.prospect_id is not null then d.master_patient_id end) matched_in_both,
          count(distinct case when s.prospect_id is null then d.master_patient_id end) in_dim_not_sfmc,
          count(distinct case when d.master_patient_id is null then s.prospect_id end) in_sfmc_not_dim
        from dim_prospect d full outer join snapshot s on d.master_patient_id = s.prospect_id""",
    "outbound_full_join": """
        select coalesce(d.master_patient_id, s.prospect_id) prospect_id,
          case when s.prospect_id is null then 'dimension_only' when d.master_patient_id is null then 'target_only' else 'both' end status
        from dim_prospect d full outer join snapshot s on d.master_patient_id = s.prospect_id""",
    "outbound_missing": """
        select master_patient_id, first_name, last_name, email, primary_channel, first_intake_date,
          'In DIM_PROSPECT but NOT in SFMC (not yet exported or load failed)' status
        from dim_prospect where master_patient_id not in (select prospect_id from snapshot) order by first_intake_date desc, master_patient_id""",
    "outbound_engagement": f"""
        select d.master_patient_id, d.first_name, d.last_name, marketing_consent, high_engagement,
          count(*) filter (event_type='SENT') total_sends, count(*) filter (event_type='OPEN') total_opens, count(*) filter (event_type='CLICK') total_clicks,
          {_pct("count(*) filter (event_type='OPEN')", "count(*) filter (event_type='SENT')", 1)} open_rate_pct, max(event_timestamp) last_engagement
        from dim_prospect d join snapshot on prospect_id = d.master_patient_id left join fact on subscriber_key = d.master_patient_id
        group by 1, 2, 3, 4, 5 order by total_sends desc, 1 limit 100""",
    # --- dashboard, trends, health ---------------------------------------------------------
    "filter_options": "select distinct coalesce(upper(channel), 'UNKNOWN') channel from leads",
    "dash_funnel_kpis": f"""
        with l as (select count(*) leads from leads where lead_date between {LO} and {HI} and upper(channel) = '1-URGENT'),
        p as (select count(*) prospects from prospects where upper(channel) = '1-URGENT')
        select leads, prospects, greatest(leads - prospects, 0) invalid from l, p""",
    "dash_email_kpis": """
        with a as (select count(*) actual from fact join jobs using (job_key) where event_type = 'SENT' and journey_type like 'J02%'
                   and event_timestamp::date between date '2024-01-03' and date '2024-01-20'),
        b as (select count(*) filter (rejection_reason = 'SUPPRESSED_PROSPECT') suppressed, count(*) filter (rejection_reason = 'FATAL_ERROR') fatal
              from blocked where rejected_at::date between date '2024-01-03' and date '2024-01-20')
        select actual + suppressed + fatal expected, actual, suppressed, fatal, suppressed + fatal unsent from a, b""",
    "dash_email_kpis_fallback": """
        with a as (select count(*) actual from fact where event_type = 'SENT' and event_timestamp::date between date '2024-01-03' and date '2024-01-20'),
        b as (select count(*) filter (rejection_reason = 'SUPPRESSED_PROSPECT') suppressed, count(*) filter (rejection_reason = 'FATAL_ERROR') fatal
              from blocked where rejected_at::date between date '2024-01-03' and date '2024-01-20')
        select actual + suppressed + fatal expected, actual, suppressed, fatal, suppressed + fatal unsent from a, b""",
    "dash_conversion_fallback": """
        with e as (select * from fact where event_timestamp::date between date '2024-01-10' and date '2024-01-11'),
        s as (select distinct subscriber_key k from e where event_type = 'SENT'), o as (select distinct subscriber_key k from e where event_type = 'OPEN'),
        c as (select distinct subscriber_key k from e where event_type = 'CLICK')
        select count(distinct c.k) high_count, count(distinct case when o.k is not null and c.k is null then s.k end) medium_count,
          count(distinct case when o.k is null then s.k end) low_count from s left join o on s.k = o.k left join c on s.k = c.k""",
    "dash_conversion": """
        with e as (select subscriber_key, count(*) filter (event_type='CLICK') c, count(*) filter (event_type='OPEN') o, count(*) filter (event_type='SENT') s
                   from fact where event_timestamp::date between date '2024-01-10' and date '2024-01-11' group by 1)
        select count(*) filter (c >= 1) high_count, count(*) filter (c = 0 and o >= 1) medium_count, count(*) filter (o = 0 and s >= 1) low_count from e""",
    "dash_segments": """
        with ps as (select master_patient_id, count(distinct case when event_type='CLICK' then job_id end) c, count(distinct case when event_type='OPEN' then job_id end) o,
              count(distinct case when event_type='SENT' then job_id end) s, count(distinct case when event_type in ('BOUNCE','UNSUBSCRIBE') then job_id end) n
            from prospects left join fact on subscriber_key = master_patient_id and event_timestamp::date between date '2024-01-10' and date '2024-01-11'
            group by 1),
        t as (select count(*) filter (c >= 1) a, count(*) filter (c = 0 and o >= 2) b, count(*) filter (o <= 1 and s >= 1 and c = 0 and n = 0) d,
              count(*) filter (n >= 1 or (s >= 1 and o = 0 and c = 0)) e from ps)
        select '1 - High Engagement' segment, a prospects from t union all select '2 - Moderate Engagement', b from t
        union all select '3 - Low Engagement', d from t union all select '4 - At Risk', e from t""",
    "dash_segments_fallback": """
        with ps as (select master_patient_id, count(distinct case when event_type='CLICK' then job_id end) c, count(distinct case when event_type='OPEN' then job_id end) o,
              count(distinct case when event_type='SENT' then job_id end) s, count(distinct case when event_type in ('BOUNCE','UNSUBSCRIBE') then job_id end) n
            from prospects left join fact on subscriber_key = master_patient_id and event_timestamp::date between date '2024-01-10' and date '2024-01-11'
            group by 1),
        t as (select count(*) filter (c >= 1) a, count(*) filter (c = 0 and o >= 2) b, count(*) filter (o <= 1 and s >= 1 and c = 0 and n = 0) d,
              count(*) filter (n >= 1 or (s >= 1 and o = 0 and c = 0)) e from ps)
        select '1 - High Engagement' segment, a prospects from t union all select '2 - Moderate Engagement', b from t
        union all select '3 - Low Engagement', d from t union all select '4 - At Risk', e from t""",
    "daily_trend": """
        select coalesce(l.dt, p.dt) dt, coalesce(leads, 0) leads, coalesce(prospects, 0) prospects
        from (select lead_date dt, count(*) leads from leads where lead_date is not null and upper(channel) = '5-LOW' group by 1) l
        full outer join (select file_date dt, count(*) prospects from prospects where upper(channel) = '5-LOW' group by 1) p on l.dt = p.dt""",
    **{f"intake_trend_{g}": f"""
        select coalesce(l.period, p.period) period, coalesce(leads, 0) leads, coalesce(prospects, 0) prospects, coalesce(leads, 0) - coalesce(prospects, 0) gap
        from (select date_trunc('{g}', lead_date)::date period, count(*) leads from leads where lead_date is not null group by 1) l
        full outer join (select date_trunc('{g}', file_date)::date period, count(*) prospects from prospects group by 1) p on l.period = p.period"""
       for g in ("day", "week", "month")},
    "run_summary": f"""
        select table_name, status, count(*) run_count, strftime(min(started_at), '%Y-%m-%d %H:%M:%S') earliest_run, strftime(max(completed_at), '%Y-%m-%d %H:%M:%S') latest_run
        from runs where started_at::date between {LO} and {HI} group by 1, 2""",
    "latest_runs": """
        with r as (select *, row_number() over (partition by pipeline_name order by started_at desc, run_id desc) rn from runs)
        select case pipeline_name when 'SP_LOAD_PHI_PROSPECT' then 'PHI Load' when 'SP_LOAD_BRONZE_PROSPECT' then 'Bronze Load' else 'Silver Load' end step,
          pipeline_name, status, coalesce(rows_loaded, 0) rows_loaded, coalesce(error_message, '') error_message, started_at, completed_at from r where rn = 1""",
    "rejects_since_silver": """
        with s as (select max(started_at) t from runs where pipeline_name = 'SP_LOAD_SILVER_PROSPECT'),
        g as (select rejection_reason reason, count(*) n from rejects, s where rejected_at >= t group by 1)
        select coalesce(sum(n), 0)::bigint dq_count, coalesce(string_agg(reason || ' = ' || n, ' | ' order by n desc, reason), 'No DQ rejections.') dq_summary from g""",
    # --- ad hoc ------------------------------------------------------------------------------
    "adhoc_top_channels": "select channel, count(*) leads from leads group by 1 order by 2 desc, 1 limit 5",
    "adhoc_prospects_by_state": "select state, count(*) prospects from prospects group by 1",
    "adhoc_distinct_emails": "select count(distinct email) distinct_emails from prospects",
    "adhoc_consent_by_channel": f"""
        select channel, count(*) leads, count(*) filter (patient_consent) consented, {_pct('count(*) filter (patient_consent)', 'count(*)', 2)} consent_pct
        from leads group by 1""",
    "adhoc_consented_via": "select record_id, master_patient_id, email, file_date from prospects where channel = '3-MEDIUM' and patient_consent",
    "adhoc_largest_drops": f"""
        with d as (select d "day", sum(l)::bigint leads, sum(p)::bigint prospects from (
              select lead_date d, 1 l, 0 p from leads where lead_date is not null union all select file_date, 0, 1 from prospects) group by 1)
        select "day", leads, prospects, leads - prospects gap, {_pct('(leads - prospects)', 'leads', 2)} drop_pct from d order by gap desc, "day" limit 10""",
    "adhoc_days_without_intake": """
        select x::date "day" from (select unnest(generate_series(min(file_date)::timestamp, max(file_date)::timestamp, interval 1 day)) x from prospects)
        where x::date not in (select file_date from prospects)""",
    "adhoc_compare_ranges": f"""
        with r as (select '1996-01-01..1996-01-31' period, date '1996-01-01' a, date '1996-01-31' b
                   union all select '1996-02-01..1996-02-29', date '1996-02-01', date '1996-02-29'),
        l as (select period, count(*) n from r join leads on lead_date between a and b group by 1),
        p as (select period, count(*) n from r join prospects on file_date between a and b group by 1)
        select period, l.n leads, p.n prospects, {_pct('p.n', 'l.n', 2)} conversion_pct from l join p using (period)""",
    "run_sql": "select event_type, count(*) n, sum(value) total from events group by 1",
    "table_profile": "\nunion all\n".join(
        f"""select '{t}' table_name, (select string_agg(column_name, ', ' order by column_index) from duckdb_columns() where table_name = '{t}') columns,
          count(*) row_count, least(count(*), 5)::integer sample_rows, null note from {t}""" for t in TABLES
    ) + "\nunion all select 'absent', null, null, null, 'Table not accessible or empty.'",
}


def oracle_sql() -> dict[str, str]:
    from .oracle_jobs import RAW_JOBS

    return {name: _sql(body) for name, body in {**RAW, **RAW_JOBS}.items()}
