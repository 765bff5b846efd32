"""DuckDB SQL for the pipeline operators."""

from __future__ import annotations

# One JSON text per refused lead, null fields left out.
_LEAD_JSON = """'{' || concat_ws(',', '"FIRST_NAME":"' || first_name || '"', '"LAST_NAME":"' || last_name || '"',
  '"EMAIL":"' || email || '"', '"PHONE_NUMBER":"' || phone_number || '"', '"CHANNEL":"' || channel || '"',
  '"FILE_DATE":"' || file_date_text || '"', '"STAGE":"PHI_LOAD"') || '}'"""

#: Event times as the raw files write them.
_EVENT_TEXT = """case event_id % 4 when 1 then strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ')
            when 2 then strftime(event_timestamp, '%-m/%-d/%Y %-I:%M:%S %p') when 3 then strftime(event_timestamp, '%Y-%m-%d %H:%M:%S+02:00')
            else strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') end"""
_IDENTITY = """i as (
  select upper(first_name) || '|' || upper(last_name) || '|' || lower(email) identity_key, min(first_name) first_name,
    min(last_name) last_name, min(lower(email)) email from checked where rejection_reason is null group by 1),
ids as (select *, 800 + row_number() over (order by identity_key) master_number from i)"""

_CHAIN = """c as (
  select *, lag(rowhash) over w prev from (
    select *, to_json([first_name, last_name, email, phone_number, coalesce(age, -1)::varchar, address, coalesce(apartment_no, '~'), city, state,
      zip_code, patient_consent::varchar, channel, is_active::varchar])::varchar rowhash from prospects)
  window w as (partition by master_patient_id order by file_date, phi_loaded_at, record_id)),
ch as (select * from c where prev is null or prev <> rowhash),
v as (select *, row_number() over w version_num, lead(file_date) over w nxt from ch
  window w as (partition by master_patient_id order by file_date, phi_loaded_at, record_id))"""

_DATE_COLUMNS = """cast(strftime(d, '%Y%m%d') as integer) date_key, d full_date, year(d)::integer "year", quarter(d)::integer "quarter",
  month(d)::integer "month", strftime(d, '%B') month_name, week(d)::integer week_of_year, day(d)::integer day_of_month,
  dayofweek(d)::integer day_of_week, strftime(d, '%a') day_name, dayofweek(d) in (0, 6) is_weekend"""

_CHANNELS = """chan as (
  select channel_key, channel_name, case when channel_name in ('Instagram','Facebook','Website','Campaign App','Referral','Survey')
      and channel_name in (select channel from prospects) then 'Digital' else cat end channel_category
  from (values (1,'Instagram','Social Media'),(2,'Campaign App','Web Campaign'),(3,'Facebook','Social Media'),(4,'Website','Web Campaign'),(5,'Referral','Referral'))
    t(channel_key, channel_name, cat)
  union all select 5 + row_number() over (order by channel), channel, 'Other' from (select distinct channel from prospects))"""
_GEO = """geo as (select row_number() over (order by city, state, zip_code) geo_key, city, state, zip_code, region from regions)"""
_PEOPLE = """people as (select *, row_number() over (order by master_patient_id) prospect_key from dim_prospect)"""

_ENGAGED = """ev as (
  select f.subscriber_key, f.job_id, date_trunc('second', event_timestamp) event_timestamp, event_type,
    case when event_type in ('SENT','OPEN','CLICK','BOUNCE') then 'example.com' end domain,
    case when event_type in ('OPEN','CLICK') then k % 2 = 0 end is_unique,
    case when event_type = 'CLICK' then concat('https://example.com/', k % 7) end click_url,
    case when event_type = 'BOUNCE' then case when k % 2 = 0 then 'Hard' else 'Soft' end end bounce_category,
    case when event_type = 'BOUNCE' then concat('type', k % 3) end bounce_type,
    case event_type when 'UNSUBSCRIBE' then reason when 'SPAM' then 'abuse' end reason,
    '1' account_id, event_type record_type, concat('file_', event_id % 4) source_file_name
  from fact f
  union all
  select prospect_id, null, loaded, 'SUPPRESSED', null, null, null, null, null, 'SUPPRESSION_FLAG=YES', null, 'SUPPRESSION', concat('journey_', uid % 3)
  from journey where suppressed),
en as (
  select ev.*, d.master_patient_id, cast(substr(d.master_patient_id, 4) as bigint) prospect_key,
    cast(strftime(event_timestamp, '%Y%m%d') as integer) date_key,
    list_position(['SENT','OPEN','CLICK','BOUNCE','UNSUBSCRIBE','SPAM','SUPPRESSED'], event_type)::bigint event_type_key,
    event_type in ('UNSUBSCRIBE','SPAM','SUPPRESSED') or coalesce(j.suppressed, false) is_suppressed,
    case when event_type = 'UNSUBSCRIBE' then case when j.suppressed then 'SUPPRESSION_FLAG=YES' else 'UNSUBSCRIBE_EVENT' end
         when event_type = 'SPAM' then case when j.suppressed then 'SUPPRESSION_FLAG=YES' else 'SPAM_EVENT' end
         when j.suppressed then 'SUPPRESSION_FLAG=YES' end suppression_reason
  from ev left join dim_prospect d on d.master_patient_id = ev.subscriber_key left join journey j on j.prospect_id = ev.subscriber_key)"""

_MART = """bounced as (select distinct subscriber_key, job_id from fact where event_type = 'BOUNCE'),
ev as (
  select f.subscriber_key prospect_id, event_type, event_timestamp, date_key, journey_type, mapped_stage,
    (event_type in ('SENT','SUPPRESSED'))::integer is_expected_send, (event_type = 'SENT')::integer is_actual_send,
    (event_type = 'SENT' and b.job_id is null)::integer is_delivered, is_unique::integer is_unique_event, is_suppressed::integer is_suppressed_event, reason
  from fact f left join jobs using (job_key) left join bounced b on b.subscriber_key = f.subscriber_key and b.job_id = f.job_id
  union all
  select master_patient_id, 'LEAD', submission_timestamp, cast(strftime(file_date, '%Y%m%d') as integer), null, null, 0, 0, 0, 0, 0, null from prospects),
mart as (
  select ev.*, d.primary_channel, d.age_group, d.state, g.region, d.patient_consent
  from ev left join dim_prospect d on d.master_patient_id = ev.prospect_id
  left join regions g on g.city = d.city and g.state = d.state and g.zip_code = d.zip_code)"""

_FEATURES = """feat as (
  select d.master_patient_id, age, age_group, state,
    case when state in ('CT','ME','MA','NH','RI','VT','NJ','NY','PA') then 'Northeast'
      when state in ('IL','IN','IA','KS','MI','MN','MO','NE','ND','OH','SD','WI') then 'Midwest'
      when state in ('AL','AR','DE','FL','GA','KY','LA','MD','MS','NC','OK','SC','TN','TX','VA','WV','DC') then 'South'
      when state in ('AZ','CO','ID','MT','NV','NM','UT','WY','AK','CA','HI','OR','WA') then 'West' else 'Other' end region,
    primary_channel, patient_consent, intake_count, date_diff('day', last_intake_date, date '2024-02-01')::integer days_since_intake,
    date_diff('day', first_intake_date, last_intake_date)::integer intake_span_days,
    coalesce(sends, 0) sends, coalesce(opens, 0) opens, coalesce(clicks, 0) clicks, coalesce(bounces, 0) bounces, coalesce(unsubscribes, 0) unsubscribes,
    opens::double / nullif(sends, 0) open_rate, clicks::double / nullif(sends, 0) click_rate, (opens + 2 * clicks)::double / nullif(sends, 0) engagement_intensity,
    date_diff('day', last_event::date, date '2024-02-01')::integer days_since_event
  from dim_prospect d left join percounts p on p.subscriber_key = d.master_patient_id
  left join (select subscriber_key, max(event_timestamp) last_event from fact group by 1) l on l.subscriber_key = d.master_patient_id)"""


_DOCUMENT_VECTORS = """w as (select doc_id id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+')) w from documents),
        b as (select id, ('0x' || substr(md5(w), 1, 4))::integer % 128 h, count(*) n from w where w <> '' group by 1, 2),
        x as (select id, h from (select distinct id from b), range(128) r(h)),
        d as (select id, list(coalesce(n, 0)::double order by h) v from x left join b using (id, h) group by 1),
        """
_JOURNEY_VECTORS = _MART + """,
        p as (select journey_type jt, mapped_stage st, prospect_id, count(*) n, date_diff('day', min(event_timestamp)::date, max(event_timestamp)::date) as days,
            """ + ", ".join(f"count(*) filter (event_type = '{e}') c_{e}" for e in ("SENT", "OPEN", "CLICK", "BOUNCE", "UNSUBSCRIBE", "SPAM")) + """,
            sum(is_unique_event) u, sum(is_suppressed_event) sup from mart where journey_type is not null and mapped_stage is not null group by 1, 2, 3),
        ent as (select jt || '|' || st id, jt || ' ' || st t, [(jt like 'J01%')::integer::double, (jt like 'J02%')::integer, (jt like 'J03%')::integer, (jt like 'J04%')::integer,
            """ + ", ".join(f"sum(c_{e})::double / sum(n)" for e in ("SENT", "OPEN", "CLICK", "BOUNCE", "UNSUBSCRIBE", "SPAM")) + """,
            sum(u)::double / sum(n), sum(sup)::double / sum(n), ln(1 + sum(n)::double) / 20.0::double, sum(days)::double / count(*) / 30.0::double]::double[] v from p group by jt, st)"""
_ENGAGEMENT_VECTORS = """
        h as (select subscriber_key, count(*)::double n, count(*) filter (hour(event_timestamp) < 6) a, count(*) filter (hour(event_timestamp) between 6 and 11) b,
            count(*) filter (hour(event_timestamp) between 12 and 17) c, count(*) filter (hour(event_timestamp) >= 18) d from fact group by 1),
        ent as (select subscriber_key id, [sends / n, opens / n, clicks / n, bounces / n, unsubscribes / n, spam / n, coalesce(least(clicks::double / nullif(opens, 0), 1.0), 0.0),
          a / n, b / n, c / n, d / n]::double[] v from percounts join h using (subscriber_key))"""


def _nearest(vectors: str, ids: str, k: int, where: str = "true") -> str:
    """Brute force: every query against every entity, then the top k."""
    return f"""with {vectors},
s as (select q.id query_id, e.id id, round(list_dot_product(e.v, q.v) / sqrt(list_dot_product(e.v, e.v) * list_dot_product(q.v, q.v)), 6) score
  from ent e, ent q where q.id in ({ids}) and e.id <> q.id and {where})
select query_id, id, score from s where score is not null qualify row_number() over (partition by query_id order by score desc, id) <= {k}"""


def _hybrid(vectors: str, texts: str, words: str, ids: str, k: int, weight: float) -> str:
    """Brute force: cosine and weighted words of every entity, then the top k."""
    return f"""with {vectors},
words as (select id, unnest(string_split_regex(lower(t), '[^\\p{{L}}\\p{{N}}]+')) w from {texts}),
hits as (select w, id, count(*)::double n from words where w in ({words}) group by 1, 2),
rarity as (select w, ln(1 + ((select count(*) from ent)::double - count(*) + 0.5::double) / (count(*) + 0.5::double)) r from hits group by 1),
found as (select id, sum(r * n / (n + 1)) / (select sum(r) from rarity) f from hits join rarity using (w) group by 1),
s as (select q.id query_id, e.id id, round(list_dot_product(e.v, q.v) / sqrt(list_dot_product(e.v, e.v) * list_dot_product(q.v, q.v)) * (1 - {weight}::double)
    + coalesce(f, 0) * {weight}::double, 6) score
  from ent e join ent q on q.id in ({ids}) and e.id <> q.id left join found on found.id = e.id)
select query_id, id, score from s where score is not null qualify row_number() over (partition by query_id order by score desc, id) <= {k}"""


RAW_JOBS: dict[str, str] = {
    "validate_leads": "select lead_id, coalesce(rejection_reason, 'VALID') outcome from checked",
    "validate_leads_consent": """select coalesce(rejection_reason, case when not patient_consent then 'NO_CONSENT' end, 'VALID') outcome, count(*) n
        from checked group by 1""",
    "reject_log": f"""select lead_id, 'PHI_PROSPECT_MASTER' table_name, rejection_reason, {_LEAD_JSON} rejected_record, ordered rejected_at, lead_date,
        md5({_LEAD_JSON}) rejected_hash from checked where rejection_reason is not null""",
    "reject_log_delta": f"""
        with r as (select lead_id, rejection_reason, {_LEAD_JSON} j from checked where rejection_reason is not null)
        select lead_id, rejection_reason from r where not exists
          (select 1 from r d where d.rejection_reason <> 'NULL_EMAIL' and d.rejection_reason = r.rejection_reason and d.j = r.j)""",
    "reject_totals": """select 'PHI_PROSPECT_MASTER' table_name, rejection_reason, count(*) rejected_count from checked
        where rejection_reason is not null group by 2""",
    "resolve_identity": f"""
        with {_IDENTITY}
        select 'FIP' || lpad(cast(master_number as varchar), 10, '0') master_patient_id, master_number, identity_key, first_name, last_name, email from ids""",
    "master_prospects": f"""
        with {_IDENTITY},
        m as (select 'FIP' || lpad(cast(master_number as varchar), 10, '0') master_patient_id, c.first_name, c.last_name, lower(c.email) email, phone_number, age,
            address, apartment_no, city, state, zip_code, patient_consent, channel, submission_timestamp, lead_date file_date
          from checked c join ids on identity_key = upper(c.first_name) || '|' || upper(c.last_name) || '|' || lower(c.email) where rejection_reason is null)
        select md5(master_patient_id || '|' || file_date::varchar) record_id, *, true is_active from m
        qualify row_number() over (partition by master_patient_id, file_date order by submission_timestamp, channel, phone_number, age nulls first) = 1""",
    "append_bronze": "select record_id, master_patient_id, file_date, 'PHI_HUB' source_layer from prospects where state not in ('NY', 'TX')",
    "silver_quality": """
        with d as (select * replace (case when record_id::bigint % 21 = 0 then ' n/a ' else email end as email,
              case when record_id::bigint % 33 = 0 then ' ' else master_patient_id end as master_patient_id) from prospects),
        b as (select *, 0 later from d union all select *, 0 from d where record_id::bigint % 10 = 0 union all select *, 0 from d where record_id::bigint % 10 = 0
          union all select * replace (phi_loaded_at + interval 1 day as phi_loaded_at, 'later' as channel), 1 from d where record_id::bigint % 15 = 0),
        r as (select *, row_number() over (partition by record_id order by later) rn from b)
        select record_id, channel, case when trim(master_patient_id) = '' then 'NULL_MASTER_PATIENT_ID' when upper(trim(email)) = 'N/A' then 'NULL_EMAIL'
            when record_id::bigint % 7 = 0 then 'DUPLICATE_RECORD_ID' when rn > 1 then 'DUPLICATE_RECORD_ID_IN_BRONZE' else 'VALID' end outcome, count(*) n
        from r group by 1, 2, 3""",
    "scd2_silver": f"""
        with {_CHAIN}
        select record_id, master_patient_id, channel, patient_consent, file_date eff_start_date, coalesce(nxt, date '9999-12-31') eff_end_date, nxt is null is_current,
          version_num::integer version_num from v""",
    "scd2_increment": f"""
        with {_CHAIN}
        select record_id, master_patient_id, channel, patient_consent, file_date eff_start_date, coalesce(nxt, date '9999-12-31') eff_end_date, nxt is null is_current,
          version_num::integer version_num, file_date >= date '1998-01-01' is_new from v where coalesce(nxt, date '9999-12-31') >= date '1998-01-01'""",
    "merge_upsert": """
        with s as (select case when l_partkey % 5 = 0 then l_partkey + 10000000 else l_partkey end p_partkey, max(l_extendedprice) price, count(*)::integer n
          from lineitem group by 1)
        select coalesce(p.p_partkey, s.p_partkey) p_partkey, p_name, coalesce(n, p_size) p_size, coalesce(price, p_retailprice) p_retailprice
        from part p full outer join s on p.p_partkey = s.p_partkey""",
    "merge_insert_only": """
        with s as (select case when l_partkey % 5 = 0 then l_partkey + 10000000 else l_partkey end p_partkey, max(l_extendedprice) price, count(*)::integer n
          from lineitem group by 1)
        select coalesce(p.p_partkey, s.p_partkey) p_partkey, p_name, coalesce(p_size, n) p_size, coalesce(p_retailprice, price) p_retailprice
        from part p full outer join s on p.p_partkey = s.p_partkey""",
    "assign_keys": "select o_orderkey, o_orderdate, 800 + row_number() over (order by o_orderdate, o_orderkey) order_number from orders",
    "first_per_key": """select l_suppkey, l_orderkey, l_linenumber, l_extendedprice from lineitem
        qualify row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey) <= 3""",
    "calendar": f"""
        with r as (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day))::date d from orders)
        select {_DATE_COLUMNS} from r""",
    "dim_date_increment": f"""
        with r as (select distinct file_date d from prospects where year(file_date) >= 1998) select {_DATE_COLUMNS} from r""",
    "dim_channel": f"with {_CHANNELS} select * from chan",
    "dim_geography": f"with {_GEO} select * from geo",
    "dim_prospect": "select * from dim_prospect",
    "fact_intake": f"""
        with {_CHANNELS}, {_GEO}, {_PEOPLE}
        select record_id, p.master_patient_id, prospect_key, channel_key, cast(strftime(file_date, '%Y%m%d') as integer) date_key, geo_key, submission_timestamp,
          file_date, p.age, p.patient_consent::integer consent_flag
        from prospects p left join people d on d.master_patient_id = p.master_patient_id left join chan on channel_name = p.channel
        left join geo g on g.city = p.city and g.state = p.state and g.zip_code = p.zip_code where p.channel <> '5-LOW'""",
    "dim_job": """
        with m as (select f.job_id, case when k % 3 = 0 then '' else email_name end nm, concat('Subject ', k) subj from fact f join jobs j on j.job_key * 7 + 100 = f.job_id
            where event_type = 'SENT' qualify row_number() over (partition by f.job_id order by event_timestamp desc, event_id desc) = 1),
        d as (select f.job_id + 14 job_id, email_name nm, concat('Detail ', k) subj from fact f join jobs j on j.job_key * 7 + 100 = f.job_id
            where event_type = 'OPEN' and k % 5 <> 0 qualify row_number() over (partition by f.job_id order by event_timestamp desc, event_id desc) = 1),
        b as (select coalesce(m.job_id, d.job_id) job_id, coalesce(nullif(m.nm, ''), d.nm) email_name, coalesce(m.subj, d.subj) email_subject from m full outer join d on m.job_id = d.job_id)
        select row_number() over (order by b.job_id) job_key, b.job_id, journey_type, mapped_stage, b.email_name, email_subject, 'JOB' record_type
        from b left join jobs j on j.email_name = b.email_name""",
    "fact_engagement": f"""
        with {_ENGAGED}
        select subscriber_key, master_patient_id, prospect_key, case when job_id <> 163 then (job_id - 100) // 7 end job_key, event_type_key, date_key, job_id, event_timestamp, event_type,
          domain, is_unique, click_url, bounce_category, bounce_type, reason, account_id, record_type, source_file_name, is_suppressed, suppression_reason from en""",
    "events_through_layers": f"""
        with {_ENGAGED}
        select event_type, is_suppressed, suppression_reason, master_patient_id is not null known, count(*) events from en group by 1, 2, 3, 4""",
    "outbound_export": """
        select master_patient_id, email, count(*) over () rows_noted from dim_prospect
        where is_active and patient_consent and trim(email) <> '' and upper(trim(email)) <> 'N/A'""",
    "run_log": """
        select * from (values ('raw_events/sent', 'SUCCESS', 3, (select count(*) from fact where event_type = 'SENT')), ('raw_events/failing', 'FAILED', 1, 0),
          ('raw_events/sent', 'file SKIPPED', 1, null), ('raw_events/failing', 'file FAILED', 1, null)) t(target_table_name, status, runs, rows_loaded)""",
    "fact_engagement_increment": f"""
        with {_ENGAGED}
        select event_type, source_file_name, is_suppressed, suppression_reason, count(*) n from en where source_file_name not in ('file_0', 'file_1', 'journey_0') group by 1, 2, 3, 4""",
    "log_suppressions": """
        select 'FACT_SFMC_ENGAGEMENT' table_name, 'SUPPRESSED_PROSPECT' rejection_reason, '{"PROSPECT_ID":"' || prospect_id || '","SUPPRESSION_FLAG":"YES","_SOURCE_FILE_NAME":"journey_' || (uid % 3)
          || '","_SOURCE_ROW_NUMBER":"' || uid || '","STAGE":"SFMC_SUPPRESSION_DETECTION"}' rejected_record, loaded rejected_at from journey where suppressed""",
    "flag_suppressed": """
        select event_id, subscriber_key, is_suppressed or coalesce(suppressed, false) is_suppressed,
          case when suppressed and not is_suppressed then 'Prospect unsubscribed — journey suppression flag active' else suppression_reason end suppression_reason
        from fact left join journey on prospect_id = subscriber_key""",
    "journey_mart": f"with {_MART} select * from mart",
    "journey_mart_summary": f"""
        with {_MART}
        select coalesce(journey_type, 'Unknown Journey') journey_type, coalesce(mapped_stage, 'Unknown Stage') stage, event_type, coalesce(region, 'Unknown') region,
          count(*) observations, sum(is_expected_send)::bigint is_expected_send, sum(is_actual_send)::bigint is_actual_send, sum(is_delivered)::bigint is_delivered,
          sum(is_unique_event)::bigint is_unique_event, sum(is_suppressed_event)::bigint is_suppressed_event from mart group by 1, 2, 3, 4""",
    "integrity_checks": """
        with bounced as (select distinct subscriber_key, job_id from fact where event_type = 'BOUNCE'),
        f as (select count(*) filter (event_type='SENT') s, count(*) filter (event_type='BOUNCE') b, count(*) filter (event_type='OPEN') o, count(*) filter (event_type='CLICK') c,
            count(*) filter (event_type='OPEN' and is_unique) uo, count(*) filter (event_type='CLICK' and is_unique) uc,
            (select count(*) from fact a where event_type = 'SENT' and not exists (select 1 from bounced x where x.subscriber_key = a.subscriber_key and x.job_id = a.job_id)) d from fact),
        x as (select 'subscriber_identity_bridge_integrity' check_name, (select count(*) from fact where subscriber_key not in (select master_patient_id from dim_prospect)) violations
          union all select 'job_metadata_integrity', (select count(*) from fact where job_key is null)
          union all select 'date_key_integrity', 0 union all select 'engagement_type_integrity', 0
          union all select 'intake_null_email_rejection', (select count(*) from prospects where email is null or trim(email) = '')
            + greatest((select count(*) from leads where email is null or trim(email) = '') - (select count(*) from refused where j_email is null or trim(j_email) = ''), 0)
          union all select 'no_consent_rejection', (select count(*) from prospects where not coalesce(patient_consent, false))
          union all select 'suppression_observability', (select count(*) from journey where suppressed and prospect_id not in
            (select j_prospect from rejects where rejection_reason = 'SUPPRESSED_PROSPECT' and j_prospect is not null))
          union all select 'valid_lead_promoted_to_prospect', 0
          union all select 'lead_to_prospect_balance', case when (select count(*) from leads) >= (select count(*) from prospects) + (select count(*) from refused) then 0 else 1 end
          union all select 'send_balance', case when (select count(*) from stages where sent and sent_date is not null and stage_number <= 8)
            >= (select count(distinct (subscriber_key, job_id)) from fact where event_type = 'SENT' and job_id >= 114)
             + (select count(*) from blocked) then 0 else 1 end
          union all select 'delivery_balance', case when s >= d + b then 0 else 1 end from f
          union all select 'engagement_balance', case when d >= o and o >= uo then 0 else 1 end from f
          union all select 'click_balance', case when o >= c and c >= uc then 0 else 1 end from f)
        select check_name, violations, violations = 0 passed from x""",
    "prospect_360_features": f"with {_FEATURES} select * from feat",
    "send_time_features": """
        with e as (select subscriber_key, hour(event_timestamp)::integer h, dayofweek(event_timestamp)::integer d from fact where event_type in ('OPEN','CLICK')),
        hh as (select subscriber_key, h, count(*) n from e group by 1, 2 qualify row_number() over (partition by subscriber_key order by count(*) desc, h) = 1),
        dd as (select subscriber_key, d from e group by 1, 2 qualify row_number() over (partition by subscriber_key order by count(*) desc, d) = 1),
        t as (select subscriber_key, count(*) n from e group by 1)
        select subscriber_key, h best_hour, hh.n best_hour_events, t.n engagement_events, d best_weekday, hh.n::double / t.n confidence
        from hh join dd using (subscriber_key) join t using (subscriber_key)""",
    "send_time_profile": """
        select dayofweek(event_timestamp)::integer weekday, hour(event_timestamp)::integer "hour", count(*) filter (event_type='SENT') sends,
          count(*) filter (event_type='OPEN') opens, count(*) filter (event_type='CLICK') clicks from fact group by 1, 2""",
    "signal_trust": """
        with q as (select lower(trim(j_email)) email, count(*) n from refused where j_email is not null group by 1),
        x as (select j_prospect, count(*) n from rejects where rejection_reason = 'FATAL_ERROR' group by 1),
        s as (select subscriber_key, count(*) filter (is_suppressed) sup, count(*) filter (event_type = 'BOUNCE') b from fact group by 1),
        t as (select master_patient_id, coalesce(q.n, 0) dq_issues, coalesce(x.n, 0) fatal_errors, coalesce(sup, 0) suppressed_events, coalesce(b, 0) bounces
          from dim_prospect d left join q on q.email = d.email left join x on x.j_prospect = d.master_patient_id left join s on s.subscriber_key = d.master_patient_id)
        select *, (100 - (least(dq_issues * 10, 30) + case when suppressed_events > 0 then 40 else 0 end + case when fatal_errors > 0 then 20 else 0 end
          + least(bounces * 5, 10)))::double / 100.0 trust from t""",
    "similar_embeddings": _nearest("ent as (select vec_id id, embedding::double[] v from embeddings)", "0, 7, 42", 10),
    "similar_documents": _nearest(
        _DOCUMENT_VECTORS + """ent as (select id, v, upper(text) t from d join documents on doc_id = id)""", "1, 2, 3", 5,
        "(contains(e.t, 'ERROR') or contains(e.t, 'LICENSE') or contains(e.t, 'THE '))"),
    "similar_prospects": _nearest(_FEATURES + """,
        ent as (select master_patient_id id, [(region = 'Northeast')::integer::double, (region = 'Midwest')::integer::double, (region = 'South')::integer::double,
          (region = 'West')::integer::double, 0.0, patient_consent::integer::double, coalesce(age / 100.0, 0)::double,
          1.0 / (1.0 + greatest(days_since_intake, 0) / 365.0), coalesce(least(engagement_intensity, 5.0) / 5.0, 0)::double]::double[] v from feat)""",
        "'FIP0000000007', 'FIP0000000011'", 10),
    "similar_journeys": _nearest(_JOURNEY_VECTORS, "'J02_Nurture|Education Email 2'", 5, "(e.t like '%Nurture%' or e.t like '%Conversion%')"),
    "similar_rejections": _nearest("""
        g as (select table_name, rejection_reason r, coalesce(j_channel, 'none') ch, count(*) n from rejects group by 1, 2, 3),
        ent as (select table_name || '|' || r || '|' || ch id, [(r='NULL_FIRST_NAME')::integer, (r='NULL_LAST_NAME')::integer, (r='NULL_EMAIL')::integer, (r='NULL_PHONE_NUMBER')::integer,
          (r='INVALID_FILE_DATE')::integer, 0, (r='SUPPRESSED_PROSPECT')::integer, (r='FATAL_ERROR')::integer, 0, (r in ('SUPPRESSED_PROSPECT','FATAL_ERROR'))::integer,
          (ch='none')::integer, ln(1 + n) / 10.0]::double[] v from g)""", "'PHI_PROSPECT_MASTER|NULL_EMAIL|5-LOW'", 5),
    "similar_engagement": _nearest(_ENGAGEMENT_VECTORS, "'FIP0000000003', 'FIP0000000009'", 10),
    "similar_documents_hybrid": _hybrid(
        _DOCUMENT_VECTORS + "ent as (select id, v from d)", "(select doc_id id, text t from documents)",
        "'license', 'copy', 'of', 'the', 'software'", "1, 2, 3", 10, 0.5),
    "similar_journeys_hybrid": _hybrid(_JOURNEY_VECTORS, "ent", "'nurture', 'conversion'", "'J02_Nurture|Education Email 2'", 5, 0.25),
    "similar_embeddings_indexed": _nearest("ent as (select vec_id id, embedding::double[] v from embeddings)", "0, 7, 42", 10),
    "similar_engagement_indexed": _nearest(_ENGAGEMENT_VECTORS, "'FIP0000000003', 'FIP0000000009'", 10),
    "read_lead_csv": """
        select first_name, last_name, email, nullif(phone_number, '') phone_number,
          case when lead_id % 37 = 0 then 'n/a' when lead_id % 41 = 0 then concat(custkey % 60 + 15, '.6') else (custkey % 60 + 15)::varchar end age,
          address, apartment_no, city, lower(state) state, zip_code, consent_text patient_consent, channel,
          case when lead_id % 3 = 0 then strftime(submitted_exact, '%d-%m-%Y %H:%M') else strftime(submitted_exact, '%Y-%m-%d %H:%M:%S') end submission_timestamp,
          file_date_text file_date from leads""",
    "read_event_csv": f"""
        select '1' account_id, job_id, job_id + 100 batch_id, null::integer list_id, subscriber_key, {_EVENT_TEXT} event_date,
          'example.com' domain, 'SENT' record_type from fact where event_type = 'SENT'""",
    "load_new_files": f"""
        select '1' account_id, job_id, job_id + 100 batch_id, subscriber_key, {_EVENT_TEXT} event_date, 'example.com' domain,
          'SENT' record_type, (select count(*) from fact where event_type = 'SENT') audited_rows from fact where event_type = 'SENT'""",
    "stream_event_load": "select event_id, event_type, user_id, ts, value, props from events",
    "stream_late_events": """
        select event_id, ts, user_id, value,
          event_id % 2 = 1 and ts < (select max(ts) from events where event_id % 2 = 0) - interval 10 day is_late from events""",
    "stream_without_repeats": "select event_id, event_type, user_id, ts, value, props from events",
    "leads_through_layers": f"""
        with {_IDENTITY},
        m0 as (select master_number, lower(c.email) email, c.first_name, c.last_name, phone_number, age, address, apartment_no, city, state, zip_code, patient_consent, channel,
            submission_timestamp, lead_date file_date
          from checked c join ids on identity_key = upper(c.first_name) || '|' || upper(c.last_name) || '|' || lower(c.email) where rejection_reason is null
          qualify row_number() over (partition by master_number, lead_date order by submission_timestamp, channel, phone_number, age nulls first) = 1),
        c as (select *, lag(h) over (partition by master_number order by file_date) prev from (
            select *, to_json([first_name, last_name, email, phone_number, coalesce(age, -1)::varchar, address, coalesce(apartment_no, '~'), city, state, zip_code,
              patient_consent::varchar, channel])::varchar h from m0)),
        v as (select * from c where prev is null or prev <> h),
        a as (select master_number, count(*) intake_count, arg_min(channel, (submission_timestamp, md5('FIP' || lpad(cast(master_number as varchar), 10, '0') || '|' || file_date::varchar))) primary_channel from v group by 1)
        select email, channel channel_name, 'Other' channel_category, file_date, age, patient_consent::integer consent_flag, intake_count, primary_channel
        from v join a using (master_number)""",
}
