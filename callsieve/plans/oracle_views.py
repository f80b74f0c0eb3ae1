"""DuckDB text of the domain tables, put in front of every check query as CTEs."""

from __future__ import annotations

VIEWS = {
    "ev": "select *, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "calls": """
select event_id as call_id,
  case when k < 60 then 'center-' || cast(k % 3 as varchar) else 'user-' || cast(user_id as varchar) end as phone_number,
  user_id, ts, cast(floor(value) as bigint) as call_duration_sec,
  ['TW','US','UK','JP','SG','AU','HK','DE'][cast(event_id % 8 as int) + 1] as caller_country,
  ['TW','TW','TW','HK','MM'][cast(k % 5 as int) + 1] as callee_country,
  case when k < 60 then event_type <> 'view' else event_type = 'error' end as is_voip,
  case when k < 60 then event_type <> 'click' else event_type = 'error' and k % 2 = 0 end as reported_as_scam,
  round(0.1 + (k % 30) / 10.0, 2)::double as weight,
  case when event_id % 50 = 0 then 'user-' || cast((user_id + 1) % 100 as varchar)
       else 'callee-' || cast(event_id % 97 as varchar) end as callee_number,
  'dev-' || cast(event_id % 5 as varchar) as device_fp,
  case when k % 10 = 9 then substr(md5(cast(event_id as varchar)), 1, 8) else '' end as sms_content_hash,
  ['investment','customs','romance','impersonation'][cast(k % 4 as int) + 1] as scam_category,
  event_id % 40 as reporter
from ev""",
    "complaints": """
select event_id as ticket_id,
  case when event_id % 97 = 0 then null when event_id % 89 = 0 then '555-555-5555'
       when k < 60 then '800-555-000' || cast(k % 3 as varchar)
       else cast(200 + user_id % 700 as varchar) || '-555-' || lpad(cast((user_id * 20 + k % 20) % 10000 as varchar), 4, '0')
  end as caller_id,
  case when event_id % 17 = 0 then 'not_a_date' when event_id % 101 = 0 then '01/01/1900'
       else strftime(ts - interval 7 year, '%m/%d/%Y') end as date_of_issue,
  case when event_id % 19 = 0 then 'noon-ish' when event_id % 23 = 0 then '25:00 pm' else strftime(ts, '%-I:%M %p') end
    as time_of_issue,
  case event_type when 'click' then 'Robocalls' when 'view' then 'Telemarketing (including do not call and spoofing)'
       when 'signup' then 'Indecency' when 'error' then 'Cramming (unauthorized charges on your phone bill)' end as issue,
  case when k % 4 = 0 then 'Prerecorded Voice' when k % 4 = 1 then 'Abandoned Calls' when k % 4 = 2 then 'Live Voice' end
    as call_type,
  case when k % 5 = 0 then 'Internet (VOIP)' when k % 5 = 1 then 'Wireless (cell phone/other mobile device)'
       when k % 5 = 2 then 'Wired' when k % 5 = 3 then 'VOIP Robocall' end as method,
  'S' || cast(event_id % 50 as varchar) as state, lpad(cast(event_id * 37 % 100000 as varchar), 5, '0') as zip,
  case when k % 3 = 0 then null when k % 3 = 1 then '800-555-0001' else '900-555-0000' end as advertiser
from ev""",
    "known_good_complaints": """
select o_orderkey as ticket_id,
  '3' || lpad(cast(o_custkey % 100 as varchar), 2, '0') || '-444-' || cast(o_custkey as varchar) as caller_id,
  lpad(cast(1 + o_orderkey % 12 as varchar), 2, '0') || '/' || lpad(cast(1 + o_orderkey % 28 as varchar), 2, '0') || '/2016'
    as date_of_issue,
  cast(8 + o_orderkey % 10 as varchar) || ':30' as time_of_issue,
  case when o_orderkey % 11 = 0 then 'Robocalls' when o_orderkey % 7 = 0 then 'Telemarketing' end as issue,
  case when o_orderkey % 3 = 0 then 'Live Voice' end as call_type,
  case when o_orderkey % 2 = 0 then 'Wired' else 'Wireless' end as method,
  'S' || cast(o_custkey % 4 as varchar) as state, cast(null as varchar) as advertiser
from orders""",
    "reports": """
select event_id as report_seq, user_id % 40 as user_id, 'num-' || cast((user_id % 40) % 9 as varchar) as phone_number,
  ['investment','customs','romance','impersonation'][cast(k % 4 as int) + 1] as scam_category,
  epoch_us(ts) / 1000000 / 100 as t,
  case when user_id % 5 = 0 and event_id % 8 = 7 then 'RU' when event_id % 8 = 6 then 'SG' else 'TW' end as report_country,
  'TW' as registered_country
from ev where event_type in ('click', 'view')""",
    "validations": """
select event_id as seq, user_id % 40 as user_id, epoch_us(ts) / 1000000 / 100 as t,
  (event_type = 'purchase' or user_id % 3 = 0) as was_correct
from ev where event_type in ('purchase', 'error')""",
    "reporters": """
select distinct c_custkey % 40 as user_id, 'TW' as registered_country from customer where c_custkey % 40 % 4 <> 3""",
    "weighted_reports": """
select event_id as report_seq, 'num-' || cast(user_id as varchar) as phone_number,
  ['investment','customs','romance','impersonation'][cast(k % 4 as int) + 1] as scam_category,
  (case when user_id % 4 = 0 then 1.0 when k % 10 < user_id % 10 then 0.65 when k % 3 = 0 then 0.35 else 0.1 end)::double
    as user_weight
from ev where event_type = 'click' or user_id % 4 = 0 and event_type = 'view'""",
    "fraud": """
select cast(c_custkey as varchar) as Phone_Number,
  case when c_custkey % 31 = 0 then 'bad' else cast(n as varchar) end as Report_Count,
  case when c_custkey % 37 = 0 then null when c_custkey % 41 = 0 then '-5' else cast(loss as varchar) end as Financial_Loss,
  case when c_custkey % 29 = 0 then null else c_mktsegment end as Age_Group,
  'E' || cast(c_nationkey % 4 as varchar) as Education,
  case when c_custkey % 50 = 0 then 'C_POISON_BOT' when c_custkey % 11 = 0 then null else 'C_NORMAL' end as Cluster_ID,
  case when c_custkey % 43 = 0 then '2' when c_acctbal < 0 then '1' else '0' end as Label
from customer left join (select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as loss from orders group by 1) o
  on o_custkey = c_custkey""",
    "legacy_fraud": """
select event_id as Incident_ID, cast(ts as varchar) as Report_Time, 'p-' || cast(user_id as varchar) as Phone_Number,
  case when event_id % 29 = 0 then '機器人測試,auto' when event_id % 13 = 0 then null else event_type end as Tags,
  cast(k * 60 as varchar) as Report_Count, cast(round(value, 2) as varchar) as Transaction_Amount,
  case when k % 4 = 0 then 'senior' when k % 4 = 1 then 'adult' else 'student' end as Victim_Demographic,
  case when event_type = 'error' then '1' else '0' end as Is_Fraud
from ev""",
    "scores": """
select event_id, ts, user_id, ts < timestamp '2024-01-16' as is_baseline, least(value / 300.0, 1.0)::double as score,
  case when event_type = 'error' then 1 else 0 end as label
from events""",
    "arms": """
select 'exp-' || cast(1 + o_custkey % 3 % 2 as varchar) as experiment,
  case when o_custkey % 2 = 0 then 'control' else 'treatment' end as arm,
  case when o_orderstatus = 'F' then 1 else 0 end as hit,
  case when o_orderpriority = '1-URGENT' then 1 else 0 end as false_alarm,
  ((o_orderkey % 100) / 100.0)::double as reporter_score
from orders""",
}

NEEDS = {"calls", "complaints", "reports", "validations", "weighted_reports", "legacy_fraud"}


def over(names: str, body: str, **extra: str) -> str:
    """``body`` behind the CTEs of the named views (space separated), then extra CTEs in order."""
    wanted = names.split()
    if NEEDS & set(wanted) and "ev" not in wanted:
        wanted.insert(0, "ev")
    ctes = [f"{n} as ({VIEWS[n]})" for n in wanted] + [f"{n} as ({sql})" for n, sql in extra.items()]
    return "with recursive " + ",\n".join(ctes) + "\n" + body
