"""The census queries: name -> (views it needs, SQL)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from muster.functions import scalar
from muster.functions.dialect import write
from muster.operators import verdicts
from muster.plans.views import VIEWS

_W = {r: f"r{r}" for r in range(1, 8)}
_PCT = "round(cast({0} as double) * 100.0 / nullif({1}, 0), 6)"
_FINDINGS = """f as (select w.run_no, count(*) filter (where r4 is not null and r4 <> 'skipped') as d1, count(*) filter (where r4 is not null and r4 <> 'skipped' and cast($[json|e4|k] as int) % 3 = 0) as n1,
    count(*) filter (where r4 = 'pass') as d2, count(*) filter (where r5 = 'refused') as n2, count(*) filter (where r7 = 'pass') as n3,
    count(*) filter (where r7 = 'pass' and r2 is not null) as d4, count(*) filter (where r7 = 'pass' and r2 = 'pass') as n4, count(*) filter (where r7 <> 'pass' and r2 is not null) as d5, count(*) filter (where r7 <> 'pass' and r2 = 'pass') as n5
    from wide w group by w.run_no),
    s as (select run_no, count(*) as d3 from snapshots group by run_no),
    findings as (select run_no, 'services_absent_or_empty' as k, n1 as num, d1 as den from f union all select run_no, 'registration_unclaimed', n2, d2 from f union all select f.run_no, 'attested', n3, d3 from f join s on f.run_no = s.run_no
        union all select run_no, 'attested_resolvable', n4, d4 from f union all select run_no, 'unattested_resolvable', n5, d5 from f)"""
_PAIRS = """pairs as (select a.run_no as run_no, a.agent_id, a.rung, b.status as was, a.status as now from checks a join checks b on a.run_no = b.run_no + 1 and a.agent_id = b.agent_id and a.rung = b.rung)"""
_GAP_TOTALS = "per as (select signature, owner, count(*) as n from gaps group by signature, owner)"
_PAID = """reach as (select distinct payee, agent from transfers union select distinct payee, (payee + 1) % 97 from transfers where payee % 9 = 0),
    holders as (select payee, count(distinct agent) as n_agents from reach group by payee),
    paid as (select r.agent, t.payee, t.value_raw, t.to_contract, t.x402, n_agents > 1 as shared from transfers t join reach r on t.payee = r.payee join holders h on h.payee = r.payee where verdict = 'counted')"""

QUERIES: dict[str, tuple[str, str]] = {
    # rates and findings
    "rates": ("checks", "select run_no, rung, status, count(*) as n from checks group by run_no, rung, status"),
    "status_counts": ("checks", "select status, count(*) as n, count(distinct agent_id) as agents from checks group by status"),
    "rates_share": ("checks", f"select run_no, rung, status, count(*) as n, {_PCT.format('count(*)', 'sum(count(*)) over (partition by run_no, rung)')} as pct from checks group by run_no, rung, status"),
    "rates_multi_run_rollup": ("checks", f"select coalesce(cast(run_no as varchar(10)), 'all') as run, count(*) filter (where rung = 2 and status = 'pass') as num, count(*) filter (where rung = 2) as den, {_PCT.format('count(*) filter (where rung = 2 and status = {q}pass{q})'.format(q=chr(39)), 'count(*) filter (where rung = 2)')} as pct from checks group by rollup(run_no)"),
    "rates_by_inline": ("checks", "select run_no, case when cast($[json|evidence|k] as int) % 2 = 0 then 'inline' else 'network' end as kind, status, count(*) as n from checks where rung = 2 group by 1, 2, 3"),
    "findings": ("checks snapshots wide", f", {_FINDINGS} select run_no, k as finding, num, den from findings"),
    "findings_percent": ("checks snapshots wide", f", {_FINDINGS} select run_no, k as finding, {_PCT.format('num', 'den')} as pct from findings"),
    "evidence_extract": ("checks", "select run_no, agent_id, rung, cast($[json|evidence|k] as int) as k from checks where rung in (2, 4)"),
    "cross_tab_r7_r2": ("checks wide", "select run_no, r7, r2, count(*) as n from wide where r7 is not null and r2 is not null group by run_no, r7, r2"),
    # ladder and verdicts
    "ladder_propagation": ("checks wide", "select run_no, agent_id, " + ", ".join(f"{verdicts.laddered(r, _W)} as l{r}, cast({verdicts.stopper(r, _W)} as varchar(2)) as stop{r}" for r in range(1, 8)) + " from wide"),
    "ladder_counts": ("checks wide", "select run_no, " + ", ".join(f"count(*) filter (where {verdicts.laddered(r, _W)} = 'skipped') as skipped{r}" for r in range(2, 8)) + " from wide group by run_no"),
    "registered": ("snapshots", f"select run_no, agent_id, {verdicts.registered(f'''case when owner = 0 then '{scalar.ZERO}' else 'owner' end''')} as status from snapshots"),
    "resolvable": ("answers", f"select page_id, {verdicts.resolvable('scheme', 'code', 'error')} as status, {verdicts.resolvable_reason('scheme', 'code', 'error')} as reason from answers"),
    "rejudge_refused": ("answers", f"select cast(code as varchar(5)) as code, error, case when code = 200 then 'pass' when error is not null then 'error' else 'fail' end as old_status, {verdicts.rejudged('''(case when code = 200 then 'pass' when error is not null then 'error' else 'fail' end)''', 'code', 'error')} as new_status, count(*) as n from answers group by 1, 2, 3, 4"),
    "endpoint_kind": ("listings", f"select page_id, {scalar.endpoint_kind('''case page_id % 6 when 0 then resource when 1 then 'mailto:a@b.c' when 2 then 'eip155:1:0xab' when 3 then null when 4 then ' ' else 'x@y.z' end''')} as kind from listings"),
    "uri_scheme": ("listings", f"select page_id, {scalar.uri_scheme('''case page_id % 5 when 0 then resource when 1 then 'ipfs://abc/x' when 2 then 'data:,x' when 3 then '' else 'ftp://x' end''')} as scheme from listings"),
    "live_verdict": ("answers", f"select page_id % 40 as agent, {verdicts.live('''count(*) filter (where scheme = 'http')''', '''count(*) filter (where scheme = 'http' and page_id % 4 > 0)''', 'count(*) filter (where code between 200 and 299 or code = 402)', 'count(*) filter (where code = 404)', 'count(*) filter (where code = 429)')} as status from answers group by page_id % 40"),
    "attested_authors": ("checks", f"select run_no, agent_id, authors, {verdicts.attested('agent_id % 10 > 0', 'authors')} as status from (select run_no, agent_id, count(distinct case when rung > 3 then lower(status) end) as authors from checks group by run_no, agent_id) x"),
    # deltas
    "flips": ("checks", f", {_PAIRS} select run_no, rung, was, now, count(*) as agents from pairs where was <> now group by run_no, rung, was, now"),
    "flips_headline": ("checks", f", {_PAIRS} select run_no, count(*) filter (where was <> now) as flips, count(*) filter (where was <> now and was not in ('refused', 'error') and now not in ('refused', 'error')) as headline from pairs group by run_no"),
    "delta_series": ("checks", f", {_PAIRS}, a as (select distinct run_no, agent_id from checks), arrived as (select x.run_no, count(*) as n from a x left join a y on y.run_no = x.run_no - 1 and y.agent_id = x.agent_id where y.agent_id is null and x.run_no > 0 group by x.run_no), left_ as (select y.run_no + 1 as run_no, count(*) as n from a y left join a x on x.run_no = y.run_no + 1 and x.agent_id = y.agent_id where x.agent_id is null and y.run_no < 2 group by y.run_no + 1), p as (select run_no, count(*) filter (where rung = 2 and was = 'pass' and now = 'fail') as stopped_resolving, count(*) filter (where rung = 2 and was = 'fail' and now = 'pass') as newly_resolving from pairs group by run_no) select p.run_no, coalesce(arrived.n, 0) as newly_registered, coalesce(left_.n, 0) as disappeared, stopped_resolving, newly_resolving from p left join arrived on arrived.run_no = p.run_no left join left_ on left_.run_no = p.run_no"),
    "delta_all_runs_lag": ("runs", "select run_no, chain, cast(lag(run_no) over (partition by chain order by started_at) as varchar(5)) as previous_run from runs"),
    "delta_declined_errored": ("checks", f", {_PAIRS} select run_no, count(*) filter (where rung = 2 and (was = 'refused' or now = 'refused')) as declined, count(*) filter (where rung = 2 and was <> 'refused' and now <> 'refused' and (was = 'error' or now = 'error')) as errored from pairs where was <> now group by run_no"),
    "seller_delta_excluded": ("checks", f", {_PAIRS} select run_no, count(*) filter (where x = 'refused') as excluded_refused, count(*) filter (where x = 'error') as excluded_error, count(*) filter (where x = 'none') as counted from (select run_no, case when was = 'refused' or now = 'refused' then 'refused' when was = 'error' or now = 'error' then 'error' else 'none' end as x from pairs where was <> now) y group by run_no"),
    "method_changed": ("checks", "select run_no, rungs, coalesce(rungs <> lag(rungs) over (order by run_no), false) as changed from (select run_no, $[set|rung] as rungs from checks where rung <= 4 + run_no group by run_no) x"),
    # filters and pages
    "agents_scalar_filter": ("snapshots checks", "select s.run_no, s.agent_id, owner from snapshots s where s.owner = 2 and exists (select 1 from checks c where c.run_no = s.run_no and c.agent_id = s.agent_id and c.rung = 2 and c.status = 'pass')"),
    "agents_facets_and": ("snapshots checks", "select s.run_no, s.agent_id from snapshots s join (select run_no, agent_id from checks where (rung = 2 and status = 'pass') or (rung = 3 and status = 'pass') group by run_no, agent_id having count(*) = 2) f on f.run_no = s.run_no and f.agent_id = s.agent_id"),
    "agents_page": ("snapshots", "select run_no, agent_id, owner from snapshots where run_no = 1 order by agent_id limit 50 offset 50"),
    "agents_page_total": ("snapshots", "select a.agent_id, b.total from (select agent_id from snapshots where run_no = 1 order by agent_id limit 50) a cross join (select count(*) as total from snapshots where run_no = 1) b"),
    "latest_run": ("runs", "select chain, max_by(run_no, started_at) as run_no from runs group by chain"),
    "runs_list": ("runs", "select run_no, chain from runs order by started_at desc limit 2"),
    "runs_with_results": ("runs checks", "select run_no from runs r where exists (select 1 from checks c where c.run_no = r.run_no)"),
    "tail_unswept": ("snapshots", "select t.agent_id, t.owner from snapshots t left join (select agent_id from snapshots where run_no < 2) s on s.agent_id = t.agent_id where t.run_no = 2 and s.agent_id is null"),
    "heartbeat_stale": ("runs", "select chain, max(finished_at) < timestamp '2024-01-25 00:00:00' as stale from runs group by chain"),
    # search
    "search_tokens_and": ("docs", "select doc_id from docs where contains(body, 'the') and contains(body, 'of') and $[has|words|'the'] and $[has|words|'of']"),
    "search_owner_prefix": ("docs", "select doc_id, source from docs where left(source, 4) = 'src1'"),
    "search_per_run_top5": ("docs", "select source, doc_id, cast(rn as bigint) as rn from (select source, doc_id, row_number() over (partition by source order by length(name) desc, doc_id) as rn from docs where contains(body, 'la')) x where rn <= 5"),
    "search_totals": ("docs", "select source, count(*) as total from docs where contains(body, 'la') group by source"),
    # joins
    "left_join_documents": ("snapshots docs", "select s.run_no, s.agent_id, d.name from snapshots s left join docs d on d.doc_id = s.agent_id * 9"),
    "anti_resume": ("snapshots", "select a.agent_id from (select distinct agent_id from snapshots) a left join (select agent_id from snapshots where run_no = 0) b on a.agent_id = b.agent_id where b.agent_id is null"),
    "semi_has_results": ("transfers", "select s_suppkey from {supplier} where s_suppkey in (select payee from transfers where verdict = 'counted')"),
    "full_outer_reconcile": ("transfers", "select coalesce(a.payee, b.s_suppkey) as payee, coalesce(n, 0) as n, case when a.payee is null then 'absent' when n = expected then 'exact' when abs(n - expected) < 50 then 'close' else 'diverges' end as verdict from (select payee, count(*) as n from transfers group by payee) a full join (select s_suppkey, s_suppkey + 550 as expected from {supplier}) b on a.payee = b.s_suppkey"),
    "membership_union": ("transfers", "select c_custkey from {customer} where c_custkey in (select payee from transfers union select payer from transfers where verdict = 'self_transfer')"),
    # payments
    "payment_targets": ("snapshots", f"select run_no, agent_id, {verdicts.payment_target('''case agent_id % 4 when 0 then null when 1 then '0x000000000000000000000000000000000000dEaD' when 2 then 'own' else 'w' end''', '''(case when owner = 1 then 'OWN' else 'other' end)''')} as target from snapshots"),
    "transfer_classify": ("transfers", "select verdict, count(*) as n, cast(sum(value_raw) as bigint) as value_raw from transfers group by verdict"),
    "transfer_rules": ("transfers", f"select {verdicts.exclusion('''(case when l_linenumber % 7 = 6 then 'out' else 'in' end)''', 'cast(payer as varchar(20))', 'cast(payee as varchar(20))', 'cast(agent as varchar(20))', '(case when payee % 31 = 0 then null else mint end)', 'block')} as verdict, count(*) as n from transfers group by 1"),
    "payment_summary": ("transfers", f", {_PAID}, g as (select agent, payee, shared, bool_or(x402) as x402, count(*) as n, sum(case when to_contract then value_raw else 0 end) as c, sum(case when to_contract then 0 else value_raw end) as e from paid group by agent, payee, shared) select count(distinct payee) as addresses, count(distinct agent) as agents, count(distinct case when x402 then agent end) as x402_agents, cast(sum(n) as bigint) as n, cast(sum(c) as bigint) as contract_raw, cast(sum(e) as bigint) as eoa_raw, count(distinct agent) - count(distinct case when not shared then agent end) as all_shared from g"),
    "contract_share": ("transfers", f"select agent, case when count(*) filter (where payer % 100 = 0) > 0 then null else {_PCT.format('sum(case when to_contract then value_raw else 0 end)', 'sum(value_raw)')} end as pct from transfers where verdict = 'counted' group by agent"),
    "shared_address_histogram": ("transfers", f", {_PAID} select n_agents, count(*) as addresses from holders group by n_agents"),
    "premint_share": ("transfers", "select payee, bool_and(verdict = 'pre_mint') as all_before, count(*) as n from transfers group by payee"),
    "format_units": ("transfers", f"select l_orderkey, l_linenumber, value_raw, {scalar.format_units('cast(value_raw as varchar(30))', 6)} as shown, {scalar.format_units('''case when payee % 3 = 0 then 'x1' else '00' || cast(value_raw as varchar(30)) end''', 18)} as long_shown from transfers"),
    "paid_medians": ("transfers", "select verdict, percentile_cont(0.5) within group (order by value_raw) as median, percentile_cont(0.9) within group (order by value_raw) as p90 from transfers group by verdict"),
    "paid_means": ("transfers", "select agent, round(avg(cast(value_raw as double)), 4) as mean_value, min(value_raw) as least, max(value_raw) as most from transfers where verdict = 'counted' group by agent"),
    "x402_first_authorizer": ("transfers", "select l_orderkey, min_by(payee, l_linenumber * 100000 + payee) as first_payee from transfers where x402 group by l_orderkey"),
    "acquired_after": ("transfers", "select payee, count(*) filter (where block < last_counted) as before_last from (select payee, block, max(case when verdict = 'counted' then block end) over (partition by payee) as last_counted from transfers) x group by payee"),
    # sellers
    "seller_population": ("listings", "select payee, host, $[set|catalog] as catalogs, count(*) as listings, count(distinct resource) as resources from listings where payee > 0 group by payee, host"),
    "seller_rejects": ("listings", "select case when payee = 0 then 'zero_address' when host is null or host = '' then 'bad_url' when page_id % 41 = 0 then 'bad_scheme' else 'none' end as reason, count(*) as n from listings group by 1"),
    "seller_coverage": ("listings", "select catalog, count(distinct host) as hosts, count(distinct payee) as payees from listings group by catalog"),
    "seller_exclusive": ("listings", "select payee, min(catalog) as catalog from listings group by payee having count(distinct catalog) = 1"),
    "seller_reachable": ("answers", f"select page_id, {verdicts.seller_reachable('permitted', 'error', 'coalesce(code, 200)')} as reachable, {verdicts.seller_quotes('permitted', 'error', 'coalesce(code, 200)', 'has_body')} as quotes from answers"),
    "seller_settled": ("transfers", f"select payee, {verdicts.settled('count(*) filter (where payer % 7 > 0 and payer <> payee)')} as status, count(*) filter (where payer % 7 > 0 and payer <> payee) as payments, count(distinct case when payer % 7 > 0 and payer <> payee then payer end) as payers, count(*) filter (where payer % 7 = 0) as excluded_ours, count(*) filter (where payer % 7 > 0 and payer = payee) as excluded_self, min(case when payer % 7 > 0 and payer <> payee then block end) as first_block from transfers group by payee"),
    "seller_network_canon": ("listings", f"select page_id, {scalar.network('''case page_id % 5 when 0 then 'Base' when 1 then 'EIP155:8453' when 2 then ' solana ' when 3 then 'base-sepolia' else 'Other' end''')} as network from listings"),
    "seller_scope": ("listings", "select catalog, count(*) filter (where page_id % 5 < 2) as in_scope, count(*) filter (where page_id % 5 >= 2) as out_of_scope from listings group by catalog"),
    "addresses": ("listings", f"select page_id, {scalar.address('''case page_id % 3 when 0 then ' 0XABCDEFabcdef0123456789abcdefABCDEF01234567 ' when 1 then '0x12' else null end''')} as address from listings"),
    # sampling
    "host_budget_rank": ("listings", "select page_id, host, case when rn <= 5 then 'probed' else 'host_budget' end as verdict from (select page_id, host, row_number() over (partition by host order by payee, page_id) as rn from listings) x"),
    "md5_sample": ("listings", "select page_id from listings order by md5(resource), page_id limit 30"),
    "url_weights": ("listings", "select host, count(*) as declared, count(distinct resource) as urls from listings group by host"),
    # analysis
    "owner_concentration": ("snapshots", f"select owner, count(*) as agents, {_PCT.format('count(*)', 'sum(count(*)) over ()')} as pct from snapshots where run_no = 0 group by owner"),
    "signature_histogram": ("files gaps", "select signature, count(*) as n, count(distinct owner) as owners from gaps group by signature"),
    "signature_top_owner": ("files gaps", f", {_GAP_TOTALS} select signature, max(n) as top, sum_n as n, {_PCT.format('max(n)', 'sum_n')} as pct from (select *, cast(sum(n) over (partition by signature) as bigint) as sum_n from per) x group by signature, sum_n"),
    "modal_share": ("checks", f"select rung, max(n) as modal, cast(sum(n) as bigint) as n, {_PCT.format('max(n)', 'sum(n)')} as pct from (select rung, $[json|evidence|k] as k, count(*) as n from checks group by 1, 2) x group by rung"),
    "search_trigram_topk": ("docs", "select doc_id, sim from (select doc_id, round(cast(size_both as double) / (size_a + size_b - size_both), 6) as sim from (select doc_id, $[ntri|name] as size_a, $[ntri|'und der die'] as size_b, $[both|name|'und der die'] as size_both from docs) x) y where sim > 0 order by sim desc, doc_id limit 20"),
    "id_islands": ("snapshots", "select run_no, owner, min(agent_id) as first_id, max(agent_id) as last_id, count(*) as n from (select *, agent_id - row_number() over (partition by run_no, owner order by agent_id) as g from snapshots) x group by run_no, owner, g"),
    "endpoint_kind_hosts_cumulative": ("listings", "select host, n, cast(sum(n) over (order by n desc, host rows between unbounded preceding and current row) as bigint) as so_far from (select host, count(*) as n from listings group by host) x"),
    "feedback_percentiles": ("checks", "select run_no, percentile_cont(0.5) within group (order by k) as p50, percentile_cont(0.95) within group (order by k) as p95, min(k) as least, max(k) as most from (select run_no, cast($[json|evidence|k] as int) as k from checks) x group by run_no"),
    "wilson_interval": ("checks", "select run_no, n, k, round((p + 1.9207 / n - 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n), 6) as low, round((p + 1.9207 / n + 1.96 * sqrt(p * (1 - p) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n), 6) as high from (select run_no, cast(count(*) as double) as n, cast(count(*) filter (where status = 'pass') as double) as k, cast(count(*) filter (where status = 'pass') as double) / count(*) as p from checks where rung = 7 group by run_no) x"),
    "author_coverage_topk": ("transfers", "select count(*) as agents, count(*) filter (where any_top) as any_top, count(*) filter (where only_top) as only_top from (select payee, bool_or(top) as any_top, bool_and(top) as only_top from (select t.payee, k.payer is not null as top from transfers t left join (select payer from transfers group by payer order by count(*) desc, payer limit 10) k on k.payer = t.payer) y group by payee) x"),
    "distinct_per_chain": ("checks", "select coalesce(cast(rung as varchar(5)), 'all') as rung, count(distinct agent_id) as agents, count(distinct status) as statuses, count(distinct run_no) as runs from checks group by rollup(rung)"),
    "key_is_unique": ("transfers", "select count(*) as n, count(distinct l_orderkey) as orders, count(*) = count(distinct l_orderkey) as one_to_one from transfers"),
    "optional_field_groups": ("files", "select image as brand, count(*) as n, count(distinct owner) as owners from files group by image"),
    "sets_in_both": ("transfers", "select payee as id from transfers intersect select payer from transfers"),
    # archive and upserts
    "upsert_latest": ("checks", "select agent_id, rung, max_by(status, run_no) as status, max(run_no) as run_no from checks group by agent_id, rung"),
    "monotone_cursor": ("snapshots", "select coalesce(a.owner, b.owner) as owner, greatest(coalesce(a.c, 0), coalesce(b.c, 0)) as cursor from (select owner, max(agent_id) as c from snapshots where run_no = 0 group by owner) a full join (select owner, max(agent_id) as c from snapshots where run_no = 1 group by owner) b on a.owner = b.owner"),
    "supersede": ("snapshots", "select t.agent_id, max(s.run_no) as superseded_by from (select distinct agent_id from snapshots where run_no = 2) t left join snapshots s on s.agent_id = t.agent_id and s.run_no < 2 group by t.agent_id"),
    "tail_plan": ("snapshots", "select agent_id from (select distinct agent_id from snapshots where run_no = 2) x where agent_id > (select min(m) from (select owner, max(agent_id) as m from snapshots where run_no = 0 group by owner) y) order by agent_id limit 500"),
    "replace_rung6": ("checks", "select run_no, agent_id, rung, status from checks where rung <> 6 union all select run_no, agent_id, 6, 'unprobeable' from checks where rung = 6"),
    "rungs_attempted": ("checks", "select run_no, $[set|rung] as rungs from checks group by run_no"),
    "stream_dedup_batch": ("", "select user_id, event_type, count(*) as n from (select distinct user_id, event_type, cast(ts as date) as d from {events}) x group by user_id, event_type"),
}
def _ladder_oracle() -> str:
    """The ladder walked from rung 1 up, one step a query: k{r} is what stops a dependent of r (nothing where r has no row)."""
    sql, at = ", s1 as (select *, case when r1 <> 'pass' then 1 end as k1, r1 as l1, cast(null as int) as stop1 from wide)", "s1"
    for r in range(2, 8):
        up = f"k{verdicts.PARENT[r]}"
        sql += f", s{r} as (select *, case when r{r} is null then null when {up} is not null then {up} when r{r} <> 'pass' then {r} end as k{r}, case when r{r} is not null and {up} is not null then 'skipped' else r{r} end as l{r}, {up} as stop{r} from {at})"
        at = f"s{r}"
    return sql


#: DuckDB texts written from the rule instead of the Spark text.
ORACLES = {
    "ladder_propagation": _ladder_oracle() + " select run_no, agent_id, " + ", ".join(f"l{r}, cast(stop{r} as varchar) as stop{r}" for r in range(1, 8)) + " from s7",
    "ladder_counts": _ladder_oracle() + " select run_no, " + ", ".join(f"count(*) filter (where l{r} = 'skipped') as skipped{r}" for r in range(2, 8)) + " from s7 group by run_no",
}
#: Spark texts that do the work of QUERIES once: the trigrams of a text are an array that both counts read, and the filter stays above
#: the limit (rows of similarity 0 come last), for below it Spark would work the arrays out a second time.
SPARK_TEXTS = {
    "search_trigram_topk": "select doc_id, sim from (select doc_id, round(cast(size_both as double) / (size_a + size_b - size_both), 6) as sim from (select doc_id, size(g) as size_a, $[ntri|'und der die'] as size_b, size(array_intersect(g, $[tri|'und der die'])) as size_both from (select doc_id, $[tri|name] as g from docs) w) x order by sim desc, doc_id limit 20) y where sim > 0",
}
TABLES = re.compile(r"\{(\w+)\}")


def full_text(body: str, needs: str, duck: bool) -> str:
    """A query with the views that it needs before it; tables are {name} for Spark and bare for DuckDB."""
    parts = [f"{v} as ({VIEWS[v].replace('$HOST', scalar.host('url'))})" for v in needs.split()]
    sql = write(("with " + ", ".join(parts) if parts else "") + (body if body.startswith(", ") else " " + body), duck)
    return TABLES.sub(r"\1", sql) if duck else sql


def text(name: str, duck: bool) -> str:
    """The query's full SQL in one dialect."""
    needs, body = QUERIES[name]
    if duck and name in ORACLES:
        return full_text(ORACLES[name], needs, True)
    return full_text(body if duck else SPARK_TEXTS.get(name, body), needs, duck)


def run_text(body: str, needs: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = full_text(body, needs, False)
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(TABLES.findall(sql))})


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    needs, body = QUERIES[name]
    return run_text(SPARK_TEXTS.get(name, body), needs, spark, sf_dir)
