"""DuckDB texts for the queries of ``records``, written from the rules (by JSON functions that Spark's plans don't use)."""

from __future__ import annotations

from muster.operators.verdicts import DECLINED, PARENT
from muster.plans import census
from muster.plans.records import ANSWER, BODY, ITEM, PAID, PROBE, REGISTRY, SEEN, _PAYEE, _USDC

_DOCS = f"docs as (select p_partkey, p_partkey % 10 as owner, p_partkey % 40 as actual_id, p_size % 6 as chain, {BODY} as body from part), parsed as (select *, try_cast(body as json) as j from docs), good as (select * from parsed where j is not null)"
_IS = "coalesce(json_type({0}, '$.{1}'), 'NULL') <> 'NULL'"
_HAS = lambda k, v="j": _IS.format(v, k)
_ARRAY = f"case when {_HAS('services')} then case when json_type(j, '$.services') = 'ARRAY' then json_extract(j, '$.services') end when json_type(j, '$.endpoints') = 'ARRAY' then json_extract(j, '$.endpoints') end"
_LISTED = f"listed as (select *, {_ARRAY} as arr from good), each as (select * exclude (i), i - 1 as index, json_extract(arr, '$[' || (i - 1) || ']') as e from (select *, unnest(range(1, json_array_length(arr)::bigint + 1)) as i from listed where arr is not null))"
_TEXT = "case when json_type({0}, '$.{1}') = 'VARCHAR' then json_extract_string({0}, '$.{1}') end"
_KIND = """case when declared is null then 'missing' when declared ilike 'https://%' then 'https' when declared ilike 'http://%' then 'http' when declared ilike 'mailto:%' then 'email' else 'other' end"""
_ENDPOINTS = f"{_LISTED}, endpoints as (select p_partkey, index, {_TEXT.format('e', 'name')} as name, {_TEXT.format('e', 'endpoint')} as declared, {_KIND.replace('declared', '(' + _TEXT.format('e', 'endpoint') + ')')} as kind from each)"
_ADDRESS = "case when regexp_matches(trim({0}), '^0[xX][0-9a-fA-F]{{40}}$') then lower(trim({0})) end"
_WALLETS = f"""{_LISTED}, found as (select p_partkey, index, {_ADDRESS.format('coalesce(' + ', '.join(_TEXT.format('e', k) for k in ('address', 'endpoint', 'value')) + ')')} as wallet from each where {_TEXT.format('e', 'name')} = 'agentWallet'),
    wallets as (select p_partkey, list(wallet order by index) as w from found where wallet is not null group by p_partkey)"""


def _gaps(fields: tuple[str, ...]) -> list[str]:
    return [f"case when not ({_HAS(f)}) then '{f}' end" for f in fields]


def _joined(parts: list[str]) -> str:
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x is not null), ',')"


_STATUS = f"case when not ({_HAS('services')}) and not ({_HAS('endpoints')}) then 'absent' when coalesce(json_array_length(arr), 0) > 0 then 'present' else 'empty' end"
_NO_VERSION = f"exists (select 1 from each x where x.p_partkey = listed.p_partkey and not ({_HAS('version', 'x.e')}))"
_NO_REG = "coalesce(case when json_type(j, '$.registrations') = 'ARRAY' then json_array_length(j, '$.registrations') end, 0) = 0"
_REGS = "regs as (select * exclude (i), i - 1 as i, json_extract(j, '$.registrations[' || (i - 1) || ']') as r from (select *, unnest(range(1, json_array_length(j, '$.registrations')::bigint + 1)) as i from good where json_type(j, '$.registrations') = 'ARRAY'))"
_PARTS = "string_split(json_extract_string(r, '$.agentRegistry'), ':')"
_AGREE = f"""(case when json_type(r, '$.agentId') = 'UBIGINT' or json_type(r, '$.agentId') = 'VARCHAR' and regexp_matches(json_extract_string(r, '$.agentId'), '^[0-9]+$') then (json_extract_string(r, '$.agentId')::hugeint = actual_id)::int else 0 end
    + case when json_type(r, '$.agentRegistry') = 'VARCHAR' and len({_PARTS}) = 3 then ({_PARTS}[1] = 'eip155')::int + coalesce((try_cast({_PARTS}[2] as hugeint) = chain)::int, 0) + (lower({_PARTS}[3]) = '{REGISTRY}')::int else 0 end)"""
_CHAIN = f"case when json_type(r, '$.agentRegistry') = 'VARCHAR' and len({_PARTS}) = 3 then try_cast({_PARTS}[2] as hugeint)::varchar end"
_PROBED = f"urls as (select distinct declared as url, regexp_extract(declared, '([0-9]+)$', 1) as n from endpoints where kind in ('http', 'https')), probes as (select url, {PROBE['http_status'].replace('$1', 'n')} as code, {PROBE['error'].replace('$1', 'n')} as error from urls where n::int % 17 > 0)"
_SAID = f"case when p.url is null then null when error is not null then case when starts_with(error, 'robots_') then 'refused' when starts_with(error, 'ssrf_blocked: ') then 'not_live' else 'our_error' end when code between 200 and 299 or code = 402 then 'live' when code in {DECLINED} then 'refused' when code is not null then 'not_live' else 'our_error' end"
_V = "case when p_partkey % 4 = 1 then concat('0x', repeat('0', 40)) when p_partkey % 4 > 1 then concat('0X', lpad((p_partkey % 11)::varchar, 40, 'A')) end"

# -- catalogs and quotes -------------------------------------------------------------------------------------------

_ITEMS = f"""bodies as (select page_id, url, {ITEM} as body from pages), p as (select *, try_cast(body as json) as j from bodies), items as (select page_id, json_extract(j, '$.items[0]') as item, {_TEXT.format("json_extract(j, '$.items[0]')", 'resource')} as resource from p where j is not null),
    raw as (select page_id, resource, unnest(json_extract(item, '$.accepts[*]')) as a from items where resource is not null),
    offers as (select distinct page_id, resource, coalesce({_TEXT.format('a', 'payTo')}, {_TEXT.format('a', 'recipient')}) as pay_to, coalesce({_TEXT.format('a', 'network')}, '') as network, coalesce(json_extract_string(a, '$.amount'), json_extract_string(a, '$.maxAmountRequired')) as amount, {_TEXT.format('a', 'asset')} as asset from raw),
    named as (select * from offers where pay_to is not null)"""
_U64 = "{0} <= 18446744073709551615"
_QUOTES = f"""bodies as (select page_id, {_PAYEE} as seller, {ANSWER} as body from pages), p as (select *, try_cast(body as json) as j from bodies),
    asked as (select page_id, seller, i - 1 as i, json_extract(j, '$.accepts[' || (i - 1) || ']') as a from (select *, unnest(range(1, json_array_length(j, '$.accepts')::bigint + 1)) as i from p where j is not null and json_type(j, '$.accepts') = 'ARRAY')),
    read as (select page_id, seller, i, json_extract_string(a, '$.scheme') as scheme, json_extract_string(a, '$.network') as network, json_extract_string(a, '$.maxAmountRequired') as am, lower(json_extract_string(a, '$.asset')) as asset, lower(json_extract_string(a, '$.payTo')) as pay_to from asked),
    judged as (select *, case when scheme is null then 'scheme' when network is null then 'network' when am is null or not regexp_matches(am, '^[0-9]+$') then 'maxAmountRequired' when asset is null then 'asset' when pay_to is null or pay_to = concat('0x', repeat('0', 40)) then 'payTo' end as missing,
        case when regexp_matches(am, '^[0-9]+$') then case when ltrim(am, '0') = '' then '0' else ltrim(am, '0') end end as amount from read),
    mine as (select *, row_number() over (partition by page_id order by i) - 1 as k from judged where missing is null and pay_to = seller)"""
_NET = "case lower(network) when 'base' then 'eip155:8453' when 'base-sepolia' then 'eip155:84532' when 'solana' then 'solana:5eykt4UsFv8P8NJdTREpY1vzqKqZKvdp' else lower(network) end"
_REASON = """case when j is null then 'not_json' when coalesce(json_type(j, '$.accepts'), '') <> 'ARRAY' then 'no_accepts' when json_array_length(j, '$.accepts') = 0 then 'no_requirements'
    when (select count(*) from mine m where m.page_id = p.page_id) > 0 then null when (select count(*) from judged g where g.page_id = p.page_id and missing is not null) > 0 then 'incomplete_requirement' else 'not_this_sellers_pay_to' end"""
_CLAIM_NET = "case when page_id % 2 = 0 then 'eip155:8453' else 'solana:5eykt4UsFv8P8NJdTREpY1vzqKqZKvdp' end"
_CLAIM = f"case when page_id % 7 = 0 then null else (page_id % 250 * 997)::varchar end"

# -- calls ---------------------------------------------------------------------------------------------------------

_OWNER = "concat('0x', owner::varchar, 'Ab')"
_RUNG_LIST = "(select string_agg(c.rung || ':' || c.status, ',' order by c.rung, c.status) from checks c where c.run_no = {0}.run_no and c.agent_id = {0}.agent_id)"
_TRI = "list_distinct(flatten(list_transform(regexp_extract_all(lower(coalesce({0}, '')), '[\\p{{L}}\\p{{N}}]+'), lambda w: list_transform(range(1, len(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))"
_SIM = "round(coalesce(len(list_intersect({0}, {1}))::double / nullif(len({0}) + len({1}) - len(list_intersect({0}, {1})), 0), 0), 9)"
_WORDS = "regexp_extract_all(lower(coalesce({0}, '')), '[\\p{{L}}\\p{{N}}]+')"


def _near(q: str) -> str:
    return _SIM.format(_TRI.format("name"), _TRI.format(f"'{q}'"))


def _match(q: str) -> str:
    return f"(list_has_all(list_concat({_WORDS.format('name')}, {_WORDS.format('description')}), {_WORDS.format(chr(39) + q + chr(39))}) or {_near(q)} >= 0.3 or starts_with(lower(owner_text), '{q}'))"


_NAMED = f", named as (select s.run_no, s.agent_id, (s.run_no % 2)::varchar as chain, {_OWNER} as owner_text, d.source as name, d.name as description from snapshots s left join docs d on d.doc_id = s.agent_id)"


def _call(body: str, needs: str) -> str:
    return census.full_text(body, needs, True)


_DELTA = """, a as (select * from checks where run_no = 0), b as (select * from checks where run_no = 2), f as (select a.rung, a.status as was, b.status as now, count(*) as agents from a join b using (agent_id, rung) where a.status <> b.status group by 1, 2, 3),
    x as (select distinct agent_id from a), y as (select distinct agent_id from b)
    select 2 as run, 0 as previous_run, true as method_changed, (select count(*) from x) as agents_before, (select count(*) from y) as agents_after, (select count(*) from y where agent_id not in (select agent_id from x)) as newly_registered,
    (select count(*) from x where agent_id not in (select agent_id from y)) as disappeared, (select string_agg(rung || ':' || was || ':' || now || ':' || agents, ',' order by rung, was, now) from f) as flips,
    (select coalesce(sum(agents), 0)::bigint from f where rung = 2 and now = 'pass' and was = 'fail') as newly_resolving, (select coalesce(sum(agents), 0)::bigint from f where rung = 2 and was = 'pass' and now = 'fail') as stopped_resolving,
    (select coalesce(sum(agents), 0)::bigint from f where rung = 2 and 'refused' in (was, now)) as rung2_declined, (select coalesce(sum(agents), 0)::bigint from f where rung = 2 and 'refused' not in (was, now) and 'error' in (was, now)) as rung2_errored"""
_FIND = """, w as (select run_no, agent_id, max(status) filter (where rung = 2) as r2, max(status) filter (where rung = 4) as r4, max(status) filter (where rung = 5) as r5, max(status) filter (where rung = 7) as r7 from checks group by 1, 2),
    n as (select run_no, 1 as k, 'services_absent_or_empty' as finding, 0 as numerator, count(*) filter (where r4 <> 'skipped') as denominator from w group by 1 union all select run_no, 2, 'registration_unclaimed', count(*) filter (where r5 = 'unclaimed'), count(*) filter (where r4 = 'pass') from w group by 1
    union all select w.run_no, 3, 'attested', count(*) filter (where r7 = 'pass'), (select count(*) from snapshots s where s.run_no = w.run_no) from w group by 1 union all select run_no, 4, 'attested_resolvable', count(*) filter (where r7 = 'pass' and r2 = 'pass'), count(*) filter (where r7 = 'pass' and r2 is not null) from w group by 1
    union all select run_no, 5, 'unattested_resolvable', count(*) filter (where r7 <> 'pass' and r2 = 'pass'), count(*) filter (where r7 <> 'pass' and r2 is not null) from w group by 1)
    select run_no as run, finding, numerator, denominator, round(numerator * 100.0::double / nullif(denominator, 0), 6) as percent from n"""

ORACLE_SQL = {
    "parseable_flags": f"""with {_DOCS} select p_partkey, case when j is null then 'fail' else 'pass' end as status, case when j is null then 'bad_json' end as reason, nullif(trim({_TEXT.format('j', 'name')}), '') as doc_name, nullif(trim({_TEXT.format('j', 'description')}), '') as doc_description,
        case when j is null then 'bad_json' when json_type(j) <> 'OBJECT' then 'not_an_object' end as doc_error from parsed""",
    "conformant_gaps": f"""with {_DOCS}, {_LISTED} select p_partkey, {_joined([*_gaps(('type', 'name', 'description', 'image')), f"case {_STATUS} when 'absent' then 'services' when 'empty' then 'services_empty' end", f"case when {_NO_VERSION} then 'services[].version' end", f"case when {_NO_REG} then 'registrations' end"])} as should,
        {_joined(_gaps(('x402Support', 'active', 'supportedTrust')))} as may, {_STATUS} as services_status, case when {_HAS('services')} then 'services' when {_HAS('endpoints')} then 'endpoints' else 'neither' end as services_source from listed""",
    "conformant_must": f"""with {_DOCS}, {_REGS}, bad as (select p_partkey, i, 0 as k, 'registrations[' || i || '].agentId' as m from regs where not ({_HAS('agentId', 'r')}) union all select p_partkey, i, 1, 'registrations[' || i || '].agentRegistry' from regs where not ({_HAS('agentRegistry', 'r')})),
        b as (select p_partkey, string_agg(m, ',' order by i, k) as must from bad group by p_partkey) select p_partkey, case when must is null then 'pass' else 'fail' end as status, coalesce(must, '') as must, (select count(*) from regs where regs.p_partkey = good.p_partkey) as registrations_checked from good left join b using (p_partkey)""",
    "bound_best_entry": f"""with {_DOCS}, {_REGS}, scored as (select p_partkey, i, {_AGREE} as score, {_CHAIN} as declared_chain from regs), best as (select *, row_number() over (partition by p_partkey order by score desc, i) as n from scored)
        select good.p_partkey, case when best.i is null then 'unclaimed' when score = 4 then 'pass' else 'fail' end as status, best.i as entry, score::bigint as score, declared_chain from good left join best on best.p_partkey = good.p_partkey and n = 1""",
    "declared_endpoints": f"with {_DOCS}, {_ENDPOINTS} select p_partkey, index, name, declared, kind from endpoints",
    "live_from_rows": f"""with {_DOCS}, {_ENDPOINTS}, {_PROBED}, said as (select p_partkey, e.kind in ('http', 'https') as probeable, p.url is not null as probed, code, error, {_SAID} as said from endpoints e left join probes p on p.url = e.declared and e.kind in ('http', 'https')),
        n as (select l.p_partkey, count(s.p_partkey) as declared, coalesce(sum(probeable::int), 0)::bigint as probeable, coalesce(sum(probed::int), 0)::bigint as probed, {', '.join(f"coalesce(sum((said = '{w}')::int), 0)::bigint as {w}" for w in ('live', 'not_live', 'refused', 'our_error'))},
            coalesce(sum((said = 'live' and code = 402)::int), 0)::bigint as payment_gated from (select p_partkey from listed where arr is not null) l left join said s using (p_partkey) group by 1)
        select p_partkey, case when probeable = 0 then 'unprobeable' when live > 0 then 'pass' when not_live > 0 then 'fail' when refused > 0 then 'refused' else 'error' end as status,
            case when declared = 0 then 'no_services_declared' when probeable = 0 then 'no_probeable_endpoint' end as reason, declared, probeable, probed, live, not_live, refused, our_error, payment_gated from n where probeable = 0 or probed > 0""",
    "declared_targets": f"""with {_DOCS}, {_WALLETS}, base as (select p_partkey, w, {_V} as v, concat('0x', lpad((p_partkey % 9)::varchar, 40, 'a')) as own from good left join wallets using (p_partkey)),
        firsts as (select p_partkey, min(i) - 1 as i, address from (select p_partkey, unnest(range(1, len(w) + 1)) as i, unnest(w) as address from base) group by p_partkey, address)
        select p_partkey, 'verified_wallet' as basis, lower(v) as address, null::bigint as declared_index, case when lower(v) = concat('0x', repeat('0', 40)) then 'wallet_unset' when lower(v) = own then 'wallet_equals_owner' end as ineligible from base where v is not null
        union all select p_partkey, 'declared_wallet', address, i, case when address = concat('0x', repeat('0', 40)) then 'burn_address' end from firsts union all select p_partkey, 'declared_wallet', '', null, 'no_declared_address' from base where w is null""",
    "x402_by_wallet": f"""with {_DOCS}, {_WALLETS} select case when not ({_HAS('x402Support')}) then 'absent' when json_type(j, '$.x402Support') <> 'BOOLEAN' then 'non_boolean' else json_extract_string(j, '$.x402Support') end as x402, w is not null as wallet, count(*) as n from good left join wallets using (p_partkey) group by 1, 2""",
    "document_shapes": f"""with {_DOCS}, s as (select owner, array_to_string(list_sort(json_keys(j)), ',') as shape, count(*) as n from good where json_type(j) = 'OBJECT' group by 1, 2) select owner, count(*) as shapes, max(n) as modal, sum(n)::bigint as n, round(max(n) * 100.0::double / sum(n), 6) as pct from s group by owner""",
    "catalog_listings": f"""with {_ITEMS} select 'bazaar' as catalog, pay_to, resource, network, case when ltrim(amount, '0') = '' then '0' else ltrim(amount, '0') end as claimed_amount, lower(asset) as claimed_asset from named""",
    "catalog_pages": f"""with {_ITEMS} select p.page_id, case when j is null then 'not_json' end as error, (j is not null)::bigint as items_seen, (j is not null and not exists (select 1 from named n where n.page_id = p.page_id))::bigint as items_unreadable, case when j is not null then p.page_id::varchar end as total from p""",
    "seller_quotes": f"""with {_QUOTES} select page_id, (select count(*) from mine m where m.page_id = p.page_id) as n, coalesce((select string_agg(network || '/' || amount || '/' || asset, ',' order by i) from mine m where m.page_id = p.page_id), '') as quotes, {_REASON} as reason,
        case when {_REASON} = 'incomplete_requirement' then (select min_by(missing, i) from judged g where g.page_id = p.page_id and missing is not null) end as missing from p""",
    "shop_decide": f"""with {_QUOTES}, priced as (select page_id, k, case when asset = lower('{_USDC}') and length(amount) <= 36 then (amount::hugeint + 9999) // 10000 end as cents from mine where {_NET} = 'eip155:8453'),
        best as (select page_id, k, cents, row_number() over (partition by page_id order by cents, k) as n from priced where cents <= 10)
        select p.page_id, case when (select count(*) from mine m where m.page_id = p.page_id) = 0 then 'no_quote' when (select count(*) from priced x where x.page_id = p.page_id) = 0 then 'out_of_scope_network' when b.k is not null then 'buy'
            when (select count(*) from priced x where x.page_id = p.page_id and cents > 10) > 0 then 'over_cap' else 'unpriced' end as decision, b.k as index, b.cents::bigint as cents from p left join best b on b.page_id = p.page_id and b.n = 1""",
    "seller_consistent": f"""with {_QUOTES}, c as (select *, {_NET} = {_CLAIM_NET} as same_net, asset = lower('{_USDC}') as same_asset, amount = {_CLAIM} as same_amount from mine),
        near as (select *, row_number() over (partition by page_id order by 2 * same_asset::int + same_net::int desc, k desc) as n from c)
        select p.page_id, case when n.k is null then 'skipped' when {_CLAIM.replace('page_id', 'p.page_id')} is null then 'unprobed' when exists (select 1 from c where c.page_id = p.page_id and same_net and same_asset and same_amount) then 'pass' else 'fail' end as status,
            case when n.k is null then 'rung_3_not_pass' when {_CLAIM.replace('page_id', 'p.page_id')} is null then 'nothing_claimed' when exists (select 1 from c where c.page_id = p.page_id and same_net and same_asset and same_amount) then null
                else concat_ws('+', case when not same_net then 'network' end, case when not same_asset then 'asset' end, case when not same_amount then 'amount' end) end as reason from p left join near n on n.page_id = p.page_id and n.n = 1""",
    "api_agents_facets": _call(f""", found as (select s.*, {_OWNER} as owner_text from snapshots s where run_no = 1 and exists (select 1 from checks c where c.run_no = 1 and c.agent_id = s.agent_id and status = 'fail') and exists (select 1 from checks c where c.run_no = 1 and c.agent_id = s.agent_id and rung = 2 and status = 'pass')
        and exists (select 1 from checks c where c.run_no = 1 and c.agent_id = s.agent_id and rung = 3 and status = 'pass')), cut as (select *, count(*) over () as total from found order by agent_id limit 20 offset 2)
        select '1' as chain, cut.agent_id, owner_text as owner, d.source as name, {_RUNG_LIST.format('cut')} as rungs, total from cut left join docs d on d.doc_id = cut.agent_id""", "snapshots checks docs"),
    "api_agents_search": _call(f"{_NAMED}, found as (select *, count(*) over () as total from named where run_no = 1 and {_match('src1')}) select chain, agent_id, owner_text as owner, name, {_RUNG_LIST.format('found')} as rungs, total from found order by {_near('src1')} desc, agent_id limit 500", "snapshots checks docs"),
    "api_search": _call(f"""{_NAMED}, found as (select *, row_number() over (partition by run_no order by {_near('0x1')} desc, chain, agent_id) as item, count(*) over (partition by run_no) as total from named where {_match('0x1')}), asked as (select * from (values (0, 2), (1, 0), (2, 1)) v(place, run))
        select place::bigint as place, run, coalesce(total, 0) as total, item, agent_id, name from asked left join found on run_no = run and item <= 5""", "snapshots docs"),
    "search_indexed": _call(f"""{_NAMED}, found as (select *, row_number() over (partition by run_no order by {_near('0x1')} desc, chain, agent_id) as item, count(*) over (partition by run_no) as total from named where {_match('0x1')}), asked as (select * from (values (0, 2), (1, 0), (2, 1)) v(place, run)),
        paged as (select *, count(*) over () as total from named where run_no = 1 and {_match('src1')} order by {_near('src1')} desc, agent_id limit 500)
        select 'search' as call, place::bigint as place, run, coalesce(total, 0) as total, item, agent_id, name from asked left join found on run_no = run and item <= 5
        union all select 'agents', null, 1, total, null, agent_id, name from paged""", "snapshots docs"),
    "api_tail": _call(f"select '0' as chain, agent_id, {_OWNER} as owner, (select count(*) from snapshots where run_no = 2 and agent_id % 3 <> 0 and owner = 2) as total from snapshots where run_no = 2 and agent_id % 3 <> 0 and owner = 2 order by agent_id limit 10 offset 1", "snapshots"),
    "api_tail_summary": _call("select c.chain, count(s.agent_id) as unswept, (select max(agent_id) from snapshots where (run_no % 2)::varchar = c.chain) as cursor from (values ('0'), ('1'), ('3')) c(chain) left join snapshots s on c.chain = '0' and s.run_no = 2 and s.agent_id % 3 <> 0 group by c.chain", "snapshots"),
    "api_delta": _call(_DELTA, "checks"),
    "api_rates": _call("select rung, string_agg(status || ':' || n, ',' order by status) as statuses from (select rung, status, count(*) as n from checks where run_no = 1 group by 1, 2) group by rung", "checks"),
    "api_findings": _call(_FIND, "checks snapshots"),
}


def _assembly() -> str:
    """The assembled ladder: every rung judged alone, then walked from rung 1 up."""
    good = f"judged4 as ({ORACLE_SQL['conformant_must']}), judged5 as ({ORACLE_SQL['bound_best_entry']})"
    sql = f"""with {good}, seen as (select p_partkey, try_cast({BODY} as json) is not null as parses, {', '.join(f'{e} as {c}' for c, e in SEEN.items())}, p_partkey % 3 > 0 as has_authors from part),
    s0 as (select p.p_partkey, case when owner = '0x1' then 'pass' else 'fail' end as r1, case when scheme = 'empty' then 'fail' when scheme = 'data' then case when error is null then 'pass' else 'error' end when error is not null then 'error' when http_status = 200 then 'pass' when http_status = 402 then 'refused' when http_status = 404 then 'fail' else 'error' end as r2,
        case when truncated then 'error' when parses then 'pass' else 'fail' end as r3, coalesce(j4.status, 'pass') as r4, coalesce(j5.status, 'unclaimed') as r5, case when owner = '0x1' then case when not has_reputation then 'error' when has_authors then 'pass' else 'fail' end end as r7 from seen p left join judged4 j4 using (p_partkey) left join judged5 j5 using (p_partkey)),
    s1 as (select *, case when r1 <> 'pass' then 1 end as k1, r1 as l1, null::int as b1 from s0)"""
    at = "s1"
    for r in (2, 3, 4, 5, 7):
        up = f"k{PARENT[r]}"
        sql += f", s{r} as (select *, case when r{r} is null then null when {up} is not null then {up} when r{r} <> 'pass' then {r} end as k{r}, case when r{r} is null then null when {up} is not null then 'skipped' else r{r} end as l{r}, case when r{r} is not null then {up} end as b{r} from {at})"
        at = f"s{r}"
    word = "case b{0} " + " ".join(f"when {r} then r{r}" for r in (1, 2, 3, 4)) + " end"
    return sql + " " + " union all ".join(f"select p_partkey, {r}::bigint as rung, l{r} as status, b{r}::bigint as because_rung, {word.format(r)} as because_status from s7 where l{r} is not null" for r in (1, 2, 3, 4, 5, 7))


ORACLE_SQL["ladder_assembly"] = _assembly()
ORACLE_SQL["paid_summary"] = census.full_text(
    PAID + """, h as (select address, count(distinct agent_id) > 1 as shared from paid group by 1), c as (select * from paid where verdict = 'counted'), a as (select token, agent_id, bool_and(shared) as every from c join h using (address) group by 1, 2),
    t as (select token, count(distinct address) as addresses, count(distinct agent_id) as agents, count(distinct case when x402 then agent_id end) as x402_agents, count(*) as transfers, count(*) filter (where is_contract) as n_contract, count(*) filter (where not is_contract) as n_eoa, count(*) filter (where is_contract is null) as n_unread,
        coalesce(sum(value_raw::hugeint) filter (where is_contract), 0)::hugeint as c_, coalesce(sum(value_raw::hugeint) filter (where not is_contract), 0)::hugeint as e_, coalesce(sum(value_raw::hugeint) filter (where is_contract is null), 0)::hugeint as u_ from c group by 1)
    select token, addresses, agents, x402_agents, transfers, n_contract, n_eoa, n_unread, c_::varchar as value_contract, e_::varchar as value_eoa, u_::varchar as value_unread, (select count(*) from a where a.token = t.token and every) as shared_agents,
        case when n_unread = 0 then round(c_::double * 100.0 / nullif(c_::double + e_::double, 0), 6) end as contract_pct from t""", "transfers", True)  # fmt: skip

#: FNV-1a by a fold over the bytes, in 128 bits modulo 2**64.
_FNV = "list_reduce(list_prepend(14695981039346656037::hugeint, list_transform(range(1, strlen(url) + 1), lambda i: ('0x' || substr(hex(encode(url)), 2 * i - 1, 2))::hugeint)), lambda h, b: (xor(h, b) * 1099511628211::hugeint) % 18446744073709551616::hugeint)"
ORACLE_SQL["fnv_host_budget"] = f"""with u as (select distinct url, lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) as host from pages), f as (select host, url, lpad(lower(hex({_FNV}::ubigint)), 16, '0') as fnv from u),
    r as (select *, row_number() over (partition by host order by fnv, url) as place from f) select host, url, fnv, place from r where place <= 5"""

#: Sellers by payee and host, 8 of a host asked; rungs 2 and 3 by what was seen, rung 7 by the claims of the very URL.
ORACLE_SQL["seller_probe"] = f"""with {_QUOTES}, o as (select page_id, url, {_PAYEE} as pay_to, lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) || ':' || (page_id % 3) as host, page_id % 23 > 0 as permitted,
        case when page_id % 17 = 0 then 'timeout' end as error, case when page_id % 13 = 0 then 429 when page_id % 7 = 0 then 200 else 402 end as code, page_id % 5 > 0 as has_body from pages),
    over_ as (select pay_to, host from (select pay_to, host, row_number() over (partition by host order by pay_to) as n from (select distinct pay_to, host from o)) where n > 8),
    s as (select o.*, {_REASON} as why, not permitted or error is not null or code in (401, 407, 429, 503) as stopped from o anti join over_ using (pay_to, host) join p on p.page_id = o.page_id),
    t as (select *, case when stopped then 'skipped' when code = 402 and has_body and why is null then 'pass' else 'fail' end as third from s),
    q as (select m.*, {_NET} = 'eip155:8453' as same_net, asset = lower('{_USDC}') as same_asset from mine m), c as (select {_PAYEE} as pay_to, url, (page_id % 250 * 997)::varchar as claimed from pages where page_id % 2 = 0),
    near as (select t.page_id, c.claimed, t.third, q.k, q.same_net, q.same_asset, q.amount = c.claimed as same_amount, row_number() over (partition by t.page_id, c.claimed order by 2 * q.same_asset::int + q.same_net::int desc, q.k desc) as n,
        bool_or(q.same_net and q.same_asset and q.amount = c.claimed) over (partition by t.page_id, c.claimed) as exact from t join c on c.pay_to = t.pay_to and c.url = t.url left join q on q.page_id = t.page_id and t.third = 'pass'),
    every as (select 2 as rung, case when not permitted then 'refused' when error is not null then 'error' when code in (401, 407, 429, 503) then 'refused' else 'pass' end as status, coalesce(error, case when not permitted or error is null and code in (401, 407, 429, 503) then 'declined' end) as reason from t
        union all select 3, third, case when stopped then 'rung_2_not_pass' when code <> 402 then 'http_' || code when not has_body then 'no_body' else why end from t
        union all select 7, case when k is null then 'skipped' when exact then 'pass' else 'fail' end, case when k is null then 'rung_3_not_pass' when not exact then coalesce(nullif(concat_ws('+', case when not same_net then 'network' end, case when not same_asset then 'asset' end, case when not same_amount then 'amount' end), ''), 'no_matching_requirement') end from near where n = 1
        union all select r, 'unprobed', 'host_budget' from over_, (values (2), (3)) v(r))
    select rung::bigint as rung, status, reason, count(*) as n from every group by 1, 2, 3"""
