
VIEWS = {
    "checks": """select run_no, agent_id, rung, status, evidence from (
        select cast(least(floor((day(ts) - 1) / 10), 2) as int) as run_no, user_id as agent_id, cast(1 + event_id % 7 as int) as rung,
            case event_type when 'purchase' then 'fail' when 'signup' then 'refused' when 'error' then 'error' else 'pass' end as status, props as evidence,
            row_number() over (partition by least(floor((day(ts) - 1) / 10), 2), user_id, event_id % 7 order by ts desc, event_id desc) as rn
        from {events}) x where rn = 1""",
    "snapshots": "select distinct cast(least(floor((day(ts) - 1) / 10), 2) as int) as run_no, user_id as agent_id, cast(floor(user_id / 7) as bigint) % 5 as owner from {events}",
    "runs": "select cast(least(floor((day(ts) - 1) / 10), 2) as int) as run_no, cast(least(floor((day(ts) - 1) / 10), 2) as int) % 2 as chain, min(ts) as started_at, max(ts) as finished_at from {events} group by cast(least(floor((day(ts) - 1) / 10), 2) as int)",
    "wide": "select run_no, agent_id, " + ", ".join(f"max(status) filter (where rung = {r}) as r{r}" for r in range(1, 8)) + ", max(evidence) filter (where rung = 4) as e4 from checks group by run_no, agent_id",
    "transfers": """select l_orderkey, l_linenumber, l_suppkey as payee, o_custkey as payer, cast(round(l_extendedprice * 100) as bigint) as value_raw, $[days|l_shipdate|1995-01-01] as block,
            365 + l_suppkey % 1500 as mint, l_suppkey % 13 = 0 as to_contract, l_partkey % 5 = 0 as x402, l_suppkey % 97 as agent,
            case when l_suppkey = 0 then 'burn_address' when o_custkey = l_suppkey then 'self_transfer' when c_nationkey = s_nationkey then 'owner_funding'
                when $[days|l_shipdate|1995-01-01] < 365 + l_suppkey % 1500 then 'pre_mint' else 'counted' end as verdict
        from {lineitem} join {orders} on l_orderkey = o_orderkey join {customer} on o_custkey = c_custkey join {supplier} on l_suppkey = s_suppkey""",
    "listings": "select page_id, url as resource, $HOST as host, page_id % 37 as payee, page_id % 3 as catalog, case when page_id % 4 = 0 then null else cast(page_id % 250 as bigint) end as amount from {pages}",
    "answers": """select page_id, case page_id % 6 when 0 then 'empty' when 1 then 'unsupported' when 2 then 'data' else 'http' end as scheme,
            case when page_id % 6 < 3 then null when page_id % 11 = 0 then 402 when page_id % 7 = 0 then 429 when page_id % 5 = 0 then 404 when page_id % 13 = 0 then null else 200 end as code,
            case when page_id % 17 = 0 then 'robots_disallowed' when page_id % 19 = 0 then 'ssrf_blocked: 10.0.0.1' when page_id % 23 = 0 then 'timeout' end as error, page_id % 29 <> 0 as permitted, page_id % 3 <> 0 as has_body from {pages}""",
    "files": """select p_partkey, case when p_size % 5 = 0 then null else p_name end as name, case when p_size % 7 = 0 then null else p_type end as description, case when p_size % 3 = 0 then null else p_brand end as image,
            case when p_size % 4 = 0 then 'absent' when p_size % 4 = 1 then 'empty' else 'present' end as services, case when p_size % 11 = 0 then null else p_partkey % 50 end as claimed_id, p_partkey % 40 as actual_id, p_size % 6 as chain, p_partkey % 10 as owner from {part}""",
    "gaps": """select p_partkey, owner, claimed_id, actual_id, concat_ws(',', case when name is null then 'name' end, case when description is null then 'description' end, case when image is null then 'image' end,
            case when services = 'absent' then 'services' when services = 'empty' then 'services_empty' end, case when claimed_id is null then 'registrations' end) as signature from files""",
    "docs": "select doc_id, text as name, lower(text) as body, source, lang, $[words|text] as words from {documents}",
}
