"""The queries of the operators in this subpackage, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from muster.llm import op4_secrets, op6_quality, op9_url_filter, op13_divergence
from muster.llm.op1_sharding import op1_sharding
from muster.llm.op2_simhash import op2_simhash
from muster.llm.op3_bpe import op3_bpe
from muster.llm.op5_language_model import op5_language_model
from muster.llm.op7_decontaminate import op7_decontaminate
from muster.llm.op8_substrings import op8_substrings
from muster.llm.op10_lines import op10_lines
from muster.llm.op11_toxicity import op11_toxicity
from muster.llm.op12_alignment import op12_alignment

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_simhash": op2_simhash,
    "op3_bpe": op3_bpe,
    "op4_secrets": op4_secrets.op4_secrets,
    "op5_language_model": op5_language_model,
    "op6_quality": op6_quality.op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_substrings": op8_substrings,
    "op9_url_filter": op9_url_filter.op9_url_filter,
    "op10_lines": op10_lines,
    "op11_toxicity": op11_toxicity,
    "op12_alignment": op12_alignment,
    "op13_divergence": op13_divergence.op13_divergence,
}


def shard_sql(shards: int = 8) -> str:
    """The minimax cut in SQL: the list of running sums, a binary search by a recursive query, and a greedy pass nested in it."""
    last = "coalesce(list_max(list_filter(es, lambda e: e <= {0} + {1})), 0)"

    def greedy(source: str, capacity: str) -> str:
        for i in range(1, shards + 1):
            source = f"(select *, {last.format(f'p{i - 1}' if i > 1 else '0', capacity)} as p{i} from {source})"
        return source

    cuts = ", ".join(f"p{i}" for i in range(1, shards))
    shard = " + ".join(f"(e > p{i})::int" for i in range(1, shards))
    return f"""
    with recursive d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, strlen(coalesce(text, '')) + 1 as size from documents),
    g as (select t, min(doc_id) as first_id, sum(size)::bigint as bytes from d group by t),
    e as (select t, sum(bytes) over (order by first_id nulls first, sha256(t) rows unbounded preceding)::bigint as e from g),
    l as (select list(e order by e) as es, max(e) as total from e),
    s(lo, hi) as (select (total + {shards - 1}) // {shards}, total from l
        union all select case when p{shards} >= total then lo else mid + 1 end, case when p{shards} >= total then mid else hi end
        from {greedy('(select lo, hi, (lo + hi) // 2 as mid, es, total from s, l where lo < hi)', 'mid')}),
    c as (select {cuts} from {greedy('(select lo as cap, es from s, l where lo = hi)', 'cap')}),
    placed as (select doc_id, size, t, ({shard})::int as shard, e from d join e using (t), c)
    select doc_id, size::bigint as size, shard, row_number() over (partition by shard order by doc_id nulls first) - 1 as slot, 'bytes' as law, null::int as grown_shard, e as shard_bytes_end from placed"""


ORACLE_SQL: dict[str, str] = {
    "op4_secrets": op4_secrets.oracle(),
    "op6_quality": op6_quality.oracle(),
    "op9_url_filter": op9_url_filter.oracle(),
    "op13_divergence": op13_divergence.oracle(),
}
