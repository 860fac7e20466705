"""SQL functions of a session (UDF-1, UDF-2): document_fields(body) of one document, run_findings(run) as a table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from muster.operators.documents import strict_parse
from muster.ship import ship


def register_document_fields(spark: SparkSession) -> None:
    """document_fields(body binary): struct<name, description, error>; errors are those of the projection, and never raised."""
    ship(spark)

    @F.pandas_udf("text string, parse_error string")
    def strict_json(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([strict_parse(b) for b in bodies], columns=["text", "parse_error"])

    spark.udf.register("strict_json", strict_json)
    doc, kind = "try_parse_json(strict_json(body).text)", "regexp_extract(schema_of_variant({0}), '^[A-Z]+', 0)"
    is_object = kind.format(doc) + " = 'OBJECT'"

    def text(name: str) -> str:
        value = f"try_variant_get({doc}, '$.{name}', 'variant')"
        return f"case when {is_object} and {kind.format(value)} = 'STRING' then nullif(trim(try_variant_get({doc}, '$.{name}', 'string')), '') end"

    error = f"coalesce(strict_json(body).parse_error, case when {doc} is null then 'bad_json' when not ({is_object}) then 'not_an_object' end)"
    spark.sql(f"""create or replace temporary function document_fields(body binary) returns struct<name: string, description: string, error: string>
        return named_struct('name', {text('name')}, 'description', {text('description')}, 'error', {error})""")


def register_run_findings(spark: SparkSession, checks: str, snapshots: str, run: str = "string") -> None:
    """run_findings(run): (finding, numerator, denominator) over two views: checks (run, agent_id, rung, status, evidence), snapshots
    (run, agent_id)."""
    n = lambda cond: f"count(case when {cond} then 1 end)"
    judged, r2, r7 = "r4 <> 'skipped'", "r2 = 'pass'", "r7 = 'pass'"
    spark.sql(f"""create or replace temporary function run_findings(asked {run}) returns table(finding string, numerator bigint, denominator bigint)
        return with agents as (select agent_id, {', '.join(f"max(case when rung = {r} then status end) as r{r}" for r in (2, 4, 5, 7))},
                max(case when rung = 4 then get_json_object(evidence, '$.services_status') in ('absent', 'empty') end) as bare from {checks} where run = asked group by agent_id),
            c as (select {n(judged + ' and bare')} as n1, {n(judged)} as d1, {n("r5 = 'unclaimed'")} as n2, {n("r4 = 'pass'")} as d2, {n(r7)} as n3, {n(f"{r7} and {r2}")} as n4, {n(r7 + ' and r2 is not null')} as d4,
                {n(f"r7 <> 'pass' and {r2}")} as n5, {n("r7 <> 'pass' and r2 is not null")} as d5 from agents),
            s as (select count(*) as d3 from {snapshots} where run = asked)
        select stack(5, 'services_absent_or_empty', n1, d1, 'registration_unclaimed', n2, d2, 'attested', n3, d3, 'attested_resolvable', n4, d4, 'unattested_resolvable', n5, d5) as (finding, numerator, denominator) from c cross join s""")
