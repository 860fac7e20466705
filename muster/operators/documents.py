"""Registration documents: strict JSON, projections and the rungs 3 to 6 (S-DOC, S-ENDPTS, S-WALLETS, S-AGENTID, S-CAIP, VRD-3 to VRD-6b).

Only the strict parse is a Python function (Arrow batches): Spark's own parser takes trailing text, lone surrogates and
numbers without bound. What it returns is read as a variant by expressions. Each operator takes a frame with the variant
``doc`` (null where there is none) and adds columns.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions.scalar import DEAD, ZERO
from muster.functions.web import endpoint_kind, normal_address, unicode_trim
from muster.operators.verdicts import DECLINED, PAYMENT

#: Fields that a registration entry must have, that a document should and may have. (Fixed values.)
MUST = ("agentId", "agentRegistry")
SHOULD = ("type", "name", "description", "image")
MAY = ("x402Support", "active", "supportedTrust")
#: Objects and arrays may be nested so deep. (A fixed value.)
DEEPEST = 128
BOM = b"\xef\xbb\xbf"


def _refuse(word: str):
    raise ValueError(word)


def _finite(text: str) -> float:
    value = float(text)
    return value if value - value == 0 else _refuse(text)


def _whole(text: str) -> int | float:
    """An integer of 64 bits as it is, a larger one as the double next to it, which must be finite."""
    if len(text) <= 20 and -(1 << 63) <= (value := int(text)) < 1 << 64:
        return value
    return _finite(text)


def _depth(value) -> int:
    held, deepest = [(value, 1)], 0
    while held:
        v, n = held.pop()
        if isinstance(v, (dict, list)):
            deepest = max(deepest, n)
            held += [(x, n + 1) for x in (v.values() if isinstance(v, dict) else v)]
    return deepest


def strict_parse(body: bytes | None, strip_bom: bool = True) -> tuple[str | None, str | None]:
    """(the document as one JSON text without repeated keys, None) or (None, no_body | bad_utf8 | bad_json).

    The last of repeated keys counts. Trailing text, NaN, numbers beyond a double (of any notation), lone surrogates and deeper nesting
    are refused; an integer beyond 64 bits becomes a double."""
    if body is None:
        return None, "no_body"
    body = bytes(body)
    try:
        text = (body[3:] if strip_bom and body.startswith(BOM) else body).decode("utf-8")
    except UnicodeDecodeError:
        return None, "bad_utf8"
    try:
        value = json.loads(text, parse_constant=_refuse, parse_float=_finite, parse_int=_whole)
        out = json.dumps(value, ensure_ascii=False)
        out.encode("utf-8")
        return (out, None) if _depth(value) <= DEEPEST else (None, "bad_json")
    except (ValueError, RecursionError):
        return None, "bad_json"


def with_document(df: DataFrame, body: str = "body", strip_bom: bool = True) -> DataFrame:
    """``df`` with ``doc`` (variant) and ``parse_error`` (null where the body is strict JSON)."""

    @F.pandas_udf("text string, parse_error string")
    def parse(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([strict_parse(b, strip_bom) for b in bodies], columns=["text", "parse_error"])

    row = df.withColumn("_parsed", parse(F.col(body))).withColumn("_doc", F.try_parse_json("_parsed.text"))
    too_large = F.when(F.col("_doc").isNull() & F.col("_parsed.text").isNotNull(), "bad_json")  # no document stops a job
    return row.select(*df.columns, F.col("_doc").alias("doc"), F.coalesce("_parsed.parse_error", too_large).alias("parse_error"))


# -- reading a variant -------------------------------------------------------------------------------------------


def kind(v: Column) -> Column:
    """STRING, BIGINT, BOOLEAN, OBJECT, ARRAY, VOID ...; null where there is nothing."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def present(v: Column, name: str) -> Column:
    """The field is there and isn't null."""
    return field(v, name).isNotNull() & ~F.is_variant_null(field(v, name))


def text_of(v: Column, name: str) -> Column:
    """The field if it is a JSON string; no other type is turned into one."""
    return F.when(kind(field(v, name)) == "STRING", F.try_variant_get(v, f"$.{name}", "string"))


def entries(v: Column, name: str) -> Column:
    """The elements of the field if it is an array, else null."""
    return F.when(kind(field(v, name)) == "ARRAY", F.try_variant_get(v, f"$.{name}", "array<variant>"))


def unsigned(v: Column, name: str, most: int = (1 << 64) - 1) -> Column:
    """S-AGENTID: an unsigned integer, or a string of its digits (a plus sign is allowed), as a decimal; else null."""
    shape, whole = F.schema_of_variant(field(v, name)), F.try_variant_get(v, f"$.{name}", "string")
    number = shape.isin("BIGINT") | shape.rlike(r"^DECIMAL\((19|2\d|3\d),0\)$")  # fewer digits and a point: 5.0
    plain = F.when(kind(field(v, name)) == "STRING", whole.rlike(r"^\+?[0-9]+$")).otherwise(number & whole.rlike("^[0-9]+$"))
    value = F.when(plain, F.regexp_replace(whole, r"^\+?0*(?=[0-9])", ""))
    return F.when((F.length(value) <= 38) & (value.try_cast("decimal(38,0)") <= F.lit(str(most)).cast("decimal(38,0)")), value.try_cast("decimal(38,0)"))


# -- S-DOC and rung 3 ----------------------------------------------------------------------------------------------


def project_document(df: DataFrame) -> DataFrame:
    """S-DOC: ``doc_name``, ``doc_description`` and ``doc_error`` of a frame from ``with_document``."""
    doc = F.col("doc")
    error = F.when(F.col("parse_error").isNotNull(), F.col("parse_error")).when(kind(doc) != "OBJECT", "not_an_object")
    own = {f"doc_{n}": F.when(error.isNull(), F.nullif(F.trim(text_of(doc, n)), F.lit(""))) for n in ("name", "description")}
    return df.withColumns(own | {"doc_error": error})


def parseable(df: DataFrame, truncated: str = "truncated") -> DataFrame:
    """VRD-3: ``status`` and ``reason``."""
    cut = F.coalesce(F.col(truncated), F.lit(False))
    error = F.col("parse_error")
    return df.withColumns({
        "status": F.when(cut | (F.coalesce(error, F.lit("")) == "no_body"), "error").when(error.isNull(), "pass").otherwise("fail"),
        "reason": F.when(cut, "body_truncated").otherwise(error),
    })


# -- rungs 4 and 5 -------------------------------------------------------------------------------------------------


def services(doc: Column) -> dict[str, Column]:
    """Which field gives the services (``endpoints`` only where ``services`` is absent or null), their entries and status."""
    new, old = present(doc, "services"), present(doc, "endpoints")
    listed = F.when(new, entries(doc, "services")).when(old, entries(doc, "endpoints"))
    status = F.when(~new & ~old, "absent").when(F.size(listed) > 0, "present").otherwise("empty")
    return {"source": F.when(new, "services").when(old, "endpoints").otherwise("neither"), "entries": listed, "status": status, "both": new & old, "legacy": ~new & old}


def conformant(df: DataFrame) -> DataFrame:
    """VRD-4: ``status`` by what must be there, with ``must``, ``should`` and ``may`` (arrays of what is missing, in order),
    ``services_status``, ``services_source`` and ``registrations_checked``."""
    doc = F.col("doc")
    has, registered = services(doc), entries(doc, "registrations")

    def missing(entry: Column, i: Column) -> Column:
        return F.array_compact(F.array(*(F.when(~present(entry, f), F.concat(F.lit("registrations["), i, F.lit(f"].{f}"))) for f in MUST)))

    should = [F.when(~present(doc, f), F.lit(f)) for f in SHOULD]
    should.append(F.when(has["status"] == "absent", "services").when(has["status"] == "empty", "services_empty"))
    should.append(F.when(F.exists(has["entries"], lambda e: ~present(e, "version")), "services[].version"))
    should.append(F.when(F.coalesce(F.size(registered), F.lit(0)) <= 0, "registrations"))
    out = df.withColumns({
        "must": F.coalesce(F.flatten(F.transform(registered, missing)), F.array().cast("array<string>")),
        "should": F.array_compact(F.array(*should)),
        "may": F.array_compact(F.array(*(F.when(~present(doc, f), F.lit(f)) for f in MAY))),
        "services_status": has["status"], "services_source": has["source"], "registrations_checked": F.greatest(F.coalesce(F.size(registered), F.lit(0)), F.lit(0)),
    })
    return out.withColumn("status", F.when(F.size("must") == 0, "pass").otherwise("fail"))


def bound(df: DataFrame, agent_id: str, chain_id: str, registry: str) -> DataFrame:
    """VRD-5: ``status`` (pass, fail, unclaimed), ``entry`` (the best one, the first among equals), ``score`` and
    ``declared_chain``, given what is on chain."""
    registered = entries(F.col("doc"), "registrations")

    def judge(e: Column, i: Column) -> Column:
        parts = F.split(text_of(e, "agentRegistry"), ":", -1)
        whole = F.size(parts) == 3
        part = lambda k: F.when(whole, F.get(parts, k))
        chain = F.when(part(1).rlike(r"^\+?[0-9]{1,38}$"), part(1).try_cast("decimal(38,0)"))
        agrees = [unsigned(e, "agentId") == F.col(agent_id), part(0) == "eip155", chain == F.col(chain_id), F.lower(part(2)) == F.lower(F.col(registry))]
        score = sum((F.coalesce(a, F.lit(False)).cast("int") for a in agrees), F.lit(0))
        return F.struct(score.alias("score"), (-i).alias("order"), chain.cast("string").alias("chain"))

    best = F.array_max(F.transform(registered, judge))
    out = df.withColumn("_best", best)
    return out.withColumns({
        "status": F.when(F.col("_best").isNull(), "unclaimed").when(F.col("_best.score") == 4, "pass").otherwise("fail"),
        "entry": -F.col("_best.order"), "score": F.col("_best.score"), "declared_chain": F.col("_best.chain"),
    }).drop("_best")


# -- endpoints, wallets, rung 6 ------------------------------------------------------------------------------------


def declared_endpoints(df: DataFrame) -> DataFrame:
    """S-ENDPTS: one row for each entry of the services array: ``index``, ``name``, ``declared`` and its ``kind``. Documents
    without an array give no row; use a frame parsed without stripping a BOM."""
    listed = services(F.col("doc"))["entries"]
    each = df.select(*(c for c in df.columns if c != "doc"), F.posexplode(listed).alias("index", "_e"))
    out = each.withColumns({"name": text_of(F.col("_e"), "name"), "declared": text_of(F.col("_e"), "endpoint")}).drop("_e")
    return out.withColumn("kind", endpoint_kind(F.col("declared")))


def declared_wallets(df: DataFrame) -> DataFrame:
    """S-WALLETS: ``wallets``, the addresses of the services named agentWallet."""
    named = F.filter(services(F.col("doc"))["entries"], lambda e: text_of(e, "name") == "agentWallet")
    first = lambda e: F.coalesce(text_of(e, "address"), text_of(e, "endpoint"), text_of(e, "value"))
    found = F.array_compact(F.transform(named, lambda e: normal_address(first(e))))
    return df.withColumn("wallets", F.coalesce(found, F.array().cast("array<string>")))


def outcome(code: Column, error: Column) -> Column:
    """What one probe of an endpoint says: live, refused, not_live or our_error."""
    asked = F.when(error.startswith("robots_"), "refused").when(error.startswith("ssrf_blocked: "), "not_live").when(error.isNotNull(), "our_error")
    heard = F.when(code.between(200, 299) | (code == PAYMENT), "live").when(code.isin(*DECLINED), "refused").when(code.isNotNull(), "not_live")
    return F.coalesce(asked, heard, F.lit("our_error"))


def live(agents: DataFrame, endpoints: DataFrame, probes: DataFrame, key: list[str]) -> DataFrame:
    """VRD-6b and JN-14: the rung-6 row of each agent with a services array.

    ``agents``: (*key) of agents with an array, empty ones as well; ``endpoints``: (*key, declared, kind); ``probes``: one row
    (url, http_status, error) for each URL asked. An agent whose probeable endpoints weren't asked at all has no row."""
    asked = endpoints.withColumn("url", F.when(F.col("kind").isin("http", "https"), unicode_trim(F.col("declared"))))
    seen = asked.join(probes.withColumn("asked", F.lit(True)), "url", "left")
    said = F.when(F.col("asked"), outcome(F.col("http_status"), F.col("error")))
    count = lambda cond: F.count(F.when(cond, 1))
    per = seen.withColumn("said", said).groupBy(*key).agg(
        F.count("*").alias("declared"), count(F.col("url").isNotNull()).alias("probeable"), count(F.col("asked")).alias("probed"),
        *(count(F.col("said") == w).alias(w) for w in ("live", "not_live", "refused", "our_error")), count(F.col("asked") & (F.col("http_status") == PAYMENT) & F.col("error").isNull()).alias("payment_gated"),
    )
    counts = ["declared", "probeable", "probed", "live", "not_live", "refused", "our_error", "payment_gated"]
    out = agents.join(per, key, "left").fillna(0, counts).filter("probeable = 0 or probed > 0")
    status = F.when(F.col("probeable") == 0, "unprobeable").when(F.col("live") > 0, "pass").when(F.col("not_live") > 0, "fail").when(F.col("refused") > 0, "refused").otherwise("error")
    reason = F.when(F.col("probeable") == 0, F.when(F.col("declared") == 0, "no_services_declared").otherwise("no_probeable_endpoint"))
    return out.withColumns({"status": status, "reason": reason})


def shape(doc: Column) -> Column:
    """AGG-34: the sorted top-level keys of an object, joined by commas; null for other documents."""
    return F.when(kind(doc) == "OBJECT", F.array_join(F.array_sort(F.json_object_keys(F.to_json(doc))), ","))


def payment_support(doc: Column) -> Column:
    """AGG-30: x402Support as true, false, non_boolean or absent."""
    v = field(doc, "x402Support")
    said = F.try_variant_get(doc, "$.x402Support", "boolean")
    return F.when(~present(doc, "x402Support"), "absent").when(kind(v) != "BOOLEAN", "non_boolean").when(said, "true").otherwise("false")


def payment_targets(df: DataFrame, wallets: str = "wallets", verified: str = "verified_wallet", owner: str = "owner") -> DataFrame:
    """VRD-11: the payment targets of every row, on both bases: ``basis``, ``address``, ``declared_index`` and ``ineligible``.

    A wallet that wasn't read gives no row. Repeated declared addresses count once, at their first place."""
    raw = F.col(verified)
    address = F.coalesce(normal_address(raw), F.lower(unicode_trim(raw)))
    own = F.coalesce(normal_address(F.col(owner)), F.lower(F.col(owner)))
    burns = lambda a: a.isin(ZERO, DEAD)
    keys = [c for c in df.columns if c not in (wallets, verified)]
    read = df.filter(raw.isNotNull()).select(
        *keys, F.lit("verified_wallet").alias("basis"), address.alias("address"), F.lit(None).cast("int").alias("declared_index"),
        F.when(burns(address), "wallet_unset").when(address == own, "wallet_equals_owner").alias("ineligible"),
    )
    each = df.select(*keys, F.col(wallets).alias("_all"), F.posexplode_outer(wallets).alias("_i", "_raw"))
    found = normal_address(F.col("_raw"))
    # the place of the first equal address decides, within the row's own array
    first = F.array_position(F.transform("_all", lambda w: F.coalesce(normal_address(w), F.lit(""))), found) - 1
    each = each.withColumns({"_address": found, "_first": first}).filter(F.col("_address").isNull() | (F.col("_first") == F.col("_i")))
    said = each.select(
        *keys, F.lit("declared_wallet").alias("basis"), F.coalesce("_address", unicode_trim(F.col("_raw")), F.lit("")).alias("address"), F.col("_i").alias("declared_index"),
        F.when(F.col("_address").isNull(), "no_declared_address").when(burns(F.col("_address")), "burn_address").alias("ineligible"),
    )
    return read.unionByName(said)
