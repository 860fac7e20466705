"""Sellers: catalog pages, population, quotes, claims, settlement and the shopper's choice (S-CATALOG, AGG-14 to AGG-16, JN-15,
JN-16, VRD-14, VRD-15, VRD-17, VRD-20, VRD-21).

Amounts are unsigned numbers of 128 bits, kept as texts of digits without leading zeros. JSON is read as in ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.functions.scalar import NETWORKS
from muster.functions.web import pay_to, unicode_trim, url_host
from muster.operators.documents import entries, field, kind, text_of, with_document

#: The largest amount, the cap of a purchase in cents, and requests to one host. (Fixed values.)
MOST = str((1 << 128) - 1)
CAP_CENTS = 10
HOST_BUDGET = 500
#: What is priced: network, asset, decimals. (Fixed values.)
ASSETS = (("eip155:8453", "0x833589fcd6edb6e08f4c7c32d4f71b54bda02913", 6),)
QUOTE = "struct<scheme:string,network:string,amount:string,asset:string,pay_to:string,resource:string,missing:string>"


def canonical_network(c: Column) -> Column:
    """S-NET: aliases in any case; a namespace in lower case with its reference as it is."""
    t = unicode_trim(c)
    low, out = F.lower(t), None
    for alias, name in NETWORKS.items():
        out = F.when(low == alias, name) if out is None else out.when(low == alias, name)
    return out.when(F.contains(t, F.lit(":")), F.concat(F.lower(F.substring_index(t, ":", 1)), F.regexp_replace(t, "^[^:]*", ""))).otherwise(low)


def digits(t: Column) -> Column:
    """A text of digits (a plus sign is allowed) as an amount, else null."""
    plain = F.when(t.rlike(r"^\+?[0-9]+$"), F.regexp_replace(t, r"^\+?0*(?=[0-9])", ""))
    return F.when((F.length(plain) < len(MOST)) | ((F.length(plain) == len(MOST)) & (plain <= MOST)), plain)


def amount_of(v: Column, *names: str) -> Column:
    """The first of the fields that is there, as an amount: a string of digits or an integer, else null."""
    value = F.coalesce(*(field(v, n) for n in names))
    text, shape = F.try_variant_get(value, "$", "string"), F.schema_of_variant(value)
    whole = shape.isin("BIGINT") | shape.rlike(r"^DECIMAL\((19|20),0\)$")
    small = text.rlike("^[0-9]+$") & ((F.length(text) < 20) | (text <= str((1 << 64) - 1)))
    return F.when(kind(value) == "STRING", digits(unicode_trim(text))).when(whole & small, digits(text))


def cents_of(amount: Column, decimals: int) -> Column:
    """S-CENTS: whole cents, rounded up, of an amount of atomic units; null where the product or the cents overflow."""
    most, places = str(((1 << 128) - 1) // 100), decimals - 2
    fits = (F.length(amount) < len(most)) | ((F.length(amount) == len(most)) & (amount <= most))
    size = F.length(amount) - places
    whole = F.when(size > 0, F.substring(amount, F.lit(1), size)).otherwise("0")
    rest = F.when(size > 0, F.substring(amount, size + 1, F.lit(places))).otherwise(amount)
    value = whole.try_cast("decimal(38,0)") + F.when(rest.rlike("[1-9]"), 1).otherwise(0)
    return F.when(fits & (F.length(whole) <= 20) & (value <= F.lit(str((1 << 64) - 1)).cast("decimal(38,0)")), value.cast("decimal(20,0)"))


# -- catalog and population ----------------------------------------------------------------------------------------


def catalog_listings(pages: DataFrame, catalog: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """S-CATALOG: (listings, pages). Listings: catalog, pay_to, resource, network, claimed_amount and claimed_asset, without
    repeats inside an item. Pages: the columns of ``pages`` but the body, with ``error`` (not_json, no_items), ``items_seen``,
    ``items_unreadable`` (no resource or no payee) and ``total``."""
    parsed = with_document(pages, body, strip_bom=False)
    items = entries(F.col("doc"), "items")
    offer = lambda e: F.struct(
        F.coalesce(text_of(e, "payTo"), F.when(field(e, "payTo").isNull(), text_of(e, "recipient"))).alias("pay_to"), F.coalesce(text_of(e, "network"), F.lit("")).alias("network"),
        amount_of(e, "amount", "maxAmountRequired").alias("claimed_amount"), F.coalesce(text_of(e, "asset"), F.when(field(e, "asset").isNull(), text_of(e, "currency"))).alias("asset"),
    )
    read = F.transform(items, lambda i: F.struct(text_of(i, "resource").alias("resource"), F.array_distinct(F.filter(F.transform(entries(i, "accepts"), offer), lambda o: o["pay_to"].isNotNull())).alias("offers")))
    usable = lambda i: i["resource"].isNotNull() & (F.coalesce(F.size(i["offers"]), F.lit(0)) > 0)
    parsed = parsed.withColumn("_items", read)
    listings = parsed.select(F.explode(F.filter("_items", usable)).alias("i")).select("i.resource", F.explode("i.offers").alias("o"))
    listings = listings.select(F.lit(catalog).alias("catalog"), "o.pay_to", "resource", "o.network", "o.claimed_amount", pay_to(F.col("o.asset"))["value"].alias("claimed_asset"))
    total = F.try_variant_get("doc", "$.pagination.total", "string")
    seen = F.coalesce(F.size("_items"), F.lit(0))
    out = parsed.select(
        *(c for c in pages.columns if c != body), F.when(F.col("parse_error").isNotNull(), "not_json").when(items.isNull(), "no_items").alias("error"), F.greatest(seen, F.lit(0)).alias("items_seen"),
        F.greatest(seen - F.coalesce(F.size(F.filter("_items", usable)), F.lit(0)), F.lit(0)).alias("items_unreadable"), F.when(total.rlike("^[0-9]+$"), digits(total)).alias("total"),
    )
    return listings, out


def in_scope(network: Column, networks: tuple[str, ...] = ("eip155:8453",)) -> Column:
    """FLT-9: whether a listing's network is one of those that are looked at, by canonical name."""
    return canonical_network(network).isin(*networks)


def population(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AGG-14: (sellers, rejected). A seller is a payee at a host, with sorted catalogs and resources; a listing whose payee or
    URL can't be read is rejected with its reason (the payee's first)."""
    named = listings.withColumns({"_payee": pay_to(F.col("pay_to")), "_host": url_host(F.col("resource"))})
    reason = F.coalesce(F.col("_payee.error"), F.col("_host.error"))
    good = named.filter(reason.isNull()).groupBy(F.col("_payee.value").alias("pay_to"), F.col("_host.value").alias("host"))
    sets = {"catalogs": "catalog", "resources": "resource"}
    return good.agg(*(F.array_sort(F.collect_set(c)).alias(n) for n, c in sets.items())), named.filter(reason.isNotNull()).select(*listings.columns, reason.alias("reason"))


def exclusive_to(sellers: DataFrame, catalog: str) -> DataFrame:
    """AGG-15: sellers that no other catalog lists."""
    return sellers.filter((F.size("catalogs") == 1) & F.array_contains("catalogs", catalog))


def listed(sellers: DataFrame, listings: DataFrame) -> DataFrame:
    """VRD-20 and JN-15: rung 1 of every seller, with its number of resources and the claims that name it (by payee and resource)."""
    claims = listings.withColumn("_payee", pay_to(F.col("pay_to"))["value"]).filter(F.col("_payee").isNotNull())
    claims = claims.groupBy(F.col("_payee").alias("pay_to"), "resource").agg(F.array_sort(F.collect_set(F.struct("catalog", "network", "claimed_amount", "claimed_asset"))).alias("claims"))
    each = sellers.select("pay_to", "host", F.explode("resources").alias("resource")).join(claims, ["pay_to", "resource"], "left")
    per = each.groupBy("pay_to", "host").agg(F.count("*").alias("resource_count"), F.sort_array(F.collect_list(F.struct("resource", "claims"))).alias("claims"))
    return sellers.select("pay_to", "host", "catalogs").join(per, ["pay_to", "host"]).withColumn("status", F.lit("pass"))


def host_budget(sellers: DataFrame, budget: int = HOST_BUDGET) -> DataFrame:
    """VRD-21: rungs 2 and 3 of the sellers beyond a host's budget (by payee): unprobed, host_budget."""
    place = F.row_number().over(Window.partitionBy("host").orderBy("pay_to"))
    over = sellers.withColumn("_n", place).filter(F.col("_n") > budget)
    return over.select("pay_to", "host", F.explode(F.array(F.lit(2), F.lit(3))).alias("rung"), F.lit("unprobed").alias("status"), F.lit("host_budget").alias("reason"))


# -- quotes, claims, purchases -------------------------------------------------------------------------------------


def _requirement(e: Column) -> Column:
    asset, payee, amount = pay_to(text_of(e, "asset"))["value"], pay_to(text_of(e, "payTo"))["value"], amount_of(e, "maxAmountRequired", "amount")
    missing = (
        F.when(text_of(e, "scheme").isNull(), "scheme").when(text_of(e, "network").isNull(), "network").when(amount.isNull(), "maxAmountRequired").when(asset.isNull(), "asset").when(payee.isNull(), "payTo")
    )
    return F.struct(
        text_of(e, "scheme").alias("scheme"), text_of(e, "network").alias("network"), amount.alias("amount"), asset.alias("asset"), payee.alias("pay_to"), text_of(e, "resource").alias("resource"), missing.alias("missing")
    )


def quotes(df: DataFrame, body: str = "body", seller: str = "pay_to") -> DataFrame:
    """VRD-14: ``quotes`` (what the body asks this seller to be paid, empty if nothing) and ``reason`` why there are none:
    not_json, no_accepts, no_requirements, incomplete_requirement (with ``missing``) or not_this_sellers_pay_to."""
    parsed = with_document(df, body, strip_bom=False)
    accepts = entries(F.col("doc"), "accepts")
    all_ = parsed.withColumns({"_accepts": F.size(accepts), "_all": F.transform(accepts, _requirement)})
    mine = F.filter("_all", lambda q: q["missing"].isNull() & (q["pay_to"] == F.col(seller)))
    first = F.get(F.filter("_all", lambda q: q["missing"].isNotNull()), 0)["missing"]
    reason = (
        F.when(F.col("parse_error").isNotNull(), "not_json").when(F.coalesce(F.col("_accepts"), F.lit(-1)) < 0, "no_accepts").when(F.col("_accepts") == 0, "no_requirements")
        .when(F.size(mine) > 0, None).when(first.isNotNull(), "incomplete_requirement").otherwise("not_this_sellers_pay_to")
    )
    return all_.select(*df.columns, F.coalesce(mine, F.array().cast(f"array<{QUOTE}>")).alias("quotes"), reason.alias("reason"), F.when(reason == "incomplete_requirement", first).alias("missing"))


def consistent(df: DataFrame, claim: str = "claim", quoted: str = "quotes") -> DataFrame:
    """VRD-15: ``status`` and ``reason`` of a claim (struct network, amount, asset) against quotes. The nearest quote is the last
    of those that agree most (asset before network)."""
    c = F.col(claim)
    same = lambda q: canonical_network(q["network"]) == canonical_network(c["network"])
    exact = F.exists(quoted, lambda q: (q["amount"] == c["amount"]) & (q["asset"] == c["asset"]) & same(q))
    near = F.array_max(F.transform(quoted, lambda q, i: F.struct((2 * (q["asset"] == c["asset"]).cast("int") + same(q).cast("int")).alias("score"), i.alias("i"), (~same(q)).alias("network"), (q["asset"] != c["asset"]).alias("asset"), (q["amount"] != c["amount"]).alias("amount"))))
    fields = F.concat_ws("+", *(F.when(F.col("_near")[w], w) for w in ("network", "asset", "amount")))
    out = df.withColumns({"_near": near, "_exact": exact})
    none, silent = F.size(quoted) == 0, c["amount"].isNull() | c["asset"].isNull()
    status = F.when(none, "skipped").when(silent, "unprobed").when(F.col("_exact"), "pass").otherwise("fail")
    reason = F.when(none, "rung_3_not_pass").when(silent, "nothing_claimed").when(~F.col("_exact"), F.when(fields == "", "no_matching_requirement").otherwise(fields))
    return out.withColumns({"status": status, "reason": reason}).drop("_near", "_exact")


def decide(df: DataFrame, quoted: str = "quotes", assets: tuple = ASSETS, cap: int = CAP_CENTS) -> DataFrame:
    """VRD-17: ``decision`` (buy, or why not: no_quote, out_of_scope_network, over_cap, unpriced), ``index`` and ``cents`` of
    what is bought: the cheapest quote in scope under the cap, the first among equals."""
    networks = sorted({n for n, _, _ in assets})

    def price(q: Column) -> Column:
        network, out = canonical_network(q["network"]), F.lit(None).cast("decimal(20,0)")
        for name, asset, decimals in assets:
            out = F.coalesce(out, F.when((network == name) & (q["asset"] == asset), cents_of(q["amount"], decimals)))
        return out

    priced = F.filter(F.transform(quoted, lambda q, i: F.struct(price(q).alias("cents"), i.alias("index"), canonical_network(q["network"]).isin(*networks).alias("asked"))), lambda p: p["asked"])
    out = df.withColumn("_priced", priced)
    best = F.array_min(F.filter("_priced", lambda p: p["cents"] <= cap))
    over = F.exists("_priced", lambda p: p["cents"] > cap)
    decision = F.when(F.size(quoted) == 0, "no_quote").when(F.size("_priced") == 0, "out_of_scope_network").when(best.isNotNull(), "buy").when(F.coalesce(over, F.lit(False)), "over_cap").otherwise("unpriced")
    return out.withColumns({"decision": decision, "index": best["index"], "cents": best["cents"]}).drop("_priced")


def settled(sellers: DataFrame, transfers: DataFrame, shopper: str, key: str = "pay_to") -> DataFrame:
    """VRD-16, AGG-16 and JN-16: payments to each seller (payees in any case) that aren't our own or its own. ``transfers``:
    (key, payer, block). Sellers without any keep their row."""
    payer, own = F.lower("payer"), F.lower(key)
    ours, self_ = payer == shopper.lower(), payer == own
    counts = ~ours & ~self_
    per = transfers.withColumn("_key", own).groupBy("_key").agg(
        F.count(F.when(counts, 1)).alias("payments"), F.count_distinct(F.when(counts, payer)).alias("payers"), F.min(F.when(counts, F.col("block"))).alias("first_block"),
        F.max(F.when(counts, F.col("block"))).alias("last_block"), F.count(F.when(ours, 1)).alias("excluded_ours"), F.count(F.when(~ours & self_, 1)).alias("excluded_self"),
    )
    out = sellers.join(per, F.lower(sellers[key]) == per["_key"], "left").drop("_key").fillna(0, ["payments", "payers", "excluded_ours", "excluded_self"])
    return out.withColumns({"status": F.when(F.col("payments") > 0, "pass").otherwise("fail"), "reason": F.when(F.col("payments") == 0, "no_settlement_in_window")})
