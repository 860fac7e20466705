"""Scalar functions of the census as SQL expression texts (S-* of the survey). ``column()`` makes a Spark Column of one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from muster.functions.dialect import write

#: Addresses that burn. (Fixed values.)
ZERO = "0x" + "0" * 40
DEAD = "0x" + "0" * 36 + "dead"


def column(expression: str) -> Column:
    return F.expr(write(expression, duck=False))


def address(c: str) -> str:
    """S-ADDR: a 20-byte hex address in lower case, else null."""
    t = f"lower($[bare|{c}])"
    return f"case when length({t}) = 42 and substr({t}, 1, 2) = '0x' and translate(substr({t}, 3), '0123456789abcdef', '') = '' then {t} end"


def is_burn(c: str) -> str:
    """S-BURN."""
    return f"lower({c}) in ('{ZERO}', '{DEAD}')"


def host(url: str) -> str:
    """S-HOST: host of an http(s) URL in lower case; the port stays unless it is the scheme's own."""
    authority = f"regexp_extract(lower({url}), '^https?://(?:[^/?#@]*@)?([^/?#@]+)', 1)"
    return f"case when lower({url}) like 'http://%' then regexp_replace({authority}, ':80$', '') when lower({url}) like 'https://%' then regexp_replace({authority}, ':443$', '') end"


def endpoint_kind(c: str) -> str:
    """VRD-6a: the kind of a declared endpoint."""
    t = f"trim({c})"
    caip = f"(length({t}) - length(replace({t}, ':', '')) = 2 and not contains({t}, '/') and not contains({t}, '@') and not contains({t}, ' '))"
    mail = f"(contains({t}, '@') and not contains({t}, '/') and not contains({t}, ' '))"
    return f"case when {c} is null then 'missing' when {t} = '' then 'other' when lower({t}) like 'https://%' then 'https' when lower({t}) like 'http://%' then 'http' when lower({t}) like 'mailto:%' then 'email' when {caip} then 'caip10' when {mail} then 'email' else 'other' end"


def uri_scheme(c: str) -> str:
    """S-RESOLVE / S-SCHEME: how a URI is resolved; bare JSON is inline."""
    t = f"lower(trim({c}))"
    return f"case when {c} is null or {t} = '' then 'empty' when {t} like 'https://%' or {t} like 'http://%' then 'http' when {t} like 'ipfs://%' then 'ipfs' when {t} like 'data:%' or substr({t}, 1, 1) in (chr(123), '[') then 'data' else 'unsupported' end"


def format_units(raw: str, decimals: int) -> str:
    """S-UNITS: an integer string with ``decimals`` places as a decimal string without trailing zeros; null unless all digits."""
    digits = f"case when trim(leading '0' from {raw}) = '' then '0' else trim(leading '0' from {raw}) end"
    padded = f"lpad({digits}, cast(greatest(length({digits}), {decimals + 1}) as int), '0')"
    whole = f"substr({padded}, 1, length({padded}) - {decimals})"
    rest = f"trim(trailing '0' from substr({padded}, length({padded}) - {decimals - 1}))"
    return f"case when {raw} is null or {raw} = '' or translate({raw}, '0123456789', '') <> '' then null when {rest} = '' then {whole} else {whole} || '.' || {rest} end"


#: Names by which networks are known. (Fixed values.)
NETWORKS = {"base": "eip155:8453", "base-sepolia": "eip155:84532", "solana": "solana:5eykt4UsFv8P8NJdTREpY1vzqKqZKvdp"}


def network(c: str) -> str:
    """S-NET: canonical network; aliases in any case, CAIP namespaces in lower case with the reference as it is."""
    t = f"trim({c})"
    alias = " ".join(f"when lower({t}) = '{a}' then '{n}'" for a, n in NETWORKS.items())
    return f"case {alias} when contains({t}, ':') then lower($[part|{t}|:|1]) || substr({t}, length($[part|{t}|:|1]) + 1) else lower({t}) end"


def cents(amount: str, decimals: int = 6) -> str:
    """S-CENTS: whole cents, rounded up, of an amount of atomic units (two decimals or more); null where it isn't all digits, is no
    unsigned number of 128 bits, or the cents are none of 64."""
    own = f"case when trim(leading '0' from {amount}) = '' then '0' else trim(leading '0' from {amount}) end"
    places = decimals - 2
    whole = f"case when length({own}) > {places} then substr({own}, 1, length({own}) - {places}) else '0' end"
    rest = f"case when length({own}) > {places} then substr({own}, length({own}) - {places - 1}) else {own} end"
    value = f"(cast({whole} as decimal(38,0)) + case when translate({rest}, '0', '') = '' then 0 else 1 end)"
    fits = f"(length({own}) < 39 or (length({own}) = 39 and {own} <= '{(1 << 128) // 100}'))"
    return f"case when {amount} is null or {amount} = '' or translate({amount}, '0123456789', '') <> '' or not {fits} then null when length({whole}) > 20 then null when {value} > {(1 << 64) - 1} then null else cast({value} as decimal(20,0)) end"


def same_address(a: str, b: str) -> str:
    return f"coalesce(lower({a}) = lower({b}), false)"
