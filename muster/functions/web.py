"""Scalar functions over addresses, URIs, hosts, headers and bodies (S-* of the survey), as Column expressions where Spark's
own functions can say it, and Arrow functions where they can't (data URIs, robots rules)."""

from __future__ import annotations

import base64
import binascii
import re
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that a trim takes off: all of Unicode's. (Fixed values.)
SPACE = r"[\p{Z}\x09-\x0D\x{85}]"
#: Bodies are read up to so many bytes. (A fixed value.)
BODY_CAP = 1 << 20


def unicode_trim(c: Column) -> Column:
    """S-TRIM."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def normal_address(c: Column) -> Column:
    """S-ADDR: a 20-byte hex address (0x or 0X, any case, white space around) in lower case, else null."""
    t = unicode_trim(c)
    return F.when(t.rlike("^0[xX][0-9a-fA-F]{40}$"), F.lower(t))


def pay_to(c: Column, network: str = "evm") -> Column:
    """S-PAYTO: struct(value, error). EVM addresses need 0x and become lower case; Solana's are kept as they are."""
    t = unicode_trim(c)
    if network == "solana":
        bad, zero, value = ~t.rlike("^[0-9A-Za-z]{32,44}$"), t.rlike("^1+$"), t
    else:
        bad, zero, value = ~t.rlike("^0x[0-9a-fA-F]{40}$"), t.rlike("^0x0{40}$"), F.lower(t)
    error = F.when(t.isNull() | bad, "malformed_address").when(zero, "zero_address")
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))


def url_host(c: Column) -> Column:
    """S-HOST: struct(value, error): the host of an http(s) URL in lower case, with a port that isn't the scheme's own.

    Hosts beyond ASCII are written in punycode."""
    t = unicode_trim(c)
    scheme = F.lower(F.regexp_extract(t, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    authority = F.regexp_extract(t, r"^[A-Za-z]+:[/\\]*([^/\\?#]*)", 1)
    place = F.regexp_replace(authority, "^.*@", "")
    port = F.regexp_extract(place, r":([0-9]*)$", 1)
    host = F.lower(F.regexp_replace(place, r":[0-9]*$", ""))
    own = F.when(scheme == "http", "80").otherwise("443")
    number = F.regexp_replace(port, "^0+(?=[0-9])", "")
    bad_port = (port != "") & ((F.length(number) > 5) | (number.try_cast("int") > 65535))
    error = F.when(t.isNull() | (scheme == ""), "malformed_url").when(~scheme.isin("http", "https"), "unsupported_scheme").when((host == "") | bad_port | host.rlike(r"[\s<>^|%]|^[^\[].*:"), "malformed_url")
    value = F.concat(F.when(host.rlike(r"^[\x00-\x7F]*$"), host).otherwise(punycode(host)), F.when((port == "") | (number == own), "").otherwise(F.concat(F.lit(":"), number)))
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))


@F.pandas_udf(T.StringType())
def punycode(hosts: pd.Series) -> pd.Series:
    def one(host):
        try:
            return None if host is None else host.encode("idna").decode("ascii")
        except UnicodeError:
            return host

    return hosts.map(one)


def probe_host(c: Column) -> Column:
    """S-HOST2: the host that a URL's budget is kept by: without scheme, path, user, brackets and a numeric port."""
    rest = F.when(F.instr(c, "://") > 0, F.regexp_replace(c, r"(?s)^.*?://", "")).otherwise(c)
    place = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*", 0), "(?s)^.*@", "")
    bare = F.when(place.startswith("["), F.regexp_extract(place, r"^\[([^\]]*)", 1)).otherwise(F.regexp_replace(place, ":[0-9]+$", ""))
    return F.translate(bare, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def endpoint_kind(c: Column) -> Column:
    """VRD-6a: the kind of a declared endpoint."""
    t = unicode_trim(c)
    low = F.lower(t)
    caip = (F.length(t) - F.length(F.replace(t, F.lit(":"), F.lit(""))) == 2) & ~t.rlike("[/@ ]")
    mail = F.contains(t, F.lit("@")) & ~t.rlike("[/ ]")
    return (
        F.when(c.isNull(), "missing").when(t == "", "other").when(low.startswith("https://"), "https").when(low.startswith("http://"), "http")
        .when(low.startswith("mailto:"), "email").when(caip, "caip10").when(mail, "email").otherwise("other")
    )


def ipfs_path(c: Column) -> Column:
    """S-IPFS: content id and path of an ipfs:// URI without leading slashes; null for others and for an empty one."""
    t = unicode_trim(c)
    return F.when(t.startswith("ipfs://"), F.nullif(F.regexp_replace(t, "^ipfs://+", ""), F.lit("")))


def percent_decode(text: str) -> bytes:
    """Bytes of a text with %XX pieces; a piece that isn't hexadecimal stays as it is."""
    return re.sub(rb"%([0-9A-Fa-f]{2})", lambda m: bytes([int(m[1], 16)]), text.encode("utf-8"))


def unpacked(raw: bytes, most: int = BODY_CAP + 1) -> bytes:
    """Gzip members one after another, ``most`` bytes at most, so that a small body can't fill a worker's memory."""
    out = b""
    while raw and len(out) < most:
        member = zlib.decompressobj(31)
        out += member.decompress(raw, most - len(out))
        if not member.eof and len(out) < most:
            raise EOFError("cut short")
        raw = member.unused_data.lstrip(b"\0")
    return out


def decode_data_uri(uri: str | None) -> tuple[bytes | None, str | None, str | None, str | None]:
    """S-DATAURI: (bytes, variant, compression, error) of a data: URI.

    Base64 may lack its padding, or be claimed for raw JSON; enc=gzip is unpacked, any other enc is an error of ours
    (unsupported_compression), and what can't be decoded is malformed."""
    if uri is None or not uri.startswith("data:") or "," not in uri:
        return None, None, None, "malformed"
    meta, payload = uri[5:].split(",", 1)
    segments = meta.split(";")
    if not any(s.lower() == "base64" for s in segments):
        return percent_decode(payload), "plain", None, None
    if payload.lstrip()[:1] in ("{", "["):
        return payload.encode("utf-8"), "base64_claimed_but_raw_json", None, None
    try:
        bare = payload.encode("ascii")
        raw = base64.b64decode(bare if len(bare) % 4 == 0 else bare + b"=" * (-len(bare) % 4) if b"=" not in bare else b"?", validate=True)
    except (UnicodeEncodeError, binascii.Error, ValueError):
        return None, None, None, "malformed"
    packed = next((s.strip()[4:].lower() for s in segments if s.strip().lower().startswith("enc=") and len(s.strip()) > 4), None)
    if packed is None:
        return raw, "base64", None, None
    if packed != "gzip":
        return None, None, packed, "unsupported_compression"
    try:
        return unpacked(raw), "compressed", packed, None
    except (zlib.error, EOFError, ValueError):
        return None, None, packed, "malformed"


@F.pandas_udf(T.StructType([T.StructField("body", T.BinaryType()), *(T.StructField(c, T.StringType()) for c in ("variant", "compression", "error"))]))
def data_uri(uris: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([decode_data_uri(u) for u in uris], columns=["body", "variant", "compression", "error"])


def resolve(c: Column) -> Column:
    """S-RESOLVE: struct(scheme, url, path, body, variant, error): what an agent's URI asks for. Bare JSON is inline."""
    t = unicode_trim(c)
    decoded = data_uri(F.when(t.startswith("data:"), t))
    named = F.lower(F.regexp_extract(t, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    bare = t.rlike(r"^[\{\[]")
    scheme = (
        F.when(t.isNull() | (t == ""), "empty")
        .when(t.startswith("data:"), F.when(decoded["error"].isNull(), "data").when(decoded["error"] == "unsupported_compression", "compressed").otherwise("unsupported"))
        .when(t.startswith("ipfs://"), F.when(ipfs_path(c).isNull(), "unsupported").otherwise("ipfs"))
        .when(bare, "data").when(named.isin("http", "https") & t.rlike(r"^[A-Za-z]+:/*[^/?#]"), "http").otherwise("unsupported")
    )
    return F.struct(
        scheme.alias("scheme"), F.when(scheme == "http", t).alias("url"), ipfs_path(c).alias("path"), F.when(bare, F.encode(t, "UTF-8")).otherwise(decoded["body"]).alias("body"),
        F.when(bare, "plain_json_without_uri_scheme").otherwise(decoded["variant"]).alias("variant"), decoded["error"].alias("error"),
    )


def scheme_bucket(evidence: Column, uri: Column) -> Column:
    """S-SCHEME: the bucket that the evidence names, else by the beginning of the URI."""
    t = unicode_trim(uri)
    guess = F.when(t.isNull() | (t == ""), "empty").when(t.startswith("data:") | t.rlike(r"^[\{\[]"), "data").when(t.startswith("ipfs://"), "ipfs").when(t.startswith("https://"), "https").when(t.startswith("http://"), "http")
    return F.coalesce(F.nullif(evidence, F.lit("")), guess, F.lit("unsupported"))


def robots_rules(text: str, agent: str) -> list[str]:
    """S-ROBOTS: the Disallow paths of all groups that name ``agent`` (any case) or *.

    Lines of User-agent in a row open one group, any other field closes its head; comments and empty paths are passed over."""
    rules: list[str] = []
    mine, heading = False, False
    for line in text.splitlines():
        key, colon, value = line.split("#", 1)[0].partition(":")
        if not colon:
            continue
        key, value = key.strip().lower(), value.strip()
        if key == "user-agent":
            mine = (mine and heading) or value == "*" or value.lower() == agent.lower()
            heading = True
        else:
            heading = False
            if key == "disallow" and value and mine:
                rules.append(value)
    return rules


def robots_allows(texts: Column, path: Column, agent: str) -> Column:
    """Whether robots.txt lets ``agent`` ask for a path: no rule that holds is its prefix. No text allows all."""

    @F.pandas_udf("boolean")
    def allowed(bodies: pd.Series, paths: pd.Series) -> pd.Series:
        cache: dict = {}
        out = []
        for body, p in zip(bodies, paths, strict=True):
            if body not in cache:
                cache[body] = robots_rules(body or "", agent)
            out.append(not any((p or "/").startswith(rule) for rule in cache[body]))
        return pd.Series(out, dtype=bool)

    return allowed(texts, path)


#: Networks that aren't public. (Fixed values.)
PRIVATE_V4 = ("0.0.0.0/32", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.2.0/24", "192.168.0.0/16", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "255.255.255.255/32")
PRIVATE_V6 = ("::/128", "::1/128", "fc00::/7", "fe80::/10", "ff00::/8")


def public_address(c: Column) -> Column:
    """S-IP: whether a text is an IP address that anyone could reach; IPv4 mapped into IPv6 counts as IPv4. Null for other text."""
    import ipaddress

    v4, v6 = [ipaddress.ip_network(n) for n in PRIVATE_V4], [ipaddress.ip_network(n) for n in PRIVATE_V6]

    @F.pandas_udf("boolean")
    def public(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                ip = ipaddress.ip_address(text)
            except ValueError:
                return None
            ip = getattr(ip, "ipv4_mapped", None) or ip
            return not any(ip in n for n in (v4 if ip.version == 4 else v6))

        return texts.map(one).astype(object)

    return public(c)


def retry_after(header: Column, now: Column) -> Column:
    """S-RETRY: seconds to wait by a Retry-After header: a number, or a date (not less than zero); else null."""
    t = F.trim(header)
    day = F.regexp_replace(F.regexp_replace(t, "^[A-Za-z]{3}, ", ""), " (GMT|UTC|[+-]0000)$", "")
    at = F.try_to_timestamp(day, F.lit("d MMM yyyy HH:mm:ss"))
    return F.when(t.rlike("^[0-9]{1,18}$"), t.try_cast("long")).when(at.isNotNull(), F.greatest(F.lit(0).cast("long"), F.unix_seconds(at) - F.unix_seconds(now)))


def sha256_hex(c: Column) -> Column:
    """S-SHA."""
    return F.sha2(c, 256)


def capped(c: Column, cap: int = BODY_CAP) -> Column:
    """S-CAP: struct(body, truncated)."""
    return F.struct(F.substring(c, 1, cap).alias("body"), (F.octet_length(c) > cap).alias("truncated"))


def escape_nul(c: Column) -> Column:
    """S-NUL: a text with NUL characters written as the six characters that JSON writes them with."""
    return F.replace(c, F.lit("\x00"), F.lit("\\u0000"))


def escape_nul_json(c: Column) -> Column:
    """S-NUL: JSON text whose NUL characters, in keys and values at any depth, are written as the six characters themselves."""
    return F.regexp_replace(c, r"(?<!\\)((?:\\\\)*)\\u0000", r"$1\\\\u0000")


def fnv1a(c: Column) -> Column:
    """S-FNV: 64-bit FNV-1a of a text's UTF-8 bytes, as 16 hex digits (which order as the unsigned number does).

    The state is two halves of 32 bits, for Spark's long product raises where it overflows: with p = 2**40 + 435, h * p mod
    2**64 is 435 * h plus the low 24 bits of h, 40 bits further left."""
    low32 = F.lit(0xFFFFFFFF).cast("long")
    octets = F.regexp_extract_all(F.hex(F.encode(c, "UTF-8")), F.lit("(..)"), F.lit(1))

    def step(acc: Column, octet: Column) -> Column:
        lo = acc["lo"].bitwiseXOR(F.conv(octet, 16, 10).cast("long"))
        low = lo * 435
        high = acc["hi"] * 435 + F.shiftright(low, 32) + F.shiftleft(lo.bitwiseAND(F.lit(0xFFFFFF).cast("long")), 8)
        return F.struct(high.bitwiseAND(low32).alias("hi"), low.bitwiseAND(low32).alias("lo"))

    start = F.struct(F.lit(0xCBF29CE4).cast("long").alias("hi"), F.lit(0x84222325).cast("long").alias("lo"))
    return F.aggregate(octets, start, step, lambda acc: F.lower(F.concat(F.lpad(F.hex(acc["hi"]), 8, "0"), F.lpad(F.hex(acc["lo"]), 8, "0"))))
