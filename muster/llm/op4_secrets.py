"""Secret scans: three base patterns, and windows of high Shannon entropy.

DataFrame functions only. Positions come from splitting a text at the matches of a pattern: the lengths of pieces and
matches add up to each match's start. Only texts that a pattern occurs in are split.

Entropy: runs of 20 or more characters of a token alphabet that hold a digit are candidates. Over each, a window of 20
characters slides; one aggregate carries the count of every character and the sum of c*log2(c), and a step changes the
two counts that the window gains and loses. A candidate whose highest window entropy reaches the limit of its character
class (hex, letters and digits, all) is a span, unless the allow-list knows it or a base span holds it. Words and runs of
the allow-list cut a candidate: they don't clear what is beside them.

Nulls: a null text is empty. An empty text has no spans. Repeated rows are scanned each; an empty table gives no rows;
other columns are ignored. A candidate of any length is scanned whole; the work grows with its length.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.common import table

#: The base patterns. (Fixed values.)
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Least entropy in bits of the best window, by class.
LIMITS = {"hex": 2.9, "alnum": 3.75, "all": 3.9}
def _run(letters: str, least: int = 10) -> str:
    """A run of the first ``least`` letters or more, in their order."""
    more = ""
    for c in reversed(letters[least:]):
        more = f"(?:{c}{more})?"
    return letters[:least] + more


#: Never part of a secret: alphabet and digit runs, words that say so. A candidate is cut at these, its pieces are judged.
ALLOWED_PIECE = "|".join(["0123456789", _run(string.ascii_lowercase), _run(string.ascii_uppercase), "(?i:example|sample|placeholder|changeme|dummy|xxxx)"])
#: Never a secret as a whole: UUIDs, and dates and paths of plain words (letters only, or four digits at most).
ALLOWED_WHOLE = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$|^[/_-]*([a-z]+|[0-9]{1,4})([/_-]+([a-z]+|[0-9]{1,4}))*[/_-]*$"

def located(text: Column, pattern: str, value_group: int = 0, least: int = 0) -> Column:
    """Array of (start, end) of the leftmost non-overlapping matches, in code points; those whose group has ``least`` characters."""
    spot = "array<struct<start:int,stop:int>>"
    hits = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
        F.split(text, pattern, -1).alias("gap"),
    )
    hits = F.filter(hits, lambda h: h["hit"].isNotNull())
    none = F.array().cast(spot)

    def step(acc: Column, h: Column) -> Column:
        start = acc["at"] + F.length(h["gap"])
        stop = start + F.length(h["hit"])
        found = F.when(F.length(h["value"]) >= least, F.array(F.struct(start.alias("start"), stop.alias("stop")))).otherwise(none)
        return F.struct(stop.alias("at"), F.concat(acc["found"], found).alias("found"))

    spots = F.aggregate(hits, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda acc: acc["found"])
    return F.when(text.rlike(pattern), spots).otherwise(none)


def _weight(count: Column) -> Column:
    """c * log2(c)."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(0.0)


#: The counts of a window lie in longs, SLOT bits for each character of ALPHABET (a window has fewer than 2**SLOT characters).
SLOT, PER_LONG = 5, 12


def _steps(word: Column, window: int) -> Column:
    """Array of (into, out): the character that each step adds to the window and the one that leaves it (-1: none)."""
    codes = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    leaving = F.slice(F.concat(F.array_repeat(F.lit(-1), window), codes), F.lit(1), F.size(codes))
    return F.zip_with(codes, leaving, lambda into, out: F.struct(into.alias("into"), out.alias("out")))


def best_window_entropy(word: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy of any window of the word, by counts that each step changes at two places.

    The steps are made once for the whole word; the fold only reads its own step, so that the work grows with the length."""
    longs = -(-len(ALPHABET) // PER_LONG)
    state = F.struct(F.array_repeat(F.lit(0).cast("long"), longs).alias("counts"), F.lit(0).alias("n"), F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least"))

    def place(code: Column) -> tuple[Column, Column]:
        return F.floor(code / PER_LONG).cast("int"), F.pmod(code, F.lit(PER_LONG)) * SLOT

    def step(acc: Column, s: Column) -> Column:
        (to, to_bit), (frm, from_bit), leaves = place(s["into"]), place(s["out"]), s["out"] >= 0

        def count(at: Column, bit: Column) -> Column:
            return F.call_function("shiftrightunsigned", F.get(acc["counts"], at), bit).bitwiseAND(F.lit((1 << SLOT) - 1).cast("long"))

        gained, lost = count(to, to_bit), F.when(leaves, count(frm, from_bit)).otherwise(0)
        moved = F.when(s["into"] == s["out"], 0.0).otherwise(_weight(gained + 1) - _weight(gained) + F.when(leaves, _weight(lost - 1) - _weight(lost)).otherwise(0.0))
        one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
        counts = F.transform(
            acc["counts"], lambda c, k: c + F.when(k == to, F.call_function("shiftleft", one, to_bit)).otherwise(zero) - F.when(leaves & (k == frm), F.call_function("shiftleft", one, from_bit)).otherwise(zero)
        )
        total, n = acc["sum"] + moved, acc["n"] + 1
        return F.struct(counts.alias("counts"), n.alias("n"), total.alias("sum"), F.when(n >= window, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"))

    least = F.aggregate(_steps(word, window), state, step, lambda acc: acc["least"])
    return F.lit(math.log2(window)) - least / window


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans: array of (start, rank, stop, kind), in the order of start and kind; code points, stop exclusive."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    t = F.col("t")
    d = d.select("doc_id", "t", located(t, ASSIGN, 2, 6).alias("assign"), located(t, ACCESS).alias("access"), located(t, HEX).alias("hex"), located(t, CANDIDATE).alias("candidates"))

    def secret(piece: Column) -> Column:
        limit = F.when(piece.rlike("^[0-9a-fA-F]+$"), LIMITS["hex"]).when(piece.rlike("^[0-9A-Za-z]+$"), LIMITS["alnum"]).otherwise(LIMITS["all"])
        return F.when((F.length(piece) < WINDOW) | piece.rlike(ALLOWED_WHOLE), False).otherwise(best_window_entropy(piece) >= limit)

    def suspicious(s: Column) -> Column:
        word = F.substring(t, s["start"] + 1, s["stop"] - s["start"])
        held = F.exists(F.concat("assign", "access", "hex"), lambda b: (b["start"] <= s["start"]) & (b["stop"] >= s["stop"]))
        return F.when(~word.rlike("[0-9]") | held | word.rlike(ALLOWED_WHOLE), False).otherwise(F.exists(F.split(word, ALLOWED_PIECE), secret))

    d = d.withColumn("entropy", F.when(F.size("candidates") > 0, F.filter("candidates", suspicious)).otherwise(F.col("candidates")))

    def as_kind(name: str) -> Column:
        return F.transform(name, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(name)).alias("rank"), s["stop"].alias("stop"), F.lit(name).alias("kind")))

    return d.select("doc_id", F.array_sort(F.concat(*map(as_kind, KINDS))).alias("spans"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql_found(kind: str, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""(select list({{'start': start, 'rank': {KINDS.index(kind)}, 'stop': start + len(hits[i]), 'kind': '{kind}'}}) from (
        select i, hits, vals, (list_sum(list_transform(gaps[1:i], lambda g: len(g))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda h: len(h))), 0))::bigint as start
        from (select regexp_extract_all(t, '{quoted}') as hits, regexp_extract_all(t, '{quoted}', {group}) as vals, regexp_split_to_array(t, '{quoted}') as gaps) x, range(1, len(hits) + 1) r(i)) y
        where len(vals[i]) >= {least})"""


def oracle() -> str:
    word = "substring(t, c.start + 1, c.stop - c.start)"
    quoted = lambda p: p.replace("'", "''")
    limit = f"case when regexp_matches(p, '^[0-9a-fA-F]+$') then {LIMITS['hex']} when regexp_matches(p, '^[0-9A-Za-z]+$') then {LIMITS['alnum']} else {LIMITS['all']} end"
    window = f"string_split(substring(p, i, {WINDOW}), '')"
    entropy = f"""list_max(list_transform(range(1, len(p) - {WINDOW} + 2), lambda i: list_sum(list_transform(list_distinct({window}),
        lambda ch: -1.0 * (len(list_filter({window}, lambda z: z = ch)) / {WINDOW}.0) * log2(len(list_filter({window}, lambda z: z = ch)) / {WINDOW}.0)))))"""
    joined = "coalesce(array_to_string(list_transform({0}, lambda s: s.kind || ':' || s.start || ':' || s.stop), ','), '')"
    return f"""
    with d as (select row_number() over () as row_id, doc_id, coalesce(text, '') as t from documents),
    found as (select row_id, doc_id, t, coalesce({_sql_found('assign', ASSIGN, 2, 6)}, []) as a, coalesce({_sql_found('access', ACCESS, 0, 0)}, []) as k,
        coalesce({_sql_found('hex', HEX, 0, 0)}, []) as h, coalesce({_sql_found('entropy', CANDIDATE, 0, 0)}, []) as c from d),
    cand as (select row_id, t, list_concat(list_concat(a, k), h) as base, unnest(c) as c from found),
    asked as (select row_id, c, {word} as w from cand where regexp_matches({word}, '[0-9]') and not regexp_matches({word}, '{quoted(ALLOWED_WHOLE)}')
        and len(list_filter(base, lambda b: b.start <= c.start and b.stop >= c.stop)) = 0),
    pieces as (select row_id, c, unnest(regexp_split_to_array(w, '{quoted(ALLOWED_PIECE)}')) as p from asked),
    hits as (select distinct row_id, c from pieces where len(p) >= {WINDOW} and not regexp_matches(p, '{quoted(ALLOWED_WHOLE)}') and {entropy} >= {limit}),
    picked as (select row_id, list(c) as e from hits group by row_id),
    spans as (select doc_id, a, k, h, list_sort(list_concat(list_concat(a, k), h)) as base, list_sort(list_concat(list_concat(list_concat(a, k), h), coalesce(e, []))) as every from found left join picked using (row_id))
    select doc_id, len(a)::bigint as n_assign, len(k)::bigint as n_access, len(h)::bigint as n_hex, sha256({joined.format('base')}) as base_sha256, {joined.format('every')} as spans from spans"""
