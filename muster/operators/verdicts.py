"""Verdicts as SQL CASE expressions (VRD-* of the survey). Each takes column expressions and gives one; order matters.

Statuses are words that are never collapsed; a missing row stays missing (no coalesce of a status).
"""

from __future__ import annotations

from muster.functions.scalar import ZERO, is_burn, same_address

#: HTTP codes by which a server declines. (Fixed values.)
DECLINED = (401, 407, 429, 503)
PAYMENT = 402
#: Which rung each rung waits for. (Fixed values.)
PARENT = {2: 1, 3: 2, 4: 3, 5: 4, 6: 4, 7: 1}
_CODES = ", ".join(map(str, DECLINED))


def registered(owner: str) -> str:
    """VRD-1."""
    return f"case when lower({owner}) = '{ZERO}' then 'fail' else 'pass' end"


def _resolve(scheme: str, code: str, error: str, words: dict[str, str]) -> str:
    w = {k: f"'{v}'" if v else "null" for k, v in words.items()}
    return f"""case when {scheme} = 'empty' then {w['empty']} when {scheme} = 'unsupported' then {w['unsupported']}
        when {scheme} = 'data' and {error} is not null then {w['bad_data']} when {scheme} = 'data' then {w['pass']}
        when left({error}, 7) = 'robots_' then {w['robots']} when left({error}, 14) = 'ssrf_blocked: ' then {w['ssrf']} when {error} is not null then {w['error']}
        when {code} between 200 and 299 then {w['pass']} when {code} = {PAYMENT} then {w['payment']} when {code} in ({_CODES}) then {w['declined']}
        when {code} is not null then {w['http']} else {w['nothing']} end"""


def resolvable(scheme: str, code: str, error: str) -> str:
    """VRD-2: status."""
    names = "empty unsupported bad_data pass robots ssrf error payment declined http nothing".split()
    return _resolve(scheme, code, error, dict(zip(names, "fail fail error pass refused fail error refused refused fail error".split(), strict=True)))


def resolvable_reason(scheme: str, code: str, error: str) -> str:
    """VRD-2: reason; null for a pass."""
    return _resolve(scheme, code, error, {"empty": "no_uri", "unsupported": "unsupported_scheme", "bad_data": "bad_data_uri", "pass": "", "robots": "robots", "ssrf": "ssrf_blocked", "error": "transport", "payment": "payment_required", "declined": "declined", "http": "http_status", "nothing": "no_response"})


def rejudged(status: str, code: str, error: str) -> str:
    """VRD-10: rows of an older rule, where declined codes were failures and robots were errors."""
    return f"case when {status} = 'fail' and {code} in ({_CODES}, {PAYMENT}) then 'refused' when {status} = 'error' and left({error}, 7) = 'robots_' then 'refused' else {status} end"


def attested(registry: str, authors: str) -> str:
    """VRD-7."""
    return f"case when not {registry} then 'error' when {authors} = 0 then 'fail' else 'pass' end"


def stopper(rung: int, status: dict[int, str]) -> str:
    """VRD-8: the rung by which ``rung`` is stopped; null if none. It is the parent's own stopper, else the parent if that didn't
    pass. A parent without a row stops nothing, and hides what is above it."""
    if rung not in PARENT:
        return "cast(null as int)"
    parent = PARENT[rung]
    above = stopper(parent, status)
    return f"case when {status[parent]} is null then null when {above} is not null then {above} when {status[parent]} <> 'pass' then {parent} end"


def laddered(rung: int, status: dict[int, str]) -> str:
    """VRD-8: the status of a rung with its stoppers applied; a missing row stays missing."""
    if rung not in PARENT:
        return status[rung]
    return f"case when {status[rung]} is null then null when {stopper(rung, status)} is not null then 'skipped' else {status[rung]} end"


def exclusion(direction: str, payer: str, payee: str, owner: str, mint: str, block: str) -> str:
    """VRD-12: why a transfer isn't counted; ``counted`` if it is."""
    return f"""case when {direction} = 'out' then 'outgoing' when {is_burn(payer)} or {is_burn(payee)} then 'burn_address' when {same_address(payer, payee)} then 'self_transfer'
        when {same_address(payer, owner)} then 'owner_funding' when {mint} is null then 'mint_block_unknown' when {block} < {mint} then 'pre_mint' else 'counted' end"""


def payment_target(wallet: str, owner: str) -> str:
    """VRD-11 (verified wallet); no row where the wallet wasn't read."""
    return f"case when {wallet} is null then null when {is_burn(wallet)} then 'wallet_unset' when {same_address(wallet, owner)} then 'wallet_equals_owner' else 'eligible' end"


def seller_reachable(permitted: str, error: str, code: str) -> str:
    """VRD-13: rung 2 of a seller. A payment request is the expected answer."""
    return f"case when not {permitted} then 'refused' when {error} is not null then 'error' when {code} in ({_CODES}) then 'refused' else 'pass' end"


def seller_quotes(permitted: str, error: str, code: str, has_body: str) -> str:
    """VRD-13: rung 3 of a seller, before its quote is read."""
    return f"case when not {permitted} or {error} is not null or {code} in ({_CODES}) then 'skipped' when {code} <> {PAYMENT} then 'fail' when not {has_body} then 'fail' else 'pass' end"


def live(probeable: str, probed: str, live_n: str, answered: str, refused: str) -> str:
    """VRD-6b from an agent's counts of endpoints; null (no row) if none of the probeable ones was probed."""
    return f"case when {probeable} = 0 then 'unprobeable' when {probed} = 0 then null when {live_n} > 0 then 'pass' when {answered} > 0 then 'fail' when {refused} > 0 then 'refused' else 'error' end"


def settled(n_payments: str) -> str:
    """VRD-16 after exclusions."""
    return f"case when {n_payments} > 0 then 'pass' else 'fail' end"
