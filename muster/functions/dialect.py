"""The few places where Spark SQL and DuckDB SQL differ. Queries name them as $[name|argument]."""

from __future__ import annotations

import re

#: Distinct trigrams of a text in lower case, padded by two spaces before and one behind. (Spark's substr counts characters from the
#: first byte on, and a lambda lowers the text again for each place; a regular expression goes over the text once.)
_TRI = ("array_distinct(slice(regexp_extract_all(concat('  ', lower({0}), ' '), '(?s)(?=(...)).', 1), 1, length({0}) + 1))", "list_distinct(list_transform(range(1, length({0}) + 2), lambda i: substr(concat('  ', lower({0}), ' '), i, 3)))")

#: Unicode's white space at the beginning or end of a text. (Fixed values; no braces, which would name a table.)
_SPACE = r"[\x09-\x0D " + "\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
_SPACES = f"^{_SPACE}|{_SPACE}$"

#: name -> (Spark, DuckDB); each is a function of its arguments.
_FORMS = {
    "json": (lambda c, k: f"get_json_object({c}, '$.{k}')", lambda c, k: f"json_extract_string({c}, '$.{k}')"),
    "re": (lambda c, p: f"regexp_like({c}, '{p}')", lambda c, p: f"regexp_matches({c}, '{p}')"),
    "set": (lambda c: f"array_join(array_sort(collect_set({c})), ',')", lambda c: f"array_to_string(list_sort(list_distinct(list({c}))), ',')"),
    "days": (lambda c, d: f"datediff(cast({c} as date), date '{d}')", lambda c, d: f"date_diff('day', date '{d}', cast({c} as date))"),
    "sub": (lambda c, p, r: f"regexp_replace({c}, '{p}', '{r}')", lambda c, p, r: f"regexp_replace({c}, '{p}', '{r}', 'g')"),
    "words": (lambda c: f"filter(split(lower({c}), '[^a-zà-ÿ0-9]+'), w -> w <> '')", lambda c: f"list_filter(regexp_split_to_array(lower({c}), '[^a-zà-ÿ0-9]+'), lambda w: w <> '')"),
    "has": (lambda a, x: f"array_contains({a}, {x})", lambda a, x: f"list_contains({a}, {x})"),
    "part": (lambda c, sep, i: f"element_at(split({c}, '{sep}'), {i})", lambda c, sep, i: f"split_part({c}, '{sep}', {i})"),
    "explode": (lambda src, name: f"lateral view explode({src}) as {name}", lambda src, name: f", unnest({src}) as u_{name}({name})"),
    "seq": (lambda a, b: f"sequence({a}, {b})", lambda a, b: f"range({a}, {b} + 1)"),
    "array": (lambda *x: f"array({', '.join(x)})", lambda *x: f"[{', '.join(x)}]"),
    "tri": (lambda c: _TRI[0].format(c), lambda c: _TRI[1].format(c)),
    "ntri": (lambda c: f"size({_TRI[0].format(c)})", lambda c: f"len({_TRI[1].format(c)})"),
    "both": (lambda a, b: f"size(array_intersect({_TRI[0].format(a)}, {_TRI[0].format(b)}))", lambda a, b: f"len(list_intersect({_TRI[1].format(a)}, {_TRI[1].format(b)}))"),
    "bare": (lambda c: f"regexp_replace({c}, r'{_SPACES}', '')", lambda c: f"regexp_replace({c}, '{_SPACES}', '', 'g')"),
    "text": (lambda c: f"cast({c} as string)", lambda c: f"cast({c} as varchar)"),
    "digits": (lambda c: f"try_cast({c} as decimal(38,0))", lambda c: f"try_cast({c} as decimal(38,0))"),
}


def write(text: str, duck: bool) -> str:
    """Fill ``$[name|arg|arg]`` pieces, innermost first."""
    piece = re.compile(r"\$\[(\w+)\|([^\[\]$]*)\]")
    while m := piece.search(text):
        form = _FORMS[m[1]][duck](*m[2].split("|"))
        text = text[: m.start()] + form.replace("$.", "\0.") + text[m.end() :]
    return text.replace("\0.", "$.")
