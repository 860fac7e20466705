"""Quality rules, line first.

Each line is judged alone; lines that fail are removed, and a document that loses too much of its text is rejected.
The rules for a line with words:

* boilerplate: a phrase of BOILERPLATE in a line of at most 25 words;
* navigation: at least half of its words (of two or more) are menu words, or it has three or more menu separators and
  no sentence end;
* punctuation: one in five of its words or more carries a symbol of SYMBOLS; or it shouts, with doubled exclamation
  marks on half of its words; or it repeats one word on more than half of 12 or more words.

A line without a sentence end alone is no reason (headings, lists and verse are clean). A document is kept if its base
rules pass (50 words or more, and at most half of its words in repeated 3-word windows) and the removed lines hold at
most MOST_LOST of its words.

Nulls: a null text has no words and is not kept. Empty texts likewise. Repeated rows are judged each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.common import WORD, per_batch, table

WORDS = re.compile(WORD)
SYMBOLS = "#*$%&|<>"
HAS_SYMBOL = re.compile(r"[#*$%&|<>]")
#: Phrases of legal notes and page furniture, and words of menus, in four languages; compared in lower case. (Fixed values.)
BOILERPLATE = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of service", "terms of use", "subscribe to our newsletter", "javascript is disabled", "enable javascript",
    "click here", "lorem ipsum", "powered by", "sign up for",
    "tous droits réservés", "accepter les cookies", "politique de confidentialité", "conditions d’utilisation", "conditions générales", "abonnez-vous à", "cliquez ici",
    "alle rechte vorbehalten", "cookies akzeptieren", "datenschutzerklärung", "nutzungsbedingungen", "newsletter abonnieren", "hier klicken",
    "todos los derechos reservados", "aceptar cookies", "política de privacidad", "términos de uso", "condiciones de uso", "suscríbete a", "haga clic aquí",
)
MENU = frozenset(
    (
        "home about contact login logout menu search share next previous back top sitemap help faq news shop cart account register subscribe follow tweet print "
        "accueil connexion déconnexion recherche partager suivant précédent retour aide boutique panier compte imprimer "
        "startseite kontakt anmelden abmelden suche teilen weiter zurück hilfe impressum warenkorb konto drucken "
        "inicio contacto acceder salir buscar compartir siguiente anterior volver ayuda tienda carrito cuenta imprimir"
    ).split()
)
SEPARATORS = re.compile(r"[\x20\x09-\x0D][|>»•·/][\x20\x09-\x0D]")
ENDS = (".", "!", "?", "…", "。", '"', "”", "'", ")")
MOST_LOST = 0.5
MIN_WORDS = 50


def line_fails(line: str, words: list[str]) -> bool:
    n = len(words)
    low = line.lower()
    if n <= 25 and any(p in low for p in BOILERPLATE):
        return True
    if n >= 2 and 2 * sum(w.strip(".,:;|>»•·").lower() in MENU for w in words) >= n:
        return True
    if len(SEPARATORS.findall(line)) >= 3 and not line.rstrip(" \t\x0b\x0c\r").endswith(ENDS):
        return True
    if n >= 3:
        if HAS_SYMBOL.search(line) and 5 * sum(HAS_SYMBOL.search(w) is not None for w in words) >= n:
            return True
        if "!!" in line and 2 * sum("!!" in w for w in words) >= n:
            return True
        if n >= 12 and 2 * Counter(words).most_common(1)[0][1] > n:
            return True
    return False


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered, until = 0, 0
    for i, w in enumerate(windows):
        if w in often:
            covered += i + 3 - max(i, until)
            until = i + 3
    return covered


def judge(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned text, removed lines)."""
    text = text or ""
    all_words: list[str] = []
    seen: set[str] = set()
    kept_lines, duplicates, lost, removed = [], 0, 0, 0
    for line in text.split("\n"):
        words = WORDS.findall(line)
        if words:
            duplicates += line in seen
            seen.add(line)
            all_words += words
            if line_fails(line, words):
                lost += len(words)
                removed += 1
                continue
        kept_lines.append(line)
    n, repeated = len(all_words), repeated_words(all_words)
    failed = n < MIN_WORDS or 100 * repeated > 50 * n
    return n, sum(map(len, all_words)), sum(map(text.count, SYMBOLS)), duplicates, repeated, failed, not failed and lost <= MOST_LOST * n, "\n".join(kept_lines), removed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, the counts, base_failed, kept, n_removed_lines and (with_text) cleaned: the text without failing lines."""
    longs = [T.StructField(c, T.LongType()) for c in ["doc_id", *COUNTS]]
    schema = T.StructType([*longs, T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("n_removed_lines", T.LongType())])
    if with_text:
        schema = schema.add("cleaned", T.StringType())

    def work(ids: list, texts: list) -> dict:
        rows = list(zip(*map(judge, texts), strict=True)) or [()] * 9
        return {"doc_id": ids} | dict(zip([*COUNTS, "base_failed", "kept", "cleaned", "n_removed_lines"], map(list, rows), strict=True))

    return per_batch(docs, [F.col(id_col).cast("long"), F.col(text_col).cast("string")], work, schema)


def keep_good(docs: DataFrame, text_col: str = "text", rows: int = 500) -> DataFrame:
    """The rows of ``docs`` that are kept, with the text cut to the lines that stay; other columns as they are."""
    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found = [(v[6], v[7]) for v in map(judge, part.column(at).to_pylist())]
                kept = part.filter(pa.array([good for good, _ in found], pa.bool_()))
                yield kept.set_column(at, kept.schema.field(at), pa.array([text for good, text in found if good], kept.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents"), with_text=False)


def oracle() -> str:
    """DuckDB SQL for all columns."""
    boiler = " or ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)
    menu = ", ".join(f"'{w}'" for w in sorted(MENU))
    ends = " or ".join("ends_with(rtrim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '{}')".format(e.replace("'", "''")) for e in ENDS)
    words = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
    fails = rf"""((n <= 25 and ({boiler})) or (n >= 2 and 2 * len(list_filter(w, lambda x: lower(trim(x, '.,:;|>»•·')) in ({menu}))) >= n)
        or (len(regexp_extract_all(l, '[\x20\x09-\x0D][|>»•·/][\x20\x09-\x0D]')) >= 3 and not ({ends}))
        or (n >= 3 and (5 * len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]'))) >= n and regexp_matches(l, '[#*$%&|<>]')
            or 2 * len(list_filter(w, lambda x: contains(x, '!!'))) >= n and contains(l, '!!')
            or n >= 12 and 2 * list_max(map_values(list_histogram(w))) > n)))""".replace("list_histogram(w)", "list_aggregate(w, 'histogram')")
    return rf"""
    with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
    tl as (select r, doc_id, t, string_split(t, chr(10)) as ls from d),
    lines as (select r, i, ls[i] as l, {words.format('ls[i]')} as w from tl, range(1, len(ls) + 1) q(i)),
    judged as (select r, i, l, w, len(w) as n, n > 0 and {fails} as bad, row_number() over (partition by r, l order by i) > 1 and n > 0 as dup from lines),
    by_doc as (select r, coalesce(sum(n) filter (bad), 0)::bigint as lost, coalesce(sum(bad::int), 0)::bigint as n_removed_lines, coalesce(sum(dup::int), 0)::bigint as n_dup_lines from judged group by r),
    ws as (select r, doc_id, t, {words.format('t')} as w from d),
    win as (select r, i, count(*) over (partition by r, w[i], w[i+1], w[i+2]) as n from ws, range(1, len(w) - 1) q(i)),
    rep as (select r, count(distinct i + k)::bigint as n_repeat_words from win, range(0, 3) q(k) where n > 1 group by r),
    base as (select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::bigint as word_chars, (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words, n_words < {MIN_WORDS} or 100 * coalesce(n_repeat_words, 0) > 50 * n_words as base_failed, lost, n_removed_lines
        from ws left join by_doc using (r) left join rep using (r))
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and lost <= {MOST_LOST} * n_words as kept, n_removed_lines from base"""
