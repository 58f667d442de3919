"""Problem 4: one consistent form for text that looks the same and differs in its characters.

The work is embedded SQL: every Arrow batch of a partition is handed to a DuckDB connection that
lives in the Python worker, and one statement maps invisible characters, spaces, compatibility
forms and look-alike letters and composes the result. Spark only moves Arrow batches.

Defined results
  null               -> null, not marked
  empty text         -> empty, not marked
  text already plain -> itself, not marked
  word wholly in a foreign alphabet -> itself; a word that mixes it with Latin letters is Latin
  very long text     -> handled whole; the statement has no length limit
Rows are never dropped, repeated rows stay repeated, other columns pass through untouched, and the
columns added by :func:`with_plain_form` replace columns of the same name.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_edges, turkish_lower
from ..session import spread

# Characters nobody sees.
INVISIBLE = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b"
    "\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\u3164\ufe0e\ufe0f\ufeff\uffa0"
)
# Spaces that are not U+0020.
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
# Latin-script, modifier and punctuation characters drawn like ordinary ones.
ALIKE_ALWAYS = {
    "ɑ": "a", "ɡ": "g", "ɩ": "ı", "ș": "ş", "Ș": "Ş", "ț": "ţ", "Ț": "Ţ", "\u0326": "\u0327", "ǃ": "!", "ʼ": "'", "ʹ": "'", "ˈ": "'",
    "‘": "'", "‛": "'", "′": "'", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-", "‚": ",", "⁄": "/", "∕": "/", "։": ":", "∶": ":",
}
# Letters of other alphabets drawn like Latin ones; they count as Latin in a mixed word only.
ALIKE_IN_WORD = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "к": "k", "ү": "y", "ь": "b",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ү": "Y", "Ӏ": "I", "Ԛ": "Q", "Ԝ": "W",
    "α": "a", "γ": "y", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
    "օ": "o", "ս": "u", "ո": "n", "հ": "h",
}
ORDINARY_SYMBOLS = "“”’…"
#: Letters, ASCII and the ordinary symbols: text of these alone is plain already, whatever SQL would do to it.
_SQL_PLAIN = r"\x00-\x7F¡-©«¬®-±´-¸»¿-ıĴ-ľŁ-ňŊ-žƀ-ǃǍ-ǰǴ-ȗȜ-ɏ“”’…]"
PLAIN_CLASS = f"[{_SQL_PLAIN}"


@cache
def compatibility() -> tuple[dict[str, str], dict[str, str]]:
    """Compatibility forms, by rule: every character whose NFKC form is ASCII or Latin letters and digits.

    Returned are those with a form of one character, for ``translate``, and the longer ones, for ``replace``.
    """
    one, more = {}, {}
    for cp in range(0x00A0, sys.maxunicode + 1):
        c = chr(cp)
        if c in ORDINARY_SYMBOLS or c in SPACES or 0x0300 <= cp < 0x0370:
            continue
        k = unicodedata.normalize("NFKC", c)
        if k == c or k == unicodedata.normalize("NFC", c) or not all(x.isascii() and x.isprintable() and x != " " or (x.isalpha() and ord(x) < 0x250) for x in k):
            continue
        if unicodedata.category(c)[0] == "L" or (unicodedata.category(c)[0] in "PSN" and "<" in unicodedata.decomposition(c)):
            (one if len(k) == 1 else more)[c] = k
    return one, more


@cache
def composed_alike() -> dict[str, str]:
    """Accented letters of other alphabets whose base has a Latin look-alike, by rule: ӧ is drawn like ö."""
    out = {}
    for cp in (*range(0x0370, 0x0530), *range(0x1F00, 0x2000)):
        d = unicodedata.normalize("NFD", chr(cp))
        if len(d) == 2 and d[0] in ALIKE_IN_WORD and len(k := unicodedata.normalize("NFC", ALIKE_IN_WORD[d[0]] + d[1])) == 1:
            out[chr(cp)] = k
    return out


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@cache
def plain_sql(source: str = "batch", value: str = "v") -> str:
    """The statement that adds ``plain`` and ``strange`` to ``source``; it runs in any DuckDB session."""
    one, more = compatibility()
    usual = {**dict.fromkeys(SPACES, " "), **ALIKE_ALWAYS}
    word = {**ALIKE_IN_WORD, **composed_alike()}
    first = f"translate(translate({value}, {_q(INVISIBLE)}, ''), {_q(''.join(usual))}, {_q(''.join(usual.values()))})"
    s = f"translate(_s, {_q(''.join(one))}, {_q(''.join(one.values()))})"
    longer = "".join(more)
    keys, values = (f"[{', '.join(map(_q, x))}]" for x in (more, more.values()))
    # Each character with a longer form is looked up, in values that hold one only.
    each = f"lambda t: coalesce(list_extract({values}, list_position({keys}, t)), t)"
    s = f"CASE WHEN regexp_matches(_s, '[{longer}]') THEN array_to_string(list_transform(regexp_extract_all({s}, '[{longer}]|[^{longer}]+'), {each}), '') ELSE {s} END"
    foreign = "\\p{Cyrillic}\\p{Greek}\\p{Armenian}"
    a, b = _q("".join(word)), _q("".join(word.values()))
    # A token is a run of letters and marks of a word; a word is what white space bounds.
    token = (
        f"CASE WHEN regexp_matches(t, '\\p{{Latin}}') OR NOT regexp_matches(translate(t, {_q(''.join(word))}, ''), '[{foreign}]') "
        f"THEN translate(t, {a}, {b}) ELSE t END"
    )
    mixed = (
        f"CASE WHEN regexp_matches(w, '[{foreign}]') AND regexp_matches(w, '\\p{{Latin}}') "
        f"THEN array_to_string(list_transform(regexp_extract_all(w, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+'), lambda t: {token}), '') ELSE w END"
    )
    return f"""
    WITH odd AS (SELECT *, regexp_matches({value}, '[^{_SQL_PLAIN}') AS _odd FROM {source}),
    first AS (SELECT *, CASE WHEN _odd THEN {first} ELSE {value} END AS _s FROM odd),
    seen AS (SELECT * REPLACE (CASE WHEN _odd AND regexp_matches(_s, '[^{_SQL_PLAIN[:-1]}\\p{{Cyrillic}}\\p{{Greek}}\\x{{0300}}-\\x{{036F}}]') THEN {s} ELSE _s END AS _s) FROM first),
    latin AS (SELECT * REPLACE (CASE WHEN _odd AND regexp_matches(_s, '[{foreign}]')
        THEN array_to_string(list_transform(regexp_extract_all(_s, '\\S+|\\s+'), lambda w: {mixed}), '') ELSE _s END AS _s) FROM seen),
    composed AS (SELECT * EXCLUDE (_s), CASE WHEN _odd THEN regexp_replace(nfc_normalize(_s), '(\\p{{Latin}})\\p{{Mn}}+', '\\1', 'g') ELSE _s END AS plain FROM latin)
    SELECT * EXCLUDE (_odd), CASE WHEN plain = {value} OR {value} IS NULL THEN false
        ELSE len(list_filter(string_split({value}, ''), lambda c: NOT contains(plain, c))) > 0 END AS strange
    FROM composed"""


def duckdb_connection():
    import duckdb

    return duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB"})


def _apply(batches: Iterator[pa.RecordBatch], value: str, schema: pa.Schema, only_strange: bool, keep: list[str]) -> Iterator[pa.RecordBatch]:
    con = duckdb_connection()
    con.execute("SET preserve_insertion_order = true")
    sql = plain_sql()
    for batch in batches:
        t = pa.table({"k": pa.array(range(batch.num_rows), pa.int64()), "v": batch.column(batch.schema.get_field_index(value)).cast(pa.string())})
        con.register("batch", t)
        got = con.sql(f"SELECT k, plain, strange FROM ({sql}) ORDER BY k").to_arrow_table()
        con.unregister("batch")
        cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
        out = pa.Table.from_arrays([*cols, got["plain"], got["strange"]], schema=schema)
        yield from out.to_batches()


def with_plain_form(df: DataFrame, value: str, plain: str = "plain", strange: str = "strange") -> DataFrame:
    """Add ``plain`` (the plain form of ``value``) and ``strange`` (whether ``value`` has a character its plain form lacks)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = [c for c in df.columns if c not in (plain, strange) or c == value]
    if value in (plain, strange):
        raise ValueError("the value and the new columns need different names")
    out = T.StructType([f for f in df.select(*(f"`{c}`" for c in keep)).schema] + [T.StructField(plain, T.StringType()), T.StructField(strange, T.BooleanType())])
    arrow = to_arrow_schema(out)
    return df.select(*(f"`{c}`" for c in keep)).mapInArrow(lambda it: _apply(it, value, arrow, False, keep), out)


def plain_lookup(values: DataFrame, value: str) -> DataFrame:
    """Distinct values that are not plain already, with their plain form: the dictionary other operators join to.

    Values of ordinary characters alone are their own plain form and never reach Python.
    """
    odd = values.select(F.col(value).alias("raw")).where(F.col("raw").rlike(rf"[^{PLAIN_CLASS[1:]}")).distinct()
    return with_plain_form(odd, "raw").select("raw", "plain")


def to_plain(df: DataFrame, *values: str) -> DataFrame:
    """Replace the given columns by their plain form, sending only distinct unusual values through SQL."""
    pairs = None
    for v in values:
        one = df.select(F.col(v).alias("raw"))
        pairs = one if pairs is None else pairs.unionAll(one)
    look = plain_lookup(pairs, "raw")
    for v in values:
        odd = F.col(v).rlike(rf"[^{PLAIN_CLASS[1:]}")
        # Ordinary rows get distinct null-like join keys through a left join on null: they match nothing and are not shuffled to one place.
        side = look.select(F.col("raw").alias("_raw"), F.col("plain").alias("_plain"))
        usual, strange = df.where(~odd | F.col(v).isNull()), df.where(odd)
        df = usual.unionByName(strange.join(side, F.col(v) == F.col("_raw"), "left").withColumn(v, F.coalesce("_plain", v)).drop("_raw", "_plain"))
    return df


def term_of(plain: Column | str) -> Column:
    """A word's plain form without outer characters that are neither letter nor digit, in lower case."""
    return turkish_lower(strip_edges(plain))


def latest_rows(df: DataFrame, columns: list[str], key: str = "clip_id", at: str = "appended_at") -> DataFrame:
    """One row per key, that of latest ``at``; among equals the greatest values decide, so the choice is stable."""
    new = F.max(F.struct(F.col(at).alias("_at"), *(F.col(c) for c in columns))).alias("_r")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(new).select(key, *(F.col(f"_r.{c}").alias(c) for c in columns))


def strange_clips(df: DataFrame, value: str, table_name: str) -> DataFrame:
    flagged = with_plain_form(spread(df.select("clip_id", "appended_at", F.col(value).alias("v"))), "v").select("clip_id", "appended_at", F.coalesce("strange", F.lit(False)).alias("strange"))
    return latest_rows(flagged, ["strange"]).where("strange").select(F.lit(table_name).alias("table_name"), "clip_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    words, sentences = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("word_clips", "sentence_clips"))
    return strange_clips(words, "surface_form", "word_clips").unionAll(strange_clips(sentences, "text", "sentence_clips"))


def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct written form that is not plain, with its plain form and the rows that carry it."""
    words, sentences = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("word_clips", "sentence_clips"))
    forms = words.select(F.lit("surface_form").alias("field"), F.col("surface_form").alias("v")).unionAll(sentences.select(F.lit("text"), "text"))
    counted = forms.where("v is not null").groupBy("field", "v").agg(F.count("*").alias("n_rows"))
    return with_plain_form(counted, "v").where("strange").select("field", F.col("v").alias("written"), "plain", "n_rows")


@cache
def _tables():
    import re

    one, more = compatibility()
    chars = {**dict.fromkeys(INVISIBLE, None), **dict.fromkeys(SPACES, " "), **one, **more, **ALIKE_ALWAYS}
    word = {**ALIKE_IN_WORD, **composed_alike()}
    odd = re.compile(r"[^\x00-\x7F¡-©«¬®-±´-¸»¿-ıĴ-ľŁ-ňŊ-žƀ-ǃǍ-ǰǴ-ȗȜ-ɏ“”’…]")
    return str.maketrans(chars), str.maketrans(word), frozenset(word), odd, re.compile(r"[Ͱ-ԯ԰-֏ἀ-῿]"), re.compile(r"[A-Za-zªºÀ-ÖØ-öø-ʯᴀ-ᴥḀ-ỿ]"), re.compile(r"[^\W\d_]+|[\W\d_]+"), re.compile(r"([A-Za-zªºÀ-ÖØ-öø-ʯᴀ-ᴥḀ-ỿ])[\u0300-\u036f]+")


def plain_text(s: str) -> str:
    """The plain form of one string, for operators already in Python; the same tables as the SQL."""
    chars, word, alike, odd, foreign, latin, tokens, marks = _tables()
    if not odd.search(s):
        return s
    s = s.translate(chars)
    if foreign.search(s):
        fixed = []
        for w in s.split(" "):
            if foreign.search(w) and latin.search(w):
                w = "".join(t.translate(word) if foreign.search(t) and (latin.search(t) or all(c in alike for c in t if foreign.match(c))) else t for t in tokens.findall(w))
            fixed.append(w)
        s = " ".join(fixed)
    return marks.sub(r"\1", unicodedata.normalize("NFC", s))
