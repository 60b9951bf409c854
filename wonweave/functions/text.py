"""Text normalisers. They differ on purpose; see the names' comments."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wonweave.functions.columns import col

#: Fixed values.
STOP_TOKENS = ("위한", "및", "등", "관련", "사업", "지원", "추진", "관리", "운영", "기본", "경비", "인건비", "소관", "부처", "실국", "기관", "계정", "분야", "부문", "일반", "회계")


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(T.StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def _filled(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def collapse(c: Column | str) -> Column:
    """White space to single spaces, trimmed."""
    return F.trim(F.regexp_replace(_filled(c), r"(?U)\s+", " "))


def title_key(c: Column | str, normalized: bool = True) -> Column:
    """For title comparison: NFKC, tags out, middle dots out, everything but word characters out, lower case. The normalisation comes first, so U+318D stays as the letter that it becomes."""
    x = nfkc(_filled(c)) if normalized else _filled(c)
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), "[·‧]", ""), r"(?U)[^\w가-힣]+", ""))


def plain_key(c: Column | str) -> Column:
    """Lower case; only digits, Latin letters and Hangul syllables; no Unicode normalisation."""
    return F.regexp_replace(F.lower(_filled(c)), "[^0-9a-z가-힣]+", "")


def name_key(c: Column | str) -> Column:
    """As plain_key, of the NFKC form."""
    return plain_key(nfkc(_filled(c)))


def clean(c: Column | str) -> Column:
    """NFKC with white space collapsed."""
    return collapse(nfkc(_filled(c)))


def readable(c: Column | str) -> Column:
    """Character references decoded, NFKC, white space collapsed."""
    return collapse(nfkc(unescape_html(_filled(c))))


def heading_text(c: Column | str) -> Column:
    """Character references decoded, NFC, white space collapsed, tildes as hyphens."""
    return collapse(heading_lines(c))


def heading_lines(c: Column | str) -> Column:
    """As heading_text(), with lines and white space as they are."""
    return F.replace(F.translate(F.replace(nfc(unescape_html(_filled(c))), F.lit("\\~"), F.lit("-")), "～〜", "--"), F.lit("~"), F.lit("-"))


def tokens(c: Column | str, normalized: bool = True) -> Column:
    """Distinct words of two characters or more, lower case, without stop words and numbers; and the whole key if it has four."""
    x = nfkc(_filled(c)) if normalized else _filled(c)
    words = F.regexp_extract_all(F.regexp_replace(x, r"<[^>]+>|[\[\](){}「」『』<>]", " "), F.lit("[가-힣A-Za-z0-9]{2,}"), F.lit(0))
    kept = F.filter(F.transform(words, lambda w: F.lower(w)), lambda w: ~w.isin(*STOP_TOKENS) & ~w.rlike(r"^\d+$"))
    whole = title_key(c, normalized)
    return F.array_union(kept, F.when(F.length(whole) >= 4, F.array(whole)).otherwise(F.array().cast("array<string>")))


def bigrams(c: Column | str) -> Column:
    """Distinct pairs of neighbouring characters."""
    chars = F.regexp_extract_all(col(c), F.lit("(?s)."), F.lit(0))
    n = F.greatest(F.size(chars) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(chars, F.lit(1), n).alias("a"), F.slice(chars, F.lit(2), n).alias("b"))
    return F.array_distinct(F.transform(pairs, lambda p: F.concat(p["a"], p["b"])))


def only_references(c: Column | str, references: Iterable[str]) -> Column:
    """An & that begins none of these character references is escaped, so that decoding gives it back."""
    return F.regexp_replace(col(c), f"&(?!{'|'.join(re.escape(r.removeprefix('&')) for r in references)})", "&amp;")


def markup_to_lines(c: Column | str, tables: bool = False) -> Column:
    """br and closing tags end a line (with `tables` cells end with a tab, and image markup and table rules go), other tags are spaces; lines are trimmed of spaces and bars, empty ones dropped."""
    x = F.regexp_replace(_filled(c), r"(?i)<br\s*/?>", "\n")
    if tables:
        x = F.regexp_replace(F.regexp_replace(x, r"!\[[^\]]*\]\([^)]*\)", " "), r"(?i)</t[dh]\s*>", "\t")
    x = F.regexp_replace(F.regexp_replace(x, r"(?i)</(p|div|tr|li|h[1-6]|table|td|th)\s*>", "\n"), "<[^>]+>", " ")
    lines = F.transform(F.split(unescape_html(x), "\n"), lambda s: F.regexp_replace(F.regexp_replace(s, "[ \\t]+", " "), r"^[ |]+|[ |]+$", ""))
    lines = F.filter(lines, lambda s: (s != "") & (~s.rlike(r"^[|:\- ]+$") if tables else F.lit(True)))
    return F.array_join(lines, "\n")


def unmarked(line: Column) -> Column:
    """A line without heading marks and bullets."""
    return F.regexp_replace(F.regexp_replace(line, r"^#{1,6}\s*", ""), "^[ \\-·□○ㅇ]+|[ \\-·□○ㅇ]+$", "")


def excerpt(c: Column | str, limit: int) -> Column:
    """Lines of markup without heading marks and bullets, each once, cut at `limit` characters."""
    lines = F.transform(F.split(markup_to_lines(c, True), "\n"), unmarked)
    return F.rtrim(F.left(F.array_join(F.array_distinct(F.filter(lines, lambda s: s != "")), "\n"), F.lit(limit)))
