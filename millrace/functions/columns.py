"""Column functions: decoding, dates, normalisation, codes, JSON text. Each returns a `Column` and stays in the JVM."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator, Mapping, Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def decode(c: Column, mapping: Mapping[str, str], otherwise: str | None = None) -> Column:
    """Label of a code; null (or `otherwise`) for codes that are not listed."""
    out = F.lit(otherwise).cast("string")
    for code, label in reversed(mapping.items()):
        out = F.when(c == code, F.lit(label)).otherwise(out)
    return out


def classify_like(c: Column, patterns: Sequence[tuple[str, str]], ignore_case: bool = False) -> Column:
    """Label of the first LIKE pattern that fits, else null."""
    fits = (lambda p: c.ilike(p)) if ignore_case else (lambda p: c.like(p))
    return F.coalesce(*(F.when(fits(p), F.lit(label)) for p, label in patterns))


def parse_date(c: Column, fmt: str = "yyyyMMdd", strict: bool = False) -> Column:
    """Date of a text; empty is null, and so is what can't be read unless `strict`."""
    filled = F.nullif(F.trim(c), F.lit(""))
    return F.to_date(filled, fmt) if strict else F.to_date(F.try_to_timestamp(filled, F.lit(fmt)))


def open_ended(c: Column, sentinel: str = "99991231", fmt: str = "yyyyMMdd") -> Column:
    return F.when(c != sentinel, parse_date(c, fmt))


def in_force(start: Column, end: Column, on: Column, end_inclusive: bool = True) -> Column:
    return (start <= on) & (end.isNull() | ((end >= on) if end_inclusive else (end > on)))


def within_lookback(c: Column, as_of: Column, months: int) -> Column:
    return c.between(F.add_months(as_of, -months), as_of)


def is_distinct_from(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def status_and_reason(cases: Sequence[tuple[Column, str, str]]) -> tuple[Column, Column]:
    """Status and reason of the first case that holds."""
    pick = lambda k: F.coalesce(*(F.when(case[0], F.lit(case[k])) for case in cases))
    return pick(1), pick(2)


def hash_bucket(c: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(n))


def millis_between(a: Column, b: Column) -> Column:
    return F.unix_millis(b) - F.unix_millis(a)


def elapsed_hours(a: Column, b: Column) -> Column:
    """Hours that have passed, not hour boundaries crossed."""
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(3.6e9)


def norm_name(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.upper(c), "[^A-Z]", ""), F.lit(""))


def norm_zip(c: Column) -> Column:
    return F.nullif(F.substring(F.regexp_replace(c, "[^0-9]", ""), 1, 5), F.lit(""))


def _letters(text: str) -> str:
    return re.sub("[^a-z]", "", unicodedata.normalize("NFKD", text).lower())


@pandas_udf(T.StringType())
def _plain_letters(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Text by text, so that only one is held decomposed."""
    for texts in batches:
        yield texts.map(_letters, na_action="ignore")


@cache
def _plain() -> tuple[str, str, str]:
    """(characters that stand for one letter, their letters, characters that stand for several), as each character is decomposed by itself."""
    single, letters, several = [], [], []
    for k in (*range(65, 91), *range(128, 0xD800), *range(0xE000, sys.maxunicode + 1)):
        found = _letters(chr(k))
        if len(found) == 1:
            single.append(chr(k))
            letters.append(found)
        elif found:
            several.append(chr(k))
    return "".join(single), "".join(letters), "".join(several)


def norm_ascii(c: Column) -> Column:
    """Lower-case letters without accents or anything else: characters are decomposed (NFKD) and what is not a letter of a-z is dropped.

    Characters are exchanged one for one; only texts with one that stands for several letters (a ligature, a unit) go to Python."""
    single, letters, several = _plain()
    rare = c.rlike(f"[{several}]")
    return F.coalesce(_plain_letters(F.when(rare, c)), F.regexp_replace(F.translate(c, single, letters), "[^a-z]", ""))


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(f"^(?:{pattern})$")


def luhn_valid(c: Column, prefix: str = "80840") -> Column:
    """Whether the check digit of a ten-digit number holds; null for anything else."""
    return F.when(full_match(c, "[0-9]{10}"), F.call_function("luhn_check", F.concat(F.lit(prefix), c)))


def dotted_icd(c: Column) -> Column:
    return F.when(F.length(c) > 3, F.concat(F.substring(c, 1, 3), F.lit("."), F.substring(c, 4, 60))).otherwise(c)


def ndc11(c: Column) -> Column:
    """Eleven digits of a three-part package code, each part padded on the left (5, 4, 2)."""
    parts = F.split(c, "-")
    return F.when(F.size(parts) == 3, F.concat(*(F.lpad(F.get(parts, F.lit(k)), w, "0") for k, w in enumerate((5, 4, 2)))))


def narrative(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def json_text(c: Column, path: str) -> Column:
    return F.get_json_object(c, path)


def json_exists(c: Column, path: str) -> Column:
    return F.get_json_object(c, path).isNotNull()


def json_len(c: Column, path: str) -> Column:
    return F.json_array_length(F.get_json_object(c, path))


def lsn_to_long(c: Column) -> Column:
    """Log position `high/low` (hexadecimal) as one number."""
    part = lambda k: F.conv(F.get(F.split(c, "/"), F.lit(k)), 16, 10).cast("long")
    return F.shiftleft(part(0), 32) + part(1)


def strip_char_padding(c: Column, declared: str) -> Column:
    return F.rtrim(c) if declared.lower().startswith("char") else c


def mib(c: Column, digits: int = 2) -> Column:
    return F.round(c / 1048576, digits)


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def iso_instant(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def ordered_list(c: Column, order: Column, when: Column | None = None) -> Column:
    """Aggregate: values of a group in order (nulls and rows that `when` leaves out are skipped)."""
    pair = F.struct(order.alias("o"), c.alias("v"))
    return F.transform(F.sort_array(F.collect_list(pair if when is None else F.when(when, pair))), lambda x: x.v)


def precision_recall(hits: Column, predicted: Column, actual: Column, digits: int = 4) -> tuple[Column, Column]:
    return F.round(F.try_divide(hits, predicted), digits), F.round(F.try_divide(hits, actual), digits)


def rate_pct(when: Column, digits: int = 1) -> Column:
    """Aggregate: per cent of rows for which `when` holds."""
    return F.round(100.0 * F.count_if(when) / F.count(F.lit(1)), digits)


def exact_sum(c: Column, digits: int = 2) -> Column:
    """Aggregate: sum that doesn't depend on the order of rows."""
    return F.sum(c.cast(f"decimal(18,{digits})")).cast("double")


def typed(c: Column, kind: str) -> Column:
    """A text as a type, null where it is not one."""
    return F.nullif(F.trim(c), F.lit("")).try_cast(kind)


def release_year_start(at: Column, month: int = 10) -> Column:
    """The first day of the release year that a date lies in."""
    year = F.year(at)
    return F.when(F.month(at) >= month, F.make_date(year, F.lit(month), F.lit(1))).otherwise(F.make_date(year - 1, F.lit(month), F.lit(1)))
