"""Headword keys shared by the operators that compare headwords: clean form, homograph number, stroke skeleton."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark.functions.fold import fold
from lexispark.llm.visual import LOOKALIKES

# Words between two spellings of one headword.
ALTERNATIVE = r" (?:vel|seu|sive|aut|or|ou) "
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")


def clean_form(c: Column) -> Column:
    """Lower-case headword without accents, look-alike letters, invisible characters and odd blanks."""
    wide = "".join(chr(x) for x in range(0xFF01, 0xFF5F))
    plain = "".join(chr(x - 0xFEE0) for x in range(0xFF01, 0xFF5F))
    alike = LOOKALIKES
    x = F.translate(F.regexp_replace(c, r"\p{Cf}+", ""), wide + "".join(alike), plain + "".join(alike.values()))
    x = F.replace(F.replace(x, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))
    return F.trim(F.regexp_replace(F.lower(fold(x)), r"(?U)[\s\p{Z}]+", " "))


def homograph(form: Column) -> Column:
    """Number of a homograph written with its headword: '2. x', 'x (II)' or 'x2'; null without one."""
    roman = F.regexp_extract(form, r" ?\(([ivx]+)\)$", 1)
    number = F.coalesce(*[F.when(roman == r, F.lit(i + 1)) for i, r in enumerate(ROMAN)])
    digits = F.coalesce(F.nullif(F.regexp_extract(form, r"^(\d+)\. ?", 1), F.lit("")), F.nullif(F.regexp_extract(form, r"(\d+)$", 1), F.lit("")))
    return F.coalesce(number, F.try_to_number(digits, F.lit("999")).cast("int"))


def bare_form(form: Column) -> Column:
    """First spelling of a clean form, without homograph marks, hyphens and other signs."""
    x = F.regexp_replace(F.regexp_replace(form, r"^\d+\. ?", ""), r" ?\([ivx]+\)$|\d+$", "")
    return F.regexp_replace(F.get(F.split(x, ALTERNATIVE), F.lit(0)), r"[^a-z]+", "")


def single_consonants(bare: Column) -> Column:
    """Doubled consonants written once."""
    return F.regexp_replace(bare, r"([bcdfglmnprst])\1", "$1")


def skeleton(bare: Column) -> Column:
    """Stroke skeleton: letters that scanning confuses fall together.

    i and r are one stroke, n and u two, m three, so rn = m, in = m, ri = n, ii = u; d is cl; e is c, h is b, f is t,
    q is g; i, j, y and u, v are the same letter. The confusable forms of one word always share the skeleton; different
    words rarely do.
    """
    x = F.translate(bare, "jvy", "iui")
    x = F.replace(F.translate(x, "ehfqir", "cbtg||"), F.lit("d"), F.lit("cl"))
    return F.replace(F.replace(F.replace(x, F.lit("m"), F.lit("|||")), F.lit("n"), F.lit("||")), F.lit("u"), F.lit("||"))


def utc_time(c: Column) -> Column:
    """Timestamp of ISO-like text in UTC, whatever its separator and zone spelling; unreadable text gives null."""
    return F.try_to_timestamp(F.concat_ws(" ", F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})", 1), F.regexp_extract(c, r"^\d{4}-\d{2}-\d{2}[T ](\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)", 1)))
