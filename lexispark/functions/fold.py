"""Text folding: the normaliser family as Catalyst expressions.

Spark has no ``normalize()``; the accent table is generated from the Unicode database once per process and applied
with ``translate``, so every normaliser stays inside whole-stage codegen.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters and signs of other scripts that scanned Latin text confuses with plain ones.
LOOKALIKE_PAIRS = (
    ("у", "y"), ("а", "a"), ("е", "e"), ("о", "o"), ("р", "p"), ("с", "c"), ("х", "x"), ("і", "i"), ("ѕ", "s"),
    ("υ", "u"), ("α", "a"), ("ο", "o"), ("ν", "v"), ("ı", "i"), ("ſ", "s"),
    ("–", "-"), ("—", "-"), ("‐", "-"), ("‑", "-"), ("−", "-"), ("’", "'"), ("‘", "'"),
)
SOFT_HYPHEN = "­"
FOLD_RANGES = ((0x00C0, 0x0250), (0x0370, 0x0530), (0x1E00, 0x2000))


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Precomposed letters whose canonical decomposition is one letter plus marks, and those letters."""
    source, target = [], []
    for lo, hi in FOLD_RANGES:
        for code in range(lo, hi):
            parts = [c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn"]
            if len(parts) == 1 and parts[0] != chr(code):
                source.append(chr(code))
                target.append(parts[0])
    return "".join(source), "".join(target)


def fold(c: Column) -> Column:
    """Strip accents: precomposed letters are mapped, loose combining marks are dropped. Nulls stay null."""
    source, target = accent_table()
    return F.regexp_replace(F.translate(c, source, target), r"\p{Mn}+", "")


def ascii_only(c: Column) -> Column:
    """Strip accents, then drop everything outside ASCII (ligatures and ordinal signs vanish)."""
    return F.regexp_replace(fold(c), r"[^\x00-\x7F]", "")


def unaccent_lower(c: Column) -> Column:
    """Accent- and case-insensitive comparison key."""
    return F.replace(F.lower(fold(c)), F.lit("ß"), F.lit("ss"))


def collapse_space(c: Column) -> Column:
    """Runs of white space become one blank; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def plain_lookalikes(c: Column) -> Column:
    source = "".join(a for a, _ in LOOKALIKE_PAIRS) + SOFT_HYPHEN
    return F.translate(c, source, "".join(b for _, b in LOOKALIKE_PAIRS))


def split_ligatures(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("æ"), F.lit("ae")), F.lit("œ"), F.lit("oe"))


def dictionary_key(c: Column) -> Column:
    """Lookup key of a headword: accents, look-alikes, case and ligatures removed."""
    return split_ligatures(F.lower(plain_lookalikes(unaccent_lower(c))))


def words_only(c: Column) -> Column:
    """``dictionary_key`` without ligature splitting, punctuation dropped, blanks collapsed."""
    return collapse_space(F.regexp_replace(F.lower(plain_lookalikes(unaccent_lower(c))), r"(?U)[^\w\s\-]", ""))


def latin_key(c: Column, merge_ij_uv: bool = True, drop_hyphen: bool = True, keep_spaces: bool = False) -> Column:
    """Strict headword key; ``i/j`` and ``u/v`` are merged, punctuation, hyphens and blanks dropped by flag."""
    x = plain_lookalikes(unaccent_lower(c))
    if merge_ij_uv:
        x = F.translate(x, "jv", "iu")
    x = F.regexp_replace(split_ligatures(x), r"[.,;:!?'\"()\[\]{}*†‡§¶]", "")
    if drop_hyphen:
        x = F.regexp_replace(x, r"[-_]", "")
    return collapse_space(x) if keep_spaces else F.regexp_replace(x, r"(?U)\s+", "")


def suggest_key(c: Column) -> Column:
    """Key for correction suggestions: ``i/j``, ``u/v`` merged, symbols dropped, words kept apart."""
    x = F.translate(F.lower(fold(c)), "jvſ", "ius")
    return collapse_space(F.regexp_replace(x, r"[.,;:!?'\"()\[\]{}*†‡§¶]", ""))


def dedupe_key(c: Column) -> Column:
    """Case, blanks, ``j`` and ``v`` normalised; accents kept."""
    return F.translate(collapse_space(F.lower(c)), "jv", "iu")


def lemma_key(c: Column, merge_ij_uv: bool = False) -> Column:
    """Accent-free lower-case headword with single blanks; ``merge_ij_uv`` joins i/j and u/v too."""
    x = collapse_space(unaccent_lower(F.trim(c)))
    return F.translate(x, "jv", "iu") if merge_ij_uv else x


def uvij_key(c: Column) -> Column:
    """Vector-index key: u and v become v, i and j become i."""
    return F.translate(unaccent_lower(c), "uj", "vi")


def latin_basic(c: Column) -> Column:
    """ASCII, lower case, brackets and quotes to blanks."""
    return collapse_space(F.regexp_replace(F.lower(ascii_only(c)), r"[()'\"]", " "))


def slugify(c: Column, default: str = "volume") -> Column:
    """URL slug; an empty result becomes ``default``."""
    x = F.regexp_replace(F.lower(fold(c)), r"[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(x, r"^-+|-+$", ""), F.lit("")), F.lit(default))


def file_name(c: Column) -> Column:
    """Safe file name: everything but letters, digits, dot, dash and underscore becomes an underscore."""
    return F.regexp_replace(ascii_only(c), r"[^A-Za-z0-9._-]+", "_")


def hyphen_agnostic(c: Column) -> Column:
    return F.regexp_replace(F.lower(fold(c)), r"[-‐‑–]", "")


def letters_only(c: Column) -> Column:
    """The sequence of ASCII letters alone: two texts with equal keys differ in accents, case or signs only."""
    return F.regexp_replace(F.lower(fold(c)), r"[^a-z]", "")


def first_letter(c: Column, other: str = "#", letters: bool = False) -> Column:
    """Upper-case first letter without accent; ``letters`` sends everything outside A-Z to ``other``."""
    x = F.upper(F.substring(F.trim(fold(c)), 1, 1))
    if letters:
        return F.when(x.rlike("^[A-Z]$"), x).otherwise(F.lit(other))
    return F.coalesce(F.nullif(x, F.lit("")), F.lit(other))
