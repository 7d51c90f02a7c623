"""String, JSON and array scalars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark.functions.fold import collapse_space, fold, split_ligatures

BLANK = r" \"'\n"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` mentions it, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def non_blank(*columns: Column) -> Column:
    """First value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in columns])


def preview(c: Column, size: int = 500) -> Column:
    """At most ``size`` characters, with an ellipsis where text was left out."""
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit("…"))).otherwise(c)


def entry_prefix(label: Column) -> Column:
    """Entry number of a node label such as n00001.e01; null for other labels."""
    return F.nullif(F.regexp_extract(label, r"^(n\d+)", 1), F.lit(""))


def chunk_and_page(c: Column) -> Column:
    """(doc_name, page_num) of an id such as chunk_13:13:0; the page is null unless all digits."""
    page = F.split_part(c, F.lit(":"), F.lit(2))
    return F.struct(F.split_part(c, F.lit(":"), F.lit(1)).alias("doc_name"), F.when(page.rlike(r"^\d+$"), page.cast("int")).alias("page_num"))


def clean_list(c: Column) -> Column:
    """Items without quotes and line ends at their edges; blank items dropped."""
    return F.filter(F.transform(c, lambda x: F.btrim(x, F.lit(" \"'\n"))), lambda x: x != "")


def clean_punctuation(c: Column) -> Column:
    """Spaces before signs removed, doubled signs made single."""
    for wrong, right in ((" ,", ","), (" .", "."), (" ;", ";"), ("..", "."), (",,", ",")):
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return c


def case_like(template: Column, c: Column) -> Column:
    """``c`` in the case of ``template``: all capitals, all small, or a capital first letter."""
    first = F.substring(template, 1, 1)
    return (
        F.when((template == F.upper(template)) & (template != F.lower(template)), F.upper(c))
        .when(template == F.lower(template), F.lower(c))
        .when((first == F.upper(first)) & (first != F.lower(first)), F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 20)))
        .otherwise(c)
    )


def json_list(c: Column) -> Column:
    """JSON array of strings; anything unreadable gives an empty array."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def decode_escapes(c: Column) -> Column:
    """Decode \\uXXXX escapes; text that cannot be decoded stays as it is."""
    return F.coalesce(F.get(F.from_json(F.concat(F.lit('["'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"]')), "array<string>"), 0), c)


def labelled_text(parts: dict[str, Column], sep: str = " | ") -> Column:
    """Non-blank parts joined by ``sep``; a part with a name is written 'name: value'."""
    shown = [F.when(F.trim(v) != "", F.concat(F.lit(f"{k}: ") if k and not k.startswith("_") else F.lit(""), v)) for k, v in parts.items()]
    return F.concat_ws(sep, *shown)


def search_blob(*lists: Column) -> Column:
    """Sorted distinct tokens of more than two letters of all lists, folded, in one string."""
    tokens = F.flatten(F.transform(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists]), lambda x: F.split(split_ligatures(F.lower(fold(x))), r"[ ,;]+")))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(tokens, lambda x: F.length(x) > 2))), " ")


def forms_before_commas(c: Column) -> Column:
    """Every word of ASCII letters and hyphens that a comma follows, as an array."""
    return F.regexp_extract_all(c, F.lit(r"([a-zA-Z\-]+),"), 1)


def tagged(values: Column, lang: str) -> Column:
    """Values of an array that carry the language tag, without it."""
    return F.transform(F.filter(values, lambda x: F.endswith(x, F.lit(f"@{lang}"))), lambda x: F.btrim(F.regexp_replace(x, rf"@{lang}$", ""), F.lit('"')))


def page_bucket(page: Column, size: int = 100) -> Column:
    return F.floor(F.coalesce(page, F.lit(0)) / size).cast("int")


def headword_line(c: Column) -> Column:
    """Headword, variants after 'ou'/'v.', endings and the rest of a headword line."""
    t = collapse_space(c)
    head = F.trim(F.regexp_extract(t, r"^([^,(]+)", 1))
    variants = F.regexp_extract_all(t, F.lit(r"(?:\bou\b|\bv\.) ([\p{L}-]+)"), 1)
    endings = F.regexp_extract_all(t, F.lit(r"(?:^|[ ,])(-[\p{L}]+)"), 1)
    rest = F.trim(F.regexp_replace(F.regexp_replace(t, r"^[^,(]+", ""), r"^(?:, ?-[\p{L}]+)+,? ?", ""))
    return F.struct(head.alias("lema"), variants.alias("variants"), endings.alias("endings"), rest.alias("description"))


def is_proper(c: Column) -> Column:
    return F.trim(c).rlike(r"^\p{Lu}")
