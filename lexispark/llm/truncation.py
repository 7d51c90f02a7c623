"""Texts cut off by field limits or transfers.

The method is a self-join by prefix. Texts are compared as copies may differ from one another (letters and digits
alone, without case, accents, spacing, punctuation and marks of a copy in front). Hashes of fixed-length prefixes, each
length twice the last, find the texts that can have a longer copy: a text looks for its own longest prefix length
only. Those are sorted (range partitions); a text whose successor continues it is a strict prefix of a longer copy. Only
neighbours are compared, so groups of copies never meet pairwise. The longer copy shows where the text breaks off: within
a word or a sentence, or where a sentence or line ends, which is no cut.

Where no longer copy is left, two kinds of further evidence tell cut texts:

* limit: lengths in characters or bytes at which one source has a spike of unfinished texts are its field limits;
  an unfinished text of exactly that length was cut.
* tail: how the last line ends, judged by the kind of text it closes (prose, verse, list, closing line).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions.fold import accent_table
from lexispark.functions.strings import let
from lexispark.operators.skew import spread_join
from lexispark.session import cut, ship_package

MIN_LETTERS = 12
PREFIX_LENGTHS = tuple(MIN_LETTERS * 2**i for i in range(18))
MIN_SHAPE_USES = 2  # texts whose complete list lines end in the same shape
LIMIT_NEIGHBOURS = 20
LIMIT_FACTOR = 8
LIMIT_LEAST = 4
LIMIT_SHARE = 0.02  # of the unfinished prose of a source: a few near copies of one length are no field limit
FINISHED = r"""[.!?…][»”"')\]]*$|[)\]]$"""
LIST_LINE = r"(?i)^[^,.!?]{2,60}, ?(?:-\p{L}|adj\b|s\.|v\.|adv\b|pron\b|prep\b|conj\b|num\b|interj\b|indecl).{0,24}$"
REFERENCE = r"^\p{Lu}\p{L}*\.(?: \p{Lu}\p{L}*\.){0,2} \d+(?:, \d+)+$"
CAPITALS = r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"
TITLE_LENGTH = 60
COPY_MARK = r"^(?:\[[^\]]{1,20}\]|[*•>]) +"
OPEN_BRACKET = r"\([^()\n]{0,40}$|«[^«»\n]{0,40}$"


def _verse_line(line: Column) -> Column:
    return line.rlike(r"^\p{Lu}") & ~line.rlike(r"[.!?…:;)\]»]$") & ~line.rlike(LIST_LINE) & (F.size(F.split(line, " ")) >= 2)


def _plain_line(line: Column) -> Column:
    """Line as copies may differ from it: single blanks, none before signs, no mark of a copy in front."""
    x = F.trim(F.regexp_replace(F.regexp_replace(line, r"(?U)\s+", " "), r" (?=[,.;:!?)])", ""))
    return F.regexp_replace(x, COPY_MARK, "")


def _share(lines: Column, test) -> Column:
    return F.when(F.size(lines) > 0, F.size(F.filter(lines, test)) / F.size(lines)).otherwise(F.lit(0.0))


def _text(body: Column) -> Column:
    return F.regexp_replace(body, r"(?U)\s+$", "")


def _unmarked(body: Column) -> Column:
    return F.regexp_replace(F.trim(body), COPY_MARK, "")


def _copy_form(body: Column) -> Column:
    """Form in which copies are compared: letters and digits without case and accents, no mark of a copy in front."""
    source, target = accent_table()
    return F.lower(F.translate(F.regexp_replace(_unmarked(body), r"[^\p{L}\p{N}]+", ""), source, target))


def _starts(form: Column) -> Column:
    """Hashes of the prefixes of fixed lengths a text has, the longest last."""
    lengths = F.array(*[F.lit(n) for n in PREFIX_LENGTHS])
    return let(F.length(form), lambda size: F.transform(F.filter(lengths, lambda n: n <= size), lambda n: F.xxhash64(n, F.substring(form, F.lit(1), n))))


def _shape(line: Column) -> Column:
    """What follows the headword of a list line, digits made equal."""
    return F.regexp_replace(F.regexp_extract(F.lower(line), r"^[^,]*(,.*)$", 1), r"\d+", "9")


def features(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """What the ends of the texts show, without the texts: ``id, source, raw, copy, starts, kind, last, shape, inner_shapes,
    n_chars, n_bytes, finished``. raw is a hash of the text, copy of its compared form, starts are those of its prefixes;
    inner_shapes are the shapes of a list's complete lines."""
    base = df.select(F.col(key).alias("id"), F.col(source).cast("string").alias("source"), F.coalesce(F.col(text), F.lit("")).alias("body"))

    def look(lines: Column) -> Column:
        last = F.coalesce(F.element_at(F.when(F.size(lines) > 0, lines), -1), F.lit(""))
        inner = F.when(F.size(lines) > 1, F.slice(lines, 1, F.size(lines) - 1)).otherwise(F.array().cast("array<string>"))
        listed = _share(inner, lambda x: x.rlike(LIST_LINE)) >= 0.6
        verse = _share(inner, _verse_line) >= 0.6
        shapes = F.when(listed, F.array_distinct(F.transform(inner, _shape))).otherwise(F.array().cast("array<string>"))
        return F.struct(last.alias("last"), F.size(inner).alias("n_inner"), listed.alias("listed"), verse.alias("verse"), (_share(inner, lambda x: x.rlike(CAPITALS)) >= 0.6).alias("shouted"), shapes.alias("shapes"))

    split = let(F.filter(F.transform(F.split(_text(F.col("body")), r"\r?\n"), _plain_line), lambda x: x != ""), look)
    f = base.select(
        "id", "source", F.xxhash64("body").alias("raw"), F.length("body").alias("n_chars"), F.octet_length("body").alias("n_bytes"), F.length(F.regexp_replace("body", r"\P{L}+", "")).alias("letters"),
        let(_copy_form(F.col("body")), lambda n: F.struct(F.md5(n).alias("copy"), _starts(n).alias("starts"))).alias("h"), split.alias("s"),
    ).select("*", "h.*", "s.*")
    # a line of capitals is a title or a closing line only where it is short and the text is not all in capitals
    upper = F.col("last").rlike(CAPITALS) & (F.length("last") <= TITLE_LENGTH) & ~F.col("shouted")
    closing = (F.col("n_inner") > 0) & (upper | F.col("last").rlike(r"^[—–-] ?\p{L}") | F.col("last").rlike(REFERENCE))
    kind = (
        F.when(F.col("letters") < MIN_LETTERS, "junk").when(closing, "closing").when(F.col("listed"), "list")
        .when(F.col("verse") & (_verse_line(F.col("last")) | (F.col("n_inner") >= 2)), "verse").when((F.col("n_inner") == 0) & upper, "heading").otherwise("prose")
    )
    finished = F.col("last").rlike(FINISHED) & ~F.col("last").rlike(OPEN_BRACKET)
    return f.select("id", "source", "raw", "copy", "starts", kind.alias("kind"), "last", _shape(F.col("last")).alias("shape"), F.col("shapes").alias("inner_shapes"), "n_chars", "n_bytes", finished.alias("finished"))


def field_limits(f: DataFrame) -> DataFrame:
    """Field limits ``(source, unit, n)``: lengths where unfinished prose of one source piles up; copies count once."""
    units = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("n_chars").alias("n")), F.struct(F.lit("bytes").alias("unit"), F.col("n_bytes").alias("n"))))
    counted = f.where(~F.col("finished") & (F.col("kind") == "prose") & F.col("source").isNotNull()).select("source", "copy", units.alias("u")).distinct().groupBy("source", "u.unit", "u.n").agg(F.count("*").alias("c"))
    near = Window.partitionBy("source", "unit").orderBy("n").rangeBetween(-LIMIT_NEIGHBOURS, LIMIT_NEIGHBOURS)
    around = (F.sum("c").over(near) - F.col("c")) / (2 * LIMIT_NEIGHBOURS)
    total = F.sum("c").over(Window.partitionBy("source", "unit"))
    spikes = counted.select("source", "unit", "n", "c", around.alias("around"), total.alias("total"))
    return spikes.where((F.col("c") >= LIMIT_LEAST) & (F.col("c") >= LIMIT_FACTOR * F.col("around")) & (F.col("c") >= LIMIT_SHARE * F.col("total"))).select("source", "unit", "n")


def break_off(text: str, longer: str, letters: int) -> str:
    """Where ``text`` stops, seen from a longer copy that goes on after ``letters`` letters and digits: in a ``word``, in
    a ``sentence``, at the end of a ``line`` whose sentence goes on, or at an ``end``. A text with a stop of its own that
    the longer one lacks is complete: another sentence that begins alike."""
    at = seen = 0
    while at < len(longer) and seen < letters:
        seen += unicodedata.category(longer[at])[0] in "LN"
        at += 1
    while at < len(longer) and unicodedata.combining(longer[at]):
        at += 1
    rest = longer[at:]
    own = re.sub(r"\s+", "", re.search(r"[\W_]*$", text)[0])
    if own and not re.sub(r"\s+", "", rest[: 4 * len(own) + 16]).startswith(own):
        return "end"
    if rest[:1].isalnum():
        return "word"
    signs, onward = re.match(r"([\W_]*)(.?)", rest, re.S).groups()
    lower = onward.islower() or onward.isdigit()
    if text.count("(") > text.count(")") or text.count("«") > text.count("»"):
        return "sentence"
    if re.search(r"[.!?…]", signs):  # after a short word the stop may belong to an abbreviation
        return "sentence" if lower and re.search(r"(?:^|[\W_])\w{1,4}[\W_]*$", text) else "end"
    if "\n" in signs:
        return "line" if lower else "end"
    return "sentence"


PREFIX_SCHEMA = "copy string, how string, role string, form string, shown string"


def _hits(found: list[tuple[str, str, str]]) -> pa.RecordBatch:
    """Rows (form, shown, longer shown) of prefixes found."""
    rows = [(f, break_off(s, l, len(f))) for f, s, l in found]
    none = pa.nulls(len(rows), pa.string())
    copies = [hashlib.md5(f.encode("utf-8", "surrogatepass")).hexdigest() for f, _ in rows]
    return pa.record_batch([pa.array(copies, pa.string()), pa.array([h for _, h in rows], pa.string()), pa.array(["hit"] * len(rows), pa.string()), none, none], ["copy", "how", "role", "form", "shown"])


def _continued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted texts of one partition: those that the next different text continues; the ends are handed on."""
    last = first = None
    for batch in batches:
        found = []
        for form, shown in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if first is None:
                first = form, shown
            elif form != last[0] and form.startswith(last[0]):
                found.append((*last, shown))
            last = form, shown
        yield _hits(found)
    if first is not None:
        none = pa.nulls(2, pa.string())
        yield pa.record_batch([none, none, pa.array(["first", "last"]), pa.array([first[0], last[0]]), pa.array([first[1], last[1]])], ["copy", "how", "role", "form", "shown"])


def _continued_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _hits([(f, s, l) for f, s, l in zip(*(c.to_pylist() for c in batch.columns))])


def strict_prefixes(texts: DataFrame) -> DataFrame:
    """``(copy, how)`` of the texts ``(form, shown)`` that are strict prefixes of others, compared by ``form``.

    how tells where the text breaks off (see break_off). Equal forms count once; null and empty ones are left out.
    """
    ship_package(texts.sparkSession)
    once = texts.where("form != ''").groupBy("form").agg(F.min("shown").alias("shown"))
    found = once.repartitionByRange("form").sortWithinPartitions("form").mapInArrow(_continued, PREFIX_SCHEMA)
    found = cut(found.withColumn("part", F.spark_partition_id()))
    # the last text of a partition is continued, if at all, by the first of the next partition that holds any
    order = Window.orderBy("part", "role")  # two rows a partition: first, last
    bound = found.where("role != 'hit'").select("form", "shown", "role", F.lead("form").over(order).alias("next"), F.lead("shown").over(order).alias("longer")).where("role = 'last'")
    across = bound.where(F.col("next").startswith(F.col("form")) & (F.col("next") != F.col("form"))).select("form", "shown", "longer").mapInArrow(_continued_across, PREFIX_SCHEMA)
    return found.where("role = 'hit'").select("copy", "how").unionByName(across.select("copy", "how")).distinct()


def with_longer_copies(f: DataFrame) -> DataFrame:
    """Hashes ``start`` of prefixes that a text has as its longest and that a different text has as well."""
    starts = f.where(F.size("starts") > 0).select("copy", F.element_at("starts", -1).alias("own"), F.explode("starts").alias("start"))
    shared = starts.groupBy("start").agg(F.min("copy").alias("lo"), F.max("copy").alias("hi"), F.max(F.col("own") == F.col("start")).alias("asked"))
    return shared.where("lo != hi AND asked").select("start")


def truncated(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row with its verdict: ``(id, source, kind, by_prefix, by_limit, by_tail, cut)``.

    Null and empty texts and texts of few letters are never cut; headings, verse, lists, references, signatures and other
    closing lines need no final stop, and are cut only where a longer copy goes on within their last word or sentence. Copies of a cut text are cut as well. A null source has no field limit.
    Repeated rows are all judged; columns of ``df`` beside the three named play no part.
    """
    f = cut(features(df, key, text, source))
    unfinished = ~F.col("finished") & ~F.col("kind").isin("junk", "closing")
    starts = f.where(F.size("starts") > 0).select("raw", F.explode("starts").alias("start"))
    wanted = cut(starts.join(with_longer_copies(f), "start", "left_semi").select("raw").distinct())
    body = df.select(F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("raw", F.xxhash64("body")).join(wanted, "raw", "left_semi")
    compared = body.select(_copy_form(F.col("body")).alias("form"), _unmarked(F.col("body")).alias("shown"))
    prefixes = cut(strict_prefixes(compared))
    marked = spread_join(f, prefixes, "copy")
    limits = field_limits(f)
    per_source = limits.groupBy("source").agg(F.collect_set(F.when(F.col("unit") == "chars", F.col("n"))).alias("by_chars"), F.collect_set(F.when(F.col("unit") == "bytes", F.col("n"))).alias("by_bytes"))
    marked = spread_join(marked, per_source, "source")
    # only unfinished lists are held against the shapes of complete lines
    shapes = f.where("kind = 'list'").select(F.explode("inner_shapes").alias("shape")).where("shape != ''").groupBy("shape").agg(F.count("*").alias("uses")).where(F.col("uses") >= MIN_SHAPE_USES)
    asked = F.when((F.col("kind") == "list") & unfinished, F.col("shape"))
    marked = spread_join(marked.withColumn("shape", asked), shapes.select("shape", F.lit(True).alias("whole_line")), "shape")
    at_limit = F.coalesce(F.array_contains("by_chars", F.col("n_chars")), F.lit(False)) | F.coalesce(F.array_contains("by_bytes", F.col("n_bytes")), F.lit(False))
    by_limit = unfinished & at_limit
    by_tail = unfinished & ((F.col("kind") == "prose") | ((F.col("kind") == "list") & F.col("whole_line").isNull()))
    breaks = F.col("how").isin("word", "sentence") | ((F.col("how") == "line") & (F.col("kind") == "prose"))
    by_prefix = (F.col("kind") != "junk") & F.coalesce(breaks, F.lit(False))
    return marked.select("id", "source", "kind", by_prefix.alias("by_prefix"), by_limit.alias("by_limit"), by_tail.alias("by_tail"), (by_prefix | by_limit | by_tail).alias("cut"))


def truncation_report(verdicts: DataFrame) -> DataFrame:
    """Share of cut texts per source, null sources in a row of their own."""
    n = lambda c: F.sum(F.col(c).cast("long"))
    return verdicts.groupBy("source").agg(F.count("*").alias("n_docs"), n("cut").alias("n_cut"), n("by_prefix").alias("n_by_prefix"), n("by_limit").alias("n_by_limit"), n("by_tail").alias("n_by_tail"), F.round(F.avg(F.col("cut").cast("double")), 6).alias("share_cut"))
