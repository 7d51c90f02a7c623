"""Repair of text extracted from scanned pages.

Method: every line is classed (page furniture, article text) with array expressions, so no text is torn apart over a
shuffle; lines at the edges of pages that come back at the edges of other pages of the document are furniture as well,
whatever they look like. Misread words are found with anagram hashes: the hash of a word is the sum of the fifth powers of
its letters' codes, so a confusion of letters always changes it by the same difference. The differences of the known
confusions, alone and in pairs, join rare words to frequent ones in SQL. Signs that no word of the language has need no
known confusion: without them a form has the hash of a word less one or two letters. Candidates are verified by edit
distance and ranked by frequency. Hyphens at line ends are judged by the corpus: where the two halves occur elsewhere as a hyphened
word more often than as one word, the hyphen belongs to the word. A word broken without any mark is found where its halves
make a known word and hardly occur alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions.fold import unaccent_lower
from lexispark.functions.strings import let
from lexispark.session import cut

# What scanning makes of letters (true text, misread text).
CONFUSIONS = (
    ("a", "o"), ("e", "c"), ("o", "0"), ("i", "!"), ("t", "f"), ("l", "1"), ("n", "u"), ("s", "5"), ("v", "y"), ("p", "þ"),
    ("h", "b"), ("b", "h"), ("m", "rn"), ("rn", "m"), ("u", "ii"), ("d", "cl"), ("cl", "d"), ("é", "6"), ("ri", "n"), ("in", "m"),
    ("g", "q"), ("ç", "c"), ("ã", "á"), ("u", "n"), ("c", "e"), ("f", "t"), ("l", "i"), ("l", "!"), ("í", "i"), ("q", "g"), ("ó", "6"), ("b", "6"), ("g", "9"), ("z", "2"),
)
BREAK_MARKS = r"[-­¬=‐]"
MIN_USES = 3
LETTER_CODES = 4093  # codes are taken modulo this prime, so that words of any script stay in the range of BIGINT
FREQUENT_SHARE = 20  # a word is rare against a variant that is this many times as frequent
COMMON_WORDS = 5000  # the most frequent sound words are dropped before the exact join; the list has this fixed length
FIRST_PAGES = 12  # an article's page numbers may be this far from its first page, and one more for every
LINES_PER_PAGE = 5  # so many of its lines
EDGE_LINES = 2
EDGE_PAGES = 3  # an edge line that comes back on so many pages of a document,
EDGE_SHARE = 0.4  # and on this share of the pages from its first to its last, is furniture
EDGE_LETTERS = 6
HEADING = r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"


@dataclass(frozen=True)
class PageText:
    """One text column: table name, key columns for rec_key, field, page number, and whether rows are whole pages."""

    df: DataFrame
    tab: str
    key: Column
    field: str
    page: Column
    doc: Column
    whole_page: bool


def _upper_share(line: Column) -> Column:
    letters = F.length(F.regexp_replace(line, r"\P{L}+", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(line, r"\P{Lu}+", "")) / letters).otherwise(F.lit(0.0))


def line_kind(line: Column, page: Column, whole_page: bool, line_no: Column) -> Column:
    """'blank', 'pagenum', 'header' or 'text'.

    A page number stands alone, in brackets, between dashes or after a word for page, and fits the page (within an
    article the pages that follow count too; an unknown page fits any). A header is a rule, a single capital, or a line
    of capitals without the comma and lower-case labels of an entry.
    """
    t = F.trim(F.regexp_replace(line, r"(?U)\s+", " "))
    number = F.try_to_number(F.nullif(F.regexp_extract(t, r"(?i)^(?:p\.|pp\.|pág\.|pag\.|página|pagina)?[ \[—–-]*(\d{1,6})[ \]—–-]*$", 1), F.lit("")), F.lit("999999"))
    fits = page.isNull() | (number == page) if whole_page else page.isNull() | number.between(page - 1, page + FIRST_PAGES + F.floor(line_no / LINES_PER_PAGE))
    rule = t.rlike(r"^[-—–_=*~ .]{4,}$") & ~t.rlike(r"^[. ]+$")
    # one or two letters of a line of capitals may be misread as small ones
    capitals = (F.length(F.regexp_replace(t, r"\P{L}+", "")) >= 6) & (_upper_share(t) >= 0.85) & ~t.rlike(r"[,;:()]") & ~t.rlike(r"\p{Ll}{2,}\.?$")
    single = t.rlike(r"^\p{Lu}\.?$")
    return F.when(t == "", "blank").when(F.coalesce(number.isNotNull() & fits, F.lit(False)), "pagenum").when(rule | single | capitals, "header").otherwise("text")


def classed_lines(p: PageText) -> DataFrame:
    """One row per text: ``tab, rec_key, field, doc, page, lines`` with lines an array of (line_no, line, kind).

    Null keys and texts give no row; a page delivered twice counts once.
    """
    base = p.df.select(F.lit(p.tab).alias("tab"), p.key.alias("rec_key"), F.lit(p.field).alias("field"), p.doc.alias("doc"), p.page.cast("int").alias("page"), F.col(p.field).alias("body"))
    base = base.where(F.col("rec_key").isNotNull() & F.col("body").isNotNull())
    if p.whole_page:
        base = base.dropDuplicates(["rec_key", "body"])
    split = F.transform(F.split("body", "\n"), lambda x, i: F.struct((i + 1).cast("int").alias("line_no"), F.regexp_replace(x, r"[\r\s]+$", "").alias("line"), line_kind(x, F.col("page"), p.whole_page, i + 1).alias("kind")))
    classed = base.select("tab", "rec_key", "field", "doc", "page", split.alias("lines"))
    return _with_edges(base, classed) if p.whole_page else classed


def _with_edges(base: DataFrame, classed: DataFrame) -> DataFrame:
    """Lines at the edges of pages that come back at the edges of their document's pages, close together, become headers.

    Compared by their letters alone. Only the edges are read for it, and only the few lines that are not furniture by
    their looks are carried along.
    """
    full = F.filter(F.transform(F.split("body", "\n"), lambda x, i: F.struct((i + 1).cast("int").alias("line_no"), x.alias("line"))), lambda x: F.trim(x["line"]) != "")
    ends = let(full, lambda a: F.array_distinct(F.concat(F.slice(a, 1, EDGE_LINES), F.slice(a, F.greatest(F.size(a) - EDGE_LINES + 1, F.lit(1)), EDGE_LINES))))
    rows = base.where(F.col("doc").isNotNull() & F.col("page").isNotNull()).select("rec_key", "doc", "page", F.explode(ends).alias("l")).select("rec_key", "doc", "page", "l.*")
    rows = rows.select("rec_key", "doc", "page", "line_no", line_kind(F.col("line"), F.col("page"), True, F.col("line_no")).alias("kind"), F.regexp_replace(unaccent_lower(F.col("line")), r"\P{L}+", "").alias("letters"))
    rows = rows.where(F.length("letters") >= EDGE_LETTERS).select("rec_key", "doc", "page", "line_no", "kind", F.xxhash64("letters").alias("letters"))
    back = rows.groupBy("doc", "letters").agg(F.count_distinct("page").alias("pages"), (F.max("page") - F.min("page") + 1).alias("span"), F.max(F.col("kind") == "text").alias("asked")).where((F.col("pages") >= EDGE_PAGES) & (F.col("pages") >= EDGE_SHARE * F.col("span")) & F.col("asked")).select("doc", "letters")
    heads = rows.where("kind = 'text'").join(back, ["doc", "letters"], "left_semi").groupBy("rec_key").agg(F.collect_set("line_no").alias("heads"))
    marked = F.transform("lines", lambda x: F.when((x["kind"] == "text") & F.array_contains("heads", x["line_no"]), x.withField("kind", F.lit("header"))).otherwise(x))
    return classed.join(cut(heads), "rec_key", "left").withColumn("lines", F.when(F.col("heads").isNotNull(), marked).otherwise(F.col("lines"))).drop("heads")


def _ends_broken(line: Column) -> Column:
    return F.coalesce(line.rlike(rf"\p{{L}}{BREAK_MARKS} *$"), F.lit(False))


def _goes_on(line: Column) -> Column:
    return line.isNull() | line.rlike(r"^ *[\p{Ll}!\d]")


def judged_lines(p: PageText) -> DataFrame:
    """Every line that is not blank, judged: ``tab, rec_key, field, line_no, kind, words, left, right, marked``.

    ``words`` are the unbroken words of an article line. ``left`` and ``right`` are its last word and the first letters
    of the next article line (on the next page where the page ends); ``marked``: a break mark stands between them.
    """
    classed = classed_lines(p).withColumn("art", F.filter("lines", lambda x: x["kind"] == "text"))
    none = F.lit(None).cast("string")
    if p.whole_page:
        # first and last article line of every page, for the pages before and after it: two short lines a page
        edges = cut(classed.where((F.size("art") > 0) & F.col("page").isNotNull()).select("doc", "page", F.col("art")[0]["line"].alias("first"), F.element_at("art", -1)["line"].alias("last")).dropDuplicates(["doc", "page"]))
        after = edges.select(F.col("doc").alias("a_doc"), F.col("page").alias("a_page"), F.col("first").alias("after"))
        before = edges.select(F.col("doc").alias("b_doc"), F.col("page").alias("b_page"), F.col("last").alias("before"))
        classed = classed.join(after, (F.col("doc") == F.col("a_doc")) & (F.col("page") + 1 == F.col("a_page")), "left").join(before, (F.col("doc") == F.col("b_doc")) & (F.col("page") - 1 == F.col("b_page")), "left")
    else:
        classed = classed.withColumn("after", none).withColumn("before", none)
    n = F.size("art")
    around = F.transform("art", lambda x, i: F.struct(x["line_no"].alias("line_no"), F.lit("text").alias("kind"), x["line"].alias("line"), F.when(i + 1 < n, F.get("art", i + 1)["line"]).otherwise(F.col("after")).alias("next"), F.when(i > 0, F.get("art", i - 1)["line"]).otherwise(F.col("before")).alias("prior")))
    rest = F.transform(F.filter("lines", lambda x: x["kind"].isin("header", "pagenum")), lambda x: F.struct(x["line_no"].alias("line_no"), x["kind"].alias("kind"), none.alias("line"), none.alias("next"), none.alias("prior")))
    rows = classed.select("tab", "rec_key", "field", F.explode(F.concat(around, rest)).alias("a")).select("tab", "rec_key", "field", "a.*")
    line, nxt, prior = F.col("line"), F.col("next"), F.col("prior")
    rows = rows.select("tab", "rec_key", "field", "line_no", "kind", line, nxt, (_ends_broken(line) & _goes_on(nxt)).alias("marked"), (_ends_broken(prior) & _goes_on(line)).alias("carried"), words_of(line).alias("w"))
    w = F.when(F.col("carried"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1)))).otherwise(F.col("w"))
    rows = rows.withColumn("w", w)
    w = F.when(F.col("marked"), F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0)))).otherwise(F.col("w"))
    low = F.lower("line")
    left = F.when(F.col("marked"), F.regexp_extract(low, rf"([\p{{L}}\p{{M}}]+){BREAK_MARKS} *$", 1)).when(line.rlike(r"\p{Ll}$") & nxt.rlike(r"^\p{Ll}"), F.regexp_extract(low, r"(?:^|[ («])([\p{L}\p{M}]+)$", 1))
    return rows.select("tab", "rec_key", "field", "line_no", "kind", w.alias("words"), left.alias("left"), F.when(left.isNotNull(), F.lower(F.regexp_extract(nxt, r"^ *([\p{L}\p{M}]+)", 1))).alias("right"), F.coalesce("marked", F.lit(False)).alias("marked"))


def words_of(line: Column) -> Column:
    """Lower-case words of a line; signs that misreading puts inside words belong to them."""
    return F.filter(F.transform(F.split(F.lower(line), r"(?U)\s+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{M}\d!]+|[^\p{L}\p{M}\d!¬=­-]+$", "")), lambda w: w != "")


def anagram_hash(word: Column) -> Column:
    """Sum of the fifth powers of the codes of a word's letters: equal for anagrams, shifted by a constant for a confusion.

    Null for texts without blanks so long that the sum leaves the range of BIGINT; they are no words.
    """
    return F.aggregate(F.filter(F.split(word, ""), lambda c: c != ""), F.lit(0).cast("bigint"), lambda a, c: F.try_add(a, letter_value(c)))


def letter_value(c: Column) -> Column:
    x = F.ascii(c).cast("bigint") % LETTER_CODES
    return x * x * x * x * x


def text_value(text: str) -> int:
    """The same of a Python string."""
    return sum((ord(c) % LETTER_CODES) ** 5 for c in text)


def hash_differences() -> list[tuple[int, int]]:
    """(difference, letters that may differ) of one or two known confusions; equal differences keep the larger bound."""
    single = [(text_value(b) - text_value(a), max(len(a), len(b))) for a, b in CONFUSIONS]
    out: dict[int, int] = {}
    for d, n in single:
        out[d] = max(out.get(d, 0), n)
    for i, (d, n) in enumerate(single):
        for e, m in single[i:]:
            out[d + e] = max(out.get(d + e, 0), n + m)
    out.pop(0, None)
    return sorted(out.items())


def misread_words(counts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Misread forms ``(word, correction)`` among counted words.

    ``counts`` (word, uses) holds every word of the texts, ``lexicon`` (word) the words of the language to be
    corrected. A form outside the lexicon, whose hash differs from a lexicon word's by a known difference, that is near
    it letter by letter and rare against it, is a misreading of it; the most frequent such word is the correction.
    Words of one letter are never corrected, words of two or three letters only where a digit or sign stands in them or
    a pair of letters was misread as one or the other way round.
    """
    known = lexicon.select("word").where(F.col("word").isNotNull()).distinct()
    sound = known.join(counts, "word", "left").select(F.col("word").alias("correction"), F.coalesce("uses", F.lit(0)).alias("right_uses")).withColumn("h", anagram_hash(F.col("correction")))
    shifts = F.array(*[F.struct(F.lit(d).cast("bigint").alias("shift"), F.lit(b).alias("bound")) for d, b in hash_differences()])
    keyed = sound.select("correction", "right_uses", "h", F.explode(shifts).alias("s")).select("correction", "right_uses", "s.bound", (F.col("h") + F.col("s.shift")).alias("h"))
    odd = counts.where(F.length("word") >= 2).join(known, "word", "left_anti").where(F.col("word").rlike(r"\p{L}") & ~F.col("word").rlike(r"^-|-$|[¬=­]")).withColumn("h", anagram_hash(F.col("word")))
    pairs = odd.join(keyed, "h").where((F.levenshtein("word", "correction") <= F.col("bound")) & (F.abs(F.length("word") - F.length("correction")) <= 2))
    pairs = pairs.where((F.col("right_uses") >= FREQUENT_SHARE * F.col("uses")) | F.col("word").rlike(r"[\d!þ]"))
    short = F.length("word") <= 3
    pairs = pairs.where(~short | F.col("word").rlike(r"[\d!þ]") | ((F.length("word") != F.length("correction")) & (F.length("word") == 3)))
    # two edits in a short word would reach too far
    pairs = pairs.where((F.levenshtein("word", "correction") <= 1) | (F.length("correction") >= 5) | (F.length("word") != F.length("correction")) | F.col("word").rlike(r"[\d!þ]"))
    pairs = pairs.select("word", "correction", "right_uses").unionByName(_foreign_signs(odd.select("word"), sound.select("correction", "right_uses", "h")))
    return pairs.groupBy("word").agg(F.max(F.struct("right_uses", "correction")).alias("best")).select("word", F.col("best")["correction"].alias("correction"))


def _foreign_signs(odd: DataFrame, sound: DataFrame) -> DataFrame:
    """Forms with one or two signs that no word of the language has, and the words they may stand for.

    Without its foreign signs a form has the anagram hash of the word less one or two letters for each.
    """
    letters = sound.select(F.explode(F.split("correction", "")).alias("c")).where("c != ''").groupBy("c").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_USES)
    alphabet = letters.agg(F.array_join(F.collect_set("c"), "").alias("alphabet"))  # one row: the letters of a language
    rest = F.filter(F.split("word", ""), lambda c: (c == "") | F.contains(F.col("alphabet"), c))
    bare = odd.crossJoin(F.broadcast(alphabet)).select("word", F.array_join(rest, "").alias("bare"), (F.length("word") - F.size(F.filter(rest, lambda c: c != ""))).alias("foreign"))
    bare = bare.where(F.col("foreign").between(1, 2) & (F.length("bare") >= 3)).select("word", "foreign", anagram_hash(F.col("bare")).alias("h"))
    codes = F.filter(F.split("correction", ""), lambda c: c != "")
    one = F.transform(codes, letter_value)
    two = F.flatten(F.transform(codes, lambda a, i: F.transform(F.slice(codes, i + 2, F.size(codes)), lambda b: letter_value(a) + letter_value(b))))
    less = sound.where(F.length("correction") >= 4).select("correction", "right_uses", "h", F.explode(F.array_distinct(F.concat(one, two))).alias("v")).select("correction", "right_uses", (F.col("h") - F.col("v")).alias("h"))
    met = bare.join(less, "h").where(F.levenshtein("word", "correction") <= 2)
    return met.select("word", "correction", "right_uses").distinct()


def lexicon_of(texts: DataFrame, column: str) -> DataFrame:
    """Words used at least MIN_USES times in texts of the language."""
    words = texts.select(F.explode(words_of(F.col(column))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("uses")).where(F.col("uses") >= MIN_USES).select("word")


@dataclass
class Repair:
    """Everything found in the texts, before it is reported or applied."""

    lines: DataFrame  # judged lines, written once
    hyphens: DataFrame
    wrong: DataFrame


def broken_words(lines: DataFrame, counts: DataFrame) -> DataFrame:
    """Keys of the lines whose last word goes on in the next line and has no hyphen of its own there."""
    key = ["tab", "rec_key", "field", "line_no"]
    uses = lambda name: counts.where("uses >= 2").select(F.col("word").alias(name), F.col("uses").alias(f"{name}_uses"))
    # hyphens of their own: hyphened words seen within lines, against the joined form
    compound = counts.where(F.col("word").rlike(r"^\p{L}+-\p{L}+$")).select(F.col("word").alias("hyphened"), F.col("uses").alias("h_uses"), F.regexp_replace("word", "-", "").alias("joined"))
    own = compound.join(uses("joined"), "joined", "left").where(F.col("h_uses") > F.coalesce("joined_uses", F.lit(0))).select("hyphened", F.lit(True).alias("own"))
    marked = lines.where("marked").select(*key, F.concat_ws("-", "left", "right").alias("hyphened")).join(own, "hyphened", "left").where(F.col("own").isNull()).select(*key)
    # breaks without a mark: the halves make a word of the corpus and at least one of them hardly occurs alone
    bare = lines.where("NOT marked AND left != '' AND right != ''").select(*key, "left", "right", F.concat("left", "right").alias("joined"))
    bare = bare.join(uses("joined"), "joined").join(uses("left"), "left", "left").join(uses("right"), "right", "left")
    silent = bare.where(2 * F.least(F.coalesce("left_uses", F.lit(0)), F.coalesce("right_uses", F.lit(0))) <= F.col("joined_uses")).select(*key)
    return marked.unionByName(silent)


def examine(pages: list[PageText], language: DataFrame, column: str) -> Repair:
    """Judge lines, find broken words, and misread words of the language of ``language.column``.

    The texts are read once: judged lines and the word counts are written to the shared folder and reused.
    """
    parts = [judged_lines(p) for p in pages]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    lines = cut(every)
    counts = cut(lines.where("kind = 'text'").select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("uses")))
    misread = cut(misread_words(counts, lexicon_of(language, column)))
    common = counts.join(misread, "word", "left_anti").orderBy(F.desc("uses"), "word").limit(COMMON_WORDS).select("word")
    rare = lines.where("kind = 'text'").select("tab", "rec_key", "field", "line_no", F.explode("words").alias("word")).join(F.broadcast(common), "word", "left_anti")
    wrong = rare.join(misread, "word").select("tab", "rec_key", "field", "line_no", "word", "correction")
    return Repair(lines, broken_words(lines, counts), wrong)


def noise(pages: list[PageText], language: DataFrame, column: str) -> DataFrame:
    """Lines with noise ``(tab, rec_key, field, line_no, kind)``: header, pagenum, hyphen, misread.

    One row per line and kind. Null and empty texts give none; a page delivered twice is reported once. Words broken at
    a line end are judged as broken, not as misread. Without texts of the language nothing counts as misread.
    """
    r = examine(pages, language, column)
    furniture = r.lines.where("kind != 'text'").select("tab", "rec_key", "field", "line_no", "kind")
    hyphen = r.hyphens.withColumn("kind", F.lit("hyphen"))
    misread = r.wrong.select("tab", "rec_key", "field", "line_no", F.lit("misread").alias("kind")).distinct()
    return furniture.unionByName(hyphen).unionByName(misread)


def repaired(pages: list[PageText], language: DataFrame, column: str) -> DataFrame:
    """Repaired texts ``(tab, rec_key, field, text)``: furniture removed, broken words joined, misread words corrected.

    Lines of a paragraph become one line; blank lines part paragraphs, entries and pages. Texts of furniture alone
    become empty texts.
    """
    r = examine(pages, language, column)
    fixes = r.wrong.groupBy("tab", "rec_key", "field", "line_no").agg(F.map_from_entries(F.collect_set(F.struct("word", "correction"))).alias("fix"))
    joins = r.hyphens.select("tab", "rec_key", "field", "line_no", F.lit(True).alias("join_next"))
    every = None
    for p in pages:
        part = classed_lines(p).select("tab", "rec_key", "field", F.explode("lines").alias("l")).select("tab", "rec_key", "field", "l.*")
        every = part if every is None else every.unionByName(part)
    key = ["tab", "rec_key", "field", "line_no"]
    every = every.where(F.col("kind").isin("text", "blank")).join(fixes, key, "left").join(joins, key, "left")
    empty = F.create_map().cast("map<string,string>")

    def corrected(word: Column, fix: Column) -> Column:
        core = F.regexp_extract(word, r"^[^\p{L}\p{M}\d!]*(.*?)[^\p{L}\p{M}\d!]*$", 1)
        good = fix[F.lower(core)]
        cased = F.when(F.substring(core, 1, 1) != F.lower(F.substring(core, 1, 1)), F.initcap(good)).otherwise(good)
        return F.when(good.isNotNull(), F.replace(word, core, cased)).otherwise(word)

    line = F.array_join(F.transform(F.split("line", " "), lambda w: corrected(w, F.coalesce("fix", empty))), " ")
    body = F.when(F.col("join_next"), F.regexp_replace(line, rf"{BREAK_MARKS} *$", "")).when(F.col("kind") == "blank", F.lit("\n\n")).when(F.col("line").rlike(r"\p{L}-$"), line).otherwise(F.concat(line, F.lit(" ")))
    text = every.groupBy("tab", "rec_key", "field").agg(F.array_sort(F.collect_list(F.struct("line_no", body.alias("body")))).alias("parts"))
    whole = F.array_join(F.transform("parts", lambda x: x["body"]), "")
    return text.select("tab", "rec_key", "field", F.trim(F.regexp_replace(F.regexp_replace(whole, r" *\n+ *", "\n\n"), r" +", " ")).alias("text"))
