"""Page text to entries: furniture, footnotes, broken lines, candidate split, order-dependent merge."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.operators.skew import spread_join
from lexispark.session import cut, ship_package

# Abbreviations of entries, and endings of headword lines.
ABBREVIATIONS = (
    "abl.", "abs.", "absl.", "abrev.", "acus.", "adj.", "adv.", "cf.", "comp.", "conj.", "dat.", "dem.", "dep.", "dim.", "distrib.", "f.", "freq.", "fut.", "gen.", "impf.", "impess.", "indecl.",
    "inf.", "interj.", "interr.", "intr.", "loc.", "m.", "n.", "nom.", "num.", "ord.", "part.", "perf.", "pass.", "pes.", "pl.", "prep.", "prés.", "pr.", "pron.", "prev.", "reflex.", "sg.",
    "sent.", "sinc.", "subs.", "subj.", "superl.", "tr.", "v.", "voc.", " = ",
)
ENDINGS = ("ae", "i", "is", "us", "ei", "are", "ere", "ire", "atus", "itus")
RUNNING_HEAD = r"^(\p{Lu}[\p{Lu}\p{M}]+) +[—–-] +(\d+) +[—–-] +(\p{Lu}[\p{Lu}\p{M}]+)$"
HEAD_LINE = r"^[^\s].{0,40}?\s*,\s*(?:[^\n]*?\s)?(?:s|adj|v|adv|prep|conj|interj|pron|num|indecl|subst)\."
WINDOW = 5


def running_head(text: Column) -> Column:
    """First word, page and last word of the running head in the first line; null without one."""
    line = F.trim(F.regexp_extract(text, r"^([^\n]*)", 1))
    made = F.struct(F.regexp_extract(line, RUNNING_HEAD, 1).alias("first"), F.regexp_extract(line, RUNNING_HEAD, 2).cast("int").alias("page"), F.regexp_extract(line, RUNNING_HEAD, 3).alias("last"))
    return F.when(line.rlike(RUNNING_HEAD), made)


def strip_head(text: Column) -> Column:
    """Text without a running head, a lone capital or a rule in its first lines."""
    furniture = r"^(?:[^\n\p{Ll}]*\p{Lu}[^\n\p{Ll}]*[—–-][^\n\p{Ll}]*|\p{Lu}|[—–_-]{10,}|\s*)\n"
    for _ in range(3):
        text = F.regexp_replace(text, furniture, "")
    return text


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def cut_footnotes(text: Column, markers: list[str]) -> Column:
    """Text up to the first of each marker, then without page-number lines and everything from '(*)'."""
    for m in markers:
        at = F.instr(text, m)
        text = F.when(at > 0, _strip(F.substring_index(text, m, 1))).otherwise(text)
    text = F.regexp_replace(text, r"\n *(?:Página|p\.) *\d+ *(?=\n|$)", "\n")
    return F.when(F.instr(text, "(*)") > 0, _strip(F.substring_index(text, "(*)", 1))).otherwise(text)


def mend_lines(text: Column) -> Column:
    """Line ends repaired: hyphens joined, open brackets, numbers and abbreviations carried to the line before."""
    for pattern, new in (
        (r"(?<=\p{L})[-­¬]\s*\n\s*(?=\p{Ll})", ""),
        (r"\(([^()\n]*)\n([^()\n]*)\)", "($1 $2)"),
        (r"\n(?=\s*(?:[IVX]+|\d+)[.)]\s)", " "),
        (r"\n(?=\s*Sent\. (?:próprio|figurado))", " "),
        (r"\n(?=\s*\p{Lu}\p{L}{0,5}\. )", " "),
        (r"[ \t]+", " "),
    ):
        text = F.regexp_replace(text, pattern, new)
    return text


def abbreviation_run(text: Column) -> Column:
    """The abbreviations a text begins with, lower case, up to the first word that is none."""
    known = F.array(*[F.lit(a) for a in ABBREVIATIONS])
    words = F.split(F.lower(_strip(text)), r"[,\s]+")
    stop = F.array_position(F.transform(words, lambda w: F.array_contains(known, w)), False)
    return F.when(stop > 0, F.slice(words, 1, (stop - 1).cast("int"))).otherwise(words)


def headword_list(line: Column) -> Column:
    """Headwords of a line that names several: what stands before the first dash or abbreviation, parted by commas.

    Only where there are several and all are plain small letters; any other line gives what stands there as one.
    """
    bare = _strip(F.regexp_replace(_strip(F.regexp_replace(line, r"^\d+\.\s*", "")), r"^\d+\)\.\s*", ""))
    signs = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    block = _strip(F.regexp_replace(F.regexp_replace(bare, rf"(?s)\b(?:{signs})\b.*$", ""), r"(?s)\s+—\s+.*$", ""))
    words = F.filter(F.transform(F.split(block, ","), _strip), lambda w: w != "")
    several = (F.size(words) > 1) & F.forall(words, lambda w: w.rlike("^[a-z]{1,30}$"))
    return F.when(several, words).otherwise(F.array(block))


HEAD_WORD = r"[A-Z]?[a-zA-ZāēīōūȳăĕĭŏŭçâêîôûãõÁÉÍÓÚÂÊÎÔÛÃÕÇ\-]+"


def simple_entries(text: Column) -> Column:
    """Entries of a text by lines that begin with a headword and a comma: (number, lema, formas, definicao).

    formas end at the first full stop, the definition before the next such line; texts without one give an empty array.
    """
    opens = rf"(?m)^(?=\s*(?:\d+\.\s*)?{HEAD_WORD}(?:\s*\([^)\n]+\))?,\s)"
    parts = F.split(F.regexp_replace(text, opens, "\x01"), "\x01")
    shape = rf"(?s)^\s*(\d+\.)?\s*({HEAD_WORD}(?:\s*\([^)]+\))?),\s*(.*?)\.\s+(.*)$"
    own = F.filter(parts, lambda p: F.concat(p, F.lit("\n")).rlike(shape))
    get = lambda p, i: _strip(F.regexp_extract(F.concat(p, F.lit("\n")), shape, i))
    return F.transform(own, lambda p: F.struct(get(p, 1).alias("number"), get(p, 2).alias("lema"), get(p, 3).alias("formas"), F.replace(get(p, 4), F.lit("\n"), F.lit(" ")).alias("definicao")))


def chunk_headwords(chunks: DataFrame, key: str, text: str, known: DataFrame, cutoff: float = 0.7, n: int = 3) -> DataFrame:
    """Headwords a chunk of text speaks of: ``(key, headword)``.

    The words before the comma in the line after a rule (and in the first line) are certain; those of other lines count
    through their close matches among the ``known`` headwords (one column), if one of the certain ones has that initial.
    """
    from lexispark.operators.fuzzy import close_matches

    lines = chunks.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    lines = lines.withColumn("rule", F.startswith("line", F.lit("-" * 39)))
    head = F.filter(F.split(_strip(F.split_part(F.regexp_replace("line", r"^\d+\.\s*", ""), F.lit(","), F.lit(1))), r"\s+"), lambda w: w != "")
    before = Window.partitionBy("key").orderBy("at")  # the lines of one chunk
    spoken = lines.withColumn("fixed", F.coalesce(F.lag("rule").over(before), F.lit(True))).where("NOT rule").select("key", "fixed", F.explode(head).alias("word"))
    fixed = spoken.where("fixed").select("key", F.col("word").alias("headword"))
    near = close_matches(spoken.where("NOT fixed"), "word", known.toDF("w"), "w", n, cutoff).select(F.col("q").alias("word"), F.col("w").alias("headword"))
    found = spoken.where("NOT fixed").join(near, "word").select("key", "headword")
    initials = fixed.select("key", F.substring("headword", 1, 1).alias("i")).distinct()
    every = fixed.unionByName(found).distinct().withColumn("i", F.substring("headword", 1, 1))
    return every.join(initials, ["key", "i"], "left_semi").select("key", "headword")


def candidates(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Candidate entries in order: (doc, pos, candidate); what stands before the first headword line is dropped."""
    marked = F.regexp_replace(F.col(text), rf"(?im)(?={HEAD_LINE})", "\x01")
    parts = F.filter(F.slice(F.split(marked, "\x01"), 2, 1 << 30), lambda x: F.trim(x) != "")
    return df.select(F.col(doc).alias("doc"), F.posexplode(parts).alias("pos", "candidate")).select("doc", "pos", F.trim("candidate").alias("candidate"))


def _bare(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn")


def _head_word(text: str) -> str:
    """First word of a candidate's headword, without the number in front."""
    line = re.sub(r"^\d+\)?\.\s*", "", text.lstrip().split("\n", 1)[0].strip())
    words = line.split(",", 1)[0].split()
    return _bare(words[0]) if words else ""


def _shows_grammar(text: str) -> bool:
    """Whether a candidate begins with an abbreviation or an ending in its first 50 letters."""
    opening = _bare(text[:50]).strip()
    return any(_bare(a) in opening for a in ABBREVIATIONS) or not set(re.split(r"[ ,.]+", opening)).isdisjoint(ENDINGS)


def merge_candidates(parts: list[tuple[str, bool, bool]], window: str = "") -> tuple[list[tuple[bool, str]], str]:
    """Merge an ordered list of (candidate, headword known, headword behind 'i.' or 'l.' known): pieces (opens an entry,
    text) and the window after them.

    A candidate continues the entry before when it begins with no letter or with 'daí:', shows no grammar, or its first
    word is an abbreviation. An 'i.' or 'l.' before a known headword is a misread number and left out. Any other opens
    an entry when its initial fits the last WINDOW initials: one of them, a letter next to one of them, or x after v
    (there is no w). Initials of known headwords always join the window, those of others only when they open an entry;
    the first known headword always opens one. What came before matters only through ``window``.
    """
    signs = {_bare(a) for a in ABBREVIATIONS}
    pieces: list[tuple[bool, list[str]]] = []
    for text, known, known_behind in parts:
        head = _head_word(text)
        if head in ("i.", "l.") and known_behind:
            text = text.lstrip()[2:].lstrip()
            head, known = _head_word(text), True
        opens = False
        if head and head[0].isalpha() and head != "dai:" and head not in signs and _shows_grammar(text):
            initial = head[0]
            if known and not window:
                window = initial
            opens = any(abs(ord(initial) - ord(w)) <= 1 for w in window) or ("v" in window and initial == "x")
            if known or opens:
                window = (window + initial)[-WINDOW:]
        if opens or not pieces:
            pieces.append((opens, [text]))
        else:
            pieces[-1][1].append(text)
    return [(o, "\n".join(t)) for o, t in pieces], window


def segment(pages: DataFrame, doc: str, page: str, text: str, known: DataFrame, markers: list[str] | None = None, chunk_pages: int = 50) -> DataFrame:
    """Entries of documents: (doc, ordinal, entry).

    Pages are cleaned and cut into candidates by expressions, headwords looked up by a join. The order-dependent merge
    runs over chunks of ``chunk_pages`` pages, each started with the window its predecessor is believed to end with;
    chunks whose predecessor ended otherwise run again until nothing changes, so a document of any length is spread
    over tasks and the result is that of one pass. ``known`` has one column ``headword``. Null texts and documents give
    nothing; a page delivered twice counts once.
    """
    ship_package(pages.sparkSession)
    body = mend_lines(cut_footnotes(strip_head(F.col(text)), markers or []))
    usable = pages.where(F.col(text).isNotNull() & F.col(doc).isNotNull() & F.col(page).isNotNull()).dropDuplicates([doc, page])
    clean = usable.select(F.col(doc).alias("doc"), F.col(page).cast("int").alias("page"), body.alias("body"))
    c = clean.select("doc", "page", F.posexplode(F.split(F.regexp_replace("body", rf"(?im)(?={HEAD_LINE})", "\x01"), "\x01")).alias("pos", "candidate")).where(F.trim("candidate") != "")
    head = F.lower(F.regexp_extract("candidate", r"^\s*(?:\d+\)?\.\s*)?([\p{L}\p{M}]+)", 1))
    behind = F.lower(F.regexp_extract("candidate", r"^\s*[ilIL]\.\s*([\p{L}\p{M}]+)", 1))
    words = known.select(F.lower("headword").alias("h")).where("h != ''").distinct()
    flag = lambda name, column: words.select(F.col("h").alias(column), F.lit(True).alias(name))
    c = c.withColumn("h", head).withColumn("b", F.nullif(behind, F.lit(""))).join(flag("known", "h"), "h", "left")
    c = spread_join(c, flag("known_behind", "b"), "b")
    c = c.select("doc", F.floor(F.col("page") / chunk_pages).cast("int").alias("chunk"), "page", "pos", "candidate", F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("known_behind", F.lit(False)).alias("known_behind"))
    c = cut(c)
    order = Window.partitionBy("doc").orderBy("chunk")  # one short row a chunk
    starts = c.select("doc", "chunk").distinct().withColumn("start", F.lit(""))
    schema = "doc string, chunk int, start string, place int, opens boolean, entry string, ends string"

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["page", "pos"])
        made, ends = merge_candidates(list(zip(pdf["candidate"].str.strip(), pdf["known"], pdf["known_behind"])), pdf["start"].iloc[0])
        n = len(made)
        return pd.DataFrame({"doc": [pdf["doc"].iloc[0]] * n, "chunk": [int(pdf["chunk"].iloc[0])] * n, "start": [pdf["start"].iloc[0]] * n, "place": range(n), "opens": [o for o, _ in made], "entry": [t for _, t in made], "ends": [ends] * n})

    done = None
    while True:
        made = cut(c.join(starts, ["doc", "chunk"]).groupBy("doc", "chunk").applyInPandas(merge, schema))
        done = made if done is None else cut(done.join(starts, ["doc", "chunk"], "left_anti").unionByName(made))
        state = done.select("doc", "chunk", "start", "ends").distinct().withColumn("wanted", F.coalesce(F.lag("ends").over(order), F.lit("")))
        starts = cut(state.where("wanted != start").select("doc", "chunk", F.col("wanted").alias("start")))
        if not starts.head(1):
            break
    # a chunk's first piece may continue the last entry of the chunk before
    opened = done.groupBy("doc", "chunk").agg(F.count_if("opens").alias("n"), F.min_by("opens", "place").alias("first"))
    before = opened.withColumn("before", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("doc", "chunk", "before", "first")
    inside = F.when(F.col("first"), F.col("place") + 1).otherwise(F.col("place"))
    rows = done.join(before, ["doc", "chunk"]).select("doc", (F.col("before") + inside).cast("int").alias("ordinal"), "chunk", "place", "entry")
    whole = rows.groupBy("doc", "ordinal").agg(F.array_sort(F.collect_list(F.struct("chunk", "place", "entry"))).alias("x"))
    return whole.select("doc", "ordinal", F.array_join(F.transform("x", lambda e: e["entry"]), "\n").alias("entry"))


def entries_to_tables(pages: DataFrame) -> dict[str, DataFrame]:
    """Nested pages to entry, headword and example tables with stable ids (document, page, place)."""
    e = pages.select("doc_name", "page_num", "raw_text", F.posexplode("normalized_text").alias("i", "item"))
    e = e.withColumn("entry_key", F.concat_ws(":", "doc_name", F.col("page_num").cast("string"), F.col("i").cast("string")))
    entry = e.select("entry_key", "doc_name", "page_num", "raw_text", "item.morfologia", "item.definicao", "item.notas")
    lemma = e.select("entry_key", F.posexplode("item.lemas").alias("n", "forma")).where(F.trim("forma") != "").select("entry_key", "n", F.trim("forma").alias("forma"))
    example = e.select("entry_key", F.posexplode("item.exemplos").alias("n", "raw_ref")).where("raw_ref IS NOT NULL")
    return {"entry": entry, "lemma": lemma, "exemplo": example}
