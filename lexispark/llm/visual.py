"""One consistent spelling for texts that look alike.

Method: distinct texts are exploded to positioned code points. A broadcast join maps each to its decomposition, combining
class and plain look-alike; words wholly in Greek letters keep their letters. Marks are ordered by class within the
cluster of their letter; a second broadcast join brings the compositions that the letter can enter, the cluster is
recomposed, and the strings are rebuilt. Both tables come from the Unicode database (all planes; Hangul syllables are
left as they are) and have a fixed size, whatever the data. Texts made of consistent characters only are recognised by
one pattern and skip the explosion.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.functions.strings import let
from lexispark.operators.skew import spread_join
from lexispark.session import cut

# Letters of other scripts that look like Latin ones.
LATIN_LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Ѕ": "S", "Т": "T", "Х": "X", "Ү": "Y",
    "а": "a", "в": "b", "е": "e", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ȷ": "j", "ſ": "s", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ӏ": "l", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ո": "n", "ս": "u", "օ": "o", "հ": "h", "Օ": "O", "Տ": "S",
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H",
    "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}
# Small capitals of the Latin script by their names.
SMALL_CAPITALS = {chr(x): unicodedata.name(chr(x))[-1].lower() for x in range(0x250, 0x1E00) if re.fullmatch("LATIN LETTER SMALL CAPITAL [A-Z]", unicodedata.name(chr(x), ""))}
LOOKALIKES = LATIN_LOOKALIKES | SMALL_CAPITALS
DASHES = "‐‑‒–—―−﹘﹣－"

def _plain_pattern() -> str:
    """Pattern of the texts that are consistent as they stand: ASCII signs, composed Latin letters, single inner blanks."""

    def fits(code: int) -> bool:
        c = chr(code)
        latin = unicodedata.category(c)[0] == "L" and unicodedata.name(c, "").startswith("LATIN") and unicodedata.normalize("NFKC", c) == c
        return 0x21 <= code <= 0x7E or c in "ªº" or (latin and c not in LOOKALIKES)

    codes = [x for x in range(0x21, 0x1F00) if fits(x)]
    starts = [x for x in codes if x - 1 not in set(codes)]
    ends = [x for x in codes if x + 1 not in set(codes)]
    some = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends))
    # a class with possessive repetition: texts of any length, no recursion
    return f"^(?! )(?!.*  )(?!.* $)[ {some}]*+$"


PLAIN = _plain_pattern()


@lru_cache(maxsize=1)
def character_rows() -> tuple[list[tuple], list[tuple[str, str, str, str]]]:
    """(character, part number, part, combining class, look-alike, Greek) of every character that is not plain, and
    (root letter, letter, mark, composed letter) of all compositions."""
    parts, composed = [], []

    def add(c: str, n: int, part: str) -> None:
        parts.append((c, n, part, unicodedata.combining(part) if part else 0, LOOKALIKES.get(part), unicodedata.name(part, "").startswith("GREEK") if part else False, unicodedata.category(part) == "Mn" if part else False))

    for code in range(0x80, 0x110000):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Cs", "Co") or 0xAC00 <= code <= 0xD7A3:
            continue
        if kind in ("Cf", "Cc") or 0xFE00 <= code <= 0xFE0F:
            add(c, 0, "")
        elif kind in ("Zs", "Zl", "Zp"):
            add(c, 0, " ")
        elif c in DASHES:
            add(c, 0, "-")
        else:
            keeps = c in "ªº" or unicodedata.decomposition(c).startswith(("<fraction>", "<super>", "<sub>"))
            plain = unicodedata.normalize("NFD" if keeps else "NFKD", c)
            if plain != c or kind[0] == "M" or c in LOOKALIKES or unicodedata.name(c, "").startswith("GREEK"):
                for i, p in enumerate(plain):
                    add(c, i, p)
        two = unicodedata.decomposition(c).split()
        if len(two) == 2 and not two[0].startswith("<") and unicodedata.normalize("NFC", unicodedata.normalize("NFD", c)) == c:
            a, b = (chr(int(x, 16)) for x in two)
            composed.append((unicodedata.normalize("NFD", c)[0], a, b, c))
    for c in (chr(x) for x in range(0x20)):
        add(c, 0, " " if c in "\t\n\r" else "")
    return parts, composed


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Code points, and compositions by root letter, as tables of fixed size."""
    parts, composed = character_rows()
    names = ["ch", "n", "part", "ccc", "alike", "greek", "mark"]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
    table = spark.createDataFrame(pa.table([pa.array(list(c), k) for c, k in zip(zip(*parts), kinds)], names=names))
    by_root: dict[str, list[tuple[str, str]]] = {}
    for root, a, b, c in composed:
        by_root.setdefault(root, []).append((a + b, c))
    pairs = spark.createDataFrame(pa.table({"root": pa.array(list(by_root)), "pairs": pa.array(list(by_root.values()), pa.map_(pa.string(), pa.string()))}))
    return table, pairs


def consistent_texts(texts: DataFrame, column: str = "text") -> DataFrame:
    """Distinct texts of ``column`` that are not in the consistent spelling: ``(text, consistent)``.

    The consistent spelling has ordinary Latin letters, composed with their marks where such letters exist (other marks
    stay), plain hyphens, single plain blanks between words and none at the ends, and no invisible characters. Words
    wholly in Greek letters (two or more) stay Greek. Null texts give no row; an empty text is consistent; a text of
    invisible characters or blanks alone becomes the empty text. Case and vowel marks are kept.
    """
    table, pairs = _tables(texts.sparkSession)
    suspects = texts.select(F.col(column).alias("text")).where(F.col("text").isNotNull() & ~F.col("text").rlike(PLAIN)).distinct().withColumn("key", F.md5("text"))
    points = suspects.select("key", F.posexplode(F.split("text", "")).alias("pos", "ch"))
    parts = points.join(F.broadcast(table), "ch", "left").select(
        "key", "pos", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("part", "ch").alias("part"), F.coalesce("ccc", F.lit(0)).alias("ccc"), "alike", F.coalesce("greek", F.lit(False)).alias("greek"), F.coalesce("mark", F.lit(False)).alias("mark")
    ).where("part != ''")
    # clusters of a letter and its marks, and words, counted along the text; all windows share the partitioning by text
    along = Window.partitionBy("key").orderBy("pos", "n")
    parts = parts.select("*", F.sum((F.col("ccc") == 0).cast("int")).over(along).alias("cluster"), F.sum((F.col("part") == " ").cast("int")).over(along).alias("word"))
    word = Window.partitionBy("key", "word")
    letter = (F.col("part") != " ").cast("int")
    whole = (F.min(F.when(F.col("part") != " ", F.col("greek") | F.col("mark"))).over(word)) & (F.max("greek").over(word)) & (F.sum(letter).over(word) >= 2)
    parts = parts.select("key", "cluster", "ccc", "pos", "n", F.when(F.coalesce(whole, F.lit(False)), F.col("part")).otherwise(F.coalesce("alike", "part")).alias("part"))
    clusters = parts.groupBy("key", "cluster").agg(F.array_sort(F.collect_list(F.struct("ccc", "pos", "n", "part"))).alias("seq"))
    clusters = clusters.withColumn("root", F.when(F.size("seq") > 1, F.col("seq")[0]["part"])).join(F.broadcast(pairs), "root", "left")

    state = lambda base, rest, c: F.struct(base.alias("base"), rest.alias("rest"), c.alias("c"))

    def step(acc: Column, x: Column) -> Column:
        """A mark joins the letter unless a mark of its class was left between."""
        joined = F.when((acc["rest"] == "") | (acc["c"] < x["ccc"]), F.col("pairs")[F.concat(acc["base"], x["part"])])
        return F.when(joined.isNotNull(), state(joined, acc["rest"], acc["c"])).otherwise(state(acc["base"], F.concat(acc["rest"], x["part"]), x["ccc"]))

    made = F.aggregate(F.slice("seq", 2, F.greatest(F.size("seq") - 1, F.lit(1))), state(F.col("seq")[0]["part"], F.lit(""), F.lit(0)), step)
    spelt = clusters.select("key", "cluster", F.when(F.size("seq") == 1, F.col("seq")[0]["part"]).otherwise(let(made, lambda m: F.concat(m["base"], m["rest"]))).alias("part"))
    line = spelt.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("cluster", "part"))).alias("seq"))
    text = F.array_join(F.transform("seq", lambda x: x["part"]), "")
    whole = line.select("key", F.trim(F.regexp_replace(text, " +", " ")).alias("consistent"))
    return suspects.join(whole, "key", "left").select("text", F.coalesce("consistent", F.lit("")).alias("consistent")).where(F.col("text") != F.col("consistent"))


def make_consistent(df: DataFrame, column: str, output: str = "consistent") -> DataFrame:
    """``df`` with the consistent spelling of ``column`` in ``output``; nulls stay null, all rows and columns are kept."""
    fixes = cut(consistent_texts(df, column)).select(F.col("text").alias(column), F.col("consistent").alias("__consistent"))
    joined = spread_join(df.drop(output) if output != column else df, fixes, column)
    return joined.withColumn(output, F.coalesce("__consistent", F.col(column))).drop("__consistent")


def inconsistent_rows(*sources: tuple[DataFrame, str, Column, str]) -> DataFrame:
    """Rows ``(tab, rec_key)`` with a text out of the consistent spelling, of all sources in one pass.

    A source is (table, key column, array of texts, name). Null keys or arrays give no row; a row delivered twice is
    reported once.
    """
    every = None
    for df, key, texts, tab in sources:
        part = df.select(F.lit(tab).alias("tab"), F.col(key).cast("string").alias("rec_key"), F.explode(texts).alias("text")).where(F.col("rec_key").isNotNull() & ~F.col("text").rlike(PLAIN))
        every = part if every is None else every.unionByName(part)
    single = cut(every)
    return spread_join(single, consistent_texts(single).select("text"), "text", "left_semi").select("tab", "rec_key").distinct()
