"""Grammatical labels: parsing, rendering, classes from endings, votes between sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of inflection classes and word classes.
DECLENSIONS = {"1ª": "1ª (-ae)", "2ª": "2ª (-i)", "3ª": "3ª (-is)", "4ª": "4ª (-us)", "5ª": "5ª (-ei)"}
CONJUGATIONS = {"1ª": "1ª (-āre)", "2ª": "2ª (-ēre)", "3ª": "3ª (-ere)", "4ª": "4ª (-īre)"}
GENDERS = {"m": "masc.", "f": "fem.", "n": "neutro."}
EXTRAS = ("arc.", "poét.", "raro", "fig.", "dep.", "defect.", "impess.")
POS_OF_CODE = {"s": "NOUN", "n": "NOUN", "m": "NOUN", "f": "NOUN", "v": "VERB", "adj": "ADJ", "a": "ADJ", "adv": "ADV", "prep": "PREP", "conj": "CONJ", "interj": "INTERJ"}


def pos_bucket(label: Column) -> Column:
    """NOUN, VERB, ADJ, ADV, PREP, CONJ, INTERJ or UNK; adverbs are tested before adjectives and verbs."""
    x = F.lower(F.coalesce(label, F.lit("")))
    return (
        F.when(x.rlike(r"\badv"), "ADV").when(x.rlike(r"\badj|\bp\. ?a\."), "ADJ").when(x.rlike(r"^(?:v\.|v\b|verb)|\bverb"), "VERB")
        .when(x.rlike(r"^s\.|subst|noun|^n\.|\bmasc|\bfem|neutr|propn|prop\."), "NOUN").when(x.rlike("prep"), "PREP").when(x.rlike("conj"), "CONJ").when(x.rlike("interj"), "INTERJ").otherwise("UNK")
    )


def parse_label(label: Column) -> Column:
    """Struct ``pos, gender, decl_class, verb_class, adj_class, extras, indeclinable`` of a label."""
    x = F.lower(F.coalesce(label, F.lit("")))
    pos = pos_bucket(label)
    gender = F.when(x.rlike(r"\bmasc"), "m").when(x.rlike(r"\bfem"), "f").when(x.rlike(r"\bneutr"), "n")
    number = F.nullif(F.regexp_extract(x, r"(\dª)", 1), F.lit(""))
    table = lambda d: F.coalesce(*[F.when(number == k, v) for k, v in d.items()])
    extras = F.filter(F.array(*[F.lit(e) for e in EXTRAS]), lambda e: F.contains(x, e))
    return F.struct(pos.alias("pos"), F.when(pos == "NOUN", gender).alias("gender"), F.when(pos == "NOUN", table(DECLENSIONS)).alias("decl_class"), F.when(pos == "VERB", table(CONJUGATIONS)).alias("verb_class"), F.when(pos == "ADJ", F.nullif(F.regexp_extract(x, r"(\dª(?:/\dª)?)", 1), F.lit(""))).alias("adj_class"), extras.alias("extras"), F.contains(x, F.lit("indecl")).cast("int").alias("indeclinable"))


def render_label(pos: Column, gender: Column, decl: Column, verb: Column, indeclinable: Column) -> Column:
    """Label of parsed parts: 's. masc. 2ª (-i)', 'v. 1ª (-āre)', 'adj.', …; null when the class is unknown."""
    p = F.upper(F.trim(pos))
    sex = F.coalesce(*[F.when(gender == k, v) for k, v in GENDERS.items()])
    tail = F.when(indeclinable == 1, F.lit("indecl."))
    return (
        F.when(p.isin("NOUN", "PROPN"), F.concat_ws(" ", F.lit("s."), sex, decl, tail)).when(p == "VERB", F.concat_ws(" ", F.lit("v."), verb)).when(p == "ADJ", F.concat_ws(" ", F.lit("adj."), tail))
        .when(p == "ADV", "adv.").when(p == "PREP", "prep.").when(p == "CONJ", "conj.").when(p == "INTERJ", "interj.")
    )


def short_label(pos: Column, gender: Column, indeclinable: Column) -> Column:
    """Display label: subst., adj., verbo or the lower-case class, short genders in brackets."""
    p = F.upper(F.trim(pos))
    name = F.when(p == "NOUN", "subst.").when(p == "ADJ", "adj.").when(p == "VERB", "verbo").otherwise(F.lower(F.trim(pos)))
    sex = F.when((F.length(gender) > 0) & (F.length(gender) <= 3), F.concat(F.lit("("), gender, F.lit(")")))
    return F.nullif(F.concat_ws(" ", name, sex, F.when(indeclinable == 1, F.lit("indeclinável"))), F.lit(""))


def noun_class(genitive: Column, gender: Column, indeclinable: Column) -> Column:
    """Noun label from the genitive ending; -ei is tested before -i."""
    g = F.lower(F.regexp_replace(F.coalesce(genitive, F.lit("")), r"^[\s,;-]+|[\s,;.]+$", ""))
    cls = F.when(g.endswith("ae"), "1ª (-ae)").when(g.endswith("ei"), "5ª (-ei)").when(g.endswith("is"), "3ª (-is)").when(g.endswith("us"), "4ª (-us)").when(g.endswith("i"), "2ª (-i)")
    sex = F.coalesce(*[F.when(gender == k, v) for k, v in GENDERS.items()])
    return F.when(indeclinable == 1, F.concat_ws(" ", F.lit("s."), sex, F.lit("indecl."))).when(cls.isNotNull(), F.concat_ws(" ", F.lit("s."), sex, cls))


def verb_class(infinitive: Column) -> Column:
    """Verb label from the infinitive; a long ē tells the second conjugation from the third."""
    x = F.lower(F.trim(infinitive))
    cls = F.when(x.rlike("[aā]re$"), "1ª (-āre)").when(x.rlike("[iī]re$"), "4ª (-īre)").when(x.rlike("ēre$"), "2ª (-ēre)").when(x.rlike("ere$"), "3ª (-ere)")
    return F.when(cls.isNotNull(), F.concat(F.lit("v. "), cls))


def adjective_class(endings: Column) -> Column:
    x = F.lower(F.trim(endings))
    return F.when(x.rlike(r"\b-?a, ?-?um\b"), "adj. 1ª/2ª").when(x.rlike(r"^-?e$|^-?is, ?-?e$"), "adj. 3ª")


def vote(g: Column, latin: Column, d: Column) -> Column:
    """Majority of three nullable labels: (label, votes); ties go to the first argument that is known."""
    n = lambda x: F.coalesce((x == g).cast("int"), F.lit(0)) + F.coalesce((x == latin).cast("int"), F.lit(0)) + F.coalesce((x == d).cast("int"), F.lit(0))
    label = F.when((g == latin) | (g == d), g).when(latin == d, latin).otherwise(F.coalesce(g, latin, d))
    return F.struct(label.alias("label"), n(label).alias("votes"))


def compatible(a: Column, b: Column) -> Column:
    """Whether two word classes may describe one word: unknown passes, noun and adjective interchange for names."""
    return (a == "UNK") | (b == "UNK") | (a == b)


# ---- labels of other dictionaries --------------------------------------------------------------------------------
def pos_matches(label: Column, wanted: Column) -> Column:
    """Whether a label is of the wanted word class; an unknown or missing wish is always met."""
    return wanted.isNull() | (wanted == "UNK") | (pos_bucket(label) == wanted)


def pos_of_code(code: Column) -> Column:
    """Word class of a short grammar code, null for codes not known."""
    table = F.create_map(*[F.lit(x) for k, v in POS_OF_CODE.items() for x in (k, v)])
    return table[F.regexp_replace(F.lower(F.trim(code)), r"\.$", "")]


def foreign_class(grammar: Column) -> Column:
    """(kind, class, extra) of a German grammar text: conjugation, declension or adjective class, and 'dep.'."""
    g = F.lower(F.trim(F.coalesce(grammar, F.lit(""))))
    number = F.nullif(F.regexp_extract(g, r"(\d)\. ?(?:konj|dekl|decl|conj)", 1), F.lit(""))
    kind = F.when(g.rlike(r"konj|conj|verb"), "verb").when(g.rlike(r"adj"), "adj").when(g.rlike(r"dekl|decl|subst"), "noun")
    table = lambda d: F.coalesce(*[F.when(number == k[0], v) for k, v in d.items()])
    cls = F.when(kind == "verb", table(CONJUGATIONS)).when(kind == "noun", table(DECLENSIONS)).when(kind == "adj", F.when(g.rlike("3"), "3ª").otherwise("1ª/2ª"))
    return F.struct(kind.alias("kind"), cls.alias("cls"), F.when(g.rlike("depon"), "dep.").alias("extra"))


def foreign_hints(text: Column) -> Column:
    """Signals in a German article: gender, infinitive, genitive ending, adjective of three endings."""
    t = F.coalesce(text, F.lit(""))
    get = lambda pattern: F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))
    return F.struct(
        F.lower(get(r"(?:^|[ ,;(])([mfnMFN])(?:\.|\)|$)")).alias("gender"), get(r"(?i)infinitiv:? ([\p{L}āēīō]+re)\b").alias("infinitive"), get(r",\s*-?(ae|ei|is|us|i)\b").alias("genitive"),
        t.rlike(r",\s*-?a,\s*-?um\b").alias("three_endings"),
    )


def inflection_set(*lists: Column) -> Column:
    """Sorted distinct inflection signs of lists such as ['a, um'], conjugation endings as numbers."""
    numbers = {"are": "1", "ere": "3", "ire": "4", "āre": "1", "ēre": "2", "īre": "4"}
    parts = F.flatten(F.transform(F.concat(*lists), lambda x: F.split(F.lower(x), r"\s*,\s*")))
    table = F.create_map(*[F.lit(x) for k, v in numbers.items() for x in (k, v)])
    bare = F.transform(parts, lambda x: F.regexp_replace(F.trim(x), r"^-", ""))
    return F.array_sort(F.array_distinct(F.filter(F.transform(bare, lambda x: F.coalesce(table[x], x)), lambda x: x != "")))


def ladder(g: Column, latin: Column, d: Column, sources: Column, old: Column, label: Column) -> Column:
    """Decision of a label correction: skip for too few sources, no agreement or no label; noop; else update."""
    v = vote(g, latin, d)
    return (
        F.when(sources < 2, "skip:not_enough_unique_sources").when(v["votes"] < 2, "skip:no_pos_consensus").when(label.isNull(), "skip:no_mapping")
        .when(label == old, "noop:same").otherwise("update")
    )
