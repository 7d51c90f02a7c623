"""Best representative of each duplicate group, bundle by bundle.

Rows that describe one article are found by headword, homograph number and word class. Fields that depend on each other
form bundles that survive whole, each from one row: the definition, the rating (conf with needs_review), the grammar
(pos, gender), the inflection (the three class columns) and the label. Rows of one headword and homograph number are
first reduced to the most trusted candidate of every bundle per signature: what it says of word class, gender and
inflection. Signatures are as many as the vocabulary of labels allows, whatever the size of the group. All candidates of
the headword stay in, also those of other word classes; for each article branch and bound picks one candidate per bundle
with the largest total trust such that in the surviving record

    article -> word class,   inflection -> word class,   label -> word class, gender, inflection

hold: where two chosen bundles both say something of the same thing, they say the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions.morph import parse_label
from lexispark.functions.strings import let
from lexispark.llm.headwords import bare_form, clean_form, skeleton, utc_time
from lexispark.operators.nested import unwrap
from lexispark.operators.skew import spread_join
from lexispark.session import cut, ship_package

MAX_MISREAD_DISTANCE = 4  # two misreadings of up to two letters each
TEXT_KEYS = r'"(?:glosa|definicao|def|gloss|lat|quote|remissao|texto)"\s*:\s*"([^"]*+)"'
# senses: texts under these keys, and bare texts in lists that hold neither headwords nor examples
GLOSS_KEYS = r'"(?:glosa|definicao|def|gloss|sentidos|subsentidos|sub)"\s*:\s*"([^"]*+)"'
OTHER_LISTS = r'"(?:lemas|exemplos|ex|cit|notas)"\s*:\s*\[[^\[\]]*\]'
LOOSE_SENSES = r'[\[,]\s*"([^"]*+)"(?=\s*[,\]])'
LOOSE_TEXTS = r'[\[,:]\s*"([^"]*+)"(?=\s*[,\]\}])'
# Word classes as they are written.
CLASS_OF_POS = {"NOUN": "N", "PROPN": "N", "VERB": "V", "ADJ": "A", "ADV": "D", "PREP": "P", "CONJ": "C", "INTERJ": "I", "PRON": "R", "NUM": "M"}
CLASS_OF_LABEL = (("^s\\.|^subst", "N"), ("^v\\.|^verb", "V"), ("^adj", "A"), ("^adv", "D"), ("^prep", "P"), ("^conj", "C"), ("^interj", "I"), ("^pron", "R"), ("^num", "M"))


def word_class(pos: Column, label: Column, verb: Column, decl: Column, adj: Column) -> Column:
    """One letter for the word class, from pos, else from the label or the class columns; null when nothing tells."""
    p = F.upper(F.trim(pos))
    by_pos = F.coalesce(*[F.when(p == k, F.lit(v)) for k, v in CLASS_OF_POS.items()])
    by_label = F.coalesce(*[F.when(F.lower(F.trim(label)).rlike(k), F.lit(v)) for k, v in CLASS_OF_LABEL])
    return F.coalesce(by_pos, by_label, F.when(verb.isNotNull(), F.lit("V")), F.when(adj.isNotNull(), F.lit("A")), F.when(decl.isNotNull(), F.lit("N")))


def article_keys(rows: DataFrame) -> DataFrame:
    """Rows with the column ``canonical``, the spelling of their headword that is trusted most.

    ``rows`` has ``bare`` (its own spelling), ``head`` (the spelling of head_raw where its strokes agree) and ``skel``.
    Spellings that share a stroke skeleton belong to one word when they are few misreadings apart; the spelling of
    head_raw is trusted before that of lemma, and frequent spellings before rare ones.
    """
    spelt = rows.groupBy("skel", F.coalesce("head", "bare").alias("spelling")).agg(F.count("*").alias("uses"), F.max(F.col("head").isNotNull()).alias("trusted"))
    # as many spellings as misreadings make of one word, whatever the number of its copies
    known = spelt.groupBy("skel").agg(F.max("trusted").alias("any"), F.collect_list(F.struct("trusted", "uses", "spelling")).alias("all"))
    only = F.when(F.col("any"), F.filter("all", lambda x: x["trusted"])).otherwise(F.slice(F.sort_array("all", asc=False), 1, 1))
    rows = spread_join(rows, known.select("skel", only.alias("spellings")), "skel", "inner")
    near = lambda own: F.array_min(F.transform("spellings", lambda x: F.struct(F.levenshtein(own, x["spelling"]).alias("d"), (-x["uses"]).alias("u"), x["spelling"].alias("s"))))
    nearest = let(near(F.col("bare")), lambda n: F.when(n["d"] <= MAX_MISREAD_DISTANCE, n["s"]))
    return rows.withColumn("canonical", F.coalesce("head", nearest, "bare")).drop("spellings")


def headwords(df: DataFrame) -> DataFrame:
    """``df`` with its headword as compared (bare, head, skel) and word class (cls).

    Rows without entry_id or headword are left out.
    """
    rows = df.where(F.col("entry_id").isNotNull())
    rows = rows.select("*", bare_form(clean_form(F.col("lemma"))).alias("__b"), bare_form(clean_form(F.regexp_extract("head_raw", r"^([^,]*)", 1))).alias("__h"))
    rows = rows.select(*[c for c in rows.columns if c not in ("bare", "head", "skel", "cls")], F.coalesce(F.nullif("__b", F.lit("")), F.nullif("__h", F.lit(""))).alias("bare")).where(F.col("bare").isNotNull())
    rows = rows.withColumn("skel", skeleton(F.col("bare")))
    rows = rows.withColumn("head", F.when((F.col("__h") != "") & (skeleton(F.col("__h")) == F.col("skel")), F.col("__h"))).drop("__b", "__h")
    return rows.withColumn("cls", word_class(F.col("pos"), F.col("morph_render"), F.col("verb_class"), F.col("decl_class"), F.col("adj_class")))


def _tokens(c: Column) -> Column:
    bare = F.regexp_replace(F.lower(c), r"(?:^|(?<=\s))\p{L}\)", " ")  # letters that number senses
    return F.filter(F.split(bare, r"[^\p{L}\p{M}\p{N}!'-]+"), lambda w: (w != "") & ~w.rlike(r"^[\d-]+$"))


def definition_state(definition: Column, record: Column) -> Column:
    """2: whole, undamaged, nothing foreign; 1: cannot be told (the record's JSON is unreadable or empty); 0: faulty or empty.

    The definition is held against the record it was rendered from: every word outside citations must occur in the
    record's texts, every gloss of the record must be in the definition, and the text must end where a sentence ends.
    """
    # escaped quotes and backslashes stand as private characters, so that patterns for strings need no alternatives
    hidden = lambda c: F.replace(F.replace(c, F.lit("\\\\"), F.lit("\ue000")), F.lit('\\"'), F.lit("\ue001"))
    shown = lambda c: F.replace(F.replace(c, F.lit("\ue001"), F.lit('\\"')), F.lit("\ue000"), F.lit("\\\\"))
    decoded = lambda x: F.coalesce(F.get(F.from_json(F.concat(F.lit('["'), shown(x), F.lit('"]')), "array<string>"), 0), x)
    strings = lambda text, pattern: F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), decoded)
    bare = lambda x: F.regexp_replace(x, r"\([^()]*\)", " ")
    ends = definition.rlike(r"[.!?]\s*$") & ~definition.rlike(r"\([^()]*$")

    def against(json: Column) -> Column:
        # texts under their keys, and senses given as bare strings in lists
        texts = F.concat(strings(json, TEXT_KEYS), strings(json, LOOSE_TEXTS))
        loose = strings(F.regexp_replace(json, OTHER_LISTS, '"_": 0'), LOOSE_SENSES)
        glosses = F.flatten(F.transform(F.concat(strings(json, GLOSS_KEYS), loose), _tokens))
        whole = let(shown(json), lambda j: F.from_json(F.when(j.startswith("["), F.get_json_object(j, "$[0]")).otherwise(j), "map<string,string>").isNotNull())
        readable = whole & json.rlike(r"[\}\]]$")

        def judge(expected: Column) -> Column:
            sound = lambda said: ends & (F.size(F.array_except(said, expected)) == 0) & (F.size(F.array_except(glosses, said)) == 0)
            known = readable & (F.size(expected) > 0)
            return F.when(known, F.when(let(_tokens(bare(definition)), sound), 2).otherwise(0)).when(ends, 1).otherwise(0)

        return let(F.array_distinct(F.flatten(F.transform(texts, lambda x: _tokens(bare(x))))), judge)

    blank = definition.isNull() | (F.trim(definition) == "")
    return F.when(blank, 0).otherwise(let(hidden(F.coalesce(unwrap(record), F.lit(""))), against))


def confidence_rank(conf: Column) -> Column:
    """high 3, med 2, low 1, anything else 0, whatever the spelling."""
    c = F.regexp_replace(F.lower(F.trim(conf)), r"^conf:\s*", "")
    return F.when(c.startswith("high"), 3).when(c.startswith("med"), 2).when(c.startswith("low"), 1).otherwise(0)


def best_bundles(candidates: list[list[tuple[tuple, tuple, object]]], compatible) -> list[object] | None:
    """One candidate per bundle with the lexicographically largest tuple of trusts, all signatures compatible.

    ``candidates[b]`` holds (trust, signature, payload). Branch and bound: bundles are fixed in turn, candidates by
    falling trust; a branch is cut when even the best trusts of the bundles left cannot beat the best found.
    """
    ranked = [sorted(c, key=lambda x: x[0], reverse=True) for c in candidates]
    bound = [c[0][0] for c in ranked]
    best: list = [None, None]

    def branch(b: int, trust: list, chosen: list) -> None:
        if best[0] is not None and tuple(trust + bound[b:]) <= best[0]:
            return
        if b == len(ranked):
            best[0], best[1] = tuple(trust), [x[2] for x in chosen]
            return
        for cand in ranked[b]:
            if all(compatible(cand[1], other[1]) for other in chosen):
                branch(b + 1, [*trust, cand[0]], [*chosen, cand])

    branch(0, [], [])
    return best[1]


BUNDLES = ("definicao", "conf", "grammar", "inflection", "label")
FIELDS = {
    "definicao": ("definicao", "notas"), "conf": ("conf", "needs_review"), "grammar": ("pos", "gender"),
    "inflection": ("decl_class", "verb_class", "adj_class"), "label": ("morph_render",),
}
UNTOLD = "?"  # the article of rows whose class cannot be told
SURVIVOR_SCHEMA = "group_id bigint, n_rows bigint, " + ", ".join(f"{b}_from bigint" for b in BUNDLES)


def agree(a: tuple, b: tuple) -> bool:
    """Functional dependencies between two bundles: article, word class, gender and inflection are equal where known."""
    return all(x is None or y is None or x == y for x, y in zip(a, b))


def _bundle_rows() -> Column:
    """What a row offers for every bundle: signature and trust (larger is better, place by place)."""
    known = lambda *cols: sum((F.col(c).isNotNull().cast("long") for c in cols), F.lit(0).cast("long"))
    none = F.lit(None).cast("string")
    plain = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))

    def bundle(i: int, cls: Column, gender: Column, infl: Column, a: Column, b: Column, key: Column | None = None) -> Column:
        return F.struct(F.lit(i).alias("bundle"), cls.alias("b_cls"), gender.alias("b_gender"), infl.alias("b_infl"), a.cast("long").alias("a"), b.cast("long").alias("b"), (F.lit(0).cast("long") if key is None else key).alias("key"))

    by_pos = F.coalesce(*[F.when(F.upper(F.trim("pos")) == k, F.lit(v)) for k, v in CLASS_OF_POS.items()])
    by_label = F.coalesce(*[F.when(F.lower(F.trim("morph_render")).rlike(k), F.lit(v)) for k, v in CLASS_OF_LABEL])
    said = parse_label(F.col("morph_render"))
    kinds = known("decl_class", "verb_class", "adj_class")
    # a row with classes of several kinds contradicts itself: '!' agrees with nothing
    kind = F.when(kinds > 1, "!").when(F.col("verb_class").isNotNull(), "V").when(F.col("adj_class").isNotNull(), "A").when(F.col("decl_class").isNotNull(), "N")
    size = F.length(F.coalesce("definicao", F.lit("")))
    return F.array(
        # a text without letters is no candidate; equal texts share what is known of one of them
        bundle(0, none, none, none, F.when(size > 0, F.col("state")).otherwise(-1), size, F.coalesce(F.xxhash64(F.regexp_replace(F.lower("definicao"), r"\s+", " ")), F.lit(0).cast("long"))),
        bundle(1, none, none, none, confidence_rank(F.col("conf")), F.when(F.col("needs_review") == 0, 1).otherwise(0)),
        bundle(2, by_pos, plain(F.col("gender")), none, known("pos", "gender"), F.lit(0)),
        bundle(3, kind, none, plain(F.coalesce("verb_class", "adj_class", "decl_class")), kinds, F.lit(0)),
        bundle(4, by_label, said["gender"], plain(F.coalesce(said["decl_class"], said["verb_class"])), known("morph_render"), F.lit(0)),
    )


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surviving bundles of every article of a headword; ``parts`` are all its candidates."""
    for batch in batches:
        out: list[tuple] = []
        for parts in batch.column(0).to_pylist():
            known = {p["cls"] for p in parts if p["cls"] is not None}
            only = next(iter(known)) if len(known) == 1 else UNTOLD
            candidates: list[list] = [[] for _ in BUNDLES]
            members: dict[str, list] = {}
            for p in parts:
                article = p["cls"] or only
                t = p["trust"]
                if p["bundle"] == 0:
                    members.setdefault(article, []).append((p["first"], p["n"]))
                    if t["a"] < 0:
                        continue
                candidates[p["bundle"]].append(((t["a"], t["b"], t["updated"], t["id"]), (article, p["b_cls"], p["b_gender"], p["b_infl"]), -t["id"]))
            for article, rows in members.items():
                n = sum(x[1] for x in rows)
                if n < 2:
                    continue
                # the article itself is the first bundle; a bundle nothing fits stays empty
                fixed = [((), (article, None if article == UNTOLD else article, None, None), None)]
                every = [fixed, *[[*c, ((-2, 0, 0, 0), (None,) * 4, None)] for c in candidates]]
                out.append((min(x[0] for x in rows), n, *best_bundles(every, agree)[1:]))
        columns = list(zip(*out)) or [()] * (len(BUNDLES) + 2)
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["group_id", "n_rows", *[f"{b}_from" for b in BUNDLES]])


def survivors(df: DataFrame) -> DataFrame:
    """One row per article with two or more rows: where each bundle of the surviving record comes from.

    ``(group_id, n_rows, definicao_from, conf_from, grammar_from, inflection_from, label_from)``; group_id is the
    smallest entry_id. A bundle for which no row fits is null. definicao_from is null when no row has a usable
    definition; of several the latest by updated_at counts, then the smallest entry_id. Null conf is the least trusted
    rating. Rows whose word class cannot be told join the class of their headword when it has only one. Of rows with
    one entry_id that differ the smallest counts. Empty input gives no rows.
    """
    ship_package(df.sparkSession)
    updated = F.coalesce(F.unix_micros(utc_time(F.col("updated_at"))), F.lit(-1).cast("long"))
    rows = headwords(df).withColumn("state", definition_state(F.col("definicao"), F.col("raw_json")))
    # what is compared and judged, without the texts, written once
    kept = ["bare", "head", "skel", "homograph_no", "cls", "updated", "offers"]
    narrow = rows.withColumn("updated", updated).withColumn("offers", _bundle_rows()).groupBy("entry_id").agg(F.min(F.struct(*kept)).alias("r"))
    scored = article_keys(cut(narrow.select("entry_id", "r.*")))
    latest = F.struct("updated", (-F.col("entry_id")).alias("id"))
    offered = scored.select("entry_id", "canonical", "homograph_no", "cls", latest.alias("latest"), F.explode("offers").alias("o")).select("*", "o.*")
    sign = ["canonical", "homograph_no", "cls", "bundle", "b_cls", "b_gender", "b_infl"]
    trust = lambda a, b, l: F.struct(a.alias("a"), b.alias("b"), l["updated"].alias("updated"), l["id"].alias("id"))
    first = offered.groupBy(*sign, "key").agg(
        F.count("*").alias("n"), F.min("entry_id").alias("first"), F.max("a").alias("a"), F.max("b").alias("b"), F.max("latest").alias("latest"), F.max(trust(F.col("a"), F.col("b"), F.col("latest"))).alias("top"),
    )
    text = trust(F.col("a"), F.when(F.col("a") == 2, F.lit(0).cast("long")).otherwise(F.col("b")), F.col("latest"))  # of whole texts the latest, of others the longest
    best = first.withColumn("trust", F.when(F.col("bundle") == 0, text).otherwise(F.col("top"))).groupBy(*sign).agg(F.max("trust").alias("trust"), F.sum("n").alias("n"), F.min("first").alias("first"))
    parts = best.groupBy("canonical", "homograph_no").agg(F.sum(F.when(F.col("bundle") == 0, F.col("n"))).alias("rows"), F.collect_list(F.struct("cls", "bundle", "b_cls", "b_gender", "b_infl", "trust", "n", "first")).alias("parts"))
    return parts.where("rows >= 2").select("parts").mapInArrow(_choose, SURVIVOR_SCHEMA)


def surviving_records(df: DataFrame) -> DataFrame:
    """The merged record of every duplicate group, each bundle taken whole from the row it survives from.

    One join brings all bundles; of rows with one entry_id that differ the smallest counts.
    """
    s = survivors(df)
    chosen = s.select("group_id", F.explode(F.array(*[F.struct(F.lit(b).alias("bundle"), F.col(f"{b}_from").alias("entry_id")) for b in BUNDLES])).alias("c")).select("group_id", "c.*").where("entry_id IS NOT NULL")
    wanted = chosen.groupBy("entry_id").agg(F.collect_list(F.struct("group_id", "bundle")).alias("uses"))
    source = df.select("entry_id", F.struct("lemma", *[c for cols in FIELDS.values() for c in cols]).alias("r")).groupBy("entry_id").agg(F.min("r").alias("r"))
    taken = wanted.join(source, "entry_id").select(F.explode("uses").alias("u"), "r").select("u.*", "r")
    merged = taken.groupBy("group_id").agg(*[F.max(F.when(F.col("bundle") == b, F.struct(*[F.col(f"r.{c}").alias(c) for c in (*cols, *(("lemma",) if b == "grammar" else ()))]))).alias(f"__{b}") for b, cols in FIELDS.items()])
    fields = [F.col(f"__{b}.{c}").alias(c) for b, cols in FIELDS.items() for c in cols]
    return s.join(merged, "group_id", "left").select(*s.columns, F.col("__grammar.lemma").alias("lemma"), *fields)
