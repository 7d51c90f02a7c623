"""Queries that assemble and correct dictionaries: examples, stars, payloads, ladders, migrations, suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.functions import morph, strings
from lexispark.operators import dictionary, patch, vector
from lexispark.session import load

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_REF = "^([A-Z][A-Za-z. ]+?)\\s+([A-Za-z][A-Za-z. ]+?)\\s+(.+)$"
_EXAMPLES = f"""SELECT entry_id, n, raw_ref, nullif(regexp_extract(raw_ref, '{_REF}', 1), '') AS fonte, nullif(regexp_extract(raw_ref, '{_REF}', 2), '') AS obra, nullif(regexp_extract(raw_ref, '{_REF}', 3), '') AS loc
FROM (SELECT entry_id, i AS n, refs[i] AS raw_ref FROM (SELECT id AS entry_id, refs, unnest(range(1, len(refs) + 1)) AS i FROM (SELECT id, regexp_extract_all(definicao, '\\(([^()]+)\\)', 1) AS refs FROM entry WHERE definicao IS NOT NULL)))"""


def _examples(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.examples(load(spark, d, "entry"), "id", "definicao")


@query(f"SELECT entry_id, n, fonte, obra, loc FROM ({_EXAMPLES}) WHERE lower(fonte) LIKE '%cald%' AND lower(obra) LIKE '%or%' ORDER BY entry_id, n LIMIT 50")
def examples_search(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.search_examples(_examples(spark, d), fonte="cald", obra="or", limit=50).select("entry_id", F.col("n").cast("bigint").alias("n"), "fonte", "obra", "loc")


_PAIR = "len(list_filter(range(1, len(t)), lambda i: t[i] = '{0}' AND t[i + 1] = '{1}'))"
_IDF = "CASE WHEN ln((c - d{0} + 0.5) / (d{0} + 0.5)) <= 0 THEN 1e-6 ELSE ln((c - d{0} + 0.5) / (d{0} + 0.5)) END"


@query(f"""WITH x AS (SELECT entry_id, n, raw_ref, list_filter(regexp_split_to_array(lower(strip_accents(raw_ref)), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM ({_EXAMPLES}) WHERE fonte IS NOT NULL AND regexp_matches(loc, '[0-9]')),
f AS (SELECT entry_id, n, raw_ref, len(t) AS size, {_PAIR.format('talv', 'hist')} AS f0, {_PAIR.format('cald', 'or')} AS f1 FROM x), s AS (SELECT count(*) AS c, avg(size) AS mean, count_if(f0 > 0) AS d0, count_if(f1 > 0) AS d1 FROM f)
SELECT entry_id, n, raw_ref, round(0 - {' - '.join(f"({_IDF.format(i)}) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * size / mean))" for i in range(2))}, 6) AS score FROM f, s WHERE f0 > 0 OR f1 > 0 ORDER BY score, entry_id, n LIMIT 100""")
def examples_fulltext(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.search_examples(_examples(spark, d), '"talv hist" OR "cald or"', status="ok", least=0.5, limit=100).select("entry_id", F.col("n").cast("bigint").alias("n"), "raw_ref", "score")


@query(f"SELECT e.id, coalesce(x.refs, '') AS refs FROM entry e LEFT JOIN (SELECT entry_id, string_agg(raw_ref, '; ' ORDER BY n) AS refs FROM ({_EXAMPLES}) GROUP BY 1) x ON x.entry_id = e.id")
def entry_with_examples(spark: SparkSession, d: str) -> DataFrame:
    e = dictionary.with_children(load(spark, d, "entry").select("id"), "id", _examples(spark, d), "entry_id", "n", ["raw_ref"])
    return e.select("id", F.array_join(F.transform("children", lambda x: x["raw_ref"]), "; ").alias("refs"))


@query(f"SELECT CASE WHEN fonte IS NULL THEN 'invalido' WHEN regexp_matches(loc, '[0-9]') THEN 'ok' ELSE 'parcial' END AS status, count(*) AS n FROM ({_EXAMPLES}) GROUP BY 1")
def parse_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return _examples(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query("""SELECT e.entry_id, e.lemma_sort, s.senses, f.forms FROM v2_entry e JOIN (SELECT entry_id, count(*) AS senses FROM (SELECT DISTINCT sense_id, entry_id FROM v2_sense) GROUP BY 1) s ON s.entry_id = e.entry_id
JOIN (SELECT entry_id, count(DISTINCT form_norm) AS forms FROM v2_form WHERE form_norm <> '' GROUP BY 1) f ON f.entry_id = e.entry_id JOIN dict_source d ON d.source_id = e.source_id WHERE d.name = 'retificado'""")
def source_star(spark: SparkSession, d: str) -> DataFrame:
    src = load(spark, d, "dict_source").where("name = 'retificado'").select("source_id")
    e = load(spark, d, "v2_entry").select("entry_id", "lemma_sort", "source_id").join(src, "source_id")
    s = load(spark, d, "v2_sense").select("sense_id", "entry_id").distinct().groupBy("entry_id").agg(F.count("*").alias("senses"))
    f = load(spark, d, "v2_form").where("form_norm <> ''").groupBy("entry_id").agg(F.countDistinct("form_norm").alias("forms"))
    return e.join(s, "entry_id").join(f, "entry_id").select("entry_id", "lemma_sort", "senses", "forms")


@query("""SELECT entry_id, sense_id, rank FROM (SELECT entry_id, sense_id, row_number() OVER (PARTITION BY entry_id ORDER BY sense_id) AS rank FROM (SELECT DISTINCT sense_id, entry_id FROM v2_sense)) WHERE rank <= 3""")
def first_senses(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "v2_sense").select("sense_id", "entry_id").distinct()
    rows = s.groupBy("entry_id").agg(F.slice(F.array_sort(F.collect_list("sense_id")), 1, 3).alias("x"))
    return rows.select("entry_id", F.posexplode("x").alias("rank", "sense_id")).select("entry_id", "sense_id", (F.col("rank") + 1).cast("bigint").alias("rank"))


@query("""SELECT upper(trim(coalesce(pos, 'UNK'))) AS pos, count(*) AS n, count_if(trim(coalesce(definicao, '')) <> '') AS with_text, round(100.0 * count_if(trim(coalesce(definicao, '')) <> '') / count(*), 1) AS pct FROM v2_entry GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20""")
def translated_by_pos(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "v2_entry").groupBy(F.upper(F.trim(F.coalesce("pos", F.lit("UNK")))).alias("pos"))
    a = g.agg(F.count("*").alias("n"), F.count_if(F.trim(F.coalesce("definicao", F.lit(""))) != "").alias("with_text"))
    return a.withColumn("pct", F.round(100.0 * F.col("with_text") / F.col("n"), 1)).orderBy(F.desc("n"), "pos").limit(20)


@query("""SELECT 'v2' AS source, entry_id::VARCHAR AS id, coalesce(nullif(trim(definicao), ''), nullif(trim(head_raw), '')) AS gloss FROM v2_entry UNION ALL SELECT 'ls', id, nullif(trim(definition), '') FROM (SELECT DISTINCT * FROM ls_entries)""")
def canonical_entries(spark: SparkSession, d: str) -> DataFrame:
    v = load(spark, d, "v2_entry").select(F.col("entry_id").alias("id"), "lemma", "pos", F.trim("definicao").alias("gloss_1"), F.trim("head_raw").alias("gloss_2"), F.col("notas").alias("notes"))
    x = load(spark, d, "ls_entries").distinct().select("id", "lemma", "pos", F.trim("definition").alias("gloss_1"), F.lit(None).cast("string").alias("notes"))
    return dictionary.canonical_entries({"v2": v, "ls": x}).select("source", "id", "gloss")


_POS3 = """SELECT e.entry_id, e.morph_render, CASE WHEN e.morph_render LIKE 's.%' THEN 'NOUN' WHEN e.morph_render LIKE 'v.%' THEN 'VERB' WHEN e.morph_render LIKE 'adv%' THEN 'ADV' WHEN e.morph_render LIKE 'adj%' THEN 'ADJ' END AS g,
CASE WHEN upper(trim(e.pos)) = 'PROPN' THEN 'NOUN' ELSE upper(trim(e.pos)) END AS l, CASE WHEN e.verb_class IS NOT NULL THEN 'VERB' WHEN e.decl_class IS NOT NULL THEN 'NOUN' WHEN e.adj_class IS NOT NULL THEN 'ADJ' END AS d, e.gender, e.decl_class, e.verb_class FROM v2_entry e"""


@query(f"""WITH p AS ({_POS3}), v AS (SELECT *, (g IS NOT NULL)::INT + (l IS NOT NULL)::INT + (d IS NOT NULL)::INT AS n, CASE WHEN g = l OR g = d THEN g WHEN l = d THEN l ELSE coalesce(g, l, d) END AS w FROM p),
c AS (SELECT *, coalesce((g = w)::INT, 0) + coalesce((l = w)::INT, 0) + coalesce((d = w)::INT, 0) AS votes, CASE w WHEN 'NOUN' THEN concat_ws(' ', 's.', CASE gender WHEN 'm' THEN 'masc.' WHEN 'f' THEN 'fem.' WHEN 'n' THEN 'neutro.' END, decl_class)
WHEN 'VERB' THEN concat_ws(' ', 'v.', verb_class) WHEN 'ADJ' THEN 'adj.' WHEN 'ADV' THEN 'adv.' END AS label FROM v)
SELECT entry_id, CASE WHEN n < 2 THEN 'skip:not_enough_unique_sources' WHEN votes < 2 THEN 'skip:no_pos_consensus' WHEN label IS NULL THEN 'skip:no_mapping' WHEN label = morph_render THEN 'noop:same' ELSE 'update' END AS decision FROM c""")
def morph_ladder(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry")
    m = F.col("morph_render")
    g = F.when(m.startswith("s."), "NOUN").when(m.startswith("v."), "VERB").when(m.startswith("adv"), "ADV").when(m.startswith("adj"), "ADJ")
    p = F.upper(F.trim("pos"))
    x = F.when(p == "PROPN", "NOUN").otherwise(p)
    c = F.when(F.col("verb_class").isNotNull(), "VERB").when(F.col("decl_class").isNotNull(), "NOUN").when(F.col("adj_class").isNotNull(), "ADJ")
    known = sum((k.isNotNull().cast("int") for k in (g, x, c)), F.lit(0))
    label = morph.render_label(morph.vote(g, x, c)["label"], F.col("gender"), F.col("decl_class"), F.col("verb_class"), F.lit(0))
    return e.select("entry_id", morph.ladder(g, x, c, known, m, label).alias("decision"))


@query("""SELECT entry_id, lower(strip_accents(trim(lemma_sort))) AS lemma_sort, CASE WHEN morph_render LIKE 's.%' THEN 'NOUN' WHEN morph_render LIKE 'v.%' THEN 'VERB' WHEN morph_render LIKE 'adv%' THEN 'ADV' WHEN morph_render LIKE 'adj%' THEN 'ADJ' ELSE 'UNK' END AS pos,
CASE WHEN lower(trim(conf)) IN ('high', 'med', 'low') THEN lower(trim(conf)) END AS conf FROM v2_entry""")
def migration_preview(spark: SparkSession, d: str) -> DataFrame:
    from lexispark.functions.fold import lemma_key

    e = load(spark, d, "v2_entry")
    conf = F.lower(F.trim("conf"))
    return e.select("entry_id", lemma_key(F.col("lemma_sort")).alias("lemma_sort"), morph.parse_label(F.col("morph_render"))["pos"].alias("pos"), F.when(conf.isin("high", "med", "low"), conf).alias("conf"))


@query("""SELECT e.entry_id, x.cls AS verb_class, CASE WHEN lower(trim(coalesce(e.conf, ''))) IN ('', 'low') THEN 'med' ELSE e.conf END AS conf, e.verb_class IS DISTINCT FROM x.cls AS differs FROM v2_entry e JOIN (SELECT lemma, min(CASE json_extract_string(itypes, '$[0]') WHEN 'are' THEN '1ª (-āre)' WHEN 'ire' THEN '4ª (-īre)' END) AS cls FROM ls_entries GROUP BY 1) x
ON x.lemma = e.lemma_sort AND x.cls IS NOT NULL""")
def class_updates(spark: SparkSession, d: str) -> DataFrame:
    end = F.get(strings.json_list(F.col("itypes")), F.lit(0))
    x = load(spark, d, "ls_entries").groupBy(F.col("lemma").alias("lemma_sort")).agg(F.min(F.when(end == "are", "1ª (-āre)").when(end == "ire", "4ª (-īre)")).alias("verb_class")).where("verb_class IS NOT NULL")
    e = load(spark, d, "v2_entry").select("entry_id", "lemma_sort", "conf", F.col("verb_class").alias("old"))
    j = e.join(x, "lemma_sort").withColumn("differs", ~F.col("old").eqNullSafe(F.col("verb_class")))
    return j.select("entry_id", "verb_class", F.when(F.lower(F.trim(F.coalesce("conf", F.lit("")))).isin("", "low"), "med").otherwise(F.col("conf")).alias("conf"), "differs")


@query("""SELECT DISTINCT id, array_to_string(list_sort(list_distinct(list_filter(list_transform(flatten(list_transform(CAST(json(itypes) AS VARCHAR[]), lambda x: string_split(lower(x), ','))), lambda y: CASE trim(y) WHEN 'are' THEN '1' WHEN 'ere' THEN '3' WHEN 'ire' THEN '4' ELSE trim(y) END), lambda z: z <> ''))), '+') AS signs FROM ls_entries""")
def inflection_sets(spark: SparkSession, d: str) -> DataFrame:
    x = load(spark, d, "ls_entries").select("id", "itypes").distinct()
    return x.select("id", F.array_join(morph.inflection_set(strings.json_list(F.col("itypes"))), "+").alias("signs"))


@query("""WITH g AS (SELECT lemma_sort AS grp, entry_id, morph_render LIKE 's.%' AS hit FROM v2_entry), s AS (SELECT *, max(hit::INT) OVER (PARTITION BY grp) AS anyhit FROM (SELECT grp, entry_id, coalesce(hit, FALSE) AS hit FROM g)) SELECT grp, entry_id FROM s WHERE hit OR anyhit = 0""")
def type_filter_or_all(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select(F.col("lemma_sort").alias("grp"), "entry_id", "morph_render")
    return dictionary.narrowed(e, "grp", F.startswith("morph_render", F.lit("s."))).select("grp", "entry_id")


_W = "trim(regexp_replace(regexp_replace(translate(lower(strip_accents({0})), 'уаеорсхіѕυαονıſ–—‐‑−’‘', 'yaeopcxisuaouis-----'''''), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s-]', '', 'g'), '\\s+', ' ', 'g'))"
_SW = (
    "[{0}, replace({0}, 'o', 'u'), replace({0}, 'u', 'o'), replace({0}, 'rn', 'm'), replace({0}, 'm', 'rn'), replace({0}, 'cl', 'd'), replace({0}, 'd', 'cl'), "
    "replace({0}, 'æ', 'ae'), replace({0}, 'œ', 'oe'), replace({0}, 'j', 'i'), replace({0}, 'v', 'u'), replace({0}, 'ſ', 's')]"
)
_BG = "list_distinct(list_transform(range(1, greatest(length({0}) - 1, 1) + 1), lambda i: substr({0}, i, 2)))"


@query(f"""WITH own AS (SELECT entry_id AS key, {_W.format('lemma_sort')} AS word FROM v2_entry), known AS (SELECT DISTINCT {_W.format('lemma')} AS word FROM ls_entries), other AS (SELECT DISTINCT {_W.format('forma')} AS word FROM lemma),
open AS (SELECT * FROM own o WHERE word <> '' AND NOT EXISTS (SELECT 1 FROM known k WHERE k.word = o.word) AND NOT EXISTS (SELECT 1 FROM other k WHERE k.word = o.word)), words AS (SELECT DISTINCT word FROM open),
seeds AS (SELECT word, word AS s FROM words UNION SELECT word, CASE WHEN starts_with(word, p || '-') THEN p || substr(word, length(p) + 2) ELSE p || '-' || substr(word, length(p) + 1) END
  FROM words, (SELECT unnest(['ab', 'ad', 'con', 'de', 'dis', 'ex', 'in', 'inter', 'ob', 'per', 'post', 'prae', 'pro', 're', 'sub', 'super', 'trans']) AS p) WHERE starts_with(word, p) AND length(word) > length(p)),
once AS (SELECT DISTINCT word, unnest({_SW.format('s')}) AS v FROM seeds), twice AS (SELECT DISTINCT word, unnest({_SW.format('v')}) AS v FROM once), met AS (SELECT DISTINCT t.word, k.word AS match FROM twice t JOIN known k ON k.word = t.v WHERE k.word <> ''),
sc AS (SELECT word, match, round(len(list_intersect({_BG.format('word')}, {_BG.format('match')}))::DOUBLE / len(list_distinct({_BG.format('word')} || {_BG.format('match')})), 6) AS ratio, levenshtein(word, match)::INTEGER AS distance FROM met),
b AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY ratio DESC, distance, match) AS k FROM sc)
SELECT o.key, o.word AS lemma, b.match AS suggestion, b.ratio, b.distance, CASE WHEN b.ratio >= 0.85 OR x.word IS NOT NULL THEN 'high' ELSE 'med' END AS conf, CASE WHEN x.word IS NOT NULL THEN 'variant+second' ELSE 'variant' END AS reason
FROM open o JOIN b ON b.word = o.word AND b.k = 1 AND b.ratio >= 0.58 LEFT JOIN other x ON x.word = b.match""")
def suggest_fixes(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.suggest_fixes(load(spark, d, "v2_entry"), "entry_id", "lemma_sort", load(spark, d, "ls_entries"), "lemma", load(spark, d, "lemma"), "forma")


@query("""WITH c AS (SELECT lemma_sort FROM v2_entry GROUP BY 1 HAVING count(*) > 1) SELECT e.lemma_sort AS grp, count(*) AS n, string_agg(e.entry_id::VARCHAR, ',' ORDER BY e.entry_id) AS ids FROM v2_entry e JOIN c ON c.lemma_sort = e.lemma_sort GROUP BY 1""")
def review_groups(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select(F.col("lemma_sort").alias("grp"), "entry_id", "definicao")
    lines = load(spark, d, "ls_entries").select(F.col("lemma").alias("grp"), dictionary.evidence_line("LS", F.col("lemma"), F.col("definition")).alias("line"))
    p = dictionary.group_payload(e, "grp", "entry_id", ["definicao"], lines)
    back = p.select("grp", F.from_json("payload", "struct<group:string,items:array<struct<entry_id:bigint,definicao:string>>,evidence:string>").alias("x"))
    ids = F.transform("x.items", lambda i: i["entry_id"].cast("string"))
    return back.where(F.size("x.items") > 1).select("grp", F.size("x.items").cast("bigint").alias("n"), F.array_join(ids, ",").alias("ids"))


@query("""SELECT lemma_sort AS group_id, id, CASE WHEN entry_id = min(entry_id) OVER (PARTITION BY lemma_sort) THEN 'keep' ELSE 'manual' END AS action FROM v2_entry WHERE lemma_sort IS NOT NULL""")
def decisions_parse(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").where("lemma_sort IS NOT NULL").select("lemma_sort", "id", "entry_id")
    first = e.groupBy("lemma_sort").agg(F.min("entry_id").alias("m"))
    rows = e.join(first, "lemma_sort").groupBy("lemma_sort").agg(F.collect_list(F.struct("id", F.when(F.col("entry_id") == F.col("m"), "keep").otherwise("manual").alias("action"))).alias("results"))
    lines = rows.select(F.to_json(F.struct(F.concat(F.lit("dedupe::"), "lemma_sort").alias("custom_id"), F.to_json(F.struct("results")).alias("content"))).alias("line"))
    return dictionary.parse_decisions(lines, "line").where("error IS NULL").select("group_id", "id", "action")


@query("SELECT value AS lemma, n FROM (SELECT forma AS value, count(*) AS n, min(id) AS p FROM lemma GROUP BY 1 ORDER BY n DESC, p, 1 LIMIT 500) WHERE contains(value, 'or') ORDER BY n DESC, p LIMIT 15")
def suggestions_containing(spark: SparkSession, d: str) -> DataFrame:
    top = load(spark, d, "lemma").where("forma IS NOT NULL").groupBy(F.col("forma").alias("lemma")).agg(F.count("*").alias("n"), F.min("id").alias("p")).orderBy(F.desc("n"), "p", "lemma").limit(500)
    return top.where(F.contains("lemma", F.lit("or"))).orderBy(F.desc("n"), "p").limit(15).select("lemma", "n")


@query("""SELECT vec_id, label, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 4) AS norm FROM embeddings""")
def vector_norms(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "embeddings").select("vec_id", "label", F.round(vector.norm(F.col("embedding")), 4).alias("norm"))


@query("""WITH q AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0), c AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, q.label, c.vec_id AS hit_id, list_cosine_similarity(q.e, c.e) AS s FROM q, c WHERE q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, hit_id) AS rank FROM s) SELECT query_id, label, hit_id, rank::INTEGER AS rank, round(s, 4) AS score FROM r WHERE rank <= 5""")
def vector_links(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "embeddings")
    q = e.where("vec_id % 100 = 0")
    hits = vector.top_k(q, e, "vec_id", "embedding", 5)
    return dictionary.link_rows(q.select(F.col("vec_id").alias("query_id"), "label"), "query_id", hits, "query_id")


@query("""SELECT entry_id, CASE WHEN entry_id % 3 = 0 THEN lemma || ' (corr.)' ELSE lemma END AS lemma, CASE WHEN entry_id % 3 = 0 AND coalesce(notas, '') = '' THEN 'lema' WHEN entry_id % 3 = 0 THEN notas || chr(10) || 'lema' ELSE notas END AS notas FROM v2_entry WHERE entry_id % 3 = 0""")
def patch_dry_run(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", "lemma", "notas")
    p = e.where("entry_id % 3 = 0").select("entry_id", F.concat("lemma", F.lit(" (corr.)")).alias("new"))
    done = patch.apply_patch(e, p, "entry_id", {"lemma": F.col("p_new"), "notas": patch.append_note(F.col("notas"), F.lit("lema"), "\n")})
    touched = patch.changed(e, done, "entry_id", ["lemma", "notas"]).select("entry_id").distinct()
    return done.join(touched, "entry_id", "left_semi")


QUERIES, ORACLE = Q, SQL
