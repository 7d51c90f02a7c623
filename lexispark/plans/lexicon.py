"""Queries of the lexicon: search, text keys, citations, labels, lookups, votes, windows, publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.functions import morph, strings
from lexispark.functions.citation import split_reference
from lexispark.functions.fold import first_letter, fold, letters_only, slugify, unaccent_lower
from lexispark.operators import dedupe, fuzzy, lookup, patch, publish, search, vector, windows
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


TOKENS = "list_filter(regexp_split_to_array(lower(strip_accents(coalesce({0}, ''))), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
DOC_TOKENS = TOKENS.format("text")


# ---- full-text search -------------------------------------------------------------------------------------------
def _bm25_sql(terms: list[str], where: str) -> str:
    f = ", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS f{i}" for i, w in enumerate(terms))
    d = ", ".join(f"count_if(f{i} > 0) AS d{i}" for i in range(len(terms)))
    idf = lambda i: f"CASE WHEN ln((n - d{i} + 0.5) / (d{i} + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - d{i} + 0.5) / (d{i} + 0.5)) END"
    score = " - ".join(f"({idf(i)}) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * size / mean))" for i in range(len(terms)))
    return f"""WITH b AS (SELECT doc_id, {DOC_TOKENS} AS t FROM documents), c AS (SELECT doc_id, len(t) AS size, {f} FROM b),
s AS (SELECT count(*) AS n, avg(size) AS mean, {d} FROM c)
SELECT doc_id, round(0 - {score}, 6) AS score FROM c, s WHERE {where} ORDER BY 2, 1 LIMIT 20"""


def _hits(spark: SparkSession, d: str, text: str) -> DataFrame:
    index = search.index_of(load(spark, d, "documents").select("doc_id", "text"), "doc_id", ["text"], f"{d}/documents")
    return search.search_index(index, text).withColumnRenamed("doc", "doc_id")


@query(_bm25_sql(["navio", "neve"], "f0 > 0 AND f1 > 0"))
def fts_and_bm25_top20(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d, "navio neve").orderBy("score", "doc_id").limit(20)


@query(_bm25_sql(["serpente", "veneno"], "f0 > 0 OR f1 > 0"))
def fts_or_bm25_top20(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d, "serpente OR veneno").orderBy("score", "doc_id").limit(20)


@query(f"SELECT doc_id FROM (SELECT doc_id, {DOC_TOKENS} AS t FROM documents) WHERE (list_contains(t, 'porto') OR list_contains(t, 'barco')) AND NOT list_contains(t, 'navio')")
def fts_or_not_filter(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d, "(porto OR barco) NOT navio").select("doc_id")


@query(f"SELECT source, count(*) AS n FROM (SELECT source, {DOC_TOKENS} AS t FROM documents) WHERE len(list_filter(t, lambda x: starts_with(x, 'templ'))) > 0 GROUP BY source")
def fts_prefix_count(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d, "templ*").join(load(spark, d, "documents").select("doc_id", "source"), "doc_id").groupBy("source").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id FROM (SELECT doc_id, ' ' || array_to_string({DOC_TOKENS}, ' ') || ' ' AS t FROM documents) WHERE contains(t, ' em sentido figurado ')")
def fts_phrase_match(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d, '"em sentido figurado"').select("doc_id")


@query(f"""WITH p AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM (SELECT doc_id, {DOC_TOKENS} AS t FROM documents))
SELECT DISTINCT a.doc_id FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.w = 'navio' AND b.w = 'vento' AND abs(a.i - b.i) <= 6""")
def fts_near_match(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d, "NEAR(navio vento, 5)").select("doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, lang, source, {DOC_TOKENS} AS t FROM documents) WHERE list_contains(t, 'corda') AND lang = 'pt' AND source ILIKE '%nota%'")
def fts_doc_filters(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").where((F.col("lang") == "pt") & F.col("source").ilike("%nota%")).select("doc_id")
    return _hits(spark, d, "corda").join(docs, "doc_id").select("doc_id")


@query("""WITH b AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS r FROM documents),
f AS (SELECT doc_id, r, list_transform(r, lambda x: regexp_replace(lower(strip_accents(x)), '[^\\p{L}\\p{N}]+', '', 'g')) AS w FROM b),
h AS (SELECT *, coalesce(list_position(w, 'herdeiro'), list_position(w, 'heranca'), 1) AS p FROM f WHERE list_contains(w, 'heranca')),
g AS (SELECT *, greatest(1, least(p - 6, len(r) - 11)) AS b FROM h)
SELECT doc_id, CASE WHEN b > 1 THEN '…' ELSE '' END || array_to_string(list_transform(range(b, least(b + 12, len(r) + 1)), lambda i: CASE WHEN w[i] = 'heranca' THEN '[' || r[i] || ']' ELSE r[i] END), ' ')
  || CASE WHEN b + 12 <= len(r) THEN '…' ELSE '' END AS snippet FROM g""")
def fts_snippet(spark: SparkSession, d: str) -> DataFrame:
    words = F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda x: x != ""), lambda x: F.regexp_replace(F.lower(fold(x)), r"[^\p{L}\p{N}]+", ""))
    # a word of the text is a word of the index unless signs part it, so the index finds all rows that may hold it
    docs = load(spark, d, "documents").select("doc_id", "text").join(_hits(spark, d, "herança").select("doc_id"), "doc_id").where(F.array_contains(words, "heranca"))
    return docs.select("doc_id", search.snippet(F.col("text"), ["herança"]).alias("snippet"))


_FIELD_TOKENS = ", ".join(f"{TOKENS.format(c)} AS {n}" for c, n in (("lemas", "tl"), ("definicao", "td"), ("morfologia", "tm"), ("notas", "tn"), ("raw_text", "tr")))
_PHRASE = "len(list_filter(range(1, len({0}) + 1), lambda i: {0}[i] = 'relativo' AND {0}[i + 1] = 'ao' AND {0}[i + 2] = 'mar'))"


@query(f"""WITH e AS (SELECT e.*, coalesce(l.lemas, '') AS lemas FROM entry e LEFT JOIN (SELECT entry_id, string_agg(forma, ' / ' ORDER BY id) AS lemas FROM lemma WHERE entry_id IS NOT NULL GROUP BY 1) l ON l.entry_id = e.id),
t AS (SELECT id, {_FIELD_TOKENS} FROM e), c AS (SELECT id, len(tl) + len(td) + len(tm) + len(tn) + len(tr) AS size, len(list_filter(tl || td || tm || tn || tr, lambda x: x = 'navio')) AS f0, len(list_filter(tm, lambda x: x = 'adj')) AS f1,
 {' + '.join(_PHRASE.format(n) for n in ('tl', 'td', 'tm', 'tn', 'tr'))} AS f2 FROM t), s AS (SELECT count(*) AS n, avg(size) AS mean, count_if(f0 > 0) AS d0, count_if(f1 > 0) AS d1, count_if(f2 > 0) AS d2 FROM c)
SELECT id, round(0 - {" - ".join(f"(CASE WHEN ln((n - d{i} + 0.5) / (d{i} + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - d{i} + 0.5) / (d{i} + 0.5)) END) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * size / mean))" for i in range(3))}, 6) AS score
FROM c, s WHERE f0 > 0 OR (f1 > 0 AND f2 > 0) ORDER BY 2, 1 LIMIT 50""")
def fts_entry_search(spark: SparkSession, d: str) -> DataFrame:
    index = search.entry_index(load(spark, d, "entry"), load(spark, d, "lemma"), f"{d}/entry")
    return search.search_entries(load(spark, d, "entry"), load(spark, d, "lemma"), 'navio OR (f_morf : adj "relativo ao mar*")', limit=50, index=index).select("id", "score")


@query(f"""WITH t AS (SELECT id, unnest({TOKENS.format('definicao')}) AS term FROM entry)
SELECT term, count(*) AS uses, count(DISTINCT id) AS docs FROM t GROUP BY term HAVING count(*) >= 5""")
def fts_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    p = search.postings(load(spark, d, "entry"), "id", ["definicao"])
    return p.groupBy("term").agg(F.count("*").alias("uses"), F.countDistinct("doc").alias("docs")).where("uses >= 5")


@query("SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY source")
def facet_counts(spark: SparkSession, d: str) -> DataFrame:
    return publish.facet_counts(load(spark, d, "documents"), ["lang", "source"])


# ---- keys, strings, citations ------------------------------------------------------------------------------------
@query("SELECT doc_id, md5(lower(strip_accents(text))) AS folded FROM documents WHERE text IS NOT NULL")
def fold_text_keys(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.md5(F.lower(fold(F.col("text")))).alias("folded"))


@query("SELECT e.entry_id, l.id AS ls_id FROM v2_entry e JOIN (SELECT DISTINCT id, lemma FROM ls_entries) l ON lower(strip_accents(e.lemma_sort)) = lower(strip_accents(l.lemma))")
def accent_insensitive_join(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", unaccent_lower(F.col("lemma_sort")).alias("k"))
    x = load(spark, d, "ls_entries").select("id", "lemma").distinct().select(F.col("id").alias("ls_id"), unaccent_lower(F.col("lemma")).alias("k"))
    return e.join(x, "k").select("entry_id", "ls_id")


@query("SELECT source_id, coalesce(nullif(regexp_replace(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'volume') AS slug FROM dict_source")
def slug_names(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "dict_source").select("source_id", slugify(F.col("name")).alias("slug"))


_CLEANED = "trim(ref, E' \t\n\r')"
for _wrong, _right in (("—", "-"), ("–", "-"), ("•", ""), ("·", "."), ("..", "."), (" ,", ","), (" , ", ", "), (" .", "."), ("cit. LS", ""), ("(cit. LS)", "")):
    _CLEANED = f"replace({_CLEANED}, '{_wrong}', '{_right}')"
_CLEANED = f"replace(replace(trim(regexp_replace(regexp_replace({_CLEANED}, '[;,.)\\]]+$', ''), '\\s+', ' ', 'g')), '1 Ped.', '1 Pet.'), 'App. M.', 'Apul. M.')"
_AUTHOR, _NAME = "[A-ZÁÉÍÓÚÂÊÎÔÛÃÕÀÇ][A-Za-zÁÉÍÓÚÂÊÎÔÛÃÕÀÇ. ]+?", "[A-Za-zÁÉÍÓÚÂÊÎÔÛÃÕÀÇ][A-Za-zÁÉÍÓÚÂÊÎÔÛÃÕÀÇ. ]+?"


@query(f"""WITH r AS (SELECT unnest(regexp_extract_all(definicao, '\\(([A-Z][^()]*)\\)', 1)) AS ref FROM entry), c AS (SELECT {_CLEANED} AS x FROM r),
p AS (SELECT x, regexp_matches(x, '[^\\p{{L}}\\p{{M}}\\p{{N}}_.,\\s()-]') AS odd, nullif(regexp_extract(x, '^({_AUTHOR})\\s+({_NAME})\\s+(.+)$', 1), '') AS a, nullif(regexp_extract(x, '^({_AUTHOR})\\s+({_NAME})\\s+(.+)$', 2), '') AS w,
 nullif(regexp_extract(x, '^({_AUTHOR})\\s+({_NAME})\\s+(.+)$', 3), '') AS l, nullif(regexp_extract(x, '^({_AUTHOR})\\s+(.+)$', 1), '') AS a2, nullif(regexp_extract(x, '^({_AUTHOR})\\s+(.+)$', 2), '') AS l2 FROM c),
q AS (SELECT coalesce(a, a2) AS a, w, CASE WHEN a IS NOT NULL THEN l ELSE l2 END AS l, odd FROM p),
j AS (SELECT *, a IS NULL AS bad, a IS NOT NULL AND w IS NULL AS alone, coalesce(NOT regexp_matches(l, '[0-9]'), FALSE) AS blind FROM q)
SELECT coalesce(a, '') AS fonte, coalesce(w, '') AS obra, CASE WHEN bad THEN 'invalido' WHEN blind OR alone THEN 'parcial' ELSE 'ok' END AS status,
round(greatest(0.0, CASE WHEN blind THEN least(0.4, CASE WHEN bad THEN 0.2 WHEN alone THEN 0.6 ELSE 0.9 END - CASE WHEN odd THEN 0.2 ELSE 0.0 END) ELSE CASE WHEN bad THEN 0.2 WHEN alone THEN 0.6 ELSE 0.9 END - CASE WHEN odd THEN 0.2 ELSE 0.0 END END)::DOUBLE, 6) AS confidence,
coalesce(NOT regexp_matches(l, '(?i)[0-9]|pr\\.|pref\\.'), FALSE) AS noted, count(*) AS n FROM j GROUP BY ALL""")
def citation_parse(spark: SparkSession, d: str) -> DataFrame:
    refs = load(spark, d, "entry").select(F.explode(F.regexp_extract_all("definicao", F.lit(r"\(([A-Z][^()]*)\)"), 1)).alias("ref"))
    p = refs.select(split_reference(F.col("ref")).alias("r")).select("r.*")
    noted = F.coalesce(F.contains("err_msg", F.lit("loc_formato_atipico")), F.lit(False))
    return p.groupBy(F.coalesce("fonte", F.lit("")).alias("fonte"), F.coalesce("obra", F.lit("")).alias("obra"), "status", "confidence", noted.alias("noted")).agg(F.count("*").alias("n"))


@query("SELECT entry_id, split_part(id, ':', 1) AS doc_name, CASE WHEN regexp_matches(split_part(id, ':', 2), '^[0-9]+$') THEN CAST(split_part(id, ':', 2) AS INTEGER) END AS page_num FROM v2_entry")
def id_parse(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "v2_entry").select("entry_id", strings.chunk_and_page(F.col("id")).alias("p")).select("entry_id", "p.doc_name", "p.page_num")


@query("SELECT id, floor(coalesce(page_num, 0) / 100)::INTEGER AS bucket, CASE WHEN length(raw_text) > 120 THEN substr(raw_text, 1, 120) || '…' ELSE raw_text END AS preview FROM entry")
def page_previews(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "entry").select("id", strings.page_bucket(F.col("page_num")).alias("bucket"), strings.preview(F.col("raw_text"), 120).alias("preview"))


@query("SELECT id, json_extract_string(props, '$.k')::BIGINT AS k FROM (SELECT event_id AS id, props FROM events) WHERE json_extract_string(props, '$.k')::BIGINT % 2 = 0")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").select(F.col("event_id").alias("id"), F.from_json("props", "k bigint")["k"].alias("k"))
    return e.where("k % 2 = 0")


@query("""WITH t AS (SELECT DISTINCT id, orths, explicit_forms FROM ls_entries),
u AS (SELECT id, unnest(CAST(json(orths) AS VARCHAR[]) || CAST(json(explicit_forms) AS VARCHAR[])) AS w FROM t), v AS (SELECT id, unnest(regexp_split_to_array(lower(strip_accents(w)), '[ ,;]+')) AS x FROM u)
SELECT id, string_agg(DISTINCT x, ' ' ORDER BY x) AS blob FROM v WHERE length(x) > 2 GROUP BY id""")
def search_blobs(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "ls_entries").select("id", "orths", "explicit_forms").distinct()
    b = strings.search_blob(strings.json_list(F.col("orths")), strings.json_list(F.col("explicit_forms")))
    return e.select("id", b.alias("blob")).where("blob != ''")


# ---- labels and classes ------------------------------------------------------------------------------------------
@query("""SELECT entry_id, CASE WHEN morph_render LIKE 's.%' THEN 'NOUN' WHEN morph_render LIKE 'v.%' THEN 'VERB' WHEN morph_render LIKE 'adv%' THEN 'ADV' WHEN morph_render LIKE 'adj%' THEN 'ADJ' ELSE 'UNK' END AS pos,
CASE WHEN morph_render LIKE 's. masc%' THEN 'm' WHEN morph_render LIKE 's. fem%' THEN 'f' WHEN morph_render LIKE 's. neutr%' THEN 'n' END AS gender,
CASE WHEN morph_render LIKE 's.%' THEN nullif(regexp_extract(morph_render, '\\dª \\(-[a-z]+\\)'), '') END AS decl_class,
CASE WHEN morph_render LIKE 'v.%' THEN nullif(regexp_extract(morph_render, '\\dª \\(-.+\\)'), '') END AS verb_class FROM v2_entry""")
def label_parse(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", morph.parse_label(F.col("morph_render")).alias("m"))
    return e.select("entry_id", "m.pos", "m.gender", "m.decl_class", "m.verb_class")


@query("""SELECT entry_id, CASE upper(trim(pos)) WHEN 'NOUN' THEN concat_ws(' ', 's.', CASE gender WHEN 'm' THEN 'masc.' WHEN 'f' THEN 'fem.' WHEN 'n' THEN 'neutro.' END, decl_class)
WHEN 'PROPN' THEN concat_ws(' ', 's.', CASE gender WHEN 'm' THEN 'masc.' WHEN 'f' THEN 'fem.' WHEN 'n' THEN 'neutro.' END, decl_class) WHEN 'VERB' THEN concat_ws(' ', 'v.', verb_class) WHEN 'ADJ' THEN 'adj.' WHEN 'ADV' THEN 'adv.' END AS label FROM v2_entry WHERE indeclinable = 0""")
def label_render(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").where("indeclinable = 0")
    return e.select("entry_id", morph.render_label(F.col("pos"), F.col("gender"), F.col("decl_class"), F.col("verb_class"), F.col("indeclinable")).alias("label"))


@query("""WITH g AS (SELECT entry_id, lower(trim(split_part(head_raw, ',', 2))) AS g, gender, pos FROM v2_entry WHERE upper(trim(pos)) = 'NOUN')
SELECT entry_id, CASE WHEN c IS NOT NULL THEN concat_ws(' ', 's.', CASE gender WHEN 'm' THEN 'masc.' WHEN 'f' THEN 'fem.' WHEN 'n' THEN 'neutro.' END, c) END AS label FROM (
SELECT *, CASE WHEN g LIKE '%ae' THEN '1ª (-ae)' WHEN g LIKE '%ei' THEN '5ª (-ei)' WHEN g LIKE '%is' THEN '3ª (-is)' WHEN g LIKE '%us' THEN '4ª (-us)' WHEN g LIKE '%i' THEN '2ª (-i)' END AS c FROM g)""")
def noun_classes(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").where(F.upper(F.trim("pos")) == "NOUN")
    return e.select("entry_id", morph.noun_class(F.split_part("head_raw", F.lit(","), F.lit(2)), F.col("gender"), F.lit(0)).alias("label"))


_THREE = "SELECT o_orderkey AS k, o_orderstatus AS a, CASE WHEN o_totalprice > 150000 THEN 'O' WHEN o_totalprice > 50000 THEN 'F' END AS b, CASE WHEN o_orderpriority LIKE '1%' THEN 'F' WHEN o_orderpriority LIKE '5%' THEN 'O' END AS c FROM orders"


@query(f"SELECT k, CASE WHEN a = b OR a = c THEN a WHEN b = c THEN b ELSE coalesce(a, b, c) END AS label FROM ({_THREE})")
def consensus_vote(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders")
    a, price, prio = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    b = F.when(price > 150000, "O").when(price > 50000, "F")
    c = F.when(prio.startswith("1"), "F").when(prio.startswith("5"), "O")
    return o.select(F.col("o_orderkey").alias("k"), morph.vote(a, b, c)["label"].alias("label"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT user_id, sum(n)::BIGINT AS total, max(n) AS top FROM c GROUP BY 1)
SELECT t.user_id, CASE WHEN 2 * t.top >= t.total THEN min(c.event_type) END AS label FROM t JOIN c ON c.user_id = t.user_id AND c.n = t.top GROUP BY t.user_id, t.top, t.total""")
def majority_label(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    g = c.groupBy("user_id").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("m"), "event_type")).alias("b"))
    return g.select("user_id", F.when(-2 * F.col("b.m") >= F.col("total"), F.col("b.event_type")).alias("label"))


# ---- joins -------------------------------------------------------------------------------------------------------
@query("SELECT entry_id, count(*) AS n_forms, string_agg(form, ' / ' ORDER BY form_id) AS forms FROM v2_form GROUP BY entry_id")
def group_concat_forms(spark: SparkSession, d: str) -> DataFrame:
    f = load(spark, d, "v2_form").groupBy("entry_id").agg(F.array_sort(F.collect_list(F.struct("form_id", "form"))).alias("x"))
    return f.select("entry_id", F.size("x").cast("bigint").alias("n_forms"), F.array_join(F.transform("x", lambda s: s["form"]), " / ").alias("forms"))


@query("""SELECT e.id, coalesce(e.morfologia, '') AS morfologia, coalesce(l.lemas, '') AS lemas FROM entry e LEFT JOIN (SELECT entry_id, string_agg(forma, ' / ' ORDER BY id) AS lemas FROM lemma WHERE entry_id IS NOT NULL GROUP BY 1) l ON l.entry_id = e.id""")
def entry_with_lemmas(spark: SparkSession, d: str) -> DataFrame:
    return search.entry_source(load(spark, d, "entry"), load(spark, d, "lemma")).select("id", F.coalesce("morfologia", F.lit("")).alias("morfologia"), "lemas")


@query("""SELECT e.entry_id, coalesce(s.gloss, '') AS gloss, coalesce(e.conf, 'none') AS conf FROM v2_entry e LEFT JOIN (SELECT DISTINCT sense_id, entry_id, gloss FROM v2_sense WHERE parent_id IS NULL) s ON s.entry_id = e.entry_id""")
def view_defaults(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "v2_sense").where("parent_id IS NULL").select("sense_id", "entry_id", "gloss").distinct()
    e = load(spark, d, "v2_entry").select("entry_id", "conf")
    return e.join(s, "entry_id", "left").select("entry_id", F.coalesce("gloss", F.lit("")).alias("gloss"), F.coalesce("conf", F.lit("none")).alias("conf"))


@query("""SELECT a.lemma_sort, a.entry_id, b.id AS ls_id FROM (SELECT lemma_sort, min(entry_id) AS entry_id FROM v2_entry WHERE lemma_sort IS NOT NULL GROUP BY 1 HAVING count(*) = 1) a
JOIN (SELECT lemma, min(id) AS id FROM (SELECT DISTINCT id, lemma FROM ls_entries) GROUP BY 1 HAVING count(*) = 1) b ON a.lemma_sort = b.lemma""")
def unique_key_join(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("lemma_sort", "entry_id")
    x = load(spark, d, "ls_entries").select(F.col("id").alias("ls_id"), F.col("lemma").alias("lemma_sort")).distinct()
    return lookup.unique_key_join(e, x, "lemma_sort").select("lemma_sort", "entry_id", "ls_id")


_PROOFS = """WITH f AS (SELECT lemma AS k, 'ls' AS w FROM ls_entries UNION SELECT form_norm, 'form' FROM v2_form WHERE kind <> 'orth' UNION SELECT forma, 'lexicon' FROM lemma),
p AS (SELECT k, count(*) AS n, string_agg(w, ',' ORDER BY w) AS s FROM f WHERE k IS NOT NULL GROUP BY k)
SELECT e.entry_id, coalesce(p.n, 0)::INTEGER AS found_count, coalesce(p.s, '') AS found_where, CASE WHEN p.n >= 2 THEN 'strong' WHEN p.n = 1 THEN 'weak' ELSE 'none' END AS consensus_note FROM v2_entry e LEFT JOIN p ON p.k = e.lemma_sort"""


def _proofs(spark: SparkSession, d: str) -> DataFrame:
    sources = {"ls": load(spark, d, "ls_entries").select("lemma"), "form": load(spark, d, "v2_form").where("kind <> 'orth'").select("form_norm"), "lexicon": load(spark, d, "lemma").select("forma")}
    return lookup.proofs(load(spark, d, "v2_entry").select("entry_id", "lemma_sort"), "lemma_sort", sources)


@query(_PROOFS)
def found_where_proofs(spark: SparkSession, d: str) -> DataFrame:
    return _proofs(spark, d).select("entry_id", "found_count", "found_where", "consensus_note")


@query(f"SELECT entry_id FROM ({_PROOFS}) WHERE found_count = 0")
def orphans_anti(spark: SparkSession, d: str) -> DataFrame:
    return _proofs(spark, d).where("found_count = 0").select("entry_id")


@query("""WITH u AS (SELECT e.entry_id, f.form_id FROM v2_entry e JOIN v2_form f ON f.form_norm = e.lemma_sort UNION SELECT e.entry_id, f.form_id FROM v2_entry e JOIN v2_form f ON f.form = e.lemma),
r AS (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY form_id) AS rn FROM u) SELECT entry_id, form_id FROM r WHERE rn <= 5""")
def evidence_lookup(spark: SparkSession, d: str) -> DataFrame:
    e, f = load(spark, d, "v2_entry").select(F.col("entry_id"), "lemma_sort", "lemma"), load(spark, d, "v2_form").select("form_id", "form_norm", "form")
    return lookup.first_matches(e, "entry_id", f, "form_id", [("lemma_sort", "form_norm"), ("lemma", "form")], 5)


@query("""SELECT id, entry_id, tier FROM (SELECT l.id, e.entry_id, e.tier, row_number() OVER (PARTITION BY l.id ORDER BY e.tier, e.needs_review, e.morph_out_of_vocab, e.entry_id) AS rn FROM (SELECT DISTINCT id, lemma FROM ls_entries) l
JOIN (SELECT lemma_sort AS k, 0 AS tier, needs_review, morph_out_of_vocab, entry_id FROM v2_entry UNION ALL SELECT lemma, 1, needs_review, morph_out_of_vocab, entry_id FROM v2_entry) e ON e.k = l.lemma) WHERE rn = 1""")
def best_definition(spark: SparkSession, d: str) -> DataFrame:
    x = load(spark, d, "ls_entries").select("id", F.col("lemma").alias("k")).distinct()
    e = load(spark, d, "v2_entry").select("lemma_sort", "lemma", "needs_review", "morph_out_of_vocab", "entry_id")
    tiers = [x.join(e.withColumnRenamed(c, "k"), "k").select("id", "needs_review", "morph_out_of_vocab", "entry_id") for c in ("lemma_sort", "lemma")]
    return lookup.best_by_tier(tiers, "id", ["needs_review", "morph_out_of_vocab", "entry_id"]).select("id", "entry_id", "tier")


@query("SELECT e.id, e.doc_name, e.page_num FROM entry e WHERE NOT EXISTS (SELECT 1 FROM ocr_page p WHERE p.doc_name = e.doc_name AND p.page_num = e.page_num AND p.extracted_text IS NOT NULL)")
def processed_anti(spark: SparkSession, d: str) -> DataFrame:
    done = load(spark, d, "ocr_page").where("extracted_text IS NOT NULL").select("doc_name", "page_num")
    return load(spark, d, "entry").select("id", "doc_name", "page_num").join(done, ["doc_name", "page_num"], "left_anti").select("id", "doc_name", "page_num")


@query("""SELECT coalesce(a.k, b.k) AS lemma, a.entry_id, b.ls_id FROM (SELECT lemma_sort AS k, min(entry_id) AS entry_id FROM v2_entry GROUP BY 1) a FULL OUTER JOIN (SELECT lemma AS k, min(id) AS ls_id FROM ls_entries GROUP BY 1) b ON a.k = b.k""")
def unified_dictionary(spark: SparkSession, d: str) -> DataFrame:
    a = load(spark, d, "v2_entry").groupBy(F.col("lemma_sort").alias("lemma")).agg(F.min("entry_id").alias("entry_id"))
    b = load(spark, d, "ls_entries").groupBy("lemma").agg(F.min("id").alias("ls_id"))
    return a.join(b, "lemma", "full_outer").select("lemma", "entry_id", "ls_id")


@query("SELECT 'v2' AS fonte, lemma_sort AS lemma, definicao AS texto FROM v2_entry WHERE lemma_sort BETWEEN 'b' AND 'c' UNION ALL SELECT 'ls', lemma, definition FROM ls_entries WHERE lemma BETWEEN 'b' AND 'c'")
def union_compare(spark: SparkSession, d: str) -> DataFrame:
    a = load(spark, d, "v2_entry").where("lemma_sort BETWEEN 'b' AND 'c'").select(F.lit("v2").alias("fonte"), F.col("lemma_sort").alias("lemma"), F.col("definicao").alias("texto"))
    b = load(spark, d, "ls_entries").where("lemma BETWEEN 'b' AND 'c'").select(F.lit("ls").alias("fonte"), "lemma", F.col("definition").alias("texto"))
    return a.unionByName(b)


# ---- triples -----------------------------------------------------------------------------------------------------
_TRIPLES = """SELECT tab || ':' || s AS subject, p AS campo, v AS valor FROM (
SELECT 'entry' AS tab, id::VARCHAR AS s, 'morf' AS p, morfologia AS v FROM entry UNION ALL SELECT 'entry', entry_id::VARCHAR, 'lema', forma FROM lemma WHERE entry_id IS NOT NULL UNION ALL SELECT 'entry', id::VARCHAR, 'doc', doc_name FROM entry) WHERE v IS NOT NULL"""


def _triples(spark: SparkSession, d: str) -> DataFrame:
    e, x = load(spark, d, "entry"), load(spark, d, "lemma").where("entry_id IS NOT NULL")
    part = lambda df, key, name, value: df.select(F.concat(F.lit("entry:"), F.col(key).cast("string")).alias("subject"), F.lit(name).alias("campo"), F.col(value).alias("valor"))
    return part(e, "id", "morf", "morfologia").unionByName(part(x, "entry_id", "lema", "forma")).unionByName(part(e, "id", "doc", "doc_name")).where("valor IS NOT NULL")


@query(f"SELECT subject, coalesce(string_agg(valor, '|' ORDER BY valor) FILTER (campo = 'lema'), '') AS lema, coalesce(string_agg(valor, '|' ORDER BY valor) FILTER (campo = 'morf'), '') AS morf FROM ({_TRIPLES}) GROUP BY subject")
def triples_pivot(spark: SparkSession, d: str) -> DataFrame:
    p = _triples(spark, d).groupBy("subject").pivot("campo", ["lema", "morf"]).agg(F.array_join(F.array_sort(F.collect_list("valor")), "|"))
    return p.select("subject", F.coalesce("lema", F.lit("")).alias("lema"), F.coalesce("morf", F.lit("")).alias("morf"))


@query(f"SELECT t.subject, t.campo, t.valor FROM ({_TRIPLES}) t SEMI JOIN (SELECT subject FROM ({_TRIPLES}) WHERE campo = 'lema' AND (lower(valor) = 'fansondefosis' OR lower(valor) LIKE 'fa%')) h ON h.subject = t.subject")
def triples_prefix_lookup(spark: SparkSession, d: str) -> DataFrame:
    t = _triples(spark, d)
    hit = t.where((F.col("campo") == "lema") & ((F.lower("valor") == "fansondefosis") | F.lower("valor").startswith("fa"))).select("subject").distinct()
    return t.join(hit, "subject", "left_semi").select("subject", "campo", "valor")


@query("SELECT form_id, form_norm FROM v2_form WHERE lower(form_norm) BETWEEN 'd' AND 'f' AND kind = 'orth'")
def nocase_range(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "v2_form").where(F.lower("form_norm").between("d", "f") & (F.col("kind") == "orth")).select("form_id", "form_norm")


# ---- windows, ranks, gaps ----------------------------------------------------------------------------------------
@query("""SELECT entry_id, array_to_string(list(lemma_sort) OVER (ORDER BY lemma_sort, entry_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), '|') AS prev,
array_to_string(list(lemma_sort) OVER (ORDER BY lemma_sort, entry_id ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), '|') AS next FROM v2_entry""")
def alpha_neighbours(spark: SparkSession, d: str) -> DataFrame:
    n = windows.neighbours(load(spark, d, "v2_entry").select("entry_id", "lemma_sort"), ["lemma_sort", "entry_id"], "lemma_sort")
    return n.select("entry_id", F.nullif(F.array_join("prev", "|"), F.lit("")).alias("prev"), F.nullif(F.array_join("next", "|"), F.lit("")).alias("next"))


@query("""WITH s AS (SELECT DISTINCT sense_id, entry_id FROM v2_sense) SELECT sense_id, lag(sense_id) OVER w AS prev, lead(sense_id) OVER w AS next FROM s WINDOW w AS (PARTITION BY entry_id ORDER BY sense_id)""")
def group_neighbours(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "v2_sense").select("sense_id", "entry_id").distinct()
    return windows.group_neighbours(s, "entry_id", ["sense_id"], "sense_id").select("sense_id", "prev", "next")


@query("""WITH p AS (SELECT DISTINCT doc_name, page_num FROM ocr_page WHERE page_num >= 1), m AS (SELECT doc_name, max(page_num) AS hi FROM p GROUP BY 1), a AS (SELECT doc_name, unnest(range(1, hi + 1))::INTEGER AS page_num FROM m)
SELECT a.doc_name, a.page_num FROM a ANTI JOIN p ON p.doc_name = a.doc_name AND p.page_num = a.page_num""")
def page_gaps(spark: SparkSession, d: str) -> DataFrame:
    return windows.page_gaps(load(spark, d, "ocr_page"), "doc_name", "page_num")


@query("""WITH k AS (SELECT entry_id, lower(strip_accents(lemma_sort)) AS key FROM v2_entry), n AS (SELECT entry_id, key, lead(key) OVER (ORDER BY entry_id) AS next_key FROM k)
SELECT entry_id, key, next_key FROM n WHERE key > next_key""")
def order_violations(spark: SparkSession, d: str) -> DataFrame:
    v = windows.order_violations(load(spark, d, "v2_entry").select("entry_id", "lemma_sort"), ["entry_id"], unaccent_lower(F.col("lemma_sort")))
    return v.where("reason = 'order'").select("entry_id", "key", "next_key")


@query("""SELECT entry_id, sense_id FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY coalesce(level, 99), sense_id) AS rn FROM (SELECT DISTINCT sense_id, entry_id, level FROM v2_sense)) WHERE rn = 1""")
def best_sense_by_priority(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "v2_sense").select("sense_id", "entry_id", F.coalesce("level", F.lit(99)).alias("level"))
    b = s.groupBy("entry_id").agg(F.min(F.struct("level", "sense_id")).alias("b"))
    return b.select("entry_id", "b.sense_id")


@query("SELECT l_orderkey, l_linenumber, rank FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 3")
def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber", "l_partkey")
    return load(spark, d, "lineitem").withColumn("rank", F.row_number().over(w).cast("bigint")).where("rank <= 3").select("l_orderkey", "l_linenumber", "rank")


@query("SELECT entry_id, arg_min(gloss, sense_id) FILTER (gloss IS NOT NULL) AS first_gloss, arg_max(n_label, sense_id) AS last_label FROM v2_sense GROUP BY entry_id")
def first_nonnull_ladder(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "v2_sense").groupBy("entry_id")
    return g.agg(F.min_by("gloss", F.when(F.col("gloss").isNotNull(), F.col("sense_id"))).alias("first_gloss"), F.max_by("n_label", F.when(F.col("n_label").isNotNull(), F.col("sense_id"))).alias("last_label"))


@query("SELECT doc_id, rn FROM (SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) AS rn FROM documents WHERE source IS NOT NULL) WHERE rn BETWEEN 101 AND 150")
def pagination(spark: SparkSession, d: str) -> DataFrame:
    n = windows.numbered(load(spark, d, "documents").where("source IS NOT NULL").select("doc_id", "source"), ["source", "doc_id"])
    return n.where("rn BETWEEN 101 AND 150").select("doc_id", "rn")


# ---- publication -------------------------------------------------------------------------------------------------
@query("""WITH n AS (SELECT id, page_num, row_number() OVER (ORDER BY id) - 1 AS o FROM entry) SELECT (o // 100)::INTEGER AS shard, count(*) AS count, min(id) AS first_id, max(id) AS last_id, min(page_num) AS page_min, max(page_num) AS page_max FROM n GROUP BY 1""")
def shards_and_blocks(spark: SparkSession, d: str) -> DataFrame:
    return publish.shard_index(publish.shards(load(spark, d, "entry").select("id", "page_num"), ["id"], 100), "id", "page_num")


@query("""WITH n AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS o FROM entry) SELECT id, printf('block-%04d.json', o // 100 + 1) AS block_file, (o % 100)::INTEGER AS idx_in_block FROM n""")
def block_lookup(spark: SparkSession, d: str) -> DataFrame:
    return publish.lookup(publish.shards(load(spark, d, "entry").select("id"), ["id"], 100), "id")


@query("""WITH h AS (SELECT entry_id, upper(substr(lemma_sort, 1, 1)) AS letter, lag(upper(substr(lemma_sort, 1, 1))) OVER (ORDER BY lemma_sort, entry_id) AS b FROM v2_entry) SELECT entry_id, letter FROM h WHERE b IS NULL OR b <> letter""")
def letter_headings(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", "lemma_sort")
    return publish.with_headings(e, ["lemma_sort", "entry_id"], first_letter(F.col("lemma_sort"))).where("is_heading").select("entry_id", "letter")


@query("SELECT coalesce(nullif(upper(substr(strip_accents(trim(forma)), 1, 1)), ''), '#') AS letter, count(*) AS n FROM lemma GROUP BY 1")
def first_letter_histogram(spark: SparkSession, d: str) -> DataFrame:
    return publish.first_letters(load(spark, d, "lemma"), "forma")


@query("SELECT form_norm AS value, count(*) AS n FROM v2_form WHERE form_norm IS NOT NULL GROUP BY 1 ORDER BY n DESC, min(form_id), 1 LIMIT 500")
def top_forms_500(spark: SparkSession, d: str) -> DataFrame:
    return publish.top_values(load(spark, d, "v2_form"), F.col("form_norm"), F.col("form_id"), 500)


@query("SELECT DISTINCT morph_render AS label FROM v2_entry WHERE morph_render <> ''")
def facet_values(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "v2_entry").where("morph_render <> ''").select(F.col("morph_render").alias("label")).distinct()


@query("""SELECT lower(trim(coalesce(conf, ''))) AS conf, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct, count_if(needs_review = 1) AS review, count(DISTINCT pos) AS n_pos FROM v2_entry GROUP BY 1""")
def conf_stats(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "v2_entry").groupBy(F.lower(F.trim(F.coalesce("conf", F.lit("")))).alias("conf")).agg(F.count("*").alias("n"), F.count_if(F.col("needs_review") == 1).alias("review"), F.countDistinct("pos").alias("n_pos"))
    total = g.agg(F.sum("n").alias("total"))
    return g.crossJoin(F.broadcast(total)).select("conf", "n", F.round(100.0 * F.col("n") / F.col("total"), 1).alias("pct"), "review", "n_pos")


@query("SELECT doc_name, page_num, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY id) AS ids FROM entry WHERE page_num IS NOT NULL GROUP BY 1, 2")
def nested_pages(spark: SparkSession, d: str) -> DataFrame:
    g = load(spark, d, "entry").where("page_num IS NOT NULL").groupBy("doc_name", "page_num").agg(F.array_sort(F.collect_list("id")).alias("x"))
    return g.select("doc_name", "page_num", F.size("x").cast("bigint").alias("n"), F.array_join(F.transform("x", lambda i: i.cast("string")), ",").alias("ids"))


@query("""WITH o AS (SELECT entry_id, row_number() OVER (PARTITION BY split_part(id, ':', 1) ORDER BY entry_id) AS i, split_part(id, ':', 1) AS doc, redirect_only FROM v2_entry) SELECT entry_id, doc || '-e' || i AS id FROM o WHERE redirect_only = 0""")
def flatten_redirects(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select(F.split_part("id", F.lit(":"), F.lit(1)).alias("doc"), F.struct("entry_id", "redirect_only").alias("item"))
    nested = e.groupBy("doc").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return publish.flatten_items(nested, "items", "doc").select(F.col("item.entry_id").alias("entry_id"), "id")


@query("""WITH h AS (SELECT lemma_sort, morph_render, definicao, lower(trim(conf)) AS conf, row_number() OVER w AS rn, CASE WHEN regexp_matches(upper(substr(trim(strip_accents(lemma_sort)), 1, 1)), '^[A-Z]$') THEN upper(substr(trim(strip_accents(lemma_sort)), 1, 1)) ELSE '#' END AS letter FROM v2_entry
 WINDOW w AS (ORDER BY lemma_sort NULLS FIRST, entry_id)), g AS (SELECT *, lag(letter) OVER (ORDER BY rn) AS before FROM h),
t AS (SELECT rn, letter, before, concat_ws(' ', '**' || lemma_sort || '**', CASE WHEN morph_render <> '' THEN '*' || morph_render || '*' END, CASE conf WHEN 'high' THEN '●' WHEN 'med' THEN '◐' WHEN 'low' THEN '○' END, definicao) AS line FROM g)
SELECT rn, CASE WHEN before IS NULL OR before <> letter THEN '## ' || letter || E'\\n\\n' || line ELSE line END AS text FROM t""")
def markdown_export(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", "lemma_sort", "morph_render", "definicao", "conf")
    return publish.markdown(e, ["lemma_sort", "entry_id"], "lemma_sort", "morph_render", "definicao", F.lower(F.trim("conf")))


# ---- fuzzy, vectors ----------------------------------------------------------------------------------------------
_PREFIXES = "['ab', 'ad', 'con', 'de', 'dis', 'ex', 'in', 'inter', 'ob', 'per', 'post', 'prae', 'pro', 're', 'sub', 'super', 'trans']"
_SWAPPED = (
    "[{0}, replace({0}, 'o', 'u'), replace({0}, 'u', 'o'), replace({0}, 'rn', 'm'), replace({0}, 'm', 'rn'), replace({0}, 'cl', 'd'), replace({0}, 'd', 'cl'), "
    "replace({0}, 'æ', 'ae'), replace({0}, 'œ', 'oe'), replace({0}, 'j', 'i'), replace({0}, 'v', 'u'), replace({0}, 'ſ', 's')]"
)
_VARIANTS = f"""words AS (SELECT DISTINCT lemma_sort AS word FROM v2_entry WHERE lemma_sort <> ''),
seeds AS (SELECT word, word AS s FROM words UNION SELECT word, CASE WHEN starts_with(word, p || '-') THEN p || substr(word, length(p) + 2) ELSE p || '-' || substr(word, length(p) + 1) END
  FROM words, (SELECT unnest({_PREFIXES}) AS p) WHERE starts_with(word, p) AND length(word) > length(p)),
once AS (SELECT DISTINCT word, unnest({_SWAPPED.format('s')}) AS v FROM seeds), twice AS (SELECT DISTINCT word, unnest({_SWAPPED.format('v')}) AS v FROM once),
met AS (SELECT DISTINCT t.word, l.lemma AS match FROM twice t JOIN ls_entries l ON l.lemma = t.v WHERE l.lemma <> '')"""


@query(f"""WITH {_VARIANTS} SELECT word, match, levenshtein(word, match)::INTEGER AS distance FROM met""")
def ocr_variants_join(spark: SparkSession, d: str) -> DataFrame:
    return fuzzy.variant_matches(load(spark, d, "v2_entry"), "lemma_sort", load(spark, d, "ls_entries"), "lemma").select("word", "match", "distance")


_BIGRAMS = "list_distinct(list_transform(range(1, greatest(length({0}) - 1, 1) + 1), lambda i: substr({0}, i, 2)))"


@query(f"""WITH p AS (SELECT e.entry_id, e.lemma_sort AS a, l.id AS ls_id, l.lemma AS b FROM v2_entry e JOIN (SELECT DISTINCT id, lemma FROM ls_entries) l ON substr(e.lemma_sort, 1, 6) = substr(l.lemma, 1, 6)),
g AS (SELECT *, {_BIGRAMS.format('a')} AS x, {_BIGRAMS.format('b')} AS y FROM p) SELECT entry_id, ls_id, round(len(list_intersect(x, y))::DOUBLE / len(list_distinct(x || y)), 6) AS ratio, levenshtein(a, b)::INTEGER AS distance FROM g""")
def bigram_pairs(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", F.col("lemma_sort").alias("a"), F.substring("lemma_sort", 1, 6).alias("k"))
    x = load(spark, d, "ls_entries").select(F.col("id").alias("ls_id"), F.col("lemma").alias("b")).distinct().withColumn("k", F.substring("b", 1, 6))
    return e.join(x, "k").select("entry_id", "ls_id", F.round(fuzzy.bigram_ratio(F.col("a"), F.col("b")), 6).alias("ratio"), F.levenshtein("a", "b").alias("distance"))


@query()
def bigram_matches(spark: SparkSession, d: str) -> DataFrame:
    """All pairs with a bigram ratio of 0.5 or more (the gate of suggestions below high confidence), wherever the words differ."""
    e = load(spark, d, "v2_entry").select("entry_id", F.col("lemma_sort").alias("word"))
    x = load(spark, d, "ls_entries").select(F.col("id").alias("ls_id"), F.col("lemma").alias("match")).distinct()
    m = fuzzy.bigram_matches(e, "word", x, "match", 0.5)
    return m.join(e, "word").join(x, "match").select("entry_id", "ls_id", F.round("ratio", 6).alias("ratio"), F.levenshtein("word", "match").alias("distance"))


@query()
def close_matches(spark: SparkSession, d: str) -> DataFrame:
    return fuzzy.close_matches(load(spark, d, "v2_entry"), "lemma_sort", load(spark, d, "ls_entries"), "lemma", 3, 0.7)


_PAIR_RATIO = f"len(list_intersect({_BIGRAMS.format('word')}, {_BIGRAMS.format('match')}))::DOUBLE / len(list_distinct({_BIGRAMS.format('word')} || {_BIGRAMS.format('match')}))"
_CLASS = "CASE WHEN {0} IN ('NOUN', 'PROPN', 'N', 'S') THEN 'NOUN' WHEN {0} IN ('VERB', 'V') THEN 'VERB' WHEN {0} IN ('ADJ', 'A') THEN 'ADJ' WHEN {0} = 'ADV' THEN 'ADV' ELSE 'UNK' END"
_KEY = "regexp_replace(regexp_replace(translate(lower(strip_accents({0})), 'jv', 'iu'), '[.,;:!?\\[\\](){{}}*_-]', '', 'g'), '\\s+', '', 'g')"


@query(f"""WITH {_VARIANTS}, s AS (SELECT word, match, {_PAIR_RATIO} AS ratio, levenshtein(word, match) AS dist FROM met), b AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY round(ratio, 6) DESC, dist, match) AS k FROM s),
n AS (SELECT entry_id, lemma_sort, definicao, {_CLASS.format("upper(trim(pos))")} AS old_pos, lag(lemma_sort) OVER w AS prev, lead(lemma_sort) OVER w AS nxt FROM v2_entry WINDOW w AS (ORDER BY lemma_sort, entry_id)),
l AS (SELECT lemma, min({_CLASS.format("upper(trim(regexp_replace(pos, '[.].*', '')))")}) AS new_pos FROM ls_entries GROUP BY 1),
g AS (SELECT n.entry_id, b.word, b.match, CASE WHEN b.ratio >= 0.85 THEN 'high' ELSE 'med' END AS conf, b.ratio, (starts_with(word, '-') OR ends_with(word, '-')) = (starts_with(match, '-') OR ends_with(match, '-')) OR {_KEY.format('word')} = {_KEY.format('match')} AS ok_affix,
  n.prev IS NULL OR n.nxt IS NULL OR lower(strip_accents(b.match)) BETWEEN lower(strip_accents(n.prev)) AND lower(strip_accents(n.nxt)) AS ok_span,
  n.old_pos = 'UNK' OR l.new_pos = 'UNK' OR n.old_pos = l.new_pos OR (n.old_pos IN ('NOUN', 'ADJ') AND l.new_pos IN ('NOUN', 'ADJ') AND len(list_filter(['people', 'orum', 'civitas', 'urbs', 'flumen', 'gentilic', 'populus', 'povo', 'cidade', 'rio', 'gentílico', 'gentilício'], lambda x: contains(lower(coalesce(n.definicao, '')), x))) > 0) AS ok_pos
  FROM n JOIN b ON b.word = n.lemma_sort AND b.k = 1 JOIN l ON l.lemma = b.match),
v AS (SELECT *, ratio >= CASE conf WHEN 'high' THEN 0.35 ELSE 0.5 END AS ok_similar FROM g)
SELECT entry_id, match, ok_affix, ok_similar, ok_span, ok_pos, CASE WHEN ok_affix AND ok_similar AND ok_span THEN CASE WHEN ok_pos THEN conf WHEN conf = 'high' THEN 'med' ELSE 'low' END ELSE 'reject' END AS verdict FROM v""")
def gates_chain(spark: SparkSession, d: str) -> DataFrame:
    """Gates of the best spelling variant of every headword, with its real neighbours and word classes."""
    e = load(spark, d, "v2_entry").select("entry_id", "lemma_sort", "definicao", "pos")
    x = load(spark, d, "ls_entries")
    cls = lambda c: F.when(c.isin("NOUN", "PROPN", "N", "S"), "NOUN").when(c.isin("VERB", "V"), "VERB").when(c.isin("ADJ", "A"), "ADJ").when(c == "ADV", "ADV").otherwise("UNK")
    best = fuzzy.best_match(fuzzy.variant_matches(e, "lemma_sort", x, "lemma"), "word").withColumn("conf", F.when(F.col("ratio") >= 0.85, "high").otherwise("med"))
    other = x.groupBy(F.col("lemma").alias("match")).agg(F.min(cls(F.upper(F.trim(F.regexp_replace("pos", r"[.].*", ""))))).alias("new_pos"))
    near = windows.neighbours(e, ["lemma_sort", "entry_id"], "lemma_sort", 1).withColumnRenamed("lemma_sort", "word")
    rows = near.join(best, "word").join(other, "match")
    g = fuzzy.gates(rows, "word", "match", "conf", F.get("prev", F.lit(0)), F.get("next", F.lit(0)), cls(F.upper(F.trim("pos"))), F.col("new_pos"), fuzzy.gentilic(F.col("definicao")))
    return g.select("entry_id", "match", "ok_affix", "ok_similar", "ok_span", "ok_pos", "verdict")


@query("""WITH q AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 100 = 0), c AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS hit_id, list_cosine_similarity(q.e, c.e) AS s FROM q, c WHERE q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, hit_id) AS rank FROM s) SELECT query_id, hit_id, rank::INTEGER AS rank, round(s, 4) AS score FROM r WHERE rank <= 10""")
def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "embeddings")
    return vector.top_k(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 10)


# ---- duplicates, decisions, patches ------------------------------------------------------------------------------
@query("SELECT lemma_sort AS key, count(*) AS n FROM v2_entry WHERE coalesce(lemma_sort, '') <> '' GROUP BY 1 HAVING count(*) >= 2")
def dup_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.clusters(load(spark, d, "v2_entry"), F.col("lemma_sort"))


@query("""SELECT lemma_sort AS key, count(*) AS n, CASE WHEN count(DISTINCT coalesce(morph_render, '~') || '#' || coalesce(definicao, '~')) = 1 THEN 'AUTO_KEEP_ALL' WHEN count(DISTINCT nullif(upper(trim(pos)), 'UNK')) > 1 AND max((lemma_sort IN (SELECT lemma FROM ls_entries WHERE lemma IS NOT NULL))::INT) = 1 THEN 'AUTO_HOMONYMS_KEEP' ELSE 'REVIEW' END AS gate FROM v2_entry WHERE coalesce(lemma_sort, '') <> '' GROUP BY 1 HAVING count(*) > 1""")
def cluster_gates(spark: SparkSession, d: str) -> DataFrame:
    return _gated(spark, d).select("key", "n", "gate")


def _gated(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.cluster_gates(load(spark, d, "v2_entry"), F.col("lemma_sort"), ["morph_render", "definicao"], F.upper(F.trim("pos")), load(spark, d, "ls_entries").select("lemma"))


@query("""WITH g AS (SELECT lemma_sort AS key FROM v2_entry WHERE coalesce(lemma_sort, '') <> '' GROUP BY 1 HAVING count(DISTINCT coalesce(morph_render, '~') || '#' || coalesce(definicao, '~')) > 1 AND count(DISTINCT nullif(upper(trim(pos)), 'UNK')) > 1),
k AS (SELECT g.key FROM g SEMI JOIN ls_entries l ON l.lemma = g.key), r AS (SELECT k.key, e.entry_id, row_number() OVER (PARTITION BY k.key ORDER BY e.entry_id) AS n FROM k JOIN v2_entry e ON e.lemma_sort = k.key)
SELECT key, entry_id, ['I', 'II', 'III', 'IV', 'V'][least(n, 5)] AS canonical_group FROM r""")
def homonym_labels(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.homonyms(load(spark, d, "v2_entry"), "lemma_sort", "entry_id", _gated(spark, d)).select("key", "entry_id", "canonical_group")


_DECIDED = """SELECT lemma_sort AS g, id, entry_id, min(entry_id) OVER (PARTITION BY lemma_sort) AS m, min(id) OVER (PARTITION BY lemma_sort) AS t, count(*) OVER (PARTITION BY lemma_sort) AS c FROM v2_entry"""


@query(f"""SELECT g AS group_id, id, CASE WHEN entry_id % 11 = 0 THEN 'manual' WHEN entry_id % 13 = 0 THEN 'drop' WHEN entry_id = m THEN 'keep' ELSE 'redirect' END AS action,
CASE WHEN c < 2 THEN 'group_below_min_size' WHEN entry_id % 11 = 0 THEN 'manual_skipped' WHEN entry_id % 13 = 0 THEN 'unknown_action:drop' WHEN entry_id = m THEN NULL WHEN entry_id % 5 = 0 THEN 'redirect_missing_target' WHEN t = id THEN 'redirect_to_self' END AS reason FROM ({_DECIDED})""")
def dedupe_validate(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d).select("group_id", "id", "action", "reason")


def _decided(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select(F.col("lemma_sort").alias("group_id"), "id", "entry_id")
    top = e.groupBy("group_id").agg(F.min("entry_id").alias("m"), F.min("id").alias("t"))
    x = e.join(top, "group_id")
    action = F.when(F.col("entry_id") % 11 == 0, "manual").when(F.col("entry_id") % 13 == 0, "drop").when(F.col("entry_id") == F.col("m"), "keep").otherwise("redirect")
    made = x.select("group_id", "id", action.alias("action"), F.when((action == "redirect") & (F.col("entry_id") % 5 != 0), F.col("t")).alias("redirect_to"))
    return dedupe.validate_decisions(made, e.select("group_id", "id"))


@query(f"""WITH v AS (SELECT g AS group_id, CASE WHEN entry_id % 11 = 0 THEN 'manual' WHEN entry_id % 13 = 0 THEN 'drop' WHEN entry_id = m THEN 'keep' ELSE 'redirect' END AS action,
CASE WHEN c < 2 THEN 'small' WHEN entry_id % 11 = 0 THEN 'manual_skipped' WHEN entry_id % 13 = 0 THEN 'unknown' WHEN entry_id = m THEN NULL WHEN entry_id % 5 = 0 THEN 'target' WHEN t = id THEN 'self' END AS reason FROM ({_DECIDED}) WHERE g IS NOT NULL),
p AS (SELECT count_if(reason IS NULL AND action = 'keep') AS k, count_if(reason IS NULL AND action = 'redirect') AS r, count_if(reason = 'manual_skipped') AS m, count_if(reason IS NOT NULL AND reason <> 'manual_skipped') AS f FROM v GROUP BY group_id)
SELECT sum(k)::BIGINT AS kept, sum(r)::BIGINT AS redirects, sum(m)::BIGINT AS manual, sum(f)::BIGINT AS refused, count_if(f = 0) AS groups_ok FROM p""")
def decision_counts(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.decision_counts(_decided(spark, d))


@query("""SELECT entry_id, CASE WHEN h THEN 'v. corr.' ELSE morph_render END AS morph_render, CASE WHEN h AND lower(trim(conf)) = 'high' THEN conf WHEN h THEN 'med' ELSE conf END AS conf,
CASE WHEN h AND coalesce(notas, '') = '' THEN 'corr.' WHEN h THEN notas || ' | corr.' ELSE notas END AS notas FROM (SELECT *, entry_id % 7 = 0 AS h FROM v2_entry)""")
def patch_update(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", "morph_render", "conf", "notas")
    p = e.where("entry_id % 7 = 0").select("entry_id", F.lit("v. corr.").alias("label"), F.lit("corr.").alias("note"))
    return patch.apply_patch(e, p, "entry_id", {"morph_render": F.col("p_label"), "conf": patch.raise_confidence(F.col("conf")), "notas": patch.append_note(F.col("notas"), F.col("p_note"), " | ")})


@query("""WITH s AS (SELECT id AS sid, lemma FROM (SELECT DISTINCT id, lemma FROM ls_entries)), c AS (SELECT s.sid, e.entry_id, count(e.entry_id) OVER (PARTITION BY s.sid) AS n, min(e.entry_id) OVER (PARTITION BY s.sid) AS m FROM s LEFT JOIN v2_entry e ON e.lemma_sort = s.lemma)
SELECT DISTINCT sid AS suggestion_id, m AS entry_id, CASE WHEN n = 0 THEN 'MISS' ELSE 'TAKE' END AS status FROM c""")
def suggestion_targets(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "ls_entries").select("id", "lemma").distinct().select(F.col("id").alias("suggestion_id"), F.lit(None).cast("bigint").alias("entry_id"), F.col("lemma").alias("norm"), F.lit(None).cast("string").alias("pos"), letters_only(F.col("lemma")).alias("letters"))
    e = load(spark, d, "v2_entry").select("entry_id", F.col("lemma_sort").alias("norm"), F.upper(F.trim("pos")).alias("pos"), letters_only(F.col("lemma_sort")).alias("letters"))
    return patch.choose_targets(s, e, "one")


@query("""SELECT entry_id, CASE WHEN lema IS NULL THEN 'missing_headword' WHEN src IS NULL THEN 'missing_source' END AS fault FROM (SELECT e.entry_id, nullif(trim(e.lemma), '') AS lema, s.source_id AS src FROM v2_entry e LEFT JOIN dict_source s ON s.source_id = e.source_id) WHERE lema IS NULL OR src IS NULL""")
def integrity_faults(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "dict_source").select("source_id", F.lit(True).alias("known"))
    e = load(spark, d, "v2_entry").join(s, "source_id", "left")
    fault = F.when(F.trim(F.coalesce("lemma", F.lit(""))) == "", "missing_headword").when(F.col("known").isNull(), "missing_source")
    return e.select("entry_id", fault.alias("fault")).where("fault IS NOT NULL")


QUERIES, ORACLE = Q, SQL
