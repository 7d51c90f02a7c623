"""Queries of listings, point lookups, form vocabularies, facets, corrections and page assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.functions import morph, strings
from lexispark.functions.fold import first_letter, unaccent_lower
from lexispark.operators import dictionary, fuzzy, listing, lookup, publish, segment
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


_REFS = "SELECT id AS entry_id, unnest(range(1, len(r) + 1)) AS n, unnest(r) AS raw_ref FROM (SELECT id, regexp_extract_all(definicao, '\\(([^()]+)\\)', 1) AS r FROM entry WHERE definicao IS NOT NULL)"
_LEVEL = "nullif(regexp_replace(lower(trim({0})), '^conf:\\s*', ''), '')"


@query(f"WITH k AS (SELECT min(entry_id) AS k FROM ({_REFS})) SELECT e.id, e.morfologia, coalesce((SELECT string_agg(raw_ref, '; ' ORDER BY n) FROM ({_REFS}) r WHERE r.entry_id = e.id), '') AS refs FROM entry e JOIN k ON k.k = e.id")
def entry_by_id(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "entry")
    refs = dictionary.examples(e, "id", "definicao")
    k = refs.agg(F.min("entry_id")).first()[0]
    r = listing.entry_with_children(e, "id", k, refs, "entry_id", "n", ["raw_ref"])
    return r.select("id", "morfologia", F.array_join(F.transform("children", lambda x: x["raw_ref"]), "; ").alias("refs"))


@query("""SELECT e.entry_id, e.conf FROM v2_entry e JOIN (SELECT min(source_id) AS source_id FROM dict_source WHERE name = 'retificado') s ON s.source_id = e.source_id WHERE e.lemma_sort = (SELECT min(lemma_sort) FROM v2_entry WHERE source_id = s.source_id)""")
def entry_by_lemma_and_source(spark: SparkSession, d: str) -> DataFrame:
    e, s = load(spark, d, "v2_entry"), load(spark, d, "dict_source")
    mine = s.where("name = 'retificado'").agg(F.min("source_id").alias("source_id"))
    word = e.join(mine, "source_id").agg(F.min("lemma_sort")).first()[0]
    return listing.of_source(e, "lemma_sort", word, s.join(mine, "source_id"), "source_id", "name", "retificado").select("entry_id", "conf")


@query(f"SELECT entry_id, lemma_sort FROM v2_entry WHERE {_LEVEL.format('conf')} = 'high' ORDER BY entry_id LIMIT 200")
def entries_of_rating(spark: SparkSession, d: str) -> DataFrame:
    return listing.rated(load(spark, d, "v2_entry"), "conf", "high", "entry_id", 200).select("entry_id", "lemma_sort")


@query("SELECT entry_id FROM v2_entry WHERE contains(lower(conf), 'low') OR needs_review = 1")
def suspects(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "v2_entry").where(F.contains(F.lower("conf"), F.lit("low")) | (F.col("needs_review") == 1)).select("entry_id")


@query("SELECT entry_id FROM v2_entry WHERE coalesce(trim(definicao), '') = ''")
def untranslated(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "v2_entry").where(F.trim(F.coalesce("definicao", F.lit(""))) == "").select("entry_id")


@query("SELECT entry_id FROM v2_entry WHERE morph_render LIKE 's. fem%' AND starts_with(lemma, 'c')")
def labels_like(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "v2_entry").where(F.col("morph_render").like("s. fem%") & F.startswith("lemma", F.lit("c"))).select("entry_id")


@query("SELECT DISTINCT name AS dicionario, lemma_sort AS label FROM v2_entry JOIN dict_source USING (source_id) WHERE lemma_sort IS NOT NULL ORDER BY 1, 2 LIMIT 300")
def dictionary_labels(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").join(load(spark, d, "dict_source").select("source_id", F.col("name").alias("dicionario")), "source_id")
    return e.where("lemma_sort IS NOT NULL").select("dicionario", F.col("lemma_sort").alias("label")).distinct().orderBy("dicionario", "label").limit(300)


@query("SELECT entry_id, lemma FROM v2_entry WHERE lemma IS NOT NULL ORDER BY translate(lemma, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), entry_id LIMIT 150")
def nocase_order(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "v2_entry").where("lemma IS NOT NULL").orderBy(listing.nocase(F.col("lemma")), "entry_id").limit(150).select("entry_id", "lemma")


@query(f"SELECT entry_id FROM v2_entry WHERE {_LEVEL.format('conf')} = 'high' ORDER BY md5(entry_id::VARCHAR || ':7'), entry_id LIMIT 100")
def high_sample(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").where(listing.conf_level(F.col("conf")) == "high")
    return listing.random_sample(e, "entry_id", 100, 7).select("entry_id")


@query("SELECT form_id FROM v2_form WHERE lower(form) IN ('gunlis', 'tircanus') OR lower(kind) IN ('orth', 'variant')")
def forms_in_list(spark: SparkSession, d: str) -> DataFrame:
    f = load(spark, d, "v2_form")
    return f.where(listing.any_of(F.col("form"), ["Gunlis", "TIRCANUS"]) | listing.any_of(F.col("kind"), ["ORTH", "Variant"])).select("form_id")


@query("SELECT id FROM entry WHERE contains(lower(definicao), 'navio') OR contains(lower(notas), 'navio')")
def substring_search(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "entry").where(listing.in_fields(["definicao", "notas"], "NAVIO")).select("id")


@query("SELECT DISTINCT id FROM ls_entries WHERE contains(lower(strip_accents(definition)), '\"gloss\"')")
def quoted_terms(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "ls_entries").where(listing.quoted_term(F.col("definition"), "Glóss", '"')).select("id").distinct()


@query("SELECT id, entry_id FROM lemma WHERE lower(forma) = (SELECT lower(min(forma)) FROM lemma) OR starts_with(lower(forma), (SELECT lower(min(forma)) FROM lemma) || ',')")
def exact_or_listed(spark: SparkSession, d: str) -> DataFrame:
    x = load(spark, d, "lemma")
    return x.where(listing.exact_or_listed(F.col("forma"), x.agg(F.min("forma")).first()[0] or "")).select("id", "entry_id")


_TIERS = """w AS (SELECT DISTINCT id, lemma AS w FROM ls_entries WHERE lemma IS NOT NULL),
e AS (SELECT lemma_sort, lemma, needs_review, morph_out_of_vocab, entry_id FROM v2_entry),
t AS (SELECT w.id, 0 AS tier, needs_review, morph_out_of_vocab, entry_id FROM w JOIN e ON e.lemma_sort = w.w UNION ALL SELECT w.id, 1, needs_review, morph_out_of_vocab, entry_id FROM w JOIN e ON e.lemma = w.w
UNION ALL SELECT w.id, 2, needs_review, morph_out_of_vocab, entry_id FROM w JOIN e ON starts_with(e.lemma_sort, w.w) AND length(w.w) >= 3)"""


@query(f"WITH {_TIERS}, r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tier, needs_review, morph_out_of_vocab, entry_id) AS k FROM t) SELECT id, tier, entry_id FROM r WHERE k = 1")
def best_definition_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Best entry of every headword of the second dictionary: equal sort key, equal headword, then as a prefix."""
    b = listing.best_with_prefixes(load(spark, d, "ls_entries").select("id", "lemma"), "id", "lemma", load(spark, d, "v2_entry"), ["lemma_sort", "lemma"], "lemma_sort", ["needs_review", "morph_out_of_vocab", "entry_id"])
    return b.select("id", "tier", "entry_id")


@query("""WITH k AS (SELECT DISTINCT form_norm FROM v2_form WHERE form_norm <> '' ORDER BY 1 LIMIT 5) SELECT f.form_id, e.entry_id, e.lemma FROM v2_form f JOIN k ON k.form_norm = f.form_norm JOIN v2_entry e ON e.entry_id = f.entry_id ORDER BY e.entry_id, f.form, f.form_id LIMIT 50""")
def forms_of_keys(spark: SparkSession, d: str) -> DataFrame:
    f = load(spark, d, "v2_form")
    keys = [r[0] for r in f.where("form_norm <> ''").select("form_norm").distinct().orderBy("form_norm").limit(5).collect()]
    hits = listing.form_hits(f.select("form_id", "entry_id", "form", "form_norm").orderBy("form_id"), load(spark, d, "v2_entry").select("entry_id", "lemma"), "entry_id", "form_norm", "form", keys, 1 << 30)
    return hits.orderBy("entry_id", "form", "form_id").limit(50).select("form_id", "entry_id", "lemma")


@query("""WITH j AS (SELECT DISTINCT lower(strip_accents(coalesce(nullif(f.form_norm, ''), f.form, e.lemma))) AS form_key, e.entry_id FROM v2_entry e LEFT JOIN v2_form f ON f.entry_id = e.entry_id)
SELECT form_key, count(*) AS n_entries, CASE WHEN count(*) = 1 THEN min(entry_id) END AS only FROM j WHERE form_key <> '' GROUP BY 1""")
def form_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return listing.vocabulary(load(spark, d, "v2_entry"), load(spark, d, "v2_form"), "entry_id", "lemma", "form_norm", "form")


@query("SELECT DISTINCT page_num, md5(extracted_text) AS body FROM ocr_page WHERE doc_name = (SELECT min(doc_name) FROM ocr_page) AND page_num >= 5")
def pages_from(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "ocr_page")
    first = p.agg(F.min("doc_name")).first()[0]
    return p.where((F.col("doc_name") == first) & (F.col("page_num") >= 5)).select("page_num", F.md5("extracted_text").alias("body")).distinct()


@query("""WITH p AS (SELECT doc_name, page_num, min(extracted_text) AS t FROM ocr_page WHERE extracted_text IS NOT NULL AND page_num IS NOT NULL GROUP BY 1, 2) SELECT doc_name, md5(string_agg(t, E'\\n\\n' ORDER BY page_num)) AS body, count(*) AS pages FROM p GROUP BY 1""")
def assembled_documents(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "ocr_page")
    n = p.where("extracted_text IS NOT NULL AND page_num IS NOT NULL").groupBy("doc_name").agg(F.count_distinct("page_num").alias("pages"))
    return listing.assembled(p, "doc_name", "page_num", "extracted_text").join(n, "doc_name").select("doc_name", F.md5("body").alias("body"), "pages")


@query("SELECT DISTINCT lemma FROM (SELECT lemma_sort AS lemma FROM v2_entry UNION ALL SELECT lemma FROM ls_entries UNION ALL SELECT forma FROM lemma) WHERE lemma IS NOT NULL")
def all_headwords(spark: SparkSession, d: str) -> DataFrame:
    return listing.headword_union([load(spark, d, "v2_entry").select("lemma_sort"), load(spark, d, "ls_entries").select("lemma"), load(spark, d, "lemma").select("forma")])


@query("""WITH n AS (SELECT id, doc_name, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS c FROM entry), a AS (SELECT *, least(999999, greatest(1, ceil(c / 40.0)))::INTEGER AS page FROM n) SELECT id, doc_name, rn, page FROM a WHERE rn BETWEEN (page - 1) * 40 + 1 AND page * 40""")
def last_page(spark: SparkSession, d: str) -> DataFrame:
    """A page beyond the last is the last."""
    return listing.result_page(load(spark, d, "entry").select("id", "doc_name"), ["id"], 999_999, 40, F.col("doc_name")).select("id", "doc_name", "rn", "page")


@query("""SELECT facet, value, count(*) AS n FROM (SELECT unnest(['volume_id', 'morph_render', 'pos', 'first_letter', 'conf', 'needs_review', 'page_bucket']) AS facet,
unnest([split_part(id, ':', 1), morph_render, upper(trim(pos)), coalesce(nullif(upper(substr(strip_accents(trim(lemma)), 1, 1)), ''), '#'), nullif(regexp_replace(lower(trim(conf)), '^conf:\\s*', ''), ''), needs_review::VARCHAR,
floor(coalesce(CASE WHEN regexp_matches(split_part(id, ':', 2), '^[0-9]+$') THEN split_part(id, ':', 2)::INTEGER END, 0) / 100)::INTEGER::VARCHAR]) AS value FROM v2_entry) WHERE value IS NOT NULL GROUP BY 1, 2""")
def all_facets(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("morph_render", F.upper(F.trim("pos")).alias("pos"), "needs_review", listing.conf_level(F.col("conf")).alias("conf"), first_letter(F.col("lemma")).alias("first_letter"), strings.chunk_and_page(F.col("id")).alias("at"))
    e = e.select("*", F.col("at.doc_name").alias("volume_id"), strings.page_bucket(F.col("at.page_num")).alias("page_bucket"))
    return publish.facet_counts(e, ["volume_id", "morph_render", "pos", "first_letter", "conf", "needs_review", "page_bucket"])


_BUCKET = "CASE WHEN lower({0}) LIKE 'v%' THEN 'VERB' WHEN lower({0}) LIKE 'adv%' THEN 'ADV' WHEN lower({0}) LIKE 'adj%' THEN 'ADJ' WHEN lower({0}) LIKE 's.%' OR lower({0}) LIKE 'n%' THEN 'NOUN' END"


@query(f"""WITH a AS (SELECT lower(strip_accents(lemma_sort)) AS k, entry_id, {_BUCKET.format('morph_render')} AS pos FROM v2_entry), b AS (SELECT lower(strip_accents(lemma)) AS k, id, {_BUCKET.format('pos')} AS pos FROM (SELECT DISTINCT id, lemma, pos FROM ls_entries)),
c AS (SELECT lower(strip_accents(forma)) AS k, l.id, {_BUCKET.format('morfologia')} AS pos FROM lemma l LEFT JOIN entry e ON e.id = l.entry_id),
ua AS (SELECT k, min(entry_id) AS entry_id, min(pos) AS pos FROM a WHERE k IS NOT NULL GROUP BY k HAVING count(*) = 1), ub AS (SELECT k, min(pos) AS pos FROM b WHERE k IS NOT NULL GROUP BY k HAVING count(*) = 1), uc AS (SELECT k, min(pos) AS pos FROM c WHERE k IS NOT NULL GROUP BY k HAVING count(*) = 1)
SELECT ua.k, ua.entry_id FROM ua JOIN ub ON ub.k = ua.k JOIN uc ON uc.k = ua.k WHERE (ua.pos IS NULL OR ub.pos IS NULL OR ua.pos = ub.pos) AND (ua.pos IS NULL OR uc.pos IS NULL OR ua.pos = uc.pos)""")
def three_way_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Headwords of three dictionaries, each once in every one, whose word classes agree where known."""

    def bucket(c):
        x = F.lower(c)
        return F.when(x.startswith("v"), "VERB").when(x.startswith("adv"), "ADV").when(x.startswith("adj"), "ADJ").when(x.startswith("s.") | x.startswith("n"), "NOUN")

    part = lambda df, word, label, *more: df.select(unaccent_lower(F.col(word)).alias("k"), *more, bucket(F.col(label)).alias("pos"))
    a = part(load(spark, d, "v2_entry"), "lemma_sort", "morph_render", "entry_id")
    b = part(load(spark, d, "ls_entries").select("id", "lemma", "pos").distinct(), "lemma", "pos")
    c = part(load(spark, d, "lemma").join(load(spark, d, "entry").select(F.col("id").alias("entry_id"), "morfologia"), "entry_id", "left"), "forma", "morfologia")
    return lookup.three_way_consensus([lookup.unique_rows(x, "k") for x in (a, b, c)], "k", ["pos"]).select("k", "entry_id")


@query("""SELECT entry_id, CASE WHEN h THEN upper(lemma) ELSE lemma END AS lemma, CASE WHEN h AND coalesce(lower(trim(conf)), '') NOT IN ('high', 'conf:high') THEN 'conf:med' ELSE conf END AS conf,
CASE WHEN NOT h THEN notas WHEN coalesce(notas, '') = '' THEN n ELSE notas || ' | ' || n END AS notas FROM (SELECT *, entry_id % 9 = 0 AND lemma IS NOT NULL AS h, '[ocr_fix 2024-01-01T00:00:00Z] caixa | lemma_in=''' || lemma || ''' → ''' || upper(lemma) || '''' AS n FROM v2_entry)""")
def ocr_fixes(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", "lemma", "conf", "notas")
    fixes = e.where("entry_id % 9 = 0 AND lemma IS NOT NULL").select("entry_id", F.upper("lemma").alias("new_lemma"), F.lit("caixa").alias("reason"), F.lit("conf:med").alias("conf"))
    return listing.ocr_fix(e, fixes, "entry_id", "2024-01-01T00:00:00Z")


@query("SELECT entry_id, CASE WHEN entry_id % 10 = 3 THEN 1 ELSE needs_review END AS needs_review FROM v2_entry")
def marked_for_review(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").select("entry_id", "needs_review")
    return listing.mark_review(e, e.where("entry_id % 10 = 3"), "entry_id")


_CASED = "CASE WHEN lemma = upper(lemma) AND lemma <> lower(lemma) THEN upper(neu) WHEN lemma = lower(lemma) THEN lower(neu) WHEN substr(lemma, 1, 1) = upper(substr(lemma, 1, 1)) AND substr(lemma, 1, 1) <> lower(substr(lemma, 1, 1)) THEN upper(substr(neu, 1, 1)) || substr(neu, 2) ELSE neu END"


@query(f"""WITH s AS (SELECT lemma_sort AS sid, count(*) AS n FROM v2_entry WHERE lemma_sort IS NOT NULL AND lemma IS NOT NULL GROUP BY 1), t AS (SELECT s.sid, s.n, e.entry_id, e.lemma, e.conf, CASE WHEN s.n % 2 = 0 THEN e.lemma_sort ELSE e.lemma_sort || 'x' END AS neu,
  regexp_matches(trim(e.lemma), '^\\p{{Lu}}') OR coalesce(regexp_matches(lower(e.morph_render), 'propn|próp|prop\\.'), FALSE) AS proper FROM v2_entry e JOIN s ON s.sid = e.lemma_sort WHERE e.lemma IS NOT NULL),
r AS (SELECT *, n > 1 AND proper AND regexp_replace(lower(strip_accents(lemma)), '[^a-z]', '', 'g') <> regexp_replace(lower(strip_accents(neu)), '[^a-z]', '', 'g') AS review FROM t)
SELECT entry_id, CASE WHEN review THEN 'REVIEW' ELSE 'UPDATE' END AS status, CASE WHEN NOT review THEN {_CASED} END AS new_lemma, CASE WHEN NOT review THEN conf END AS conf_set FROM r""")
def suggestion_updates(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").where("lemma_sort IS NOT NULL AND lemma IS NOT NULL")
    n = e.groupBy("lemma_sort").agg(F.count("*").alias("n"))
    taken = e.join(n, "lemma_sort").select(F.col("lemma_sort").alias("suggestion_id"), "entry_id", F.col("lemma_sort").alias("lemma_in"), F.when(F.col("n") % 2 == 0, F.col("lemma_sort")).otherwise(F.concat("lemma_sort", F.lit("x"))).alias("new_lemma"), F.lit("").alias("reason"), F.lit("med").alias("conf"), F.lit(False).alias("by_id"))
    u = listing.suggestion_updates(taken, e.select("entry_id", "lemma", F.col("morph_render").alias("label"), "conf"), "2024-01-01T00:00:00Z")
    return u.select("entry_id", "status", "new_lemma", F.get_json_object("payload", "$.conf_set").alias("conf_set"))


@query("""SELECT entry_id, CASE WHEN a <> 'UNK' AND b <> 'UNK' AND a <> b AND c = 'high' THEN 'med' ELSE c END AS conf, CASE WHEN a <> 'UNK' AND b <> 'UNK' AND a <> b AND c = 'high' THEN 'vector; conflito morfológico (LS vs entrada)' ELSE 'vector' END AS reason
FROM (SELECT entry_id, CASE WHEN morph_render LIKE 's.%' THEN 'NOUN' WHEN morph_render LIKE 'v.%' THEN 'VERB' WHEN morph_render LIKE 'adv%' THEN 'ADV' WHEN morph_render LIKE 'adj%' THEN 'ADJ' ELSE 'UNK' END AS a, CASE WHEN entry_id % 2 = 0 THEN 'NOUN' ELSE 'UNK' END AS b, CASE WHEN entry_id % 3 = 0 THEN 'high' ELSE 'low' END AS c FROM v2_entry)""")
def morph_guard(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry")
    own = morph.pos_bucket(F.col("morph_render"))
    g = fuzzy.morph_guard(F.when(F.col("entry_id") % 3 == 0, "high").otherwise("low"), F.lit("vector"), F.when(F.col("entry_id") % 2 == 0, "NOUN").otherwise("UNK"), own)
    return e.select("entry_id", g.alias("g")).select("entry_id", "g.conf", "g.reason")


@query("""WITH w AS (SELECT entry_id, regexp_split_to_array(lower(trim(morph_render)), '[,\\s]+') AS w FROM v2_entry WHERE morph_render IS NOT NULL),
k AS (SELECT entry_id, w, list_position(list_transform(w, lambda x: list_contains(['abl.', 'abs.', 'absl.', 'abrev.', 'acus.', 'adj.', 'adv.', 'cf.', 'comp.', 'conj.', 'dat.', 'dem.', 'dep.', 'dim.', 'distrib.', 'f.', 'freq.', 'fut.', 'gen.', 'impf.', 'impess.', 'indecl.', 'inf.', 'interj.', 'interr.', 'intr.', 'loc.', 'm.', 'n.', 'nom.', 'num.', 'ord.', 'part.', 'perf.', 'pass.', 'pes.', 'pl.', 'prep.', 'prés.', 'pr.', 'pron.', 'prev.', 'reflex.', 'sg.', 'sent.', 'sinc.', 'subs.', 'subj.', 'superl.', 'tr.', 'v.', 'voc.'], x)), FALSE) AS stop FROM w)
SELECT entry_id, array_to_string(CASE WHEN coalesce(stop, 0) = 0 THEN w ELSE w[1:stop - 1] END, ' ') AS run FROM k""")
def abbreviation_runs(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").where("morph_render IS NOT NULL")
    return e.select("entry_id", F.array_join(segment.abbreviation_run(F.col("morph_render")), " ").alias("run"))


@query("""WITH b AS (SELECT entry_id, trim(regexp_replace(regexp_replace(trim(head_raw), '^\\d+\\.\\s*', ''), '\\s+—\\s+.*$', '')) AS b FROM v2_entry WHERE head_raw IS NOT NULL),
w AS (SELECT entry_id, b, list_filter(list_transform(string_split(b, ','), lambda x: trim(x)), lambda x: x <> '') AS w FROM b)
SELECT entry_id, CASE WHEN len(w) > 1 AND len(list_filter(w, lambda x: NOT regexp_full_match(x, '[a-z]{1,30}'))) = 0 THEN array_to_string(w, '|') ELSE b END AS heads FROM w""")
def headword_lists(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "v2_entry").where("head_raw IS NOT NULL")
    return e.select("entry_id", F.array_join(segment.headword_list(F.col("head_raw")), "|").alias("heads"))


@query()
def simple_entries(spark: SparkSession, d: str) -> DataFrame:
    """Entries read off the scanned pages line by line."""
    p = load(spark, d, "ocr_page").select("doc_name", "page_num", "extracted_text").distinct()
    return p.select("doc_name", "page_num", F.posexplode(segment.simple_entries(F.col("extracted_text"))).alias("at", "x")).select("doc_name", "page_num", "at", "x.*")


@query()
def page_headwords(spark: SparkSession, d: str) -> DataFrame:
    """Headwords the article pages speak of, certain or close to known ones."""
    pages = load(spark, d, "ocr_page").where("page_num IS NOT NULL").groupBy("doc_name", "page_num").agg(F.min("extracted_text").alias("t"))
    chunks = pages.select(F.concat_ws(":", "doc_name", "page_num").alias("k"), "t")
    return segment.chunk_headwords(chunks, "k", "t", load(spark, d, "lemma").select("forma"))


@query("SELECT id, regexp_replace(forma, '[āēīōūȳăĕĭŏŭĀĒĪŌŪȲĂĔĬŎŬ]', '', 'g') AS bare, regexp_replace(lower(strip_accents(forma)), '[^\\x00-\\x7F]', '', 'g') AS plain FROM lemma WHERE forma IS NOT NULL AND NOT regexp_matches(lower(forma), '[æœßøþðłıđħŧ…—–’‘“”«»]')")
def unmarked_forms(spark: SparkSession, d: str) -> DataFrame:
    x = load(spark, d, "lemma").where(F.col("forma").isNotNull() & ~F.lower("forma").rlike("[æœßøþðłıđħŧ…—–’‘“”«»]"))
    return x.select("id", listing.delete_vowel_marks(F.col("forma")).alias("bare"), listing.transliterated(F.col("forma")).alias("plain"))


@query("SELECT e.id, coalesce(string_agg(l.forma, ' / ' ORDER BY l.id), '') AS lemas FROM entry e LEFT JOIN lemma l ON l.entry_id = e.id GROUP BY e.id ORDER BY e.id LIMIT 10")
def first_entries(spark: SparkSession, d: str) -> DataFrame:
    from lexispark.operators.search import entry_source

    return entry_source(load(spark, d, "entry"), load(spark, d, "lemma")).orderBy("id").limit(10).select("id", "lemas")


@query("""WITH c AS (SELECT count(*) AS n, count_if(lower(trim(conf)) = 'high') AS h, count_if(lower(trim(conf)) = 'med') AS m, count_if(lower(trim(conf)) = 'low') AS l FROM v2_entry)
SELECT unnest([-5, -4, -3, -2, -1])::BIGINT AS rn, unnest(['# Retificado', '**Total de entradas:** ' || n, '**Confiança:** high ' || h || ', med ' || m || ', low ' || l, '**Exportado em:** 2024-01-01', '---']) AS text FROM c""")
def export_header(spark: SparkSession, d: str) -> DataFrame:
    return publish.export_header(load(spark, d, "v2_entry"), "Retificado", F.lower(F.trim("conf")), "2024-01-01")


@query("""WITH s AS (SELECT lemma_sort AS lemma, 0 AS i, '- *retificado*: ' || array_to_string(list_sort(list(DISTINCT coalesce(definicao, ''))), ' / ') AS line FROM v2_entry WHERE lemma_sort IS NOT NULL GROUP BY 1
UNION ALL SELECT lemma, 1, '- *ls*: ' || array_to_string(list_sort(list(DISTINCT coalesce(definition, ''))), ' / ') FROM ls_entries WHERE lemma IS NOT NULL GROUP BY 1),
g AS (SELECT lemma, '**' || lemma || E'**\\n' || string_agg(line, E'\\n' ORDER BY i) AS text FROM s GROUP BY 1) SELECT row_number() OVER (ORDER BY lower(lemma), lemma) AS rn, text FROM g""".replace("\\\\", "\\"))
def unified_export(spark: SparkSession, d: str) -> DataFrame:
    a = load(spark, d, "v2_entry").select(F.col("lemma_sort").alias("lemma"), F.col("definicao").alias("body"))
    return publish.unified({"retificado": a, "ls": load(spark, d, "ls_entries").select("lemma", F.col("definition").alias("body"))})


QUERIES, ORACLE = Q, SQL
