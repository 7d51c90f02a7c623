"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm.leak import leaked_items
from lexispark.llm.matching import matches
from lexispark.llm.mixing import Mix
from lexispark.llm.scanned import PageText, noise, repaired
from lexispark.llm.survivor import survivors, surviving_records
from lexispark.llm.truncation import truncated, truncation_report
from lexispark.llm.visual import DASHES, LOOKALIKES, consistent_texts, inconsistent_rows
from lexispark.session import load


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(load(spark, sf_dir, "v2_entry")).select("group_id", "definicao_from", "conf_from")


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of every duplicated article."""
    return surviving_records(load(spark, sf_dir, "v2_entry"))


def _page_texts(spark: SparkSession, sf_dir: str) -> list[PageText]:
    pages, entries = load(spark, sf_dir, "ocr_page"), load(spark, sf_dir, "entry")
    page_key = F.concat_ws(":", "doc_name", "page_num")
    page = [PageText(pages, "ocr_page", page_key, field, F.col("page_num"), F.col("doc_name"), True) for field in ("raw_text", "extracted_text")]
    return [*page, PageText(entries, "entry", F.col("id").cast("string"), "raw_text", F.col("page_num"), F.col("doc_name"), False)]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noise(_page_texts(spark, sf_dir), load(spark, sf_dir, "v2_sense"), "gloss")


def p3_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and articles as continuous, readable paragraphs."""
    return repaired(_page_texts(spark, sf_dir), load(spark, sf_dir, "v2_sense"), "gloss")


def _form_arrays(spark: SparkSession, sf_dir: str):
    yield load(spark, sf_dir, "v2_entry"), "entry_id", F.array("lemma"), "v2_entry"
    yield load(spark, sf_dir, "v2_form"), "form_id", F.array("form"), "v2_form"
    yield load(spark, sf_dir, "ls_entries"), "id", F.from_json("orths", "array<string>"), "ls_entries"


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inconsistent_rows(*_form_arrays(spark, sf_dir))


def p4_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct form that is not in the consistent spelling, with the spelling it gets."""
    texts = [df.select(F.explode(a).alias("text")) for df, _, a, _ in _form_arrays(spark, sf_dir)]
    return consistent_texts(texts[0].unionByName(texts[1]).unionByName(texts[2]))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_matches(spark, sf_dir).select("entry_id", "ls_id")


def p7_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched articles of the two dictionaries with score and calibrated confidence."""
    return matches(load(spark, sf_dir, "v2_entry"), load(spark, sf_dir, "ls_entries"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_item")).select("doc_id", "item_id")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test item: in how many documents it leaks, and how much of it at most."""
    found = leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_item"))
    per_item = found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("share").alias("largest_share"))
    items = load(spark, sf_dir, "eval_item").select("item_id", "task").distinct()
    return items.join(per_item, "item_id", "left").select("item_id", "task", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "largest_share")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mix with their number of copies."""
    return Mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_target")).copies()


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every source."""
    return Mix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_target")).report()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(load(spark, sf_dir, "documents")).where("cut").select(F.col("id").alias("doc_id")).distinct()


def p10_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of cut texts per source, with the evidence that found them."""
    return truncation_report(truncated(load(spark, sf_dir, "documents")))


QUERIES = {
    "p1_found": p1_found, "p1_records": p1_records, "p3_found": p3_found, "p3_texts": p3_texts, "p4_found": p4_found, "p4_spellings": p4_spellings,
    "p7_found": p7_found, "p7_matches": p7_matches, "p8_found": p8_found, "p8_leaks": p8_leaks, "p9_mix": p9_mix, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_report": p10_report,
}


def _consistent_sql(text: str) -> str:
    wide = "".join(chr(x) for x in range(0xFF01, 0xFF5F))
    plain = "".join(chr(x - 0xFEE0) for x in range(0xFF01, 0xFF5F)).replace("'", "''")
    letters, latin = "".join(LOOKALIKES), "".join(LOOKALIKES.values())
    x = f"regexp_replace({text}, '[\\p{{Cf}}]', '', 'g')"
    x = f"translate({x}, '{wide}{DASHES}', '{plain}{'-' * len(DASHES)}')"
    x = f"replace(replace({x}, 'ﬁ', 'fi'), 'ﬂ', 'fl')"
    x = f"trim(regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g'))"
    word = f"CASE WHEN regexp_matches(w, '^[\\p{{Greek}}\\p{{Mn}}]*\\p{{Greek}}[\\p{{Greek}}\\p{{Mn}}]+$') THEN w ELSE translate(w, '{letters}', '{latin}') END"
    return f"nfc_normalize(array_to_string(list_transform(string_split({x}, ' '), lambda w: {word}), ' '))"


_FORMS = """t AS (SELECT 'v2_entry' AS tab, entry_id::VARCHAR AS rec_key, lemma AS x FROM v2_entry UNION ALL SELECT 'v2_form', form_id::VARCHAR, form FROM v2_form
UNION ALL SELECT 'ls_entries', id, unnest(CAST(json(orths) AS VARCHAR[])) FROM ls_entries)"""
ORACLE = {
    "p4_found": f"WITH {_FORMS} SELECT DISTINCT tab, rec_key FROM t WHERE x IS NOT NULL AND x <> {_consistent_sql('x')}",
    "p4_spellings": f"WITH {_FORMS}, c AS (SELECT DISTINCT x AS text, {_consistent_sql('x')} AS consistent FROM t WHERE x IS NOT NULL) SELECT text, consistent FROM c WHERE text <> consistent",
}
