from pyspark.sql import functions as F

from lexispark.llm.scanned import PageText, hash_differences, noise, repaired, text_value

WORDS = ["navio", "inverno", "colheita", "guarda", "chuva", "tesouro", "perante", "o", "do", "da", "sem", "de"]


def texts(spark, pages, entries=()):
    p = spark.createDataFrame(pages, "doc_name string, page_num int, raw_text string, kind string, word string")
    e = spark.createDataFrame(list(entries), "id bigint, page_num int, raw_text string")
    return [PageText(p, "ocr_page", F.concat_ws(":", "doc_name", "page_num"), "raw_text", F.col("page_num"), F.col("doc_name"), True), PageText(e, "entry", F.col("id").cast("string"), "raw_text", F.col("page_num"), F.lit(None).cast("string"), False)]


def language(spark):
    return spark.createDataFrame([(" ".join(WORDS),)] * 30, "gloss string")


BODY = "\n".join(["o navio do inverno sem guarda-chuva perante o tesouro da colheita"] * 30)


def found(spark, pages, entries=()):
    return {(r.tab, r.rec_key, r.line_no, r.kind) for r in noise(texts(spark, [*pages, ("base", 1, BODY, "", "")], entries), language(spark), "gloss").collect()}


def test_furniture_hyphens_and_misread_words(spark):
    page = "NAVIRA — 7 — NAVIUS\n\no navio sem o inver-\nno do teso¬ \nuro sem guarda-\nchuva da colhei\nta, o invemo do nayio lertomus fornix\n— 7 —"
    got = found(spark, [("d", 7, page, "", "")])
    assert got == {("ocr_page", "d:7", 1, "header"), ("ocr_page", "d:7", 3, "hyphen"), ("ocr_page", "d:7", 4, "hyphen"), ("ocr_page", "d:7", 6, "hyphen"), ("ocr_page", "d:7", 7, "misread"), ("ocr_page", "d:7", 8, "pagenum")}


def test_break_goes_on_past_furniture_and_pages(spark):
    got = found(spark, [("d", 1, "o navio sem te-\n1", "", ""), ("d", 2, "LÉXICO DA LÍNGUA LATlNA\nsouro da colheita", "", "")], [(5, 1, "o inver-\np. 1\nNAVIRA  2  NAVIUS\nno da colheita\n9")])
    assert ("ocr_page", "d:1", 1, "hyphen") in got and ("entry", "5", 1, "hyphen") in got
    assert {x for x in got if x[3] == "misread"} == set()
    assert ("entry", "5", 2, "pagenum") in got and ("entry", "5", 3, "header") in got


def test_other_numbers_and_capitals_in_articles_stay(spark):
    got = found(spark, [("d", 7, "8\nNAVIRA, -ae, s. fem. navio\n12).\nUM DO\no navio", "", "")])
    assert got == set()


def test_nulls_empty_repeated_and_no_language(spark):
    pages = [("d", 1, None, "", ""), ("d", 2, "", "", ""), ("d", None, "T", None, None), ("d", 3, "T\no nayio", "", ""), ("d", 3, "T\no nayio", "", "")]
    got = found(spark, pages, [(None, 1, "T"), (1, None, "3\no navio")])
    assert got == {("ocr_page", "d", 1, "header"), ("ocr_page", "d:3", 1, "header"), ("ocr_page", "d:3", 2, "misread"), ("entry", "1", 1, "pagenum")}
    none = noise(texts(spark, pages), language(spark).limit(0), "gloss")
    assert {r.kind for r in none.collect()} == {"header"}
    assert noise(texts(spark, []), language(spark), "gloss").count() == 0


def test_repaired_text_is_continuous(spark):
    page = "NAVIRA — 7 — NAVIUS\no navio sem o inver-\nno, perante o nayio.\n\nsem guarda-\nchuva\n— 7 —"
    got = {(r.tab, r.rec_key): r.text for r in repaired(texts(spark, [("d", 7, page, "", ""), ("base", 1, BODY, "", "")]), language(spark), "gloss").collect()}
    assert got["ocr_page", "d:7"] == "o navio sem o inverno, perante o navio.\n\nsem guarda-chuva"


def test_hash_differences_cover_single_and_double_confusions():
    value = text_value
    known = dict(hash_differences())
    assert value("c") - value("e") in known
    assert value("c") - value("e") + value("rn") - value("m") in known


def test_edge_lines_that_come_back_are_furniture(spark):
    """A head in small letters and a foot are known by their place and by coming back; the same words inside pages stay."""
    pages = [("d", i, f"o tesouro perante\no navio sem inverno\no tesouro perante\nda chuva do navio\nguarda sem número {i}", "", "") for i in range(1, 5)]
    got = {x for x in found(spark, pages) if x[3] == "header"}
    assert got == {("ocr_page", f"d:{i}", n, "header") for i in range(1, 5) for n in (1, 5)} | {x for x in got if x[2] in (2, 4)}
    few = {x for x in found(spark, [("e", 1, "o tesouro perante\no navio\nda chuva do navio\nsem", "", ""), ("e", 2, "o tesouro perante\nda chuva\no navio\nperante", "", "")]) if x[3] == "header"}
    assert few == set()


def test_page_numbers_far_into_an_article(spark):
    text = "\n".join(["o navio do inverno"] * 150 + ["40"] + ["sem o tesouro"])
    assert ("entry", "5", 151, "pagenum") in found(spark, [], [(5, 7, text)])
    assert ("entry", "5", 2, "pagenum") not in found(spark, [], [(5, 7, "o navio\n40\no navio")])


def test_signs_the_language_does_not_have(spark):
    """A sign that no known confusion names is found where the rest of the word fits."""
    got = found(spark, [("d", 7, "o tes¢uro sem inv€rno\no navi0 da colh£ita", "", "")])
    assert {x[2] for x in got if x[3] == "misread"} == {1, 2}
    assert {x for x in found(spark, [("d", 7, "o x€z sem a€b", "", "")]) if x[3] == "misread"} == set()
