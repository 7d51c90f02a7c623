import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from lexispark.operators import segment
from lexispark.sources import readers, writers


def test_json_lines_keep_rejects(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1, "b": "x"}\n\nnot json\n{"a": 2}\n')
    good, bad = readers.json_lines(spark, str(p), "a int, b string")
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, "x"), (2, None)]
    assert [r.line for r in bad.collect()] == ["not json"]


def test_text_readers(spark, tmp_path):
    (tmp_path / "d.csv").write_text("id ; lemma\n 1;a b\n2; c \n")
    assert [tuple(r) for r in readers.delimited(spark, str(tmp_path / "d.csv")).collect()] == [("1", "a b"), ("2", "c")]
    (tmp_path / "s.tsv").write_text("1\tnavis\tx\ty\nnauta\tctx\nrex\n")
    assert [tuple(r) for r in readers.suspects(spark, str(tmp_path / "s.tsv")).collect()] == [("1", "navis", "x\ty"), (None, "nauta", "ctx"), (None, "rex", None)]


def test_triples(spark, tmp_path):
    (tmp_path / "t.nt").write_text('<http://x/Cardoso/n1> <http://p#label> "navis, a"@la .\n<http://x/y/n2> <http://w#type> <http://o/Entry> .\nbroken line\n')
    rows = {r.label: r for r in readers.triples(spark, str(tmp_path / "t.nt"), {"cardoso": "Cardoso"}).collect()}
    assert rows["n1"].dicionario == "Cardoso" and rows["n1"].campo == "label" and rows["n1"].valor.startswith("navis, a")
    assert rows["n2"].dicionario == "Outro" and rows["n2"].tipo == "Entry" and rows["n2"].valor is None


def test_tei(spark, tmp_path):
    (tmp_path / "e.xml").write_text('<r><entryFree id="n1"><orth>navis</orth><orth>navis</orth><itype>is</itype><pos>n</pos><sense>a <i>ship</i></sense><sense>b</sense></entryFree></r>')
    r = readers.tei_entries(spark, str(tmp_path / "e.xml")).first()
    assert (r.id, r.orths, r.itypes, r.pos, r.definition) == ("n1", ["navis"], ["is"], "n", "a ship\nb")


def test_html_and_bytes(spark):
    r = spark.range(1).select(readers.html_grammar(F.lit('<b>x</b><span class="g">Subst. <i>f</i></span>')), readers.html_text(F.lit("<p>a&amp;b</p><script>z</script> c")), readers.decode_bytes(F.lit(bytearray(b"caf\xe9"))), readers.decode_bytes(F.lit(bytearray("é".encode())))).first()
    assert tuple(r) == ("Subst.  f", "a&b c", "café", "é")
    odd = [b"a\x93b\x94", b"x\x81\x93", b"\x80", b"plain"]
    got = spark.createDataFrame([(bytearray(b),) for b in odd], "b binary").select(readers.decode_bytes(F.col("b"))).collect()
    assert [r[0] for r in got] == ["a\u201cb\u201d", "x\x81\x93", "€", "plain"]


def test_sqlite_source(spark, tmp_path):
    path = str(tmp_path / "d.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE e (id INTEGER, lemma TEXT, w REAL)")
        db.executemany("INSERT INTO e VALUES (?, ?, ?)", [(i, f"l{i}", i / 2) for i in range(50)] + [(None, None, None)])
        db.execute("CREATE TABLE none (id INTEGER)")
    df = readers.sqlite_table(spark, path, "e")
    assert df.count() == 51 and df.agg(F.sum("w")).first()[0] == sum(i / 2 for i in range(50))
    assert readers.sqlite_table(spark, path, "none").count() == 0


def test_shards_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 7 if i % 5 else None, f"t{i}") for i in range(95)], "id int, page_num int, t string")
    writers.write_shards(df, ["id"], "id", "page_num", str(tmp_path / "s"), 20)
    index = json.loads((tmp_path / "s/index.json").read_text())
    assert index["total_records"] == 95 and len(index["shards"]) == 5 and index["page_max"] == 6
    back = spark.read.json(str(tmp_path / "s/rows"))
    assert back.count() == 95 and back.where("shard = 4").count() == 15


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(2, None), (1, "a")], "id int, b string")
    writers.export_csv(df, str(tmp_path / "c"))
    assert {tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "c")).select("b", "id").collect()} == {("a", "1"), (None, "2")}
    writers.write_requests(df, "id", ["b"], str(tmp_path / "r"))
    assert {json.loads(r.value)["custom_id"] for r in spark.read.text(str(tmp_path / "r")).collect()} == {"dedupe::1", "dedupe::2"}
    new = spark.createDataFrame([(1, "z", 0), (3, "second", 2), (3, "first", 1)], "id int, b string, pos int")
    assert {r.id: r.b for r in writers.insert_or_ignore(df, new, "id", "pos").collect()} == {1: "a", 2: None, 3: "first"}


def test_volumes_need_their_files(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps([{"doc_name": "d", "page_num": 1, "normalized_text": [{"lemas": ["a", " "], "exemplos": ["x", None]}]}]))
    df = readers.volumes(spark, [{"id": "v", "title": "V", "source_json": "v.json"}], str(tmp_path))
    t = segment.entries_to_tables(df)
    assert (t["entry"].count(), t["lemma"].count(), t["exemplo"].count()) == (1, 1, 1)
    with pytest.raises(FileNotFoundError):
        readers.volumes(spark, [{"id": "w", "source_json": "none.json"}], str(tmp_path))


def test_segmentation_in_chunks_equals_one_pass(spark):
    heads = ["abacus", "abdo", "acer", "bellum", "bonus", "caput", "casa", "dies", "domus", "equus", "zeta", "fama"]
    pages = [("d", i, f"ABACUS — {i} — FAMA\n{h}, -i, s. m. texto de {h} que se-\ngue aqui\nlinha solta {i}") for i, h in enumerate(heads)] + [("e", 1, None), (None, 1, "x"), ("f", 1, "só texto")]
    df = spark.createDataFrame([*pages, pages[0]], "doc string, page int, t string")
    known = spark.createDataFrame([(h,) for h in heads if h != "zeta"], "headword string")
    whole = {(r.doc, r.ordinal, r.entry) for r in segment.segment(df, "doc", "page", "t", known, chunk_pages=1000).collect()}
    for size in (1, 2, 5):
        assert {(r.doc, r.ordinal, r.entry) for r in segment.segment(df, "doc", "page", "t", known, chunk_pages=size).collect()} == whole
    first = {o: e for d, o, e in whole if d == "d"}
    assert first[1].startswith("abacus") and "segue" in first[1] and "linha solta 0" in first[1]
    assert not any(e.startswith("zeta") for e in first.values())


def test_page_functions(spark):
    f = lambda expr: spark.range(1).select(expr).first()[0]
    h = f(segment.running_head(F.lit("ABACUS — 12 — ACER\nx")))
    assert (h.first, h.page, h.last) == ("ABACUS", 12, "ACER")
    assert f(segment.running_head(F.lit("texto"))) is None
    assert f(segment.strip_head(F.lit("A\n——————————————\ntexto"))) == "texto"
    assert f(segment.cut_footnotes(F.lit("corpo\n(1) nota\np. 3\nfim (*) z"), ["(1)"])) == "corpo"
    assert f(segment.mend_lines(F.lit("na-\nvio (a\nb)\n2. c"))) == "navio (a b) 2. c"


def test_search_index_and_catalog(spark, tmp_path):
    df = spark.createDataFrame([(1, "navio rio", "a"), (2, "neve", None)], "id int, t string, conf string")
    writers.write_search_index(df, str(tmp_path / "i"), ["t"], {"conf": F.col("conf")})
    back = spark.read.parquet(str(tmp_path / "i/postings"))
    assert {(r.term, r.doc, r.initial) for r in back.collect()} == {("navio", 1, "n"), ("rio", 1, "r"), ("neve", 2, "n")}
    writers.write_volumes(spark.createDataFrame([("b", "B", 1, 2), ("a", "A", None, None)], "volume_id string, title string, page_min int, page_max int"), str(tmp_path / "v.json"))
    assert [v["volume_id"] for v in json.loads((tmp_path / "v.json").read_text())] == ["a", "b"]
