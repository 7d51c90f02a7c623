"""Readers: nested page JSON, shards, rejecting JSON lines, delimited text, N-Triples, TEI XML, SQLite files."""

from __future__ import annotations

import csv
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lexispark.session import path_exists, read_text

ITEM = "struct<lemas:array<string>,morfologia:string,morph_extra:array<string>,definicao:string,exemplos:array<string>,notas:string,conf:string,needs_review:int,redirect_only:int,morph_out_of_vocab:int,raw_json:string>"
PAGE_SCHEMA = f"doc_name string, page_num int, raw_text string, extracted_text string, normalized_text array<{ITEM}>"


def pages_json(spark: SparkSession, path: str) -> DataFrame:
    """Files holding one JSON array of pages with nested entries."""
    return spark.read.option("multiLine", True).schema(PAGE_SCHEMA).json(path)


def volumes(spark: SparkSession, catalog: list[dict], base: str) -> DataFrame:
    """Pages of all volumes of a catalog (id, title, source_json), with volume_id and title; a missing file is an error."""
    out = None
    for v in catalog:
        above = base.rstrip("/").rpartition("/")[0] or "."
        options = [f"{base}/{v['source_json']}", f"{above}/{v['source_json']}", v["source_json"]]
        found = next((p for p in options if path_exists(spark, p)), None)
        if found is None:
            raise FileNotFoundError(v["source_json"])
        part = pages_json(spark, found).withColumn("volume_id", F.lit(v["id"])).withColumn("title", F.lit(v.get("title")))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("the catalog is empty")
    return out


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a JSON lines file; blank lines are skipped, rejects keep the line."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.withColumn("r", F.from_json("value", T.StructType([*T._parse_datatype_string(schema).fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"}))
    good = F.col("r").isNotNull() & F.col("r._bad").isNull()
    return parsed.where(good).select("r.*").drop("_bad"), parsed.where(~good).select(F.col("value").alias("line"))


def shards(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of the shard files an index.json lists, in page, shard and line order.

    A row's place is the offset of its block in the file and its number among the rows read from there.
    """
    index = json.loads(read_text(spark, f"{folder}/index.json") or '{"shards": []}')
    files = [f"{folder}/{s['file']}" for s in index["shards"]]
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).json(files).select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__line"))
    return rows.orderBy("page_num", "__file", "__block", "__line").drop("__file", "__block", "__line")


def sniff_delimiter(path: str, options: str = ",;|\t") -> str:
    """Delimiter of a text file, judged by its first lines."""
    head = "\n".join(r[0] for r in SparkSession.active().read.text(path).limit(200).collect())[: 1 << 16]
    try:
        return csv.Sniffer().sniff(head, options).delimiter
    except csv.Error:
        return max(options, key=head.split("\n")[0].count)


def delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Delimited text with a header, all columns strings; names and values are trimmed."""
    df = spark.read.option("header", True).option("sep", sep or sniff_delimiter(path)).csv(path)
    return df.select(*[F.trim(F.col(f"`{c}`")).alias(c.strip()) for c in df.columns])


def suspects(spark: SparkSession, path: str) -> DataFrame:
    """Ragged lines: three or more fields give id, headword and context (the rest), two headword and context, one a headword."""
    parts = F.split("value", "\t", 3)
    n = F.size(parts)
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.when(n >= 3, parts[0]).alias("entry_id"), F.when(n >= 3, F.get(parts, F.lit(1))).otherwise(parts[0]).alias("lemma"), F.when(n >= 3, F.get(parts, F.lit(2))).when(n == 2, F.get(parts, F.lit(1))).alias("contexto"))


def triple_columns(line: Column) -> Column:
    """Parts of an N-Triples line: subject, predicate, literal (outer quotes removed) or uri; null unless it ends with a dot."""
    t = F.trim(line)
    pattern = r"^(\S+)\s+(\S+)\s+(.*?)\s*\.$"
    obj = F.regexp_extract(t, pattern, 3)
    strip = lambda c: F.regexp_replace(c, r"^<|>$", "")
    made = F.struct(strip(F.regexp_extract(t, pattern, 1)).alias("subject"), strip(F.regexp_extract(t, pattern, 2)).alias("predicate"), F.when(~obj.startswith("<"), F.regexp_replace(obj, r'^"|"$', "")).alias("literal"), F.when(obj.startswith("<"), strip(obj)).alias("uri"))
    return F.when(t.rlike(pattern), made)


def triples(spark: SparkSession, path: str, dictionaries: dict[str, str]) -> DataFrame:
    """N-Triples as (dicionario, sujeito_uri, tipo, label, campo, valor, outros_uris); the dictionary is the first whose
    key stands in the subject, else 'Outro'."""
    t = spark.read.text(path).select(triple_columns(F.col("value")).alias("t")).where("t IS NOT NULL").select("t.*")
    name = F.coalesce(*[F.when(F.contains(F.lower("subject"), F.lit(k.lower())), F.lit(v)) for k, v in dictionaries.items()], F.lit("Outro"))
    tail = lambda c: F.element_at(F.split(c, "[/#]"), -1)
    return t.select(name.alias("dicionario"), F.col("subject").alias("sujeito_uri"), F.when(tail(F.col("predicate")) == "type", tail(F.col("uri"))).alias("tipo"), tail(F.col("subject")).alias("label"), tail(F.col("predicate")).alias("campo"), F.col("literal").alias("valor"), F.col("uri").alias("outros_uris"))


def tei_entries(spark: SparkSession, path: str) -> DataFrame:
    """TEI dictionary entries: id, orths, itypes, pos, text of the senses without tags."""
    schema = "_id string, orth array<string>, itype array<string>, pos string, sense array<string>"
    x = spark.read.format("xml").option("rowTag", "entryFree").schema(schema).load(path)
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", ""), r"(?U)\s+", " "))
    empty = F.array().cast("array<string>")
    return x.select(F.col("_id").alias("id"), F.array_distinct(F.coalesce("orth", empty)).alias("orths"), F.array_distinct(F.coalesce("itype", empty)).alias("itypes"), "pos", F.array_join(F.transform(F.coalesce("sense", empty), plain), "\n").alias("definition"))


def html_grammar(c: Column) -> Column:
    """Text of the first grammar span of an HTML cell."""
    return F.trim(F.regexp_replace(F.regexp_extract(c, r'(?is)<span[^>]*class="g"[^>]*>(.*?)</span>', 1), r"<[^>]*>", " "))


def html_text(c: Column) -> Column:
    """All text of an HTML cell; scripts and styles are left out."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</\1>", " "), r"<[^>]*>", " ")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def decode_bytes(c: Column) -> Column:
    """UTF-8 where valid, else Windows-1252, else (bytes that it leaves undefined) Latin-1."""
    latin = F.decode(c, "ISO-8859-1")
    windows = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
    other = F.when(latin.rlike(r"[\x81\x8D\x8F\x90\x9D]"), latin).otherwise(F.translate(latin, "".join(windows), "".join(windows.values())))
    return F.when(F.is_valid_utf8(c.cast("string")), F.decode(c, "UTF-8")).otherwise(other)


class _Slice(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class _SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.parts, self.schema = options["path"], options["table"], int(options.get("partitions", "4")), schema

    def partitions(self):
        import sqlite3

        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            lo, hi = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if lo is None:
            return [_Slice(0, -1)]
        step = max(1, -(-(hi - lo + 1) // self.parts))
        return [_Slice(a, a + step - 1) for a in range(lo, hi + 1, step)]

    def read(self, part):
        import sqlite3

        names = ", ".join(f'"{f.name}"' for f in self.schema.fields)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            yield from db.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid BETWEEN ? AND ?', (part.lo, part.hi))


class SqliteSource(DataSource):
    """Read-only SQLite table as a Spark source: options path, table, partitions; rows are read by rowid ranges."""

    @classmethod
    def name(cls):
        return "sqlite_file"

    def schema(self):
        import sqlite3

        kinds = {"INTEGER": "bigint", "INT": "bigint", "REAL": "double", "BLOB": "binary"}
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            cols = db.execute(f'PRAGMA table_info("{self.options["table"]}")').fetchall()
        return ", ".join(f"`{c[1]}` {kinds.get((c[2] or 'TEXT').upper().split('(')[0], 'string')}" for c in cols)

    def reader(self, schema):
        return _SqliteReader(self.options, schema)


def sqlite_table(spark: SparkSession, path: str, table: str, partitions: int = 4) -> DataFrame:
    from lexispark.session import ship_package

    ship_package(spark)
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_file").option("path", path).option("table", table).option("partitions", str(partitions)).load()


def vector_index(spark: SparkSession, folder: str) -> DataFrame:
    """A stored vector index; ``vector_id`` is the place of a row."""
    return spark.read.parquet(folder)
