"""Writers: CSV and JSON exports, ordered dumps, NDJSON shards with index, blocks with lookup, batch requests, reports."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.operators import publish
from lexispark.operators.vector import unit
from lexispark.operators.windows import numbered
from lexispark.session import write_text


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with sorted columns, nulls as empty text."""
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(df.columns)]).write.mode("overwrite").option("header", True).option("sep", sep).option("quoteAll", False).csv(path)


def export_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def ordered_dump(df: DataFrame, key: str, path: str) -> None:
    """JSON lines in key order over range partitions: the files in name order hold the rows in order."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def json_document(df: DataFrame, kind: str, path: str, stamp: str | None = None, key: str | None = None) -> None:
    """One JSON document ``{"metadata": {tipo, exportado_em, total_entradas}, "entradas": [...]}`` in a folder of parts.

    The entries are ordered by ``key`` over range partitions; the parts in name order, put together, are the document.
    """
    spark = df.sparkSession
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"), *([F.col(key).alias("__k")] if key else [F.lit(0).alias("__k")]))
    ordered = numbered(rows.withColumn("__v", F.col("value")), ["__k", "__v"]).select("value", "rn")
    body = ordered.select("rn", F.concat(F.when(F.col("rn") > 1, F.lit(",")).otherwise(F.lit("")), "value").alias("value"))
    body.repartitionByRange("rn").sortWithinPartitions("rn").select("value").write.mode("overwrite").text(f"{path}/part-1-entradas")
    meta = {"tipo": kind, "exportado_em": stamp or datetime.now(UTC).isoformat(timespec="seconds"), "total_entradas": df.count()}
    write_text(spark, f"{path}/part-0-metadata", '{"metadata": ' + json.dumps(meta, ensure_ascii=False) + ', "entradas": [\n')
    write_text(spark, f"{path}/part-2-end", "]}\n")


def export_entry(df: DataFrame, path: str, form: str = "json", nested: str = "exemplos") -> None:
    """One entry as JSON, or as CSV without its nested column."""
    if form == "json":
        export_json_lines(df, path)
    else:
        export_csv(df.drop(nested), path)


def backup(spark: SparkSession, path: str, folder: str, stamp: str | None = None) -> str:
    """A copy of a table under its name and a time, made before changes are applied; its path."""
    name = f"{path.rstrip('/').rsplit('/', 1)[-1].split('.')[0]}.{stamp or datetime.now(UTC).strftime('%Y%m%d-%H%M%S')}.parquet"
    spark.read.parquet(path).write.mode("error").parquet(f"{folder}/{name}")
    return f"{folder}/{name}"


def write_vectors(df: DataFrame, key: str, vector: str, folder: str) -> None:
    """Vector index: unit vectors and all other columns, ordered by key, with the place of every row (its vector id)."""
    rows = numbered(df.where(F.col(vector).isNotNull()), [key]).withColumn("vector_id", F.col("rn") - 1).drop("rn")
    rows.withColumn(vector, unit(F.col(vector))).repartitionByRange("vector_id").sortWithinPartitions("vector_id").write.mode("overwrite").parquet(folder)


def write_shards(df: DataFrame, order: list[str], key: str, page: str, folder: str, size: int = 1000) -> None:
    """NDJSON shards partitioned by shard number, and index.json with one row a shard."""
    sharded = publish.shards(df, order, size)
    sharded.drop("ordinal", "idx").repartition("shard").write.mode("overwrite").partitionBy("shard").option("ignoreNullFields", False).json(f"{folder}/rows")
    index = [r.asDict() for r in publish.shard_index(sharded, key, page).orderBy("shard").toLocalIterator()]
    total = {"shard_size": size, "total_records": sum(r["count"] for r in index), "page_min": min((r["page_min"] for r in index if r["page_min"] is not None), default=None), "page_max": max((r["page_max"] for r in index if r["page_max"] is not None), default=None)}
    write_text(df.sparkSession, f"{folder}/index.json", json.dumps({**total, "shards": [{**r, "file": f"rows/shard={r['shard']}"} for r in index]}, ensure_ascii=False))


def write_blocks(df: DataFrame, order: list[str], key: str, folder: str, size: int = 500) -> None:
    """Blocks of rows, their index, and a lookup from key to block and place."""
    b = publish.shards(df, order, size)
    b.drop("ordinal").repartition("shard").write.mode("overwrite").partitionBy("shard").json(f"{folder}/blocks")
    publish.block_index(b).write.mode("overwrite").json(f"{folder}/index")
    publish.lookup(b, key).write.mode("overwrite").json(f"{folder}/lookup")


def write_markdown(lines: DataFrame, path: str) -> None:
    """Rendered lines (rn, text) in order over range partitions."""
    lines.repartitionByRange("rn").sortWithinPartitions("rn").select("text").write.mode("overwrite").option("lineSep", "\n\n").text(path)


def write_requests(groups: DataFrame, group: str, payload: list[str], path: str, prefix: str = "dedupe::") -> None:
    """One JSON request per group: custom_id and the rows of the group ordered by their first column."""
    rows = groups.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*payload))).alias("items"))
    rows.select(F.to_json(F.struct(F.concat(F.lit(prefix), F.col(group)).alias("custom_id"), F.col("items"))).alias("value")).write.mode("overwrite").text(path)


def insert_or_ignore(target: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``target`` plus the new keys; of a key that comes twice the first by ``order`` counts."""
    first = new.groupBy(key).agg(F.min_by(F.struct(*[c for c in new.columns if c not in (key, order)]), order).alias("__r")).select(key, "__r.*")
    return target.unionByName(first.join(target.select(key), key, "left_anti").select(*target.columns))


def write_search_index(df: DataFrame, folder: str, text: list[str], filters: dict, key: str = "id") -> None:
    """Static search index: postings bucketed by the first letter of the term, and one row of filter values per document.

    ``filters`` maps filter names to columns; null values are left out of the filters.
    """
    from lexispark.operators.search import postings

    p = postings(df, key, text).withColumn("initial", F.substring("term", 1, 1))
    p.repartition("initial", F.pmod(F.xxhash64("term"), F.lit(8))).sortWithinPartitions("term", "doc").write.mode("overwrite").partitionBy("initial").parquet(f"{folder}/postings")
    df.select(F.col(key), *[c.alias(n) for n, c in filters.items()]).write.mode("overwrite").json(f"{folder}/filters")


def write_volumes(volumes: DataFrame, path: str) -> None:
    """Catalog of published volumes (volume_id, title, page_min, page_max), ordered by id; a few rows."""
    rows = [r.asDict() for r in volumes.orderBy("volume_id").toLocalIterator()]
    write_text(volumes.sparkSession, path, json.dumps(rows, ensure_ascii=False))
