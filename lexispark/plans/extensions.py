"""Queries on the event and page tables: windows, sessions, segmentation, page heads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.operators import segment
from lexispark.session import load
from lexispark.streaming.events import session_counts, windowed_counts


def _events(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def events_hourly(spark: SparkSession, d: str) -> DataFrame:
    w = windowed_counts(_events(spark, d))
    return w.select(F.unix_seconds("start").alias("start_s"), "event_type", "n", "total")


def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    return session_counts(_events(spark, d)).groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))


def page_heads(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "ocr_page").dropDuplicates(["doc_name", "page_num"])
    h = p.select("doc_name", "page_num", segment.running_head(F.col("raw_text")).alias("h")).where("h IS NOT NULL")
    return h.select("doc_name", "page_num", F.col("h.first").alias("first"), F.col("h.page").alias("page"), F.col("h.last").alias("last"))


def segment_pages(spark: SparkSession, d: str) -> DataFrame:
    known = load(spark, d, "lemma").select(F.col("forma").alias("headword"))
    return segment.segment(load(spark, d, "ocr_page").where("raw_text IS NOT NULL"), "doc_name", "page_num", "raw_text", known)


QUERIES = {"events_hourly": events_hourly, "events_sessions": events_sessions, "page_heads": page_heads, "segment_pages": segment_pages}
ORACLE = {
    "events_hourly": "SELECT epoch(date_trunc('hour', ts))::BIGINT AS start_s, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2",
    "events_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first FROM events)
SELECT user_id, sum(first)::BIGINT AS sessions, count(*) AS events FROM g GROUP BY user_id""",
    "page_heads": """SELECT doc_name, page_num, regexp_extract(l, '^(\\p{Lu}+) +[—–-] +(\\d+) +[—–-] +(\\p{Lu}+)$', 1) AS first, regexp_extract(l, '^(\\p{Lu}+) +[—–-] +(\\d+) +[—–-] +(\\p{Lu}+)$', 2)::INTEGER AS page, regexp_extract(l, '^(\\p{Lu}+) +[—–-] +(\\d+) +[—–-] +(\\p{Lu}+)$', 3) AS last
FROM (SELECT DISTINCT doc_name, page_num, trim(split_part(raw_text, chr(10), 1)) AS l FROM ocr_page) WHERE regexp_matches(l, '^(\\p{Lu}{2,}) +[—–-] +(\\d+) +[—–-] +(\\p{Lu}{2,})$')""",
}
