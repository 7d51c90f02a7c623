"""Queries of the general training-data problems: nested records, dead references, hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.operators.hierarchy import conflicting_links, descendants, hierarchy, resolve
from lexispark.operators.nested import TreeSpec, flatten_tree
from lexispark.operators.references import Reference, orphan_report, orphans
from lexispark.session import load

ARTICLE_TREE = TreeSpec(("sentidos",), ("sentidos", "subsentidos", "sub"), ("exemplos", "ex"))
LEXICON_TREE = TreeSpec(("sense",), ("sense",), ("cit",))


def _nodes(spark: SparkSession, sf_dir: str, bodies: bool) -> DataFrame:
    entries = flatten_tree(load(spark, sf_dir, "v2_entry"), "entry_id", "raw_json", ARTICLE_TREE, bodies)
    # rows of ls_entries may be delivered twice, identical in every column
    lexicon = load(spark, sf_dir, "ls_entries").where(F.col("definition").rlike(r'^\s*[\{\["`]')).select("id", "definition").distinct()
    other = flatten_tree(lexicon, "id", "definition", LEXICON_TREE, bodies)
    return entries.withColumn("tab", F.lit("v2_entry")).unionByName(other.withColumn("tab", F.lit("ls_entries")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir, False).select("tab", "rec_key", "node_kind", "node_path")


def p2_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat tables: gloss of senses, quotation of examples, linked to the node above and to the record."""
    n = _nodes(spark, sf_dir, True)
    is_text = F.col("body").startswith('"')
    text = F.get(F.from_json(F.concat(F.lit("["), F.col("body"), F.lit("]")), "array<string>"), 0)
    pick = lambda *names: F.coalesce(*[F.get_json_object("body", f"$.{x}") for x in names])
    said = F.when(is_text, text).when(F.col("node_kind") == "sense", pick("glosa", "definicao", "def", "gloss")).otherwise(pick("lat", "quote"))
    return n.select("tab", "rec_key", "node_kind", "node_path", "parent_path", "depth", "position", F.when(~is_text, pick("n")).alias("label"), said.alias("text"), F.when(~is_text, pick("trad")).alias("translation"))


def _references(spark: SparkSession, sf_dir: str) -> list[Reference]:
    t = lambda name: load(spark, sf_dir, name)
    gone = t("deleted_key")
    month = lambda c: F.date_format(F.col(c), "yyyy-MM")
    return [
        Reference("lemma", t("lemma"), "id", "entry_id", t("entry"), "id", F.col("imported_at"), F.col("created_at"), None, gone.where("tab = 'entry'"), month("imported_at")),
        Reference("v2_sense", t("v2_sense"), "sense_id", "parent_id", t("v2_sense"), "sense_id", F.col("imported_at"), F.col("imported_at"), None, gone.where("tab = 'v2_sense'"), month("imported_at")),
        Reference("v2_entry", t("v2_entry"), "entry_id", "source_id", t("dict_source"), "source_id", None, None, F.col("removed_at").isNotNull(), None, F.substring("updated_at", 1, 7)),
    ]


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second, third = (orphans(r) for r in _references(spark, sf_dir))
    return first.unionByName(second).unionByName(third)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("tab", "row_id", "kind")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken references per table, kind and month of import (or of the last update)."""
    return orphan_report(_orphans(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = resolve(load(spark, sf_dir, "v2_sense"), "sense_id", "parent_id")
    return r.select(F.col("id").alias("sense_id"), "root_id", "depth")


def p6_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full path, depth, root and number of descendants of every sense."""
    h = hierarchy(load(spark, sf_dir, "v2_sense"), "sense_id", "parent_id")
    return h.withColumnRenamed("id", "sense_id")


def p6_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sense with each sense below it and the number of steps between them."""
    return descendants(load(spark, sf_dir, "v2_sense"), "sense_id", "parent_id").withColumnRenamed("id", "sense_id")


def p6_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senses delivered with several different parents, and which of them holds."""
    return conflicting_links(load(spark, sf_dir, "v2_sense"), "sense_id", "parent_id").withColumnRenamed("id", "sense_id")


QUERIES = {"p2_found": p2_found, "p2_rows": p2_rows, "p5_found": p5_found, "p5_report": p5_report, "p6_found": p6_found, "p6_hierarchy": p6_hierarchy, "p6_below": p6_below, "p6_conflicts": p6_conflicts}

_BROKEN = """
WITH c AS (
  SELECT 'lemma' AS tab, l.id AS row_id, l.imported_at AS t, strftime(l.imported_at, '%Y-%m') AS period, l.entry_id AS k, e.id AS pk, e.created_at AS pt, FALSE AS removed, d.key_id AS gone
  FROM lemma l LEFT JOIN entry e ON e.id = l.entry_id LEFT JOIN deleted_key d ON d.tab = 'entry' AND d.key_id = l.entry_id
  UNION ALL
  SELECT 'v2_sense', s.sense_id, s.imported_at, strftime(s.imported_at, '%Y-%m'), s.parent_id, p.sense_id, p.imported_at, FALSE, d.key_id
  FROM (SELECT DISTINCT sense_id, parent_id, imported_at FROM v2_sense) s LEFT JOIN (SELECT DISTINCT sense_id, imported_at FROM v2_sense) p ON p.sense_id = s.parent_id
  LEFT JOIN deleted_key d ON d.tab = 'v2_sense' AND d.key_id = s.parent_id
  UNION ALL
  SELECT 'v2_entry', v.entry_id, NULL, substr(v.updated_at, 1, 7), v.source_id, q.source_id, NULL, q.removed_at IS NOT NULL, NULL
  FROM v2_entry v LEFT JOIN dict_source q ON q.source_id = v.source_id),
k AS (
  SELECT tab, row_id, period, CASE WHEN pk IS NULL AND gone IS NOT NULL THEN 'deleted' WHEN pk IS NULL THEN 'missing' WHEN removed THEN 'deleted' WHEN pt > t THEN 'late' END AS kind
  FROM c WHERE k IS NOT NULL)
"""

# JSON documents out of code fences and JSON strings, then one recursive step per level of nesting
_NODES = """
WITH RECURSIVE w AS (
  SELECT 'v2_entry' AS tab, entry_id::VARCHAR AS rec_key, trim(regexp_replace(regexp_replace(raw_json, '^\\s*```[a-zA-Z]*\\s*', ''), '\\s*```\\s*$', '')) AS t FROM v2_entry
  UNION SELECT 'ls_entries', id, trim(definition) FROM ls_entries WHERE definition LIKE '{%' OR definition LIKE '[%'),
p AS (SELECT tab, rec_key, CASE WHEN json_valid(t) AND json_type(t::JSON) = 'VARCHAR' THEN json_extract_string(t::JSON, '$') ELSE t END AS t FROM w),
d AS (SELECT tab, rec_key, t::JSON AS j FROM p WHERE json_valid(t)),
r AS (SELECT tab, rec_key, unnest(CASE json_type(j) WHEN 'ARRAY' THEN j::JSON[] WHEN 'OBJECT' THEN [j] ELSE [] END) AS j FROM d),
lists AS (SELECT tab, rec_key, json_extract(j, CASE tab WHEN 'v2_entry' THEN '$.sentidos' ELSE '$.sense' END) AS a FROM r),
many AS (SELECT tab, rec_key, CASE json_type(a) WHEN 'ARRAY' THEN a::JSON[] WHEN 'OBJECT' THEN [a] WHEN 'VARCHAR' THEN CASE WHEN a::VARCHAR = '""' THEN [] ELSE [a] END ELSE [] END AS a FROM lists),
s(tab, rec_key, path, j) AS (
  SELECT tab, rec_key, i::VARCHAR, a[i] FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM many)
  UNION ALL
  SELECT tab, rec_key, path || '.' || i, a[i] FROM (SELECT tab, rec_key, path, a, unnest(range(1, len(a) + 1)) AS i FROM (
    SELECT s.tab, s.rec_key, s.path, CASE json_type(x) WHEN 'ARRAY' THEN x::JSON[] WHEN 'OBJECT' THEN [x] WHEN 'VARCHAR' THEN CASE WHEN x::VARCHAR = '""' THEN [] ELSE [x] END ELSE [] END AS a
    FROM (SELECT tab, rec_key, path, unnest([json_extract(j, '$.sentidos'), json_extract(j, '$.subsentidos'), json_extract(j, '$.sub'), json_extract(j, '$.sense')]) AS x FROM s WHERE json_type(j) = 'OBJECT') s))),
e AS (SELECT tab, rec_key, path, CASE json_type(x) WHEN 'ARRAY' THEN x::JSON[] WHEN 'OBJECT' THEN [x] WHEN 'VARCHAR' THEN CASE WHEN x::VARCHAR = '""' THEN [] ELSE [x] END ELSE [] END AS a
  FROM (SELECT tab, rec_key, path, unnest([json_extract(j, '$.exemplos'), json_extract(j, '$.ex'), json_extract(j, '$.cit')]) AS x FROM s WHERE json_type(j) = 'OBJECT'))
"""
_NODE_LIST = """SELECT tab, rec_key, 'sense' AS node_kind, path AS node_path FROM s
UNION ALL SELECT tab, rec_key, 'example', path || '#' || i FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM e)"""
_NODE_ROWS = """, n AS (SELECT tab, rec_key, 'sense' AS node_kind, path AS node_path, CASE WHEN contains(path, '.') THEN regexp_replace(path, '\\.[0-9]+$', '') END AS parent_path, len(string_split(path, '.'))::INTEGER AS depth, string_split(path, '.')[-1]::INTEGER AS position, j FROM s
UNION ALL SELECT tab, rec_key, 'example', path || '#' || i, path, len(string_split(path, '.'))::INTEGER, i::INTEGER, a[i] FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM e)),
o AS (SELECT *, json_type(j) = 'OBJECT' AS obj, CASE WHEN json_type(j) = 'VARCHAR' THEN json_extract_string(j, '$') END AS said FROM n)
SELECT tab, rec_key, node_kind, node_path, parent_path, depth, position, CASE WHEN obj THEN json_extract_string(j, '$.n') END AS label,
CASE WHEN NOT obj THEN said WHEN node_kind = 'sense' THEN coalesce(json_extract_string(j, '$.glosa'), json_extract_string(j, '$.definicao'), json_extract_string(j, '$.def'), json_extract_string(j, '$.gloss')) ELSE coalesce(json_extract_string(j, '$.lat'), json_extract_string(j, '$.quote')) END AS text,
CASE WHEN obj THEN json_extract_string(j, '$.trad') END AS translation FROM o"""

_TREES = """
WITH RECURSIVE n AS (SELECT DISTINCT sense_id, parent_id FROM v2_sense), top AS (SELECT n.sense_id FROM n LEFT JOIN n p ON p.sense_id = n.parent_id WHERE p.sense_id IS NULL),
t(sense_id, root_id, depth, path) AS (
  SELECT sense_id, sense_id, 1, sense_id::VARCHAR FROM top
  UNION ALL SELECT n.sense_id, t.root_id, t.depth + 1, t.path || '/' || n.sense_id FROM t JOIN n ON n.parent_id = t.sense_id),
c AS (SELECT n.* FROM n ANTI JOIN t ON t.sense_id = n.sense_id),
r(s, x) AS (SELECT sense_id, parent_id FROM c UNION SELECT r.s, c.parent_id FROM r JOIN c ON c.sense_id = r.x),
l AS (SELECT r.s, min(r.x) AS root_id FROM r JOIN r o ON o.s = r.x AND o.x = r.x GROUP BY r.s),
f AS (SELECT sense_id, root_id, depth, path FROM t UNION ALL SELECT s, root_id, -1, NULL FROM l)
"""

ORACLE = {
    "p2_found": _NODES + _NODE_LIST,
    "p2_rows": _NODES + _NODE_ROWS,
    "p6_found": _TREES + "SELECT sense_id, root_id, depth FROM f",
    "p6_hierarchy": _TREES + """, b AS (SELECT a.sense_id, count(*) AS n FROM t a JOIN t d ON starts_with(d.path, a.path || '/') AND a.root_id = d.root_id GROUP BY 1)
SELECT f.sense_id, f.root_id, f.depth, f.path, CASE WHEN f.depth > 0 THEN coalesce(b.n, 0) END AS n_below FROM f LEFT JOIN b ON b.sense_id = f.sense_id""",
    "p6_below": _TREES + """, o AS (SELECT DISTINCT s FROM r WHERE s = x),
u(sense_id, descendant, distance) AS (
  SELECT p.sense_id, n.sense_id, 1 FROM n JOIN n p ON p.sense_id = n.parent_id ANTI JOIN o ON o.s = n.sense_id
  UNION ALL SELECT p.sense_id, u.descendant, u.distance + 1 FROM u JOIN n m ON m.sense_id = u.sense_id JOIN n p ON p.sense_id = m.parent_id ANTI JOIN o ON o.s = u.sense_id)
SELECT sense_id, descendant, distance FROM u""",
    "p6_conflicts": """SELECT DISTINCT sense_id, parent_id AS parent, parent_id = m AS used FROM (SELECT sense_id, parent_id, min(parent_id) OVER w AS m, max(parent_id) OVER w AS x FROM v2_sense WHERE parent_id IS NOT NULL WINDOW w AS (PARTITION BY sense_id)) WHERE m < x""",
    "p5_found": _BROKEN + "SELECT DISTINCT tab, row_id, kind FROM k WHERE kind IS NOT NULL",
    "p5_report": _BROKEN + "SELECT tab, period, kind, COUNT(*) AS n_rows FROM (SELECT DISTINCT tab, row_id, period, kind FROM k WHERE kind IS NOT NULL) GROUP BY tab, period, kind",
}
