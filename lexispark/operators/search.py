"""Full-text search: query parser, boolean/prefix/phrase/NEAR matching, BM25, snippets, postings."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.functions.fold import fold
from lexispark.functions.strings import let
from lexispark.session import path_exists, shared_folder

K1, B = 1.2, 0.75


def tokens(c: Column) -> Column:
    """Lower-case accent-free tokens of letters and digits; null gives an empty array."""
    return F.filter(F.split(F.lower(fold(F.coalesce(c, F.lit("")))), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def plain(term: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", term.lower()) if unicodedata.category(c) != "Mn")


@dataclass
class Node:
    """Parsed query: op is phrase, near, and, or, not."""

    op: str
    words: list[str] = field(default_factory=list)
    prefix: bool = False
    initial: bool = False
    column: str | None = None
    distance: int = 10
    parts: list["Node"] = field(default_factory=list)
    member: int | None = None  # of a NEAR group: the word that is counted


TOKEN = re.compile(r'\s*(?:(NEAR)\s*(?:/(\d+))?\s*\(|(AND|OR|NOT)\b|("(?:[^"])*")|([()+:,^*])|([^\s()"+:,^*]+))')


class Parser:
    """Recursive descent: OR < AND (or mere sequence) < NOT; phrases, word*, ^word, column:, NEAR(a b, n)."""

    def __init__(self, text: str):
        self.items: list[tuple[str, str]] = []
        at = 0
        while at < len(text.rstrip()):
            m = TOKEN.match(text, at)
            if not m:
                raise ValueError(f"cannot read the query at {text[at:]!r}")
            at = m.end()
            if m[1]:
                self.items.append(("near", m[2] or ""))
            elif m[3]:
                self.items.append((m[3], m[3]))
            elif m[4] is not None:
                self.items.append(("text", m[4][1:-1]))
            elif m[5]:
                self.items.append((m[5], m[5]))
            else:
                self.items.append(("word", m[6]))
        self.at = 0

    def peek(self) -> str:
        return self.items[self.at][0] if self.at < len(self.items) else ""

    def take(self) -> str:
        self.at += 1
        return self.items[self.at - 1][1]

    def parse(self) -> Node:
        node = self.either()
        if self.peek():
            raise ValueError("unexpected " + self.peek())
        return node

    def either(self) -> Node:
        parts = [self.both()]
        while self.peek() == "OR":
            self.take()
            parts.append(self.both())
        return parts[0] if len(parts) == 1 else Node("or", parts=parts)

    def both(self) -> Node:
        node = self.unit()
        while self.peek() in ("AND", "NOT", "word", "text", "(", "near", "^"):
            kind = self.peek()
            if kind in ("AND", "NOT"):
                self.take()
                if kind == "AND" and self.peek() == "NOT":
                    self.take()
                    kind = "NOT"
            right = self.unit()
            node = Node("not", parts=[node, right]) if kind == "NOT" else Node("and", parts=[node, right])
        return node

    def unit(self) -> Node:
        kind = self.peek()
        if kind == "(":
            self.take()
            node = self.either()
            if self.peek() != ")":
                raise ValueError("missing )")
            self.take()
            return node
        if kind == "near":
            distance = self.take()
            words: list[str] = []
            while self.peek() in ("word", "text"):
                words += self.split(self.take())
            if self.peek() == ",":
                self.take()
                distance = self.take()
            if self.peek() != ")":
                raise ValueError("missing ) of NEAR")
            self.take()
            return Node("near", words=words, distance=int(distance or 10))
        initial = kind == "^"
        if initial:
            self.take()
            kind = self.peek()
        if kind not in ("word", "text"):
            raise ValueError("a term is missing")
        first = self.take()
        if self.peek() == ":" and kind == "word":
            self.take()
            node = self.unit()
            self.restrict(node, first)
            return node
        words = self.split(first)
        while self.peek() == "+":
            self.take()
            words += self.split(self.take())
        prefix = self.peek() == "*"
        if prefix:
            self.take()
        return Node("phrase", words=words, prefix=prefix, initial=initial)

    @staticmethod
    def split(text: str) -> list[str]:
        return [w for w in re.split(r"[^\w]+|_", plain(text)) if w]

    def restrict(self, node: Node, column: str) -> None:
        if node.op in ("phrase", "near"):
            node.column = column
        for p in node.parts:
            self.restrict(p, column)


def parse_query(text: str) -> Node:
    return Parser(text).parse()


def _starts(toks: Column, node: Node) -> Column:
    """Positions (from 0) at which a phrase begins."""
    words = node.words
    spots = F.sequence(F.lit(0), F.greatest(F.size(toks) - 1, F.lit(0)))

    def here(i: Column) -> Column:
        ok = F.lit(True)
        for k, w in enumerate(words):
            t = F.get(toks, i + k)
            ok = ok & F.coalesce(t.startswith(w) if node.prefix and k == len(words) - 1 else t == w, F.lit(False))
        return ok

    found = F.filter(spots, here)
    return F.filter(found, lambda i: i == 0) if node.initial else found


def occurrences(node: Node, columns: dict[str, Column]) -> Column:
    """How often a phrase or NEAR group occurs, summed over its columns."""
    use = {node.column: columns[node.column]} if node.column else columns
    total = F.lit(0)
    for toks in use.values():
        if node.op == "near":
            at = node.member or 0
            ok = _starts(toks, Node("phrase", words=[node.words[at]]))
            for w in node.words[:at] + node.words[at + 1 :]:
                ok = _beside(ok, _starts(toks, Node("phrase", words=[w])), node.distance)
            n = F.when(_all_there(toks, node.words), F.size(ok)).otherwise(0)
        elif len(node.words) == 1 and not node.prefix and not node.initial:
            n = F.size(F.filter(toks, lambda t: t == node.words[0]))
        else:
            n = F.when(_all_there(toks, node.words[:-1] if node.prefix else node.words), F.size(_starts(toks, node))).otherwise(0)
        total = total + n
    return total


def present(node: Node, columns: dict[str, Column]) -> Column:
    """Whether a row counts for a term's document frequency; a word of a NEAR group counts wherever it occurs."""
    if node.op == "near":
        return occurrences(Node("phrase", words=[node.words[node.member or 0]], column=node.column), columns) > 0
    return occurrences(node, columns) > 0


def _all_there(toks: Column, words: list[str]) -> Column:
    """Cheap test before positions are compared."""
    ok = F.lit(True)
    for w in words:
        ok = ok & F.array_contains(toks, w)
    return ok


def _beside(spots: Column, others: Column, distance: int) -> Column:
    """Positions with another position at most ``distance`` words between."""
    return F.filter(spots, lambda i: F.exists(others, lambda j: (F.abs(i - j) <= distance + 1) & (i != j)))


def matches(node: Node, columns: dict[str, Column]) -> Column:
    if node.op in ("phrase", "near"):
        if node.op == "phrase" and len(node.words) == 1 and not node.prefix and not node.initial:
            use = {node.column: columns[node.column]} if node.column else columns
            hit = F.lit(False)
            for toks in use.values():
                hit = hit | F.array_contains(toks, node.words[0])
            return hit
        return occurrences(node, columns) > 0
    first, *rest = [matches(p, columns) for p in node.parts]
    for r in rest:
        first = first | r if node.op == "or" else (first & ~r if node.op == "not" else first & r)
    return first


def leaves(node: Node, negated: bool = False) -> list[Node]:
    """Scored terms: phrases, and every word of a NEAR group on its own."""
    if negated:
        return []
    if node.op == "near":
        return [Node("near", words=node.words, column=node.column, distance=node.distance, member=i) for i in range(len(node.words))]
    if node.op == "phrase":
        return [node]
    return [x for i, p in enumerate(node.parts) for x in leaves(p, negated or (node.op == "not" and i > 0))]


def search(df: DataFrame, query: str, columns: list[str], keep: list[str]) -> DataFrame:
    """Rows that match, with their BM25 ``score`` (the smaller, the better), unordered and unlimited.

    A row's length is the number of its tokens over all columns; a phrase or prefix counts as one term, a NEAR group as
    one term per word.
    One aggregation gathers row count, mean length and document frequencies; it joins back as a single row.
    """
    node = parse_query(query)
    terms = leaves(node)

    def judge(row: Column) -> Column:
        toks = {c: row[f"t_{c}"] for c in columns}
        size = sum((F.size(t) for t in toks.values()), F.lit(0))
        return F.struct(size.alias("__size"), matches(node, toks).alias("__hit"), *[occurrences(t, toks).alias(f"__f{i}") for i, t in enumerate(terms)], *[present(t, toks).alias(f"__c{i}") for i, t in enumerate(terms)])

    # tokens are made once a row, however often the query mentions them
    counted = df.select(*keep, let(F.struct(*[tokens(F.col(c)).alias(f"t_{c}") for c in columns]), judge).alias("__j")).select(*keep, "__j.*")
    stats = counted.agg(F.count("*").alias("__n"), F.avg("__size").alias("__avg"), *[F.count_if(F.col(f"__c{i}")).alias(f"__d{i}") for i in range(len(terms))])
    return counted.where("__hit").crossJoin(F.broadcast(stats)).select(*keep, bm25(len(terms)).alias("score"))


def bm25(n_terms: int) -> Column:
    """Score out of __f (uses), __d (rows with the term), __size, __n and __avg; negative, the smaller the better."""
    score = F.lit(0.0)
    for i in range(n_terms):
        n, f = F.col(f"__d{i}"), F.col(f"__f{i}").cast("double")
        idf = F.log((F.col("__n") - n + 0.5) / (n + 0.5))
        idf = F.when(idf <= 0, F.lit(1e-6)).otherwise(idf)
        score = score - idf * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("__size") / F.col("__avg")))
    return F.round(score, 6)


def snippet(text: Column, words: list[str], size: int = 12, start: str = "[", end: str = "]") -> Column:
    """``size`` words round the first hit, hits marked; without a hit the first words."""
    raw = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: x != "")
    hits = F.array(*[F.lit(plain(w)) for w in words])
    pairs = F.transform(raw, lambda x: F.struct(x.alias("r"), F.regexp_replace(F.lower(fold(x)), r"[^\p{L}\p{N}]+", "").alias("f")))

    def show(p: Column) -> Column:
        folded = F.transform(p, lambda x: x["f"])
        n = F.size(p)
        first = F.coalesce(F.array_min(F.filter(F.transform(hits, lambda h: F.array_position(folded, h).cast("int")), lambda i: i > 0)), F.lit(1))
        begin = F.greatest(F.lit(1), F.least(first - size // 2, n - size + 1))
        part = F.transform(F.slice(p, begin, F.lit(size)), lambda x: F.when(F.array_contains(hits, x["f"]), F.concat(F.lit(start), x["r"], F.lit(end))).otherwise(x["r"]))
        return F.concat(F.when(begin > 1, F.lit("…")).otherwise(F.lit("")), F.array_join(part, " "), F.when(begin + size <= n, F.lit("…")).otherwise(F.lit("")))

    return let(pairs, show)


def postings(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Inverted index rows ``(term, doc, col, pos)``; ``write_index`` stores them to serve queries."""
    parts = [df.select(F.col(key).alias("doc"), F.lit(c).alias("col"), F.posexplode(tokens(F.col(c))).alias("pos", "term")) for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("term", "doc", "col", "pos")


@dataclass(frozen=True)
class Index:
    """A stored index: postings in order of their terms, and one row with the number of rows and their mean length."""

    postings: DataFrame
    stats: DataFrame
    columns: tuple[str, ...]


def write_index(df: DataFrame, key: str, columns: list[str], folder: str) -> None:
    """Write the index of ``columns`` to ``folder``: postings ``(term, doc, col, pos, size)`` and statistics.

    Postings are range partitioned and sorted by term and row, so a term's rows lie together (those of a frequent term in
    several files), and the smallest and largest term of every file and row group keep queries from reading others. Rows
    with a null key are not indexed; a key delivered twice is indexed twice.
    """
    spread, rows = _index_rows(df, key, columns)
    _store_index(spread, rows, folder)


def _index_rows(df: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    row = df.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), *[tokens(F.col(c)).alias(c) for c in columns])
    sized = row.withColumn("size", sum((F.size(c) for c in columns), F.lit(0)))
    parts = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("terms")) for c in columns])
    spread = sized.select("doc", "size", F.explode(parts).alias("p")).select("doc", "size", "p.col", F.posexplode("p.terms").alias("pos", "term"))
    return spread.select("term", "doc", "col", "pos", "size"), sized.select("doc", "size")


def _store_index(spread: DataFrame, rows: DataFrame, folder: str) -> None:
    spread.repartitionByRange("term", "doc").sortWithinPartitions("term", "doc").write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/postings")
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/rows")
    stored = rows.sparkSession.read.parquet(f"{folder}/rows")
    stored.agg(F.count("*").alias("n_rows"), F.avg("size").alias("mean_size")).write.mode("overwrite").parquet(f"{folder}/stats")


def update_index(spark: SparkSession, folder: str, changed: DataFrame, deleted: DataFrame, key: str, columns: list[str], target: str) -> None:
    """A new version of the index in ``folder``, written to ``target``: rows of ``changed`` are inserted or replace those
    with their key, keys of ``deleted`` (one column) are gone. The old version stays readable meanwhile."""
    gone = changed.select(F.col(key).alias("doc")).unionByName(deleted.toDF("doc")).where("doc IS NOT NULL").distinct()
    spread, rows = _index_rows(changed, key, columns)
    kept = lambda name: spark.read.parquet(f"{folder}/{name}").join(gone, "doc", "left_anti")
    _store_index(kept("postings").select("term", "doc", "col", "pos", "size").unionByName(spread), kept("rows").select("doc", "size").unionByName(rows), target)


def open_index(spark: SparkSession, folder: str, columns: list[str]) -> Index:
    return Index(spark.read.parquet(f"{folder}/postings"), spark.read.parquet(f"{folder}/stats"), tuple(columns))


_OPEN: dict[tuple, str] = {}


def index_of(df: DataFrame, key: str, columns: list[str], name: str) -> Index:
    """The index of a table under ``name``, written to the shared folder when it is first asked for in a session."""
    spark = df.sparkSession
    at = (spark.sparkContext.applicationId, name, key, *columns)
    if at not in _OPEN or not path_exists(spark, f"{_OPEN[at]}/stats"):
        folder = shared_folder(spark)
        write_index(df, key, columns, folder)
        _OPEN[at] = folder
    return open_index(spark, _OPEN[at], columns)


def _spots_of(found: Column, word: int, column: str) -> Column:
    return F.transform(F.filter(found, lambda x: (x["w"] == word) & (x["col"] == column)), lambda x: x["pos"])


def _earlier(spots: Column, k: int) -> Column:
    return F.transform(spots, lambda i: i - k)


def search_index(index: Index, query: str) -> DataFrame:
    """Rows ``(doc, score)`` that match, with their BM25 score (the smaller, the better), unordered and unlimited.

    Only the postings of the query's words are read (words of a prefix by their range). They are gathered per row, and
    phrases and NEAR groups are judged by their places. The scores are those of ``search`` over the whole table.
    """
    node = parse_query(query)
    terms = leaves(node)
    words: list[tuple[str, bool]] = []

    def gather(n: Node) -> None:
        for k, w in enumerate(n.words):
            spec = (w, n.prefix and k == len(n.words) - 1)
            if spec not in words:
                words.append(spec)
        for p in n.parts:
            gather(p)

    gather(node)
    if not words:
        raise ValueError("the query has no word")
    test = lambda w, prefix: F.startswith("term", F.lit(w)) if prefix else F.col("term") == w
    wanted = test(*words[0])
    for w in words[1:]:
        wanted = wanted | test(*w)
    which = F.array_compact(F.array(*[F.when(test(*w), F.lit(i)) for i, w in enumerate(words)]))
    read = index.postings.where(wanted).select("doc", "col", "pos", "size", F.explode(which).alias("w"))
    rows = read.groupBy("doc").agg(F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("w", "col", "pos"))).alias("found"))

    def starts(n: Node, column: str) -> Column:
        spots = [_spots_of(F.col("found"), words.index((w, n.prefix and k == len(n.words) - 1)), column) for k, w in enumerate(n.words)]
        at = F.array_distinct(spots[0])
        for k, other in enumerate(spots[1:], 1):
            at = F.array_intersect(at, _earlier(other, k))
        return F.filter(at, lambda i: i == 0) if n.initial else at

    def often(n: Node) -> Column:
        total = F.lit(0)
        for column in [n.column] if n.column else index.columns:
            if n.op == "near":
                at = n.member or 0
                ok = starts(Node("phrase", words=[n.words[at]]), column)
                for w in n.words[:at] + n.words[at + 1 :]:
                    ok = _beside(ok, starts(Node("phrase", words=[w]), column), n.distance)
                total = total + F.size(ok)
            else:
                total = total + F.size(starts(n, column))
        return total

    def there(n: Node) -> Column:
        return often(Node("phrase", words=[n.words[n.member or 0]], column=n.column)) > 0 if n.op == "near" else often(n) > 0

    def hit(n: Node) -> Column:
        if n.op in ("phrase", "near"):
            return often(n) > 0
        first, *rest = [hit(p) for p in n.parts]
        for r in rest:
            first = first | r if n.op == "or" else (first & ~r if n.op == "not" else first & r)
        return first

    counted = rows.select("doc", F.col("size").alias("__size"), hit(node).alias("__hit"), *[often(t).alias(f"__f{i}") for i, t in enumerate(terms)], *[there(t).alias(f"__c{i}") for i, t in enumerate(terms)])
    found = counted.agg(*[F.count_if(F.col(f"__c{i}")).alias(f"__d{i}") for i in range(len(terms))])
    stats = found.crossJoin(F.broadcast(index.stats.select(F.col("n_rows").alias("__n"), F.col("mean_size").alias("__avg"))))
    return counted.where("__hit").crossJoin(F.broadcast(stats)).select("doc", bm25(len(terms)).alias("score"))


def entry_source(entries: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Entries with all their headwords in one column, ordered by headword id."""
    forms = lemmas.where(F.col("entry_id").isNotNull()).groupBy("entry_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "forma"))), lambda x: x["forma"]), " / ").alias("lemas"))
    return entries.join(forms, entries["id"] == forms["entry_id"], "left").drop("entry_id").withColumn("lemas", F.coalesce("lemas", F.lit("")))


ENTRY_FIELDS = {"f_lemas": "lemas", "f_def": "definicao", "f_morf": "morfologia", "f_notas": "notas", "f_raw": "raw_text"}


def entry_index(entries: DataFrame, lemmas: DataFrame, name: str) -> Index:
    """Index of all text fields of entries, with their headwords."""
    src = entry_source(entries, lemmas)
    return index_of(src.select("id", *[F.col(c).alias(f) for f, c in ENTRY_FIELDS.items()]), "id", list(ENTRY_FIELDS), name)


def search_entries(entries: DataFrame, lemmas: DataFrame, query: str, limit: int = 20, doc_name: str | None = None, page: int | None = None, include_raw: bool = False, marks: tuple[str, str] = ("[", "]"), index: Index | None = None) -> DataFrame:
    """Entry search: id, headwords, label, snippet, definition, notes and score, best first.

    With an index only hits are read from the table, and the statistics of the score are those of all entries.
    """
    src = entry_source(entries, lemmas)
    keep = ["id", "lemas", "doc_name", "page_num", "morfologia", "definicao", "notas", "raw_text"]
    src = src.select(*keep)
    if doc_name is not None:
        src = src.where(F.col("doc_name") == doc_name)
    if page is not None:
        src = src.where(F.col("page_num") == page)
    words = [w for leaf in leaves(parse_query(query)) for w in leaf.words]
    if index is None:
        named = src.select(*keep, *[F.col(c).alias(f) for f, c in ENTRY_FIELDS.items()])
        hit = search(named, query, list(ENTRY_FIELDS), keep)
    else:
        hit = src.join(search_index(index, query).withColumnRenamed("doc", "id"), "id")
    show = snippet(F.coalesce(F.nullif("definicao", F.lit("")), F.col("raw_text")), words, 12, *marks)
    out = hit.select("id", "lemas", "morfologia", show.alias("snippet"), "definicao", "notas", *(["raw_text"] if include_raw else []), "score")
    return out.orderBy("score", "id").limit(limit)
