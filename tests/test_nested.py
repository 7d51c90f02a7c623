import json
import random

from lexispark.operators.nested import TreeSpec, flatten_tree

SPEC = TreeSpec(("sentidos",), ("sentidos", "sub"), ("ex", "exemplos"))
SCHEMA = "rec_key string, doc string, node_path string, body string"


def brute(record):
    out = set()

    def items(x):
        return x if isinstance(x, list) else [] if x in (None, "") else [x]

    def sense(s, path):
        out.add(("sense", path))
        if isinstance(s, dict):
            for k in SPEC.leaves:
                out.update(("example", f"{path}#{i}") for i, _ in enumerate(items(s.get(k)), 1))
            for k in SPEC.children:
                for i, x in enumerate(items(s.get(k)), 1):
                    sense(x, f"{path}.{i}")

    for r in record if isinstance(record, list) else [record]:
        for i, x in enumerate(items(r.get("sentidos")), 1):
            sense(x, str(i))
    return out


def made(rng, depth=0):
    if rng.random() < 0.2:
        return rng.choice(["texto", 'com "aspas" e {chaves}', "barra \\ e [colchetes]", "é, ç: ñ"])
    node = {"n": str(rng.randint(1, 9)), "glosa": rng.choice(["a", "b, c", "d: e"]), "meta": [{"sub": 1}, 2.5, None, True]}
    if rng.random() < 0.6:
        node["ex"] = rng.choice([None, [], "uma", {"lat": "x"}, ["a", {"lat": "b", "ref": {"loc": ["1", "2"]}}], ""])
    if depth < 5 and rng.random() < 0.6:
        kids = [made(rng, depth + 1) for _ in range(rng.randint(0, 3))]
        node[rng.choice(SPEC.children)] = kids if len(kids) != 1 or rng.random() < 0.5 else kids[0]
    return node


def test_matches_brute_force_on_random_trees(spark):
    rng = random.Random(7)
    rows, expected = [], set()
    for i in range(300):
        record = {"lemas": ["x"], "sentidos": rng.choice([[made(rng) for _ in range(rng.randint(0, 4))], made(rng), None])}
        text = json.dumps(record, ensure_ascii=bool(i % 2))
        text = rng.choice([text, f"```json\n{text}\n```", json.dumps(text), f"[{text}]"])
        rows.append((f"r{i}", text, "clash", "clash"))
        expected |= {(f"r{i}", *x) for x in brute(record)}
    got = flatten_tree(spark.createDataFrame(rows, SCHEMA), "rec_key", "doc", SPEC).collect()
    assert {(r.rec_key, r.node_kind, r.node_path) for r in got} == expected
    assert len(got) == len(expected)


def test_parent_links_and_bodies(spark):
    doc = '{"sentidos": [{"glosa": "a", "sub": ["b", {"glosa": "c", "ex": "q"}]}]}'
    got = {r.node_path: (r.parent_path, r.depth, r.position, r.body) for r in flatten_tree(spark.createDataFrame([("1", doc, "", "")], SCHEMA), "rec_key", "doc", SPEC).collect()}
    assert got["1.2#1"] == ("1.2", 2, 1, '"q"')
    assert got["1.1"] == ("1", 2, 1, '"b"')
    assert json.loads(got["1"][3])["glosa"] == "a"


def test_unreadable_null_empty_and_plain_text_give_no_rows(spark):
    bad = [None, "", "   ", "plain text, with commas", '{"sentidos": [{"glosa": "cut', '"{\\"sentidos\\": [', "[]", "{}", '{"sentidos": null}', '{"sentidos": ""}', "}{", "null"]
    df = spark.createDataFrame([(str(i), b, None, None) for i, b in enumerate(bad)], SCHEMA)
    assert flatten_tree(df, "rec_key", "doc", SPEC).count() == 0
    assert flatten_tree(df.limit(0), "rec_key", "doc", SPEC).count() == 0


def test_very_deep_and_very_long(spark):
    deep = '{"sentidos": [' + '{"sub": [' * 200 + '"x"' + "]}" * 200 + "]}"
    long = json.dumps({"sentidos": [{"glosa": "y" * 200_000} for _ in range(3)]})
    got = flatten_tree(spark.createDataFrame([("d", deep, "", ""), ("l", long, "", "")], SCHEMA), "rec_key", "doc", SPEC)
    counts = {r.rec_key: r["count"] for r in got.groupBy("rec_key").count().collect()}
    assert counts == {"d": 201, "l": 3}


def test_documents_wrapped_any_number_of_times(spark):
    doc = json.dumps({"sentidos": ["um", {"glosa": "dois", "ex": "x"}]})
    texts = [doc]
    for _ in range(5):
        doc = "```json\n" + json.dumps(doc) + "\n```" if len(texts) % 2 else json.dumps(doc)
        texts.append(doc)
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)] + [("p", '"only text"'), ("q", '"'), ("r", "```")], "rec_key string, doc string")
    got = {}
    for r in flatten_tree(df, "rec_key", "doc", SPEC).collect():
        got.setdefault(r.rec_key, set()).add((r.node_kind, r.node_path))
    assert got == {str(i): {("sense", "1"), ("sense", "2"), ("example", "2#1")} for i in range(6)}
