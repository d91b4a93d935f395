"""JSON of unknown shape against a plain walk of the parsed texts."""

import json
import random

from quadloom.sources import json_io, json_open


def rows(df):
    return sorted(
        (r.subject, r.predicate, r.object or "", r.value or "", r.value_type, r.lang or "", tuple(sorted((r.facets or {}).items())))
        for r in df.collect()
    )


def texts(spark, docs):
    return spark.createDataFrame([(d if d is None or isinstance(d, str) else json.dumps(d),) for d in docs], "json string").repartition(3)


def literal(x):
    return json.dumps(x, ensure_ascii=False, separators=(",", ":"))


def walk(o, out, via=None):
    """Triples of an object whose objects all have a uid."""
    me = o["uid"].lower()
    for name, value in o.items():
        if name == "uid" or "|" in name:
            continue
        predicate, _, lang = name.partition("@")
        facets = {} if lang or name == via else {k[len(name) + 1 :]: literal(v) for k, v in o.items() if k.startswith(name + "|") and v is not None}
        put(me, predicate, lang, facets, value, out)


def put(me, predicate, lang, facets, value, out):
    if isinstance(value, list):
        for item in value:
            put(me, predicate, lang, {}, item, out)
    elif isinstance(value, dict) and set(value) == {"type", "coordinates"}:
        out.append((me, predicate, "", literal(dict(sorted(value.items()))), "geo", lang, tuple(sorted(facets.items()))))
    elif isinstance(value, dict):
        own = {k[len(predicate) + 1 :]: literal(v) for k, v in value.items() if k.startswith(predicate + "|") and v is not None}
        out.append((me, predicate, value["uid"].lower(), "", "uid", "", tuple(sorted(own.items()))))
        walk(value, out, predicate)
    elif value is not None:
        kind = "string" if lang else {bool: "bool", int: "int", float: "float", str: "string"}[type(value)]
        text = str(value).lower() if isinstance(value, bool) else str(value)
        out.append((me, predicate, "", text, kind, lang, tuple(sorted(facets.items()))))


def made(rnd, depth, count):
    """A random object: values, lists in lists, objects, facets, languages, nulls, geometries."""
    count[0] += 1
    o = {"uid": f"0x{count[0]:X}"}
    for name in rnd.sample(["a", "b", "name", "p", "q", "friend"], rnd.randint(0, 5)):
        kind = rnd.randrange(9)
        if kind < 4:
            o[name] = rnd.choice([1, -7, 2.5, True, False, "", "text", "größe|x", None])
            if rnd.random() < 0.4:
                o[f"{name}|since"] = rnd.choice([2001, "2001-01-01", None, True])
        elif kind == 4:
            o[f"{name}@de"] = "wert"
        elif kind == 5:
            o[name] = {"type": "Point", "coordinates": [1.5, -2.5]}
        elif kind == 6:
            o[name] = [1, [2, [3, []]], "x", None]
        elif depth:
            child = made(rnd, depth - 1, count)
            child[f"{name}|weight"] = rnd.randint(0, 9)
            o[name] = child if kind == 7 else [child, [made(rnd, depth - 1, count)], 5]
    return o


def test_any_shape(spark):
    rnd, count = random.Random(8), [0]
    docs = [made(rnd, rnd.randint(0, 6), count) for _ in range(60)]
    want = []
    for d in docs:
        walk(d, want)
    assert max(len(json.dumps(d)) for d in docs) > 1000
    half = [docs[:20], *docs[20:]]  # a text may be an array of objects
    assert rows(json_open.to_triples(texts(spark, half), "json")) == sorted(want)


def test_same_as_declared(spark):
    schema = "a: bigint, `a|k`: string, b: struct<c: double, d: array<string>>, e: array<struct<`e|w`: bigint, f: boolean>>, `n@fr`: string, uid: string"
    docs = [
        {"a": 1, "a|k": "v", "b": {"c": 1.5, "d": ["x", "y"]}, "e": [{"e|w": 3, "f": True}, {"f": False}], "n@fr": "nom", "uid": "<0xAB>"},
        {"a": 2, "b": {"c": 0.5}}, {"a": 2, "b": {"c": 0.5}}, {}, {"a": None, "uid": "0x5"}, None, "not json", "3",
    ]
    from pyspark.sql import types as T

    declared = json_io.to_triples(texts(spark, docs), "json", T.StructType.fromDDL(schema.replace(": ", " ", 0)))
    open_ = json_open.to_triples(texts(spark, docs), "json")
    assert rows(open_) == rows(declared) and rows(open_)
    assert declared.columns == open_.columns


def test_odd_texts(spark):
    bad = ["not json", "3", '"text"', "{", "[1"]
    docs = [*bad, None, "", "[]", "{}", "[1, null]", {"uid": "0x1", "big": 12345678901234567890, "e": 1e30, "deep": None}]
    df = texts(spark, docs)
    assert sorted(r.json for r in json_open.unreadable(df, "json").collect()) == sorted([*bad, ""])
    got = rows(json_open.to_triples(df, "json"))
    assert got == [("0x1", "big", "", "12345678901234567890", "float", "", ()), ("0x1", "e", "", "1.0E30", "float", "", ())]
    assert json_open.to_triples(df.where("1 = 0"), "json").count() == 0
    deep = "1"
    for k in range(12, 0, -1):
        deep = f'{{"uid": "0x{k:x}", "next": {deep}}}'
    assert json_open.to_triples(texts(spark, [deep]), "json").where("value_type = 'uid'").count() == 11
