"""Small fixtures with results fixed by hand."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from quadloom.functions import facets as fx, uid as uids, values as v
from quadloom.model import FACETS, FACT_COLUMNS, FACT_SCHEMA, TYPE_PREDICATE
from quadloom.operators import checks, facet_ops, identity, mutate, roots, schema, traverse
from quadloom.plans.pages import nest
from quadloom.sources import json_io, nquads


def col(spark, value, fn, kind="string"):
    """fn over one value as a column."""
    row = spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()
    return row[0]


# people -----------------------------------------------------------------------
@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            (1, "Ines", 34, True, dt.datetime(1991, 7, 14, 6, 30), bytearray(b"12 knots"), 8.25, 47.5),
            (2, "Jaro", 41, None, None, None, None, None),
            (3, "Katla", 37, None, None, None, None, None),
        ],
        "uid long, name string, age int, married boolean, dob timestamp_ntz, raw binary, lon double, lat double",
    )


@pytest.fixture(scope="module")
def friends(spark):
    return spark.createDataFrame(
        [(1, 2, "port", 7, True), (1, 3, "starboard", 11, None)], "src long, dst long, watch string, years int, relief boolean"
    )


def test_nested_query_with_edge_filter(people, friends):
    """Ines with only the friend that passes the filter, location and bytes as text."""
    child = people.where(F.col("name") == "Jaro").select(F.col("uid").alias("dst"), "name", "age")
    rows = friends.select("src", "dst").join(child, "dst")
    lists = nest(rows, ["src"], ["name", "dst"], F.struct("name", "age"), "crew")
    ines = people.where(roots.compare("name", "eq", "Ines"))
    doc = ines.join(lists, ines["uid"] == lists["src"], "left").select(
        F.to_json(
            F.struct(
                "name", "age", "married", v.to_rfc3339(F.col("dob")).alias("dob"), v.bytes_to_text(F.col("raw")).alias("log_line"),
                F.from_json(v.point_to_geojson(F.col("lon"), F.col("lat")), v.POINT).alias("loc"), "crew",
            )
        )
    )
    assert json.loads(doc.first()[0]) == {
        "name": "Ines", "age": 34, "married": True, "dob": "1991-07-14T06:30:00.000Z", "log_line": "MTIga25vdHM=",
        "loc": {"type": "Point", "coordinates": [8.25, 47.5]}, "crew": [{"name": "Jaro", "age": 41}],
    }


def test_missing_block_is_absent(people, friends):
    jaro = people.where("name = 'Jaro'").join(
        nest(friends, ["src"], ["dst"], F.col("dst"), "crew"), F.col("uid") == F.col("src"), "left"
    )
    assert json.loads(jaro.select(F.to_json(F.struct("name", "crew"))).first()[0]) == {"name": "Jaro"}


def test_ordered_children_and_conditional_delete(spark, people, friends):
    def names(edges):
        rows = traverse.expand(people.select("uid"), edges.select("src", "dst"), people.select("uid", "name"), prefix="f_")
        return nest(rows, ["uid"], ["f_name", "f_uid"], F.col("f_name"), "names").first()["names"]

    assert names(friends) == ["Jaro", "Katla"]
    gone = spark.createDataFrame([(1, 3)], "src long, dst long")
    ines, katla = people.where("name = 'Ines'"), people.where("name = 'Katla'")
    held = mutate.apply_if(gone, [(ines, "eq", 1), (katla, "eq", 1)])
    assert names(mutate.delete_edges(friends, held)) == ["Jaro"]
    refused = mutate.apply_if(gone, [(ines, "eq", 1), (people.where("name = 'Lumi'"), "eq", 1)])
    assert names(mutate.delete_edges(friends, refused)) == ["Jaro", "Katla"]


def test_facets_on_value_and_edge(spark, people, friends):
    rows = nest(
        friends.join(people.select(F.col("uid").alias("dst"), "name"), "dst"), ["src"], ["name", "dst"],
        F.struct("name", F.col("years").alias("crew|years"), F.col("relief").alias("crew|relief"), F.col("watch").alias("crew|watch")),
        "crew",
    )
    assert json.loads(rows.select(F.to_json("crew")).first()[0]) == [
        {"name": "Jaro", "crew|years": 7, "crew|relief": True, "crew|watch": "port"},
        {"name": "Katla", "crew|years": 11, "crew|watch": "starboard"},
    ]
    fact = spark.createDataFrame([(0, 1, "name", None, "Ines", "string", None, {"harbour": '"Bergen"'})], FACT_SCHEMA)
    assert facet_ops.value_with_facets(fact, "name", ["harbour"]).first().asDict() == {
        "uid": 1, "name": "Ines", "name|harbour": "Bergen",
    }


def test_type_expansion_follows_list_and_reverse_edges(people, friends):
    edges = friends.select("src", "dst")
    types = {
        "Person": traverse.TypeInfo(people, ["name"], {"crew": (edges, "Person"), "~crew": (traverse.reverse(edges), "Person")})
    }
    rows = traverse.expand_all(types, "Person", 1).where("root = 1").orderBy("path", "uid").collect()
    assert [(r["path"], r["parent"], r["uid"], json.loads(r["fields"])) for r in rows] == [
        ("", None, 1, {"name": "Ines"}), ("crew", 1, 2, {"name": "Jaro"}), ("crew", 1, 3, {"name": "Katla"}),
    ]
    assert {r["path"] for r in traverse.expand_all(types, "Person", 0).collect()} == {""}
    back = traverse.expand_all(types, "Person", 2).where("path = '~crew.crew' and root = 2")
    assert sorted(r["uid"] for r in back.collect()) == [2, 3]


def test_expansion_grows_with_the_edges(people, friends):
    """One branch per path: four sibling edges plan twice what two do, not its square."""
    edges = friends.select("src", "dst")

    def size(n):
        types = {"Person": traverse.TypeInfo(people, ["name"], {f"e{i}": (edges, "Person") for i in range(n)})}
        return len(traverse.expand_all(types, "Person", 1)._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert size(8) - size(4) <= 1.1 * (size(6) - size(2))


# N-Quads ----------------------------------------------------------------------
VOYAGE = [
    '<0x1> <routes> "Skagen" .',
    '<0x1> <routes> "Lofoten" (leg=40) .',
    f'<0x1> <{TYPE_PREDICATE}> "Voyage" .',
    f'_:0 <{TYPE_PREDICATE}> "Voyage" .',
    "<0x1> <fleet> _:0 .",
    '<0x1> <name> "north" .',
]


def lines_of(df):
    return sorted(r[0] for r in df.collect())


def test_nquad_text_round_trip(spark):
    parsed = nquads.parse(spark.createDataFrame([(x,) for x in VOYAGE], "value string"))
    assert nquads.rejects(parsed).count() == 0
    assert lines_of(nquads.lines(nquads.triples(parsed))) == sorted(VOYAGE)


@pytest.mark.parametrize(
    "line, error",
    [
        ('_:sailor1 <email> "ines@example.org" ', "end of line"),
        ('<0xG> <p> "x" .', "subject"),
        ("<0x12345678901234567> <p> \"x\" .", "subject"),
        ('<0x1> p "x" .', "predicate"),
        ('<0x1> <p> "x .', "object"),
        ("<0x1> <p> 12abc .", "end of line"),
        ("<0x1> <p> 12@en .", "language"),
        ('<0x1> <p> "x" (k) .', "facets"),
        ('<0x1> <p> "bad \\q escape" .', "literal"),
    ],
)
def test_malformed_lines_are_rejected(spark, line, error):
    parsed = nquads.parse(spark.createDataFrame([(line,)], "value string"))
    assert [(r.line, r.error) for r in nquads.rejects(parsed).collect()] == [(line, error)]
    assert nquads.triples(parsed).count() == 0


@pytest.mark.parametrize(
    "line, expected",
    [
        ('_:Sailor <email> "jaro@example.org".', ("_:sailor", "email", None, "jaro@example.org", "string", None, None, False)),
        ("  <0x0A>\t<age>\t26.", ("0x0a", "age", None, "26", "int", None, None, False)),
        ("<0x1> <h> -1.5e3 .", ("0x1", "h", None, "-1.5e3", "float", None, None, False)),
        ("<0x1> <ok> true .", ("0x1", "ok", None, "true", "bool", None, None, False)),
        ("<0x1> <old> * .", ("0x1", "old", None, "_STAR_ALL", "default", None, None, True)),
        ("\t<0x1> * *\t.\r", ("0x1", "_STAR_ALL", None, "_STAR_ALL", "default", None, None, True)),
        ("uid(a) <friend> uid(c) .", ("uid(a)", "friend", "uid(c)", None, "uid", None, None, False)),
        ('<0x1> <t> "a \\"b\\" . (c)\\n"@pt-BR .', ("0x1", "t", None, 'a "b" . (c)\n', "string", "pt-BR", None, False)),
        ('<0x1> <t> "" .', ("0x1", "t", None, "", "string", None, None, False)),
        (
            '<0x1> <f> <0x2> (since="2009, \\"x\\"", n=1.5, ok=true) .',
            ("0x1", "f", "0x2", None, "uid", None, {"since": '"2009, \\"x\\""', "n": "1.5", "ok": "true"}, False),
        ),
    ],
)
def test_parsed_pieces(spark, line, expected):
    parsed = nquads.parse(spark.createDataFrame([(line,), ("   ",)], "value string"))
    assert [tuple(r) for r in nquads.triples(parsed).collect()] == [expected]


def test_any_text_survives_the_round_trip(spark):
    import random

    rng = random.Random(11)
    alphabet = 'ab"\\/\n\t\r\u0001 .@()<>*,=|éß漢😀\u2028'
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(400)]
    rows = spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "subject long, value string")
    facts = rows.select(
        F.lit(0).cast("long").alias("namespace"), "subject", F.lit("t").alias("predicate"), F.lit(None).cast("long").alias("object_uid"), "value",
        F.lit("string").alias("value_type"), F.when(F.col("subject") % 2 == 0, "en").alias("lang"),
        F.when(F.col("subject") % 3 == 0, F.create_map(F.lit("f"), v.json_literal(F.col("value")))).alias("facets"),
    )
    lines = nquads.lines(nquads.from_facts(facts)).withColumnRenamed("line", "value")
    back = nquads.to_facts(nquads.triples(nquads.parse(lines)))
    key = lambda r: (r.subject, r.value, r.lang, str(r.facets))
    assert sorted(map(key, back.collect())) == sorted(map(key, facts.collect()))


def test_long_literal_with_many_escapes(spark):
    text = 'line "quoted" \\ back\n' * 20000
    line = f"<0x1> <t> {json.dumps(text)}@en ."
    parsed = nquads.parse(spark.createDataFrame([(line,)], "value string"))
    assert nquads.triples(parsed).first()["value"] == text


def test_nquad_files(spark, tmp_path):
    nquads.write(nquads.triples(nquads.parse(spark.createDataFrame([(x,) for x in VOYAGE], "value string"))), str(tmp_path / "out"))
    assert lines_of(nquads.lines(nquads.triples(nquads.read(spark, str(tmp_path / "out"))))) == sorted(VOYAGE)


# JSON -------------------------------------------------------------------------
VOYAGE_JSON = '{ "uid": "0x1","node.type": ["Voyage"],"name": "north","fleet": { "uid": "_:0","node.type": ["Voyage"] } }'


def test_json_to_triples(spark):
    inner = T.StructType().add("uid", "string").add(TYPE_PREDICATE, T.ArrayType(T.StringType()))
    shape = T.StructType().add("uid", "string").add(TYPE_PREDICATE, T.ArrayType(T.StringType())).add("name", "string").add("fleet", inner)
    rows = json_io.to_triples(spark.createDataFrame([(VOYAGE_JSON,)], "j string"), "j", shape)
    assert lines_of(nquads.lines(rows)) == sorted(
        [f'<0x1> <{TYPE_PREDICATE}> "Voyage" .', '<0x1> <name> "north" .', "<0x1> <fleet> _:0 .", f'_:0 <{TYPE_PREDICATE}> "Voyage" .']
    )


def test_json_languages_facets_geo_and_nested_lists(spark):
    shape = T.StructType.fromDDL(
        "uid string, `name@pt` string, since timestamp, `since|by` string, loc struct<type: string, coordinates: array<double>>, "
        "friend array<struct<uid: string, name: string, `friend|close`: boolean, pet: array<struct<uid: string, name: string>>>>"
    )
    doc = {
        "uid": "0xA", "name@pt": "Olá", "since": "2020-01-02T03:04:05Z", "since|by": "me", "loc": {"type": "Point", "coordinates": [8.25, 47.5]},
        "friend": [{"uid": "_:B", "name": "Jaro", "friend|close": True, "pet": [{"uid": "_:p", "name": "Rex"}]}, {"uid": "0xc"}],
    }
    rows = json_io.to_triples(spark.createDataFrame([(json.dumps(doc),)], "j string"), "j", shape)
    assert lines_of(nquads.lines(rows)) == sorted(
        [
            '<0xa> <name> "Olá"@pt .', '<0xa> <since> "2020-01-02T03:04:05.000Z" (by="me") .',
            '<0xa> <loc> "{\\"type\\":\\"Point\\",\\"coordinates\\":[8.25,47.5]}" .', "<0xa> <friend> _:b (close=true) .", '_:b <name> "Jaro" .',
            "_:b <pet> _:p .", '_:p <name> "Rex" .', "<0xa> <friend> <0xc> .",
        ]
    )


def test_json_deletes(spark):
    """Named values and edges, a null key, and a bare uid; applied to a small state."""
    shape = T.StructType.fromDDL("uid string, name string, age bigint, friend array<struct<uid: string>>")
    docs = ['{"uid":"0x1","age":null,"friend":[{"uid":"0x2"}]}', '{"uid":"0x3"}', '{"uid":"0x4","name":"d"}']
    rows = json_io.to_deletes(spark.createDataFrame([(d,) for d in docs], "j string"), "j", shape)
    assert lines_of(nquads.lines(rows)) == ["<0x1> <age> * .", "<0x1> <friend> <0x2> .", "<0x3> * * .", '<0x4> <name> "d" .']
    state = [(1, "age", None, "5"), (1, "name", None, "a"), (1, "friend", 2, None), (1, "friend", 3, None), (3, "name", None, "c"), (4, "name", None, "d"), (4, "age", None, "6")]
    facts = spark.createDataFrame([(0, s, p, o, x, "string", None, None) for s, p, o, x in state], FACT_SCHEMA)
    after = mutate.apply(facts, mutate.changes_from(rows.withColumn("op", F.lit("DEL")), 1), ["friend"])
    assert sorted((r.subject, r.predicate, r.object_uid, r.value) for r in after.collect()) == [(1, "friend", 3, None), (1, "name", None, "a"), (4, "age", None, "6")]


def test_variables_in_mutation_text(spark):
    texts = ["uid(a) <friend> uid(c) .", 'uid(n) <email> "e" .', '<0x9> <x> "y" .']
    rows = nquads.triples(nquads.parse(spark.createDataFrame([(t,) for t in texts], "value string")))
    nodes = lambda *ids: spark.createDataFrame([(i,) for i in ids], "uid long")
    variables = {"a": nodes(1, 2), "c": nodes(3)}
    assert lines_of(nquads.lines(mutate.bind(rows, variables))) == ["<0x1> <friend> <0x3> .", "<0x2> <friend> <0x3> .", '<0x9> <x> "y" .']
    assert '_:n <email> "e" .' in lines_of(nquads.lines(mutate.bind(rows, variables, create=True)))
    many = mutate.bind(rows, {"a": nodes(1, 2), "c": nodes(3, 4, 5), "n": nodes(7)})
    assert sorted((r.subject, r.object) for r in many.collect() if r.predicate == "friend") == [
        (f"0x{a}", f"0x{c}") for a in (1, 2) for c in (3, 4, 5)
    ]
    assert '<0x7> <email> "e" .' in lines_of(nquads.lines(many))


def test_object_without_uid_gets_the_same_label_every_time(spark):
    shape = T.StructType.fromDDL("name string")
    rows = spark.createDataFrame([('{"name":"x"}',), ('{"name":"x"}',), ('{"name":"y"}',)], "j string")
    labels = [r.subject for r in json_io.to_triples(rows, "j", shape).orderBy("value").collect()]
    assert labels[0] == labels[1] != labels[2] and labels[0].startswith("_:")


@pytest.mark.parametrize(
    "text", ['{"data":{"me":[{"name":"a"},{"name":"b"}]}}', '{"me":[{"name":"a"},{"name":"b"}]}', '[{"name":"a"},{"name":"b"}]', '{"data":[{"name":"a"},{"name":"b"}]}'],
)
def test_response_forms(spark, text):
    rows = json_io.read_response(spark.createDataFrame([(text,)], "j string"), "j", "me", "name: string")
    assert [r.name for r in rows.collect()] == ["a", "b"]


def test_single_object_response(spark):
    rows = json_io.read_response(spark.createDataFrame([('{"me":{"name":"a"}}',)], "j string"), "j", "me", "name: string")
    assert [r.name for r in rows.collect()] == ["a"]


def test_json_document_pages(spark):
    """A node with more children than a page becomes several objects with the same uid."""
    nodes = spark.createDataFrame([(1, "a"), (2, "b")], "uid long, name string")
    rows = spark.createDataFrame([(1, i) for i in range(10)] + [(2, 99)], "src long, dst long")
    block = json_io.Block(rows, ["dst"], F.struct(uids.to_text(F.col("dst") + 1).alias("uid")))
    docs = [json.loads(r.json) for r in json_io.documents(nodes, ["name"], {"to": block}, page_size=4).orderBy("uid", "page").collect()]
    assert [len(d["to"]) for d in docs] == [4, 4, 2, 1]
    assert docs[0]["name"] == "a" and "name" not in docs[1] and docs[1]["uid"] == "0x1"
    assert [c["uid"] for d in docs[:3] for c in d["to"]] == [hex(i + 1) for i in range(10)]


def test_faceted_list(spark):
    doc = '{"routes":["1",null,"2"],"routes|leg":{"2":40},"routes|note":{"0":"n","1":"gone"}}'
    rows = facet_ops.read_faceted_list(spark.createDataFrame([(1, doc)], "uid long, j string"), "j", ["uid"], "routes", {"leg": "bigint", "note": "string"})
    assert [tuple(r) for r in rows.orderBy("pos").collect()] == [(1, 0, "1", None, "n"), (1, 2, "2", 40, None)]
    shape = T.ArrayType(T.StructType().add("value", "string").add("facets", FACETS))
    elements = spark.createDataFrame([([("1", None), ("2", {"leg": "40"}), ("3", {"leg": "4", "ok": "true"})],)], T.StructType().add("e", shape))
    text = elements.select(facet_ops.faceted_list_json(F.col("e"), "routes")).first()[0]
    assert json.loads(text) == {"routes": ["1", "2", "3"], "routes|leg": {"1": 40, "2": 4}, "routes|ok": {"2": True}}


# uids -------------------------------------------------------------------------
@pytest.mark.parametrize("text", ["0x", "0xG", "0x" + "1" * 17, "_:", "_:a-b", "_:" + "a" * 33, "12"])
def test_invalid_uids(spark, text):
    assert col(spark, text, uids.classify) == "invalid" and col(spark, text, uids.normalise) is None
    assert col(spark, text, uids.is_valid) is False


@pytest.mark.parametrize(
    "text, kind, clean", [("<0x1", "concrete", "0x1"), ("0x1>", "concrete", "0x1"), ("<_:a>", "blank", "_:a"), ("0XAB", "invalid", None), ("0xAB", "concrete", "0xab"), ("_:Ab", "blank", "_:ab"), ("", "empty", None)]
)
def test_uid_forms(spark, text, kind, clean):
    assert col(spark, text, uids.classify) == kind and col(spark, text, uids.normalise) == clean


def test_uid_numbers(spark):
    assert str(col(spark, "0xffffffffffffffff", uids.to_unsigned)) == "18446744073709551615"
    assert col(spark, "0xffffffffffffffff", uids.to_long) == -1
    assert col(spark, -1, uids.to_text, "long") == "0xffffffffffffffff"
    assert col(spark, "0x8000000000000001", lambda x: uids.unsigned_order(uids.to_long(x))) > col(spark, "0x7fffffffffffffff", lambda x: uids.unsigned_order(uids.to_long(x)))
    assert col(spark, "0x0", uids.to_long) is None and col(spark, "_:a", uids.to_long) is None
    assert col(spark, 2**63 - 1, lambda x: uids.to_long(uids.to_text(x)), "long") == 2**63 - 1
    assert col(spark, 0, uids.to_text, "long") is None
    assert "0x10" < "0x9" and col(spark, "0x10", lambda x: x < "0x9") is True


def test_blank_labels_resolve_everywhere(spark):
    rows = nquads.triples(nquads.parse(spark.createDataFrame([(x,) for x in VOYAGE], "value string")))
    assigned = identity.assign(identity.blank_labels(rows), 256)
    assert [tuple(r) for r in assigned.collect()] == [("_:0", 256)]
    out = lines_of(nquads.lines(identity.propagate(rows, assigned)))
    assert out == sorted(x.replace("_:0", "<0x100>") for x in VOYAGE)


# values -----------------------------------------------------------------------
def test_vectors(spark):
    assert col(spark, "[1 2.5 -3]", v.parse_vector) == [1.0, 2.5, -3.0]
    assert col(spark, "[ 1  2 ]", v.parse_vector) == [1.0, 2.0]
    for bad in ("1 2", "[a b]", "[]", "[1 [2]"):
        assert col(spark, bad, v.parse_vector) is None
    assert col(spark, [1.0, 2.5], v.format_vector, "array<float>") == "[1.0 2.5]"


def test_flags(spark):
    members = {"None": 0, "A": 1, "B": 2, "C": 4}
    assert col(spark, 5, lambda x: v.flag_members(x, members), "int") == ["None", "A", "C"]
    assert col(spark, ["a", "C", "c", "x"], lambda x: v.flags_value(x, members), "array<string>") == 5


def test_literals(spark):
    for literal, text in [('"a\\"b\\u00e9"', 'a"bé'), ('""', ""), ("12", "12"), ("true", "true"), ('"plain"', "plain"), ('"bad\\q"', None)]:
        assert col(spark, literal, v.decode_literal) == text
    assert col(spark, 'a"b\n', v.json_literal) == '"a\\"b\\n"'
    assert col(spark, None, v.json_literal) is None


def test_lenient_values(spark):
    assert col(spark, "9999999999999999999", lambda x: v.coerce(x, "int")) is None
    assert col(spark, " 12 ", lambda x: v.coerce(x, "int")) == 12
    assert col(spark, "1e3", lambda x: v.coerce(x, "float")) == 1000.0
    assert col(spark, "yes", lambda x: v.coerce(x, "bool")) is None
    assert col(spark, "2020-02-30", lambda x: v.coerce(x, "dateTime")) is None


def test_parameters():
    assert roots.declare(a=1, b="x", c=2**70, d=True, e=[1, [2, 3]], f=dt.date(2020, 1, 2), g=1.5) == {
        "$a": ("int", "1"), "$b": ("string", "x"), "$c": ("string", str(2**70)), "$d": ("string", "true"),
        "$e": ("string", "[1,[2,3]]"), "$f": ("string", "2020-01-02"), "$g": ("string", "1.5"),
    }
    assert roots.parameter_text('say "hi"') == 'say \\"hi\\"'
    assert roots.parameter_text(dt.datetime(2020, 1, 2, 3, 4, 5, 6)) == "2020-01-02T03:04:05.0000060"
    zoned = dt.datetime(2020, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=-3)))
    assert roots.parameter_text(zoned) == "2020-01-02T00:00:00.0000000-03:00"
    with pytest.raises(ValueError):
        roots.parameter_text(None)


def test_patterns(spark):
    assert roots.to_java_pattern("/ab+c/im") == "(?im)ab+c"
    assert roots.to_java_pattern("/x/U") == "x"
    assert roots.to_java_pattern("plain") == "plain"
    good, bad = roots.split_patterns(spark, ["/a(/", "a{2}", "[z-a]"])
    assert list(good) == ["a{2}"] and bad == ["/a(/", "[z-a]"]


def test_facet_values(spark):
    m = {"n": "13", "t": '"13"', "ok": "true", "at": '"2020-01-02T03:04:05Z"', "f": "1.5"}
    get = lambda name, t, d: col(spark, m, lambda x: fx.get(x, name, t, d), "map<string,string>")
    assert get("n", "int", -1) == 13 and get("t", "int", -1) == -1 and get("t", "string", "") == "13" and get("n", "string", "d") == "d"
    assert get("ok", "boolean", False) is True and get("n", "boolean", False) is False and get("f", "double", 0.0) == 1.5
    assert get("at", "timestamp", None) == dt.datetime(2020, 1, 2, 3, 4, 5) and get("zz", "int", 7) == 7
    kinds = {'"2020-01-02"': "dateTime", '"2020"': "string", "12": "int", "1.5": "float", "false": "bool", "null": None, "[1]": None, "{}": None}
    for literal, kind in kinds.items():
        assert col(spark, literal, fx.inferred_type) == kind


# schema -----------------------------------------------------------------------
EXAMPLE = [
    ("Person", "name", "string", "term", False, False, None),
    ("Person", "my_boss", "uid", "none", True, False, "Person"),
    ("Person", "my_boss", "uid", "none", True, True, "Person"),
    ("Person", "works_for", "uid", "none", True, False, "Company"),
    ("Company", "name", "string", "none", False, False, None),
    ("Company", "industry", "string", "exact", False, False, None),
    ("Company", "works_for", "uid", "none", True, True, "Person"),
    ("ledger", "ledger.name", "string", "exact", False, False, None),
    ("ledger", "ledger.generated_at", "dateTime", "hour", False, False, None),
    ("ledger", "ledger.applied_at", "dateTime", "day", False, False, None),
]


@pytest.fixture(scope="module")
def example(spark):
    rows = [
        (0, 0, t, p, kind, None, token, False, False, False, False, False, edge, edge, None, rev, target)
        for t, p, kind, token, edge, rev, target in EXAMPLE
    ]
    return spark.createDataFrame(
        rows,
        "namespace long, version long, type_name string, predicate string, kind string, list_type string, token string, fulltext boolean, "
        "trigram boolean, indexed boolean, upsert boolean, lang boolean, reverse boolean, count boolean, metric string, reversed boolean, target string",
    )


def test_schema_script(example):
    lines = [r.line for r in schema.script(example).collect()]
    assert lines == [
        "industry: string @index(exact) .", "ledger.applied_at: dateTime @index(day) .", "ledger.generated_at: dateTime @index(hour) .",
        "ledger.name: string @index(exact) .", "my_boss: uid @count @reverse .", "name: string @index(term) .", "works_for: uid @count @reverse .",
        "type Company {", "  industry", "  name", "  <~works_for>", "}", "type Person {", "  <~my_boss>", "  my_boss", "  name", "  works_for", "}",
        "type ledger {", "  ledger.applied_at", "  ledger.generated_at", "  ledger.name", "}",
    ]


def test_schema_query_sorted(example):
    rows = schema.query_schema(schema.merge(example), ["name", "industry", "zz"]).collect()
    assert [(r.predicate, r.type) for r in rows] == [("industry", "string"), ("name", "string")]


def test_reverse_mappings(example):
    assert schema.reverse_errors(example).count() == 0
    broken = example.withColumn("reverse", F.lit(False))
    assert {r.error for r in schema.reverse_errors(broken).collect()} == {"not reversible"}
    missing = example.where("NOT (predicate = 'works_for' AND NOT reversed)")
    assert [(r.predicate, r.error) for r in schema.reverse_errors(missing).collect()] == [("works_for", "not mapped")]


def test_migration_names(spark):
    parse = lambda x: col(spark, x, schema.parse_migration_name)
    assert tuple(parse("AddHarbour_20240311094500")) == ("AddHarbour", dt.datetime(2024, 3, 11, 9, 45, 0))
    for bad in ("addHarbour_20240311094500", "Ad_20240311094500", "Add-Harbour_20240311094500", "AddHarbour_20241311094500", "AddHarbour_2024", "AddHarbour"):
        assert parse(bad) is None


def store(spark):
    facts = spark.createDataFrame([(0, 1, "boss_of", 2, None, "uid", None, None), (0, 1, "name", None, "a", "string", None, None)], FACT_SCHEMA)
    types = spark.createDataFrame([(0, "Person", "boss_of"), (0, "Person", "name"), (0, "Old", "name")], "namespace long, type_name string, predicate string")
    ledger = spark.createDataFrame([], "namespace long, name string, generated_at timestamp_ntz, applied_at timestamp_ntz")
    return schema.Store(facts, types, ledger)


def test_migrations_up_down_and_remove(spark):
    one = schema.Migration("One", "2024-03-11 09:45:00", schema.Step(set_types=[("Person", "age")]), schema.Step(drop_predicates=["age"]))
    two = schema.Migration("Two", "2024-04-02 18:20:30", schema.Step(drop_types=["Old"], drop_predicates=["boss_of"]), schema.Step(set_types=[("Old", "name")]))
    names = lambda s: sorted(r.name for r in s.ledger.collect())
    kinds = lambda s: sorted((r.type_name, r.predicate) for r in s.types.collect())
    s = store(spark)
    assert kinds(schema.migrate(s, one, "2024-01-01", down=True)) == kinds(s)  # unknown and down: nothing
    s = schema.migrate(schema.migrate(s, one, "2024-01-01"), two, "2024-01-01")
    assert names(s) == ["One", "Two"] and kinds(s) == [("Person", "age"), ("Person", "name")]
    assert [r.predicate for r in s.facts.collect()] == ["name"]
    again = schema.migrate(s, two, "2024-02-02")
    assert names(again) == ["One", "Two"]
    back = schema.remove_migration(s, [one, two], "One")
    assert names(back) == [] and kinds(back) == [("Old", "name"), ("Person", "name")]


# drops and checks -------------------------------------------------------------
def test_drop_all_leaves_nothing(spark):
    s = store(spark)
    predicates = s.facts.select("predicate").distinct()
    assert [df.count() for df in mutate.drop(s.facts, predicates, s.types, mutate.DROP_ALL)] == [0, 0, 0]
    with pytest.raises(ValueError):
        mutate.drop(s.facts, predicates, s.types, "NONE")


def test_wide_round_trip(people):
    from quadloom.model import wide_to_facts

    facts = wide_to_facts(people, "uid", {"name": ("name", "string"), "age": ("age", "int"), "married": ("married", "bool")})
    assert facts.columns == FACT_COLUMNS
    back = traverse.wide(facts, {"name": "string", "age": "int", "married": "boolean"})
    want = people.select(F.lit(0).cast("long"), "uid", "name", "age", "married")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_checks(spark, people, friends):
    dangling = checks.dangling(friends, people.where("name <> 'Katla'"))
    assert [tuple(r) for r in dangling.collect()] == [(1, 3)]
    lists = spark.createDataFrame([(1, ["a", None]), (2, ["a"]), (3, [])], "uid long, l array<string>")
    assert [r.uid for r in checks.null_elements(lists, "l").collect()] == [1]
