"""Dictionary order by language."""

import random

from pyspark.sql import functions as F

from quadloom.operators import order

GERMAN = ["apfel", "Apfel", "Äpfel", "arbeit", "oben", "ober", "öl", "Ölung", "Ort", "zebra", "Zebra", None]
FRENCH = ["cote", "coté", "côte", "côté", "cotes", "élan", "Élan", "émeu", "etage", "œuf", "ouf"]
SWEDISH = ["aln", "zon", "åtta", "ärta", "öl"]


def listed(df, tag):
    return [r.word for r in df.where(F.col("lang") == tag).orderBy("position").collect()]


def test_each_language_has_its_own_order(spark):
    rows = [("de", w) for w in GERMAN] + [("fr", w) for w in FRENCH] + [("sv", w) for w in SWEDISH] + [("xx", w) for w in ("b", "B", "ä", "a")] + [(None, "q"), (None, "p")]
    random.Random(16).shuffle(rows)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "uid long, lang string, word string").repartition(5)
    got = order.by_locale(df, "word", "lang", ["de", "fr", "sv", "xx"], [F.asc("uid")])
    assert listed(got, "de") == ["apfel", "Apfel", "Äpfel", "arbeit", "oben", "ober", "öl", "Ölung", "Ort", "zebra", "Zebra", None]
    assert listed(got, "fr") == ["cote", "coté", "côte", "côté", "cotes", "élan", "Élan", "émeu", "etage", "œuf", "ouf"]
    assert listed(got, "sv") == SWEDISH  # å, ä and ö are letters of their own, behind z
    assert listed(got, "xx") == ["B", "a", "b", "ä"]  # no rules are known: by code point
    assert [r.word for r in got.where("lang is null").orderBy("position").collect()] == ["p", "q"]
    assert got.count() == len(rows) and got.columns == [*df.columns, "position"]
    back = order.by_locale(df, "word", "lang", ["de"], [F.asc("uid")], descending=True)
    assert listed(back, "de") == [w for w in GERMAN[::-1] if w] + [None]


def test_pages_of_a_hot_list_fit_together(spark):
    """Two thousand rows of few words: ties by uid, positions without a gap over all partitions."""
    rnd = random.Random(17)
    rows = [(i, "de", rnd.choice(["äpfel", "apfel", "Apfel", "zoo"])) for i in range(2000)]
    got = order.by_locale(spark.createDataFrame(rows, "uid long, lang string, word string"), "word", "lang", ["de"], [F.asc("uid")]).collect()
    place = ["apfel", "Apfel", "äpfel", "zoo"]
    want = sorted(rows, key=lambda r: (place.index(r[2]), r[0]))
    assert [r.uid for r in sorted(got, key=lambda r: r.position)] == [r[0] for r in want] and {r.position for r in got} == set(range(1, 2001))
