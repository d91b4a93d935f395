import random

import pytest

#: Columns that operators use inside under the same names.
EXTRA = ["spans", "row", "key", "print", "edge", "slice", "start", "index", "size", "one", "length", "first", "hits", "kept", "shard"]


def odd_texts() -> list:
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and", "Über", "naïve", "größe", "日本"]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base = prose(120)
    passage = prose(60)
    words = base.split()
    near = [" ".join(words[:i] + ["changed"] + words[i + 1 :]) for i in (5, 60, 110)]
    return [
        None, "", "   \n\t ", "12345 67890", "one", "Two Words", "x " * 300, "a\x0bb\x0cc\x1cd e f",
        base, base, *near, passage + " " + prose(80), prose(70) + " " + passage + " " + prose(30), passage.upper(),
        "same line\nsame line\nother\n\nsame line\n", prose(20) + "\n" + prose(20), prose(5000), prose(35), prose(34),
        "mail me at a.b@c.example.org, or 10.0.0.1 / 999.1.1.1; +1 (705) 555-5569", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "é" * 50 + " 1.2.3.4.5.6.7.8 x@y@z.com " + "9" * 40, "<b>not & markup</b> #*$%&|<>",
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, long and repeated texts, ties, a null id, clashing columns."""
    texts = odd_texts()
    langs = ["en", "de", None]
    rows = [(i, t, langs[i % 3], f"s{i % 2}", None if t is None else len(t), *["x"] * len(EXTRA)) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, "a text without id", "en", None, None, *[None] * len(EXTRA)), (None, None, None, None, None, *[None] * len(EXTRA))]
    names = "doc_id int, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("1 = 0")
