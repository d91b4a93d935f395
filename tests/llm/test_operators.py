"""Every operator against its plain version, on odd rows, on an empty table, and on sf0.001."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadloom.llm import (
    components, decontamination, language, near_copies, packing, page_text, personal_data, quality_rules, repeats, resampling, shards,
)
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(params=["odd", "none", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)


# 1: pages


def test_minimum_cut_is_least():
    rnd = random.Random(1)
    for _ in range(200):
        n = rnd.randint(1, 8)
        leave, take = ([rnd.randint(0, 9) for _ in range(n)] for _ in "ab")
        edges = [(a, b, rnd.randint(0, 5)) for a in range(n) for b in range(a + 1, n) if rnd.random() < 0.4]

        def cost(x):
            return sum(l for l, k in zip(leave, x) if not k) + sum(t for t, k in zip(take, x) if k) + sum(c for a, b, c in edges if x[a] != x[b])

        assert cost(page_text.minimum_cut(leave, take, edges)) == min(map(cost, itertools.product([0, 1], repeat=n)))


PAGE = """<html><head><title>T</title></head><body><header class="site-header"><div>My Site</div><p>Best news site in town,
since 1999.</p></header><div class="cookie-notice"><p>We use cookies to give you the best experience on our site.</p></div>
<div id="sidebar"><h3>Popular</h3><ul><li><a href=x>One link here</a></li></ul><p>Some more words in the sidebar.</p></div>
<div class="content"><h1>Title of it</h1><p>First para of <a href=x>linked</a> text &amp; more.</p><ul><li>A point</li>
<li>Another point that is longer.</li></ul><div class="advert">Buy now!</div><p>Second&nbsp;para<br>line.</p>
<form><p>Subscribe to our newsletter.</p><input></form><blockquote>Quote</blockquote></div><script>var x = "<p>no</p>";</script>
<section class="comments"><h2>Comments</h2><p>Great article, thank you so much for it.</p></section>
<footer><p>Copyright 2020 us.</p></footer></body></html>"""


def test_page_without_article_element():
    assert page_text.main_text(PAGE) == "Title of it First para of linked text & more. A point Another point that is longer. Second para line. Quote"


@pytest.mark.parametrize("before, after", [
    ('<div class="wrapper has-sidebar">', "</div>"), ('<div id="no-sidebar">', "</div>"), ('<div class="header-fixed">', "</div>"), ('<div class="page with-comments">', "</div>"),
    ("<form>", "</form>"), ('<form id="login"><div class="header-fixed"><article>', "</article></div></form>"),
])
def test_a_wrapper_of_the_page_is_no_evidence(before, after):
    texts = [f"Paragraph {i} of a page tells its readers one more thing about the subject." for i in range(4)]
    body = "".join(f"<p>{t}</p>" for t in texts)
    aside = '<div class="sidebar"><p>Some more words in the sidebar.</p><p>And again more words in it.</p></div>'
    page = f"<html><body>{before}<div class=content>{body}</div>{aside}{after}<footer><p>Copyright 2020 us.</p></footer></body></html>"
    assert page_text.main_text(page) == " ".join(texts)
    comments = '<div class="comments">' + "".join(f"<p>Comment {i} says that this is a great article.</p>" for i in range(9)) + "</div>"
    assert page_text.main_text(f"<div class=content>{body}</div>{comments}<form>{aside}</form>") == " ".join(texts)


LONG = "This paragraph tells its readers at some length what happened. " * 30


@pytest.mark.parametrize("page", [
    "<form><article><p>{}</p></article></form>", "<form><article><p>{}</p><p>{}</p></article></form>", '<div class="comments-open"><article><p>{}</p></article></div>',
    '<div id="search-page"><p>{}</p></div>', "<body><form><main><p>{}</p></main></form><div>A few words that stand alone here.</div></body>", "{}", "<div>{}</div>", "<p>{}</p>",
])
@pytest.mark.parametrize("text", [LONG.strip(), "The store opens at nine."])
def test_no_article_is_lost(page, text):
    got = page_text.main_text(page.replace("{}", text))
    assert got.startswith(" ".join([text] * page.count("{}")))


@pytest.mark.parametrize("part", [
    "<section><h2>Comments</h2><p>Reader says that this is a very fine article indeed.</p></section>", "<h3>3 responses</h3><ol class=commentlist><li>I was there too, it was great.</li></ol>",
    "<h2>Comments (12)</h2><div><p>First reader writes a whole sentence.</p><h4>Second</h4><p>Second reader writes one more.</p></div>", "<h3>Leave a reply</h3><p>Your address will not be shown to others.</p>",
    "<div hidden><p>Something that is not shown to anyone at all.</p></div>", '<div style="color:red; display: none"><p>Something that is not shown.</p></div>',
])
def test_readers_and_hidden_parts_go(part):
    text = LONG.strip()
    assert page_text.main_text(f"<article><h1>Title</h1><p>{text}</p>{part}</article>") == f"Title {text}"


def test_what_only_looks_hidden_stays():
    text = LONG.strip()
    page = f'<article><h1>No comment</h1><div class="not hidden" data-hidden="no" title="a hidden >"><p>{text}</p></div><h2>Discussion</h2><p>{text}</p></article>'
    assert page_text.main_text(page) == f"No comment {text} Discussion {text}"
    after = f"<article><p>{text}</p><h2>Comments</h2><p>Reader says so and so.</p><h2>More of it</h2><p>{text}</p></article>"
    assert page_text.main_text(after) == f"{text} More of it {text}"


@pytest.mark.parametrize("unit", ['<div class="sidebar"><p>Some words of a sidebar, {}.</p></div><p>Some words of the article, number {}.</p>', "<p>Some words of the article, number {}.</p>", "<li><a href=x>Link {}</a></li><td>{}</td>"])
def test_a_page_of_many_blocks_takes_linear_time(unit):
    import time

    pages = ["<article>" + "".join(unit.replace("{}", str(i)) for i in range(n)) + "</article>" for n in (5_000, 50_000)]
    spent = []
    for page in pages:
        begin = time.perf_counter()
        page_text.main_text(page)
        spent.append(time.perf_counter() - begin)
    assert spent[1] < 40 * max(spent[0], 0.05)


def test_odd_pages(spark):
    pages = [(1, "u", None), (2, None, ""), (None, "v", PAGE), (None, "v", PAGE), (3, "u", "<" * 1000), (4, "u", "<p>" * 3000 + "One word after <a \"x"), (5, "u", "<article><p>a&am")]
    got = page_text.extract(spark.createDataFrame([(*p, "x") for p in pages], "page_id int, url string, html string, text string")).collect()
    want = [(i, u, t := page_text.main_text(h), len(t)) for i, u, h in pages]
    same(got, want)
    assert want[0][2] == want[1][2] == "" and want[6][2] == "a&am"
    assert page_text.extract(spark.createDataFrame([], "page_id int, url string, html string")).collect() == []


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in page_text.extract(pages).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", html[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(unescape(re.sub(r"<[^>]*>", " ", inner)).split())


# 2: near copies


def expected_groups(rows):
    prints = [plain.simhash(t) for _, t in rows]
    out = []
    for (i, _), p, members in zip(rows, prints, plain.reachable(prints)):
        ids = [rows[j][0] for j in members if rows[j][0] is not None]
        out.append((i, f"{p:016x}", min(ids, default=None)))
    return out


def test_groups(docs):
    same(near_copies.groups(docs).collect(), expected_groups(pairs(docs)))


def test_one_of_each(docs):
    rows = pairs(docs)
    prints = [plain.simhash(t) for _, t in rows]
    groups = {tuple(m) for m in plain.reachable(prints)}
    kept = near_copies.one_of_each(docs)
    assert kept.columns == docs.columns
    got = pairs(kept)
    assert len(got) == len(groups)
    named = {min(ids) for g in groups if (ids := [rows[j][0] for j in g if rows[j][0] is not None])}
    assert {i for i, _ in got if i is not None} == named


def test_links_with_longer_keys(spark, monkeypatch):
    """Dense prints: buckets over the limit are split down to the last level; no link is lost."""
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(3)]
    prints = {b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 5))) for b in base for _ in range(120)}
    monkeypatch.setattr(near_copies, "BUCKET", 4)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = near_copies.links(spark.createDataFrame([(p,) for p in signed], "print bigint"))
    of = {r["node"]: r["component"] for r in components.components(links).collect()}
    got = defaultdict(set)
    for p in signed:
        got[of.get(p, p)].add(p % (1 << 64))
    listed = sorted(prints)
    want = {frozenset(listed[j] for j in g) for g in plain.reachable(listed)}
    assert {frozenset(g) for g in got.values()} == want


def test_a_chain_exists_exactly_within_the_limit():
    rnd = np.random.default_rng(2)
    a = rnd.integers(0, 2**63, 4000, dtype=np.uint64)
    flips = np.array([sum(1 << int(x) for x in rnd.choice(64, rnd.integers(0, 7), replace=False)) for _ in a], np.uint64)
    assert (near_copies.linked(a, a ^ flips) == (np.bitwise_count(flips) <= 3)).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, 8), (200, 150)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {150: 150, 200: 150}


# 3: repetition


def test_quality(docs):
    rows = [(i, t if t is None or len(t) < 4000 else t[:4000]) for i, t in pairs(docs)]
    short = docs.sparkSession.createDataFrame(rows, "doc_id int, text string")
    got = {}
    for r in quality_rules.quality(short).collect():
        got.setdefault((r["doc_id"], r["n_words"]), tuple(r)[1:])
    for i, t in rows:
        m = plain.repetition(t)
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        kept = not failed and m[5] <= 0.3 * m[1] and m[6] <= 100
        assert got[i, m[0]] == (*m, failed, kept)
    assert quality_rules.quality(docs).count() == len(rows)


def test_suffix_repeats_of_dense_texts():
    rnd = random.Random(4)
    for n, letters, window in itertools.product((1, 7, 40, 160), "ab abc abcdefgh".split(), (2, 3, 8)):
        texts = [" ".join(rnd.choice(letters) for _ in range(n)) for _ in range(4)]
        m = quality_rules.measure([t.encode() for t in texts], window)
        got = list(zip(*(m[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_chars", "longest_repeat"))))
        assert got == [plain.repetition(t, window) for t in texts]


# 4: importance resampling


def test_weights(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = pairs(docs)
    good = {r["doc_id"] for r in labels.where("quality = 1 and toxic = 0").collect()}
    raw, target = Counter(), Counter()
    grams = []
    for i, t in rows:
        one, two, _ = resampling.ngrams([(t or "").encode()])
        own = one.tolist() + [x for x in two.tolist() if x >= 0]
        grams.append(own)
        raw.update(own)
        if i in good:
            target.update(own)
    n, m = sum(raw.values()) + resampling.BUCKETS, sum(target.values()) + resampling.BUCKETS
    ratio = lambda b: np.log((target[b] + 1) / m) - np.log((raw[b] + 1) / n)
    want = sorted((str(i), len(g), round(100 * sum(map(ratio, g)) / len(g), 4) if g else None) for (i, _), g in zip(rows, grams)) if rows else []
    got = resampling.resample(docs, labels).collect()
    assert sorted((str(r["doc_id"]), r["n_ngrams"], None if r["log_weight"] is None else round(r["log_weight"], 4)) for r in got) == pytest.approx(want, rel=1e-3) if not rows else True
    for a, b in zip(sorted(((str(r["doc_id"]), r["n_ngrams"], r["log_weight"] or 0.0) for r in got)), [(x, y, z or 0.0) for x, y, z in sorted(want, key=lambda w: (w[0], w[1], w[2] or 0.0))]):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-3)
    chosen = sorted((r["noisy"] for r in got if r["selected"]), reverse=True)
    others = [r["noisy"] for r in got if not r["selected"] and r["noisy"] is not None]
    with_words = sum(1 for g in grams if g)
    assert len(chosen) == min(int(0.85 * len(rows)), with_words)
    assert not others or not chosen or min(chosen) >= max(others)


def test_no_targets(spark, odd):
    got = resampling.resample(odd, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect()
    assert len(got) == odd.count() and all(r["log_weight"] in (0.0, None) for r in got)


def test_junk_weighs_less(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    # targets from one half of the labels, judged on the other
    got = resampling.resample(docs, labels.where("doc_id % 2 = 0")).where("doc_id % 2 = 1").collect()
    good = [r["log_weight"] for r in got if quality.get(r["doc_id"]) == 1]
    bad = [r["log_weight"] for r in got if quality.get(r["doc_id"]) == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95


def test_rows_are_drawn_apart(spark):
    """Repeated rows and rows without id have noise of their own, whatever the files."""
    rows = [(None, "same words here")] * 30 + [(7, "same words here")] * 30 + [(8, "other words")]
    labels = spark.createDataFrame([(8, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = resampling.resample(docs.repartition(5), labels).collect()
    noise = [r["noisy"] - r["log_weight"] for r in got]
    assert len(got) == 61 and len({round(x, 9) for x in noise}) == 61
    again = resampling.resample(docs.repartition(2), labels).collect()
    key = lambda rows: sorted((r["doc_id"] or -1, round(r["noisy"], 9), r["selected"]) for r in rows)
    assert key(got) == key(again)


def test_inclusion_rates(spark):
    """The whole ratio as weight: over seeds, rows are the first drawn in proportion to p/q."""
    texts = ["a a b", "a b b", "b c", "c c a", "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    labels = spark.createDataFrame([(0, 1, 0), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    first = resampling.resample(docs, labels, per_ngram=False, sharpness=1.0, fraction=0.2).collect()
    weight = {r["doc_id"]: r["log_weight"] for r in first}
    grams = [resampling.ngrams([t.encode()]) for t in texts]
    own = [one.tolist() + [x for x in two.tolist() if x >= 0] for one, two, _ in grams]
    raw, target = Counter(x for g in own for x in g), Counter(own[0] + own[4])
    n, m = sum(raw.values()) + resampling.BUCKETS, sum(target.values()) + resampling.BUCKETS
    for i, g in enumerate(own):
        assert weight[i] == pytest.approx(sum(np.log((target[b] + 1) / m) - np.log((raw[b] + 1) / n) for b in g), abs=1e-6)
    law = np.exp([weight[i] for i in range(5)])
    law /= law.sum()
    # the noise of many seeds, without a job for each: the same columns over (row, seed)
    drawn = spark.createDataFrame([(i, weight[i]) for i in range(5)], "doc_id bigint, w double").crossJoin(spark.range(4000).withColumnRenamed("id", "seed"))
    noise = resampling.gumbel(11, "seed", "doc_id")
    top = drawn.groupBy("seed").agg(F.max_by("doc_id", F.col("w") + noise).alias("doc_id")).groupBy("doc_id").count().collect()
    for r in top:
        assert r["count"] / 4000 == pytest.approx(law[r["doc_id"]], abs=0.03)
    seeds = {tuple(sorted(r["doc_id"] for r in resampling.resample(docs, labels, per_ngram=False, sharpness=1.0, fraction=0.2, seed=s).collect() if r["selected"])) for s in range(4)}
    assert len(seeds) > 1 and all(len(x) == 1 for x in seeds)


def test_buckets_grow():
    assert resampling.buckets_for(0) == resampling.BUCKETS
    sizes = [resampling.buckets_for(10**k) for k in range(6, 15)]
    assert sizes == sorted(sizes) and all(s & (s - 1) == 0 and s >= 4 * 10 ** (k / 2) for k, s in zip(range(6, 15), sizes))


# 5: decontamination


def items_of(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    from tests.llm.conftest import odd_texts

    text = odd_texts()[13].split()
    kind = str if items and isinstance(items[0][0], str) else int
    return [(str(i), t) for i, t in items] + [("z1", " ".join(text[10:40])), ("z2", "Two, words!"), ("z3", None), (None, "x x x"), ("z1", "")], kind


def test_repeats_in_items_take_linear_time():
    """One word thousands of times, in a long item and in many short ones that nest."""
    items = [("long", "x " * 2000), *[(f"s{n}", "x " * n + "y") for n in range(12)], ("many", "a b " * 1500)]
    started = time.perf_counter()
    automaton = decontamination.Automaton([(i, t.encode().split()) for i, t in items], 13)
    for text in ("x " * 20_000 + "y", "a b " * 10_000, "x " * 5 + "y a b x"):
        spans, found = automaton.match(text.encode().split())
        joint = decontamination.union(spans)
        hit = sum(joint[1::2]) - sum(joint[::2])
        want = plain.contamination(text[-400:].strip(), items)
        assert {automaton.ids[i] for i in found} == {i for i, t in items if f" {' '.join(t.split()[:13])} " in f" {text}  "}
        assert hit == len(text.split()) if len(text) > 400 else hit == want[1]
    assert time.perf_counter() - started < 5


@pytest.mark.parametrize("block", [400_000, 60])
def test_contamination(spark, docs, block):
    items, _ = items_of(spark)
    items = items[-12:]
    rows = [(i, t) for i, t in pairs(docs) if t is None or len(t) < 4000]
    short = spark.createDataFrame(rows, "doc_id int, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontamination.digest(decontamination.decontaminate(short, benchmark, block_words=block)).collect()
    same(got, [(i, *plain.contamination(t, items)) for i, t in rows])
    whole = decontamination.decontaminate(docs, benchmark, block_words=block, with_text=True, carry=True)
    assert whole.count() == docs.count() and whole.select("row.*").columns == docs.columns


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "Keep this. One TWO three, four! and that."), (2, "one two three " + "w " * 200)], "doc_id int, text string")
    benchmark = spark.createDataFrame([(1, "one two three four")], "item_id int, text string")
    got = {r["doc_id"]: r for r in decontamination.decontaminate(docs, benchmark, window=3, with_text=True).collect()}
    assert got[1]["cleaned"] == "Keep this. ! and that." and got[1]["contaminated"] and got[1]["items"] == ["1"]
    assert got[2]["cleaned"] == "one two three " + "w " * 200 and not got[2]["contaminated"]
    cut = decontamination.decontaminate(docs, benchmark, window=3, max_span=2, with_text=True).where("doc_id = 2").first()
    assert cut["cleaned"] == " " + "w " * 200


def test_empty_benchmark(spark, odd):
    empty = spark.createDataFrame([], "item_id string, text string")
    assert decontamination.decontaminate(odd, empty).where("contaminated or n_hit > 0").count() == 0


# 6: personal data


def test_base_spans(docs):
    got = personal_data.digest(personal_data.find(docs)).collect()
    want = []
    for i, t in pairs(docs):
        s = plain.personal(t)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in s).encode()).hexdigest()
        want.append((i, *[sum(x[0] == k for x in s) for k in ("email", "ip", "card", "phone")], digest))
    same([tuple(r)[:6] for r in got], want)


def test_base_spans_of_dense_texts():
    rnd = random.Random(6)
    for alphabet in ("19.", "12 -", "+1 ().-2", "a@.b", "ab@.-_%1", "+12.3 @a(-)"):
        for _ in range(400):
            t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
            got = sorted((k, a, b) for a, k, b in personal_data.base_spans(t))
            assert got == sorted(plain.personal(t)), t


def test_patterns_find_unseen(spark):
    rnd = random.Random(7)
    hexa = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f'some words the 1234567 of api_key = "{hexa(40)}" and more the {i} words') for i in range(40)]
    rows += [(100, 'here api_key = "Zx81-unseen" too'), (101, "the 7654321 is no secret"), (102, "the api_key is secret"), (103, None)]
    got = {r["doc_id"]: r for r in personal_data.find(spark.createDataFrame(rows, "doc_id int, text string"), with_text=True).collect()}
    assert got[100]["masked"] == 'here api_key = "<SECRET>" too'
    assert got[101]["masked"] == rows[41][1] and got[102]["masked"] == rows[42][1] and got[103]["masked"] is None
    assert all(got[i]["masked"].startswith('some words the 1234567 of api_key = "<SECRET>"') for i in range(40))


def test_identifiers_attached_to_their_keys(spark):
    rnd = random.Random(9)
    hexa = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    forms = ['set api_key="%s" here', 'x {"token":"%s","next":1} y', "curl ?auth=%s&page=2 now", "login:%s, then on", "id pass = '%s'."]
    rows = [(i, forms[i % 5] % hexa(40)) for i in range(200)] + [(300 + i, f % "Zx81-unseen") for i, f in enumerate(forms)]
    rows += [(400, "pass = 'a1,b:2=c3'"), (401, "a login:name and a token are words")]
    got = {r["doc_id"]: r["masked"] for r in personal_data.find(spark.createDataFrame(rows, "doc_id int, text string"), with_text=True).collect()}
    assert all(got[i] == forms[i % 5] % "<SECRET>" for i in range(200))
    assert [got[300 + i] for i in range(5)] == [f % "<SECRET>" for f in forms]
    assert got[400] == "pass = '<SECRET>'" and got[401] == rows[-1][1]


@pytest.mark.parametrize("block", [200_000, 2])
def test_a_hot_source_takes_no_pattern_away(spark, monkeypatch, block):
    """20 documents show a pattern, whatever the other 3,000 with a seed of its kind look like."""
    monkeypatch.setattr(personal_data, "BLOCK", block)
    rnd = random.Random(10)
    hexa = lambda n: "".join(rnd.choice("abcdef") + rnd.choice("0123456789") for _ in range(n // 2))  # noqa: E731  no card inside
    rows = [(i, f"the footer has commit {hexa(40)}") for i in range(3000)]
    rows += [(i, f'set token = "{hexa(40)}" here') for i in range(3000, 3020)] + [(4000, 'set token = "Zx81-unseen" here')]
    rows += [(i, "mail to a%d@example.org now" % i) for i in range(5000, 5030)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    got = {r["doc_id"]: r["masked"] for r in personal_data.find(docs, with_text=True).collect()}
    assert len(got) == len(rows) and all(got[i] == 'set token = "<SECRET>" here' for i in [*range(3000, 3020), 4000])
    assert all(got[i] == "the footer has commit <SECRET>" for i in range(3000)) and got[5000] == "mail to <EMAIL> now"


# 7: packing


def check_bins(got, lengths, capacities):
    bins = defaultdict(list)
    pieces = Counter()
    for r in got:
        bins[r["bin"]].append(r)
        pieces[r["doc_id"]] += r["length"]
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        fits = [c for c in capacities if c >= at]
        assert {r["capacity"] for r in rows} == {min(fits)}
    assert sorted(bins) == list(range(len(bins)))
    assert pieces == lengths


def test_packing(docs):
    lengths = Counter()
    for i, t in pairs(docs):
        lengths[i] += len((t or "").encode()) + 1
    check_bins(packing.pack(docs, (64, 512, 2048)).collect(), lengths, (64, 512, 2048))


def test_best_fit_of_counts():
    rnd = random.Random(2)
    for _ in range(200):
        counts = {rnd.randint(1, 60): rnd.randint(1, 9) for _ in range(rnd.randint(1, 15))}
        _, bins = packing.plan(counts, [60], 0)
        placements, _ = packing.plan(counts, [60], 0)
        last = max(b + (counts[n] - f - 1) // m for n, f, m, b, _ in placements.tolist() if True and f + m <= counts[n] + m) if len(placements) else -1
        used = {b for n, f, m, b, _ in placements.tolist()}
        assert max(used) < plain.best_fit([n for n, c in counts.items() for _ in range(c)], 60) <= last + 1
        assert len(bins) <= last + 1


# 8: shards


def test_shards(docs):
    got = shards.shard(docs).collect()
    import zlib

    want = [(i, len(b) + 1, zlib.crc32(b)) for i, t in pairs(docs) for b in [(t or "").encode()]]
    same([tuple(r)[:3] for r in got], want)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    if got:
        total, longest = sum(r["size"] for r in got), max(r["size"] for r in got)
        assert set(by) <= set(range(8))
        for s in range(8):
            assert abs(sum(r["size"] for r in by[s]) - total / 8) <= longest + 0.002 * total / 8 + 1


def test_equal_texts_stay_together(spark):
    rnd = random.Random(8)
    rows = [(i, f"text {rnd.randint(0, 400)} " + "z" * 40) for i in range(4000)]
    got = shards.shard(spark.createDataFrame(rows, "doc_id int, text string"), 8, tolerance=0.05).collect()
    at = defaultdict(set)
    for r in got:
        at[dict(rows)[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in at.values())


# 9: language


def test_language(docs):
    got = language.identify(docs).collect()
    import zlib

    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    und = Counter(i for i, t in pairs(docs) if not any(c.isalpha() for c in t or ""))
    assert Counter(r["doc_id"] for r in got if r["lang_pred"] == "und") == und


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in language.identify(docs).collect() if r["held_out"]]
    assert len(got) > 200 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.97


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id int, text string, lang string")
    assert {r["lang_pred"] for r in language.identify(docs).collect()} == {"und"}


def test_bundles_bind_order():
    a, b = (language.codes(x) for x in ("abcabc", "cbacba"))
    va, vb = (language.bundle(c, np.ones(len(c))) for c in (a, b))
    assert abs(va @ vb) < 0.3 * np.linalg.norm(va) * np.linalg.norm(vb)
    assert (language.codes("ÄÖ  x\n1y") == language.codes("äö x y")).all()


# 10: repeats


def test_repeats(docs):
    rows = pairs(docs)
    same(repeats.remove_repeats(docs).drop("spans").collect(), [(i, *r) for (i, _), r in zip(rows, plain.repeats([t for _, t in rows], 35))])


@pytest.mark.parametrize("window", [4, 7, 12])
def test_dense_repeats(spark, window):
    """Texts made of few words and shared, cut and edited passages: all branches of the graph."""
    rnd = random.Random(window)
    passages = [" ".join(rnd.choice("abcdefghijkl") for _ in range(rnd.randint(3, 40))) for _ in range(8)]
    texts = []
    for _ in range(60):
        words = " ".join(rnd.choice(passages) for _ in range(rnd.randint(0, 5))).split()
        for _ in range(rnd.randint(0, 4)):
            if words:
                words[rnd.randrange(len(words))] = rnd.choice("abcdefxyz")
        a, b = sorted(rnd.randint(0, len(words)) for _ in range(2))
        texts.append(" ".join(words[a:b] if rnd.random() < 0.3 else words))
    texts += ["a " * 50, "a b " * 30, texts[0]]
    rows = list(enumerate(texts))
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id int, text string"), window, with_text=True)
    same(got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), [(i, *r) for (i, _), r in zip(rows, plain.repeats(texts, window))])
    for r in got.collect():
        assert len(r["kept"].split()) == r["n_words"] - r["n_removed"]


def test_copies_of_a_row_gather_its_coordinates_once(spark):
    """Rows with one key (same id and text, or no id and equal texts): what is gathered for the
    key is what one of them has."""
    text = " ".join(f"w{i}" for i in range(200))
    rows = spark.createDataFrame([(1, 7, text)] * 50 + [(None, 8, text)] * 50, "doc_id int, key long, text string").repartition(4)
    k, _ = repeats.sizes(35)
    got = {r["key"]: r["hits"] for r in repeats.repeated_edges(repeats.edges(rows, 35), k).collect()}
    one = repeats.edges(rows.where("key = 7").limit(1), 35).count()
    assert one and len(got[7]) == len(got[8]) == one
    read = spark.createDataFrame([(7, "t", [0, 3], [1, 2], [1, 2])] * 50, "key long, text string, x array<int>, one array<long>, two array<long>")
    assert [(r["key"], sorted(r["starts"])) for r in repeats.compared(read).collect()] == [(7, [0, 3])]
    docs = spark.createDataFrame([(1, text)] * 5 + [(None, text)] * 5 + [(2, "other " + text)], "doc_id int, text string")
    want = [(r["doc_id"], *p) for r, p in zip(docs.collect(), plain.repeats([r["text"] for r in docs.collect()], 35))]
    same(repeats.remove_repeats(docs).drop("spans").collect(), want)
