"""Hard negatives, conversations and token counts against their plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadloom.llm import conversations, hard_negatives, token_counts
from quadloom.llm.queries import QUERIES
from tests.llm import plain
from tests.llm.conftest import odd_texts

SMALL = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


# 11: hard negatives


def odd_vectors() -> list[tuple]:
    """Ties, repeated rows, null ids, labels, vectors and components, other lengths, huge numbers."""
    rnd = random.Random(2)
    cell = lambda: rnd.choice([0.5, -0.25, 0.01, 1.0, 0.0])
    rows = [(rnd.choice([None, 0, 50, 100, rnd.randint(1, 99)]), [cell() for _ in range(rnd.choice([3, 3, 3, 0, 20]))], rnd.choice([None, 1, 2])) for _ in range(200)]
    rows += [rows[5]] * 3 + [(7, None, 1), (8, [None, 1.0, 1.0], 1), (9, [float("nan"), 1.0, 1.0], 2), (150, [float("inf"), 1.0, 1.0], 2)]
    rows += [(200, [3e38, 1.0, 1.0], 2), (201, [3e38, 2.0, 1.0], 2), (203, [1e30, 2.0, 1.0], 1), (300, [3e15, 1.0, 1.0], 2), (302, [2e15, 0.5, 1.0], 1)]
    single = lambda v: None if v is None else [None if x is None else float(np.float32(x)) for x in v]
    return [(i, single(v), l) for i, v, l in rows]


@pytest.mark.parametrize("block, at_once", [(1 << 23, 512), (40, 16)])
def test_hard_negatives_of_odd_rows(spark, monkeypatch, block, at_once):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ROWS_AT_ONCE", at_once)
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, number int, cells string")
    same(hard_negatives.mine(df, "vec_id % 50 = 0").collect(), plain.hard_negatives(rows))
    assert hard_negatives.mine(df.where("1 = 0"), "vec_id % 50 = 0").collect() == []


def test_hard_negatives_of_the_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    same(QUERIES["op11_hard_negatives"](spark, SMALL).collect(), plain.hard_negatives(rows))


def test_bounds_hold_and_get_tighter():
    rnd = np.random.default_rng(3)
    for size in (1, 3, 4, 16, 64, 70):
        cells = np.floor(rnd.normal(size=(60, size)) * 100)
        v = hard_negatives.Vectors(*[np.arange(60)] * 2, np.zeros(60, bool), np.zeros(60, int), cells, hard_negatives.summaries(cells))
        exact, widths = hard_negatives.scores(v, v), []
        for level in hard_negatives.spans(size):
            low, high = hard_negatives.bounds(v, v, level)
            assert (low <= exact).all() and (exact <= high).all()
            widths.append(float((high - low).mean()))
        assert widths == sorted(widths, reverse=True)


def test_bounds_leave_pairs_out():
    """On vectors in groups most pairs fall to a bound; every score left out is too low."""
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(8, 64)) * 100
    cells = np.floor(np.concatenate([c + rnd.normal(size=(200, 64)) * 5 for c in centres]))
    label = np.zeros(len(cells), int)
    order = rnd.permutation(len(cells))
    rows = hard_negatives.Vectors(np.arange(len(cells)), np.arange(len(cells)), np.zeros(len(cells), bool), label, cells, hard_negatives.summaries(cells)).part(order)
    looking, counts = hard_negatives.Positives(rows.part(slice(0, 50)), 5), hard_negatives.Counts()
    for i in range(0, len(cells), 100):
        hard_negatives.compare(looking, rows.part(slice(i, i + 100)), counts)
    assert counts.pairs[0] > 5 * counts.pairs[-1] and counts.pairs == sorted(counts.pairs, reverse=True)
    exact = rows.cells[:50] @ rows.cells.T
    exact[np.arange(50), np.arange(50)] = -np.inf
    assert sorted(looking.best.kept[1].tolist()) == sorted(np.sort(exact, axis=1)[:, -5:].ravel().astype(int).tolist())


# 12: conversations


def odd_turns() -> list[tuple]:
    rows = [(1, None, None, None), (1, None, "user", "x?"), (None, 1, "user", "a."), (None, 2, "", "q."), (None, 2, "", "q."), (2, 5, "tool", "x!"),
            (2, 9, "assistant", " y. \n"), (3, 1, "system", "s."), (3, 1, "user", "é"), (3, 1, "user", "é"), (6, 0, "user", " \t\x0b"), (7, 3, "system", "Alone.")]
    return rows + [(4, i, "user" if i % 3 else "assistant", f"t{i % 50}.") for i in range(300)] + [(5, i % 9, ("user", "assistant", "system")[i * 7 % 3], "same text") for i in range(60)]


@pytest.mark.parametrize("block_rows", [None, 1, 7])
@pytest.mark.parametrize("given", ["odd", "table", "none"])
def test_repairs(spark, given, block_rows):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet") if given == "table" else spark.createDataFrame(
        [(*r, "x", 1) for r in odd_turns()], "conv_id bigint, turn bigint, role string, text string, c string, position int").where(F.lit(given == "odd"))
    turns = plain.damaged([tuple(r)[:4] for r in df.collect()])
    got = conversations.digest(conversations.damage(df), df, block_rows=block_rows).collect()
    same(got, [(c, *plain.repaired(t)) for c, t in turns.items()])


def test_the_query_of_conversations(spark):
    turns = plain.damaged([tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()])
    same(QUERIES["op12_conversations"](spark, SMALL).collect(), [(c, *plain.repaired(t)) for c, t in turns.items()])


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Still there?"), (1, 2, "assistant", "Yes"), (1, 3, "assistant", "Yes"), (2, 0, "system", "Be kind.")]
    got = sorted(map(tuple, conversations.repair(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()))
    # inserting a turn costs as much as a new role, and I comes before R, but a new role leaves the rest wrong
    assert got == [("1", 0, "K", "user", "Hello."), ("1", 1, "I", "assistant", ""), ("1", 2, "K", "user", "Still there?"), ("1", 3, "K", "assistant", "Yes"),
                   ("1", 4, "D", "assistant", "Yes"), ("2", 0, "D", "system", "Be kind.")]


def test_a_walk_is_cheapest_for_all_short_codes():
    """Blocks of any size give the same walk, and its cost is the one found going back."""
    rnd = random.Random(6)
    for _ in range(300):
        codes = bytes(rnd.choice([0, 1, 2, 3, 4, 5, 9, 10]) for _ in range(rnd.randint(1, 40)))
        front = conversations.checkpoints(codes, conversations.END, len(codes))[0]
        letters, state = conversations.walk(codes, 0, conversations.END)
        cost, s = 0, 0
        for code, edits in zip(codes, letters):
            for x in edits[:-1]:
                cost, s = cost + 2, conversations.TURN[s]
            _, c, s = next(e for e in conversations.row_edits(code, s) if e[0] == edits[-1])
            cost += c
        assert s == state and cost + 2 * len(conversations.closing(state)) == front[0]
        cut = rnd.randint(0, len(codes))
        behind = conversations.checkpoints(codes[cut:], conversations.END, len(codes))[0] if cut < len(codes) else conversations.END
        first, middle = conversations.walk(codes[:cut], 0, behind) if cut else ([], 0)
        rest = conversations.walk(codes[cut:], middle, conversations.END)[0] if cut < len(codes) else []
        assert first + rest == letters


# 13: token counts


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


LETTERS = [" ", "  ", "a", "e", "er", "in", "the", "ing", "\n", "\t", "é", "日本", "ö", "▁", "<s>", "</s>", "1", "22", "\x00", "😀", "oo", "ss", "-", "==", "x", "﻿"]


def test_counts_of_all_prefixes(library):
    pieces, rnd = token_counts.Pieces(open(MODEL, "rb").read()), random.Random(7)
    for _ in range(150):
        text = "".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 25)))
        want = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        got = pieces.read(text)
        assert got.all().tolist() == want and [got.tokens(i) for i in range(len(text) + 1)] == want and got.total == want[-1]
        for budget in range(0, want[-1] + 3):
            assert got.within(budget) == max(i for i, n in enumerate(want) if n <= budget)


@pytest.mark.parametrize("text", ["a" * 30000, " " * 20000, "日" * 5000, "ab" * 10000, "=-" * 9999])
def test_long_texts_without_a_break(library, text):
    assert token_counts.Pieces(open(MODEL, "rb").read()).read(text).total == len(library.encode(text))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_counts_of_the_table(spark, library, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()}
    for r in QUERIES["op13_token_counts"](spark, f"/root/testdata/{folder}").collect():
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
        assert len(library.encode(texts[r.doc_id][: r.fits_chars])) <= 4096 and (r.over_limit or r.fits_chars == len(texts[r.doc_id]))


def test_counts_of_odd_rows(spark, odd, none, library):
    got = token_counts.count_tokens(odd, MODEL, limit=40, budgets=[0, 5], carry=True).collect()
    assert len(got) == odd.count() == len(odd_texts()) + 4
    for r in got:
        text = r.row.text or ""
        assert r.n_tokens == len(library.encode(text)) and r.over_limit == (r.n_tokens > 40) and r.n_bytes == len(text.encode())
        assert r.cuts[0] == 0 and all(len(library.encode(text[:cut])) <= b for cut, b in zip([r.fits_chars, *r.cuts], [40, 0, 5]))
    assert token_counts.count_tokens(none, MODEL).collect() == [] == token_counts.prefix_counts(none, MODEL).collect()


def test_the_stored_form_answers(spark, odd, library):
    stored = token_counts.prefix_counts(odd.where("length(text) < 3000 or text is null"), MODEL)
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    asked = stored.where("doc_id is not null").select("doc_id", token_counts.tokens_of(F.lit(7)).alias("seven"), token_counts.longest_within(F.lit(6)).alias("fits"))
    for r in asked.collect():
        text = texts[r.doc_id]
        assert r.seven == len(library.encode(text[:7]))
        assert r.fits == max(i for i in range(min(len(text), 200) + 1) if len(library.encode(text[:i])) <= 6)
