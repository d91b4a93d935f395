"""Benchmark decontamination with a generalised suffix automaton over words.

Every block of benchmark items becomes one automaton of their normalised words. Documents
stream through it: each word moves to the state of the longest suffix of the document so far
that occurs in some item, a word no item has goes back to the start. Where that longest match
reaches `window` words, the window ending there lies in an item; items shorter than a window
are found whole, through the suffix links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quadloom.llm.tables import carried, carried_on, schema_of, text_of
from quadloom.llm.words import byte_texts
from quadloom.plans.cut import written

#: A-Z lower-cased, bytes `[\x00-\x2F\x3A-\x60\x7B-\x7F]` to blanks.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(rb"[0-9a-zA-Z\x80-\xff]+")
#: Benchmark words of one automaton; more items make more automata, one pass each.
BLOCK_WORDS = 400_000


class Automaton:
    """Generalised suffix automaton of items (id, words), packed into arrays."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        texts = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        self.ids = [i for i, _ in items]
        self.shortest = min((min(len(t), window) for t in texts if t), default=0)
        moves: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        ends = []
        for t in texts:
            last = 0
            for c in t:
                last = self._extend(moves, link, length, last, c)
            ends.append(last)
        self.link, self.length = np.array(link, np.int32), np.array(length, np.int32)
        keys = np.array([(s << 32) | c for s, m in enumerate(moves) for c in m], np.int64)
        to = np.array([v for m in moves for v in m.values()], np.int32)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], to[order]
        del moves
        self.whole: dict[int, list[tuple[int, int]]] = {}  # state: (words, item) of short items ending there
        for item, t in enumerate(texts):
            if 0 < len(t) < window:
                self.whole.setdefault(ends[item], []).append((len(t), item))
        self._settle_links()
        self.holders: dict[int, set[int]] = {}  # state of a window: items that have it
        for item, t in enumerate(texts):
            for _, state, size in self.walk(t):
                if size >= window:
                    self.holders.setdefault(int(self.window_state[state]), set()).add(item)

    @staticmethod
    def _extend(moves, link, length, last, c) -> int:
        """Add word `c` behind the state `last`; the state of the longer prefix."""

        def new(size, m, up):
            moves.append(m)
            length.append(size)
            link.append(up)
            return len(length) - 1

        def split(p, q):
            copy = new(length[p] + 1, dict(moves[q]), link[q])
            link[q] = copy
            while p != -1 and moves[p].get(c) == q:
                moves[p][c] = copy
                p = link[p]
            return copy

        q = moves[last].get(c)
        if q is not None:
            return q if length[q] == length[last] + 1 else split(last, q)
        state, p = new(length[last] + 1, {}, 0), last
        while p != -1 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p != -1:
            q = moves[p][c]
            link[state] = q if length[q] == length[p] + 1 else split(p, q)
        return state

    def _move(self, state: int, word: int) -> int:
        key = (state << 32) | word
        at = int(self.keys.searchsorted(key))
        return int(self.to[at]) if at < len(self.keys) and self.keys[at] == key else -1

    def _settle_links(self) -> None:
        """For every state, once: the state of the last `window` words of a match there, and the
        nearest state up its suffix links, itself included, at which a short item ends (0: none).
        A word of a document then looks at no more states than there are lengths below a window."""
        self.window_state = np.arange(len(self.link), dtype=np.int32)
        self.short_state = np.zeros(len(self.link), np.int32)
        for state in np.argsort(self.length, kind="stable")[1:].tolist():  # suffixes are shorter
            up = self.link[state]
            if self.length[up] >= self.window:
                self.window_state[state] = self.window_state[up]
            self.short_state[state] = state if state in self.whole else self.short_state[up]

    def walk(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, state, words matched) after each word of known words."""
        state, size = 0, 0
        for i, c in enumerate(words):
            to = self._move(state, c)
            while to < 0 and state:
                state = int(self.link[state])
                size = int(self.length[state])
                to = self._move(state, c)
            if to >= 0:
                state, size = to, size + 1
            yield i, state, size

    def match(self, words: list[bytes]) -> tuple[list[int], set[int]]:
        """Hit spans of a document, flat (start, end, start, end ...), and the items hit."""
        if not self.shortest or len(words) < self.shortest:
            return [], set()
        known = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        edge = np.diff(np.concatenate([[0], (known >= 0).astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= self.shortest  # an unknown word sends the automaton to its start
        spans, found, held = [], set(), set()
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            for i, state, size in self.walk(known[a:b].tolist()):
                if size >= self.window:
                    spans += (a + i + 1 - self.window, a + i + 1)
                    held.add(int(self.window_state[state]))
                if self.whole:
                    up = int(self.short_state[state])
                    while up > 0:
                        for n, item in self.whole[up]:
                            if n <= size:
                                spans += (a + i + 1 - n, a + i + 1)
                                found.add(item)
                        up = int(self.short_state[self.link[up]])
        return spans, found.union(*(self.holders[state] for state in held))


def blocks(items: DataFrame, window: int, limit: int) -> Iterator[Automaton]:
    """Automata of at most `limit` words (or one item); the driver holds one block at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        words = (row["text"] or "").encode().translate(NORMAL).split()
        if block and size + len(words) > limit:
            yield Automaton(block, window)
            block, size = [], 0
        if words:
            block.append((row["item_id"] or "", words))
            size += len(words)
    yield Automaton(block, window)


def union(spans: list[int]) -> list[int]:
    """Flat sorted spans without overlaps; spans that touch become one."""
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


def cut_out(text: bytes, spans: list[int]) -> str:
    """The text without the words of the spans; what stands between words stays."""
    places = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, text[at:]]).decode()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    coverage: float = 1 / 20,
    max_span: int | None = None,
    with_text: bool = False,
    carry: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, `spans` (flat word positions), `items`
    (ids as text, sorted), contaminated (hit words make up `coverage` of the text or more).
    `with_text` adds `cleaned`: the text without the spans of contaminated documents and
    without any span longer than `max_span` words; `carry` adds the whole row as `row`.

    Null or empty texts have no words and are clean; repeated rows are judged alike; items
    without words match nothing, a null item id is the empty text; an empty benchmark leaves all
    documents clean. A benchmark of more than `block_words` words takes several passes, each
    with one automaton of bounded size."""
    rows = carried(docs, F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_of(docs, text).alias("text"), carry=carry)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_of(benchmark).alias("text"))
    context = docs.sparkSession.sparkContext
    share = round(1 / coverage)  # whole numbers: no rounding at the limit

    def one_pass(df: DataFrame, shared, first: bool, last: bool) -> DataFrame:
        keep = with_text or not last

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                raw = byte_texts(batch.column(1))
                n_words, n_hit, spans, found, cleaned = [], [], [], [], []
                before = [([], [])] * len(raw) if first else zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                for body, (had, known) in zip(raw, before):
                    words = body.translate(NORMAL).split()
                    new, items_hit = automaton.match(words)
                    joint = union([*had, *new])
                    hit = sum(joint[1::2]) - sum(joint[::2])
                    n_words.append(len(words))
                    n_hit.append(hit)
                    spans.append(joint)
                    found.append(sorted({*known, *(automaton.ids[i] for i in items_hit)}))
                    if with_text:
                        over = hit and hit * share >= len(words)
                        gone = [x for a, b in zip(joint[::2], joint[1::2]) if over or (max_span and b - a > max_span) for x in (a, b)]
                        cleaned.append(cut_out(body, gone) if gone else body.decode())
                out = {"doc_id": batch.column(0)}
                if keep:
                    out["text"] = batch.column(1)
                out |= {
                    "spans": pa.array(spans, pa.list_(pa.int32())), "items": pa.array(found, pa.list_(pa.string())),
                    "n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
                }
                if with_text:
                    out["cleaned"] = pa.array(cleaned, pa.string())
                yield pa.RecordBatch.from_pydict(out | carried_on(batch))

        columns = "doc_id bigint, " + "text string, " * keep + "spans array<int>, items array<string>, n_words bigint, n_hit bigint" + ", cleaned string" * with_text
        return df.mapInArrow(run, schema_of(columns, docs if carry else None))

    waiting, first = blocks(items, window, block_words), True
    automaton = next(waiting)
    while automaton is not None:
        following = next(waiting, None)
        source = rows if first else written(rows.select("doc_id", "text", "spans", "items", *["row"] * carry), "decontamination")
        rows = one_pass(source, context.broadcast(automaton), first, following is None)
        automaton, first = following, False
    return rows.drop("text").withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def digest(found: DataFrame) -> DataFrame:
    """The report of a `decontaminate` result, one row per document."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )
