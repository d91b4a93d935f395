"""Exact token counts of every prefix by dynamic programming, for piece vocabularies (BPE).

A merge order has one outcome, and that outcome is known by its neighbours: pieces p1 ... pn are
the encoding of their text exactly if every two neighbours are the encoding of theirs. So the
encoding of a prefix is that of a shorter prefix and one more piece, the only one that ends there
and may follow the shorter prefix's last piece: count[i] = count[i - len(piece)] + 1. The counts of
all prefixes take one walk over the text, and then the tokens of any cut and the longest cut within
any budget are lookups.

No merge crosses two letters that no piece holds side by side (a word's end and the next blank,
most marks and the letters behind them). A text is the sequence of chunks between such places; the
table of a chunk is made once for all its copies (a bounded cache).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quadloom.llm.tables import carried, carried_on, schema_of, text_of

#: Tables of chunks, of their first letters and answers about pairs kept by a worker; the longest
#: chunk kept; the letters of a stem.
KEPT, KEPT_LENGTH, STEM = 1 << 18, 64, 6


class _Cache(dict):
    """Values made on demand, forgotten all at once when there are too many."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= KEPT:
            self.clear()
        self[key] = value
        return value


class Pieces:
    """A piece vocabulary with the tables it needs. `model` is the content of a model file of
    the BPE kind with byte pieces, so that what the vocabulary lacks counts its UTF-8 bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.sp.vocab_size())
        if not any(self.sp.is_byte(i) for i in ids):
            raise ValueError("the vocabulary has no byte pieces")
        own = [i for i in ids if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i))]
        self.score = {self.sp.id_to_piece(i): self.sp.get_score(i) for i in own}
        self.tails = {p[i:] for p in self.score for i in range(len(p))}
        letters = sorted(set("".join(self.score)))
        self.number = np.zeros(0x110000, np.uint16)  # 0: no piece has it
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.joined = np.zeros((len(letters) + 1,) * 2, bool)
        for p in self.score:
            at = self.number[[ord(c) for c in p]]
            self.joined[at[:-1], at[1:]] = True
        self.follows = _Cache(lambda pair: self.merged("".join(pair)) == list(pair))
        self.tables = _Cache(self.table_of)
        self.stems = _Cache(lambda stem: tuple(map(tuple, self.walked(stem, [0], [""]))))

    def chunks(self, text: str) -> list[str]:
        """`text` cut wherever two letters are side by side in no piece."""
        if not text:
            return []
        at = self.number[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        cuts = (np.flatnonzero(~self.joined[at[:-1], at[1:]]) + 1).tolist()
        return [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)])]

    def merged(self, text: str) -> list[str]:
        """The encoding of a few letters: the best pair first, the leftmost of equal ones."""
        score, none = self.score.get, float("-inf")
        parts = list(text)
        pairs = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > none:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def walked(self, chunk: str, counts: list[int], last: list[str]) -> tuple[list[int], list[str]]:
        """Tokens of every prefix of a chunk and the last piece of each, the empty one first,
        from those of its shorter prefixes."""
        score, follows, tails = self.score, self.follows, self.tails
        for end in range(len(counts), len(chunk) + 1):
            ending = [chunk[end - 1 : end]]  # a letter stands for itself, in the vocabulary or not
            for start in range(end - 2, -1, -1):
                tail = chunk[start:end]
                if tail not in tails:
                    break
                if tail in score:
                    ending.append(tail)
            for piece in reversed(ending):
                start = end - len(piece)
                before = last[start]
                if follows[(before, piece) if before else (piece,)]:
                    counts.append(counts[start] + (1 if piece in score else len(piece.encode())))
                    last.append(piece)
                    break
        return counts, last

    def table_of(self, chunk: str) -> tuple[int, ...]:
        """Tokens of every prefix of a chunk, the whole one last. What chunks have in common at
        their start is walked once."""
        counts, last = self.stems[chunk[:STEM]]
        if len(chunk) > STEM:
            counts, last = self.walked(chunk, [*counts], [*last])
        return tuple(counts[1:])

    def read(self, text: str | None) -> "Prefixes":
        return Prefixes(self, text or "")


class Prefixes:
    """The counts of all prefixes of one text: chunk by chunk, sums at their ends."""

    def __init__(self, pieces: Pieces, text: str):
        shown = pieces.sp.normalize(text) if text else ""
        chunks = pieces.chunks(shown)
        kept, make = pieces.tables, pieces.table_of
        self.tables = [kept[c] if len(c) <= KEPT_LENGTH else make(c) for c in chunks]
        self.sums = list(accumulate((t[-1] for t in self.tables), initial=0))
        self.ends = list(accumulate(map(len, chunks), initial=0))
        #: Characters the vocabulary's normal form puts in front of the text's own.
        self.front = max(0, len(shown) - len(text))

    @property
    def total(self) -> int:
        return self.sums[-1]

    def tokens(self, chars: int) -> int:
        """Tokens of the first `chars` code points."""
        at = min(chars + self.front, self.ends[-1]) if chars > 0 else 0
        k = bisect_right(self.ends, at) - 1
        return self.sums[k] + (self.tables[k][at - self.ends[k] - 1] if at > self.ends[k] else 0)

    def within(self, budget: int) -> int:
        """Code points of the longest prefix of at most `budget` tokens. Behind the first chunk
        end over the budget every prefix is over it, so only that chunk's table is looked at."""
        k = bisect_right(self.sums, budget) - 1
        if k == len(self.tables):
            at = self.ends[-1]
        else:
            fits = [i for i, n in enumerate(self.tables[k], 1) if self.sums[k] + n <= budget]
            at = self.ends[k] + (fits[-1] if fits else 0)
        return max(0, at - self.front)

    def all(self) -> np.ndarray:
        """Tokens of the prefix of each number of code points from 0 on."""
        if not self.tables:
            return np.zeros(1, np.int32)
        whole = np.concatenate([np.asarray(t, np.int32) + s for t, s in zip(self.tables, self.sums)])
        return np.concatenate([[0], whole[self.front :]]).astype(np.int32)


@cache
def _pieces(model: bytes) -> Pieces:
    """One vocabulary per worker process, kept from task to task."""
    return Pieces(model)


def _model(path: str) -> bytes:
    """The content of a vocabulary file, read by the driver: executors need not see it."""
    with open(path, "rb") as f:
        return f.read()


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, budgets: Sequence[int] = (), doc_id: str = "doc_id", text: str = "text", carry: bool = False
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit (more than `limit`
    tokens), fits_chars (code points of the longest prefix of at most `limit` tokens) and cuts
    (the same for each of `budgets`); with `carry` the whole row as `row`.

    `model` is the path of a piece vocabulary. Null and empty texts have no bytes and no tokens.
    Strings of special tokens are ordinary text; what the vocabulary lacks counts its bytes. Texts
    of any length are read whole in linear time, a text without blanks too. Repeated rows and null
    ids are counted each; other columns are not looked at; an empty table gives no rows. Work is
    by row, without a shuffle; what is broadcast is the vocabulary file."""
    shared = docs.sparkSession.sparkContext.broadcast(_model(model))
    asked = list(budgets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            total, fits, cuts = [], [], []
            for body in batch.column("text").to_pylist():
                found = pieces.read(body)
                total.append(found.total)
                fits.append(found.within(limit))
                cuts.append([found.within(b) for b in asked])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": pa.array(total, pa.int64()),
                "over_limit": pa.array([n > limit for n in total], pa.bool_()), "fits_chars": pa.array(fits, pa.int64()),
                "cuts": pa.array(cuts, pa.list_(pa.int64())),
            } | carried_on(batch))

    rows = carried(docs, F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), _bytes(docs, text).alias("n_bytes"), text_of(docs, text).alias("text"), carry=carry)
    out = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, fits_chars bigint, cuts array<bigint>"
    return rows.mapInArrow(run, schema_of(out, docs if carry else None))


def _bytes(docs: DataFrame, text: str) -> Column:
    return F.octet_length(F.coalesce(text_of(docs, text), F.lit(""))).cast("bigint")


def prefix_counts(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored form: doc_id and counts, of which element i (from 0) is the tokens of the
    first i code points; [0] for null and empty texts. `tokens_of` and `longest_within` answer
    from it with built-in functions, without the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(shared.value)
        for batch in batches:
            ids, bodies = batch.column("doc_id"), batch.column("text")
            for i in range(batch.num_rows):  # a row at a time: a list is four times its text
                counts = pieces.read(bodies[i].as_py()).all()
                yield pa.RecordBatch.from_pydict({"doc_id": ids.slice(i, 1), "counts": pa.ListArray.from_arrays([0, len(counts)], pa.array(counts))})

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_of(docs, text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, counts array<int>")


def tokens_of(chars: Column, counts: str = "counts") -> Column:
    """Tokens of the first `chars` code points, all if the text is shorter."""
    at = F.least(F.greatest(chars.cast("int"), F.lit(0)), F.size(counts) - 1)
    return F.get(counts, at)


def longest_within(budget: Column, counts: str = "counts") -> Column:
    """Code points of the longest prefix of at most `budget` tokens."""
    fits = F.transform(F.col(counts), lambda n, i: F.when(n <= budget, i))
    return F.array_max(fits)
