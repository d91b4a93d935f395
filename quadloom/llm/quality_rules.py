"""Quality rules on repetition, from suffix arrays of each text's words.

Suffixes are sorted by prefix doubling for all texts of a chunk at once; after each doubling
only suffixes that still share their beginning with another one of the same text go on. The
longest common prefixes of neighbours in that order give, for every word, the longest repeat
beginning there; repeats of `window` words or more are united to spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quadloom.llm.tables import map_batches, text_of
from quadloom.llm.words import Words, byte_texts, chunks, sums_by_text

SYMBOL = np.zeros(256, bool)
SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def suffix_order(words: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes that share their first `least` words (a power of two) with another suffix of the
    same text: their positions in text order and in suffix order, and for every position the end
    of its text. `words` are small numbers, `text` the text of each word (ascending).

    rank[i] is the place at which the group of suffix i begins among all sorted suffixes, plus
    1; beyond a text's end it is 0. A doubling sorts every group by the rank `span` words on."""
    n = len(words)
    end = np.searchsorted(text, text, "right")
    key = text * np.int64(int(words.max(initial=0)) + 1) + words
    _, group, size = np.unique(key, return_inverse=True, return_counts=True)
    rank = np.zeros(n + 1, np.int64)
    rank[:n] = (np.cumsum(size) - size)[group] + 1
    active, span = np.flatnonzero(size[group] > 1), 1
    starts = active
    while len(active):
        if span == least:
            starts = np.sort(active)
        next_at = active + span
        follow = rank[np.where(next_at < end[active], next_at, n)]
        key = rank[active] * np.int64(n + 2) + follow
        order = np.argsort(key)
        active, key = active[order], key[order]
        own = rank[active]
        at = np.arange(len(active))
        old_first = np.maximum.accumulate(np.where(np.concatenate([[True], own[1:] != own[:-1]]), at, 0))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        new_first = np.maximum.accumulate(np.where(new, at, 0))
        rank[active] = own + new_first - old_first
        last = np.concatenate([new[1:], [True]])
        active, span = active[~(new & last)], span * 2
    if span <= least:
        starts = starts[:0]
    return starts, starts[np.argsort(rank[starts])], end


def longest_repeats(words: np.ndarray, text: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions (ascending) at which a repeat of at least `window` words of the same text
    begins, and the length of the longest repeat there: the larger common prefix with the
    neighbours in suffix order. The prefix shared with the suffix before, less one word, is
    shared at the next position (while that is at least what makes a group), so all are found in
    linear time."""
    least = 1 << (window.bit_length() - 1)
    starts, order, end = suffix_order(words, text, least)
    if not len(starts):
        return starts, starts
    before = np.full(len(order), -1, np.int64)
    before[1:] = np.where(text[order[1:]] == text[order[:-1]], order[:-1], -1)
    near = dict(zip(order.tolist(), before.tolist()))
    w, prefix, size, last = words.tolist(), {}, 0, -2
    for i, stop in zip(starts.tolist(), end[starts].tolist()):
        size = size - 1 if i == last + 1 and size > least else 0
        j = near[i]
        if j < 0:
            size = 0
        else:
            most = stop - max(i, j)
            while size < most and w[i + size] == w[j + size]:
                size += 1
        prefix[i] = size
        last = i
    shared = np.array([prefix[i] for i in order.tolist()], np.int64)
    best = np.maximum(shared, np.concatenate([shared[1:], [0]]))
    back = np.argsort(order)
    found = best[back]
    long = found >= window
    return starts[long], found[long]


def spans_covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """True for the positions that lie in a span."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    lines = [x for x in lines if x.strip()]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes], window: int) -> dict[str, np.ndarray]:
    """The measures of each text of a chunk."""
    w = Words(texts)
    n = len(w.start)
    points = (w.data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(points)])
    _, word = np.unique(w.hashes(), return_inverse=True)
    text = np.repeat(np.arange(len(texts)), w.count)
    starts, lengths = longest_repeats(word, text, window)
    hit = spans_covered(starts, lengths, n)
    size = before[w.end] - before[w.start]
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, text[starts], lengths)
    symbols = np.concatenate([[0], np.cumsum(SYMBOL[w.data])])
    return {
        "n_words": w.count.astype(np.int64),
        "word_chars": sums_by_text(size, w.first),
        "n_symbols": symbols[w.text_start[1:] - 1] - symbols[w.text_start[:-1]],
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": sums_by_text(hit, w.first),
        "repeat_chars": sums_by_text(np.where(hit, size, 0), w.first),
        "longest_repeat": longest,
    }


def quality(
    docs: DataFrame,
    window: int = 8,
    min_words: int = 20,
    max_repeat_words: float = 0.3,
    max_repeat_chars: float = 0.3,
    max_longest: int = 100,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs` with its measures, `base_failed` (fewer than `min_words` words,
    or more than `max_repeat_words` of the words in repeats of `window` words) and `kept`: not
    failed, at most `max_repeat_chars` of the characters of words in repeats, and no repeat
    longer than `max_longest` words.

    A null or empty text has no words and fails; rows with one id or text are judged alike and
    all kept in the result; an empty table gives no rows; other columns are not looked at."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = byte_texts(batch.column(1))
        for a, b in chunks(texts):
            yield {"doc_id": batch.column(0).slice(a, b - a)} | {k: pa.array(v, pa.int64()) for k, v in measure(texts[a:b], window).items()}

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_of(docs, text).alias("text"))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_chars", "longest_repeat"]
    found = map_batches(rows, run, "doc_id bigint, " + ", ".join(f"{m} bigint" for m in measures))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > round(100 * max_repeat_words) * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept",
        ~failed & (F.col("repeat_chars") <= max_repeat_chars * F.col("word_chars")) & (F.col("longest_repeat") <= max_longest),
    )
