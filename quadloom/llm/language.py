"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a random vector of +1 and -1. A three-letter sequence is the elementwise product
of its letters' vectors, permuted (rolled) by two, one and no places, so order counts. A text is
the sum of its sequences' vectors, a language the sum over its texts; texts are compared with
languages by cosine, after the mean of all languages is taken off.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quadloom.llm.tables import carried, carried_on, schema_of, text_of

#: Symbols: 0 between words, 1-26 for a-z, the rest shared by all other letters.
SYMBOLS, DIMENSIONS, SEED, LETTERS_TO = 64, 1024, 7, 0x323B0
CODES = SYMBOLS**3


@cache
def symbol_table() -> np.ndarray:
    """Symbol of every code point; capital letters share that of their small one."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(LETTERS_TO):  # letters end below
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[cp] = low - 96 if 97 <= low <= 122 else 27 + low * 2654435761 % 2**32 % (SYMBOLS - 27)
    return table


@cache
def letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols' vectors rolled by 2, 1 and 0 places."""
    v = np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, DIMENSIONS)).astype(np.int8) * 2 - 1
    return np.roll(v, 2, axis=1), np.roll(v, 1, axis=1), v


def codes(text: str) -> np.ndarray:
    """Codes of all three-symbol sequences of a text; runs of other characters are one gap."""
    symbols = symbol_table()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    symbols = np.concatenate([[0], symbols, [0]]).astype(np.int32)
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    s = symbols[keep]
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


def bundle(which: np.ndarray, counts: np.ndarray, block: int = 4096) -> np.ndarray:
    """Sum of the sequences' vectors, each as often as it counts."""
    two, one, none = letter_vectors()
    out = np.zeros(DIMENSIONS)
    for i in range(0, len(which), block):
        c = which[i : i + block]
        bound = two[c // SYMBOLS**2] * one[c // SYMBOLS % SYMBOLS] * none[c % SYMBOLS]
        out += counts[i : i + block].astype(np.float32) @ bound.astype(np.float32)
    return out


def learn(texts: DataFrame, lang: str, text: str) -> tuple[list[str], np.ndarray]:
    """Languages in order and their profiles, from all rows with both values. Tasks add up
    counts per language and bind them once; what is shuffled and collected is one number per
    language and dimension."""
    rows = texts.select(F.col(f"`{lang}`").cast("string").alias("lang"), text_of(texts, text).alias("text")).dropna()

    def bundles(counted: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, n in counted.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * DIMENSIONS), "dimension": pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                "value": pa.array(np.rint(bundle(seen, n[seen])).astype(np.int64)),
            })

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name not in counted:
                    if len(counted) == 32:  # bounds the task's memory; sums are joined below
                        yield from bundles(counted)
                        counted = {}
                    counted[name] = np.zeros(CODES, np.int64)
                c, n = np.unique(codes(body), return_counts=True)
                counted[name][c] += n
        yield from bundles(counted)

    sums = rows.mapInArrow(add_up, "lang string, dimension int, value bigint")
    lines = sums.groupBy("lang", "dimension").agg(F.sum("value").alias("value")).collect()
    names = sorted({r["lang"] for r in lines})
    place = {x: i for i, x in enumerate(names)}
    profiles = np.zeros((len(names), DIMENSIONS))
    for r in lines:
        profiles[place[r["lang"]], r["dimension"]] = r["value"]
    return names, centred(profiles)


def centred(profiles: np.ndarray) -> np.ndarray:
    """Profiles of length 1, without their mean where there are several."""
    unit = profiles / np.maximum(np.linalg.norm(profiles, axis=1, keepdims=True), 1e-9)
    if len(unit) > 1:
        unit = unit - unit.mean(axis=0)
    return unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)


def guess(text: str | None, names: list[str], profiles: np.ndarray) -> tuple[str, float]:
    c = codes(text or "")
    if not names or not c.any():
        return "und", 0.0
    which, n = np.unique(c, return_counts=True)
    v = bundle(which, n)
    cosine = profiles @ v / max(float(np.linalg.norm(v)), 1e-9)
    best = int(np.argmax(cosine))
    return names[best], float(min(1.0, max(0.0, (1 + cosine[best]) / 2)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: CRC-32 of the id as text is 2 modulo 4. Null ids are not held
    out, nor learned from."""
    return F.coalesce(_fold(doc_id) == 2, F.lit(False))


def _fold(doc_id: str) -> Column:
    return F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4


def identify(docs: DataFrame, learn_from: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", carry: bool = False) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred and score, (1 + cosine) / 2; with
    `carry` the whole row as `row`.

    Profiles come from the rows of `learn_from` (default `docs`) that have a language and are
    not held out. The language is `und` and the score 0 for null texts, texts without a letter,
    and where nothing could be learned. Of equal cosines the first language in order wins.
    Repeated rows count each time; other columns are not looked at."""
    source = docs if learn_from is None else learn_from
    names, profiles = learn(source.where(_fold(doc_id) != 2), lang, text)
    shared = docs.sparkSession.sparkContext.broadcast((names, profiles))  # languages x dimensions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vectors = shared.value
        for batch in batches:
            found = [guess(t, known, vectors) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "held_out": batch.column(1),
                "lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64()),
            } | carried_on(batch))

    rows = carried(docs, F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), held_out(doc_id).alias("held_out"), text_of(docs, text).alias("text"), carry=carry)
    return rows.mapInArrow(run, schema_of("doc_id bigint, held_out boolean, lang_pred string, score double", docs if carry else None))
