"""Best-fit packing of documents into training sequences of several permitted lengths.

Which document goes where follows from the counts of lengths alone: there are at most as many
lengths as the longest sequence has tokens, however many documents. Best fit, longest first, runs
on these counts and moves whole groups of equal bins at once; its outcome is a list of placements
("the documents number f and on of length n go m to a bin, from bin b, behind o tokens"). Documents
are numbered within their length by global prefix sums and look their placement up.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quadloom.llm.shards import prefix_sums
from quadloom.llm.tables import text_of


def plan(counts: dict[int, int], capacities: list[int], overhead: int) -> tuple[np.ndarray, np.ndarray]:
    """Placements (length, first, per bin, bin, offset) and bins (first bin, capacity).

    Longest first, each piece goes to the open bin with the least room it fits in. Where none
    has room, the permitted length with the least cost per token opens: (length + overhead) over
    the tokens it will hold, which are the pieces at hand and what is left of shorter ones for
    the gap. At the end each bin takes the least permitted length that holds its contents."""
    capacities = sorted(capacities)
    placements: list[tuple[int, int, int, int, int]] = []
    rooms: list[tuple[int, int, int, int]] = []  # (room, first bin, bins, opened length), sorted
    done: list[tuple[int, int, int]] = []  # (first bin, room, opened length)
    supply = sum(n * c for n, c in counts.items())
    free = bins = 0
    for n in sorted(counts, reverse=True):
        left, first = counts[n], 0

        def put(room: int, at: int, number: int, opened: int, each: int) -> None:
            """`each` pieces into every one of `number` bins."""
            nonlocal left, first, free, supply
            placements.append((n, first, each, at, opened - room))
            first, left = first + number * each, left - number * each
            free -= number * each * n
            supply -= number * each * n
            rest = room - each * n
            if rest:
                insort(rooms, (rest, at, number, opened))
            else:
                done.append((at, 0, opened))

        while left:
            i = bisect_left(rooms, (n,))
            if i < len(rooms):
                room, at, number, opened = rooms.pop(i)
            else:
                best = None
                for c in capacities:
                    if c >= n:
                        each = min(c // n, left)
                        need = -(-left // each)
                        spare = max(0, supply - left * n - free)
                        held = each * n + min(c - each * n, spare / need)
                        best = min(best or (float("inf"),), ((c + overhead) / held, c, each))
                _, opened, each = best
                number = max(1, left // each)
                room, at = opened, bins
                bins += number
                free += number * opened
            each = room // n
            use = min(number, left // each)
            if use < number:  # the bins behind stay as they are, the next may take fewer
                rest = (at + use, number - use)
                if use:
                    put(room, at, use, opened, each)
                if left:
                    if rest[1] > 1:
                        insort(rooms, (room, rest[0] + 1, rest[1] - 1, opened))
                    put(room, rest[0], 1, opened, left)
                else:
                    insort(rooms, (room, rest[0], rest[1], opened))
            else:
                put(room, at, number, opened, each)
    done += [(at, room, opened) for room, at, _, opened in rooms]
    final = [(at, capacities[bisect_left(capacities, opened - room)]) for at, room, opened in sorted(done)]
    return np.array(sorted(placements), np.int64).reshape(-1, 5), np.array(final, np.int64).reshape(-1, 2)


def byte_tokens(docs: DataFrame, text: str = "text") -> Column:
    """Tokens of a byte-level vocabulary: UTF-8 bytes and one end mark."""
    return F.octet_length(F.coalesce(text_of(docs, text), F.lit(""))) + F.lit(1)


def pack(
    docs: DataFrame,
    capacities: tuple[int, ...] = (4096, 8192, 16384, 32768),
    overhead: int = 128,
    length: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start and length (tokens of the document),
    bin, capacity (the bin's final length) and offset (tokens before it in the bin).

    `length` counts the tokens of a document, by default byte tokens; 0 or null counts as 1. A
    document longer than the largest capacity is cut into full pieces and a rest. A bin holds no
    more than its capacity, its pieces lie without gaps from 0. Null and empty texts are one end
    mark long. Repeated rows and null ids are packed like others (equal pieces of one id may
    swap places). An empty table gives no rows; other columns are not looked at."""
    most = max(capacities)
    tokens = F.greatest(F.coalesce(length if length is not None else byte_tokens(docs, text), F.lit(1)), F.lit(1)).cast("bigint")
    whole = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), tokens.alias("tokens"))
    pieces = whole.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0), F.expr(f"cast((tokens - 1) div {most} as int)"))).alias("piece"))
    pieces = pieces.select(
        "doc_id", "piece", (F.col("piece").cast("bigint") * most).alias("first"),
        F.least(F.lit(most).cast("bigint"), F.col("tokens") - F.col("piece").cast("bigint") * most).alias("length"),
    )
    placed = prefix_sums(pieces, ["length", "doc_id", "piece"], "length")
    counts = {r["length"]: r["count"] for r in placed.groupBy("length").count().collect()}  # at most `most` lines
    placements, bins = plan(counts, list(capacities), overhead)
    lengths = np.array(sorted(counts), np.int64)
    before = np.concatenate([[0], np.cumsum([counts[n] for n in lengths.tolist()])]).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((placements, bins, lengths, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placements, bins, lengths, before = shared.value
        start_of = before[np.searchsorted(lengths, placements[:, 0])] + placements[:, 1]  # global numbers
        for batch in batches:
            n = batch.column("length").to_numpy()
            number = batch.column("index").to_numpy()
            at = np.searchsorted(start_of, number, "right") - 1
            _, _, each, first_bin, offset = placements[at].T
            t = number - start_of[at]
            where = first_bin + t // each
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "piece": batch.column("piece"), "start": batch.column("first"), "length": batch.column("length"),
                "bin": pa.array(where), "capacity": pa.array(bins[np.searchsorted(bins[:, 0], where, "right") - 1, 1]),
                "offset": pa.array(offset + t % each * n),
            })

    return placed.select("doc_id", "piece", "first", "length", "index").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, bin bigint, capacity bigint, offset bigint"
    )
