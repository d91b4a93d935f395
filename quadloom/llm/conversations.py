"""Repair of conversations by the cheapest edits: dynamic programming with square-root checkpoints.

A repaired conversation is empty, or an optional system turn and pairs of user and assistant. The
state of a half-written one is its last role (nothing, system, user, assistant), so a row of the
conversation is a step between four states, and the cost to the end is a vector of four numbers.
Walking forward needs the vectors from the end back, of which only checkpoints are kept: what lies
between two checkpoints is computed again when the walk comes to it.

That holds twice. A conversation of any length is cut into blocks of about the square root of the
longest one; Spark works on blocks alone, each with its table of 4 x 4 costs, and the vectors at the
ends of blocks are the checkpoints between tasks. In a block the vectors are kept at every
square root of its rows. A hot conversation is so many blocks, and what meets per conversation is
one short line a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import pairwise
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quadloom.plans.cut import written
from quadloom.plans.rank import positions

#: States: nothing yet, behind a system turn, behind a user's, behind an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: What may follow a state, by class of role (0 system, 1 user, 2 assistant, 3 any other), and the
#: state it leads to. The one of user and assistant that may follow is what is inserted.
NEXT = ({0: SYSTEM, 1: USER}, {1: USER}, {2: ASSISTANT}, {1: USER})
TURN = (USER, USER, ASSISTANT, USER)
DELETE, INSERT, REROLE, UNFINISHED = 3, 2, 2, 1
NEVER = 1 << 40
#: A row's code: its class of role, 4 if it must go, 8 if it is truncated.
MUST_GO, TRUNCATED = 4, 8
LEAST_BLOCK = 4096

Vector = tuple[int, ...]


def row_edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row, letters in ASCII order."""
    out = [("D", DELETE, state)]
    if not code & MUST_GO:
        more = UNFINISHED if code & TRUNCATED else 0
        if code & 3 in NEXT[state]:
            out.append(("K", more, NEXT[state][code & 3]))
        out.append(("R", REROLE + more, TURN[state]))
    return out


def with_inserts(costs: Sequence[int]) -> Vector:
    """Costs to the end where turns may be inserted first, any number of them."""
    out = list(costs)
    for _ in STATES:  # a longer chain comes back to a state it has been in
        out = [min(out[s], INSERT + out[TURN[s]]) for s in STATES]
    return tuple(out)


#: The end: a conversation may stop with nothing or behind an assistant.
END = with_inserts([0 if s in (NOTHING, ASSISTANT) else NEVER for s in STATES])


@cache
def _back(code: int, after: Vector) -> Vector:
    return with_inserts([min(c + after[t] for _, c, t in row_edits(code, s)) for s in STATES])


def back(code: int, after: Vector) -> Vector:
    """Costs to the end in front of a row from those behind it. They differ by little, so
    there are few once their least is taken off, and each is computed once."""
    least = min(after)
    if least >= NEVER:
        return (NEVER,) * 4
    return tuple(min(NEVER, c + least) for c in _back(code, tuple(min(NEVER, c - least) for c in after)))


def checkpoints(codes: bytes, after: Vector, step: int) -> list[Vector]:
    """Costs in front of rows 0, step, 2 * step, ... and behind the last."""
    kept, vector = [after], after
    for at in range(len(codes) - 1, -1, -1):
        vector = back(codes[at], vector)
        if at % step == 0:
            kept.append(vector)
    return kept[::-1]


@cache
def _tight(code: int, state: int, after: Vector) -> tuple[str, int]:
    left = _back(code, after)
    letters = ""
    while True:  # inserts come before the row they stand in front of
        want = left[state]
        ways = [(letter, t) for letter, c, t in row_edits(code, state) if c + after[t] == want]
        if INSERT + left[TURN[state]] == want:
            ways.append(("I", TURN[state]))
        letter, state = min(ways)
        letters += letter
        if letter != "I":
            return letters, state


def walk(codes: bytes, state: int, after: Vector) -> tuple[list[str], int]:
    """The ASCII-least of the cheapest edits: per row its letter with the inserts before it, and
    the state behind the last row. Costs are known at checkpoints and made again block by block."""
    step = isqrt(max(1, len(codes) - 1)) + 1
    kept = checkpoints(codes, after, step)
    out = []
    for block, behind in enumerate(kept[1:]):
        rows = codes[block * step : (block + 1) * step]
        vectors = checkpoints(rows, behind, 1)
        for code, vector in zip(rows, vectors[1:]):
            least = min(vector)
            letters, state = _tight(code, state, tuple(min(NEVER, c - least) for c in vector))
            out.append(letters)
    return out, state


def closing(state: int) -> str:
    """Inserts behind the last row."""
    out = ""
    while state not in (NOTHING, ASSISTANT):
        out, state = out + "I", TURN[state]
    return out


def transfer(codes: bytes) -> list[int]:
    """16 costs: from each state in front of a block to each behind it."""
    columns = [checkpoints(codes, tuple(0 if s == t else NEVER for s in STATES), len(codes))[0] for t in STATES]
    return [columns[t][s] for s in STATES for t in STATES]


# the rows ----------------------------------------------------------------------


def shown(rows: DataFrame, column: str) -> Column:
    """A cell as text, null as one blank."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by CRC-32 of `conv_id:turn` modulo 20: 0 drops
    the row, 1 empties its text, 2 takes its `.`, `!` and `?` away, 3 gives it twice, 4 makes it a
    user's. Nulls of the key, of role and of text read as one blank; ids and turns stay null."""
    fate = F.crc32(F.concat(shown(rows, conv_id), F.lit(":"), shown(rows, turn)).cast("binary")) % 20
    marked = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), shown(rows, role).alias("role"), shown(rows, text).alias("text"), fate.alias("fate")
    ).where("fate != 0")
    return marked.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _keyed(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """`c` names the conversation, also a null one; rows are in order of turn (nulls first), role
    and `digest`. Rows equal in all of them are the same and may swap places."""
    keyed = rows.select(
        F.coalesce(F.col(f"`{conv_id}`").cast("string"), F.lit("")).alias("c"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        shown(rows, role).alias("role"), shown(rows, text).alias("text"),
    )
    return keyed.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


ROW_ORDER = ("turn", "role", "digest")


def marked_rows(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows without their texts: c, turn, position in the conversation, the faults and `code`.

    The first fault of a row counts: blank (no character but white space), duplicate (role and
    text of an earlier row), truncated (the last such character is none of `.`, `!`, `?`). Positions
    come from a range partitioning, first places of (role, text) from one aggregation."""
    body = F.col("text")
    inside = F.rtrim(body, F.lit(" \t\n\x0b\x0c\r"))
    slim = _keyed(rows, conv_id, turn, role, text).select(
        "c", "turn", "role", "digest", (inside == "").alias("empty"), (~F.substring(inside, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    placed = positions(slim, [F.col(o).asc_nulls_first() for o in ROW_ORDER], group=["c"])
    first = placed.where("not empty").groupBy(F.col("c").alias("c1"), F.col("role").alias("r1"), F.col("digest").alias("d1")).agg(
        F.min("position").alias("p1"), F.count(F.lit(1)).alias("n1")
    ).where("n1 > 1")  # only what occurs again is looked up
    found = placed.join(first, (F.col("c") == F.col("c1")) & (F.col("role") == F.col("r1")) & (F.col("digest") == F.col("d1")), "left")
    seen = ~F.col("empty") & F.coalesce(F.col("position") > F.col("p1"), F.lit(False))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    cut_off = ~F.col("empty") & ~seen & F.col("open")
    return found.select(
        "c", "turn", "position", F.col("empty").alias("blank"), seen.alias("duplicate"), cut_off.alias("truncated"),
        (kind + F.when(F.col("empty") | seen, MUST_GO).when(cut_off, TRUNCATED).otherwise(0)).cast("int").alias("code"),
    )


def _batched(df: DataFrame, fn, schema: str) -> DataFrame:
    """`fn` over the rows of each batch as dicts, giving dicts."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fn(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pydict({n: pa.array([m[n] for m in made], kinds[n]) for n in names})

    kinds = {"c": pa.string(), "block": pa.int64(), "codes": pa.binary(), "costs": pa.list_(pa.int64()), "illegal": pa.int64(), "first": pa.int32(), "last": pa.int32(),
             "audits": pa.list_(pa.string()), "exits": pa.list_(pa.int32()), "cost": pa.int64(), "after": pa.list_(pa.list_(pa.int64())), "entries": pa.list_(pa.int32())}
    return df.mapInArrow(run, schema)


LEGAL = {(0, 1), (1, 2), (2, 1)}


def _measure(row: dict) -> dict:
    codes = bytes(x["code"] for x in row["rows"])
    kinds = [c & 3 for c in codes]
    return {"c": row["c"], "block": row["block"], "codes": codes, "costs": transfer(codes), "illegal": sum(p not in LEGAL for p in pairwise(kinds)),
            "first": kinds[0], "last": kinds[-1]}


def _back_over_blocks(row: dict) -> dict:
    """Costs behind each block, from the last block to the first."""
    blocks, vector, after = row["blocks"], END, []
    for b in reversed(blocks):
        after.append(list(vector))
        m = b["costs"]
        vector = tuple(min(NEVER, *(m[4 * s + t] + vector[t] for t in STATES)) for s in STATES)
    joints = sum((x["last"], y["first"]) not in LEGAL for x, y in pairwise(blocks))
    return {"c": row["c"], "after": after[::-1], "cost": vector[NOTHING], "illegal": sum(b["illegal"] for b in blocks) + joints}


def _walk_from_all(row: dict) -> dict:
    ways = [walk(row["codes"], s, tuple(row["after"])) for s in STATES]
    return {"c": row["c"], "block": row["block"], "audits": ["".join(letters) for letters, _ in ways], "exits": [t for _, t in ways]}


def _forward_over_blocks(row: dict) -> dict:
    """The state in front of each block and, last, behind the whole."""
    entries = [NOTHING]
    for b in row["blocks"]:
        entries.append(b["exits"][entries[-1]])
    return {"c": row["c"], "entries": entries}


def _per_conversation(blocks: DataFrame, *columns: str) -> DataFrame:
    return blocks.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("block", *columns))).alias("blocks"))


def audits(marked: DataFrame, block_rows: int | None = None) -> DataFrame:
    """c, block, letters (the edits of a block's rows; in the last block the closing inserts
    too), cost and illegal (of the whole conversation) for every block of every conversation."""
    marked = written(marked.select("c", "position", "code"), "rows")
    if block_rows is None:
        longest = marked.agg(F.max("position")).first()[0] or 0
        block_rows = max(LEAST_BLOCK, isqrt(longest))
    block = F.floor((F.col("position") - 1) / block_rows).cast("bigint")
    lists = marked.groupBy("c", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("position", "code"))).alias("rows"))  # block_rows at most
    measured = written(_batched(lists, _measure, "c string, block bigint, codes binary, costs array<bigint>, illegal bigint, first int, last int"), "blocks")
    ends = _batched(_per_conversation(measured, "costs", "illegal", "first", "last"), _back_over_blocks, "c string, after array<array<bigint>>, cost bigint, illegal bigint")
    ends = written(ends, "checkpoints")
    behind = ends.select("c", F.posexplode("after").alias("b", "after")).select("c", F.col("b").cast("bigint").alias("block"), "after")
    walked = measured.select("c", "block", "codes").join(behind, ["c", "block"])
    walked = written(_batched(walked, _walk_from_all, "c string, block bigint, audits array<string>, exits array<int>"), "walks")
    entered = _batched(_per_conversation(walked, "exits"), _forward_over_blocks, "c string, entries array<int>")
    closing_of = F.element_at(F.array(*[F.lit(closing(s)) for s in STATES]), F.element_at("entries", -1) + 1)
    last = F.size("entries") - 2
    entered = entered.select("c", last.alias("last"), closing_of.alias("closing"), F.posexplode(F.slice("entries", F.lit(1), F.size("entries") - 1)).alias("b", "entry"))
    entered = entered.select("c", F.col("b").cast("bigint").alias("block"), "entry", F.when(F.col("b") == F.col("last"), F.col("closing")).otherwise("").alias("closing"))
    letters = F.concat(F.element_at("audits", F.col("entry") + 1), F.col("closing"))
    return walked.join(entered, ["c", "block"]).select("c", "block", letters.alias("letters")).join(ends.select("c", "cost", "illegal"), "c")


def _numbered(rows: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edits ahead of the rows they are about, conversation by conversation, in order."""
    conv_id, turn, role, text = keys
    turns = _keyed(rows, conv_id, turn, role, text).select("c", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("block"), *ROW_ORDER, "text")
    edits = blocks.select("c", F.lit(0).alias("kind"), "block", *[F.lit(None).cast(t).alias(n) for n, t in zip(ROW_ORDER, ("bigint", "string", "binary"))], F.col("letters").alias("text"))
    both = edits.unionByName(turns)
    return both.repartition("c").sortWithinPartitions("c", "kind", F.col("block").asc_nulls_first(), *[F.col(o).asc_nulls_first() for o in ROW_ORDER])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[str, str | None, str | None]] | None]]:
    """(c, [(edit, role, text), ...]) for every row, and (c, None) behind a conversation."""
    current, letters, at, state = None, "", 0, NOTHING

    def inserted() -> list[tuple[str, str, str]]:
        nonlocal at, state
        out = []
        while at < len(letters) and letters[at] == "I":
            state, at = TURN[state], at + 1
            out.append(("I", "user" if state == USER else "assistant", ""))
        return out

    for batch in batches:
        for c, kind, role, text in zip(*(batch.column(n).to_pylist() for n in ("c", "kind", "role", "text"))):
            if c != current:
                if current is not None:
                    yield current, inserted()
                    yield current, None
                current, letters, at, state = c, "", 0, NOTHING
            if kind == 0:
                letters += text
                continue
            out = inserted()
            letter, at = letters[at], at + 1
            if letter == "R":
                state = TURN[state]
                role = "user" if state == USER else "assistant"
            elif letter == "K":
                state = NEXT[state]["sua".index(role[0])]
            yield c, [*out, (letter, role, text)]
    if current is not None:
        yield current, inserted()
        yield current, None


KEYS = ("conv_id", "turn", "role", "text")


def repair(rows: DataFrame, keys: Sequence[str] = KEYS, block_rows: int | None = None) -> DataFrame:
    """The edits and the turns they give: conversation (the id as text, empty for null), place
    (from 0), edit (`K`, `R`, `D` or `I`), role and text. Deleted rows are listed with `D`; the
    repaired conversation is the others by place.

    A row with no character but white space, or with role and text of an earlier row, must go (3);
    keeping costs 0, a new role (user or assistant) 2, an inserted empty turn 2, and a truncated row
    that stays 1 more. Of equally cheap edits those with the ASCII-least letters are taken. Nulls in
    role and text are one blank; null turns come first; rows of one turn are in order of role and
    SHA-256 of the text; repeated rows are duplicates; null ids are one conversation; an empty table
    gives no rows; other columns are not looked at. Columns are named by `keys`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, size, place = [], 0, 0

        def batch_of(found: list) -> pa.RecordBatch:
            c, n, edit, role, text = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()), pa.array(n, pa.int64()), pa.array(edit, pa.string()), pa.array(role, pa.string()), pa.array(text, pa.string())],
                                              names=["conversation", "place", "edit", "role", "text"])

        for c, edits in _edited(batches):
            if edits is None:
                place = 0
            for edit, role, text in edits or []:
                lines.append((c, place, edit, role, text))
                place, size = place + 1, size + len(text)
            if len(lines) >= 10_000 or size > 1 << 22:
                yield batch_of(lines)
                lines, size = [], 0
        if lines:
            yield batch_of(lines)

    blocks = audits(marked_rows(rows, *keys), block_rows)
    return _numbered(rows, blocks, keys).mapInArrow(run, "conversation string, place bigint, edit string, role string, text string")


def digest(rows: DataFrame, originals: DataFrame | None = None, keys: Sequence[str] = KEYS, block_rows: int | None = None) -> DataFrame:
    """One row per conversation of `originals` (default `rows`): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256, over the repairs of `repair`.

    gaps is the number of turns missing between the first and the last (null turns do not
    count; 0 without others); blank, duplicate and truncated count first faults; illegal counts
    neighbours whose roles' initials may not follow each other. Conversations without rows have
    zeros, no audit and the hash of the empty text. The text of a conversation streams through
    its hash; nothing of it is gathered."""
    originals = rows if originals is None else originals
    conv_id = keys[0]
    marked = written(marked_rows(rows, *keys), "marked")
    counts = marked.groupBy("c").agg(
        *[F.sum(F.col(n).cast("bigint")).alias(n) for n in ("blank", "duplicate", "truncated")], F.min("turn").alias("lo"), F.max("turn").alias("hi")
    )
    turns = marked.where("turn is not null").select("c", "turn").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("turns"))
    blocks = written(audits(marked, block_rows), "audits")
    whole = blocks.groupBy("c").agg(F.min("cost").alias("cost"), F.min("illegal").alias("illegal"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, sha, audit, kept = [], hashlib.sha256(), [], 0

        def batch_of(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*found)], names=["c", "audit", "repaired_sha256"])

        for c, edits in _edited(batches):
            if edits is None:
                done.append((c, "".join(audit), sha.hexdigest()))
                sha, audit, kept = hashlib.sha256(), [], 0
                if len(done) >= 1000:
                    yield batch_of(done)
                    done = []
                continue
            for edit, role, text in edits:
                audit.append(edit)
                if edit != "D":
                    sha.update(f"{'\n' * bool(kept)}{role}:{text}".encode())
                    kept += 1
        if done:
            yield batch_of(done)

    hashed = _numbered(rows, blocks.select("c", "block", "letters"), keys).mapInArrow(run, "c string, audit string, repaired_sha256 string")
    found = hashed.join(counts, "c").join(whole, "c").join(turns, "c", "left").select(
        "c", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    )
    named = originals.select(F.col(f"`{conv_id}`").alias("conv_id")).distinct().withColumn("c", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return named.join(found, "c", "left").select(
        "conv_id", *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        *[F.coalesce(F.col(n), F.lit(e)).alias(n) for n, e in empty.items()],
    )
