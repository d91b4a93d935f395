"""Personal data: fixed forms, and identifiers found from the contexts those forms induce.

1. Seeds: texts that have one of the fixed forms (email, ip, card, phone) or are long key-like
   strings (secret). The words before a seed and the marks between are its lexical patterns,
   whether blanks stand between or not. A pattern with seeds of a kind in `least` documents or
   more is a candidate, however many other documents there are: more rows never take one away.
   Candidates, graph and scores are Spark tables; texts are matched with blocks of about BLOCK
   patterns, more patterns take more passes.
2. Graph: how often each candidate pattern is followed by which identifier, or by any other
   word, counted over all texts.
3. Scoring: identifiers start with 1 for the kind of a seed and 0 else. A pattern scores the
   mean of what follows it (smoothed), an identifier the best of its patterns, in turn for
   `rounds` rounds of Spark joins.
4. Patterns that end with a score of `confidence` or more mark what follows them as the
   pattern's kind, where it looks like an identifier and no fixed form already covers it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from quadloom.llm.tables import carried, carried_on, map_batches, schema_of, text_of
from quadloom.plans.cut import written

KINDS = ["email", "ip", "card", "phone", "secret"]
#: The fixed forms. The rewritten expressions match what the plain ones do, in linear time:
#: an email's local part is looked up backwards from its @, and a run of digits is tried once.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
DIGIT_START = tuple("+0123456789")
DIGITS = re.compile(r"[^0-9]+")
#: Key-like strings: long hexadecimal, or long and mixed of letters and digits.
SECRET = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])(?:[0-9a-fA-F]{32,}|[A-Za-z0-9_/+=-]{36,})")
#: Texts are read in units: runs without white space, signs of assignment, quotes and marks of
#: lists. The same units give patterns and are matched by them, so `key="x"`, `{"key":"x"}` and
#: `key = "x"` all show what follows the key.
GAP = re.compile(r"[\s=:\"'`,;&?|(){}\[\]<>]")
UNIT = re.compile(r"([\s=:\"'`,;&?|(){}\[\]<>]*+)([^\s=:\"'`,;&?|(){}\[\]<>]++)")
RUN = re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-][A-Za-z0-9_/+=-]{31,}+")
ASSIGN = re.compile("=+")
RUN_END = re.compile(r"[\"'`)\]}>.,;:!?#*$%&|]*+(?:\s|$)|[\"'`,;&)}\]>]")
QUOTES, CLOSE = "\"'`", "\"'`)]}>.,;:!?#*$%&|"
QUOTED = {q: re.compile(rf"[^\s{q}]+") for q in QUOTES}
BARE = re.compile(r"""(?:[^\s"'`,;&|}]|[,;&|}](?!["']?[A-Za-z_][\w.-]*+["']?[=:]))+""")
LONGEST_CONTEXT, LONGEST_GLUE = 64, 8
#: Patterns (of at most 75 characters) that a pass over the texts looks for.
BLOCK = 200_000
MARK = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("size", pa.int32()), ("kind", pa.string())])


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def octet(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and not NOT_LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed forms, leftmost and without overlaps per kind."""
    out = []
    if not ANY.search(text):
        return out
    out += [(a, "email", b) for a, b in emails(text)]
    out += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if all(map(octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((m.start(), "card", m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(DIGITS.sub("", m[0])) <= 15:
            out.append((m.start(), "phone", m.end()))
    return out


def value_end(text: str, at: int, glue: str) -> int:
    """Where the value that begins at `at` ends, closing marks left off: at white space or the
    quote that opened it; without one at any quote, or where a next key begins."""
    quote = glue[-1:] if glue[-1:] in QUOTES else ""
    b = (QUOTED[quote] if quote else BARE).match(text, at).end()
    while b > at and text[b - 1] in CLOSE:
        b -= 1
    return b


def identifier(word: str) -> bool:
    return len(word) >= 6 and bool(ANY.search(word))


def contexts(before: list[str], glue: str) -> list[str]:
    """Patterns of what stands before an entity: the last word, the last two, and a sign of
    assignment alone, each with the marks between it and the entity. Overlong words and marks
    make no pattern."""
    if len(glue) > LONGEST_GLUE:
        return []
    return [" " + glue] * ("=" in glue or ":" in glue) + [
        f"{' '.join(before[-k:])} {glue}"
        for k in (1, 2)
        if len(before) >= k and sum(map(len, before[-k:])) <= LONGEST_CONTEXT
    ]


def lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def before(text: str, at: int) -> tuple[list[str], str] | None:
    """The last two units before a place and the marks behind them; none inside a unit."""
    part = lowered(text[max(0, at - 4 * LONGEST_CONTEXT) : at])
    words = UNIT.findall(part)
    rest = part[sum(len(g) + len(w) for g, w in words) :]
    return None if part and not rest else ([w for _, w in words[-2:]], "".join(rest.split()))


def seeds(text: str) -> Iterator[tuple[int, str, int]]:
    """Base spans, and key-like strings that hold none of them, without the key they are
    attached to."""
    found = base_spans(text)
    yield from found
    if ANY.search(text):
        for m in RUN.finditer(text):
            a, b = m.span()
            if text.startswith("//", a) or (a and not GAP.match(text[a - 1])) or not RUN_END.match(text, b):
                continue
            starts = [a, *(x.end() for x in ASSIGN.finditer(text, a, b))]
            a = max((x for x in starts if SECRET.fullmatch(text, x, b)), default=-1)
            if a >= 0 and not any(s < b and e > a for s, _, e in found):
                yield a, "secret", b


def seed_patterns(texts: DataFrame, least: int) -> DataFrame:
    """Candidate (of, pattern): kinds and what stands before their seeds in `least` documents or
    more."""

    def run(batch: pa.RecordBatch) -> dict:
        count: Counter = Counter()
        for text in batch.column(0).to_pylist():
            own = set()
            for a, kind, _ in seeds(text or ""):
                if known := before(text, a):
                    own.update((kind, p) for p in contexts(*known))
            count.update(own)
        keys = list(count)
        return {"kind": pa.array([k for k, _ in keys], pa.string()), "pattern": pa.array([p for _, p in keys], pa.string()), "n": pa.array([count[k] for k in keys], pa.int64())}

    counted = map_batches(texts, run, "kind string, pattern string, n bigint").groupBy("kind", "pattern").agg(F.sum("n").alias("n"))
    return written(counted.where(F.col("n") >= least).select(F.col("kind").alias("of"), "pattern"), "seed-patterns")


def in_blocks(patterns: DataFrame) -> Iterator[list[Row]]:
    """Rows of different patterns in blocks of about BLOCK, the driver holds one at a time; none
    for no rows."""
    n = -(-patterns.count() // BLOCK)
    for i in range(n):
        yield patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == i).collect()


def last_words(patterns: Iterable[str]) -> set[str]:
    """The words directly before the marks of patterns; empty for marks alone."""
    return {p.rsplit(" ", 1)[0].rsplit(" ", 1)[-1] for p in patterns}


def followers(text: str, patterns: Container[str], last: set[str]) -> Iterator[tuple[str, int, int]]:
    """(pattern, start, end) of every value that follows a candidate pattern; of one value the
    shorter patterns first."""
    at, one, two, marks = 0, "", "", "" in last
    for gap, word in UNIT.findall(lowered(text)):
        at += len(gap)
        end = at + len(word)
        if one in last or (marks and ("=" in gap or ":" in gap)):
            glue = "" if gap == " " else "".join(gap.split())
            after = f"{one} {glue}"
            hit = [after] if one and after in patterns else []
            if two and (after := f"{two} {after}") in patterns:
                hit.append(after)
            if ("=" in glue or ":" in glue) and (after := " " + glue) in patterns:
                hit.insert(0, after)
            if hit:
                plain = word.isalpha() and text[end : end + 1] == " "
                for p in hit:
                    yield p, at, end if plain else value_end(text, at, glue)
        at, one, two = end, word, one


def graph(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(pattern, instance, n, kinds): what follows each candidate pattern how often in all
    texts; ordinary words are one instance without name, kinds has those of seeds."""

    def one_pass(patterns: set[str]) -> DataFrame:
        last = last_words(patterns)

        def run(batch: pa.RecordBatch) -> dict:
            count: Counter = Counter()
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                known = None
                for p, a, b in followers(text, patterns, last):
                    word = text[a:b]
                    if identifier(word) or (b < len(text) and word[:1] in DIGIT_START):
                        if known is None:
                            known = {s: (k, e) for s, k, e in seeds(text)}
                        kind, end = known.get(a, (None, b))
                        count[p, text[a : min(end, a + 256)], kind] += 1
                    else:
                        count[p, "", None] += 1
            keys = list(count)
            return {
                "pattern": pa.array([k[0] for k in keys], pa.string()), "instance": pa.array([k[1] for k in keys], pa.string()),
                "kind": pa.array([k[2] for k in keys], pa.string()), "n": pa.array([count[k] for k in keys], pa.int64()),
            }

        return map_batches(texts, run, "pattern string, instance string, kind string, n bigint")

    edges = None
    for block in in_blocks(candidates.select("pattern").distinct()):
        found = one_pass({r["pattern"] for r in block})
        edges = found if edges is None else edges.unionAll(found)
    kinds = F.collect_set("kind").alias("kinds")  # five at most
    return written(edges.groupBy("pattern", "instance").agg(F.sum("n").alias("n"), kinds), "pattern-graph")


def confident(edges: DataFrame, candidates: DataFrame, rounds: int, confidence: float) -> DataFrame:
    """(pattern, kind) of the patterns that score `confidence` or more after `rounds` rounds."""
    seed = F.array_contains("kinds", F.col("of")).cast("double").alias("seed")
    by_kind = written(edges.join(candidates, "pattern").select("pattern", "of", "instance", "n", seed), "pattern-kinds")
    total = written(by_kind.groupBy("of", "pattern").agg(F.sum("n").alias("all")), "pattern-totals")
    named = by_kind.where("instance != ''")  # ordinary words stay at 0
    belief = named.groupBy("of", "instance").agg(F.max("seed").alias("belief"))
    scores = None
    for _ in range(rounds):
        good = named.join(belief, ["of", "instance"]).groupBy("of", "pattern").agg(F.sum(F.col("n") * F.col("belief")).alias("good"))
        scores = written(good.join(total, ["of", "pattern"]).select("of", "pattern", (F.col("good") / (F.col("all") + 1)).alias("score")), "pattern-scores")
        belief = named.join(scores, ["of", "pattern"]).groupBy("of", "instance").agg(F.greatest(F.max("seed"), F.max("score")).alias("belief"))
    best = scores.where(F.col("score") >= confidence).groupBy("pattern").agg(F.max(F.struct("score", "of")).alias("best"))
    return written(best.select("pattern", F.col("best.of").alias("kind")), "confident-patterns")


def find(docs: DataFrame, least: int = 5, rounds: int = 3, confidence: float = 0.9, with_text: bool = False, carry: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, `base` and `found`, arrays of (kind, start, end) in
    code points, end exclusive, by start, then kind; `found` has the base spans and the spans of
    confident patterns that touch no base span. `with_text` adds `masked`, the text with every
    found span replaced by its kind in angle brackets (null stays null); `carry` adds the whole
    row as `row`.

    A null or empty text has no spans. Texts of any length are read whole. Repeated rows all
    stay, null ids stay null, an empty table gives no rows, other columns are not looked at."""
    rows = carried(docs, F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), text_of(docs, text).alias("text"), carry=carry)
    texts = rows.select("text")
    candidates = seed_patterns(texts, least)
    names = [] if candidates.isEmpty() else in_blocks(confident(graph(texts, candidates), candidates, rounds, confidence))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    struct = "array<struct<kind: string, start: int, end: int>>"

    def after_patterns(text: str | None, known: dict[str, str], last: set[str], had: list) -> list:
        """Spans (start, end, length of the pattern, kind) behind the patterns, and `had`."""
        if not text or not known:
            return had
        return had + [{"start": a, "end": b, "size": len(p), "kind": known[p]} for p, a, b in followers(text, known, last) if identifier(text[a:b])]

    def spans(text: str | None, marked: list) -> tuple[list, list]:
        base = sorted(base_spans(text or ""), key=lambda s: (s[0], KINDS.index(s[1])))
        more, free = {}, 0
        for s in sorted(marked, key=lambda s: (s["start"], s["size"])):
            a, b = s["start"], s["end"]
            if (a >= free or (a, b) in more) and not any(x < b and y > a for x, _, y in base):
                more[a, b], free = s["kind"], b
        every = sorted([*base, *((a, k, b) for (a, b), k in more.items())], key=lambda s: (s[0], KINDS.index(s[1])))
        return [[{"kind": k, "start": a, "end": b} for a, k, b in x] for x in (base, every)]

    def one_pass(df: DataFrame, known: dict[str, str], first: bool, final: bool) -> DataFrame:
        last = last_words(known)

        def run(batch: pa.RecordBatch) -> dict:
            texts = batch.column(1).to_pylist()
            had = [[]] * len(texts) if first else batch.column("marked").to_pylist()
            marked = [after_patterns(t, known, last, h) for t, h in zip(texts, had)]
            out = {"doc_id": batch.column(0)}
            if not final:
                return out | {"text": batch.column(1), "marked": pa.array(marked, pa.list_(MARK))} | carried_on(batch)
            both = [spans(t, m) for t, m in zip(texts, marked)]
            out |= {"base": pa.array([x for x, _ in both], kind), "found": pa.array([x for _, x in both], kind)}
            if with_text:
                out["masked"] = pa.array([masked(t, every) for t, (_, every) in zip(texts, both)], pa.string())
            return out | carried_on(batch)

        columns = f"doc_id bigint, base {struct}, found {struct}" + ", masked string" * with_text
        if not final:
            columns = "doc_id bigint, text string, marked array<struct<start: int, end: int, size: int, kind: string>>"
        return map_batches(df, run, schema_of(columns, docs if carry else None))

    waiting, first = iter(names), True
    block = next(waiting, [])
    while block is not None:
        following = next(waiting, None)
        rows = one_pass(rows, {r["pattern"]: r["kind"] for r in block}, first, following is None)
        block, first = following, False
        if block is not None:
            rows = written(rows, "marked-texts")
    return rows


def masked(text: str | None, spans: list[dict]) -> str | None:
    """The text with spans replaced; of spans that overlap the first names the mark."""
    if not spans:
        return text
    out, at, open_to = [], 0, -1
    for s in spans:
        if s["start"] < open_to:
            open_to = at = max(open_to, s["end"])
            continue
        out += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = open_to = s["end"]
    return "".join([*out, text[at:]])


def joined(spans: str):
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", parts)


def digest(found: DataFrame) -> DataFrame:
    """The report of a `find` result, one row per document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"))
