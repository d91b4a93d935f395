"""Plain versions of the operators: short, slow, one text or all pairs at a time."""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def simhash(text: str | None) -> int:
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(prints: list[int]) -> list[list[int]]:
    """For each print the rows reachable over links of at most 3 bits."""
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [[j for j, g in enumerate(group) if g == group[i]] for i in range(len(prints))]


def repetition(text: str | None, window: int = 8) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    grams = Counter(tuple(words[i : i + window]) for i in range(n - window + 1))
    hit = set()
    for i in range(n - window + 1):
        if grams[tuple(words[i : i + window])] > 1:
            hit.update(range(i, i + window))
    longest = 0
    for i in range(n):
        for j in range(i):
            size = 0
            while i + size < n and words[i + size] == words[j + size]:
                size += 1
            longest = max(longest, size)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
        sum(len(words[i]) for i in hit), longest if longest >= window else 0,
    )


def contamination(text: str | None, items: list[tuple], window: int = 13) -> tuple:
    words = NORMAL.findall(lower(text or ""))
    hit, found = set(), set()
    for item, body in items:
        own = NORMAL.findall(lower(body or ""))
        for k in range(max(1, len(own) - window + 1)) if own else ():
            gram = own[k : k + window]
            for i in range(len(words) - len(gram) + 1):
                if words[i : i + len(gram)] == gram:
                    hit.update(range(i, i + len(gram)))
                    found.add(item or "")
    ids = ",".join(sorted(found))
    return len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


def personal(text: str | None) -> list[tuple]:
    text = text or ""

    def luhn(s):
        d = [int(c) for c in s][::-1]
        return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0

    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    order = ["email", "ip", "card", "phone"]
    return sorted(((k, m.start(), m.end()) for k, m in out), key=lambda s: (s[1], order.index(s[0])))


def repeats(texts: list[str | None], window: int) -> list[tuple]:
    words = [WORD.findall(t or "") for t in texts]
    grams = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - window + 1) if grams[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def best_fit(lengths: list[int], capacity: int) -> int:
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def hard_negatives(rows: list[tuple]) -> list[tuple]:
    """rows of (vec_id, vector, label); anchors are ids divisible by 50."""
    ok = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows
          if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for n, (i, v, l) in enumerate(ok):
        if i is None or i % 50:
            continue
        scored = [(min(max(sum(a * b for a, b in zip(v, w)), -(2**63)), 2**63 - 1), j, m, k) for k, (j, w, m) in enumerate(ok) if len(w) == len(v)]
        positives = sorted((s for s in scored if s[2] == l and s[3] != n), key=order)[:5]
        others = sorted((s for s in scored if s[2] != l), key=order)
        for p in positives:
            hits = [s for s in others if 50 * p[0] <= 100 * s[0] <= 95 * p[0]][:3]
            out += [(i, p[1], r, s[1], p[0], s[0]) for r, s in enumerate(hits, 1)]
    return out


def damaged(rows: list[tuple]) -> dict:
    """Rows of (conv_id, turn, role, text) after damage, by conversation and in order."""
    shown = lambda x: " " if x is None else str(x)
    out = defaultdict(list)
    for c, t, role, text in rows:
        out[c]
        fate = zlib.crc32(f"{shown(c)}:{shown(t)}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", shown(text)) if fate == 2 else shown(text)
        out[c] += [(t, "user" if fate == 4 else shown(role), text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    for turns in out.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def repaired(turns: list[tuple]) -> tuple:
    """Cheapest edits by a shortest path search over all of them, equal costs in ASCII order."""
    seen, faults = set(), []
    for _, role, text in turns:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    fits = lambda last, x: x != "" and x in {"": "su", "s": "u", "u": "a", "a": "u"}[last]
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, kept = heapq.heappop(heap)
        if i == len(turns) and last in ("", "a"):
            break
        if (i, last) in done:
            continue
        done.add((i, last))
        ways = [(2, "I", i, x, ((x, ""),)) for x in ("user", "assistant") if fits(last, x[0])]
        if i < len(turns):
            _, role, text = turns[i]
            ways.append((3, "D", i + 1, last, ()))
            if faults[i] in ("", "truncated"):
                more = int(faults[i] == "truncated")
                ways += [(more, "K", i + 1, role, ((role, text),))] * fits(last, role[:1])
                ways += [(2 + more, "R", i + 1, x, ((x, text),)) for x in ("user", "assistant") if fits(last, x[0])]
        for c, letter, j, role, own in ways:
            heapq.heappush(heap, (cost + c, audit + letter, j, role[:1], kept + own))
    text = "\n".join(f"{a}:{b}" for a, b in kept)
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()
