"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks (runs of text between block-level tags) with the open elements above
them. Costs of a small fixed classifier (which elements stand above, words in their class and id,
share of linked text) become capacities to the terminals "text" and "rest"; neighbouring blocks
and blocks close in the tree get edges, stronger the closer they are. Maximum flow gives the
cheapest labelling; the blocks on the text side, in page order, are the main text. A form or a
named element that holds nearly all running text, or more than half and the page's article, is the
page's wrapper and no evidence. A page on which nothing is spoken for keeps what nothing speaks against.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quadloom.llm.tables import map_batches, text_of

TAG = re.compile(
    r"""<(?:(?P<comment>!--)|(?P<other>[!?][^>]*+>)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)"""
    r"""(?P<attributes>(?:[^>"'<]++|"[^"<]*+"|'[^'<]*+')*+>|[^>]*+>))"""
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: Elements whose content is never text of the page.
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "math", "iframe", "object", "canvas", "title", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that end where one of the same set begins.
SIBLING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Block elements that end an open paragraph.
ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Costs in tenths: elements above a block that speak against or for it.
NEVER = set("head nav footer aside form button select dialog menu".split())
AGAINST = {"header": 40, "figcaption": 4, "li": 3, "td": 2, "option": 60}
FOR = {"article": 60, "main": 30, "section": 4, "p": 12, "h1": 14, "h2": 8, "h3": 8, "h4": 6, "blockquote": 8, "pre": 8}
NAMED_AGAINST = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|alert|banner|breadcrumbs?|comment\w*|consent|cookies?|copyright|disclaimer|discussion|disqus|footer|gdpr|header|legal|login|masthead|"
    r"menu|modal|nav\w*|newsletter|notice|notification|overlay|pagination|paywall|popup|promo\w*|recommend\w*|related|replies|reply|"
    r"respond|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscri\w*|tags?|toolbar|widget)(?:$|[\s_-])",
    re.I,
)
NAMED_FOR = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?:$|[\s_-])", re.I)
#: Class and id tokens that tell what a page has or lacks, not what an element is.
STATE = re.compile(r"(?:has|no|not|with|without)[_-]", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "form", "menu", "menubar", "alert"}
FIXED = 1 << 20
#: Elements that are not shown: by attribute or style.
HIDDEN = re.compile(r"""\shidden(?=[\s=/>])(?!\s*=\s*["']?(?:false|until-found))|\sstyle\s*=\s*(?:"[^"]*|'[^']*)(?:display\s*:\s*none|visibility\s*:\s*hidden)""", re.I)
QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Headings of what readers have written.
READERS = re.compile(r"(?:\(?\d+\)?\s*(?:comments?|responses?|replies)(?: (?:on|to)\b.*)?|(?:reader |user |recent |all )?comments?\s*(?:\(?\d+\)?)?:?|(?:leave|post|add|write) an? (?:reply|comment)[.:]?)", re.I)
#: Cost of taking any block in.
PRIOR = 8
#: Capacity between neighbours: same parent, same grandparent, elsewhere.
CLOSE, NEAR, FAR = 20, 8, 1


class Element:
    __slots__ = ("name", "up", "against", "favour", "never", "inline", "hard", "named", "mark")

    def __init__(self, name: str, up: "Element | None", attributes: str = ""):
        self.name, self.up = name, up
        self.inline = name in INLINE
        self.hard = (up.hard if up else False) or (name in NEVER and name != "form")
        self.favour = (up.favour if up else 0) + FOR.get(name, 0)
        self.named = 0
        if name not in ("html", "body") and (found := HIDDEN.search(attributes)):
            # the bare word must not stand inside a value
            self.hard |= "style" in found[0].lower() or bool(HIDDEN.search(QUOTED.sub("=x", attributes)))
        if "=" in attributes:
            for key, *values in ATTRIBUTE.findall(attributes):
                value = "".join(values)
                if key.lower() == "role":
                    self.hard |= value.lower() in ROLES
                    continue
                value = " ".join(x for x in value.split() if not STATE.match(x))
                if name not in ("html", "body") and NAMED_AGAINST.search(value):
                    self.named += 90
                elif NAMED_FOR.search(value):
                    self.favour += 10
        #: The innermost element, this one or above, that is a form or named against.
        self.mark = self if self.named or name == "form" else up.mark if up else None
        self.settle(False)

    def settle(self, wrapper: bool) -> None:
        """Costs with those of the elements above; a wrapper's name and form do not count."""
        up = self.up
        self.never = self.hard or (up.never if up else False) or (self.name == "form" and not wrapper)
        self.against = (up.against if up else 0) + AGAINST.get(self.name, 0) + (0 if wrapper else self.named)


def blocks(page: str) -> list[tuple[str, Element, float]]:
    """Blocks in page order: text (references decoded, white space one blank), the block element
    it stands in, and the share of its characters inside links. Unclosed, misnested and cut
    tags are read as browsers mostly do."""
    here, out = Element("#page", None), []
    pieces: list[str] = []
    linked = links = 0
    raw_end: re.Pattern | None = None
    at, n = 0, len(page)

    def flush(owner: Element) -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                while owner.inline and owner.up:
                    owner = owner.up
                out.append((text, owner, min(1.0, linked / len(text))))
            pieces.clear()
        linked = 0

    last_gt = page.rfind(">")
    while at < n:
        lt = page.find("<", at)
        m = None
        while 0 <= lt < last_gt and not (m := TAG.match(page, lt)):
            lt = page.find("<", lt + 1)
        text_end = m.start() if m else n
        if not m and 0 <= (cut := page.rfind("<", max(at, last_gt + 1))) and re.match(r"</?[a-zA-Z!]", page[cut : cut + 3]):
            text_end = cut  # the page was cut inside a tag
        if text_end > at:
            pieces.append(page[at:text_end])
            linked += (text_end - at) if links else 0
        if not m:
            break
        at = m.end()
        if m["comment"]:
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        if m["other"]:
            continue
        name, attributes = m["name"].lower(), m["attributes"]
        if m["close"]:
            found = here
            while found.up and found.name != name:
                found = found.up
            if found.up:
                if name not in INLINE:
                    flush(here)
                elif name == "a":
                    links = max(0, links - 1)
                if name in INLINE:  # an inline end tag does not close the blocks inside
                    up = here
                    while up is not found and up.inline:
                        up = up.up
                    if up is not found:
                        continue
                here = found.up
            elif name == "p":
                flush(here)
            continue
        if name in RAW:
            if not attributes.rstrip(">").endswith("/"):
                raw_end = re.compile(rf"</{re.escape(name)}\s*>", re.I)
                end = raw_end.search(page, at)
                at = end.end() if end else n
            continue
        if name in VOID:
            if name == "br":
                pieces.append(" ")
            elif name == "hr":
                flush(here)
            continue
        if name not in INLINE:
            flush(here)
            ends = SIBLING.get(name, set()) | ({"p"} if name in ENDS_P else set())
            up = here
            while up.up and (up.inline or up.name in ends):
                if up.name in ends:
                    here = up.up
                up = up.up
            while here.inline and here.up:  # formatting left open does not reach into new blocks
                here = here.up
            links = 0
        elif name == "a":
            links += 1
        if not attributes.endswith("/>"):
            here = Element(name, here, attributes)
    flush(here)
    return out


def settle_readers(found: list[tuple[str, Element, float]]) -> None:
    """What readers have written under a heading that says so, without a class of its own: the
    heading and what follows it in the element around it, up to a heading as high."""
    rank = lambda e: HEADINGS.index(e.name) if e.name in HEADINGS else len(HEADINGS)
    part: tuple[Element, int] | None = None
    for text, e, _ in found:
        mine = e.name in HEADINGS and READERS.fullmatch(text) is not None
        if part and not mine and (rank(e) <= part[1] or not inside(e, part[0])):
            part = None
        if mine:
            part = (e.up, rank(e))
        if part:
            e.hard = e.never = True


def inside(e: Element | None, around: Element) -> bool:
    while e and e is not around:
        e = e.up
    return e is around


def in_article(e: Element | None, mark: Element | None) -> bool:
    """Whether an article or main element stands between a block and its mark (or the page)."""
    while e and e is not mark:
        if e.name in ("article", "main"):
            return True
        e = e.up
    return False


def settle_wrappers(found: list[tuple[str, Element, float]]) -> None:
    """Forms and named elements that hold over four fifths of the running text that nothing else
    speaks against, or over half of it (a form without a name: any) in an article where there is no
    other, are wrappers of the page: no evidence."""
    sizes, marks, owners = [], [], []
    for text, e, linked in found:
        if not e.hard and linked < 0.5:
            words = text.count(" ") + 1
            sizes.append(words if words > 3 else 0)  # a few words are no running text
            marks.append(e.mark)
            owners.append(e)
    wrappers: set[Element] = set()
    while True:
        held: dict[Element | None, list[int]] = {}
        for m, words, e in zip(marks, sizes, owners):
            one = held.setdefault(m, [0, 0])
            one[0] += words
            one[1] += (words or 1) * in_article(e, m)
        free, free_article = held.pop(None, [0, 0])
        # where an article stands on its own, what is around or beside it wraps nothing
        most = max((m for m in held if not free_article or in_article(m.up, None)), key=lambda m: held[m][0], default=None)
        if most is None:
            break
        words, article = held[most]
        holds = article > free or (article and most.name == "form" and not most.named)  # no bare form stands in for an article
        if not words or (words <= 4 * free and not (holds and not free_article)):
            break
        wrappers.add(most)
        marks = [(m.up.mark if m.up else None) if m is most else m for m in marks]
    if not wrappers:
        return
    done: set[Element] = set()
    for _, e, _ in found:
        chain = []
        while e and e not in done:
            chain.append(e)
            done.add(e)
            e = e.up
        for x in reversed(chain):
            x.settle(x in wrappers)


def capacities(found: list[tuple[str, Element, float]]) -> tuple[list[int], list[int], list[tuple[int, int, int]]]:
    """Cost of leaving each block out, of taking it in, and the edges between blocks."""
    settle_readers(found)
    settle_wrappers(found)
    leave, take = [], []
    for text, e, linked in found:
        if e.never:
            leave.append(0)
            take.append(FIXED)
            continue
        words = text.count(" ") + 1
        sentence = text[-1] in ".!?…:;\"'”»)" and words > 3
        leave.append(e.favour + min(words, 30) // 3 + 4 * sentence)
        take.append(e.against + PRIOR + int(40 * linked))
    edges, last_in = [], {}
    for i, (_, e, _) in enumerate(found):
        if i:
            before = found[i - 1][1]
            close = e is before or e.up is before.up
            near = e.up is before or before.up is e or (e.up and before.up and (e.up.up is before.up or before.up.up is e.up))
            if e.never != before.never or abs(e.against - before.against) >= 40:
                near = close = False  # the page itself draws a line here
            edges.append((i - 1, i, CLOSE if close else NEAR if near else FAR))
        key = (id(e.up), e.never, e.against // 40)
        if key in last_in and last_in[key] < i - 1:
            edges.append((last_in[key], i, CLOSE))
        last_in[key] = i
    return leave, take, edges


def minimum_cut(leave: list[int], take: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for the nodes on the "text" side of a minimum cut, where cutting a node off the
    text costs `leave`, off the rest `take`, and an edge its capacity if its ends differ. Of
    several minimum cuts the one with the fewest nodes on the text side."""
    n = len(leave)
    spare = [a - b for a, b in zip(leave, take)]  # flow text -> node -> rest is taken at once
    joint: dict[tuple[int, int], int] = {}
    for a, b, c in edges:
        pair = (a, b) if a < b else (b, a)
        joint[pair] = joint.get(pair, 0) + c
    ends, room = [], []  # edge k leads to ends[k] and has room[k] left, k ^ 1 leads back
    around: list[list[int]] = [[] for _ in range(n)]
    for (a, b), c in joint.items():
        around[a].append(len(ends))
        around[b].append(len(ends) + 1)
        ends += [b, a]
        room += [c, c]
    while True:  # rounds of all shortest paths from nodes with text capacity left to nodes that lack it
        level = [0 if x > 0 else -1 for x in spare]
        ring, depth, met = [i for i in range(n) if spare[i] > 0], 0, False
        while ring and not met:
            depth, after = depth + 1, []
            for i in ring:
                for k in around[i]:
                    j = ends[k]
                    if room[k] and level[j] < 0:
                        level[j] = depth
                        after.append(j)
                        met = met or spare[j] < 0
            ring = after
        if not met:
            return [x >= 0 for x in level]
        at = [0] * n
        for source in range(n):
            while spare[source] > 0:
                path, i = [], source  # edges walked; each is looked at until it has no use left
                while not (spare[i] < 0 and path):
                    while at[i] < len(around[i]):
                        k = around[i][at[i]]
                        if room[k] and level[ends[k]] == level[i] + 1:
                            break
                        at[i] += 1
                    if at[i] < len(around[i]):
                        path.append(k)
                        i = ends[k]
                    elif path:
                        i = ends[path.pop() ^ 1]
                        at[i] += 1
                    else:
                        break
                if not path:
                    break
                flow = min(spare[source], -spare[i], *[room[k] for k in path])
                spare[source] -= flow
                spare[i] += flow
                for k in path:
                    room[k] -= flow
                    room[k ^ 1] += flow


def main_text(page: str | None) -> str:
    """Texts of the blocks on the text side, in page order, joined by one blank."""
    found = blocks(page or "")
    if not found:
        return ""
    leave, take, edges = capacities(found)
    taken = minimum_cut(leave, take, edges)
    if not any(taken):  # nothing is spoken for: what nothing speaks against stays
        fair = [not e.never and e.against < PRIOR and linked < 0.5 for _, e, linked in found]
        leave = [x + 1 + PRIOR * f for x, f in zip(leave, fair)]
        taken = minimum_cut(leave, take, edges)
    return " ".join(text for (text, _, _), keep in zip(found, taken) if keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of `pages`: page_id, url, text and n_chars (code points).

    A null or empty page, and one without text, gives the empty text. Nothing of a long page is
    cut off. Null ids and urls stay null, repeated rows all stay, an empty table gives no rows,
    other columns are not looked at."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            texts = [main_text(x) for x in part.column(2).to_pylist()]
            yield {
                "page_id": part.column(0), "url": part.column(1), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            }

    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), text_of(pages, html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return map_batches(rows, run, f"page_id {kind}, url string, text string, n_chars bigint")
