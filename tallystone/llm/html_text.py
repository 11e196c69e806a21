"""Main text of web pages: a tree-structured model over the page's blocks, solved by message passing.

Every block element is a node with a hidden state, content or not. A node's tag, names, size and
link share speak for a state; its parent's state speaks for the same state. Messages pass from leaves to
root and back, and each node's marginal decides on its own text. Potentials come from counts over labelled pages; listed
names begin with some counts, and what they say is weighed against the node's looks, parent and children.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import pick, scan

# Names of HTML elements.
BLOCKS = set(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript object ol "
    "option p pre section select summary table tbody td template textarea tfoot th thead title tr ul video".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "template", "noscript", "iframe", "svg")
#: An opening tag ends these open elements (up to the nearest other block).
ENDS = {x: {"p"} for x in BLOCKS - {"button", "label", "option", "caption", "td", "th", "tr"}} | {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
# Names that label the blocks of training pages and that the model expects something of before it has seen any page: tags
# (``<``), and words of class, id and role.
CONTENT_TAGS, CONTENT_NAMES = {"<article", "<main"}, {"article", "main", "articlebody", "post", "entry", "story"}
OTHER_TAGS = set("<nav <footer <aside <form <head <title <button <select <option <textarea <fieldset <dialog <menu".split())
OTHER_NAMES = set(
    "nav navigation menu header masthead footer aside sidebar ad ads advert advertisement sponsored promo banner "
    "cookie cookies consent notice alert popup modal form newsletter subscribe signup login search comment comments "
    "reply replies disqus share social related recommended breadcrumb breadcrumbs pagination pager toolbar widget "
    "copyright legal dialog".split()
)
#: Elements that hold prose: a name says less about them than about a box around other elements.
PROSE = set("p h1 h2 h3 h4 h5 h6 section blockquote pre li dl dt dd table tr td th figure figcaption".split())
#: Blocks that a name counts as seen in before training: a tag or a box's whole name (``=``), and a word of other names.
SURE, CONTENT_HINT, OTHER_HINT = 20_000, 400, 40
#: Bounds of what tag, size, links and unlisted words say together: these depend on each other, and a list of links inside an
#: article is text. The least share of children that differ from their parent.
LOOKS, TURNS = (-0.5, 2.0), 0.001
_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>|<[/!?a-zA-Z][^>]*$", re.S
)
_NAMES = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_CAMEL = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")
#: Labelled pages that the model is fitted on at most: a sample by hash of the key where there are more.
MOST_LABELLED = 2_000


class Page:
    """The blocks of a page in document order; each node knows its parent, a node before it."""

    def __init__(self, source: str):
        self.tags, self.parents, self.names = ["#page"], [-1], [()]
        self.size, self.linked = [0], [0]
        self.pieces: list[tuple[int, str]] = []  # (node, text); an empty text is a break inside a node
        self._read(source)

    def _open(self, tag: str, parent: int, attributes: str) -> int:
        names = ["<" + tag]
        if attributes:
            for m in _NAMES.finditer(attributes):
                value = m[1] or m[2] or m[3] or ""
                names += [w.lower() for w in _CAMEL.findall(value)]
                if tag not in PROSE:
                    names += ["=" + w.lower() for w in value.split()]
        self.tags.append(tag)
        self.parents.append(parent)
        self.names.append(tuple(dict.fromkeys(names)))
        self.size.append(0)
        self.linked.append(0)
        return len(self.tags) - 1

    def _text(self, node: int, text: str, link: bool) -> None:
        if text:
            text = html.unescape(text)
            self.pieces.append((node, text))
            n = len(text.strip())
            self.size[node] += n
            if link:
                self.linked[node] += n

    def _read(self, source: str) -> None:
        stack, at, link, end = [0], 0, False, len(source)
        while at < end:
            m = _TAG.search(source, at)
            if m is None:
                self._text(stack[-1], source[at:], link)
                break
            self._text(stack[-1], source[at : m.start()], link)
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag == "a":
                    link = False
                elif tag in BLOCKS and any(self.tags[x] == tag for x in stack[1:]):
                    while self.tags[stack.pop()] != tag:
                        pass
                    link = False
                continue
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                at = close.end() if close else end
            elif tag == "a":
                link = True
            elif tag == "br" or tag == "hr":
                self.pieces.append((stack[-1], ""))
            elif tag in BLOCKS and tag not in VOID:
                ends = ENDS.get(tag, ())
                while len(stack) > 1 and self.tags[stack[-1]] in ends:
                    stack.pop()
                stack.append(self._open(tag, stack[-1], m[3]))

    def text(self, keep: list[bool]) -> str:
        """Texts of the kept nodes in page order; white space inside a block is one space."""
        blocks, current, last = [], [], None
        for node, text in self.pieces:
            if node != last or not text:
                blocks.append("".join(current))
                current, last = [], node
            if keep[node]:
                current.append(text)
        blocks.append("".join(current))
        return " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)

    def features(self, node: int) -> list[str]:
        """Words for what a node looks like on its own."""
        size, linked = self.size[node], self.linked[node]
        share = 0 if not size else min(3, 4 * linked // size)
        return [*self.names[node], f"#size{min(6, size.bit_length() // 2)}", f"#link{share}"]

    def labels(self) -> list[bool] | None:
        """States of the nodes of a page that marks its article itself, or None.

        What lies in a node marked as content is content, unless a node between is marked otherwise. Tags and whole names of boxes
        mark a node; words of other names do not, so counts can tell which of them occur inside articles.
        """
        if not any(MARKS_CONTENT & set(n) for n in self.names):
            return None
        state = [False] * len(self.tags)
        for i in range(1, len(state)):
            names = set(self.names[i])
            state[i] = bool(MARKS_CONTENT & names) or (state[self.parents[i]] and not MARKS_OTHER & names)
        return state


MARKS_CONTENT = CONTENT_TAGS | {"=" + n for n in CONTENT_NAMES}
MARKS_OTHER = OTHER_TAGS | {"=" + n for n in OTHER_NAMES}
MARKED = MARKS_CONTENT | MARKS_OTHER
EVEN = {(p, c): 0.5 for p in (False, True) for c in (False, True)}
#: Blocks (other, content) that each listed name counts as seen in.
PRIOR = (
    {n: (SURE, 0) for n in MARKS_OTHER} | {n: (0, SURE) for n in MARKS_CONTENT}
    | {n: (OTHER_HINT, 0) for n in OTHER_NAMES} | {n: (0, CONTENT_HINT) for n in CONTENT_NAMES}
)


class Model:
    """Log-potentials: of each feature for content, and of a child's state given its parent's."""

    def __init__(self, counts: dict[str, tuple[int, int]], moves: dict[tuple[bool, bool], int]):
        total = [1.0 + sum(c[k] for w, c in counts.items() if w.startswith("#size")) for k in (1, 0)]
        self.speaks: dict[str, float] = {}
        for word in {*counts, *PRIOR}:
            (other, content), (less, more) = counts.get(word, (0, 0)), PRIOR.get(word, (0, 0))
            odds = math.log(content + more + 0.5) - math.log(other + less + 0.5)
            self.speaks[word] = odds - math.log((total[0] + 0.5) / (total[1] + 0.5))
        self.pair = {}
        for p in (False, True):
            same, turned = moves.get((p, p), 0) + 200.0, moves.get((p, not p), 0) + 1.0
            self.pair[p, not p] = max(TURNS, turned / (same + turned))
            self.pair[p, p] = 1 - self.pair[p, not p]

    def edge(self, names: tuple[str, ...]) -> dict[tuple[bool, bool], float]:
        """Potentials between a node and its parent: a marked box is what it is under any parent, so it tells nothing of it."""
        return EVEN if MARKED.intersection(names) else self.pair

    def alone(self, features: list[str]) -> float:
        """Log-odds of content from what a node looks like on its own: its listed names, each as counts have it, and its looks."""
        named, looks = 0.0, 0.0
        for w in features:
            if w in PRIOR:
                named += self.speaks[w]
            else:
                looks += self.speaks.get(w, 0.0)
        return named + max(LOOKS[0], min(LOOKS[1], looks))

    def marginals(self, page: Page) -> list[float]:
        """Probability of content for each node: one pass of messages to the root, one back."""
        n = len(page.tags)
        edges = [tuple(e[k] for k in ((False, False), (False, True), (True, False), (True, True))) for e in map(self.edge, page.names)]
        own = [0.0] * n
        for i in range(1, n):
            own[i] = self.alone(page.features(i))
        up = [(0.0, 0.0)] * n  # the message to the parent: log weights of its states other, content
        below = [[0.0, x] for x in own]  # own potential and the children's messages
        for i in range(n - 1, 0, -1):
            ff, ft, tf, tt = edges[i]
            a, b = below[i]
            m = max(a, b)
            ea, eb = math.exp(a - m), math.exp(b - m)
            up[i] = (math.log(ff * ea + ft * eb), math.log(tf * ea + tt * eb))
            parent = below[page.parents[i]]
            parent[0] += up[i][0]
            parent[1] += up[i][1]
        belief = [(0.0, 0.0)] * n
        belief[0] = (below[0][0], below[0][1] - 5.0)  # the page as a whole is no content
        for i in range(1, n):
            ff, ft, tf, tt = edges[i]
            p = belief[page.parents[i]]
            a, b = p[0] - up[i][0], p[1] - up[i][1]  # without what this node said
            m = max(a, b)
            ea, eb = math.exp(a - m), math.exp(b - m)
            x, y = below[i][0] + math.log(ff * ea + tf * eb), below[i][1] + math.log(ft * ea + tt * eb)
            m = max(x, y)
            belief[i] = (x - m, y - m)
        return [1 / (1 + math.exp(max(-700.0, min(700.0, x - y)))) for x, y in belief]


def train(pages: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Counts over labelled pages (those that mark their article), of ``most`` rows by hash of the key at most."""

    def labelled(got, n):
        some = [i for i, source in enumerate(got["html"]) if Page((source or b"").decode()).labels() is not None]
        return [pa.array([got["order"][i] for i in some], pa.int64())]

    sample = pages.select("html")
    if most:
        # the labelled pages first in hash order lie in the first part of all pages that has enough of them; pages stay where they are
        ordered = pages.select(F.xxhash64("page_id", "html").alias("order"), "html")
        share = min(1.0, 4 * most / max(1, pages.count()))
        while True:
            first = ordered if share >= 1 else ordered.filter(F.col("order") < int(-(2**63) + share * 2**64))
            orders = scan(first, labelled, "order long", ["order", "html"]).distinct().orderBy("order").limit(most)
            orders = [r["order"] for r in orders.collect()]
            if len(orders) >= most or share >= 1:
                break
            share = min(1.0, 8 * share)
        cut = max(orders, default=-(2**63))
        sample = ordered.filter(F.col("order") <= cut).dropDuplicates(["order"])  # copies of a page count once

    def work(got, n):
        counts: Counter = Counter()
        for source in got["html"]:
            page = Page((source or b"").decode())
            states = page.labels()
            if states is None:
                continue
            for i in range(1, len(states)):
                for w in page.features(i):
                    counts[w, states[i]] += 1
                if not MARKED.intersection(page.names[i]):
                    counts[f"->{int(states[page.parents[i]])}", states[i]] += 1
        words = list(counts)
        return [pa.array([w for w, _ in words], pa.string()), pa.array([s for _, s in words], pa.bool_()), pa.array([counts[w] for w in words], pa.int64())]

    # names seen once or twice say nothing and are not collected
    found = (
        scan(sample, work, "word string, content boolean, n long", ["html"])
        .groupBy("word").agg(F.sum(F.when(F.col("content"), F.col("n")).otherwise(0)).alias("yes"), F.sum("n").alias("n"))
        .filter("n > 2").collect()
    )
    counts = {r["word"]: (r["n"] - r["yes"], r["yes"]) for r in found if not r["word"].startswith("->")}
    moves = {(r["word"] == "->1", c): (r["yes"] if c else r["n"] - r["yes"]) for r in found if r["word"].startswith("->") for c in (False, True)}
    return Model(counts, moves)


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", most: int = MOST_LABELLED) -> DataFrame:
    """The main text of each page from its whole source.

    Returns ``page_id, url, text, n_chars``, one row per input row. NULL or empty source gives an empty text;
    broken markup is read as far as it goes; repeated rows and NULL keys are fine; an empty
    table gives none; other columns are not read.
    """
    rows = pick(pages, **{key: "page_id", url: "url", source: "html"})
    model = pages.sparkSession.sparkContext.broadcast(train(rows.select("page_id", "html"), most))

    def work(got, n):
        texts = []
        for x in got["html"]:
            page = Page((x or b"").decode())
            texts.append(page.text([p > 0.5 for p in model.value.marginals(page)]))
        urls = [u.decode() if isinstance(u, bytes) else u for u in got["url"]]
        return [pa.array(got["page_id"], kind), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = rows.schema["page_id"].dataType
    kind = to_arrow_type(key_type)
    schema = f"page_id {key_type.simpleString()}, url string, text string, n_chars long"
    return scan(rows.withColumn("url", F.col("url").cast("string")), work, schema, ["page_id", "url", "html"])
