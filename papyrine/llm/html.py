"""Main text of web pages by a tree-structured graphical model over the page's elements.

Each block element of a page is a node with a hidden label, content or not. A node's features depend on its label, its label
on that of its parent. Messages go up the tree and down again (sum-product), which gives every node's exact marginal in two
passes. All tables are counts from labelled pages: a bounded sample of the corpus' own pages that mark their article, and a
few layouts kept here, so that notices, side bars, forms and comments are known where the sample shows none.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm import common

#: Pages of the corpus that the model is fitted on (those with the smallest hash of id and address).
TRAIN_PAGES = 400
#: What one kept layout counts for, in pages.
LAYOUT_WEIGHT = 20
#: A count that every feature value has before any page is read.
SMOOTHING = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S,
)
#: Elements whose text is never read, and those that only exist as a tag.
_RAW = frozenset("script style noscript template title textarea iframe svg annotation annotation-xml canvas select head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr blockquote pre "
    "figure figcaption details summary address hgroup header footer nav aside form fieldset menu dialog center".split()
)
_SPACES = frozenset("br hr td th".split())
#: Opening one of these ends an open element of the same kind, up to the nearest element that holds them.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
}
#: What stands loose in one of these, beside other blocks, is a node of its own (``#text``).
_HOLDERS = frozenset("#page html body".split())
_FORMS = frozenset("form fieldset dialog".split())
_FIELDS = frozenset("input select textarea button".split())
#: Characters for each of its fields from which a form holds a page or a part of it, and does not merely ask for something.
FIELD_CHARS = 150
_WORD = re.compile(r"[a-z]+")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\btype\s*=\s*[\"']?hidden", re.I)
_CONTENT_WORDS = frozenset("article articlebody main content post entry story body text prose maintext".split())
_OTHER_TAGS = frozenset("nav aside footer".split())
_OTHER_WORDS = frozenset(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer foot copyright sidebar side aside widget related recommended share sharing social comment comments "
    "respond reply disqus cookie cookies consent notice notices alert popup modal newsletter subscribe signup login form search "
    "pagination pager tags meta toolbar skip legal privacy".split()
)
_CALLED = {"h1": "h", "h2": "h", "h3": "h", "h4": "h", "h5": "h", "h6": "h", "ol": "ul", "menu": "ul", "dd": "dt", "tbody": "table"}


class Page:
    """Block elements of a page as nodes in page order, and its blocks of text."""

    def __init__(self, source: str):
        self.tags, self.parents, self.words, self.marks = ["#page"], [-1], [frozenset()], [None]
        self.own, self.linked = [0], [0]  # characters of a node's own text, and those inside links
        self.fields = [0]  # fields of forms
        self.blocks: list[tuple[int, str]] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#page", 0)]  # open elements with their block node
        run: list[str] = []
        links = in_links = 0  # open links, and the characters of the run inside links
        marks = ""  # attributes of marked inline elements of the run

        def flush() -> None:
            nonlocal in_links, marks
            if run:
                text = " ".join(references.unescape("".join(run)).split())
                run.clear()
                if text:
                    node = next(at for tag, at in reversed(stack) if tag in _BLOCKS or tag == "#page")
                    if self.tags[node] in _HOLDERS:
                        node = self._node("#text", node, marks)
                    self.blocks.append((node, text))
                    self.own[node] += len(text)
                    self.linked[node] += in_links
            in_links, marks = 0, ""

        def close(depth: int) -> None:
            nonlocal links
            if any(tag in _BLOCKS for tag, _ in stack[depth:]):
                flush()
            links -= sum(tag == "a" for tag, _ in stack[depth:])
            del stack[depth:]

        at, find = 0, _TOKEN.search
        while (token := find(source, at)) is not None:
            if token.start() > at:
                text = source[at : token.start()]
                run.append(text)
                if links:
                    in_links += len(text.strip())
            at = token.end()
            if (name := token.group(2)) is None:
                continue
            name = name.lower()
            if token.group(1):
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                if depth:
                    close(depth)
                continue
            if name in _SPACES:
                run.append(" ")
            attributes = token.group(3)
            if name in _FIELDS and not _HIDDEN.search(attributes):
                self.fields[stack[-1][1]] += 1
            if name in _VOID or attributes.endswith("/") and name not in _BLOCKS:
                continue
            if name in _RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source) if name in ("script", "style") else at
                continue
            if name in _BLOCKS:
                # A block ends an open paragraph, an item the item before it.
                ends, until = _ENDS.get(name, (set(), set()))
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in until:
                        break
                    if stack[i][0] == "p" or stack[i][0] in ends:
                        close(i)
                        break
                flush()
                stack.append((name, self._node(name, stack[-1][1], attributes)))
            else:
                links += name == "a"
                if "data-main" in attributes:
                    marks += attributes
                stack.append((name, stack[-1][1]))
        run.append(source[at:])
        flush()

    def _node(self, name: str, parent: int, attributes: str) -> int:
        words, mark = set(), None
        if attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                value = "".join(values)
                if key.lower() == "data-main":
                    mark = value == "1"
                else:
                    words.update(_WORD.findall(value.lower()))
        for held, value in ((self.tags, name), (self.parents, parent), (self.words, words), (self.marks, mark)):
            held.append(value)
        self.own.append(0)
        self.linked.append(0)
        self.fields.append(0)
        return len(self.tags) - 1

    def features(self) -> list[tuple[str, ...]]:
        """Of each node what its names say, and how much text and how many links lie in it."""
        total, linked, fields = self.own[:], self.linked[:], self.fields[:]
        for node in range(len(total) - 1, 0, -1):
            total[self.parents[node]] += total[node]
            linked[self.parents[node]] += linked[node]
            fields[self.parents[node]] += fields[node]
        out: list[tuple[str, ...]] = []
        forms, named, above = [], [], []
        for node in range(len(self.tags)):
            words = self.words[node]
            called = ("c" if words & _CONTENT_WORDS else "") + ("o" if words & _OTHER_WORDS or self.tags[node] in _OTHER_TAGS else "")
            # What the nearest element above that says what it is says.
            above.append((named[self.parents[node]] or above[self.parents[node]]) if node else "")
            named.append(called)
            # Of the nearest form around a node: whether it asks for something, or has a page or a part of one inside.
            form = forms[self.parents[node]] if node else "none"
            if self.tags[node] in _FORMS:
                holds = total[node] >= FIELD_CHARS * fields[node] and total[node] >= 60 and self.tags[node] != "dialog"
                form = "asks" if form == "asks" or not holds else "holds"
            forms.append(form)
            density = linked[node] / total[node] if total[node] else 0.0
            out.append(
                (
                    "named:" + called,
                    "above:" + above[-1],
                    f"own:{min(2, self.own[node] // 40)}",
                    f"links:{0 if density == 0 else 1 if density < 0.3 else 2 if density < 0.7 else 3}",
                    "form:" + form,
                )
            )
        return out

    def kind(self, node: int) -> str:
        """The element; one that stands directly in the page's body has nothing to take its label from, and is a kind of its own."""
        tag = _CALLED.get(self.tags[node], self.tags[node])
        return tag + "^" if node and self.tags[self.parents[node]] in _HOLDERS else tag

    def labels(self) -> list[int] | None:
        """Labels of a page that marks its article (or carries marks of its own), else none."""
        marked = any(m is not None for m in self.marks)
        if not marked and sum(t in ("article", "main") for t in self.tags) != 1:
            return None
        out = [0] * len(self.tags)
        for node in range(1, len(out)):
            if marked:
                out[node] = out[self.parents[node]] if self.marks[node] is None else int(self.marks[node])
            elif self.tags[node] in ("article", "main"):
                out[node] = 1
            elif self.tags[node] not in ("nav", "aside", "footer", *_FORMS):
                out[node] = int(out[self.parents[node]] and not self.words[node] & _OTHER_WORDS)
        return out

    def counts(self) -> Counter:
        """What a labelled page adds to the tables."""
        found: Counter = Counter()
        labels = self.labels()
        if labels is None:
            return found
        for node, features in enumerate(self.features()):
            if node:
                found[f"{self.kind(node)}>{labels[self.parents[node]]}>{labels[node]}"] += 1
            for feature in features:
                found[f"{labels[node]}|{feature}"] += 1
        return found


class Model:
    """Tables of the tree model as logarithms; ``marginals`` runs the messages.

    How a label follows from the parent's depends on the element: paragraphs and items are as their parent, sections may
    not be. An element never met has the table of all elements together.
    """

    def __init__(self, counts: Counter):
        steps: Counter = Counter()
        for key, n in counts.items():
            if ">" in key:
                kind, above, y = key.split(">")
                steps[kind, int(above), int(y)] += n
                steps["*", int(above), int(y)] += n
        self.edges = {}
        for kind in {"*"} | {k for k, _, _ in steps}:
            rows = [[steps[kind, above, y] + SMOOTHING for y in (0, 1)] for above in (0, 1)]
            self.edges[kind] = [[math.log(n / sum(row)) for n in row] for row in rows]
        self.seen: dict[str, tuple[float, float]] = {}
        kinds: dict[str, set] = {}
        for key in counts:
            if "|" in key:
                kinds.setdefault(key[2:].split(":")[0], set()).add(key[2:])
        for values in kinds.values():
            totals = [sum(counts[f"{y}|{v}"] + SMOOTHING for v in values) + SMOOTHING for y in (0, 1)]
            for v in values:
                self.seen[v] = tuple(math.log((counts[f"{y}|{v}"] + SMOOTHING) / totals[y]) for y in (0, 1))

    def marginals(self, page: Page) -> list[float]:
        """Probability of content of every node."""
        n, parents = len(page.tags), page.parents
        any_kind = self.edges["*"]
        steps = [self.edges.get(page.kind(node), any_kind) for node in range(n)]
        up = [[0.0, 0.0] for _ in range(n)]
        for node, features in enumerate(page.features()):
            for feature in features:
                a, b = self.seen.get(feature, (0.0, 0.0))
                up[node][0] += a
                up[node][1] += b
        # Children stand after their parents: backwards is upwards.
        sent = [(0.0, 0.0)] * n
        for node in range(n - 1, 0, -1):
            own, edges = up[node], steps[node]
            sent[node] = tuple(_log_sum(edges[y][0] + own[0], edges[y][1] + own[1]) for y in (0, 1))
            above = up[parents[node]]
            above[0] += sent[node][0]
            above[1] += sent[node][1]
        # The page itself is not content: what lies outside all elements has nodes of its own.
        belief = [[0.0, 0.0] for _ in range(n)]
        belief[0] = [up[0][0], -math.inf]
        out = [0.0] * n
        for node in range(1, n):
            above, edges = belief[parents[node]], steps[node]
            rest = [above[y] - sent[node][y] for y in (0, 1)]
            down = [_log_sum(rest[0] + edges[0][y], rest[1] + edges[1][y]) for y in (0, 1)]
            belief[node] = [up[node][y] + down[y] for y in (0, 1)]
            out[node] = math.exp(belief[node][1] - _log_sum(*belief[node]))
        return out

    def text(self, source: str) -> str:
        """The main text: blocks whose element is content, in page order, one per line."""
        page = Page(source)
        if not page.blocks:
            return ""
        content = self.marginals(page)
        return "\n".join(text for node, text in page.blocks if content[node] > 0.5)


def _log_sum(a: float, b: float) -> float:
    low, high = (a, b) if a < b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES, id_col: str = "page_id", html_col: str = "html") -> Model:
    """The model of a corpus: counts over its sample and the kept layouts. The driver sees one row per feature value."""
    place = F.xxhash64(*[F.col(f"`{c}`") for c in pages.columns if c in (id_col, "url")])
    own = pages.select(place.alias("place"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    last = own.select("place").orderBy("place").limit(train_pages).agg(F.max("place")).first()[0]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        for source in batch["html"].to_pylist():
            found.update(Page(source).counts())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["key", "n"]
        )

    counts: Counter = Counter()
    if last is not None:
        sample = common.map_batches(own.filter(F.col("place") <= last).select("html"), step, "key string, n long")
        counts.update({r["key"]: r["n"] for r in sample.groupBy("key").agg(F.sum("n").alias("n")).collect()})
    for layout in LAYOUTS:
        for key, n in Page(layout).counts().items():
            counts[key] += LAYOUT_WEIGHT * n
    return Model(counts)


def extract(
    pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text, n_chars for every row; null or empty html gives an empty text. Repeated rows stay rows."""
    model = model or fit(pages, id_col=id_col, html_col=html_col)
    own = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
    )

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [model.text(source) for source in batch["html"].to_pylist()]
        lengths = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"]
        )

    return common.map_batches(own, step, "page_id long, url string, text string, n_chars long")


_P = "<p>Several sentences that tell the story, one after the other, at some length.</p>"
_MARKED = _P.replace("<p>", "<p data-main='1'>")
_LINKS = "<ul><li><a href='/a'>First entry</a></li><li><a href='/b'>Second entry</a></li></ul>"
#: Labelled layouts: ``data-main`` says whether an element is content; the others are as their parent.
LAYOUTS = (
    f"<body data-main='0'><header><h1>Site</h1>{_LINKS}</header><div id='cookie-notice'><p>We use cookies.</p></div>"
    f"<div id='content' data-main='1'><h1>Title</h1>{_P}{_P}<blockquote>{_P}</blockquote>{_P}</div>"
    f"<div class='sidebar'><h3>Related</h3>{_LINKS}</div><footer><p>Copyright, all rights reserved.</p></footer></body>",
    f"<body data-main='0'><nav>{_LINKS}</nav><main data-main='1'><article><h1>Title</h1>{_P}<h2>Part</h2>{_P}<ul><li>One "
    f"point</li><li>Another point</li></ul>{_P}</article></main><aside><h3>More</h3>{_LINKS}</aside><section class='comments' "
    f"data-main='0'><h3>Comments</h3><div class='comment'><p>I liked this article very much, and I say so here.</p></div></section>"
    f"<footer>{_LINKS}</footer></body>",
    f"<body data-main='0'><div class='header'><p>Site</p><div class='menu'>{_LINKS}</div></div><div class='ad'><p>Buy this thing "
    f"now.</p></div><div class='post' data-main='1'><div class='entry-content'>{_P}{_P}<div class='advert' data-main='0'><p>Buy more "
    f"things.</p></div>{_P}</div></div><form class='newsletter'><p>Subscribe to our letter.</p></form><div id='comments'><ol><li><p>A "
    f"reader writes something of some length here, too.</p></li></ol></div><div class='footer'><p>Contact and imprint.</p></div></body>",
    f"<body data-main='0'><div class='breadcrumb'>{_LINKS}</div><article data-main='1'><header><h1>Title</h1></header>{_P}<figure><figcaption>"
    f"What the picture shows.</figcaption></figure>{_P}<aside data-main='0'><p>Read this as well, it is related.</p></aside>"
    f"<table><tr><td>Cell</td><td>Cell</td></tr></table>{_P}<div class='share' data-main='0'>{_LINKS}</div><footer data-main='0'><p>Filed "
    f"under news.</p></footer></article><div class='banner'><p>An advertisement.</p></div></body>",
    # Everything inside one form, a small form among it.
    f"<body data-main='0'><form id='aspnetform'><div id='header'>{_LINKS}<input name='q'></div><div id='content' data-main='1'><h1>Title</h1>"
    f"{_P}{_P}{_P}{_P}{_P}<fieldset data-main='0'><p>Your name</p><input name='n'><input name='m'></fieldset>{_P}{_P}{_P}{_P}{_P}</div><div id='footer'><p>"
    f"Contact and imprint.</p></div></form><form data-main='0'><p>Send us a letter</p><input name='a'><button>Go</button></form></body>",
    # Text without elements of its own, between menus.
    f"<body data-main='0'><div id='menu'>{_LINKS}</div><span data-main='1'>Several sentences that stand loose in the page.</span><hr><p "
    f"data-main='1'>A paragraph between them, of some length, too.</p><span data-main='1'>More sentences that stand loose in the page.</span>"
    f"<form><p>Search</p><input name='q'></form><span data-main='0'><a href='/a'>First</a> <a href='/b'>Second</a></span><div id='foot'>"
    f"<p>All rights reserved.</p></div></body>",
    "<span data-main='1'>Nothing but sentences, in a page without a single element, one after the other.</span>",
    f"<body data-main='0'><form><p>Name</p><input name='n'></form><p data-main='1'>A page of paragraphs alone, at some length.</p>{_MARKED}"
    f"{_MARKED}</body>",
    # Plain containers within containers, of the text as of comments and side bars; asides and footers of an article.
    f"<body data-main='0'><div class='wrapper'><div><article data-main='1'><header><h1>Title</h1></header>{_P}<aside data-main='0'><p>See this "
    f"as well.</p></aside>{_P}<footer data-main='0'><p>Written by somebody.</p></footer></article></div></div><div id='comments'><h3>Two replies</h3>"
    f"<div><div>{_P}</div></div><div><div>{_P}{_P}</div></div></div><div class='sidebar'><h3>Other stories</h3><div>{_P}</div><div>{_P}</div></div></body>",
)
