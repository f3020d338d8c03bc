"""Main text of web pages: a tree-structured graphical model over the DOM's blocks."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import map_batches

SAMPLE_PAGES = 300           # labelled pages to fit on
SAMPLE_CHARS = 50_000        # longest page taken into that sample
ROUNDS, RATE, PULL = 30, 0.5, 0.02

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
TAG_NAME = re.compile(r"</?[A-Za-z][^\s/>]*+")
QUOTED = re.compile(r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)")
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[a-z]+")
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math object audio video canvas noembed".split())
#: an opening tag closes the nearest open one of these, unless one of the second set comes first
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}

#: where the weights start and what they are drawn back to: evidence for content (above 0) or against it
PRIOR = {"bias": -0.5, "tag=article": 3.0, "tag=main": 2.0, "tag=p": 1.0, "tag=h1": 1.0, "tag=h2": 0.5,
         "tag=blockquote": 0.5, "tag=pre": 0.5, "tag=nav": -4.0, "tag=header": -4.0, "tag=footer": -4.0, "tag=aside": -4.0,
         "tag=form": -4.0, "tag=menu": -4.0, "tag=button": -4.0, "tag=select": -4.0, "tag=option": -4.0,
         "tag=dialog": -4.0, "tag=body": -0.5, "tag=html": -0.5, "linked": -1.5, "long": 1.0}
FOR = ("article content post story entry main text body").split()
AGAINST = ("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
           "copyright disclaimer disqus footer form header login masthead menu modal nav navbar navigation newsletter "
           "notice notices pager pagination popup promo promoted related replies respond share sharing sidebar signup "
           "social sponsor sponsored subscribe tags toolbar topbar widget").split()
PRIOR |= {f"name={w}": 1.5 for w in FOR} | {f"name={w}": -4.0 for w in AGAINST}
#: parent label, child label -> starting potential
EDGE = {(0, 0): 1.0, (0, 1): -1.0, (1, 0): 0.0, (1, 1): 2.0}


class Unclosed:
    """Places where no tag can begin because its end is missing, so that none is looked for twice.

    A tag that has begun runs from its name's end, past quoted values, to the next ">".  If
    there is none, the same holds for every tag whose name ends outside of those quoted
    values, as it runs on alike from there.  One whose name ends inside runs differently;
    as a run is outside, in double or in single quotes, and two that agree once agree for
    good, there are three different ones at most."""

    def __init__(self, page: str):
        self.page, self.runs, self.name = page, [], (0, 0)

    def name_end(self, at: int) -> int:
        """Where the name of a tag at ``at`` ends, 0 if none begins there."""
        if self.name[0] < at < self.name[1] - 1 and self.page[at + 1].isascii() and self.page[at + 1].isalpha():
            return self.name[1]                      # inside a longer name, which ends there too
        name = TAG_NAME.match(self.page, at)
        self.name = name.span() if name else (0, 0)
        return self.name[1]

    def has(self, at: int) -> bool:
        end = self.name_end(at)
        return end > 0 and any(end >= begin and (not (i := bisect_right(begins, end)) or end >= ends[i - 1])
                               for begin, begins, ends in self.runs)

    def add(self, at: int) -> None:
        end = self.name_end(at)
        if end:
            spans = [m.span() for m in QUOTED.finditer(self.page, end)]
            self.runs.append((end, [a for a, _ in spans], [b for _, b in spans]))


def parse(page: str):
    """Blocks of a page as (tags, parents, names, segments, linked): parents come before their
    children; a segment is (block, text) in page order; linked counts a block's characters in links.

    Comments, scripts, styles and other raw elements yield nothing.  Inline tags leave the
    text joined; a line break and every block bound part it."""
    tags, parents, names, linked, segments = ["#root"], [-1], [()], [0], []
    stack, inline, links = [0], [], 0
    buffer: list = []
    closed, unclosed = page.rfind(">"), Unclosed(page)
    opened: dict = {}                 # how many of each tag are open

    def flush():
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                segments.append((stack[-1], text))

    def close(depth):
        flush()
        for block in stack[depth:]:
            opened[tags[block]] -= 1
        del stack[depth:]

    at = 0
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            start = len(page)
        if start > at:
            buffer.append(page[at:start])
            if links:
                linked[stack[-1]] += start - at
        if start == len(page):
            break
        m = TOKEN.match(page, start) if start < closed and not unclosed.has(start) else \
            TOKEN.match(page, start) if page.startswith("<!--", start) else None
        if not m:
            if start < closed and not unclosed.has(start):
                unclosed.add(start)
            buffer.append("&lt;")
            at = start + 1
            continue
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                links = 0
            elif opened.get(tag):
                for d in range(len(stack) - 1, 0, -1):
                    if tags[stack[d]] == tag:
                        close(d)
                        break
        elif tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif tag == "a":
            links = 1
        elif tag == "br":
            buffer.append(" ")
        elif tag in BLOCKS:
            flush()
            if tag in CLOSES:
                own, stop = CLOSES[tag]
                for d in range(len(stack) - 1, 0, -1):
                    if tags[stack[d]] in own:
                        close(d)
                        break
                    if tags[stack[d]] in stop:
                        break
            elif tags[stack[-1]] == "p":
                close(len(stack) - 1)
            if tag == "hr":
                continue
            links = 0
            words = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(m[3])).lower()
            opened[tag] = opened.get(tag, 0) + 1
            tags.append(tag)
            parents.append(stack[-1])
            names.append(tuple(sorted(set(NAME.findall(words)))))
            linked.append(0)
            stack.append(len(tags) - 1)
    flush()
    return tags, parents, names, segments, linked


def evidence(tree, plain_article: bool = False) -> list:
    """Features of every block; with ``plain_article`` an article looks like any division."""
    tags, _, names, segments, linked = tree
    size = [0] * len(tags)
    for b, text in segments:
        size[b] += len(text)
    out = []
    for i, tag in enumerate(tags):
        own = ["bias", "tag=" + ("div" if plain_article and tag in ("article", "main") else tag)]
        own += [f"name={n}" for n in names[i]]
        if size[i]:
            own.append(f"size={min(10, int(math.log2(size[i])))}")
            if size[i] >= 200:
                own.append("long")
            if 2 * linked[i] > size[i]:
                own.append("linked")
        out.append(own)
    return out


def pass_messages(parents: list, unary: list, edge: dict):
    """Sum-product on the tree: (P(content) of each block, P(parent label, child label) of each edge).

    ``unary`` is each block's log potential for content; an upward sweep gathers from
    children, a downward sweep hands on what each child has not told its parent."""
    n = len(parents)
    up, told = [[0.0, u] for u in unary], [(0.0, 0.0)] * n
    e00, e01, e10, e11 = (edge[k] for k in ((0, 0), (0, 1), (1, 0), (1, 1)))

    def add(a, b):
        return max(a, b) + math.log1p(math.exp(-abs(a - b)))

    for i in range(n - 1, 0, -1):
        a, b = up[i]
        m = (add(e00 + a, e01 + b), add(e10 + a, e11 + b))
        shift = max(m)
        told[i] = (m[0] - shift, m[1] - shift)
        p = up[parents[i]]
        p[0] += told[i][0]
        p[1] += told[i][1]
    down, prob, pair = [(0.0, 0.0)] * n, [0.0] * n, [None] * n
    for i in range(n):
        if i:
            j = parents[i]
            c0, c1 = up[j][0] - told[i][0] + down[j][0], up[j][1] - told[i][1] + down[j][1]
            m = (add(c0 + e00, c1 + e10), add(c0 + e01, c1 + e11))
            shift = max(m)
            down[i] = (m[0] - shift, m[1] - shift)
            four = [c0 + e00 + up[i][0], c0 + e01 + up[i][1], c1 + e10 + up[i][0], c1 + e11 + up[i][1]]
            top = max(four)
            four = [math.exp(x - top) for x in four]
            total = sum(four)
            pair[i] = [x / total for x in four]
        d = (up[i][1] + down[i][1]) - (up[i][0] + down[i][0])
        prob[i] = 1 / (1 + math.exp(-d)) if d > -700 else 0.0
    return prob, pair


def label(tree) -> list | None:
    """Labels from a page's own mark-up: blocks inside its one article are content, save those
    inside a nested menu, aside, header, footer or form; None if it has no single article."""
    tags, parents = tree[0], tree[1]
    if tags.count("article") != 1:
        return None
    out = [0] * len(tags)
    for i in range(1, len(tags)):
        inside = tags[i] == "article" or out[parents[i]]
        out[i] = int(bool(inside and tags[i] not in ("nav", "aside", "header", "footer", "form", "menu")))
    return out


def fit(pages: list, rounds: int = ROUNDS) -> dict:
    """Weights of evidence and edges by gradient ascent on the labels' likelihood, drawn back to
    the starting ones.  Each labelled page counts twice, once without its article mark, so pages
    that lack one are read by what else they show."""
    weights, edge = dict(PRIOR), dict(EDGE)
    cases = []
    for page in pages:
        tree = parse(page)
        gold = label(tree)
        if gold:
            cases += [(tree[1], evidence(tree, plain), gold) for plain in (False, True)]
    blocks = sum(len(c[0]) for c in cases)
    for _ in range(rounds if cases else 0):
        g_w, g_e = {}, dict.fromkeys(edge, 0.0)
        for parents, feats, gold in cases:
            unary = [sum(weights.get(f, 0.0) for f in fs) for fs in feats]
            prob, pair = pass_messages(parents, unary, edge)
            for i, fs in enumerate(feats):
                d = gold[i] - prob[i]
                for f in fs:
                    g_w[f] = g_w.get(f, 0.0) + d
                if i:
                    for k, x in zip(((0, 0), (0, 1), (1, 0), (1, 1)), pair[i]):
                        g_e[k] += ((gold[parents[i]], gold[i]) == k) - x
        for f, g in g_w.items():
            w = weights.get(f, 0.0)
            weights[f] = w + RATE * (20 * g / blocks - PULL * (w - PRIOR.get(f, 0.0)))
        for k, g in g_e.items():
            edge[k] += RATE * (20 * g / blocks - PULL * (edge[k] - EDGE[k]))
    return {"weights": weights, "edge": edge}


def main_text(page: str | None, model: dict) -> str:
    """Text of the blocks that are more likely content than not, in page order, joined by one space."""
    if not page:
        return ""
    tree = parse(page)
    if not tree[3]:
        return ""
    w = model["weights"]
    prob, _ = pass_messages(tree[1], [sum(w.get(f, 0.0) for f in fs) for fs in evidence(tree)], model["edge"])
    return " ".join(text for block, text in tree[3] if prob[block] >= 0.5)


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict:
    """Fit on the ``sample_pages`` different pages with one article, of ``SAMPLE_CHARS``
    characters at most, that hash lowest; without any, the starting weights hold.  Their
    hashes are found first, so only the pages themselves come to the driver."""
    marked = pages.where(F.regexp_count("html", F.lit(r"(?i)<article[\s>]")) == 1) \
        .where(F.length("html") <= SAMPLE_CHARS)
    low = [r.h for r in marked.select(F.xxhash64("html").alias("h")).distinct().orderBy("h").limit(sample_pages).collect()]
    rows = marked.select(F.xxhash64("html").alias("h"), "html").where(F.col("h").isin(low)) \
        .groupBy("h").agg(F.min("html").alias("html")).collect() if low else []
    return fit([r.html for r in sorted(rows, key=lambda r: r.h)])


def extract(pages: DataFrame, model: dict | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    Null and empty pages, and pages without content, give an empty text.  Broken mark-up
    is read as far as it goes (a stray "<" is text), in time linear in the page, however long.
    Rows are independent."""
    model = train(pages) if model is None else model
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_chars bigint"

    def run(batch):
        text = [main_text(p.as_py(), model) for p in batch.column("html")]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": text,
                "n_chars": [len(t) for t in text]}

    return map_batches(pages.select("page_id", "url", "html"), schema, run)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
