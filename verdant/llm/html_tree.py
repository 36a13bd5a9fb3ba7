"""Main-text extraction with a tree-structured graphical model.

A page becomes the tree of its block elements.  Every node is content or not:
its own potential comes from its tag, the words of its class and id, its text
and its share of link text; a parent and its child share a potential of their
two labels.  Sum-product messages go up the tree and down again and give each
node's marginal of being content; the text runs of the nodes above one half are
the main text.

The potentials are trained on labelled pages (``labelled_pages``: layouts with
every block marked), by gradient ascent on the exact likelihood.  Pages of a
batch form one forest, so a message step is a numpy operation per depth.

Defined results: null and empty pages have no text; a comment, a raw element or a tag
that never closes ends with the page, any other element that is dropped with its parent;
implied head and body tags are understood; unknown tags are inline; character references are decoded
in text, white space (no-break space included) becomes one space; a page
without content nodes gives the empty text; repeated rows are read each.
"""

from __future__ import annotations

import html as entities
import random
import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from verdant.llm.common import small_batches

# Elements by kind (fixed names of HTML).
BLOCKS = frozenset("""html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption
    blockquote pre article section main header footer nav aside figure figcaption form fieldset legend details summary
    address hgroup menu dialog center label""".split())
DROPPED = frozenset("script style noscript template iframe svg math canvas object title textarea select button "
                    "option datalist audio video map".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag ends these open elements, unless one of the others stands in between.
ITEMS = BLOCKS - {"li", "dt", "dd", "address", "div", "p"}
ENDS = {"li": (("li",), ITEMS), "dt": (("dt", "dd"), ITEMS), "dd": (("dt", "dd"), ITEMS),
        **{t: (("td", "th"), ("table",)) for t in ("td", "th")}, "tr": (("tr", "td", "th"), ("table",)),
        **{t: (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)) for t in ("tbody", "tfoot")}}

# Words of class, id and role that tell a block's part (fixed lists).
CUES = {
    "main": "article content post entry main story body text page prose copy markdown richtext".split(),
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs skip".split(),
    "edge": "header footer masthead topbar bottom banner logo copyright legal colophon site".split(),
    "side": "sidebar aside rail widget related recommended recommend more popular trending tags share social follow".split(),
    "note": "notice cookie consent gdpr alert popup modal overlay newsletter subscribe signup login toast message warning "
            "disclaimer announcement".split(),
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promoted promotion dfp teaser outbrain".split(),
    "talk": "comment comments reply replies discussion respond disqus reader thread feedback review reviews".split(),
    "form": "form search field input poll survey contact".split(),
}
CUE_OF = {w: k for k, ws in CUES.items() for w in ws}
TAGS = ("p", "div", "heading", "list", "li", "table", "cell", "quote", "pre", "article", "section", "main", "header",
        "footer", "nav", "aside", "figure", "form", "body", "other")
TAG_OF = {"p": "p", "div": "div", "center": "div", **{f"h{i}": "heading" for i in range(1, 7)}, "hgroup": "heading",
          "ul": "list", "ol": "list", "dl": "list", "menu": "nav", "li": "li", "dt": "li", "dd": "li", "table": "table",
          "thead": "table", "tbody": "table", "tfoot": "table", "tr": "table", "td": "cell", "th": "cell",
          "caption": "cell", "blockquote": "quote", "pre": "pre", "article": "article", "section": "section",
          "main": "main", "header": "header", "footer": "footer", "nav": "nav", "aside": "aside", "figure": "figure",
          "figcaption": "figure", "form": "form", "fieldset": "form", "legend": "form", "label": "form",
          "dialog": "form", "html": "body", "body": "body"}
KINDS = (*TAGS, *[f"cue_{k}" for k in CUES], "text_none", "text_short", "text_mid", "text_long", "links_some", "links_most", "sentence",
         "copyright", "hidden", "tag_in_article", "tag_in_edge", "prose_in_root", "in_noise")
COLUMN = {k: i for i, k in enumerate(KINDS)}
NOISE_CUES = [COLUMN[f"cue_{k}"] for k in CUES if k != "main"]

NAME = re.compile(r"/?([a-zA-Z][^\s/>]*+)")
MARKS = re.compile(r"[>\"']")
ATTR = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
CUE_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    attrs: str
    chars: int = 0
    links: int = 0
    last: str = ""
    low: bool = False


class Tags:
    """The tags of a page, one after the other, in time linear in its length."""

    def __init__(self, page: str):
        self.page = page
        self.absent: set[str] = set()       # what does not come any more
        self.last_close: dict[str, int] = {}

    def find(self, what: str, at: int) -> int:
        """Position of ``what`` from ``at`` on, -1 if none (which is looked for once)."""
        if what in self.absent:
            return -1
        k = self.page.find(what, at)
        if k < 0:
            self.absent.add(what)
        return k

    def end(self, at: int) -> int:
        """Where the tag whose name ends at ``at`` closes: after the next > outside quotes; -1 if never."""
        if self.find(">", at) < 0:
            return -1
        while m := MARKS.search(self.page, at):
            at = m.end()
            if m[0] == ">":
                return at
            if self.page[max(0, m.start() - 8):m.start()].rstrip()[-1:] == "=":
                k = self.find(m[0], at)
                if k >= 0:
                    at = k + 1
        return -1

    def closes(self, name: str, at: int) -> bool:
        """Whether an end tag of ``name`` comes after ``at``."""
        if name not in self.last_close:
            self.last_close[name] = max((m.start() for m in re.finditer(f"</{name}", self.page, re.I)), default=-1)
        return at <= self.last_close[name]

    def after(self, name: str, at: int) -> int:
        """The place after the next end tag of ``name`` (the page's end, if none)."""
        if not self.closes(name, at):
            return len(self.page)
        m = re.compile(f"</{name}[^>]*+>?", re.I).search(self.page, at)
        return m.end() if m else len(self.page)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block elements in page order, and the (node, text) runs."""
    nodes, runs = [Node("body", -1, 0, "")], []
    stack, at, link, buffer = [0], 0, False, []
    open_at: dict[str, list[int]] = {}   # places in the stack of the open elements of a name
    linked = 0
    dropped: list[str] = []
    inner: dict[str, int] = {}           # blocks that were opened inside a dropped element
    loose = False                        # in a dropped element that nothing closes: up to the next block
    tags = Tags(page)

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                node = nodes[stack[-1]]
                node.chars += len(text)
                node.links += min(linked, len(text))
                node.last = text[-1]
                node.low = node.low or "©" in text or "copyright" in text.lower()
                runs.append((stack[-1], text))
        linked = 0

    def cut(k: int) -> None:
        """Close the elements from place k of the stack on."""
        while len(stack) > k:
            open_at[nodes[stack.pop()].tag].pop()

    n = len(page)
    while at < n:
        lt = tags.find("<", at)
        m = NAME.match(page, lt + 1) if lt >= 0 else None
        end = lt if lt >= 0 else n
        if lt >= 0 and not m and page[lt + 1:lt + 2] not in ("!", "?"):
            end = lt + 1                     # a bare < is text
        if end > at and not dropped and not loose:
            buffer.append(page[at:end])
            if link:
                linked += end - at
        if lt < 0:
            break
        if not m:
            if end > lt:
                at = end
            elif page.startswith("<!--", lt):
                k = tags.find("-->", lt + 4)
                at = k + 3 if k >= 0 else n
            else:
                k = tags.find(">", lt)
                at = k + 1 if k >= 0 else n
            continue
        at = tags.end(m.end())
        if at < 0:
            break                            # a tag that never closes ends the page
        name, closing, attrs = m[1].lower(), page[lt + 1] == "/", page[m.end():at - 1]
        if name in DROPPED:
            if not closing and name in RAW:
                at = tags.after(name, at)
            elif not closing and not attrs.endswith("/"):
                if tags.closes(name, at):
                    dropped.append(name)
                else:
                    loose = True
            elif closing and name in dropped:
                while dropped.pop() != name:
                    pass
            if not dropped:
                inner.clear()
            continue
        if dropped:
            if name not in BLOCKS:
                continue
            if not closing:
                inner[name] = inner.get(name, 0) + (name != "body")
            elif inner.get(name):
                inner[name] -= 1
            elif open_at.get(name):          # its parent ends
                dropped.clear()
                inner.clear()
            if dropped and (name != "body" or closing):
                continue
            dropped.clear()
            inner.clear()
        if name == "a":
            link = not closing
        if name in VOID:
            if name in ("br", "hr"):
                buffer.append(" ")
            continue
        if name not in BLOCKS:
            continue
        flush()
        link = loose = False
        if closing:
            if open_at.get(name):
                cut(open_at[name][-1])
            continue
        if name in ("html", "body"):
            nodes[0].attrs += attrs  # one root, whatever the page opens
            continue
        if nodes[stack[-1]].tag == "p":
            cut(len(stack) - 1)
        if name in ENDS:
            ends, walls = ENDS[name]
            wall = max((open_at[t][-1] for t in walls if open_at.get(t)), default=-1)
            first = [open_at[t][bisect(open_at[t], wall)] for t in ends if open_at.get(t) and open_at[t][-1] > wall]
            if first:
                cut(min(first))
        nodes.append(Node(name, stack[-1], len(stack), attrs))
        if not attrs.endswith("/") or name not in ("p", "div"):
            open_at.setdefault(name, []).append(len(stack))
            stack.append(len(nodes) - 1)
    flush()
    return nodes, runs


def features(nodes: list[Node]) -> np.ndarray:
    out = np.zeros((len(nodes), len(KINDS)), np.float64)
    inside = [0] * len(nodes)  # 1 in an article or main element, 2 in an edge element
    noise = [False] * len(nodes)  # a block around it, or itself, has a cue of another part
    for i, v in enumerate(nodes):
        tag = TAG_OF.get(v.tag, "other")
        out[i, COLUMN[tag]] = 1
        if v.parent >= 0:
            inside[i] = inside[v.parent]
        if tag in ("article", "main"):
            inside[i] = max(inside[i], 1)
        elif tag in ("nav", "aside", "footer", "form") or tag == "header" and inside[i] == 0:
            inside[i] = 2
        out[i, COLUMN["tag_in_article"]] = inside[i] == 1
        out[i, COLUMN["tag_in_edge"]] = inside[i] == 2
        out[i, COLUMN["in_noise"]] = noise[i] = v.parent > 0 and noise[v.parent]
        out[i, COLUMN["prose_in_root"]] = v.parent == 0 and tag in ("p", "heading", "quote", "pre", "list")
        if v.attrs:
            for key, a, b, c in ATTR.findall(v.attrs):
                value = (a or b or c).lower()
                key = key.lower()
                if key in ("class", "id", "role"):
                    for w in CUE_WORD.findall(value):
                        if w in CUE_OF:
                            out[i, COLUMN[f"cue_{CUE_OF[w]}"]] = 1
                elif key == "hidden" or key == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", ""):
                    out[i, COLUMN["hidden"]] = 1
        if any(out[i, c] for c in NOISE_CUES) and not out[i, COLUMN["cue_main"]] and tag not in ("article", "main", "body"):
            noise[i] = True
        kind = "none" if v.chars == 0 else "short" if v.chars < 25 else "mid" if v.chars < 100 else "long"
        out[i, COLUMN[f"text_{kind}"]] = 1
        if v.chars:
            share = v.links / v.chars
            out[i, COLUMN["links_some"]] = 0.2 <= share < 0.6
            out[i, COLUMN["links_most"]] = share >= 0.6
            out[i, COLUMN["sentence"]] = v.last in ".?!…"
            out[i, COLUMN["copyright"]] = v.low
    return out


@dataclass
class Model:
    weights: np.ndarray  # of the log-odds of content
    edge: np.ndarray     # 2 x 2 log potentials (parent, child)

    def marginals(self, x: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return sum_product(x @ self.weights, self.edge, parent, depth)[0]


def sum_product(unary: np.ndarray, edge: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of label 1 and the expected (parent, child) label counts of a forest."""
    local = np.stack([np.zeros_like(unary), np.clip(unary, -30, 30)], axis=1)  # logs throughout
    up, msg = local.copy(), np.zeros_like(local)
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(depth.max(initial=0) + 2))
    levels = [order[a:b] for a, b in zip(cuts, cuts[1:])]
    for level in reversed(levels[1:]):
        m = np.logaddexp(edge[:, 0] + up[level, :1], edge[:, 1] + up[level, 1:])
        msg[level] = m - m.max(axis=1, keepdims=True)
        np.add.at(up, parent[level], msg[level])
    belief, expected = up.copy(), np.zeros((2, 2))
    for level in levels[1:]:
        above = belief[parent[level]] - msg[level]  # the parent without this child
        pair = above[:, :, None] + edge[None] + up[level][:, None, :]
        pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        expected += pair.sum(axis=0)
        belief[level] = np.log(pair.sum(axis=1) + 1e-300)
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -50, 50))), expected


def _forest(pages: list[list[Node]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parent, depth, at = [], [], 0
    for nodes in pages:
        parent += [v.parent + at if v.parent >= 0 else -1 for v in nodes]
        depth += [v.depth for v in nodes]
        at += len(nodes)
    # the open-element depth may exceed the tree depth; levels need the tree's
    for i, p in enumerate(parent):
        depth[i] = depth[p] + 1 if p >= 0 else 0
    return np.vstack([features(n) for n in pages]), np.array(parent), np.array(depth)


MARK = re.compile(r"\bdata-main\b")


def train(pages: list[str], steps: int = 200) -> Model:
    """Fit on pages whose content elements carry the attribute data-main."""
    trees = [parse(p)[0] for p in pages]
    x, parent, depth = _forest(trees)
    y = np.array([bool(MARK.search(v.attrs)) for nodes in trees for v in nodes], float)
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[parent[child]].astype(int), y[child].astype(int)), 1)
    theta = np.zeros(x.shape[1] + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, steps + 1):
        p, expected = sum_product(x @ theta[:-4], theta[-4:].reshape(2, 2), parent, depth)
        grad = np.r_[x.T @ (y - p), (seen - expected).ravel()] / len(y) - 3e-4 * theta
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        theta += 0.1 * (mean / (1 - 0.9 ** i)) / (np.sqrt(square / (1 - 0.999 ** i)) + 1e-8)
    return Model(theta[:-4], theta[-4:].reshape(2, 2))


def labelled_pages(count: int = 240, seed: int = 7) -> list[str]:
    """Training pages: layouts in which every content block carries data-main.

    Wrappers, class words, lengths and the parts around the article vary."""
    rng = random.Random(seed)
    letters = "aeiounrstlmdchgp"

    def words(n: int) -> str:
        return " ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(n))

    def sentence(n: int) -> str:
        return words(n).capitalize() + rng.choice("...?!")

    def some(names: list[str]) -> str:
        return rng.choice(["", "", f' class="{rng.choice(names)}"', f' id="{rng.choice(names)}"',
                           f' class="{rng.choice(names)} {words(1)}"'])

    def links(n: int, wrap: str = "li") -> str:
        return "".join(f'<{wrap}><a href="/{words(1)}">{words(rng.randint(1, 3))}</a></{wrap}>' for _ in range(n))

    def block() -> str:
        kind = rng.random()
        size = rng.choice([1, 2, 5, 12, 30, 80])
        if kind < .68:
            link = f' <a href="/{words(1)}">{words(2)}</a> ' if rng.random() < .2 else ""
            return f"<p data-main{some(['text', 'lead', 'intro'])}>{sentence(size)}{link}</p>"
        if kind < .78:
            level = rng.randint(2, 4)
            return f"<h{level} data-main>{words(rng.randint(1, 8))}</h{level}>"
        if kind < .86:
            return "<ul data-main>" + "".join(f"<li data-main>{sentence(rng.randint(1, 14))}</li>" for _ in range(3)) + "</ul>"
        if kind < .90:
            return f"<blockquote data-main><p data-main>{sentence(size)}</p></blockquote>"
        if kind < .94:
            return (f"<table data-main><tr data-main><td data-main>{words(1)}</td><td data-main>{words(2)}</td></tr></table>")
        if kind < .97:
            return f"<pre data-main>{words(size)}</pre>"
        return f"<div data-main>{sentence(size)}</div>"

    def aside_part() -> str:
        tag = rng.choice(["div", "section", "aside", "div"])
        pick = rng.randint(0, 6)
        if pick == 0:
            names, inner = CUES["side"], f"<h3>{words(2)}</h3><ul>{links(rng.randint(2, 6))}</ul>"
        elif pick == 1:
            names, inner = CUES["note"], f"<p>{sentence(rng.randint(3, 30))}</p>"
        elif pick == 2:
            names, inner = CUES["ad"], rng.choice([sentence(rng.randint(2, 25)), f"<p>{sentence(rng.randint(2, 25))}</p>"])
        elif pick == 3:
            names = CUES["talk"]
            inner = f"<h3>{words(1)}</h3>" + "".join(
                f"<div{some(CUES['talk'])}><p>{sentence(rng.randint(2, 40))}</p></div>" for _ in range(rng.randint(1, 4)))
        elif pick == 4:
            return (f"<form{some(CUES['form'])}><label>{words(2)}</label><p>{sentence(rng.randint(2, 9))}</p>"
                    f"<input name=q></form>")
        elif pick == 5:
            names, inner = CUES["nav"], f"<ul>{links(rng.randint(2, 7))}</ul>"
        else:
            return f"<aside>{rng.choice([sentence(20), f'<p>{sentence(rng.randint(2, 30))}</p>'])}</aside>"
        return f'<{tag} class="{rng.choice(names)}">{inner}</{tag}>'

    pages = []
    for _ in range(count):
        title = f"<h1 data-main>{words(rng.randint(1, 9))}</h1>"
        parts = [block() for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12]))]
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):  # other parts stand between the blocks of an article, too
            parts.insert(rng.randint(0, len(parts)), aside_part())
        body = "".join(parts)
        wrap = rng.choice(["article", "article", "article", "main", "div", "section", "main+article", "div+div", ""])
        inner = title + body
        for name in reversed(wrap.split("+") if wrap else []):
            cue = some(CUES["main"]) if name in ("article", "main") else f' class="{rng.choice(CUES["main"])}"'
            if name in ("article", "main") and rng.random() < .15:
                inner += aside_part()
            inner = f"<{name} data-main{cue}>{inner}</{name}>"
        before = [f"<nav><ul>{links(rng.randint(2, 8))}</ul></nav>" if rng.random() < .7 else "",
                  f"<header{some(CUES['edge'])}>{rng.choice([words(2), f'<p>{sentence(5)}</p>', f'<h2>{words(2)}</h2>'])}</header>"
                  if rng.random() < .6 else "", *[aside_part() for _ in range(rng.randint(0, 2))]]
        after = [*[aside_part() for _ in range(rng.randint(0, 3))],
                 rng.choice([f"<footer>&copy; {words(2)} &middot; {sentence(rng.randint(2, 14))}</footer>",
                             f"<footer><p>{sentence(rng.randint(2, 14))}</p></footer>",
                             f'<div class="footer">{sentence(rng.randint(2, 14))}</div>', ""])]
        rng.shuffle(before)
        rest = "".join(before) + inner + "".join(after)
        if rng.random() < .3:
            rest = f"<div{some(['wrapper', 'container', 'page'])}>{rest}</div>"
        if rng.random() < .06:  # bare text
            pages.append(f"<body data-main>{sentence(rng.randint(3, 60))}</body>")
        else:
            pages.append(f"<html><body>{rest}</body></html>")
    return pages


def extract(pages: list[str], model: Model) -> list[str]:
    """The main text of each page."""
    parsed = [parse(p) for p in pages]
    if not parsed:
        return []
    x, parent, depth = _forest([nodes for nodes, _ in parsed])
    main = model.marginals(x, parent, depth) > 0.5
    out, at = [], 0
    for nodes, runs in parsed:
        out.append("\n\n".join(text for i, text in runs if main[at + i]))
        at += len(nodes)
    return out


def main_text(df: DataFrame, model: Model, keys: list[str], html_col: str = "html", out: str = "text") -> DataFrame:
    """``keys`` and the main text of every row."""
    small_batches(df.sparkSession)
    rows = df.select(*keys, df[html_col].alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            htmls = b["__html"].to_pylist()
            for a in range(0, len(htmls), 128):
                texts += extract([h or "" for h in htmls[a:a + 128]], model)
            yield pa.RecordBatch.from_arrays([*[b[k] for k in keys], pa.array(texts, pa.string())], [*keys, out])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema]
    return rows.mapInArrow(run, ", ".join([*kinds, f"`{out}` string"]))
