"""Main text of web pages: a tree-structured graphical model over the DOM.

A page is parsed (leniently) into a tree of its block elements; inline markup belongs to
the block around it.  Every node has a hidden state, content or not.  Its own features give a
unary potential (logistic weights), and parent and child share a pair potential: how much more
often their two states meet than by chance, for children that stand apart by tag or class, for
those that look like the article itself, and for all others.
Sum-product message passing, upward and then downward, yields the exact marginal of each node;
the texts of nodes whose marginal is above one half are the main text.  Weights and
potentials are trained from labelled pages (``labelled_pages``).

Defined cases: a null or empty page has no text; unclosed and stray tags are repaired as
browsers do it roughly; attributes end where the HTML standard ends them (a quote opens a value only right
after an equals sign); scripts, styles, templates, comments and titles never carry text; an element whose content is
not shown (video, object, svg and the like) drops what stands before its own end tag, and drops its tag alone where
an enclosing block or the page ends first; very long and very deep pages are read whole, in time proportional to
their length; repeated rows get equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import labelled_pages
from .learn import logistic

# --- fixed values: HTML element classes and class words ---
RAW = {"script", "style", "iframe", "title", "textarea", "xmp", "noembed", "noframes"}  # no markup inside
CODE = {"script", "style"}
HIDDEN = {"template", "noscript", "svg", "math", "select", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "ruby", "rt", "rp", "center", "nobr", "picture"}
GROUPS = [{"html", "body", "head"}, {"nav", "menu"}, {"header", "hgroup"}, {"footer"}, {"aside"}, {"form", "button", "label", "fieldset", "legend", "option", "dialog"},
          {"article", "main"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"p", "blockquote", "pre"}, {"ul", "ol", "dl"}, {"li", "dt", "dd"},
          {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"div"}, {"section"}, {"figure", "figcaption", "address", "details", "summary"}]
#: A start tag of the first closes open elements of the second, up to one of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
WORDS = {
    "apart": re.compile(r"nav|menu|header|masthead|foot|side-?bar|widget|cookie|consent|notice|popup|modal|newsletter|subscribe|alert|advert|(?<![a-z])ads?(?![a-z])|sponsor|promo|banner"
                        r"|share|social|breadcrumb|toolbar|top-?bar|related|recommend|copyright|legal|login|search|(?<![a-z])tags(?![a-z])", re.I),
    "comment": re.compile(r"comment|discussion|repl(?:y|ies)|respond|disqus", re.I),
    "main": re.compile(r"article|content|entry|story|post|(?<![a-z])text|main", re.I),
}
# --- end of fixed values ---
_GROUP = {t: k for k, g in enumerate(GROUPS) for t in g}
_OTHER = len(GROUPS)
_APART, _MAIN = {1, 2, 3, 4, 5}, 6
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
LABEL = re.compile(r"\by=\"([01])\"")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}


def tokens(s: str) -> Iterator[tuple[str, str, bool]]:
    """(tag name or "", text or attributes, whether it is an end tag) in page order.  Comments, declarations and the
    content of raw-text elements are left out; of a raw-text element without an end tag only code takes the rest."""
    pos, n, last, unclosed = 0, len(s), s.rfind(">"), set()
    while pos < n:
        lt = s.find("<", pos)
        if lt < 0 or lt > last:  # no tag can follow
            yield "", s[pos:], False
            return
        if lt > pos:
            yield "", s[pos:lt], False
        if s.startswith("<!--", lt):
            end = s.find("-->", lt + 2)  # "<!-->" is a whole comment
            pos = n if end < 0 else end + 3
            continue
        if s.startswith(("<!", "<?"), lt):
            end = s.find(">", lt)
            pos = n if end < 0 else end + 1
            continue
        m = TAG.match(s, lt) or LOOSE_TAG.match(s, lt)
        if not m:
            yield "", "<", False
            pos = lt + 1
            continue
        pos = m.end()
        name = m[2].lower()
        if name not in RAW:
            yield name, m[3], bool(m[1])
        elif not m[1] and not m[3].endswith("/") and name not in unclosed:
            end = _RAW_END[name].search(s, pos)
            if end:
                pos = end.end()
            elif name in CODE:
                return
            else:
                unclosed.add(name)


class Open:
    """The open elements, with the depths at which each name is open."""

    def __init__(self):
        self.names, self.items, self.at = ["html"], [0], {}

    def push(self, name: str, item: int) -> None:
        self.at.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.items.append(item)

    def depth(self, names) -> int:
        """Depth of the innermost open element of these names; 0 if none is open."""
        return max((self.at[t][-1] for t in names if self.at.get(t)), default=0)

    def close(self, depth: int) -> None:
        """Closes the element at ``depth`` and all inside it."""
        while len(self.names) > depth:
            self.at[self.names.pop()].pop()
            self.items.pop()


def hidden_ends(toks: list[tuple[str, str, bool]]) -> dict[int, int]:
    """Token number of the start tag -> that of the end tag, of every element of HIDDEN that its own end tag closes."""
    ends, o = {}, Open()
    for i, (name, attrs, closing) in enumerate(toks):
        if not name or name in VOID or name in INLINE:
            continue
        if not closing:
            if not attrs.endswith("/"):
                o.push(name, i)
            continue
        k = o.depth((name,))
        if k:
            if name in HIDDEN:
                ends[o.items[k]] = i
            o.close(k)
    return ends


class Page:
    """Block tree in page order: parents come before children."""

    __slots__ = ("parent", "tag", "attrs", "blocks", "chars", "links", "stops", "label")

    def __init__(self, source: str):
        self.parent, self.tag, self.attrs, self.label = [-1], ["html"], [""], [0]
        self.chars, self.links, self.stops = [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []  # (node, text) in page order
        self._parse(source)

    def _flush(self, node: int, parts: list[str], linked: int) -> None:
        text = " ".join("".join(parts).split())
        if text:
            self.blocks.append((node, text))
            self.chars[node] += len(text)
            self.links[node] += min(linked, len(text))
            self.stops[node] += text.count(". ") + (text[-1] in ".!?")

    def _parse(self, s: str) -> None:
        o, parts, linked, in_link = Open(), [], 0, False
        toks = list(tokens(s))
        ends = hidden_ends(toks) if any(t[0] in HIDDEN for t in toks) else {}
        i, n = -1, len(toks)

        def flush():
            nonlocal linked
            if parts:
                self._flush(o.items[-1], parts, linked)
                parts.clear()
            linked = 0

        while (i := i + 1) < n:
            name, a, closing = toks[i]
            if not name:
                t = _html.unescape(a) if "&" in a else a
                parts.append(t)
                if in_link:
                    linked += len(t.strip())
                continue
            if name in HIDDEN:
                i = ends.get(i, i)
                continue
            if name == "br" or name == "wbr":
                parts.append(" " if name == "br" else "")
                continue
            if name in INLINE:
                if name == "a":
                    in_link = not closing
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                continue
            flush()
            in_link = False
            if closing:
                k = o.depth((name,))
                if k:
                    o.close(k)
                continue
            if name == "html":
                continue
            if name in CLOSES:
                shut, scope = CLOSES[name]
                stop = o.depth(scope)
                while (k := o.depth(shut)) > stop:
                    o.close(k)
                    if name in ("li", "option"):
                        break
            if o.names[-1] == "p":  # a block ends an open paragraph
                o.close(len(o.names) - 1)
            parent = o.items[-1]
            self.parent.append(parent)
            self.tag.append(name)
            self.attrs.append(" ".join("".join(x) for x in ATTRIBUTE.findall(a)) if "=" in a else "")
            y = LABEL.search(a) if "y=" in a else None
            self.label.append(int(y[1]) if y else self.label[parent])
            self.chars.append(0)
            self.links.append(0)
            self.stops.append(0)
            if not a.endswith("/"):
                o.push(name, len(self.tag) - 1)
        flush()

    def features(self) -> list[list[float]]:
        n = len(self.tag)
        sub, sublink, heads = self.chars[:], self.links[:], [t == "h1" for t in self.tag]
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            sub[p] += sub[k]
            sublink[p] += sublink[k]
            heads[p] |= heads[k]
        total = max(sub[0], 1)
        rows = []
        for k in range(n):
            g = _GROUP.get(self.tag[k], _OTHER)
            row = [0.0] * N_FEATURES
            row[g] = 1.0
            a = self.attrs[k]
            if a:
                for i, r in enumerate(WORDS.values()):
                    row[_OTHER + 1 + i] = float(bool(r.search(a)))
            at = _OTHER + 1 + len(WORDS)
            row[at:] = [np.log1p(self.chars[k]) / 5, np.log1p(sub[k]) / 8, sublink[k] / sub[k] if sub[k] else 0.0, sub[k] / total,
                        min(self.stops[k], 5) / 5, float(heads[k]), float(sub[k] == 0)]
            rows.append(row)
        return rows

    def kind(self, k: int) -> int:
        """1: a child that stands apart from its parent's text; 2: one that looks like the article; else 0."""
        g, a = _GROUP.get(self.tag[k], _OTHER), self.attrs[k]
        if g in _APART or (a and (WORDS["apart"].search(a) or WORDS["comment"].search(a))):
            return 1
        return 2 if g == _MAIN or (a and WORDS["main"].search(a)) else 0


N_FEATURES = _OTHER + 1 + len(WORDS) + 7


class Model:
    """Unary weights, and log pair potentials [kind of child][parent state][child state]."""

    def __init__(self, weights: np.ndarray, pair: np.ndarray):
        self.weights, self.pair = weights, pair

    def marginals(self, page: Page, unary: np.ndarray) -> np.ndarray:
        """Probability of content for every node: exact sum-product on the tree."""
        n = len(page.parent)
        # messages as odds of content to not content; u: unary odds times the messages from below
        u = np.exp(np.clip(unary, -30, 30)).tolist()
        pair = np.exp(self.pair).tolist()
        up = [1.0] * n
        kind = [0] * n
        for k in range(n - 1, 0, -1):
            t = kind[k] = page.kind(k)
            (a00, a01), (a10, a11) = pair[t]
            m = up[k] = (a10 + a11 * u[k]) / (a00 + a01 * u[k])
            p = page.parent[k]
            u[p] = min(max(u[p] * m, 1e-200), 1e200)
        out = [0.0] * n
        belief = [0.0] * n
        belief[0] = u[0]
        for k in range(1, n):
            t = kind[k]
            (a00, a01), (a10, a11) = pair[t]
            rest = belief[page.parent[k]] / up[k]  # the parent's odds without this child
            belief[k] = min(max(u[k] * (a01 + a11 * rest) / (a00 + a10 * rest), 1e-200), 1e200)
        for k in range(n):
            out[k] = belief[k] / (1 + belief[k])
        return np.array(out)

    def extract(self, sources: list[str]) -> list[str]:
        pages = [Page(s) if s else None for s in sources]
        rows = [p.features() for p in pages if p]
        if not rows:
            return ["" for _ in sources]
        z = np.concatenate([np.array(r) for r in rows]) @ self.weights[:-1] + self.weights[-1]
        out, at = [], 0
        for p in pages:
            if not p:
                out.append("")
                continue
            n = len(p.parent)
            q = self.marginals(p, z[at:at + n])
            at += n
            out.append("\n".join(t for k, t in p.blocks if q[k] > 0.5))
        return out


def train(pages: list[str] | None = None) -> Model:
    """Weights and pair potentials from labelled pages."""
    parsed = [Page(s) for s in (pages or labelled_pages())]
    x = np.concatenate([np.array(p.features()) for p in parsed])
    y = np.concatenate([np.array(p.label, float) for p in parsed])
    w = logistic(x, y, l2=0.5)
    count = np.ones((3, 2, 2))
    for p in parsed:
        for k in range(1, len(p.parent)):
            count[p.kind(k), p.label[p.parent[k]], p.label[k]] += 1
    joint = count / count.sum((1, 2), keepdims=True)
    pair = np.log(joint) - np.log(joint.sum(2, keepdims=True)) - np.log(joint.sum(1, keepdims=True))
    return Model(w, pair)


def text_column(model: Model, source):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for col in batches:
            out: list[str] = []
            for i in range(0, len(col), 200):
                out += model.extract(list(col.iloc[i:i + 200]))
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string").asNondeterministic()(source)


def extract_pages(pages: DataFrame, html_col: str = "html", model: Model | None = None) -> DataFrame:
    """``pages`` with the main text in place of the html, as ``page_id, url, text, n_chars``."""
    t = pages.select("page_id", "url", text_column(model or train(), F.col(html_col).cast("string")).alias("text"))
    return t.withColumn("n_chars", F.length("text").cast("long"))


def op8_html_text(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
