"""Main text of web pages: a tree-structured graphical model over the DOM.

A page becomes a tree of block elements and text blocks (runs of inline text). Every node is content or not. Unary
potentials come from the node's tag, the words of its class, id and role, and its text and link lengths; pairwise
potentials tie a child to its parent. A word that is a whole name (``side``) speaks for its kind; in a compound name a
word of everyday language (``side-by-side``, ``share-price``) speaks less, as articles are marked up with such names
too. Hidden is what has the attribute ``hidden`` or ``aria-hidden``, the style ``display:none`` or the class ``hidden``,
and not what only contains the word. Sum-product messages go up and down the tree once and give exact marginals; text
blocks with a marginal over 0.5 are the main text. The weights are trained by gradient ascent on the exact likelihood of
labelled pages (``labelled_pages``: layouts with marked articles, filled with invented words).

Scripts, styles, comments and markup never become text, nor does ``noscript``. Character references are decoded, white
space inside a block is one space, blocks are joined by one newline in page order. A tag that the page's end cuts off is
dropped; elements without end tags end where HTML says. Inside a tag a quote opens a value only after ``=`` and only if
the page closes it; any other quote is an ordinary character. Formulas (``math``) are inline text. Drawings (``svg``)
are none, but for their ``foreignObject``; one without an end tag ends at ``/>``, at the next HTML tag, or where the
element around it ends.
Null and empty pages give an empty text; nothing is capped.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VALUE = r"\s*+=\s*+(?:\"{0}\"|'{1}'|{2})"
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<([a-zA-Z][^\s/>]*+)"
    rf"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE.format('[^\"]*+', "[^']*+", '[^\\s>]*+')})?+)*+)>"
    r"|</([a-zA-Z][^\s/>]*+)[^>]*+>|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:{_VALUE.format('([^\"]*+)', "([^']*+)", '([^\\s>]*+)')})?+")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
#: Names of elements by their role in HTML.
RAW = frozenset("script style textarea title iframe noframes noembed xmp noscript template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark q ruby rt s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math annotation annotation-xml maction menclose merror mfenced mfrac mglyph mi mlabeledtr mmultiscripts mn mo mover mpadded "
    "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
SPACED = frozenset("br mtd annotation annotation-xml".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
#: Start tags that cannot stand in a drawing: it has ended, as HTML says.
LEAVES_SVG = CLOSES_P | SAME.keys() | (INLINE - {"a"}) | {"body", "embed"}
STOPS = frozenset("ul ol dl table select body div article section".split())
#: Words of class, id and role names, by what they speak of.
WORDS = {
    "w:content": "content article post entry story main text body",
    "w:menu": "nav navbar menu breadcrumb breadcrumbs pagination pager toolbar navigation skip",
    "w:ad": "ad ads advert advertisement sponsor sponsored promo promotion banner adsense advertorial",
    "w:foot": "footer foot copyright colophon legal contentinfo",
    "w:head": "header masthead logo brand topbar site",
    "w:side": "sidebar side aside widget related recommended share social tags more trending complementary popular teaser",
    "w:comment": "comment comments reply replies disqus respond discussion reactions",
    "w:notice": "cookie cookies consent notice alert modal popup newsletter subscribe login signup gdpr privacy overlay dialog",
}
_KEYWORD = {w: k for k, words in WORDS.items() for w in words.split()}
#: Those of the words that compound names of anything may contain.
COMMON = frozenset(
    "text main story body more share social side trending popular tags legal foot brand site skip reply respond discussion reactions "
    "notice alert consent complementary overlay dialog widget pager menu logo".split()
)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "names", "hidden", "gold", "parent", "children", "parts", "chars", "links")

    def __init__(self, tag: str, parent: Node | None, names: str = "", gold: str | None = None, hidden: bool = False) -> None:
        self.tag, self.names, self.hidden, self.gold, self.parent = tag, names, hidden, gold, parent
        self.children: list[Node] = []
        self.parts: list[str] = []
        self.chars = self.links = 0
        if parent:
            parent.children.append(self)


def parse(page: str) -> Node:
    """The tree of block elements; text blocks are nodes with the tag ``#text``."""
    root = Node("html", None)
    stack, block, inline, pos, n = [root], None, 0, 0, len(page)
    drawing = links = paused = 0  # depths of svg and of its own links, and the first while in a foreignObject
    endless: set[str] = set()
    places: dict[str, list[int]] = {}  # of each tag where it stands in the stack

    def push(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def text(raw: str) -> None:
        nonlocal block
        if drawing or not raw or (block is None and not raw.strip()):
            return
        raw = entities.unescape(raw)
        if block is None:
            block = Node("#text", stack[-1])
        size = len(raw) - raw.count(" ")
        block.parts.append(raw)
        block.chars += size
        block.links += size if inline else 0

    def innermost(names: set[str] | frozenset[str]) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=0)

    def close(names: set[str] | frozenset[str], stops: frozenset[str]) -> None:
        """Closes the innermost of ``names`` and what is in it, unless one of ``stops`` stands between."""
        at = innermost(names)
        if at and at >= innermost(stops):
            for node in reversed(stack[at:]):
                places[node.tag].pop()
            del stack[at:]

    while pos < n:
        at = page.find("<", pos)
        if at < 0:
            text(page[pos:])
            break
        m = _TOKEN.match(page, at)
        if not m:
            cut = page[at + 1 : at + 2]
            if cut.isalpha() or cut in ("/", "!", "?"):
                text(page[pos:at])  # the page ends inside a tag
                break
            text(page[pos : at + 1])
            pos = at + 1
            continue
        text(page[pos:at])
        pos = m.end()
        if m[1]:
            tag, shut = m[1].lower(), m[2].endswith("/")
            if drawing and tag in LEAVES_SVG:
                drawing = 0
            if tag == "svg":
                if not shut:
                    drawing, links = drawing + 1, links if drawing else 0
            elif drawing and (shut or tag in endless):
                continue
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, pos)
                if drawing and not end:
                    endless.add(tag)
                else:
                    pos = end.end() if end else n
            elif drawing:
                links += tag == "a"
                if tag == "foreignobject":
                    drawing, paused, block, inline = 0, drawing, None, 0
            elif tag in INLINE:
                inline += tag == "a"
                if tag in SPACED:
                    text(" ")
            elif tag not in ("html", "head"):
                block = None
                if tag in CLOSES_P:
                    close({"p"}, STOPS)
                if tag in SAME:
                    close(SAME[tag], STOPS)
                names, gold, hidden = "", None, False
                for k, *v in _ATTRIBUTE.findall(m[2]):
                    k, value = k.lower(), "".join(v)
                    if k in ("class", "id", "role", "itemprop"):
                        names += " " + value
                    elif k == "aria-label":  # a phrase, so one name
                        names += " " + "-".join(value.split())
                    elif k == "hidden" or (k == "aria-hidden" and value.strip().lower() != "false") or (k == "style" and _UNSEEN.search(value)):
                        hidden = True
                    elif k == "data-gold":
                        gold = value
                if tag not in VOID:
                    inline = 0
                    push(Node(tag, stack[-1], names, gold, hidden))
        elif m[3]:
            tag = m[3].lower()
            if tag == "foreignobject" and paused:
                drawing, paused, block, inline = paused, 0, None, 0
            if drawing:
                if tag == "svg":
                    drawing -= 1
                elif tag == "a" and links:
                    links -= 1
                elif tag in INLINE or places.get(tag):
                    drawing = 0  # the end of what the drawing stands in
                if tag == "svg" or drawing or (tag == "a" and not inline):
                    continue
            if tag == "a":
                inline = max(0, inline - 1)
            elif tag not in INLINE and tag not in RAW:
                block, inline = None, 0
                if tag not in ("body", "html"):
                    close({tag}, frozenset())
    return root


def _log_bin(n: int) -> int:
    return min(7, int(math.log2(n + 1)))


def features(node: Node) -> list[str]:
    if node.tag == "#text":
        share = node.links / max(1, node.chars)
        kind = "none" if not node.links else "some" if share < 0.5 else "all"
        raw = node.parts[-1].rstrip()
        return ["text", f"t:size{_log_bin(node.chars)}", f"t:link-{kind}", f"t:in-{node.parent.tag}", f"t:stop{raw[-1:] in '.!?'}"]
    found = {"w:hidden"} if node.hidden else set()
    for name in node.names.split():
        words = [w.lower() for w in _PARTS.findall(name)]
        if words == ["hidden"]:
            found.add("w:hidden")
        for w in words:
            if w in _KEYWORD:
                found.add(_KEYWORD[w] if len(words) == 1 or w not in COMMON else f"c{_KEYWORD[w][1:]}")
    return ["element", f"e:{node.tag}", *(found or ["w:none"])]


def nodes_of(root: Node) -> list[Node]:
    """Parents before children, children in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node.children))
    return out


def _soft(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


KINDS = ("text", "noise", "box", "block")
_NOISE = frozenset("nav aside footer header form button label select dialog menu fieldset".split())
_BOX = frozenset("html body div section main article center table tbody tr".split())


def kind_of(node: Node, names: list[str]) -> str:
    """What the tie to its parent depends on."""
    if node.tag == "#text":
        return "text"
    if node.tag in _NOISE or any(f[:2] == "w:" and f not in ("w:none", "w:content") for f in names):
        return "noise"
    return "box" if node.tag in _BOX else "block"


class TreeModel:
    """Weights of features, and for each kind of child a table of parent-child potentials."""

    def __init__(self) -> None:
        self.unary: dict[str, float] = {}
        self.pair = {kind: [[0.0, 0.0], [0.0, 0.0]] for kind in KINDS}

    def marginals(self, nodes: list[Node], names: list[list[str]] | None = None):
        """P(content) of each node, and of each node but the first the joint table with its parent."""
        names = names or [features(x) for x in nodes]
        place = {id(x): i for i, x in enumerate(nodes)}
        own = [sum(self.unary.get(f, 0.0) for f in fs) for fs in names]
        parent = [place[id(x.parent)] if x.parent else -1 for x in nodes]
        table = [self.pair[kind_of(x, fs)] for x, fs in zip(nodes, names)]
        up0, up1 = [0.0] * len(nodes), own[:]  # log beliefs of the subtree below each node
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            t = table[i]
            sent[i] = _soft(t[0][0] + up0[i], t[0][1] + up1[i]), _soft(t[1][0] + up0[i], t[1][1] + up1[i])
            up0[parent[i]] += sent[i][0]
            up1[parent[i]] += sent[i][1]
        all0, all1 = up0[:], up1[:]
        joint: list[list[float]] = [[]] * len(nodes)
        for i in range(1, len(nodes)):
            p, t = parent[i], table[i]
            rest0, rest1 = all0[p] - sent[i][0], all1[p] - sent[i][1]  # the parent's belief without this child
            cells = [rest0 + t[0][0] + up0[i], rest0 + t[0][1] + up1[i], rest1 + t[1][0] + up0[i], rest1 + t[1][1] + up1[i]]
            top = max(cells)
            cells = [math.exp(c - top) for c in cells]
            total = sum(cells)
            joint[i] = [c / total for c in cells]
            all0[i] = up0[i] + _soft(rest0 + t[0][0], rest1 + t[1][0])
            all1[i] = up1[i] + _soft(rest0 + t[0][1], rest1 + t[1][1])
        return [1 / (1 + math.exp(min(700, a - b))) for a, b in zip(all0, all1)], joint

    def fit(self, pages: list[str], *, rounds: int = 14, rate: float = 0.3, decay: float = 1e-3) -> TreeModel:
        """Gradient steps with per-weight rates on the exact log likelihood; ``data-gold`` marks the labels."""
        trees = []
        for page in pages:
            nodes = nodes_of(parse(page))
            gold: dict[int, int] = {}
            for x in nodes:
                gold[id(x)] = int(x.gold) if x.gold is not None else gold.get(id(x.parent), 0)
            trees.append((nodes, [features(x) for x in nodes], [gold[id(x)] for x in nodes]))
        seen: dict[object, float] = {}
        for _ in range(rounds):
            for nodes, names, gold in trees:
                marginal, joint = self.marginals(nodes, names)
                place = {id(x): i for i, x in enumerate(nodes)}
                step: dict[object, float] = {}
                for i, x in enumerate(nodes):
                    for f in names[i]:
                        step[f] = step.get(f, 0.0) + gold[i] - marginal[i]
                    if i:
                        kind, truth = kind_of(x, names[i]), 2 * gold[place[id(x.parent)]] + gold[i]
                        for c in range(4):
                            step[kind, c] = step.get((kind, c), 0.0) + (c == truth) - joint[i][c]
                for key, g in step.items():
                    now = self.unary.get(key, 0.0) if isinstance(key, str) else self.pair[key[0]][key[1] // 2][key[1] % 2]
                    g -= decay * now
                    seen[key] = seen.get(key, 1e-6) + g * g
                    now += rate * g / math.sqrt(seen[key])
                    if isinstance(key, str):
                        self.unary[key] = now
                    else:
                        self.pair[key[0]][key[1] // 2][key[1] % 2] = now
        return self


def labelled_pages(count: int = 220, seed: int = 11) -> list[str]:
    """Layouts with marked articles (``data-gold``): the training set."""
    r, everyday = random.Random(seed), sorted(COMMON)

    def words(a: int, z: int) -> str:
        return " ".join("".join(r.choice("aeiounrstlmdkp") for _ in range(r.randint(2, 8))) for _ in range(r.randint(a, z)))

    def sentence(a: int = 4, z: int = 18) -> str:
        return words(a, z).capitalize() + r.choice(".....!?")

    def prose() -> str:
        text = " ".join(sentence() for _ in range(r.choice((1, 1, 2, 4, 8))))
        return text if r.random() < 0.85 else text[:-1] + r.choice((":", "”", ""))

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{words(1, 4)}</a></li>' for _ in range(n)) + "</ul>"

    def row(n: int) -> str:
        return r.choice((" | ", " ", " &middot; ")).join(f'<a href="/x">{words(1, 3)}</a>' for _ in range(n))

    def named(kind: str) -> str:
        return r.choice(("class", "id")) + f'="{r.choice(WORDS[kind].split())}{r.choice(("", "-box", " x", "-1"))}"'

    def compound() -> str:
        """Names as articles have them too: utility classes, and everyday words in compounds."""
        return "class=" + '"' + " ".join(r.choice((
            lambda: f"{r.choice(everyday)}-{words(1, 1)}", lambda: f"{words(1, 1)}-{r.choice(everyday)}", lambda: f"{r.choice(everyday)}-{r.choice(everyday)}",
            lambda: r.choice("overflow-hidden mx-auto flex row container wrapper text-lg lead is-wide col-md-8 mt-4 unhidden".split()), lambda: words(1, 1),
        ))() for _ in range(r.randint(1, 2))) + '"'

    def noise(inside: bool) -> str:
        mark = ' data-gold="0"' if inside else ""
        sub = lambda kind, tag="div": f"<{tag} {named(kind)}{mark}>"
        return r.choice((
            lambda: f"{sub('w:ad')}{r.choice((sentence(), prose()))}</div>",
            lambda: f"<aside{mark}><h3>{words(1, 3)}</h3>{r.choice((links(4), f'<p>{prose()}</p>'))}</aside>",
            lambda: f"{sub('w:side')}<h4>{words(1, 3)}</h4>{r.choice((links(5), f'<p>{prose()}</p>'))}</div>",
            lambda: f"{sub('w:notice')}<p>{prose()}</p><button>{words(1, 2)}</button></div>",
            lambda: f"<form{mark}><label>{words(1, 3)}</label><input><p>{sentence()}</p><button>{words(1, 2)}</button></form>",
            lambda: f"{sub('w:menu')}{links(r.randint(2, 7))}</div>", lambda: f"<div{mark}>{row(r.randint(2, 7))}</div>",
            lambda: f"{sub('w:comment', r.choice(('div', 'section')))}<h3>{words(1, 2)}</h3>"
            + "".join(r.choice((f"<div><p>{prose()}</p></div>", f"<p>{prose()}</p>")) for _ in range(r.randint(1, 4))) + "</div>",
            lambda: f"<div {r.choice(('hidden', 'style=display:none', 'aria-hidden=true', 'class=hidden'))}{mark}><p>{prose()}</p></div>",
            lambda: f"<div {compound()}{mark}>{links(r.randint(2, 6))}</div>",
            lambda: f"{sub('w:comment', 'ul')}" + "".join(f"<li><p>{prose()}</p></li>" for _ in range(3)) + "</ul>",
        ))()

    def paragraph() -> str:
        return r.choice((
            f"<p>{prose()}</p>", f"<p>{prose()}", f"<p>{prose()}</p>", f"<p><b>{prose()}<br><p>{prose()}</p>", f"<{(h := r.choice(('h2', 'h3', 'h4')))}>{words(2, 6)}</{h}>",
            f'<p>{prose()} <a href="/y">{words(1, 3)}</a> {prose()}</p>', f"<ul><li>{sentence()}</li><li>{prose()}</li></ul>",
            f"<blockquote><p>{prose()}</p></blockquote>", f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>",
            f"<div>{prose()}</div>", f"<p>{words(1, 3)}.</p>",
            f"<div {compound()}><p>{prose()}</p><p>{prose()}</p></div>", f"<{(h := r.choice(('div', 'section', 'p')))} {compound()}>{prose()}</{h}>",
            f"<section {compound()}><h2 {compound()}>{words(2, 6)}</h2><p {compound()}>{prose()}</p><div {compound()}>{prose()}</div></section>",
        ))

    pages = []
    for _ in range(count):
        head = f"<h1>{words(3, 12)}</h1>" if r.random() < 0.9 else ""
        body = "".join(paragraph() if r.random() < 0.92 else noise(True) for _ in range(r.randint(1, 14)))
        open_, shut = r.choice((
            ("<article data-gold=1>", "</article>"), ("<main data-gold=1>", "</main>"), ("<main data-gold=0><article data-gold=1>", "</article></main>"),
            (f'<div {named("w:content")} data-gold=1>', "</div>"), (f'<article {named("w:content")} data-gold=1>', "</article>"),
            (f'<section {named("w:content")} data-gold=1>', "</section>"), ("<div data-gold=1>", "</div>"),
            (f"<article {compound()} data-gold=1>", "</article>"), (f"<main {compound()} data-gold=1><div {compound()}>", "</div></main>"),
            (f"<div {compound()} data-gold=0><div {compound()} data-gold=1>", "</div></div>"),
            (f"<table><tr><td>{row(r.randint(3, 7))}</td></tr><tr><td>{links(r.randint(2, 7))}</td><td data-gold=1>", "</td></tr></table>"),
        ))
        top = [f"<nav>{links(r.randint(2, 8))}</nav>", f"<header><a href=/>{words(1, 3)}</a><p>{words(2, 6)}</p></header>"]
        top += [f"<div {named('w:head')}><h1>{words(1, 3)}</h1>{links(3)}</div>", noise(False), noise(False)]
        low = [f"<footer>&copy; {words(1, 4)} {sentence()}</footer>", f"<div {named('w:foot')}><p>{sentence()}</p>{links(3)}</div>"]
        low += [f"<footer><p>{prose()}</p>{links(4)}</footer>", noise(False), noise(False), noise(False)]
        top, low = r.sample(top, r.randint(1, 3)), r.sample(low, r.randint(1, 3))
        page = "".join(top) + open_ + head + body + shut + "".join(low)
        page = f"<!DOCTYPE html><html><head><title>{words(2, 5)}</title></head><body>{page}</body></html>"
        if r.random() < 0.12:  # a fragment, as some crawls store
            page = open_ + head + body
        pages.append(page[: int(len(page) * r.uniform(0.7, 1))] if r.random() < 0.1 else page)
    return pages


@cache
def trained() -> TreeModel:
    return TreeModel().fit(labelled_pages())


def main_text(page: str | None, model: TreeModel) -> str:
    nodes = nodes_of(parse(page or ""))
    marginal, _ = model.marginals(nodes)
    blocks = (" ".join("".join(x.parts).split()) for x, p in zip(nodes, marginal) if x.tag == "#text" and p > 0.5)
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, *, html_col: str = "html", model: TreeModel | None = None) -> DataFrame:
    """``pages`` with ``text`` (empty where there is none); a column of this name is replaced."""
    shared = pages.sparkSession.sparkContext.broadcast(model or trained())  # a few hundred weights

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(x, shared.value) for x in batch], dtype=object)

    return pages.withColumn("text", run(F.col(html_col)))
