"""HTML extraction (operator 7): a linear-chain conditional random field over DOM leaf blocks.

A page is parsed into its leaf blocks: runs of text between the borders of block elements, each with the
chain of its ancestors. Features are the tags and the class, id and role words of the ancestors, and
the block's text: length, share of link text, signs, its words if it is short. The CRF labels each block
as main text or not; neighbours' labels are tied by transition weights, and Viterbi gives the best sequence.

It is trained on labelled pages: a bounded sample of the table whose article is marked up
(``<article>``, ``<main>`` or such a role), labelled by that markup, and pages made from templates with the
usual furniture (menus, notices, adverts, comments) in and around the article, labelled as made."""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.base import arrow_limits, per_batch, pick

SAMPLE = 400       # pages of the table learnt from, at most
TEMPLATES = 600    # made pages

# --- fixed values: kinds of elements ------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr "
                   "math annotation menclose mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
FOREIGN = frozenset("svg math".split())
#: Elements besides foreign and custom ones that ``/>`` closes, as XHTML pages write them.
EMBEDDED = frozenset("script style noscript template iframe object svg math canvas".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An opening tag ends an open one of these, up to the nearest of the limits.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}

_TAG = re.compile(r"""(?P<comment><!--)(?:.*?-->|(?P<rest>.*))|<(?P<raw>script|style)(?=[\s/>])(?!(?:[^>]*(?:["'\s]|\s[\w-]+))?/>)[^>]*+>(?:.*?</(?P=raw)(?=[\s/>])[^>]*+>|(?P<open>.*))|"""
                  r"""<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<tail>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|"""
                  r"""<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<tail2>[^>]*+)>|<[!?/][^>]*+>""", re.DOTALL | re.IGNORECASE)
_ATTR = re.compile(r"""\b(class|id|role|data-y|hidden|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_CLOSED = re.compile(r"""(?:^|["'\s]|\s[\w-]+)/$""")   # not the end of a value without quotes
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: Groups of ``SIBLINGS``, and paragraphs, which every element but inline ones limits.
_GROUPS = tuple(SIBLINGS) + ("p",)
_ENDS = {t: [i for i, g in enumerate(_GROUPS[:-1]) if t in SIBLINGS[g][0]] for g in SIBLINGS for t in SIBLINGS[g][0]}
_LIMITS = {t: [i for i, g in enumerate(_GROUPS[:-1]) if t in SIBLINGS[g][1]] for g in SIBLINGS for t in SIBLINGS[g][1]}
_P = len(_GROUPS) - 1

NEAR_NAMED = 8     # ancestors whose names are features: the innermost that have any
NAMES = 32         # words of one element's class, id and role that are features, at most
TAGS = 40          # different tags of ancestors that are features: the innermost


class Node:
    """An element. What its ancestors say is merged when it is opened, at a bounded cost each, so that
    deep nesting takes time in proportion to the page."""
    __slots__ = ("tag", "parent", "depth", "names", "near", "tags", "label", "inner", "link", "foreign", "article", "main", "named",
                 "furniture", "open", "kids", "first", "last", "parted", "prose")

    def __init__(self, tag: str, parent: Node | None, names: frozenset[str], label: str | None, at: int):
        self.tag, self.parent, self.names, self.kids, self.first, self.last, self.parted, self.prose = tag, parent, names, None, at, at, False, 0.0
        kind = _kind(tag, names)
        if parent is None:
            self.depth, self.near, self.tags, self.label, self.inner = 0, (), (), label, "nothing"
            self.link = self.foreign = self.article = self.main = self.furniture = False
            self.named = None     # the outermost element with a name of an article
            self.open = (-1,) * len(_GROUPS)
            return
        self.depth = parent.depth + 1
        self.near = (parent.near + (names,))[-NEAR_NAMED:] if names else parent.near
        self.tags = parent.tags if tag in parent.tags else (parent.tags + (tag,))[-TAGS:]
        self.label = parent.label if label is None else label
        self.inner = kind or parent.inner
        self.link = parent.link or tag == "a"
        self.foreign = parent.foreign or tag in FOREIGN
        self.article = parent.article or tag == "article"
        self.main = parent.main or tag in MAIN_TAGS
        self.named = parent.named or (self if names & _article_names() else None)
        self.furniture = parent.furniture or tag in FURNITURE_TAGS
        self.open = parent.open
        if tag not in INLINE or tag in _ENDS or tag in _LIMITS:
            near = list(parent.open)
            for i in _LIMITS.get(tag, ()):
                near[i] = -1
            for i in _ENDS.get(tag, ()):
                near[i] = self.depth
            near[_P] = self.depth if tag == "p" else -1
            self.open = tuple(near)
            if parent.kids is None:
                parent.kids = {}
            parent.kids[tag, names] = parent.kids.get((tag, names), 0) + 1
            parent.parted = True


@dataclass(slots=True)
class Block:
    text: str
    node: Node                   # the innermost element around it that is not inline
    tags: tuple[str, ...]        # different tags of its ancestors, outermost first
    near: tuple[frozenset[str], ...]   # words of class, id and role of the innermost ancestors that have any
    linked: float                # share of text inside links
    inner: str                   # what the innermost telling ancestor is: furniture, article or nothing
    label: str | None            # data-y of the innermost ancestor that has it


@lru_cache(maxsize=4096)
def _attributes(tail: str) -> tuple[frozenset[str], str | None]:
    names, label = {}, None
    for m in _ATTR.finditer(tail):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "data-y":
            label = value
        else:
            names.update((w.lower(), None) for w in _NAME.findall(value))
    return frozenset(list(names)[:NAMES]), label


@lru_cache(maxsize=4096)
def _kind(tag: str, names: frozenset[str]) -> str | None:
    """What an element's names, or else its tag, say about what is inside."""
    if names & _furniture():
        return "furniture"
    if names & _article_names():
        return "article"
    return "furniture" if tag in FURNITURE_TAGS else "article" if tag in MAIN_TAGS else None


def blocks(page: str) -> list[Block]:
    """Leaf blocks with text, in page order. Scripts, styles, comments and the like have none. Takes time in
    proportion to the page, however deep its elements are nested and whatever they leave unclosed."""
    out: list[Block] = []
    stack = [Node("", None, frozenset(), None, 0)]
    opened: dict[str, int] = {}
    pieces: list[str] = []
    links = 0

    def flush():
        nonlocal pieces, links
        if pieces:
            raw = "".join(pieces)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                top = own = stack[-1]
                while own.tag in INLINE and own.parent is not None and top.depth - own.depth < TAGS:
                    own = own.parent
                out.append(Block(text, own, top.tags, top.near, min(1.0, links / max(1, len(raw))), top.inner, top.label))
        pieces, links = [], 0

    def close(depth: int):
        if any(stack[i].tag not in INLINE for i in range(depth, len(stack))):
            flush()
        while len(stack) > depth:
            gone = stack.pop()
            gone.last = len(out)
            opened[gone.tag] -= 1

    def add(text: str):
        nonlocal links
        if text:
            pieces.append(text)
            if stack[-1].link:
                links += len(text)

    at = 0
    # behind the last > there is no tag; an unfinished comment or script goes on to the end
    for m in _TAG.finditer(page, 0, page.rfind(">") + 1):
        add(page[at:m.start()])
        at = m.end()
        if m["rest"] is not None or m["open"] is not None:
            at = len(page)
            break
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            if opened.get(tag):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close(depth)
            elif tag not in INLINE:
                flush()
            continue
        if tag in VOID:
            if tag == "br":
                add(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in CLOSES_P and stack[-1].open[_P] > 0:
            close(stack[-1].open[_P])
        if tag in SIBLINGS and stack[-1].open[_GROUPS.index(tag)] > 0:
            close(stack[-1].open[_GROUPS.index(tag)])
        if tag not in INLINE:
            flush()
        tail = m["tail"] or m["tail2"] or ""
        if tail.endswith("/") and (tag in EMBEDDED or "-" in tag or stack[-1].foreign) and _CLOSED.search(tail):
            continue
        names, label = _attributes(tail.strip()) if "=" in tail else (frozenset(), None)
        stack.append(Node(tag, stack[-1], names, label, len(out)))
        opened[tag] = opened.get(tag, 0) + 1
    add(page[at:])
    flush()
    for node in stack:
        node.last = len(out)
    return out


def _densest(page: list[Block]) -> Node | None:
    """The element whose children hold most of the text outside links and furniture: a block's characters
    count for the element around it, and half for the next one out."""
    found: dict[int, Node] = {}
    for b in page:
        if b.inner != "furniture":
            worth = len(b.text) * (1.0 - b.linked)
            for node, part in ((b.node.parent, 1.0), (b.node.parent and b.node.parent.parent, 0.5)):
                if node is not None:
                    if id(node) not in found:
                        found[id(node)], node.prose = node, 0.0
                    node.prose += part * worth
    return max(found.values(), key=lambda n: (n.prose, -n.first, n.depth), default=None)


def _marked(page: list[Block]) -> list[str]:
    """Whether each block is inside what the page marks as its article, by tag or else by name: in, out, or none
    if it marks nothing."""
    size = [len(b.text) if b.inner != "furniture" else 0 for b in page]
    article, main = (sum(n for n, b in zip(size, page) if getattr(b.node, k)) for k in ("article", "main"))
    if article or main:      # <main> around a few small <article>s is the article itself
        scope = "article" if article and 2 * article >= main else "main"
        return ["in" if getattr(b.node, scope) else "out" for b in page]
    held: dict[Node, int] = {}
    for n, b in zip(size, page):
        if b.node.named:
            held[b.node.named] = held.get(b.node.named, 0) + n
    most = max(held, key=lambda k: (held[k], -k.first), default=None)
    if most is None or 2 * held[most] < sum(size):      # a name counts only with most of the text in it
        return ["none"] * len(page)
    return ["in" if b.node.named is most else "out" for b in page]


def _repeats(node: Node) -> int:
    """How often structure like that around a block is repeated: the most siblings with the same tag and names of
    one of the three elements around it that have parts or names."""
    most = 0
    for _ in range(3):
        if node.parent is None:
            break
        if node.parted or node.names:
            most = max(most, (node.parent.kids or {}).get((node.tag, node.names), 0))
        node = node.parent
    return min(most.bit_length(), 4)


def features(page: list[Block]) -> list[list[str]]:
    """Feature names of each block."""
    out = []
    dense, marked = _densest(page), _marked(page)
    for i, b in enumerate(page):
        own = b.node.tag
        n = len(b.text.split()) if len(b.text) < 400 else 64
        f = ["bias", "tag=" + own, f"words={n.bit_length()}", f"links={round(b.linked * 4)}", f"end={b.text[-1] if not b.text[-1].isalnum() else 'a'}"]
        f += ["in=" + t for t in b.tags if t not in ("html", "body")]
        names = frozenset().union(*b.near)
        f += ["name=" + w for w in names]
        f += ["begins=" + w for w in {w[:4] for w in names if len(w) > 4}]
        f += ["inner=" + b.inner, f"inner={b.inner} links={round(b.linked * 2)}", f"inner={b.inner} marked={marked[i]}", "marked=" + marked[i],
              f"marked={marked[i]} links={round(b.linked * 2)}"]
        inside = dense is not None and dense.first <= i < dense.last and b.node.depth >= dense.depth
        place = f"in{min(b.node.depth - dense.depth, 3)}" if inside else "before" if dense is None or i < dense.first else "after"
        f += ["dense=" + place, f"dense={place} marked={marked[i]}", f"dense={place} inner={b.inner}"]
        repeats = _repeats(b.node)
        f += [f"repeats={repeats}", f"repeats={repeats} dense={place}"]
        f.append(f"first={i < 2}")
        if n <= 12:
            f += ["word=" + w.strip(".,:;!?()").lower() for w in set(b.text.split())]
        if "©" in b.text:
            f.append("copyright")
        out.append(f)
    return out


@dataclass(frozen=True)
class Model:
    """``weights``: feature -> weight of the label main; ``moves[a, b]``: from label a to b."""
    weights: dict[str, float]
    moves: np.ndarray


def decode(model: Model, names: list[list[str]]) -> list[bool]:
    """Viterbi: the best sequence of labels."""
    if not names:
        return []
    get = model.weights.get
    (m00, m01), (m10, m11) = model.moves.tolist()
    s0, s1, back = 0.0, sum(get(f, 0.0) for f in names[0]), []
    for f in names[1:]:
        e = sum(get(x, 0.0) for x in f)
        a, b = s0 + m00, s1 + m10
        c, d = s0 + m01, s1 + m11
        back.append((b > a, d > c))
        s0, s1 = max(a, b), max(c, d) + e
    label = s1 > s0
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return out[::-1]


def main_text(model: Model, page: str | None) -> str:
    found = blocks(page) if page else []
    return " ".join(b.text for b, y in zip(found, decode(model, features(found)), strict=True) if y)


# --- training pages --------------------------------------------------------------
MAIN_TAGS = frozenset(("article", "main"))
FURNITURE_TAGS = frozenset("nav header footer aside form menu button select head title dialog".split())
FURNITURE_NAMES = ("ad ads advert advertisement advertising banner sponsor sponsored promo promotion sidebar side widget menu nav navigation navbar breadcrumb breadcrumbs "
                   "header masthead topbar footer foot copyright legal cookie cookies consent notice notices alert warning disclaimer gdpr popup modal overlay newsletter subscribe signup login register "
                   "form search comment comments commentlist respond reply replies discussion disqus feedback share sharing social related recommended popular trending tags pagination pager toolbar skip").split()
ARTICLE_NAMES = "content article post entry story body main text blog news".split()


def _markup_labels(page: list[Block]) -> list[int] | None:
    """Labels by markup; None if the page has no marked article."""
    y = [int(b.inner == "article" and b.node.main and not b.node.furniture) for b in page]
    return y if any(y) else None


@lru_cache(maxsize=1)
def _furniture() -> frozenset[str]:
    return frozenset(FURNITURE_NAMES)


@lru_cache(maxsize=1)
def _article_names() -> frozenset[str]:
    return frozenset(ARTICLE_NAMES)


def template_page(rng: random.Random) -> str:
    """A made page; ``data-y`` tells whether what is inside is main text."""
    syllables = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo za".split()

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def words(low, high, end="."):
        out = " ".join(word() for _ in range(rng.randint(low, high)))
        return out.capitalize() + end

    def links(n):
        kind = rng.choice(["li", "span", "div"])
        items = "".join(f"<{kind}><a href='/{word()}'>{words(1, 3, '')}</a></{kind}>" for _ in range(n))
        return f"<ul>{items}</ul>" if kind == "li" else items

    def thread():
        """Reader comments: the same structure some times, under any name."""
        name, part, tag = word(), rng.choice([f" class='{word()}'", ""]), rng.choice(["div", "div", "li", "section"])
        who = rng.choice([lambda: f"<b>{word()}</b>", lambda: f"<div>{word()}</div>", lambda: f"<span>{word()}</span> <time>{rng.randint(1, 28)}.{rng.randint(1, 12)}.</time>", lambda: ""])
        flat = rng.random() < 0.4
        one = (lambda: f"<p>{rng.choice([word() + ': ', ''])}{words(2, 30)}</p>") if flat else (lambda: f"<{tag}{part}>{who()}<p>{words(2, 40)}</p></{tag}>")
        title = rng.choice(["", f"<h3>{words(1, 2, '')}</h3>"])
        full = rng.choice([name, f"{rng.choice(ARTICLE_NAMES)}-{name}", f"{name}{rng.randint(1, 9)}", f"{word()}-{rng.choice(ARTICLE_NAMES)}s"])
        return f"<div {rng.choice(['class', 'id'])}='{full}' data-y='0'>{title}{''.join(one() for _ in range(rng.randint(1 if flat else 2, 6)))}</div>"

    def furniture(listed=True):
        name = rng.choice(FURNITURE_NAMES) if listed else word()
        tag = rng.choice(["div", "div", "div", "section", "aside", "ul", "p"])
        key = rng.choice(["class", "class", "id"])
        full = rng.choice([name, f"{name}-{rng.choice(['box', 'bar', 'list', 'area', 'wrap'])}", f"{word()} {name}", f"{name}{rng.randint(1, 9)}"])
        inside = rng.choice([lambda: links(rng.randint(1, 6)), lambda: words(3, 30), lambda: "".join(f"<p>{words(3, 40)}</p>" for _ in range(rng.randint(1, 4))),
                             lambda: f"<h3>{words(1, 3, '')}</h3><p>{words(4, 40)}</p><p>{words(4, 40)}</p>", lambda: f"<p><b>{word()}</b>: {words(5, 60)}</p>"])()
        if tag == "p":
            inside = words(3, 25)
        return f"<{tag} {key}='{full}' data-y='0'>{inside}</{tag}>"

    def by_tag():
        return rng.choice([
            lambda: f"<nav data-y='0'>{links(rng.randint(2, 8))}</nav>", lambda: f"<aside data-y='0'><h3>{words(1, 3, '')}</h3><p>{words(4, 40)}</p></aside>",
            lambda: f"<form data-y='0'><label>{words(1, 3, '')}</label><input name='q'><button>{words(1, 2, '')}</button></form>"])()

    def article():
        level = rng.choice("112")
        out = [f"<h{level}>{words(3, 10, rng.choice(['', '.', '']))}</h{level}>"] if rng.random() < 0.85 else []
        for _ in range(rng.randint(1, 8)):
            x = rng.random()
            if x < 0.7:
                out.append(f"<p>{words(1 if rng.random() < 0.15 else 8, 80)}</p>")
            elif x < 0.78:
                out.append(f"<h2>{words(1, 6, '')}</h2>")
            elif x < 0.84:
                out.append("<ul>" + "".join(f"<li>{words(2, 20)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif x < 0.88:
                out.append(f"<blockquote>{words(5, 40)}</blockquote>")
            elif x < 0.90:
                out.append(f"<ul>{''.join(f'<li><a href=/{word()}>{words(1, 6, rng.choice(list(("", "."))))}</a></li>' for _ in range(rng.randint(1, 6)))}</ul>")
            elif x < 0.92:
                out.append(f"<{rng.choice(['div', 'section'])} class='{word()}'><p>{words(8, 80)}</p><p>{words(8, 80)}</p>")
                out[-1] += f"</{out[-1][1:].split(' ')[0]}>"
            elif x < 0.94:
                out.append(f"<p>{words(3, 20, '')} <a href='/x'>{words(1, 4, '')}</a> {words(3, 30)}</p>")
            else:
                out.append(rng.choice([furniture, by_tag])())
        return "".join(out)

    kind = rng.random()
    inner = article()
    if kind < 0.45:
        body = f"<article data-y='1'>{inner}</article>"
    elif kind < 0.6:
        body = f"<main data-y='1'>{inner}</main>"
    elif kind < 0.9:
        body = f"<div {rng.choice(['class', 'id'])}='{rng.choice(ARTICLE_NAMES)}{rng.choice(['', '-body', '-text', ' full'])}' data-y='1'>{inner}</div>"
    else:
        body = f"<div data-y='1'>{inner}</div>"
    def unseen():
        return furniture(False)

    # an article that nothing marks has only listed names and threads beside it
    plain = [furniture] if kind >= 0.9 else [furniture, unseen]
    before = "".join(rng.choice([*plain, by_tag])() for _ in range(rng.randint(0, 3)))
    after = "".join(rng.choice([*plain, by_tag, thread])() for _ in range(rng.randint(0, 3)))
    head = f"<header data-y='0'><div>{words(1, 4, '')}</div>{links(rng.randint(0, 4))}</header>" if rng.random() < 0.4 else ""
    foot = f"<footer data-y='0'>&copy; {words(1, 6)} {words(2, 14)}</footer>" if rng.random() < 0.7 else ""
    return f"<html><head><title data-y='0'>{words(2, 9, '')}</title></head><body>{head}{before}{body}{after}{foot}</body></html>"


def _templates(n: int) -> list[tuple[list[list[str]], list[int]]]:
    rng = random.Random(7)
    out = []
    for _ in range(n):
        page = blocks(template_page(rng))
        out.append((features(page), [int(b.label == "1") for b in page]))
    return out


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = 120, rate: float = 0.15, l2: float = 1e-3) -> Model:
    """Maximum conditional likelihood by Adam; forward and backward passes run over all pages at once."""
    # longest first, so that the blocks at one position are those of the first pages; arrays have a row for each block
    pages = sorted(((f, y) for f, y in pages if f), key=lambda p: -len(p[0]))
    if not pages:
        return Model({}, np.zeros((2, 2)))
    index: dict[str, int] = {}
    n = len(pages)
    length = np.array([len(f) for f, _ in pages])
    many = [int(np.searchsorted(-length, -t, side="left")) for t in range(length[0])]     # pages that have position t
    start = np.concatenate([[0], np.cumsum(many)])
    size = int(start[-1])
    at, row = [], []
    y = np.zeros(size, np.int64)
    for i, (f, labels) in enumerate(pages):
        y[start[:len(labels)] + i] = labels
        for t, names in enumerate(f):
            for x in names:
                at.append(index.setdefault(x, len(index)))
                row.append(start[t] + i)
    at, row = np.array(at), np.array(row)
    page = np.concatenate([np.arange(k) for k in many])
    cur = np.arange(many[0], size)
    prev = start[np.repeat(np.arange(len(many) - 1), many[1:])] + page[cur]
    last = start[length - 1] + np.arange(n)
    p = np.zeros(len(index) + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    want_moves = np.array([[((y[prev] == a) & (y[cur] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    for step in range(1, steps + 1):
        e = np.bincount(row, p[at], minlength=size)
        e = np.stack([np.zeros_like(e), e], axis=1)
        moves = p[-4:].reshape(2, 2)
        forward, backward = np.zeros((size, 2)), np.zeros((size, 2))
        forward[:many[0]] = e[:many[0]]
        for t in range(1, len(many)):
            f, k = forward[start[t - 1]:], many[t]
            forward[start[t]:start[t + 1]] = np.logaddexp(f[:k, 0, None] + moves[0], f[:k, 1, None] + moves[1]) + e[start[t]:start[t + 1]]
        for t in range(len(many) - 2, -1, -1):
            x = e[start[t + 1]:start[t + 2]] + backward[start[t + 1]:start[t + 2]]
            backward[start[t]:start[t] + many[t + 1]] = np.logaddexp(moves[None, :, 0] + x[:, 0, None], moves[None, :, 1] + x[:, 1, None])
        z = np.logaddexp(forward[last, 0], forward[last, 1])[page]
        g_e = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - z, 0.0)) - y
        g_moves = np.array([[np.exp(np.minimum(forward[prev, a] + moves[a, b] + e[cur, b] + backward[cur, b] - z[cur], 0.0)).sum() for b in (0, 1)] for a in (0, 1)]) - want_moves
        g = np.concatenate([np.bincount(at, g_e[row], minlength=len(index)), g_moves.ravel()]) / n + l2 * p
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model({x: float(p[i]) for x, i in index.items() if abs(p[i]) > 1e-4}, p[-4:].reshape(2, 2))


def fit(pages: DataFrame, sample: int = SAMPLE, templates: int = TEMPLATES) -> Model:
    """Trains on at most ``sample`` pages of the table (smallest hashes of their ids) and ``templates`` made ones."""
    few = pick(pages, "page_id", "html").filter("html is not null").withColumn("h", F.xxhash64(F.lit(9), "page_id")).orderBy("h", "page_id").limit(sample)

    def run(batch: pa.RecordBatch) -> dict:
        out, labels = [], []
        for page in batch.column(1).to_pylist():
            found = blocks(page)
            y = _markup_labels(found)
            out.append(features(found) if y else [])
            labels.append(y or [])
        return {"f": pa.array(out, pa.list_(pa.list_(pa.string()))), "y": pa.array(labels, pa.list_(pa.int32()))}

    rows = per_batch(few, run, "f array<array<string>>, y array<int>").collect()   # at most ``sample`` pages
    return train([(r["f"], r["y"]) for r in rows if r["y"]] + _templates(templates))


def extracted(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row: the main text of the whole page. A null or empty page
    has the empty text; repeated rows give the same text; an empty table gives no rows."""
    shared = pages.sparkSession.sparkContext.broadcast(model)   # bounded by the training pages
    arrow_limits(pages.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(shared.value, p) for p in batch.column(2).to_pylist()]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    rows = pick(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("bigint"))
    return per_batch(rows, run, "page_id bigint, url string, text string, n_chars bigint")
