"""HTML extraction: the template of same-host pages from equivalence classes, then its slots."""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.common import mixed, small_batches, stored


# Pages of a host are worked on in groups of about so many bytes.
GROUP_BYTES = 4 << 20
# Html of one task, which works on its groups one after the other.
TASK_BYTES = 16 << 20
# So many large hosts (a name and a number each) are sent to every executor; more are shuffled.
MOST_BROADCAST = 100_000
# A class is frequent if its tokens stand in this share of the host's distinct pages.
SUPPORT = 0.5
# A group first tells of tokens on this share of its pages. What it keeps to itself is rarer there,
# which bounds how often a token can stand on the host.
TOLD = SUPPORT / 2
# Of a slot with more than this share of its text in links, nothing is taken.
LINK_SHARE = 0.5

# Elements without an end tag; elements whose content is never text; elements
# that stand inside a line; elements a start tag of which closes open ones.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
# A new one of these ends an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5"
    " h6 header hr main menu nav ol p pre section table ul".split()
)
# Lists and table cells only close their like up to here.
BARRIER = frozenset("ul ol dl table article section div body".split())
# What start tags close.
CLOSABLE = frozenset({"p"}.union(*CLOSES.values()))
# Elements, roles, and words in classes or ids, of what is not the article.
NOT_MAIN = frozenset("nav aside form menu button select dialog input label footer head".split())
MAIN = frozenset(["article", "main"])
LEAVES = frozenset("p li td th pre blockquote h1 h2 h3 h4 h5 h6".split())
NOT_MAIN_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar"
    .split()
)
NOT_MAIN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo"
    " promotion banner cookie cookies consent gdpr notice notices notification alert popup modal"
    " overlay sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead"
    " topbar share sharing social related recommended comment comments disqus reply replies"
    " respond discussion newsletter subscribe subscription signup login search widget toolbar"
    " pagination pager".split()
)
# Of these words, those of what readers add below an article, which may be longer than it.
READERS_WORDS = frozenset("comment comments disqus reply replies respond discussion".split())
# A class word does not tell of an element with more than this share of the text in question.
MOST = 0.5
# Elements, and words of names such as "has-sidebar", that describe the page around a part.
PAGE = frozenset(["html", "body"])
PAGE_WORDS = frozenset("has with no without".split())

_NOT_ZERO = np.uint64(0x9E3779B97F4A7C15)
_ATTRIBUTES = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    r"|<[!?][^>]*>"
    rf"|<(?P<raw>{'|'.join(sorted(RAW))})\b{_ATTRIBUTES}(?<!/)>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"|</(?P<close>[a-z][a-z0-9:-]*)[^<>]*>?"
    rf"|<(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>{_ATTRIBUTES})>?",
    re.S | re.I,
)
_TELLING = re.compile(r"class|id|role|hidden", re.I)
_ATTRIBUTE = re.compile(
    r"(?:^|\s)(class|id|role|hidden)(?=[\s=/]|$)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I
)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def fingerprint(*texts: str) -> str:
    """16 hexadecimal digits that are the same in every process."""
    return hashlib.blake2b("\0".join(texts).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


class Slot:
    """A path of elements without what only formats a line; equal paths of a group are one slot."""

    __slots__ = ("parent", "label", "depth", "children")

    def __init__(self, parent: Slot | None, label: str):
        self.parent, self.label = parent, label
        self.depth = 0 if parent is None else parent.depth + 1
        self.children: dict[str, Slot] = {}

    def child(self, label: str) -> Slot:
        found = self.children.get(label)
        if found is None:
            found = self.children[label] = Slot(self, label)
        return found


class Node:
    """A path of elements from the page's root; equal paths of a group are one node.

    An element is known by its name and classes. `boilerplate` is what elements and roles tell.
    `told` is the nearest element, from this one upwards, that only a class word tells to be;
    its text decides. `closable` is the nearest one that a start tag may close, or that stops it.
    A node keeps nothing that grows with its depth.
    """

    __slots__ = (
        "parent", "name", "label", "main", "boilerplate", "link", "slot", "children", "print", "told", "above",
        "readers", "closable",
    )

    def __init__(self, parent: Node | None, name: str, attributes: str):
        found = defaultdict(str)
        for attribute, *values in _ATTRIBUTE.findall(attributes):
            found[attribute.lower()] += " " + "".join(values)
        words = {w.lower() for w in _NAME_PART.findall(f"{found['class']} {found['id']}")}
        role = found["role"].strip().lower()
        self.parent, self.name = parent, name
        self.label = " ".join([name, *found["class"].split()])
        self.main = name in MAIN or role in MAIN or parent is not None and parent.main
        aside = name in NOT_MAIN or role in NOT_MAIN_ROLES or "hidden" in found
        told = frozenset() if name in PAGE or words & PAGE_WORDS else words & NOT_MAIN_WORDS
        # The told element above this one, itself left out.
        self.above: Node | None = None if parent is None else parent.told
        self.told: Node | None = self if told else self.above
        self.readers = bool(told & READERS_WORDS)
        # A header is the page's, unless it stands inside the article.
        aside = aside or not self.main and (name == "header" or "header" in words)
        self.boilerplate = aside or parent is not None and parent.boilerplate
        self.link = name == "a" or parent is not None and parent.link
        if parent is None:
            self.slot = Slot(None, "")
        else:
            self.slot = parent.slot if name in INLINE else parent.slot.child(self.label)
        stops = name in CLOSABLE or name in BARRIER
        self.closable: Node | None = self if stops or parent is None else parent.closable
        self.children: dict[tuple, Node] = {}
        path = "" if parent is None else parent.print
        self.print = fingerprint(path, self.label, str((self.main, self.boilerplate, bool(told))))

    def child(self, name: str, attributes: str) -> Node:
        key = (name, attributes if _TELLING.search(attributes) else "")
        node = self.children.get(key)
        if node is None:
            node = Node(self, name, key[1])
            # Ids differ from place to place; what they tell of the role is kept.
            told = (node.label, node.main, node.boilerplate, node.told is node, node.readers)
            node = self.children[key] = self.children.setdefault(told, node)
        return node

    def told_ones(self) -> Iterator[Node]:
        """The elements a class word tells of, from the innermost one outwards."""
        at = self.told
        while at is not None:
            yield at
            at = at.above


Token = Node | tuple[Node, str]


@dataclass
class Chunk:
    """A run of text: its path and block, and its token (None for white space)."""

    path: Node
    block: int  # runs of one block stand in one line
    text: str
    token: Token | None


@dataclass
class Page:
    tokens: list[Token]  # every start tag (its path) and text (path and text), in order
    chunks: list[Chunk]


def parse(source: str, root: Node) -> Page:
    """Tokens and text runs of a page. Broken markup is read as far as it goes.

    Time and memory grow with the page, however deep its elements are nested and whatever end tags
    it lacks or has too many of.
    """
    tokens: list[Token] = []
    chunks: list[Chunk] = []
    node, block, last = root, 0, 0
    open_names: Counter[str] = Counter()

    def take(text: str) -> None:
        bare = text.strip()
        token = (node, bare) if bare else None
        chunks.append(Chunk(node, block, text, token))
        if token:
            tokens.append(token)

    def end(last_one: Node) -> Node:
        """Ends an open element with all that is open inside it."""
        at = node
        while at is not last_one:
            open_names[at.name] -= 1
            at = at.parent
        open_names[at.name] -= 1
        return at.parent

    for m in _TOKEN.finditer(source):
        if m.start() > last:
            take(source[last : m.start()])
        last = m.end()
        kind = m.lastgroup
        if kind == "attributes":
            name = m["name"].lower()
            if name not in INLINE:
                block += 1
                closes = CLOSES.get(name)
                if closes and (over := _ended(node, closes)):
                    node = end(over)
                if name in ENDS_PARAGRAPH and (over := _ended(node, {"p"})):
                    node = end(over)
            inner = node.child(name, m["attributes"])
            tokens.append(inner)
            if name not in VOID and name not in RAW:
                node = inner
                open_names[name] += 1
        elif kind == "close":
            name = m["close"].lower()
            if name not in INLINE:
                block += 1
            # Ends the nearest open element of that name.
            if open_names[name]:
                over = node
                while over.name != name:
                    over = over.parent
                node = end(over)
        elif kind == "raw":
            block += m["raw"].lower() not in INLINE
            tokens.append(node.child(m["raw"].lower(), ""))
        elif kind == "cdata":
            take(entities.escape(m["cdata"]))
    if last < len(source):
        take(source[last:])
    return Page(tokens, chunks)


def _ended(node: Node, names: set[str]) -> Node | None:
    """The nearest open element of one of the names, if none that stops the search is nearer."""
    at = node.closable
    while at.parent is not None:
        if at.name in names:
            return at
        if at.name in BARRIER:
            break
        at = at.parent.closable
    return None


@dataclass(frozen=True)
class Vector:
    """On which pages a token occurs, and how often: sums (exclusive or) over pages of marks of
    the page, and of the page with the number. Equal vectors are equal sums."""

    n_pages: int
    where: int
    numbers: int
    once: bool

    def __add__(self, other: Vector) -> Vector:
        sums = self.where ^ other.where, self.numbers ^ other.numbers
        return Vector(self.n_pages + other.n_pages, *sums, self.once and other.once)


def occurrences(pages: list[Page], marks: list[int]) -> tuple[dict[Token, Vector], Vector]:
    """Each token's vector, and that of all pages. Pages without tokens have no layout and do not
    count."""
    found: dict[Token, Vector] = {}
    every = Vector(0, 0, 0, True)
    for page, mark in zip(pages, marks, strict=True):
        if not page.tokens:
            continue
        counts = Counter(page.tokens)
        # One mark for the page and one for each number of occurrences.
        numbers = [0, *sorted(set(counts.values()) | {1})]
        # Mixing leaves zero as it is, and a mark of zero would not show in a sum.
        seed = np.array([mark], np.int64).view(np.uint64) + np.array(numbers, np.uint64) + _NOT_ZERO
        of = dict(zip(numbers, mixed(mixed(seed)).view(np.int64).tolist(), strict=True))
        every += Vector(1, of[0], of[1], True)
        for token, n in counts.items():
            vector = Vector(1, of[0], of[n], n == 1)
            found[token] = found[token] + vector if token in found else vector
    return found, every


def frequent(vectors: dict, every: Vector) -> dict:
    return {t: v for t, v in vectors.items() if v.n_pages >= SUPPORT * every.n_pages}


def equivalence_classes(pages: list[Page]) -> dict[Vector, list[Token]]:
    """Frequent tokens by their vectors."""
    vectors, every = occurrences(pages, list(range(len(pages))))
    return _classes(frequent(vectors, every))


def _classes(vectors: dict[Token, Vector]) -> dict[Vector, list[Token]]:
    classes = defaultdict(list)
    for token, vector in vectors.items():
        classes[vector].append(token)
    return classes


@dataclass
class Host:
    """Frequent tokens of a host that is dealt into groups, by fingerprint, and all its pages."""

    vectors: dict[str, Vector]
    elements: frozenset[str]  # which of them are start tags
    every: Vector


def token_print(token: Token) -> str:
    return token.print if isinstance(token, Node) else fingerprint(token[0].print, "text", token[1])


@dataclass
class Template:
    """Tokens of the valid classes by the slot they stand in, and the fixed texts."""

    root: list[Token]
    nested: dict[int, list[list[Token]]]
    fixed: frozenset[Token]


def root_vector(vectors: dict, elements) -> Vector | None:
    """Of the classes that occur once on their pages, that of the most start tags.

    So a page without the common layout, or one with an empty body, does not turn the template
    off, and the lines a few near copies share do not pass for one.
    """
    sizes, texts = Counter(), Counter()
    for token, vector in vectors.items():
        if vector.once:
            sizes[vector] += token in elements
            texts[vector] += 1
    return max(sizes, key=lambda v: (sizes[v], v.n_pages, texts[v], v.numbers), default=None)


def deduce(pages: list[Page], host: Host | None = None) -> Template:
    """The template of distinct pages: the class of once-only tokens, others nested in its gaps.

    Vectors are those over all pages of the host: where these pages are one of several groups,
    `host` has them. The root holds the tokens of the largest class that occurs once on its
    pages, at least SUPPORT of the host's, and in one order on all of them. A class is nested if
    all its occurrences on those pages lie in one gap between two root tokens, the same on every
    page; others are not valid. Fixed are the texts of the root's class and of once-only tokens
    on every page, and texts of nested classes on all pages of the root that fill all their
    elements.
    """
    if host is None:
        vectors, every = occurrences(pages, list(range(len(pages))))
        vectors = frequent(vectors, every)
        top = root_vector(vectors, {t for t in vectors if isinstance(t, Node)})
    else:
        every = host.every
        prints = {t: token_print(t) for t in dict.fromkeys(t for p in pages for t in p.tokens)}
        vectors = {t: host.vectors[x] for t, x in prints.items() if x in host.vectors}
        top = root_vector(host.vectors, host.elements)
    classes = _classes(vectors)
    root = classes.pop(top, [])
    fixed = {t for t in root if not isinstance(t, Node)}
    known = set(root)
    orders = {i: o for i, p in enumerate(pages) if (o := [t for t in p.tokens if t in known])}
    for n, order in enumerate(orders.values()):
        if n == 0:
            root = order
        elif order != root:
            # Those that break the order go.
            place = {t: i for i, t in enumerate(order)}
            kept: list[Token] = []
            for token in root:
                if token in place and (not kept or place[kept[-1]] < place[token]):
                    kept.append(token)
            root = kept
    number = {t: i for i, t in enumerate(root)}
    gaps: dict[Token, set[int]] = {t: set() for tokens in classes.values() for t in tokens}
    for i in orders:
        gap = -1
        for token in pages[i].tokens:
            if token in number:
                gap = number[token]
            elif token in gaps:
                gaps[token].add(gap)
    nested: dict[int, list[list[Token]]] = defaultdict(list)
    for vector, tokens in classes.items():
        wide = vector.n_pages == every.n_pages or top is not None and vector.where == top.where
        if wide and vector.once:
            fixed.update(t for t in tokens if not isinstance(t, Node))
        where = set().union(*(gaps[t] for t in tokens))
        if len(where) == 1:
            nested[where.pop()].append(tokens)
            if wide:
                fixed.update(t for t in tokens if not isinstance(t, Node) and t[0] in tokens)
    return Template(root, dict(nested), frozenset(fixed if top is not None else ()))


def fixed_blocks(page: Page, template: Template) -> set[int]:
    """Blocks all texts of which are the template's; a line that differs in a word is not fixed."""
    texts = [c for c in page.chunks if c.token]
    return {c.block for c in texts} - {c.block for c in texts if c.token not in template.fixed}


def own_text(page: Page, fixed: set[int]) -> bool:
    """Whether the page says anything of its own."""
    return any(c.token and not c.path.boilerplate and c.block not in fixed for c in page.chunks)


class Spared:
    """Elements that a class word calls boilerplate and that are not, by the text they hold."""

    def __init__(self):
        self.nodes: set[Node] = set()
        self._outermost: dict[Node, Node | None] = {}

    def add(self, nodes: Iterable[Node]) -> None:
        self.nodes.update(nodes)
        self._outermost.clear()

    def outermost(self, path: Node) -> Node | None:
        """The outermost told element of a path that is not spared."""
        chain = []
        at, found = path.told, None
        while at is not None:
            if at in self._outermost:
                found = self._outermost[at]
                break
            chain.append(at)
            at = at.above
        for node in reversed(chain):
            found = found or (None if node in self.nodes else node)
            self._outermost[node] = found
        return found

    def aside(self, path: Node) -> bool:
        return path.boilerplate or self.outermost(path) is not None


def heard(page: Page, fixed: set[int]) -> Spared:
    """The elements a class word calls boilerplate that are not, by the text they hold.

    Text counts outside boilerplate and fixed lines. An element around <main> is spared. If no
    article is left outside class words, one in them is, if it holds more text than there is
    outside (what readers add: than all else); of several that in the fewest such elements, and
    then the longest. Then an element with MOST of the text is spared, again and again, as one
    may stand in another: of the article's text where there is one, and not what readers add.
    """
    runs = [(c.path, len(c.token[1])) for c in page.chunks if c.token and not c.path.boilerplate and c.block not in fixed]
    spared = Spared()
    inner: dict[Node, Node] = {}  # of each path that is told of, the innermost article
    around: set[Node] = set()
    for path, _ in runs:
        at, steps = path if path.told else None, []
        while at is not None and at.parent is not None and at not in inner:
            steps.append(at)
            if at.name == "main":
                around.update(at.told_ones())
            at = at.parent
        found = inner.get(at, path) if at is not None and at in inner else None
        for node in reversed(steps):
            if node.name in MAIN or node.main and not node.parent.main:
                found = node
            inner[node] = found
    spared.add(around)
    if not any(p.main and spared.outermost(p) is None for p, _ in runs):
        marked: Counter[Node] = Counter()
        outside = 0
        for path, n in runs:
            if spared.outermost(path) is None:
                outside += n
            elif path.main:
                article = inner.get(path)
                if article is not None and article.told is not None:
                    marked[article.told] += n
                else:
                    marked[list(path.told_ones())[-1]] += n
        total = sum(n for _, n in runs)
        enough = {}
        for node, n in marked.items():
            chain = list(node.told_ones())
            # What readers add is marked as articles too: those must outweigh all else.
            if n > (total - n if any(x.readers for x in chain) else outside):
                enough[node] = (-len(chain), n)
        if enough:
            spared.add(max(enough, key=enough.__getitem__).told_ones())
    article = any(p.main and spared.outermost(p) is None for p, _ in runs)
    while True:
        total, held = 0, Counter()
        for path, n in runs:
            if path.main or not article:
                total += n
                held[spared.outermost(path)] += n
        del held[None]
        node, most = max(held.items(), key=lambda x: x[1], default=(None, 0))
        if most <= MOST * total or article and node.readers:
            return spared
        spared.add([node])


@dataclass
class Container:
    """The slot below which the article of an unmarked page lies, and the slots that count."""

    slots: set[Slot]
    within: Slot | None

    def holds(self, slot: Slot, known: dict[Slot, bool]) -> bool:
        """Whether a slot belongs to the article: one that counts, or one of repeated text inside
        the container."""
        if slot in self.slots:
            return True
        chain, at = [], slot
        while at is not None and at is not self.within and at not in known:
            chain.append(at)
            at = at.parent
        found = self.within is not None and (at is self.within or at is not None and known[at])
        for step in chain:
            known[step] = found
        return found


def main_slots(pages: list[Page], fixed: list[set[int]], spared: list[Spared]) -> Container:
    """The slots that hold the article, of pages that do not mark one.

    Slots outside boilerplate count their text that is not fixed. The container of the article
    is followed from the body downwards as long as one child holds most of the text; all slots
    below it belong to the article, unless most of their text is links.
    """
    sizes, links = Counter(), Counter()
    for page, repeated, own in zip(pages, fixed, spared, strict=True):
        for c in page.chunks:
            if c.token and c.block not in repeated and not own.aside(c.path):
                sizes[c.path.slot] += len(c.token[1])
                links[c.path.slot] += len(c.token[1]) * c.path.link
    useful = {s: n for s, n in sizes.items() if links[s] <= LINK_SHARE * n}
    total = sum(useful.values())
    # Text of every slot with all below it, the deepest first.
    held: Counter[Slot] = Counter(useful)
    levels: dict[int, set[Slot]] = defaultdict(set)
    for slot in useful:
        levels[slot.depth].add(slot)
    below: dict[Slot, list[Slot]] = defaultdict(list)
    for depth in range(max(levels, default=0), 0, -1):
        for slot in levels.pop(depth, ()):
            held[slot.parent] += held[slot]
            below[slot.parent].append(slot)
            levels[depth - 1].add(slot.parent)
    roots = levels.get(0, set())
    container = next(iter(roots), None)
    followed = False
    while container is not None:
        best = max(below[container], key=lambda s: (held[s], s.label), default=None)
        # Paragraphs and the like are what a container holds.
        if best is None or held[best] <= 0.7 * total or best.label.split()[0] in LEAVES:
            break
        container, followed = best, True
    chosen, queue = set(), [container] if container is not None else []
    while queue:
        at = queue.pop()
        chosen.add(at)
        queue.extend(below[at])
    return Container({s for s in useful if s in chosen}, container if followed else None)


@dataclass
class Block:
    """A line of an article: its slot, length, and whether it is fixed."""

    slot: Slot
    size: int
    fixed: bool


def frame_blocks(articles: dict[str, dict[int, Block]]) -> dict[str, set[int]]:
    """Of each page the lines inside its article that belong to the template.

    Pages that repeat most of their articles are copies of one another, and what they repeat is
    what they say. Elsewhere a line on every page is frame if its slot has a class of its own and
    holds nothing else, or if it is shorter than all that the pages themselves say in that slot
    (where they say nothing there, in the whole article without headings): a line to share or a
    licence among paragraphs, but not one paragraph of several. A title is never frame. The number
    of pages does not matter; in doubt a line stays.
    """
    own = sum(b.size for blocks in articles.values() for b in blocks.values() if not b.fixed)
    repeated = sum(b.size for blocks in articles.values() for b in blocks.values() if b.fixed)
    if own <= repeated:
        return {source: set() for source in articles}
    shortest: dict[Slot | None, int] = {}
    for blocks in articles.values():
        for b in blocks.values():
            if not b.fixed:
                for slot in (b.slot,) if _heading(b.slot) else (b.slot, None):
                    shortest[slot] = min(b.size, shortest.get(slot, b.size))

    def frame(b: Block) -> bool:
        if not b.fixed or b.slot.label.split()[:1] == ["h1"]:
            return False
        if b.slot in shortest:
            return b.size < shortest[b.slot]
        return " " in b.slot.label or b.size < shortest.get(None, 0)

    return {source: {i for i, b in blocks.items() if frame(b)} for source, blocks in articles.items()}


def _heading(slot: Slot) -> bool:
    return re.match(r"h[1-6]\b", slot.label) is not None


def votes(sources: list[str], marks: list[int], asked: frozenset[str] | None = None) -> list[tuple[str, bool, Vector]]:
    """What a group adds to its host's vectors: fingerprint, whether a start tag, and vector.

    Those of all tokens asked for or, unless some are, of those on TOLD of the group's pages. The
    first row is then that of all pages.
    """
    top = Node(None, "", "")
    pages = {s: (parse(s, top), m) for s, m in zip(sources, marks, strict=True)}
    found, every = occurrences([p for p, _ in pages.values()], [m for _, m in pages.values()])
    rows = [("", False, every)] if asked is None else []
    for token, vector in found.items():
        if asked is not None or vector.n_pages >= TOLD * every.n_pages:
            name = token_print(token)
            if asked is None or name in asked:
                rows.append((name, isinstance(token, Node), vector))
    return rows


def extract_group(sources: list[str], host: Host | None = None) -> list[str]:
    """The main text of each page of a group of one host."""
    top = Node(None, "", "")
    pages = {source: parse(source, top) for source in dict.fromkeys(sources)}
    template = deduce(list(pages.values()), host)
    fixed = {source: fixed_blocks(page, template) for source, page in pages.items()}
    # A page of repeated lines only tells no template from text.
    used = {s: fixed[s] if own_text(page, fixed[s]) else set() for s, page in pages.items()}
    spared = {source: heard(page, used[source]) for source, page in pages.items()}
    marked = {
        source: any(c.token and c.path.main and not spared[source].aside(c.path) for c in page.chunks)
        for source, page in pages.items()
    }
    plain = [source for source in pages if not marked[source]]
    container = main_slots([pages[s] for s in plain], [used[s] for s in plain], [spared[s] for s in plain])
    within: dict[Slot, bool] = {}

    def in_article(source: str, path: Node) -> bool:
        if spared[source].aside(path):
            return False
        return path.main if marked[source] else container.holds(path.slot, within)

    articles: dict[str, dict[int, Block]] = {}
    for source, page in pages.items():
        blocks = articles[source] = {}
        for c in page.chunks:
            if c.token and in_article(source, c.path):
                block = blocks.setdefault(c.block, Block(c.path.slot, 0, c.block in fixed[source]))
                block.size += len(c.token[1])
    frame = frame_blocks(articles)

    def lines(source: str) -> str:
        found: list[str] = []
        block = None
        for c in pages[source].chunks:
            if c.block in frame[source] or not in_article(source, c.path):
                continue
            if block != c.block:
                found.append("")
                block = c.block
            found[-1] += entities.unescape(c.text) if "&" in c.text else c.text
        return " ".join("\n".join(found).split())

    texts = {source: lines(source) for source in pages}
    return [texts[s] for s in sources]


def extract(pages: DataFrame, html: str = "html", url: str = "url", page_id: str = "page_id") -> DataFrame:
    """The pages with text (the main text; empty if none) and n_chars, without their html.

    Pages are grouped by host; a host with more than GROUP_BYTES of html is dealt into several
    groups by a hash, so no group grows with the host. Its groups tell the tokens that are common in
    them, Spark adds the counts up, those that may be frequent on the host are counted in the groups
    that did not tell, and all groups get the host's frequent tokens, with counts over all pages. On a host, tokens (start tags and texts with their paths) that occur equally
    often on every page form classes, and valid classes nest into the template. The texts left
    are its slots. Slots in menus, headers, footers, sidebars, notices, adverts, forms and
    comments go, unless only a class word says so and the element holds the article or most of
    the page's text that is not the template's; of the rest, those in the marked article or main element stay, or, on pages
    that mark none, those of the container with most of the text. Lines of the template inside
    the article go as `frame_blocks` tells, by what the pages themselves say beside them.

    Null html is empty and gives an empty text; a null url is a host of its own. Repeated rows
    give equal texts; an empty table gives no rows. Input columns named text or n_chars are
    replaced.
    """
    small_batches(pages.sparkSession)
    out = ("text", "n_chars")
    kept = [f for f in pages.schema.fields if f.name != html and f.name.lower() not in out]
    inner = {f.name: f"own_{i}" for i, f in enumerate(kept)}
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))
    dealt = pages.select(
        *[F.col(f"`{c}`").alias(n) for c, n in inner.items()],
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
        host.alias("host"),
        F.xxhash64(*[F.col(f"`{c}`") for c in pages.columns]).alias("mark"),
        F.xxhash64(F.coalesce(F.col(html).cast("string"), F.lit(""))).alias("page"),
    )
    # Copies of a page meet in one group and count once; those of crowded pages are dealt by row.
    kinds = stored(
        dealt.groupBy("host", "page").agg(
            F.sum(F.octet_length("html")).alias("bytes"), F.count(F.lit(1)).alias("n")
        )
    )
    large = stored(
        kinds.groupBy("host")
        .agg(F.sum("bytes").alias("bytes"))
        .filter(F.col("bytes") > GROUP_BYTES)
        .select("host", F.ceil(F.col("bytes") / GROUP_BYTES).alias("parts"))
    )
    crowded = stored(
        kinds.filter((F.col("n") > 1) & (F.col("bytes") > GROUP_BYTES // 4))
        .select("host", "page", F.lit(True).alias("crowded"))
    )
    few = large.count() <= MOST_BROADCAST and crowded.count() <= MOST_BROADCAST
    small = F.broadcast if few else lambda frame: frame
    joined = dealt.join(small(large), "host", "left").join(small(crowded), ["host", "page"], "left")
    parts, own = F.coalesce("parts", F.lit(1)), F.col("crowded").isNull()
    grouped = joined.withColumn("part", F.pmod(F.when(own, F.col("page")).otherwise(F.col("mark")), parts))
    # A crowded page counts in one of the groups it may lie in.
    grouped = grouped.withColumn("counts", own | (F.col("part") == F.pmod("page", parts)))
    # As many tasks as keep each at a few groups, however much html there is; the votes and the
    # extraction share the exchange.
    total = kinds.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    grouped = grouped.repartition(max(1, -(-total // TASK_BYTES)), "host", "part")
    names = list(inner.values())
    schema = T.StructType(
        [
            *[T.StructField(inner[f.name], f.dataType) for f in kept],
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    arrow = pages.sparkSession.createDataFrame([], schema).toArrow().schema

    ballot = pa.schema(
        [
            ("host", pa.string()), ("parts", pa.int64()), ("heard", pa.int64()), ("all_pages", pa.int64()),
            ("token", pa.string()), ("element", pa.bool_()), ("n_pages", pa.int64()),
            ("where", pa.int64()), ("numbers", pa.int64()), ("once", pa.bool_()),
        ]
    )
    cast = (
        "host string, parts long, heard long, all_pages long, token string, element boolean, n_pages long,"
        " where long, numbers long, once boolean"
    )

    def cast_votes(host: str, parts: int, heard: int, all_pages: int, rows: list[tuple[str, bool, Vector]]) -> pa.Table:
        columns = [[x] * len(rows) for x in (host, parts, heard, all_pages)]
        columns += [[r[0] for r in rows], [r[1] for r in rows]]
        columns += [[getattr(r[2], c) for r in rows] for c in ("n_pages", "where", "numbers", "once")]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ballot, strict=True)], schema=ballot)

    def vote(group: pa.Table) -> pa.Table:
        """The first round: what is common in the group."""
        host, parts = (group.column(c)[0].as_py() for c in ("host", "parts"))
        group = group.filter(group.column("counts"))
        if parts is None or not len(group):
            return ballot.empty_table()
        rows = votes(group.column("html").to_pylist(), group.column("page").to_pylist())
        return cast_votes(host, parts, rows[0][2].n_pages, 0, rows)

    def recount(group: pa.Table, told: pa.Table) -> pa.Table:
        """The second round: tokens that not all groups told of, in all groups; the first group
        passes the others on."""
        if told.num_rows == 0:
            return ballot.empty_table()
        first = told.column("part")[0].as_py() == 0
        host, parts, all_pages = (told.column(c)[0].as_py() for c in ("host", "parts", "all_pages"))
        tokens = told.column("tokens")[0].as_py()
        rows = [
            (r["token"], r["element"], Vector(r["n_pages"], r["where"], r["numbers"], r["once"]))
            for r in tokens if first and r["heard"] == all_pages
        ]
        asked = frozenset(r["token"] for r in tokens if r["heard"] < all_pages)
        if asked and group.num_rows:
            group = group.filter(group.column("counts"))
            rows += votes(group.column("html").to_pylist(), group.column("page").to_pylist(), asked)
        return cast_votes(host, parts, 0, all_pages, rows)

    def added(ballots: DataFrame) -> DataFrame:
        return ballots.groupBy("host", "token").agg(
            F.max("parts").alias("parts"),
            F.sum("heard").alias("heard"),
            F.max("all_pages").alias("all_pages"),
            F.bool_or("element").alias("element"),
            F.sum("n_pages").alias("n_pages"),
            F.bit_xor("where").alias("where"),
            F.bit_xor("numbers").alias("numbers"),
            F.bool_and("once").alias("once"),
        )

    def for_each_part(counted: DataFrame) -> DataFrame:
        names = ("token", "element", "heard", "n_pages", "where", "numbers", "once")
        return (
            counted.groupBy("host")
            .agg(
                F.max("parts").alias("parts"),
                F.max("all_pages").alias("all_pages"),
                F.collect_list(F.struct(*names)).alias("tokens"),
            )
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        )

    by_part = grouped.groupBy("host", "part")
    # A token that is frequent on the host stands on SUPPORT of its pages at most as counted so
    # far and on less than TOLD of those of the groups that did not tell. So the tokens left are at
    # most 1 / TOLD times those of the host's average page.
    on_host = F.max(F.when(F.col("token") == "", F.col("n_pages"))).over(Window.partitionBy("host"))
    heard = added(by_part.applyInArrow(vote, cast)).withColumn("all_pages", on_host)
    at_most = F.col("n_pages") + TOLD * (F.col("all_pages") - F.col("heard"))
    told = for_each_part(heard.filter(at_most >= SUPPORT * F.col("all_pages")))
    counted = added(by_part.cogroup(told.groupBy("host", "part")).applyInArrow(recount, cast))
    # The frequent tokens of a host are at most 1 / SUPPORT times those of its average page.
    tokens = for_each_part(counted.filter(F.col("n_pages") >= SUPPORT * F.col("all_pages")))

    def work(group: pa.Table, template: pa.Table) -> pa.Table:
        if group.num_rows == 0:
            return arrow.empty_table()
        host = None
        if template.num_rows:
            rows = template.column("tokens")[0].as_py()
            vectors = {r["token"]: Vector(r["n_pages"], r["where"], r["numbers"], r["once"]) for r in rows}
            host = Host(vectors, frozenset(r["token"] for r in rows if r["element"]), vectors.pop(""))
        texts = extract_group(group.column("html").to_pylist(), host)
        columns = [group.column(n) for n in names]
        columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.Table.from_arrays(columns, schema=arrow)

    found = by_part.cogroup(tokens.groupBy("host", "part")).applyInArrow(work, schema)
    return found.select(*[F.col(n).alias(c) for c, n in inner.items()], *out)
