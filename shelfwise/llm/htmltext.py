"""HTML main text by wrapper induction over the pages of a host.

1.  Each page is parsed into a tree of block elements (inline markup is text of
    its block).  Neighbouring siblings of the same label fold into one repeated
    node, as a list does in a wrapper; where more than ``WIDEST`` runs of siblings
    are left, labels (but for the numbers in them) of more than ``OFTEN`` siblings
    fold too, and all others keep their own nodes.
2.  Per host the folded trees are aligned by simple tree matching (ordered
    alignment of children with the most matching nodes) and merged into a
    wrapper: one tree whose nodes are slots.  The wrapper is learnt from all shapes
    of the host, ``FAN`` at a time and then the wrappers of these in turn; merging
    keeps the order of both sides, so that every node of every page has its slot.
3.  For every slot all pages of the host are counted by their body: the text of the
    article (else main), else of the page's slots that vary on the host the text in
    the one with the most different text, or a text that hardly varies if it is longer
    than all varying text of the page.  A text that stands in a slot with at least
    1 - ``VARIETY`` of the bodies that show the slot, and these are ``LEAST_PAGES``
    or more, is template; all other texts are content, be they as few as they may.
    So copies of one article under changing menus count once, however many they are.
4.  Menus, headers, footers, asides, forms, adverts, notices and comments may vary
    from page to page; their elements and roles mark them as no part of the
    article whatever the slot says (a form around an ``article`` or ``main`` does
    not).  Class and id words (within an ``article`` those of adverts and reader
    comments) do so only for blocks beside the main text: words on blocks of one
    label that hold half of the text of the articles (else of main, else of the
    page) or more drop nothing, nor do words that would leave no such text.  If a
    page has an ``article`` (or ``main``), its text is what stands in there.

Text: character references decoded, white space inside a block one space,
trimmed, blocks joined by one newline in page order.  Formulas (MathML) are text of
their block; the content of ``object`` and ``template`` is content.  Elements nested more than
``DEEPEST`` deep lose nothing: they stand side by side there, in page order.  Drawings
(``svg``) have no text.  Only an unclosed script or style runs to the page's end.

Defined results: null or empty html, or a page without content, gives an empty
text; a host with few pages has no template slots; null and odd urls share the
host that their text before the path gives (empty if there is none); repeated
pages get equal texts; an empty table gives no row.  Extra columns are not read.
"""

from __future__ import annotations

import html as entities
import itertools
import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .urlfilter import host_of

FAN = 64  # shapes, then partial wrappers of a host, that one task merges
LEAST_PAGES = 5  # different bodies of a host before a slot can be template
VARIETY = 0.2  # at most this share of a template slot's bodies has another text in it
BROADCAST_BYTES = 32 << 20
WIDEST = 100  # from so many runs of siblings on, labels that recur in them fold
OFTEN = 8  # siblings of one label that such a list keeps apart
DEEPEST = 200  # elements nested deeper stand side by side, in page order, in the one at this depth

#: Element names of HTML, and the words that sites mark furniture with.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "iframe")
TO_THE_END = ("script", "style")  # without an end tag they run to the page's end
MATHML = """annotation annotation-xml maction math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded
    mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none
    semantics"""
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby
    s samp small span strike strong sub sup time tt u var wbr""".split()) | frozenset(MATHML.split())
FURNITURE = frozenset("""nav aside footer form button select option menu dialog input fieldset head script style textarea
    title noscript iframe""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                  "toolbar".split())
WORDS = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead topbar ad ads
    adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr
    notice popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
    recommendations comment comments disqus respond reply replies widget widgets pager pagination toolbar skip
    teaser""".split())
INSIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored comment comments disqus
    respond replies""".split())  # what marks furniture within an article too
PARAGRAPH_ENDS = frozenset("""address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr
    main nav ol p pre section table ul figure details center""".split())

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_SVG = re.compile(r"""<(/?)svg(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.I)
_SELF_CLOSED = re.compile(r"""(?:^|[\s"'])/\s*\Z""")
_SPLIT = re.compile(r"[^a-z0-9]+")
_NUMBER = re.compile(r"\d+")
_CAMEL = re.compile(r"([a-z0-9])([A-Z])")


class Node:
    """A block element, or (label ``#``) a run of text in one."""

    __slots__ = ("children", "dropped", "label", "text", "worded")

    def __init__(self, label: str, dropped: bool = False, worded: bool = False):
        self.label, self.dropped, self.worded, self.children, self.text = label, dropped, worded, [], None


def parse(page: str) -> Node:
    """The tree of a page.  Unclosed elements end with their parent; an end tag
    without an open element is ignored.  A form around an article or main is no
    furniture."""
    root = Node("root")
    stack: list[tuple[str, Node, bool]] = [("root", root, False)]  # with what the element itself says of dropping
    opened: Counter = Counter()
    run: list[str] = []
    marked = False
    svgs: dict[int, int] | None = None  # start tags of svg to where the element ends
    endless: set[str] = set()  # raw elements without an end tag in the rest of the page

    def close_run() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            run.clear()
            if text:
                leaf = Node("#", stack[-1][1].dropped)
                leaf.text = text
                if len(stack) > DEEPEST and stack[DEEPEST - 1][1].children[-1] is not stack[-1][1]:
                    # others stand after this element by now: it goes on behind them
                    name, before, own = stack[-1]
                    stack[-1] = name, Node(before.label, before.dropped, before.worded), own
                    stack[DEEPEST - 1][1].children.append(stack[-1][1])
                stack[-1][1].children.append(leaf)

    def pop() -> None:
        opened[stack.pop()[0]] -= 1

    at, size = 0, len(page)
    while at < size:
        low = page.find("<", at)
        if low < 0:
            run.append(page[at:])
            break
        if low > at:
            run.append(page[at:low])
        m = _TAG.match(page, low)
        if not m:
            run.append("&lt;")
            at = low + 1
            continue
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue  # a comment or declaration: the text runs on
        if name in INLINE:
            continue
        if m[1] or m[4]:
            if opened[name] > 0:
                close_run()
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        attributes = m[3] if m[2] else m[6]
        closed = attributes.endswith("/") and _SELF_CLOSED.search(attributes) is not None
        if name == "svg":
            if svgs is None:
                svgs = _svg_ends(page)
            at = svgs.get(low, at)
            continue
        if name in _RAW_END:
            if not closed and name not in endless:
                end = _RAW_END[name].search(page, at)
                if end:
                    at = end.end()
                elif name in TO_THE_END:
                    at = size
                else:
                    endless.add(name)
            continue
        if closed and name in ("object", "template", "noscript"):
            continue
        if name == "br":
            run.append(" ")
            continue
        if name == "img":
            continue
        close_run()
        if name in PARAGRAPH_ENDS and stack[-1][0] == "p":
            pop()
        elif name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
                    "tr": ("tr", "td", "th")}.get(name, (name,))
            while stack[-1][0] in same or (stack[-1][0] == "p" and any(opened[x] > 0 for x in same)):
                pop()
        if name in ("html", "body") and opened[name] > 0:
            continue
        if name in ("article", "main") and opened["form"] > 0:
            gone = False
            for i, (open_name, held, own) in enumerate(stack):
                own = own and open_name != "form"
                gone = held.dropped = gone or own
                stack[i] = open_name, held, own
        label, dropped, worded = _label(name, attributes, {x for x in ("article", "main") if opened[x] > 0})
        node = Node(label, stack[-1][1].dropped or dropped, worded)
        marked |= worded
        stack[min(len(stack), DEEPEST) - 1][1].children.append(node)
        if name not in VOID:
            stack.append((name, node, dropped))
            opened[name] += 1
    close_run()
    if marked:
        _drop_worded(root)
    return root


def _svg_ends(page: str) -> dict[int, int]:
    """Where the svg element of each start tag ends; one without an end tag is empty."""
    ends: dict[int, int] = {}
    opened: list[int] = []
    for m in _SVG.finditer(page):
        if not m[1]:
            if not _SELF_CLOSED.search(m[2]):
                opened.append(m.start())
        elif opened:
            ends[opened.pop()] = m.end()
    return ends


def _drop_worded(root: Node) -> None:
    """Drop the blocks that class or id words mark, but for those that hold the main text."""
    in_order: list[tuple[Node, int]] = []  # nodes with the place of their parent, parents first
    todo = [(root, -1)]
    while todo:
        node, above = todo.pop()
        in_order.append((node, above))
        todo += [(c, len(in_order) - 1) for c in node.children]
    for wanted in ("article", "main", "root"):
        inside = [False] * len(in_order)
        size = [0] * len(in_order)
        for i, (node, above) in enumerate(in_order):
            inside[i] = node.label.split(".")[0] == wanted or above >= 0 and inside[above]
            if node.text and inside[i] and not node.dropped:
                size[i] = len(node.text)
        for i in range(len(in_order) - 1, 0, -1):
            size[in_order[i][1]] += size[i]
        if size[0]:
            break
    else:
        return
    held: Counter = Counter()  # a block inside another of its label counts with that
    names: list[frozenset] = [frozenset()] * len(in_order)
    for i, (node, above) in enumerate(in_order):
        names[i] = names[above] if above >= 0 else frozenset()
        if node.worded and node.label not in names[i]:
            held[node.label] += size[i]
            names[i] |= {node.label}
    gone = [False] * len(in_order)
    for i, (node, above) in enumerate(in_order):
        gone[i] = above >= 0 and gone[above] or node.worded and 2 * held[node.label] < size[0]
    if any(node.text and inside[i] and not node.dropped and not gone[i] for i, (node, _) in enumerate(in_order)):
        for i, (node, _) in enumerate(in_order):
            node.dropped |= gone[i]


def _label(name: str, attributes: str, above: set[str]) -> tuple[str, bool, bool]:
    """The label that alignment compares, whether the element is furniture, and
    whether its class or id words say so."""
    dropped = name in FURNITURE or (name == "header" and not above & {"article", "main"})
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return name, dropped, False
    kept, worded = [], False
    plain = name in ("html", "body", "article", "main")
    marks = INSIDE_WORDS if "article" in above else WORDS
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            words = [w for w in _SPLIT.split(_CAMEL.sub(r"\1 \2", value).lower()) if w]
            worded |= not plain and any(w in marks for w in words)
            if key == "class":
                kept += sorted(set(words))
        elif key == "role":
            dropped |= value.lower() in ROLES
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            dropped = True
        elif key == "style":
            dropped |= "display:none" in value.replace(" ", "").lower()
    return ".".join([name, *kept[:4]]), dropped, worded


# A folded tree is (label, [folded children]); its shape is the same as JSON text.


def fold(node: Node, leaves: list | None = None, path: tuple = ()) -> list:
    """The folded tree; ``leaves`` gets (path in the folded tree, text leaf)."""
    out: list = []
    labels = [child.label for child in node.children]
    wide = sum(a != b for a, b in itertools.pairwise(labels)) >= WIDEST
    names = [_NUMBER.sub("0", label) for label in labels] if wide else labels
    often = {name for name, n in Counter(names).items() if n > OFTEN} if wide else frozenset()
    places: dict[str, int] = {}  # of the labels that fold wherever they stand
    last = None
    for label, name, child in zip(labels, names, node.children, strict=True):
        if name in often:
            new = name not in places
            spot = places.setdefault(name, len(out))
        else:  # only neighbours fold
            new = label != last
            spot = len(out) if new else len(out) - 1
        last = None if name in often else label
        if new:
            out.append([label, []])
        part = out[spot]
        at = (*path, spot)
        if child.label == "#":
            if leaves is not None:
                leaves.append((at, child))
        else:
            own: list = []
            sub = fold(child, own, at)
            if part[1]:
                # members of a repeated node share one subtree: align it with what is there
                moved = merge_children(part[1], sub)
            else:
                part[1] = sub
                moved = None
            if leaves is not None:
                for where, leaf in own:
                    leaves.append((at + (_moved(moved, where[len(at):]) if moved else where[len(at):]), leaf))
    return out


def _moved(moved: list, path: tuple) -> tuple:
    out = []
    for step in path:
        at, moved = moved[step]
        out.append(at)
    return tuple(out)


def _matching(a: list, b: list, memo: dict) -> int:
    """Simple tree matching: the most nodes that pair up in an ordered alignment."""
    if a[0] != b[0]:
        return 0
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + _align(a[1], b[1], memo)[0]
    return memo[key]


def _align(xs: list, ys: list, memo: dict) -> tuple[int, list[tuple[int, int]]]:
    """The best ordered alignment of two lists of subtrees: its size and pairs.

    Only pairs of one label can match: the heaviest chain of pairs that rises in
    both lists, by the best chain up to each place of ``xs`` (a Fenwick tree).
    """
    where: dict[str, list[int]] = {}
    for i, x in enumerate(xs):
        where.setdefault(x[0], []).append(i)
    n = len(xs)
    best: list[tuple[int, int]] = [(0, -1)] * (n + 1)  # weight and last link of the best chain
    links: list[tuple[int, int, int]] = []  # i, j, link before
    top = (0, -1)
    for j, y in enumerate(ys):
        found = []
        for i in where.get(y[0], ()):
            before, k = (0, -1), i
            while k:
                if best[k][0] > before[0]:
                    before = best[k]
                k &= k - 1
            found.append((before[0] + _matching(xs[i], y, memo), i, before[1]))
        for weight, i, link in found:
            links.append((i, j, link))
            here, k = (weight, len(links) - 1), i + 1
            if weight > top[0]:
                top = here
            while k <= n:
                if weight > best[k][0]:
                    best[k] = here
                k += k & -k
    pairs = []
    at = top[1]
    while at >= 0:
        i, j, at = links[at]
        pairs.append((i, j))
    return top[0], pairs[::-1]


def merge_children(into: list, other: list) -> list:
    """Merge ``other``'s children into ``into`` (new nodes go to the end, so that
    paths stay as they are); returns where each child went: [(index, [...])]."""
    pairs = dict((j, i) for i, j in _align(into, other, {})[1])
    moved = []
    for j, node in enumerate(other):
        if j in pairs:
            moved.append((pairs[j], merge_children(into[pairs[j]][1], node[1])))
        else:
            into.append(node)
            moved.append((len(into) - 1, _same(node[1])))
    return moved


def _merged(a: list, b: list) -> list:
    """The shortest wrapper by their best alignment in which both lists of subtrees
    are found in their order."""
    out: list = []
    i = j = 0
    for k, m in _align(a, b, {})[1]:
        out += a[i:k] + b[j:m]
        out.append([a[k][0], _merged(a[k][1], b[m][1])])
        i, j = k + 1, m + 1
    return out + a[i:] + b[j:]


def _same(children: list) -> list:
    return [(i, _same(c[1])) for i, c in enumerate(children)]


def place(wrapper: list, shape: list) -> list:
    """Where each node of a page's shape stands in the wrapper: [(index or -1, [...])]."""
    pairs = dict((j, i) for i, j in _align(wrapper, shape, {})[1])
    return [(pairs[j], place(wrapper[pairs[j]][1], node[1])) if j in pairs else (-1, [])
            for j, node in enumerate(shape)]


def _slot(placed: list, path: tuple) -> str | None:
    out = []
    for step in path:
        at, placed = placed[step] if step < len(placed) else (-1, [])
        if at < 0:
            return None
        out.append(str(at))
    return ".".join(out)


class Wrappers:
    """Alignments of shapes with wrappers, kept by (host, shape) up to a bound."""

    def __init__(self):
        self.kept: dict[tuple[str, str], list] = {}

    def placed(self, host: str, wrapper: list, shape: list) -> list:
        key = host, json.dumps(shape)
        if key not in self.kept:
            if len(self.kept) > 2_000:
                self.kept.clear()
            self.kept[key] = place(wrapper, shape)
        return self.kept[key]


def _shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        counted: Counter = Counter()
        for host, page in zip(pdf["host"], pdf["html"], strict=True):
            counted[host, json.dumps(fold(parse(page)))] += 1
        yield pd.DataFrame([(h, s, n) for (h, s), n in counted.items()], columns=["host", "wrapper", "n"])


def _induce(pdf: pd.DataFrame) -> pd.DataFrame:
    """One wrapper from shapes or partial wrappers of a host, the most frequent first."""
    wrapper: list = []
    for shape in pdf.sort_values(["n", "wrapper"], ascending=[False, True])["wrapper"]:
        wrapper = _merged(wrapper, json.loads(shape))
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(wrapper)], "n": [pdf["n"].sum()]})


def induce(shapes: DataFrame) -> DataFrame:
    """``shapes(host, wrapper, n)`` to one row per host, merged in a tree."""
    while True:
        sizes = shapes.groupBy("host").agg(F.count("*").alias("parts"))
        most = sizes.agg(F.max("parts")).first()[0] or 0
        tasks = F.ceil(F.col("parts") / FAN)
        dealt = joined(shapes, sizes).withColumn("task", F.pmod(F.xxhash64("wrapper"), tasks))
        shapes = written(dealt.select("host", "task", "wrapper", "n").groupBy("host", "task")
                         .applyInPandas(_induce, "host string, wrapper string, n long"), "html-wrappers")
        if most <= FAN:
            return shapes.select("host", "wrapper")


def _by_slot(placed: list, leaves: list) -> dict[str, list[str]]:
    """The texts of the undropped leaves in each slot."""
    texts: dict[str, list[str]] = {}
    for path, leaf in leaves:
        if not leaf.dropped and (slot := _slot(placed, path)) is not None:
            texts.setdefault(slot, []).append(leaf.text)
    return texts


def _digest(texts: list[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(texts).encode("utf-8", "replace")) >> 1


SLOT_TEXTS = "host string, page long, body long, slots array<struct<slot string, value long, size long>>"


def _slot_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per page: digests of its unmarked texts and of its article (null without
    one), and each slot with the digest and length of its text; equal rows once."""
    known, parsed = Wrappers(), {}
    for pdf in batches:
        rows: dict = {}
        for host, page, wrapper in zip(pdf["host"], pdf["html"], pdf["wrapper"], strict=True):
            if not page or wrapper is None:
                continue
            if host not in parsed:
                if len(parsed) > 200:
                    parsed.clear()
                parsed[host] = json.loads(wrapper)
            leaves: list = []
            tree = parse(page)
            placed = known.placed(host, parsed[host], fold(tree, leaves))
            slots = sorted((slot, _digest(t), sum(map(len, t))) for slot, t in _by_slot(placed, leaves).items())
            inside = _articles(tree)
            body = _digest([leaf.text for _, leaf in leaves if id(leaf) in inside]) if inside else None
            if slots:
                own = _digest([f"{slot} {value}" for slot, value, _ in slots])
                rows[host, own, body] = [{"slot": a, "value": b, "size": c} for a, b, c in slots]
        out = pd.DataFrame([(*key, slots) for key, slots in rows.items()], columns=["host", "page", "body", "slots"])
        yield out.astype({"body": "Int64"})


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known, parsed = Wrappers(), {}
    for pdf in batches:
        texts = []
        for host, page, wrapper, template in zip(pdf["host"], pdf["html"], pdf["wrapper"], pdf["template"], strict=True):
            if not page:
                texts.append("")
                continue
            fixed = frozenset(template) if template is not None else frozenset()
            leaves: list = []
            tree = parse(page)
            shape = fold(tree, leaves)
            if fixed:
                if host not in parsed:
                    if len(parsed) > 200:
                        parsed.clear()
                    parsed[host] = json.loads(wrapper)
                placed = known.placed(host, parsed[host], shape)
                drop = {slot for slot, t in _by_slot(placed, leaves).items() if f"{slot} {_digest(t)}" in fixed}
                leaves = [x for x in leaves if _slot(placed, x[0]) not in drop]
            inside = _articles(tree)
            kept = [leaf for _, leaf in leaves if not leaf.dropped]
            if inside:
                kept = [leaf for leaf in kept if id(leaf) in inside]
            texts.append("\n".join(leaf.text for leaf in kept))
        yield pd.DataFrame({"key": pdf["key"], "url": pdf["url"], "text": texts})


def _articles(tree: Node) -> set[int]:
    """The text leaves inside article (else main) elements that have any."""
    for wanted in ("article", "main"):
        found: set[int] = set()
        todo = [(tree, False)]
        while todo:
            node, inside = todo.pop()
            if inside and node.label == "#" and not node.dropped:
                found.add(id(node))
            inside = inside or node.label.split(".")[0] == wanted
            todo += [(c, inside) for c in node.children]
        if found:
            return found
    return set()


def wrappers(pages: DataFrame) -> DataFrame:
    """``pages(host, html)`` to one row per host: wrapper (JSON) and its template slots with their texts."""
    some = pages.where("html IS NOT NULL AND html <> ''")
    shapes = (some.mapInPandas(_shapes, "host string, wrapper string, n long")
              .groupBy("host", "wrapper").agg(F.sum("n").alias("n")))
    induced = induce(written(shapes, "html-shapes"))
    texts = written(joined(some, induced).select("host", "html", "wrapper")
                    .mapInPandas(_slot_texts, SLOT_TEXTS), "html-slots")
    facts = joined(texts, _weights(texts)).withColumn("varying", F.expr(
        "aggregate(slots, 0L, (n, x) -> n + if(weights[x.slot].fixed, 0L, x.size))")).select(
        "host", F.expr("coalesce(body, array_max(transform(slots, x -> struct(if(weights[x.slot].fixed, x.size, varying), "
                       "weights[x.slot].own, x.slot, x.value AS value))).value)").alias("body"),
        F.explode("slots").alias("x"))
    facts = facts.select("host", "body", "x.slot", "x.value").distinct()
    # the bodies of a text, those of the slot, then the slots
    most = (facts.groupBy("host", "slot", "value").agg(F.count("*").alias("bodies"))
            .groupBy("host", "slot").agg(F.max(F.struct("bodies", "value")).alias("top")))
    bodies = facts.select("host", "slot", "body").distinct().groupBy("host", "slot").agg(F.count("*").alias("bodies"))
    template = (most.join(bodies, ["host", "slot"])
                .where((F.col("bodies") >= LEAST_PAGES) & (F.col("top.bodies") >= F.col("bodies") * (1 - VARIETY)))
                .groupBy("host").agg(F.sort_array(F.collect_set(F.concat_ws(" ", "slot", "top.value")))
                                     .alias("template")))  # slots of one wrapper
    return written(induced.join(template, "host", "left"), "html-templates")


def _weights(texts: DataFrame) -> DataFrame:
    """Per host and slot: whether its text hardly varies, and how much different text it has."""
    rows = texts.select("host", "page", F.explode("slots").alias("x")).select("host", "page", "x.*").distinct()
    slots = (rows.groupBy("host", "slot", "value").agg(F.max("size").alias("size"), F.count("*").alias("pages"))
             .groupBy("host", "slot").agg(F.sum("size").alias("own"), F.sum("pages").alias("pages"),
                                          F.max("pages").alias("top")))
    fixed = (F.col("pages") >= LEAST_PAGES) & (F.col("top") >= F.col("pages") * (1 - VARIETY))
    weight = F.struct("slot", F.struct(fixed.alias("fixed"), "own"))
    return slots.groupBy("host").agg(F.map_from_entries(F.collect_list(weight)).alias("weights"))  # slots of one wrapper


def joined(pages: DataFrame, by_host: DataFrame) -> DataFrame:
    """Pages with their host's row: broadcast if that table is small, else an
    ordinary join, whose hot hosts adaptive execution splits."""
    fields = [c for c in by_host.columns if c != "host"]
    size = by_host.agg(F.sum(sum((F.length(F.to_json(F.struct(c))) for c in fields), F.lit(0)))).first()[0] or 0
    return pages.join(F.broadcast(by_host) if size <= BROADCAST_BYTES else by_host, "host", "left")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) of every page."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"),
                        F.col(html).alias("html"))
    known = joined(rows, wrappers(rows.select("host", "html")))
    kind = rows.schema["key"].dataType.simpleString()
    out = known.select("key", "url", "host", "html", "wrapper", "template").mapInPandas(
        _extracted, f"key {kind}, url string, text string")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text")
