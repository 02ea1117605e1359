"""Main text of web pages by composite text density.

The page is read into a tree in one pass; scripts, styles, titles, text areas, templates and hidden elements never enter it.
Suspects are elements that are boilerplate by their kind (menus, headers, footers, asides, forms, buttons and the like), by their
role or by a whole class or id. They are cut, unless the text outside all suspects shows that the page itself lies in one: see
`_restored`. Every node then has a density: characters per tag, lowered by the share of characters and tags in links. The container whose children have the largest sum of densities is
the core; the smallest density on its way up to the body is the threshold, and beside the core every subtree on that way counts
whose density reaches it. If the core lies inside an article (else main), that whole element stands for the core; subtrees beside
it count by the threshold as anywhere.

Text is given as blocks: character references decoded, white space inside a block one space, blocks joined by one line end. A
line break inside a block is white space.

Defined cases: a null or empty page has an empty text, as has one without text outside boilerplate; tags that are never closed
end with the element around them or the page, and such a suspect may be far wider than meant: of a button, list or drawing only
its own text is cut, other kinds stay if they hold more text than lies outside; ids and urls are passed through, null or repeated; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = re.compile(
    rf"""(?is)<!--.*?(?:-->|\Z)
    |<(script|style|textarea|title)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)
    |<(/?)([a-z][^\s/>]*)({_ATTRIBUTES})>
    |<[!?/][^>]*(?:>|\Z)
    |<[a-z][^<>]*\Z
    |[^<]+
    |<""",
    re.X,
)
_PAIR = re.compile(r"""(?s)([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_UNSEEN = re.compile(r"(?i)display\s*:\s*none")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = frozenset("article body center dd details div dl fieldset figure html main ol section table tbody td tr ul blockquote".split())
_LEFT_OUT = frozenset("nav header footer aside form menu dialog fieldset".split())
#: Kinds whose content is a label, a list of choices or a drawing: they cannot hold a page.
_SMALL = frozenset("button select input option datalist audio video map svg iframe noscript".split())
#: Kinds and roles that servers put around a whole page.
_WRAPPERS = frozenset("form fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_BOILERPLATE = frozenset(
    "ad ads adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice"
    " notification alert popup modal overlay newsletter subscribe subscription sidebar sidebars aside menu nav navbar navigation breadcrumb"
    " breadcrumbs pagination pager toolbar header masthead footer comment comments disqus respond replies share sharing social related"
    " recommended recommendations widget login signup".split()
)
#: Those of _BOILERPLATE that name what is in the element, not where it stands on the page.
_ADDED = frozenset(
    "ad ads adslot advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr newsletter"
    " subscribe subscription comment comments disqus respond replies share sharing social related recommended recommendations".split()
)
#: Words beside those of _BOILERPLATE that leave a class name one of boilerplate.
_PLACES = frozenset("site left right top bottom box bar block list links button buttons section area container wrapper slot unit".split())
_KEPT_WHOLE = frozenset(("html", "body", "article", "main"))
#: A start tag on the left ends an open element on the right, up to the nearest scope.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
_OPTIONAL_ENDS = frozenset("p li dt dd tr td th thead tbody tfoot option html body".split())
#: How many times the text outside all suspects a named suspect must hold to be the page itself.
_ALL_BUT = 10
_SCOPES = frozenset("ul ol dl table html body article main section div".split())


def _attributes(text: str) -> dict[str, str]:
    """Lower-cased names with their values; the first of equal names counts."""
    found: dict[str, str] = {}
    for name, *values in _PAIR.findall(text):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    return found


def _is_hidden(tag: str, attributes: dict[str, str]) -> bool:
    return tag == "template" or tag not in _KEPT_WHOLE and ("hidden" in attributes or _UNSEEN.search(attributes.get("style", "")) is not None)


def _suspicion(tag: str, attributes: dict[str, str]) -> str | None:
    """Why an element may be boilerplate: its kind (small, wrapper or kind), what its name says (added) or where it stands (place).

    A class or id counts if it names boilerplate as a whole: sidebar, site-footer or cookie-notice, not with-sidebar.
    """
    if tag in _SMALL:
        return "small"
    named = None
    if attributes and tag not in _KEPT_WHOLE:
        for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
            words = set(re.split(r"[^a-z0-9]+", token)) - {""}
            if not _BOILERPLATE.isdisjoint(words) and words <= _BOILERPLATE | _PLACES:
                if not _ADDED.isdisjoint(words):
                    return "added"
                named = "place"
    if tag in _LEFT_OUT:
        return "wrapper" if tag in _WRAPPERS else "kind"
    roles = _ROLES.intersection(attributes.get("role", "").lower().split()) if tag not in _KEPT_WHOLE else ()
    if roles:
        return "wrapper" if _WRAPPERS.issuperset(roles) else "kind"
    return named or ("place" if attributes.get("aria-hidden", "").lower() == "true" and tag not in _KEPT_WHOLE else None)


class _Tree:
    """Nodes in page order with their tags, parents and own characters; the text runs with their node and block.

    Hidden elements have no node, but stay on the stack of open elements until they end.
    """

    def __init__(self, page: str):
        self.tags, self.parents, self.chars = ["html"], [-1], [0]
        self.runs: list[tuple[int, int, str]] = []
        self.suspects: dict[int, str] = {}
        self.endless: set[int] = set()
        self.block = 0
        self.open: list[tuple[str, int | None]] = [("html", 0)]
        for token in _TOKEN.finditer(page):
            if token[3] is None:
                if token[0][0] != "<" or token[0] == "<":
                    self._text(token[0])
            elif token[2]:
                self._end(token[3].lower())
            else:
                self._start(token[3].lower(), token[4])
        self._unended(1)
        self._cut()

    def _text(self, text: str) -> None:
        node = self.open[-1][1]
        if node is not None:
            text = html.unescape(text) if "&" in text else text
            self.chars[node] += len(text.strip())
            self.runs.append((node, self.block, text))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in _BLOCKS:
            self.block += 1
            self._close("p", _SCOPES)
        for ended in _ENDS.get(tag, ()):
            self._close(ended, _SCOPES)
        if tag in ("html", "head") or tag == "body" and "body" in self.tags:
            return
        node = self.open[-1][1]
        if node is not None and tag == "br":
            self.runs.append((node, self.block, " "))
        pairs = _attributes(attributes) if attributes else {}
        if node is not None and not _is_hidden(tag, pairs):
            self.tags.append(tag)
            self.parents.append(node)
            self.chars.append(0)
            node = len(self.tags) - 1
            why = _suspicion(tag, pairs)
            if why:
                self.suspects[node] = why
        else:
            node = None
        if tag not in _VOID and not (attributes.endswith("/") and tag not in _BLOCKS):
            self.open.append((tag, node))

    def _end(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.block += 1
        self._close(tag, ())

    def _close(self, tag: str, scopes) -> None:
        """End the innermost open element of this name, unless one of `scopes` lies between."""
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at][0]
            if name == tag:
                self._unended(at + 1)
                del self.open[at:]
                return
            if name in scopes:
                return

    def _unended(self, at: int) -> None:
        """Note the suspects open from `at` on: they end without an end tag of their own."""
        self.endless.update(node for tag, node in self.open[at:] if node in self.suspects and tag not in _OPTIONAL_ENDS)

    def _cut(self) -> None:
        """Leave out the suspects but those that hold the page itself."""
        if not self.suspects:
            return
        n = len(self.tags)
        bare = {s for s in self.endless if self.suspects[s] == "small"}
        for s in bare:
            del self.suspects[s]
        if bare:
            self.runs = [run for run in self.runs if run[0] not in bare]
            for s in bare:
                self.chars[s] = 0
        cut = _restored(self)
        gone = [False] * n
        for node in range(1, n):
            gone[node] = gone[self.parents[node]] or node in cut
        kept = [node for node in range(n) if not gone[node]]
        new = {node: at for at, node in enumerate(kept)} | {-1: -1}
        self.tags, self.chars, self.parents = [self.tags[x] for x in kept], [self.chars[x] for x in kept], [new[self.parents[x]] for x in kept]
        self.runs = [(new[node], block, text) for node, block, text in self.runs if not gone[node]]


def _restored(tree: _Tree) -> set[int]:
    """The suspects to be cut, after those that hold the page itself have been taken out, greatest first.

    A suspect's own text is what lies in it, but in no suspect inside it and in no link. It is held against the text outside all
    suspects. While no article or main with text lies outside, a form, a wrapper or an endless suspect stays with more text than that or
    with an article or main, one named by its place with `_ALL_BUT` times that text or with an article or main, and one named by what is in
    it with `_ALL_BUT` times that text. Beside such an article only a wrapper or an endless suspect of `_ALL_BUT` times the text stays.
    Menus, headers, footers and asides that end where they should never stay. What a suspect that stays holds counts as outside.
    """
    n = len(tree.tags)
    around, linked, inside = [-1] * n, [False] * n, [False] * n
    own, story = {s: 0 for s in tree.suspects} | {-1: 0}, {-1: False}
    for node in range(n):
        up = tree.parents[node]
        if node:
            around[node] = node if node in tree.suspects else around[up]
            linked[node] = linked[up] or tree.tags[node] == "a"
            # An article counts where its text lies: in its own suspect, not in one further inside.
            inside[node] = tree.tags[node] in ("article", "main") or inside[up] and around[node] == around[up]
        if not linked[node]:
            own[around[node]] += tree.chars[node]
        if inside[node] and tree.chars[node]:
            story[around[node]] = True
    cut = set(tree.suspects)
    while True:
        outside, told = own[-1], story[-1]
        stays = []
        for s in cut:
            why, size = tree.suspects[s], own[s]
            if s in tree.endless or why == "wrapper":
                times = _ALL_BUT if told else 1
            elif why == "kind" or why == "small" or told:
                continue
            else:
                times = _ALL_BUT
            holds = not told and story.get(s, False) and why != "added"
            if size and (holds or size > times * outside):
                stays.append((holds, size, s))
        if not stays:
            return cut
        at = max(stays)[2]
        while at > 0:
            if at in cut:
                cut.discard(at)
                own[-1] += own[at]
                story[-1] = story[-1] or story.get(at, False)
            at = tree.parents[at]


def _densities(tree: _Tree) -> list[float]:
    n = len(tree.tags)
    linked = [False] * n
    for node in range(1, n):
        linked[node] = tree.tags[node] == "a" or linked[tree.parents[node]]
    chars, tags = tree.chars[:], [0] * n
    link_chars, link_tags = [c if inside else 0 for c, inside in zip(chars, linked, strict=True)], [int(t == "a") for t in tree.tags]
    for node in range(n - 1, 0, -1):
        up = tree.parents[node]
        chars[up] += chars[node]
        link_chars[up] += link_chars[node]
        link_tags[up] += link_tags[node]
        tags[up] += tags[node] + 1
    all_share = link_chars[0] / max(chars[0], 1)
    out = []
    for c, lc, t, lt in zip(chars, link_chars, tags, link_tags, strict=True):
        if not c:
            out.append(0.0)
            continue
        t = max(t, 1)
        base = math.log(c / max(c - lc, 1) * lc + all_share * c + math.e)
        # The base is moved up by e - 1, so that short runs without links stay finite.
        out.append(c / t * max(math.log(c / max(lc, 1) * t / max(lt, 1)), 0.0) / math.log(max(base, 1.0) + math.e - 1))
    return out


def _chosen(tree: _Tree) -> set[int] | None:
    """Roots of the subtrees that make the main text; None if there is no text."""
    density = _densities(tree)
    sums, below = [0.0] * len(density), [[] for _ in density]
    for node in range(1, len(density)):
        sums[tree.parents[node]] += density[node]
        below[tree.parents[node]].append(node)
    holders = [n for n, tag in enumerate(tree.tags) if tag in _CONTAINERS and density[n] > 0]
    if not holders:
        return {0} if density[0] > 0 or tree.runs else None
    core = max(holders, key=lambda n: (sums[n], n))
    way = [core]
    while way[-1] > 0:
        way.append(tree.parents[way[-1]])
    body = [n for n in way if tree.tags[n] != "html"] or way
    threshold = min(density[n] for n in body)
    articles = [n for n in way if tree.tags[n] == "article"] or [n for n in way if tree.tags[n] == "main"]
    whole = articles[-1] if articles else core
    on_way = set(way)
    return {whole} | {n for up in way[way.index(whole) + 1:] for n in below[up] if n not in on_way and density[n] >= threshold}


def main_text(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    tree = _Tree(page)
    roots = _chosen(tree)
    if roots is None:
        return ""
    inside = [False] * len(tree.tags)
    for node in range(len(inside)):
        inside[node] = node in roots or node > 0 and inside[tree.parents[node]]
    blocks: list[str] = []
    last = None
    parts: list[str] = []
    for node, block, text in [*tree.runs, (-1, -1, "")]:
        if block != last:
            joined = " ".join("".join(parts).split())
            if joined:
                blocks.append(joined)
            parts, last = [], block
        if node >= 0 and inside[node]:
            parts.append(text)
    return "\n".join(blocks)


def extract(pages: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """`keep` columns and the main text of every row."""
    rows = pages.select(*keep, F.col(page).alias("__page"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                texts = pa.array([main_text(x.as_py()) for x in part.column(len(keep))], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], [*keep, "text"])

    return rows.mapInArrow(extracted, f"{kinds}, text string")
