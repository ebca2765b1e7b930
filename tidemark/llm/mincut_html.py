"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes a list of text blocks with the open elements around each. A linear classifier over element names, class
and id words, link share, length and punctuation gives each block a cost for either label (a capacity from the source or
to the sink); blocks that follow each other, and more so those of one parent, are joined by smoothness edges. The minimum
cut separates content from boilerplate. Blocks whose own capacity exceeds all their edges together take their side at
once, exactly; a maximum flow by blocking flows settles the rest. Parsing takes time about linear in the page, however
many elements stay open.

Defined cases: null or empty html, or html without text, gives an empty text; broken markup never raises (unclosed
comments, tags and elements of raw text, as scripts, reach to the end; of other unseen elements, as svg or button, only
those with an end tag are left out, before an enclosing block ends); repeated rows repeat; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import common as C

#: Elements of raw text, whose content is never text of the page, reach to their end tag or the end of the page.
#: A `>` within a quoted attribute value ends no tag; a quote that is never closed is an ordinary character.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(script|style|title|iframe|textarea)(?=[\s/>])" + _INSIDE + r">.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)(" + _INSIDE + r")(?:>|\Z)",
    re.S | re.I,
)
#: A numeric reference of more digits than any character has.
_LONG_REFERENCE = re.compile(r"&#(?=[0-9]{20})0*+([0-9]*+)")
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose whole content is not text of the page either, from their start tag to their own end tag.
_UNSEEN = frozenset("noscript template svg math object select button canvas audio video".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SCOPE = frozenset("article aside body div fieldset footer form header html main nav section table td th blockquote".split())
#: What a start tag closes reaches down to one of these that is still open (cells of a table: to one that is no cell).
_LISTS = frozenset("ul ol dl".split())
_CELLS = frozenset("td th".split())
_CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TABLE = frozenset("tr td th".split())
_BLOCK_CLOSES = frozenset(["p"])
#: Costs by element and by words in class, id and role; positive speaks for content.
_BY_NAME = {"article": 4.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -8.0, "form": -9.0, "menu": -8.0, "dialog": -8.0, "fieldset": -6.0, "head": -9.0}
_BY_WORD = {
    **dict.fromkeys("ad ads advert adverts advertisement banner sponsor sponsored promo promotion".split(), -9.0),
    **dict.fromkeys("nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead toolbar pagination pager".split(), -9.0),
    **dict.fromkeys("cookie cookies consent notice popup modal newsletter subscribe subscription signup login".split(), -9.0),
    **dict.fromkeys("comment comments reply replies disqus respond discussion".split(), -9.0),
    **dict.fromkeys("share sharing social related recommended widget copyright legal disclaimer search form tags".split(), -7.0),
    **dict.fromkeys("werbung anzeige anzeigen publicidad publicite pubblicita reklama reclame kommentare comentarios commentaires commenti".split(), -9.0),
    **dict.fromkeys("content article post entry story main body text".split(), 2.0),
}
_ATTR = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_ATTRS = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_UNDISPLAYED = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
#: Words behind one of these in a class name, and words before one of those at its end, tell of the page or of a state.
_ABOUT = frozenset("has have no not without with hide hides show shows is".split())
_STATES = frozenset("open opened closed active visible shown enabled disabled collapsed expanded accepted fixed sticky on off layout".split())
#: Words that only say what kind of box it is, so that the word before tells what is in it.
_BOXES = frozenset("area bar block body box btn button buttons card cell col column container content field group header headline holder icon icons inner input item items layer left link links list label outer overlay panel placeholder posts rail region right row section slot stories text title top unit wrap wrapper zone bottom middle center".split())
#: In an article, a word before another that is no box ("related-work", "search-engines") says little: a part of its cost.
QUALIFIES = 0.3
#: What still counts against an article inside: comments and teasers are often marked up as articles.
_STAYS_BY_NAME = frozenset("nav footer aside menu dialog".split())
_STAYS_BY_WORD = frozenset("comment comments reply replies disqus respond discussion related recommended".split())
#: Smoothness between neighbours: under one parent, else.
SAME_PARENT, NEXT = 1.5, 0.4
#: Capacities up to this are used up.
EPSILON = 1e-9


@dataclass
class Block:
    text: str
    name: str
    parent: int
    hint: float
    linked: int
    in_article: bool


def _class_words(value: str) -> dict[str, bool]:
    """Words of a class, id or role that tell what the element itself is, and whether they name it or qualify another word."""
    out: dict[str, bool] = {}
    for token in value.split():
        words = _WORDS.findall(token)
        if words and words[-1] not in _STATES:
            words = words[: next((i for i, w in enumerate(words) if w in _ABOUT), len(words))]
            names = True
            for w in reversed(words):
                out[w] = names or out.get(w, False)
                names = names and (w in _BOXES or _BY_WORD.get(w, 0.0) < 0)
    return out


def _hidden(attrs: str) -> bool:
    low = attrs.lower()
    if "hidden" not in low and "none" not in low:
        return False
    for m in _ATTRS.finditer(low):
        name, value = m[1], (m[2] or "").strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.strip() == "true") or (name == "style" and _UNDISPLAYED.search(value)):
            return True
    return False


def _hint(name: str, attrs: str, in_article: bool) -> tuple[float, float]:
    """Cost by what the element is, and the part of it that counts against an article inside."""
    score = _BY_NAME.get(name, 0.0)
    stays = score if name in _STAYS_BY_NAME else 0.0
    if name == "header" and not in_article:
        score -= 8.0
    if attrs:
        words: dict[str, bool] = {}
        for m in _ATTR.finditer(attrs):
            for w, names in _class_words(m[1].lower().strip("\"'")).items():
                words[w] = names or words.get(w, False)
        found = [_BY_WORD[w] * (1.0 if names or not in_article else QUALIFIES) for w, names in words.items() if w in _BY_WORD]
        if found and name not in ("html", "body"):
            score += min(found) if min(found) < 0 else max(found)
            if words.keys() & _STAYS_BY_WORD:
                stays += min(found)
        if _hidden(attrs):
            score -= 9.0
    return score, stays


def _capped(m: re.Match) -> str:
    return f"&#{m[1] or 0 if len(m[1]) < 8 else 9999999}"


def blocks(page: str) -> list[Block]:
    """Text blocks in page order; white space inside a block is one space."""
    out: list[Block] = []
    # name, summed hint, number, within an article, what there was before an unseen element, what stays of the hint
    stack: list[tuple[str, float, int, bool, tuple | None, float]] = [("", 0.0, 0, False, None, 0.0)]
    # places in the stack, ascending: by name, of block elements, of scopes, of what stops a search (with and without cells)
    at_name: dict[str, list[int]] = {}
    at_block, at_scope, at_stop, at_hard = [0], [0], [0], [0]
    parts: list[str] = []
    number = linked = links = 0
    at = 0

    def end() -> None:
        nonlocal linked, parts
        if parts:
            text = _SPACE.sub(" ", entities.unescape(_LONG_REFERENCE.sub(_capped, "".join(parts)))).strip()
            if text:
                own = at_block[-1]
                out.append(Block(text, stack[own][0], stack[max(0, own - 1)][2], stack[own][1], linked, stack[own][3]))
            parts = []
        linked = 0

    def pop(i: int) -> None:
        nonlocal links
        for x in stack[i:]:
            links -= x[0] == "a"
            places = at_name[x[0]]
            del places[bisect_left(places, i) :]
        del stack[i:]
        for places in (at_block, at_scope, at_stop, at_hard):
            del places[bisect_left(places, i) :]

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            if links > 0:
                linked += len(piece.strip())
        at = m.end()
        name = m[3]
        if not name:
            continue
        name = name.lower()
        if name in _BLOCKS:
            end()
        elif name == "br":
            parts.append(" ")
        if m[2]:
            i = at_name[name][-1] if at_name.get(name) else 0
            if i and (name in _BLOCKS or name in _UNSEEN or i > at_scope[-1]):
                before = stack[i][4]
                pop(i)
                if before:  # its content goes
                    n_blocks, parts, n_parts, linked = before
                    del out[n_blocks:], parts[n_parts:]
        elif name not in _VOID:
            closes = _CLOSES.get(name, _BLOCK_CLOSES if name in _BLOCKS else ())
            if closes:
                stop = (at_hard if name in _TABLE else at_stop)[-1]
                first = [places[j] for c in closes if (places := at_name.get(c)) and (j := bisect_right(places, stop)) < len(places)]
                if first:
                    pop(min(first))
            if m[4].endswith("/"):
                continue
            number += 1
            top = stack[-1]
            before = (len(out), parts, len(parts), linked) if name in _UNSEEN else None
            hint, stays = _hint(name, m[4], top[3])
            above, kept = top[1], top[5]
            if name == "main" or (name == "article" and not top[3]):  # what wraps the whole page says nothing of its text
                kept = 0.0 if name == "main" else kept
                above = max(above, kept)
            here = len(stack)
            at_name.setdefault(name, []).append(here)
            if name in _BLOCKS:
                at_block.append(here)
            if name in _SCOPE:
                at_scope.append(here)
            if name in _SCOPE or name in _UNSEEN or name in _LISTS:
                at_stop.append(here)
                if name not in _CELLS:
                    at_hard.append(here)
            stack.append((name, above + hint, number, top[3] or name in ("article", "main"), before, kept + stays))
            links += name == "a"
    if at < len(page):
        parts.append(page[at:])
    end()
    return out


def unary(b: Block) -> float:
    """Cost of calling the block boilerplate less that of calling it content."""
    n = len(b.text)
    share = min(1.0, b.linked / n)
    score = b.hint - 0.6 + min(n, 400) / 130 - 5.0 * share * (not b.in_article) - 1.5 * share * b.in_article
    if b.name in ("p", "pre", "blockquote"):
        score += 1.0
    elif b.name in ("h1", "h2", "h3", "h4"):
        score += 0.3
    elif b.name == "li":
        score -= 0.7
    if b.text[-1:] in ".!?:;\"'»”…":
        score += 0.6
    if n < 200 and ("©" in b.text or "all rights reserved" in b.text.lower()):
        score -= 4.0
    return score


def min_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: source side) of least cost: sum of |score| of nodes against their sign, and weights of cut edges."""
    n = len(score)
    score = list(score)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # a node that outweighs its open edges has its label in some least cut
        i = todo.popleft()
        if label[i] is None and abs(score[i]) >= sum(near[i].values()):
            label[i] = score[i] > 0
            for j, w in near[i].items():
                score[j] += w if label[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if not rest:
        return [bool(x) for x in label]
    return _cut_rest(score, near, rest, label)


def _cut_rest(score: list[float], near: list[dict[int, float]], rest: list[int], label: list[bool | None]) -> list[bool]:
    """The nodes without a label by maximum flow: blocking flows over the levels of a breadth-first search."""
    place = {i: k for k, i in enumerate(rest)}
    source, sink = len(rest), len(rest) + 1
    arcs: list[list[int]] = [[] for _ in range(len(rest) + 2)]
    to: list[int] = []
    cap: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        arcs[a].append(len(to))
        arcs[b].append(len(to) + 1)
        to.extend((b, a))
        cap.extend((forth, back))

    for i in rest:
        k = place[i]
        if score[i] > 0:
            join(source, k, score[i], 0.0)
        elif score[i] < 0:
            join(k, sink, -score[i], 0.0)
        for j, w in near[i].items():
            if j > i:
                join(k, place[j], w, w)
    while True:
        level = [-1] * len(arcs)
        level[source] = 0
        queue = deque([source])
        while queue:
            i = queue.popleft()
            for e in arcs[i]:
                if cap[e] > EPSILON and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            break
        left = [0] * len(arcs)  # arcs of a node before this one lead nowhere in this round
        path: list[int] = []
        i = source
        while True:
            if i == sink:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                full = next(k for k, e in enumerate(path) if cap[e] <= EPSILON)
                i = to[path[full] ^ 1]
                del path[full:]
            for k in range(left[i], len(arcs[i])):
                e = arcs[i][k]
                if cap[e] > EPSILON and level[to[e]] == level[i] + 1:
                    left[i] = k
                    path.append(e)
                    i = to[e]
                    break
            else:
                if not path:
                    break
                level[i] = -1
                i = to[path.pop() ^ 1]
    return [bool(x) if x is not None else level[place[i]] >= 0 for i, x in enumerate(label)]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, NEXT))
        if b.parent in last:
            edges.append((last[b.parent], i, SAME_PARENT))
        last[b.parent] = i
    keep = min_cut([unary(b) for b in found], edges)
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html)."""
    C.prepare(pages.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(x) for x in batch.column(2).to_pylist()]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return C.map_arrow(C.only(pages, "page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
