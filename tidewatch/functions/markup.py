"""Linear scan of HTML pages into wanted elements and text nodes.

The scan goes once through a page with a stack of open elements; no pattern backtracks over tags and
nothing recurses, so a page may have any size, any nesting and any damage:

* an end tag closes the nearest open element of its name and all inside it; without one it is ignored;
* elements that are still open at the page's end are closed there; void elements and ``<x/>`` hold nothing;
* comments, declarations, ``script`` and ``style`` hold no text, nor does ``template``; unclosed ones reach to the page's end;
* a tag without its ``>`` ends the page; a ``<`` that opens no tag is text; a quote without its partner is
  part of an unquoted value; the last of repeated attributes counts;
* a text node is the text between two tags or comments, entities decoded, stripped; empty ones are dropped.

The result is linear in the page as well: an element's text is a range of the page's text nodes, so unclosed or
nested elements share them.  What is taken from the elements (rules, orders, limits) is Spark's work.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, functions as F

# ---- fixed values: elements that hold nothing; elements whose content is raw ----
VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr "
                 "basefont bgsound command frame image isindex nextid spacer".split())
RAW = ("script", "style")

_OPEN = re.compile(r"<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<end>/)?(?P<name>[A-Za-z][^\s/>\x00]*+))")
_GAP = re.compile(r"[\s/]*+")
_NAME = re.compile(r"[^\s/>][^\s/>=]*+")
_VALUE = re.compile(r"""\s*+=[\s=]*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+))""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}

ELEMENT = "STRUCT<label: STRING, href: STRING, first: INT, until: INT>"
SCANNED = f"STRUCT<texts: ARRAY<STRING>, elements: ARRAY<{ELEMENT}>, blocks: ARRAY<ARRAY<INT>>, reject: STRING>"


class Selector(NamedTuple):
    """Elements of a tag that have all ``classes`` and lie anywhere within a ``within`` element."""

    label: str
    tag: str
    classes: tuple[str, ...] = ()
    within: str | None = None


def _attributes(page: str, at: int):
    """(attributes, place after the tag's '>' or None if it has none, self-closing)."""
    found = {}
    while True:
        gap = _GAP.match(page, at)
        at = gap.end()
        if at >= len(page):
            return found, None, False
        if page[at] == ">":
            return found, at + 1, gap.group().endswith("/")
        name = _NAME.match(page, at)
        value = _VALUE.match(page, name.end())
        text = next((v for v in value.groups() if v is not None), "") if value else ""
        found[name.group().lower()] = _html.unescape(text)
        at = (value or name).end()


def scan(page: str, wanted: list[Selector], block: Selector | None = None,
         closed_by_next: Iterable[str] = ()) -> tuple[list[str], list[dict], list[list[int]]]:
    """(text nodes, elements, blocks) of a page, in document order.

    An element's text is ``texts[first:until]``.  Without ``block``, all elements of the selectors are listed.  With it, a row
    per block element gives the number of the first element inside it for each selector (-1: none), and only these
    are listed.  A start tag in ``closed_by_next`` closes an open element of its name in the same block (a paragraph
    ends where the next begins)."""
    by_tag: dict[str, list[tuple[int, Selector]]] = {}
    for i, selector in enumerate(wanted):
        by_tag.setdefault(selector.tag, []).append((i, selector))
    texts: list[str] = []
    elements: list[dict] = []
    blocks: list[list[int]] = []
    lacking: list[list[int]] = [[] for _ in wanted]  # open blocks that have no element of the selector yet
    stack: list[tuple[str, list[dict], int]] = []  # name, listed elements, block number
    depth: dict[str, int] = {}
    levels: dict[str, list[int]] = {name: [] for name in closed_by_next}  # places of open elements in the stack
    block_levels: list[int] = [-1]
    pending: list[str] = []

    def flush():
        if pending and not depth.get("template"):
            text = _html.unescape("".join(pending)).strip()
            if text:
                texts.append(text)
        pending.clear()

    def push(name, attributes):
        listed, number = [], -1
        if name in by_tag or block and name == block.tag:
            classes = set(attributes.get("class", "").split())
            for i, selector in by_tag.get(name, ()):
                if classes.issuperset(selector.classes) and (selector.within is None or depth.get(selector.within)) and (not block or lacking[i]):
                    for b in lacking[i]:
                        blocks[b][i] = len(elements)
                    lacking[i].clear()
                    listed.append({"label": selector.label, "href": attributes.get("href"), "first": len(texts), "until": len(texts)})
                    elements.append(listed[-1])
            if block and name == block.tag and classes.issuperset(block.classes):
                number = len(blocks)
                blocks.append([-1] * len(wanted))
                block_levels.append(len(stack))
                for open_blocks in lacking:
                    open_blocks.append(number)
        if name in levels:
            levels[name].append(len(stack))
        stack.append((name, listed, number))
        depth[name] = depth.get(name, 0) + 1

    def pop():
        name, listed, number = stack.pop()
        depth[name] -= 1
        if name in levels:
            levels[name].pop()
        for element in listed:
            element["until"] = len(texts)
        if number >= 0:
            block_levels.pop()
            for open_blocks in lacking:
                if open_blocks and open_blocks[-1] == number:
                    open_blocks.pop()

    def close(name):
        if depth.get(name):
            while stack[-1][0] != name:
                pop()
            pop()

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            pending.append(page[at:])
            break
        pending.append(page[at:tag])
        m = _OPEN.match(page, tag)
        if m is None:
            pending.append("<")
            at = tag + 1
            continue
        flush()
        if m["comment"] or m["other"]:
            mark = "-->" if m["comment"] else ">"
            end = page.find(mark, m.end())
            at = size if end < 0 else end + len(mark)
            continue
        name = m["name"].lower()
        if m["end"]:
            close(name)
            end = page.find(">", m.end())
            at = size if end < 0 else end + 1
            continue
        attributes, after, empty = _attributes(page, m.end())
        if after is None:
            break
        at = after
        if levels.get(name) and levels[name][-1] > block_levels[-1]:
            close(name)
        push(name, attributes)
        if empty or name in VOID:
            pop()
        elif name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else size
    flush()
    while stack:
        pop()
    return texts, elements, blocks


#: Fixed value: characters of pages whose scans are Python objects at one time.
SLICE = 1 << 20


def covered(texts: list[str], elements: list[dict]) -> list[str]:
    """The text nodes that lie in an element; the elements' ranges are moved to these."""
    opened = [0] * (len(texts) + 1)
    for e in elements:
        opened[e["first"]] += 1
        opened[e["until"]] -= 1
    kept, place, depth = [], [], 0
    for text, change in zip(texts, opened):
        depth += change
        place.append(len(kept))
        if depth:
            kept.append(text)
    place.append(len(kept))
    for e in elements:
        e["first"], e["until"] = place[e["first"]], place[e["until"]]
    return kept


def scanned(page: str | Column, wanted: list[Selector], block: Selector | None = None,
            closed_by_next: Iterable[str] = ()) -> Column:
    """The scan of each page as a column (SCANNED) with the texts that lie in its elements.  A batch goes to Arrow in slices, so
    what a worker holds as Python objects has a limit, whatever the batch.  A null or blank page, and one whose scan
    fails, has no texts, elements and blocks but a ``reject`` reason; no page stops the others."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    closed_by_next = sorted(closed_by_next)
    kind = to_arrow_type(_parse_datatype_string(SCANNED))

    @F.arrow_udf(SCANNED)
    def run(pages: pa.Array) -> pa.Array:
        done, out, size = [], [], 0
        for value in pages:
            text, reason = value.as_py(), None
            found: tuple[list, list, list] = ([], [], [])
            if text is None or not text.strip():
                reason = "empty page"
            else:
                try:
                    found = scan(text, wanted, block, closed_by_next)
                except Exception as error:  # noqa: BLE001  one bad page must not stop the others
                    reason = f"{type(error).__name__}: {error}"[:200]
            out.append({"texts": covered(found[0], found[1]), "elements": found[1], "blocks": found[2], "reject": reason})
            size += len(text or "")
            if size >= SLICE:
                done.append(pa.array(out, kind))
                out, size = [], 0
        return pa.concat_arrays([*done, pa.array(out, kind)])

    return run(F.col(page) if isinstance(page, str) else page)


def joined_text(texts: Column, element: Column, characters: int | None = None) -> Column:
    """Text of an element: its nodes without separator.  Nodes are not empty, so the first ``characters`` characters
    lie in as many nodes; without the limit the whole text is built.  Null for a null element."""
    n = element["until"] - element["first"]
    if characters is None:
        return F.array_join(F.slice(texts, element["first"] + 1, n), "")
    return F.substring(F.array_join(F.slice(texts, element["first"] + 1, F.least(n, F.lit(characters))), ""), 1, characters)
