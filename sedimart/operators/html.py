"""HTML pages: timetable lessons and links."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from sedimart.functions.fixed import SLOT_TIMES

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# the parser travels with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LESSON_COLUMNS = "url string, group string, weekday int, num int, start string, end string, odd boolean, even boolean, name string, error string"


class Element:
    """An element of a page: name, attributes, children (elements and texts)."""

    def __init__(self, name: str, attrs: list[tuple[str, str | None]]):
        self.name, self.attrs, self.children = name, attrs, []

    def below(self) -> Iterator[Element]:
        return (e for e, inside in self._walk() if isinstance(e, Element) and inside)

    def _walk(self) -> Iterator[tuple[Element | str, bool]]:
        """What stands below, in order: texts and elements where they begin, elements again where they end (False)."""
        waiting = [(child, True) for child in reversed(self.children)]
        while waiting:
            node, begins = waiting.pop()
            yield node, begins
            if begins and isinstance(node, Element):
                waiting.append((node, False))
                waiting += [(child, True) for child in reversed(node.children)]

    def cells(self, kind: str) -> list[Element]:
        return [e for e in self.below() if e.name == "td" and kind in (dict(e.attrs).get("class") or "").split()]

    def text(self) -> str:
        return "".join(node for node, _ in self._walk() if isinstance(node, str))

    def inside(self) -> str:
        """Markup of what stands below; texts directly below are not escaped."""
        out, depth = [], 0
        for node, begins in self._walk():
            if isinstance(node, str):
                out.append(escape(node, quote=False) if depth else node)
                continue
            depth += 1 if begins else -1
            if begins:
                attrs = "".join(f' {k}="{escape(v or "", quote=False)}"' for k, v in node.attrs)
                out.append(f"<{node.name}{attrs}/>" if node.name in VOID else f"<{node.name}{attrs}>")
            elif node.name not in VOID:
                out.append(f"</{node.name}>")
        return "".join(out)


class PageTree(HTMLParser):
    """Builds the element tree; rows left open hold what follows them."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = Element("", [])
        self.open = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Element(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Element(tag, attrs))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].name == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def _cell_lessons(row: Element) -> list[tuple[str, bool, bool]]:
    """(name, odd, even) of one timetable row."""
    whole, half, parts = row.cells("tditem1"), row.cells("tdsmall1"), row.cells("tdsmall0")
    if not whole and not half:
        raise ValueError("unexpected type of lesson")
    with_time = bool(row.cells("tdtime"))
    odd, even = (True, True) if whole else (with_time, not with_time)
    return [(c.inside(), odd, even) for c in (parts or (whole or half)[:1])]


def page_lessons(page: str) -> list[tuple]:
    """(group, weekday, num, start, end, odd, even, name) rows of one timetable page.

    A day counts once its delimiter row is met, and a slot once the next slot's time is met:
    what follows the last of either is not part of the result, as in the source system.
    """
    bodies = [e for e in PageTree(page).root.below() if e.name == "body"]
    rows = [e for e in bodies[0].below() if e.name == "tr"]
    if len(rows) < 2:
        return []
    nodes = [n for n in rows[1].children if n != "\n"]
    group = ""
    if len(nodes) > 1:
        group = nodes[1] if isinstance(nodes[1], str) else nodes[1].text()
    found, weekday, slots, slot = [], 0, [], []
    for row in (n for n in nodes[3:-1] if isinstance(n, Element)):
        if row.cells("delimiter"):
            for num, slot_rows in enumerate(slots):
                start, end = SLOT_TIMES[num]
                for lesson in slot_rows:
                    for name, odd, even in _cell_lessons(lesson):
                        name = name.replace("\xa0", " ")
                        if name != " ":
                            found.append((group, weekday, num, start, end, odd, even, name))
            weekday, slots, slot = weekday + 1, [], []
            continue
        if slot and row.cells("tdtime"):
            slots.append(slot)
            slot = []
        slot.append(row)
    return found


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in LESSON_COLUMNS.split(", ")]
    for pages in batches:
        out = []
        for url, page in zip(pages["url"], pages["raw_html"]):
            try:
                out += [(url, *row, None) for row in page_lessons(page)]
            except (ValueError, IndexError, TypeError) as problem:
                out.append((url, *[None] * 8, f"{type(problem).__name__}: {problem}"))
        yield pd.DataFrame(out, columns=names)


def html_lessons(pages: DataFrame, on_error: str = "raise") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Lessons of the pages (url, raw_html), one row per lesson; each page is parsed on its own.

    A page of another shape fails the job; with ``on_error="reject"`` the result is
    (lessons, (url, error) of the pages left out).
    """
    parsed = pages.select("url", "raw_html").mapInPandas(_parse_batches, LESSON_COLUMNS)
    failed = F.col("error").isNotNull()
    if on_error == "reject":
        return parsed.filter(~failed).drop("error"), parsed.filter(failed).select("url", "error")
    message = F.concat(F.lit("cannot parse "), F.coalesce("url", F.lit("?")), F.lit(": "), F.col("error"))
    checked = parsed.withColumn("url", F.when(failed, F.raise_error(message)).otherwise(F.col("url")))
    return checked.drop("error")


def page_parts(df: DataFrame, id_col: str, html_col: str, pattern: str, out: str) -> DataFrame:
    """One row per match of a pattern with one group, numbered within its page."""
    found = F.regexp_extract_all(html_col, F.lit(pattern), F.lit(1))
    return df.select(id_col, F.posexplode(found).alias("position", out))
