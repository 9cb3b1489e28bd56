"""Values out of page markup: a page is read once into a flat element table, selectors are tests over it.

Elements are numbered in the order they open, so those below an element are an interval of numbers, as are the
texts below it. Script, style and comments hold no elements. Only the fields asked for leave the reader.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections.abc import Mapping, Sequence
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# elements without an end tag
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# elements whose content is text up to their own end tag
RAW = {"script", "style", "textarea", "title"}
# an open element of the second kind ends where one of the first kind starts
_BLOCKS = [
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
]
ENDS = {"li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ENDS |= {block: {"p"} for block in _BLOCKS}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>""",
    re.DOTALL,
)
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")


@lru_cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE)


class El(NamedTuple):
    """A selector: elements named `tag` (any, without one) for which everything that is given holds.

    `css`: all these words are among its classes; `css_part`: its class text contains this; `ident`: its id; `attrs`:
    (name, value) pairs, equal; `attr_part`: (name, text), contained; `text`: all its text, single-blanked, is this;
    `has`: its text contains this; `own_has`: its own first text does. `holds`: one such element below it,
    `parent_of`: among its children. `within`: below such an element, `child_of`: a child of one, `after`: the first
    such sibling behind one. `first`: only the page's first one.
    """

    tag: str | None = None
    css: str | None = None
    css_part: str | None = None
    ident: str | None = None
    attrs: tuple[tuple[str, str], ...] = ()
    attr_part: tuple[str, str] | None = None
    text: str | None = None
    has: str | None = None
    own_has: str | None = None
    holds: El | None = None
    parent_of: El | None = None
    within: El | None = None
    child_of: El | None = None
    after: El | None = None
    first: bool = False


class Field(NamedTuple):
    """What to take of the elements that a selector finds, in page order.

    `take`: "text", all text of each; "own", its own texts, blank ones left out; "texts", all texts below each, blank
    ones left out; else the name of an attribute, of those that have it.
    """

    select: El
    take: str = "text"


class _Named:
    """What a selector asks of a tag alone, its name and attributes; one for all selectors that ask the same.

    `sign`: text that stands in the tag of every element it fits, unless written with entities.
    """

    def __init__(self, tag: str | None, css: str | None, css_part: str | None, ident: str | None, attrs: tuple, attr_part: tuple | None):
        self.tag, self.css_part, self.ident, self.attrs, self.attr_part = tag, css_part, ident, attrs, attr_part
        self.css = None if css is None else frozenset(css.split())
        self.by_attrs = css is not None or css_part is not None or ident is not None or bool(attrs or attr_part)
        signs = [*(self.css or ()), css_part, ident, *(value for _, value in attrs), attr_part and attr_part[1]]
        self.sign = max((x for x in signs if x), key=len, default="")


_named = lru_cache(4096)(_Named)


class _Ready:
    """A selector as pages use it: equal only to itself, so looked up without hashing what it is nested in."""

    def __init__(self, el: El):
        self.named = _named(el.tag, el.css, el.css_part, el.ident, el.attrs, el.attr_part)
        self.tag, self.text, self.has, self.own_has, self.first = el.tag, el.text, el.has, el.own_has, el.first
        self.holds, self.parent_of, self.within, self.child_of, self.after = (
            x and _ready(x) for x in (el.holds, el.parent_of, el.within, el.child_of, el.after)
        )
        self.by_text = el.text is not None or el.has is not None or el.own_has is not None
        self.by_place = any((el.holds, el.parent_of, el.within, el.child_of))


@lru_cache(4096)
def _ready(el: El) -> _Ready:
    return _Ready(el)


class Page:
    """The element table of a page: per element its tag, attributes, parent, and where its elements and texts end."""

    def __init__(self, html: str):
        self.tags: list[str] = []
        self.raw: list[str] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.text_start: list[int] = []
        self.text_end: list[int] = []
        self.texts: list[str] = []
        self.owner: list[int] = []
        self.by_tag: dict[str, list[int]] = {}
        self.html = html
        self._attrs: dict[int, dict[str, str]] = {}
        self._flat: dict[int, str] = {}
        self._coded: list[int] | None = None
        self._by_name: dict[_Named, Sequence[int]] = {}
        self._found: dict[_Ready, list[int]] = {}
        self._sets: dict[tuple[_Ready, bool], set[int]] = {}
        self._covers: dict[_Ready, tuple[list[int], list[int]]] = {}
        self._read(html)

    def _read(self, html: str) -> None:
        open_, at, n = [-1], 0, len(html)
        # how often a tag is open, and where the last token can start: no search runs to the end in vain
        depth_of: dict[str, int] = {}
        last = max(html.rfind(">"), html.rfind("<!--"))
        # names of the function's own: this loop takes most of the time of a job on pages
        tags, raws, parent, end, by_tag = self.tags, self.raw, self.parent, self.end, self.by_tag
        text_start, text_end, texts, owner = self.text_start, self.text_end, self.texts, self.owner
        element, above, tokens = -1, -1, _TOKEN.finditer(html)

        while at <= last:
            token = next(tokens, None)
            if token is None:
                break
            start, stop = token.span()
            if at < start:
                texts.append(html[at:start])
                owner.append(above)
            at = stop
            slash, tag, raw, slash_, tag_, raw_ = token.groups()
            if not tag:
                if not tag_:
                    continue
                slash, tag, raw = slash_, tag_, raw_
            tag = tag.lower()
            if slash:
                if depth_of.get(tag):
                    closed = ""
                    while closed != tag:
                        closed = tags[above]
                        depth_of[closed] -= 1
                        end[above], text_end[above] = element + 1, len(texts)
                        open_.pop()
                        above = open_[-1]
                continue
            ended = ENDS.get(tag)
            if ended:
                while above >= 0 and (closed := tags[above]) in ended:
                    depth_of[closed] -= 1
                    end[above], text_end[above] = element + 1, len(texts)
                    open_.pop()
                    above = open_[-1]
            element += 1
            before = len(texts)
            tags.append(tag)
            raws.append(raw)
            parent.append(above)
            end.append(element + 1)
            text_start.append(before)
            text_end.append(before)
            if tag in by_tag:
                by_tag[tag].append(element)
            else:
                by_tag[tag] = [element]
            if tag in VOID:
                continue
            if tag in RAW:
                stop = _end_of(tag).search(html, at)
                if tag in ("textarea", "title") and at < stop.start():
                    texts.append(html[at : stop.start()])
                    owner.append(element)
                    text_end[element] = len(texts)
                at = stop.end()
                tokens = _TOKEN.finditer(html, at)
                continue
            open_.append(element)
            above = element
            depth_of[tag] = depth_of.get(tag, 0) + 1
        if at < n:
            texts.append(html[at:])
            owner.append(above)
        for above in open_[1:]:
            end[above], text_end[above] = element + 1, len(texts)

    # ---- of an element -------------------------------------------------------------------------
    def attrs(self, e: int) -> dict[str, str]:
        found = self._attrs.get(e)
        if found is None:
            found = {}
            for name, double, single, bare in _ATTR.findall(self.raw[e]):
                found.setdefault(name.lower(), entities.unescape(double or single or bare))
            self._attrs[e] = found
        return found

    def text_of(self, e: int) -> str:
        return entities.unescape("".join(self.texts[self.text_start[e] : self.text_end[e]]))

    def own(self, e: int) -> list[str]:
        return [self.texts[t] for t in range(self.text_start[e], self.text_end[e]) if self.owner[t] == e]

    def flat(self, e: int) -> str:
        """All its text, single-blanked; kept where no element is below, as such texts together are no more than the page."""
        if self.end[e] > e + 1:
            return " ".join(self.text_of(e).split())
        if e not in self._flat:
            self._flat[e] = " ".join(self.text_of(e).split())
        return self._flat[e]

    def _is_named(self, e: int, el: _Named) -> bool:
        attrs = self.attrs(e)
        css = attrs.get("class", "")
        if el.css is not None and not el.css.issubset(css.split()):
            return False
        if el.css_part is not None and el.css_part not in css:
            return False
        if el.ident is not None and attrs.get("id") != el.ident:
            return False
        if el.attrs and any(attrs.get(name) != value for name, value in el.attrs):
            return False
        return not el.attr_part or el.attr_part[1] in attrs.get(el.attr_part[0], "")

    def _can_be(self, e: int, el: _Named) -> bool:
        return not el.by_attrs or ((el.sign in self.raw[e] or "&" in self.raw[e]) and self._is_named(e, el))

    def _fits(self, e: int, el: _Ready) -> bool:
        """Whether an element that is named as asked fits in the rest."""
        if el.text is not None and self.flat(e) != el.text:
            return False
        if el.has is not None and el.has not in self.text_of(e):
            return False
        if el.own_has is not None and el.own_has not in entities.unescape((self.own(e) or [""])[0]):
            return False
        if not el.by_place:
            return True
        if el.holds:
            below = self._find(el.holds)
            at = bisect_right(below, e)
            if at == len(below) or below[at] >= self.end[e]:
                return False
        if el.parent_of and e not in self._set(el.parent_of, parents=True):
            return False
        if el.within:
            starts, ends = self._cover(el.within)
            at = bisect_left(starts, e)
            # the one that reaches furthest of those that start before
            if not at or ends[at - 1] <= e:
                return False
        return el.child_of is None or self.parent[e] in self._set(el.child_of)

    def _set(self, el: _Ready, parents: bool = False) -> set[int]:
        key = el, parents
        if key not in self._sets:
            self._sets[key] = {self.parent[e] if parents else e for e in self._find(el)}
        return self._sets[key]

    def _cover(self, el: _Ready) -> tuple[list[int], list[int]]:
        if el not in self._covers:
            found = self._find(el)
            self._covers[el] = found, list(accumulate((self.end[e] for e in found), max))
        return self._covers[el]

    # ---- of a page -----------------------------------------------------------------------------
    def _elements_named(self, el: _Named) -> Sequence[int]:
        found = self._by_name.get(el)
        if found is None:
            found = range(len(self.tags)) if el.tag is None else self.by_tag.get(el.tag, ())
            if el.by_attrs and found:
                raw, sign = self.raw, el.sign
                if sign in self.html:
                    can = [e for e in found if sign in raw[e] or "&" in raw[e]]
                else:
                    if self._coded is None:
                        self._coded = [e for e, text in enumerate(raw) if "&" in text]
                    can = [e for e in self._coded if el.tag in (None, self.tags[e])]
                found = [e for e in can if self._is_named(e, el)]
            self._by_name[el] = found
        return found

    def find(self, el: El) -> list[int]:
        """The elements a selector means, in page order; each selector is looked for once."""
        return self._find(_ready(el))

    def _find(self, el: _Ready) -> list[int]:
        found = self._found.get(el)
        if found is None:
            if el.after:
                behind = self._find(el.after)
                found = sorted({x for e in behind for x in self._next(e, el)}) if behind else []
            else:
                found = self._elements_named(el.named)
                found = [e for e in found if self._fits(e, el)] if el.by_text or el.by_place else list(found)
            found = self._found[el] = found[:1] if el.first else found
        return found

    def _next(self, e: int, el: _Ready) -> list[int]:
        behind, above = self.end[e], self.parent[e]
        last = self.end[above] if above >= 0 else len(self.tags)
        named = el.named
        while behind < last:
            if el.tag in (None, self.tags[behind]) and self._can_be(behind, named) and self._fits(behind, el):
                return [behind]
            behind = self.end[behind]
        return []

    def take(self, field: Field) -> list[str]:
        return self._take(_ready(field.select), field.take)

    def _take(self, el: _Ready, take: str) -> list[str]:
        found = self._find(el)
        if not found:
            return []
        if take == "text":
            return [self.text_of(e) for e in found]
        if take == "own":
            return [entities.unescape(t) for e in found for t in self.own(e) if t.strip()]
        if take == "texts":
            # nested finds share their texts: each counts once
            places = sorted({t for e in found for t in range(self.text_start[e], self.text_end[e])})
            return [entities.unescape(self.texts[t]) for t in places if self.texts[t].strip()]
        return [value for e in found if (value := self.attrs(e).get(take)) is not None]


def read_fields(html: Column, fields: Mapping[str, Field]) -> Column:
    """A struct with an `array<string>` per field, empty where nothing is found; one reading of the page for all
    (EXT8, EXT9).

    A null page is an empty one.
    """
    names, wanted = list(fields), list(fields.values())
    kind = f"struct<{','.join(f'`{n}`:array<string>' for n in names)}>"

    @F.arrow_udf(kind)
    def read(pages: pa.Array) -> pa.Array:
        columns: list[list] = [[] for _ in wanted]
        # looked up once for all pages
        parts = [(column, _ready(field.select), field.take) for column, field in zip(columns, wanted)]
        for page in pages:
            table = Page(page.as_py() or "")
            for column, select, take in parts:
                column.append(table._take(select, take))
        return pa.StructArray.from_arrays([pa.array(c, pa.list_(pa.string())) for c in columns], names)

    return read(html)


def elements(html: Column, select: El, take: str = "text") -> Column:
    """One field of a page, as an array (EXT9)."""
    return read_fields(html, {"found": Field(select, take)})["found"]


def with_fields(pages: DataFrame, fields: Mapping[str, Field], *kept: str) -> DataFrame:
    """Columns `kept` of the page table and one column per field; the markup itself goes no further."""
    read = pages.select(*kept, read_fields(F.col("html"), fields).alias("_read"))
    return read.select(*kept, *[F.col("_read")[n].alias(n) for n in fields])


def only(texts: Column) -> Column:
    """The first entry of a field, null without one."""
    return F.try_element_at(texts, F.lit(1))


def without_label(texts: Column, label: str) -> Column:
    """Texts joined, each that holds the label taken out, white space collapsed."""
    named = F.filter(texts, lambda t: t.contains(label))
    rest = F.aggregate(named, F.array_join(texts, " "), lambda acc, t: F.replace(acc, t, F.lit("")))
    return F.trim(F.regexp_replace(rest, r"[\s\p{Z}]+", " "))


def labelled(label: str, css: str = "element_detail") -> Field:
    """The paragraph texts of the blocks of a class in which a span names the label."""
    return Field(El("p", within=El("div", css=css, holds=El("span", own_has=label))), "texts")


def labelled_values(pages: DataFrame, labels: Sequence[str], css: str = "element_detail") -> DataFrame:
    """Values next to labels, one column per label (EXT8).

    A value is the paragraph text of the `<div class=css>` blocks in which a `<span>` names the
    label, without the texts that hold the label itself; blank when the label is absent.
    """
    kept = [c for c in pages.columns if c != "html"]
    read = with_fields(pages, {f"_t{i}": labelled(label, css) for i, label in enumerate(labels)}, *kept)
    return read.select(*kept, *[without_label(F.col(f"_t{i}"), label).alias(label) for i, label in enumerate(labels)])
