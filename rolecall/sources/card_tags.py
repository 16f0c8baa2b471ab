"""Fields of the cards of HTML pages, for functions that run on Arrow batches.

The tags of many pages are found at once as arrays of byte offsets; no page becomes a
tree. An element is an interval of tags, so descendants are intervals within intervals,
and a selector is a mask over all elements of the batch. Attributes are read once per
distinct tag text. Selectors are the CSS subset that the card profiles use: tag,
``.class``, ``[attr]``, ``[attr=v]``, ``[attr*=v]``, descendants, and commas.
"""

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of pages handled at once (one page at least).
STEP_BYTES = 1 << 20

# Fixed values of HTML: elements without content, and those that a next one of the kind ends.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
ENDED_BY_NEXT = ("p", "li", "option", "tr", "td", "th")
UNSEEN = ("script", "style")

_PART = re.compile(r"^([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:(\*?=)['\"]?([^'\"\]]*)['\"]?)?\]")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_TAG = re.compile(rb"<(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+>")
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")  # as in html.unescape
_NAME = re.compile(r"[^\s/>]*")
_OPEN_VALUE = re.compile(rb"=[^\s\"'>]+/>\Z")  # the slash belongs to a value without quotes
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_NAME_END = np.zeros(256, bool)
_NAME_END[[9, 10, 12, 13, 32, 47, 62]] = True


def compile_profile(profile: dict, single: tuple, multiple: tuple) -> dict:
    """A profile's selectors as chains of compounds, each (tag, classes, attribute tests)."""

    def selector(css):
        return [[compound(text) for text in chain.split()] for chain in css.split(",")]

    def compound(text):
        parts = _PART.findall(text)
        tag = next((p[0] for p in parts if p[0]), None)
        return tag, frozenset(p[1] for p in parts if p[1]), tuple(p[2:] for p in parts if p[2])

    def reading(text):
        css, _, attribute = text.partition(" @")
        return selector(css), attribute or None

    return {
        "cards": [selector(c) for c in profile["cards"]],
        "single": {n: [reading(r) for r in profile.get(n, [])] for n in single},
        "multiple": {n: selector(profile[n]) if n in profile else None for n in multiple},
    }


def _spans(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    ends = np.cumsum(many)
    return np.repeat(first - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)


def _texts(data: np.ndarray, first: np.ndarray, last: np.ndarray, pieces: np.ndarray | None = None) -> pa.Array:
    """The byte ranges as a binary array; with ``pieces`` so many of them are one value."""
    many = last - first
    if (pieces is None or len(pieces) == len(first) == pieces.sum()) and (first[1:] >= last[:-1]).all():
        # every other one of the ranges that cut up the bytes where they lie
        cuts = np.stack([first, last], 1).reshape(-1).astype(np.int32)
        ranges = pa.Array.from_buffers(pa.binary(), max(len(cuts) - 1, 0), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        return ranges.take(pa.array(np.arange(0, len(ranges), 2)))
    ends = np.concatenate([[0], np.cumsum(many)])
    if pieces is not None:
        ends = ends[np.concatenate([[0], np.cumsum(pieces)])]
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[_spans(first, many)])]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def _unescaped(text: str, known: dict[str, str]) -> str:
    """``html.unescape``, which looks a reference up by all its prefixes, with those met before in ``known``."""

    def meaning(found):
        if found[0] not in known:
            known[found[0]] = html.unescape(found[0])
        return known[found[0]]

    return _REFERENCE.sub(meaning, text) if "&" in text else text


@dataclass
class Tags:
    """Markup of some pages in order of place. Elements are the tags that open one."""

    data: np.ndarray
    start: np.ndarray  # first byte of each piece of markup
    stop: np.ndarray  # byte after it
    page: np.ndarray  # of each element
    tag: np.ndarray  # its piece of markup
    begin: np.ndarray  # byte after the opening tag of each element
    end: np.ndarray  # byte after its content
    after: np.ndarray  # first element that is not inside it
    kind: np.ndarray  # number of its tag's text
    attributes: list[dict]  # of each distinct tag text, as written
    shape: np.ndarray  # number of the name and tested attributes of each element
    shapes: list[tuple[str, dict]]
    known: dict  # masks of the compounds asked for

    @staticmethod
    def of(data: np.ndarray, offsets: np.ndarray, tested: dict) -> "Tags":
        raw = data.tobytes()
        start, stop, own, opens, closes = _markup(data, raw, offsets)
        tag = np.flatnonzero(opens | closes)
        first = start[tag] + 1 + closes[tag]
        stops = np.flatnonzero(_NAME_END[data])
        name_end = np.minimum(stops[np.minimum(np.searchsorted(stops, first), max(len(stops) - 1, 0))], own[tag]) if len(tag) else first
        name = pc.dictionary_encode(_texts(data, first, name_end))
        lowered = [n.decode("utf-8", "replace").lower() for n in name.dictionary.to_pylist()]
        known = {n: i for i, n in enumerate(dict.fromkeys(lowered))}
        name = np.array([known[n] for n in lowered], np.int64)[np.asarray(name.indices)] if len(tag) else np.zeros(0, np.int64)
        page = np.searchsorted(offsets, start[tag], "right") - 1
        empty = np.isin(name, [known[n] for n in VOID if n in known])
        opening = opens[tag]
        alone = opening & (empty | (data[np.maximum(own[tag] - 2, 0)] == 47))  # void, or closed at once
        for i in np.flatnonzero(alone & ~empty):
            alone[i] = not _OPEN_VALUE.search(raw, int(first[i]), int(own[tag[i]]))
        seen = opening | ~empty  # closing tags of void elements say nothing
        close_at = _close(tag, page, name, opening, alone, seen, [known[n] for n in ENDED_BY_NEXT if n in known], start, offsets)
        element = np.flatnonzero(opening)
        begin, end = stop[tag[element]], close_at[element]
        after = np.searchsorted(start[tag[element]], np.maximum(end, begin))
        texts = pc.dictionary_encode(_texts(data, first[element], own[tag[element]] - 1))
        attributes, shape, shapes = [], [], {}
        for text in texts.dictionary.to_pylist():
            text = text.decode("utf-8", "replace")
            found = _NAME.match(text)[0]
            of = {k.lower(): v[1:-1] if v[:1] in ("'", '"') else v for k, v in _ATTRIBUTE.findall(text, len(found))}
            attributes.append(of)
            # where only presence is asked for, all values are one
            looks = (found.lower(), *[(a, html.unescape(of[a]) if tested[a] else "") for a in of if a in tested])
            shape.append(shapes.setdefault(looks, len(shapes)))
        kind = np.asarray(texts.indices).astype(np.int64)
        return Tags(
            data, start, stop, page[element], tag[element], begin, end, after, kind, attributes,
            np.array(shape, np.int64)[kind], [(name, dict(of)) for name, *of in shapes], {},
        )

    def matching(self, selector: list) -> np.ndarray:
        """Mask of the elements that a selector matches."""
        out = np.zeros(len(self.page), bool)
        for chain in selector:
            mask = self._fitting(chain[0])
            for compound in chain[1:]:
                mask = self._fitting(compound) & self.inside(mask)
            out |= mask
        return out

    def inside(self, mask: np.ndarray) -> np.ndarray:
        """Elements within an element of ``mask``."""
        outer = np.flatnonzero(mask)
        change = np.zeros(len(mask) + 1, np.int64)
        np.add.at(change, outer + 1, 1)
        np.add.at(change, np.maximum(self.after[outer], outer + 1), -1)
        return np.cumsum(change[:-1]) > 0

    def _fitting(self, compound) -> np.ndarray:
        tag, classes, tests = compound
        if compound not in self.known:
            fits = [
                (not tag or name == tag) and classes <= set(of.get("class", "").split())
                and all(a in of and (operator != "=" or of[a] == v) and (operator != "*=" or v in of[a]) for a, operator, v in tests)
                for name, of in self.shapes
            ]
            self.known[compound] = np.array(fits, bool)[self.shape]
        return self.known[compound]

    def attribute(self, elements: np.ndarray, name: str) -> pa.Array:
        known: dict[str, str] = {}
        return pa.array([_unescaped(self.attributes[k].get(name, ""), known) for k in self.kind[elements].tolist()], pa.string())

    def text(self, elements: np.ndarray) -> pa.Array:
        """Shown texts of elements, blanks folded: what stands between the markup inside them."""
        inner = self.tag[elements] + 1
        end = np.maximum(self.end[elements], self.begin[elements])
        many = np.maximum(np.searchsorted(self.start, end) - inner, 0)
        at = _spans(inner, many)
        last = np.cumsum(many + 1) - 1  # of the pieces of each element
        is_last = np.zeros(len(at) + len(elements), bool)
        is_last[last] = True
        is_first = np.zeros(len(is_last), bool)
        is_first[last - many] = True
        first_byte, last_byte = np.empty(len(is_last), np.int64), np.empty(len(is_last), np.int64)
        first_byte[is_first], first_byte[~is_first] = self.begin[elements], self.stop[at]
        last_byte[is_last], last_byte[~is_last] = end, self.start[at]
        texts = _texts(self.data, first_byte, np.maximum(first_byte, last_byte), many + 1)
        coded = pc.dictionary_encode(texts)
        shown = [t.decode("utf-8", "replace") for t in coded.dictionary.to_pylist()]
        known: dict[str, str] = {}
        shown = [" ".join(_unescaped(t, known).split()) for t in shown]
        return pa.array(shown, pa.string()).take(coded.indices)


def _markup(data: np.ndarray, raw: bytes, offsets: np.ndarray):
    """(start, stop, own, opens, closes) of tags, comments and declarations; ``stop`` of a
    script or style takes its content along, which is not shown and holds no tags, while
    ``own`` is where the tag itself ends."""
    less = np.flatnonzero(data == 60)
    after = np.append(data, np.zeros(2, np.uint8))
    second = after[less + 1]
    opens = _LETTER[second]
    closes = (second == 47) & _LETTER[after[less + 2]]
    other = (second == 33) | (second == 63) | ((second == 47) & ~closes)
    keep = opens | closes | other
    less, opens, closes, other = less[keep], opens[keep], closes[keep], other[keep]
    page_end = offsets[np.searchsorted(offsets, less, "right")]
    more = np.append(np.flatnonzero(data == 62), len(data))
    stop = more[np.searchsorted(more, less)] + 1
    # a tag's first > may stand in a quoted value: then one of the quotes before it is not closed
    quotes = []
    for quote in (34, 39):
        at = np.flatnonzero(data == quote)
        quotes.append(np.searchsorted(at, stop) - np.searchsorted(at, less))
    unsure = opens & ((quotes[0] % 2 == 1) | (quotes[1] % 2 == 1) | (quotes[0] > 0) & (quotes[1] > 0))
    hidden = opens & np.isin((after[less + 1] | 32) * np.int64(256) + (after[less + 2] | 32), [ord(n[0]) * 256 + ord(n[1]) for n in UNSEEN])
    at, own = 0, stop.copy()
    for i in np.flatnonzero(unsure | hidden | other).tolist():
        first, last = int(less[i]), int(page_end[i])
        if first < at or stop[i] > last:  # inside the one before, or open at the end of its page
            stop[i] = max(stop[i], last + 1) if first >= at else first
            continue
        if unsure[i]:
            whole = _TAG.match(raw, first, last)
            own[i] = stop[i] = whole.end() if whole else last + 1
        if hidden[i] and stop[i] <= last:
            stop[i] = _unseen_to(raw, first, int(stop[i]), last)
        elif other[i] and raw.startswith(b"<!--", first):
            found = raw.find(b"-->", first + 4, last)
            stop[i] = found + 3 if found >= 0 else last
        at = int(stop[i])
    whole = (stop <= page_end) & (stop > less)  # what is open at the end of a page is text
    less, stop, own, opens, closes = less[whole], stop[whole], own[whole], opens[whole], closes[whole]
    # markup that begins inside other markup is none
    reach = np.maximum.accumulate(np.concatenate([[0], stop]))[:-1] if len(stop) else stop
    if (less < reach).any():
        good, at = np.zeros(len(less), bool), 0
        for i in range(len(less)):
            if less[i] >= at:
                good[i], at = True, stop[i]
        less, stop, own, opens, closes = less[good], stop[good], own[good], opens[good], closes[good]
    return less, stop, own, opens, closes


def _unseen_to(raw: bytes, first: int, stop: int, last: int) -> int:
    """Where the content of a script or style ends; ``stop`` for another tag."""
    for name in UNSEEN:
        if re.match(rb"<%s[\s/>]" % name.encode(), raw[first : first + len(name) + 2], re.I):
            found = re.compile(rb"</%s[\s/>]" % name.encode(), re.I).search(raw, stop, last)
            return found.start() if found else last
    return stop


def _close(tag, page, name, opening, alone, seen, ended_by_next, start, offsets) -> np.ndarray:
    """The byte at which each opening tag's element ends."""
    at = start[tag]
    out = np.where(opening, at, 0)  # elements that are closed at once have no content
    out[opening] = 0
    nested = np.flatnonzero(seen & ~alone)
    step = np.where(opening[nested], 1, -1)
    depth = np.cumsum(step)
    first = np.searchsorted(page[nested], np.arange(len(offsets)))
    base = np.concatenate([[0], depth])[first[:-1]]
    depth = depth - base[page[nested]] if len(nested) else depth
    level = np.where(step > 0, depth, depth + 1)
    untidy = np.zeros(len(offsets), bool)
    untidy[page[nested][level < 1]] = True
    # in a tidy page the tags of a level are an opening and its closing one by turns
    order = np.lexsort([level, page[nested]])
    own = nested[order]
    group = page[own] * (int(level.max(initial=0)) + 1) + level[order]
    begins = np.concatenate([[True], group[1:] != group[:-1]]) if len(own) else np.zeros(0, bool)
    place = np.arange(len(own)) - np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(own) else np.zeros(0, np.int64)
    even = place % 2 == 0
    untidy[page[own][even != opening[own]]] = True
    pair = np.flatnonzero(even)
    partner = np.minimum(pair + 1, len(own) - 1)
    fits = (pair + 1 < len(own)) & (group[partner] == group[pair]) & (name[own[partner]] == name[own[pair]])
    untidy[page[own[pair]][~fits]] = True
    out[own[pair[fits]]] = at[own[partner[fits]]]
    for kind in ended_by_next:  # one within another of its kind may end it
        outer = np.flatnonzero(opening & ~alone & (name == kind))
        reach = np.maximum.accumulate(out[outer]) if len(outer) else outer
        untidy[page[outer[1:]][at[outer[1:]] < reach[:-1]]] = True
    for p in np.flatnonzero(untidy[:-1]).tolist():
        _close_in_turn(np.flatnonzero(seen & (page == p)), name, opening, alone, at, ended_by_next, int(offsets[p + 1]), out)
    return out


def _close_in_turn(tags, name, opening, alone, at, ended_by_next, end, out) -> None:
    """As browsers do it: a closing tag ends the nearest open element of its name and all
    within, or nothing; what is open at the end of the page ends there."""
    open_: list[int] = []
    many: dict[int, int] = {}  # open elements of each name

    def close(place):
        last = open_.pop()
        out[last] = place
        many[int(name[last])] -= 1
        return last

    for t in tags.tolist():
        kind = int(name[t])
        if opening[t]:
            if kind in ended_by_next and open_ and name[open_[-1]] == kind:
                close(at[t])
            if not alone[t]:
                open_.append(t)
                many[kind] = many.get(kind, 0) + 1
        elif many.get(kind):
            while name[close(at[t])] != kind:
                pass
    for o in open_:
        out[o] = end


def _tested(profile: dict) -> dict[str, bool]:
    """The attributes that the selectors ask for, and whether they ask for values."""
    readings = [r for rs in profile["single"].values() for r, _ in rs]
    selectors = [*profile["cards"], *readings, *filter(None, profile["multiple"].values())]
    out = {"class": True}
    for _, _, tests in (compound for selector in selectors for chain in selector for compound in chain):
        for name, operator, _ in tests:
            out[name] = out.get(name, False) or operator != ""
    return out


def read_cards(pages: pa.Array, site: np.ndarray, profiles: list[dict], single: tuple, multiple: tuple) -> tuple[np.ndarray, np.ndarray, dict]:
    """As ``card_columns``, the fields as lists."""
    row, site, fields = card_columns(pages, site, profiles, single, multiple)
    return row, site, {n: column.to_pylist() for n, column in fields.items()}


def card_columns(pages: pa.Array, site: np.ndarray, profiles: list[dict], single: tuple, multiple: tuple) -> tuple[np.ndarray, np.ndarray, dict]:
    """Cards of all pages: (row of the page, its site, {field: values}). ``site`` gives
    each page its profile's number, -1 for none. On each page the first card selector
    that matches is used; of a single field's readings the first that is not empty."""
    rows = [np.zeros(0, np.int64)]
    fields = {n: [pa.array([], pa.string())] for n in single} | {n: [pa.array([], pa.list_(pa.string()))] for n in multiple}
    for number, profile in enumerate(profiles):  # a site's pages by themselves: its selectors meet no other's tags
        own = np.flatnonzero(site == number)
        for first, tags in _steps(pages.take(pa.array(own)), _tested(profile)):
            cards = _cards(tags, profile["cards"])
            rows.append(own[first + tags.page[cards]])
            for name in single:
                fields[name].append(_single(tags, cards, profile["single"][name]))
            for name in multiple:
                fields[name].append(_multiple(tags, cards, profile["multiple"][name]))
    row = np.concatenate(rows)
    return row, site[row], {n: pa.concat_arrays(columns) for n, columns in fields.items()}


def _steps(pages: pa.Array, tested: dict):
    """(number of the first page, tags) of some pages at a time."""
    pages = pc.fill_null(pages.cast(pa.large_string()), "")
    _, offsets, data = pages.buffers()
    offsets = np.frombuffer(offsets, np.int64)[pages.offset : pages.offset + len(pages) + 1] if len(pages) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(pages):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + STEP_BYTES, "right")) - 1)
        yield first, Tags.of(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], tested)
        first = last


def _cards(tags: Tags, selectors: list) -> np.ndarray:
    done = np.zeros(int(tags.page.max(initial=-1)) + 1, bool)
    found = []
    for selector in selectors:
        mask = tags.matching(selector) & ~done[tags.page]
        found.append(np.flatnonzero(mask))
        done[tags.page[found[-1]]] = True
    return np.sort(np.concatenate(found))


def _single(tags: Tags, cards: np.ndarray, readings: list) -> pa.Array:
    values = pa.nulls(len(cards), pa.string())
    open_ = np.arange(len(cards))
    for selector, attribute in readings:
        matched = np.flatnonzero(tags.matching(selector))
        at = np.searchsorted(matched, cards[open_] + 1)
        has = at < len(matched)
        has[has] = matched[at[has]] < tags.after[cards[open_[has]]]
        elements = matched[at[has]]
        # behind the values so far come those of this reading
        place = np.arange(len(cards))
        place[open_[has]] = len(cards) + np.arange(len(elements))
        found = tags.attribute(elements, attribute) if attribute else tags.text(elements)
        values = pa.concat_arrays([values, found]).take(pa.array(place))
        open_ = np.flatnonzero(np.asarray(pc.fill_null(pc.equal(values, ""), True)))
    return values


def _multiple(tags: Tags, cards: np.ndarray, selector: list | None) -> pa.Array:
    if selector is None:
        return pa.ListArray.from_arrays(pa.array(np.zeros(len(cards) + 1, np.int32)), pa.array([], pa.string()))
    matched = np.flatnonzero(tags.matching(selector))
    a, z = np.searchsorted(matched, cards + 1), np.searchsorted(matched, tags.after[cards])
    many = np.maximum(z - a, 0)
    ends = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), tags.text(matched[_spans(a, many)]))
