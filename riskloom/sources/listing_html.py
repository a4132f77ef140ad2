"""Raw fields of the items on one landed listing page.

Only element structure is handled here: which text and attributes belong to
which item. What the fields mean is decided by column expressions.
"""

from __future__ import annotations

from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer keygen menuitem".split()
)
# Elements whose text is not part of what a reader sees.
SILENT = frozenset(["script", "style", "template", "rt", "rp"])

ATTRIBUTES = {
    "fullname": "data-fullname",
    "element_id": "id",
    "promoted": "data-promoted",
    "timestamp": "data-timestamp",
    "subreddit": "data-subreddit",
    "author": "data-author",
    "permalink": "data-permalink",
    "link": "data-url",
}
TEXTS = ("title", "expando_text", "md_text")
# An item that is open gets the texts of all elements in it, those of nested items too. A
# page with more open items than this is refused, so that work and output stay in
# proportion to the page.
MAX_OPEN_ITEMS = 64


class NestedTooDeep(ValueError):
    """A page that opens items within items without end."""


class _Text:
    """Strings below an element, each stripped, empty ones left out."""

    def __init__(self) -> None:
        self.strings: list[str] = []
        self.open = ""

    def add(self, data: str) -> None:
        self.open += data

    def cut(self) -> None:
        string = self.open.strip()
        if string:
            self.strings.append(string)
        self.open = ""


class _Item:
    def __init__(self, attrs: dict[str, str], depth: int) -> None:
        self.depth = depth
        self.raw: dict[str, str | None] = {k: attrs.get(a) for k, a in ATTRIBUTES.items()}
        self.raw["iso_time"] = None
        self.texts: dict[str, _Text] = {}
        self.has_time = False
        self.expando_depth: int | None = None

    def record(self) -> dict[str, str | None]:
        separators = {"title": "", "expando_text": "\n", "md_text": "\n"}
        found = {k: separators[k].join(t.strings) for k, t in self.texts.items()}
        return {**self.raw, **{k: found.get(k) for k in TEXTS}}


class ListingParser(HTMLParser):
    """Collects ``div.thing`` items and the link in ``span.next-button``.

    An end tag closes up to the nearest open element of its name and is
    ignored if there is none.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.open_names: dict[str, int] = {}
        self.items: list[_Item] = []
        self.open_items: list[_Item] = []
        self.open_texts: list[tuple[int, _Text]] = []
        self.silent_depth: int | None = None
        self.next_depth: int | None = None
        self.next_seen = False
        self.next_link_seen = False
        self.next_link: str | None = None

    def _cut(self) -> None:
        for _, text in self.open_texts:
            text.cut()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_starttag(self, tag, attrs):
        self._cut()
        attributes = {k: "" if v is None else v for k, v in attrs}
        classes = attributes.get("class", "").split()
        self.stack.append(tag)
        self.open_names[tag] = self.open_names.get(tag, 0) + 1
        depth = len(self.stack)
        self._within_items(tag, attributes, classes, depth)
        if tag == "div" and "thing" in classes:
            if len(self.open_items) >= MAX_OPEN_ITEMS:
                raise NestedTooDeep(f"more than {MAX_OPEN_ITEMS} items are open at once")
            item = _Item(attributes, depth)
            self.items.append(item)
            self.open_items.append(item)
        if tag == "span" and "next-button" in classes and not self.next_seen:
            self.next_seen, self.next_depth = True, depth
        elif tag == "a" and self.next_depth is not None and not self.next_link_seen:
            self.next_link_seen, self.next_link = True, attributes.get("href")
        if tag in SILENT and self.silent_depth is None:
            self.silent_depth = depth
        if tag in VOID:
            self._pop()

    def _within_items(self, tag, attributes, classes, depth):
        for item in self.open_items:
            if tag == "a" and "title" in classes:
                self._start_text(item, "title", depth)
            elif tag == "time" and not item.has_time:
                item.has_time, item.raw["iso_time"] = True, attributes.get("datetime")
            elif tag == "div":
                if "md" in classes:
                    self._start_text(item, "md_text", depth)
                    if item.expando_depth is not None and item.expando_depth > 0:
                        self._start_text(item, "expando_text", depth)
                if "expando" in classes and item.expando_depth is None:
                    item.expando_depth = depth

    def _start_text(self, item, name, depth):
        if name not in item.texts:
            item.texts[name] = text = _Text()
            self.open_texts.append((depth, text))

    def handle_endtag(self, tag):
        self._cut()
        if not self.open_names.get(tag):
            return
        while self._pop() != tag:
            pass

    def _pop(self) -> str:
        depth, tag = len(self.stack), self.stack.pop()
        self.open_names[tag] -= 1
        self.open_texts = [(d, t) for d, t in self.open_texts if d < depth]
        self.open_items = [i for i in self.open_items if i.depth < depth]
        for item in self.open_items:
            if item.expando_depth == depth:
                item.expando_depth = 0  # closed; a later one does not count
        if self.next_depth == depth:
            self.next_depth = None
        if self.silent_depth == depth:
            self.silent_depth = None
        return tag

    def handle_data(self, data):
        if self.silent_depth is None:
            for _, text in self.open_texts:
                text.add(data)

    def handle_comment(self, data):
        self._cut()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def close(self):
        super().close()
        while self.stack:
            self._cut()
            self._pop()


def parse_listing(html: str) -> dict:
    """``{"next": link or None, "items": [raw fields, ...]}``."""
    parser = ListingParser()
    parser.feed(html)
    parser.close()
    return {"next": parser.next_link, "items": [i.record() for i in parser.items]}
