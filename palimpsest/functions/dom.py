"""HTML trees on the standard library's tokenizer, and table functions over them.

The builder knows void elements, raw text in scripts and styles, implied end tags and mis-nested closing tags; it is not
a full HTML 5 parser. Table functions take one page a row, so pages are spread as Spark's partitions are.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import quote

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the language and of the pages read: tags, classes, addresses and phrases.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 blockquote pre form hr section article nav footer header".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]), "th": frozenset(["td", "th", "tr", "tbody"]),
    "option": frozenset(["option", "optgroup"]),
}
SCOPE = {"li": frozenset(["ul", "ol"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"]), "option": frozenset(["select"])}
BLOCKS = ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "dt", "dd", "caption", "blockquote")
VERBATIM = ("pre", "code", "script", "style")
CHROME = ("script", "style", "noscript", "iframe", "form", "input", "button", "select", "textarea")
EDIT_LINK = re.compile(r"[?&]cmd=(edit|guiedit|freeze|diff|backup)")
EDIT_IMAGE = re.compile(r"(guiedit|paraedit|edit)\.png")
ATTACHMENT, NEW_PAGE = "plugin=attach", "plugin=newpage"
COMMENTS, COMMENT, COMMENT_FORM, NEW_MARK, LATEST = "pcomment", "pcmt", "pcomment-form", "__plugin_new", "最新の20件"
FOLDED, RULES_NOTICES = "rgn-container", ("板を利用する前にルールを必ずお読みください", "ルールについて")
PROFILE, NAME_HEADING = "プロフィール", "名前"
SOURCE_SCRIPT = re.compile("[ぁ-んァ-ヶ一-龯々〆ヵヶ]")


@dataclass(eq=False)
class Node:
    tag: str  # "" for text, "!" for a comment
    attrs: dict[str, str] = field(default_factory=dict)
    text: str = ""
    children: list[Node] = field(default_factory=list)
    parent: Node | None = None

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.children))

    def find(self, *tags: str, **attrs: str) -> list[Node]:
        return [n for n in self.walk() if n is not self and (not tags or n.tag in tags) and all(v in n.attrs.get(k.rstrip("_"), "").split() for k, v in attrs.items()) and n.tag not in ("", "!")]

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def content(self, gap: str = "") -> str:
        """The text below, each piece stripped where a gap is given."""
        parts = [n.text for n in self.walk() if n.tag == "" and not (n.parent and n.parent.tag in ("script", "style"))]
        return gap.join(p.strip() for p in parts if p.strip()) if gap else "".join(parts)

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def unwrap(self) -> None:
        at = next(i for i, c in enumerate(self.parent.children) if c is self)
        for c in self.children:
            c.parent = self.parent
        self.parent.children[at : at + 1] = self.children

    def put_before(self, other: Node) -> None:
        self.remove()
        at = next(i for i, c in enumerate(other.parent.children) if c is other)
        other.parent.children.insert(at, self)
        self.parent = other.parent

    def put_before_new(self, other: Node) -> None:
        """Put a node that has no place yet before another."""
        at = next(i for i, c in enumerate(other.parent.children) if c is other)
        other.parent.children.insert(at, self)
        self.parent = other.parent

    def append(self, child: Node) -> None:
        child.remove()
        self.children.append(child)
        child.parent = self

    def inner(self) -> str:
        return "".join(c.outer() for c in self.children)

    def outer(self) -> str:
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag == "":
                out.append(n.text if n.parent and n.parent.tag in ("script", "style") else entities.escape(n.text, quote=False))
            elif n.tag == "!":
                out.append(f"<!--{n.text}-->")
            else:
                attrs = "".join(f' {k}="{entities.escape(v)}"' for k, v in n.attrs.items())
                out.append(f"<{n.tag}{attrs}>")
                if n.tag not in VOID:
                    stack.append(f"</{n.tag}>")
                    stack.extend(reversed(n.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")

    def _add(self, node: Node) -> None:
        node.parent = self.at
        self.at.children.append(node)

    def handle_starttag(self, tag, attrs):
        node = self.at
        while node.parent is not None:  # end what this tag ends, up to the element that holds such items
            if tag in CLOSED_BY.get(node.tag, ()):
                self.at = node.parent
            if any(node.tag in SCOPE[t] for t in SCOPE if tag in CLOSED_BY.get(t, ())):
                break
            node = node.parent
        new = Node(tag, {k: v or "" for k, v in attrs})
        self._add(new)
        if tag not in VOID:
            self.at = new

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        if self.at.children and self.at.children[-1].tag == "":
            self.at.children[-1].text += data
        else:
            self._add(Node("", text=data))

    def handle_comment(self, data):
        self._add(Node("!", text=data))


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def body_of(root: Node) -> Node:
    """The element with id ``body``, else the body, else everything."""
    return next((n for n in root.walk() if n.attrs.get("id") == "body"), None) or next(iter(root.find("body")), root)


def is_a(node: Node, tag: str, class_: str | None = None) -> bool:
    return node.tag == tag and (class_ is None or class_ in node.attrs.get("class", "").split())


def within(tag: str, class_: str, test: Callable[[Node], bool]) -> Callable[[Node], bool]:
    return lambda n: test(n) and any(is_a(a, tag, class_) for a in n.ancestors())


def _link(test: Callable[[str, Node], bool]) -> Callable[[Node], bool]:
    return lambda n: n.tag == "a" and "href" in n.attrs and test(n.attrs["href"], n)


def _gone(node: Node) -> list[Node]:
    return []


def _opened(node: Node) -> list[Node]:
    return node.children


def _list_of_comments(form: Node) -> list[Node]:
    return [x for x in form.find("ul")[:1] if x.find("li", class_=COMMENT)]


#: What stands in the place of a node: the first rule whose test holds decides.
Rule = tuple[Callable[[Node], bool], Callable[[Node], list[Node]]]
CLEANING: list[Rule] = [
    (within("div", COMMENTS, lambda n: n.tag == "form"), _list_of_comments),
    (lambda n: n.tag in CHROME or n.tag == "!", _gone),
    (within("div", COMMENTS, lambda n: n.tag == "div" and n.attrs.get("id") == COMMENT_FORM), _gone),
    (within("div", COMMENTS, lambda n: n.tag == "p" and LATEST in n.content()), _gone),
    (within("li", COMMENT, lambda n: is_a(n, "span", NEW_MARK)), _gone),
    (_link(lambda href, n: ATTACHMENT in href and bool(n.find("img"))), _opened),
    (_link(lambda href, n: any(x in href for x in (ATTACHMENT, NEW_PAGE)) or bool(EDIT_LINK.search(href))), _gone),
    (_link(lambda href, n: href.startswith("#") and not n.content().strip() and not n.find("img")), _gone),
    (lambda n: n.tag == "img" and bool(EDIT_IMAGE.search(n.attrs.get("src", ""))), _gone),
]
BOILERPLATE: list[Rule] = [(lambda n: is_a(n, "div", FOLDED) and any(m in n.content(" ") for m in RULES_NOTICES), _gone)]


def rewrite(root: Node, rules: list[Rule]) -> None:
    """Put what the rules say in the place of each node below, and below that again."""
    open_ = [root]
    while open_:
        node = open_.pop()
        waiting, node.children = node.children[::-1], []
        while waiting:
            child = waiting.pop()
            child.parent = node
            make = next((make for test, make in rules if test(child)), None)
            if make is None:
                node.children.append(child)
                open_.append(child)
            else:
                waiting.extend(reversed(make(child)))


# What a link of each kind carries beside its address.
AWAY = {"target": "_blank", "rel": "noopener"}
LINK_MARKS = {"page": ("internal-link", {}), "source": ("source-link", AWAY), "outer": ("", AWAY)}


@dataclass
class LinkRow:
    """A link of a page: its element, what it points at, and the kind of that."""

    at: Node
    kind: str
    address: str


def link_rows(body: Node, name_of: Callable[[str], str | None], slugs: dict[str, str], url_of: Callable[[str], str]) -> list[LinkRow]:
    """Links that change, each with its new address: a page of the site, a page of the source, another site."""
    rows = []
    for a, href in ((a, a.attrs["href"]) for a in body.find("a") if a.attrs.get("href") is not None):
        name, (_, mark, part) = name_of(href), href.partition("#")
        here = None if name is None else slugs.get(name)
        if here:
            rows.append(LinkRow(a, "page", f"__ROUTE__/{quote(here)}.html{mark}{part}"))
        elif name is not None:
            rows.append(LinkRow(a, "source", f"{url_of(name)}{mark}{part}"))
        elif href.startswith("http"):
            rows.append(LinkRow(a, "outer", href))
    return rows


def rewrite_links(body: Node, name_of: Callable[[str], str | None], slugs: dict[str, str], url_of: Callable[[str], str]) -> None:
    """Put each link row's address and its kind's marks back at the link's place."""
    for row in link_rows(body, name_of, slugs, url_of):
        mark, more = LINK_MARKS[row.kind]
        row.at.attrs |= {"href": row.address, **more}
        if mark:
            row.at.attrs["class"] = " ".join(filter(None, [row.at.attrs.get("class"), mark]))


def innermost_blocks(root: Node) -> list[Node]:
    """Blocks that hold no other block, aren't empty and aren't verbatim, in one walk that knows the block around."""
    around, found = set(), []
    below: list[tuple[Node, Node | None, bool]] = [(c, None, False) for c in reversed(root.children)]
    while below:
        node, block, verbatim = below.pop()
        if node.tag in BLOCKS:
            around.add(id(block))
            if not verbatim:
                found.append(node)
            block = node
        verbatim = verbatim or node.tag in VERBATIM
        below.extend((c, block, verbatim) for c in reversed(node.children))
    return [n for n in found if id(n) not in around and n.inner().strip()]


def clean(html: str) -> Node:
    """A page's body without chrome and boilerplate; visitors' comments are kept, those outside the body behind it."""
    root = parse(html)
    body = body_of(root)
    for box in [b for b in root.find("div", class_=COMMENTS) if body is not b and body not in b.ancestors()]:
        body.append(box)
    rewrite(body, CLEANING)
    rewrite(body, BOILERPLATE)
    return body


def visible_text(html: str) -> str:
    """What a reader sees of the body, white space squeezed."""
    return " ".join(clean(html).content(" ").split())


NO_SPACE, NO_SIGNS = re.compile(r"\s+"), re.compile(r"[^\w　-鿿぀-ヿ]")


def relink_contents(body: Node) -> None:
    """Join the links of tables of contents with the headings on their texts without blanks (a heading's also without signs); of
    headings with one text the first counts. Matched links point at their heading."""
    headings = [(NO_SIGNS.sub("", NO_SPACE.sub("", h.content())), h.attrs.get("id")) for h in body.find(*(f"h{n}" for n in range(1, 7)))]
    by_text = dict(reversed([(text, anchor) for text, anchor in headings if text and anchor]))
    links = [(NO_SPACE.sub("", a.content()), a) for box in body.find("div", class_="contents") for a in box.find("a") if a.attrs.get("href", "")[:1] == "#"]
    for text, a in links:
        a.attrs["href"] = f"#{by_text[text]}" if text in by_text else a.attrs["href"]


def cell_text(cell: Node) -> str:
    parts = ["\n" if n.tag == "br" else re.sub(r"\s+", " ", n.text) for n in cell.walk() if n.tag in ("", "br")]
    lines = (" ".join(line.split()) for line in "".join(parts).split("\n"))
    return "\n".join(x for x in lines if x)


def sections(html: str, keys: list[str]) -> list[tuple[str, int, int, bool, str, int, int]]:
    """Cells of a page's information tables: section, row, cell, whether a heading, text, column span, row span.

    A section begins below the heading cell whose text starts with one of ``keys`` and ends before the next such row; the
    first of a name counts; cells with an image alone are left out. A table may begin with the profile's first heading
    instead of the profile's own: then the profile begins in that row.
    """
    key_of = lambda t: next((k for k in keys if t.startswith(k)), None)
    out, done = [], set()
    body = body_of(parse(html))
    for th in body.find("th"):
        label = th.content().strip()
        key = key_of(label) or (PROFILE if label == NAME_HEADING and PROFILE in keys else None)
        row = next((a for a in th.ancestors() if a.tag == "tr"), None)
        table = next((a for a in th.ancestors() if a.tag == "table"), None)
        if key is None or key in done or row is None or table is None:
            continue
        done.add(key)
        rows = table.find("tr")
        r = 0
        for tr in rows[rows.index(row) + (key_of(label) is not None) :]:
            cells = [c for c in tr.children if c.tag in ("th", "td")]
            if any(c.tag == "th" and key_of(c.content().strip()) for c in cells):
                break
            kept = [(c, cell_text(c)) for c in cells]
            kept = [(c, t) for c, t in kept if t or not c.find("img")]
            for i, (c, t) in enumerate(kept):
                out.append((key, r, i, c.tag == "th", t, int(c.attrs.get("colspan") or 1), int(c.attrs.get("rowspan") or 1)))
            r += bool(kept)
    return out


@F.udtf(returnType="node: int, parent: int, depth: int, tag: string, attrs: map<string, string>, text: string", useArrow=True)
class Nodes:
    """A page's nodes in document order."""

    def eval(self, html: str):
        number: dict[int, tuple[int, int]] = {}
        for i, n in enumerate(parse(html).walk()):
            up = number.get(id(n.parent), (-1, -1))
            number[id(n)] = (i, up[1] + 1)
            yield i, up[0], up[1] + 1, n.tag, n.attrs, n.text or None


@F.udtf(returnType="i: int, tag: string, html: string, text: string, translate: boolean", useArrow=True)
class Chunks:
    """The innermost blocks of a page's cleaned body."""

    def eval(self, html: str):
        for i, n in enumerate(innermost_blocks(clean(html))):
            text = n.content(" ")
            yield i, n.tag, n.inner().strip(), text, bool(SOURCE_SCRIPT.search(text))


@F.udtf(returnType="ord: int, href: string, label: string", useArrow=True)
class Links:
    def eval(self, html: str):
        for i, a in enumerate(n for n in parse(html).find("a") if "href" in n.attrs):
            yield i, a.attrs["href"], a.content().strip()


@F.udtf(returnType="section: string, row: int, cell: int, heading: boolean, text: string, colspan: int, rowspan: int", useArrow=True)
class Sections:
    def eval(self, html: str, keys: list):
        yield from sections(html, list(keys))


@F.pandas_udf(T.StringType())
def page_text(x: pd.Series) -> pd.Series:
    return x.map(visible_text)


@F.pandas_udf(T.StringType())
def page_fragment(x: pd.Series) -> pd.Series:
    """A page's cleaned body, contents relinked."""

    def one(html: str) -> str:
        body = clean(html)
        relink_contents(body)
        return body.inner()

    return x.map(one)


#: Inline elements: runs of them and text make a sentence block.
INLINE = frozenset("a abbr b bdi bdo br cite data dfn em font i img ins kbd mark q rp rt ruby s samp small span strong sub sup time u var wbr del".split())


def keyed(html: str) -> tuple[str, list[tuple[int, str]], list[tuple[int, str, list[int]]]]:
    """A template with ``{{keyN}}`` for each text in the source script, the keys, and the sentence blocks.

    A block is an element whose content is inline and holds two keys or more; its text has every key's text in order.
    Keys and blocks are numbered from 1 in document order; verbatim elements are left alone.
    """
    root = parse(html)
    keys: list[tuple[int, str]] = []
    blocks: list[tuple[int, str, list[int]]] = []
    inside: dict[int, list[int]] = {}
    for n in list(root.walk()):
        if n.tag == "" and SOURCE_SCRIPT.search(n.text) and not any(a.tag in VERBATIM for a in n.ancestors()):
            keys.append((len(keys) + 1, n.text.strip()))
            lead = n.text[: len(n.text) - len(n.text.lstrip())]
            tail = n.text[len(n.text.rstrip()) :]
            n.text = f"{lead}{{{{key{len(keys)}}}}}{tail}"
            for a in n.ancestors():
                inside.setdefault(id(a), []).append(len(keys))
    text_of = dict(keys)
    for n in root.walk():
        own = inside.get(id(n), [])
        if len(own) >= 2 and n.tag not in ("", "!", "#root") and n.tag not in INLINE and all(c.tag in ("", "!") or c.tag in INLINE for c in n.walk() if c is not n):
            blocks.append((len(blocks) + 1, "".join(text_of[k] for k in own), own))
            n.attrs["data-i18n-blk"] = f"blk{len(blocks)}"
    return root.inner(), keys, blocks


@F.udtf(returnType="kind: string, id: int, ja: string, keys: array<int>, template: string", useArrow=True)
class Keyed:
    """One ``template`` row, then a ``key`` row for each text and a ``blk`` row for each sentence block."""

    def eval(self, html: str):
        template, keys, blocks = keyed(html)
        yield "template", 0, None, None, template
        for n, text in keys:
            yield "key", n, text, None, None
        for n, text, own in blocks:
            yield "blk", n, text, own, None
