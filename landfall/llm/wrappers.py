"""Main text of web pages by wrappers inferred from the pages of a host.

A wrapper is a union-free regular expression over a page's stream of tags and texts, kept as the tree
its balanced tags make: every item is a tag with its own sequence inside or a text slot, and is marked
as optional or repeated. The first page of a host is its wrapper. Each further page is aligned with it from
left to right: equal tags are matched and their insides aligned in turn, repeats in a row become one
repeated item (or group of up to four), what one side lacks becomes optional, and texts that differ
become slots. Wrappers align with each other just as well. So each task makes one of the
pages it has of a host, and a second pass over these, a row for each host and task at most, makes the host's.

A wrapper says where the pages of a host keep their article: in the element that is marked as such or else
the innermost one that holds most of the text; and which short lines in it are the
same on page after page, and therefore template. Menus, page headers and footers, sidebars, forms,
notices, adverts and reader comments are left out by their tags, roles and class names. A page that
does not fit its host's wrapper is read by a wrapper of its own.

Null or empty html gives an empty text, as does a page without any. Null or odd urls share a host
of no name. Pages of any length pass; repeated rows and ``page_id`` are pages of their own; further
columns are ignored.
"""

import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from landfall.llm.tables import stored

# A text up to so long that stands unchanged on at least so many pages is template.
TEMPLATE_CHARS, TEMPLATE_PAGES = 80, 3
# An element is taken for the article's if it holds this share of what its parent holds.
MOST = 0.7
# Wrappers up to this many bytes in all are broadcast to the tasks that apply them.
BROADCAST_BYTES = 16 << 20
HOSTS_A_TASK = 2_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*>|([^<]+)|<", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_PARTS = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
OUT_TAGS = frozenset("nav header footer aside form button script style noscript template iframe svg math select textarea title head dialog menu figcaption object".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer header masthead topbar toolbar comment comments reply replies disqus respond discussion "
    "share sharing social related recommended newsletter subscribe subscription signup login paywall pagination pager search hidden skip copyright".split()
)
MAIN_TAGS = frozenset({"article", "main"})
MAIN_NAMES = frozenset("article articlebody post entry story maincontent".split())


class Element:
    """A tag with what is inside: elements and texts in page order."""

    __slots__ = ("name", "sig", "kind", "inside")

    def __init__(self, name: str, sig: str, kind: str) -> None:
        self.name, self.sig, self.kind, self.inside = name, sig, kind, []


_NATURES: dict[tuple[str, str], tuple[str, str]] = {}


def _element(name: str, attributes: str) -> Element:
    key = (name, attributes if name != "a" and "=" in attributes or "class" in attributes else "")
    if key not in _NATURES:
        if len(_NATURES) > 4096:
            _NATURES.clear()
        _NATURES[key] = _nature(*key)
    return Element(name, *_NATURES[key])


def _nature(name: str, attributes: str) -> tuple[str, str]:
    """Signature of a tag, and whether it is the article's, template or neither."""
    values = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    label = " ".join(values.get(k, "") for k in ("class", "id"))
    names = {w for w in _NAME_PARTS.split(label.lower()) if w}
    role = values.get("role", "").lower()
    out = name in OUT_TAGS or role in OUT_ROLES or values.get("aria-hidden") == "true"
    # A header inside an article is told apart when the article is read; names outweigh the tag.
    out = out or (bool(names & OUT_NAMES) and name not in ("body", "html", "main"))
    main = name in MAIN_TAGS or role in ("main", "article") or "articlebody" in values.get("itemprop", "").lower()
    main = main or bool(names & MAIN_NAMES)
    sig = name + "".join("." + c for c in sorted(values.get("class", "").split())[:3] if not re.search(r"\d", c))
    return sig, "out" if out else "main" if main else ""


def parse(html: str) -> Element:
    """The tree of a page; tags that are missing, cut off or in disorder are made up for."""
    root = Element("", "", "")
    stack, at, size = [root], 0, len(html)
    while at < size:
        m = _TOKEN.match(html, at)
        at = m.end()
        text, name = m[4], m[2]
        if text is not None:
            stack[-1].inside.append(text)
        elif name is None:
            if m[0] == "<":
                if re.match(r"[a-zA-Z/!?]", html[at : at + 1]):
                    break  # a tag cut off by the page's end
                stack[-1].inside.append("<")
        else:
            name = name.lower()
            if m[1]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == name:
                        del stack[i:]
                        break
                    if name in INLINE and stack[i].name not in INLINE:
                        break
                continue
            if name in CLOSES_P or name in SAME_CLOSES:
                closes = SAME_CLOSES.get(name, ("p",))
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name in closes:
                        del stack[i:]
                        break
                    if stack[i].name not in INLINE and not (name == "tr" and stack[i].name in ("td", "th")):
                        break
            element = _element(name, m[3])
            stack[-1].inside.append(element)
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else size
            elif name not in VOID and not m[3].endswith("/"):
                stack.append(element)
    return root


# --- Wrappers: [signature, kind, optional, repeated, text, chars, pages, inside] -------------
# text is None for a tag, a string for a text that has been the same so far, True for a slot.
SIG, KIND, OPTIONAL, REPEATED, TEXT, CHARS, PAGES, INSIDE = range(8)


def wrapper(element: Element) -> list:
    """The wrapper of one page."""
    every, made = [element], {}
    for e in every:
        every += [x for x in e.inside if not isinstance(x, str) and x.kind != "out"]
    for e in reversed(every):  # what is inside comes first
        items = []
        for x in e.inside:
            if isinstance(x, str):
                text = " ".join(x.split())
                if text:
                    items.append(["#", "", False, False, text if len(text) <= TEMPLATE_CHARS else True, len(text), 1, []])
            elif x.kind != "out":
                items.append(made.pop(id(x)))
        made[id(e)] = [e.sig, e.kind, False, False, None, sum(i[CHARS] for i in items), 1, repeats(items)]
    return made[id(element)]


def repeats(items: list[list]) -> list[list]:
    """Items that come several times in a row as one repeated item, or group of up to four."""
    out, i, all_sigs = [], 0, [x[SIG] for x in items]
    while i < len(items):
        for k in range(1, 5):
            if all_sigs[i] != (all_sigs[i + k] if i + k < len(items) else None):
                continue
            sigs, n = all_sigs[i : i + k], 1
            while all_sigs[i + n * k : i + n * k + k] == sigs:
                n += 1
            if n > 1:
                rounds = [items[i + j * k : i + j * k + k] for j in range(n)]
                if k > 1:
                    rounds = [[["(" + " ".join(sigs) + ")", "", False, False, None, sum(x[CHARS] for x in r), 1, r]] for r in rounds]
                first = rounds[0][0]
                for r in rounds[1:]:
                    first = align(first, r[0])
                out.append([*first[:REPEATED], True, *first[TEXT:PAGES], 1, first[INSIDE]])
                i += n * k
                break
        else:
            out.append(items[i])
            i += 1
    return out


def align(a: list, b: list) -> list:
    """One wrapper for what two of the same tag describe."""
    whole = [None]
    todo = [(a, b, whole, 0)]
    while todo:
        a, b, into, k = todo.pop()
        inside, i, left, right = [], 0, a[INSIDE], b[INSIDE]
        places: dict[str, list[int]] = {}
        for at, x in enumerate(left):
            places.setdefault(x[SIG], []).append(at)
        for y in right:
            at = next((p for p in places.get(y[SIG], ()) if p >= i), None)
            if at is None:
                inside.append([*y[:OPTIONAL], True, *y[REPEATED:]])
            else:
                inside += [[*x[:OPTIONAL], True, *x[REPEATED:]] for x in left[i:at]]
                todo.append((left[at], y, inside, len(inside)))
                inside.append(None)
                i = at + 1
        inside += [[*x[:OPTIONAL], True, *x[REPEATED:]] for x in left[i:]]
        text = a[TEXT] if a[TEXT] == b[TEXT] else True
        into[k] = [a[SIG], a[KIND], a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], text, a[CHARS] + b[CHARS], a[PAGES] + b[PAGES], inside]
    return whole[0]


def _marked(root: list) -> tuple[int, list[str], list] | None:
    """Characters, path and item of the largest that is marked as the article's, the first of equals."""
    best, todo = None, [(x, None) for x in reversed(root[INSIDE])]
    while todo:
        x, above = todo.pop()
        own = above if x[SIG].startswith("(") else (x[SIG], above)
        if x[KIND] == "main":
            if best is None or x[CHARS] > best[0]:
                best = x[CHARS], own, x
        elif x[TEXT] is None:
            todo += [(y, own) for y in reversed(x[INSIDE])]
    if best is None:
        return None
    path, own = [], best[1]
    while own:
        path.append(own[0])
        own = own[1]
    return best[0], path[::-1], best[2]


def _flat(root: list) -> list[list]:
    """A wrapper's items in page order, each with the number of those inside: JSON does not nest without bound."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append([*x[:INSIDE], len(x[INSIDE])])
        todo += reversed(x[INSIDE])
    return out


def _nested(items: list[list]) -> list:
    """The wrapper that ``_flat`` laid flat."""
    done: list[list] = []
    for x in reversed(items):
        inside = [done.pop() for _ in range(x[INSIDE])]
        done.append([*x[:INSIDE], inside])
    return done[0]


def rules(root: list) -> dict:
    """Where a wrapper's pages have their article, as a path of tags, and which texts in it are template."""
    node, path = root, []
    marked = _marked(root)
    if marked and marked[0] * 4 >= root[CHARS]:
        _, path, node = marked
    else:
        while True:
            inner = [x for x in node[INSIDE] if x[TEXT] is None]
            best = max(inner, key=lambda x: x[CHARS], default=None)
            if best is None or best[CHARS] < MOST * node[CHARS] or best[REPEATED] or best[SIG].split(".")[0] in ("p", *INLINE):
                break
            node = best
            path += [] if best[SIG].startswith("(") else [best[SIG]]
    fixed, varies = [], False
    todo = [node]
    while todo:
        x = todo.pop()
        varies = varies or x[TEXT] is True
        if isinstance(x[TEXT], str) and x[PAGES] >= TEMPLATE_PAGES and not x[REPEATED]:
            fixed.append(" ".join(unescape(x[TEXT]).split()))
        todo += x[INSIDE]
    return {"path": path, "fixed": sorted(set(fixed)) if varies else []}


def _at(root: Element, path: list[str]) -> list[Element]:
    found = [root]
    for sig in path:
        found = [x for e in found for x in e.inside if isinstance(x, Element) and x.sig == sig and x.kind != "out"]
    return found


def blocks(element: Element) -> list[str]:
    """The texts of an element's blocks in page order."""
    out, run = [], []

    def close() -> None:
        text = " ".join(unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    todo = [(element, iter(element.inside), False)]
    while todo:
        e, rest, ends = todo[-1]
        x = next(rest, None)
        if x is None:
            todo.pop()
            if ends:
                close()
        elif isinstance(x, str):
            run.append(x)
        elif x.kind != "out" or (x.name == "header" and x.sig == "header" and e.kind == "main"):
            if x.name in ("br", "hr", "img", "wbr"):
                run.append(" ")
            else:
                if x.name not in INLINE:
                    close()
                todo.append((x, iter(x.inside), x.name not in INLINE))
    close()
    return out


def extract(html: str | None, rule: dict | None) -> str:
    """The main text of a page under the rules of its host."""
    if not html:
        return ""
    root = parse(html)
    found = _at(root, rule["path"]) if rule else []
    if not found or (rule["path"] and not any(map(blocks, found))):
        rule = rules(wrapper(root))
        found = _at(root, rule["path"])
    fixed = set(rule["fixed"])
    return "\n\n".join(b for e in found for b in blocks(e) if b not in fixed)


def _of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A wrapper for each host of the pages of a task."""
    found: dict[str, list] = {}
    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            own = wrapper(parse(html))
            found[host] = align(found[host], own) if host in found else own
            if len(found) >= HOSTS_A_TASK:
                yield _rows(found)
                found = {}
    yield _rows(found)


def _rows(found: dict[str, list]) -> pa.RecordBatch:
    said = [json.dumps(_flat(w), ensure_ascii=False, separators=(",", ":")) for w in found.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(said, pa.string())], ["host", "wrapper"])


def _of_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host, of rows that lie sorted by host; one is held at a time."""
    host, held = None, None
    for batch in batches:
        for name, said in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            if name == host and held is not None:
                held = align(held, _nested(json.loads(said)))
            else:
                if held is not None:
                    yield _rows({host: held})
                host, held = name, _nested(json.loads(said))
    if held is not None:
        yield _rows({host: held})


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper``: the wrapper of each host, as JSON."""
    own = pages.filter("html <> ''").select(_host(), "html")
    partial = own.mapInArrow(_of_pages, "host string, wrapper string")
    return partial.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_of_wrappers, "host string, wrapper string")


def _host():
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))
    return F.coalesce(host, F.lit("")).alias("host")


def _as_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        said = [json.dumps(rules(_nested(json.loads(w))), ensure_ascii=False) for w in batch.column("wrapper").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(said, pa.string())], ["host", "rule"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read: dict[str, dict] = {}
    for batch in batches:
        texts = []
        for html, rule in zip(batch.column("html").to_pylist(), batch.column("rule").to_pylist()):
            if rule is not None and rule not in read:
                if len(read) >= HOSTS_A_TASK:
                    read.clear()
                read[rule] = json.loads(rule)
            texts.append(extract(html, read.get(rule)))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_texts(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``page_id, url, text`` of every page."""
    found = stored(wrappers(pages).mapInArrow(_as_rules, "host string, rule string"), "wrappers")
    size = found.agg(F.sum(F.octet_length("rule") + F.octet_length("host") + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        found = F.broadcast(found)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), _host())
    return own.join(found, "host", "left").select("page_id", "url", "html", "rule").mapInArrow(_extracted, "page_id long, url string, text string")
