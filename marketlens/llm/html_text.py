"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is read as a stream of block tags and text slots. Adjacent equal groups fold into
repeated ones. Streams of one host are aligned pairwise: where they differ, the surplus
becomes one more turn of a repeated group if it equals the group before it, else an optional
group. The result is the host's wrapper. Every page is then matched against it, which says
for each text by which slot of the wrapper it was read; per slot the host keeps how much text
it held and whether that was always the same. From these the slots of the article are chosen,
and a page's text is what these slots read. A text that no slot reads (none, as long as the
wrapper covers all pages) is judged like a slot of its own by its blocks.

Expressions and counts are taken per scan batch and merged per host in rounds of at most
`GROUP` rows, so a host with most pages is spread like any other.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.sizes import small_side
from marketlens.llm.url_filter import host_of
from marketlens.session import stored

# fixed values: elements of HTML
BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
RAW = ("script", "style", "noscript", "template", "iframe", "textarea", "svg", "title", "object", "xmp")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>|</{name}\Z", re.I) for name in RAW}
VOID = frozenset("hr br img input meta link col area base embed source track wbr".split())
# an opening tag on the left ends an open element on the right
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
FURNITURE = frozenset("nav header footer aside form menu dialog button select option head search fieldset".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion sidebar side nav navbar "
    "navigation menu breadcrumb breadcrumbs header masthead footer comment comments reply replies respond disqus notice "
    "notices cookie cookies consent newsletter subscribe signup related share sharing social widget popup modal alert "
    "legal copyright login search toolbar pagination pager".split()
)
# words that may stand beside these in a class that names furniture
PLACES = frozenset(
    "left right top bottom upper lower main site page global fixed sticky primary secondary wrapper wrap container box "
    "block area section bar list item items links inner outer widgets 0".split()
)
# elements that also wrap whole pages, and the share of the text from which they do
WRAPPING = frozenset("form fieldset".split())
WRAPPER_SHARE = 0.8
ARTICLE = ("article", "main")
# blocks of text that belong to the article beside its largest block
LEADS = frozenset("h1 h2 h3 h4 h5 h6 hgroup p blockquote pre figure".split())
# rows of a host that one task merges in a round
GROUP = 64
# blocks open at once; one more closes the innermost, so its text stays and only its place
# in the tree changes
DEPTH = 100
# matched sequences remembered per wrapper, and their length
REMEMBERED, SHORT = 20_000, 64
# a text that is the same on this many different pages belongs to the template
TEMPLATE_PAGES = 5
# hosts whose wrappers (a few kilobytes each) are broadcast; beyond this the join shuffles
BROADCAST_HOSTS = 20_000
_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NUMBER = re.compile(r"\d+")


def _label(name: str, rest: str) -> str:
    """The element with its classes, id and role, numbers in these made equal."""
    if not rest:
        return name
    label = [name]
    for key, *values in _ATTRIBUTE.findall(rest):
        label += [("." if key.lower() == "class" else "@") + w for w in _NUMBER.sub("0", "".join(values)).lower().split()]
    return "".join(label)


def blocks(html: str) -> Iterator[tuple[str, tuple[str, ...], str]]:
    """("<", path, "") at a block's begin, (">", path, "") at its end, ("#", path, text) for
    text directly in the block at `path`. Missing end tags are supplied."""
    path: list[str] = []
    names: list[str] = []
    held: list[str] = []

    def text() -> Iterator[tuple[str, tuple[str, ...], str]]:
        joined = "".join(held)
        held.clear()
        joined = " ".join((references.unescape(joined) if "&" in joined else joined).split())
        if joined:
            yield "#", tuple(path), joined

    def close(count: int) -> Iterator[tuple[str, tuple[str, ...], str]]:
        for _ in range(count):
            yield ">", tuple(path), ""
            path.pop()
            names.pop()

    at = 0
    while at < len(html):
        found = _PIECE.search(html, at)
        if not found:
            held.append(html[at:])
            break
        held.append(html[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                held.append(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if name in RAW and not found["end"]:
            end = _RAW_ENDS[name].search(html, at)
            at = end.end() if end else len(html)
            continue
        if name == "br":
            held.append(" ")
            continue
        if name not in BLOCKS:
            continue
        yield from text()
        if found["end"]:
            if name in names:
                yield from close(len(names) - max(i for i, n in enumerate(names) if n == name))
            continue
        if names and names[-1] == "p":
            yield from close(1)
        ends = CLOSES.get(name, ())
        while names and names[-1] in ends:
            yield from close(1)
        if len(path) == DEPTH:
            yield from close(1)
        path.append(_label(name, found["rest"]))
        names.append(name)
        yield "<", tuple(path), ""
        if name in VOID:
            yield from close(1)
    yield from text()
    yield from close(len(path))


# --- expressions: a list of tokens and of [mark, expression], mark "+" or "?" ----------


def _key(item) -> str:
    """Equal for a group and the same group repeated or optional."""
    while isinstance(item, list) and len(item[1]) == 1 and isinstance(item[1][0], list):
        item = item[1][0]
    return json.dumps(item[1] if isinstance(item, list) else [item])


def fold(items: list, key: Callable, repeated: Callable, longest: int = 12) -> list:
    """Adjacent equal groups of up to `longest` items become one repeated group."""
    keys = [key(i) for i in items]
    size = 1
    while size <= longest and 2 * size <= len(items) and len(set(keys)) < len(keys):
        out: list = []
        made: list[str] = []
        at = 0
        while at < len(items):
            group, turns = keys[at : at + size], 1
            while len(group) == size and keys[at + turns * size : at + (turns + 1) * size] == group:
                turns += 1
            item = repeated(items[at : at + size]) if turns > 1 else items[at]
            out.append(item)
            made.append(key(item) if turns > 1 else keys[at])
            at += turns * size if turns > 1 else 1
        items, keys = out, made
        size += 1
    return items


def _again(group: list):
    if len(group) == 1 and isinstance(group[0], list) and group[0][0] == "+":
        return group[0]
    return ["+", group]


def stream(events: Iterable[tuple]) -> list[str]:
    """Tokens of a page: `<label`, `>`, `#`."""
    return [mark + path[-1] if mark == "<" else mark for mark, path, _ in events]


def _again_text(group: list[tuple[str, str]]) -> tuple[str, str]:
    if len(group) == 1 and group[0][1].startswith('["+"'):
        return group[0]
    body = f"[{','.join(text for _, text in group)}]"
    return group[0][0] if len(group) == 1 else body, f'["+",{body}]'


def folded(events: Iterable[tuple]) -> str:
    """The page's own expression as JSON: elements as groups, so that equal siblings fold.

    Items are pairs of what they are compared by and their text, so no group is spelled twice.
    """
    stack: list[list[tuple[str, str]]] = [[]]

    def close() -> None:
        items = fold([*stack.pop(), _END], _first, _again_text)
        text = f'["1",[{",".join(text for _, text in items)}]]'
        stack[-1].append((text, text))

    for token in stream(events):
        if token[0] == "<":
            text = json.dumps(token)
            stack.append([(text, text)])
        elif token == ">":
            close()
        else:
            stack[-1].append(_SLOT)
    while len(stack) > 1:
        close()
    return f"[{','.join(text for _, text in fold(stack[0], _first, _again_text))}]"


_END, _SLOT = ('">"', '">"'), ('"#"', '"#"')
_first = itemgetter(0)


def align(left: list, right: list) -> list:
    """The least expression of this kind found that covers both."""

    def label(item) -> str:
        while isinstance(item, list):
            item = item[1][0] if item[1] else ""
        return item

    out: list = []
    pairs = SequenceMatcher(None, [label(i) for i in left], [label(i) for i in right], autojunk=False)
    for op, a, b, c, d in pairs.get_opcodes():
        if op == "equal":
            out += [_merged(x, y) for x, y in zip(left[a:b], right[c:d], strict=True)]
            continue
        for item in [*left[a:b], *right[c:d]]:
            if out and _key(out[-1]) == _key(item):
                out[-1] = out[-1] if isinstance(out[-1], list) and out[-1][0] == "+" else ["+", [out[-1]]]
            else:
                out.append(item if isinstance(item, list) and item[0] == "?" else ["?", [item]])
    return fold(out, _key, _again)


def _merged(x, y):
    if x == y:
        return x
    if _is_element(x) and _is_element(y):
        return ["1", [x[1][0], *align(x[1][1:-1], y[1][1:-1]), x[1][-1]]]
    inner = align(*(i[1] if _is_marked(i) else [i] for i in (x, y)))
    marks = {i[0] for i in (x, y) if _is_marked(i)}
    return [marks.pop(), inner] if len(marks) == 1 else ["?", [["+", inner]]]


def _is_element(item) -> bool:
    return isinstance(item, list) and item[0] == "1"


def _is_marked(item) -> bool:
    return isinstance(item, list) and item[0] != "1"


# --- matching: which slot of the expression reads a text -------------------------------


class Wrapper:
    """An expression ready to read pages.

    Every element of the expression is a node; the places in it (elements and text slots)
    form an automaton whose steps follow from the marks. A slot's path is a tuple of steps
    `node:label`.
    """

    def __init__(self, expression: list):
        self.paths: list[tuple[str, ...]] = []
        self._places: list[list[tuple[str, int]]] = []
        self._after: list[dict[int, dict[str, list[int]]]] = []
        self._last: list[set[int]] = []
        self._known: dict[tuple, list] = {}
        self._node(expression, ())

    def _node(self, items: list, path: tuple[str, ...]) -> int:
        number = len(self._places)
        places: list[tuple[str, int]] = []
        after: dict[int, set[int]] = {}
        self._places.append(places)
        self._after.append({})
        self._last.append(set())

        def place(item) -> tuple[set[int], set[int], bool]:
            at = len(places)
            if item == "#":
                places.append((item, len(self.paths)))
                self.paths.append(path)
            elif _is_element(item):
                token = item[1][0]
                places.append((token, 0))
                places[at] = token, self._node(item[1][1:-1], (*path, f"{len(self._places)}:{token[1:]}"))
            else:
                first, last, empty = sequence(item[1])
                if item[0] == "+":
                    for q in last:
                        after.setdefault(q, set()).update(first)
                return first, last, empty or item[0] == "?"
            return {at}, {at}, False

        def sequence(items: list) -> tuple[set[int], set[int], bool]:
            first: set[int] = set()
            last: set[int] = set()
            empty = True
            for item in items:
                begins, ends, none = place(item)
                for q in last:
                    after.setdefault(q, set()).update(begins)
                first = first | begins if empty else first
                last = last | ends if none else ends
                empty = empty and none
            return first, last, empty

        after[-1], self._last[number], _ = sequence(items)
        for q, nexts in after.items():
            tokens = self._after[number].setdefault(q, {})
            for p in sorted(nexts):
                tokens.setdefault(places[p][0], []).append(p)
        return number

    def _read(self, node: int, tokens: tuple[str, ...]) -> list[int | None]:
        """Per token what its place leads to. A token that the expression doesn't expect
        there takes any place of its kind, else none."""
        if (node, tokens) in self._known:
            return self._known[node, tokens]
        places, after = self._places[node], self._after[node]
        at, steps = [-1], []
        for token in tokens:
            came: dict[int, int] = {}
            for q in at:
                for p in after.get(q, {}).get(token, ()):
                    came.setdefault(p, q)
            if not came:
                came = {p: at[0] for p, (kind, _) in enumerate(places) if kind == token}
            steps.append(came)
            at = sorted(came) or at
        here = next((p for p in at if p in self._last[node]), at[0])
        found: list[int | None] = []
        for came in reversed(steps):
            found.append(places[here][1] if came else None)
            here = came[here] if came else here
        found.reverse()
        if len(tokens) <= SHORT:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            self._known[node, tokens] = found
        return found

    def read(self, html: str) -> list[tuple[int | str, tuple[str, ...], str]]:
        """(slot, path, text) in page order; a text that no slot reads has its path's text
        as slot and steps without node."""
        root: list = []
        stack = [root]
        for mark, path, text in blocks(html):
            if mark == "<":
                inner: list = []
                stack[-1].append(("<" + path[-1], inner))
                stack.append(inner)
            elif mark == ">":
                stack.pop()
            else:
                stack[-1].append(("#", text))
        out: list[tuple[int | str, tuple[str, ...], str]] = []

        def walk(node: int | None, children: list, labels: tuple[str, ...]) -> None:
            tokens = tuple([token for token, _ in children])
            leads = [None] * len(tokens) if node is None else self._read(node, tokens)
            for (token, held), lead in zip(children, leads, strict=True):
                if token != "#":
                    walk(lead, held, (*labels, ":" + token[1:]))
                elif lead is None:
                    out.append((json.dumps(labels), labels, held))
                else:
                    out.append((lead, self.paths[lead], held))

        walk(0, root, ())
        return out

    def path(self, slot: str) -> tuple[str, ...]:
        """The steps of a slot as written by `slots`."""
        return self.paths[int(slot)] if slot.isdigit() else tuple(json.loads(slot))


def _digest(texts: Iterable[str]) -> str:
    return hashlib.blake2b("\n".join(texts).encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def slots(found: Iterable[tuple[int | str, tuple[str, ...], str]]) -> dict[str, list]:
    """Per slot of a page read by its wrapper: [digests of pages, characters, the texts'
    digest or null once it varies]. A page's digest is that of its text outside furniture;
    `TEMPLATE_PAGES` of them are kept."""
    texts: dict[int | str, list[str]] = {}
    paths: dict[int | str, tuple[str, ...]] = {}
    for slot, path, text in found:
        texts.setdefault(slot, []).append(text)
        paths[slot] = path
    sizes: Counter[tuple[str, ...]] = Counter()
    for slot, own in texts.items():
        sizes[paths[slot]] += sum(map(len, own))
    aside = furniture(sizes)
    page = _digest(t for s, own in texts.items() if paths[s] not in aside for t in own)
    return {str(s): [[page], sum(map(len, own)), _digest(own)] for s, own in texts.items()}


def merge_slots(into: dict[str, list], other: dict[str, list]) -> None:
    for path, (pages, chars, same) in other.items():
        if path in into:
            seen = into[path]
            merged = sorted({*seen[0], *pages})[:TEMPLATE_PAGES]
            into[path] = [merged, seen[1] + chars, same if same == seen[2] else None]
        else:
            into[path] = [pages, chars, same]


def _name(step: str) -> str:
    return re.split(r"[.@]", step.partition(":")[2], maxsplit=1)[0]


def _is_article(step: str) -> bool:
    return _name(step) in ARTICLE or step.endswith("@main")


def _is_furniture_word(word: str) -> bool:
    parts = [w for w in re.split(r"[-_:]", word) if w]
    return any(w in FURNITURE_WORDS for w in parts) and all(w in FURNITURE_WORDS or w in PLACES for w in parts)


def furniture(sizes: dict[tuple[str, ...], int]) -> set[tuple[str, ...]]:
    """Of paths with their characters, those in menus, headers, footers, sidebars, notices,
    adverts, forms and comments, by element or by whole words of class, id and role.

    Never by html or body, nor by a block around an article or main element; and by words,
    forms and field sets only while these hold less than `WRAPPER_SHARE` of all text.
    """
    held: Counter[tuple[str, ...]] = Counter()
    around = set()
    for path, size in sizes.items():
        for depth, step in enumerate(path, 1):
            held[path[:depth]] += size
            if _is_article(step):
                around.update(path[:d] for d in range(1, depth))
    total = sum(sizes.values())
    judged: set[tuple[str, ...]] = set()
    for block, size in held.items():
        name, *words = re.split(r"[.@]", block[-1].partition(":")[2])
        small = size < total * WRAPPER_SHARE
        if (
            name not in ("html", "body")
            and block not in around
            and (name in FURNITURE and (small or name not in WRAPPING) or small and any(map(_is_furniture_word, words)))
        ):
            judged.add(block)
    return {path for path in sizes if judged and any(path[:depth] in judged for depth in range(1, len(path) + 1))}


def article_slots(found: dict[str, list], wrapper: Wrapper) -> list[str]:
    """The slots that read the article: those below an article or main element, else below
    the innermost block with most of the text that varies, with the headings and paragraphs
    that stand beside a block around it; never furniture."""
    paths = {s: wrapper.path(s) for s in found}
    sizes: Counter[tuple[str, ...]] = Counter()
    for slot, (_, chars, _) in found.items():
        sizes[paths[slot]] += chars
    aside = furniture(sizes)
    eligible = {s: own for s, own in found.items() if paths[s] not in aside}
    inside = [s for s in eligible if any(map(_is_article, paths[s]))]
    if inside:
        return sorted(inside)
    # text that is the same on several pages belongs to the template
    eligible = {s: own for s, own in eligible.items() if len(own[0]) < TEMPLATE_PAGES or own[2] is None} or eligible
    held: Counter[tuple[str, ...]] = Counter()
    for slot, own in eligible.items():
        for depth in range(1, len(paths[slot])):
            held[paths[slot][:depth]] += own[1]
    total = sum(own[1] for own in eligible.values())
    best = max((block for block, size in held.items() if size * 2 > total), key=len, default=())

    def belongs(path: tuple[str, ...]) -> bool:
        shared = next((d for d, (a, b) in enumerate(zip(path, best, strict=False)) if a != b), min(len(path), len(best)))
        return shared == len(best) or shared < len(path) and _name(path[shared]) in LEADS

    return sorted(s for s in eligible if belongs(paths[s]))


def main_text(html: str, wrapper: Wrapper, chosen: set[str]) -> str:
    """What the chosen slots read, in page order; a page without any of them gives all text
    outside furniture."""
    found = wrapper.read(html)
    kept = [text for slot, _, text in found if str(slot) in chosen]
    if not kept:
        sizes: Counter[tuple[str, ...]] = Counter()
        for _, path, text in found:
            sizes[path] += len(text)
        aside = furniture(sizes)
        kept = [text for _, path, text in found if path not in aside]
    return "\n".join(kept)


def _in_rounds(rows: DataFrame, merge: Callable[[pa.Table], pa.Table], spread: Column, name: str) -> DataFrame:
    """One row per host, by `merge` over groups of about `GROUP` rows of a host a round;
    `spread` deals a host's rows to groups."""
    schema = rows.schema
    while True:
        rows = stored(rows, name)
        counts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > GROUP)
        if not counts.limit(1).count():
            return rows.groupBy("host").applyInArrow(merge, schema)
        large = small_side(counts, BROADCAST_HOSTS, f"{name}_large")
        dealt = rows.withColumn("_spread", spread).join(large, "host", "left")
        part = F.pmod("_spread", F.coalesce(F.ceil(F.col("_rows") / GROUP), F.lit(1)))
        dealt = dealt.select(*schema.names, part.alias("_part"))
        rows = dealt.groupBy("host", "_part").applyInArrow(lambda t: merge(t.drop_columns(["_part"])), schema)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, expression) per host of `pages(url, html)`; the expression as JSON."""
    schema = "host string, expression string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {
                (host, folded(blocks(html or "")))
                for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)
            }
            hosts, texts = [h for h, _ in found], [e for _, e in found]
            yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "expression": pa.array(texts, pa.string())})

    def merge(table: pa.Table) -> pa.Table:
        texts = sorted(set(table.column("expression").to_pylist()))
        expression = json.loads(texts[0])
        for text in texts[1:]:
            expression = align(expression, json.loads(text))
        return pa.table({"host": table.column("host")[:1], "expression": [json.dumps(expression)]})

    hosts = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(read, schema).distinct()
    return _in_rounds(hosts, merge, F.xxhash64("expression"), "expressions")


def _compiled() -> Callable[[str], Wrapper]:
    known: dict[str, Wrapper] = {}

    def of(expression: str) -> Wrapper:
        if expression not in known:
            if len(known) == 64:
                known.clear()
            known[expression] = Wrapper(json.loads(expression))
        return known[expression]

    return of


def chosen_slots(rows: DataFrame) -> DataFrame:
    """(host, article) from `rows(host, html, expression)`: the slots of the host's wrapper
    that read the article, as JSON."""
    schema = "host string, expression string, slots string"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapper = _compiled()
        for batch in batches:
            found: dict[tuple[str, str], dict] = {}
            for host, html, expression in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "expression")), strict=True):
                merge_slots(found.setdefault((host, expression), {}), slots(wrapper(expression).read(html or "")))
            yield pa.RecordBatch.from_pydict(
                {
                    "host": pa.array([h for h, _ in found], pa.string()),
                    "expression": pa.array([e for _, e in found], pa.string()),
                    "slots": pa.array([json.dumps(s) for s in found.values()], pa.string()),
                }
            )

    def merge(table: pa.Table) -> pa.Table:
        found: dict[str, list] = {}
        for held in table.column("slots").to_pylist():
            merge_slots(found, json.loads(held))
        return table.slice(0, 1).set_column(2, "slots", pa.array([json.dumps(found)], pa.string()))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [
                json.dumps(article_slots(json.loads(held), Wrapper(json.loads(expression))))
                for expression, held in zip(batch.column("expression").to_pylist(), batch.column("slots").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(chosen, pa.string())], names=["host", "article"])

    counted = rows.select("host", "html", "expression").mapInArrow(count, schema)
    return _in_rounds(counted, merge, F.monotonically_increasing_id(), "slots").mapInArrow(choose, "host string, article string")


def extract_text(pages: DataFrame) -> DataFrame:
    """Per row of `pages(page_id, url, html)`: page_id, url, text, n_chars.

    Null pages count as empty and give an empty text, as do pages without text. Pages whose
    url has no host share one wrapper. Repeated rows stay; other columns are not used. Pages
    of any length and with missing or unmatched tags are read whole. On hosts without an
    article or main element, a slot whose text is the same on `TEMPLATE_PAGES` different
    pages belongs to the template.
    """
    pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    known = small_side(wrappers(pages), BROADCAST_HOSTS, "wrappers")
    chosen = chosen_slots(pages.join(known, "host"))
    rows = pages.join(small_side(known.join(chosen, "host"), BROADCAST_HOSTS, "articles"), "host")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapper = _compiled()
        for batch in batches:
            read = zip(*(batch.column(c).to_pylist() for c in ("html", "expression", "article")), strict=True)
            texts = [main_text(html or "", wrapper(expression), set(json.loads(article))) for html, expression, article in read]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return rows.select("page_id", "url", "html", "expression", "article").mapInArrow(cut, schema)
