"""Main text of web pages: element rules, and site templates found by counting.

A page is read into block elements.  Menus, forms, adverts, comments and the like
go by element, role, class or id.  What is left of the article (else of `main`,
else of the body) is hashed subtree by subtree, from the leaves up.  Spark counts,
for each host, how many different pages hold a subtree; subtrees that recur on
most pages of their host are its template, and are deleted wherever they stand.

Pages of a host with the same text count once, so an article published under many
addresses is no template; a passage that many articles quote is none either, since
it takes most of a host's pages.
"""

from __future__ import annotations

import functools
import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage, text_batches

MIN_PAGES, MIN_SHARE = 5, 0.7         # a template's subtree: at least so many pages of the host, and this share of them
BROADCAST_BYTES = 16 << 20            # of all hosts' templates; beyond this they are joined by a shuffle

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?:[!?]|/(?![A-Za-z]))[^>]*+>|</([A-Za-z][^\s/>]*+)[^>]*+>
    |<([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<([A-Za-z][^\s/>]*+)([^>]*+)>|<[A-Za-z/!?][^>]*+\Z""", re.S | re.X)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Elements by what becomes of them.
RAW = frozenset("script style title textarea iframe noscript noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section summary
    table tbody td template tfoot th thead tr ul""".split())
GONE = frozenset("""aside audio button canvas datalist dialog fieldset footer head legend menu meter nav object optgroup
    option progress search select svg template video""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element that begins closes an open one of these, up to the given container.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"})}
ROLES = frozenset("navigation contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
NAMES = frozenset("""ad ads adv adsense aside banner breadcrumb cmp comment consent cookie copyright discussion follow footer
    gdpr login menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popular popup
    promo promotion reactions recommended recommendations related replies reply respond share sharing sidebar signup skip
    social sponsor sponsored subscribe toolbar trending widget widgets""".split())
STEMS = ("advert", "breadcrumb", "comment", "cookie", "disqus", "footer", "navbar", "newsletter", "sidebar", "sponsor", "subscri")
TALK = ("comment", "reply", "replies", "related", "teaser", "sponsor", "promo")
TOPS = frozenset("header masthead topbar".split())
EXCUSED = frozenset("has with without no not".split())                    # has-sidebar, no-ads


@functools.lru_cache(maxsize=4096)
def named(attributes: str) -> str:
    """What an element's role, class, id and style say: 'gone', 'top' or ''."""
    said = ""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), markup.unescape(value.strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value) \
                or name == "role" and value.lower() in ROLES:
            return "gone"
        if name == "role" and value.lower() == "banner":
            said = "top"
        if name in ("class", "id"):
            for part in value.split():
                words = [w.lower() for w in WORD.findall(part)]
                if not words or words[0] in EXCUSED or words[-1] == "free":
                    continue
                if any(w in NAMES or w.startswith(STEMS) and w != "commentary" for w in words):
                    return "gone"
                if not TOPS.isdisjoint(words):
                    said = "top"
    return said


def talk(attributes: str) -> bool:
    """Whether an article is a comment, a teaser or an advert."""
    return any(n.lower() in ("class", "id") and any(w.lower().startswith(TALK) and w.lower() != "commentary" for w in WORD.findall(v))
               for n, v in ATTRIBUTE.findall(attributes))


class Page:
    """The block elements of one page: `tag` and `up` (the element above) of each,
    and `blocks` (element, text, characters and number of its links) in page order,
    of what the rules leave.  Unclosed and stray tags are taken as browsers do in
    the common cases; what is cut off at the page's end is complete as it stands."""

    def __init__(self, source: str):
        self.tag, self.up, self.gone, self.soft, self.top = ["body"], [-1], [False], [False], [False]
        self.pieces: list[tuple | None] = []
        self._read(source)
        self._judge()

    def _push(self, stack: list[int], name: str, gone: bool, soft: bool, top: bool) -> None:
        stack.append(len(self.tag))
        self.tag.append(name)
        self.up.append(stack[-2])
        self.gone.append(gone)
        self.soft.append(soft)
        self.top.append(top)

    def _read(self, source: str) -> None:
        stack, pieces, tag, link, at, size = [0], self.pieces, self.tag, 0, 0, len(source)
        lower = None
        while at < size:
            m = TOKEN.search(source, at)
            if m is None or m.start() > at:
                pieces.append((stack[-1], source[at:m.start() if m else size], link))
            if m is None:
                break
            at, close = m.end(), m[1]
            if close:
                close = close.lower()
                if close == "a":
                    link = 0
                elif close == "br":
                    pieces.append((stack[-1], " ", link))
                k = len(stack) - 1
                while k and tag[stack[k]] != close:
                    k -= 1
                if k:
                    if any(tag[x] in BLOCK for x in stack[k:]):
                        pieces.append(None)
                    del stack[k:]
                elif close == "p":
                    pieces.append(None)
                continue
            name = (m[2] or m[4] or "").lower()
            if not name:
                continue
            if name in RAW:
                lower = source.lower() if lower is None else lower
                lower = lower if len(lower) == size else source            # where lower case has another length
                end = lower.find("</" + name, at)
                at = size if end < 0 else (source.find(">", end) + 1 or size)
                continue
            if name in VOID:
                if name in ("br", "hr"):
                    pieces.append((stack[-1], " ", link) if name == "br" else None)
                continue
            attributes = m[3] or m[5] or ""
            if name not in BLOCK:
                if name == "a":
                    link = len(pieces) + 1
                if name in GONE or attributes and named(attributes) == "gone":
                    self._push(stack, name, True, False, False)
                continue
            pieces.append(None)
            for k in range(len(stack) - 1, 0, -1):                         # a block ends an open paragraph or heading
                if tag[stack[k]] == "p" or name in HEADINGS and tag[stack[k]] in HEADINGS:
                    del stack[k:]
                    break
                if tag[stack[k]] in BLOCK:
                    break
            if name in CLOSES:
                ends, stops = CLOSES[name]
                for k in range(len(stack) - 1, 0, -1):
                    if tag[stack[k]] in stops:
                        break
                    if tag[stack[k]] in ends:
                        del stack[k:]
                        if name != "tr":                                   # a row may have to end a cell and a row
                            break
            if name in ("html", "body"):
                continue
            if name == "head":
                self._push(stack, name, True, True, False)
                continue
            if len(stack) > 1 and tag[stack[-1]] == "head":                # an unclosed head ends with the first block
                stack.pop()
            said = named(attributes) if attributes else ""
            if name in ("article", "main"):
                inner = any(tag[x] in ("article", "main") for x in stack) and name == "article"
                self._push(stack, name, said == "gone" if inner else name == "article" and talk(attributes), False, False)
            else:
                top = name == "header" or said == "top"
                self._push(stack, name, name in GONE, name == "form" or said == "gone", top)

    def _judge(self) -> None:
        tag, up, n = self.tag, self.up, len(self.tag)
        holds = [False] * n                                                # an article or main below
        for k in range(n - 1, 0, -1):
            if holds[k] or tag[k] in ("article", "main") and not self.gone[k]:
                holds[up[k]] = True
        dead, kind, bare = [False] * n, [""] * n, [False] * n
        for k in range(1, n):
            kind[k] = "article" if "article" in (kind[up[k]], tag[k]) else "main" if "main" in (kind[up[k]], tag[k]) else ""
            outer = kind[up[k]]
            dead[k] = dead[up[k]] or self.gone[k] or self.soft[k] and not holds[k] or self.top[k] and not outer and not holds[k]
            bare[k] = (bare[up[k]] or self.top[k] and outer != "" and not holds[k]) and tag[k] not in HEADINGS
        runs, open_ = [], []                                               # of pieces between two block limits
        for p in [*self.pieces, None]:
            if p is not None:
                if not dead[p[0]] and not bare[p[0]]:
                    open_.append(p)
            elif open_:
                text = " ".join("".join([markup.unescape(x[1]) for x in open_]).split())
                if text:
                    linked = [x for x in open_ if x[2]]
                    runs.append((open_[0][0], text, sum(len(x[1].strip()) for x in linked), len({x[2] for x in linked})))
                open_ = []
        for area in ("article", "main", ""):
            self.blocks = [r for r in runs if not area or kind[r[0]] == area or area == "main" and kind[r[0]]]
            if self.blocks:
                break
        self.kind = kind
        if area != "article":
            self._drop_menus()
        self.pieces = []

    def _drop_menus(self) -> None:
        """Outside articles, elements with three links or more and next to no other text go."""
        n = len(self.tag)
        size, linked, links = [0] * n, [0] * n, [0] * n
        for k, text, chars, count in self.blocks:
            size[k] += len(text)
            linked[k] += chars
            links[k] += count
        for k in range(n - 1, 0, -1):
            for sums in (size, linked, links):
                sums[self.up[k]] += sums[k]
        menu = [False] * n
        for k in range(1, n):
            menu[k] = menu[self.up[k]] or links[k] >= 3 and linked[k] >= 0.8 * size[k] and self.tag[k] not in ("main", "p")
        self.blocks = [b for b in self.blocks if not menu[b[0]]]

    def subtrees(self) -> dict[int, int]:
        """Hash of each element that holds text, from its tag and, in order, its own
        texts and the hashes of the elements below it; not of the article itself."""
        items: dict[int, list] = {}
        for at, (k, text, *_) in enumerate(self.blocks):
            items.setdefault(k, []).append((at, xxhash.xxh64_intdigest(text)))
        out, todo = {}, sorted(items)
        while todo:
            k = todo.pop()
            parts = sorted(items[k])
            code = xxhash.xxh64_intdigest(self.tag[k].encode() + b"".join([x.to_bytes(8, "little") for _, x in parts]))
            if k and self.tag[k] not in ("article", "main"):
                out[k] = code - (1 << 64) if code >> 63 else code
            if k:
                above = self.up[k]
                if above not in items:
                    items[above] = []
                    lo = next((x for x in range(len(todo) - 1, -1, -1) if todo[x] < above), -1)
                    todo.insert(lo + 1, above)
                items[above].append((parts[0][0], code))
        return out

    def text(self, templates: set[int] = frozenset()) -> str:
        """Blocks joined by newlines, without those in subtrees of `templates`."""
        blocks = self.blocks
        if templates:
            cut = {k for k, code in self.subtrees().items() if code in templates}
            if cut:
                dead = [False] * len(self.tag)
                for k in range(1, len(dead)):
                    dead[k] = k in cut or dead[self.up[k]]
                blocks = [b for b in blocks if not dead[b[0]]]
        return "\n".join([b[1] for b in blocks])


def host(url: str = "url") -> Column:
    """The host of an address in lower case; null where it has none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))


def templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Staged: (host, subtrees), the hashes that recur on most of the host's pages.
    As each takes MIN_SHARE of the pages, a host has at most 1 / MIN_SHARE times as
    many as its mean page has subtrees."""
    schema = T.StructType.fromDDL("host string, page long, subtrees array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = [Page(x) for x in b.column("html").to_pylist()]
            found = [list(set(p.subtrees().values())) for p in seen]
            pages_ = np.array([xxhash.xxh64_intdigest(p.text()) for p in seen], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(pages_), pa.array(found, pa.list_(pa.int64()))],
                                             names=schema.names)

    rows = text_batches(pages.select(host(url).alias("host"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
                        .where("host IS NOT NULL"))
    seen = stage(rows.mapInArrow(run, schema), "subtrees")
    found = (seen.select("host", "page", F.explode("subtrees").alias("subtree"))
             .groupBy("host", "subtree").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= MIN_PAGES))
    pages_ = seen.groupBy("host").agg(F.count_distinct("page").alias("pages"))
    return stage(found.join(pages_, "host").where(F.col("n") >= MIN_SHARE * F.col("pages"))
                 .groupBy("host").agg(F.collect_list("subtree").alias("subtrees")), "templates")


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """`pages` without `html`, with `out`: the main text, '' if there is none.

    A null html is an empty page.  Every row gives one row, repeated ones too; a
    page without a host in its address is read by the rules alone; an empty table
    stays empty; a column already named `out` is replaced, others are carried along.
    """
    known = templates(pages, url, html)
    keep = [c for c in pages.columns if c not in (html, out)]
    schema = pages.select(*keep).schema.add(out, "string")
    size = known.agg(F.sum(F.length("host") + 8 * F.size("subtrees") + 32).alias("bytes")).first()["bytes"] or 0
    side = known.select(F.col("host").alias("__host"), F.col("subtrees").alias("__templates"))
    side = F.broadcast(side) if size <= BROADCAST_BYTES else side
    rows = pages.select(*keep, host(url).alias("__of"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("__html"))
    rows = rows.join(side, F.col("__of") == F.col("__host"), "left").select(*keep, "__html", "__templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [Page(x).text(frozenset(t or ())) for x, t in
                     zip(b.column("__html").to_pylist(), b.column("__templates").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, out])

    return text_batches(rows).mapInArrow(run, schema)
