"""HTML extraction by differencing a page with its nearest pages on the same host.

Pages of a host are put in order of their URL paths, and each is aligned with the one
before and the one after it: text lines in the longest common subsequence are shared
furniture and go. The order is cut into ranges wherever Spark cuts it; the outermost
pages of neighbouring ranges are compared across the cut, so results do not depend on it.

Differencing alone misjudges two cases, and a check of the markup follows. Articles that
two neighbours copy from each other are shared without being furniture: text inside an
article or main element stays, and where there is no such element, a neighbour that
shares half of the page's text is taken for a copy and ignored. Furniture that differs
from page to page is not shared: menus, headers, footers, sidebars, forms, adverts,
notices and comments go by element or class.

Rows: null html is empty; a null or odd url has an empty host or path; null ids sort
first; equal rows are one page to their neighbours and one output row each; an empty
table gives an empty result.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesight.llm import text as T
from salesight.llm.tables import map_batches, records, unpack, write_table

#: A neighbour with this share of a page's text in common is a copy.
COPY_SHARE = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|svg|iframe)\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-z][a-z0-9]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr br input".split()
)
#: Elements that are never main text.
FURNITURE = frozenset("head nav footer aside form button select dialog menu object".split())
MAIN = frozenset("article main".split())
#: First or last parts of class names and ids that mark furniture.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent notice notices popup modal menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar widget widgets header footer comment comments reply replies disqus related recommended "
    "share sharing social newsletter subscribe signup login search pagination pager copyright".split()
)
_STATE = frozenset("has with no without is".split())


class Block(NamedTuple):
    text: str
    main: bool
    furniture: bool


def _kind(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is furniture, and whether it holds main text."""
    if tag in MAIN or tag in ("html", "body"):
        main = tag in MAIN
        comment = main and any("comment" in (a or b or c).lower() for a, b, c in _NAMES.findall(attributes))
        return comment, main
    if tag in FURNITURE:
        return True, False
    for quoted, single, bare in _NAMES.findall(attributes) if "=" in attributes else ():
        for name in (quoted or single or bare).lower().split():
            if name in ("main", "articlebody", "article-body"):
                return False, True
            parts = _PART.findall(name)
            if parts and parts[0] not in _STATE and (parts[0] in MARKED or parts[-1] in MARKED):
                return True, False
    return False, False


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, white space collapsed, empty ones left out."""
    found: list[Block] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []
    opened: Counter[str] = Counter()  # open elements by tag: the stack is searched only for those
    furniture = main = 0

    def flush() -> None:
        words = " ".join(markup.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if words:
            found.append(Block(words, main > 0, furniture > 0))

    def pop(to: int) -> None:
        nonlocal furniture, main
        while len(stack) > to:
            name, f, m = stack.pop()
            opened[name] -= 1
            furniture, main = furniture - f, main - m

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append(page[at : token.start()])
        at = token.end()
        tag = (token.group(3) or "").lower()
        if not tag:
            continue
        if tag == "header" and not main and not token.group(2):
            kind = (True, False)
        elif not token.group(2):
            kind = _kind(tag, token.group(4))
        if tag in INLINE and (token.group(2) or not any(kind)):
            parts.append(" " if tag == "br" else "")
            if token.group(2) and opened[tag]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        flush()
                        pop(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            continue
        flush()
        if token.group(2):
            for i in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    pop(i)
                    break
            continue
        if tag in VOID or (token.group(4) or "").endswith("/"):
            continue
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):
            closes = ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closes:
                    pop(i)
                    break
                if stack[i][0] not in INLINE and stack[i][0] not in ("p", "td", "th"):
                    break
        stack.append((tag, *kind))
        opened[tag] += 1
        furniture, main = furniture + kind[0], main + kind[1]
    parts.append(page[at:] if at < len(page) else "")
    flush()
    return found


def main_text(found: list[Block], shared: set[int]) -> str:
    """Main elements' text if there is any, else the lines that are no furniture and not shared."""
    kept = [b.text for b in found if b.main and not b.furniture]
    if not kept:
        kept = [b.text for i, b in enumerate(found) if not b.furniture and i not in shared]
    return "\n\n".join(kept)


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of two lists.

    Equal ends and lines that only one side has go first; the rest is a bit-parallel
    table of one integer for each line of ``a``, read backwards.
    """
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    both = set(a[low : len(a) - high]) & set(b[low : len(b) - high])
    left = [i for i in range(low, len(a) - high) if a[i] in both]
    right = [x for x in b[low : len(b) - high] if x in both]
    places: dict[int, int] = {}
    for j, x in enumerate(right):
        places[x] = places.get(x, 0) | 1 << j
    full, row, table = (1 << len(right)) - 1, (1 << len(right)) - 1, []
    for i in left:
        met = row & places[a[i]]
        row = ((row + met) | (row - met)) & full
        table.append(row)
    found, j = [], len(right) - 1
    for k in range(len(left) - 1, -1, -1):
        # in row k a 0 bit is where the length grows; j must not grow in the row before
        while j >= 0 and table[k] >> j & 1:
            j -= 1
        if j < 0:
            break
        if k and not table[k - 1] >> j & 1:
            continue
        found.append(left[k])
        j -= 1
    return [*range(low), *reversed(found), *range(len(a) - high, len(a))]


def shared_lines(own: tuple[list, list], others: list[tuple[list, list]]) -> list[int]:
    """Lines of a page that a neighbour shares, copies of the page left aside.

    A page is its line hashes and the lines' characters, 0 for lines of furniture.
    """
    shared: set[int] = set()
    lines, chars = own
    for other, other_chars in others:
        met = common_lines(lines, other)
        common = sum(chars[i] for i in met)
        least = min(sum(chars), sum(other_chars))
        if not common or common < COPY_SHARE * least:
            shared.update(met)
    return sorted(shared)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def _keyed(pages: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.xxhash64(F.coalesce("url", F.lit("")), html).alias("pk"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
    )


def profiles(pages: DataFrame) -> DataFrame:
    """Each distinct page's host, path, line hashes and characters of its lines."""
    schema = "page_id bigint, pk bigint, host string, path string, lines array<bigint>, chars array<int>"

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lines, chars = [], []
        for page in batch.column("html"):
            found = blocks(page.as_py())
            hashes = np.zeros(0, np.uint64)
            if found:
                made = [
                    T.byte_hasher(c.data)(c.bounds[:-1], c.bounds[1:], seed=4)
                    for c in T.chunks(pa.array([b.text for b in found]))
                ]
                hashes = np.concatenate(made)
            lines.append(T.signed(hashes).tolist())
            chars.append([0 if b.furniture else len(b.text) for b in found])
        yield records(
            **{n: batch.column(n) for n in ("page_id", "pk", "host", "path")},
            lines=pa.array(lines, pa.list_(pa.int64())),
            chars=pa.array(chars, pa.list_(pa.int32())),
        )

    rows = _keyed(pages).select(
        "page_id", "pk", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "html"
    )
    return map_batches(rows, step, schema).dropDuplicates(["page_id", "pk"])


def neighbours(found: DataFrame) -> DataFrame:
    """Each profile with the lines and chars of the pages before and after it on its host."""
    order = ["host", "path", "page_id", "pk"]
    ranged = found.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = write_table(ranged, "ranged-pages")
    page = F.struct(*order, "lines", "chars")
    ends = ranged.groupBy("part").agg(F.min(page).alias("first"), F.max(page).alias("last"))
    along = Window.orderBy("part")  # one row for each partition
    ends = ends.select(
        "part", F.lag("last").over(along).alias("end_before"), F.lead("first").over(along).alias("start_after")
    )
    inside = Window.partitionBy("part").orderBy(*order)
    placed = ranged.withColumns({"before": F.lag(page).over(inside), "after": F.lead(page).over(inside)})
    placed = placed.join(ends, "part")
    both = {"before": F.coalesce("before", "end_before"), "after": F.coalesce("after", "start_after")}
    placed = placed.withColumns(both)
    near = [F.when(F.col(c).getField("host") == F.col("host"), F.struct(f"{c}.lines", f"{c}.chars")).alias(c) for c in both]
    return placed.select("page_id", "pk", "lines", "chars", *near)


def furniture(pages: DataFrame) -> DataFrame:
    """page_id, pk and ``shared``, the numbers of the lines that a neighbour has as well."""
    schema = "page_id bigint, pk bigint, shared array<int>"

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        shared = []
        for page in batch.select(["lines", "chars", "before", "after"]).to_pylist():
            others = [(o["lines"], o["chars"]) for o in (page["before"], page["after"]) if o]
            shared.append(shared_lines((page["lines"], page["chars"]), others))
        yield records(
            page_id=batch.column("page_id"), pk=batch.column("pk"), shared=pa.array(shared, pa.list_(pa.int32()))
        )

    return map_batches(neighbours(profiles(pages)), step, schema)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_shared (lines shared with a neighbour) for every row of ``pages``."""
    shared = write_table(furniture(pages), "page-furniture")

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        packed = [squeeze(h.as_py().encode()) for h in batch.column("html")]
        yield records(
            **{n: batch.column(n) for n in ("page_id", "pk", "url")}, packed=pa.array(packed, pa.binary())
        )

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, counts = [], []
        for packed, shared in zip(batch.column("packed"), batch.column("shared"), strict=True):
            lines = set(shared.as_py() or ())
            found.append(main_text(blocks(unpack(packed)), lines))
            counts.append(len(lines))
        yield records(
            page_id=batch.column("page_id"),
            url=batch.column("url"),
            text=pa.array(found, pa.string()),
            n_shared=pa.array(counts, pa.int64()),
        )

    rows = map_batches(_keyed(pages), pack, "page_id bigint, pk bigint, url string, packed binary")
    shared = shared.select(F.col("page_id").alias("_id"), F.col("pk").alias("_pk"), "shared")
    joined = rows.join(shared, rows.page_id.eqNullSafe(F.col("_id")) & (rows.pk == F.col("_pk")), "left")
    return map_batches(
        joined.select("page_id", "url", "packed", "shared"),
        step,
        "page_id bigint, url string, text string, n_shared bigint",
    )
