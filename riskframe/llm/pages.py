"""HTML extraction by nearest-URL page differencing.

Pages are cut into text blocks inside tasks, those of menus, headers, footers and adverts too. Pages stand by URL path within
each host, copies counting once, and the lines of every page are aligned with those of the pages before and after it by
longest common subsequence: what two pages share is their frame and goes, what differs stays, unless the pages are copies of
each other in nearly all their text. A check by markup follows: text that differs from page to page but stands in an element
that names it as no article goes, and text of an article (or, without one, of the main element) that neighbours repeat
comes back. Pages without such an element are left as the differences have them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest, xxh64_intdigest

from riskframe.llm.common import stored

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre search "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE_TAGS = frozenset("aside button dialog footer form head iframe menu nav noscript object search select template textarea title".split())
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Names, or first or last parts of names, in class and id attributes.
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement adbox adslot banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright discussion disqus footer gdpr legal login menu modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination popup promo promotion related replies reply respond share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
HEADER_NAMES = frozenset("header masthead topbar".split())
#: On an article or main element only these names count.
NOISE_ARTICLES = frozenset("ad advert comment comments related reply sponsored teaser".split())
COPY_SHARE = 0.9
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
OPEN, ARTICLE, MAIN, NOISE = range(4)


def _names(value: str) -> set[str]:
    out = set()
    for name in value.lower().split():
        parts = re.split(r"[-_]+", name)
        out |= {name, parts[0], parts[-1]}
    return out


def _element_kind(tag: str, attributes: str, outer: int) -> int:
    """What text of a new element is, given what surrounds it."""
    if outer == NOISE or tag in NOISE_TAGS or (tag == "header" and outer == OPEN):
        return NOISE
    names: set[str] = set()
    roles: set[str] = set()
    if attributes:
        for key, *values in ATTRIBUTE.findall(attributes):
            value = "".join(values)
            if key.lower() == "role":
                roles |= set(value.lower().split())
            elif key.lower() != "hidden":
                names |= _names(value)
    if tag in ("article", "main") or "main" in roles:
        if names & NOISE_ARTICLES:
            return NOISE
        return ARTICLE if tag == "article" or outer == ARTICLE else MAIN
    if roles & NOISE_ROLES or (tag not in ("body", "html") and names & (NOISE_NAMES if outer != OPEN else NOISE_NAMES | HEADER_NAMES)):
        return NOISE
    return outer


def blocks_of(html: str | None) -> list[tuple[int, str]]:
    """(kind, text) of every block, in page order; white space is one space, references are decoded."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []
    kind, pieces, at = OPEN, [], 0
    html = html or ""

    def close() -> None:
        if pieces:
            if text := " ".join(unescape("".join(pieces)).split()):
                out.append((kind, text))
            pieces.clear()

    for m in MARKUP.finditer(html):
        if m.start() > at:
            pieces.append(html[at : m.start()])
        at = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK_TAGS:
            close()
        if m.group(2):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close()
                    del stack[i:]
                    break
        elif tag not in VOID_TAGS and not m.group(4).endswith("/"):
            if tag in ("p", "li") and stack and tag in (x for x, _ in stack[-3:]):
                while stack.pop()[0] != tag:
                    pass
            outer = stack[-1][1] if stack else OPEN
            inner = _element_kind(tag, m.group(4), outer)
            if inner != outer:
                close()
            stack.append((tag, inner))
        now = stack[-1][1] if stack else OPEN
        if now != kind:
            close()
            kind = now
    if at < len(html):
        pieces.append(html[at:])
    close()
    return out


def checked(kinds: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Which lines stay: those of the article, or else of the main element; or else the open ones that are not shared."""
    for best in (ARTICLE, MAIN):
        if (kinds == best).any():
            return kinds == best
    return (kinds == OPEN) & ~shared


def common_lines(a: np.ndarray, b: np.ndarray, most: int = 20_000_000) -> np.ndarray:
    """Which lines of ``a`` belong to a longest common subsequence with ``b`` (halved first if the table is large)."""
    shared = np.zeros(len(a), bool)
    if not len(a) or not len(b):
        return shared
    if len(a) > 1 and len(a) * len(b) > most:
        half = len(a) // 2
        cut = int((_lengths(a[:half], b)[-1] + _lengths(a[half:][::-1], b[::-1])[-1][::-1]).argmax())
        shared[:half], shared[half:] = common_lines(a[:half], b[:cut], most), common_lines(a[half:], b[cut:], most)
        return shared
    table = _lengths(a, b, keep=True)
    i, j = len(a), len(b)
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            shared[i] = True
    return shared


def _lengths(a: np.ndarray, b: np.ndarray, keep: bool = False) -> list[np.ndarray]:
    """Rows of the table of common lengths: all of them, or the last one only."""
    rows = [np.zeros(len(b) + 1, np.int32)]
    for x in a:
        last = rows[-1] if keep else rows.pop()
        row = np.zeros(len(b) + 1, np.int32)
        row[1:] = np.maximum.accumulate(np.maximum(last[1:], np.where(b == x, last[:-1] + 1, 0)))
        rows.append(row)
    return rows


def deleted(lines: np.ndarray, sizes: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Lines shared with a neighbouring page that is no copy; ``sizes`` are those of the text that may stay."""
    gone = np.zeros(len(lines), bool)
    for other in others:
        shared = common_lines(lines, other)
        if sizes[shared].sum() < COPY_SHARE * max(1, sizes.sum()):
            gone |= shared
    return gone


def neighbours(pages: DataFrame) -> DataFrame:
    """(host, content, lines, sizes, before, after): line digests of each distinct page of a host and of those next to it, by path.

    Pages are sorted by ranges; the first and last page of a range look into the ranges beside them. So a host's
    pages may fill many ranges.
    """
    classes = pages.groupBy("host", "content").agg(F.min(F.struct("path", "page_id")).alias("place"), F.first("lines").alias("lines"), F.first("sizes").alias("sizes"))
    ordered = stored(
        classes.repartitionByRange("host", "place", "content").sortWithinPartitions("host", "place", "content")
        .withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()),
        "page-order",
    )
    page = F.struct("host", "lines")
    # One row per range.
    ends = ordered.groupBy("part").agg(F.min_by(page, "seq").alias("first"), F.max_by(page, "seq").alias("last"))
    beside = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(beside).alias("last_before"), F.lead("first").over(beside).alias("first_after"))
    inside = Window.partitionBy("part").orderBy("seq")
    rows = ordered.select("*", F.lag(page).over(inside).alias("p"), F.lead(page).over(inside).alias("n")).join(ends, "part")
    own = lambda c: F.when(c["host"].eqNullSafe(F.col("host")), c["lines"])
    before, after = F.coalesce("p", "last_before"), F.coalesce("n", "first_after")
    return rows.select("host", "content", "lines", "sizes", own(before).alias("before"), own(after).alias("after"))


def parsed(pages: DataFrame, texts: bool) -> DataFrame:
    """page_id, url, host, path, content (digest of lines and kinds) of every page, and its blocks: kinds and texts, or line
    digests and the sizes of those that no markup names as noise."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [blocks_of(h) for h in b["html"]]
            lines = [[xxh64_intdigest(t) - 2**63 for _, t in x] for x in found]
            kinds = [[k for k, _ in x] for x in found]
            content = [xxh3_128_hexdigest(np.array([*x, *k], np.int64).tobytes()) for x, k in zip(lines, kinds, strict=True)]
            rows = pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "host": b["host"], "path": b["path"], "content": content})
            if texts:
                yield rows.assign(kinds=kinds, blocks=[[t for _, t in x] for x in found])
            else:
                yield rows.assign(lines=lines, sizes=[[0 if k == NOISE else len(t) for k, t in x] for x in found])

    url = F.coalesce("url", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
        F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", "").alias("path"), "html",
    )
    more = "kinds array<int>, blocks array<string>" if texts else "lines array<long>, sizes array<int>"
    return rows.mapInPandas(run, f"page_id long, url string, host string, path string, content string, {more}")


def differences(pages: DataFrame) -> DataFrame:
    """(host, content, shared): which lines of each distinct page a page next to it has, too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            shared = [
                deleted(np.asarray(lines), np.asarray(sizes), [np.asarray(o) for o in others if o is not None])
                for lines, sizes, *others in zip(b["lines"], b["sizes"], b["before"], b["after"], strict=True)
            ]
            yield b[["host", "content"]].assign(shared=shared)

    return neighbours(stored(parsed(pages, texts=False), "page-lines")).mapInPandas(run, "host string, content string, shared array<boolean>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null or empty html: empty text. Null url: a host of its own without a name. Repeated rows and copies get equal
    texts and count once as neighbours. An empty table gives an empty result; other columns are ignored. Texts are parsed
    again once the differences are known, so that they are not stored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [
                "\n".join(x for x, stays in zip(blocks, checked(np.asarray(kinds, int), np.asarray(shared, bool)), strict=True) if stays)
                for blocks, kinds, shared in zip(b["blocks"], b["kinds"], b["shared"], strict=True)
            ]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts})

    rows = parsed(pages, texts=True).drop("path").join(differences(pages), ["host", "content"])
    texts = rows.select("page_id", "url", "kinds", "blocks", "shared").mapInPandas(run, "page_id long, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
