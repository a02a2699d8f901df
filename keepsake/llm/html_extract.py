"""Main text of HTML pages by nearest-URL page differencing.

A page is cut into text lines at block elements; what HTML itself says is never text of the page (scripts, forms,
``nav``, ``footer`` and the like, by element or role, and what is hidden) is left out. Every other line takes part
in differencing. Pages of a host are sorted by URL path; each is aligned with the nearer of the two pages beside it
that differ from it, by the length of the path they share, by a longest common subsequence of lines. A shared line
is page furniture and is deleted, unless it is plain text inside an article element, as neighbouring pages may carry
the same passages. Class and id names speak only for lines that no neighbour shares: what they call furniture
goes, but for headings and sections inside an article. Only where a host has no other page to tell furniture by, and
there is an article, all lines outside it go.

Pages meet by a range partitioning over (host, path), so a host of any size spreads; a page whose
neighbour is in another partition is settled afterwards from the partitions' first and last pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import map_rows
from keepsake.llm.url_rules import host_and_path
from keepsake.sources.staging import stage

# HTML elements by their part in a page.
NEVER_TEXT = frozenset(
    "script style noscript template svg math head title iframe object embed audio video canvas map "
    "form button select option textarea input label fieldset datalist dialog menu nav footer aside".split()
)
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# Start tags that end an open p; table parts and items end their kind, and what stands in them.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
_TABLE = frozenset(["table"])
_LISTS = frozenset("ul ol menu".split())
#: For each of these start tags the elements within which it belongs to them, not to what is outside.
HOLDERS = {
    **dict.fromkeys(("li",), _LISTS),
    **dict.fromkeys(("dd", "dt"), frozenset(["dl"])),
    **dict.fromkeys(("td", "th"), _TABLE | {"tr"}),
    **dict.fromkeys(("tr",), _TABLE | {"tbody", "thead", "tfoot"}),
    **dict.fromkeys(("tbody", "thead", "tfoot"), _TABLE),
}
UNCLOSED = frozenset("p li dd dt td th tr".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
# Words of class and id names. A name is furniture if one of its words is, and the others
# are too or say nothing: "ad-slot", "reader-comments", "cookie_bar", but not "share-price".
REMARKS = frozenset("comment comments respond reply replies discussion disqus related recommended".split())
FURNITURE = REMARKS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "sidebar aside footer header masthead topbar toolbar breadcrumb breadcrumbs cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "pagination pager widget".split()
)
PLAIN = frozenset(
    "site page main top bottom left right global user users reader readers post article entry side inline google box bar "
    "slot unit container wrapper wrap list links area section block panel buttons button item items inner outer content "
    "title thread body author meta text group row col column message first last js big small fixed sticky".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]+)))?|.", re.S)
#: Inside an article a class or id name alone does not take these away.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Nor do these words a section.
SECTION_WORDS = frozenset("discussion related recommended notice notices promotion social sharing share notification alert".split())
_NAMES = re.compile(r"[a-z]+")
_ARTICLE = re.compile(r"<(?:article|main)\b", re.I)


def _named(token: str, in_article: bool) -> frozenset[str]:
    """The furniture words of a class or id name, none if it has other words that say something."""
    words = frozenset(_NAMES.findall(token.lower()))
    found = words & FURNITURE
    if in_article:
        found -= {"header", "masthead", "banner"}
    return found if found and words <= FURNITURE | PLAIN else frozenset()


def attributes_of(text: str) -> dict[str, str]:
    """Attributes by name in lower case, read from the tag's start; of one name the first counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        if m[1]:
            out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _is_furniture(name: str, attributes: str, in_article: bool) -> str:
    """``no``; ``yes``; ``shell``: yes, unless it turns out to hold the article; or ``named``, ``named shell``: by a class
    or id name only.
    """
    if name in NEVER_TEXT or name == "header" and not in_article:
        return "shell" if name in ("form", "fieldset", "dialog") else "yes"
    if name in ("html", "body", "main") or not attributes:
        return "no"
    given = attributes_of(attributes)
    role = given.get("role", "").lower()
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return "yes"
    if role in ROLES:
        return "shell" if role in ("form", "dialog", "alert", "banner") else "yes"
    named = (given.get("class", "") + " " + given.get("id", "")).lower().split()
    found = frozenset().union(*(_named(t, in_article) for t in named))
    if found:
        return "named" if found & REMARKS or name == "article" else "named shell"
    return "no"


class _Skipped:
    """An element that may go without its end tag, read on until it is over."""

    def __init__(self, name: str, around: Counter) -> None:
        self.inside, self.around = [name], around

    def over(self, tag: str, closing: bool) -> str:
        """``no``; ``closed`` by this tag; or ``before`` it, which belongs to what is around."""
        if tag in INLINE or tag in VOID and tag != "hr":
            return "no"
        if closing:
            for n in range(len(self.inside) - 1, -1, -1):
                if self.inside[n] == tag:
                    del self.inside[n:]
                    return "no" if self.inside else "closed"
            return "before" if tag != "p" and self.around[tag] > 0 else "no"
        if tag in HOLDERS:
            if HOLDERS[tag].isdisjoint(self.inside):
                return "before"
        elif tag in ENDS_P and self.inside[0] == "p" and len(self.inside) == 1:
            return "before"
        if tag not in VOID:
            self.inside.append(tag)
        return "no"


def _after_raw(html: str, at: int, name: str) -> int:
    end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
    return end.end() if end else len(html)


def _holds_article(html: str, at: int, name: str, around: Counter) -> bool:
    """Does the element opened before ``at`` hold an article element that is none of furniture?"""
    if not _ARTICLE.search(html, at):
        return False
    depth = 1
    unclosed = _Skipped(name, around) if name in UNCLOSED else None
    for m in _TAG.finditer(html, at):
        tag, closing = (m[2] or m[5] or "").lower(), bool(m[1] or m[4])
        if unclosed and tag and unclosed.over(tag, closing) != "no":
            return False
        if tag in ("article", "main") and not closing and _is_furniture(tag, m[3] or m[6] or "", False) == "no":
            return True
        if tag == name and not unclosed:
            depth += -1 if closing else 1
            if not depth:
                return False
    return False


Lines = list[tuple[str, str]]


def page_lines(html: str | None, by_name: bool = True) -> Lines:
    """(kind, text) of the page's text lines in order, white space folded and trimmed.

    Kinds: ``+`` inside an article; ``-`` outside; ``?`` inside, in a heading or section that a name calls furniture;
    ``#`` in other elements that a class or id name calls furniture. Without ``by_name`` names say nothing.
    """
    html = html or ""
    out: Lines = []
    held: list[str] = []
    article = 0
    skipped, depth, named_from = "", 0, -1
    unclosed: _Skipped | None = None
    doubted, doubt = "", 0  # a heading or section inside the article, and how deep in it
    around: Counter = Counter()  # open elements outside of what is skipped

    def end_line() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(("-" if not article else "?" if doubt else "+", text))

    def end_named(end: int) -> None:
        if named_from >= 0:
            out.extend(("#", text) for _, text in page_lines(html[named_from:end], by_name=False))

    at = 0
    while True:
        m = _TAG.search(html, at)
        if not skipped:
            held.append(html[at : m.start() if m else len(html)])
        if m is None:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        alone = name in VOID or attributes.endswith("/") and name in ("svg", "path", "use")
        if unclosed:
            ended = "no" if alone and name not in VOID else unclosed.over(name, closing)
            if ended == "no" and name in RAW and not closing:
                at = _after_raw(html, at, name)
                unclosed.over(name, True)
            if ended != "no":
                end_named(m.start())
                skipped, unclosed = "", None
            if ended != "before":
                continue
        elif skipped:
            if name == skipped and not alone:
                depth += -1 if closing else 1
                if depth == 0:
                    end_named(m.start())
                    skipped = ""
            continue
        furniture = "no" if closing else _is_furniture(name, attributes, article > 0)
        if furniture.startswith("named") and not by_name:
            furniture = "no"
        if furniture.endswith("shell") and not article and name not in VOID and _holds_article(html, at, name, around):
            furniture = "no"
        if furniture.startswith("named") and article and _doubtful(name, attributes):
            end_line()
            if not doubt:
                doubted, doubt = name, 0
            furniture = "no"
        elif furniture != "no":
            if name not in INLINE:
                end_line()
            if alone:
                continue
            if name in RAW:
                at = _after_raw(html, at, name)
                continue
            skipped, depth = name, 1
            named_from = at if furniture.startswith("named") and name not in INLINE else -1
            unclosed = _Skipped(name, around) if name in UNCLOSED else None
            continue
        if name in INLINE:
            continue
        end_line()
        around[name] = max(0, around[name] + (-1 if closing else 1))
        if name == doubted:
            doubt = max(0, doubt + (-1 if closing else 1))
            doubted = doubted if doubt else ""
        if name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
    if skipped:
        end_named(len(html))
    end_line()
    return out


def _doubtful(name: str, attributes: str) -> bool:
    """Is it a heading, or a section named by words that also stand over a part of an article?"""
    if name in HEADINGS:
        return True
    given = attributes_of(attributes)
    tokens = (given.get("class", "") + " " + given.get("id", "")).lower().split()
    return name == "section" and frozenset().union(*(_named(t, True) for t in tokens)) <= SECTION_WORDS


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``.

    Equal starts and ends are taken at once; between them the matching pairs form a longest
    increasing chain (pairs of one line in ``a`` from the last backwards).
    """
    low, n = 0, min(len(a), len(b))
    while low < n and a[low] == b[low]:
        low += 1
    high = 0
    while high < n - low and a[-1 - high] == b[-1 - high]:
        high += 1
    out = set(range(low)) | set(range(len(a) - high, len(a)))
    where: dict[str, list[int]] = {}
    for j in range(len(b) - high - 1, low - 1, -1):
        where.setdefault(b[j], []).append(j)
    ends: list[int] = []
    chains: list[tuple] = []
    for i in range(low, len(a) - high):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(link)
            else:
                ends[k], chains[k] = j, link
    link = chains[-1] if chains else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def settled(lines: Lines, nearest: Lines | None) -> tuple[str, int, int]:
    """The text that is left, how many lines went as shared, and how many by their name alone."""
    if nearest is None:
        has_article = any(kind == "+" for kind, _ in lines)
        kept = [text for kind, text in lines if kind in "+?" or kind == "-" and not has_article]
        return " ".join(kept), 0, sum(kind == "#" for kind, _ in lines)
    shared = common_lines([t for _, t in lines], [t for _, t in nearest])
    gone = {n for n in shared if lines[n][0] != "+"}
    named = {n for n, (kind, _) in enumerate(lines) if kind == "#"} - gone
    return " ".join(t for n, (_, t) in enumerate(lines) if n not in gone and n not in named), len(gone), len(named)


def shared_length(a: str, b: str) -> int:
    """Characters that two paths have in common from the start."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _compressed(text: str) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(9).compress(text.encode("utf-8", "surrogatepass"))


def _plain(blob: bytes) -> str:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob).decode("utf-8", "surrogatepass")


def _packed(lines: Lines) -> bytes:
    """Lines that only say what is shared, as they go anyway, are kept as hashes."""

    def written(kind: str, text: str) -> str:
        raw = text.encode("utf-8", "surrogatepass")
        return kind + (hashlib.blake2b(raw, digest_size=6).hexdigest() if kind == "#" else text)

    return _compressed("\n".join(written(*line) for line in lines))


def _unpacked(blob: bytes) -> Lines:
    body = _plain(blob)
    return [(x[0], x[1:]) for x in body.split("\n")] if body else []


Near = tuple[str, bytes]  # path and lines of a page beside


def _text(path: str, lines: bytes, before: Near | None, after: Near | None) -> tuple[str, int, int]:
    """By the neighbour whose path has more in common; the one before, if both have as much."""
    near = before or after
    if before and after and shared_length(path, after[0]) > shared_length(path, before[0]):
        near = after
    return settled(_unpacked(lines), None if near is None else _unpacked(near[1]))


_LINES = "page_id long, url string, host string, path string, lines binary"
_SETTLED = (
    "part int, role string, page_id long, url string, host string, path string, last_path string, text binary, "
    "shared_lines int, named_lines int, lines binary"
)


def _in_order(taken: Iterable[tuple]) -> Iterator[tuple]:
    """Rows of one sorted partition: settled pages, open ones, and the runs at both ends.

    A run is consecutive pages of one host with equal lines. The first and last run of the partition stay open.
    Ids and paths of a run wait for the run after it, its lines only once.
    """
    part = TaskContext.get().partitionId()
    ends: list[list] = []  # host, first path, last path, lines of the first two runs and the last two
    runs, before = 0, None
    waiting: list[tuple] = []

    def open_page(role: str, page: tuple) -> tuple:
        return part, role, page[0], page[1], None, page[2], None, None, None, None, None

    def close(run: list, after: Near | None) -> Iterator[tuple]:
        last: dict[int, tuple] = {}
        earlier = (before[2], before[3]) if before and before[0] == run[0] else None
        for page_id, url, path in waiting:
            # Pages of a run differ by their path only, and few are nearer to the other side.
            near = bool(after and earlier and shared_length(path, after[0]) > shared_length(path, earlier[0]))
            if near not in last:
                text, *counts = _text(path, run[3], None if near else earlier, after if near or not earlier else None)
                last[near] = _compressed(text), *counts
            yield part, "page", page_id, url, None, None, None, *last[near], None

    for page_id, url, host, path, lines in taken:
        if not runs or ends[-1][0] != host or ends[-1][3] != lines:
            if runs > 1:
                yield from close(ends[-1], (path, lines) if host == ends[-1][0] else None)
            waiting = []
            before = ends[-1] if runs else None
            if len(ends) == 4:
                ends.pop(2)
            ends.append([host, path, path, lines])
            runs += 1
        ends[-1][2] = path
        if runs == 1:
            yield open_page("first", (page_id, url, path))
        else:
            waiting.append((page_id, url, path))
    for page in waiting:
        yield open_page("last", page)
    for n, (host, first, last, lines) in enumerate(ends):
        yield part, f"end {n}", None, None, host, first, last, None, None, None, lines


def _neighbours(ends: list[tuple[int, list[tuple]]]) -> dict[tuple[int, str], tuple[bytes, Near | None, Near | None]]:
    """For the open runs of each partition their lines and the pages before and after of the host, if any."""
    flat: list[list] = []
    first, last = {}, {}
    for part, runs in sorted(ends):
        for n, (host, start, end, lines) in enumerate(runs):
            if n == 0 and flat and (flat[-1][0], flat[-1][3]) == (host, lines):
                flat[-1][2] = end
            else:
                flat.append([host, start, end, lines])
            if n == 0:
                first[part] = len(flat) - 1
            last[part] = len(flat) - 1

    def near(at: int) -> tuple[bytes, Near | None, Near | None]:
        host, _, _, lines = flat[at]
        before, after = flat[at - 1] if at else None, flat[at + 1] if at + 1 < len(flat) else None
        return (
            lines,
            (before[2], before[3]) if before and before[0] == host else None,
            (after[1], after[3]) if after and after[0] == host else None,
        )

    return {
        **{(part, "first"): near(at) for part, at in first.items()},
        **{(part, "last"): near(at) for part, at in last.items()},
    }


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, shared_lines, named_lines) of every page row.

    The last two count the lines that went as shared with the nearest page, and those that went by a class or id name
    alone. Null and empty pages have an empty text; pages with null or malformed URLs share one nameless
    host; repeated rows have one text; a host of one distinct page loses no shared lines. Other columns
    are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    source = pages.select("page_id", "url", host.alias("host"), path.alias("path"), "html")

    def cut(taken: Iterable[tuple]) -> Iterator[tuple]:
        for page_id, url, host, path, html in taken:
            yield page_id, url, host, path, _packed(page_lines(html))

    # Lines order equal keys only; they are no part of the keys that are sampled for the ranges.
    keys = ["host", "path", "page_id", "url"]
    by_url = map_rows(source, _LINES, cut).repartitionByRange(*keys).sortWithinPartitions(*keys, "lines")
    done = stage(map_rows(by_url, _SETTLED, _in_order), "settled")
    # At most four runs of each partition reach the driver.
    ends: dict[int, list[tuple[int, tuple]]] = {}
    columns = ("part", "role", "host", "path", "last_path", "lines")
    for r in done.where(F.col("role").startswith("end")).select(*columns).collect():
        run = (r["host"], r["path"], r["last_path"], bytes(r["lines"]))
        ends.setdefault(r["part"], []).append((int(r["role"][4:]), run))
    sent = spark.sparkContext.broadcast(
        _neighbours([(part, [run for _, run in sorted(runs)]) for part, runs in ends.items()])
    )

    def close(taken: Iterable[tuple]) -> Iterator[tuple]:
        for part, role, page_id, url, path, text, shared, named in taken:
            if role == "page":
                text = _plain(text)
            else:
                lines, before, after = sent.value[part, role]
                text, shared, named = _text(path, lines, before, after)
            yield page_id, url, text, len(text), shared, named

    rows = done.where(~F.col("role").startswith("end")).select(
        "part", "role", "page_id", "url", "path", "text", "shared_lines", "named_lines"
    )
    return map_rows(
        rows, "page_id long, url string, text string, n_chars long, shared_lines int, named_lines int", close
    )
