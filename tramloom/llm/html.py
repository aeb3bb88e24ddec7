"""Main text of web pages by consensus host paths.

Each page's containers are scored by the text of their paragraphs; the page votes for the generalised tag-class path of
its best one. Votes are counted per host and weighed by the pages that have the path at all, so that what stands on every
page and wins on a few loses to what wins wherever it stands. Every page is extracted again with that of its own paths
which has the highest share of votes. A page with no voted path uses its own best container, and a page without any its
body. A path has all class names of its tags, in order, with digits generalised; it is known by a 64-bit hash that goes
on from its parent's, so that a page takes memory by its elements, however deep they are. Of all votes, up to PATH_BYTES
go to every task; beyond it pages' paths are joined with them by shuffles, with the same result. Both passes parse.

Scripts, styles, navigation, footers, asides, controls and what is hidden go at once. Words of a class, id or role only
raise a suspicion, which is judged when the page has been read: a wrapper may be called has-sidebar, comments-open or
widget. An element that is named for what it is (sidebar, comment-list) goes unless it holds nearly all of the page's
text; one whose name only mentions it, and a form, go if they hold little of it and no article or main. Inside a voted
container suspects go, but the container itself never does. If nothing is left, the page's text outside scripts and
styles is given.

Defined results: a null or empty html gives an empty text; pages without a host share one host; rows alike vote each;
a tie goes to the path with the least hash; an unclosed comment, tag or raw-text element ends with the page.
Columns of the input named main_text or n_chars give way.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramloom.llm.common import OWN, col, materialize, slices, spread_join, without

#: Bytes of voted paths that go to every task.
PATH_BYTES = 8_000_000

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>|<[a-zA-Z/!?][^<>]*+\Z", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_SKIP = _RAW | {"head", "nav", "footer", "aside", "button", "select", "option", "datalist", "svg", "object", "canvas", "audio", "video", "dialog", "menu", "applet", "map"}
_BLOCK = set("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_CONTAINER = {"article", "main", "section", "div", "td", "body", "center"}
_PARAGRAPH = {"p", "pre", "blockquote", "td", "dd", "li", "div", "section", "article", "main", "body", "center"}
#: What starts of these tags close when it is open above.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CLOSES_P = _BLOCK - {"br", "caption", "legend", "option", "td", "th", "tr", "tbody", "thead", "tfoot"}
_BARRIER = {"ul", "ol", "dl", "table", "body", "html"}
#: Words of class, id or role that mark what is not the article. Fixed values of this extractor.
_BOILERPLATE = set(
    "ad ads adbox adsense advert adverts advertisement advertising banner bannerad sponsor sponsored sponsors promo promoted promotion outbrain taboola "
    "nav navbar navigation menu menubar topbar breadcrumb breadcrumbs pagination pager toc sitemap "
    "footer contentinfo colophon copyright masthead "
    "sidebar sidebars aside complementary widget widgets rail "
    "comment comments commentlist commentary disqus respond replies reply "
    "cookie cookies consent gdpr notice notices alert popup modal overlay dialog toast paywall "
    "share sharing social related recommended recommendations trending newsletter subscribe subscription signup login signin search searchbox skip hidden".split()
)
_HEADER = {"header", "siteheader", "pageheader"}
_COMMENT = {"comment", "comments", "commentlist", "reply", "replies", "disqus"}
#: Words that say nothing of what an element is, at the end of a name; words before it by which it is only mentioned.
_NEUTRAL = set("left right top bottom list box block section area inner outer wrap wrapper container item items group bar link links primary secondary body form button buttons icons row col column".split())
_STATE = set("has no with without is not show hide enable enabled".split())
#: Shares of the page's text from which an element stays that is named for, or only mentions, what is not the article.
NAMED, MENTIONED = 0.98, 0.3
_CONTENT = re.compile(r"(?:[^>]*[.-])?(?:article|content|post|entry|story)")


def suspicion(tag: str, words: list[list[str]], inside: bool) -> int:
    """0, 1 if a name mentions what is not the article, 2 if it is named for that. words: of each class, id and role."""
    found = 0
    for name in words:
        hit = _COMMENT.intersection(name) if tag == "article" else _BOILERPLATE.intersection(name)
        if not hit and not (tag != "article" and not inside and _HEADER.intersection(name) and "article" not in name and "entry" not in name):
            continue
        rest = list(name)
        while len(rest) > 1 and rest[-1] in _NEUTRAL:
            rest.pop()
        named = rest[-1] in _BOILERPLATE or rest[-1] in _HEADER or rest[-1] in _COMMENT
        found = max(found, 2 if named and not _STATE.intersection(name) else 1)
    if found == 2 and any(name[-1] in ("article", "content", "post", "entry", "story", "main") for name in words):
        found = 1  # another of its names says that it is the article
    return found


class Page:
    """One pass over a page: its containers with their paths and scores, and its pieces of text."""

    __slots__ = ("boxes", "chars", "dropped", "events", "lifts", "parts", "paths", "scores", "spans", "suspects")

    def __init__(self, source: str, everything: bool = False) -> None:
        self.paths: list[int] = []  # of each container, as a hash
        self.lifts: list[float] = []
        self.spans: list[list[int]] = []  # [first, end) in parts
        self.parts: list[str] = []  # decoded text; a block boundary is a space of its own
        self.events: list[tuple[float, int, int, int]] = []  # of each paragraph: value, own container, the one around it, end in parts
        self.boxes: list[int] = []  # the container around each
        self.suspects: list[list[int]] = []  # suspicion, [first, end) in parts, [first, end) in events, holds an article
        self._read(source, everything)
        self.chars = [0, *accumulate(len(x) if x.strip() else 0 for x in self.parts)]
        self.dropped = self._judged()
        self.scores = self._scored()

    def _read(self, source: str, everything: bool) -> None:
        # an open element: tag, path, own container or -1, skip, link, suspect or -1, container around or in it, within article or main
        stack: list[tuple] = [("", 0, -1, False, False, -1, -1, False)]
        text: list[list[float]] = [[0.0, 0.0]]  # of each open element: own characters outside and inside links
        places: dict[str, list[int]] = {}  # of the open elements of each tag
        doubted: list[int] = []  # open suspects
        at, end, parts = 0, len(source), self.parts

        def add(raw: str) -> None:
            top = stack[-1]
            if top[3] or not raw:
                return
            piece = entities.unescape(raw) if "&" in raw else raw
            parts.append(piece)
            if n := len(piece.strip()):
                text[-1][top[4]] += n + 20 * (piece.count(",") + piece.count("."))

        def close() -> None:
            tag, _, box, skip, _, suspect, _, _ = stack.pop()
            places[tag].pop()
            plain, linked = text.pop()
            if not skip:
                if tag in _BLOCK:
                    parts.append(" ")
                if tag in _PARAGRAPH or box >= 0:
                    if plain:
                        self.events.append((plain * plain / (plain + linked), box, stack[-1][6], len(parts)))
                else:
                    text[-1][0] += plain
                    text[-1][1] += linked
                if box >= 0:
                    self.spans[box][1] = len(parts)
            if suspect >= 0:
                self.suspects[suspect][2], self.suspects[suspect][4] = len(parts), len(self.events)
                doubted.pop()

        def up_to(names: set[str], barrier: set[str]) -> None:
            place = max((places[n][-1] for n in names if places.get(n)), default=-1)
            if place > 0 and place > max((places[n][-1] for n in barrier if places.get(n)), default=-1):
                while len(stack) > place:
                    close()

        while at < end:
            m = _TOKEN.search(source, at)
            if m is None:
                add(source[at:])
                break
            if m.start() > at:
                add(source[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                if tag == "p" and not places.get("p"):
                    parts.append(" ")
                elif tag not in _VOID:
                    up_to({tag}, set() if tag in _BLOCK else {"td", "th", "body"})
                continue
            if tag in _BLOCK:
                if tag in _CLOSES_P:
                    up_to({"p"}, _CONTAINER)
                if tag in _CLOSES:
                    up_to(_CLOSES[tag], _BARRIER)
                if not stack[-1][3]:
                    parts.append(" ")
            if tag in _VOID:
                continue
            if tag in _RAW:
                over = re.compile(rf"</{tag}\s*/?>", re.I).search(source, at)
                at = over.end() if over else end
                continue
            if tag == "html" or tag == "body" and places.get("body"):
                continue
            _, path, _, skip, link, _, around, inside = stack[-1]
            attributes, kind, suspect = (m[3] if m[2] else m[6]) or "", "", -1
            skip = skip or tag in _SKIP and (not everything or tag == "head")
            if not skip and attributes.strip(" /"):
                hidden, level, kind = self._named(tag, attributes, inside)
                skip = hidden and not everything
            else:
                level = 0
            if tag == "header" and not inside and not everything:
                skip = True
            level = max(level, tag == "form")
            box, own = -1, tag in ("article", "main") and level < 2
            if not skip:
                if level and not everything:
                    suspect = len(self.suspects)
                    doubted.append(suspect)
                    self.suspects.append([level, len(parts), -1, len(self.events), -1, 0])
                if tag in _BLOCK:
                    path = xxhash.xxh3_64_intdigest((tag + kind).encode("utf-8", "surrogatepass"), path)
                    if tag in _CONTAINER:
                        box = len(self.paths)
                        self.paths.append(path)
                        self.lifts.append(1.25 if tag in ("article", "main") or kind and _CONTENT.match(kind) else 1.0)
                        self.boxes.append(around)
                        self.spans.append([len(parts), -1])
                if own:
                    for i in reversed(doubted):  # those around it that don't know of an article yet
                        if self.suspects[i][5]:
                            break
                        self.suspects[i][5] = 1
            stack.append((tag, path, box, skip, link or tag == "a", suspect, box if box >= 0 else around, inside or own))
            places.setdefault(tag, []).append(len(stack) - 1)
            text.append([0.0, 0.0])
        while len(stack) > 1:
            close()

    @staticmethod
    def _named(tag: str, attributes: str, inside: bool) -> tuple[bool, int, str]:
        """(hidden, suspicion, class names for the path)."""
        hidden, kind, words = False, "", []
        for name, a, b, c, bare in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if bare or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                hidden = True
            elif name in ("class", "id", "role"):
                words += [own for w in value.split() if (own := [x for x in re.split(r"[^a-z]+", w) if x])]
                if name == "class" and value.split():
                    kind = "." + ".".join(sorted({re.sub(r"\d+", "#", w) for w in value.split()}))
        return hidden, 0 if tag in ("html", "body", "main") else suspicion(tag, words, inside), kind

    def _judged(self) -> list[tuple[int, int]]:
        """Spans in parts of the suspects that go, in order, none within another."""
        worth, out = [0.0, *accumulate(e[0] for e in self.events)], []
        for level, low, high, first, last, holds in self.suspects:
            if out and high <= out[-1][1]:
                continue
            share = max((worth[last] - worth[first]) / worth[-1] if worth[-1] else 0.0, (self.chars[high] - self.chars[low]) / self.chars[-1] if self.chars[-1] else 0.0)
            if share < (NAMED if level == 2 and not (holds and share >= 0.5) else 0.0 if holds else MENTIONED):
                out.append((low, high))
        return out

    def _scored(self) -> list[float]:
        """Of each container: its paragraphs, and half and a quarter of those in containers within it; without what goes."""
        scores, gone, i = [0.0] * len(self.paths), self.dropped, 0
        ends = [high for _, high in gone]
        for value, box, around, place in self.events:
            i = bisect_left(ends, place)
            if i < len(gone) and gone[i][0] < place:
                continue
            share = 1.0
            if box >= 0:
                scores[box] += value
                share = 0.5
            outer = around
            while outer >= 0 and share >= 0.2:
                scores[outer] += share * value
                share, outer = share / 2, self.boxes[outer]
        return scores

    def best(self) -> int | None:
        """The path of the container with the highest score; the outer one of equals."""
        ranked = [(s * lift, -i) for i, (lift, s) in enumerate(zip(self.lifts, self.scores, strict=True)) if s > 0]
        return self.paths[-max(ranked)[1]] if ranked else None

    def held(self) -> list[int]:
        """Distinct paths of containers that have any text, suspects within them left out."""
        gone = [0, *accumulate(self.chars[high] - self.chars[low] for low, high in self.dropped)]
        ends = [high for _, high in self.dropped]

        def text(low: int, high: int) -> int:
            first, last = bisect_left(self.dropped, (low, -1)), bisect_right(ends, high)
            inside = gone[last] - gone[first] if last > first and self.dropped[first] != (low, high) else 0
            return self.chars[high] - self.chars[low] - inside

        return list(dict.fromkeys(p for p, (low, high) in zip(self.paths, self.spans, strict=True) if text(low, high)))

    def _pieces(self, low: int, high: int) -> Iterator[str]:
        """The text of a span without the suspects that lie within it."""
        for first, last in self.dropped[bisect_left(self.dropped, (low, -1)) :]:
            if first >= high:
                break
            if last <= high and (first, last) != (low, high):
                yield from self.parts[low:first]
                low = last
        yield from self.parts[low:high]

    def text_of(self, path: int) -> str | None:
        """Text of all containers with the path, in page order; null if there is none with text."""
        pieces, covered = [], -1
        for p, (low, high) in zip(self.paths, self.spans, strict=True):
            if p == path and low >= covered:
                pieces.append("".join(self._pieces(low, high)))
                covered = high
        return " ".join(" ".join(pieces).split()) or None

    def main_text(self, shares: dict[int, float]) -> str:
        for path in sorted({p for p in self.paths if p in shares}.intersection(self.held()), key=lambda p: (-shares[p], p)):
            if found := self.text_of(path):
                return found
        own = self.best()
        return (self.text_of(own) if own else None) or " ".join("".join(self._pieces(0, len(self.parts))).split())


def main_text_of(source: str, shares: dict[int, float]) -> str:
    """The main text; if all of a page seems to be something else, its text outside scripts and styles."""
    return Page(source).main_text(shares) or (" ".join("".join(Page(source, everything=True).parts).split()) if source else "")


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def signed(path: int) -> int:
    return path - (1 << 64) if path >> 63 else path


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each host's paths, in some pages at a time: the pages that have it, and those that vote for it."""
    for b in slices(batches, 200):
        have, best = Counter(), Counter()
        for host, x in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            page = Page(x or "")
            have.update((host, signed(p)) for p in set(page.paths))
            if found := page.best():
                best[host, signed(found)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in have], pa.string()), pa.array([k[1] for k in have], pa.int64()), pa.array([best[k] for k in have], pa.int64()), pa.array(list(have.values()), pa.int64())], names=["host", "path", "n", "pages"])


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, pages, share) of each path that a host's pages voted for; one page more in the share makes many votes count more."""
    seen = pages.select(host_of(url).alias("host"), col(html).alias("html")).mapInArrow(_vote, "host string, path long, n long, pages long")
    voted = seen.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages")).where("n > 0")
    return materialize(voted.select("host", "path", "pages", (F.col("n") / (F.col("pages") + 1)).alias("share")), "host-paths")


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct paths of each page that have a text."""
    for b in slices(batches, 200):
        rows, paths = [], []
        for i, x in enumerate(b.column("html").to_pylist()):
            page = Page(x or "")
            own = [signed(p) for p in page.held()]
            rows += [i] * len(own)
            paths += own
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("host").take(at), b.column("h").take(at), pa.array(paths, pa.int64())], names=["host", "h", "path"])


def _chosen(rows: DataFrame, votes: DataFrame) -> DataFrame:
    """rows (host, h: a hash of the page, html) with that path of each page which has the highest share, where there is one."""
    held = materialize(rows.select("host", "h", "html").mapInArrow(_held, "host string, h long, path long"), "page-paths")
    first = spread_join(held, votes, ["host", "path"], "pages").groupBy("host", "h").agg(F.min(F.struct(-F.col("share"), "path")).alias("first"))
    return rows.join(first.select("host", "h", F.col("first.path").alias("path")), ["host", "h"], "left")


def extract_main_text(pages: DataFrame, url: str = "url", html: str = "html", path_bytes: int = PATH_BYTES) -> DataFrame:
    """pages with html replaced by main_text and n_chars; all rows and other columns stay."""
    pages = without(pages, "main_text", "n_chars")
    names = [c for c in pages.columns if c != html]
    votes = host_paths(pages, url, html)
    few = (votes.agg(F.sum(F.octet_length("host") + 16)).first()[0] or 0) <= path_bytes
    rows = pages.select(*[col(c).alias(f"{OWN}{i}") for i, c in enumerate(names)], host_of(url).alias("host"), F.xxhash64(col(html)).alias("h"), col(html).alias("html"))
    known: dict[str, dict[str, float]] = {}
    if few:
        for r in votes.toLocalIterator():
            known.setdefault(r["host"], {})[r["path"] % (1 << 64)] = r["share"]
        rows = rows.withColumn("path", F.lit(None).cast("long"))
    else:
        rows = _chosen(rows, votes)
    shared = pages.sparkSession.sparkContext.broadcast(known)
    shape = pages.select(*map(col, names)).schema.add("main_text", "string").add("n_chars", "long")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 200):
            hosts, own = (b.column(c).to_pylist() for c in ("host", "path"))
            found = [main_text_of(x or "", {p % (1 << 64): 1} if p is not None else shared.value.get(h, {})) for x, h, p in zip(b.column("html").to_pylist(), hosts, own, strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(f"{OWN}{i}") for i in range(len(names))], pa.array(found, pa.string()), pa.array(map(len, found), pa.int64(), size=len(found))], names=[*names, "main_text", "n_chars"])

    return rows.mapInArrow(extract, shape)
