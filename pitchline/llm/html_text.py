"""Main text of web pages by equivalence-class template deduction.

Pages of one host are read together, large hosts in chunks of about
``chunk_pages`` pages by a hash of the page id, so no task holds a host whole.
A page is a sequence of tokens: tags, named by their path of open elements with
classes, and words, named by the path they stand in. Tokens that share one
occurrence vector (how often they occur on each page of the chunk) form an
equivalence class. A class is valid if it is large and frequent enough, if on every
page its tokens come round in the same order, and if each of its rounds falls into
one gap of the class it is nested in. Valid classes, nested, are the template; what
stands between their tokens are the slots.

Runs of text all of whose words are in the template are fixed text of the site and
go; a run with any other word is a slot and stays whole. Slots are kept by their
place in the template: gaps inside navigation, headers, footers, asides, forms,
adverts, notices, comments and scripts go, unless a form or an element of such a
name holds the page's only article (or main) and most of its text, or all its text, and if the page has an article (or
main) element, its gaps alone are kept. Inside such an element a run is a token
as a whole: it can be in the template if it stands at one place on most pages of
the chunk, of which there must be twice ``least_pages`` (a single word in common is
data, so pages can't lose text that they happen to share), and if a page would lose
over half of its article that way, the article is a copy and stays. Chunks of fewer
pages have tag and class names alone to tell text inside an article. With fewer than ``least_pages`` pages no words are fixed at all.

Defined cases: null or empty html gives an empty text; a null url, or one without
a host, is of the host ''; tags that are not closed end with the element around
them; equal rows each give a row; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.url_filter import host_of
from pitchline.settings import materialize_counted

#: Hosts of over a chunk of pages that are broadcast at most; each is a name and a number.
MOST_BROADCAST = 500_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_CLOSED_BY_SELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
#: Elements, and words of class, id and role names, that hold no article text.
_DROPPED = frozenset(
    "head nav header footer aside script style noscript template button select textarea iframe svg canvas object dialog menu title xmp noembed noframes".split()
)
_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert popup modal
    overlay newsletter subscribe subscription sidebar aside nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer comment
    comments commentary discussion disqus reply replies respond related recommended share sharing social login signup search pagination pager
    toolbar complementary contentinfo""".split()
)
_CONTENT = frozenset(("article", "main"))
#: Class names that tell a state of the page or what it has, not what the block is.
_STATE = re.compile(r"(?:^|\s)(?:(?:has|with|no|is|show|hide)[-_]\S+|\S+[-_](?:open|closed|enabled|disabled|on|off|left|right))(?=\s|$)", re.I)


class Page:
    """Tokens of one page: (name, text or None for a tag, outside dropped elements, inside an article)."""

    __slots__ = ("has_content", "held", "inner", "tokens")

    def __init__(self, source: str):
        self._read(source, frozenset())
        if not self.has_content and (wrappers := self._wrappers()):
            self._read(source, wrappers)

    def _wrappers(self) -> frozenset[int]:
        """Elements dropped by name alone, or forms, that hold the page's article, or all its text."""
        outside = sum(len(text.strip()) for _, text, kept, _ in self.tokens if text and kept)
        if self.inner and (best := max(self.inner, key=lambda c: (c[0], c[1])))[1] > outside:  # main before article, then the one of most text
            return best[2]
        if self.held and not outside:
            return max(self.held.values(), key=lambda c: c[0])[1]
        return frozenset()

    def _read(self, source: str, released: frozenset[int]) -> None:
        """``released`` numbers elements that are not dropped by their name."""
        self.tokens: list[tuple[str, str | None, bool, bool]] = []
        self.has_content = False
        #: articles in elements dropped by name: [is main, length of text, numbers of these elements], and such elements
        self.inner: list[list] = []
        self.held: dict[int, list] = {}
        # tag, path, dropped, content, dropped for good, numbers of elements dropped by name, article in them
        stack: list[tuple] = [("", "", False, False, False, frozenset(), None)]
        at = number = 0
        while found := _TOKEN.match(source, at):
            at = found.end()
            tag = found[2]
            if tag is None:
                text = found[0]
                if text[0] != "<" or len(text) == 1:
                    self._text(text, stack[-1])
                continue
            tag = tag.lower()
            if found[1]:
                self._close(tag, stack)
                continue
            if tag in _CLOSES_P:
                self._shut("p", stack, _CONTENT | {"td", "th", "table", "button"})
            if tag in _CLOSED_BY_SELF:
                self._shut(tag, stack, _CLOSED_BY_SELF[tag])
            _, path, dropped, content, gone, by_name, inner = stack[-1]
            number += 1
            names = " ".join(sorted(m[2].strip("\"'") for m in _ATTRIBUTE.finditer(found[3]))) if found[3] else ""
            content_here = content or (tag in _CONTENT and not dropped)
            gone = gone or tag in _DROPPED
            named = tag == "form"
            if names and not named and tag not in ("html", "body", "main") and not (tag == "article" and not content):
                named = not _NAMES.isdisjoint(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", _STATE.sub(" ", names)).lower()))
            named = named and number not in released
            if tag in _CONTENT and dropped and not (gone or content or inner):
                inner = [tag == "main", 0, by_name]
                self.inner.append(inner)
            if named and not gone and not content:
                by_name = by_name | {number}
                self.held[number] = [0, by_name]
            dropped = dropped or gone or named
            path = f"{path}/{tag}.{names}" if names else f"{path}/{tag}"
            self.tokens.append((f"<{path}", None, False, content_here))
            if tag not in _INLINE:
                self.tokens.append(("", " ", not dropped, content_here))
            if tag in _VOID or found[3].endswith("/") and tag in ("svg", "path"):
                continue
            entry = (tag, path, dropped, content_here and not dropped, gone, by_name, inner)
            self.has_content |= entry[3]
            if tag in _RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                self.tokens.append((f">{path}", None, False, content_here))
                continue
            stack.append(entry)

    def _text(self, text: str, top: tuple) -> None:
        if top[5] and not top[4]:
            for number in top[5]:
                self.held[number][0] += len(text.strip())
            if top[6]:
                top[6][1] += len(text.strip())
        self.tokens.append((top[1], entities.unescape(text), not top[2], top[3]))

    def _close(self, tag: str, stack: list) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == tag:
                for _, path, dropped, content, *_ in reversed(stack[k:]):
                    self.tokens.append((f">{path}", None, False, content))
                    if tag not in _INLINE:
                        self.tokens.append(("", " ", not dropped, content))
                del stack[k:]
                return
            if tag in _INLINE and stack[k][0] not in _INLINE:
                return

    def _shut(self, tag: str, stack: list, scope) -> None:
        """Close an open ``tag`` that no element of ``scope`` separates from here."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == tag:
                self._close(tag, stack)
                return
            if stack[k][0] in scope:
                return

    def content_runs(self):
        """Places and texts of the runs that article elements keep."""
        for name, text, kept, content in self.tokens:
            if text is not None and kept and content and name and text.strip():
                yield name, " ".join(text.split())

    def words(self, shared: frozenset = frozenset()):
        """Tags and words in order, as token names; inside article elements only words of ``shared`` runs."""
        for name, text, kept, content in self.tokens:
            if text is None:
                yield name
            elif name and not content:
                for word in text.split():
                    yield f"{name} {word}"
            elif name and kept and shared and (name, " ".join(text.split())) in shared:
                yield from _run_words(name, " ".join(text.split()))

    def text(self, fixed: frozenset[str], shared: frozenset = frozenset()) -> str:
        """The kept slots, without runs of text made of words that ``fixed`` names alone."""
        parts, lost, held = [], 0, 0
        for name, text, kept, content in self.tokens:
            if text is None or not kept or (self.has_content and not content):
                continue
            if fixed and name and text.strip():
                run = " ".join(text.split())
                held += len(run)
                names = (f"{name} {word}" for word in text.split()) if not content else _run_words(name, run) if (name, run) in shared else ("",)
                if all(word in fixed for word in names):
                    text = " "
                    lost += len(run)
            parts.append(text)
        if shared and self.has_content and 2 * lost > held:  # a copied article, not a site's fixed text
            return self.text(frozenset())
        return " ".join("".join(parts).split())


def _run_words(name: str, run: str) -> list[str]:
    """Token names of a run inside an article element, whose words count with the whole run alone."""
    return [f"{name} {k} {run}" for k in range(run.count(" ") + 1)]


def shared_runs(pages: list[Page], least_pages: int = 4, least_share: float = 0.6) -> frozenset[tuple[str, str]]:
    """Runs inside article elements that stand at one place on most of ``pages``, of which twice ``least_pages`` are asked."""
    if len(pages) < 2 * least_pages:
        return frozenset()
    on = Counter(run for page in pages for run in set(page.content_runs()))
    return frozenset(run for run, n in on.items() if n >= max(2 * least_pages, least_share * len(pages)))


def template(
    pages: list[Page], least_pages: int = 4, least_share: float = 0.6, least_size: int = 3, shared: frozenset = frozenset()
) -> frozenset[str]:
    """Names of all tokens of the template that ``pages`` share."""
    if len(pages) < least_pages:
        return frozenset()
    places: dict[str, dict[int, list[int]]] = defaultdict(dict)
    for number, page in enumerate(pages):
        for at, name in enumerate(page.words(shared)):
            places[name].setdefault(number, []).append(at)
    classes: dict[tuple, list[str]] = defaultdict(list)
    for name, by_page in places.items():
        if len(by_page) >= max(least_pages, least_share * len(pages)):
            classes[tuple((number, len(at)) for number, at in by_page.items())].append(name)
    # classes on more pages first: an inner class is nested in one found before it
    order = sorted(classes.items(), key=lambda c: (-len(c[0]), sum(n for _, n in c[0]), -len(c[1]), c[1][0]))
    valid: list[list[str]] = []
    for vector, names in order:
        names = _in_order(names, vector, places)
        if len(names) >= least_size and _nested(names, vector, valid, places):
            valid.append(names)
    return frozenset(name for names in valid for name in names)


def _in_order(names: list[str], vector: tuple, places: dict) -> list[str]:
    """The class without tokens that break the order of its rounds on some page."""
    first, _ = vector[0]
    names = sorted(names, key=lambda name: places[name][first][0])
    out: list[str] = []
    for name in names:
        if not out or all(
            places[out[-1]][number][k] < places[name][number][k] and (k + 1 == n or places[name][number][k] < places[out[0]][number][k + 1])
            for number, n in vector
            for k in range(n)
        ):
            out.append(name)
    return out


def _nested(names: list[str], vector: tuple, valid: list[list[str]], places: dict) -> bool:
    """Whether every round falls into one gap of each class found before."""
    for outer in valid:
        gaps = set()
        for number, n in vector:
            if number not in places[outer[0]]:
                continue
            rounds = len(places[outer[0]][number])
            if rounds > 1:
                marks = sorted(at for name in outer for at in places[name][number])
            else:
                marks = [places[name][number][0] for name in outer]
            for k in range(n):
                start, end = _gap(marks, places[names[0]][number][k]), _gap(marks, places[names[-1]][number][k])
                if n > 1 and start != end and rounds == 1:
                    return False
                gaps.add((start if rounds == 1 else start % len(outer), (end if rounds == 1 else end % len(outer))))
        if n > 1 and len({g for g, _ in gaps}) > 1:
            return False
    return True


def _gap(marks: list[int], at: int) -> int:
    from bisect import bisect_left

    return bisect_left(marks, at)


def _extract(least_pages: int):
    def run(pages: pa.Table) -> pa.Table:
        sources = [h or "" for h in pages.column("html").to_pylist()]
        read = [Page(h) for h in sources]
        shared = shared_runs(list(dict(zip(sources, read, strict=True)).values()), least_pages)  # a page given twice is one
        fixed = template(read, least_pages, shared=shared)
        texts = [page.text(fixed, shared) for page in read]
        return pa.table(
            {
                "page_id": pages.column("page_id"),
                "url": pages.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            }
        )

    return run


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", chunk_pages: int = 256, least_pages: int = 4) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    given = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host")
    )
    large = (
        given.groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > chunk_pages)
        .select(F.col("host").alias("_host"), F.ceil(F.col("n") / chunk_pages).cast("long").alias("chunks"))
    )
    large, hosts = materialize_counted(large, "html-hosts")
    if hosts <= MOST_BROADCAST:  # else Spark joins as it sees fit, which shuffles the pages once more
        large = F.broadcast(large)
    chunk = F.pmod(F.xxhash64("page_id", "url"), F.coalesce("chunks", F.lit(1)))
    dealt = given.join(large, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "host", chunk.alias("chunk"))
    # dealt by host alone, as a join leaves them, all chunks of a host would meet in one task
    return dealt.repartition("host", "chunk").groupBy("host", "chunk").applyInArrow(_extract(least_pages), "page_id long, url string, text string, n_chars long")
