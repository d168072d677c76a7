"""HTML main-text extraction by consensus host paths (operator 7).

Each page's containers are scored by the running text their blocks hold; the
best one's path, tags and classes with numbers generalised, is the page's
vote.  Spark counts the votes per host, and every page is extracted again at
its host's winning path; a page without that path, or with little of its text
there, uses its own best one.

A container is widened to the one around it while the text that adds is
running text, so an introduction or an end in containers of their own stays.

Main text leaves out menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments.  Character references are
decoded, white space inside a block becomes one space, and the blocks are
joined by a newline in page order.  A null or empty html gives an empty text.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricescope.llm.common import cut

#: Winning paths are broadcast only up to this many hosts; beyond it they are joined by a shuffle.
BROADCAST_HOSTS = 50_000

# Fixed lists of HTML elements by their use.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp svg math".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small "
             "span strike strong sub sup time tt u var wbr".split())
DROPPED = set("head nav header footer aside form button select dialog menu object audio video canvas map".split()) | RAW
DROPPED_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
DROPPED_WORDS = set("nav navbar navigation menu header footer sidebar aside notice notices cookie cookies consent gdpr banner ad ads "
                    "advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus replies "
                    "share sharing social related breadcrumb breadcrumbs subscribe subscription newsletter popup modal login "
                    "signup widget masthead toolbar pagination pager skip adsense commenter commenters response responses discussion".split())
#: Words of place and shape: beside a dropped word, or grown together with one ("commentlist"), they say no more than it.
PLACE_WORDS = set("site page main top bottom left right upper lower primary secondary global local inner outer container wrapper wrap "
                  "box bar list area block section region item content links menus buttons icons text slot unit card thread".split())
#: A name with one of these words is about what the page has or how it is, not about what the element is ("has-sidebar", "ad-free").
STATE_WORDS = set("has have with without no not non free less open opened closed enabled disabled active visible ready loaded on off".split())
#: What an article has of its own: its header or footer is not the site's.
ARTICLE_WORDS = set("post entry article story title chapter".split())
#: Names of what readers add.
READER_WORDS = set("comment comments commenter commenters disqus replies response responses discussion".split())
#: Elements that the share of the running text cannot save, if their name says nothing else.
NEVER_MAIN = READER_WORDS | set("nav footer menu dialog button select notice notices cookie cookies consent gdpr banner ad ads advert "
                                "adverts advertisement advertising sponsor sponsored promo promotion share sharing social "
                                "related breadcrumb breadcrumbs subscribe subscription newsletter popup modal login signup navbar "
                                "navigation pagination pager adsense".split())
#: A block of at least so many characters outside links is running text.
PROSE = 40
CONTAINERS = set("article main section div td body".split())
#: An open element of the value set ends when the key opens.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}}
#: An element of this kind keeps what stands outside from being closed by what opens inside.
SCOPES = set("table ul ol dl div article main section body html blockquote td th".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
_NUMBER = re.compile(r"[0-9]+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', text, ''), ('open', tag, attributes) and ('close', tag, '') in page order; raw elements are skipped whole."""
    i, n = 0, len(page)
    while i < n:
        j = page.find("<", i)
        if j < 0:
            j = n
        if j > i:
            yield "text", page[i:j], ""
        if j >= n:
            return
        nxt = page[j + 1:j + 2]
        if page.startswith("<!--", j):
            k = page.find("-->", j + 4)
            i = n if k < 0 else k + 3
        elif nxt in ("!", "?"):
            k = page.find(">", j)
            i = n if k < 0 else k + 1
        elif m := _TAG.match(page, j):
            tag, i = m[2].lower(), m.end()
            if m[1]:
                yield "close", tag, ""
            elif tag in RAW:
                if not m[3].endswith("/"):
                    end = re.compile(f"</{re.escape(tag)}[^>]*>?", re.I).search(page, i)
                    i = end.end() if end else n
            else:
                yield "open", tag, m[3]
        elif nxt == "/" or nxt.isalpha():  # a tag whose quotes never close
            k = page.find(">", j)
            i = n if k < 0 else k + 1
        else:
            yield "text", "<", ""
            i = j + 1


def _root(word: str) -> str | None:
    """The dropped word that ``word`` is, or begins or ends with where the rest is a word of place ("commentlist")."""
    if word in DROPPED_WORDS:
        return word
    for k in range(3, len(word) - 2):
        for part, rest in ((word[:k], word[k:]), (word[k:], word[:k])):
            if part in DROPPED_WORDS and rest in PLACE_WORDS:
                return part
    return None


@functools.lru_cache(maxsize=65536)
def _furniture(name: str) -> tuple[frozenset[str], bool]:
    """The dropped words in a class or id (none if it tells of a state, or of an article's own header), and whether
    it says nothing else."""
    words = [w.lower() for w in _WORD.findall(name) if not w.isdigit()]
    if (whole := name.lower().strip("-_0123456789")) in DROPPED_WORDS:
        words = [whole]
    if not STATE_WORDS.isdisjoint(words):
        return frozenset(), False
    roots = {w: r for w in words if (r := _root(w))}
    if not ARTICLE_WORDS.isdisjoint(words):
        roots = {w: r for w, r in roots.items() if r not in ("header", "footer", "menu", "nav", "skip", "widget")}
    return frozenset(roots.values()), all(w in roots or w in PLACE_WORDS for w in words)


def _named(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """(path step, dropped, never main text): the tag with its generalised classes, and what its tag and attributes say."""
    if not attrs or "=" not in attrs:
        return tag, tag in DROPPED or attrs.strip().lower() == "hidden", tag in NEVER_MAIN
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    classes = got.get("class", "").split()
    step = ".".join([tag, *sorted({_NUMBER.sub("#", c) for c in classes})])
    if tag in ("html", "body", "article", "main"):
        return step, False, False
    said = [_furniture(name) for name in [*classes, *got.get("id", "").split()]]
    words = set().union(*(w for w, _ in said))
    never = set().union(*(w if only else w & READER_WORDS for w, only in said)) & NEVER_MAIN
    dropped = bool(tag in DROPPED or words or got.get("role", "").lower() in DROPPED_ROLES or "hidden" in got)
    return step, dropped, tag in NEVER_MAIN or bool(never) or "hidden" in got


def _scan(page: str) -> tuple[list[tuple], list[list[bool]], bool]:
    """Blocks, dropped elements, and whether an article or main stands outside these.

    A block is (path, [(text, characters inside links, dropped elements
    around it)]); a dropped element is [never main text, holds an article,
    holds a main].
    """
    stack: list[tuple[str, str, tuple[int, ...]]] = []  # tag, step, dropped elements here and above
    buf: list[tuple[str, int, tuple[int, ...]]] = []
    found: list[tuple] = []
    gone: list[list[bool]] = []
    links, outside = 0, False

    def flush() -> None:
        if buf:
            found.append((tuple(s[1] for s in stack if s[0] not in INLINE), buf.copy()))
            buf.clear()

    def leave(at: int) -> None:
        nonlocal links
        links -= sum(t[0] == "a" for t in stack[at:])
        del stack[at:]

    for kind, what, attrs in tokens(page):
        above = stack[-1][2] if stack else ()
        if kind == "text":
            text = entities.unescape(what) if "&" in what else what
            buf.append((text, len(text.strip()) if links else 0, above))
            continue
        if what == "br":
            buf.append((" ", 0, above))
            continue
        if what not in INLINE:
            flush()
        if kind == "open":
            if what not in INLINE:
                ends = CLOSES.get(what, set()) | {"p"}
                for at in range(len(stack) - 1, -1, -1):
                    if stack[at][0] in ends:
                        leave(at)
                        break
                    if stack[at][0] in SCOPES:
                        break
            if what in VOID or attrs.endswith("/") and what not in CONTAINERS | {"p"}:
                continue
            step, dropped, never = _named(what, attrs)
            above = stack[-1][2] if stack else ()
            if what in ("article", "main"):
                outside |= not above
                for i in above:
                    gone[i][1 if what == "article" else 2] = True
            if dropped:
                gone.append([never, False, False])
                above = (*above, len(gone) - 1)
            stack.append((what, step, above))
            links += what == "a"
        else:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == what:
                    leave(at)
                    break
                if what in INLINE and stack[at][0] not in INLINE:
                    break
    flush()
    return found, gone, outside


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters inside links) of every block outside dropped elements, in page order.

    An element is not dropped after all if it holds a main, or the page's
    articles while none stands outside, or, on a page with neither outside,
    more than half of the running text; what is never main text (comments,
    notices, adverts, menus) only goes by the first two.
    """
    found, gone, outside = _scan(page)
    lost = {i for i, (_, article, main) in enumerate(gone) if not (main or article and not outside)}
    if lost and not outside:
        total, inside = 0, [0] * len(gone)
        for _, parts in found:
            prose = _prose(" ".join("".join(p[0] for p in parts).split()), sum(p[1] for p in parts))
            total += prose
            for i in parts[0][2] if prose else ():
                inside[i] += prose
        lost -= {i for i in lost if not gone[i][0] and 2 * inside[i] > total}
    for path, parts in found:
        if lost:
            parts = [p for p in parts if not p[2] or lost.isdisjoint(p[2])]
        if text := " ".join("".join(p[0] for p in parts).split()):
            yield path, text, sum(p[1] for p in parts)


def _prose(text: str, linked: int) -> int:
    """Characters of running text of a block: none below ``PROSE``."""
    worth = len(text) - 2 * linked
    return worth if worth >= PROSE else 0


def best_path(page: str | None) -> tuple[str, float]:
    """Path of the container whose blocks hold the most running text, widened to what it is part of, and its score."""
    return _best(list(blocks(page or "")))


def _best(got: list[tuple[tuple[str, ...], str, int]]) -> tuple[str, float]:
    score: dict[tuple[str, ...], float] = defaultdict(float)
    for path, text, linked in got:
        at = [i for i, s in enumerate(path) if s.split(".")[0] in CONTAINERS]
        worth = max(0, len(text) - 2 * linked)
        for rank, i in enumerate(reversed(at[-3:])):  # the nearest container counts most
            score[path[:i + 1]] += worth / (1 + rank)
    if not score:
        return "", 0.0
    top, worth = min(score.items(), key=lambda x: (-x[1], x[0]))
    # An article or main element around the densest container is the whole of what it is part of.
    whole = [i for i, s in enumerate(top) if s.split(".")[0] in ("article", "main")]
    return ">".join(top[:whole[-1] + 1] if whole else _widened(top, got)), worth


def _widened(top: tuple[str, ...], got: list[tuple[tuple[str, ...], str, int]]) -> tuple[str, ...]:
    """The outermost container around ``top`` whose text outside of what is inside it so far is running text.

    That is: more of it stands outside links than inside, and it has a block
    of ``PROSE`` characters, or below body any block of the container's own
    (a heading beside the containers, say).
    """
    for i in range(len(top) - 2, -1, -1):
        if (tag := top[i].split(".")[0]) not in CONTAINERS:
            continue
        rest = [(p, t, linked) for p, t, linked in got if p[:i + 1] == top[:i + 1] and p[:len(top)] != top]
        own = [p for p, t, linked in rest if tag != "body" and linked == 0 and not any(s.split(".")[0] in CONTAINERS for s in p[i + 1:])]
        if sum(len(t) - 2 * linked for _, t, linked in rest) > 0 and (own or any(_prose(t, linked) for _, t, linked in rest)):
            top = top[:i + 1]
    return top


def extract(page: str | None, path: str | None) -> str:
    """Main text inside the elements of a path.

    A path that holds less than half of the page's running text gives way
    to an article or main element that is the page's own best path and holds
    more than twice as much (a container of another name does not outvote
    the host); a page without either gives all its blocks.
    """
    got = list(blocks(page or ""))

    def inside(want: str | None) -> list[tuple]:
        steps = tuple(want.split(">")) if want else None
        return [x for x in got if x[0][:len(steps)] == steps] if steps else []

    worth = lambda rows: sum(_prose(t, linked) for _, t, linked in rows)
    mine = inside(path)
    if not mine or 2 * worth(mine) < worth(got):
        best = _best(got)[0]
        if not mine or best.split(">")[-1].split(".")[0] in ("article", "main") and 2 * worth(mine) < worth(inside(best)):
            mine = inside(best)
    return "\n".join(t for _, t, _ in mine or got)


def host(url: Column) -> Column:
    """Lower-cased host of a URL, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [best_path(h.as_py()) for h in b.column("html")]
        yield pa.record_batch({"host": b.column("host"), "path": pa.array([p for p, _ in got], pa.string()),
                               "score": pa.array([s for _, s in got], pa.float64())})


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            text = [extract(h.as_py(), p.as_py()) for h, p in zip(part.column("html"), part.column("path"), strict=True)]
            yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"), "host": part.column("host"),
                                   "path": part.column("path"), "text": pa.array(text, pa.string()),
                                   "n_chars": pa.array([len(t) for t in text], pa.int64())})


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path) with the most votes of the host's pages; of equal ones the greater summed score, then the first path."""
    votes = (pages.mapInArrow(_vote, "host string, path string, score double").where("path <> ''")
             .groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(F.round("score").cast("long")).alias("score")))
    first = F.min(F.struct((-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "path")).alias("w")
    return votes.groupBy("host").agg(first).select("host", "w.path")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, host, path (the host's winning one), text, n_chars.

    Repeated rows are kept; pages without a url form a host of their own.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    rows = rows.withColumn("host", host(F.col("url")))
    won = cut(host_paths(rows.select("host", "html")), "host-paths")
    few = won.count() <= BROADCAST_HOSTS
    found = rows.join(F.broadcast(won) if few else won, "host", "left")
    id_type = rows.schema["page_id"].dataType.simpleString()
    return found.mapInArrow(_extract, f"page_id {id_type}, url string, host string, path string, text string, n_chars long")
