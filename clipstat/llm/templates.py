"""Main-text extraction by equivalence-class template deduction.

Pages of one host are read side by side.  A token is a tag or a word together with the path of
container elements it stands in.  The occurrence vector of a token says how often it occurs on each
page; tokens with equal vectors that are on at least half of the pages form an equivalence class.
A class is valid if its tokens come in the same order on every page (round after round, if they
repeat); tokens that break the order are left out.  Valid classes are nested: the class on every
page once is the skeleton, and another class belongs to the template if all its occurrences lie in
one gap between neighbours of a class that is already in.  What lies between template tokens are the
slots.

A slot is known by the template elements around it.  Slots in navigation, page headers and footers,
sidebars, forms, scripts, adverts, notices and reader comments are dropped.  If the template (or, on a
host whose pages share none, the page) has an article, main or article-body element, its slots are
the main text, otherwise all slots that are left, without the template's own words.

Inside the main region the template decides as well.  A container that every
page has equally often and that holds no slot, only text that the template has too, is dropped whatever its
class is called; so is one whose slots are links only, on every page (a menu).  Lists, tables and
paragraphs that merely repeat are article text and stay.  A container that only its class, id or role
marks is dropped if ``MIN_PAGES`` pages have it, so that a section of one article stays.  Where the pages
are too few for a template, the marks alone decide.

The pages of a host meet in groups of about ``GROUP_PAGES``, dealt by a hash of the page, so which pages are
compared depends neither on their length nor on Spark's partitions, and a host with a large share of all
rows is dealt over many tasks.  A group is held as compressed pages and 64-bit tokens.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.llm.common import map_rows, stage
from clipstat.llm.urls import host_and_path

GROUP_PAGES = 128
MIN_PAGES = 3          # distinct pages from which words can be told to be template

# Elements whose content is never text, elements that start a new block, and those that make up paths.
RAW = "script style noscript template svg math textarea select iframe object canvas title"
BLOCK = set("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
            "form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td "
            "tfoot th thead tr ul".split())
CONTAINER = set("html head body article aside details dialog div fieldset figure footer form header li main menu nav ol "
                "section table tbody td tfoot th thead tr ul button".split())
# Elements, and words of class, id or role, that mark a region as not the main text.
DROP_ELEMENT = set("head nav aside footer form menu dialog button fieldset".split())
DROP_WORD = set("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments complementary consent "
                "contentinfo cookie cookies disqus footer masthead menu modal nav navbar navigation newsletter notice notices "
                "popup promo promotion related replies reply respond share sidebar signup social sponsor sponsored subscribe "
                "toolbar widget".split())
MAIN_WORD = set("articlebody main".split())
# Containers of the main region that are dropped if the template has them without a slot, and those that
# are if it has them with links only.
REGION = set("details div header section".split())
MENU = REGION | set("ol ul table".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW.split())})\b(?:[^\"'>]|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>"
    r"|<[/!?a-z][^>]*(?:>|\Z)", re.S | re.I)
_MARK = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")


def _marks(attrs: str) -> tuple[str, frozenset]:
    """Class, id and role as text, and their lower-case words."""
    if not attrs or "=" not in attrs:
        return "", frozenset()
    found = [(k.lower(), v.strip("\"'").lower()) for k, v in _MARK.findall(attrs)]
    return ";".join(f"{k}={v}" for k, v in found), frozenset(w for _, v in found for w in _WORDS.split(v) if w)


class Page:
    """Tokens of one page: ``items`` are (is tag, value, path number, drop, in main, name of a tag or whether the
    text is a link's).

    ``drop`` is a tuple of path numbers inside the main region, if only words mark the elements there."""

    def __init__(self, source: str, paths: dict):
        self.items: list[tuple] = []
        self.has_main = False
        stack: list[tuple] = [("", False, False, paths.setdefault((), 0))]
        at, link = 0, False
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self.items.append((False, source[at:m.start()], stack[-1][3], stack[-1][1], stack[-1][2], link))
            at = m.end()
            name = m["name"]
            if not name:
                continue
            name = name.lower()
            if name == "a":
                link = not m["close"]
            if m["close"]:
                if name in CONTAINER:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == name:
                            del stack[i:]
                            break
                top = stack[-1]
                self.items.append((True, "/" + name, top[3], top[1], top[2], name))
                continue
            text, marks = _marks(m["attrs"])
            _, dropped, main, path = stack[-1]
            self.items.append((True, f"{name} {text}", path, dropped, main, name))
            if name in CONTAINER and not m["attrs"].endswith("/"):
                opens = (name in ("article", "main") or bool(marks & MAIN_WORD)) and "comment" not in marks and "comments" not in marks
                named = name in DROP_ELEMENT or (name == "header" and not main)
                drops = named or bool(marks & DROP_WORD)
                number = paths.setdefault((path, name, text), len(paths))
                if opens and not drops and not (main and dropped):
                    dropped, main = False, True  # also leaves regions that were never closed
                    self.has_main = True
                elif drops:
                    dropped = True if named or not main or dropped is True else (*(dropped or ()), number)
                stack.append((name, dropped, main, number))
        if at < len(source):
            self.items.append((False, source[at:], stack[-1][3], stack[-1][1], stack[-1][2], link))

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """64-bit tokens (path, tag), (path, word) and (path, whole text) in page order, and the texts as rows
        (path, first token, last token + 1, in main, link); the last token of a text is its whole."""
        out: list[int] = []
        texts: list[tuple] = []
        for tag, value, path, _, inside, link in self.items:
            if tag:
                out.append(tag_token(path, value))
            elif words := value.split():
                at = len(out)
                out += [hash((path, w)) for w in words]
                out.append(hash((path, "", *words)))
                texts.append((path, at, len(out), inside, link))
        return np.array(out, dtype=np.int64), np.array(texts, dtype=np.int64).reshape(-1, 5)


def tag_token(path: int, value: str) -> int:
    return hash((path, "<" + value))


def template(pages: list) -> tuple[set, set]:
    """Template tokens of a group of distinct pages, each a list of tokens, and the tokens of the steady classes,
    whose vector is the same number on every page."""
    n = len(pages)
    support: Counter = Counter()
    pages = [p.tolist() if isinstance(p, np.ndarray) else p for p in pages]
    for tokens in pages:
        support.update(set(tokens))
    frequent = {t for t, c in support.items() if 2 * c >= n}
    places = [defaultdict(list) for _ in pages]
    for tokens, where in zip(pages, places):
        for i, t in enumerate(tokens):
            if t in frequent:
                where[t].append(i)
    classes = defaultdict(list)
    for t in frequent:
        classes[tuple(len(w.get(t, ())) for w in places)].append(t)
    skeleton: set = set()
    steady = {t for vector, members in classes.items() if min(vector) == max(vector) for t in members}
    # largest support first: a class is nested into those that are in already
    order = sorted(classes.items(), key=lambda c: (-sum(1 for k in c[0] if k), max(c[0]), -len(c[1]), sorted(c[1])[0]))
    marks: list[list[int]] | None = None  # places of the skeleton on every page
    for vector, members in order:
        valid = _ordered(vector, members, places)
        if len(valid) < 2:
            continue
        if max(vector) == 1 and min(vector) == 1:
            skeleton.update(valid)
            marks = [sorted(w[t][0] for t in skeleton) for w in places]
        elif marks is None or _nested(vector, valid, places, marks):
            skeleton.update(valid)
    return skeleton, steady


def _ordered(vector: tuple, members: list, places: list) -> list:
    """Members in the order they have on every page; a member that breaks it is left out."""
    first = next(i for i, k in enumerate(vector) if k)
    rows = sorted(members, key=lambda t: places[first][t])
    kept: list = []
    for t in rows:
        ok = True
        for w, k in zip(places, vector):
            if not k:
                continue
            mine = w[t]
            if kept:
                last, head = w[kept[-1]], w[kept[0]]
                # after the member before it in the same round, before the first member of the next
                if any(a > b for a, b in zip(last, mine)) or any(b > a for b, a in zip(mine, head[1:])):
                    ok = False
                    break
        if ok:
            kept.append(t)
    return kept


def _nested(vector: tuple, members: list, places: list, marks: list[list[int]]) -> bool:
    """Whether all occurrences lie in one and the same gap of the skeleton on every page."""
    from bisect import bisect

    gap = None
    for w, k, cut in zip(places, vector, marks):
        if not k:
            continue
        low, high = bisect(cut, w[members[0]][0]), bisect(cut, w[members[-1]][-1])
        if low != high or (gap is not None and gap != low):
            return False
        gap = low
    return True


def regions(pages: list[tuple[np.ndarray, np.ndarray]], paths: dict, known: set, steady: set) -> set:
    """Path numbers inside the main region that hold no text of the article (with all beneath them), from the
    pages' tokens and texts."""
    above = {number: key for key, number in paths.items()}
    inner, slots, unlinked, filled = set(), set(), set(), set()
    for tokens, texts in pages:
        for path, lo, hi, inside, link in texts.tolist():
            if not inside:
                continue
            # a text is the template's if it is so as a whole or word by word
            free = int(tokens[hi - 1]) in known or all(t in known for t in tokens[lo:hi - 1].tolist())
            marks = [filled] + [slots] * (not free) + [unlinked] * (not link)
            inner.add(path)
            while path and any(path not in m for m in marks):
                for m in marks:
                    m.add(path)
                path = above[path][0] if above[path] else 0
    fixed = set()
    for path in sorted(filled):
        up, name, text = above[path]
        if up in fixed:
            fixed.add(path)
        elif tag_token(up, f"{name} {text}") in steady and _in_main(path, above, inner) and (
                (name in REGION and path not in slots) or (name in MENU and path not in unlinked)):
            fixed.add(path)
    return fixed


def _in_main(path: int, above: dict, inner: set) -> bool:
    """Whether the element stands inside the main region (the region's own element does not)."""
    up = above[path][0]
    while up and above[up]:
        _, name, text = above[up]
        if name in ("article", "main") or MAIN_WORD & _marks_of(f"{name} {text}"):
            return True
        up = above[up][0]
    return False


def render(page: Page, known: set, main: bool, fixed: set = frozenset(), repeated: set | None = None) -> str:
    """Text of the page's slots: of its main region if ``main``, without ``fixed`` paths, else of all that are
    not dropped, without stretches that consist of template words only.  What only words mark inside the main
    region is dropped if it is ``repeated`` (None: in any case)."""
    blocks: list[str] = []
    open_: list[str] = []

    def flush():
        if open_:
            text = " ".join("".join(open_).split())
            if text:
                blocks.append(text)
            open_.clear()

    for tag, value, path, dropped, inside, name in page.items:
        if tag:
            if name in BLOCK:
                flush()
            elif name == "br":
                open_.append(" ")
            continue
        if isinstance(dropped, tuple) and repeated is not None:
            dropped = not repeated.isdisjoint(dropped)
        if not dropped and (inside or not main) and not (main and path in fixed):
            if not main and known and _templates(path, value, known):
                continue
            open_.append(entities.unescape(value))
    flush()
    return "\n".join(blocks)


def _templates(path: int, value: str, known: set) -> bool:
    words = value.split()
    return hash((path, "", *words)) in known or all(hash((path, w)) in known for w in words)


def extract_group(sources: list[bytes]) -> Iterator[str]:
    """Main text of each of some pages of one host (compressed by ``zlib``).  A page is parsed twice, so
    that only tokens are held of all pages at once."""
    paths: dict = {}
    order = list(dict.fromkeys(sources))
    read = lambda source: Page(zlib.decompress(source).decode(), paths)
    tokens, on, anchors, has_main = [], Counter(), set(), {}
    for source in order:
        page = read(source)
        tokens.append(page.tokens())
        on.update({path for _, _, path, *_ in page.items})
        has_main[source] = page.has_main
        if page.has_main:
            anchors |= {tag_token(path, value) for tag, value, path, _, _, name in page.items
                        if tag and value[0] != "/" and (name in ("article", "main") or MAIN_WORD & _marks_of(value))}
    enough = len(order) >= MIN_PAGES
    known, steady = template([t for t, _ in tokens]) if enough else (set(), set())
    # does the template have a main region?  on hosts without a template each page answers for itself
    shared = bool(known & anchors)
    fixed = regions(tokens, paths, known, steady) if known else set()
    repeated = {path for path, n in on.items() if n >= MIN_PAGES} if enough else None
    del tokens
    done: dict[bytes, str] = {}
    for source in sources:
        if source not in done:
            page = read(source)
            main = page.has_main and (shared or not known or not _template_text(page, known))
            # a main region that is the same on all pages is still the text
            done[source] = render(page, known, main, fixed, repeated) or render(page, known, main, repeated=repeated)
        yield done[source]


def _marks_of(value: str) -> set:
    return set(_WORDS.split(value.partition(" ")[2]))


def _template_text(page: Page, known: set) -> bool:
    """Whether any text outside the main region is neither dropped nor template (so that the region that
    the page alone has may be one of several)."""
    return any(not tag and not dropped and not inside and value.strip() and not _templates(path, value, known)
               for tag, value, path, dropped, inside, _ in page.items)


def extract(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``).

    A null html is empty and gives an empty text.  Pages whose URL is null or has no host are read as
    one host.  Repeated rows stay repeated; identical pages count once in occurrence vectors.  Pages of any
    length are read whole.  An empty table gives an empty result; other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html", host_and_path(F.col("url"))[0].alias("_host"))
    # written, so that Spark knows its size and broadcasts it only if that is small
    lots = stage(rows.groupBy("_host").agg(F.ceil(F.count("*") / group_pages).alias("_lots")).where("_lots > 1"), "hosts")
    rows = rows.join(lots, "_host", "left").select("page_id", "url", "html", "_host", F.pmod(
        F.xxhash64("page_id", "url"), F.coalesce("_lots", F.lit(1))).alias("_lot"))
    dealt = rows.repartition("_host", "_lot").sortWithinPartitions("_host", "_lot", "page_id", "url")

    def texts(it: Iterator[tuple]) -> Iterable[tuple]:
        held: list[tuple] = []
        key = None

        def done():
            for (page_id, url, _), text in zip(held, extract_group([s for _, _, s in held])):
                yield page_id, url, text, len(text)

        for page_id, url, source, host, lot in it:
            if held and (host, lot) != key:
                yield from done()
                held = []
            key = (host, lot)
            held.append((page_id, url, zlib.compress((source or "").encode(), 1)))
        if held:
            yield from done()

    return map_rows(dealt, texts, "page_id long, url string, text string, n_chars long")
