"""HTML extraction by nearest-URL page differencing.

Pages are ordered by host and URL path; each meets the few neighbours on its
host that share the longest paths. The text lines of page and neighbour are
aligned by a longest common subsequence. Neighbours that leave nothing unshared
are copies and say nothing; a line that most of the others share is one a site
repeats from page to page, and is deleted. Articles stay whole: a line in a
declared article or main element is deleted only if all neighbours with other
text there have it at the same place, and no deletion may leave only lines that
are shorter than a deleted one where few neighbours speak for it. Where no
neighbour says anything, an article or main element that holds most of the text
is taken for the article. Elements that are never article text (menus, scripts,
forms, …) are left out whether shared or not.

A host may hold a third of all pages. Its pages are dealt to blocks of the
global order; the first and last few pages of a block also go to the neighbouring
block, so every page meets its neighbours wherever blocks are cut.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lakemill.llm.common import column
from lakemill.operators.numbering import with_row_index

# Fixed values of the HTML standard and of usual page templates.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head nav footer aside form button select datalist menu dialog svg canvas object video audio map annotation annotation-xml".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
#: An opening tag that ends an open paragraph; elements that an end tag, or an implied end, does not reach beyond.
ENDS_P = BLOCK - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead tr".split())
SCOPE = frozenset("html table td th caption object template".split())
TABLE_PARTS = frozenset("table tbody td tfoot th thead tr caption".split())
#: What an opening tag ends, and the elements that this does not reach beyond.
IMPLIED = {
    "li": (frozenset(("li",)), frozenset("ul ol menu dir".split()) | SCOPE),
    **dict.fromkeys(("dd", "dt"), (frozenset(("dd", "dt")), frozenset(("dl",)) | SCOPE)),
    "option": (frozenset(("option",)), frozenset(("select", "datalist", "optgroup")) | SCOPE),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("tr", "table")))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset(("tbody", "thead", "tfoot", "tr")), frozenset(("table",)))),
}
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted promotion related search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget".split()
)
#: A class name that also holds one of these belongs to the article or to a frame around it; comments always go.
KEEP_WORDS = frozenset("article content post entry story body text has no with layout wrapper".split())
COMMENT_WORDS = frozenset(("comment", "comments", "disqus"))
#: Beside noise words, these do not make the id of a block inside an article the slug of a section.
FRAME_WORDS = frozenset(
    "area bar block bottom box button buttons container content form frame icons inner left links list outer page right "
    "section site slot top unit wrapper".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")

#: Neighbours that a page meets, and as many pages on either side to choose them from. From this many with other
#: text on, their majority decides alone.
NEAR, MANY = 4, 3


#: What closing tags do not look beyond.
P, IN_TABLE, IN_BLOCK, IN_BUTTON = frozenset(("p",)), frozenset(("table",)), SCOPE | BLOCK, SCOPE | {"button"}


def noisy(words: set[str], name: str) -> bool:
    """Whether the words of one class or id speak against an element."""
    if words & COMMENT_WORDS and "no" not in words:
        return True
    return name not in MAIN and bool(words & NOISE_WORDS) and not words & KEEP_WORDS


def is_noise(name: str, rest: str, inside: bool = False) -> bool:
    """Whether an element is left out with all it holds; ``inside``: of an article or main element.

    There, headings are text, and ids are mostly slugs of sections: only the id
    of a block or list counts, if it has no other words than those of a frame.
    """
    if name in NEVER:
        return True
    if not rest or name in ("html", "body"):
        return False
    given: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(rest):
        given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in given and given["hidden"].lower() != "until-found" or NOT_SHOWN.search(given.get("style", "")):
        return True
    if given.get("role", "").strip().lower() in NOISE_ROLES:
        return True
    if inside and name in HEADINGS:
        return False
    if any(noisy(set(WORD.findall(part)), name) for part in given.get("class", "").lower().split()):
        return True
    words = set(WORD.findall(given.get("id", "").lower()))
    if inside and not (name in ("div", "ul", "ol") and words <= NOISE_WORDS | FRAME_WORDS):
        return False
    return noisy(words, name)


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, standing) of every block: 0 left out, 1 plain, 2 in a main element, 3 in an article."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    at, inside = 0, {"article": 0, "main": 0}
    # Open elements (an ended formatting one leaves a gap), the places of each name, and that of the one left out.
    stack: list[str | None] = []
    places: dict[str, list[int]] = {}
    skipping: int | None = None

    def leave(name: str) -> None:
        """Forgets the innermost place of a name."""
        places[name].pop()
        if not places[name]:
            del places[name]

    def cut(place: int) -> None:
        """Ends the elements from a place of the stack on."""
        nonlocal skipping
        for gone in stack[place:]:
            if gone is not None:
                leave(gone)
            if gone in MAIN:
                inside[gone] -= 1
        del stack[place:]
        if skipping is not None and place <= skipping:
            skipping = None

    def find(names: frozenset[str], barrier: frozenset[str]) -> int | None:
        """Place of the innermost open element of one of the names, if none of the barrier lies within it."""
        place = max((places[n][-1] for n in names if n in places), default=-1)
        if place < 0:
            return None
        wall = max((at[-1] for n, at in places.items() if n in barrier and n not in names), default=-1)
        return place if place > wall else None

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append((text, 0 if skipping is not None else 3 if inside["article"] else 2 if inside["main"] else 1))

    size = len(page)
    while at < size:
        m = TAG.search(page, at)
        if not m:
            parts.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            parts.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if not m["name"]:
            continue
        name, closes, rest = m["name"].lower(), bool(m["end"]), m["rest"]
        if not closes and name in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{name}\s*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            parts.append(" ")
        if closes:
            if name in FORMATTING:
                place = find(frozenset((name,)), SCOPE)
                if place is not None:
                    if place == skipping:
                        flush()
                        skipping = None
                    leave(name)
                    stack[place] = None
                    while stack and stack[-1] is None:
                        stack.pop()
                continue
            barrier = IN_TABLE if name in TABLE_PARTS else SCOPE if name in BLOCK or name in NEVER else IN_BLOCK
            place = find(frozenset((name,)), barrier)
            if place is not None:
                if skipping is not None and place <= skipping:
                    flush()
                cut(place)
            continue
        if name in VOID or rest.endswith("/"):
            if name == "hr" and (place := find(P, SCOPE)) is not None:
                cut(place)
            continue
        if name in IMPLIED and (place := find(*IMPLIED[name])) is not None:
            cut(place)
        if name in ENDS_P and (place := find(P, IN_BUTTON)) is not None:
            cut(place)
        within = bool(inside["article"] or inside["main"])
        if skipping is None:
            if is_noise(name, rest, within) or (name == "header" and not inside["article"]):
                flush()
                skipping = len(stack)
        elif name in MAIN and not is_noise(name, rest, within):
            skipping = None  # an element that was never closed does not swallow the article
        places.setdefault(name, []).append(len(stack))
        stack.append(name)
        if name in MAIN:
            inside[name] += 1
    flush()
    return out


def shared_lines(a: list[str], b: list[str]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``, by bit vectors over ``a``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    mid_a, mid_b = a[head : len(a) - tail], b[head : len(b) - tail]
    where: dict[str, int] = {}
    for i, line in enumerate(mid_a):
        where[line] = where.get(line, 0) | 1 << i
    mid_b = [line for line in mid_b if line in where]
    full = (1 << len(mid_a)) - 1
    state, rows = full, []
    for line in mid_b:
        hit = state & where[line]
        state = (state + hit | state - hit) & full
        rows.append(state)
    found = []
    i, j = len(mid_a), len(mid_b)
    while i and j:
        if rows[j - 1] >> (i - 1) & 1:
            i -= 1
            continue
        j -= 1
        if not (j and not rows[j - 1] >> (i - 1) & 1):
            i -= 1
            found.append(head + i)
    return [*range(head), *reversed(found), *range(len(a) - tail, len(a))]


def same_place(mine: list[str], others: list[list[str]]) -> set[int]:
    """Lines that all others have at the same place from the beginning, or all from the end."""
    return {
        i
        for i, line in enumerate(mine)
        if all(i < len(o) and o[i] == line for o in others)
        or all(len(mine) - i <= len(o) and o[i - len(mine)] == line for o in others)
    }


def outweighs(lines: list[str], kept: set[int], gone: set[int]) -> bool:
    """Whether a kept line is as long as every deleted one: what goes is not the text itself."""
    return max((len(lines[i]) for i in kept), default=0) >= max((len(lines[i]) for i in gone), default=0)


def article(lines: list[str], standings: list[int], others: list[tuple[list[str], list[int]]]) -> str:
    """Lines of the page that its neighbours ``others`` do not show to be the site's.

    Lines that are left out come neither in ``lines`` nor in those of ``others``.
    """
    everything = set(range(len(lines)))
    main = [i for i, s in enumerate(standings) if s > 1]
    region, outside = set(main), everything.difference(main)
    mine = [lines[i] for i in main]
    votes, speakers, regions, met = [0] * len(lines), 0, [], set()
    for theirs, places in others:
        if tuple(theirs) in met:
            continue
        met.add(tuple(theirs))
        shared = shared_lines(lines, theirs)
        if len(shared) in (len(lines), len(theirs)):
            continue
        speakers += 1
        for i in shared:
            votes[i] += 1
        part = [line for line, s in zip(theirs, places) if s > 1]
        if mine and part and part not in regions and len(shared_lines(mine, part)) < min(len(mine), len(part)):
            regions.append(part)
    if not speakers:
        if sum(len(lines[i]) for i in region) > sum(len(lines[i]) for i in outside):
            return "\n".join(mine)
        return "\n".join(lines)
    gone = {i for i in outside if 2 * votes[i] > speakers}
    if speakers < MANY and not outweighs(lines, {i for i in everything if not votes[i]}, gone):
        gone = set()
    if len(regions) > 1:
        framed = {main[k] for k in same_place(mine, regions)}
        if outweighs(lines, region - framed, framed):
            gone |= framed
    return "\n".join(line for i, line in enumerate(lines) if i not in gone)


def path_overlap(a: str, b: str) -> int:
    """Leading path steps that two paths of one host share, then leading characters."""
    x, y = a.split("/"), b.split("/")
    steps = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    chars = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
    return steps << 32 | chars


def nearest(host: str, path: str, around: list[tuple]) -> list[tuple]:
    """The (host, path, lines, standings) around a page that are on its host and nearest by path; earlier ones on a tie."""
    return sorted((n for n in around if n[0] == host), key=lambda n: -path_overlap(n[1], path))[:NEAR]


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", blocks: int | None = None
) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    A null or empty page, or one without article text, gives an empty text. A
    null URL counts as the empty one for pairing and is returned as null.
    Repeated rows and pages with one URL meet each other and, as copies, keep
    their text. Other columns are left out; an empty table gives an empty
    result.
    """
    url = F.coalesce(column(url_col).cast("string"), F.lit(""))
    parsed = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1), r"/+$", "")
    id_kind, url_kind = pages.schema[id_col].dataType, pages.schema[url_col].dataType
    place = pages.select(
        column(id_col).cast("string").alias("page_id"),
        column(url_col).cast("string").alias("url"),
        F.lower(parsed).alias("host"),
        path.alias("path"),
        F.coalesce(column(html_col).cast("string"), F.lit("")).alias("html"),
    )
    spark = pages.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks or 4 * tasks
    key = F.concat_ws("\x00", "host", "path", F.coalesce("page_id", F.lit("")), F.coalesce("url", F.lit("")))
    order = with_row_index(place.select(key.alias("key")), ["key"])
    total = place.count()
    step = max(NEAR, -(-total // blocks))
    at = (F.col("row_index") - 1) % step
    # Three keys a block at most come to the driver: of its first page, and of the pages up to and from which others are guests next door.
    edges = order.where(at.isin(0, NEAR - 1, step - NEAR)).select("key", at.alias("at"), "row_index").orderBy("row_index").collect()
    firsts = [e["key"] for e in edges if e["at"] == 0]
    heads = [e["key"] for e in edges if e["at"] == NEAR - 1]
    tails = [e["key"] for e in edges if e["at"] == step - NEAR]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page_id, url_, host, path_, page, key_ in batch.itertuples(index=False):
                found = [x for x in lines_of(page) if x[1]]
                lines = "\n".join(line for line, _ in found)
                standings = "".join(str(s) for _, s in found)
                block = max(0, bisect_right(firsts, key_) - 1)
                row = (key_, page_id, url_, host, path_, lines, standings)
                out.append((block, False, *row))
                # Only the last block may be too short to have these keys.
                if block and (block >= len(heads) or key_ <= heads[block]):
                    out.append((block - 1, True, *row))
                if block + 1 < len(firsts) and key_ >= tails[block]:
                    out.append((block + 1, True, *row))
            yield pd.DataFrame(out, columns=columns)

    def differ(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The pages of a block around the next one to be closed, and its place among them.
        held: list[tuple] = []
        at, out = 0, []

        def close() -> None:
            nonlocal at
            _, guest, page_id, url_, host, path_, lines, standings = held[at]
            if not guest:
                around = [n[4:] for n in held[max(0, at - NEAR) : at] + held[at + 1 : at + 1 + NEAR]]
                text = article(lines, standings, [n[2:] for n in nearest(host, path_, around)])
                out.append((page_id, url_, text, len(text)))
            at += 1
            if at > NEAR:
                del held[0]
                at -= 1

        for batch in batches:
            for block, guest, _, page_id, url_, host, path_, lines, standings in batch.itertuples(index=False):
                if held and held[-1][0] != block:
                    while at < len(held):
                        close()
                    held.clear()
                    at = 0
                held.append((block, guest, page_id, url_, host, path_, lines.split("\n") if lines else [], [int(s) for s in standings]))
                if len(held) - at > NEAR:
                    close()
            yield pd.DataFrame(out, columns=results)
            out.clear()
        while at < len(held):
            close()
        yield pd.DataFrame(out, columns=results)

    columns = ["block", "guest", "key", "page_id", "url", "host", "path", "lines", "standings"]
    results = ["page_id", "url", "text", "n_chars"]
    dealt = (
        place.select("page_id", "url", "host", "path", "html", key.alias("key"))
        .mapInPandas(
            read,
            "block int, guest boolean, key string, page_id string, url string, host string, path string, "
            "lines string, standings string",
        )
        .repartition(tasks, "block")
        .sortWithinPartitions("block", "key", "guest")
    )
    return dealt.mapInPandas(differ, "page_id string, url string, text string, n_chars long").select(
        F.col("page_id").cast(id_kind), F.col("url").cast(url_kind), "text", "n_chars"
    )
