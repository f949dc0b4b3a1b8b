"""HTML extraction by nearest-URL page differencing.

Pages are cut into text lines.  Within each host every page is paired with the
page next to it in URL path order (the neighbour that shares more leading path
parts).  Near copies that follow each other there (print versions, other query
strings) form a run, and the pages next to the run are the neighbours of all its
pages, so no page is differenced against its own copy.  The two pages' lines are aligned by longest common subsequence, and
shared lines are deleted as template text.  Inside the article one neighbour is
not evidence enough, since two texts may have a sentence in common: there a shared
line goes if more than half of the host's pages, and at least ``TEMPLATE`` of
them, have it in their articles (a run of near copies counts as one page).  The
page's own markup only corrects that result: lines inside navigation, header,
footer, sidebar, advert, notice, form or comment elements go even if this page
alone has them, and a line of the article stays if the neighbour has it in such
elements only.  Lines outside the article that no neighbour has stay.

Only 64-bit line hashes travel for the alignment.  Neighbours come from a
range partitioning over (host, path), with the first and last rows of the
partitions joined on, so a host with a third of all pages spreads evenly.

Defined results
  * NULL or empty html: empty text.  A page without neighbour on its host, or
    whose host has nothing but near copies of it, loses no line by differencing.
  * Near copies share more than half of the lines and of the text of both
    articles (without article: of all lines that markup doesn't drop); under
    different paths more than ``COPY`` of the text.
  * A page without any line is no neighbour.
  * A NULL url: the page has no host and no neighbour.
  * Repeated rows are separate pages; an empty table gives an empty result.
  * Class and id names count whole, or by their parts (``user-comments``,
    ``site-footer__inner``) where all parts but places and wrappers name such an
    element; ``has-sidebar`` or ``share-price`` doesn't.  Ids of headings, sections and other places to
    link to don't count in the article.  A main element opens the
    article again inside any dropped element, an article element unless that is
    hidden or holds other texts (comments, related, navigation, sidebar, footer).
  * A form is dropped.  One that holds more than half of the page's text outside
    dropped elements is the page's wrapper: only its controls are dropped.
  * Unclosed and stray tags, unknown tags, cut-off documents: handled as browsers do in
    the main (paragraphs and list items end where the next block begins).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import materialise

# Element and attribute names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea select svg math object canvas title".split())
_DROP = frozenset("nav footer aside button dialog menu head".split())
_CONTROLS = frozenset("label legend button output datalist meter progress".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOXES = frozenset("div ul ol table form".split())
_MAIN = frozenset("article main".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
# Whole names of a class or id.
_BOILERPLATE = frozenset(
    "ad ads adv advert advertisement adverts advertising banner consent cookie cookies header login masthead modal "
    "newsletter notice notices notification popup search share sharing signup social sponsor sponsored subscribe toolbar "
    "widget widgets ad-banner ad-container ad-slot ad-unit ad-wrapper adsbygoogle cookie-banner cookie-bar cookie-consent "
    "cookie-notice login-form newsletter-form newsletter-signup search-bar search-box "
    "search-form searchform share-bar share-buttons share-links sharedaddy sign-up signup-form site-banner site-header "
    "social-icons social-links social-media social-share subscribe-box subscribe-form top-bar topbar widget-area".split())
# The same for elements whose articles are other texts than the page's own.
_OTHERS = frozenset(
    "breadcrumb breadcrumbs comment comments disqus footer menu nav navbar navigation pager pagination promo promoted "
    "related replies reply respond sidebar comment-body comment-content comment-form comment-list comment-respond "
    "comment-section comments-area comments-list comments-section left-sidebar main-menu main-nav main-navigation nav-bar "
    "nav-links nav-menu navbar-nav navigation-menu page-footer page-navigation post-navigation primary-menu primary-nav "
    "related-articles related-content related-links related-posts related-stories right-sidebar side-bar side-menu "
    "sidebar-left sidebar-right site-footer site-nav site-navigation top-menu top-nav".split())
# Parts of a class or id: those that name an element to drop (the first list is of the kind of _OTHERS), and those that
# only say where it stands or that it wraps something.
_OTHER_PARTS = frozenset("breadcrumb breadcrumbs comment comments disqus footer menu nav navbar navigation pagination promo "
                         "related sidebar".split())
_PARTS = _OTHER_PARTS | frozenset("ads advert adverts advertisement advertising banner consent cookie cookies modal newsletter "
                                  "notice popup signup subscribe widget widgets".split())
_PLACES = frozenset("area block bottom box container fixed global inner left list main outer page primary right secondary "
                    "section site sticky top user wrap wrapper".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                    r"|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|/|$)", re.I)

PLAIN, DROP, MAIN = 0, 1, 2
#: Pages of a host that must have a line in their articles before it counts as template there.
TEMPLATE = 3
# While a page is cut: SHUT is dropped for articles inside too, and form number k
# has the regions FORMS + 2 * k and, in the article, one more.
SHUT, FORMS = 3, 4
COPY = 0.8


def _in_article(region: int) -> bool:
    return region == MAIN or (region >= FORMS and region % 2 == 1)


def _kind_of(name: str) -> int | None:
    """SHUT or DROP for a class or id that names such an element, by its whole or by its parts."""
    if name in _OTHERS:
        return SHUT
    if name in _BOILERPLATE:
        return DROP
    parts = [p for p in name.replace("_", "-").split("-") if p and p not in _PLACES]
    if not parts or not all(p in _PARTS for p in parts):
        return None
    return SHUT if any(p in _OTHER_PARTS for p in parts) else DROP


def _role(tag: str, attributes: str, inside: int) -> int:
    """The region that an element opens, given the one that it is in."""
    if (inside == SHUT and tag != "main") or tag in _DROP or (inside >= FORMS and tag in _CONTROLS):
        return SHUT
    opens = tag in _MAIN
    if attributes:
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
        if found.get("role") in ("main", "article") or found.get("itemprop") == "articlebody":
            opens = True
        if tag not in ("html", "body"):
            named = set(found.get("class", "").split())
            if tag in _BOXES or not (_in_article(inside) or tag in _INLINE or tag in _HEADINGS):
                named.add(found.get("id", "").strip())
            if any(_kind_of(name) == SHUT for name in named) or found.get("role") in _ROLES - {"form", "banner"} or found.get("aria-hidden") == "true":
                return SHUT
            if "hidden" in found or ("hidden" in attributes and _HIDDEN.search(_ATTRIBUTE.sub("", attributes))):
                return SHUT
            if "display:none" in found.get("style", "").replace(" ", ""):
                return SHUT
            if _in_article(inside):
                named.discard("header")
            if any(_kind_of(name) == DROP for name in named) or found.get("role") in _ROLES:
                return DROP
    if opens:
        return inside if _in_article(inside) else MAIN
    return DROP if tag == "header" and not _in_article(inside) else inside


def lines_of(html: str | None) -> list[tuple[str, int]]:
    """(text, region) of each non-empty line of a page: the text of one block."""
    html = html or ""
    lines: list[tuple[str, int]] = []
    buffer: list[str] = []
    open_: list[tuple[str, int]] = []
    region, forms = PLAIN, 0

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            lines.append((text, region))

    def close(tag: str) -> None:
        """End the innermost ``tag`` and all that is open inside it."""
        nonlocal region
        for i in range(len(open_) - 1, -1, -1):
            name = open_[i][0]
            if name == tag:
                region = open_[i][1]
                del open_[i:]
                return
            if tag in _INLINE and name not in _INLINE:
                return  # a stray end tag doesn't end a block

    def end_paragraph() -> None:
        """A block ends an open paragraph, with inline elements left open in it."""
        for i in range(len(open_) - 1, -1, -1):
            if open_[i][0] == "p":
                close("p")
                return
            if open_[i][0] not in _INLINE:
                return

    at = 0
    for m in iter(lambda: _TOKEN.search(html, at), None):
        if m.start() > at:
            buffer.append(unescape(html[at:m.start()]) if "&" in html[at:m.start()] else html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, ending = m[2].lower(), bool(m[1])
        if tag in _RAW:
            if not ending and not m[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                at = html.find(">", stop.start()) + 1 if stop else len(html)
                if at == 0:
                    at = len(html)
            continue
        if tag in _INLINE:
            if tag in _VOID:
                buffer.append(" ")
            elif ending:
                close_region = region
                if any(name == tag and r != close_region for name, r in open_):
                    flush()
                close(tag)
            else:
                inner = _role(tag, m[3], region)
                if inner != region:
                    flush()
                open_.append((tag, region))
                region = inner
            continue
        flush()
        if tag in _VOID:
            end_paragraph()
        elif ending:
            close(tag)
        else:
            end_paragraph()
            if tag == "li" and any(name == "li" for name, _ in _to_list(open_)):
                close("li")
            open_.append((tag, region))
            region = _role(tag, m[3], region)
            if tag == "form" and (region in (PLAIN, MAIN) or region >= FORMS):
                region, forms = FORMS + 2 * forms + _in_article(region), forms + 1
    if at < len(html):
        buffer.append(unescape(html[at:]))
    flush()
    return _settle(lines)


def _settle(lines: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Lines with the regions of forms decided: text if the form holds most of the page's, else dropped."""
    chars: dict[int, int] = {}
    for t, r in lines:
        if r not in (DROP, SHUT):
            form = (r - FORMS) // 2 if r >= FORMS else -1
            chars[form] = chars.get(form, 0) + len(t)
    wrapper = next((f for f, n in chars.items() if f >= 0 and 2 * n > sum(chars.values())), None)

    def region(r: int) -> int:
        if r >= FORMS:
            return (MAIN if r % 2 else PLAIN) if (r - FORMS) // 2 == wrapper else DROP
        return DROP if r == SHUT else r

    return [(t, region(r)) for t, r in lines]


def _to_list(open_: list[tuple[str, int]]) -> Iterator[tuple[str, int]]:
    """Open elements from the innermost out, up to the nearest list."""
    for item in reversed(open_):
        if item[0] in ("ul", "ol", "menu"):
            return
        yield item


def _rows(a: list[int], b: list[int]) -> list[int]:
    """Bit rows of the LCS table: bit j of row i is 0 where L(i, j + 1) = L(i, j) + 1."""
    full = (1 << len(b)) - 1
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    row, out = full, [full]
    for x in a:
        u = row & at.get(x, 0)
        row = ((row + u) | (row - u)) & full
        out.append(row)
    return out


def _lengths(row: int, m: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(row.to_bytes((m + 7) // 8, "little"), np.uint8), bitorder="little")[:m]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def common(a: list[int], b: list[int], cells: int = 1 << 28) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Bit-parallel; tables of more than ``cells`` bits are split in two halves
    (Hirschberg), so memory is bounded for any lengths.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = list(range(head)) + list(range(len(a) - tail, len(a)))
    in_a, in_b = set(a[head:len(a) - tail]), set(b[head:len(b) - tail])
    where = [i for i in range(head, len(a) - tail) if a[i] in in_b]
    x, y = [a[i] for i in where], [v for v in b[head:len(b) - tail] if v in in_a]
    if x and y:
        if len(x) * len(y) > cells and len(x) > 1:
            half = len(x) // 2
            front = _lengths(_last_row(x[:half], y), len(y))
            back = _lengths(_last_row(x[half:][::-1], y[::-1]), len(y))[::-1]
            cut = int(np.argmax(front + back))
            out += [where[i] for i in common(x[:half], y[:cut], cells)]
            out += [where[half + i] for i in common(x[half:], y[cut:], cells)]
        else:
            rows, i, j = _rows(x, y), len(x), len(y)
            while i and j:
                bit = 1 << j - 1
                if rows[i] & bit:
                    j -= 1
                elif rows[i - 1] & bit:
                    out.append(where[i - 1])
                    i, j = i - 1, j - 1
                else:
                    i -= 1
    return sorted(out)


def _last_row(a: list[int], b: list[int]) -> int:
    full = (1 << len(b)) - 1
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    row = full
    for x in a:
        u = row & at.get(x, 0)
        row = ((row + u) | (row - u)) & full
    return row


def _hashes(lines: list[str]) -> list[int]:
    from xxhash import xxh64_intdigest

    return [xxh64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t in lines]


def _marks(lines: list[tuple[str, int]]) -> list[int]:
    """Length of each line: 0 if dropped, negative in the article."""
    return [0 if r == DROP else -len(t) if r == MAIN else len(t) for t, r in lines]


def near_copy(own: list[int], own_marks: list[int], near: list[int], near_marks: list[int], same_path: bool) -> bool:
    """Whether two pages, by line hashes and marks, have most of their body in common."""
    def body(hashes: list[int], marks: list[int]) -> list[tuple[int, int]]:
        article = any(m < 0 for m in marks)
        return [(h, abs(m)) for h, m in zip(hashes, marks) if (m < 0 if article else m > 0)]

    a, b = body(own, own_marks), body(near, near_marks)
    at = common([h for h, _ in a], [h for h, _ in b])
    text = sum(a[i][1] for i in at)
    return 2 * len(at) > len(a) + len(b) - len(at) and text > (0.5 if same_path else COPY) * (
        sum(n for _, n in a) + sum(n for _, n in b) - text)


def shared_lines(own: list[int], own_marks: list[int], near: list[int], near_marks: list[int],
                 template: frozenset[int]) -> frozenset[int]:
    """Positions in ``own`` that are template text by the neighbour ``near``; in the article only
    lines of the host's ``template``."""
    if own == near:
        return frozenset()
    every = common(own, near)
    if not any(m < 0 for m in own_marks):
        return frozenset(every)
    out = frozenset(i for i in every if own_marks[i] >= 0)
    if template:
        at = [i for i, m in enumerate(own_marks) if m]
        text = common([own[i] for i in at], [h for h, m in zip(near, near_marks) if m])
        out |= {at[i] for i in text if own_marks[at[i]] < 0 and own[at[i]] in template}
    return out


def _rows_of(pages: DataFrame) -> DataFrame:
    """(uid, page_id, url, html); ``uid`` is a 128-bit hash of the row: rows that repeat it have the same result."""
    typed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    nulls = F.col("url").isNull(), F.col("html").isNull()  # the hash passes over NULLs
    halves = F.xxhash64(*nulls, "page_id", "url", "html"), F.xxhash64(*nulls, "html", "url", "page_id")
    uid = F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))
    return typed.select(uid.alias("uid"), "page_id", "url", "html")


def cut_lines(pages: DataFrame) -> DataFrame:
    """(uid, host, path, hashes, marks): the line hashes and lengths of each different page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lines_of(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([_hashes([t for t, _ in p]) for p in found], pa.list_(pa.int64())),
                pa.array([_marks(p) for p in found], pa.list_(pa.int32()))], ["uid", "url", "hashes", "marks"])

    cut = _rows_of(pages).select("uid", "url", "html").mapInArrow(
        run, "uid binary, url string, hashes array<long>, marks array<int>")
    bare = F.regexp_replace("url", r"[?#].*$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return cut.dropDuplicates(["uid"]).withColumns({
        "host": F.lower(F.regexp_extract(rest, r"^[^/]*", 0)), "path": F.regexp_extract(rest, r"^[^/]*(.*)$", 1)}).drop("url")


def _copies(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """(uid, copy): the pages of ``pairs`` (uid, other, same_path) that are near copies of the other one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = [r["uid"] for r in batch.to_pylist()
                    if near_copy(r["hashes"], r["marks"], r["others"], r["other_marks"], r["same_path"])]
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.binary()), pa.array([True] * len(uids), pa.bool_())],
                                             ["uid", "copy"])

    lines = cut.select("uid", "hashes", "marks")
    others = cut.select(F.col("uid").alias("other"), F.col("hashes").alias("others"), F.col("marks").alias("other_marks"))
    return pairs.join(lines, "uid").join(others, "other").select(
        "uid", "hashes", "marks", "others", "other_marks", "same_path").mapInArrow(run, "uid binary, copy boolean")


def neighbours(cut: DataFrame) -> DataFrame:
    """(uid, host, run, other): the page's run of near copies on its host, and the page next to the run that
    shares more leading path parts (NULL: there is none)."""
    key = F.struct("host", "path", "uid")
    placed = (cut.where("host IS NOT NULL AND size(hashes) > 0").select("uid", "host", "path")
              .repartitionByRange("host", "path", "uid").withColumn("part", F.spark_partition_id()))
    placed = materialise(placed, "order")
    by_part, from_end = Window.orderBy("part"), Window.orderBy(F.desc("part"))  # a row for each partition
    ends = placed.groupBy("part").agg(F.max(key).alias("last")).select("part", F.lag("last").over(by_part).alias("left"))
    in_order = Window.partitionBy("part").orderBy("host", "path", "uid")
    placed = placed.withColumn("before", F.lag(key).over(in_order)).join(ends, "part").withColumn(
        "before", F.coalesce("before", "left")).drop("left")
    pairs = placed.where("before.host = host").select(
        "uid", F.col("before.uid").alias("other"), (F.col("before.path") == F.col("path")).alias("same_path"))
    # A row that is no near copy of the one before starts a run.
    first = ~F.coalesce("copy", F.lit(False))
    placed = materialise(placed.join(_copies(pairs, cut), "uid", "left").select(
        "part", "uid", "host", "path", F.when(first, F.struct("before")).alias("start"), F.when(first, key).alias("at")), "runs")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy("part").agg(F.max_by("start", "at").alias("start"), F.min("at").alias("at")).select(
        "part", F.last("start", True).over(earlier(by_part)).alias("left"), F.last("at", True).over(earlier(from_end)).alias("right"))
    up_to = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("part").orderBy(F.desc("host"), F.desc("path"), F.desc("uid"))
    both = placed.withColumns({"start": F.last("start", True).over(up_to), "next": F.last("at", True).over(earlier(back))}).join(
        ends, "part").select("uid", "host", "path", F.coalesce("start", "left")["before"].alias("before"),
                             F.coalesce("next", "right").alias("after"))

    def shared(side: str):
        parts = F.zip_with(F.split("path", "/"), F.split(f"{side}.path", "/"), lambda a, b: a.eqNullSafe(b))
        leading = F.array_position(parts, False)
        n = F.when(leading == 0, F.size(parts)).otherwise(leading - 1)
        return F.when(F.col(f"{side}.host") == F.col("host"), n)

    scored = both.withColumns({"b": shared("before"), "a": shared("after")})
    other = F.when(F.col("b").isNotNull() & (F.col("a").isNull() | (F.col("b") >= F.col("a"))), F.col("before.uid")).when(
        F.col("a").isNotNull(), F.col("after.uid"))
    run = F.when(F.col("before.host") == F.col("host"), F.col("before.uid"))  # the page before it; NULL: it is the first
    return scored.select("uid", "host", F.coalesce(F.hex(run), F.lit("")).alias("run"), other.alias("other"))


def templates(cut: DataFrame, pairs: DataFrame) -> DataFrame:
    """(uid, template): hashes of article lines that the page shares with its neighbour and that most of
    the host's runs have in their articles."""
    text = lambda h, m, keep: F.transform(F.filter(F.arrays_zip(F.col(h).alias("h"), F.col(m).alias("m")), keep), lambda x: x["h"])
    lines = cut.select("uid", F.array_distinct(text("hashes", "marks", lambda x: x["m"] < 0)).alias("main"),
                       text("hashes", "marks", lambda x: x["m"] != 0).alias("all"))
    mains = lines.select("uid", "main").where(F.size("main") > 0)
    both = pairs.where("other IS NOT NULL").join(mains, "uid").join(
        lines.select(F.col("uid").alias("other"), "all"), "other")
    shared = materialise(both.select("uid", "host", F.explode(F.array_intersect("main", "all")).alias("line")), "shared")
    # Only lines that some page shares are counted, over all pages.
    held = pairs.select("uid", "host", "run").join(mains, "uid").select("host", "run", F.explode("main").alias("line"))
    held = held.join(shared.select("host", "line").distinct(), ["host", "line"], "left_semi")
    counts = held.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    hosts = pairs.select("host", "run").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("runs"))
    often = counts.where(F.col("n") >= TEMPLATE).join(hosts, "host").where(2 * F.col("n") > F.col("runs"))
    return shared.join(often.select("host", "line"), ["host", "line"]).groupBy("uid").agg(
        F.collect_set("line").alias("template"))  # lines of one page


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: (page_id, url, text, n_chars).

    Line hashes are written once; the pages are cut again for their text, which
    so is moved once and compressed.
    """
    cut = materialise(cut_lines(pages), "lines")
    pairs = materialise(neighbours(cut), "pairs")
    others = pairs.where("other IS NOT NULL").join(cut.select(
        F.col("uid").alias("other"), F.col("hashes").alias("others"), F.col("marks").alias("other_marks")), "other").join(
        templates(cut, pairs), "uid", "left")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lines_of(h.as_py()) for h in batch.column(3)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3],
                pa.array([zlib.compress("\n".join(t for t, _ in p).encode("utf-8", "replace")) for p in found], pa.binary()),
                pa.array([bytes(r for _, r in p) for p in found], pa.binary())],
                ["uid", "page_id", "url", "body", "regions"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for body, regions, other, marks, template in zip(*(batch.column(i) for i in (2, 3, 4, 5, 6))):
                regions = regions.as_py()
                lines = zlib.decompress(body.as_py()).decode().split("\n") if regions else []
                cut = list(zip(lines, regions))
                # Differencing decides; markup then takes the rest of the frame out.
                shared = shared_lines(_hashes(lines), _marks(cut), other.as_py() or [], marks.as_py() or [],
                                      frozenset(template.as_py() or []))
                texts.append("\n\n".join(t for i, (t, r) in enumerate(cut) if i not in shared and r != DROP))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    whole = _rows_of(pages).mapInArrow(compress, "uid binary, page_id long, url string, body binary, regions binary")
    joined = whole.join(others.select("uid", "others", "other_marks", "template"), "uid", "left")
    return joined.select("page_id", "url", "body", "regions", "others", "other_marks", "template").mapInArrow(
        keep, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
