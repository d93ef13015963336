"""Main text of pages by differencing with the page of the nearest URL.

Pages are cut into lines of text (blocks), without what their markup names as menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles or comments. Within a host, pages stand in order of their URL's path, and each is
paired with the neighbour it shares more leading path segments with. The lines of a pair are aligned by a
longest common subsequence, and the lines in it, being the site's and not the page's, are deleted.

Pages of a host with the same lines are one class, which is paired once. A neighbour is a copy, which proves nothing, if it
shares more than ``COPIES`` of the characters that a page has in lines that are rare on the host, which are those on less
than ``SITE`` of its classes. Copies are grouped, the first of a group is paired again, and so on until its neighbour
is no copy. A page that the neighbour found for its group still copies loses only the lines that are not rare.
A host of less than ``FEW`` classes cannot tell what is rare, so there all lines count as rare; and if
a host has nothing but copies, no line is deleted.

Lines inside an ``article`` or ``main`` element are marked and never deleted: copies of an article, and passages
that many articles quote, are shared by neighbours too. Where a ``main`` element has text, unmarked lines are none of the
page's, as that element is by definition its only body; else every page with unmarked lines is aligned, and those that
the difference leaves are text beside the marked ones, however many there are of either.

An element is left out by its tag, its role, or a class or id that as a whole names such a thing (``ad``, ``site-footer``,
``comment-list``); a state of the page in a class (``no-sidebar``, ``comments-open``) names nothing. Headings and
paragraphs of an article go only by the names of adverts and comments. If a page has no marked lines, and an element named
for its place (a sidebar, a widget) holds more text than all that is kept, then its name is not believed.

Null or empty html gives an empty text; a page with a null url, or alone on its host, is not differenced.
Rows that repeat a page are pages of their own: each input row gives one output row, null ids included. Unclosed
elements end where the page does. Parsing is linear in the page's length but for the alignment, which takes
the product of two pages' lines in bits, in bounded memory.
"""

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import slices
from tallybook.llm.components import components
from tallybook.operators.load import written
from tallybook.scratch import scratch_dir

#: A neighbour with more than this share of the page's rare characters is a copy; bits held by one alignment.
COPIES, BITS = 0.8, 1 << 28
#: Lines on this share of a host's classes are the site's, if the host has at least so many classes.
SITE, FEW = 0.8, 4

_TOKEN = re.compile(r"""
      <!--.*?(?:-->|\Z)
    | <(?P<raw>script|style|title|textarea|iframe)\b(?:.*?</(?P=raw)\s*>|.*\Z)
    | <(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attributes>(?:"[^"]*"|'[^']*'|[^'">])*+)>
    | <[/!?a-z][^>]*(?:>|\Z)
    """, re.IGNORECASE | re.DOTALL | re.VERBOSE)
_ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.IGNORECASE)
# Elements that break lines, those without content, and names of what is not the page's own text.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot
thead tr ul""".split())
SPACED = frozenset("br td th".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OTHERS = frozenset("nav footer aside form button dialog menu object audio video canvas map noscript template svg select".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
NAMES = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu
nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus cookie cookies consent notice notices
popup modal newsletter subscribe share sharing social related recommended widget toolbar pagination pager login signup""".split())
COMMENTS = frozenset("comment comments disqus".split())
# Names that an element's text cannot outweigh, and words beside a name that leave it the name of the element.
SURE = COMMENTS | frozenset("ad ads advert adverts advertisement advertising sponsored cookie cookies consent login signup".split())
BESIDE = frozenset("""site page main top bottom left right upper lower primary secondary global inner outer list box block section
area wrapper wrap container content buttons button links link items item bar text post posts article articles story header title
form group row column col panel slot unit thread body media icons desktop mobile the""".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p".split())


def _left_out(tag: str, attributes: str, marked: bool, names: bool) -> str:
    """Why an element holds no text of the page's own: "sure", "named" by a word that may mislead, or empty if it does."""
    if tag in OTHERS or tag == "header" and not marked:
        return "sure"
    if not attributes.strip() or tag in ("html", "body"):
        return ""
    given = {"hidden": "hidden"} if re.search(r"(?i)(?:^|\s)hidden(?:\s|$)", attributes) else {}
    for name, *values, hidden in _ATTRIBUTE.findall(attributes):
        given[(name or hidden).lower()] = "".join(values)
    found = _names(given)
    if tag in ("article", "main"):
        return "sure" if found & COMMENTS else ""
    style = given.get("style", "").replace(" ", "").lower()
    if ("hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in style
            or given.get("role", "").lower() in ROLES or found & SURE):
        return "sure"
    if not names or marked and tag in PROSE:
        return ""
    return "named" if found or not marked and "header" in _tokens(given) else ""


def _tokens(given: dict[str, str]) -> list[str]:
    """An element's classes and its id."""
    return re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{given.get('class', '')} {given.get('id', '')}").lower().split()


def _names(given: dict[str, str]) -> set[str]:
    """The names in those classes and ids that consist of a name and nothing but words that leave it the element's."""
    out: set[str] = set()
    for token in _tokens(given):
        words = set(re.split(r"[^a-z]+", token)) - {""}
        if words <= NAMES | BESIDE:
            out |= words & NAMES
    return out


def page_lines(html: str) -> list[tuple[str, bool]]:
    """(line, marked) for every line of a page in order; marked are those in an article or main element."""
    lines, body, named = _lines(html, True, -1)
    for names in (True, False):  # an element inside the one that is now believed may outweigh again: then no name counts
        size, at = max(named, default=(0, -1))
        if any(marked for _, marked in lines) or size <= sum(len(line) for line, _ in lines):
            break
        lines, body, named = _lines(html, names, at)
    return [(line, marked) for line, marked in lines if marked or not body]


def _lines(html: str, names: bool, spared: int) -> tuple[list[tuple[str, bool]], bool, list[tuple[int, int]]]:
    """All lines that are not left out, whether some lie in a main element, and (characters, place) of elements left out by name.

    The element that starts at ``spared`` is not left out; without ``names`` none is for the words that may mislead.
    """
    lines: list[tuple[str, bool]] = []
    named: list[tuple[int, int]] = []
    held: list[str] = []
    marked, mains, body = 0, 0, False
    outer, depth = "", 0  # the element that is left out, and how many of its name are open
    seen, place, size = 0, -1, 0

    def end_line():
        nonlocal body
        line = " ".join(unescape("".join(held)).split())
        if line:
            lines.append((line, marked > 0))
            body = body or mains > 0
        held.clear()

    for token in _TOKEN.finditer(html):
        if not outer:
            held.append(html[seen:token.start()])
        else:
            size += len(" ".join(html[seen:token.start()].split()))
        seen, tag = token.end(), (token["tag"] or "").lower()
        if not tag:
            continue
        opens = not token["end"]
        if outer:
            if tag == outer:
                depth += 1 if opens else -1
            elif outer == "p" and tag in BLOCKS:
                depth = 0
            if depth > 0:
                continue
            closed, outer = outer, ""
            if place >= 0:
                named.append((size, place))
            if tag == closed and not opens:
                continue
        if tag in BLOCKS:
            end_line()
        elif tag in SPACED:
            held.append(" ")
        why = _left_out(tag, token["attributes"], marked > 0, names) if opens and tag not in VOID else ""
        if why and token.start() != spared:
            outer, depth, size = tag, 1, 0
            place = token.start() if why == "named" else -1
        elif tag in ("article", "main"):
            marked = marked + 1 if opens else max(0, marked - 1)
            if tag == "main":
                mains = mains + 1 if opens else max(0, mains - 1)
    if not outer:
        held.append(html[seen:])
    elif place >= 0:
        named.append((size + len(" ".join(html[seen:].split())), place))
    end_line()
    return lines, body, named


def common_lines(one: list, other: list) -> list[int]:
    """The places in ``one`` of a longest common subsequence of both."""
    head = 0
    while head < min(len(one), len(other)) and one[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(len(one), len(other)) - head and one[-1 - tail] == other[-1 - tail]:
        tail += 1
    middle = _aligned(one[head:len(one) - tail], other[head:len(other) - tail])
    return [*range(head), *(head + i for i in middle), *range(len(one) - tail, len(one))]


def _bits(one: list, other: list) -> Iterator[int]:
    """After each line of ``one``: a zero at every place of ``other`` where the common subsequence grows."""
    where: dict = {}
    for j, line in enumerate(other):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(other)) - 1
    row = full
    for line in one:
        hit = row & where.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _aligned(one: list, other: list) -> list[int]:
    if not one or not other:
        return []
    if len(one) == 1:
        return [0] if one[0] in other else []
    if len(one) * len(other) > BITS:  # halve, so that no more than two rows are held
        half = len(one) // 2
        ahead, back = (_grown(*pair) for pair in ((one[:half], other), (one[half:][::-1], other[::-1])))
        cut = int((ahead + back[::-1]).argmax())
        return _aligned(one[:half], other[:cut]) + [half + i for i in _aligned(one[half:], other[cut:])]
    rows, out = list(_bits(one, other)), []
    i, j = len(one), len(other)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append(i)
    return out[::-1]


def _grown(one: list, other: list) -> np.ndarray:
    """The length of the common subsequence of ``one`` with every beginning of ``other``."""
    for row in _bits(one, other):
        pass
    bits = np.frombuffer(row.to_bytes(len(other) // 8 + 1, "little"), np.uint8)
    return np.concatenate([[0], np.cumsum(1 - np.unpackbits(bits, bitorder="little")[:len(other)].astype(np.int64))])


def compared(lines: list, sizes: list[int], neighbour: list, site: list | None) -> tuple[bool, list[int]]:
    """Whether the neighbour is a copy of the page, and the places of the lines that may be deleted."""
    shared, site = common_lines(lines, neighbour), set(site or ())
    rare = sum(size for line, size in zip(lines, sizes) if line not in site)
    held = sum(sizes[i] for i in shared if lines[i] not in site)
    copy = held > COPIES * rare
    return copy, [i for i in shared if lines[i] in site] if copy else shared


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            pages = [page_lines(html or "") for html in part.column("html").to_pylist()]
            kept = [part.column(c) for c in ("page_id", "url", "host", "path")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([[line for line, _ in lines] for lines in pages], pa.list_(pa.string())),
                 pa.array([[marked for _, marked in lines] for lines in pages], pa.list_(pa.bool_()))],
                ["page_id", "url", "host", "path", "lines", "marked"])


def page_text(lines: list[str], marked: list[bool], shared: list[int] | None) -> str:
    """The lines that are the page's: the marked ones and those that the difference leaves."""
    shared = set(shared or ())
    return "\n".join(line for i, line in enumerate(lines) if marked[i] or i not in shared)


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, len(batch), 64):
            part = batch.slice(a, 64)
            texts = [page_text(*page) for page in zip(*(part.column(c).to_pylist() for c in ("lines", "marked", "shared")))]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, len(batch), 64):
            part = batch.slice(a, 64)
            told = [compared(*pair) for pair in zip(*(part.column(c).to_pylist() for c in ("lines", "sizes", "others", "site")))]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("near"), pa.array([copy for copy, _ in told], pa.bool_()),
                 pa.array([shared for _, shared in told], pa.list_(pa.int32()))], ["row", "near", "copy", "shared"])


def nearest(pages: DataFrame) -> DataFrame:
    """(row, near) for (row, host, path): the row before or after it in its host's order, by shared path segments.

    Pages are sorted into ranges, whatever their hosts, and neighbours are taken
    within a range; the ends of the ranges, a row or two of each, are joined after.
    """
    spark = pages.sparkSession
    url = F.struct("host", "path", "row")
    ranges = written(pages.repartitionByRange("host", "path", "row").select(
        F.spark_partition_id().alias("range"), url.alias("url")), scratch_dir(spark, "url-ranges"))
    within = Window.partitionBy("range").orderBy("url")
    lined = ranges.select("range", "url", F.lag("url").over(within).alias("before"), F.lead("url").over(within).alias("after"))
    over = Window.orderBy("range")
    ends = ranges.groupBy("range").agg(F.min("url").alias("first"), F.max("url").alias("last")).select(
        F.col("range").alias("_range"), F.lag("last").over(over).alias("_before"), F.lead("first").over(over).alias("_after"))
    lined = lined.join(ends, F.col("range") == F.col("_range")).select(
        "url", F.coalesce("before", "_before").alias("before"), F.coalesce("after", "_after").alias("after"))

    def same(other: str):
        parts = [F.split(F.col(f"{c}.path"), "/") for c in ("url", other)]
        run = F.aggregate(F.zip_with(*parts, lambda x, y: x.eqNullSafe(y)),
                          F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
                          lambda state, equal: F.struct(
                              (state["n"] + (state["on"] & equal).cast("int")).alias("n"), (state["on"] & equal).alias("on")))
        return F.when(F.col(f"{other}.host") == F.col("url.host"), run["n"])

    near = F.when(F.coalesce(same("before"), F.lit(-1)) >= F.coalesce(same("after"), F.lit(-1)), F.col("before")).otherwise(
        F.col("after"))
    return lined.select(F.col("url.row").alias("row"), F.col("url.host").alias("host"), near.alias("near")).where(
        "near.host = host").select("row", F.col("near.row").alias("near"))


def _forms() -> list:
    """Hashes and sizes of the lines of a page, and a hash of all of them."""
    hashes = F.transform("lines", lambda line: F.xxhash64(line))
    return [hashes.alias("hashes"), F.transform("lines", F.length).alias("sizes"), F.xxhash64(hashes, F.size("lines")).alias("form")]


def site_lines(classes: DataFrame) -> DataFrame:
    """(host, site) per host of at least ``FEW`` classes that has lines on the share ``SITE`` of them."""
    hosts = classes.groupBy("host").agg(F.count("*").alias("classes")).where(F.col("classes") >= FEW)
    stands = classes.select("host", F.explode(F.array_distinct("hashes")).alias("line")).groupBy("host", "line").agg(
        F.count("*").alias("on")).where("on > 1")
    return stands.join(hosts, "host").where(F.col("on") >= SITE * F.col("classes")).groupBy("host").agg(
        F.collect_list("line").alias("site"))


def deleted_places(rows: DataFrame) -> DataFrame:
    """(host, form, shared) per class of pages with the same lines: the places of the lines that its neighbour tells to delete.

    Asked are (row, host, path, mixed, hashes, sizes, form); hosts without a mixed page are left out, for nothing is decided there.
    A round compares what has a new neighbour, and takes all but the first of each group of copies out of the order,
    so rounds grow with the logarithm of the longest run of copies.
    """
    spark = rows.sparkSession
    asked = rows.where("mixed").select("host").distinct()
    first = F.min(F.struct("path", "row", "hashes", "sizes")).alias("first")
    classes = written(rows.where("size(hashes) > 0").join(asked, "host", "left_semi").groupBy("host", "form").agg(
        first, F.max("mixed").alias("mixed")).select("host", "form", "mixed", "first.*"), scratch_dir(spark, "page-classes"))
    site = written(site_lines(classes), scratch_dir(spark, "site-lines"))
    ones = classes.join(site, "host", "left").select("row", F.col("hashes").alias("lines"), "sizes", "site")
    others = classes.select(F.col("row").alias("_near"), F.col("hashes").alias("others"))

    def judged(pairs: DataFrame) -> DataFrame:
        both = pairs.join(ones, "row").join(others, F.col("near") == F.col("_near")).select(
            "row", "near", "lines", "sizes", "others", "site")
        return written(both.mapInArrow(_compared, "row long, near long, copy boolean, shared array<int>"),
                       scratch_dir(spark, "page-pairs"))

    leaders = classes.select("row", "host", "path")
    members = classes.select("row", F.col("row").alias("leader"))
    known = None
    while True:
        pairs = written(nearest(leaders), scratch_dir(spark, "page-neighbours"))
        fresh = judged(pairs if known is None else pairs.join(known, ["row", "near"], "left_anti"))
        known = fresh.select("row", "near") if known is None else known.unionByName(fresh.select("row", "near"))
        copies = fresh.where("copy").select(F.col("row").alias("a"), F.col("near").alias("b"))
        if copies.isEmpty():
            break
        groups = components(copies).select(F.col("id").alias("leader"), "component")
        members = written(members.join(groups, "leader", "left").select("row", F.coalesce("component", "leader").alias("leader")),
                          scratch_dir(spark, "page-members"))
        leaders = written(leaders.join(groups, F.col("row") == F.col("leader"), "left").where(
            "component IS NULL OR component = row").select("row", "host", "path"), scratch_dir(spark, "page-leaders"))
    last = classes.where("mixed").select("row", "host", "form").join(members, "row").join(
        pairs.select(F.col("row").alias("leader"), "near"), "leader").select("row", "near", "host", "form")
    told = judged(last.select("row", "near")).select("row", "shared")
    return last.join(told, "row").select("host", "form", "shared")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) per page."""
    spark = pages.sparkSession
    place = F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    slim = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
                        F.lower(place).alias("host"),
                        F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"))
    schema = T.StructType([*slim.drop("html").schema, T.StructField("lines", T.ArrayType(T.StringType())),
                           T.StructField("marked", T.ArrayType(T.BooleanType()))])
    parsed = written(slim.mapInArrow(_parsed, schema).withColumn("row", F.monotonically_increasing_id()),
                     scratch_dir(spark, "page-lines"))
    mixed = F.array_contains("marked", False)
    rows = parsed.where("host <> ''").select("row", "host", "path", mixed.alias("mixed"), *_forms())
    deletions = deleted_places(rows)
    open_pages = parsed.where(mixed).select("row", "page_id", "url", "lines", "marked", "host", _forms()[-1])
    told = open_pages.join(deletions, ["host", "form"], "left").select("page_id", "url", "lines", "marked", "shared")
    texts = T.StructType([*parsed.select("page_id", "url").schema, T.StructField("text", T.StringType())])
    out = parsed.where(~mixed).select("page_id", "url", F.array_join("lines", "\n").alias("text")).unionByName(
        told.mapInArrow(_differenced, texts))
    return out.select(F.col("page_id").alias(key), F.col("url").alias(url), "text")
