"""Main text of HTML pages by tag-path ratios.

Every block of text has a path of tags from the root to the block element that holds it. Paths repeat
within a page and over the pages of a site, and tell content from the rest: paths of content hold much
text and punctuation for each block and little of it in links. Per site and path these are added up over all
pages, smoothed with the sums of the enclosing elements, and fused into one score:

    log(1 + text per block) * (1 + log(1 + punctuation per block)) * (1 - share of text in links)

Of a page those paths are selected whose score reaches the deviation of the scores of the page's blocks, so
a page whose paths are all alike keeps all of them. Elements that say what they are (menus, footers, asides,
forms, scripts, and elements whose class, id or role names a menu, an advert, comments and so on) have no part in
it; where a page marks its article (``article``, ``main``), only paths within are meant.

A page is read twice: once for its paths, of which small rows of numbers are staged, and once for the text of
the selected ones. Paths are 64-bit hashes, so deep pages cost no more than others. Equal pages of a site
are one page in the second step, and its result meets them by digest.

Results in special cases: a null or empty html, or one without text, gives an empty text; a page without
url belongs to a site of its own; unclosed elements end where HTML lets them end, at the page's end at the
latest; text beyond a comment, a script or a tag that is not closed is lost with it; ``header`` elements within an
article are a part of it; repeated rows and null ids stay as they are; an empty table gives no row.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.staging import stage

#: Fixed values of HTML: elements without an end, raw text, elements that begin a block, and what ends a paragraph's kin.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

#: Fixed word lists: elements that are no content, and words of classes, ids and roles that say so.
OUTSIDE = frozenset("head nav footer aside form menu dialog script style noscript template svg math object canvas button select textarea iframe audio video".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promotion banner "
    "sidebar menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer comment comments commentlist disqus "
    "reply replies respond cookie cookies consent gdpr notice notices newsletter subscribe subscription popup modal overlay share "
    "sharing social related recommended widget widgets toolbar masthead login signup search complementary contentinfo".split()
)
PAGE_TOP = frozenset(["header"])
ARTICLE = frozenset(["article", "main"])
NAMED = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

TOKEN = re.compile(r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/><]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+>|[^>]*>)", re.S)
MARKS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
LEVELS = 4


@dataclass(slots=True)
class Element:
    name: str
    path: int
    outside: bool
    article: bool
    link: bool
    block: Element | None  # the nearest block element, itself included
    up: tuple[int, ...]  # paths of the nearest enclosing blocks below the body


@lru_cache(maxsize=65_536)
def child_path(path: int, name: str) -> int:
    """Hash of a path that goes on with one more tag, a signed 64-bit number."""
    value = (path * 0x9E3779B97F4A7C15 + crc32(name.encode(errors="replace")) * 0xBF58476D1CE4E5B9 + 1) & (1 << 64) - 1
    value = (value ^ value >> 31) * 0x94D049BB133111EB & (1 << 64) - 1
    return (value ^ value >> 29) - (1 << 63)


@lru_cache(maxsize=65_536)
def marks(attributes: str) -> tuple[frozenset[str], bool]:
    """Words of class, id and role that tell what an element is; whether it is the page's main part."""
    found = [(k.lower(), v.strip("\"'")) for k, v in MARKS.findall(attributes)]
    words = {w.lower() for _, v in found for w in NAMED.findall(v)}
    return frozenset(words & (WORDS | PAGE_TOP)), any(k == "role" and v.lower() == "main" for k, v in found)


def opened(name: str, attributes: str, parent: Element) -> Element:
    """The element that a start tag begins below ``parent``."""
    words, main = marks(attributes) if "=" in attributes else (frozenset(), False)
    article = parent.article or main or name in ARTICLE
    outside = parent.outside or name in OUTSIDE or name not in ("html", "body", "main") and bool(words & WORDS)
    if not article:
        outside = outside or name == "header" or bool(words & PAGE_TOP)
    link = parent.link or name == "a"
    if name not in BLOCKS:
        return Element(name, parent.path, outside, article, link, parent.block, parent.up)
    path = child_path(parent.path, f"{name}*" if main else name)
    up = () if name in ("html", "body") else (path, *parent.up)[:LEVELS]
    one = Element(name, path, outside, article, link, None, up)
    one.block = one
    return one


def blocks(page: str) -> Iterator[tuple[Element, str, int]]:
    """(block element, text, characters in links) of every run of text that is no part of menus and the like."""
    root = Element("", 0, False, False, False, None, ())
    root.block = root
    stack, counts, run = [root], {}, []
    at, size = 0, len(page)

    def flush() -> Iterator[tuple[Element, str, int]]:
        if run:
            text = " ".join("".join(t for t, _ in run).split())
            linked = sum(len(t.strip()) for t, link in run if link)
            block = stack[-1].block
            run.clear()
            if text:
                yield block, text, min(linked, len(text))

    def close(upto: int) -> None:
        while len(stack) > upto:
            counts[stack.pop().name] -= 1

    while at < size:
        begin = page.find("<", at)
        token = TOKEN.match(page, begin) if begin >= 0 else None
        end = size if begin < 0 else begin
        cut_off = begin >= 0 and not token and page[begin + 1 : begin + 2].isalpha()  # a tag that never ends
        if begin >= 0 and not token and not cut_off:
            end = begin + 1  # a sign that begins no tag is text
        if end > at and not stack[-1].outside:
            run.append((markup.unescape(page[at:end]), stack[-1].link))
        at = size if cut_off else end if not token else token.end()
        if not token or not token[2]:
            continue
        name = token[2].lower()
        if name == "br" and not stack[-1].outside:
            run.append((" ", False))
        if token[1]:
            if not counts.get(name):
                continue
            place = len(stack) - 1
            while stack[place].name != name:
                place -= 1
            if any(e.name in BLOCKS for e in stack[place:]):
                yield from flush()
            close(place)
            continue
        if name in BLOCKS:
            yield from flush()
            if counts.get("p"):
                place = len(stack) - 1
                while stack[place].name != "p":
                    place -= 1
                close(place)
            if name in ENDS and any(counts.get(n) for n in ENDS[name]):
                place = len(stack) - 1
                while place and stack[place].name not in ENDS[name] and stack[place].name not in HOLDS[name]:
                    place -= 1
                if stack[place].name in ENDS[name]:
                    close(place)
            if name == "body" and counts.get("head"):
                close(next(i for i, e in enumerate(stack) if e.name == "head"))
        if name in VOID or token[3].endswith("/>") and name not in BLOCKS and name not in RAW:
            continue
        if name in RAW:
            ended = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = ended.end() if ended else size
            continue
        one = opened(name, token[3], stack[-1])
        if one.outside and not stack[-1].outside:
            yield from flush()
        stack.append(one)
        counts[name] = counts.get(name, 0) + 1
    yield from flush()


PATHS = "site string, digest string, `path` bigint, `up` array<bigint>, article boolean, `blocks` bigint, chars bigint, marks bigint, linked bigint"


def page_paths(pages: DataFrame) -> DataFrame:
    """A row per page and path of ``pages(site, digest, html)``: blocks, characters, punctuation and characters in links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("site", pa.string()), ("digest", pa.string()), ("path", pa.int64()), ("up", pa.list_(pa.int64())), ("article", pa.bool_())]
            + [(c, pa.int64()) for c in ("blocks", "chars", "marks", "linked")]
        )
        for batch in batches:
            rows = []
            for site, digest, page in zip(*(batch.column(c) for c in ("site", "digest", "html")), strict=True):
                sums: dict[int, list] = {}
                for block, text, linked in blocks(page.as_py()):
                    one = sums.setdefault(block.path, [list(block.up), block.article, 0, 0, 0, 0])
                    for i, n in enumerate((1, len(text), len(PUNCTUATION.findall(text)), linked), start=2):
                        one[i] += n
                rows += [(site.as_py(), digest.as_py(), path, *one) for path, one in sums.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return pages.select("site", "digest", "html").mapInArrow(run, PATHS)


def path_scores(paths: DataFrame) -> DataFrame:
    """``(site, path, score)``: ratios over all pages of a site, smoothed along the enclosing elements and fused."""
    sums = [F.sum(c).alias(c) for c in ("blocks", "chars", "marks", "linked")]
    # the path names its enclosing elements, so they are the same in all rows of a path
    own = stage(paths.groupBy("site", "path", "up").agg(*sums), "paths")
    near = own.select("site", "path", F.posexplode("up").alias("level", "above"), "blocks", "chars", "marks", "linked")
    # sums of all that an element encloses; a path is the first of its own list and stands for itself
    around = near.groupBy("site", "above").agg(*sums)
    above = near.where("level > 0").select("site", "path", F.pow(F.lit(0.5), "level").alias("w"), "above").join(around, ["site", "above"])
    smooth = above.groupBy("site", "path").agg(
        F.sum("w").alias("w"), *[F.sum(F.col("w") * F.col(c) / F.col("blocks")).alias(f"{c}_above") for c in ("chars", "marks")]
    )
    w = 1 + F.coalesce("w", F.lit(0.0))
    text = (F.col("chars") / F.col("blocks") + F.coalesce("chars_above", F.lit(0.0))) / w
    punctuation = (F.col("marks") / F.col("blocks") + F.coalesce("marks_above", F.lit(0.0))) / w
    score = F.log1p(text) * (1 + F.log1p(punctuation)) * (1 - F.col("linked") / F.col("chars"))
    return own.join(smooth, ["site", "path"], "left").select("site", "path", score.alias("score"))


def selected_paths(paths: DataFrame, scores: DataFrame) -> DataFrame:
    """``(site, digest, chosen)``: the paths of each page whose blocks are content."""
    each = paths.groupBy("site", "digest", "path").agg(F.max("article").alias("article"), F.max("blocks").alias("blocks"))
    scored = each.join(scores, ["site", "path"])
    inside = F.when(F.col("article"), F.col("blocks"))
    facts = F.collect_list(F.struct("path", "score", "article", "blocks")).alias("facts")  # the distinct paths of one page
    page = scored.groupBy("site", "digest").agg(
        facts,
        F.sum("blocks").alias("n"),
        (F.sum(F.col("score") * F.col("blocks")) / F.sum("blocks")).alias("mean"),
        (F.sum(F.col("score") * F.col("score") * F.col("blocks")) / F.sum("blocks")).alias("square"),
        F.coalesce(F.sum(inside), F.lit(0)).alias("inside"),
    )
    bar = F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    chosen = F.filter("facts", lambda f: F.when(F.col("inside") > 0, f["article"]).otherwise(f["score"] >= bar))
    return page.select("site", "digest", F.transform(chosen, lambda f: f["path"]).alias("chosen"))


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row per row of ``pages(page_id, url, html)``."""
    site = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    given = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    given = given.select("*", site.alias("site"), F.sha2("html", 256).alias("digest"))
    paths = stage(page_paths(given), "page-paths")
    chosen = stage(selected_paths(paths, stage(path_scores(paths), "path-scores")), "chosen-paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, some in zip(batch.column("html"), batch.column("chosen"), strict=True):
                some = set(some.as_py() or ())
                texts.append(" ".join(text for block, text, _ in blocks(page.as_py()) if block.path in some) if some else "")
            cols = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema if f.name in ("page_id", "url"))
    met = given.join(chosen, ["site", "digest"], "left").select("page_id", "url", "html", "chosen")
    return met.mapInArrow(run, f"{kinds}, text string").withColumn("n_chars", F.length("text").cast("bigint"))
