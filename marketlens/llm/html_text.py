"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: each opened tag with its path, and below a
path the words of short text blocks or, for longer blocks, the whole block.
Over the pages of one host every token has an occurrence vector, its count on
each page.  Tokens with the same vector form an equivalence class; large
classes on many pages are what the site's template prints.  Classes that nest
in one another's gaps make up the host's template; its fixed text is removed
and the slots between remain.  Of these, the slots of the article are
extracted: regions that their tag or their class, id or role names as menu,
header, footer, sidebar, notice, advert, form or comments are not.  Where
no element says that it is the article, the template alone tells fixed text.

Occurrence vectors are never collected: a vector is represented by its support,
total and two commutative hashes over (page, count), all of which add up
in partial aggregates.  A host with a third of all pages is therefore no
large group; only its few frequent tokens ever meet.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.shared import stored, table

SHORT_BLOCK = 12
MIN_SHARE = 0.6
MIN_PAGES = 10
FEW_PAGES = 3
MIN_CLASS = 2
BROADCAST_TOKENS = 500_000
FLUSH = 100_000
_M = (1 << 64) - 1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>?|[^<]++|<", re.S | re.I)
#: Elements whose content is no text; the end tag of each.
_RAW_ENDS = {t: re.compile(rf"</{t}\s*+>", re.I) for t in
             "script style textarea template noscript iframe svg math select object xmp title".split()}
#: Of these, those that run to the end of the page without an end tag; others are ordinary elements then.
_TO_THE_END = frozenset("script style textarea title iframe".split())
_NAMES = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.I)
_CLASS = re.compile(r"\bclass\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.I)
_PIECES = re.compile(r"[a-z]+|[A-Z][a-z]*")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
NO_CONTENT = frozenset("head nav aside footer form button dialog menu".split())
MAIN = frozenset(["article", "main"])
#: Pieces of class, id and role that name a region outside the article.
OUTSIDE = frozenset("nav navbar navigation menu menubar header masthead footer foot sidebar aside rail ad ads advert adverts "
                    "advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
                    "popup modal overlay alert comment comments respond disqus replies reply share sharing social related "
                    "recommended breadcrumb breadcrumbs pagination pager newsletter subscribe signup login search form "
                    "widget toolbar contentinfo complementary".split())
#: Pieces that name a region with the article in it, whatever else its name holds.
INSIDE = frozenset("article main content post entry story body page wrapper container layout".split())
#: Of the outside names, those that count even so.
ALWAYS = frozenset("comment comments disqus replies ad ads advert adverts sidebar related newsletter share cookie".split())
#: Of the outside names, those that an article's own parts have too.
IN_ARTICLE = frozenset("alert notice banner form foot overlay header rail".split())
#: Pieces that go with an outside name without another meaning.
PLAIN = frozenset("a and bar block bottom box button buttons container count group icon icons inline inner item items left link "
                  "links list outer primary right section the title top widget widgets wrap wrapper".split())


def _tokens(attributes: str) -> list[frozenset[str]]:
    """The pieces of each class, id and role name."""
    return [frozenset(p.lower() for p in _PIECES.findall(t)) for m in _NAMES.finditer(attributes)
            for t in (m[1] or m[2] or m[3] or "").split()]


def _names_outside(tokens: list[frozenset[str]]) -> bool:
    """Whether a name of an element inside an article as a whole, not one piece of it, says that it is no part of it."""
    return any(t & ALWAYS or t & OUTSIDE - IN_ARTICLE and t <= OUTSIDE | PLAIN for t in tokens)


def _names(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    return frozenset(p.lower() for m in _NAMES.finditer(attributes) for p in _PIECES.findall(m[1] or m[2] or m[3] or ""))


def _region(tag: str, names: frozenset[str], inside: bool) -> tuple[bool, bool]:
    """Whether an element is outside the article; whether it is the article."""
    if tag in NO_CONTENT or tag == "header" and not inside:
        return True, False
    if names and tag not in ("html", "body"):
        outside = names & OUTSIDE
        if outside and not (inside and outside <= {"header"}):
            if not names & INSIDE or outside & ALWAYS and not outside <= {"sidebar"} and tag not in MAIN - {"article"}:
                return True, False
    return False, tag in MAIN or "main" in names and tag != "body" or "article" in names


class Block:
    """A run of text without a block boundary: its path, words, and where it stands."""

    __slots__ = ("path", "words", "outside", "inside", "linked", "named")

    def __init__(self, path, words, outside, inside, linked, named):
        self.path, self.words, self.outside, self.inside, self.linked = path, words, outside, inside, linked
        self.named = named


class Named:
    """An element that its names put outside: the one around it, its words, whether an article is in it or is it, and
    whether a whole name of it says that the article is in it."""

    __slots__ = ("around", "n", "main", "own", "holds")

    def __init__(self, around, main, holds):
        self.around, self.n, self.main, self.own, self.holds = around, 0, False, main, holds


def _put_outside(blocks: list[Block], named: list[Named]) -> None:
    """Blocks in named elements are outside, but an element with most of the page's words and the article is not."""
    open_blocks = [b for b in blocks if not b.outside]
    total = sum(len(b.words) for b in open_blocks)
    for b in open_blocks:
        if b.named >= 0:
            named[b.named].n += len(b.words)
    out = [True] * len(named)
    for i in range(len(named) - 1, -1, -1):  # inner ones first
        e = named[i]
        out[i] = not (2 * e.n > total and (e.main or e.own or e.holds))
        if e.around >= 0:
            named[e.around].n += e.n
            named[e.around].main |= e.main or e.own and not out[i]
    if total and all(b.named >= 0 for b in open_blocks) and all(out[b.named] for b in open_blocks):
        # nothing is left: the largest of the outermost ones stays
        out[max((i for i, e in enumerate(named) if e.around < 0), key=lambda i: named[i].n)] = False
    for i, e in enumerate(named):  # outer ones first
        out[i] |= e.around >= 0 and out[e.around]
    for b in open_blocks:
        b.outside = b.named >= 0 and out[b.named]


def parse(page: str) -> tuple[list[int], list[Block]]:
    """The paths of all opened tags and the text blocks, in page order.

    A path is a hash of the path around it, the tag and its class, and end tags
    without an open element are told by a count, so time and memory are linear.
    """
    paths: list[int] = []
    blocks: list[Block] = []
    named: list[Named] = []
    # tag, hash of the path, outside, inside, link, element named as outside, place of the innermost block element
    stack = [("", 0, False, False, False, -1, 0)]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = total = 0

    def flush():
        nonlocal linked, total
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                _, path, outside, inside, _, around, _ = where
                blocks.append(Block(path, words, outside, inside, linked > 0.5 * total, around))
            parts.clear()
            linked = total = 0

    def close(i):
        opened.subtract(e[0] for e in stack[i:])
        del stack[i:]

    where = stack[0]
    at, unclosed = 0, set()
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            text = m[0]
            if text[0] != "<" or text == "<":
                if not parts:
                    where = stack[-1]
                parts.append(text)
                total += len(text)
                if stack[-1][4]:
                    linked += len(text)
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag not in INLINE:
                flush()
            if opened[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in _RAW_ENDS and tag not in unclosed:
            if tag in ("svg", "math") and attributes.endswith("/"):
                continue
            end = _RAW_ENDS[tag].search(page, at)
            if end or tag in _TO_THE_END:
                at = end.end() if end else len(page)
                continue
            unclosed.add(tag)
        if tag == "br":
            parts.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            closes = ("li",) if tag == "li" else ("dt", "dd") if tag in ("dt", "dd") else ("tr",) if tag == "tr" else \
                ("td", "th") if tag in ("td", "th") else ("p",)
            i = stack[-1][6]
            while i and any(opened[t] > 0 for t in closes):  # ends that may be left out
                if stack[i][0] in closes:
                    close(i)
                    break
                if stack[i][0] != "p":
                    break
                i = stack[i - 1][6]
        _, path, outside, inside, link, around, block = stack[-1]
        names = _names(attributes) if attributes else frozenset()
        c = _CLASS.search(attributes) if names else None
        path = _hash(f"{path:x}/{tag}.{c[1] or c[2] or c[3]}" if c else f"{path:x}/{tag}")
        out, main = _region(tag, names, inside)
        if not attributes.endswith("/"):
            main = main or tag in MAIN
            if out and names & OUTSIDE and not (tag in NO_CONTENT or tag == "header" and not inside):
                tokens = _tokens(attributes)
                out = False
                if not inside or tag in MAIN or _names_outside(tokens):
                    named.append(Named(around, tag in MAIN, any(t and t <= INSIDE for t in tokens)))
                    around = len(named) - 1
            elif main and not out and around >= 0:
                named[around].main = True
            stack.append((tag, path, outside or out, inside or main, link or tag == "a", around,
                          block if tag in INLINE else len(stack)))
            opened[tag] += 1
        paths.append(path)
    flush()
    _put_outside(blocks, named)
    return paths, blocks


def block_tokens(b: Block) -> list[int]:
    """The block's tokens: its words, or for a longer block the block."""
    texts = b.words if len(b.words) <= SHORT_BLOCK else [" ".join(b.words)]
    return [_hash(f"{b.path:x}\0{w}") for w in texts]


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "replace")) or 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token) -> support, total, sum of first places, hashes of the vector; added up while memory allows."""
    found: dict[tuple[str, int], list[int]] = {}

    def out():
        rows = [(h, _signed(t), *v[:3], _signed(v[3]), v[4], bool(v[5])) for (h, t), v in found.items()]
        found.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), *[pa.int64()] * 6, pa.bool_()))],
            names=["__host", "__token", "__support", "__total", "__place", "__x", "__s", "__is_text"])

    for batch in batches:
        for host, key, page in zip(*(batch.column(c).to_pylist() for c in ("__host", "__page", "__html"))):
            paths, blocks = parse(page)
            texts = [t for b in blocks for t in block_tokens(b)]
            tokens = paths + texts
            place: dict[int, int] = {}
            for i, t in enumerate(tokens):
                place.setdefault(t, i)
            is_text, counts = set(texts), Counter(tokens)
            counts[0] = 1  # the page itself
            for t, n in counts.items():
                x = ((key & _M) ^ n * 0x9E3779B97F4A7C15) * 0xFF51AFD7ED558CCD & _M
                x ^= x >> 31
                v = found.get((host, t))
                if v is None:
                    found[host, t] = [1, n, place.get(t, 0), x, x >> 32, t in is_text]
                else:
                    v[0] += 1
                    v[1] += n
                    v[2] += place.get(t, 0)
                    v[3] ^= x
                    v[4] += x >> 32
            if len(found) > FLUSH:
                yield out()
    if found:
        yield out()


def nested(classes: list[dict]) -> list[dict]:
    """The classes that form a template: by support and size, each in one gap of every class accepted before, or
    the class before in one of its own."""
    accepted: list[tuple[np.ndarray, dict]] = []
    for c in sorted(classes, key=lambda c: (-c["support"], -len(c["tokens"]), min(t["token"] for t in c["tokens"]))):
        at = np.sort([t["place"] for t in c["tokens"]])
        if all(np.ptp(np.searchsorted(a, at)) == 0 or np.ptp(np.searchsorted(at, a)) == 0 for a, _ in accepted):
            accepted.append((at, c))
    return [c for _, c in accepted]


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fixed, always = [], []
        for pages, classes in zip(batch.column("pages").to_pylist(), batch.column("classes").to_pylist()):
            template = [(c["support"], t["token"]) for c in nested(classes) for t in c["tokens"] if t["text"]]
            fixed.append([t for _, t in template])
            always.append([t for n, t in template if n == pages])
        yield pa.RecordBatch.from_arrays([batch.column("__host"), batch.column("pages"),
                                          *(pa.array(c, pa.list_(pa.int64())) for c in (fixed, always))],
                                         names=["__host", "__pages", "__fixed", "__always"])


def host_templates(pages: DataFrame, min_share: float = MIN_SHARE, min_pages: int = MIN_PAGES,
                   min_class: int = MIN_CLASS) -> DataFrame:
    """(__host, __pages, __fixed, __always): the hosts' numbers of pages, the fixed text tokens of their templates and,
    of these, the ones that all pages have equally often, from (__host, __page, __html).

    A token counts from ``min_share`` of its host's pages on, a class from
    ``min_class`` tokens and a host from ``min_pages`` pages on.  At most
    1 / ``min_share`` times the tokens of an average page count, so a host's
    classes are a bounded list.
    """
    seen = pages.mapInArrow(_occurrences, "__host string, __token long, __support long, __total long, __place long, "
                                          "__x long, __s long, __is_text boolean")
    sums = stored(seen.groupBy("__host", "__token").agg(
        F.sum("__support").alias("support"), F.sum("__total").alias("total"), F.sum("__place").alias("place"),
        F.bit_xor("__x").alias("x"), F.sum("__s").alias("s"), F.bool_or("__is_text").alias("text"))
        .where(F.col("support") >= 2), "occurrences")
    hosts = sums.where("__token = 0").select("__host", F.col("support").alias("pages")).where(F.col("pages") >= min_pages)
    often = sums.where("__token <> 0").join(hosts, "__host").where(F.col("support") >= F.col("pages") * min_share)
    token = F.struct(F.col("__token").alias("token"), (F.col("place") / F.col("support")).alias("place"), "text")
    classes = often.groupBy("__host", "support", "total", "x", "s").agg(
        F.max("pages").alias("pages"), F.collect_list(token).alias("tokens"))
    classes = classes.where(F.size("tokens") >= min_class)
    per_host = classes.groupBy("__host").agg(F.max("pages").alias("pages"),
                                             F.collect_list(F.struct("support", "tokens")).alias("classes"))
    return per_host.mapInArrow(_templates, "__host string, __pages long, __fixed array<long>, __always array<long>")


def main_text(page: str, fixed: frozenset[int], always: frozenset[int] = frozenset()) -> str:
    """The article's slots, blocks joined by one space.

    ``fixed`` is the text of the host's template, ``always`` the part of it
    that all pages have.  Where an element says that it is the article, its
    blocks are slots but for fixed text.  Elsewhere the template says which
    blocks are: all but those of ``always``, and of the other fixed text.
    Other fixed text stays where it is most of a page, and all of a page's
    text where nothing else is left: copies of an article are no template.
    """
    _, blocks = parse(page)
    open_blocks = [b for b in blocks if not b.outside]
    chosen = [b for b in open_blocks if b.inside]
    if not chosen:
        chosen = [b for b in open_blocks if not b.linked]
        if always:
            chosen = [b for b in chosen if not all(t in always for t in block_tokens(b))] or chosen
    if fixed:
        slots = [b for b in chosen if not all(t in fixed for t in block_tokens(b))]
        if 2 * sum(len(b.words) for b in slots) >= sum(len(b.words) for b in chosen):
            chosen = slots
    return " ".join(w for b in chosen for w in b.words)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fixed, always = ([frozenset(t & _M for t in f) if f else frozenset() for f in batch.column(c).to_pylist()]
                         for c in ("__fixed", "__always"))
        texts = [main_text(p, f, a) for p, f, a in zip(batch.column("__html").to_pylist(), fixed, always)]
        yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__url"), pa.array(texts, pa.string())],
                                         names=["__id", "__url", "__text"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", min_pages: int = MIN_PAGES,
            few_pages: int = FEW_PAGES, **settings) -> DataFrame:
    """(``page_id``, ``url``, text): one row per page.

    Text on all pages of a host of ``few_pages`` or more is template where
    no element says that it is the article; the rest of a template counts from
    ``min_pages`` pages on, since a few pages may share a passage.

    Null and empty html give an empty text.  Pages whose url is null or names
    no host are one host of their own.  Repeated rows are pages of their own.
    A page without any article element gives all its text outside other
    regions.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(page_id).alias("__id"), F.col(url).alias("__url"), host.alias("__host"),
                        F.coalesce(F.col(page), F.lit("")).alias("__html"))
    key = F.xxhash64("__id", "__url", "__html").alias("__page")
    templates = host_templates(rows.select("__host", key, "__html"), min_pages=min(few_pages, min_pages), **settings)
    templates = stored(templates.select("__host", F.when(F.col("__pages") >= min_pages, F.col("__fixed")).alias("__fixed"),
                                        "__always"), "templates")
    known = templates.agg(F.sum(F.coalesce(F.size("__fixed"), F.lit(0)) + F.size("__always") + 1)).first()[0] or 0
    if known <= BROADCAST_TOKENS:  # else a join that deals the pages by host and splits large hosts
        templates = F.broadcast(templates)
    found = rows.join(templates, "__host", "left").select("__id", "__url", "__html", "__fixed", "__always")
    id_type = pages.schema[page_id].dataType.simpleString()
    return found.mapInArrow(_extract, f"__id {id_type}, __url string, __text string").toDF(page_id, url, "text")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
