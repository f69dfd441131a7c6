"""Main text of web pages by template deduction.

A page is a sequence of tokens: tags with their attributes' names and class, and
blocks of text, each told apart by the path of open tags above it.  How often a token
occurs in each page of its host is its occurrence vector.  Tokens with equal
vectors are an equivalence class; a class that occurs in enough pages and has
enough tokens is part of the host's template, and classes nest by the order of
their tokens.  What stands between template tokens is a slot.

Vectors are never collected: their sum of page numbers (hashed) times counts is
equal for equal vectors and is added up by Spark like any other sum, so a host may
have any share of all pages.  Only tokens that are in a third of the pages of a host,
or of one layout of it, can be template; they are few and are kept as a small table.

The main region is the slot that holds most of the distinct text.  Of it, template
text and slots that a tag or class name tells to be a menu, notice, advert, form,
comments and the like are left out.  Pages without a template go by these names alone.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bytesift.llm.store import stored

# HTML's own lists.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " section summary table tbody td tfoot th thead tr ul".split()
)
OUTSIDE = set("nav header footer aside form menu dialog button select option head fieldset".split())
# Of these, what never holds the article; a form or header may be put around a whole page.
MENUS = set("nav footer aside menu button select option head".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# What can be the main region; paragraphs, lists and the like are in one.
PARTS = set("html body div section article main center form header dialog fieldset table tbody tr td".split())
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog"}
# Class or id words that name what is not the article.
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion nav navbar navigation menu"
    " breadcrumb breadcrumbs header footer sidebar side aside widget cookie cookies consent notice notices alert"
    " popup modal newsletter subscribe signup login share sharing social related recommended recommendations"
    " comment comments commentlist disqus reply replies respond toolbar pagination pager tags form search"
    " copyright legal disclaimer masthead".split()
)
# A new one of these ends an open one of the second set (HTML's optional end tags).
ENDS = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}

# Attributes one after the other: a name after white space or "/", then a quoted value or
# one that ends at white space or ">".  A quote only opens a value right behind "=".
VALUE = r"""(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|(?!["'])[^\s>]+)"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+{VALUE}?+)?+|=)*+)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(rf"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+({VALUE})?+)?+|=")
SPACE = re.compile(r"\s+")


def _attributes(rest: str) -> dict[str, str]:
    """Names in lower case with their values, the first of each name."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(rest):
        if m[1]:
            value = m[2] or ""
            if value[:1] in ('"', "'"):
                value = value[1:-1] if len(value) > 1 and value[-1] == value[0] else value[1:]
            found.setdefault(m[1].lower(), entities.unescape(value))
    return found


# What an element is by its own names.
HIDDEN, OUTER, NAMED, MAIN, NEVER, TITLE, HOLDER, HEADING = 1, 2, 4, 8, 16, 32, 64, 128


def _kind(tag: str, attributes: dict[str, str]) -> int:
    """The flags of an element by its tag, role, class and id."""
    kind = 0
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in SPACE.sub("", attributes.get("style", "")).lower():
        kind |= HIDDEN
    if tag in OUTSIDE or attributes.get("role", "").lower() in ROLES:
        kind |= OUTER
    if tag in MENUS:
        kind |= NEVER
    if tag in ("article", "main"):
        kind |= MAIN
    elif tag not in ("html", "body"):
        names = re.split(r"[^A-Za-z0-9]+", f"{attributes.get('class', '')} {attributes.get('id', '')}".lower())
        if any(n in ASIDE_WORDS for n in names):
            kind |= NAMED
    return kind | (TITLE if tag == "h1" else 0) | (HOLDER if tag in PARTS else 0) | (HEADING if tag in HEADINGS else 0)


@lru_cache(maxsize=1 << 14)
def _element(tag: str, rest: str) -> tuple[int, str]:
    """The flags of an element, and its tag with its class; few differ on a host."""
    attributes = _attributes(rest)
    return _kind(tag, attributes), tag + ("." + attributes["class"] if attributes.get("class") else "")


def _token(parent: int, kind: str, value: str) -> int:
    """64 bits of a tag or text and the path above it."""
    hashed = hashlib.blake2b(f"{parent}{kind}{value}".encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(hashed.digest(), "little", signed=True)


@lru_cache(maxsize=1 << 16)
def _tag_token(parent: int, label: str) -> int:
    return _token(parent, "/", label)


# Elements nested deeper than this count as children of the one at this depth, with the
# flags of those between; so a path has a bounded length however many tags stay open.
DEPTH = 128


class Page:
    """The elements of one page and its blocks of text, each with the element it is in."""

    def __init__(self, source: str):
        self.parents: list[int] = []  # of each element, -1 at the top
        self.tokens: list[int] = []  # tag and path
        self.kinds: list[int] = []
        self.at: list[int] = []  # of each block
        self.texts: list[str] = []
        self._read(source)

    def above(self, element: int) -> list[int]:
        """The element and those around it, innermost first."""
        found = []
        while element >= 0:
            found.append(element)
            element = self.parents[element]
        return found

    def words(self) -> list[int]:
        """The tokens of the blocks."""
        return [_token(self.tokens[e] if e >= 0 else 0, "#", t) for e, t in zip(self.at, self.texts)]

    def layout(self) -> int:
        """The same for pages whose outermost three levels have the same paths."""
        depth: list[int] = []
        for parent in self.parents:
            depth.append(depth[parent] + 1 if parent >= 0 else 1)
        return _token(0, "L", ",".join(map(str, sorted({t for t, d in zip(self.tokens, depth) if d <= 3})))) or 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = []  # tag, element
        pieces: list[str] = []
        depths: list[int] = []
        still_open: Counter[str] = Counter()
        at = 0

        def flush() -> None:
            text = SPACE.sub(" ", entities.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                self.at.append(stack[-1][1] if stack else -1)
                self.texts.append(text)

        def leave(n: int) -> None:
            for tag, _ in stack[n:]:
                still_open[tag] -= 1
            del stack[n:]

        def close(n: int) -> None:
            flush()
            leave(n)

        while True:
            found = TOKEN.search(source, at)
            if not found:
                pieces.append(source[at:])
                break
            pieces.append(source[at : found.start()])
            at = found.end()
            if found["tag"] is None:
                continue
            tag = found["tag"].lower()
            if found["end"]:
                if not still_open[tag]:
                    if tag in BLOCK:
                        flush()
                    continue
                n = len(stack) - 1
                while stack[n][0] != tag:
                    n -= 1
                if tag in BLOCK or any(t in BLOCK for t, _ in stack[n:]):
                    flush()
                leave(n)
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if tag == "br":
                pieces.append(" ")
            if tag in BLOCK:
                flush()
                for n in range(len(stack) - 1, -1, -1):
                    if stack[n][0] in ENDS.get(tag, ()) or stack[n][0] == "p":
                        close(n)
                        break
                    if stack[n][0] in BLOCK:
                        break
            kind, label = _element(tag, found["rest"])
            parent = stack[-1][1] if stack else -1
            if parent >= 0 and depths[parent] >= DEPTH:
                kind |= self.kinds[parent] & (HIDDEN | OUTER | NAMED | NEVER)
                parent = self.parents[parent]
            depths.append(depths[parent] + 1 if parent >= 0 else 1)
            self.parents.append(parent)
            self.tokens.append(_tag_token(self.tokens[parent] if parent >= 0 else 0, label))
            self.kinds.append(kind)
            if tag not in VOID:
                stack.append((tag, len(self.tokens) - 1))
                still_open[tag] += 1
        flush()


def _by_slots(page: Page, words: list[int], slots: dict[int, int], fixed: set[int]) -> list[str] | None:
    """The article by the template: ``slots`` has the distinct text of each slot in
    characters, by the tag token that it is next under, ``fixed`` the template's text.

    From the top, the path goes on to the slot that has more than half of the text,
    until none has, or it is an article or main, or a title would be left behind.
    """
    above = [page.above(e) for e in range(len(page.tokens))]
    out = [any(page.kinds[a] & (HIDDEN | NEVER) for a in chain) for chain in above]
    chains: dict[int, list[int]] = {}  # of each slot of this page, the parts of a page that it is in, outermost first
    main = set()
    for e, chain in enumerate(above):
        if page.tokens[e] in slots and not out[e]:
            around = [page.tokens[a] for a in reversed(chain) if page.tokens[a] in slots and page.kinds[a] & HOLDER]
            chains.setdefault(page.tokens[e], around)
            if page.kinds[e] & MAIN:
                main.add(page.tokens[e])
    if not chains:
        return None
    titles = [
        {page.tokens[a] for a in above[e]}
        for e, w in zip(page.at, words)
        if e >= 0 and w not in fixed and not out[e] and any(page.kinds[a] & TITLE for a in above[e])
        and not any(page.kinds[a] & OUTER for a in above[e])
    ]
    weights: dict[int, int] = {}
    for token, chain in chains.items():
        for a in chain:
            weights[a] = weights.get(a, 0) + slots[token]
    here, whole, depth = None, sum(slots[t] for t in chains), 0
    while here not in main:
        inner = {c[depth] for c in chains.values() if len(c) > depth and (here is None or here in c[:depth])}
        best = max(inner, key=lambda t: (weights[t], t), default=None)
        if best is None or 2 * weights[best] <= whole:
            break
        if here is not None and any(here in t and best not in t for t in titles):
            break
        here, whole, depth = best, weights[best], depth + 1

    kept = []
    for e, word, text in zip(page.at, words, page.texts):
        if e < 0:
            if here is None:
                kept.append((False, word, text))
            continue
        last = next((n for n, a in enumerate(above[e]) if page.tokens[a] == here), None)
        if (here is not None and last is None) or any(page.kinds[a] & HIDDEN for a in above[e]):
            continue
        inside = above[e][:last]
        # a name says what a slot is; in what is a page's own it says nothing
        if not any(page.kinds[a] & OUTER or (page.kinds[a] & NAMED and page.tokens[a] in slots) for a in inside):
            kept.append((any(page.kinds[a] & HEADING for a in above[e][:1]), word, text))
    # what an article, or a heading of any region, shares with other pages is its own
    if here in main:
        return [t for _, _, t in kept] or None
    # a region that is mostly the same on other pages is a copy, not a template
    same = sum(len(t) for _, w, t in kept if w in fixed)
    if 2 * same > sum(len(t) for _, _, t in kept):
        return [t for _, _, t in kept] or None
    return [t for heading, w, t in kept if heading or w not in fixed] or None


def _by_names(page: Page) -> list[str]:
    """The article by tags and class names, for pages without a template.

    The main slot is the longest article or main, or else each element with more than
    half of the text; what is around it is not left out for its names.
    """
    # parents come first: flags go down in one sweep, lengths go up in one back
    out = _down(page, lambda e: bool(page.kinds[e] & (HIDDEN | NEVER)))
    inside = [0] * len(page.tokens)
    for e, text in zip(page.at, page.texts):
        if e >= 0 and not out[e]:
            inside[e] += len(text)
    for e in range(len(page.tokens) - 1, -1, -1):
        if page.parents[e] >= 0:
            inside[page.parents[e]] += inside[e]
    mains = [e for e, kind in enumerate(page.kinds) if kind & MAIN and inside[e]]
    if mains:
        holds = set(page.above(max(mains, key=lambda e: inside[e])))
    else:
        whole = sum(len(t) for e, t in zip(page.at, page.texts) if e < 0 or not out[e])
        holds = {e for e, n in enumerate(inside) if 2 * n > whole}
    left = _down(page, lambda e: bool(page.kinds[e] & (HIDDEN | NEVER) or (page.kinds[e] & (OUTER | NAMED) and e not in holds)))
    main = _down(page, lambda e: bool(page.kinds[e] & MAIN))
    found = [(e >= 0 and main[e], text) for e, text in zip(page.at, page.texts) if e < 0 or not left[e]]
    any_main = any(m for m, _ in found)
    return [text for is_main, text in found if is_main or not any_main]


def _down(page: Page, own) -> list[bool]:
    """Whether ``own`` holds for each element or one around it."""
    held: list[bool] = []
    for e, parent in enumerate(page.parents):
        held.append((parent >= 0 and held[parent]) or own(e))
    return held


def _host() -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


# A token is template if it is in at least LEAST_PAGES pages and this share of the
# pages of its host or of its host's layout, in a class of at least LEAST_CLASS tokens.
LEAST_PAGES = 3
LEAST_SHARE = 1 / 3
LEAST_CLASS = 2


def template_tokens(pages: DataFrame) -> DataFrame:
    """(host, layout, tags, chars, fixed): the template of each layout of a host, and of
    all its pages (layout 0): its tag tokens with the characters of distinct text in the
    slot under each, and its text tokens.

    A token is a tag or a block of text with its path.  ``vector`` is the sum of
    count times a hash of the page, so equal occurrence vectors have equal sums; equal
    pages are one page.  A class is valid if its tokens are frequent and it is nested in
    the page, which its tags are by their paths; text alone is no template.
    """
    names = ["host", "layout", "mark", "token", "is_tag", "n", "chars", "path", "under"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, mark, source in zip(*[batch[c].to_pylist() for c in ("host", "mark", "html")]):
                page = Page(source or "")
                layout = page.layout()
                rows.append((host, layout, mark, 0, True, 1, 0, None, None))  # the page itself
                for token, n in Counter(page.tokens).items():
                    rows.append((host, layout, mark, token, True, n, 0, None, None))
                words = page.words()
                times, seen = Counter(words), set()
                for element, word, text in zip(page.at, words, page.texts):
                    if word not in seen:
                        seen.add(word)
                        under = [page.tokens[a] for a in reversed(page.above(element))]
                        rows.append((host, layout, mark, word, False, times[word], len(text), under[-1] if under else 0, under))
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    schema = "host STRING, layout BIGINT, mark BIGINT, token BIGINT, is_tag BOOLEAN, n INT, chars BIGINT, path BIGINT, under ARRAY<BIGINT>"
    rows = pages.select("host", F.xxhash64("html").alias("mark"), "html")
    found = rows.mapInArrow(read, schema)
    key = ["host", "layout"]
    per_page = found.groupBy(*key, "token", "mark", "is_tag").agg(
        *[F.first(c).alias(c) for c in ("n", "chars", "path", "under")]
    )
    # equal pages have one layout, so they are one page in either count
    both = per_page.withColumn("layout", F.explode(F.array(F.lit(0).cast("long"), "layout")))
    vectors = stored(
        both.groupBy(*key, "token", "is_tag").agg(
            F.count("*").alias("in_pages"),
            F.expr("sum(CAST(pmod(mark, 1000000007) AS DECIMAL(20, 0)) * n)").alias("vector"),
            *[F.first(c).alias(c) for c in ("chars", "path", "under")],
        ),
        "vectors",
    )
    counts = vectors.where("token = 0").select(*key, F.col("in_pages").alias("pages"))
    frequent = vectors.where(f"token <> 0 AND in_pages >= {LEAST_PAGES}").join(counts, key).where(f"in_pages >= pages * {LEAST_SHARE}")
    classes = frequent.groupBy(*key, "in_pages", "vector").agg(
        F.collect_list(F.expr("IF(is_tag, token, NULL)")).alias("tags"), F.collect_list(F.expr("IF(is_tag, NULL, token)")).alias("fixed")
    )
    valid = classes.where((F.size("tags") > 0) & (F.size("tags") + F.size("fixed") >= LEAST_CLASS))
    templates = stored(
        valid.groupBy(*key).agg(F.flatten(F.collect_list("tags")).alias("tags"), F.flatten(F.collect_list("fixed")).alias("fixed")), "classes"
    )
    # the text of each slot, by the innermost tag of the template that is around it
    paths = vectors.where("NOT is_tag").groupBy(*key, "path").agg(F.sum("chars").alias("chars"), F.first("under").alias("under"))
    slot = F.expr("element_at(array_append(filter(reverse(under), u -> array_contains(tags, u)), 0L), 1)")
    slots = paths.join(templates.select(*key, "tags"), key).groupBy(*key, slot.alias("slot")).agg(F.sum("chars").alias("chars"))
    sums = slots.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("slot", "chars"))).alias("of"))
    return templates.join(sums, key, "left").select(
        *key, "tags", F.expr("transform(tags, t -> coalesce(of[t], 0L))").alias("chars"), "fixed"
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages(page_id, url, html)``.

    Character references are decoded, white space inside a block is one space,
    blocks are trimmed and joined by two newlines in page order.  A NULL or empty
    page, or one without an article, has the empty text.  A url without a host is
    of the host of that name, the empty one.  Repeated rows come out as often as
    they came in; other columns are not looked at.
    """
    hosted = pages.select("page_id", "url", "html", _host().alias("host"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    templates = stored(template_tokens(hosted), "templates").select(
        F.col("host").alias("of"), F.col("layout").alias("kind"), F.struct("tags", "chars", "fixed").alias("template")
    )
    many, big = pa.list_(pa.int64()), "ARRAY<BIGINT>"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [Page(source or "") for source in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], batch["host"], pa.array([p.layout() for p in read], pa.int64())]
                + [pa.array([getattr(p, c) for p in read], many) for c in ("parents", "tokens", "kinds", "at")]
                + [pa.array([p.texts for p in read], pa.list_(pa.string()))],
                ["page_id", "url", "host", "layout", "parents", "tokens", "kinds", "at", "texts"],
            )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            names = ("template", "parents", "tokens", "kinds", "at", "texts")
            for template, parents, tokens, kinds, at, blocks in zip(*[batch[c].to_pylist() for c in names]):
                page = Page("")
                page.parents, page.tokens, page.kinds, page.at, page.texts = parents, tokens, kinds, at, blocks
                kept = None
                if template:
                    kept = _by_slots(page, page.words(), dict(zip(template["tags"], template["chars"])), set(template["fixed"]))
                texts.append("\n\n".join(_by_names(page) if kept is None else kept))
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    read = hosted.mapInArrow(
        parse,
        f"page_id {id_type}, url STRING, host STRING, layout BIGINT, parents {big}, tokens {big}, kinds {big}, at {big}, texts ARRAY<STRING>",
    )
    # the template of the page's layout, or else the host's
    own, host = templates.where("kind <> 0"), templates.where("kind = 0").select(F.col("of").alias("all_of"), F.col("template").alias("all"))
    joined = read.join(own, (read["host"] == own["of"]) & (read["layout"] == own["kind"]), "left")
    joined = joined.join(host, joined["host"] == host["all_of"], "left").withColumn("template", F.coalesce("template", "all"))
    columns = ["page_id", "url", "template", "parents", "tokens", "kinds", "at", "texts"]
    return (
        joined.select(*columns)
        .mapInArrow(choose, f"page_id {id_type}, url STRING, text STRING")
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
