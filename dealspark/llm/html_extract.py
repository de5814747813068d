"""Main text of HTML pages; boilerplate found by a suffix array per host.

All blocks of a page, its article included, form its token stream, and the
streams of a host one text.  ``repeated_blocks`` builds the array of its
suffixes at block starts: one range sort by (host, suffix, page body), so a
suffix that a third of all pages share is spread over many tasks.  Each task
reads its stretch in order and takes the common prefix of neighbours; the
stretches with a common prefix of whole blocks are the repeats.  Of each it
keeps up to ``LEAST`` distinct bodies and its places on the pages, which add up
where the ends of tasks cut a stretch.  A repeat of whole blocks (the entries
of a menu are one run) with ``RUN`` tokens or more on ``LEAST`` distinct bodies
is boilerplate if it belongs to the page and not to the text: ``FIXED`` of its
occurrences are equally many blocks from the page's start, or from its end.
Passages that texts share move about, and stay.  A suffix holds its first block
and what follows up to ``RUN`` more tokens: every block of any longer repeat
lies in such a prefix of it.

Inside blocks outside a marked article, ``repeated`` groups the suffixes at
every token by their first ``RUN`` tokens in the block; a run there is boilerplate if it is
on ``LEAST`` bodies and on the share ``SHARE`` of the host's, so passages and
phrases that some texts share stay.  The unique runs between stay.

Pages with equal blocks are one body, so copies of an article stay.  What the
markup says outright is checked afterwards: nothing stays from menus, page
headers, footers, sidebars, notices, adverts, forms, comments or scripts,
however unique; and nothing goes from inside a marked article, however often
it is repeated (copies and quoted passages are content).  ``main`` protects
nothing, as many sites wrap whole pages in it.

Defined results: a null or empty html gives an empty text; markup that ends
early (a cut page) ends the text there; rows that repeat id, url and html are
one page to the suffix array and one row each in the result; a null or
malformed url shares the host ''; an empty table gives an empty result.
Extra columns are not read and may have any name.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import small_batches

RUN = 6  # tokens a repeated substring has at least, at most 7
LEAST, SHARE = 3, 0.5  # distinct bodies of a host that boilerplate is on; share of them inside blocks
FIXED = 0.9  # share of a repeat's occurrences at one distance from an end of the page
CODE = 8  # bytes of a block in a suffix

# --- fixed values: HTML element and attribute names ----------------------------
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes")
CHROME = ("nav", "footer", "aside", "form", "head", "dialog", "menu", "button", "select", "svg", "canvas", "object", "audio", "video")
MAIN = ("article", "main")
BREAK = ("address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
         "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary",
         "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar")
NAMES = ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
         "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "newsletter", "subscribe",
         "subscription", "popup", "modal", "overlay", "sidebar", "sidebars", "menu", "menus", "nav", "navbar", "navigation",
         "breadcrumb", "breadcrumbs", "footer", "masthead", "comment", "comments", "disqus", "reply", "replies", "respond",
         "related", "recommended", "share", "sharing", "social", "toolbar", "login", "signup", "search", "widget", "widgets",
         "pager", "pagination", "copyright", "skip")
BOXES = ("area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form", "global", "group",
         "inner", "item", "items", "left", "link", "links", "list", "main", "module", "page", "panel", "primary", "right",
         "row", "secondary", "section", "site", "slot", "text", "thread", "title", "to", "top", "unit", "us", "wrap", "wrapper")
REPLIES = ("comment", "comments", "disqus", "reply", "replies", "respond")
SLUGGED = ("section", "h1", "h2", "h3", "h4", "h5", "h6")  # their id may be the slug of a heading
# What a start tag closes whose end tag may be left out, and what stops the search for it.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th")}
PASSED = ("address", "div", "p", "li", "dt", "dd", "option", "td", "th", "tr")
KEEPS_P = ("caption", "dd", "dt", "legend", "option", "summary", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "head", "html")
# -----------------------------------------------------------------------------
TRUSTED, LOOSE, CHROMED = 0, 1, 2

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S)
LABELS = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
PARTS = re.compile(r"[^a-z0-9]+")


def _names_chrome(token: str, more: tuple[str, ...]) -> bool:
    """Whether a class or id says chrome by all its parts (``ad-slot``, not
    ``has-sidebar`` or ``related-work``)."""
    words = [w for w in PARTS.split(token) if w]
    named = [w in NAMES or w in more for w in words]
    return any(named) and all(n or w in BOXES or any(c.isdigit() for c in w) for n, w in zip(named, words))


def _is_named(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether class or id call the element chrome."""
    if not attributes or tag in MAIN or tag in ("body", "html"):
        return False
    more = () if in_main else ("header",)
    for name, *values in LABELS.findall(attributes):
        tokens = "".join(values).lower().split()
        if name.lower() == "id" and tag in SLUGGED:
            tokens = [t for t in tokens if tag == "section" and PARTS.split(t)[0] in REPLIES]
        if name.lower() in ("class", "id") and any(_names_chrome(t, more) for t in tokens):
            return True
    return False


def _is_marked(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether tag, role or visibility make the element chrome."""
    if tag in CHROME or (tag == "header" and not in_main):
        return True
    for name, *values in LABELS.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower()
        if (name == "role" and value in ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _is_reply(attributes: str) -> bool:
    """Whether an article is a comment on another one."""
    return any(PARTS.split(t)[0] in REPLIES for name, *values in LABELS.findall(attributes) if name.lower() == "class"
               for t in "".join(values).lower().split())


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in order: in a marked article, loose, or
    in an element the markup tells to be no content.  A name does not make an
    element chrome that encloses an article."""
    around: set[int] = set()
    while True:
        out, found = _parse(page or "", around)
        if found <= around:
            return out
        around |= found


def _parse(page: str, around: set[int]) -> tuple[list[tuple[int, str]], set[int]]:
    """The blocks, and the places of the elements called chrome that enclose an
    article; those in ``around`` are none."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, chrome, main, article: with all around it
    opened: Counter[str] = Counter()  # tags in the stack
    named_at: list[tuple[int, int]] = []  # depth and place of elements called chrome, not yet found to enclose an article
    found: set[int] = set()
    chrome = main = article = False

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((CHROMED if chrome else TRUSTED if article else LOOSE, text))

    def close(i: int) -> None:
        nonlocal chrome, main, article
        opened.subtract(s[0] for s in stack[i:])
        del stack[i:]
        while named_at and named_at[-1][0] >= i:
            named_at.pop()
        chrome, main, article = stack[-1][1:] if stack else (False, False, False)

    def close_implied(tag: str) -> None:
        if tag not in KEEPS_P and opened["p"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] in BREAK:
                    break
        ends = ENDS.get(tag, ())
        if any(opened[e] for e in ends):
            last = None
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    last = i
                    if tag != "tr":
                        break
                elif stack[i][0] in BREAK and stack[i][0] not in PASSED:
                    break
            if last is not None:
                close(last)

    at = 0
    while True:
        m = MARKUP.search(page, at)
        parts.append(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        closing, tag, attributes = m[1], (m[2] or "").lower(), m[3] or ""
        if not tag:
            continue
        if tag in BREAK:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            for i in range(len(stack) - 1 if opened[tag] else -1, -1, -1):
                if stack[i][0] == tag:
                    if tag not in BREAK and stack[i][1] != (stack[i - 1][1] if i else False):
                        flush()
                    close(i)
                    break
            continue
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if stack and tag in BREAK:
            close_implied(tag)
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag == "body":  # a head that was not closed ends here
            close(0)
        named = _is_named(tag, attributes, main)
        if tag in MAIN and named_at and not _is_reply(attributes):
            found.update(place for _, place in named_at)
            named_at.clear()
        now_chrome = chrome or (named and at not in around) or _is_marked(tag, attributes, main)
        if now_chrome or tag in BREAK or tag == "span":
            if now_chrome != chrome and tag not in BREAK:
                flush()
            if named:
                named_at.append((len(stack), at))
            stack.append((tag, now_chrome, main or tag in MAIN, article or tag == "article"))
            opened[tag] += 1
            chrome, main, article = stack[-1][1:]
    flush()
    return out, found


def stream(found: list[tuple[int, str]], run: int) -> tuple[list[int], list[int], np.ndarray]:
    """Of the blocks outside the article: their numbers, their first tokens'
    places, and the hash of the ``run`` tokens from each place (0 where the
    block ends first)."""
    which, first, hashes, n = [], [], [], 0
    for i, (kind, text) in enumerate(found):
        if kind == TRUSTED:
            continue
        tokens = text.split(" ")
        which.append(i)
        first.append(n)
        n += len(tokens)
        hashes += [xxhash.xxh64_intdigest(" ".join(tokens[j:j + run])) | 1 if j + run <= len(tokens) else 0 for j in range(len(tokens))]
    return which, first, np.array(hashes, np.uint64).astype(np.int64)


def block_suffixes(found: list[tuple[int, str]]) -> list[bytes]:
    """The suffix at each block: codes of the block and of those that follow up
    to ``RUN`` more tokens.  A code is the text's hash, its last three bits the
    number of tokens, at most 7."""
    sizes = [text.count(" ") + 1 for _, text in found]
    codes = [(xxhash.xxh64_intdigest(text) & ~7 | min(n, 7)).to_bytes(CODE, "big") for (_, text), n in zip(found, sizes)]
    out = []
    for i in range(len(codes)):
        end, more = i + 1, 0
        while end < len(codes) and more < RUN:
            more += sizes[end]
            end += 1
        out.append(b"".join(codes[i:end]))
    return out


def unique_runs(found: list[tuple[int, str]], which: list[int], first: list[int], starts: list[int], run: int) -> list[tuple[int, str]]:
    """What is left of the loose blocks when the tokens under the repeated
    substrings that begin at ``starts`` are taken away."""
    n = first[-1] + len(found[which[-1]][1].split(" ")) if which else 0
    covered = np.zeros(n + 1, np.int64)
    for s in starts:
        covered[s] += 1
        covered[min(n, s + run)] -= 1
    gone = np.cumsum(covered) > 0
    out = []
    for i, f in zip(which, first):
        if found[i][0] == LOOSE:
            text = " ".join(t for j, t in enumerate(found[i][1].split(" "), f) if not gone[j])
            if text:
                out.append((i, text))
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


STREAM = "page long, host string, loose boolean, body long, hashes array<long>, suffixes array<binary>"


def _pages(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    ids = small_batches(pages).select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    return ids.withColumn("page", F.xxhash64("page_id", "url", "html"))


def _body(found: list[tuple[int, str]]) -> int:
    """A number for the page's text, equal for copies whose chrome differs."""
    text = "\n".join(t for k, t in found if k != CHROMED)
    return int(np.uint64(xxhash.xxh64_intdigest(text)).astype(np.int64))


def streams(pages: DataFrame, run: int = RUN) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h in batch.column("html"):
                found = blocks(h.as_py())
                rows.append((any(k == LOOSE for k, _ in found), _body(found), stream(found, run)[2], block_suffixes(found)))
            kinds = (pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("page"), batch.column("host"), *columns],
                                             names=["id", "page", "host", "loose", "body", "hashes", "suffixes"])

    ids = pages.select(F.col("page_id").alias("id"), "page", host_of(F.col("url")).alias("host"), "html")
    return ids.mapInArrow(scan, f"id {dict(ids.dtypes)['id']}, {STREAM}")


def repeats_in_order(rows: Iterator[tuple[str, bytes, int, int, int]], least: int = LEAST) -> Iterator[tuple]:
    """(host, prefix, bodies, heads, foots) of the repeats of ``RUN`` tokens or
    more in a sorted stretch of the array of (host, suffix, body, head, foot):
    up to ``least`` distinct bodies, and the occurrences by number of blocks
    before and after.  Those of fewer bodies are told only at the ends of the
    stretch, where they may go on.  Equal rows are copies and count once."""
    last_row, last_host, last = None, None, b""
    nodes: list[tuple[bool, set[int], Counter, Counter]] = []  # by depth: whether open since the first row, bodies, heads, foots

    def closed(depth: int, all_of_them: bool = False) -> Iterator[tuple]:
        while len(nodes) > depth:
            prefix = last[:len(nodes) * CODE]
            early, bodies, heads, foots = nodes.pop()
            if (len(bodies) >= least or early or all_of_them) and sum(c & 7 for c in prefix[CODE - 1::CODE]) >= RUN:
                yield last_host, prefix, sorted(bodies), dict(heads), dict(foots)

    for row in rows:
        if row == last_row:
            continue
        host, key, body, head, foot = row
        common = 0
        if host == last_host:
            while common < min(len(key), len(last)) and key[common:common + CODE] == last[common:common + CODE]:
                common += CODE
        yield from closed(common // CODE)
        nodes += [(last_row is None, set(), Counter(), Counter()) for _ in range(len(key) // CODE - len(nodes))]
        last_row, last_host, last = row, host, key
        for depth, (_, bodies, heads, foots) in enumerate(nodes, 1):
            if len(bodies) < least:
                bodies.add(body)
            heads[head] += 1
            foots[foot - depth] += 1
    yield from closed(0, True)


def repeated_blocks(found: DataFrame, least: int = LEAST) -> DataFrame:
    """(host, prefix): runs of whole blocks on ``least`` distinct bodies of a
    host, at a fixed place of the page."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        kinds = (pa.string(), pa.binary(), pa.list_(pa.int64()), pa.map_(pa.int32(), pa.int64()), pa.map_(pa.int32(), pa.int64()))
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [[r[i] for r in out] for i in range(3)] + [[list(r[i].items()) for r in out] for i in (3, 4)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "prefix", "bodies", "heads", "foots"])

        for node in repeats_in_order(rows, least):
            out.append(node)
            if len(out) == 1000:
                yield batch()
                out = []
        yield batch()

    suffixes = found.select("host", "body", F.size("suffixes").alias("n"), F.posexplode("suffixes").alias("head", "suffix"))
    suffixes = suffixes.select("host", "suffix", "body", "head", (F.col("n") - F.col("head")).alias("foot"))
    order = suffixes.repartitionByRange("host", "suffix", "body").sortWithinPartitions("host", "suffix", "body", "head", "foot")
    nodes = order.mapInArrow(scan, "host string, prefix binary, bodies array<long>, heads map<int,long>, foots map<int,long>")
    # A repeat cut by the ends of tasks comes from each with its part.
    nodes = materialize(nodes, "html-nodes")
    bodies = nodes.select("host", "prefix", F.explode("bodies").alias("body")).distinct().groupBy("host", "prefix").agg(F.count("*").alias("bodies"))
    places = nodes.select("host", "prefix", F.lit(True).alias("top"), F.explode("heads").alias("place", "n")).unionByName(
        nodes.select("host", "prefix", F.lit(False).alias("top"), F.explode("foots").alias("place", "n")))
    places = places.groupBy("host", "prefix", "top", "place").agg(F.sum("n").alias("n"))
    fixed = places.groupBy("host", "prefix").agg(F.max("n").alias("most"), F.sum(F.when(F.col("top"), F.col("n"))).alias("n"))
    fixed = fixed.where(F.col("most") >= F.col("n") * F.lit(FIXED)).select("host", "prefix")
    return bodies.where(F.col("bodies") >= least).select("host", "prefix").join(fixed, ["host", "prefix"])


def _covered_blocks(found: DataFrame, common: DataFrame) -> DataFrame:
    """(id, page, first, blocks) of the longest repeat at each block of the
    pages with loose blocks."""
    starts = found.where("loose").select("id", "page", "host", F.posexplode("suffixes").alias("first", "suffix"))
    depths = F.expr(f"sequence(1, CAST(length(suffix) DIV {CODE} AS INT))")
    ways = starts.select("id", "page", "host", "first", "suffix", F.explode(depths).alias("blocks"))
    ways = ways.select("id", "page", "host", "first", "blocks", F.expr(f"substring(suffix, 1, blocks * {CODE})").alias("prefix"))
    return ways.join(common, ["host", "prefix"]).groupBy("id", "page", "first").agg(F.max("blocks").alias("blocks"))


def repeated(found: DataFrame, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """(host, hash): substrings on ``least`` distinct bodies of a host, and on
    the ``share`` of all of them."""
    suffixes = found.select("host", "body", F.explode(F.array_distinct("hashes")).alias("hash")).where("hash <> 0")
    spans = suffixes.distinct().groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    if not share:
        return spans.select("host", "hash")
    hosts = found.select("host", "body").distinct().groupBy("host").agg(F.count("*").alias("bodies"))
    # Stored, so that Spark knows its size and joins accordingly.
    hosts = materialize(hosts.where(F.col("bodies") >= least), "html-hosts")
    return spans.join(hosts, "host").where(F.col("n") >= F.col("bodies") * F.lit(share)).select("host", "hash")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", run: int | None = None) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.  With ``run`` given,
    every substring of a block of so many tokens that two distinct bodies of a
    host share is boilerplate; otherwise the rules above tell it."""
    least, share = (LEAST, SHARE) if run is None else (2, 0.0)
    rows = _pages(pages, page_id, url, html)
    found = materialize(streams(rows, run or RUN), "html-streams")
    common = materialize(repeated(found, least, share), "html-repeated")
    loose = found.where("loose").select("id", "page", "host", F.posexplode("hashes").alias("at", "hash"))
    covered = loose.join(common, ["host", "hash"]).select("id", "page", "at", F.lit(0).alias("blocks"))
    if run is None:
        runs = materialize(repeated_blocks(found, least), "html-repeats")
        covered = covered.unionByName(_covered_blocks(found, runs).withColumnRenamed("first", "at"))
    # Rows that are one page count once; a place of tokens has no blocks.
    covered = covered.groupBy("id", "page").agg(F.collect_set(F.struct("at", "blocks")).alias("covered"))
    # Pages all of whose blocks the markup explains are not among them.
    covered = materialize(covered, "html-covered")
    run = run or RUN

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for h, c in zip(batch.column("html"), batch.column("covered")):
                page, spans = blocks(h.as_py()), c.as_py() or []
                which, first, _ = stream(page, run) if any(k == LOOSE for k, _ in page) else ([], [], None)
                kept = dict(unique_runs(page, which, first, [s["at"] for s in spans if not s["blocks"]], run))
                for s in spans:
                    for i in range(s["at"], s["at"] + s["blocks"]):
                        kept.pop(i, None)
                kept.update((i, t) for i, (k, t) in enumerate(page) if k == TRUSTED)
                texts.append("\n\n".join(kept[i] for i in sorted(kept)))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    kind = dict(rows.dtypes)
    # The id as well, as two of very many pages may share a hash.
    same = (rows["page"] == covered["page"]) & rows["page_id"].eqNullSafe(covered["id"])
    out = rows.join(covered, same, "left").select("page_id", "url", "html", "covered")
    out = out.mapInArrow(write, f"page_id {kind['page_id']}, url {kind['url']}, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))
