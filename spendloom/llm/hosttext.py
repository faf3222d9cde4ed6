"""Main text of web pages: a suffix array over each host's pages, and page structure as evidence beside it.

A page becomes blocks of text by its block-level tags.  A block lies in chrome (menus, page headers, footers, asides,
forms, and elements whose class, id or role says advert, notice, comments and the like), in the declared article, or in
the open.  The token streams of a host's pages (words of all blocks, and an end mark for each block) are put after each
other, their suffixes are sorted to a depth of ``RUN`` tokens, and a run that stands on at least ``LEAST_PAGES`` and
``SHARE`` of the distinct pages covers its tokens.  Blocks that are covered for the most part are the host's boilerplate;
the others are kept, of a page with a declared article those in it.  In an article, what its markup calls prose
(paragraphs, headings, quotations, cells) is the author's, repeated or not; other blocks of it are judged like any.

Hosts are dealt out in shards of about ``SHARD_BYTES`` of html, so that a large host is many tasks.  Its runs are counted
over all its shards: a run on ``SHARE`` of the host's distinct pages is on that share of at least one shard's, so suffix
arrays give each shard's candidates, every shard counts the candidates of all, and the sums decide.  How large a host is
comes from a table of ``HOST_SLOTS`` counters; texts are shuffled once, without their markup, and read from there by each
of these steps.  Pages of the same blocks count as one page: its shard follows from its blocks, and further copies that a
task sees are dealt out to any shard and not counted.

Null and empty html give an empty text.  Pages without a host (no url) are one host.  Repeated rows are each answered.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import map_batches, pick

RUN = 8
LEAST_PAGES = 3
SHARE = 0.1
COVERED = 0.8
SHARD_BYTES = 4 << 20
HOST_SLOTS = 1 << 20
#: Pages that a task remembers, to tell further copies.
SEEN = 1 << 18
#: Rows that a host's runs are packed in.
RUN_PARTS = 64

#: How many elements around a block are looked at for prose.
PROSE_DEPTH = 16

CHROME, OPEN, MAIN = 0, 1, 2
PROSE = 4  # added to a zone in shuffled rows
FACTOR = np.uint64(0x9E3779B97F4A7C15)

#: Comment, tag with well-formed attributes, any other tag, tag cut off by the page's end.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<([/!?]?)([a-zA-Z][^\s/>]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>|<([/!?]?)([a-zA-Z!?][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![-\w])(hidden)(?![-\w])", re.I)
SKIPPED = {"script", "style", "title", "textarea", "template", "svg", "iframe", "object", "math", "select", "noscript"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr br".split()
)
#: Elements that end where the next of their kind starts.
CLOSED_BY_NEXT = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
STRONG_TAGS = {"nav", "aside", "footer", "form", "dialog", "menu", "button"}
MAIN_TAGS = {"article", "main"}
#: Elements whose text in a declared article is prose.
PROSE_TAGS = set("p h1 h2 h3 h4 h5 h6 blockquote pre td th dt dd caption figcaption math".split())
STRONG_WORDS = set("comment comments reply replies respond discussion disqus".split())
WEAK_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar widget footer header "
    "masthead share sharing social related recommended newsletter subscribe subscription signup login search pagination "
    "pager toolbar copyright contentinfo complementary alert".split()
)
WORD = re.compile(r"[a-z]+")


def _kind(tag: str, attributes: str, inside_main: bool) -> tuple[bool, bool, bool]:
    """Whether an element is chrome, whether an article within it stays chrome, whether it declares the article."""
    words: set[str] = set()
    hidden = False
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[5] or m[1] and m[1].lower() == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
            elif m[1] and m[1].lower() != "style":
                words.update(WORD.findall(value))
    if tag in ("html", "body"):
        return False, False, False
    strong = hidden or tag in STRONG_TAGS or bool(words & STRONG_WORDS)
    main = (tag in MAIN_TAGS or "main" in words and "role" in attributes.lower()) and not strong
    if main:
        return False, False, True
    weak = bool(words & WEAK_WORDS) or tag == "header"
    if inside_main and tag == "header":  # an article's own header holds its title
        weak = False
    return strong or weak, strong, False


def blocks(page: str | None) -> list[tuple[str, int]]:
    """Text and zone of each block, in page order."""
    return [(text, zone) for text, zone, _ in _blocks(page)]


def _blocks(page: str | None) -> list[tuple[str, int, bool]]:
    """Text, zone and whether markup calls it prose, of each block, in page order."""
    out: list[tuple[str, int, bool]] = []
    if not page:
        return out
    stack: list[tuple[str, int, bool]] = []  # tag, zone within it, whether an article within it is chrome
    zone, firm, held, at = OPEN, False, [], 0

    def close() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, zone, any(tag in PROSE_TAGS for tag, *_ in stack[-PROSE_DEPTH:])))

    for m in TAG.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        mark, tag = (m[1] if m[2] else m[4]) or "", tag.lower()
        if mark in ("!", "?") or tag[0] in "!?":
            continue
        if tag not in INLINE:
            close()
        elif tag == "br":
            held.append(" ")
        if mark == "/":
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None and (tag not in INLINE or len(stack) - depth < 32):
                if zone != (stack[depth - 1][1] if depth else OPEN):
                    close()
                del stack[depth:]
                zone, firm = (stack[-1][1], stack[-1][2]) if stack else (OPEN, False)
            continue
        if tag in SKIPPED:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or (m[3] or "").endswith("/"):
            continue
        if tag in CLOSED_BY_NEXT:
            for i in range(len(stack) - 1, max(-1, len(stack) - 32), -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] not in INLINE and stack[i][0] not in CLOSED_BY_NEXT:
                    break
            zone, firm = (stack[-1][1], stack[-1][2]) if stack else (OPEN, False)
        chrome, strong, main = _kind(tag, m[3] or m[6] or "", zone == MAIN)
        new = CHROME if chrome else MAIN if main and not firm else zone
        if new != zone:
            close()
        zone, firm = new, firm or strong
        stack.append((tag, zone, firm))
    if at < len(page):
        held.append(page[at:])
    close()
    return out


class Streams:
    """Token streams of distinct pages after each other: words of all blocks, an end mark for each block and each page."""

    def __init__(self, pages: list[list[str]]):
        unlike: dict[tuple[str, ...], int] = {}
        self.owner = [unlike.setdefault(tuple(p), len(unlike)) for p in pages]
        self.distinct = list(unlike)
        ids: dict[str, int] = {}
        stream, block, page = [], [], []
        number, sizes = 0, []
        for k, texts in enumerate(self.distinct):
            for text in texts:
                words = [ids.setdefault(w, len(ids) + 2) for w in text.split()]
                stream += [*words, 1]  # 1 ends a block
                block += [number] * len(words) + [-1]
                page += [k] * (len(words) + 1)
                sizes.append(len(words))
                number += 1
            stream.append(-1 - k)  # a page's end is like no other
            block.append(-1)
            page.append(k)
        self.words, self.sizes = ids, np.array(sizes, np.int64)
        self.tokens, self.block, self.page = (np.array(x, np.int64) for x in (stream, block, page))

    def ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each suffix by its first ``RUN`` tokens, and on how many pages suffixes of each rank stand."""
        n = len(self.tokens)
        # Ranks of the suffixes by their first 1, 2, 4, ... RUN tokens.
        _, rank = np.unique(self.tokens, return_inverse=True)
        depth = 1
        while depth < RUN:
            after = np.zeros(n, np.int64)
            after[:-depth] = rank[depth:] + 1
            _, rank = np.unique(rank * (n + 1) + after, return_inverse=True)
            depth *= 2
        order = np.lexsort((self.page, rank))  # the suffix array to that depth
        ranks, owners = rank[order], self.page[order]
        fresh = np.append(True, (ranks[1:] != ranks[:-1]) | (owners[1:] != owners[:-1]))
        return rank, np.bincount(ranks[fresh], minlength=int(rank.max()) + 1)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where runs within a page start, and their hashes, which are the same in every shard."""
        n = len(self.tokens) - RUN + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        table = np.zeros(len(self.words) + 2, np.uint64)
        table[1] = xxhash.xxh3_64_intdigest(b"\n")
        table[2:] = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in self.words), np.uint64, len(self.words))
        values = table[np.maximum(self.tokens, 0)]
        mixed = np.zeros(n, np.uint64)
        for k in range(RUN):
            mixed = mixed * FACTOR + values[k : k + n]
            mixed ^= mixed >> np.uint64(29)
        ends = np.cumsum(np.append(0, self.tokens < 0))
        starts = np.flatnonzero(ends[RUN : RUN + n] == ends[:n])
        return starts, mixed[starts].view(np.int64)

    def shares(self, starts: np.ndarray) -> list[list[float]]:
        """For each page's blocks, the share of tokens that lie in the runs that start there."""
        edge = np.zeros(len(self.tokens) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + RUN, -1)
        hit = np.cumsum(edge[:-1]) > 0
        number = len(self.sizes)
        total = np.bincount(self.block[(self.block >= 0) & hit], minlength=number) if number else np.zeros(0)
        share = iter((total / np.maximum(self.sizes, 1)).tolist() if number else [])
        shares = [[next(share) for _ in texts] for texts in self.distinct]
        return [shares[k] for k in self.owner]


def covered(pages: list[list[str]]) -> list[list[float]]:
    """For each page's blocks, the share of tokens that lie in runs repeated across distinct pages."""
    streams = Streams(pages)
    starts = np.zeros(0, np.int64)
    n, least = len(streams.tokens), max(LEAST_PAGES, int(np.ceil(SHARE * len(streams.distinct))))
    if n > RUN and len(streams.distinct) >= least:
        rank, on_pages = streams.ranks()
        starts = np.flatnonzero(on_pages[rank] >= least)
        starts = starts[starts + RUN <= n]
    return streams.shares(starts)


def _candidates(pages: list[list[str]]) -> np.ndarray:
    """Hashes of the runs on ``SHARE`` of the distinct pages of a shard."""
    streams = Streams(pages)
    starts, runs = streams.runs()
    if not len(starts):
        return runs
    rank, on_pages = streams.ranks()
    return np.unique(runs[on_pages[rank[starts]] >= SHARE * len(streams.distinct) * (1 - 1e-9)])


def _counts(pages: list[list[str]], wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """On how many distinct pages of a shard each run (sorted) stands, and how many distinct pages there are."""
    streams = Streams(pages)
    starts, runs = streams.runs()
    at, found = _among(runs, wanted)
    on = np.unique(at[found] * len(streams.distinct) + streams.page[starts[found]])
    return np.bincount(on // max(len(streams.distinct), 1), minlength=len(wanted)), len(streams.distinct)


def _among(runs: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each run in ``wanted`` (sorted), and whether it is there."""
    if not len(wanted):
        return np.zeros(len(runs), np.int64), np.zeros(len(runs), bool)
    at = np.minimum(np.searchsorted(wanted, runs), len(wanted) - 1)
    return at, wanted[at] == runs


def _marked(pages: list[list[str]], frequent: np.ndarray) -> list[list[float]]:
    """``covered`` by runs (sorted) that are known to be frequent."""
    streams = Streams(pages)
    starts, runs = streams.runs()
    return streams.shares(starts[_among(runs, frequent)[1]])


def _extracted(zoned: list[list[tuple[str, int, bool]]], shares: list[list[float]]) -> list[str]:
    """Texts of a shard's pages."""
    out = []
    for page, share in zip(zoned, shares, strict=True):
        inside = MAIN if any(z == MAIN for _, z, _ in page) else OPEN
        kept = [t for (t, z, prose), s in zip(page, share, strict=True) if z == inside and (s < COVERED or z == MAIN and prose)]
        out.append("\n".join(kept))
    return out


def _finished(shard: pa.Table, shares: list[list[float]]) -> pa.Table:
    zoned = [
        [(t, z % PROSE, z >= PROSE) for t, z in zip(texts, zones, strict=True)]
        for texts, zones in zip(shard.column("blocks").to_pylist(), shard.column("zones").to_pylist(), strict=True)
    ]
    texts = pa.array(_extracted(zoned, shares), pa.string())
    return pa.table({"page_id": shard.column("page_id"), "url": shard.column("url"), "text": texts})


def _packed_runs(shard: pa.Table) -> np.ndarray:
    """Sorted runs of the rows that ``_for_shards`` made."""
    runs = shard.column("runs").combine_chunks()
    return np.sort(runs.flatten().to_numpy(zero_copy_only=False)) if len(runs) else np.zeros(0, np.int64)


def _for_shards(runs: DataFrame) -> DataFrame:
    """``host, shard, runs``: the distinct runs (host, of, run) of a host for each of its shards."""
    packed = runs.groupBy("host", "of", F.pmod("run", F.lit(RUN_PARTS)).alias("part")).agg(F.collect_set("run").alias("runs"))
    return packed.select("host", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("of") - 1)).alias("shard"), "runs")


def _over_shards(parsed: DataFrame) -> DataFrame:
    """``page_id, url, text`` of the pages of hosts of several shards."""

    def counted(shard: pa.Table) -> list[list[str]]:
        return shard.filter(shard.column("counted")).column("blocks").to_pylist()

    def propose(shard: pa.Table) -> pa.Table:
        runs = pa.array([_candidates(counted(shard))], pa.list_(pa.int64()))
        return pa.table({"host": shard.column("host").slice(0, 1), "of": shard.column("of").slice(0, 1), "runs": runs})

    def count(shard: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["host", "of", "run", "n", "pages"]
        if not shard.num_rows or not asked.num_rows:
            none = [pa.array([], t) for t in (pa.string(), *[pa.int64()] * 4)]
            return pa.table(none, names)
        wanted = _packed_runs(asked)
        n, pages = _counts(counted(shard), wanted)
        host, of = (pa.repeat(shard.column(c)[0], len(wanted)) for c in names[:2])
        return pa.table([host, of, pa.array(wanted), pa.array(n.astype(np.int64)), pa.array(np.full(len(wanted), pages, np.int64))], names)

    def finish(shard: pa.Table, frequent: pa.Table) -> pa.Table:
        return _finished(shard, _marked(shard.column("blocks").to_pylist(), _packed_runs(frequent)))

    shards = parsed.groupBy("host", "shard")
    proposed = shards.applyInArrow(propose, "host string, of bigint, runs array<bigint>")
    asked = _for_shards(proposed.select("host", "of", F.explode("runs").alias("run")))
    counts = shards.cogroup(asked.groupBy("host", "shard")).applyInArrow(
        count, "host string, of bigint, run bigint, n bigint, pages bigint"
    )
    summed = counts.groupBy("host", "of", "run").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))
    frequent = summed.where(F.col("n") >= F.greatest(F.lit(LEAST_PAGES), F.ceil(F.lit(SHARE) * F.col("pages"))))
    return shards.cogroup(_for_shards(frequent).groupBy("host", "shard")).applyInArrow(
        finish, "page_id bigint, url string, text string"
    )


def extract(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``page_id, url, text`` of every page (columns page_id, url, html)."""
    host = F.regexp_extract(F.lower("url"), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    source = (
        pick(pages, "page_id", "url", "html")
        .withColumn("host", F.coalesce(host, F.lit("")))
        .withColumn("slot", F.pmod(F.xxhash64("host"), F.lit(HOST_SLOTS)).cast("int"))
    )
    sizes = np.zeros(HOST_SLOTS, np.int64)
    # At most one row for each slot.
    for slot, size in source.groupBy("slot").agg(F.sum(F.length("html").cast("bigint"))).collect():
        sizes[slot] = size or 0
    # What a slot has beyond twice the usual is a large host's.
    many = (1 + np.maximum(sizes - 2 * int(np.median(sizes)), 0) // shard_bytes).astype(np.int32)
    shards = pages.sparkSession.sparkContext.broadcast(many)
    deal = F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.lit(1 << 31))
    dealt = source.select("page_id", "url", "html", "host", "slot", deal.alias("deal"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            of = shards.value[batch.column(4).to_numpy()].astype(np.int64)
            zoned = [_blocks(h) for h in batch.column(2).to_pylist()]
            blocks = [[t for t, *_ in z] for z in zoned]
            shard, counted = batch.column(5).to_numpy() % of, np.ones(len(of), bool)
            for i in np.flatnonzero(of > 1).tolist():
                page = xxhash.xxh3_128_intdigest("\n".join([batch.column(3)[i].as_py(), *blocks[i]]).encode())
                counted[i] = page not in seen
                if counted[i]:
                    shard[i] = page % int(of[i])
                    if len(seen) < SEEN:
                        seen.add(page)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(3),
                    pa.array(shard),
                    pa.array(of),
                    pa.array(counted),
                    pa.array(blocks, pa.list_(pa.string())),
                    pa.array([bytes(z + PROSE * prose for _, z, prose in page) for page in zoned], pa.binary()),
                ],
                ["page_id", "url", "host", "shard", "of", "counted", "blocks", "zones"],
            )

    schema = "page_id bigint, url string, host string, shard bigint, of bigint, counted boolean, blocks array<string>, zones binary"

    def finish(shard: pa.Table) -> pa.Table:
        return _finished(shard, covered(shard.column("blocks").to_pylist()))

    def whole(df: DataFrame) -> DataFrame:
        parsed = map_batches(df, parse, schema)
        return parsed.groupBy("host", "shard").applyInArrow(finish, "page_id bigint, url string, text string")

    large = np.flatnonzero(many > 1).tolist()
    if not large:
        return whole(dealt)
    split = F.col("slot").isin(large)
    return whole(dealt.where(~split)).union(_over_shards(map_batches(dealt.where(split), parse, schema)))
