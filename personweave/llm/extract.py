"""Main text of web pages: markup roles, and a suffix array of each host for boilerplate that repeats across its pages.

A page becomes blocks of text, each with what its markup says: boilerplate (menus, footers, forms ...), article, or
nothing. What an article holds is main text unless markup names it otherwise. The blocks outside articles, one after the
other, are the page's token stream. The host's suffix array over these streams, cut at the depth of the least length that
counts, brings suffixes together that agree on their first tokens: suffixes from distinct pages mark a long repeated
substring, and overlapping marks add up to maximal ones. A block outside articles that repeated substrings cover from end
to end goes, wherever they begin; of other such blocks go the tokens of repeated substrings that lie within the block.
Unique runs stay.

The array is never built in one place: suffixes meet by their first tokens, with the host in the key. Every page takes part.
A suffix is looked up by a sample of its first tokens that equal suffixes share and neighbours have in common, about a third
of the rows; those whose sample repeats meet whole. A host with a third of all pages is spread like any other, and what
repeats there is one aggregated row per task. Texts of articles are never shuffled, nor are pages that markup decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from personweave.sources.scratch import scratch_table

# HTML element names by what they do to a page's text.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output "
                   "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video select textarea option datalist".split())
RAW = frozenset("script style textarea title iframe".split())
ASIDE = frozenset("nav header footer aside form button fieldset menu dialog".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                           "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
# Words of class and id values that name boilerplate, and those that name the article.
NAMED_ASIDE = frozenset("ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner nav "
                        "navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr "
                        "notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social "
                        "related recommended comment comments reply replies disqus pagination pager widget toolbar skip".split())
NAMED_ARTICLE = frozenset("article articlebody content entry post story maincontent".split())
# Words that say something about a wrapper's state, and nouns that may follow a name of boilerplate.
STATE = frozenset("with without no not has have is hide show".split())
PARTS = frozenset("area bar block box container form heading inner item items link links list section title top bottom left right "
                  "wrap wrapper".split())

_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)
# Tokens of the short runs that stand for a suffix.
SAMPLED = 4


def _names_aside(token: str) -> bool:
    """Whether a whole class or id names boilerplate: its words are such names, perhaps with parts, or its last word is."""
    words = _NAME.findall(token)
    if not words or STATE & set(words):
        return False
    return words[-1] in NAMED_ASIDE or (words[0] in NAMED_ASIDE and all(w in NAMED_ASIDE or w in PARTS for w in words))


class _Blocks(HTMLParser):
    """Blocks in page order as [text, aside, article]."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, bool, bool]] = []
        self.text: list[str] = []
        self.open: list[tuple[str, bool, bool, bool, bool]] = []  # tag, silent, aside, article, article by element

    def _state(self) -> tuple[bool, bool, bool]:
        return self.open[-1][1:4] if self.open else (False, False, False)

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        self.text.clear()
        if text:
            _, aside, article = self._state()
            self.blocks.append((text, aside, article))

    def _close(self, tags: set[str], within: frozenset[str]) -> None:
        """Close the innermost open element of `tags` and all in it, unless one of `within` is in between."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in tags:
                self.flush()
                del self.open[at:]
                return
            if self.open[at][0] in within:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.flush()
            if tag in ENDS_PARAGRAPH:
                self._close({"p"}, ENDS_PARAGRAPH - {"p"})
            if tag in OWN_KIND:
                self._close(OWN_KIND[tag], frozenset({"ul", "ol", "dl", "table", "select", "menu"}))
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        silent, aside, article = self._state()
        values = {k: (v or "").lower() for k, v in attrs}
        tokens = f"{values.get('class', '')} {values.get('id', '')}".split()
        names = {w for t in tokens for w in _NAME.findall(t)}
        named = any(_names_aside(t) for t in tokens)
        role = values.get("role", "")
        hidden = "hidden" in values or values.get("aria-hidden") == "true"
        # A header of an article holds its title.
        own = role in ROLES or (tag in ASIDE and not (tag == "header" and article)) or bool(
            named and tag not in ("body", "html", "article", "main") and not (article and names & {"header"}))
        # An article that opens in a wrapper outside any article ends the wrapper's say, unless it is named boilerplate itself.
        starts = tag in ("article", "main") or role in ("main", "article") or values.get("itemprop") == "articlebody"
        if starts and not (tag == "article" and named) and not any(x[4] for x in self.open):
            aside = False
        main = starts or (tag in ("div", "section") and not own and bool(names & NAMED_ARTICLE))
        self.open.append((tag, silent or tag in SILENT or hidden, aside or own, article or main, starts))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if any(x[0] not in INLINE for x in self.open[at:]):
                    self.flush()
                # An unclosed inline element ends with its block.
                del self.open[at:]
                return

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment without an end runs to the end of the page; what looks like one in raw text opens none."""
        if self.open and self.open[-1][0] in RAW:
            return i + 4
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 else end

    def handle_data(self, data: str) -> None:
        if not self._state()[0]:
            self.text.append(data)


def blocks(html: str) -> list[tuple[str, bool, bool]]:
    """(text, boilerplate by markup, inside an article) of each block; a page that breaks off ends there."""
    tag = html.rfind("<")
    if html.find(">", tag) < 0 <= tag and re.match(r"</?[A-Za-z!]", html[tag:tag + 3]):
        html = html[:tag]
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def host_of(url: str | None) -> str:
    """Host of a URL in lower case, without user and port; empty if there is none."""
    m = re.match(r"\s*(?:[A-Za-z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m.group(1).lower() if m else ""


def _grams(words: list[str], size: int) -> np.ndarray:
    """Hashes of the runs of `size` words, one for each place."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    known = {x: xxhash.xxh64_intdigest(x) for x in set(words)}
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = (out ^ w[i:i + n]) * _ODD
        out ^= out >> np.uint64(29)
    return out


def _samples(words: list[str], host: str, depth: int) -> np.ndarray:
    """For each suffix the least hash of the short runs in its first `depth` tokens, with the host in it. Equal suffixes
    have equal samples, and neighbours mostly share one."""
    size = min(SAMPLED, depth)
    grams = _grams(words, size)
    if len(words) < depth:
        return np.empty(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(grams, depth - size + 1).min(axis=1)
    return ((least ^ np.uint64(xxhash.xxh64_intdigest(host))) * _ODD).view(np.int64)


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """`page_id`, `url`, `host`, `content` (a hash of the page's text) and the blocks of each page: `texts`, `aside`,
    `article`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(html.as_py()) for html in batch["html"]]
            content = [xxhash.xxh64_intdigest("\n".join(b[0] for b in page)) - (1 << 63) for page in found]
            columns = [pa.array([host_of(url) for url in batch["url"].to_pylist()], pa.string()), pa.array(content, pa.int64())]
            columns += [pa.array([[b[i] for b in page] for page in found], pa.list_(kind))
                        for i, kind in enumerate((pa.string(), pa.bool_(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], *columns],
                                             ["page_id", "url", "host", "content", "texts", "aside", "article"])
    return (pages.select(pages[f"`{id_col}`"].cast("long").alias("page_id"), pages[f"`{url_col}`"].cast("string").alias("url"),
                         F.coalesce(pages[f"`{html_col}`"].cast("string"), F.lit("")).alias("html"))
            .mapInArrow(run, "page_id long, url string, host string, content long, texts array<string>, aside array<boolean>, "
                             "article array<boolean>"))


def _words(outside: list[str]) -> list[str]:
    return [w for text in outside for w in text.lower().split()]


def _sampled(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["row", "host", "outside"]).to_pylist()
            keys = [np.unique(_samples(_words(r["outside"]), r["host"], depth)) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([r["row"] for r in rows], np.int64), [len(k) for k in keys])),
                 pa.array(np.concatenate([np.empty(0, np.int64), *keys]))], ["row", "sample"])
    return run


def _suffixes(depth: int):
    """`row`, `host`, `content` and `suffix` of the suffixes whose samples repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words = _words(r["outside"])
                at = np.isin(_samples(words, r["host"], depth), np.array(r["samples"], np.int64))
                found = np.unique(_grams(words, depth)[at].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["row"]] * len(found), pa.int64()), pa.array([r["host"]] * len(found), pa.string()),
                     pa.array([r["content"]] * len(found), pa.int64()), pa.array(found)], ["row", "host", "content", "suffix"])
    return run


def repeated_suffixes(streams: DataFrame, depth: int, least_pages: int) -> DataFrame:
    """`row`, `repeated`: for each undecided page its suffixes that start in at least `least_pages` distinct pages of its host.

    `streams` has `row`, `host`, `content`, `undecided` and `outside`, the blocks outside articles. Samples are counted
    first; only suffixes whose samples repeat are compared whole."""
    streams = streams.where(F.size("outside") > 0)
    samples = streams.mapInArrow(_sampled(depth), "row long, sample long")
    # A page counts once for each sample, so a count before the shuffle is a count of pages.
    often = scratch_table(samples.groupBy("sample").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
                          .select("sample"), "page_samples")
    near = samples.join(often, "sample").groupBy("row").agg(F.collect_list("sample").alias("samples"))
    suffixes = scratch_table(streams.join(near, "row").select("row", "host", "content", "outside", "samples").mapInArrow(
        _suffixes(depth), "row long, host string, content long, suffix long"), "page_suffixes", "zstd")
    # Copies of one page count once.
    repeated = (suffixes.groupBy("host", "suffix", "content").agg(F.lit(1).alias("one"))
                .groupBy("host", "suffix").agg(F.count("*").alias("contents")).where(F.col("contents") >= least_pages)
                .select("host", "suffix"))
    asked = suffixes.join(streams.where("undecided").select("row"), "row", "left_semi")
    return asked.join(repeated, ["host", "suffix"]).groupBy("row").agg(F.collect_set("suffix").alias("repeated"))


def _covered(words: list[str], repeated: np.ndarray, depth: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words lie in repeated substrings of the stream, and in such that lie within one block."""
    marks = np.flatnonzero(np.isin(_grams(words, depth).view(np.int64), repeated))
    block = np.searchsorted(edges, np.arange(len(words)), side="right")

    def spread(marks: np.ndarray) -> np.ndarray:
        starts = np.zeros(len(words) + 1, np.int64)
        np.add.at(starts, marks, 1)
        np.add.at(starts, marks + depth, -1)
        return np.cumsum(starts)[:-1] > 0

    return spread(marks), spread(marks[block[marks] == block[marks + depth - 1]])


def _kept_text(depth: int, cover: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for row in batch.select(["texts", "aside", "article", "repeated"]).to_pylist():
                outside = [text.split() for text, inside in zip(row["texts"], row["article"]) if not inside]
                edges = np.cumsum([len(words) for words in outside])
                if row["repeated"]:
                    anywhere, within = _covered([w.lower() for words in outside for w in words], np.array(row["repeated"], np.int64), depth, edges)
                kept, at = [], 0
                for text, aside, article in zip(row["texts"], row["aside"], row["article"]):
                    if not article:
                        words = outside[at]
                        part = slice(edges[at] - len(words), edges[at])
                        at += 1
                        if aside or (row["repeated"] and anywhere[part].all()):
                            continue
                        if row["repeated"] and within[part].any():
                            own = within[part]
                            if cover is None:
                                text = " ".join(w for w, out in zip(words, own) if not out)
                            elif own.sum() >= cover * len(words):
                                continue
                    if not aside:
                        kept.append(text)
                texts.append("\n\n".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    return run


def main_text(pages: DataFrame, depth: int = 8, least_pages: int = 3, cover: float | None = None, id_col: str = "page_id",
              url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id`, `url`, `text`, `n_chars` of every row of `pages`: the blocks of the main text, joined by empty lines.

    A block goes if its markup makes it boilerplate. Blocks inside articles stay otherwise, headings included. A block
    outside articles also goes if substrings of `depth` tokens or more that `least_pages` distinct pages of the host share
    cover it whole; of other such blocks the tokens go that lie in shared substrings within the block. With a `cover`
    these blocks stay or go whole, by the share of such tokens.

    Null html counts as empty and gives an empty text, as does a page without main text. A url without a host counts with
    all such urls as one host. Rows of equal text count as one page; each row gets its result. An empty table gives an
    empty result; other columns are ignored. Whole pages, whatever their length.
    """
    found = scratch_table(parsed(pages, id_col, url_col, html_col).withColumn("row", F.monotonically_increasing_id()), "page_blocks", "zstd")
    whole = F.arrays_zip("texts", "aside", "article")
    found = found.withColumn("undecided", F.exists(whole, lambda b: ~b.aside & ~b.article))
    streams = found.select("row", "host", "content", "undecided",
                           F.transform(F.filter(whole, lambda b: ~b.article), lambda b: b.texts).alias("outside"))
    columns = ["page_id", "url", "texts", "aside", "article"]
    decided = found.where(~F.col("undecided")).select(*columns, F.lit(None).cast("array<long>").alias("repeated"))
    others = found.where("undecided").join(repeated_suffixes(streams, depth, least_pages), "row", "left").select(*columns, "repeated")
    schema = "page_id long, url string, text string, n_chars long"
    return decided.mapInArrow(_kept_text(depth, cover), schema).unionByName(others.mapInArrow(_kept_text(depth, cover), schema))
