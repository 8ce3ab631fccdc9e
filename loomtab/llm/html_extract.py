"""Main text of web pages: page structure, checked against a suffix array of each host's token streams.

A page falls into blocks of text. Markup gives each a prior: in the article (ARTICLE), open (the page marks no article:
OPEN), furniture by tag, role or hiding (OUTSIDE), or furniture by a word of its class or id alone (WEAK). Token streams of
pages are joined into one; its suffixes are sorted to the depth of RUN tokens, and equal neighbours show the runs that
recur on distinct pages. Recurrence then decides:
- OPEN: a block goes when runs that stand on two different pages of the host cover most of it; its unique runs stay.
- ARTICLE: a block goes when it recurs on nearly all pages of a host with many different ones, and the rest of the article
  outweighs what goes. Quoted passages and paragraphs that many stories share stay.
- WEAK: goes, unless the page has no other text; then it is judged as OPEN.
- OUTSIDE: goes.
Pages are told apart by their content (the set of their blocks of a run or more), so copies of a page count as one, and a
copied article stays however many there are. A page that would lose all is a copy too and keeps its text.

A host of up to GROUP_PAGES pages is one group. A larger one is dealt out in pieces: suffix arrays of the pages at hand give
its runs, which are merged over the host by (host, bucket of keys); each piece gets the verdicts on its own. Every run is
exchanged where the host has pages that mark no article; else the runs that judge the blocks of articles (the first, the
last and the one of least key, of every block). Groups only bound memory: a page's text depends on its host's pages alone.
Runs are told apart by 64-bit keys within a host.

Null html is the empty page: empty text. Null url is a host of its own; equal rows each give a row; null page_ids stay; an
empty table gives an empty result; other columns are not looked at, whatever their names. A page is read whole, in time
linear in its length: a tag that never ends is closed by the next `>`, or is text where none follows.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RUN = 8
GROUP_PAGES = 256
GROUP_BYTES = 8 << 20
#: A block of an article goes when it is on this share of the pages of a host, and on so many different ones at least.
NEARLY_ALL, WELL_FILLED = 0.9, 50
#: An open block goes when recurring runs cover this share of its tokens.
MOSTLY = 0.9

# Element names of HTML by role, and words of class, id and role attributes that mark furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript svg math iframe object canvas audio video select textarea title head".split())
FURNITURE = frozenset("nav header footer aside form button dialog menu fieldset".split()) | RAW
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - frozenset("body html head title".split())
ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form header masthead menu modal nav navbar navigation newsletter notice notices notification popup popups promo related share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)

#: Where a tag may begin, and what follows its name up to its end. Possessive: no step back, so linear.
_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*+))")
_REST = re.compile(r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+>")
_ATTRIBUTE = re.compile(r"(?<![\w:-])(?:([\w:-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))|(hidden)(?![\w:-]))", re.S)
_SPLIT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")
_NO_DISPLAY = re.compile(r"display\s*+:\s*+none", re.I)
_MAIN_ROLE = re.compile(r"role\s*+=\s*+[\"']?(?:main|article)\b", re.I)
#: What marks an article somewhere on a page; the same pattern for Java and Python.
MARKED = r"(?i)<(?:article|main)[ \t\n\r\f/>]|role[ \t\n\r\f]*=[ \t\n\r\f]*[\"']?(?:main|article)"
_MARKED = re.compile(MARKED, re.A)

ARTICLE, OPEN, OUTSIDE, WEAK = 0, 1, 2, 3
#: How an element weighs on what is in it.
NOT, BY_NAME, BY_TAG = 0, 1, 2


def _furniture(tag: str, attributes: str) -> int:
    if tag in FURNITURE:
        return BY_TAG
    if not attributes or attributes.isspace():
        return NOT
    found = NOT
    for name, a, b, c, hidden in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if hidden or name == "aria-hidden" and value.lower() == "true" or name == "style" and _NO_DISPLAY.search(value):
            return BY_TAG
        if name == "role" and value.lower() in ROLES:
            return BY_TAG
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") and not WORDS.isdisjoint(w.lower() for w in _SPLIT.split(value)):
            found = BY_NAME
    return found


def _units(page: str) -> Iterator[tuple[str, str, str]]:
    """(text before, tag, attributes) of the page's tags in order, a closing tag with / before its name; the last has no
    tag. Comments and declarations are left out. Time is linear: a tag whose quotes swallow the page ends at the next `>`, and
    so do all after it."""
    at = since = 0
    last, strict = page.rfind(">"), True
    while m := _OPEN.search(page, at):
        start = m.start()
        if m[2] is None:
            end = page.find("-->", m.end()) + 3 if m[0] == "<!--" else page.find(">", m.end()) + 1
            if end < 3 and m[0] == "<!--":
                end = len(page)
            elif not end:
                break
            yield page[since:start], "", ""
        else:
            if start > last:
                break
            rest = _REST.match(page, m.end()) if strict else None
            strict = rest is not None
            end = rest.end() if rest else page.find(">", m.end()) + 1
            if not end:
                break
            yield page[since:start], m[1] + m[2].lower(), page[m.end() : end - 1]
        at = since = end
        if not m[1] and m[2] and (tag := m[2].lower()) in _RAW_TEXT:  # up to its own end
            found = _CLOSING[tag].search(page, at)
            at = since = len(page) if not found else (page.find(">", found.start()) + 1 or len(page))
    yield page[since:], "", ""


_RAW_TEXT = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
_CLOSING = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in _RAW_TEXT}


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order; text has its references decoded and its white space made single."""
    out: list[tuple[int, bool, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # open elements: name, furniture, in an article
    places: dict[str, list[int]] = defaultdict(list)  # places in the stack by name, and those of all blocks
    drop, inside, article = NOT, False, False

    def flush() -> None:
        if parts:
            if text := " ".join(entities.unescape("".join(parts)).split()):
                out.append((drop, inside, text))
            parts.clear()

    def cut(depth: int) -> None:
        nonlocal drop, inside
        while len(stack) > depth:
            name = stack.pop()[0]
            places[name].pop()
            if name in BLOCK:
                places[""].pop()
        drop, inside = (stack[-1][1], stack[-1][2]) if stack else (NOT, False)

    for before, tag, attributes in _units(page):
        if before:
            parts.append(before)
        if not tag:
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if tag in BLOCK:
                flush()
            elif tag == "br":
                parts.append(" ")
            if places[tag]:
                cut(places[tag][-1])
            continue
        if tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            flush()
        if tag in VOID or tag in _RAW_TEXT:
            continue
        if tag in BLOCK:
            if tag in CLOSES_P and places["p"] and places["p"][-1] == places[""][-1]:
                cut(places["p"][-1])
            if (scope := ITEMS.get(tag)) and places[tag] and places[tag][-1] > max((places[x][-1] for x in scope if places[x]), default=-1):
                cut(places[tag][-1])
        if attributes.rstrip().endswith("/"):
            continue
        gone = drop if drop == BY_TAG else max(drop, _furniture(tag, attributes))
        within = inside or tag in ("article", "main") or bool(attributes) and bool(_MAIN_ROLE.search(attributes))
        article = article or within and not gone
        places[tag].append(len(stack))
        if tag in BLOCK:
            places[""].append(len(stack))
        stack.append((tag, gone, within))
        drop, inside = gone, within
    flush()
    # A page that marks an article without text of its own counts as one article.
    plain = ARTICLE if article or _MARKED.search(page) else OPEN
    return [(OUTSIDE if gone == BY_TAG or article and not within else WEAK if gone else plain, text) for gone, within, text in out]


def _suffixes(tokens: np.ndarray, ends: np.ndarray, page: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of a stream to the depth of a run: starts of the runs that fit their block, by run, then page; and
    where in it a new run and a new (run, page) begin.

    tokens: codes of one stream; ends: end of the token's block; page: the token's page. The stream's suffixes are
    ranked by 1, 2, 4, ... tokens (prefix doubling) and sorted; equal ranks are neighbours in the suffix array.
    """
    n = len(tokens)
    rank, depth = tokens.astype(np.int64), 1
    at = np.arange(n)
    at = at[at + run <= ends] if run == 1 else at
    while depth < run:
        step = min(depth, run - depth)
        at = at[at + depth + step <= ends[at]]
        key = rank[at] * (int(rank.max(initial=0)) + 1) + rank[at + step]
        fresh = np.zeros(n, np.int64)
        fresh[at] = np.unique(key, return_inverse=True)[1]
        rank, depth = fresh, depth + step
    order = at[np.lexsort((page[at], rank[at]))]
    new_rank = np.diff(rank[order], prepend=-1) != 0
    return order, new_rank, new_rank | (np.diff(page[order], prepend=-1) != 0)


def _covered(n: int, ends: np.ndarray, order: np.ndarray, times: np.ndarray, run: int = RUN) -> np.ndarray:
    """For every token, the most of the times of runs that cover it; 0 if no run fits."""
    out, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    best[order] = times
    for shift in range(min(run, n)):  # a token is covered by the runs that start up to run - 1 tokens before it
        out[shift:] = np.maximum(out[shift:], np.where(np.arange(n - shift) + run <= ends[: n - shift], best[: n - shift], 0))
    return out


def recurring(tokens: np.ndarray, ends: np.ndarray, page: np.ndarray, run: int = RUN) -> np.ndarray:
    """For every token, on how many distinct pages a run of `run` tokens that covers it occurs; 0 if no such run fits."""
    order, new_rank, new_page = _suffixes(tokens, ends, page, run)
    group = np.cumsum(new_rank) - 1
    return _covered(len(tokens), ends, order, np.bincount(group, new_page).astype(np.int64)[group], run)


def _hashes(values: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in values.to_pylist()], np.uint64)


def _run_keys(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit keys of the runs at starts, equal wherever the run occurs. words: hashes of the stream's tokens."""
    out = np.zeros(len(starts), np.uint64)
    for j in range(RUN):
        out = (out + words[starts + j]) * np.uint64(0x9E3779B97F4A7C15)
    return common.mix64(out).view(np.int64)


def _whole_keys(texts: pa.Array) -> np.ndarray:
    return common.mix64(_hashes(texts) ^ np.uint64(0xA0761D6478BD642F)).view(np.int64)


class Pages:
    """Pages' blocks as one stream of tokens, with its suffix array to the depth of a run.

    Runs and, for blocks shorter than a run, whole blocks are the units that may recur; each has a 64-bit key.
    """

    def __init__(self, pages: list[list[tuple[int, str]]]):
        self.pages = pages
        self.flat = pa.array([t for p in pages for _, t in p], pa.string())
        self.kind = np.array([k for p in pages for k, _ in p], np.int64)
        words, self.counts = common.space_words(self.flat, lower=False)
        self.owner = np.repeat(np.arange(len(pages)), [len(p) for p in pages])  # page of a block
        self.block = np.repeat(np.arange(len(self.counts)), self.counts)  # block of a token
        self.ends = np.cumsum(self.counts)
        coded = words.dictionary_encode()
        self.tokens = coded.indices.to_numpy().astype(np.int64)
        self.hashes = _hashes(coded.dictionary)
        self.whole = _whole_keys(self.flat)
        self.content = self._contents()

    def _contents(self) -> np.ndarray:
        """An id of every page's content: its set of blocks of a run or more that are not furniture; of all blocks if none."""
        out = np.zeros(len(self.pages), np.uint64)
        long = (self.counts >= RUN) & ((self.kind == ARTICLE) | (self.kind == OPEN))
        use = long | ~np.isin(self.owner, self.owner[long])
        pairs = np.unique(np.stack([self.owner[use], self.whole[use]]), axis=1)
        np.add.at(out, pairs[0], common.mix64(pairs[1].astype(np.uint64)))
        return common.mix64(out).view(np.int64)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of runs in the order of the suffix array, by content among equal ones; where a new run begins; keys."""
        content = np.unique(self.content, return_inverse=True)[1]
        order, new, _ = _suffixes(self.tokens, self.ends[self.block], content[self.owner[self.block]])
        keys = _run_keys(self.hashes[self.tokens], order[new])
        return order, new, keys

    def probes(self, order: np.ndarray, new: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, key): the units that judge a block of an article: its first, last and least run; a short one whole. They
        are counted wherever they are a block's first, last or least run, in an article or not."""
        long = np.flatnonzero(self.counts >= RUN)
        by_place = np.zeros(len(self.tokens), np.int64)
        by_place[order] = keys[np.cumsum(new) - 1]
        least = np.full(len(self.counts), np.iinfo(np.int64).max)
        np.minimum.at(least, self.block[order], by_place[order])
        short = np.flatnonzero((self.counts > 0) & (self.counts < RUN))
        found = [by_place[(self.ends - self.counts)[long]], by_place[self.ends[long] - RUN], least[long], self.whole[short]]
        return np.concatenate([long, long, long, short]), np.concatenate(found)


def _spread(keys: np.ndarray, content: np.ndarray, n: np.ndarray, extra: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Sums of n over equal (extra, key, content), of which each (extra, key) keeps the WELL_FILLED least contents; what the
    others have goes to the first of them."""
    extra = np.zeros(len(keys), np.int64) if extra is None else extra
    order = np.lexsort((content, keys, extra))
    keys, content, n, extra = keys[order], content[order], n[order], extra[order]
    of_key = np.ones(len(keys), bool)
    of_key[1:] = (keys[1:] != keys[:-1]) | (extra[1:] != extra[:-1])
    of_pair = of_key.copy()
    of_pair[1:] |= content[1:] != content[:-1]
    total = np.add.reduceat(n, np.flatnonzero(of_pair)) if len(n) else n
    keys, content, extra, first = keys[of_pair], content[of_pair], extra[of_pair], of_key[of_pair]
    start = np.flatnonzero(first)[np.cumsum(first) - 1] if len(first) else np.zeros(0, np.int64)
    kept = np.arange(len(keys)) - start < WELL_FILLED
    np.add.at(total, start[~kept], total[~kept])
    return extra[kept], keys[kept], content[kept], total[kept]


def nearly_everywhere(keys: np.ndarray, content: np.ndarray, n: np.ndarray, n_host: int) -> np.ndarray:
    """Keys, in order, that are on nearly all pages of a host and in enough contents. One row for each key, content and n."""
    _, keys, _, n = _spread(keys, content, n)
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0) if len(keys) else np.zeros(0, np.int64)
    total, contents = np.add.reduceat(n, first) if len(first) else n, np.diff(np.append(first, len(keys)))
    return keys[first][(total >= NEARLY_ALL * n_host) & (contents >= WELL_FILLED)]


def _of_pages(block: np.ndarray, key: np.ndarray, of: Pages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(page, key, content) of probes, each once a page."""
    pairs = np.unique(np.stack([of.owner[block], key]), axis=1)
    return pairs[0], pairs[1], of.content[pairs[0]]


def _in(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


class Verdicts(NamedTuple):
    """What recurs on a host: keys of units on two contents or more, and of probes that are nearly everywhere; ascending."""

    shared: np.ndarray
    everywhere: np.ndarray


def judge_host(of: Pages, runs: tuple) -> Verdicts:
    """Verdicts on a host whose pages are all at hand."""
    order, new, keys = runs
    content = of.content[of.owner[of.block[order]]]
    first, last = content[new], content[np.append(np.flatnonzero(new)[1:], len(content)) - 1] if len(content) else content
    shared = [keys[first != last]]  # contents of a run are in order
    short = np.flatnonzero((of.counts > 0) & (of.counts < RUN))
    pairs = np.unique(np.stack([of.whole[short], of.content[of.owner[short]]]), axis=1)[0]
    shared.append(pairs[1:][pairs[1:] == pairs[:-1]])
    everywhere = np.zeros(0, np.int64)
    if len(of.pages) >= WELL_FILLED:
        page, key, content = _of_pages(*of.probes(*runs), of)
        everywhere = nearly_everywhere(key, content, np.ones(len(key), np.int64), len(of.pages))
    return Verdicts(np.unique(np.concatenate(shared)), everywhere)


def main_texts(pages: list[list[tuple[int, str]]], known: Verdicts | None = None) -> list[str]:
    """Main text of each of the pages. They are all of their host, or known has the host's verdicts."""
    return [text for text, _, _ in _extracted(pages, known)]


def _extracted(pages: list[list[tuple[int, str]]], known: Verdicts | None = None) -> list[tuple[str, int, int]]:
    """Main text of each page, and the numbers of blocks that markup and recurrence took."""
    of = Pages(pages)
    judged = len(pages) > 1 or known is not None
    runs = of.runs() if judged else (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
    if known is None:
        known = judge_host(of, runs) if judged else Verdicts(runs[2], runs[2])
    order, new, keys = runs
    shared = np.zeros(len(of.tokens), bool)
    if len(order):
        shared = _covered(len(of.tokens), of.ends[of.block], order, _in(keys, known.shared)[np.cumsum(new) - 1].astype(np.int64)) > 0
    short = of.counts < RUN
    shared = np.where(short[of.block], _in(of.whole, known.shared)[of.block], shared)
    covered = np.bincount(of.block, shared, len(of.counts))
    # A block of an article goes if none of its probes is missing among those that are nearly everywhere.
    goes = np.zeros(len(of.counts), bool)
    if len(known.everywhere):
        block, key = of.probes(*runs)
        goes[block] = True
        goes[block[~_in(key, known.everywhere)]] = False
    out, nth = [], 0
    for page in pages:
        a, nth = nth, nth + len(page)
        kinds = of.kind[a:nth]
        if not ((kinds == ARTICLE) | (kinds == OPEN)).any():  # nothing but what a name marks: names may mislead
            kinds = np.where(kinds == WEAK, OPEN, kinds)
        rest = (kinds == ARTICLE) & ~goes[a:nth]
        copied = 2 * of.counts[a:nth][rest].sum() < of.counts[a:nth][kinds == ARTICLE].sum()
        kept, whole, taken = [], [], 0
        for i, (_, text) in enumerate(page, a):
            kind = kinds[i - a]
            if kind == ARTICLE:
                if copied or not goes[i]:
                    kept.append(text)
                else:
                    taken += 1
            elif kind == OPEN:
                whole.append(text)
                if covered[i] < MOSTLY * of.counts[i] or not of.counts[i]:
                    kept.append(text)
                else:
                    taken += 1
                    kept += _unique_runs(text.split(" "), shared[of.ends[i] - of.counts[i] : of.ends[i]])
        # A page that recurs as a whole is a copy, not furniture.
        out.append(("\n".join(kept or whole), int(((kinds == OUTSIDE) | (kinds == WEAK)).sum()), taken))
    return out


def _unique_runs(words: list[str], shared: np.ndarray) -> list[str]:
    """Stretches of a run or more that nothing recurring covers."""
    cuts = np.flatnonzero(np.diff(np.concatenate([[1], shared.astype(np.int8), [1]])))
    return [" ".join(words[a:b]) for a, b in zip(cuts[::2], cuts[1::2]) if b - a >= RUN]


_PAGE = "page_id long, url string, host string, piece long, kinds array<tinyint>, blocks array<string>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in common.chunks(batch, "html"):
            got = [blocks(x) for x in common.texts(piece.column("html")).to_pylist()]
            kinds = pa.array([[k for k, _ in p] for p in got], pa.list_(pa.int8()))
            text = pa.array([[t for _, t in p] for p in got], pa.list_(pa.string()))
            names = ["page_id", "url", "host", "piece"]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), kinds, text], [*names, "kinds", "blocks"])


_SHARE = "host string, piece long, bucket long, n_host long, run array<long>, low array<long>, high array<long>, probe array<long>, content array<long>, n array<int>"


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values))


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pages at hand have to say of their large hosts, by host, piece and bucket of keys: runs with the least and
    the greatest content they are in (of hosts with an open page), and probes with contents and pages."""
    for batch in batches:
        for chunk in common.chunks(batch, "html", GROUP_BYTES):
            where = list(zip(*(chunk.column(c).to_pylist() for c in ("host", "piece", "pieces", "n_host", "any_open")), strict=True))
            html = common.texts(chunk.column("html"))
            turn = sorted(range(len(where)), key=where.__getitem__)
            parts = sorted(set(where))
            number = {w: i for i, w in enumerate(parts)}
            of = Pages([blocks(html[i].as_py()) for i in turn])
            part = np.array([number[where[i]] for i in turn], np.int64)  # of a page
            runs = of.runs()
            page, probe, content = _of_pages(*of.probes(*runs), of)
            at, probe, content, n = _spread(probe, content, np.ones(len(probe), np.int64), part[page])
            # Runs of hosts with open pages: each (part, run) once.
            order, new, keys = runs
            place_part = part[of.owner[of.block[order]]]
            wide = np.array([w[4] for w in parts], bool)
            use = wide[place_part]
            short = np.flatnonzero((of.counts > 0) & (of.counts < RUN) & wide[part[of.owner]])
            key = np.concatenate([keys[np.cumsum(new) - 1][use], of.whole[short]]) if len(order) else of.whole[short]
            in_part = np.concatenate([place_part[use], part[of.owner[short]]])
            text = np.concatenate([of.content[of.owner[of.block[order[use]]]], of.content[of.owner[short]]])
            turn = np.lexsort((text, key, in_part))
            key, in_part, text = key[turn], in_part[turn], text[turn]
            first = np.flatnonzero((np.diff(key, prepend=~key[:1]) != 0) | (np.diff(in_part, prepend=-1) != 0))
            last = np.append(first[1:], len(key)) - 1 if len(first) else first
            run, run_part, low, high = key[first], in_part[first], text[first], text[last]
            # Buckets: as many as pieces where all runs are exchanged, else an eighth.
            buckets = np.array([w[2] if w[4] else -(-w[2] // 8) for w in parts], np.uint64)
            both = np.concatenate([run_part, at]), np.concatenate([run, probe]).view(np.uint64)
            bucket = (both[1] % buckets[both[0]]).astype(np.int64) if len(both[0]) else np.zeros(0, np.int64)
            cells, cell = np.unique(np.stack([both[0], bucket]), axis=1, return_inverse=True)
            cell = cell.reshape(-1)
            by_run, by_probe = np.argsort(cell[: len(run)], kind="stable"), np.argsort(cell[len(run) :], kind="stable")
            run_ends, probe_ends = (np.concatenate([[0], np.cumsum(np.bincount(c, minlength=cells.shape[1]))]) for c in (cell[: len(run)], cell[len(run) :]))
            hosts = pa.array([w[0] for w in parts], pa.string()).take(pa.array(cells[0]))
            pieces, n_host = (pa.array(np.array([w[j] for w in parts], np.int64)[cells[0]]) for j in (1, 3))
            values = [_lists(x[by_run], run_ends) for x in (run, low, high)] + [_lists(x[by_probe], probe_ends) for x in (probe, content, n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([hosts, pieces, pa.array(cells[1]), n_host, *values], ["host", "piece", "bucket", "n_host", "run", "low", "high", "probe", "content", "n"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Verdicts on the keys of each (host, bucket), to each piece that has the key."""
    own, rows = None, []

    def joined(j: int) -> np.ndarray:
        return np.concatenate([r[j] for r in rows])

    def done() -> pa.RecordBatch:
        run, low, high, probe, content, n = (joined(j) for j in range(2, 8))
        kinds, code = np.unique(run, return_inverse=True)
        least, most = np.full(len(kinds), np.iinfo(np.int64).max), np.full(len(kinds), np.iinfo(np.int64).min)
        np.minimum.at(least, code, low)
        np.maximum.at(most, code, high)
        everywhere = nearly_everywhere(probe, content, n.astype(np.int64), rows[0][1])
        pieces, out = np.unique(np.array([r[0] for r in rows], np.int64)), []
        for keys, hit, j in ((run, (least < most)[code], 2), (probe, _in(probe, everywhere), 5)):
            piece = np.repeat(np.array([r[0] for r in rows], np.int64), [len(r[j]) for r in rows])
            pairs = np.unique(np.stack([piece[hit], keys[hit]]), axis=1)
            ends = np.concatenate([[0], np.cumsum(np.bincount(np.searchsorted(pieces, pairs[0]), minlength=len(pieces)))])
            out.append(_lists(pairs[1], ends))
        return pa.RecordBatch.from_arrays([pa.array([own[0]] * len(pieces), pa.string()), pa.array(pieces), *out], ["host", "piece", "shared", "everywhere"])

    for batch in batches:
        columns = [batch.column(c) for c in ("run", "low", "high", "probe", "content", "n")]
        for i, (host, piece, bucket, n_host) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "piece", "bucket", "n_host")), strict=True)):
            if own != (host, bucket):
                if rows:
                    yield done()
                own, rows = (host, bucket), []
            rows.append((piece, n_host, *(c[i].values.to_numpy() for c in columns)))
    if rows:
        yield done()


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Main texts, host by host and piece by piece; rows with verdicts come before the pages of their piece."""
    ids, urls, held, size = [], [], [], 0
    own, given, known = None, [], None

    def done() -> pa.RecordBatch:
        text, marked, recurring = zip(*_extracted(held, known), strict=True)
        values = [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(text, pa.string()), *(pa.array(x, pa.int64()) for x in (list(map(len, text)), list(map(len, held)), marked, recurring))]
        return pa.RecordBatch.from_arrays(values, ["page_id", "url", "text", "n_chars", "n_blocks", "n_by_markup", "n_by_recurrence"])

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "host", "piece", "is_page", "kinds", "blocks")), strict=True)
        for i, (page_id, url, host, piece, is_page, kinds, text) in enumerate(rows):
            # A host without pieces is whole here; groups of one with pieces are cut anywhere, as all verdicts are the host's.
            if held and (own != (host, piece) or piece is not None and (len(held) >= GROUP_PAGES or size >= GROUP_BYTES)):
                yield done()
                ids, urls, held, size = [], [], [], 0
            if own != (host, piece):
                own, given, known = (host, piece), [], None
            if not is_page:
                given.append(tuple(batch.column(c)[i].values.to_numpy() for c in ("shared", "everywhere")))
                continue
            if known is None and piece is not None:
                known, given = Verdicts(*(np.unique(np.concatenate([np.zeros(0, np.int64), *(g[j] for g in given)])) for j in (0, 1))), []
            ids.append(page_id)
            urls.append(url)
            held.append(list(zip(kinds, text, strict=True)))
            size += sum(map(len, text))
    if held:
        yield done()


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars; and how many blocks it has, markup took, recurrence took."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))
    # A host of more than one group is dealt out in pieces. Blocks are never longer than their html.
    is_open = ~F.coalesce(F.col("html").rlike(MARKED), F.lit(False))
    by_host = rows.groupBy("host").agg(F.count("*").alias("n_host"), F.sum(F.octet_length("html")).alias("bytes"), F.max(is_open).alias("any_open"))
    large = by_host.withColumn("pieces", F.ceil(F.greatest(F.col("n_host") / GROUP_PAGES, F.coalesce("bytes", F.lit(0)) / GROUP_BYTES))).filter("pieces > 1")
    large = common.table(large.select("host", "n_host", "pieces", "any_open"), "large_hosts")
    n_large = large.count()
    piece = F.pmod(F.xxhash64("page_id", "url", "html"), "pieces")
    marked = rows.join(F.broadcast(large) if n_large < 10_000 else large, "host", "left").withColumn("piece", piece)
    near = marked.select("page_id", "url", "host", "piece", "html").transform(common.map_batches, _parse, _PAGE)
    none = F.lit(None).cast("array<bigint>")
    near = near.withColumns({"is_page": F.lit(True), "shared": none, "everywhere": none})
    if n_large:
        shares = marked.filter("pieces IS NOT NULL").select("host", "piece", "pieces", "n_host", "any_open", "html").transform(common.map_batches, _propose, _SHARE)
        shares = shares.repartition("host", "bucket").sortWithinPartitions("host", "bucket")
        verdicts = shares.transform(common.map_batches, _merge, "host string, piece long, shared array<long>, everywhere array<long>")
        near = near.unionByName(verdicts.withColumn("is_page", F.lit(False)), allowMissingColumns=True)
    near = near.repartition("host", "piece").sortWithinPartitions("host", "piece", "is_page", "page_id", "url")
    return near.transform(common.map_batches, _choose, "page_id long, url string, text string, n_chars long, n_blocks long, n_by_markup long, n_by_recurrence long")
