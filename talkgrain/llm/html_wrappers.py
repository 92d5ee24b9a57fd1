"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of each host.

A page is a stream of texts with the elements around them. Repeats beside each other in a stream become repeated groups. The streams of
a host are aligned one after another: what only some of them have becomes an optional group, what one has once and another many
times a repeated one; a text that is the same wherever pages have it is a constant of the template, one that differs makes a slot.
Each page is then parsed with its host's wrapper, which tells of each piece whether it is template text and whether its slot is
navigation. Which of the rest is the article is judged by tags, classes and link shares.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import stored, whole

# Fixed values of HTML.
RAW = "script|style|noscript|template|textarea|iframe|title|select|object|svg|canvas|audio|video|math"
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data dfn del em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav footer aside form button menu dialog head".split())
MAIN = frozenset("article main".split())
# Words of classes, ids and roles that name what is no part of an article.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login search share sharing social sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer "
    "masthead toolbar comment comments reply replies respond disqus related recommended recommendations complementary contentinfo".split())
HEADER_WORDS = frozenset("header heading topbar".split())

MARKUP = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>"']|"[^"]*"|'[^']*'|["'])*+>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*+>"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*+)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.DOTALL | re.IGNORECASE)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
DIGITS = re.compile(r"\d+")


@dataclass(frozen=True)
class Settings:
    """repeat: longest group of tokens looked for as a repeat. salts: parts in which a host's streams are aligned before the parts
    are aligned with each other. held: streams that a task holds before it passes them on. links: share of a slot's text in links above which it is
    navigation. little: share of an element's text below which other text is no article beside it. support: different pages that must
    have a text before it is a constant of the template."""

    repeat: int = 24
    salts: int = 16
    held: int = 5_000
    links: float = 0.5
    little: float = 0.1
    support: int = 3


def page_slots(html: str) -> Iterator[tuple[str, str, bool] | tuple[str, None, bool]]:
    """The page in order: (path, text, in a link) for a piece of text, (path, None, False) where a block starts or ends.

    A path is the elements around a piece, with class, id and role; inline elements aren't part of it.
    """
    path: list[tuple[str, str]] = []
    links, at = 0, 0
    where = ""
    for m in MARKUP.finditer(html):
        if m.start() > at:
            yield where, html[at : m.start()], links > 0
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if m["end"] else links + 1
            elif tag == "br":
                yield where, " ", False
            continue
        if tag in VOID:
            yield where, None, False
            continue
        if m["end"]:
            depth = next((k for k in range(len(path) - 1, -1, -1) if path[k][0] == tag), None)
            if depth is not None:
                del path[depth:]
        else:
            if path and path[-1][0] == "p" or path and tag == path[-1][0] and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                path.pop()  # the end tag was left out
            path.append((tag, _name(tag, m["rest"])))
        links = 0 if tag not in ("p", "li") else links
        where = "/".join(n for _, n in path)
        yield where, None, False
    if at < len(html):
        yield where, html[at:], links > 0


def _name(tag: str, rest: str) -> str:
    """The tag with its class, id and role, without numbers."""
    if "=" not in rest:
        return tag
    told = sorted({DIGITS.sub("0", w) for _, a, b, c in ATTRIBUTE.findall(rest) for w in (a or b or c).replace("/", " ").split()})
    return ".".join([tag, *told])


def blocks(html: str) -> list[tuple[str, str, float]]:
    """(path, text, share in links) of each block with text: references decoded, white space made one space."""
    out: list[tuple[str, str, float]] = []
    parts: list[str] = []
    linked, here = 0, ""

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((here, text, linked / max(1, sum(map(len, parts)))))
        parts, linked = [], 0

    for where, text, link in page_slots(html):
        if text is None:
            close()
            here = where
        else:
            here = where
            parts.append(text)
            linked += len(text) if link else 0
    close()
    return out


# A wrapper is a tuple of nodes: ("#", path) a text slot, ("+", body) a group once or more, ("?", body) an optional group.
Node = tuple[str, object]


class Facts(NamedTuple):
    """What pages have at a node of a wrapper: a digest of its texts in order (None: they differ) and how many a page has, characters and
    those of them in links, and the least digests of the pages, `support` at most."""

    digest: int | None
    texts: int
    chars: int
    linked: int
    pages: tuple[int, ...]


PRIME, BASE = (1 << 61) - 1, 1_000_003


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


def _beside(one: Facts, two: Facts) -> Facts:
    """Facts of two nodes of a page that stand side by side, as one."""
    same = None if one.digest is None or two.digest is None else (one.digest + two.digest * pow(BASE, one.texts, PRIME)) % PRIME
    return Facts(same, one.texts + two.texts, one.chars + two.chars, one.linked + two.linked, one.pages or two.pages)


def _merged(one: Facts, two: Facts, settings: Settings) -> Facts:
    """Facts of a node that two streams have: equal texts stay a constant, others make it a slot."""
    same = one.digest if one.digest == two.digest and one.texts == two.texts else None
    return Facts(same, one.texts, one.chars + two.chars, one.linked + two.linked, tuple(sorted({*one.pages, *two.pages})[: settings.support]))


def _folds(nodes: list[Node], longest: int) -> tuple[list[Node], list[int]]:
    """Repeats beside each other made one repeated group, and of how many of the nodes given each is made."""
    nodes, spans = list(nodes), [1] * len(nodes)
    size = 1
    while size <= min(longest, len(nodes) // 2):
        out: list[Node] = []
        told: list[int] = []
        k = 0
        while k < len(nodes):
            stop = k + size
            if stop < len(nodes) and nodes[k] == nodes[stop]:
                body = nodes[k:stop]
                while nodes[stop : stop + size] == body:
                    stop += size
            if stop > k + size:
                out.append(body[0] if size == 1 and body[0][0] == "+" else ("+", tuple(body)))
                told.append(sum(spans[k:stop]))
                k = stop
            else:
                out.append(nodes[k])
                told.append(spans[k])
                k += 1
        nodes, spans = out, told
        size += 1
    return nodes, spans


def folded(nodes: list[Node], longest: int) -> tuple[Node, ...]:
    """Repeats beside each other made one repeated group, shortest groups first, so that groups nest."""
    return tuple(_folds(nodes, longest)[0])


class Wrapper(NamedTuple):
    nodes: tuple[Node, ...]
    facts: tuple[Facts, ...]


def stream(pieces: list[tuple[str, str, float]], settings: Settings) -> tuple[Wrapper, list[int]]:
    """The page's own wrapper, in which each text is a constant, and how many of its pieces each node holds."""
    nodes, spans = _folds([("#", path) for path, _, _ in pieces], settings.repeat)
    own = [_digest(text) for _, text, _ in pieces]
    page = _digest("\n".join(f"{path} {d}" for (path, _, _), d in zip(pieces, own, strict=True)))
    facts: list[Facts] = []
    at = 0
    for n in spans:
        digest = 0
        for d in reversed(own[at : at + n]):
            digest = (digest * BASE + d) % PRIME
        chars = sum(len(text) for _, text, _ in pieces[at : at + n])
        linked = sum(round(link * len(text)) for _, text, link in pieces[at : at + n])
        facts.append(Facts(digest, n, chars, linked, (page,)))
        at += n
    return Wrapper(tuple(nodes), tuple(facts)), spans


def _common(one: list[Node], two: list[Node]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, found over pairs of equal nodes only."""
    where: dict[Node, list[int]] = {}
    for j in range(len(two) - 1, -1, -1):
        where.setdefault(two[j], []).append(j)  # from the last, so that a node of one is used once
    ends: list[int] = []
    chain: list[tuple] = []
    for i, node in enumerate(one):
        for j in where.get(node, ()):
            k = bisect_left(ends, j)
            link = (i, j, chain[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chain.append(link)
            else:
                ends[k], chain[k] = j, link
    out: list[tuple[int, int]] = []
    link = chain[-1] if chain else None
    while link is not None:
        out.append((link[0], link[1]))
        link = link[2]
    return out[::-1]


def _joined(one: Wrapper, two: Wrapper, settings: Settings) -> Wrapper:
    """The least union-free expression found for both: common nodes in order, groups that repeat on one side only made repeated,
    and the rest optional. Facts of common nodes are merged."""
    if one.nodes == two.nodes:
        return Wrapper(one.nodes, tuple(_merged(a, b, settings) for a, b in zip(one.facts, two.facts, strict=True)))
    (one, _), (two, _) = _as_groups(one, two.nodes), _as_groups(two, one.nodes)
    nodes: list[Node] = []
    facts: list[Facts] = []

    def some(of: Wrapper, start: int, stop: int) -> None:
        for k in range(start, stop):
            nodes.append(of.nodes[k] if of.nodes[k][0] == "?" else ("?", (of.nodes[k],)))
            facts.append(of.facts[k])

    i = j = 0
    for a, b in [*_common([_bare(x) for x in one.nodes], [_bare(x) for x in two.nodes]), (len(one.nodes), len(two.nodes))]:
        some(one, i, a)
        some(two, j, b)
        if a < len(one.nodes):
            nodes.append(one.nodes[a] if one.nodes[a][0] == "?" else two.nodes[b])
            facts.append(_merged(one.facts[a], two.facts[b], settings))
        i, j = a + 1, b + 1
    return Wrapper(tuple(nodes), tuple(facts))


NOTHING = Facts(None, 1, 0, 0, ())


def aligned(one: tuple[Node, ...], two: tuple[Node, ...]) -> tuple[Node, ...]:
    """The expression of _joined for nodes alone."""
    return _joined(Wrapper(one, (NOTHING,) * len(one)), Wrapper(two, (NOTHING,) * len(two)), Settings()).nodes


def _bare(node: Node) -> Node:
    return node[1][0] if node[0] == "?" and len(node[1]) == 1 else node


def _as_groups(own: Wrapper, other: tuple[Node, ...]) -> tuple[Wrapper, list[int]]:
    """own, with what the other side has as a repeated group made one here too, and the node in it of each node given."""
    nodes, facts, place = list(own.nodes), list(own.facts), list(range(len(own.nodes)))
    for body in sorted({x[1] for x in map(_bare, other) if x[0] == "+"}, key=lambda b: (len(b), b)):
        if body[0] not in nodes:
            continue
        out: list[Node] = []
        told: list[Facts] = []
        to: list[int] = []
        k = 0
        while k < len(nodes):
            n = len(body)
            if nodes[k] == body[0] and tuple(nodes[k : k + n]) == body:
                whole_body = facts[k]
                for x in facts[k + 1 : k + n]:
                    whole_body = _beside(whole_body, x)
                if out and out[-1] == ("+", body):
                    told[-1] = _beside(told[-1], whole_body)
                else:
                    out.append(("+", body))
                    told.append(whole_body)
                to += [len(out) - 1] * n
                k += n
            else:
                out.append(nodes[k])
                told.append(facts[k])
                to.append(len(out) - 1)
                k += 1
        nodes, facts, place = out, told, [to[x] for x in place]
    return Wrapper(tuple(nodes), tuple(facts)), place


def parsed(page: Wrapper, wrapper: Wrapper) -> list[Facts | None]:
    """For each node of a page's own wrapper the facts of the node it is in its host's; None where that has no place for it."""
    grouped, place = _as_groups(page, wrapper.nodes)
    found = dict(_common([_bare(x) for x in grouped.nodes], [_bare(x) for x in wrapper.nodes]))
    return [wrapper.facts[found[k]] if k in found else None for k in place]


def slots(nodes: tuple[Node, ...]) -> list[str]:
    """The paths of a wrapper's slots, in order, each once."""
    out: dict[str, None] = {}
    open_nodes = list(reversed(nodes))
    while open_nodes:
        kind, what = open_nodes.pop()
        if kind == "#":
            out[what] = None
        else:
            open_nodes += reversed(what)
    return list(out)


def outside(path: str, spared: frozenset[str] = frozenset()) -> bool:
    """Whether an element around the slot is one of menus, headers, footers, sidebars, notices, adverts, forms or comments.

    Words of the whole page's elements and of spared ones (by their paths) don't count.
    """
    in_main = False
    names = path.split("/")
    for k, name in enumerate(names):
        tag, *told = name.split(".")
        free = tag in ("html", "body") or spared and "/".join(names[: k + 1]) in spared
        words = set() if free else {w.lower() for t in told for w in WORD.findall(t)}
        if tag in OUTSIDE or words & OUTSIDE_WORDS:
            return True
        if not in_main and (tag == "header" or words & HEADER_WORDS):
            return True
        in_main = in_main or tag in MAIN
    return False


def in_main(path: str) -> bool:
    return any(name.split(".")[0] in MAIN or "main" in name.split(".")[1:] for name in path.split("/"))


def main_pieces(pieces: list[tuple[str, str, float]], told: list[Facts | None], settings: Settings) -> set[int]:
    """The pieces of a page's article: those inside article or main elements if the page has any with text, else those in slots of the wrapper
    that hold more than links, on the page or on its host; never those outside.

    Constants of the template are no article, unless without them little of it is left (Settings.little), as on pages that are near copies.
    An element whose class, id or role has a word of what is outside is still the article, or around it, if it holds most of the
    page's text and what is found without it is little.
    """
    sums: dict[str, tuple[int, float]] = {}
    for path, text, link in pieces:
        chars, linked = sums.get(path, (0, 0.0))
        sums[path] = chars + len(text), linked + link * len(text)
    reads = [sums[path][1] <= settings.links * sums[path][0] or of is not None and of.linked <= settings.links * of.chars
             for (path, _, _), of in zip(pieces, told, strict=True)]
    fixed = [of is not None and of.digest is not None and len(of.pages) >= settings.support for of in told]

    def chars_of(at: set[int]) -> int:
        return sum(len(pieces[k][1]) for k in at)

    def found(spared: frozenset[str]) -> set[int]:
        inside = {path for path in sums if not outside(path, spared)}
        marked = {path for path in inside if in_main(path)}
        if marked:
            return {k for k, (path, _, _) in enumerate(pieces) if path in marked}
        every = {k for k, (path, _, _) in enumerate(pieces) if path in inside and reads[k]}
        own = {k for k in every if not fixed[k]}
        return own if chars_of(own) >= settings.little * chars_of(every) else every

    main = found(frozenset())
    held: dict[str, float] = {}
    for path, (chars, linked) in sums.items():
        names = path.split("/")
        if not any(n.split(".")[0] in OUTSIDE for n in names):
            for k in range(len(names)):
                around = "/".join(names[: k + 1])
                held[around] = held.get(around, 0.0) + chars - linked
    most, little = max(held.values(), default=0.0) / 2, sum(len(pieces[k][1]) * (1 - pieces[k][2]) for k in main)
    spared = frozenset(p for p, chars in held.items() if chars > most and little < settings.little * chars)
    return found(spared) if spared else main


def _packed(nodes: tuple[Node, ...]) -> str:
    return json.dumps(nodes, ensure_ascii=False, separators=(",", ":"))


def _unpacked(nodes: str, facts: str) -> Wrapper:
    def node(x: list) -> Node:
        return x[0], x[1] if x[0] == "#" else tuple(node(y) for y in x[1])

    return Wrapper(tuple(node(x) for x in json.loads(nodes)), tuple(Facts(*f[:4], tuple(f[4])) for f in json.loads(facts)))


def host_of(url: Column) -> Column:
    """The host in a URL, in lower case; empty for a NULL or other text."""
    return F.lower(F.regexp_extract(whole(url), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


SCHEMA = "host string, wrapper string, told string"


def streams(pages: DataFrame, settings: Settings) -> DataFrame:
    """(host, html) to the streams of each host, equal ones of a task made one."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, tuple[Node, ...]], Wrapper] = {}
        for rows in batches:
            for host, html in zip(rows["host"], rows["html"], strict=True):
                own, _ = stream(blocks(html), settings)
                known = held.get((host, own.nodes))
                held[host, own.nodes] = own if known is None else _joined(known, own, settings)
                if len(held) >= settings.held:
                    yield _rows(held)
                    held = {}
        yield _rows(held)

    return pages.mapInPandas(read, SCHEMA)


def _rows(held: dict[tuple[str, tuple[Node, ...]], Wrapper]) -> pd.DataFrame:
    return pd.DataFrame([(host, _packed(w.nodes), json.dumps(w.facts, separators=(",", ":"))) for (host, _), w in held.items()], columns=["host", "wrapper", "told"])


def wrappers(pages: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(host, html) to a row (host, wrapper, told) for each host: its wrapper and the facts of its nodes.

    The streams of a host are dealt into parts, each aligned as it streams by, so that no task holds the streams of a large host;
    then the wrappers of its parts, `salts` at most, are aligned.
    """
    settings = settings or Settings()

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, known = None, Wrapper((), ())
        for rows in batches:
            for own, nodes, told in rows[["host", "wrapper", "told"]].itertuples(index=False):
                if own == host:
                    known = _joined(known, _unpacked(nodes, told), settings)
                    continue
                if host is not None:
                    yield _rows({(host, known.nodes): known})
                host, known = own, _unpacked(nodes, told)
        if host is not None:
            yield _rows({(host, known.nodes): known})

    def finish(part: pd.DataFrame) -> pd.DataFrame:
        return next(align(iter([part.sort_values("wrapper")])))

    dealt = streams(pages, settings).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(settings.salts)))
    parts = dealt.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInPandas(align, SCHEMA)
    return parts.groupBy("host").applyInPandas(finish, SCHEMA)


def main_text(html: str, wrapper: Wrapper | None, settings: Settings) -> str:
    """The main text of a page, parsed with its host's wrapper; without one it is judged alone."""
    pieces = blocks(html)
    told: list[Facts | None] = [None] * len(pieces)
    if wrapper:
        own, spans = stream(pieces, settings)
        told = [of for of, n in zip(parsed(own, wrapper), spans, strict=True) for _ in range(n)]
    main = main_pieces(pieces, told, settings)
    return "\n".join(text for k, (_, text, _) in enumerate(pieces) if k in main)


def extracted(pages: DataFrame, settings: Settings | None = None, *, url_col: str = "url", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """pages with the main text of each, empty if there is none; a NULL html counts as empty; a page without a host is judged alone.

    The column html_col must not be named text_col; a column of that name is replaced.
    """
    settings = settings or Settings()
    hosted = pages.withColumn("_host", host_of(pages[url_col]))
    found = stored(wrappers(hosted.where("_host <> ''").select(F.col("_host").alias("host"), whole(F.col(html_col)).alias("html")), settings), "wrappers")
    joined = hosted.join(found.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"), F.col("told").alias("_told")), "_host", "left")

    @F.pandas_udf("string")
    def extract(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[tuple[str, str], Wrapper] = {}
        for pages_of in batches:
            out = []
            for html, nodes, told in zip(*pages_of, strict=True):
                if nodes is not None and (nodes, told) not in known:
                    if len(known) >= 1_000:  # hosts held at a time
                        known.clear()
                    known[nodes, told] = _unpacked(nodes, told)
                out.append(main_text(html, known[nodes, told] if nodes is not None else None, settings))
            yield pd.Series(out, dtype=object)

    return joined.withColumn(text_col, extract.asNondeterministic()(whole(F.col(html_col)), F.col("_wrapper"), F.col("_told"))).drop("_host", "_wrapper", "_told")
