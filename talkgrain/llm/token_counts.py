"""Edit-aware token counts.

Each document keeps a segment tree over runs of its pre-tokens: the leaves are stretches of text that a tokenizer splits the same
alone as in the whole, the nodes are sums of their token counts. After edits only the leaves they touch, with the context on both
sides, are encoded again, and the sums above them are updated.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import whole

# Fixed value: how the byte-level vocabulary splits a text into pre-tokens.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# White space after something else always starts a pre-token, and what stands before it is split alike without it.
BOUNDARY = re.compile(r"(?<=\S)(?=[ \t\r\n])")


# White space as the pattern has it, in runs that its matcher cannot be trusted with: it backs up sign by sign and ends the process at a million.
LONG_RUN = re.compile("[\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


@dataclass(frozen=True)
class Settings:
    """vocabulary: a file of ranks, read by the driver; its size is that of the vocabulary. leaf: least characters of a leaf."""

    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    leaf: int = 512


class Encoder:
    """Token counts of texts under a vocabulary of ranks."""

    def __init__(self, ranks: bytes) -> None:
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def counts(self, texts: list[str]) -> list[int]:
        return [self.count(x) for x in texts]  # a batch call would start a pool of threads each time

    def count(self, text: str) -> int:
        """A long run of white space is counted apart: it is a pre-token if the text ends with it, else all of it but the last sign is."""
        done = at = 0
        for run in LONG_RUN.finditer(text) if len(text) >= 1000 else ():
            end = run.end() if run.end() == len(text) else run.end() - 1
            done += len(self.encoding.encode_ordinary(text[at : run.start()])) + len(self.encoding._core_bpe.encode_single_piece(text[run.start() : end].encode()))
            at = end
        return done + len(self.encoding.encode_ordinary(text[at:]))


def cut(text: str, leaf: int) -> list[int]:
    """Where the leaves of a text end."""
    ends = []
    at = leaf
    while at < len(text) and (m := BOUNDARY.search(text, at)):
        ends.append(m.start())
        at = m.start() + leaf
    return [*ends, len(text)] if text else []


def summed(leaves: list[int]) -> list[int]:
    """The tree over leaf counts as a heap: node k has the children 2k and 2k + 1, node 1 is the whole."""
    width = 1
    while width < len(leaves):
        width *= 2
    tree = [0] * width + leaves + [0] * (width - len(leaves))
    for k in range(width - 1, 0, -1):
        tree[k] = tree[2 * k] + tree[2 * k + 1]
    return tree


def settled(edits: list[tuple[int, int, str]], length: int) -> list[tuple[int, int, str]]:
    """Edits (start, end, new text) in order, clipped to the text. Of edits that overlap the earlier start stays, then the shorter,
    then the lesser text; equal edits count once."""
    kept: list[tuple[int, int, str]] = []
    for start, end, new in sorted({(max(0, min(a, length)), max(0, min(b, length)), t) for a, b, t in edits}):
        if end >= start and (not kept or start >= kept[-1][1] and (start, end) != kept[-1][:2]):
            kept.append((start, end, new))
    return kept


def recounted(text: str, ends: list[int], tree: list[int], edits: list[tuple[int, int, str]], encoder: Encoder, leaf: int) -> tuple[str, list[int], list[int], int]:
    """The edited text, its leaf ends and tree, and how many characters were encoded for them."""
    edits = settled(edits, len(text))
    if not edits:
        return text, ends, tree, 0
    if not ends:
        new = "".join(t for _, _, t in edits)
        ends = cut(new, leaf)
        return new, ends, summed(encoder.counts([new[a:b] for a, b in zip([0, *ends], ends, strict=False)])), len(new)
    regions: list[list] = []  # first leaf, last leaf, edits
    for edit in edits:
        first = bisect_right(ends, max(edit[0] - 1, 0))
        last = min(bisect_right(ends, edit[1]), len(ends) - 1)
        if regions and first <= regions[-1][1]:
            regions[-1][1] = max(regions[-1][1], last)
            regions[-1][2].append(edit)
        else:
            regions.append([min(first, last), last, [edit]])
    tree, new_ends, pieces, width = list(tree), list(ends), [], len(tree) // 2
    shift, done, encoded, touched, at_leaf = 0, 0, 0, set(), 0
    for first, last, own in regions:
        start, end = ends[first - 1] if first else 0, ends[last]
        for k in range(at_leaf, first):
            new_ends[k] = ends[k] + shift
        pieces.append(text[done:start])
        parts, at = [], start
        for a, b, t in own:
            parts += [text[at:a], t]
            at = b
        region = "".join([*parts, text[at:end]])
        pieces.append(region)
        inner = cut(region, leaf)
        slots = last - first + 1
        inner = [*inner[: slots - 1], len(region)] if len(inner) > slots else inner + [len(region)] * (slots - len(inner))
        counts = encoder.counts([region[a:b] for a, b in zip([0, *inner], inner, strict=False)])
        for k, (stop, count) in enumerate(zip(inner, counts, strict=True)):
            new_ends[first + k] = start + shift + stop
            tree[width + first + k] = count
            touched.add((width + first + k) // 2)
        encoded += len(region)
        shift += len(region) - (end - start)
        done, at_leaf = end, last + 1
    for k in range(at_leaf, len(ends)):
        new_ends[k] = ends[k] + shift
    pieces.append(text[done:])
    while touched:
        for k in touched:
            if k:
                tree[k] = tree[2 * k] + tree[2 * k + 1]
        touched = {k // 2 for k in touched if k > 1}
    return "".join(pieces), new_ends, tree, encoded


def _ranks(spark, settings: Settings):
    with open(settings.vocabulary, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def with_trees(docs: DataFrame, settings: Settings | None = None, *, text_col: str = "text") -> DataFrame:
    """docs with n_tokens, leaf_ends and token_tree of each whole text; a NULL or empty text has no leaves and no tokens."""
    settings = settings or Settings()
    ranks = _ranks(docs.sparkSession, settings)

    @F.pandas_udf("leaf_ends array<int>, token_tree array<long>")
    def grow(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks.value)
        for texts in batches:
            ends = [cut(x, settings.leaf) for x in texts]
            flat = encoder.counts([x[a:b] for x, own in zip(texts, ends, strict=True) for a, b in zip([0, *own], own, strict=False)])
            trees, at = [], 0
            for own in ends:
                trees.append(summed(flat[at : at + len(own)]))
                at += len(own)
            yield pd.DataFrame({"leaf_ends": ends, "token_tree": trees})

    out = docs.withColumn("_tree", grow.asNondeterministic()(whole(docs[text_col])))
    out = out.withColumns({"leaf_ends": F.col("_tree.leaf_ends"), "token_tree": F.col("_tree.token_tree")}).drop("_tree")
    return out.withColumn("n_tokens", total(out["token_tree"]))


def total(tree):
    """The count at the root; a tree of one leaf is that leaf."""
    return F.coalesce(F.get(tree, F.lit(1)), F.lit(0)).cast("long")


def with_edits(trees: DataFrame, settings: Settings | None = None, *, edits_col: str = "edits", text_col: str = "text") -> DataFrame:
    """Texts with trees, after their edits (an array of start, end, text; code points of the text as it was, end exclusive).

    text, leaf_ends, token_tree and n_tokens are those after the edits; n_edits counts the edits that took effect and n_encoded the
    characters encoded again. NULL edits are none. Edits may be NULL in parts: a NULL text is empty, a NULL bound drops the edit.
    """
    settings = settings or Settings()
    ranks = _ranks(trees.sparkSession, settings)

    @F.pandas_udf("text string, leaf_ends array<int>, token_tree array<long>, n_edits long, n_encoded long")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks.value)
        for texts, ends, nodes, edits in batches:
            rows = []
            for text, own, tree, changes in zip(texts, ends, nodes, edits, strict=True):
                wanted = [(int(x["start"]), int(x["end"]), x["text"] or "") for x in ([] if changes is None else changes) if x is not None and x["start"] is not None and x["end"] is not None]
                rows.append((*recounted(text, list(own), list(tree), wanted, encoder, settings.leaf), len(settled(wanted, len(text)))))
            yield pd.DataFrame([(t, e, n, k, c) for t, e, n, c, k in rows], columns=["text", "leaf_ends", "token_tree", "n_edits", "n_encoded"])

    out = trees.withColumn("_edited", apply.asNondeterministic()(whole(trees[text_col]), trees["leaf_ends"], trees["token_tree"], trees[edits_col]))
    out = out.withColumns({text_col: F.col("_edited.text"), **{n: F.col(f"_edited.{n}") for n in ("leaf_ends", "token_tree", "n_edits", "n_encoded")}}).drop("_edited")
    return out.withColumn("n_tokens", total(out["token_tree"]))


def counted_through(docs: DataFrame, find: Callable[[str], list[tuple[int, int, str]]], settings: Settings | None = None, *, text_col: str = "text") -> DataFrame:
    """docs with the counts before and after the edits that `find` gives for each whole text: the steps of with_trees and with_edits
    in one task, for callers that keep neither trees nor edited texts.

    New columns: n_chars_before, n_tokens_before, n_leaves, n_edits, n_encoded, n_tokens. A NULL text counts as empty.
    """
    settings = settings or Settings()
    ranks = _ranks(docs.sparkSession, settings)
    names = ("n_chars_before", "n_tokens_before", "n_leaves", "n_edits", "n_encoded", "n_tokens")

    @F.pandas_udf(", ".join(f"{n} long" for n in names))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks.value)
        for batch in batches:
            rows = []
            for text in batch:
                ends = cut(text, settings.leaf)
                tree = summed(encoder.counts([text[a:b] for a, b in zip([0, *ends], ends, strict=False)]))
                edits = settled(find(text), len(text))
                _, left, after, encoded = recounted(text, ends, tree, edits, encoder, settings.leaf)
                rows.append((len(text), tree[1], len(left), len(edits), encoded, after[1]))
            yield pd.DataFrame(rows, columns=names)

    return docs.withColumn("_counts", count.asNondeterministic()(whole(docs[text_col]))).withColumns({n: F.col(f"_counts.{n}") for n in names}).drop("_counts")


PERSONAL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+?\d[\d ().-]{7,}\d|[0-9a-f]{32,}")


def personal(text: str, mark: str = "<removed>") -> list[tuple[int, int, str]]:
    """The edits that take e-mail addresses, long numbers and long hex runs out of a text."""
    return [(m.start(), m.end(), mark) for m in PERSONAL.finditer(text)]


def personal_edits(docs: DataFrame, *, text_col: str = "text", edits_col: str = "edits", mark: str = "<removed>") -> DataFrame:
    """docs with the edits of `personal`."""

    @F.pandas_udf("array<struct<start int, end int, text string>>")
    def find(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: [{"start": a, "end": b, "text": t} for a, b, t in personal(x, mark)])

    return docs.withColumn(edits_col, find.asNondeterministic()(whole(docs[text_col])))
