"""Merkle manifest of a dataset: a hash tree for each language, a tree over their roots, and a proof for each document.

Leaves are numbered within their language by range partitions and offsets, so no language is sorted in one task. Trees are built
`span` levels at a time from blocks of 2^span neighbours and stored as node rows: the address of a node, the address it is linked to
above, and the steps of a proof from one to the other. The lowest `span` levels are linked to their parents, one step each; above
them the roots of blocks are linked to the root of the block that holds them. Proofs come from recursive queries over the stored
rows: a start ascends one link in each round of the recursion, appends the steps and folds them into its hash. Roots of the lowest
blocks climb first, so that a leaf ascends `span` levels by itself and then takes the path of its block: the part of the proofs that
is shared is never carried by each leaf through a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkgrain.llm.shared import picked, stored

SPAN = 4
# Addresses: a language's tree is '1' and its name, that of NULL is '0', so that trees sort as languages do; '2' is the tree over the roots.
NO_LANG, LANG, TOP, END = "0", "1", "2", ""

NODE = "tree string, level int, idx long, up_level int, up_idx long, n long, digest binary, steps binary"
# A step of a proof: L, R or N (sibling to the left, to the right, none) and 32 bytes.
STEP = 33


def field(value: Column) -> Column:
    """'-' for NULL, else the number of bytes, ':', and the value."""
    shown = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaves(docs: DataFrame) -> DataFrame:
    """lang, id, leaf, and tampered: the leaf with 1 added to n_chars, for ids whose CRC-32 is a multiple of 7; else NULL."""
    rows = picked(docs, id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")

    def hashed(n_chars: Column) -> Column:
        return F.unhex(F.sha2(F.concat(field(F.col("id")), field(F.col("source")), field(F.col("lang")), field(n_chars), field(F.col("text"))), 256))

    chosen = F.crc32(F.encode(F.col("id").cast("string"), "UTF-8")) % 7 == 0
    return rows.select("lang", "id", hashed(F.col("n_chars")).alias("leaf"), F.when(chosen, hashed(F.col("n_chars").cast("decimal(20,0)") + 1)).alias("tampered"))


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """rows with `at` (unique), `idx` (the number within the group, from 0, by `order`, NULLs first) and `n` (rows of the group).

    Range partitions are numbered apart and set off by the counts before them; these counts are one row for each group in a
    partition. Equal rows are told apart by their place, so any number of them can be split.
    """
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    by = [group, *order, "_place"]
    laid = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_place")
    laid = stored(laid.withColumns({"_part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "numbered")
    counts = laid.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_held"), F.min("at").alias("_first"))
    of_group = Window.partitionBy(group)
    earlier = F.sum("_held").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(group, "_part", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_held").over(of_group).alias("n"))
    return laid.join(offsets, [group, "_part"]).withColumn("idx", F.col("at") + F.col("_shift")).drop("_part", "_shift")


def height(n: int) -> int:
    """Levels above the leaves."""
    return (n - 1).bit_length()


def folded(left: bytes, right: bytes = b"") -> bytes:
    return hashlib.sha256((left.hex() + right.hex()).encode()).digest()


def step(nodes: Sequence[bytes], k: int) -> bytes:
    other = nodes[k ^ 1] if k ^ 1 < len(nodes) else None
    return b"N" + bytes(STEP - 1) if other is None else (b"L" if k & 1 else b"R") + other


def raised(nodes: Sequence[bytes], first: int, level: int, n: int, span: int) -> Iterator[tuple]:
    """Links (level, idx, up_level, up_idx, digest, steps) of some neighbours that start at a multiple of 2^span, up to `span` levels
    higher or the root; the last one, with no steps, is what they come to. From level 0 each node is linked to its parent, from
    higher ones the nodes that came in to the last one."""
    up, top = level, min(level + span, height(n))
    start, digests, steps = level, list(nodes), [b""] * len(nodes)
    while up < top:
        if start == 0:
            yield from ((up, (first >> up) + k, up + 1, (first >> up + 1) + (k >> 1), digest, step(nodes, k)) for k, digest in enumerate(nodes))
        else:
            steps = [own + step(nodes, k >> up - start) for k, own in enumerate(steps)]
        nodes, up = [folded(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)], up + 1
    if start and up > start:
        yield from ((start, first + k, up, first >> up - start, digest, steps[k]) for k, digest in enumerate(digests))
    yield up, first >> up - start, up, first >> up - start, nodes[0], None


def built(tree_leaves: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Stored links of the trees over (tree, idx, n, digest): those below level `span`, those above (None if there are no such levels), and the roots
    (tree, level, digest). A tree of one leaf has no links; the leaf is the root.
    """
    rows = tree_leaves.select("tree", "idx", "n", "digest")
    tallest = height(tree_leaves.agg(F.max("n")).first()[0] or 1)
    low = high = roots = None
    for level in range(0, max(tallest, 1), span):

        def raise_blocks(batches: Iterator[pd.DataFrame], level: int = level) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), 1000):
                    out = []
                    for tree, block, n, digests in batch.iloc[at : at + 1000][["tree", "block", "n", "digests"]].itertuples(index=False):
                        out += [(tree, *link[:4], n, *link[4:]) for link in raised([bytes(x) for x in digests], block << span, level, n, span)]
                    yield pd.DataFrame(out, columns=["tree", "level", "idx", "up_level", "up_idx", "n", "digest", "steps"])

        blocks = rows.groupBy("tree", F.shiftright("idx", span).alias("block")).agg(
            F.first("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"]).alias("digests"))
        done = stored(blocks.mapInPandas(raise_blocks, NODE), f"nodes-{level}")
        links = done.where("steps is not null").select("tree", "level", "idx", F.col("tree").alias("up_tree"), "up_level", "up_idx", "steps", F.lit(None).cast("binary").alias("subroot"))
        low, high = (links, None) if low is None else (low, links if high is None else high.unionByName(links))
        last, finished = done.where("steps is null"), F.expr("n <= shiftleft(1L, level)")
        ended = last.where(finished).select("tree", "level", "digest")
        roots = ended if roots is None else roots.unionByName(ended)
        rows = last.where(~finished).select("tree", "idx", "n", "digest")
    return low, high, roots


HEX = "lower(hex({}))"
FOLD = f"""aggregate(sequence(1, length(l.steps), {STEP}), c.fold, (x, i) -> unhex(sha2(
    concat(if(substring(l.steps, i, 1) = X'4C', {HEX.format(f"substring(l.steps, i + 1, {STEP - 1})")}, ''), {HEX.format("x")},
      if(substring(l.steps, i, 1) = X'52', {HEX.format(f"substring(l.steps, i + 1, {STEP - 1})")}, '')), 256)))"""
CLIMB = f"""
with recursive climb(home, tree, level, idx, steps, fold, subroot) as (
  select home, tree, level, idx, cast('' as binary), fold, cast(null as binary) from {{starts}}
  union all
  select c.home, l.up_tree, l.up_level, l.up_idx, {{steps}}, if(length(l.steps) = 0, c.fold, {FOLD}), coalesce(c.subroot, l.subroot)
  from climb c join {{links}} l on c.tree = l.tree and c.level = l.level and c.idx = l.idx
  where c.tree <> '{END}'
)
select home, steps, fold, subroot from climb where tree = '{END}' limit all  -- the recursion is not held to a number of rows
"""
STEPS = "concat(c.steps, l.steps)"
# A proof is hashed when it is whole, so that it is in no shuffle.
SIBLINGS = f"array_join(transform(filter(sequence(1, length({STEPS}), {STEP}), i -> substring({STEPS}, i, 1) <> X'4E'), i -> {HEX.format(f'substring({STEPS}, i + 1, {STEP - 1})')}), '')"
PROOF = f"if(l.up_tree = '{END}', unhex(sha2(if(length({STEPS}) = 0, '', {SIBLINGS}), 256)), {STEPS})"


def climbed(starts: DataFrame, links: DataFrame, steps: str = STEPS) -> DataFrame:
    """Rows (home, tree, level, idx, fold) with what they gather on the way from link to link to the end: steps, fold, subroot."""
    return starts.sparkSession.sql(CLIMB.replace("{steps}", steps), starts=starts, links=links)


def paths(low: DataFrame, high: DataFrame | None, exits: DataFrame, span: int = SPAN) -> DataFrame:
    """Links for a climb from the leaves: the low ones, and whole paths from where these end. exits: links from the roots of the trees."""
    if high is None:
        return low.unionByName(exits)
    links = high.unionByName(exits.where(F.col("level") >= span))
    starts = links.where(F.col("level") == span).select(F.struct("tree", "level", "idx").alias("home"), "tree", "level", "idx", F.lit(None).cast("binary").alias("fold"))
    upper = stored(climbed(starts, links).select("home.*", *_end(), "steps", "subroot"), "paths")
    return low.unionByName(exits.where(F.col("level") < span)).unionByName(upper)


def _end() -> list[Column]:
    return [F.lit(END).alias("up_tree"), F.lit(-1).alias("up_level"), F.lit(-1).cast("long").alias("up_idx")]


def _exits(roots: DataFrame, steps: Column, subroot: Column) -> DataFrame:
    return roots.select("tree", "level", F.lit(0).cast("long").alias("idx"), *_end(), steps.alias("steps"), subroot.alias("subroot"))


def manifest(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row for each row of docs; digests as hex text.

    A document whose CRC-32 is a multiple of 7 is checked with its tampered leaf. Ids ascend, NULL before all; rows of one id are
    ordered by leaf, and equal rows are leaves each. A NULL id or n_chars is never tampered with. One language alone: its root is
    the root of all; one document alone: its leaf, and its proof is the digest of nothing. No documents: no rows.
    """
    tree = F.when(F.col("lang").isNull(), NO_LANG).otherwise(F.concat(F.lit(LANG), F.col("lang")))
    rows = stored(leaves(docs).select(tree.alias("tree"), "id", "leaf", "tampered"), "leaves")
    rows = stored(numbered(rows, "tree", ["id", "leaf"]), "leaves")
    low, high, roots = built(rows.withColumn("digest", F.col("leaf")), span)
    roots = stored(roots, "subroots")

    top = numbered(roots.withColumn("group", F.lit(TOP)), "group", ["tree"]).select(F.col("tree").alias("of"), "level", F.lit(TOP).alias("tree"), "idx", "n", "digest")
    top = stored(top, "top")
    *top_links, top_root = built(top, span)
    top_root = stored(top_root, "root")
    home = F.struct("of", F.col("level").alias("at"), "digest").alias("home")
    over = climbed(top.select(home, "tree", F.lit(0).alias("level"), "idx", F.col("digest").alias("fold")), paths(*top_links, _exits(top_root, F.lit("").cast("binary"), F.lit(None).cast("binary")), span))
    over = stored(over.select("home.*", "steps"), "top-paths").select(F.col("of").alias("tree"), F.col("at").alias("level"), "digest", "steps")

    starts = rows.select(F.col("at").alias("home"), "tree", F.lit(0).alias("level"), "idx", F.coalesce("tampered", "leaf").alias("fold"))
    ends = climbed(starts, paths(low, high, _exits(over, F.col("steps"), F.col("digest")), span), PROOF).select(F.col("home").alias("at"), "steps", "fold", "subroot")
    root = top_root.first()
    root = bytes(root["digest"]) if root else None
    hexed = lambda c: F.lower(F.hex(c))
    return rows.select("at", "id", "leaf").join(ends, "at").select(
        F.col("id").alias("doc_id"), hexed("leaf").alias("leaf"), hexed("subroot").alias("subroot"), F.lit(root and root.hex()).alias("root"), hexed("steps").alias("proof_sha256"),
        hexed("fold").alias("folded_root"), (F.col("fold") == F.lit(root)).alias("verified"))
