"""Merkle manifest of a table: every row a leaf, runs of three up to a subroot per source and one root.

Rows are ordered by source and id with a range shuffle, numbered where they then lie, and folded level by level; a group
is one run of three, so no source, however large, meets in one task. The levels are stored as parent-linked node rows.
A recursive query climbs from every leaf at once, collects the siblings of each step and folds the digest it started
with. Nodes above a share of all leaves are few by arithmetic (at most HEAVY_SHARE a level) and are broadcast; the rows
of one such node are never brought together.

Nulls in any column count as such in the leaf's digest; a null source comes before all others and a null id before all
ids. Rows that share source and id are ordered by their digest, equal rows in any order, as they are interchangeable. An
empty table gives no rows. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sized, stored

RUN = 3                # children of a node
LEVEL_BITS = 7         # a node's key is its leftmost leaf's number and its level
HEAVY_SHARE = 5_000    # a node above 1/HEAVY_SHARE of all leaves is broadcast: at most that many on a level
NODES_PER_TASK = 500_000  # small rows: more tasks would leave a shuffle with blocks of single rows

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


class Manifest(NamedTuple):
    """*leaves* (leaf_no, doc_id, leaf, changed), parent-linked *nodes* in two parts, the root (None without rows)
    and the number of leaves."""

    leaves: DataFrame
    light: DataFrame
    heavy: DataFrame
    root: bytes | None
    total: int


def _tasks(df: DataFrame, rows: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, rows // NODES_PER_TASK)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _field(value: Column) -> Column:
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """The leaf of a row, or of the row with another *text*."""
    parts = {name: F.col(name) for name in COLUMNS} | ({} if text is None else {"text": text})
    return _digest(F.concat(*[_field(parts[name]) for name in COLUMNS]))


def without_line_breaks() -> Column:
    """The tampering that the query checks for: rows whose id has an even crc32 lose their line breaks; others give null."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even & F.contains("text", F.lit("\n")), F.replace("text", F.lit("\n"), F.lit("")))


def _ordered(docs: DataFrame, changed: Column | None) -> DataFrame:
    """Rows in order of (source, id, digest), numbered by partition and place in it."""
    other = F.lit(None).cast("binary") if changed is None else F.when(changed.isNotNull(), leaf_digest(changed))
    keyed = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("ranked"),  # null first, by bytes
        "doc_id", leaf_digest().alias("leaf"), other.alias("changed"), F.monotonically_increasing_id().alias("tie"))
    order = ["ranked", "doc_id", "leaf", "tie"]
    # hashed once: the range shuffle below reads its input twice
    laid = stored(keyed).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(laid.select(F.monotonically_increasing_id().alias("leaf_no"), _digest(F.col("ranked")).alias("of"),
                              "doc_id", "leaf", F.coalesce("changed", "leaf").alias("changed")))


def _placed(numbered: DataFrame, number: str, of: str) -> DataFrame:
    """Add tree (its first number), place in it and size, from counts by partition and tree alone."""
    part = F.shiftright(number, 33)
    counts = numbered.groupBy(part.alias("part"), F.col(of).alias("tree_of")).agg(
        F.min(number).alias("start"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree_of")  # a tree has one row for each partition it touches
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized(stored(counts.select(
        "part", "tree_of", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.min("start").over(tree).alias("tree"), F.sum("n").over(tree).alias("size"))), rows=200_000)
    return numbered.join(starts, (part == F.col("part")) & (F.col(of) == F.col("tree_of"))).withColumn(
        "place", F.col(number) - F.col("start") + F.col("offset")).drop("part", "tree_of", "start", "offset")


def _runs(nodes: DataFrame, level: int, most: int) -> DataFrame:
    """The parents of *nodes* (tree, place, size, node, digest, weight, subroot), stored with their children; at most *most* of them."""
    kid = F.struct("place", "node", "digest", "weight", "subroot")
    runs = nodes.groupBy("tree", F.expr(f"place DIV {RUN}").alias("up")).agg(
        F.sort_array(F.collect_list(kid)).alias("kids"), F.max("size").alias("size"), F.sum("weight").alias("weight"))
    first = F.shiftright(F.element_at("kids", 1)["node"], LEVEL_BITS)
    joined = F.aggregate("kids", F.unhex(F.lit("")), lambda done, kid: F.concat(done, kid["digest"]))
    return stored(runs.select(
        "tree", F.col("up").alias("place"), F.expr(f"(size + {RUN - 1}) DIV {RUN}").alias("size"),
        F.shiftleft(first, LEVEL_BITS).bitwiseOR(F.lit(level)).alias("node"), _digest(_hex(joined)).alias("digest"),
        "weight", F.lit(None).cast("binary").alias("subroot"), "kids", joined.alias("joined"))
        .coalesce(1 + most // NODES_PER_TASK if most < NODES_PER_TASK // 10 else _tasks(nodes, most)))


def _links(runs: DataFrame) -> DataFrame:
    """One row per child: its node, its parent and the siblings on either side."""
    child = runs.select(F.col("node").alias("parent"), F.col("weight").alias("parent_weight"), "joined",
                        F.posexplode("kids").alias("at", "kid"))
    return child.select(
        F.col("kid.node").alias("node"), "parent", F.col("kid.weight").alias("weight"), "parent_weight",
        F.expr("substring(joined, 1, 32 * at)").alias("before"), F.expr("substring(joined, 32 * at + 33)").alias("after"),
        F.col("kid.subroot").alias("subroot"))


def manifest(docs: DataFrame, changed: Column | None = None) -> Manifest:
    """Build all levels over *docs*; *changed* is a text to check in place of a row's own, null for rows to be left."""
    spark = docs.sparkSession
    leaves = _ordered(docs.select(*COLUMNS), changed)
    total = leaves.count()
    level_columns = ["tree", "place", "size", "node", "digest", "weight", "subroot"]
    current = stored(_placed(leaves, "leaf_no", "of").select(
        "tree", "place", "size", F.shiftleft("leaf_no", LEVEL_BITS).alias("node"), F.col("leaf").alias("digest"),
        F.lit(1).cast("long").alias("weight"), F.lit(None).cast("binary").alias("subroot")))
    links, tops, level = [], [], 0
    largest = current.agg(F.max("size")).first()[0] or 0
    while True:
        tops.append(current.where("size = 1"))
        if largest <= 1:
            break
        level += 1
        # a run holds two nodes at least, but for one run of a tree
        current = _runs(current.where("size > 1"), level, 2 * total // 2 ** level)
        links.append(_links(current))
        current = current.select(*level_columns)
        largest = -(-largest // RUN)
    subroots = reduce(DataFrame.unionByName, tops).select("tree", "node", "digest", "weight")
    laid = stored(subroots.repartitionByRange("tree").sortWithinPartitions("tree").select(
        F.monotonically_increasing_id().alias("no"), F.lit(b"").alias("of"), "node", "digest", "weight"))
    current = _placed(laid, "no", "of").select(
        "tree", "place", "size", "node", "digest", "weight", F.col("digest").alias("subroot"))
    largest = laid.count()
    while largest > 1:
        level += 1
        current = _runs(current, level, largest // 2)
        links.append(_links(current))
        current = current.select(*level_columns)
        largest = -(-largest // RUN)
    root = current.select("digest").first()
    limit = max(1, total // HEAVY_SHARE)
    schema = "node long, parent long, weight long, parent_weight long, before binary, after binary, subroot binary"
    rows = reduce(DataFrame.unionByName, links, spark.createDataFrame([], schema)).select(
        "node", "parent", "before", "after", "subroot", (F.col("weight") > limit).alias("heavy"),
        (F.col("parent_weight") > limit).alias("to_heavy"))
    # laid out once as every step of the climb joins it
    light = stored(rows.where("NOT heavy").repartition(_tasks(leaves, 3 * total // 2), "node").sortWithinPartitions("node"))
    return Manifest(leaves, light, stored(rows.where("heavy").coalesce(1)), root and bytes(root[0]), total)


_CLIMB = """
WITH RECURSIVE climb (leaf_no, step, node, heavy, folded, siblings, subroot) MAX RECURSION LEVEL 120 AS (
  SELECT leaf_no, step, node, heavy, folded, siblings, subroot FROM {start}
  UNION ALL
  SELECT /*+ %s */ c.leaf_no, c.step + 1, n.parent, n.to_heavy,
         unhex(sha2(lower(hex(concat(n.before, c.folded, n.after))), 256)), concat(n.before, n.after), n.subroot
  FROM climb c JOIN {nodes} n ON c.node = n.node)
SELECT * FROM climb"""


def climb(built: Manifest) -> DataFrame:
    """(leaf_no, step, node, heavy, folded, siblings, subroot): every step of every leaf on its way to the root.

    Step 0 is the leaf with the digest to be checked. The nodes below the heavy ones are joined by key, each of them the
    ancestor of a bounded share of leaves; the heavy ones are looked up where the rows are.
    """
    spark = built.leaves.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # the climb ends at the root; its rows are leaves times levels
    start = built.leaves.select(
        "leaf_no", F.lit(0).alias("step"), F.shiftleft("leaf_no", LEVEL_BITS).alias("node"), F.lit(False).alias("heavy"),
        F.col("changed").alias("folded"), F.lit(b"").alias("siblings"), F.lit(None).cast("binary").alias("subroot"))
    tasks = _tasks(built.leaves, built.total)
    low = stored(spark.sql(_CLIMB % f"COALESCE({tasks}), MERGE(n)", start=start, nodes=built.light).coalesce(4 * tasks))
    high = spark.sql(_CLIMB % f"COALESCE({tasks}), BROADCAST(n)", start=low.where("heavy").coalesce(tasks), nodes=built.heavy)
    return low.where("NOT heavy").unionByName(high).coalesce(4 * tasks)


def proofs(built: Manifest) -> DataFrame:
    """Per leaf: its digest, subroot and root as built, the digest of its siblings, and the root folded from *changed*."""
    steps = F.sort_array(F.collect_list(F.struct("step", "siblings", "folded", "subroot")))
    paths = climb(built).groupBy("leaf_no").agg(steps.alias("steps"))
    joined = F.aggregate("steps", F.unhex(F.lit("")), lambda done, step: F.concat(done, step["siblings"]))
    own = F.filter("steps", lambda step: step["subroot"].isNotNull())
    root = F.lit(built.root).cast("binary")
    told = paths.select("leaf_no", F.sha2(_hex(joined).cast("binary"), 256).alias("proof_sha256"),
                        F.coalesce(F.get(own, F.lit(0))["subroot"], root).alias("subroot"),
                        F.element_at("steps", -1)["folded"].alias("folded"))
    return built.leaves.join(told, "leaf_no").select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(root).alias("root"),
        "proof_sha256", _hex(F.col("folded")).alias("folded_root"), (F.col("folded") == root).alias("verified"))


def merkle_report(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row under the query's tampering."""
    return proofs(manifest(docs, without_line_breaks()))

