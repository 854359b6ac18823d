"""Duplicate and similarity rules over labels, and what is done with the pairs."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelweave.functions.similarity import cosine, jaro_winkler, jaro_winkler_arrays, lexical_bound
from labelweave.functions.text import normalize_text
from labelweave.operators.blocks import BLOCK_ROWS, Side, block_self_join
from labelweave.operators.cells import cell_self_join, nearest_in_cells
from labelweave.operators.keyed import HOT_ROWS, lookup_unique, top_n_per_group
from labelweave.session import broadcast_if_small, cut_lineage

# Rule thresholds, neighbour cap and rule names.
LEXICAL_MIN = 0.80
COSINE_MIN = 0.85
NEIGHBOURS = 64
EXACT_RULE = "dup-merge-5"
SIMILAR_RULE = "sim-merge-1"

BARE = "bare"            # group of rows without a label or a vector
APART_ROWS = 1_000_000   # pairs told at a time
LOOKUP_ROWS = 100_000  # pairs of ids at most that go to the labels instead of meeting them in a shuffle

_SLACK = 1e-4  # single-precision products are re-checked in double precision


def filter_labels(df: DataFrame, pattern: str, label: str = "label") -> DataFrame:
    """Rows whose label contains a match of *pattern*, ignoring case; ids are kept."""
    re.compile(pattern)  # reject a bad pattern before any job starts
    return df.where(F.col(label).rlike("(?iu)" + pattern))


# --- exact duplicates -------------------------------------------------------

def match_key(norm: Column) -> Column:
    """Private join key of a normalised text: its digest, at every length; nulls count as empty."""
    return F.sha2(F.coalesce(norm, F.lit("")), 256)


def first_occurrence(df: DataFrame, key: str, order: str = "row_id") -> DataFrame:
    """The first row per key (by *order*, unique within a key), all columns kept.

    The minimum is found on keys alone; whole rows meet it in a semi-join.
    """
    first = df.groupBy(key).agg(F.min(order).alias("_first")).withColumnRenamed(key, "_key")
    met = F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_first"))
    return df.join(first, met, "left_semi")


def exact_duplicates(labels: DataFrame, label: str = "label", hot_rows: int = HOT_ROWS, with_key: bool = True) -> DataFrame:
    """(source_id, target_id[, norm_key]) for every repeat of an earlier label.

    Every text is normalised once, to a stored digest. The first row per key comes
    from a pre-aggregated minimum; repeats then look it up, hot keys map-side. The
    normalised text is taken afterwards, *with_key* only, for the rows that repeat.
    """
    known = labels.where(F.col(label).isNotNull())
    keyed = cut_lineage(known.select(F.col("row_id").alias("source_id"), match_key(normalize_text(label)).alias("_key_of")))
    groups = (keyed.groupBy("_key_of")
              .agg(F.min("source_id").alias("target_id"), F.count(F.lit(1)).alias("_rows"))
              .where(F.col("_rows") > 1))
    found = lookup_unique(keyed, groups, "_key_of", "_rows", "target_id", hot_rows)
    found = found.where(F.col("source_id") > F.col("target_id")).select("source_id", "target_id")
    if not with_key:
        return found
    texts = known.select(F.col("row_id").alias("source_id"), F.col(label).alias("_text"))
    return found.join(texts, "source_id").select("source_id", "target_id", normalize_text("_text").alias("norm_key"))


# --- similar pairs ----------------------------------------------------------

_PAIR_SCHEMA = "source_id bigint, target_id bigint, jw double, cos double"
_FEATURE_SCHEMA = _PAIR_SCHEMA + ", lex double"


def _cosine_hits(left: Side, right: Side, diagonal: bool, cos_min: float):
    """Exact (left index, right index, cosine) of pairs at or above *cos_min*."""
    near = _near(left, right, diagonal, cos_min)
    for rows in left.chunks(right):
        yield from near(rows)


def _near(left: Side, right: Side, diagonal: bool, cos_min: float):
    """What :func:`_cosine_hits` tells of some left rows."""
    l32, r32 = left.unit.astype(np.float32), right.unit.astype(np.float32)

    def hits(rows: slice):
        keep = l32[rows] @ r32.T >= cos_min - _SLACK
        if diagonal:
            keep &= right.ids[None, :] > left.ids[rows][:, None]
        i, j = np.nonzero(keep)
        i += rows.start
        # checked by the stored vectors in slices, so a dense block stays small
        for at in range(0, len(i), 200_000):
            a, b = i[at:at + 200_000], j[at:at + 200_000]
            cos = left.cosines(a, right, b)
            hit = cos >= cos_min
            if hit.any():
                yield a[hit], b[hit], cos[hit]
    return hits


def _oriented_texts(left: Side, right: Side, i, j):
    """Ids and texts with the smaller id first."""
    swap = left.ids[i] > right.ids[j]
    lo, hi = np.where(swap, right.ids[j], left.ids[i]), np.where(swap, left.ids[i], right.ids[j])
    a, b = np.where(swap, right.text[j], left.text[i]), np.where(swap, left.text[i], right.text[j])
    return lo, hi, a, b


def _lengths(texts) -> np.ndarray:
    return np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))


def _both_rules(cos_min: float, jw_min: float, with_lex: bool = False):
    def score(left: Side, right: Side, diagonal: bool):
        for i, j, cos in _cosine_hits(left, right, diagonal, cos_min):
            lo, hi, a, b = _oriented_texts(left, right, i, j)
            can = lexical_bound(_lengths(a), _lengths(b)) >= jw_min
            jw = np.zeros(len(i))
            jw[can] = jaro_winkler_arrays(a[can], b[can])
            hit = jw >= jw_min
            if hit.any():
                lex = {"lex": jaro_winkler_arrays(b[hit], a[hit])} if with_lex else {}
                yield {"source_id": hi[hit], "target_id": lo[hit], "jw": jw[hit], "cos": cos[hit], **lex}
    return score


def _block_input(labels: DataFrame, emb: DataFrame | None, label: str) -> DataFrame:
    # a label without a vector is an error there, not a loss here
    df = labels if emb is None else labels.join(emb.select("row_id", "embedding"), "row_id", "left")
    return df.select(F.col("row_id").alias("id"), F.col(label).alias("text"), F.col("embedding").alias("vec"))


def similar_pairs(labels: DataFrame, emb: DataFrame | None = None, cos_min: float = COSINE_MIN,
                  jw_min: float = LEXICAL_MIN, label: str = "label",
                  block_rows: int = BLOCK_ROWS, with_lex: bool = False) -> DataFrame:
    """Every pair with cosine and Jaro-Winkler at or above the thresholds.

    The larger id merges into the smaller. *labels* may carry ``embedding``
    itself, or it is joined from *emb*. Rows meet in the cells of a metric index,
    which skips what cannot reach the cosine; the lexical check only sees its
    survivors, in the same task. *with_lex* adds the Jaro-Winkler of source to target, the
    lexical feature of the pair, as the measure is not symmetric.
    """
    return cell_self_join(_block_input(labels, emb, label), _both_rules(cos_min, jw_min, with_lex),
                          _FEATURE_SCHEMA if with_lex else _PAIR_SCHEMA, cos_min, block_rows=block_rows)


def linked_pairs(pairs: DataFrame, labels: DataFrame, cos_min: float = COSINE_MIN, jw_min: float = LEXICAL_MIN,
                 label: str = "label") -> DataFrame:
    """(source_id, target_id) of those of *pairs* (i, j; i < j) that :func:`similar_pairs` would link. The work grows with
    *pairs* and *labels*; vectors are met by the pairs whose labels are alike only."""
    pairs = broadcast_if_small(pairs, LOOKUP_ROWS)
    name = lambda a, b: labels.select(F.col("row_id").alias(a), F.col(label).alias(b))
    vector = lambda a, b: labels.select(F.col("row_id").alias(a), F.col("embedding").alias(b))
    alike = cut_lineage(pairs.join(name("i", "_a"), "i").join(name("j", "_b"), "j").where(
        jaro_winkler("_a", "_b") >= jw_min).select("i", "j"))
    near = broadcast_if_small(alike, LOOKUP_ROWS).join(vector("i", "_u"), "i").join(vector("j", "_v"), "j")
    return near.where(cosine("_u", "_v") >= cos_min).select(F.col("j").alias("source_id"), F.col("i").alias("target_id"))


_APART_SCHEMA = "i bigint, j bigint"


def _apart(cos_min: float, jw_min: float):
    """All pairs but those that both rules link; a row of the group BARE is linked to none."""
    def score(left: Side, right: Side, diagonal: bool):
        near = _near(left, right, diagonal, cos_min)
        for rows in left.chunks(right):
            a = left.ids[rows]
            apart = right.ids[None, :] > a[:, None] if diagonal else right.ids[None, :] != a[:, None]
            for i, j, _ in near(rows):
                _, _, x, y = _oriented_texts(left, right, i, j)
                linked = (jaro_winkler_arrays(x, y) >= jw_min) & (left.group[i] != BARE) & (right.group[j] != BARE)
                apart[i[linked] - rows.start, j[linked]] = False
            i, j = np.nonzero(apart)
            for at in range(0, len(i), APART_ROWS):
                one, other = a[i[at:at + APART_ROWS]], right.ids[j[at:at + APART_ROWS]]
                yield {"i": np.minimum(one, other), "j": np.maximum(one, other)}
    return score


def unlinked_pairs(labels: DataFrame, cos_min: float = COSINE_MIN, jw_min: float = LEXICAL_MIN, label: str = "label",
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(i, j), i < j, of every two rows that :func:`similar_pairs` would not link, copies told one by one.

    Half the square of the rows. Blocks of rows meet, and the pairs of two blocks are told in slices where they meet: no pair
    is shuffled. A label or vector that is missing is similar to nothing.
    """
    wide = max(1, labels.agg(F.max(F.size("embedding"))).first()[0] or 1)
    bare = F.col(label).isNull() | F.col("embedding").isNull()
    rows = labels.where(F.col("row_id").isNotNull()).select(
        F.col("row_id").alias("id"), F.coalesce(label, F.lit("")).alias("text"),
        F.when(bare, BARE).otherwise("").alias("grp"),
        F.coalesce("embedding", F.array_repeat(F.lit(0.0).cast("float"), wide)).alias("vec"))
    return block_self_join(rows, _apart(cos_min, jw_min), _APART_SCHEMA, block_rows=block_rows)


@dataclass(frozen=True)
class MergeRule:
    """The rule of :func:`similar_pairs` over given labels, for those who need not know all merges."""

    labels: DataFrame
    cos_min: float = COSINE_MIN
    jw_min: float = LEXICAL_MIN

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """(source_id, target_id) of the merges among *pairs* (i, j)."""
        return linked_pairs(pairs, self.labels, self.cos_min, self.jw_min)

    def unlinked(self) -> DataFrame:
        """All pairs (i, j) that are no merge."""
        return unlinked_pairs(self.labels, self.cos_min, self.jw_min)


def representatives(labels: DataFrame, label: str = "label") -> DataFrame:
    """One row per distinct (label, vector): the lowest id, with the group size.

    Copies add nothing to which rows merge: the exact rule already removes
    them, and they are similar to exactly what their first occurrence is
    similar to. Similarity work on the result is free of copy groups. Labels that
    differ in case or accents only are kept apart, as similarity compares them as written.
    """
    return (labels.where(F.col(label).isNotNull()).groupBy(label, "embedding")
            .agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("copies"))
            .select("row_id", label, "embedding", "copies"))


def class_key(label: str = "label") -> Column:
    """Digest of (label, vector), equal for rows of one class."""
    # floats print so that they read back alike, so equal texts are equal vectors
    vector = F.transform("embedding", lambda x: x + F.lit(0.0)).cast("string")  # -0.0 is 0.0
    return F.sha2(F.concat(F.octet_length(label).cast("string"), F.lit(":"), F.col(label), vector), 256)


def class_table(labels: DataFrame, label: str = "label", hot_rows: int = HOT_ROWS) -> DataFrame:
    """(row_id, representative, copies, zero): the class of every row, that is of its (label, vector).

    *zero* tells that the vector is all zeros, which is similar to nothing, not even to its copies.
    """
    keyed = labels.where(F.col(label).isNotNull()).select(
        "row_id", class_key(label).alias("_class"), F.forall("embedding", lambda x: x == 0).alias("zero"))
    groups = keyed.groupBy("_class").agg(F.min("row_id").alias("_first"), F.count(F.lit(1)).alias("copies"))
    several = groups.where("copies > 1").withColumn("_of", F.struct("_first", "copies"))
    found = lookup_unique(keyed, several.select("_class", "copies", "_of"), "_class", "copies", "_of", hot_rows)
    return found.select("row_id", F.coalesce("_of._first", "row_id").alias("representative"),
                        F.coalesce("_of.copies", F.lit(1)).cast("bigint").alias("copies"), "zero")


def similar_classes(labels: DataFrame, classes: DataFrame | None = None, cos_min: float = COSINE_MIN,
                    jw_min: float = LEXICAL_MIN, label: str = "label", block_rows: int = BLOCK_ROWS,
                    with_lex: bool = False) -> DataFrame:
    """As :func:`similar_pairs`, with every link and no expanded copies: the pairs of representatives, and each copy
    with its representative. Two rows are similar exactly when their classes are one or linked."""
    classes = class_table(labels, label) if classes is None else classes
    between = similar_pairs(representatives(labels, label), cos_min=cos_min, jw_min=jw_min, label=label, block_rows=block_rows,
                            with_lex=with_lex)
    copies = classes.where("row_id > representative AND NOT zero").select(
        F.col("row_id").alias("source_id"), F.col("representative").alias("target_id"), F.lit(1.0).alias("jw"), F.lit(1.0).alias("cos"),
        *([F.lit(1.0).alias("lex")] if with_lex else []))
    return between.unionByName(copies)


def similar_pairs_topk(labels: DataFrame, emb: DataFrame | None = None, k: int = NEIGHBOURS,
                       cos_min: float = COSINE_MIN, jw_min: float = LEXICAL_MIN, label: str = "label",
                       block_rows: int = BLOCK_ROWS, cells: int | None = None) -> DataFrame:
    """As :func:`similar_pairs`, but a pair (i, j>i) counts only when j is among
    the *k* nearest of i (i itself takes the first place).

    Copies count as rows. The search runs over one row per class, weighted by its copies; classes near enough are then
    read as rows, of which a class gives at most its first k. Labels are joined for the classes that are left.
    """
    labels = labels if emb is None else labels.join(emb.select("row_id", "embedding"), "row_id", "left")
    labels = labels.where(F.col(label).isNotNull())
    classes = cut_lineage(class_table(labels, label))
    reps = labels.join(classes.where("row_id = representative").select("row_id", "copies"), "row_id").select(
        F.col("row_id").alias("id"), F.col(label).alias("text"), F.col("embedding").alias("vec"), F.col("copies").alias("weight"))
    own = classes.where("row_id = representative").select(
        F.col("row_id").alias("row"), F.col("row_id").alias("other"), F.when(F.col("zero"), 0.0).otherwise(1.0).alias("cos"))
    near = nearest_in_cells(reps, k, cos_min, block_rows, cells).unionByName(own).where(F.col("cos") >= cos_min)
    members = top_n_per_group(classes.select("representative", F.col("row_id").alias("j")), ["representative"], [F.col("j")], k)
    order = [F.round("cos", 12).desc(), F.col("j")]
    # the k first rows as all rows of a class see them, itself among them
    listed = cut_lineage(top_n_per_group(
        near.join(members.withColumnRenamed("representative", "other"), "other"), ["row"], order, k))
    texts = reps.select("id", "text")
    alike = (listed.select("row", "other").distinct()
             .join(texts.select(F.col("id").alias("row"), F.col("text").alias("_a")), "row")
             .join(texts.select(F.col("id").alias("other"), F.col("text").alias("_b")), "other")
             .select("row", "other", jaro_winkler("_a", "_b").alias("jw")).where(F.col("jw") >= jw_min))
    seen = classes.select(F.col("row_id").alias("i"), F.col("representative").alias("row")).join(listed, "row").where("i <> j")
    nearest = top_n_per_group(seen, ["i"], order, k - 1).where(F.col("j") > F.col("i"))
    return nearest.join(alike, ["row", "other"]).select(
        F.col("j").alias("source_id"), F.col("i").alias("target_id"), "jw", "cos")


# --- pair sets --------------------------------------------------------------

def union_rules(exact: DataFrame, similar: DataFrame, distinct: bool = False) -> DataFrame:
    """All rule hits with their rule name; a pair found by both rules appears twice
    unless *distinct*."""
    def shaped(df, rule):
        cols = {c: F.col(c) for c in df.columns}
        null = F.lit(None)
        return df.select("source_id", "target_id", F.lit(rule).alias("rule"),
                         cols.get("norm_key", null.cast("string")).alias("norm_key"),
                         cols.get("jw", null.cast("double")).alias("jw"),
                         cols.get("cos", null.cast("double")).alias("cos"))
    out = shaped(exact, EXACT_RULE).unionByName(shaped(similar, SIMILAR_RULE))
    return out.select("source_id", "target_id").distinct() if distinct else out


def sort_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.orderBy("target_id", "source_id")


def label_pairs(pairs: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Attach both labels to (source_id, target_id). Sides join on ids; a hot id
    is left to adaptive skew handling, and small label sets are broadcast by size."""
    src = labels.select(F.col("row_id").alias("source_id"), F.col(label).alias("source_label"))
    tgt = labels.select(F.col("row_id").alias("target_id"), F.col(label).alias("target_label"))
    return pairs.join(src, "source_id").join(tgt, "target_id").select(
        *pairs.columns, "source_label", "target_label")


def merge_audit(pairs: DataFrame) -> DataFrame:
    """Typed audit rows plus the rendered line of each decision."""
    head = F.concat(F.lit("rule="), F.col("rule"), F.lit(" src="), F.col("source_id").cast("string"),
                    F.lit(" tgt="), F.col("target_id").cast("string"))
    line = F.when(F.col("rule") == EXACT_RULE, F.concat(head, F.lit(" norm='"), F.col("norm_key"), F.lit("'"))) \
        .otherwise(F.concat(head, F.lit(" jw="), F.format_string("%.3f", "jw"),
                            F.lit(", cos="), F.format_string("%.3f", "cos")))
    return pairs.select("rule", "source_id", "target_id", "norm_key", "jw", "cos", line.alias("line"))


def rule_metrics(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs per rule, their total, and the total as a percentage of the labels."""
    per_rule = pairs.groupBy("rule").agg(F.count(F.lit(1)).alias("pairs"))
    totals = per_rule.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("total"))
    size = labels.agg(F.count(F.lit(1)).alias("labels"))
    # both sides of these joins hold one row
    return per_rule.crossJoin(F.broadcast(totals)).crossJoin(F.broadcast(size)).select(
        "rule", "pairs", "total", F.try_divide(F.col("total") * 100.0, F.col("labels")).alias("pct_of_labels"))


def merge_metrics(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: how far the merges shrink the taxonomy."""
    size = labels.agg(F.count(F.lit(1)).alias("original"))
    found = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("source_id").alias("unique_sources"))
    # one row each
    return size.crossJoin(F.broadcast(found)).select(
        "original", "pairs", "unique_sources",
        (F.col("original") - F.col("unique_sources")).alias("aligned"),
        F.col("unique_sources").alias("reduction"),
        F.try_divide(F.col("unique_sources") * 100.0, F.col("original")).alias("reduction_pct"))


def export_aligned(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """Labels left after merged sources are dropped; ids stay original."""
    sources = pairs.select(F.col("source_id").alias("row_id")).distinct()
    return labels.join(sources, "row_id", "left_anti")


def unknown_sources(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: merged ids that name no label (the export ignores them)."""
    ids = pairs.select(F.col("source_id").alias("row_id")).distinct()
    return ids.join(labels.select("row_id"), "row_id", "left_anti").agg(F.count(F.lit(1)).alias("unknown_sources"))


def distinct_seeds(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("target_id").alias("seed_id")).distinct().orderBy("seed_id")


def compartments(pairs: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Members of each merge target, the target itself included; one hop, no repeats."""
    # the pairs are read once: finding them may be most of the work
    members = pairs.select(F.col("target_id").alias("canonical_id"),
                           F.explode(F.array("source_id", "target_id")).alias("member_id")).distinct()
    canon = labels.select(F.col("row_id").alias("canonical_id"), F.col(label).alias("canonical_label"))
    member = labels.select(F.col("row_id").alias("member_id"), F.col(label).alias("member_label"))
    return (members.join(canon, "canonical_id").join(member, "member_id")
            .select("canonical_id", "canonical_label", "member_id", "member_label")
            .orderBy("canonical_id", "member_id"))


# --- preference prompts and rewards ----------------------------------------

def merge_prompts(pairs: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """One yes/no question per pair."""
    named = label_pairs(pairs.select("source_id", "target_id"), labels, label)
    return named.select("source_id", "target_id", F.format_string(
        "Should '%s' be merged into '%s'? Answer 'Yes' or 'No'.", "source_label", "target_label").alias("prompt"))


def score_responses(df: DataFrame, response: str = "response", expected: Column | None = None) -> DataFrame:
    """+1 when the answer agrees with *expected* (default: yes), else -1."""
    want = F.lit(True) if expected is None else expected
    trimmed = F.regexp_replace(F.col(response), r"^[\s\x1c-\x1f]+", "")
    says_yes = F.startswith(F.lower(trimmed), F.lit("yes"))
    return df.withColumn("reward", F.when(says_yes == want, F.lit(1.0)).otherwise(F.lit(-1.0)))


def mean_reward(scored: DataFrame, batch: str) -> DataFrame:
    return scored.groupBy(batch).agg(F.avg("reward").alias("mean_reward"))
