"""Pair classifier: negatives, features, split, training, metrics, scoring."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelweave.functions.similarity import cosine, jaro_winkler
from labelweave.functions.text import pin
from labelweave.session import cut_lineage

# Training defaults.
NEGATIVE_SAMPLE = 10_000
TEST_FRACTION = 0.2
MAX_ITERATIONS = 1000

FIT_ROWS_PER_TASK = 50_000

ROUNDS = 4  # of the permutation of pair numbers


def _hash(seed: int, *cols) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def unordered(pairs: DataFrame, a: str = "source_id", b: str = "target_id") -> DataFrame:
    """Distinct (i, j) with i < j."""
    return pairs.select(F.least(a, b).alias("i"), F.greatest(a, b).alias("j")).where("i < j").distinct()


# Merge pairs, or a function from (i, j) pairs to those of them that are merges
Positives = DataFrame | Callable[[DataFrame], DataFrame]


def no_merges(pairs: DataFrame, positives: Positives, classes: DataFrame | None = None) -> DataFrame:
    """Rows of *pairs* (i, j, ...) that are no positive, whichever way round.

    As a function, *positives* tells the merges (source_id, target_id) among the pairs it is given, so that not all merges
    there are need to be known; it judges copies itself.

    With *classes* (row_id, representative, zero) a pair is judged by its classes: copies of one row are a merge, and so
    are copies of the two rows of a positive pair.
    """
    if callable(positives):
        positives, classes = positives(pairs.select("i", "j")), None
    merges = unordered(positives).select(F.col("i").alias("_i"), F.col("j").alias("_j"))
    if classes is None:
        return pairs.join(merges, (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")), "left_anti")
    left = classes.select(F.col("row_id").alias("i"), F.col("representative").alias("_a"), F.col("zero").alias("_zero"))
    right = classes.select(F.col("row_id").alias("j"), F.col("representative").alias("_b"))
    judged = pairs.join(left, "i", "left").join(right, "j", "left").withColumns(
        {"_a": F.coalesce("_a", "i"), "_b": F.coalesce("_b", "j")})
    apart = judged.where((F.col("_a") != F.col("_b")) | F.coalesce("_zero", F.lit(False)))
    met = (F.least("_a", "_b") == F.col("_i")) & (F.greatest("_a", "_b") == F.col("_j"))
    return apart.join(merges, met, "left_anti").select(*pairs.columns)


def negative_candidates(candidates: DataFrame | None, positives: Positives, classes: DataFrame | None = None) -> DataFrame:
    """Candidate (i, j) pairs that are no positive, whichever way round; see :func:`no_merges`.

    Without *candidates* all pairs of rows are: *positives* is then a rule that can list the pairs it does not link
    (``matching.MergeRule``), as so many pairs must not travel to be judged.
    """
    if candidates is None:
        return positives.unlinked()
    pairs = candidates.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    return no_merges(pairs.where("i < j"), positives, classes)


def _positions(labels: DataFrame) -> DataFrame:
    """Dense position to row id, for ids with gaps. Ids are range-partitioned by sampled splitters, so outlying ids make no
    range longer, sorted, and numbered where they lie: by the sizes of the ranges before and the place in their own."""
    ids = labels.select("row_id").where(F.col("row_id").isNotNull()).distinct()
    laid = cut_lineage(ids.repartitionByRange("row_id").sortWithinPartitions("row_id").select(
        "row_id", F.monotonically_increasing_id().alias("_at")))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = laid.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return laid.join(F.broadcast(offsets), part == F.col("_part")).select(
        (F.col("_offset") + place).alias("position"), "row_id")


def _to_row_ids(pairs: DataFrame, positions: DataFrame | None) -> DataFrame:
    if positions is None:
        return pairs.select("draw", F.col("pi").alias("i"), F.col("pj").alias("j"))
    low = positions.select(F.col("position").alias("pi"), F.col("row_id").alias("ri"))
    high = positions.select(F.col("position").alias("pj"), F.col("row_id").alias("rj"))
    return pairs.join(low, "pi").join(high, "pj").select(
        "draw", F.least("ri", "rj").alias("i"), F.greatest("ri", "rj").alias("j"))


def half_bits(total: int) -> int:
    """Bits of each half of the smallest even-sized binary domain that holds *total* numbers."""
    return max(1, math.ceil(max(total - 1, 1).bit_length() / 2))


def _drawn_pairs(spark: SparkSession, start: int, stop: int, total: int, seed: int) -> DataFrame:
    """(draw, pi, pj): draws start..stop of a seeded permutation of the numbers of all pairs.

    A Feistel network permutes the next larger binary domain; numbers beyond *total* are left out. The number
    of a pair decodes to (i, j) arithmetically, so no join builds the pairs.
    """
    bits = half_bits(total)
    mask = (1 << bits) - 1
    halves = spark.range(start, stop).select(
        F.col("id").alias("draw"), F.shiftright("id", bits).alias("l"), F.col("id").bitwiseAND(F.lit(mask)).alias("r"))
    for turn in range(ROUNDS):
        digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{turn}"), F.col("r").cast("string")))
        mixed = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").bitwiseAND(F.lit(mask))
        halves = halves.select("draw", F.col("r").alias("l"), pin(F.col("l").bitwiseXOR(mixed)).alias("r"))
    k = F.col("k")
    guess = F.floor((1 + F.sqrt(1 + 8 * k.cast("double"))) / 2).cast("bigint")
    below = lambda j: F.expr("0L") + j * (j - 1) / 2
    fixed = F.when(below(guess) > k, guess - 1).when(below(guess + 1) <= k, guess + 1).otherwise(guess)
    numbered = halves.select("draw", (F.col("l") * F.lit(1 << bits) + F.col("r")).alias("k")).where(k < total)
    return numbered.withColumn("pj", pin(fixed)).select(
        "draw", (k - below(F.col("pj")).cast("bigint")).alias("pi"), "pj")


def sample_negatives(labels: DataFrame, positives: Positives, n: int = NEGATIVE_SAMPLE, seed: int = 42,
                     classes: DataFrame | None = None) -> DataFrame:
    """min(n, available) random non-positive pairs, i < j: the first of a seeded permutation of all pairs. *classes*
    tells which rows are copies, as in :func:`no_merges`.

    Draws are taken in growing runs until n pairs are left that are no positive, or all are drawn; how long the
    runs are changes the work and never the sample. The work grows with n and the positives only, and with n and one scan
    of the labels if *positives* is a function. The sample is stored.
    """
    spark = labels.sparkSession
    size, low, high = labels.agg(F.count("row_id"), F.min("row_id"), F.max("row_id")).first()
    total = size * (size - 1) // 2
    if total == 0 or n <= 0:
        return spark.createDataFrame([], "i bigint, j bigint")
    positions = None if low == 0 and high == size - 1 else _positions(labels)
    domain = 1 << 2 * half_bits(total)
    stop = min(domain, 2 * n * math.ceil(domain / total))
    while True:
        drawn = cut_lineage(_to_row_ids(_drawn_pairs(spark, 0, stop, total, seed), positions))
        free = no_merges(drawn, positives, classes)
        taken = cut_lineage(free.orderBy("draw").limit(n).select("i", "j"))
        if stop == domain or taken.count() >= n:
            return taken
        stop = min(domain, 4 * stop)


def union_examples(positives: DataFrame, negatives: DataFrame, seed: int = 42, shuffled: bool = True) -> DataFrame:
    """Labelled examples, in seeded hash order unless the consumer needs none."""
    pos = positives.select(F.col("source_id").alias("i"), F.col("target_id").alias("j"), F.lit(1).alias("label"))
    neg = negatives.select("i", "j", F.lit(0).alias("label"))
    both = pos.unionByName(neg)
    if not shuffled:
        return both
    return both.withColumn("_h", _hash(seed, "i", "j")).orderBy("_h", "i", "j").drop("_h")


def pair_features(examples: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """(i, j, lex, cos, label) for labelled id pairs. A hot id is split by Spark's skew handling, as
    the joins are inner and nothing above them needs the rows of an id together."""
    left = labels.select(F.col("row_id").alias("i"), F.col(label).alias("_a"), F.col("embedding").alias("_u"))
    right = labels.select(F.col("row_id").alias("j"), F.col(label).alias("_b"), F.col("embedding").alias("_v"))
    return examples.join(left, "i").join(right, "j").select(
        "i", "j", jaro_winkler("_a", "_b").alias("lex"), cosine("_u", "_v").alias("cos"), "label")


def known_features(positives: DataFrame, negatives: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """As :func:`pair_features` of all examples, for *positives* found with their ``lex`` and ``cos`` (see similar_pairs):
    no label or vector is met again but those of the negatives."""
    drawn = pair_features(negatives.select("i", "j", F.lit(0).alias("label")), labels, label)
    return positives.select(F.col("source_id").alias("i"), F.col("target_id").alias("j"), "lex", "cos",
                            F.lit(1).alias("label")).unionByName(drawn)


def _cuts(hashed: DataFrame, fraction: float, label: str, small: int) -> list[tuple]:
    """Per class (class, prefix, wanted): all rows below *prefix* of the hash are test rows, and of those that begin with
    it the first *wanted*. The prefix grows until at most *small* rows of the class begin with it."""
    spark = hashed.sparkSession
    sizes = hashed.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.round(F.count(F.lit(1)) * F.lit(fraction)).cast("bigint").alias("w"))
    open_, done = [(row[0], "", row["w"], row["n"]) for row in sizes.collect()], []  # one row per class
    while open_:
        done += [cut[:3] for cut in open_ if cut[3] <= small or len(cut[1]) >= 32]
        open_ = [cut for cut in open_ if cut[3] > small and len(cut[1]) < 32]
        if not open_:
            break
        wide = len(open_[0][1]) + 2
        kind = hashed.select(F.col(label).alias("_class"), F.lit("").alias("_prefix")).schema
        cuts = F.broadcast(spark.createDataFrame([cut[:2] for cut in open_], kind))
        inside = hashed.join(cuts, F.col(label).eqNullSafe(F.col("_class")) & F.startswith("_h", "_prefix"))
        counts = {}
        for value, prefix, n in inside.groupBy(label, F.substring("_h", 1, wide)).agg(F.count(F.lit(1))).collect():
            counts.setdefault(value, []).append((prefix, n))  # 256 rows per class
        deeper = []
        for value, _, wanted, _ in open_:
            for prefix, n in sorted(counts[value]):
                if wanted <= n:
                    deeper.append((value, prefix, wanted, n))
                    break
                wanted -= n
        open_ = deeper
    return done


def stratified_split(df: DataFrame, fraction: float = TEST_FRACTION, seed: int = 42,
                     label: str = "label", ids: tuple[str, ...] = ("i", "j"), small: int = 100_000) -> DataFrame:
    """Add ``is_test``: exactly round(fraction x class size) rows of each class, those first by a seeded hash.

    The last test row is found by selection: a histogram of hash ranges is refined around it until at most *small* rows
    of a class are left, and only these are ranked. However large a class is, no task ranks more.
    """
    hashed = df.withColumn("_h", _hash(seed, *ids))
    kind = hashed.select(F.col(label).alias("_class"), F.lit("").alias("_prefix"), F.lit(0).cast("bigint").alias("_wanted")).schema
    cuts = df.sparkSession.createDataFrame(_cuts(hashed, fraction, label, small), kind)
    placed = hashed.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_class")), "left")  # one row per class
    low = F.col("_h") < F.col("_prefix")
    at_cut = F.startswith("_h", "_prefix")
    ranked = placed.where(at_cut).withColumn("_pos", F.row_number().over(Window.partitionBy(label).orderBy("_h", *ids)))
    return placed.where(~at_cut).select(*df.columns, low.alias("is_test")).unionByName(
        ranked.select(*df.columns, (F.col("_pos") <= F.col("_wanted")).alias("is_test")))


@dataclass(frozen=True)
class MergeModel:
    """Logistic scorer over [lexical, cosine]."""

    intercept: float
    lexical: float
    cosine: float

    def logit(self, lex, cos):
        return self.intercept + self.lexical * lex + self.cosine * cos

    def probability(self, lex: Column | str, cos: Column | str) -> Column:
        lex = F.col(lex) if isinstance(lex, str) else lex
        cos = F.col(cos) if isinstance(cos, str) else cos
        z = F.lit(self.intercept) + lex * F.lit(self.lexical) + cos * F.lit(self.cosine)
        return 1.0 / (1.0 + F.exp(-z))

    def probability_array(self, lex, cos) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.logit(lex, cos)))

    def logit_floor(self, p: float) -> float:
        """Smallest logit whose probability reaches *p*."""
        if p <= 0:
            return -math.inf
        return math.inf if p >= 1 else math.log(p / (1 - p)) - 1e-9


def train_merge_classifier(features: DataFrame) -> PipelineModel:
    """L2 logistic regression with unit inverse penalty on the raw features."""
    rows = features.count()
    assemble = VectorAssembler(inputCols=["lex", "cos"], outputCol="features")
    fit = LogisticRegression(featuresCol="features", labelCol="label", maxIter=MAX_ITERATIONS, tol=1e-8,
                             standardization=False, elasticNetParam=0.0, regParam=1.0 / max(rows, 1))
    # every iteration is a job over all rows, so few rows must not be many tasks
    return Pipeline(stages=[assemble, fit]).fit(features.coalesce(max(1, rows // FIT_ROWS_PER_TASK)))


def coefficients(model: PipelineModel) -> MergeModel:
    fitted = model.stages[-1]
    lex, cos = fitted.coefficients
    return MergeModel(float(fitted.intercept), float(lex), float(cos))


def merge_probability(df: DataFrame, model: MergeModel, lex: str = "lex", cos: str = "cos",
                      out: str = "merge_probability") -> DataFrame:
    """Probability of a merge as a plain column: no Python call per pair."""
    return df.withColumn(out, model.probability(lex, cos))


def predict(df: DataFrame, model: MergeModel, threshold: float = 0.5) -> DataFrame:
    scored = merge_probability(df, model, out="probability")
    return scored.withColumn("prediction", (F.col("probability") > threshold).cast("int"))


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and averages.

    One pass counts (label, prediction) cells; the rest works on that table of
    classes squared rows.
    """
    cells = pred.groupBy(F.col(label).cast("string").alias("actual"),
                         F.col(prediction).cast("string").alias("guess")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("actual").alias("name"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("guess").alias("name"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"),
                 F.lit(0).cast("bigint").alias("hits")))).alias("s")).select("s.*")
    totals = sides.groupBy("name").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"),
                                       F.sum("hits").alias("hits"))
    def share(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))
    per_class = totals.select(
        "name", share(F.col("hits"), F.col("guessed")).alias("precision"),
        share(F.col("hits"), F.col("support")).alias("recall"),
        share(2 * F.col("hits"), F.col("guessed") + F.col("support")).alias("f1"), "support", "hits")
    def weighted(c):
        return F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)
    macro = per_class.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                          F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weight = per_class.agg(weighted("precision"), weighted("recall"), weighted("f1"), F.sum("support").alias("support"))
    right = F.try_divide(F.sum("hits"), F.sum("support"))
    accuracy = per_class.agg(right.alias("f1"), F.sum("support").alias("support"))
    cols = ["name", "precision", "recall", "f1", "support"]
    null = F.lit(None).cast("double")
    return (per_class.select(*cols)
            .unionByName(accuracy.select(F.lit("accuracy").alias("name"), null.alias("precision"),
                                         null.alias("recall"), "f1", "support"))
            .unionByName(macro.select(F.lit("macro avg").alias("name"), *cols[1:]))
            .unionByName(weight.select(F.lit("weighted avg").alias("name"), *cols[1:])))


def roc_auc(pred: DataFrame, label: str = "label", score: str = "probability") -> float:
    """Exact area under the ROC curve; ties count half."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="actual", metricName="areaUnderROC", numBins=0)
    return evaluator.evaluate(pred.select(F.col(score).cast("double").alias("score"),
                                          F.col(label).cast("double").alias("actual")))
