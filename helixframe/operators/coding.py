"""Second stage: splits, folds, cutoffs, forests and metrics."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators import forest
from helixframe.operators.key_balance import number_rows
from helixframe.session import shared_checkpoint

_BITS = 48


def hash_order(name: Column, seed: int) -> Column:
    """A repeatable random order: 48 bits of the md5 of name and seed."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", name, F.lit(str(seed)))), 1, _BITS // 4), 16, 10).cast("long")


def shuffled_rank(df: DataFrame, name: str, cls: str, seed: int = 1) -> DataFrame:
    """`df` with shuffle_rank (1, 2, ... within `cls` in hash order) and class_size.

    Numbered by blocks of the hash order, so that no class is sorted in one task.
    """
    keyed = df.withColumn("_h", hash_order(F.col(name), seed))
    ranked = number_rows(keyed, [cls], "_h", [name], name="shuffle_rank").drop("_h")
    sizes = df.groupBy(F.col(cls).alias("_c")).agg(F.count("*").alias("class_size"))
    return ranked.join(sizes, ranked[cls].eqNullSafe(sizes["_c"])).drop("_c")


def holdout_split(df: DataFrame, name: str, cls: str, share: float = 0.1, seed: int = 1) -> DataFrame:
    """`df` with part: model for the first `share` of each class in hash order, forest for the rest."""
    ranked = shuffled_rank(df, name, cls, seed)
    return ranked.withColumn("part", F.when(F.col("shuffle_rank") <= F.floor(F.col("class_size") * share), "model").otherwise("forest")).drop("shuffle_rank", "class_size")


def cv_folds(df: DataFrame, name: str, n_folds: int = 10, seed: int = 1) -> DataFrame:
    """`df` with fold 1..n_folds: equal runs of the hash order."""
    ranked = shuffled_rank(df.withColumn("_all", F.lit(0)), name, "_all", seed)
    return ranked.withColumn("fold", F.ceil(F.col("shuffle_rank") * n_folds / F.col("class_size")).cast("int")).drop("_all", "shuffle_rank", "class_size")


#: A curve's scores are summed in about this many blocks.
CURVE_BLOCKS = 200


def cutoff_curve(scored: DataFrame, by: str = "fold", blocks: int = CURVE_BLOCKS) -> DataFrame:
    """(by, cutoff, tp, fp, p, n, sensitivity, specificity) at every distinct score, taken as coding from it on.

    `scored` has `by`, score and truth (1 coding, 0 not); rows with a null in either are left out.
    Quantiles of the distinct scores cut them into blocks of like size; sums run within a block
    and start from the sum of those above, so no fold is sorted whole. The quantiles being
    approximate changes the blocks' sizes alone.
    """
    counts = scored.where("score is not null and truth is not null").groupBy(by, F.col("score").alias("cutoff")).agg(F.count_if(F.col("truth") == 1).alias("c1"), F.count_if(F.col("truth") == 0).alias("c0"))
    edges = counts.agg(F.array_distinct(F.approx_percentile("cutoff", F.array(*[F.lit(i / blocks) for i in range(1, blocks)]), F.lit(blocks * 10)))).scalar()
    parted = counts.withColumn("edges", edges).withColumn("block", F.size(F.filter("edges", lambda e: e <= F.col("cutoff")))).drop("edges")
    sums = parted.groupBy(by, "block").agg(F.sum("c1").alias("b1"), F.sum("c0").alias("b0"))
    above, whole = Window.partitionBy(by).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(by)
    carried = sums.select(
        F.col(by).alias("_by"), F.col("block").alias("_block"), *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("b1", "b0")],
        F.sum("b1").over(whole).alias("p"), F.sum("b0").over(whole).alias("n"),
    )
    up = Window.partitionBy(by, "block").orderBy(F.desc("cutoff")).rowsBetween(Window.unboundedPreceding, 0)
    within = parted.select(by, "block", "cutoff", F.sum("c1").over(up).alias("i1"), F.sum("c0").over(up).alias("i0"))
    curve = within.join(carried, within[by].eqNullSafe(carried["_by"]) & (within["block"] == carried["_block"])).select(
        within[by], "cutoff", (F.col("i1") + F.col("b1_above")).alias("tp"), (F.col("i0") + F.col("b0_above")).alias("fp"), "p", "n"
    )
    return curve.withColumn("sensitivity", F.try_divide("tp", "p")).withColumn("specificity", 1 - F.try_divide("fp", "n"))


def balanced_cutoffs(curve: DataFrame, by: str = "fold") -> DataFrame:
    """(by, cutoff): where sensitivity and specificity differ least, the highest score on ties."""
    off = F.abs(F.col("sensitivity") - F.col("specificity"))
    return curve.groupBy(by).agg(F.min_by("cutoff", F.struct(F.round(off, 12), -F.col("cutoff"))).alias("cutoff"))


def two_cutoffs(curve: DataFrame, specificity: float, sensitivity: float, by: str = "fold") -> DataFrame:
    """One row (coding_cutoff, noncoding_cutoff): means over folds of the least cutoff with the
    wanted specificity and the greatest with the wanted sensitivity; the balanced cutoff for
    both if they come in the wrong order."""
    folds = curve.groupBy(by).agg(F.min(F.when(F.col("specificity") >= specificity, F.col("cutoff"))).alias("m"), F.max(F.when(F.col("sensitivity") >= sensitivity, F.col("cutoff"))).alias("l"))
    means = folds.join(balanced_cutoffs(curve, by), by).agg(F.avg("m").alias("m"), F.avg("l").alias("l"), F.avg("cutoff").alias("b"))
    ordered = F.col("m") > F.col("l")
    return means.select(F.when(ordered, F.col("m")).otherwise(F.col("b")).alias("coding_cutoff"), F.when(ordered, F.col("l")).otherwise(F.col("b")).alias("noncoding_cutoff"))


def labelled(scored: DataFrame, coding: Column | float, noncoding: Column | float | None = None) -> DataFrame:
    """`scored` with label: 1 from the coding cutoff on, 0 below the other one, -1 between; null without a score."""
    coding = coding if isinstance(coding, Column) else F.lit(coding)
    noncoding = coding if noncoding is None else noncoding if isinstance(noncoding, Column) else F.lit(noncoding)
    return scored.withColumn("label", F.when(F.col("score") >= coding, 1).when(F.col("score") < noncoding, 0).when(F.col("score").isNotNull(), -1))


def confusion(df: DataFrame, by: list[str]) -> DataFrame:
    """tp, tn, fp, fn and sen, spe, pre, acc, f1, mcc per `by`, of truth and label (0 or 1; others are passed over)."""
    t, p = F.col("truth") == 1, F.col("label") == 1
    used = df.where(F.col("truth").isin(0, 1) & F.col("label").isin(0, 1))
    counts = used.groupBy(*by).agg(F.count_if(t & p).alias("tp"), F.count_if(~t & ~p).alias("tn"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"))
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    ratio = lambda a, b: F.round(F.try_divide(a, b), 6)
    return counts.select(
        *by, "tp", "tn", "fp", "fn",
        ratio(tp, tp + fn).alias("sen"), ratio(tn, tn + fp).alias("spe"), ratio(tp, tp + fp).alias("pre"), ratio(tp + tn, tp + tn + fp + fn).alias("acc"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"),
    )


#: The classes that labels route to.
ROUTES = {0: "lncRNA", 1: "mRNA", -1: "TUCp"}


def routed(rows: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """`rows` with class: that of their label, noORF without one. `labels` has `name` and label, once a name."""
    c = F.lit("noORF")
    for k, v in ROUTES.items():
        c = F.when(F.col("label") == k, v).otherwise(c)
    return rows.join(labels.select(name, "label"), name, "left").withColumn("class", c).drop("label")


#: The number of trees of a forest, and how many of Spark's own forests are grown at a time.
TREES, AT_A_TIME = 500, 4


def fitted_forest(train: DataFrame, features: list[str], label: str, trees: int = TREES, seed: int = 1):
    """A random forest for label 1 against 0. Both weigh the same, however many rows they have;
    rows with a null feature or another label aren't used. Beyond `forest.MATRIX_ROWS` rows it is
    one of Spark's, whose rows stay where they are."""
    usable = shared_checkpoint(train.where(F.col(label).isin(0, 1)).dropna(subset=features).select(*features, label))
    if usable.count() > forest.MATRIX_ROWS:
        return _spark_forest(usable, features, label, trees, seed)
    return forest.forests(usable, features, label, trees, seed)[0]


def _spark_forest(usable: DataFrame, features: list[str], label: str, trees: int, seed: int):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    assembled = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="skip")
    rows = usable.select(*features, F.col(label).cast("double").alias("_label"))
    sizes = rows.groupBy("_label").count()
    weighted = assembled.transform(rows.join(F.broadcast(sizes), "_label").withColumn("_weight", 1 / F.col("count")))
    return RandomForestClassifier(featuresCol="_features", labelCol="_label", weightCol="_weight", numTrees=trees, maxDepth=forest.DEPTH, featureSubsetStrategy="sqrt", seed=seed).fit(weighted)


def forest_scores(model, test: DataFrame, features: list[str]) -> DataFrame:
    """`test` with score: the probability of label 1 by a `fitted_forest`, null for rows with a null feature."""
    if isinstance(model, forest.Forest):
        return test.withColumn("score", forest.scored(test, features, {0: model}))
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep").transform(test))
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull()
    return scored.withColumn("score", F.when(whole, vector_to_array("probability")[1])).drop("_features", "rawPrediction", "probability", "prediction")


def forest_predictions(train: DataFrame, test: DataFrame, features: list[str], label: str, trees: int = TREES, seed: int = 1) -> DataFrame:
    """`test` with score: the probability of label 1 by a random forest on `train` (see `fitted_forest`).

    Rows with a null feature have a null score.
    """
    return forest_scores(fitted_forest(train, features, label, trees, seed), test, features)


def cross_validated(df: DataFrame, name: str, features: list[str], label: str, n_folds: int = 10, trees: int = TREES, seed: int = 1) -> DataFrame:
    """`df` with fold and score, each row scored by a forest on the other folds.

    The forests are grown when this is called, all in one job, over folds written once; beyond
    `forest.MATRIX_ROWS` rows some of Spark's at a time.

    With `cutoff_curve`, `balanced_cutoffs` and `confusion` this gives the cutoff and the
    metrics of each fold. Rows with a null feature have a null score. If the other folds lack
    one of the labels the fold's scores are null.
    """
    folded = shared_checkpoint(cv_folds(df, name, n_folds, seed))
    usable = folded.dropna(subset=features).where(F.col(label).isin(0, 1))
    held = {(r.fold, r[label]): r["count"] for r in usable.groupBy("fold", label).count().collect()}  # two rows a fold
    totals = [sum(n for (_, t), n in held.items() if t == side) for side in (0, 1)]
    known = [fold for fold in range(1, n_folds + 1) if all(totals[side] > held.get((fold, side), 0) for side in (0, 1))]
    if sum(totals) <= forest.MATRIX_ROWS:
        grown = forest.forests(usable, features, label, trees, seed, "fold", known) if known else []
        return folded.withColumn("score", forest.scored(folded, features, dict(zip(known, grown, strict=True)), "fold"))

    def scored(fold: int) -> DataFrame:
        rest, mine = usable.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        return forest_scores(_spark_forest(rest, features, label, trees, seed), mine, features) if fold in known else mine.withColumn("score", F.lit(None).cast("double"))

    with ThreadPoolExecutor(AT_A_TIME) as pool:
        return reduce(DataFrame.unionByName, pool.map(scored, range(1, n_folds + 1)))


#: The columns of `confusion`.
METRICS = ["tp", "tn", "fp", "fn", "sen", "spe", "pre", "acc", "f1", "mcc"]


def with_mean(metrics: DataFrame, by: str = "fold") -> DataFrame:
    """`metrics` with `by` as text and a last row `mean` of all columns over the others."""
    rest = [c for c in metrics.columns if c != by]
    rows = metrics.select(F.col(by).cast("string").alias(by), *[F.col(c).cast("double").alias(c) for c in rest])
    return rows.unionByName(rows.agg(F.lit("mean").alias(by), *[F.round(F.avg(c), 6).alias(c) for c in rest]))


def label_summary(labels: DataFrame, coding: Column | float, noncoding: Column | float | None = None) -> DataFrame:
    """One row: the cutoffs, and how many rows of `labels` are lncRNA, mRNA, between (TUCp) and without a label."""
    as_column = lambda c: c if isinstance(c, Column) else F.lit(c)
    counts = [F.count_if(F.col("label") == k).alias(f"n_{v.lower()}") for k, v in ROUTES.items()]
    return labels.agg(*counts, F.count_if(F.col("label").isNull()).alias("n_unlabelled")).select(as_column(coding).alias("coding_cutoff"), as_column(coding if noncoding is None else noncoding).alias("noncoding_cutoff"), "*")


def capped(df: DataFrame, name: str, most: int | None = None, least: int = 100, seed: int = 1) -> DataFrame:
    """The first `most` rows of `df` in an order of hashes; all rows without `most`.

    Fewer than `least` rows are an error, as no model can be learnt from them; they are counted
    when this is called.
    """
    n = df.count()
    if n < least:
        raise ValueError(f"{n} sequences to learn from, {least} are needed")
    return df if most is None or n <= most else df.orderBy(hash_order(F.col(name), seed), name).limit(most)


def feature_importances(train: DataFrame, features: list[str], label: str, trees: int = TREES, seed: int = 1, model=None) -> DataFrame:
    """(feature, importance) in a forest on `train`, or in `model` if it is there already; importances sum to 1."""
    model = fitted_forest(train, features, label, trees, seed) if model is None else model
    found = model.importances() if isinstance(model, forest.Forest) else model.featureImportances.toArray()
    return train.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(features, found, strict=True)], "feature string, importance double")
