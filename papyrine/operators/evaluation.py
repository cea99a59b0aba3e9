"""Classifiers over text and the measures of their predictions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.functions.text import preview
from papyrine.operators.labels import attach_labels
from papyrine.operators.sampling import head_percent
from papyrine.operators.sizing import frequent_from
from papyrine.session import stage, store


def argmax(scores: Column) -> Column:
    """0-based place of the highest score, the first of several."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("bigint")


def classification_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: rows, accuracy, micro precision, recall and F1 (all equal for one label per
    row) and the multiclass Matthews correlation, 0 where it is not defined.

    Everything comes from the counts per (label, prediction).
    """
    cells = df.groupBy(F.col(label).alias("t"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("t").eqNullSafe(F.col("p")), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("t").alias("k"), F.col("n").alias("t_k"), none.alias("p_k"), hit.alias("hits")),
        F.struct(F.col("p").alias("k"), none.alias("t_k"), F.col("n").alias("p_k"), none.alias("hits")),
    )
    classes = (
        cells.select(F.inline(sides))
        .groupBy("k")
        .agg(*[F.sum(c).cast("double").alias(c) for c in ("t_k", "p_k", "hits")])
    )
    sums = classes.agg(
        F.sum("t_k").alias("s"),
        F.sum("hits").alias("c"),
        F.sum(F.col("t_k") * F.col("p_k")).alias("tp"),
        F.sum(F.col("t_k") * F.col("t_k")).alias("tt"),
        F.sum(F.col("p_k") * F.col("p_k")).alias("pp"),
    )
    s, c = F.col("s"), F.col("c")
    below = F.sqrt((s * s - F.col("pp")) * (s * s - F.col("tt")))
    accuracy = c / s
    return sums.select(
        s.cast("bigint").alias("rows"),
        accuracy.alias("accuracy"),
        accuracy.alias("precision"),
        accuracy.alias("recall"),
        accuracy.alias("f1"),
        F.when(below == 0, 0.0).otherwise((c * s - F.col("tp")) / below).alias("matthews_correlation"),
    )


def prediction_listing(
    df: DataFrame, names: DataFrame, id_col: str, text: str, label: str, pred: str, n: int = 100
) -> DataFrame:
    """The first ``n`` predictions with a preview of the text and the names of both labels.
    ``names``: index, display_name."""
    first = df.orderBy(id_col).limit(n)
    for column, name in ((label, "label_name"), (pred, "pred_name")):
        first = attach_labels(first, names, {column: "index"}, {"display_name": name})
    return first.select(id_col, preview(F.col(text)).alias("text_start"), label, "label_name", pred, "pred_name")


def train_text_classifier(
    train: DataFrame, text: str, label: str, algorithm: str = "bayes", features: int = 1 << 14
) -> PipelineModel:
    """Words, stop words out, hashed counts, idf, then naive Bayes or logistic regression."""
    estimators = {
        "bayes": NaiveBayes(labelCol=label, featuresCol="_features"),
        "logistic": LogisticRegression(labelCol=label, featuresCol="_features", maxIter=20, regParam=0.01),
    }
    if algorithm not in estimators:
        raise ValueError(f"unknown algorithm {algorithm!r}")
    counting = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"(?U)\w{2,}", gaps=False),
        StopWordsRemover(inputCol="_words", outputCol="_terms"),
        HashingTF(inputCol="_terms", outputCol="_counts", numFeatures=features),
    ]
    # Both fits read the stored counts, so that texts are cut into words once.
    counts = stage(PipelineModel(counting).transform(train).select(label, "_counts"))
    idf = IDF(inputCol="_counts", outputCol="_features").fit(counts)
    return PipelineModel([*counting, idf, estimators[algorithm].fit(idf.transform(counts))])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``scores`` (one per class) and ``pred``."""
    scored = model.transform(df).withColumn("scores", vector_to_array("probability"))
    kept = [*df.columns, "scores"]
    return scored.select(*kept).withColumn("pred", argmax(F.col("scores")))


def term_counts(df: DataFrame, id_col: str, terms: Column, keep: list[str]) -> DataFrame:
    """``id, *keep, term, tf``: how often each term occurs in each row."""
    return df.select(id_col, *keep, F.explode(terms).alias("term")).groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_counts(train: DataFrame, id_col: str, terms: Column, label: str) -> tuple[DataFrame, DataFrame]:
    """A multinomial naive Bayes classifier as two tables: its classes and its terms.

    classes: label, base (log share of the rows), norm (log of the class's terms plus the vocabulary). terms: term, with one
    (label, log of one more than its count) for each class that has it, and its count in all. So a term c times in a class with n terms weighs
    log((c + 1) / (n + v)), v the distinct terms of all classes. Rows without a term count for their class.
    """
    counts = stage(train.select(label, F.explode(terms).alias("term")).groupBy("term", label).agg(F.count(F.lit(1)).alias("c")))
    vocabulary = counts.agg(F.count_distinct("term")).first()[0]
    rows = stage(train.groupBy(label).agg(F.count(F.lit(1)).alias("rows")))
    all_rows = rows.agg(F.sum("rows")).first()[0]
    sizes = counts.groupBy(label).agg(F.sum("c").alias("n"))
    norm = F.log(F.coalesce("n", F.lit(0)) + F.lit(float(max(vocabulary, 1))))
    classes = rows.join(sizes, label, "left").select(label, F.log(F.col("rows") / F.lit(all_rows)).alias("base"), norm.alias("norm"))
    of_class = F.struct(F.col(label).alias("label"), F.log(F.col("c") + 1.0).alias("w"))
    return stage(classes), stage(counts.groupBy("term").agg(F.collect_list(of_class).alias("weights"), F.sum("c").alias("c")))


def predict_counts(df: DataFrame, id_col: str, terms: Column, label: str, model: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``id, label, pred`` for every row with a unique id: the most likely class, of equally likely ones the smallest.

    Terms that training did not have say nothing. Scores are compared rounded to nine digits. A row without a known term gets
    the most frequent class. The classes are one value. Rows move once, by id, and their terms are counted where they are.
    The weights of frequent terms, which are most of a text, are broadcast; of the others only the terms are shuffled.
    """
    classes, weights = model
    found = store(term_counts(df.repartition(id_col), id_col, terms, []), "terms")
    often = frequent_from(weights, "c", "term", 24 * F.size("weights"))
    common = F.broadcast(weights.filter(F.col("c") >= often).drop("c"))
    rare = found.join(common.select("term"), "term", "left_anti").join(weights.filter(F.col("c") < often).drop("c"), "term")
    # No label: the known terms of the row themselves.
    every = F.array(F.struct(F.lit(None).alias("label"), F.lit(1.0).alias("w")))
    summed = None
    for known in (found.join(common, "term"), rare):
        some = known.select(id_col, "tf", F.inline(F.concat("weights", every)))
        some = some.groupBy(id_col, "label").agg(F.sum(F.col("tf") * F.col("w")).alias("s"))
        summed = some if summed is None else summed.unionByName(some)
    summed = summed.groupBy(id_col, "label").agg(F.sum("s").alias("s"))
    labelled = F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "s")))
    tokens = F.max(F.when(F.col("label").isNull(), F.col("s"))).cast("bigint")
    own = summed.groupBy(id_col).agg(F.map_from_entries(labelled).alias("sums"), tokens.alias("n"))
    all_classes = classes.agg(F.collect_list(F.struct(F.col(label).alias("label"), "base", "norm")).alias("classes"))
    joined = df.select(id_col, label).join(own, id_col, "left").withColumn("classes", all_classes.scalar())
    scores = F.transform(
        "classes",
        lambda k: F.struct(
            (-F.round(k["base"] + F.coalesce(F.try_element_at("sums", k["label"]), F.lit(0.0)) - F.coalesce("n", F.lit(0)) * k["norm"], 9)).alias("cost"),
            k["label"].alias("label"),
        ),
    )
    return joined.select(id_col, label, F.array_min(scores)["label"].alias("pred"))


def evaluate_counts(split: DataFrame, id_col: str, terms: Column, label: str, percent: float = 100) -> DataFrame:
    """Fit on ``train``, predict ``test`` (the first ``percent`` % of each), and measure."""
    rows = split.filter(F.col(label).isNotNull())
    parts = {s: head_percent(rows.filter(F.col("subset") == s), id_col, percent) for s in ("train", "test")}
    model = fit_counts(parts["train"], id_col, terms, label)
    return classification_metrics(predict_counts(parts["test"], id_col, terms, label, model), label, "pred")


def evaluate_classifier(
    split: DataFrame, id_col: str, text: str, label: str, percent: float = 100, algorithm: str = "bayes"
) -> DataFrame:
    """Train on ``train``, predict ``test`` (``percent`` % of each), and measure."""
    rows = split.select(id_col, F.col(text).alias("text"), F.col(label).cast("double").alias("label"), "subset").dropna()
    parts = {s: head_percent(rows.filter(F.col("subset") == s), id_col, percent) for s in ("train", "test")}
    model = train_text_classifier(parts["train"], "text", "label", algorithm)
    predicted = predict(model, parts["test"]).withColumn("label", F.col("label").cast("bigint"))
    return classification_metrics(predicted, "label", "pred")
