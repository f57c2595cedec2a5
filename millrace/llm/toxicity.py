"""Toxicity by classifier chains.

Categories are predicted one after another by logistic models; each later model sees the
probabilities of the earlier categories beside the words. For training, those probabilities come
from models that have not seen the document (out of fold), neither to be fitted nor to choose their features, so a
later model learns how good they are on new documents. Features are a document's different words and their
beginnings, which carry a stem through its endings.

The models are fitted on at most ``TRAIN_ROWS`` labelled documents, chosen by a hash of the id, with at
most ``VOCABULARY`` features for each category; every document is scored, on its whole text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

TRAIN_ROWS = 20_000
VOCABULARY = 4096
CHI_SQUARE = 25.0
LEAST_DOCS = 3  # training documents in which a feature must occur
FOLDS = 3
PARTITIONS = 4  # of the sample, which ``rows`` bounds; so few that the sums of an iteration are one stage
AT_ONCE = 2  # fits that run side by side
BEGINNINGS = (4, 5)  # letters


def features(text: Column) -> Column:
    """The different words of a text in lower case, and the beginnings of the longer ones."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    parts = [words]
    for n in BEGINNINGS:
        long = F.filter(words, lambda w, n=n: F.length(w) > n)
        parts.append(F.transform(long, lambda w, n=n: F.concat(F.lit("^"), F.substring(w, 1, n))))
    return F.concat(*parts)


@dataclass
class Share:
    """Training documents of a fold: how many, and how many are of each category."""

    n: float
    of: tuple[float, ...]


def _shares(sample: DataFrame, categories: tuple[str, ...]) -> list[Share]:
    rows = sample.groupBy("__fold").agg(F.count("*"), *[F.sum(c) for c in categories]).collect()
    found = {row[0]: Share(row[1], tuple(row[2:])) for row in rows}
    return [found.get(fold, Share(0, (0.0,) * len(categories))) for fold in range(FOLDS)]


def _without(shares: list[Share], fold: int | None) -> Share:
    left = [s for k, s in enumerate(shares) if k != fold]
    return Share(sum(s.n for s in left), tuple(map(sum, zip(*(s.of for s in left), strict=True))))


def telling(sample: DataFrame, categories: tuple[str, ...], shares: list[Share]) -> dict[int | None, list[str]]:
    """The features that tell some category apart, on all folds (None) and on all folds but each one.

    ``VOCABULARY`` per category at most, those with the highest chi-square of at least ``CHI_SQUARE``,
    which chance gives to one feature in a million. Features are counted once, by fold.
    """
    numbers = range(len(categories))
    here = {k: (F.col("__fold") == k).cast("double") for k in range(FOLDS)}
    counts = [F.sum(here[k]).alias(f"n{k}") for k in here]
    counts += [F.sum(here[k] * F.col(c)).alias(f"s{k}_{i}") for k in here for i, c in enumerate(categories)]
    table = sample.select(F.explode("__features").alias("f"), "__fold", *categories).groupBy("f").agg(*counts)
    scored = []
    for fold in (None, *range(FOLDS)):
        all_of = _without(shares, fold)
        kept = [k for k in here if k != fold]
        there = sum((F.col(f"n{k}") for k in kept), F.lit(0.0))
        for i in numbers:
            n, total = all_of.n, all_of.of[i]
            if 0 < total < n:
                # Of the table feature x category: n (ad - bc)^2 / (products of the margins).
                off = sum((F.col(f"s{k}_{i}") for k in kept), F.lit(0.0)) * n - there * total
                score = F.when((there >= LEAST_DOCS) & (there < n), off * off * n / (there * (n - there) * total * (n - total)))
                scored.append(F.struct(F.lit(-1 if fold is None else fold).alias("fold"), F.lit(i).alias("i"), score.alias("s")))
    chosen: dict[int | None, dict[str, None]] = {fold: {} for fold in (None, *range(FOLDS))}
    if scored:
        rows = table.select("f", F.inline(F.array(*scored))).where(F.col("s") >= CHI_SQUARE)
        best = Window.partitionBy("fold", "i").orderBy(F.desc("s"), "f")
        rows = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= VOCABULARY)
        for row in sorted(rows.collect(), key=lambda r: (r.fold, r.i, r["rank"])):
            chosen[None if row.fold < 0 else row.fold][row.f] = None
    return {fold: list(names) for fold, names in chosen.items()}


@dataclass
class Link:
    """One category of the chain: a model, or a constant where the sample holds one class only or nothing tells it apart."""

    category: str
    model: LogisticRegressionModel | None
    constant: float
    earlier: tuple[str, ...]

    def score(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, which has ``__vector``, and the probability under ``name``."""
        if self.model is None:
            return df.withColumn(name, F.lit(self.constant))
        joined = _assembled(df, self.earlier)
        out = self.model.setProbabilityCol("__probability").transform(joined)
        return out.select(*df.columns, vector_to_array("__probability")[1].alias(name))


@dataclass
class Chain:
    vocabulary: CountVectorizerModel | None
    links: list[Link]


def _assembled(df: DataFrame, earlier: tuple[str, ...]) -> DataFrame:
    return VectorAssembler(inputCols=["__vector", *earlier], outputCol="__input").transform(df)


def _vocabulary(told: list[str]) -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary(told, "__features", "__vector").setBinary(True)


def _fit(sample: DataFrame, told: list[str], category: str, constant: float, earlier: tuple[str, ...]) -> Link:
    if constant in (0.0, 1.0) or not told:
        return Link(category, None, constant, earlier)
    model = LogisticRegression(
        featuresCol="__input", labelCol="__label", rawPredictionCol="__raw", predictionCol="__prediction",
        regParam=1e-4, maxIter=40,
    )
    labelled = _assembled(_vocabulary(told).transform(sample), earlier).select("__input", F.col(category).alias("__label"))
    return Link(category, model.fit(labelled), constant, earlier)


def _together(session: SparkSession, tasks: list[Callable]) -> list:
    """Results of fits that do not need each other, ``AT_ONCE`` side by side: each is many short jobs."""
    with ThreadPool(min(AT_ONCE, len(tasks))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(session)(task) for task in tasks], chunksize=1)


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], id: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> Chain:
    """Fit the chain on documents with an id and a text, and ``labels``: the id and a 0/1 column per category.

    Labels with a null, or of an unknown document, are left out; a document with several different labels, or several
    rows of one id, counts with each. Without any, each category is constant 0.
    Only ids are shuffled: the labels of ``rows`` documents, each different one once, are broadcast.
    """
    known = labels.select(F.col(id).alias("__id"), *categories).dropna().distinct()
    there = known.select("__id").distinct().join(docs.select(F.col(id).alias("__id")), "__id", "left_semi")
    chosen = written(known.join(there.orderBy(F.xxhash64("__id"), "__id").limit(rows), "__id"))
    sample = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id").select(
        "__id", *[F.col(c).cast("double").alias(c) for c in categories], features(F.col("__text")).alias("__features"),
        F.pmod(F.xxhash64("__id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("__fold"),
    )
    # In one order at every run, as sums of fractions depend on it.
    sample = sample.repartition(PARTITIONS, F.xxhash64("__id")).sortWithinPartitions("__id", *categories, F.xxhash64("__features"))
    current = written(sample)
    shares = _shares(current, categories)
    whole = _without(shares, None)
    if not whole.n:
        return Chain(None, [Link(c, None, 0.0, categories[:i]) for i, c in enumerate(categories)])
    told = telling(current, categories, shares)
    vocabulary = _vocabulary(told[None]) if told[None] else None
    links = []
    for i, category in enumerate(categories):
        earlier = tuple(f"__p{k}" for k in range(i)) if vocabulary else ()
        folds = range(FOLDS if vocabulary and i + 1 < len(categories) else 0)
        tasks = [partial(_fit, current, told[None], category, whole.of[i] / whole.n, earlier)]
        for fold in folds:
            left = _without(shares, fold)
            tasks.append(partial(_fit, current.where(F.col("__fold") != fold), told[fold], category, left.of[i] / left.n if left.n else 0.0, earlier))
        link, *rest = _together(current.sparkSession, tasks)
        links.append(link)
        if rest:
            held = []
            for fold, one in enumerate(rest):
                part = current.where(F.col("__fold") == fold)
                part = _vocabulary(told[fold]).transform(part) if one.model else part
                held.append(one.score(part, f"__p{i}").drop("__vector"))
            current = written(reduce(DataFrame.union, held))
    return Chain(vocabulary, links)


def score(docs: DataFrame, chain: Chain, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the probability of each category, ``p_<category>``, for every row."""
    df = docs.select(F.col(id).cast("bigint").alias("doc_id"), features(F.col(text)).alias("__features"))
    if chain.vocabulary is not None:
        df = chain.vocabulary.transform(df)
    df = df.drop("__features")
    for i, link in enumerate(chain.links):
        df = link.score(df, f"__p{i}")
    return df.select("doc_id", *[F.col(f"__p{i}").alias(f"p_{link.category}") for i, link in enumerate(chain.links)])


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, p_junk, p_toxic, toxic`` of every row of the documents, learnt from ``labels``.

    The labelled categories are ``junk`` (quality 0), then ``toxic``. Probabilities have four digits.
    A null text has no words. Labels of unknown documents, and null ones, are left out; without
    labels nothing is toxic. Rows that repeat an id are scored each.
    """
    known = labels.select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    chain = fit(docs, known, ("junk", "toxic"))
    scored = score(docs, chain)
    return scored.select(
        "doc_id", F.round("p_junk", 4).alias("p_junk"), F.round("p_toxic", 4).alias("p_toxic"), (F.col("p_toxic") >= 0.5).alias("toxic")
    )
