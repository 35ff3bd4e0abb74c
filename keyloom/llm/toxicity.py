"""Toxicity by a classifier chain.

Categories are predicted in turn. The first linear model sees the words of a text (each once, of a vocabulary); every
later one also sees the probabilities that the earlier ones gave. While training, those probabilities are
out-of-fold: each labelled row gets them from models that did not see it, so a later model learns how far
an earlier one can be trusted on unseen text. The thresholds come from out-of-fold probabilities, too.

Training uses at most about ``MAX_LABELLED`` labelled rows, chosen by a hash of the id; scoring reads every
document whole. A category without both kinds of rows predicts its rate. Null and empty texts have no words;
they are never rejected. Unlabelled and repeated labels: null labels are left out, of several the larger counts.
Columns of the input are kept, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.common import free_name, quoted, written
from keyloom.session import shuffle_width

MAX_LABELLED = 20_000
FOLDS, ITERATIONS = 3, 20
#: Tasks of a training step; the sample is bounded.
TRAIN_PARTS = 3
#: At most so many words are features; a word counts from so many texts of the sample.
FEATURES, LEAST_TEXTS = 2048, 4
#: Beginnings of words that are features beside the words.
STEMS = (4, 5)
#: The chain: a category and what it is in the label table.
CHAIN = (("poor", "1 - quality"), ("toxic", "toxic"))


WORD = re.compile(r"[^\W_]+")
#: The same for ASCII texts: every other byte becomes a blank.
ASCII_WORDS = bytes(c if chr(c).isascii() and chr(c).isalnum() else 32 for c in range(256))
#: Texts from so many characters on give their words piece by piece, without a list of all.
LONG = 1 << 20


def whole_words(text: str | None) -> set[str]:
    """Different lower-case words (runs of letters and digits)."""
    low = (text or "").lower()
    if len(low) >= LONG:
        return {m.group() for m in WORD.finditer(low)}
    if low.isascii():
        return set(low.encode("ascii").translate(ASCII_WORDS).decode("ascii").split())
    return set(WORD.findall(low))


def stems(words: set[str], n: int) -> set[str]:
    """The beginnings that stand for the inflections of words."""
    return {w[:n] + "-" for w in words if len(w) > n}


def spoken_words(rows: DataFrame, text: str, flags: Sequence[str]) -> DataFrame:
    """(word, n, flags): the number of texts with a word, and of those in each category."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sums: dict[str, list[float]] = {}
            for said, *values in frame.itertuples(index=False, name=None):
                whole = whole_words(said)
                for word in whole.union(*[stems(whole, n) for n in STEMS]):
                    have = sums.setdefault(word, [0.0] * (1 + len(values)))
                    have[0] += 1
                    for i, value in enumerate(values, 1):
                        have[i] += value
            yield pd.DataFrame([(w, *have) for w, have in sums.items()], columns=["word", "n", *flags])

    names = ", ".join(f"`{f}` double" for f in ("n", *flags))
    parts = rows.select(text, *[F.col(f).cast("double") for f in flags]).mapInPandas(run, f"word string, {names}")
    return parts.groupBy("word").agg(*[F.sum(f).alias(f) for f in ("n", *flags)])


def vocabulary(rows: DataFrame, text: str, flags: Sequence[str]) -> CountVectorizerModel:
    """The words that stand out in a category: more, or less, of its texts have them than chance explains."""
    counted = rows.agg(F.count("*").alias("n"), *[F.sum(f).alias(f) for f in flags]).first()
    n = max(1, counted["n"])
    spoken = written(spoken_words(rows, text, flags).filter(F.col("n") >= LEAST_TEXTS), "spoken")
    level = math.sqrt(2 * math.log(max(2, spoken.count())))  # what the best of so many unrelated words reaches
    scores = []
    for f in flags:
        share = (counted[f] or 0) / n
        expected = F.col("n") * share
        spread = F.sqrt(expected * (1 - share) * (1 - F.col("n") / (n + 1)))
        scores.append(F.when(spread > 0, F.abs(F.col(f) - expected) / spread).otherwise(0.0))
    found = spoken.withColumn("z", F.greatest(*scores, F.lit(0.0))).filter(F.col("z") > level).orderBy(F.desc("z"), "word").limit(FEATURES)
    chosen = [r["word"] for r in found.collect()] or [" "]  # at most FEATURES words
    return CountVectorizerModel.from_vocabulary(chosen, inputCol="_tokens", outputCol="_counts").setBinary(True)


def known_words(vocabulary: Sequence[str], text: Column) -> Column:
    """The words of a text that are in the vocabulary."""
    known = frozenset(vocabulary)

    def among_known(text: str | None) -> list[str]:
        whole = whole_words(text)
        return sorted((whole & known).union(*[stems(whole, n) & known for n in STEMS]))

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([among_known(t) for t in texts], index=texts.index, dtype=object)

    return run(text)


def with_words(df: DataFrame, known: CountVectorizerModel, text: str, output: str) -> DataFrame:
    tokens = free_name(df, "_tokens")
    counting = known.copy().setInputCol(tokens).setOutputCol(output)
    return counting.transform(df.withColumn(tokens, known_words(known.vocabulary, quoted(text)))).drop(tokens)


@dataclass
class Link:
    """One category's model: a linear one, or a rate where there was nothing to learn."""

    name: str
    model: LogisticRegressionModel | None
    rate: float
    threshold: float = 0.5

    def probability(self, df: DataFrame, inputs: Sequence[str], output: str) -> DataFrame:
        if self.model is None:
            return df.withColumn(output, F.lit(self.rate))
        joined, vector = free_name(df, "_inputs"), free_name(df, "_probability")
        df = VectorAssembler(inputCols=list(inputs), outputCol=joined, handleInvalid="keep").transform(df)
        model = self.model.copy().setFeaturesCol(joined).setProbabilityCol(vector).setRawPredictionCol("").setPredictionCol("")
        return model.transform(df).withColumn(output, vector_to_array(vector)[1]).drop(joined, vector)


@dataclass
class Chain:
    """Fitted links in their order, and the words they know."""

    known: CountVectorizerModel
    links: list[Link] = field(default_factory=list)

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with a struct as the last column: the probability of each category, in the chain's order."""
        base = free_name(docs, "_words")
        df, inputs = with_words(docs, self.known, text, base), [base]
        for link in self.links:
            output = free_name(df, f"_p_{link.name}")
            df = link.probability(df, inputs, output)
            inputs.append(output)
        found = F.struct(*[F.col(c).alias(k.name) for c, k in zip(inputs[1:], self.links, strict=True)])
        return df.select(*map(quoted, docs.columns), found.alias(free_name(docs, "toxicity")))

    def rejects(self, scored: DataFrame, category: str = "toxic", text: str = "text") -> Column:
        link = next(k for k in self.links if k.name == category)
        likely = quoted(scored.columns[-1])[category] >= link.threshold
        return likely & F.coalesce(F.length(quoted(text)) > 0, F.lit(False))


def learn(df: DataFrame, name: str, inputs: Sequence[str]) -> Link:
    """A model of label ``_y`` on the inputs."""
    counts = df.agg(F.count("*").alias("n"), F.sum("_y").alias("positive")).first()
    n, positive = counts["n"], counts["positive"] or 0
    if not 0 < positive < n:
        return Link(name, None, positive / n if n else 0.0, 1.5 if positive == 0 else 0.5)
    joined = free_name(df, "_inputs")
    df = VectorAssembler(inputCols=list(inputs), outputCol=joined).transform(df).select(F.col("_y").cast("double").alias("label"), joined)
    fitted = LogisticRegression(
        featuresCol=joined, maxIter=ITERATIONS, regParam=1e-3, standardization=False
    ).fit(df)
    return Link(name, fitted, positive / n)


def best_threshold(df: DataFrame, probability: str) -> float:
    """The threshold, in hundredths, with the best F1, the middle one of equals."""
    steps = df.groupBy(F.floor(F.col(probability) * 100).alias("step")).agg(F.count("*").alias("n"), F.sum("_y").alias("positive"))
    rows = steps.collect()  # at most 101
    positives = sum(r["positive"] for r in rows)
    grid = range(5, 96)
    scores = []
    for k in grid:
        above = [r for r in rows if r["step"] >= k]
        scores.append(2 * sum(r["positive"] for r in above) / max(1, positives + sum(r["n"] for r in above)))
    equal = [k / 100 for k, s in zip(grid, scores, strict=True) if s == max(scores)]
    return equal[len(equal) // 2]


def labelled_rows(docs: DataFrame, labels: DataFrame, chain: Sequence[tuple[str, str]], limit: int) -> DataFrame:
    """A bounded, repeatable sample of labelled texts with a 0/1 column per category and a fold."""
    kept = labels.filter("doc_id is not null").groupBy("doc_id").agg(*[F.max(F.expr(e)).alias(f"_is_{n}") for n, e in chain])
    kept = kept.dropna()
    count = kept.count()
    if count > limit:
        kept = kept.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * limit / count))
    kept = kept.withColumn("_fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    kept = kept.withColumnRenamed("doc_id", "_labelled")
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))
    rows = texts.join(kept, F.col("_doc") == F.col("_labelled")).drop("_labelled")
    return rows.repartition(shuffle_width(docs.sparkSession), "_doc").dropDuplicates(["_doc"])


def fit_chain(
    docs: DataFrame, labels: DataFrame, chain: Sequence[tuple[str, str]] = CHAIN, limit: int = MAX_LABELLED
) -> Chain:
    """Train the links in turn, each on out-of-fold probabilities of those before it."""
    rows = written(labelled_rows(docs, labels, chain, limit), "labelled")
    out, inputs = Chain(vocabulary(rows, "_text", [f"_is_{n}" for n, _ in chain])), ["_words"]
    df = written(with_words(rows, out.known, "_text", "_words").drop("_text"), "features")
    df = df.coalesce(TRAIN_PARTS)
    for name, _ in chain:
        labelled = df.withColumn("_y", F.col(f"_is_{name}"))
        output = f"_p_{name}"
        # One after another: side by side, the jobs' records fill the driver's memory.
        folds = [learn(labelled.filter(F.col("_fold") != fold), name, inputs) for fold in range(FOLDS)]
        link = learn(labelled, name, inputs)
        parts = [k.probability(labelled.filter(F.col("_fold") == fold), inputs, output) for fold, k in enumerate(folds)]
        seen = written(reduce(DataFrame.unionByName, parts).coalesce(TRAIN_PARTS), "out_of_fold")
        if link.model is not None:
            link.threshold = best_threshold(seen, output)
        out.links.append(link)
        df = seen.drop("_y")
        inputs.append(output)
    return out
