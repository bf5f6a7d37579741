"""User functions and models over tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.exact import exact_parts, exact_sum, sum_of_parts
from corpusloom.functions.tokens import word_tokens
from corpusloom.operators.lookup import most_frequent
from corpusloom.operators.vocab import HEAD_ROWS, HEAD_TOKEN_BYTES
from corpusloom.session import materialize

PART_BYTES = 8 << 20        # of a batch in memory that a user function gets at a time
FAILURE_PREFIX = "GENERATION FAILED: "     # fixed value: marks a failed row


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Apply `fn` to parts of Arrow batches; it may return any number of rows.

    A part has about `part_bytes` in memory, one row at least: what `fn` makes of it, often several times its
    size, is passed on before the next part is cut.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            step = max(1, len(batch) * part_bytes // max(1, int(batch.memory_usage(deep=True).sum())))
            for at in range(0, max(1, len(batch)), step):
                yield fn(batch.iloc[at : at + step])

    return df.mapInPandas(run, schema)


def predict(
    df: DataFrame,
    load: Callable[[], Callable[[pd.Series], pd.Series]],
    column: str,
    returns: str,
    out: str = "prediction",
    drop: Sequence[str] = ("labels",),
) -> DataFrame:
    """Add a prediction column; `load` builds the model once per task.

    Label columns are dropped first, so a predictor never sees them.
    """

    @F.pandas_udf(returns)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield model(batch)

    return df.drop(*drop).withColumn(out, score(F.col(column)))


def predict_safe(df: DataFrame, load: Callable[[], Callable[[int, str], str]], key: str, step: Column) -> DataFrame:
    """Generate per row; a failing row becomes a data row and the job goes on.

    `df` has (key, prompt); the result is (key, global_step, prompt, generated_text).
    """
    schema = f"{key} bigint, global_step bigint, prompt string, generated_text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(row_key: int, prompt: str) -> str:
            try:
                return model(row_key, prompt)
            except Exception as error:  # any failure of user code is a result here
                return f"{FAILURE_PREFIX}{error}"

        for batch in batches:
            texts = [one(k, p) for k, p in zip(batch[key], batch["prompt"])]
            yield batch.assign(generated_text=texts)[[key, "global_step", "prompt", "generated_text"]]

    return df.select(key, step.cast("bigint").alias("global_step"), "prompt").mapInPandas(run, schema)


def fit_bayes(train: DataFrame, label: str, text: str = "text") -> tuple[DataFrame, list, list[float]]:
    """Multinomial naive Bayes over word tokens, for any number of classes.

    Returns (token, n, loglik) with one log likelihood per class (add-one smoothing over
    the training vocabulary) as a written table, the classes in order, and their log
    priors.  Words keep their identity; nothing is hashed.
    """
    shares = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()       # one row per class
    classes, total = [r[0] for r in shares], sum(r.n for r in shares)
    words = train.select(F.col(label).alias("_class"), F.explode(word_tokens(F.col(text))).alias("token"))
    counts = words.groupBy("token").agg(*[F.count_if(F.col("_class") == c).alias(f"_n{i}") for i, c in enumerate(classes)])
    counts = materialize(counts, "class-counts")
    sums = counts.agg(F.count(F.lit(1)), *[F.sum(f"_n{i}") for i in range(len(classes))]).first()
    logs = [F.log((F.col(f"_n{i}") + 1) / F.lit(float((sums[i + 1] or 0) + sums[0]))) for i in range(len(classes))]
    seen = sum((F.col(f"_n{i}") for i in range(len(classes))), F.lit(0).cast("bigint"))
    table = materialize(counts.select("token", seen.alias("n"), F.array(*logs).alias("loglik")), "class-words")
    return table, classes, [math.log(r.n / total) for r in shares]


def classify(
    train: DataFrame, score: DataFrame, key: str, label: str, text: str = "text", max_rows: int = HEAD_ROWS
) -> tuple[DataFrame, list]:
    """(key, logits, prediction) for every row of `score`, and the classes the logits stand for.

    Words outside the training vocabulary count for no class; a row without known words
    gets the priors.  Equal logits go to the earlier class.  The most frequent words are broadcast and summed where
    the text is read, one row per document and task; only a document's other words are shuffled.
    """
    table, classes, priors = fit_bayes(train, label, text)
    often = table.where(most_frequent(table, "n", max_rows) & (F.octet_length("token") <= HEAD_TOKEN_BYTES))
    # decimals are made once for a word of the table, not for each of its occurrences
    parts = [exact_parts(F.get("loglik", F.lit(i))) for i in range(len(classes))]
    often = often.select("token", F.lit(True).alias("_known"), *[c.alias(f"_{x}{i}") for i, both in enumerate(parts) for x, c in zip("wf", both)])
    words = score.select(key, F.explode(word_tokens(F.col(text))).alias("token")).join(F.broadcast(often), "token", "left")
    known = [F.get("loglik", F.lit(i)) for i in range(len(classes))]
    open_ = F.when(F.col("_known").isNull(), F.col("token")).alias("token")
    counted = words.withColumn("token", open_).groupBy(key, "token").agg(
        F.count(F.lit(1)).alias("_n"), *[sum_of_parts(F.col(f"_w{i}"), F.col(f"_f{i}")).alias(f"_s{i}") for i in range(len(classes))]
    )
    counted = materialize(counted, "document-words")
    rare = counted.where("token IS NOT NULL").select(key, "token", "_n").join(table.select("token", "loglik"), "token")
    rare = rare.select(key, *[(F.col("_n") * x).alias(f"_s{i}") for i, x in enumerate(known)])
    every = counted.where("token IS NULL").select(key, *[f"_s{i}" for i in range(len(classes))]).unionByName(rare)
    sums = every.groupBy(key).agg(*[exact_sum(F.col(f"_s{i}")).alias(f"_s{i}") for i in range(len(classes))])
    logits = F.array(*[F.coalesce(f"_s{i}", F.lit(0.0)) + F.lit(p) for i, p in enumerate(priors)])
    best = F.array_position("logits", F.array_max("logits"))
    scored = score.select(key).join(sums, key, "left").select(key, logits.alias("logits"))
    return scored.withColumn("prediction", F.element_at(F.array(*map(F.lit, classes)), best.cast("int"))), classes
