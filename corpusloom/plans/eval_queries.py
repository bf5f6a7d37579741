"""Registered queries over evaluation data: losses, runs, n-grams, user functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.arith import int_div
from corpusloom.operators import inference, losses, ngram, runs
from corpusloom.plans import fixtures as fx
from corpusloom.plans.token_queries import text_documents, train_vocab
from corpusloom.schemas import BATCH_SIZE
from corpusloom.session import materialize, scratch_path
from corpusloom.sources import store
from corpusloom.sources.corpora import read_table

# Parameters of the registered queries.
SMOOTHING = 0.1
TOP_K, TOP_P, TEMPERATURE = 50, 0.95, 0.7
PENALTY = 1.2
PATIENCE = 3
KEEP_BEST = 2
LOG_EVERY = 5


def _batch_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fx.logits(spark, sf_dir).withColumn("batch_id", int_div(F.col("vec_id"), BATCH_SIZE))
    rows = losses.row_losses(table, "embedding", "label", fx.LOGIT_IGNORE, ["batch_id"])
    return losses.batch_losses(rows, ["batch_id"])


def masked_xent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_losses(spark, sf_dir).withColumn("loss", F.round("loss", 6))


def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = losses.perplexity(_batch_losses(spark, sf_dir))
    return found.select("n_batches", *[F.round(c, 6).alias(c) for c in ("mean_loss", "mean_of_exp", "exp_of_mean")])


def metric_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = runs.epoch_means(fx.metrics(spark, sf_dir), "batch_rows")
    return means.withColumn("mean_value", F.round("mean_value", 6))


def _logged(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    rows = runs.every_n(fx.metrics(spark, sf_dir), "batch_idx", n)
    return rows.select("run", "epoch", "batch_idx", "step", "name", "value")


def every_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logged(spark, sf_dir, LOG_EVERY)


def every_n_epoch_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logged(spark, sf_dir, -1)


def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.early_stop(fx.checks(spark, sf_dir), PATIENCE, "min", ["run", "name"])


def best_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.best_checkpoints(fx.checks(spark, sf_dir), KEEP_BEST, "min", ["run", "name"])


def job_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.job_tally(read_table(spark, sf_dir, "events"), ["user_id"], F.col("event_type") != "error")


def _train_bigrams(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and bigram counts of the training split, the counts as a written table."""
    vocab = train_vocab(spark, sf_dir)
    train = text_documents(spark, sf_dir).where(F.col("split") == "train")
    return vocab, materialize(ngram.bigram_counts(train, vocab), "bigrams")


def bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab, bigrams = _train_bigrams(spark, sf_dir)
    p = ngram.smoothed(F.col("n"), F.col("context_n"), ngram.vocab_size(vocab), SMOOTHING)
    return ngram.with_context_totals(bigrams).select("prev", "next", "n", "context_n", F.round(p, 6).alias("p"))


def _scored_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Held-out texts, vocabulary, and the held-out pair types with their losses."""
    vocab, bigrams = _train_bigrams(spark, sf_dir)
    held_out = text_documents(spark, sf_dir).where(F.col("split") == "validation")
    return held_out, vocab, ngram.pair_types_scored(held_out, vocab, bigrams, ngram.vocab_size(vocab), SMOOTHING)


def bigram_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, scored = _scored_pairs(spark, sf_dir)
    return ngram.overall_loss(scored).select(
        "n_pairs", F.round("loss", 6).alias("loss"), F.round("perplexity", 4).alias("perplexity")
    )


def bigram_eval_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out, vocab, scored = _scored_pairs(spark, sf_dir)
    found = ngram.document_losses(held_out, ["doc_id"], vocab, materialize(scored, "pair-losses"))
    return found.select(
        "doc_id", "n_pairs", F.round("loss", 6).alias("loss"), F.round("perplexity", 3).alias("perplexity")
    )


def next_token_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bigrams = _train_bigrams(spark, sf_dir)
    kept = ngram.top_k(ngram.tempered(bigrams, TEMPERATURE), TOP_K)
    return kept.select("prev", "next", "n", F.round("p", 6).alias("p"), "next_rank")


def next_token_topp(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bigrams = _train_bigrams(spark, sf_dir)
    return ngram.top_p(bigrams, TOP_P).withColumn("p_before", F.round("p_before", 6))


def next_token_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab, bigrams = _train_bigrams(spark, sf_dir)
    prompts = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    found = ngram.greedy_next(prompts, ["conv_id", "turn"], vocab, bigrams)
    return found.select("conv_id", "turn", "prev_token", "next", "next_token")


def repetition_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "_s"))
    score = F.col("_s").cast("double")
    fixed = ngram.repetition_penalty(score, F.col("pos") % 3 == 0, PENALTY)
    return rows.select("vec_id", "pos", F.round(fixed, 6).alias("score"))


def map_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch function that returns one row per line of its documents."""

    def lines(batch: pd.DataFrame) -> pd.DataFrame:
        cut = batch.assign(line=batch["text"].str.split("\n")).explode("line")
        number = cut.groupby("doc_id").cumcount()
        return pd.DataFrame({"doc_id": cut["doc_id"], "line_no": number, "n_chars": cut["line"].str.len()})

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return inference.map_batches(docs, lines, "doc_id bigint, line_no bigint, n_chars bigint")


def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").join(read_table(spark, sf_dir, "labels"), "doc_id", "left")
    docs = docs.select("doc_id", "text", F.col("quality").alias("labels"))
    return inference.predict(docs, lambda: lambda texts: texts.str.len(), "text", "bigint").drop("text")


def _generate(docs: DataFrame, step: int) -> DataFrame:
    def load():
        def generate(doc_id: int, prompt: str) -> str:
            if doc_id % 19 == 0:
                raise ValueError(f"no output for {doc_id}")
            return f"{len(prompt)} characters"

        return generate

    return inference.predict_safe(docs, load, "doc_id", F.lit(step))


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"))


def predict_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generate(_prompts(spark, sf_dir), 0)


def generation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generations of two steps appended to one log, read back."""
    path = scratch_path(spark, "generations")
    for step in (10, 20):
        rows = _generate(_prompts(spark, sf_dir), step)
        store.append_log(rows.select("global_step", "prompt", "generated_text"), path)
    return spark.read.parquet(path)


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step metrics and epoch means appended to one log, read back."""
    path, steps = scratch_path(spark, "metric-log"), fx.metrics(spark, sf_dir)
    store.append_log(steps.select("run", "step", "name", "value"), path)
    means = runs.epoch_means(steps, "batch_rows")
    last = ((F.col("epoch") + 1) * fx.STEPS_PER_EPOCH - 1).alias("step")
    store.append_log(means.select("run", last, F.concat("name", F.lit("_epoch")).alias("name"), F.round("mean_value", 6).alias("value")), path)
    return spark.read.parquet(path)


def classify_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the labelled training documents, score every document."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = text_documents(spark, sf_dir).join(labels, "doc_id", "left")
    train = docs.where((F.col("split") == "train") & F.col("label").isNotNull())
    scored, classes = inference.classify(train, docs, "doc_id", "label")
    logits = [F.round(F.get("logits", F.lit(i)), 4).alias(f"logit_{c}") for i, c in enumerate(classes)]
    return docs.select("doc_id", "split", "label").join(scored, "doc_id").select("doc_id", "split", "label", *logits, "prediction")


QUERIES = {
    "masked_xent": masked_xent,
    "perplexity": perplexity,
    "metric_epoch": metric_epoch,
    "every_n": every_n,
    "every_n_epoch_end": every_n_epoch_end,
    "early_stop": early_stop,
    "best_checkpoints": best_checkpoints,
    "job_tally": job_tally,
    "bigram_counts": bigram_counts,
    "bigram_eval": bigram_eval,
    "bigram_eval_docs": bigram_eval_docs,
    "next_token_topk": next_token_topk,
    "next_token_topp": next_token_topp,
    "next_token_greedy": next_token_greedy,
    "repetition_penalty": repetition_penalty,
    "map_batches": map_batches,
    "batch_predict": batch_predict,
    "predict_safe": predict_safe,
    "generation_log": generation_log,
    "metric_log": metric_log,
    "classify_docs": classify_docs,
}
