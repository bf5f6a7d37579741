from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import labels as lab
from corpusloom.functions import tokens as tok
from corpusloom.operators import inference, losses, mixing, ngram, runs


def python_stop(values, patience, mode):
    best, best_step, wait = None, None, 0
    for step, v in enumerate(values):
        if best is None or (v < best if mode == "min" else v > best):
            best, best_step, wait = v, step, 0
        else:
            wait += 1
            if wait >= patience:
                return step, best_step, best
    return None, best_step, best


@pytest.mark.parametrize("mode", ["min", "max"])
@pytest.mark.parametrize("patience", [1, 3, 50])
def test_early_stop_equals_a_loop(spark, mode, patience):
    rng = random.Random(patience)
    series = {r: [rng.randrange(12) for _ in range(rng.randrange(1, 40))] for r in range(12)}
    rows = [(r, s, float(v)) for r, vs in series.items() for s, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "run bigint, step bigint, value double")
    found = {r.run: (r.stop_step, r.best_step, r.best_value) for r in runs.early_stop(df, patience, mode).collect()}
    assert found == {r: python_stop(vs, patience, mode) for r, vs in series.items()}


def test_early_stop_mode_is_checked(spark):
    with pytest.raises(ValueError):
        runs.early_stop(spark.createDataFrame([], "run int, step int, value double"), 1, "best")


def test_best_checkpoints_break_ties_by_step(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, 1.0), (1, 2, 1.0), (1, 3, 5.0)], "run int, step int, value double")
    assert sorted(r.step for r in runs.best_checkpoints(df, 2).collect()) == [1, 2]
    assert [r.step for r in runs.best_checkpoints(df, 1, "max").collect()] == [3]


def test_cross_entropy_and_ignored_rows(spark):
    logits = [[1000.0, 1001.0], [0.0, -5.0], [3.0, 3.0]]
    rows = [(0, logits[0], 1), (0, logits[1], 0), (1, logits[2], 7)]
    df = spark.createDataFrame(rows, "b int, z array<double>, y int")
    batches = losses.batch_losses(losses.row_losses(df, "z", "y", 7, ["b"]), ["b"])
    found = {r.b: (r.n_rows, r.n_scored, r.loss) for r in batches.collect()}
    mean = (math.log(1 + math.exp(-1)) + math.log(1 + math.exp(-5))) / 2
    assert found[0][:2] == (2, 2) and found[0][2] == pytest.approx(mean)
    assert found[1] == (1, 0, None)
    both = losses.perplexity(spark.createDataFrame([(1.0,), (3.0,), (None,)], "loss double")).first()
    assert both.n_batches == 2
    assert both.mean_of_exp == pytest.approx((math.e + math.e**3) / 2)
    assert both.exp_of_mean == pytest.approx(math.e**2)


def test_label_arrays(spark):
    df = spark.createDataFrame([([5, 9, 9, 1],)], "ids array<int>")
    row = df.select(
        lab.ignore_pad(F.col("ids"), 9).alias("pad"),
        lab.only_masked(F.col("ids"), 9).alias("mlm"),
        lab.only_masked(F.col("ids"), 9, F.array(*[F.lit(i) for i in (5, 6, 7, 1)])).alias("targets"),
        lab.strip_ignored(lab.ignore_pad(F.col("ids"), 9)).alias("kept"),
    ).first()
    assert row.pad == [5, -100, -100, 1] and row.mlm == [-100, 9, 9, -100]
    assert row.targets == [-100, 6, 7, -100] and row.kept == [5, 1]


def test_padding_and_bytes(spark):
    df = spark.createDataFrame([("hé\x00",), ("",)], "t string").select(tok.byte_tokens(F.col("t")).alias("ids"))
    assert [r.ids for r in df.collect()] == [[104, 195, 169, 0], []]
    out = df.select(
        tok.pad_right(F.col("ids"), 3, 256).alias("r"),
        tok.pad_left(F.col("ids"), 6, 256).alias("l"),
        tok.mask_left(F.col("ids"), 6).alias("m"),
        tok.append_eos(F.col("ids"), None).alias("same"),
        tok.decode_bytes(tok.append_eos(F.col("ids"))).alias("text"),
        tok.byte_repr(tok.append_eos(F.col("ids"))).alias("shown"),
        F.size(tok.next_token_pairs(F.col("ids"))).alias("pairs"),
    ).collect()
    assert out[0].r == [104, 195, 169] and out[1].r == [256] * 3
    assert out[0].l == [256, 256, 104, 195, 169, 0] and out[0].m == [0, 0, 1, 1, 1, 1]
    assert out[0].same == [104, 195, 169, 0] and out[0].text == "hé\x00" and out[1].text == ""
    assert out[0].shown == "h\\xC3\\xA9\\x00<eos>"
    assert [r.pairs for r in out] == [3, 0]


def test_every_n_and_epoch_end(spark):
    df = spark.createDataFrame([(1, 0, i, float(i)) for i in range(7)], "run int, epoch int, b int, value double")
    assert sorted(r.b for r in runs.every_n(df, "b", 3).collect()) == [2, 5]
    assert [r.b for r in runs.every_n(df, "b", 0).collect()] == [6]


def test_rank_plan_wraps_to_even_length(spark):
    rows = [("train", i, 1) for i in range(1)] + [("test", i, 5) for i in range(5)]
    df = spark.createDataFrame(rows, "split string, idx bigint, n_rows bigint")
    slots = mixing.rank_plan(df, 3, 2, 2).collect()
    one = sorted((r.slot, r.idx) for r in slots if r.split == "train")
    five = sorted((r.slot, r.idx) for r in slots if r.split == "test")
    assert one == [(0, 0), (1, 0), (2, 0)]
    assert five == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 0)]


def test_shuffle_is_a_permutation_that_changes_with_the_epoch(spark):
    df = spark.range(200).select(F.lit("train").alias("split"), F.col("id").alias("idx"), F.lit(200).alias("n_rows"))
    orders = []
    for epoch in (1, 1, 2):
        rows = mixing.shuffle_epoch(df, 42, epoch).collect()
        orders.append([r.idx for r in sorted(rows, key=lambda r: r.position)])
    assert orders[0] == orders[1] != orders[2]
    assert sorted(orders[0]) == sorted(orders[2]) == list(range(200))


def test_collected_batches_keep_order(spark):
    df = spark.range(10).select(F.lit("s").alias("split"), F.col("id").alias("idx"))
    batches = mixing.collect_batches(mixing.assign_batches(df, 4), ["split"], ["idx"]).collect()
    assert {r.batch_id: [m.idx for m in r.members] for r in batches} == {0: [0, 1, 2, 3], 1: [4, 5, 6, 7], 2: [8, 9]}


def test_nucleus_and_top_k(spark):
    df = spark.createDataFrame([(1, n, c) for n, c in [(10, 5), (11, 3), (12, 1), (13, 1)]], "prev int, next int, n bigint")
    assert sorted(r.next for r in ngram.top_p(df, 0.5).collect()) == [10]
    assert sorted(r.next for r in ngram.top_p(df, 0.81).collect()) == [10, 11, 12]
    assert sorted(r.next for r in ngram.top_k(df, 3).collect()) == [10, 11, 12]
    p = {r.next: r.p for r in ngram.tempered(df, 0.5).collect()}
    assert p[10] == pytest.approx(25 / 36) and sum(p.values()) == pytest.approx(1)
    assert ngram.greedy_table(df.withColumn("n", F.lit(1))).first().next == 10


def test_failures_become_rows(spark):
    def load():
        def generate(key, prompt):
            if key == 1:
                raise RuntimeError("no luck")
            return prompt.upper()

        return generate

    df = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, prompt string")
    rows = inference.predict_safe(df, load, "k", F.lit(7)).collect()
    assert {r.k: (r.global_step, r.generated_text) for r in rows} == {0: (7, "A"), 1: (7, "GENERATION FAILED: no luck")}


def test_predictor_never_sees_labels(spark):
    df = spark.createDataFrame([("abc", 1)], "text string, labels int")
    out = inference.predict(df, lambda: lambda s: s.str.len(), "text", "bigint")
    assert out.columns == ["text", "prediction"] and out.first().prediction == 3


def test_values_that_are_no_numbers(spark):
    nan, inf = float("nan"), float("inf")
    series = {
        "nan stops": ([3.0, 2.0, nan, 1.0], (2, 1, 2.0)),
        "infinite stops": ([3.0, -inf, 1.0], (1, 0, 3.0)),
        "null waits": ([3.0, None, 2.0, None, None, 5.0], (4, 2, 2.0)),
        "no number": ([None, None], (1, None, None)),
        "first is nan": ([nan, 1.0], (0, None, None)),
        "never": ([3.0, None, 2.0], (None, 2, 2.0)),
    }
    rows = [(name, i, v) for name, (values, _) in series.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "run string, step bigint, value double")
    got = {r.run: (r.stop_step, r.best_step, r.best_value) for r in runs.early_stop(df, 2).collect()}
    assert got == {name: want for name, (_, want) in series.items()}
    for mode, best in (("min", 1.0), ("max", 3.0)):
        kept = runs.best_checkpoints(df.where("run = 'nan stops'"), 1, mode).collect()
        assert [r.value for r in kept] == [best]
    assert runs.best_checkpoints(df.where("run = 'no number'"), 1).count() == 0


def test_targets_outside_the_logits_are_counted(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], y) for y in (0, 1, 2, -1, None, 9)], "b int, z array<double>, y int")
    row = losses.batch_losses(losses.row_losses(df, "z", "y", 9, ["b"]), ["b"]).first()
    assert (row.n_rows, row.n_scored, row.n_bad) == (6, 2, 3)


def test_bayes_takes_any_number_of_classes(spark):
    texts = {"a": "cat cat dog", "b": "dog bird", "c": "fish fish"}
    train = spark.createDataFrame([(c, t) for c, t in texts.items() for _ in range(3)], "label string, text string")
    asked = spark.createDataFrame([(1, "cat"), (2, "bird bird"), (3, "fish dog fish"), (4, ""), (5, None)], "k int, text string")
    found = []
    for head in (0, 2, 500_000):
        scored, classes = inference.classify(train, asked, "k", "label", max_rows=head)
        rows = {r.k: r for r in scored.collect()}
        found.append({k: (tuple(r.logits), r.prediction) for k, r in rows.items()})
    assert found[0].keys() == found[1].keys() and all(x[k][0] == pytest.approx(found[0][k][0]) for x in found for k in x)
    assert classes == ["a", "b", "c"] and [rows[k].prediction for k in (1, 2, 3, 4, 5)] == ["a", "b", "c", "a", "a"]
    assert rows[1].logits == pytest.approx([math.log(7 / 13) + math.log(1 / 3), math.log(1 / 10) + math.log(1 / 3), math.log(1 / 10) + math.log(1 / 3)])


def test_user_functions_get_bounded_parts(spark):
    from corpusloom.operators import inference

    def sizes(batch):
        return batch.assign(n=len(batch))[["id", "n"]]

    rows = spark.range(0, 64, 1, 1).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    found = inference.map_batches(rows, sizes, "id bigint, n bigint", part_bytes=10_000).collect()
    assert sorted(r.id for r in found) == list(range(64)) and max(r.n for r in found) <= 10


def test_decimals_made_before_a_lookup_give_the_same_sum(spark):
    from corpusloom.functions.exact import exact_parts, exact_sum, sum_of_parts

    rows = [(0, -7.123456789012345), (0, 1e15 + 0.25), (0, None), (1, None), (2, 0.1), (2, 0.2), (2, -0.3)]
    df = spark.createDataFrame(rows, "k int, x double")
    whole, fraction = exact_parts(F.col("x"))
    parts = df.select("k", "x", whole.alias("w"), fraction.alias("f"))
    found = parts.groupBy("k").agg(exact_sum(F.col("x")).alias("a"), sum_of_parts(F.col("w"), F.col("f")).alias("b")).collect()
    assert len(found) == 3 and all(r.a == r.b for r in found)
