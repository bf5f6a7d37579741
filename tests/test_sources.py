from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.sizes import human_size
from corpusloom.functions.text import drop_blank, first_nonblank, normalise, preview, resolve_text_column
from corpusloom.operators.manifest import classify_scan
from corpusloom.operators.ordering import integer_levels
from corpusloom.operators.slicing import head_bounds, percent_bounds, range_bounds, slice_rows
from corpusloom.plans.prepare import run_plan
from corpusloom.sources import corpora, naming, registry, store


def numbers(spark, n):
    return spark.range(n).select(F.lit("train").alias("split"), F.col("id").alias("doc_id"))


def cut(df, bounds):
    return sorted(r.doc_id for r in slice_rows(df, ["split"], ["doc_id"], integer_levels("doc_id"), bounds).collect())


def test_head_slice_keeps_at_least_one_row(spark):
    assert cut(numbers(spark, 1), lambda n: head_bounds(n, F.lit(0.001))) == [0]
    assert cut(numbers(spark, 11), lambda n: head_bounds(n, F.lit(0.1))) == [0, 1]


def test_range_slice_and_empty_range(spark):
    assert cut(numbers(spark, 10), lambda n: range_bounds(n, F.lit(0.25), F.lit(0.55))) == [2, 3, 4]
    with pytest.raises(Exception, match="empty slice: start=0, end=0"):
        cut(numbers(spark, 10), lambda n: range_bounds(n, F.lit(0.0001), F.lit(0.0005)))


@pytest.mark.parametrize("n", [3, 10, 25, 101])
def test_percent_rounds_to_nearest_row(spark, n):
    assert len(cut(numbers(spark, n), lambda c: percent_bounds(c, 50))) == round(n * 50 / 100.0)
    assert len(cut(numbers(spark, n), lambda c: percent_bounds(c, 150))) == n


def test_slice_arguments():
    assert naming.parse_slice("0.1-0.2") == (0.1, 0.2)
    assert naming.parse_slice(0.5) == (0.0, 0.5)
    assert naming.parse_slice(None) is None
    for bad in ("0.1", "1e-3-0.5", [0.2, 0.1], [0.0, 1.5], [0.1, 0.2, 0.3]):
        with pytest.raises(ValueError):
            naming.parse_slice(bad)


def test_stored_names_and_storage_keys():
    narrow, wider = (0.0001, 0.0005), (0.0002, 0.0006)
    assert naming.stored_name("a", None, "train") == "a_default_train"
    settings = {"tokenizer": naming.tokenizer_id("org/name"), "length": 128, "eos": True, "scope": "batch"}
    keys = {
        naming.storage_key("a", None, "train", narrow, settings),
        naming.storage_key("a", None, "train", wider, settings),
        naming.storage_key("a", None, "train", narrow, {**settings, "length": 64}),
    }
    assert len(keys) == 3


def test_run_plan_rejects_unknown_datasets(spark):
    with pytest.raises(KeyError, match="nothing"):
        run_plan(spark, {"nothing": {}})
    rows = {(r.dataset, r.split): (r.start, r.end) for r in run_plan(spark, {"pages": {"train_slice": 0.3}}).collect()}
    assert rows[("pages", "train")] == (0.0, 0.3) and rows[("pages", "test")] == (None, None)


def test_text_choice_and_cleaning(spark):
    df = spark.createDataFrame(
        [(1, None, " 　", "b"), (2, "", "a", "b"), (3, None, None, None)], "k int, text string, x string, y string"
    )
    assert resolve_text_column(df, "text") == "text"
    assert resolve_text_column(df, "body") == "text"
    with pytest.raises(ValueError):
        resolve_text_column(df.select("k"), "text")
    found = [r.t for r in df.orderBy("k").select(first_nonblank(df, "text").alias("t")).collect()]
    assert found == ["b", "", None]
    assert [r.t for r in df.orderBy("k").select(normalise(F.col("k")).alias("t")).collect()] == ["1", "2", "3"]
    blanks = spark.createDataFrame([("\x0b \n",), ("x ",), ("​",)], "t string")
    assert drop_blank(blanks, "t").count() == 2      # a zero-width space is not white space
    texts = spark.createDataFrame([("x" * 103,), ("x" * 104,)], "t string")
    assert sorted(len(r.p) for r in texts.select(preview(F.col("t")).alias("p")).collect()) == [103, 103]


def test_human_sizes(spark):
    shown = {
        None: "N/A", -1: "N/A", 0: "0 Bytes", 1023: "1023 Bytes", 1024: "1.0 KiB", 1280: "1.2 KiB", 1792: "1.8 KiB",
        (1 << 20) - 1: "1024.0 KiB", 1 << 20: "1.0 MiB", 123456789: "117.7 MiB", 627 * 10**9: "583.9 GiB", 15 << 40: "15.0 TiB",
        1 << 60: "1024.0 PiB",
    }
    df = spark.createDataFrame([(v,) for v in shown], "n bigint").select("n", human_size(F.col("n")).alias("s"))
    assert {r.n: r.s for r in df.collect()} == shown


def test_scan_classes(spark):
    df = spark.createDataFrame([(None,), ("ok",), ("infected",), ("pending",)], "r string")
    assert [x.c for x in df.select(classify_scan(F.col("r")).alias("c")).collect()] == ["safe", "safe", "unsafe", "unexpected"]


def test_latest_registration_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "name string, at int, source string")
    found = {r.name: (r.source, r.n_overwritten) for r in registry.latest_by_key(df, ["name"], "at").collect()}
    assert found == {"a": ("y", 1), "b": ("z", 0)}


def test_strict_checks_name_the_failures(spark):
    rows = spark.createDataFrame([("s1",), ("s2",)], "source string")
    with pytest.raises(KeyError, match="1 unregistered sources, listed in") as error:
        registry.unregistered(rows, "source", rows.where("source = 's1'"), strict=True)
    listed = spark.read.parquet(str(error.value).strip("'").rsplit(" ", 1)[1])
    assert [tuple(r) for r in listed.collect()] == [("s2", 1)]
    planned = registry.planned_splits(registry.registry_table(spark))
    present = planned.where("dataset <> 'pages'")
    with pytest.raises(RuntimeError, match="pages: test,train,validation"):
        registry.missing_splits(planned, present, strict=True)


def test_stage_names_and_empty_concat(spark, sf_dir):
    with pytest.raises(ValueError):
        corpora.select_stage(corpora.scan_corpora(spark, sf_dir), "predict")
    assert corpora.concat_frames(spark, []).count() == 0
    assert corpora.concat_frames(spark, []).columns == corpora.scan_corpora(spark, sf_dir).columns


def packed(spark):
    return spark.createDataFrame(
        [("d", "train", 0, 0, [1, 2], [1, 2], [1, 1])],
        "dataset string, split string, block_id bigint, pack_group bigint, "
        "input_ids array<int>, labels array<int>, attention_mask array<int>",
    )


def test_packed_store_round_trip_and_checks(spark, tmp_path):
    path = str(tmp_path / "store")
    store.write_packed(packed(spark), path)
    assert store.read_packed(spark, path, "train").count() == 1
    assert store.read_packed(spark, path, "test").count() == 0
    assert dict(store.as_export(store.read_packed(spark, path)).dtypes)["labels"] == "array<bigint>"
    with pytest.raises(ValueError):
        store.check_packed(packed(spark).drop("labels"))
    with pytest.raises(FileNotFoundError):
        store.read_packed(spark, str(tmp_path / "nothing"))
    bare = str(tmp_path / "bare")
    store.write_cache(packed(spark).drop("labels"), bare)
    with pytest.raises(ValueError, match="labels"):
        store.read_packed(spark, bare)


def test_failed_write_leaves_no_complete_store(spark, tmp_path):
    path = str(tmp_path / "broken")
    bad = packed(spark).withColumn("block_id", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        store.write_packed(bad, path)
    assert not store.is_complete(spark, path)


def test_logs(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([(1, "p", "t")], "global_step bigint, prompt string, generated_text string")
    store.append_log(row, path)
    store.append_log(row, path)
    assert spark.read.parquet(path).count() == 2


def test_a_second_dataset_leaves_the_first(spark, tmp_path):
    path = str(tmp_path / "cache")
    rows = spark.range(2000).select(F.lit("a").alias("dataset"), F.lit("train").alias("split"), F.col("id").alias("block_id"))
    store.write_cache(rows, path, ["block_id"])
    store.write_cache(rows.withColumn("dataset", F.lit("b")), path, ["block_id"])
    store.write_cache(rows.withColumn("dataset", F.lit("b")).limit(7), path)
    found = {r.dataset: r.n_rows for r in store.cache_counts(store.read_cache(spark, path, rows.schema)).collect()}
    assert found == {"a": 2000, "b": 7} and store.is_complete(spark, path)
    assert {r.dataset: r.n_rows for r in store.committed(spark, path).collect()} == found


def test_interleaved_writers_leave_one_whole_copy(spark, tmp_path, monkeypatch):
    """The second writer starts and ends while the first has its files written and is about to commit."""
    path = str(tmp_path / "cache")
    rows = spark.range(3000).select(F.lit("a").alias("dataset"), F.lit("train").alias("split"), F.col("id").alias("block_id"))
    plain, inside = store._data, []

    def meanwhile(*args):
        if not inside:
            inside.append(store.read_cache(spark, path, rows.schema).count() if store.is_complete(spark, path) else 0)
            store.write_cache(rows.where("block_id < 1000"), path, ["block_id"])
            inside.append(store.read_cache(spark, path, rows.schema).count())
        return plain(*args)

    monkeypatch.setattr(store, "_data", meanwhile)
    store.write_cache(rows, path, ["block_id"])
    assert inside[0] == 0 and inside[1] == 1000                 # the uncommitted copy is never seen
    got = store.read_cache(spark, path, rows.schema)
    assert got.count() == 3000 == got.distinct().count()        # the last commit counts, whole
    bad = rows.withColumn("block_id", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        store.write_cache(bad, path)
    assert store.read_cache(spark, path, rows.schema).count() == 3000


def test_blocks_by_position(spark, tmp_path):
    path = str(tmp_path / "store")
    ids = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.col("id") * 4 + i).cast("int"))
    for name, n in (("b", 300), ("a", 1000)):
        rows = spark.range(n).select(
            F.lit(name).alias("dataset"), F.lit("train").alias("split"), F.col("id").alias("block_id"), F.lit(0).cast("bigint").alias("pack_group"),
            *[ids.alias(c) for c in ("input_ids", "labels", "attention_mask")],
        )
        store.write_packed(rows.repartition(5), path)
    asked = [1299, 0, 999, 1000, 17, 0]
    found = store.blocks_at(spark, path, "train", asked, ["a", "b", "c"])
    got = sorted((r.slot, r.idx, r.dataset, r.input_ids[0] // 4) for r in found.collect())
    assert got == [(i, p, "a" if p < 1000 else "b", p if p < 1000 else p - 1000) for i, p in enumerate(asked)]
    one = store.blocks_at(spark, path, "train", [17], ["a", "b"])
    files = [f for f in one.inputFiles() if f.endswith(".parquet")]
    assert len(files) == 1 < len(store.read_packed(spark, path).inputFiles())
    assert "In(block_id" in one._jdf.queryExecution().executedPlan().toString() or "EqualTo(block_id,17)" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(IndexError, match="from 0 to 1299"):
        store.blocks_at(spark, path, "train", [5, 1300], ["a", "b"])


def test_a_mirror_reads_its_data_folder_only(spark, tmp_path):
    folder = str(tmp_path / "mirror")
    spark.range(5).write.parquet(f"{folder}/data/part")
    spark.range(50).write.parquet(f"{folder}/elsewhere")
    assert store.scan_glob(spark, folder).count() == 5


def test_blocks_are_placed_without_what_follows_from_their_ids(spark, tmp_path, monkeypatch):
    """Equal labels and masks of ones come back as they were, others and nulls too."""
    from corpusloom.sources import store

    rows = [([1, 2], [1, 2], [1, 1]), ([1, 2], [1, -100], [1, 0]), ([], [], []), ([7], None, None), (None, None, []), ([5], [5], [1, 1])]
    table = [("d", "train", i, 0, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(table, "dataset string, split string, block_id bigint, pack_group bigint, input_ids array<int>, labels array<int>, attention_mask array<int>")
    placed, write = [], store.write_cache
    monkeypatch.setattr(store, "write_cache", lambda df, *rest: placed.append(df) or write(df, *rest))
    store.write_packed(df, str(tmp_path / "p"))
    back = {r.block_id: (r.input_ids, r.labels, r.attention_mask) for r in store.read_packed(spark, str(tmp_path / "p")).collect()}
    assert back == dict(enumerate(rows))
    first = placed[0].where("block_id = 0").first()
    assert first.labels is None and first.attention_mask is None
