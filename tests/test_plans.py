"""What the optimizer makes of the operators."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusloom.plans import fixtures as fx
from corpusloom.sources import corpora

# the small tables that may be ordered as a whole: cells, file parts
QUERIES = {name: query for name, query in entry.queries().items() if name not in entry._llm()[0]}
NO_DATA_WINDOW = [
    "row_index", "concat_sources", "shuffle_epoch", "rank_plan", "slice_range", "multi_slice",
    "pack_batch", "pack_split", "early_stop", "metric_epoch", "next_token_topp", "encode_word",
]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_pack", "stream_tokenize", "classify_docs"}))
def test_no_cross_or_nested_loop_join(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", NO_DATA_WINDOW)
def test_no_data_in_a_single_partition(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    assert "SinglePartition" not in plan


def test_scans_read_only_the_needed_columns(spark, sf_dir):
    plan = physical(QUERIES["row_index"](spark, sf_dir))
    assert all("text" not in s and "html" not in s for s in re.findall(r"ReadSchema: \S+", plan))


def test_filters_reach_the_scan(spark, sf_dir):
    docs = corpora.read_table(spark, sf_dir, "documents").where(F.col("doc_id") < 10)
    assert "LessThan(doc_id,10)" in physical(docs)


def test_a_filtered_union_branch_disappears(spark, sf_dir):
    plan = physical(corpora.scan_corpora(spark, sf_dir).where(F.col("dataset") == "benchmark").select("key1"))
    assert "benchmark.parquet" in plan and "documents.parquet" not in plan


def test_first_rows_read_the_first_keys_only(spark, tmp_path):
    """Files of consecutive keys: what is read grows with the rows asked for, not with the table."""
    from corpusloom.functions.text import drop_blank
    from corpusloom.operators.slicing import first_rows

    path = str(tmp_path / "t")
    blank = F.when((F.col("id") >= 10) & (F.col("id") % 100 < 97), F.lit(" ")).otherwise(F.concat(F.lit("text "), "id"))
    rows = spark.range(10, 20_000).select(F.lit("d").alias("dataset"), F.col("id").alias("key1"), F.lit(0).alias("key2"), blank.alias("text"))
    rows.repartitionByRange(40, "key1").write.parquet(path)
    table = spark.read.parquet(path)
    found = first_rows(drop_blank(table, "text"), "dataset", ["key1", "key2"], 4, table)
    assert [(r.sample, r.key1) for r in found.orderBy("sample").collect()] == [(1, 97), (2, 98), (3, 99), (4, 197)]
    plan = physical(found)
    bound = max(int(x) for x in re.findall(r"key1#\d+L <= (\d+)", plan))
    assert 197 <= bound < 2000


def test_a_stage_lists_its_own_folders_only(spark, sf_dir):
    plan = physical(QUERIES["stage_select"](spark, sf_dir))
    # dataset, split and version are all folders: nothing is left to filter rows by (the list of filters is cut short in the plan's text)
    assert "DataFilters: []" in plan and "PushedFilters: []" in plan and " Filter " not in plan and "FileScan parquet" in plan


def test_text_is_never_shuffled_by_a_slice(spark, sf_dir):
    plan = physical(fx.documents(spark, sf_dir).where(F.col("split") == "train"))
    assert "Exchange" not in plan
    plan = physical(QUERIES["slice_range"](spark, sf_dir))
    assert "Exchange" not in plan and "GreaterThanOrEqual(doc_id," in plan
    plan = physical(QUERIES["multi_slice"](spark, sf_dir))
    assert "Exchange" not in plan and "GreaterThanOrEqual(conv_id," in plan.replace("\n", "")
    assert "pages.parquet" not in plan


def test_packing_hashes_the_narrow_side(spark, sf_dir):
    assert "ShuffledHashJoin" in physical(QUERIES["pack_batch"](spark, sf_dir))


@pytest.mark.parametrize("name", ["best_checkpoints", "next_token_topk", "sample_per_dataset"])
def test_rank_filters_run_before_the_shuffle(spark, sf_dir, name):
    assert "WindowGroupLimit" in physical(QUERIES[name](spark, sf_dir))


def test_a_stored_peek_is_pushed_to_its_folder(spark, sf_dir):
    plan = physical(QUERIES["peek_packed"](spark, sf_dir))
    assert "LessThan(block_id,3)" in plan and re.search(r"PartitionFilters: \[[^]]*split", plan)
    assert "Exchange" not in plan
