from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import tokens as tok
from corpusloom.streaming.ledger import file_states, take_files, taken_rows, waiting_files
from corpusloom.streaming.ingest import ingest, read_arriving, read_sink
from corpusloom.streaming.stateful import pack_stateful


def test_restart_takes_only_what_is_new(spark, tmp_path):
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = spark.createDataFrame([], "doc_id bigint, text string").schema

    def land(lo, hi):
        spark.range(lo, hi).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).write.mode(
            "append"
        ).parquet(source)

    def take():
        columns = ["doc_id", tok.byte_tokens(F.col("text")).alias("input_ids")]
        ingest(read_arriving(spark, source, schema, 1), columns, sink, progress)
        return sorted(r.doc_id for r in read_sink(spark, sink).collect())

    land(0, 5)
    assert take() == list(range(5))
    assert take() == list(range(5))
    land(5, 8)
    assert take() == list(range(8))


def _batch_blocks(rows, length):
    """Blocks per group of (g, k, text) rows, by plain Python."""
    out = []
    for g in sorted({r[0] for r in rows}):
        ids = [x for _, _, text in sorted(r for r in rows if r[0] == g) for x in [*text.encode(), 256]]
        out += [(g, b, ids[b * length : (b + 1) * length]) for b in range(len(ids) // length)]
    return out


def test_a_group_may_arrive_in_parts(spark, tmp_path):
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = [(g, k, f"é text {k}" * (k % 3)) for g in range(4) for k in range(10)]
    schema = "g bigint, k bigint, text string, n bigint"

    def take(part, **options):
        frame = spark.createDataFrame([(*r, 10 if r[0] < 3 else None) for r in part], schema)
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = read_arriving(spark, source, frame.schema, 1)
        pack_stateful(stream, ["g"], ["k"], F.col("text").cast("binary"), 16, sink, progress, announced=F.col("n"), **options)
        return sorted((r.g, r.block_id, r.input_ids) for r in read_sink(spark, sink, spark.createDataFrame([], "g bigint, block_id bigint, input_ids array<int>").schema).collect())

    want = _batch_blocks(rows, 16)
    # group 0 in three batches and out of order, 1 at once, 2 in two, 3 never announces its size
    assert take([r for r in rows if r[0] == 0 and r[1] % 3 == 1] + [r for r in rows if r[0] in (1, 3)]) == [x for x in want if x[0] == 1]
    assert take([r for r in rows if r[0] == 0 and r[1] % 3 == 0] + [r for r in rows if r[0] == 2 and r[1] > 4]) == [x for x in want if x[0] == 1]
    last = [r for r in rows if r[0] == 0 and r[1] % 3 == 2] + [r for r in rows if r[0] == 2 and r[1] <= 4]
    assert take(last) == [x for x in want if x[0] < 3]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    with pytest.raises(Exception, match="arrived after it was packed"):
        take([(1, 99, "late")])


def test_a_group_that_stays_open_is_closed_by_its_timer(spark, tmp_path):
    source, sink, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = [(0, k, f"text {k}") for k in range(8)] + [(1, 0, "x" * 40)]
    schema = spark.createDataFrame([], "g bigint, k bigint, text string").schema
    for part in (rows[:8], rows[8:]):       # the second batch comes after the first group's time
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        pack_stateful(read_arriving(spark, source, schema), ["g"], ["k"], F.col("text").cast("binary"), 16, sink, progress, wait_ms=1)
    got = sorted((r.g, r.block_id, r.input_ids) for r in read_sink(spark, sink).collect())
    assert [x for x in got if x[0] == 0] == _batch_blocks(rows[:8], 16)


def test_damaged_files_are_retried_and_listed(spark, tmp_path):
    folder, sink, book = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    rows = spark.range(5000).select("id", F.concat(F.lit("text "), "id").alias("text"))
    rows.where("id < 3000").coalesce(1).write.parquet(str(folder / "good"))
    rows.where("id < 0").coalesce(1).write.parquet(str(folder / "empty"))
    rows.where("id >= 3000").coalesce(1).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "elsewhere"))
    content = next((tmp_path / "elsewhere").glob("*.parquet")).read_bytes()
    whole = folder / "later.parquet"
    whole.write_bytes(content[:200] + b"\x00" * 2000 + content[2200:])      # the footer is fine, a row group is not
    summed = next((folder / "empty").glob("*.parquet"))                    # Spark wrote a checksum beside this one
    summed.write_bytes(b"\x00" * summed.stat().st_size)
    (folder / "cut.parquet").write_bytes(content[:500])
    (folder / "other.parquet").write_bytes(b"nothing of the kind")

    def take():
        n = take_files(spark, str(folder), rows.schema, sink, book)
        return n, sorted(r.id for r in taken_rows(spark, rows.schema, sink, book).collect())

    assert take_files(spark, str(folder), rows.schema, sink, book, most_files=1) == 1
    assert take() == (5, list(range(3000)))         # the first file of the list was damaged and is tried again
    assert take() == (4, list(range(3000)))
    whole.write_bytes(content)
    assert take() == (4, list(range(5000)))         # a replaced file starts anew
    tried = [take()[0] for _ in range(3)]
    assert tried[-1] == 0 and waiting_files(spark, str(folder), book, "*.parquet").count() == 0
    states = {r.path.rsplit("/", 1)[1]: (r.status, r.attempts) for r in file_states(spark, book).where("status = 'damaged'").collect()}
    assert states["other.parquet"] == states["cut.parquet"] == states[summed.name] == ("damaged", 5)
    assert all(r.error for r in file_states(spark, book).where("status = 'damaged'").collect())


def test_a_batch_of_the_stream_has_a_file_for_every_core(spark, sf_dir, monkeypatch):
    from corpusloom.plans import token_queries as tq

    asked, read = [], tq.ingest.read_arriving
    monkeypatch.setattr(tq.ingest, "read_arriving", lambda *args: asked.append(args[-1]) or read(*args))
    tq.stream_tokenize(spark, sf_dir)
    tq.stream_pack(spark, sf_dir)
    assert asked and min(asked) >= spark.sparkContext.defaultParallelism
