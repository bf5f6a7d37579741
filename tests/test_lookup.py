from __future__ import annotations

from corpusloom.operators import lookup as lk
from corpusloom.operators.vocab import build_vocab, decode_words, encode_words


def test_heavy_and_light_keys_agree_with_a_plain_join(spark):
    """A key with a third of the rows, one of them unknown, and null keys."""
    rows = [(i, "the") for i in range(500)] + [(500 + i, "odd") for i in range(500)]
    rows += [(1000 + i, f"w{i % 97}") for i in range(490)] + [(2000 + i, None) for i in range(10)]
    facts = spark.createDataFrame(rows, "i bigint, token string")
    table = spark.createDataFrame([("the", 1)] + [(f"w{i}", 10 + i) for i in range(90)], "token string, id int")
    plain = facts.join(table, ["token"], "left").select("i", "token", "id")
    split = lk.keyed_lookup(facts, table, ["token"], heavy_share=8, small=False).select("i", "token", "id")
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_heavy_keys_of_wide_values_are_salted(spark, monkeypatch):
    rows = [(i, "the") for i in range(500)] + [(500 + i, "odd") for i in range(500)] + [(1000 + i, f"w{i % 97}") for i in range(490)]
    facts = spark.createDataFrame(rows, "i bigint, token string").repartition(6)
    table = spark.createDataFrame([("the", "x" * 1000)] + [(f"w{i}", "y") for i in range(90)], "token string, value string")
    monkeypatch.setattr(lk, "fits_broadcast", lambda *_: False)
    found = lk.keyed_lookup(facts, table, ["token"], heavy_share=8).select("i", "token", "value")
    plain = facts.join(table, ["token"], "left").select("i", "token", "value")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_size_check_counts_rows_and_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 50, "s string")
    assert lk.fits_broadcast(df)
    assert not lk.fits_broadcast(df, max_rows=49)
    assert not lk.fits_broadcast(df, max_bytes=10_000)


def test_encode_is_the_same_with_and_without_broadcast(spark):
    docs = spark.createDataFrame(
        [(0, "the cat, the dog"), (1, ""), (2, "   "), (3, "the the the zebra 42"), (4, "dog")], "doc_id bigint, text string"
    )
    vocab = build_vocab(docs.where("doc_id <> 3"))
    small = {r.doc_id: r.input_ids for r in encode_words(docs, ["doc_id"], vocab).collect()}
    large = {r.doc_id: r.input_ids for r in encode_words(docs, ["doc_id"], vocab, max_rows=0).collect()}
    assert small == large
    ids = {r.token: r.id for r in vocab.collect()}
    assert ids["dog"] == 3 and ids["the"] == 4      # two each, ties by token
    assert small[1] == [] and small[2] == []
    assert small[3] == [ids["the"]] * 3 + [0, 0]
    encoded = encode_words(docs, ["doc_id"], vocab)
    kept = {r.doc_id: r.decoded for r in decode_words(encoded, ["doc_id"], vocab, skip_special=False).collect()}
    assert kept[3] == "the the the <unk> <unk>" and kept[1] == ""
    dropped = {r.doc_id: r.decoded for r in decode_words(encoded, ["doc_id"], vocab, max_rows=0).collect()}
    assert dropped[3] == "the the the" and dropped[0] == "the cat , the dog"


def test_a_vocabulary_in_two_parts_gives_the_same_ids(spark):
    """Head and tail both used, a long token that no head may hold, nulls, one pass over the texts."""
    long = "z" * 100
    docs = spark.createDataFrame([(0, f"a a a b b c {long}"), (1, None), (2, f"c d {long} a"), (3, "zebra")], "doc_id bigint, text string")
    vocab = build_vocab(docs.where("doc_id < 3"))
    want = {r.doc_id: r.input_ids for r in encode_words(docs, ["doc_id"], vocab, max_rows=0).collect()}
    for head in (1, 2, 500_000):
        encoded = encode_words(docs, ["doc_id"], vocab, max_rows=head)
        assert {r.doc_id: r.input_ids for r in encoded.collect()} == want
        plan = encoded._jdf.queryExecution().executedPlan().toString()
        assert plan.count("posexplode") <= 1
        decoded = {r.doc_id: r.decoded for r in decode_words(encoded, ["doc_id"], vocab, max_rows=head).collect()}
        assert decoded == {0: f"a a a b b c {long}", 1: "", 2: f"c d {long} a", 3: ""}


def test_arrays_are_mapped_where_they_are_read(spark):
    """No token becomes a row of its own, and rows of unique keys are not gathered; repeated and null keys are merged by position."""
    docs = spark.createDataFrame([(0, "a a b"), (1, None), (2, "b c a")], "doc_id bigint, text string")
    vocab = build_vocab(docs)
    encoded = encode_words(docs, ["doc_id"], vocab)
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (encoded, decode_words(encoded, ["doc_id"], vocab))]
    assert not any("Generate" in p or "Aggregate" in p or "Exchange" in p for p in plans)
    ids = {r.token: r.id for r in vocab.collect()}
    twice = docs.unionAll(docs.where("doc_id = 2")).unionAll(spark.createDataFrame([(None, "c c"), (None, "a")], docs.schema))
    found = {r.doc_id: r.input_ids for r in encode_words(twice, ["doc_id"], vocab).collect()}
    assert found[0] == [ids["a"], ids["a"], ids["b"]] and found[1] == []
    assert found[2] == [ids[x] for x in "bbccaa"] and found[None] == sorted([ids["a"], ids["c"]]) + [ids["c"]]
