"""Constants and the packed-block schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Ids that decide the results.
BYTE_EOS = 256          # one past the last byte value
UNK_ID = 0
EOS_ID = 1              # doubles as the pad id of the word vocabulary
MASK_ID = 2
FIRST_WORD_ID = 3
IGNORE_INDEX = -100

BLOCK_LENGTH = 128
BATCH_SIZE = 4
PACK_BATCH_ROWS = 1000

SPLITS = ("train", "validation", "test")

PACKED_COLUMNS = ("input_ids", "labels", "attention_mask")

PACKED_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("block_id", T.LongType()),
        T.StructField("pack_group", T.LongType()),
        *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in PACKED_COLUMNS],
    ]
)
