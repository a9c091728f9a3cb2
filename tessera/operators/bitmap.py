"""Bitmap index of a dimension's keys: membership tests that move no fact.

Keys are whole numbers, best dense or nearly so. They are cut into buckets
of 32,768 (``bitmap_bucket_number``), and each bucket's keys become one bit each
(``bitmap_construct_agg``): 4 KB a bucket, however wide the dimension is. A bucket
that is full, as all but the last one of a dense key are, needs no bits: its
row says so. A billion dense keys are 30,518 such rows, under a megabyte, where the
keys themselves would be many gigabytes to broadcast or a shuffle of the fact.

A fact is tested by a broadcast join on the bucket number and one look at a word.

``key_ranks`` goes one step further where surrogate keys number whole-number natural
keys in their order, as dense keys do: 64 natural keys are a word and the key of
its first one, and a key is that plus the bits below. Five million members in
row are 80,000 such rows where the pairs themselves would be too many to broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

BUCKET = 32768
_WORD = 32      # bits of a word, kept in a long
#: Bytes of a bucket's row in a hash table, without and with words.
FULL_BYTES, WORDS_BYTES = 64, 64 + 8 * BUCKET // _WORD


@dataclass
class KeyBitmap:
    """Rows ``bucket, words`` (null: every key of the bucket is there), and their size."""
    df: DataFrame
    buckets: int
    with_words: int

    @property
    def bytes(self) -> int:
        return (self.buckets - self.with_words) * FULL_BYTES + self.with_words * WORDS_BYTES


def key_bitmap(keys: DataFrame, key: str) -> KeyBitmap:
    """Index of the distinct keys of a column, NULL left out. Checkpointed and measured."""
    own = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("k"))
    bits = own.groupBy(F.bitmap_bucket_number("k").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("k")).alias("bits"))
    words = F.transform(F.sequence(F.lit(0), F.lit(BUCKET // _WORD - 1)),
                        lambda i: F.conv(F.hex(F.substr(F.col("bits"), i * 4 + 1, F.lit(4))), 16, 10).cast("long"))
    full = F.bitmap_count("bits") == BUCKET
    ensure_checkpoint_dir(keys.sparkSession)
    df = bits.select("bucket", F.when(~full, words).alias("words")).checkpoint(eager=True)
    n, some = df.agg(F.count(F.lit(1)), F.count("words")).first()
    return KeyBitmap(df, n, some)


def has_key(key: Column, words: Column, found: Column) -> Column:
    """Whether ``key`` is in the bucket that was joined to it (``found`` is null where there is none)."""
    bit = F.bitmap_bit_position(key)
    # a word is four bytes, the first one its highest; a byte's first key is its lowest bit
    word = F.get(words, F.shiftright(bit, 5).cast("int"))
    within = bit.bitwiseAND(F.lit(31))
    place = (F.lit(3) - F.shiftright(within, 3)) * 8 + within.bitwiseAND(F.lit(7))
    set_ = F.call_function("shiftright", word, place.cast("int")).bitwiseAND(F.lit(1)) == 1
    return F.when(found.isNull(), F.lit(False)).when(words.isNull(), F.lit(True)).otherwise(set_)


def with_membership(df: DataFrame, key: str, index: KeyBitmap, flag: str) -> DataFrame:
    """``df`` with a column that says whether ``key`` is in the index (false for NULL)."""
    k = F.col(key).cast("long")
    side = index.df.select(F.col("bucket").alias("_bucket"), F.col("words").alias("_words"))
    joined = df.join(F.broadcast(side), F.bitmap_bucket_number(k) == F.col("_bucket"), "left")
    known = F.when(k.isNull(), F.lit(False)).otherwise(has_key(k, F.col("_words"), F.col("_bucket")))
    return joined.withColumn(flag, known).drop("_bucket", "_words")


#: Bytes of a word's row in a hash table.
RANK_BYTES = 64


def _word(k: Column) -> Column:
    return F.shiftright(k, 6)


def _shifted(value: int, k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))


def _ranked(k: Column) -> Column:
    there = F.col("_bits").bitwiseAND(_shifted(1, k)) != 0
    below = F.bitwise_not(_shifted(-1, k))
    return F.when(there, F.col("_first") + F.bit_count(F.col("_bits").bitwiseAND(below)))


def key_ranks(dim: DataFrame, natural: str, key: str, max_bytes: int) -> DataFrame | None:
    """Index of the surrogate keys of whole-number natural keys: rows ``_word, _bits, _first``. None if it is larger
    than ``max_bytes`` or doesn't give every row of ``dim`` its key (keys that repeat or are out of order)."""
    k = F.col(natural).cast("long")
    own = dim.where(F.col(natural).isNotNull()).select(k.alias("k"), F.col(key).cast("long").alias("key"))
    words = own.groupBy(_word(F.col("k")).alias("_word")).agg(F.bit_or(_shifted(1, F.col("k"))).alias("_bits"), F.min("key").alias("_first"))
    ensure_checkpoint_dir(dim.sparkSession)
    words = words.checkpoint(eager=True)
    if words.count() * RANK_BYTES > max_bytes:
        return None
    seen = own.join(F.broadcast(words), _word(F.col("k")) == F.col("_word"), "left")
    return None if seen.where(~F.col("key").eqNullSafe(_ranked(F.col("k")))).limit(1).count() else words


def with_rank(df: DataFrame, natural: str, ranks: DataFrame, key: str) -> DataFrame:
    """``df`` with the surrogate key of a whole-number column; NULL where the dimension has none."""
    k = F.col(natural).cast("long")
    joined = df.join(F.broadcast(ranks), _word(k) == F.col("_word"), "left")
    return joined.withColumn(key, _ranked(k)).drop("_word", "_bits", "_first")
