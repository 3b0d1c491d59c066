"""A Bloom filter over the keys of a small table, for the scan of a large one.

A join of few keys with a large table shuffles the whole large table, unless the
small side can be broadcast.  The filter says of nearly all rows that cannot match
that they cannot, before the exchange: it is an array of 64-bit words, built from
the keys by one aggregate and read by the scan as a scalar subquery.  A key sets
``BITS`` bits of one word, so that a test costs one word.  Rows that pass wrongly
are dropped by the join itself; rows that match always pass.

The size follows the number of keys and is bounded by ``MAX_WORDS`` (1 MiB); more
keys than it can tell apart get no filter, and the join runs as it would without.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 4
BITS_PER_KEY = 16
MAX_WORDS = 1 << 17


def filter_words(n_keys: int) -> int | None:
    """Words of the filter of so many keys, a power of two; None where it would say little."""
    words = 16
    while words * 64 < n_keys * BITS_PER_KEY and words < MAX_WORDS:
        words *= 2
    return words if words * 64 * 2 >= n_keys * BITS_PER_KEY else None


def _place(key: Column, n_words: int) -> tuple[Column, Column]:
    """The word of a key and its bits there, from one hash."""
    h = F.xxhash64(F.lit("key filter"), key)
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 64 - 6 * (i + 1)).bitwiseAND(F.lit(63).cast("long")).cast("int"))
            for i in range(BITS)]
    return h.bitwiseAND(F.lit(n_words - 1).cast("long")).cast("int"), reduce(lambda a, b: a.bitwiseOR(b), bits)


def key_filter(keys: DataFrame, key: str, n_keys: int | None = None):
    """A function of a column: true on every value that ``keys`` holds in ``key``,
    and on few others.  ``n_keys`` bounds the number of keys; it is counted if not given."""
    n_words = filter_words(keys.count() if n_keys is None else n_keys)
    if n_words is None:
        return lambda column: F.lit(True)
    word, bits = _place(F.col(key), n_words)
    empty = keys.sparkSession.range(n_words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    set_ = keys.filter(F.col(key).isNotNull()).select(word.alias("word"), bits.alias("bits"))
    # At most MAX_WORDS rows come together, whatever the number of keys.
    filled = set_.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words")).scalar()

    def passes(column: Column) -> Column:
        at, wanted = _place(column, n_words)
        return F.get(words, at).bitwiseAND(wanted) == wanted
    return passes
