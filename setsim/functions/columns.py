"""Column expressions used by the operators.

Everything here returns a ``Column`` built from Spark's built-in functions, so
it runs inside the JVM (whole-stage codegen where Spark supports it) and never
ships rows to Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as "blank" when a structure is stripped: the
# white space of Unicode and the four ASCII separators.
BLANK_PATTERN = (r"^[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*$")


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """Empty string -> NULL (whitespace-only strings are kept)."""
    c = col_(c)
    return F.when(c == F.lit(""), F.lit(None).cast(T.StringType())).otherwise(c)


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL for floating columns."""
    return F.nanvl(col_(c), F.lit(None).cast(T.DoubleType()))


def strict_whole_number(c: str | Column, target: T.DataType, name: str = "value") -> Column:
    """Cast a floating value to an integral type, failing on a fraction.

    ``24.0 -> 24``, NULL/NaN -> NULL, ``24.5`` -> error.  Overflow is an error
    through the ANSI cast.  A plain CAST would silently truncate the fraction.
    """
    c = nan_to_null(col_(c).cast(T.DoubleType()))
    return (
        F.when(c.isNull(), F.lit(None).cast(target))
        .when(c != F.floor(c), F.raise_error(F.concat(F.lit(f"non-integral value in {name}: "), c.cast("string"))).cast(target))
        .otherwise(c.cast(target))
    )


def is_blank(c: str | Column) -> Column:
    """NULL or only whitespace."""
    c = col_(c)
    return c.isNull() | c.rlike(BLANK_PATTERN)


def bucket_hash(key: Column, n_bits: int, method: str = "md5") -> Column:
    """Map a string key to a bit position in ``[0, n_bits)``.

    ``md5``: the first 7 hex digits of the MD5 digest as an integer, modulo
    ``n_bits``; it is portable to any SQL engine with md5 (used for oracles).
    ``xxhash64``: Spark's native 64-bit hash, cheaper, for scale runs.
    """
    if method == "md5":
        raw = F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast(T.LongType())
    elif method == "xxhash64":
        raw = F.xxhash64(key)
    else:
        raise ValueError(f"unknown hash method {method!r}")
    return F.pmod(raw, F.lit(n_bits).cast(T.LongType()))


def digest28(key: Column) -> Column:
    """A 28-bit integer digest of a string (first 7 hex digits of MD5)."""
    return F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast(T.LongType())


def tanimoto(a: str | Column, b: str | Column,
             size_a: Column | None = None, size_b: Column | None = None) -> Column:
    """|A ∩ B| / (|A| + |B| − |A ∩ B|) for two on-bit arrays (distinct elements).

    Identical sets give 1.0; two empty sets (not produced by the fingerprint
    operators, which drop invalid input) are defined as 1.0.  Pass precomputed
    sizes to avoid recomputing them per pair.
    """
    a, b = col_(a), col_(b)
    inter = F.size(F.array_intersect(a, b))
    sa = size_a if size_a is not None else F.size(a)
    sb = size_b if size_b is not None else F.size(b)
    return tanimoto_from_sizes(inter, sa, sb)


def tanimoto_from_sizes(inter: Column, size_a: Column, size_b: Column) -> Column:
    """Tanimoto from the intersection size and the two set sizes (integers;
    the union is exact, the quotient is one double division)."""
    union = size_a.cast(T.LongType()) + size_b.cast(T.LongType()) - inter.cast(T.LongType())
    return F.when(union == 0, F.lit(1.0)).otherwise(inter.cast(T.DoubleType()) / union.cast(T.DoubleType()))


def ring_window_bits(s: str | Column, radius: int, n_bits: int, method: str = "md5") -> Column:
    """Sorted distinct bit positions of all ring windows of a string.

    For every radius ``r`` in ``0..radius`` and every position the window of
    ``r`` characters to either side (clipped to the string) is keyed as
    ``"r:window"`` and hashed to a bit.  The string is cut into characters
    once and a window copies only its own, so a text costs time in proportion
    to its length; each distinct window is hashed once.  Runs on the JVM.
    """
    if method == "rolling":
        return rolling_window_bits(s, radius, n_bits)

    def windows(padded: Column) -> Column:
        def per_radius(r: int) -> Column:
            # Empty text stands beyond either end, so that a clipped window is a plain one.
            around = F.transform(F.slice(padded, radius + 1, F.size(padded) - 2 * radius), lambda _, i: F.concat(
                *(F.get(padded, i + (radius + j)) for j in range(-r, r + 1))))
            keys = F.array_distinct(around)
            return F.transform(keys, lambda w: bucket_hash(F.concat(F.lit(f"{r}:"), w), n_bits, method))
        return F.concat(*(per_radius(r) for r in range(radius + 1)))

    edge = F.array_repeat(F.lit(""), radius)
    # The one-element array binds the characters to a name for the lambdas.
    bound = F.transform(F.array(F.concat(edge, F.split(col_(s), ""), edge)), windows)
    return F.array_sort(F.array_distinct(F.flatten(bound)))


#: The window hash by arithmetic: a prime below 2**31 and the factors of the
#: window within, the character that joins on the left and the one on the right.
ROLLING_PRIME = 2_147_483_647
ROLLING_FACTORS = (48_271, 69_621, 1_583_458_089)


def rolling_window_bits(s: str | Column, radius: int, n_bits: int) -> Column:
    """Sorted distinct bit positions of all ring windows, hashed by arithmetic.

    A window of radius ``r`` has the hash of the window of ``r - 1`` within it,
    extended by the code points of the two characters that join:
    ``(h * M + (left + 1) * A + (right + 1) * B + r) mod P``, where a side beyond the
    string adds nothing; radius 0 is ``(code * A + 1) mod P``.  No window is ever
    copied, joined or hashed as text, so that a position costs the same at every
    radius.  All terms stay below 2**63.
    """
    m, a, b = (F.lit(x).cast(T.LongType()) for x in ROLLING_FACTORS)
    prime = F.lit(ROLLING_PRIME).cast(T.LongType())

    def bound(value: Column, use) -> Column:
        """``use(value)`` with the value computed once, not for each element."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def extended(codes: Column, inner: Column, r: int) -> Column:
        def joins(i: Column) -> Column:
            return F.coalesce(F.get(codes, i), F.lit(0).cast(T.LongType()))
        return F.transform(inner, lambda h, i: (h * m + joins(i - r) * a + joins(i + r) * b + r) % prime)

    def levels(codes: Column, inner: Column, r: int) -> Column:
        if r > radius:
            return inner
        return bound(extended(codes, inner, r), lambda h: F.concat(inner, levels(codes, h, r + 1)))

    # Code points and one, so that 0 stands for no character.
    codes = F.transform(F.split(col_(s), ""), lambda c: F.ascii(c).cast(T.LongType()) + 1)
    hashes = bound(codes, lambda c: bound(
        F.transform(c, lambda x: ((x - 1) * a + 1) % prime), lambda h: levels(c, h, 1)))
    return F.sort_array(F.array_distinct(F.transform(hashes, lambda h: h % F.lit(n_bits).cast(T.LongType()))))


def n_words(n_bits: int) -> int:
    """64-bit words needed for ``n_bits`` positions."""
    return (int(n_bits) + 63) // 64


def packed_words(bits: str | Column, n_bits: int) -> Column:
    """Pack an on-bit array into an array of ``ceil(n_bits / 64)`` BIGINT words.

    Word ``j`` holds bits ``64j .. 64j+63`` (bit ``b`` is ``1 << (b - 64j)``;
    bit 63 is the sign bit, which ``bit_count`` counts like any other).  The bits,
    positions from 0 on, are folded once in ascending order: the fold carries the
    words that are done, and the number and bits of the one it is in.  Done once per
    record; every pair then costs ``AND`` + ``bit_count`` per word.
    """
    zero, one, size = F.lit(0).cast(T.LongType()), F.lit(1).cast(T.LongType()), n_words(n_bits)

    def closed(state: Column, upto: Column) -> Column:
        """The words before ``upto``: the one at hand and the empty ones after it."""
        return F.concat(state["done"], F.array(state["bits"]), F.array_repeat(zero, upto - state["word"] - 1))

    def step(state: Column, b: Column) -> Column:
        word = F.shiftright(b, 6).cast(T.IntegerType())
        bit = F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63).cast(T.LongType())).cast(T.IntegerType()))
        same = state["word"] == word
        return F.struct(F.when(same, state["done"]).otherwise(closed(state, word)).alias("done"), word.alias("word"),
                        F.when(same, state["bits"].bitwiseOR(bit)).otherwise(bit).alias("bits"))

    start = F.struct(F.array().cast("array<bigint>").alias("done"), F.lit(0).alias("word"), zero.alias("bits"))
    return F.aggregate(F.sort_array(col_(bits)), start, step, lambda s: F.slice(closed(s, F.lit(size)), 1, size))


def packed_intersection(a_words: list[Column], b_words: list[Column]) -> Column:
    """|A ∩ B| of two packed fingerprints: Σ bit_count(a_j & b_j)."""
    terms = [F.bit_count(a.bitwiseAND(b)).cast(T.LongType()) for a, b in zip(a_words, b_words)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def bits_to_text(c: str | Column) -> Column:
    """Comma-joined on-bits, for stable comparison of array results."""
    return F.array_join(F.transform(col_(c), lambda x: x.cast("string")), ",")
