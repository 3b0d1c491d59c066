"""Set-similarity search.

Plan shape for "score chosen sources against every record", the same for ten
sources and for a million:

* every fingerprint is packed once into ``n_bits/64`` non-nullable BIGINT
  words (stored with the table, ``pack_fingerprints``), so a pair costs ``W``
  AND + ``bit_count`` in generated code;
* pairs form block by block: a source hashes into one of ``B`` blocks and is
  copied to the ``T`` target blocks, a target hashes into one of ``T`` and is
  copied to the ``B`` source blocks; the two meet in an equi-join on
  ``(source block, target block)``.  B and T follow the row counts.  Spark
  broadcasts the sources where they are small and sorts both sides where not;
* top-k per source is ``row_number() <= k+1`` over ``(score DESC, target)``, planned as
  a partial WindowGroupLimit *before* the shuffle (k+1 rows per source and
  task are exchanged); the tie flag is a second window over the same
  partitioning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setsim.functions import key_filter, n_words, packed_intersection, packed_words, tanimoto, tanimoto_from_sizes
from setsim.operators.fingerprint import BITS_COL, DEFAULT_N_BITS
from setsim.session import default_parallelism, materialize

# Fixed defaults of the reference: 100 sources, top 10.
DEFAULT_SOURCE_COUNT = 100
DEFAULT_K = 10
PACKED_PREFIX = "w"
# Sources that one block holds, and target blocks for each task (so that the
# hash of the blocks spreads them evenly).
SOURCE_BLOCK = 4096
BLOCKS_PER_TASK = 4


def select_source_molecules(fingerprinted: DataFrame, count: int = DEFAULT_SOURCE_COUNT,
                            id_col: str = "chembl_id") -> DataFrame:
    """The first ``count`` fingerprinted rows in id (text) order (M5).

    Takes the fingerprint table, where invalid structures are already absent,
    so failures are skipped before counting.  Plans as TakeOrderedAndProject:
    each task keeps its best ``count`` rows and one task merges them, so the
    result is bounded by ``count`` whatever the table size.  Rows that repeat
    an id come in the order of their fingerprints.
    """
    rest = [F.col(c) for c in fingerprinted.columns if c != id_col]
    return fingerprinted.orderBy(F.col(id_col).asc(), *rest).limit(int(count))


def tanimoto_column(a: str = "source_bits", b: str = "target_bits", size_a: str | None = None,
                    size_b: str | None = None):
    """T1 as a column: Tanimoto of two on-bit arrays."""
    return tanimoto(a, b, F.col(size_a) if size_a else None, F.col(size_b) if size_b else None)


def pack_fingerprints(fingerprinted: DataFrame, n_bits: int = DEFAULT_N_BITS) -> DataFrame:
    """The search form of a fingerprint table: ``(chembl_id, n_on, w0 … w{W-1})``.

    Built once per record; every pair afterwards is ``W`` AND/bit_count
    operations in generated code instead of a hash-set intersection.
    """
    if PACKED_PREFIX + "0" in fingerprinted.columns:
        return fingerprinted
    # Declared non-nullable (coalesce with a literal): the pair loop then
    # carries no null branches, which keeps its generated code small.
    zero = F.lit(0).cast("bigint")
    packed = fingerprinted.select("chembl_id", F.coalesce(F.size(BITS_COL), F.lit(0)).alias("n_on"),
                                  packed_words(BITS_COL, n_bits).alias("words"))
    return packed.select("chembl_id", "n_on", *[F.coalesce(F.get("words", F.lit(j)), zero).alias(f"{PACKED_PREFIX}{j}")
                                                for j in range(n_words(n_bits))])


def word_count(packed: DataFrame) -> int:
    return sum(1 for c in packed.columns if c.startswith(PACKED_PREFIX) and c[len(PACKED_PREFIX):].isdigit())


def packed_table(fingerprinted: DataFrame, n_bits: int = DEFAULT_N_BITS) -> DataFrame:
    """The packed form, written once unless the table already is packed."""
    if PACKED_PREFIX + "0" in fingerprinted.columns:
        return fingerprinted
    return materialize(pack_fingerprints(fingerprinted, n_bits), "packed")


def _side(packed: DataFrame, role: str) -> DataFrame:
    """One side of the pairs.  Columns of a file are nullable whatever was written,
    so the numbers are declared non-nullable again: with 64 null checks a pair the
    compiled loop is several times slower."""
    w = word_count(packed)
    zero = F.lit(0).cast("bigint")
    return packed.select(F.col("chembl_id").alias(f"{role}_chembl_id"), F.coalesce("n_on", F.lit(0)).alias(f"{role}_n_on"),
                         *[F.coalesce(f"{PACKED_PREFIX}{j}", zero).alias(f"{role}_{PACKED_PREFIX}{j}") for j in range(w)])


@dataclass(frozen=True)
class Blocks:
    """How the pairs are cut: source blocks, target blocks, tasks."""

    source: int
    target: int
    tasks: int


def pair_blocks(spark, n_sources: int, n_targets: int, pairs_per_task: int = 5_000_000,
                source_block: int = SOURCE_BLOCK, target_block: int | None = None) -> Blocks:
    """Blocks for the pair stage.  5 M pairs keep a task's top-k sort buffer near
    200 MB (about 40 bytes per pair row).  With ``target_block`` a task holds
    whole blocks of that many targets instead (one output file for each)."""
    by_source = max(1, math.ceil(n_sources / source_block))
    if target_block is not None:
        by_target = max(1, math.ceil(n_targets / target_block))
        return Blocks(by_source, by_target, by_source * by_target)
    pairs = max(1, n_targets) * max(1, n_sources)
    tasks = max(min(default_parallelism(spark), max(1, n_targets)), math.ceil(pairs / pairs_per_task))
    return Blocks(by_source, max(1, math.ceil(tasks * BLOCKS_PER_TASK / by_source)), tasks)


def _block_of(id_col: str, n: int):
    return F.pmod(F.xxhash64(id_col), F.lit(n))


def _copies(n: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def score_pairs(sources: DataFrame, targets: DataFrame, n_sources: int | None = None, n_targets: int | None = None,
                n_bits: int = DEFAULT_N_BITS, blocks: Blocks | None = None) -> DataFrame:
    """T3 core: ``(source_chembl_id, target_chembl_id, similarity_score)`` for
    every source against every target with a different id (M6).

    Inputs are fingerprint tables (``chembl_id, fingerprint_on_bits``), packed
    and written here, or their stored packed form.  The row counts size the
    blocks (they are counted when not given) and change no result.
    """
    spark = sources.sparkSession
    src, tgt = packed_table(sources, n_bits), packed_table(targets, n_bits)
    if blocks is None:
        n_sources = src.count() if n_sources is None else n_sources
        n_targets = tgt.count() if n_targets is None else n_targets
        blocks = pair_blocks(spark, n_sources, n_targets)
    src, tgt = _side(src, "source"), _side(tgt, "target")
    # Both sides are laid out by block: whichever one a join streams keeps its tasks.
    src = src.withColumn("_b", _block_of("source_chembl_id", blocks.source)).withColumn("_t", _copies(blocks.target)) \
        .repartition(blocks.tasks, "_b", "_t")
    tgt = tgt.withColumn("_t", _block_of("target_chembl_id", blocks.target)).withColumn("_b", _copies(blocks.source))
    if blocks.tasks == blocks.source * blocks.target:
        # As many tasks as pairs of blocks: one each.  Their hash would give some tasks several and others none.
        tgt = tgt.repartitionById(blocks.tasks, (F.col("_b") * blocks.target + F.col("_t")).cast("int"))
    else:
        tgt = tgt.repartition(blocks.tasks, "_b", "_t")
    return _pairs(src, tgt)


def _pairs(src: DataFrame, tgt: DataFrame) -> DataFrame:
    prefix = f"target_{PACKED_PREFIX}"
    w = sum(1 for c in tgt.columns if c.startswith(prefix) and c[len(prefix):].isdigit())
    inter = packed_intersection([F.col(f"source_{PACKED_PREFIX}{j}") for j in range(w)],
                                [F.col(f"target_{PACKED_PREFIX}{j}") for j in range(w)])
    joined = tgt.join(src, ["_b", "_t"]).filter(F.col("source_chembl_id") != F.col("target_chembl_id"))
    # The intersection is projected once (its own Project, kept apart by
    # Catalyst because the score reads it twice); inlining it would triple
    # the generated code of the hottest loop.
    counted = joined.select("source_chembl_id", "target_chembl_id", "source_n_on", "target_n_on", inter.alias("inter"))
    return counted.select("source_chembl_id", "target_chembl_id",
                          tanimoto_from_sizes(F.col("inter"), F.col("source_n_on"), F.col("target_n_on"))
                          .alias("similarity_score"))


def rank_top_k(scored: DataFrame, k: int = DEFAULT_K, flag: bool = True) -> DataFrame:
    """T4 ranking: top ``k`` per source by ``score DESC, target ASC`` (M7) with
    the boundary-tie flag (M8).

    Flag rule: with fewer than k+1 candidates nothing is flagged; otherwise
    the rows whose score equals the k-th score are flagged iff the (k+1)-th
    score equals it too (scores are sorted, so "any later row equals the k-th"
    is "the next row does").
    """
    ranked = scored.withColumn("rank", F.row_number().over(_by_score())).filter(F.col("rank") <= k + 1)
    if not flag:
        return ranked.filter(F.col("rank") <= k)
    whole = Window.partitionBy("source_chembl_id")
    kth = F.max(F.when(F.col("rank") == k, F.col("similarity_score"))).over(whole)
    nxt = F.max(F.when(F.col("rank") == k + 1, F.col("similarity_score"))).over(whole)
    tie = F.coalesce((F.col("similarity_score") == kth) & (nxt == kth), F.lit(False))
    return (ranked.withColumn("has_duplicates_of_last_largest_score", tie)
            .filter(F.col("rank") <= k))


def _by_score() -> Window:
    return Window.partitionBy("source_chembl_id").orderBy(F.col("similarity_score").desc(),
                                                          F.col("target_chembl_id").asc())


def compute_top_k(sources: DataFrame, targets: DataFrame, k: int = DEFAULT_K, n_sources: int | None = None,
                  n_targets: int | None = None, n_bits: int = DEFAULT_N_BITS, flag: bool = True) -> DataFrame:
    """T4/T5: the fact rows ``(source, target, score, flag)`` for all sources."""
    ranked = rank_top_k(score_pairs(sources, targets, n_sources, n_targets, n_bits), k, flag)
    return ranked.select("source_chembl_id", "target_chembl_id", "similarity_score",
                         "has_duplicates_of_last_largest_score" if flag else "rank")


def compute_full_similarity(sources: DataFrame, targets: DataFrame, n_sources: int | None = None,
                            n_targets: int | None = None, n_bits: int = DEFAULT_N_BITS,
                            blocks: Blocks | None = None) -> DataFrame:
    """Every other record's score for each source, zeros included (M9)."""
    return score_pairs(sources, targets, n_sources, n_targets, n_bits, blocks)


def top_k_single_source(fingerprinted: DataFrame, k: int = 5, source_id: str | None = None,
                        n_bits: int = DEFAULT_N_BITS) -> DataFrame:
    """Top-``k`` preview of one source (the first by id unless given), no flag.
    Every row that holds a given id is searched."""
    packed = packed_table(fingerprinted, n_bits)
    src = select_source_molecules(packed, 1) if source_id is None else packed.filter(F.col("chembl_id") == source_id)
    return compute_top_k(materialize(src, "source"), packed, k, 1, n_bits=n_bits, flag=False)


def compare_pairs(pairs: DataFrame, fingerprinted: DataFrame, a: str = "id_a", b: str = "id_b",
                  n_pairs: int | None = None) -> DataFrame:
    """Scores for named id pairs (two equi-joins with the fingerprints, each
    read through a filter of the ids that its side of the pairs names)."""
    named = pairs.select(a, b)
    n_pairs = named.count() if n_pairs is None else n_pairs

    def side(name: str, bits: str) -> DataFrame:
        can_match = key_filter(named, name, n_pairs)
        return fingerprinted.filter(can_match(F.col("chembl_id"))).select(F.col("chembl_id").alias(name), F.col(BITS_COL).alias(bits))

    return (named.join(side(a, "bits_a"), a).join(side(b, "bits_b"), b)
            .select(a, b, tanimoto("bits_a", "bits_b").alias("similarity_score")))
