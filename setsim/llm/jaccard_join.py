"""N-gram Jaccard join with rare-first prefix filtering.

A document's set holds its distinct 4-word shingles (as 64-bit hashes).  Sets
are ordered rare first, by counts over all documents held in 2**16 hash
buckets; two sets with Jaccard at least 0.85 must share a shingle among the
first ``n - ceil(0.85 n) + 1`` of each.  Spark joins on these prefix n-grams:
documents that share one get into one candidate group.  Within a candidate
group every pair goes through the prefix, length, positional and suffix
filters and is verified once by its exact intersection.

Scale.  Documents with equal sets are one class.  Prefixes are longer than that
by n/8 n-grams, so that similar sets share n/8 and more of them; a class that
shares fewer with all others together drops out before any pair is formed.  The
rows of an n-gram that a task finds shared by itself are salted, so that a hot
one is no hot group.  Candidate groups travel in bins of bounded bytes; a larger
group is cut by set size and then into blocks, whose pairs are tasks of their own.
Every pair that passes the filters is verified, in one task only.  A task returns
the number of links it verified for each class, in documents, and a spanning
forest of them for the components; the number of links of a document is the sum
over the tasks, plus the other documents of its class.

Defined results: null, empty or wordless texts have an empty set and are linked
with nothing; fewer words than the shingle length make one shingle; a row
without an id takes part in no link and has a null ``component_id``; repeated
rows share their class and count as one document, while an id counts once in each
class that its texts are in; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setsim.llm.common import FOLD, WordHasher, drop_step, mix, multipliers, row_slices, signed, small_batches, write_step
from setsim.llm.graph import components

SHINGLE = 4
PERCENT = 85
BUCKET_BITS = 16
BLOCK_BYTES = 8 << 20
ZONES = 16
SLICE_BYTES = 3 << 20


def shingle_sets(texts: list[bytes | None], hashes: WordHasher, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hashes, the text each belongs to (both
    sorted by text, then hash) and the set sizes."""
    flat, counts = hashes(texts)
    m = multipliers(width, width)
    short = (counts > 0) & (counts < width)
    starts = np.concatenate([[0], np.cumsum(counts)])
    h, of = [], []
    if len(flat) >= width:
        grams = np.zeros(len(flat) - width + 1, np.uint64)
        for k in range(width):
            grams += flat[k:len(flat) - width + 1 + k] * m[k]
        owner = np.repeat(np.arange(len(texts)), counts)
        inside = owner[:len(grams)] == owner[width - 1:]
        h.append(mix(grams[inside]))
        of.append(owner[:len(grams)][inside])
    for i in np.flatnonzero(short):
        seq = flat[starts[i]:starts[i + 1]]
        h.append(mix(np.array([np.sum(seq * multipliers(len(seq), -len(seq)), dtype=np.uint64)])))
        of.append(np.array([i]))
    if not h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    h, of = np.concatenate(h), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    h, of = h[order], of[order]
    ends = np.cumsum(np.bincount(of, minlength=len(texts)))
    for a, b in zip(ends - np.diff(ends, prepend=0), ends, strict=True):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    h, of = h[new], of[new]
    return h, of, np.bincount(of, minlength=len(texts))


def set_classes(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set (0 for the empty one): equal sets, equal names."""
    ends = np.cumsum(sizes)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    names = mix(total[ends] - total[ends - sizes] + sizes.astype(np.uint64))
    return np.where(sizes > 0, signed(names), 0)


def prefix_length(n, percent: int):
    return n + (-percent * n) // 100 + 1


def _profile(text_col: str, id_col: str, width: int):
    """Per row its class and set size (kind 0); per task the n-gram counts by
    hash bucket (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids = WordHasher(FOLD), None
        count = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch, texts in row_slices(batches, text_col, SLICE_BYTES):
            h, _, sizes = shingle_sets(texts, hashes, width)
            count += np.bincount((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(count))
            ids, version = (batch.column(batch.schema.names.index(c)) for c in (id_col, "version"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(texts), np.int32)), ids, version, pa.array(set_classes(h, sizes)), pa.array(sizes)],
                ["kind", "id", "version", "cls", "n"])
        if ids is None:
            return
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(used), np.int32)), pa.nulls(len(used), ids.type), pa.array(np.zeros(len(used), np.int64)),
             pa.array(used), pa.array(count[used])], ["kind", "id", "version", "cls", "n"])
    return run


def extra_prefix(n):
    """Prefix n-grams beyond the first that can be missed: similar sets share
    this many and one in their longer prefixes."""
    return n // 8


def shared_least(n, percent: int):
    """How many prefix n-grams of a set any similar set must share with it."""
    return 1 + extra_prefix(-(-percent * n // 100))


def _prefix_rows(shared, width: int, percent: int):
    """Rows (gram, salt, cls, n) for the prefix n-grams of each class.  An n-gram
    that several classes of the slice share is settled: its rows carry a salt
    that spreads them, and one row of its smallest class stands for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, freq = WordHasher(FOLD), shared.value
        for _, texts in row_slices(batches, "text", SLICE_BYTES):
            h, of, sizes = shingle_sets(texts, hashes, width)
            names = set_classes(h, sizes)
            _, first = np.unique(names, return_index=True)
            keep = np.zeros(len(texts), bool)
            keep[first] = True
            keep &= sizes > 0
            mask = keep[of]
            h, of = h[mask], of[mask]
            often = freq[(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
            ends = np.cumsum(np.where(keep, sizes, 0))
            reach = prefix_length(sizes, percent) + extra_prefix(sizes)
            first = [ends[k] - sizes[k] + np.argsort(often[ends[k] - sizes[k]:ends[k]], kind="stable")[:reach[k]]
                     for k in np.flatnonzero(keep)]
            first = np.concatenate([np.zeros(0, np.int64), *first])
            gram, cls, n = signed(h[first]), names[of[first]], sizes[of[first]]
            order = np.lexsort((cls, gram))
            gram, cls, n = gram[order], cls[order], n[order]
            lead = np.ones(len(gram), bool)
            lead[1:] = gram[1:] != gram[:-1]
            head = np.flatnonzero(lead)
            several = np.diff(head, append=len(gram)) > 1
            settled = several[np.cumsum(lead) - 1] if len(gram) else lead
            salt = np.where(settled, 1 + (mix(cls.view(np.uint64)) >> np.uint64(50)).astype(np.int64), 0)
            stand = head[several]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([gram, gram[stand]])),
                 pa.array(np.concatenate([salt, np.zeros(len(stand), np.int64)]).astype(np.int32)),
                 pa.array(np.concatenate([cls, cls[stand]])),
                 pa.array(np.concatenate([n, np.zeros(len(stand), np.int64)]).astype(np.int32))],
                ["gram", "salt", "cls", "n"])
    return run


def _class_sets(width: int):
    """Rows (cls, docs, places, grams): the set of a class as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHasher(FOLD)
        for batch, texts in row_slices(batches, "text", SLICE_BYTES):
            h, _, sizes = shingle_sets(texts, hashes, width)
            ends = np.cumsum(sizes)
            cls = batch.column(batch.schema.names.index("cls")).to_numpy()
            same = set_classes(h, sizes) == cls  # an id that repeats with another text
            names = ("cls", "docs", "places")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)).filter(pa.array(same)) for c in names),
                 pa.array([h[e - n:e].tobytes() for e, n, ok in zip(ends, sizes, same, strict=True) if ok], pa.binary())],
                [*names, "grams"])
    return run


def link_counts(names: np.ndarray, sets: list[np.ndarray], docs: np.ndarray, side: np.ndarray | None, later: np.ndarray,
                freq: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """All links among ``sets``: the names, for each the number of ``docs`` in the
    sets it is linked with, and links that connect what all of them connect.  With
    ``side`` only pairs of different sides count; two ``later`` sets meet in another task."""
    n = np.array([len(s) for s in sets], np.int64)
    by_size = np.lexsort((names, n))
    names, n, docs = names[by_size], n[by_size], docs[by_size]
    sets = [sets[i] for i in by_size]
    side = side[by_size] if side is not None else None
    later = later[by_size]
    flat = np.concatenate(sets)
    universe, ranks = np.unique(flat, return_inverse=True)
    rare = np.lexsort((universe, freq[(universe >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]))
    rank = np.empty(len(universe), np.int64)
    rank[rare] = np.arange(len(universe))
    ends = np.cumsum(n)
    starts = ends - n
    owner = np.repeat(np.arange(len(n)), n)
    flat = rank[ranks]
    flat = flat[np.lexsort((flat, owner))]
    # Prefix entries by n-gram, then by size: before a set's own entry stand the smaller sets.
    pos = np.arange(len(flat)) - starts[owner]
    entry = np.flatnonzero(pos < prefix_length(n, percent)[owner])
    entry = entry[np.lexsort((owner[entry], flat[entry]))]
    e_gram, e_set, e_pos = flat[entry], owner[entry], pos[entry]
    lead = np.ones(len(entry), bool)
    lead[1:] = e_gram[1:] != e_gram[:-1]
    first = np.flatnonzero(lead)[np.cumsum(lead) - 1]
    mine = np.lexsort((e_pos, e_set))
    bounds = np.searchsorted(e_set[mine], np.arange(len(n) + 1))
    parent = list(range(len(n)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # Suffix: the n-grams of each set by zone of the order bound every overlap.
    zones = np.zeros((len(n), ZONES), np.int32)
    cuts = np.sort(flat)[np.linspace(0, len(flat), ZONES + 1)[1:-1].astype(np.int64)]
    np.add.at(zones, (owner, np.searchsorted(cuts, flat, side="right")), 1)
    mark = np.zeros(len(universe), bool)
    linked, forest = np.zeros(len(n), np.int64), []
    for x in range(len(n)):
        own = mine[bounds[x]:bounds[x + 1]]
        own = own[first[own] < own]
        if not len(own):
            continue
        runs = own - first[own]
        back = np.repeat(first[own] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        y, j, i = e_set[back], e_pos[back], np.repeat(e_pos[own], runs)
        ok = 100 * n[y] >= percent * n[x]  # length
        if later[x]:
            ok &= ~later[y]
        if side is not None:
            ok &= side[y] != side[x]
        y, j, i = y[ok], j[ok], i[ok]
        need = -(-percent * (n[x] + n[y]) // (100 + percent))
        # Positional: shared n-grams stand before both, at both or after both.
        poor = np.minimum(i, j) + 1 + np.minimum(n[x] - i, n[y] - j) - 1 < need
        cand = np.setdiff1d(y, y[poor])
        least = -(-percent * (n[x] + n[cand]) // (100 + percent))
        fit = np.minimum(zones[cand], zones[x]).sum(axis=1) >= least
        cand, least = cand[fit], least[fit]
        mine_x = flat[starts[x]:ends[x]]
        mark[mine_x] = True
        for k in range(0, len(cand), 1024):
            c = cand[k:k + 1024]
            before = np.cumsum(n[c]) - n[c]
            both = np.add.reduceat(mark[flat[np.repeat(starts[c] - before, n[c]) + np.arange(n[c].sum())]], before, dtype=np.int64)
            c = c[both >= least[k:k + 1024]]
            linked[x] += docs[c].sum()
            linked[c] += docs[x]
            for y in c.tolist():
                if root(y) != root(x):
                    parent[root(x)] = root(y)
                    forest.append((int(names[x]), int(names[y])))
        mark[mine_x] = False
    return names, linked, forest


def _verify(shared, percent: int):
    """Rows (a, null, links): the links of class a in documents; rows (a, b, 0): the forest."""
    def run(group: pa.Table) -> pa.Table:
        names, first = np.unique(group.column("cls").to_numpy(), return_index=True)
        grams = group.column("grams").take(pa.array(first)).to_pylist()
        docs, side, later = (group.column(c).to_numpy()[first] for c in ("docs", "side", "later"))
        two = group.column("bi")[0].as_py() != group.column("bj")[0].as_py()
        names, linked, forest = link_counts(names, [np.frombuffer(g, np.uint64) for g in grams], docs, side if two else None,
                                            later, shared.value, percent)
        some = linked > 0
        a, b = zip(*forest, strict=True) if forest else ((), ())
        return pa.table({"a": pa.array([*names[some].tolist(), *a], pa.int64()),
                         "b": pa.array([*([None] * int(some.sum())), *b], pa.int64()),
                         "links": pa.array([*linked[some].tolist(), *([0] * len(a))], pa.int64())})
    return run


def _near(grams: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between classes that share a prefix n-gram, among classes that
    share enough of them with others to be similar to any.  Whoever shares too
    few drops out, and is not counted when the others are judged again."""
    enough = F.col("shared") >= shared_least_sql("n", percent)
    group = Window.partitionBy("gram", "salt")
    rows = write_step(grams.withColumn("low", F.min("cls").over(group)).withColumn("high", F.max("cls").over(group))
                      .filter("n > 0 and (salt > 0 or low <> high)").select("gram", "cls", "n"), "jaccard-shared")
    alive = write_step(rows.groupBy("cls").agg(F.countDistinct("gram").alias("shared"), F.first("n").alias("n"))
                       .filter(enough).select("cls"), "jaccard-alive")
    left = write_step(rows.join(alive, "cls").distinct(), "jaccard-left")
    drop_step(rows, alive)
    pivots = write_step(left.groupBy("gram").agg(F.min("cls").alias("pivot"), F.max("cls").alias("high"))
                        .filter("pivot <> high").select("gram", "pivot"), "jaccard-pivots")
    tied = write_step(left.join(pivots, "gram").select("cls", "pivot", "n"), "jaccard-tied")
    alive = write_step(tied.groupBy("cls").agg(F.count("*").alias("shared"), F.first("n").alias("n"))
                       .filter(enough).select("cls"), "jaccard-alive")
    drop_step(left, pivots)
    # The pivot itself may have dropped out; it then only names the group.
    return tied.join(alive, "cls").select(F.col("cls").alias("a"), F.col("pivot").alias("b")).filter("a <> b").distinct()


def shared_least_sql(n: str, percent: int):
    return 1 + F.floor(F.ceil(F.col(n) * percent / 100) / 8)


def _places(members: DataFrame, percent: int, block_bytes: int) -> DataFrame:
    """``members`` with ``places``: where the set of a class is compared.  Small
    groups share bins; a large one is cut by set size into bands so that similar
    sets lie in one band or in neighbouring ones, and a heavy band into blocks."""
    weight = write_step(members.groupBy("comp").agg(F.sum("n").alias("w")), "jaccard-weights")
    small = weight.filter(F.col("w") * 8 <= block_bytes).agg(F.sum("w")).first()[0] or 0
    n_bins = max(1, -(-8 * small // block_bytes))
    step = -float(np.log(percent / 100 - 0.001))
    wide = write_step(members.join(weight, "comp").withColumn("band", F.floor(F.log("n") / step)).withColumn(
        "at", F.explode(F.when(F.col("w") * 8 <= block_bytes, F.array(F.struct(
            F.pmod(F.xxhash64("comp"), F.lit(n_bins)).alias("grp"), F.lit(-2).cast("long").alias("unit"),
            F.lit(False).alias("later")))).otherwise(F.array(
                F.struct(F.col("comp").alias("grp"), F.col("band").alias("unit"), F.lit(False).alias("later")),
                F.struct(F.col("comp").alias("grp"), (F.col("band") - 1).alias("unit"), F.lit(True).alias("later"))))))
        .select("id", "cls", "docs", "n", "at.*"), "jaccard-units")
    heavy = write_step(wide.filter("unit > -2").groupBy("grp", "unit").agg(
        F.ceil(F.sum("n") * 8 / block_bytes).alias("blocks")).filter("blocks > 1"), "jaccard-heavy")
    placed = write_step(
        wide.join(heavy, ["grp", "unit"], "left").groupBy("id", "cls", "docs").agg(F.collect_list(F.struct(
            "grp", "unit", "later", F.coalesce("blocks", F.lit(1)).alias("blocks"))).alias("places")), "jaccard-places")
    drop_step(weight, wide, heavy)
    return placed


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                       percent: int = PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id_col, n_shingles, n_links, component_id)`` for every row of ``docs``;
    ``n_links`` counts the other documents that it is linked with."""
    return _rows_with_components(docs, id_col, text_col, width, percent, block_bytes).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "n_links", "component_id")


def _rows_with_components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, block_bytes: int) -> DataFrame:
    """(id, version, n, root, n_links, component_id) for every row; ``version``: a hash
    of its text, ``root``: a name of its group (two groups can have one smallest id)."""
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    profile = write_step(source.mapInArrow(_profile("text", "id", width),
                                           f"kind int, id {id_type}, version bigint, cls bigint, n bigint"), "jaccard-profile")
    freq = np.zeros(1 << BUCKET_BITS, np.int64)
    for bucket, count in profile.filter("kind = 1").groupBy("cls").agg(F.sum("n")).collect():  # 2**16 rows at most
        freq[bucket] = count
    shared = spark.sparkContext.broadcast(freq)
    rows = profile.filter("kind = 0").select("id", "version", "cls", "n")

    grams = source.filter("id is not null").select("text").mapInArrow(
        _prefix_rows(shared, width, percent), "gram bigint, salt int, cls bigint, n int")
    near = write_step(_near(grams, percent), "jaccard-near")
    groups = components(near)

    classes = write_step(rows.filter("id is not null and n > 0").groupBy("cls", "id").agg(F.first("n").alias("n")).groupBy("cls").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.count("*").alias("docs")), "jaccard-classes")
    members = write_step(classes.join(groups.withColumnRenamed("node", "cls"), "cls"), "jaccard-members")
    drop_step(near, groups)
    placed = _places(members, percent, block_bytes)
    drop_step(members)
    # The same sort-merge join at every size.
    sets = source.join(placed.hint("merge"), "id").select("cls", "docs", "places", "text").mapInArrow(
        _class_sets(width),
        "cls bigint, docs bigint, places array<struct<grp:bigint,unit:bigint,later:boolean,blocks:bigint>>, grams binary")
    tasks = sets.withColumn("at", F.explode("places")).select("cls", "docs", "grams", "at.*") \
        .withColumn("side", F.pmod(F.xxhash64("cls"), F.col("blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .select("grp", "unit", F.least("side", "other").alias("bi"), F.greatest("side", "other").alias("bj"),
                "side", "later", "cls", "docs", "grams")
    links = write_step(tasks.groupBy("grp", "unit", "bi", "bj").applyInArrow(
        _verify(shared, percent), "a bigint, b bigint, links bigint"), "jaccard-links")
    linked = components(links.filter("b is not null"))
    counts = links.filter("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    degrees = write_step(classes.join(counts, "cls", "left").select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("docs") - 1).alias("n_links")), "jaccard-degrees")
    drop_step(links, placed, classes)

    least = rows.filter("id is not null").groupBy("cls").agg(F.min("id").alias("least"))
    rooted = write_step(least.join(linked, F.col("cls") == F.col("node"), "left")
                        .select("cls", "least", F.coalesce("comp", "cls").alias("root")), "jaccard-roots")
    firsts = write_step(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "jaccard-firsts")
    names = write_step(rooted.join(firsts, "root").join(degrees, "cls", "left")
                       .select("cls", "root", "component_id", "n_links"), "jaccard-names")
    drop_step(linked, rooted, firsts, degrees)
    return rows.join(names, "cls", "left").select(
        "id", "version", "n", "root",
        F.coalesce(F.when(F.col("id").isNotNull(), F.col("n_links")), F.lit(0)).alias("n_links"),
        F.when(F.col("n") == 0, F.col("id")).when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row of each linked group stays: one with the smallest id, and of the
    texts that this id has in the group the one of the smallest hash; of rows that
    repeat an id and a text, one.  Rows without words are linked with nothing, and
    rows without an id take no part: each text of the former and all of the latter stay."""
    found = _rows_with_components(docs, id_col, text_col, width, percent, BLOCK_BYTES).filter("id = component_id")
    stays = write_step(
        found.groupBy("id", "root", F.when(F.col("n") == 0, F.col("version")).alias("bare")).agg(
            F.min("version").alias("version")).select("id", "version"), "jaccard-stays")
    # The columns of the input as one struct: none of its names can meet ours.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"))
    # The same sort-merge join at every size; its layout serves the window too.
    joined = rows.join(stays.withColumn("stays", F.lit(True)).hint("merge"), ["id", "version"], "left").filter("id is null or stays")
    again = Window.partitionBy("id", "version").orderBy(F.xxhash64("row"))
    return joined.withColumn("nth", F.row_number().over(again)).filter("id is null or nth = 1").select("row.*")
