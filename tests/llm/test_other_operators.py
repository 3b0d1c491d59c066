"""Mixing, top-k search, sharding, extraction, classifiers, pipeline."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from setsim.llm import (
    decontaminate,
    html_dom,
    html_extract,
    jaccard_join,
    langid,
    mixing,
    quality,
    sharding,
    topk_search,
)
from setsim.llm.common import table
from setsim.session import scratch_path

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


# -- mixing ------------------------------------------------------------------

def plain_copies(rows, seed=17):
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len((text or "").encode()) + 1
    scale, total = sum(math.sqrt(s) for s in size.values()), sum(size.values())
    out, seen = Counter(), Counter()
    for doc, text, source in rows:
        rate = math.sqrt(size[source]) / scale * total / size[source]
        name = f"{seed}:{'' if doc is None else doc}:{hashlib.md5((text or '').encode()).hexdigest()}"
        seen[name] += 1
        name += f":{seen[name]}" if seen[name] > 1 else ""
        u = int(hashlib.md5(name.encode()).hexdigest()[:13], 16) / 2 ** 52
        n, p, below = 0, math.exp(-rate), math.exp(-rate)
        while below <= u:
            n += 1
            p *= rate / n
            below += p
        out.update((doc, c) for c in range(1, n + 1))
    return out


def test_mixing_edges(edge, none):
    got = mixing.mix_sources(edge)
    assert set(edge.columns) <= set(got.columns) | {"copy"}
    want = plain_copies([(r["doc_id"], r["text"], r["source"]) for r in edge.collect()])
    assert Counter((r["doc_id"], r["copy"]) for r in got.collect()) == want
    assert mixing.mix_sources(none).count() == 0


def test_mixing_meets_given_weights(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.format_string("text %06d", "id").alias("text"),
                                    F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    got = mixing.mix_sources(rows, weights={"hot": 1.0, "s0": 1.0, "s1": 2.0, "gone": 5.0}, epochs=2.0)
    share = {r["source"]: r["count"] / 12000 for r in got.groupBy("source").count().collect()}
    assert set(share) == {"hot", "s0", "s1"}
    assert abs(share["hot"] - 0.25) < 0.02 and abs(share["s1"] - 0.5) < 0.03
    first = [r["doc_id"] for r in got.limit(50).collect()]
    assert first != sorted(first)


def test_equal_rows_are_drawn_each_for_itself(spark):
    """A third of all rows equal in id and text: their source keeps its share of the bytes."""
    rows = [(None, "the same text", "a")] * 4000 + [(i, f"text {i:08d}", "b") for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix_sources(df).collect()
    size = {s: sum(len(t) + 1 for _, t, x in rows if x == s) for s in "ab"}
    for s in "ab":
        target = math.sqrt(size[s]) / sum(map(math.sqrt, size.values())) * sum(size.values())
        copies = target / size[s] * sum(x == s for *_, x in rows)
        mixed = sum(len(r["text"]) + 1 for r in got if r["source"] == s)
        # Five standard errors of a Poisson number of copies.
        assert abs(mixed / target - 1) < 5 / math.sqrt(copies)
    assert Counter((r["doc_id"], r["copy"]) for r in got) == plain_copies(rows)
    # Their copies are spread over the order too.
    assert len({r["shuffle_key"] for r in got}) == len(got)


def test_mixing_keeps_columns_of_clashing_names(spark):
    names = ["name", "u", "times", "nth", "mark", "task", "place", "row", "_mix_source", "_rate", "_low", "_steps", "before", "count"]
    df = spark.createDataFrame([(i % 3, "t", "s") for i in range(30)], "doc_id long, text string, source string")
    for k, n in enumerate(names):
        df = df.withColumn(n, F.lit(k))
    got = mixing.mix_sources(df, epochs=3.0)
    assert got.count() > 0 and set(got.columns) == {*df.columns, "copy", "shuffle_key"}
    assert all(r[n] == k for r in got.collect() for k, n in enumerate(names))


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0, 7.5, 900.0])
def test_poisson_steps(rate):
    low, steps = mixing.poisson_steps(rate)
    u = (np.arange(20000) + 0.5) / 20000
    n = low + np.searchsorted(steps, u, side="right")
    assert abs(n.mean() - rate) < 0.01 * max(1, rate) and abs(n.var() - rate) < 0.02 * max(1, rate)


# -- top-k search -------------------------------------------------------------

def plain_topk(rows, k=5):
    v = {}
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            v[i] = [math.floor(256 * c) for c in x]
    out = {}
    for q in (i for i in v if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=False)), c) for c in v if c != q)[:k]
        out |= {(q, r): (c, -s) for r, (s, c) in enumerate(best, 1)}
    return out


def check_topk(got, rows):
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got.collect()} == plain_topk(rows)


def test_topk_edges(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=6)]) for i in range(330)]
    hot = [0.5, -1.0, 2.0, 0.0, 0.25, 1.0]
    rows += [(i, hot) for i in range(330, 560)]
    rows += [(600, None), (650, []), (700, [1.0, None]), (750, [float("nan")]), (800, [float("inf")] * 6), (None, hot),
             (850, [1.0, 2.0]), (851, [0.0] * 6), (900, [0.0] * 6), (950, [-x for x in hot])]
    df = spark.createDataFrame([*rows, rows[3], rows[400]], "vec_id long, embedding array<double>")
    df = df.withColumn("rep", F.lit(1)).withColumn("v", F.lit(2))
    for n_lists in (2, 3):
        check_topk(topk_search.exact_topk(df, n_lists=n_lists), rows)
    assert topk_search.exact_topk(df.filter("false")).count() == 0
    check_topk(topk_search.exact_topk(df.filter("vec_id in (0, 7, 50)")), [rows[0], rows[7], rows[50]])


def test_scores_that_may_pass_64_bits_are_an_error(spark):
    big = float(2 ** 28)
    rows = [(0, [big, big]), (1, [big, big]), (2, [big / 2, 1.0])]
    df = lambda r: spark.createDataFrame(r, "vec_id long, embedding array<double>")
    with pytest.raises(OverflowError):
        topk_search.exact_topk(df(rows))
    with pytest.raises(OverflowError):
        topk_search.exact_topk(df([(0, [1e300]), (1, [1.0])]))
    check_topk(topk_search.exact_topk(df(fits := [(0, [2.0 ** 16, 2.0 ** 16]), (1, [big, 1.0]), (2, [1.0, big]), (3, [-big, big])])), fits)


def test_partial_scores_stay_exact_beyond_doubles():
    q = np.array([[2 ** 31 + 1, 3]])
    assert topk_search.partial_scores(q, q)[0, 0] == (2 ** 31 + 1) ** 2 + 9


def test_topk_sends_no_vectors_through_the_driver(spark, monkeypatch):
    """The queries, once for each block of rows, grow with the square of the rows."""
    plans = []

    def written(df, name, write=topk_search.write_step):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    for name, to in (("write_step", written), ("ROW_BLOCK", 64), ("QUERY_BLOCK", 4)):
        monkeypatch.setattr(topk_search, name, to)
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(size=4)]) for i in range(700)]
    check_topk(topk_search.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)
    joins = [x for plan in plans for x in plan.splitlines() if "Join [list" in x]
    assert len(joins) >= 6 and not [x for x in joins if "Broadcast" in x]


@pytest.mark.parametrize(("scale", "n_lists"), [(0.4, 1), (100.0, 4), (2.0 ** 14, 2), (2.0 ** 20, 2)])
def test_topk_with_small_blocks_and_components_of_any_width(spark, monkeypatch, scale, n_lists):
    monkeypatch.setattr(topk_search, "ROW_BLOCK", 32)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 2)
    r = np.random.default_rng(11)
    rows = [(i, [float(x) * scale for x in r.integers(-5, 6, size=5)]) for i in range(300)] + [(2 ** 40, [scale] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_topk(topk_search.exact_topk(df, n_lists=n_lists), rows)


@pytest.mark.parametrize("most", [0, 127, 128, 2 ** 15 - 1, 2 ** 15, 2 ** 31, 2 ** 62])
def test_packed_integers_come_back(most):
    for x in ([most, -most], [-most - 1, 0], [most], []):
        x = np.array(x, np.int64)
        assert topk_search._from_bytes(topk_search._to_bytes(x)).tolist() == x.tolist()


# -- sharding -----------------------------------------------------------------

def key(value) -> int:
    return int(hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()[:15], 16)


def check_shards(df, n, part_bytes=1 << 30, tolerance=0.02):
    rows = sharding.shard(df, n, part_bytes=part_bytes, tolerance=tolerance).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in df.collect())
    by_shard = defaultdict(list)
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        by_shard[r["shard"]].append(r)
    total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for s, members in by_shard.items():
        assert 0 <= s < n and sorted(r["slot"] for r in members) == list(range(len(members)))
        assert sum(r["size"] for r in members) <= total / n * (1 + 2 * tolerance) + most
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    keys = [(key(r["text"]), key(r["doc_id"])) for r in ordered]
    assert keys == sorted(keys)
    return by_shard


def test_sharding_edges(edge, none, docs):
    check_shards(edge, 4)
    check_shards(docs, 40)
    assert sharding.shard(none).count() == 0
    path = scratch_path(docs.sparkSession, "t_shards")
    sharding.write_shards(sharding.shard(docs, 8), path)
    back = docs.sparkSession.read.parquet(path)
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 8
    import zlib
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    report = sharding.shard_digest(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in report) == texts
    assert {(r["law"], r["grown_shard"]) for r in report} == {("bytes", None)}
    shard_bytes, total = Counter(), sum(r["size"] for r in report)
    for r in report:
        shard_bytes[r["shard"]] += r["size"]
    for s in shard_bytes:
        assert sorted(r["slot"] for r in report if r["shard"] == s) == list(range(sum(r["shard"] == s for r in report)))
    most = max(r["size"] for r in report)
    assert set(shard_bytes) <= set(range(40)) and all(abs(x - total / 40) <= 2 * 0.02 * total / 40 + most for x in shard_bytes.values())
    digest = sharding.shard_digest(edge)
    assert digest.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_sharding_splits_a_hot_group_only(spark):
    rows = [(i, "same text " * 3 if i % 3 else f"other {i}") for i in range(900)] + [(None, None), (5000, ""), (5001, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for part_bytes in (1 << 30, 500):
        shards = check_shards(df, 10, part_bytes)
        sizes = [sum(r["size"] for r in m) for m in shards.values()]
        assert max(sizes) < 1.05 * sum(sizes) / 10
    pairs = spark.createDataFrame([(i, f"text {i // 2}") for i in range(2000)], "doc_id long, text string")
    of = {r["doc_id"]: r["shard"] for r in sharding.shard(pairs, 7).collect()}
    assert all(of[i] == of[i + 1] for i in range(0, 2000, 2))


def test_sharding_splits_a_group_of_equal_rows(spark):
    rows = [(i, f"other {i}") for i in range(600)] + [(None, "same text")] * 300 + [(7, "mixed copies of one document")] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for part_bytes in (1 << 30, 500):
        shards = check_shards(df, 10, part_bytes)
        sizes = [sum(r["size"] for r in m) for m in shards.values()]
        assert len(sizes) == 10 and max(sizes) < 1.05 * sum(sizes) / 10


def test_splitters_equal_a_plain_prefix_sum(spark):
    """Many ranges at once, against the sorted rows."""
    r = np.random.default_rng(8)
    rows = [(i, "x" * int(r.integers(0, 60)) + str(i % 700)) for i in range(3000)]
    keys = sharding.keyed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    total = sum(len(t) + 16 for _, t in rows)
    ordered = sorted((key(t), key(i), len(t) + 16) for i, t in rows)
    ends = np.cumsum([x[2] for x in ordered])
    for n_parts in (7, 400):
        found = sharding.find_splitters(keys, n_parts, total, 0.0)
        for k, s in enumerate(found, 1):
            # No other place between two rows is nearer to the target.
            below = 0 if s.rows_below == 0 else int(ends[s.rows_below - 1])
            best = min(abs(int(e) - total * k / n_parts) for e in [0, *ends])
            assert abs(abs(below - total * k / n_parts) - best) < 1e-6
            assert s.rows_below == sum((a, b) < (s.text, s.row) for a, b, _ in ordered) + s.copies


# -- extraction -----------------------------------------------------------------

@pytest.fixture(scope="module")
def trees():
    return html_extract.fit_trees()


def extract(trees, html):
    page = html_dom.parse(html)
    return html_dom.extract(page, html_extract.decode(page, trees.log_odds(html_dom.node_features(page))))


def test_extraction_of_unseen_grammar_pages(trees):
    writer, right, total, exact = html_extract._Writer(77), 0, 0, 0
    for _ in range(120):
        page = html_dom.parse(writer.page())
        want = html_extract.node_labels(page)
        got = html_extract.decode(page, trees.log_odds(html_dom.node_features(page)))
        right, total = right + (got == want).sum(), total + len(want)
        exact += html_dom.extract(page, got) == html_dom.extract(page, want.astype(bool))
    assert right / total > 0.98 and exact > 100


def test_decoding_never_keeps_a_child_without_its_parent():
    page = html_dom.parse("<div><p>a<b>c</b></p></div><div>d</div>")
    r = np.random.default_rng(2)
    for _ in range(200):
        odds = r.normal(size=len(page.tag))
        keep = html_extract.decode(page, odds)
        assert all(keep[page.parent[i]] for i in range(1, len(keep)) if keep[i])
        n = len(odds)
        best = max(sum(o for o, k in zip(odds, bits, strict=True) if k) for bits in (
            [b >> i & 1 for i in range(n)] for b in range(2 ** n))
            if all(bits[page.parent[i]] or not bits[i] for i in range(1, n)))
        assert math.isclose(max(0, best), odds[keep].sum(), abs_tol=1e-9)


def test_extraction_of_the_pages(spark, trees):
    pages = table(spark, SF, "pages")
    for r in html_extract.extract_text(pages, trees).collect():
        body = r["html"].partition("<article>")[2].partition("</article>")[0]
        page = html_dom.parse(f"<article>{body}</article>")
        assert r["text"] == html_dom.extract(page, np.ones(len(page.tag), bool)) and r["n_chars"] == len(r["text"])


def test_extraction_edges(spark, trees):
    cases = {1: None, 2: "", 3: "   ", 4: "<", 5: "<p", 6: "<!-- never closed <p>x</p>", 7: "</div></p>", 8: "<a href='x",
             9: "<div>" * 3000 + "deep", 10: "<script>var a = '<p>no</p>'", 11: "&#0; &amp &bogus; &#x41;", 12: "<p>a\n b&nbsp;c<br>d</p>"}
    df = spark.createDataFrame(list(cases.items()), "page_id long, html string").withColumn("text", F.lit("x")).withColumn("block", F.lit(1))
    got = {r["page_id"]: r for r in html_extract.extract_text(df, trees).collect()}
    assert got[1]["text"] == got[2]["text"] == got[3]["text"] == got[10]["text"] == "" and got[1]["n_chars"] == 0
    assert set(got) == set(cases)
    page = html_dom.parse("<article><h1>T &amp; U</h1><p>a\n b<br>c<p>d</article>")
    assert html_dom.extract(page, np.ones(len(page.tag), bool)) == "T & U\na b c\nd"
    assert html_extract.extract_text(df.filter("false"), trees).count() == 0


def test_no_hard_rule_drops_article_text(trees):
    def whole(html):
        page = html_dom.parse(html)
        return html_dom.extract(page, np.ones(len(page.tag), bool))

    head = "<html><head><title>no</title><meta charset=utf-8><script>no</script><style>no</style>"
    assert whole(head + "<article><p>One.<p>Two.</article>") == "One.\nTwo."
    assert whole(head + "<noscript><style>no</style><img src=x>no</noscript><link href=x><h1>T</h1>") == "T"
    assert whole(head + "\n Words at once <p>One.") == "Words at once\nOne."
    assert whole(head + "</head><body><p>One.") == whole(head + "<body><p>One.") == "One."
    assert whole("<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p>") == "If x=2 then"
    assert whole("<p>a <svg><title>no</title><text>b</text></svg> <noscript>c</noscript></p>") == "a b c"
    page = html_extract._Writer(5).page()
    bare = page.replace("</head>", "").replace("<body>", "")
    assert extract(trees, page) and (bare == page or extract(trees, bare) == extract(trees, page))


def test_hand_written_pages_give_hand_written_text():
    """References, white space and blocks, against text written by hand."""
    pages = {
        "<p>caf&eacute; &amp; th&#233; &#x1F600; &lt;b&gt; &amp;lt;</p>": "café & thé 😀 <b> &lt;",
        "<h1>  One\n\ttwo </h1>\n\n<p>three<p>  four": "One two\nthree\nfour",
        "<ul><li>a<li>b <em>c</em>d</ul><p></p><p> </p>e": "a\nb cd\ne",
        "<div>out<div>in</div>after</div>": "out\nin\nafter",
        "<p>x<!-- no -->y<script>z()</script><style>q{}</style></p>": "xy",
        "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>": None,
        "<blockquote><p>He said <i>no</i>.</p></blockquote><h2>End</h2>": "He said no.\nEnd",
        "": "",
    }
    for html, want in pages.items():
        page = html_dom.parse(html)
        got = html_dom.extract(page, np.ones(len(page.tag), bool))
        if want is None:  # cells: their order, whichever way they are joined
            assert got.split() == ["1", "2", "3"]
        else:
            assert got == want, html


# -- classifiers ------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    got = quality.quality_digest(table(spark, sf, "documents"), labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95 and ((got.score >= 0.7) == (got.predicted == 1)).all()


def test_quality_never_learns_from_held_out_rows(spark):
    from setsim.llm.common import held_out
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.fit_quality(docs, x) for x in (labels, flipped))
    assert np.array_equal(one.weights, two.weights) and one.cut == two.cut


def test_quality_fit_and_score_restated_with_plain_loops(spark):
    """Gradient descent on the same pairs, a loop for the cut and for every score."""
    r = np.random.default_rng(4)
    good = [" ".join("abcdefgh"[int(x)] * int(r.integers(2, 9)) for x in r.integers(0, 8, 40)) + "." for _ in range(30)]
    bad = [" ".join("|#" * int(r.integers(1, 4)) + "zz" for _ in range(int(r.integers(3, 30)))) for _ in range(20)]
    good[:3], bad[:3] = bad[3:6], good[3:6]  # labels that the texts contradict
    x1, x0 = quality.feature_matrix([t.encode() for t in good]), quality.feature_matrix([t.encode() for t in bad])
    share = 0.3
    model = quality.fit_pairs(x1, x0, share, n_pairs=800, ridge=1.0, seed=7)
    both = [list(row) for row in [*x1, *x0]]
    width = len(both[0])
    mean = [sum(row[k] for row in both) / len(both) for k in range(width)]
    spread = [math.sqrt(sum((row[k] - mean[k]) ** 2 for row in both) / len(both)) + 1e-6 for k in range(width)]
    norm = [[max(-6.0, min(6.0, (row[k] - mean[k]) / spread[k])) for k in range(width)] for row in both]
    draw = np.random.default_rng(7)
    left, right = draw.integers(len(good), size=800), draw.integers(len(bad), size=800)
    pairs = [[a - b for a, b in zip(norm[i], norm[len(good) + j], strict=True)] for i, j in zip(left, right, strict=True)]

    def slope_at(w):
        out = [-x for x in w]
        for d in pairs:
            lose = 1 / (1 + math.exp(min(30, max(-30, sum(a * b for a, b in zip(d, w, strict=True))))))
            out = [o + lose * a for o, a in zip(out, d, strict=True)]
        return out

    # The loss is convex: where its slope is nil stands the only best fit.
    assert max(map(abs, slope_at(model.weights.tolist()))) < 1e-4
    raw = [sum(a * b for a, b in zip(row, model.weights, strict=True)) for row in norm]
    weights = [(1 - share) / len(good)] * len(good) + [share / len(bad)] * len(bad)
    below, cut = 0.0, None
    for s, w in sorted(zip(raw, weights, strict=True)):
        below += w
        if cut is None and below >= share - 1e-12:
            cut = s
    assert math.isclose(model.cut, cut, abs_tol=1e-9)
    for row, s, got in zip(both, raw, model.score(np.array(both)), strict=True):
        z = max(-30.0, min(30.0, model.slope * (s - cut)))
        assert math.isclose(got, 1 / (1 + math.exp(-z) * 0.3 / 0.7), abs_tol=1e-9) and (got >= 0.7 - 1e-12) == (s >= cut - 1e-12)


def test_quality_fit_takes_every_labelled_row_and_every_pair(spark):
    """The loss over all pairs is least at the weights found, the cut is the exact
    quantile of all scores; 60 labelled rows make 900 pairs, none drawn twice."""
    from setsim.llm.common import held_out
    r = np.random.default_rng(9)
    kinds = [lambda: " ".join("abcdefgh"[int(x)] * int(r.integers(2, 9)) for x in r.integers(0, 8, 30)) + ".",
             lambda: " ".join("|#" * int(r.integers(1, 4)) + "zz" for _ in range(int(r.integers(3, 30))))]
    texts = [(i, kinds[(i + (i % 9 == 0)) % 2]()) for i in range(80)]  # some that their labels contradict
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    learnt = {x[0] for x in labels.filter(~held_out(F.col("doc_id"))).select("doc_id").collect()}
    x = quality.feature_matrix([t.encode() for i, t in texts if i in learnt])
    good = np.array([i % 2 == 0 for i, _ in texts if i in learnt])
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-8) and np.allclose(model.scale, x.std(axis=0) + 1e-6, atol=1e-8)
    z = np.clip((x - model.mean) / model.scale, -6, 6)
    pairs = (z[good][:, None, :] - z[~good][None, :, :]).reshape(-1, x.shape[1])
    lose = 1 / (1 + np.exp(pairs @ model.weights))
    slope = quality.N_PAIRS / len(pairs) * (pairs.T @ lose) - model.weights
    assert np.abs(slope).max() < 0.05  # of a loss of 60,000 pairs; a draw of them misses by tens
    s = np.sort(z @ model.weights)
    assert math.isclose(model.cut, s[int((~good).sum())], abs_tol=1e-9)


def test_quality_cut_among_equal_scores_and_many_rows(spark):
    """More rows than are fetched at once; the cut is found whether scores repeat or not."""
    rows = spark.range(20_000).selectExpr("cast(id % 2 as int) label", "array(cast(floor(id / 4) as double)) x").repartition(5)
    for width, want in ((1, 2500.0), (5000, 0.0)):
        got = quality._cut(rows, lambda x: x[:, 0] // width, 6000.0, np.array([0.5, 0.5]) / 10_000, 0.5)
        assert abs(got - want) < 1e-8


def test_fits_do_not_depend_on_the_order_of_rows(spark):
    """Several texts under one id: the same one is taken wherever the rows lie."""
    texts = ["plain words in a row", "| # | # zz", "other words, more of them here", "|||| #### zz zz"]
    rows = [(i, texts[(i + k) % 4] + f" {k}", "ab"[i % 2]) for i in range(60) for k in range(3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    fits = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(3)
        q, lang = quality.fit_quality(docs, labels), langid.fit_language(docs)
        fits.append((q.weights, q.cut, lang.weights, lang.temperature))
    assert all(np.array_equal(a, b) for a, b in zip(*fits, strict=True))


def test_quality_edges(spark, edge, none):
    labels = spark.createDataFrame([(i, q) for i, q in [(1, 1), (2, 1), (4, 0), (4, 1), (6, 0), (9, None), (None, 1), (15, 0), (16, 1)]],
                                   "doc_id long, quality int")
    got = quality.score_quality(edge, quality.fit_quality(edge, labels))
    assert got.count() == 21 and got.filter("score between 0 and 1").count() == 21 and set(edge.columns) <= set(got.columns)
    assert quality.fit_quality(edge, labels.filter("quality = 1")) is None
    assert quality.keep_good(edge, labels.filter("false")).count() == 21
    assert quality.quality_digest(none, labels).count() == 0


def test_language_on_held_out_rows(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97


def test_language_fit_and_score_restated_with_plain_loops():
    """FTRL-proximal with one weight at a time, from dictionaries."""
    grams = langid.Grams()
    texts = [("the house and the tree", 0), ("das haus und der baum", 1), ("a house in the wood", 0), ("ein haus im wald", 1),
             ("the tree of the wood", 0), ("der baum im wald", 1)]
    counts = [grams.counts(t.encode()) for t, _ in texts]
    df = np.sum([c > 0 for c in counts], axis=0)
    idf = np.log((1 + len(texts)) / (1 + df)) + 1
    rows = [(*langid.tfidf(c, idf), y) for c, (_, y) in zip(counts, texts, strict=True)]
    weights, bias = langid.ftrl(rows, 2, alpha=0.5, beta=1.0, l1=0.02, l2=0.05, epochs=3, seed=7)

    plain = []  # TF-IDF by dictionaries
    for c, (_, y) in zip(counts, texts, strict=True):
        v = {k: math.log1p(int(c[k])) * (math.log((1 + len(texts)) / (1 + int(df[k]))) + 1) for k in range(len(c)) if c[k]}
        size = math.sqrt(sum(x * x for x in v.values()))
        plain.append(({k: x / size for k, x in v.items()} | {"bias": 1.0}, y))
    z, n = defaultdict(float), defaultdict(float)

    def weight(k, j):
        lasso = 0.0 if k == "bias" else 0.02
        if abs(z[k, j]) <= lasso:
            return 0.0
        return -(z[k, j] - math.copysign(lasso, z[k, j])) / ((1.0 + math.sqrt(n[k, j])) / 0.5 + 0.05)

    def chances(v):
        e = [math.exp(sum(x * weight(k, j) for k, x in v.items())) for j in range(2)]
        return [x / sum(e) for x in e]

    order = np.random.default_rng(7)
    for _ in range(3):
        for i in order.permutation(len(plain)):
            v, y = plain[i]
            p = chances(v)
            before = {(k, j): weight(k, j) for k in v for j in range(2)}
            for k, x in v.items():
                for j in range(2):
                    g = x * (p[j] - (j == y))
                    z[k, j] += g - (math.sqrt(n[k, j] + g * g) - math.sqrt(n[k, j])) / 0.5 * before[k, j]
                    n[k, j] += g * g
    for k in {k for v, _ in plain for k in v if k != "bias"}:
        assert all(math.isclose(weights[k, j], weight(k, j), abs_tol=1e-5) for j in range(2))
    assert all(math.isclose(bias[j], weight("bias", j), abs_tol=1e-9) for j in range(2))
    assert np.count_nonzero(weights.any(axis=1)) <= len({k for v, _ in plain for k in v})
    model = langid.LanguageModel(["en", "de"], idf, weights, bias, 1.5)
    for (v, _), c in zip(plain, counts, strict=True):
        e = [math.exp(sum(x * weight(k, j) for k, x in v.items()) / 1.5) for j in range(2)]
        lang, score = model.predict(c)
        assert lang == ["en", "de"][e.index(max(e))] and math.isclose(score, max(e) / sum(e), abs_tol=1e-5)


def test_language_fit_holds_only_the_columns_in_use(spark):
    """10,000 one-line texts in one task: a dense row each would take 2.6 GB."""
    import resource
    docs = spark.range(10_000).select(F.col("id").alias("doc_id"), F.format_string("line number %d of the text", "id").alias("text"),
                                      F.when(F.col("id") % 2 == 0, "en").otherwise("xx").alias("lang")).coalesce(1)
    from pyspark.sql import DataFrame
    assert isinstance(docs, DataFrame)
    model = langid.fit_language(docs, max_docs=8000)

    def peak(batches):
        import pyarrow as pa
        for b in batches:
            pass
        yield pa.RecordBatch.from_pydict({"kb": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss]})

    worst = max(r["kb"] for r in spark.range(8).repartition(8).mapInArrow(peak, "kb long").collect())
    assert model is not None and worst < 1 << 20  # 1 GB in any Python worker, this one included


def test_language_edges(spark, edge, none):
    got = {r["doc_id"]: r for r in langid.identify_language(edge, langid.fit_language(edge)).collect()}
    assert len(got) == 20 and got[6]["lang_pred"] == got[7]["lang_pred"] == got[8]["lang_pred"] == "und"
    assert got[1]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.language_digest(none).count() == 0
    assert langid.identify_language(edge, langid.fit_language(edge.filter("lang is null"))).filter("lang_pred = 'und'").count() == 21


def test_temperature_lowers_the_loss():
    r = np.random.default_rng(0)
    y = r.integers(0, 3, 500)
    logits = 9 * (np.eye(3)[y] + r.normal(size=(500, 3)))
    t = langid.fit_temperature(logits, y)
    loss = lambda z: float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(500), y]).mean())
    assert t > 1 and loss(logits / t) < min(loss(logits), loss(logits / (1.1 * t)), loss(logits / (0.9 * t))) + 1e-12


# -- pipeline ---------------------------------------------------------------------

def test_pipeline_is_its_stages(spark, docs):
    labels, benchmark = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    good = {r["doc_id"] for r in quality.quality_digest(docs, labels).filter("predicted = 1").collect()}
    left = docs.filter(F.col("doc_id").isin(list(good)))
    joined = jaccard_join.jaccard_components(left, width=corpus_pipeline.NEAR_SHINGLE, percent=corpus_pipeline.NEAR_PERCENT)
    left = left.filter(F.col("doc_id").isin([r["doc_id"] for r in joined.filter("doc_id = component_id").collect()]))
    dirty = decontaminate.contamination_digest(left, benchmark).filter("contaminated").collect()
    left = left.filter(~F.col("doc_id").isin([r["doc_id"] for r in dirty]))
    want = plain_copies([(r["doc_id"], r["text"], r["source"]) for r in left.collect()])
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(doc for doc, _ in want.elements())
    assert {r["shard"] for r in rows} <= set(range(40))


def test_pipeline_stages_keep_the_columns(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter("false"), SF).count() == 0


def test_near_duplicates_are_judged_at_five_words_and_four_fifths(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    sets = {r["doc_id"]: brute.shingles(r["text"], 5) for r in docs.collect()}
    group = {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in holders[g]).items():
            if 10 * n >= 8 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(i)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.keep_distinct(spark, docs, "").collect())
    assert kept == sorted({find(i) for i in sets}) and len(kept) < jaccard_join.keep_first(docs).count()
