"""Operators 11 to 13 against plain restatements."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMOKE
from setsim.llm import catalog, ranked_search, token_align, toxicity
from setsim.llm.common import table

from .conftest import DOCS, prose

FOLD = {c: c + 32 for c in range(65, 91)}


# -- 11: cross-tokenizer alignment ------------------------------------------------------

@pytest.fixture(scope="module")
def encoders():
    with open(f"{token_align.TOKENIZER_DIR}/{token_align.BYTE_BPE}", encoding="utf-8") as f:
        a = f.read()
    with open(f"{token_align.TOKENIZER_DIR}/{token_align.PIECE_BPE}", "rb") as f:
        b = f.read()
    return token_align.Encoders(a, b)


def plain_tokens(e, text):
    """Both token sequences of the whole text, encoded in one go; None where there are none."""
    if not text:
        return None
    whole = (" " + text).encode()
    a, b = e.a.encode(" " + text, add_special_tokens=False).ids, e.b.encode(text)
    # The bytes from the tokenizers' own decoding tables, not from the operator's.
    chars = token_align.byte_level_alphabet()
    a_raw = [bytes(chars[c] for c in e.a.id_to_token(i)) for i in a]
    b_raw = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and e.b.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in ((i, e.b.id_to_piece(i)) for i in b)]
    return (a, a_raw, b, b_raw) if b"".join(a_raw) == whole == b"".join(b_raw) else None


def plain_alignment(e, docs):
    rows, links, count = {}, {}, Counter()
    for doc, text in docs:
        got = plain_tokens(e, text)
        links[doc] = []
        if got is None:
            rows[doc] = [0, 0, 0, ""]
            continue
        a, a_raw, b, b_raw = got
        a_end, b_end = np.cumsum([len(x) for x in a_raw]).tolist(), np.cumsum([len(x) for x in b_raw]).tolist()
        both, groups, x, y = set(a_end) & set(b_end), [], 0, 0
        for end in sorted(both):
            i, j = a_end.index(end) + 1, b_end.index(end) + 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
            x, y = i, j
            links[doc].append((a[i - 1], b[j - 1]))
        count.update(links[doc])
        rows[doc] = [len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()]
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return {doc: (n_a, n_b, n_groups, n_groups, sum(count[p] == best[p[1]] for p in links[doc]), sum(count[p] for p in links[doc]), h)
            for doc, (n_a, n_b, n_groups, h) in rows.items()}


ODD = ["<|endoftext|> a <s> b </s>", "a▁b", "<0x0A> x", "\n\n  two\tlines \r\n end ", " lead", "trail ", "日本語 テキスト 漢字", "naïve café — “quoted”",
       "😀 emoji 👩‍👩‍👧 z", "it's we'll don't I'd", "x" * 5000, "a  b   c", " nb sp", "\u0085 next", "1234567890 12 3", "ﬁ Å é",
       "\x00\x1f odd \x7f", "!!! ??? ... a.b,c;d", "the " * 3000, " ", "\n"]


def test_alignment_equals_plain_restatement(spark, encoders):
    docs = [(i, t) for i, t in enumerate([*ODD, None, "", prose(1, 400), prose(1, 400), prose(2, 3000)])]
    got = {r[0]: tuple(r[1:]) for r in token_align.align(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == plain_alignment(encoders, docs)


def test_alignment_of_the_registered_query(spark, encoders):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMOKE, "documents").select("doc_id", "text").collect()]
    df = catalog.op11_token_alignment(spark, SF_SMOKE)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r[1:]) for r in df.collect()} == plain_alignment(encoders, docs)


def test_segments_and_a_full_store_change_nothing(spark, encoders, monkeypatch):
    docs = [(i, t) for i, t in enumerate([*ODD, prose(3, 5000), prose(4, 9)])]
    monkeypatch.setattr(token_align, "SEGMENT", 64)
    monkeypatch.setattr(token_align, "STORE_TOKENS", 10)

    class Held:
        def __init__(self, value):
            self.value = value

    with open(f"{token_align.TOKENIZER_DIR}/{token_align.BYTE_BPE}", encoding="utf-8") as f:
        a = f.read()
    with open(f"{token_align.TOKENIZER_DIR}/{token_align.PIECE_BPE}", "rb") as f:
        b = f.read()
    import pyarrow as pa
    codes = token_align.linkable(encoders.a_bytes, encoders.b_bytes)
    run = token_align._aligned(Held((a, b)), Held(codes))
    batch = pa.RecordBatch.from_pydict({"doc": [i for i, _ in docs], "text": [t for _, t in docs]})
    rows = [r for out in run(iter([batch])) for r in out.to_pylist()]
    want = plain_alignment(encoders, docs)
    assert {r["doc"]: (r["n_a"], r["n_b"], r["n_groups"], r["groups_sha256"]) for r in rows} == {
        d: (*w[:3], w[6]) for d, w in want.items()}


def test_galloping_finds_ranks_common_ends_and_overlaps():
    r = np.random.default_rng(5)
    for _ in range(200):
        x, y = (np.unique(r.integers(1, 400, r.integers(0, 200))) for _ in range(2))
        if len(y):
            assert token_align.gallop(x, y).tolist() == np.searchsorted(y, x).tolist()
        i, j = token_align.common_ends(x, y)
        assert x[i].tolist() == y[j].tolist() == sorted(set(x.tolist()) & set(y.tolist()))
    end, other = np.array([3, 5, 9]), np.array([1, 4, 9])
    first, stop = token_align.overlaps(np.array([0, 3, 5]), end, other)
    assert list(zip(first.tolist(), stop.tolist(), strict=True)) == [(0, 2), (1, 3), (2, 3)]


def test_alignment_edges(spark, edge, none):
    out = token_align.align(edge).collect()
    assert len(out) == edge.count() and all(r.groups_sha256 == "" for r in out if r.n_a == 0)
    assert token_align.align(none).collect() == []
    bad = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text UNION ALL SELECT NULL, 'a b'")
    got = {r.doc_id: r.n_a for r in token_align.align(bad).collect()}
    assert got[1] == 0 and got[None] > 0


# -- 12: ranked lexical search -----------------------------------------------------------

def plain_terms(text):
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def plain_search(docs, items, k=10):
    bags = [(doc, Counter(plain_terms(t))) for doc, t in docs]
    bags = [(doc, c, sum(c.values())) for doc, c in bags if c]
    n_docs, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in plain_terms(text) if t in c)
            if s > 0 and doc is not None:
                scored.append((-s, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_search_equals_plain_restatement(spark, edge_rows):
    docs = [(r[0], r[1]) for r in edge_rows] + [(100 + i, prose(i, 30 + i % 70, 90)) for i in range(300)] + [(None, prose(1, 50))]
    items = [(1, prose(1, 60)), (2, "w1 w1 w2"), (3, "nowhere else"), (4, None), (5, "é 😀 ONE two"), (6, "a A a"), (7, prose(8, 40, 90))]
    got = ranked_search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), _items(spark, items))
    assert sorted(tuple(r) for r in got.collect()) == plain_search(docs, items)


def test_search_in_small_slices_blocks_and_item_blocks(spark, monkeypatch):
    r = random.Random(4)
    docs = [(i, " ".join(f"w{min(int(r.expovariate(0.05)), 200)}" for _ in range(r.randrange(1, 60)))) for i in range(900)]
    items = [(i, " ".join(f"w{r.randrange(120)}" for _ in range(9))) for i in range(20)]
    want = plain_search(docs, items, 4)
    part_rows = [(d, Counter(plain_terms(t))) for d, t in docs]
    terms = sorted({t for _, c in part_rows for t in c})
    number, n = {t: i for i, t in enumerate(terms)}, np.array([sum(c.values()) for _, c in part_rows])
    df = Counter(t for _, c in part_rows for t in c)
    weight = np.array([ranked_search.term_weight(len(docs), df[t]) for t in terms])
    m = ranked_search.length_norms(n, len(docs), int(n.sum()))
    owner = np.array([i for i, (_, c) in enumerate(part_rows) for _ in c])
    term = np.array([number[t] for _, c in part_rows for t in c])
    tf = np.array([x for _, c in part_rows for x in c.values()])
    for block, share in ((8, 4), (64, 1000), (1024, 1)):
        monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
        monkeypatch.setattr(ranked_search, "LONG_SHARE", share)
        part = ranked_search.Slice(np.arange(len(docs)), owner, term, weight[term] * ((10 ** 9 * tf) // (1000 * tf + 8 * m[owner])))
        got = []
        for item, text in items:
            wanted = [(number[t], x) for t, x in Counter(plain_terms(text)).items() if t in number]
            doc, score = ranked_search.search(part, wanted, 0, 4)
            best = np.lexsort((doc, -score))[:4]
            got += [(item, rank, int(doc[i]), int(score[i])) for rank, i in enumerate(best, 1)]
        assert got == want
    # Items in many blocks, slices of few documents.
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 400)
    df_ = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(x) for x in ranked_search.ranked_search(df_, _items(spark, items), k=4).collect()) == want


def test_slices_are_bounded_and_whole(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(ranked_search, "SLICE_DOCS", 7)
    monkeypatch.setattr(ranked_search, "SLICE_POSTINGS", 20)
    r = random.Random(2)
    batches = [pa.RecordBatch.from_pydict({"doc": list(range(a, a + 10)), "n": [1] * 10, "terms": [[0] * r.randrange(9) for _ in range(10)],
                                           "tfs": [[1]] * 10}) for a in range(0, 100, 10)]
    parts = list(ranked_search._slices(iter(batches)))
    assert [d for p in parts for d in p.column("doc").to_pylist()] == list(range(100))
    assert all(p.num_rows <= 7 and (p.num_rows == 1 or sum(map(len, p.column("terms").to_pylist())) <= 20) for p in parts)


def test_length_norms_pass_64_bits():
    n = np.array([1, 10 ** 9])
    assert ranked_search.length_norms(n, 10 ** 11, 10 ** 13).tolist() == [25, 25 + 75 * 10 ** 9 * 10 ** 11 // 10 ** 13]


def test_search_edges(spark, edge, none):
    items = _items(spark, [(1, "w1 w2"), (None, "w1"), (2, ""), (3, "w7"), (3, "w7"), (3, "w9")])
    got = ranked_search.ranked_search(edge.withColumn("item_id", edge.n_chars), items).collect()
    assert {r.item_id for r in got} == {1, 3} and all(r.score > 0 for r in got)
    assert ranked_search.ranked_search(none, items).collect() == []
    assert ranked_search.ranked_search(edge, _items(spark, [])).collect() == []
    # A third of all rows equal: ties go to the smaller ids.
    same = spark.createDataFrame([(i, "hot word" if i % 3 else f"cold word{i}") for i in range(3000, 0, -1)], "doc_id long, text string")
    got = ranked_search.ranked_search(same, _items(spark, [(9, "hot")])).orderBy("rank").collect()
    assert [(r.rank, r.doc_id) for r in got] == list(enumerate([1, 2, 4, 5, 7, 8, 10, 11, 13, 14], 1))


# -- 13: toxicity -------------------------------------------------------------------------

def _toxic_corpus(n=600):
    r, rows, labels = random.Random(6), [], []
    bad = ["scumlord", "trashy", "idiotic", "loserish"]
    for i in range(n):
        words, toxic = [f"w{r.randrange(3000)}x" for _ in range(40)], i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_index_gives_the_exact_neighbours():
    r = np.random.default_rng(3)
    n, n_terms = 700, 40
    rows, terms, weights = [], [], []
    dense = np.zeros((n, n_terms))
    for i in range(n):
        t = np.sort(r.choice(n_terms, r.integers(1, 9), replace=False))
        w = r.random(len(t)) + 0.1 if i % 3 else np.ones(len(t))  # a third in large groups of ties
        dense[i, t] = w / np.linalg.norm(w)
        rows += [i] * len(t)
        terms += t.tolist()
        weights += dense[i, t].tolist()
    ids = r.permutation(10 * n)[:n]
    index = toxicity.Index(ids, np.zeros(n, np.int64), np.array(rows), np.array(terms), np.array(weights), n_terms)
    for _ in range(100):
        t = np.sort(r.choice(n_terms, r.integers(1, 12), replace=False))
        q = r.random(len(t))
        without = int(ids[r.integers(n)])
        slot, score = index.nearest(t, q, 15, without)
        full = dense[:, t] @ q
        full[ids == without] = 0
        best = np.lexsort((ids, -np.round(full, 9)))[:15]
        best = best[full[best] > 0]
        assert index.ids[slot].tolist() == ids[best].tolist() and np.allclose(score, full[best])


def test_plain_scores(spark):
    """The whole fit and scoring restated with plain loops."""
    docs, labels = _toxic_corpus(240)
    k = 5
    got = {r.doc_id: r for r in toxicity.score_toxicity(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), k=k).collect()}

    def bag(text):
        out = Counter()
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            out.update([w, *(w[:n] + "*" for n in (4, 5, 6) if len(w) > n)])
        return out

    import zlib
    bags, label = {d: bag(t) for d, t in docs}, dict(labels)
    learn = [d for d, _ in docs if zlib.crc32(str(d).encode()) % 5 != 0]
    n = [sum(label[d] == x for d in learn) for x in (0, 1)]
    z = {}
    for t in {t for d in learn for t in bags[d]}:
        held = [sum(label[d] == x and t in bags[d] for d in learn) for x in (0, 1)]
        share = sum(held) / sum(n)
        if share < 1:
            z[t] = abs(held[1] / n[1] - held[0] / n[0]) / math.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
    terms = sorted(t for t in z if z[t] >= toxicity.LEAST_Z)
    assert 4 <= len(terms) <= toxicity.MAX_TERMS
    idf = {t: math.log((1 + len(docs)) / (1 + sum(t in b for b in bags.values()))) + 1 for t in terms}
    vec = {}
    for d, b in bags.items():
        v = {t: (1 + math.log(b[t])) * idf[t] for t in terms if t in b}
        size = math.sqrt(sum(x * x for x in v.values()))
        vec[d] = {t: x / size for t, x in v.items()}

    def near(d, without=None):
        s = [(round(sum(x * vec[e].get(t, 0) for t, x in vec[d].items()), 9), e) for e in learn if e != without]
        return sorted(((c, e) for c, e in s if c > 0), key=lambda p: (-p[0], p[1]))[:k]

    def features(found):
        w = [0.0, 0.0]
        for c, e in found:
            w[label[e]] += 1 / (1 - min(c, 1) + toxicity.SOFT)
        least = 0.05 * sum(w) / len(found)
        mean = sum(c for c, _ in found) / len(found)
        odds = math.log((w[1] + least) / (w[0] + least))
        return [1, odds, mean, odds * mean]

    x, y = zip(*((features(f), label[d]) for d in learn if (f := near(d, d))), strict=True)
    beta = np.zeros(4)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.array(x) @ beta))
        beta = beta + np.linalg.solve((np.array(x).T * (p * (1 - p))) @ np.array(x) + 0.01 * np.eye(4),
                                      np.array(x).T @ (np.array(y) - p) - 0.01 * beta)
    bare = [label[d] for d in learn if not vec[d]]
    alone = (sum(bare) + n[1] / sum(n)) / (len(bare) + 1)
    for d, _ in docs:
        found = near(d)
        want = 1 / (1 + math.exp(-float(np.dot(beta, features(found))))) if found else alone
        assert abs(got[d].score - want) < 1e-4, d
        assert got[d].near_ids == [e for _, e in found] and got[d].near_labels == [label[e] for _, e in found]
        assert got[d].held_out == (d not in set(learn)) and got[d].predicted == int(got[d].score >= 0.5)


def test_toxic_rows_kept_out_of_the_fit_are_caught(spark):
    docs, labels = _toxic_corpus()
    out = toxicity.score_toxicity(spark.createDataFrame(docs, "doc_id long, text string"),
                                  spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    label = dict(labels)
    held = [r for r in out if r.held_out]
    assert len(held) > 80 and all(r.predicted == label[r.doc_id] for r in held)


def test_toxicity_of_the_registered_query(spark):
    df = catalog.op13_toxicity(spark, SF_SMOKE)
    assert df.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = df.collect()
    assert len(rows) == table(spark, SF_SMOKE, "documents").count() and all(0 <= r.score <= 1 for r in rows)


def test_toxicity_edges(spark, edge, none):
    labels = spark.createDataFrame([(1, 0, "x"), (3, 1, "y"), (4, 0, "z"), (12, 1, "z"), (None, 1, "n"), (5, None, "m"), (3, 0, "again")],
                                   "doc_id long, toxic int, text string")
    out = toxicity.score_toxicity(edge, labels).collect()
    assert len(out) == edge.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score_toxicity(none, labels).collect() == []
    no_labels = toxicity.score_toxicity(edge, labels.limit(0)).collect()
    assert {r.score for r in no_labels} == {0.0} and {r.predicted for r in no_labels} == {0}
    docs = spark.createDataFrame([(None, "scum"), (1, None), (2, "")], DOCS.split(", lang")[0])
    assert {r.doc_id for r in toxicity.score_toxicity(docs, labels).collect()} == {None, 1, 2}
