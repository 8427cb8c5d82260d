"""Periodic runs, ranked search and sharding against brute force, and over their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import runs, search, shards
from ledgerlake.llm.queries import QUERIES
from test_operators import EDGE, LONG, SF, duck, frame, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


# 11 ---------------------------------------------------------------- periodic runs

def brute_runs(w):
    """Every stretch of equal words p apart, for every p; the least period of each."""
    out, n = {}, len(w)
    for p in range(1, n // 4 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                out.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 9)),
                min_size=1, max_size=6))
def test_runs_equal_all_periods(parts):
    texts = [[b"%d" % x for x in own] * k for own, k in parts]
    texts.append([w for t in texts for w in t])
    assert runs.find_runs(texts) == [brute_runs(t) for t in texts]


def test_grammar_agrees_with_plain_comparison():
    rng = random.Random(3)
    for size, letters in ((2, 1), (40, 1), (200, 2), (500, 3), (3000, 2)):
        s = [letters, *[rng.randrange(letters) for _ in range(size)], letters + 1]
        s[size // 2:size // 2 + size // 3] = s[1:1 + size // 3]
        g = runs.Grammar(np.array(s))
        a = np.array([rng.randrange(1, size) for _ in range(200)])
        b = np.array([rng.randrange(1, size) for _ in range(200)])
        a, b = a[a != b], b[a != b]
        f, back = g.forward(a, b), g.backward(a, b)
        for i, j, x, y in zip(a.tolist(), b.tolist(), f.tolist(), back.tolist()):
            assert s[i:i + x] == s[j:j + x] and s[i + x] != s[j + x]
            assert s[i - y:i] == s[j - y:j] and s[i - y - 1] != s[j - y - 1]


def test_long_runs_are_whole(monkeypatch):
    monkeypatch.setattr(runs, "SLAB", 50)  # many slabs give the same
    text = [b"x%d" % (i % 7) for i in range(2000)] + [b"end"] + [b"a"] * 300
    assert runs.find_runs([text, [], text]) == [[(0, 2000, 7), (2001, 300, 1)], [],
                                               [(0, 2000, 7), (2001, 300, 1)]]


def test_strongest_compares_exactly():
    assert runs.strongest([(5, 10**9, 3), (0, 10**9 - 1, 3), (9, 4, 1)]) == (5, 10**9, 3)
    assert runs.strongest([(4, 12, 3), (2, 8, 2), (2, 4, 1)]) == (2, 4, 1)  # ties: start, period
    assert runs.strongest([]) is None


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_op11_equals_brute_force(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(documents)
    some = 0
    for d in documents:
        w = planted(d.doc_id, d.text)
        own, r = brute_runs(w), got[d.doc_id]
        drop = {i for s, m, q in own for i in range(s + q, s + m)}
        best = min(own, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        some += bool(own)
        assert (r.n_runs, r.start, r.length, r.period) == (len(own), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if own else None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in own)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        kept = " ".join(x for i, x in enumerate(w) if i not in drop)
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert some > 10


def test_runs_edges(spark, edge, empty):
    assert runs.word_runs(empty).count() == 0
    got = runs.word_runs(edge).collect()
    assert len(got) == len(EDGE) and set(edge.columns) < set(got[0].asDict())
    own = {r.doc_id: r for r in got}
    assert own[1].runs_ == [] and own[1].n_words == 0 and own[1].collapsed == ""
    assert own[3].collapsed == "" and own[3].best is None
    assert own[4].n_words == 30_000 and own[4].collapsed == LONG  # no period four times
    assert own[8].collapsed == "Σωκράτης 你好 ok"
    d = frame(spark, [(1, "begin " + "a b " * 5 + "end end end end end end end", "a")] * 2)
    assert [([tuple(x) for x in r.runs_], r.collapsed) for r in runs.word_runs(d).collect()] == \
        [([(1, 10, 2), (11, 7, 1)], "begin a b end")] * 2


# 12 ---------------------------------------------------------------- ranked search

def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_search(docs, queries, k=10):
    """Scores of all documents, by the contract's formula."""
    tf = [Counter(TERM.findall(lower(t))) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    n_docs, n_terms = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in tf for t in c)
    own = defaultdict(set)
    for q, t in queries:
        own[q] |= set(TERM.findall(lower(t)))
    out = []
    for q, terms in own.items():
        scores = []
        for i, (d, _) in enumerate(docs):
            s = 0
            for t in terms & tf[i].keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * n[i] * n_docs) // n_terms
                s += w * ((10**9 * tf[i][t]) // (1000 * tf[i][t] + 8 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        scores.sort(key=lambda x: x[:3])
        out += [(q, r + 1, x[3], -x[0]) for r, x in enumerate(scores[:k])]
    return out


def ranked(df):
    return Counter((r.query, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_op12_equals_sql(spark):
    assert rows(QUERIES["op12_lexical_search"](spark, SF)) == \
        duck("op12_lexical_search", "documents", "benchmark")


@pytest.mark.parametrize("shard_bytes,k", [(300, 3), (5_000, 1), (1 << 20, 10)])
def test_search_equals_brute_force(spark, shard_bytes, k):
    """Zipf words, ties, copies and shards of any size; blocks of few and many postings."""
    rng = random.Random(shard_bytes)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(rng.choice([i, i, i, i % 50, None]),
             " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 30]))).replace("w1 ", "W1, "))
            for i in range(900)]
    docs += [(5000 + i, "w59 w58") for i in range(40)]
    queries = [(q, " ".join(rng.choices(words, k=rng.choice([0, 1, 4, 20])))) for q in range(12)]
    queries += [(3, "w59 unseen"), (None, "w0 W0 w59"), (77, "unseen only"), (78, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(queries, "item_id long, text string")
    got = ranked(search.search(d, q, k=k, shard_bytes=shard_bytes, query_terms_a_block=30))
    assert got == Counter(brute_search(docs, queries, k))


def test_blocks_round_trip_and_bounds():
    rng = np.random.default_rng(1)
    doc = np.sort(rng.choice(500_000, 3000, replace=False))
    term = np.array([7] * 1000 + [9] * 1 + [11] * 1999, np.uint64)
    doc = np.concatenate([np.sort(doc[:1000]), doc[1000:1001], np.sort(doc[1001:])])
    count, n = rng.integers(1, 300, 3000), rng.integers(300, 90_000, 3000)
    lengths = np.zeros(500_000, np.int64)
    lengths[doc] = n
    terms, df, *parts = search.pack(doc, term, count, n)
    assert terms.tolist() == [7, 9, 11] and df.tolist() == [1000, 1, 1999]
    at = 0
    for k in range(3):
        p = search.Postings(*[x[k].as_py() for x in parts], 1000, 900_000)
        got = [p.block(i, lengths, 1000, 900_000) for i in range(len(p.last))]
        size = int(df[k])
        want = search.contribution(count[at:at + size], n[at:at + size], 1000, 900_000)
        assert np.concatenate([g[0] for g in got]).tolist() == doc[at:at + size].tolist()
        assert np.concatenate([g[1] for g in got]).tolist() == want.tolist()
        assert [int(g[1].max()) for g in got] == p.block_max.tolist()  # exact, not just a bound
        at += size


def test_blocks_are_rejected_unread(monkeypatch):
    """A frequent term's blocks are not decompressed where no candidate can enter."""
    texts = [b"common " * 3 + b"filler " * (i % 50) for i in range(4000)]
    texts[17] = texts[3000] = b"rare common"
    n, d, t, c = search.terms_of(texts)
    terms, _, *parts = search.pack(d, t, c, n[d])
    shard = search.Shard(n, 4000, int(n.sum()))
    for k, term in enumerate(terms.tolist()):
        shard.add(term, *[x[k].as_py() for x in parts])
    read = []
    real = search.unpack
    monkeypatch.setattr(search, "unpack", lambda *a: read.append(1) or real(*a))
    rare = next(t for t, p in shard.lists.items() if p.last[-1] == 3000)
    common = max(shard.lists, key=lambda x: len(shard.lists[x].last))
    doc, _ = shard.top([(rare, 7000), (common, 1)], 2, 0)
    assert sorted(doc.tolist()) == [17, 3000]
    # the first range fills the heap; then the rare list's block and one of the common list's
    assert len(read) <= search.RANGE // search.BLOCK + 1 + 2


def test_search_edges(spark, edge, empty):
    q = spark.createDataFrame([("a", "ONE text", 1), (None, "X ok", 2)],
                              "item_id string, text string, score int")
    assert search.search(empty, q).count() == 0
    assert search.search(edge, q.limit(0)).count() == 0
    got = ranked(search.search(edge, q))
    docs = [(i, t) for i, t, _ in EDGE]
    assert got == Counter(brute_search(docs, [("a", "one text"), (None, "x ok")]))


# 13 ---------------------------------------------------------------- sharding

def check_law(got, source, n_shards):
    """Counts one apart, slots without gaps, every source spread in proportion."""
    own = defaultdict(list)
    for r in got:
        own[r.shard].append(r.slot)
    sizes = [len(own[s]) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in own.values())
    per = Counter((r.shard, source[r.doc_id]) for r in got)
    for s, n in Counter(source[r.doc_id] for r in got).items():
        assert all(abs(per[k, s] - n / n_shards) <= 3 for k in range(n_shards))


def test_op13_law(spark, documents):
    got = QUERIES["op13_sharding"](spark, SF).collect()
    assert len(got) == len(documents) == len({r.doc_id for r in got})
    text = {d.doc_id: (d.text or "").encode() for d in documents}
    for r in got:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id]) + 16, zlib.crc32(text[r.doc_id]))
        assert r.law == "rows" and r.grown_shard is None
    check_law(got, {d.doc_id: d.source for d in documents}, 40)


def test_sharding_follows_the_mixture_and_the_seed(spark):
    rng = random.Random(2)
    data = [(i, f"text {i}", rng.choice(["hot"] * 6 + ["b", "c", None])) for i in range(3000)]
    d = frame(spark, data).select("doc_id", "text", "source")
    got = shards.shard_documents(d.repartition(7), 16).collect()
    check_law(got, {i: s for i, _, s in data}, 16)
    again = shards.shard_documents(d.coalesce(1).orderBy("text"), 16).collect()
    key = lambda rs: sorted((r.doc_id, r.shard, r.slot) for r in rs)
    assert key(got) == key(again)  # the seed decides, not the reading order
    assert key(got) != key(shards.shard_documents(d, 16, seed=14).collect())


def test_sharding_by_exact_ranks(spark):
    """Shard and slot follow from the sorted fractional ranks."""
    data = [(i, f"t{i}", "ab"[i % 5 == 0]) for i in range(103)]
    d = frame(spark, data).select("doc_id", "text", "source")
    keyed = d.select("doc_id", "source", shards.shuffle_key(d, 13).alias("k")).collect()
    order = []
    for s in "ab":
        own = sorted((r.k, r.doc_id) for r in keyed if r.source == s)
        order += [((i + 0.5) / len(own), s, k, doc) for i, (k, doc) in enumerate(own)]
    want = {doc: i * 7 // 103 for i, (*_, doc) in enumerate(sorted(order))}
    got = {r.doc_id: r for r in shards.shard_documents(d, 7).collect()}
    assert {i: r.shard for i, r in got.items()} == want
    places = sorted(got.values(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in places] == [doc for *_, doc in sorted(order)]


def test_sharding_edges(spark, edge, empty):
    assert shards.shard_documents(empty).count() == 0
    clash = edge.withColumn("size", F.lit(1)).withColumn("slot", F.lit("x")) \
        .withColumn("before", F.lit(2)).withColumn("part", F.lit(3))
    got = shards.shard_documents(clash, 4).collect()
    assert len(got) == len(EDGE) and set(clash.columns) < set(got[0].asDict())
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, t, _ in EDGE)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 4
    assert {r.size_ for r in got if r.text is None} == {16}
    same = frame(spark, [(None, "x", None)] * 50)
    assert Counter(r.shard for r in shards.shard_documents(same, 4).collect()) == \
        {0: 13, 1: 12, 2: 13, 3: 12}
    few = shards.shard_documents(edge.limit(3), 40).collect()
    assert [r.slot for r in few] == [0, 0, 0]
