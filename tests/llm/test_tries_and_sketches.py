"""Prefix trie, ranked search and SetSketch: plain versions, hot groups and odd input."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from assayer.llm import lexsearch, prefixtrie, setsketch
from assayer.llm.jaccard import WordHashes, shingles
from assayer.llm.queries import QUERIES
from tests.llm.test_copies import near_copies, plain_components

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = own.get(c - c % 100, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    below = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in below
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), below[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def trie_rows(df):
    return sorted((tuple(r[c] for c in NODE) for r in df.collect()))


def built(df):
    return prefixtrie.prefix_trie(prefixtrie.rebuilt(prefixtrie.numbered(df)))


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_trie_of_odd_conversations(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(None, 0, "user", "lost"), (7, None, None, "first"), (7, 0, "user", None), (7, 1, "", ""), (100, 0, "user", "ñandú 你好"), (101, None, None, None)]
    for c in [*range(1, 60), *range(200, 260), 1000]:
        rows += [(c, t, ("user", "assistant")[t % 2], rng.choice("abc") * rng.randint(1, 2)) for t in range(rng.randint(1, 8))]
    rows += [(300, t, "user", f"turn {t}") for t in range(50)]
    rows += [(c, t, "user", f"turn {t}") for c in (301, 399) for t in range(49)] + [(-5, 0, "user", "a"), (-100, 0, "user", "b"), (-101, 3, "user", "b")]
    rng.shuffle(rows)
    expected = None
    for chunk, least in ((1024, 1 << 16), (4, 1 << 16), (4, 64)):  # a sketch that is much too small proves less and changes nothing
        monkeypatch.setattr(prefixtrie, "CHUNK", chunk)
        monkeypatch.setattr(prefixtrie, "SKETCH_LEAST", least)
        monkeypatch.setattr(prefixtrie, "SKETCH_MOST", max(least, 64))
        df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", at int, one bigint, depth string").repartition(5)
        if expected is None:
            # conversations whose ids leave a negative rest take other bases in Python than in SQL
            expected = plain_trie([r for r in rows if (r[0] or 0) >= 0])
        assert trie_rows(built(df.where("conv_id is null or conv_id >= 0"))) == expected
    assert len(trie_rows(built(df))) >= len(expected)
    assert trie_rows(built(df.limit(0))) == []


def test_trie_sketch_is_never_too_low(spark, sf_dir):
    rows = prefixtrie.packed(prefixtrie.rebuilt(prefixtrie.numbered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
    table = prefixtrie.count_min(rows, 1 << 10)
    batches = rows.toArrow().combine_chunks().to_batches()
    flats = [prefixtrie.unpacked(b) for b in batches]
    exact = Counter((int(d), int(a), int(b)) for f in flats for d, a, b in zip(f["at"], f["d1"], f["d2"], strict=True) if d)
    for f in flats:
        estimate = np.min([table[r, p] for r, p in enumerate(prefixtrie.sketch_places(f, 1 << 10))], axis=0)
        for d, a, b, e in zip(f["at"], f["d1"], f["d2"], estimate, strict=True):
            assert not d or e >= min(2, exact[int(d), int(a), int(b)])


def test_trie_of_one_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK", 32)
    rows = [(100, t, "user", "same") for t in range(120)] + [(100, 5, "user", "same")] * 80 + [(c, t, "user", "same") for c in range(101, 140) for t in range(3)]
    assert trie_rows(built(spark.createDataFrame(rows, SCHEMA).repartition(6))) == plain_trie(rows)


def plain_search(docs, items, best):
    split = [(i, lexsearch.terms((t or "").encode())) for i, t in docs]
    split = [(i, w) for i, w in split if w]
    n_docs, n_terms = len(split), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    out = []
    for item, text in items:
        asked = Counter(lexsearch.terms((text or "").encode()))
        scored = []
        for doc, words in split:
            tf, m = Counter(words), 25 + 75 * len(words) * n_docs // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t, times in asked.items() if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:best], 1)]
    return Counter(out)


def found_rows(df):
    return Counter(tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect())


def test_search_by_blocks_and_ties(spark, odd_docs, no_docs, monkeypatch):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    items = [(1, "one two THREE, four! four"), (2, None), (None, "tie tie word77 end"), (3, "..."), (1, "line"), (4, "é ñandú 你好"), (5, "text id " * 9000)]
    asked = spark.createDataFrame([(*i, 0, 1) for i in items], "item_id bigint, text string, doc_id int, rank int")
    for cells, terms in ((1_500_000, 8_000), (32, 3)):
        monkeypatch.setattr(lexsearch, "TILE_CELLS", cells)
        for best in (2, 10):
            assert found_rows(lexsearch.search(odd_docs, asked, best, terms)) == plain_search(docs, items, best)
    assert lexsearch.search(no_docs, asked).collect() == lexsearch.search(odd_docs, asked.limit(0)).collect() == []


def test_search_adds_up_beyond_doubles():
    impacts, weights = np.full((2, 50), 999_999.0), np.full((50, 1), 3e8)
    weights[7, 0] = 2e10  # alone beyond 2^53
    exact = 999_999 * (49 * 300_000_000 + 20_000_000_000)
    assert exact > 2**53 and lexsearch.product(impacts, weights).tolist() == [[exact], [exact]]


def test_sketch_estimates_and_merges():
    rng = np.random.default_rng(5)
    for n in (4, 60, 900):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate((x[n // 4 :], rng.integers(0, 1 << 63, n // 4).astype(np.uint64))))
        a, b, both = setsketch.sketches([x, y, np.union1d(x, y)])
        assert (np.maximum(a, b) == both).all()
        assert (setsketch.sketches([y])[0] == b).all()
    similar, equal = [], []
    for _ in range(300):
        x = rng.integers(0, 1 << 63, 100).astype(np.uint64)
        y = np.concatenate((x[11:], rng.integers(0, 1 << 63, 11).astype(np.uint64)))
        a, b = setsketch.sketches([np.sort(x), np.sort(y)])
        first, second = np.array([(a > b).sum()]), np.array([(b > a).sum()])
        equal.append(int((a == b).sum()))
        grid = np.linspace(0.3, 1, 141)
        similar.append(grid[np.argmax(setsketch.log_likelihood(grid, np.float64(100), np.float64(100), first, second))])
        assert setsketch.plausible(np.int64(100), np.array([100]), first, second)[0]
        assert len(np.intersect1d(setsketch.band_keys(a[None])[0], setsketch.band_keys(b[None])[0]))
    assert abs(np.mean(similar) - 89 / 111) < 0.01 and np.mean(equal) / setsketch.REGISTERS >= 0.8
    far = setsketch.plausible(np.int64(100), np.array([100, 100, 300]), np.array([60, 14, 0]), np.array([60, 14, 90]))
    assert far.tolist() == [False, True, False]


def test_near_duplicates_of_many_copies(spark, monkeypatch):
    texts = [t for k, (n, words, changes) in enumerate(((150, 150, 8), (80, 40, 2), (40, 12, 1), (30, 5, 1), (50, 7, 1), (60, 400, 40))) for t in near_copies(k, n, words, changes)]
    random.Random(9).shuffle(texts)
    texts = dict(enumerate([*texts, "", None, "one", "one", "One TWO"]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(7)
    for size, percent in ((4, 80), (5, 80)):
        expected = plain_components(texts, size, percent)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(docs, size, percent).collect()} == expected
    monkeypatch.setattr(setsketch, "TILE_ROWS", 16)  # strips, pivots and rows that meet all others
    monkeypatch.setattr(setsketch, "PIVOTS", 2)
    expected = plain_components(texts, 4, 80)
    found = setsketch.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_odd_documents(spark, odd_docs, no_docs):
    assert setsketch.near_duplicates(no_docs).collect() == []
    found = setsketch.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    of = defaultdict(set)
    for r in found:
        of[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert of[7] == {(len(shingles((" ".join(f"word{i}" for i in range(30_000)) + " end").encode(), WordHashes(), 4)), 6, False)}
    assert of[3] == {(0, 3, True)} and of[4] == {(0, 4, True)} and of[11] == {(1, 10, False)}
    assert {k for _, _, k in of[None]} == {True}


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_lexical_search", "op13_minhash_dedup"])
def test_results_do_not_depend_on_partitions(spark, tmp_path, sf_dir, name):
    for table in ("documents", "benchmark", "conversations"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(13).write.parquet(f"{tmp_path}/{table}.parquet")
    assert Counter(QUERIES[name](spark, str(tmp_path)).collect()) == Counter(QUERIES[name](spark, sf_dir).collect())
