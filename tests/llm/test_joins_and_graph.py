"""Components, signature trees and the n-gram Jaccard join against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import graph, jaccard, signature_tree as tree, words


def shingles(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return frozenset([tuple(w)] if 0 < len(w) < k else (tuple(w[i:i + k]) for i in range(len(w) - k + 1)))


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sets, 2):
        if any(s and t and 100 * len(s & t) >= 85 * len(s | t) for s in sets[a] for t in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def corpus(seed=0):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, base = [], [[r.choice(vocabulary) for _ in range(r.choice([2, 3, 5, 40, 90, 300]))] for _ in range(25)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    for words_ in base:
        for _ in range(r.choice([1, 2, 8])):
            w = list(words_)
            for _ in range(r.choice([0, 0, 1, 1, 3])):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            if r.random() < 0.2:
                w += passage
            rows.append((len(rows) * 7 % 1009, r.choice([" ", "\n", "\t "]).join(w).upper() if r.random() < 0.2 else " ".join(w)))
    return rows + [(2001, None), (2002, ""), (2003, " \n "), (2004, "One two"), (2005, "one TWO"), (2006, "É"), (2007, "é")]


def test_join_matches_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N_shingles", F.lit("clash"))
    expected = brute(rows)
    monkeypatch.setattr(jaccard, "LINK_ROWS", 2)
    monkeypatch.setattr(jaccard, "NODE_ROWS", 4)       # blocks are dealt out as node pairs
    got = {r["doc_id"]: r for r in jaccard.components(docs).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == expected
    assert all(got[i]["n_shingles"] == len(shingles(t)) for i, t in rows)


def test_join_of_near_copies_repeats_and_nulls(spark):
    r = random.Random(3)
    base = [f"x{r.randrange(50)}" for _ in range(120)]
    rows = []
    for i in range(150):                                # one large group: many linked, some not
        w = list(base)
        for _ in range(r.randrange(6)):
            w[r.randrange(len(w))] = f"y{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    rows += [(500, rows[3][1]), (500, "entirely different words that stand alone"), (501, "entirely different words that stand alone")]
    docs = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string")
    out = jaccard.components(docs).collect()
    assert {(x["doc_id"], x["component_id"]) for x in out if x["doc_id"] is not None} == set(brute(rows).items())
    assert [x["component_id"] for x in out if x["doc_id"] is None] == [None]
    assert len(out) == len(rows) + 1
    kept = {x["doc_id"] for x in jaccard.keep_one(docs).collect()}
    assert kept == set(brute(rows).values()) | {None}


def test_join_of_nothing(spark):
    assert jaccard.components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("last", [0, 20, 200_000])
def test_components_of_paths_cycles_and_loops(spark, monkeypatch, last):
    monkeypatch.setattr(graph, "LAST_EDGES", last)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3), (100, 101)]
    out = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_dual_traversal_misses_no_link(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(10):
        b = rng.integers(0, 2 ** 64, size=rng.integers(1, 150), dtype=np.uint64)
        for _ in range(rng.integers(1, 7)):
            s = b.copy()
            at = rng.choice(len(s), rng.integers(0, len(s) // 8 + 1), replace=False)
            s[at] = rng.integers(0, 2 ** 64, size=len(at), dtype=np.uint64)
            sets.append(np.unique(s))
    n = np.array([len(s) for s in sets])
    every = np.arange(len(sets))
    groups = tree.trees(n, every, [tree.bitmap(s).tobytes() for s in sets], every)
    got = [(min(a, b), max(a, b)) for i, j in tree.candidates(groups, None, 85, 100) for a, b in zip(i.tolist(), j.tolist())]
    links = {(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
             if 100 * (o := len(np.intersect1d(sets[a], sets[b]))) >= 85 * (n[a] + n[b] - o)}
    assert links <= set(got) and len(got) == len(set(got))


def test_word_hashes_follow_words():
    hasher = words.Hasher(words.non_space(), words.byte_values())
    texts = ["Ab\tcd ab\x0bAB", None, "", " ", "x" * (words.WINDOW + 5) + " y", "a\x00b a\x85b", "y"]
    h, doc, start, end = hasher.words(pa.array(texts))
    found = [(int(d), texts[d].encode()[a:z].decode()) for d, a, z in zip(doc, start, end)]
    assert found == [(0, "Ab"), (0, "cd"), (0, "ab"), (0, "AB"), (4, "x" * (words.WINDOW + 5)), (4, "y"),
                     (5, "a\x00b"), (5, "a\x85b"), (6, "y")]
    assert h[0] == h[2] == h[3] != h[1] and h[5] == h[8]
