"""Importance resampling against a brute-force version with zlib."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from larkspur.llm import crc, queries, resampling

LETTERS = "abAZ09 \t\n.,é漢-😀\x00"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams_of(words, n):
    return [" ".join(words[i:i + n]).encode() for i in range(len(words) - n + 1)]


def expected(docs, target, percent=25, least=20):
    """{position: (doc_id, n_features, weight, score, rank)} by plain loops."""
    def features(text):
        w = words_of(text)
        return [zlib.crc32(g) % 10000 for n in (1, 2) for g in grams_of(w, n)]
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = [k for k, (_, text) in enumerate(docs) if len(words_of(text)) >= least]
    able.sort(key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0))
    rank = {k: r + 1 for r, k in enumerate(able[:percent * len(able) // 100])}
    return sorted((*row, rank.get(k)) for k, row in enumerate(rows) if row[0] is not None), [row for row in rows if row[0] is None]


def got(df):
    rows = [tuple(r) for r in df.collect()]
    return sorted(r for r in rows if r[0] is not None), [r[:4] for r in rows if r[0] is None]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_gram_crcs_equal_zlib(n):
    rng = random.Random(n)
    texts = ["".join(rng.choices(LETTERS, k=rng.choice([0, 1, 5, 40, 700]))) for _ in range(200)]
    texts += [None, "", " ", "x" * 70_000, "ab " * 400_000, "é" * 40_000 + " z"]
    words = crc.Words(pa.array(texts), *resampling.byte_classes())
    want = [words_of(t) for t in texts]
    assert words.per_text.tolist() == [len(w) for w in want]
    assert words.grams(n)[1].tolist() == [zlib.crc32(g) for w in want for g in grams_of(w, n)]


def test_no_texts():
    words = crc.Words(pa.array([], pa.string()), *resampling.byte_classes())
    assert len(words.grams(1)[0]) == 0 and len(words.per_text) == 0


def test_shift_is_zero_bytes():
    state = np.array([0x12345678, 0xDEADBEEF], np.uint32)
    for n in (0, 1, 255, 256, 257, 65_536 + 3, (1 << 24) + 5):
        slow = state.copy()
        if n < 70_000:
            for _ in range(n):
                slow = crc.BYTE[slow & 255] ^ (slow >> 8)
            assert (crc.SHIFT(state.copy(), np.full(2, n)) == slow).all()
        half = crc.SHIFT(crc.SHIFT(state.copy(), np.full(2, n // 2)), np.full(2, n - n // 2))
        assert (half == crc.SHIFT(state.copy(), np.full(2, n))).all()


def test_scores_and_ranks_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "漢字", "x9"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 19, 20, 21, 200]))) for _ in range(150)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(9000, None), (9001, ""), (9002, ", ; \n"), (9003, "Ab\x00cD " * 20_000)]
    docs += [(None, texts[5]), (None, "a b"), (7, texts[8]), (3, texts[3])]               # null ids, repeated id, repeated row
    target = [" ".join(rng.choices(vocabulary[:9], k=30)) for _ in range(6)] + [None, ""]
    frame = spark.createDataFrame([(t, i, "x", 1.5) for i, t in docs], "text string, doc_id long, Rank string, score double").repartition(7)
    aim = spark.createDataFrame([(k, t, 0) for k, t in enumerate(target)], "item_id long, text string, weight int")
    want, want_null = expected(docs, target)
    out = resampling.resample(frame, aim)
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    rows, nulls = got(out)
    strip = lambda x: [r for r in x if r[0] not in (3, 7)]  # noqa: E731  of repeated ids either may come first
    assert strip(rows) == strip(want) and sorted(nulls) == sorted(want_null)
    assert sorted(r[:4] for r in rows) == sorted(r[:4] for r in want)
    assert sorted(r[4] for r in rows if r[4]) == sorted(r[4] for r in want if r[4])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 30)], "doc_id long, text string")
    assert resampling.resample(none, some).count() == 0
    (row,) = resampling.resample(some, none, percent=100).collect()
    assert row["rank"] == 1 and row["n_features"] == 119


def test_ranks_split_equal_keys(spark):
    rows = spark.range(5000).selectExpr("5 as score", "1L as doc_id")
    ranked = resampling.ranks(rows, "score", "doc_id")
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 5001))


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert got(queries.QUERIES["op11_importance_resampling"](spark, sf_dir)) == expected(docs, target)
