"""One-bit codes (recall, exact scores) and zone-block mining (brute force) on planted and given vectors."""

import math

import numpy as np
import pytest

from larkspur.llm import queries, rotated_codes, vectors, zone_blocks

SCHEMA = "vec_id long, embedding array<double>, label int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def clustered(n, dims, seed, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dims))
    x = middle[rng.integers(0, centres, n)] + 0.2 * rng.standard_normal((n, dims))
    return (x / np.linalg.norm(x, axis=1, keepdims=True) * rng.uniform(0.5, 2, (n, 1))).tolist()


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(100, None, 1), (200, [1.0, None] * 4, 1), (300, [nan] + [0.5] * 7, 2), (400, [inf] + [0.5] * 7, 2), (None, [0.1] * 8, 3),
            (500, [0.0] * 8, 1), (600, [], 1), (700, [0.5, 0.5], 1), (701, [0.25, 0.5], 1), (702, [0.25, 0.25], 2), (800, [0.2] * 8, None)]


# ---------------------------------------------------------------- one-bit codes

def nearest(rows, every, k):
    """{query id: {id: score}} and the k-th best score, in doubles."""
    rows = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and usable(v) and any(v)]
    out = {}
    for q, a in rows:
        if q % every == 0:
            scores = {}
            for i, b in rows:
                if i != q and len(a) == len(b):
                    scores[i] = max(scores.get(i, -np.inf), float((a * b).sum()))
            for i, s in scores.items():
                out.setdefault(q, {})[i] = max(out.get(q, {}).get(i, -np.inf), s)
    return {q: sorted(s.items(), key=lambda p: (-p[1], p[0]))[:k] for q, s in out.items()}


def check_search(found, want, k, least):
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert set(got) == {q for q, w in want.items() if w}
    hits = total = 0
    for q, rows in got.items():
        best = dict(want[q])
        assert [r for _, _, r in rows] == list(range(1, len(want[q]) + 1))          # as many as there are, ranked
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and q not in [i for i, _, _ in rows]
        for i, s, _ in rows:
            assert i not in best or abs(best[i] - s) <= 1e-12 * max(1, abs(s))
        last = want[q][-1][1]
        hits += sum(s >= last - 1e-12 for _, s, _ in rows)
        total += len(rows)
    assert hits >= least * total
    return hits / max(1, total)


@pytest.mark.parametrize("dims,n", [(8, 900), (130, 700)])
def test_neighbours_of_clustered_vectors(spark, dims, n, monkeypatch):
    monkeypatch.setattr(rotated_codes, "BLOCK_ROWS", 200)
    monkeypatch.setattr(rotated_codes, "GROUP_ROWS", 30)
    rows = [(i, v, 0) for i, v in enumerate(clustered(n, dims, dims))]
    found = rotated_codes.neighbours(spark.createDataFrame(rows, SCHEMA).repartition(5), every=20, k=20)
    assert found.dtypes[:4] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    check_search(found, nearest(rows, 20, 20), 20, 0.98)


def test_odd_vectors_ties_copies_and_few_candidates(spark):
    rows = odd_rows() + [(1000 + i, v, 0) for i, v in enumerate(clustered(60, 8, 3))]
    rows += [(2000 + i, [0.1] * 8, 0) for i in range(50)] + [(2000, [0.1] * 8, 0)] * 30 + [(1001, [0.3] * 8, 0), (1020, [-0.1] * 8, 4)]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA + ", Score string, rank int")
    check_search(rotated_codes.neighbours(frame, every=20, k=20), nearest(rows, 20, 20), 20, 1.0)
    assert rotated_codes.neighbours(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rotated_codes.neighbours(spark.createDataFrame([(20, [1.0, 2.0], 0)], SCHEMA)).count() == 0


def test_estimates_keep_their_error_bound():
    x = np.array(clustered(3000, 64, 9))
    model = rotated_codes.Model(x, 1, 1)
    block = rotated_codes.Block(model, 0, np.arange(len(x)), x)
    guess, error = block.estimates(x[:40])
    off = (guess - x[:40] @ x.T) / (error / rotated_codes.SIGMAS)
    assert abs(off.mean()) < 0.2 and 0.5 < off.std() < 1.5                           # the scalars unbias it, sigma is right
    assert (np.abs(guess - x[:40] @ x.T) <= error).mean() > 0.99


def test_most_vectors_are_not_scored():
    x = np.array(clustered(3000, 64, 4))
    block = rotated_codes.Block(rotated_codes.Model(x, 1, 1), 0, np.arange(len(x)), x)
    scored = [n for *_, n in block.search(np.arange(40), x[:40], np.full(40, -np.inf), 20)]
    assert np.mean(scored) < 0.5 * len(x)


def test_far_blocks_are_skipped_whole():
    x = np.array(clustered(500, 16, 4, centres=1))
    block = rotated_codes.Block(rotated_codes.Model(x, 1, 1), 0, np.arange(len(x)), x)
    assert list(block.search(np.array([1]), -x[:1], np.array([0.5]), 20)) == []


def test_query_recall(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert check_search(queries.QUERIES["op12_rotated_codes"](spark, sf_dir), nearest(rows, 20, 20), 20, 0.9) >= 0.97


# ---------------------------------------------------------------- zone blocks

def negatives(rows, every=100, k=5, m=5, scale=256):
    whole = {(i, lab, tuple(float(math.floor(scale * x)) for x in v)) for i, v, lab in rows if i is not None and lab is not None and usable(v)}
    out = []
    for a, lab, av in whole:
        if a % every:
            continue
        same, other = {}, {}
        for i, l, v in whole:
            if i != a and len(v) == len(av):
                s = int(sum(x * y for x, y in zip(av, v, strict=True)))
                side = same if l == lab else other
                side.setdefault(i, []).append(s)
        for p, ps in sorted(((i, max(s)) for i, s in same.items()), key=lambda t: (-t[1], t[0]))[:k]:
            fits = {i: max(x for x in s if 80 * ps <= 100 * x <= 100 * ps) for i, s in other.items() if any(80 * ps <= 100 * x <= 100 * ps for x in s)}
            for r, (i, s) in enumerate(sorted(fits.items(), key=lambda t: (-t[1], t[0]))[:m]):
                out.append((a, p, r + 1, i, ps, s))
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def small_blocks(monkeypatch):
    for name, n in (("BLOCK_ROWS", 40), ("GROUP_ROWS", 7), ("PAGE_ZONES", 4)):
        monkeypatch.setattr(zone_blocks, name, n)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 2), (5, 1), (2, 1)])
def test_curve_steps_to_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = [bytes(k) for k in zone_blocks.curve_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[np.argsort(np.array(keys, dtype=object))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()                  # a Hilbert curve moves one step at a time


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((50, 6)), rng.standard_normal((20, 6))
    least, most = zone_blocks.bounds(q, x.min(axis=0)[None], x.max(axis=0)[None])
    score = q @ x.T
    assert (least[:, 0] <= score.min(axis=1)).all() and (most[:, 0] >= score.max(axis=1)).all()


@pytest.mark.parametrize("dims", [5])
def test_mined_negatives_equal_brute_force(spark, monkeypatch, dims):
    small_blocks(monkeypatch)
    rng = np.random.default_rng(dims)
    rows = [(i, v, int(rng.choice(4, p=[0.55, 0.2, 0.2, 0.05]))) for i, v in enumerate(clustered(500, dims, dims, centres=5))]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(zone_blocks.mine(zone_blocks.Candidates(frame), every=20)) == negatives(rows, every=20)


def test_odd_rows_of_mining(spark, monkeypatch):
    small_blocks(monkeypatch)
    rows = odd_rows() + [(1000 + i, v, i % 3) for i, v in enumerate(clustered(120, 8, 3))]
    rows += [(2000 + i, [0.1] * 8, i % 2) for i in range(40)] + [(2000, [0.1] * 8, 0)] * 5                 # ties and repeated rows
    rows += [(3000, [-0.5] * 8, 7), (3001, [0.5] * 8, 7), (3100, [0.5] * 8, 8)]                            # negative score; no positive
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA + ", Score string, Rank int")
    assert mined(zone_blocks.mine(zone_blocks.Candidates(frame))) == negatives(rows)
    for few in ([], [(100, [1.0], 1)], [(100, None, None)]):
        assert zone_blocks.mine(zone_blocks.Candidates(spark.createDataFrame(few, SCHEMA))).count() == 0


def test_zone_maps_spare_blocks_of_clustered_vectors(spark, monkeypatch):
    small_blocks(monkeypatch)
    rows = [(i, v, i % 2) for i, v in enumerate(clustered(2000, 8, 2, centres=20))]
    c = zone_blocks.Candidates(spark.createDataFrame(rows, SCHEMA))
    blocks = c.blocks.count()
    assert mined(zone_blocks.mine(c)) == negatives(rows)
    read = c.chosen.selectExpr("sum(length(members) / 4)").first()[0]              # (anchor, block) pairs of the negative windows
    assert read < 0.5 * blocks * 20


def test_mining_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    assert mined(queries.QUERIES["op13_zone_block_negatives"](spark, sf_dir)) == negatives(rows)


def test_packed_blocks_keep_order_and_rows(spark):
    rows = spark.createDataFrame([(i % 3, i, [float(i), 1.0]) for i in range(30)], "k long, vec_id long, x array<double>")
    for r in vectors.pack(rows, "k", {"vec_id": "i8"}, ["vec_id"]).collect():
        ids = vectors.unpacked(r["vec_id"], "i8")
        assert ids.tolist() == list(range(r["k"], 30, 3)) and r["n"] == 10 and r["dims"] == 2
        assert vectors.unpacked(r["x"], "f8", 2)[:, 0].tolist() == ids.tolist()
