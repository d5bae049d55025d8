"""Hard negatives and near vectors against plain loops over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows
from visitlens.llm import hard_negatives, near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
ODD = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 8, 1), (1003, [1.0, None] + [0.0] * 6, 1), (1004, [NAN] + [1.0] * 7, 1),
       (1005, [INF] + [0.0] * 7, 1), (1006, [1.0] * 8, None), (None, [1.0] * 8, 1), (1007, [3e38] * 8, 7), (1008, [1e-40] * 8, 7), (1009, [1.0, 1.0], 8), (1010, [1.0, 1.0, 0.0], 8)]


def cloud(n=260, width=8, seed=4):
    """Clusters of near vectors, exact copies, a chain and a hot one; some rows twice."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    pick = np.where(rng.random(n) < 0.33, 0, rng.integers(0, 12, n))
    x = centres[pick] + rng.normal(size=(n, width)) * rng.choice([0.0, 0.03, 0.1, 1.0], (n, 1))
    chain = [np.array([math.cos(t), math.sin(t), *[0.0] * (width - 2)]) for t in np.arange(0, 3, 0.19)]
    out = [(i, v.astype("f4").tolist(), int(p % 3)) for i, (v, p) in enumerate(zip(x, pick))]
    out += [(500 + 100 * k, v.astype("f4").tolist(), 5) for k, v in enumerate(chain)]
    return out + out[3:6]


def plain_links(data, least=0.98):
    def good(r):
        return r[2] is not None and r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1])

    width = max((len(r[1]) for r in data if r[1]), default=0)
    unit = [(v := np.pad(np.array(r[1], float), (0, width - len(r[1])))) / abs(v).max() if good(r) else None for r in data]
    unit = [None if v is None else v / np.linalg.norm(v) for v in unit]
    near = [{j for j in range(len(data)) if j != i and unit[i] is not None and unit[j] is not None and data[i][2] == data[j][2] and unit[i] @ unit[j] >= least} for i in range(len(data))]
    out = []
    for i, r in enumerate(data):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        head = min((data[j][0] for j in seen if data[j][0] is not None), default=None)
        out.append((r[0], len(near[i]), head, head is not None and r[0] == head))
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [{}, {"homes": 7, "visits": 9, "exact": 5, "lists": 6}, {"lists": 1}])
def test_no_link_is_lost(spark, blocks):
    data = cloud() + ODD
    df = spark.createDataFrame(data, SCHEMA).repartition(4).withColumns({c: F.lit("x") for c in ("id", "vector", "grp", "node", "list", "part", "links", "home")})
    got = near_vectors.near_vectors(df, **blocks)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert rows(got, *got.columns) == plain_links(data)


def test_other_thresholds_and_text_ids(spark):
    data = [(f"id{i}", v, g) for i, v, g in cloud(80)]
    got = near_vectors.near_vectors(spark.createDataFrame(data, SCHEMA.replace("bigint", "string")), least=0.9)
    assert rows(got, *got.columns) == plain_links(data, 0.9)
    with pytest.raises(ValueError):
        near_vectors.near_vectors(spark.createDataFrame(data, SCHEMA.replace("bigint", "string")), least=0)


def test_no_usable_vector(spark):
    assert near_vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    got = near_vectors.near_vectors(spark.createDataFrame(ODD[:8], SCHEMA))
    assert rows(got, *got.columns) == plain_links(ODD[:8])


def test_look_ups_are_within_the_stored_error():
    rng = np.random.default_rng(0)
    x = near_vectors.units(rng.normal(size=(600, 21)))
    q = near_vectors.fit(x[:300], 9)
    home, codes, shift, error, (row, lists) = q.code(x, 0.2)
    exact = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0))
    looked = np.sqrt(np.maximum(q.look_up(x, home, codes, shift), 0))
    assert (np.abs(exact - looked) <= error + 1e-6).all()
    visits = np.zeros((600, 9), bool)
    visits[row, lists] = True
    i, j = np.nonzero(exact <= 0.5)
    visits = np.zeros((600, 9), bool)
    row, lists = q.code(x, 0.5)[4]
    visits[row, lists] = True
    assert visits[j, home[i]].all() and visits.sum() < visits.size


def plain_negatives(data, every=100, want=5, wanted=5, low=80):
    seen = {}
    for i, v, g in data:
        if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            seen[i] = min(seen.get(i, (g, v)), (g, v))
    width = max((len(v) for _, v in seen.values()), default=0)
    full = {i: (g, [math.floor(256 * x) for x in v] + [0] * (width - len(v))) for i, (g, v) in seen.items()}
    out = []
    for a, (g, x) in full.items():
        if a % every:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y)), i, h) for i, (h, y) in full.items() if i != a)
        for s, p, _ in [t for t in scores if t[2] == g][:want]:
            window = [t for t in scores if t[2] != g and low * -s <= 100 * -t[0] <= 100 * -s][:wanted]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(window)]
    return sorted(out, key=str)


USABLE = [r for r in ODD if r[0] not in (1007,)]


@pytest.mark.parametrize("values", [{"chunk": 3, "every": 10}, {"every": 50}, {"every": 20, "positives": 3, "negatives": 2, "low": 10}])
def test_negatives_equal_all_pairs(spark, values, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE", 5)
    data = cloud(220, 19) + USABLE + [(40, [9.0] * 19, 1), (40, [8.0] * 19, 2)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3).selectExpr("vec_id as id", "embedding as vector", "label", "'x' as w", "1 as score", "2 as place")
    got = hard_negatives.hard_negatives(df, **values)
    options = {"every": values["every"], "want": values.get("positives", 5), "wanted": values.get("negatives", 5), "low": values.get("low", 80)}
    assert rows(got, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == plain_negatives(data, **options)


def test_ties_go_to_the_smaller_id(spark):
    data = [(i, [1.0, 0.0], i % 2) for i in range(40)]
    got = hard_negatives.hard_negatives(spark.createDataFrame(data, SCHEMA).selectExpr("vec_id id", "embedding vector", "label"), every=20)
    assert rows(got, *got.columns) == plain_negatives(data, every=20)


def test_negatives_of_nothing_and_scores_too_large(spark):
    df = spark.createDataFrame([], SCHEMA).selectExpr("vec_id id", "embedding vector", "label")
    assert hard_negatives.hard_negatives(df).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2), (200, [], 3)], SCHEMA).selectExpr("vec_id id", "embedding vector", "label")
    assert hard_negatives.hard_negatives(alone).count() == 0
    with pytest.raises(Exception, match="not exact"):
        hard_negatives.hard_negatives(spark.createDataFrame([(0, [3e38], 1)], SCHEMA).selectExpr("vec_id id", "embedding vector", "label"))


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(30, 27)) * 50) * rng.choice([0.05, 1, 4], (30, 27))
    y = np.floor(rng.normal(size=(90, 27)) * 50)
    x = np.floor(x)
    block = hard_negatives.Block(np.arange(90), np.zeros(90, int), y, hard_negatives.rests(y))
    exact = x @ y.T
    for level in (2e5, 5e4, 1e4, 0, -1e9):
        least = np.full(30, float(level)) + np.arange(30)
        use = rng.random(exact.shape) < 0.9
        i, j, s = hard_negatives.pairs_above(x, hard_negatives.rests(x), least, block, use)
        want = (exact >= least[:, None]) & use
        assert set(zip(i, j)) == set(zip(*np.nonzero(want))) and (s == exact[i, j]).all()
