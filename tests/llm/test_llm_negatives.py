"""Hard-negative mining against SQL over all pairs, and the bounds of the tree."""

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from llm_fixtures import stored

from millrace.llm import negatives
from millrace.llm.negatives import OP13_SQL, Candidates, hard_negatives, op13_hard_negatives, spanning_tree


def odd_rows(seed=0, n=700):
    """Clusters with copies, ties, repeated rows, ids that several rows share, nulls, and vectors of two lengths."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (6, 12))
    rows = []
    for i in range(n):
        v = [float(np.float32(x)) for x in centres[rng.integers(6)] + rng.normal(0, 0.1, 12)]
        rows.append((int(i * rng.choice([1, 5])) - 100, v, int(rng.integers(0, 3))))
    same = [0.25] * 12
    rows += [(10_000 + i, same, i % 2) for i in range(60)] + [(20_000 + 100 * i, [-x for x in same], 1) for i in range(3)]
    rows += rows[:20] + [(200, same, 2), (200, [0.5] * 12, 2)]
    rows += [(100 * i, [0.1 * i, 0.2], i % 2) for i in range(1, 8)] + [(7 * i, [0.0, 0.3], 1) for i in range(5)]
    rows += [(300, None, 1), (400, same, None), (None, same, 1), (500, [], 1), (600, [None, 0.1], 1), (700, [float("nan")] * 12, 1), (800, [float("inf")] * 12, 1)]
    return rows + [(100, [0.0] * 12, 9), (-300, [0.0] * 12, 0)]


@pytest.mark.parametrize("sizes", [None, (50, 4, 3, 16)])
def test_same_rows_as_sql_on_odd_rows(spark, tmp_path, monkeypatch, sizes):
    rows = spark.createDataFrame(odd_rows(), "vec_id long, embedding array<float>, label int")
    more = rows.selectExpr("*", "label AS dims", "vec_id AS part", "label AS code", "'x' AS v", "1 AS number")
    folder = stored(spark, tmp_path, embeddings=more.repartition(5).coalesce(1))
    if sizes:
        # Many shards, blocks, trees and steps.
        shard, block, tree, step = sizes
        monkeypatch.setattr(negatives, "TREE", tree)
        monkeypatch.setattr(negatives, "STEP", step)
        monkeypatch.setattr(hard_negatives, "__defaults__", (5, 5, 80, 100, shard, block))
    columns, found = spark_rows(op13_hard_negatives(spark, folder))
    con = connect(folder)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    expected_columns, expected = sql_rows(con, OP13_SQL)
    assert columns == expected_columns
    assert len(expected) > 100
    assert found == expected


def test_bounds_hold_and_spare_work():
    """Every score is inside its bounds, and near anchors leave most candidates unscored."""
    rng = np.random.default_rng(1)
    x = rng.integers(-100, 100, (3_000, 24))
    anchors = x[0] + rng.integers(-2, 3, (200, 24))
    candidates = Candidates(np.arange(3_000), np.zeros(3_000, int), np.zeros(3_000, int), x)
    scored, seen = [], []

    def visit(a, low, high):
        true = x @ anchors[a]
        assert ((low <= true) & (true <= high)).all()
        wanted = high >= negatives.kth(low, 5)
        seen.append(a)

        def take(rows, scores):
            assert (scores == true[rows]).all()
            assert set(np.argsort(-true)[:5]) <= set(rows)
            scored.append(len(rows))

        return wanted, take

    candidates.walk(anchors, visit)
    assert sorted(seen) == list(range(200))
    assert np.median(scored) < 300


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(2)
    x = rng.integers(-9, 9, (40, 3)).astype(float)
    order, parent, edge = spanning_tree(x)
    place = np.argsort(order)
    assert all(place[parent[i]] < place[i] for i in order[1:])
    # Kruskal's total.
    distance = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    group, total = list(range(40)), 0.0
    for i, j in sorted(((i, j) for i in range(40) for j in range(i)), key=lambda p: distance[p]):
        if group[i] != group[j]:
            total += distance[i, j]
            group = [group[i] if g == group[j] else g for g in group]
    assert edge.sum() == pytest.approx(total)
