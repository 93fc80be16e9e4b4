import numpy as np
import pytest

from claimsmith.llm import spherical_dedup as S
from tests.llm.conftest import SF0001


def usable(i, x, label):
    return i is not None and label is not None and x is not None and all(e is not None and np.isfinite(e) for e in x) and any(e != 0 for e in x)


def brute(rows):
    out = []
    good = [k for k, r in enumerate(rows) if usable(*r)]
    link = {k: [] for k in good}
    unit = {k: np.array(rows[k][1], float) / np.abs(np.array(rows[k][1], float)).max() for k in good}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93:
                link[a].append(b)
                link[b].append(a)
    for k, (i, _, _) in enumerate(rows):
        if k not in link:
            out.append((i, 0, i, True))
            continue
        seen, todo = {k}, [k]
        while todo:
            for m in link[todo.pop()]:
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        low = min(rows[m][0] for m in seen)
        out.append((i, len(link[k]), low, low == i))
    return sorted(out, key=str)


def fixture(seed=1, n=150):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for _ in range(n):
        x = rng.normal(size=16).astype(np.float32)
        for _ in range(int(rng.integers(1, 5))):
            rows.append((k, (x + rng.normal(size=16) * rng.choice([0, 0.05, 0.2, 0.45])).astype(np.float32).tolist(), int(rng.integers(0, 3))))
            k += 1
    nan, inf = float("nan"), float("inf")
    same = rows[0][1]
    rows += [(9000, None, 1), (9001, [], 1), (9002, [0.0] * 16, 1), (9003, [nan] + [1.0] * 15, 1), (9004, [inf] + [1.0] * 15, 1), (9005, [None] + [1.0] * 15, 1),
             (9006, same, None), (9007, same, None), (9008, same[:8], 0), (9009, same[:8], 0), (9010, [1e30] * 16, 2), (9011, [1e-30] * 16, 2), (9012, [-0.0] + [1.0] * 15, 2),
             (9013, [0.0] + [1.0] * 15, 2), (9013, [0.0] + [1.0] * 15, 2), (9014, same, 0), (None, same, 0)]
    return rows


def spread(spark, rows):
    return spark.createDataFrame([(i, x, c, "a", "b", 3) for i, x, c in rows], "vec_id long, embedding array<float>, label int, same string, cell string, id int")


@pytest.mark.parametrize("block", [S.BLOCK, 16])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rows = fixture()
    rows = [(i, None if x is None else [None if e is None else float(np.float32(e)) for e in x], c) for i, x, c in rows]
    got = S.near_duplicates(spread(spark, rows), guard=1.0).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str) == brute(rows)


def test_large_group_of_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(3000)] + [(5000, [1.0, 2.0, 3.1], 1)]
    got = S.near_duplicates(spread(spark, rows)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(3000, 0)} and sum(r.kept for r in got) == 1


def test_empty(spark):
    assert S.near_duplicates(spread(spark, [])).count() == 0
    assert S.near_duplicates(spread(spark, [(1, None, None)])).collect()[0].kept


def test_recall_on_whole_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    got = S.op4_embedding_near_dedup(spark, SF0001).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str) == brute(rows)


@pytest.mark.parametrize("dim, directions", [(64, 3), (64, 4), (8, None)])
def test_every_partner_s_home_is_visited_in_low_dimensions(dim, directions):
    """The cells of the default search, on vectors near a few directions or of few components."""
    rng = np.random.default_rng(3)
    if directions:
        x = rng.normal(size=(4000, directions)) @ rng.normal(size=(directions, dim)) + 0.05 * rng.normal(size=(4000, dim))
    else:
        x = rng.normal(size=(4000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = S.spherical_kmeans(x, 32)
    cells = S.probes(x, c, S.GUARD * np.sqrt(1 - S.THRESHOLD ** 2))
    visited = np.zeros((len(x), len(c)), bool)
    for i, to in enumerate(cells):
        visited[i, to] = True
    a, b = np.nonzero(x @ x.T >= S.THRESHOLD)
    home = np.array([to[0] for to in cells])
    assert len(a) > len(x) and visited[a, home[b]].all()


def test_nearly_equal_centroids_are_both_visited():
    x = np.array([[1.0, 0.0], [np.cos(1e-9), np.sin(1e-9)]])
    assert all(len(to) == 2 for to in S.probes(x, x, np.sqrt(1 - S.THRESHOLD ** 2)))


def test_links_of_low_rank_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(700, 3)) @ rng.normal(size=(3, 64)) + 0.3 * rng.normal(size=(700, 64))).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = S.near_duplicates(spread(spark, rows)).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str) == brute(rows)


@pytest.mark.parametrize("super_", [16, 40])
def test_many_groups_and_cut_groups_equal_brute_force(spark, monkeypatch, super_):
    """Labels of several groups, and groups with more rows than a task takes."""
    monkeypatch.setattr(S, "BLOCK", 8)
    monkeypatch.setattr(S, "SUPER", super_ // 4)
    rows = [(i, None if x is None else [None if e is None else float(np.float32(e)) for e in x], c) for i, x, c in fixture(seed=4)]
    got = S.near_duplicates(spread(spark, rows)).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str) == brute(rows)


def test_double_components_equal_brute_force(spark):
    rows = [(i, x, c) for i, x, c in fixture(seed=6, n=40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = S.near_duplicates(df).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str) == brute(rows)


def test_vectors_without_structure_are_copied_once_a_group_not_once_a_cell(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 64)
    monkeypatch.setattr(S, "SUPER", 1000)
    rng = np.random.default_rng(8)
    rows = [(i, 1, 0, v.tolist(), i) for i, v in enumerate(rng.normal(size=(4000, 64)).astype(np.float32))]
    reps = spark.createDataFrame(rows, "node long, copies long, label int, x array<float>, same long").repartition(4)
    cells = spark.sparkContext.broadcast(S.fit_cells(reps, 4000))
    assert len(cells.value[64]) == 32
    margin = np.sqrt(1 - S.THRESHOLD ** 2)
    placed = S.placed_in_groups(reps, 4000, cells, margin).select("id", "cell", "kind").collect()
    assert len({(r.id, r.cell) for r in placed}) == len(placed) <= 4 * 4000
    assert sum(r.kind == S.BOTH for r in placed) == 4000  # each has one home
