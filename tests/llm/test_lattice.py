import numpy as np

from tenura.llm import lattice
from tests.llm import brute


def test_nearest_point_is_a_nearest_lattice_point():
    random = np.random.default_rng(0)
    y = random.normal(size=(200, 8)) * 2
    found = lattice.nearest_point(y)
    doubled = np.rint(found * 2).astype(int)
    assert np.allclose(doubled, found * 2)
    assert ((doubled % 2 == 0).all(1) | (doubled % 2 == 1).all(1)).all()
    assert (found.sum(1) % 2 == 0).all()
    best = ((y - found) ** 2).sum(1)
    for move in lattice.MINIMAL:
        assert (((y - found - move) ** 2).sum(1) >= best - 1e-9).all()


def test_minimal_vectors():
    assert len({tuple(v) for v in lattice.MINIMAL}) == 240
    assert np.allclose((lattice.MINIMAL**2).sum(1), 2)


def clusters(n, seed=1, dims=32):
    random = np.random.default_rng(seed)
    out = []
    for i in range(n):
        base = random.normal(size=dims)
        for _ in range(random.integers(1, 5)):
            near = base + random.normal(size=dims) * random.choice([0, 0.1, 0.25, 0.4])
            out.append((len(out), [float(np.float32(x)) for x in near * random.choice([1, 3])], int(i % 3)))
    return out


def result(df):
    return {r["vec_id"]: tuple(r)[1:] for r in df.collect()}


def test_recall_and_no_false_links(spark, rows):
    data = clusters(150)
    expected = brute.linked_vectors(data)
    vectors = rows("vec_id long, embedding array<float>, label int", data)
    for cell_rows in (512, 2):
        got = result(lattice.near_duplicate_vectors(vectors, cell_rows=cell_rows))
        wanted, found = (sum(v[0] for v in x.values()) for x in (expected, got))
        assert 0.97 * wanted <= found <= wanted
        assert all(got[i][0] <= expected[i][0] for i in got)


def test_vectors_that_take_no_part(spark, rows):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [1.0, nan], 1), (8, [1.0, inf], 1), (9, [1.0, None], 1), (10, [], 1),
        (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 2), (13, [-1.0, -0.0], 1), (14, [-1.0, 0.0], 1),
    ]
    vectors = rows("vec_id long, embedding array<float>, label int, id string", [(*d, "clash") for d in data])
    got = result(lattice.near_duplicate_vectors(vectors))
    linked = {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 13: (1, 13, True), 14: (1, 13, False)}
    assert got == {d[0]: linked.get(d[0], (0, d[0], True)) for d in data}


def test_repeated_rows_null_ids_and_empty_table(spark, rows):
    schema = "vec_id long, embedding array<float>, label int"
    vectors = rows(schema, [(5, [1.0], 1), (5, [1.0], 1), (None, [1.0], 1)])
    got = sorted((tuple(r) for r in lattice.near_duplicate_vectors(vectors).collect()), key=str)
    assert got == sorted([(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)], key=str)
    assert lattice.near_duplicate_vectors(rows(schema, [])).count() == 0


def test_a_large_group_counts_every_link(spark, rows):
    random = np.random.default_rng(5)
    base = random.normal(size=16)
    data = [(i, [float(x) for x in base + random.normal(size=16) * 0.01], 1) for i in range(150)]
    got = result(lattice.near_duplicate_vectors(rows("vec_id long, embedding array<double>, label int", data), cell_rows=20))
    assert {v[:2] for v in got.values()} == {(149, 0)}
