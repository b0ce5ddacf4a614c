import numpy as np
import pytest

from tenura.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def expected(data, queries, k):
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in data}
    out = {}
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        out.update({(q, r + 1): (i, -s) for r, (s, i) in enumerate(scored[:k])})
    return out


def result(df):
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("part_rows", [50, 100_000])
def test_equals_scoring_all(spark, rows, part_rows):
    random = np.random.default_rng(2)
    centres = random.normal(size=(20, 8))
    data = [(i, (centres[i % 20] + random.normal(size=8) * 0.2).round(2).tolist()) for i in range(600)]
    data += [(600 + i, data[3][1]) for i in range(100)]  # ties
    vectors = rows(SCHEMA, data)
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), part_rows=part_rows, block_rows=16)
    assert result(got) == expected(data, range(0, 700, 50), 5)


def test_pruning_leaves_blocks_out():
    values = np.zeros((1000, 4))
    values[:10] = 100
    index = topk.BlockIndex(np.arange(1000), values, 10)
    seen = []
    rows = index.values
    index.values = type("Counted", (), {"dtype": rows.dtype, "__getitem__": lambda self, i: (seen.append(len(i)), rows[i])[1]})()
    ids, scores = index.search(0, np.ones(4), 5)
    assert ids.tolist() == [1, 2, 3, 4, 5] and sum(seen) < 500


def test_few_others_large_values_and_rows_left_out(spark, rows):
    big = float(1 << 40)
    data = [(1, [big]), (2, [1.0]), (3, [-0.001]), (4, None), (5, [float("nan")]), (6, [None]), (7, []), (8, [1.0, 2.0]), (None, [1.0])]
    vectors = rows(SCHEMA + ", score string", [(*d, "clash") for d in data])
    got = result(topk.top_k(vectors, vectors.where("vec_id in (1, 3, 4, 8)"), k=5))
    assert got == expected([(1, [big]), (2, [1.0]), (3, [-0.001])], [1, 3], 5)


def test_exact_beyond_doubles(spark, rows):
    data = [(1, [1e7 + 1 / 256, 3.0]), (2, [1e7, 7.0]), (3, [1e7, 7.00390625]), (4, [1e7 - 1 / 256, 7.0])]
    vectors = rows(SCHEMA, data)
    assert result(topk.top_k(vectors, vectors.where("vec_id = 1"))) == expected(data, [1], 5)


@pytest.mark.parametrize("part_rows", [1, 3, 8, 100_000])
def test_repeated_ids_take_one_place(spark, rows, part_rows):
    others = [(i, [float(i % 4), 1.0]) for i in range(3, 9)]
    # Copies, and the same ids with vectors of their own that score less, in more than one block.
    copies = [(2, [9.0, 9.0])] * 6 + [(10, [8.0, 8.0 - i / 4]) for i in range(20)]
    vectors = rows(SCHEMA, [(1, [1.0, 1.0]), *copies, *others])
    got = topk.top_k(vectors, vectors.where("vec_id = 1"), part_rows=part_rows, block_rows=2)
    once = [(1, [1.0, 1.0]), (2, [9.0, 9.0]), (10, [8.0, 8.0]), *others]
    assert result(got) == expected(once, [1], 5)
    got = topk.top_k(vectors, vectors.where("vec_id = 1"), k=20, part_rows=part_rows, block_rows=2)
    assert result(got) == expected(once, [1], 20)


def test_equal_rows_are_held_once():
    ids, values = np.array([1, 1, 1, 2, 2]), np.array([[1, 2], [1, 2], [1, 3], [1, 3], [1, 3]])
    assert topk._unlike_before(ids, values, None, None).tolist() == [True, False, True, True, False]
    assert topk._unlike_before(ids, values, 1, np.array([1, 2])).tolist() == [False, False, True, True, False]


def test_repeated_rows_and_empty_tables(spark, rows):
    twice = rows(SCHEMA, [(1, [1.0]), (2, [1.0]), (2, [1.0])])
    assert result(topk.top_k(twice, twice)) == {(1, 1): (2, 65536), (2, 1): (1, 65536)}
    empty = rows(SCHEMA, [])
    assert topk.top_k(empty, empty).count() == 0
    assert topk.top_k(twice, empty).count() == 0


def test_components_and_scores_beyond_a_long(spark, rows):
    huge = [
        (0, [1.0, 1.0]), (1, [3e16, 0.0]), (2, [1e300, 0.0]), (3, [-1e300, -1e300]), (4, [3e16, 2.0]),
        (50, [3e16, -1.0]), (100, [0.5, 0.25]), (7, [2.0, 2.0]),
    ]
    limit = 2**63 - 1
    values = {i: [int(max(-limit, min(limit, np.floor(256 * x)))) for x in v] for i, v in huge}
    wanted = {}
    for q in (0, 50, 100):
        held = lambda i: max(-limit, min(limit, sum(a * b for a, b in zip(values[q], values[i]))))
        scored = sorted((-held(i), i) for i in values if i != q)
        wanted.update({(q, r + 1): (i, -s) for r, (s, i) in enumerate(scored[:5])})
    vectors = rows(SCHEMA, huge)
    for part_rows in (2, 1000):
        got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), part_rows=part_rows, block_rows=2)
        assert result(got) == wanted
