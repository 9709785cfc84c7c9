import numpy as np

from stratalake.llm.ann import nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, id string, vector string, block int, score double, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y", 1, 0.5, 7) for i, v in rows], SCHEMA)


def brute(rows, query_ids, k):
    valid = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            valid.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in query_ids:
        for query in valid.get(q, []):
            scored = [(-sum(float(a) * float(b) for a, b in zip(query, v)), i) for i, vs in valid.items() for v in vs if i != q and len(v) == len(query)]
            out.setdefault(q, []).extend((i, -s) for s, i in sorted(scored)[:k])
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((3_000, 64))
    vectors[2_000:2_200] = vectors[5] + 0.05 * rng.standard_normal((200, 64))
    vectors *= rng.uniform(0.5, 2, (3_000, 1))  # inner products, not angles
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = table(spark, rows)
    got = found(nearest_neighbours(df, df.where("vec_id % 50 = 0"), vectors_a_block=700, queries_a_block=25))
    want = brute(rows, range(0, 3_000, 50), 20)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) >= 0.95 * 20 * len(want)
    scores = {(q, i): s for q, found_ in want.items() for i, s in found_}
    assert all(abs(s - scores[q, i]) < 1e-12 for q, f in got.items() for i, s in f if (q, i) in scores)


def test_all_candidates_if_few(spark):
    rows = [(i, [i + 1.0, 2.0, -i]) for i in range(7)]
    df = table(spark, rows)
    assert found(nearest_neighbours(df, df, vectors_a_block=2, queries_a_block=3)) == brute(rows, range(7), 20)


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 1.0]) for i in range(50, 0, -1)] + [(0, [1.0, 0.0]), (100, [2.0, 2.0])]
    df = table(spark, rows)
    got = found(nearest_neighbours(df, df.where("vec_id in (0, 50)"), k=5, vectors_a_block=9))
    assert got == brute(rows, [0, 50], 5)
    assert [i for i, _ in got[0]] == [100, 1, 2, 3, 4]


def test_odd_vectors(spark):
    odd = [None, [], [0, 0, 0], [1, None, 2], [1, float("nan"), 0], [float("inf"), 0, 0]]
    rows = [(i, v) for i, v in enumerate(odd)] + [(10, [1, 2, 3]), (11, [3, 2, 1]), (12, [1, 2]), (None, [9, 9, 9]), (13, [5, 5]), (11, [3, 2, 1])]
    df = table(spark, rows)
    got = found(nearest_neighbours(df, df.where("vec_id != 11")))
    assert got == {10: [(11, 10.0), (11, 10.0)], 12: [(13, 15.0)], 13: [(12, 15.0)]}
    assert found(nearest_neighbours(table(spark, []), df)) == {} == found(nearest_neighbours(df, table(spark, [])))
