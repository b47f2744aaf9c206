"""Vector codes against plain Lloyd rounds over Python's integers."""

import hashlib
import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from chainlake.llm import oracles, queries, vector_codes

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, row int"


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """``vec_id, code, error, label_error`` and the digest."""
    kept = [(i, v, y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(Fraction(float(np.float32(x))) * 4096) for x in v], y) for i, v, y in kept]
    width = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[assign(v, p) for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), f in zip(kept, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(xs) // len(own) for xs in zip(*own)]
    out = []
    for i, v, y in kept:
        found = [assign(v, p) for p in range(parts)]
        out.append([i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), y])
    for r in out:
        total = sum(x[2] for x in out if x[3] == r[3])
        r.append(total if total < 1 << 63 else None)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    small = lambda e: e if e < 1 << 63 else None
    return sorted(((i, c, small(e), t, digest) for i, c, e, _, t in out), key=str)


def query_rows(spark, stored, rows, partitions=3):
    df = spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], SCHEMA).repartition(partitions)
    found = queries.op12_vector_codes(spark, stored(embeddings=df)).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found), key=str)


def test_query(spark):
    given = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in queries.op12_vector_codes(spark, SF).collect()), key=str)
    assert got == plain_codes(given)


def random_rows(n, seed, grid=None):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, 16)).astype(np.float32) if grid is None else rng.integers(-grid, grid + 1, (n, 16)).astype(np.float32) / 4096
    return [(int(i), v.tolist(), int(i) % 3 or None) for i, v in enumerate(values)]


@pytest.mark.parametrize("n, grid", [(120, None), (150, 1), (90, 2), (5, None), (1, None)])
def test_ties_and_small_tables(spark, stored, n, grid):
    """Coarse grids make equal distances and equal first entries everywhere."""
    rows = random_rows(n, n, grid)
    assert query_rows(spark, stored, rows) == plain_codes(rows)


def test_takes_odd_rows(spark, stored):
    rows = random_rows(60, 3)
    odd = [(None, rows[5][1], 1), (7, rows[7][1], None), (70, None, 1), (71, [float("nan")] * 16, 1), (72, [float("inf")] + [0.0] * 15, 2)]
    odd += [(73, [None] + [0.5] * 15, 2), (74, [0.0] * 16, 1), (75, [1e20, -3e38] + [0.25] * 14, 2), (76, [5000.5, -7000.25] * 8, 1)]
    short = [(80, [1.0] * 5, 1), (81, [], 2)]
    got = query_rows(spark, stored, rows + odd + short)
    assert got == plain_codes(rows + odd)
    assert [r[2:4] for r in got if r[0] == 75] != [(None, None)]
    assert query_rows(spark, stored, []) == []
    assert query_rows(spark, stored, [(1, None, 1)]) == []
    assert query_rows(spark, stored, [(1, [], 1)]) == [(1, "00" * 8, 0, 0, hashlib.sha256(b"").hexdigest())]


def test_errors_beyond_64_bits_are_null(spark):
    """Two far apart rows share an entry."""
    rows = [(i, [x] * 8, y) for i, x, y in ((1, 0.0, 1), (2, 1e30, 1), (3, -1e30, 2))]
    df = spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], SCHEMA)
    found = vector_codes.with_label_errors(vector_codes.compress(df, entries=1, rounds=1).rows).collect()
    assert {(r.vec_id, r.error, r.label_error) for r in found} >= {(2, None, None), (3, None, None)}


def test_lengths_that_parts_do_not_divide(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0, 2.0], 1, "x", 1) for i in range(40)], SCHEMA)
    codes = vector_codes.compress(df, parts=2, entries=4)
    assert [len(e) for book in codes.codebooks for e in book] == [2] * 8
    decoded = {r.vec_id: r.decoded for r in vector_codes.decode(codes.rows, codes.codebooks).collect()}
    errors = {r.vec_id: r.error for r in codes.rows.collect()}
    for i in range(40):
        ints = [4096 * i, 4096, 8192, 0]
        assert sum((a - 4096 * b) ** 2 for a, b in zip(ints, decoded[i])) == errors[i]


def test_active_entries_give_what_a_full_look_gives():
    rng = np.random.default_rng(2)
    for _ in range(200):
        rows, entries = rng.integers(-3, 4, (30, 2)), rng.integers(-3, 4, (6, 2))
        code, known = vector_codes.nearest(rows, entries)
        moved = rng.random(6) < 0.4
        entries[moved] += rng.integers(0, 2, (int(moved.sum()), 2))
        again = vector_codes.reassign(rows, entries, moved, code, known)
        for got, want in zip(again, vector_codes.nearest(rows, entries)):
            assert (got == want).all()


def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({oracles.vector_codes()})").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in queries.op12_vector_codes(spark, SF).select(names).collect())
