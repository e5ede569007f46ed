"""Product codes against their SQL in DuckDB on small tables with every edge, and the trie walk against brute force."""

import math
import random

import duckdb
import numpy as np
import pytest

from postloom.llm import codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, code double"


def run_sql(rows, tmp_path, **kw):
    con = duckdb.connect()
    path = str(tmp_path / "e.parquet")
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                             "label": pa.array([r[2] for r in rows], pa.int32())}), path)
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}')")
    return con.execute(codes.oracle_sql(**kw)).fetchall()


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1.0) for r in rows], SCHEMA)


def fixture(seed, n=60, dim=8):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dim)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [rows[3], rows[3], (None, [0.5] * dim, 1), (7, [0.25] * dim, None), (100, [], 0), (101, [0.1] * (dim - 3), 1)]
    rows += [(102, None, 0), (103, [0.1, None] + [0.0] * (dim - 2), 0), (104, [math.nan] * dim, 1), (105, [math.inf] + [0.0] * (dim - 1), 1)]
    return rows


@pytest.mark.parametrize("seed, entries", [(1, 16), (2, 256), (3, 4)])
def test_codes_equal_their_sql(spark, tmp_path, seed, entries):
    rows = fixture(seed)
    got = codes.quantize(table(spark, rows), entries=entries).collect()
    want = run_sql(rows, tmp_path, entries=entries)
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)
    assert len(got) == len(rows) - 4


def test_empty_table(spark):
    assert codes.quantize(table(spark, [])).count() == 0


def test_walk_is_the_nearest_entry():
    rng = np.random.default_rng(5)
    parts = rng.integers(-3, 4, (500, 5))
    parts[100:200] = parts[0]
    book = rng.integers(-3, 4, (40, 5))
    book[7] = book[3]  # a tie goes to the lower index
    entry, dist = codes.walk(parts, book)
    full = ((parts[:, None, :] - book[None, :, :]) ** 2).sum(-1)
    assert (entry == full.argmin(1)).all() and (dist == full.min(1)).all()
    big = parts.astype(object) * (1 << 40)
    entry2, dist2 = codes.walk(big, book.astype(object) * (1 << 40))
    assert (entry2 == entry).all() and all(int(a) == int(b) << 80 for a, b in zip(dist2, dist))
