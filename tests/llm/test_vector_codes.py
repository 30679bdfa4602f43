import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np

from fleetspark.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, v string, code int, error string, p int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "v", 1, "e", 2) for r in rows], SCHEMA)


def plain(rows, parts=8, entries=16, rounds=6):
    """The same by loops over Python numbers."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return Counter()
    size = max(-(-max(len(v) for _, v, _ in kept) // parts), 1)
    whole = [v + [0] * (parts * size - len(v)) for _, v, _ in kept]
    cut = lambda v, p: v[p * size : (p + 1) * size]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))
    books = [[cut(whole[k], p) for k in order[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        best = [[min((away(cut(v, p), e), k) for k, e in enumerate(books[p])) for p in range(parts)] for v in whole]
        if turn == rounds:
            break
        for p in range(parts):
            held = defaultdict(list)
            for v, b in zip(whole, best):
                held[b[p][1]].append(cut(v, p))
            for e, vs in held.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    digest = hashlib.sha256(",".join(str(c) for part in books for e in part for c in e).encode()).hexdigest()
    total = Counter()
    for (_, _, label), b in zip(kept, best):
        total[label] += sum(d for d, _ in b)
    return Counter((i, "".join(f"{e:02x}" for _, e in b), sum(d for d, _ in b), total[label], digest)
                   for (i, _, label), b in zip(kept, best))


def got(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return Counter(map(tuple, df.collect()))


def odd(seed, n=60, width=24):
    make = random.Random(seed)
    rows = [(i, [make.choice([-1.5, -0.25, 0.0, 0.3, 1.0, make.gauss(0, 1)]) for _ in range(width)], make.choice([None, 1, 2])) for i in range(n)]
    rows += [rows[3], rows[3], (3, rows[4][1], 2), (None, rows[5][1], None), (90, None, 1), (91, [0.5, None, *rows[0][1][2:]], 1)]
    rows += [(92, [float("nan"), *rows[0][1][1:]], 1), (93, [float("inf"), *rows[0][1][1:]], None), (94, [-float("inf")] * width, 2), (95, [0.0] * width, 2)]
    return rows


def test_equals_loops_over_odd_rows(spark):
    for seed in range(2):
        rows = odd(seed)
        assert got(vector_codes.compress(table(spark, rows).repartition(3))) == plain(rows)


def test_parts_of_any_length(spark):
    for width in (8, 40):
        rows = odd(width, 30, width)
        assert got(vector_codes.compress(table(spark, rows))) == plain(rows)
    rows = [(i, [float(i % 5)] * (i % 13), 0) for i in range(40)]  # lengths differ, one is empty
    assert got(vector_codes.compress(table(spark, rows))) == plain(rows)


def test_fewer_rows_than_entries_and_large_numbers(spark):
    rows = [(i, [50000.0 * (i + 1), -30000.0 * i] + [0.1 * i] * 14, None) for i in range(5)]
    assert got(vector_codes.compress(table(spark, rows))) == plain(rows)


def test_empty_tables(spark):
    assert got(vector_codes.compress(table(spark, []))) == Counter()
    assert got(vector_codes.compress(table(spark, [(1, None, 1), (2, [float("nan")] * 8, 2)]))) == Counter()


def test_search_equals_all_distances():
    make = np.random.default_rng(5)
    for size in (1, 2, 8, 16):
        x, e = make.integers(-9, 9, (500, size)), make.integers(-9, 9, (16, size))
        order = vector_codes.sequency_order(size)
        best, scaled = vector_codes.nearest(vector_codes.transformed(x)[:, order], vector_codes.transformed(e)[:, order])
        distance = ((x[:, None] - e[None]) ** 2).sum(2)
        assert (best == distance.argmin(1)).all() and (scaled == size * distance.min(1)).all()


def test_sequency_counts_sign_changes():
    rows = vector_codes.transformed(np.eye(16, dtype=np.int64))[:, vector_codes.sequency_order(16)]
    assert (np.diff(rows, axis=0) != 0).sum(0).tolist() == list(range(16))


def test_decoding_gives_the_entries(spark):
    rows = vector_codes.whole_numbers(table(spark, odd(7, 40, 20)))
    books = vector_codes.fit(rows, rounds=2)
    out = vector_codes.decode(vector_codes.encode(rows, books), books).join(rows.select("vec_id", "v"), "vec_id").where("vec_id > 5").collect()
    assert out
    for r in out:
        assert len(r.embedding) == 20
        assert sum((round(a * 4096) - b) ** 2 for a, b in zip(r.embedding, r.v)) <= r.error


def test_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = Counter(con.execute(vector_codes.ORACLE).fetchall())
    assert want and got(vector_codes.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))) == want
