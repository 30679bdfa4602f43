import subprocess
import sys
from functools import partial

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from fleetspark.llm import (
    byte_bpe, dart_minhash, decontaminate, divergence, language_mix, lattice_lm, line_dedup, packing, quality, templates, vector_codes,
)
from fleetspark.llm.catalog import ORACLE, QUERIES
from tests.llm.conftest import prose

ROOT = corpus_pipeline.__file__.rsplit("/", 1)[0]


@pytest.fixture(scope="module")
def table_dir(spark, tmp_path_factory, sf):
    """Clean documents, and one of each kind that a stage must catch."""
    path = str(tmp_path_factory.mktemp("tables"))
    passage = prose(900, 60)
    docs = [(i, f"{prose(i, 120)}\n{prose(i + 500, 80)}") for i in range(100, 140)]
    docs += [(200, docs[0][1]), (201, docs[1][1] + " more")]  # copies of 100 and 101
    docs += [(300 + i, f"{prose(i + 700, 90)}\n{passage}\n{prose(i + 800, 90)}") for i in range(4)]  # a passage in four
    docs += [(400, f"{prose(401, 90)}\n{prose(999, 40)}")]  # a benchmark item
    docs += [(500 + i, "!!! ### $$$ " * 80) for i in range(12)]  # junk
    docs += [(None, None), (600, ""), (601, None)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 9) for i, t in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long, row int")
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if (i or 0) >= 500 else 1, 0) for i, _ in docs if i is not None]
    labels += [(10_000 + i, i % 2, 0) for i in range(3)]
    # enough rows for trees with leaves of 20 rows: each label several times
    spark.createDataFrame(labels * 12, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(999, 40)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_decides(spark, table_dir, tmp_path):
    docs = spark.read.parquet(f"{table_dir}/documents.parquet")
    shape = docs.columns
    ids = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, table_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == shape
            ids[name] = {r.doc_id: r.text for r in docs.collect()}
    clean = set(range(100, 140)) | {200, 201, 300, 301, 302, 303, 400}
    good, lines, near, safe = ids.values()
    assert clean <= set(good) and not any(500 <= (i or 0) < 600 for i in good)
    passage = prose(900, 60)
    assert [i for i, t in lines.items() if passage in (t or "")] == [303]
    assert 200 not in near and 201 not in near and {100, 101} <= set(near)
    assert set(near) - set(safe) == {400}
    packed = docs.collect()
    assert {r.doc_id for r in packed} == set(safe)
    run = corpus_pipeline.run(spark, table_dir).collect()
    assert sorted((r.doc_id or -1, r.start, r.ids_crc32) for r in run) == sorted((r.doc_id or -1, r.start, r.ids_crc32) for r in packed)


def test_run_equals_brute_force(spark, table_dir):
    """All five stages by loops over all rows, pairs and windows."""
    import math
    import zlib
    from collections import defaultdict

    from tokenizers import Tokenizer

    from tests.llm import test_dart_minhash, test_decontaminate, test_line_dedup

    docs, labels, items = ([tuple(r) for r in spark.read.parquet(f"{table_dir}/{t}.parquet").collect()] for t in ("documents", "labels", "benchmark"))
    rows = [(d[0], d[1]) for d in docs]
    text = {i: t for i, t in rows if i is not None}
    taught = [(i, q) for i, q, _ in labels if i in text and q in (0, 1) and zlib.crc32(str(i).encode()) % 4 != 2]
    x, y = np.array([quality.text_features(text[i]) for i, _ in taught]), np.array([q for _, q in taught], float)
    order = np.lexsort([*x.T, y])
    model = quality.fit(x[order], y[order])

    def score(value):
        row, total = quality.text_features(value), model.base
        for v, edges, table in zip(row, model.edges, model.tables):
            total += table[sum(e <= v for e in edges)]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[sum(e <= row[a] for e in model.pair_edges[a]), sum(e <= row[b] for e in model.pair_edges[b])]
        return 1 / (1 + math.exp(-total))

    rows = [(i, t) for i, t in rows if score(t) >= 0.7]
    holders = defaultdict(set)
    rank = lambda i: float("-inf") if i is None else i
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(test_line_dedup.key(line)) >= 20:
                holders[test_line_dedup.key(line)].add(rank(i))
    gone = lambda i, k: len(holders[k]) >= 3 and max(holders[k]) != rank(i)
    rows = [(i, t and "\n".join(x for x in t.split("\n") if not gone(i, test_line_dedup.key(x)))) for i, t in rows]
    numbered = [(dart_minhash.NO_ID if i is None else i, t) for i, t in rows]
    firsts = {}
    for (i, t), (_, c) in zip(sorted(numbered, key=lambda r: r[0]), test_dart_minhash.exact_classes(numbered)):
        if i == c:
            firsts.setdefault(c, (None if i == dart_minhash.NO_ID else i, t))
    rows = list(firsts.values())
    leaked = {i for i, *_ in test_decontaminate.brute(rows, items)}
    rows = [r for r in rows if r[0] not in leaked]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: np.array([*encode.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}

    run = corpus_pipeline.run(spark, table_dir).collect()
    assert {r.doc_id for r in run} == set(want)
    for i, ids in want.items():
        pieces = sorted((r for r in run if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1]] and sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    places = defaultdict(list)
    for r in run:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [0, *np.cumsum([n for _, n in held])[:-1]] and sum(n for _, n in held) <= 2048


def test_stages_are_the_operators(spark, table_dir):
    docs = spark.read.parquet(f"{table_dir}/documents.parquet")
    labels, items = (spark.read.parquet(f"{table_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    want = [quality.keep_good(docs, labels), line_dedup.dedup_lines(docs), dart_minhash.keep_one(docs),
            decontaminate.drop_leaked(docs, items), packing.packed_digests(docs)]
    for (_, stage), frame in zip(corpus_pipeline.STAGES, want):
        assert sorted(map(repr, stage(spark, docs, table_dir).collect())) == sorted(map(repr, frame.collect()))


def test_empty_tables(spark, table_dir, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{table_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_entry_lists_the_queries():
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert {x.split("_")[0] for x in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
    assert set(QUERIES) <= set(out) and len(out) > 100 and "op10_line_dedup" in ORACLE


def test_entry_works_without_the_subpackage(tmp_path):
    import shutil

    gone = shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=gone)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q; print(len(e.oracle_sql()))"
    for half in (False, True):
        if half:  # an empty folder is left
            (tmp_path / "repo/fleetspark/llm/__pycache__").mkdir(parents=True)
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True)
        assert out.returncode == 0, out.stderr


def test_entry_fails_if_part_of_the_subpackage_is_lost(tmp_path):
    import shutil

    gone = shutil.ignore_patterns(".git", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=gone)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert out.returncode != 0 and "corpus_pipeline" in out.stderr


def test_tasks_need_no_copy_of_the_package():
    """What is sent to the workers carries its own code."""
    from pyspark import cloudpickle

    script = "import sys, pickle; sys.path = [p for p in sys.path if 'repo' not in p]; print(pickle.load(sys.stdin.buffer)())"
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        encoder = partial(packing.Encoder, file.read(), public_tokenizers.PATTERN)
    page = partial(templates.main_text, "<p>a")
    calls = [partial(quality.text_features, "a b"), partial(dart_minhash.words_of, "A b"), encoder, page,
             partial(language_mix.trigram_counts, "ab"), partial(lattice_lm.Lattice, [b"a"], 1),
             partial(byte_bpe.Codec, b"YQ== 0\n", "."), partial(vector_codes.sequency_order, 8), partial(divergence.terms_of, b"A b"),
             partial(dart_minhash._first_link, [np.array([1, 2])], [np.array([2, 1])], 0.8)]
    for call in calls:
        out = subprocess.run([sys.executable, "-c", script], input=cloudpickle.dumps(call), capture_output=True, cwd="/")
        assert out.returncode == 0, out.stderr.decode()
