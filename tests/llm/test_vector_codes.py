"""Codes and codebooks against plain Lloyd rounds in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from crownlake.llm import queries, vector_codes
from crownlake.llm.vector_codes import Book, Tree, assign, compress, integers


def plain_assign(points, entries):
    """Nearest entry of each part, lower index on ties, by trying all."""
    return [[min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(x, book[e])), e)) for x in rows] for rows, book in zip(points, entries)]


@pytest.mark.parametrize("n, k, spread", [(1, 1, 5), (7, 3, 2), (200, 16, 3), (300, 16, 4000), (257, 11, 1), (90, 16, 0)])
def test_assign_equals_trying_all(n, k, spread):
    rng = np.random.default_rng(n + k)
    points = rng.integers(-spread, spread + 1, (8, n, 3))
    entries = np.ascontiguousarray(points[:, rng.integers(0, n, k)] + rng.integers(0, 2, (8, k, 3)))
    tree = Tree(points)
    codes, sums, counts = assign(tree, Book(entries))
    back = np.empty_like(codes)
    for p in range(8):
        back[p, tree.perm[p]] = codes[p]
    want = np.array(plain_assign(points.tolist(), entries.tolist()))
    assert (back == want).all()
    for p in range(8):
        for e in range(k):
            assert counts[p, e] == (want[p] == e).sum() and (sums[p, e] == points[p][want[p] == e].sum(axis=0)).all()


def test_whole_nodes_are_assigned_by_their_sums():
    """Far clusters need no part-by-part comparison at all."""
    points = np.repeat(np.array([[0, 0], [1000, 0], [0, 1000], [1000, 1000]]), 64, axis=0)
    points = np.tile(points + np.arange(256)[:, None] % 3, (8, 1, 1))
    tree = Tree(points)
    tree.points = np.full_like(tree.points, -1)  # a comparison of parts would now go wrong
    codes, sums, counts = assign(tree, Book(np.ascontiguousarray(points[:, ::64])))
    assert (counts == 64).all() and (sums == np.stack([points[:, i * 64 : i * 64 + 64].sum(axis=1) for i in range(4)], axis=1)).all()


def test_trees_survive_packing():
    tree = Tree(np.random.default_rng(1).integers(-(1 << 25), 1 << 25, (8, 100, 4)))
    again = Tree.unpacked(tree.packed(), 4)
    assert all((getattr(tree, a) == getattr(again, a)).all() for a in ("perm", "points", "low", "high", "sums", "first", "end"))


def plain_report(rows):
    """The contract in Python integers: rows of (vec_id, vector, label)."""
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    edge = [p * len(kept[0][1]) // 8 for p in range(9)]
    cut = [[v[edge[p] : edge[p + 1]] for _, v, _ in kept] for p in range(8)]
    ids = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:16]
    books = [[cut[p][r] for r in ids] for p in range(8)]
    for _ in range(6):
        codes = plain_assign(cut, books)
        for p in range(8):
            for e in range(len(ids)):
                own = [x for x, c in zip(cut[p], codes[p]) if c == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    codes = plain_assign(cut, books)
    errors = [sum(sum((a - b) ** 2 for a, b in zip(cut[p][r], books[p][codes[p][r]])) for p in range(8)) for r in range(len(kept))]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by_label = {}
    for (_, _, lab), err in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + err
    return [
        (i, "".join(f"{codes[p][r]:02x}" for p in range(8)), errors[r], by_label[lab], digest) for r, (i, _, lab) in enumerate(kept)
    ]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def some_rows(n, dim=16):
    rng = random.Random(n)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(9)]
    rows = []
    for i in range(n):
        v = [float(np.float32(x + rng.gauss(0, 0.1))) for x in rng.choice(centres)]
        rows.append((3 * i % (n + 1), v if i % 3 else [float(np.float32(x)) for x in centres[0]], rng.choice([0, 0, 1, None])))
    odd = [(-5, None, 1), (-4, [], 1), (-3, [None] * dim, 1), (-2, [math.nan] * dim, 1), (-1, [math.inf] + [0.0] * (dim - 1), None)]
    return rows + odd + [rows[0], (None, rows[1][1], 7), (n + 9, [-0.0] * dim, 7)]


@pytest.mark.parametrize("few", [100_000, 1])
def test_query_against_plain_lloyd(ready, tmp_path, monkeypatch, few):
    monkeypatch.setattr(vector_codes, "FEW_LABELS", few)
    rows = some_rows(400)
    vectors(ready, rows).repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op13_vector_codes(ready, str(tmp_path))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_report(rows), key=repr)


def test_few_vectors_odd_lengths_and_other_columns(ready):
    from pyspark.sql import functions as F

    rows = [(1, [0.5] * 11, 0), (2, [0.25] * 11, 0), (3, [0.5] * 10 + [0.6], None)]
    extra = vectors(ready, rows + [(4, [1.0], 0), (5, [1e30] * 11, 0)]).withColumns({c: F.lit(1) for c in ("id", "code", "error", "of", "salt")})
    got = vector_codes.code_report(extra)
    assert sorted(map(tuple, got.collect())) == sorted(plain_report(vectors(ready, rows).collect()))


def test_empty_tables(ready):
    for rows in ([], [(1, None, 1)], [(1, [1e30] * 8, 1)]):
        got = vector_codes.code_report(vectors(ready, rows))
        assert got.collect() == [] and got.columns[0] == "vec_id"


def test_own_column_names_and_codebooks(ready):
    rows = some_rows(60, 24)
    df = vectors(ready, rows).selectExpr("vec_id AS a", "embedding AS b", "label AS c")
    coded, entries, dim = compress(df, "a", "b", "c")
    assert (dim, entries.shape) == (24, (8, 16, 3))
    assert sorted((r.id, r.code) for r in coded.where("id IS NOT NULL").collect()) == sorted(r[:2] for r in plain_report(rows) if r[0] is not None)
    assert integers(np.array([0.1] * 24), 24).shape == (8, 1, 3)
