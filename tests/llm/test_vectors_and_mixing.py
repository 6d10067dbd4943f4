"""Whitening, hard negatives and source mixing against brute force."""

import math
import random
import re
from fractions import Fraction

import duckdb
import numpy as np
import pytest

import __spark_entry__
from tests.llm import data
from touchline.llm import hard_negatives, mixing, whitening
from touchline.llm.tables import read_table

SF = "/root/testdata/sf0.001"
CLASHES = ("x", "n", "dim", "component", "label_", "uid", "angles", "rank", "size", "key", "part", "row",
           "u", "at", "target", "words", "left", "its_source", "salt", "b1", "deviation")


def vector_table(spark, rows, kind="float"):
    names = f"vec_id long, embedding array<{kind}>, label int"
    names += "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([tuple(r) + CLASHES for r in rows], names).repartition(3)


def odd_vectors(n=150, dim=6, seed=3):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(4, dim))
    rows = []
    for i in range(n):
        k = int(rnd.integers(4))
        rows.append((i, [float(np.float32(v)) for v in centres[k] + 0.4 * rnd.normal(size=dim)], k))
    rows += [(200, None, 1), (201, [None] * dim, 1), (202, [float("nan")] * dim, 1),
             (203, [float("inf")] + [0.0] * (dim - 1), 1), (204, rows[0][1], rows[0][2]),
             (205, rows[0][1], 3), (250, [0.0] * dim, 2), (251, [-0.0] * dim, 2), (300, [], 1),
             (301, [0.5, 0.25], 1), (350, [0.25, 0.75], 2), (351, [0.5, 0.5], 2), (206, rows[3][1], None),
             (None, rows[4][1], rows[4][2])]
    return rows + [rows[50], rows[50], rows[7]]


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def ints(v):
    return tuple(math.floor(256 * c) + 0 for c in v)


def test_factor_and_rotations():
    rnd = np.random.default_rng(1)
    for d, r in ((1, 1), (6, 6), (9, 4), (8, 1)):
        low = rnd.normal(size=(d, r))
        a = low @ low.T
        c = whitening.pivoted_cholesky(a)
        assert c.shape == (d, r) and np.allclose(c @ c.T, a, atol=1e-12)
        e, u = whitening.one_sided_jacobi(c)
        assert np.allclose(e, np.linalg.eigvalsh(a)[::-1][:r], rtol=1e-10)
        assert np.allclose(a @ u, u * e, atol=1e-10) and np.allclose(u.T @ u, np.eye(r), atol=1e-12)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
    for r in range(1, 8):  # a tournament meets every pair once
        met = sorted((int(p), int(q)) for ps, qs in whitening.rounds(r) for p, q in zip(ps, qs))
        assert met == [(p, q) for p in range(r) for q in range(p + 1, r)]


def check_whitened(rows, got, components=4):
    """Every length on its own: exact numbers, and the spectral ones by numpy's eigh."""
    by_id = sorted((r for r in rows if usable(r[1]) and r[1]), key=lambda r: (r[0] is None, r[0] or 0))
    for dim in {len(r[1]) for r in by_id}:
        mine = [r for r in by_id if len(r[1]) == dim]
        fit = sorted({ints(r[1]) for r in mine})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        z = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
        v = z.T @ z / n
        e, u = np.linalg.eigh(v)
        e, u = e[::-1], u[:, ::-1]
        k = min(components, int((e > 1e-9 * max(e[0], 1e-300)).sum()))
        there = [g for g in got if g["vec_id"] in {r[0] for r in mine}]
        assert len(there) == k * len(mine)
        for c in range(k):
            part = {}
            for g in there:
                if g["component"] == c + 1:
                    part.setdefault(g["vec_id"], []).append(g)
            want, have = [], []
            for vec_id, v_, *_ in mine:
                x = ints(v_)
                dev = [n * a - s for a, s in zip(x, sums)]
                for g in part[vec_id]:
                    assert int(g["deviation"]) == sum(t * t for t in dev) and g["n"] == n
                    assert abs(g["explained"] - e[c] / np.trace(v)) <= 1e-10
                    assert g["identity_error"] <= 1e-9
                    want.append(np.array(dev, float) / n @ u[:, c] / np.sqrt(e[c]))
                    have.append(g["whitened"])
            sign = np.sign(np.dot(want, have))
            assert np.allclose(np.array(have) * sign, want, atol=1e-8)


def test_whitening_of_odd_rows(spark):
    rows = odd_vectors()
    got = whitening.whiten(vector_table(spark, rows)).collect()
    check_whitened(rows, got)
    assert {200, 201, 202, 203, 300}.isdisjoint({g["vec_id"] for g in got})
    assert None in {g["vec_id"] for g in got}


def test_whitening_in_several_chunks(spark, monkeypatch):
    """Models of few lengths at a time, and partial matrices handed on early, change nothing."""
    monkeypatch.setattr(whitening, "HELD", 64)
    assert len(whitening._chunks([(6, 9), (2, 3)], 4, 64)) == 2
    real = whitening._chunks
    monkeypatch.setattr(whitening, "_chunks", lambda lengths, most: real(lengths, most, 64))
    rows = odd_vectors()
    check_whitened(rows, whitening.whiten(vector_table(spark, rows)).collect())


def test_whitening_of_huge_components(spark):
    """Sums and squares beyond a long stay exact; the query's long is null there."""
    rows = [(i, [float(2 ** 50 + 2 ** 40 * i * i), float(i)], 0) for i in range(5)]
    got = whitening.whiten(vector_table(spark, rows, "double")).collect()
    fit = [ints(r[1]) for r in rows]
    sums = [sum(c) for c in zip(*fit)]
    for g in got:
        x = fit[g["vec_id"]]
        assert int(g["deviation"]) == sum((5 * a - s) ** 2 for a, s in zip(x, sums))


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], [(1, [], 0)]])
def test_whitening_without_variance(spark, rows):
    found = whitening.whiten(vector_table(spark, rows))
    assert found.count() == 0 and "identity_error" in found.columns


def test_whitening_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "embeddings").collect()]
    got = __spark_entry__.queries()["op11_whitening"](spark, SF).collect()
    assert dict(__spark_entry__.queries()["op11_whitening"](spark, SF).dtypes)["deviation"] == "bigint"
    check_whitened(rows, got)


def mined(rows, every=50, k=5, m=3):
    """Hard negatives by scoring everything."""
    rows = [(i, r[0], ints(r[1]), r[2]) for i, r in enumerate(rows)
            if r[0] is not None and r[2] is not None and usable(r[1])]
    out = []
    for u, a, x, label in rows:
        if a % every:
            continue
        others = [(-sum(p * q for p, q in zip(x, y)), b, other) for v, b, y, other in rows
                  if v != u and len(y) == len(x)]
        for ps, p, _ in sorted(o for o in others if o[2] == label)[:k]:
            window = [o for o in others if o[2] != label and 50 * -ps <= 100 * -o[0] <= 95 * -ps]
            for rank, (s, b, _) in enumerate(sorted(window)[:m], 1):
                out.append((a, p, rank, b, -ps, -s))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block_rows": 16}, {"reference_count": 1}, {"sample_rows": 1}])
def test_hard_negatives(spark, options):
    rows = odd_vectors()
    rows[50], rows[100] = rows[50][:2] + (2,), (100, rows[50][1], 2)
    got = hard_negatives.mine(vector_table(spark, rows), **options).collect()
    want = mined(rows)
    assert sorted(map(tuple, got)) == want and len(want) > 10


def test_hard_negatives_when_every_row_asks(spark):
    rows = odd_vectors(seed=9)
    got = hard_negatives.mine(vector_table(spark, rows), every=1, positives=2, negatives=1).collect()
    assert sorted(map(tuple, got)) == mined(rows, 1, 2, 1)


def test_hard_negatives_with_summaries_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SUMMARIES", 2)
    rows = odd_vectors(seed=5)
    got = hard_negatives.mine(vector_table(spark, rows), block_rows=16).collect()
    assert sorted(map(tuple, got)) == mined(rows)


def test_hard_negatives_of_large_components(spark):
    """Scores beyond what doubles hold exactly; rows whose squared norm leaves a long take no part."""
    rnd = random.Random(2)
    rows = [(i * 10, [rnd.uniform(-1, 1) * 2 ** 20 + 2 ** 20 for _ in range(3)], i % 2) for i in range(40)]
    got = hard_negatives.mine(vector_table(spark, rows + [(7, [2.0 ** 60] * 3, 1)], "double")).collect()
    want = mined(rows)
    assert sorted(map(tuple, got)) == want and max(r[4] for r in want) > 2 ** 53


def test_hard_negatives_of_an_empty_table(spark):
    assert hard_negatives.mine(vector_table(spark, [])).count() == 0
    assert hard_negatives.mine(vector_table(spark, [(50, None, 1), (100, [1.0], None)])).count() == 0


def test_score_bounds_hold_every_score():
    rnd = np.random.default_rng(4)
    x = rnd.integers(-2000, 2000, (300, 5))
    x[:3] = [x[4], -x[4], x[4] * 3]
    f = x.astype(float)
    norms = np.sqrt((f * f).sum(1))
    refs = hard_negatives.references(f, 4)
    theta = hard_negatives.angles_to(f, norms, refs, 4)
    pruned = 0
    for i in range(0, 300, 7):
        low, high = hard_negatives.intervals(theta[i], np.ascontiguousarray(theta.T), norms * norms[i])
        scores = x @ x[i]
        assert (low <= scores).all() and (scores <= high).all()
        pruned += (high < scores.max() / 2).sum()
    assert pruned > 0


def plain_mix(rows, weights=(3, 1, 2)):
    """source -> (words, target), by sharing until no source is above its stop, in fractions."""
    words: dict = {}
    for _, text, source in rows:
        words[source] = words.get(source, 0) + len(re.findall(mixing.WORD, text or ""))
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, stopped = Fraction(3, 2) * sum(words.values()), set()
    while True:
        rest = goal - sum(2 * words[s] for s in stopped)
        open_ = sum(w for s, w in weight.items() if s not in stopped)
        target = {s: 2 * Fraction(words[s]) if s in stopped else rest * weight[s] / open_ for s in order}
        above = {s for s in order if target[s] > 2 * words[s]}
        if not above:
            return {s: (words[s], target[s]) for s in order}
        stopped |= above


def mix_rows():
    rnd = random.Random(5)
    texts = list(data.texts().values())
    rows = [(i, rnd.choice(texts[:60]), f"s{rnd.choice('aaaaaabcdZ')}") for i in range(300)]
    rows += [(400 + i, t, "odd") for i, t in enumerate(texts[60:])] + [(500, "one word", None), (501, None, None),
                                                                       (502, "\t \n", "blank"), (503, "x y z", "")]
    rows += [(None, "no id " * 5, "sa")] * 3 + [(600, "the same row", "same")] * 9 + [(601, None, "sé")]
    return rows


def mix_table(spark, rows, parts=3):
    names = "doc_id long, text string, source string" + "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([tuple(r) + CLASHES for r in rows], names).repartition(parts)


def check_mix(rows, got):
    want = plain_mix(rows)
    assert len(got) == len(rows)
    taken: dict = {}
    for g in got:
        words, target = want[g["source"]]
        assert g["source_size"] == words and abs(g["target"] - target) <= 1e-9 * max(1, target)
        copies = math.floor(target / words) if words else 0
        assert copies * g["size"] <= g["taken"] <= min(copies + 1, 2) * g["size"]
        taken[g["source"]] = taken.get(g["source"], 0) + g["taken"]
    for s, (_, target) in want.items():
        assert abs(taken[s] - target) <= 0.5 + 1e-9
        # At most one document of a source is taken in part.
        assert sum(g["taken"] % g["size"] > 0 for g in got if g["source"] == s and g["size"]) <= 1


def test_mixing(spark):
    rows = mix_rows()
    got = mixing.mix(mix_table(spark, rows)).collect()
    check_mix(rows, got)
    again = mixing.mix(mix_table(spark, rows, 7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixing_takes_documents_by_their_rank(spark):
    """Within a source, the extra copies go to the smallest ranks."""
    rows = [r for r in mix_rows() if r[2] == "sa" and r[0] is not None]
    table = mix_table(spark, rows)
    rank = {r["doc_id"]: (r["u"], r["key"]) for r in mixing.sized(table, "doc_id", "text", "source").collect()}
    got = [g for g in mixing.mix(table).collect() if g["size"]]
    copies = [g["taken"] // g["size"] for g in sorted(got, key=lambda g: rank[g["doc_id"]])]
    assert copies == sorted(copies, reverse=True) and copies[0] > copies[-1]


def test_mixing_with_salted_sources_and_one_bucket(spark, monkeypatch):
    rows = mix_rows()
    want = sorted(map(str, mixing.mix(mix_table(spark, rows)).collect()))
    monkeypatch.setattr(mixing, "SMALL", -1)
    assert sorted(map(str, mixing.mix(mix_table(spark, rows)).collect())) == want
    monkeypatch.setattr(mixing, "BUCKETS", 1)
    assert sorted(map(str, mixing.mix(mix_table(spark, rows)).collect())) == want


def test_mixing_of_repeated_rows(spark):
    """A source of one row repeated: some copies are taken, one in part."""
    rows = [(1, "a b c d e f g", "one")] * 50 + [(i, "w " * 40, "two") for i in range(2, 40)]
    check_mix(rows, mixing.mix(mix_table(spark, rows, 5)).collect())


def test_mixing_of_empty_tables(spark):
    assert mixing.mix(mix_table(spark, [])).count() == 0
    rows = [(1, None, "a"), (2, " ", None)]
    got = mixing.mix(mix_table(spark, rows)).collect()
    assert sorted((g["doc_id"], g["size"], g["source_size"], g["target"], g["taken"]) for g in got) == [
        (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mixing_main_path_is_native(spark):
    plan = mixing.mix(mix_table(spark, mix_rows()))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("key", ["op12_hard_negatives", "op13_mixing"])
def test_queries_match_their_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = __spark_entry__.queries()[key](spark, SF)
    want = con.execute(__spark_entry__.oracle_sql()[key])
    names = [c[0] for c in want.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(str, map(tuple, found.select(*names).collect()))) == sorted(map(str, want.fetchall()))
