"""Exact, SimHash, substring, suffix-array and embedding de-duplication against brute force."""

from collections import Counter

import numpy as np
import pytest

from tests.llm import data
from touchline.llm import (embedding_dedup, exact_dedup, induced, repeats, simhash, suffix_dedup,
                           window_dedup)
from touchline.llm.anchors import anchors
from touchline.llm.components import components


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


@pytest.fixture(scope="module")
def docs(spark):
    return data.documents(spark).persist()


def test_exact_dedup(spark, docs):
    rows = exact_dedup.exact_dedup(docs).collect()
    found = data.texts()
    groups: dict = {}
    for k, t in found.items():
        groups.setdefault(data.ascii_lower(t), []).append(k)
    groups[data.ascii_lower(found[4])] += [4, 4]
    assert len(rows) == len(found) + 3
    for k, t in found.items():
        g = groups[data.ascii_lower(t)]
        mine = [r for r in rows if r["doc_id"] == k]
        assert len(mine) == (3 if k == 4 else 1)
        assert {(r["keep_id"], r["group_size"], r["text_sha256"]) for r in mine} == {
            (max(g), len(g), data.sha(data.ascii_lower(t).encode()))}
        assert sum(r["kept"] for r in mine) == (max(g) == k)
    lone = [r for r in rows if r["doc_id"] is None]
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in lone] == [(None, 1, True)]


def test_exact_dedup_compares_contents_when_digests_meet(spark, docs, monkeypatch):
    """With a digest shared by all texts, contents alone decide."""
    want = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"])
                  for r in exact_dedup.exact_dedup(docs).collect())
    real = exact_dedup.F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: exact_dedup.F.lit("00" * 32))
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"])
                 for r in exact_dedup.exact_dedup(docs).collect())
    monkeypatch.setattr(exact_dedup.F, "sha2", real)
    assert got == want


def test_exact_dedup_main_path_is_native(docs):
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_keep_one_keeps_columns(spark, docs):
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [data.ascii_lower(r["text"]) for r in kept.collect()]
    want = {data.ascii_lower(t) for t in data.texts().values()} | {"no id here"}
    assert sorted(texts) == sorted(want)


def test_simhash(spark, docs):
    found = data.texts()
    fps = {k: data.fingerprint(t) for k, t in found.items()}
    groups, ids = data.near_groups(found), list(fps)
    rows = simhash.simhash_dedup(docs).collect()
    assert len(rows) == len(found) + 3
    got = by_id(rows)
    for k in ids:
        assert (got[k]["fingerprint"], got[k]["component_id"]) == (f"{fps[k]:016x}", groups.find(k))
    kept = simhash.keep_one_near(docs)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()} - {None}
    assert left == {k for k in ids if groups.find(k) == k}


def test_vantage_points_lose_no_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    flips = [base ^ (np.uint64(1) << rng.integers(0, 64, len(base), dtype=np.uint64)) for _ in range(3)]
    dense = np.uint64(12345) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    points = np.unique(np.concatenate([base, *flips, dense]))
    tree = simhash.grow(points[::3], 4)
    got, found_in, members = set(), Counter(), 0
    for shard, m, v in simhash.route(tree, points, 3):
        members += len(m)
        assert not np.isin(v, m).any()
        pairs = {tuple(sorted(p)) for a, b in simhash.near_pairs(m, np.concatenate([m, v]), 3, block=64)
                 for p in zip(a.tolist(), b.tolist())}
        found_in.update(pairs)
        got |= pairs
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    a, b = np.nonzero(np.triu(near, 1))
    assert members == len(points)
    assert got == set(zip(points[a].tolist(), points[b].tolist()))
    assert set(found_in.values()) == {1}  # each pair in one shard only


def test_simhash_shards_in_parts(spark):
    """Several shards, searched in several parts, give the components of brute force."""
    rng = np.random.default_rng(5)
    base = rng.integers(-(1 << 63), 1 << 63, 400)
    points = np.unique(np.concatenate([base, base ^ 1, base ^ 6]))
    nodes = spark.createDataFrame([(int(p),) for p in points], "fp long")
    edges = simhash.link(nodes, shard_rows=100, shard_work=20_000)
    groups = data.Groups(points.tolist())
    u = points.view(np.uint64)
    for i, j in zip(*np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 3)):
        groups.join(int(points[i]), int(points[j]))
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert {p: roots.get(p, p) for p in points.tolist()} == {p: groups.find(p) for p in points.tolist()}


def test_blocks_keep_every_point_once():
    points = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64)
    for k in (1, 2, 7):
        blocks = simhash.blocks_of(points, k, 32)
        assert len(blocks) == k and all(len(b) for b in blocks)
        assert sorted(np.concatenate(blocks).tolist()) == sorted(points.tolist())
        again = simhash.blocks_of(points[::-1], k, 32)
        assert all(set(x.tolist()) == set(y.tolist()) for x, y in zip(blocks, again))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(7))
    got = {r["node"]: r["root"] for r in found.collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


def naive_suffixes(x, cap):
    t = tuple(x)
    order = sorted(range(len(t)), key=lambda i: t[i:])
    lcp = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        lcp.append(k)
    return order, lcp


@pytest.mark.parametrize("memory", [64, 1 << 22])
def test_induced_sorting(memory):
    """Order and common prefixes, in memory and with every queue on disk and full recursion."""
    rng = np.random.default_rng(0)
    for n in [1, 2, 3, *rng.integers(4, 160, 120).tolist()]:
        x = rng.integers(0, rng.integers(1, 6), n).astype(np.uint16)
        x = np.tile(x, rng.integers(1, 4))
        parts = []
        with induced.Scratch(memory) as scratch:
            induced.Sorter(x, scratch, 20).run(lambda p, c: parts.append((np.array(p), np.array(c))))
        order, lcp = (np.concatenate(c)[::-1].tolist() for c in zip(*parts))
        want, common = naive_suffixes(x.tolist(), 20)
        assert order == want
        assert lcp[:-1] == common[1:]


@pytest.mark.parametrize("memory", [2048, 192 << 20])
def test_suffix_dedup(spark, docs, memory):
    found = data.texts()
    got = suffix_dedup.suffix_dedup(docs, memory_bytes=memory).collect()
    assert len(got) == len(found) + 3
    want = data.byte_spans(found, 50)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
            continue
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"])
        assert data.sha(bytes(r["kept"])) == r["kept_sha256"]


def test_without_repeats_keeps_rows_and_columns(spark, docs):
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    want = data.byte_spans(data.texts(), 50)
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert all(r[c] == f"{c}!" for c in data.CLASH)
        if r["doc_id"] is not None:
            assert r["text"] == data.without_spans(data.texts(), 50)[r["doc_id"]]
            assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


@pytest.fixture(scope="module")
def crowded(spark):
    """Half of the rows without id, one id on half of the others."""
    found = [t for t in data.texts().values() if t is None or len(t) < 5000] * 2
    rows = [(None if i % 2 else 7 if i % 4 else 1000 + i, t) for i, t in enumerate(found)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_rows_without_id_and_repeated_ids(spark, crowded):
    """Documents are told apart by key and tag: rows without id by their text, rows of one id stay one document."""
    rows, docs = crowded
    named = {(k, t): (k, 0) if k is not None else (1 << 40, data.sha((t or "").encode())) for k, t in rows}
    order = {k: i for i, k in enumerate(sorted(set(named.values())))}
    for length, dedup, brute in ((50, suffix_dedup.suffix_dedup, data.byte_groups),
                                 (20, window_dedup.window_dedup, data.word_groups)):
        got = dedup(docs).collect()
        assert len(got) == len(rows)
        # Among rows without id the order is a hash's, so only what the others lose is fixed.
        want = brute([(order[named[r]], r[1]) for r in rows if r[0] is not None], length)
        have = sorted((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in got if r["doc_id"] is not None)
        assert have == sorted((r[0], *w) for r, w in zip([r for r in rows if r[0] is not None], want))
        # All that a row without id holds and a row with an id holds as well is lost.
        whole = {t for k, t in rows if k is not None}
        lost = brute([(order[named[r]], r[1]) for r in rows], length)
        least = sorted(n for (k, t), (n, _) in zip(rows, lost) if k is None and t in whole)
        assert sorted(r["n_removed"] for r in got if r["doc_id"] is None and r["n_removed"]) >= [
            n for n in least if n][:1]


def test_anchors_of_a_repeated_id_are_dealt_over_its_texts(spark, crowded):
    rows, docs = crowded
    kept = repeats.shared_anchors(repeats.keyed(docs, "doc_id", "text"), suffix_dedup.as_items, 50, 20,
                                  within=False, parts=repeats.even_parts(docs, 4)).collect()
    mine = [set(r["anchors"]) for r in kept if r["key"] == 7]
    assert len(mine) > 10 and max(map(len, mine)) < len(set.union(*mine))
    assert len({r["key"] for r in kept if r["key"] >= repeats.NAMELESS}) > 10


@pytest.mark.parametrize("made", [suffix_dedup.without_repeats, suffix_dedup.suffix_dedup, window_dedup.window_dedup])
def test_the_texts_are_shuffled_once(spark, made):
    """One exchange carries the texts; its second use is the same exchange again."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = made(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Reused exchanges do not show what is below them, so the texts are compressed and shuffled once.
    assert plan.count("SortMergeJoin") >= 2 and "ReusedExchange" in plan
    assert plan.count("MapInArrow rows_of") == 1, plan


@pytest.mark.parametrize("first_length", [5, 10, 20])
def test_window_dedup(spark, docs, first_length):
    found = data.texts()
    got = window_dedup.window_dedup(docs, first_length=first_length).collect()
    assert len(got) == len(found) + 3
    want = data.word_windows(found, 20)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


def test_no_character_is_made_across_a_cut(spark):
    """The cut leaves C5 of one character and BC of another, which together would be a third one."""
    passage = " ".join(data.texts()[71].split()[:20])
    docs = spark.createDataFrame([(1, f"©{passage}à"), (2, f"ũ{passage}ü"), (3, "left as it is")],
                                 "doc_id long, text string")
    got = by_id(suffix_dedup.suffix_dedup(docs).collect())
    assert bytes(got[2]["kept"]) == b"\xc5\xbc"
    assert {k: r["kept_text"] for k, r in got.items()} == {1: f"©{passage}à", 2: "", 3: "left as it is"}


def test_hot_anchor_is_settled_in_its_task():
    """An anchor of many documents of a task is sent once."""
    docs = np.arange(1000)
    rows = list(repeats.pack_anchors(np.full(1000, 7, np.uint64), docs, docs, docs.astype(np.uint16),
                                     np.zeros(1000, int), 4))
    assert sorted(r[1] for r in rows) == [False, True]
    assert len(repeats.unplanes(next(r for r in rows if not r[1])[5])) == 1


def test_buckets_of_anchors_are_even():
    """Anchors are smallest hashes; no bucket holds much more than its share of them."""
    items = np.random.default_rng(1).integers(0, 256, 200_000)
    for window, k in ((50, 20), (20, 10)):
        a = np.unique(anchors(items, window, k))
        for buckets in (8, 24, 200):
            assert np.bincount(repeats.by_bucket(a, buckets), minlength=buckets).max() < 2 * len(a) / buckets


def test_buckets_grow_with_the_text(spark, docs):
    size = sum(len((r["text"] or "").encode()) for r in docs.collect())
    assert repeats.buckets_of(docs, "text") == 8
    assert repeats.buckets_of(docs, "text", 1000) == -(-size // 1000)
    assert len(set(repeats.even_parts(docs, 100))) == 100


def test_anchors_repeated_in_a_task_reach_documents_only(spark):
    """What a task has settled stands for no document; a row without id keeps its own anchors."""
    text = " ".join(data.texts()[71].split()[:40])
    other = " ".join(data.texts()[71].split()[40:80])
    rows = [(1, text), (2, text), (3, text), (4, other)]
    for extra in ([], [(None, other)]):
        docs = spark.createDataFrame(rows + extra, "doc_id long, text string").coalesce(1)
        kept = repeats.shared_anchors(repeats.keyed(docs, "doc_id", "text"), suffix_dedup.as_items, 50, 20,
                                      within=False, parts=repeats.even_parts(docs, 4)).collect()
        nameless = {r["key"] for r in kept if r["key"] >= repeats.NAMELESS}
        assert {r["key"] for r in kept} - nameless == ({1, 2, 3, 4} if extra else {1, 2, 3})
        assert len(nameless) == len(extra)
        got = {r["key"]: set(r["anchors"]) for r in kept}
        assert got[1] == got[2] == got[3]
        if extra:
            assert got[4] == got[nameless.pop()]
            cut = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.suffix_dedup(docs).collect()}
            assert cut == {1: 0, 2: len(text.encode()), 3: len(text.encode()), 4: 0, None: len(other.encode())}


@pytest.mark.parametrize("most, memory", [(1 << 20, 96 << 20), (3000, 512), (200, 96 << 20)])
def test_hot_shard_is_sorted_in_parts(monkeypatch, most, memory):
    """Documents that hold one passage between different texts give one anchor different fragments; all of
    them in one shard are never sorted at once, and lose what brute force says."""
    rng = np.random.default_rng(4)
    passage, *around = (bytes(rng.integers(97, 100, n, np.uint8)) for n in [200] + [60] * 120)
    texts = {i: around[i] + passage + around[60 + i] for i in range(60)}
    texts |= {60: b"x" * 300, 61: b"x" * 200, 62: texts[3], 63: passage[40:] + passage}
    a = [anchors(suffix_dedup.as_items(t), 50, 20) for t in texts.values()]
    among = np.unique(np.concatenate(a)).view(np.int64).tolist()
    found, blocks = [], []
    for task in (0, 1):
        held = suffix_dedup.Fragments(50, 20, 1)
        for k, t in texts.items():
            if k % 2 == task:
                held.add(k, 0, t, among)
        for x in held.flush():
            found.append(x) if len(x) == 3 else blocks.append(x[1])
    sorted_bytes, plain = [], suffix_dedup.repeated_windows
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda text, at, size, *rest: (
        sorted_bytes.append(int(size.sum())), plain(text, at, size, *rest))[1])
    found += suffix_dedup.search_shard(iter(blocks), 50, 20, memory, most)
    assert 0 < max(sorted_bytes) <= most
    want = data.byte_spans({k: t.decode() for k, t in texts.items()}, 50)
    for k, t in texts.items():
        s, e = repeats.merged(*repeats.unpack_spans([x[2] for x in found if x[0] == k]))
        left = b"".join(t[i:j] for i, j in zip([0, *e.tolist()], [*s.tolist(), len(t)]))
        assert (len(t), int((e - s).sum()), len(s), data.sha(left)) == want[k], k


def test_suffix_dedup_in_parts(spark, docs):
    want = data.byte_spans(data.texts(), 50)
    for r in suffix_dedup.suffix_dedup(docs, memory_bytes=2048, shard_bytes=300, shards_per_task=1).collect():
        if r["doc_id"] is not None:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]


@pytest.mark.parametrize("memory", [0, 40, 1 << 20])
def test_waiting_blocks(memory):
    blocks = [(b % 3, bytes([b]) * b) for b in range(20)]
    with repeats.Blocks(memory) as held:
        for b, x in blocks:
            held.add(b, x)
        assert {b: list(held.take(b)) for b in held.buckets()} == {
            b: [x for c, x in blocks if c == b] for b in range(3)}


def embeddings(spark):
    rng = np.random.default_rng(2)
    rows, v = [], rng.normal(size=(40, 12))
    for i in range(300):
        e = v[i % 40] + rng.normal(size=12) * (0.05 if i % 3 else 0.12)
        rows.append((i, [float(np.float32(x)) for x in e], i % 40 % 4))
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(50)]
    rows += [(400, None, 0), (401, [0.0] * 12, 0), (402, [None, *rows[0][1][1:]], 0), (403, rows[0][1], None),
             (404, [float("nan")] * 12, 0), (405, [float("inf")] * 12, 0), (406, [], 0),
             (407, [1.0, 2.0], 0), (408, [1.0, 2.0], 0), (409, [2.0, 4.0], 0), (410, [1e-30] * 12, 0),
             (411, [1e30] * 12, 0)]
    return spark.createDataFrame([r + ("x", 1) for r in rows],
                                 "vec_id long, embedding array<float>, label int, salt string, n int"), rows


@pytest.mark.parametrize("options", [{}, {"list_rows": 8, "part_work": 500, "sample_rows": 100}])
def test_embedding_dedup(spark, options):
    df, rows = embeddings(spark)
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(df.repartition(3), **options).collect()}
    good = {k: np.array(e, np.float64) for k, e, label in rows if label is not None and e
            and all(x is not None and np.isfinite(x) for x in e) and any(e)}
    label = {k: x for k, _, x in rows}
    groups, n = data.Groups([r[0] for r in rows]), Counter()
    for a in good:
        for b in good:
            if a < b and label[a] == label[b] and len(good[a]) == len(good[b]):
                x, y = good[a], good[b]
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
                    groups.join(a, b)
                    n[a] += 1
                    n[b] += 1
    assert sum(n.values()) > 1000
    assert len(got) == len(rows)
    for k in label:
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (
            n[k], groups.find(k), groups.find(k) == k), k


def test_embeddings_in_doubles_and_in_dense_groups(spark):
    """Doubles are not rounded; a dense group gives as many rows as it has vectors, not pairs."""
    rng = np.random.default_rng(8)
    # Just below and just above the threshold, which single precision cannot tell apart.
    angle = np.arccos(0.98)
    rows = [(0, [1.0, 0.0], 1), (1, [float(np.cos(angle * (1 + 1e-12))), float(np.sin(angle * (1 + 1e-12)))], 1),
            (2, [0.0, 1.0], 2), (3, [float(np.sin(angle * (1 - 1e-12))), float(np.cos(angle * (1 - 1e-12)))], 2)]
    kinds = "vec_id long, embedding array<double>, label int"
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.embedding_dedup(spark.createDataFrame(rows, kinds)).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1}
    base = rng.normal(size=16)
    dense = [(i, (base + rng.normal(size=16) * 0.01).tolist(), 1) for i in range(600)]
    classes = embedding_dedup.classes_of(spark.createDataFrame(dense, kinds))
    found = embedding_dedup.links(classes, list_rows=50, part_work=20_000)
    parts = found.count()
    assert parts < 30 * 600 < 600 * 599 // 2
    rows = embedding_dedup.embedding_dedup(spark.createDataFrame(dense, kinds), list_rows=50, part_work=20_000).collect()
    assert {(r["n_links"], r["component_id"]) for r in rows} == {(599, 0)}


def test_empty_tables(spark):
    none = data.documents(spark, {}, repeat=False)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.keep_one(none).columns == none.columns
    assert simhash.simhash_dedup(none).count() == 0
    assert suffix_dedup.suffix_dedup(none).count() == 0
    assert window_dedup.window_dedup(none).count() == 0
    df, _ = embeddings(spark)
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0
