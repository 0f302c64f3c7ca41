"""Links and classes: components, near duplicates among vectors and texts, whatever the partitions."""

import contextlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import embeddings, minhash
from ledgerline.llm.components import _large_star, _open, _small_star, components, further, local_components, more_trees, trees


@contextlib.contextmanager
def partitions(spark, n):
    """Shuffles with n partitions that AQE leaves alone."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("n", [1, 9])
def test_components_whatever_the_partitions(spark, n):
    draw = np.random.default_rng(3)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(300)]
    rest = [(2000 + int(a), 2000 + int(b)) for a, b in draw.integers(0, 400, (260, 2))]
    edges = [chain[i] for i in draw.permutation(60)] + star + rest
    names = sorted({x for e in edges for x in e})
    at = np.searchsorted(names, np.array(edges))
    label = local_components(len(names), at[:, 0], at[:, 1])
    want = {v: names[label[i]] for i, v in enumerate(names) if any(v in e and e[0] != e[1] for e in edges)}
    with partitions(spark, n):
        half = len(edges) // 2
        first = components(spark.createDataFrame(edges[:half], "u long, v long").repartition(n))
        both = further(first, spark.createDataFrame(edges[half:], "u long, v long").repartition(n))
        assert {r.vertex: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()} == want
        assert {r.vertex: r.component for r in both.collect()} == want


def test_a_step_reads_its_edges_once_a_shuffle(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "u long, v long")
    with partitions(spark, 5):
        step = _small_star(_large_star(edges))
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Union") <= 1
        assert _open(edges) and not _open(spark.createDataFrame([(3, 1), (2, 1), (9, 8)], "u long, v long"))


def test_trees_leave_out_the_smallest(spark):
    first = trees(spark.createDataFrame([(1, 2), (3, 2), (7, 8), (5, 5), (None, 1)], "u long, v long"))
    assert {tuple(r) for r in first.collect()} == {(2, 1), (3, 1), (8, 7)}
    more = more_trees(first, spark.createDataFrame([(8, 3), (7, 0), (20, 21)], "u long, v long"))
    assert {tuple(r) for r in more.collect()} == {(1, 0), (2, 0), (3, 0), (7, 0), (8, 0), (21, 20)}


# op7


def brute(rows, least=0.9):
    """n_links and component of every (id, vector) by comparing all pairs."""
    x = np.array([v for _, v in rows], np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    ids = np.array([i for i, _ in rows])
    order = np.argsort(ids)
    label = local_components(len(ids), *np.nonzero(near[np.ix_(order, order)]))
    return {int(ids[o]): (int(near[o].sum()), int(ids[order][label[k]])) for k, o in enumerate(order)}


def found(vectors, **options):
    return {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(vectors, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"block": 16}, {"dense": 0}, {"dense": 0, "block": 16}])
def test_planted_pairs_among_the_registered_vectors(spark, sf_dir, options):
    draw = np.random.default_rng(6)
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    for k in range(150):
        v = np.array(rows[k % 50][1])
        rows.append((10_000 + k, [float(x) for x in v + draw.uniform(0.02, 0.07) * np.linalg.norm(v) * draw.standard_normal(64)]))
    rows += [(20_000 + k, rows[3][1]) for k in range(40)]
    want, got = brute(rows), found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **options)
    links = sum(n for n, _ in want.values())
    assert links > 1000 and set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in got)  # no pair below the threshold counts
    assert sum(n for n, _ in got.values()) > 0.99 * links and np.mean([got[i] == want[i] for i in want]) > 0.97


def test_vectors_of_extreme_size_and_odd_rows(spark):
    at = lambda i, *values: [0.0] * i + [*values] + [0.0] * (8 - i - len(values))
    rows = [(1, at(0, 1e-200, 9e-200)), (2, at(0, 9e-200, 1e-200)), (3, at(2, 1e200, 2e200)), (4, at(2, 2e200, 4e200)), (5, at(4, 5e-324)), (6, at(4, 1.0)), (7, at(5, -0.0, -2.0)), (8, at(5, 0.0, -2.0)), (9, [1.0, None]), (10, [float("inf"), 1.0]), (11, None), (11, [1.0, 1.0, 1.0]), (11, [-1.0, 1.0, 1.0])]
    source = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id long, embedding array<double>, n long, keys int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(source).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (5, 1, 5), (6, 1, 5), (7, 1, 7), (8, 1, 7), (9, 0, 9), (10, 0, 10), (11, 0, 11), (11, 0, 11), (11, 0, 11)]
    assert embeddings.near_duplicates(source.limit(0)).count() == 0


def test_repeated_ids_of_different_vectors_share_a_component(spark):
    rows = [(7, [1.0, 0.0]), (7, [0.0, 1.0]), (3, [0.0, 1.0]), (9, [1.0, 0.1])]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(3, 1, 3), (7, 1, 3), (7, 1, 3), (9, 1, 3)]


def test_tables_follow_one_rule():
    sizes = [embeddings.tables_for(10**e) for e in range(3, 12)]
    assert [k for k, _ in sizes] == sorted(k for k, _ in sizes) and sizes[-1][0] > sizes[-2][0] > 16
    for k, tables in sizes:
        assert (1 - embeddings.collision(np.sqrt(0.2)) ** k) ** tables <= embeddings.MISS


# op8


def edited(draw, words, changes, name):
    own = list(words)
    for k in draw.choice(len(own) // 6, changes, replace=False):
        own[6 * k + 5] = f"{name}x{k}"
    return " ".join(own)


def test_classes_whatever_the_partitions(spark):
    draw = np.random.default_rng(5)
    texts = []
    for g in range(160):
        words = [f"g{g}w{i}" for i in draw.integers(0, 10**6, 120)]
        texts += [edited(draw, words, 1, f"e{g}c{k}") for k in range(2 + g % 3)]
    source = spark.createDataFrame([(i, texts[k]) for i, k in enumerate(draw.permutation(len(texts)).tolist())], "doc_id long, text string").cache()
    results = []
    for n in (1, 24):
        with partitions(spark, n):
            results.append({r.doc_id: r.class_id for r in minhash.near_duplicates(source).collect()})
    assert results[0] == results[1] and len(set(results[0].values())) == 160


def test_recall_at_the_threshold(spark):
    draw, texts, pairs = np.random.default_rng(12), [], 0
    for g in range(400):
        words = [f"w{i}" for i in draw.integers(0, 10**6, 229)]  # 225 items; 5 changed words leave 200 of 250
        texts += [" ".join(words), edited(draw, words, 5, f"e{g}")]
        value, bounds = minhash.items(texts[-2:])
        pairs += minhash.similar(value[: bounds[1]], value[bounds[1] :])
    rows = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)).collect()
    caught = sum(r.doc_id != r.class_id for r in rows)
    assert pairs == 400 and caught >= 0.99 * pairs


def test_all_pairs_of_crowded_classes_are_reached(spark):
    """Two clusters, hooked by one pair only that is not among the closest that a block gives first."""
    draw = np.random.default_rng(2)
    base = [f"b{i}" for i in range(304)]
    left = [edited(draw, base, 4, f"l{i}") for i in range(60)]
    texts = [" ".join(base), *left]
    value, bounds = minhash.items(texts)
    own = [value[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    parent = list(range(len(own)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(own)):
        for k in range(i):
            if minhash.similar(own[i], own[k]):
                a, b = find(i), find(k)
                parent[max(a, b)] = min(a, b)
    rows = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block=8, closest=1).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: find(i) for i in range(len(own))}


def test_possible_pairs_of_two_sides():
    draw, own = np.random.default_rng(4), []
    for _ in range(40):
        a = draw.integers(0, 10**6, draw.integers(20, 300)).astype(np.uint32)
        own += [a, np.delete(a, draw.integers(0, len(a), len(a) // 10))]
    sizes, marks, of = np.array([len(x) for x in own]), [minhash.bitmap(x) for x in own], np.arange(len(own))
    everything = {frozenset(x) for x in zip(*(z.tolist() for z in minhash.possible(sizes, marks, of, np.full(len(own), 2))[:2]))}
    for side in (np.arange(len(own)) % 2, (np.arange(len(own)) % 9 == 0).astype(int)):
        got = [frozenset(x) for x in zip(*(z.tolist() for z in minhash.possible(sizes, marks, of, side)[:2]))]
        assert len(got) == len(set(got)) and set(got) == {p for p in everything if len({int(side[i]) for i in p}) == 2}


def test_long_texts_have_a_defined_end():
    a = np.arange(300_000, dtype=np.uint32)
    assert minhash.similar(a, np.concatenate([a[30_000:], a[:30_000]]))  # a tenth moved: 270,000 of 330,000 match
    assert not minhash.similar(a, np.concatenate([a[60_000:], a[:60_000]]))
    same = np.zeros(400_000, np.uint32)
    assert minhash.similar(same, same[:350_000]) and not minhash.similar(same, same[:300_000])
    mixed = np.tile(np.arange(3, dtype=np.uint32), 100_000)
    assert minhash.similar(mixed, np.roll(mixed, 1))  # all but one match


def _longest(a, b) -> int:
    """The longest common run in order, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b, 1):
            before, row[k] = row[k], before + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_repeated_items_are_aligned_as_by_the_plain_table():
    draw, seen = np.random.default_rng(11), []
    for trial in range(400):
        a = draw.integers(0, draw.choice([1, 2, 3, 8, 60]), draw.integers(1, 130)).astype(np.uint32)
        b = np.delete(a, draw.integers(0, len(a), draw.integers(0, len(a) // 4 + 1)))
        b = np.insert(b, draw.integers(0, len(b) + 1, draw.integers(0, 12)), draw.integers(0, 3)).astype(np.uint32)
        b = np.roll(b, draw.integers(-6, 7)) if trial % 3 == 0 else b
        m = _longest(a.tolist(), b.tolist())
        want = m >= 0.8 * (len(a) + len(b) - m) - 1e-9
        assert minhash.similar(a, b) == want, (a.tolist(), b.tolist())
        seen.append(want)
    assert 100 < sum(seen) < 350


def test_repeated_items_in_several_runs_of_rows(monkeypatch):
    monkeypatch.setattr(minhash, "PLACES_KEPT", 64)
    draw, seen = np.random.default_rng(12), []
    for _ in range(12):
        a = draw.integers(0, 12, 1_500).astype(np.uint32)
        b = np.delete(np.roll(a, draw.integers(0, 60)), draw.integers(0, 1_500, draw.integers(0, 500)))
        m = _longest(a.tolist(), b.tolist())
        seen.append(m >= 0.8 * (len(a) + len(b) - m) - 1e-9)
        assert minhash.similar(a, b) == minhash.similar(b, a) == seen[-1]
    assert 0 < sum(seen) < 12


def test_lost_copies_of_one_repeated_window():
    def text(copies, seed=13):
        own = np.random.default_rng(seed).integers(10, 1 << 32, 2_000, dtype=np.uint64).astype(np.uint32)
        return np.concatenate([own[:1_000], np.zeros(copies, np.uint32), own[1_000:]])

    assert minhash.similar(text(6_020), text(6_000))
    spread = np.zeros(8_020, np.uint32)
    spread[::7] = np.arange(1, len(spread[::7]) + 1)
    assert minhash.similar(spread, np.delete(spread, np.arange(1, 200, 7)))
    assert not minhash.similar(spread, spread[:6_000])


def test_ids_with_two_texts_share_a_class(spark):
    rows = [(10, "one two three four five six"), (10, "seven eight nine ten eleven"), (3, "seven eight nine ten eleven"), (4, "other words that stand alone here")]
    source = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.class_id) for r in minhash.near_duplicates(source).collect()} == {(10, 3), (3, 3), (4, 4)}
    assert sorted(r.doc_id for r in minhash.drop_near_duplicates(source).collect()) == [3, 4]


def test_dropping_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f g", "x", 1), (2, "a b c d e f g", "y", 2), (None, "a b c d e f g", "z", 3), (None, "h i j", "z", 3), (5, None, "w", 4)]
    source = spark.createDataFrame(rows, "doc_id long, text string, digest string, id int").withColumn("__text", F.lit(1)).withColumn("component", F.lit(2))
    got = minhash.drop_near_duplicates(source)
    assert got.columns == source.columns
    assert sorted(tuple(r)[2:4] for r in got.collect()) == [("w", 4), ("x", 1), ("z", 3)]
