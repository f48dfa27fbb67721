"""Near duplicates of texts and of embeddings, and connected components, against brute force."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from estrella.llm import common, embeddings, setsketch
from estrella.llm import textbytes as tb


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_connected_components(spark, shape):
    rng = random.Random(4)
    pairs = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(99, i) for i in range(50)] + [(0, 0), (3, 99), (99, 3)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        "empty": [],
    }[shape]
    edges = spark.createDataFrame([*pairs, (None, 1)], "a long, b long")
    got = {r["node"]: r["component"] for r in common.connected_components(edges).collect()}
    pairs = [p for p in pairs if p[0] != p[1]]
    assert got == components({x for p in pairs for x in p}, pairs)


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    ids = [d if d is not None else 10**9 + i for i, (d, _) in enumerate(rows)]
    pairs = [
        (ids[i], ids[j])
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    part = components(set(ids), pairs)
    return collections.Counter((d, len(s), part[i], i == part[i]) for d, i, s in zip([r[0] for r in rows], ids, sets))


def run(spark, rows, width, percent):
    docs = spark.createDataFrame([(d, t, b"x", 3, "c", 4) for d, t in rows], "doc_id long, text string, cls binary, size int, component string, block int")
    return collections.Counter(map(tuple, setsketch.near_duplicates(docs, width, percent).collect()))


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("width,percent,blocks", [(3, 85, 512), (5, 80, 7)])
def test_near_duplicates(spark, monkeypatch, width, percent, blocks):
    monkeypatch.setattr(setsketch, "SET_BLOCK", blocks)
    monkeypatch.setattr(setsketch, "SKETCH_BLOCK", 3 * blocks)
    rng = random.Random(1)
    rows = []
    for _ in range(12):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([40, 200, 900]))]
        rows += [" ".join(base)] * rng.randrange(1, 4)
        rows += [edited(base, rng.randrange(1, max(2, len(base) // 15)), rng) for _ in range(8)]
    rows += [None, "", " \t", "one", "ONE", "one two", "one  two\n", "one two three", "É a", "é a", "x " * 50, "x " * 70]
    rows.append(" ".join(f"z{i}" for i in range(60_000)))
    order = list(range(len(rows)))
    rng.shuffle(order)
    rows = [(d, rows[i]) for d, i in enumerate(order)] + [(3, rows[order[3]])]
    assert run(spark, rows, width, percent) == brute(rows, width, percent)


def test_near_duplicates_of_the_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = collections.Counter(map(tuple, setsketch.near_duplicates(docs, 3, 85).collect()))
    assert got == brute(rows, 3, 85)


def test_null_id_and_empty_table(spark):
    text = "a b c d e f g"
    got = run(spark, [(None, text), (7, text), (4, text), (None, "other words here now ok")], 3, 85)
    assert got == {(None, 5, 4, False): 1, (7, 5, 4, False): 1, (4, 5, 4, True): 1, (None, 3, None, True): 1}
    assert run(spark, [], 3, 85) == {}


def test_registers_are_mergeable_and_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(1, 2**63, 3000, dtype=np.uint64)
    for common_part in (0.0, 0.3, 0.6, 0.9):
        got = []
        for k in range(20):
            x = tb.mix(pool + np.uint64(k))
            n = 1000
            a, b = x[:n], x[int(n * (1 - common_part)) : int(n * (1 - common_part)) + 800]
            both = np.union1d(a, b)
            sk = setsketch.registers(
                np.concatenate([a, b, both]), np.repeat([0, 1, 2], [len(a), len(b), len(both)]), 3
            )
            assert (setsketch.merge(sk[0], sk[1]) == sk[2]).all()
            truth = len(np.intersect1d(a, b)) / len(both)
            got.append(setsketch.estimate(sk[0], len(a), sk[1], len(b)) - truth)
        assert abs(np.mean(got)) < 0.03 and np.std(got) < 0.06


def test_small_sets_fill_all_registers():
    one = setsketch.registers(np.array([5], np.uint64), np.array([0]), 1)
    again = setsketch.registers(np.array([9, 5], np.uint64), np.array([0, 1]), 2)
    assert (one[0] == again[1]).all() and (one > 0).all()


def brute_vectors(rows, threshold):
    ok = []
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            x = x / np.abs(x).max()
            ok.append((i, x / np.linalg.norm(x)))
    pairs = [(i, j) for i, x in ok for j, y in ok if i != j and len(x) == len(y) and x @ y >= threshold]
    ids = [r[0] for r in rows]
    links = collections.Counter(i for i, _ in pairs)
    part = components(set(ids), [(ids[a], ids[b]) for a, b in pairs])
    return {d: (links[i], part[d], part[d] == d) for i, d in enumerate(ids)}


@pytest.mark.parametrize("block", [2048, 16])
def test_embedding_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(15):
        base = rng.standard_normal(16)
        vectors += [base + rng.standard_normal(16) * s for s in rng.uniform(0, 0.25, 8)]
        vectors += [base, base, 3 * base]
    vectors = [list(map(float, v)) for v in vectors]
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 0.0], [2.0, 0.0], [1e300] * 16, [-1e300] * 16, [1e-300] * 16]
    rng.shuffle(order := np.arange(len(vectors)))
    rows = [(d, vectors[i]) for d, i in enumerate(order.tolist())]
    df = spark.createDataFrame([(d, v, "l", 1) for d, v in rows], "vec_id long, embedding array<double>, cls string, size int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.embedding_duplicates(df).collect()}
    assert got == brute_vectors(rows, 0.9)


def test_embeddings_of_the_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.embedding_duplicates(df).collect()}
    assert got == brute_vectors(rows, 0.9)
    assert embeddings.embedding_duplicates(df.limit(0)).collect() == []
    twice = embeddings.embedding_duplicates(df.unionAll(df)).where("vec_id = 0").collect()
    assert len(twice) == 2 and twice[0]["n_links"] == 2 * got[0][0] + 1


def test_bucket_keys_agree_as_often_as_the_docstring_says():
    rng = np.random.default_rng(3)
    x = embeddings.unit(rng.standard_normal((4000, 64)))
    y = rng.standard_normal((4000, 64))
    y = embeddings.unit(y - (x * y).sum(1, keepdims=True) * x)
    near = 0.9 * x + np.sqrt(1 - 0.81) * y
    args = (embeddings.TABLES, embeddings.HASHES, embeddings.WIDTH, embeddings.SEED)
    same = embeddings.bucket_keys(x, *args) == embeddings.bucket_keys(near, *args)
    assert same.mean() == pytest.approx(0.2076, abs=0.01)
    assert (~same.any(axis=1)).mean() < 0.004
    assert (embeddings.bucket_keys(x, *args) == embeddings.bucket_keys(y, *args)).mean() < 0.006


def test_tables_follow_the_number_of_vectors():
    assert embeddings.table_plan(0, 0.9) == embeddings.table_plan(500, 0.9) == (embeddings.TABLES, embeddings.HASHES)
    assert embeddings.table_plan(10, 1.0)[0] == 1
    rng = np.random.default_rng(6)
    met = {}
    for n in (1500, 24_000):
        x = embeddings.unit(rng.standard_normal((n, 64)))
        y = rng.standard_normal((n, 64))
        near = 0.9 * x + np.sqrt(1 - 0.81) * embeddings.unit(y - (x * y).sum(1, keepdims=True) * x)
        tables, hashes = embeddings.table_plan(n, 0.9)
        args = (tables, hashes, embeddings.WIDTH, embeddings.SEED)
        keys = embeddings.bucket_keys(x, *args)
        assert (keys == embeddings.bucket_keys(near, *args)).any(axis=1).mean() > 0.997
        sizes = [np.unique(keys[:, t], return_counts=True)[1].astype(float) for t in range(tables)]
        met[n] = sum((s * (s - 1) / 2).sum() for s in sizes)
    assert np.log(met[24_000] / met[1500]) / np.log(24_000 / 1500) < 1.35


@pytest.mark.parametrize("dim", [1, 2, 64, 2000])
def test_coarse_vectors_bound_the_cosine(dim):
    rng = np.random.default_rng(dim)
    x = rng.standard_normal((300, dim)) * rng.choice([1, 1e-3, 30], (300, dim))
    x = embeddings.unit(np.concatenate([x, x + 0.01 * rng.standard_normal(x.shape)]))
    bound = embeddings.most_cosine(*embeddings.coarse(x))
    assert (bound >= x @ x.T).all() and (bound - x @ x.T).max() < 0.02 + 0.02 * np.sqrt(dim)


def test_more_tables_give_the_same_links(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 32))
    x = np.concatenate([b + rng.standard_normal((9, 32)) * rng.uniform(0, 0.3, (9, 1)) for b in base])
    rows = [(i, list(map(float, v))) for i, v in enumerate(x)]
    monkeypatch.setattr(embeddings, "ROOM", 0.05)
    monkeypatch.setattr(embeddings, "BLOCK", 4)
    assert embeddings.table_plan(len(x), 0.9)[1] > embeddings.HASHES
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.embedding_duplicates(df).collect()}
    assert got == brute_vectors(rows, 0.9)


@pytest.mark.parametrize("few", [0, 32, 10**6])
def test_may_link_equals_the_bounds_of_each_group(monkeypatch, few):
    monkeypatch.setattr(embeddings, "FEW", few)
    rng = np.random.default_rng(9)
    sizes = [1, 1, 2, 5, 40, 1, 3, 70, 2]
    starts = np.cumsum([0, *sizes])
    dim = np.repeat([16, 16, 16, 16, 16, 3, 3, 16, 8], sizes)
    cols = collections.defaultdict(list)
    truth = []
    for g, (n, d) in enumerate(zip(sizes, dim[starts[:-1]])):
        x = rng.standard_normal((n, d)) + 2 * rng.integers(0, 2, (n, 1))
        cells, step, error = embeddings.coarse(embeddings.unit(x))
        two = g % 2
        block = rng.integers(0, 2, n) if two else np.zeros(n, int)
        pairs = embeddings.most_cosine(cells, step, error) >= 0.8
        np.fill_diagonal(pairs, False)
        truth += (pairs & ((block[:, None] != block) | (not two))).any(axis=1).tolist()
        cols["cells"] += [c.tobytes() for c in cells]
        for name, values in (("step", step), ("error", error), ("block", block), ("bi", [0] * n), ("bj", [two] * n)):
            cols[name] += list(map(float if name in ("step", "error") else int, values))
        cols["tab"] += [g] * n
    rows = pa.table({**cols, "dim": dim, "bucket": np.zeros(len(dim), int)})
    assert embeddings.may_link(rows, starts, 0.8).tolist() == truth and any(truth) and not all(truth)


@pytest.mark.parametrize("most_bytes", [1, 400, 10**6])
def test_runs_hold_whole_groups(most_bytes):
    rng = random.Random(5)
    keys = sorted((rng.randrange(3), rng.randrange(6)) for _ in range(200)) + [(9, 9)] * 90
    cut = sorted({0, len(keys), *(rng.randrange(len(keys)) for _ in range(30))})
    a, b = (pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))
    whole = pa.record_batch([a, b], ["a", "b"])
    batches = [whole.slice(0, 0)] + [whole.slice(s, e - s) for s, e in zip(cut, cut[1:])]
    got = []
    for rows, starts in common.iter_runs(iter(batches), ["a", "b"], most_bytes):
        listed = list(zip(rows["a"].to_pylist(), rows["b"].to_pylist()))
        for s, e in zip(starts, starts[1:]):
            assert len(set(listed[s:e])) == 1
            got.append((listed[s], e - s))
    assert got == sorted(collections.Counter(keys).items())
    assert list(common.iter_runs(iter([]), ["a"], 1)) == []
