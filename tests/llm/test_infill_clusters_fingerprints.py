"""Fill-in-middle, centroid clusters and fingerprints against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from estrella.llm import clusters, fingerprints, infill

DOCS = "doc_id long, text string, n int, form string, output string, part int, opening string, nth int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "f", "o", 2, "p", 3) for i, t in rows], DOCS)


CASES = [(5, None), (1, ""), (2, "a b c"), (2, "a b c"), (2, "another text"), (None, "null id é😀"), (None, None)]
CASES += [(9, "long\nwörd " * 9000), (7, "has <M> in it"), (8, "x"), (4, "<P<S"), (10, "日本語 \n\n テスト ")]
CASES += [(100 + i, f"text {i} " * (i % 7) + "<") for i in range(120)]


# ---- fill in middle


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=400), st.integers(0, 5))
def test_skip_list_reaches_every_rank(widths, turn):
    lanes = infill.SkipList(np.array(widths, np.int64))
    at = np.concatenate([[0], np.cumsum(widths)]).tolist()
    assert [lanes.seek(r) for r in range(len(widths) + 1)] == at
    for (passed, points, _), (above, more, below) in zip(lanes.lanes, lanes.lanes[1:]):
        assert above.sum() == passed.sum() and more.sum() == points.sum() and len(above) == len(below) < len(passed)


def test_skip_list_of_a_long_text_has_few_lanes():
    lanes = infill.SkipList(infill.char_widths("x" * 300_000))
    assert 4 <= len(lanes.lanes) <= 10
    assert [lanes.seek(r) for r in (0, 1, 77_777, 299_999, 300_000)] == [0, 1, 77_777, 299_999, 300_000]


def units_by_hand(text, unit):
    return {"char": list, "word": lambda t: re.findall(r"\s*\S+|\s+", t), "line": lambda t: t.splitlines(keepends=True)}[
        unit
    ](text)


def infill_by_hand(doc, text, unit):
    text = text or ""
    parts = units_by_hand(text, unit)
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return (doc, len(parts), "plain", None, None, text)
    a, b = sorted((h[0] % (len(parts) + 1), h[1] % (len(parts) + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return (doc, len(parts), "spm" if h[3] % 100 < 20 else "psm", len(p), len(m), out)


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_fill_in_middle(spark, unit):
    got = infill.fill_in_middle(frame(spark, CASES), unit).withColumn("back", infill.restored()).collect()
    assert collections.Counter(tuple(r)[:6] for r in got) == collections.Counter(infill_by_hand(d, t, unit) for d, t in CASES)
    assert collections.Counter((r["doc_id"], r["back"]) for r in got) == collections.Counter((d, t or "") for d, t in CASES)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_nothing(spark):
    assert infill.digests(infill.fill_in_middle(frame(spark, []))).collect() == []
    with pytest.raises(ValueError):
        infill.fill_in_middle(frame(spark, []), "page")


# ---- clusters


def clusters_by_hand(rows, k, rounds, dims):
    kept = [
        (i, [int(np.floor(64 * float(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [list(q) for _, q in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = collections.defaultdict(list)
        for _, q in kept:
            of[nearest(q)[1]].append(q)
        for n, members in of.items():
            centroids[n] = [sum(col) // len(members) for col in zip(*members)]
    out = [(i, *nearest(q)[::-1]) for i, q in kept]
    inertia = collections.Counter()
    for _, n, d in out:
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return collections.Counter((i, n, d, inertia[n], sum(inertia.values()), sha[n]) for i, n, d in out)


VECTORS = "vec_id long, embedding array<double>, cluster int, ids string, codes string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], VECTORS)


@pytest.mark.parametrize("dims,block,chunk", [(64, 2, 8192), (64, 4, 7), (7, 3, 5)])
def test_clusters(spark, dims, block, chunk):
    rng = np.random.default_rng(dims)
    centre = rng.standard_normal((5, dims))
    rows = [(i, (centre[i % 5] + 0.4 * rng.standard_normal(dims)).tolist()) for i in range(150)]
    rows += [rows[3], (3, rows[4][1]), (None, rows[5][1]), (None, rows[5][1]), (900, rows[6][1]), (901, rows[6][1])]
    rows += [(950, None), (951, []), (952, [1.0] * (dims - 1)), (953, [float("nan")] + [0.0] * (dims - 1))]
    rows += [(954, [None] + [0.0] * (dims - 1)), (955, [float("inf")] * dims), (956, [0.0] * dims), (957, [-1e4] * dims)]
    for k in (1, 16):
        got = clusters.cluster_vectors(vectors(spark, rows), k=k, dims=dims, block_dims=block, chunk=chunk)
        assert collections.Counter(map(tuple, got.collect())) == clusters_by_hand(rows, k, 3, dims)


def test_clusters_keep_an_empty_one(spark):
    # equal vectors: the later of two equal centroids never gets a vector
    rows = [(i, [float(i % 2)] * 64) for i in range(20)]
    got = clusters.cluster_vectors(vectors(spark, rows), k=16).collect()
    assert collections.Counter(map(tuple, got)) == clusters_by_hand(rows, 16, 3, 64)
    assert len({r["cluster"] for r in got}) == 2


def test_clusters_of_few_and_none(spark):
    rows = [(1, [0.5] * 64), (2, [0.25] * 64)]
    got = clusters.cluster_vectors(vectors(spark, rows)).collect()
    assert {(r["vec_id"], r["distance"]) for r in got} == {(1, 0), (2, 0)} and len({r["cluster"] for r in got}) == 2
    assert clusters.cluster_vectors(vectors(spark, [(1, None)])).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        clusters.cluster_vectors(vectors(spark, [(1, [1e300] * 64)])).collect()


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(1)
    values = rng.integers(-6, 7, (400, 10))
    for width in (1, 2, 3, 10):
        subs, codes = clusters.encode_chunk(values, width)
        assert (np.concatenate([s[c] for s, c in zip(subs, codes)], axis=1) == values).all()
        assert all(len(np.unique(s, axis=0)) == len(s) for s in subs)
        centroids = rng.integers(-6, 7, (5, 10))
        d = clusters.distances(subs, codes, centroids)
        assert (d == ((values[:, None] - centroids[None]) ** 2).sum(axis=2)).all()
        cluster = d.argmin(axis=1)
        sums = clusters.cluster_sums(subs, codes, cluster, 5)
        assert (sums == [values[cluster == k].sum(axis=0) for k in range(5)]).all()


# ---- fingerprints


def test_prefix_arrays_by_definition(monkeypatch):
    text = "aé😀z" * 9
    codes = [ord(c) for c in text]
    want = [
        [sum((c + 1) * pow(b, j, fingerprints.PRIME) for j, c in enumerate(codes[:i])) % fingerprints.PRIME for i in range(len(codes) + 1)]
        for b in fingerprints.BASES
    ]
    for size in (1, 5, 1 << 16):
        monkeypatch.setattr(fingerprints, "SLICE", size)
        assert fingerprints.Hashed(text).prefix.tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=30), st.text("ab", max_size=30), st.data())
def test_extensions_and_spans(x, y, data):
    a, b = fingerprints.Hashed(x), fingerprints.Hashed(y)
    i, j = data.draw(st.integers(0, len(x))), data.draw(st.integers(0, len(y)))
    most = min(len(x) - i, len(y) - j)
    for length in range(most + 1):
        assert a.same(i, b, j, length) == (x[i : i + length] == y[j : j + length])
    assert a.extension(i, b, j) == max(n for n in range(most + 1) if x[i : i + n] == y[j : j + n])
    back = [n for n in range(min(i, j) + 1) if x[i - n : i] == y[j - n : j]]
    assert a.extension_back(i, b, j) == max(back)


def slow_likeness(x, y):
    """From the texts themselves, at the positions that both fingerprints keep."""
    if x == y:
        return 1.0
    short, long = sorted((len(x), len(y)))
    if not short:
        return 0.0
    step = max(fingerprints.step_of(len(x)), fingerprints.step_of(len(y)))
    at = range(0, short + 1, step)
    start = max(n for n in at if x[:n] == y[:n])
    end = max(n for n in at if x[len(x) - n :] == y[len(y) - n :])
    return min(start + end, short, long - 1) / long


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", max_size=200), st.integers(0, 200), st.integers(0, 200), st.text("ab ", max_size=60))
def test_likeness_is_that_of_the_texts(x, lo, hi, new):
    y = x[:lo] + new + x[hi:]
    a, b = fingerprints.Hashed(x).fingerprint, fingerprints.Hashed(y).fingerprint
    assert fingerprints.likeness(a, b) == fingerprints.likeness(b, a) == slow_likeness(x, y)
    assert (a == b) == (x == y) and fingerprints.parse(str(a)) == a


def test_likeness_finds_the_shared_part():
    rng = random.Random(0)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    other = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    f = lambda t: fingerprints.Hashed(t).fingerprint
    assert 0.45 < fingerprints.likeness(f(text), f(fingerprints.edited(text, other))) <= 0.5
    assert fingerprints.likeness(f(text), f(text[:2500] + "!" + text[2501:])) > 0.9
    assert fingerprints.likeness(f(text), f(other)) < 0.05


def compared_by_hand(rows):
    """doc_id and sha256 of the edited text, where no doc_id has two different texts."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = collections.Counter()
    for (d, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        new = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        start = next((i for i, (p, q) in enumerate(zip(t, new)) if p != q), min(len(t), len(new)))
        end = next((i for i, (p, q) in enumerate(zip(t[::-1], new[::-1])) if p != q), min(len(t), len(new)))
        end = min(end, min(len(t), len(new)) - start)
        text, other = fingerprints.Hashed(t).fingerprint, fingerprints.Hashed(new).fingerprint
        near = (slow_likeness(t, new), slow_likeness(t, n))
        out[(d, len(t), hashlib.sha256(new.encode()).hexdigest(), str(text), str(other), *near, start, end)] += 1
    return out


def test_compare_with_next(spark):
    rows = [r for r in CASES if r[0] is not None and r != (2, "another text")] + [(None, "no id")] * 3
    for parts in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            got = fingerprints.compare_with_next(frame(spark, rows).repartition(5)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert collections.Counter(map(tuple, got)) == compared_by_hand(rows)
    same = {}
    for r in got:
        same.setdefault(r["fingerprint"], set()).add(next(t or "" for d, t in rows if d == r["doc_id"]))
    assert all(len(texts) == 1 for texts in same.values())


def test_compare_with_next_of_one_hot_id(spark):
    rows = [(4, "same text of a third")] * 100 + [(4, f"text {i}") for i in range(50)] + [(i, "b" * i) for i in range(10, 60)]
    got = fingerprints.compare_with_next(frame(spark, rows).repartition(6)).collect()
    assert len(got) == 200
    copies = [r for r in got if r["doc_id"] == 4 and r["near_next"] == 1.0]
    assert len(copies) >= 99 and len({r["fingerprint"] for r in copies}) == 1


def test_compare_of_one_and_none(spark):
    one = fingerprints.compare_with_next(frame(spark, [(3, "abcdé")])).collect()
    assert collections.Counter(map(tuple, one)) == compared_by_hand([(3, "abcdé")])
    assert fingerprints.compare_with_next(frame(spark, [])).collect() == []


def test_fingerprints_of_the_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = fingerprints.compare_with_next(docs)
    assert collections.Counter(map(tuple, got.collect())) == compared_by_hand(rows)
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    assert plain == {r["doc_id"]: r["fingerprint"] for r in got.collect()}
