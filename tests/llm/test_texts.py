"""Decontamination, line dedup, language, quality and resharding against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from estrella.llm import common, decontaminate, langid, line_dedup, quality, queries, sharding
from tests.oracle_compare import compare, duck_conn


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(docs, items, size=13):
    wins = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            wins[tuple(w[i : i + size])].add(item)
    out = set()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[k]
        ids = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.add((doc, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run_contamination(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, 2, "w") for i, t in docs], "doc_id long, text string, item_id int, wid long, w string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted(map(tuple, decontaminate.contamination(d, b).collect()), key=str)


def test_decontamination(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary = ["The", "of", "é", "É", "x1", "rare", "a", "b", "ñ中", "Q"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 12, 13, 14, 30])))) for i in range(25)]
    items += [(2, "a, a. a!"), (40, None), (41, ""), (42, "?!"), (43, items[0][1]), (None, "null item id words"), (10, "zebra")]
    docs = []
    for i in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 40, 300]))]
        for _ in range(rng.randrange(3)):
            t = rng.choice(items)[1] or ""
            w[rng.randrange(len(w) + 1) : 0] = t.upper().split() if rng.random() < 0.3 else t.split()
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    docs += [(100, None), (101, ""), (102, "..."), (103, "null item id words"), (104, "long " * 50_000 + "zebra"), (0, docs[0][1]), (None, "zebra")]
    got = run_contamination(spark, docs, items)
    alone = {(d, t): next(iter(contaminated([(d, t)], items))) for d, t in docs}
    assert got == sorted((alone[r] for r in docs), key=str)
    assert set(got) == contaminated(docs, items)
    # the other way round the prefixes: no broadcast
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert run_contamination(spark, docs, items) == got
    assert run_contamination(spark, [], items) == []
    assert {r[2:4] for r in run_contamination(spark, docs, [])} == {(0, 0)}


def test_decontamination_runs_no_python(spark, sf_small):
    plan = queries.QUERIES["op4_decontamination"](spark, sf_small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_queries_with_sql(spark, sf_small, key):
    got = compare(spark, duck_conn(sf_small), key, queries.QUERIES[key], queries.ORACLE_SQL[key], sf_small)
    assert got["ok"], got.get("why")


def lines_by_hand(rows, ratio, min_pages):
    pages, hosts = collections.Counter(), collections.Counter()
    for _, text, host in rows:
        hosts[host] += 1
        if text is not None:
            pages.update({(host, x.strip(" ")) for x in text.split("\n") if x.strip(" ")})
    asked = lambda n: ratio if n >= min_pages else max(ratio, 0.5)
    bad = {k for k, n in pages.items() if n > 1 and n > asked(n) * hosts[k[0]]}
    out = []
    for doc, text, host in rows:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if (host, x.strip(" ")) not in bad]
        out.append((doc, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_line_dedup(spark):
    rng = random.Random(6)
    rows = []
    for i in range(80):
        body = [rng.choice(["menu", " menu ", "", "footer", f"line {rng.randrange(200)}", "é"]) for _ in range(rng.randrange(6))]
        rows.append((i, "\n".join(body), rng.choice(["a", "a", "b", None])))
    rows += [(90, None, "a"), (91, "", "a"), (92, "menu", "alone"), (93, "\n\n", None), rows[0], (94, "menu\n" * 20_000, "a")]
    docs = spark.createDataFrame([(*r, 9, 8, "k") for r in rows], "doc_id long, text string, source string, n_lines int, host_pages int, key string")
    out = line_dedup.drop_boilerplate(docs, ratio=0.2, min_pages=4)
    assert set(out.columns) == {"doc_id", "text", "source", "n_lines", "n_dropped", "host_pages", "key"}
    got = sorted(map(tuple, out.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)
    assert got == lines_by_hand(rows, 0.2, 4)
    assert line_dedup.drop_boilerplate(docs.limit(0)).collect() == []


def test_small_hosts_lose_their_menus_alone(spark):
    pages = {"one": ["a\nb"], "two": ["menu\nx", "menu\ny"], "four": [f"menu\np {i}\nhalf {i // 2}" for i in range(4)]}
    rows = [(i, t, h) for i, (h, t) in enumerate((h, t) for h, texts in pages.items() for t in texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(docs).collect()}
    assert got == {i: t.replace("menu\n", "") for i, t, _ in rows}


def slow_bits(text, grams):
    """Code length of a text under one language's counts, straight from the definition."""
    total = 0.0
    data = b"\0" * 3 + text
    for i in range(3, len(data)):
        for k in (3, 2, 1, 0):
            after = grams.get(data[i - k : i])
            if after is None:
                continue
            n, d = sum(after.values()), len(after)
            if data[i] in after:
                total -= np.log2(after[data[i]] / (n + d))
                break
            total -= np.log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_follow_the_definition(spark):
    train = [("en", "the cat sat on the mat"), ("en", "The hat"), ("fr", "le chat était là, le chat"), ("fr", "où là")]
    df = spark.createDataFrame([(i, t, l) for i, (l, t) in enumerate(train)], "doc_id long, text string, lang string")
    model = langid.fit(df, docs_per_language=10**6)
    import pyarrow as pa

    from estrella.llm import textbytes as tb

    texts = ["the chat", "", "le hat là", "zzz\x00\x00qq", "日本", "é"]
    got = langid.code_lengths(model, *tb.text_buffer(pa.array(texts)))
    for j, lang in enumerate(model.languages):
        grams = collections.defaultdict(collections.Counter)
        for l, t in train:
            if l == lang:
                data = b"\0" * 3 + t.encode()
                for i in range(3, len(data)):
                    for k in range(4):
                        grams[data[i - k : i]][data[i]] += 1
        want = [slow_bits(t.encode(), dict(grams)) for t in texts]
        assert got[:, j] == pytest.approx(want, abs=1e-3)


def test_long_texts_are_scored_in_slices(monkeypatch):
    import pyarrow as pa

    from estrella.llm import textbytes as tb

    rng = np.random.default_rng(1)
    grams = rng.integers(97, 110, (500, 4))
    key = (grams * (256 ** np.arange(3, -1, -1))).sum(1)
    model = langid.build(["a", "b"], rng.integers(0, 2, 500), key, rng.integers(1, 9, 500).astype(float))
    col = pa.array(["".join(map(chr, rng.integers(97, 112, n))) for n in (0, 1, 2, 3, 500, 4, 0, 33, 0)])
    whole = langid.code_lengths(model, *tb.text_buffer(col))
    for size in (1, 2, 5, 64):
        monkeypatch.setattr(langid, "SLICE", size)
        assert langid.code_lengths(model, *tb.text_buffer(col)) == pytest.approx(whole)


def test_language_on_held_out_documents(spark):
    rows = langid.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    right = [r["lang_pred"] == want[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(right) > 100 and np.mean(right) >= 0.97


def test_language_cases(spark):
    cases = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "en"), (4, "the cat", "en"), (5, "the dog", None), (None, "the", "en"), (6, "the " * 50_000, "en"), (4, "the cat", "en")]
    df = spark.createDataFrame([(*c, "x") for c in cases], "doc_id long, text string, lang string, lang_pred string")
    got = collections.Counter((r["doc_id"], r["lang_pred"]) for r in langid.identify(df).collect())
    assert got == {(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (4, "en"): 2, (5, "en"): 1, (None, "en"): 1, (6, "en"): 1}
    assert langid.identify(df.limit(0)).collect() == []
    nothing = langid.identify(df.withColumn("lang", df.lang.substr(9, 1)).where("doc_id = 2 or doc_id = 4").selectExpr("doc_id", "text", "nullif(lang, '') lang")).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    model = langid.fit(df)
    kept = langid.keep_languages(df, model)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "4", "5", "6", "None"]


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(rows) == docs.count()
    for d, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(rows[l["doc_id"]]["score"], l["quality"]) for l in labels.collect() if rows[l["doc_id"]]["held_out"]]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_quality_cases(spark):
    texts = [(1, "good fine words"), (2, "bad $$$ junk"), (3, None), (4, ""), (5, "x" * 300_000), (None, "good"), (1, "good fine words"), (7, "zzz"), (8, "good fine day"), (9, "junk $$$")]
    docs = spark.createDataFrame([(*t, 1, "s") for t in texts], "doc_id long, text string, quality int, score string")
    labels = spark.createDataFrame([(1, 1, "t"), (2, 0, "t"), (8, 1, "t"), (9, 0, None), (5, None, "t"), (99, 1, "t"), (None, 0, "t"), (1, 1, "t")], "doc_id long, quality int, text string")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4)}) == 1
    assert quality.quality_scores(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def fewest_bytes(old, shards):
    """Least bytes to move, by trying every choice of the shards that hold one row more."""
    import itertools

    n = sum(map(len, old.values()))
    base, more = divmod(n, shards)
    best = None
    for up in itertools.combinations(range(shards), more):
        cost = 0
        for s, sizes in old.items():
            room = (base + (s in up)) if s < shards else 0
            cost += sum(sorted(sizes)[: max(0, len(sizes) - room)])
        best = cost if best is None else min(best, cost)
    return best


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(8)
    for _ in range(60):
        shards = rng.randrange(1, 6)
        old = {s: [rng.choice([16, 20, 300]) for _ in range(rng.randrange(9))] for s in range(rng.randrange(1, 7))}
        blocks = collections.Counter()
        for s, sizes in old.items():
            blocks.update((s, x) for x in sizes)
        plan = sharding.plan_transfers([(s, x, n, n * x) for (s, x), n in blocks.items()], shards)
        counts = collections.Counter()
        for p in plan:
            counts[p.shard] += p.hi - p.lo
        sizes = [counts[s] for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == sum(map(len, old.values()))
        assert sum((p.hi - p.lo) * p.cls for p in plan if p.old != p.shard) == fewest_bytes(old, shards)


@pytest.mark.parametrize("n", [0, 3, 500])
def test_resharding(spark, monkeypatch, tmp_path, n):
    monkeypatch.setattr(sharding, "PART_ROWS", 16)
    monkeypatch.setattr(sharding, "FILE_ROWS", 8)
    rng = random.Random(9)
    rows = [(i, rng.choice(["dup é", None, "", "x" * rng.randrange(400)]), rng.choice(["hot", "hot", "b", "c", None]), i, 1, 2) for i in range(n)]
    rows += [(None, "y" * 200_000, "b", n, 1, 2), rows[0][:3] + (n + 1, 1, 2)] if n > 3 else []
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row long, shard int, size int")
    from pyspark.sql import functions as F

    got = sharding.reshard(docs, sharding.source_shard(4), F.col("row"), shards=7).collect()
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < 7
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_that_keep_their_rows_are_not_written(spark, tmp_path):
    rows = [(i, "t" * i, i % 3, i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, old int, row long")
    from pyspark.sql import functions as F

    assigned, _ = sharding.assign(sharding.row_sizes(docs).drop("text"), 3)
    assert sharding.write_affected(assigned, str(tmp_path / "a")) == []
    assert sharding.moved_bytes(assigned).first()["rows"] == 0
    same = sharding.reshard(docs, F.col("old"), F.col("row"), shards=3).collect()
    assert len(same) == 30 and all(r["shard"] == r["doc_id"] % 3 for r in same)
