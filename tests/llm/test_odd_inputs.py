"""Clashing column names, hot and missing ids, partitioned folders: what rows come out."""

import random
import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from estrella.llm import common, langid, quality, queries, sharding, token_files

NAMES = ["txt", "_ta", "_tb", "_key0", "_key1", "row", "n", "d", "t", "score", "code_bits", "lang_pred", "c0", "cls", "_host", "drop"]


@pytest.fixture()
def clashing(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(60)
    extra = {name: F.concat(F.lit(f"{name} of "), F.col("doc_id")) for name in NAMES}
    tags = F.create_map(F.lit("k"), F.col("doc_id"))
    return common.materialize(docs.unionAll(docs.limit(20)).withColumns(extra).withColumn("tags", tags), "clashing")


@pytest.mark.parametrize("limit", [400_000, 0])
@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES[:-1]])
def test_stages_hand_back_all_columns(spark, sf_small, monkeypatch, clashing, name, limit):
    monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    out = dict(cp.STAGES)[name](spark, clashing, sf_small)
    assert out.columns == clashing.columns and [f.dataType for f in out.schema] == [f.dataType for f in clashing.schema]
    rows = out.collect()
    assert len(rows) > 20
    for r in rows:
        assert all(r[c] == f"{c} of {r['doc_id']}" for c in NAMES) and r["tags"] == {"k": r["doc_id"]}


def test_resharding_of_partitioned_folders(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs.repartition(1).write.partitionBy("lang").parquet(f"{tmp_path}/documents.parquet")
    got = queries.op5_resharding(spark, str(tmp_path)).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r["doc_id"] for r in docs.collect())


@pytest.mark.parametrize("hot", ["cast(null as bigint)", "7"])
def test_samples_are_bounded_for_a_hot_id(spark, hot):
    rows = spark.range(0, 12_000, 1, 6).selectExpr(
        f"if(id % 2 = 0, {hot}, id) doc_id", "if(id % 4 = 0, 'same text', concat('text ', id)) text",
        "'en' lang", "cast(id % 3 = 0 as int) quality",
    )
    _, sample = langid.sample_rows(rows, docs_per_language=500)
    assert 400 < sample.count() < 600
    _, sample = langid.sample_rows(rows, docs_per_language=500, bytes_per_language=2000)
    assert sample.agg(F.sum(F.octet_length("text"))).first()[0] < 2800
    for labels in (rows.select("doc_id", "quality"), rows.where("doc_id = 7").select("doc_id", "quality")):
        n = quality.sample_rows(rows.select("doc_id", "text"), labels, sample_docs=500).count()
        assert n < 600


def test_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    foreign = [
        "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita.",
        "De vergadering van morgen gaat niet door omdat de voorzitter ziek is en niemand hem vervangen kan. "
        "Wij zoeken nog een geschikte dag in de volgende week, want er liggen veel vragen over het gebouw.",
        "Широка страна моя родная, много в ней лесов, полей и рек",
        "今天的会议取消了，因为主席病了，没有人可以代替他。",
        "xq zvw kkjh qpwz vbnm xcvw qzzk wvvx kjqq zzxw zqk vvx pqj wzzy kxq bvvk hjq xzw qqk vwx zkj",
    ]  # of some length: SLACK_BITS lets very short texts pass
    rows = spark.createDataFrame([(i, t, None) for i, t in enumerate(foreign)], "doc_id long, text string, lang string")
    assert langid.keep_languages(rows, model).count() == 0
    known = docs.where(langid.held_out() & F.col("lang").isNotNull() & (F.length("text") > 50))
    assert langid.keep_languages(known, model).count() == known.count()


def test_moved_bytes_of_long_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 16)
    rows = [(i, "x" * (7 * i % 400), 0 if i % 3 else 1, i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, old int, row long")
    assigned, _ = sharding.assign(common.materialize(sharding.row_sizes(docs).drop("text"), "rows"), 4)
    moved = sharding.moved_bytes(assigned).first()
    sizes = collections.defaultdict(list)
    for _, t, old, _ in rows:
        sizes[old].append(len(t) + sharding.OVERHEAD)
    least = sum(sum(sorted(s)[: len(s) - 150]) for s in sizes.values())
    assert moved["rows"] == 300 and least <= moved["bytes"] <= least * 1.001


def test_bloom_streams_and_stripes(spark, tmp_path):
    path = str(tmp_path / "ids")
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('word ', id) as text")
    token_files.write_token_files(docs.repartition(3), path, queries.tokenizer_path())
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    files = sorted((tmp_path / "ids").glob("part-*.orc"))
    assert files
    for f in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(
            jvm.org.apache.hadoop.fs.Path(str(f)), jvm.org.apache.orc.OrcFile.readerOptions(conf)
        )
        if not reader.getNumberOfRows():
            continue
        kinds = set()
        rows = reader.rows()
        for stripe in reader.getStripes():
            footer = rows.readStripeFooter(stripe)
            kinds |= {(s.getKind().toString(), s.getColumn()) for s in footer.getStreamsList()}
        rows.close()
        assert ("ROW_INDEX", 1) in kinds and any(k.startswith("BLOOM_FILTER") and c == 1 for k, c in kinds)


@pytest.mark.parametrize("part_rows", [4, 10**6])
def test_resharding_moves_the_smallest_rows(spark, monkeypatch, part_rows):
    """Bytes moved against the least possible: every old shard gives up its smallest rows."""
    monkeypatch.setattr(sharding, "PART_ROWS", part_rows)
    rng = random.Random(12)
    rows = []
    for old, n in enumerate([400, 90, 7, 30]):
        # close sizes inside one class, one size many times, and a long tail
        pick = lambda: rng.choice([rng.randrange(900, 1060), 977, rng.randrange(3000)])
        rows += [(len(rows) + i, "x" * pick(), old) for i in range(n)]
    rows += [rows[0]] * 25
    docs = spark.createDataFrame(rows, "doc_id long, text string, old int")
    shards = 6
    assigned, _ = sharding.assign(common.materialize(sharding.row_sizes(docs).drop("text"), "rows"), shards)
    got = assigned.collect()
    assert len(got) == len(rows)
    for s in range(shards):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and len(slots) - len(rows) // shards in (0, 1)
    least, saved = 0, []
    base, more = divmod(len(rows), shards)
    for old in range(shards):
        sizes = sorted(len(t) + sharding.OVERHEAD for _, t, o in rows if o == old)
        gone = sizes[: max(0, len(sizes) - base)]
        stays = sum(1 for r in got if r["old"] == old and r["shard"] == old)
        left = sorted(r["size"] for r in got if r["old"] == old and r["shard"] != old)
        assert left == sizes[: len(sizes) - stays]
        least += sum(gone)
        saved += gone[-1:]
    least -= sum(sorted(saved)[::-1][:more])
    # which shards get one row more is chosen by the means of size classes
    assert least <= sharding.moved_bytes(assigned).first()["bytes"] <= least * 1.01


def test_files_of_shards_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FILE_BYTES", 20_000)
    rng = random.Random(2)
    rows = [(i, "x" * rng.choice([0, 10, 500, 3000, 30_000][: 4 + (i % 50 == 0)]), i % 3) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, old int")
    assigned, _ = sharding.assign(common.materialize(sharding.row_sizes(docs).drop("text"), "rows"), 4)
    files = collections.defaultdict(list)
    for r in assigned.collect():
        files[r["shard"], r["file"]].append((r["slot"], r["size"]))
    for held in files.values():
        held.sort()
        assert [s for s, _ in held] == list(range(held[0][0], held[0][0] + len(held)))
        assert sum(n for _, n in held) <= 20_000 or len(held) == 1
    assert 20 < len(files) < 120
