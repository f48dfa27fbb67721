"""Encoder, packing, token files and length histogram against the library and brute force."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from estrella.llm import packing, token_counts, token_files, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tokens.Encoder(tokens.read_definition(PATH))
ODD = [
    "", None, " \n\t ", "don't I'LL (x) a.b,c 's't'", "J̌.á b≠ a̸.", "Σας ΟΔΟΣ",
    "x\x1cy\x00z\x85w", "日本語 テスト １２", "'''s'", "İstanbul", "a <|endoftext|> b",
    "word" * 3000, "A" * 500 + "." * 500, "7 77 777 a7b'7",
]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library_on_odd_texts():
    got = [x.tolist() for x, _ in ENCODER.texts(pa.array(ODD))]
    assert got == [ids(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aAbZ'.,!-0 9\né́ßΣ  中\U0001f600<|>")), max_size=30), max_size=5))
def test_encoder_equals_library(texts):
    got = [x.tolist() for x, _ in ENCODER.texts(pa.array(texts, pa.string()))]
    assert got == [ids(t) for t in texts]


def test_encoder_forgets_without_changing_ids(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_CHUNKS", 3)
    enc = tokens.Encoder(tokens.read_definition(PATH))
    for _ in range(3):
        assert [x.tolist() for x, _ in enc.texts(pa.array(ODD))] == [ids(t) for t in ODD]


def first_fit_by_hand(lengths, context):
    bins, out = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, used in enumerate(bins) if used + lengths[i] <= context), None)
        if b is None:
            bins.append(0)
            b = len(bins) - 1
        out[i] = (b, bins[b])
        bins[b] += lengths[i]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_tournament_tree_is_first_fit_decreasing(lengths):
    assert list(zip(*packing.first_fit_decreasing(lengths, 20))) == first_fit_by_hand(lengths, 20)


DOCS = "doc_id long, text string, start int, salt string, grp int, ids string, n_tokens string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", "z") for i, t in rows], DOCS)


CASES = [(5, None), (1, ""), (2, "a b c"), (2, "a b c"), (None, "null id"), (9, "long word " * 3000), (7, "日本")]


def check_packing(rows, pieces, context, end):
    by_sequence = collections.defaultdict(list)
    by_doc = collections.defaultdict(list)
    for r in pieces:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and 0 < length
            at += length
        assert at <= context
    for doc, text in dict(rows).items():
        want = ids(text) + [end]
        copies = sum(1 for d, _ in rows if d == doc)
        spans = collections.Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc[doc])
        assert set(spans.values()) == {copies}
        at = 0
        for start, length, crc, total in sorted(spans):
            part = np.array(want[start : start + length], "<u4")
            assert (start, total, crc) == (at, len(want), zlib.crc32(part.tobytes()))
            at += length
        assert at == len(want)


@pytest.mark.parametrize("context,group", [(2048, 8192), (64, 5)])
def test_packing_covers_every_id_once(spark, context, group):
    out = packing.pack_documents(frame(spark, CASES), PATH, 1, context, group).collect()
    check_packing(CASES, out, context, 1)


def test_packing_keeps_ids(spark):
    out = packing.pack_documents(frame(spark, CASES), PATH, 1, keep_ids=True).collect()
    for r in out:
        assert tokens.crc(np.array(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == r["length"]


@pytest.mark.parametrize("context,group", [(2048, 8192), (64, 5)])
def test_sequences_are_put_together_and_padded(spark, context, group):
    rows = CASES + [(20 + i, "word " * (7 * i)) for i in range(40)]
    sequences = packing.pack_sequences(frame(spark, rows), PATH, 1, context, group, pad_id=9).collect()
    dtype = packing.id_type(tokens.read_definition(PATH), 1, 9)
    assert dtype == "<u2" and packing.id_type(tokens.read_definition(PATH), 1 << 16) == "<u4"
    found = []
    for r in sequences:
        r = {**r.asDict(), "ids": np.frombuffer(r["ids"], dtype).tolist()}
        assert len(r["ids"]) == (r["used"] if bin(r["used"]).count("1") == 1 else context)
        assert sum(r["lengths"]) == r["used"] <= context and set(r["ids"][r["used"] :]) <= {9}
        at = 0
        for doc, start, n, total in zip(r["doc_ids"], r["starts"], r["lengths"], r["doc_tokens"]):
            found.append((doc, start, tuple(r["ids"][at : at + n]), total))
            at += n
    want = []
    for doc, text in rows:
        whole = ids(text) + [1]
        want += [(doc, i, tuple(whole[i : i + context]), len(whole)) for i in range(0, len(whole), context)]
    assert collections.Counter(found) == collections.Counter(want)
    assert len({r["sequence_id"] for r in sequences}) == len(sequences)


def test_packing_of_the_table_wastes_little(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = packing.pack_documents(docs, PATH, 1).collect()
    check_packing([(r["doc_id"], r["text"]) for r in docs.collect()], out, 2048, 1)
    used = sum(r["length"] for r in out)
    assert used / (2048 * len({r["sequence_id"] for r in out})) > 0.97


def digest_by_hand(rows, end):
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        x = np.array(ids(text) + [end], "<u4")
        out.append((doc, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    return out


def test_token_files_round_trip(spark, sf_small):
    got = token_files.token_round_trip(frame(spark, CASES), PATH).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == digest_by_hand(CASES, 2)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = token_files.token_round_trip(docs, PATH).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == digest_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()], 2)


def test_token_files_are_ordered_and_indexed(spark, tmp_path):
    import pyarrow.orc as orc

    path = str(tmp_path / "ids")
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('word ', id) as text")
    token_files.write_token_files(docs.repartition(7), path, PATH)
    files = sorted((tmp_path / "ids").glob("part-*.orc"))
    spans = []
    for f in files:
        col = orc.ORCFile(f).read(columns=["doc_id"])["doc_id"].to_pylist()
        if col:
            assert col == sorted(col)
            spans.append((col[0], col[-1]))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    plan = token_files.read_token_files(spark, path).where("doc_id = 77")
    assert plan.count() == 1
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,77)]" in plan._jdf.queryExecution().toString()


def test_histogram_against_brute_force(spark):
    hist = token_counts.length_histogram(frame(spark, CASES), PATH)
    rows = {r["n_tokens"]: r for r in hist.collect()}
    lengths = [len(ids(t)) for _, t in CASES]
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r["docs"] == lengths.count(n) and r["tokens"] == n * r["docs"]
        assert r["docs_at_least"] == sum(x >= n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert (r["total_docs"], r["total_tokens"]) == (len(lengths), sum(lengths))
        assert r["kept_tokens"] == sum(min(x, n) for x in lengths) == sum(lengths) - r["cut_tokens"]
        assert r["share_at_most"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    for limit in (0, 1, 2, 3, 100, 10**6):
        got = token_counts.truncated_total(hist, limit).first()
        assert got["kept_tokens"] == sum(min(x, limit) for x in lengths)
    for q in (0.0, 0.3, 0.5, 0.9, 1.0):
        want = min(x for x in lengths if sum(y <= x for y in lengths) / len(lengths) >= q)
        assert token_counts.length_quantile(hist, q).first()[0] == want


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert packing.pack_documents(empty, PATH).collect() == []
    assert token_files.token_round_trip(empty, PATH).collect() == []
    hist = token_counts.length_histogram(empty, PATH)
    assert hist.collect() == []
    assert token_counts.truncated_total(hist, 8).first()["kept_tokens"] == 0
