"""The pipeline's stages one by one, against brute force on what each was given."""

import public_tokenizers

import corpus_pipeline as cp
from tests.llm.test_duplicates import brute
from tests.llm.test_texts import contaminated, lines_by_hand
from tests.llm.test_tokens import check_packing


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()))


def test_stages_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = [(10_001, None, "en", "src0", None), (10_002, "", "en", None, 0), (10_003, "123 !", None, "src1", 5)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    given, kept = {}, {}
    for name, stage in cp.STAGES:
        given[name] = docs
        docs = cp.materialize(stage(spark, docs, sf_small), name)
        if name != "packing":
            assert docs.columns == given[name].columns
        kept[name] = docs
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    assert ids(given["language"]) - ids(kept["language"]) == {10_001, 10_002, 10_003}

    want = lines_by_hand([(r["doc_id"], r["text"], r["source"]) for r in given["lines"].collect()], 0.05, 5)
    assert rows(kept["lines"]) == sorted((d, t) for d, t, *_ in want)
    assert all(r["n_chars"] == len(r["text"]) for r in kept["lines"].collect())

    want = {d for (d, _, _, keep) in brute(rows(given["near_duplicates"]), 5, 80) if keep}
    assert ids(kept["near_duplicates"]) == want and len(want) < given["near_duplicates"].count()

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated(rows(given["decontamination"]), items) if r[-1]}
    assert ids(kept["decontamination"]) == ids(given["decontamination"]) - bad and bad

    check_packing(rows(given["packing"]), kept["packing"].collect(), 2048, 1)
    assert public_tokenizers.path("word_bpe_49k.json") == cp.tokenizer_path()


def test_run_and_empty_documents(spark, sf_small, tmp_path):
    out = cp.run(spark, sf_small)
    assert out.count() > 100 and "sequence_id" in out.columns
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_small}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_copies_do_not_make_their_own_lines_boilerplate(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    copied = "\n".join(f"part {i} of the text that a third of the rows hold" for i in range(6))
    texts = [copied + "\nmenu" if i % 3 == 0 else f"menu\npage {i} has words of its own {i * i}" for i in range(60)]
    for host in ("s", None):
        docs = spark.createDataFrame([(i, t, "en", host, len(t)) for i, t in enumerate(texts)], schema)
        cleaned = cp.materialize(cp.lines(spark, docs, ""), "lines")
        got = dict(rows(cleaned))
        assert len(got) == 60 and all(got[i] == t.replace("\nmenu", "").replace("menu\n", "") for i, t in enumerate(texts))
        kept = dict(rows(cp.near_duplicates(spark, cleaned, "")))
        assert [i for i, t in kept.items() if t == copied] == [0] and len(kept) == 41


def test_rows_without_an_id_or_with_one_id_are_judged_by_their_text(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = lambda tag, n=40: " ".join(f"{tag}{i}" for i in range(n))
    exam = words("exam", 20)
    spark.createDataFrame([(1, exam)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    hot, pair, own = words("hot"), words("pair"), words("own")
    # near copies and exact ones without an id; one id with two texts; a repeated row; no words
    given = [(None, hot)] * 20 + [(None, hot + " end"), (None, pair), (4, pair), (7, pair), (7, own), (8, own + " x")]
    given += [(9, words("twice"))] * 3 + [(10, " "), (11, " "), (None, None)]
    frame = lambda pairs: spark.createDataFrame(
        [(d, t, "en", f"s{i % 3}", 1) for i, (d, t) in enumerate(pairs)], schema
    )
    got = cp.near_duplicates(spark, frame(given), "").collect()
    kept = [(r["doc_id"], r["text"]) for r in got]
    of_hot = [p for p in kept if p[1] in (hot, hot + " end")]
    assert len(of_hot) == 1 and of_hot[0][0] is None
    rest = [p for p in kept if p not in of_hot]
    want = [(None, None), (4, pair), (7, own), (9, words("twice")), (10, " "), (11, " ")]
    assert sorted(rest, key=str) == sorted(want, key=str)

    given = [(None, exam), (None, exam), (None, own), (5, exam + " z"), (5, own), (6, pair), (6, pair), (None, None)]
    got = cp.decontamination(spark, frame(given), str(tmp_path))
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    want = [(None, own), (5, own), (6, pair), (6, pair), (None, None)]
    assert sorted(kept, key=str) == sorted(want, key=str)
