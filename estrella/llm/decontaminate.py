"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is ``window`` consecutive words of a benchmark item (all of a shorter item). A
document contains a window only if it contains every shingle of it, so it is enough to
join one: the shingles of each window are ordered by how rare they are in the documents
and the rarest is the window's prefix. A match of the prefix fixes where the window would
lie; the bounds of position and length drop what cannot fit, and the words there are then
compared with the window's.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrella.llm.common import fits_broadcast, join_keys, materialize, packed, small

SHINGLE = 3


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, then runs of digits, letters a-z and non-ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    parts = F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def _token(array: str, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[F.get(F.col(array), at + i) for i in range(width)])


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """wid, win (its words), len, items (ids of the items that have it): one row per distinct window."""
    split = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return (
        split.select("item_id", "w", F.explode(starts).alias("s"))
        .select("item_id", F.slice("w", F.col("s"), F.lit(window)).alias("win"))
        .groupBy("win")
        .agg(F.collect_set("item_id").alias("items"))
        .select(F.monotonically_increasing_id().alias("wid"), "win", F.size("win").alias("len"), "items")
    )


def _document_tokens(docs: DataFrame, widths: list[int]) -> DataFrame:
    """doc_id, txt, n_words, w, pos, tok: a row for each word position (and shingle width);
    a document without words has one row with a null pos."""
    split = docs.select("doc_id", F.xxhash64("text").alias("txt"), words(F.col("text")).alias("w"))
    at = split.select("doc_id", "txt", F.size("w").alias("n_words"), "w", F.posexplode_outer("w").alias("pos", "_"))
    toks = [_token("w", F.col("pos"), k) for k in widths]
    tok = toks[0] if len(toks) == 1 else F.explode(F.array(*toks))
    return at.select("doc_id", "txt", "n_words", "w", "pos", tok.alias("tok"))


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, txt, n_words, start, len, wid: every verified occurrence of a window in a
    document, and at least one row (with a null wid) per document."""
    width = F.least(F.col("len"), F.lit(SHINGLE))
    spots = windows.select("wid", "win", width.alias("k"), F.explode(F.sequence(F.lit(0), F.col("len") - width)).alias("off"))
    widths = sorted(r["k"] for r in spots.select("k").distinct().collect()) or [SHINGLE]  # at most SHINGLE values
    tok = F.lit(None).cast("bigint")
    for k in widths:
        tok = F.when(F.col("k") == k, _token("win", F.col("off"), k)).otherwise(tok)
    spots = materialize(spots.select("wid", "off", tok.alias("tok")), "shingles")
    vocabulary = small(materialize(spots.select("tok").distinct(), "vocabulary"))
    seen = _document_tokens(docs, widths).join(vocabulary, "tok").groupBy("tok").agg(F.count("*").alias("n"))
    rarest = (
        spots.join(seen, "tok")  # a shingle that no document holds rules its window out
        .groupBy("wid")
        .agg(F.min(F.struct("n", "off", "tok")).alias("m"), F.count("*").alias("found"))
        .join(spots.groupBy("wid").agg(F.count("*").alias("all")), "wid")
        .where(F.col("found") == F.col("all"))
    )
    prefixes = materialize(
        rarest.select("wid", "m.off", F.col("m.tok").alias("tok")).join(windows.select("wid", "win", "len"), "wid"),
        "prefixes",
    )
    if not fits_broadcast(prefixes):
        return _far_occurrences(docs, _document_tokens(docs, widths), prefixes)
    start = F.col("pos") - F.col("off")
    fits = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    same = F.when(fits, F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("len")) == F.col("win")).otherwise(False)
    hit = F.coalesce(same, F.lit(False))
    return (
        _document_tokens(docs, widths)
        .join(F.broadcast(prefixes), "tok", "left")
        .withColumn("hit", hit)
        .where(F.col("hit") | F.col("pos").isNull() | (F.col("pos") == 0))
        .select(
            "doc_id",
            "txt",
            "n_words",
            F.when(F.col("hit"), start).alias("start"),
            F.when(F.col("hit"), F.col("len")).alias("len"),
            F.when(F.col("hit"), F.col("wid")).alias("wid"),
        )
    )


def _far_occurrences(docs: DataFrame, tokens: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``occurrences`` where the prefixes are too many to broadcast.

    Only positions and tokens meet the prefixes; what fits is gathered for each document,
    goes to its words once, and is compared there. Matches of a prefix that is the rarest
    shingle of its window are few, so a document's list is short beside its words.
    """
    start = F.col("pos") - F.col("off")
    met = (
        tokens.where("pos is not null")
        .select("doc_id", "txt", "n_words", "pos", "tok")
        .join(prefixes, "tok")
        .where((start >= 0) & (start + F.col("len") <= F.col("n_words")))
        .groupBy("doc_id", "txt")
        .agg(F.collect_set(F.struct(start.alias("start"), "len", "wid", "win")).alias("met"))
        .select(F.col("doc_id").alias("d"), F.col("txt").alias("t"), "met")
    )
    texts = docs.select("doc_id", F.xxhash64("text").alias("txt"), words(F.col("text")).alias("w"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("txt").eqNullSafe(F.col("t"))
    true = F.filter("met", lambda m: F.slice(F.col("w"), m["start"] + 1, m["len"]) == m["win"])
    none = F.array(F.lit(None).cast("struct<start:int,len:int,wid:bigint>"))
    spans = F.transform(true, lambda m: F.struct(m["start"].alias("start"), m["len"].alias("len"), m["wid"].alias("wid")))
    return (
        texts.join(met, same, "left")
        .select("doc_id", "txt", F.size("w").alias("n_words"), F.explode(F.concat(none, F.coalesce(spans, none))).alias("m"))
        .select("doc_id", "txt", "n_words", "m.start", "m.len", "m.wid")
    )


def _covered(spans: Column) -> Column:
    """Number of positions that sorted (start, len) spans cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, span: Column) -> Column:
        end = F.greatest(acc["end"], span["start"] + span["len"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], F.least(span["start"], end))).alias("n"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["n"])


def _judged(docs: DataFrame, items: DataFrame, window: int, share: int) -> DataFrame:
    """The columns of ``contamination`` and txt, the text's hash: one row per doc_id and text."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    windows = materialize(item_windows(items.select("item_id", "text"), window), "windows")
    found = materialize(occurrences(docs, windows), "occurrences")
    spans = F.collect_set(F.when(F.col("wid").isNotNull(), F.struct("start", "len")))
    key = ["doc_id", "txt"]
    base = found.groupBy(*key).agg(F.max("n_words").cast("bigint").alias("n_words"), spans.alias("spans"))
    by_item = (
        found.where("wid is not null")
        .select(*key, "wid")
        .distinct()
        .join(small(windows).select("wid", "items"), "wid")
        .select(*key, F.explode("items").alias("item"))
        .distinct()
        .groupBy(*key)
        .agg(F.collect_list(F.col("item").cast("string")).alias("ids"))
    )
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = _covered(F.col("spans")).cast("bigint")
    other = by_item.select(F.col("doc_id").alias("d"), F.col("txt").alias("t"), "ids")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("txt").eqNullSafe(F.col("t"))
    return base.join(other, same, "left").select(
        "doc_id",
        "txt",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(ids)), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of ``docs(doc_id, text)``
    against ``items(item_id, text)``.

    n_hit counts words inside any occurrence of a window, n_items the items that have
    one; contaminated if n_hit > 0 and ``share`` * n_hit >= n_words. A null or empty text
    has no words. Every row of ``docs`` gives one row: rows that repeat doc_id and text give
    equal ones, and the texts of one doc_id are judged one by one. An item with a null id hits but is not counted. Without
    items nothing is hit; without documents there are no rows; other columns are ignored.
    """
    key = [F.col("doc_id").cast("bigint").alias("d"), F.xxhash64("text").alias("t")]
    repeated = materialize(docs.select(*key).groupBy("d", "t").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("txt").eqNullSafe(F.col("t"))
    times = F.sequence(F.lit(1), F.coalesce("n", F.lit(1)).cast("int"))
    judged = _judged(docs, items, window, share)
    return judged.join(small(repeated), same, "left").withColumn("d", F.explode(times)).drop("txt", "d", "t", "n")


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """``docs(doc_id, text, …)`` without the contaminated rows.

    Decided by doc_id and text: texts that share an id, or have none, are judged one by one.
    """
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    found = _judged(docs, items, window, share).where("contaminated").select("doc_id", "txt")
    found = materialize(found, "contaminated")
    keyed = packed(docs, F.col("doc_id"), F.xxhash64("text").alias("txt"))
    return join_keys(keyed, found, ["doc_id", "txt"], "left_anti").select("row.*")


# The same rule in DuckDB SQL: all windows of documents against all windows of items.
SQL = """
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') w from documents),
i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') w from benchmark),
iw as (
  select distinct item_id, array_to_string(w[s:s + 12], ' ') win, least(len(w), 13) l
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) s from i where len(w) > 0)),
dw as (
  select doc_id, s, l, array_to_string(w[s:s + l - 1], ' ') win
  from (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) s
        from d, (select distinct l from iw) where len(w) >= l)),
m as (select distinct doc_id, item_id, s, dw.l from dw join iw using (win, l)),
hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + l)) p from m) group by 1),
its as (
  select doc_id, count(*) n_items, string_agg(item, ',' order by item) ids
  from (select distinct doc_id, item_id::varchar item from m) group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join hit using (doc_id) left join its using (doc_id)
"""
