"""Language ID by prediction by partial matching over bytes.

For every language the counts of bytes after contexts of 0 to 3 bytes form a context
tree. A byte's code length is read at the longest context the tree holds: if the byte
was seen there it costs -log2(n / (N + D)), else the escape -log2(D / (N + D)) plus its
cost one context shorter (N bytes seen, D distinct ones; method C); below the empty
context every byte costs 8 bits. The statistics stay frozen while a text is scored, so
its code length is a sum over its bytes and all languages are scored at once from tables.
The shortest code wins.

The trees are learned from a bounded sample: about ``docs_per_language`` whole documents and
at most about ``bytes_per_language`` of each language, chosen row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrella.llm import textbytes as tb
from estrella.llm.common import map_batches

ORDER = 3
DOCS_PER_LANGUAGE = 3000
BYTES_PER_LANGUAGE = 64 << 20
UNDETERMINED = "und"
SLICE = 1 << 18  # bytes scored at a time
SLACK_BITS = 64.0


class Grams:
    """Open-addressed table from 32-bit grams to their row, looked up in bulk."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.keys = np.zeros(1 << self.bits, np.uint32)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        while left.size:
            free = left[self.rows[at[left]] < 0]
            spot, one = np.unique(at[free], return_index=True)
            self.keys[spot], self.rows[spot] = keys[free[one]], free[one]
            left = left[self.keys[at[left]] != keys[left]] if not free.size else np.setdiff1d(left, free[one])
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        at = self._place(keys)
        out = self.rows[at]
        left = np.flatnonzero((self.keys[at] != keys) & (out >= 0))
        out[left] = -1
        while left.size:
            at_ = (at[left] + 1) & ((1 << self.bits) - 1)
            at[left] = at_
            rows = self.rows[at_]
            same = (self.keys[at_] == keys[left]) & (rows >= 0)
            out[left[same]] = rows[same]
            left = left[~same & (rows >= 0)]
        return out


@dataclass
class Model:
    """Frozen tables: code length in bits by gram and language, and escapes by context."""

    languages: list[str]
    order1: np.ndarray  # (65536, languages): cost of a byte after one byte
    grams3: Grams
    cost3: np.ndarray
    escape2: np.ndarray  # (65536, languages): escape cost where the 2-byte context is held
    grams4: Grams
    cost4: np.ndarray
    contexts3: Grams
    escape3: np.ndarray

    def score(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each position's byte (positions x languages) from its 4-byte gram."""
        row = self.grams4.find(grams)
        out = self.cost4[np.maximum(row, 0)]
        miss = np.flatnonzero(row < 0)
        if miss.size:
            out[miss] = self._shorter(grams[miss])
        return out

    def _shorter(self, grams: np.ndarray) -> np.ndarray:
        context = self.contexts3.find(grams >> np.uint32(8))
        out = np.where((context >= 0)[:, None], self.escape3[np.maximum(context, 0)], np.float32(0))
        g3 = grams & np.uint32(0xFFFFFF)
        row = self.grams3.find(g3)
        at2 = self.escape2[g3 >> np.uint32(8)] + self.order1[g3 & np.uint32(0xFFFF)]
        return out + np.where((row >= 0)[:, None], self.cost3[np.maximum(row, 0)], at2)


def build(languages: list[str], which: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> Model:
    """Model from (language number, 4-byte gram, count) rows."""
    n = max(1, len(languages))

    def tally(keys: np.ndarray, size: int | None = None):
        """Distinct keys and their counts by language."""
        seen, at = np.unique(keys, return_inverse=True)
        table = np.zeros((len(seen), n))
        np.add.at(table, (at, which), counts)
        return seen, table

    def of_context(keys: np.ndarray, table: np.ndarray):
        """Distinct contexts of grams with the bytes and the distinct bytes seen after each."""
        seen, at = np.unique(keys >> 8, return_inverse=True)
        total, kinds = np.zeros((len(seen), n)), np.zeros((len(seen), n))
        np.add.at(total, at, table)
        np.add.at(kinds, at, table > 0)
        return seen, at, total, kinds

    def bits(part, whole):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(part > 0, -np.log2(part / whole), 0.0)

    grams = grams.astype(np.int64)
    zero, t0 = tally(grams & 0xFF)
    total, kinds = t0.sum(0), (t0 > 0).sum(0)
    cost = np.tile(bits(kinds, total + kinds) + 8.0, (256, 1))
    cost[zero] = np.where(t0 > 0, bits(t0, total + kinds), cost[zero])

    one, t1 = tally(grams & 0xFFFF)
    seen, at, total, kinds = of_context(one, t1)
    escape = np.zeros((256, n))
    escape[seen] = bits(kinds, total + kinds)
    order1 = (escape[:, None, :] + cost[None, :, :]).reshape(65536, n)
    order1[one] = np.where(t1 > 0, bits(t1, (total + kinds)[at]), order1[one])

    two, t2 = tally(grams & 0xFFFFFF)
    seen, at, total, kinds = of_context(two, t2)
    escape2 = np.zeros((65536, n))
    escape2[seen] = bits(kinds, total + kinds)
    cost3 = np.where(t2 > 0, bits(t2, (total + kinds)[at]), escape2[two >> 8] + order1[two & 0xFFFF])

    three, t3 = tally(grams)
    seen3, at, total, kinds = of_context(three, t3)
    escape3 = bits(kinds, total + kinds)
    lower = cost3[np.searchsorted(two, three & 0xFFFFFF)]
    cost4 = np.where(t3 > 0, bits(t3, (total + kinds)[at]), escape3[at] + lower)

    def f4(table: np.ndarray) -> np.ndarray:
        """As floats, with one row at least, so that a lookup that finds nothing has a row to read."""
        return (table if len(table) else np.zeros((1, n))).astype(np.float32)

    return Model(
        languages,
        f4(order1),
        Grams(two.astype(np.uint32)),
        f4(cost3),
        f4(escape2),
        Grams(three.astype(np.uint32)),
        f4(cost4),
        Grams(seen3.astype(np.uint32)),
        f4(escape3),
    )


def padded(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ORDER zero bytes before each, and their new row offsets."""
    rows = len(offsets) - 1
    at = offsets + ORDER * np.arange(rows + 1)
    out = np.zeros(int(at[-1]), np.uint8)
    mark = np.ones(len(out), bool)
    mark[(at[:-1, None] + np.arange(ORDER)).ravel()] = False
    out[mark] = buf
    return out, at


def grams_of(pad: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """4-byte grams that end at positions lo..hi-1 (lo >= ORDER)."""
    g = np.zeros(hi - lo, np.uint32)
    for k in range(ORDER + 1):
        g |= pad[lo - k : hi - k].astype(np.uint32) << np.uint32(8 * k)
    return g


def code_lengths(model: Model, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text under each language (rows x languages)."""
    pad, at = padded(buf, offsets)
    rows = len(at) - 1
    out = np.zeros((rows, max(1, len(model.languages))))
    for lo in range(ORDER, len(pad), SLICE):
        hi = min(lo + SLICE, len(pad))
        bits = model.score(grams_of(pad, lo, hi))
        first = int(np.searchsorted(at, lo, "right")) - 1
        last = int(np.searchsorted(at, hi, "left"))
        edges = np.clip(np.stack([at[first:last] + ORDER, at[first + 1 : last + 1]]), lo, hi) - lo
        held = edges[1] > edges[0]
        if held.any():
            # sums between a row's first and last position; the padding between rows is left out
            cut = edges[:, held].T.ravel()
            tail = np.vstack([bits, np.zeros((1, bits.shape[1]), np.float32)])
            sums = np.add.reduceat(tail, cut, axis=0, dtype=np.float64)[::2]
            out[first:last][held] += sums
    return out


def has_letter(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any alphabet."""
    ascii_letter = np.concatenate([[0], np.cumsum((tb.lowered(buf) >= 97) & (tb.lowered(buf) <= 122))])
    out = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for i in np.flatnonzero(~out & (offsets[1:] > offsets[:-1])):
        out[i] = any(map(str.isalpha, buf[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")))
    return out


def sample_rows(
    labelled: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    bytes_per_language: int = BYTES_PER_LANGUAGE,
    seed: int = 5,
) -> tuple[list[str], DataFrame]:
    """(languages, text and lang of the rows learned from).

    Every row is drawn by itself: its number goes into the draw with its id and text, so rows
    that repeat an id or a text, or have none, are thinned like all others.
    """
    rows = labelled.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    amount = [F.count("*").alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes")]
    sizes = {r["lang"]: (r["n"], r["bytes"]) for r in rows.groupBy("lang").agg(*amount).collect()}
    languages = sorted(sizes)
    shares = {k: min(docs_per_language / n, bytes_per_language / max(1, size)) for k, (n, size) in sizes.items()}
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, shares[k])]) if languages else None
    numbered = rows.withColumn("nth", F.monotonically_increasing_id())
    draw = F.pmod(F.xxhash64("doc_id", "text", "nth", F.lit(seed)), F.lit(1_000_000)) / 1e6
    chosen = F.lit(False) if share is None else draw < F.element_at(share, F.col("lang"))
    return languages, numbered.where(chosen).select("text", "lang")


def fit(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, seed: int = 5) -> Model:
    """Learn from ``labelled(doc_id, text, lang)``; rows with a null text or lang teach nothing.

    The driver receives the counts of distinct 4-byte grams of the sample, which the
    sample's size in bytes bounds; the sample is of whole texts.
    """
    languages, sample = sample_rows(labelled, docs_per_language, seed=seed)
    if not languages:
        return build([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    number = {k: i for i, k in enumerate(languages)}

    def count(batches):
        for batch in batches:
            buf, offsets = tb.text_buffer(batch.column(0))
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for lo, hi in tb.row_blocks(offsets):
                part = offsets[lo : hi + 1]
                pad, at = padded(buf[part[0] : part[-1]], part - part[0])
                if len(pad) <= ORDER:
                    continue
                row = np.searchsorted(at, np.arange(ORDER, len(pad)), "right") - 1
                inside = np.arange(ORDER, len(pad)) - at[row] >= ORDER
                key = grams_of(pad, ORDER, len(pad)).astype(np.int64) | (lang[lo:hi][row] << 32)
                seen, n = np.unique(key[inside], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n.astype(np.int64))], ["k", "n"])

    table = sample.transform(map_batches, count, "k bigint, n bigint")
    table = table.groupBy("k").agg(F.sum("n").alias("n")).orderBy("k").toArrow()
    k = table["k"].to_numpy()
    return build(languages, k >> 32, k & 0xFFFFFFFF, table["n"].to_numpy().astype(np.float64))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and code_bits added (input columns of those names go).

    lang_pred is the language with the shortest code, the first by name among equals;
    score is its posterior under equal priors. ``und`` with score 0 if the text is null or
    has no letter, or if nothing was learned. Only the text is looked at.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "code_bits")]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m: Model = shared.value
        for batch in batches:
            buf, offsets = tb.text_buffer(batch.column(names.index("text")))
            lang, score, code = [], [], []
            for lo, hi in tb.row_blocks(offsets):
                at = offsets[lo : hi + 1] - offsets[lo]
                part = buf[offsets[lo] : offsets[hi]]
                bits = code_lengths(m, part, at)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(best)), best]
                p = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
                known = has_letter(part, at) & bool(m.languages)
                lang += [m.languages[b] if ok else UNDETERMINED for b, ok in zip(best, known)]
                score.append(np.where(known, p, 0.0))
                code.append(least)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(lang, pa.string()),
                    pa.array(np.concatenate(score) if score else np.zeros(0)),
                    pa.array(np.concatenate(code) if code else np.zeros(0)),
                ],
                [*names, "lang_pred", "score", "code_bits"],
            )

    schema = T.StructType(
        [
            *kept,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("code_bits", T.DoubleType()),
        ]
    )
    return docs.select(*[F.col(f"`{c}`") for c in names]).transform(map_batches, run, schema)


def keep_languages(docs: DataFrame, model: Model) -> DataFrame:
    """The rows and columns of ``docs`` whose text is in a learned language.

    Rejected are undetermined texts, and texts that the best language codes in more bits
    than their plain bytes take (8 a byte and ``SLACK_BITS``): no learned language fits.
    """
    inner = {c: "text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    found = predict(docs.select(*[F.col(f"`{c}`").alias(k) for c, k in inner.items()]), model)
    fits = F.col("code_bits") <= 8 * F.octet_length("text") + SLACK_BITS
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & fits)
    return kept.select(*[F.col(k).alias(c) for c, k in inner.items()])


def held_out(doc_id: str = "doc_id", parts: int = 5, part: int = 0):
    """Whether crc32 of the id as text falls in the part that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(part)) == part


def identify(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, code_bits of every document, by a model learned
    from the documents that are not held out. A null doc_id counts as held out; repeated
    rows are scored alike; no rows give no rows."""
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(~held_out()), docs_per_language)
    return predict(rows.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
