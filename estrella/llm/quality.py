"""Quality classifier: supervised subword embeddings.

Words and character n-grams are hashed to buckets, each with a learned vector; a text is
the mean of its vectors, and a softmax layer gives the classes. Vectors and layer are
trained together by stochastic gradient descent in numpy, on a bounded sample of labelled
documents. With two classes the trained score of a text is a sigmoid of the mean of one
number per bucket, so scoring whole texts is a table lookup per feature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrella.llm import textbytes as tb
from estrella.llm.common import map_batches, materialize

BUCKET_BITS = 17
NGRAMS = (2, 4)
DIM = 8
EPOCHS = 12
RATE = 0.5
SAMPLE_DOCS = 6000  # labelled documents learned from, at most about so many
SAMPLE_BYTES = 64 << 20  # and bytes of their texts
THRESHOLD = 0.7

_SPACE = np.ones(256, np.uint8)
_SPACE[[9, 10, 11, 12, 13, 32]] = 0
_EDGE = np.array([[False, True], [True, False]])


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word and character n-gram of the texts, unordered.

    Words are runs without white space; n-grams are of NGRAMS consecutive characters,
    white space included, inside one text. A-Z counts as a-z. Besides, every word gives
    bucket 0 where the text has it for the first time and bucket 1 where it comes again,
    or the mean could not tell a text that repeats itself.
    """
    low = tb.lowered(buf)
    shift = np.uint64(64 - BUCKET_BITS)
    starts, ends = tb.runs(low, offsets, _SPACE, _EDGE)
    words = tb.run_hashes(low, starts, ends)
    word_row = np.searchsorted(offsets, starts, "right") - 1
    again = np.ones(len(words), np.int32)
    again[np.unique(tb.mix(words + word_row.astype(np.uint64)), return_index=True)[1]] = 0
    bucket = [(words >> shift).astype(np.int32), again]
    row = [word_row, word_row]
    char = np.flatnonzero((low & 0xC0) != 0x80)
    char_row = np.searchsorted(offsets, char, "right") - 1
    ends_of = np.append(char, len(low))
    for k in NGRAMS:
        if len(char) < k:
            continue
        inside = char_row[: len(char) - k + 1] == char_row[k - 1 :]
        at = np.flatnonzero(inside)
        h = tb.run_hashes(low, char[at], ends_of[at + k])
        bucket.append(((h * np.uint64(2 * k + 1)) >> shift).astype(np.int32))
        row.append(char_row[at])
    return np.concatenate(bucket), np.concatenate(row)


@dataclass
class Model:
    weight: np.ndarray  # one number per bucket: the projection of its vector on the layer
    bias: float

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        bucket, row = features(buf, offsets)
        n = np.bincount(row, minlength=rows)
        total = np.bincount(row, weights=self.weight[bucket], minlength=rows)
        return 1.0 / (1.0 + np.exp(-(total / np.maximum(n, 1) + self.bias)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 3) -> Model:
    """Gradient descent over documents given as (distinct buckets, counts).

    The step falls linearly to zero. A bucket's step is scaled by the root of a text's
    features instead of their number, or the vectors of long texts would hardly move.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    vectors = rng.uniform(-1.0 / DIM, 1.0 / DIM, (1 << BUCKET_BITS, DIM))
    layer, bias = np.zeros((DIM, 2)), np.zeros(2)
    steps, done = max(1, EPOCHS * len(bags)), 0
    onehot = np.eye(2)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            rate = RATE * (1 - done / steps)
            done += 1
            at, count = bags[i]
            if not len(at):
                continue
            share = count / count.sum()
            mean = share @ vectors[at]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            off = p - onehot[labels[i]]
            back = layer @ off
            layer -= rate * np.outer(mean, off)
            bias -= rate * 0.1 * off
            vectors[at] -= (rate * np.sqrt(count.sum())) * share[:, None] * back
    gap = layer[:, 1] - layer[:, 0]
    return Model((vectors @ gap).astype(np.float32), float(bias[1] - bias[0]))


def sample_rows(
    docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES, seed: int = 9
) -> DataFrame:
    """text and _label of the rows learned from: about ``sample_docs`` and ``sample_bytes`` at most.

    First labelled ids are drawn, each once for each of its labels; then, if these have more
    rows than that (repeated ids), the rows themselves, with their number in the draw.
    """
    known = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .select("doc_id", F.col("quality").cast("int").alias("_label"))
        .distinct()
    )
    known = materialize(known, "labels")
    share = sample_docs / max(1, known.count())
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) / 1e6
    chosen = F.broadcast(known.where(draw < share))  # about sample_docs rows of two numbers
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    n, held = rows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    share = min(sample_docs / max(1, n), sample_bytes / max(1, held))
    if share < 1:
        again = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id(), F.lit(seed + 1)), F.lit(1_000_000))
        rows = rows.withColumn("draw", again / 1e6).where(F.col("draw") < share)
    return rows.select("text", "_label")


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 9) -> Model:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, quality)`` (0 or 1; other and
    null labels teach nothing; a document with two labels counts with each).

    The sample (``sample_rows``) is of whole texts; their bags of buckets meet in one task,
    and the driver gets the trained table.
    """
    rows = sample_rows(docs, labels, sample_docs, seed=seed)

    def bags(batches):
        for batch in batches:
            buf, offsets = tb.text_buffer(batch.column(0))
            out = []
            for lo, hi in tb.row_blocks(offsets):
                at = offsets[lo : hi + 1] - offsets[lo]
                bucket, row = features(buf[offsets[lo] : offsets[hi]], at)
                key, count = np.unique(bucket.astype(np.int64) | (row << 32), return_counts=True)
                cut = np.searchsorted(key >> 32, np.arange(hi - lo + 1))
                for a, b in zip(cut, cut[1:]):
                    out.append(((key[a:b] & 0xFFFFFFFF).astype("<i4").tobytes(), count[a:b].astype("<i4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).cast(pa.int32()),
                    pa.array([x for x, _ in out], pa.binary()),
                    pa.array([x for _, x in out], pa.binary()),
                ],
                ["label", "buckets", "counts"],
            )

    def learn(batches):
        held, labels_ = [], []
        for batch in batches:
            labels_ += batch.column(0).to_pylist()
            held += [
                (np.frombuffer(a, "<i4"), np.frombuffer(b, "<i4").astype(np.float64))
                for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
        # the order of rows must not matter: sort by what they are
        order = sorted(range(len(held)), key=lambda i: (labels_[i], held[i][0].tobytes(), held[i][1].tobytes()))
        model = train([held[i] for i in order], np.array([labels_[i] for i in order], np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weight.tobytes()], pa.binary()), pa.array([model.bias])], ["weight", "bias"]
        )

    bagged = materialize(
        rows.transform(map_batches, bags, "label int, buckets binary, counts binary"), "bags"
    )
    made = bagged.repartition(1).transform(map_batches, learn, "weight binary, bias double").collect()
    if not made:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0)
    return Model(np.frombuffer(made[0]["weight"], np.float32), made[0]["bias"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and predicted in place of their text (input columns of those names go).

    score is the probability of label 1 from the text alone; a null or empty text has the
    score of the bias. Repeated rows are scored alike; no rows give no rows.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("text", "score", "predicted")]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m: Model = shared.value
        for batch in batches:
            buf, offsets = tb.text_buffer(batch.column(0))
            score = [
                m.score(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                for lo, hi in tb.row_blocks(offsets)
            ]
            score = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    schema = T.StructType(
        [*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    return docs.select("text", *[F.col(f"`{c}`") for c in names]).transform(map_batches, run, schema)


def held_out():
    """Whether crc32 of the doc_id as text leaves 2 by 4: nothing is learned from such rows."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4, F.lit(2)) == 2


def quality_scores(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, by a model learned from the
    labelled documents that are not held out. A null doc_id counts as held out."""
    rows = docs.select("doc_id", "text")
    model = fit(rows.where(~held_out()), labels.where(~held_out()), sample_docs)
    return predict(rows.select("doc_id", held_out().alias("held_out"), "text"), model)
