"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts are lower-cased, runs of blanks become one, and the n-grams of four lengths are hashed to buckets.  It learns from
a bounded sample of the labelled rows, ``SAMPLE`` of either class at most, those whose ids hash lowest.  For each bucket
the toxic and the clean documents that hold it are counted.  The log of the ratio of the two smoothed shares is the
bucket's scale; the buckets whose ratios tell most are the features.  A logistic regression on the presence of
features, each times its scale, is then fitted; classes weigh as they come among all labelled rows.

The sample is drawn from the labels, which are small; its ids then pick their texts, so texts are never joined whole.

Scoring needs one table of weights by bucket (4 MB) and no shuffle.  A feature counts once a document, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import written
from .batches import batch, pieces
from .shipping import ship

ORDERS = (4, 5, 6, 7)
BUCKETS = 1 << 20
#: Features kept, and labelled documents of either class in the sample: together they bound the fit.
FEATURES = 1 << 14
SAMPLE = 8192
#: Tasks that the sample is dealt over.
TASKS = 8
THRESHOLD = 0.3
#: Smoothing of the counts, weight of the penalty, steps of the fit.
SMOOTH, PENALTY, STEPS = 1.0, 1e-3, 300
#: Characters hashed at a time.
SLICE = 1 << 20


@dataclass
class Model:
    #: Weight by bucket, scale included; 0 where a bucket is no feature.
    weights: np.ndarray
    bias: float


def hashed(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, repeats included, in slices."""
    text = " " + " ".join(text.lower().split()) + " "
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    widest = max(ORDERS)
    for at in range(0, max(len(codes) - min(ORDERS) + 1, 0), SLICE):
        part = codes[at: at + SLICE + widest - 1]
        rolling, taken = part * np.uint32(0x9E3779B1), 1
        for n in ORDERS:
            while taken < n:
                rolling = (rolling[: len(rolling) - 1] ^ (rolling[: len(rolling) - 1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + part[taken:] * np.uint32(0xC2B2AE35)
                taken += 1
            if len(rolling) == 0:
                return
            own = rolling[:SLICE] if at + SLICE < len(codes) else rolling
            yield ((own ^ (own >> np.uint32(16))) * np.uint32(0x27D4EB2F)) >> np.uint32(32 - 20)


def buckets_of(text: str | None, only: np.ndarray | None = None) -> np.ndarray:
    """Distinct buckets of a text; those with ``only`` set, if given."""
    found = [np.zeros(0, np.uint32)]
    for part in hashed(text or ""):
        found.append(part if only is None else part[only[part]])
        if only is None:
            found[-1] = np.unique(found[-1])
    return np.unique(np.concatenate(found))


def held_out(id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(documents: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, np.ndarray]:
    """``_id, _text, _toxic`` of the sample, and the numbers of all clean and toxic labels to learn from.

    Of several labels for an id the highest holds; of several documents with an id the one whose text hashes lowest.
    """
    ship(documents.sparkSession)
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
    marks = written(marks.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), "_toxic"), "toxicity-labels")
    all_ = {r["_toxic"]: r["n"] for r in marks.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    drawn = [marks.where(F.col("_toxic") == k).orderBy(F.xxhash64("_id"), "_id").limit(sample) for k in (0, 1)]
    # At most twice the sample of ids, so they can be sent to every task.
    ids = F.broadcast(written(drawn[0].union(drawn[1]), "toxicity-sample"))
    texts = documents.select(F.col("doc_id").alias("_key"), F.coalesce("text", F.lit("")).alias("_text"))
    rows = texts.join(ids, F.col("_key") == F.col("_id")).groupBy("_id", "_toxic").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    return written(rows, "toxicity-rows"), np.array([all_.get(0, 0), all_.get(1, 0)], float)


def bucket_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents that hold each bucket, (clean, toxic), and the numbers of documents."""
    schema = pa.schema([("bucket", pa.int32()), ("clean", pa.int64()), ("toxic", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs = np.zeros((2, BUCKETS), np.int32), np.zeros(2, np.int64)
        for piece in pieces(batches):
            for text, mark in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                counts[int(mark > 0), buckets_of(text)] += 1
                docs[int(mark > 0)] += 1
        some = np.flatnonzero(counts[0] + counts[1])
        yield batch(schema, np.append(some, BUCKETS).astype(np.int32), np.append(counts[0, some], docs[0]).astype(np.int64), np.append(counts[1, some], docs[1]).astype(np.int64))

    sums = rows.select("_text", "_toxic").repartition(TASKS).mapInArrow(run, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # At most one row a bucket that two documents hold; a bucket of one document can't tell anything.
    table = sums.where(f"clean + toxic > 1 or bucket = {BUCKETS}").toArrow()
    counts = np.zeros((2, BUCKETS + 1))
    at = table.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = table.column("clean").to_numpy(), table.column("toxic").to_numpy()
    return counts[:, :BUCKETS], counts[:, BUCKETS]


def log_ratios(counts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    share = (counts + SMOOTH) / (docs + 2 * SMOOTH)[:, None]
    return np.where(counts.sum(axis=0) > 0, np.log(share[1] / share[0]), 0.0)


def telling(counts: np.ndarray, docs: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The buckets with the largest ratios for how often they come, ties to the lower bucket."""
    worth = np.abs(ratios) * np.sqrt((counts / np.maximum(docs, 1)[:, None]).max(axis=0))
    order = np.lexsort((np.arange(BUCKETS), -worth))[:FEATURES]
    return np.sort(order[worth[order] > 0])


def fit(rows: list[tuple[np.ndarray, int]], scale: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by full gradient steps (Adam).  Rows weigh as if their classes came in their true shares."""
    indices = np.concatenate([r for r, _ in rows] or [np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r, _ in rows])
    y = np.array([m for _, m in rows], float)
    weight = np.where(y > 0, shares[1] / max(y.sum(), 1), shares[0] / max((1 - y).sum(), 1))
    bias = float(np.log(shares[1] / shares[0]))
    theta, m, v = np.append(np.zeros(len(scale)), bias), np.zeros(len(scale) + 1), np.zeros(len(scale) + 1)
    values = scale[indices]
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, values * theta[indices], len(rows)) + theta[-1]
        slope = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.append(np.bincount(indices, values * slope[owner], len(scale)) + PENALTY * theta[:-1], slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1] * scale, float(theta[-1])


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Without labelled documents of both classes nothing can be told: every text gets the share of toxic labels, smoothed."""
    rows, all_ = labelled(documents, labels, sample)
    counts, docs = bucket_counts(rows)
    ratios = log_ratios(counts, docs)
    chosen = telling(counts, docs, ratios)
    only = np.zeros(BUCKETS, bool)
    only[chosen] = True
    schema = pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = [np.searchsorted(chosen, buckets_of(t, only)).astype(np.int32) for t in piece.column(0).to_pylist()]
            yield batch(schema, piece.column(1), found)

    table = rows.select("_text", "_toxic").repartition(TASKS).mapInArrow(run, "toxic int, features array<int>").toArrow()
    lists = table.column("features").combine_chunks()
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    fitted = [(flat[a:b], int(mark > 0)) for a, b, mark in zip(ends[:-1], ends[1:], table.column("toxic").to_pylist())]
    shares = (all_ + 1e-3) / (all_.sum() + 2e-3)
    weights = np.zeros(BUCKETS, np.float32)
    own, bias = fit(fitted, ratios[chosen], shares)
    if docs.min() > 0:
        weights[chosen] = own
    else:
        bias = float(np.log(shares[1] / shares[0]))
    return Model(weights, bias)


def scored(documents: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """``_row`` with the columns in ``carry``, and ``_score``.  The model is sent to the executors once."""
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    rows = documents.select(F.coalesce("text", F.lit("")).alias("_text"), F.struct(*[F.col(c) for c in carry]).alias("_row"))
    schema = T.StructType([rows.schema["_row"], T.StructField("_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        only = weights != 0
        for piece in pieces(batches):
            z = np.array([weights[buckets_of(t, only)].sum(dtype=np.float64) + bias for t in piece.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["_row", "_score"])

    return rows.mapInArrow(run, schema)


def score(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row.

    Only the text is scored.  Null and empty texts have no features and get the score of the bias alone.  Repeats get
    equal scores; a null id is not held out.  An empty table gives no rows; other columns are not touched.
    """
    model = train(documents, labels)
    rows = scored(documents, model, ["doc_id"])
    return rows.select("_row.doc_id", held_out(F.col("_row.doc_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def clean(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that score below the threshold, with their columns."""
    columns = documents.columns
    kept = scored(documents, train(documents, labels), columns).where(F.col("_score") < threshold)
    return kept.select(*[F.col("_row")[c].alias(c) for c in columns])
