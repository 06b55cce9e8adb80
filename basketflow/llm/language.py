"""Language of a text: cosine of TF-IDF n-gram vectors with several centroids per language.

Byte n-grams of the lower-cased text (anything but letters is one space) are hashed into
``DIMENSIONS`` features. ``learn`` counts document frequencies over all training rows, then runs
spherical k-means inside each language on at most about ``SAMPLE`` of its rows (chosen by hash of
the id), so that dialects and mixtures get centroids of their own. A text takes the language of the
nearest centroid; beyond ``REJECT`` cosine distance the row is marked as rejected, though the
nearest language is still given.

Defined cases: null texts and texts without any letter are ``und`` with score 0, as is everything
when no language could be learned; rows with null lang are not learned from; repeated rows agree;
equal cosines go to the smaller language code.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx

DIMENSIONS = 4096
ORDERS = (1, 2, 3, 4)
CENTROIDS = 4
SAMPLE = 1000
ROUNDS = 12
REJECT = 0.85
UNKNOWN = "und"

_BYTES = np.arange(256)
_FOLD = np.where((_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 0x80), _BYTES, 32).astype(np.uint8)
_FOLD[65:91] = np.arange(97, 123)


@dataclass
class Centroids:
    langs: list[str]              # language of each centroid
    vectors: np.ndarray           # centroids x dimensions, unit length
    idf: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams: rows x dimensions. Runs of non-letters count once."""
    n = len(offsets) - 1
    folded = _FOLD[data]
    if len(data):   # upper-case letters of Latin-1 as their lower-case twins
        upper = (data >= 0x80) & (data <= 0x9E) & (np.roll(data, 1) == 0xC3)
        folded = np.where(upper, folded | 0x20, folded)
    keep = folded != 32
    keep[1:] |= folded[:-1] != 32
    if len(keep):
        keep[0] = True
    sums = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=sums[1:])
    code, bounds = folded[keep].astype(np.uint32), sums[offsets]
    rows = np.repeat(np.arange(n), np.diff(bounds))
    total = np.zeros(n * DIMENSIONS, np.float32)
    gram = np.zeros(len(code), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        size = len(code) - order + 1
        if size <= 0:
            break
        gram = gram[:size] * np.uint32(0x01000193) + code[order - 1:order - 1 + size] + np.uint32(1)
        if order in ORDERS:
            inside = rows[:size] == rows[order - 1:order - 1 + size]
            slot = ((gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
            total += np.bincount((rows[:size] * DIMENSIONS + slot)[inside],
                                 minlength=n * DIMENSIONS)
    return total.reshape(n, DIMENSIONS)


def weighted(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vector = np.log1p(count) * idf
    norm = np.linalg.norm(vector, axis=1, keepdims=True)
    return (vector / np.where(norm > 0, norm, 1)).astype(np.float32)


def _small_chunks(batch):
    """Chunks of at most 256 rows: the feature matrix stays at 4 MB."""
    for low, high, data, offsets in tx.text_chunks(batch):
        for a in range(low, high, 256):
            b = min(a + 256, high)
            cut = offsets[a - low:b - low + 1]
            yield a, b, data[cut[0]:cut[-1]], cut - cut[0]


def _frequencies(batches):
    seen, rows = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for _, _, data, offsets in _small_chunks(batch):
            seen += (features(data, offsets) > 0).sum(axis=0)
            rows += len(offsets) - 1
    yield pa.record_batch({"slot": np.arange(-1, DIMENSIONS), "docs": np.append(rows, seen)})


def _kmeans(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from the row furthest from what is chosen, so reruns agree."""
    centres = vectors[:1]
    while len(centres) < k:
        centres = np.vstack([centres, vectors[np.argmin((vectors @ centres.T).max(axis=1))]])
    for _ in range(ROUNDS):
        owner = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[owner == c].sum(axis=0) for c in range(len(centres))])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres.astype(np.float32)


def learn(docs: DataFrame, folds: int = 3, hidden_fold: int = 1, sample: int = SAMPLE,
          centroids: int = CENTROIDS) -> Centroids | None:
    """Centroids from the rows with a language outside the hidden fold; None without such rows."""
    training = (tx.need(docs, "doc_id", "lang", "text")
                .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
                .filter(tx.id_bucket(folds) != hidden_fold))
    sizes = training.groupBy("lang").count().collect()     # one row a language
    if not sizes:
        return None
    found = (training.select("text").mapInArrow(_frequencies, "slot long, docs long")
             .groupBy("slot").agg(F.sum("docs").alias("docs")).collect())
    docs_by_slot = {r.slot: r.docs for r in found}
    n = docs_by_slot[-1]
    idf = np.log((1 + n) / (1 + np.array([docs_by_slot[i] for i in range(DIMENSIONS)]))) + 0.05

    chance = F.lit(0.0)
    for r in sizes:
        chance = F.when(F.col("lang") == r.lang, min(1.0, sample / r["count"])).otherwise(chance)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    picked = training.filter(draw < chance)

    def vectors(batches):
        for batch in batches:
            langs = batch.column(batch.schema.get_field_index("lang"))
            for low, high, data, offsets in _small_chunks(batch):
                v = weighted(features(data, offsets), idf)
                yield pa.record_batch({"lang": langs.slice(low, high - low),
                                       "vector": pa.array([x.tobytes() for x in v], pa.binary())})

    def cluster(key, table):
        v = np.stack([np.frombuffer(x, np.float32)
                      for x in sorted(table.column("vector").to_pylist())])
        v = v[np.linalg.norm(v, axis=1) > 0]
        centres = _kmeans(v, min(centroids, len(v))) if len(v) else v
        return pa.table({"lang": pa.array([key[0].as_py()] * len(centres), pa.string()),
                         "vector": pa.array([c.tobytes() for c in centres], pa.binary())})

    rows = (picked.select("lang", "text").mapInArrow(vectors, "lang string, vector binary")
            .groupBy("lang").applyInArrow(cluster, "lang string, vector binary").collect())
    rows.sort(key=lambda r: (r.lang, bytes(r.vector)))
    if not rows:
        return None
    return Centroids([r.lang for r in rows],
                     np.stack([np.frombuffer(bytes(r.vector), np.float32) for r in rows]), idf)


def predicted(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1) and rejected for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # languages x CENTROIDS vectors

    def run(batches):
        model = shared.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for low, high, data, offsets in _small_chunks(batch):
                n = high - low
                near, score = np.full(n, -1), np.zeros(n)
                if model is not None:
                    cosine = weighted(features(data, offsets), model.idf) @ model.vectors.T
                    near = np.argmax(cosine, axis=1)
                    score = np.clip(cosine[np.arange(n), near], 0, 1).astype(float)
                ascii_letters = tx.per_row(((data | 0x20) >= 97) & ((data | 0x20) <= 122)
                                           & (data < 0x80), offsets)
                for r in np.flatnonzero(ascii_letters == 0):
                    text = data[offsets[r]:offsets[r + 1]].tobytes().decode("utf-8", "replace")
                    if not any(map(str.isalpha, text)):
                        near[r] = -1
                score = np.where(near < 0, 0.0, score)
                yield pa.record_batch({
                    "doc_id": ids.slice(low, n),
                    "lang_pred": [model.langs[k] if k >= 0 else UNKNOWN for k in near],
                    "score": score, "rejected": score < 1 - REJECT})

    return tx.need(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")
