"""Language-model scores: a bigram model by deleted interpolation.

P(w | v) = a[b] * c(v, w) / c(v) + (1 - a[b]) * (c(w) + 0.1) / (N + 0.1 (V + 1)), where b is the
bucket (power of two) of the context's count. The weights a[b] are learned by expectation
maximisation on one fold of the training rows, with counts from the other training rows; scores
then use the counts of all training rows.

Counts never meet in one place. Documents become chunks (written once, so retries see the same
ones). A chunk sends each distinct word and word pair once, as sorted hashes, to the slice of the
hash range they fall in; a slice adds up what all chunks sent and answers each of them. A word in
every line is thus one entry a chunk, and slices grow in number with the text, not in size. The
statistics for the weights are a histogram over (bucket, ratio of the two estimates), which is
bounded and follows from every held-out token.

Defined cases: null and empty texts are one end token; without training rows every token has base
probability 1 / 1; a null doc_id counts as the empty text when rows are dealt; repeated rows count
as often as they stand there. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx

CHUNK_BYTES = 8 << 20          # text of a chunk
SLICE_BYTES = 3_000_000        # text per slice of the hash range
SMOOTH = 0.1
BINS = 32                      # histogram bins per doubling of the ratio
REACH = 64                     # doublings covered on either side
ROUNDS = 60
END, BEGIN = np.uint64(0xE17A1465D5C1B2A3), np.uint64(0x9D39247E33776D41)
PAIR = np.uint64(0xA0761D6478BD642F)


def _pack(a: np.ndarray) -> bytes:
    """Byte planes, compressed: high bytes of small numbers cost nothing."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(width, -1).T).reshape(-1).view(kind)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


@dataclass
class Chunk:
    """Tokens of some documents: positions in ``words`` (hashes), and first token of each."""

    words: np.ndarray
    tokens: np.ndarray
    first: np.ndarray

    def contexts(self) -> np.ndarray:
        """Hash of the token before each token."""
        before = np.empty(len(self.tokens), np.uint64)
        before[1:] = self.words[self.tokens[:-1]]
        before[self.first[:-1]] = BEGIN
        return before

    def pairs(self) -> np.ndarray:
        return tx.mix(self.contexts() * PAIR + self.words[self.tokens])

    def per_token(self, per_doc: np.ndarray) -> np.ndarray:
        return np.repeat(per_doc, np.diff(self.first))


def tokenised(data: np.ndarray, offsets: np.ndarray) -> Chunk:
    lower = tx.ASCII_LOWER[data]
    starts, ends, first = tx.words(lower, offsets)
    hashes = tx.span_hash(tx.prefix_hash(lower), starts, ends)
    n = len(offsets) - 1
    first = first + np.arange(n + 1)
    tokens = np.full(len(hashes) + n, END, np.uint64)
    word = np.ones(len(tokens), bool)
    word[first[1:] - 1] = False
    tokens[word] = hashes
    words, back = np.unique(tokens, return_inverse=True)
    return Chunk(words, back, first)


def _chunks(folds: int):
    def run(batches):
        for batch in batches:
            fold = batch.column(batch.schema.get_field_index("fold")).to_numpy(False)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for low, high, data, offsets in tx.text_chunks(batch, limit=CHUNK_BYTES):
                own = fold[low:high]
                for tuning in (False, True):
                    rows = np.flatnonzero((own == 1) == tuning)
                    if not len(rows):
                        continue
                    size = np.diff(offsets)[rows]
                    bounds = np.concatenate([[0], np.cumsum(size)])
                    at = np.repeat(offsets[rows] - bounds[:-1], size) + np.arange(bounds[-1])
                    c = tokenised(data[at], bounds)
                    common = np.argsort(-np.bincount(c.tokens, minlength=len(c.words)),
                                        kind="stable")
                    place = np.empty(len(common), np.uint32)
                    place[common] = np.arange(len(common))
                    yield pa.record_batch({
                        "chunk": [uuid.uuid4().hex], "tuning": [tuning],
                        "ids": pa.array([ids.slice(low, high - low).take(
                            pa.array(rows)).to_pylist()], pa.list_(pa.int64())),
                        "held": pa.array([(own[rows] == 0).tolist()], pa.list_(pa.bool_())),
                        "words": [_pack(c.words[common])], "tokens": [_pack(place[c.tokens])],
                        "first": [_pack(c.first)]})
    return run


CHUNK_SCHEMA = ("chunk string, tuning boolean, ids array<bigint>, held array<boolean>, "
                "words binary, tokens binary, first binary")


def _chunk(row: dict) -> Chunk:
    return Chunk(_unpack(row["words"], np.uint64),
                 _unpack(row["tokens"], np.uint32).astype(np.int64),
                 _unpack(row["first"], np.int64))


def _keys(c: Chunk, held: np.ndarray):
    """Per kind: distinct keys, the place of every token among them, training counts."""
    train = c.per_token(~held)
    for kind, values in ((0, c.words[c.tokens]), (1, c.pairs())):
        keys, back = np.unique(values, return_inverse=True)
        yield kind, keys, back, np.bincount(back, train, len(keys)).astype(np.int64)


def _cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the slices in sorted keys."""
    if not bits:
        return np.array([0, len(keys)])
    inner = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, inner), [len(keys)]])


def _requests(bits: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _chunk(row)
                for kind, keys, _, n in _keys(c, np.array(row["held"], bool)):
                    cut = _cuts(keys, bits)
                    full = np.flatnonzero(np.diff(cut))
                    yield pa.record_batch({
                        "kind": np.full(len(full), kind, np.int32),
                        "slice": full.astype(np.int32),
                        "chunk": [row["chunk"]] * len(full), "tuning": [row["tuning"]] * len(full),
                        "keys": [_pack_sorted(keys[cut[k]:cut[k + 1]]) for k in full],
                        "n": [_pack(n[cut[k]:cut[k + 1]]) for k in full]})
    return run


ANSWER_SCHEMA = ("chunk string, tuning boolean, kind int, slice int, n binary, rest binary, "
                 "total long, total_rest long, distinct long, distinct_rest long")


def _answer(key, table):
    """Add up one slice and answer every chunk: counts of all training rows, and (for tuning
    chunks) of those outside the tuning fold. One more row carries the slice's totals."""
    kind, part = (k.as_py() for k in key)
    rows = table.select(["chunk", "tuning", "keys", "n"]).to_pylist()
    keys = [_unpack_sorted(r["keys"]) for r in rows]
    n = [_unpack(r["n"], np.int64) for r in rows]
    bounds = np.cumsum([0] + [len(k) for k in keys])
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    everything = np.bincount(back, np.concatenate(n), len(distinct)).astype(np.int64)
    tuning = np.concatenate([x * r["tuning"] for x, r in zip(n, rows)])
    rest = everything - np.bincount(back, tuning, len(distinct)).astype(np.int64)
    blank = [0] * len(rows)
    out = {"chunk": [r["chunk"] for r in rows] + [None],
           "tuning": [r["tuning"] for r in rows] + [False],
           "n": [_pack(everything[back[a:b]]) for a, b in zip(bounds, bounds[1:])] + [None],
           "rest": [_pack(rest[back[a:b]]) if r["tuning"] else None
                    for r, a, b in zip(rows, bounds, bounds[1:])] + [None],
           "total": blank + [int(everything.sum())], "total_rest": blank + [int(rest.sum())],
           "distinct": blank + [int((everything > 0).sum())],
           "distinct_rest": blank + [int((rest > 0).sum())]}
    size = len(rows) + 1
    fields = {"chunk": pa.array(out["chunk"], pa.string()), "tuning": pa.array(out["tuning"]),
              "kind": pa.array([kind] * size, pa.int32()),
              "slice": pa.array([part] * size, pa.int32())}
    fields |= {k: pa.array(out[k], pa.binary()) for k in ("n", "rest")}
    fields |= {k: pa.array(out[k], pa.int64()) for k in
               ("total", "total_rest", "distinct", "distinct_rest")}
    return pa.table(fields)


def _answered(left: pa.Table, right: pa.Table, column: str):
    """The chunk of a cogroup and, per kind, the counts of its distinct keys put together."""
    row = left.to_pylist()[0]
    answers = sorted(right.select(["kind", "slice", column]).to_pylist(),
                     key=lambda r: (r["kind"], r["slice"]))
    counts = [np.concatenate([_unpack(r[column], np.int64) for r in answers if r["kind"] == k])
              for k in (0, 1)]
    return row, counts


def _estimates(row: dict, counts, total: int, distinct: int):
    """Per token: count, smoothed unigram probability, context's bucket, bigram ratio to it."""
    c = _chunk(row)
    held = np.array(row["held"], bool)
    (_, words, word_at, _), (_, _, pair_at, _) = _keys(c, held)
    n = counts[0][word_at]
    base = (n + SMOOTH) / (total + SMOOTH * (distinct + 1))
    # How often the token before occurs as a context; a text's begin occurs once a text.
    ends = counts[0][np.searchsorted(words, END)]
    context = np.empty(len(n), np.int64)
    context[1:] = n[:-1]
    context[c.first[:-1]] = ends
    bucket = np.where(context > 0, np.frexp(context.astype(float))[1], 0)
    ratio = np.where(context > 0, counts[1][pair_at] / np.maximum(context, 1), 0.0) / base
    return c, held, n, base, bucket, ratio


def _histogram(total: int, distinct: int):
    def run(key, left, right):
        if not left.num_rows:
            return pa.table({k: pa.array([], pa.int64()) for k in ("bucket", "bin", "n")})
        row, counts = _answered(left, right, "rest")
        *_, bucket, ratio = _estimates(row, counts, total, distinct)
        with np.errstate(divide="ignore"):
            place = np.clip(np.rint(np.log2(ratio) * BINS), -REACH * BINS - 1, REACH * BINS)
        code, n = np.unique(bucket * (1 << 20) + (place.astype(np.int64) + (1 << 19)),
                            return_counts=True)
        return pa.table({"bucket": code >> 20, "bin": (code & ((1 << 20) - 1)) - (1 << 19), "n": n})
    return run


def mixture_weights(rows) -> np.ndarray:
    """Expectation maximisation per bucket from (bucket, bin, n); 0 where nothing was seen."""
    weights = np.zeros(70)
    for b in sorted({r.bucket for r in rows} - {0}):
        own = [r for r in rows if r.bucket == b]
        n = np.array([r.n for r in own], float)
        place = np.array([r.bin for r in own])
        ratio = np.where(place < -REACH * BINS, 0.0, 2.0 ** (place / BINS))
        a = 0.5
        for _ in range(ROUNDS):
            a = float((n * a * ratio / (a * ratio + 1 - a)).sum() / n.sum())
        weights[b] = min(a, 0.999)
    return weights


def _scores(total: int, distinct: int, weights: np.ndarray):
    def run(key, left, right):
        if not left.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()),
                             "held_out": pa.array([], pa.bool_()),
                             "n_tokens": pa.array([], pa.int64()),
                             "n_known": pa.array([], pa.int64()),
                             "base_score": pa.array([], pa.float64()),
                             "score": pa.array([], pa.float64())})
        row, counts = _answered(left, right, "n")
        c, held, n, base, bucket, ratio = _estimates(row, counts, total, distinct)
        a = weights[bucket]
        base_log = np.log10(base)
        mixed = base_log + np.log10(a * ratio + 1 - a)
        at = c.first[:-1]
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "held_out": held,
            "n_tokens": np.diff(c.first), "n_known": tx.per_row(n > 0, c.first),
            "base_score": np.add.reduceat(base_log, at), "score": np.add.reduceat(mixed, at)})
    return run


def scored(docs: DataFrame, folds: int = 10) -> DataFrame:
    """One row a document: held_out (fold 0), token counts, base and interpolated score."""
    spark = docs.sparkSession
    source = tx.need(docs, "doc_id", "text").withColumn(
        "fold", tx.id_bucket(folds).cast("int"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(size, 1) / SLICE_BYTES))))
    chunks = tx.stored(source.mapInArrow(_chunks(folds), CHUNK_SCHEMA), "lm-chunks")
    answers = tx.stored(
        chunks.select("chunk", "tuning", "held", "words", "tokens", "first")
        .mapInArrow(_requests(bits), "kind int, slice int, chunk string, tuning boolean, "
                                     "keys binary, n binary")
        .groupBy("kind", "slice").applyInArrow(_answer, ANSWER_SCHEMA), "lm-answers")
    totals = (answers.filter("chunk IS NULL AND kind = 0")
              .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in
                     ("total", "total_rest", "distinct", "distinct_rest")]).first())
    replies = answers.filter("chunk IS NOT NULL").select("chunk", "tuning", "kind", "slice",
                                                         "n", "rest")
    histogram = (chunks.filter("tuning").groupBy("chunk")
                 .cogroup(replies.filter("tuning").groupBy("chunk"))
                 .applyInArrow(_histogram(totals.total_rest, totals.distinct_rest),
                               "bucket long, bin long, n long")
                 .groupBy("bucket", "bin").agg(F.sum("n").alias("n")).collect())
    weights = mixture_weights(histogram)
    result = (chunks.groupBy("chunk").cogroup(replies.groupBy("chunk"))
              .applyInArrow(_scores(totals.total, totals.distinct, weights),
                            "doc_id long, held_out boolean, n_tokens long, n_known long, "
                            "base_score double, score double"))
    return result.withColumn("train_tokens", F.lit(totals.total).cast("long"))
