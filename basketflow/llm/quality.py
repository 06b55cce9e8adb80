"""Quality rules: counts of a text, and its divergence from the language it resembles most.

``references`` gathers, over all documents, each language's distribution of character classes and
of its most common words. ``judged`` compares every document with them by Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1) and takes the language with the smallest distance.
A text is rejected when its characters or its words are further away than the limits allow, unless
it is too short for the histogram in question.

Defined cases: null and empty texts have all counts 0 and fail the base rule; a null language
gives no reference; without any reference only the base rule decides. Repeated rows get the same
verdict, ids are passed through unread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import texts as tx

COMMON_WORDS = 64        # reference words of a language; everything else is one more class
MIN_CHARS = 200          # shortest text whose character classes are judged
MIN_WORDS = 50           # shortest text whose words are judged
MAX_CHAR_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.46

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def _classes() -> np.ndarray:
    """Class of a byte: lower, upper, digit, blank, sentence mark, symbol, letter beyond ASCII,
    control. A character counts by its first byte."""
    kind = np.full(256, 7, np.int64)
    for low, high, k in ((97, 122, 0), (65, 90, 1), (48, 57, 2), (33, 126, 5), (0x80, 0xFF, 6)):
        span = np.arange(low, high + 1)
        kind[span] = np.where(kind[span] == 7, k, kind[span])
    kind[tx.IS_BLANK] = 3
    kind[np.frombuffer(b".,;:!?'\"-()", np.uint8)] = 4
    return kind


_CLASS = _classes()
N_CLASSES = 8


@dataclass
class Reference:
    """Per language: class shares, and shares of its common words by word hash."""

    langs: list[str]
    chars: np.ndarray                  # languages x classes
    keys: list[np.ndarray]             # per language: sorted word hashes
    words: list[np.ndarray]            # per language: shares in the order of keys, then the rest


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    lead = (data & 0xC0) != 0x80
    rows = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount((rows * N_CLASSES + _CLASS[data])[lead],
                       minlength=n * N_CLASSES).reshape(n, N_CLASSES)


def _lower_hashes(data, starts, ends):
    return tx.span_hash(tx.prefix_hash(tx.ASCII_LOWER[data]), starts, ends)


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base columns of each row."""
    starts, ends, first = tx.words(data, offsets)
    n = len(offsets) - 1
    sums = tx.prefix_hash(data)
    hashes = tx.span_hash(sums, starts, ends)
    row = tx.row_of(first)
    salt = tx.mix(np.arange(1, n + 1, dtype=np.uint64))

    line_starts, line_ends, _ = tx.spans(data != 10, offsets)
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_row = np.searchsorted(offsets, line_starts, "right") - 1
    lines = tx.mix(tx.span_hash(sums, line_starts, line_ends) + salt[line_row])
    _, kept = np.unique(lines, return_index=True)
    repeated = np.ones(len(lines), bool)
    repeated[kept] = False

    covered = np.zeros(len(starts), bool)
    if len(starts) >= 3:
        windows = tx.window_hash(hashes, 3)
        inside = np.flatnonzero(row[:-2] == row[2:])
        _, back, times = np.unique(tx.mix(windows[inside] + salt[row[inside]]),
                                   return_inverse=True, return_counts=True)
        twice = inside[times[back] > 1]
        for k in range(3):
            covered[twice + k] = True
    lead = (data & 0xC0) != 0x80
    return {
        "n_words": np.diff(first),
        "word_chars": tx.per_row(lead & ~tx.IS_BLANK[data], offsets),
        "n_symbols": tx.per_row(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_row[repeated], minlength=n).astype(np.int64),
        "n_repeat_words": tx.per_row(covered, first),
    }


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise distance of distributions; a row without mass is at distance 1."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    out = np.sqrt(np.clip((left + right) / 2, 0, 1))
    return np.where(p.sum(axis=-1) > 0, out, 1.0)


def _statistics(batches):
    """(lang, kind, key, n): class counts under kind 0, word counts under kind 1."""
    for batch in batches:
        langs = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
        code, names = langs.indices.to_numpy(False), langs.dictionary.to_pylist()
        for low, high, data, offsets in tx.text_chunks(batch):
            own = code[low:high]
            starts, ends, first = tx.words(data, offsets)
            kinds = class_counts(data, offsets)
            hashes, rows = _lower_hashes(data, starts, ends), tx.row_of(first)
            for k, lang in enumerate(names):
                mine = own == k
                total = kinds[mine].sum(axis=0)
                key, n = np.unique(hashes[mine[rows]], return_counts=True)
                yield pa.record_batch({
                    "lang": pa.array([lang] * (N_CLASSES + len(key)), pa.string()),
                    "kind": np.repeat(np.array([0, 1], np.int32), [N_CLASSES, len(key)]),
                    "key": np.concatenate([np.arange(N_CLASSES), key.view(np.int64)]),
                    "n": np.concatenate([total, n]).astype(np.int64)})


def references(docs: DataFrame, common: int = COMMON_WORDS) -> Reference:
    """Language references over all documents with a language.

    Word counts are summed before they are ranked, and ranked per (language, slice of the words)
    before a language's winners meet, so a hot language is spread. The driver receives
    ``common`` + 9 rows a language.
    """
    counted = (tx.need(docs, "lang", "text").filter(F.col("lang").isNotNull())
               .mapInArrow(_statistics, "lang string, kind int, key long, n long")
               .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    counted = tx.stored(counted, "quality-counts")
    most = [F.desc("n"), F.asc("key")]
    ranked = counted.filter("kind = 1")
    for part in (["lang", F.pmod("key", F.lit(256))], ["lang"]):
        ranked = (ranked.withColumn("rank", F.row_number().over(
            Window.partitionBy(*part).orderBy(*most)))
            .filter(F.col("rank") <= common).drop("rank"))
    totals = counted.filter("kind = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    rows = (counted.filter("kind = 0").unionByName(ranked)
            .unionByName(totals.select("lang", F.lit(2).alias("kind"),
                                       F.lit(0).cast("long").alias("key"), "n"))).collect()
    langs = sorted({r.lang for r in rows})
    chars, keys, words = [], [], []
    for lang in langs:
        mine = [r for r in rows if r.lang == lang]
        shares = np.zeros(N_CLASSES)
        for r in mine:
            if r.kind == 0:
                shares[r.key] = r.n
        key = np.array([r.key for r in mine if r.kind == 1], np.int64).view(np.uint64)
        n = np.array([r.n for r in mine if r.kind == 1], float)
        total = max(sum(r.n for r in mine if r.kind == 2), 1)
        order = np.argsort(key)
        chars.append(shares / max(shares.sum(), 1))
        keys.append(key[order])
        words.append(np.append(n[order] / total, 1 - n.sum() / total))
    return Reference(langs, np.array(chars).reshape(len(langs), N_CLASSES), keys, words)


def distances(ref: Reference, data: np.ndarray, offsets: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest language (-1: none), and the distances of characters and of words to it."""
    n = len(offsets) - 1
    best = np.full(n, -1)
    chars, words = np.zeros(n), np.zeros(n)
    starts, ends, first = tx.words(data, offsets)
    hashes, rows = _lower_hashes(data, starts, ends), tx.row_of(first)
    kinds = class_counts(data, offsets)
    kinds = kinds / np.maximum(kinds.sum(axis=1, keepdims=True), 1)
    total = np.maximum(np.diff(first), 1)
    for k in range(len(ref.langs)):
        keys = ref.keys[k]
        at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
        known = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
        width = len(keys) + 1
        slot = np.where(known, at, width - 1)
        own = np.bincount(rows * width + slot, minlength=n * width).reshape(n, width)
        w = js_distance(own / total[:, None], ref.words[k])
        c = js_distance(kinds, ref.chars[k])
        nearer = (best < 0) | (w + c < words + chars)
        best[nearer], words[nearer], chars[nearer] = k, w[nearer], c[nearer]
    return best, chars, words


def judged(docs: DataFrame, ref: Reference) -> DataFrame:
    """Counts, distances and verdict of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ref)   # languages x COMMON_WORDS

    def run(batches):
        ref = shared.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for low, high, data, offsets in tx.text_chunks(batch):
                c = counts(data, offsets)
                lang, chars, words = distances(ref, data, offsets)
                base = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
                size = tx.per_row((data & 0xC0) != 0x80, offsets)
                far = ((size >= MIN_CHARS) & (chars > MAX_CHAR_DISTANCE)) \
                    | ((c["n_words"] >= MIN_WORDS) & (words > MAX_WORD_DISTANCE))
                yield pa.record_batch({
                    "doc_id": ids.slice(low, high - low), **c, "base_failed": base,
                    "kept": ~base & ~(far & (lang >= 0)),
                    "nearest_lang": pa.array([ref.langs[k] if k >= 0 else None for k in lang],
                                             pa.string()),
                    "char_distance": chars, "word_distance": words})

    return tx.need(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, base_failed boolean, kept boolean, nearest_lang string, "
             "char_distance double, word_distance double")
