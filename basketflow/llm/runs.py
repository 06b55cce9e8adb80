"""Periodic runs of words: stretches that repeat with a small period, found by minimizers.

A run is a maximal stretch of words with smallest period q and length >= max(6, 4 q). Lags up to
``DIRECT`` are scanned: word i against word i + q for every i. Longer periods go by scales
k = 8, 16, 32 ...; scale k is in charge of the periods k/2 < q <= k:

* every stretch of k words gets a hash, and in every window of k/2 such stretches the smallest hash
  is marked (window minima by doubling, so a scale costs few passes over the words);
* inside a run all windows come again q words later, hence so do their minima, and k >= q words
  cannot stand twice within one period: a marked stretch and the next marked one with the same
  hash are exactly q apart. Such pairs are the seeds;
* seeds of one lag that touch form a chain. A run is one chain short of at most k/2 words on
  either side, so the chain is grown by comparing single words, and only so far;
* what has come out long enough is kept unless a divisor of q is a period of it too.

A run of period q has 4 q > 2 k words, so a scale only reads documents that long. Work is
proportional to the words of a scale, whatever repeats how often; nothing is paired within a group
of equal hashes but neighbours. Words are told apart exactly (a dictionary of their bytes), hashes
of stretches only choose seeds.

Documents do not meet: the operator is one pass without a shuffle, and a worker holds one chunk of
texts (or one longer document).

Defined cases: null, empty and blank texts have no words and no runs; a null id is never altered by
``planted``; repeated rows are reported each for itself; of runs with an equal length / period the
one that starts first is the strongest, then the one with the smaller period; very long texts make
a chunk of their own; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import texts as tx

DIRECT = 4          # periods up to here are scanned lag by lag
TIMES = 4           # a run holds its period so often at least ...
LEAST = 6           # ... and so many words
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass
class Words:
    """Words of some documents: codes (equal exactly for equal words), and first word of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    codes: np.ndarray


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends, first = tx.words(data, offsets)
    solid = data[~tx.IS_BLANK[data]]
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(solid)])
    codes = array.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(data, starts, ends, first, codes)


def _extremes(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every ``width`` (a power of two) consecutive values."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _marked(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions whose hash is the smallest of some window that holds them."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    lows = _extremes(hashes, width, np.minimum)
    # A position is a minimum where the largest minimum of its windows is its own hash.
    padded = np.zeros(len(lows) + 2 * (width - 1), np.uint64)
    padded[width - 1:width - 1 + len(lows)] = lows
    return np.flatnonzero((_extremes(padded, width, np.maximum) == hashes) & (hashes != _TOP))


def _grown(codes, low, high, at, lag, most, step):
    """How many words from ``at`` on, going by ``step``, still equal the word ``lag`` further."""
    far = np.zeros(len(at), np.int64)
    alive = np.arange(len(at))
    done, width = 0, 8
    while len(alive) and done < most:
        width = min(width, most - done)
        here = at[alive, None] + step * (far[alive, None] + np.arange(width))
        inside = (here >= low[alive, None]) & (here + lag[alive, None] < high[alive, None])
        here = np.where(inside, here, 0)
        there = np.where(inside, here + lag[alive, None], 0)
        same = inside & (codes[here] == codes[there])
        length = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
        far[alive] += length
        alive = alive[length == width]
        done += width
        width = min(2 * width, max(8, (1 << 20) // max(len(alive), 1)))
    return far


def _chains(codes, hashes, of, low, high, k):
    """Runs (row, start, end, period) of periods in (k/2, k] from the seeds of one scale."""
    none = np.empty((0, 4), np.int64)
    width = k // 2
    at = _marked(hashes, width)
    if not len(at):
        return none
    at = at[np.argsort(hashes[at], kind="stable")]
    lag = at[1:] - at[:-1]
    seed = np.flatnonzero((lag > width) & (lag <= k))
    seed = seed[(hashes[at[seed]] == hashes[at[seed + 1]]) & (of[at[seed]] == of[at[seed + 1]])]
    start, lag = at[seed], lag[seed]
    if not len(start):
        return none
    order = np.lexsort((start, lag, of[start]))
    start, lag = start[order], lag[order]
    of = of[start]
    new = np.ones(len(start), bool)
    new[1:] = (of[1:] != of[:-1]) | (lag[1:] != lag[:-1]) | (start[1:] > start[:-1] + k)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start)) - 1
    of, lag, left, right = of[head], lag[head], start[head], start[tail] + k
    left = left - _grown(codes, low[of], high[of], left - 1, lag, width, -1)
    right = right + _grown(codes, low[of], high[of], right, lag, width, 1)
    return np.column_stack([of, left, right + lag, lag])


def _primes(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] * (n > 1)


def _primitive(codes, start, period) -> bool:
    """No divisor of the period is a period of the stretch as well."""
    return not any(np.array_equal(codes[start:start + period],
                                  codes[start + period // p:start + period // p + period])
                   for p in _primes(period))


def find(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """All runs as rows (document, start, end, period), by document, start and period.

    ``first`` holds the first word of every document and the end of the last; starts and ends
    count words over all documents.
    """
    n, low, high = len(codes), first[:-1], first[1:]
    found = [np.empty((0, 4), np.int64)]
    if n < LEAST:
        return found[0]
    of = tx.row_of(first)
    for q in range(1, DIRECT + 1):
        same = np.zeros(n + 1, bool)
        same[:n - q] = (codes[:-q] == codes[q:]) & (of[:-q] == of[q:])
        edge = np.flatnonzero(np.diff(same, prepend=False))
        start, end = edge[::2], edge[1::2] + q
        long = end - start >= max(LEAST, TIMES * q)
        found.append(np.column_stack([of[start[long]], start[long], end[long],
                                      np.full(long.sum(), q)]))
    hashes, k = tx.mix(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), 1
    places = np.arange(n)
    while True:
        # Double the stretches; of documents too short for a run of this scale nothing is kept.
        shift = k
        k *= 2
        if k >= 2 * DIRECT:
            stay = (high - low >= TIMES * (k // 2 + 1))[of[places]]
            if not stay.all():
                # Words of other documents go; what a stretch would need of them is beyond its end.
                places, hashes = places[stay], hashes[stay]
            if not len(places):
                break
        second = np.full(len(hashes), _TOP)
        second[:-shift] = hashes[shift:] if len(hashes) > shift else _TOP
        whole = places + k <= high[of[places]]
        hashes = np.where(whole, tx.mix(hashes * np.uint64(0xD6E8FEB86659FD93) + second), _TOP)
        if k > DIRECT:
            base = places - np.arange(len(places))      # from the kept words to all words
            got = _chains(codes[places], hashes, of[places], np.searchsorted(places, low),
                          np.searchsorted(places, high), k)
            if len(got):
                move = base[got[:, 1]]
                got[:, 1] += move
                got[:, 2] += move
                found.append(got[got[:, 2] - got[:, 1] >= np.maximum(LEAST, TIMES * got[:, 3])])
    runs = np.concatenate(found)
    prim = [_primitive(codes, s, q) for _, s, _, q in runs.tolist()]
    runs = runs[np.array(prim, bool)]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def planted_sources(ids: list, first: np.ndarray) -> np.ndarray:
    """For every word the word that stands there once tails of some documents repeat.

    With h = crc32 of the decimal id and g = h // 10: where h % 10 = 0, words from a = g % n on
    become word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    """
    source = np.arange(first[-1])
    for doc, low, high in zip(ids, first[:-1].tolist(), first[1:].tolist()):
        if doc is None or low == high:
            continue
        h = zlib.crc32(str(doc).encode())
        if h % 10:
            continue
        g, n = h // 10, high - low
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        source[low + a:high] = low + a + np.arange(n - a) % p
    return source


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Of (start, length, period) by start and period, the first with the greatest ratio."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _reports(planted: bool):
    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for low, high, data, offsets in tx.text_chunks(batch):
                own = ids.slice(low, high - low)
                yield _report(own, read_words(data, offsets), planted)
    return run


def _report(ids: pa.Array, words: Words, planted: bool) -> pa.RecordBatch:
    first = words.first
    source = planted_sources(ids.to_pylist(), first) if planted else np.arange(first[-1])
    runs = find(words.codes[source], first)
    drop = np.zeros(len(source) + 1, np.int64)
    np.add.at(drop, runs[:, 1] + runs[:, 3], 1)
    np.add.at(drop, runs[:, 2], -1)
    keep = np.cumsum(drop)[:-1] == 0
    kept = source[keep]
    size = words.ends[kept] - words.starts[kept]
    ends = np.cumsum(size + 1)
    begins = ends - size - 1
    body = np.full(ends[-1] if len(ends) else 0, 0x20, np.uint8)
    letters = np.repeat(begins - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) \
        else np.empty(0, np.int64)
    letters = letters + np.arange(len(letters))
    body[letters] = words.data[np.repeat(words.starts[kept] - begins, size) + letters]
    body = body.tobytes()
    kept_to = np.concatenate([[0], np.cumsum(keep)])[first]
    places = np.concatenate([[0], ends])[kept_to]
    bounds = np.searchsorted(runs[:, 0], np.arange(len(first)))
    out = {name: [] for name in ("n_runs", "start", "length", "period", "exponent_milli",
                                 "runs_sha256", "collapsed_sha256")}
    relative = np.column_stack([runs[:, 1] - first[runs[:, 0]], runs[:, 2] - runs[:, 1],
                                runs[:, 3]]).tolist()
    for row in range(len(first) - 1):
        own = relative[bounds[row]:bounds[row + 1]]
        top = strongest(own)
        out["n_runs"].append(len(own))
        for name, value in zip(("start", "length", "period", "exponent_milli"),
                               (*top, 1000 * top[1] // top[2]) if top else (None,) * 4):
            out[name].append(value)
        listing = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        out["runs_sha256"].append(hashlib.sha256(listing.encode()).hexdigest())
        text = body[places[row]:max(places[row], places[row + 1] - 1)]
        out["collapsed_sha256"].append(hashlib.sha256(text).hexdigest())
        out.setdefault("n_words", []).append(int(first[row + 1] - first[row]))
        out.setdefault("n_dropped", []).append(
            int(first[row + 1] - first[row] - kept_to[row + 1] + kept_to[row]))
    return pa.record_batch({"doc_id": ids.cast(pa.int64())} | {
        name: pa.array(v, pa.string() if name.endswith("sha256") else pa.int64())
        for name, v in out.items()})


REPORT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long")


def reported(docs: DataFrame, planted: bool = False) -> DataFrame:
    """One row a document: its runs, the strongest of them, and digests of all and of what is left.

    ``planted`` repeats the tails of some documents first (see ``planted_sources``).
    """
    return tx.need(docs, "doc_id", "text").mapInArrow(_reports(planted), REPORT)


def _listings(batches):
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for low, high, data, offsets in tx.text_chunks(batch):
            words = read_words(data, offsets)
            runs = find(words.codes, words.first)
            yield pa.record_batch({
                "doc_id": ids.slice(low, high - low).take(pa.array(runs[:, 0])).cast(pa.int64()),
                "start": pa.array(runs[:, 1] - words.first[runs[:, 0]]),
                "length": pa.array(runs[:, 2] - runs[:, 1]), "period": pa.array(runs[:, 3])})


def listed(docs: DataFrame) -> DataFrame:
    """Every run of every document: doc_id, start (word number), length and period."""
    return tx.need(docs, "doc_id", "text").mapInArrow(
        _listings, "doc_id long, start long, length long, period long")


def _collapsed(batches):
    for batch in batches:
        column = batch.schema.get_field_index("text")
        texts = []
        for _, _, data, offsets in tx.text_chunks(batch):
            words = read_words(data, offsets)
            runs = find(words.codes, words.first)
            drop = np.zeros(len(words.codes) + 1, np.int64)
            np.add.at(drop, runs[:, 1] + runs[:, 3], 1)
            np.add.at(drop, runs[:, 2], -1)
            gone = np.cumsum(drop)[:-1] > 0
            # A dropped word goes with the blanks before it; documents without runs stay as they are.
            before = np.empty(len(words.starts), np.int64)
            before[1:] = words.ends[:-1]
            heads = words.first[:-1][np.diff(words.first) > 0]
            before[heads] = offsets[:-1][np.diff(words.first) > 0]
            cut = np.zeros(len(data) + 1, np.int64)
            np.add.at(cut, before[gone], 1)
            np.add.at(cut, words.ends[gone], -1)
            stay = np.cumsum(cut)[:-1] == 0
            left = data[stay].tobytes()
            bounds = np.concatenate([[0], np.cumsum(stay)])[offsets].tolist()
            texts += [left[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        new = pc.if_else(pc.is_null(batch.column(column)), pa.scalar(None, pa.string()),
                         pa.array(texts, pa.binary()).cast(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [new if i == column else c for i, c in enumerate(batch.columns)], schema=batch.schema)


def collapsed(docs: DataFrame) -> DataFrame:
    """The documents with every run cut to its first period; other columns stay as they are."""
    return docs.mapInArrow(_collapsed, docs.schema)
