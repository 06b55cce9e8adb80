"""Toxic documents: a learned lexicon, misspellings by Levenshtein automaton, quotation by context.

Learning (``learn``) reads the labelled training rows. Word beginnings that stand in many toxic
documents and hardly ever in clean ones become lexicon entries: a whole word where the word is
nearly always the same, else a stem that any ending may follow. Scoring walks the lexicon trie once
per chunk of text and keeps, for all distinct words of the chunk together, the states of their
Levenshtein automata as bit masks, so that a branch is left as soon as no word is alive in it.

Defined cases: null and empty texts score the share of toxic rows among training rows without a
hit; a null doc_id counts as the empty text when rows are dealt; labels other than 0 and 1, or
without document, are not learned; without training labels every score is 0. Repeated rows score
alike. Texts may be of any length: a chunk is at least one document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx

MIN_STEM = 4          # code points of the shortest lexicon entry
MAX_TERM = 16         # code points beyond which a beginning is not examined
MIN_SHARE = 0.005     # of the toxic training documents an entry must occur in
CHANCE = 1e-5         # an entry's support must be this unlikely at the toxic share alone
MIN_PRECISION = 0.93  # of an entry that decides alone
MIN_EVIDENCE = 0.5    # of an entry that counts as evidence; three different words then decide
MIN_GAIN = 20.0       # nats by which such an entry's documents must beat the toxic share
EVIDENCE = 0.45       # trust in one word of such an entry at most
MIN_VARIETY = 0.5     # distinct surroundings a document; copies of one text all show the same
MAX_KNOWN = 3         # innocent spellings near an entry beyond which it must be exact
MAX_LABELS = 200_000  # labelled rows learned from, about
MAX_TERMS = 2000      # capacity of the lexicon, strongest entries first
QUOTE_REACH = 160     # code points searched for quotation marks on either side of a hit

_LIMIT = 0x3000
_CODES = np.arange(_LIMIT)
_WORD = np.array([chr(c).isalnum() for c in _CODES])
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in _CODES], np.uint32)
_TABLE = tx.mix(np.arange(7, _LIMIT + 7, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
# Quotation marks: opening -> closing.
_QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»"}


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of a chunk and the row offsets counted in them."""
    text = data.tobytes().decode("utf-8", "replace")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    low = np.where(codes < _LIMIT, _LOWER[np.minimum(codes, _LIMIT - 1)], codes)
    return low, leads[offsets]


def code_words(codes: np.ndarray, offsets: np.ndarray):
    """Runs of letters and digits, and running sums for hashing them."""
    near = np.minimum(codes, _LIMIT - 1)
    inside = _WORD[near] | (codes >= _LIMIT)
    starts, ends, first = tx.spans(inside, offsets)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((_TABLE[near] + codes) * tx._power("up", len(codes)), out=sums[1:])
    return starts, ends, first, sums


def _string(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "replace")


@dataclass
class Trie:
    """Lexicon entries by their code points; a node holds (children, entry ending here)."""

    root: dict = field(default_factory=dict)

    def add(self, word: str, entry: int) -> None:
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = entry


@dataclass
class Model:
    """words, stem flags and precisions of the entries; everything a worker needs."""

    words: list[str]
    stems: list[bool]
    weights: list[float]
    known: frozenset = frozenset()      # spellings near an entry that clean documents use
    strict: frozenset = frozenset()     # entries with several such spellings
    fuzzy: float = 0.75                 # trust in a misspelled hit against an exact one
    quoted: float = 0.5                 # trust in a quoted hit
    prior: float = 0.0                  # toxic share of training rows without a hit

    def __post_init__(self):
        self.trie = Trie()
        for i, word in enumerate(self.words):
            self.trie.add(word, i)
        self.width = max([len(w) for w in self.words] or [1]) + 2

    def allowed(self, entry: int) -> int:
        """Edits tolerated in an entry. Stems, short entries and entries whose neighbourhood is
        full of innocent words must be exact."""
        n = len(self.words[entry])
        if self.stems[entry] or entry in self.strict:
            return 0
        return 0 if n < 5 else 1 if n < 10 else 2

    def match(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best entry (-1: none) and its edit distance for words given as a code matrix.

        Bit i of a mask says that i code points of the word are read; one mask per number of
        edits. Words longer than the matrix can only match stems.
        """
        n, width = codes.shape
        entry = np.full(n, -1, np.int32)
        distance = np.full(n, 9, np.uint8)
        one = np.uint64(1)
        final = np.where(lengths <= width, one << np.minimum(lengths, 62).astype(np.uint64), 0)
        final = final.astype(np.uint64)
        upto = (final << one) - one
        upto = np.where(final == 0, np.uint64((1 << (width + 1)) - 1), upto)
        reads: dict[str, np.ndarray] = {}

        def read(c: str) -> np.ndarray:
            if c not in reads:
                bits = np.packbits(codes == ord(c), axis=1, bitorder="little")
                whole = np.zeros((n, 8), np.uint8)
                whole[:, :bits.shape[1]] = bits
                reads[c] = whole.view(np.uint64)[:, 0]
            return reads[c]

        start = [np.full(n, (1 << (e + 1)) - 1, np.uint64) & upto for e in range(3)]
        todo = [(self.trie.root, np.arange(n), start)]
        while todo:
            node, alive, masks = todo.pop()
            for c, child in node.items():
                if c == "":
                    continue
                seen, top = read(c)[alive], upto[alive]
                nexts = [((masks[0] & seen) << one) & top]
                for e in (1, 2):
                    nexts.append((((masks[e] & seen) << one) | masks[e - 1]
                                  | (masks[e - 1] << one) | (nexts[e - 1] << one)) & top)
                live = np.flatnonzero(nexts[2])
                if not len(live):
                    continue
                ids, kept = alive[live], [m[live] for m in nexts]
                found = child.get("", -1)
                if found >= 0:
                    for e in range(self.allowed(found) + 1):
                        hit = kept[e] != 0 if self.stems[found] else (kept[e] & final[ids]) != 0
                        better = ids[hit & (distance[ids] > e)]
                        entry[better], distance[better] = found, e
                todo.append((child, ids, kept))
        return entry, distance

    def hits(self, codes, starts, ends, sums):
        """Entry and distance for each word of a chunk; distinct words are matched once."""
        if not len(starts) or not self.words:
            return np.full(len(starts), -1, np.int32), np.zeros(len(starts), np.uint8)
        lengths = ends - starts
        _, sample, back = np.unique(tx.span_hash(sums, starts, ends), return_index=True,
                                    return_inverse=True)
        entry = np.full(len(sample), -1, np.int32)
        distance = np.zeros(len(sample), np.uint8)
        step = np.arange(self.width)
        for low in range(0, len(sample), 1 << 16):
            part = sample[low:low + (1 << 16)]
            at = np.minimum(starts[part][:, None] + step, len(codes) - 1)
            matrix = np.where(step < lengths[part][:, None], codes[at], 0)
            found, far = self.match(matrix, lengths[part])
            for k in np.flatnonzero((found >= 0) & (far > 0)):
                word = _string(codes[starts[part[k]]:ends[part[k]]])
                if word in self.known:
                    found[k] = -1
            entry[low:low + len(part)], distance[low:low + len(part)] = found, far
        return entry[back], distance[back]


def _is_quoted(codes: np.ndarray, low: int, high: int, start: int, end: int) -> bool:
    """Whether the hit stands between an opening and a closing mark of its line."""
    before = _string(codes[max(low, start - QUOTE_REACH):start]).rpartition("\n")[2]
    after = _string(codes[end:min(high, end + QUOTE_REACH)]).partition("\n")[0]
    for opening, closing in _QUOTES.items():
        inside = before.count(opening) % 2 == 1 if opening == closing \
            else before.rfind(opening) > before.rfind(closing)
        if inside and closing in after:
            return True
    return False


def _chunk_hits(model: Model, data: np.ndarray, offsets: np.ndarray):
    """Per hit: row, entry, distance, quoted; the code points, the hits' places and words."""
    codes, bounds = code_points(data, offsets)
    starts, ends, first, sums = code_words(codes, bounds)
    entry, distance = model.hits(codes, starts, ends, sums)
    at = np.flatnonzero(entry >= 0)
    rows = tx.row_of(first)[at]
    quoted = np.array([_is_quoted(codes, bounds[r], bounds[r + 1], starts[i], ends[i])
                       for r, i in zip(rows, at)], bool)
    return rows, entry[at], distance[at], quoted, codes, starts[at], ends[at], \
        tx.span_hash(sums, starts[at], ends[at])


def _beginnings(data: np.ndarray, offsets: np.ndarray):
    """Distinct word beginnings per row: hash, whole word?, start, length, hash of the two words
    on either side."""
    codes, bounds = code_points(data, offsets)
    starts, ends, first, sums = code_words(codes, bounds)
    rows = tx.row_of(first)
    padded = np.zeros(len(starts) + 4, np.uint64)
    padded[2:-2] = tx.span_hash(sums, starts, ends)
    around = tx.mix(padded[:-4] + tx.mix(padded[1:-3] + tx.mix(padded[3:-1] + tx.mix(padded[4:]))))
    out = []
    for length in range(MIN_STEM, MAX_TERM + 1):
        fit = ends - starts >= length
        at, row, near = starts[fit], rows[fit], around[fit]
        if not len(at):
            break
        key = tx.span_hash(sums, at, at + length)
        whole = ends[fit] == at + length
        pair = tx.mix(key + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.lexsort((~whole, pair))
        keep = order[np.concatenate([[True], np.diff(pair[order]) != 0])]
        out.append((key[keep], whole[keep], at[keep], np.full(len(keep), length), near[keep]))
    if not out:
        return codes, *[np.empty(0, np.int64)] * 5
    return codes, *[np.concatenate(x) for x in zip(*out)]


def _toxic_beginnings(batches):
    for batch in batches:
        for _, _, data, offsets in tx.text_chunks(batch):
            codes, key, whole, at, length, near = _beginnings(data, offsets)
            if not len(key):
                continue
            _, sample, back, count = np.unique(tx.mix(key) + near, return_index=True,
                                               return_inverse=True, return_counts=True)
            yield pa.record_batch({
                "key": key[sample].view(np.int64), "near": near[sample].view(np.int64),
                "docs": count,
                "whole": np.bincount(back, whole, len(sample)).astype(np.int64),
                "term": [_string(codes[at[i]:at[i] + length[i]]) for i in sample]})


def learn(docs: DataFrame, labels: DataFrame, folds: int = 3, hidden_fold: int = 1) -> Model:
    """Fit the lexicon on labelled rows outside the hidden fold.

    About MAX_LABELS labels are used (chosen by hash of the id), so the labels can be broadcast
    and no text is shuffled. What reaches the driver is bounded by MIN_SHARE (candidate entries)
    and MAX_TERMS, not by the corpus.
    """
    labelled = (tx.need(labels, "doc_id", "toxic").filter(F.col("toxic").isin(0, 1))
                .filter(tx.id_bucket(folds) != hidden_fold)
                .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = labelled.count()
    share = int(min(1.0, MAX_LABELS / max(n, 1)) * (1 << 30)) + 1
    labelled = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(share))
    training = tx.stored(
        tx.need(docs, "doc_id", "text").filter(F.col("text").isNotNull())
        .join(F.broadcast(labelled), "doc_id").select("toxic", "text"), "toxic-training")
    sizes = {r.toxic: r["count"] for r in training.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return Model([], [], [])
    share = min(max(n_toxic / (n_toxic + n_clean), 1e-6), 0.9)
    support = max(math.ceil(MIN_SHARE * n_toxic), math.ceil(math.log(CHANCE) / math.log(share)))
    found = (training.filter("toxic = 1").select("text")
             .mapInArrow(_toxic_beginnings,
                         "key long, near long, docs long, whole long, term string")
             .groupBy("key", "near").agg(F.sum("docs").alias("docs"),
                                         F.sum("whole").alias("whole"),
                                         F.max("term").alias("term"))
             .groupBy("key").agg(F.sum("docs").alias("docs"), F.sum("whole").alias("whole"),
                                 F.max("term").alias("term"), F.count("*").alias("variety"))
             .filter((F.col("variety") >= support)
                     & (F.col("variety") >= MIN_VARIETY * F.col("docs"))).collect())
    wanted = np.array(sorted(r.key for r in found), np.int64).view(np.uint64)
    wanted = np.sort(wanted)

    def clean_counts(batches):
        for batch in batches:
            for _, _, data, offsets in tx.text_chunks(batch):
                _, key, *_ = _beginnings(data, offsets)
                if not len(key) or not len(wanted):
                    continue
                key = key[wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key]
                value, count = np.unique(key, return_counts=True)
                yield pa.record_batch({"key": value.view(np.int64), "docs": count})

    clean = {r.key: r.docs for r in training.filter("toxic = 0").select("text")
             .mapInArrow(clean_counts, "key long, docs long")
             .groupBy("key").agg(F.sum("docs").alias("docs")).collect()}
    model = _select(found, clean, share)
    return _calibrate(model, training)


def _gain(toxic: int, clean: int, share: float) -> float:
    """Log likelihood of a word's documents under their own toxic share against the general one."""
    n = toxic + clean
    p = min(max(toxic / n, 1e-9), 1 - 1e-9)
    return n * (p * math.log(p / share) + (1 - p) * math.log((1 - p) / (1 - share)))


def _select(found, clean: dict, share: float) -> Model:
    """Closed beginnings of high precision, none of them below another."""
    good = {}
    for r in found:
        other = clean.get(r.key, 0)
        precision = (r.docs + 0.5) / (r.docs + other + 1)
        if precision >= MIN_PRECISION or (precision >= MIN_EVIDENCE
                                          and _gain(r.docs, other, share) >= MIN_GAIN):
            good[r.term] = r.docs, r.whole, precision
    longest: dict[str, int] = {}
    for term, (docs, _, _) in good.items():
        longest[term[:-1]] = max(longest.get(term[:-1], 0), docs)
    closed = {t: v for t, v in good.items() if longest.get(t, 0) < 0.9 * v[0]}
    chosen = []
    for term in sorted(closed):     # a beginning sorts right before what it begins
        if chosen and term.startswith(chosen[-1]):
            continue
        chosen.append(term)
    chosen.sort(key=lambda t: (-closed[t][0] * closed[t][2], t))
    chosen = chosen[:MAX_TERMS]
    return Model(chosen, [closed[t][1] < 0.9 * closed[t][0] for t in chosen],
                 [closed[t][2] if closed[t][2] >= MIN_PRECISION else min(closed[t][2], EVIDENCE)
                  for t in chosen])


def _calibrate(model: Model, training: DataFrame) -> Model:
    """Spellings that clean documents use, and how far fuzzy and quoted hits can be trusted."""
    if not model.words:
        return model

    def spellings(batches):
        for batch in batches:
            toxic = batch.column(batch.schema.get_field_index("toxic")).to_numpy(False)
            for low, _, data, offsets in tx.text_chunks(batch):
                rows, entry, far, quoted, codes, starts, ends, _ = _chunk_hits(
                    model, data, offsets)
                seen: dict[tuple, None] = {}
                exact = set(rows[far == 0].tolist())
                for r, e, d, q, a, b in zip(rows, entry, far, quoted, starts, ends):
                    word = _string(codes[a:b]) if d else ""
                    seen[(int(r), word, int(e) if d else -1, bool(q), int(toxic[low + r]),
                          int(r) in exact)] = None
                for r in range(len(offsets) - 1):
                    if r not in exact:
                        seen[(r, "", -1, False, int(toxic[low + r]), False)] = None
                if seen:
                    yield pa.record_batch({
                        "word": [k[1] for k in seen],
                        "entry": pa.array([k[2] for k in seen], pa.int32()),
                        "quoted": [k[3] for k in seen],
                        "toxic": pa.array([k[4] for k in seen], pa.int32()),
                        "exact": [k[5] for k in seen]})

    rows = (training.select("toxic", "text")
            .mapInArrow(spellings, "word string, entry int, quoted boolean, toxic int, "
                                   "exact boolean")
            .groupBy("word", "entry", "quoted", "toxic", "exact").count().collect())
    total = lambda test: sum(r["count"] for r in rows if test(r))
    model.known = frozenset(r.word for r in rows if r.word and not r.toxic)
    near: dict[int, set] = {}
    for r in rows:
        if r.word and not r.toxic:
            near.setdefault(r.entry, set()).add(r.word)
    model.strict = frozenset(e for e, found in near.items() if len(found) > MAX_KNOWN)
    fuzzy = [total(lambda r, t=t: r.word and not r.exact and r.toxic == t
                   and r.word not in model.known and r.entry not in model.strict)
             for t in (0, 1)]
    quoted = [total(lambda r, t=t: not r.word and r.exact and r.quoted and r.toxic == t)
              for t in (0, 1)]
    bare = [total(lambda r, t=t: not r.word and not r.exact and r.toxic == t) for t in (0, 1)]
    model.fuzzy = (fuzzy[1] + 3) / (sum(fuzzy) + 4)
    model.quoted = (quoted[1] + 1) / (sum(quoted) + 2)
    model.prior = bare[1] / (sum(bare) + 1)
    return model


def score_rows(model: Model, data: np.ndarray, offsets: np.ndarray):
    """Score and hits of each row: the chance that at least one of its different words counts."""
    n = len(offsets) - 1
    rows, entry, far, quoted, *_, word = _chunk_hits(model, data, offsets)
    # Repeating a word adds nothing; of its hits the least quoted one counts.
    order = np.lexsort((quoted, word, rows))
    keep = np.ones(len(order), bool)
    keep[1:] = (np.diff(rows[order]) != 0) | (np.diff(word[order]) != 0)
    at = order[keep]
    rows, entry, far, quoted = rows[at], entry[at], far[at], quoted[at]
    trust = np.array(model.weights or [0.0])[entry] if len(entry) else np.empty(0)
    trust = trust * np.where(far > 0, model.fuzzy ** np.maximum(far, 1), 1.0)
    trust = trust * np.where(quoted, model.quoted, 1.0)
    miss = np.full(n, math.log1p(-min(model.prior, 0.5)))
    np.add.at(miss, rows, np.log1p(-np.minimum(trust, 0.999999)))
    return -np.expm1(miss), np.bincount(rows, minlength=n), np.bincount(rows, far > 0, n), \
        np.bincount(rows, quoted, n)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_hits, n_misspelled, n_quoted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # bounded by MAX_TERMS

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for low, high, data, offsets in tx.text_chunks(batch):
                score, hits, fuzzy, quoted = score_rows(shared.value, data, offsets)
                yield pa.record_batch({
                    "doc_id": ids.slice(low, high - low), "score": score,
                    "n_hits": hits.astype(np.int64), "n_misspelled": fuzzy.astype(np.int64),
                    "n_quoted": quoted.astype(np.int64)})

    return tx.need(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, score double, n_hits long, n_misspelled long, n_quoted long")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` scored below the threshold, all columns as they came."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            keep = np.concatenate([score_rows(shared.value, data, offsets)[0] < threshold
                                   for _, _, data, offsets in tx.text_chunks(batch)]
                                  or [np.empty(0, bool)])
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
