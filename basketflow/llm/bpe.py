"""BPE encoding and decoding for vocabularies with word ends: speculate, verify, repair.

Every distinct word of a batch is first cut greedily into the longest vocabulary entries. The cut
is the true encoding exactly when every entry encodes to itself and every adjacent pair is
compatible, that is, no merge across their border would have come first. All adjacent pairs of all
new words are tested together in numpy; only words with a failing pair are merged rule by rule.
Known words are kept in a bounded cache of the worker.

Decoding joins the entries' strings with spaces, which is what a tokenizer file without a decoder
prescribes. Defined cases: a null or empty text has no tokens and decodes to the empty text; the
special strings inside a text become their special ids; repeated rows encode alike.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from . import texts as tx

CACHE_WORDS = 1_000_000    # runs per worker; a full cache is emptied, results do not change
_SHIFT = 1 << 20
_NEVER = np.int64(1 << 60)


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free code."""
    printable = set(chain(range(33, 127), range(161, 173), range(174, 256)))
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class PairTable:
    """Merge rules as an open hash table for arrays of pairs."""

    def __init__(self, rules: dict[tuple[int, int], tuple[int, int]]):
        bits = max(4, (4 * len(rules)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, _NEVER, np.int64)
        self.made = np.full(1 << bits, -1, np.int64)
        key = np.array([x * _SHIFT + y for x, y in rules], np.int64)
        value = np.array(list(rules.values()), np.int64).reshape(-1, 2)
        slot = tx.mix(key.astype(np.uint64)) & self.mask
        self.probes = 0
        while len(key):
            self.probes += 1
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[free]          # of several the last one stays
            placed = self.keys[slot] == key
            at = slot[placed]
            self.rank[at], self.made[at] = value[placed, 0], value[placed, 1]
            key, value = key[~placed], value[~placed]
            slot = (slot[~placed] + np.uint64(1)) & self.mask

    def get(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (a huge number without rule) and id of the merged entry."""
        key = left * _SHIFT + right
        slot = tx.mix(key.astype(np.uint64)) & self.mask
        found = self.keys[slot] == key
        rank = np.where(found, self.rank[slot], _NEVER)
        made = np.where(found, self.made[slot], -1)
        open_ = np.flatnonzero(~found.ravel() & (self.keys[slot].ravel() >= 0))
        flat_key, flat_slot = key.ravel(), slot.ravel()
        for step in range(1, self.probes):
            if not len(open_):
                break
            at = (flat_slot[open_] + np.uint64(step)) & self.mask
            hit = self.keys[at] == flat_key[open_]
            rank.ravel()[open_[hit]] = self.rank[at[hit]]
            made.ravel()[open_[hit]] = self.made[at[hit]]
            open_ = open_[~hit & (self.keys[at] >= 0)]
        return rank, made


class ByteTrie:
    """Vocabulary entries by bytes: entries inside a word, and entries that end one."""

    def __init__(self, ids: dict[str, int], suffix: str):
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        children: dict[tuple[int, int], tuple[int, int]] = {}
        inner, final = [-1], [-1]
        for text, i in ids.items():
            end = bool(suffix) and text.endswith(suffix) and len(text) > len(suffix)
            node = 0
            for c in text[:-len(suffix)] if end else text:
                if c not in byte:
                    break
                key = node, byte[c]
                if key not in children:
                    children[key] = len(children), len(inner)
                    inner.append(-1)
                    final.append(-1)
                node = children[key][1]
            else:
                (final if end or not suffix else inner)[node] = i
                if not suffix:
                    inner[node] = i
        self.step = PairTable(children)
        self.inner, self.final = np.array(inner), np.array(final)

    def longest(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Greedy longest entries of many words: (word, id) in order; -1 where nothing fits."""
        word = np.arange(len(starts))
        at, scan = starts.copy(), starts.copy()
        node = np.zeros(len(word), np.int64)
        best, stop = np.full(len(word), -1), starts + 1
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(word):
            inside = scan < ends
            _, child = self.step.get(node, np.where(
                inside, data[np.minimum(scan, len(data) - 1)], 0).astype(np.int64))
            child = np.where(inside, child, -1)
            node = np.maximum(child, 0)
            scan = scan + 1
            entry = np.where(scan == ends, self.final[node], self.inner[node])
            better = (child >= 0) & (entry >= 0)
            best, stop = np.where(better, entry, best), np.where(better, scan, stop)
            done = child < 0
            if done.any():
                out.append((word[done], at[done], best[done]))
                at = np.where(done, stop, at)
                scan = np.where(done, at, scan)
                node = np.where(done, 0, node)
                best, stop = np.where(done, -1, best), np.where(done, at + 1, stop)
                go = at < ends
                word, at, scan, node, best, stop, ends = (
                    x[go] for x in (word, at, scan, node, best, stop, ends))
        words, places, entries = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(places, kind="stable")
        return words[order], entries[order]


class Vocabulary:
    """Tables of one tokenizer file; picklable, bounded by the vocabulary."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                     if p["type"] == "Split")
        self.pattern = split
        size = max(chain(self.ids.values(), self.special.values())) + 1
        self.strings: list[str] = [""] * size
        for text, i in chain(self.ids.items(), self.special.items()):
            self.strings[i] = text
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        ordered = True
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m
                                      for m in model["merges"]):
            x, y, made = self.ids[a], self.ids[b], self.ids[a + b]
            self.rules[x, y] = rank, made
            ordered &= self.rank[made] < 0 and max(self.rank[x], self.rank[y]) < rank
            self.rank[made], self.left[made], self.right[made] = rank, x, y
        self.table = PairTable(self.rules)
        self.trie = ByteTrie(self.ids, self.suffix)
        self.inner = np.array([self.ids.get(c, -1) for c in byte_alphabet()], np.int64)
        self.final = np.array([self.ids.get(c + self.suffix, -1) for c in byte_alphabet()], np.int64)
        # Entries that encode to themselves. Files whose merges are out of order get none, so
        # that every word of more than one entry is merged exactly.
        self.own = np.zeros(size, bool)
        if ordered:
            for text, i in self.ids.items():
                self.own[i] = self.rank[i] < 0 or self.merge(self._atoms(text)) == [i]

    def _atoms(self, text: str) -> list[int]:
        """Single characters, the last one with the word end if the text carries it."""
        end = self.suffix and text.endswith(self.suffix) and len(text) > len(self.suffix)
        chars = list(text[:-len(self.suffix)] if end else text)
        if end:
            chars[-1] += self.suffix
        return [self.ids[c] for c in chars]

    def merge(self, parts: list[int]) -> list[int]:
        """Apply the merge rules exactly: lowest rank first, leftmost among equals."""
        n = len(parts)
        token, after, before = list(parts), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rules[p][0], i, p) for i, p in enumerate(zip(parts, parts[1:]))
                if p in self.rules]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if token[i] < 0 or j >= n or (token[i], token[j]) != pair:
                continue
            token[i], token[j] = self.rules[pair][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (token[a], token[b]) in self.rules:
                    heapq.heappush(heap, (self.rules[token[a], token[b]][0], a,
                                          (token[a], token[b])))
        return [t for t in token if t >= 0]

    def merge_many(self, tokens: np.ndarray) -> np.ndarray:
        """The same for many short words at once: rows of ids, filled up with -1.

        Every round applies the best rule of each row that still has one.
        """
        tokens = tokens.copy()
        rank, made = self.table.get(tokens[:, :-1], tokens[:, 1:])
        column = np.arange(tokens.shape[1])
        rows = np.arange(len(tokens))
        while len(rows):
            at = rank.argmin(axis=1)
            line = np.arange(len(rows))
            go = rank[line, at] < _NEVER
            rows, at, rank, made = rows[go], at[go], rank[go], made[go]
            if not len(rows):
                break
            line = line[:len(rows)]
            own = tokens[rows]
            own[line, at] = made[line, at]
            shift = np.minimum(column + (column > at[:, None]), len(column) - 1)
            own = np.take_along_axis(own, shift, 1)
            own[:, -1] = -1
            tokens[rows] = own
            shift = np.minimum(column[:-1] + (column[:-1] > at[:, None]), len(column) - 2)
            rank, made = np.take_along_axis(rank, shift, 1), np.take_along_axis(made, shift, 1)
            rank[:, -1] = _NEVER
            for k in (at - 1, at):
                k = np.clip(k, 0, len(column) - 2)
                rank[line, k], made[line, k] = self.table.get(own[line, k], own[line, k + 1])
        return tokens

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two entries may stand side by side, for arrays of pairs.

        Both entries are taken apart along their border, latest merge first. A rule joining the
        two border pieces wins if it comes before the merge that swallowed either piece; at equal
        rank the merge further left wins.
        """
        ok = np.ones(len(left), bool)
        todo = np.arange(len(left))
        u, v = left.copy(), right.copy()
        above_u, above_v = np.full(len(u), _NEVER), np.full(len(v), _NEVER)
        while len(todo):
            rank, _ = self.table.get(u, v)
            clash = (rank < above_u) & (rank <= above_v) & (rank < _NEVER)
            ok[todo[clash]] = False
            take_left = self.rank[u] > self.rank[v]
            go = ~clash & ((self.rank[u] >= 0) | (self.rank[v] >= 0))
            todo, u, v, take_left = todo[go], u[go], v[go], take_left[go]
            above_u = np.where(take_left, self.rank[u], above_u[go])
            above_v = np.where(take_left, above_v[go], self.rank[v])
            u, v = np.where(take_left, self.right[u], u), np.where(take_left, v, self.left[v])
        return ok


class Store:
    """Encoded runs by hash: flat ids and decoded bytes in arrays, no object per run."""

    def __init__(self, room: int):
        bits = (2 * room).bit_length()
        self.room, self.mask = room, np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.index = np.full(1 << bits, -1, np.int64)
        self.count = 0
        self.ids, self.id_bounds = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.text, self.text_bounds = np.empty(0, np.uint8), np.zeros(1, np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 if unknown."""
        out = np.full(len(keys), -1)
        slot, todo = keys & self.mask, np.arange(len(keys))
        while len(todo):
            at = self.index[slot]
            hit = (at >= 0) & (self.keys[slot] == keys[todo])
            out[todo[hit]] = at[hit]
            go = (at >= 0) & ~hit
            todo, slot = todo[go], (slot[go] + np.uint64(1)) & self.mask
        return out

    def add(self, keys: np.ndarray, ids: list[bytes], text: list[bytes]) -> None:
        number = np.arange(self.count, self.count + len(keys))
        slot = keys & self.mask
        while len(keys):
            free = self.index[slot] < 0
            self.keys[slot[free]], self.index[slot[free]] = keys[free], number[free]
            go = self.index[slot] != number
            keys, number, slot = keys[go], number[go], (slot[go] + np.uint64(1)) & self.mask
        self.count += len(ids)
        sizes = np.array([len(x) for x in ids], np.int64) // 4
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
        self.id_bounds = np.append(self.id_bounds, self.id_bounds[-1] + np.cumsum(sizes))
        sizes = np.array([len(x) for x in text], np.int64)
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(text), np.uint8)])
        self.text_bounds = np.append(self.text_bounds, self.text_bounds[-1] + np.cumsum(sizes))


def _gather(flat: np.ndarray, bounds: np.ndarray, which: np.ndarray, first: np.ndarray):
    """The pieces ``which`` of a flat array one after the other, and the rows' bounds in them."""
    start, size = bounds[which], bounds[which + 1] - bounds[which]
    ends = np.zeros(len(which) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    at = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
    return flat[at], ends[first]


class Encoder:
    """Encodes texts with one vocabulary; holds the worker's cache."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pieces = regex.compile(vocabulary.pattern)
        self.specials = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True)) + ")") \
            if vocabulary.special else None
        self.store = Store(CACHE_WORDS)
        self.exact = 0

    def encode_words(self, new: list[str]) -> dict[str, tuple[bytes, str]]:
        """Ids and decoded string of distinct words."""
        if not new:
            return {}
        v = self.v
        raw = [w.encode() for w in new]
        size = np.array([len(r) for r in raw])
        bounds = np.concatenate([[0], np.cumsum(size)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        owner, ids = v.trie.longest(data, bounds[:-1], bounds[1:])
        bad = np.zeros(len(new), bool)
        bad[owner[(ids < 0) | ~v.own[ids]]] = True
        border = np.flatnonzero((owner[:-1] == owner[1:]) & ~bad[owner[1:]])
        if len(border):
            pairs, back = np.unique(ids[border] * _SHIFT + ids[border + 1], return_inverse=True)
            fits = v.compatible(pairs // _SHIFT, pairs % _SHIFT)
            bad[owner[border[~fits[back]]]] = True
        keep = ~bad[owner]
        owners, entries = [owner[keep]], [ids[keep]]
        self.exact += int(bad.sum())
        atoms = v.inner[data]
        last = bounds[1:] - 1
        atoms[last] = v.final[data[last]]
        low = 0
        for width in (8, 16, 32, 64):
            some = np.flatnonzero(bad & (size > low) & (size <= width))
            low = width
            for part in np.array_split(some, len(some) // 20_000 + 1):
                if not len(part):
                    continue
                step = np.arange(width)
                at = np.minimum(bounds[part][:, None] + step, len(data) - 1)
                made = v.merge_many(np.where(step < size[part][:, None], atoms[at], -1))
                full = made >= 0
                owners.append(np.repeat(part, full.sum(axis=1)))
                entries.append(made[full])
        for k in np.flatnonzero(bad & (size > 64)):
            made = v.merge(atoms[bounds[k]:bounds[k + 1]].tolist())
            owners.append(np.full(len(made), k))
            entries.append(np.array(made))
        owner, ids = np.concatenate(owners), np.concatenate(entries)
        order = np.argsort(owner, kind="stable")
        flat = ids[order].astype("<u4").tobytes()
        strings = [v.strings[i] for i in ids[order]]
        cuts = np.searchsorted(owner[order], np.arange(len(new) + 1)).tolist()
        return {word: (flat[4 * a:4 * b], " ".join(strings[a:b]))
                for word, a, b in zip(new, cuts, cuts[1:])}

    def normal(self, text: str) -> str:
        """Composed and lower-cased character by character. White space only separates words."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def split(self, run: str) -> list[str]:
        """Words of a run without ASCII blanks; special strings stay whole."""
        if self.specials is not None and "<|" in run and self.specials.search(run):
            out: list[str] = []
            for part in self.specials.split(run):
                out.extend([part] if part in self.v.special
                           else self.pieces.findall(self.normal(part)))
            return out
        word = self.normal(run)
        return [word] if word.isalpha() else self.pieces.findall(word)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Flat ids and decoded bytes of a chunk with the rows' bounds in both.

        No word crosses a blank, so runs between blanks are encoded once and then copied. Every
        decoded run carries a space at its end, which a row's last one gives back.
        """
        starts, ends, first = tx.words(data, offsets)
        keys, sample, back = np.unique(tx.span_hash(tx.prefix_hash(data), starts, ends),
                                       return_index=True, return_inverse=True)
        if self.store.count + len(keys) > self.store.room:
            self.store = Store(max(CACHE_WORDS, 2 * len(keys)))
        number = self.store.find(keys)
        new = np.flatnonzero(number < 0)
        if len(new):
            raw = data.tobytes()
            runs = [self.split(raw[a:b].decode()) for a, b in
                    zip(starts[sample[new]].tolist(), ends[sample[new]].tolist())]
            words = self.encode_words(sorted(
                {w for run in runs for w in run} - self.v.special.keys()))
            for text, i in self.v.special.items():
                words[text] = np.array([i], "<u4").tobytes(), text
            known = [[words[w] for w in run] for run in runs]
            self.store.add(keys[new], [b"".join([k[0] for k in run]) for run in known],
                           ["".join([k[1] + " " for k in run]).encode() for run in known])
            number = self.store.find(keys)
        which = number[back]
        ids, id_bounds = _gather(self.store.ids, self.store.id_bounds, which, first)
        text, text_bounds = _gather(self.store.text, self.store.text_bounds, which, first)
        return ids, id_bounds, text, text_bounds

    def encode_text(self, text: str) -> tuple[list[int], str]:
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _, decoded, _ = self.encode(data, np.array([0, len(data)]))
        return ids.tolist(), decoded.tobytes().decode()[:-1]

    def decode(self, ids: bytes) -> str:
        return " ".join([self.v.strings[i] for i in np.frombuffer(ids, "<u4")])


def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        return Vocabulary(json.load(f))


_encoders: dict[str, Encoder] = {}


def _encoder(name: str, vocabulary: Vocabulary) -> Encoder:
    if name not in _encoders:
        _encoders[name] = Encoder(vocabulary)
    return _encoders[name]


def _apply(spark: SparkSession, path: str, fields, docs: DataFrame, schema: str) -> DataFrame:
    shared = spark.sparkContext.broadcast(load(path))     # bounded by the vocabulary

    def run(batches):
        encoder = _encoder(path, shared.value)
        for batch in batches:
            doc_ids = batch.column(batch.schema.get_field_index("doc_id"))
            for low, high, data, offsets in tx.text_chunks(batch):
                yield pa.record_batch({"doc_id": doc_ids.slice(low, high - low),
                                       **fields(*encoder.encode(data, offsets))})

    return tx.need(docs, "doc_id", "text").mapInArrow(run, schema)


def _rows(flat: np.ndarray, bounds: np.ndarray, width: int, cut: int = 0) -> list[bytes]:
    raw = memoryview(flat.tobytes())
    return [raw[width * a:max(width * a, width * b - cut)]
            for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded of every row."""
    def fields(ids, id_bounds, text, text_bounds):
        return {"ids": pa.ListArray.from_arrays(id_bounds.astype(np.int32), ids.astype(np.int32)),
                "decoded": [bytes(r).decode() for r in _rows(text, text_bounds, 1, 1)]}

    return _apply(docs.sparkSession, path, fields, docs,
                  "doc_id long, ids array<int>, decoded string")


def digested(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text, without moving either."""
    def fields(ids, id_bounds, text, text_bounds):
        return {"n_tokens": np.diff(id_bounds),
                "ids_sha256": [hashlib.sha256(r).hexdigest() for r in _rows(ids, id_bounds, 4)],
                "decoded_sha256": [hashlib.sha256(r).hexdigest()
                                   for r in _rows(text, text_bounds, 1, 1)]}

    return _apply(docs.sparkSession, path, fields, docs,
                  "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
