"""Repeated passages: later documents are aligned with the first holder of their rare lines.

Anchors are line hashes that are rare by content: lines of ``MIN_WORDS`` words or more, and pairs
of neighbouring lines. Each anchor has a first holder, the earliest document with it, and every later document
with the anchor is compared with that holder only: at most one partner per anchor, however
many documents share it, so a line in a third of all documents costs one pair each. Partners are
aligned by patience diff (lines unique on both sides, longest increasing run, grown through equal
neighbours). Aligned blocks of ``MIN_WORDS`` words or more are deleted from the later document; the
first holder of a line never loses it. Where shared lines stay unaligned (passages that stand twice, or in
another order), a suffix automaton of the holder's lines finds every run of lines that it holds
anywhere, and those are deleted by the same measure.

The alignment works on line hashes; texts are touched only by the final deletion. Documents are
ordered by (doc_id, hash of the text).

Defined cases: a null or empty text and a null doc_id pass unchanged and lend no lines; rows equal
in doc_id and text are one document and are edited alike; lines without words neither count
nor break a block; what is left keeps its line breaks, and a text that is deleted
whole becomes empty. Extra columns are kept by ``deduplicated``.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx

MIN_WORDS = 25     # words of the shortest block that is deleted, and of a line that is an anchor


def line_hashes(data: np.ndarray, offsets: np.ndarray):
    """Per row: hashes and word counts of its lines, in order; blank lines have 0 words."""
    sums = tx.prefix_hash(data)
    breaks = np.flatnonzero(data == 10)
    starts, _, _ = tx.words(data, offsets)
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        inner = breaks[np.searchsorted(breaks, a):np.searchsorted(breaks, b)]
        low = np.concatenate([[a], inner + 1])
        high = np.concatenate([inner, [b]])
        count = np.searchsorted(starts, high) - np.searchsorted(starts, low)
        yield tx.span_hash(sums, low, high), count


def anchors(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Distinct anchors of a text: long lines, and neighbouring lines that both have words."""
    full = np.flatnonzero(count)
    h, n = hashes[full], count[full]
    return np.unique(np.concatenate([h[n >= MIN_WORDS], tx.window_hash(h, 2)]))


def patience(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Aligned positions (in a, in b) of equal lines, ascending in both.

    Without a line unique on both sides the equal head and tail still align.
    """
    def unique(x):
        value, first, n = np.unique(x, return_index=True, return_counts=True)
        return dict(zip(value[n == 1].tolist(), first[n == 1].tolist()))

    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        al, ah, bl, bh = todo.pop()
        while al < ah and bl < bh and a[al] == b[bl]:
            out.append((al, bl))
            al, bl = al + 1, bl + 1
        while al < ah and bl < bh and a[ah - 1] == b[bh - 1]:
            ah, bh = ah - 1, bh - 1
            out.append((ah, bh))
        if al == ah or bl == bh:
            continue
        here, there = unique(a[al:ah]), unique(b[bl:bh])
        common = sorted((i, there[h]) for h, i in here.items() if h in there)
        run = _increasing([j for _, j in common])
        last_a, last_b = al, bl
        for k in run:
            i, j = al + common[k][0], bl + common[k][1]
            if i > last_a and j > last_b:
                todo.append((last_a, i, last_b, j))
            out.append((i, j))
            last_a, last_b = i + 1, j + 1
        if run and last_a < ah and last_b < bh:
            todo.append((last_a, ah, last_b, bh))
    return sorted(out)


def _increasing(values: list[int]) -> list[int]:
    """Positions of a longest increasing run (patience piles)."""
    tops: list[int] = []
    pile: list[int] = []
    before = [-1] * len(values)
    for k, v in enumerate(values):
        p = bisect_left(tops, v)
        if p:
            before[k] = pile[p - 1]
        if p == len(tops):
            tops.append(v)
            pile.append(k)
        else:
            tops[p], pile[p] = v, k
    out = []
    k = pile[-1] if pile else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def repeated_lines(own: np.ndarray, count: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Positions in ``own`` that lie in long enough blocks that stand in ``other``.

    Both arrays leave out lines without words.
    """
    pairs = patience(own, other)
    drop: list[int] = []
    block: list[int] = []
    for k, (i, j) in enumerate(pairs):
        if block and (i, j) != (pairs[k - 1][0] + 1, pairs[k - 1][1] + 1):
            if count[block].sum() >= MIN_WORDS:
                drop += block
            block = []
        block.append(i)
    if block and count[block].sum() >= MIN_WORDS:
        drop += block
    gone = np.zeros(len(own), bool)
    gone[drop] = True
    if _left_over(own, count, other, gone):
        gone |= _held(own, count, other)
    return np.flatnonzero(gone)


def _left_over(own: np.ndarray, count: np.ndarray, other: np.ndarray, gone: np.ndarray) -> bool:
    """Whether a run of lines that ``other`` has too is long enough and not all gone."""
    shared = np.concatenate([[False], np.isin(own, other), [False]])
    low = np.flatnonzero(shared[1:] & ~shared[:-1])
    high = np.flatnonzero(~shared[1:] & shared[:-1])
    words = np.concatenate([[0], np.cumsum(count)])
    kept = np.concatenate([[0], np.cumsum(~gone)])
    return bool(((words[high] - words[low] >= MIN_WORDS) & (kept[high] > kept[low])).any())


def _held(own: np.ndarray, count: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Marks the lines in every long enough run of ``own`` that stands anywhere in ``other``.

    For each end, a suffix automaton of ``other`` gives the longest run. Runs of lines that ``own`` does
    not have count as one line that matches nothing.
    """
    shared = np.isin(other, own)
    body = other[shared | np.concatenate([[True], shared[:-1]])].tolist()
    steps: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for line in body:
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and line not in steps[at]:
            steps[at][line] = new
            at = link[at]
        if at >= 0:
            to = steps[at][line]
            if length[to] > length[at] + 1:
                copy = len(steps)
                steps.append(dict(steps[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and steps[at].get(line) == to:
                    steps[at][line] = copy
                    at = link[at]
                link[to] = to = copy
            link[new] = to
        last = new
    words = np.concatenate([[0], np.cumsum(count)]).tolist()
    edge = np.zeros(len(own) + 1, np.int64)
    at = run = 0
    for end, line in enumerate(own.tolist(), 1):
        while at and line not in steps[at]:
            at = link[at]
            run = length[at]
        if line in steps[at]:
            at, run = steps[at][line], run + 1
        if words[end] - words[end - run] >= MIN_WORDS:
            edge[end - run] += 1
            edge[end] -= 1
    return np.cumsum(edge[:-1]) > 0


_KEY = "doc_id long, mark long"


def _lines(batches):
    """Documents as line hashes, with their anchors."""
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for low, high, data, offsets in tx.text_chunks(batch):
            rows = list(line_hashes(data, offsets))
            full = [(h[n > 0], n[n > 0]) for h, n in rows]
            yield pa.record_batch({
                "doc_id": ids.slice(low, high - low),
                "mark": pa.array([_mark(h) for h, _ in rows], pa.int64()),
                "lines": pa.array([h.tobytes() for h, _ in full], pa.binary()),
                "words": pa.array([n.astype(np.int64).tobytes() for _, n in full], pa.binary()),
                "anchors": pa.array([anchors(h, n).view(np.int64) for h, n in rows],
                                    pa.list_(pa.int64()))})


def _mark(hashes: np.ndarray) -> int:
    """Hash of a whole text by its lines."""
    return int(tx.window_hash(hashes, len(hashes)).view(np.int64)[0])


def _align(batches):
    """Later document with the lines of its partners -> positions to delete."""
    for batch in batches:
        ids, marks, found, cut, partners = [], [], [], [], []
        for row in batch.to_pylist():
            own = np.frombuffer(row["lines"], np.uint64)
            count = np.frombuffer(row["words"], np.int64)
            drop: set[int] = set()
            used: set[int] = set()
            for partner in row["partners"]:
                at = repeated_lines(own, count, np.frombuffer(partner["lines"], np.uint64))
                if len(at):
                    used.add(partner["doc_id"])
                    drop.update(at.tolist())
            if drop:
                at = sorted(drop)
                ids.append(row["doc_id"])
                marks.append(row["mark"])
                found.append(at)
                cut.append(int(count[at].sum()))
                partners.append(sorted(used))
        yield pa.record_batch({
            "doc_id": pa.array(ids, pa.int64()), "mark": pa.array(marks, pa.int64()),
            "deleted": pa.array(found, pa.list_(pa.int64())),
            "deleted_words": pa.array(cut, pa.int64()),
            "partners": pa.array(partners, pa.list_(pa.int64()))})


def edits(docs: DataFrame) -> DataFrame:
    """(doc_id, mark) of every document that loses lines, with their numbers (among lines that
    have words), the words they hold and the documents that keep them."""
    lines = tx.stored(
        tx.need(docs, "doc_id", "text").filter("doc_id IS NOT NULL AND text <> ''")
        .mapInArrow(_lines, f"{_KEY}, lines binary, words binary, anchors array<bigint>"),
        "lines")
    holders = lines.select(F.explode("anchors").alias("anchor"),
                           F.struct("doc_id", "mark").alias("doc"))
    first = tx.stored(holders.groupBy("anchor").agg(F.min("doc").alias("first"),
                                                    F.max("doc").alias("last"))
                      .filter("first <> last").select("anchor", "first"), "holders")
    pairs = (holders.join(first, "anchor").filter("doc <> first")
             .select("doc", "first").distinct())
    body = lines.dropDuplicates(["doc_id", "mark"])
    held = body.select(F.struct("doc_id", "mark").alias("first"), F.col("lines").alias("held"))
    # One row per pair carries 8 bytes a line of the first holder, not its text.
    wanted = tx.stored(pairs, "line-pairs")
    partner = wanted.join(held, "first").select(
        "doc", F.struct(F.col("first.doc_id").alias("doc_id"), F.col("held").alias("lines"))
        .alias("partner"))
    gathered = partner.groupBy("doc").agg(F.collect_list("partner").alias("partners"))
    later = body.select(F.struct("doc_id", "mark").alias("doc"), "doc_id", "mark", "lines", "words")
    return tx.stored(
        later.join(gathered, "doc").select("doc_id", "mark", "lines", "words", "partners")
        .mapInArrow(_align, f"{_KEY}, deleted array<bigint>, deleted_words long, "
                            "partners array<bigint>"), "line-edits")


def _marks(batches):
    for batch in batches:
        parts = [np.array([_mark(h) for h, _ in line_hashes(data, offsets)], np.int64)
                 for _, _, data, offsets in tx.text_chunks(batch)]
        yield batch.append_column("_mark", pa.array(
            np.concatenate(parts) if parts else np.empty(0, np.int64)))


def _without(text: str, deleted: list[int]) -> str:
    gone, at, out = set(deleted), 0, []
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            if at not in gone:
                out.append(line)
            at += 1
        else:
            out.append(line)
    return "\n".join(out) if any(x.strip(" \t\n\r\x0b\x0c") for x in out) else ""


def _delete(batches):
    for batch in batches:
        index = batch.schema.get_field_index("text")
        texts = batch.column(index).to_pylist()
        deleted = batch.column(batch.schema.get_field_index("deleted")).to_pylist()
        new = [t if not d else _without(t, d) for t, d in zip(texts, deleted)]
        yield batch.set_column(index, "text", pa.array(new, batch.schema.field(index).type))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages deleted, plus deleted, deleted_words and partners."""
    found = edits(docs)
    columns = docs.columns
    marked = docs.mapInArrow(_marks, _with(docs.schema, "_mark long"))
    joined = marked.join(
        found.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark2"), "deleted",
                     "deleted_words", "partners").hint("merge"),
        (F.col("doc_id") == F.col("_id")) & (F.col("_mark") == F.col("_mark2")), "left") \
        .select(*columns, "deleted", "deleted_words", "partners")
    return joined.mapInArrow(_delete, joined.schema)


def _with(schema, extra: str):
    from pyspark.sql.types import StructType
    return StructType(schema.fields + StructType.fromDDL(extra).fields)
