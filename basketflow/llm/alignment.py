"""Two tokenizers laid over each other: which tokens cover the same bytes, and how often.

Both encodings of a text cut the same bytes. Where both cut, a group ends; between two cuts of
either lies one stretch of bytes that exactly one token of A and one of B share, so the links of a
text are the stretches between the distinct cuts. Inside a task all of that is Arrow on flat
columns: lists of ids are flattened, a parent index says whose they are, cumulative sums of token
lengths (less the sum before the document) give ends, a full outer hash join on (document, end)
brings the cuts together, and ``Table.group_by`` counts.

Counting over the corpus goes by blocks of documents (about ``BLOCK`` bytes of text, or one longer
text). A block sends each of its id pairs once, with the number of its documents that hold it;
Spark adds those up, takes the highest count of every A id, and joins the sums back to the pairs of
the blocks. Documents keep their links as positions in the block's list of pairs, and meet the sums
again block by block. So a pair that stands in a third of all texts is one row a block, and no
task ever holds more than a block.

A is encoded from the vocabulary's ranks, which yields the merges of its own file: every token
builds itself from its bytes, so no state can hold two parts of a token other than those of its own
merge. Texts with long runs of blanks, on which that encoder gives up, take the library's own way.

Defined cases: null and empty texts, and texts whose joined tokens are not exactly space + text
(B replaces or folds some characters), have no tokens: zeros and an empty digest; they hold no pair
and count for nothing. Repeated rows and repeated ids are documents each of its own. Ties for an A
id's highest count are all best. A null id is carried along. Very long texts are a block of their
own. An empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texts as tx

BLOCK = 16 << 20        # bytes of text of a block, about
STEP = 1 << 20          # bytes of text aligned at a time
_BLANKS = re.compile(r"\s{1000}")
_loaded: dict[str, "Pair"] = {}


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids one after the other, and the number of each list."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return (np.concatenate(lists) if lists else np.empty(0)).astype(np.int64), counts


class Pair:
    """Both tokenizers, from the content of their files, and the bytes of their tokens."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        self.file = byte_level
        raw = json.loads(byte_level)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in raw["added_tokens"]}
        ranks = {bytes(letters[c] for c in entry): number
                 for entry, number in raw["model"]["vocab"].items() if entry not in special}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.slow = None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        a_bytes = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for entry, number in ranks.items():
            a_bytes[number] = entry
        b_bytes = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(number)
                           else piece.replace("\u2581", " ").encode())
        self.entries = [pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)]
        self.lengths = [np.array([len(e) for e in x], np.int64) for x in (a_bytes, b_bytes)]
        self.decimals = [pa.array([str(i) for i in range(len(x))], pa.string())
                         for x in (a_bytes, b_bytes)]

    def own_way(self, text: str) -> list[int]:
        """Ids of A by the library that its file is made for."""
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_buffer(self.file)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def encode_a(self, text: str) -> np.ndarray:
        text = " " + text
        return np.array(self.own_way(text) if _BLANKS.search(text)
                        else self.fast.encode_ordinary(text), np.int64)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per tokenizer the ids of all texts and the number of each text's."""
        return [_flat([self.encode_a(t) for t in texts]),
                _flat([np.array(ids, np.int64) for ids in self.b.encode(texts, num_threads=1)])]


def load(files: tuple[bytes, bytes]) -> Pair:
    key = hashlib.sha256(files[0] + files[1]).hexdigest()
    if key not in _loaded:
        _loaded[key] = Pair(*files)
    return _loaded[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _exact(pair: Pair, encoded, texts: list[str]) -> np.ndarray:
    """Texts whose joined token bytes are space + text under both tokenizers."""
    want = [b" " + t.encode() for t in texts]
    good = np.array([t != "" for t in texts], bool)
    for entries, lengths, (ids, counts) in zip(pair.entries, pair.lengths, encoded):
        body = entries.take(pa.array(ids)).buffers()[2]
        body = memoryview(body.to_pybytes() if body is not None else b"")
        ends = np.concatenate([[0], np.cumsum(lengths[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        good &= np.fromiter((body[a:b] == w for a, b, w in
                             zip(ends[:-1].tolist(), ends[1:].tolist(), want)), bool, len(texts))
    return good


def _parents(lists: pa.LargeListArray) -> tuple[pa.Array, np.ndarray]:
    """Flattened values and the list that each belongs to."""
    return lists.flatten(), pc.list_parent_indices(lists).to_numpy().astype(np.int64)


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.LargeListArray:
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(ids))


def _cuts(ids: pa.LargeListArray, lengths: np.ndarray, name: str) -> pa.Table:
    """(document, end) of every token with its id, ends counted from the document's start."""
    flat, of = _parents(ids)
    total = np.cumsum(lengths[flat.to_numpy()])
    before = np.concatenate([[0], total])[ids.offsets.to_numpy()[:-1]]
    return pa.table({"doc": of, "end": total - before[of], name: flat})


def _joined(parts: pa.Array, ends: np.ndarray, between: str) -> pa.Array:
    """Consecutive strings made one, up to each of the ends."""
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), parts), between)


def aligned(pair: Pair, texts: list[str]) -> tuple[pa.Table, pa.Table]:
    """Documents (n_a, n_b, n_groups, n_links, groups_sha256) and links (doc, a, b), in order."""
    encoded = pair.encode(texts)
    good = _exact(pair, encoded, texts)
    lists = []
    for ids, counts in encoded:
        lists.append(_lists(ids[np.repeat(good, counts)], np.where(good, counts, 0)))
    n = len(texts)
    a, b = (_cuts(x, lengths, name) for x, lengths, name in zip(lists, pair.lengths, "ab"))
    cuts = a.join(b, keys=["doc", "end"], join_type="full outer", use_threads=False)
    key = (cuts["doc"].to_numpy() << 32) | cuts["end"].to_numpy()
    cuts = cuts.take(pa.array(np.argsort(key))).combine_chunks()
    both = pc.and_(pc.is_valid(cuts["a"]), pc.is_valid(cuts["b"]))
    joint = cuts.filter(both)
    doc = cuts["doc"].to_numpy()
    # Between two cuts lie the tokens that end at the next cut of their own tokenizer.
    links = pa.table({"doc": cuts["doc"], "a": pc.fill_null_backward(cuts["a"]),
                      "b": pc.fill_null_backward(cuts["b"])})
    joint_doc, joint_end = joint["doc"].to_numpy(), joint["end"].to_numpy()
    n_groups = np.bincount(joint_doc, minlength=n)
    text = []
    for table, decimals, name in zip((a, b), pair.decimals, "ab"):
        # A group's tokens follow one another: it ends where a joint cut stands in the token table.
        key = (table["doc"].to_numpy() << 32) | table["end"].to_numpy()
        bounds = np.searchsorted(key, (joint_doc << 32) | joint_end, "right")
        text.append(_joined(decimals.take(table[name].combine_chunks()), bounds, ","))
    whole = _joined(pc.binary_join_element_wise(*text, "|"), np.cumsum(n_groups), ";")
    digests = [hashlib.sha256(w.encode()).hexdigest() if ok else ""
               for w, ok in zip(whole.to_pylist(), good)]
    documents = pa.table({
        "n_a": pc.list_value_length(lists[0]), "n_b": pc.list_value_length(lists[1]),
        "n_groups": n_groups, "n_links": np.bincount(doc, minlength=n), "groups_sha256": digests})
    return documents, links


def _blocks(shared):
    def run(batches):
        pair = load(shared.value)
        width = len(pair.lengths[1])
        held, size = [], 0
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            texts = batch.column(batch.schema.get_field_index("text"))
            for low, high, data, _ in tx.text_chunks(batch, limit=STEP):
                own = [t or "" for t in texts.slice(low, high - low).to_pylist()]
                documents, links = aligned(pair, own)
                number = pc.add(pc.multiply(links["a"], width), links["b"])
                times = pa.table({"doc": links["doc"], "pair": number}) \
                    .group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
                held.append((ids.slice(low, high - low), documents, times))
                size += len(data)
                if size >= BLOCK:
                    yield from _block(held)
                    held, size = [], 0
        if held:
            yield from _block(held)
    return run


def _block(held: list) -> Iterator[pa.RecordBatch]:
    """A row a document with its links as positions in the block's pairs, and one with those."""
    name = uuid.uuid4().hex
    counts = pa.concat_tables([t.select(["pair"]) for _, _, t in held]) \
        .group_by("pair", use_threads=False).aggregate([([], "count_all")])
    order = np.argsort(counts["pair"].to_numpy())
    pairs = counts["pair"].to_numpy()[order]
    for ids, documents, times in held:
        times = times.take(pa.array(np.argsort(times["doc"].to_numpy(), kind="stable")))
        bounds = np.searchsorted(times["doc"].to_numpy(), np.arange(len(ids) + 1)).astype(np.int32)
        places = np.searchsorted(pairs, times["pair"].to_numpy()).astype(np.int32)
        documents = documents.combine_chunks().to_batches()
        columns = {c: pa.concat_arrays([x.column(c) for x in documents])
                   for c in documents[0].schema.names}
        yield _row(len(ids), block=pa.array([name] * len(ids)), doc_id=ids, **columns,
                   places=pa.ListArray.from_arrays(pa.array(bounds), pa.array(places)),
                   times=pa.ListArray.from_arrays(
                       pa.array(bounds), times["count_all"].combine_chunks().cast(pa.int32())))
    yield _row(1, block=pa.array([name]), pairs=pa.array([pairs], pa.list_(pa.int64())),
               holders=pa.array([counts["count_all"].to_numpy()[order]], pa.list_(pa.int64())))


_KINDS = {"block": pa.string(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
          "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
          "places": pa.list_(pa.int32()), "times": pa.list_(pa.int32()),
          "pairs": pa.list_(pa.int64()), "holders": pa.list_(pa.int64())}
BLOCKS = ("block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
          "groups_sha256 string, places array<int>, times array<int>, pairs array<long>, "
          "holders array<long>")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
          "count_sum long, groups_sha256 string")


def _row(n: int, **given) -> pa.RecordBatch:
    return pa.record_batch({name: given[name].cast(kind) if name in given else pa.nulls(n, kind)
                            for name, kind in _KINDS.items()})


def _summed(docs: pa.Table, sums: pa.Table) -> pa.Table:
    """Documents of one block with what their links count over the corpus."""
    order = np.argsort(sums["place"].to_numpy())
    total, best = sums["total"].to_numpy()[order], sums["best"].to_numpy()[order]
    docs = docs.combine_chunks()
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(docs["places"]).to_numpy())])
    at = pc.list_flatten(docs["places"]).to_numpy()
    times = pc.list_flatten(docs["times"]).to_numpy().astype(np.int64)
    add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])
    return docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]) \
        .append_column("n_best", pa.array(add(times * best[at]), pa.int64())) \
        .append_column("count_sum", pa.array(add(times * total[at]), pa.int64())) \
        .append_column("groups_sha256", docs["groups_sha256"])


def aligned_documents(docs: DataFrame, byte_level: str, pieces: str) -> tuple[DataFrame, DataFrame]:
    """Documents with group and link counts, and the table of id pairs (pair, total, best)."""
    files = (_read(byte_level), _read(pieces))
    width = len(load(files).lengths[1])
    shared = docs.sparkSession.sparkContext.broadcast(files)      # two vocabularies
    blocks = tx.stored(tx.need(docs, "doc_id", "text").mapInArrow(_blocks(shared), BLOCKS), "aligned")
    sent = blocks.filter("pairs IS NOT NULL").select(
        "block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "x")) \
        .select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.holders").alias("holders"))
    totals = sent.groupBy("pair").agg(F.sum("holders").alias("total"))
    # One row an A id: bounded by the vocabulary.
    highest = totals.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("total").alias("top"))
    counted = tx.stored(
        totals.withColumn("a", F.expr(f"pair div {width}")).join(F.broadcast(highest), "a")
        .select("pair", "a", F.expr(f"cast(pair % {width} AS int)").alias("b"), "total",
                (F.col("total") == F.col("top")).cast("int").alias("best")), "pairs")
    answers = sent.select("block", "place", "pair").join(counted, "pair") \
        .select(F.col("block").alias("of"), "place", "total", "best")
    rows = blocks.filter("pairs IS NULL").drop("pairs", "holders")
    found = rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_summed, RESULT)
    return found, counted


def pair_counts(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """The corpus' table of id pairs: a, b, number of documents, and whether it is A's highest."""
    return aligned_documents(docs, byte_level, pieces)[1].select(
        F.col("a").cast("int").alias("a"), "b", "total", (F.col("best") == 1).alias("best"))
