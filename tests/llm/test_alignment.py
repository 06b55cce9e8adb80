import hashlib
import json
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from basketflow.llm import alignment
from basketflow.llm.queries import BYTE_BPE, PIECE_BPE
from llm_helpers import rows_by_id

EMPTY = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def tokens(libraries, text):
    """[(id, bytes)] of both, or nothing where they do not give space + text."""
    a, b = libraries
    letters = alignment._byte_letters()
    left = [(i, bytes(letters[c] for c in a.id_to_token(i)))
            for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([i - 3]) if 3 <= i < 259 else b.id_to_piece(i).replace("▁", " ").encode())
             for i in b.encode(text)]
    want = b" " + text.encode()
    fits = text and all(b"".join(x for _, x in side) == want for side in (left, right))
    return (left, right) if fits else ([], [])


def spans(side):
    ends = list(accumulate(len(x) for _, x in side))
    return [(i, e - len(x), e) for (i, x), e in zip(side, ends)]


def brute(libraries, docs):
    """All overlapping occurrences by comparing byte ranges."""
    seen, pairs = [], Counter()
    for doc, text in docs:
        left, right = map(spans, tokens(libraries, text or ""))
        links = Counter()
        at = 0
        for i, low, high in left:
            while at < len(right) and right[at][2] <= low:
                at += 1
            k = at
            while k < len(right) and right[k][1] < high:
                links[i, right[k][0]] += 1
                k += 1
        joint = sorted({x[2] for x in left} & {x[2] for x in right})
        groups, low = [], 0
        for high in joint:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= high)
                                   for side in (left, right)) if len(joint) < 4000 else None)
            low = high
        seen.append((doc, left, right, groups, links))
        pairs.update(links.keys())
    top = {}
    for (a, _), n in pairs.items():
        top[a] = max(top.get(a, 0), n)
    out = {}
    for doc, left, right, groups, links in seen:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if left else ""
        out.setdefault(doc, []).append(
            (len(left), len(right), len(groups), sum(links.values()),
             sum(n for p, n in links.items() if pairs[p] == top[p[0]]),
             sum(n * pairs[p] for p, n in links.items()), sha))
    return out, pairs


def columns(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


def compare(libraries, docs):
    want, pairs = brute(libraries, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    found, _ = alignment.aligned_documents(docs, BYTE_BPE, PIECE_BPE)
    got = {k: [columns(r) for r in v] for k, v in rows_by_id(found).items()}
    assert got == want
    counted = {(r.a, r.b): r.total
               for r in alignment.pair_counts(docs, BYTE_BPE, PIECE_BPE).collect()}
    assert counted == dict(pairs)
    return got


def test_short_documents(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars < 2500")
    compare(libraries, docs)


def test_many_small_blocks_give_the_same(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 2000)
    monkeypatch.setattr(alignment, "STEP", 500)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars < 600")
    compare(libraries, docs)


def test_hand_made_rows(make, libraries):
    docs = make((1, "Hello wörld 123"), (2, "Hello wörld 123"), (3, None), (4, ""), (5, "日本語 \x00 🎉"),
                (6, "<|endoftext|> <s> x"), (7, "two  blanks\n\nlines "), (7, "repeated id"),
                (8, "a" * 300), (9, " " * 1200 + "x"), (10, "the" + " the" * 50), (11, "a▁b"))
    got = compare(libraries, docs)
    assert got[3] == got[4] == [EMPTY]
    assert got[1] == got[2] and len(got[7]) == 2 and got[9][0][0] > 0
    assert got[6] == [EMPTY] or got[6][0][0] > 0


def test_odd_rows(odd, nothing, libraries):
    got = rows_by_id(alignment.aligned_documents(odd.filter("doc_id IS NULL OR doc_id <> 4"),
                                                 BYTE_BPE, PIECE_BPE)[0])
    assert columns(got[1][0]) == EMPTY and len(got[5]) == 2 and got[None][0].n_a > 0
    assert alignment.aligned_documents(nothing, BYTE_BPE, PIECE_BPE)[0].count() == 0
    long = alignment.aligned_documents(odd.filter("doc_id = 4"), BYTE_BPE, PIECE_BPE)[0].first()
    assert long.n_links == long.n_a + long.n_b - long.n_groups


def test_every_token_builds_itself():
    """Why ranks and merges come to the same: no token can arise from other parts than its own."""
    with open(BYTE_BPE, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
    assert all(model["vocab"]["".join(m)] == 256 + i for m, i in merges.items())
    for entry in model["vocab"]:
        if entry == "<|endoftext|>":
            continue
        parts = list(entry)
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: merges.get((parts[i], parts[i + 1]), 1 << 30))
            assert (parts[at], parts[at + 1]) in merges
            parts[at:at + 2] = [parts[at] + parts[at + 1]]


@pytest.mark.parametrize("start", [0x20, 0x2B0, 0x1680, 0x2000, 0x3000, 0xE000, 0x1F300, 0xE0000])
def test_both_ways_to_encode_agree(start):
    pair = alignment.load((alignment._read(BYTE_BPE), alignment._read(PIECE_BPE)))
    for c in map(chr, range(start, start + 400)):
        text = f" a{c}b 1{c}2 !{c}? {c}  {c} x"
        assert pair.own_way(text) == pair.fast.encode_ordinary(text)


def test_files_are_where_the_parameter_says():
    assert BYTE_BPE == public_tokenizers.path("byte_bpe_50k.json")
