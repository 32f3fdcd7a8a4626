"""Token counts, byte-level BPE and repeated windows against plain versions."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from contraluz.llm import byte_bpe, repeated_windows, token_counts
from tests.llm.helpers import CLASHING, ODD_ROWS, frame, prose

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_and_decoding(spark, ranks, plain):
    codec = byte_bpe.Codec(ranks, PATTERN)
    df = frame(spark, ODD_ROWS, **CLASHING)
    rows = byte_bpe.decode(byte_bpe.encode(df, "text", codec), "ids", codec).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        assert r["ids"] == plain.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode() and r["score"] == "mine"
    empty = byte_bpe.encode(df.where("doc_id > 99"), "text", codec)
    assert empty.count() == 0 and "ids" in empty.columns


def test_merges_of_odd_pieces(ranks, plain):
    codec, rnd = byte_bpe.Codec(ranks, PATTERN), random.Random(4)
    pieces = ["".join(rnd.choice("aabcdeé!?日") for _ in range(n)).encode()
              for n in (1, 2, 3, 5, 9, 17, 33, 65, 200, 256, 257, 900) for _ in range(6)]
    for piece, ids in zip(pieces, codec.encode_pieces(pieces)):
        assert ids.tolist() == plain._encode_single_piece(piece)
        assert codec.decode(ids.tolist()) == piece


def test_pair_table_holds_exactly_the_vocabulary_pairs():
    ranks = {b"a": 0, b"b": 1, b"ab": 2, b"aab": 3, b"aa": 4}
    found = byte_bpe.PairTable(ranks).find(np.array([0, 0, 0, 1, -1]), np.array([0, 1, 2, 1, 0]))
    assert found.tolist() == [4, 2, 3, byte_bpe.NONE, byte_bpe.NONE]


def test_edits_change_counts_as_counting_again_does(ranks, plain):
    rnd, counter = random.Random(9), token_counts.Counter(ranks, PATTERN)
    letters = " \n\t'srelld12.!a é日　x  "
    for _ in range(250):
        text = "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 3, 30, 2000])))
        tree = token_counts.SegmentTree(*token_counts.cut(text, counter))
        for _ in range(5):
            start, removed = rnd.randint(0, len(text) + 2), rnd.choice([0, 0, 1, 5, 400])
            new = "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 4, 900])))
            expected = text[:start] + new + text[start + removed:]
            text, _ = token_counts.edit(text, tree, counter, start, removed, new)
            assert text == expected and tree.total == len(plain.encode_ordinary(text))


def test_edits_encode_only_what_they_touch(ranks):
    counter = token_counts.Counter(ranks, PATTERN)
    text = prose(1, 20000)
    tree = token_counts.SegmentTree(*token_counts.cut(text, counter))
    _, again = token_counts.edit(text, tree, counter, 50000, 3, "new")
    assert again < 10


def test_edit_tables(spark, ranks, plain):
    df = frame(spark, ODD_ROWS, **CLASHING)
    edits = frame(spark, [(4, 1, 0, 4, "This"), (4, 0, 0, 0, "A "), (0, 0, 5, 5, "new"),
                          (99, 0, 0, 0, "nobody"), (8, 0, None, None, None)],
                  "doc_id long, seq int, start int, removed int, inserted string")
    both = token_counts.with_edits(df, edits)
    rows = token_counts.count_with_edits(both, "text", "edits", ranks, PATTERN).collect()
    assert len(rows) == len(ODD_ROWS)
    for r in rows:
        assert r["n_tokens"] == len(plain.encode_ordinary(r["text"] or ""))
        assert r["n_tokens_edited"] == len(plain.encode_ordinary(r["edited"]))
    assert {r["edited"] for r in rows if r["doc_id"] == 4} == {"Thisat it."}
    assert [r["edited"] for r in rows if r["doc_id"] == 0] == ["new"]
    assert token_counts.count_with_edits(
        both.where("doc_id > 99"), "text", "edits", ranks, PATTERN).count() == 0


def without_repeats(rows):
    """The contract, word by word, for rows of distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if (k := tuple(w[i:i + 20])) in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(k)
        out[doc] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_repeated_windows(spark):
    common = prose(50, 60)
    rows = [(i, t) for i, t in ODD_ROWS[:12]] + [
        (100 + i, prose(i, 30 + i) + " " + common + " " + prose(900 + i, 15)) for i in range(40)
    ] + [(200 + i, prose(7, 25)) for i in range(30)] + [(300, " ".join(["again"] * 70)),
                                                       (301, common + " " + common)]
    df = frame(spark, rows, **CLASHING)
    expected = without_repeats(rows)
    for sizes in ({}, {"block_bytes": 3000, "shard_windows": 300}):
        found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"])
                 for r in repeated_windows.without_repeats(df, **sizes).collect()}
        assert found == expected


def test_repeated_windows_of_odd_rows(spark):
    text = prose(11, 40)
    rows = [(None, text), (1, text), (1, text), (2, prose(12, 25)), (2, text)]
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], r["n_removed"])
                 for r in repeated_windows.without_repeats(frame(spark, rows)).collect())
    assert got == [(False, 0, 40, 0), (True, 1, 40, 40), (True, 1, 40, 40),
                   (True, 2, 25, 0), (True, 2, 40, 40)]
    assert repeated_windows.without_repeats(frame(spark, [])).count() == 0


def test_sketch_code_round_trip():
    rng = np.random.default_rng(3)
    for top in (40, 5000, 10**6, 2**31):
        cells = np.unique(rng.integers(0, top, 37))
        doubled = rng.integers(0, 2, len(cells)).astype(bool)
        got = repeated_windows.unpack(repeated_windows.pack(cells, doubled))
        assert got[0].tolist() == cells.tolist() and got[1].tolist() == doubled.tolist()


def test_text_is_shuffled_once(spark, tmp_path):
    frame(spark, [(i, prose(i, 30)) for i in range(20)]).write.parquet(f"{tmp_path}/d")
    df = repeated_windows.without_repeats(spark.read.parquet(f"{tmp_path}/d"))
    df.select(F.sha2("kept", 256)).collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_digests_of_the_queries(spark, plain):
    from contraluz.llm import queries
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    expected = without_repeats(list(texts.items()))
    for r in queries.op2_repeated_windows(spark, sf).collect():
        n, m, kept = expected[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (
            n, m, hashlib.sha256(kept.encode()).hexdigest())
    for r in queries.op4_byte_bpe(spark, sf).collect():
        ids = plain.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    for r in queries.op1_edit_token_counts(spark, sf).collect():
        assert r["n_tokens"] == len(plain.encode_ordinary(texts[r["doc_id"]]))
