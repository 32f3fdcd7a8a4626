"""Word-table encoding, token alignment and whitening against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contraluz.llm import byte_level, positions, token_alignment, whitening, word_table
from tests.llm.helpers import CLASHING, ODD_ROWS, frame, prose

PATTERN = public_tokenizers.PATTERN
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPECIAL = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "x  <|endoftext|>",
           "!<|endoftext|>", "<|endoftext|", "࢏x ࢏ 1࢏", "a▁b", "it'sŉ",
           "ÿ�\U0001f600", "a" * 700 + " \n" * 300]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return byte_level.Vocabulary(BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def odd_rows():
    long = prose(5, 200_000)  # above a megabyte, the size at which slices begin
    return ODD_ROWS + [(100 + i, t) for i, t in enumerate(SPECIAL)] + [
        (200, long + "y" * 300_000 + long)] + [(300 + i, prose(i, 40)) for i in range(30)]


def test_word_table_equals_the_library(spark, vocabulary, library):
    rows = odd_rows()
    texts = [t or "" for _, t in rows]
    expected = Counter(tuple(e.ids) for e in library.encode_batch(texts, add_special_tokens=False))
    df = frame(spark, rows, **CLASHING).repartition(3)
    for size in (positions.BLOCK, 2000):
        encoded = word_table.encode(df, "text", vocabulary, PATTERN, block_bytes=size)
        decoded = word_table.decode(encoded, "ids", word_table.piece_table(spark, vocabulary))
        found = decoded.collect()
        assert Counter(tuple(r["ids"]) for r in found) == expected
        assert {r["score"] for r in found} == {"mine"} and "text" not in decoded.columns
        for r in found:
            assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False)
    assert word_table.encode(df.where("doc_id < -1"), "text", vocabulary, PATTERN).count() == 0


def test_added_tokens_can_be_plain_text(spark, vocabulary, library):
    library.encode_special_tokens = True
    try:
        df = frame(spark, list(enumerate(SPECIAL)))
        found = word_table.encode(df, "text", vocabulary, PATTERN, special=False).collect()
        for r in found:
            expected = library.encode(SPECIAL[r["doc_id"]], add_special_tokens=False).ids
            assert r["ids"] == expected
    finally:
        library.encode_special_tokens = False


def test_every_entry_and_character_is_cut_as_by_the_library(vocabulary, library):
    strange = byte_level.disputed(vocabulary, PATTERN)
    cut = byte_level.Cutter(vocabulary.text, PATTERN, strange)
    rnd = random.Random(2)
    letters = "".join(chr(c) for c in (*range(1, 0x2fff), *range(0xa000, 0xab00))) + strange
    for _ in range(300):
        text = "".join(rnd.choice(rnd.choice([letters, " a1'\n.", "'s ' re"])) for _ in range(60))
        mine = [w for part in cut.parts(text) for w in part]
        theirs = library.pre_tokenizer.pre_tokenize_str(text)
        assert mine == [text[a:b] for _, (a, b) in theirs]
        assert "".join(mine) == text
    for piece, at in random.Random(3).sample(sorted(vocabulary.ranks.items()), 3000):
        assert vocabulary.pieces[at] == piece


def test_decoding_ids_of_any_kind(spark, vocabulary, library):
    rows = [(1, [0, 1, 50256]), (2, None), (3, []), (4, [99999, 5, -1]), (5, [254, 130, 200]),
            (6, [50256] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in word_table.decode(
        df, "ids", word_table.piece_table(spark, vocabulary)).collect()}
    for at, ids in rows:
        known = [i for i in ids or [] if 0 <= i <= 50256]
        assert found[at] == library.decode(known, skip_special_tokens=False)


def test_each_word_is_encoded_once_and_rows_wait_in_one_exchange(spark, vocabulary, tmp_path):
    frame(spark, [(i, prose(i % 3, 200)) for i in range(40)]).repartition(4).write.parquet(
        f"{tmp_path}/d")
    df = word_table.encode(spark.read.parquet(f"{tmp_path}/d"), "text", vocabulary, PATTERN)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1


def test_other_blocks_on_a_second_reading_fail(spark):
    blocks = spark.createDataFrame([(1, 7, 5, -3, bytearray(b""))],
                                   "id int, __block long, __mark long, __size int, __codes binary")
    found = spark.createDataFrame([(7, 6)], "__block long, __mark long")
    with pytest.raises(Exception, match="other blocks"):
        positions.by_position(blocks, found, ["id"], "n long", lambda t, n: None).collect()


def token_bytes(library, pieces):
    byte = byte_level.byte_alphabet()

    def a(i):
        piece = library.id_to_token(i)
        return piece.encode() if i == 50256 else bytes(byte[c] for c in piece)

    def b(i):
        piece = pieces.id_to_piece(i)
        return (bytes([int(piece[3:5], 16)]) if pieces.is_byte(i)
                else piece.replace("▁", " ").encode())
    return a, b


def plain_alignment(rows, library, pieces):
    """The contract, token by token."""
    bytes_a, bytes_b = token_bytes(library, pieces)
    library.encode_special_tokens = True
    out, counts = [], Counter()
    for doc, text in rows:
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
            a, b = [], []
        ends_a = np.cumsum([len(bytes_a(i)) for i in a]).tolist()
        ends_b = np.cumsum([len(bytes_b(i)) for i in b]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(f"{','.join(map(str, a[i:k]))}|{','.join(map(str, b[j:m]))}")
            links.append((a[k - 1], b[m - 1]))
            i, j = k, m
        counts.update(links)
        out.append((doc, len(a), len(b), groups, links))
    library.encode_special_tokens = False
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return Counter(
        (doc, n, m, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
         sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n else "")
        for doc, n, m, groups, links in out)


def aligned(df, vocabulary, **sizes):
    with open(PIECES, "rb") as model:
        both = token_alignment.align(df, "text", vocabulary, PATTERN, model.read())
    both = both.withColumn("n_links", F.size("links"))
    done = token_alignment.link_counts(both, "links", **sizes)
    return Counter((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"],
                    r["count_sum"], hashlib.sha256(r["groups"].encode()).hexdigest()
                    if r["groups"] else "") for r in done.collect())


def test_alignment_equals_a_plain_one(spark, vocabulary, library, pieces):
    rows = [r for r in odd_rows() if r[0] != 200] + [(200, prose(8, 3000))]
    df = frame(spark, rows, **CLASHING).repartition(3)
    expected = plain_alignment(rows, library, pieces)
    assert aligned(df, vocabulary) == expected
    assert aligned(df, vocabulary, block_bytes=500) == expected
    assert not aligned(df.where("doc_id < -1"), vocabulary)


def test_pointers_end_at_the_last_token_of_their_group():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 40, 400):
        ends = np.arange(1, n + 1)
        a = np.append(np.sort(rnd.choice(ends, n // 2, replace=False)), n)
        b = np.append(np.sort(rnd.choice(ends, n // 3, replace=False)), n)
        a, b = np.unique(a), np.unique(b)
        shared = np.intersect1d(a, b)
        last = b[token_alignment.terminals(a, b)]
        for end, reached in zip(np.concatenate([a, b]), last):
            assert reached == shared[np.searchsorted(shared, end)]
    # a chain as long as the text: no shared end before the last byte
    a, b = np.append(np.arange(1, 20001, 2), 20001), np.append(np.arange(2, 20001, 2), 20001)
    assert set(token_alignment.terminals(a, b)) == {len(b) - 1}


def test_decimal_ids_as_bytes():
    ids = np.array([0, 7, 10, 99, 100, 31999, 50256, 1234567890])
    text, ends = token_alignment.written(ids, np.array([44, 0, 124, 59, 44, 44, 0, 59], np.uint8))
    assert text.tobytes().decode() == "0,710|99;100,31999,502561234567890;"
    assert ends[0] == 2 and ends[-1] == len(text)


def plain_whitening(vectors, k=4):
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    own = np.unique(x, axis=0)
    n, sums = len(own), own.sum(axis=0)
    c = (n * own - sums) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    whitened = ((n * x - sums) / n) @ axes[:, :k] / np.sqrt(values[:k])
    return n, ((n * x - sums) ** 2).sum(axis=1), whitened, values[:k] / values.sum()


def test_whitening_equals_a_plain_one(spark):
    rnd = np.random.default_rng(4)
    usual = (rnd.normal(size=(200, 12)) * np.geomspace(40, 1e-2, 12)).astype(np.float32).tolist()
    odd = [None, [], [None] * 12, [float("nan")] + [0.0] * 11, [float("inf")] * 12, [1.0] * 5,
           [-0.0] * 12, [1e300] * 12]
    vectors = usual + usual[:50] + odd
    df = frame(spark, list(enumerate(vectors)), "vec_id long, embedding array<double>",
               whitened="w", x="x", n=3)
    model = whitening.fit(df, "embedding")
    found = {r["vec_id"]: r for r in whitening.whiten(df, "embedding", model).collect()}
    kept = [i for i, v in enumerate(vectors)
            if v and len(v) == 12 and all(c is not None and abs(c) < 1e200 for c in v)]
    n, deviation, whitened, explained = plain_whitening([vectors[i] for i in kept])
    assert sorted(found) == kept and model.n == n and found[0]["x"] == "x"
    assert [found[i]["deviation"] for i in kept] == deviation.tolist()
    mine = np.array([found[i]["whitened"] for i in kept])
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine * signs - whitened).max() < 1e-9
    assert np.abs(model.explained / explained - 1).max() < 1e-9
    assert model.identity_error < 1e-9


@pytest.mark.parametrize("vectors,components", [
    ([], 0), ([[1.0, 2.0]], 0), ([[1.0, 2.0]] * 5, 0), ([None, []], 0),
    ([[1.0, 2.0], [1.0, 3.0]], 1), ([[1.0, 2.0, 0.0], [2.0, 4.0, 0.0], [4.0, 8.0, 0.0]], 1),
    ([[0.0, 1.0, 2.0, 3.0], [1.0, 1.0, 2.0, 3.0], [0.0, 2.0, 2.0, 3.0]], 2)])
def test_whitening_of_degenerate_tables(spark, vectors, components):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    model = whitening.fit(df, "embedding")
    assert len(model.values) == components and model.identity_error < 1e-6
    rows = whitening.whiten(df, "embedding", model).collect()
    assert len(rows) == sum(bool(v) for v in vectors)
    assert all(len(r["whitened"]) == components for r in rows)


def test_deviations_beyond_64_bits_are_null():
    big = np.array([[1 << 40, 0], [3, 0]], np.int64)
    sums = np.array([0, 0], object)
    assert whitening.deviations(big, 1 << 20, sums) == [None, 9 << 40]


def test_badly_scaled_columns_stay_orthogonal(spark):
    rnd = np.random.default_rng(9)
    base = rnd.normal(size=(300, 1)) * 1e6
    vectors = np.hstack([base + rnd.normal(size=(300, 1)) * s for s in (1e-2, 1e-1, 1.0, 10.0)])
    df = spark.createDataFrame(list(enumerate(vectors.tolist())),
                               "vec_id long, embedding array<double>")
    model = whitening.fit(df, "embedding")
    assert len(model.values) == 4 and model.identity_error < 1e-4


def test_digests_of_the_queries(spark, library, pieces):
    from contraluz.llm import queries
    rows = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts = dict(rows)
    for r in queries.op13_word_table(spark, SF).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(r) == (r["doc_id"], len(ids),
                            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                            hashlib.sha256(decoded.encode()).hexdigest())
    found = Counter(tuple(r) for r in queries.op11_token_alignment(spark, SF).collect())
    assert found == plain_alignment(rows, library, pieces)
    vectors = {r["vec_id"]: r["embedding"] for r in
               spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    at = sorted(vectors)
    n, deviation, whitened, explained = plain_whitening([vectors[i] for i in at])
    got = queries.op12_whitening(spark, SF).collect()
    assert len(got) == 4 * len(at) and {r["n"] for r in got} == {n}
    for k in range(4):
        mine = {r["vec_id"]: r for r in got if r["component"] == k + 1}
        line = np.array([mine[i]["whitened"] for i in at])
        assert np.abs(line * np.sign(line @ whitened[:, k]) - whitened[:, k]).max() < 1e-9
        assert [mine[i]["deviation"] for i in at] == deviation.tolist()
        assert abs(mine[at[0]]["explained"] / explained[k] - 1) < 1e-9
        assert mine[at[0]]["identity_error"] < 1e-9
