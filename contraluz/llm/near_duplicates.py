"""Near-duplicate classes by DartMinHash signatures and banded joins.

The elements of a document are its five-word shingles, their weights how often
they occur.  Each unit of weight is a region (shingle, occurrence) into which
hashed darts fall as a Poisson process over rank: one dart on average in each
rank cell of length one, the same darts wherever the region occurs.  A document
looks only at ranks below a limit that makes a few more darts than coordinates
are needed, so the cost is the document's length plus k log k.  A dart's hash
names one of k coordinates, and the earliest dart of each is kept.  Two
documents keep the same dart with the probability of their weighted Jaccard
similarity.  Where a coordinate stays empty the limit is doubled.

Bands of R coordinates are hashed to buckets.  With R = 6 and 42 bands a pair of
similarity 0.8 misses all buckets with probability 3e-6.

Nobody emits all pairs of a bucket.  Copies of a text, told by its MD5, are one
node; ids play no part before the classes are named, so unlike texts of one id
stay apart.
The member of a bucket that shares most buckets with others, as it stands in the
middle of its group, is paired with the other members, where the two bits kept of
each coordinate do not speak against the similarity (a pair of 0.8 is lost to
their margin in less than one case of a million).  Pairs are verified on the
texts, and verified links give components.  Only buckets that still hold several
components go on.  Those with many members make groups (buckets that have a member
in common); a group's texts are dealt into blocks, every two blocks meet in one
task, which compares what is not yet in one component and emits links alone, so
no pair is a row.  Buckets with few members then pair what is left of different
components.  So no pair is left that shares a bucket and is neither judged nor in
one component.  Pairs whose lengths alone rule the similarity out are not formed.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contraluz.llm.common import few, ship, slices, stored
from contraluz.llm.hashing import Hasher, U, mix, scaled

SHINGLE = 5
SIMILARITY = 0.8
R, BANDS = 6, 42
LONGS = -(-R * BANDS // 32)
SMALL = 8  # open members of a bucket up to which its pairs are rows
BLOCK, BLOCK_WORDS = 1024, 1 << 19  # texts of a group, and words of them, in a block
MARGIN = 5.0  # standard errors of the estimate that a candidate may fall short
DOCS = 400  # documents whose darts are thrown at once
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])


def shingles(texts: list[bytes], hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Regions (shingle, occurrence) of all texts and their number in every text.

    A text of one to four words has one shingle, all its words.
    """
    width = SHINGLE
    first, _, valid, sizes = hasher.windows(texts, width)
    ends = np.cumsum(sizes)
    short = (sizes > 0) & (sizes < width)
    if short.any():
        few = [t for t, s in zip(texts, short) if s]
        words, counts = hasher.words(few)
        at = np.cumsum(counts) - counts
        whole = np.add.reduceat(
            mix(words + (np.arange(len(words)) - np.repeat(at, counts)).astype(np.uint64), 21),
            at)
        starts = (ends - sizes)[short]
        first[starts] = mix(whole, 22)
        valid[starts] = True
    owner = np.repeat(np.arange(len(texts)), sizes)[valid]
    values = first[valid]
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])][:len(values)]
    begin = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    nth = (np.arange(len(values)) - begin).astype(np.uint64)
    back = np.argsort(owner, kind="stable")
    return mix(values + nth * U(0x632BE59BD9B4E019), 23)[back], np.bincount(
        owner, minlength=len(texts))


def darts(regions: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """The rank of the earliest dart in each of k coordinates, a row for each text."""
    out = np.zeros((len(sizes), k), np.uint64)
    ends = np.cumsum(sizes)
    waiting = np.flatnonzero(sizes)
    limits = k * (math.log(k) + 4) / np.maximum(sizes, 1)
    while len(waiting):
        again = []
        for begin in range(0, len(waiting), DOCS):
            part = waiting[begin:begin + DOCS]
            n = sizes[part]
            owner = np.repeat(np.arange(len(part)), n)
            at = np.repeat(ends[part] - n.cumsum(), n) + np.arange(n.sum())
            depth = np.ceil(limits[part]).astype(np.int64)[owner]
            total = int(depth.sum())
            cell = np.arange(total) - np.repeat(depth.cumsum() - depth, depth)
            owner = np.repeat(owner, depth)
            seed = mix(np.repeat(regions[at], depth)
                       + cell.astype(np.uint64) * U(0xA0761D6478BD642F), 24)
            thrown = np.searchsorted(POISSON, (seed >> U(11)) * (1.0 / (1 << 53)), "right")
            nth = np.arange(int(thrown.sum())) - np.repeat(thrown.cumsum() - thrown, thrown)
            dart = mix(np.repeat(seed, thrown) + nth.astype(np.uint64) * U(0xE7037ED1A0B428DB), 25)
            owner, cell = np.repeat(owner, thrown), np.repeat(cell, thrown)
            rank = (cell.astype(np.uint64) << U(24)) | (dart & U(0xFFFFFF))
            inside = rank < (limits[part] * (1 << 24)).astype(np.uint64)[owner]
            slot = owner.astype(np.uint64) * U(k) + scaled(dart, k)
            packed = np.sort((slot[inside] << U(36)) | rank[inside])
            slot = (packed >> U(36)).astype(np.int64)
            lead = np.r_[True, slot[1:] != slot[:-1]][:len(slot)]
            found = np.full(len(part) * k, ~U(0), np.uint64)
            found[slot[lead]] = packed[lead] & U((1 << 36) - 1)
            found = found.reshape(len(part), k)
            full = (found != ~U(0)).all(axis=1)
            out[part[full]] = found[full]
            again.append(part[~full])
        waiting = np.concatenate(again)
        limits[waiting] *= 2
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A bucket for every band of every text's signature."""
    signature = signature.reshape(len(signature), BANDS, R)
    value = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), signature.shape[:2])
    for i in range(R):
        value = mix(value * U(0x9FB21C651E98DF25) + signature[:, :, i], 26)
    return value.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, size, bands, sketch) of rows with a word.

    The size is the total weight, the sketch two bits of every coordinate of the
    signature, 32 coordinates in a number.
    """
    schema = "doc_id long, digest binary, size int, bands array<long>, sketch array<long>"

    def one(part, hasher):
        texts = part.column(1).cast(pa.binary()).to_pylist()
        regions, sizes = shingles(texts, hasher)
        has = np.flatnonzero(sizes)
        signature = darts(regions, sizes, R * BANDS)[has]
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(has) + 1) * BANDS, pa.int32()),
            pa.array(bands(signature).ravel()))
        two = np.zeros((len(has), 32 * LONGS), np.uint64)
        two[:, :R * BANDS] = mix(signature, 27) >> U(62)
        packed = (two.reshape(len(has), LONGS, 32) << (U(2) * np.arange(32, dtype=np.uint64))).sum(
            axis=2, dtype=np.uint64).view(np.int64)
        sketches = pa.ListArray.from_arrays(
            pa.array(np.arange(len(has) + 1) * LONGS, pa.int32()), pa.array(packed.ravel()))
        digests = [hashlib.md5(texts[i]).digest() for i in has]
        return pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(has)), pa.array(digests, pa.binary()),
             pa.array(sizes[has], pa.int32()), lists,
             sketches],
            names=["doc_id", "digest", "size", "bands", "sketch"])

    def run(batches):
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch, 1):
                for begin in range(0, part.num_rows, DOCS):
                    yield one(part.slice(begin, DOCS), hasher)

    return docs.where("text IS NOT NULL").mapInArrow(run, schema)


def digest(text: str) -> Column:
    """The MD5 that tells texts apart."""
    return F.unhex(F.md5(text))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two multisets, each given by its distinct regions."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


def alike(one: str, two: str, least: float) -> Column:
    """Whether two sketches differ in no more coordinates than that similarity
    lets expect, with the margin."""
    different = F.lit(0)
    for i in range(LONGS):
        x = F.get(one, F.lit(i)).bitwiseXOR(F.get(two, F.lit(i)))
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        different = different + F.bit_count(either)
    return different <= most_different(least)


def texts_of(asked: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the asked nodes, stored.

    One row's text of each node moves: ids and digests of the nodes are broadcast
    while they are few enough, else the texts are shuffled.
    """
    asked = stored(nodes.select("node", F.col("first").alias("__first"), F.col(
        "digest").alias("__digest")).join(asked, "node", "left_semi"))
    same = F.col("doc_id").eqNullSafe(F.col("__first")) & (F.col("digest") == F.col("__digest"))
    texts = docs.withColumn("digest", digest("text")).join(few(asked), same)
    return stored(texts.groupBy("node").agg(F.any_value("text").alias("text")))


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The candidate pairs (a, b) of nodes whose texts are at least that similar.

    Only texts of candidates move.  pairs is a stored table.
    """
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = texts_of(asked, docs, nodes)
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")

    def run(batches):
        hasher, last, mine = Hasher(), None, None
        for batch in batches:
            a, b, text_a, text_b = batch.columns
            kept = []
            for i, (x, left, right) in enumerate(zip(
                    a.to_pylist(), text_a.cast(pa.binary()), text_b.cast(pa.binary()))):
                if x != last:
                    last, mine = x, shingles([left.as_py()], hasher)[0]
                kept.append(similarity(mine, shingles([right.as_py()], hasher)[0]) >= least)
            found = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(found), b.filter(found)], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def most_different(least: float) -> float:
    """The coordinates in which sketches of that similarity may differ, with the margin."""
    k, chance = R * BANDS, least + (1 - least) / 4
    return k * (1 - chance) + MARGIN * math.sqrt(k * chance * (1 - chance))


def links_of_blocks(texts: list[bytes], block: np.ndarray, label: np.ndarray,
                    sketch: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links between texts of different labels, enough to connect what is alike.

    Of one block all texts are compared, of two blocks those of the one with
    those of the other.  Texts that links have brought together count as one.
    """
    regions, sizes = shingles(texts, Hasher())
    ends = np.cumsum(sizes)
    vocabulary, ids = np.unique(regions, return_inverse=True)
    ids = np.split(ids, ends[:-1])
    label, marked, out = label.copy(), np.zeros(len(vocabulary), bool), []
    alone, most = block.min() == block.max(), most_different(least)
    for x in np.arange(len(texts)) if alone else np.flatnonzero(block == block.min()):
        other = np.arange(len(texts)) > x if alone else block != block[x]
        at = np.flatnonzero(
            other & (label != label[x])
            & (np.minimum(sizes, sizes[x]) >= least * np.maximum(sizes, sizes[x])))
        bits = sketch[at] ^ sketch[x]
        bits = (bits | bits >> U(1)) & U(0x5555555555555555)
        at = at[np.bitwise_count(bits).sum(axis=1) <= most]
        if not len(at):
            continue
        marked[ids[x]] = True
        both = np.add.reduceat(marked[np.concatenate([ids[y] for y in at])],
                               np.cumsum(sizes[at]) - sizes[at], dtype=np.int64)
        marked[ids[x]] = False
        for y in at[both / (sizes[x] + sizes[at] - both) >= least]:
            if label[y] != label[x]:
                out.append((int(x), int(y)))
                label[label == label[y]] = label[x]
    return out


def verified_groups(members: DataFrame, docs: DataFrame, nodes: DataFrame,
                    least: float) -> DataFrame:
    """Links (a, b) within groups: rows (group, rep, label, size, sketch), stored.

    A group's members are dealt into blocks by number and length, and each block
    goes to every task in which it meets one.
    """
    parts = members.groupBy("group").agg(
        (F.floor(F.count("*") / BLOCK) + F.floor(F.sum("size") / BLOCK_WORDS) + 1)
        .cast("int").alias("parts"))
    texts = texts_of(members.select(F.col("rep").alias("node")), docs, nodes)
    block = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    rows = members.join(parts, "group").withColumn("block", block).join(
        texts.withColumnRenamed("node", "rep"), "rep").withColumn(
            "meets", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("group", F.least("block", "meets").alias("i"), F.greatest(
        "block", "meets").alias("j"), "block", "rep", "label", "sketch", "text")

    def meet(table: pa.Table) -> pa.Table:
        block, rep, label = (table.column(c).to_numpy() for c in ("block", "rep", "label"))
        sketch = np.array(table.column("sketch").to_pylist(), np.int64).view(U)
        links = []
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        if i == j or len(np.unique(block)) == 2:
            texts = table.column("text").cast(pa.binary()).to_pylist()
            links = links_of_blocks(texts, block, label, sketch, least)
        at = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": rep[at[:, 0]], "b": rep[at[:, 1]]})

    return rows.groupBy("group", "i", "j").applyInArrow(meet, "a long, b long")


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label): the least node of each node's component, for linked nodes.

    Each node points to the least node around it, pointers double until they end
    at nodes that are the least around them, and links between these ends go on
    to the next round.  So rounds read fewer links each; their state is a table in
    the shared folder.
    """
    if labels is not None:
        links = links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
    edges = stored(links.where("a <> b").union(links.where("a <> b").select("b", "a")).distinct())
    found = None
    while True:
        ends = stored(edges.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("label")))
        while True:
            jumped = stored(ends.join(ends.toDF("label", "far"), "label").select(
                "node", F.col("label").alias("old"), F.col("far").alias("label")))
            ends = jumped.select("node", "label")
            if not jumped.where("old <> label").head(1):
                break
        found = ends if found is None else stored(found.join(
            ends.toDF("label", "end"), "label", "left").select(
                "node", F.coalesce("end", "label").alias("label")))
        edges = stored(edges.join(ends.toDF("a", "x"), "a").join(ends.toDF("b", "y"), "b").where(
            "x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        if not edges.head(1):
            return found


def labelled(docs: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Signed rows, and (digest, first, label, class_id) of every text with a word.

    first is the least id of the rows with that text, label a number of its
    class, class_id the least id of the class.  docs has doc_id and text.
    """
    signed = stored(signatures(docs).withColumn(
        "rep", F.monotonically_increasing_id()))  # holds, as it is stored
    nodes = stored(signed.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.min("rep").alias("node")))
    texts = signed.join(few(nodes.select(F.col("node").alias("rep"))), "rep", "left_semi")
    # keys are counted and looked up in one exchange, so both sides read all its columns
    rows = texts.select("rep", F.explode("bands").alias("key")).repartition("key")
    shared = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.min("rep").alias("low"), F.max("rep").alias("high")).where(
            "low < high").select("key", "n")
    buckets = rows.join(shared, "key").groupBy("rep").agg(
        F.collect_list("key").alias("keys"), F.sum("n").alias("degree"))
    buckets = buckets.join(texts.select("rep", "size"), "rep").select(
        F.explode("keys").alias("key"), "rep", "size", "degree").repartition("key")
    # a bucket's hub shares most buckets, then has the least number
    hubs = buckets.groupBy("key").agg(F.min(F.struct(
        (-F.col("degree")).alias("degree"), "rep", "size")).alias("f")).select(
            "key", F.col("f.rep").alias("hub"), F.col("f.size").alias("hub_size"))
    members = stored(buckets.join(hubs, "key").select("key", "rep", "size", "hub", "hub_size"))

    def close(one: str, two: str) -> Column:
        """Lengths do not rule the similarity out."""
        return F.least(one, two) >= least * F.greatest(one, two)

    def sketched(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that their sketches do not rule out, stored."""
        marks = texts.select("rep", "sketch")
        return stored(pairs.join(marks.toDF("a", "one"), "a").join(
            marks.toDF("b", "two"), "b").where(alike("one", "two", least)).select("a", "b"))

    pairs = sketched(members.where("rep <> hub").where(close("hub_size", "size")).select(
        F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    found = components(verified(pairs, docs, nodes, least))

    def open_buckets(rows: DataFrame) -> DataFrame:
        """Members of buckets in which several components meet, and their number, stored."""
        labels = rows.select("key", "rep", "size").join(
            found.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
                "label", F.coalesce("label", "rep"))
        mixed = labels.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high"),
            F.count("*").alias("n")).where("low <> high")
        return stored(labels.join(mixed.select("key", "n"), "key"))

    # the hub has met all members of its bucket
    members = open_buckets(members.where("rep <> hub"))
    large = members.where(F.col("n") > SMALL)
    if large.head(1):
        least_rep = large.groupBy("key").agg(F.min("rep").alias("a"))
        groups = components(large.join(least_rep, "key").select(
            "a", F.col("rep").alias("b")).distinct())
        groups = stored(large.select("rep", "label", "size").distinct().join(
            groups.toDF("rep", "group"), "rep").join(texts.select("rep", "sketch"), "rep"))
        found = components(verified_groups(groups, docs, nodes, least), found)
        members = open_buckets(members.where(F.col("n") <= SMALL))
    if members.head(1):
        lead = members.select("key", F.col("rep").alias("a"), F.col("size").alias("lead_size"),
                              F.col("label").alias("own"))
        fresh = members.join(lead, "key").where("own <> label AND a < rep").where(
            close("lead_size", "size")).select("a", F.col("rep").alias("b")).distinct()
        judged = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        fresh = sketched(fresh.join(judged, ["a", "b"], "left_anti"))
        found = components(verified(fresh, docs, nodes, least), found)

    linked = stored(nodes.join(found, "node", "left"))
    shared = stored(linked.where("label IS NOT NULL").groupBy("label").agg(
        F.min("first").alias("class_id")))
    many = linked.where("label IS NOT NULL").join(few(shared), "label")
    alone = linked.where("label IS NULL").withColumn("label", F.col("node")).withColumn(
        "class_id", F.col("first"))
    names = ["digest", "first", "label", "class_id"]
    return signed.select("doc_id", "digest"), many.select(*names).unionByName(
        alone.select(*names))


def named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))


def worded(text: str) -> Column:
    """Whether a text has a word."""
    return F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) for every row: the least id of its text's near-duplicate class.

    A class is a component of texts linked by a weighted Jaccard similarity of
    at least `least` over five-word shingles, words as they stand between blanks;
    shorter texts are one shingle.  A null text or one without words is a class
    of its own, a row without an id has a null class and links nothing, and
    repeated rows are copies like others.  Several texts of one id are each in
    their own class, unless they are alike.
    """
    docs = named(docs, doc_id, text)
    signed, texts = labelled(docs.where("doc_id IS NOT NULL"), least)
    grouped = signed.join(texts, "digest").select("doc_id", "class_id")
    return grouped.unionByName(docs.where(F.col("doc_id").isNull() | ~worded("text")).select(
        "doc_id", F.col("doc_id").alias("class_id")))


def surplus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            least: float = SIMILARITY) -> DataFrame:
    """(doc_id, digest) of the rows that are not the first of their class.

    The first is the least by id, null last, then by text.  Rows without an id
    are in the class of their text; those without words are in none.
    """
    docs = named(docs, doc_id, text)
    signed, texts = labelled(docs, least)
    texts = stored(texts)
    leads = F.col("first").eqNullSafe(F.col("class_id"))
    rows = signed.join(texts, "digest").where(~(leads & F.col("doc_id").eqNullSafe(
        F.col("first")))).select("doc_id", "digest").distinct()
    several = stored(texts.where(leads).groupBy("label").count().where("count > 1").select("label"))
    if not several.head(1):
        return rows
    tied = stored(texts.where(leads).join(few(several), "label", "left_semi").select(
        F.col("first").alias("__first"), F.col("digest").alias("__digest"), "label"))
    same = F.col("doc_id").eqNullSafe(F.col("__first")) & (F.col("digest") == F.col("__digest"))
    best = docs.withColumn("digest", digest("text")).join(few(tied), same).groupBy("label").agg(
        F.min("text").alias("text")).select(digest("text").alias("__digest"))
    beaten = tied.join(best, "__digest", "left_anti")
    return rows.unionByName(beaten.select(
        F.col("__first").alias("doc_id"), F.col("__digest").alias("digest")))


ship(__name__)
