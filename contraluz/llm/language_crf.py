"""Language of every word, and of the document, by a linear-chain CRF.

A word's emission score for a language is the sum of learned weights of its
features: the word itself (the lexicon), prefixes and suffixes of one to four
bytes, and the byte trigrams inside it.  A learned transition matrix joins
neighbouring words, so that in code-switched text a stretch of words holds its
language against single odd words.  Forward-backward gives each word's
posterior; a document's language is the one with the largest mean posterior.

Everything is worked out on whole batches of texts as flat arrays.  The chain
is cut into blocks of words: a block's transfer matrix is the product of its
words' matrices, so all blocks advance side by side, and the state at the edges
of blocks comes from products along each document.  The result is exactly that
of the word-by-word recursion.

Training takes a bounded, documented sample (`per_language` documents of each
language, whole texts) to the driver and fits by stochastic gradient; scoring
is a narrow map with a model of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contraluz.llm.common import map_column, ship
from contraluz.llm.hashing import U, mix

BITS = 16  # buckets of each feature table
AFFIXES = 4
BLOCK = 128
PER_LANGUAGE = 250
LANGUAGES = 64  # most frequent labels that a model learns
EPOCHS, MINIBATCH, RATE = 3, 24, 0.25
TABLES = 2 * AFFIXES + 1
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[128:] = True


@dataclass
class Model:
    """Weights of fixed size; `emission` has a table for each feature kind."""

    languages: list[str]
    emission: np.ndarray  # (TABLES + 1, 2**BITS, languages)
    transition: np.ndarray  # (languages, languages), logarithms

    @property
    def plain(self) -> tuple:
        return self.languages, self.emission, self.transition


@dataclass
class Words:
    """All words of some texts: feature buckets, trigram buckets, text sizes."""

    features: np.ndarray  # (TABLES, words)
    grams: np.ndarray  # buckets of byte trigrams, word after word
    gram_starts: np.ndarray
    sizes: np.ndarray


def _bucket(code: np.ndarray, salt: int) -> np.ndarray:
    return (mix(code, salt) >> U(64 - BITS)).astype(np.int32)


def read_words(texts: list[str]) -> Words:
    """Words are runs of letters, lower-cased, as UTF-8 bytes."""
    data = np.frombuffer(
        b" ".join([b"", *[t.lower().encode(errors="replace") for t in texts], b"    "]), np.uint8)
    bounds = np.cumsum([0] + [len(t.lower().encode(errors="replace")) + 1 for t in texts]) + 1
    letter = _LETTER[data]
    starts = np.flatnonzero(~letter[:-1] & letter[1:]) + 1
    ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    sizes = np.diff(np.searchsorted(starts, bounds))
    lengths = ends - starts
    wide = data.astype(np.uint64)
    features = np.empty((TABLES, len(starts)), np.int32)
    prefix = np.zeros(len(starts), np.uint64)
    suffix = np.zeros(len(starts), np.uint64)
    for i in range(AFFIXES):
        here = lengths > i
        prefix = np.where(here, (prefix << U(8)) | wide[starts + i], prefix)
        suffix = np.where(here, (suffix << U(8)) | wide[ends - 1 - i], suffix)
        features[i] = _bucket(prefix, 31 + i)
        features[AFFIXES + i] = _bucket(suffix, 41 + i)
    grams = (wide[:-2] << U(16)) | (wide[1:-1] << U(8)) | wide[2:]
    whole = np.add.reduceat(
        mix(grams, 51) * _position(starts, ends, len(grams)), starts) if len(starts) else prefix
    features[-1] = _bucket(whole + prefix, 52)
    # trigrams that start at a word's byte, reaching over its end by a blank
    inside = letter[:len(grams)]
    return Words(features, _bucket(grams[inside], 53), np.cumsum(lengths) - lengths, sizes)


def _position(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """An odd factor for each byte by its place in its word, 0 outside words."""
    at = np.zeros(n + 2, np.int64)
    place = np.arange(n + 2)
    at[starts] = starts
    at = np.maximum.accumulate(at)
    inside = np.zeros(n + 3, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    factor = mix((place - at).astype(np.uint64), 54) | U(1)
    return np.where(np.cumsum(inside[:n]) > 0, factor[:n], U(0))


def emissions(words: Words, model: Model) -> np.ndarray:
    n, m = words.features.shape[1], len(model.languages)
    out = np.zeros((n, m), np.float32)
    for table in range(TABLES):
        out += model.emission[table][words.features[table]]
    if n:
        for label in range(m):
            weight = np.ascontiguousarray(model.emission[TABLES][:, label])
            out[:, label] += np.add.reduceat(weight[words.grams], words.gram_starts)
    return out


def chain(emission: np.ndarray, sizes: np.ndarray, transition: np.ndarray):
    """Posteriors of all words, and the scaled forward and backward vectors."""
    n, m = emission.shape
    local = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float64)
    step = np.exp(transition - transition.max()).astype(np.float64)
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * BLOCK
    lengths = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
    order = np.argsort(-lengths, kind="stable")
    active = np.searchsorted(-lengths[order], -np.arange(1, BLOCK + 1), "right")
    begin = starts[order]

    transfer = np.broadcast_to(np.eye(m), (len(owner), m, m)).copy()
    for t in range(BLOCK):
        k = active[t]
        if not k:
            break
        moved = (transfer[:k] @ step) * local[begin[:k] + t][:, None, :]
        transfer[:k] = moved / moved.max(axis=(1, 2), keepdims=True)
    by_block = np.empty_like(transfer)
    by_block[order] = transfer

    enter = np.full((len(owner), m), 1.0 / m)  # forward state before each block
    leave = np.full((len(owner), m), 1.0)  # backward state after each block
    deepest = int(blocks.max()) if len(blocks) else 0
    first = np.cumsum(blocks) - blocks
    for i in range(1, deepest):
        has = np.flatnonzero(blocks > i)
        at = first[has] + i
        state = np.einsum("bi,bij->bj", enter[at - 1], by_block[at - 1])
        enter[at] = state / state.sum(axis=1, keepdims=True)
        at = first[has] + blocks[has] - 1 - i
        state = np.einsum("bij,bj->bi", by_block[at + 1], leave[at + 1])
        leave[at] = state / state.sum(axis=1, keepdims=True)

    forward, backward = np.empty((n, m)), np.empty((n, m))
    state = enter[order]
    for t in range(BLOCK):
        k = active[t]
        if not k:
            break
        moved = (state[:k] @ step) * local[begin[:k] + t]
        state[:k] = moved / moved.sum(axis=1, keepdims=True)
        forward[begin[:k] + t] = state[:k]
    state = leave[order]
    last = lengths[order] - 1
    for t in range(BLOCK):
        k = active[t]
        if not k:
            break
        at = begin[:k] + last[:k] - t
        backward[at] = state[:k]
        moved = (local[at] * state[:k]) @ step.T
        state[:k] = moved / moved.sum(axis=1, keepdims=True)
    posterior = forward * backward
    posterior /= posterior.sum(axis=1, keepdims=True)
    return posterior, forward, backward, local, step


def document_scores(posterior: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean posterior of each text; zeros for one without words."""
    sums = np.zeros((len(sizes) + 1, posterior.shape[1]))
    total = np.vstack([np.zeros((1, posterior.shape[1])), np.cumsum(posterior, axis=0)])
    ends = np.cumsum(sizes)
    sums = total[ends] - total[ends - sizes]
    return sums / np.maximum(sizes, 1)[:, None]


def fit(rows: list[tuple[str, str]], epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Stochastic gradient of the CRF's likelihood; each text has one language.

    The order of the rows decides the steps, so the same rows give the same
    model.  Steps shrink by squared gradients; a little of each weight decays.
    """
    languages = sorted({lang for _, lang in rows})
    m = len(languages)
    shape = (TABLES + 1, 1 << BITS, m)
    model = Model(languages, np.zeros(shape, np.float32), np.zeros((m, m)))
    seen = np.full(shape, 1e-2, np.float32)
    seen_moves = np.full((m, m), 1e-2)
    batches = []
    for begin in range(0, len(rows), MINIBATCH):
        part = rows[begin:begin + MINIBATCH]
        words = read_words([t for t, _ in part])
        labels = np.repeat([languages.index(lang) for _, lang in part], words.sizes)
        if len(labels):
            batches.append((words, labels))
    for _ in range(epochs):
        for words, labels in batches:
            posterior, forward, backward, local, step = chain(
                emissions(words, model), words.sizes, model.transition)
            error = -posterior
            error[np.arange(len(labels)), labels] += 1
            scale = 1.0 / len(words.sizes)
            gram_owner = np.repeat(np.arange(len(labels)), np.diff(
                np.r_[words.gram_starts, len(words.grams)]))
            for table in range(TABLES + 1):
                grams = table == TABLES
                key, inverse = np.unique(
                    words.grams if grams else words.features[table], return_inverse=True)
                value = error[gram_owner] if grams else error
                slope = np.stack([np.bincount(inverse, value[:, j], len(key))
                                  for j in range(m)], axis=1) * scale
                seen[table][key] += slope ** 2
                model.emission[table][key] += rate * slope / np.sqrt(seen[table][key])
            inner = np.ones(len(labels), bool)
            ends = np.cumsum(words.sizes)
            inner[(ends - words.sizes)[words.sizes > 0]] = False
            at = np.flatnonzero(inner)
            pair = forward[at - 1][:, :, None] * step * (local[at] * backward[at])[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            slope = -pair.sum(axis=0)
            np.add.at(slope, (labels[at - 1], labels[at]), 1)
            slope *= scale
            seen_moves += slope ** 2
            model.transition += rate * slope / np.sqrt(seen_moves)
    return model


def sample(docs: DataFrame, doc_id: str, text: str, lang: str,
           per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most `per_language` labelled texts of each language, by a hash of the id."""
    rows = docs.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(
        F.xxhash64(F.col(f"`{doc_id}`").cast("string")).alias("place"),
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{lang}`").alias("lang"))
    turn = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = rows.withColumn("n", F.row_number().over(turn)).where(
        F.col("n") <= per_language).select("doc_id", "lang").distinct()
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                         F.col(f"`{lang}`").alias("lang"))
    # bounded: per_language rows of each language
    return source.join(F.broadcast(chosen), ["doc_id", "lang"])


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """A model of the labelled rows given; with no usable row it knows no language."""
    labelled = docs.where(F.col(f"`{lang}`").isNotNull())
    top = [r[0] for r in labelled.groupBy(F.col(f"`{lang}`").alias("lang")).count().orderBy(
        F.desc("count"), "lang").limit(LANGUAGES).collect()]
    rows = sample(labelled.where(F.col(f"`{lang}`").isin(top)), doc_id, text, lang,
                  per_language).withColumn("place", F.xxhash64(F.col("doc_id").cast("string")))
    got = sorted((r["place"], r["text"], r["lang"]) for r in rows.limit(
        per_language * LANGUAGES).collect())
    return fit([(t, lang_) for _, t, lang_ in got])


def predict(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """Adds lang_pred, score and the share of words in each language.

    `lang_pred` is the language of the largest mean word posterior (ties: the
    first by name), `score` that mean; `shares` gives the part of the words
    whose likeliest language is each.  A null text, one without a letter, or a
    model without languages gives `und`, 0.0 and no shares.  A text of letters
    of which none forms a word is scored as if each language were as likely.
    Columns of those names are replaced, all others kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.plain)

    def start():
        known = Model(*shared.value)
        names = np.array(known.languages + [UNKNOWN], object)

        def work(column: pa.Array) -> list[pa.Array]:
            texts = [t or "" for t in column.to_pylist()]
            letters = np.fromiter((any(map(str.isalpha, t)) for t in texts), bool, len(texts))
            if not known.languages:
                letters[:] = False
            score, label = np.zeros(len(texts)), np.full(len(texts), len(names) - 1)
            shares: list[dict] = [{} for _ in texts]
            if letters.any():
                words = read_words(texts)
                m = len(known.languages)
                best = np.zeros((0, m))
                if words.sizes.sum():
                    posterior = chain(emissions(words, known), words.sizes, known.transition)[0]
                    best = np.eye(m)[posterior.argmax(axis=1)]
                    means = document_scores(posterior, words.sizes)
                else:
                    means = np.zeros((len(texts), m))
                means[words.sizes == 0] = 1.0 / m
                parts = document_scores(best, words.sizes)
                label = np.where(letters, means.argmax(axis=1), label)
                score = np.where(letters, means.max(axis=1).clip(0, 1), 0.0)
                shares = [[(known.languages[j], float(row[j])) for j in np.flatnonzero(row)]
                          if has else [] for row, has in zip(parts, letters)]
            return [pa.array(names[label].tolist(), pa.string()), pa.array(score, pa.float64()),
                    pa.array([list(s) for s in shares], pa.map_(pa.string(), pa.float64()))]
        return work

    return map_column(docs, text, "lang_pred string, score double, shares map<string,double>",
                      start)


def learnable(doc_id: str, held: Column) -> Column:
    """Rows that a model may learn from: an id, and not held out."""
    return F.col(f"`{doc_id}`").isNotNull() & ~held


ship(__name__)
