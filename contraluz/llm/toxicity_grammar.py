"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reporting verb, quote,
clause end, other.  Three small transducers rewrite them: negation marks
insults and threats in its scope, reported speech marks those that are quoted
or reported, targeting tells those aimed at somebody from bare ones and closes
the reading of each clause.  They are composed once into one machine of a few
dozen states, and a text's clauses run through it.  What it emits, the readings,
carries the weights: a logistic model of how often each reading occurs, learned
from labelled rows.

Insults are written with endings, so the lexicon holds whole words and stems.
Both are learned: in a bounded sample of labelled documents, words and proper
word beginnings whose documents are marked toxic far more often than others;
of beginnings that contain each other the most telling one is kept.

Texts, and nothing else of a row, are scored in a narrow map.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contraluz.llm.common import map_column, ship, slices, stored

TOXIC_SAMPLE, CLEAN_SAMPLE = 4000, 8000
STEM = range(3, 10)
LEAST_SHARE, LEAST_DOCS, LEAST_Z = 0.004, 4, 6.0
LEXICON = 300
SCOPE = 3  # words that a negation reaches

# fixed values: function words and threats of the languages of the corpus
TARGETS = "you your yours youre u du dich dir dein deine ihr euch tu te toi vous votre tú ti usted ustedes vosotros"
NEGATIONS = "not no never isnt arent wasnt dont nicht kein keine nie pas non jamais ne nunca jamás sin"
REPORTS = "said says say called calls wrote claimed sagte sagt nannte schrieb dit appelle appelé écrit dijo dice llamó escribió"
THREATS = "kill hurt destroy murder stab töten umbringen vernichten tuer détruire frapper matar destruir golpear"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = "OIHTNRQE"
SYMBOLS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END)
#: what the composed machine emits: aimed and bare insults and threats, a target
#: that follows a bare insult, negated and reported ones, and hostile clauses
READINGS = ("aimed", "bare", "followed", "menace", "violence", "negated", "reported", "clause")
_CLAUSE = re.compile(r"[.,!?;:\n]+")
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»„]")
_QUOTES = set("\"“”«»„")


class Transducer:
    """A finite-state transducer given by its start and its step function."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def __rshift__(self, other: Transducer) -> Transducer:
        """Composition: what this one writes is what the other one reads."""
        def step(state, symbol):
            left, written = self.step(state[0], symbol)
            outputs, right = [], state[1]
            for w in written:
                right, more = other.step(right, w)
                outputs += more
            return (left, right), outputs
        return Transducer((self.start, other.start), step)

    def table(self, symbols) -> tuple[list[dict], list[dict]]:
        """Numbered states reached from the start: next state, and outputs."""
        numbers, todo, moves, writes = {self.start: 0}, [self.start], [], []
        for state in todo:
            moves.append({})
            writes.append({})
            for symbol in symbols:
                after, outputs = self.step(state, symbol)
                if after not in numbers:
                    numbers[after] = len(todo)
                    todo.append(after)
                moves[-1][symbol] = numbers[after]
                writes[-1][symbol] = tuple(outputs)
        return moves, writes


def negating(left: int, symbol: str):
    if symbol == END:
        return 0, [END]
    if symbol == NEGATION:
        return SCOPE, [OTHER]
    if left and symbol in (INSULT, THREAT):
        return left - 1, ["negated"]
    return max(0, left - 1), [symbol]


def reporting(state: tuple[bool, bool], symbol: str):
    reported, quoted = state
    if symbol == END:
        return (False, False), [END]
    if symbol == REPORT:
        return (True, quoted), [OTHER]
    if symbol == QUOTE:
        return (reported, not quoted), [OTHER]
    if (reported or quoted) and symbol in (INSULT, THREAT):
        return state, ["reported"]
    return state, [symbol]


def targeting(state: tuple[bool, bool], symbol: str):
    target, hostile = state
    if symbol == END:
        return (False, False), ["clause"] if hostile else []
    if symbol == TARGET:
        return (True, hostile), ["followed"] if hostile and not target else []
    if symbol == INSULT:
        return (target, True), ["aimed" if target else "bare"]
    if symbol == THREAT:
        return (target, True), ["menace" if target else "violence"]
    return state, [symbol] if symbol in READINGS else []


def grammar() -> tuple[list[dict], list[dict]]:
    return (Transducer(0, negating) >> Transducer((False, False), reporting)
            >> Transducer((False, False), targeting)).table(SYMBOLS)


class Matcher:
    """Readings of texts with one lexicon."""

    def __init__(self, words: list[str], stems: list[str]):
        self.moves, self.writes = grammar()
        self.symbol = {}
        for symbol, listed in ((TARGET, TARGETS), (NEGATION, NEGATIONS),
                               (REPORT, REPORTS), (THREAT, THREATS)):
            self.symbol.update(dict.fromkeys(listed.split(), symbol))
        self.symbol.update(dict.fromkeys(words, INSULT))
        threats = THREATS.split()
        wanted = sorted({*words, *threats, *stems}, key=lambda w: (-len(w), w))
        self.hit = re.compile("|".join(map(re.escape, wanted)))
        self.stems = re.compile("|".join(map(re.escape, stems))) if stems else None

    def read(self, word: str) -> str:
        if word in self.symbol:
            return self.symbol[word]
        if word in _QUOTES:
            return QUOTE
        if self.stems and (found := self.stems.match(word)) and found.end() < len(word):
            return INSULT
        return OTHER

    def readings(self, text: str) -> list[int]:
        """How often each reading occurs in a lower-cased text."""
        counts = dict.fromkeys(READINGS, 0)
        if self.hit.search(text):
            for clause in _CLAUSE.split(text):
                if self.hit.search(clause):
                    state = 0
                    for symbol in [*map(self.read, _TOKEN.findall(clause)), END]:
                        for reading in self.writes[state][symbol]:
                            counts[reading] += 1
                        state = self.moves[state][symbol]
        return list(counts.values())


def features(readings: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Logarithms of the counts and of their density by text length."""
    total = readings[:, :5].sum(axis=1)
    return np.column_stack([
        np.log1p(readings), np.log1p(total), np.minimum(total, 3),
        np.log1p(500.0 * total / np.maximum(lengths, 20)), np.log1p(lengths) / 5])


def labelled(docs: DataFrame, labels: DataFrame, text: str,
             toxic: int = TOXIC_SAMPLE, clean: int = CLEAN_SAMPLE):
    """A bounded sample (doc_id, text, toxic) and the labelled rows of each class."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    known = marks.join(docs.where(F.col(f"`{text}`").isNotNull()).select("doc_id").distinct(),
                       "doc_id", "left_semi")
    turn = Window.partitionBy("toxic").orderBy(
        F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    chosen = known.withColumn("n", F.row_number().over(turn)).where(
        F.col("n") <= F.when(F.col("toxic") == 1, toxic).otherwise(clean)).drop("n")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    # bounded: `toxic` and `clean` rows at most
    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text")).join(
        F.broadcast(chosen), "doc_id")
    return rows, sizes


def evidence(rows: DataFrame) -> DataFrame:
    """(form, stem, toxic, clean): documents of each class with the word or stem."""
    def run(batches):
        for batch in batches:
            counts = (Counter(), Counter())
            for part in slices(batch, 0):
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = set(re.findall(r"[^\W\d_]+", text.lower()))
                    forms = {w for w in found if len(w) <= 40}
                    counts[toxic].update(forms)
                    counts[toxic].update({w[:n] + "*" for w in forms for n in STEM if n < len(w)})
            keys = sorted(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([
                pa.array([k.rstrip("*") for k in keys], pa.string()),
                pa.array([k[-1] == "*" for k in keys], pa.bool_()),
                pa.array([counts[1][k] for k in keys], pa.int64()),
                pa.array([counts[0][k] for k in keys], pa.int64())],
                names=["form", "stem", "toxic", "clean"])

    counted = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        run, "form string, stem boolean, toxic long, clean long")
    return counted.groupBy("form", "stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(rows: DataFrame) -> tuple[list[str], list[str]]:
    """Telling words and stems, most telling first; none contains another's matches."""
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    nt, nc = n.get(1, 0), n.get(0, 0)
    if not nt or not nc:
        return [], []
    share = (F.col("toxic") + F.col("clean")) / F.lit(nt + nc)
    z = (F.col("toxic") / nt - F.col("clean") / nc) / F.sqrt(
        share * (1 - share) * (1 / nt + 1 / nc) + 1e-12)
    found = evidence(rows).where(F.col("toxic") >= max(LEAST_DOCS, math.ceil(LEAST_SHARE * nt))
                                 ).withColumn("z", z).where(F.col("z") >= LEAST_Z)
    words: list[str] = []
    stems: list[str] = []
    for r in found.orderBy(
            F.desc("z"), "stem", F.desc(F.length("form")), "form").limit(50 * LEXICON).collect():
        form = r["form"]
        covered = any(form.startswith(s) for s in stems) or any(
            s.startswith(form) for s in stems) or (
                r["stem"] and any(w.startswith(form) for w in words))
        if not covered and len(words) + len(stems) < LEXICON:
            (stems if r["stem"] else words).append(form)
    return words, stems


def fit(x: np.ndarray, y: np.ndarray, offset: float, ridge: float = 1.0) -> dict:
    """Logistic regression by Newton steps on scaled features.

    `offset` is the log odds that the sample's class sizes add to the true ones.
    """
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w, keep = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-(z @ w).clip(-30, 30)))
        slope = z.T @ (y - p) - keep * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(keep)
        move = np.linalg.solve(curve, slope)
        w += move
        if abs(move).max() < 1e-8:
            break
    return {"mean": mean, "spread": spread, "weights": w[1:], "bias": w[0] - offset}


def train(docs: DataFrame, labels: DataFrame, text: str = "text",
          toxic: int = TOXIC_SAMPLE, clean: int = CLEAN_SAMPLE) -> dict:
    """Lexicon and weights from at most `toxic` + `clean` labelled documents.

    Of several labels of a document the toxic one counts.  Where a class has no
    document nothing can be told apart: every text gets the share of toxic ones.
    """
    rows, sizes = labelled(docs, labels, text, toxic, clean)
    rows = stored(rows)
    words, stems = lexicon(rows)
    scored = read(rows, "text", words, stems).select("toxic", "readings", "length")
    got = scored.limit(toxic + clean).collect()
    y = np.array([r["toxic"] for r in got], float)
    if not len(y) or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        return {"words": [], "stems": [], "rate": rate}
    x = features(np.array([r["readings"] for r in got], float),
                 np.array([r["length"] for r in got], float))
    offset = math.log(y.sum() / sizes[1]) - math.log((len(y) - y.sum()) / sizes[0])
    return {"words": words, "stems": stems, "model": fit(x, y, offset)}


def read(docs: DataFrame, text: str, words: list[str], stems: list[str]) -> DataFrame:
    """Adds `readings`, the count of each of READINGS, and the text's length."""
    def start():
        matcher = Matcher(words, stems)

        def work(column: pa.Array) -> list[pa.Array]:
            texts = [(t or "").lower() for t in column.to_pylist()]
            return [pa.array([matcher.readings(t) for t in texts], pa.list_(pa.int32())),
                    pa.array([len(t) for t in texts], pa.int32())]
        return work

    return map_column(docs, text, "readings array<int>, length int", start)


def score(docs: DataFrame, text: str, model: dict) -> DataFrame:
    """Adds readings, score (0 to 1) and predicted (1 from a score of 0.5).

    A null or empty text has no readings and gets the score of such texts.
    Columns of the added names (also `length`, which is dropped) are replaced.
    """
    plain = read(docs, text, model["words"], model["stems"])
    if "model" not in model:
        return plain.drop("length").withColumn("score", F.lit(model["rate"])).withColumn(
            "predicted", (F.col("score") >= 0.5).cast("int"))
    found = model["model"]
    counts = [F.col("readings")[i].cast("double") for i in range(len(READINGS))]
    total = sum(counts[1:5], counts[0])
    length = F.col("length").cast("double")
    x = [*[F.log1p(c) for c in counts], F.log1p(total), F.least(total, F.lit(3.0)),
         F.log1p(F.lit(500.0) * total / F.greatest(length, F.lit(20.0))), F.log1p(length) / 5]
    odds = F.lit(float(found["bias"]))
    for value, mean, spread, weight in zip(
            x, found["mean"], found["spread"], found["weights"]):
        odds = odds + (value - float(mean)) * float(weight / spread)
    scored = plain.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).drop("length")


ship(__name__)
