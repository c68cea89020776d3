"""Toxicity of texts whose insults may be disguised.

Writers hide words by look-alike signs (``1d10t``), by spacing (``i d i o t``,
``i.d.i.o.t``) and by repetition (``idiooot``). Every such spot becomes a lattice:
each position lists the letters it may stand for, each with a channel cost. The
Viterbi path through the lattice under a character trigram model of the corpus
is the restored text, which is then scored.

The classifier is a logistic model over words and over the number of words that
share an opening, so it also learns families of insults that grow new endings.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asphalt.llm.batches import text_batches
from asphalt.llm.folds import bounded_share, held_out, kept_share
from asphalt.session import materialise

# Documents whose label the fit reads, at most about this many: bounds the word statistics.
MAX_LABELLED = 20_000
MIN_DOCS = 4  # toxic documents that support a feature
LIFT = 2.0  # times the overall share of toxic documents
RIDGE = 0.3  # strength of the pull of all weights to zero, against the sum over labelled texts
OPENINGS = (4, 5, 6, 7, 8)
STRONG = 0.5
SYMBOLS = 28  # boundary, a to z, any other letter
CACHE = 150_000
CHUNK = 500  # documents whose features are counted together

# What a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i",
}
SIGN_COST, REPEAT_COST, GAP_COST = 1.0, 1.0, 1.5

_LEAD = ".,;:?\"'()[]{}<>*&%#~-_=/\\`…«»“”‘’"
_TRAIL = _LEAD + "!$@|+"
_RUN = re.compile(r"([^\W\d_])\1\1")
_GAPPED = re.compile(r"^\S(?:[._*\-~/]\S){2,}$")
_PIECE = re.compile(r"[^\s.,;:?\"'()\[\]{}<>*&%#~\-_=/\\`…«»“”‘’]+")
_HIDDEN = re.compile("[­​-‏⁠﻿]")

_CODES = np.zeros(129, dtype=np.int64)
_CODES[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CODES[ord("A"):ord("Z") + 1] = np.arange(1, 27)


def _code(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 27 if letter.isalpha() else 0


def trigram_counts(texts: Iterator[str | None]) -> np.ndarray:
    """Counts of (before last, last, next) symbols, flat; what stands before a boundary is forgotten."""
    total = np.zeros(SYMBOLS ** 3, dtype=np.int64)
    for text in texts:
        if not text:
            continue
        points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
        codes = np.where(points < 128, _CODES[np.minimum(points, 128)], np.where(points >= 0xC0, 27, 0))
        codes = np.concatenate(([0, 0], codes, [0]))
        first, last, after = codes[:-2] * (codes[1:-1] != 0), codes[1:-1], codes[2:]
        total += np.bincount((first * SYMBOLS + last) * SYMBOLS + after, minlength=SYMBOLS ** 3)
    return total


def letter_model(counts: np.ndarray, weight: float = 5.0) -> list:
    """Costs (negative logarithms) of a symbol after two symbols, smoothed by shorter contexts."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    one = three.sum(axis=(0, 1)) + 1
    one /= one.sum()
    two = three.sum(axis=0) + weight * one
    two /= two.sum(axis=1, keepdims=True)
    three = three + weight * two[None]
    three /= three.sum(axis=2, keepdims=True)
    return (-np.log(three)).tolist()


def lattice(text: str) -> list[list[tuple[str, float]]]:
    """Positions of a disguised word: what each may stand for, with its cost."""
    places, at = [], 0
    while at < len(text):
        sign, end = text[at], at + 1
        while end < len(text) and text[end] == sign:
            end += 1
        if sign in " ._*-~/":
            places.append([("", GAP_COST), (" ", 0.0)])
        else:
            options = [(c, SIGN_COST) for c in LOOKALIKES.get(sign, "")] or [(sign, 0.0)]
            if end - at >= 3:
                places.append([(c, cost + REPEAT_COST) for c, cost in options] + [(c + c, cost + REPEAT_COST) for c, cost in options])
            else:
                places.extend([options] * (end - at))
        at = end
    return places


def decode(places: list[list[tuple[str, float]]], model: list) -> str:
    """The cheapest reading of a lattice; ties go to the reading that sorts first."""
    paths = {(0, 0): (0.0, "")}
    for options in [*places, [(" ", 0.0)]]:
        found: dict = {}
        for (a, b), (cost, read) in paths.items():
            for letters, extra in options:
                x, y, total = a, b, cost + extra
                for letter in letters:
                    code = _code(letter)
                    total += model[x if y else 0][y][code]
                    x, y = y, code
                known = found.get((x, y))
                if known is None or (total, read + letters) < known:
                    found[x, y] = (total, read + letters)
        paths = found
    return min(paths.values())[1].strip()


def _readings(token: str, model: list) -> list[str]:
    """The words a token holds, restored where it is disguised."""
    if token.isalpha() and not _RUN.search(token) and not any(c in LOOKALIKES for c in token if c > "z"):
        return [token]
    token = _HIDDEN.sub("", token).lstrip(_LEAD).rstrip(_TRAIL)
    if not token:
        return []
    pieces = [token] if _GAPPED.match(token) else _PIECE.findall(token)
    words = []
    for piece in pieces:
        piece = piece.rstrip(_TRAIL)
        if piece.isalpha() and not _RUN.search(piece) and not any(c in LOOKALIKES for c in piece if c > "z"):
            words.append(piece)
        elif any(c.isalpha() for c in piece):
            words.extend(decode(lattice(piece), model).split())
    return words


def _spaced(tokens: list[str]) -> Iterator[str]:
    """Runs of three or more tokens of one sign each, of which one is a letter at least."""
    if len(tokens) < 3:
        return
    single = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) == 1
    if not (single[:-2] & single[1:-1] & single[2:]).any():
        return
    edges = np.flatnonzero(np.diff(np.concatenate(([0], single.view(np.int8), [0]))))
    for start, end in zip(edges[::2], edges[1::2]):
        signs = [t for t in tokens[start:end] if t.isalnum() or t in LOOKALIKES]
        if len(signs) >= 3 and any(c.isalpha() for c in signs):
            yield " ".join(signs)


def restored_words(text: str | None, model: list, cache: dict) -> set[str]:
    """The distinct words of a text after restoring, lower case."""
    tokens = text.lower().split() if text else []
    words: set[str] = set()
    for token in set(tokens):
        found = cache.get(token)
        if found is None:
            if len(cache) >= CACHE:
                cache.clear()
            found = cache[token] = _readings(token, model)
        words.update(found)
    for run in _spaced(tokens):
        words.update(decode(lattice(run), model).split())
    return words


def openings(word: str) -> list[str]:
    return [word[:n] + "*" for n in OPENINGS if len(word) > n]


def features(words: set[str], known: set[str] | None = None) -> set[str]:
    """What the classifier sees: words, and how many words share an opening, as a number and against all words.

    With ``known`` only these words and openings are looked at.
    """
    if known is None:
        return set(words) | _grouped(Counter(o for w in words for o in openings(w)), len(words))
    return words & known | _grouped(Counter(o for w in words for o in openings(w) if o in known), len(words))


def _grouped(groups: Counter, size: int) -> set[str]:
    """Features of openings that so many of a text's ``size`` words share."""
    return {f for opening, n in groups.items() for f in (
        f"{opening}{min(n, 4)}", f"{opening}~{min(6, (1000 * n // size).bit_length())}")}


def _base(feature: str) -> str:
    return feature[: feature.index("*") + 1] if "*" in feature else feature


@dataclass
class ToxicityModel:
    letters: list
    intercept: float
    weights: dict[str, float] = field(default_factory=dict)

    @property
    def known(self) -> set[str]:
        return {_base(f) for f in self.weights}


def _letters(docs: DataFrame, text_column: str) -> list:
    """Trigram model over all texts; at most ``SYMBOLS ** 3`` sums reach the driver."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS ** 3, dtype=np.int64)
        for batch in batches:
            total += trigram_counts(batch["text"])
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    parts = docs.select(F.col(text_column).alias("text")).mapInPandas(counted, "at long, n long")
    counts = np.zeros(SYMBOLS ** 3)
    for row in parts.groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[row["at"]] = row["n"]
    return letter_model(counts)


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "toxic",
    max_labelled: int = MAX_LABELLED, seed: int = 9,
) -> ToxicityModel:
    """Character model over all texts, logistic model over labelled rows of the learning fold.

    Only labels of ids outside the held-out fold are read, about ``max_labelled``
    of them by a hash of the id. An id labelled twice counts as toxic if one
    label says so. Texts that repeat count once per label. Features that too
    few toxic texts support are left out. Without both labels every score is
    the smoothed share of toxic texts.
    """
    text_batches(docs.sparkSession)
    letters = _letters(docs, text_column)
    known = labels.select(F.col(id_column).alias("doc_id"), F.col(label).alias("toxic")).dropna().where(
        ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(kept_share(F.col("doc_id"), bounded_share(known, max_labelled), seed))
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).join(
        F.broadcast(known), "doc_id")  # bounded by max_labelled
    texts = texts.groupBy(F.xxhash64("text").alias("same"), F.col("toxic")).agg(F.first("text").alias("text"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for batch in batches:
            yield pd.DataFrame({
                "toxic": batch["toxic"], "words": [sorted(restored_words(t, letters, cache)) for t in batch["text"]]})

    sample = materialise(texts.select("toxic", "text").mapInPandas(read, "toxic int, words array<string>"))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                part = batch.iloc[start:start + CHUNK]
                seen, bad = Counter(), Counter()
                for words, toxic in zip(part["words"], part["toxic"]):
                    own = features(set(words))
                    seen.update(own)
                    if toxic:
                        bad.update(own)
                yield pd.DataFrame({"feature": list(seen), "docs": list(seen.values()), "bad": [bad[f] for f in seen]})

    totals = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = (totals[1] + 0.5) / (totals[0] + 10)
    model = ToxicityModel(letters, math.log(share / (1 - share)))
    if not 0 < totals[1] < totals[0]:
        return model
    sums = sample.mapInPandas(counted, "feature string, docs long, bad long").groupBy("feature").agg(
        F.sum("docs").alias("docs"), F.sum("bad").alias("bad"))
    useful = sums.where((F.col("bad") >= MIN_DOCS) & (F.col("bad") >= LIFT * share * F.col("docs")))
    bases = {_base(r["feature"]) for r in useful.select("feature").collect()}  # bounded by max_labelled texts
    if not bases:
        return model

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "label": batch["toxic"].astype(float), "found": [sorted(features(set(w), bases)) for w in batch["words"]]})

    rows = materialise(sample.mapInPandas(told, "label double, found array<string>"))
    seen = rows.select(F.explode("found").alias("f")).groupBy("f").count().where(F.col("count") >= MIN_DOCS)
    names = sorted(r["f"] for r in seen.collect())
    vectors = CountVectorizerModel.from_vocabulary(
        names, inputCol="found", outputCol="features").transform(rows)
    fitted = LogisticRegression(regParam=RIDGE / totals[0], maxIter=60, standardization=False).fit(vectors)
    model.intercept = float(fitted.intercept)
    model.weights = {f: float(w) for f, w in zip(names, fitted.coefficients.toArray()) if w}
    return model


class Scorer:
    """Scores texts, remembering what it made of the words."""

    def __init__(self, model: ToxicityModel):
        self.model, self.known, self.cache, self.bases = model, model.known, {}, {}

    def _known(self, word: str) -> list[str]:
        """The word and its openings as far as the model knows them."""
        found = self.bases.get(word)
        if found is None:
            if len(self.bases) >= CACHE:
                self.bases.clear()
            found = self.bases[word] = [b for b in (word, *openings(word)) if b in self.known]
        return found

    def features(self, words: set[str]) -> set[str]:
        """``features`` of the model's words and openings."""
        bases = Counter(b for w in words for b in self._known(w))
        return {b for b in bases if b[-1] != "*"} | _grouped(
            Counter({b: n for b, n in bases.items() if b[-1] == "*"}), len(words))

    def score(self, text: str | None) -> tuple[float, list[str]]:
        """Score, and the restored words that raise it."""
        words = restored_words(text, self.model.letters, self.cache)
        weights = self.model.weights
        found = self.features(words)
        total = self.model.intercept + sum(weights.get(f, 0.0) for f in sorted(found))
        raising = {_base(f) for f in found if weights.get(f, 0.0) > 0.5}
        shown = sorted(w for w in words if w in raising or any(o in raising for o in openings(w))) if raising else []
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total)))), shown


def score(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """Add ``toxicity`` (score, words) to every row.

    ``score`` is from 0 to 1; null and empty texts get what the model says of no
    words at all. A column named ``toxicity`` is replaced, others stay; repeated
    rows get equal scores.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see fit

    @F.pandas_udf("score double, words array<string>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            rows = [scorer.score(t) for t in texts]
            yield pd.DataFrame({"score": [r[0] for r in rows], "words": [r[1] for r in rows]})

    return docs.withColumn("toxicity", scored(F.col(text_column)))


def rejected(score_column: Column) -> Column:
    return score_column >= STRONG
