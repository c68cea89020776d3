"""Language of a text, and of its spans where languages mix.

The script of a word's letters narrows the candidates to languages that use it.
Each candidate scores the word by a character trigram model. A Viterbi path
over the words of a text then labels each with a language, where a change of
language costs ``SWITCH``; its spans are the runs of one label.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asphalt.llm.batches import text_batches
from asphalt.llm.folds import held_out, kept_share

# Documents of each language that the models are counted on, at most about this many.
MAX_PER_LANGUAGE = 3_000
MAX_LANGUAGES = 1_000
SWITCH = 10.0
SMOOTHING = 0.5
SCRIPT_SHARE = 0.01  # of a language's letters that a script needs to count as used
NO_CANDIDATE = -30.0
CACHE = 200_000
UNKNOWN = "und"

# First and last code point of the letters of a script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)],
}
_NAMES = [*SCRIPTS, "other"]
_RANGES = sorted((low, high, i) for i, ranges in enumerate(SCRIPTS.values()) for low, high in ranges)
_LOWS = np.array([r[0] for r in _RANGES])

words_of = re.compile(r"[^\W\d_]+").findall


def script(word: str) -> int:
    """Script of most letters of a word; ties go to the first letter's."""
    if word.isascii():
        return 0
    points = np.fromiter(map(ord, word), dtype=np.int64, count=len(word))
    at = np.searchsorted(_LOWS, points, side="right") - 1
    found = [_RANGES[i][2] if i >= 0 and p <= _RANGES[i][1] else len(SCRIPTS) for i, p in zip(at, points)]
    counts = Counter(found)
    return max(counts, key=lambda s: (counts[s], s == found[0], -s))


def trigrams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i:i + 3] for i in range(len(padded) - 2)]


@dataclass
class LanguageModel:
    languages: list[str]
    index: dict[str, int]  # trigram to row
    scores: np.ndarray  # log probability of a trigram in each language; the last row is for unknown ones
    uses: np.ndarray  # script, language: whether the language uses it
    default: int  # the language with most learning rows


def fit(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    max_per_language: int = MAX_PER_LANGUAGE, seed: int = 7,
) -> LanguageModel:
    """Trigram and script counts on the learning fold, about ``max_per_language`` documents of each language.

    Rows without a language, a text or an id, and ids of the held-out fold, are not learned from.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    rows = rows.where(~held_out(F.col("doc_id"))).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], {}, np.zeros((1, 0)), np.zeros((len(_NAMES), 0), dtype=bool), 0)
    share = F.element_at(F.create_map(*[
        F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, max_per_language / n))]), F.col("lang"))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for lang, texts in batch.groupby("lang")["text"]:
                words = Counter(w for t in texts for w in words_of(t.lower()))
                for word, n in words.items():
                    counts[lang][f"#{script(word)}"] += n * len(word)
                    for gram in trigrams(word):
                        counts[lang][gram] += n
            flat = [(lang, gram, n) for lang, found in counts.items() for gram, n in found.items()]
            yield pd.DataFrame(flat, columns=["lang", "gram", "n"])

    sample = rows.where(kept_share(F.col("doc_id"), share, seed)).select("lang", "text")
    sums = sample.mapInPandas(counted, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = sums.collect()  # bounded by max_per_language texts of each language
    spot = {lang: i for i, lang in enumerate(languages)}
    index: dict[str, int] = {}
    letters = np.zeros((len(_NAMES), len(languages)))
    for r in found:
        if r["gram"][0] == "#":
            letters[int(r["gram"][1:]), spot[r["lang"]]] = r["n"]
        else:
            index.setdefault(r["gram"], len(index))
    counts = np.zeros((len(index) + 1, len(languages)))
    for r in found:
        if r["gram"][0] != "#":
            counts[index[r["gram"]], spot[r["lang"]]] = r["n"]
    smooth = counts + SMOOTHING
    uses = letters > SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0))
    return LanguageModel(languages, index, np.log(smooth / smooth.sum(axis=0)), uses, max(spot.values(), key=lambda i: sizes[languages[i]]))


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; a change between neighbours costs ``switch``. Ties keep the label, then the first.

    Staying with the best single label is optimal if no stretch of words gains
    more than ``switch`` by another label, and no first and last stretch do
    together: a path that has the best label somewhere pays at least one change
    for each stretch of others, one without it pays for all but one of them.
    """
    best = int(scores.sum(axis=0).argmax())
    gains = np.cumsum(scores - scores[:, best:best + 1], axis=0)
    lowest = np.minimum.accumulate(np.vstack((np.zeros(scores.shape[1]), gains[:-1])), axis=0)
    ends = gains[:-1].max(initial=0.0) + (gains[-1] - gains[:-1]).max(initial=0.0)
    if (gains - lowest).max(initial=0.0) <= switch and ends <= switch:
        return np.full(len(scores), best)
    total, back = scores[0].tolist(), []
    labels = range(scores.shape[1])
    for row in scores[1:].tolist():
        top = max(labels, key=total.__getitem__)
        limit = total[top] - switch
        back.append([k if total[k] >= limit else top for k in labels])
        total = [max(total[k], limit) + row[k] for k in labels]
    path = [max(labels, key=total.__getitem__)]
    for row in reversed(back):
        path.append(row[path[-1]])
    return np.array(path[::-1])


class Labeller:
    """Labels texts, remembering the scores of words."""

    def __init__(self, model: LanguageModel):
        self.model, self.known, self.rows = model, {}, []

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE:
            self.known, self.rows = {}, []
            self.table = np.zeros((0, len(self.model.languages)))
        new = [w for w in words if w not in self.known]
        if not new and self.rows:
            return
        get, unknown = self.model.index.get, len(self.model.index)
        codes, starts = [], []
        for word in new:
            starts.append(len(codes))
            codes.extend(get(g, unknown) for g in trigrams(word))
        if new:
            scores = np.add.reduceat(self.model.scores[codes], starts, axis=0)
            used = self.model.uses[[script(w) for w in new]]
            none = ~used.any(axis=1)
            scores[~used] += NO_CANDIDATE
            scores[none] = 0.0  # no language writes it: it says nothing
            for word in new:
                self.known[word] = len(self.known)
            self.rows.append(scores)
            self.table = np.vstack(self.rows)
            self.rows = [self.table]

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list]]:
        """Language, score and spans (language, first word, last word + 1) of each text."""
        found = [words_of(t.lower()) if t else [] for t in texts]
        if not self.model.languages:
            return [(UNKNOWN, 0.0, []) for _ in texts]
        self._learn({w for words in found for w in words})
        return [self._label(words) for words in found]

    def _label(self, words: list[str]) -> tuple[str, float, list]:
        if not words:
            return UNKNOWN, 0.0, []
        names, known = self.model.languages, self.known
        scores = self.table[np.fromiter((known[w] for w in words), dtype=np.int64, count=len(words))]
        if not scores.any():
            return names[self.model.default], 0.0, [(UNKNOWN, 0, len(words))]
        path = viterbi(scores)
        letters = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        share = np.bincount(path, weights=letters, minlength=len(names))
        top = int(share.argmax())
        own = scores[path == top].sum(axis=0)
        margin = float(own[top] - np.delete(own, top).max()) if len(names) > 1 else 50.0
        edges = np.flatnonzero(np.diff(path)) + 1
        spans = [(names[path[a]], int(a), int(b)) for a, b in zip([0, *edges], [*edges, len(path)])]
        return names[top], float(share[top] / share.sum()) / (1 + math.exp(-max(-50.0, min(50.0, margin)))), spans


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """Add ``language`` (lang, score, spans) to every row; a column of that name is replaced.

    ``lang`` labels most letters; ``score`` is their share, times the chance
    against the next language by the words' scores. Texts without a letter and
    null texts are ``und`` with score 0 and no span. Words in a script that no
    learned language uses say nothing; a text of such words only gets the
    language with most learning rows, score 0 and an ``und`` span. Repeated rows
    get equal results.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: see fit

    @F.pandas_udf("lang string, score double, spans array<struct<lang: string, first: int, last: int>>")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(shared.value)
        for texts in batches:
            rows = labeller.label(list(texts))
            yield pd.DataFrame({
                "lang": [r[0] for r in rows], "score": [r[1] for r in rows],
                "spans": [[dict(zip(("lang", "first", "last"), s)) for s in r[2]] for r in rows],
            })

    return docs.withColumn("language", labelled(F.col(text_column)))
