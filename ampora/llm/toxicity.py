"""Toxicity score: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding takes compatibility forms apart, drops invisible characters, lower-cases, turns look-alike
letters and digits or signs that stand for letters into plain ones (the letters i, l and 1 become one), and
every other character that is no letter, mark or digit into a blank, in any script.  A text is matched with
its accents and without them, as terms may be learned from either form; a word counts once.  A
term is the beginning of a word, a run between blanks.  Terms inside an exception phrase don't count.

The lexicon is learned from labelled texts of the training fold: of all word beginnings,
those that far more toxic texts hold than clean ones, with the log of the ratio as weight;
the shortest that will do stands for all that begin with it.  The weights found in a text, as a sum and
per hundred words, are turned into a probability by a logistic regression on the same texts.
Training uses at most ``TOXIC`` and ``CLEAN`` texts, the first in hash order.

Rows: null and empty texts hold no term.  Without toxic or without clean training texts, the terms in
``SEED`` are the lexicon.  A null ``doc_id`` is scored, and isn't held out.  Further columns
are kept.  An empty table gives an empty table.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, sample_ids, sampled

TOXIC, CLEAN = 3_000, 6_000
SCORED = 250                   # texts scored at once: a bound on a worker's memory
SHORTEST, LONGEST = 3, 10     # letters of a term
LEAST_SHARE = 0.01            # of the toxic texts that hold a term
LEAST_RATIO = 4.0             # log of how much more often toxic texts hold it
CONTINUED = 0.95              # share from which a longer term stands for a shorter one
HIGHER = 0.7                  # by which a longer term must outweigh a shorter one to be kept too
REJECT = 0.5

# Terms used where there are no labels, with their weight, and phrases in which
# a term is harmless.
SEED = {"idiot": 5.0, "moron": 5.0, "scum": 5.0, "stupid": 4.0, "pathetic": 4.0, "worthless": 4.0,
        "disgusting": 4.0, "loser": 4.0}
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "idiot proof", "pond scum",
              "disgusting taste", "stupid question")

# Letters of other scripts that look like Latin ones, and digits and signs used as letters.
_LOOKALIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w",
    "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ı": "i", "ł": "l", "ø": "o",
    "0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e",
}


class _Folding(dict):
    """What becomes of each code point, by its Unicode category; found when it is first seen."""

    def __missing__(self, code: int) -> str | None:
        kind = unicodedata.category(chr(code))
        if kind in ("Cf", "Me"):       # invisible, circles around letters
            to = None
        else:
            to = chr(code) if kind[0] in "LNM" else " "
        self[code] = to
        return to


_FOLD = _Folding({ord(c): "i" if x == "l" else x for c, x in _LOOKALIKE.items()} | {ord("l"): "i"})


class _Plain(_Folding):
    """The same without accents."""

    def __missing__(self, code: int) -> str | None:
        self[code] = None if unicodedata.category(chr(code)) == "Mn" else _FOLD[code]
        return self[code]


_PLAIN = _Plain()


def forms(text: str) -> tuple[str, str]:
    """The text with accents and without them; both have the same blanks."""
    if text.isascii():
        folded = text.lower().translate(_FOLD)
        return folded, folded
    normal = unicodedata.normalize
    accented = normal("NFC", normal("NFKC", text).lower().translate(_FOLD))
    return accented, normal("NFC", normal("NFD", accented).translate(_PLAIN))


def fold(text: str) -> str:
    """The text without accents, as the given terms and phrases are matched in it."""
    return forms(text)[1]


@dataclass
class Lexicon:
    """Terms (folded) with weights, exception phrases (folded) and the calibration."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float] = (-3.0, 2.0, 2.0)   # constant, per log of the sum, per log of the density

    @cached_property
    def automaton(self):  # noqa: ANN201 - an ahocorasick.Automaton
        import ahocorasick

        made = ahocorasick.Automaton()
        for phrase in self.exceptions:
            made.add_word(f" {phrase} ", (len(phrase) + 2, None))
        for term, weight in self.weights.items():
            made.add_word(f" {term}", (len(term) + 1, weight))
        if len(made):
            made.make_automaton()
        return made

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def _matches(self, folded: str) -> tuple[dict[int, float], set[int]]:
        """(heaviest term of each word that has one, words of exception phrases), by the word's number of blanks before it."""
        hits: dict[int, float] = {}
        phrases: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                phrases.append((start, folded.count(" ", start + 1, end)))
            else:
                hits[start] = max(weight, hits.get(start, 0.0))
        number, at, blanks = {}, 0, 0
        for start in sorted({*hits, *(x[0] for x in phrases)}):
            blanks += folded.count(" ", at, start)
            number[start], at = blanks, start
        return {number[x]: w for x, w in hits.items()}, {number[x] + k for x, more in phrases for k in range(more + 1)}

    def found(self, text: str) -> tuple[float, int]:
        """(sum of the weights of the terms found, number of words)."""
        accented, plain = (f" {x} " for x in forms(text))
        words = len(plain.split())
        if not len(self.automaton):
            return 0.0, words
        hits, spared = self._matches(plain)
        if accented != plain:
            more, also = self._matches(accented)
            spared |= also
            for at, w in more.items():
                hits[at] = max(w, hits.get(at, 0.0))
        return sum(w for at, w in sorted(hits.items()) if at not in spared), words

    def measure(self, text: str) -> tuple[float, float]:
        total, words = self.found(text)
        return np.log1p(total), np.log1p(100 * total / max(words, 1))

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.measure(t or "") for t in texts]).reshape(-1, 2)
        c, a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(c + a * x[:, 0] + b * x[:, 1], -30, 30)))


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small penalty; the measures' weights aren't negative."""
    design = np.column_stack([np.ones(len(x)), x])
    w = np.array([-2.0, 1.0, 1.0])
    penalty = np.array([1e-3, 1e-2, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + penalty * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty + 1e-6)
        step = np.linalg.solve(curve, slope)
        w = w - np.clip(step, -1, 1)
        w[1:] = np.maximum(w[1:], 0)
    return float(w[0]), float(w[1]), float(w[2])


def _beginnings(text: Column) -> Column:
    def begin(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sorted({w[:k] for w in {w for x in forms(t or "") for w in x.split()}
                                    for k in range(SHORTEST, min(LONGEST, len(w)) + 1)})
                            for t in batch.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(begin, "array<string>")(text)


def chosen_terms(likely: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Weights of the terms to keep, from (toxic texts, weight) of all likely word beginnings.

    A beginning that a longer one nearly always continues says no more than the longer one,
    which is less likely to be in harmless words.  A longer one whose weight isn't higher than that
    of a kept beginning of it is covered.
    """
    longer: dict[str, int] = {}
    for term, (t, _) in likely.items():
        longer[term[:-1]] = max(longer.get(term[:-1], 0), t)
    weights: dict[str, float] = {}
    for term in sorted(likely, key=lambda x: (len(x), x)):
        t, w = likely[term]
        if longer.get(term, 0) >= CONTINUED * t:
            continue
        if w > HIGHER + max((weights.get(term[:k], -HIGHER) for k in range(SHORTEST, len(term))), default=-HIGHER):
            weights[term] = w
    return weights


def learn(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from the labels' training fold."""
    phrases = tuple(" ".join(fold(p).split()) for p in exceptions)
    seed = Lexicon({fold(t): w for t, w in SEED.items()}, phrases)
    chosen = sample_ids(labels, F.col("toxic") == 1, TOXIC, "t").union(
        sample_ids(labels, F.col("toxic") == 0, CLEAN, "c"))
    # at most TOXIC + CLEAN ids: a broadcast of bounded size
    rows = sampled(docs, chosen).select("role", "text")
    sizes = {r["role"]: r["n"] for r in rows.groupBy("role").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return seed
    toxic, clean = sizes["t"], sizes["c"]
    counted = (rows.select("role", F.explode(_beginnings(F.col("text"))).alias("term")).groupBy("term")
               .agg(F.sum((F.col("role") == "t").cast("int")).alias("t"), F.sum((F.col("role") == "c").cast("int")).alias("c")))
    weight = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    # each toxic text holds a bounded share of terms, so at most a few thousand pass
    likely = (counted.where(F.col("t") >= max(5, LEAST_SHARE * toxic)).withColumn("w", weight)
              .where(F.col("w") >= LEAST_RATIO).select("term", "t", "w").collect())
    weights = chosen_terms({r["term"]: (int(r["t"]), float(r["w"])) for r in likely})
    if not weights:
        return seed
    found = Lexicon(weights, phrases)
    pairs = rows.select((F.col("role") == "t").cast("int").alias("y"), _measured(F.col("text"), found).alias("x")).toPandas()
    found.curve = _calibrated(np.array(pairs["x"].tolist()).reshape(-1, 2), pairs["y"].to_numpy())
    return found


def _measured(text: Column, lexicon: Lexicon) -> Column:
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([list(lexicon.measure(t or "")) for t in batch.to_pylist()], pa.list_(pa.float64()))

    return F.arrow_udf(measure, "array<double>")(text)


def toxicity_score(text: Column, lexicon: Lexicon) -> Column:
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.concatenate([np.empty(0), *(
                lexicon.scores(batch.slice(at, SCORED).to_pylist()) for at in range(0, len(batch), SCORED))]))

    return F.arrow_udf(score, "double")(text).alias("score")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    lexicon = learn(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity_score(F.col("text"), lexicon))
    return scored.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """The documents that aren't toxic; their columns stay."""
    lexicon = learn(docs if training is None else training, labels)
    return docs.where(toxicity_score(F.col("text"), lexicon) < REJECT)
