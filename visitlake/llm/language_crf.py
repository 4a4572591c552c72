"""Language of words in code-switched text by a linear-chain conditional random field, and of whole texts from it.

A word's score for a language is the sum of learned weights of its affixes and n-grams (hashed) and of the lexicons that
list it; learned transitions tie neighbouring words. Forward-backward gives each word's probabilities, whose mean over
all words of a text is the text's. A chain is a run of at most ``CHAIN`` words of one text; longer texts are several chains.

The model is fitted in numpy to a bounded sample of labelled texts. To learn transitions, training chains are put together
from runs of words of different languages.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlake.llm.batches import frugal, slices

LETTERS = re.compile(r"[^\W\d_]+")
TABLE = 1 << 16
CHAIN = 128
AFFIXES = (1, 2, 3, 4)
TEXTS_AT_ONCE = 256
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased. What looks like a letter to the pattern only, such as a raised digit, is no word."""
    found = LETTERS.findall(text.lower()) if text else []
    return found if all(map(str.isalpha, found)) else [word for word in found if any(map(str.isalpha, word))]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table places of the affixes and n-grams of each word, filled up with ``TABLE``, and a hash of each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max())
    codes = np.zeros((len(words), width + 2), np.uint64)
    codes[:, 0] = 1  # begins with 1, ends with 2
    codes[:, 1:-1] = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
    codes[np.arange(len(words)), lengths + 1] = 2
    found, places = [], np.arange(width + 2)
    whole = np.zeros(len(words), np.uint64)
    for place in range(width + 2):
        whole = np.where(place < lengths + 2, (whole ^ codes[:, place]) * _MIX ^ (whole >> np.uint64(29)), whole)
    for size in (2, 3):
        if size > width + 2:
            continue
        value = np.full((len(words), width + 3 - size), size, np.uint64)
        for i in range(size):
            value = (value ^ codes[:, i:width + 3 - size + i]) * _MIX
        inside = places[:width + 3 - size] + size <= lengths[:, None] + 2
        found.append(np.where(inside, (value >> np.uint64(48)).astype(np.int64), TABLE))
    for size in AFFIXES:
        for salt, start in ((10 + size, np.ones(len(words), np.int64)), (20 + size, np.maximum(lengths - size + 1, 1))):
            value = np.full(len(words), salt, np.uint64)
            for i in range(size):
                value = (value ^ codes[np.arange(len(words)), np.minimum(start + i, width + 1)]) * _MIX
            found.append(np.where(lengths >= size, (value >> np.uint64(48)).astype(np.int64), TABLE)[:, None])
    return np.concatenate(found, axis=1), whole


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # TABLE + 1 rows, the last one zero
    lexicon: np.ndarray  # sorted hashes of listed words
    listed: np.ndarray  # for each of them, 1 for the languages that list it
    lexicon_weights: np.ndarray
    bias: np.ndarray
    transitions: np.ndarray

    def in_lexicon(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(hashes), len(self.languages)))
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return self.listed[at] * (self.lexicon[at] == hashes)[:, None]

    def scores(self, words: list[str]) -> np.ndarray:
        """Scores of different words; words of like length are done together, so that memory follows their letters."""
        result = np.zeros((len(words), len(self.languages)))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            last = at + 1
            limit = max(8, 2 * len(words[order[at]]))
            while last < len(order) and len(words[order[last]]) <= limit and (last - at) * limit < 200_000:
                last += 1
            part = order[at:last]
            places, hashes = features([words[i] for i in part])
            result[part] = self.weights[places].sum(axis=1) + self.in_lexicon(hashes) @ self.lexicon_weights + self.bias
            at = last
        return result


def marginals(scores: np.ndarray, inside: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains (chains x places x languages); ``inside`` marks words, which come before the filling.

    Gives the probabilities of every word, and the expected counts of transitions summed over all chains.
    """
    chains, length, languages = scores.shape
    moves = np.exp(transitions)
    words = np.exp(scores - scores.max(axis=2, keepdims=True))
    forward, backward = np.empty_like(words), np.empty_like(words)
    here = words[:, 0] / words[:, 0].sum(axis=1, keepdims=True)
    forward[:, 0] = here
    for t in range(1, length):
        ahead = (here @ moves) * words[:, t]
        here = np.where(inside[:, t, None], ahead / ahead.sum(axis=1, keepdims=True), here)
        forward[:, t] = here
    here = np.full((chains, languages), 1.0 / languages)
    backward[:, -1] = here
    expected = np.zeros_like(moves)
    for t in range(length - 2, -1, -1):
        onward = words[:, t + 1] * here
        both = forward[:, t, :, None] * moves * onward[:, None, :]
        expected += (both / both.sum(axis=(1, 2), keepdims=True))[inside[:, t + 1]].sum(axis=0)
        behind = onward @ moves.T
        here = np.where(inside[:, t + 1, None], behind / behind.sum(axis=1, keepdims=True), here)
        backward[:, t] = here
    found = forward * backward
    return found / found.sum(axis=2, keepdims=True), expected


def posteriors(scores: np.ndarray, inside: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """As ``marginals``, without the expected transitions."""
    moves = np.exp(transitions)
    words = np.exp(scores - scores.max(axis=2, keepdims=True))
    forward = np.empty_like(words)
    here = words[:, 0] / words[:, 0].sum(axis=1, keepdims=True)
    forward[:, 0] = here
    for t in range(1, words.shape[1]):
        ahead = (here @ moves) * words[:, t]
        here = np.where(inside[:, t, None], ahead / ahead.sum(axis=1, keepdims=True), here)
        forward[:, t] = here
    here = np.ones_like(here)
    for t in range(words.shape[1] - 2, -1, -1):
        behind = (words[:, t + 1] * here) @ moves.T
        here = np.where(inside[:, t + 1, None], behind / behind.sum(axis=1, keepdims=True), here)
        forward[:, t] *= here
    return forward / forward.sum(axis=2, keepdims=True)


def train(samples: list[tuple[str, str]], seed: int = 5, chains: int = 6000, length: int = 32, rounds: int = 4,
          rate: float = 0.3) -> Model:
    """Fit a model to (language, text) pairs; texts without words teach nothing."""
    draw = np.random.default_rng(seed)
    texts: dict[str, list[list[str]]] = {}
    for language, text in samples:
        words = [word for word in words_of(text) if len(word) <= 32]
        if words:
            texts.setdefault(language, []).append(words)
    languages = sorted(texts)
    if not languages:
        return Model([], np.zeros((TABLE + 1, 0)), np.zeros(0, np.uint64), np.zeros((0, 0)), *(np.zeros((0, 0)),) * 3)
    chosen = []
    for _ in range(chains):
        chain = []
        while len(chain) < length:
            label = int(draw.integers(len(languages)))
            options = texts[languages[label]]
            words = options[int(draw.integers(len(options)))]
            start = int(draw.integers(len(words)))
            chain.extend((word, label) for word in words[start:start + int(draw.integers(4, 25))])
        chosen.append(chain[:length])
    numbers: dict[str, int] = {}
    tokens = np.array([[numbers.setdefault(word, len(numbers)) for word, _ in chain] for chain in chosen])
    labels = np.array([[label for _, label in chain] for chain in chosen])
    counts = np.zeros((len(numbers), len(languages)))
    for label, language in enumerate(languages):
        for words in texts[language]:
            for word in words:
                if word in numbers:
                    counts[numbers[word], label] += 1
    places, hashes = features([*numbers])
    usual = counts.max(axis=1) >= 3
    order = np.argsort(hashes[usual])
    model = Model(languages, np.zeros((TABLE + 1, len(languages))), hashes[usual][order],
                  (counts[usual][order] >= 3).astype(float), np.zeros((len(languages),) * 2), np.zeros(len(languages)),
                  np.zeros((len(languages),) * 2))
    lexical = model.in_lexicon(hashes)
    squares = {name: np.full_like(getattr(model, name), 1e-6) for name in ("weights", "lexicon_weights", "bias", "transitions")}

    def step(name, gradient):
        squares[name] += gradient ** 2
        getattr(model, name)[...] -= rate * gradient / np.sqrt(squares[name])

    inside, size = np.ones((64, length), bool), len(languages)
    for _ in range(rounds):
        for batch in np.array_split(draw.permutation(chains), max(1, chains // 64)):
            words, truth = tokens[batch], labels[batch]
            rows = places[words]
            scores = model.weights[rows].sum(axis=2) + lexical[words] @ model.lexicon_weights + model.bias
            found, expected = marginals(scores, inside[:1].repeat(len(batch), axis=0), model.transitions)
            error = (found - np.eye(size)[truth]) / len(batch)
            seen = np.zeros_like(expected)
            np.add.at(seen, (truth[:, :-1].ravel(), truth[:, 1:].ravel()), 1.0)
            flat = error.reshape(-1, size)
            gradient = np.stack([np.bincount(rows.ravel(), np.repeat(flat[:, label], rows.shape[2]), TABLE + 1)
                                 for label in range(size)], axis=1)
            gradient[TABLE] = 0
            step("weights", gradient)
            step("lexicon_weights", lexical[words].reshape(-1, size).T @ flat)
            step("bias", flat.sum(axis=0))
            step("transitions", (expected - seen) / len(batch))
    model.weights = model.weights.astype(np.float32)
    return model


def fit(docs: DataFrame, learn: Column, per_language: int = 150, seed: int = 5, text_column: str = "text",
        language_column: str = "lang") -> Model:
    """Fit to at most ``per_language`` different texts of each language, drawn by a hash among the rows for which ``learn`` holds.

    Every language with labelled texts is learned, so the model grows with their number.
    """
    rows = docs.filter(learn & F.col(language_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(language_column).alias("language"), F.col(text_column).alias("text"),
        F.xxhash64(F.lit(seed), F.col(text_column)).alias("draw"))
    counted = rows.groupBy("language").agg(F.count_distinct("draw").alias("texts")).collect()
    if not counted:
        return train([], seed)
    # About twice the texts wanted pass a bound on the hash, all of them in one scan; the smallest hashes are taken.
    bounds = {"language": [row["language"] for row in counted],
              "bound": [(2 * min(1.0, 2 * per_language / row["texts"]) - 1) * float(2 ** 63) for row in counted]}
    # From Arrow: a list of rows would pass through Python on the executors, in workers of its own that stay there.
    bounds = F.broadcast(docs.sparkSession.createDataFrame(pa.table(bounds)))
    taken = (rows.join(bounds, "language").filter("draw <= bound").groupBy("language", "draw").agg(F.min("text").alias("text"))
             .collect())
    kept: dict[str, list[str]] = {}
    for row in sorted(taken, key=lambda row: (row["draw"], row["text"])):
        if len(kept.setdefault(row["language"], [])) < per_language:
            kept[row["language"]].append(row["text"])
    return train([(language, text) for language, texts in sorted(kept.items()) for text in texts], seed)


def labelled(texts: list[str | None], model: Model):
    """Words of all texts one after the other, their probabilities, and how many each text has."""
    lists = [words_of(text) for text in texts]
    numbers: dict[str, int] = {}
    rows = np.array([numbers.setdefault(word, len(numbers)) for words in lists for word in words], np.int64)
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    if not len(rows) or not model.languages:
        return lists, np.zeros((len(rows), len(model.languages))), counts
    scores = model.scores([*numbers])
    # Chains: the words of each text in runs of CHAIN.
    within = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    chains = np.cumsum((within % CHAIN == 0)) - 1
    places = within % CHAIN
    found = np.empty((len(rows), len(model.languages)))
    for first in range(0, chains[-1] + 1, 1024):
        part = slice(*np.searchsorted(chains, [first, first + 1024]))
        shape = (min(1024, chains[-1] + 1 - first), int(places[part].max()) + 1)
        inside = np.zeros(shape, bool)
        inside[chains[part] - first, places[part]] = True
        grid = np.zeros((*shape, len(model.languages)))
        grid[chains[part] - first, places[part]] = scores[rows[part]]
        found[part] = posteriors(grid, inside, model.transitions)[chains[part] - first, places[part]]
    return lists, found, counts


def with_language(docs: DataFrame, model: Model, column: str = "language", text_column: str = "text") -> DataFrame:
    """All columns and a struct of ``lang_pred`` and ``score`` (0 to 1, the mean probability over all words) of each text.

    A missing or empty text and one without letters is ``und`` with score 0, and so is every text if the model knows no
    language. Of equal languages the first by name wins. Repeated rows get equal results; a column named as the struct
    is replaced.
    """
    docs = docs.drop(column) if column in docs.columns else docs
    at_text = docs.columns.index(text_column)

    def run(batches):
        for batch in slices(batches, at_text):
            names, scores = [], []
            _, found, counts = labelled(batch.column(at_text).to_pylist(), model)
            sums = np.zeros((len(counts), found.shape[1]))
            np.add.at(sums, np.repeat(np.arange(len(counts)), counts), found)
            for total, count in zip(sums, counts):
                if count and len(total):
                    best = int(total.argmax())
                    names.append(model.languages[best])
                    scores.append(min(1.0, float(total[best] / count)))
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
            judged = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                names=["lang_pred", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns, judged], names=[*batch.schema.names, column])

    verdict = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(frugal(run), T.StructType([*docs.schema.fields, T.StructField(column, verdict)]))


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``lang_pred`` and ``score`` of every whole text, as in ``with_language``; other columns are left out."""
    return with_language(docs.select(id_column, text_column), model, "_language", text_column).select(id_column, "_language.*")


def label_words(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and ``words`` of every text: an array of ``word``, ``lang`` and ``probability``, for code-switched text."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                lists, found, counts = labelled(part.column(1).to_pylist(), model)
                rows, first = [], 0
                for words, count in zip(lists, counts):
                    here = found[first:first + count]
                    best = here.argmax(axis=1) if here.size else []
                    rows.append([{"word": word, "lang": model.languages[k], "probability": float(row[k])}
                                 for word, k, row in zip(words, best, here)])
                    first += count
                kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("probability", pa.float64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], names=["id", "words"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        run, f"`{id_column}` {kind}, words array<struct<word: string, lang: string, probability: double>>")
