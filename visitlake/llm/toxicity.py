"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of hashed embeddings of the word and of its first letters, so that a word not seen before
shares what its stem has. Filters of several widths run over the whole text, each keeps its largest value, and a logistic
unit weighs them. Thresholds are calibrated on texts kept from training, one for each language; the language is guessed
from the text by its function words, never taken from a column. A bounded sample only gives the values to start from: then
Spark tasks learn from all labelled texts, a fifth of them aside, and their models are averaged. The thresholds come from
counts over that whole fifth, in which a text counts for the labelled documents that hold it, on average of its label.

At scoring, the contribution of every different word of a batch to every place of every filter is worked out once; a
filter then is a sum of looked-up rows.
"""

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.llm.batches import slices
from visitlake.llm.url_filter import blocks_for, bloom_filter, may_hold
from visitlake.session import staged

LETTERS = re.compile(r"[^\W\d_]+")
TABLE, DIMENSIONS, FILTERS, WIDTHS = 1 << 15, 8, 8, (1, 2, 3)
PIECES = (None, 4, 5)  # the whole word, and how many first letters
PADDING = max(WIDTHS) - 1
THRESHOLD = 0.7
TEXTS_AT_ONCE = 128
PLACES_AT_ONCE = 1 << 18
PART_TEXTS, MOST_PARTS = 4096, 64  # texts that one task learns from, and into how many tasks a large table is divided
BLOCKS = 16  # pieces of the table of embeddings in which the parts' models are merged
CUTS = 1 << 16  # thresholds lie on a grid of this many steps
ARRAYS = ("embeddings", "filter_bias", "output", "bias")
# Frequent function words by language.
FUNCTION_WORDS = {
    "de": "der die das und den von zu mit ist nicht ein eine dem sich auf für",
    "en": "the of and to in is that it for was on are with as be by",
    "es": "de la que el en los se del las un por con una su para al",
    "fr": "de la le les et des un une du que dans qui par sur pour est",
}
_GUESSES = [(name, frozenset(words.split())) for name, words in FUNCTION_WORDS.items()]


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def guess(counts: dict[str, int]) -> int:
    """Number of the language with most function words among counted words; one more than the last where there are none."""
    found = [sum(counts.get(word, 0) for word in words) for _, words in _GUESSES]
    return found.index(max(found)) if any(found) else len(found)


def places(word: str) -> list[int]:
    return [zlib.crc32(word[:size].encode(), number) % TABLE for number, size in enumerate(PIECES)]


@dataclass
class Model:
    embeddings: np.ndarray  # TABLE x DIMENSIONS
    filters: list[np.ndarray]  # for each width: width x DIMENSIONS x FILTERS
    filter_bias: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    thresholds: np.ndarray  # by guessed language

    def probabilities(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Probability and guessed language of whole texts."""
        numbers: dict[str, int] = {}
        rows, starts, languages = [], [], []
        for text in texts:
            starts.append(len(rows))
            rows.extend([-1] * PADDING)
            own = [numbers.setdefault(word, len(numbers)) for word in words_of(text)]
            rows.extend(own)
            languages.append(_guess_numbers(own, numbers))
        rows = np.array(rows + [-1] * PADDING, np.int64)
        size = len(numbers)
        vectors = np.zeros((size + 1, DIMENSIONS), np.float32)  # the last row is padding
        if size:
            vectors[:size] = self.embeddings[np.array([places(word) for word in numbers])].sum(axis=1)
        starts, count = np.array(starts, np.int64), len(rows) - PADDING
        pooled = [np.full((len(starts), FILTERS), -np.inf, np.float32) for _ in self.filters]
        taps = [[vectors @ tap for tap in filters] for filters in self.filters]
        # The places of a long text are taken in parts; its maximum is that of its parts.
        for begin in range(0, count, PLACES_AT_ONCE):
            end = min(count, begin + PLACES_AT_ONCE)
            first = np.searchsorted(starts, begin, "right") - 1
            cuts = np.maximum(starts[first:np.searchsorted(starts, end)] - begin, 0)
            for found, own in zip(pooled, taps):
                total = sum(tap[rows[begin + step:end + step]] for step, tap in enumerate(own))
                here = slice(first, first + len(cuts))
                found[here] = np.maximum(found[here], np.maximum.reduceat(total, cuts, axis=0))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.filter_bias, 0)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.output + self.bias, -30, 30))), np.array(languages)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated: a text scores ``THRESHOLD`` where its probability meets its language's threshold."""
        found, languages = self.probabilities(texts)
        limit = self.thresholds[languages]
        above = THRESHOLD + (1 - THRESHOLD) * (found - limit) / (1 - limit)
        below = np.minimum(THRESHOLD * found / limit, np.nextafter(THRESHOLD, 0))
        return np.where(found >= limit, above, below)


def _guess_numbers(own: list[int], numbers: dict[str, int]) -> int:
    counted = np.bincount(own) if own else np.zeros(0, np.int64)
    counts = {word: int(counted[numbers[word]]) for _, words in _GUESSES for word in words
              if word in numbers and numbers[word] < len(counted)}
    return guess(counts)


def train(samples: list[tuple[str, int]], seed: int = 3, rounds: int = 6, batch: int = 64, rate: float = 0.1,
          weights: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Fit to (text, label) pairs; a fifth of them only calibrates the thresholds, where ``weights`` holds by label."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(samples))
    kept, taught = order[: len(order) // 5], order[len(order) // 5:]
    numbers: dict[str, int] = {}
    texts = [np.array([numbers.setdefault(word, len(numbers)) for word in words_of(text)], np.int64) for text, _ in samples]
    labels = np.array([label for _, label in samples], np.float64)
    pieces = np.array([places(word) for word in numbers], np.int64).reshape(-1, len(PIECES))
    width = len(WIDTHS) * FILTERS
    model = Model(draw.normal(0, 0.1, (TABLE, DIMENSIONS)), [draw.normal(0, 0.3, (w, DIMENSIONS, FILTERS)) for w in WIDTHS],
                  np.zeros(width), draw.normal(0, 0.3, width), np.zeros(1), np.full(len(_GUESSES) + 1, 0.5))
    _start(model, texts, labels, pieces, taught)
    step = _stepper(rate)
    for _ in range(rounds):
        for some in np.array_split(draw.permutation(taught), max(1, len(taught) // batch)):
            if len(some):
                _learn(model, [texts[i] for i in some], labels[some], pieces, step)
    model = _as(model, np.float32)
    model.thresholds = _thresholds(model, [samples[i] for i in kept], np.array(weights))
    return model


def _stepper(rate: float):
    """Steps down a gradient, shorter where gradients were large before."""
    squares: dict[int, np.ndarray] = {}

    def step(array, gradient, rows=...):
        square = squares.setdefault(id(array), np.full_like(array, 1e-4))
        square[rows] += gradient ** 2
        array[rows] -= rate * gradient / np.sqrt(square[rows])

    return step


def _as(model: Model, kind: type) -> Model:
    """A copy with numbers of a kind."""
    arrays = {name: getattr(model, name).astype(kind) for name in ARRAYS}
    return Model(filters=[filters.astype(kind) for filters in model.filters], thresholds=model.thresholds.copy(), **arrays)


def _start(model, texts, labels, pieces, taught) -> None:
    """The first dimension starts from how much more often toxic texts hold a piece; each width has a filter for it."""
    seen = np.zeros((2, TABLE))
    for i in taught:
        seen[int(labels[i]), np.unique(pieces[np.unique(texts[i])])] += 1
    totals = np.bincount(labels[taught].astype(int), minlength=2)
    ratio = np.log((seen[1] + 0.5) / (totals[1] + 1)) - np.log((seen[0] + 0.5) / (totals[0] + 1))
    model.embeddings[:, 0] = 0.3 * np.where(seen.sum(axis=0) >= 2, np.clip(ratio, -3, 3), 0)
    for number, filters in enumerate(model.filters):
        filters[:, 0, 0] = 1.0
        model.output[number * FILTERS] = 0.5


def _learn(model, texts, labels, pieces, step) -> None:
    """One step down the gradient of the logistic loss; only the place where a filter is largest gets a gradient."""
    rows, starts = [], []
    padding = np.full(PADDING, len(pieces))
    at = 0
    for text in texts:
        starts.append(at)
        rows.extend([padding, text])
        at += PADDING + len(text)
    rows = np.concatenate([*rows, padding])
    used, inverse = np.unique(rows, return_inverse=True)
    real = used < len(pieces)
    vectors = np.zeros((len(used), DIMENSIONS))
    vectors[real] = model.embeddings[pieces[used[real]]].sum(axis=1)
    count, ends = len(rows) - PADDING, [*starts[1:], len(rows) - PADDING]
    values, chosen = [], []
    for filters in model.filters:
        total = sum((vectors @ taps)[inverse[i:i + count]] for i, taps in enumerate(filters))
        best = np.array([start + total[start:end].argmax(axis=0) for start, end in zip(starts, ends)])
        chosen.append(best)
        values.append(np.take_along_axis(total, best, axis=0))
    pooled = np.concatenate(values, axis=1) + model.filter_bias
    hidden = np.maximum(pooled, 0)
    found = 1 / (1 + np.exp(-np.clip(hidden @ model.output + model.bias, -30, 30)))
    error = (found - labels) / len(labels)
    back = np.outer(error, model.output) * (pooled > 0)
    moved = np.zeros_like(vectors)
    for number, filters in enumerate(model.filters):
        part = back[:, number * FILTERS:(number + 1) * FILTERS]
        gradient = np.zeros_like(filters)
        for i, taps in enumerate(filters):
            words = inverse[chosen[number] + i]
            gradient[i] = np.einsum("df,dfe->ef", part, vectors[words])
            np.add.at(moved, words, part[:, :, None] * taps.T[None])
        step(filters, gradient)
    step(model.output, hidden.T @ error)
    step(model.bias, error.sum(keepdims=True))
    step(model.filter_bias, back.sum(axis=0))
    touched = np.flatnonzero(real & (moved != 0).any(axis=1))
    table_rows, at = np.unique(pieces[used[touched]], return_inverse=True)
    gradient = np.zeros((len(table_rows), DIMENSIONS))
    np.add.at(gradient, at.reshape(len(touched), -1), moved[touched][:, None, :])
    step(model.embeddings, gradient, table_rows)


def _thresholds(model, samples, weights) -> np.ndarray:
    """For each guessed language the threshold with the best F1 on texts kept from training; that of all texts where few are."""
    limits = np.full(len(_GUESSES) + 1, 0.5)
    if not samples:
        return limits
    found, languages = [], []
    for at in range(0, len(samples), TEXTS_AT_ONCE):
        some, guessed = model.probabilities([text for text, _ in samples[at:at + TEXTS_AT_ONCE]])
        found.append(some)
        languages.append(guessed)
    found, languages = np.concatenate(found), np.concatenate(languages)
    labels = np.array([label for _, label in samples])
    limits[:] = _best(found, labels, 0.5, weights)
    for number in range(len(_GUESSES)):
        own = languages == number
        if labels[own].sum() >= 10:
            limits[number] = _best(found[own], labels[own], limits[-1], weights)
    return limits


def _best(found, labels, otherwise, weights) -> float:
    """Half way between the probabilities around the best cut; ``weights`` says how many texts one of each label counts for."""
    if not 0 < labels.sum() < len(labels):
        return otherwise
    order = np.argsort(-found, kind="stable")
    counted = weights[labels[order]]
    right = np.cumsum(counted * labels[order])
    f1 = 2 * right / (np.cumsum(counted) + right[-1])
    cut = int(np.flatnonzero(f1 == f1.max())[-1])
    following = found[order[cut + 1]] if cut + 1 < len(order) else 0.0
    return float(np.clip((found[order[cut]] + following) / 2, 0.01, 0.99))


def learn_part(model: Model, pairs, batch: int = 64, rate: float = 0.02) -> tuple[Model, int]:
    """The model after one pass over (text, label) pairs, and how many these were. Only one batch of them is held."""
    own, step, count, some = _as(model, np.float64), _stepper(rate), 0, []

    def flush():
        numbers: dict[str, int] = {}
        texts = [np.array([numbers.setdefault(word, len(numbers)) for word in words_of(text)], np.int64) for text, _ in some]
        pieces = np.array([places(word) for word in numbers], np.int64).reshape(-1, len(PIECES))
        _learn(own, texts, np.array([label for _, label in some], np.float64), pieces, step)

    for pair in pairs:
        some.append(pair)
        if len(some) == batch:
            flush()
            count, some = count + batch, []
    if some:
        flush()
    return own, count + len(some)


def merge(model: Model, learned: list[tuple[Model, int]]) -> Model:
    """The model moved by the parts' mean change, by their numbers of texts; a word's row by that of the parts that met it."""
    changes = ((count, *_changed(model, part)) for part, count in learned)
    return _merged(model, learned, _mean_change(changes, TABLE))


def _changed(model: Model, part: Model) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embeddings that a part changed, and by how much."""
    change = part.embeddings - model.embeddings
    rows = np.flatnonzero((change != 0).any(axis=1))
    return rows, change[rows]


def _mean_change(changes, size: int) -> np.ndarray:
    moved, met = np.zeros((size, DIMENSIONS)), np.zeros((size, 1))
    for count, rows, change in changes:
        moved[rows] += count * change
        met[rows] += count
    return moved / np.maximum(met, 1)


def _merged(model: Model, learned: list[tuple[Model, int]], change: np.ndarray) -> Model:
    """The model with its embeddings moved by ``change`` and the mean of the parts' other arrays."""
    sizes = np.array([count for _, count in learned], np.float64)
    merged = _as(model, np.float64)
    for name in ARRAYS[1:]:
        setattr(merged, name, np.average([getattr(part, name) for part, _ in learned], axis=0, weights=sizes))
    merged.filters = [np.average([part.filters[k] for part, _ in learned], axis=0, weights=sizes) for k in range(len(model.filters))]
    merged.embeddings += change
    return _as(merged, np.float32)


def learn_everywhere(model: Model, taught: DataFrame, count: int, passes: int) -> Model:
    """Passes over all rows ``text, label, place``. Each task learns from its own rows and gives the rows of embeddings that it
    changed; their means are made in tasks too, a block of the table in each. The driver gets these means, 2 MB in all, and
    the other arrays of each part, 2 KB."""
    parts = min(MOST_PARTS, max(1, -(-count // PART_TEXTS)))
    spread = taught.repartition(parts, "place").sortWithinPartitions("place").select("text", "label")
    for _ in range(passes):
        def run(batches, start=model):
            pairs = (pair for piece in slices(batches, 0) for pair in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()))
            found, texts = learn_part(start, pairs)
            if texts:
                yield _packed(start, _as(found, np.float32), TaskContext.get().partitionId(), texts)

        learned = (spread.mapInArrow(run, f"block int, {PART_COLUMNS}").groupBy("block")
                   .applyInArrow(_merge_block, f"block int, {PART_COLUMNS}").collect())
        whole = sorted((row for row in learned if row["block"] < 0), key=lambda row: row["part"])
        if whole:
            blocks = {row["block"]: np.frombuffer(row["arrays"], np.float64).reshape(-1, DIMENSIONS) for row in learned
                      if row["block"] >= 0}
            change = np.concatenate([blocks.get(block, np.zeros((TABLE // BLOCKS, DIMENSIONS))) for block in range(BLOCKS)])
            model = _merged(model, [(_unpacked(model, row["arrays"]), row["texts"]) for row in whole], change)
    return model


PART_COLUMNS = "part int, texts bigint, rows binary, arrays binary"


def _packed(start: Model, found: Model, part: int, texts: int) -> pa.RecordBatch:
    """A part's model: its small arrays as block -1, and for each block of the embeddings the rows that it changed."""
    flat = np.concatenate([array.ravel() for array in (*[getattr(found, name) for name in ARRAYS[1:]], *found.filters)])
    rows, change = _changed(start, found)
    cuts = np.searchsorted(rows, np.arange(BLOCKS + 1) * (TABLE // BLOCKS))
    given = [(-1, np.zeros(0, np.int32), flat)] + [
        (block, (rows[first:last] % (TABLE // BLOCKS)).astype(np.int32), change[first:last])
        for block, (first, last) in enumerate(zip(cuts, cuts[1:])) if last > first]
    return pa.RecordBatch.from_arrays([
        pa.array([block for block, _, _ in given], pa.int32()), pa.array([part] * len(given), pa.int32()),
        pa.array([texts] * len(given), pa.int64()), pa.array([numbers.tobytes() for _, numbers, _ in given], pa.binary()),
        pa.array([array.tobytes() for _, _, array in given], pa.binary())], names=["block", "part", "texts", "rows", "arrays"])


def _merge_block(parts: pa.Table) -> pa.Table:
    """One row with the mean change of a block; the small arrays of all parts as they are."""
    given = sorted(parts.to_pylist(), key=lambda row: row["part"])
    if given[0]["block"] < 0:
        return parts
    changes = ((row["texts"], np.frombuffer(row["rows"], np.int32), np.frombuffer(row["arrays"], np.float32).reshape(-1, DIMENSIONS))
               for row in given)
    merged = _mean_change(changes, TABLE // BLOCKS)
    return pa.Table.from_pylist([given[0] | {"rows": b"", "arrays": merged.tobytes()}], parts.schema)


def _unpacked(like: Model, packed: bytes) -> Model:
    """A part's small arrays, with the embeddings of ``like``."""
    flat, at, found = np.frombuffer(packed, np.float32), 0, []
    for array in (*[getattr(like, name) for name in ARRAYS[1:]], *like.filters):
        found.append(flat[at:at + array.size].reshape(array.shape))
        at += array.size
    named = dict(zip(ARRAYS[1:], found))
    return Model(embeddings=like.embeddings, filters=found[len(ARRAYS) - 1:], thresholds=like.thresholds, **named)


def calibrated(model: Model, held: DataFrame, weights: tuple[float, float]) -> Model:
    """The model with thresholds from all rows ``text, label``: Spark counts them by guessed language, place on the grid and label."""
    def run(batches):
        for part in slices(batches, 0):
            found, languages = model.probabilities(part.column(0).to_pylist())
            cut = np.floor(np.clip(found, 0, 1) * CUTS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(languages.astype(np.int64)), pa.array(cut), part.column(1)],
                                             names=["language", "cut", "label"])

    rows = (held.select("text", "label").mapInArrow(run, "language bigint, cut bigint, label int")
            .groupBy("language", "cut", "label").agg(F.count("*").alias("texts")).collect())
    counted = np.zeros((len(_GUESSES) + 1, 2, CUTS + 1), np.int64)
    for row in rows:
        counted[row["language"], row["label"], row["cut"]] += row["texts"]
    found = _as(model, np.float32)
    found.thresholds[:] = _best_cut(counted.sum(axis=0), model.thresholds[-1], weights)
    for number in range(len(_GUESSES)):
        if counted[number, 1].sum() >= 10:
            found.thresholds[number] = _best_cut(counted[number], found.thresholds[-1], weights)
    return found


def _best_cut(counted: np.ndarray, otherwise: float, weights: tuple[float, float]) -> float:
    """Like ``_best``, of numbers of texts by label and place on the grid."""
    places_held = np.flatnonzero(counted.sum(axis=0))[::-1]
    clean, toxic = (np.cumsum(counted[label, places_held] * weights[label]) for label in (0, 1))
    if not len(places_held) or not clean[-1] or not toxic[-1]:
        return otherwise
    f1 = 2 * toxic / (clean + toxic + toxic[-1])
    cut = int(np.flatnonzero(f1 == f1.max())[-1])
    following = places_held[cut + 1] + 1 if cut + 1 < len(places_held) else 0
    return float(np.clip((places_held[cut] + following) / 2 / CUTS, 0.01, 0.99))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = 3000, seed: int = 3, id_column: str = "doc_id",
        text_column: str = "text", label_column: str = "toxic", passes: int = 2) -> Model:
    """Fit to all different texts of label rows for which ``learn`` holds.

    The start is fitted to at most ``per_label`` of them for each label, drawn by a hash; tasks then learn from all of them,
    ``passes`` times, but for a fifth, all of which calibrates the thresholds. A document labelled more than once, or with
    several texts, is toxic if one of its labels says so, and so is a text of several documents; missing labels and texts
    teach nothing. The thresholds are those for the mix of labels among all labelled documents with a text.
    """
    identity, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    known = labels.filter(learn & F.col(label_column).isNotNull()).groupBy(identity.alias("id")).agg(
        F.max((F.col(label_column) > 0).cast("int")).alias("label"))
    with_text = docs.filter(text.isNotNull()).select(identity.alias("id"), F.xxhash64(text).alias("text_hash"))
    labelled = staged(with_text.join(known, "id"), "labelled")
    counts = {row["label"]: row["count"] for row in labelled.groupBy("label").count().collect()}
    # One row per text: copies, whatever their ids, teach as one.
    texts = staged(labelled.groupBy("text_hash").agg(F.min("id").alias("id"), F.max("label").alias("label")), "labelled-texts")
    draw = F.xxhash64(F.lit(seed), "text_hash").alias("place")
    whole = docs.select(identity.alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = staged(texts_of(whole, texts).select("*", draw), "taught-texts")
    # The sample is chosen among places and hashes; only its own texts leave the tasks, at most 2 * per_label.
    placed, place, hashed = texts.select("label", draw, "text_hash"), F.col("place"), F.col("text_hash")
    bounds = [placed.filter(F.col("label") == label).orderBy(place, hashed).limit(per_label)
              .agg(F.max(F.struct(place, hashed)).alias("last")).first()["last"] for label in (0, 1)]
    chosen = [(F.col("label") == label) & ((place < last[0]) | ((place == last[0]) & (hashed <= last[1])))
              for label, last in enumerate(bounds) if last]
    sample = sorted(rows.filter(reduce(Column.__or__, chosen, F.lit(False))).collect(), key=lambda row: (row["place"], row["text_hash"]))
    drawn = Counter(row["label"] for row in sample)
    clean, toxic = (max(1.0, counts.get(label, 0) / max(1, drawn[label])) for label in (0, 1))
    model = train([(row["text"], row["label"]) for row in sample], seed, weights=(clean, toxic))
    different = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    held = F.pmod("place", F.lit(5)) == 0
    model = learn_everywhere(model, rows.filter(~held), sum(different.values()), passes)
    return calibrated(model, rows.filter(held), tuple(max(1.0, counts.get(label, 0) / max(1, different.get(label, 0))) for label in (0, 1)))


def texts_of(whole: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows ``id, text_hash, text`` whose id and hash are wanted, once each, with the wanted ``label``. Only these and the
    few others that a Bloom filter passes are shuffled, at any size."""
    blocks = blocks_for(wanted.count())
    words = bloom_filter(wanted.select(F.xxhash64("id", "text_hash").alias("canonical")), blocks).scalar()
    likely = whole.filter(may_hold(words, blocks, F.xxhash64("id", "text_hash")))
    return likely.join(wanted.hint("shuffle_hash"), ["id", "text_hash"]).groupBy("id", "text_hash").agg(
        F.first("text").alias("text"), F.first("label").alias("label"))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and ``score`` (0 to 1) of every whole text.

    A missing or empty text has the score of a text without words. Repeated rows get equal scores, an empty table gives no
    rows, and a model fitted to nothing gives all texts about the same score. Other columns are left out.
    """
    def run(batches):
        for part in slices(batches, 1):
            found = model.scores(part.column(1).to_pylist()).astype(np.float64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["id", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, score double")
