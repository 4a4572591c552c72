"""Quality rules, BPE, packing, toxicity and language on hand-made texts and against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visitlake.llm import batches, bpe, language_crf, packing, quality_rules, toxicity
from visitlake.llm.queries import VOCABULARY

DOCS = "doc_id bigint, text string, lang string, ids string, quality int"
PROSE = "The river of the town is wide and the boats on it are slow. People walk along and look at the water every day."


@pytest.fixture(scope="module")
def strange(spark):
    """Missing, empty, blank and very long texts, repeated rows, missing ids and columns with clashing names."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, PROSE), (4, PROSE), (None, "a b"), (5, "word " * 60_000), (6, "Ａﬀ Σας ΟΔΟΣ!!"),
            (7, "x<|endoftext|>y 'll don't 12 <|startoftext|>"), (8, "!" * 3000), (9, "a\x1cb\u2028c"), (10, PROSE + "\n" + PROSE)]
    return spark.createDataFrame([(i, text, "en", "mine", 7) for i, text in rows], DOCS)


def test_quality_counts_and_verdicts(spark):
    menu = "Home | News | Sport | Weather | Shop"
    texts = {1: None, 2: "", 3: PROSE, 4: "\n".join([PROSE, menu]), 5: "\n".join([menu] * 6 + ["Short."]),
             6: "one two three four five six seven eight " * 4, 7: "\n".join([PROSE, "x y", PROSE, "WHAT!! IS!! THIS!!"])}
    frame = spark.createDataFrame([(i, text, 1) for i, text in texts.items()], "doc_id bigint, text string, quality int")
    found = {row["doc_id"]: row["quality"] for row in quality_rules.judge(frame).collect()}
    for number, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        often = Counter(windows)
        covered = {i + j for i, window in enumerate(windows) if often[window] > 1 for j in range(8)}
        lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\v\f\r")]
        assert found[number]["n_words"] == len(words)
        assert found[number]["word_chars"] == sum(map(len, words))
        assert found[number]["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert found[number]["n_dup_lines"] == len(lines) - len(set(lines))
        assert found[number]["n_repeat_words"] == len(covered)
        assert found[number]["base_failed"] == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
    assert {number for number, row in found.items() if row["kept"]} == {3, 4}
    assert found[4]["clean_text"] == PROSE
    assert found[7]["clean_text"] == "\n".join([PROSE, PROSE])
    cleaned = quality_rules.clean(frame)
    assert cleaned.columns == frame.columns
    assert {(row["doc_id"], row["quality"]) for row in cleaned.collect()} == {(3, 1), (4, 1)}
    assert quality_rules.judge(frame.limit(0)).count() == 0


def test_long_repeats_take_time_in_proportion(spark):
    text = " ".join(f"w{i % 50_000}" for i in range(100_000))
    row = quality_rules.judge(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()["quality"]
    assert row["n_repeat_words"] == 100_000 and row["base_failed"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_bpe_of_strange_rows(strange, library):
    rows = bpe.encode_digests(strange, VOCABULARY).collect()
    assert len(rows) == strange.count()
    given_rows = [(row["doc_id"], row["text"] or "") for row in strange.collect()]
    expected = []
    for number, text in given_rows:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        expected.append((number, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(decoded).hexdigest()))
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    assert bpe.encode_decode(strange.limit(0), VOCABULARY).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_bpe_is_exact(text):
    own, library = bpe.word_bpe(VOCABULARY), _library()
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == np.array(ids, "<u4").tobytes()
    assert own.decode(own.encode(text)).decode() == library.decode(ids, skip_special_tokens=False)


def _library(found=[]):  # noqa: B006
    if not found:
        found.append(Tokenizer.from_file(VOCABULARY))
    return found[0]


@settings(max_examples=200, deadline=None)
@given(st.text("abcdefghij'thesn", min_size=1, max_size=30))
def test_backtracking_gives_plain_merges(piece):
    encoder = bpe.word_bpe(VOCABULARY).encoder
    data = piece.encode()
    assert encoder.encode(piece) == encoder.merge(data[:-1].decode("latin-1") + chr(data[-1] + 256))


def test_packing_places_every_id_once(strange, library):
    pieces = packing.pack(strange, VOCABULARY, group_windows=4).collect()
    sequences = {}
    for row in pieces:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
        assert len(row["ids"]) == 4 * row["length"]
    for spans in sequences.values():
        assert sum(length for _, length in spans) <= 2048
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
    expected = Counter()
    for row in strange.collect():
        ids = np.array([*library.encode(row["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        expected[row["doc_id"]] += len(ids)
    found = Counter()
    for row in pieces:
        found[row["doc_id"]] += row["length"]
    assert found == expected
    one = sorted((row["start"], row["ids"]) for row in pieces if row["doc_id"] == 5)
    ids = np.array([*library.encode("word " * 60_000, add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert b"".join(part for _, part in one) == ids
    assert packing.pack(strange.limit(0), VOCABULARY).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 512), max_size=120))
def test_windows_hold_all_pieces_and_balance(sizes):
    windows = packing.windows_of(sizes, 2048)
    assert sorted(number for numbers in windows for number in numbers) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in numbers) <= 2048 for numbers in windows)


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(1).integers(1, 512, 800).tolist()
    sums = [total for total, _ in packing.differencing(sizes, 100)]
    assert len(sums) == 100 and max(sums) - min(sums) <= 16


INSULTS = {"en": ["blarg", "snurk"], "de": ["murksig", "murkser"], "fr": ["grolu", "groluter"], "es": ["tronco", "troncuda"]}


def _prose(draw, language, words=60):
    common = toxicity.FUNCTION_WORDS[language].split()
    rare = [f"{a}{b}" for a in ("ka", "lo", "mi", "ra") for b in ("ten", "dor", "sel", "vu")]
    return [str(draw.choice(common if draw.random() < 0.5 else rare)) + ("" if language == "en" else language[0]) * int(
        draw.random() < 0.3) for _ in range(words)]


def test_toxicity_finds_insults_and_generalizes(spark, strange):
    draw = np.random.default_rng(0)
    rows = []
    for number in range(900):
        language = ["en", "de", "fr", "es"][number % 4]
        words, toxic = _prose(draw, language), int(draw.random() < 0.4)
        for _ in range(3 * toxic):
            words.insert(int(draw.integers(len(words))), str(draw.choice(INSULTS[language])))
        rows.append((number, " ".join(words), toxic))
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(row[0], row[2]) for row in rows] + [(5000, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 1)
    scores = {row["doc_id"]: row["score"] for row in toxicity.score(docs, model).collect()}
    held = [(scores[number] >= toxicity.THRESHOLD, toxic) for number, _, toxic in rows if number % 3 == 1]
    assert np.mean([predicted == bool(toxic) for predicted, toxic in held]) >= 0.95
    found = toxicity.score(strange, model).collect()
    assert len(found) == strange.count() and all(0 <= row["score"] < toxicity.THRESHOLD for row in found)
    assert toxicity.score(strange.limit(0), model).count() == 0
    nothing = toxicity.fit(docs, labels.limit(0), F.col("doc_id") > 0)
    assert len({round(row["score"], 6) for row in toxicity.score(strange, nothing).collect()}) >= 1


def test_toxicity_cut_follows_the_mix_of_all_labels(spark):
    """Half of the toxic texts look like three tenths of the clean ones: worth a hit at equal shares, not at one in nine."""
    draw = random.Random(2)
    rows = []
    for i in range(3600):
        toxic = i % 9 == 0
        kind = draw.random()
        word = ("awful" if kind < 0.5 else "maybe") if toxic else ("maybe" if kind < 0.3 else "lovely")
        rows.append((i, " ".join([word, *draw.choices("one two three four five six seven".split(), k=6)]), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.lit(True), per_label=300)
    scores = model.scores([f"{word} one two three four five six" for word in ("awful", "maybe", "lovely")])
    assert [score >= toxicity.THRESHOLD for score in scores] == [True, False, False]


def test_language_of_words_and_texts(spark, strange):
    draw = np.random.default_rng(1)
    parts = {"aa": ["kolo", "mat", "tik", "sara"], "bb": ["schnu", "wurz", "pfel", "brau"]}

    def text(language, words=40):
        return " ".join("".join(draw.choice(parts[language], 2)) for _ in range(words))

    rows = [(number, text(language), language) for number in range(200) for language in [("aa", "bb")[number % 2]]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_crf.fit(docs, F.col("doc_id") < 120, per_language=40)
    found = {row["doc_id"]: row for row in language_crf.identify(docs, model).collect()}
    assert np.mean([found[number]["lang_pred"] == language for number, _, language in rows if number >= 120]) >= 0.97
    mixed = spark.createDataFrame([(1, text("aa", 12) + " " + text("bb", 12))], "doc_id bigint, text string")
    labels = [word["lang"] for word in language_crf.label_words(mixed, model).first()["words"]]
    assert sum(a == b for a, b in zip(labels, ["aa"] * 12 + ["bb"] * 12)) >= 22
    judged = {row["doc_id"]: row for row in language_crf.identify(strange, model).collect()}
    assert all(judged[number]["lang_pred"] == "und" and judged[number]["score"] == 0 for number in (1, 2, 3, 8))
    assert judged[5]["lang_pred"] in ("aa", "bb") and 0 < judged[5]["score"] <= 1
    assert language_crf.words_of("x² ² Ⅳ 12 Été") == ["x²", "été"]
    kept = language_crf.with_language(strange, model, "quality")
    assert kept.columns == ["doc_id", "text", "lang", "ids", "quality"] and kept.count() == strange.count()
    unlearned = language_crf.fit(docs, F.col("doc_id") < 0)
    assert {row["lang_pred"] for row in language_crf.identify(strange, unlearned).collect()} == {"und"}
    assert language_crf.identify(strange.limit(0), model).count() == 0


def test_language_model_learns_all_languages(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_crf, "train", lambda samples, seed: seen.extend(samples))
    rows = [(f"l{k:02}", f"text {k} {i}") for k in range(70) for i in range(5)]
    language_crf.fit(spark.createDataFrame(rows, "lang string, text string"), F.lit(True), per_language=8)
    assert sorted(seen) == sorted(rows)


def test_language_model_gives_copies_no_places(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_crf, "train", lambda samples, seed: seen.extend(samples))
    rows = [(f"l{k:02}", f"text {k} {i}") for k in range(70) for i in range(5)] + [("l00", f"many {i % 3}") for i in range(6000)]
    language_crf.fit(spark.createDataFrame(rows, "lang string, text string"), F.lit(True), per_language=8)
    assert sorted(seen) == sorted(set(rows))


def test_forward_backward_equals_enumeration():
    draw = np.random.default_rng(2)
    scores, moves = draw.normal(size=(1, 5, 3)), draw.normal(size=(3, 3))
    inside = np.array([[True, True, True, True, False]])
    total, expected = np.zeros((4, 3)), np.zeros((3, 3))
    for path in np.ndindex(3, 3, 3, 3):
        weight = np.exp(sum(scores[0, t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for t, k in enumerate(path):
            total[t, k] += weight
        for a, b in zip(path, path[1:]):
            expected[a, b] += weight
    found, counts = language_crf.marginals(scores, inside, moves)
    assert np.allclose(found[0, :4], total / total.sum(axis=1, keepdims=True))
    assert np.allclose(counts, expected / total[0].sum())
    assert np.allclose(language_crf.posteriors(scores, inside, moves)[0, :4], found[0, :4])


def test_language_lets_go_of_the_tokenizer_that_packing_kept(spark, monkeypatch):
    """A worker that packed keeps a tokenizer with its table of chunks; a task that judges languages there lets them go."""
    docs = spark.createDataFrame([(1, PROSE)], "doc_id bigint, text string")
    tasks, original = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda frame, task, kind: tasks.append(task) or original(frame, task, kind))
    language_crf.identify(docs, language_crf.train([("en", PROSE)], chains=2, rounds=1))
    packing.library_ids(VOCABULARY)
    assert packing.library_ids.cache_info().currsize == 1
    assert sum(batch.num_rows for batch in tasks[0](docs.toArrow().to_batches())) == 1
    assert packing.library_ids.cache_info().currsize == 0


def test_toxicity_learns_from_different_texts(spark):
    """Thousands of copies of one clean text, under ids of their own and under one id, leave room for all others."""
    toxic = [(number, f"you are a gleeb {number} and a fool", 1) for number in range(40)]
    clean = [(100 + number, f"a quiet day {number} in the garden", 0) for number in range(40)]
    copies = [(1000 + number, "the same clean text again", 0) for number in range(3000)] + [(99, "the same clean text again", 0)] * 500
    frame = spark.createDataFrame(toxic + clean + copies, "doc_id long, text string, toxic int")
    seen = []
    original = toxicity.train
    toxicity.train = lambda samples, *given, **named: seen.append((samples, named["weights"])) or original(samples, *given, **named)
    try:
        model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic").distinct(), F.lit(True), per_label=50)
    finally:
        toxicity.train = original
    (samples, weights), = seen
    assert len(samples) == len({text for text, _ in samples}) == 81 and sum(label for _, label in samples) == 40
    assert weights == (pytest.approx(3540 / 41), 1.0)
    assert model.scores(["you are a gleeb"])[0] > model.scores(["a quiet day"])[0]


def test_toxicity_learns_from_all_texts_not_from_its_starting_sample(spark):
    """Each insult has 40 texts; the sample that training starts from holds few of the insults."""
    draw = random.Random(4)
    insults = ["".join(draw.choices("bcdfgklmnprstvz", k=6)) for _ in range(30)]
    mild = "river garden window table paper water evening morning people market".split()
    rows = [" ".join([insults[i % 30] if i < 1200 else draw.choice(mild), *draw.choices(mild, k=8)]) + f" n{i}" for i in range(2400)]
    frame = spark.createDataFrame([(i, text, int(i < 1200)) for i, text in enumerate(rows)], "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.lit(True), per_label=10)
    scores = model.scores([f"river {insult} garden window evening people" for insult in insults])
    assert np.mean(scores >= toxicity.THRESHOLD) >= 0.9
    assert model.scores(["river garden window evening people market"])[0] < toxicity.THRESHOLD


def test_toxicity_parts_are_averaged_where_they_met_a_word():
    start = toxicity.train([])
    parts = [toxicity._as(start, np.float64) for _ in range(2)]
    parts[0].embeddings[7] += 1
    parts[0].bias += 1
    merged = toxicity.merge(start, [(parts[0], 10), (parts[1], 30)])
    assert merged.embeddings[7] == pytest.approx(start.embeddings[7] + 1, abs=1e-5)
    assert merged.bias == pytest.approx(start.bias + 0.25)


def test_toxicity_parts_are_merged_in_tasks(spark, monkeypatch):
    """The model is that of the plain merge, and the driver gets as much from 24 parts as from one, but for their small arrays."""
    draw = random.Random(7)
    rows = [(" ".join(draw.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=6)), i % 2, i * 7919) for i in range(400)]
    taught = spark.createDataFrame(rows, "text string, label int, place long")
    start = toxicity.train([(text, label) for text, label, _ in rows[:40]])
    monkeypatch.setattr(toxicity, "PART_TEXTS", 17)
    spread = taught.repartition(24, "place").sortWithinPartitions("place").withColumn("part", F.spark_partition_id()).collect()
    collected, collect = [], type(taught).collect
    monkeypatch.setattr(type(taught), "collect", lambda frame: collected.append(collect(frame)) or collected[-1])
    found = toxicity.learn_everywhere(start, taught, len(rows), 1)
    monkeypatch.undo()
    parts = {}
    for row in spread:
        parts.setdefault(row["part"], []).append((row["text"], row["label"]))
    learned = [toxicity.learn_part(start, parts[part]) for part in sorted(parts)]
    plain = toxicity.merge(start, [(toxicity._as(model, np.float32), count) for model, count in learned])
    assert len(parts) > 20
    for name in toxicity.ARRAYS:
        assert np.allclose(getattr(found, name), getattr(plain, name), atol=1e-6)
    assert all(np.allclose(own, other, atol=1e-6) for own, other in zip(found.filters, plain.filters))
    held = sum(len(value) for rows in collected for row in rows for value in row if isinstance(value, (bytes, bytearray)))
    assert held < 8 * start.embeddings.size + 4096 * len(parts)


def test_toxicity_shuffles_wanted_texts_only(spark, monkeypatch):
    """Of 5,000 documents with 40 wanted ones, a few more than the wanted reach the join; all wanted are found, once each."""
    whole = spark.range(5000).selectExpr("id", "concat('text ', id % 4000) AS text").select("id", F.xxhash64("text").alias("text_hash"), "text")
    wanted = whole.filter("id % 125 = 0").select("text_hash", "id", F.lit(1).alias("label"))
    passed, join = [], type(whole).join
    monkeypatch.setattr(type(whole), "join", lambda frame, *given: passed.append(frame.count()) or join(frame, *given))
    found = toxicity.texts_of(whole.union(whole), wanted)
    monkeypatch.undo()
    assert 80 <= passed[0] <= 200
    assert sorted((row["id"], row["text"], row["label"]) for row in found.collect()) == [(i, f"text {i % 4000}", 1) for i in range(0, 5000, 125)]


def test_toxicity_is_a_plain_convolution(monkeypatch):
    """Probabilities against loops over places, filters and taps, also where places are taken in parts."""
    draw = np.random.default_rng(1)
    model = toxicity.Model(
        draw.normal(0, 1, (toxicity.TABLE, toxicity.DIMENSIONS)).astype(np.float32),
        [draw.normal(0, 1, (width, toxicity.DIMENSIONS, toxicity.FILTERS)).astype(np.float32) for width in toxicity.WIDTHS],
        draw.normal(0, 1, 24).astype(np.float32), draw.normal(0, 1, 24).astype(np.float32), np.zeros(1, np.float32), np.full(5, 0.5))
    texts = ["one two three two one", None, "", "word " * 300 + "odd even", "x y", "é ß"]

    def plainly(text):
        padding = [np.zeros(toxicity.DIMENSIONS)] * toxicity.PADDING
        own = [model.embeddings[toxicity.places(word)].sum(axis=0) for word in toxicity.words_of(text)]
        hidden = []
        for filters in model.filters:
            # A filter of fewer words also sees the padding before the text, and the last words of it up to its width.
            row = padding + own + padding
            values = [sum(row[at + step] @ tap for step, tap in enumerate(filters)) for at in range(len(own) + toxicity.PADDING)]
            hidden.append(np.max(values, axis=0))
        total = np.maximum(np.concatenate(hidden) + model.filter_bias, 0) @ model.output + model.bias[0]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    expected = [plainly(text) for text in texts]
    for at_once in (1 << 18, 7):
        monkeypatch.setattr(toxicity, "PLACES_AT_ONCE", at_once)
        assert model.probabilities(texts)[0] == pytest.approx(np.array(expected), rel=1e-4)


def test_a_line_ends_at_its_end_and_not_before_other_separators(spark):
    lines = ["done now.", "done now. ", "done now.\u2028", "done now.\u0085", "not done"]
    frame = spark.createDataFrame([(number, line) for number, line in enumerate(lines)], "n int, line string")
    found = [row[0] for row in frame.orderBy("n").select(quality_rules.line_failure(F.col("line"))).collect()]
    assert found == [None, None, "unfinished", "unfinished", "unfinished"]


def test_languages_are_counted_without_python_on_the_executors(spark, monkeypatch):
    def refused(self):
        raise AssertionError("rows go through a Python worker")

    rows = [(i, f"{'river boat water' if i % 2 else 'fluss boot wasser'} n{i}", "en" if i % 2 else "de", "a", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr("pyspark.RDD._to_java_object_rdd", refused)
    model = language_crf.fit(docs, F.lit(True), per_language=10)
    assert model.languages == ["de", "en"]


def test_a_task_gives_its_memory_back():
    def resident():
        with open("/proc/self/smaps_rollup") as file:
            return sum(int(size) for size in re.findall(r"\nPss_Anon:\s+(\d+)", file.read())) / 1024

    pinned = []

    def run(given):
        held = [np.ones(8_000) for _ in range(2_000)]
        pinned.append(held[-1])
        yield from given

    let_go_of = batches.kept_by_worker(lambda name: object())
    kept, before = let_go_of("table"), resident()
    assert list(run([1])) == [1] and resident() > before + 60  # what lies below the pinned piece stays
    assert list(batches.frugal(run)([1, 2])) == [1, 2] and resident() < before + 30
    assert let_go_of("table") is not kept
    kept = let_go_of("table")
    assert list(batches.frugal(run, keeps=True)([])) == [] and let_go_of("table") is kept
    batches.let_go()
