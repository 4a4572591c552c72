"""Source mixing, tokenizer alignment and the prefix trie against plain versions."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import public_tokenizers
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visitlake.llm import prefix_trie, queries, source_mix, token_alignment
from visitlake.llm.bpe import LATER, byte_letters

BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


# Source mixing

def long_hash(*values):
    """The engine's xxhash64 of longs."""
    seed = 42
    for value in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", value), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def targets_by_resharing(sizes, weights, share, rounds):
    """The rule as it is told: share by weight, stop at the bound, share the excess again."""
    named = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[place % len(weights)] for place, name in enumerate(named)}
    target, left, still = dict.fromkeys(named, 0.0), share * sum(sizes.values()), set(named)
    while still and left > 1e-9:
        unit = left / sum(weight[name] for name in still)
        left = 0.0
        for name in list(still):
            target[name] += unit * weight[name]
            if target[name] >= rounds * sizes[name]:
                left += target[name] - rounds * sizes[name]
                target[name] = float(rounds * sizes[name])
                still.discard(name)
    return target


@pytest.fixture(scope="module")
def sourced(spark):
    draw = random.Random(5)
    rows = []
    for number in range(300):
        source = draw.choice(["a", "a", "a", "a", "b", "é", "Z", "tiny", None])
        words = draw.choice([0, 1, 3, 40, 200])
        rows.append((number, source, " ".join(f"w{number}.{place}" for place in range(words)), 1, 2))
    rows += [(7, "a", "again again", 1, 2)] * 3 + [(None, "b", "no id", 1, 2), (None, "b", None, 1, 2), (900, "empty", "", 1, 2),
                                                    (901, "long", " ".join(f"l{place}" for place in range(20_000)), 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, block long, `a.b` long")


def test_targets_are_those_of_resharing_and_are_met_to_the_word(sourced):
    found = source_mix.mix(sourced, (3, 1, 2), block_words=16, shard_blocks=32).taken().collect()
    sizes = Counter()
    for row in sourced.collect():
        sizes[row["source"]] += len((row["text"] or "").split())
    wanted = targets_by_resharing(sizes, (3, 1, 2), 1.5, 2)
    assert len(found) == sourced.count()
    taken, target = Counter(), {}
    for row in found:
        taken[row["source"]] += row["taken"]
        target[row["source"]] = row["target"]
        assert row["source_size"] == sizes[row["source"]] and 0 <= row["taken"] <= 2 * row["size"]
    assert target == pytest.approx(wanted)
    assert {name: abs(taken[name] - target[name]) <= 0.5 for name in target} == dict.fromkeys(target, True)


def test_mix_equals_a_sequential_version(spark, sourced):
    """Draws, numbers, permutations and joins once more, one slot after the other."""
    block_words, shard_blocks, seed, rounds = 16, 32, 11, 2
    mixture = source_mix.mix(sourced, (3, 1, 2), block_words=block_words, shard_blocks=shard_blocks, seed=seed)
    documents, stream = mixture.documents.collect(), defaultdict(list)
    for row in documents:
        if row["size"]:
            stream[row["key"]].append((row["start"], row["size"]))
    named = sorted({(row["source"] is None, row["source"] or "", row["key"], row["source_size"], row["target"]) for row in documents})
    keys, slots, mapped = [one[2] for one in named], {}, {}
    for _, _, key, size, target in named:
        blocks, wanted = -(-size // block_words), int(target + 0.5)
        words = lambda block: min(block_words, size - block * block_words)
        steps = [[] for _ in range(rounds)]
        for turn in range(rounds):
            for step in range(source_mix.ROUNDS):
                first = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
                second = xxhash.xxh64_intdigest(struct.pack("<i", turn), first)
                third = xxhash.xxh64_intdigest(struct.pack("<i", step), second)
                hashed = xxhash.xxh64_intdigest(key.encode(), third)
                steps[turn].append(hashed - (1 << 64) if hashed >> 63 else hashed)

        def block_of(index):
            at, turn = index % blocks, index // blocks
            for hashed in steps[turn]:
                mirror = (hashed % blocks - at) % blocks
                at = mirror if long_hash(hashed, max(at, mirror)) & 1 else at
            return at

        got, chosen = 0, []
        while got < wanted:
            block = block_of(len(chosen))
            chosen.append((block, min(words(block), wanted - got)))
            got += chosen[-1][1]
        if blocks:
            assert sorted(block_of(index) for index in range(blocks)) == [*range(blocks)]
        slots[key], mapped[key] = len(chosen), chosen
    total = sum(slots.values())
    bounds, number = [], 0
    for key in keys:
        bounds.append((number, number + slots[key], key))
        number += slots[key]
    drawn, used = [], Counter()
    for place in range(total):
        hashed = int(xxhash.xxh64_intdigest(struct.pack("<q", place), xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)))
        hashed = (hashed - (1 << 64) if hashed >> 63 else hashed) % total
        drawn.append(next(key for low, high, key in bounds if low <= hashed < high))
    draws = Counter(drawn)
    lacking = [(key, index) for key in keys for index in range(draws[key], slots[key])]
    over = {}
    for key in keys:
        for index in range(slots[key], draws[key]):
            over[key, index] = lacking[len(over)]
    expected = Counter()
    for place, key in enumerate(drawn):
        index = used[key]
        used[key] += 1
        key, index = over.get((key, index), (key, index))
        block, most = mapped[key][index]
        low, high = block * block_words, block * block_words + most
        for start, size in stream[key]:
            length = min(high, start + size) - max(low, start)
            if length > 0:
                expected[place // shard_blocks, place % shard_blocks, max(start - low, 0), key, start, max(low - start, 0), length] += 1
    columns = ["shard", "slot", "offset", "key", "start", "first", "length"]
    assert Counter(tuple(row) for row in mixture.spans.select(columns).collect()) == expected


def test_spans_give_the_texts_of_full_blocks(sourced):
    mixture = source_mix.mix(sourced, (3, 1, 2), block_words=16, shard_blocks=32, with_text=True)
    texts = {(row["doc_id"], row["text"]) for row in sourced.collect()}
    by_slot = defaultdict(list)
    for row in mixture.spans.collect():
        assert any(doc == row["doc"] and (text or "").split()[row["first"]:row["first"] + row["length"]] == row["text"].split()
                   for doc, text in texts)
        by_slot[row["shard"], row["slot"]].append((row["offset"], row["length"]))
    for pieces in by_slot.values():
        ends = [0, *(offset + length for offset, length in sorted(pieces))]
        assert [offset for offset, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 16
    assert {slot for shard, slot in by_slot if shard == 0} == {*range(32)}


def test_mix_of_nothing_and_reruns(spark, sourced):
    empty = source_mix.mix(sourced.limit(0), (3, 1, 2))
    assert empty.taken().count() == 0 and empty.spans.count() == 0
    wordless = source_mix.mix(spark.createDataFrame([(1, None, None), (2, "s", " \n")], "doc_id long, source string, text string"), (3, 1, 2))
    assert [row["taken"] for row in wordless.taken().collect()] == [0, 0]
    once, again = (rows_of(source_mix.mix(frame, (3, 1, 2), block_words=16).taken()) for frame in (sourced, sourced.repartition(7)))
    assert once == again
    with pytest.raises(ValueError):
        source_mix.mix(sourced, (1,), share=2.5)


# Alignment

ODD = [(-1, None), (-2, ""), (-3, "a▁b"), (-4, "▁"), (-5, " x  y\n\n z <|endoftext|> </s> <0x41> \x00 ́"), (-6, "日本語 text ﬁ"),
       (None, "hello world"), (None, None), (-7, "ab " * 60_000), (-8, " "), (-9, "x" * 3000 + "  y"), (-7, "ab cd"), (-7, "ab cd")]


def token_bytes(model, number):
    piece = model.id_to_piece(number)
    return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()


def aligned_plainly(rows):
    byte_level, model = Tokenizer.from_file(BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    byte_level.encode_special_tokens = True
    byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
    found, documents = [], Counter()
    for key, text in rows:
        a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        spans = []
        for tokens in ([bytes(byte_of[letter] for letter in byte_level.id_to_token(one)) for one in a], [token_bytes(model, one) for one in b]):
            if text and b"".join(tokens) != (" " + text).encode():
                a, b = [], []
            ends = [sum(map(len, tokens[:0]))]
            for token in tokens:
                ends.append(ends[-1] + len(token))
            spans.append([*zip(ends, ends[1:])])
        spans = spans if a else [[], []]
        common = sorted({end for _, end in spans[0]} & {end for _, end in spans[1]})
        groups, low = [], 0
        for high in common:
            parts = [",".join(str(one) for one, (start, end) in zip(ids, own) if low <= start and end <= high) for ids, own in zip((a, b), spans)]
            groups.append("|".join(parts))
            low = high
        links, first = [], 0
        for one, (start, end) in zip(a, spans[0]):
            while spans[1][first][1] <= start:
                first += 1
            at = first
            while at < len(b) and spans[1][at][0] < end:
                links.append((one, b[at]))
                at += 1
        documents.update(set(links))
        found.append((key, len(a), len(b), ";".join(groups), links))
    best = Counter()
    for (one, _), count in documents.items():
        best[one] = max(best[one], count)
    return sorted(((key, n_a, n_b, groups.count(";") + bool(groups), len(links), sum(documents[link] == best[link[0]] for link in links),
                    sum(documents[link] for link in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                   for key, n_a, n_b, groups, links in found), key=str)


@pytest.fixture(scope="module")
def aligned_docs(spark):
    draw = random.Random(9)
    letters = "abc déß Été  \n,.09"
    some = [(number, "".join(draw.choice(letters) for _ in range(draw.randint(1, 80)))) for number in range(120)]
    real = [(row["doc_id"], row["text"][:2000]) for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect()]
    return spark.createDataFrame([(*row, 1) for row in [*some, *real, *[one for one in ODD if one[0] != -7 or len(one[1]) < 9]]],
                                 "doc_id long, text string, `n_a` int")


@pytest.mark.parametrize("frequent", [1 << 20, 50, 0])
def test_alignment_equals_a_plain_version(aligned_docs, frequent):
    docs = aligned_docs.select("doc_id", "text").collect()
    assert rows_of(token_alignment.align(aligned_docs, BYTE_LEVEL, PIECES, frequent_pairs=frequent)) == aligned_plainly(docs)


def test_long_texts_are_encoded_in_parts(monkeypatch):
    tokenizers = token_alignment.tokenizers_of(BYTE_LEVEL, PIECES)[:2]
    draw = random.Random(2)
    text = "".join(draw.choice("ab  Éü\n.7'") for _ in range(5000))
    whole = [one.encode(text) for one in tokenizers]
    monkeypatch.setattr(token_alignment, "PART_CHARS", 40)
    assert len(token_alignment.parts_of(text)) > 50 and "".join(token_alignment.parts_of(text)) == text
    assert [one.encode(text) for one in tokenizers] == whole


def test_both_byte_level_libraries_agree_below_later():
    byte_level = token_alignment.tokenizers_of(BYTE_LEVEL, PIECES)[0]
    for code in range(ord(LATER)):
        text = f" a{chr(code)}b {chr(code)}{chr(code)} 1{chr(code)}"
        assert byte_level.ranked.encode_ordinary(text) == byte_level.library.encode(text, add_special_tokens=False).ids, code


def test_a_very_long_text_is_aligned_whole(spark):
    docs = spark.createDataFrame([(1, "word " * 200_000), (2, "x" * 200_000)], "doc_id long, text string")
    found = {row["doc_id"]: row for row in token_alignment.align(docs, BYTE_LEVEL, PIECES).collect()}
    assert found[1]["n_groups"] >= 200_000 and found[1]["n_links"] >= 200_000 and found[2]["n_a"] > 0


def test_groups_read_back_as_ids(spark, aligned_docs):
    byte_level, model, *_ = token_alignment.tokenizers_of(BYTE_LEVEL, PIECES)
    for row in token_alignment.groups_of(aligned_docs.filter("doc_id >= 0"), BYTE_LEVEL, PIECES).collect():
        sides = [[int(one) for group in row["groups"].split(";") for one in group.split("|")[side].split(",")] for side in (0, 1)]
        assert sides == [byte_level.encode(row["row"]["text"]), model.encode(row["row"]["text"])]


def test_alignment_of_an_empty_table(aligned_docs):
    assert token_alignment.align(aligned_docs.limit(0), BYTE_LEVEL, PIECES).count() == 0


# Prefix trie

TURN_ROWS = "conv_id long, turn long, role string, text string"


def rebuilt_plainly(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv_id: [turn[2:] for turn in sorted(turns)] for conv_id, turns in own.items()}
    shared = {conv_id: zlib.crc32(str(conv_id).encode()) % 6 for conv_id in own}
    return {c: tuple(own.get(c - c % 100, [])[:shared[c]] + own[c][shared[c]:]) for c in own}


def trie_plainly(conversations):
    members, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for conv_id, path in conversations.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv_id)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, of_path in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(of_path) - 1) * len(path[-1][1]) if path else 0
    found = []
    for path, of_path in members.items():
        ends = sorted(conv_id for conv_id in of_path if len(conversations[conv_id]) == len(path))
        found.append((min(of_path), len(path), min(members[path[:-1]]) if path else None, len(of_path), children[path], leaves[path],
                      saved[path], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(4)
    rows = []
    for conv_id in range(400):
        if conv_id % 3 == 0:  # a third are copies of one conversation
            rows += [(conv_id, turn, "user", f"same {turn}") for turn in range(4)]
        else:
            rows += [(conv_id, turn, draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "ü👍", "", None]))
                     for turn in range(draw.randint(1, 7))]
    rows += [(1000, turn, "user", f"t{turn % 5}") for turn in range(300)] + [(1001, turn, "user", f"t{turn % 5}") for turn in range(299)]
    return rows + [(5, None, "user", "first"), (5, None, "user", "first"), (None, 1, "user", "nowhere"), (10**15, None, None, None)]


@pytest.mark.parametrize("shards", [1, 3, 40, 1000])
def test_trie_equals_a_plain_version(spark, talks, shards):
    conversations = defaultdict(list)
    for conv_id, turn, role, text in talks:
        if conv_id is not None:
            conversations[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    plain = {conv_id: tuple(turn[2:] for turn in sorted(turns)) for conv_id, turns in conversations.items()}
    frame = prefix_trie.turns_of(spark.createDataFrame(talks, TURN_ROWS).withColumn("depth", F.lit(1)).repartition(3))
    assert rows_of(prefix_trie.prefix_trie(frame, shards=shards)) == trie_plainly(plain)


def test_trie_with_a_bounded_skeleton(spark, talks):
    frame = prefix_trie.turns_of(spark.createDataFrame(talks, TURN_ROWS))
    assert rows_of(prefix_trie.prefix_trie(frame, shards=100, skeleton_nodes=5)) == rows_of(prefix_trie.prefix_trie(frame, shards=1))


def test_trie_of_conversations_without_turns_and_of_nothing(spark):
    frame = spark.createDataFrame([(4, []), (2, [])], "conv_id long, turns array<struct<digest: string, chars: int>>")
    digest = hashlib.sha256(b"2,4").hexdigest()
    assert rows_of(prefix_trie.prefix_trie(frame)) == [(2, 0, None, 2, 0, 1, 0, digest)]
    assert prefix_trie.prefix_trie(frame.limit(0)).count() == 0


def test_trie_query_rebuilds_conversations(spark, talks, tmp_path):
    rows = [row for row in talks if row[1] is not None or row[0] is None]
    spark.createDataFrame(rows, TURN_ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op13_prefix_trie(spark, str(tmp_path))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert rows_of(found.select(columns)) == trie_plainly(rebuilt_plainly(rows))
