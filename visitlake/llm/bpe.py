"""Exact BPE encoding by backtracking over longest token matches, and decoding by an offset table.

The vocabulary file is a word BPE: text is brought to NFC, white space separates, letters are lower-cased, each piece is
written in byte letters and its last letter carries an end-of-word mark. Since no piece crosses white space, a text is
encoded chunk by chunk between white space, and chunks seen before come from a bounded table.

A sequence of tokens is the result of BPE exactly when every two neighbours are compatible: merging the text of both
from its letters leaves the border between them. So the encoder walks a piece from left to right with the longest token
that is compatible with the one before, and goes back to a shorter one where nothing fits. An end position that failed
is never tried again, so the work is linear in the piece.
"""

import hashlib
import json
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

# The end-of-word mark and the normalizing steps of the vocabulary file this encoder is for.
WORD_END = "</w>"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# Below this character all Unicode versions agree on what are letters, digits and white space.
LATER = "\u0530"
# These count as white space for str.split() but not in the vocabulary's pattern.
_SEPARATORS = regex.compile("[\x1c-\x1f]")
_WHITE_SPACE = regex.compile(r"\p{White_Space}+")

CHUNKS_KEPT = 250_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    shifted = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(shifted)) for byte in range(256)]


class Bounded(dict):
    """A table filled on demand by a function; it holds the last ``limit`` to ``2 * limit`` keys that were asked for."""

    def __init__(self, find, limit: int):
        super().__init__()
        self.find, self.limit, self.older = find, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
        return self.add(key, value)

    def add(self, key, value):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def unknown(self, keys) -> set:
        return {key for key in keys if key not in self and key not in self.older}


class ChunkedText:
    """Splits whole texts into chunks and joins the ids of their chunks; ``encode_chunk`` gives a chunk's bytes."""

    def __init__(self, spec: dict, encode_chunk, chunks_kept: int = CHUNKS_KEPT):
        steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
        if steps != NORMALIZERS or spec["model"]["end_of_word_suffix"] != WORD_END:
            raise ValueError("the vocabulary file is not a lower-casing word BPE")
        # A special token's string stands among the chunks with a space before it, which no chunk holds.
        self.specials = {" " + token["content"]: np.array(token["id"], "<u4").tobytes() for token in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(regex.escape(token[1:]) for token in self.specials) + ")")
        self.table = Bounded(lambda chunk: self.specials.get(chunk) or encode_chunk(chunk), chunks_kept)

    def chunks(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not any(token[1:] in text for token in self.specials):
            return self._plain(text)
        parts = [[" " + part] if " " + part in self.specials else self._plain(part) for part in self.special.split(text)]
        return [chunk for part in parts for chunk in part]

    def _plain(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Letters are lowered one by one, without the rule for a sigma at the end of a word.
        text = text.replace("Σ", "σ").lower()
        return text.split() if not _SEPARATORS.search(text) else [chunk for chunk in _WHITE_SPACE.split(text) if chunk]

    def ids(self, chunks: list[str]) -> bytes:
        """The ids of a text's chunks as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.table.__getitem__, chunks))


class BacktrackingEncoder:
    """Encodes single pieces. A letter is the code point of its byte, plus 256 for the last letter of a piece."""

    def __init__(self, spec: dict, pairs_kept: int = 250_000):
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}

        def letters(token: str) -> str:
            ends = token.endswith(WORD_END)
            body = [byte_of[letter] for letter in (token[: -len(WORD_END)] if ends else token)]
            if ends:
                body[-1] += 256
            return "".join(map(chr, body))

        vocabulary = spec["model"]["vocab"]
        self.letters = {number: letters(token) for token, number in vocabulary.items()}
        self.base = {text: number for number, text in self.letters.items() if len(text) == 1}
        self.merged, self.parts = {}, {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            number = vocabulary[left + right]
            if number != len(self.base) + rank:
                raise ValueError("the vocabulary does not number its tokens in the order of their merges")
            pair = vocabulary[left], vocabulary[right]
            self.merged[pair], self.parts[number] = number, pair
        # Tokens that BPE of their own text does not give are never in a result.
        self.token = {text: number for number, text in self.letters.items() if self.merge(text) == [number]}
        self.automaton = ahocorasick.Automaton()
        for text, number in self.token.items():
            self.automaton.add_word(text, number)
        self.automaton.make_automaton()
        self.length = [len(self.letters[number]) for number in range(len(self.letters))]
        # The longest shorter token that a token begins with, or -1.
        self.shorter = [-1] * len(self.letters)
        for text, number in self.token.items():
            begins = (self.token.get(text[:end]) for end in range(len(text) - 1, 0, -1))
            self.shorter[number] = next((found for found in begins if found is not None), -1)
        self.compatible = Bounded(self._compatible, pairs_kept)

    def merge(self, text: str) -> list[int]:
        """Plain BPE: the first merge in the vocabulary's order, again and again."""
        tokens = [self.base[letter] for letter in text]
        while len(tokens) > 1:
            first, at = min((self.merged.get(pair, len(self.letters)), i)
                            for i, pair in enumerate(zip(tokens, tokens[1:])))
            if first == len(self.letters):
                break
            tokens[at:at + 2] = [first]
        return tokens

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether the border between two tokens stands when their joined text is merged from its letters.

        Both tokens are taken apart along the border, latest merge first. If at some point the two parts at the border
        would merge earlier than the parts were themselves merged further, the border falls.
        """
        left, right = pair
        limit = len(self.letters) + 1
        while self.merged.get((left, right), limit) >= limit:
            # Of equal merges the right one is undone first, since merging goes from left to right.
            if left in self.parts and (left > right or right not in self.parts):
                limit, left = left, self.parts[left][1]
            elif right in self.parts:
                limit, right = right + 1, self.parts[right][0]
            else:
                return True
        return False

    def encode(self, piece: str) -> list[int]:
        data = piece.encode("utf-8")
        text = data[:-1].decode("latin-1") + chr(data[-1] + 256)
        if text in self.token:
            return [self.token[text]]
        length, shorter, compatible = self.length, self.shorter, self.compatible
        longest, failed = [-1] * len(text), bytearray(len(text) + 1)
        tokens, at, number = [], 0, -1
        while at < len(text):
            if number < 0:
                if longest[at] < 0:
                    self._fill(text, at, longest)
                number = longest[at]
            if failed[at + length[number]] or tokens and not compatible[tokens[-1], number]:
                number = shorter[number]
                while number < 0:  # nothing fits here: the token before must be shorter
                    failed[at] = 1
                    last = tokens.pop()
                    at -= length[last]
                    number = shorter[last]
            else:
                tokens.append(number)
                at += length[number]
                number = -1
        return tokens

    def _fill(self, text: str, at: int, longest: list[int]) -> None:
        """Note the longest tokens from here on, each beginning where the one before ends."""
        for end, number in self.automaton.iter_long(text, at):
            start = end + 1 - self.length[number]
            if longest[start] >= 0:
                break
            longest[start] = number


class WordBpe:
    """Encodes and decodes whole texts with one vocabulary file."""

    def __init__(self, path: str, chunks_kept: int = CHUNKS_KEPT):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.encoder = BacktrackingEncoder(spec)
        self.piece = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.pieces = Bounded(lambda piece: np.array(self.encoder.encode(piece), "<u4").tobytes(), chunks_kept // 4)
        self.text = ChunkedText(spec, self._chunk, chunks_kept)
        # Decoding: the texts of all tokens in one row of bytes, each with a space behind, and where each begins.
        tokens = spec["model"]["vocab"] | {token["content"]: token["id"] for token in spec["added_tokens"]}
        texts = [b""] * (max(tokens.values()) + 1)
        for token, number in tokens.items():
            texts[number] = token.encode("utf-8") + b" "
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(text) for text in texts], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths

    def _chunk(self, chunk: str) -> bytes:
        # Later Unicode versions class some characters differently; the library's own splitter knows its version.
        found = self.piece.findall(chunk) if max(chunk) < LATER else [
            chunk[begin:end] for _, (begin, end) in self.split(chunk)]
        return b"".join(map(self.pieces.__getitem__, found))

    def encode(self, text: str | None) -> bytes:
        return self.text.ids(self.text.chunks(text))

    def decode(self, ids: bytes) -> bytes:
        """The decoded text in UTF-8: the tokens' own spellings, separated by spaces."""
        numbers = np.frombuffer(ids, "<u4")
        lengths = self.lengths[numbers]
        begins = np.cumsum(lengths) - lengths
        places = np.repeat(self.offsets[numbers] - begins, lengths) + np.arange(lengths.sum())
        return self.bytes[places].tobytes()[:-1]


@lru_cache(maxsize=1)
def word_bpe(path: str) -> WordBpe:
    """One encoder for each Python worker."""
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every whole text and decode it again: id, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` (UTF-8).

    A missing or empty text, or one without pieces, has no ids and decodes to nothing. Repeated rows give repeated
    results; other columns are left out. Strings of special tokens in a text become their ids, as the library does.
    """
    fields = _fields(docs, id_column)
    return docs.select(id_column, text_column).mapInArrow(
        lambda batches: _encoded(batches, path, lambda ids, decoded: (ids, decoded)),
        f"{fields}, ids binary, decoded binary")


def encode_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As ``encode_decode``, but with the number of ids and digests of both results instead of the results."""
    def digests(ids, decoded):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    fields = _fields(docs, id_column)
    return docs.select(id_column, text_column).mapInArrow(
        lambda batches: _encoded(batches, path, digests),
        f"{fields}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _fields(docs: DataFrame, id_column: str) -> str:
    return f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}"


def _encoded(batches, path, result):
    bpe = word_bpe(path)
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            ids = bpe.encode(text)
            rows.append(result(ids, bpe.decode(ids)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, zip(*rows))],
                                         names=[str(i) for i in range(1 + len(rows[0]))]) if rows else batch.slice(0, 0)
