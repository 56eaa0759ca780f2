"""BPE encoding and decoding with a given word-end vocabulary.

Encoder: an Aho-Corasick automaton finds every token in a word; at each place the longest token is
tried whose pair with the token before it is compatible, with shorter ones and a step back where
none is. Places from which no way leads on are marked, so the work is linear in the length of the
word. Two tokens are compatible when merging their joint text would give just these two; the answer
comes from undoing their merges along the border and is kept in a table. Decoding copies slices of
one buffer by an offset table.

The vocabulary file is a parameter; tasks read it once per worker. Words are kept in a table of
bounded size. The result is that of the file's own library with add_special_tokens=False and no
truncation or padding; strings of special tokens in a text are those tokens there, and here too.

Defined results: null counts as empty, and empty text has no tokens. Repeated rows give repeated
rows. Only doc_id and text are read. Texts are handled one by one, whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sortwell.llm.common import WORKER_TABLES, lean

WORD_END = "</w>"
MAX_WORDS = 400_000
MAX_KEPT_LENGTH = 64
MAX_PAIRS = 1_000_000
# White space of the file's library; str.split() also cuts at the four controls after it.
SPACES = r"\t\n\v\f\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANKS = re.compile(f"[{SPACES}]+")
EXTRA_BLANKS = re.compile("[\x1c-\x1f]")
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def keep(known: dict[str, bytes], word: str, ids: bytes) -> None:
    """Remember a word; a full table first loses its older half."""
    if len(word) <= MAX_KEPT_LENGTH:
        if len(known) >= MAX_WORDS:
            for old in list(islice(known, MAX_WORDS // 2)):
                del known[old]
        known[word] = ids


class Bpe:
    """Tables of one vocabulary. A word is a string of symbols: its bytes as characters 0 to 255,
    the last one moved up by 256."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = {letter: chr(b) for b, letter in enumerate(byte_letters())}

        def symbols(token: str) -> str:
            if token.endswith(WORD_END):
                plain = [letters[c] for c in token.removesuffix(WORD_END)]
                plain[-1] = chr(ord(plain[-1]) + 256)
                return "".join(plain)
            return "".join(letters[c] for c in token)

        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_split = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ) if self.special else None
        self.joined: dict[tuple[int, int], tuple[int, int]] = {}
        # Rank and both halves of each merged token; single symbols come before all merges.
        self.rank, self.halves = {}, {}
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            pair, token = (vocab[left], vocab[right]), vocab[left + right]
            self.joined[pair] = (rank, token)
            self.rank.setdefault(token, rank)
            self.halves.setdefault(token, pair)
        self.lengths, self.automaton = {}, ahocorasick.Automaton()
        singles = {}
        for token, number in vocab.items():
            text = symbols(token)
            self.lengths[number] = len(text)
            if len(text) == 1:
                singles[text] = number
        for token, number in vocab.items():
            # A token that its own text would not give can never come out.
            if number not in self.halves or self.plain_merge(symbols(token), singles) == [number]:
                self.automaton.add_word(symbols(token), number)
        self.automaton.make_automaton()
        # For each token the longest other one that it begins with, or -1.
        self.shorter = {}
        for text, number in self.automaton.items():
            shorter = (self.automaton.get(text[:k], None) for k in range(len(text) - 1, 0, -1))
            self.shorter[number] = next((x for x in shorter if x is not None), -1)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        # Offset table for decoding: each token's text, with the blank that joins tokens.
        texts = {number: token for token, number in vocab.items()} | {n: t for t, n in self.special.items()}
        encoded = [(texts.get(i, "") + " ").encode() for i in range(max(texts) + 1)]
        self.sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.buffer = np.frombuffer(b"".join(encoded), dtype=np.uint8)

    def plain_merge(self, text: str, singles: dict[str, int]) -> list[int]:
        """Merging by definition, used for single tokens only."""
        parts = [singles[c] for c in text]
        while len(parts) > 1:
            ranked = [(self.joined[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.joined]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i : i + 2] = [self.joined[parts[i], parts[i + 1]][1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.border_holds(left, right)
        return known

    def border_holds(self, left: int, right: int) -> bool:
        """Undo the later merge on either side of the border, again and again. The border breaks if
        a merge across it comes before the one that was undone last: earlier by rank, or of the
        same rank and further left."""
        limit, inclusive = float("inf"), False
        while True:
            across = self.joined.get((left, right))
            if across and (across[0] < limit or inclusive and across[0] == limit):
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # the pair on the left was merged first among equals, before one across
                limit, inclusive = a, False
                left = self.halves[left][1]
            else:  # one across stands left of the pair on the right and would be first
                limit, inclusive = b, True
                right = self.halves[right][0]

    def merged(self, word: str) -> list[int]:
        """Tokens of one word of symbols: the longest match at each place, and steps back where
        neighbours are not compatible."""
        longest = [number for _, number in self.automaton.iter_long(word)]
        pairs = self.pairs
        for i, pair in enumerate(zip(longest, longest[1:])):
            if not (pairs[pair] if pair in pairs else self.compatible(*pair)):
                return self.stepping_back(word, longest[: i + 1], longest[i + 1])
        return longest

    def stepping_back(self, word: str, out: list[int], number: int) -> list[int]:
        """Go on after the tokens `out`, trying `number` and its shorter beginnings next."""
        size, lengths, shorter, pairs = len(word), self.lengths, self.shorter, self.pairs
        at = sum(lengths[x] for x in out)
        dead = set()
        while at < size:
            while number >= 0:
                end = at + lengths[number]
                if end not in dead:
                    if not out:
                        break
                    pair = (out[-1], number)
                    if pairs[pair] if pair in pairs else self.compatible(*pair):
                        break
                number = shorter[number]
            if number >= 0:
                out.append(number)
                at = end
                if at < size:
                    number = next(self.automaton.iter_long(word, at))[1]
            else:
                dead.add(at)
                number = out.pop()
                at -= lengths[number]
                number = shorter[number]
        return out

    def chunk(self, text: str) -> bytes:
        """Ids, four bytes each, of a text without white space."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        out = []
        for word in WORDS.findall(text):
            ids = self.words.get(word)
            if ids is None:
                raw = word.encode("utf-8", "surrogatepass").decode("latin-1")
                ids = packed(self.merged(raw[:-1] + chr(ord(raw[-1]) + 256)))
                keep(self.words, word, ids)
            out.append(ids)
        return b"".join(out)

    def plain(self, text: str) -> bytes:
        chunks = BLANKS.split(text) if EXTRA_BLANKS.search(text) else text.split()
        out = list(map(self.chunks.get, chunks))
        if None in out:
            known = self.chunks
            for i, ids in enumerate(out):
                if ids is None:
                    out[i] = known.get(chunks[i])
                    if out[i] is None:
                        out[i] = self.chunk(chunks[i])
                        keep(known, chunks[i], out[i])
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        if self.special_split is None or not self.special_split.search(text):
            raw = self.plain(text)
        else:
            raw = b"".join(
                self.special[part].to_bytes(4, "little") if part in self.special else self.plain(part)
                for part in self.special_split.split(text)
            )
        return np.frombuffer(raw, dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of the ids, in UTF-8; one blank stands between tokens."""
        if not len(ids):
            return b""
        pieces = []
        for i in range(0, len(ids), 1 << 18):
            own = ids[i : i + (1 << 18)]
            sizes = self.sizes[own]
            shift = self.offsets[own] - (np.cumsum(sizes) - sizes)
            pieces.append(self.buffer[np.repeat(shift, sizes) + np.arange(sizes.sum())].tobytes())
        return b"".join(pieces)[:-1]


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    return Bpe(path)


WORKER_TABLES["bpe"] = loaded.cache_clear


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", carried: list[str] | None = None) -> DataFrame:
    """key, the `carried` columns, n_tokens, ids and the sha256 of the decoded text, for every row."""
    first = [key, *(carried or [])]
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in first)

    def run(stream):
        bpe = loaded(path)
        for batch in stream:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = [bpe.encode(t or "") for t in part.column(len(first)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(first)], pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                     pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string())],
                    names=[*first, "n_tokens", "ids", "decoded_sha256"],
                )

    return docs.select(*first, "text").mapInArrow(lean(run, "bpe"), f"{types}, n_tokens bigint, ids array<int>, decoded_sha256 string")


def decode_ids(rows: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """key, text: the texts of arrays of ids; null stays null."""
    key_type = rows.schema[key].dataType.simpleString()

    def run(stream):
        bpe = loaded(path)
        for batch in stream:
            texts = [None if x is None else bpe.decode(np.array(x, dtype=np.uint32)).decode() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return rows.select(key, ids).mapInArrow(lean(run, "bpe"), f"`{key}` {key_type}, text string")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row."""
    key_type = docs.schema["doc_id"].dataType.simpleString()

    def run(stream):
        bpe = loaded(path)
        for batch in stream:
            counts, coded, decoded = [], [], []
            for value in batch.column(1):
                ids = bpe.encode(value.as_py() or "")
                counts.append(len(ids))
                coded.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        lean(run, "bpe"), f"doc_id {key_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
