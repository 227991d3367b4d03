"""Byte-level BPE: words of many texts are merged together in numpy rounds over one flat array of symbols."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.columns import over_chunks, spread, strings

#: Fixed value: how byte-level BPE cuts a text into words.
WORDS = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A worker forgets the words it has met when there are more than this; results do not depend on it.
KNOWN_WORDS = 400_000
NO_PAIR = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The printable character by which the vocabulary writes each byte, with its byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(others)}


class Merges:
    """Ids of words by merge rounds. In a round every word merges all places of its lowest-ranked pair.

    A merged symbol's own pairs rank behind the merge that made it, so a round does what one merge after another would."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        vocabulary, letters = stored["model"]["vocab"], byte_letters()
        self.special = {x["content"]: x["id"] for x in stored["added_tokens"]}
        size = max(max(vocabulary.values()), *self.special.values(), 0) + 1
        pieces = [b""] * size
        for token, i in vocabulary.items():
            pieces[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.pieces = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_length = np.array([len(x) for x in pieces], np.int64)
        self.piece_start = np.cumsum(self.piece_length) - self.piece_length
        names = [b"%d," % i for i in range(size)]
        self.decimals = np.frombuffer(b"".join(names), np.uint8)
        self.decimal_length = np.array([len(x) for x in names], np.int64)
        self.decimal_start = np.cumsum(self.decimal_length) - self.decimal_length
        self.first = np.zeros(256, np.int64)
        for c, byte in letters.items():
            self.first[byte] = vocabulary[c]
        merges = [x.split(" ") if isinstance(x, str) else x for x in stored["model"]["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.index: dict[str, int] = {}
        self.ids, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of each pair, by binary search over the sorted pair keys; NO_PAIR where no merge exists."""
        pairs = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.rank[at], NO_PAIR)

    def encode(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all words, and how many each has."""
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.array([len(x) for x in words], np.int64)
        symbol = self.first[data]
        word = np.repeat(np.arange(len(words)), length)
        done_ids, done_word = [], []
        rank = self._pair_ranks(symbol, word)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[starts, len(word)])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), size)
            over = lowest == NO_PAIR
            if over.any():
                done_ids.append(symbol[over])
                done_word.append(word[over])
                symbol, word, rank, lowest = symbol[~over], word[~over], rank[~over], lowest[~over]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == lowest)
            # of touching hits, as in a a a, every second one from the left merges
            run = np.r_[True, np.diff(hit) != 1]
            begin = hit[run][np.cumsum(run) - 1]
            hit = hit[(hit - begin) % 2 == 0]
            symbol[hit] = self.made[lowest[hit]]
            stay = np.ones(len(symbol), bool)
            stay[hit + 1] = False
            touched = np.zeros(len(symbol), bool)
            touched[hit] = True
            touched[np.maximum(hit - 1, 0)] = True  # the pair to the left changed as well; if that symbol is gone, a hit took it in
            symbol, word, rank, touched = symbol[stay], word[stay], rank[stay], touched[stay]
            fresh = np.flatnonzero(touched)
            inner = fresh[fresh + 1 < len(word)]
            rank[fresh] = NO_PAIR
            inner = inner[word[inner] == word[inner + 1]]
            rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_word)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(words))

    def _pair_ranks(self, symbol: np.ndarray, word: np.ndarray) -> np.ndarray:
        rank = np.full(len(symbol), NO_PAIR)
        inner = np.flatnonzero(word[1:] == word[:-1]) if len(word) else np.zeros(0, np.int64)
        rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        return rank

    def words(self, text: str) -> list[str]:
        """A special token's string is a word of its own, as in the library."""
        if self.split is None or not self.split.search(text):
            return WORDS.findall(text)
        found, at = [], 0
        for m in self.split.finditer(text):
            found += [*WORDS.findall(text[at : m.start()]), m[0]]
            at = m.end()
        return found + WORDS.findall(text[at:])

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and how many each has. Words met before are looked up."""
        split = [self.words(x) for x in texts]
        if len(self.index) > KNOWN_WORDS:
            self.index, self.ids, self.length = {}, self.ids[:0], self.length[:0]
        index = self.index
        fresh = list({w for words in split for w in words if w not in index})
        if fresh:
            plain = [w for w in fresh if w not in self.special]
            extra = [w for w in fresh if w in self.special]
            ids, length = self.encode([w.encode("utf-8", "surrogatepass") for w in plain])
            for w in plain + extra:
                index[w] = len(index)
            self.ids = np.concatenate([self.ids, ids, [self.special[w] for w in extra]]).astype(np.int64)
            self.length = np.concatenate([self.length, length, [1] * len(extra)]).astype(np.int64)
        starts = np.cumsum(self.length) - self.length
        flat = np.fromiter((index[w] for words in split for w in words), np.int64)
        ids = spread(self.ids, starts[flat], self.length[flat])
        ends = np.cumsum(np.r_[0, self.length[flat]])
        bounds = np.cumsum([0, *map(len, split)])
        return ids, np.diff(ends[bounds])

    def spelled(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Each id in decimal with a comma behind it, and where each begins."""
        length = self.decimal_length[ids]
        return spread(self.decimals, self.decimal_start[ids], length).tobytes(), np.r_[0, np.cumsum(length)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        return spread(self.pieces, self.piece_start[ids], self.piece_length[ids])


_LOADED: dict[str, Merges] = {}


def merges(path: str) -> Merges:
    """The tables of a vocabulary file, read once in each worker."""
    if path not in _LOADED:
        _LOADED[path] = Merges(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int> of every text. Null and empty texts have no ids; repeated rows come out once each."""

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        ids, length = merges(path).encode_texts(strings(chunk.column("text")))
        return {"doc_id": chunk.column("doc_id"), "ids": pa.ListArray.from_arrays(np.r_[0, np.cumsum(length)].astype(np.int32), pa.array(ids.astype(np.int32)))}

    return over_chunks(docs, ["doc_id", "text"], work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of every row of `encode`; bytes that are no UTF-8 become U+FFFD. Null ids count as none."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    sized = encoded.select("doc_id", F.expr("coalesce(ids, array()) AS ids"))

    def run(batches):
        for batch in batches:
            table = merges(path)
            texts = [bytes(table.decode(np.asarray(x, np.int64))).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return sized.mapInArrow(run, f"doc_id {kind}, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: encoded, then decoded from those ids alone."""

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        table = merges(path)
        ids, length = table.encode_texts(strings(chunk.column("text")))
        ends = np.cumsum(length)
        starts = ends - length
        size = np.r_[0, np.cumsum(table.piece_length[ids])]
        decoded = table.decode(ids).tobytes()
        spelled, spelled_at = table.spelled(ids)
        ids_sha, text_sha = [], []
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            ids_sha.append(hashlib.sha256(spelled[spelled_at[a] : max(spelled_at[b] - 1, spelled_at[a])]).hexdigest())
            own = decoded[size[a] : size[b]].decode("utf-8", "replace").encode()
            text_sha.append(hashlib.sha256(own).hexdigest())
        return {"doc_id": chunk.column("doc_id"), "n_tokens": length, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    return over_chunks(docs, ["doc_id", "text"], work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
