"""Packing of documents into sequences: cutting-stock column generation over the histogram of piece lengths."""

from __future__ import annotations

import json
import os
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.columns import flat, over_chunks, spread, staged
from llm.hashing import word_bounds

#: Tokens of a sequence, the id that ends a document, and the width of a length class: lengths are planned as rounded up to it.
LENGTH = 2048
END = 1
WIDTH = 4
#: A class's pieces are ranked in so many parts, whose sizes are added up. With the number of classes it bounds a broadcast table.
SALTS = 64
#: The plan is good enough when it is this close to the bound that the prices prove; it also ends after so many patterns.
GAP = 0.001
MOST_PATTERNS = 1500
#: A worker holds words and their ids of about so many bytes. Beyond, those go that were met in one chunk only, or all if most
#: were met again; results do not depend on it.
KNOWN_BYTES = 24 << 20
#: So many words of letters go to the library as one text.
JOINED = 256
#: What a held word takes besides its bytes and ids.
_PER_WORD = 120


# The pattern of a tokenizer that takes runs of letters, single digits and runs of other characters apart, and its mark of a word's end.
END_OF_WORD = "</w>"
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Ids of texts by the tokenizers library, which sees each distinct word between white space once."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        first = (kind["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        self.cuts = first.get("pattern") == {"Regex": LETTERS_APART} and first.get("invert") is True and kind["model"].get("end_of_word_suffix") == END_OF_WORD
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(END_OF_WORD)]] = True
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.length, self.again = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, bool)
        self.held = 0

    def _forget(self) -> None:
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > len(self.again):
            self._clear()
            return
        words = list(self.index)  # in the order of their numbers
        starts = np.cumsum(self.length, dtype=np.int64) - self.length
        self.ids = spread(self.ids, starts[kept], self.length[kept].astype(np.int64))
        self.length, self.again = self.length[kept], np.zeros(len(kept), bool)
        self.index = {words[i]: n for n, i in enumerate(kept.tolist())}
        self.held = sum(len(w) for w in self.index) + 4 * len(self.ids) + _PER_WORD * len(kept)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, JOINED to a text: the last token of such a word, and no other, ends in END_OF_WORD."""
        texts = [" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids = np.array([i for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) for i in x.ids], np.int32)
        ends = np.flatnonzero(self.is_end[ids]) if len(ids) else ids
        return ids, np.diff(np.r_[-1, ends]).astype(np.int32)

    def _single(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        length = np.fromiter(map(len, found), np.int32, len(found))
        return np.fromiter((i for x in found for i in x), np.int32, int(length.sum())), length

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of distinct words, those not met before after the library has encoded them, all in one call."""
        index = self.index
        known = len(index)
        fresh = [w for w in words if w not in index]
        if fresh:
            whole = [w for w in fresh if self.cuts and w.isalpha() and w.isascii()]
            if whole:
                fresh = [*whole, *(w for w in fresh if not (w.isalpha() and w.isascii()))]
            ids, length = (np.concatenate(x) for x in zip(self._joined(whole), self._single(fresh[len(whole) :]), strict=True))
            index.update(zip(fresh, range(known, known + len(fresh)), strict=True))
            self.ids, self.length = np.concatenate([self.ids, ids]), np.concatenate([self.length, length])
            self.again = np.concatenate([self.again, np.zeros(len(fresh), bool)])
            self.held += sum(map(len, fresh)) + 4 * len(ids) + _PER_WORD * len(fresh)
        numbers = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        self.again[numbers[numbers < known]] = True
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts (null: none), and how many each has."""
        if self.held > KNOWN_BYTES:
            self._forget()
        data, offsets = flat(texts)
        starts, ends, bounds = word_bounds(data, offsets)  # at the six ASCII spaces, as the tokenizer does
        if self.cuts:
            starts, ends, bounds = _cut(data, starts, ends, bounds)
        lengths = ends - starts
        where = np.cumsum(np.r_[0, lengths])
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(where), pa.py_buffer(spread(data, starts, lengths))]).dictionary_encode()
        numbers = self._numbers(words.dictionary.to_pylist())[words.indices.to_numpy()]
        length = self.length[numbers].astype(np.int64)
        at = np.cumsum(self.length, dtype=np.int64) - self.length
        return spread(self.ids, at[numbers], length), np.diff(np.r_[0, np.cumsum(length)][bounds])


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words cut where an ASCII letter meets an ASCII character that is none, at which LETTERS_APART cuts as well.

    Not behind an apostrophe, which may begin an ending such as 's, and not in words that may hold a special token. Far fewer
    of the pieces are new to a worker than of the words."""
    small = data | np.uint8(32)
    letter = (small >= 97) & (small <= 122)
    other = (data < 128) & ~letter & (data > 32)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (letter[:-1] & other[1:]) | (other[:-1] & letter[1:] & (data[:-1] != 39))
    special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
    if len(special):
        for i in np.unique(np.searchsorted(starts, special, "right") - 1).tolist():
            cut[starts[i] : ends[i]] = False
    cut[starts] = False  # where a text ends and the next begins, words are apart already
    before = np.cumsum(cut)
    more = np.r_[before[starts], before[-1:]] if len(starts) else np.zeros(1, np.int64)
    is_start, is_end = cut.copy(), cut
    is_start[starts], is_end[ends] = True, True
    return np.flatnonzero(is_start), np.flatnonzero(is_end), (bounds + more[bounds]).astype(np.int64)


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece: whole sequences, then what is left of the document.

    With `with_ids`, the ids as well. Null and empty texts are the end id alone; repeated rows are documents of their own."""

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        plain, count = word_ids(path).encode(chunk.column("text"))
        total = count + 1
        ends = np.cumsum(total)
        ids = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint32)
        body = np.ones(len(ids), bool)
        body[ends - 1] = False
        ids[body] = plain
        number = -(-total // LENGTH)
        row = np.repeat(np.arange(len(total)), number)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * LENGTH
        length = np.minimum(LENGTH, total[row] - start)
        at = (ends - total)[row] + start
        raw = ids.astype("<u4").view(np.uint8)
        crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
        out = {"doc_id": chunk.column("doc_id").take(pa.array(row)), "start": start, "length": length, "ids_crc32": crc, "doc_tokens": total[row]}
        if with_ids:
            out["ids"] = pa.ListArray.from_arrays(np.r_[at, ends[-1:]].astype(np.int32), pa.array(ids.astype(np.int32)))
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return over_chunks(docs, ["doc_id", "text"], work, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids)


def knapsack(price: np.ndarray, units: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of largest total price whose units fit in `room`, by dynamic programming over the room."""
    best, taken = np.zeros(room + 1), np.full(room + 1, -1)
    order = np.argsort(units)
    sorted_units, sorted_price = units[order], price[order]
    for space in range(1, room + 1):
        fitting = int(np.searchsorted(sorted_units, space, "right"))
        best[space], taken[space] = best[space - 1], -1
        if fitting:
            values = best[space - sorted_units[:fitting]] + sorted_price[:fitting]
            i = int(values.argmax())
            if values[i] > best[space] + 1e-12:
                best[space], taken[space] = values[i], i
    pattern, space = np.zeros(len(units), np.int64), room
    while space > 0:
        if taken[space] < 0:
            space -= 1
        else:
            pattern[order[taken[space]]] += 1
            space -= int(sorted_units[taken[space]])
    return float(best[room]), pattern


def first_basis(demand: np.ndarray, units: np.ndarray, room: int) -> np.ndarray:
    """Patterns (columns) whose fractions meet the demand: in turn the fullest pattern of what is left, larger pieces first.

    Each is used until a class runs out, and no later pattern has that class: the columns are a basis."""
    left, columns = demand.copy(), np.zeros((len(units), len(units)))
    value = units + 1e-3 * units * units / room
    open_classes = np.ones(len(units), bool)
    for k in range(len(units)):
        some = np.flatnonzero(open_classes)
        pattern = np.zeros(len(units), np.int64)
        pattern[some] = knapsack(value[some], units[some], room)[1]
        ratio = np.where(pattern > 0, left / np.maximum(pattern, 1), np.inf)
        out = int(ratio.argmin())
        left = np.maximum(left - ratio[out] * pattern, 0)
        columns[:, k] = pattern
        open_classes[out] = False
    return columns


def patterns(demand: np.ndarray, units: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, in fractions, in a least number of sequences that meets the demand.

    Revised simplex over the patterns found so far; the knapsack finds the pattern of best reduced cost."""
    m = len(units)
    columns = first_basis(demand, units, room)
    inverse = np.linalg.inv(columns)
    used = np.maximum(inverse @ demand, 0)
    for _ in range(MOST_PATTERNS):
        price = inverse.sum(0)
        value, pattern = knapsack(np.maximum(price, 0), units, room)
        bound = max(price @ demand / max(value, 1), units @ demand / room)
        if value <= 1 + 1e-9 or bound >= (1 - GAP) * used.sum():
            break
        into = inverse @ pattern
        ratio = np.where(into > 1e-9, used / np.where(into > 1e-9, into, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        used = np.maximum(used - step * into, 0)
        used[out] = step
        columns[:, out] = pattern
        inverse[out] /= into[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(into[others], inverse[out])
    return columns.astype(np.int64), used


def fullest(left: np.ndarray, units: np.ndarray, room: int) -> np.ndarray:
    """A pattern of what is left with its largest piece, and the fullest there is with that: subset sums over the room."""
    pattern = np.zeros(len(units), np.int64)
    largest = int(np.flatnonzero(left)[-1])
    pattern[largest] = 1
    rest = left - pattern
    room -= int(units[largest])
    items = np.repeat(np.arange(len(units)), np.minimum(rest, room // units))[::-1]
    reached = np.zeros((len(items) + 1, room + 1), bool)
    reached[0, 0] = True
    for k, i in enumerate(items.tolist()):
        u = int(units[i])
        reached[k + 1] = reached[k]
        reached[k + 1, u:] |= reached[k, : room + 1 - u]
    space = int(np.flatnonzero(reached[-1])[-1])
    for k in range(len(items) - 1, -1, -1):
        if not reached[k, space]:
            pattern[items[k]] += 1
            space -= int(units[items[k]])
    return pattern


@dataclass
class Plan:
    """Where the pieces of each class go. Entry i serves ranks from `first[i]` of its class on: `each[i]` of them in each of the
    sequences from `sequence[i]` on, at places from `slot[i]` on. Entries are sorted by class and rank."""

    classes: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    slot: np.ndarray
    sequences: int


def plan(demand: np.ndarray, room: int) -> Plan:
    """demand[u]: pieces of u units. Patterns are used as often as the whole part says; what is left is filled sequence by sequence."""
    units = np.flatnonzero(demand)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    given = np.zeros(len(units), np.int64)

    def use(pattern: np.ndarray, times: int) -> None:
        nonlocal sequences
        slot = 0
        for i in np.flatnonzero(pattern)[::-1].tolist():
            each = int(pattern[i])
            rows.append((int(units[i]), int(given[i]), each, sequences, slot))
            given[i] += each * times
            slot += each
        sequences += times

    if len(units):
        columns, used = patterns(demand[units].astype(np.float64), units, room)
        times = np.floor(used + 1e-9).astype(np.int64)
        over = columns @ times - demand[units]
        for j in np.flatnonzero(times):
            while times[j] and (over[columns[:, j] > 0] > 0).any():  # rounding noise must not serve more than there is
                times[j] -= 1
                over -= columns[:, j]
        for j in np.flatnonzero(times):
            use(columns[:, j], int(times[j]))
        left = demand[units] - columns @ times
        while left.any():
            pattern = fullest(left, units, room)
            use(pattern, 1)
            left = left - pattern
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Plan(*table.T, sequences)


def pack(found: DataFrame) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset.

    Only the histogram of length classes, at most LENGTH / WIDTH rows, and the plan made of it pass through the driver.
    Pieces of a class are ranked by document; a rank's place follows from the plan. A class may hold any share of the
    rows: it is ranked in SALTS parts."""
    kept = [f for f in found.schema.fields]
    names = [f.name for f in kept]
    sized = found.withColumn("__class", F.ceil(F.col("length") / WIDTH).cast("int")).withColumn("__salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS)).cast("int"))
    counted = sized.groupBy("__class", "__salt").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__class").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counted.withColumn("__before", before).toArrow()  # at most SALTS rows for each class
    demand = np.zeros(LENGTH // WIDTH + 1, np.int64)
    np.add.at(demand, counts["__class"].to_numpy(), counts["__n"].to_numpy())
    made = plan(demand, LENGTH // WIDTH)
    base = np.zeros((len(demand), SALTS), np.int64)
    base[counts["__class"].to_numpy(), counts["__salt"].to_numpy()] = counts["__before"].to_numpy()
    ranked = sized.withColumn("__rank", F.row_number().over(Window.partitionBy("__class", "__salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")))
    reach = 1 << 40
    starts = made.classes * reach + made.first

    def place(batches):
        for batch in batches:
            kind, salt, rank = (batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("__class", "__salt", "__rank"))
            rank = rank - 1 + base[kind, salt]
            entry = np.searchsorted(starts, kind * reach + rank, "right") - 1
            nth = rank - made.first[entry]
            sequence, slot = made.sequence[entry] + nth // made.each[entry], made.slot[entry] + nth % made.each[entry]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(sequence), pa.array(slot)], names=[*names, "sequence_id", "__slot"])

    shape = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("__slot", T.LongType())])
    placed = ranked.mapInArrow(place, shape)
    earlier = Window.partitionBy("sequence_id").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("__slot")


def pack_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every document."""
    return pack(staged(pieces(docs, path)))
