"""Packing of token sequences by patterns of few lengths, fitted to the histogram of lengths.

Texts are encoded, closed by an end id and cut into pieces of at most ``capacity`` ids.  Which pieces
share a sequence depends on their lengths only, so it is decided on the histogram, which has at most
``capacity`` rows at any size of the corpus:

1. all patterns of up to ``docs`` lengths that fill a sequence exactly are enumerated,
2. repeat counts are fitted to the histogram by non-negative least squares,
3. they are rounded, the rest of one count carried to the next, and limited to what is left,
4. the lengths left over are packed around the longest of them, by an exact pair if there is one, else
   by the longest that fits; such a pattern too is repeated as often as its lengths last.

Where long pieces outnumber what can complete them, exact patterns take from these; so steps 3 and 4 are
also tried with half the counts and with none, and the fewest sequences decide.

The patterns then are a table of runs over the places of the pieces in order of length: a piece's place
says its sequence and its offset.  No window, group or task sees all pieces of a length.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadastre.llm.common import fresh, numbered, ship
from cadastre.llm.words import byte_table, split, text_bytes
from cadastre.sources.scratch import settle

CAPACITY = 2048
END_ID = 0
DOCS = 3
ROUNDS = 300
SLICE = 4 << 20  # bytes of text handled at once
CACHE_IDS = 6_000_000
OF_CHUNK = byte_table(b" \t\n\x0b\x0c\r")
SIGNS = ~byte_table(b".,;:!?")
CAPITALS = ~byte_table(bytes(range(0x41, 0x5B)))
SMALL = ~byte_table(bytes(range(0x61, 0x7B)))


class ChunkEncoder:
    """Ids of whole texts by the tokenizers library, for vocabularies that drop white space.

    No pre-token reaches across ASCII white space, so each different run between it is encoded once and
    remembered, ``CACHE_IDS`` ids at most; then all is forgotten.  The vocabulary is
    one that lower-cases.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self):
        self.known: dict[bytes, int] = {}
        self.first, self.count, self.ids = np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, "u4")

    def _learn(self, chunks: list[bytes]):
        found = self.tokenizer.encode([c.decode() for c in chunks], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, "u4")
        count = np.bincount(np.array(found.word_ids, "i8"), minlength=len(chunks)) if len(ids) else np.zeros(len(chunks), "i8")
        self.known.update(zip(chunks, range(len(self.first), len(self.first) + len(chunks)), strict=True))
        self.first = np.append(self.first, len(self.ids) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.ids = np.append(self.ids, ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids per text)."""
        if len(self.ids) > CACHE_IDS:
            self._forget()
        data, begins = text_bytes(texts)
        data, cuts = _alike(data, begins)
        words, low = split(data, OF_CHUNK, np.append(begins, cuts))
        coded = words.dictionary_encode()
        different = coded.dictionary.to_pylist()
        new = [w for w in different if w not in self.known]
        if new:
            self._learn(new)
        place = np.fromiter(map(self.known.__getitem__, different), "i8", len(different))
        word = place[coded.indices.to_numpy()] if len(words) else np.zeros(0, "i8")
        count = self.count[word]
        end = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[word] - (end - count), count) + np.arange(end[-1] if len(end) else 0)]
        upto = np.append(0, end)[np.searchsorted(low, begins)]
        return ids, np.diff(upto)


def _alike(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes with fewer different runs but the same ids, places where runs are cut besides).

    A-Z are lower-cased, but not before a byte that could belong to a combining mark, nor in texts with
    ``<|``, which may begin a special token.  A single sign that ends a run is cut off after a letter.
    """
    if len(data) < 2 or b"<|" in data.tobytes():
        return data, np.zeros(0, "i8")
    after = np.append(data[1:], np.uint8(32))
    after[begins[(begins > 0) & (begins < len(data))] - 1] = 32
    plain = (after < 0x80) | (after == 0xC3)
    data = data + (CAPITALS[data] & plain) * np.uint8(32)
    # U+00C0 to U+00FF but for the signs of multiplication and division.
    latin = np.append(False, (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    letter = SMALL[data] | latin
    sign = SIGNS[data] & ~OF_CHUNK[after]
    return data, np.flatnonzero(sign[1:] & letter[:-1]) + 1


_encoders: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``SLICE`` bytes of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("i8"))
    low = 0
    while low < len(texts):
        before = size[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(size, before + SLICE)))
        yield low, high
        low = high


def pieces(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(id, piece, start, length, ids) per piece: the ids of a text and its end id, ``capacity`` at a time.

    ids are little-endian 32-bit numbers.  A null or empty text is the end id alone.  Repeated rows are
    kept, null ids too; an empty table gives no rows.  Other columns are not looked at.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            whole = batch.column(1)
            for low, high in _slices(whole):
                ids, count = _encoder(path).encode(whole.slice(low, high - low))
                total = count + 1
                closed = np.full(int(total.sum()), end_id, "<u4")
                inside = np.ones(len(closed), bool)
                inside[np.cumsum(total) - 1] = False
                closed[inside] = ids
                parts = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(total[row] - start, capacity)
                at = np.append(0, np.cumsum(length)) * 4
                held = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(at), pa.py_buffer(closed)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low).take(pa.array(row)),
                        pa.array(piece.astype("i4")), pa.array(start), pa.array(length), held.cast(pa.binary()),
                    ],
                    names=["id", "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    made = rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary")
    return made.withColumnRenamed("id", id)


def patterns(counts: np.ndarray, docs: int = DOCS) -> np.ndarray:
    """All multisets of 1 to ``docs`` (at most 3) lengths that occur and sum to the capacity; 0 fills up.

    ``counts[n]`` is the number of pieces of length n, for n from 0 to the capacity.
    """
    capacity, there = len(counts) - 1, np.append(True, counts[1:] > 0)
    found = []
    for a in range(-(-capacity // docs), capacity + 1):
        if not there[a]:
            continue
        rest = capacity - a
        b = np.arange(-(-rest // 2), min(a, rest) + 1) if docs > 2 else np.array([rest] if rest <= a else [], "i8")
        if docs < 2:
            b = b[b == 0]
        b = b[there[b] & there[rest - b]]
        found.append(np.stack([np.full(len(b), a), b, rest - b], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), "i8")


def fit(lengths: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that bring the lengths used nearest to ``counts`` in least squares.

    A length weighs as much as its share of the capacity: long pieces left over need a sequence each,
    short ones fill gaps.  Accelerated projected gradient with a restart when it turns uphill; a pattern
    touches three lengths, so a step costs three look-ups per pattern.
    """
    size, here = len(counts), (lengths > 0).astype("f8")
    goal, weight = counts.astype("f8"), np.arange(size) / (size - 1)

    def used(x):
        return np.bincount(lengths.ravel(), (here * x[:, None]).ravel(), size)

    def up(misfit):
        return ((weight * misfit)[lengths] * here).sum(axis=1)

    # The greatest row sum of A'WA bounds its greatest eigenvalue.
    step = 1 / max(up(used(np.ones(len(lengths)))).max(initial=0), 1e-9)
    x = y = np.zeros(len(lengths))
    t = 1.0
    for _ in range(rounds):
        gradient = up(used(y) - goal)
        new = np.maximum(y - step * gradient, 0)
        if gradient @ (new - x) > 0:
            t = 1.0
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / grown * (new - x), new, grown
    return x


def rounded(lengths: np.ndarray, repeat: np.ndarray, left: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """(copies, lengths) from fitted counts, taken out of ``left``; what a count has beyond a whole is carried on."""
    out, carry = [], 0.0
    order = np.argsort(-repeat, kind="stable")
    for row, x in zip(lengths[order].tolist(), repeat[order].tolist(), strict=True):
        carry += x
        if carry < 1:
            continue
        row = tuple(n for n in row if n)
        copies = min(int(carry), *(int(left[n]) // row.count(n) for n in row))
        carry = min(carry - copies, 1.0)
        if copies > 0:
            out.append((copies, row))
            for n in row:
                left[n] -= copies
    return out


def residual(left: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """(copies, lengths) that use up ``left``: the longest, then an exact pair or the longest that fits."""
    out, capacity = [], len(left) - 1
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return out
        row, gap, mine = [int(there[-1])], capacity - int(there[-1]), left.copy()
        mine[row[0]] -= 1
        while gap:
            best = gap
            if not mine[gap]:
                pair = np.flatnonzero((mine[1:gap] > 0) & (mine[gap - 1 : 0 : -1] > 0)) + 1
                pair = pair[(2 * pair != gap) | (mine[pair] > 1)]
                fits = pair if len(pair) else np.flatnonzero(mine[: gap + 1])
                if not len(fits):
                    break
                best = int(fits[-1])
            row.append(best)
            mine[best] -= 1
            gap -= best
        copies = min(int(left[n]) // row.count(n) for n in set(row))
        out.append((copies, tuple(sorted(row, reverse=True))))
        for n in row:
            left[n] -= copies


def plan(counts: np.ndarray, docs: int = DOCS) -> list[tuple[int, tuple[int, ...]]]:
    """(copies, lengths in descending order) of the patterns that use up ``counts`` exactly.

    The fitted counts are rounded whole, halved and not at all; the plan with the fewest sequences counts.
    """
    counts = counts.astype("i8")
    counts[0] = 0
    lengths = patterns(counts, docs)
    repeat = fit(lengths, counts)
    plans = []
    for share in (1, 0.5, 0):
        left = counts.copy()
        plans.append(rounded(lengths, share * repeat, left) + residual(left))
    return min(plans, key=lambda chosen: sum(copies for copies, _ in chosen))


def runs(chosen: list[tuple[int, tuple[int, ...]]], counts: np.ndarray) -> pd.DataFrame:
    """(place, sequence, offset) of the first piece of each run; a run's next piece goes to the next sequence."""
    copies = np.array([c for c, _ in chosen], "i8")
    base = np.cumsum(copies) - copies
    width = [len(row) for _, row in chosen]
    pattern = np.repeat(np.arange(len(chosen)), width)
    length = np.array([n for _, row in chosen for n in row], "i8")
    offset = np.array([o for _, row in chosen for o in np.cumsum((0, *row[:-1]))], "i8")
    order = np.argsort(length, kind="stable")
    taken = copies[pattern[order]]
    return pd.DataFrame(
        {"place": np.cumsum(taken) - taken, "sequence": base[pattern[order]], "offset": offset[order]}
    )


def pack(rows: DataFrame, length: str = "length", capacity: int = CAPACITY, docs: int = DOCS) -> DataFrame:
    """Add sequence_id and offset to ``rows``, whose ``length`` is from 1 to ``capacity``.

    Sequences are numbered from 0; the pieces of one follow each other without a gap from offset 0.
    ``rows`` is written once; the driver receives one count per length.  Columns named sequence_id or
    offset give way.  A length that is null or out of range is an error.
    """
    rows = settle(rows.drop("sequence_id", "offset"))
    counts = np.zeros(capacity + 1, "i8")
    for r in rows.groupBy(F.col(length).cast("long").alias("n")).count().collect():
        if r["n"] is None or not 1 <= r["n"] <= capacity:
            raise ValueError(f"a length is {r['n']}, not from 1 to {capacity}")
        counts[r["n"]] = r["count"]
    if not counts.any():
        return rows.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    table = runs(plan(counts, docs), counts)
    first, sequence, offset = (table[c].to_numpy() for c in table)
    key, place = fresh(rows, "_key"), fresh(rows, "_place")
    placed = numbered(rows.withColumn(key, F.monotonically_increasing_id()), [F.col(length), F.col(key)], place)

    @F.pandas_udf("struct<sequence_id long, offset long>")
    def where(place: pd.Series) -> pd.DataFrame:
        run = np.searchsorted(first, place.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": sequence[run] + place.to_numpy() - first[run], "offset": offset[run]})

    spot = fresh(placed, "_spot")
    placed = placed.withColumn(spot, where(place))
    return placed.select(*rows.columns, f"{spot}.sequence_id", f"{spot}.offset")


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """(sequence_id, ids, lengths) per sequence: its pieces put together; at most ``capacity`` ids meet."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", F.col(ids).alias("ids"))))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b))
    return whole.select("sequence_id", joined.alias("ids"), F.col("parts.length").alias("lengths"))
