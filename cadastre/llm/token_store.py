"""Token ids in raw binary shards, each with a minimal perfect hash index over its documents.

A shard file holds, one after the other (little-endian):

    magic 8 bytes | id width, documents, buckets, ids, different keys: 5 x uint64
    payload     ids x uint16 or uint32, documents in ascending key order
    keys        documents x int64       the keys in payload order
    present     documents x uint8       0 for a null key
    offsets     (documents + 1) x uint64    where each document's ids begin, in ids
    seeds       buckets x int64         of the hash; -(slot + 1) names the slot itself
    slots       different keys x (uint32 fingerprint, uint32 first place in payload order)

and ends with the line end that Spark's text writer adds, the writer by which raw bytes reach any
store.  A keyed read needs one seed, one slot and two offsets.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadastre.llm.common import maybe_broadcast, ship
from cadastre.sources.scratch import cut

MAGIC = b"TOKSHRD2"
SHARD_IDS = 1 << 22
END_ID = 0
BUCKET_KEYS = 4
CACHE = 400_000
WIDTHS = {2: "<u2", 4: "<u4"}
SLOT = np.dtype([("print", "<u4"), ("place", "<u4")])

_encoders: dict[tuple[str, str], Encoder] = {}


def _mix(keys: np.ndarray, seed) -> np.ndarray:
    """A 64-bit mixing of integer keys with a seed (multiply and shift, public constants)."""
    x = keys.astype("u8") + np.asarray(seed).astype("u8") * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, -1) >> np.uint64(32)).astype("u4")


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, slot of each key) of a minimal perfect hash over distinct keys.

    Buckets are placed from the largest down: the first seed is taken that sends all keys of a
    bucket to free slots.  Buckets of one key take the free slots that are left.
    """
    n = len(keys)
    seeds = np.zeros(max(1, -(-n // BUCKET_KEYS)), "i8")
    slots, free = np.zeros(n, "i8"), np.ones(n, bool)
    if not n:
        return seeds, slots
    bucket = (_mix(keys, 0) % np.uint64(len(seeds))).astype("i8")
    order = np.argsort(bucket, kind="stable")
    low = np.searchsorted(bucket[order], np.arange(len(seeds) + 1))
    sizes = np.diff(low)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[low[b] : low[b + 1]]
        if len(members) < 2:
            break
        seed = 1
        while True:
            tries = _mix(keys[members][None, :], np.arange(seed, seed + 64)[:, None]) % np.uint64(n)
            good = free[tries.astype("i8")].all(axis=1)
            spread = np.sort(tries, axis=1)
            good &= (spread[:, 1:] != spread[:, :-1]).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                seeds[b], slots[members] = seed + k, tries[k].astype("i8")
                free[slots[members]] = False
                break
            seed += 64
    single = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    slots[order[low[single]]] = left
    seeds[single] = -(left + 1)
    return seeds, slots


def find_slot(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    seed = seeds[(_mix(keys, 0) % np.uint64(len(seeds))).astype("i8")]
    slot = (_mix(keys, np.maximum(seed, 0)) % np.uint64(max(n, 1))).astype("i8")
    return np.where(seed < 0, -seed - 1, slot)


def pack(keys: list, ids: list[bytes], width: int) -> bytes:
    """A shard from documents in key order; ``ids`` are bytes of ``width`` an id.

    Of equal keys the index names the first; the others follow it.
    """
    present = np.array([k is not None for k in keys], "u1")
    numbers = np.array([0 if k is None else k for k in keys], "i8")
    offsets = np.zeros(len(keys) + 1, "u8")
    offsets[1:] = np.cumsum([len(x) // width for x in ids])
    first = np.flatnonzero(present)
    first = first[np.unique(numbers[first], return_index=True)[1]]
    seeds, slots = build_hash(numbers[first])
    table = np.zeros(len(first), SLOT)
    table["print"][slots], table["place"][slots] = _fingerprint(numbers[first]), first
    head = np.array([width, len(keys), len(seeds), int(offsets[-1]), len(first)], "<u8")
    parts = [MAGIC, head.tobytes(), *ids, numbers.astype("<i8").tobytes(), present.tobytes()]
    return b"".join([*parts, offsets.astype("<u8").tobytes(), seeds.astype("<i8").tobytes(), table.tobytes()])


class Shard:
    """A shard file's bytes, read in place."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token shard")
        width, n, buckets, ids, distinct = map(int, np.frombuffer(data, "<u8", 5, 8))
        at = 48

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.ids = take(WIDTHS[width], ids)
        self.keys, self.present = take("<i8", n), take("u1", n).astype(bool)
        self.offsets, self.seeds = take("<u8", n + 1), take("<i8", buckets)
        self.table = take(SLOT, distinct)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of the first document of each key, -1 for a key that the shard lacks."""
        if not len(self.table):
            return np.full(len(keys), -1)
        at = self.table[find_slot(keys, self.seeds, len(self.table))]
        place = at["place"].astype("i8")
        known = (at["print"] == _fingerprint(keys)) & (self.keys[place] == keys)
        return np.where(known, place, -1)

    def document(self, place: int) -> np.ndarray:
        return self.ids[int(self.offsets[place]) : int(self.offsets[place + 1])]


# Places that no match of the vocabulary's pattern goes across; Python's class of white space holds
# every character that other engines call white.
SPACES = re.compile(r"\s\s")
SPACE_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
LINE_END = re.compile(r"\n(?=\S)(?<=\S\n)")
# One word, or one after a space, of letters that all engines class alike.
WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
LONGEST = 64  # characters of a piece that is remembered
SIGN_AFTER_WORD = re.compile("([.,;:!?])(?=[ \n])(?<=[A-Za-z\u00df-\u00f6\u00f8-\u00ff].)")
GLUED, LINE = "\x01", "\x02"  # begins a piece that has no space before it; a line end as a piece


def _pieces(text: str) -> list[str]:
    """The text in pieces that can be encoded one by one.

    It is cut at single spaces, which a piece without ``GLUED`` has lost, around single line ends
    and before a sign that ends a word.
    """
    text = SIGN_AFTER_WORD.sub(f" {GLUED}\\1", GLUED + text)
    text = LINE_END.sub(f" {LINE} {GLUED}", text)
    return SPACE_BETWEEN.split(text) if SPACES.search(text) else text.split(" ")


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: itself if it prints, else the next letter from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in prints)
    return {b: chr(b) for b in prints} | {b: chr(0x100 + i) for i, b in enumerate(others)}


LETTERS = byte_letters()


class Known(dict):
    """Ids of pieces; one that is missing comes from ``older``, else from ``encode``, and stays unless it is long."""

    def __init__(self, encode: Callable[[str], bytes], older: dict[str, bytes]):
        self.encode, self.older = encode, dict(older)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts by the tokenizers library, without special tokens added.

    The pieces of texts are encoded once and remembered, ``CACHE`` of them and as many before, long ones
    excepted.  A piece that is one word goes to the library's model without the stages before it, if these
    leave words as they are.  Texts that name a special token, or hold the marks themselves, go to the
    library as they are.
    """

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # Arrays of the machine's order, which is little-endian wherever Spark runs.
        self.tokenizer, self.code = Tokenizer.from_file(path), {"<u2": "H", "<u4": "I"}[kind]
        self.special = [GLUED, LINE, *(t.content for t in self.tokenizer.get_added_tokens_decoder().values())]
        self.known = Known(self.piece, {})
        probes = [" probe", "Probe", " \u00e9t\u00e9", "\u0141\u00f3d\u017a", "x" * 50, " THE"]
        self.direct = [self._word(p) for p in probes] == self._library(probes)

    def _word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(LETTERS)
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a piece as ``_pieces`` makes it."""
        plain = "\n" if piece == LINE else piece[1:] if piece[:1] == GLUED else " " + piece
        return self._word(plain) if self.direct and WORD.fullmatch(plain) else self._library([plain])[0]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if len(self.known) > CACHE:
            self.known = Known(self.piece, self.known)
        out = [b"".join(map(self.known.__getitem__, _pieces(t))) for t in texts]
        for i, x in zip(whole, self._library([texts[i] for i in whole]), strict=True):
            out[i] = x
        return out


def _encoder(path: str, kind: str) -> Encoder:
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]


def write_shards(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode every whole text, append the end id and write shards in ascending id order.

    Ids (an integer column) may repeat or be null (these come last); a null text is empty.  A shard is closed once
    it has ``shard_ids`` ids, so it exceeds that by less than one document.
    """
    spark = docs.sparkSession
    ship(spark)
    width = 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else 4
    kind = WIDTHS[width]
    end = np.array([end_id], kind).tobytes()

    def run(batches):
        keys, ids, size = [], [], 0
        for pdf in batches:
            known = pdf["id"].notna()
            for low in range(0, len(pdf), 1000):
                part = pdf.iloc[low : low + 1000]
                encoded = _encoder(tokenizer_path, kind).encode(list(part["text"]))
                for key, has, x in zip(part["id"], known.iloc[low : low + 1000], encoded, strict=True):
                    keys.append(int(key) if has else None)
                    ids.append(x + end)
                    size += len(x) // width + 1
                    if size >= shard_ids:
                        yield pd.DataFrame({"value": [pack(keys, ids, width)]})
                        keys, ids, size = [], [], 0
        if keys:
            yield pd.DataFrame({"value": [pack(keys, ids, width)]})

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    shards = dealt.select(F.col("id").cast("decimal(20,0)").cast("string").alias("id"), "text")
    shards = shards.mapInPandas(run, "value binary")
    shards.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, content).  Names are part-<range>-<job>-c<file>.<ending>; shards sort as their documents do.

    The name of a job may hold ``-c`` and digits too, so the number is looked for at the end.
    """
    shard = F.concat_ws(
        "-",
        F.lpad(F.regexp_extract("path", r"part-(\d+)-", 1), 10, "0"),
        F.lpad(F.regexp_extract("path", r"-c(\d+)(?:\.[^/-]*)?$", 1), 10, "0"),
    )
    files = spark.read.format("binaryFile").load(folder).filter("length > 0")
    return files.select(shard.alias("shard"), "content")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids before the document in all shards, ``ids_crc32`` is taken over the ids
    as 32-bit numbers.  Every document with a key is fetched through its shard's index; a key that
    the index does not lead to is an error.
    """
    ship(spark)

    def run(batches):
        for pdf in batches:
            for name, content in zip(pdf["shard"], pdf["content"], strict=True):
                shard = Shard(content)
                n = len(shard.keys)
                first = np.where(shard.present, shard.places(shard.keys), 0)
                if (first < 0).any():
                    raise ValueError(f"shard {name}: the index misses a key")
                # Equal keys follow the one that the index names; documents without a key are read in turn.
                here = np.arange(n)
                same = np.append(False, (shard.keys[1:] == shard.keys[:-1]) & shard.present[1:] & shard.present[:-1])
                rank = here - np.maximum.accumulate(np.where(same, 0, here))
                place = np.where(shard.present, first + rank, here)
                crc = [zlib.crc32(shard.document(i).astype("<u4").tobytes()) for i in place]
                yield pd.DataFrame(
                    {
                        "shard": name,
                        "id": pd.Series(shard.keys.astype("i8")).astype("Int64").mask(~shard.present),
                        "local": shard.offsets.astype("i8")[place],
                        "n_tokens": np.diff(shard.offsets.astype("i8"))[place],
                        "ids_crc32": np.array(crc, "i8"),
                    }
                )

    schema = "shard string, id long, local long, n_tokens long, ids_crc32 long"
    docs = cut(_files(spark, folder).mapInPandas(run, schema))
    # Ids before a shard: those of earlier ranges (one row per range) and of earlier files of its own.
    of = F.substring("shard", 1, 10).alias("range")
    sizes = docs.groupBy(of, "shard").agg(F.sum("n_tokens").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w), F.lit(0))
    ranges = sizes.groupBy("range").agg(F.sum("n").alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    ranges = ranges.select("range", before(Window.orderBy("range").rowsBetween(*earlier)).alias("base"))
    within = Window.partitionBy("range").orderBy("shard").rowsBetween(*earlier)
    bases = sizes.select("range", "shard", before(within).alias("own")).join(ranges, "range")
    bases = maybe_broadcast(cut(bases.select("shard", (F.col("base") + F.col("own")).alias("base"))))
    return docs.join(bases, "shard").select(
        "id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(spark: SparkSession, folder: str, keys: list[int]) -> DataFrame:
    """(id, ids) of the documents with these keys, first of equal keys; the list goes to every task."""
    ship(spark)
    wanted = np.array(sorted(set(keys)), "i8")

    def run(batches):
        for pdf in batches:
            for content in pdf["content"]:
                shard = Shard(content)
                place = shard.places(wanted)
                have = place >= 0
                ids = [shard.document(i).astype("<u4").tobytes() for i in place[have]]
                yield pd.DataFrame({"id": wanted[have], "ids": ids})

    return _files(spark, folder).mapInPandas(run, "id long, ids binary")


def stored_digests(docs: DataFrame, folder: str, tokenizer_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the shards of all documents below ``folder`` and read every document back."""
    write_shards(docs, folder, tokenizer_path, id, text)
    return read_shards(docs.sparkSession, folder).withColumnRenamed("id", id)
