"""Byte-level BPE encoding by overlapping chunks, and decoding.

A long text is cut into chunks that overlap.  The chunks are pre-tokenised in parallel; where the
pre-tokens of two neighbours begin at the same place in the overlap they have resynchronised,
since a match depends only on where it begins and on what follows.  The texts between these places
are encoded, again in parallel, and their ids put together.  Short texts are one piece.
"""

from __future__ import annotations

import base64
import unicodedata

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastre.llm.common import in_parts, map_frames, ship

CHUNK, OVERLAP = 32_768, 512
ID_TYPE = "<u4"

_encodings: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """Built once a worker."""
    if (ranks_path, pattern) not in _encodings:
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[ranks_path, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[ranks_path, pattern]


def _stable(c: str) -> bool:
    """Printable, and in Unicode for so long that all engines class it alike."""
    return c < "\x7f" and c.isprintable() or c == "\n" or (
        c.isprintable() and unicodedata.ucd_3_2_0.category(c) != "Cn"
    )


def starts(text: str, pattern: regex.Pattern, low: int, high: int) -> list[int]:
    """Where pre-tokens begin, from ``low`` to ``high`` and between two characters of stable class."""
    found = (m.start() for m in pattern.finditer(text))
    return [
        p for p in found if low <= p < high and (p == 0 or _stable(text[p - 1]) and _stable(text[p]))
    ]


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    decoded: bool = False,
) -> DataFrame:
    """(id, ids[, decoded]) per row: the token ids of the whole text as little-endian 32-bit numbers.

    As tiktoken's ``encode_ordinary``: no special tokens.  A null text is empty and gives no ids.
    Repeated rows are kept.  Where two chunks never resynchronise (one word or one run of white
    space longer than the overlap) the rest of that text is one piece.  ``decoded``
    adds the bytes that the ids stand for, piece by piece as they are made.
    """
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    ship(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    made = ["ids", "decoded"] if decoded else ["ids"]
    binary = ", ".join(f"{c} binary" for c in made)

    def with_ids(pdf):
        one = encoding(ranks_path, pattern)
        ids = [one.encode_ordinary(t or "") for t in pdf["text"]]
        out = pdf.drop(columns="text").assign(ids=[np.array(x, ID_TYPE).tobytes() for x in ids])
        return out.assign(decoded=list(map(one.decode_bytes, ids))) if decoded else out

    def cut_up(batches):
        for pdf in in_parts(batches, 64):
            for row, key, t in zip(pdf["row"], pdf["id"], pdf["text"], strict=True):
                low = range(0, len(t), chunk)
                parts = [t[i : i + chunk + overlap] for i in low]
                yield pd.DataFrame({"row": row, "id": key, "chunk": range(len(parts)), "part": parts})

    def pre_tokenise(batches):
        match = regex.compile(pattern)
        for pdf in in_parts(batches, 64):
            head = [starts(t, match, 0, overlap) for t in pdf["part"]]
            tail = [[p - chunk for p in starts(t, match, chunk, chunk + overlap)] for t in pdf["part"]]
            yield pdf.assign(head=head, tail=tail)

    def put_together(batches):
        for pdf in in_parts(batches, 64):
            joined = {c: [b"".join(p[c] for p in parts) for parts in pdf["parts"]] for c in made}
            yield pdf[["id"]].assign(**joined)

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = map_frames(rows.filter(~is_long), with_ids, f"id {kind}, {binary}")

    # Rows are told apart by their place in the scan, since ids may repeat or be null.
    many = rows.filter(is_long).withColumn("row", F.monotonically_increasing_id())
    schema = f"row long, id {kind}, chunk int, part string"
    chunks = many.mapInPandas(cut_up, schema).repartition("row", "chunk")
    chunks = chunks.mapInPandas(pre_tokenise, schema + ", head array<int>, tail array<int>")

    order = Window.partitionBy("row").orderBy("chunk")
    agreed = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    agreed = F.when(F.col("chunk") == 0, 0).otherwise(agreed)  # null: not resynchronised
    lost = F.min(F.when(F.col("sync").isNull(), F.col("chunk")))
    placed = (
        chunks.withColumn("sync", agreed)
        .withColumn("lost", lost.over(Window.partitionBy("row")))
        .withColumn("next", F.lead("sync").over(order))
        .withColumn("is_last", F.lead("chunk").over(order).isNull())
    )
    rest = F.coalesce(F.col("chunk") >= F.col("lost") - 1, F.lit(False))  # of a text from the lost place on
    begin = F.when(rest & (F.col("chunk") >= F.col("lost")), 0).otherwise(F.col("sync"))
    end = F.when(F.col("is_last"), F.length("part")).when(rest, chunk).otherwise(F.col("next") + chunk)
    spans = placed.select(
        "row",
        "id",
        F.when(rest, F.col("lost") - 1).otherwise(F.col("chunk")).alias("span"),
        F.struct("chunk", F.col("part").substr(begin + 1, end - begin).alias("text")).alias("piece"),
    )
    spans = spans.groupBy("row", "id", "span").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    spans = spans.select("row", "id", "span", F.array_join("pieces.text", "").alias("text"))
    spans = map_frames(spans.repartition("row", "span"), with_ids, f"row long, id {kind}, span int, {binary}", 64)
    whole = spans.groupBy("row", "id").agg(
        F.array_sort(F.collect_list(F.struct("span", *made))).alias("parts")
    )
    whole = whole.select("id", "parts").mapInPandas(put_together, f"id {kind}, {binary}")
    return short.unionByName(whole).withColumnRenamed("id", id)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the raw bytes of the ids, put together; ids are not changed and null gives null."""
    ship(tokens.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema) + f", `{name}` binary"

    def run(batches):
        of = encoding(ranks_path, pattern).decode_bytes
        for pdf in in_parts(batches):
            made = [None if x is None else of(np.frombuffer(x, ID_TYPE).tolist()) for x in pdf[ids]]
            yield pdf.assign(**{name: made})

    return tokens.mapInPandas(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of ids and the SHA-256 of the ids and of the decoded bytes."""
    return encode(docs, ranks_path, pattern, id, text, decoded=True).select(
        id,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
