"""Importance resampling towards a target text: hashed word runs, log ratios, Gumbel noise, highest scores.

A 256-byte table lower-cases A-Z and blanks separators in UTF-8; ``bytes.split`` gives the words.  The
CRC-32 of a run of words is that of the run without its last word, continued over a space and that word.
Counters per task hold at most one entry per bucket.  Texts are read twice, once to count all features
and once to weigh each text; nothing per feature is kept.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm.common import fresh, in_parts, map_frames, numbered, ship
from cadastre.sources.scratch import cut

BUCKETS = 10_000
ORDER = 3
SEED = 42
PERCENT = 5
LEAST_WORDS = 20
BLOCK = 1 << 20
# Digits, letters and everything beyond ASCII belong to words; the rest is blank.
TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def word_blocks(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, about ``BLOCK`` bytes of them at a time."""
    data = text.encode().translate(TABLE) if text else b""
    low = 0
    while low < len(data):
        high = data.find(b" ", low + BLOCK)
        high = len(data) if high < 0 else high
        words = data[low:high].split()
        if words:
            yield words
        low = high


def feature_buckets(text: str | None, buckets: int = BUCKETS, order: int = ORDER) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of all runs of 1 to ``order`` words that end in it) per block of a text."""
    before: list[bytes] = []
    for words in word_blocks(text):
        n, words = len(words), before + words
        held = len(before)
        chain = list(map(crc32, words))
        found = chain[held:]
        spaced = [b" " + w for w in words]
        for k in range(1, order):
            chain = list(map(crc32, spaced[k:], chain))
            found += chain[max(0, held - k) :]
        yield n, np.array(found, "u4") % buckets
        before = words[-(order - 1) :] if order > 1 else []


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """How often each bucket occurs in all texts; one number per bucket reaches the driver."""
    ship(texts.sparkSession)

    def run(batches):
        counts = Counter()
        for pdf in in_parts(batches):
            for t in pdf["text"]:
                for _, found in feature_buckets(t, buckets, order):
                    counts.update(found.tolist())
        yield pd.DataFrame({"bucket": list(counts.keys()), "n": list(counts.values())}, dtype="int64")

    out = np.zeros(buckets, "i8")
    rows = texts.select(F.col(text).alias("text")).mapInPandas(run, "bucket long, n long")
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) per bucket, for B buckets."""
    size, whole, aim = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (whole + size) / ((s + 1) * (aim + size))))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        "i8",
    )


def noise(id, seed: int = SEED) -> int:
    """Gumbel noise of an id in thousandths, the same on every run; a null id counts as empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(
    docs: DataFrame, gain: np.ndarray, id: str = "doc_id", text: str = "text", order: int = ORDER, seed: int = SEED
) -> DataFrame:
    """(id, n_words, n_features, weight, score) per row."""
    ship(docs.sparkSession)

    def figures(id, text):
        n_words = n_features = weight = 0
        for n, found in feature_buckets(text, len(gain), order):
            n_words, n_features = n_words + n, n_features + len(found)
            weight += int(gain[found].sum())
        return n_words, n_features, weight, weight + noise(id, seed)

    def run(pdf):
        made = [figures(i, t) for i, t in zip(pdf["id"], pdf["text"], strict=True)]
        return pd.DataFrame(made, columns=["n_words", "n_features", "weight", "score"]).assign(id=pdf["id"].to_list())

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return map_frames(rows, run, f"n_words long, n_features long, weight long, score long, id {kind}")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    order: int = ORDER,
    seed: int = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) per row of ``docs``.

    Of the N texts with ``least_words`` words or more, the floor(percent N / 100) of the highest scores are
    drawn and ranked from 1, ties to the smaller id; rank is null for the others.  Adding Gumbel noise to
    the log weights and taking the highest is drawing without replacement by weight.  A null text has no
    features; null ids come last among ties; repeated rows are drawn each for itself; empty tables on
    either side are allowed.  Other columns are not looked at.
    """
    gain = gains(bucket_counts(docs, text, buckets, order), bucket_counts(target, text, buckets, order))
    weighed = cut(weigh(docs, gain, id, text, order, seed))
    enough = F.col("n_words") >= least_words
    drawn = percent * weighed.filter(enough).count() // 100
    tie = fresh(weighed, "_tie")
    best = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col(tie)]
    placed = numbered(weighed.filter(enough).withColumn(tie, F.monotonically_increasing_id()), best, "rank").drop(tie)
    placed = placed.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    others = weighed.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id), "n_features", "weight", "score", "rank"]
    return placed.unionByName(others).select(*columns)


def drawn(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents drawn, all columns kept.  Ids must tell documents apart."""
    chosen = resample(docs, target, id, text, **options).filter("rank is not null")
    return docs.join(chosen.select(id).distinct(), id, "left_semi")
