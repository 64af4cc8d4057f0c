"""Packing, importance resampling and collocations against plain versions."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadastre.llm import importance, packing, phrases, queries

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a<|endoftext|>b  c", None, "", " \t\n", "é ́x   y z ΑΣ Σ don't 12 a1b2 'S", "\x1c a\x85b", "İ x", "b", "A.", "Ç,",
    "H̱ A. É, Ab., x×. ÷, ...a. a.b a. ", "x́. .", "　word　,", "aB́ AB́", "it's, ab's. <|",
]


def odd_documents(spark, sf_dir):
    """The documents with odd rows: nulls, empty, repeated, very long, one very common word."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    odd = [(1000 + i, "en", t) for i, t in enumerate(ODD)]
    odd += [(None, None, "no id. " * 30), (1100, "en", "the cat sat. " * 4000), (1100, "en", "the cat sat. " * 4000)]
    odd += [(1101, "xx", "one two " * 9000), (1102, None, "w" * 30000 + " tail of it")]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns(
        {c: F.lit("clash") for c in ("id", "piece", "offset", "n", "rank", "_key", "key", "f", "phrase", "score")}
    )


def test_chunk_encoder_agrees_with_the_library(monkeypatch):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    texts = [*ODD, *("".join(map(chr, np.random.default_rng(k).choice([*range(9, 14), *range(32, 127), 0xC9, 0xD7, 0x301, 0x85, 0x3A3], 300))) for k in range(40))]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for limit in (packing.CACHE_IDS, 10):
        monkeypatch.setattr(packing, "CACHE_IDS", limit)
        encoder = packing.ChunkEncoder(WORD_BPE)
        for part in (slice(0, 9), slice(9, None), slice(0, None)):
            ids, count = encoder.encode(pa.array(texts[part]))
            assert np.split(ids, np.cumsum(count)[:-1])[0].tolist() == want[part][0]
            assert ids.tolist() == [i for x in want[part] for i in x] and count.tolist() == [len(x) for x in want[part]]
    assert packing.ChunkEncoder(WORD_BPE).encode(pa.array([], pa.string()))[1].tolist() == []


def test_pieces_and_packing(spark, sf_dir):
    frame = odd_documents(spark, sf_dir)
    packed = packing.pack(packing.pieces(frame, WORD_BPE)).persist()
    tokenizer, want = Tokenizer.from_file(WORD_BPE), collections.Counter()
    for r in frame.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for k, low in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[low : low + 2048], "<u4")
            want[r["doc_id"], k, low, len(part), part.tobytes()] += 1
    rows = packed.collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows) == want
    per = collections.defaultdict(list)
    for r in rows:
        per[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["ids"])))
    for parts in per.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(per) <= 1.005 * -(-total // 2048) + 1
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    assert whole == {k: b"".join(x for *_, x in sorted(v)) for k, v in per.items()}
    assert packing.pack(packing.pieces(frame.limit(0), WORD_BPE)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 2049)], "id long, length long"))


@pytest.mark.parametrize("kind", ["even", "long", "short", "mixed", "one", "none", "few"])
def test_plan_uses_every_length_once(kind):
    rng, capacity = np.random.default_rng(1), 200
    lengths = {
        "even": rng.integers(1, 201, 3000), "long": rng.integers(101, 201, 500), "short": rng.integers(1, 9, 5000),
        "mixed": np.r_[rng.integers(90, 120, 900), rng.integers(1, 60, 900)], "one": np.full(1000, 67),
        "none": np.zeros(0, "i8"), "few": np.array([200, 199, 1, 100, 100]),
    }[kind]
    counts = np.bincount(lengths, minlength=capacity + 1)
    chosen = packing.plan(counts)
    used = np.zeros(capacity + 1, "i8")
    for copies, row in chosen:
        assert copies > 0 and sum(row) <= capacity
        for n in row:
            used[n] += copies
    assert (used == counts).all()
    # No more than best-fit decreasing needs, text by text.
    room, bins = [], 0
    for n in sorted(lengths.tolist(), reverse=True):
        fits = [i for i, x in enumerate(room) if x >= n]
        if fits:
            best = min(fits, key=room.__getitem__)
            room[best] -= n
        else:
            room.append(capacity - n)
            bins += 1
    assert sum(c for c, _ in chosen) <= bins


def test_fit_reaches_an_exact_histogram():
    counts = np.zeros(101, "i8")
    counts[[20, 30, 50, 60, 40]] = [40, 40, 40, 70, 70]
    rows = packing.patterns(counts)
    assert sorted(map(tuple, rows.tolist())) == sorted(
        t for t in {tuple(sorted((a, b, 100 - a - b), reverse=True)) for a in (0, 20, 30, 40, 50, 60) for b in (0, 20, 30, 40, 50, 60)}
        if set(t) <= {0, 20, 30, 40, 50, 60})
    x = packing.fit(rows, counts, 2000)
    used = np.zeros(101)
    for row, n in zip(rows, x, strict=True):
        for length in row[row > 0]:
            used[length] += n
    assert (x >= 0).all() and np.abs(used - counts).max() < 0.5


def plain_features(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(x.encode()) % 10_000 for x in runs]


def plain_resample(docs, target):
    made = [(i, *plain_features(t)) for i, t in docs]
    s, t = collections.Counter(), collections.Counter()
    for _, _, found in made:
        s.update(found)
    for x in target:
        t.update(plain_features(x)[1])
    whole, aim = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (whole + 10_000) / ((s[b] + 1) * (aim + 10_000)))) for b in range(10_000)]
    rows = []
    for i, n, found in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((-r[4], r[0] is None, r[0], k) for k, r in enumerate(rows) if r[1] >= 20)
    rank = {x[3]: n for n, x in enumerate(enough[: 5 * len(enough) // 100], 1)}
    return [(r[0], *r[2:], rank.get(k)) for k, r in enumerate(rows)]


@pytest.mark.parametrize("block", [importance.BLOCK, 40])
def test_importance(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK", block)
    texts = ["a b c d e f g", "One TWO one two é-é 3four five", "x" * 100 + " y " * 60, "", None]
    for t in texts:
        n, found = plain_features(t)
        made = list(importance.feature_buckets(t))
        assert sum(x for x, _ in made) == n
        assert sorted(b for _, x in made for b in x.tolist()) == sorted(found)
    if block == 40:
        return
    frame = odd_documents(spark, sf_dir)
    aim = spark.read.parquet(f"{sf_dir}/benchmark.parquet").unionByName(
        spark.createDataFrame([(-1, None), (-2, "")], "item_id long, text string")
    )
    got = importance.resample(frame, aim).collect()
    docs = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    want = plain_resample(docs, [r["text"] for r in aim.collect()])
    # Two equal rows may swap ranks: they are told apart by nothing.
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert any(r["rank"] for r in got)
    assert importance.resample(frame.limit(0), aim).count() == 0
    assert importance.resample(frame, aim.limit(0)).count() == frame.count()
    kept = importance.drawn(frame.filter("doc_id is not null"), aim)
    assert kept.columns == frame.columns and kept.count() > 0


def plain_collocations(rows, least=10, top=2000, cover=50, longest=3):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, mine in f.items():
        many = {p: a for p, a in mine.items() if len(p) > 1 and a >= least}
        covered = collections.Counter()
        for p, a in many.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covered[p[i : i + k]] = max(covered[p[i : i + k]], a)
        scored = []
        for p, a in many.items():
            cuts = [(10**6 * a * a // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if not (p in covered and 100 * covered[p] >= cover * a):
                scored.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


@pytest.mark.parametrize("options", [{}, {"route": 500, "least": 4, "top": 50}, {"max_words": 2}, {"max_words": 4, "route": 5000}])
def test_collocations(spark, sf_dir, options):
    frame = odd_documents(spark, sf_dir)
    got = phrases.collocations(frame, **options).collect()
    rows = [(r["lang"], r["text"]) for r in frame.select("lang", "text").collect()]
    plain = {"longest" if k == "max_words" else k: v for k, v in options.items() if k != "route"}
    assert sorted(map(tuple, got)) == sorted(plain_collocations(rows, **plain)) and got
    assert phrases.collocations(frame.limit(0)).count() == 0


@pytest.mark.parametrize("size", [64, 300, 1 << 22])
def test_blocks_lose_no_place(size):
    texts = ["a b c d e f g " * 40, "x. y z. " * 30, "long" * 99 + " w1 w2", "", None, "q" * 500 + "\n" + "r s " * 99, "one"]
    langs = ["en", "en", "fr", "fr", "fr", "de", "de"]
    batch = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts)], names=["lang", "text"])
    got, want = collections.Counter(), collections.Counter()
    for lang, data, tail in phrases.blocks([batch], 2, size):
        words, ids, piece = phrases._block_words(data)
        for i in range(len(ids) - tail):
            run = [words[ids[j]].decode() for j in range(i, min(i + 3, len(ids))) if piece[j] == piece[i]]
            got[lang, " ".join(run)] += 1
    for lang, text in zip(langs, texts, strict=True):
        for p in re.split(r"[.,;:!?\n]", text or ""):
            w = p.split()
            for i in range(len(w)):
                want[lang, " ".join(w[i : i + 3])] += 1
    assert got == want


def test_hashes_and_bitmap(spark):
    words = ["a", "é", "the", "x" * 100, "日本"]
    frame = spark.createDataFrame([("en", w) for w in words], "lang string, phrase string")
    h = {r[0]: r[1] for r in frame.select("phrase", phrases._hash_column()).collect()}
    mine = phrases._hash("en", [w.encode() for w in words])
    assert [h[w] % 2**64 for w in words] == mine.tolist() and mine[0] == xxhash.xxh64_intdigest(b"en a", 42)
    bits = 1 << 17
    held = phrases.bitmap(frame, bits)
    other = phrases._hash("en", [str(i).encode() for i in range(100)])
    assert phrases._marked(held, bits, mine).all() and phrases._marked(held, bits, other).sum() <= 1


def test_quicksort_counts():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 6, (2000, 3)), axis=0)[rng.permutation(2000)]
    keys[rng.random(2000) < 0.2, 2] = phrases.END
    weights = rng.integers(1, 4, 2000)
    want = collections.Counter()
    for row, w in zip(keys.tolist(), weights.tolist(), strict=True):
        want[tuple(row[:2])] += w
        if row[2] != phrases.END:
            want[tuple(row)] += w
    got = {tuple(keys[p, :size].tolist()): n for p, size, n in phrases.count_phrases(np.ascontiguousarray(keys.T), weights, 10, False)}
    assert got == {k: n for k, n in want.items() if n >= 10}


def test_new_queries_have_the_columns_of_their_contracts(spark, sf_dir):
    columns = {
        "op11_packing": "doc_id piece start length ids_crc32 sequence_id offset",
        "op12_importance": "doc_id n_features weight score rank",
        "op13_phrases": "lang rank phrase a l r n score",
    }
    for name, want in columns.items():
        assert queries.QUERIES[name](spark, sf_dir).columns == want.split()
