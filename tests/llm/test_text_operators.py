"""BPE, SimHash, line rules, personal data, licences and grades against plain Python."""

import collections
import hashlib
import re
import textwrap

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadastre.llm import bpe, grades, licences, line_rules, pii, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, n_chars long, judged string, size int"
TEXTS = [
    None, "", " \n\t", "one", "One two", "a b c", "A  b\nc", "x y z x y z x y z", "line one\nline one\n\nend",
    "it's don't 'll  we've\n\n  tabs\t\tand more   spaces", "数据 данные ümlaut 😀 123 4567.89",
    "word " * 3000, " " * 2000, "a" * 3000, "<|endoftext|> b " * 40,
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names clash."""
    rows = [(i, t, None if i % 4 == 0 else f"s{i % 2}", None, "x", i) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (5, "other text", "s1", 3, None, None), (None, "no id", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


BPE = {"ranks_path": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


@pytest.mark.parametrize("chunk,overlap", [(32768, 512), (100, 30), (64, 2)])
def test_chunks_encode_as_the_whole(odd, docs, chunk, overlap):
    frame = odd.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    got = bpe.encode(frame, chunk=chunk, overlap=overlap, decoded=True, **BPE).collect()
    one = bpe.encoding(*BPE.values())
    want = collections.Counter()
    for r in frame.collect():
        ids = np.array(one.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        want[r["doc_id"], ids, (r["text"] or "").encode()] += 1
    assert collections.Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in got) == want


def test_decode(odd):
    got = bpe.decode(bpe.encode(odd, **BPE), *BPE.values()).collect()
    assert sorted(bytes(r["decoded"]) for r in got) == sorted((r["text"] or "").encode() for r in odd.collect())
    assert bpe.digests(odd.limit(0), *BPE.values()).count() == 0


def classes_of(fps, limit):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= limit
    for a, b in zip(*np.nonzero(near), strict=True):
        parent[find(a)] = find(b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("limit", [0, 2, 8])
def test_gray_index_finds_every_pair(limit):
    rng = np.random.default_rng(limit)
    base = rng.integers(0, 2**63, 20, dtype="u8")
    flips = np.uint64(1) << rng.integers(0, 64, (20, 40, 3), dtype="u8")
    fps = np.unique(np.concatenate([base, np.bitwise_xor.reduce(flips, axis=2).ravel() ^ np.repeat(base, 40)]))
    index = simhash.GrayIndex(fps)
    q, member = index.near(fps, limit)
    got = {(int(fps[a]), int(index.fps[b])) for a, b in zip(q, member, strict=True)}
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= limit)
    assert got == {(int(fps[x]), int(fps[y])) for x, y in zip(a, b, strict=True)}


@pytest.mark.parametrize("max_bucket", [2, 4096])
def test_near_duplicates(odd, docs, max_bucket):
    frame = odd.select("doc_id", "text").unionByName(docs.select("doc_id", "text").limit(120))
    got = simhash.near_duplicates(frame, max_bucket=max_bucket).collect()
    rows = frame.collect()
    fps = np.array([simhash.fingerprint(r["text"]) for r in rows], "u8")
    first = {}
    for k, r in zip(classes_of(fps, 2), rows, strict=True):
        if r["doc_id"] is not None:
            first[k] = min(first.get(k, r["doc_id"]), r["doc_id"])
    want = [(r["doc_id"], f"{int(f):016x}", first.get(k)) for r, f, k in zip(rows, fps, classes_of(fps, 2), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


def test_one_of_each_class_stays(spark):
    rows = [(4, "same text here now"), (2, "Same text here now"), (2, "Same text here now"), (None, "same text here now"),
            (7, "something else is this"), (None, None), (9, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    kept = simhash.one_per_class(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [
        (2, "Same text here now"), (7, "something else is this"), (9, "")]


@pytest.mark.parametrize("max_bucket", [3, 4096])
def test_one_per_class_by_brute_force(spark, max_bucket):
    """Chains whose ends are unlike, and groups of many edited copies."""
    rng = np.random.default_rng(3)
    texts = []
    for k in range(8):
        base = [f"w{x}" for x in rng.integers(0, 5000, 400)]
        for _ in range(60 if k else 200):
            edited = set(rng.integers(0, 400, 2).tolist())
            texts.append(" ".join(f"{w}x" if i in edited else w for i, w in enumerate(base)))
    fps = np.array([simhash.fingerprint(t) for t in texts], "u8")
    classes = classes_of(fps, 2)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    assert any(classes[a] == classes[b] and not near[a, b] for a in range(200) for b in range(200))
    first = {}
    for i, k in enumerate(classes):
        first.setdefault(k, i)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = simhash.one_per_class(frame, max_bucket=max_bucket)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())
    assert len(first) < len(texts) / 2


def test_line_rules(spark, odd, docs):
    frame = odd.select("doc_id", "text", "source").unionByName(docs.select("doc_id", "text", "source"))
    got = collections.Counter(tuple(r)[:6] for r in line_rules.quality_report(frame).collect())
    want = collections.Counter()
    for r in frame.collect():
        text = r["text"] or ""
        words = WORD.findall(text)
        windows = list(zip(words, words[1:], words[2:], strict=False))
        seen = collections.Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        signs = sum(c in line_rules.SYMBOLS for c in text)
        want[r["doc_id"], len(words), sum(map(len, words)), signs, len(lines) - len(set(lines)), len(covered)] += 1
    assert got == want
    assert line_rules.quality_report(frame.limit(0)).count() == 0


def test_frequent_lines_go_and_depleted_documents_are_rejected(spark):
    banner = "Accept our 12 cookies"
    word = lambda *x: "".join("abcdefghij"[d % 10] for n in x for d in (n // 10, n))
    body = [" ".join(word(i, k) for k in range(60)) for i in range(60)]
    rows = [(i, f"{banner}\n{b}", "host") for i, b in enumerate(body[:40])]
    long_banner = " ".join(["accept"] + [f"all{k}" for k in range(70)])
    rows += [(100 + i, f"{long_banner}\n{body[i + 40][:60]}", "host") for i in range(20)]
    rows += [(200 + i, f"{long_banner}\nown words {i}", "host") for i in range(20)]
    rows += [(300 + i, body[0], "host") for i in range(50)]  # copies count once
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in line_rules.passed(frame).collect()}
    assert set(kept) == {*range(40), *range(300, 350)}
    assert kept[3] == body[3] and kept[301] == body[0]


def test_frequent_lines_do_not_depend_on_the_size_of_the_host(spark):
    own = spark.range(2000).selectExpr("id AS doc_id", "concat_ws('\n', 'Shared line', concat_ws(' ', transform(sequence(1, 60), x -> concat('w', id, 'x', x)))) AS text", "'large' AS source")
    rows = own.withColumn("text", F.when(F.col("doc_id") >= 21, F.substring_index("text", "\n", -1)).otherwise(F.col("text")))
    small = rows.filter("doc_id < 20").withColumn("source", F.lit(None).cast("string"))
    got = line_rules.passed(rows.unionByName(small)).groupBy("source").agg(F.count_if(F.col("text").contains("Shared line")))
    assert {tuple(r) for r in got.collect()} == {("large", 0), (None, 20)}


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PLAIN = [
    "a@b.c,d@e-f.g.h@i.j x@y @z.q a@@b.c a.b@c..d", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 1.2.3 256.0.0.1",
    "4539148803436467 4539 1488 0343 6467 4539-1488-0343-6468 1 2 3", "+1 (555) 123-4567. +123 +1-2-3-4-5-6-7-8 ++49 30 1234567",
    "＋ nothing", "me@x.org 10.0.0.1 +44 20 7946 0958 " * 50,
]


@pytest.mark.parametrize("text", PLAIN)
def test_plain_personal_data(text):
    def right(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    for kind, pattern in BASE.items():
        want = [m.span() for m in re.finditer(pattern, text) if right(kind, m[0])]
        assert [(a, b) for k, a, b, plain in pii.spans(text) if k == kind and plain] == want


DISGUISED = {
    "mail john (at) example (dot) com now": ("email", "john (at) example (dot) com"),
    "write bob at example dot co dot uk please": ("email", "bob at example dot co dot uk"),
    "jоhn@examplе.com is Cyrillic": ("email", "jоhn@examplе.com"),
    "host 192 dot 168 dot 1 dot 10 is up": ("ip", "192 dot 168 dot 1 dot 10"),
    "１９２.168.1.1": ("ip", "１９２.168.1.1"),
    "call plus four four two zero seven nine four six zero nine five eight":
        ("phone", "plus four four two zero seven nine four six zero nine five eight"),
    "joe_at_mail_dot_org": ("email", "joe_at_mail_dot_org"),
}


@pytest.mark.parametrize("text", DISGUISED)
def test_disguises_map_back_to_the_source(text):
    kind, part = DISGUISED[text]
    at = text.index(part)
    assert pii.spans(text) == [(kind, at, at + len(part), False)]
    assert pii.masked(text) == text.replace(part, f"[{kind.upper()}]")


ALONE = {
    "john@example[.]com": "email", "john (@) example.com": "email", "user@example·com": "email", "192.168[.]1[.]1": "ip",
    "+1 415 five five five 0199": "phone", "+4 4 two 0 seven 9 four 6 zero 9 five": "phone",
}


@pytest.mark.parametrize("text", ALONE)
def test_disguises_count_without_others(text):
    assert pii.spans(text) == [(ALONE[text], 0, len(text), False)]
    assert pii.spans(text + "\n— “”") == pii.spans(text)


@pytest.mark.parametrize("text", ["look at the dot on the map", "one two three four things", "Данные и код.", "state-of-the-art"])
def test_clean_texts_have_none(text):
    assert pii.spans(text) == [] and pii.masked(text) == text


def test_spans_are_met_as_by_a_look_at_each():
    rng = np.random.default_rng(1)
    base = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 900, 60), rng.integers(1, 30, 60), strict=True)]
    held, plain = pii._Spans(base), list(base)
    for a, n in zip(rng.integers(0, 950, 900).tolist(), rng.integers(1, 20, 900).tolist(), strict=True):
        met = any(x < a + n and a < y for x, y in plain)
        assert held.meet(a, a + n) == met
        if not met:
            held.add(a, a + n)
            plain.append((a, a + n))


def test_clashing_names(spark):
    frame = spark.createDataFrame([(1, "mail a@b.com", "s")], "doc_id long, text string, source string")
    frame = frame.withColumns({c: F.lit("clash") for c in ("pii", "masked", "_of_host", "of_host", "judged", "frequent")})
    assert pii.detect(frame).columns == [*frame.columns, "_pii"]
    assert pii.redact(frame).first()["text"] == "mail [EMAIL]"
    assert line_rules.passed(frame).columns == frame.columns and line_rules.quality_report(frame).count() == 1


def test_personal_data_frames(spark, odd):
    frame = odd.withColumn("text", F.concat("text", F.lit(" me@x.org")))
    out = pii.redact(frame)
    assert out.columns == frame.columns
    for r in out.collect():
        assert r["text"] is None or r["text"].endswith(" [EMAIL]") and r["n_chars"] == len(r["text"])
    got = pii.report(frame)
    assert got.count() == frame.count() and got.agg(F.sum("n_email")).first()[0] == frame.filter("text is not null").count()
    empty = [r["base_sha256"] for r in pii.report(odd.filter("text is null")).collect()]
    assert empty == [hashlib.sha256(b"").hexdigest()]
    assert pii.report(odd.limit(0)).count() == 0 and pii.redact(odd.limit(0)).count() == 0


def test_licences(spark, docs, odd):
    model = licences.train(docs)
    more = [
        "Some words before\nReleased under the MIT License.\nand after", "All rights reserved by someone",
        "Licensed under the Apache License, Version 2.0.", "Nothing of the kind", None, "",
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(more)], "licences int, text string")
    got = {r["licences"]: [(x["paragraph"], x["family"], x["confirmed"]) for x in r["_licences"]] for r in licences.scan(frame, model).collect()}
    assert got == {0: [(1, "mit", True)], 1: [(0, "unknown", False)], 2: [(0, "apache", True)], 3: [], 4: [], 5: []}
    licences.scan(odd.limit(0), licences.train(odd.limit(0))).collect()


def test_licences_without_keywords_and_wrapped(docs):
    model = licences.train(docs)
    texts = {"gpl": "Distributed under the GNU GPL v3", "cc": "Available under CC BY 4.0", "apache": "Released under Apache 2.0",
             "mpl": "This file is under the terms of the MPL 2.0"}
    for family, text in texts.items():
        assert [(x["paragraph"], x["family"]) for x in licences.judge(f"Some words.\n\n{text}", model)] == [(2, family)]
    for family in ("bsd", "mit"):
        notice = max(licences.TEMPLATES[family], key=len)
        text = "A title\n\n" + textwrap.fill(notice, 75) + "\n\nOther words."
        found = [(x["paragraph"], x["family"], x["confirmed"]) for x in licences.judge(text, model)]
        assert found == [(2, family, True)]
    plain = licences.judge("The river is long and cold.\nWe walked to the market under the bridge.", model)
    assert plain == []


def test_licence_sample_is_of_different_paragraphs(spark, monkeypatch):
    monkeypatch.setattr(licences, "MAX_OTHER", 40)
    frame = spark.range(3000).selectExpr("if(id < 2900, 'the same line', concat('line ', repeat('a', int(id - 2900)))) AS text")
    seen = {}
    monkeypatch.setattr(licences, "fit", lambda keys, classes, held, buckets: seen.update(n=int((classes == licences.OTHER).sum())))
    licences.train(frame)
    assert seen["n"] == 40 + len(licences.OPENINGS) * len(licences.ELSE) + len(licences.PLAIN)


def test_licence_unknown_class(docs):
    """Licences of no family are told by the model, and words of licensing alone declare nothing."""
    model = licences.train(docs)
    declared = ["Terms: EPL-2.0", "All rights reserved by the band", "Provided under the Zope Public License 2.1"]
    for text in declared:
        assert [x["family"] for x in licences.judge(f"A title\n\n{text}", model)] == ["unknown"], text
    plain = ["His driving licence had expired.", "She has poetic license.", "The band plays in the public domain of taste",
             "The shop has a license for tobacco", "Mit.", "-- * --"]
    for text in plain:
        assert licences.judge(text, model) == [], text


def test_licence_scores_against_plain_version(docs, monkeypatch):
    """Scores of many texts at once are those of each paragraph on its own, however the bytes are sliced."""
    rng = np.random.default_rng(5)
    weights = rng.normal(size=(512, licences.OTHER + 1))
    texts = TEXTS + ["a\n\n(b) 12.34 --\n***\n x-1\n", "\n", "7" * 300 + ". x", "é'é \r\n\tÜ"] + [r["text"] for r in docs.limit(60).collect()]

    def value(word):
        total = sum(int(licences._VALUE[b]) * pow(int(licences._MIX), i, 1 << 64) for i, b in enumerate(word))
        return int(licences._mixed(np.array([total % (1 << 64)], "u8"))[0])

    def keys(tokens):
        found, hashes = set(), [value(w) for w in tokens]
        for i in range(len(hashes)):
            run = 0
            for h in hashes[i : i + licences.GRAMS]:
                run = int(licences._mixed(np.array([run ^ h], "u8"))[0])
                found.add(run % 512)
        return sorted(found)

    plain = []
    for row, text in enumerate(texts):
        for number, line in enumerate((text or "").encode().split(b"\n")):
            if tokens := licences.words(line):
                plain.append((row, number, keys(tokens)))
    for slice_ in (1 << 20, 700):
        monkeypatch.setattr(licences, "SLICE", slice_)
        if slice_ == 700:  # words that are longer are cut, so they are left out
            texts = [None if i in {r for r, t in enumerate(texts) if max(map(len, (t or "").split() or [""])) > 250} else t for i, t in enumerate(texts)]
            plain = [x for x in plain if texts[x[0]] is not None]
        lines = licences.Paragraphs(pa.array(texts, pa.large_string()))
        sums, counts = lines.sums(lines.line, len(lines.text), weights)
        assert list(zip(lines.text.tolist(), lines.number.tolist())) == [x[:2] for x in plain]
        assert counts.tolist() == [len(x[2]) for x in plain]
        assert np.allclose(sums, [weights[x[2]].sum(axis=0) for x in plain])
        for i, (_, _, k) in enumerate(plain):
            assert licences.grams(lines.body(i, i), 512).tolist() == k


@pytest.fixture(scope="module")
def held_out(docs):
    """Per family: (right, given, asked) on notices in wordings that were not trained on."""
    model = licences.train(docs)
    wordings = ("The sources are published under {}", "You may copy this under {}", "It is free software under {}", "{} applies to all files")
    right, given, asked = collections.Counter(), collections.Counter(), collections.Counter()
    for family in licences.FAMILIES:
        for name in licences.NAMES[family]:
            for wording in wordings:
                asked[family] += 1
                for found in licences.judge(wording.format(name), model):
                    given[found["family"]] += 1
                    right[family] += found["family"] == family
    print({f: (right[f], given[f], asked[f]) for f in asked})
    return {f: (right[f], given[f], asked[f]) for f in asked}


def test_licence_precision_held_out(held_out):
    assert all(right >= 0.95 * given for right, given, _ in held_out.values()), held_out


@pytest.mark.xfail(reason="recall of families in other wordings falls short of 0.7; README, Open", strict=False)
def test_licence_recall_held_out(held_out):
    assert all(right >= 0.7 * asked for right, _, asked in held_out.values()), held_out


def test_grades_on_held_out_rows(spark):
    """Grades follow telling words; thresholds are in order; held-out rows are ranked."""
    rng = np.random.default_rng(1)
    telling = [["bad", "awful"], ["plain"], ["lucid", "sound"]]
    rows = []
    for i in range(900):
        g = i % 3
        words = [f"w{x}" for x in rng.integers(0, 300, 30)] + list(rng.choice(telling[g], 3))
        rows.append((i, " ".join(words), g))
    frame = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = grades.train(frame, frame.filter("doc_id % 4 <> 3").select("doc_id", "grade"))
    assert model.thresholds[0] < model.thresholds[1]
    got = grades.graded(frame.drop("grade"), model).join(frame.select("doc_id", "grade"), "doc_id")
    got = got.filter("doc_id % 4 = 3").toPandas()
    assert (got["expected_grade"].round() == got["grade"]).mean() > 0.9
    assert (got["kept"] == (got["grade"] == 2)).mean() > 0.9


def test_grades_of_odd_rows(odd, spark):
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = grades.train(odd, none)
    assert grades.graded(odd, model).count() == odd.count()
    assert grades.graded(odd.limit(0), model).count() == 0
