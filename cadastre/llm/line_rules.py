"""Quality rules with a cross-document line frequency, in DataFrame functions throughout.

Lines are normalised and hashed, the different texts of a host that hold a line are counted, lines
in more than ``max_texts`` of them are removed, and a document that loses over half of its words is
rejected.  The limit is the same in every host, so a verdict does not depend on the host's size.

Hashes of lines are joined with the frequent ones by (host, line) and gathered per text, so that a
text meets only those of its own lines that go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.llm.common import SPACE, fresh, maybe_broadcast, word_count
from cadastre.sources.scratch import cut, settle

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A line is removed if more than so many different texts of its host have it.
MAX_TEXTS = 20
MAX_REMOVED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(line: Column) -> Column:
    """A-Z lowered, digits as 0, runs of white space as one space, none at the ends."""
    line = F.translate(line, _UPPER + "123456789", _LOWER + "000000000")
    return F.trim(F.regexp_replace(line, SPACE, " "))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def with_repeats(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Add the number of words in 3-word windows that occur twice or more in the text.

    Windows are hashed, sorted by hash and compared with their neighbours; the words they cover
    are counted from the sorted places.  Every step is a column of its own that is used more than
    once, so that no step is computed again for each element of the next.
    """
    words, windows, places = (fresh(docs, f"{name}_{x}") for x in ("words", "windows", "places"))
    w, s, p = F.col(words), F.col(windows), F.col(places)
    n = F.size(w)
    third = F.slice(w, 3, F.greatest(n - 2, F.lit(0)))
    hashed = F.transform(
        F.arrays_zip(F.slice(w, 1, F.greatest(n - 2, F.lit(0))).alias("a"), F.slice(w, 2, F.greatest(n - 2, F.lit(0))).alias("b"), third.alias("c")),
        lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("p")),
    )
    same = lambda x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
    again = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
    out = docs.withColumn(words, _words(F.col(text)))
    out = out.withColumn(windows, F.sort_array(hashed)).drop(words)
    out = out.withColumn(places, F.sort_array(F.transform(again, lambda x: x["p"]))).drop(windows)
    covered = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3)))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn(name, total).drop(places)


def frequent_lines(docs: DataFrame, host: str = "source", text: str = "text", max_texts: int = MAX_TEXTS) -> DataFrame:
    """(host, of, lines): per text of a host, known by its hash ``of``, its lines above the limit, hashed.

    Texts without such lines have no row.  Equal texts of a host count once, so copies do not make
    their own lines frequent; a null host is a host; lines without a word do not count.
    """
    lines = F.transform(lines_of(F.col(text)), normalised)
    lines = F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(x))
    rows = docs.select(
        F.col(host).alias("host"), F.xxhash64(F.col(text)).alias("of"), F.explode(F.array_distinct(lines)).alias("line")
    )
    rows = settle(rows.distinct())
    often = rows.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > max_texts)
    often = maybe_broadcast(cut(often.select(F.col("host").alias("of_host"), F.col("line").alias("often"))))
    same = F.col("host").eqNullSafe(F.col("of_host")) & (F.col("line") == F.col("often"))
    return cut(rows.join(often, same).groupBy("host", "of").agg(F.collect_list("line").alias("lines")))


def judged(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    max_texts: int = MAX_TEXTS,
    max_removed_percent: int = MAX_REMOVED_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` with one column ``judged`` more (with underscores before it if taken).

    It holds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
    kept, and clean_text: the text without its frequent lines.  A null or empty text has no words
    and fails; its clean_text is itself.  Repeated rows are judged alike.
    """
    column, gone = fresh(docs, "judged"), fresh(docs, "frequent")
    repeats = fresh(docs, "repeats")
    t = F.col(text)
    body = F.coalesce(t, F.lit(""))
    found = frequent_lines(docs, host, text, max_texts)
    of_host, of = fresh(docs, "of_host"), fresh(docs, "of_text")
    found = maybe_broadcast(found.withColumnsRenamed({"host": of_host, "of": of, "lines": gone}))
    same = docs[host].eqNullSafe(found[of_host]) & (F.xxhash64(docs[text]) == found[of])
    rows = docs.join(found, same, "left").drop(of_host, of)
    rows = with_repeats(rows, text, repeats)
    worded = F.filter(lines_of(t), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    is_gone = lambda x: F.array_contains(gone, F.xxhash64(normalised(x))) & (normalised(x) != "")
    some = F.col(gone).isNotNull()
    left = F.filter(lines_of(t), lambda x: ~is_gone(x))
    clean = F.when(some & t.isNotNull(), F.array_join(left, "\n")).otherwise(t)
    # Out of a generator, so that the optimizer does not copy these terms to each of their uses.
    measured = F.explode(
        F.array(F.struct(
            word_count(t).alias("n_words"),
            F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(worded) - F.size(F.array_distinct(worded))).cast("long").alias("n_dup_lines"),
            F.col(repeats).alias("n_repeat_words"),
            clean.alias("clean_text"),
        ))
    ).alias(column)
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], measured)
    j = F.col(column)
    failed = (j["n_words"] < MIN_WORDS) | (100 * j["n_repeat_words"] > MAX_REPEAT_PERCENT * j["n_words"])
    removed = F.when(j["clean_text"] == t, F.lit(0).cast("long")).otherwise(j["n_words"] - word_count(j["clean_text"]))
    rows = rows.withColumn(column, j.withField("base_failed", failed).withField("removed_words", removed))
    depleted = 100 * j["removed_words"] > max_removed_percent * j["n_words"]
    return rows.withColumn(column, j.withField("kept", ~(j["base_failed"] | F.coalesce(depleted, F.lit(False)))))


def quality_report(docs: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """The figures and the verdict per document, without texts."""
    rows = judged(docs, **options)
    j = F.col(rows.columns[-1])
    return rows.select(
        id,
        *[j[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        j["base_failed"].alias("base_failed"),
        j["kept"].alias("kept"),
    )


def passed(docs: DataFrame, text: str = "text", chars: str = "n_chars", **options) -> DataFrame:
    """The documents kept, without their frequent lines; the columns of ``docs``."""
    rows = judged(docs, text=text, **options)
    j = F.col(rows.columns[-1])
    new = {text: j["clean_text"]}
    if chars in docs.columns:
        changed = ~j["clean_text"].eqNullSafe(F.col(text))
        size = F.length(j["clean_text"]).cast(docs.schema[chars].dataType)
        new[chars] = F.when(changed, size).otherwise(F.col(chars))
    return rows.filter(j["kept"]).select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
