"""Spelling variants: words of the corpus one edit apart, grouped under their
most frequent form.

The similarity join is asymmetric.  One word of a pair contributes two disjoint
chunks, its halves; the other contributes its positional grams of the same
lengths.  One inserted, deleted or replaced code point leaves one of the halves
whole and moves it by at most one place, so the join is on (length, half, text)
with the grams that begin within one place of where that half begins, and every
pair it brings is verified.  The shorter word of a pair gives the chunks (the
smaller one of two equal lengths), so a pair is looked for once.  Only words
that pass the verification leave the join.

Counts are over all documents: words are counted before anything is shuffled,
so a word that fills a third of the corpus is one row of each task.  Forms lead
to words at least ``RATIO`` times as frequent, hence without cycles, and roots
are found by jumping: each round doubles the length of the paths it has followed.

Every join is by sorting.  Words are many even where their compressed table is
small, and their grams nine times as many, which Spark's estimate of a size
leaves out: it would send them through the driver.

Defined cases: a null text has no words; a null ``doc_id`` names its damage with
an empty id; rows that share an id are damaged alike; an empty table, or one
whose words are all rare or short, gives no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import write_table

LEAST_LENGTH = 5          # code points of a word; at least 4, so that a half has two
LEAST_COUNT = 3
RATIO = 2                 # a form is at least so many times as frequent
DAMAGE = 97               # one of so many runs of a document loses a code point

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "[A-Za-zÀ-ÿ]"


def _runs(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """``(id, w)``: every maximal run of letters with ``least`` code points."""
    found = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(_RUN + "{%d,}" % least), F.lit(0))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("raw")) \
        .select("id", F.translate("raw", _UPPER, _LOWER).alias("w"))


def damaged(runs: DataFrame) -> DataFrame:
    """``(word)`` per run ``(id, w)``: where ``DAMAGE`` divides the CRC-32 of
    ``id:w``, the run without its code point number ``crc % length``."""
    h = runs.select("w", F.crc32(F.concat_ws(":", "id", "w")).alias("h"))
    at = (F.col("h") % F.length("w")).cast("int")
    short = F.concat(F.substring(F.col("w"), F.lit(1), at), F.substring(F.col("w"), at + 2, F.length("w")))
    return h.select(F.when(F.col("h") % DAMAGE == 0, short).otherwise(F.col("w")).alias("word"))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of all (damaged) words of the documents that are long and
    frequent enough.  A run shorter than a word's least length can't become one."""
    words = damaged(_runs(docs, id_col, text_col, least_length))
    return (words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def chunks(words: DataFrame) -> DataFrame:
    """The two halves of each word: ``(length, half, part, word, n)``."""
    h, size = _half(F.length("word")), F.length("word")
    halves = F.array(F.struct(F.lit(0).alias("half"), F.substring(F.col("word"), F.lit(1), h).alias("part")),
                     F.struct(F.lit(1).alias("half"), F.substring(F.col("word"), h + 1, size).alias("part")))
    return words.select(size.alias("length"), F.inline(halves), "word", "n")


def grams(words: DataFrame) -> DataFrame:
    """The positional grams of each word that can be a half of a word of its
    length or one less: those that begin within one place of that half.
    ``(length, half, part, word, n)`` with the length of that other word."""
    size = F.length("word")

    def of(length: Column, half: int) -> list[Column]:
        h = _half(length)
        begin, long = (F.lit(0), h) if half == 0 else (h, length - h)
        out = []
        for shift in (-1, 0, 1):
            if half == 0 and shift < 0:
                continue
            at = begin + shift
            out.append(F.when((at >= 0) & (at + long <= size), F.struct(
                length.alias("length"), F.lit(half).alias("half"), F.substring(F.col("word"), at + 1, long).alias("part"))))
        return out

    every = [g for less in (0, 1) for half in (0, 1) for g in of((size - less).cast("int"), half)]
    some = F.array_distinct(F.filter(F.array(*every), lambda g: g.isNotNull()))
    return words.select(F.inline(some), F.col("word").alias("other"), F.col("n").alias("m"))


def near_pairs(words: DataFrame) -> DataFrame:
    """Each pair of words ``(word, n)`` one edit apart once: ``(word, n, other, m)``."""
    a, b = chunks(words), grams(words)
    on = ((a["length"] == b["length"]) & (a["half"] == b["half"]) & (a["part"] == b["part"])
          & ((a["length"] < F.length("other")) | (F.col("word") < F.col("other")))
          & (F.levenshtein(F.col("word"), F.col("other"), 1) == 1))
    return a.join(b.hint("merge"), on).select("word", "n", "other", "m").distinct()


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, n_near, form, form_n)`` of words that have near words; the form
    is null where no near word is frequent enough."""
    pairs = write_table(near_pairs(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("m").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("m")))
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"),
                                         F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form"))).alias("b"))
    enough = -F.col("b.less") >= ratio * F.col("n")
    return best.select("word", "n_near", F.when(enough, F.col("b.form")).alias("form"),
                       F.when(enough, -F.col("b.less")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """``(word, root)`` of the words ``(word, form)`` that have a form."""
    now = write_table(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = now.join(ahead.hint("merge"), F.col("root") == F.col("_w"), "left")
        now = write_table(step.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` per word of the documents."""
    words = write_table(word_counts(docs, id_col, text_col), "words")
    near = write_table(forms(words), "forms")
    return (words.join(near.hint("merge"), "word", "left").join(roots(near).hint("merge"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
