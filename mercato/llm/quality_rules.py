"""Quality rules: counts within a text, and lines that repeat across documents.

All work is DataFrame expressions.  Repeated word triples are found inside the
row: triples are hashed, sorted with their positions, and equal neighbours
give the positions whose words are counted.

Line frequency: lines are normalised (lower case, white space runs to one
space, trimmed) and hashed with their host; distinct documents are counted for
each (copies of one text on a host count once, so a copied document does not
make its own lines frequent).  Lines in more documents than a host's limit are
removed; a document that is depleted by that is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import materialize

#: Characters between words, and symbols that are counted (fixed values).
BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"

#: A line is frequent in more than this many documents of a host, and more than this share of them.
MIN_LINE_DOCS = 10
LINE_SHARE = 0.01
#: A document is depleted with less than this share of its words left.
MIN_LEFT = 0.5
#: Base rules: fewest words, and the largest percentage of words in repeated triples.
MIN_WORDS, MAX_REPEATED = 50, 50


def split_words(text: Column) -> Column:
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(spaced, " "), "")


def base_counts(docs: DataFrame) -> DataFrame:
    """(id, host, text) -> id, host, content, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    removed = lambda chars: F.translate(text, chars, "")
    one = docs.select(
        "id", "host", F.xxhash64("text").alias("content"), split_words(text).alias("words"),
        F.length(removed(BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(removed(SYMBOLS))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "").alias("lines"))
    triple = F.arrays_zip(*[F.slice("words", k, F.greatest(F.size("words") - 2, F.lit(0))).alias(f"w{k}") for k in (1, 2, 3)])
    two = one.select(
        "id", "host", "content", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.transform(triple, lambda t, i: F.struct(F.xxhash64(t).alias("h"), i.alias("i")))).alias("sorted"))
    # single elements only: "sorted.h" inside a function would build its array anew for every element
    same = lambda x, j: (x.h == F.get("sorted", j - 1).h) | (x.h == F.get("sorted", j + 1).h)
    four = two.withColumn("at", F.sort_array(F.array_compact(F.transform("sorted", lambda x, j: F.when(same(x, j), x.i)))))
    words_of = F.transform("at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("at", j + 1) - p, F.lit(3))))
    return four.select("id", "host", "content", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.aggregate(words_of, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))


def document_lines(docs: DataFrame) -> DataFrame:
    """(id, host, text) -> a row for each line with a word: id, host, content, nth, line (a hash with the host), words."""
    spaced = F.regexp_replace(F.translate(F.lower("text"), "\t\x0b\x0c\r", "    "), " {2,}", " ")
    split = docs.select("id", "host", F.xxhash64("text").alias("content"), F.posexplode(F.split(spaced, "\n")).alias("nth", "raw"))
    plain = split.select("id", "host", "content", "nth", F.trim("raw").alias("plain")).filter("plain <> ''")
    words = F.length("plain") - F.length(F.translate("plain", " ", "")) + 1
    return plain.select("id", "host", "content", "nth", F.xxhash64(F.isnull("host"), "host", "plain").alias("line"), words.alias("words"))


def frequent_lines(lines: DataFrame, docs: DataFrame, min_docs: int = MIN_LINE_DOCS, share: float = LINE_SHARE) -> DataFrame:
    """Hashes of the lines that more distinct documents of a host hold than its limit."""
    limits = (docs.groupBy("host").agg(F.count_distinct(F.xxhash64("text")).alias("n"))
              .select(F.col("host").alias("of"), F.greatest(F.lit(float(min_docs)), F.col("n") * share).alias("limit")))
    counts = lines.groupBy("host", "line").agg(F.count_distinct("content").alias("docs")).filter(F.col("docs") > min_docs)
    return counts.join(limits, F.col("host").eqNullSafe(F.col("of"))).filter("docs > limit").select("line")


def judge(docs: DataFrame, min_docs: int = MIN_LINE_DOCS, share: float = LINE_SHARE,
          min_left: float = MIN_LEFT) -> DataFrame:
    """(id, host, text) -> doc_id, the counts, base_failed, kept, n_removed_words.

    A null or empty text has no words and fails the base rules.  Null hosts are
    one host.  Repeated rows are judged each, alike; there are no ties.  Texts
    are judged whole, however long; a text's lines and triples are held in its
    row.  An empty table gives an empty result.  Other columns, whatever their
    names, are left out.
    """
    docs = docs.select("id", "host", "text")
    lines = materialize(document_lines(docs), "document-lines")  # read twice
    frequent = materialize(frequent_lines(lines, docs, min_docs, share), "frequent-lines")
    removed = (lines.join(frequent, "line").groupBy("id", "host", "content", "nth").agg(F.max("words").alias("words"))
               .groupBy(F.col("id").alias("id2"), F.col("host").alias("host2"), F.col("content").alias("content2"))
               .agg(F.sum("words").alias("n_removed_words")))
    same = (F.col("id").eqNullSafe(F.col("id2")) & F.col("host").eqNullSafe(F.col("host2")) & (F.col("content") == F.col("content2")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    return (base_counts(docs).join(removed, same, "left").fillna(0, ["n_removed_words"])
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (left >= F.col("n_words") * min_left))
            .select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "n_removed_words"))
