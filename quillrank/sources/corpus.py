"""Text sources: documents, sentence files, labelled corpora and IDF lexicons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = "[ \\t\\r\\f]+"


def split_words(line: Column) -> Column:
    return F.filter(F.split(line, BLANKS), lambda w: w != "")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole text, outer blanks removed."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("doc_id"), F.trim("value").alias("text")))


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """One array of words per non-empty line."""
    return (spark.read.text(path).select(split_words(F.col("value")).alias("words"))
            .filter(F.size("words") > 0))


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """``category tag tag ...`` lines; lines without a tag are skipped."""
    words = F.col("words")
    return (read_sentences(spark, path).filter(F.size(words) > 1)
            .select(words[0].alias("category"), F.slice(words, 2, F.size(words) - 1).alias("tags")))


def read_idf(spark: SparkSession, path: str) -> DataFrame:
    """``word idf`` lines."""
    parts = F.col("words")
    return (read_sentences(spark, path).filter(F.size(parts) >= 2)
            .select(parts[0].alias("word"), parts[1].try_cast("double").alias("idf"))
            .dropna())


def sentences(docs: DataFrame) -> DataFrame:
    """(doc_id, line, words) for every non-empty line of every document."""
    return (docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "value"))
            .select("doc_id", "line", split_words(F.col("value")).alias("words"))
            .filter(F.size("words") > 0))


def words_of_lines(docs: DataFrame, min_line: int = 1, stop_words: tuple[str, ...] = (),
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, words): the words of a document in order, in one array.

    Lines shorter than ``min_line`` words are dropped before single characters
    and stop words are. A document is one row of the input, so no shuffle is
    needed to keep its words together.
    """
    lines = F.transform(F.split("text", "\n"), split_words)
    words = F.flatten(F.filter(lines, lambda ws: F.size(ws) >= min_line))
    kept = F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(list(stop_words))
                    if stop_words else F.length(w) > 1)
    return docs.select("doc_id", *keep, kept.alias("words"))


def tokens(words: DataFrame) -> DataFrame:
    """(doc_id, word, pos) rows of the word arrays."""
    return words.select("doc_id", F.posexplode("words").alias("pos", "word"))
