"""Quality rules: cross-document line frequency, and counts within a text.

A line, normalised (A-Z lower-cased, digits 0, white space joined) and hashed,
that more than ``max_docs`` documents of one host hold is boilerplate there.
Boilerplate lines are removed; a document that loses more than ``max_share`` of
its words to that is rejected.  Everything is DataFrame functions.  The text is
read once: its counts and the hashes of its distinct lines are written, and what
follows works on them.  Counts combine before the shuffle; common lines, which
are counted, are broadcast if they are few, and else joined by a shuffle.

Nulls and empties: a null text has no words and no lines; it fails the base
rule.  A null host is a host of its own.  A line's documents are the distinct
doc_ids that hold it, null not counted; each row, with a null or repeated doc_id
too, is judged by what its own text loses.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import storage

SPACES = " \t\n\x0b\f\r"
SPACE = "[\\x20\\x09-\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0000000000"
#: A host's documents that may hold a line before it counts as boilerplate.
MAX_DOCS = 100
#: Share of a document's words that may be boilerplate.
MAX_SHARE = 0.5
#: So many common lines (two hashes each) are broadcast at most.
BROADCAST_LINES = 500_000


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))


def lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def normalised(line: Column) -> Column:
    return F.translate(F.regexp_replace(F.btrim(line, F.lit(SPACES)), f"{SPACE}+", " "), UPPER, LOWER)


def base_counts(rows: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words to rows with a column text.

    Repeats: the 3-word windows are hashed and sorted with their places; equal
    neighbours are repeats, and their places, in order, give the covered words.
    """
    text = F.col("text")
    x = rows.withColumns({"_w": words(text), "_l": lines(text)})
    x = x.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_h": F.transform("_w", lambda w: F.xxhash64(w)),
    })
    places = F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int"))).otherwise(F.array().cast("array<int>"))
    x = x.withColumn("_g", F.transform(places, lambda i: F.xxhash64(F.get("_h", i), F.get("_h", i + 1), F.get("_h", i + 2))))
    # most texts of distinct windows need no sorting
    pairs = F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("h"), i.alias("i"))))
    x = x.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    repeated = lambda v, k: F.coalesce(F.get("_s", k - 1)["h"] == v["h"], F.lit(False)) | F.coalesce(F.get("_s", k + 1)["h"] == v["h"], F.lit(False))
    x = x.withColumn("_r", F.sort_array(F.transform(F.filter("_s", repeated), lambda v: v["i"])))
    start = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n"))
    step = lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n"))
    return x.withColumn("n_repeat_words", F.aggregate("_r", start, step, lambda a: a["n"])).drop("_w", "_l", "_h", "_g", "_s", "_r")


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text, source and row_key, equal for rows with equal host and text; with doc_id it tells what a row loses."""
    return documents.select("doc_id", "text", "source", F.xxhash64(F.coalesce("source", F.lit("\x00")), "text").alias("row_key"))


def measured(documents: DataFrame, folder: str) -> DataFrame:
    """(Keyed) documents with their base counts and lines, an array of line (hash), n (words in all its occurrences) for each distinct normalised line; without text, written once.

    Equal lines are neighbours in the sorted array, and have equally many words.
    """
    entry = lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).cast("long").alias("n"))
    rows = base_counts(documents).withColumn("_n", F.transform(lines(F.col("text")), normalised))
    rows = rows.withColumn("_s", F.sort_array(F.transform("_n", entry)))
    first = lambda x, i: (i == 0) | (F.get("_s", i - 1)["line"] != x["line"])
    rows = rows.withColumn("_p", F.filter(F.transform("_s", lambda x, i: F.when(first(x, i), i)), lambda i: i.isNotNull()))
    whole = lambda i, k: F.struct(F.get("_s", i)["line"].alias("line"), (F.get("_s", i)["n"] * (F.coalesce(F.get("_p", k + 1), F.size("_s")) - i)).alias("n"))
    rows = rows.withColumn("lines", F.transform("_p", whole)).withColumn("host", F.coalesce("source", F.lit("\x00")))
    return storage.save(rows.drop("text", "source", "_n", "_s", "_p"), f"{folder}/measured")


def line_rows(rows: DataFrame) -> DataFrame:
    """doc_id, row_key, host, line, n: a row for each distinct line of a (measured) document."""
    return rows.select("doc_id", "row_key", "host", F.explode("lines").alias("x")).select("doc_id", "row_key", "host", "x.line", "x.n")


def common_lines(rows: DataFrame, max_docs: int) -> DataFrame:
    """host, line of the lines that more than max_docs documents of a host hold."""
    return rows.groupBy("host", "line").agg(F.count_distinct("doc_id").alias("docs")).where(F.col("docs") > max_docs).select("host", "line")


def lost_lines(rows: DataFrame, max_docs: int, folder: str) -> DataFrame:
    """lost_id, row_key, lost (line, n): the boilerplate lines of each (measured) document, once also where its row is repeated."""
    rows = line_rows(rows)
    common = storage.save(common_lines(rows, max_docs), f"{folder}/common")
    few = common.count() <= BROADCAST_LINES
    found = rows.join(F.broadcast(common) if few else common, ["host", "line"])
    return found.groupBy(F.col("doc_id").alias("lost_id"), "row_key").agg(F.collect_set(F.struct("line", "n")).alias("lost"))


def with_lost(rows: DataFrame, lost: DataFrame) -> DataFrame:
    """Adds lost to keyed rows."""
    return rows.join(lost, (rows["row_key"] == lost["row_key"]) & rows["doc_id"].eqNullSafe(lost["lost_id"]), "left").drop("lost_id", "row_key")


def judge(documents: DataFrame, max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_boilerplate, kept."""
    folder = storage.work_dir(documents.sparkSession, "rules")
    rows = measured(keyed(documents), folder)
    n_lost = F.aggregate("lost", F.lit(0).cast("long"), lambda n, x: n + x["n"])
    lost = lost_lines(rows, max_docs, folder).withColumn("n_boilerplate", n_lost).drop("lost")
    base = rows.drop("lines", "host")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = with_lost(base, lost).withColumn("n_boilerplate", F.coalesce("n_boilerplate", F.lit(0)).cast("long"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("n_boilerplate") <= max_share * F.col("n_words")))


def clean(documents: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """doc_id and text without the lines that more than max_docs documents of its host hold."""
    folder = storage.work_dir(documents.sparkSession, "rules")
    documents = keyed(documents)
    lost = lost_lines(measured(documents, folder), max_docs, folder).withColumn("_drop", F.col("lost")["line"]).drop("lost")
    kept = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.coalesce("_drop", F.array().cast("array<bigint>")), F.xxhash64(normalised(x))))
    return with_lost(documents, lost).select("doc_id", F.array_join(kept, "\n").alias("text"))
