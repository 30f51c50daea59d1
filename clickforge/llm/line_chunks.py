"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of two consecutive lines is taken at every line; a chunk
starts where it is smaller than at both neighbours. Such borders depend on nearby lines only,
so they shift with a passage, and a chunk has two lines at least. A line of ``long_line``
words or more is a passage of its own and always one chunk. A chunk that occurs before, in
any document, is removed, after its bytes were compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import SEPARATORS, let, saved

#: Base and modulus of the rolling hash, over 28-bit line hashes.
BASE, MODULUS = 1_000_003, 2_147_483_647


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _n_words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, SEPARATORS), lambda w: w != ""))


def chunks_of(text: Column, long_line: int) -> Column:
    """Chunks of a text in order: array of ``n_lines``, ``text`` and ``whole`` (two lines with a
    word, or one long line: what may be removed)."""
    def upto(n):
        return F.sequence(F.lit(0), n - 1)

    def starts(r, wide):
        def at(i):
            least = (F.get(r, i) < F.get(r, i - 1)) & F.coalesce(F.get(r, i) <= F.get(r, i + 1), F.lit(True))
            return (i == 0) | F.get(wide, i) | F.get(wide, i - 1) | least
        return F.filter(upto(F.size(r)), lambda i: F.when(i == 0, True).otherwise(at(i)))

    def chunk(lines, wide, words_in, start, end):
        with_words = F.size(F.filter(F.slice(words_in, start + 1, end - start), lambda n: n > 0))
        return F.struct((end - start).alias("n_lines"),
                        F.array_join(F.slice(lines, start + 1, end - start), "\n").alias("text"),
                        ((with_words >= 2) | F.get(wide, start)).alias("whole"))

    def cut(lines, words_in, wide, s):
        return F.transform(s, lambda start, j: chunk(
            lines, wide, words_in, start, F.coalesce(F.get(s, j + 1), F.size(lines))))

    def rolled(h):
        return F.transform(h, lambda x, i: F.pmod(
            x * BASE + F.coalesce(F.get(h, i + 1), F.lit(0)), F.lit(MODULUS)))

    return let(F.split(text, "\n"), lambda lines: let(
        F.transform(lines, _n_words), lambda words_in: let(
            F.transform(words_in, lambda n: n >= long_line), lambda wide: let(
                let(F.transform(lines, _line_hash), rolled), lambda r: let(
                    starts(r, wide), lambda s: cut(lines, words_in, wide, s))))))



def _repeats(docs: DataFrame, id_col: str, text_col: str, long_line: int) -> DataFrame:
    """Chunks that occur before: ``id``, ``t`` (hash of the text), ``gone`` (their places)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    each = rows.select("id", F.md5("text").alias("t"), F.posexplode(chunks_of(F.col("text"), long_line)).alias("place", "c")) \
        .where("c.whole").select("id", "t", "place", F.md5("c.text").alias("h"), F.col("c.text").alias("chunk"))
    again = saved(each.groupBy("h").count().where("count > 1").select("h"), "repeated-hashes")
    at = F.struct(F.col("id").isNull().alias("none"), "id", "t", "place")
    # the repeated hashes grow with the documents, so they are never broadcast
    found = saved(each.join(again.hint("merge"), "h", "left_semi").withColumn("at", at).drop("id", "t", "place"), "repeated-chunks")
    # grouping by the bytes is the comparison: a hash may be shared, the bytes are not
    first = saved(found.groupBy("h", "chunk").agg(F.min("at").alias("first")), "first-chunks")
    later = found.join(first, ["h", "chunk"]).where("at <> first")
    return later.groupBy("at.id", "at.t").agg(F.collect_set("at.place").alias("gone"))


def _deduped(docs: DataFrame, id_col: str, text_col: str, long_line: int) -> DataFrame:
    """``row`` (all columns), ``text`` without repeats, ``n_lines``, ``n_removed_lines`` and
    ``n_removed_chunks``."""
    gone = saved(_repeats(docs, id_col, text_col, long_line), "repeats").hint("merge")  # grows too
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col("row")[text_col]
    rows = rows.join(gone, F.col("row")[id_col].eqNullSafe(gone["id"]) & (F.md5(text) == gone["t"]), "left")

    def rest(chunks):
        kept = F.array_except(F.sequence(F.lit(0), F.size(chunks) - 1), F.col("gone"))
        return F.struct(F.array_join(F.transform(kept, lambda j: F.get(chunks, j)["text"]), "\n").alias("text"),
                        F.aggregate("gone", F.lit(0), lambda n, j: n + F.get(chunks, j)["n_lines"]).alias("removed"))

    done = F.when(F.col("gone").isNotNull(), let(chunks_of(text, long_line), rest))
    return rows.withColumn("done", done).select(
        "row", F.when(F.col("gone").isNull(), text).otherwise(F.col("done.text")).alias("text"),
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("long").alias("n_lines"),
        F.coalesce("done.removed", F.lit(0)).cast("long").alias("n_removed_lines"),
        F.greatest(F.size("gone"), F.lit(0)).cast("long").alias("n_removed_chunks"))


def dedup_line_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      long_line: int = 50) -> DataFrame:
    """``id_col``, ``text`` without repeated chunks, ``n_lines``, ``n_removed_lines`` and
    ``n_removed_chunks`` of every row.

    Of equal chunks the one of the least id stays (null ids last; then by a hash of the text,
    then by place). Rows that repeat both id and text are one document: they lose the same
    chunks, and none to each other. A null text stays null and an empty one empty, with 0 and
    1 lines. Other columns are ignored. Repeats are found by hashes alone; then the
    chunks' bytes are shuffled once to meet the repeated hashes, and those of a repeated hash
    are compared.
    """
    return _deduped(docs.select(id_col, text_col), id_col, text_col, long_line).select(
        F.col("row")[id_col].alias(id_col), "text", "n_lines", "n_removed_lines", "n_removed_chunks")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    long_line: int = 50) -> DataFrame:
    """``docs`` with repeated chunks removed from the text column. A row of whose text nothing
    but blanks is left goes; a row that had no words before stays as it is."""
    done = _deduped(docs, id_col, text_col, long_line)
    done = done.where((F.col("n_removed_chunks") == 0) | (_n_words(F.col("text")) > 0))
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c)
                         for c in docs.columns])
