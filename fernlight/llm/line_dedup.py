"""Line dedup by content-defined line chunks, with DataFrame operations alone.

Each line has a hash (MD5). A rolling hash over the hashes of a line and the `reach` - 1 lines before it
says where a chunk ends: where it falls into 1 of `spread` classes. Boundaries follow the lines
around them, so lines put in or left out elsewhere in a document shift no other chunk. A chunk of
two lines or more that also occurs earlier, in order of (document id, place), is removed.

Finding repeats moves no text: chunk hashes are counted by a partial aggregation, one row a task for
a chunk that every document holds. The texts of chunks whose hash repeats are then fetched from
their documents and grouped by the bytes themselves, not by that hash; so equal chunks, and only
these, share a first place. The SHA-256 of a group's bytes takes the place back to its chunks. The text exchange, by document, serves all three passes; its key is the id and a hash of the text, so rows without an id are dealt over all tasks.

Cases: null text counts as empty, which is one empty line. A last line without end is a line.
Rows that repeat an id are ordered by a hash of the text; equal rows are one document, so a repeat of a whole row
does not remove itself. A null id is an id of its own, before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: First hex digits that end a chunk, by the mean length of chunks.
ENDS = {2: "02468ace", 4: "048c", 8: "08", 16: "0"}
NO_ID = -(1 << 63)


def chunk_ends(reach: int, spread: int) -> str:
    """SQL for the last line (from 0) of each chunk, given line hashes h."""
    rolled = ", ".join(f"coalesce(get(h, i - {k}), '')" for k in reversed(range(reach)))
    classes = ", ".join(f"'{c}'" for c in ENDS[spread])
    return f"filter(transform(h, (x, i) -> if(i = size(h) - 1 or left(md5(concat({rolled})), 1) in ({classes}), i, -1)), e -> e >= 0)"


def _own(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"), text.alias("t")).withColumn("v", F.xxhash64("t")).repartition("d", "v")


def _chunks(own: DataFrame, reach: int, spread: int) -> DataFrame:
    """Adds lines, and starts and ends of the chunks."""
    rows = own.withColumn("lines", F.split("t", "\n", -1)).withColumn("h", F.expr("transform(lines, x -> md5(x))"))
    rows = rows.withColumn("ends", F.expr(chunk_ends(reach, spread)))
    return rows.withColumn("starts", F.expr("concat(array(0), transform(slice(ends, 1, size(ends) - 1), e -> e + 1))"))


def _text(k: str) -> Column:
    return F.expr(f"array_join(slice(lines, starts[{k}] + 1, ends[{k}] - starts[{k}] + 1), '\\n')")


def remove_repeated_chunks(docs: DataFrame, *, reach: int = 2, spread: int = 4, least_lines: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_lines, n_chunks, n_removed (lines), kept_text."""
    own = _own(docs, id_col, text_col)
    cut = _chunks(own, reach, spread)

    sized = F.expr("filter(transform(starts, (s, k) -> named_struct('k', k, 'n', ends[k] - s + 1, 'c', xxhash64(slice(h, s + 1, ends[k] - s + 1)))), x -> x.n >= %d)" % least_lines)
    small = cut.select("d", "v", F.explode(sized).alias("x")).select("d", "v", "x.k", "x.c")
    place = F.struct("d", "v", "k")
    again = small.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # the key is written anew so that both sides are shuffled for the join, which AQE needs to split a skewed key
    wanted = small.withColumn("nc", F.bitwise_not("c")).join(again.select(F.bitwise_not("c").alias("nc")), "nc").groupBy("d", "v").agg(F.sort_array(F.collect_set("k")).alias("ks"))

    found = cut.join(wanted, ["d", "v"]).select("d", "v", F.explode("ks").alias("k"), "lines", "starts", "ends").select("d", "v", "k", _text("k").alias("b"))
    # groups are of the bytes; only their digests travel back
    digest = F.unhex(F.sha2("b", 256))
    firsts = found.groupBy("b").agg(F.min(place).alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").select("low", digest.alias("e"))
    gone = found.select("d", "v", "k", digest.alias("e")).join(firsts, "e").where(place > F.col("low")).groupBy("d", "v").agg(F.collect_set("k").alias("gone"))

    out = cut.join(gone, ["d", "v"], "left").withColumn("gone", F.coalesce("gone", F.expr("cast(array() as array<int>)")))
    left = F.expr("transform(array_except(sequence(0, size(starts) - 1), gone), k -> array_join(slice(lines, starts[k] + 1, ends[k] - starts[k] + 1), '\\n'))")
    removed = F.expr("aggregate(gone, 0, (a, k) -> a + ends[k] - starts[k] + 1)")
    return out.select(F.nullif("d", F.lit(NO_ID)).alias(id_col), F.size("lines").alias("n_lines"), F.size("ends").alias("n_chunks"), removed.alias("n_removed"), F.array_join(left, "\n").alias("kept_text"))
