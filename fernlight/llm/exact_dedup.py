"""Exact dedup by content sort, with DataFrame operations alone.

Texts are equal when they are identical after lower-casing A-Z. Rows are range-partitioned by content,
the external sort by the normalised text places equal texts next to each other, and a window compares
each text in full with its neighbours and keeps one identifier: the largest document id of each group by
default, or the smallest.

* Order of the partitions: the first four bytes, then a hash, of the text lower-cased by the JVM's `lower`; inside
  a partition rows are sorted by the text itself. The hash deals texts that begin alike, as pages of a
  site do, over several partitions. Texts equal after A-Z alone are equal there too, so equal texts
  always meet; the order only deals, the window's own comparison is of whole normalised texts.
* A first scan counts rows by that hash and writes the small table of counts. From it come the
  splitters, as approximate quantiles of the order over all distinct contents: one number for each
  shuffle partition is all that the driver sees, whatever the input. The second scan deals the texts.
* Heavy texts. A text with more than 1 / (8 n) of all rows, n being the shuffle partitions, would
  fill its partition. There are fewer than 8 n by that very share; if there is any, they are
  broadcast, and their rows are dealt over all partitions by their ids and sorted in n pieces. The
  pieces' winners, at most n a text, are then compared in full in the same way and one row a text,
  again fewer than 8 n, is broadcast back.

Cases: null text counts as empty, and empty texts form a group. Rows that repeat an id and a text
are one group; exactly one row of a group stays. A null id loses to all others, whichever is kept. Rows
of one heavy text that repeat an id, or have none, are one piece. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernlight.llm.common import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. `lower` does the same, faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _order(low: Column, hashed: Column) -> Column:
    """A number of 53 bits: four bytes of the text, then bits of its hash."""
    head = F.conv(F.rpad(F.hex(F.substring(low.cast("binary"), 1, 4)), 8, "0"), 16, 10).cast("long")
    return head * F.lit(1 << 21) + F.shiftrightunsigned(hashed, 43)


def _range_of(order: Column, splitters: list[int]) -> Column:
    """How many of the sorted splitters are below order, by halving steps."""
    if not splitters:
        return F.lit(0)
    edges = F.lit([*splitters, (1 << 62)])
    steps = [1 << k for k in reversed(range(len(splitters).bit_length()))]
    further = lambda at, step: F.when((at + step <= len(splitters)) & (F.get(edges, F.least(at + step, F.lit(len(splitters))) - 1) < order), at + step).otherwise(at)
    return F.aggregate(F.lit(steps), F.lit(0), further)


def _sorted_runs(docs: DataFrame, keep: str, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Rows i, d (SHA-256), k (winner), n (group size), kept and, to carry, c (the input row)."""
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    best = F.max if keep == "largest" else F.min

    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("c")] if carry else []))
    low = F.lower("t")
    keyed = rows.withColumn("x", F.xxhash64(low)).withColumn("o", _order(low, F.col("x")))

    counts = checkpointed(keyed.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("o")))
    quantiles = F.percentile_approx("o", [k / parts for k in range(1, parts)], max(10_000, 20 * parts)) if parts > 1 else F.lit(None)
    splitters, total = counts.agg(quantiles, F.sum("n")).first()
    heavy = counts.where(F.col("n") * 8 * parts > F.lit(total)).select("x", F.lit(True).alias("heavy"))
    place = _range_of(F.col("o"), sorted(set(splitters or [])))

    def runs(part: DataFrame) -> DataFrame:
        ordered = part.repartitionById(parts, "p").withColumn("w", lower_ascii(F.col("t"))).drop("t")
        run = Window.partitionBy("p", "s", "w")
        first = F.row_number().over(run.orderBy(F.col("i").desc_nulls_last() if keep == "largest" else F.col("i").asc_nulls_last()))
        return ordered.select("i", "s", "w", F.sha2("w", 256).alias("d"), best("i").over(run).alias("k"), F.count(F.lit(1)).over(run).alias("n"), first.alias("r"), *(["c"] if "c" in part.columns else []))

    kept = (F.col("r") == 1) & F.col("i").eqNullSafe(F.col("k"))
    out = ["i", "d", "k", "n", kept.alias("kept"), *(["c"] if carry else [])]
    if heavy.isEmpty():
        return runs(keyed.withColumns({"s": F.lit(-1), "p": place})).select(*out)

    found = keyed.join(F.broadcast(heavy), "x", "left")
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("i"), F.lit(parts))).otherwise(F.lit(-1)).cast("int")
    salted = found.withColumn("s", salt).drop("heavy").withColumn("p", F.when(F.col("s") >= 0, F.col("s")).otherwise(place))
    pieces = runs(salted.where("s >= 0").drop("c")).where("r = 1")
    whole = Window.partitionBy("d", "w")
    merged = pieces.select("d", best("k").over(whole).alias("mk"), F.sum("n").over(whole).alias("mn"), F.row_number().over(whole.orderBy("s")).alias("mr")).where("mr = 1").select(F.col("d").alias("md"), "mk", "mn")
    joined = runs(salted).drop("w").join(F.broadcast(merged), (F.col("s") >= 0) & (F.col("d") == F.col("md")), "left")
    return joined.withColumns({"k": F.when(F.col("s") >= 0, F.col("mk")).otherwise(F.col("k")), "n": F.when(F.col("s") >= 0, F.col("mn")).otherwise(F.col("n"))}).select(*out)


def exact_groups(docs: DataFrame, *, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 of the normalised text."""
    runs = _sorted_runs(docs, keep, id_col, text_col, carry=False)
    return runs.select(F.col("i").alias(id_col), F.col("k").alias("keep_id"), F.col("n").alias("group_size"), "kept", F.col("d").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, *, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the input's columns; rows travel with the sort, so no join follows."""
    return _sorted_runs(docs, keep, id_col, text_col, carry=True).where("kept").select("c.*")
