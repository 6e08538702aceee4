"""Mixing sources to target weights by iterative proportional fitting, with DataFrame operations alone.

The table of token counts by (source, language, topic) is raked under the bound that no document can
be taken more than once and that no cell is emptied: each cell has a weight, its probability is the weight held
between `least` and 1, and in turn each margin's cells are multiplied by target / expected share, until no probability changes by over
`tolerance` in a round or after `rounds`. A cell's probability is that with which each of its documents is
sampled. The draw is a hash of the id, so a run repeats and shards agree.

Targets: a margin's goal is a mapping of value to weight, or a power: shares in proportion to
(present share) ** power, which evens out a source that holds a third of all rows and follows new
values by itself. Values without a goal keep their present share; all are then scaled to 1. `fraction`
is the share of all tokens expected to stay. A value can give no more than it has: where its goal asks
for more, its target is all it has, and the others share the rest in proportion to their goals. So
the margins' targets are the nearest ones that the corpus can meet, one margin at a time. Cells of a
value that gives all have probability 1 and take no part in the raking.

How well it went is told, not assumed. `margins` lists each value's present share, goal, target and
expected share. `residual` is the largest difference between an expected share and a target: over 0
where the three margins, or a margin and `least`, contradict each other. `off_goal` is the largest
difference between a value's share of the expected mixture and its goal: what the bound of 1 costs. A
lower `fraction` comes nearer to the goals.

Topics are a column of the table, or `shape_topic`: where, as in `documents`, no topic is known, the
third margin is a class of texts by form (table, shouting, symbols, prose) and length, computed from
whole texts.

Scale: one pass over the texts makes small rows, whose partial aggregation makes the cell table; its
size is (sources x languages x topics) and not the number of rows. Raking runs on it alone, a
checkpoint a round: in one partition up to `CELLS_IN_ONE` cells, by shuffles of cells beyond. Its
result is joined back as a broadcast up to the same checked number, by a shuffled join (AQE splits
the hot source) beyond.

Cases: null source or language is the value ''. Null and empty texts have 0 tokens; a cell of 0
tokens has probability 1. Rows that repeat an id are drawn alike. A `fraction` of 1 or more keeps all.
An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernlight.llm.common import checkpointed

CELLS_IN_ONE = 200_000
ROUNDS, TOLERANCE, LEAST = 60, 1e-13, 0.1
MARGINS = ("source", "lang", "topic")
WORD = r"[^\x20\x09-\x0D]+"
DEFAULT_TARGETS = {"source": 0.5, "lang": 0.7, "topic": 0.9}


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD + "+")).cast("long")


def shape_topic(text: Column, n: Column) -> Column:
    """Form and length class of a whole text of n words."""
    bars = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("|"), F.lit("")))
    bangs = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("!"), F.lit("")))
    marks = F.regexp_count(text, F.lit("[#$%&*]"))
    form = F.when(bars * 4 > n, "table").when(bangs * 2 > n, "shouting").when(marks > n, "symbols").otherwise("prose")
    length = F.when(n < 100, "short").when(n < 1000, "medium").otherwise("long")
    return F.concat_ws("/", form, length)


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the id: 48 bits of an MD5."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


# --- targets


def margin_targets(cells: DataFrame, margin: str, goal, fraction: float) -> DataFrame:
    """(value, g, t, full) of one margin: goal, target share of all tokens, and whether the value gives all it has."""
    everything, by_ratio = Window.partitionBy(), Window.orderBy(F.col("r").asc_nulls_last(), "value")
    has = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("share").alias("s"))
    if isinstance(goal, dict):
        named = F.create_map(*[F.lit(x) for kv in goal.items() for x in kv]) if goal else None
        g = F.col("s") if named is None else F.coalesce(named[F.col("value")].cast("double"), F.col("s"))
    else:
        g = F.pow("s", F.lit(float(goal)))
    goals = has.withColumn("g", F.when(F.col("s") > 0, g).otherwise(0.0))
    goals = goals.withColumn("g", F.coalesce(F.try_divide("g", F.sum("g").over(everything)), F.lit(0.0))).withColumn("r", F.try_divide("s", "g"))
    # the share kept if all goals grew to this value's ratio; values before the wanted share give all
    kept = F.sum("s").over(by_ratio) + F.col("r") * (F.lit(1.0) - F.sum("g").over(by_ratio))
    goals = goals.withColumn("full", F.coalesce(kept < F.lit(float(fraction)), F.lit(False)))
    rest = F.lit(float(fraction)) - F.coalesce(F.sum(F.when(F.col("full"), F.col("s"))).over(everything), F.lit(0.0))
    factor = F.coalesce(F.try_divide(rest, F.sum(F.when(~F.col("full"), F.col("g"))).over(everything)), F.lit(0.0))
    return goals.select("value", "g", F.when(F.col("full"), F.col("s")).otherwise(F.least("s", F.col("g") * factor)).alias("t"), "full")


def _with_targets(cells: DataFrame, targets: dict, fraction: float) -> DataFrame:
    """Adds `share`, each margin's g_<margin> and t_<margin>, and `full`: whether one of its values gives all it has."""
    total = F.sum("n").over(Window.partitionBy())
    cells = cells.withColumn("share", F.coalesce(F.try_divide(F.col("n"), total), F.lit(0.0)))
    out = cells
    for m in MARGINS:
        told = margin_targets(cells, m, targets[m], fraction)
        out = out.join(told.select(F.col("value").alias(m), F.col("g").alias(f"g_{m}"), F.col("t").alias(f"t_{m}"), F.col("full").alias(f"f_{m}")), m)
    full = reduce(lambda a, b: a | b, [F.col(f"f_{m}") for m in MARGINS]) | F.lit(fraction >= 1) | (F.col("share") <= 0)
    return out.withColumn("full", full).drop(*[f"f_{m}" for m in MARGINS])


# --- raking


def rake(cells: DataFrame, targets: dict, fraction: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE, least: float = LEAST, small: bool = True) -> DataFrame:
    """Adds `share` (present), g_<margin> (goals), t_<margin> (targets) and `p` to cells (source, lang, topic, n). small: in one partition."""
    written = (lambda df: checkpointed(df).coalesce(1)) if small else checkpointed
    p = F.greatest(F.lit(float(min(least, fraction))), F.least(F.lit(1.0), F.col("w")))
    now = _with_targets(cells.coalesce(1) if small else cells, targets, fraction)
    for m in MARGINS:  # what the cells that are raked have to give
        given = F.coalesce(F.sum(F.when(F.col("full"), F.col("share"))).over(Window.partitionBy(m)), F.lit(0.0))
        now = now.withColumn(f"l_{m}", F.greatest(F.lit(0.0), F.col(f"t_{m}") - given))
    now = written(now.withColumn("w", F.lit(float(fraction))))
    for _ in range(rounds):
        now = now.withColumn("before", p)
        for m in MARGINS:
            have = F.sum(F.when(~F.col("full"), F.col("share") * p)).over(Window.partitionBy(m))
            now = now.withColumn("w", F.when(have > 0, F.col("w") * F.col(f"l_{m}") / have).otherwise(F.col("w")))
        now = written(now.withColumn("change", F.when(~F.col("full"), F.abs(p - F.col("before")))).drop("before"))
        if (now.agg(F.max("change")).first()[0] or 0.0) <= tolerance:
            break
    return now.select(*MARGINS, "n", "share", *[f"{x}_{m}" for x in "gt" for m in MARGINS], F.when(F.col("full"), F.lit(1.0)).otherwise(p).alias("p"))


def margins(raked: DataFrame) -> DataFrame:
    """(margin, value, present, goal, target, expected) of raked cells. Present, target and expected are shares of all tokens before sampling, the goal is one of the mixture."""
    rows = [raked.groupBy(F.col(m).alias("value")).agg(F.sum("share").alias("present"), F.first(f"g_{m}").alias("goal"), F.first(f"t_{m}").alias("target"), F.sum(F.col("share") * F.col("p")).alias("expected")).select(F.lit(m).alias("margin"), "*") for m in MARGINS]
    return reduce(DataFrame.union, rows)


def _told(raked: DataFrame) -> DataFrame:
    """One row: residual and off_goal."""
    kept = F.sum("expected") / len(MARGINS)
    far = F.max(F.abs(F.try_divide("expected", F.col("kept")) - F.col("goal")))
    listed = margins(raked)
    total = listed.agg(kept.alias("kept"))
    return listed.crossJoin(F.broadcast(total)).agg(F.coalesce(F.max(F.abs(F.col("expected") - F.col("target"))), F.lit(0.0)).alias("residual"), F.coalesce(far, F.lit(0.0)).alias("off_goal"))


_CELL = {m: f"__mix_{m}" for m in MARGINS}


def _rows(docs: DataFrame, text_col: str, source_col: str, lang_col: str, topic: Column | None) -> DataFrame:
    """docs with cells and tokens in columns __mix_*."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumns({_CELL["source"]: F.coalesce(F.col(source_col).cast("string"), F.lit("")), _CELL["lang"]: F.coalesce(F.col(lang_col).cast("string"), F.lit("")), "__mix_tokens": tokens(text)})
    return rows.withColumn(_CELL["topic"], F.coalesce(topic.cast("string"), F.lit("")) if topic is not None else shape_topic(text, F.col("__mix_tokens")))


def _probabilities(rows: DataFrame, targets: dict | None, fraction: float, rounds: int, tolerance: float, least: float) -> tuple[DataFrame, bool]:
    """Raked cells of rows, and whether they are few."""
    cells = checkpointed(rows.groupBy(*[F.col(c).alias(m) for m, c in _CELL.items()]).agg(F.sum("__mix_tokens").alias("n")))
    small = cells.count() <= CELLS_IN_ONE
    return rake(cells, DEFAULT_TARGETS | (targets or {}), fraction, rounds, tolerance, least, small), small


def _joined(rows: DataFrame, raked: DataFrame, small: bool) -> DataFrame:
    named = raked.select(*[F.col(m).alias(c) for m, c in _CELL.items()], F.col("p").alias("__mix_p"))
    return rows.join(F.broadcast(named) if small else named, list(_CELL.values()))


def mixture(docs: DataFrame, *, targets: dict | None = None, fraction: float = 0.8, rounds: int = ROUNDS, tolerance: float = TOLERANCE, least: float = LEAST, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None) -> DataFrame:
    """One row per input row: id, source, lang, topic, tokens, p (probability), kept, and residual and off_goal, the same for all rows. Texts are read once."""
    rows = checkpointed(_rows(docs, text_col, source_col, lang_col, topic).select(F.col(id_col).alias("__mix_id"), *_CELL.values(), "__mix_tokens"))
    raked, small = _probabilities(rows, targets, fraction, rounds, tolerance, least)
    out = _joined(rows, raked, small).crossJoin(F.broadcast(_told(raked)))
    return out.select(F.col("__mix_id").alias(id_col), *[F.col(c).alias(m) for m, c in _CELL.items()], F.col("__mix_tokens").alias("tokens"), F.col("__mix_p").alias("p"), (draw(F.col("__mix_id"), seed) < F.col("__mix_p")).alias("kept"), "residual", "off_goal")


def sample_mixture(docs: DataFrame, *, targets: dict | None = None, fraction: float = 0.8, rounds: int = ROUNDS, tolerance: float = 1e-9, least: float = LEAST, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None) -> DataFrame:
    """The sampled rows, with the input's columns. Texts are read twice, and not moved."""
    rows = _rows(docs, text_col, source_col, lang_col, topic)
    raked, small = _probabilities(rows, targets, fraction, rounds, tolerance, least)
    return _joined(rows, raked, small).where(draw(F.col(id_col), seed) < F.col("__mix_p")).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture_sql(*, fraction: float = 0.8, rounds: int = ROUNDS, least: float = LEAST, seed: int = 42, power: dict | None = None, table: str = "documents") -> str:
    """DuckDB SQL for mixture over documents with powers as targets; raking is a recursive CTE of `rounds` steps."""
    power = DEFAULT_TARGETS | (power or {})
    strip = "(strlen(t) - strlen({}))"
    bars, bangs, marks = (strip.format(x) for x in ("replace(t, '|', '')", "replace(t, '!', '')", "translate(t, '#$%&*', '')"))
    cell, floor = ", ".join(MARGINS), min(least, fraction)
    steps = [
        f"base AS (SELECT doc_id AS i, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS tokens FROM {table})",
        f"d AS (SELECT i, source, lang, CASE WHEN {bars} * 4 > tokens THEN 'table' WHEN {bangs} * 2 > tokens THEN 'shouting' WHEN {marks} > tokens THEN 'symbols' ELSE 'prose' END || '/' || CASE WHEN tokens < 100 THEN 'short' WHEN tokens < 1000 THEN 'medium' ELSE 'long' END AS topic, tokens FROM base)",
        f"c AS (SELECT {cell}, coalesce(n::DOUBLE / sum(n) OVER (), 0) AS share FROM (SELECT {cell}, sum(tokens)::BIGINT AS n FROM d GROUP BY ALL))",
    ]
    for m in MARGINS:
        steps += [
            f"s_{m} AS (SELECT {m}, s, g / sum(g) OVER () AS g FROM (SELECT {m}, sum(share) AS s, CASE WHEN sum(share) > 0 THEN pow(sum(share), {power[m]}::DOUBLE) ELSE 0 END AS g FROM c GROUP BY {m}))",
            f"k_{m} AS (SELECT *, coalesce(sum(s) OVER o + s / g * (1 - sum(g) OVER o) < {fraction}, false) AS f FROM s_{m} WINDOW o AS (ORDER BY s / g NULLS LAST, {m} ROWS UNBOUNDED PRECEDING))",
            f"t_{m} AS (SELECT {m}, g AS g_{m}, f AS f_{m}, CASE WHEN f THEN s ELSE least(s, g * ({fraction} - coalesce(sum(CASE WHEN f THEN s END) OVER (), 0)) / sum(CASE WHEN NOT f THEN g END) OVER ()) END AS t_{m} FROM k_{m})",
        ]
    full = " OR ".join(f"f_{m}" for m in MARGINS)
    left = ", ".join(f"greatest(0, t_{m} - coalesce(sum(CASE WHEN whole THEN share END) OVER (PARTITION BY {m}), 0)) AS l_{m}" for m in MARGINS)
    steps += [
        f"j AS (SELECT *, {full} OR share <= 0 AS whole FROM c " + " ".join(f"JOIN t_{m} USING ({m})" for m in MARGINS) + ")",
        f"l AS (SELECT *, {left} FROM j)",
    ]
    step = "(SELECT * FROM r WHERE k < {})".format(rounds)
    for m in MARGINS:
        step = f"(SELECT * EXCLUDE (w, h), CASE WHEN h > 0 THEN w * l_{m} / h ELSE w END AS w FROM (SELECT *, sum(share * greatest({floor}, least(1, w))) OVER (PARTITION BY {m}) AS h FROM {step}))"
    names = f"{cell}, share, {', '.join(f'l_{m}' for m in MARGINS)}"
    steps += [
        f"r AS (SELECT 0 AS k, {names}, {fraction}::DOUBLE AS w FROM l WHERE NOT whole UNION ALL SELECT k + 1, {names}, w FROM {step})",
        f"z AS (SELECT l.*, CASE WHEN whole THEN 1 ELSE greatest({floor}, least(1, w)) END AS p FROM l LEFT JOIN (SELECT {cell}, w FROM r WHERE k = {rounds}) USING ({cell}))",
        "e AS (SELECT max(abs(x)) AS residual, max(abs(y)) AS off_goal FROM (" + " UNION ALL ".join(f"SELECT sum(share * p) - any_value(t_{m}) AS x, sum(share * p) / (SELECT sum(share * p) FROM z) - any_value(g_{m}) AS y FROM z GROUP BY {m}" for m in MARGINS) + "))",
    ]
    draw_sql = f"('0x' || substr(md5(coalesce(i::VARCHAR, '') || ':{seed}'), 1, 12))::BIGINT::DOUBLE / {1 << 48}::DOUBLE"
    return "WITH RECURSIVE " + ",\n".join(steps) + f"\nSELECT i AS doc_id, source, lang, topic, tokens, round(p, 6) AS p, {draw_sql} < p AS kept, round(residual, 6) AS residual, round(off_goal, 6) AS off_goal FROM d JOIN z USING ({cell}), e"
