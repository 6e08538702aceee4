"""Named queries over the driver tables, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.functions import features as X
from fernlight.functions import text as T
from fernlight.functions.lexicon import ACCESS_MARKERS, BEARISH, BULLISH, NEGATIONS, RISK
from fernlight.functions.numbers import compact_count, round6
from fernlight.operators import dedupe, retention, sampling, search, signals, terms, vectors
from fernlight.operators.mapping import spread
from fernlight.sources import adapter, landing, posts, synthetic
from fernlight.sources.adapter import AS_OF, CONTENTS_SQL, EVENTS_SQL, as_of, contents, events, raw_posts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- shared parts


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, raw, content (normalised), normalized_content (for analysis), each once a document."""
    docs = spread(contents(spark, sf_dir).select("doc_id", F.col("content").alias("raw")))
    return docs.withColumn("content", T.normalize_text("raw")).withColumn("normalized_content", T.for_analysis("content"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with signal and weight. Features follow from the text alone: each document's are computed once, and small rows are joined."""
    own = texts(spark, sf_dir).select("doc_id", "normalized_content", T.language_hint("content").alias("language_hint"))
    known = X.with_features(own, "normalized_content").select("doc_id", "polarity", "manipulation_risk", "language_hint")
    return X.with_signal(events(spark, sf_dir).join(known, "doc_id"), as_of())


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _hits_sql(terms: tuple[str, ...], col: str = "low") -> str:
    return "(" + " + ".join(f"contains({col}, {_q(t)})::INT" for t in terms) + ")"


def _list_sql(terms: tuple[str, ...]) -> str:
    return ", ".join(_q(t) for t in dict.fromkeys(terms))


_TOKEN = r"[#@]?[\pL\pN_\x{0900}-\x{097F}%]+"


@cache
def features_sql(col: str = "normalized_content", source: str = "an", name: str = "ft") -> str:
    """CTEs up to `name`: doc_id, b, s, hits, upper, bangs, polarity, risk."""
    return rf"""
{name}0 AS (SELECT doc_id, {col} AS t, lower({col}) AS low, regexp_extract_all(lower({col}), '{_TOKEN}') AS tok FROM {source}),
{name}1 AS (SELECT *, {_hits_sql(BULLISH)} AS b0, {_hits_sql(BEARISH)} AS s0, {_hits_sql(RISK)} AS hits,
  list_filter(list_transform(range(1, len(tok)), lambda i: CASE WHEN tok[i] IN ({_list_sql(NEGATIONS)}) THEN CASE WHEN tok[i + 1] IN ({_list_sql(BULLISH)}) THEN 1 WHEN tok[i + 1] IN ({_list_sql(BEARISH)}) THEN -1 END END), lambda x: x IS NOT NULL) AS flips FROM {name}0),
{name}2 AS (SELECT *, list_reduce(list_transform(flips, lambda x: {{'b': 0, 's': 0, 'x': x}}), lambda a, e: {{'b': CASE WHEN e.x = 1 THEN greatest(a.b - 1, 0) ELSE a.b + 1 END, 's': CASE WHEN e.x = 1 THEN a.s + 1 ELSE greatest(a.s - 1, 0) END, 'x': 0}}, {{'b': b0, 's': s0, 'x': 0}}) AS r FROM {name}1),
{name}3 AS (SELECT *, r.b AS b, r.s AS s, len(regexp_extract_all(t, '\pL')) AS letters, len(regexp_extract_all(t, '\p{{Lu}}')) AS uppers, len(t) - len(replace(t, '!', '')) AS bangs FROM {name}2),
{name}4 AS (SELECT *, CASE WHEN letters > 0 THEN uppers::DOUBLE / letters ELSE 0::DOUBLE END AS upper_ratio FROM {name}3),
{name} AS (SELECT doc_id, t, b, s, hits, upper_ratio, bangs, CASE WHEN b + s > 0 THEN (b - s)::DOUBLE / (b + s) ELSE 0::DOUBLE END AS polarity,
  least(1::DOUBLE, hits * 0.3::DOUBLE + greatest(0::DOUBLE, upper_ratio - 0.45::DOUBLE)) AS risk FROM {name}4)"""


@cache
def scored_sql() -> str:
    return f"""WITH {EVENTS_SQL}, {CONTENTS_SQL}, {features_sql()},
sc0 AS (SELECT ev.*, polarity, risk, 1::DOUBLE - 0.65::DOUBLE * risk AS quality, exp(-greatest(0::DOUBLE, (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(timestamp)) / 3.6e9::DOUBLE) / 12::DOUBLE) AS recency,
  least(3::DOUBLE, 1::DOUBLE + 0.22::DOUBLE * ln(1 + greatest(0, coalesce(engagement_total, 0))::DOUBLE) + 0.08::DOUBLE * ln(1 + greatest(0, coalesce(view_count, 0))::DOUBLE)) AS social FROM ev JOIN ft USING (doc_id)),
sc AS (SELECT *, greatest(-1::DOUBLE, least(1::DOUBLE, polarity * quality)) AS signal, greatest(0.05::DOUBLE, recency * social * quality) AS weight, coalesce(tag, 'other') AS market FROM sc0)"""


def signals_sql(minutes: int, where: str = "true", columns: str = "*") -> str:
    return f"""{scored_sql()},
g0 AS (SELECT date_trunc('hour', timestamp) + to_minutes(((minute(timestamp) // {minutes}) * {minutes})::INT) AS ws, market, username, engagement_total, signal, weight, risk FROM sc WHERE {where}),
g1 AS (SELECT ws, market, count(*) AS n, count(DISTINCT username) AS authors, sum(coalesce(engagement_total, 0))::BIGINT AS eng, count(*) FILTER (signal > 0.05) AS bull, count(*) FILTER (signal < -0.05) AS bear,
  sum(weight) AS w, sum(weight * signal) AS wsig, sum(weight * signal * signal) AS wsq, sum(risk) AS rs FROM g0 GROUP BY ws, market),
g2 AS (SELECT *, wsig / w AS mean, 1.96::DOUBLE * sqrt(greatest(0::DOUBLE, wsq / w - (wsig / w) * (wsig / w)) / greatest(1::DOUBLE, least(n::DOUBLE, w))) AS margin FROM g1),
sg AS (SELECT strftime(ws, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS window_start, market, n AS tweet_count, authors AS unique_authors, eng AS engagement_total, bull AS bullish_count, bear AS bearish_count, n - bull - bear AS neutral_count,
  round(mean, 6) + 0.0 AS composite_signal, round(greatest(-1::DOUBLE, mean - margin), 6) + 0.0 AS ci95_lower, round(least(1::DOUBLE, mean + margin), 6) + 0.0 AS ci95_upper,
  round(least(1::DOUBLE, 0.45::DOUBLE * least(1::DOUBLE, n / 40::DOUBLE) + 0.35::DOUBLE * (authors / greatest(1, n)::DOUBLE) + 0.20::DOUBLE * greatest(0::DOUBLE, 1 - margin)), 6) + 0.0 AS confidence,
  round(rs / n, 6) + 0.0 AS manipulation_risk_mean FROM g2)
SELECT {columns} FROM sg"""


_LANG_SQL = r"""CASE WHEN regexp_matches({0}, '[\x{{0900}}-\x{{097F}}]') AND regexp_matches({0}, '[A-Za-z\x{{0130}}\x{{212A}}]') THEN 'hinglish_or_mixed' WHEN regexp_matches({0}, '[\x{{0900}}-\x{{097F}}]') THEN 'hi_or_indic' WHEN regexp_matches({0}, '[A-Za-z\x{{0130}}\x{{212A}}]') THEN 'en_or_romanized' ELSE 'unknown' END"""


# --- signals


@query(signals_sql(15))
def signals_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.signals(scored(spark, sf_dir), minutes=15)


@query(signals_sql(60))
def signals_60m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.signals(scored(spark, sf_dir), minutes=60)


@query(signals_sql(45))
def signals_45m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that don't divide the hour."""
    return signals.signals(scored(spark, sf_dir), minutes=45)


@query(signals_sql(15, f"timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR"))
def signals_last48h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.signals(retention.recent(scored(spark, sf_dir), as_of(), 48), minutes=15)


@query(f"""{signals_sql(15)} QUALIFY (row_number() OVER (PARTITION BY market ORDER BY window_start) - 1) % greatest(1, count(*) OVER (PARTITION BY market) // 600) = 0""")
def stride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stride_sample(signals_15m(spark, sf_dir))


@query(f"""{signals_sql(15, columns="window_start, market, round(unique_authors / greatest(1, tweet_count)::DOUBLE, 6) AS diversity")}""")
def author_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals_15m(spark, sf_dir).select("window_start", "market", round6(F.col("unique_authors") / F.greatest(F.lit(1), F.col("tweet_count"))).alias("diversity"))


_LANGS = f"""lg AS (SELECT {_LANG_SQL.format("content")} AS language_hint, count(*) AS n FROM ev JOIN an USING (doc_id) GROUP BY 1)"""


@query(f"WITH {EVENTS_SQL}, {CONTENTS_SQL}, {_LANGS} SELECT language_hint, n FROM lg")
def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hints = texts(spark, sf_dir).select("doc_id", T.language_hint("content").alias("language_hint"))
    return signals.language_counts(events(spark, sf_dir).select("doc_id").join(hints, "doc_id"))


@query(
    f"""{signals_sql(15).rsplit("SELECT * FROM sg", 1)[0]}, {_LANGS},
o AS (SELECT sum(tweet_count)::BIGINT AS tweet_count, count(*) AS window_count, sum(composite_signal * tweet_count) / sum(tweet_count) AS x FROM sg)
SELECT tweet_count, window_count, round(x, 6) + 0.0 AS overall_signal, CASE WHEN x > 0.08 THEN 'bullish' WHEN x < -0.08 THEN 'bearish' ELSE 'neutral' END AS overall_label,
  (SELECT string_agg(language_hint || '=' || n, ',' ORDER BY language_hint) FROM lg) AS language_counts FROM o"""
)
def overall_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = signals.run_summary(scored(spark, sf_dir))
    counts = F.array_join(F.transform(F.map_entries("language_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return one.select("tweet_count", "window_count", "overall_signal", "overall_label", counts.alias("language_counts"))


@query(f"""{scored_sql()} SELECT tweet_id, round(signal, 6) + 0.0 AS signal, round(weight, 6) + 0.0 AS weight FROM sc""")
def post_signal_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("tweet_id", round6(F.col("signal")).alias("signal"), round6(F.col("weight")).alias("weight"))


# --- features


@query(f"""WITH {CONTENTS_SQL}, {features_sql()} SELECT doc_id, b AS bullish_hits, s AS bearish_hits, round(polarity, 6) + 0.0 AS polarity, round(risk, 6) + 0.0 AS manipulation_risk, bangs AS exclamation_count FROM ft""")
def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = X.with_features(texts(spark, sf_dir), "normalized_content")
    return out.select("doc_id", "bullish_hits", "bearish_hits", round6(F.col("polarity")).alias("polarity"), round6(F.col("manipulation_risk")).alias("manipulation_risk"), F.col("exclamation_count").cast("long").alias("exclamation_count"))


@query(f"""WITH {CONTENTS_SQL}, rw AS (SELECT doc_id, raw AS normalized_content FROM an), {features_sql("normalized_content", "rw")} SELECT doc_id, round(upper_ratio, 6) + 0.0 AS uppercase_ratio, round(risk, 6) + 0.0 AS manipulation_risk, bangs AS exclamation_count FROM ft""")
def uppercase_ratio_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On texts as they came: capitals raise the risk."""
    out = X.with_features(texts(spark, sf_dir), "raw")
    return out.select("doc_id", round6(F.col("uppercase_ratio")).alias("uppercase_ratio"), round6(F.col("manipulation_risk")).alias("manipulation_risk"), F.col("exclamation_count").cast("long").alias("exclamation_count"))


@query(f"""WITH {CONTENTS_SQL}, {features_sql()} SELECT doc_id, round(risk, 6) + 0.0 AS manipulation_risk FROM ft WHERE risk > 0""")
def manipulation_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = X.with_features(texts(spark, sf_dir), "normalized_content").where("manipulation_risk > 0")
    return out.select("doc_id", round6(F.col("manipulation_risk")).alias("manipulation_risk"))


@query(f"""WITH {CONTENTS_SQL}, {features_sql()}, rr AS (SELECT doc_id, flips, b0, s0, r.b AS b, r.s AS s FROM ft2) SELECT doc_id, len(flips)::INT AS n_flips, b0 AS b_before, s0 AS s_before, b AS b_after, s AS s_after FROM rr WHERE len(flips) > 0""")
def negation_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = texts(spark, sf_dir).select("doc_id", F.col("normalized_content").alias("t")).withColumn("flips", X.flips(T.tokens("t"))).where(F.size("flips") > 0)
    rows = rows.withColumns({"b": X.hits(F.col("t"), BULLISH), "s": X.hits(F.col("t"), BEARISH)}).withColumn("r", X.folded(F.col("b"), F.col("s"), F.col("flips")))
    return rows.select("doc_id", F.size("flips").alias("n_flips"), F.col("b").alias("b_before"), F.col("s").alias("s_before"), F.col("r.b").alias("b_after"), F.col("r.s").alias("s_after"))


@query(f"""WITH {EVENTS_SQL} SELECT coalesce(tag, 'other') AS market, count(*) AS n FROM ev GROUP BY 1""")
def market_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy(X.market(F.col("hashtags"), F.col("query_tag")).alias("market")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {EVENTS_SQL} SELECT tweet_id, strftime(date_trunc('hour', timestamp) + to_minutes(((minute(timestamp) // 45) * 45)::INT), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS window_start FROM ev""")
def window_floor_45m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("tweet_id", X.iso(X.window_start(F.col("timestamp"), 45)).alias("window_start"))


# --- text


@query(f"""WITH {CONTENTS_SQL} SELECT doc_id, sha256(content) AS content_sha, sha256(normalized_content) AS normalized_sha, {_LANG_SQL.format("content")} AS language_hint FROM an""")
def nfkc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.sha2("content", 256).alias("content_sha"), F.sha2("normalized_content", 256).alias("normalized_sha"), T.language_hint("content").alias("language_hint"))


@query(
    rf"""WITH {CONTENTS_SQL}, tg AS (SELECT doc_id, content || ' @User_' || doc_id || ' #Tag' || (doc_id % 7) || ' x@no mail#no #निफ्टी' AS t FROM an)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?:^|[^\pL\pN_])@([A-Za-z0-9_]{{1,15}})', 1), lambda x: lower(x)))), ',') AS mentions,
  array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?:^|[^\pL\pN_])#([\pL\pN_\x{{0900}}-\x{{097F}}]+)', 1), lambda x: lower(x)))), ',') AS hashtags FROM tg"""
)
def mentions_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    tagged = texts(spark, sf_dir).select("doc_id", F.concat("content", F.lit(" @User_"), d.cast("string"), F.lit(" #Tag"), (d % 7).cast("string"), F.lit(" x@no mail#no #निफ्टी")).alias("t"))
    return tagged.select("doc_id", F.array_join(T.mentions("t"), ",").alias("mentions"), F.array_join(T.hashtags("t"), ",").alias("hashtags"))


@query(f"""WITH {EVENTS_SQL} SELECT tweet_id, sha256('id:' || tweet_id) AS fingerprint FROM ev""")
def fingerprint_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("tweet_id", T.fingerprint(F.col("tweet_id"), F.col("username"), F.col("timestamp"), F.lit("")).alias("fingerprint"))


@query(f"""WITH {EVENTS_SQL}, {CONTENTS_SQL} SELECT event_id::VARCHAR AS tweet_id, sha256('fallback:' || lower(username) || '|' || strftime(timestamp, '%Y-%m-%dT%H:%M') || '|' || normalized_content) AS fingerprint FROM ev JOIN an USING (doc_id)""")
def fingerprint_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).join(texts(spark, sf_dir).select("doc_id", "normalized_content"), "doc_id")
    return rows.select("tweet_id", T.fingerprint(F.lit(""), F.col("username"), F.col("timestamp"), F.col("normalized_content")).alias("fingerprint"))


@query(
    r"""WITH v AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN floor(value)::BIGINT || '.01K' WHEN 1 THEN floor(value)::BIGINT || '.5M views' WHEN 2 THEN floor(value)::BIGINT || ' mentions' WHEN 3 THEN floor(value)::BIGINT || ',234 Likes' WHEN 4 THEN '1.2.3' WHEN 5 THEN 'none' WHEN 6 THEN '' ELSE floor(value)::BIGINT::VARCHAR END AS s FROM events),
p AS (SELECT event_id, s, replace(regexp_extract(s, '([0-9,.]+)\s*([KkMm]?)', 1), ',', '') AS d, lower(regexp_extract(s, '([0-9,.]+)\s*([KkMm]?)', 2)) AS u FROM v)
SELECT event_id, CASE WHEN NOT regexp_matches(s, '[0-9,.]') THEN 0 ELSE floor(try_cast(d AS DOUBLE) * CASE u WHEN 'k' THEN 1000 WHEN 'm' THEN 1000000 ELSE 1 END)::BIGINT END AS n FROM p"""
)
def compact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, k = F.col("value"), F.col("event_id") % 8
    whole = F.floor(v).cast("long").cast("string")
    s = F.when(k == 0, F.concat(whole, F.lit(".01K"))).when(k == 1, F.concat(whole, F.lit(".5M views"))).when(k == 2, F.concat(whole, F.lit(" mentions"))).when(k == 3, F.concat(whole, F.lit(",234 Likes"))).when(k == 4, "1.2.3").when(k == 5, "none").when(k == 6, "").otherwise(whole)
    return adapter.read(spark, sf_dir, "events").select("event_id", compact_count(s).alias("n"))


@query(
    f"""WITH {CONTENTS_SQL}, lo AS (SELECT doc_id, lower(content || CASE doc_id % 5 WHEN 0 THEN ' Rate limit exceeded' WHEN 1 THEN ' Verify your identity now' ELSE '' END) AS t FROM an)
SELECT doc_id, {" OR ".join(f"contains(t, {_q(m)})" for m in ACCESS_MARKERS)} AS flagged FROM lo"""
)
def access_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    shown = F.concat("content", F.when(k == 0, " Rate limit exceeded").when(k == 1, " Verify your identity now").otherwise(""))
    return texts(spark, sf_dir).select("doc_id", T.has_marker(shown, ACCESS_MARKERS).alias("flagged"))


@query(
    r"""WITH u AS (SELECT user_id, ['/home', '/i/flow', CASE user_id % 3 WHEN 0 THEN '/@User' || user_id || '/' WHEN 1 THEN '/explore' ELSE 'https://x.test/a/Trader' || user_id END] AS h FROM (SELECT DISTINCT user_id FROM events)),
v AS (SELECT user_id, list_filter(list_transform(h, lambda x: string_split(regexp_replace(x, '/+$', ''), '/')[-1]), lambda p: p <> '' AND p NOT IN ('home', 'explore', 'search') AND NOT starts_with(p, 'i')) AS g FROM u)
SELECT user_id, coalesce(lower(regexp_replace(g[1], '^@+', '')), 'unknown') AS username FROM v"""
)
def username_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, n = F.col("user_id"), F.col("user_id").cast("string")
    third = F.when(u % 3 == 0, F.concat(F.lit("/@User"), n, F.lit("/"))).when(u % 3 == 1, "/explore").otherwise(F.concat(F.lit("https://x.test/a/Trader"), n))
    users = adapter.read(spark, sf_dir, "events").select("user_id").distinct()
    return users.select("user_id", T.username_of(F.array(F.lit("/home"), F.lit("/i/flow"), third)).alias("username"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_id::VARCHAR END AS status_id FROM events""")
def status_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id").cast("string")
    href = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("https://x.test/u/photo/"), n)).otherwise(F.concat(F.lit("https://x.test/u/status/"), n, F.lit("/photo/1")))
    return adapter.read(spark, sf_dir, "events").select("event_id", T.status_id(href).alias("status_id"))


@query("""SELECT DISTINCT '(#' || event_type || ' OR x) since:' || strftime(ts - INTERVAL 24 HOUR, '%Y-%m-%d') || ' -filter:retweets' AS q FROM events""")
def search_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = adapter.read(spark, sf_dir, "events")
    q = F.concat(F.lit("(#"), F.col("event_type"), F.lit(" OR x)"))
    return e.select(T.search_text(q, F.col("ts") - F.expr("interval 24 hours")).alias("q")).distinct()


@query(
    rf"""WITH {CONTENTS_SQL} SELECT doc_id FROM an WHERE (regexp_matches(normalized_content, '(?:^|[^\pL\pN_\x{{0900}}-\x{{097F}}])not\s+buy(?:$|[^\pL\pN_\x{{0900}}-\x{{097F}}])') OR regexp_matches(normalized_content, '(?:^|[^\pL\pN_\x{{0900}}-\x{{097F}}])guaranteed(?:$|[^\pL\pN_\x{{0900}}-\x{{097F}}])'))
AND NOT regexp_matches(normalized_content, '(?:^|[^\pL\pN_\x{{0900}}-\x{{097F}}])never(?:$|[^\pL\pN_\x{{0900}}-\x{{097F}}])')"""
)
def search_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored query run again over stored posts."""
    rows = texts(spark, sf_dir)
    return rows.where(search.compile_query('("not buy" OR guaranteed) -never', F.col("normalized_content"))).select("doc_id")


@query("""SELECT DISTINCT replace(replace('#' || event_type || ' OR a/b', '#', '%23'), ' ', '%20') AS encoded FROM events""")
def url_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = adapter.read(spark, sf_dir, "events").select("event_type").distinct()
    return e.select(T.percent_encoded(F.concat(F.lit("#"), F.col("event_type"), F.lit(" OR a/b"))).alias("encoded"))


@query("""SELECT DISTINCT '/Data/' || event_type || '/Posts' AS path, substr(sha256(lower('/Data/' || event_type || '/Posts')), 1, 16) AS suffix FROM events""")
def path_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = adapter.read(spark, sf_dir, "events").select(F.concat(F.lit("/Data/"), F.col("event_type"), F.lit("/Posts")).alias("path")).distinct()
    return paths.select("path", T.short_hash("path").alias("suffix"))


@query(rf"""WITH {CONTENTS_SQL}, tk AS (SELECT doc_id, regexp_extract_all(normalized_content, '[\pL\pN_]{{2,}}') AS w FROM an),
gr AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM tk),
bk AS (SELECT doc_id, (('0x' || substr(md5(g), 1, 8))::BIGINT % 16384)::INT AS bucket, count(*) AS n FROM gr GROUP BY 1, 2)
SELECT doc_id, bucket, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)::DOUBLE), 6) AS weight FROM bk""")
def hashed_ngrams_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.hashed_ngrams(texts(spark, sf_dir), id_col="doc_id")


def murmur3_sql(text: str) -> str:
    """Signed MurmurHash3 (seed 0) of a text in DuckDB, as |h|."""
    mask, turn = "4294967295::UBIGINT", "((({0})::UBIGINT << {1}) | (({0})::UBIGINT >> {2})) & 4294967295::UBIGINT"
    times = lambda x, c: f"((({x}) * {c}::UBIGINT) & {mask})"
    mixed = lambda k: times("(" + turn.format(times(k, 0xCC9E2D51), 15, 17) + ")", 0x1B873593)
    word = lambda p: "(('0x' || substr(x, {0} + 6, 2) || substr(x, {0} + 4, 2) || substr(x, {0} + 2, 2) || substr(x, {0}, 2))::UBIGINT)".format(p)
    step = f"((({turn.format(f'xor(a, {mixed("k")})', 13, 19)}) * 5::UBIGINT + {0xE6546B64}::UBIGINT) & {mask})"
    body = f"list_reduce(list_transform(range(0, n // 4), lambda i: {word('8 * i + 1')}), lambda a, k: {step}, 0::UBIGINT)"
    tail = f"xor(xor(b, CASE WHEN n % 4 > 0 THEN {mixed('tail')} ELSE 0::UBIGINT END), n::UBIGINT)"
    final = "h0"
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        final = times(f"xor({final}, ({final}) >> {shift})", factor)
    last = word("8 * (n // 4) + 1").replace("x,", "rpad(x, (2 * n + 8)::INT, '0'),")
    return rf"""
m0 AS (SELECT g, hex(encode(g)) AS x, strlen(g) AS n FROM (SELECT DISTINCT {text} AS g FROM gr)),
m1 AS (SELECT g, n, {body} AS b, {last} & ((1::UBIGINT << ((n % 4) * 8)::INT) - 1) AS tail FROM m0),
m2 AS (SELECT g, {tail} AS h0 FROM m1),
m3 AS (SELECT g, {final} AS h1 FROM m2),
mm AS (SELECT g, abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) AS h FROM (SELECT g, xor(h1, h1 >> 16)::BIGINT AS h FROM m3))"""


@query(rf"""WITH {CONTENTS_SQL}, tk AS (SELECT doc_id, regexp_extract_all(normalized_content, '[\pL\pN_]{{2,}}') AS w FROM an),
gr AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM tk),{murmur3_sql("g")},
bk AS (SELECT doc_id, (h % 16384)::INT AS bucket, count(*) AS n FROM gr JOIN mm USING (g) GROUP BY 1, 2)
SELECT doc_id, bucket, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)::DOUBLE), 6) AS weight FROM bk""")
def hashed_vectors_murmur3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.murmur3_features(texts(spark, sf_dir), id_col="doc_id")


@query("SELECT count(*) AS \"rows\", ceil(count(*) / 1000.0)::BIGINT AS batches, 16384 AS features FROM documents")
def vector_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_metadata(vectors.hashed_vectors(texts(spark, sf_dir), id_col="doc_id"), 1 << 14)


@query(
    r"""WITH t AS (SELECT doc_id, lower(coalesce(text, '')) AS t, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN_\x{0900}-\x{097F}]+') AS w FROM documents),
q AS (SELECT doc_id AS query_id, w[1] AS a, w[2] AS b, w[3] AS c, w[4] AS d, w[5] AS e FROM t WHERE len(w) >= 5 AND doc_id % 50 = 0),
k AS (SELECT DISTINCT doc_id, unnest(w) AS word FROM t),
p AS (SELECT DISTINCT k.doc_id, q.query_id FROM q JOIN k ON k.word = q.a JOIN t ON t.doc_id = k.doc_id
  WHERE regexp_matches(t.t, '(^|[^\pL\pN_\x{0900}-\x{097F}])' || a || '\s+' || b || '($|[^\pL\pN_\x{0900}-\x{097F}])') OR (list_contains(t.w, c) AND list_contains(t.w, d) AND NOT list_contains(t.w, e))
  UNION SELECT k.doc_id, q.query_id FROM q JOIN k ON k.word = q.c JOIN t ON t.doc_id = k.doc_id WHERE list_contains(t.w, d) AND NOT list_contains(t.w, e))
SELECT query_id, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM p GROUP BY query_id"""
)
def search_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five words of each document whose id is divisible by 50 as a stored query, `"a b" OR (c d -e)`: all queries against all documents in one pass."""
    docs = spread(adapter.read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    w = F.regexp_extract_all(F.lower("text"), F.lit(search.WORDS), F.lit(0))
    asked = docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("own"), w.alias("w")).where("size(w) >= 5")
    asked = asked.select("own", F.format_string('"%s %s" OR (%s %s -%s)', *[F.get("w", F.lit(k)) for k in range(5)]).alias("query"))
    asked = asked.groupBy("query").agg(F.min("own").alias("query_id"), F.collect_list("own").alias("own")).persist()  # equal queries are one
    found = search.match_many(docs, search.stored_queries(asked).persist(), id_col="doc_id", text_col="text")
    counts = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))
    return counts.join(asked, "query_id").select(F.explode("own").alias("query_id"), "n", "ids")


@query(
    """WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]{4,}')) AS term FROM benchmark),
d AS (SELECT doc_id, lower(coalesce(text, '')) AS low FROM documents)
SELECT doc_id, coalesce(sum(1) FILTER (contains(low, term)), 0)::BIGINT AS terms, coalesce(sum(len(term)) FILTER (contains(low, term)), 0)::BIGINT AS letters FROM d, t GROUP BY doc_id"""
)
def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the benchmark as a lexicon of two lists: which of them occur in each document, anywhere."""
    words = adapter.read(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]{4,}"), F.lit(0))).alias("term")).distinct()
    lexicon = words.select("term", F.explode(F.map_from_arrays(F.array(F.lit("terms"), F.lit("letters")), F.array(F.lit(1), F.char_length("term")))).alias("list", "weight"))
    docs = spread(adapter.read(spark, sf_dir, "documents").select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("low")))
    return terms.term_hits(docs, lexicon, text_col="low").drop("low")


# --- scans, dedupe, runs


@query(f"""WITH {EVENTS_SQL} SELECT tweet_id FROM ev WHERE timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR AND tweet_id <> ''""")
def id_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.post_ids(events(spark, sf_dir), cutoff=as_of() - F.expr("interval 72 hours"))


@query("SELECT count(*) AS n FROM events")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the files' footers."""
    return posts.count_rows(spark, f"{sf_dir}/events.parquet")


@query(f"""WITH {EVENTS_SQL} SELECT count(DISTINCT tweet_id) AS existing_unique FROM ev WHERE timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR""")
def rolling_cutoff_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.recent_count(events(spark, sf_dir), as_of(), 48)


@query(f"""WITH {EVENTS_SQL} SELECT strftime(min(timestamp), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS period_start, strftime(max(timestamp), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS period_end FROM ev""")
def period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.period(events(spark, sf_dir)).select(X.iso(F.col("period_start")).alias("period_start"), X.iso(F.col("period_end")).alias("period_end"))


@query(f"""WITH {EVENTS_SQL} SELECT strftime(timestamp, '%Y-%m-%d') AS event_date, strftime(timestamp, '%H') AS event_hour, count(*) AS n, sum(engagement_total)::BIGINT AS engagement_total FROM ev GROUP BY 1, 2""")
def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("engagement_total", posts.engagement())
    return e.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("event_date"), F.date_format("timestamp", "HH").alias("event_hour")).agg(F.count(F.lit(1)).alias("n"), F.sum("engagement_total").alias("engagement_total"))


@query(f"""WITH {CONTENTS_SQL} SELECT min(doc_id) AS doc_id, sha256(normalized_content) AS fingerprint FROM an GROUP BY 2""")
def dedupe_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = texts(spark, sf_dir).select("doc_id", F.sha2("normalized_content", 256).alias("fingerprint"))
    return dedupe.first_wins(rows, ["fingerprint"], [F.col("doc_id")])


@query(f"""WITH {EVENTS_SQL} SELECT tweet_id FROM ev WHERE event_id % 3 <> 0 AND event_id % 5 <> 0""")
def dedupe_anti_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State knows every third id by fingerprint and every fifth by id under another fingerprint."""
    rows = events(spark, sf_dir).select("tweet_id", T.fingerprint(F.col("tweet_id"), F.col("username"), F.col("timestamp"), F.lit("")).alias("fingerprint"))
    n = F.col("tweet_id").cast("long")
    seen = rows.where(n % 3 == 0).select("fingerprint", F.lit("").alias("tweet_id")).unionByName(rows.where(n % 5 == 0).select(F.concat(F.lit("other:"), F.col("fingerprint")).alias("fingerprint"), "tweet_id"))
    return dedupe.new_only(rows, seen).select("tweet_id")


@query("""WITH i AS (SELECT DISTINCT trim(CASE user_id % 4 WHEN 0 THEN ' ' || user_id || ' ' WHEN 1 THEN '' ELSE user_id::VARCHAR END) AS tweet_id FROM events) SELECT sha256('id:' || tweet_id) AS fingerprint, tweet_id FROM i WHERE tweet_id <> ''""")
def state_seeding(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id").cast("string")
    k = F.col("user_id") % 4
    ids = adapter.read(spark, sf_dir, "events").select(F.when(k == 0, F.concat(F.lit(" "), u, F.lit(" "))).when(k == 1, "").otherwise(u).alias("tweet_id"))
    return dedupe.seeds(ids)


@query(f"""WITH {EVENTS_SQL} SELECT tweet_id FROM ev WHERE timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 480 HOUR ORDER BY timestamp, event_id LIMIT 777""")
def collected_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit is what a run is asked for."""
    rows = retention.recent(events(spark, sf_dir), as_of(), 480)
    return retention.take_first(rows, 777, [F.col("timestamp"), F.col("tweet_id").cast("long")]).select("tweet_id")


@query(
    f"""WITH {EVENTS_SQL}, x AS (SELECT count(DISTINCT tweet_id) AS e FROM ev WHERE timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR), f AS (SELECT count(*) AS n, count(DISTINCT username) AS u FROM ev WHERE timestamp < TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR)
SELECT 5000 AS requested_total, e AS existing_unique, least(u, greatest(5000 - e, 0)) AS accepted_this_run, n - u AS duplicates_this_run, e + least(u, greatest(5000 - e, 0)) AS total_unique, greatest(5000 - e - least(u, greatest(5000 - e, 0)), 0) AS remaining, e + least(u, greatest(5000 - e, 0)) >= 5000 AS target_met FROM x, f"""
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of a run whose candidates are keyed by author."""
    e = events(spark, sf_dir)
    target = F.lit(5000)
    old = e.where(F.col("timestamp") < as_of() - F.expr("interval 48 hours")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("username").alias("u"))
    one = retention.recent_count(e, as_of(), 48).crossJoin(F.broadcast(old))  # one row each
    one = one.withColumn("accepted_this_run", F.least("u", F.greatest(target - F.col("existing_unique"), F.lit(0)))).withColumn("total_unique", F.col("existing_unique") + F.col("accepted_this_run"))
    return one.select(target.alias("requested_total"), "existing_unique", "accepted_this_run", (F.col("n") - F.col("u")).alias("duplicates_this_run"), "total_unique", F.greatest(target - F.col("total_unique"), F.lit(0)).alias("remaining"), (F.col("total_unique") >= target).alias("target_met"))


@query(f"""WITH {EVENTS_SQL}, {CONTENTS_SQL} SELECT tweet_id, username, sha256(content) AS content_sha, sha256(normalized_content) AS normalized_sha, {_LANG_SQL.format("content")} AS language_hint, engagement_total, coalesce(tag, '') AS hashtags, sha256('id:' || tweet_id) AS fingerprint, strftime(timestamp, '%Y-%m-%d') AS event_date, strftime(timestamp, '%H') AS event_hour FROM ev JOIN an USING (doc_id)""")
def clean_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored columns of all posts, long ones as digests."""
    p = posts.clean(raw_posts(spark, sf_dir))
    return p.select("tweet_id", "username", F.sha2("content", 256).alias("content_sha"), F.sha2("normalized_content", 256).alias("normalized_sha"), "language_hint", "engagement_total", F.array_join("hashtags", ",").alias("hashtags"), "fingerprint", "event_date", "event_hour")


@query(
    """WITH a AS (SELECT page_id, page_id % 4 AS k FROM pages)
SELECT page_id::VARCHAR AS tweet_id, 'trader' || page_id AS username, 'Page ' || page_id || ' says #Nifty50 up @Desk' AS content, (2500 + page_id * 0)::BIGINT AS reply_count, page_id AS like_count, 'desk' AS mentions, 'nifty50' AS hashtags FROM a WHERE k <> 3 AND k <> 2"""
)
def article_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed post elements; one in four has no status id and one in four a number that can't be read."""
    n, k = F.col("page_id").cast("string"), F.col("page_id") % 4
    kind = F.when(k == 3, "photo").otherwise("status")
    reply = F.when(k == 2, "1.2.3 Replies").otherwise("2.5K Replies")
    html = F.format_string(
        '<article data-testid="tweet"><div data-testid="User-Name"><a href="/iris">i</a><a href="/@Trader%s">T</a></div><a href="https://x.test/u/%s/%s"><time datetime="2024-01-30T10:00:00Z">1h</time></a>'
        '<div data-testid="tweetText">Page %s <b>says</b> #Nifty50 up @Desk</div><button data-testid="reply" aria-label="%s"></button><button data-testid="like">%s</button></article>',
        n, kind, n, n, reply, n,
    )
    pages = adapter.read(spark, sf_dir, "pages").select(html.alias("html"))
    out = landing.parse_articles(landing.split_articles(pages), F.lit("q"), as_of())
    return out.select("tweet_id", "username", "content", "reply_count", "like_count", F.array_join("mentions", ",").alias("mentions"), F.array_join("hashtags", ",").alias("hashtags"))


@query(
    r"""WITH c AS (SELECT page_id, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(<(script|style)[^>]*>).*?</(script|style)>', '\1', 'gs') AS h FROM pages),
l AS (SELECT page_id, regexp_extract_all(h, '<a [^>]*?href="([^"]*)"', 1) AS links, len(regexp_extract_all(h, '<[a-zA-Z]')) AS n FROM c)
SELECT page_id, len(links)::INT AS n_links, sha256(array_to_string(links, chr(10))) AS links_sha256, n::INT AS n_elements FROM l"""
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a tree: its elements, and the targets of its links in page order."""
    out = landing.outlines(spread(adapter.read(spark, sf_dir, "pages").select("page_id", "html")))
    return out.select("page_id", F.size("links").alias("n_links"), F.sha2(F.array_join("links", "\n"), 256).alias("links_sha256"), "n_elements")


@query()
def page_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, first heading and depth of every page."""
    out = landing.outlines(spread(adapter.read(spark, sf_dir, "pages").select("page_id", "html")))
    return out.select("page_id", "title", F.sha2("heading", 256).alias("heading_sha256"), "depth")


@query()
def synthetic_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A synthetic post for each event, whose number is its seed."""
    ids = adapter.read(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    p = posts.clean(synthetic.posts_of(ids, 42, as_of()))
    return p.groupBy("hashtags", "language_hint").agg(F.count(F.lit(1)).alias("n"))
