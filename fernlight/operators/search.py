"""The search-query mini-language, compiled to a Column for matching stored posts again.

Words next to each other must all match, OR joins alternatives, parentheses group, quotes make a
phrase, #word a hashtag and @word a mention; -x excludes. Case doesn't count. A word matches whole words; `since:`
bounds the date and `-filter:retweets` is ignored, as stored posts hold no reposts.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernlight.functions.text import DEVANAGARI, WORD

_PART = re.compile(r'-?"[^"]*"|\(|\)|[^\s()]+')
_EDGE = f"[{WORD}{DEVANAGARI}]"

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Words of a text, for the index of stored queries.
WORDS = f"{_EDGE}+"


def _tree(query: str) -> tuple:
    """The query as a tree of ("and" or "or", parts), ("not", part), ("term", text), ("since", time) and ("true",)."""
    parts = _PART.findall(query)
    at = 0

    def term(part: str) -> tuple:
        if part.startswith("-") and len(part) > 1:
            return ("true",) if part.startswith("-filter:") else ("not", term(part[1:]))
        if part.startswith("since:"):
            return ("since", part[6:])
        word = " ".join(part.strip('"').lower().split())
        return ("term", word) if word else ("true",)

    def any_of() -> tuple:
        nonlocal at
        out = [all_of()]
        while at < len(parts) and parts[at] == "OR":
            at += 1
            out.append(all_of())
        return out[0] if len(out) == 1 else ("or", out)

    def all_of() -> tuple:
        nonlocal at
        out = []
        while at < len(parts) and parts[at] not in (")", "OR"):
            if parts[at] == "(":
                at += 1
                out.append(any_of())
                if at >= len(parts):
                    raise ValueError("a parenthesis is not closed")
            else:
                out.append(term(parts[at]))
            at += 1
        if not out:
            raise ValueError("a term is missing")
        return out[0] if len(out) == 1 else ("and", out)

    found = any_of()
    if at < len(parts):
        raise ValueError("a parenthesis is not opened")
    return found


def _pattern(word: str) -> str:
    before = "" if word[:1] in "#@" else f"(?<!{_EDGE})"
    inner = r"\s+".join("\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E" for w in word.split())
    return f"{before}{inner}(?!{_EDGE})"


def compile_query(query: str, text: Column, timestamp: Column | None = None) -> Column:
    """A boolean Column of whether lower-cased text matches. Without a timestamp, `since:` is a word like others."""

    def column(tree: tuple) -> Column:
        kind = tree[0]
        if kind == "term" or (kind == "since" and timestamp is None):
            return text.rlike(_pattern(tree[1] if kind == "term" else f"since:{tree[1].lower()}"))
        if kind == "since":
            return timestamp >= F.lit(tree[1]).cast("timestamp")
        if kind == "not":
            return ~column(tree[1])
        if kind == "true":
            return F.lit(True)
        return reduce(lambda a, b: a & b if kind == "and" else a | b, map(column, tree[1]))

    return column(_tree(query))


# --- many stored queries at once


def _words(tree: tuple) -> set[str]:
    kind = tree[0]
    if kind == "term":
        return {tree[1]}
    if kind == "not":
        return _words(tree[1])
    return set().union(*map(_words, tree[1])) if kind in ("and", "or") else set()


def _keys(tree: tuple) -> set[str] | None:
    """Terms of which each text that matches holds one; the fewest, then the longest. None: a text without any term may match."""
    kind = tree[0]
    if kind == "term":
        return {tree[1]}
    if kind == "or":
        own = [_keys(t) for t in tree[1]]
        return None if None in own else set().union(*own)
    if kind == "and":
        own = [k for t in tree[1] if (k := _keys(t)) is not None]
        return min(own, key=lambda k: (len(k), -min(map(len, k)), sorted(k)), default=None)
    return None


def stored_queries(queries: DataFrame, id_col: str = "query_id", query_col: str = "query") -> DataFrame:
    """query_id, tree (JSON), terms, keys and error of each query. keys is null where a text without any of the terms may match, and where the query can't be read."""

    @F.arrow_udf("struct<tree:string,terms:array<string>,keys:array<string>,error:string>")
    def read(column: pa.Array) -> pa.Array:
        out = []
        for query in column.to_pylist():
            try:
                tree = _tree(query or "")
                keys = _keys(tree)
                out.append({"tree": json.dumps(tree), "terms": sorted(_words(tree)), "keys": None if keys is None else sorted(keys), "error": None})
            except ValueError as e:
                out.append({"tree": None, "terms": [], "keys": None, "error": str(e)})
        text = pa.string()
        return pa.array(out, pa.struct([("tree", text), ("terms", pa.list_(text)), ("keys", pa.list_(text)), ("error", text)]))

    return queries.select(F.col(id_col).alias("query_id"), read(F.col(query_col)).alias("r")).select("query_id", "r.*")


def _holds(tree: tuple, held: Callable[[str], np.ndarray], since: Callable[[str], np.ndarray]) -> np.ndarray:
    """Which posts of a group a tree is true for."""
    kind = tree[0]
    if kind == "term":
        return held(tree[1])
    if kind == "since":
        return since(tree[1])
    if kind == "not":
        return ~_holds(tree[1], held, since)
    if kind == "true":
        return ~held("")  # no term is empty
    return reduce(np.logical_and if kind == "and" else np.logical_or, (_holds(t, held, since) for t in tree[1]))


def _pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs (i, query_id) that match, of a group's queries (tree, query_id) and terms held by its posts (i, at, term)."""
    asked, hits = rows.filter(rows["tree"].is_valid()), rows.filter(rows["tree"].is_null())
    if not len(asked) or not len(hits):
        return
    posts, terms = (hits[c].combine_chunks().dictionary_encode() for c in ("i", "term"))
    post, term = (x.indices.to_numpy() for x in (posts, terms))
    n, places = len(posts.dictionary), {t: k for k, t in enumerate(terms.dictionary.to_pylist())}
    by_term = post[np.argsort(term, kind="stable")]
    ends = np.cumsum(np.bincount(term, minlength=len(places)))
    at = np.full(n, np.iinfo(np.int64).max)
    at[post] = hits["at"].fill_null(np.iinfo(np.int64).max).to_numpy()
    timed = at.min() < np.iinfo(np.int64).max

    def held(word: str) -> np.ndarray:
        out = np.zeros(n, bool)
        if (k := places.get(word)) is not None:
            out[by_term[ends[k - 1] if k else 0 : ends[k]]] = True
        return out

    def since(day: str) -> np.ndarray:
        return at >= datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp() * 1e6 if timed else np.ones(n, bool)

    ids, made, sizes = asked["query_id"].combine_chunks(), [], []

    def told(first: int) -> pa.RecordBatch:
        whose = np.repeat(np.arange(first, first + len(sizes)), sizes)
        return pa.RecordBatch.from_arrays([posts.dictionary.take(pa.array(np.concatenate(made))), ids.take(pa.array(whose))], ["i", "query_id"])

    first, total = 0, 0
    for k, tree in enumerate(asked["tree"].to_pylist()):
        found = np.flatnonzero(_holds(json.loads(tree), held, since))
        made.append(found)
        sizes.append(len(found))
        total += len(found)
        if total > 1 << 18 or k == len(asked) - 1:
            yield told(first)
            first, total = k + 1, 0
            made.clear()
            sizes.clear()


def _try_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads rows in order of groups g."""
    key, rows = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column(0).to_numpy()
        edge = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
        for s, e in zip(edge[:-1], edge[1:], strict=True):
            if rows and g[s] != key:
                yield from _pairs(pa.Table.from_batches(rows))
                rows = []
            key = g[s]
            rows.append(batch.slice(s, e - s))
    if rows:
        yield from _pairs(pa.Table.from_batches(rows))


#: Posts and stored queries of a group, about, and stored queries whose terms are broadcast at most; more are joined by a shuffle.
GROUP_POSTS, GROUP_QUERIES, FEW_QUERIES = 1 << 13, 1 << 13, 200_000


def match_many(posts: DataFrame, stored: DataFrame, *, id_col: str, text_col: str, timestamp_col: str | None = None, group_posts: int = GROUP_POSTS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """id and query_id of every post and stored query that match, in one pass over the posts, as compile_query would say one by one.

    An inverted index leads from words, and from pairs of words with white space between, to terms: a post's distinct words
    and pairs are joined to it. Terms of one or two words are found so; longer ones, and those with other characters, are
    verified in the text. Posts and queries are dealt in groups, and a task evaluates each query for all posts of its
    group at once, by the sets of posts that hold its terms. Queries without keys are left out: they match most posts, and
    compile_query suits them. Ids must be unique and not null. Null texts match nothing. Without a timestamp column,
    `since:` is true. `stored` is read several times, so it had better be persisted.
    """
    known = stored.where("keys is not null")
    asked, parts = known.count(), max(1, -(-posts.count() // group_posts))
    blocks = max(1, -(-asked // group_queries))
    known = known.withColumn("z", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    few = (lambda df: F.broadcast(df)) if asked <= FEW_QUERIES else (lambda df: df)
    own = known.select(F.explode("terms").alias("term"), "z").distinct()
    runs = F.regexp_extract_all("term", F.lit(WORDS), F.lit(0))
    # a term is found by its first two words, or by its longest word, which is a whole word of the text; what has no word is looked for everywhere
    longest = F.try_element_at(F.array_sort(runs, lambda a, b: F.char_length(a) - F.char_length(b)), F.lit(-1))
    term = own.select("term", F.when(F.rlike("term", F.lit(f"^{WORDS}( {WORDS})+$")), F.substring_index("term", " ", 2)).otherwise(longest).alias("gram"), "z")
    low = posts.select(F.col(id_col).alias("i"), F.lower(text_col).alias("t"), (F.lit(None) if timestamp_col is None else F.unix_micros(timestamp_col)).cast("long").alias("at")).where("i is not null")
    # of each word, the next one if only white space is between them, else an empty text
    word, following = (F.regexp_extract_all("t", F.lit(f"{_EDGE}++(?:(?=\\s+({_EDGE}++))|)"), F.lit(k)) for k in (0, 1))
    pairs = F.zip_with("w", "v", lambda a, b: F.when(b != "", F.concat(a, F.lit(" "), b)))
    grams = low.select("i", "at", word.alias("w"), following.alias("v")).select("i", "at", F.explode(F.array_distinct(F.concat("w", pairs))).alias("gram"))
    index = term.where("gram is not null").groupBy("gram").agg(F.collect_list(F.struct("term", "z")).alias("terms"))
    found = grams.join(few(index), "gram").select("i", "at", "gram", F.explode("terms").alias("x")).select("i", "at", "gram", "x.*")
    hits = found.where(F.col("term") == F.col("gram")).select("i", "at", "term", "z")
    if not term.where("gram is null or gram <> term").isEmpty():
        pattern = F.concat(F.when(F.substring("term", 1, 1).isin("#", "@"), "").otherwise(f"(?<!{_EDGE})"), F.array_join(F.transform(F.split("term", " "), lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))), "\\s+"), F.lit(f"(?!{_EDGE})"))
        odd = term.where("gram is null").agg(F.collect_set("term").alias("odd")).where("size(odd) > 0")
        to_try = found.where(F.col("term") != F.col("gram")).select("i", "term").groupBy("i").agg(F.collect_set("term").alias("tried"))
        both = low.join(to_try, "i", "left").join(F.broadcast(odd), F.lit(True), "left")  # one row of terms without a word, mostly none
        held = both.select("i", "at", "t", F.explode(F.concat(F.coalesce("tried", F.array().cast("array<string>")), F.coalesce("odd", F.array().cast("array<string>")))).alias("term"))
        hits = hits.unionByName(held.where(F.rlike("t", pattern)).select("i", "at", "term").join(few(own), "term"))
    group = lambda d: (F.col(d) * blocks + F.col("z")).alias("g")
    nothing = lambda like: F.lit(None).cast(like)
    id_type, query_type = posts.schema[id_col].dataType, stored.schema["query_id"].dataType
    told = hits.withColumn("d", F.pmod(F.xxhash64("i"), F.lit(parts))).select(group("d"), nothing("string").alias("tree"), nothing(query_type).alias("query_id"), "i", "at", "term")
    trees = known.withColumn("d", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    trees = trees.select(group("d"), "tree", "query_id", nothing(id_type).alias("i"), nothing("long").alias("at"), nothing("string").alias("term"))
    schema = T.StructType([T.StructField("i", id_type), T.StructField("query_id", query_type)])
    return told.unionByName(trees).repartition("g").sortWithinPartitions("g").mapInArrow(_try_groups, schema).select(F.col("i").alias(id_col), "query_id")
