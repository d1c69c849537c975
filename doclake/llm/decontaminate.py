"""Benchmark passages in a corpus, found through a distributed positional inverted index. Built-in functions only.

Each benchmark window of ``window`` words is searched from its rarest terms. A pass over the corpus counts the benchmark's
terms; a second writes the index: the postings ``(term, document, position)`` of the terms that are the rarest ones of some
window, ordered by term. Shifted by the term's place in the benchmark item, two postings of one occurrence name the same
offset between item and document; the lists of a window's terms are intersected on it, shortest first. Each offset that is
left is then read in the document itself, word by word, which gives every exact window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from doclake.llm.common import stored

# Words are what is left between ASCII signs other than letters and digits.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BROADCAST_WORDS = 1_000_000


def _fold(word: Column) -> Column:
    """A-Z in lower case; the quick way for words of ASCII alone."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def _raw_words(text: Column) -> Column:
    """Words as they stand, with an empty one before and after where the text does not begin or end in a word."""
    return F.split(F.coalesce(text, F.lit("")), _BETWEEN)


def _word_count(raw: Column) -> Column:
    ends = (F.element_at(raw, 1) == "").cast("int") + (F.element_at(raw, -1) == "").cast("int")
    return F.greatest(F.size(raw) - ends, F.lit(0)).cast("long")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``(key, item, words)`` of rows with a word; the item is its id as text, empty for a null one, the key a hash of both."""
    words = F.transform(F.filter(_raw_words(F.col("text")), lambda w: w != ""), _fold)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("words"))
    return items.filter(F.size("words") > 0).distinct().select(F.xxhash64("item", "words").alias("key"), "item", "words")


def _keyed(docs: DataFrame) -> DataFrame:
    """A document is known by its id and a hash of its text, so rows that share an id are told apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def postings(docs: DataFrame, terms: DataFrame, small: bool) -> DataFrame:
    """``(term, doc_id, mark, pos)``: every place of the terms in the documents; ``small``: terms may be broadcast."""
    each = _keyed(docs).select("doc_id", "mark", F.posexplode(_raw_words(F.col("text"))).alias("pos", "word"))
    each = each.select(_fold(F.col("word")).alias("term"), "doc_id", "mark", "pos")
    return each.join(F.broadcast(terms) if small else terms, "term", "left_semi")


def search_plan(items: DataFrame, frequency: DataFrame, window: int, lists: int) -> DataFrame:
    """``(key, rarest, probe)``: for each window of an item the places of its ``lists`` rarest terms.

    Windows of an item with the same rarest places share one probe. Terms that the corpus lacks come first: such a window
    has an empty list and cannot occur, so it is left out. A row holds one window, so the plan is as long as the items are.
    """
    placed = items.select("key", F.posexplode("words").alias("place", "term")).join(frequency, "term", "left")
    ranked = placed.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("places")
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("places") - window, F.lit(0)) + 1)
    slices = ranked.select("key", F.explode(F.transform(starts, lambda i: F.slice("places", i, window))).alias("slice"))
    by_rarity = F.transform("slice", lambda p: F.struct(p["n"].alias("n"), p["place"].alias("place"), p["term"].alias("term")))
    rarest = slices.select("key", F.slice(F.sort_array(by_rarity), 1, lists).alias("rarest"))
    rarest = rarest.filter(F.col("rarest")[0]["n"] > 0).distinct()
    return rarest.withColumn("probe", F.xxhash64("key", "rarest"))


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = 13, lists: int = 2) -> DataFrame:
    """``(doc_id, mark, found)``: for each document with candidates, ``array<struct<item, words, shifts>>``.

    ``shifts`` are the places in the document's raw words that the item's first word has there; words are put to them last,
    once for each item and document. Every document that holds
    a window exactly is among them; which windows it holds is read from its text by :func:`contamination`.
    """
    size = items.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    small = size <= _BROADCAST_WORDS
    terms = items.select(F.explode("words").alias("term")).distinct()
    frequency = stored(postings(docs, terms, small).groupBy("term").agg(F.count("*").alias("n")), "terms")
    plan = stored(search_plan(items, frequency, window, lists), "search")
    lookups = plan.select("key", "probe", F.size("rarest").alias("needed"), F.posexplode("rarest").alias("rank", "at"))
    lookups = lookups.select("key", "probe", "needed", "rank", F.col("at.place").alias("place"), F.col("at.term").alias("term"))
    rare = lookups.select("term").distinct()
    index = stored(postings(docs, rare, small), "postings")
    index = stored(index.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id", "pos"), "index")
    near = lookups.select("term", "probe", "needed", "rank", "place")
    shifted = index.join(F.broadcast(near) if small else near, "term").select(
        "doc_id", "mark", "probe", "needed", "rank", (F.col("pos") - F.col("place")).alias("shift")
    )
    hits = (
        shifted.groupBy("doc_id", "mark", "probe", "shift")
        .agg(F.bit_or(F.expr("shiftleft(1, rank)")).alias("ranks"), F.first("needed").alias("needed"))
        .filter(F.bit_count("ranks") == F.col("needed"))
    )
    named = lookups.select("probe", "key").distinct()
    candidates = hits.join(F.broadcast(named) if small else named, "probe")
    shifts = candidates.groupBy("doc_id", "mark", "key").agg(F.collect_set("shift").alias("shifts"))
    whole = shifts.join(F.broadcast(items) if small else items, "key")
    return whole.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("item", "words", "shifts")).alias("found"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, lists: int = 2, percent: int = 5, keep: bool = False
) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, contaminated)`` of each row of ``docs (doc_id, text)``; ``keep``: all its columns too.

    Words have A-Z in lower case and lie between ASCII signs. A window is ``window`` words in a row of a benchmark item
    ``(item_id, text)``, or all words of a shorter one. ``n_hit`` counts the document's words inside any occurrence of a
    window, ``items`` lists the ids (as text, sorted) of the items found. ``contaminated``: at least ``percent`` of the words
    are hit, and one at least. A null text has no words; an empty benchmark, or an item without words, hits nothing; an
    item without id is named by an empty text. Rows that share a doc_id, and repeated rows, are judged each by itself. Own
    columns of the names of the results are replaced.
    """
    found = _judged(docs, benchmark, window, lists, percent, keep)
    kept = [f"row.{c}" for c in (f"`{c}`" for c in docs.columns if c not in _RESULTS)] if keep else ["doc_id"]
    return found.select(*kept, *_RESULTS)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, lists: int = 2, percent: int = 5) -> DataFrame:
    """The rows of ``docs`` that :func:`contamination` does not call contaminated, with their columns as they are."""
    found = _judged(docs, benchmark, window, lists, percent, keep=True)
    return found.filter("not contaminated").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


_RESULTS = ("n_words", "n_hit", "items", "contaminated")


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, lists: int, percent: int, keep: bool) -> DataFrame:
    """``doc_id`` and the results of each row; with ``keep`` the whole row too, as ``row``, where no name can clash."""
    items = stored(benchmark_items(benchmark), "items")
    found = stored(phrase_matches(docs, items, window, lists), "candidates").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("found").alias("_found")
    )
    keyed = _keyed(docs)
    same = keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed["mark"] == F.col("_mark"))
    # Each step is stored so that the next one reads columns, not expressions to be computed again for every word. The
    # sides of the joins with whole texts are joined alike at every size.
    words = F.transform(_raw_words(F.col("text")), _fold)
    held = stored(keyed.join(found.hint("merge"), same).select("doc_id", "mark", "_found", words.alias("words")), "held")

    def read(c: Column) -> Column:
        """The candidates of an item, each with a sign for each of the item's words: 1 where the document has it there."""

        def at(shift: Column) -> Column:
            signs = F.transform(c["words"], lambda w, i: F.when(F.get("words", shift + i) == w, "1").otherwise("0"))
            return F.struct(c["item"].alias("item"), shift.alias("shift"), F.array_join(signs, "").alias("signs"))

        return F.transform(c["shifts"], at)

    held = stored(held.select("doc_id", "mark", F.flatten(F.transform("_found", read)).alias("found")), "read")

    def windows(c: Column) -> Column:
        """The candidate's item and the places covered by each window that occurs."""
        size = F.least(F.length(c["signs"]), F.lit(window))
        starts = F.sequence(F.lit(0), F.length(c["signs"]) - size)
        starts = F.filter(starts, lambda i: F.substr(c["signs"], i + 1, size) == F.repeat(F.lit("1"), size))
        spans = F.transform(starts, lambda i: F.sequence(c["shift"] + i, c["shift"] + i + size - 1))
        return F.struct(c["item"].alias("item"), F.array_distinct(F.flatten(spans)).alias("places"))

    held = stored(held.select("doc_id", "mark", F.transform("found", windows).alias("hit")), "windows")
    hit = F.filter("hit", lambda x: F.size(x["places"]) > 0)
    hits = held.select(
        F.col("doc_id").alias("_id"),
        F.col("mark").alias("_mark"),
        F.size(F.array_distinct(F.flatten(F.transform(hit, lambda x: x["places"])))).cast("long").alias("_n_hit"),
        F.array_sort(F.array_distinct(F.transform(hit, lambda x: x["item"]))).alias("_items"),
    ).filter("_n_hit > 0").dropDuplicates(["_id", "_mark"])

    n_words = _word_count(_raw_words(F.col("text"))).alias("n_words")
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if keep else []
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("mark")
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark, n_words, *whole)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    joined = counted.join(hits.hint("merge") if keep else hits, same, "left")
    n_hit = F.coalesce(F.col("_n_hit"), F.lit(0).cast("long"))
    flag = (n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)
    return joined.select(
        "doc_id",
        *(["row"] if keep else []),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
        flag.alias("contaminated"),
    )


def near_matches(index: DataFrame, queries: DataFrame, width: int) -> DataFrame:
    """``(query, doc_id, mark, first, last)``: the places where all terms of a query lie within ``width`` words.

    ``index`` has postings ``(term, doc_id, mark, pos)``, ``queries`` rows ``(query, term)``; a query's terms are taken once
    each, in any order in the document. One row for each posting that ends such a stretch, with the latest start it can
    have. A query with a term that is in no document matches nothing.
    """
    terms = queries.filter("query is not null and term is not null").distinct()
    listed = terms.groupBy("query").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    hits = index.join(terms, "term").join(listed, "query")
    before = Window.partitionBy("query", "doc_id", "mark").orderBy("pos").rangeBetween(-(width - 1), Window.currentRow)
    seen = F.collect_list(F.struct("term", "pos")).over(before)
    latest = F.transform("terms", lambda t: F.array_max(F.transform(F.filter("seen", lambda s: s["term"] == t), lambda s: s["pos"])))
    found = hits.withColumn("seen", seen).withColumn("latest", latest)
    whole = found.filter(~F.exists("latest", lambda x: x.isNull()))
    return whole.select("query", "doc_id", "mark", F.array_min("latest").alias("first"), F.col("pos").alias("last"))
