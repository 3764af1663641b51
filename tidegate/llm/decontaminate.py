"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

``postings`` writes one row for every place of a benchmark term in the training texts:
(document, term, place), in the order the documents are read, without a shuffle. A
benchmark window is looked up from its rarest terms: the places of the rarest one, less
its offset in the window, are candidate starts; they are joined with the offset-adjusted
places of the second and third rarest. What is left is compared word by word with the
document, which gives the exact phrase matches. ``near_matches`` uses the same index for
terms that stand near, not at, their place.

The benchmark's terms and the table of windows and terms are broadcast only if their
counted rows are within ``BROADCAST_ROWS``; beyond that the joins shuffle. A term is
named by a 64-bit hash after it was matched as a string; the last comparison is on words.

Defined results: words are runs of a-z, 0-9 and non-ASCII after lower-casing A-Z. A null
text has no words; an item without words has no window. Repeated rows each get a result;
rows that share an id but not a text are separate documents, and so are such items. An item without
an id counts for hits but has no name in ``items``. A row without an id is
searched like others. Empty tables give no matches. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.sources.shared import fresh_dir

WINDOW = 10
#: How many of a window's rarest terms are intersected before words are compared.
RAREST = 3
#: Rows (at most some 100 bytes each) of a benchmark-sized table that may be broadcast.
BROADCAST_ROWS = 1_000_000
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_ID = -(1 << 63)
#: Stands for the end of a text in the index; no word looks like it.
_END = "#"


def cut_words(text: Column) -> Column:
    """Words of a text with an empty string before a leading and after a trailing break."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.split(lower, _BREAKS)


def words_of(text: Column) -> Column:
    return F.array_remove(cut_words(text), "")


def bounded(frame: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few enough rows."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, at, size, words): windows of ``width`` words; an item with fewer words is one window.

    ``item`` tells apart the texts that share an id.
    """
    named = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    items = named.select(F.xxhash64("item_id", "text").alias("item"), "item_id", words_of(F.col("text")).alias("all"))
    items = items.where(F.size("all") > 0)
    last = F.greatest(F.size("all") - width, F.lit(0))
    each = items.select("item", "item_id", "all", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    size = F.least(F.size("all"), F.lit(width))
    return each.select("item", "item_id", "at", size.alias("size"), F.slice("all", F.col("at") + 1, size).alias("words"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, copy, text): an id that is never null, and a hash that tells texts of one id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("copy"), text.alias("text")
    )


def postings(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write and read back the index: (doc, copy, term, pos) of every benchmark term, and term 0 at each text's end."""
    spark = docs.sparkSession
    terms = windows.select(F.explode("words").alias("word")).distinct().select("word", F.xxhash64("word").alias("term"))
    terms = terms.unionByName(spark.range(1).select(F.lit(_END).alias("word"), F.lit(0).cast("long").alias("term")))
    cut = keyed(docs, id_col, text_col).select("doc", "copy", cut_words(F.col("text")).alias("cut"))
    lead = (F.element_at("cut", 1) == "").cast("int")
    tail = ((F.size("cut") > 1) & (F.element_at("cut", -1) == "")).cast("int")
    each = cut.select("doc", "copy", lead.alias("lead"), tail.alias("tail"), F.posexplode(F.concat("cut", F.array(F.lit(_END)))).alias("pos", "word"))
    place = F.col("pos") - F.col("lead") - F.when(F.col("term") == 0, F.col("tail")).otherwise(0)
    found = each.join(bounded(terms), "word").select("doc", "copy", "term", place.alias("pos"))
    path = fresh_dir(spark, "postings")
    found.write.parquet(path)
    return spark.read.parquet(path)


def needed(share: float) -> Column:
    """How many of a window's terms are ``share`` of them."""
    return F.ceil(F.col("size") * share - 1e-9)


def search_plan(index: DataFrame, windows: DataFrame, share: float = 1.0) -> DataFrame:
    """Write and read back (item, at, size, offset, term, rank): each window's terms that documents have, the rarest first.

    Windows of which no document can have ``share`` of the terms are left out.
    """
    spark = index.sparkSession
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("places"))
    terms = windows.select("item", "at", "size", F.posexplode("words").alias("offset", "word"))
    terms = terms.withColumn("term", F.xxhash64("word")).drop("word").join(counts, "term")
    whole = Window.partitionBy("item", "at")
    rank = F.row_number().over(whole.orderBy("places", "offset"))
    ranked = terms.withColumn("rank", rank).withColumn("present", F.count(F.lit(1)).over(whole)).where(F.col("present") >= needed(share))
    path = fresh_dir(spark, "search-plan")
    ranked.select("item", "at", "size", "offset", "term", "rank").write.parquet(path)
    return spark.read.parquet(path)


def candidates(index: DataFrame, plan: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(doc, copy, start, item, at, size) where each window's ``rarest`` terms stand at their offsets."""
    step = plan.where("rank = 1").select("term", "item", "at", "size", "offset")
    places = index.join(bounded(step), "term")
    found = places.select("doc", "copy", (F.col("pos") - F.col("offset")).alias("start"), "item", "at", "size").where("start >= 0")
    for rank in range(2, rarest + 1):
        step = plan.where(F.col("rank") == rank)
        wanted = found.join(bounded(step.select("item", "at", "offset", "term")), ["item", "at"])
        wanted = wanted.withColumn("pos", F.col("start") + F.col("offset"))
        held = index.join(bounded(step.select("term").distinct()), "term", "left_semi").distinct()
        kept = wanted.join(held, ["doc", "copy", "term", "pos"]).select(*found.columns)
        short = found.where(F.col("size") < rank)  # a short item has no further terms
        found = kept.unionByName(short)
    return found.distinct()


def phrase_matches(docs: DataFrame, windows: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The candidates whose words all equal the window's: (doc, copy, item_id, start, size)."""
    by_item = found.groupBy("doc", "copy", "item").agg(F.collect_list(F.struct("start", "at", "size")).alias("tries"))
    items = windows.groupBy("item", "item_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "words"))).alias("windows"))
    texts = keyed(docs, id_col, text_col).dropDuplicates(["doc", "copy"])
    joined = by_item.join(bounded(items), "item").join(texts, ["doc", "copy"]).withColumn("own", words_of(F.col("text")))
    exact = F.filter("tries", lambda t: F.slice(F.col("own"), t["start"] + 1, t["size"]) == F.element_at(F.col("windows"), t["at"]))
    return joined.select("doc", "copy", "item_id", F.explode(exact).alias("t")).select("doc", "copy", "item_id", "t.start", "t.size").distinct()


def near_matches(index: DataFrame, windows: DataFrame, slack: int = 3, share: float = 0.8, rarest: int = RAREST) -> DataFrame:
    """(doc, copy, item, at, start, n_near): windows most of whose terms stand near their places.

    A place of one of the ``rarest`` terms gives a start, or of one of as many as it takes
    that not all of them can be missing; a term counts if one of its places is within
    ``slack`` of start + offset, and ``share`` of the terms must count. A term may be
    missing from all documents.
    """
    plan = search_plan(index, windows, share)
    seeding = F.greatest(F.lit(rarest), F.col("size") - needed(share) + 1)
    seeds = index.join(bounded(plan.where(F.col("rank") <= seeding)), "term")
    seeds = seeds.select("doc", "copy", "item", "at", "size", (F.col("pos") - F.col("offset")).alias("start")).distinct()
    wanted = seeds.join(bounded(plan.select("item", "at", "offset", "term")), ["item", "at"])
    near = wanted.join(index, ["doc", "copy", "term"]).where(F.abs(F.col("pos") - F.col("start") - F.col("offset")) <= slack)
    counted = near.groupBy("doc", "copy", "item", "at", "size", "start").agg(F.count_distinct("offset").alias("n_near"))
    return counted.where(F.col("n_near") >= needed(share)).drop("size")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy, n_words, n_hit, items (sorted ids) and contaminated of every document."""
    windows = benchmark_windows(benchmark, width)
    index = postings(docs, windows, id_col, text_col)
    matches = phrase_matches(docs, windows, candidates(index, search_plan(index, windows)), id_col, text_col)
    spans = F.transform(F.collect_set(F.struct("start", "size")), lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))
    hits = matches.groupBy("doc", "copy").agg(
        F.size(F.array_distinct(F.flatten(spans))).cast("long").alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("items")
    )
    whole = index.where("term = 0").select("doc", "copy", F.col("pos").cast("long").alias("n_words"))
    return whole.join(hits, ["doc", "copy"], "left").select(
        F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"),
        "copy",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
