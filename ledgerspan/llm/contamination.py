"""Benchmark decontamination over a positional inverted index of the training documents.

The index holds a posting (term, document, position) for every word of a document that the test items
use at all (no other word can be part of a match), sorted by term within each file, and one posting
per document that closes it, at the position behind its last word. A window of an item is looked up
from its two rarest terms: the posting list of the rarest, shifted by its place in the item, is
intersected with that of the second; what is left (item, document, shift) is intersected with the
lists of all the item's terms, and runs of matching places are the exact phrases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspan.llm.common import ascii_lower, fresh, stored, table

# The class is that of the contract without A-Z being lower-cased first; words are lower-cased one by one.
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
# Hit words times this must reach the document's words.
CONTAMINATED = 20
CLOSING = ""  # no word is empty


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def test_words(items: DataFrame) -> DataFrame:
    """(item, item_id, n, place, word): the words of each item row; items without words have none."""
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", tokens(F.col("text")).alias("ws"))
    placed = numbered.select("item", "item_id", F.size("ws").alias("n"), F.posexplode("ws").alias("place", "raw"))
    return stored(placed.select("item", "item_id", "n", "place", ascii_lower(F.col("raw")).alias("word")), "test-words")


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, term): a number for every distinct test word and for the closing posting."""
    closing = words.sparkSession.createDataFrame([(CLOSING,)], "word string")
    distinct = words.select("word").unionByName(closing).distinct()
    return stored(distinct.select("word", F.monotonically_increasing_id().alias("term")), "test-vocabulary")


def build_index(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(term, doc, pos, doc_id, mark): the postings of `docs`, whose rows are numbered here.

    doc_id and `mark`, a hash of the text, are set on closing postings only.
    """
    words = docs.select(
        F.monotonically_increasing_id().alias("doc"), "doc_id", F.xxhash64("text").alias("mark"), F.array_append(tokens(F.col("text")), F.lit(CLOSING)).alias("ws")
    )
    each = words.select("doc", "doc_id", "mark", F.posexplode("ws").alias("pos", "raw"))
    at_end = lambda c: F.when(F.col("raw") == CLOSING, F.col(c)).alias(c)
    each = each.select("doc", "pos", ascii_lower(F.col("raw")).alias("word"), at_end("doc_id"), at_end("mark"))
    postings = each.join(vocab, "word").select("term", "doc", "pos", "doc_id", "mark")
    return stored(postings.sortWithinPartitions("term"), "postings")


def closing(index: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc, doc_id, mark, n_words) of every indexed row."""
    last = vocab.where(F.col("word") == CLOSING).select("term")
    return index.join(last, "term", "left_semi").select("doc", "doc_id", "mark", F.col("pos").cast("long").alias("n_words"))


def anchors(words: DataFrame, vocab: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(item, place_1, term_1, place_2, term_2): the two rarest places of every window, each pair once per item.

    Windows with a word that no document has are left out.
    """
    frequency = index.groupBy("term").agg(F.count("*").alias("cf"))
    known = words.join(vocab, "word").join(frequency, "term", "left")
    length = F.least(F.lit(window), F.col("n"))
    first = F.greatest(F.lit(0), F.col("place") - length + 1)
    last = F.least(F.col("place"), F.col("n") - length)
    spread = known.select("item", length.alias("length"), F.explode(F.sequence(first, last)).alias("start"), "place", "term", "cf")
    windows = spread.groupBy("item", "start").agg(
        F.count("cf").alias("found"), F.first("length").alias("length"), F.sort_array(F.collect_list(F.struct("cf", "place", "term"))).alias("by_rarity")
    )
    pair = windows.where("found = length").select(
        "item", F.get("by_rarity", F.lit(0)).alias("a"), F.get("by_rarity", F.least(F.lit(1), F.col("length") - 1)).alias("b")
    )
    return pair.select(
        "item", F.col("a.place").alias("place_1"), F.col("a.term").alias("term_1"), F.col("b.place").alias("place_2"), F.col("b.term").alias("term_2")
    ).distinct()


def alignments(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """(item, doc, shift): where both anchors of some window stand at the right distance."""
    pairs = stored(pairs, "anchors")
    first = index.join(pairs, F.col("term") == F.col("term_1")).select(
        "item", "doc", (F.col("pos") - F.col("place_1")).alias("shift"), "term_2", "place_2"
    )
    second = index.join(pairs.select(F.col("term_2").alias("term")).distinct(), "term", "left_semi").select(
        F.col("term").alias("other"), F.col("doc").alias("other_doc"), F.col("pos").alias("other_pos")
    )
    both = first.join(
        second,
        (F.col("other") == F.col("term_2")) & (F.col("other_doc") == F.col("doc")) & (F.col("other_pos") == F.col("shift") + F.col("place_2")),
        "left_semi",
    )
    return both.select("item", "doc", "shift").distinct()


def phrases(index: DataFrame, words: DataFrame, vocab: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, item_id, doc, from, to): the runs of words, at least a window long, that a document shares with an item.

    `from` and `to` are the first and the last word; an item shorter than a window must match whole.
    """
    found = stored(alignments(index, anchors(words, vocab, index, window)), "alignments")
    numbered = words.join(vocab, "word").select("item", "item_id", "n", "place", "term")
    expected = found.join(numbered, "item").select("item", "item_id", "n", "doc", "shift", "place", "term", (F.col("shift") + F.col("place")).alias("pos"))
    near = index.join(found.select("doc").distinct(), "doc", "left_semi").select("doc", "pos", "term")
    matched = expected.join(near, ["doc", "pos", "term"])
    by_place = Window.partitionBy("item", "doc", "shift").orderBy("place")
    runs = matched.withColumn("run", F.col("place") - F.row_number().over(by_place))
    return (
        runs.groupBy("item", "item_id", "n", "doc", "shift", "run")
        .agg(F.count("*").alias("length"), F.min("pos").alias("from"), F.max("pos").alias("to"))
        .where(F.col("length") >= F.least(F.lit(window), F.col("n")))
        .select("item", "item_id", "doc", "from", "to")
    )


def proximity(index: DataFrame, words: DataFrame, vocab: DataFrame, within: int, window: int = WINDOW) -> DataFrame:
    """(item, doc): documents where the two rarest terms of some window stand at most `within` words apart, in any order.

    Positions are cut into stretches of `within`, and a posting meets those of its own and the next
    stretches only, so no pairs of far postings are made.
    """
    pairs = stored(anchors(words, vocab, index, window), "anchors")
    stretch = lambda pos: F.floor(pos / F.lit(within))
    first = index.join(pairs, F.col("term") == F.col("term_1")).select("item", "doc", "pos", "term_2", F.explode(F.array(*[stretch(F.col("pos")) + i for i in (-1, 0, 1)])).alias("s"))
    second = index.select(F.col("term").alias("term_2"), "doc", F.col("pos").alias("other"), stretch(F.col("pos")).alias("s"))
    return first.join(second, ["term_2", "doc", "s"]).where(F.abs(F.col("pos") - F.col("other")) <= within).select("item", "doc").distinct()


def hits(found: DataFrame) -> DataFrame:
    """(doc, n_hit, items): words inside any run, and the sorted ids of the items, per document with a run."""
    before = Window.partitionBy("doc").orderBy("from", "to").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("doc", "from", "to").distinct().withColumn("seen", F.coalesce(F.max("to").over(before), F.lit(-1)))
    new = F.greatest(F.lit(0), F.col("to") - F.greatest(F.col("seen"), F.col("from") - 1))
    words = spans.groupBy("doc").agg(F.sum(new).cast("long").alias("n_hit"))
    ids = found.groupBy("doc").agg(F.sort_array(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items"))
    return words.join(ids, "doc")


def _contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (CONTAMINATED * n_hit >= n_words)


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and no hits. Item rows that repeat an id count once, a null id
    reads as the empty text. Repeated documents are judged alike. Empty tables give no rows or no hits.
    """
    words = test_words(items)
    vocab = vocabulary(words)
    index = build_index(docs, vocab)
    found = stored(hits(phrases(index, words, vocab, window)), "hits").withColumnRenamed("doc", "hit_doc")
    joined = closing(index, vocab).join(found, F.col("doc") == F.col("hit_doc"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), _contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with the columns of `docs`.

    Rows are told apart by id and hash of the text. The table of contaminated rows is broadcast while it
    is small; otherwise both sides are shuffled.
    """
    its_id, its_mark = fresh(docs.columns, "__id"), fresh(docs.columns, "__mark")
    words = test_words(items)
    vocab = vocabulary(words)
    index = build_index(docs, vocab)
    found = hits(phrases(index, words, vocab, window))
    judged = found.join(closing(index, vocab), "doc").where(_contaminated(F.col("n_hit"), F.col("n_words")))
    bad = stored(judged.select(F.col("doc_id").alias(its_id), F.col("mark").alias(its_mark)).distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(F.col(its_id)) & (F.xxhash64(docs["text"]) == F.col(its_mark))
    return docs.join(bad, same, "left_anti")


def benchmark(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", "text")
