"""Substring dedup: paragraphs that repeat, exactly or nearly, in other places of the corpus.

A paragraph is a line of MIN_WORDS words or more, or, from every shorter line on, the shortest run of
lines that reaches MIN_WORDS; so a repeated passage of that length that fills whole lines is found
wherever it stands. Equal paragraphs form one class at once. Classes are banded by MinHash; classes that share a
bucket are compared by the exact Jaccard similarity of their five-word shingles, and clusters are the
components of the links.

A passage may also begin and end inside longer lines. Every run of MIN_WORDS words that stands, word for
word, in two places is found, wherever its lines break; such runs that follow each other make one passage.
All runs hang on a seed of SEED_WORDS words, chosen by the words of the run alone, and only runs whose seed
stands in two places are compared. What differs in single words is found where its lines are paragraphs.

A bucket is never expanded into its pairs: its members are first compared with one of them. Where members
are in different components by now, they meet by their rarest shingles, of which alike paragraphs share one
so early that the rest can still reach the similarity; first each with the smallest paragraph of the shingle,
which joins those with much in common, then those that are still apart. What the buckets propose is thereby decided in full,
while a bucket of many alike paragraphs, or of unlike ones with a common line, costs about its size.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspan.llm.common import WORD, forget, fresh, stored
from ledgerspan.llm.components import components
from ledgerspan.operators.reshape import union_all
from ledgerspan.operators.skew import join_unique

MIN_WORDS = 50
SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.998  # chance that a pair of exactly SIMILARITY shares a bucket
ROWS = 3
SEED = 11
SEED_WORDS = 25  # a run has MIN_WORDS - SEED_WORDS + 1 of these
FEW = 8  # members of different components of a bucket that are compared pair by pair
CHUNK = 20_000  # words that are worked on together


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """The least number of bands of `rows` values that reaches `recall` at `similarity`."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands


def words_in(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def runs(lines: list[int], least: int = MIN_WORDS) -> list[tuple[int, int]]:
    """(first, last) lines of the paragraphs, from the number of words of each line. Lines without words start none."""
    total, out, end = np.concatenate([[0], np.cumsum(lines)]), [], len(lines)
    reach = np.searchsorted(total, total[:-1] + least)
    for i, j in enumerate(reach):
        if lines[i] and j <= end:
            out.append((i, int(j) - 1))
    return out


def shingle_hashes(hashed: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash of every run of `size` words, from the hashes of the words."""
    if len(hashed) < size:
        size = max(1, len(hashed))
    out = np.zeros(len(hashed) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out ^ hashed[k : len(hashed) - size + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def _numbers(n: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


def _hashed(words: Iterable[bytes]) -> np.ndarray:
    """The XXH64 of every word. Eight bytes a word are joined, so no number passes through Python."""
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)


def _cut(text: str | None) -> tuple[list[tuple[int, int, int, int]], np.ndarray]:
    """(first line, last line, first word, words) of every paragraph of a text, and the hashes of its words."""
    lines = [line.split() for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")]
    counts = [len(w) for w in lines]
    found = runs(counts)
    if not found:
        return [], np.zeros(0, np.uint64)
    values = _hashed(chain.from_iterable(lines))
    places = np.concatenate([[0], np.cumsum(counts)]).tolist()
    return [(first, last, places[first], places[last + 1] - places[first]) for first, last in found], values


POWER = np.uint64(0xD6E8FEB86659FD93)
BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _classes(shingles: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the shingles of every range, in order, from prefix sums; it does not depend on where the range stands."""
    powers = np.full(len(shingles) + 1, POWER)
    back = np.full(len(shingles) + 1, BACK)
    powers[0] = back[0] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(back, out=back)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(shingles * powers[:-1], dtype=np.uint64)])
        mixed = (sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * POWER
        return mixed ^ (mixed >> np.uint64(31))


def _banded(bands: int, rows: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, mix = _numbers(bands * rows), _numbers(rows + bands)
        names = ["doc_id", "mark", "first", "last", "start", "n_words", "class", "overlaps", "buckets"]

        def out(texts: list[int], batch: pa.RecordBatch, cuts: list, words: list[np.ndarray]) -> pa.RecordBatch:
            """The paragraphs of some texts: their shingles are multiplied once, though paragraphs overlap."""
            # shingles over the end of a text belong to no paragraph
            bases = np.cumsum([0, *[len(x) for x in words]])
            rows_ = np.concatenate([np.zeros((0, 4), np.int64), *[np.array(c, np.int64) for c in cuts]])
            each = [len(c) for c in cuts]
            base = np.repeat(bases[:-1], each)
            starts, ends = base + rows_[:, 2], base + rows_[:, 2] + np.maximum(rows_[:, 3] - SHINGLE + 1, 1)
            # following paragraphs of the text that begin on a line of this one
            last, limit = rows_[:, 1], np.repeat(np.cumsum(each), each)
            key = np.repeat(np.arange(len(cuts)), each) * (int(last.max(initial=0)) + 2)
            overlaps = np.minimum(np.searchsorted(key + rows_[:, 0], key + last, "right"), limit) - np.arange(len(rows_)) - 1
            flat = np.append(shingle_hashes(np.concatenate(words)), np.uint64(0xFFFFFFFFFFFFFFFF))
            pairs = np.stack([starts, ends], 1).ravel()
            least = np.empty((len(rows_), bands * rows), np.uint64)
            with np.errstate(over="ignore"):
                for k, f in enumerate(factors):
                    product = flat * f
                    product[-1] = flat[-1]
                    least[:, k] = np.minimum.reduceat(product, pairs)[::2] if len(pairs) else 0
                keys = (least.reshape(-1, bands, rows) * mix[:rows]).sum(2) ^ mix[rows:]
            chosen = pa.array(np.repeat(np.array(texts, np.int64), each))
            columns = [batch.column(0).take(chosen).cast(id_type), batch.column(1).take(chosen)]
            columns += [pa.array(rows_[:, i].astype(np.int32)) for i in range(4)]
            columns += [pa.array(_classes(flat[:-1], starts, ends).view(np.int64)), pa.array(overlaps.astype(np.int64))]
            offsets = pa.array(np.arange(0, keys.size + 1, bands), pa.int32())
            return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, pa.array(keys.ravel().view(np.int64)))], names)

        for batch in batches:
            texts, cuts, words, total = [], [], [], 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                found, values = _cut(text)
                if not found:
                    continue
                texts.append(i)
                cuts.append(found)
                words.append(values)
                total += len(values)
                if total > CHUNK:
                    yield out(texts, batch, cuts, words)
                    texts, cuts, words, total = [], [], [], 0
            if texts:
                yield out(texts, batch, cuts, words)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (bucket, unit, overlaps) sorted by both, the units of buckets that hold two paragraphs which don't overlap.

    `overlaps` is the number of following units of the same text that a unit overlaps, and units of a text have
    successive numbers, so a bucket is dropped if its first unit overlaps all others. The first and the last
    bucket of a partition may go on elsewhere and are kept.
    """
    last_kept = None  # bucket at the end of the batches so far, if it is kept whatever follows
    rest = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))  # its rows, if that is still open
    first = True
    out = lambda b, u: pa.RecordBatch.from_arrays([pa.array(b), pa.array(u)], ["bucket", "unit"])
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, unit, over = (np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest))
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.concatenate([starts[1:], [len(bucket)]])
        keep = unit[ends - 1] > unit[starts] + over[starts]
        if first or bucket[0] == last_kept:
            keep[0] = True
        first = False
        open_ = not keep[-1]
        last_kept = None if open_ else bucket[-1]
        rows = np.repeat(keep, ends - starts)
        rest = (bucket[starts[-1] :], unit[starts[-1] :], over[starts[-1] :]) if open_ else tuple(x[:0] for x in (bucket, unit, over))
        yield out(bucket[rows], unit[rows])
    yield out(rest[0], rest[1])


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct shingles of the wanted paragraphs of each text."""
    for batch in batches:
        classes, shingles = [], []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            at = {(w["first"], w["last"]): w["class"] for w in wanted}
            found, values = _cut(text)
            whole = shingle_hashes(values).view(np.int64)
            for first, last, start, n in found:
                if (first, last) in at:
                    classes.append(at[(first, last)])
                    shingles.append(np.unique(whole[start : start + max(n - SHINGLE + 1, 1)]))
        yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(shingles, pa.list_(pa.int64()))], ["class", "shingles"])


def _verified(pairs: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact Jaccard similarity is at least `similarity`."""
    one = shingles.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    two = shingles.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    met = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("x", "y"))
    return met.where(common >= F.lit(similarity) * (F.size("x") + F.size("y") - common)).select("a", "b")


def _headed(posts: DataFrame, similarity: float, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The posts with roots that are joined where members of a shingle are alike to its smallest class, found by `link`.

    Of classes that have the same in common, all that are alike to any are alike to the smallest, so they need no pairs.
    """
    head = F.min_by(F.struct("class", "root", "size", "rest"), F.struct("size", F.xxhash64("class")))
    heads = stored(posts.groupBy("shingle").agg(F.count("*").alias("n"), head.alias("head")).where("n > 2").drop("n"), "paragraph-heads")
    enough = F.least("rest", "head.rest") * (1 + similarity) >= F.lit(similarity) * (F.col("size") + F.col("head.size")) - 1e-6
    met = join_unique(posts, heads, ["shingle"], ["shingle"]).where(F.col("head").isNotNull() & (F.col("root") != F.col("head.root")) & enough)
    pairs = met.select(F.least("class", "head.class").alias("a"), F.greatest("class", "head.class").alias("b"), F.least("root", "head.root").alias("u"), F.greatest("root", "head.root").alias("v")).distinct()
    pairs = stored(pairs, "paragraph-headed")
    found = link(pairs.select("a", "b")).withColumnsRenamed({"a": "linked_a", "b": "linked_b"})
    roots = pairs.join(found, (F.col("a") == F.col("linked_a")) & (F.col("b") == F.col("linked_b"))).select("u", "v")
    joined = stored(components(roots, "u", "v"), "paragraph-headed-roots")
    out = stored(join_unique(posts, joined, ["root"], ["node"]).select("class", F.coalesce("component", "root").alias("root"), "size", "rest", "shingle"), "paragraph-posts")
    forget(heads, pairs, joined, posts)
    return out


def _proposed(classes: DataFrame, shingles: DataFrame, similarity: float, link: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Pairs (a, b) of the classes (class, root) with different roots, among them all whose Jaccard similarity is at least `similarity`,
    but for those that `link`, which returns the alike ones of some pairs, has brought together.

    The shingles of each class are put in one order, rare ones first. Where two classes share their first shingle at
    places i and j, they have at most min(x - i, y - j) of their x and y shingles in common, so a pair is proposed only
    where that still reaches the similarity. Shingles of one class alone count as places but never meet.
    """
    wide = stored(classes.join(shingles, "class").select("class", "root", F.size("shingles").alias("size"), "shingles"), "paragraph-open")
    each = wide.select("class", "root", "size", F.explode("shingles").alias("shingle"))
    counts = stored(each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("n > 1"), "paragraph-counts")
    met = join_unique(each, counts, ["shingle"], ["shingle"]).where("n is not null")
    ordered = met.groupBy("class").agg(F.first("root").alias("root"), F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "shingle", (F.col("low") < F.col("high")).alias("mixed")))).alias("order"))
    placed = ordered.select("class", "root", "size", (F.col("size") - F.size("order")).alias("alone"), F.posexplode("order").alias("i", "x"))
    rest = F.col("size") - F.col("alone") - F.col("i")
    # the partner has at least `similarity` times the shingles, so less than this can't do
    posts = placed.select("class", "root", "size", rest.alias("rest"), "x.shingle", "x.mixed").where(F.col("mixed") & (F.col("rest") >= F.lit(similarity) * F.col("size") - 1e-6)).drop("mixed")
    posts = stored(posts, "paragraph-posts")
    forget(wide, counts)
    if link is not None:
        posts = _headed(posts, similarity, link)
    other = posts.select(F.col("class").alias("b"), F.col("root").alias("root_b"), F.col("size").alias("size_b"), F.col("rest").alias("rest_b"), F.col("shingle").alias("shingle_b"))
    enough = F.least("rest", "rest_b") * (1 + similarity) >= F.lit(similarity) * (F.col("size") + F.col("size_b")) - 1e-6
    pairs = posts.join(other, (F.col("shingle") == F.col("shingle_b")) & (F.col("root") < F.col("root_b")) & enough)
    out = stored(pairs.select(F.least("class", "b").alias("a"), F.greatest("class", "b").alias("b")).distinct(), "paragraph-proposed")
    forget(posts)
    return out


def _across(at: DataFrame, shingles: DataFrame, similarity: float, link: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Pairs (a, b) of the members (bucket, class, root) that share a bucket and no root: all where FEW members stand in it, else at least those that are alike."""
    mixed = at.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("bucket", (F.col("n") <= FEW).alias("few"))
    met = stored(join_unique(at, stored(mixed, "paragraph-mixed"), ["bucket"], ["bucket"]).where("few is not null"), "paragraph-met")
    small = met.where("few")
    other = small.select(F.col("bucket").alias("bucket_b"), F.col("class").alias("b"), F.col("root").alias("root_b"))
    direct = small.join(other, (F.col("bucket") == F.col("bucket_b")) & (F.col("root") < F.col("root_b"))).select(F.least("class", "b").alias("a"), F.greatest("class", "b").alias("b"))
    return direct.unionByName(_proposed(met.where("not few").select("class", "root").distinct(), shingles, similarity, link)).distinct()


def _joined(hashed: np.ndarray, n: int, step: int) -> np.ndarray:
    """A hash of every `n` values that are `step` apart."""
    size = len(hashed) - (n - 1) * step
    out = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = (out ^ hashed[k * step : k * step + size]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def _hashed_words(text: str | None) -> np.ndarray:
    return _hashed(words_in(text))


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of every `width` values, the first of equals, by windows that double."""
    at, least, span = np.arange(len(values)), values, 1
    while span < width:
        step = min(span, width - span)
        later = least[step:] < least[:-step]
        at, least = np.where(later, at[step:], at[:-step]), np.where(later, least[step:], least[:-step])
        span += step
    return at


def _seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mark, size, at, until, seed): of every text of MIN_WORDS words or more the stretches of runs, `at` to `until`, with one seed."""
    names, places = ["mark", "size", "at", "until", "seed"], MIN_WORDS - SEED_WORDS + 1

    def out(marks: list[int], words: list[np.ndarray]) -> pa.RecordBatch:
        """Stretches of some texts side by side; runs over the end of a text are left out."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        five = _joined(np.concatenate(words), SHINGLE, 1)
        seed = _joined(five, SEED_WORDS // SHINGLE, SHINGLE)
        text = np.repeat(np.arange(len(sizes)), sizes - MIN_WORDS + 1)
        starts = np.arange(len(text)) + text * (MIN_WORDS - 1)
        anchors = _first_least(five, places)[starts]
        first = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])]))
        last = np.append(first[1:], len(text)) - 1
        base = (ends - sizes)[text[first]]
        columns = [np.array(marks, np.int64)[text[first]], sizes[text[first]].astype(np.int32), (starts[first] - base).astype(np.int32)]
        columns += [(starts[last] + 1 - base).astype(np.int32), seed[anchors[first]].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    for batch in batches:
        marks, words, total = [], [], 0
        for mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = _hashed_words(text)
            if len(values) < MIN_WORDS:
                continue
            marks.append(mark)
            words.append(values)
            total += len(values)
            if total > CHUNK:
                yield out(marks, words)
                marks, words, total = [], [], 0
        if marks:
            yield out(marks, words)


def _windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mark, pos, window): hashes of the runs of MIN_WORDS words in the given stretches of a text."""
    for batch in batches:
        marks, positions, windows = [], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for mark, text, stretches in zip(*(batch.column(i).to_pylist() for i in range(3))):
            five = _joined(_hashed_words(text), SHINGLE, 1)
            whole = _joined(five, MIN_WORDS // SHINGLE, SHINGLE)
            at = np.concatenate([np.arange(x["at"], x["until"]) for x in stretches])
            marks += [mark] * len(at)
            positions.append(at)
            windows.append(whole[at])
        columns = [pa.array(marks, pa.int64()), pa.array(np.concatenate(positions).astype(np.int32)), pa.array(np.concatenate(windows).view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["mark", "pos", "window"])


def _merged(id_type: pa.DataType):
    """From texts with their repeated runs (place, keeper's mark, id and place) and covered words, the passages that whole lines don't cover.

    In a text that other documents hold as well (`rep` is the first of them) every run repeats, if only there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            for k, (doc_id, mark, rep, copied, words) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 5, 6)))):
                found, lines = batch.column(2)[k].values, batch.column(3)[k].as_py() or []
                listed = found.field("pos").to_numpy() if found is not None else np.zeros(0, np.int32)
                pos, order = np.unique(listed, return_index=True)
                ids = pa.array([rep], id_type)
                if found is None:
                    its_mark, its_pos = np.zeros(0, np.int64), np.zeros(0, np.int32)
                else:
                    its_mark, its_pos = (found.field(f).to_numpy()[order] for f in ("its_mark", "its_pos"))
                    ids = pa.concat_arrays([ids, pc.take(found.field("its_id"), pa.array(order)).cast(id_type)])
                # every id once, and the number of the keeper's id for each run
                coded = pc.dictionary_encode(ids, null_encoding="encode")
                ids, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy()
                reps, numbers = numbers[0], numbers[1:]
                if copied:
                    every = np.arange(words - MIN_WORDS + 1)
                    marks, places, names = np.full(len(every), mark), every.copy(), np.full(len(every), reps)
                    marks[pos], places[pos], names[pos] = its_mark, its_pos, numbers
                    pos, its_mark, its_pos, numbers = every, marks, places, names
                own = np.array([x == doc_id for x in ids], bool)[numbers]
                near = own & (its_mark == mark) & (np.abs(its_pos - pos) < MIN_WORDS)
                cut = (np.diff(pos) != 1) | (np.diff(its_mark) != 0) | (np.diff(numbers) != 0) | (near[1:] != near[:-1])
                starts = np.flatnonzero(np.concatenate([[True], cut]))
                ends = np.concatenate([starts[1:], [len(pos)]]) - 1
                size = max([int(pos[-1]) + MIN_WORDS, *[x["start"] + x["n_words"] for x in lines]])
                by_any, by_removed = np.zeros(size, bool), np.zeros(size, bool)
                for x in lines:
                    by_any[x["start"] : x["start"] + x["n_words"]] = True
                    if x["removed"]:
                        by_removed[x["start"] : x["start"] + x["n_words"]] = True
                for a, b in zip(starts, ends):
                    start, end, keeper, stays = int(pos[a]), int(pos[b]) + MIN_WORDS, ids[numbers[a]], bool(near[a])
                    # a few words more than whole lines agree by chance
                    if np.count_nonzero(~(by_any if stays else by_removed)[start:end]) < SHINGLE:
                        continue
                    for column, value in zip(out, (doc_id, mark, start, end - start, keeper, not stays)):
                        column.append(value)
            types = (id_type, pa.int64(), pa.int32(), pa.int32(), id_type, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "mark", "start", "n_words", "component_id", "removed"])

    return run


def _lined(id_type: pa.DataType):
    """Passages with the lines that they touch, from (doc_id, mark, text, spans)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(8)]
            for doc_id, mark, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4))):
                ends = np.cumsum([len(line.split()) for line in text.encode("utf-8", "surrogatepass").split(b"\n")])
                for x in spans:
                    first, last = np.searchsorted(ends, [x["start"], x["start"] + x["n_words"] - 1], "right")
                    for column, value in zip(out, (doc_id, mark, int(first), int(last), x["n_words"], x["component_id"], x["removed"], x["start"])):
                        column.append(value)
            types = (id_type, pa.int64(), pa.int32(), pa.int32(), pa.int32(), id_type, pa.bool_(), pa.int32())
            names = ["doc_id", "mark", "first", "last", "n_words", "component_id", "removed", "start"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return run


def passages(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, mark, first, last, n_words, component_id, removed, start) of the passages that repeat word for word beyond `lines`,
    the places of whole lines with doc_id, mark, start, n_words and removed."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    name = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", _mark(F.col("text")).alias("mark"), "text")
    # texts count once, whoever holds them; `rep` is the first document of each
    holders = stored(texts.select("doc_id", "mark").distinct(), "passage-holders")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("rep")))
    reps = stored(holders.groupBy("mark").agg(first.alias("first"), (F.count("*") > 1).alias("copied")).select("mark", "first.none", "first.rep", "copied"), "passage-texts")
    cut = stored(texts.select("mark", "text").mapInArrow(_seeded, "mark long, size int, at int, until int, seed long"), "passage-seeds")
    place = F.xxhash64("mark", "at")
    span = cut.groupBy("seed").agg(F.min(place).alias("one"), F.max(place).alias("two"))
    seeds = stored(span.where("one <> two").select("seed", F.lit(True).alias("again")), "passage-repeated-seeds")
    met = join_unique(cut, seeds, ["seed"], ["seed"]).where("again")
    stretches = met.groupBy("mark").agg(F.collect_set(F.struct("at", "until")).alias("stretches"))
    wanted = stored(stretches.withColumnRenamed("mark", "its_mark"), "passage-stretches")
    sizes = stored(cut.groupBy(F.col("mark").alias("size_mark")).agg(F.max("size").alias("size")), "passage-sizes")
    forget(cut, seeds)
    again_read = texts.select("mark", "text").join(wanted, F.col("mark") == F.col("its_mark")).dropDuplicates(["its_mark"]).select("mark", "text", "stretches")
    each = stored(again_read.mapInArrow(_windowed, "mark long, pos int, window long"), "passage-runs")
    twice = each.groupBy("window").agg(F.min("mark").alias("one"), F.max("mark").alias("two"), F.min("pos").alias("top"), F.max("pos").alias("low"))
    twice = stored(twice.where(f"one <> two or low - top >= {MIN_WORDS}").select("window", F.lit(True).alias("twice")), "passage-repeats")
    again = join_unique(each, twice, ["window"], ["window"]).where("twice").drop("twice")
    held = reps.select(F.col("mark").alias("held_mark"), "none", "rep")
    again = stored(again.join(held, F.col("mark") == F.col("held_mark")).select("mark", "pos", "window", "none", "rep"), "passage-places")
    forget(each, twice, wanted)
    place = F.struct("none", F.col("rep").alias("its_id"), F.col("mark").alias("its_mark"), F.col("pos").alias("its_pos"))
    keepers = stored(again.groupBy("window").agg(F.min(place).alias("keeper")), "passage-keepers")
    kept = join_unique(again, keepers, ["window"], ["window"]).select("mark", F.struct("pos", "keeper.its_id", "keeper.its_mark", "keeper.its_pos").alias("run"))
    runs_of = stored(kept.groupBy(F.col("mark").alias("runs_mark")).agg(F.collect_list("run").alias("runs")), "passage-runs-of")
    forget(again, keepers)
    known = reps.join(sizes, F.col("mark") == F.col("size_mark")).join(runs_of, F.col("mark") == F.col("runs_mark"), "left").where("copied or runs is not null")
    known = stored(known.select(F.col("mark").alias("known_mark"), "rep", "copied", "size", "runs"), "passage-known")
    forget(runs_of, sizes, reps)
    covered = lines.groupBy(F.col("doc_id").alias("lines_id"), F.col("mark").alias("lines_mark")).agg(F.collect_set(F.struct("start", "n_words", "removed")).alias("lines"))
    both = holders.join(covered, F.col("doc_id").eqNullSafe(F.col("lines_id")) & (F.col("mark") == F.col("lines_mark")), "left")
    both = both.join(known, F.col("mark") == F.col("known_mark")).select("doc_id", "mark", "runs", "lines", "rep", "copied", "size")
    found = both.mapInArrow(_merged(kind), f"doc_id {name}, mark long, start int, n_words int, component_id {name}, removed boolean")
    spans = found.groupBy(F.col("doc_id").alias("its_id"), F.col("mark").alias("its_mark")).agg(F.collect_set(F.struct("start", "n_words", "component_id", "removed")).alias("spans"))
    spans = stored(spans, "passage-spans")
    forget(known, holders)
    read = texts.join(spans, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("mark") == F.col("its_mark"))).select("doc_id", "mark", "text", "spans")
    schema = f"doc_id {name}, mark long, first int, last int, n_words int, component_id {name}, removed boolean, start int"
    # rows alike in id and text give the same passages
    return read.dropDuplicates(["doc_id", "mark"]).mapInArrow(_lined(kind), schema)


def _mark(text: Column) -> Column:
    return F.xxhash64(text)


def paragraphs(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, mark, first, last, start, n_words, class, overlaps, buckets) of every paragraph; `mark` hashes the text."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind, bands = docs.schema["doc_id"].dataType, tune_bands(similarity)
    schema = f"doc_id {kind.simpleString()}, mark long, first int, last int, start int, n_words int, class long, overlaps long, buckets array<long>"
    return docs.select("doc_id", _mark(F.col("text")).alias("mark"), "text").mapInArrow(_banded(bands, ROWS, to_arrow_type(kind)), schema)


def repeats(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, mark, first, last, n_words, component_id, removed, start, whole): the places of all repeated paragraphs.

    A cluster's paragraph in the smallest doc_id (ties: the smallest mark and line) stays, and so does what
    overlaps it; all others are `removed`. component_id is that doc_id. Of runs of a cluster that end on
    the same line the shortest counts. Lines are numbered from 0, and words from `start` on, the first of the place. Passages
    that reach SHINGLE words or more beyond whole lines have a row of their own, with the lines that they
    touch and without `whole`; of these the smallest doc_id and word stay. Paragraphs of one document that
    overlap don't count as repeats of each other. Null, empty and short texts have no paragraphs, rows
    alike in id and text count as one document, and an empty table gives no rows.
    """
    found = stored(paragraphs(docs, similarity).withColumn("unit", F.monotonically_increasing_id()), "paragraphs")
    thin = stored(found.drop("buckets", "overlaps"), "paragraph-units")
    # ranges of (bucket, unit) cut also a bucket that many share
    posted = found.select(F.explode("buckets").alias("bucket"), "unit", "overlaps").repartitionByRange("bucket", "unit")
    near = stored(posted.sortWithinPartitions("bucket", "unit").mapInArrow(_shared, "bucket long, unit long"), "paragraph-buckets")
    forget(found)
    shared = stored(near.join(thin.select("unit", "class"), "unit").select("bucket", "class").distinct(), "paragraph-shared")
    forget(near)
    # a bucket of one class holds copies, which are together already
    several = shared.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("class", F.xxhash64("class")).alias("leader")).where("n > 1").drop("n")
    leaders = stored(several, "paragraph-leaders")
    led = stored(join_unique(shared, leaders, ["bucket"], ["bucket"]).where("leader is not null"), "paragraph-led")
    forget(shared, leaders)
    tagged = thin.withColumn("doc", F.xxhash64("doc_id", "mark"))
    stats = stored(
        tagged.groupBy("class").agg(
            F.min("unit").alias("unit"), F.min("doc").alias("doc"), F.max("doc").alias("other_doc"), F.min("first").alias("top"), F.max("first").alias("low"), F.max("last").alias("bottom")
        ),
        "paragraph-classes",
    )
    wanted = stored(stats.join(led.select("class").distinct(), "class", "left_semi"), "paragraph-wanted")
    spans = thin.join(wanted.select("unit"), "unit", "left_semi").groupBy("doc_id", "mark").agg(F.collect_set(F.struct("first", "last", "class")).alias("spans"))
    spans = stored(spans.withColumnsRenamed({"doc_id": "its_id", "mark": "its_mark"}), "paragraph-spans")
    texts = docs.select("doc_id", "text").withColumn("mark", _mark(F.col("text")))
    read = texts.join(spans, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("mark") == F.col("its_mark"))).select("text", "spans")
    shingles = stored(read.mapInArrow(_fetched, "class long, shingles array<long>").dropDuplicates(["class"]), "paragraph-shingles")

    def apart(pairs: DataFrame) -> DataFrame:
        """Without pairs that stand in one place each, and there overlap."""
        names = ("doc", "other_doc", "top", "low", "bottom")
        a = wanted.select(F.col("class").alias("a"), *[F.col(c).alias(f"{c}_a") for c in names])
        b = wanted.select(F.col("class").alias("b"), *[F.col(c).alias(f"{c}_b") for c in names])
        met = pairs.join(a, "a").join(b, "b")
        once = (F.col("doc_a") == F.col("other_doc_a")) & (F.col("doc_b") == F.col("other_doc_b")) & (F.col("top_a") == F.col("low_a")) & (F.col("top_b") == F.col("low_b"))
        return met.where(~(once & (F.col("doc_a") == F.col("doc_b")) & (F.col("top_a") <= F.col("bottom_b")) & (F.col("top_b") <= F.col("bottom_a")))).select("a", "b")

    pairs = led.where("class <> leader").select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b")).distinct()
    links = stored(_verified(apart(pairs), shingles, similarity), "paragraph-links")
    known = stored(components(links, "a", "b"), "paragraph-components")
    at = stored(led.join(known, F.col("class") == F.col("node"), "left").select("bucket", "class", F.coalesce("component", "class").alias("root")), "paragraph-roots")
    headed = []

    def link(some: DataFrame) -> DataFrame:
        headed.append(stored(_verified(apart(some), shingles, similarity), "paragraph-links"))
        return headed[0]

    across = _across(at, shingles, similarity, link)
    tried = pairs.withColumnsRenamed({"a": "old_a", "b": "old_b"})
    untried = across.join(tried, (F.col("a") == F.col("old_a")) & (F.col("b") == F.col("old_b")), "left_anti")
    more = stored(_verified(apart(untried), shingles, similarity), "paragraph-links")
    forget(shingles, spans, led, at, known, wanted)
    every = union_all([links, *headed, more])
    final = stored(components(every, "a", "b"), "paragraph-clusters")
    forget(links, *headed, more)
    copied = stats.where("doc <> other_doc or top <> low").select(F.col("class").alias("of"))
    members = copied.unionByName(final.select(F.col("node").alias("of"))).distinct()
    rooted = members.join(final, F.col("of") == F.col("node"), "left").select("of", F.coalesce("component", "of").alias("root"))
    rooted = stored(rooted, "paragraph-members")
    placed = stored(thin.join(rooted, F.col("class") == F.col("of")).drop("of", "class", "unit").distinct(), "paragraph-places")
    forget(thin, rooted, stats, final)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "first", "last")
    keepers = placed.groupBy(F.col("root").alias("cluster")).agg(F.min(place).alias("keeper"))
    places, keepers = placed, stored(keepers, "paragraph-keepers")
    placed = placed.join(keepers, F.col("root") == F.col("cluster"))
    # a run that holds a shorter one of its cluster with the same end repeats only for the sake of that one
    next_in_text = Window.partitionBy("doc_id", "mark", "root").orderBy("first")
    least = placed.withColumn("next", F.lead("last").over(next_in_text)).where(F.col("next").isNull() | (F.col("next") > F.col("last")))
    stays = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & F.col("mark").eqNullSafe(F.col("keeper.mark")) & (F.col("first") <= F.col("keeper.last")) & (F.col("keeper.first") <= F.col("last"))
    lines = stored(least.select("doc_id", "mark", "first", "last", "n_words", F.col("keeper.doc_id").alias("component_id"), (~stays).alias("removed"), "start"), "paragraph-lines")
    forget(places, keepers)
    return lines.withColumn("whole", F.lit(True)).unionByName(passages(docs, lines).withColumn("whole", F.lit(False)))


def _left(text: str, lines: list[int] | None, spans: list | None) -> str:
    """`text` without the lines, and without the words of the spans (start, n_words); a line that loses all its words goes."""
    gone, out, at = set(lines or ()), [], 0
    dropped = {k for s in spans or () for k in range(s["start"], s["start"] + s["n_words"])}
    for i, line in enumerate(text.split("\n")):
        found = list(re.finditer(WORD, line))
        stay = [k for k in range(len(found)) if at + k not in dropped]
        at += len(found)
        if i in gone or (found and not stay):
            continue
        if len(stay) < len(found):
            # every word keeps the white space before it
            line = "".join(line[found[k - 1].end() if k else 0 : found[k].end()] for k in stay) + line[found[-1].end() :]
        out.append(line)
    return "\n".join(out)


def without_repeats(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """`docs` with the removed lines and passages taken out of the texts; other columns stay."""
    gone = stored(repeats(docs, similarity).where("removed"), "paragraph-removed")
    per_text = gone.groupBy("doc_id", "mark").agg(
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("whole"), F.sequence("first", "last"))))).alias("gone"),
        F.collect_list(F.when(~F.col("whole"), F.struct("start", "n_words"))).alias("spans"),
    )
    its_id, its_mark, gone_name, spans_name = (fresh(docs.columns, x) for x in ("__id", "__mark", "__gone", "__spans"))
    per_text = stored(per_text.withColumnsRenamed({"doc_id": its_id, "mark": its_mark, "gone": gone_name, "spans": spans_name}), "paragraph-removals")
    met = docs.join(per_text, docs["doc_id"].eqNullSafe(F.col(its_id)) & (_mark(F.col("text")) == F.col(its_mark)), "left")
    left = F.udf(lambda text, lines, spans: text if lines is None and spans is None else _left(text, lines, spans), "string")
    return met.select(*[left("text", gone_name, spans_name).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
