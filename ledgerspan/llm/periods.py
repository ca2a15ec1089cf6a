"""Periodic runs: stretches of words that repeat with a period, found tile by tile.

Periods are taken by octaves. For an octave a text is cut into overlapping tiles around boundaries that stand
so close that every run of one of its periods holds one. Tiles are solved independently: the Z-functions of the words
after and before the boundary say, for every period of the octave, how far words one period apart go on being equal
on both sides. A tile that no period can fill is left out by a few vectorised comparisons. The interval
fragments of a stretch of neighbouring tiles are joined, sent by document and period, and stitched; of
intervals with the same ends the smallest period is the run's.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerspan.llm.common import let, stored, words_of

LEAST = 12  # words of a run, besides twice its period
QUICK = 16  # words that the first comparison looks at on each side
GROUP = 500_000  # words that are solved together
PAIRS = 1 << 21  # of boundary and period, compared at once
STRETCH = 64  # tiles whose fragments are joined before the shuffle


def needed(period: int | np.ndarray) -> int | np.ndarray:
    """How many successive words must equal the word one period on."""
    return np.maximum(period, LEAST - period)


def z_values(s: list[int]) -> list[int]:
    """For every place of `s` the length of the longest prefix of `s` that stands there."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    z[0] = n
    return z


def solve_tile(words: list[int], at: int, periods: range, reach: int) -> list[tuple[int, int, int]]:
    """(period, first, end) of the places around the boundary `at` from which the word one period on is equal, `reach` places at most on each side."""
    n = len(words)
    low, high = periods[0], min(periods[-1], n - 1 - at)
    if high < low:
        return []
    after = z_values(words[at : at + high + reach])
    # the words before the boundary, backwards, against those before boundary + period, backwards; -1 is no word
    start = max(0, at - reach)
    back = words[start:at][::-1]
    before = z_values([*back, -1, *words[start : at + high][::-1]])
    out = []
    for p in range(low, high + 1):
        forward = min(after[p], reach)
        backward = min(before[len(back) + 1 + high - p], len(back))
        if forward and forward + backward >= needed(p):
            out.append((p, at - backward, at + forward))
    return out


def octaves(longest: int) -> Iterator[tuple[range, int]]:
    """(periods, distance of boundaries) up to half of the longest text."""
    low = 1
    while 2 * low <= longest:
        periods = range(low, 2 * low)
        yield periods, int(min(needed(p) for p in periods))
        low *= 2


def _live(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, periods: range, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, boundary) of the tiles in which some period could fill a run, by a look at QUICK words on each side."""
    sizes = ends - starts
    of = np.flatnonzero(sizes >= max(LEAST, 2 * periods[0]))
    counts = -(-(sizes[of] - periods[0]) // step)
    text = np.repeat(of, counts)
    place = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    rows, offsets = max(1, PAIRS // len(periods)), np.array(periods)
    need = np.minimum(needed(offsets), QUICK)
    kept = []
    for i in range(0, len(text), rows):
        b, end = starts[text[i : i + rows]] + place[i : i + rows], ends[text[i : i + rows]]
        for part in range(0, len(offsets), PAIRS):
            p = offsets[part : part + PAIRS]
            there = b[:, None] + p
            row, col = np.nonzero((words.take(there, mode="clip") == words[b][:, None]) & (there < end[:, None]))
            one, two, want, total = b[row], there[row, col], need[part + col], np.ones(len(row), np.int32)
            for direction in (1, -1):
                going = np.arange(len(row))
                for k in range(1, QUICK):
                    going = going[words[one[going] + k * direction] == words[two[going] + k * direction]]
                    if not len(going):
                        break
                    total[going] += 1
            kept.append(i + np.unique(row[total >= want]))
    live = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
    return text[live], place[live]


def _joined(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of a period that overlap or touch become one."""
    out: list[tuple[int, int, int]] = []
    for p, a, b in sorted(found):
        if out and out[-1][0] == p and a <= out[-1][2]:
            out[-1] = (p, out[-1][1], max(out[-1][2], b))
        else:
            out.append((p, a, b))
    return out


def fragments(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """For each text the (period, first, end) of its tiles, joined over STRETCH tiles."""
    number = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    # every text ends with a mark that equals nothing, so that no comparison goes on into the next one
    words = np.empty(sizes.sum() + len(texts) + 2 * QUICK, np.int64)
    words[-2 * QUICK :] = -2 - len(texts)
    starts = np.cumsum(sizes + 1) - sizes + QUICK - 1
    words[:QUICK] = -1
    for i, (t, a) in enumerate(zip(texts, starts.tolist())):
        words[a : a + len(t)] = np.fromiter(map(number.__getitem__, t), np.int64, len(t))
        words[a + len(t)] = -2 - i
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for periods, step in octaves(int(sizes.max(initial=0))):
        text, place = _live(words, starts, starts + sizes, periods, step)
        cuts = np.flatnonzero(np.diff(text, prepend=-1) | np.diff(place // (step * STRETCH), prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(text)]):
            own = words[starts[text[a]] : starts[text[a]] + sizes[text[a]]]
            found = []
            for at in place[a:b].tolist():
                # the tile: what its boundary reaches, and a period more
                reach = 2 * step
                first = max(0, at - reach)
                tile = own[first : at + 2 * periods[0] + reach].tolist()
                found += [(p, first + x, first + y) for p, x, y in solve_tile(tile, at - first, periods, reach)]
            out[text[a]] += _joined(found)
    return out


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every text the number of its words, the hash of its words joined by blanks, and where it has fragments these and the words."""
    kind = pa.list_(pa.struct([("period", pa.int32()), ("first", pa.int32()), ("end", pa.int32())]))
    names = ["n_words", "plain_sha256", "words", "fragments"]

    def solved(texts: list[list[bytes]]) -> list[pa.Array]:
        found, plain = fragments(texts), [b" ".join(t) for t in texts]
        return [
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in plain], pa.string()),
            pa.array([t if f else None for t, f in zip(plain, found)], pa.binary()),
            pa.array([[{"period": p, "first": a, "end": b} for p, a, b in f] for f in found], kind),
        ]

    for batch in batches:
        held, total, done = [], 0, 0
        for value in batch.column(0):
            text = value.as_py()
            held.append((text or "").encode("utf-8", "surrogatepass").split())
            total += len(held[-1])
            if total > GROUP:
                yield pa.RecordBatch.from_arrays([*[c.slice(done, len(held)) for c in batch.columns[1:]], *solved(held)], [*batch.schema.names[1:], *names])
                done, held, total = done + len(held), [], 0
        if held:
            yield pa.RecordBatch.from_arrays([*[c.slice(done, len(held)) for c in batch.columns[1:]], *solved(held)], [*batch.schema.names[1:], *names])


def stitched(pieces: DataFrame) -> DataFrame:
    """(row, start, length, period) of the runs, from fragments (row, period, first, end).

    A window over a document's period holds a row per stretch of tiles at most.
    """
    by_place = Window.partitionBy("row", "period").orderBy("first", "end")
    before = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.withColumn("new", F.when(before >= F.col("first"), 0).otherwise(1))
    numbered = marked.withColumn("stretch", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("row", "period", "stretch").agg(F.min("first").alias("start"), F.max("end").alias("end"))
    long_enough = whole.where(F.col("end") - F.col("start") >= F.greatest(F.col("period"), LEAST - F.col("period")))
    length = F.col("end") - F.col("start") + F.col("period")
    return long_enough.groupBy("row", "start", length.alias("length")).agg(F.min("period").alias("period"))


RUNS = "array<struct<start:int,period:int,length:int>>"


@F.pandas_udf(T.StringType())
def collapsed(words: pd.Series, runs: pd.Series) -> pd.Series:
    """`words`, joined by blanks, without those that any run holds after its first period."""

    def left(text: bytes | None, found) -> str | None:
        if text is None:
            return None
        kept = text.split()
        keep = np.ones(len(kept), bool)
        for r in found if found is not None else ():
            keep[r["start"] + r["period"] : r["start"] + r["length"]] = False
        return b" ".join([w for w, k in zip(kept, keep.tolist()) if k]).decode("utf-8", "surrogatepass")

    return pd.Series([left(t, f) for t, f in zip(words, runs)], dtype=object)


def tiled(docs: DataFrame) -> DataFrame:
    """Stored rows of every document: row, doc_id, n_words, plain_sha256, and words and fragments where there are any."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, plain_sha256 string, words binary, fragments array<struct<period:int,first:int,end:int>>"
    return stored(docs.select("text", "doc_id").mapInArrow(_tiled, schema).withColumn("row", F.monotonically_increasing_id()), "tiles")


def runs_of(tiles: DataFrame) -> DataFrame:
    """(row, runs) of the documents with runs, ordered by start, then period."""
    pieces = tiles.select("row", F.inline("fragments"))
    each = stitched(pieces)
    return each.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of every document, and its text without their repetitions, null where that is as it was.

    A run is a stretch of words with smallest period q, of max(12, 2 q) words or more, that no neighbouring word
    extends. Null and empty texts have none; repeated rows have theirs each; an empty table gives no rows. Runs of one
    document are collected: they are no more than its words.
    """
    tiles = tiled(docs)
    found = runs_of(tiles).withColumnRenamed("row", "of")
    left = stored(tiles.join(found, F.col("row") == F.col("of"), "left").select("doc_id", "n_words", "plain_sha256", "words", F.coalesce("runs", F.array().cast(RUNS)).alias("runs")), "runs")
    text = collapsed(F.when(F.size("runs") > 0, F.col("words")), F.col("runs"))
    return left.select("doc_id", "n_words", "plain_sha256", "runs", text.alias("collapsed"))


def planted(doc_id: Column, text: Column) -> Column:
    """The words of a tenth of the documents, by the hash of the id, repeat from some word on; other texts stay.

    With h = crc32(id) and g = h / 10, words from a = g % n on repeat with period 1 + (n - a) / (3 + g % 8), if h % 10 is 0. A
    null id chooses no document.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words)
        first = (g % n).cast("int")
        place = F.struct(first.alias("a"), (1 + F.floor((n - first) / (3 + g % 8))).cast("int").alias("p"))
        return let(place, lambda at: F.array_join(F.transform(words, lambda w, i: F.when(i < at["a"], w).otherwise(F.get(words, at["a"] + (i - at["a"]) % at["p"]))), " "))

    words = words_of(text)
    return F.when((h % 10 == 0) & (F.size(words) > 0), let(words, repeat)).otherwise(text)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_runs, the longest run (start, length, period, exponent_milli; ties: least start, then period; null without runs), and
    the hashes of all runs and of the collapsed text."""
    r = runs(docs)
    best = F.try_element_at(F.array_sort(F.transform("runs", lambda x: F.struct((-x["length"]).alias("shorter"), x["start"].alias("start"), x["period"].alias("period")))), F.lit(1))
    listed = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    length = -F.col("best.shorter")
    return r.withColumn("best", best).select(
        "doc_id",
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").cast("long").alias("start"),
        length.cast("long").alias("length"),
        F.col("best.period").cast("long").alias("period"),
        F.floor(1000 * length.cast("long") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.coalesce(F.sha2(F.col("collapsed").cast("binary"), 256), F.col("plain_sha256")).alias("collapsed_sha256"),
    )
