"""Token counts by a two-tier lookup of pre-token lengths, without shuffling pre-tokens.

First tier: a table of the frequent pre-tokens and their number of tokens, counted over all documents
with summaries of bounded size per task, and broadcast. Second tier: what the table lacks is
encoded by the tokenizer inside the worker and kept in a cache of bounded size. Neither tier can change
a count; they only save encoding.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerspan.llm.common import commonest, stored

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
FREQUENT = 32_768  # entries of the broadcast table (about 2 MB)
SUMMARY = 4_096  # entries that a task's summary may report
HELD = 1 << 17  # entries that a task counts before it prunes
CACHED = 1 << 20  # entries that a worker caches besides (about 100 MB)
# Fixed value: how a byte-level BPE tokenizer of this kind cuts a text.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters on whose class every Unicode version agrees; a text with any other is cut by the tokenizer's own rule, which is slower.
PLAIN = r"[\t\n\r\x20-\x7e¡-ɏ]*"


def plain_pre_token() -> str:
    """PRE_TOKEN for plain texts in the classes of `re`, which cuts them twice as fast as `regex`.

    Letters and numbers come first: a pre-token that begins with a quote begins with none of them.
    """

    def span(kind: str) -> str:
        return "".join(rf"\u{o:04x}" for o in range(0x250) if re.fullmatch(PLAIN, chr(o)) and unicodedata.category(chr(o))[0] == kind)

    letters, numbers = span("L"), span("N")
    return rf" ?[{letters}]+| ?[{numbers}]+|'(?:[stmd]|re|ve|ll)| ?[^\s{letters}{numbers}]+|\s+(?!\S)|\s+"


_KEPT: dict[str, object] = {}


def _per_process(what: str, make):
    """What `make` returns, made once per Python worker: worker processes outlive their tasks."""
    if what not in _KEPT:
        _KEPT[what] = make()
    return _KEPT[what]


def _require_byte_level(path: str) -> None:
    """Refuse a tokenizer that does not cut texts the way PRE_TOKEN does."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    cut = content.get("pre_tokenizer") or {}
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or content.get("normalizer") is not None:
        raise ValueError(f"{path}: not a byte-level tokenizer without normalizer and prefix space")


def _tools(path: str):
    """The tokenizer, and a function that cuts a text into pre-tokens, or says None where special strings must be told apart first."""

    def load():
        from tokenizers import Tokenizer

        _require_byte_level(path)
        tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        find, plain, own = re.compile(plain_pre_token()).findall, re.compile(PLAIN).fullmatch, tokenizer.pre_tokenizer.pre_tokenize_str

        def cut(text: str) -> list[str] | None:
            if any(s in text for s in special):
                return None
            return find(text) if plain(text) else [text[a:b] for _, (a, b) in own(text)]

        return tokenizer, cut

    return _per_process(f"tools {path}", load)


def default_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _summary(path: str):
    """Per task: the counts of its commonest pre-tokens, at most SUMMARY rows, from at most HELD counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cut = _tools(path)
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text and (pieces := cut(text)) is not None:
                    counts.update(pieces)
                    if len(counts) > HELD:
                        counts = Counter(dict(counts.most_common(HELD // 2)))
        top = counts.most_common(SUMMARY)
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    return run


def frequent(docs: DataFrame, path: str, size: int = FREQUENT) -> dict[str, int]:
    """Number of tokens of each of the commonest pre-tokens, at most `size`."""
    summaries = docs.select("text").mapInArrow(_summary(path), "piece string, n long")
    pieces = [r["piece"] for r in commonest(stored(summaries.groupBy("piece").agg(F.sum("n").alias("n")), "pre-tokens"), "n", size).collect()]
    tokenizer = _tools(path)[0]
    return {p: len(e.ids) for p, e in zip(pieces, tokenizer.encode_batch(pieces, add_special_tokens=False))} if pieces else {}


class Lengths(dict):
    """Lengths by pre-token: the broadcast table, and what the worker has encoded besides, up to CACHED entries."""

    def __init__(self, table: dict[str, int], tokenizer):
        super().__init__(table)
        self.table, self.tokenizer = table, tokenizer

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(self) >= CACHED + len(self.table):
            self.clear()
            self.update(self.table)
        self[piece] = n
        return n


def counter(path: str, table):
    """Function from text to its number of tokens; `table` is the broadcast of `frequent`."""
    tokenizer, cut = _tools(path)
    # one per worker: what it has encoded outlives the task, and a later table only adds to it
    lengths = _per_process(f"lengths {path}", lambda: Lengths(table.value, tokenizer))
    if lengths.table is not table.value:
        lengths.table = table.value
        lengths.update(table.value)

    def count(text: str | None) -> int:
        if not text:
            return 0
        pieces = cut(text)
        if pieces is None:
            return len(tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(lengths.__getitem__, pieces))

    return count


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row, in whole texts, as the tokenizer's library counts.

    Null and empty texts have no bytes and no tokens. Strings of special tokens inside a text count as the
    library counts them by default (one token); only texts with such a string are encoded whole. Repeated rows count alike; an empty table gives none.
    """
    path = path or default_path()
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs, path))

    @F.pandas_udf(T.LongType())
    def n_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(path, table)
        for batch in texts:
            yield pd.Series([count(t) for t in batch], dtype="int64")

    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n_tokens("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
