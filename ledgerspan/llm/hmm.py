"""A hidden Markov language model, trained by Baum-Welch over all documents, with exact scores.

A state emits a word class, and the class its word, by the word's share of the corpus counts:
P(word | state) = P(class | state) * P(word | class). Each of the OWN commonest words is a class of
its own; the others fall into classes by spelling; the end of a text is a class. So the forward
recursion needs only classes, which a broadcast table of bounded size gives inside the task, and the rest
of the likelihood is a sum over words, for which only the words outside that table are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.llm.common import commonest, crc_remainder, stored

STATES = 6
ROUNDS = 4
OWN = 8_192  # commonest words, with a class of their own
FREQUENT = 65_536  # commonest words whose counts are broadcast (about 6 MB); only the others are shuffled
SPELLING = 1_024  # classes of all other words
ABREAST = 1_024  # documents that go through a recursion side by side
CELLS = 1 << 19  # tokens of these with their padding, where a recursion keeps STATES + 1 doubles of each
BARE = 1 << 22  # the same, where it keeps nothing of them
HELD = 1 << 19  # distinct words that a task counts before it hands them on
DIVISOR, HELD_OUT = 7, 2
FLOOR = 0.05  # added to every expected count
SEED = 7
END = "\n"  # stands for the end among counted words; no word holds white space


def held_out(doc_id: Column) -> Column:
    return crc_remainder(doc_id, DIVISOR) == HELD_OUT


def words_in(text: str | None) -> list[bytes]:
    """Words between ASCII white space with A-Z lower-cased (bytes know no other case)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def spelling(word: bytes) -> int:
    """The class of an infrequent word, by its first two and last two bytes."""
    key = word[:2] + word[-2:]
    value = 0
    for b in key:
        value = (value * 257 + b + 1) % 1_000_003
    return value % SPELLING


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(words_in(text))
        counts[END.encode()] += batch.num_rows
        if len(counts) > HELD:
            yield out(counts)
            counts = Counter()
    yield out(counts)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the texts of `docs`, words as bytes; the end of each text counts as a token."""
    partial = docs.select("text").mapInArrow(_counted, "word binary, n long")
    return stored(partial.groupBy("word").agg(F.sum("n").alias("c")), "word-counts")


@dataclass
class Classes:
    """The commonest words with class and count, per class its tokens and distinct words, and N and V."""

    frequent: dict[bytes, tuple[int, int]]
    tokens: np.ndarray
    kinds: np.ndarray
    total: int
    distinct: int

    def share(self) -> np.ndarray:
        return (self.tokens + 1.0) / (self.tokens + 1.0).sum()


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens and distinct words of each spelling class, per task."""
    for batch in batches:
        words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        at = np.fromiter((spelling(w) for w in words), np.int64, len(words))
        tokens = np.bincount(at, weights=counts, minlength=SPELLING).astype(np.int64)
        kinds = np.bincount(at, minlength=SPELLING).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SPELLING)), pa.array(tokens), pa.array(kinds)], ["class", "tokens", "kinds"])


def classes(counts: DataFrame, own: int = OWN, frequent: int = FREQUENT) -> Classes:
    """Classes from the counts of all training words. Class 0 is the end, then come the spellings, then
    the words of their own. `frequent` bounds what the driver collects."""
    row = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    end = F.col("word") == F.lit(END).cast("binary")
    top = sorted(commonest(counts.where(~end), "c", frequent).collect(), key=lambda r: (-r["c"], bytes(r["word"])))
    ends = counts.where(end).collect()
    spelled = counts.where(~end).mapInArrow(_spelled, "class long, tokens long, kinds long")
    sums = spelled.groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).collect()
    own = min(own, len(top))
    tokens, kinds = np.zeros(1 + SPELLING + own, np.int64), np.zeros(1 + SPELLING + own, np.int64)
    tokens[0], kinds[0] = (ends[0]["c"], 1) if ends else (0, 1)
    for r in sums:
        tokens[1 + r["class"]], kinds[1 + r["class"]] = r["tokens"], r["kinds"]
    known = {}
    for i, r in enumerate(top):
        word, at = bytes(r["word"]), 1 + spelling(bytes(r["word"]))
        if i < own:
            tokens[at] -= r["c"]
            kinds[at] -= 1
            at = 1 + SPELLING + i
            tokens[at], kinds[at] = r["c"], 1
        known[word] = (at, r["c"])
    return Classes(known, tokens, kinds, row["n"] or 0, row["v"])


@dataclass
class Model:
    start: np.ndarray  # K
    move: np.ndarray  # K x K
    emit: np.ndarray  # K x classes


def initial(share: np.ndarray, states: int = STATES, seed: int = SEED) -> Model:
    """The corpus shares of the classes, disturbed at random per state, with states that tend to stay."""
    rng = np.random.default_rng(seed)
    emit = share * rng.gamma(1.0, 1.0, (states, len(share))) + 1e-3 * share
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1.0 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def _abreast(sequences: list[np.ndarray], cells: int):
    """Time-major padded arrays of sequences of like length, up to ABREAST of them and `cells` tokens: (places, classes T x B, lengths)."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    while order:
        longest = len(sequences[order[0]])
        # one very long text doesn't pad many short ones: those below an eighth of its length wait
        now = [j for j in order[: max(1, min(ABREAST, cells // max(longest, 1)))] if len(sequences[j]) * 8 >= longest]
        lengths = np.array([len(sequences[j]) for j in now])
        padded = np.zeros((longest, len(now)), np.int32)
        for b, j in enumerate(now):
            padded[: lengths[b], b] = sequences[j]
        yield now, padded, lengths
        order = order[len(now) :]


def forward(model: Model, padded: np.ndarray, lengths: np.ndarray, entry: np.ndarray):
    """Scaled forward recursion from the states expected at the first token (B x K): alphas (T x B x K, each step summing to 1) and scales (T x B, 1 past the end)."""
    steps, width = padded.shape
    emit = np.ascontiguousarray(model.emit.T)
    alphas, scales = np.zeros((steps, width, len(model.start))), np.ones((steps, width))
    now = None
    active = (lengths[None, :] > np.arange(steps)[:, None]).sum(1)  # longest first: a prefix is active
    for t in range(steps):
        n = active[t]
        now = (entry[:n] if t == 0 else now[:n] @ model.move) * emit[padded[t, :n]]
        scale = now.sum(1)
        now = now / scale[:, None]
        alphas[t, :n], scales[t, :n] = now, scale
    return alphas, scales


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each class sequence."""
    out = np.zeros(len(sequences))
    emit = np.ascontiguousarray(model.emit.T)
    for places, padded, lengths in _abreast(sequences, BARE):
        steps = len(padded)
        active = (lengths[None, :] > np.arange(steps)[:, None]).sum(1)
        total, now = np.zeros(len(places)), None
        for t in range(steps):
            n = active[t]
            now = (model.start if t == 0 else now[:n] @ model.move) * emit[padded[t, :n]]
            scale = now.sum(1)
            now = now / scale[:, None]
            total[:n] += np.log10(scale)
        out[places] = total
    return out


SEGMENT = 2_048


def _through(model: Model, pieces: list[np.ndarray], first: list[bool]) -> np.ndarray:
    """For every piece a matrix, up to a factor: from the state before it to the state at its end (rows alike in a text's first piece)."""
    states = len(model.start)
    emit, out = np.ascontiguousarray(model.emit.T), np.zeros((len(pieces), states, states))
    for places, padded, lengths in _abreast(pieces, BARE):
        active = (lengths[None, :] > np.arange(len(padded))[:, None]).sum(1)
        begin = np.where(np.array([first[j] for j in places])[:, None, None], model.start, model.move)
        now = begin
        for t in range(len(padded)):
            n = active[t]
            if t and n < len(now):
                out[[places[b] for b in range(n, len(now))]] = now[n:]
            now = (now[:n] if t == 0 else now[:n] @ model.move) * emit[padded[t, :n]][:, None, :]
            now = now / now.sum((1, 2))[:, None, None]
        out[places[: len(now)]] = now
    return out


def _joints(model: Model, pieces: list[np.ndarray], groups: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every piece the states before it (of later pieces), the states expected at its first token, and the weights of its last state by what follows it.

    Texts of one piece start from `model.start` and end freely. In longer ones the pieces' matrices carry the
    forward vector over every cut, and what follows back to it, so no count knows of the cuts.
    """
    entry, exits = np.tile(model.start, (len(pieces), 1)), np.ones((len(pieces), len(model.start)))
    before = np.zeros_like(entry)
    long = [g for g in groups if len(g) > 1]
    inside = [j for g in long for j in g]
    heads = {g[0] for g in long}
    through = dict(zip(inside, _through(model, [pieces[j] for j in inside], [j in heads for j in inside])))
    for group in long:
        ends = []
        for j in group:
            now = through[j][0] if not ends else ends[-1] @ through[j]
            ends.append(now / now.sum())
        for j, end in zip(group[1:], ends):
            before[j], entry[j] = end, end @ model.move
        for k in range(len(group) - 2, -1, -1):
            after = through[group[k + 1]] @ exits[group[k + 1]]
            exits[group[k]] = after / (ends[k] @ after)
    return before, entry, exits


def expected(model: Model, sequences: list[np.ndarray], segment: int = SEGMENT):
    """Baum-Welch counts (starts, moves, emissions) of some sequences, whole ones.

    The recursions run over pieces of `segment` tokens, which bounds their memory; `_joints` makes the pieces of a text
    one sequence again.
    """
    pieces, groups = [], []
    for s in sequences:
        cuts = range(0, len(s), segment)
        groups.append(list(range(len(pieces), len(pieces) + len(cuts))))
        pieces += [s[i : i + segment] for i in cuts]
    first = {g[0] for g in groups if g}
    before, entry, exits = _joints(model, pieces, groups)
    states = len(model.start)
    starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((model.emit.shape[1], states))
    emit = np.ascontiguousarray(model.emit.T)
    for places, padded, lengths in _abreast(pieces, CELLS):
        alphas, scales = forward(model, padded, lengths, entry[places])
        steps, outside = len(padded), exits[places]
        active = (lengths[None, :] > np.arange(steps)[:, None]).sum(1)
        beta = outside.copy()
        for t in range(steps - 1, -1, -1):
            n = active[t]
            gamma = alphas[t, :n]
            gamma *= beta[:n]  # nothing reads these alphas again; past the ends they stay 0
            onward = emit[padded[t, :n]] * beta[:n] / scales[t, :n, None]
            if t:
                moves += alphas[t - 1, :n].T @ onward
                beta = outside.copy()
                beta[:n] = onward @ model.move.T
            else:
                heads = np.array([j in first for j in places[:n]])
                starts += gamma[heads].sum(0)
                if not heads.all():
                    moves += before[[places[b] for b in np.flatnonzero(~heads)]].T @ onward[~heads]
        at = padded.ravel()
        for k in range(states):
            emits[:, k] += np.bincount(at, weights=alphas[:, :, k].ravel(), minlength=len(emits))
    return starts, moves * model.move, emits.T


def _prepared(sent) -> object:
    """Per document: its classes, number of tokens, what words of the broadcast table add to both scores,
    and its other words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, tokens, kinds, total, distinct = sent.value
        spread = math.log10(total + distinct + 1)
        within = np.log10(tokens + kinds + 1.0)  # a class's tokens, each of its words once more, and one unseen
        first_own = 1 + SPELLING
        table = {w: (at, math.log10(c + 1), 0.0 if at >= first_own else math.log10(c + 1) - within[at]) for w, (at, c) in frequent.items()}
        lookup, end = table.get, math.log10(tokens[0] + 1)
        for batch in batches:
            rows = ([], [], [], [], [], [], [])
            for text in batch.column("text").to_pylist():
                own = words_in(text)
                place, missing, known, base, model = {}, {}, int(tokens[0] > 0), end, 0.0
                for w, c in Counter(own).items():
                    hit = lookup(w)
                    if hit is None:
                        place[w] = at = 1 + spelling(w)
                        missing[w] = c
                        model -= c * within[at]
                    else:
                        place[w] = hit[0]
                        known += c
                        base += c * hit[1]
                        model += c * hit[2]
                sequence = np.zeros(len(own) + 1, np.uint16)  # the last stays 0, the end
                sequence[:-1] = list(map(place.__getitem__, own))
                n = len(own) + 1
                for column, value in zip(rows, (sequence.tobytes(), n, known, base - n * spread, model, list(missing), list(missing.values()))):
                    column.append(value)
            types = (pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            made = [pa.array(c, t) for c, t in zip(rows, types)]
            names = ["row", "doc_id", "learn", "classes", "n_tokens", "known", "base", "model", "words", "times"]
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in names[:3]] + made, names)

    return run


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint16).astype(np.int32) for b in column.to_pylist()]


def _counts_of(sent) -> object:
    """Per task, one row per count that isn't zero; `at` numbers starts, moves and emissions in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = Model(*sent.value), None
        for batch in batches:
            if batch.num_rows:
                part = np.concatenate([x.ravel() for x in expected(model, _sequences(batch.column(0)))])
                total = part if total is None else total + part
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    return run


def train(sequences: DataFrame, share: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the column `classes`: each round sums the expected counts of all tasks. What reaches
    the driver has the model's own size, states * (states + classes + 1), whatever the corpus."""
    context, model, n = sequences.sparkSession.sparkContext, initial(share, states), len(share)
    for _ in range(rounds):
        sent = context.broadcast((model.start, model.move, model.emit))
        rows = sequences.select("classes").mapInArrow(_counts_of(sent), "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        flat = np.zeros(states + states * states + states * n)
        flat[rows["at"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
        starts, moves = flat[:states] + FLOOR, flat[states : states + states * states].reshape(states, states) + FLOOR
        # the floor is shared by the corpus, so that every state can emit every class
        emits = flat[states + states * states :].reshape(states, n) + FLOOR * n * share
        model = Model(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(1, keepdims=True))
    return model


def _likelihoods(sent) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            at = batch.schema.get_field_index("classes")
            found = pa.array(log_likelihoods(model, _sequences(batch.column(at))))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns) if i != at], found], [*[x for x in batch.schema.names if x != "classes"], "sequence"])

    return run


def report(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    base_score is the add-one unigram of the training tokens. score is log10 of the model's probability of
    the whole text: the exact likelihood of its classes plus, per word of a spelling class,
    log10((c + 1) / (tokens of the class + its distinct words + 1)). Null and empty texts are their end
    alone. Repeated rows are scored alike; without training rows every word is unseen.
    """
    context = docs.sparkSession.sparkContext
    learn = ~held_out(F.col("doc_id"))
    counts = word_counts(docs.where(learn))
    k = classes(counts)
    sent = context.broadcast((k.frequent, k.tokens, k.kinds, k.total, k.distinct))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", learn.alias("learn"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, learn boolean, classes binary, n_tokens long, known long, base double, model double, words array<binary>, times array<long>"
    prepared = stored(rows.mapInArrow(_prepared(sent), schema), "hmm-documents")
    model = train(prepared.where("learn"), k.share(), states, rounds)
    best = context.broadcast((model.start, model.move, model.emit))
    rare = prepared.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    met = rare.join(counts, "word")
    sums = met.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs"))
    thin = prepared.select("row", "doc_id", "learn", "classes", "n_tokens", "known", "base", "model")
    scored = thin.mapInArrow(_likelihoods(best), f"row long, doc_id {kind}, learn boolean, n_tokens long, known long, base double, model double, sequence double")
    joined = scored.join(sums, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return joined.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(k.total).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"), (F.col("sequence") + F.col("model") + logs).alias("score"),
    )
