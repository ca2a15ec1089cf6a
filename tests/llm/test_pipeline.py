"""The pipeline against plain Python, stage by stage, on a small corpus."""

import hashlib
import importlib.util
import itertools
import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
import regex
import xxhash
from llm_frames import frame
from test_llm_operators import WORDS, brute_hits, brute_rules, edited, prose

from ledgerspan.llm import rules, sharding


def corpus():
    rng = random.Random(20)
    rows = []
    for i in range(240):
        text = prose(i, 60 + rng.randrange(120))
        if i % 12 == 5:
            text = " | ".join(text.split())
        if i % 12 == 7:
            text = prose(i, 20)
        if i % 12 == 9:
            text = prose(i, 30) + "\n" + prose(7000 + i % 3, 25).upper() + "\n" + prose(i + 500, 30)
        rows.append((i, text, "en" if i % 3 else "de", f"s{rng.randrange(5)}" if i % 11 else None))
    for i in range(40):
        rows.append((300 + i, edited(rows[12 * (i % 10)][1], i, i % 3), "en", "s1"))
    rows += [rows[0], (400, None, None, None), (None, prose(9000, 90), "en", "s2")]
    return rows, [(i, prose(7000 + i, 25)) for i in range(3)] + [(9, None)]


def distance(p, q):
    side = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x > 0)
    return math.sqrt(max(0.0, (side(p, q) + side(q, p)) / 2))


def kept_by_rules(rows):
    def shares(text):
        words = WORDS.findall(text)
        counts = [len(regex.findall(f"[{c}]", text)) for c in (rules.LOWER, *rules.CLASSES)]
        found = Counter(w.lower() for w in words)
        commons = [found[w] for w in rules.COMMON_WORDS]
        return (
            [c / len(text) for c in [*counts, len(text) - sum(counts)]] if text else [0.0] * rules.N_CLASSES,
            [c / len(words) for c in [*commons, len(words) - sum(commons)]] if words else [0.0] * (len(commons) + 1),
        )

    seen = [(r, shares(r[1] or ""), brute_rules(r[1])) for r in rows]
    per_language = defaultdict(list)
    for r, s, (*_, failed) in seen:
        if not failed:
            per_language[r[2]].append(s)
    means = {k: [[sum(c) / len(v) for c in zip(*(s[part] for s in v))] for part in (0, 1)] for k, v in per_language.items() if len(v) >= rules.GUARD_DOCS}
    out = []
    for r, s, (n, *_, failed) in seen:
        far = n >= rules.GUARD_WORDS and r[2] in means and (distance(s[0], means[r[2]][0]) > rules.MAX_CLASS_DISTANCE or distance(s[1], means[r[2]][1]) > rules.MAX_WORD_DISTANCE)
        if not failed and not far:
            out.append(r)
    return out


def one_of_each_group(rows):
    def value(text):
        w = (text or "").encode().lower().split()
        s = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    values, group = [value(r[1]) for r in rows], list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (values[i] ^ values[j]).bit_count() <= 4 and group[i] != group[j]:
            a, b = group[i], group[j]
            group = [a if g == b else g for g in group]
    best = {}
    for g, r in zip(group, rows):
        best[g] = min(best.get(g, r), r, key=lambda x: (x[0] is None, x[0] or 0))
    return list(best.values())


def mixed(rows):
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORDS.findall(r[1] or ""))
    order = sorted(s for s in size if s is not None) + [None] * (None in size)
    weight, target, open_, left = dict(zip(order, itertools.cycle((3.0, 1.0, 2.0)))), {}, set(order), 1.5 * sum(size.values())
    while True:
        share = {s: left / sum(weight[x] for x in open_) * weight[s] for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= sum(2.0 * size[s] for s in over)
        open_ -= over
    target |= share
    out = []
    for r in rows:
        rate = target[r[3]] / size[r[3]] if size[r[3]] else 0.0
        key = f"17:{'' if r[0] is None else r[0]}"
        draw = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
        out += [r] * (math.floor(rate) + (draw < rate - math.floor(rate)))
    return out


def shards_of(rows, limit):
    keys = []
    for r in rows:
        own = hashlib.md5((r[1] or "").encode()).hexdigest()
        digest = hashlib.md5(f"{'' if r[0] is None else r[0]}:{own}".encode()).hexdigest()
        keys.append((f"{int(digest[:15], 16):060b}", len((r[1] or "").encode())))
    out = []
    for key, _ in keys:
        depth = next(d for d in range(61) if sum(n for k, n in keys if k.startswith(key[:d])) <= limit)
        out.append(key[:depth])
    return out


@pytest.fixture(scope="module")
def pipeline():
    path = Path(__file__).resolve().parents[2] / "corpus_pipeline.py"
    spec = importlib.util.spec_from_file_location("corpus_pipeline", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_every_stage_and_the_whole(spark, pipeline, tmp_path, monkeypatch):
    rows, items = corpus()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(pipeline, "shards", lambda s, d, sf: sharding.assign(d, 4_000))
    monkeypatch.setattr(pipeline, "STAGES", [*pipeline.STAGES[:-1], ("sharding", pipeline.shards)])
    ids = lambda rs: sorted(((r[0] is None, r[0] or 0, r[1] or "") for r in rs))
    want = [kept_by_rules(rows)]
    want.append(one_of_each_group(want[-1]))
    want.append([r for r in want[-1] if not brute_hits(r[1], items)[4]])
    want.append(mixed(want[-1]))
    assert all(len(a) > len(b) for a, b in zip([rows, *want], want[:3])) and want[2]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        got.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        assert ids([(r["doc_id"], r["text"]) for r in docs.collect()]) == ids(want[k]), name
    final = pipeline.run(spark, str(tmp_path)).collect()
    shard = shards_of(want[3], 4_000)
    assert sorted((r["shard"], str(r["doc_id"])) for r in final) == sorted((s, str(r[0])) for s, r in zip(shard, want[3]))
