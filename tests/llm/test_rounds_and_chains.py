"""WARC records, periodic runs and centroid clusters against brute-force versions."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_frames import frame
from pyspark.sql import functions as F

from ledgerspan.llm import centroids, periods, warc

# 11


def expected_records(rows, least=0):
    groups, out = {}, []
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids.sort(key=lambda i: (i is not None, i or 0))
        whole = ids if len(payload) < least else [ids.pop()]
        out += [(i, len(payload), digest, "response", None) for i in whole]
        if whole is not ids:
            out += [(i, len(payload), digest, "revisit", whole[0]) for i in ids]
    return sorted(out, key=str)


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, "u", "x"), (2, None, "x"), (3, "a b\r\nc", "y" + FAKE + FAKE), (4, "u", None), (5, "u", ""), (6, "u", FAKE), (7, "u", "WARC/1.0\r\n"),
    (8, "u", "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 100000\r\n\r\n"), (None, "u", "x"), (None, "u", "q"), (None, "u", "q"),
    (9, "u", "é中\U0001f600" + FAKE), (10, "u", "r"), (10, "u", "r"), (10, "u", "s"), (11, "u", FAKE * 300), (12, "u", FAKE * 300), (13, "u", "long " * 200_000),
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("block, least", [("128m", 0), ("128m", 2), ("5000b", 0)])
def test_records_with_opening_lines_in_payloads(spark, block, least):
    rng = random.Random(0)
    parts = [FAKE, "WARC/1.0\r\n", "text ", "\r\n\r\n", "\r\n", "é" * 7]
    rows = PAGES[:-1] + [(100 + i, "u", "".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for i in range(100)]
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for name, value in zip(names, (block, "1b")):
            spark.conf.set(name, value)
        got = warc.report(pages(spark, rows).coalesce(1), least).collect()
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    assert sorted((tuple(r) for r in got), key=str) == expected_records(rows, least)


def test_archives_hold_their_payloads_and_break_where_a_length_is_wrong(spark, tmp_path):
    folder = f"{tmp_path}/archives"
    warc.write_archives(pages(spark, PAGES).orderBy("page_id").coalesce(1), folder)
    blocks, records = warc.scan_archives(spark, folder)
    texts = {(r["path"], r["at"]): bytes(r["payload"]) for r in warc.payloads(spark, folder, blocks, records).collect()}
    whole = {r["id"]: texts[r["path"], r["at"]] for r in records.where("kind = 'response'").collect()}
    assert whole["3"] == ("y" + FAKE + FAKE).encode() and whole["13"] == b"long " * 200_000 and whole["7"] == b"WARC/1.0\r\n"
    assert {r["uri"] for r in records.collect()} == {"u", "a%20b%0D%0Ac", None}
    file = next(tmp_path.glob("archives/part-*"))
    content = file.read_bytes()
    assert sum(content.startswith(b"WARC/1.0\r\n", r["at"]) for r in records.collect()) == len(PAGES)
    broken = tmp_path / "broken"
    broken.mkdir()
    at = sorted(r["at"] for r in records.collect())[5]
    length = content.index(b"Content-Length: ", at) + len(b"Content-Length: ")
    (broken / "part-0.txt").write_bytes(content[:length] + b"9" + content[length:])
    left = warc.scan_archives(spark, str(broken))[1].collect()
    assert [r["at"] for r in sorted(left, key=lambda r: r["at"])] == sorted(r["at"] for r in records.collect())[: 6 if left[-1]["next"] else 5]


def test_no_pages(spark):
    docs = pages(spark, PAGES[:1]).withColumns({c: F.lit("own") for c in ("value", "bytes", "hex", "keeper", "path", "at")})
    assert warc.report(docs.limit(0)).count() == 0
    assert [tuple(r) for r in warc.report(docs).collect()] == expected_records(PAGES[:1])


# 12


def brute_runs(words):
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i >= max(p, 12 - p):
                key = (i, j - i + p)
                found[key] = min(found.get(key, p), p)
            i = max(j, i + 1)
    return sorted((start, q, length) for (start, length), q in found.items())


def expected_runs(doc_id, text, plant=True):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    keep = [True] * n
    for start, q, length in runs:
        keep[start + q : start + length] = [False] * (length - q)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    longest = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    left = b" ".join(w for w, k in zip(words, keep) if k)
    return (doc_id, n, len(runs), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def repetitive(rng, kind, n):
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        base = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 40))]
        return [base[i % len(base)] if rng.random() > 0.01 else "z" for i in range(n)]
    if kind == 2:
        return ["a"] * n
    if kind == 3:
        words = []
        while len(words) < n:
            words += [rng.choice("abc") for _ in range(rng.randrange(1, 20))] * rng.randrange(1, 6)
        return words
    one, two = ["a"], ["a", "b"]
    while len(two) < n:
        one, two = two, two + one
    return two[:n]


def test_runs_of_repetitive_texts(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(repetitive(rng, i % 5, rng.randrange(250)))) for i in range(300)]
    rows += [(None, "é " * 40), (7, None), (8, ""), (9, " \n "), (10, "a b c " * 5), (10, "a b c " * 5), (11, "ünïcode 中文 \U0001f600 " * 4)]
    docs = frame(spark, rows)
    planted = docs.withColumn("text", periods.planted(F.col("doc_id"), F.col("text")))
    got = periods.report(planted).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((expected_runs(*r) for r in rows), key=str)
    assert sum(r["n_runs"] for r in got) > 1_000
    assert periods.report(docs.limit(0)).count() == 0


def test_runs_over_many_stretches_of_tiles(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(400)}" for _ in range(2_000)]
    texts = [base + base * 3 + base[:700], ["x"] * 5_000, base[:900] + ["y", "z"] * 2_000 + base[900:], [f"w{i * i % 9973}" for i in range(25_000)]]
    docs = frame(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    assert periods.tiled(docs).select(F.max(F.size("fragments"))).first()[0] > 10
    got = {r["doc_id"]: [(x["start"], x["period"], x["length"]) for x in r["runs"]] for r in periods.runs(docs).collect()}
    assert got[0] == [(0, 2_000, 8_700)] and got[1] == [(0, 1, 5_000)] and (900, 2, 4_000) in got[2]
    assert (0, 9_973, 25_000) in got[3]


def test_octaves_leave_no_period_out():
    for longest in (1, 2, 3, 24, 1_000):
        found = [p for ps, _ in periods.octaves(longest) for p in ps]
        assert found == list(range(1, len(found) + 1)) and len(found) >= longest // 2
    assert all(step <= periods.needed(p) for ps, step in periods.octaves(5_000) for p in ps)


# 13


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, whole string, cluster string")


def expected_clusters(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in e]) for i, e, *_ in rows if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    points = np.array([w for _, w in kept], np.int64).reshape(-1, 64)
    mark = lambda j: hashlib.sha256(f"3:{'' if kept[j][0] is None else kept[j][0]}".encode()).hexdigest()
    centers = points[sorted(range(len(kept)), key=lambda j: (mark(j), kept[j][1]))[:k]]
    near = lambda: ((points[:, None] - centers[None]) ** 2).sum(2)
    for _ in range(rounds if len(kept) else 0):
        number = near().argmin(1)
        for c in range(len(centers)):
            if (number == c).any():
                centers[c] = [int(s) // int((number == c).sum()) for s in points[number == c].sum(0)]
    if not kept:
        return []
    apart = near()
    number, least = apart.argmin(1), apart.min(1)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]
    return sorted(((i, int(c), int(d), int(least[number == c].sum()), int(least.sum()), digest[c]) for (i, _), c, d in zip(kept, number, least)), key=str)


def test_clusters_of_vectors(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(5, 64))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 5] + rng.normal(scale=0.3, size=64)], 0, "own", "own") for i in range(400)]
    rows += [(1_000 + i, [0.25] * 64, 0, "own", "own") for i in range(150)]  # copies, a quarter of all
    rows += [(2_000 + i, [float(i % 2)] * 64, None, None, None) for i in range(20)]
    bad = [None, [], [0.5] * 63, [0.5] * 65, [0.5] * 63 + [None], [0.5] * 63 + [float("nan")], [float("inf")] + [0.5] * 63, [None] * 64]
    rows += [(3_000 + i, e, 0, "own", "own") for i, e in enumerate(bad)]
    rows += [(None, [0.125] * 64, 0, "own", "own"), (7, rows[7][1], 0, "own", "own"), (7, [-0.3] * 64, 0, "own", "own")]
    got = centroids.report(vectors(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_clusters(rows)


def test_few_vectors_none_and_too_large_ones(spark):
    rows = [(i, [float(i % 2)] * 64, 0, "own", "own") for i in range(5)]
    assert sorted((tuple(r) for r in centroids.report(vectors(spark, rows)).collect()), key=str) == expected_clusters(rows)
    assert centroids.report(vectors(spark, rows).limit(0)).count() == 0
    with pytest.raises(Exception, match="vector 9 has a component beyond"):
        centroids.report(vectors(spark, [(9, [1e30] * 64, 0, "own", "own")]))


@pytest.mark.parametrize("k, spread", [(1, 5), (2, 5), (3, 2), (40, 3), (300, 30)])
def test_tree_finds_the_nearest_centroid_and_the_smaller_of_two(k, spread):
    rng = np.random.default_rng(k)
    for dimensions in (1, 2, 64):
        points, centers = rng.integers(-spread, spread, (500, dimensions)), rng.integers(-spread, spread, (k, dimensions))
        number, squared = centroids.nearest(centroids.vantage_tree(centers), centers, points)
        apart = ((points[:, None] - centers[None]) ** 2).sum(2)
        assert (number == apart.argmin(1)).all() and (squared == apart.min(1)).all()
