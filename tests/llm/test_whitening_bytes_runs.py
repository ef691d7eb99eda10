"""Whitening, the byte network and periodic runs against brute force, on small tables and on cases by hand."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import byte_convolution, periodic_runs, queries, whitening

WORD = re.compile("[^\x20\x09-\x0d]+")


# Whitening


@pytest.mark.parametrize(
    "matrix",
    [
        np.diag([4.0] * 5 + [1.0] * 20),
        np.eye(7),
        np.diag([1e9, 3.0, 3.0, 2.0, 1e-6]),
        np.array([[0.0, 1.0], [1.0, 0.0]]) + 2 * np.eye(2),
        np.cov(np.random.default_rng(5).normal(size=(400, 40)) * np.logspace(2, -2, 40), rowvar=False),
        np.cov(np.floor(np.random.default_rng(6).normal(size=(9, 30)) * 8), rowvar=False),
    ],
)
def test_leading_eigenpairs_are_those_of_a_dense_solver(matrix):
    values, vectors = whitening.leading(matrix, 12)
    true = np.linalg.eigvalsh(matrix)[::-1]
    assert len(values) == min(12, (true > 1e-12 * true.sum()).sum())
    assert np.abs(values - true[: len(values)]).max() < 1e-12 * true[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * true[0]


def test_inertia_counts_with_pivots_of_one_and_two():
    r = np.random.default_rng(2)
    for n in (1, 2, 5, 17):
        a = r.normal(size=(n, n))
        a = a + a.T
        np.fill_diagonal(a, 0)  # needs blocks of two
        values = np.linalg.eigvalsh(a)
        for shift in (0.0, *(values[:-1] + values[1:]) / 2):
            assert whitening.above(a, shift) == (values > shift).sum()


def plain_whitening(vectors):
    """x, n, S, exact deviations, and covariance in fractions rounded once."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(row[k] for row in x) for k in range(d)]
    z = [[Fraction(row[k]) - Fraction(s[k], n) for k in range(d)] for row in x]
    v = np.array([[float(sum(r[i] * r[j] for r in z) / n) for j in range(d)] for i in range(d)])
    return x, n, s, [sum((n * a - b) ** 2 for a, b in zip(row, s, strict=True)) for row in x], v, np.array([[float(c) for c in r] for r in z])


def by_vector(rows):
    out = {}
    for r in rows:
        out.setdefault(r["vec_id"], []).append(r)
    return {k: sorted(v, key=lambda r: r["component"]) for k, v in out.items()}


def test_whitening_of_the_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = by_vector(queries.QUERIES["op11_whitening_slices"](spark, sf_dir).collect())
    vectors = np.array([[float(c) for c in r["embedding"]] for r in table])
    x = np.floor(64 * vectors) + 1_000_000
    z = x - x.mean(axis=0)
    v = z.T @ z / len(z)
    values, turned = np.linalg.eigh(v)
    assert set(got) == {r["vec_id"] for r in table} and all([r["component"] for r in rows] == list(range(1, 33)) for rows in got.values())
    w = np.array([[r["whitened"] for r in got[t["vec_id"]]] for t in table])
    for k in range(32):
        plain = z @ turned[:, -1 - k] / np.sqrt(values[-1 - k])
        assert min(np.abs(plain - w[:, k]).max(), np.abs(plain + w[:, k]).max()) < 1e-6
    assert np.abs(np.cov(w.T, bias=True) - np.eye(32)).max() < 1e-8
    one = got[table[0]["vec_id"]]
    assert one[0]["n"] == len(table) and one[0]["identity_error"] < 1e-8
    assert np.allclose([r["explained"] for r in one], values[::-1][:32] / np.trace(v), rtol=1e-9)
    s = x.sum(axis=0).astype(int).tolist()
    for t, row in zip(table, x.astype(int).tolist(), strict=True):
        assert {r["deviation"] for r in got[t["vec_id"]]} == {sum((len(table) * a - b) ** 2 for a, b in zip(row, s, strict=True))}


def test_whitening_drops_broken_vectors_and_keeps_repeated_and_unnamed_rows(spark):
    r = random.Random(4)
    good = [(k, [r.uniform(-3, 3) for _ in range(5)]) for k in range(40)]
    good += [good[3], (None, [0.5, 0.25, -1.0, 2.0, 0.0])]
    broken = [(90, None), (91, [1.0, None, 1.0, 1.0, 1.0]), (92, [1.0, math.nan, 1.0, 1.0, 1.0]), (93, [1.0, math.inf, 1.0, 1.0, 1.0]), (94, [1.0]), (95, [])]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in good + broken], "vec_id long, embedding array<double>, component int, whitened string")
    rows = whitening.whiten(df, "embedding", ["vec_id", "component"], 3).collect()
    x, n, s, deviations, v, z = plain_whitening([v for _, v in good])
    assert len(rows) == 3 * len(good) and {r["n"] for r in rows} == {42}
    assert sorted(r["deviation"] for r in rows if r["component"] == 1) == sorted(deviations)
    values, turned = np.linalg.eigh(v)
    got = sorted(abs(r["whitened"]) for r in rows if r["component"] == 2)
    assert np.allclose(got, sorted(np.abs(z @ turned[:, -2]) / math.sqrt(values[-2])), atol=1e-9)
    assert sum(r["vec_id"] is None for r in rows) == 3 and sum(r["vec_id"] == 3 for r in rows) == 6


def test_whitening_of_few_equal_none_and_huge_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema), "embedding", ["vec_id"]).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 4, schema), "embedding", ["vec_id"]).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [4.0, 2.0, 0.0])], schema), "embedding", ["vec_id"]).collect()
    assert sorted((r["vec_id"], r["component"], r["deviation"], round(abs(r["whitened"]), 9)) for r in two) == [(1, 1, 192**2, 1.0), (2, 1, 192**2, 1.0)]
    huge = whitening.whiten(spark.createDataFrame([(1, [3e38]), (2, [-3e38]), (3, [0.0])], schema), "embedding", ["vec_id"]).collect()
    assert {r["vec_id"]: r["deviation"] for r in huge}[1] is None and all(r["identity_error"] < 1e-9 for r in huge)


# Byte network


def test_gradient_of_the_byte_network():
    r = np.random.default_rng(1)
    layout = byte_convolution.Layout(pa.array(["plain words here. " * 40, "", "xx%% yy$$ " * 30, None, "é" * 200]))
    net = {k: v.astype(np.float64) for k, v in byte_convolution.initial().items()}
    net["filter_bias"] = r.normal(size=net["filter_bias"].shape) * 0.1
    target, weight = np.array([1.0, 0, 0, 1, 1]), np.array([1.0, 2, 1, 1, 0.5])

    def loss(n):
        z = byte_convolution.forward(n, layout)
        return float(((np.logaddexp(0, z) - target * z) * weight).sum() / weight.sum())

    found = byte_convolution.gradient(net, layout, target, weight)
    for name in ("filters", "units", "unit_bias", "out", "out_bias"):
        for _ in range(5):
            at = tuple(r.integers(0, s) for s in net[name].shape)
            moved = [{**net, name: net[name].copy()} for _ in range(2)]
            moved[0][name][at] += 1e-6
            moved[1][name][at] -= 1e-6
            assert abs((loss(moved[0]) - loss(moved[1])) / 2e-6 - found[name][at]) < 1e-5


def test_a_text_scores_alike_in_any_company():
    net = byte_convolution.initial(3)
    texts = ["a short one", "", None, "word " * 5000, "end"]
    together = byte_convolution.forward(net, byte_convolution.Layout(pa.array(texts)))
    alone = [byte_convolution.forward(net, byte_convolution.Layout(pa.array([t], pa.string())))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-4) and together[1] == together[2]
    late = byte_convolution.forward(net, byte_convolution.Layout(pa.array(["word " * 5000, "word " * 4990 + "%$#! " * 10])))
    assert late[0] != late[1]  # the end of a long text counts


def area_under_curve(score, good):
    pairs = [(a > b) + 0.5 * (a == b) for a in score[good == 1] for b in score[good == 0]]
    return sum(pairs) / len(pairs)


def test_byte_network_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.QUERIES["op12_byte_convolution"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [i for i in rows if rows[i]["held_out"] and i in labels]
    score, good = np.array([rows[i]["score"] for i in held]), np.array([labels[i] for i in held])
    assert area_under_curve(score, good) > 0.95


def test_labels_that_are_held_out_missing_or_contradicting_do_not_count(spark):
    docs = [(i, ("fine words in a row. " if i % 2 else "%% $$ ## ") * 20, "x", "y", 0.5) for i in range(60)] + [(None, None, None, None, None), (7, "", None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(0, 1), (1, 1), (2, None), (None, 1), (3, 5)], "doc_id long, quality int")
    rows = byte_convolution.quality_scores(df, labels, queries.held_out, ["doc_id", "score"]).collect()
    assert len(rows) == 62 and set(rows[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
    flipped = spark.createDataFrame([(i, (i % 2) if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    plain = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    sample, share = byte_convolution.labelled_sample(df, plain, "doc_id", "text", "quality", queries.held_out(byte_convolution.F.col("__id")))
    other, other_share = byte_convolution.labelled_sample(df, flipped, "doc_id", "text", "quality", queries.held_out(byte_convolution.F.col("__id")))
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, other.collect())) and share == other_share
    sample, _ = byte_convolution.labelled_sample(df, labels, "doc_id", "text", "quality", byte_convolution.F.lit(False))
    assert sample.count() == 60 - 1 + 1  # id 0 contradicts itself; id 7 has two texts
    nothing = byte_convolution.quality_scores(df, labels.filter("quality = 1"), queries.held_out, ["doc_id"]).collect()
    assert len({r["score"] for r in nothing}) == 1
    assert byte_convolution.quality_scores(df.limit(0), plain, queries.held_out, ["doc_id"]).collect() == []


# Periodic runs


def plain_runs(w, least):
    """Every maximal stretch with its smallest period, by trying all periods."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            s = i - q
            if j - s >= max(least, 2 * q) and not any(all(w[k] == w[k - r] for k in range(s + r, j)) for r in range(1, q)):
                out.append((s, j - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 12)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_random_words():
    r = random.Random(1)
    for _ in range(600):
        k, n = r.choice([1, 2, 3, 5]), r.randint(0, 60)
        w = [r.randrange(k) for _ in range(n)]
        if r.random() < 0.5:
            block = [r.randrange(k + 2) for _ in range(r.randint(1, 9))]
            w = w[: r.randint(0, n)] + (block * 8)[: r.randint(0, 8 * len(block))] + w[:5]
        for least in (1, 12):
            assert periodic_runs.runs_of(w, least) == plain_runs(w, least)


def test_machine_numbers_give_the_same_runs(monkeypatch):
    r = random.Random(2)
    w = [r.randrange(2) for _ in range(300)] * 2 + [0, 1, 2] * 50
    expected = periodic_runs.runs_of(w)
    monkeypatch.setattr(periodic_runs, "COMPACT", 10)
    assert periodic_runs.runs_of(w) == expected == plain_runs(w, 12)


def test_periodic_runs_of_texts_by_brute_force(spark):
    r = random.Random(3)
    texts = [None, "", " \t\n", "one", "a " * 11, "a " * 12, "a b c d e f " * 2, "x " + "a b c d e f " * 2 + "y", "a\nb\x0bc\x0cd\re\tf " * 2]
    for _ in range(120):
        w = [r.choice("abcde") * r.randint(1, 2) for _ in range(r.randint(1, 80))]
        block = [r.choice("uvwxyz") for _ in range(r.randint(1, 14))]
        texts.append(r.choice([" ", "\n", "  "]).join(w + (block * 9)[: r.randint(0, 9 * len(block))] + w[:9]))
    texts += ["é ß " * 30, "  a " * 20]
    table = [(i, t, 9) for i, t in enumerate(texts)] + [(None, "b c " * 40, 9), (5, texts[5], 9)]
    df = spark.createDataFrame(table, "doc_id long, text string, runs int")
    found = periodic_runs.periodic_runs(df, "text", ["doc_id", "runs"], id="doc_id", rearrange=periodic_runs.planted_tail)
    got = [tuple(x) for x in periodic_runs.digests(found, ["doc_id"]).collect()]
    assert sorted(got, key=repr) == sorted((plain_digest(i, t) for i, t, _ in table), key=repr)
    assert periodic_runs.periodic_runs(df.limit(0), "text", ["doc_id"]).collect() == []


def test_periodic_runs_of_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    some = [d for d in docs if len(d["text"] or "") < 9000]
    assert len(got) == len(docs) and any(r[1] for r in got.values())
    assert all(got[d["doc_id"]] == plain_digest(d["doc_id"], d["text"]) for d in some)


def test_long_periodic_texts_take_time_in_proportion():
    w = [k % 7 for k in range(120_000)]
    assert periodic_runs.runs_of(w) == [(0, 120_000, 7)]
    a, b = [0], [0, 1]
    while len(b) < 30_000:
        a, b = b, b + a
    assert len(periodic_runs.runs_of(b)) > 1000
