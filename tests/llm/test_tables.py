"""Operators on whole tables and the pipeline, against brute force on small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from lakeops.llm import decontaminate, line_dedup, mixing, near_copies, quality, queries, simhash, warc
from lakeops.llm.components import components
from verification.compare import differences, duckdb_on

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def rows(documents):
    return documents.collect()


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_matches_its_sql(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir).toArrow()
    assert differences(got, duckdb_on(sf_dir).execute(queries.ORACLE[name]).to_arrow_table()) is None


def test_thirteen_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


# Quality


def plain_kneser_ney(texts, order):
    """log probability of every text under an interpolated modified Kneser-Ney model, with dictionaries."""
    sequences = [[quality.START] * (order - 1) + [int(c) for c in quality.folded(np.array([ord(c) for c in t], np.uint32))] for t in texts]
    tables = {order: Counter(tuple(s[i : i + order]) for s in sequences for i in range(len(s) - order + 1))}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    discount, context = {}, {}
    for k, table in tables.items():
        t = Counter(table.values())
        if all(t[i] for i in (1, 2, 3)):
            y = t[1] / (t[1] + 2 * t[2])
            discount[k] = [max(0.0, min(float(i), i - (i + 1) * y * t[i + 1] / t[i])) for i in (1, 2, 3)]
        else:
            discount[k] = [0.5, 1.0, 1.5]
        groups = defaultdict(list)
        for g, n in table.items():
            groups[g[:-1]].append(n)
        context[k] = {c: (sum(ns), sum(discount[k][min(n, 3) - 1] for n in ns) / sum(ns)) for c, ns in groups.items()}

    def p(gram):
        if not gram:
            return 1 / (len(tables[1]) + 1)
        total, gamma = context[len(gram)][gram[:-1]]
        n = tables[len(gram)][gram]
        return (n - discount[len(gram)][min(n, 3) - 1]) / total + gamma * p(gram[1:])

    return [sum(math.log(p(tuple(s[i : i + order]))) for i in range(len(s) - order + 1)) for s in sequences]


def test_perplexity_is_modified_kneser_ney(spark):
    texts = ["the cat sat on the mat", "a cat sat", "the dog ran to the cat", "xyz 12 é", "the the the", "on a mat the dog sat"]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    for order in (1, 3):
        expected = plain_kneser_ney(texts, order)
        for rows in (quality.SEGMENT_ROWS, 7):  # one segment of each length, and many
            out = {r["doc_id"]: r["log_perplexity"] for r in quality.quality_rules(df, ["doc_id"], order=order, segment_rows=rows).collect()}
            assert [out[k] for k in range(len(texts))] == pytest.approx([-e / len(t) for e, t in zip(expected, texts, strict=True)], abs=1e-8)


def test_quality_verdicts_of_the_whole_table(spark, sf_dir, documents, rows):
    """Perplexities by dictionaries and bands by sorting, for every text of the table."""
    of_lang = defaultdict(list)
    for r in rows:
        of_lang[r["lang"] or ""].append(r)
    logs = {}
    for group in of_lang.values():
        for r, e in zip(group, plain_kneser_ney([x["text"] or "" for x in group], quality.ORDER), strict=True):
            logs[r["doc_id"]] = round(-e / len(r["text"]), 9) if r["text"] else None
    got = {r["doc_id"]: r for r in quality.quality_rules(documents, ["doc_id"]).collect()}
    for group in of_lang.values():
        x = sorted(round(logs[r["doc_id"]], 3) for r in group if not got[r["doc_id"]]["base_failed"])
        middle = x[(len(x) - 1) // 2]
        far = sorted(round(abs(v - middle), 3) for v in x)
        spread = max(0.01, 1.4826 * far[(len(far) - 1) // 2])
        for r in group:
            own, value = got[r["doc_id"]], logs[r["doc_id"]]
            assert own["log_perplexity"] == pytest.approx(value, abs=1e-6)
            wide = spread * math.sqrt(1 + quality.SHORT / max(1, len(r["text"] or "")))
            inside = len(x) < quality.MIN_TEXTS or value is None or middle - quality.LOWER * wide <= value <= middle + quality.UPPER * wide
            assert own["kept"] == (not own["base_failed"] and inside)


@pytest.mark.parametrize("mapped", [True, False])
def test_probabilities_of_unseen_ngrams_add_up(spark, tmp_path, monkeypatch, mapped):
    df = spark.createDataFrame([("en", "abracadabra abba"), ("en", "cab bac dab"), ("", "zz")], "lang string, text string")
    table = quality.kneser_ney(quality.count_ngrams(df, 3), 3)
    segments = quality.write_model(table, f"file://{tmp_path}", 6)
    assert len(segments) > 12 and sum(s[4] for s in segments) == table.agg(F.count("logp") + F.count("logb")).first()[0]
    if not mapped:  # a file system that cannot map files, with room for one segment
        monkeypatch.setattr(quality.fs, "LocalFileSystem", quality.fs.HadoopFileSystem)
        monkeypatch.setattr(quality, "CACHE_BYTES", 1)
    model = quality.Model(segments, f"file://{tmp_path}", 3)
    symbols = sorted({r["key"] for r in table.filter("lang = 'en' AND length = 1 AND logp IS NOT NULL").collect()})
    for context in ("ab", "zz", "ca", "rr"):
        prefix = (ord(context[0]) << 24) | (ord(context[1]) << 12)
        keys = np.array([prefix | s for s in symbols] + [prefix | 0x7FF], np.uint64)  # all seen characters and one for the unseen
        assert np.exp(model.log_probabilities("en", keys)).sum() == pytest.approx(1.0)
    assert model.knows("") and not model.knows("fr") and (mapped or len(model.cache) == 1)


def test_kept_columns_may_clash_with_added_ones(spark):
    df = spark.createDataFrame([(1, "some words of a text " * 5, "en", 7, "own")], "doc_id long, text string, lang string, n_words int, kept string")
    out = quality.quality_rules(df, ["doc_id", "n_words", "kept", "lang"]).collect()
    assert [c for c in out[0].asDict() if c in ("doc_id", "n_words", "kept", "lang")] == ["doc_id", "lang", "n_words", "kept"]
    assert (out[0]["n_words"], out[0]["lang"]) == (25, "en")


def test_bands_reject_outliers_of_a_language(spark):
    random.seed(2)
    words = "the of and to in that it was for on with as his they be at one have this from".split()
    clean = [(k, " ".join(random.choice(words) for _ in range(80)), "en") for k in range(80)]
    noise = (100, " ".join("".join(random.choice("qxzjkvwбдж0") for _ in range(6)) for _ in range(80)), "en")
    alone = (101, noise[1], "xx")
    df = spark.createDataFrame([*clean, noise, alone, (102, None, None), (None, "", "en"), clean[0]], "doc_id long, text string, lang string")
    out = quality.quality_rules(df, ["doc_id"]).collect()
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert len(out) == df.count()
    assert all(kept[k] for k in range(80)) and not kept[100] and kept[101] and not kept[102] and not kept[None]
    assert quality.quality_rules(df.limit(0), ["doc_id"]).count() == 0


def test_bands_reject_scrambled_words(spark):
    draw = random.Random(5)
    words = "the of and to in that it was for on with as his they be at one have this from".split()
    texts = [[draw.choice(words) for _ in range(150)] for _ in range(200)]
    clean = [(k, " ".join(t), "en") for k, t in enumerate(texts)]
    scrambled = lambda t: " ".join("".join(draw.sample(w, len(w))) if draw.random() < 0.2 else w for w in t)
    junk = [(1000 + k, scrambled(texts[k]), "en") for k in range(4)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df, ["doc_id"]).collect()}
    assert not any(kept[i] for i, _, _ in junk) and sum(not kept[i] for i, _, _ in clean) <= 4


# Line dedup


def test_line_dedup_on_odd_tables(spark):
    menu = "Home | About"
    pages = [(k, "s", f"{menu}\nstory {k}\n\n", 7) for k in range(9)] + [(9, "s", menu, 7), (10, "s", None, 7), (11, None, menu, 7), (12, "t", menu, 7), (12, "t", menu, 7)]
    df = spark.createDataFrame(pages, "doc_id long, source string, text string, n_lines int")
    for limit in (line_dedup.SET_BYTES, 0):
        out = sorted(map(tuple, line_dedup.drop_boilerplate(df, ratio=0.5, set_bytes=limit).select("doc_id", "text", "n_lines", "n_dropped").collect()))
        assert out == sorted(
            [(k, f"story {k}\n\n", 4, 1) for k in range(9)]  # the menu goes
            + [(9, menu, 1, 0), (10, None, None, None), (11, menu, 1, 0), (12, menu, 1, 0), (12, menu, 1, 0)]
        )
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_lines_on_a_hundredth_of_a_source_go(spark):
    pages = [(k, "s", f"story {k}\nLicensed to all." if k % 100 == 0 else f"story {k}\nTwice." if k < 3 else f"story {k}") for k in range(400)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(spark.createDataFrame(pages, "doc_id long, source string, text string")).collect()}
    assert out == {k: t.replace("\nLicensed to all.", "") for k, _, t in pages}


# Mixing


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    out, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[n] for n in free)
        over = [n for n in free if weight[n] * level > 3 * sizes[n]]
        if not over:
            return out | {n: weight[n] * level for n in free}
        for n in over:
            out[n] = 3.0 * sizes[n]
            left -= out[n]
            free.remove(n)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_mix_meets_targets(spark, seed):
    draw = random.Random(seed)
    docs = [(k, draw.choice("abcdefg"), " ".join("w" for _ in range(draw.choice([0, 1, 5, 20, 20, 40])))) for k in range(700)]
    docs += [(1000 + k, None, "w " * 9) for k in range(5)] + [(2000, "z", "w " * 3)] * 300 + [(None, "a", None)] * 3
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("copies", F.lit("own"))
    sizes = defaultdict(int)
    for _, s, t in docs:
        sizes[s] += len(WORD.findall(t or ""))
    expected = plain_targets(sizes)
    out = mixing.mix(df, seed=seed).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in out) == Counter((i, s, len(WORD.findall(t or ""))) for i, s, t in docs)
    taken = defaultdict(int)
    for r in out:
        assert r["target"] == pytest.approx(expected[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 41, s
    again = mixing.mix(df.repartition(3), seed=seed).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_mix_is_unbiased_and_handles_empty_tables(spark):
    df = spark.createDataFrame([(k, "a" if k < 40 else "b", "w " * (1 + k % 7)) for k in range(80)], "doc_id long, source string, text string")
    assert mixing.mix(df.limit(0)).count() == 0
    assert {r["taken"] for r in mixing.mix(spark.createDataFrame([(1, "a", "")], df.schema)).collect()} == {0}
    total = defaultdict(float)
    for seed in range(12):
        for r in mixing.mix(df, seed=seed).collect():
            total[r["source"], r["doc_id"]] += r["copies"] / 12
    rates = {s: plain_targets({"a": sum(1 + k % 7 for k in range(40)), "b": sum(1 + k % 7 for k in range(40, 80))})[s] for s in "ab"}
    for s, size in (("a", 156), ("b", 163)):
        mean = np.mean([v for (source, _), v in total.items() if source == s])
        assert abs(mean - rates[s] / sum(1 + k % 7 for k in (range(40) if s == "a" else range(40, 80)))) < 0.1, (s, size)


# Decontamination


def test_contaminated_documents_are_those_with_an_item(spark, sf_dir, documents, rows):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = benchmark.collect()
    expected = {r["doc_id"]: sorted(b["item_id"] for b in items if b["text"] in (r["text"] or "")) for r in rows}
    for options in ({}, {"broadcast_windows": 0, "bits": 1 << 10}):
        out = decontaminate.verdicts(documents, benchmark, ["doc_id"], **options).collect()
        assert {r["doc_id"]: r["items"] for r in out} == expected
        assert all(r["contaminated"] == bool(r["items"]) for r in out)
    assert any(expected.values())


def test_reparameterised_questions(spark):
    question = "We saw Tom has 5 apples and buys 7 more apples so Tom has 12 apples today in all."
    docs = [
        (1, "At noon we saw Anna has 9 apples and buys 4 more apples so Anna has 13 apples today in all, (she says)."),
        (2, "We saw Anna has 9 apples and buys 4 more apples so Peter has 13 apples today in all."),  # two names for one
        (3, question.replace(" ", "\n ").lower() + " yes"),
        (4, None), (5, ""), (6, "We saw Tom has 5 apples"), (None, question), (1, "nothing to see here at all"), (7, "so it"), (8, "and so it goes"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("own"))
    benchmark = spark.createDataFrame([(1, question), (2, None), (3, "so it"), (4, question), (5, "")], "item_id long, text string")
    out = sorted(((r["doc_id"], tuple(r["items"])) for r in decontaminate.verdicts(df, benchmark, ["doc_id"]).collect()), key=repr)
    assert out == sorted([(1, (1, 4)), (1, ()), (2, ()), (3, ()), (4, ()), (5, ()), (6, ()), (None, (1, 4)), (7, (3,)), (8, ())], key=repr)
    assert decontaminate.verdicts(df.limit(0), benchmark, ["doc_id"]).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.verdicts(df, benchmark.limit(0), ["doc_id"]).collect())


def plain_contaminated(docs, items):
    """Pairs by comparing every document with every item, window by window."""
    numbers, units = (decontaminate._hash_words(w) for w in (decontaminate.NUMBER_WORDS, decontaminate.UNITS))

    def windows(text):
        _, at, key, slots = decontaminate.Templates(pa.array([text], pa.string()), numbers, units).windows(decontaminate.WINDOW)
        return list(zip(at.tolist(), key.tolist(), slots.tolist(), strict=True))

    of_item = {i: windows(t) for i, t in items}
    out = set()
    for d, text in docs:
        mine = defaultdict(list)
        for at, key, slots in windows(text):
            mine[key].append((at, slots))
        for i, theirs in of_item.items():
            matches = [(p - at, key, list(zip(a, b, strict=True))) for at, key, a in theirs for p, b in mine[key]]
            values = defaultdict(set)
            for diagonal, _, slots in matches:
                for a, b in slots:
                    if a:
                        values[diagonal, a].add(b)
            good = {key for diagonal, key, slots in matches if all(a == b for a, b in slots) or all(not a or len(values[diagonal, a]) == 1 for a, b in slots)}
            if theirs and len(good) >= 0.8 * len({key for _, key, _ in theirs}):
                out.add((d, i))
    return out


def test_contaminated_pairs_by_brute_force(spark):
    """Items with a stock opening, re-parameterised, cut and mixed copies of them in documents."""
    draw = random.Random(4)
    word = lambda: draw.choice(["apples", "trains", "goes", "then", "with", "over", "km", "Tom", "Anna", "5", "seven", "12", "costs", "left", "when"])
    opening = "Read the following problem and answer it with one number only please:"
    items = [(k, f"{opening} " + " ".join(word() for _ in range(draw.randint(3, 40)))) for k in range(60)] + [(100, "5 km"), (101, None), (102, opening)]
    items.append((103, items[7][1]))
    docs = []
    for k in range(300):
        text = draw.choice(items[:60])[1].split()
        text = text[draw.choice([0, 0, 3]) : draw.choice([None, None, -4])]
        swap = {w: draw.choice(["Tom", "Bob", "9", "3", w]) for w in ("Tom", "Anna", "5", "12")}
        text = [draw.choice(["Eve", "8"]) if w in swap and draw.random() < 0.03 else swap.get(w, w) for w in text]
        docs.append((k, " ".join([word() for _ in range(draw.randint(0, 30))] + text + [word() for _ in range(draw.randint(0, 30))])))
    docs += [(400 + k, f"{opening} and more {word()}") for k in range(50)]
    df, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = plain_contaminated(docs, items)
    for options in ({}, {"broadcast_windows": 0, "bits": 1 << 10}):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, benchmark, **options).collect()}
        assert got == expected and 100 < len(expected)


def test_one_wrong_slot_drops_only_its_windows(spark):
    item = "We saw Tom and Anna walk " + " ".join(f"w{chr(97 + k % 26)}" for k in range(40)) + " until 9 passed"
    docs = [(1, item + "."), (2, item.replace("Anna", "Tom")), (3, item.replace("until 9", "until 7"))]
    df, benchmark = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item + " for Tom")], "item_id long, text string")
    got = {r["doc_id"] for r in decontaminate.contaminated(df, benchmark).collect()}
    assert got == {1, 2, 3}


# SimHash


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(ids, values):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    distinct = sorted(set(values))
    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, v in zip(ids, values, strict=True):
        if i is not None:
            least[find(v)] = min(i, least.get(find(v), i))
    return [least.get(find(v)) for v in values]


def test_near_duplicates_are_all_components(spark, documents, rows):
    extra = [(None, ""), (-5, None), (-5, None), (-6, "One two"), (-7, "ONE  two\n"), (-8, "É x"), (-9, "w " * 40_000)]
    df = documents.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("fp", F.lit("own"))
    pairs = [(r["doc_id"], r["text"]) for r in rows] + extra
    values = [plain_fingerprint(t) for _, t in pairs]
    expected = sorted(zip([i for i, _ in pairs], [f"{v:016x}" for v in values], plain_components([i for i, _ in pairs], values), strict=True), key=repr)
    assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr) == expected
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_links_of_crowded_values_and_all_plans(spark):
    draw = random.Random(4)
    values = set()
    for _ in range(20):
        middle = draw.getrandbits(64)
        for _ in range(60):
            v = middle
            for _ in range(draw.randrange(4)):
                v ^= 1 << draw.randrange(64)
            values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    groups = plain_components(signed, values)
    n, ones = simhash.common_ones(fps)
    assert n == len(values) and ones[0, 0] == sum(v & 1 for v in values)
    two, four = simhash.group_bits(n, ones, 2), simhash.group_bits(n, ones, 4)
    assert sorted(b for part in four for b in part) == list(range(64))
    for plan in (None, [(two[0], 1), (two[1], 0)], [(four[2], 2)]):
        for hot in (4, 10**9):
            found = {r["node"]: r["root"] for r in components(simhash.links(fps, hot=hot, plan=plan)).collect()}
            named = defaultdict(set)
            for v in signed:
                named[found.get(v, v)].add(v)
            expected = defaultdict(set)
            for v, g in zip(signed, groups, strict=True):
                expected[g].add(v)
            assert sorted(map(sorted, named.values())) == sorted(map(sorted, expected.values()))


def test_thresholds_are_allocated_at_least_cost():
    draw = random.Random(1)
    for _ in range(50):
        costs = [[0.0, *sorted(draw.random() for _ in range(3))] for _ in range(4)]
        total, thresholds = simhash.allocate(costs, 3)
        assert sum(t + 1 for t in thresholds) == 3
        every = [(a, b, c, d) for a in range(4) for b in range(4) for c in range(4) for d in range(4) if a + b + c + d == 3]
        assert total == pytest.approx(min(sum(c[u] for c, u in zip(costs, us, strict=True)) for us in every))


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(200)] + [(300, 301), (302, 301), (5, 5)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(1, 201)} | {301: 300, 302: 300}


# Archives


def test_archives_come_back(spark, tmp_path):
    page = "<p>" + "x" * 200
    pages = [(k, f"http://{'ab'[k % 2]}.example.org/{k % 3}", page if k % 4 == 0 else f"{page}{k}") for k in range(1200)]
    pages += [(5000, None, None), (5001, "", ""), (5002, "no url", "y" * 99), (5003, "http://x\r\n.org/é", "y" * 99), (5004, "http://x", "é\r\n\r\n" * 60_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("id", F.lit("own"))
    first = {}
    expected = []
    for i, _, h in pages:
        data = (h or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        least = first.setdefault(digest, i) if len(data) >= 100 else i
        expected.append((i, len(data), digest, "response" if least == i else "revisit", None if least == i else least))
    assert sorted(map(tuple, warc.archive_and_read(df).collect())) == expected
    assert warc.archive_and_read(df.limit(0)).count() == 0
    # Several archives and index files; chosen keys only.
    rows = warc.typed(df.select(F.col("page_id").alias("id"), "url", "html"))
    captures = warc.write_archives(rows, f"file://{tmp_path}", archive_bytes=5000)
    level = warc.write_index(captures, f"file://{tmp_path}", rows=100)
    assert level.count() > 5
    wanted = spark.createDataFrame([warc.capture_key(u, i) for i, u, _ in pages[::50]] + [("org,example,a)/0", -1), ("zz)/", 1)], "key string, id long")
    assert sorted(map(tuple, warc.look_up(wanted, level, f"file://{tmp_path}").collect())) == expected[:1200:50] + expected[1200::50]


def test_pages_without_an_id_come_back(spark):
    """Also among equal payloads: the smallest known id is the response, without one all are; as the query's SQL says."""
    shared, lonely = "<p>" + "x" * 200, "<p>" + "y" * 200
    pages = [(None, "http://a.org/", shared), (7, "http://a.org/", shared), (9, "http://a.org/", shared), (None, "http://a.org/", shared), (None, None, lonely), (None, "u", lonely),
             (None, "http://a.org/", None), (None, "http://a.org/", "short"), (-3, "http://a.org/", "short"), (None, "http://b.org/", "z" * 300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = warc.archive_and_read(df).toArrow()
    connection = duckdb_on("/root/testdata/sf0.001")
    connection.execute("CREATE OR REPLACE TABLE small AS SELECT * FROM (VALUES " + ", ".join(f"({'NULL' if i is None else i}::BIGINT, {'NULL' if h is None else repr(h)}::VARCHAR)" for i, _, h in pages) + ") t(page_id, html)")
    sql = queries.ORACLE["op9_warc_capture_index"].replace("FROM pages", "FROM small")
    assert differences(got, connection.execute(sql).to_arrow_table()) is None
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got.to_pylist())
    assert kinds[None, "revisit", 7] == 2 and kinds[7, "response", None] == 1 and kinds[None, "response", None] == 5


def test_one_index_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ_ROWS", 50)
    pages = spark.range(400).select(F.col("id"), F.concat(F.lit("http://a.org/"), F.col("id") % 7).alias("url"), F.concat(F.lit("p"), F.col("id")).alias("html"))
    captures = warc.write_archives(warc.typed(pages), f"file://{tmp_path}")
    level = warc.write_index(captures, f"file://{tmp_path}")
    read = warc.look_up(captures.select("key", "id"), level, f"file://{tmp_path}")
    assert level.count() == 1 and sorted(r["page_id"] for r in read.collect()) == list(range(400))
    assert "RepartitionByExpression" in read._jdf.queryExecution().analyzed().toString() and ", 8" in read._jdf.queryExecution().analyzed().toString()


def test_url_keys_reverse_the_host():
    assert warc.url_key("https://Blog.Example.org/a?b") == "org,example,blog)/a?b"
    assert warc.url_key(None) == warc.url_key("") == ""


# Pipeline


def test_pipeline_stages(spark, sf_dir, documents, rows):
    assert [f for _, f in corpus_pipeline.STAGES][0] is corpus_pipeline.quality_rules and len(corpus_pipeline.STAGES) == 5
    docs, left = documents, {r["doc_id"] for r in rows}
    verdict = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs, ["doc_id"]).collect()}
    docs = corpus_pipeline.stored(corpus_pipeline.quality_rules(spark, docs, sf_dir))
    assert docs.columns == documents.columns and {r["doc_id"] for r in docs.collect()} == {i for i in left if verdict[i]}
    docs = corpus_pipeline.stored(corpus_pipeline.line_dedup_by_site(spark, docs, sf_dir))
    texts = {r["doc_id"]: r for r in docs.collect()}
    assert set(texts) == {i for i in left if verdict[i]} and all(r["n_chars"] == len(r["text"]) for r in texts.values())
    ids = sorted(texts)
    root = jaccard_components([texts[i]["text"] for i in ids])
    docs = corpus_pipeline.stored(corpus_pipeline.near_dedup(spark, docs, sf_dir))
    left = {i for k, i in enumerate(ids) if root[k] == k}
    assert {r["doc_id"] for r in docs.collect()} == left and docs.count() == len(left) < len(ids)
    items = [b["text"] for b in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = corpus_pipeline.stored(corpus_pipeline.benchmark_decontamination(spark, docs, sf_dir))
    left = {i for i in left if not any(b in texts[i]["text"] for b in items)}
    assert {r["doc_id"] for r in docs.collect()} == left
    mixed = {r["doc_id"] for r in corpus_pipeline.mixing_to_targets(spark, docs, sf_dir).collect()}
    assert mixed == left


def plain_shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)]) if words else frozenset()


def jaccard_components(texts):
    """Per text the first text that links of similarity 0.8 or more lead to; pairs by an index of all shingles."""
    sets, root, holders = [plain_shingles(t) for t in texts], list(range(len(texts))), defaultdict(list)

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    empty = [i for i, x in enumerate(sets) if not x]
    for i, x in enumerate(sets):
        common = Counter(j for g in x for j in holders[g])
        for j in [j for j, n in common.items() if 9 * n >= 4 * (len(x) + len(sets[j]))] + (empty[:1] if not x else []):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
        for g in x:
            holders[g].append(i)
    return [find(i) for i in range(len(texts))]


def test_shingle_sets_of_any_slice(rows):
    texts = pa.array([r["text"] for r in rows] + [None, "", "a B", "A b"])
    for a, b in ((0, len(texts)), (100, 150), (150, len(texts))):
        found, hashes, n, digest = near_copies.shingle_sets(texts[a:b])
        sets = [plain_shingles(t) for t in texts[a:b].to_pylist()]
        assert n.tolist() == [len(x) for x in sets] and len(set(digest.tolist())) == len(set(sets))


def test_near_copies_are_found_by_five_words(spark, sf_dir):
    draw = random.Random(8)
    word = lambda: f"w{draw.randrange(3000)}"
    base, passage = [word() for _ in range(150)], [word() for _ in range(120)]
    texts = [" ".join(word() for _ in range(60)) for _ in range(20)] + [" ".join(passage + [word() for _ in range(25 + k)]) for k in range(20)]
    for k in range(60):
        copy = list(base)
        for _ in range(k % 7):
            copy[draw.randrange(len(copy))] = word()
        texts.append(" ".join(copy if k % 2 else copy[k // 4 :]))
    texts += ["A b", "a  B\n", "a c", "", texts[5].upper(), texts[6], texts[50] + " end"]
    root = jaccard_components(texts)
    df = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    for crowd in (3, 48):
        found = defaultdict(set)
        for r in near_copies.near_copies(df.withColumn("key", F.xxhash64("text")), "key", crowd=crowd).collect():
            found[r["__component"]].add(r["__id"])
        assert sorted(map(sorted, found.values())) == sorted([i for i in range(len(root)) if root[i] == x] for x in set(root))
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, sf_dir).collect()} == {k for k, r in enumerate(root) if k == r} and len(set(root)) < 70


def test_near_copies_of_a_whole_table(spark):
    """Every link of the table is found: the components are those of brute force."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    table = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    root = jaccard_components([t for _, t in table])
    found = defaultdict(set)
    for r in near_copies.near_copies(docs.withColumn("k", F.xxhash64("text")), "k").collect():
        found[r["__component"]].add(r["__id"])
    expected = defaultdict(set)
    for k, (i, _) in enumerate(table):
        expected[root[k]].add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values())) and len(expected) < len(table)


def test_near_copies_of_repeated_rows(spark, monkeypatch):
    """Rows with equal ids and texts, joined by broadcast and by shuffles."""
    base = [f"w{k}" for k in range(80)]
    texts = [" ".join([*base, f"end{k}"]) for k in range(4)] + ["quite another text of its own words here"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] * 3 + [(None, texts[0]), (7, texts[1])], "doc_id long, text string").withColumn("k", F.xxhash64("text"))
    for few in (near_copies.BROADCAST_SETS, 0):
        monkeypatch.setattr(near_copies, "BROADCAST_SETS", few)
        found = near_copies.near_copies(df, "k").collect()
        groups = defaultdict(list)
        for r in found:
            groups[r["__component"]].append(r["__id"])
        assert sorted(sorted(map(repr, g)) for g in groups.values()) == sorted([sorted(map(repr, [0, 1, 2, 3] * 3 + [None, 7])), ["4"] * 3])


def test_templates_make_no_pairs_and_crowds_of_copies_few(spark, monkeypatch):
    """Texts that fill in one template stay apart without being compared; a crowd of near copies costs its number, not its square."""
    draw, counted, verified = random.Random(3), [], near_copies._verified

    def counting(shelf, pairs, *rest):
        counted.append(pairs.count())
        return verified(shelf, pairs, *rest)

    monkeypatch.setattr(near_copies, "_verified", counting)
    word = lambda: f"w{draw.randrange(10**6)}"
    passage, base = [word() for _ in range(200)], [word() for _ in range(150)]
    for n in (150, 300):
        templates = [" ".join(passage + [word() for _ in range(30 + k % 3)]) for k in range(n)]
        copies = [" ".join(base[: 60 + k % 80] + [word()] + base[60 + k % 80 :]) for k in range(n)]
        table = [(k, t) for k, t in enumerate(templates + copies)]
        df = spark.createDataFrame(table, "doc_id long, text string").repartition(6).withColumn("k", F.xxhash64("text"))
        counted.clear()
        root = {r["__id"]: r["__component"] for r in near_copies.near_copies(df, "k").collect()}
        assert len({root[k] for k in range(n)}) == n and len({root[k] for k in range(n, 2 * n)}) == 1
        assert sum(counted) < 30 * n


def test_near_dedup_goes_through_simhash_classes(spark, sf_dir, monkeypatch):
    """Classes of the SimHash operator are verified first: they alone group the nearest copies, and unlike texts with one fingerprint stay apart."""
    draw, classes, verified = random.Random(5), simhash.near_duplicates, near_copies._verified
    word = lambda: f"w{draw.randrange(10**6)}"
    base = [word() for _ in range(1500)]
    near = [" ".join(base), " ".join([*base, "end"]), " ".join([*base[:700], word(), *base[701:]])]
    chant = ["one", "two", "three", "four", "five"] * 300
    unlike = [" ".join(chant + [word() for _ in range(12)]) for _ in range(3)]
    short = base[:80]
    texts = [*near, *unlike, " ".join(short), " ".join([*short[:40], word(), *short[41:], "more"]), near[0], None]
    assert [simhash.fingerprint(t, 5) for t in unlike] == [simhash.fingerprint(unlike[0], 5)] * 3
    assert all((simhash.fingerprint(near[0], 5) ^ simhash.fingerprint(t, 5)).bit_count() <= 2 for t in near)
    assert (simhash.fingerprint(texts[6], 5) ^ simhash.fingerprint(texts[7], 5)).bit_count() > 2
    df = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    calls, counted = [], []

    def called(*args, **options):
        calls.append(options)
        return classes(*args, **options)

    def counting(shelf, pairs, *rest):
        counted.append(pairs.count())
        return verified(shelf, pairs, *rest)

    monkeypatch.setattr(simhash, "near_duplicates", called)
    monkeypatch.setattr(near_copies, "_verified", counting)
    left = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, sf_dir).collect()}
    root = jaccard_components(texts)
    assert left == {k for k, r in enumerate(root) if k == r} == {0, 3, 4, 5, 6, 9}
    assert calls == [{"size": 5}] and counted == [4, 1]  # two links of near copies and two of unlike ones; then the pair of short ones
    pairs = near_copies._pairs
    monkeypatch.setattr(near_copies, "_pairs", lambda *args: pairs(*args).limit(0))
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, sf_dir).collect()} == left | {7}


def test_decontamination_judges_rows_not_ids(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    clean = " ".join(f"word{k}" for k in range(60))
    docs = [(None, item), (None, clean), (1, item), (1, clean), (2, clean)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = corpus_pipeline.benchmark_decontamination(spark, df, sf_dir).collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(None, clean), (1, clean), (2, clean)], key=repr)


def test_pipeline_on_odd_documents(spark, sf_dir):
    text = " ".join(f"word{k}" for k in range(60))
    docs = [(1, text, "en", "a", 3), (1, text, "en", "a", 3), (2, text.upper(), None, None, None), (None, text + " more words", "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("kept", "id", "key", "drop", "set", "component", "position"):
        df = df.withColumn(name, F.lit("own"))
    for case in (df, df.limit(0)):
        docs = case
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir))
            assert docs.columns == df.columns
        out = corpus_pipeline.mixing_to_targets(spark, docs, sf_dir).collect()
        assert sorted((r["doc_id"] for r in out), key=repr) == ([1, None] if case is df else [])
