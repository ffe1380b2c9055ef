"""Hard negatives, lexical search and mixing against brute force."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rivulet.llm import chat, lexical, mixing, negatives, secrets
from test_edges import CLASH, DOCS, LONG_TEXT, LONG_WORD, ROWS, documents

# ------------------------------------------------------------ hard negatives


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-20, 60), max_size=40), st.sets(st.integers(-5, 50), min_size=1, max_size=5), st.integers(1, 4))
def test_slots_answer_every_window(scores, limits, k):
    """The best k of a slot and all after it are the best k up to its limit."""
    limits = sorted(limits, reverse=True)
    slot, at = negatives.best_of_slots(np.array(scores, np.int64), np.array(limits, np.int64), -9, k)
    for s, limit in enumerate(limits):
        merged = [int(i) for n, i in sorted(zip(slot, range(len(at)))) if n >= s for i in [at[i]]][:k]
        best = sorted((i for i, x in enumerate(scores) if -9 <= x <= limit), key=lambda i: (-scores[i], i))[:k]
        assert merged == best


def plain_negatives(rows, asks, positives=5, wanted=3):
    ok = [(i, v, c) for i, v, c in rows if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in ok]
    late = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, (i, v, c) in enumerate(ok):
        if i is None or not asks(i):
            continue
        met = [(sum(a * b for a, b in zip(v, w)), j, d) for m, (j, w, d) in enumerate(ok) if m != n and len(w) == len(v)]
        for ps, p, _ in sorted((x for x in met if x[2] == c), key=late)[:positives]:
            inside = sorted((x for x in met if x[2] != c and 50 * ps <= 100 * x[0] <= 95 * ps), key=late)[:wanted]
            out += [(i, p, r, x[1], ps, x[0]) for r, x in enumerate(inside, 1)]
    return Counter(out)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({c: F.lit("e") for c in ("row", "id", "side", "b1", "b2", "vector", "dim", "asks", "slot", "limits")})


@pytest.mark.parametrize("blocks", [(16_384, 16_384), (7, 3)])
def test_negatives_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", blocks[1])
    rng = random.Random(5)
    # small whole numbers give ties; label 0 is a third of all rows
    rows = [(i, [rng.randint(-2, 3) / 256 for _ in range(4)], rng.choice([0, 0, 0, 1, 2, 3, 4])) for i in range(60)]
    rows += [(7, rows[7][1], rows[7][2]), (8, rows[8][1], 4), (None, rows[3][1], 0), (None, rows[4][1], 1)]
    out = negatives.mine(vectors(spark, rows), F.col("vec_id") % 4 == 0).collect()
    assert Counter(map(tuple, out)) == plain_negatives(rows, lambda i: i % 4 == 0)
    assert len(out) > 50


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.75, 0.5], 2), (3, None, 1), (4, [1.0, None], 2), (5, [nan, 1.0], 2),
            (6, [inf, 1.0], 2), (8, [1.0, 0.5], None), (9, [1.0, 0.5, 0.25], 2), (10, [], 1), (12, [], 1), (14, [], 2)]
    out = negatives.mine(vectors(spark, rows), F.col("vec_id") % 2 == 0).collect()
    assert Counter(map(tuple, out)) == plain_negatives(rows, lambda i: i % 2 == 0)
    assert negatives.mine(vectors(spark, rows).limit(0), F.lit(True)).collect() == []
    huge = [(0, [3e38, 1.0], 1), (1, [3e38, 1.0], 1), (2, [3e38, -1.0], 2)]
    assert negatives.mine(vectors(spark, huge), F.col("vec_id") == 0).collect() == []      # all scores at the end of 64 bits


def test_products_are_exact():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-2 ** 28, 2 ** 28, (3, 5)).astype(float), rng.integers(-2 ** 28, 2 ** 28, (4, 5)).astype(float)
    assert negatives.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(v, w)) for w in b] for v in a]


# ------------------------------------------------------------ lexical search

@settings(max_examples=150, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 6), st.integers(1, 4), max_size=5), min_size=1, max_size=25),
       st.sets(st.integers(0, 6), max_size=7), st.integers(1, 4), st.integers(1, 3), st.integers(1, 60))
def test_bounds_resolve_the_best(docs, asked, k, first_read, least):
    lexical.FIRST_READ, keep = first_read, lexical.FIRST_READ
    try:
        n = np.array([sum(d.values()) + i % 3 for i, d in enumerate(docs)], np.int64)
        table = pa.table({"id": pa.array([(i * 7) % 11 for i in range(len(docs))], pa.int64()), "n": n,
                          "terms": pa.array([sorted(d) for d in docs], pa.list_(pa.int32())),
                          "counts": pa.array([[d[t] for t in sorted(d)] for d in docs], pa.list_(pa.int32()))})
        weights = np.array([3, 0, 1, 1, 2, 5, 1], np.int64)
        total = max(1, int(n.sum()))
        shard = lexical.Shard([table], weights, len(docs), total)
        doc, score = shard.search(np.array(sorted(asked), np.int64), k, least)
    finally:
        lexical.FIRST_READ = keep
    norm = lambda i: 10 + 90 * int(n[i]) * len(docs) // total
    full = [sum(int(weights[t]) * (10 ** 9 * c // (1000 * c + 8 * norm(i))) for t, c in d.items() if t in asked) for i, d in enumerate(docs)]
    want = sorted((-s, (i * 7) % 11, i) for i, s in enumerate(full) if s >= least)[:k]
    assert [(-int(s), (int(i) * 7) % 11, int(i)) for i, s in zip(doc, score)] == want


def test_lexical_shards(spark, monkeypatch):
    """Shards of few postings, items in blocks of one: the same result."""
    docs, items = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    some = items.filter("item_id < 5")
    want = sorted(map(tuple, lexical.search(docs, some).collect()))
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 300)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 1)
    monkeypatch.setattr(lexical, "FIRST_READ", 1)
    assert sorted(map(tuple, lexical.search(docs.repartition(3), some).collect())) == want and len(want) == 50


def test_lexical_edges(spark):
    items = spark.createDataFrame([(1, "SAME text, text"), (2, None), (3, " .-"), (4, "日本語 İ"), (1, "y1x"), (None, "word"),
                                   (5, "x1y" * 40_000)], "item_id int, text string").withColumn("term", F.lit("e"))
    rows = [*ROWS, (11, "y1x1y " * 3, "en", "a", 1), (None, "The same text here, and more of it.", "en", "a", 35)]
    out = [tuple(r) for r in lexical.search(documents(spark, rows), items).collect()]
    of = lambda i: [(r, d) for q, r, d, _ in sorted(out, key=lambda x: x[1]) if q == i]
    assert of(1) == [(1, 4), (2, 4), (3, 5), (4, None)] and of(2) == of(3) == []
    assert of(4) == [(1, 8)] and of(None) == [(1, 7)] and of(5) == [(1, 6)]
    assert lexical.terms("Aé1 日本語\x7fİx_y".encode()) == ["aé1".encode(), "日本語".encode(), "İx".encode(), b"y"]
    assert lexical.search(documents(spark, []), items).collect() == []
    assert lexical.search(documents(spark), items.limit(0)).collect() == []


# -------------------------------------------------------------------- mixing

def highest(votes, seats):
    """Sainte-Lague, one seat after the other."""
    got = [0] * len(votes)
    for _ in range(seats):
        got[max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * got[i] + 1), -i))] += 1
    return got


def test_highest_quotients(spark):
    rng = random.Random(1)
    groups = {g: ([rng.choice([0, 1, 5, 100, rng.randint(1, 10 ** 4)]) for _ in range(rng.randint(1, 9))], rng.randint(0, 60)) for g in range(40)}
    groups = {g: (v, s if any(v) else 0) for g, (v, s) in groups.items()}
    rows = [(g, i, x, s) for g, (v, s) in groups.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "g int, i int, votes long, seats long")
    out = {(r["g"], r["i"]): r["quota"] for r in mixing.highest_quotients(df, "votes", "seats", "i", "g").collect()}
    assert out == {(g, i): q for g, (v, s) in groups.items() for i, q in enumerate(highest(v, s))}


def test_targets_share_the_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 40, None: 3000, "z": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    out = {r["source"]: r for r in mixing.targets(df).collect()}
    order = ["a", "b", "c", "d", "z", None]
    weight, full, total = {s: i % 3 + 1 for i, s in enumerate(order)}, set(), sum(sizes.values())
    while True:       # round by round, as the rule says
        rest = total - sum(3 * sizes[s] for s in full)
        aim = {s: 3 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in order if x not in full) for s in order}
        above = {s for s in order if aim[s] > 3 * sizes[s]}
        if not above:
            break
        full |= above
    assert {s: out[s]["src"] for s in order} == {s: i for i, s in enumerate(order)}
    assert all(out[s]["target"] == pytest.approx(aim[s]) for s in order)


def test_mix_keeps_its_rules(spark):
    """Several shards a source, one source with a third of all rows; texts
    rendered from the copies hold the words taken."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(rng.choice([0, 1, 3, 20, 200]))), "en", rng.choice("aaabcdefg"), 0) for i in range(400)]
    df = spark.createDataFrame(rows, DOCS)
    mixed = mixing.mix(df, block_words=8, shard_rows=25, keep=("text",)).cache()
    out = mixed.collect()
    assert len({r["shard"] for r in out if r["src"] == 0}) > 3
    for source in {r["src"] for r in out}:
        own = [r for r in out if r["src"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 8 * (1 + len({r["shard"] for r in own}))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    again = mixing.mix(df.repartition(5), block_words=8, shard_rows=25).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in out)
    texts = Counter()
    for r in mixing.mixed_texts(mixed).collect():
        texts[r["doc_id"]] += len(r["text"].split())
        assert r["text"] in " ".join(rows[r["doc_id"]][1].split())
    assert texts == Counter({r["doc_id"]: r["taken"] for r in out if r["taken"]})


def test_mix_edges(spark):
    out = mixing.mix(documents(spark), block_words=4)
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted((r[0] for r in ROWS), key=str)
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["size"] == got[2]["size"] == got[3]["size"] == 0 and got[1]["taken"] == 0
    assert got[6]["size"] == 1 and got[7]["size"] == 5 * 8_000 == len(LONG_TEXT.split()) and LONG_WORD
    assert got[3]["source_size"] == sum(len(r[1].split()) for r in ROWS if r[3] is None)
    assert mixing.mix(documents(spark, [])).collect() == []
    none = documents(spark, [r for r in ROWS if r[0] in (1, 2, 3)]).drop(*CLASH)
    assert all(r["taken"] == 0 and r["target"] == 0 for r in mixing.mix(none).collect())


# ------------------------------------------------------------------ secrets

def plain_entropy(hit):
    """(first, end) of the windows at or above the threshold, None without."""
    if not any(a.isalpha() != b.isalpha() and a.isalnum() and b.isalnum() for a, b in zip(hit, hit[1:])):
        return None
    bits = next(b for p, b in secrets.CLASSES if re.search(p, hit))
    entropy = lambda w: -sum(c / len(w) * math.log2(c / len(w)) for c in Counter(w).values())
    at = [i for i in range(len(hit) - secrets.WINDOW + 1) if entropy(hit[i:i + secrets.WINDOW]) >= bits - 1e-12]
    return (at[0], at[-1] + secrets.WINDOW) if at else None


def test_entropy_of_random_strings(spark):
    rng, rows = random.Random(8), []
    for i in range(300):
        letters = rng.choice(["0123456789ABCDEFabcdef", "ABCDEFGHIJ0123456789", "abcdefghijkl0123456789XYZ", "abc019_-", secrets.ALPHABET,
                              "ab1", "abcdefghijklmnop", "a/1-"])
        rows.append((i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(15, 70))) for _ in range(3))))
    out = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    n = 0
    for i, text in rows:
        base = [(s.start, s.end) for s in out[i]["base_spans"]]
        want = []
        for m in re.finditer(secrets.CANDIDATE, text):
            found = plain_entropy(m[0])
            span = found and (m.start() + found[0], m.start() + found[1])
            if span and not any(a <= span[0] and b >= span[1] for a, b in base):
                want.append(span)
        assert [(s.start, s.end) for s in out[i]["all_spans"] if s.kind == "entropy"] == want, text
        n += len(want)
    assert n > 200


def test_long_texts_of_any_characters(spark):
    """No pattern recurses and no step is repeated for every match."""
    n = 1_000_000
    texts = ["a/1/" * (n // 4), "a1" * (n // 2), "-/" * (n // 2), "password: abc123XYZ " * (n // 100), "0123456789abcdef01234567 " * (n // 100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert got[0] == texts[0] and got[1] == "[SECRET]" and got[2] == texts[2]
    assert got[3] == "[SECRET] " * (n // 100) and got[4] == "[SECRET] " * (n // 100)
    plan = secrets.scan(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 12


def test_roles_stay_as_given(spark):
    """Only layouts with names of their own are mapped."""
    rows = [('{"turn":0,"role":"Human","text":"a"}', [("Human", "a")]), ('{"turn":0,"role":"gpt","text":"a"}', [("gpt", "a")]),
            ('{"messages":[{"role":"Bot","content":"a"}]}', [("Bot", "a")]),
            ('{"conversations":[{"from":"Human","value":"u"}]}', [("user", "u")])]
    for text, want in rows:
        got = chat.canonical_turns(spark.range(1).select(F.parse_json(F.lit(text)).alias("r")), "r").first()
        assert [(t.role, t.text) for t in got["turns"]] == want
