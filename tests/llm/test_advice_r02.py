"""Cases of the second review."""

import math
import random
import zlib

import numpy as np

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import catalog, linededup, packing, quality, secrets, sharding

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ op 6

def test_op6_rewrites_the_shards(spark, monkeypatch, tmp_path):
    """The result is what stands in the written shards."""
    monkeypatch.setattr(sharding, "scratch_path", lambda _, name: str(tmp_path / name))
    out = {r["doc_id"]: r for r in catalog.op6_resharding(spark, SF).collect()}
    back = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert len(back) == len(out) > 0
    for r in back:
        want = out[r["doc_id"]]
        assert (r["new_shard"], r["new_slot"], zlib.crc32(r["text"].encode())) == (want["shard"], want["slot"], want["text_crc32"])


def test_rewrite_repeated_rows_and_untouched_shards(spark, tmp_path):
    rows = [(i // 2 if i < 40 else None, "same" if i < 40 else "x" * (i % 3)) for i in range(60)]
    rows += [(1000 + i, "y" * 20) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    at = F.when(F.col("doc_id") >= 1000, F.lit(2)).otherwise(F.lit(0))
    placed = sharding.materialize(df.select("doc_id", sharding.text_size(F.col("text")).alias("size"),
                                            sharding.text_crc(F.col("text")).alias("text_crc32"), at.alias("old_shard"))
                                  .withColumn("slot", F.monotonically_increasing_id())
                                  .withColumn("shard", F.when(F.col("old_shard") == 2, 2).otherwise((F.col("slot") % 2).cast("int"))), "p")
    path = str(tmp_path / "out")
    touched = sharding.rewrite_affected(df, placed, path)
    assert {r[0] for r in touched.collect()} == {0, 1}
    assert 2 not in {r["new_shard"] for r in spark.read.parquet(path).collect()}
    got = sharding.read_back(df, placed, touched, path).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(rows, key=key)
    assert (sorted((r["new_shard"], r["new_slot"]) for r in got)
            == sorted((r["shard"], r["slot"]) for r in placed.collect()))


# ------------------------------------------------------------------ op 8

def words_of(rng, alphabet, n=40):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 6))) for _ in range(n))


def test_control_characters(spark):
    """U+0001 is a character like others and no mark of a text's start."""
    rows = [(1, "\x01", "en"), (2, "one \x01\x01\x01 two \x00", "en"), (3, "plain words", "en"), (4, "\ud7ff\ue000\U00010000x\uffff", "en")]
    out = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len(out) == 4 and all(r["log_perplexity"] > 0 for r in out.values())
    assert [len(x) for x in quality.packed_grams([r[1] for r in rows])] == [sum(n for n in (1, 13, 11, 6)), 4]


def test_full_keys_in_both_ways(spark, monkeypatch):
    """Every n-gram keeps its own probability, broadcast or joined; characters
    beyond 12 bits and languages are not merged."""
    rng = random.Random(1)
    cjk = "".join(chr(0x4E00 + i) for i in range(6000))
    rows = [(i, words_of(rng, cjk if i % 2 else "abcdefgh \U0001f600"), f"l{i % 3}" if i else None) for i in range(60)] + [(60, None, "l0"), (None, "", "l1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    probs = quality.probabilities(quality.materialize(quality.count_grams(df), "g")).persist()
    assert {r[0] for r in probs.select("lang").distinct().collect()} == {"l0", "l1", "l2", "und"}
    small = {r["doc_id"]: r for r in quality.score(df, probs).collect()}
    monkeypatch.setattr(quality, "BROADCAST_GRAMS", 0)
    large = {r["doc_id"]: r for r in quality.score(df, probs).collect()}
    assert set(small) == set(large) == {r[0] for r in rows}
    table = {(r["lang"], r["g"]): math.log(r["p"]) for r in probs.collect()}
    for i, text, lang in rows:
        grams = quality.packed_grams([text or ""])[0].tolist()
        want = pytest.approx(-sum(table[lang or "und", g] for g in grams) / len(grams), rel=1e-5) if grams else None
        assert small[i]["log_perplexity"] == want and large[i]["log_perplexity"] == want
        assert small[i]["n_words"] == large[i]["n_words"]


def test_planted_foreign_texts_leave_the_band(spark):
    """Texts in another language than labelled go; few of the corpus's own do."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    french = [r["text"] for r in docs.filter("lang = 'fr' and length(text) > 2000").orderBy("doc_id").limit(5).collect()]
    planted = spark.createDataFrame([(-1 - i, t, "en") for i, t in enumerate(french)], docs.schema)
    out = {r["doc_id"]: r for r in quality.judge(docs.unionByName(planted)).collect()}
    assert len(french) == 5
    assert not [out[i] for i in range(-5, 0) if out[i]["kept"]]
    base_ok = [r for i, r in out.items() if i > 0 and not r["base_failed"]]
    assert sum(not r["kept"] for r in base_ok) < 0.06 * len(base_ok)


# ------------------------------------------------------------------ op 3

def test_pieces_are_read_from_written_windows(spark, monkeypatch):
    """The result carries the ids that stand in the written windows, and the
    pipeline's last stage keeps them."""
    from tokenizers import Tokenizer

    written, real = [], packing.read_pieces
    monkeypatch.setattr(packing, "read_pieces", lambda windows, *rest: written.append(windows) or real(windows, *rest))
    rows = [(1, "one two three " * 2000), (2, "four"), (3, None), (None, "five six")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.packing(spark, df, "").collect()
    assert any("/windows-" in f for f in written[0].inputFiles()) and any("/pieces-" in f for f in written[0].inputFiles())
    windows = {r["sequence_id"]: np.frombuffer(r["ids"], "<u2").astype("<u4").tobytes() for r in written[0].collect()}
    assert sum(map(len, windows.values())) == 4 * sum(r["length"] for r in out)
    tk, whole = Tokenizer.from_file(packing.default_tokenizer()), {}
    for r in sorted(out, key=lambda r: r["start"]):
        ids = bytes(r["ids"])
        assert windows[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])] == ids
        assert zlib.crc32(ids) == r["ids_crc32"]
        whole[r["doc_id"]] = whole.get(r["doc_id"], b"") + ids
    for i, text in rows:
        want = tk.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        assert whole[i] == b"".join(n.to_bytes(4, "little") for n in want)


# ------------------------------------------------------------------ op 5

def test_short_texts_and_edges_are_deduplicated(spark):
    """Copies of short texts and repeated passages at a text's edge go."""
    rows = [(1, "one line"), (2, "one line"), (3, "p\nq"), (4, "p\nq"), (5, "head\nx\ny\ntail"), (6, "head\nx\nz"),
            (7, "w\nnew\ntail"), (8, "v\ny\ntail"), (9, ""), (10, ""), (11, None), (12, "one line\nmore")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["__lines"], r["__removed"]) for r in linededup.dedup_lines(df).collect()}
    assert got == {1: ("one line", 1, 0), 2: ("", 1, 1), 3: ("p\nq", 2, 0), 4: ("", 2, 2), 5: ("head\nx\ny\ntail", 4, 0),
                   6: ("z", 3, 2), 7: ("w\nnew\ntail", 3, 0), 8: ("v", 3, 2), 9: ("", 1, 0), 10: ("", 1, 0),
                   11: (None, 0, 0), 12: ("one line\nmore", 2, 0)}
    docs = spark.createDataFrame([(1, "one line", 8), (2, "one line", 8)], "doc_id long, text string, n_chars long")
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()} == {1: "one line", 2: ""}


# ------------------------------------------------------------------ op 10

def test_sample_words_allow_only_themselves(spark):
    """A key beside a sample's word is found; the word's own text is not."""
    rng = random.Random(2)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwyz0123456789") for _ in range(40))
    long = "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(100)) + "XxXx" + key
    texts = [f"sample_key={key}", f"v1/samples/{key}", long, "this-is-an-example-of-a-long-slug", "dummy-dummy-placeholder-x1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert all(key not in got[i] and "[SECRET]" in got[i] for i in (0, 1, 2))
    assert got[3] == texts[3] and got[4] == texts[4]


# ------------------------------------------------------------------ pipeline

def test_repeated_ids_with_other_texts_survive(spark):
    rng = random.Random(4)
    text = lambda: words_of(rng, "abcdefghijklmnop", 60)
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, b), (1, b), (2, b), (3, c), (4, c), (None, a)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.simhash_dedup(spark, df, "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted([(1, a), (1, b), (3, c), (None, a)], key=str)


def test_documents_without_any_language_survive(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, "123", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in corpus_pipeline.language_id(spark, df, "").collect()] == [1]
