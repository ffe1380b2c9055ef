"""Nulls, empty and very long texts, repeated rows, empty tables and extra
columns whose names the operators use inside."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import (chat, embedding, langid, linededup, packing, quality, secrets, sharding, simhash,
                         tokenizing)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["id", "h", "size", "shard", "slot", "block", "old_shard", "text_hash", "pos", "lines", "fp", "label",
         "vertex", "start", "length", "ids", "crc", "score", "held_out", "spans", "base_spans", "g", "c", "low",
         "high", "starts", "key", "which", "nth", "part", "component_id"]
LONG_WORD, LONG_TEXT = "x1Y" * 40_000, "Word after word goes on.\n" * 8_000
ROWS = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4),
    (4, "The same text here, and more of it.", "en", "a", 35), (4, "The same text here, and more of it.", "en", "a", 35),
    (5, "The same text here, and more of it.", "en", "b", 35), (None, "No id on this one at all.", "en", None, 25),
    (6, LONG_WORD, "de", "a", len(LONG_WORD)), (7, LONG_TEXT, "de", "a", len(LONG_TEXT)),
    (8, "Ünïcode 日本語 👩‍👩‍👧 é́ İ\x1c\x85end", "fr", "c", 30), (9, "a\nb\nc\nd", "fr", "c", 7), (10, "z\na\nb\nc", "fr", "c", 7),
]


def documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})


def path_and_pattern():
    return tokenizing._default_file()


OPERATORS = {
    "encode": lambda d: tokenizing.decode(tokenizing.encode(d, *path_and_pattern()), *path_and_pattern()),
    "langid": lambda d: langid.predict(d, langid.train(d), keep=("source",)),
    "simhash": simhash.near_duplicates,
    "linededup": linededup.dedup_lines,
    "sharding": lambda d: sharding.reshard(d, F.lit(0), 4),
    "quality": quality.judge,
    "secrets": secrets.scan,
    "redact": secrets.redact,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, name):
    out = OPERATORS[name](documents(spark)).select("doc_id").collect()
    assert sorted((r[0] for r in out), key=str) == sorted((r[0] for r in ROWS), key=str)


@pytest.mark.parametrize("name", [*OPERATORS, "packing"])
def test_empty_table(spark, name):
    run = OPERATORS.get(name) or (lambda d: packing.pack_documents(d, packing.default_tokenizer()))
    assert run(documents(spark, [])).collect() == []


def test_packing_edges(spark):
    out = packing.pack_documents(documents(spark), packing.default_tokenizer()).collect()
    assert {r["doc_id"] for r in out} == {r[0] for r in ROWS}
    assert [r["length"] for r in out if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]


def test_stages_keep_the_columns(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert out.dtypes == docs.dtypes, name
        assert stage(spark, documents(spark, []), "").collect() == [], name
        out.count()


def test_stages_decide(spark):
    by_name = dict(corpus_pipeline.STAGES)
    docs = documents(spark)
    ids = lambda d: sorted(r[0] for r in d.select("doc_id").collect() if r[0] is not None)
    assert not {1, 2, 3} & set(ids(by_name["language_id"](spark, docs, "")))
    lines = {r["doc_id"]: r for r in by_name["line_dedup"](spark, docs, "").collect()}
    assert lines[9]["text"] == "a\nb\nc\nd" and lines[10]["text"] == "z" and lines[10]["n_chars"] == 1
    assert lines[7]["text"] == "Word after word goes on.\n"      # its first line and the empty last one
    assert ids(by_name["simhash_dedup"](spark, docs, "")).count(4) == 1
    assert 5 not in ids(by_name["simhash_dedup"](spark, docs, ""))
    hidden = spark.createDataFrame([(1, "my password = hunter2hunter2 ok", "en", "s", 31)], DOCS)
    assert by_name["secret_scan"](spark, hidden, "").first()["text"] == "my [SECRET] ok"


def test_pipeline_equals_its_stages(spark, sf_small):
    out = corpus_pipeline.run(spark, sf_small)
    tokens = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    short = [r["n"] for r in tokens if r["n"] != 4096]
    assert all(n & (n - 1) == 0 for n in short) and len(short) < 13
    assert out.select("doc_id").distinct().count() > 100


def test_conversations_edges(spark):
    rows = spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", ""), (2, 0, None, "\\ <|im_end|> [INST]"),
                                  (2, 0, None, "\\ <|im_end|> [INST]"), (None, 0, "assistant", "x" * 300_000)],
                                 "conv_id long, turn long, role string, text string")
    extra = rows.withColumns({c: F.lit("e") for c in ("part", "at", "formatted", "turns", "from", "to")})
    records = extra.select("conv_id", "turn", F.to_variant_object(F.struct("turn", "role", "text")).alias("record"))
    turns = chat.canonical_turns(records, "record").select("conv_id", "turn", F.inline("turns"))
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert [(t.role, t.text) for t in out[1]["turns"]] == [("user", ""), ("assistant", "")]
    assert [(t.role, t.text) for t in out[2]["turns"]] == [("", "\\ <|im_end|> [INST]")] * 2
    assert out[None]["loss"] == "x" * 300_000
    assert chat.format_turns(rows.limit(0)).collect() == []


def test_vectors_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1),
            (5, [1.0, None], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0, 0.0], 1),
            (10, [], 1), (None, [1.0, 0.0], 2), (11, [1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({c: F.lit("e") for c in ("cid", "members", "vector", "block", "ok", "dim", "links")})
    out = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding.near_duplicates(df).collect()), key=str)
    want = [(1, 2, 1), (2, 2, 1), (2, 2, 1), *((i, 0, i) for i in range(3, 11)), (None, 1, 11), (11, 1, 11)]
    assert out == sorted(want, key=str)
    assert embedding.near_duplicates(df.limit(0)).collect() == []
