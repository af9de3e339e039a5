"""Readers, writers, streaming, classifier and the whole job."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from corpuswash.model import SEGMENT, SESSION, session_lists, to_utterances
from corpuswash.operators import audit as A
from corpuswash.operators import classify, stats
from corpuswash.operators.lexicon import Lexicon
from corpuswash.operators.rowchain import apply_named
from corpuswash.operators.rules import Rule
from corpuswash.plans.clean import Extensions, Lexicons, clean
from corpuswash.plans.config import CleanConfig
from corpuswash.sources import readers, writers
from corpuswash.streaming import rowchain as stream

SCHEMA = "dataset string, file_id string, session_id long, turn long, part int, text string"
LINES = [
    '["a", "b"]', "", "not json", "[]", '"text"', '{"a": 1}', '["one"]', '["  "]', '["line\\nbreak", "🐹"]', '["a", null]',
]


@pytest.fixture()
def tree(tmp_path):
    (tmp_path / "chat").mkdir()
    (tmp_path / "web").mkdir()
    (tmp_path / "chat" / "one.jsonl").write_text("﻿" + "\n".join(LINES), encoding="utf-8")
    with gzip.open(tmp_path / "chat" / "two.jsonl.gz", "wt", encoding="utf-8") as f:
        f.write('["x", "y", "z"]\n')
    doc = {"type": "text-only", "instances": [{"text": " hi "}, {"text": "  "}, {"text": "there"}]}
    (tmp_path / "web" / "page.json").write_text(json.dumps(doc, indent=2), encoding="utf-8")
    return tmp_path


def turns(df):
    return sorted(r["turns"] for r in session_lists(df).collect())


def test_dialogues(spark, tree):
    df = readers.dialogues(spark, f"{tree}/chat/one.jsonl")
    assert turns(df) == sorted([["a", "b"], ["one"], ["  "], ["line\nbreak", "🐹"]])
    assert {(r["dataset"], r["file_id"]) for r in df.collect()} == {("chat", "chat_one")}
    bad = readers.malformed_lines(spark, f"{tree}/chat/one.jsonl").first()
    assert bad["lines"] == 4


def test_raw_tree_and_dataset_selection(spark, tree):
    everything = readers.raw_tree(spark, str(tree))
    assert {r["file_id"] for r in everything.collect()} == {"chat_one", "chat_two", "web_page.json"}
    assert turns(readers.raw_tree(spark, str(tree), "web")) == [["hi"], ["there"]]
    assert everything.select(*SESSION).distinct().count() == 7
    with pytest.raises(FileNotFoundError):
        readers.raw_tree(spark, str(tree), "missing")


def test_dialogues_with_ids(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.jsonl").write_text('["id1", ["a", "b", "c"]]\n["id2", ["d"]]\n', encoding="utf-8")
    df = readers.dialogues(spark, f"{tmp_path}/d/x.jsonl", have_id=True)
    assert turns(df) == [["a", "b", "c"], ["d"]]


def test_word_lists(spark, tmp_path):
    (tmp_path / "w.txt").write_text(" b \n\na\nb\n", encoding="utf-8")
    lex = Lexicon.of(readers.word_list(spark, f"{tmp_path}/w.txt"))
    assert [r["word"] for r in lex.df.orderBy("ord").collect()] == ["b", "a"]
    (tmp_path / "s.txt").write_text("!\t\t12\n?\t\t3\n", encoding="utf-8")
    assert {r["word"] for r in readers.symbol_list(spark, f"{tmp_path}/s.txt").collect()} == {"!", "?"}


def segments(spark):
    rows = [("d", "f", 1, t, 0, x, "0") for t, x in enumerate(["a", "b\nc"])] + [("e", "g", 2, 0, 0, "only", "0")]
    rows += [("d", "f", 3, t, 0, f"t{t}", "0") for t in range(5)]
    return spark.createDataFrame(rows, SCHEMA + ", segment string")


def test_text_round_trip(spark, tmp_path):
    writers.write_text(segments(spark), f"{tmp_path}/out", max_turns=4)
    back = readers.cleaned_text(spark, f"{tmp_path}/out/lines/*/*.txt")
    assert turns(back) == [["a", "b c"], ["only"]]
    big = spark.read.json(f"{tmp_path}/out/oversized")
    assert [r["text"] for r in big.orderBy("turn").collect()] == [f"t{i}" for i in range(5)]
    assert sorted(turns(readers.cleaned(spark, f"{tmp_path}/out"))) == [["a", "b c"], ["only"], [f"t{i}" for i in range(5)]]


def test_jsonl_round_trip(spark, tmp_path):
    writers.write_jsonl(segments(spark), f"{tmp_path}/out")
    lines = sorted(json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/out/lines").collect())
    assert lines == [["a", "b c"], ["only"], ["t0", "t1", "t2", "t3", "t4"]]


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([("d", "f", i, 0, 0, t) for i, t in enumerate(["#a# x", "", "转发", "y 🐹"])], SCHEMA)
    rows.write.parquet(f"{tmp_path}/in")
    cfg = CleanConfig().on("de_hashtag", "no_specific_utter", "de_emoji")
    src = stream.read_stream(spark, f"{tmp_path}/in", rows.schema)
    stream.append_parquet(stream.clean_stream(src, cfg), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(60)
    got = {(r["session_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {(r["session_id"], r["text"]) for r in clean(rows, cfg).segments.collect()}
    assert got == want == {(0, "x"), (3, "y")}


def test_classifier(spark):
    data = [(i, "bad awful words" if i % 2 else "kind gentle words", i % 2) for i in range(40)]
    texts = spark.createDataFrame(data, "id long, text string, toxic int")
    labelled = classify.join_labels(texts.select("id", "text"), texts.select("id", "toxic"), "id", "toxic")
    model = classify.fit_offence_model(labelled, features=256)
    kept = classify.inoffensive(texts, model)
    assert {r["toxic"] for r in kept.collect()} == {0} and kept.count() == 20
    by_rule = classify.inoffensive(texts, lambda t: F.contains(t, F.lit("awful")).cast("int"))
    assert by_rule.count() == 20
    assert {r["label"]: r["texts"] for r in classify.class_counts(labelled).collect()} == {0.0: 20, 1.0: 20}


def test_counted_scores(spark):
    data = [(i, "bad awful words" if i % 2 else "kind gentle words", i % 2) for i in range(40)]
    texts = spark.createDataFrame(data + [(40, None, None), (41, "awful", None), (42, "", None)], "id long, text string, toxic int")
    labelled = classify.join_labels(texts.select("id", "text"), texts.select("id", "toxic").where("toxic is not null"), "id", "toxic")
    got = {r["id"]: r["offensive"] for r in classify.counted_scores(texts, labelled, "id").collect()}
    assert got == {**{i: bool(y) for i, _, y in data}, 40: False, 41: True, 42: False}
    none = {r["offensive"] for r in classify.counted_scores(texts, labelled.where("label = 0"), "id").collect()}
    assert none == {False}


def test_whole_job(spark, tmp_path):
    dialogs = [["hello there", "#tag# fine day", "转发", "see QQ12345678, now"], ["same", "same"], ["hello badword", "ok then"]]
    rows = spark.createDataFrame([("d", "f", s, t, 0, x) for s, d in enumerate(dialogs) for t, x in enumerate(d)], SCHEMA)
    black = Lexicon.of(spark.createDataFrame([("badword", 0)], "word string, ord long"))
    cfg = CleanConfig.basic().on("no_utter_dup", "de_hashtag", "no_specific_utter")
    for materialize in (False, True):
        out = clean(rows, cfg, Lexicons(black), materialize=materialize)
        got = sorted(r["turns"] for r in session_lists(out.segments, SEGMENT).collect())
        assert got == [["hello", "ok then"], ["hello there", "fine day"], ["see now"]]
        log = {(r["category"], r["reason"]) for r in out.audit.collect()}
        assert log == {
            ("other", "less_pair"), ("emoji", "hashtag"), ("other", "specific_utter"), ("other", "de_qq"),
            ("other", "cleantext"), ("str_blacklist", "badword"),
        }
    writers.write_audit(out.audit, f"{tmp_path}/audit")
    counts = spark.read.json(f"{tmp_path}/audit/word_counts").first()
    assert (counts["word"], counts["utterances"]) == ("badword", 1)
    assert {r["utterances"] for r in A.rule_counts(out.audit).collect()} == {1}


def test_audit_can_be_switched_off(spark):
    rows = spark.createDataFrame([("d", "f", 0, 0, 0, "a\u0007b")], SCHEMA)
    out = clean(rows, CleanConfig(audit=False).on("bert_clean"))
    assert out.audit is None and out.segments.first()["text"] == "ab"


def test_user_rule_and_empty_input(spark):
    rows = spark.createDataFrame([("d", "f", 0, 0, 0, "Abc")], SCHEMA)
    lower = Rule("X1", None, "edit", "user", "lower", lambda t, c: F.lower(t))
    assert clean(rows, CleanConfig(), ext=Extensions((lower,))).segments.first()["text"] == "abc"
    assert clean(rows.where("false"), CleanConfig.full()).segments.count() == 0


def test_null_values(spark):
    rows = spark.createDataFrame([("d", None, 0, 0, 0, None), ("d", None, 0, 1, 0, "x y")], SCHEMA)
    assert [r["text"] for r in clean(rows, CleanConfig.basic().off("no_str_blacklist")).segments.collect()] == ["x y"]


def test_presets():
    assert len(CleanConfig.flags()) == 39
    assert not CleanConfig.full().no_str_blacklist and CleanConfig.basic().no_str_blacklist


def test_documents_as_single_turn_sessions(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    df = to_utterances(docs, "doc_id", dataset=F.lit("docs"))
    assert df.count() == 2 and stats.corpus_statistics(df).first()["sessions"] == 2
    assert apply_named(df, "B0").count() == 2
