"""Instances files read by many tasks: equal to the whole-file reader, whatever the ranges."""

import json
import random

import pytest

from corpuswash.sources import instances, readers


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "301", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


ODD = ['"', "\\", "}", "{", "]", "[", ",", "\\\"", "}{", "\n", "\t", "é", "中", "🐹", " ", "a", '"text": "x"', '"instances": [', ":", "\\u0041"]


def document(rng, n):
    text = lambda: "".join(rng.choice(ODD) for _ in range(rng.randint(0, 25)))
    items = []
    for _ in range(n):
        item = {"text": text()}
        kind = rng.randint(0, 5)
        if kind == 0:
            item = {"meta": {"text": text(), "deep": [{"text": text()}, {}]}, **item, "z": [1, {"a": "}"}]}
        elif kind == 1:
            item = {"id": text()}
        elif kind == 2:
            item["text"] = None
        items.append(item)
    parts = [("type", text()), ("instances", items)]
    if rng.random() < 0.5:
        parts += [("other", [{"text": "no"}, {"text": "no"}]), ("info", {"text": "no", "instances": [{"text": "no"}]}), ("none", [])]
        rng.shuffle(parts)
    return dict(parts)


@pytest.mark.parametrize("seed", range(2))
def test_ranges_give_the_rows_of_the_whole_file(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    folder = tmp_path / "raw" / "da ta"
    folder.mkdir(parents=True)
    want = set()
    for k, n in enumerate([0, 1, 25]):
        doc = document(rng, n)
        (folder / f"f{k}.json").write_text(json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2])), encoding="utf-8")
        want |= {(f"da ta_f{k}.json", i, (x.get("text") or "").strip()) for i, x in enumerate(doc["instances"]) if (x.get("text") or "").strip()}
    path = str(tmp_path / "raw" / "*" / "*.json")
    columns = ["dataset", "file_id", "session_id", "text"]
    whole = sorted(map(tuple, readers.instances(spark, path, split=False).select(*columns).collect()))
    parts = sorted(map(tuple, readers.instances(spark, path, split=True).select(*columns).collect()))
    assert parts == whole
    assert {r[1:] for r in parts} == want
    assert len({(r["file"], r["block"]) for r in instances.pieces(spark, path).select("file", "block").collect()}) > 4


def test_a_border_inside_an_escape_or_a_string(spark, tmp_path, small_splits):
    """The same document shifted byte by byte over the border of a range."""
    folder = tmp_path / "d"
    folder.mkdir()
    texts = ['a\\"}{\\', '"}"', "{" * 40 + '\\"' * 30 + "}" * 40, "", "last }"]
    for shift in range(0, 60, 7):
        (folder / f"s{shift}.json").write_text(json.dumps({"type": "t" * shift + '\\"}', "instances": [{"text": t} for t in texts]}))
    got = readers.instances(spark, f"{folder}/*.json", split=True).select("file_id", "session_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted((f"d_s{s}.json", i, t) for s in range(0, 60, 7) for i, t in enumerate(texts) if t)


def test_size_decides_and_tree_reads_both(spark, tmp_path, monkeypatch):
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"type": "t", "instances": [{"text": f"line {i}"} for i in range(50)]}))
    seen = []
    own = instances.texts
    monkeypatch.setattr(instances, "texts", lambda *a: seen.append(1) or own(*a))
    assert readers.raw_tree(spark, str(tmp_path)).count() == 50 and not seen
    monkeypatch.setattr(readers, "SPLIT_BYTES", 100)
    assert readers.raw_tree(spark, str(tmp_path)).count() == 50 and seen
