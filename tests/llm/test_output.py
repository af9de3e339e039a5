"""Chat formatting, mixing, token files, decontamination, nearest neighbours and the pipeline."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuswash.llm import ann, chat, decontam, mixing, token_codes
from corpuswash.llm.queries import queries, tokenizer_path

# ---- chat ---------------------------------------------------------------------

ODD_TEXT = st.lists(st.sampled_from([*"<>/[]\\sINSTROLEY a\n", *chat.CONTROL]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(ODD_TEXT)
def test_escape_round_trip(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    assert not any(c in safe for c in chat.CONTROL)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "[ROLE]", "tool"]), ODD_TEXT), max_size=6))
def test_reader_restores_turns_and_loss(turns):
    reader = chat.Reader()
    messages = [{"role": r, "text": t} for r, t in turns]
    for piece, mark in chat.Template().pieces(iter(messages)):
        reader.feed(piece, mark)
    loss = "".join(t for r, t in turns if r == "assistant")
    assert reader.n_turns == len(turns)
    assert reader.turns.hexdigest() == sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert (reader.loss_chars, reader.loss.hexdigest()) == (len(loss), sha256(loss.encode()).hexdigest())
    text, spans = chat.Template().render(messages)
    assert len(text) == reader.chars
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == loss


def test_templates_fold_and_branch():
    t = chat.Template("{{ 'A' + 'b' | lower }}{% if 1 == 2 %}no{% else %}yes{% endif %}{% for m in messages %}{{ m['text'] | upper }}{% if loop.last %}.{% else %},{% endif %}{% endfor %}")
    assert isinstance(t.tree[0], chat.Text) and t.tree[0].value == "abyes"
    assert t.render([{"text": "a"}, {"text": "b"}])[0] == "abyesA,B."
    assert t.render([])[0] == "abyes"


@pytest.mark.parametrize("bad", ["{{ open('x') }}", "{{ m.__class__() }}", "{% import os %}", "{% if x %}", "{% for x y %}", "{{ 2 ** 9 }}", "{{ [1] }}", "{% endif %}", "{{ a b }}"])
def test_templates_refuse_what_is_outside(bad):
    with pytest.raises(chat.TemplateError):
        chat.Template(bad)


def test_conversations_with_odd_rows(spark):
    rows = [(1, 2, "assistant", "B", "x"), (1, 1, "user", None, "x"), (1, None, None, "first", "x"), (1, 2, "assistant", "B", "x"), (None, 0, "user", "n", "x"), (2, 0, "user", "<s>" * 70_000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string")
    got = {r["conv_id"]: r for r in chat.digests(df).collect()}
    assert set(got) == {1, 2, -(1 << 63)}
    assert got[1]["turns_sha256"] == sha256(b"\nfirst\nuser\n\nassistant\nB\nassistant\nB\n").hexdigest()
    assert got[1]["loss_sha256"] == sha256(b"BB").hexdigest() and got[2]["loss_chars"] == 0
    assert chat.digests(df.where("false")).count() == 0
    texts = {r["conv_id"]: r["text"] for r in chat.formatted(df).collect()}
    assert len(texts[2]) == got[2]["formatted_chars"]


# ---- mixing -------------------------------------------------------------------


def _plain_targets(sizes, weights, budget, most):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full, out = budget * sum(sizes.values()), set(), dict.fromkeys(names, 0.0)
    while True:
        free = [s for s in names if s not in full]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free} if free else {}
        over = [s for s in free if share[s] >= most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            full.add(s)


def test_mix_meets_its_targets(spark):
    r = random.Random(3)
    names = ["é", "z", "a", "B", None, "", "hot"]
    rows = [(i, "w " * int(r.paretovariate(1.1) * 5), r.choice(names + ["hot"] * 5), "q", 1) for i in range(2000)]
    rows += [(None, "one two", "a", "", 1), (5000, None, "nothing", "", 1), (7, "x y z", "a", "", 1), (7, "x y z", "a", "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = _plain_targets(sizes, mixing.WEIGHTS, 1.5, 2.0)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for x in got:
        assert x["source_size"] == sizes[x["source"]]
        assert x["target"] == pytest.approx(want[x["source"]], rel=1e-9, abs=1e-9)
        assert x["copies"] <= 2
        taken[x["source"]] += x["copies"] * x["size"]
        largest[x["source"]] = max(largest[x["source"]], x["size"])
    assert all(0 <= want[s] - taken[s] <= largest[s] * 3 for s in sizes)
    key = lambda x: (x["id"], x["h"], x["size"], str(x["source"]), x["copies"])
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(df.repartition(7)).collect()))
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert out.count() == sum(x["copies"] for x in got)
    assert mixing.mix(df.where("false")).count() == 0


def test_a_large_document_that_comes_early_does_not_starve_its_source(spark):
    """One document holds most of its source; wherever it comes, the source ends within a typical document of its target."""
    r = random.Random(11)
    for big in (3_000, 400):
        rows = [(i, "w " * (big if i == 40 else r.randint(5, 25)), "one") for i in range(60)]
        rows += [(100 + i, "w " * r.randint(5, 25), "two") for i in range(40)] + [(7, f"x{k} " * r.randint(5, 25), "three") for k in range(60)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        for seed in (17,):
            got = mixing.mix(df, seed=seed).collect()
            for source in ("one", "two", "three"):
                own = [x for x in got if x["source"] == source]
                short = own[0]["target"] - sum(x["copies"] * x["size"] for x in own)
                most = max(x["copies"] for x in own)
                assert short >= 0
                # short by less than a typical document, or all documents but the large one are taken once more
                assert short <= 25 or all(x["copies"] == most for x in own if x["id"] != 40)
            assert mixing.mixed(df, seed=seed).count() == sum(x["copies"] for x in got)


def test_mixing_handles_empty_and_very_long_texts(spark):
    rows = [(1, "", "a"), (2, None, "a"), (3, "w " * 300_000, "a"), (4, " \n", None), (4, "w", None)]
    got = {(x["id"], x["size"]): x["copies"] * x["size"] for x in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 300_000), (4, 0), (4, 1)} and got[3, 300_000] in (300_000, 600_000)


# ---- token files --------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**31) | st.integers(0, 300), max_size=1500))
def test_codes_give_every_id_directly(ids):
    codes = token_codes.Codes(token_codes.encode(np.array(ids, np.uint32)))
    assert codes.all().tolist() == ids
    assert [codes[i] for i in range(0, len(ids), 7)] == ids[::7]


def test_pieces_give_the_ids_of_whole_texts():
    coder = token_codes.Encoder(tokenizer_path())
    r = random.Random(2)
    bits = ["word", " ", "  ", "\n", ".", ",", "it's", "Ünï", "12", "\t", " ", "<|endoftext|>", "…", "'s", "日本", "\r\n", "a.b", "...", "\x01", "é", " ", "\x85", "\x1c"]
    texts = ["", " ", "plain words, and more.\nNext line", *("".join(r.choice(bits) for _ in range(r.randint(1, 30))) for _ in range(1500))]
    want = [e.ids for e in coder.model.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in coder(texts)] == want
    assert [x.tolist() for x in coder(texts)] == want  # from memory


def test_token_files_read_back(spark):
    from tokenizers import Tokenizer

    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["alpha", "beta,", "gamma."]) for _ in range(r.randint(0, 300))), "x") for i in range(0, 600, 2)]
    rows += [(3, None, "x"), (5, "", "x"), (7, "b", "x"), (7, "a", "x"), (None, "n", "x"), (9, "long text " * 30_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = sorted(token_codes.token_ids(df, tokenizer_path(), file_tokens=5000).collect(), key=lambda x: x["start"])
    model, at = Tokenizer.from_file(tokenizer_path()), 0
    order = sorted(((-(1 << 63) if i is None else i, t or "") for i, t, _ in rows))
    for (i, t), x in zip(order, got, strict=True):
        ids = np.array([*model.encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert (x["doc_id"], x["start"], x["n_tokens"], x["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_codes.token_ids(df.where("false"), tokenizer_path()).count() == 0


# ---- decontamination ----------------------------------------------------------


def _plain_hits(text, items, size):
    w = [x.decode() for x in decontam.words_of(text)]
    hit, found = set(), set()
    for item, t in items:
        v = [x.decode() for x in decontam.words_of(t)]
        n = min(size, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    hit.update(range(j, j + n))
                    found |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_hits_equal_plain_search(spark, block):
    r = random.Random(7)
    words = ["ab", "a", "b", "Cd", "é", "x1", "1"]
    text = lambda n: r.choice([" ", ", ", "\n"]).join(r.choice(words) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 3, 5, 8]))) for i in range(3, 12)] + [(12, "a b a b a b a"), (12, "q"), (13, ""), (14, None), (None, "b b b b b")]
    items = [x for x in items if x[1] is None or len(decontam.words_of(x[1])) != 1 or x[1] == "q"]
    rows = [(i, text(r.randint(0, 60)), "x") for i in range(60)] + [(60, None, "x"), (61, "", "x"), (62, "a b " * 20_000, "x"), (1, "q", "x"), (1, "q", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.hits(docs, bench, window=4, block_bytes=block).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *_plain_hits(t, items, 4)) for i, t, _ in rows if i != 62))
    have = sorted((x["id"], x["n_words"], sum(b - a for a, b in x["ranges"]), sorted(x["items"])) for x in got if x["id"] != 62)
    assert have == want
    clean = decontam.clean(docs, bench, window=4, block_bytes=block)
    assert clean.columns == docs.columns
    assert sorted(x["doc_id"] for x in clean.collect()) == sorted(i for i, _, h, _ in want if not h)
    assert decontam.hits(docs.where("false"), bench).count() == 0
    assert {x["n_hit"] for x in decontam.report(docs.where("doc_id < 9"), bench.where("false")).collect()} == {0}


def test_parts_of_a_benchmark_are_bounded_and_one_at_a_time(spark):
    words = [f"w{i}" for i in range(4000)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "a b c")], "item_id long, text string")
    n, parts = decontam._blocks(bench, "item_id", "text", 4000, 4)
    assert iter(parts) is parts and n > 4
    parts = list(parts)
    assert max(sum(len(t) for _, t in p) for p in parts) < 3 * 4000
    together = {}
    for p in parts:
        for w, ids in decontam.windows(p, 4).items():
            together.setdefault(w, set()).update(ids)
    assert together == dict(decontam.windows([(1, " ".join(words)), (2, "a b c")], 4))


# ---- nearest neighbours ---------------------------------------------------------


def test_hilbert_visits_neighbours_one_after_the_other():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = ann.hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 16))
    v = (centres[rng.integers(0, 20, 3000)] + 0.4 * rng.standard_normal((3000, 16))).astype(np.float32)
    v[100:900] = v[100]  # one vector in many rows
    rows = [(i, x.tolist(), "c", 1) for i, x in enumerate(v)]
    odd = [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [1.0] * 15 + [None]), (5200, [1.0] * 4), (5250, [float("inf")] + [1.0] * 15), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + [(i, x, "c", 1) for i, x in odd], "vec_id long, embedding array<float>, rank string, q int")
    got = ann.search(df, F.col("vec_id") % 50 == 0, block=128).collect()
    by = {}
    for x in got:
        by.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    d = v.astype(np.float64)
    unit = d / np.linalg.norm(d, axis=1, keepdims=True)
    hit = 0
    assert set(by) == set(range(0, 3000, 50))
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        score = unit @ unit[q]
        assert all(abs(score[i] - s) < 1e-9 for _, i, s in found)
        score[q] = -2
        fifth = np.sort(score)[-5]
        hit += sum(s >= fifth - 1e-9 for _, _, s in found)
    assert hit >= 0.9 * 5 * len(by)
    assert [f[1] for f in by[200]] == [100, 101, 102, 103, 104]
    few = ann.search(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 50 == 0).collect()
    assert sorted(x["vec_id"] for x in few) == [1, 2]
    assert ann.search(df.where("false"), F.lit(True)).count() == 0
    assert ann.search(df.where("vec_id = 5000"), F.lit(True)).count() == 0


def test_many_equal_cosines_are_ranked_by_exact_score_and_id(spark):
    """Multiples of one vector, which are no equal vectors, and 59 that round to the same cosine."""
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(i, (base * f).tolist()) for i, f in enumerate(rng.uniform(0.5, 2.0, 80))] + [(100 + i, (base * 2.0**i).tolist()) for i in range(-9, 10)]
    rows += [(200 + i, rng.standard_normal(16).tolist()) for i in range(100)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id").isin(0, 100, 205)).collect()
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for q in (0, 100, 205):
        own = v[ids == q][0]
        score = ann.cosines(np.repeat(own[None], len(v), axis=0), v)
        want = sorted((-s, i) for s, i in zip(score, ids.tolist(), strict=True) if i != q)[:5]
        assert sorted((x["rank"], x["vec_id"], x["score"]) for x in got if x["query_id"] == q) == [(k, i, -s) for k, (s, i) in enumerate(want, 1)]


def test_salted_queries_and_small_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, rng.standard_normal(8).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, ann.search(df, F.col("vec_id") % 2 == 0).collect()))
    monkeypatch.setattr(ann, "ASKERS", 50)
    monkeypatch.setattr(ann, "QUERIES", 3)
    assert sorted(map(tuple, ann.search(df, F.col("vec_id") % 2 == 0).collect())) == want


# ---- registration and pipeline ---------------------------------------------------


def test_every_dealt_operator_is_registered():
    assert [k.split("_")[0] for k in queries()] == [f"op{n}" for n in range(1, 14)]


def test_pipeline_on_planted_rows(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(12)
    syllables = "th er on an in re nd at en es or ti".split()
    prose = lambda n: " ".join("".join(r.choice(syllables) for _ in range(3)) for _ in range(n))
    item = prose(20)
    rows = [(i, prose(120), "en", f"s{i % 3}") for i in range(400)]
    bad = list(range(0, 400, 8))
    for i in bad:
        rows[i] = (i, rows[i][1] + " gronkle snarfle flubber", "en", "s0")
    rows.append((400, rows[3][1], "en", "s1"))
    rows.append((401, rows[5][1] + " extra", "en", "s1"))
    rows.append((402, prose(40) + " " + item + " " + prose(40), "en", "s2"))
    labels = [(i, 1, int(i in bad)) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    starts = sorted((x["start"], x["n_tokens"]) for x in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    ids = {x["doc_id"] for x in got}
    assert not ids & {*bad, 400, 401, 402}
    assert len(ids) > 200
    for (_, stage), columns in zip(corpus_pipeline.STAGES[:-1], [None] * 4, strict=True):
        out = stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
        assert out.columns == ["doc_id", "text", "lang", "source"]


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows, a very long text, columns named like the operators' own; then empty tables."""
    import corpus_pipeline

    r = random.Random(5)
    prose = lambda n: " ".join("".join(r.choice("aeiostnr") for _ in range(5)) for _ in range(n))
    rows = [(i, prose(60), "en", "s", "x", 1) for i in range(30)]
    rows += [(None, None, None, None, None, None), (None, "", "en", None, "x", 1), (40, prose(40_000), "de", "s", "x", 1), rows[2], rows[2], (41, rows[3][1], "en", "t", "x", 1)]
    schema = "doc_id long, text string, lang string, source string, h string, same int"
    labels = [(i, 1, int(i % 5 == 0)) for i in range(20)]
    for name, some in (("full", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels[: len(some)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "a benchmark passage of eleven words that occurs in no document"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = corpus_pipeline.run(spark, str(folder)).collect()
        ids = {x["doc_id"] for x in got}
        assert ids <= {x[0] if x[0] is not None else -(1 << 63) for x in some}
        assert (40 in ids) == bool(some) and 41 not in ids
        assert sorted(x["start"] for x in got) == [sum(y["n_tokens"] for y in sorted(got, key=lambda x: x["start"])[:k]) for k in range(len(got))]


def test_workers_drop_what_tasks_of_other_stages_remember(spark):
    import gc

    from corpuswash.llm import common, pieces, toxicity

    judge = toxicity.Judge(b"foul nasty words", b"some plain words", 1, (0.0, 1.0, 1.0))

    def look(batches):
        import pyarrow as pa

        for whole in batches:
            list(common.slices(whole))
            held = sum(isinstance(x, pieces.ByteLevel) for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([held + len(getattr(common, "_KEPT", ""))])], ["n"])

    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(64)], "doc_id long, text string").repartition(4)
    token_codes.token_ids(docs, tokenizer_path()).count()
    toxicity.scored(docs, judge).count()
    assert {r["n"] for r in docs.mapInArrow(look, "n long").collect()} == {0}
