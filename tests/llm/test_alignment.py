"""Alignment of two tokenizers against a plain version; expansion in parts; odd rows."""

import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from corpuswash.llm import alignment, pieces
from corpuswash.llm.queries import queries, tokenizer_path

PATHS = (tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(docs):
    """Offsets and links one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    table = pieces.byte_level_bytes()
    out, links, held = [], [], defaultdict(set)
    for i, (_, text) in enumerate(docs):
        ids = ([], []) if not text else (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
        spelled = ([bytes(table[c] for c in a.id_to_token(x)) for x in ids[0]], [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids[1]])
        if not text or any(b"".join(s) != b" " + text.encode() for s in spelled):
            out.append((0, 0, 0, 0, ""))
            links.append([])
            continue
        ends = [{}, {}]
        for side in (0, 1):
            at = 0
            for k, s in enumerate(spelled[side]):
                at += len(s)
                ends[side][at] = k + 1
        groups, last = [], (0, 0)
        for x in sorted(set(ends[0]) & set(ends[1])):
            to = (ends[0][x], ends[1][x])
            groups.append((ids[0][last[0] : to[0]], ids[1][last[1] : to[1]]))
            last = to
        own = [(x, y) for p, q in groups for x in p for y in q]
        for x in set(own):
            held[x].add(i)
        links.append(own)
        out.append((len(ids[0]), len(ids[1]), len(groups), len(own), sha256(";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (x, _), d in held.items():
        best[x] = max(best[x], len(d))
    return sorted(((i if i is not None else -1), *o[:4], sum(len(held[x]) == best[x[0]] for x in own), sum(len(held[x]) for x in own), o[4]) for (i, _), o, own in zip(docs, out, links, strict=True))


def made(n=120, seed=4):
    rng = random.Random(seed)
    parts = ["the", " of", "ation", "ing", " Wörter", "\n", "  ", "\t", "é", "東京", "<|endoftext|>", "</s>", ".", ", ", "1234", "🐹", "a", "_", " ", "don't", " x.y", "\r\n", "\x00"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    return [*docs, (n, None), (n + 1, ""), (n + 2, " "), (n + 3, "▁"), (n + 4, "a▁b"), (n + 5, docs[3][1]), (n + 5, docs[3][1]), (None, "the of the"), (n + 6, "z" * 30_000), (n + 7, "the of " * 9_000), (n + 8, " the"), (n + 9, "́​")]


@pytest.mark.parametrize("bound", [alignment.BROADCAST_PAIRS, 0])
def test_equal_to_plain_offsets(spark, bound):
    docs = made()
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], "doc_id long, text string, pair string, n_a int").repartition(5)
    got = alignment.align(df, *PATHS, broadcast_pairs=bound)
    assert got.columns == COLUMNS
    assert [(f.name, f.dataType.simpleString()) for f in got.schema][:-1] == [(c, "bigint") for c in COLUMNS[:-1]]
    assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got.collect()) == plain(docs)
    assert alignment.align(df.limit(0), *PATHS, broadcast_pairs=bound).collect() == []


def test_ids_of_cut_texts_are_those_of_whole_texts():
    work = alignment.Aligner(*PATHS)
    assert work.b.cuts
    texts = [f" {t}" for _, t in made(600, 9) if t]
    for text, (a, b) in zip(texts, work.ids(texts), strict=True):
        assert a.tolist() == work.a.whole([text])[0].tolist()
        assert b.tolist() == work.b.whole([text])[0].tolist()


def test_memory_forgets_the_older_half():
    coder = pieces.ByteLevel(PATHS[0], most=4_000)
    texts = [t for _, t in made(900, 11) if t]
    for at in range(0, len(texts), 40):
        some = texts[at : at + 40]
        assert [x.tolist() for x in coder(some)] == [x.tolist() for x in coder.whole(some)]
    assert coder.memory.base > 0


def test_memory_keeps_pieces_that_come_again():
    asked = []

    def encode(some):
        asked.extend(some)
        return np.array([len(p) for p in some], np.uint32), np.ones(len(some), np.int64)

    memory = pieces.Memory(encode, most=20_000)
    for at in range(100):
        batch = [*[f"once{at}-{i}" for i in range(50)], "often", "x" * (at + pieces.LONG - 20)]
        ids, start, size = memory(batch)
        assert ids[start].tolist() == [len(p) for p in batch] and size.tolist() == [1] * len(batch)
        assert memory.bytes == memory.cost[: memory.count].sum() and len(memory.place) <= memory.count
    assert memory.base > 3_000 and asked.count("often") == 1


def test_expansion_in_parts_is_the_same():
    rng = np.random.default_rng(2)
    docs = []
    for _ in range(12):
        size_a, size_b = rng.integers(1, 30, 40), rng.integers(1, 30, 40)
        docs.append((rng.integers(0, 50, size_a.sum()), rng.integers(0, 60, size_b.sum()), size_a, size_b))
    docs.insert(4, (np.zeros(0, np.int64),) * 4)
    results = [{(int(i), int(p), int(n)) for who, pair, links in alignment.expanded(docs, most) for i, p, n in zip(who, pair, links, strict=True)} for most in (10**9, 30_000, 500, 1)]
    assert all(r == results[0] for r in results)
    assert sum(n for *_, n in results[0]) == sum(int((d[2] * d[3]).sum()) for d in docs)


def test_query_over_the_given_table(spark):
    got = queries()["op13_alignment"](spark, "/root/testdata/sf0.001").collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(tuple(r) for r in got) == plain(docs)


def test_new_pieces_reach_the_library_in_short_runs(monkeypatch):
    coder = pieces.ByteLevel(PATHS[0])
    own, seen = coder.whole, []
    monkeypatch.setattr(coder, "whole", lambda texts: seen.extend(t.count("\n") + 1 for t in texts) or own(texts))
    text = " ".join(f"w{i}x" for i in range(3 * pieces.RUN + 7)) + "\nend"
    assert [x.tolist() for x in coder([text])] == [x.tolist() for x in own([text])]
    assert max(seen) == pieces.RUN and len(seen) == 4
