"""SimHash classes and near-duplicate removal against plain loops."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from corpuswash.llm import simhash
from corpuswash.llm.common import components

DOCS = "doc_id long, text string, id string, fp string, h string"


def _words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return out


def _plain_fingerprint(text, k=3):
    w = _words(text)
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(nodes, linked):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def _texts(n=60, seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 4)))
    base = [" ".join(word() for _ in range(r.choice([1, 2, 5, 30, 200]))) for _ in range(n)]
    for t in base[:25]:
        w = t.split()
        w[r.randrange(len(w))] = word()
        base.append(" ".join(w))
    return [*base, *base[:10], None, "", " \n\t", "ÄÖ ß Ünï", "x" * 300_000, "w " * 50_000]


def test_classes_equal_brute_force(spark):
    rows = [(i, t, "id", "fp", "h") for i, t in enumerate(_texts())]
    rows += [rows[5], rows[5], (None, "a b c d", "", "", "")]
    got = [(r["id"], r["fp"], r["component_id"]) for r in simhash.classes(spark.createDataFrame(rows, DOCS)).collect()]
    assert len(got) == len(rows)
    fp = {i if i is not None else -(1 << 63): _plain_fingerprint(t) for i, t, *_ in rows}
    want = _classes(sorted(fp), lambda a, b: bin(fp[a] ^ fp[b]).count("1") <= 2)
    for i, f, c in got:
        assert f % (1 << 64) == fp[i]
        assert c == want[i]


@pytest.mark.parametrize("hot", [32, 1])
def test_links_span_every_class_in_small_and_hot_blocks(spark, hot):
    r = random.Random(5)
    fps = []
    for _ in range(12):
        f = r.getrandbits(64)
        fps += [f]
        for _ in range(12):
            f ^= 1 << r.randrange(64) | 1 << r.randrange(64)
            fps.append(f)
    fps += [0, 1, 3, 7, 15, (1 << 64) - 1]
    signed = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    near = lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 2
    links = [(x["a"], x["b"]) for x in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, hot).collect()]
    assert all(near(a, b) for a, b in links)
    have = set(links) | {(b, a) for a, b in links}
    assert _classes(signed, lambda a, b: (a, b) in have) == _classes(signed, near)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (500, 400), (500, 400)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 500: 400}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert simhash.classes(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.dedup(none).count() == 0


def _jaccard(a, b, k=5):
    sa, sb = ({" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if (w := _words(t)) else set() for t in (a, b))
    return 1.0 if sa == sb else len(sa & sb) / len(sa | sb)


def test_near_duplicates_against_jaccard(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    texts = []
    for _ in range(40):
        base = [word() for _ in range(r.choice([40, 120, 400]))]
        texts.append(" ".join(base))
        for edits in (1, 2, len(base) // 60, len(base) // 12):
            w = list(base)
            for _ in range(edits):
                w[r.randrange(len(w))] = word()
            texts.append(" ".join(w))
    texts += [None, "", texts[0], texts[0].upper()]
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame(rows, DOCS)
    marks = {r["id"]: (r["group"], r["keep"]) for r in simhash.near_duplicates(df).collect()}
    want = _classes(range(len(texts)), lambda a, b: _jaccard(texts[a], texts[b]) >= 0.8)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if want[i] == want[j]]
    found = sum(marks[i][0] == marks[j][0] for i, j in pairs)
    assert found >= 0.98 * len(pairs)
    assert all(want[i] == want[g] for i, (g, _) in marks.items())  # nothing is put together that is not similar
    kept = simhash.dedup(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids) == sorted({g for g, _ in marks.values()})


def test_near_copies_are_found_by_blocks_of_fingerprints(spark, monkeypatch):
    r = random.Random(13)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7)))
    texts = []
    for k in range(30):
        base = [word() for _ in range(600)]
        texts.append(" ".join(base))
        for _ in range(40 if k == 0 else 1):  # the first family fills a block beyond simhash.HOT
            w = list(base)
            w[r.randrange(len(w))] = word()
            texts.append(" ".join(w))
    df = spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], DOCS)
    whole = {x["id"]: x["group"] for x in simhash.near_duplicates(df).collect()}
    # without the pairs of rare shingles, those within two bits of each other are still found
    monkeypatch.setattr(simhash._Search, "_few", lambda self, full: self.block.select("same", F.col("same").alias("same_b")).limit(0))
    monkeypatch.setattr(simhash._Search, "crowded", lambda self: None)
    marks = {x["id"]: x["group"] for x in simhash.near_duplicates(df).collect()}
    sets = simhash.shingle_sets(texts, 5)
    fps = [int.from_bytes(simhash.simhash(h.tobytes()), "big") for h in sets]
    want = _classes(range(len(texts)), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 2 and _jaccard(texts[a], texts[b]) >= 0.8)
    assert len({*want.values()}) < len(texts) - 40
    assert marks == want
    assert all(whole[i] == whole[g] for i, g in marks.items())


def test_a_large_group_of_near_copies_leaves_one(spark):
    r = random.Random(1)
    base = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    rows = [(i, " ".join([*base[: i % 300], f"edit{i}", *base[i % 300 + 1 :]]), "", "", "") for i in range(400)]
    assert simhash.dedup(spark.createDataFrame(rows, DOCS)).count() == 1


def test_members_of_a_large_block_meet_beyond_its_leaders(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(8))
    base = [word() for _ in range(400)]
    # few edits: all are similar to the leaders; half as many at fixed places: similar to the first kind, not to the leaders
    texts = []
    for size in [2] * 80 + [6] * 60 + [9] * 60:
        w = list(base)
        for _ in range(size):
            w[r.randrange(200)] = word()
        texts.append(w)
    for w in list(texts[80:200]):
        w = list(w)
        for _ in range(6):
            w[r.randrange(200)] = word()
        texts.append(w)
    texts = [" ".join(w) for w in texts]
    marks = {x["id"]: x["group"] for x in simhash.near_duplicates(spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], DOCS)).collect()}
    sets = [{" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    want = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if want[i] != want[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                want = [want[j] if x == want[i] else x for x in want]
    assert all((marks[i] == marks[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))


def test_no_task_numbers_a_large_block(spark, monkeypatch):
    seen, plain = [], simhash.numbered

    def watched(df, part, *rest):
        seen.append(df.groupBy(*part).count().agg(F.max("count")).first()[0] or 0)
        return plain(df, part, *rest)

    monkeypatch.setattr(simhash, "numbered", watched)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*base[:i], f"edit{i}", *base[i + 1 :]]), "", "", "") for i in range(100)]
    assert simhash.dedup(spark.createDataFrame(rows, DOCS)).count() == 1
    assert seen and max(seen) <= simhash.FULL_BLOCK


def test_a_comparison_shuffles_only_the_sets_of_its_pairs(spark, monkeypatch):
    """The sets of the pairs are picked before the joins, and without a new link the classes are not formed again."""
    picked, formed = [], []
    own_sized, own_components = simhash.sized, simhash.components
    monkeypatch.setattr(simhash, "sized", lambda t: picked.append(sorted(r["same"] for r in t.collect())) or own_sized(t))
    monkeypatch.setattr(simhash, "components", lambda e: formed.append(e.count()) or own_components(e))
    search = object.__new__(simhash._Search)
    search.spark, search.least, search.done, search.roots = spark, 0.8, None, spark.createDataFrame([], "node long, root long")
    pack = lambda *h: bytearray(b"".join(x.to_bytes(8, "little") for x in h))
    search.sets = spark.createDataFrame([(1, pack(1, 2, 3, 4)), (2, pack(1, 2, 3, 4, 5)), (3, pack(7)), (4, pack())], "same long, hashes binary")
    pairs = lambda *p: spark.createDataFrame(list(p), "same long, same_b long")
    assert [(r["a"], r["b"], round(r["gap"], 6), r["near"]) for r in search.compare(pairs((1, 2), (2, 1))).collect()] == [(2, 1, 0.2, True)]
    assert [(r["a"], r["b"], r["gap"], r["near"]) for r in search.compare(pairs((1, 2), (3, 1))).collect()] == [(3, 1, 1.0, False)]
    assert search.compare(pairs((3, 1))).count() == 0
    assert picked == [[1, 2], [1, 3]] and formed == [1]
    assert {(r["node"], r["root"]) for r in search.roots.collect()} == {(2, 1)}


def test_marks_never_rule_out_a_near_pair(spark):
    """Marks bound the difference of two sets from below, and leave hardly any pair that is far apart."""
    import numpy as np

    r, rows, pairs, near = np.random.default_rng(5), [], [], set()
    for i in range(200):
        n = int(r.integers(0, 600))
        a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        b = a[r.random(len(a)) < r.choice([0.2, 0.8, 0.85, 0.95, 1.0])]
        b = np.unique(np.concatenate([b, r.integers(0, 1 << 63, int(r.integers(0, 30)), dtype=np.uint64)]))
        rows += [(2 * i, len(a), simhash.marks(a)), (2 * i + 1, len(b), simhash.marks(b))]
        pairs.append((2 * i, 2 * i + 1))
        assert sum((x ^ y & -1).bit_count() if x ^ y >= 0 else ((x ^ y) + (1 << 64)).bit_count() for x, y in zip(rows[-1][2], rows[-2][2], strict=True)) <= len(np.setxor1d(a, b))
        if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            near.add((2 * i, 2 * i + 1))
    search = object.__new__(simhash._Search)
    search.least, search.marks = 0.8, spark.createDataFrame(rows, "same long, n long, marks array<long>")
    got = {(x["same"], x["same_b"]) for x in search.hopeful(spark.createDataFrame(pairs, "same long, same_b long")).collect()}
    assert near <= got
    assert len(got) < len(near) + 40 < 200
