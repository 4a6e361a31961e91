"""Near lines against all pairs, recall of the bands, and equal halves of hashes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlab.llm import common, lines, ngram_join, packed


def grams(line):
    line = lines.normal(line)
    return {line[i:i + 5] for i in range(len(line) - 4)} if len(line) >= 5 else {line.ljust(5, "\0")}


def near(x, y):
    return 100 * len(x & y) >= 80 * len(x | y)


def brute(rows):
    """Kept and dropped lines of each row, by all pairs."""
    place = [(d is None, d if d is not None else 0, i, at) for at, (d, t) in enumerate(rows)
             for i, x in enumerate((t or "").split("\n")) if lines.normal(x)]
    text = [lines.normal(x) for _, t in rows for x in (t or "").split("\n") if lines.normal(x)]
    sets = [grams(x) for x in text]
    lead = list(range(len(text)))

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i
    for i in range(len(text)):
        for j in range(i):
            if near(sets[i], sets[j]):
                a, b = sorted((top(i), top(j)), key=lambda k: place[k])
                lead[b] = a
    out = []
    for at, (d, _) in enumerate(rows):
        mine = [i for i, p in enumerate(place) if p[3] == at]
        out.append((d, len(mine), sorted(place[i][2] for i in mine if top(i) != i)))
    return out


def made(seed, templates=12, variants=14):
    """Groups of lines with random edits, among them some just under the limit, over documents with all odd rows."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij é") for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    every = []
    for _ in range(templates):
        base = " ".join(rnd.choice(words) for _ in range(rnd.randint(2, 30)))
        for _ in range(variants):
            x = list(base)
            for _ in range(rnd.choice((0, 0, 1, 1, 2, 6))):
                x[rnd.randrange(len(x))] = rnd.choice("xyz ")
            every.append("".join(x).upper() if rnd.random() < .2 else "".join(x))
    every += ["", "  ", "ab", "AB ", "x", "日本"]
    rnd.shuffle(every)
    return [(i, "\n".join(every[i::9])) for i in range(9)] + [(20, None), (21, "\n"), (22, "")]


def report(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit(1)).withColumn("line", F.lit("x"))
    return sorted((r.doc_id, r.n_lines, list(r.dropped)) for r in lines.line_report(df).collect())


@pytest.mark.parametrize("seed, few", [(1, 16), (2, 2)])
def test_against_all_pairs(spark, monkeypatch, seed, few):
    """With a small ``few`` the same lines go through hubs, strays and further buckets."""
    monkeypatch.setattr(lines, "FEW", few)
    rows = made(seed)
    assert report(spark, rows) == sorted(brute(rows))


def test_one_band_of_many_different_lines(spark, monkeypatch):
    """Variants of one line, two edits each: most link with most, through others or at once."""
    monkeypatch.setattr(lines, "FEW", 4)
    rows = made(7, templates=1, variants=250)
    assert report(spark, rows) == sorted(brute(rows))


def test_finer_bands_split_what_the_first_leave_together(spark, monkeypatch):
    """Lines of one small vocabulary: many share a band by chance, few link."""
    monkeypatch.setattr(lines, "FEW", 2)
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8))) for _ in range(40)]
    every = []
    for _ in range(60):
        base = rnd.sample(words, 28)
        every.append(" ".join(base))
        if rnd.random() < .5:
            base[rnd.randrange(28)] = "zzz"
            every.append(" ".join(base))
    rows = [(i, "\n".join(every[i::6])) for i in range(6)]
    split, asked = packed.shared, []

    def shared(dealt, n):
        asked.append(n)
        return split(dealt, n)
    monkeypatch.setattr(packed, "shared", shared)
    assert report(spark, rows) == sorted(brute(rows))
    assert len(asked) == 2


@pytest.mark.parametrize("rows, bands", [(lines.ROWS, lines.BANDS), (lines.FINE_ROWS, lines.FINE_BANDS)])
def test_recall_of_the_bands(rows, bands):
    """Pairs of Jaccard 0.80 to 0.86 of lines of 14 to 300 characters share a band."""
    rnd = random.Random(3)
    met = tried = 0
    for length in (14, 25, 40, 80, 150, 300):
        left, right = [], []
        while len(left) < 300:
            a = "".join(rnd.choice("abcdefghijklmnop ") for _ in range(length))
            b = list(a)
            for _ in range(rnd.randint(1, max(1, length // 40))):
                b[rnd.randrange(length) if rnd.random() < .5 else -1] = rnd.choice("qrstu")
            a, b = lines.normal(a), lines.normal("".join(b))
            x, y = grams(a), grams(b)
            if 0.8 <= len(x & y) / len(x | y) <= 0.86:
                left.append(a)
                right.append(b)
        met += (lines.band_keys(left, rows, bands) == lines.band_keys(right, rows, bands)).any(axis=1).sum()
        tried += len(left)
    assert met / tried > 0.99, met / tried


def test_overlaps_are_those_of_the_sets():
    rnd = random.Random(5)
    x = ["".join(rnd.choice("ab é日") for _ in range(rnd.choice((1, 3, 4, 5, 40, 3000)))) for _ in range(300)] + ["y" * 200_000, "z"]
    y = [a[:len(a) // 2] + "b" + a[len(a) // 2:] if rnd.random() < .8 else "ab" for a in x]
    got = np.array(lines.overlaps(x, y)).T
    plain = lambda s: {s[i:i + 5] for i in range(len(s) - 4)} if len(s) >= 5 else {s.ljust(5, "\0")}
    want = [(len(plain(a)), len(plain(b)), len(plain(a) & plain(b))) for a, b in zip(x, y)]
    assert got.tolist() == [list(w) for w in want]
    assert lines.sizes(x).tolist() == [w[0] for w in want] and lines.sizes([]).tolist() == []
    assert np.array(lines.overlaps([], [])).shape == (3, 0)


def test_equal_halves_are_told_apart(spark):
    rows = spark.createDataFrame([(1, 5, 10), (2, 5, 11), (3, 6, 12), (4, 5, 10)], "doc_id long, node long, check long")
    got, apart = common.part_clashes(rows, "test-clash")
    assert apart == {5} and sorted((r.doc_id, r.node) for r in got.collect()) == [(1, 10), (2, 11), (3, 6), (4, 10)]
    assert common.part_clashes(rows.where("doc_id <> 2"), "test-clash")[1] == frozenset()


@pytest.mark.parametrize("module", [lines, ngram_join])
def test_results_stay_when_nodes_take_the_other_half(spark, monkeypatch, module):
    """As if every other node's half stood for two lines, or sets."""
    docs = made(4)
    frame = spark.createDataFrame(docs, "doc_id long, text string")

    def parted(rows, purpose):
        odd = frozenset(r["node"] for r in rows.where("node % 2 <> 0").select("node").distinct().collect())
        assert odd
        return rows.withColumn("node", F.when(F.col("node") % 2 != 0, F.col("check")).otherwise(F.col("node"))), odd
    op = lines.line_report if module is lines else ngram_join.join_components
    want = sorted(map(str, op(frame).collect()))
    monkeypatch.setattr(module, "part_clashes", parted)
    assert sorted(map(str, op(frame).collect())) == want


def test_dropped_lines_are_cut_and_other_columns_stay(spark):
    rows = [(1, "the quick brown fox jumps over it\nshort", "a"), (2, "the quick brown fox jumps over it!\n\nlast", "b"),
            (None, None, "c"), (None, "short", None), (3, "", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = {(r.doc_id, r.node): r.text for r in lines.drop_near_lines(docs).collect()}
    assert got == {(1, "a"): rows[0][1], (2, "b"): "\nlast", (None, "c"): None, (None, None): "", (3, "d"): ""}
    assert lines.drop_near_lines(docs).columns == docs.columns
    assert lines.drop_near_lines(docs.limit(0)).count() == 0


def test_gathered_values_are_those_of_two_nodes():
    """Packed values against a plain count, repeated nodes of a value included."""
    rnd = np.random.default_rng(2)
    value = rnd.integers(0, 300, 500).astype(np.uint64) << np.uint64(50)
    node, tag = rnd.integers(-4, 4, 500), (value >> np.uint64(50)).astype(np.uint8)
    got = [b for b in packed._gather([packed.deal(value[:200], node[:200], tag[:200], 1), packed.deal(value[200:], node[200:], tag[200:], 1)])]
    rows = sorted(r for b in got for r in zip(*(c.to_pylist() for c in b.columns)))
    nodes = {}
    for v, n in zip(value.view(np.int64).tolist(), node.tolist()):
        nodes.setdefault(v, set()).add(n)
    assert rows == sorted((v, n, (v >> 50) % 256, len(s)) for v, s in nodes.items() for n in s if len(s) > 1)
    assert not list(packed._gather([])) and not list(packed._gather([packed.deal(value[:1], node[:1], tag[:1], 1)]))


def test_long_lines_share_long_bands_and_meet_less_by_chance():
    """Pairs at Jaccard 0.80 to 0.86 share a key whatever bands each has; unlike
    long lines share fewer than the short bands alone would give them."""
    rnd = random.Random(8)
    met = tried = 0
    for length in (60, 180, 220, 260, 320, 400, 900):
        left, right = [], []
        while len(left) < 60:
            a = "".join(rnd.choice("abcdefghijklmnop ") for _ in range(length))
            b = list(a)
            for _ in range(rnd.randint(1, max(1, length // 40))):
                b[rnd.randrange(length)] = rnd.choice("qrstu")
            a, b = lines.normal(a), lines.normal("".join(b))
            x, y = grams(a), grams(b)
            if 0.8 <= len(x & y) / len(x | y) <= 0.86:
                left.append(a)
                right.append(b)
        keys, line = lines.line_keys(left + right)
        held = [set(keys[line == i].tolist()) for i in range(2 * len(left))]
        met += sum(bool(held[i] & held[i + len(left)]) for i in range(len(left)))
        tried += len(left)
    assert met / tried > 0.99, met / tried
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 6))) for _ in range(60)]
    alike = [" ".join(rnd.choice(words) for _ in range(140)) for _ in range(150)]

    def collisions(keys):
        return len(keys) - len(np.unique(keys))
    assert collisions(lines.line_keys(alike)[0]) < collisions(lines.band_keys(alike).ravel()) / 2


def test_short_values_keep_what_they_share():
    """Halves of values meet as the whole ones do, node by node."""
    rnd = np.random.default_rng(4)
    value = rnd.choice(rnd.integers(0, 2**64, 200, dtype=np.uint64), 600)
    node, tag = rnd.integers(-9, 9, 600), np.zeros(600, np.uint8)

    def groups(short):
        dealt = packed.deal(value, node, tag, 8, short)
        out = {}
        for i in range(dealt.num_rows):
            for b in packed._gather([dealt.slice(i, 1)]):
                for v, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    out.setdefault((i, v), set()).add(n)
        return sorted(map(sorted, out.values()))
    assert groups(True) == groups(False) and groups(False)


def test_buckets_beyond_small_are_taken_apart(spark, monkeypatch):
    """Without the direct comparison of bounded buckets the same components come out."""
    monkeypatch.setattr(lines, "FEW", 2)
    rows = made(9, templates=2, variants=90)
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def parts(small):
        got = lines.near_lines(df, small=small).select("doc_id", "line", "component", "kept").collect()
        return sorted(map(tuple, got))
    assert parts(1) == parts(1000)
