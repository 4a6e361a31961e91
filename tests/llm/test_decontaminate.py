import hashlib
import random
import re

from cohortlab.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(docs, bench, size=10):
    windows = {}
    for item, text in bench:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, items = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                held = windows.get(tuple(w[i:i + n]))
                if held is not None:
                    hit[i:i + n] = [True] * n
                    items |= held
        items = sorted(str(i) for i in items if i is not None)
        out.append((doc, len(w), sum(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), any(hit)))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Été", "x1", "ÄB", "straße", "no", "über", "42"]
    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", "\0", " \x7f"]) for _ in range(n))
    bench = [(i, text(rng.randint(0, 14))) for i in range(30)] + [(3, "The of 42"), (None, "no no no x1"), (5, None), (8, "...")]
    docs = [(i, text(rng.randint(0, 120))) for i in range(80)]
    docs += [(100 + i, text(20) + b + " " + text(5)) for i, (_, b) in enumerate(bench) if b]
    return docs + [(None, bench[0][1]), (None, None), (1, ""), docs[0], docs[0]], bench


def test_against_all_windows(spark):
    docs, bench = sample(1)
    got = D.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, ITEMS))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert collected(got) == plain(docs, bench)


def test_other_window_and_blocks_beyond_the_bound(spark):
    docs, bench = sample(2)
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, ITEMS)
    assert len(D.benchmark_blocks(b, 4, 900)) > 1
    assert collected(D.contamination(d, b, size=4, max_bytes=900)) == plain(docs, bench, 4)


def test_long_items_are_cut_and_long_words_cross_slices(spark, monkeypatch):
    monkeypatch.setattr(D, "SLICE", 7)
    rng = random.Random(3)
    long_ = " ".join(rng.choice(["aa", "Bb", "c" * 40]) for _ in range(9000))
    docs = [(1, long_[5000:90000]), (2, "c" * 5_000), (3, "d" * 20 + " " + long_[:300])]
    bench = [(9, long_), (10, "c" * 5_000)]
    for text in (long_[:2000], "c" * 50, "", " ", "é" * 30 + " b"):
        data = text.encode()
        assert [w.decode() for w in D.normal_words(data)] == words(text)
    assert collected(D.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, ITEMS))) == plain(docs, bench)


def test_same_word_has_the_same_hash_wherever_it_stands():
    import numpy as np
    data = b"x" * (D.SLICE - 5) + b" abcdefghij " + b"ABCdefghij"
    _, _, h = D.words_of(np.frombuffer(data, np.uint8))
    assert len(h) == 3 and h[1] == h[2] != h[0]


def test_spans_go_and_documents_go(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Keep this. {passage.title()}! And this."), (2, "clean text"), (3, None), (3, None), (4, passage)]
    d = spark.createDataFrame([(*r, "a", "b") for r in docs], DOCS + ", k string, row string")
    b = spark.createDataFrame([(1, passage)], ITEMS)
    for limit in (D.MAX_BYTES, 200):
        cut = D.remove_spans(d, b, max_bytes=limit)
        assert cut.columns == d.columns
        assert sorted(((r["doc_id"], r["text"]) for r in cut.collect()), key=repr) == sorted(
            [(1, "Keep this. ! And this."), (2, "clean text"), (3, None), (3, None), (4, "")], key=repr)
        kept = D.drop_documents(d, b, max_bytes=limit)
        assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 3]
        assert sorted(r["doc_id"] for r in D.drop_documents(d, b, 0.9, max_bytes=limit).collect()) == [1, 2, 3, 3]


def test_empty_tables(spark):
    none_d, none_b = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some_d, some_b = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    assert D.contamination(none_d, some_b).count() == 0
    assert [(r["n_words"], r["n_hit"]) for r in D.contamination(some_d, none_b).collect()] == [(2, 0)]
