import hashlib
import random

import numpy as np
import pytest

from cohortlab.llm import alignment as A

DOCS = "doc_id long, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def vocabularies():
    return A.Vocabularies(*A.default_tokenizers())


def tokens(text, v):
    """Ids and ends under both tokenizers, of the whole text at once; None where the bytes differ."""
    out = []
    for t in v.both:
        ids = t.ids([" " + text])[0]
        if b"".join(t.bytes[i] for i in ids) != (" " + text).encode():
            return None
        out.append((ids, np.cumsum([len(t.bytes[i]) for i in ids]).tolist()))
    return out


def plain(docs, v):
    """Groups from the set of common ends, links from all overlapping pairs."""
    found = []
    for doc, text in docs:
        got = tokens(text, v) if text else None
        if got is None:
            found.append((doc, None))
            continue
        (a, ea), (b, eb) = got
        common = sorted(set(ea) & set(eb))
        groups, sa, sb = [], 0, 0
        for e in common:
            za, zb = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, a[sa:za])) + "|" + ",".join(map(str, b[sb:zb])))
            sa, sb = za, zb
        links = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b)
                 if max(ea[i - 1] if i else 0, eb[j - 1] if j else 0) < min(ea[i], eb[j])]
        found.append((doc, (len(a), len(b), groups, links)))
    counts = {}
    for _, f in found:
        for pair in set(f[3]) if f else ():
            counts[pair] = counts.get(pair, 0) + 1
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for doc, f in found:
        if f is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        out.append((doc, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr)


def collected(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = ["", None, " ", "a", "  two  spaces ", "tab\tand\nline\r\n end", "x▁y ▁z", "<|endoftext|> <s> </s> <0x41> <unk>",
       "naïve Ünïcödé — “quotes” …", "漢字かな交じり文 한국어", "😀👩‍👩‍👧 é", "don't I'll we've 'S", "1234567 3.14 a1b2", " nb sp  x",
       "a  b　 c", "\n\n \n  a", "trailing \n", "http://x.y/z?q=1&r=2#s", "    def f(x):\n        return x  # ok", "\x00\x01 \x1c x"]


def test_against_all_pairs(spark, vocabularies):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, "once more"), (None, None), (3, "a"), (3, "a")]
    df = spark.createDataFrame([(*d, 1) for d in docs], DOCS + ", row int").repartition(3)
    assert collected(A.align_documents(df)) == plain(docs, vocabularies)


def test_pairs_beyond_the_broadcast_are_joined(spark, vocabularies):
    rng = random.Random(1)
    words = "the of and nation Straße été information token alignments xyzzy ñandú".split()
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(30)]
    df = spark.createDataFrame(docs, DOCS)
    assert collected(A.align_documents(df, max_pairs=4)) == plain(docs, vocabularies)
    assert collected(A.align_documents(df)) == plain(docs, vocabularies)


def test_cutting_at_words_changes_no_token(vocabularies):
    v = vocabularies
    assert v.local
    rng = random.Random(2)
    alphabet = ["a", "b", " ", " ", "  ", "\n", "\t", ".", "'s", "'", "1", "é", " ", "▁", "漢", "the", "-", "\x85", " ", "​"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40)))
        parts = A.Parts(v)
        for side, t in enumerate(v.both):
            whole = t.ids([" " + text])[0]
            assert [i for p in parts.cut(" " + text) for i in t.ids([p])[0]] == whole, text
        got = parts.texts([text])[0]
        want = tokens(text, v)
        if want is None:
            assert None in got
        else:
            assert sum(r[0] for r in got) == len(want[0][0]) and sum(r[1] for r in got) == len(want[1][0])
            assert sum(r[2] for r in got) == len(set(want[0][1]) & set(want[1][1]))


@pytest.mark.parametrize("seed", range(30))
def test_diagonal_runs(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 400)
    dense = rng.choice([.05, .5, .95])
    a = sorted({n} | {i for i in range(1, n) if rng.random() < dense})
    b = sorted({n} | {i for i in range(1, n) if i in a and rng.random() < .98 or rng.random() < .02})
    common = sorted(set(a) & set(b))
    want, i, j = [], 0, 0
    for e in common:
        x, y = a.index(e), b.index(e)
        if x > i or y > j:
            want.append((i, x, j, y))
        i, j = x + 1, y + 1
    assert A.irregular_groups(np.array(a), np.array(b)) == want


def test_empty_table_and_long_text(spark, vocabularies):
    assert A.align_documents(spark.createDataFrame([], DOCS)).count() == 0
    docs = [(1, "alignment " * 30_000), (2, "x" * 20_000)]
    got = {r["doc_id"]: r for r in A.align_documents(spark.createDataFrame(docs, DOCS)).collect()}
    for doc, text in docs:
        (a, ea), (b, eb) = tokens(text, vocabularies)
        assert (got[doc]["n_a"], got[doc]["n_b"], got[doc]["n_groups"]) == (len(a), len(b), len(set(ea) & set(eb)))
        assert got[doc]["n_links"] == len(set(ea) | set(eb))


def test_given_table_as_whole_texts(spark, vocabularies):
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = [tuple(r) for r in spark.read.parquet(path).select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in A.align_documents(spark.read.parquet(path)).collect()}
    for doc, text in docs:
        found = tokens(text, vocabularies) if text else None
        if found is None:
            assert got[doc]["n_a"] == 0
            continue
        (a, ea), (b, eb) = found
        assert (got[doc]["n_a"], got[doc]["n_b"], got[doc]["n_groups"]) == (len(a), len(b), len(set(ea) & set(eb)))
