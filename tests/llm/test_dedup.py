import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from habispark.llm import exact_dedup, minhash, substring
from habispark.llm.components import connected_components
from habispark.llm.packed import pack, unpack
from habispark.llm.words import read_texts

from .conftest import lower, words_of


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_words_match_their_pattern():
    texts = ["a\u00a0b\x0bc  d", None, "", "é\n\nÀB x", " \t", "z"]
    found = read_texts(pa.array(texts), lower=True)
    got = [[found.word_bytes(i).decode() for i in range(a, b)] for a, b in zip(found.first[:-1], found.first[1:])]
    assert got == [words_of(lower(t)) for t in texts]
    again = read_texts(pa.array(["q", *texts]), lower=True)
    assert (again.hashes()[1:] == found.hashes()).all()


@pytest.mark.parametrize("largest", [False, True])
def test_exact_groups(corpus, largest):
    groups = defaultdict(list)
    for r in corpus.collect():
        groups[lower(r.text)].append(r.doc_id)
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        for i in ids:
            expected.append((i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.duplicate_groups(corpus, largest=largest).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_exact_merge_takes_several_rounds(corpus, monkeypatch):
    before = sorted(map(str, rows(exact_dedup.duplicate_groups(corpus))))
    monkeypatch.setattr(exact_dedup, "_STORED_EVERY", 2)
    monkeypatch.setattr(exact_dedup, "RUN_ENTRIES", 5)
    assert sorted(map(str, rows(exact_dedup.duplicate_groups(corpus.repartition(9))))) == before


def test_exact_empty_and_unchanged_columns(corpus, nothing):
    assert exact_dedup.duplicate_groups(nothing).count() == 0
    kept = exact_dedup.without_copies(corpus)
    assert kept.columns == corpus.columns
    assert kept.filter("doc_id between 85 and 94").count() == 0


def shingles(text):
    w = words_of(lower(text))
    if not w:
        return frozenset()
    return frozenset({tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})


def test_components_equal_brute_force(corpus):
    docs = [(r.doc_id, shingles(r.text)) for r in corpus.collect()]
    parent = {i: i for i, _ in docs if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in docs:
        for j, b in docs:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    expected = sorted((str(i), len(s), str(None if i is None else find(i)), i is None or find(i) == i) for i, s in docs)
    got = sorted(
        (str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in minhash.near_duplicates(corpus).collect()
    )
    assert got == expected


def test_chain_of_near_copies_is_one_component(spark):
    base = [f"t{i}" for i in range(400)]
    docs = []
    for i in range(12):
        words = list(base)
        for k in range(i):
            words[k * 9 : k * 9 + 2] = [f"n{k}"]
        docs.append((i, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    near = [100 * len(shingles(a) & shingles(b)) >= 85 * len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(docs, docs[1:])]
    far = shingles(docs[0][1]), shingles(docs[-1][1])
    assert all(near) and 100 * len(far[0] & far[1]) < 85 * len(far[0] | far[1])
    assert {r.component_id for r in got} == {0}


def test_near_empty(nothing, corpus):
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.without_near_copies(corpus).columns == corpus.columns


def test_components_of_path_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def cut_by_hand(docs):
    first = {}
    for i, text in docs:
        w = words_of(text)
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in docs:
        w = words_of(text)
        gone = set()
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k : k + 50])] < i:
                gone |= set(range(k, k + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("gathered", [substring.GATHERED, 200])
def test_passages_equal_brute_force(corpus, monkeypatch, gathered):
    monkeypatch.setattr(substring, "GATHERED", gathered)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.removed_words(corpus).collect())
    assert got == cut_by_hand([(r.doc_id, r.text) for r in corpus.collect()])


def test_passages_empty_and_untouched(corpus, nothing):
    assert substring.removed_words(nothing).count() == 0
    cut = substring.without_repeats(corpus)
    assert cut.columns == corpus.columns and cut.count() == corpus.count()
    before = {r.doc_id: r.text for r in corpus.filter("doc_id < 60").collect()}
    assert {r.doc_id: r.text for r in cut.filter("doc_id < 60").collect()} == before


def test_passages_taken_out_of_the_texts_themselves(spark):
    rng = random.Random(31)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared, alone = prose(70), prose(300)
    table = [(4, f"{prose(20)} {shared}\n{prose(20)}"), (9, f"{prose(11)}  {shared}\t{prose(5)}"), (7, shared)]
    table += [(9, alone), (9, table[1][1]), (None, shared), (3, None), (2, ""), (11, alone)]
    rows = [(i, t, n, f"x{n}") for n, (i, t) in enumerate(table)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bit int, new_text string")
    got = {r.bit: r for r in substring.without_repeats(docs).collect()}
    assert len(got) == len(rows)
    digest = {(i, n): h for i, n, _, h in cut_by_hand(table)}
    for i, text, n, other in rows:
        assert (got[n].doc_id, got[n].new_text) == (i, other)
        words = words_of(got[n].text or "")
        sha = hashlib.sha256(" ".join(words).encode()).hexdigest()
        assert sha == digest[str(i), len(words_of(text or ""))]
        if len(words) == len(words_of(text or "")):
            assert got[n].text == text
    assert got[7].text == "" and got[1].text == got[4].text and not words_of(got[2].text) and not words_of(got[8].text)
    assert substring.without_repeats(docs.limit(0)).count() == 0


def test_packed_numbers_come_back():
    top = 2**63 - 1
    for values in ([], [0], [5, 5, 6], [top, -top - 1, 0, top, 3], [2**62, -(2**62), 2**62 + 7]):
        assert unpack(pack(np.array(values, np.int64))).tolist() == values


def test_windows_need_both_hashes():
    keys = np.array([[5, 1], [5, 2], [5, 1], [5, 2], [6, 1]], np.uint64)
    beaten, best = substring._decided(keys, np.array([3, 2, 4, 2, 1]), np.ones(5, bool))
    assert beaten.tolist() == [False, False, True, False, False] and best.tolist() == [True, True, False, True, True]
    texts = read_texts(pa.array(["one two one", "two"]))
    first, other = texts.hashes(), texts.other_hashes()
    assert first[0] == first[2] and other[0] == other[2] and first[1] == first[3] and other[1] == other[3]
    assert not set(first.tolist()) & set(other.tolist())


def test_signature_estimates_similarity():
    rng = np.random.RandomState(0)
    common = rng.randint(0, 2**62, 900).astype(np.uint64)
    a = np.concatenate([common, rng.randint(0, 2**62, 100).astype(np.uint64)])
    b = np.concatenate([common, rng.randint(0, 2**62, 100).astype(np.uint64)])
    s = minhash.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]), minhash._second_permutation())
    assert abs((s[0] == s[1]).mean() - 900 / 1100) < 0.1


def test_rows_go_by_identifier_and_text(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(200)) for x in "abcde")
    near = a.replace("a0 ", "changed ")
    table = [(1, a), (None, a), (None, b), (2, c), (7, c), (7, d), (3, e), (None, e)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    left = {tuple(r) for r in exact_dedup.without_copies(docs).collect()}
    assert left == {(1, a), (None, b), (2, c), (7, d), (3, e)}
    left = {tuple(r) for r in exact_dedup.without_copies(docs, largest=True).collect()}
    assert left == {(1, a), (None, b), (7, c), (7, d), (3, e)}
    docs = spark.createDataFrame([(1, a), (5, near), (5, b), (None, near), (None, c)], "doc_id long, text string")
    left = {tuple(r) for r in minhash.without_near_copies(docs).collect()}
    assert left == {(1, a), (5, b), (None, near), (None, c)}
    # The verdicts by identifier still name one component for all rows of it.
    assert {r.component_id for r in minhash.near_duplicates(docs).collect()} == {1, None}
