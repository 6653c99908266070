"""Operators 11 to 13 against brute force, on a fixture of hard cases, and on empty tables."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dosecast.llm import merkle, ngram_join, spelling
from dosecast.llm.dealing import dealt, numbered
from dosecast.session import materialize
from test_operators import SCHEMA, WORDS, rows

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(t):
    return t.translate(str.maketrans(UPPER, UPPER.lower()))


def more_rows():
    """The fixture, and near copies in a chain, a very long text, a very long word, ties and repeated rows."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(500)}" for _ in range(80)]
    out, i = rows(), 100
    for k in range(12):                       # each near the one before, the ends far apart
        out.append((i + k, " ".join(base), "en", "chain", k, "c", 1, 2, "n"))
        base[k * 6] = f"edit{k}"
    long_text = " ".join(f"v{rng.randrange(9000)}" for _ in range(40_000))
    out += [(200, long_text, "en", "long", 1, "c", 1, 2, "n"), (201, long_text + " tail", "en", "long", 1, "c", 1, 2, "n"),
            (202, "y" * 200_000, "en", "long", 1, "c", 1, 2, "n"), (203, "One Two Three", "en", "short", 1, "c", 1, 2, "n"),
            (204, "one two three", "en", "short", 1, "c", 1, 2, "n"), (205, "one two", None, "short", None, "c", 1, 2, "n")]
    out += [(300, "Rows That Are Equal In All", "en", "s1", 3, "c", 1, 2, "n")] * 3
    out += [(301, "same id, text one", "en", "s1", 3, "c", 1, 2, "n"), (301, "same id, text two", "en", "s1", 3, "c", 1, 2, "n")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(more_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# -- 11 --------------------------------------------------------------------------------------------------

def sets_of(rows_, k=4):
    out = []
    for r in rows_:
        w = [x for x in WORDS.findall(lowered(r[1] or ""))]
        out.append({tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)})
    return out


def brute_components(rows_, k=4, percent=85):
    sets = sets_of(rows_, k)
    near = collections.defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                near[i].add(j)
                near[j].add(i)
    out, seen = {}, {}
    for i in range(len(rows_)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        ids = [rows_[j][0] for j in group if rows_[j][0] is not None]
        seen.update({j: min(ids) if ids else None for j in group})
    for i, r in enumerate(rows_):
        out[i] = (r[0], len(sets[i]), seen[i], len(near[i]))
    return collections.Counter(out.values())


def both_of(join):
    """Component rows, and the rows' numbers of links."""
    return (collections.Counter(tuple(r) for r in ngram_join.digest(join).collect()),
            collections.Counter(tuple(r) for r in ngram_join.counted(join).collect()))


def as_counts(brute):
    parts, links = collections.Counter(), collections.Counter()
    for (doc, n, component, degree), c in brute.items():
        parts[doc, n, component] += c
        links[doc, degree] += c
    return parts, links


def test_ngram_join_equals_all_pairs(docs):
    join = ngram_join.Join(docs)
    assert both_of(join) == as_counts(brute_components(more_rows()))


@pytest.mark.parametrize("shingle,percent", [(1, 50), (3, 80)])
def test_ngram_join_on_random_sets(spark, shingle, percent):
    """Few words, so that sets overlap by every amount; frequent shingles are prefix shingles too."""
    rng = random.Random(shingle)
    seeds = [[rng.choice("abcdefghij") for _ in range(rng.randint(1, 25))] for _ in range(12)]
    out = []
    for i in range(160):
        w = list(rng.choice(seeds))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice("abcdefghijxyz")
        out.append((i, " ".join(w)))
    d = spark.createDataFrame(out, "doc_id long, text string")
    assert both_of(ngram_join.Join(d, shingle, percent)) == as_counts(brute_components(out, shingle, percent))


def test_ngram_join_dense_keys_and_small_blocks(spark):
    """A key dealt out over cells and sets dealt out over blocks lose no link."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    out = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(60)] = f"x{i}"
        out.append((i, " ".join(w)))
    d = spark.createDataFrame(out, "doc_id long, text string")
    join = ngram_join.Join(d, 1, 85)
    want = {(r.a, r.b) for r in join.links().collect()}
    assert len(want) == 60 * 59 // 2
    assert len(join.connecting().collect()) < 60 * 40 and ngram_join.neighbours(join.shared, 85, 5).count() > 0
    prefix = materialize(ngram_join.prefixes(d, np.zeros(ngram_join.BUCKETS, np.uint32), 1, 85), "t")
    pairs = materialize(ngram_join.candidates(ngram_join.shared_rows(prefix, join.nodes), 85, dense=7), "t")
    assert {(r.a, r.b) for r in pairs.collect()} >= want and pairs.count() == pairs.distinct().count()
    found = ngram_join.verified(d, join.nodes, pairs, 1, 85, block=200).collect()
    assert {(r.a, r.b) for r in found} == want and len(found) == len(want)


def test_ngram_join_clashing_columns_and_empty(spark, none):
    assert ngram_join.digest(ngram_join.Join(none)).count() == 0
    d = spark.createDataFrame([(1, "a b c d e", 5, 6, 7), (2, "a b c d e", 5, 6, 7)], "doc_id long, text string, node long, key long, n long")
    assert [tuple(r) for r in ngram_join.digest(ngram_join.Join(d)).orderBy("doc_id").collect()] == [(1, 2, 1), (2, 2, 1)]


# -- 12 --------------------------------------------------------------------------------------------------

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, g = sorted((a, b), key=len)
    return any(g[:i] + g[i + 1:] == s for i in range(len(g)))


def brute_spelling(rows_, noise=97, min_length=5, min_count=3):
    import re
    n = collections.Counter()
    for r in rows_:
        for w in re.findall("[A-Za-zÀ-ÿ]+", lowered(r[1] or "")):
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{w}".encode())
            if noise and h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: min(near[w], key=lambda x: (-n[x], x.encode())) for w in n if near[w]}
    form = {w: x for w, x in form.items() if n[x] >= 2 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def spelled_rows():
    rng = random.Random(5)
    words = ["straße", "größer", "éclair", "eclair", "naïve", "colour", "color", "colours", "aaaaa", "aaaaaa", "aaaaab", "baaaaa",
             "ababab", "bababa", "letter", "better", "latter", "ladder", "tre", "café", "cafés", "ÿÿÿÿÿ", "ÀÀÀÀÀ", "z" * 3000, "z" * 3001]
    out = []
    for i in range(220):
        w = [rng.choice(words[:2 + rng.randrange(len(words) - 1)]) for _ in range(30)]
        out.append((i if i % 9 else None, rng.choice([" ", "-", "3"]).join(w).replace("color", "Color"), "x"))
    steps = " ".join(["abcdef"] * 40 + ["abcdeg"] * 15 + ["abcdhg"] * 5)
    return out + [(5, None, "x"), (6, "", "x"), (7, "no", "x"), (1000, steps, "x")]


def test_spelling_equals_brute_force(spark, docs):
    d = spark.createDataFrame(spelled_rows(), "doc_id long, text string, word string").repartition(4)
    want = brute_spelling(spelled_rows(), noise=7)
    assert any(a[1] and a[2] != a[1] for a in want) and len(want) > 20          # a root two steps away
    assert {tuple(r) for r in spelling.variants(d, noise=7).collect()} == want
    assert {tuple(r) for r in spelling.variants(docs).collect()} == brute_spelling(more_rows())


def test_spelling_dense_keys_random_words_and_empty(spark, none):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(5, 7))) for _ in range(300)})
    w = spark.createDataFrame([(x, 3) for x in words], "word string, n long")
    want = {(*sorted((a, b), key=lambda x: (len(x), x)),) for a in words for b in words if one_edit(a, b)}
    for dense in (3, 2048):
        got = spelling.near_pairs(w, dense).collect()
        assert {(r.a, r.b) for r in got} == want and len(got) == len(want)
    assert spelling.variants(none).count() == 0


# -- 13 --------------------------------------------------------------------------------------------------

def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf_of(r, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def brute_merkle(rows_, run=16):
    def levels(d):
        out = [d]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][i:i + run])) for i in range(0, len(out[-1]), run)])
        return out

    def path(lv, i):
        out = []
        for d in lv[:-1]:
            a = i - i % run
            out.append(("".join(d[a:i]), "".join(d[i + 1:a + run])))
            i //= run
        return out
    by = collections.defaultdict(list)
    for r in rows_:
        by[r[3]].append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources]) if sources else []
    out = []
    for k, s in enumerate(sources):
        for i, (_, _, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            p = path(trees[s], i) + path(top, k)
            t = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            d = leaf_of(r, None if r[1] is None else lowered(r[1])) if t else leaf
            for a, b in p:
                d = h(a + d + b)
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in p)), d, d == top[-1][0]))
    return collections.Counter(out)


def folded(d):
    low = F.translate(F.col("text"), UPPER, UPPER.lower())
    return collections.Counter(tuple(r) for r in merkle.digest(merkle.manifest(d, merkle.tampered(), low)).collect())


def test_merkle_equals_brute_force(docs, none):
    want = brute_merkle(more_rows())
    assert folded(docs) == want
    assert {k[-1] for k in want} == {True, False}
    assert folded(none) == collections.Counter()


def test_merkle_over_several_blocks_and_sources(spark):
    """More than one block of 4096 in a source, a last run of one leaf, more sources than a run, a lone leaf."""
    out = [(i, f"Text {i}", "en", "big", i) for i in range(2 * 4096 + 1)] + [(20_000 + i, f"T{i}", "en", "mid", 1) for i in range(257)]
    out += [(30_000 + i, f"L{i}", None, f"s{i:03}", 1) for i in range(40)] + [(None, "X", "en", "big", 1), (40_000, "Q", "en", None, 2)]
    d = spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert folded(d) == brute_merkle(out)


def test_merkle_versions_share_the_rest(spark):
    """A version's own nodes are a leaf and its ancestors; the base tree is as without the change."""
    out = [(i, f"Text {i}", "en", f"s{i % 2}", i) for i in range(600)]
    d = spark.createDataFrame(out, "doc_id long, text string, lang string, source string, n_chars long")
    m = merkle.manifest(d, F.col("doc_id") == 77, F.lit("other"))
    base = merkle.manifest(d)
    assert m.root.collect() == base.root.collect()
    v = {r.doc_id: r for r in m.versions().collect()}
    assert [i for i in v if v[i].changed] == [77] and v[77].copied[-1] != v[77].root
    assert len(v[77].copied) == 1 + 3 + 1 and v[76].copied[-1] == v[77].root
    assert not set(v[77].copied) & set(v[75].copied)


def test_numbered_and_dealt(spark):
    d = spark.range(1000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") * 7 % 1000).alias("x"))
    got = numbered(d, "g", [F.col("x")], lambda x: materialize(x, "t")).collect()
    for g in "012":
        own = sorted((r for r in got if r.g == g), key=lambda r: r.idx)
        assert [r.idx for r in own] == list(range(len(own))) and [r.x for r in own] == sorted(r.x for r in own)
        assert {r.n for r in own} == {len(own)}
    k = spark.range(50).select(F.lit(1).alias("k"), F.col("id"))
    left, right = dealt(k, "k", "id", 8)
    both = left.toDF("k", "a", "r", "c").join(right.toDF("k", "b", "c", "r"), ["k", "r", "c"])
    assert both.count() == 2500 and both.select("a", "b").distinct().count() == 2500
