"""The operators against brute force on a small fixture of hard cases, and on empty tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dosecast.llm import bpe, chat, decontaminate, graph, langid, line_dedup, mixing, pii, quality, records, simhash, token_counts
from dosecast.llm.queries import tokenizer_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, kept int, c0 int, n_words string"
EN = "the quick brown fox jumps over the lazy dog and then it rests under a warm tree by the river until the sun goes down"
DE = "der schnelle braune fuchs springt über den faulen hund und ruht dann unter einem warmen baum am fluss bis zur nacht"


def rows():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)] + ["Über", "naïve", "日本", "x-y"]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    texts = [None, "", " \n\t ", "one", "a b", EN, EN, EN + " ", EN.replace("warm", "cold"), DE,
             "call +1 (555) 010-0199 or mail a.b@example.org, 10.0.0.255 and 300.1.1.1, card 4111 1111 1111 1111",
             "mail a.b@example.org about the zebrafish", "mail a.b@example.org about the zebrafish again",
             "x <|endoftext|> y", "\x02 marks \x03", "tail \n\n  head", "spam spam spam spam spam spam", prose(3000),
             "the same line of six words\nthe same line of six words\nthe other line of six words\nshort\nshort",
             "\n".join(f"item {i} of a list that goes on" for i in range(60))]
    texts += [prose(rng.randint(1, 120)) for _ in range(30)]
    texts += [texts[-1]] * 5 + [EN + " " + prose(4) for _ in range(5)]
    out = []
    for i, t in enumerate(texts):
        out.append((i, t, "de" if t and t.startswith("der") else None if i == 3 else "en", None if i % 7 == 0 else f"s{i % 3}",
                    len(t or ""), "clash", 1, 2, "n"))
    return out + [out[5], (None, EN, None, None, 1, "c", 1, 2, "n"), (None, "no id here", "en", "s1", 10, "c", 1, 2, "n")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def plain(docs):
    """The rows with different ids only."""
    return docs.where("doc_id is not null").dropDuplicates(["doc_id"])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(tokenizer_path())


def table(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def texts_of(df):
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}


# -- 1 ---------------------------------------------------------------------------------------------------

def near(a, b):
    if min(len(a), len(b)) < line_dedup.MIN_WORDS:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    s, g = sorted((a, b), key=len)
    return len(g) - len(s) == 1 and any(g[:i] + g[i + 1:] == s for i in range(len(g)))


def test_line_dedup_equals_all_pairs(plain):
    seen, want = [], {}
    for doc, text in sorted(texts_of(plain).items()):
        want[doc] = []
        for pos, line in enumerate(text.split("\n")):
            w = WORDS.findall(line)
            if w:
                if not any(line == a or near(b, w) for a, b in seen):
                    want[doc].append(pos)
                seen.append((line, w))
    got = table(line_dedup.digest(plain))
    assert {d: r["kept_lines"] for d, r in got.items()} == {d: ",".join(map(str, p)) for d, p in want.items()}


def test_line_dedup_text_and_empty(plain, docs, none):
    out = table(line_dedup.remove_lines(plain, line_dedup.kept_lines(plain)))
    assert out[18]["text"].split("\n") == ["the same line of six words", "short"] and out[18]["_id"] == "clash"
    assert line_dedup.digest(docs).count() == docs.count()
    assert line_dedup.digest(none).count() == 0


def test_line_dedup_with_repeated_and_null_ids(spark, docs):
    """All pairs again, with rows that share an id or have none: each distinct line once, whichever row it is in."""
    extra = [(None, "no id here\nlazy dogs lie in the warm sun\nshort"), (None, "no id here\nlazy dogs lie in the cold sun\nlong"),
             (7, "a line of its own words\nand some other line entirely"), (7, "a line of its own words\nand yet another thing to say"),
             (-9, "copies of a line of words\ncopies of a line of verbs"), (-9, "copies of a line of words\ncopies of a line of verbs"),
             (900, "copies of one line of words"), (901, "words that no row had before\nand some other line here entirely")]
    rows_ = spark.createDataFrame(extra, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    hashed = rows_.select("doc_id", "text", *line_dedup.row_key()).collect()
    order = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, pos, r["row1"], r["row2"]), line, r["doc_id"], r["text"])
                   for r in hashed for pos, line in enumerate((r["text"] or "").split("\n")) if WORDS.search(line))
    seen, want = [], collections.Counter()
    for (_, _, pos, _, _), line, doc, text in order:
        w = WORDS.findall(line)
        if not any(line == a or near(b, w) for a, b in seen):
            want[doc, text, pos] += 1
        seen.append((line, w))
    out = line_dedup.remove_lines(rows_, line_dedup.kept_lines(rows_)).collect()
    left = collections.Counter(x for r in out for x in (r["text"] or "").split("\n") if WORDS.search(x))
    assert left == collections.Counter(text.split("\n")[pos] for _, text, pos in want)
    got = collections.Counter((r["doc_id"], r["n_lines"], r["kept_lines"]) for r in line_dedup.digest(rows_).collect() if r["n_kept"])
    kept = collections.defaultdict(list)
    for doc, text, pos in want:
        kept[doc, text].append(pos)
    assert got == collections.Counter((d, sum(1 for x in t.split("\n") if WORDS.search(x)), ",".join(map(str, sorted(p)))) for (d, t), p in kept.items())


# -- 2 ---------------------------------------------------------------------------------------------------

def test_every_prefix_count(lib):
    counter = token_counts.PrefixCounter(bpe.read_spec(tokenizer_path()))
    rng = random.Random(1)
    cases = ["don't they're we'll 's 've''re", "a  b", " \n a\t b", "a<|endoftext|>b c <|endoftext|>", "日本語 テスト", "a　　b",
             "=-" * 40, " " * 70 + "x", "\r\n\r\n", "word. word, word.. 9. ä.", "\x1c!\x1c a", "😀 😀😀 'rx"]
    cases += ["".join(rng.choice("ab 'sre\n\t.,1é<|>日  ") for _ in range(rng.randint(0, 25))) for _ in range(150)]
    for t in cases:
        got = np.cumsum(np.frombuffer(counter.encode(t), "<i2"))
        assert got.tolist() == [len(lib.encode(t[:i], add_special_tokens=False).ids) for i in range(1, len(t) + 1)], t


def test_token_counts(docs, plain, none, lib):
    full = token_counts.prefix_table(docs, tokenizer_path())
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in full.collect())
    want = sorted((r[0] or -1, len((r[1] or "").encode()), len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows())
    assert got == want
    for d, r in table(token_counts.longest_within(token_counts.prefix_table(plain, tokenizer_path()), 20)).items():
        t = texts_of(plain)[d]
        fits = [i for i in range(len(t) + 1) if len(lib.encode(t[:i], add_special_tokens=False).ids) <= 20] if len(t) < 400 else None
        assert fits is None or r["n_chars"] == fits[-1]
    assert token_counts.digest(token_counts.prefix_table(none, tokenizer_path())).count() == 0


def test_full_store_gives_the_same_ids(lib, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_UNITS", 20)
    t = bpe.UnitTokenizer(bpe.read_spec(tokenizer_path()))
    for r in rows():
        assert np.frombuffer(t.encode(r[1] or ""), t.dtype).tolist() == lib.encode(r[1] or "", add_special_tokens=False).ids


# -- 3 ---------------------------------------------------------------------------------------------------

def measures(t):
    w = WORDS.findall(t)
    c = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = t.split("\n")
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)),
            sum(1 for k, x in enumerate(lines) if WORDS.search(x) and x in lines[:k]), len(hit),
            sum(1 for x in lines if WORDS.search(x)))


def test_quality_measures_and_filter(docs, plain, none):
    got = table(quality.quality(plain))
    for d, t in texts_of(plain).items():
        assert tuple(got[d][m] for m in quality.MEASURES) == measures(t)
    kept = quality.filter_documents(plain)
    assert kept.columns == plain.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["kept"]}
    assert quality.quality(docs).count() == docs.count() and quality.filter_documents(none).count() == 0


def test_prior_shrinks_towards_all_hosts(spark):
    hosts = [("bad", True)] * 90 + [("bad", False)] * 10 + [("good", False)] * 100 + [("tiny", True)] * 1 + [("ok", False)] * 100
    m = spark.createDataFrame(hosts, "source string, base_failed boolean")
    v = {r["host"]: r for r in quality.host_verdicts(m, "source").collect()}
    assert v["bad"]["rejected"] and not v["good"]["rejected"]
    assert 0.3 < v["tiny"]["shrunk_rate"] < 1.0      # one failure of one document is not taken at its word


# -- 4 ---------------------------------------------------------------------------------------------------

def test_records_round_trip(docs, none, lib):
    got = records.digest(docs, tokenizer_path()).collect()
    start, want = 0, []
    for r in sorted(rows(), key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array(lib.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r[0], len(ids), zlib.crc32(ids.tobytes())))
    key = lambda x: (x[0] is not None, x[0] or 0, x[2])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: -1 if d is None else d)
    assert records.digest(none, tokenizer_path()).count() == 0


def test_a_damaged_record_is_found():
    data = bytearray(records.frame(records.payload(7, 4, b"\1\0\0\0")))
    assert records.records_of(memoryview(data)) == [(7, b"\1\0\0\0")]
    data[-6] ^= 1
    with pytest.raises(ValueError):
        records.records_of(memoryview(data))


# -- 5 ---------------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base(t):
    def good(kind, s):
        d = re.sub("[^0-9]", "", s)
        even = sum(int(c) for c in d[::-1][::2]) + sum(sum(divmod(2 * int(c), 10)) for c in d[::-1][1::2])
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in s.split(".")),
                "card": 16 <= len(d) <= 19 and even % 10 == 0, "phone": 8 <= len(d) <= 15}[kind]
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, t) if good(k, m.group())]


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(3000):
        t = "".join(rng.choice("ab@.-+%1 25(") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == base(t), t
    pii.base_spans("a" * 200_000 + "1" * 200_000)      # long runs take linear time


def test_personal_data_and_disclosing_terms(docs, plain, none):
    got = table(pii.digest(pii.personal_data(plain)))
    for d, t in texts_of(plain).items():
        assert got[d]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base(t)).encode()).hexdigest()
    # "zebrafish" occurs with one address only, "the" everywhere.
    assert "term:31:40" in got[11]["spans"] and "term:27:30" not in got[11]["spans"]
    clean = table(pii.sanitise(plain))
    assert "zebrafish" not in clean[11]["text"] and "<EMAIL>" in clean[11]["text"] and clean[5]["text"] == EN
    assert pii.personal_data(docs).count() == docs.count() and pii.personal_data(none).count() == 0


def test_disclosing_terms_go_wherever_they_stand(spark):
    """On the next line, far off on the line, and in documents without the entity; none inside a base span."""
    fill = " ".join(["the cat sat"] * 20)
    texts = ["mail a.b@example.org about the zebrafish\nZebrafish " + fill + " zebrafish", "mail a.b@example.org about the zebrafish",
             "the zebrafish alone", "about zebrafish@example.org", None, ""] + ["mail about " + fill] * 300
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = table(pii.personal_data(d, threshold=0.8))      # of 306 documents, 4 hold the term
    at = lambda t: ",".join(f"term:{m.start()}:{m.end()}" for m in re.finditer("(?i)zebrafish(?!@)", t or ""))
    assert {i: r["terms"] for i, r in got.items()} == {i: at(t) for i, t in enumerate(texts)}
    full = pii.bit_table(spark.range(64).select(F.col("id").alias("term")))
    assert full[:8] == b"\xff" * 8 and not any(full[8:])
    clean = table(pii.sanitise(d, threshold=0.8))
    assert {i for i, r in clean.items() if "zebrafish" in (r["text"] or "").lower()} == set()


def test_near_terms_are_the_nearest_words_of_any_length():
    rng = random.Random(6)
    unit = lambda: rng.choice(["a", "日本", "xy", "é" * 400, "k" * 350, "word", "1.2.3.4", "b@c.de", "Q", "9", "-", "\n"])
    cases = ["".join(unit() + rng.choice([" ", " ", ", ", ""]) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    for t in ["日本 b@c.de " + "é" * 5000, "x " * 3 + "y" * 900 + " b@c.de q", *cases]:
        spans, want = pii.base_spans(t), set()
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        words = [m.span() for m in TERM.finditer(low)]
        for kind, a, b in spans:
            on_line = lambda x, y: "\n" not in t[min(y, b):max(x, a)]
            near_ = [w for w in words if w[1] <= a and on_line(*w)][-pii.REACH:] + [w for w in words if w[0] >= b and on_line(*w)][:pii.REACH]
            want |= {(pii._hash(kind, t[a:b].lower().encode()), pii._hash("term", low[x:y].encode())) for x, y in near_
                     if not any(p < y and x < q for _, p, q in spans)}
        assert {(r["entity"], r["term"]) for r in pii.near_terms(t, spans)} == want, t
    long = "a b@c.de " + "z" * 1_000_000
    assert len(pii.near_terms(long, pii.base_spans(long))) == 2


def test_each_row_is_cleaned_by_its_own_spans(spark):
    data = [(None, "mail a.b@example.org"), (None, "nothing to hide in this text"), (None, None), (1, "10.0.0.1 is up"),
            (1, "up is 10.0.0.1"), (1, "up is 10.0.0.1"), (2, "nothing to hide in this text")]
    out = pii.sanitise(spark.createDataFrame(data, "doc_id long, text string"), threshold=2.0).collect()
    want = collections.Counter((d, t and t.replace("a.b@example.org", "<EMAIL>").replace("10.0.0.1", "<IP>")) for d, t in data)
    assert collections.Counter((r["doc_id"], r["text"]) for r in out) == want


# -- 6 ---------------------------------------------------------------------------------------------------

def fingerprint(t):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, bits):
    """(id, fingerprint) -> smallest id reachable."""
    low = {i: i for i, _ in prints}
    while True:
        new = {i: min(low[j] for j, q in prints if bin(p ^ q).count("1") <= bits) for i, p in prints}
        if new == low:
            return low
        low = new


def test_simhash_components(docs, plain, none):
    prints = [(d, fingerprint(t)) for d, t in texts_of(plain).items()]
    got, want = table(simhash.digest(simhash.near_duplicates(plain))), classes(prints, 3)
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(got[d]["fingerprint"] == f"{p:016x}" for d, p in prints)
    kept = [r["doc_id"] for r in simhash.keep_one(plain).collect()]
    assert sorted(kept) == sorted(set(want.values()))
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns and out.where("doc_id is null").count() == 1 and out.where("doc_id = 5").count() == 1
    assert simhash.keep_one(none).count() == 0


def test_keep_one_chooses_by_row(spark):
    """Two texts under one id, of which one links to a smaller id, and near copies without id."""
    other = "nine plain words that no other row here holds"
    assert fingerprint(EN) == fingerprint(EN + " ") and bin(fingerprint(EN) ^ fingerprint(other)).count("1") > 3
    data = [(1, EN), (2, EN + " "), (2, DE), (3, other), (3, other + " "), (3, other), (None, EN), (None, EN + " "), (None, EN + "  ")]
    out = [(r["doc_id"], r["text"].strip()) for r in simhash.keep_one(spark.createDataFrame(data, "doc_id long, text string")).collect()]
    assert collections.Counter(out) == collections.Counter([(1, EN), (2, DE), (3, other)])


def test_simhash_links_of_a_dense_cluster(spark, monkeypatch):
    """Many fingerprints around one centre, with the grid in use: the same pairs as all against all."""
    monkeypatch.setattr(simhash, "DENSE", 20)
    rng = random.Random(4)
    fps = {0, -1}
    for _ in range(150):
        x = 0x0123456789ABCDEF
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        fps.add(simhash._signed(x))
    fps = sorted(fps)
    got = sorted(tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect())
    mask = (1 << 64) - 1
    assert got == [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin((a ^ b) & mask).count("1") <= 3]


def test_components_of_a_long_path(spark):
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = graph.components(path.unionByName(spark.createDataFrame([(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")))
    assert {(r["node"], r["label"]) for r in got.collect()} == {(i, 0) for i in range(301)} | {(1000, 1000), (1001, 1000)}


# -- 7 ---------------------------------------------------------------------------------------------------

def test_mixing(docs, plain, none):
    size = {r[0]: len(WORDS.findall(r[1] or "")) for r in rows() if r[0] is not None}
    src = {r[0]: r[3] for r in rows() if r[0] is not None}
    by = collections.Counter()
    for d, n in size.items():
        by[src[d]] += n
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(by, key=lambda s: (s is None, s)))}
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2 * by[s], mid * weight[s]) for s in by) < 1.5 * sum(by.values()) else (low, mid)
    got = table(mixing.taken(plain))
    for s in by:
        target = min(2 * by[s], high * weight[s])
        assert abs(sum(r["taken"] for d, r in got.items() if src[d] == s) - target) <= 1
        assert all(abs(r["target"] - target) < 1e-3 for d, r in got.items() if src[d] == s)
    assert all(r["size"] == size[d] and r["taken"] <= 2 * r["size"] for d, r in got.items())
    assert got == table(mixing.taken(plain))
    words = collections.Counter()
    for r in mixing.mix(plain).collect():
        words[r["doc_id"]] += len(WORDS.findall(r["text"]))
        assert (texts_of(plain)[r["doc_id"]]).startswith(r["text"]) or r["text"] in texts_of(plain)[r["doc_id"]]
    assert {d: n for d, n in words.items()} == {d: r["taken"] for d, r in got.items() if r["taken"]}
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(none).count() == 0 and mixing.taken(none).count() == 0


# -- 8 ---------------------------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    said = [r"\### Assistant: </turn> ok", "", None, "a\\", "\\\\</turn>\n### user: x", "<|image:1|>", "line\nline", "é日"]
    data = [(c, t, role, said[(c + t) % len(said)], "clash") for c in range(8) for t, role in
            enumerate(["system", "user", "assistant", None, "odd: role\\", "assistant"])]
    data += [(9, 0, "user", "twice", "x")] * 2 + [(None, None, "assistant", "no id", "x")]
    m = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, formatted string")
    f = chat.format_conversations(m.withColumn("parts", chat.text_part(F.col("text"))))
    for r in f.select("*", chat.parsed_turns(F.col("formatted")).alias("t")).collect():
        want = [(x[2] or "", x[3] or "") for x in sorted((x for x in data if x[0] == r["conv_id"]), key=lambda x: x[1] or 0)]
        assert [(x["role"], x["text"]) for x in r["t"]] == want
    for r in chat.digest(f).collect():
        own = [(x[2] or "", x[3] or "") for x in sorted((x for x in data if x[0] == r["conv_id"]), key=lambda x: x[1] or 0)]
        loss = "".join(t for role, t in own if role == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest(chat.format_conversations(m.limit(0).withColumn("parts", chat.text_part(F.col("text"))))).count() == 0


def test_chat_parts_are_numbered_and_counted(spark):
    parts = [[("text", "see ", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None), (None, "!", None, None, None, None, None)],
             [("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 9)]]
    m = spark.createDataFrame([(1, i, "user", p) for i, p in enumerate(parts)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_conversations(m).first()
    assert r["formatted"] == "### user: see <|image:1|>!</turn>\n### user: <|audio:2|><|document:3|></turn>\n"
    assert [tuple(a) for a in r["attachments"]] == [("image", "a.png", 1, 4), ("audio", "b.wav", 2, 38), ("document", "c.pdf", 3, 3)]
    assert r["expanded_tokens"] == 45


# -- 9 ---------------------------------------------------------------------------------------------------

def test_language_id(spark, docs, none):
    data = [(i, (EN if i % 2 else DE)[i % 9:], "en" if i % 2 else "de") for i in range(40)] + [(100, None, "en"), (101, "123 !", "de"), (102, EN, None)]
    got = table(langid.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")))
    assert all(got[i]["lang_pred"] == lang for i, _, lang in data[:40]) and got[102]["lang_pred"] == "en"
    assert got[100]["lang_pred"] == got[101]["lang_pred"] == "und"
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    assert langid.identify(docs).count() == docs.count()
    assert langid.identify(none).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.mark.parametrize("k", [1, 2, 4, 6, 12])
def test_codewords_differ(k):
    code = langid.code_matrix(k)
    assert len({tuple(r) for r in code.tolist()}) == k and code.shape[0] == k


# -- 10 --------------------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def windows(items):
    out = collections.defaultdict(set)
    for item, text in items:
        w = terms(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            out[tuple(w[k:k + 10])].add("" if item is None else str(item))
    return out


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def test_decontamination(spark, docs, plain, none, monkeypatch):
    texts = texts_of(plain)
    items = [(1, EN[:70]), (2, "w1 w2"), (3, None), (4, "..."), (None, "Lazy DOG and"), (5, DE), (5, EN[20:]), (6, "spam spam spam")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    win = windows([i for i in items if i[1]])
    got = table(decontaminate.digest(decontaminate.matches(plain, bench)))
    for d, t in texts.items():
        w, hit, found = terms(t), set(), set()
        for g, ids in win.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    found |= ids
                    hit |= set(range(k, k + len(g)))
        r = got[d]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(found))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    clean = decontaminate.remove_spans(plain, bench)
    assert clean.columns == plain.columns
    for r in clean.collect():
        if got[r["doc_id"]]["n_hit"]:
            assert r["n_chars"] == len(r["text"]) and len(terms(r["text"])) == got[r["doc_id"]]["n_words"] - got[r["doc_id"]]["n_hit"]
        else:
            assert (r["text"] or "") == texts[r["doc_id"]]
    # Blocks of the query set, and small shards, give the same, repeated and null ids included.
    monkeypatch.setattr(decontaminate, "SHARD_CHARS", 300)
    assert len(decontaminate.benchmark_blocks(bench, 40)) > 1
    every = lambda df: collections.Counter(tuple(map(str, r)) for r in df.collect())
    assert every(decontaminate.matches(docs, bench, 40)) == every(decontaminate.matches(docs, bench))
    assert every(decontaminate.remove_spans(docs, bench, 40)) == every(decontaminate.remove_spans(docs, bench))
    assert decontaminate.matches(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.matches(none, bench).count() == 0


def test_suffix_array_and_ranks():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 400):
        s = rng.integers(0, 3, n)
        assert decontaminate.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())
        m = decontaminate.WaveletMatrix(s, 2)
        at = rng.integers(0, n + 1, 20)
        for c in range(3):
            assert m.rank(np.full(20, c), at).tolist() == [int((s[:a] == c).sum()) for a in at]
