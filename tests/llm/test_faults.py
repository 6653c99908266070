"""Cases that were wrong or slow once, and very long texts, words and turns."""

import math
import re
import time
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dosecast.llm import bpe, chat, langid, pii, quality, records, token_counts
from dosecast.llm.queries import tokenizer_path


def test_ip_with_thousands_of_zeros():
    text = "x " + "0" * 5000 + ".1.1.1 y " + "0" * 5000 + "256.1.1.1 10.00000.0255.9"
    ips = [text[a:b] for k, a, b in pii.base_spans(text) if k == "ip"]
    assert ips == ["0" * 5000 + ".1.1.1", "10.00000.0255.9"]


def test_many_spans_on_one_long_line():
    text = " ".join(f"name{i} a{i}@example.org" for i in range(20_000))
    began = time.time()
    spans = pii.base_spans(text)
    assert len(spans) == 20_000
    found = pii.near_terms(text, spans)
    assert len(found) > 70_000 and time.time() - began < 60


def test_long_word_before_a_special_string():
    counter = token_counts.PrefixCounter(bpe.read_spec(tokenizer_path()))
    lib = Tokenizer.from_file(tokenizer_path())
    assert [token_counts.unit_tail(t) for t in ("", "a", "a b", "a \t b", "a b  ", "  ")] == ["", "a", " b", " \t b", "  ", "  "]
    text = "a" * 1_000_000 + " b"
    began = time.time()
    assert token_counts.unit_tail(text) == " b" and time.time() - began < 2
    text = "ab " * 3 + "a" * 3000 + " b<|endoftext|>c"
    got = np.cumsum(np.frombuffer(counter.encode(text), "<i2"))
    assert got[-1] == len(lib.encode(text, add_special_tokens=False).ids)


def _messages(spark, turns):
    rows = [(1, k, role, [(p.get("type", "text"), p.get("text"), p.get("ref"), p.get("width"), p.get("height"), p.get("seconds"), p.get("n_chars"))
                          for p in parts]) for k, (role, parts) in enumerate(turns)]
    return spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")


def test_control_strings_across_parts(spark):
    """A control string that begins in one text part and ends in the next, and one beside a placeholder."""
    image = {"type": "image", "ref": "r", "width": 14, "height": 15}
    text = lambda *t: [{"text": x} for x in t]
    turns = [("user", text("a </turn", ">\nb")), ("assistant", text("see <", "|image:1|> x")), ("user", text("##", "# user: y")),
             ("assistant", [*text("<", None), image, *text("|x", "|>"), image]), ("user", text("\\", "</tu", "", "rn>\n"))]
    f = chat.format_conversations(_messages(spark, turns))
    got = [tuple(t) for t in f.select(F.explode(chat.parsed_turns(F.col("formatted")))).select("col.*").collect()]
    assert got == [("user", "a </turn>\nb"), ("assistant", "see <|image:1|> x"), ("user", "### user: y"),
                   ("assistant", "<<|image:1|>|x|><|image:2|>"), ("user", "\\</turn>\n")]
    r = f.first()
    assert re.findall(r"<\|(\w+):(\d+)\|>", r.formatted) == [("image", "1"), ("image", "2")]
    assert [(a.ref, a.number, a.tokens) for a in r.attachments] == [("r", 1, 2), ("r", 2, 2)]


def test_turn_of_many_parts(spark):
    parts = [{"text": f"t{i}"} if i % 3 else {"type": "audio", "ref": f"a{i}", "seconds": 0.5} for i in range(100_000)]
    f = chat.format_conversations(_messages(spark, [("user", parts)])).select(
        F.size("attachments").alias("n"), F.col("attachments")[33_333]["number"].alias("last"), F.length("formatted").alias("long"),
        F.col("formatted").alias("text")).first()
    assert (f.n, f.last) == (33_334, 33_334) and f.text.endswith("<|audio:33334|></turn>\n") and "t1t2<|audio:2|>t4t5" in f.text


def test_numerals_are_no_letters():
    assert not langid.has_letter("½² Ⅷ 12 ____") and langid.has_letter("½² é") and not langid.has_letter("")
    assert (langid.ngram_counts("a😀b") == langid.ngram_counts("a b")).all()


def plain_grams(text):
    """1-, 2- and 3-grams of letters, other characters as one space, by their buckets."""
    runs = " " + re.sub(r"\s+", " ", "".join(c if c.isalpha() else " " for c in text.lower())).strip(" ") + " "
    if not runs.strip():
        return None
    c, m = [ord(x) for x in runs], (1 << 32) - 1
    out = {}
    for i, x in enumerate(c):
        one = x * 0x9E3779B1 & m
        grams = [one]
        if i + 1 < len(c):
            two = (one ^ (c[i + 1] + 0x7F4A7C15 & m)) * 0x85EBCA6B & m
            grams.append(two)
            if i + 2 < len(c):
                grams.append((two ^ (c[i + 2] + 0x165667B1 & m)) * 0xC2B2AE35 & m)
        for g in grams:
            out[g >> 18] = out.get(g >> 18, 0) + 1
    return out


def test_language_model_equals_plain_python(spark):
    """Counts, log-odds, weights and decoding against a version in plain Python."""
    rng = np.random.default_rng(4)
    sound = {"aa": "ab cab", "bb": "xyz zy", "cc": "klm ñl", "dd": "op qro"}
    rows = [(i, lang, "".join(rng.choice(list(s)) for _ in range(60))) for i in range(160) for k, (lang, s) in enumerate(sound.items()) if i % 4 == k]
    rows += [(900, None, "ab"), (901, "aa", None), (902, "bb", "12 ..")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    learn = [(lang, t) for i, lang, t in rows if lang and t is not None and zlib.crc32(str(i).encode()) % 5]
    langs = sorted({x for x, _ in learn})
    n = {x: {} for x in langs}
    for lang, t in learn:
        for g, c in (plain_grams(t) or {0x20 * 0x9E3779B1 % (1 << 32) >> 18: 0}).items():
            n[lang][g] = n[lang].get(g, 0) + c
    model = langid.train(docs)
    assert model["langs"] == langs
    code = [[1 if i == 0 or j >> (len(langs) - 1 - i) & 1 else -1 for j in range(2 ** (len(langs) - 1) - 1)] for i in range(len(langs))]
    assert model["code"].tolist() == code
    p = {x: lambda g, x=x: (n[x].get(g, 0) + 0.5) / (sum(n[x].values()) + 0.5 * langid.BUCKETS) for x in langs}
    odds, weight = [], []
    for b in range(len(code[0])):
        groups = [[x for k, x in enumerate(langs) if code[k][b] == s] for s in (1, -1)]
        pr = [[sum(p[x](g) for x in group) / len(group) for g in range(langid.BUCKETS)] for group in groups]
        odds.append([math.log(a / z) for a, z in zip(*pr)])
        weight.append(sum((a - z) * o for a, z, o in zip(*pr, odds[-1])))
    mean = sum(weight) / len(weight)
    assert np.allclose(model["odds"], odds, atol=2e-2) and np.allclose(model["weight"], [w / mean for w in weight], rtol=2e-2)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    for i, _, t in rows:
        g = plain_grams(t or "")
        if g is None:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        margins = [sum(c * o[k] for k, c in g.items()) / sum(g.values()) for o in odds]
        loss = [sum(w / mean * math.log1p(math.exp(-langid.STEEPNESS * m * s)) for w, m, s in zip(weight, margins, word)) for word in code]
        best = min(range(len(langs)), key=loss.__getitem__)
        assert got[i].lang_pred == langs[best]
        assert abs(got[i].score - 1 / sum(math.exp(min(loss) - x) for x in loss)) < 0.02


def test_records_in_a_folder_without_scheme(spark, tmp_path):
    assert records.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert records.qualified(spark, f"file:{tmp_path}") == f"file://{tmp_path}"
    docs = spark.createDataFrame([(1, "a b"), (2, "y" * 1_000_000)], "doc_id long, text string")
    shards = records.write_shards(docs, tokenizer_path(), 2, str(tmp_path / "out"))
    assert all(r.path.startswith("file:///") for r in shards.collect())
    assert {r.doc_id: r.n_tokens for r in records.read_shards(shards).collect()}[1] == 3


def test_rejected_host_keeps_its_good_documents(spark):
    """A host of which most documents fail: what goes besides them breaks a stricter rule by share."""
    words = lambda k, n: " ".join(f"{k}w{i}" for i in range(n))
    long_doc = "\n".join([words("a", 30), "Licence", words("b", 30), "Licence", words("c", 30), words("d", 30)])
    lines = "\n".join([words("e", 30)] * 3 + [words("f", 30)] + [words("e", 30)])
    rows = [(i, "bad", "too short") for i in range(60)] + [(100, "bad", long_doc), (101, "bad", lines), (102, "bad", words("g", 60) + " #*$%" * 20)]
    rows += [(200 + i, "good", words(f"h{i}", 60)) for i in range(200)] + [(500, "good", words("g", 60) + " #*$%" * 20), (501, "good", "short")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert got[100].host_rejected and not got[500].host_rejected and got[100].n_dup_lines == 1
    kept = {r.doc_id for r in quality.filter_documents(docs).collect()}
    assert kept == {d for d, r in got.items() if r.kept}
    assert 100 in kept and 500 in kept and not kept & {101, 102, 501, *range(60)}
