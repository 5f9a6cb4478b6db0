import hashlib
import json
import math
import random
import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm import bpe, chunks
from riskframe.llm import op3_token_records as op3
from riskframe.llm import op4_resampling as op4
from riskframe.llm import op5_url_rules as op5
from riskframe.llm import op12_packing as op12
from riskframe.llm import words as W
from tests.llm.helpers import awkward_rows, frame, prose

PATH = public_tokenizers.path(op3.TOKENIZER)


# ---- records
def encoded(encoder, texts):
    """The ids of each text, in slices of an Arrow column that begins inside its buffers."""
    column = pa.array(["left out", *texts])[1:]
    return [ids[first[i]:first[i + 1]].tolist() for a, b, ids, first in encoder.slices(column) for i in range(b - a)]


def wild_text(rnd):
    letters = "aAbBzZ09.,;:!?'’ \t\n\r\x0b\x0c\x1c\x85\xa0\u1680\u2003\u2028\u3000\u200b  éÉ̸́ñßİıſΣςσ漢字🙂<|>‍-_" + 8 * " "
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "the,", "end."]
    return "".join(rnd.choice(letters) if rnd.random() < 0.85 else rnd.choice(pieces) for _ in range(rnd.randint(0, 30)))


def new_encoder(path=PATH):
    op3._encoders.clear()
    return op3.encoder(path, op3.word_ranks(path))


def test_chunks_give_the_ids_of_whole_texts():
    rnd, plain, encoder = random.Random(4), Tokenizer.from_file(PATH), new_encoder()
    assert not encoder.whole
    texts = [wild_text(rnd) for _ in range(6000)] + ["Ünder ÉTÉ, ªº µ. ÿ ß ŁÓDŹ İs ǅ"]
    for text, got in zip(texts, encoded(encoder, texts), strict=True):
        assert got == plain.encode(text, add_special_tokens=False).ids + [op3.END_ID], repr(text)


def test_byte_pairs_give_the_ids_of_the_tokenizer():
    path, rnd = public_tokenizers.path(op12.TOKENIZER), random.Random(5)
    plain, encode = Tokenizer.from_file(path), op12.encoder(path, op12.word_ranks(path))
    texts = [wild_text(rnd) for _ in range(4000)] + [f"a{chr(c)}1 {chr(c)}" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    ids, sizes = encode(texts)
    for got, want in zip(np.split(ids, np.cumsum(sizes)[:-1]), plain.encode_batch(texts, add_special_tokens=False), strict=True):
        assert got.tolist() == want.ids


def test_unsound_vocabularies_are_refused(tmp_path):
    def file(vocab, merges, **more):
        out = tmp_path / "t.json"
        out.write_text(json.dumps({"added_tokens": [], "model": {"type": "BPE", "vocab": vocab, "merges": merges, **more}}))
        return str(out)

    good = {"a": 0, "b": 1, "c": 2, "ab": 3, "abc": 4}
    assert bpe.ranks(file(good, ["a b", "ab c"]))[0] == {k.encode(): v for k, v in good.items()}
    # abc is made of (a, bc), but ab is merged first
    assert bpe.ranks(file(good | {"bc": 5, "abc": 6, "x": 4}, ["a b", "b c", "a bc"])) is None
    assert bpe.ranks(file({"a": 0, "b": 1, "c": 2, "bc": 4, "ab": 3}, ["b c", "a b"])) is None  # ids don't follow merges
    assert bpe.ranks(file(good, ["a b", "ab c"], dropout=0.1)) is None


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = new_encoder(path), Tokenizer.from_file(path)
    texts = ["", "Two  words", " a", "x" * 1000]
    assert encoder.whole and encoded(encoder, texts) == [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    ids, _ = op12.encoder(PATH, op12.word_ranks(PATH))(["Two words"])
    assert ids.tolist() == Tokenizer.from_file(PATH).encode("Two words", add_special_tokens=False).ids


def test_small_slices_change_nothing(monkeypatch):
    texts = [prose(s, 200) for s in range(30)] * 2
    want = encoded(new_encoder(), texts)
    monkeypatch.setattr(chunks, "SLICE", 3000)
    assert encoded(new_encoder(), texts) == want


def test_a_hot_id_spreads_over_shards(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.lit("one two three").alias("text"))
    out = op3.output_folder(spark)
    op3.write_records(rows, out, shards=8)
    sizes = [r["n"] for r in op3.scan_records(spark, out).groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500
    index = op3.write_index(spark, out)
    assert index.agg(F.count_distinct("start")).first()[0] == 4000


def test_shards_follow_the_numbers_in_their_names(spark):
    out = op3.output_folder(spark)
    op3.write_records(spark.createDataFrame([(i, "a b") for i in range(30)], "doc_id long, text string"), out, shards=3)
    files = {r["shard"] for r in op3.scan_records(spark, out).select("shard").distinct().collect()}
    moved = {f: f.replace(f[5:10], n) for f, n in zip(sorted(files), ("99998", "99999", "100000"))}
    fs = spark._jvm.org.apache.hadoop.fs
    for f, to in moved.items():
        old = fs.Path(f"{out}/records/{f}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, fs.Path(f"{out}/records/{to}"))
    index = op3.write_index(spark, out).orderBy("start").collect()
    assert [r["doc_id"] for r in index] == list(range(30))


def test_records_round_trip(spark):
    rows = awkward_rows()
    df, plain = frame(spark, rows, extra=True).repartition(5), Tokenizer.from_file(PATH)
    out = op3.output_folder(spark)
    op3.write_records(df, out, shards=4)
    index = op3.write_index(spark, out).orderBy("start").collect()
    want = sorted(((r[0], [*plain.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in rows),
                  key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r["doc_id"] for r in index] == [w[0] for w in want]
    start = 0
    for r in index:
        assert r["start"] == start
        start += r["n_tokens"]
    crc = Counter((d, len(i), zlib.crc32(struct.pack(f"<{len(i)}I", *i))) for d, i in want)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in index) == crc
    read = Counter((r["doc_id"], tuple(r["ids"])) for r in op3.scan_records(spark, out).collect())
    assert read == Counter((d, tuple(i)) for d, i in want)
    some = op3.read_documents(spark, out, spark.createDataFrame([(12,), (4,), (999,)], "doc_id long")).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in some} == {d: i for d, i in want if d in (12, 4)}


def test_damage_is_noticed():
    good = op3.frame(b"payload") + b"\n"
    assert bytes(op3.unframe(good, 0)[0]) == b"payload" and op3.unframe(good, 0)[1] == len(good)
    for i in range(len(good)):
        with pytest.raises(ValueError):
            op3.unframe(good[:i] + bytes([good[i] ^ 1]) + good[i + 1:], 0)


def test_records_of_nothing(spark):
    assert op3.encode_and_read_back(frame(spark, [])).collect() == []


# ---- resampling
def test_weights_and_sample_match_brute_force(spark):
    rows = [(i, prose(i % 7, 30) + " " + prose(1000 + i, 8), None, None, 0) for i in range(60)] + [(60, None, None, None, 0), (61, "", None, None, 0)]
    good = [(i,) for i in range(0, 60, 7)] + [(None,), (777,)]
    got = {r["doc_id"]: r for r in op4.resample(frame(spark, rows, extra=True), spark.createDataFrame(good, "doc_id long"), share=0.3).collect()}

    def buckets(text):
        for _, _, data, offsets in W.slices(pa.array([text or ""])):
            return Counter(op4.ngram_buckets(W.split_words(data, offsets, W.NOT_WORD))[0].tolist())
    bags = {r[0]: buckets(r[1]) for r in rows}
    raw, target = sum(bags.values(), Counter()), sum((bags[i] for i, in good if i in bags), Counter())
    log = lambda c, b: math.log((c[b] + 1) / (sum(c.values()) + op4.BUCKETS))
    keys = {}
    for d, bag in bags.items():
        weight = sum(n * (log(target, b) - log(raw, b)) for b, n in bag.items())
        assert abs(got[d]["log_weight"] - weight) < 1e-3 and got[d]["n_ngrams"] == sum(bag.values())
        u = (int(hashlib.md5(f"{d}-23".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        keys[d] = weight - math.log(-math.log(u))
        assert abs(got[d]["key"] - keys[d]) < 1e-3
    best = sorted(keys, key=lambda d: -keys[d])[:round(0.3 * len(rows))]
    assert {d for d, r in got.items() if r["selected"]} == set(best)
    assert sorted(r["rank"] for r in got.values()) == list(range(1, len(rows) + 1))
    # target-like documents weigh more
    mean = lambda ids: sum(got[i]["log_weight"] for i in ids) / len(ids)
    assert mean([i for i in range(60) if i % 7 == 0]) > mean([i for i in range(60) if i % 7])


def test_resampling_awkward_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long")
    got = op4.resample(frame(spark, awkward_rows(), extra=True), none).collect()
    assert len(got) == len(awkward_rows()) and all(r["log_weight"] == 0 for r in got)
    assert sum(r["selected"] for r in got) == round(len(got) / 2)
    assert op4.resample(frame(spark, []), none).collect() == []
    a, b = (sorted(((r["doc_id"], r["selected"]) for r in op4.resample(frame(spark, awkward_rows()).repartition(n), none).collect()), key=str) for n in (1, 6))
    assert Counter(a) == Counter(b)


# ---- URLs
def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest[:min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))]
    path = rest[len(host):]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def fixed(host, path):
    fits = [(h + p, v) for h, p, v in op5.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


URLS = (["http://www.example.com/en/1", "HTTPS://WWW.Example.COM/en/x?a=1", "http://a.www.example.com/en/", "http://example.com/en/2", "http://b.example.com/en/2#x",
         "http://example.com/fr/", "http://example.com", "http://com/", "http://notexample.com/en/", "ftp://x.net/es/1", "http://x.net/fr/9", "http://x.net/en/3",
         "http://x.net/ES/3", None, "", "no scheme", "http://", "http://?q", "x://y://z.com/en/", "http://h.org/a\nb/c?d", "http://x.org/en/1", "http://x.org/en/1"]
        + [f"http://{h}.example.{t}/{p}/{i}" for i in range(12) for h in ("ads-track", "news") for t in ("com", "net", "org") for p in ("en", "es", "fr")])


def pages(spark, urls):
    return spark.createDataFrame([(i, u, None, None) for i, u in enumerate(urls)], "page_id long, url string, host string, tokens string")


def test_hosts_paths_and_fixed_rules(spark):
    got = op5.judge(pages(spark, URLS), min_support=0.02).collect()
    assert len(got) == len(URLS)
    for r in got:
        assert (r["host"], r["path"]) == split(URLS[r["page_id"]])
        rule, verdict = fixed(r["host"], r["path"])
        assert r["rule"] == rule and (verdict is None or r["verdict"] == verdict) and r["verdict"] in ("allow", "block")


def test_mined_rules_match_brute_force(spark):
    support, confidence = 0.05, 0.9
    parts = op5.url_parts(F.col("url"))
    tokens = {r["page_id"]: tuple(r["t"]) for r in pages(spark, URLS).select("page_id", op5.url_tokens(*parts.values()).alias("t")).collect()}
    verdicts = {i: fixed(*split(u))[1] for i, u in enumerate(URLS)}
    labelled = [(set(tokens[i]), v) for i, v in verdicts.items() if v]
    count, of = Counter(), defaultdict(Counter)
    for t, v in labelled:
        for n in range(1, len(t) + 1):
            for c in combinations(sorted(t), n):
                count[c] += 1
                of[c][v] += 1
    rules = [(of[c][v] / count[c], of[c][v] / len(labelled), len(c), v == "block", v, set(c)) for c in count for v in of[c]
             if of[c][v] >= math.ceil(support * len(labelled)) and of[c][v] / count[c] >= confidence]
    assert rules
    got = {r["page_id"]: r for r in op5.judge(pages(spark, URLS), min_support=support, min_confidence=confidence).collect()}
    decided = 0
    for i, v in verdicts.items():
        if v is None:
            fits = [x for x in rules if x[5] <= set(tokens[i])]
            want = max(fits, key=lambda x: x[:4])[4] if fits else op5.DEFAULT
            assert got[i]["verdict"] == want and (got[i]["mined"] is not None) == bool(fits)
            decided += bool(fits)
    assert decided > 10


def test_urls_without_labels_and_empty(spark):
    got = op5.judge(pages(spark, ["http://x.org/en/1", None])).collect()
    assert [r["verdict"] for r in got] == [op5.DEFAULT] * 2
    assert op5.judge(pages(spark, [])).collect() == []


def test_urls_of_many_arguments_are_mined_at_once(spark):
    """2^40 subsets of one URL's tokens are all frequent; tokens of equal rows are one item."""
    import time
    long = "http://a.net/es/p.html?" + "&".join(f"arg{i}=1" for i in range(40))
    urls = [long] * 3 + [f"http://b{i}.com/d/{i}" for i in range(120)] + ["http://q.org/x?arg7=2&arg9=3", "http://q.org/x?other=1"]
    started = time.time()
    got = {r["page_id"]: r for r in op5.judge(pages(spark, urls)).collect()}
    assert time.time() - started < 60
    assert [got[i]["verdict"] for i in range(3)] == ["block"] * 3
    # any of its tokens marks the rule, and those that a URL has are the rule's
    assert got[123]["verdict"] == "block" and got[123]["mined"] == ["arg:arg7", "arg:arg9"]
    assert got[124]["verdict"] == op5.DEFAULT
