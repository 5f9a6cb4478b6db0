"""op11 to op13 against plain Python on small tables with every awkward case."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm import op11_shallot as op11
from riskframe.llm import op12_packing as op12
from riskframe.llm import op13_lemp as op13
from tests.llm.helpers import awkward_rows, frame

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, length int, g int, bucket string, `of` string"


def table(spark, folder, rows):
    """An embeddings table with extra columns whose names the operators use inside."""
    spark.createDataFrame([(*r, *[None] * 6) for r in rows], SCHEMA).write.parquet(f"{folder}/embeddings.parquet")
    return folder


def clustered(n, width=64, centres=9, spread=0.1, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    return (middle[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, width))).astype(np.float32)


def awkward_vectors(n=400, seed=1):
    x = clustered(n, seed=seed)
    rows = [(i, [float(v) for v in x[i]], i % 4) for i in range(n)]
    rows += [(i, rows[5][1], 1) for i in range(1000, 1100)]  # copies of one vector
    rows += [(100, rows[7][1], 2), (100, rows[8][1], 1), (7, rows[7][1], 3)]  # repeated ids
    rows += [(2000, None, 1), (2001, [0.5] * 63 + [None], 1), (2002, [0.5] * 63 + [float("nan")], 2), (2100, [float("inf")] * 64, 2),
             (2003, [], 1), (2004, [0.25] * 3, 1), (2200, [0.25] * 3, 2), (2201, [0.25] * 3, 2), (None, [0.125] * 64, 2),
             (2300, [0.0] * 64, 1), (2301, [0.0] * 64, 2), (2400, [0.1] * 64, None), (-100, [0.5] * 64, 3), (-300, [-0.5] * 64, 0)]
    return rows


def floors(v, scale):
    return [int(np.floor(scale * float(np.float32(x)))) for x in v]


# ------------------------------------------------------------------ op11
def lloyd(rows, k=40, rounds=5):
    vectors = [(i, floors(v, 256)) for i, v, *_ in rows
               if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[0] or 0, r[1])
    cents = [v for _, v in sorted(vectors, key=key)[:k]]

    def nearest():
        out = []
        for _, v in vectors:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)))
        return out

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, v), (_, n) in zip(vectors, nearest()):
            members[n].append(v)
        cents = [[sum(col) // len(members[n]) for col in zip(*members[n])] if members[n] else c for n, c in enumerate(cents)]
    found = nearest()
    inertia = Counter()
    for d, n in found:
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    cut = lambda x: min(x, 2**63 - 1)
    return Counter((i, n, cut(d), cut(inertia[n]), cut(sum(inertia.values())), sha[n]) for (i, _), (d, n) in zip(vectors, found))


def op11_rows(spark, folder):
    got = op11.op11_shallot(spark, folder)
    return Counter(tuple(r) for r in got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


def test_clusters_equal_plain_rounds(spark, scratch):
    rows = awkward_vectors()
    assert op11_rows(spark, table(spark, scratch, rows)) == lloyd(rows)


def test_clusters_few_empty_and_large(spark, scratch):
    few = [(i, [float(i % 2)] * 64, 0) for i in range(5)]
    assert op11_rows(spark, table(spark, f"{scratch}/a", few)) == lloyd(few)
    assert op11_rows(spark, table(spark, f"{scratch}/b", [])) == Counter()
    large = [(i, [3e38 * (-1) ** (i + j) if j % 3 else float(j) for j in range(64)], 0) for i in range(60)]
    assert op11_rows(spark, table(spark, f"{scratch}/c", large)) == lloyd(large)


def test_search_skips_distances_on_clusters():
    x = np.floor(clustered(5000) * 256).astype(np.int64)
    cents = [[int(v) for v in row] for row in x[:40]]
    state = np.zeros(len(x), np.int32), np.ones(len(x), np.int32), np.full(len(x), np.inf), np.full(len(x), -np.inf)
    first = op11.assign(x, op11.prepare(cents, None), *state)
    moved = [[v + 1 for v in c] for c in cents]
    again = op11.assign(x, op11.prepare(moved, cents), *first[:4])
    for (cluster, second, *_), c in ((first, cents), (again, moved)):
        d = ((x[:, None, :] - np.array(c)[None]) ** 2).sum(2)
        assert (cluster == d.argmin(1)).all()
    assert again[4] < 0.25 * 40 * len(x)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 8), st.integers(1, 3))
def test_bounds_hold_over_moves(seed, k, spread):
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread + 1, (60, 3))  # many ties
    cents = [[int(v) for v in row] for row in rng.integers(-spread, spread + 1, (k, 3))]
    state = np.zeros(60, np.int32), np.full(60, min(1, k - 1), np.int32), np.full(60, np.inf), np.full(60, -np.inf)
    before = None
    for _ in range(4):
        state = op11.assign(x, op11.prepare(cents, before), *state)[:4]
        d = ((x[:, None, :] - np.array(cents)[None]) ** 2).sum(2)
        assert (state[0] == d.argmin(1)).all()
        own = np.sqrt(d[np.arange(60), state[0]])
        d[np.arange(60), state[0]] = 10**9
        assert (state[2] >= own).all() and (state[3] <= np.sqrt(d.min(1))).all()
        before, cents = cents, [[v + int(rng.integers(-1, 2)) for v in c] for c in cents]


# ------------------------------------------------------------------ op12
@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200), st.sampled_from([32, 33, 50]))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        best = min((r for r in rooms if r >= n), default=None)
        if best is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(best)] -= n
    held, ranks = defaultdict(list), Counter()
    for length, low, high, per, first, at in op12.plan(Counter(lengths), capacity):
        assert low == ranks[length]
        ranks[length] = high
        for k in range(low, high):
            held[first + (k - low) // per].append((at + (k - low) % per * length, length))
    assert ranks == Counter(lengths) and sorted(held) == list(range(len(held)))
    for slots in held.values():
        slots.sort()
        assert [o for o, _ in slots] == [sum(n for _, n in slots[:i]) for i in range(len(slots))]
    assert sorted(capacity - sum(n for _, n in s) for s in held.values()) == sorted(rooms)


def check_packed(rows, docs, capacity=1024):
    """rows: (doc_id, start, length, crc, sequence_id, offset); docs: (doc_id, text)."""
    t = Tokenizer.from_file(public_tokenizers.path(op12.TOKENIZER))
    want = Counter()
    for i, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = list(range(len(ids), 0, -capacity))[::-1]
        for piece, (a, b) in enumerate(zip([0, *cuts], cuts)):
            want[(i, piece, a, b - a, zlib.crc32(ids[a:b]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for slots in held.values():
        slots.sort()
        assert [o for o, _ in slots] == [sum(n for _, n in slots[:i]) for i in range(len(slots))]
        assert sum(n for _, n in slots) <= capacity
    return len(held), -(-sum(r["length"] for r in rows) // capacity)


@pytest.mark.parametrize("extra", [False, True])
def test_packing_of_awkward_documents(spark, scratch, extra):
    docs = awkward_rows() + [(20, " ".join(str(i) for i in range(9000)), "en", "a", 1)]
    frame(spark, docs, extra).repartition(3).write.parquet(f"{scratch}/documents.parquet")
    rows = op12.op12_packing(spark, scratch).collect()
    check_packed(rows, [(d[0], d[1]) for d in docs])


def test_packing_is_tight_and_empty_stays_empty(spark, scratch):
    rows = op12.op12_packing(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    used, least = check_packed(rows, [tuple(d) for d in docs])
    assert used <= 1.02 * least + 1
    frame(spark, []).write.parquet(f"{scratch}/documents.parquet")
    assert op12.op12_packing(spark, scratch).collect() == []


def test_sequences_hold_the_ids_of_their_pieces(spark):
    docs = frame(spark, awkward_rows())
    packed = op12.pack(docs, capacity=64).checkpoint()
    whole = {r["sequence_id"]: r for r in op12.sequences(packed).collect()}
    for r in packed.collect():
        s = whole[r["sequence_id"]]
        assert s["ids"][r["offset"]:r["offset"] + r["length"]] == r["ids"] and len(s["ids"]) <= 64
        assert (r["doc_id"], r["piece"], r["offset"]) in [tuple(p) for p in s["pieces"]]


def test_one_hot_length(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text")).repartition(7)
    got = op12.pack(docs).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count_distinct("offset").alias("o"), F.count("*").alias("c"))
    full = [r for r in got.collect()]
    assert len(full) == -(-3000 // (1024 // 4)) and all(r["n"] <= 1024 and r["o"] == r["c"] for r in full)


# ------------------------------------------------------------------ op13
def mined(rows):
    usable = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, floors(v, 256)) for i, v, lab in rows
              if i is not None and v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, v in usable:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (lab, v)), (lab, v))
    out = Counter()
    dot = lambda a, b: min(max(sum(x * y for x, y in zip(a, b)), -2**63), 2**63 - 1)
    for a, (lab, q) in anchors.items():
        scored = sorted((-dot(q, v), i, other) for i, other, v in usable if len(v) == len(q))
        for s, i, _ in [x for x in scored if x[2] == lab and x[1] != a][:5]:
            able = [(-n, j) for n, j, other in scored if other != lab and 80 * -s <= 100 * -n <= 100 * -s]
            for rank, (n, j) in enumerate(able[:5], 1):
                out[(a, i, rank, j, -s, n)] += 1
    return out


def op13_rows(spark, folder):
    got = op13.op13_lemp(spark, folder).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return Counter(tuple(r) for r in got.collect())


def test_hard_negatives_equal_brute_force(spark, scratch):
    rows = awkward_vectors(700)
    got = op13_rows(spark, table(spark, scratch, rows))
    # of copies of one id with one score, either row is the positive
    assert got == mined(rows) and len(got) > 50


def test_hard_negatives_over_many_buckets(spark):
    x = np.floor(clustered(900, 8, seed=3) * 40)
    rows = [(i, i % 3 if i % 5 else 0, [float(v) for v in x[i]]) for i in range(900)]
    vectors = spark.createDataFrame(rows, "id long, label long, v array<double>")
    one = op13.hard_negatives(vectors, F.col("id") % 30 == 0)
    many = op13.hard_negatives(vectors.repartition(5), F.col("id") % 30 == 0, bucket=60)
    assert sorted(one.collect()) == sorted(many.collect()) and one.count() > 100


def test_hard_negatives_of_little_and_large(spark, scratch):
    assert op13_rows(spark, table(spark, f"{scratch}/a", [])) == Counter()
    lone = [(100, [1.0, 2.0], 1)]
    assert op13_rows(spark, table(spark, f"{scratch}/b", lone)) == Counter()
    rnd = random.Random(4)
    large = [(i * 50, [rnd.choice([1e38, 2e30, 1.0, -5.0, 7.5e9]) for _ in range(4)], i % 2) for i in range(40)]
    assert op13_rows(spark, table(spark, f"{scratch}/c", large)) == mined(large)


def test_lists_leave_few_candidates_on_clusters():
    x = clustered(4000, 16, 60, 0.02)
    x = np.floor(x / np.sqrt((x ** 2).sum(1, keepdims=True)) * 256)  # of about one length, as in a bucket
    bucket = op13.Bucket(np.arange(4000), np.zeros(4000, int), x)
    for i in range(0, 4000, 97):
        s = x @ x[i]
        least = 0.97 * s[i]
        rows = bucket.candidates(x[i], least)
        assert rows is not None and set(np.flatnonzero(s >= least)) <= set(rows.tolist())
        assert len(rows) < 0.3 * 4000
