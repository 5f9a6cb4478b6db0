import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import op6_dual_tree as op6
from riskframe.llm import op7_toxicity as op7
from riskframe.llm import op8_chat_repair as op8
from riskframe.llm import words as W
from tests.llm.helpers import awkward_rows, frame, prose


# ---- search
def best(rows, k=10):
    ok = [(i, [int(np.floor(np.float64(np.float32(x)) * 1024)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    out = []
    queries = {}
    for i, v in ok:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    for q, v in queries.items():
        scored = sorted((-max(min(sum(a * b for a, b in zip(v, w)), op6.HIGH), op6.LOW), i) for i, w in ok if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = op6.whole_numbered(df)
    return sorted(tuple(r) for r in op6.search(v, v.where("id % 100 = 0"), **how).collect())


def test_search_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=8) * (0.05 if i % 3 else 0)]) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # copies: ties go to the smaller id
    assert run(spark, rows, block=200, group=3) == best(rows)


def test_search_awkward(spark):
    rows = [(0, [1.0, -0.0005]), (100, [3e38, 3e38]), (1, [1e30, 2.0]), (2, [1e30, 2.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 0.0]), (7, [1.0]), (8, []), (200, []), (None, [1.0, 1.0]), (9, [-0.25, 0.0]), (9, [-0.25, 0.0]), (300, [0.5, 0.5, 0.5])]
    assert run(spark, rows) == best(rows)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


def test_trees_cover_and_prune():
    rng = np.random.default_rng(0)
    x = np.rint(1024 * np.concatenate([rng.normal(size=(300, 6)) * 0.01 + c for c in rng.normal(size=(30, 6)) * 3]))
    seen, todo = [], [op6.cover_tree(x)]
    while todo:
        node = todo.pop()
        assert np.sqrt(((x[node.points] - node.centre) ** 2).sum(1)).max() <= node.radius + 1e-9
        assert (x[node.points] == node.centre).all(1).any()
        seen += [] if node.children else node.points.tolist()
        todo += node.children
    assert sorted(seen) == list(range(len(x)))
    ids = np.arange(len(x))
    search = op6.Search(x[::50], ids[::50], x, ids, 5)
    assert search.products < 0.5 * len(x) * len(x[::50])
    s = x[::50] @ x.T
    s[np.arange(len(s)), ids[::50]] = -np.inf
    want = np.take_along_axis(s, np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, :5], 1)
    assert (search.scores == want).all()


def test_cells_and_bounds_leave_out_blocks_before_the_shuffle(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(24, 8)) * 4
    rows = [(i, [float(x) for x in centres[rng.integers(24)] + 0.02 * rng.normal(size=8)]) for i in range(2400)]
    v = op6.whole_numbered(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    stats = {}
    got = sorted(tuple(r) for r in op6.search(v, v.where("id % 100 = 0"), block=100, group=4, stats=stats).collect())
    assert got == best(rows)
    assert stats["blocks"] >= 24 and stats["pairs"] < 0.5 * stats["blocks"] * stats["groups"]


# ---- toxicity
def toxic_corpus(n, seed):
    """Documents over one vocabulary; toxic ones hold a few words of three stems with endings of their own."""
    rnd, rows = random.Random(seed), []
    vocabulary, stems = prose(42, 3000, 3000).split(), ["grumblo", "zorkatt", "flimpur"]
    for i in range(n):
        w = [rnd.choice(vocabulary) for _ in range(rnd.choice([20, 80, 400]))]
        toxic = i % 4 == 0
        for _ in range(rnd.randint(1, 3) if toxic else 0):
            w[rnd.randrange(len(w))] = rnd.choice(stems) + "".join(rnd.choices("aeioulmn", k=rnd.randint(0, 3)))
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_unseen_misspellings_are_found_in_long_texts():
    train, held = toxic_corpus(800, 1), toxic_corpus(300, 2)
    model = op7.train(pa.array([r[1] for r in train]), np.array([r[2] for r in train]))
    scores = np.concatenate([model.scores(d, o) for _, _, d, o in W.slices(pa.array([r[1] for r in held]))])
    toxic = np.array([r[2] for r in held])
    assert ((scores >= 0.5) == toxic).mean() > 0.93  # 200 toxic examples
    again = op7.train(pa.array([r[1] for r in train]), np.array([r[2] for r in train]))
    assert (again.buckets == model.buckets).all()


def test_toxicity_by_spark_holds_out_and_keeps_columns(spark):
    rows = toxic_corpus(300, 3)
    df = frame(spark, [(i, t, None, None, 0) for i, t, _ in rows] + [(-1, None, None, None, 0), (-2, "", None, None, 0), (None, "x y", None, None, 0)], extra=True)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (10**9, 1)], "doc_id long, toxic int")
    model = op7.fit(df, labels)
    got = {r["doc_id"]: r["score"] for r in op7.score(df.repartition(7), model).collect()}
    assert len(got) == 303 and all(0 <= s <= 1 for s in got.values()) and got[-1] == got[-2]
    assert got == {r["doc_id"]: r["score"] for r in op7.score(df.coalesce(1), model).collect()}
    left = op7.drop_toxic(df, model)
    assert left.columns == df.columns
    assert {r["doc_id"] for r in left.select("doc_id").collect()} == {d for d, s in got.items() if s < 0.5}
    held = {r["doc_id"]: r["h"] for r in df.select("doc_id", op7.held_out(df["doc_id"]).alias("h")).collect()}
    import zlib
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(300))


@pytest.mark.parametrize("toxic, score", [([], 0), ([0, 0], 0), ([1, 1], 1)])
def test_toxicity_without_both_classes(spark, toxic, score):
    df = frame(spark, awkward_rows())
    labels = spark.createDataFrame([(i + 1, y) for i, y in enumerate(toxic)], "doc_id long, toxic int")
    assert {round(r["score"]) for r in op7.score(df, op7.fit(df, labels)).collect()} == {score}
    assert op7.score(frame(spark, []), op7.fit(frame(spark, []), labels)).collect() == []


def plain_score(model, text):
    """A document's score by plain Python integers and lists."""
    full, base = 2**64 - 1, int(W._BASE)

    def mix(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & full
        h = (h ^ h >> 27) * 0x94D049BB133111EB & full
        return h ^ h >> 31

    words = re.findall("[0-9A-Za-z\x80-\U0010ffff]+", text or "")
    scores = []
    for w in words:
        codes = [mix(ord(c) + 32 if "A" <= c <= "Z" else ord(c)) for c in f"<{w}>"]
        found = [mix(sum(c * pow(base, i, 2**64) for i, c in enumerate(codes)) & full)]
        for k in op7.GRAMS:
            found += [mix(k + sum(c * pow(base, j + 8, 2**64) for j, c in enumerate(codes[i:i + k])) & full) for i in range(len(codes) - k + 1)]
        scores.append(sum(float(model.buckets[h % op7.BUCKETS]) for h in found) / len(found))
    n = min(len(scores), op7.BAG)
    worst = max((sum(scores[i:i + n]) / n for i in range(len(scores) - n + 1)), default=0.0) if n else 0.0
    return 1 / (1 + np.exp(-(worst + model.bias)))


def test_scores_match_plain_python(spark):
    rows = toxic_corpus(200, 5)
    df = frame(spark, awkward_rows() + [(100 + i, t, None, None, 0) for i, t, _ in rows])
    model = op7.fit(df, spark.createDataFrame([(100 + i, y) for i, _, y in rows], "doc_id long, toxic int"))
    want = sorted(plain_score(model, r["text"]) for r in df.select("text").collect())
    got = sorted(r["score"] for r in op7.score(df.select("doc_id", "text"), model).collect())
    assert np.allclose(got, want, atol=1e-5) and max(got) > 0.9 > 0.1 > min(got)


def test_training_sample_is_bounded_in_bytes(spark, monkeypatch):
    rows = [(i, "x" * (10 * i), None, None, 0) for i in range(1, 100)] + [(200, "y" * 5000, None, None, 0), (7, "longer " * 20, None, None, 0)]
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in rows], "doc_id long, toxic int")
    monkeypatch.setattr(op7, "MAX_TEXT", 4000)
    kept = {b: {r["doc_id"]: r["text"] for r in op7.sample(frame(spark, rows), labels, max_bytes=b).collect()} for b in (6000, 10**9)}
    assert set(kept[6000]) < set(kept[10**9]) and 3000 < sum(map(len, kept[6000].values())) <= 6000
    assert 200 not in kept[10**9] and kept[10**9][7] == "longer " * 20 and len(kept[10**9]) > 70


def test_bags_match_plain_python():
    texts = ["Ab c,d é漢 x", "", "word", "a b c d e f g h i j k l m n o p q r s t"]
    for _, _, data, offsets in W.slices(pa.array(texts)):
        bags = op7.Bags(data, offsets)
    assert np.diff(bags.first).tolist() == [5, 0, 1, 20]
    for i, w in enumerate(["ab", "c", "d", "é漢", "x"]):
        n = len(f"<{w}>")
        size = bags.bounds[bags.word[i] + 1] - bags.bounds[bags.word[i]]
        assert size == 1 + sum(max(0, n - k + 1) for k in op7.GRAMS)
    scores = np.arange(26.0)
    best, at, end = op7.row_worst(scores, bags.first)
    assert best.tolist() == [2.0, 0.0, 5.0, np.arange(10, 26).mean()] and at.tolist()[3] == 10 and end.tolist()[3] == 26


# ---- conversations
def cheapest(roles):
    """Least cost over all labels, merges and insertions, by trying all of them."""
    def extend(seq, to):  # cheapest legal way from the last turn to ``to``
        return len(op8.INSERT[seq[-1] if seq else 0, to]) if (seq[-1] if seq else 0, to) in op8.INSERT else None
    top = None
    for labels in product((1, 2, 3), repeat=len(roles)):
        for merged in product((False, True), repeat=len(roles)):
            seq, cost, ok = [], 0, True
            for role, label, m in zip(roles, labels, merged):
                cost += 0 if role == label else op8.COST_UNKNOWN if role == 0 else op8.COST_RELABEL
                if m:
                    ok &= bool(seq) and seq[-1] == label
                    cost += op8.COST_MERGE
                else:
                    ways = [len(run) for (a, b), run in op8.INSERT.items() if a == (seq[-1] if seq else 0) and label in op8.NEXT[b]]
                    ok &= bool(ways)
                    cost += op8.COST_INSERT * min(ways, default=0)
                    seq.append(label)
            n = extend(seq, 3)
            if ok and n is not None:
                cost += op8.COST_INSERT * n
                top = cost if top is None else min(top, cost)
    return top


def legal(text):
    roles = [x.split("\n")[0] for x in text.split(op8.OPEN)[1:]]
    assert text.count(op8.OPEN) == text.count(op8.CLOSE) == len(roles) and text.endswith(f"{op8.CLOSE}\n")
    body = roles[1:] if roles[0] == "system" else roles
    return body and len(body) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def repaired(df):
    out = defaultdict(list)
    for r in op8.repair_conversations(df).collect():
        out[r["conv_id"]].append(r)
    return out


NAMES = ["tool", "system", "user", "assistant"]


def test_repairs_are_cheapest_and_legal(spark):
    rnd = random.Random(6)
    convs = [r for n in (1, 2) for r in product(range(4), repeat=n)] + [[rnd.randrange(4) for _ in range(rnd.randint(3, 4))] for _ in range(25)]
    rows = [(c, t, NAMES[r], f"t{c}-{t}") for c, roles in enumerate(convs) for t, r in enumerate(roles)]
    got = repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for c, roles in enumerate(convs):
        turns = sorted(got[c], key=lambda r: r["turn"])
        text = "".join(r["fragment"] for r in turns)
        assert sum(r["cost"] for r in turns) == cheapest(roles) and legal(text)
        assert [text.index(f"t{c}-{t}") for t in range(len(roles))] == sorted(text.index(f"t{c}-{t}") for t in range(len(roles)))


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_a_conversation_over_many_partitions(spark, partitions, monkeypatch):
    rnd = random.Random(8)
    rows = [(5, t, NAMES[rnd.randrange(4)], f"x{t}") for t in range(600)] + [(c, t, NAMES[2 + t % 2], "y") for c in (1, 9) for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    monkeypatch.setattr(op8, "shuffle_partitions", lambda _: partitions)
    got = repaired(df)
    turns = [(t, r, x, 0) for c, t, r, x in rows if c == 5]
    path = op8.repair(turns)
    want = [f[4] for f in op8.render(path, turns, op8.START, True)]
    assert [r["fragment"] for r in sorted(got[5], key=lambda r: r["turn"])] == want and legal("".join(want))
    assert all(r["cost"] == 0 for c in (1, 9) for r in got[c])


def test_conversations_awkward_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, cost int, fragment string"
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None), (2, 1, " HUMAN ", ""), (None, 3, "gpt", "q" * 50_000),
            (None, None, "system", "s"), (3, 0, "assistant", "<|im_end|> injected"), (4, 0, "system", None), (4, 1, "system", "")]
    got = repaired(spark.createDataFrame([(*r, None, None) for r in rows], schema))
    assert Counter(len(v) for v in got.values()) == Counter([3, 2, 2, 1, 2])
    for conv in (2, 3, 4, None):
        text = "".join(r["fragment"] for r in sorted(got[conv], key=lambda r: (r["turn"] is not None, r["turn"] or 0)))
        assert legal(text)
    assert sum(r["cost"] for r in got[1]) == cheapest([2, 2, 2])
    assert op8.repair_conversations(spark.createDataFrame([], schema)).collect() == []
