import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskframe.llm import op2_line_dedup as op2
from riskframe.llm import op9_mixing as op9
from riskframe.llm import op10_decontamination as op10
from tests.llm.helpers import awkward_rows, frame, prose


# ---- lines
def clean(rows, least):
    sites = defaultdict(set)
    for _, text, _, source, _ in rows:
        for line in (text or "").split("\n"):
            sites[line.strip(" \t\r")].add(source)
    out = []
    for doc, text, _, _, _ in rows:
        lines = [] if text is None else text.split("\n")
        left = [x for x in lines if not x.strip(" \t\r") or len(sites[x.strip(" \t\r")]) < least]
        out.append((doc, len(lines), len(lines) - len(left), None if text is None else "\n".join(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("margin", [0.25, 0.0, 10.0])
def test_lines_match_brute_force(spark, margin):
    rows = [(i, "\n".join(["Menu", f"line {i % 4}", " Footer \r", prose(i, 5), "", "\t"]), None, f"s{i % 7}" if i % 7 else None, 0)
            for i in range(40)]
    rows += [(90 + i, f"rare\nline {i}", None, f"s{i}", 0) for i in range(3)] + awkward_rows()
    got = op2.clean_lines(frame(spark, rows), min_sites=5, margin=margin)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_removed", "text").collect()), key=str) == clean(rows, 5)


def test_lines_keep_columns_and_empty_tables(spark):
    df = frame(spark, awkward_rows(), extra=True)
    assert op2.clean_lines(df).columns == [*df.columns, "n_lines", "n_removed"]
    assert op2.clean_lines(frame(spark, [])).collect() == []


def test_line_dedup_runs_no_python(spark):
    plan = op2.clean_lines(frame(spark, awkward_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---- mixing
def mix(rows, epochs=3):
    docs = [(i, d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), hashlib.md5(f"{'' if d is None else d}-17".encode()).hexdigest())
            for i, (d, t, _, s, _) in enumerate(rows)]
    size = Counter()
    for _, _, s, n, _ in docs:
        size[s] += n
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight, budget = {s: k % 3 + 1 for k, s in enumerate(names)}, sum(size.values())
    capped: set = set()
    while True:  # share, stop those above their caps, share again
        free = [s for s in names if s not in capped]
        rest = budget - sum(epochs * size[s] for s in capped)
        target = {s: float(epochs * size[s]) if s in capped else rest * weight[s] / max(1, sum(weight[f] for f in free)) for s in names}
        over = [s for s in free if target[s] > epochs * size[s]]
        if not over:
            break
        capped |= set(over)
    copies = []
    for k, s in enumerate(names):
        mine = sorted((x for x in docs if x[2] == s), key=lambda x: (x[4], x[1] if x[1] is not None else -1, x[3]))
        for e in range(epochs):
            through = e * size[s]
            for n, x in enumerate(mine):
                through += x[3]
                copies.append((through / target[s] if target[s] else 0.0, k, e, n, x))
    taken, total = Counter(), 0
    for *_, x in sorted(copies, key=lambda c: c[:4]):
        total += x[3]
        if total <= budget:
            taken[x[0]] += x[3]
    return docs, size, target, taken


@pytest.mark.parametrize("rows", [awkward_rows(), [(i, prose(i, 5 + i % 30), None, f"s{i % 11 if i % 3 else 0}", 0) for i in range(300)]])
def test_mix_matches_brute_force(spark, rows):
    docs, size, target, taken = mix(rows)
    got = op9.mix(frame(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    key = lambda r: str(r)
    want = sorted(((d, n, size[s], round(target[s], 6), taken[i]) for i, d, s, n, _ in docs), key=key)
    assert sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got), key=key) == want
    assert all(r["taken"] <= 3 * r["size"] for r in got)


def test_mix_reruns_agree_and_repeats_rows(spark):
    rows = [(i, prose(i, 10 + i % 9), None, "small" if i < 6 else f"s{i % 2}", 0) for i in range(120)]
    df = frame(spark, rows, extra=True)
    a, b = (sorted(tuple(r) for r in op9.mix(x).select("doc_id", "taken").collect()) for x in (df.repartition(3), df.repartition(7)))
    assert a == b
    out = op9.apply_mix(df)
    assert out.columns == df.columns
    counts = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert {d: t for d, t in a if t} == {d: n * len(rows[d][1].split()) for d, n in counts.items()}


def test_rows_that_differ_in_other_columns_alone_stay_rows_of_their_own(spark):
    one = [(None, "same text here", "en", "a", 1), (None, "same text here", "de", "a", 2), (5, "other", "en", "a", 3), (5, "other", "fr", "a", 4)]
    got = Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in op9.apply_mix(frame(spark, one, extra=True)).collect())
    assert got == Counter(one)  # a lone source is taken once in full
    two = one + [(6, f"more {i}", None, "b", i) for i in range(4)]
    df = frame(spark, two)
    due = Counter()
    for r in op9.mix(df).collect():
        due[r["doc_id"], r["text_hash"]] += r["copies"]
    taken = Counter((r["doc_id"], r["h"]) for r in op9.apply_mix(df).select("doc_id", F.xxhash64("text").alias("h")).collect())
    assert taken == +due


def test_mix_of_nothing(spark):
    assert op9.mix(frame(spark, [])).collect() == [] and op9.apply_mix(frame(spark, [])).collect() == []
    got = op9.mix(frame(spark, [(1, None, None, None, None), (2, "", None, "a", 0)])).collect()
    assert sorted((r["doc_id"], r["target"], r["taken"]) for r in got) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_mix_runs_no_python(spark):
    plan = op9.mix(frame(spark, awkward_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---- benchmark passages
def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def judged(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(item)
    out = {}
    for d, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        ids = sorted(map(str, found))
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_passages_match_brute_force(spark):
    long = prose(70, 40)
    items = [(1, long), (2, prose(71, 13)), (3, "Two Words"), (4, ""), (5, None), (6, prose(72, 12)), (7, long), (8, "tick tock " * 12), (9, "mono")]
    w = long.split()
    rows = [(1, long, None, None, 0), (2, "pre " + " ".join(w[3:16]) + " post " + prose(80, 300, 300), None, None, 0),
            (3, " ".join(w[3:15]), None, None, 0), (4, prose(71, 13).upper() + " TWO, words", None, None, 0), (5, None, None, None, 0),
            (6, "", None, None, 0), (7, "tick tock " * 30, None, None, 0), (8, prose(72, 11), None, None, 0), (9, prose(72, 12), None, None, 0),
            (10, " ".join([prose(90, 200, 200), *w[10:30], prose(91, 150, 150), *w[0:14], "mono"]), None, None, 0),
            (11, " ".join(prose(s, 400) for s in range(500, 530)) + " " + long, None, None, 0)]
    rows += [(20 + i, " ".join(w[i:i + 20]) + " end", None, None, 0) for i in range(20)]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["contaminated"])
           for r in op10.judge(frame(spark, rows, extra=True), bench(spark, items)).collect()}
    assert got == judged(rows, items)


def test_every_long_shared_run_is_found():
    import pyarrow as pa

    from riskframe.llm import words as W
    a = prose(7, 200, 200).split()
    for start in range(0, 180, 7):
        for _, _, data, offsets in W.slices(pa.array([" ".join(a), " ".join(["other"] * 5 + a[start:start + 13] + ["words"] * 9)])):
            h, place = op10.fingerprints(W.split_words(data, offsets, W.NOT_WORD))
            assert set(h[place < 200].tolist()) & set(h[place >= 200].tolist())


def test_passages_awkward_and_empty(spark):
    rows, items = awkward_rows(), [(1, prose(1, 60)), (2, "one two"), (None, "漢字")]
    df = frame(spark, rows, extra=True)
    left = op10.drop_contaminated(df, bench(spark, items))
    assert left.columns == df.columns
    ids = [r["doc_id"] for r in left.select("doc_id").collect()]
    assert not {1, 2, 3, 7, 8} & set(ids) and {4, 5, 6, 9, 10, 11, 12} <= set(ids)
    assert op10.judge(frame(spark, []), bench(spark, items)).collect() == []
    none = op10.judge(df, bench(spark, [])).collect()
    assert len(none) == len({r[0] for r in rows}) and not any(r["contaminated"] for r in none)


def test_rows_of_one_doc_id_are_judged_by_their_own_texts(spark):
    passage = prose(70, 13)
    dirty = f"{passage} {prose(80, 187)}"  # 13 of 200 words: contaminated
    clean = [f"{prose(90 + i, 400)} {i}" for i in range(6)]
    rows = [(d, dirty, None, None, i) for d in (1, None) for i in range(2)]  # twice the words, the same hits
    rows += [(d, t, None, None, 9) for d in (1, 2, None) for t in clean]  # diluted by clean ones
    df, items = frame(spark, rows, extra=True), bench(spark, [(1, passage)])
    left = [(r["doc_id"], r["text"]) for r in op10.drop_contaminated(df, items).select("doc_id", "text").collect()]
    assert sorted(left, key=str) == sorted(((d, t) for d in (1, 2, None) for t in clean), key=str)
    got = op10.judge_rows(df, items)
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["contaminated"]) for r in got.collect()) == Counter(
        (d, len(words(t)), 13 if t == dirty else 0, t == dirty) for d, t, *_ in rows)
    assert got.select("row").distinct().count() == len(rows)
