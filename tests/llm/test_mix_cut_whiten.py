"""Cutting for fill-in-the-middle, mixing to weights, whitening: against brute force, and on odd rows."""

import hashlib
import json
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import differences, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.llm import middle, mixing, whitening
from starmill.llm.common import read
from starmill.llm.queries import ORACLES, QUERIES

# Columns that clash with what operators return or use.
DOCS = "doc_id long, text string, source string, size long, form string, output string, target double, __cut string, __part int"
LONG = "a" * 1_000_000


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "psm", "x", 0.5, "y", 3) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "one two", "b"), (2, "one two", "b"), (2, "one two", "b"), (3, None, "a"), (None, "some words", None), (None, None, None)]
    rows += [(4, "", "c"), (5, " \n\t ", "c"), (6, LONG, "b"), (7, "word " * 100_000, "z"), (8, "ünï 𝒳 <S> it's", "b"), (9, "𝒳é" * 5000, "")]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [(1, "x", "a")]).where("false")


@pytest.mark.parametrize("name", ["op1_pivot_topk", "op11_block_tree_middle", "op12_systematic_mix"])
def test_queries_against_their_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) == ""


# --- cutting ---------------------------------------------------------------------------------


def naive_middle(doc_id, text):
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    front, centre, back = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{back}<P>{front}<M>{centre}")
    return (doc_id, n, "psm", a, b - a, f"<P>{front}<S>{back}<M>{centre}")


def test_middle_on_odd_rows(spark, odd, nothing):
    got = middle.transform(odd).withColumn("restored", middle.restored())
    rows = Counter(tuple(r)[:6] for r in got.collect())
    assert rows == Counter(naive_middle(r.doc_id, r.text) for r in odd.collect())
    assert Counter(r.restored for r in got.collect()) == Counter(r.text or "" for r in odd.collect())
    assert middle.digest(middle.transform(nothing)).count() == 0


def test_middle_of_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    got = middle.transform(docs)
    assert {r.form for r in got.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    assert Counter(tuple(r) for r in got.collect()) == Counter(naive_middle(r.doc_id, r.text) for r in docs.collect())


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é𝒳\n\t "), max_size=60), st.integers(1, 9), st.sampled_from(sorted(middle.UNITS)))
def test_tree_finds_every_unit(text, block, units):
    pattern = {"code_points": r"(?s).", "words": r"(?s)^\s*\S+\s*|\S+\s*|^\s+$", "lines": r"(?s)[^\n]*\n|[^\n]+"}[units]
    ends = [0, *(m.end() for m in re.finditer(pattern, text))]
    tree = middle.BlockTree(text.encode(), units, block)
    assert tree.total == len(ends) - 1
    assert [tree.chars_before(i) for i in range(tree.total + 1)] == ends


def test_middle_between_words(spark):
    text = " a bb  ccc\n dd e"
    rows = middle.transform(docs_of(spark, [(i, text, None) for i in range(60)]), units="words", block=4)
    for r in rows.withColumn("restored", middle.restored()).collect():
        assert r.n == 5 and r.restored == text
        if r.form != "plain":
            assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= {0, 3, 7, 12, 15, 16}


# --- mixing ----------------------------------------------------------------------------------


def naive_targets(sizes):
    """By giving away what is above the limit, round by round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = sum(sizes.values())
    share = {s: total * weight[s] / sum(weight.values()) for s in names}
    full = set()
    while True:
        above = [s for s in names if s not in full and share[s] > 3 * sizes[s] + 1e-9]
        if not above:
            return share
        full.update(above)
        excess = sum(share[s] - 3 * sizes[s] for s in above)
        rest = [s for s in names if s not in full]
        for s in above:
            share[s] = 3 * sizes[s]
        for s in rest:
            share[s] += excess * weight[s] / sum(weight[r] for r in rest)


def check_mix(rows, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((i, s, size(t)) for i, t, s in docs)
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        sizes[source] += size(text)
        largest[source] = max(largest[source], size(text))
    aims = naive_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(aims[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - aims[source]) <= 2 * largest[source] + 1


def test_mix_on_odd_rows(spark, odd, nothing):
    docs = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    check_mix(mixing.mix(odd).collect(), docs)
    assert mixing.mix(nothing).count() == 0
    wordless = docs_of(spark, [(1, None, "a"), (2, "", None)])
    assert [(r.target, r.taken) for r in mixing.mix(wordless).collect()] == [(0.0, 0), (0.0, 0)]


def test_mix_with_a_hot_source_and_repeats(spark):
    rng = np.random.default_rng(4)
    docs = [(int(i) if i % 3 else None, "w " * int(rng.integers(0, 40)), "hot") for i in range(900)]
    docs += [(5, "w w w", f"s{i % 11}") for i in range(600)] + [(i, "w" * 3, "𝒳") for i in range(40)] + [(i, "w x", "￿") for i in range(40)]
    check_mix(mixing.mix(docs_of(spark, docs)).collect(), docs)


def test_mix_agrees_on_any_partitions(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    rows = lambda df: Counter(tuple(r) for r in mixing.mix(df).collect())
    assert rows(docs) == rows(docs.repartition(5, "n_chars"))


def test_mix_emits_copies(spark, sf_dir):
    mixed = mixing.mix(read(spark, sf_dir, "documents"), keep=["text", "lang"])
    out = mixing.emitted(mixed)
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]
    words = out.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert words == mixed.agg(F.sum("taken")).first()[0]
    assert out.groupBy("doc_id").agg(F.max("copy").alias("m"), F.max("copies").alias("c")).where("m <> c").count() == 0


def test_mix_needs_no_python(spark, sf_dir):
    plan = mixing.mix(read(spark, sf_dir, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- whitening -------------------------------------------------------------------------------


def naive_whiten(vectors, k=4):
    """In a process of its own, with one thread of linear algebra."""
    code = """
import json, sys
import numpy as np
vectors, k = json.load(sys.stdin)
x = [[int(np.floor(256 * c)) for c in v] for _, v in vectors]
fit = np.array(sorted(set(map(tuple, x))))
n, s = len(fit), fit.sum(axis=0)
d = fit - s / n
values, axes = np.linalg.eigh(d.T @ d / n)
values, axes = values[::-1], axes[:, ::-1]
k = min(k, len(values))
out = []
for (i, _), v in zip(vectors, x):
    far = sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s))
    w = [float((np.array(v) - s / n) @ axes[:, c] / np.sqrt(values[c])) if values[c] > 1e-9 else None for c in range(k)]
    out.append([i, n, far, w])
print(json.dumps([out, [float(e) for e in values[:k] / values.sum()]]))
"""
    env = {"OPENBLAS_NUM_THREADS": "1", "OMP_NUM_THREADS": "1"}
    done = subprocess.run([sys.executable, "-c", code], input=json.dumps([vectors, k]), capture_output=True, text=True, env=env, check=True, timeout=120)
    return json.loads(done.stdout)


def check_whiten(rows, vectors, k=4):
    want, explained = naive_whiten(vectors, k)
    by = defaultdict(list)
    for r in rows:
        by[r.component].append(r)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-6, abs=1e-12) and r.identity_error < 1e-8
    assert sorted(by) == list(range(1, len(explained) + 1))
    key = lambda row: tuple(-1 if p is None else p for p in row)
    for c, got in by.items():
        mine = sorted(((r.vec_id, r.n, r.deviation, r.whitened) for r in got), key=key)
        theirs = sorted(((i, n, far, w[c - 1]) for i, n, far, w in want), key=key)
        assert [m[:3] for m in mine] == [t[:3] for t in theirs]
        a, b = (np.array([np.nan if m[3] is None else m[3] for m in part]) for part in (mine, theirs))
        assert np.allclose(a, b, atol=1e-7, equal_nan=True) or np.allclose(a, -b, atol=1e-7, equal_nan=True)


def test_whitening_of_embeddings(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    kept = [(r.vec_id, [float(c) for c in r.embedding]) for r in vectors.collect() if r.embedding is not None]
    check_whiten(whitening.whiten(vectors, rows_per_block=64).collect(), kept)


def test_whitening_with_copies_and_many_blocks(spark):
    rng = np.random.default_rng(2)
    spread = rng.normal(size=(6, 6)) * np.array([5, 3, 2, 1, 0.5, 0.1])
    vectors = [(i, (rng.normal(size=6) @ spread).tolist()) for i in range(300)] + [(1000 + i, [1.5, -2.0, 0.0, 0.0, 1.0, 1.0]) for i in range(200)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5).withColumn("component", F.lit(9)).withColumn("x", F.lit("y"))
    check_whiten(whitening.whiten(df, rows_per_block=16).collect(), vectors)


def test_whitening_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [None, 1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [float("-inf"), 0.0]), (None, [1.0, 1.0]), (5, [4.0]), (6, []), (0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = [(0, [1.0, 2.0]), (None, [1.0, 1.0]), (5, [4.0, 0.0]), (6, [0.0, 0.0]), (0, [1.0, 2.0])]
    check_whiten(whitening.whiten(df).collect(), whole)
    assert whitening.whiten(df.where("false")).count() == 0
    assert whitening.whiten(df.where("vec_id = 6")).count() == 0
    one = whitening.whiten(df.where("vec_id = 0")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4


def test_whitening_of_huge_vectors(spark):
    df = spark.createDataFrame([(1, [3e30, 0.0]), (2, [-3e30, 1.0]), (3, [0.0, 5.0])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(df).collect()
    assert len(rows) == 6 and {r.deviation for r in rows if r.vec_id != 3} == {None}
    assert {r.deviation for r in rows if r.vec_id == 3} == {(3 * 1280 - 1536) ** 2}
