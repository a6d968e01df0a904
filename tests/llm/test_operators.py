"""The operators of the training-corpus subpackage against brute force, on small fixtures and edge cases."""

import base64
import hashlib
import math
import pathlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from veilframe.llm import ann, bpe, langid, line_dedup, minhash, packing, pitman_yor, quality_gam, quality_rules, sharding
from veilframe.llm import components as linked
from veilframe.llm.common import LOWER, Scratch, WorkerScratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, kept string, rep long, label string, k long"


def words(text):
    return (text or "").encode().split()


def low(text):
    return (text or "").encode().translate(LOWER).split()


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    rng = random.Random(1)
    prose = [" ".join(rng.choice("the of and table river stone window seven green light runs over under".split()) for _ in range(60)) for _ in range(6)]
    texts = [*prose, prose[0], prose[1] + " end", None, "", " \t\n", "one", "one", "two words", "12 34 !!", "x" * 3000, "long " * 30_000, "\n".join(prose[2:5]), "café \U0001f600 naïve 中文"]
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", "a", "b", None)[i % 4], len(t or ""), i, "x", i, None, i) for i, t in enumerate(texts)]
    rows += [(3, prose[3], "en", "a", 1, 1, "y", 2, "z", 3), (3, prose[3], "en", "a", 1, 1, "y", 2, "z", 3), (None, prose[4], None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# Line dedup.


def test_line_dedup(spark):
    a = "alpha beta gamma delta"
    long = "one two three " + " ".join(f"w{chr(97 + i)}" for i in range(12))
    other = long.replace("wc", "CHANGED")  # one segment of four differs
    far = "one two three " + " ".join(f"z{chr(97 + i)}" if i % 3 else f"w{chr(97 + i)}" for i in range(12))
    docs = [(1, f"{a}\nonly here at all"), (2, f"{a}\nsomething else entirely here"), (3, long), (4, other), (5, long.replace("wa", "p").replace("wl", "q")), (10, far), (6, "at 10:30 on 2024-01-01 ok"), (7, "at 11:45 on 2025-02-03 ok"), (8, "hi you"), (9, "hi you"), (None, a)]
    # A field in a line of nine tokens; one of five tokens may differ, of four none.
    fault = "error while opening connection to host {} port closed"
    docs += [(20, fault.format("alpha")), (21, fault.format("bravo")), (22, "red green blue cyan pink"), (23, "red green blue cyan grey"), (24, "red green blue lime"), (25, "red green blue teal"), (26, " \n\n"), (27, " \n\n")]
    got = {r["doc_id"]: (r["text"], r["a"], r["b"]) for r in line_dedup.drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string"), counts=("a", "b")).collect()}
    assert got[1][0] == docs[0][1] and got[2] == ("something else entirely here", 2, 1)
    assert got[4][0] == "" and got[5][0] == ""  # one part differs, then two
    assert got[10][0] == far  # more than two parts differ: another template
    assert got[21][0] == "" and got[23][0] == "" and got[25][0] == docs[-3][1] and got[27][0] == " \n\n"
    assert got[6][0] == docs[6][1] and got[7][0] == ""  # digits are variable fields
    assert got[8][0] == "hi you" and got[9][0] == ""  # short lines agree entirely
    assert got[None][0] == a


def test_line_dedup_edges(edge, empty):
    out = line_dedup.drop_recurring_lines(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    assert out.where("text is null").count() == edge.where("text is null").count()
    assert line_dedup.drop_recurring_lines(empty).count() == 0


# MinHash.


def components(texts: dict, width=4, percent=80):
    sets = {}
    for d, t in texts.items():
        w = low(t)
        sets[d] = frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()
    label = {d: d for d in texts}
    find = lambda x: x if label[x] == x else find(label[x])
    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and find(a) != find(b):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def copies(seed=5, n=240):
    """Bases with copies at many distances, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = {}
    for d in range(n):
        if d % 8 == 0:
            base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 12, 60, 200)))]
        text = list(base)
        for _ in range(rng.randrange(0, 1 + len(text) // 12)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        out[d] = " ".join(text)
    return out


def test_minhash_equals_brute_force(spark):
    texts = copies()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, sketch=minhash.Sketch(width=4)).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in components(texts).items()}


def test_minhash_sets_of_one_id_are_one_vertex(spark):
    rng = random.Random(2)
    a, b = (" ".join(f"{c}{rng.randrange(10**6)}" for _ in range(40)) for c in "ab")
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (9, b), (9, b), (11, "else")], "doc_id long, text string")
    got = minhash.near_duplicates(docs).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(3, 3), (5, 3), (9, 3), (11, 11)} and len(got) == 6


@pytest.mark.parametrize("block", [1024, 16])
def test_hidden_pairs_miss_nothing(spark, block):
    """Every pair of 80 percent or more is among the candidates of the prefix search, in one block or in many."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for d in range(90):
        text = list(base)
        for _ in range(rng.randrange(0, 12)):
            text[rng.randrange(120)] = f"x{rng.randrange(10_000)}"
        texts[d] = " ".join(text)
    sets = {d: {tuple(low(t)[i : i + 4]) for i in range(len(low(t)) - 3)} for d, t in texts.items()}
    rows = [(d, len(sets[d]), d, t) for d, t in texts.items()]
    members = spark.createDataFrame(rows, "v long, n long, label long, text string")
    got = {(r["a"], r["b"]) for r in minhash.hidden_pairs(members, minhash.Sketch(width=4, block=block), Scratch(spark)).collect()}
    want = {(x, y) for x in sets for y in sets if y < x and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])}
    assert want and want <= got


def test_minhash_large_mixed_buckets(spark):
    """Heavy mutations of one text: many near misses in every bucket."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for d in range(120):
        text = list(base)
        for _ in range(rng.randrange(0, 12)):
            text[rng.randrange(120)] = f"x{rng.randrange(10_000)}"
        texts[d] = " ".join(text)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, sketch=minhash.Sketch(width=4)).collect()}
    assert got == {d: c for d, (_, c) in components(texts).items()}


def test_minhash_edges(edge, empty):
    out = minhash.near_duplicates(edge).collect()
    assert len(out) == edge.count()
    by = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert by[6]["component_id"] == 0 and by[7]["component_id"] == 1 and by[12]["component_id"] == 11
    assert by[8]["n_shingles"] == by[9]["n_shingles"] == by[10]["n_shingles"] == 0 and by[9]["kept"]
    assert all(r["kept"] and r["component_id"] is None for r in out if r["doc_id"] is None)
    assert minhash.keep_one(edge).columns == edge.columns
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_long_chains(spark):
    """A chain in the order of its ids, one in mixed order, and a ring with a tail."""
    rng = random.Random(4)
    mixed = rng.sample(range(1000, 1200), 150)
    links = [*zip(range(150), range(1, 151)), *zip(mixed, mixed[1:]), *((2000 + i, 2000 + (i + 1) % 30) for i in range(30)), (2007, 1999), (5, 5)]
    df = spark.createDataFrame(links, "a long, b long").coalesce(2)
    for at_once in (0, 20, 1 << 20):
        got = {r["v"]: r["label"] for r in linked.components(df, Scratch(spark), "chains", at_once).collect()}
        assert got == dict.fromkeys(range(151), 0) | dict.fromkeys(mixed, min(mixed)) | dict.fromkeys([1999, *range(2000, 2030)], 1999)


def test_densified_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    probes = minhash.probe_table(128, 512)
    for size in (1, 5, 40, 300):
        hits = []
        for _ in range(60):
            a = np.unique(rng.integers(0, 2**63, 2 * size, dtype=np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate([a[: int(1.6 * size)], rng.integers(0, 2**63, max(1, size // 3), dtype=np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            hits.append((minhash.one_permutation(a, 128, probes) == minhash.one_permutation(b, 128, probes)).mean() - true)
        assert abs(np.mean(hits)) < 0.12


# Sharding.


def test_sharding(spark):
    rows = [(i, f"t{i % 17}", ("hot" if i % 3 else f"s{i % 5}")) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for bucket in (8, 8192):  # the result does not depend on the buckets
        out = sharding.interleave(docs, 16, rows_per_bucket=bucket).collect()
        shards = [[r for r in out if r["shard"] == k] for k in range(16)]
        assert max(map(len, shards)) - min(map(len, shards)) <= 1
        assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards)
        assert sorted(r["position"] for r in out) == list(range(1000))
        source = {i: s for i, _, s in rows}
        for name, n in Counter(source.values()).items():
            per = [sum(source[r["doc_id"]] == name for r in s) for s in shards]
            assert max(per) - min(per) <= 4 and sum(per) == n
        place = {r["doc_id"]: r["position"] for r in out}
        assert bucket == 8 or place == before
        before = place
    assert all(r["size"] == len(f"t{r['doc_id'] % 17}") + 1 and r["text_crc32"] == zlib.crc32(f"t{r['doc_id'] % 17}".encode()) for r in out)


def test_sharding_edges(edge, empty):
    out = sharding.interleave(edge, 16).collect()
    assert len(out) == edge.count() and {r["law"] for r in out} == {"rows"}
    assert sorted(r["position"] for r in out) == list(range(len(out)))
    assert sharding.interleave(empty, 16).count() == 0


# Byte-level BPE.


@pytest.fixture(scope="module")
def encoding():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(spark, edge, empty, encoding):
    path, own = encoding
    pairs = bpe.BytePairs(spark, path, public_tokenizers.PATTERN)
    out = pairs.encode(edge.select("doc_id", "text"), decoded="raw").withColumn("again", pairs.decode("ids")).collect()
    assert len(out) == edge.count()
    for r in out:
        assert r["ids"] == own.encode_ordinary(r["text"] or "")
        assert bytes(r["raw"]) == bytes(r["again"]) == (r["text"] or "").encode()
    assert pairs.encode(empty, into="tokens").count() == 0
    with pytest.raises(ValueError):
        pairs.encode(edge, into="TEXT")


def test_worker_scratch_holds_all_rows(spark):
    schema = "a long, t string, k array<long>, i int, b boolean"
    rows = [(n, None if n % 7 == 0 else "x\n" * (n % 5) + "\u00e9", None if n % 11 == 0 else [n, -n][: n % 3], n % 4, n % 2 == 0) for n in range(25_000)]
    scratch = WorkerScratch(spark)
    folder = pathlib.Path(scratch.root.removeprefix("file:").replace("///", "/"))
    got = scratch.write(spark.createDataFrame(rows, schema).repartition(3), "rows")
    (folder / "rows" / "_left.parquet").write_bytes(b"of a task that was lost")
    assert got.schema == spark.createDataFrame([], schema).schema
    assert sorted(map(tuple, got.collect())) == rows
    assert scratch.write(got.where("a < 0"), "none").collect() == []
    scratch.drop("rows")
    assert not (folder / "rows").exists()


def test_tables_of_near_duplicates_start_no_processes(spark):
    # Each checksum file beside a table tells of two processes that the local file system started from the executor.
    shared = pathlib.Path(Scratch(spark).root.removeprefix("file:").replace("///", "/")).parent
    before = set(shared.glob("*"))
    minhash.near_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    made = [p for root in set(shared.glob("*")) - before for p in root.rglob("*")]
    assert any(p.suffix == ".parquet" for p in made) and not any(p.suffix == ".crc" for p in made)


def test_steps_of_near_duplicates_hold_one_worker_a_task(spark, monkeypatch):
    # A Python step below the one that writes its table holds a second worker for each task; components join few links in one task.
    kind, plans = type(spark.range(0)), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    docs = spark.createDataFrame(list(copies().items()), "doc_id long, text string")
    minhash.near_duplicates(docs, sketch=minhash.Sketch(width=4))
    steps = [re.findall(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow", plan) for plan in plans]
    assert len(steps) > 10 and all(len(found) == 1 for found in steps)


def test_kernels_of_near_duplicates_do_not_depend_on_parts():
    s, texts = minhash.Sketch(width=4), list(copies(n=1100).values())
    docs = pa.RecordBatch.from_pydict({"id": [*range(1100)], "th": [*range(1100)], "text": texts})
    pairs = pa.RecordBatch.from_pydict({"a": [n // 3 for n in range(1100)], "b": [*range(1100)], "ta": [texts[n // 3] for n in range(1100)], "tb": texts})
    members = pa.RecordBatch.from_pydict({"v": [*range(1100)], "n": [1] * 1100, "label": [*range(1100)], "text": ["", *texts[1:]]})
    for kernel, batch in ((minhash._sketches(s), docs), (minhash._confirm(s), pairs), (minhash._shingles(s), members)):
        rows = lambda parts, f=kernel: [r for x in f(iter(parts)) for r in x.to_pylist()]
        assert rows([batch]) == rows([batch.slice(n, 1) for n in range(1100)]) and rows([batch.slice(0, 0)]) == []
        assert rows([batch])


def test_chunks_stitch_like_one_pass():
    pattern, rng = regex.compile(public_tokenizers.PATTERN), random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choice("ab 1\n\t.'s é ") for _ in range(rng.randrange(300)))
        assert bpe.pretokenise(text, pattern, rng.choice((4, 16, 40)), rng.choice((1, 3, 8))) == pattern.findall(text)
    for text in ("a" * 5000 + " " * 3000 + "b " * 100, " " * 5000, "1" * 4000):
        assert bpe.pretokenise(text, pattern, 64, 8) == pattern.findall(text)


# Nearest neighbours.


def test_ann_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(3000, 24)).astype(np.float32)
    v[100:400] = v[100]  # one frequent vector
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    settings = ann.Settings(sample=1500, parts=8, block_rows=256, block_queries=16)
    got = {}
    for r in ann.nearest(df, F.col("id") % 50 == 0, 5, settings=settings).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    x = v.astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        s = np.round(unit @ unit[q], 12)
        s[q] = -9
        best = np.lexsort((np.arange(3000), -s))[:5]
        hits += len(set(best) & {i for i, _ in got[q].values()})
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        for i, score in got[q].values():
            assert abs(score - float(x[q] @ x[i] / np.linalg.norm(x[q]) / np.linalg.norm(x[i]))) < 1e-12
    assert hits / 300 >= 0.9
    assert [got[100][k][0] for k in range(1, 6)] == [101, 102, 103, 104, 105]  # ties by id


def test_ann_extreme_lengths():
    """Squares of these components over- or underflow; the cosines do not."""
    q = np.array([[1.0, 0.0]])
    v = np.array([[1e200, 0.0], [1e-200, 0.0], [3e-310, 4e-310], [-1e300, 1e300]])
    _, ids, scores = ann.search_block(np.array([0]), q, np.arange(1, 5), v, 4)
    assert ids.tolist() == [1, 2, 3, 4] and np.allclose(scores, [1, 1, 0.6, -math.sqrt(0.5)], atol=1e-12)


def test_ann_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 2.0]), (50, [1.0, 1.0]), (8, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("id") % 50 == 0, 5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 50), (0, 2, 8), (50, 1, 0), (50, 2, 8)]
    assert ann.nearest(df.where("false"), F.col("id") % 50 == 0).count() == 0


def test_ann_repeated_ids(spark):
    """Copies of one near id, plain and scaled, take one place of the five."""
    turn = lambda a: [math.cos(a), math.sin(a)]
    for scale in (1.0, 2.0):
        rows = [(0, turn(0.0)), *((7, [x * scale**i for x in turn(0.1)]) for i in range(6)), *((i, turn(0.1 + i / 10)) for i in range(1, 7))]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = [(r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("id") == 0, 5).orderBy("rank").collect()]
        assert got == [(1, 7), (2, 1), (3, 2), (4, 3), (5, 4)]


# Language identification.


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(0)
    net = langid.Network(["a", "b", "c"], langid.Settings(hidden=3))
    for d in (net.forth, net.back):
        d.x, d.u = d.x.astype(np.float64), d.u.astype(np.float64)
    codes = rng.integers(0, 257, (5, 4)).astype(np.int16)
    target = np.array([0, 1, 2, 1])
    _, grads = net.gradients(codes, target)
    for p, g in zip(net.parameters(), grads, strict=True):
        for at in [np.unravel_index(i, p.shape) for i in np.argsort(-np.abs(g), axis=None)[:3]]:
            old, step = p[at], 1e-2
            p[at] = old + step
            up, _ = net.gradients(codes, target)
            p[at] = old - step
            down, _ = net.gradients(codes, target)
            p[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 5e-3


def test_langid_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    settings = langid.Settings(steps=200)
    out = langid.identify(df, settings=settings).join(df.select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    assert out.where("score < 0 or score > 1").count() == 0


def test_langid_edges(edge, empty):
    quick = langid.Settings(steps=3)
    by = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(edge, settings=quick).collect()}
    assert {(8, "und"), (9, "und"), (10, "und"), (14, "und"), (None, "und")} <= by
    assert langid.keep_known(edge, settings=quick).columns == edge.columns
    assert langid.identify(empty).count() == 0
    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}


# Quality classifier.


def test_quality_held_out(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet").repartition(8), spark.read.parquet(f"{base}/labels.parquet")
    out = quality_gam.classify(docs, labels, settings=quality_gam.Settings(max_rows=2000, rounds=60, pair_rounds=20)).join(labels, "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame([(i, q) for i in range(20) for q in (i % 2, None)] + [(None, 1), (3, 7)], "doc_id long, quality int")
    quick = quality_gam.Settings(rounds=3, pair_rounds=2)
    out = quality_gam.classify(edge, labels, settings=quick).collect()
    assert len(out) == edge.count() and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in quality_gam.classify(edge, labels.where("false"), settings=quick).collect()} == {0.5}
    assert quality_gam.classify(empty, labels).count() == 0


def test_pairs_explain_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.Additive().fit(x, y)
    assert model.pairs[0][:2] == (1, 0) and ((model.score(x) > 0.5) == y).mean() > 0.9


# Packing.


def test_packing(spark, edge, empty):
    lengths = packing.Lengths(permitted=(16, 32, 64))
    rng = random.Random(3)
    docs = [(i, " ".join("w" for _ in range(rng.choice((0, 1, 5, 20, 63, 64, 150))))) for i in range(500)] + [(None, "a b"), (7, None)]
    for df, n in ((spark.createDataFrame(docs, "doc_id long, text string"), len(docs)), (edge, edge.count())):
        bins = packing.best_fit(df, lengths=lengths, group_tokens=2000).collect()
        sizes = Counter((r["doc_id"], len(words(r["text"])) + 1) for r in df.select("doc_id", "text").collect())
        got = Counter()
        for b in bins:
            assert b["used"] == sum(e - s for s, e in zip(b["starts"], b["ends"])) <= b["capacity"]
            assert b["capacity"] == min(c for c in lengths.permitted if c >= b["used"]) and b["n_items"] == len(b["doc_ids"])
            got.update({(d, s): 0 for d, s in zip(b["doc_ids"], b["starts"])})
            for d, s, e in zip(b["doc_ids"], b["starts"], b["ends"]):
                got[d] += e - s
        want = Counter()
        for (d, size), k in sizes.items():
            want[d] += size * k
        assert {d: got[d] for d in want} == dict(want) and sum(sizes.values()) == n
    assert packing.best_fit(empty).count() == 0


def test_packing_against_brute_force():
    """Small sets: never above best fit with any one length, and close to the cheapest of all partitions."""
    rng, lengths = random.Random(5), packing.Lengths(permitted=(8, 16, 32), fixed=2.0)

    def cheapest(sizes):
        best = math.inf

        def place(k, bins):
            nonlocal best
            if k == len(sizes):
                best = min(best, sum(lengths.cost(lengths.holding(b)) for b in bins))
                return
            for i in range(len(bins)):
                if bins[i] + sizes[k] <= 32:
                    place(k + 1, [*bins[:i], bins[i] + sizes[k], *bins[i + 1 :]])
            place(k + 1, [*bins, sizes[k]])

        place(0, [])
        return best

    lost = []
    for _ in range(60):
        sizes = sorted((rng.randrange(1, 33) for _ in range(7)), reverse=True)
        cost = sum(lengths.cost(c) for c, _ in packing.pack(sizes, lengths))
        for c in lengths.permitted:
            assert cost <= sum(lengths.cost(lengths.holding(sum(sizes[i] for i in b))) for b in packing.fill(sizes, lengths, (c,))) + 1e-9
        lost.append(cost / cheapest(sizes))
    assert min(lost) >= 1 - 1e-9 and np.mean(lost) < 1.02


def test_packing_opens_several_lengths():
    sizes = np.sort(np.clip((np.random.default_rng(1).pareto(1.1, 2500) * 150 + 20).astype(int), 1, 8192))[::-1]
    lengths = packing.Lengths()
    cost = lambda opening: sum(lengths.cost(lengths.holding(int(sizes[b].sum()))) for b in packing.fill(sizes, lengths, opening))
    assert cost(None) < min(cost((c,)) for c in lengths.permitted)
    assert len({c for c, _ in packing.pack(sizes, lengths)}) >= 3


def test_packing_is_near_the_bound():
    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 700) for _ in range(2000)), reverse=True)
    bins = packing.pack(sizes, packing.Lengths(permitted=(256, 512, 1024)))
    assert sum(sizes) / sum(c for c, _ in bins) > 0.98
    assert sorted(i for _, items in bins for i in items) == list(range(2000))


# Language-model scoring.


def reference_scores(texts: dict, s: pitman_yor.Settings):
    """The model told plainly: one process, dictionaries, the same random numbers."""
    from veilframe.llm.minhash import WordHashes, mix

    hashes, end = WordHashes(), pitman_yor.END_WORD
    tokens = {d: [*low(t), end] for d, t in texts.items()}
    learn = {d for d in texts if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2}
    count = Counter(w for d in learn for w in tokens[d])
    total, types = sum(count.values()), len(count)
    pairs = Counter()
    for d in learn:
        for u, w in zip(["START", *tokens[d]], tokens[d]):
            pairs[u, w] += 1
    code = lambda w: np.array([hashes[pitman_yor.START_WORD if w == "START" else w]], np.uint64)
    estimate = lambda values: float(np.clip(sum(v == 1 for v in values) / max(sum(v == 1 for v in values) + 2 * sum(v == 2 for v in values), 1), 0.3, 0.95))
    d1, d2 = estimate(count.values()), estimate(pairs.values())
    floor = 1 / (types + 1)
    key = {p: pitman_yor.pair_key(code(p[0]), code(p[1])) for p in pairs}
    t = dict.fromkeys(pairs, 1)
    cw = Counter(w for _, w in pairs)
    tw = {w: 1 for w in cw}
    samples = []
    tables = lambda: Counter({u: 0 for u, _ in pairs})
    tu = tables()
    for (u, _), n in t.items():
        tu[u] += n
    parent = lambda w: (cw.get(w, 0) - d1 * tw.get(w, 0) + (s.base_strength + d1 * sum(tw.values())) * floor) / (s.base_strength + sum(cw.values()))
    for sweep in range(1, s.sweeps + 1):
        new = {p: int(pitman_yor.seat(np.array([n]), np.array([(s.strength + d2 * tu[p[0]]) * parent(p[1])]), d2, key[p], sweep)[0]) for p, n in pairs.items()}
        weight = (s.base_strength + d1 * sum(tw.values())) * floor
        cw, tu = Counter(), tables()
        for (u, w), n in new.items():
            cw[w] += n
            tu[u] += n
        tw = {w: int(pitman_yor.seat(np.array([n]), np.array([weight]), d1, mix(np.array([hashes[w]], np.uint64) + np.uint64(5)), sweep)[0]) for w, n in cw.items()}
        t = new
        if sweep > s.sweeps - s.averaged:
            samples.append((dict(t), Counter(tu), dict(cw), dict(tw)))
    followed = Counter()
    for (u, _), n in pairs.items():
        followed[u] += n

    def probability(u, w):
        p = 0.0
        for st, su, sc, sw in samples:
            up = (sc.get(w, 0) - d1 * sw.get(w, 0) + (s.base_strength + d1 * sum(sw.values())) * floor) / (s.base_strength + sum(sc.values()))
            p += (pairs[u, w] - d2 * st.get((u, w), 0) + (s.strength + d2 * su[u]) * up) / (s.strength + followed[u])
        return p / s.averaged

    return count, total, types, {d: sum(math.log10(probability(u, w)) for u, w in zip(["START", *tokens[d]], tokens[d])) for d in texts}, probability


def test_pitman_yor_equals_the_plain_model(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = {d: " ".join(vocabulary[min(59, int(rng.expovariate(0.12)))] for _ in range(rng.randrange(0, 60))) for d in range(150)}
    texts[150] = None
    s = pitman_yor.Settings()
    count, total, types, score, probability = reference_scores(texts, s)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    # Also with frequent pairs scored at once, and with most or nearly all words owned by the part of their hash.
    for settings in (s, pitman_yor.Settings(hot=40, flush_tokens=300), pitman_yor.Settings(resident=20, flush_tokens=300), pitman_yor.Settings(resident=1)):
        got = {r["doc_id"]: r for r in pitman_yor.language_model_scores(docs, settings=settings).collect()}
        assert len(got) == len(texts)
        for d, text in texts.items():
            own, r = [*low(text), b"\n"], got[d]
            assert r["held_out"] == (zlib.crc32(str(d).encode()) % 7 == 2) and r["train_tokens"] == total
            assert (r["n_tokens"], r["n_known"]) == (len(own), sum(count[w] > 0 for w in own))
            assert math.isclose(r["base_score"], sum(math.log10((count[w] + 1) / (total + types + 1)) for w in own), rel_tol=1e-9)
            assert abs(r["score"] - score[d]) < 1e-4 + 1e-5 * len(own)
    for u in ("START", b"w0", b"w30"):  # probabilities of all words and one unknown sum to one
        assert abs(sum(probability(u, w) for w in [*count, b"unknown"]) - 1) < 1e-9


def test_pitman_yor_rare_words(spark):
    """Where a word's restaurant lives changes no score: also of unseen words and pairs."""
    texts = {d: " ".join(f"w{(d * 7 + i * i) % (30 + d)}" for i in range(40)) + f" only{d} twice{d // 2} twice{d // 2 + 1}" for d in range(80)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    all_ = {r["doc_id"]: r for r in pitman_yor.language_model_scores(docs).collect()}
    for resident in (1, 10, 60):
        few = {r["doc_id"]: r for r in pitman_yor.language_model_scores(docs, settings=pitman_yor.Settings(resident=resident, flush_tokens=500)).collect()}
        assert len(few) == len(texts)
        for d in texts:
            assert few[d]["n_known"] == all_[d]["n_known"] and math.isclose(few[d]["base_score"], all_[d]["base_score"], rel_tol=1e-9)
            assert abs(few[d]["score"] - all_[d]["score"]) < 1e-3
    plain = spark.createDataFrame([(d, text.split(" only")[0]) for d, text in texts.items()], "doc_id long, text string")
    few = [r for r in pitman_yor.language_model_scores(plain, settings=pitman_yor.Settings(resident=10)).collect() if r["held_out"]]
    assert sum(r["score"] for r in few) > sum(r["base_score"] for r in few)


def test_pitman_yor_edges(edge, empty):
    out = pitman_yor.language_model_scores(edge).collect()
    assert len(out) == edge.count() and all(r["score"] <= 0 and r["n_tokens"] >= 1 for r in out)
    assert pitman_yor.language_model_scores(empty).count() == 0


# Quality rules.


def test_rules_equal_brute_force(edge, empty):
    import zstandard

    out = edge.select("text", quality_rules.quality_measures("text").alias("q")).select("text", "q.*").collect()
    assert len(out) == edge.count()
    for r in out:
        text, w = r["text"] or "", words(r["text"])
        marked, windows = set(), [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        n = Counter(windows)
        for i, x in enumerate(windows):
            if n[x] > 1:
                marked.update(range(i, i + 5))
        lines = [x for x in text.split("\n") if words(x)]
        assert r["n_words"] == len(w) and r["n_repeat_words"] == len(marked) and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["word_chars"] == sum(len(x.decode()) for x in w) and r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert r["base_failed"] == (len(w) < 10 or 100 * len(marked) > 20 * len(w)) and (not r["kept"] or not r["base_failed"])
        if text:
            raw = text.encode()
            assert r["whole_ratio"] == len(raw) / len(zstandard.ZstdCompressor(level=3).compress(raw))
    assert quality_rules.keep_good(edge).columns == edge.columns
    assert quality_rules.quality_rules(empty).count() == 0


def test_bands_reject_both_ends():
    import zstandard

    rng, c, bands = random.Random(0), zstandard.ZstdCompressor(level=3), quality_rules.Bands()
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(8)) for _ in range(400))
    repetitive = " ".join(f"{a} {b}" for a in range(40) for b in range(40))
    assert quality_rules.measure(noise, bands, c)[-2] in ("incompressible", "chunks")
    assert quality_rules.measure(repetitive, bands, c)[-2] == "repetitive"


def test_chunks_reach_the_end():
    import zstandard

    rng, c, bands = random.Random(2), zstandard.ZstdCompressor(level=3), quality_rules.Bands()
    prose = " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 8))) for _ in range(3000))[: bands.chunk_bytes]
    head, tail = prose, " ".join(["again and"] * 500)[: bands.chunk_bytes - 1]
    at = quality_rules.COLUMNS.index("chunks")
    assert quality_rules.measure(head, bands, c)[at : at + 2] == (1, 0)
    assert quality_rules.measure(head + tail, bands, c)[at : at + 2] == (2, 1)


def test_digest_columns(spark, encoding):
    from veilframe.llm.queries import queries

    path, own = encoding
    rows = queries()["op4_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        ids = own.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
