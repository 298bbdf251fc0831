import json
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, nothing, texts
from pyspark.sql import functions as F
from test_text_ops import LOW, WORD

from quillon.llm import chat_format, components, frames, secret_scan, sharding, simhash

def test_hash_sample(spark):
    df = spark.range(20_000).withColumn("x", F.col("id") % 7)
    one, two = (sorted(r["id"] for r in frames.hash_sample(d, ["id", "x"], 500).collect()) for d in (df, df.repartition(13)))
    assert one == two and len(one) == 500
    assert frames.hash_sample(df.limit(10), ["id"], 500).count() == 10
    assert frames.hash_sample(df.limit(0), ["id"], 500).count() == 0


# --- components -------------------------------------------------------------


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (200, 100)]
    out = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 200: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- SimHash ----------------------------------------------------------------


def fingerprint(t, k):
    w = [x.translate(LOW) for x in WORD.findall(t or "")]
    if not w:
        return 0
    h = np.array([xxhash.xxh64_intdigest(" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))


def linked(prints, limit):
    names = sorted(prints)
    comp = {i: i for i in names}
    changed = True
    while changed:
        changed = False
        for a in names:
            for b in names:
                if bin(prints[a] ^ prints[b]).count("1") <= limit and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return comp


@pytest.mark.parametrize("tile_rows", [8192, 2])
def test_simhash_contract(spark, tile_rows):
    rows = texts()
    prints = {i: fingerprint(t, 3) for i, t in enumerate(rows)}
    comp = linked(prints, 3)
    out = simhash.near_duplicates(documents(spark), words=3, lanes=1, limit=3, tile_rows=tile_rows).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out} == {i: (f"{p:016x}", comp[i]) for i, p in prints.items()}


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6), st.lists(st.tuples(st.integers(0, 5), st.lists(st.integers(0, 63), max_size=4)), max_size=30))
@settings(max_examples=60, deadline=None)
def test_pivots_lose_nothing(seeds, flips):
    prints = list(dict.fromkeys(seeds + [seeds[i % len(seeds)] ^ sum(1 << b for b in set(bits)) for i, bits in flips]))
    fp = np.array(prints, np.uint64)[:, None]
    up = simhash.close_forest(fp, 3)
    want = linked(dict(enumerate(prints)), 3)
    find = lambda i: i if up[i] == i else find(up[i])
    roots = [find(i) for i in range(len(prints))]
    assert all((roots[i] == roots[j]) == (want[i] == want[j]) for i in range(len(prints)) for j in range(len(prints)))
    keys = simhash.block_keys(fp[:, 0], 5, 2)
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                assert (keys[i] == keys[j]).any()


def test_near_dedup_similarity(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(3000)]
    rows, want = [], []
    for k in range(40):
        base = list(rng.choice(words, 200))
        near = list(base)
        for p in rng.choice(200, 2, replace=False):  # ten of 196 shingles: similarity of 0.9 and more
            near[p] = "changed"
        rows += [" ".join(base), " ".join(near), " ".join(rng.choice(words, 200))]
        want += [3 * k, 3 * k, 3 * k + 2]
    out = simhash.near_duplicates(documents(spark, rows)).collect()
    assert [r["component_id"] for r in sorted(out, key=lambda r: r["doc_id"])] == want
    kept = simhash.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def similar_pages():
    """Pages that share a tail less or a template: pairs at similarities of 0.5-0.79 and 0.80-0.85, short texts, a template at 0.6."""
    rng = np.random.default_rng(4)
    fresh = iter(f"n{i}" for i in range(10**6))
    some = lambda n: [next(fresh) for _ in range(n)]
    rows = []
    for m in [*range(16, 22), *range(22, 66, 3)] * 2:  # (196 - m) / (196 + m)
        base = some(200)
        rows += [base, base[: 200 - m] + some(m)]
    for n, m in [(14, 1), (15, 1), (12, 1), (24, 2), (24, 3), (5, 1), (4, 0), (3, 1)]:  # the first, second, fourth: 9/11, 10/12, 18/22
        base = some(n)
        rows += [base, base[: n - m] + some(m)]
    template = some(154)
    rows += [template + some(50) for _ in range(60)]
    return [" ".join(rows[i]) for i in rng.permutation(len(rows))]


@pytest.mark.parametrize("tile_rows", [8192, 2])
def test_near_dedup_is_exact(spark, tile_rows):
    rows = similar_pages()
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in map(str.split, rows)]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9 and comp[i] != comp[j]:
                old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                comp = [new if c == old else c for c in comp]
    assert 12 < sum(c != i for i, c in enumerate(comp)) < 20
    out = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(spark, rows), tile_rows=tile_rows).collect()}
    assert out == dict(enumerate(comp))


@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=1, max_size=12), st.sampled_from([0.3, 0.5, 0.8]))
@settings(max_examples=100, deadline=None)
def test_similar_forest(sets, similarity):
    flat = np.array([x for s in sets for x in sorted(s)], np.int64)
    up = simhash.similar_forest(flat, np.array([len(s) for s in sets]), similarity)
    comp = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    assert all((up[i] == up[j]) == (comp[i] == comp[j]) for i in range(len(sets)) for j in range(len(sets)))


def test_near_dedup_edges(spark):
    df = spark.createDataFrame([(3, "a b c"), (None, "a b c"), (None, None), (5, ""), (6, None), (3, "a b c"), (7, "A  b\nC")], "doc_id long, text string")
    out = sorted(((r["doc_id"] or -1), r["component_id"]) for r in simhash.near_duplicates(df, 3, 1, 3).collect())
    assert out == [(-1, 3), (-1, 5), (3, 3), (3, 3), (5, 5), (6, 5), (7, 3)]
    assert sorted((r["doc_id"] or -1) for r in simhash.keep_one(df).collect()) == [3, 5]
    assert simhash.near_duplicates(nothing(spark)).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(df, 3, 1, 4)


def test_null_ids_link_others(spark):
    """A row without an id links the two documents on either side of it; alone, rows without ids still leave one."""
    words = [f"w{i}" for i in range(60)]
    chain = [" ".join(words[:k] + ["x"] * 3 + words[k + 3 :]) for k in (0, 3)]  # each close to the middle one only
    df = spark.createDataFrame([(9, chain[0]), (None, " ".join(words)), (4, chain[1]), (None, "other words altogether here now"), (None, "other words altogether here now"), (8, "p q"), (8, "r s")], "doc_id long, text string")
    out = simhash.near_duplicates(df, similarity=0.75).collect()
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in out)
    assert got == [(0, 0), (0, 0), (0, 4), (4, 4), (8, 8), (8, 8), (9, 4)]
    kept = simhash.keep_one(df, similarity=0.75).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(4, chain[1]), (0, "other words altogether here now"), (8, "p q"), (8, "r s")])


def test_large_groups_meet_in_two_rounds(spark):
    """Buckets of many tiles: every link between different texts is found, in a large group and beside it."""
    rng = np.random.default_rng(12)
    base = int(rng.integers(0, 2**62))
    prints = {base ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(150)} | {base}
    prints |= {p ^ (1 << 5) ^ (1 << 9) for p in list(prints)[:4]} | {int(x) for x in rng.integers(0, 2**62, 30)}
    prints = sorted(prints)
    fp = np.array(prints, np.uint64)
    keys = simhash.block_keys(fp, 5, 2)
    signed = lambda x: [int(v) for v in x.view(np.int64)]
    nodes = spark.createDataFrame([(i, signed(fp[i : i + 1]), signed(keys[i])) for i in range(len(fp))], "node long, fp array<long>, keys array<long>").repartition(3)
    want = linked(dict(enumerate(prints)), 3)
    for tile_rows in (8192, 8):
        comp = {r["node"]: r["component"] for r in components.components(simhash.links(nodes, 3, tile_rows)).collect()}
        assert {i: comp.get(i, i) for i in range(len(fp))} == want


# --- sharding ---------------------------------------------------------------


@pytest.mark.parametrize("shards", [1, 4, 24])
def test_sharding(spark, shards):
    rng = np.random.default_rng(1)
    rows = texts() + [" ".join(["pad"] * int(n)) + f" {i}" for i, n in enumerate(rng.integers(1, 200, 1500))]
    out = sharding.shard_documents(documents(spark, rows), shards).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in out} == {(i, size(t), zlib.crc32((t or "").encode())) for i, t in enumerate(rows)}
    total, groups, slots = [0] * shards, {}, [[] for _ in range(shards)]
    for r in out:
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert groups.setdefault(rows[r["doc_id"]] or "", r["shard"]) == r["shard"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max(map(size, rows))
    assert max(total) - min(total) <= 2.5 * largest


def split(cells, shards):
    """A k-d tree by recursion over (source, lang, chars, hash, fine, bytes): shard of each cell."""
    if shards == 1:
        return {c: 0 for c in cells}
    spans = [max(c[d] for c in cells) - min(c[d] for c in cells) for d in range(3)]
    d = spans.index(max(spans)) if max(spans) else 3
    total, left = sum(c[5] for c in cells), shards // 2
    goal, before = total * left / shards, 0
    for value in sorted({c[d] for c in cells}):
        here = [c for c in cells if c[d] == value]
        if before + sum(c[5] for c in here) > goal or value == max(c[d] for c in cells):
            break
        before += sum(c[5] for c in here)
    for fine in sorted({c[4] for c in here}):
        weight = sum(c[5] for c in here if c[4] == fine)
        if before + weight > goal or fine == max(c[4] for c in here):
            break
        before += weight
    fine += goal - before > weight / 2
    low = [c for c in cells if c[d] < value or c[d] == value and c[4] < fine]
    high = [c for c in cells if c not in low]
    return (split(low, left) if low else {}) | {c: left + s for c, s in (split(high, shards - left) if high else {}).items()}


@pytest.mark.parametrize("shards", [2, 5, 8])
def test_cuts_by_recursion(spark, shards):
    rng = np.random.default_rng(shards)
    cells = {tuple(int(x) for x in (rng.integers(0, 200), rng.integers(0, 3) * 90, rng.integers(0, 250), f >> 4, f)): int(rng.integers(1, 500)) for f in rng.integers(0, 4096, 300)}
    rows = [(*c, w) for c, w in cells.items()]
    df = spark.createDataFrame(rows, "source int, lang int, chars int, hash int, fine int, bytes long").repartition(3)
    got = {tuple(r)[:6]: r["shard"] for r in sharding.grow(df, shards).select("source", "lang", "chars", "hash", "fine", "bytes", "shard").collect()}
    assert got == split(rows, shards)


def test_sharding_is_native(spark):
    out = sharding.shard_documents(documents(spark), 4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 20)
    df = spark.range(300).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('t ', id % 150) AS text", "'s' AS source").repartition(4)
    out = sharding.shard_documents(df, 3).collect()
    for shard in range(3):
        mine = [r["slot"] for r in out if r["shard"] == shard]
        assert sorted(mine) == list(range(len(mine))) and len(mine) > 80


def test_sharding_large_group(spark):
    rows = ["big group"] * 400 + [f"text {i}" for i in range(600)]
    out = sharding.shard_documents(documents(spark, rows, extra=False), 6).collect()
    of = {r["doc_id"]: r["shard"] for r in out}
    assert len({of[i] for i in range(400)}) == 1 and of[0] not in {of[i] for i in range(400, 1000)}
    rest = [sum(s == of_shard for s in list(of.values())) for of_shard in range(6) if of_shard != of[0]]
    assert max(rest) - min(rest) <= 12
    assert sharding.shard_documents(nothing(spark)).count() == 0
    bare = spark.createDataFrame([(None, None), (None, "x"), (1, "x")], "doc_id long, text string")
    assert sharding.shard_documents(bare, 3).count() == 3


# --- secrets ----------------------------------------------------------------


@pytest.fixture(scope="module")
def corpus(spark):
    return secret_scan.learn_corpus(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


@pytest.fixture(scope="module")
def model(spark, corpus):
    return secret_scan.train(secret_scan.seed_findings(spark, secret_scan.frequent(corpus), 3000), corpus)


def test_secret_corpus(spark):
    """Dictionary and transitions by hand; an empty corpus has neither."""
    rows = ["Abc abc xyz", "abc, qq xyzz", "abc\nXYZ", None, "xyz1 abcdefghijklmnopqrs"]
    made = secret_scan.learn_corpus(documents(spark, rows), least_docs=2)
    assert {r["word"]: r["n_docs"] for r in made.words.collect()} == {"abc": 3, "xyz": 3}
    counts = {p: 1 for p in [(a, b) for a in range(26) for b in range(26)]}
    for word in ("abc", "xyz"):
        for a, b in zip(word, word[1:]):
            counts[ord(a) - 97, ord(b) - 97] += 3
    for (a, b), n in counts.items():
        total = sum(counts[a, c] for c in range(26))
        assert abs(made.transitions[26 * a + b] - np.log(n / total)) < 1e-12
    empty = secret_scan.learn_corpus(nothing(spark))
    assert empty.words.count() == 0 and len(set(empty.transitions)) == 1


def test_secret_features(spark, corpus):
    """Coverage, likeness and context by hand."""
    words = {r["word"] for r in corpus.words.collect()}
    a, b = sorted(w for w in words if len(w) > 4)[:2]
    rows = [(0, f"{a}_{b}-1234", "x y key", "zz"), (1, "Q7" * 10, "so token =", ""), (2, f"{a}{b.title()}99", f"a b{a}", "k")]
    found = spark.createDataFrame([(i, c, f'"{c}"', p, q) for i, c, p, q in rows], "row long, core string, word string, before string, after string")
    weights = spark.createDataFrame([("b:token", 2.0), ("b:key", 0.5), ("a:zz", -0.25)], "neighbour string, weight double")
    got = {r["row"]: r for r in secret_scan.with_features(found, corpus, weights).collect()}
    for i, c, *_ in rows:
        low = c.lower()
        pairs = [(x, y) for x, y in zip(low, low[1:]) if "a" <= x <= "z" and "a" <= y <= "z"]
        likeness = [corpus.transitions[26 * (ord(x) - 97) + ord(y) - 97] for x, y in pairs]
        assert abs(got[i]["likeness"] - (np.mean(likeness) if likeness else -np.log(26))) < 1e-9
        assert got[i]["length"] == len(c) and got[i]["digits"] == sum(x.isdigit() for x in c) / len(c) and got[i]["quoted"] == 1
    assert [round(got[i]["context"], 6) for i in range(3)] == [0.25, 2.0, 0.0]
    assert got[0]["coverage"] == (len(a) + len(b)) / len(rows[0][1]) and got[1]["coverage"] == 0
    assert got[2]["coverage"] == (len(a) + len(b)) / len(rows[2][1])


def test_secret_held_out(spark, corpus, model):
    """Findings of other ids than the training's, by kind."""
    seeds = secret_scan.seed_findings(spark, secret_scan.frequent(corpus), 4000).withColumn("row", F.monotonically_increasing_id())
    held = seeds.exceptAll(seeds.limit(0)).filter("row % 1000000000 >= 0").join(secret_scan.seed_findings(spark, secret_scan.frequent(corpus), 3000).select("core"), "core", "left_anti")
    right = (F.col("score") >= 0.5).cast("int") == F.col("label")
    by = {r["kind"]: r["right"] for r in secret_scan.score(held, model).groupBy("kind").agg(F.avg(right.cast("double")).alias("right")).collect()}
    assert len(by) >= 10 and min(by.values()) >= 0.9, by


def test_secret_scan(spark, model):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    rows = texts() + [f'so token = "{key}" then', f"commit {key} by me", "card 9807915762804490 here", f"a=1;api_key={key[::-1]};b", "path /usr/share/lib/python3/module_2 x", f'TOKEN = "{key.upper()}"!!', None, 'password = "hT7bq!4f9c" ok', "the short word hT7bq4f9 alone"]
    n = len(texts())
    out = secret_scan.scan(documents(spark, rows), model).collect()
    by = {}
    for r in out:
        by[r["doc_id"]] = by.get(r["doc_id"], False) or r["is_secret"]
    assert {d: s for d, s in by.items() if d >= n} == {n: True, n + 1: False, n + 2: False, n + 3: True, n + 4: False, n + 5: True, n + 7: True}
    assert not any(r["is_secret"] for r in out if r["doc_id"] < n)
    at = next(r for r in out if r["doc_id"] == n)
    assert (at["word_at"], at["nth"], at["length"]) == (3, 0, 40)
    assert secret_scan.scan(nothing(spark), model).count() == 0


def test_secret_scan_is_native(spark, model):
    found = secret_scan.candidates(documents(spark)).withColumn("row", F.monotonically_increasing_id())
    for df in (found, secret_scan.scan(documents(spark), model), model.corpus.words):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_secret_labels_of_one_kind(spark, corpus):
    seeds = secret_scan.seed_findings(spark, [], 200)
    for labelled, score, secret in ((seeds.limit(0), None, True), (seeds.filter("label = 1"), 1.0, True), (seeds.filter("label = 0"), 0.0, False)):
        made = secret_scan.train(labelled, corpus)
        out = secret_scan.scan(documents(spark, ["card 9807915762804490 here"]), made).collect()
        assert [(r["score"], r["is_secret"]) for r in out] == [(score, secret)]


# --- chat -------------------------------------------------------------------

SCHEMAS = {"add": {"type": "object", "properties": {"x": {"type": "integer"}, "y": {"type": "number", "maximum": 10}, "tags": {"type": "array", "items": {"type": "string"}}}, "required": ["x"], "additionalProperties": False}}


def messages(spark):
    call = lambda i, args, after=(), name="add": "<tool_call>" + json.dumps({"id": i, "name": name, "arguments": args, "after": list(after)}) + "</tool_call>"
    result = lambda i, c: "<tool_result>" + json.dumps({"id": i, "content": c}) + "</tool_result>"
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", call("b", {"x": 1, "y": 2.0}, ["a"]) + " and " + call("a", {"y": 11})),
        (1, 2, "tool", result("a", {"z": 1, "b": [2.50]}) + result("orphan", 1)),
        (1, 3, "tool", result("b", None)),
        (1, 4, "assistant", call("b", {"x": 1})),
        (2, 0, "tool", result("e", 1)),
        (2, 1, "assistant", call("e", {"x": 1, "q": 1}) + "<tool_call>{broken</tool_call>" + call("c1", {"x": 1}, ["c2"]) + call("c2", {"x": "s"}, ["c1"], "nope")),
        (None, 1, "assistant", call("n", {"x": 1})),
        (3, 0, None, None),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("status", F.lit("own"))


def test_chat(spark):
    linked = chat_format.link(*chat_format.parse(messages(spark)), SCHEMAS)
    got = {(r["conv_id"], r["call_id"], r["turn"], r["result_turn"]): (r["status"], r["level"], r["errors"]) for r in linked.collect()}
    assert got == {
        (1, "a", 1, 2): ("linked", 0, ["$.x: missing", "$.y: above maximum"]),
        (1, "b", 1, 3): ("linked", 1, []),
        (1, "b", 4, None): ("repeated", None, []),
        (1, "orphan", None, 2): ("orphan", None, []),
        (2, "e", 1, 0): ("early", 0, ["$.q: unknown"]),
        (2, "c1", 1, None): ("unanswered", None, []),
        (2, "c2", 1, None): ("unanswered", None, ["unknown tool"]),
        (None, "n", 1, None): ("unanswered", None, []),
    }
    text = {r["call_id"]: r["canonical_json"] for r in linked.filter("conv_id = 1 AND status = 'linked'").collect()}
    assert text["a"] == '{"arguments":{"y":11},"id":"a","name":"add","result":{"b":[2.5],"z":1},"status":"linked","valid":false}'
    assert [r["call_id"] for r in chat_format.in_order(linked.filter("conv_id = 1 AND level IS NOT NULL")).collect()] == ["a", "b"]
    none = chat_format.link(*chat_format.parse(messages(spark).limit(0)), SCHEMAS)
    assert none.count() == 0


def test_chat_ties(spark):
    """Rows at one place, equal or not: one counts, the others are repeated; nothing is multiplied."""
    calls = [(1, 5, 0, "a", "add", '{"x":2}', [])] * 3 + [(1, 5, 0, "a", "add", '{"x":1}', [])] * 2 + [(1, 9, 0, "a", "add", "{}", [])]
    results = [(1, 6, 0, "a", "1")] * 4 + [(1, 6, 0, "a", "0")]
    c, r = spark.createDataFrame(calls, chat_format.CALLS).repartition(3), spark.createDataFrame(results, chat_format.RESULTS).repartition(2)
    out = chat_format.link(c, r, SCHEMAS).collect()
    assert sorted(x["status"] for x in out) == ["linked"] + ["repeated"] * 9
    first = next(x for x in out if x["status"] == "linked")
    assert json.loads(first["canonical_json"]) == {"arguments": {"x": 1}, "id": "a", "name": "add", "result": 0, "status": "linked", "valid": True}


def level_reference(graph):
    known = {a: {b for b in after if b in graph} for a, after in graph.items()}
    out = {}
    while True:
        new = {a: max((out[b] + 1 for b in after), default=0) for a, after in known.items() if a not in out and all(b in out for b in after)}
        if not new:
            return out
        out |= new


def test_levels_brute_force(spark):
    """Chains, diamonds, ladders, cycles and what stands behind them, of several conversations; by one task or by joins."""
    rng = np.random.default_rng(1)
    graphs = {1: {f"c{i}": [f"c{i - 1}"] for i in range(70)}, 5: {"x": [], "y": ["x", "x"], "z": ["y", None]}}
    graphs[2] = {f"c{i}": [f"c{i - 1}", f"c{i - 2}"] for i in range(5)} | {f"d{i}": [f"d{(i + 1) % 5}"] for i in range(5)} | {"e": ["d0"], "f": ["e", "c3"], "g": ["g"]}
    graphs[3] = {f"n{i}": [f"n{j}" for j in rng.choice(max(i, 1), min(i, int(rng.integers(0, 3))), replace=False)] for i in range(25)}
    graphs[4] = {f"n{i}": [f"n{j}" for j in rng.choice(25, int(rng.integers(0, 2)), replace=False)] + ["unknown"] for i in range(25)}
    rows = [(conv, 0, 0, call, "t", "{}", after) for conv, graph in graphs.items() for call, after in graph.items()]
    df = spark.createDataFrame(rows, chat_format.CALLS).repartition(3)
    want = {(conv, call): level for conv, graph in graphs.items() for call, level in level_reference(graph).items()}
    for group_rows in (50_000, 60):
        got = {(r["conv_id"], r["call_id"]): r["level"] for r in chat_format.levels(df, group_rows).collect()}
        assert got == want


def test_chat_awkward_json(spark):
    """Deep nesting, lone surrogates, huge integers, not-a-number: each row comes back, none stops the job."""
    deep = "[" * 50_000 + "]" * 50_000
    arguments = ['{"x": ' + "9" * 400 + "}", '{"x": ' + "9" * 5000 + "}", '{"x": 1, "tags": ["\\ud800"]}', '{"x": ' + deep + "}", deep, "", None, '{"x": NaN}', '{"x": 1e999}', '{"x": 1.0}', '{"x": true}']
    calls = [(1, i, 0, f"i{i}", "add", a, []) for i, a in enumerate(arguments)]
    results = [(1, i, 1, f"i{i}", a) for i, a in enumerate(arguments)]
    out = {r["turn"]: r for r in chat_format.link(spark.createDataFrame(calls, chat_format.CALLS), spark.createDataFrame(results, chat_format.RESULTS), SCHEMAS).collect()}
    wrong = ["$: not object"]
    assert [out[i]["errors"] for i in range(len(arguments))] == [[], wrong, [], wrong, wrong, wrong, wrong, ["$.x: not integer"], ["$.x: not integer"], [], ["$.x: not integer"]]
    assert '"tags":["\\ud800"]' in out[2]["canonical_json"] and json.loads(out[0]["canonical_json"])["arguments"]["x"] == int("9" * 400)
    marked = [(1, i, "assistant", f'<tool_call>{{"id": "\\ud800{i}", "arguments": {a}, "after": 7, "name": ["n"]}}</tool_call>') for i, a in enumerate(["{}", deep, '{"a": "\\udfff"}'])]
    parsed = chat_format.parse(spark.createDataFrame(marked, "conv_id long, turn long, role string, text string"))[0].collect()
    assert sorted((r["call_id"], r["name"], r["arguments"]) for r in parsed) == [("\\ud8000", '["n"]', "{}"), ("\\ud8002", '["n"]', '{"a":"\\udfff"}')]


def test_schema_keywords(spark):
    with pytest.raises(ValueError, match="pattern"):
        chat_format.link(*chat_format.parse(messages(spark)), {"add": {"properties": {"x": {"pattern": "a"}}}})
    with pytest.raises(ValueError, match="not a type"):
        chat_format.check_schema({"type": ["string", "text"]})
    assert chat_format.violations(None, {"type": ["string", "null"]}) == []
    assert chat_format.violations(2, {"type": ["string", "null"]}) == ["$: not string or null"]
    assert chat_format.violations(True, {"enum": [1]}) == ["$: not in enum"] and chat_format.violations(1.0, {"enum": [1]}) == []
    assert chat_format.violations({"a": "x"}, {"additionalProperties": {"type": "integer"}}) == ["$.a: not integer"]


def test_violations():
    s = {"type": "object", "properties": {"a": {"type": "array", "items": {"enum": [1, 2]}}, "b": {"type": "boolean"}, "c": {"type": "string", "minLength": 2}}}
    assert chat_format.violations({"a": [1, 3], "b": 1, "c": "x"}, s) == ["$.a[1]: not in enum", "$.b: not boolean", "$.c: length"]
    assert chat_format.violations(True, {"type": "integer"}) == ["$: not integer"]
    assert chat_format.canonical({"b": float("nan"), "a": 1.0, "é": [float("inf")]}) == '{"a":1,"b":null,"é":[null]}'


def test_similar_forest_uses_fingerprints():
    """Pairs of similar sets keep to the limit, also small ones; sets whose fingerprints are far apart are not counted."""
    rng = np.random.default_rng(7)
    limit = simhash.similarity_limit(0.8, 4)
    sets, pairs = [], [(4, 1, 0), (5, 1, 0), (8, 1, 1), (9, 1, 1), (16, 2, 2), (40, 10, 0), (200, 25, 25)]
    for shared, a, b in pairs * 60:  # shared members, and those of one side only
        h = rng.integers(0, 2**64, shared + a + b, dtype=np.uint64)
        sets += [h[: shared + a], np.concatenate((h[:shared], h[shared + a :]))]
    sizes, flat = np.array([len(x) for x in sets]), np.concatenate([np.sort(x) for x in sets])
    lanes = [simhash.majority_bits(flat if k == 0 else simhash.mix64(flat + np.uint64(k)), sizes) for k in range(4)]
    fp = np.stack(lanes, axis=1)
    apart = np.bitwise_count(fp[::2] ^ fp[1::2]).sum(axis=1)
    assert apart.max() <= limit < 128 - 4 * 8
    up = simhash.similar_forest(flat.view(np.int64), sizes, 0.8, fp=fp)
    assert (up[::2] == up[1::2]).all() and len(set(up.tolist())) == len(sets) // 2
    far = np.stack([np.zeros(4, np.uint64), np.full(4, 2**64 - 1, np.uint64)])
    assert list(simhash.similar_forest(np.array([1, 2, 3, 1, 2, 3]), np.array([3, 3]), 0.8, fp=far)) == [0, 1]
