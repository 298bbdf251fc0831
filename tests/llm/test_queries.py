"""Every op query and the pipeline on a small table; against SQL where there is some."""

import re

import duckdb
import numpy as np
import pytest
import test_text_ops

from quillon.llm import frames, quality_rules
from quillon.llm.queries import ORACLES, QUERIES

CONTRACT = {
    "op1": {"conv_id", "call_id", "status", "level", "json_sha256"},
    "op2": {"doc_id", "n_lines", "n_dropped", "kept_sha256"},
    "op3": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op4": {"doc_id", "fingerprint", "component_id"},
    "op5": {"doc_id", "item_id", "coverage"},
    "op6": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op7": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op8": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op9": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op10": {"doc_id", "word_at", "score", "is_secret"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir):
    if name == "op10_secret_scan":  # the smallest table holds no secret
        sf_dir = sf_dir.replace("0.001", "0.01")
    df = QUERIES[name](spark, sf_dir)
    assert CONTRACT[re.match(r"op\d+", name)[0]] <= set(df.columns)
    rows = df.collect()
    assert rows
    if name not in ORACLES:
        return
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    rel = con.execute(ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, rel.fetchall())) == sorted(repr(tuple(r[c] for c in names)) for r in rows)


def awkward(spark, sf_dir):
    """The smallest table with nulls, empty and repeated rows, copies without an id, and columns that clash with outputs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    some = [r for r in docs.orderBy("doc_id").limit(40).collect() if len(r["text"]) > 400][:6]
    rows = [(None, None, "en", "s", 0), (100_001, None, None, None, None), (100_002, "", "en", "s", 0), (None, some[0]["text"], None, "s", 1)]
    rows += [tuple(some[k]) for k in (1, 1, 2)] + [(some[3]["doc_id"], "Another text of ten words and more under the same id", "en", "s", 3)]
    extra = spark.createDataFrame(rows, docs.schema)
    return docs.unionByName(extra).selectExpr("*", "doc_id AS n_lines", "'k' AS key", "'d' AS digest", "1 AS hash").repartition(3)


def kept_by_rules(rows, labels):
    """Base rules, and a walk over each tree of the forest that the labelled rows give."""
    stats = [test_text_ops.rules_reference(r["text"]) for r in rows]
    good = {}
    for doc, quality, *_ in labels:
        good[doc] = min(good.get(doc, 1), quality)
    use = [i for i, r in enumerate(rows) if r["doc_id"] in good]
    table = {c: np.array([stats[i][k] for i in use]) for k, c in enumerate(quality_rules.STATS)}
    forest = quality_rules.fit(table, np.array([good[rows[i]["doc_id"]] == 1 for i in use]))
    out = []
    for s in stats:
        n = max(s[0], 1)
        x, total = [s[1] / n, s[2] / n, s[3] / n, s[4] / n], 0.0
        for t in range(len(forest.feature)):
            node = 0
            while forest.feature[t][node] >= 0:
                node = forest.left[t][node] + (x[forest.feature[t][node]] >= forest.cut[t][node])
            total += forest.length[t][node]
        score = 2.0 ** (-total / len(forest.feature) / forest.norm)
        out.append(s[0] >= 10 and 100 * s[4] <= 20 * s[0] and score < forest.threshold)
    return out


def without_lines(rows, least):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(test_text_ops.LOW)
    words = [" ".join(test_text_ops.WORD.findall((r["text"] or "").translate(test_text_ops.LOW))) for r in rows]
    seen, first = {}, {}
    for r, w in zip(rows, words, strict=True):
        for k in {key(x) for x in (r["text"] or "").split("\n")} - {""}:
            seen.setdefault(k, set()).add(w)
            if r["doc_id"] is not None:
                first[k] = min(first.get(k, (r["doc_id"], w)), (r["doc_id"], w))
    out = []
    for r, w in zip(rows, words, strict=True):
        left, had = [], set()
        for line in (r["text"] or "").split("\n"):
            k = key(line)
            if not k or len(seen[k]) < least or (k not in had and first.get(k, (0, None))[1] == w):
                left.append(line)
            had.add(k)
        out.append("\n".join(left))
    return out


def one_of_each(rows):
    """Of documents that links of similarity 0.8 over five-word shingles connect, the one of least id, nulls last."""
    words = [[w.translate(test_text_ops.LOW) for w in test_text_ops.WORD.findall(r["text"] or "")] for r in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if comp[i] != comp[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                comp = [new if c == old else c for c in comp]
    return {(min((rows[i]["doc_id"] for i in range(len(rows)) if comp[i] == c and rows[i]["doc_id"] is not None), default=None)) for c in set(comp)}, len(set(comp))


def test_pipeline(spark, sf_dir):
    """Each stage on what the one before left, against brute force; awkward rows are among them."""
    import corpus_pipeline as pipeline

    docs = awkward(spark, sf_dir)
    columns = docs.columns
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    items = [test_text_ops.TOKEN.findall(r["text"].translate(test_text_ops.LOW)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    state = lambda df: sorted(df.select("doc_id", "text", "n_chars").collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))
    rows = state(docs)
    for name, stage in pipeline.STAGES[:-1]:
        out = frames.written(stage(spark, docs, sf_dir), name)
        assert out.columns == columns and out.dtypes == docs.dtypes
        got = state(out)
        if name == "quality_rules":
            want = [r for r, keep in zip(rows, kept_by_rules(rows, labels), strict=True) if keep]
            assert got == want and 0 < len(want) < len(rows)
        elif name == "line_dedup":
            assert sorted((r["doc_id"] or -1, r["text"]) for r in got) == sorted((r["doc_id"] or -1, t) for r, t in zip(rows, without_lines(rows, 10), strict=True))
            assert all(r["n_chars"] == len(r["text"]) for r, old in zip(got, rows, strict=False) if r["text"] != old["text"])
        elif name == "near_dedup":
            ids, n = one_of_each(rows)
            assert {r["doc_id"] for r in got} == ids and len(got) == n < len(rows)
        else:
            bad = set()
            for k, r in enumerate(rows):
                tokens = test_text_ops.TOKEN.findall(r["text"].translate(test_text_ops.LOW))
                grams = {tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4)}
                for item in items:
                    at = [i for i in range(len(item) - 4) if tuple(item[i : i + 5]) in grams]
                    if at and 5 * len(at) >= 0.5 * len(item) and test_text_ops.tiling_reference(tokens, item, 5) >= 0.5 * len(item):
                        bad.add(k)
                        break
            assert got == [r for k, r in enumerate(rows) if k not in bad] and bad
        docs, rows = out, got
    last = pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    library = test_text_ops.tiktoken_library()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in last) == sorted((r["doc_id"] or -1, len(library.encode_ordinary(r["text"]))) for r in rows)
    assert len(pipeline.STAGES) == 5


def test_pipeline_runs(spark, sf_dir, tmp_path):
    """run() over a whole table and over an empty one."""
    import corpus_pipeline as pipeline

    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    n = pipeline.run(spark, sf_dir).count()
    assert 0 < n < spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_pipeline_copies_keep_their_text(spark, sf_dir):
    """Of 12 copies of a clean text one survives with its text, of 12 near copies too; a line that ten texts share stays once."""
    import corpus_pipeline as pipeline

    stages = dict(pipeline.STAGES)
    clean = "\n".join(" ".join(f"c{i}x{j}" for j in range(12)) for i in range(6))
    near = "\n".join(" ".join(f"d{i}x{j}" for j in range(12)) for i in range(6))
    rows = [clean] * 11 + [clean.upper() + " \n"] + [f"shared notice\n{' '.join(f't{i}x{j}' for j in range(30))}" for i in range(10)]
    rows += [f"{near}\nown line {i} of twelve" for i in range(12)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(rows)], "doc_id long, text string, n_chars long").repartition(3)
    lined = stages["line_dedup"](spark, docs, sf_dir)
    want = {i: t if i <= 12 or i == 22 else t.removeprefix("shared notice\n").removeprefix(near + "\n") for i, t in enumerate(rows)}
    assert {r["doc_id"]: r["text"] for r in lined.collect()} == want
    left = {r["doc_id"]: r["text"] for r in stages["near_dedup"](spark, lined, sf_dir).collect()}
    assert left[0] == clean and left[22] == rows[22] and not set(left) & set(range(1, 12))
