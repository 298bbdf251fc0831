import base64
import hashlib
import re
import struct
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, nothing, texts
from pyspark.sql import functions as F

from quillon.llm import bloom, byte_bpe, decontaminate, fm_index, frames, line_dedup, quality_rules, substring_dedup, text_blocks, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {i: i + 32 for i in range(65, 91)}
PATH = P.path("byte_bpe_50k.tiktoken")


TOKEN = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")


@pytest.fixture(scope="module")
def library():
    return tiktoken_library()


def tiktoken_library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- blocks -----------------------------------------------------------------


@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\rabAé日", max_size=30)), max_size=12), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_blocks(rows, limit):
    got_words, got_lines = [[] for _ in rows], [[] for _ in rows]
    for b in text_blocks.blocks(pa.array(rows, pa.string()), limit):
        for find, out in ((b.words, got_words), (b.lines, got_lines)):
            for s, e, d in zip(*find(), strict=True):
                out[b.first + d].append(b.data[s:e].tobytes().decode())
        joined, s, e, d = b.joined(b.data)
        assert [joined[x:y].tobytes() for x, y in zip(s, e, strict=True)] == [b.data[x:y].tobytes() for x, y in zip(*b.words()[:2], strict=True)]
    assert got_words == [WORD.findall(t or "") for t in rows]
    assert got_lines == [(t or "").split("\n") for t in rows]


@given(st.binary(min_size=0, max_size=60), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=10), st.integers(1, 9))
@settings(max_examples=80, deadline=None)
def test_hashes_over_chunks(data, cuts, chunk):
    """The same hash wherever a range stands and however the text is cut into chunks."""
    ranges = sorted((min(a, b, len(data)), min(max(a, b), len(data))) for a, b in cuts)
    ranges = [(a, b) for k, (a, b) in enumerate(ranges) if k == 0 or b >= ranges[k - 1][1]]
    starts, ends = (np.array([r[k] for r in ranges], np.int64) for k in (0, 1))
    block = text_blocks.Block(0, np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    want = block.hashes(starts, ends).tolist()
    old, text_blocks.HASH_BYTES = text_blocks.HASH_BYTES, chunk
    try:
        assert block.hashes(starts, ends).tolist() == want
    finally:
        text_blocks.HASH_BYTES = old
    for (a, b), h in zip(ranges, want, strict=True):
        alone = text_blocks.Block(0, np.frombuffer(data[a:b], np.uint8), np.array([0, b - a]))
        assert alone.hashes(np.array([0]), np.array([b - a])).tolist() == [h]


def test_pieces():
    batch = pa.record_batch({"text": ["x" * n for n in (10, 2000, 3, 900, 900, 1, 1)]})
    parts = list(frames.pieces([batch], 1000))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or p.nbytes <= 1000 for p in parts) and len(parts) > 3


@pytest.mark.parametrize("layout", [{}, {"bits_per_hash": 1, "slice_hashes": 64}, {"page_bits": 64, "filter_bytes": 64}])
def test_bloom(spark, layout):
    """Every hash of two documents is in the filter, few others are, whatever the layout."""
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    docs = [rng.choice(pool, 40, replace=False) for _ in range(120)]
    df = spark.createDataFrame([(d.tobytes(),) for d in docs], "h binary").repartition(5)
    read = lambda batch: (np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(0))
    sizes = {k: v for k, v in layout.items() if k in ("bits_per_hash", "slice_hashes")}
    repeated = bloom.repeats(df, read, 5000, **sizes)
    parts = bloom.filters(repeated, **{k: v for k, v in layout.items() if k != "slice_hashes"})
    assert len(parts) > 1 if "filter_bytes" in layout else len(parts) == 1
    count = Counter(h for d in docs for h in d.tolist())
    every = np.array(sorted(count), np.uint64)
    found = np.zeros(len(every), bool)
    for part in parts:
        found |= bloom.Filter(part.value).contains(every)
    twice = np.array([count[int(h)] > 1 for h in every])
    assert found[twice].all()
    if not layout:
        assert found[~twice].mean() < 0.05
    assert bloom.filters(repeated.limit(0)) == []


# --- line dedup -------------------------------------------------------------


def line_reference(rows, least):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOW)
    count = Counter(k for t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and count[key(x)] >= least)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("broadcast,layout", [(1 << 20, {}), (0, {}), (1 << 20, {"bits_per_hash": 1, "slice_hashes": 64}), (0, {"page_bits": 64, "filter_bytes": 64})])
def test_line_dedup(spark, broadcast, layout):
    rows = texts()
    out = line_dedup.dedup_lines(documents(spark), 10, broadcast_bytes=broadcast, **layout)
    assert set(out.columns) == set(documents(spark).columns) | {"n_lines", "n_dropped"}
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"] or "") for r in out.collect()}
    assert got == dict(enumerate(line_reference(rows, 10)))
    assert sum(x[1] for x in got.values()) > 14
    assert {r["key"] for r in out.collect()} == {"own"}


def test_line_dedup_keeps_first(spark):
    df = spark.createDataFrame([(2, "a\nx\nX"), (1, "X \nb\nx"), (None, "x"), (3, "x")], "doc_id long, text string")
    for broadcast in (1 << 20, 0):
        out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, 2, keep="first", broadcast_bytes=broadcast).collect()}
        assert out == {1: "X \nb", 2: "a", 3: "", None: ""}
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(df, 1)


def test_line_dedup_copies(spark):
    """Copies count once and keep their lines; of other documents the first and its copies keep the line."""
    rows = [(1, "S\na b"), (2, "s\nA  b"), (3, "s\nc"), (4, "s"), (5, "x\ns\ns"), (None, "s\nq")] + [(k, "same\ntext") for k in range(6, 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same = {k: "same\ntext" for k in range(6, 20)}
    for broadcast in (1 << 20, 0):
        for keep, kept in (("none", {1: "a b", 2: "A  b", 3: "c", 4: "", 5: "x", None: "q"}), ("first", {1: "S\na b", 2: "s\nA  b", 3: "c", 4: "", 5: "x", None: "q"})):
            out = line_dedup.dedup_lines(df, 5, keep=keep, broadcast_bytes=broadcast, copies_once=True).collect()
            assert {r["doc_id"]: r["text"] for r in out} == kept | same


def test_line_dedup_empty(spark):
    assert line_dedup.dedup_lines(nothing(spark), 10).count() == 0
    out = line_dedup.dedup_lines(spark.createDataFrame([(1, None), (2, ""), (3, "\n")], "doc_id long, text string"), 2).collect()
    assert {r["doc_id"]: (r["text"], r["n_lines"]) for r in out} == {1: (None, 1), 2: ("", 1), 3: ("\n", 2)}


# --- byte-level BPE ---------------------------------------------------------


def test_bpe_documents(spark, library):
    out = {r["doc_id"]: r for r in byte_bpe.encode(documents(spark), PATH, P.PATTERN).collect()}
    for i, t in enumerate(texts()):
        ids = library.encode_ordinary(t or "")
        raw = struct.pack(f"<{len(ids)}I", *ids)
        r = out[i]
        assert (r["n_tokens"], bytes(r["token_ids"]), r["ids_sha256"], r["decoded_sha256"]) == (len(ids), raw, hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert byte_bpe.encode(nothing(spark), PATH, P.PATTERN).count() == 0
    carried = byte_bpe.encode(documents(spark), PATH, P.PATTERN, carry=True)
    assert dict(carried.dtypes)["n_tokens"] == "bigint" and carried.filter("key = 'own'").count() == len(texts())


@given(st.text(max_size=60), st.text(alphabet="ab \n'", max_size=400))
@settings(max_examples=120, deadline=None)
def test_bpe_any_text(library_module, a, b):
    bpe, library = library_module
    for t in (a, b, b * 4):
        ids = bpe.encode_texts([t])[0]
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        assert bpe.decode(ids) == t.encode()


@pytest.fixture(scope="module")
def library_module(library):
    return byte_bpe.tokenizer(PATH, P.PATTERN), library


@pytest.mark.parametrize("size", [300, 2000, 60_000])
def test_bpe_long_pieces(library_module, size):
    bpe, library = library_module
    rng = np.random.default_rng(3)
    for alphabet in ("ab", "aeinrst", "=-_", "é日x"):
        t = "".join(rng.choice(list(alphabet), size))
        assert np.frombuffer(bpe.encode_texts([t])[0], "<u4").tolist() == library.encode_ordinary(t)


# --- decontamination --------------------------------------------------------


def tiling_reference(doc, item, tile):
    """Textbook greedy string tiling."""
    used_d, used_i, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and not used_d[p + n] and not used_i[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < tile:
            return covered
        used_d[p : p + n] = used_i[q : q + n] = [True] * n
        covered += n


@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), min_size=3, max_size=20), st.sampled_from([1, 3]))
@settings(max_examples=150, deadline=None)
def test_tiling(doc, item, tile):
    number = {w: k for k, w in enumerate("ab")}  # c is a token that matches nothing
    d = np.array([number.get(w, -1) for w in doc], np.int64)
    i = np.array([number.get(w, 2) for w in item], np.int64)
    placed = decontaminate.tiles(d, i, tile)
    assert sum(x[2] for x in placed) == tiling_reference(["-" if w == "c" else w for w in doc], item, tile)
    assert all((d[a : a + n] == i[b : b + n]).all() for a, b, n in placed)


def test_tiling_of_periodic_texts():
    """Runs that repeat without end take time and memory by their length, not by its square."""
    import time
    import tracemalloc

    tracemalloc.start()
    start = time.perf_counter()
    for doc, item in (([0] * 200_000, [0] * 200), ([0, 1] * 100_000, [1, 0] * 100), ([0, 1, -1] * 60_000, [0, 1] * 90 + [2] * 20)):
        placed = decontaminate.tiles(np.array(doc), np.array(item), 2)
        assert sum(x[2] for x in placed) == sum(x < 2 for x in item)
    assert time.perf_counter() - start < 20 and tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()


def test_decontamination(spark):
    item = "When the quick brown fox jumps over one lazy dog, nobody in this town cares at all."
    half = item.split(" ")
    moved = " ".join(half[8:] + ["and"] + half[:8])
    rows = [item.upper().replace(",", " -"), f"before {moved} after", " ".join(half[:5]), None, "", "clean words only here today", item, item]
    bench = spark.createDataFrame([(5, item), (6, "too short"), (7, None), (8, "")], "item_id long, text string")
    for filter_bytes in (1 << 20, 1):
        out = decontaminate.contaminated(documents(spark, rows), bench, filter_bytes=filter_bytes)
        assert sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in out.collect()) == [(0, 5, 1.0), (1, 5, 1.0), (6, 5, 1.0), (7, 5, 1.0)]
    for broadcast_rows in (100, 0):
        left = decontaminate.drop_contaminated(documents(spark, rows), bench, broadcast_rows=broadcast_rows)
        assert left.columns == documents(spark, rows).columns
        assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 5]
    assert decontaminate.contaminated(nothing(spark), bench).count() == 0
    assert decontaminate.contaminated(documents(spark, rows), bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(documents(spark, rows), bench.limit(0)).count() == len(rows)
    twice = documents(spark, rows).unionByName(documents(spark, rows))
    assert decontaminate.contaminated(twice, bench).count() == 8


def test_decontamination_brute_force(spark):
    """All documents against all items, periodic texts and repeated runs among them, in one and in several filters."""
    rng = np.random.default_rng(8)
    some = lambda n, k=6: " ".join(rng.choice([f"v{i}" for i in range(k)], n))
    items = [some(int(n)) for n in rng.integers(1, 40, 25)] + ["the " * 30, "v0 v1 " * 12, "v2"]
    docs = [some(int(n)) for n in rng.integers(0, 150, 40)] + ["the " * 400, "v0 v1 " * 90, "v0 " * 60, f"{items[0]} x {items[1]}", "the the the the"]
    want = set()
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            x, y = doc.split(), item.split()
            n = tiling_reference(x, y, min(5, len(y)))
            if n >= 0.5 * len(y):
                want.add((d, i, n))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for filter_bytes in (1 << 20, 1):
        out = decontaminate.contaminated(documents(spark, docs), bench, filter_bytes=filter_bytes)
        assert {(r["doc_id"], r["item_id"], r["covered_tokens"]) for r in out.collect()} == want
    assert len(want) > 20


def test_decontamination_short_items(spark):
    """An item shorter than a tile is reported where it stands whole, once a document, and only there."""
    rows = ["It was (TOO, short) too short", "too very short", "short too", "Yes!", "yesterday", "a b c d e", None, "too", "short"]
    bench = spark.createDataFrame([(1, "Too short"), (2, "yes"), (3, "b c d e"), (4, "a b c d e"), (5, "TOO SHORT!"), (6, "?!"), (7, None)], "item_id long, text string")
    out = decontaminate.contaminated(documents(spark, rows), bench).collect()
    got = sorted((r["doc_id"], r["item_id"], r["item_tokens"], r["covered_tokens"], r["n_tiles"], r["coverage"]) for r in out)
    assert got == [(0, 1, 2, 2, 1, 1.0), (0, 5, 2, 2, 1, 1.0), (3, 2, 1, 1, 1, 1.0), (5, 3, 4, 4, 1, 1.0), (5, 4, 5, 5, 1, 1.0)]
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(documents(spark, rows), bench).collect()) == [1, 2, 4, 6, 7, 8]


# --- substring dedup --------------------------------------------------------


def substring_reference(rows, window):
    first = {}
    words = [WORD.findall(t or "") for t in rows]
    for i, w in enumerate(words):
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), i)
    out = {}
    for i, w in enumerate(words):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("window,hot,layout", [(13, 50_000, {}), (5, 50_000, {"bits_per_hash": 1, "slice_hashes": 64}), (5, 2, {}), (13, 0, {}), (13, 50_000, {"broadcast_keys": 0, "page_bits": 64, "filter_bytes": 64})])
def test_substring_dedup(spark, window, hot, layout):
    rows = texts()
    out = substring_dedup.dedup_substrings(documents(spark), window, hot_rows=hot, **layout)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()}
    assert got == substring_reference(rows, window)


def test_hot_anchors(spark):
    """Windows around one very common word run still meet, by other anchors or by themselves."""
    rng = np.random.default_rng(6)
    some = lambda n: " ".join(rng.choice([f"w{i}" for i in range(400)], n))
    run, shared = "in the light of what was said", some(20)
    rows = [f"{some(9)} {run} {some(9)}" for _ in range(60)] + [f"{some(4)} {shared} {run} {shared}" for _ in range(6)] + ["la " * 80, "la " * 95]
    want = substring_reference(rows, 13)
    for hot in (50_000, 8, 1):
        out = substring_dedup.dedup_substrings(documents(spark, rows), 13, hot_rows=hot)
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()} == want


def test_substring_dedup_edges(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(None, text), (4, text), (4, text), (4, text + " more"), (9, text)], "doc_id long, text string")
    out = sorted(((r["doc_id"] or -1), r["n_removed"]) for r in substring_dedup.dedup_substrings(df).collect())
    assert out == [(-1, 0), (4, 0), (4, 0), (4, 0), (9, 20)]
    assert substring_dedup.dedup_substrings(nothing(spark)).count() == 0


@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=14), min_size=1, max_size=12), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_fm_index(segments, window):
    text = np.concatenate([np.array([*s, 0]) for s in segments])
    lengths = np.array([len(s) for s in segments])
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    owner = np.random.default_rng(len(text)).permutation(len(text))
    index = fm_index.FMIndex(text, window, owner)
    found = {}
    for s, o, low, high, kind in zip(*index.matching(text, starts, lengths), strict=True):
        found[int(s), int(o)] = int(high - low), int(index.least[kind])
    where = {}
    for a, s in enumerate(segments):
        for p in range(len(s) - window + 1):
            where.setdefault(tuple(s[p : p + window]), []).append(int(owner[int(starts[a]) + p]))
    expected = {(a, p): where[tuple(s[p : p + window])] for a, s in enumerate(segments) for p in range(len(s) - window + 1)}
    assert found == {k: (len(v), min(v)) for k, v in expected.items()}


@given(st.lists(st.booleans(), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_bit_vector(bits):
    v = fm_index.BitVector(np.array(bits))
    ones = np.flatnonzero(bits)
    assert v.rank1(np.arange(len(bits) + 1)).tolist() == [sum(bits[:i]) for i in range(len(bits) + 1)]
    assert v.select1(np.arange(len(ones))).tolist() == ones.tolist()


# --- quality rules ----------------------------------------------------------


def rules_reference(t):
    t = t or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, cover, seen, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if count[g] > 1:
            cover.update(range(i, i + 5))
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_rule_statistics(spark):
    labels = spark.createDataFrame([(8, 1, 0), (9, 1, 0), (None, 1, 0), (10, None, 0), (40, 0, 0), (8, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality_rules.rate(documents(spark), labels).collect()}
    for i, t in enumerate(texts()):
        want = rules_reference(t)
        assert tuple(out[i][c] for c in quality_rules.STATS) == want
        assert out[i]["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (out[i]["base_failed"] and out[i]["kept"])
    assert quality_rules.rate(nothing(spark), labels).count() == 0
    alone = quality_rules.rate(documents(spark), labels.limit(0)).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in alone)
    kept = quality_rules.keep_good(documents(spark), labels)
    assert kept.columns == documents(spark).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in out.items() if r["kept"])


def test_quality_held_out(sf_dir):
    """Half of the labels trains, the other half judges."""
    import pyarrow.parquet as pq

    sf = sf_dir.replace("0.001", "0.01")
    docs, labels = pq.read_table(f"{sf}/documents.parquet"), pq.read_table(f"{sf}/labels.parquet").to_pydict()
    quality = dict(zip(labels["doc_id"], labels["quality"], strict=True))
    stats = quality_rules.text_stats(docs["text"].combine_chunks())
    y = np.array([quality.get(i, -1) for i in docs["doc_id"].to_pylist()])
    odd = np.arange(len(y)) % 2 == 1
    forest = quality_rules.fit({k: v[~odd & (y >= 0)] for k, v in stats.items()}, y[~odd & (y >= 0)] == 1)
    kept = quality_rules.verdict(stats, forest)["kept"]
    clean = odd & (y == 1) & ~quality_rules.base_failed(stats)
    assert kept[clean].mean() >= 0.97
    assert kept[odd & (y == 0)].mean() <= 0.1


def test_forest_by_hand():
    """Scores follow from path lengths that a walk over each tree gives, and stay the same in any order of rows."""
    rng = np.random.default_rng(4)
    x = np.concatenate((rng.normal(size=(400, 4)), rng.normal(size=(10, 4)) * 9))
    forest = quality_rules.fit_forest(x[:400], trees=20, rows=64)

    def path(t, row):
        node = 0
        while forest.feature[t][node] >= 0:
            node = forest.left[t][node] + (row[forest.feature[t][node]] >= forest.cut[t][node])
        return forest.length[t][node]

    want = [2.0 ** -(sum(path(t, row) for t in range(20)) / 20 / forest.norm) for row in x]
    assert np.allclose(forest.score(x), want)
    assert np.mean(want[400:]) > np.quantile(want[:400], 0.95)


# --- token counts -----------------------------------------------------------


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts(spark, tmp_path, name):
    path, cache = P.path(name), str(tmp_path / "cache")
    counter = token_counts.Counter(path)
    want = dict(enumerate(counter._encode([t or "" for t in texts()])))
    for round_ in range(2):
        out = token_counts.count_tokens(documents(spark), path, cache, limit=100)
        got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect()}
        assert got == {i: (len((t or "").encode()), want[i], want[i] > 100) for i, t in enumerate(texts())}, round_
    assert spark.read.parquet(cache).count() == len({t or "" for t in texts()})
    assert token_counts.count_tokens(nothing(spark), path, cache).count() == 0


@given(st.text(alphabet="ab  \n▁é日<s>　 ", max_size=40))
@settings(max_examples=200, deadline=None)
def test_piecewise_counts(text):
    counter = token_counts.counter(P.path("piece_bpe_32k.model"))
    assert counter.piecewise
    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    assert counter.counts([text]) == [len(library.encode(text))]


def test_cache_is_used(spark, tmp_path):
    path, cache = P.path("piece_bpe_32k.model"), str(tmp_path / "cache")
    digest = hashlib.sha256(b"hello").digest()
    version = token_counts.tokenizer_digest(path)
    old = spark.createDataFrame([(digest, version, 77), (digest, version, 77), (digest, "other", 5), (b"unused", version, 9)], "content_digest binary, tokenizer_digest string, n_tokens long")
    token_counts.append(old, cache)
    df = spark.createDataFrame([(1, "hello"), (2, "hello"), (None, "new")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, path, cache).collect()}
    assert got[1] == got[2] == 77
    assert spark.read.parquet(cache).filter(F.col("tokenizer_digest") != "other").count() == 4
    token_counts.compact(spark, cache, version, cache + "-compact")
    assert spark.read.parquet(cache + "-compact").count() == 3
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, path, cache + "-compact").collect()} == got
