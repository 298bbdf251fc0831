"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more key characters with a digit in it, or a
run of 8 or more, of more characters, behind a sign of assignment or a word
that announces a key.  The features of a candidate: its length and signs; how
likely its letters follow each other in the corpus; how much of it the
corpus's dictionary covers; path signs; and the weight of the words around it.
Letter transitions and dictionary come from all documents
(:func:`learn_corpus`), word weights and the forest (Spark's own) from
labelled findings (:func:`train`).  Everything on the way from texts to
findings is a DataFrame expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import frames

SPACES = r"[\x20\x09-\x0D]+"
LONG = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
#: Behind an assignment or an announcing word; the last character is no full stop or exclamation mark.
SHORT = r"[A-Za-z0-9+/_\-@!$%^&*~.]{7,}[A-Za-z0-9+/_\-@$%^&*~]={0,2}"
LEAST_LENGTH = 8
#: Words that announce a key: a candidate right behind one need not be long.
ANNOUNCING = r"(?i)(token|secret|passw|pwd|api.?key|\bkey\b|bearer|credential)"
ASSIGNED = r"[=:]>?['\"]?$"
#: A dictionary word has these letters and stands in so many documents at least.
WORD, LEAST_DOCS = "[a-z]{3,16}", 5
#: Labelled findings that the forest is trained on, at most: those with the smallest hashes.
SAMPLE_ROWS = 20_000
#: A neighbouring word has a weight if so many labelled findings have it.
LEAST_FINDINGS = 5
TREES, DEPTH, SEED = 30, 7, 7
THRESHOLD = 0.5
SHAPE = ("length", "transitions", "digits", "uppers", "distinct", "hex_only", "digits_only", "slashes", "separators", "path_like", "assigned", "quoted", "likeness")
FEATURES = (*SHAPE, "coverage", "context")


@dataclass
class Corpus:
    """What is learned from documents: (word, n_docs), and the log probability of each letter behind each letter."""

    words: DataFrame
    transitions: list[float]


@dataclass
class Model:
    """A forest, or without labelled rows of both kinds the one score that all candidates have."""

    forest: RandomForestClassificationModel | None
    constant: float | None
    weights: DataFrame
    corpus: Corpus


def learn_corpus(docs: DataFrame, least_docs: int = LEAST_DOCS) -> Corpus:
    """Dictionary and letter transitions of all documents; an empty corpus has no words and even transitions.

    The dictionary is a written table and meets candidates by join, so it may
    have any size; transitions are 26 x 26 numbers, with one added to each count.
    """
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(f"({WORD})"), F.lit(1)))
    words = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") >= least_docs)
    words = frames.written(words, "dictionary")
    letters = lambda k: F.ascii(F.substring("word", k, 1)) - 97
    at = F.col("at")
    pairs = words.select("word", "n_docs", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("at"))
    pairs = pairs.select((letters(at) * 26 + letters(at + 1)).alias("pair"), "n_docs").groupBy("pair").agg(F.sum("n_docs").alias("n"))
    counts = [1.0] * 676
    for r in pairs.collect():  # 676 rows at most
        counts[r["pair"]] += r["n"]
    sums = [sum(counts[26 * a : 26 * a + 26]) for a in range(26)]
    return Corpus(words, [math.log(n / sums[k // 26]) for k, n in enumerate(counts)])


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, word_at, word, before (three words), after (one word), nth (in the word) and core of every candidate."""
    words = F.split(F.coalesce("text", F.lit("")), SPACES)

    def look(words: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            at = lambda k: F.coalesce(F.get(words, i + k), F.lit(""))
            near = at(-1).rlike(ASSIGNED) | at(-1).rlike(ANNOUNCING) | w.rlike(r"[=:]['\"]?[A-Za-z0-9]") | (at(-1).rlike("^[=:]+>?$") & at(-2).rlike(ANNOUNCING))
            near = near & w.rlike(SHORT)
            before = F.concat_ws(" ", at(-3), at(-2), at(-1))
            found = F.struct(i.alias("word_at"), w.alias("word"), before.alias("before"), at(1).alias("after"), near.alias("near"))
            return F.when((F.length(w) >= LEAST_LENGTH) & (near | ((F.length(w) >= 16) & w.rlike(LONG))), found)

        return F.filter(F.transform(words, one), lambda x: x.isNotNull())

    # The words are bound to a variable, else each look at a neighbour would split the text again; and the condition, which
    # always holds, keeps the optimizer from searching a second time for its filter on empty arrays.
    found = F.when(F.monotonically_increasing_id() >= 0, F.get(F.transform(F.array(words), look), 0))
    each = docs.select("doc_id", found.alias("_found")).select("doc_id", F.explode("_found").alias("f")).select("doc_id", "f.*")
    short, long = (F.regexp_extract_all("word", F.lit(f"({p})"), F.lit(1)) for p in (SHORT, LONG))
    cores = F.when(F.col("near"), short).otherwise(F.filter(long, lambda x: x.rlike("[0-9]")))
    return each.select("doc_id", "word_at", "word", "before", "after", F.posexplode(cores).alias("nth", "core"))


def _shape(found: DataFrame, transitions: list[float]) -> DataFrame:
    """Adds SHAPE (doubles) to rows of core, word and before."""
    core, n = F.col("core"), F.length("core")
    share = lambda pattern: F.regexp_count(core, F.lit(pattern)) / n
    letter = lambda i: F.ascii(F.substring(F.lower(core), i, 1)) - 97
    table = F.split(F.lit(" ".join(map(repr, transitions))), " ").cast("array<double>")  # one literal once folded
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.when(letter(i).between(0, 25) & letter(i + 1).between(0, 25), F.get(table, letter(i) * 26 + letter(i + 1))))
    known = F.array_compact(pairs)
    likeness = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known)).otherwise(-math.log(26))
    values = {
        "length": n,
        "transitions": share(r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"),
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "distinct": F.size(F.array_distinct(F.split(core, ""))) / F.least(n, F.lit(36)),
        "hex_only": core.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "digits_only": core.rlike("^[0-9]+$"),
        "slashes": F.regexp_count(core, F.lit("/")),
        "separators": share("[_.-]"),
        "path_like": F.col("word").rlike(r"(://|^[~.]?/|\\|\.[a-z]{2,4}\b)"),
        "assigned": F.col("before").rlike(ASSIGNED) | F.col("word").rlike(r"[=:]['\"]?[A-Za-z0-9+/_\-]{8,}"),
        "quoted": F.col("word").rlike("['\"`]"),
        "likeness": likeness,
    }
    return found.withColumns({k: v.cast("double") for k, v in values.items()})


def _neighbours() -> Column:
    """The words around a candidate, in small letters: those before it and in front of it in its own word (b:), the one after (a:)."""
    words = lambda text: F.regexp_extract_all(F.lower(text), F.lit("([a-z]{2,20})"), F.lit(1))
    marked = lambda side, text: F.transform(words(text), lambda w: F.concat(F.lit(side), w))
    own = F.expr("substring_index(word, core, 1)")
    return F.array_distinct(F.concat(marked("b:", F.concat_ws(" ", "before", own)), marked("a:", F.col("after"))))


def with_features(found: DataFrame, corpus: Corpus, weights: DataFrame) -> DataFrame:
    """Adds FEATURES (doubles) to rows of row (a key), core, word, before and after.

    coverage: the share of the core in runs of letters that are dictionary
    words; context: the sum of its neighbours' weights.
    """
    runs = F.regexp_extract_all(F.lower(F.regexp_replace("core", "(?<=[a-z])(?=[A-Z])", " ")), F.lit(f"({WORD})"), F.lit(1))
    parts = found.select("row", F.explode(runs).alias("word")).join(corpus.words.select("word"), "word")
    covered = parts.groupBy("row").agg(F.sum(F.length("word")).alias("_covered"))
    near = found.select("row", F.explode(_neighbours()).alias("neighbour")).join(F.broadcast(weights), "neighbour")  # fewer than 10 x SAMPLE_ROWS rows
    near = near.groupBy("row").agg(F.sum("weight").alias("_weight"))
    shaped = _shape(found, corpus.transitions).join(covered, "row", "left").join(near, "row", "left")
    coverage = F.coalesce("_covered", F.lit(0)) / F.length("core")
    return shaped.withColumns({"coverage": coverage.cast("double"), "context": F.coalesce("_weight", F.lit(0.0))}).drop("_covered", "_weight")


def learn_weights(rows: DataFrame) -> DataFrame:
    """(neighbour, weight): the smoothed log odds of a secret next to a word, for words of LEAST_FINDINGS labelled rows or more."""
    totals = rows.agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
    each = rows.select("label", F.explode(_neighbours()).alias("neighbour")).groupBy("neighbour")
    each = each.agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).filter(F.col("a") + F.col("b") >= LEAST_FINDINGS)
    weight = F.log((F.col("a") + 0.5) / (F.col("p") + 1)) - F.log((F.col("b") + 0.5) / (F.col("q") + 1))
    return each.crossJoin(totals).select("neighbour", weight.alias("weight"))  # one row


def train(labelled: DataFrame, corpus: Corpus, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from labelled findings (core, word, before, after, label: 1 for a secret): at most ``sample_rows`` of them, by hash.

    Rows without core or label are left out.  Without rows of both kinds there
    is no forest: all candidates score 1.0 or 0.0 as the one kind says, and
    without any rows null, which counts as a secret since nothing speaks
    against it.
    """
    rows = labelled.filter("label is not null and core is not null").fillna("", ["word", "before", "after"])
    rows = frames.hash_sample(rows, ["core", "before", "after", "label"], sample_rows)
    rows = frames.written(rows.select("core", "word", "before", "after", F.col("label").cast("int").alias("label"), F.monotonically_increasing_id().alias("row")), "labelled")
    weights = frames.written(learn_weights(rows), "weights")
    kinds = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        return Model(None, float(kinds[0]) if kinds else None, weights, corpus)
    made = frames.written(with_features(rows, corpus, weights).select("label", *FEATURES), "features")  # training goes over them often
    vectors = _vectors(made).select("features", F.col("label").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(vectors)
    return Model(forest, None, weights, corpus)


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def score(found: DataFrame, model: Model) -> DataFrame:
    """Adds FEATURES and score to rows of row (a key), core, word, before and after."""
    made = with_features(found, model.corpus, model.weights)
    if model.forest is None:
        return made.withColumn("score", F.lit(model.constant).cast("double"))
    share = F.round(F.element_at(vector_to_array("probability"), 2), 6)
    return model.forest.transform(_vectors(made)).withColumn("score", share).drop("features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, word_at, nth, length, core_sha256, score and is_secret of every candidate of every text.

    Candidates are numbered by word (0-based, split at white space) and by
    place in the word.  Null and empty texts have none; repeated rows and null
    ids are scanned each; other columns are not looked at.  Candidates are
    written once, so texts are read once.
    """
    found = frames.written(candidates(docs).withColumn("row", F.monotonically_increasing_id()), "candidates")
    secret = F.coalesce(F.col("score") >= threshold, F.lit(True))
    return score(found, model).select("doc_id", "word_at", "nth", F.col("length").cast("int").alias("length"), F.sha2("core", 256).alias("core_sha256"), "score", secret.alias("is_secret"))


def frequent(corpus: Corpus, n: int = 200) -> list[str]:
    """The corpus's most frequent words."""
    return [r["word"] for r in corpus.words.orderBy(F.desc("n_docs"), "word").limit(n).collect()]


#: Used where a corpus has no words.
NO_WORDS = ("the", "and", "with", "from")


def seed_findings(spark: SparkSession, words: list[str], rows: int = 6000) -> DataFrame:
    """Labelled findings to start from: core, word, before, after, label (1: a secret), kind.

    Half are keys of several alphabets and prefixes and passwords, behind a
    name and a sign of assignment; the others are digests, card and serial
    numbers, dated identifiers, paths, plain words and placeholders in their
    usual surroundings.  Plain words are drawn from ``words``.
    """
    words = words or list(NO_WORDS)
    i = F.col("id")
    pick = lambda salt, *xs: F.element_at(F.split(F.lit("\x00".join(map(str, xs))), "\x00"), (F.pmod(F.xxhash64(F.lit(salt), i), F.lit(len(xs))) + 1).cast("int"))
    size = lambda salt, low, high: (F.pmod(F.xxhash64(F.lit(salt), i), F.lit(high - low + 1)) + low).cast("int")
    sha = lambda salt: F.sha2(F.concat(F.lit(salt), i.cast("string")), 512)
    whole = lambda salt: F.abs(F.xxhash64(F.lit(salt), i)).cast("string")
    name = F.concat(pick("w", "api_", "access_", "", "auth_", "client_"), pick("v", "token", "key", "secret", "password", "credential"))
    base = {
        "hex": sha("a"),
        "other_hex": sha("c"),
        "b64": F.regexp_replace(F.base64(F.unhex(sha("b"))), "=+$", ""),
        "digits": F.regexp_replace(F.concat(whole("d"), whole("e")), "^0", "1"),
        "kind": size("kind", 0, 7),
        "name": F.when(size("up", 0, 3) == 0, F.upper(name)).otherwise(name),
        "n_hex": pick("n", 32, 40, 64).cast("int"),
        "n_b64": size("m", 20, 64),
        "n_digits": pick("n2", 16, 16, 19).cast("int"),
        "quote": pick("q", '"', "'", '"', ""),
        "tail": pick("t", "", ",", ";", ".", "!!", "###"),
        "sign": pick("s", "=", ":", ":=", "="),
        "inside": size("in", 0, 3) == 0,  # name=key in one word
        "password": F.concat(F.substring(F.base64(F.unhex(sha("p"))), F.lit(1), size("m1", 5, 9)), pick("mark", "!", "@", "$", "%", "9"), F.substring(sha("g"), F.lit(1), size("m2", 3, 6))),
        "prefix": pick("p", "pk_", "ak-", "live_"),
        "joint": pick("j", "_", "-", "/"),
        "digest_name": pick("l", "commit", "sha256", "checksum", "digest", "revision"),
        "holder": pick("ph", "your_token_here_", "example_secret_", "changeme_", "xxxxxxxxxxxxxxxx"),
        "other_name": pick("lw", "token", "secret", "key", "note:"),
        **{f"w{k}": pick(f"word{k}", *words) for k in range(4)},
    }
    made = frames.written(spark.range(0, rows, 1, 4).select("id", *[c.alias(n) for n, c in base.items()]), "seeds")
    c = F.col
    cut = lambda text, n: F.substring(c(text), F.lit(1), n if isinstance(n, Column) else F.lit(n))
    kind, real = c("kind"), c("id") % 2 == 0
    several = F.concat_ws("", "w0", "joint", "w1", "joint", "w2", "joint", "w3")
    key = (
        F.when(kind < 3, cut("hex", c("n_hex")))
        .when(kind == 3, F.upper(cut("hex", c("n_hex"))))
        .when(kind < 6, cut("b64", c("n_b64")))
        .when(kind == 6, F.concat("prefix", cut("b64", F.greatest(c("n_b64") - 20, F.lit(20)))))
        .otherwise(c("password"))
    )
    false = (
        F.when(kind == 0, cut("other_hex", c("n_hex")))
        .when(kind < 3, cut("digits", c("n_digits")))
        .when(kind == 3, F.concat(several, F.lit("-"), cut("digits", 4)))
        .when(kind == 4, F.concat(F.lit("/"), several, F.lit("/"), cut("digits", 2)))
        .when(kind == 5, F.concat(c("holder"), cut("digits", 4)))
        .when(kind == 6, F.concat(F.lit("2024-01-02_"), several))
        .otherwise(F.concat("w0", "w1", "w2"))
    )
    real_kind = F.when(kind < 3, "hex").when(kind == 3, "upper_hex").when(kind < 6, "base64").when(kind == 6, "prefixed").otherwise("password")
    false_kind = F.when(kind == 0, "digest").when(kind < 3, "number").when(kind == 3, "identifier").when(kind == 4, "path").when(kind == 5, "placeholder").when(kind == 6, "dated").otherwise("word")
    made = made.select("*", F.when(real, key).otherwise(false).alias("core"))
    quoted = F.concat("quote", "core", "quote", "tail")
    lead = (
        F.when(kind == 0, F.concat_ws(" ", "w1", "w2", "digest_name"))
        .when(kind == 5, F.concat_ws(" ", "w1", "name", F.lit("=")))
        .when(kind == 7, F.concat_ws(" ", "w1", "w2", "other_name"))
        .otherwise(F.concat_ws(" ", "w1", "w2", "w3"))
    )
    before = F.when(real & c("inside"), F.concat_ws(" ", "w1", "w2", "w3")).when(real, F.concat_ws(" ", "w1", "name", "sign")).otherwise(lead)
    word = F.when(real & c("inside"), F.concat(c("name"), F.lit("="), quoted)).when(real, quoted).otherwise(F.concat("core", "tail"))
    out = made.select("core", word.alias("word"), before.alias("before"), c("w0").alias("after"), real.cast("int").alias("label"), F.when(real, real_kind).otherwise(false_kind).alias("kind"))
    return frames.written(out, "seed-findings")
