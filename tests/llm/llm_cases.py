"""Small documents that hold the awkward cases."""

import random

from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, n_tokens string, shard string, id string, key string, fp string, digest string, kept string"


def texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta,", "épée", "naïve", "the", "of", "x", "日本語", "42", "#tag", "co-op"]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = some(60)
    near = base.split(" ")
    near[30] = "other"
    passage = some(25)
    out = [None, "", " ", "\n", "\n\n", "\t a \x0b b\r\n", "one", "A", base, base, base, " ".join(near), base.upper(), "same line\n" + some(5)]
    out += [f"{some(8)}\nSame LINE \n{some(6)}\n  same line" for _ in range(14)]
    out += [f"{some(9)} {passage} {some(11)}" for _ in range(5)]
    out += ["dup\n" * 30, "word " * 400, "a" * 5000, "é" * 700, " " * 3000, some(3000), "! ? . , ; : #*$%&|<>" * 3, "<|endoftext|> ▁x  y  ", "don't we'll I'm ok　ok"]
    return out


def documents(spark, rows=None, extra=True):
    rows = texts() if rows is None else rows
    data = [(i, t, ["en", "fr", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(rows)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    if extra:
        df = df.withColumns({c.split()[0]: F.lit("own") for c in COLUMNS.split(", ")[5:]})
    return df


def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
