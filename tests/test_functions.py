import math

import pytest
from pyspark.sql import functions as F

from quillon.functions import scalars as S
from quillon.functions import semantics as M


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


NAN = float("nan")


def number(x):
    return F.lit(x).cast("double")


@pytest.mark.parametrize("op", [M.gt, M.ge, M.lt, M.le])
@pytest.mark.parametrize("a,b", [(NAN, 1.0), (1.0, NAN), (NAN, NAN), (None, 1.0)])
def test_missing_satisfies_nothing(spark, op, a, b):
    assert one(spark, op(number(a), number(b))) is False


def test_finite(spark):
    assert one(spark, M.finite(number(NAN))) is None
    assert one(spark, M.finite(F.lit(float("-inf")))) is None
    assert one(spark, M.finite(F.lit(2.0))) == 2.0
    assert one(spark, M.is_finite(number(None))) is False
    assert one(spark, M.ratio(F.lit(1.0), F.lit(0.0))) is None
    name, value = M.first_finite([("a", number(NAN)), ("b", F.lit(3.0))])
    assert (one(spark, name), one(spark, value)) == ("b", 3.0)


@pytest.mark.parametrize("low,high", [("1.2.3", "1.10.0"), ("1.0.0-dev", "1.0.0"), ("0.9", "1"), ("1.0.0", "1.0.1-rc1")])
def test_version_order(spark, low, high):
    assert one(spark, S.version_key(F.lit(low)) < S.version_key(F.lit(high)))


def test_versions_differ(spark):
    assert one(spark, S.minor_differs(F.lit("1.2.3"), F.lit("1.2.9"))) is False
    assert one(spark, S.minor_differs(F.lit("1.2.3"), F.lit("1.3.0"))) is True


@pytest.mark.parametrize("message,stderr,by_word,by_substring", [("CUDA out of memory", "", "oom", "oom"), ("gpu lock timeout", "", "gpu_acquire_timeout", "gpu_acquire_timeout"), ("exception in function", "", "unknown", "io_error"), ("no room", "", "unknown", "oom"), ("subprocess ended", "", "subprocess_nonzero", "subprocess_nonzero"), ("x", "file not found", "io_error", "io_error"), ("", "subprocess", "unknown", "unknown"), ("contract version", "", "contract_error", "contract_error")])
def test_error_kind(spark, message, stderr, by_word, by_substring):
    assert one(spark, S.error_kind(F.lit(message), F.lit(stderr))) == by_word
    assert one(spark, S.error_kind(F.lit(message), F.lit(stderr), by_substring=True)) == by_substring


@pytest.mark.parametrize("n,length", [(0, 1), (3, 1), (8, 1), (27, 3), (64, 4), (125, 5), (126, 6), (1000, 10), (1001, 11)])
def test_block_length(spark, n, length):
    cube = math.ceil(n ** (1 / 3) - 1e-9)
    want = max(1, n // 5) if n // max(cube, 1) < 5 else cube
    assert one(spark, S.block_length(F.lit(n))) == want == length


def test_text(spark):
    assert one(spark, S.tail_lines(F.lit("a\nb\nc"), 2)) == "b\nc"
    assert one(spark, S.tail_lines(F.lit("a"), 5)) == "a"
    assert one(spark, S.last_match(F.lit("loss=1 loss=2"), "loss=([0-9]+)")) == "2"
    assert one(spark, S.last_match(F.lit("none"), "loss=([0-9]+)")) is None
    assert one(spark, S.fold_name(F.lit(" Smoothed-Return "))) == "smoothedreturn"
    assert one(spark, S.fold_strategy(F.lit("Triple-Barrier"))) == "triple_barrier"
    assert one(spark, S.grid_name(F.lit("s"), [F.lit("a"), F.lit("b")])) == "s__a_b"
    assert one(spark, S.references(F.lit("${a.b}/${c}"))) == ["a.b", "c"]
    assert one(spark, S.is_sha256(F.lit("A" * 64))) is False
    assert one(spark, S.types_match(F.lit("a"), F.lit(""))) is None
    assert one(spark, S.overdue(F.lit(None), F.lit("2026-01-02"), "2026-01-01")) is True
    assert one(spark, S.position_of(F.array(F.lit(10), F.lit(60)), F.lit(60))) == 1
    assert one(spark, S.position_of(F.array(F.lit(10)), F.lit(5))) is None


def test_driver_side():
    with pytest.raises(ValueError):
        S.require_sha256("ABC")
    assert S.resolve({"a": {"b": 3}, "c": "${a.b}", "d": "x${c}y", "e": "${later.z}", "f": "${nope}"}, deferred=["later"]) == {"a": {"b": 3}, "c": 3, "d": "x3y", "e": "${later.z}", "f": "${nope}"}
    assert S.resolve({"a": "${now}"}, extra={"now": "e"}, builtin={"now": "b"}) == {"a": "b"}
    assert S.unresolved({"a": ["${x}", {"b": "${y}"}]}) == [("a[0]", "x"), ("a[1].b", "y")]
    assert S.failure_policy("retry:3") == ("retry", 3)
    with pytest.raises(ValueError):
        S.failure_policy("retry:0")
    assert S.truthy(" Yes ") and not S.truthy("0") and not S.truthy(None)
    assert S.rebase("data/x", "/root/p", "/root/p/trainer") == "../data/x"
    assert S.under_root("/a", "b/../c") == "/a/c"
    with pytest.raises(ValueError):
        S.under_root("/a", "../ab")
    assert S.close_match("learning_rte", ["learning_rate", "epochs"]) == "learning_rate"
    assert S.finite_tree({"a": [float("nan"), 1.0]}) == {"a": [None, 1.0]}
    with pytest.raises(ValueError):
        S.as_fraction(None, float("nan"))
