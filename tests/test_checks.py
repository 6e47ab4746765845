import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfsight import config
from shelfsight.functions import ordering
from shelfsight.operators import checks, engine
from shelfsight.operators.checks import Step, register
from shelfsight.operators.engine import CheckSpec, run_check, run_checks


@pytest.fixture
def copies(frame):
    return frame(
        "k string, y int, at int",
        ("a", 1, 1), ("a", 1, 2), ("a", 1, 3), ("b", 1, 4), (None, 1, 5), (None, 1, 6), ("c", None, 7),
    )


@pytest.mark.parametrize("keep, bad", [("first", [2, 3, 6]), ("last", [1, 2, 5]), (False, [1, 2, 3, 5, 6])])
def test_duplicate_keeps_the_chosen_row(copies, keep, bad):
    passing, rejected = run_check(copies, "duplicate", keys=["k", "y"], order=["at"], keep=keep)
    assert [r[0] for r in rows(rejected, "at")] == bad
    assert passing.count() + rejected.count() == copies.count()
    assert {r.failure_reason for r in rejected.collect()} == {"duplicate_on:k+y"}


def test_duplicate_without_its_columns_rejects_nothing(copies):
    for keys in ([], ["nope"]):
        assert run_check(copies, "duplicate", keys=keys, order=["at"])[1].count() == 0


def test_duplicate_plan_has_no_window(copies, capsys):
    run_check(copies, "duplicate", keys=["k"], order=["at"])[0].explain()
    assert "Window" not in capsys.readouterr().out


def test_null_lists_all_columns_and_sees_blanks(frame):
    df = frame("id int, a string, b double", (1, "x", 1.0), (2, " \t", 1.0), (3, None, None), (4, "x", float("nan")))
    _, bad = run_check(df, "null", mandatory_cols=["a", "b", "missing"])
    assert rows(bad, "id", "failure_reason") == [(2, "null_in:a"), (3, "null_in:a,b"), (4, "null_in:b")]


def test_referential_integrity(frame):
    ref = frame("r string", ("a",), ("a",), (None,))
    df = frame("id int, fk string", (1, "a"), (2, "z"), (3, None))
    ok, bad = run_check(df, "referential_integrity", fk_col="fk", ref_df=ref, ref_col="r")
    assert rows(ok, "id") == [(1,)] and rows(bad, "id") == [(2,), (3,)]


@pytest.mark.parametrize("inclusive, bad", [(True, [1, 4]), (False, [1, 2, 3, 4])])
def test_value_range(frame, inclusive, bad):
    df = frame("id int, v string", (1, "0"), (2, "1"), (3, "5"), (4, "abc"), (5, None), (6, "3"))
    _, rejected = run_check(df, "value_range", col="v", min_=1, max_=5, inclusive=inclusive)
    assert [r[0] for r in rows(rejected, "id")] == bad


def test_format_types(frame):
    df = frame("id int, v string", (1, "1.0"), (2, "1.5"), (3, "x"), (4, None), (5, "1d"), (6, "1e2"))
    assert [r[0] for r in rows(run_check(df, "format", col="v", dtype="int")[1], "id")] == [2, 3, 5]
    assert [r[0] for r in rows(run_check(df, "format", col="v", dtype="float")[1], "id")] == [3, 5]
    days = frame("id int, v string", (1, "2024-01-05"), (2, "20240105"), (3, "soon"), (4, None), (5, "2024-13-01"))
    assert [r[0] for r in rows(run_check(days, "format", col="v", dtype="datetime")[1], "id")] == [3, 5]


def test_format_pattern_matches_as_a_whole(frame):
    df = frame("id int, v string", (1, "ab"), (2, "ab\n"), (3, "xab"), (4, None), (5, "cd"))
    assert [r[0] for r in rows(run_check(df, "format", col="v", regex="ab|cd")[1], "id")] == [2, 3, 4]


def test_coordinate_swap(frame):
    df = frame("id int, latitude double, longitude double", (1, 80.0, 7.0), (2, 7.0, 80.0), (3, 0.0, 0.0), (4, None, 7.0))
    ok, bad = run_check(df, "coord_swap_fix")
    assert rows(ok) == [(1, 7.0, 80.0), (2, 7.0, 80.0), (3, 0.0, 0.0), (4, None, 7.0)] and bad.count() == 0
    assert rows(run_check(df, "coord_swap_fix", autofix=False)[1], "id") == [(1,)]


def test_text_normalize(frame):
    df = frame("id int, t string", (1, " GROCRY\t"), (2, "  "), (3, " Corner Shop "), (4, None))
    ok, _ = run_check(df, "text_normalize", col="t", mapping=config.OUTLET_TYPES)
    assert rows(ok) == [(1, "Grocery"), (2, ""), (3, "Corner Shop"), (4, None)]


def test_negative_volume(frame):
    ok, _ = run_check(frame("v double", (-1.0,), (1.0,), (None,)), "negative_volume_tag", value_col="v")
    assert rows(ok) == [(None, False), (-1.0, True), (1.0, False)]


def test_low_volume(frame):
    df = frame("g string, v double", *[("a", float(i)) for i in range(1, 12)], (None, 1.0), ("a", None))
    ok, _ = run_check(df, "low_volume_month_tag", group_keys=["g"], value_col="v")
    assert rows(ok.where("_low_volume_month_flag"), "v") == [(1.0,), (2.0,), (3.0,)]
    assert ok.count() == 13


def test_credit_cap(frame):
    df = frame(
        "g string, v double", *[("a", 100.0)] * 5, *[("a", 7.0)] * 5, *[("b", 100.0)] * 4, *[(None, 500.0)] * 5, ("a", -100.0)
    )
    ok, _ = run_check(df, "credit_cap_signature", group_keys=["g"], value_col="v")
    flagged = ok.where("_credit_cap_flag").groupBy("g").count()
    assert rows(flagged) == [(None, 5), ("a", 5)]


def brute_runs(values, min_run):
    out, start = set(), 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] is None or values[i] != values[start]:
            if i - start >= min_run and values[start] not in (None, 0):
                out |= set(range(start, i))
            start = i
    return out


@pytest.fixture(params=[1, 5, 23, 60])
def pieces(spark, request):
    """That many ranges of rows, and no merging of small ones."""
    settings = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_constant_run_across_pieces(frame, pieces):
    rng = random.Random(pieces)
    data, want = [], set()
    for g, size in (("a", 60), ("b", 60), ("c", 200), ("d", 3)):
        values = []
        while len(values) < size:
            values += [rng.choice([0.0, 1.0, 2.0, None])] * rng.choice([1, 2, 6, 7, 9])
        want |= {(g, i) for i in brute_runs(values, 7)}
        data += [(g, i, v) for i, v in enumerate(values)]
    df = frame("g string, at int, v double", *data)
    _, bad = run_check(df, "constant_run", group_keys=["g"], order=["at"], value_col="v", min_run=7)
    assert {(r.g, r.at) for r in bad.collect()} == want


def test_one_group_at_one_moment_is_many_tasks(frame, pieces):
    """All rows in one group, and one run through all of it."""
    df = frame("g string, at int, v double", *[("a", i, 1.0 if i else 2.0) for i in range(600)])
    _, bad = run_check(df, "constant_run", group_keys=["g"], order=["at"], value_col="v", min_run=599)
    assert bad.count() == 599
    cut = ordering.in_ranges(df, ["g", "at"], "test").groupBy("_part").count().collect()
    assert len(cut) == pieces and max(r["count"] for r in cut) <= 3 * 600 / pieces + 3


def test_blackout(frame):
    day = dt.date(2024, 1, 1)
    df = frame(
        "d string, day date, o string, v double",
        *[("x", day, f"o{i}", 0.0) for i in range(19)], ("x", day, "o19", 5.0),
        ("y", day, "o1", 0.0), ("y", day, "o1", 3.0), ("y", day, "o2", 0.0),
    )
    _, bad = run_check(
        df, "distributor_blackout", distributor_col="d", date_col="day", outlet_col="o", value_col="v"
    )
    assert {r.d for r in bad.collect()} == {"x"} and bad.count() == 20


def test_checks_see_only_survivors_and_rejects_keep_their_values(frame):
    df = frame("id int, k string, t string, n int", (1, "a", None, 1), (2, "a", " GROCRY", 1), (3, "a", "x", 1), (4, "b", "grocry", 500))
    result = run_checks(
        df,
        "demo",
        [
            CheckSpec("null", {"mandatory_cols": ["t"]}),
            CheckSpec("duplicate", {"keys": ["k"], "order": ["id"]}),
            CheckSpec("text_normalize", {"col": "t", "mapping": config.OUTLET_TYPES}),
            CheckSpec("no_such_check", {}),
            CheckSpec("value_range", {"col": "n", "min_": 0, "max_": 100}),
        ],
    )
    assert rows(result.passing) == [(2, "a", "Grocery", 1)]
    assert rows(result.rejected, "id", "t", "_check", "_dataset") == [
        (1, None, "null", "demo"), (3, "x", "duplicate", "demo"), (4, "Grocery", "value_range", "demo"),
    ]
    summary = rows(result.summary, "step", "check", "rows_before", "rows_rejected", "rows_after")
    assert summary == [(0, "null", 4, 1, 3), (1, "duplicate", 3, 1, 2), (2, "text_normalize", 2, 0, 2), (3, "value_range", 2, 1, 1)]


def test_reason_is_appended(frame):
    df = frame("v int, failure_reason string", (500, "before"), (500, None), (1, "before"))
    _, bad = run_check(df, "value_range", col="v", min_=0, max_=10)
    assert rows(bad, "failure_reason") == [("before | range_violation:v[0,10]",), ("range_violation:v[0,10]",)]


def test_user_check(frame):
    @register("odd", row_local=True)
    def odd(df, live, col):
        return Step(df, F.col(col) % 2 == 1, F.lit("odd"))

    assert "odd" in checks.available_checks()
    assert rows(run_check(frame("v int", (1,), (2,)), "odd", col="v")[1]) == [(1, "odd")]


def test_specs_without_columns_are_left_out():
    specs = [CheckSpec("value_range", {"col": "x"}), CheckSpec("null", {"mandatory_cols": ["x", "y"]}), CheckSpec("duplicate", {"keys": ["z"]})]
    assert [s.name for s in engine.fit_to_columns(specs, ["y"])] == ["null"]


def test_union_of_rejects(frame):
    u = engine.union_rejects([frame("a int", (1,)), frame("b int", (2,))])
    assert rows(u) == [(None, 2), (1, None)]


@pytest.mark.parametrize("most", [1, 3, 100_000])
@pytest.mark.parametrize("keep", ["first", "last"])
def test_duplicate_by_an_order_of_several_columns(spark, most, keep):
    """Keys with more copies than ``most`` are judged another way, with the same verdicts; rejected rows judge nobody."""
    given = [(k, y, a, b, a * 7 % 5) for k in ("x", "y", None) for y in (1, None) for a in range(2) for b in range(3 if k else 1)]
    df = spark.createDataFrame([*given, ("x", 1, -1, 9, 99), ("one", 1, 0, 0, 0)], "k string, y int, a int, b int, v int")
    specs = [CheckSpec("value_range", {"col": "v", "max_": 50}), CheckSpec("duplicate", {"keys": ["k", "y"], "order": ["a", "b"], "keep": keep, "most": most})]
    result = run_checks(df, "demo", specs)
    groups = {}
    for k, y, a, b, _ in given:
        groups.setdefault((k, y), []).append((a, b))
    kept = {(k, y, *(min(v) if keep == "first" else max(v))) for (k, y), v in groups.items()} | {("one", 1, 0, 0)}
    assert {tuple(r)[:4] for r in result.passing.collect()} == kept
    assert result.rejected.count() == len(given) + 2 - len(kept) and result.tagged.columns == [*df.columns, "_failed_step", "failure_reason"]


def test_duplicate_takes_one_shuffle_of_the_rows(frame):
    df = frame("k string, a int, b int", ("x", 1, 1), ("x", 1, 2), ("y", 1, 1))
    plan = run_check(df.repartition("b"), "duplicate", keys=["k"], order=["a", "b"])[1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
