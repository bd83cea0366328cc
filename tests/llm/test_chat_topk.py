import compare
import numpy as np
import pytest
from conftest import SMALL

from basketflow.llm import chat, queries, topk

TURNS = "pair_id long, turn long, role string, text string"


def formatted(spark, chosen, rejected):
    frame = chat.format_preferences(spark.createDataFrame(chosen, TURNS), spark.createDataFrame(rejected, TURNS))
    return {r.pair_id: r for r in frame.collect()}


def test_common_turns_are_the_prompt(spark):
    u, a, b = (1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 2, "assistant", "no")
    row = formatted(spark, [u, a], [u, b])[1]
    assert row.prompt_turns == 1
    assert row.prompt == "<|user|>\nhi<|end|>\n"
    assert (row.chosen, row.rejected) == ("<|assistant|>\nyes<|end|>\n", "<|assistant|>\nno<|end|>\n")
    assert [tuple(m) for m in row.chosen_mask] == [(len(row.chosen), True)]


def test_odd_conversations(spark):
    same = [(1, 1, "user", "q"), (1, 2, "assistant", "a")]
    rows = formatted(
        spark,
        [*same, (2, 1, None, None), (3, 5, "user", "x"), (3, 5, "user", "x"), (None, 1, "user", "lost"), (4, 2, "b", ""),
         (4, None, "user", "lost"), (4, 1, "a", "é" * 5000)],
        [*same, (1, 3, "user", "more"), (5, 1, "assistant", "alone"), (3, 5, "user", "x")],
    )
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert (rows[1].prompt_turns, rows[1].chosen, rows[1].chosen_mask) == (2, "", [])
    assert [tuple(m) for m in rows[1].rejected_mask] == [(len(rows[1].rejected), False)]
    assert (rows[2].prompt, rows[2].chosen, rows[2].rejected) == ("", "<||>\n<|end|>\n", "")
    assert (rows[3].prompt_turns, rows[3].chosen, rows[3].rejected) == (1, "<|user|>\nx<|end|>\n", "")
    assert rows[4].chosen.startswith("<|a|>\né") and [m.learn for m in rows[4].chosen_mask] == [False, False]
    assert rows[5].rejected_mask[0].learn and rows[5].prompt_turns == 0
    for row in rows.values():
        for side in ("chosen", "rejected"):
            assert sum(m.length for m in row[f"{side}_mask"]) == len(row[side])
    assert formatted(spark, [], []) == {}


def test_main_path_has_no_python(spark):
    plan = queries.op9_preferences(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SMALL), compare.duck(SMALL), queries.ORACLE[name]) is None


def test_top_k_with_ties_gaps_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 7)
    rng = np.random.default_rng(1)
    data = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(40)]
    data += [(40, None), (41, [1.0, None]), (42, [float("nan")]), (43, [float("inf"), 1.0]), (None, [1.0] * 4)]
    data += [(44, [1.0]), (45, []), (46, [0.00123, 3.0, 1.0, 2.0, 9.0]), (5, data[5][1])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "2 AS q")
    vectors = topk.quantised(frame)
    found = topk.top_k(vectors.filter("vec_id % 4 = 0"), vectors, 6).collect()
    usable = [(i, v) for i, v in data if i is not None and v is not None and i not in (41, 42, 43)]
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in usable]
    expected = []
    for q, a in whole:
        if q % 4 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)[:6]
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_few_candidates_give_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    vectors = topk.quantised(spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema))
    assert [tuple(r) for r in topk.top_k(vectors.filter("vec_id = 0"), vectors).collect()] == [(0, 1, 1, 2048 * 1024)]
    assert topk.top_k(vectors.limit(0), vectors).count() == 0
    assert topk.top_k(vectors.filter("vec_id = 0"), vectors.filter("vec_id = 0")).count() == 0


def test_only_the_own_row_of_a_query_is_left_out(spark, monkeypatch):
    """Rows that share the query's id are candidates, and each row is a query."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 2)
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [3.0, -1 / 1024]), (0, [3.0, -2 / 1024]), (1, [2.0, 0.0]), (2, [2.0, 0.0])]
    vectors = topk.quantised(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    found = topk.top_k(vectors.filter("vec_id = 0"), vectors, 3).collect()
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in data]
    expected = []
    for n, (q, a) in enumerate(whole):
        if q == 0:
            others = [row for m, row in enumerate(whole) if m != n]
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in others)[:3]
            expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_large_components_do_not_wrap(spark):
    """-2**57 is the highest score; the products with row 2 and 3 are below any long."""
    data = [(0, [2.0**45, 0.25]), (1, [-4 / 1024, 0.0]), (2, [-(2.0**40), 0.0]), (3, [-(2.0**60), 1.0])]
    vectors = topk.quantised(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    found = topk.top_k(vectors.filter("vec_id = 0"), vectors, 1).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, -(2**57))]
