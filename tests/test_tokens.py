import base64

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tests import brute
from trajspark.functions.text import estimate_tokens
from trajspark.operators import expand as P, tokens as T, usage as U
from trajspark.operators.quality import split_counted
from trajspark.plans import jobs as J
from trajspark.schemas import IMAGE_DIMS, TRAINING_ROW, TRAJECTORY
from trajspark.settings import MODELS, Model


def counted(spark, texts, counter=estimate_tokens):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, content string")
    rows = T.flat_message_tokens(frame, counter=counter).orderBy("i").collect()
    return [r.tokens for r in rows]


def test_message_rules(spark):
    assert counted(spark, ["<image>", "do<image>", None, "", "ab 12345"]) == [0, 4, 0, 0, 4]


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="aZé1٣ \n\t.#$\\`\"'😀é", max_size=40),
                      min_size=1, max_size=20))
def test_estimate_equals_pattern_matches(spark, texts):
    assert counted(spark, texts) == [
        0 if t == "<image>" else brute.tokens(t) for t in texts]


def test_distinct_counts(spark, exact):
    frame = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["abab"] * 50 + [None, "", "<image>", "x <|end|>"])],
        "i int, content string")
    got = {r.i: r.tokens for r in T.distinct_message_tokens(frame, ["i"], counter=exact).collect()}
    assert {got[i] for i in range(50)} == {2}
    assert [got[i] for i in range(50, 54)] == [0, 0, 0, None]


def test_hot_conversation_sum(spark):
    rows = [("hot", "a b")] * 500 + [("cold", "x")] + [("hot", "<image>")]
    frame = spark.createDataFrame(rows, "id string, content string")
    got = {r.id: r.text_tokens_0 for r in T.tokens_by_conversation(frame, ["id"]).collect()}
    assert got == {"hot": 1500, "cold": 1}


@pytest.fixture(scope="module")
def rank_file(tmp_path_factory):
    """All single bytes and a few merges, among them a full stop with line breaks."""
    path = tmp_path_factory.mktemp("ranks") / "tiny.tiktoken"
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"\n\n", b".\n\n", b"do", b" it"]
    path.write_text("".join(f"{base64.b64encode(p).decode()} {i}\n"
                            for i, p in enumerate(pieces)))
    return str(path)


SPLIT = r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n/]*|\s*[\r\n]+|\s+"


@pytest.fixture(scope="module")
def exact(rank_file):
    return T.exact_counter("tiny", rank_file, SPLIT, {"<|end|>": 999})


def tokenizer(rank_file):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    return tiktoken.Encoding("tiny", pat_str=SPLIT, mergeable_ranks=load_tiktoken_bpe(rank_file),
                             special_tokens={"<|end|>": 999})


def test_exact_counts_and_special_tokens(spark, exact, rank_file):
    enc = tokenizer(rank_file)
    texts = ["abab", "do it.\n\n", None, "", "<image>", "stop <|end|>", "abab"]
    want = [len(enc.encode(t)) if t and t != "<image>" and "<|end|>" not in t else 0
            for t in texts]
    want[5] = None
    assert counted(spark, texts, exact) == want


def dims(spark, rows=()):
    return spark.createDataFrame(list(rows), IMAGE_DIMS)


def chat(spark, rows):
    return spark.createDataFrame(
        [(i, 1, "L2", [("user", t) for t in texts], images)
         for i, texts, images in rows], TRAINING_ROW)


TWO = {"a": Model("enc-a", True, 1.0, 2.0, 1.0), "b": Model("enc-b", True, 1.0, 2.0, 2.0)}


def test_one_count_per_encoding(spark, exact, rank_file):
    enc = tokenizer(rank_file)
    rows = chat(spark, [("1", ["abab", "do it", "<image>"], []), ("2", ["bad <|end|>"], []),
                        ("3", [], []), ("4", ["x", None], None)])
    usage = J.row_usage(rows, dims(spark), TWO, {"enc-b": exact}, details=False)
    counted_rows, failed = split_counted(usage)
    got = {(r.task_id, r.model): r.text_tokens for r in counted_rows.collect()}
    assert got[("1", "a")] == 1 + 3
    assert got[("1", "b")] == len(enc.encode("abab")) + len(enc.encode("do it"))
    assert got[("3", "b")] == 0 and got[("4", "a")] == 1
    # The conversation that cannot be encoded is set aside, for that encoding only.
    assert [(r.task_id, r.model) for r in failed.collect()] == [("2", "b")]


TEXTS = ["do it.", "ends blank \n", "", " \n lead", "9", "#", "\u00e9\n#"]


@pytest.mark.parametrize("level,chunk", [("L1", 7), ("L3", 4), ("L3", 4096)])
def test_sizes_equal_counts_of_built_rows(spark, exact, level, chunk):
    """Both counters: step-wise sizes against the built text of every prefix."""
    tasks = [brute.task(f"long{i}", 13, text=t) for i, t in enumerate(TEXTS)]
    mixed = brute.task("mixed", len(TEXTS))
    for step, text in zip(mixed["traj"], TEXTS):
        step["value"].update(action=text, thought=text, observation=text)
    data = spark.createDataFrame(tasks + [mixed, brute.task("one", 1)], TRAJECTORY)
    counters = {"enc-b": exact}
    want = J.row_usage(P.training_rows(data, level), dims(spark), TWO, counters, details=False)
    got = J.trajectory_usage(data, dims(spark), level, TWO, counters, chunk=chunk, details=False)
    pick = ["task_id", "prefix_len", "model", "text_tokens"]
    assert sorted(got.select(pick).collect()) == sorted(want.select(pick).collect())


def test_uncountable_step_spoils_only_prefixes_that_repeat_it(spark, exact):
    tasks = brute.task("t", 12)
    tasks["traj"][5]["value"]["action"] = "press <|end|>"
    data = spark.createDataFrame([tasks], TRAJECTORY)
    models = {"b": TWO["b"]}
    for chunk in (4, 4096):
        got = J.trajectory_usage(data, dims(spark), "L2", models, {"enc-b": exact}, chunk=chunk)
        assert {r.prefix_len: r.text_tokens is None for r in got.collect()} == {
            n: n > 5 for n in range(1, 13)}
    # One step whose target alone fails takes out one prefix; a task without failures stays whole.
    tasks["traj"][2]["value"]["thought"] = "see <|end|>"
    two = spark.createDataFrame([tasks, brute.task("u", 5)], TRAJECTORY)
    want = U.usage_totals(J.trajectory_usage(two, dims(spark), "L2", models, {"enc-b": exact}),
                          models)
    got = J.trajectory_totals(two, dims(spark), "L2", models, {"enc-b": exact})
    assert got.collect() == want.collect()
    assert got.first().total_conversations == 4 + 5


def test_estimate_never_fails(spark):
    usage = J.row_usage(chat(spark, [("1", ["<|end|>"], [])]), dims(spark), details=False)
    assert usage.filter("text_tokens is null").count() == 0
    assert usage.count() == len(MODELS)


def test_flat_usage_equals_nested(spark):
    data = chat(spark, [("1", ["a b", "<image>"], ["x", "x", "gone"]), ("2", ["c"], [])])
    sizes = dims(spark, [("x", 1920, 1080, "ok")])
    want = J.row_usage(data, sizes, details=False)
    keys = list(U.ROW_KEYS)
    got = U.flat_usage(P.message_rows(data), P.image_rows(data), sizes, keys)
    cols = [*keys, "model", "text_tokens", "image_tokens", "image_count", "pricing"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_flat_usage_of_images_without_messages(spark):
    messages = spark.createDataFrame([("1", "a b")], "id string, content string")
    images = spark.createDataFrame([("2", "x"), ("2", "gone")], "id string, path string")
    got = U.flat_usage(messages, images, dims(spark, [("x", 1920, 1080, "ok")]), ["id"], TWO)
    assert sorted((r.id, r.model, r.text_tokens, r.image_tokens, r.image_count)
                  for r in got.collect()) == [
        ("1", "a", 3, 0, 0), ("1", "b", 3, 0, 0), ("2", "a", 0, 1105, 2), ("2", "b", 0, 2210, 2)]


def test_totals_leave_out_what_cannot_be_counted(spark, exact):
    rows = chat(spark, [("1", ["abab"], []), ("2", ["<|end|>"], [])])
    usage = J.row_usage(rows, dims(spark), TWO, {"enc-b": exact}, details=False)
    assert {r.model: r.total_conversations for r in U.usage_totals(usage, TWO).collect()} == {
        "a": 2, "b": 1}


def test_counts_are_shared_between_models(spark):
    counters, position = T.per_encoding(MODELS)
    assert len(counters) == 1 and set(position.values()) == {0}
    plan = U.row_sizes(chat(spark, []), dims(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_no_python_in_the_default_path(spark):
    data = spark.createDataFrame([brute.task("t", 5)], TRAJECTORY)
    for frame in (P.training_rows(data), J.trajectory_usage(data, dims(spark)),
                  J.trajectory_totals(data, dims(spark))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_training_rows_need_no_shuffle(spark):
    data = spark.createDataFrame([brute.task("t", 5)], TRAJECTORY)
    plan = P.training_rows(data, split_over=None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
