from hypothesis import given, settings
from hypothesis import strategies as st

from cirrus.llm import op1_chat as C

pieces = st.lists(st.sampled_from([*C.CONTROLS, "\\", "<", "|", "[", "a", "é", "\n", " ", "\U0001F600"]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(pieces, pieces), min_size=1, max_size=4))
def test_rendering_is_reversible(turns):
    text = C.render(turns)
    assert [(r, C.unescape(text[a:b])) for r, a, b in C.parse(text)] == turns
    for c in C.CONTROLS[3:]:
        assert c not in text


def test_mask_covers_exactly_the_assistant_text():
    t = C.load()
    turns = [("user", "hi  there"), ("assistant", " café \U0001F600\U0001F600 </s> x "), ("assistant", ""), ("user", "z")]
    text = C.render(turns)
    spans = [(a, b) for r, a, b in C.parse(text) if r == "assistant"]
    got = C.mask(t.encode(text).offsets, spans)
    assert "".join(C.unescape(text[a:b]) for *_, a, b in got) == turns[1][1]


def test_odd_conversations(spark):
    data = [(1, 0, "user", None), (1, 1, None, "x"), (2, 0, "assistant", ""), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"),
            (None, None, "assistant", "b"), (3, 1, "assistant", "later"), (3, 0, "user", "y" * 3000000)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in C.summaries(df).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in got.items()} == {1: (2, 0), 2: (3, 2), None: (1, 1), 3: (2, 5)}
    assert C.summaries(df.limit(0)).count() == 0
    one = C.formatted(df.where("conv_id = 3")).orderBy("block").collect()
    assert len(one) == 2 and all(len(r["ids"]) == len(r["loss"]) for r in one)
