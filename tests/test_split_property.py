"""Round trip: any objects, any layout, split back to the same objects."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from bibflow.sources.json_text import split_records

# Strings full of the characters that break naive splitters.
tricky = st.text(alphabet=st.sampled_from(list('{}[]",:\\ \n\tabcé')), max_size=12)
scalars = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6), tricky)
values = st.recursive(scalars, lambda inner: st.one_of(
    st.lists(inner, max_size=3), st.dictionaries(tricky, inner, max_size=3)), max_leaves=8)
objects = st.dictionaries(tricky, values, max_size=4)


def render(objs, layout):
    if layout == "concat":
        return "".join(json.dumps(o) for o in objs)
    if layout == "pretty":
        return "\n".join(json.dumps(o, indent=2, ensure_ascii=False) for o in objs)
    if layout == "ndjson":
        return "\n".join(json.dumps(o) for o in objs) + "\n"
    return json.dumps(objs, indent=1)


@settings(max_examples=300, deadline=None)
@given(st.lists(objects, max_size=6), st.sampled_from(["concat", "pretty", "ndjson", "array"]))
def test_split_round_trip(objs, layout):
    out = list(split_records(render(objs, layout)))
    assert all(err is None for _, _, err in out)
    assert [json.loads(rec) for _, rec, _ in out] == objs
    assert [pos for pos, _, _ in out] == list(range(len(objs)))


@settings(max_examples=200, deadline=None)
@given(st.lists(objects, min_size=1, max_size=5), st.integers(min_value=1, max_value=40))
def test_truncation_keeps_complete_prefix(objs, cut):
    text = "".join(json.dumps(o) for o in objs)
    cut = min(cut, len(json.dumps(objs[-1])) - 1)
    out = list(split_records(text[: len(text) - cut]))
    good = [json.loads(r) for _, r, e in out if e is None]
    # Every record before the damaged last one survives, nothing is invented.
    assert good[: len(objs) - 1] == objs[: len(good[: len(objs) - 1])]
    assert len(good) <= len(objs)
    assert sum(1 for _, _, e in out if e is not None) <= 1
