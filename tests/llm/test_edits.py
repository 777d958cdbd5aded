"""Edit-aware counts against counting the edited text anew."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from starling.llm import bpe, edits

PIECES = ["the", " ", "  ", "\n", "don't", "<|endoftext|>", "<|", "é", "é", "́", "x1", "\t ", "ing", "Σ", ".", "日本"]
texts = st.lists(st.sampled_from(PIECES), max_size=120).map("".join)
changes = st.lists(st.tuples(st.integers(-3, 300), st.integers(-2, 200), st.lists(st.sampled_from(PIECES), max_size=4).map("".join)),
                   max_size=5)


def full(text):
    return sum(map(len, bpe.tokenizer().encode(text)))


def apply(text, at, removed, inserted):
    at = max(0, min(at, len(text)))
    return text[:at] + inserted + text[at + max(0, min(removed, len(text) - at)):]


@settings(max_examples=300, deadline=None)
@given(texts, changes)
def test_tree_equals_full_count(text, edit_list):
    tree = edits.TokenTree(text, edits.Counter(bpe.tokenizer()))
    for e in edit_list:
        text = apply(text, *e)
        tree.edit(*e)
        assert tree.text() == text and tree.n_chars == len(text)
        assert tree.n_tokens == full(text) == sum(map(sum, tree.tokens))


def test_only_the_region_is_encoded_again():
    text = " ".join(f"word{i}" for i in range(5000))
    tree = edits.TokenTree(text, edits.Counter(bpe.tokenizer()))
    tree.edit(20_000, 5, "new words here")
    assert tree.encoded <= 6 and tree.n_tokens == full(tree.text())


def test_query_form_and_cases(spark):
    rnd = random.Random(1)
    rows = [(1, None, None), (2, "", [(0, 0, "a b")]), (3, "solo", [(None, None, None), (99, 5, " end")]),
            (4, " ".join(rnd.choice(PIECES) for _ in range(3000)), [(100, 50, "x"), (5, 9999, "")]), (4, "a", [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<at:long,removed:long,inserted:string>>")
    got = edits.count_edited(df).collect()
    assert len(got) == 5
    for r, (i, t, changes) in zip(got, rows):
        text = t or ""
        assert (r["doc_id"], r["n_chars"], r["n_tokens"]) == (i, len(text), full(text))
        for a, n, s in changes or []:
            text = apply(text, a or 0, n or 0, s or "")
        assert (r["n_chars_edited"], r["n_tokens_edited"]) == (len(text), full(text))
        assert r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    empty = spark.createDataFrame([], df.schema)
    assert edits.count_edited(empty).collect() == []
