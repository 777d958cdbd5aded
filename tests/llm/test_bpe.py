"""The transducer against the public library, and its lookahead."""

import gc
import hashlib
import random
import time

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starling.llm import bpe
from starling.llm.common import record_batch, slices

LIBRARY = Tokenizer.from_file(bpe.default_vocabulary())
PIECES = ["the", "ing", "er", "tion", " ", "\n", "'s", "'LL", "1", "٣", "é", "é", "Σ", "İ", "ﬁ", "🙂", "日", "\x00", "\x1c",
          "\x85", "​", "<|endoftext|>", "<|", "***", "_", "A", "ẞ"]


def check(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    tok = bpe.tokenizer()
    assert [i for w in tok.encode(text) for i in w] == want
    decoded = LIBRARY.decode(want, skip_special_tokens=False)
    assert "".join(tok.decode(want)) == decoded
    assert bpe._digest(tok, text) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest(),
                                      hashlib.sha256(decoded.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60).map("".join) | st.text(max_size=60))
def test_equals_the_library(text):
    check(text)


def test_characters_of_other_unicode_versions():
    """Letters, numbers, cases and marks that the library's Unicode data has not, or has alone."""
    for text in (":\U00012550", "a\u0558b", "x\U000323b0y", "1\u1c891", "a\ua7dab", ":\U00012475:", "a\u0327\u0334\U00010efd",
                 "a\u0301\u1ac5\u0334", "\u1ac5\u0327", "a\u0301\u0c3c"):
        check(text)


def test_text_beyond_ascii_is_not_slow():
    """Thousands of characters of other Unicode data cost ordinary text no look at each."""
    tok = bpe.tokenizer()
    text = " ".join(f"größe{i}é日本" for i in range(4_000))
    began = time.process_time()
    assert tok.normalise(text) == text
    tok.pre_tokens(text[:20_000])
    assert time.process_time() - began < 0.2  # 2 s and more with single characters in the classes


def test_ranges():
    characters = {chr(c) for c in (93, 94, 45, 0x3042, 0x3043, 0x3044, 0x20000, 0x20001)}
    assert bpe.ranges(characters).count("-") == 4
    pattern = bpe.one_of(characters)
    assert all(bool(pattern.search("a" + chr(c))) == (chr(c) in characters) for c in (*range(256), *range(0x3000, 0x3100), *range(0x1FF00, 0x20100)))
    assert not bpe.one_of(set()).search("a")


def test_long_runs_and_texts():
    rnd = random.Random(1)
    check("".join(rnd.choice("aeinthrs") for _ in range(60_000)))  # one pre-token over several windows
    check(" ".join(rnd.choice(PIECES) * 3 for _ in range(30_000)))  # several blocks


def test_window_is_bounded_and_stable():
    """Emitting after the sufficient lookahead gives the whole pre-token's tokens."""
    merges = [("a", "b"), ("b", "a"), ("ab", "ab"), ("aba", "b"), ("a", "ba"), ("abab", "abab"), ("b", "b")]
    ids = {s: i for i, s in enumerate(["a", "b", *dict.fromkeys(x + y for x, y in merges), "aba"])}
    merged = {ids[a] << 32 | ids[b]: r << 32 | ids[a + b] for r, (a, b) in reversed([*enumerate(merges)])}
    sizes = [0] * (max(ids.values()) + 1)
    for s, i in ids.items():
        sizes[i] = len(s)
    look = bpe.sufficient_lookahead(merges)
    machine = bpe.StreamingBpe(merged, sizes, look)
    rnd = random.Random(2)
    for _ in range(200):
        symbols = [ids[rnd.choice("ab")] for _ in range(rnd.randint(0, 12 * look))]
        assert [*machine.tokens(symbols)] == machine._merge_long(symbols)


def test_documents(spark):
    texts = [None, "", "Hello World!", "Hello World!", "x" * 3000]
    df = spark.createDataFrame([(i, t, "ids") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = bpe.round_trip(df).collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in rows] == [
        (i, len(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)]
    encoded = bpe.encode_documents(df)
    assert [r["ids"] for r in encoded.collect()][2] == LIBRARY.encode("Hello World!", add_special_tokens=False).ids
    assert [r["text"] for r in bpe.decode_documents(encoded).collect()][2] == "hello</w> world</w> !</w>"
    assert bpe.round_trip(df.limit(0)).collect() == []


def test_a_stage_shares_a_tokenizer_and_later_stages_do_not_keep_it(spark):
    docs = spark.range(64).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(32)

    def used(batches):
        for b in slices(batches):
            tok = bpe.tokenizer()
            tok.tasks = getattr(tok, "tasks", 0) + 1
            yield record_batch({"n": ([tok.tasks], pa.int64())})

    def left(batches):
        for _ in slices(batches):
            yield record_batch({"n": ([sum(isinstance(x, bpe.WordBpeTokenizer) for x in gc.get_objects())], pa.int64())})

    assert max(r["n"] for r in docs.mapInArrow(used, "n long").collect()) > 1
    assert {r["n"] for r in docs.mapInArrow(left, "n long").collect()} == {0}


def test_cached_ids_are_one_object_each():
    tok = bpe.tokenizer()
    known = {id(i) for i in tok.strings}
    assert all(id(i) in known for word in tok.encode("unbelievable thermodynamics, un-thermodynamic 12345") for i in word)
