import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer as Library

from strataloom.llm.bpe import Tokenizer, slices, texts_of, token_ids
from strataloom.llm.packing import best_fill, pack, packed
from strataloom.session import tokenizer_dir

TEXTS = ["", " ", "Hello, world!\r\n", "a" * 3000, "ab" * 900, " " * 2001 + "x", "<|endoftext|> it's", "é́" * 40 + "日本語 🙂\x00", "def f(x):\n    return x  # ok", "1234567890" * 60, "I'll we've 'S"]


@pytest.fixture(scope="module")
def own():
    return Tokenizer(tokenizer_dir())


@pytest.fixture(scope="module")
def library():
    t = Library.from_file(os.path.join(tokenizer_dir(), "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_are_the_librarys(own, library):
    assert own.encode([None, *TEXTS]) == [[]] + [library.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert own.decode(own.encode(TEXTS)) == TEXTS


def test_long_words_are_joined_at_their_seams(own, library):
    draw = random.Random(1)
    letters = ["abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ab", "中文字符测试语言模型数据", "аеиостнрлвк", "=-_", "ingtherationINGTION"]
    texts = ["".join(draw.choice(a) for _ in range(n)) for a in letters for n in (390, 401, 1300, 6000)]
    texts += ["x" * 5000, " " * 3000, "international" * 300, "a" * 399 + "é" * 500]
    assert own.encode(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert own.decode(own.encode(texts)) == texts


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(own, library, text):
    ids = own.encode([text])
    assert ids[0] == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == [text]


def test_slices_cover_all_texts():
    texts = ["x" * 10, None, "y" * 100, "", "z"]
    assert [i for a, b in slices(texts, 50) for i in range(a, b)] == list(range(5))


def test_documents(spark, library):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r["doc_id"], list(r["ids"])) for r in token_ids(docs).collect()), key=str)
    ab = library.encode("a b", add_special_tokens=False).ids
    assert got == sorted([(1, ab), (1, ab), (2, []), (None, [])], key=str)
    assert sorted(r["text"] for r in texts_of(token_ids(docs)).collect()) == ["", "", "a b", "a b"]
    assert token_ids(docs.limit(0)).isEmpty()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7), st.integers(0, 40))
def test_fill_is_the_best(sizes, room):
    lengths = sorted(set(sizes), reverse=True)
    chosen, slack = best_fill(lengths, [sizes.count(x) for x in lengths], room)
    sums = {0}
    for s in sizes:
        sums |= {x + s for x in sums if x + s <= room}
    assert room - slack == max(sums) == sum(n * x for n, x in zip(chosen, lengths))
    assert all(n <= sizes.count(x) for n, x in zip(chosen, lengths))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=40), st.integers(1, 16))
def test_packing_is_whole(sizes, capacity):
    out = pack(sizes, capacity)
    assert all(sum(n for _, _, n in c) <= capacity for c in out)
    parts = {}
    for c in out:
        for item, start, n in c:
            parts.setdefault(item, []).append((start, n))
    assert set(parts) == set(range(len(sizes)))
    for item, size in enumerate(sizes):
        spans = sorted(parts[item])
        assert sum(n for _, n in spans) == size and (len(spans) == 1 or size > capacity)
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_packed_table(spark):
    items = spark.createDataFrame([(i % 90, (i * 37) % 61) for i in range(400)] + [(None, None), (7, 1000)], "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([("s", 64), ("l", 256), ("l", 256), ("bad", 0), ("none", None)], "container_kind string, capacity_tokens int")
    rows = packed(items, kinds).collect()
    total = sum((i * 37) % 61 for i in range(400)) + 1000
    for kind, capacity in (("s", 64), ("l", 256)):
        own = [r for r in rows if r["container_kind"] == kind]
        assert sum(r["n_tokens"] for r in own) == total
        used = {}
        for r in own:
            used[r["container_id"]] = used.get(r["container_id"], 0) + r["n_tokens"]
        assert max(used.values()) <= capacity and total / (len(used) * capacity) > 0.97
    assert {r["container_kind"] for r in rows} == {"s", "l"}
    assert packed(items.limit(0), kinds).isEmpty() and packed(items, kinds.limit(0)).isEmpty()


def test_nothing_is_lost_and_little_is_left(spark):
    from strataloom.llm.queries import p9_fill, p9_faults

    folder = "/root/testdata/sf0.01"
    assert {tuple(r)[2:] for r in p9_faults(spark, folder).collect()} == {(0, 0, 0, 0)}
    assert all(r["fill"] > 0.97 for r in p9_fill(spark, folder).collect())
