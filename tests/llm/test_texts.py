"""Words, repetition and packing against plain versions."""

import random
import unicodedata

import numpy as np
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from reelspark.llm import packing, repetition, words

ALPHABET = st.text(alphabet="ab Đđéĩ é\n1.-_²ßΣ", max_size=60)


def plain(text):
    return [x.lower() for x in regex.findall(r"\p{L}+", unicodedata.normalize("NFC", text or ""))]


def plain_share(text, length=8):
    w = plain(text)
    seen, hit = set(), set()
    for i in range(len(w) - length + 1):
        g = tuple(w[i : i + length])
        if g in seen:
            hit |= set(range(i, i + length))
        seen.add(g)
    return len(w), len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), ALPHABET), max_size=6))
def test_words_equal_plain(texts):
    w = words.split(texts)
    want = [plain(t) for t in texts]
    assert np.diff(w.first).tolist() == [len(x) for x in want]
    flat = [x for one in want for x in one]
    assert len(set(flat)) == len(set(w.key.tolist()))
    assert len(set(zip(flat, w.key.tolist()))) == len(set(flat))


def test_fold_drops_marks():
    a, b = words.split(["Đường phố", "duong pho", "étage ETAGE"], True), None
    assert a.key[0] == a.key[2] and a.key[1] == a.key[3] and a.key[4] == a.key[5] and b is None


def documents():
    r = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"]
    out = [None, "", "  \n", "one", "﻿"]
    for _ in range(120):
        text = [r.choice(vocabulary) for _ in range(r.randint(1, 90))]
        for _ in range(r.randint(0, 4)):
            k = r.randint(0, len(text))
            text[k:k] = text[max(0, k - r.randint(3, 15)) : k]
        out.append(" ".join(text))
    return out + ["so " * 5000, out[-1], out[-1]]


def test_repetition_equals_plain(spark):
    texts = documents()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, share int")
    want = {i: plain_share(t) for i, t in enumerate(texts)}
    got = {r.doc_id: (r.n_words, r.n_repeated) for r in repetition.share(df).collect()}
    assert got == want
    for least in (0.05, 0.3, 0.9):
        got = {r.doc_id for r in repetition.share(df, least=least).collect()}
        assert got == {i for i, (n, c) in want.items() if n and c / n >= least}
    assert repetition.share(df.limit(0), least=0.3).count() == 0


def test_first_fit_equals_plain():
    r = random.Random(1)
    for _ in range(50):
        capacity = r.randint(1, 30)
        items = [r.randint(1, capacity) for _ in range(r.randint(0, 40))]
        bins, want = [], []
        for x in items:
            b = next((i for i, held in enumerate(bins) if held + x <= capacity), len(bins))
            if b == len(bins):
                bins.append(0)
            bins[b] += x
            want.append(b)
        assert packing.first_fit(items, capacity) == want


def test_packing_keeps_everything(spark):
    texts = documents()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, container int")
    enc = packing.encoder(packing.TOKENIZER)
    size = {i: len(enc.encode_ordinary(t)) for i, t in enumerate(texts) if t}
    rows = packing.pack(df, {"a": 40, "b": 700}).collect()
    for name, capacity in (("a", 40), ("b", 700)):
        mine = [r for r in rows if r.size_name == name]
        held, per = {}, {}
        for r in mine:
            held[r.container] = held.get(r.container, 0) + r.n_tokens
            per.setdefault(r.doc_id, []).append(r)
        assert max(held.values()) <= capacity
        assert {i: sum(x.n_tokens for x in p) for i, p in per.items()} == size
        assert all(len(p) == -(-size[i] // capacity) == p[0].n_pieces for i, p in per.items())
        assert len(held) <= 1.3 * sum(size.values()) / capacity + 1
    assert packing.pack(df.limit(0), {"a": 40}).count() == 0
    assert {r.size_name: r.n_tokens for r in packing.filling(packing.pack(df, {"a": 40})).collect()} == {"a": sum(size.values())}
