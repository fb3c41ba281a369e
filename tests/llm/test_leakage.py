"""Leaks against a plain alignment of every item with every document."""

import random
import time

import numpy as np

from reelspark.llm import leakage, words


def plain(item, doc, least=15):
    """Whether ``least`` or more item words stand in ``doc`` with one edit in ten, first and last word kept."""
    for a in range(len(item)):
        rows = {(a, j): 0 for j in range(len(doc)) if doc[j] == item[a]}
        # fewest edits to have used item[a..i] up to doc[..j]
        for i in range(a, len(item)):
            if i > a:
                new = {}
                for (_, j), e in rows.items():
                    for to, cost in (((i, j + 1), 0 if j + 1 < len(doc) and doc[j + 1] == item[i] else 1), ((i, j), 1)):
                        if to[1] < len(doc) and e + cost <= len(item) // 10:
                            new[to] = min(new.get(to, 99), e + cost)
                for _ in range(len(item) // 10):
                    for (_, j), e in list(new.items()):
                        if j + 1 < len(doc) and e + 1 <= len(item) // 10:
                            new[(i, j + 1)] = min(new.get((i, j + 1), 99), e + 1)
                rows = new
            n = i - a + 1
            if n >= least and any(10 * e <= n and doc[j] == item[i] for (_, j), e in rows.items()):
                return True
    return False


def test_leaks_equal_plain(spark):
    r = random.Random(3)
    vocabulary = [f"{a}{b}{c}" for a in "bcdg" for b in "aeo" for c in "nm"]
    opening = [r.choice(vocabulary) for _ in range(9)]
    items = [opening + [r.choice(vocabulary) for _ in range(r.randint(3, 34))] for _ in range(8)]
    docs = []
    for _ in range(90):
        item = r.choice(items)
        a = r.randrange(len(item))
        part = item[a : a + r.randint(8, 40)]
        for _ in range(r.randint(0, 4)):
            k = r.randrange(len(part))
            part[k : k + r.randint(0, 1)] = [r.choice(vocabulary)] * r.randint(0, 1)
            part = part or ["ba"]
        docs.append([r.choice(vocabulary) for _ in range(r.randint(0, 12))] + part + [r.choice(vocabulary) for _ in range(r.randint(0, 12))])
    rows = [(i, " ".join(d).upper().replace("A", "Á"), 0) for i, d in enumerate(docs)] + [(900, None, 0), (901, "", 0), (902, " ".join(docs[0]), 0), (903, "ba " * 3000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    ev = spark.createDataFrame([(i, ", ".join(t), 1) for i, t in enumerate(items)] + [(50, None, 1), (51, "", 1)], "item_id long, text string, doc_id int")
    want = {(i, k) for i, d in [*enumerate(docs), (902, docs[0])] for k, t in enumerate(items) if plain(t, d)}
    found = leakage.leaks(df, ev)
    got = {(x.doc_id, x.item_id) for x in found.collect()}
    assert got == want and len(want) > 20
    for x in found.where("doc_id < 900").collect():  # the match is where it is said to be
        n = x.verbatim_words
        assert docs[x.doc_id][x.doc_word : x.doc_word + n] == items[x.item_id][x.item_word : x.item_word + n] and n >= 6 and x.passage_words >= 15
    assert leakage.clean(df, found).count() == len(rows) - len({d for d, _ in want})
    assert leakage.leaks(df.limit(0), ev).count() == 0 and leakage.leaks(df, ev.limit(0)).count() == 0


def test_suffix_array_equals_plain():
    r = np.random.default_rng(2)
    for _ in range(40):
        text = r.integers(0, 3, r.integers(1, 60)) * r.integers(1, 4)
        ends = np.append(np.flatnonzero(text == 0), len(text))
        plain = [tuple(text[i : ends[ends >= i][0]]) for i in range(len(text))]
        got = leakage.suffix_array(text)
        assert sorted(got) == list(range(len(text))) and [plain[i] for i in got] == sorted(plain)


def test_one_long_item_costs_its_own_words_only():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklm") for _ in range(5))
    texts = [" ".join(word() for _ in range(40)) for _ in range(3000)]
    long = " ".join(word() for _ in range(10_000))
    docs = [" ".join([word() for _ in range(60)] + texts[i].split()[5:30]) for i in range(0, 3000, 10)] + [long[2000:30_000]]
    seconds = []
    for extra in ([], [long]):
        items = leakage.Items(list(range(3000 + len(extra))), texts + extra, 15)
        leakage.search(items, docs[:5])
        began = time.perf_counter()
        found = leakage.search(items, docs)
        seconds.append(time.perf_counter() - began)
        assert set(zip(found[0].tolist(), found[1].tolist(), strict=True)) == {(k, 10 * k) for k in range(300)} | ({(300, 3000)} if extra else set())
    assert found[2].max() > 4000 and seconds[1] < 5 * seconds[0] + 1
    assert len(words.split(docs).key) > 20_000


def test_shortest_passages_are_found_in_long_items():
    """An edit in ten over hundreds of words: proven by a part of at most 32 words."""
    r = random.Random(8)
    for trial in range(30):
        item = [f"w{''.join(r.choice('abcdefgh') for _ in range(4))}" for _ in range(200)]
        doc, k = list(item), 0
        while k < 200:
            k += r.randint(8, 13)
            if k < 199:
                doc[k] = "zzz"
        found = leakage.search(leakage.Items([0], [" ".join(item)], 15), [" ".join(doc)])
        assert bool(len(found[0])) == plain(item, doc), trial
