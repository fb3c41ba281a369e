"""Evaluation passages inside training documents, found with suffix arrays.

The documents are read in shards. Of each shard the stretches of words that are covered by sequences of ``SEED`` words of
some item are put into a suffix array (a match of ``SEED`` or more words lies within such a stretch), and every item suffix
that can be there is binary-searched in it. That gives the verbatim matches, their places and, word by word as far as they go,
their lengths. A match of ``least_words`` is a leak; around every shorter one that cannot be extended to the left an alignment
decides whether at least ``least_words`` consecutive item words stand there with at most one word in ten changed, missing or
added. The first and the last word of such a passage must be in the document.

Words are folded: case, punctuation, spacing, digits and diacritics do not matter. ``SEED`` loses nothing: a passage of
15 to 19 words may hold one edit, one of 20 or more words one for each ten, and in every case six words in a row are left.
Nor does the alignment lose anything by looking at few words to either side and at three edits: if a passage can be cut
before one of its matching words into two parts of ``least_words`` or more, one of them has no more edits for its length than
the whole, so the shortest passage that proves a leak has at most (2 * 15 - 1) / 0.9, or 32 words. The work on a match
therefore depends neither on the length of its item nor on that of any other.

Defined results: null, empty and blank texts on either side match nothing; repeated documents or items each match for
themselves; extra columns are dropped; empty tables give an empty result. An item shorter than ``least_words`` never
matches. No shuffle; the items are sent to all tasks in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from reelspark.llm import words

SEED = 6
#: Words of items sent to the tasks at once (about 40 bytes each); a larger set takes more passes over the documents.
BLOCK_WORDS = 2_000_000
#: Pairs of places looked at, and pairs aligned, in one vectorised step, and words compared at a time.
PAIRS, ALIGN_STEP, STRIDE = 200_000, 4096, 16


class Items:
    """The folded words of the items and all their suffixes, as numbers."""

    def __init__(self, ids: list, texts: list[str | None], least_words: int) -> None:
        w = words.split(texts, fold=True)
        self.ids, self.least = ids, least_words
        #: Words to either side of a match that can belong to the shortest passage around it, and the edits in that.
        longest = int((2 * least_words - 1) / 0.9)
        self.around, self.edits = longest - SEED, max(1, longest // 10)
        self.vocabulary = np.unique(w.key)
        self.word = (np.searchsorted(self.vocabulary, w.key) + 1).astype(np.int32)
        self.first = w.first
        self.item = np.repeat(np.arange(len(ids)), np.diff(w.first)).astype(np.int32)
        end = self.first[self.item + 1]
        places = np.arange(len(self.word))
        starts = places[(end - places >= SEED) & (np.diff(w.first)[self.item] >= least_words)]
        gram = words.grams(w.key, SEED)[starts] if len(starts) else np.empty(0, np.uint64)
        order = np.argsort(gram, kind="stable")
        self.starts, gram = starts[order], gram[order]
        new = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.empty(0, np.int64)
        self.grams, self.gram_first = gram[new], np.append(new, len(gram))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The places of ``text`` in the order of the suffixes that begin there, by prefix doubling. 0 ends a suffix."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    ends = np.flatnonzero(text == 0)
    reach = np.append(ends, n)[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # words left
    order, depth = np.argsort(rank, kind="stable"), 1
    while depth <= reach.max(initial=0):
        then = np.where(reach > depth, rank[np.minimum(np.arange(n) + depth, n - 1)] + 1, 0)
        key = rank * (n + 2) + then
        order = np.argsort(key, kind="stable")
        now = np.cumsum(np.concatenate([[False], key[order][1:] != key[order][:-1]]))
        if now[-1] == rank.max():  # no order is left open that more words would settle
            break
        rank = np.empty(n, np.int64)
        rank[order] = now
        depth *= 2
    return order


def _compare(text: np.ndarray, at: np.ndarray, items: Items, p: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 as the ``SEED`` words of ``text`` from ``at`` come before, equal or come after those of the items from ``p``."""
    out = np.zeros(len(at), np.int8)
    for k in range(SEED):
        a, b = text[np.minimum(at + k, len(text) - 1)], items.word[p + k]
        out = np.where(out == 0, np.sign(a.astype(np.int64) - b), out)
    return out


def _search(text: np.ndarray, order: np.ndarray, items: Items, p: np.ndarray, right: bool) -> np.ndarray:
    """Where in the suffix array the suffixes that begin with the first ``SEED`` words of the item suffixes ``p`` begin or end."""
    low, high = np.zeros(len(p), np.int64), np.full(len(p), len(order))
    while (low < high).any():
        middle = (low + high) // 2
        side = _compare(text, order[np.minimum(middle, len(order) - 1)], items, p)
        after = (side < 0) | (right & (side == 0))
        going = low < high
        low, high = np.where(going & after, middle + 1, low), np.where(going & ~after, middle, high)
    return low


def matches(items: Items, w: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word places in items and in documents where a verbatim match of ``SEED`` or more words begins that cannot be
    extended to the left, the length of each, and the documents' words as item words (0: in no item)."""
    none = np.empty(0, np.int64)
    if len(w.key) < SEED or not len(items.grams):
        return none, none, none, none
    n = len(w.key)
    where = np.minimum(np.searchsorted(items.vocabulary, w.key), len(items.vocabulary) - 1)
    word = np.where(items.vocabulary[where] == w.key, where + 1, 0).astype(np.int32)
    strange = np.concatenate([[0], np.cumsum(word == 0)])
    text_end = np.repeat(w.first[1:], np.diff(w.first))
    at = np.flatnonzero((strange[SEED:] == strange[:-SEED]) & (text_end[: n - SEED + 1] - np.arange(n - SEED + 1) >= SEED))
    if not len(at):
        return none, none, none, word
    g = words.grams(w.key, SEED)[at]
    spot = np.minimum(np.searchsorted(items.grams, g), len(items.grams) - 1)
    hit = items.grams[spot] == g
    at, spot = at[hit], np.unique(spot[hit])
    if not len(at):
        return none, none, none, word
    # the stretches that the sequences cover, a 0 behind each; neighbouring texts never share one
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + SEED, -1)
    place = np.flatnonzero(np.cumsum(covered[:n]) > 0)
    last = np.flatnonzero(np.append(np.diff(place) > 1, True) | np.append(text_end[place[:-1]] != text_end[place[1:]], True))
    text = np.insert(word[place], last + 1, 0)
    place = np.insert(place, last + 1, -1)
    order = suffix_array(text)
    size = items.gram_first[spot + 1] - items.gram_first[spot]
    p = items.starts[np.repeat(items.gram_first[spot], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
    left, right = _search(text, order, items, p, False), _search(text, order, items, p, True)
    found = [(none, none, none)]
    count = right - left
    for a, b in _portions(count, PAIRS):
        k = count[a:b]
        mine = np.repeat(p[a:b], k)
        t = order[np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(left[a:b], k)]
        before_p = np.where(mine > items.first[items.item[mine]], items.word[mine - 1], -1)
        before_t = np.where((t > 0) & (text[t - 1] > 0), text[t - 1], -2)
        keep = before_p != before_t
        mine, t = mine[keep], t[keep]
        length, end = np.full(len(mine), SEED), items.first[items.item[mine] + 1]
        going = np.arange(len(mine))
        while len(going):  # as many words as the match has, and no more
            i = mine[going, None] + length[going, None] + np.arange(STRIDE)
            j = t[going, None] + length[going, None] + np.arange(STRIDE)
            same = (i < end[going, None]) & (j < len(text)) & (items.word[np.minimum(i, len(items.word) - 1)] == text[np.minimum(j, len(text) - 1)])
            length[going] += np.where(same.all(1), STRIDE, np.argmin(same, 1))
            going = going[same.all(1)]
        found.append((mine, place[t], length))
    p, q, length = (np.concatenate(x) for x in zip(*found, strict=True))
    return p, q, length, word


def _portions(count: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``count`` that sum up to about ``most``."""
    total, begin = np.cumsum(count), 0
    while begin < len(count):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + most, "right")))
        yield begin, end
        begin = end


def aligned(items: Items, p: np.ndarray, q: np.ndarray, length: np.ndarray, word: np.ndarray, q_from: np.ndarray, q_to: np.ndarray) -> np.ndarray:
    """Length in item words of the longest passage seen around each match of ``length`` words at ``p`` (item) and ``q``
    (document), 0 if none is long enough. ``q_from`` and ``q_to`` bound the pair's document.

    For each shift of the document against the item and each number of edits the earliest item word is kept at which a
    passage can have begun, over the item's words around the match in turn.
    """
    item, most, far = items.item[p], items.edits, np.iinfo(np.int32).max // 2
    low, high = np.maximum(items.first[item], p - items.around), np.minimum(items.first[item + 1], p + length + items.around)
    shape = (len(p), 2 * most + 3, most + 1)  # a column more at either side
    begin = np.full(shape, far, np.int32)
    best = np.zeros(len(p), np.int64)
    edits = 10 * np.arange(most + 1)
    for step in range(int((high - low).max(initial=0))):
        i = low + step
        target = np.where(i < high, items.word[np.minimum(i, len(items.word) - 1)], -1)
        j = (q - p + i)[:, None] + np.arange(-most, most + 1)
        inside = (j >= q_from[:, None]) & (j < q_to[:, None])
        hit = inside & (word[np.clip(j, 0, len(word) - 1)] == target[:, None])
        now = np.full(shape, far, np.int32)
        match = np.minimum(begin[:, 1:-1, :], np.where(edits == 0, i[:, None, None], far))
        now[:, 1:-1, :] = np.where(hit[:, :, None], match, far)
        long = np.where(hit[:, :, None], i[:, None, None] + 1 - match, 0)
        best = np.maximum(best, np.where((long >= items.least) & (edits <= long), long, 0).max((1, 2)))
        now[:, 1:-1, 1:] = np.minimum(now[:, 1:-1, 1:], np.where(inside[:, :, None], begin[:, 1:-1, :-1], far))  # changed
        now[:, 1:-1, 1:] = np.minimum(now[:, 1:-1, 1:], begin[:, 2:, :-1])  # missing
        for e in range(most):  # added
            now[:, 2:-1, e + 1] = np.minimum(now[:, 2:-1, e + 1], now[:, 1:-2, e])
        begin = now
    return best


def search(items: Items, texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Of one shard: the numbers of leaking texts, the item numbers, the longest verbatim match of each pair, its first word in the
    text and in the item, and the words of a passage that proves the leak."""
    w = words.split(texts, fold=True)
    p, q, length, word = matches(items, w)
    text = np.searchsorted(w.first, q, "right") - 1
    item = items.item[p].astype(np.int64)
    pair = text * np.int64(max(len(items.ids), 1)) + item
    order = np.lexsort((p, q, -length, pair))
    head = order[np.concatenate([[True], pair[order][1:] != pair[order][:-1]])] if len(order) else order
    passage = np.where(length[head] >= items.least, length[head], 0)
    left = np.flatnonzero(~np.isin(pair, pair[head][passage > 0]))
    for a in range(0, len(left), ALIGN_STEP):
        k = left[a : a + ALIGN_STEP]
        long = aligned(items, p[k], q[k], length[k], word, w.first[text[k]], w.first[text[k] + 1])
        np.maximum.at(passage, np.searchsorted(pair[head], pair[k]), long)
    some = passage > 0
    h = head[some]
    return text[h], item[h], length[h], q[h] - w.first[text[h]], p[h] - items.first[item[h]], passage[some]


def leaks(documents: DataFrame, eval_items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least_words: int = 15) -> DataFrame:
    """``(id, item, verbatim_words, doc_word, item_word, passage_words)``: every document with every item that it gives away.

    ``verbatim_words``: the longest verbatim match, ``doc_word`` and ``item_word``: where it begins, in words from 0 (of equally
    long ones the first in the document); ``passage_words``: the item words of a passage that proves the leak (a verbatim match of
    ``least_words`` is proof enough and is then not aligned further).
    """
    docs = documents.select(id_col, text_col)
    asked = eval_items.select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t"))
    letters = asked.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-letters // (2 * BLOCK_WORDS)))
    schema = f"{id_col} {docs.schema[0].dataType.simpleString()}, {item_col} {asked.schema[0].dataType.simpleString()}, verbatim_words bigint, doc_word bigint, item_word bigint, passage_words bigint"
    item_type = to_arrow_type(asked.schema[0].dataType)

    def one(block: int) -> DataFrame:
        rows = asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block).collect()
        shared = docs.sparkSession.sparkContext.broadcast(Items([r.i for r in rows], [r.t for r in rows], least_words))

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for a, b in words.steps(texts):
                    text, item, *found = search(items, texts[a:b])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text + a)), pa.array([items.ids[x] for x in item], item_type), *(pa.array(x.astype(np.int64)) for x in found)], [id_col, item_col, "verbatim_words", "doc_word", "item_word", "passage_words"])

        return docs.mapInArrow(find, schema)

    return reduce(DataFrame.unionByName, [one(b) for b in range(blocks)])


def clean(documents: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents without those that ``found`` names."""
    return documents.join(found.select(id_col).distinct(), id_col, "left_anti")
