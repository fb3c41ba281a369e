"""Subject areas of documents, by subject-specific interpolated n-gram language models.

A model of two-word sequences, interpolated with single words and with all training text, is trained for each subject; the
background of a subject is the mean of the models of all others. Training starts from the labels of all labelled documents, in which
annotators err and documents hold more than their subject: in rounds every word is given, by the cross-entropies around it and
the votes for its document, to a subject, and the models are trained again on what they were given. A document counts once for
a pair of words however often it says it, so that what a long or repetitive one repeats is no surer than its label. Tasks give the
words and count in whole numbers, so that models do not depend on partitions; the driver works the models out of the counts.

A document is then read with the models: for every word the cross-entropies per token, subject against background, are
summed over the words around it, the best subject takes the word if its evidence is enough, and a subject is accepted
if it holds enough of the words that any subject took. What is enough is calibrated on a fifth of the labelled documents, kept
apart by a hash of their ids; then the models are trained once more, on all of them.

Defined results: null, empty and blank texts have no subject; labels that are null, unknown or of a missing document are
left out, case and surrounding blanks in labels do not matter, and a repeated vote of one annotator counts once. Without any
usable label nothing is accepted. Extra columns are dropped; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm import words
from reelspark.runtime import cut

#: One labelled document in so many is kept apart to calibrate.
HELD_OUT = 5
#: Parts of a document's weight: shares are rounded to them, so that sums are the same in any order.
PARTS = 1 << 20
#: Evidence is rounded to such parts, so that sums of it are exact and do not depend on the texts around a text.
GRAIN = 1 << 16
#: Numbers (words times subjects) worked on in one step, weights added up in a task before they are sent, and pairs in one step of the driver.
STEP, HELD, PAIRS = 1 << 22, 1 << 22, 1 << 16
ROUNDS = 6
#: Words around a word that are judged with it, to either side.
AROUND = 5
#: Taken from every count for the interpolation, so that what was seen once or twice is no evidence.
DISCOUNT = 1.5
#: Standard errors by which a word's or a pair's evidence is lessened: the first of these after which a smaller one gains
#: less than ``GAIN`` in agreement with labelled documents kept apart. Much doubt keeps chance out, but few labels need little.
DOUBTS = (6.0, 4.0, 2.5, 1.5, 0.5)
GAIN = 0.01
#: Evidence for a subject around a word at which the word is given to it while training.
MARGIN = 4.0
#: Part of the certainty given to the votes for a document in the first rounds of training, less from round to round.
TRUST, TRUSTED_ROUNDS = 0.9, 5
#: What is tried in calibration: least share of a subject (a quarter is a case, so never more than that), and least evidence for any subject around a word.
SHARES = (0.25, 0.22, 0.2)
EVIDENCE = (2.0, 1.0, 3.0, 4.0, 6.0)
LEAST_WORDS = 4
#: Subjects whose models are held in every task at once.
MOST_SUBJECTS = 1000


def befores(w: words.Words) -> np.ndarray:
    """The word before each word in its text; 0 for the first."""
    before = np.zeros(len(w.key), np.uint64)
    before[1:] = w.key[:-1]
    before[w.first[:-1][np.diff(w.first) > 0]] = 0
    return before


def pairs(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A hash of each word and the word before it."""
    return words.mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


def bigrams(w: words.Words) -> np.ndarray:
    """A hash of each word and the word before it in its text."""
    return pairs(befores(w), w.key)


def around(score: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``score`` within ``AROUND`` of each row and within its text."""
    total = np.zeros((len(score) + 1, score.shape[1]), np.float64)
    np.cumsum(score, axis=0, out=total[1:])
    size = np.diff(first)
    low, high = np.repeat(first[:-1], size), np.repeat(first[1:], size)
    at = np.arange(len(score))
    return (total[np.minimum(at + AROUND + 1, high)] - total[np.maximum(at - AROUND, low)]).astype(np.float32)


def smooth(count: np.ndarray, total: np.ndarray, taken: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probability of each event after its history for each model: counts less a discount, interpolated with ``lower``, the
    probability without the history, in proportion to what the discount took. ``total``, ``taken``: counts of its history, and
    what the discount took of them; a history that was hardly seen says nothing of its own."""
    return (np.maximum(count - DISCOUNT, 0) + (taken + DISCOUNT) * lower) / (total + DISCOUNT)


def against_others(p: np.ndarray, count: np.ndarray, doubt: float) -> np.ndarray:
    """Cross-entropy of each subject's background less that of the subject, per event, as far as it is beyond chance.

    The background of a subject is the mean of the models of all others: what all subjects share is evidence for none.
    ``doubt`` standard errors of the difference, by how often the event was seen, are taken off it.
    """
    others = (p.sum(1, keepdims=True) - p) / max(p.shape[1] - 1, 1)
    found = np.log(np.maximum(p, 1e-300)) - np.log(np.maximum(others, 1e-300))
    error = np.sqrt(1 / (count + 0.5) + 1 / (count.sum(1, keepdims=True) - count + 0.5))
    return (np.rint(np.sign(found) * np.maximum(np.abs(found) - doubt * error, 0) * GRAIN) / GRAIN).astype(np.float32)


class Vocabulary(NamedTuple):
    """``word``, ``pair``: hashes of the words and pairs of words of all labelled documents, ascending; for each pair the
    numbers of its second word and of the word ``before`` (of no word: ``len(word)``)."""

    word: np.ndarray
    pair: np.ndarray
    second: np.ndarray
    before: np.ndarray

    def evidence(self, count: np.ndarray, corpus: np.ndarray, doubt: float) -> tuple[np.ndarray, np.ndarray]:
        """The evidence of each pair and of each word for each subject. ``count``: of each pair, in how many documents it was given to each
        subject; ``corpus``: the share of each word in all of them. A pair that was not given to any has the evidence of its second
        word, a word none."""
        def of(place: np.ndarray, n: int, less: float = 0.0) -> np.ndarray:
            return np.stack([np.bincount(place, np.maximum(c - less, 0), n) for c in count.T], axis=1)

        n_word = of(self.second, len(self.word))
        total = n_word.sum(0)
        p_word = smooth(n_word, total, total - np.maximum(n_word - DISCOUNT, 0).sum(0), corpus[:, None])
        of_word = against_others(p_word, n_word, doubt)
        of_word[n_word.sum(1) == 0] = 0
        total = of(self.before, len(self.word) + 1)
        taken = total - of(self.before, len(self.word) + 1, DISCOUNT)
        of_pair = np.empty(count.shape, np.float32)
        for a in range(0, len(count), PAIRS):
            c, history, second = count[a : a + PAIRS], self.before[a : a + PAIRS], self.second[a : a + PAIRS]
            found = against_others(smooth(c, total[history], taken[history], p_word[second]), c, doubt)
            unseen = c.sum(1) == 0
            found[unseen] = of_word[second[unseen]]
            of_pair[a : a + PAIRS] = found
        return of_pair, of_word


def taken_words(score: np.ndarray, first: np.ndarray, evidence: float) -> np.ndarray:
    """How many words of each text each subject takes. ``score``: evidence around each word."""
    n, k = len(first) - 1, score.shape[1]
    text, best = np.repeat(np.arange(n), np.diff(first)), score.argmax(1)
    strong = score[np.arange(len(score)), best] > evidence
    return np.bincount(text[strong] * k + best[strong], minlength=n * k).reshape(n, k)


def accepted(taken: np.ndarray, share: float) -> np.ndarray:
    """Which subjects each text has."""
    return (taken >= LEAST_WORDS) & (taken >= share * taken.sum(1, keepdims=True))


def tally(taken: Callable[[float], np.ndarray], votes: np.ndarray) -> np.ndarray:
    """For each evidence and share that is tried the votes for accepted subjects and the number of these."""
    out = []
    for evidence in EVIDENCE:
        of = taken(evidence)
        for share in SHARES:
            got = accepted(of, share)
            out.append((votes[got].sum(), got.sum()))
    return np.array(out)


class Models:
    """The evidence of every known pair of words, and of every known word, for each subject against the background."""

    def __init__(self, known: Vocabulary, of_pair: np.ndarray, of_word: np.ndarray) -> None:
        self.word, self.pair, self.of_pair, self.of_word = known.word, known.pair, of_pair, of_word
        self.share, self.evidence = SHARES[0], EVIDENCE[0]

    def taken(self, w: words.Words) -> np.ndarray:
        """How many words of each text each subject takes."""
        score = np.zeros((len(w.key), self.of_word.shape[1]), np.float32)
        b = bigrams(w)
        at = np.minimum(np.searchsorted(self.pair, b), len(self.pair) - 1)
        known = self.pair[at] == b
        score[known] = self.of_pair[at[known]]
        rest = np.flatnonzero(~known)
        at = np.minimum(np.searchsorted(self.word, w.key[rest]), len(self.word) - 1)
        hit = self.word[at] == w.key[rest]
        score[rest[hit]] = self.of_word[at[hit]]
        return taken_words(around(score, w.first), w.first, self.evidence)

    def accepted(self, taken: np.ndarray) -> np.ndarray:
        return accepted(taken, self.share)

    def settle(self, tried: np.ndarray, n_votes: float) -> None:
        """Sets the least share and evidence at which accepted subjects agree best with the votes (F1; the first of equals)."""
        self.agreement = -1.0
        for (hit, got), (evidence, share) in zip(tried, [(e, s) for e in EVIDENCE for s in SHARES], strict=True):
            f = 2 * hit / max(got + n_votes, 1e-9)
            if f > self.agreement + 1e-3:
                self.agreement, self.evidence, self.share = f, evidence, share

    def calibrate(self, texts: list[str], votes: np.ndarray) -> None:
        """:meth:`settle` with texts at hand and the share of the votes that each subject has for each."""
        w = words.split(texts)

        def taken(evidence: float) -> np.ndarray:
            self.evidence = evidence
            return self.taken(w)

        self.settle(tally(taken, votes), votes.sum())


def given_parts(place: np.ndarray, text: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What words at ``place`` give to subjects by the ``parts`` of their texts: texts, numbers of cells (place, subject) and parts."""
    doc, subject = np.nonzero(parts)
    size = np.bincount(doc, minlength=len(parts))
    n = size[text]
    at = np.repeat((np.cumsum(size) - size)[text] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.repeat(text, n), np.repeat(place, n) * parts.shape[1] + subject[at], parts[doc, subject][at]


def given(pair: np.ndarray, first: np.ndarray, votes: np.ndarray, of_pair: np.ndarray | None, trust: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the words of texts give to subjects in a round, as :func:`given_parts`: words with evidence go to their subject,
    whatever the votes; the rest follows what their document holds. Without evidence all follows the votes."""
    k = votes.shape[1]
    text = np.repeat(np.arange(len(votes)), np.diff(first))
    if of_pair is None:
        return given_parts(pair, text, np.rint(votes * PARTS).astype(np.int64))
    score = around(of_pair[pair], first) + np.log(trust * votes + (1 - trust) / k)[text] + np.log(k)
    best = score.argmax(1)
    strong = score[np.arange(len(score)), best] > MARGIN
    held = np.bincount(text[strong] * k + best[strong], minlength=len(votes) * k).reshape(votes.shape)
    total = held.sum(1, keepdims=True)
    parts = np.rint(np.where(total > 0, held / np.maximum(total, 1), votes) * PARTS).astype(np.int64)
    doc, cell, n = given_parts(pair[~strong], text[~strong], parts)
    return np.concatenate([doc, text[strong]]), np.concatenate([cell, pair[strong] * k + best[strong]]), np.concatenate([n, np.full(strong.sum(), PARTS)])


def summed(cell: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each cell once, with the sum of its numbers."""
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    at = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.empty(0, np.int64)
    return cell[at], np.add.reduceat(n[order], at) if len(at) else n


def by_documents(doc: np.ndarray, cell: np.ndarray, n: np.ndarray, n_cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Each cell once, with the sum over documents of what each gave it, one at most."""
    both, n = summed(doc * n_cells + cell, n)
    return summed(both % n_cells, np.minimum(n, PARTS))


def pack(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The values of each text as one binary value."""
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def unpack(batch: pa.RecordBatch, kind: type, k: int) -> Iterator[tuple[np.ndarray, words.Words]]:
    """Labelled documents a few at a time: the share of the votes of each subject in whole parts, and the values of :func:`pack`."""
    if not batch.num_rows:
        return
    column, packed = batch.column(1), batch.column(2)
    subject, n = (c.to_numpy() for c in column.flatten().flatten())
    doc = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(column.offsets)))
    total = np.bincount(doc, n, batch.num_rows)
    votes = np.zeros((batch.num_rows, k))
    votes[doc, subject] = np.rint(n * PARTS / total[doc]) / PARTS
    _, offsets, data = packed.buffers()
    first = np.frombuffer(offsets, np.int32)[packed.offset : packed.offset + batch.num_rows + 1] // np.dtype(kind).itemsize
    values = np.frombuffer(data, np.uint8)[: first[-1] * np.dtype(kind).itemsize].view(kind) if first[-1] else np.empty(0, kind)
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(first, first[a] + STEP // k, "right")) - 1)
        yield votes[a:b], words.Words(values[first[a] : first[b]], (first[a : b + 1] - first[a]).astype(np.int64))
        a = b


class Training:
    """All labelled documents as numbers of their pairs of words in a table, the vocabulary of them, and passes over the table."""

    def __init__(self, rows: DataFrame, n_subjects: int) -> None:
        """``rows``: ``(apart, votes, text)``, ``votes`` as a list of subjects (by number) and how many voted for each."""
        k = self.n_subjects = n_subjects
        self.context = rows.sparkSession.sparkContext
        schema = "apart boolean, votes array<struct<subject: int, n: bigint>>, packed binary"

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(2).to_pylist()
                for a, b in words.steps(texts):
                    w = words.split(texts[a:b])
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pack(w.key, w.first)], ["apart", "votes", "packed"])

        def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, w in unpack(batch, np.uint64, k):
                    before = befores(w)
                    at = np.unique(pairs(before, w.key), return_index=True)[1]
                    yield pa.RecordBatch.from_arrays([pa.array(x[at].view(np.int64)) for x in (before, w.key)], ["before", "word"])

        whole = cut(rows.mapInArrow(split, schema), "subjects")
        found = whole.mapInArrow(seen, "before bigint, word bigint").distinct().toArrow()
        before, word = (c.to_numpy().view(np.uint64) for c in found.columns)
        pair, head = np.unique(pairs(before, word), return_index=True)
        names = np.unique(word)
        second, first = np.searchsorted(names, word[head]), np.searchsorted(names, before[head])
        self.known = Vocabulary(names, pair, second, np.where(before[head] == 0, len(names), first))
        shared = self.context.broadcast(pair)

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    at = [np.searchsorted(shared.value, bigrams(w)).astype(np.int32) for _, w in unpack(batch, np.uint64, k)]
                    size = np.frombuffer(batch.column(2).buffers()[1], np.int32)[batch.column(2).offset :][: batch.num_rows + 1] // 8
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pack(np.concatenate(at), size - size[0])], ["apart", "votes", "packed"])

        self.table = cut(whole.mapInArrow(number, schema), "subjects", whole) if len(pair) else whole
        shared.destroy()

    def counted(self, every: bool, of_pair: np.ndarray | None = None, trust: float = 1.0) -> np.ndarray:
        """For each pair of words in how many documents each subject is given it, of all or of those that are not kept apart."""
        k, n_cells, shared = self.n_subjects, len(self.known.pair) * self.n_subjects, self.context.broadcast(of_pair)

        def sent(cells: list[np.ndarray], ns: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in summed(np.concatenate(cells), np.concatenate(ns))], ["cell", "n"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells, ns, size = [], [], 0
            for batch in batches:
                for votes, w in unpack(batch, np.int32, k):
                    cell, n = by_documents(*given(w.key.astype(np.int64), w.first, votes, shared.value, trust), n_cells)
                    cells, ns, size = [*cells, cell], [*ns, n], size + len(cell)
                    if size > HELD:
                        yield sent(cells, ns)
                        cells, ns, size = [], [], 0
            if cells:
                yield sent(cells, ns)

        rows = self.table if every else self.table.where("not apart")
        found = rows.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        shared.destroy()
        count = np.zeros(n_cells)
        count[found.column("cell").to_numpy()] = found.column("n").to_numpy() / PARTS
        return count.reshape(-1, k)

    def models(self, doubt: float, every: bool) -> Models:
        """Models trained in rounds on all documents, or on those that are not kept apart."""
        count = self.counted(every)
        corpus = np.bincount(self.known.second, count.sum(1), len(self.known.word))
        corpus /= corpus.sum()
        for r in range(ROUNDS):
            if r:
                # words go by the models of the last round, and by the votes less from round to round
                count = self.counted(every, of_pair, TRUST * max(0.0, 1 - r / TRUSTED_ROUNDS))
            of_pair, of_word = self.known.evidence(count, corpus, doubt)
        return Models(self.known, of_pair, of_word)

    def calibrate(self, models: Models) -> None:
        """:meth:`Models.settle` with the documents that are kept apart."""
        k, shared = self.n_subjects, self.context.broadcast(models.of_pair)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for votes, w in unpack(batch, np.int32, k):
                    score = around(shared.value[w.key], w.first)
                    tried = tally(lambda evidence: taken_words(score, w.first, evidence), votes)  # noqa: B023
                    hit, got = [*tried[:, 0], votes.sum()], [*tried[:, 1], 0]
                    yield pa.RecordBatch.from_arrays([pa.array(range(len(hit)), pa.int32()), pa.array(np.rint(np.array(hit) * PARTS).astype(np.int64)), pa.array(np.array(got).astype(np.int64))], ["i", "hit", "got"])

        found = self.table.where("apart").mapInArrow(run, "i int, hit bigint, got bigint").groupBy("i").agg(F.sum("hit"), F.sum("got")).orderBy("i").toArrow()
        shared.destroy()
        hit = found.column(1).to_numpy() / PARTS
        models.settle(np.stack([hit, found.column(2).to_numpy()], axis=1)[:-1], hit[-1])


def fit(documents: DataFrame, labels: DataFrame, subjects: list[str], seed: int = 3) -> Models | None:
    """Models from all labelled documents; None if there is no usable label."""
    known = {s.strip().lower(): i for i, s in enumerate(subjects)}
    clean = labels.select("doc_id", F.lower(F.trim("subject")).alias("subject"), "annotator").where(F.col("subject").isin(list(known)) & F.col("doc_id").isNotNull()).distinct()
    number = F.create_map(*[F.lit(x) for item in known.items() for x in item])
    votes = clean.groupBy("doc_id", number[F.col("subject")].alias("subject")).agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.collect_list(F.struct("subject", "n")).alias("votes"))
    rows = documents.select("doc_id", "text").where(F.col("text").isNotNull()).join(votes, "doc_id")
    rows = rows.select((F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(HELD_OUT)) == 0).alias("apart"), "votes", "text")
    training = Training(rows, len(subjects))
    if not len(training.known.pair):
        return None
    if training.table.where("length(packed) > 0").select("apart").distinct().count() < 2:
        return training.models(DOUBTS[-1], True)
    best = None
    for doubt in DOUBTS:
        models = training.models(doubt, False)
        training.calibrate(models)
        if best is not None and models.agreement < best.agreement + GAIN and best.agreement > 0:
            break
        best, chosen = models, doubt
    # what was kept apart has set what is enough; now it is evidence as well
    models = training.models(chosen, True)
    models.share, models.evidence = best.share, best.evidence
    return models


def areas(documents: DataFrame, labels: DataFrame, areas_table: DataFrame) -> DataFrame:
    """``(doc_id, subject, n_words, share)``: every document with each subject it deals with, the words that the subject
    took, and their share of the words of all subjects. ``areas_table`` names the subjects; more than ``MOST_SUBJECTS`` are an error."""
    names = sorted(r.subject for r in areas_table.select("subject").dropna().distinct().limit(MOST_SUBJECTS + 1).collect())
    if len(names) > MOST_SUBJECTS:
        raise ValueError(f"more than {MOST_SUBJECTS} subject areas: their models would not fit into one task")
    docs = documents.select("doc_id", "text")
    schema = f"doc_id {docs.schema[0].dataType.simpleString()}, subject string, n_words bigint, share double"
    models = fit(documents, labels, names) if names else None
    if models is None:
        return documents.sparkSession.createDataFrame([], schema)
    shared = documents.sparkSession.sparkContext.broadcast(models)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in words.steps(texts):
                taken = m.taken(words.split(texts[a:b]))
                doc, subject = np.nonzero(m.accepted(taken))
                n = taken[doc, subject]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(a + doc)), pa.array([names[s] for s in subject], pa.string()), pa.array(n), pa.array(n / np.maximum(taken.sum(1)[doc], 1))], ["doc_id", "subject", "n_words", "share"])

    return docs.mapInArrow(read, schema)
