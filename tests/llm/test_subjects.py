"""Subject areas: held-out accuracy on made-up documents with noisy labels."""

import random

import numpy as np

from reelspark.llm import subjects


def corpus(seed, n):
    """Documents of sentences about one or two of three subjects and about none, and the subjects that hold a quarter."""
    r = random.Random(seed)
    topics = {s: [[f"{s}{a}{b}" for a in "bdg" for b in "aeiou"[:4]], [f"{s}v{b}" for b in "aeiou"]] for s in ("law", "food", "sport")}
    plain = [f"x{a}{b}" for a in "bcdfg" for b in "aeiou"]
    docs, truth = [], []
    for _ in range(n):
        mine = r.sample(sorted(topics), r.choice([0, 1, 1, 1, 2]))
        sentences = []
        for _ in range(r.randint(3, 12)):
            if mine and r.random() < 0.75:
                s = r.choice(mine)
                noun, verb = topics[s]
                sentences.append((s, f"the {r.choice(noun)} {r.choice(noun)} {r.choice(verb)} a {r.choice(noun)} with {r.choice(noun)} near the {r.choice(plain)} {r.choice(noun)}"))
            else:
                sentences.append((None, "and now we " + " ".join(r.choice(plain) for _ in range(8))))
        held = [s for s, _ in sentences if s]
        docs.append(" ".join(t for _, t in sentences))
        truth.append({s for s in held if held.count(s) >= 0.25 * len(held)})
    return docs, truth


def test_held_out_accuracy(spark):
    docs, truth = corpus(1, 900)
    r = random.Random(2)
    rows = [(i, t, "a") for i, t in enumerate(docs)] + [(9001, None, "a"), (9002, "", "a"), (9003, " \n", "a"), (9004, docs[0], "a")]
    labels = []
    for i in range(400):
        for s in truth[i] or {"law"} if r.random() < 0.1 else truth[i]:
            labels.append((i, r.choice([s, s.upper(), f" {s} "]) if r.random() > 0.12 else r.choice(["law", "food", "sport"]), "q"))
    labels += [(3, None, "q"), (None, "law", "q"), (5, "poetry", "q"), (77777, "law", "q"), labels[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, subject string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string, annotator string")
    names = spark.createDataFrame([("law", "x"), ("food", "y"), ("sport", "z")], "subject string, description string")
    got = {}
    for x in subjects.areas(df, lab, names).collect():
        got.setdefault(x.doc_id, set()).add(x.subject)
    held = range(400, 900)
    hit = sum(len(got.get(i, set()) & truth[i]) for i in held)
    assert hit / sum(len(got.get(i, ())) for i in held) > 0.9 and hit / sum(len(truth[i]) for i in held) > 0.9
    assert not {9001, 9002, 9003} & set(got) and got.get(9004) == got.get(0)
    assert subjects.areas(df.limit(0), lab, names).count() == 0
    assert subjects.areas(df, lab.limit(0), names).count() == 0 and subjects.areas(df, lab, names.limit(0)).count() == 0


def test_a_quarter_is_always_enough():
    """Votes for one subject of each document must not calibrate areas of a quarter to three tenths away."""
    class Fixed(subjects.Models):
        def __init__(self):
            self.share, self.evidence = subjects.SHARES[0], subjects.EVIDENCE[0]

        def taken(self, w):
            return np.array([[74, 26]] * 8 + [[100, 0]] * 8)

    models = Fixed()
    models.calibrate(["a"] * 16, np.array([[1.0, 0.0]] * 16))
    assert models.accepted(np.array([[74, 26], [75, 25]])).all()


def labelled(spark, docs):
    """Documents and labels of ``(text, subject)``."""
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(docs)], "doc_id long, text string")
    return df, spark.createDataFrame([(i, s, "q") for i, (_, s) in enumerate(docs)], "doc_id long, subject string, annotator string")


def letters(i):
    return "".join(chr(97 + int(c)) for c in str(i))


def test_every_labelled_document_counts(spark):
    """Many labelled documents and long ones are all trained on, whatever the partitions."""
    names = ["food", "law"]
    docs = [(f"own{letters(i)} {names[i % 2]} word", names[i % 2]) for i in range(4500)] + [("far " * 6000 + "end", "law")]
    df, lab = labelled(spark, docs)
    models = subjects.fit(df, lab, names)
    own = subjects.words.split([" ".join(f"own{letters(i)}" for i in range(4500)) + " far end"]).key
    assert np.isin(own, models.word).all()
    other = subjects.fit(df.repartition(7), lab.repartition(3), names)
    assert np.array_equal(models.of_pair, other.of_pair) and np.array_equal(models.pair, other.pair) and (models.share, models.evidence) == (other.share, other.evidence)


def test_repeats_in_one_long_document_are_no_evidence(spark):
    """Words of no subject that one long labelled document says thousands of times do not get its subject."""
    texts, truth = corpus(4, 500)
    docs = [(t, sorted(s)[0]) for t, s in zip(texts, truth, strict=True) if s]
    docs.append((texts[0] + " and now we greet you" * 3000, "law"))
    docs += [("and now we greet you", s) for s in ("law", "food", "sport") for _ in range(8)]
    df, lab = labelled(spark, docs)
    models = subjects.fit(df, lab, ["food", "law", "sport"])
    assert not models.accepted(models.taken(subjects.words.split(["and now we greet you"] * 2))).any()
