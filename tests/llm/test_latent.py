"""Paraphrases with words replaced from their contexts, with and without the latent space; the
products of the distributed SVD against numpy."""

from dataclasses import replace

import numpy as np

from notifyq.llm import decontaminate as D

COMMON = "the of and to in a is that it for on with".split()
TOPICS, CONCEPTS = 30, 40


def corpus(rng, n_docs=900):
    """Documents of one topic each; a concept is written with either of two words."""
    def sentence(topic, pick):
        words = []
        for c in rng.integers(0, CONCEPTS, 24):
            words += [rng.choice(COMMON), f"{pick()}{topic}x{c}"]
        return words

    docs = [" ".join(w for _ in range(4) for w in sentence(k % TOPICS, lambda: rng.choice(["a", "b"]))) for k in range(n_docs)]
    items, paraphrases = [], []
    for k in range(60):
        words = sentence(k % TOPICS, lambda: "a")
        for at, name in zip((5, 21, 37), "pqr"):  # the answer: words of no other text
            words[at] = f"answer{name}{k}"
        items.append((k, " ".join(words)))
        changed = [w.replace("a", "b", 1) if w[0] == "a" and "x" in w else w for w in words]
        paraphrases.append((10_000 + k, " ".join(sentence((k + 7) % TOPICS, lambda: "b") + changed)))
    return docs, items, paraphrases


def test_paraphrases_from_contexts(spark):
    docs, items, paraphrases = corpus(np.random.default_rng(3))
    rows = [*enumerate(docs), *paraphrases]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    found = {}
    for name, r in (("with", D.Rules()), ("without", D.Rules(latent_rank=0))):
        got = {x.doc_id: x.item_ids for x in D.leak_report(d, b, r).collect()}
        found[name] = sum(k in got[10_000 + k] for k in range(60)) / 60
        assert all(not got[k] for k in range(len(docs))), "clean documents stay"
    assert found["without"] <= 0.1 and found["with"] >= 0.9, found


def test_copies_are_found_without_the_latent_space_too(spark):
    rng = np.random.default_rng(5)
    items = [(k, " ".join(f"w{int(x)}" for x in rng.integers(0, 4000, 50))) for k in range(400)]
    rows = [(k, f"{' '.join(f'w{int(x)}' for x in rng.integers(0, 4000, 30))} {t}") for k, t in items]
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for r in (D.Rules(), D.Rules(latent_rank=0)):
        assert all(r.doc_id in r.item_ids for r in D.leak_report(d, b, r).collect())


def test_the_space_is_the_strongest_of_the_rows_and_far_smaller_than_the_passages(spark):
    docs, items, _ = corpus(np.random.default_rng(4), 300)
    r = replace(D.Rules(), latent_power=6, latent_terms=1 << 10)
    d = spark.createDataFrame([(t,) for t in docs] + [(None,), ("",)], "text string").repartition(5)
    p = D._passages(spark.createDataFrame(items, "item_id long, text string"), np.ones(r.terms), r)
    rows = D._context_rows(d, p, len(docs), r)
    held = rows.collect()
    a = np.zeros((len(held), len(p.vocabulary) + r.latent_terms))
    for k, x in enumerate(held):
        a[k, np.frombuffer(x["ids"], np.int64)] = np.frombuffer(x["weights"], np.float64)
    q = np.random.default_rng(0).normal(size=(a.shape[1], 7))
    assert np.allclose(D._product(rows, q), a.T @ (a @ q))
    space = D.fit_latent(d, p, len(docs), r)
    assert space.basis.shape == (a.shape[1], r.latent_rank) and r.latent_rank + r.latent_skip > 0
    v = np.linalg.svd(a, full_matrices=False)[2][: r.latent_skip + 20].T  # clearly the strongest
    inside = np.linalg.norm(space.basis.T @ v[:, r.latent_skip :], axis=0)
    assert inside.min() > 0.97, inside


def test_too_few_words_for_a_space(spark):
    d = spark.createDataFrame([(1, "x y z one two three"), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([(7, "one two three"), (8, None)], "item_id long, text string")
    assert {x.doc_id: x.item_ids for x in D.leak_report(d, b).collect()} == {1: [7], 2: []}


def test_word_numbers_are_places_or_hashes_and_nothing_is_held():
    import xxhash

    words = [b"one", b"two", b"none", b"one", "über".encode()]
    terms = D.Terms(1000, {b"one": 0, b"two": 1})
    before = dict(vars(terms))
    want = [terms.vocabulary.get(w, 2 + xxhash.xxh3_64_intdigest(w) % 1000) for w in words]
    assert terms.of(words).tolist() == want and terms.of([]).tolist() == []
    assert D.Terms(1000).of(words).tolist() == [xxhash.xxh3_64_intdigest(w) % 1000 for w in words]
    terms.of([b"w%d" % k for k in range(10_000)])
    assert vars(terms) == before and not isinstance(terms, dict), "no memo of the words met"


def test_recall_of_a_space_fitted_on_a_sample(spark):
    """10,000 documents, of which the sample takes one in two; with all documents as the measure."""
    rng = np.random.default_rng(6)
    _, items, paraphrases = corpus(rng, 0)
    common, side, concept = rng.integers(0, len(COMMON), (10_000, 96)), rng.integers(0, 2, (10_000, 96)), rng.integers(0, CONCEPTS, (10_000, 96))
    docs = [
        (k, " ".join(f"{COMMON[c]} {'ab'[s]}{k % TOPICS}x{x}" for c, s, x in zip(common[k].tolist(), side[k].tolist(), concept[k].tolist())))
        for k in range(10_000)
    ]
    d = spark.createDataFrame(docs + [(k + 10_000, t) for k, t in paraphrases], "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    recall = {}
    for name, r in (("sample", D.Rules()), ("whole", D.Rules(latent_docs=1 << 40, latent_windows=1 << 40))):
        got = {x.doc_id: x.item_ids for x in D.leak_report(d, b, r).collect()}
        recall[name] = sum(k in got[20_000 + k] for k in range(60)) / 60
        assert all(not got[k] for k in range(10_000))
    print(recall)
    assert recall["sample"] >= 0.9 * max(recall["whole"], 1e-9) and recall["sample"] >= 0.9, recall


def test_the_space_is_fitted_to_all_windows_of_all_documents(spark):
    import math
    from collections import Counter

    import xxhash

    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 90, n)) for n in (64 * 40, 64 * 17 + 5, 1, 63, 64, 65, 200, 200)] + [None, "", "w1 " * 70]
    texts += texts[:2]
    d = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    r = replace(D.Rules(), latent_terms=1 << 4)
    idf = np.linspace(1, 2, r.terms)
    p = D._passages(spark.createDataFrame([(1, "w1 w2 w3"), (2, "w4 w5")], "item_id long, text string"), idf, r)
    names = {w: k for k, w in enumerate(p.vocabulary)}
    wanted = []
    for words in [D.words_of(t)[at : at + 64] for t in texts for at in range(0, len(D.words_of(t)), 64)] + [*p.texts]:
        row = Counter()
        for w in words:
            h = xxhash.xxh3_64_intdigest(w) % r.terms
            row[names[w] if w in names else len(names) + h % r.latent_terms] += p.idf[names[w] if w in names else len(names) + h]
        norm = math.sqrt(sum(x * x for x in row.values()))
        wanted.append([(c, round(x / norm, 9)) for c, x in sorted(row.items())])
    # As many documents in all as make a sample, if there were one, leave most of these out.
    got = [
        [*zip(np.frombuffer(x["ids"], np.int64).tolist(), np.frombuffer(x["weights"], np.float64).round(9).tolist())]
        for x in D._context_rows(d, p, 1 << 40, r).collect()
    ]
    assert sorted(got) == sorted(wanted)


def test_leaks_fit_the_space_to_every_document(spark, monkeypatch):
    seen, fit = [], D.fit_latent
    monkeypatch.setattr(D, "_product", lambda rows, q, w, product=D._product: seen.append(rows.mapInArrow(w, D.ROWS).count()) or product(rows, q, w))
    rows = [(k, " ".join(f"d{k}x{x}" for x in range(64 * 20))) for k in range(50)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    monkeypatch.setattr(D, "fit_latent", lambda docs, p, n, *a: fit(docs, p, 1 << 20, *a))
    assert all(not x.contaminated for x in D.leak_report(d, b).collect())
    assert seen and set(seen) == {50 * 20}


def test_document_frequencies_count_each_document_once(spark):
    import xxhash

    texts = ["a b a", "B c", None, "", "c", "c"]
    r = D.Rules()
    counts, n = D.document_frequencies(D.word_hashes(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)), r)
    of = {w: int(counts[xxhash.xxh3_64_intdigest(w.encode()) % r.terms]) for w in "abc"}
    assert n == 6 and of == {"a": 1, "b": 2, "c": 3} and counts.sum() == 6
