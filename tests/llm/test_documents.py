"""Line dedup, classifier, Jaccard join, decontamination and the pipeline by brute force."""

import os
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from notifyq.llm import decontaminate, jaccard_join, line_dedup, quality
from notifyq.llm.common import components

SCHEMA = "doc_id long, text string, lang string, kept_text string, component_id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "x", "y") for i, t in rows], SCHEMA)


def random_docs(n, seed=5):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefg", k=rnd.randint(1, 4)))
    bases = [[word() for _ in range(60)] for _ in range(12)]
    out = [(i, None if i % 17 == 0 else " ".join(w if rnd.random() > 0.03 else word() for w in rnd.choice(bases))) for i in range(n)]
    out += [(n, ""), (n + 1, " \n "), (n + 2, "one two"), (n + 3, "One TWO"), (n + 4, " ".join(bases[0] * 300)), (None, " ".join(bases[0]))]
    return out + [out[1], out[2]]


def brute_lines(rows):
    keys = {}
    for i, t in rows:
        for line in (t or "").split("\n") if i is not None and t is not None else []:
            k = line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            if len(k) >= 10:
                keys.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        kept = []
        for line in (t or "").split("\n"):
            k = line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            gone = i is not None and len(keys.get(k, ())) > 1 and min(keys[k]) != i
            kept += [] if gone else [line]
        out.append((i, "\n".join(kept), (t or "").count("\n") + 1))
    return sorted(out, key=str)


LINES = [
    (5, "A shared line here\nown line of five"), (2, " a SHARED line here\t\nshort\nshort"), (9, "short\nA shared line here"), (3, None),
    (4, ""), (None, "A shared line here"), (7, "twice in one document\ntwice in one document"), (5, "A shared line here\nown line of five"),
    (8, "ÄÄÄÄÄÄÄÄÄÄ äußere\nÄÄÄÄÄÄÄÄÄÄ äußere"), (6, "ÄÄÄÄÄÄÄÄÄÄ äußere\n" + "x" * 200_000), (1, "ÄÄÄÄÄ\nÄÄÄÄÄ"),
]


def test_lines_by_brute_force(spark):
    got = line_dedup.dedup_lines(frame(spark, LINES)).select("doc_id", "kept_text", "n_lines").collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(LINES)
    assert line_dedup.line_report(frame(spark, []).limit(0)).count() == 0


def test_lines_are_reversible(spark):
    first, more = LINES[:4], LINES[4:]
    index = line_dedup.LineIndex.build(frame(spark, first)).insert(frame(spark, more))
    got = line_dedup.dedup_lines(frame(spark, LINES), index).select("doc_id", "kept_text", "n_lines").collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(LINES)
    gone = spark.createDataFrame([(2,), (6,)], "id long")
    left = [r for r in LINES if r[0] not in (2, 6)]
    back = line_dedup.dedup_lines(frame(spark, left), index.delete(gone)).select("doc_id", "kept_text", "n_lines").collect()
    assert sorted(map(tuple, back), key=str) == brute_lines(left)


def test_cuckoo_filter_holds_and_forgets():
    rng = np.random.default_rng(1)
    keys = np.frombuffer(rng.bytes(16 * 5000), line_dedup._KEY)
    f = line_dedup.Cuckoo.of(keys[:3000])
    assert f.has(keys[:3000]).all() and f.has(keys[3000:]).mean() < 0.01
    f.remove(keys[:1500])
    assert f.has(keys[1500:3000]).all() and f.has(keys[:1500]).mean() < 0.02


def brute_components(rows, words, percent):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())

    nodes = [(i, shingles(t)) for i, t in rows if i is not None]
    label = {i: i for i, _ in nodes}
    changed = True
    while changed:
        changed = False
        for i, a in nodes:
            for j, b in nodes:
                if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return sorted([(i, len(shingles(t)), label.get(i)) for i, t in rows], key=str)


def test_jaccard_join_by_brute_force(spark):
    rows = random_docs(150)
    for words, percent in ((4, 85), (5, 80), (2, 60)):
        got = jaccard_join.jaccard_components(frame(spark, rows), jaccard_join.Rule(words, percent)).collect()
        assert sorted(map(tuple, got), key=str) == brute_components(rows, words, percent)
    assert jaccard_join.jaccard_components(frame(spark, rows).limit(0)).count() == 0


def test_jaccard_join_cuts_large_groups(spark, monkeypatch):
    """Blocks of two and one query a task give the same result."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    monkeypatch.setattr(jaccard_join, "QUERIES", 1)
    monkeypatch.setattr(jaccard_join, "EXPANDED", 7)
    rows = random_docs(80, seed=8)
    got = jaccard_join.jaccard_components(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows, 4, 85)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 120)] + [(7, 7), (3, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 120), 100)}


def test_classifier_learns_on_kept_out_rows(spark):
    rnd = random.Random(2)
    good = lambda: " ".join(rnd.choices(["then", "the", "other", "morning", "quiet", "river"], k=40))
    bad = lambda: " ".join(w + "%%%" for w in good().split())
    rows = [(i, good() if i % 3 else bad()) for i in range(300)] + [(300, None), (301, ""), (302, "x" * 100_000), (None, "the")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(300, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_report(frame(spark, rows), labels).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    for i in range(300):
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i].predicted == int(i % 3 > 0)
    blank = quality.quality_report(frame(spark, rows), labels.limit(0)).collect()
    assert {r.score for r in blank} == {0.5}
    assert quality.quality_report(frame(spark, rows).limit(0), labels).count() == 0


def test_quality_model_is_learned_in_a_task(spark, monkeypatch, workdir):
    """The driver neither holds the sample nor trains; the model is that of the same rows in the same order."""
    train = quality.train

    def spied(*given):
        with open(f"{workdir}/{os.getpid()}", "w"):
            return train(*given)

    docs = frame(spark, [(i, f"word{i % 7} {'good' if i % 3 else 'bad'} text {i}") for i in range(200)] + [(5, None)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)], "doc_id long, quality int").repartition(7)
    used = docs.filter(~quality.held_out(F.col("doc_id"))).join(labels, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(50).collect()
    settings = quality.Settings(sample_docs=50)
    monkeypatch.setattr(quality, "train", spied)
    got, want = quality.fit(docs.repartition(9), labels, settings=settings), train([r.text for r in used], [r.quality for r in used], settings)
    assert len(os.listdir(workdir)) == 1 and str(os.getpid()) not in os.listdir(workdir)
    for part in ("vectors", "layer", "bias"):
        assert np.array_equal(getattr(got, part), getattr(want, part))


def test_leaks_copies_and_paraphrases(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefghij", k=5))
    items = [" ".join(word() for _ in range(n)) for n in (16, 30, 50, 90)]
    filler = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{filler(80)} {t.upper()}, {filler(70)}") for i, t in enumerate(items)]
    part = items[1].split()
    rows.append((10, filler(40) + " " + " ".join(w for k, w in enumerate(part) if k % 6) + " " + filler(40)))
    rows += [(20 + k, filler(200)) for k in range(30)] + [(60, None), (61, ""), (62, items[0]), (None, items[0]), (62, items[0])]
    bench = spark.createDataFrame([(i, t, None) for i, t in enumerate(items)] + [(9, None, 1), (None, items[0], 1), (8, "", 1)], "item_id long, text string, extra int")
    got = decontaminate.leak_report(frame(spark, rows), bench).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r.item_ids for r in got}
    assert {k: v for k, v in found.items() if v} == {0: [0], 1: [1], 2: [2], 3: [3], 10: [1], 62: [0], None: [0]}
    chunked = decontaminate.leak_report(frame(spark, rows), bench, decontaminate.Rules(chunk=1)).collect()
    assert {r.doc_id: r.item_ids for r in chunked} == found
    assert not any(r.contaminated for r in decontaminate.leak_report(frame(spark, rows), bench.limit(0)).collect())
    assert decontaminate.leak_report(frame(spark, rows).limit(0), bench).count() == 0


def held_items(rows, items, words=13):
    """(doc_id, item) of each document that holds all n-grams of an item."""
    grams = lambda t: {tuple(t[k : k + words]) for k in range(len(t) - words + 1)}
    texts = [(i, grams(t.lower().split())) for i, t in rows]
    where = {}
    for i, g in texts:
        for x in g:
            where.setdefault(x, set()).add(i)
    return {(i, k) for k, t in enumerate(items) for i in set.intersection(*(where.get(x, set()) for x in grams(t.lower().split())))}


def test_copies_are_found_whatever_the_size_of_the_benchmark(spark):
    """2,000 texts, far more passages than one latent space has dimensions."""
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 300) % 20_000)) for i in range(400)]
    items = [" ".join(t.split()[at : at + 50]) for _, t in rows for at in range(3, 250, 59)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    truth = held_items(rows, items)
    assert len(items) == 2000 and len(truth) >= 2000
    for rules in (None, decontaminate.Rules(held=600)):
        got = decontaminate.leak_report(frame(spark, rows), bench, rules).collect()
        assert truth <= {(r.doc_id, i) for r in got for i in r.item_ids}


def test_a_copied_part_of_a_long_text_is_a_leak(spark):
    rnd = random.Random(12)
    some = lambda n: ["".join(rnd.choices("abcdefghij", k=5)) for _ in range(n)]
    text, short = some(150), some(59)
    put = lambda *parts: " ".join(some(90) + [w for p in parts for w in p] + some(90))
    parts = {1: text[40:100], 2: text[-50:], 3: text[20:44], 4: text[64:96], 5: text[0:8] + text[50:58] + text[140:148], 6: short[:25], 7: text[14:24]}
    rows = [(k, put(p)) for k, p in parts.items()] + [(8, put(w for k, w in enumerate(text[60:130]) if k % 8)), (9, put(some(60)))]
    bench = spark.createDataFrame([(0, " ".join(text)), (1, " ".join(short))], "item_id long, text string")
    got = {r.doc_id: (r.item_ids, round(r.overlap * 150)) for r in decontaminate.leak_report(frame(spark, rows), bench).collect()}
    assert {k for k, v in got.items() if v[0] == [0]} == {1, 2, 3, 4, 8} and {k for k, v in got.items() if not v[0]} == {5, 6, 7, 9}
    assert got[1][1] >= 60 and got[2][1] >= 50


def test_common_words_is_the_longest_common_subsequence():
    rnd = random.Random(6)
    for _ in range(50):
        a, b = ([bytes([rnd.randrange(4)]) for _ in range(rnd.randint(1, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common_words(a, b) == best[-1][-1]


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001").cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert 0 < docs.count() <= n
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == docs.count()


def test_pipeline_stages_by_plain_python(spark):
    """Line dedup and Jaccard stages give the rows that plain Python does; decontamination
    drops every document that holds all 13-grams of a benchmark text."""
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("length(text) < 4000").cache()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = stages["line_dedup"](spark, docs, folder).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=str) == sorted([(i, t) for i, t, _ in brute_lines(rows)], key=str)
    assert all(r.n_chars == len(r.text) for r in got)
    kept = [r.doc_id for r in stages["jaccard_join"](spark, docs, folder).collect()]
    assert sorted(kept) == sorted({i for i, _, c in brute_components(rows, 5, 80) if c == i})
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    left = {r.doc_id for r in stages["decontamination"](spark, docs, folder).collect()}
    held = {i for i, _ in held_items(rows, items)}
    assert held and not held & left and len(left) > len(rows) / 2


def state(index):
    """Counts, keepers and filtered keys of a line index, for comparison with another one."""
    refs = {bytes(r.key): (r.refs, r.keeper) for r in index.refs.collect()}
    held = sorted((r.doc_id, bytes(r.key)) for r in index.postings.collect())
    filters = {r.shard: bytes(r.table) for r in index.filters.collect()}
    return refs, held, filters


def test_small_changes_touch_their_own_keys_and_shards(spark):
    """One per cent inserted and deleted: the state is that of a fresh build, filters of other
    shards stay as they are, and only the changed documents' keys get new rows."""
    rng = random.Random(6)
    line = lambda k: f"line number {k} of the corpus"
    rows = [(i, "\n".join(line(rng.randrange(12_000)) for _ in range(6))) for i in range(2000)]
    extra = [(3000 + i, "\n".join([line(rng.randrange(12_000)), line(20_000 + i), line(20_000 + i // 2)])) for i in range(20)]
    extra += [(rows[5][0], line(30_000)), (rows[6][0], rows[6][1])]  # a known document with a new line, and one as it was
    first = line_dedup.LineIndex.build(frame(spark, rows))
    before = state(first)
    more = first.insert(frame(spark, extra))
    keys = {line_dedup.line_key(x) for _, t in extra[:-1] for x in t.split("\n")}
    assert {bytes(r.key) for r in more.touched.collect()} == keys
    whole = {}
    for i, t in rows + extra:
        whole[i] = f"{whole[i]}\n{t}" if i in whole else t
    after, fresh = state(more), state(line_dedup.LineIndex.build(frame(spark, list(whole.items()))))
    assert after[:2] == fresh[:2]
    shards = {r.shard for r in more.touched.filter("(was >= 2) <> (refs >= 2)").select(line_dedup._shard(more.shards)).collect()}
    assert 0 < len(shards) <= 40
    assert {k: v for k, v in after[2].items() if k not in shards} == {k: v for k, v in before[2].items() if k not in shards}

    ids = [r[0] for r in rows[::100]] + [3000, 3001]
    less = more.delete(spark.createDataFrame([(i,) for i in ids], "id long"))
    left = {i: t for i, t in whole.items() if i not in ids}
    gone = {line_dedup.line_key(x) for i in ids for x in whole[i].split("\n")}
    assert {bytes(r.key) for r in less.touched.collect()} == gone
    assert state(less)[:2] == state(line_dedup.LineIndex.build(frame(spark, list(left.items()))))[:2]
    assert (less.held, less.changes) == (len(state(less)[1]), 2)
    got = line_dedup.dedup_lines(frame(spark, list(left.items())), less).select("doc_id", "kept_text", "n_lines").collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(list(left.items()))


def test_many_changes_are_written_together_and_full_filters_made_anew(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "COMPACT", 2)
    monkeypatch.setattr(line_dedup, "MIN_SHARDS", 2)
    line = lambda k: f"line number {k} of the corpus"
    index, held = line_dedup.LineIndex.build(frame(spark, [(0, line(0)), (1, line(0))])), [(0, line(0)), (1, line(0))]
    for k in range(1, 4):  # each adds far more shared keys than the filters have room for
        new = [(10 * k + j, "\n".join(line(1000 * k + x) for x in range(60 * k))) for j in range(2)]
        index, held = index.insert(frame(spark, new)), held + new
    assert index.changes == 1
    got = line_dedup.dedup_lines(frame(spark, held), index).select("doc_id", "kept_text", "n_lines").collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(held)
    nothing = index.delete(spark.createDataFrame([(i,) for i, _ in held], "id long"))
    assert nothing.held == 0 and nothing.refs.count() == nothing.postings.count() == 0
