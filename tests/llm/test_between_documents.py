"""Operators that compare documents, against plain versions."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheafline.llm import decontamination, lm_scores, ngram_join, substrings
from sheafline.llm.common import checkpointed
from sheafline.llm.components import components

DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def changed(r: random.Random, words: list[str], n: int) -> list[str]:
    words = list(words)
    for _ in range(n):
        i, kind = r.randrange(len(words)), r.random()
        if kind < 0.5:
            words[i] = f"m{r.randrange(10**6)}"
        elif kind < 0.75:
            words.insert(i, f"i{r.randrange(10**6)}")
        elif len(words) > 1:
            del words[i]
    return words


# ---- components -------------------------------------------------------------


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + r.randrange(1, 40)) for _ in range(60)] + [(7, 7), (300, 200), (200, 300)]
    edges += [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(60)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {n: find(n) for n in parent if find(n) != n}
    assert {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()} == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_write_few_files_for_few_edges(spark, monkeypatch):
    written = []

    def noted(df, name):
        out = checkpointed(df, name)
        written.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr("sheafline.llm.components.checkpointed", noted)
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "64")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    edges = [(30 * i, 30 * i + j) for i in range(20) for j in range(1, 30)]
    found = components(session.createDataFrame(edges, "u long, v long"))
    assert {(x["node"], x["root"]) for x in found.collect()} == {(v, u) for u, v in edges}
    steps = [n for name, n in written if name != "edges"]
    assert steps and max(steps) <= spark.sparkContext.defaultParallelism


# ---- n-gram Jaccard join ----------------------------------------------------


def plain_groups(docs, length=4, num=85, den=100):
    sets = []
    for _, text in docs:
        words = WORD.findall(lower(text or ""))
        sets.append({tuple(words[i : i + length]) for i in range(len(words) - length + 1)} or ({tuple(words)} if words else set()))
    holders, shared, parent = defaultdict(list), Counter(), list(range(len(docs)))
    for i, grams in enumerate(sets):
        for gram in grams:
            shared.update((j, i) for j in holders[gram])
            holders[gram].append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            parent[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((docs[i][0], len(sets[i]), least[find(i)]) for i in range(len(docs)))


def near_copies(seed: int) -> list[tuple[int, str | None]]:
    r = random.Random(seed)
    docs: list[tuple[int, str | None]] = []
    for _ in range(40):
        base = [f"v{r.randrange(500)}" for _ in range(r.choice([3, 5, 8, 12, 20, 40, 60, 150, 300]))]
        for _ in range(r.choice([1, 2, 5, 12])):
            docs.append((len(docs), " ".join(changed(r, base, r.randint(0, max(1, len(base) // 25))))))
    base = now = [f"v{r.randrange(500)}" for _ in range(160)]
    for _ in range(120):
        now = changed(r, now if r.random() < 0.5 else base, 1)
        docs.append((len(docs), " ".join(now)))
    docs += [(9000, None), (9001, ""), (9002, "a b"), (9003, "A  b"), (9004, "a"), (9005, "a"), (9006, " \n")]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("blocks", [None, (5000, 25, 2)])
def test_groups_equal_plain_ones(spark, monkeypatch, blocks):
    if blocks:
        for name, value in zip(("BLOCK_GRAMS", "BLOCK_TEXTS", "PIVOTS"), blocks):
            monkeypatch.setattr(ngram_join, name, value)
    docs = near_copies(5)
    found = sorted(tuple(r) for r in ngram_join.jaccard_groups(spark.createDataFrame(docs, DOCS)).collect())
    assert found == plain_groups(docs)


@pytest.mark.parametrize("threshold", [(85, 100), (1, 2), (1, 1)])
def test_linked_sets_share_enough_keys(threshold):
    num, den = threshold
    r = random.Random(6)
    parts = ngram_join.Parts(threshold)
    for _ in range(400):
        size = r.choice([1, 2, 3, 5, 6, 7, 8, 13, 20, 50, 120, 400])
        one = [r.getrandbits(60) for _ in range(size)]
        other = one[r.randint(0, int(size * (1 - num / den))) :]
        other = other + [r.getrandbits(60) for _ in range(r.randint(0, int(size * (den - num) / den)))]
        both = len(set(one) & set(other))
        if not other or den * both < num * len(set(one) | set(other)):
            continue
        grams = np.array(one + other, np.uint64)
        owner, key = parts.keys(grams, np.array([0, len(one), len(grams)]))
        shared = Counter(k % (1 << ngram_join.CLASS_BITS) for k in set(key[owner == 0].tolist()) & set(key[owner == 1].tolist()))
        assert any(n >= parts.need[kind] for kind, n in shared.items())
        sets, kinds, least = parts.least(grams, np.array([0, len(one), len(grams)]))
        owed = [dict(zip(kinds[sets == k].tolist(), least[sets == k].tolist())) for k in (0, 1)]
        assert {k for o in owed for k in o} == {k % (1 << ngram_join.CLASS_BITS) for k in key.tolist()}
        assert any(n >= max(owed[0].get(kind, 0), owed[1].get(kind, 0)) for kind, n in shared.items())


def test_a_passage_in_half_of_all_texts_chains_nothing(spark, monkeypatch):
    """Texts that share one passage, and near copies among them, in blocks far smaller than the texts."""
    r = random.Random(9)
    passage = [f"p{i}" for i in range(30)]
    docs = []
    for i in range(300):
        words = [f"v{r.randrange(5000)}" for _ in range(r.choice([120, 150, 200]))]
        if i % 2:
            at = r.randrange(len(words))
            words = words[:at] + passage + words[at:]
        docs.append((i, " ".join(words)))
        if i % 10 == 0:
            docs.append((1000 + i, " ".join(changed(r, words, 2))))
    placed = []
    blocks_of = ngram_join._links_of_blocks

    def watched(docs, rows, *rest):
        placed.append(rows.count())
        return blocks_of(docs, rows, *rest)

    monkeypatch.setattr(ngram_join, "_links_of_blocks", watched)
    found = sorted(tuple(x) for x in ngram_join.jaccard_groups(spark.createDataFrame(docs, DOCS)).collect())
    assert found == plain_groups(docs)
    # Only the copies and their originals are joined, once.
    assert len(placed) == 1 and placed[0] <= 80


def test_texts_of_common_passages_do_not_meet(spark, monkeypatch):
    """Texts made of the same few passages chain by keys; only what may link is joined, once."""
    for name, value in (("BLOCK_GRAMS", 5000), ("BLOCK_TEXTS", 60)):
        monkeypatch.setattr(ngram_join, name, value)
    r = random.Random(11)
    passages = [[f"p{i}.{k}" for k in range(40)] for i in range(16)]
    docs = []
    for i in range(240):
        words = [w for p in r.sample(passages, 5) for w in p]
        at = r.randrange(0, len(words), 40)
        words = words[:at] + [f"v{r.randrange(10**6)}" for _ in range(50)] + words[at:]
        docs.append((i, " ".join(words)))
        if i % 12 == 0:
            docs.append((1000 + i, " ".join(changed(r, words, 2))))
    met = []
    blocks_of = ngram_join._links_of_blocks

    def watched(docs, rows, *rest):
        met.append(rows.selectExpr("sum(size(blocks)) AS n").first()["n"])
        return blocks_of(docs, rows, *rest)

    monkeypatch.setattr(ngram_join, "_links_of_blocks", watched)
    found = sorted(tuple(x) for x in ngram_join.jaccard_groups(spark.createDataFrame(docs, DOCS)).collect())
    assert found == plain_groups(docs)
    assert len({x[2] for x in found}) < len(docs)
    assert len(met) == 1 and met[0] <= 80


def test_least_follows_the_size_of_the_set():
    """A set at the lower end of its class can differ from its partners in fewer n-grams than the class allows for."""
    parts = ngram_join.Parts((85, 100))
    r = random.Random(12)
    kind = next(k for k in range(len(parts.start)) if parts.start[k] > 400)
    most = int(parts.start[kind + 1]) - 1
    for size in (int(parts.start[kind]), most):
        grams = np.array([r.getrandbits(60) for _ in range(size)], np.uint64)
        _, kinds, least = parts.least(grams, np.array([0, size]))
        owed = dict(zip(kinds.tolist(), least.tolist()))
        partner = min(size * 100 // 85, most)
        empty = int(parts._empty(parts._slots(grams, np.array([0, size]), np.array([0]), np.array([kind]))[1], np.array([kind]))[0])
        assert owed[kind] == parts.parts[kind] - 15 * (size + partner) // 185 - empty
    assert owed[kind] == parts.spare[kind] + 1 - empty


def test_tree_groups_of_a_block():
    r = random.Random(7)
    for _ in range(60):
        sets = []
        for _ in range(r.randint(1, 4)):
            base = r.sample(range(1000), r.randint(1, 80))
            for _ in range(r.randint(1, 8)):
                sets.append(sorted(set(r.sample(base, max(1, len(base) - r.randint(0, 5)))) | set(r.sample(range(1000), r.randint(0, 4)))))
        group = ngram_join.groups_in_block([np.array(s, np.uint64) for s in sets])
        parent = list(range(len(sets)))
        for a in range(len(sets)):
            for b in range(a):
                n = len(set(sets[a]) & set(sets[b]))
                if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((parent[a], parent[b]))
                    parent = [x if p == y else p for p in parent]
        assert group.tolist() == parent


def test_jaccard_odd_rows(spark, odd_docs):
    rows = ngram_join.jaccard_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {(r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] in (2, 3, 7)} == {(0, 2), (0, 3), (0, 7)}
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 4)} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {None}
    assert ngram_join.jaccard_groups(odd_docs.limit(0)).count() == 0


def test_a_written_step_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tag = spark._jvm.scala.reflect.ClassTag.apply(spark._jvm.java.lang.Class.forName("java.io.File"))

    def files() -> set[str]:
        return {f.getName() for f in disk.getAllFiles().toArray(tag) if f.getName().startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting_before, before = spark.conf.get(setting), files()
    rows = checkpointed(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counted")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert rows.count() == 7 and spark.conf.get(setting) == setting_before


# ---- substring dedup --------------------------------------------------------


def plain_removal(docs, length):
    first, out = {}, []
    words = [(doc, (text or "").encode().split()) for doc, text in docs]
    for doc, w in words:
        for i in range(len(w) - length + 1):
            run = tuple(w[i : i + length])
            first[run] = min(first.get(run, doc), doc)
    for doc, w in words:
        gone = {i + k for i in range(len(w) - length + 1) if first[tuple(w[i : i + length])] < doc for k in range(length)}
        out.append((doc, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("length", [1, 2, 4, 7, 50])
def test_removal_equals_a_plain_one(spark, length):
    r = random.Random(length)
    if length == 50:
        passages = [[f"p{k}w{i}" for i in range(r.choice([49, 50, 51, 80]))] for k in range(6)]
        docs = []
        for i in range(60):
            words = [f"d{r.randrange(40)}" for _ in range(r.randint(0, 60))]
            for _ in range(r.randint(0, 3)):
                words += r.choice(passages) + [f"e{r.randrange(40)}"] * r.randint(0, 2)
            docs.append((i, " ".join(words)))
        docs += [(70, docs[3][1]), (71, docs[3][1]), (72, "x " * 120), (73, "x " * 90)]
    else:
        docs = [(i, "".join(r.choice(["a ", "b ", "c\n", "a\t "]) for _ in range(r.randint(0, 40)))) for i in range(100)]
        docs += [(3, None), (107, "a " * 100), (109, "a " * 90), (109, "b a " * 20)]
    rows = substrings.remove_repeats(spark.createDataFrame(docs, DOCS), length).collect()
    assert sorted((x["doc_id"], x["n_words"], x["n_removed"], x["kept"]) for x in rows) == plain_removal(docs, length)
    assert all(x["left"].split() == x["kept"].split() for x in rows)


def test_removal_keeps_white_space_and_odd_rows(spark, odd_docs):
    docs = spark.createDataFrame([(1, "a b c d"), (2, " x\n\na  b c\td\n y z ")], DOCS)
    assert {r["doc_id"]: r["left"] for r in substrings.remove_repeats(docs, 4).collect()}[2] == " x\n\ny z "
    rows = substrings.remove_repeats(odd_docs, 5, carry=("row", "kept")).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["n_removed"] == 0 for r in rows if r["doc_id"] in (None, 1, 2, 3, 5, 6, 7))
    assert substrings.remove_repeats(odd_docs.limit(0)).count() == 0


# ---- decontamination --------------------------------------------------------


def plain_leaks(docs, bench):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    items = [(i, len(words(t)), Counter(grams(words(t)))) for i, t in bench]
    found = set()
    for doc, text in docs:
        w = words(text)
        own = grams(w)
        for item, size, count in items:
            if size < 5:
                continue
            for start in range(max(1, len(w) - size + 1)):
                window = Counter(own[start : start + min(size, len(w)) - 4])
                both = sum((window & count).values())
                if both and 10 * both >= 8 * (sum(window.values()) + sum(count.values()) - both):
                    found.add((doc, item))
    return found


def test_leaks_equal_plain_ones(spark):
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    bench = [(k, " ".join(r.choice(vocabulary) for _ in range(r.choice([3, 5, 6, 10, 30, 60])))) for k in range(25)]
    bench += [(90, "a b a b a b a b a b a b c"), (91, None), (92, "")]
    docs: list[tuple[int | None, str | None]] = []
    for k in range(120):
        words = changed(r, (r.choice(bench[:25])[1] or "").split(), r.choice([0, 0, 1, 1, 2, 3]))
        around = [[r.choice(vocabulary) for _ in range(r.choice([0, 0, 3, 50]))] for _ in range(2)]
        docs.append((k, ", ".join(around[0] + words + around[1]).upper()))
    docs += [(900, None), (901, ""), (902, "A b a b a b a b a b a b c!"), (903, "a b"), (None, bench[4][1])]
    rows = decontamination.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(x["doc_id"], x["item_id"]) for x in rows} == plain_leaks(docs, bench)
    assert len(rows) == len({(x["doc_id"], x["item_id"]) for x in rows})


def test_leaks_of_items_that_repeat_themselves_or_are_short(spark):
    """Pairs at and just above the threshold whose fingerprints lie far apart."""
    r = random.Random(14)
    bench = [(1, "a b " * 7 + "a"), (2, "c c c c c c c c c c"), (3, "d e f " * 6), (4, "g h g h g h g h g h g i j k l m"), (5, "n o p q r")]
    bench += [(10 + k, " ".join(r.choice("stuv") for _ in range(r.randint(5, 24)))) for k in range(12)]
    bench += [(40 + k, " ".join(f"w{r.randrange(40)}" for _ in range(r.randint(5, 12)))) for k in range(8)]
    docs: list[tuple[int | None, str | None]] = [(1, "b a " * 7 + "b"), (2, "c " * 9), (3, "e f d " * 6), (4, "h g " * 8 + "i j k l m"), (5, "n o p q r s")]
    for k in range(150):
        words = changed(r, r.choice(bench)[1].split(), r.choice([0, 1, 1, 2]))
        turn = r.randrange(len(words))
        words = words[turn:] + words[:turn] if k % 2 else words
        docs.append((100 + k, " ".join([*(r.choice("stuvab") for _ in range(r.randint(0, 6))), *words, *(r.choice("xyz") for _ in range(r.randint(0, 4)))])))
    schema = "item_id long, text string"
    rows = decontamination.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, schema)).collect()
    want = plain_leaks(docs, bench)
    assert {(x["doc_id"], x["item_id"]) for x in rows} == want
    assert (1, 1) in want and len(want) > 30


def test_blocks_find_every_print_within_the_radius(spark):
    from pyspark.sql import functions as F

    r = random.Random(8)
    pairs = []
    for i in range(300):
        one = r.getrandbits(64)
        other = one
        for j in r.sample(range(64), r.randint(0, decontamination.RADIUS)):
            other ^= 1 << j
        pairs.append((i, *(x - (1 << 64) if x >> 63 else x for x in (one, other))))
    rows = spark.createDataFrame(pairs, "id int, one long, other long")
    left = rows.select("id", F.inline(decontamination.block_values(F.col("one"))))
    right = rows.select("id", F.inline(decontamination.near_block_values(F.col("other"))))
    assert left.join(right, ["id", "block", "value"]).select("id").distinct().count() == 300


def test_leaks_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([(None, "one two three four five six seven eight nine ten"), (1, None)], "item_id long, text string")
    kept = decontamination.clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns and {r["doc_id"] for r in kept.collect()} == {None, 2, 3, 5, 6, 7}
    assert decontamination.clean(odd_docs, bench.limit(0)).count() == odd_docs.count()
    assert decontamination.leaks(odd_docs.limit(0), bench).count() == 0


# ---- language model ---------------------------------------------------------


def plain_scores(docs, order, backoff=0.4):
    words = [WORD.findall(lower(t or "")) for _, t in docs]
    own = [[Counter(tuple(w[i - k : i + 1]) for i in range(k, len(w))) for k in range(order)] for w in words]
    total = [sum((o[k] for o in own), Counter()) for k in range(order)]
    every, out = sum(map(len, words)), []
    for (doc, _), w, o in zip(docs, words, own):
        count = lambda g: total[len(g) - 1][g] - o[len(g) - 1][g]
        score, unseen = 0.0, 0
        for i in range(len(w)):
            unseen += count((w[i],)) == 0
            for k in range(min(order - 1, i), 0, -1):
                gram = tuple(w[i - k : i + 1])
                if count(gram) and count(gram[:-1]):
                    score += math.log(count(gram) / count(gram[:-1]))
                    break
                score += math.log(backoff)
            else:
                score += math.log(max(count((w[i],)), 1) / max(every - len(w), 1))
        out.append((doc, len(w), unseen, score))
    return sorted(out)


@pytest.mark.parametrize("order, block", [(1, 200), (2, 200), (3, 100), (2, 1 << 24)])
def test_scores_equal_plain_ones(spark, monkeypatch, order, block):
    monkeypatch.setattr(lm_scores, "BLOCK_BYTES", block)
    r = random.Random(order)
    docs = [(i, " ".join(r.choice("a b c A d e".split()) for _ in range(r.randint(0, 12)))) for i in range(60)] + [(900, None), (901, "")]
    rows = lm_scores.backoff_scores(spark.createDataFrame(docs, DOCS), order).collect()
    found = sorted((x["doc_id"], x["n_words"], x["n_unseen"], x["log_score"]) for x in rows)
    for one, want in zip(found, plain_scores(docs, order), strict=True):
        assert one[:3] == want[:3] and one[3] == pytest.approx(want[3])


def test_packed_numbers():
    r = np.random.default_rng(1)
    for n in (0, 1, 1000):
        values = np.sort(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert (lm_scores.unpack(lm_scores.pack(values)) == values).all()


def test_score_odd_rows(spark, odd_docs):
    rows = lm_scores.backoff_scores(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["log_score"] == 0 and r["mean_log_score"] is None for r in rows if r["n_words"] == 0)
    assert lm_scores.backoff_scores(odd_docs.limit(0)).count() == 0


def test_first_of_equal_rows_with_hot_keys(spark):
    from pyspark.sql import functions as F

    from sheafline.llm import common

    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 500).alias("a"), F.lit("x").alias("b")
    )
    out = common.with_first(rows, ["a", "b"])
    assert out.columns[-1] == "first" and out.count() == 3000
    want = {r["a"]: r["m"] for r in rows.groupBy("a").agg(F.min("doc_id").alias("m")).collect()}
    assert all(r["first"] == want[r["a"]] for r in out.collect())
    # No task of the way back has more than a part of the hot key.
    changes = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in changes}
    try:
        for k, v in changes.items():
            spark.conf.set(k, v)
        sizes = common.with_first(rows, ["a", "b"]).filter("a = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(r["count"] for r in sizes) < 500
