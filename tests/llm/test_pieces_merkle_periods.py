"""SentencePiece round trips, Merkle manifests and periodic runs against the library and plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sheafline.llm import merkle, periods, queries, sentence_pieces

from .test_per_document import FOLDER, WORD, some_texts


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- SentencePiece ----------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


ODD = [*"abcdehnrt.,'01 ", "  ", "▁", "\n", "\t", "<s>", "</s>", "<unk>", "<0x0A>", "é", "é", "漢字", "😀", "\x00", "\xa0", "　", "ﬁ", "the "]


def test_chunks_equal_the_library(model, library, monkeypatch):
    table = sentence_pieces.Chunks(model)
    assert table.can_cut
    rows = some_texts(1, ODD, 3000, 30) + [" " * k for k in range(9)] + ["x" + " " * k for k in range(5)] + [" " * k + "x y" for k in range(5)]
    rows += ["▁", "a▁", "▁a", "a ▁", "ab" * 4000, "漢" * 3000, " ".join(["word"] * 5000)]
    monkeypatch.setattr(sentence_pieces, "CHUNKS_KEPT", 500)
    for at in range(0, len(rows), 100):
        some = rows[at : at + 100]
        ids, decoded = table.round_trip(some)
        assert ids.to_pylist() == [library.encode(t) for t in some]
        assert decoded.to_pylist() == [library.decode(library.encode(t)) for t in some]


def test_each_distinct_chunk_is_segmented_once(model):
    table = sentence_pieces.Chunks(model)

    class Counting:
        calls: list[str] = []

        def encode(self, new, num_threads):
            self.calls += new
            return real.encode(new, num_threads=num_threads)

        def decode(self, ids):
            return real.decode(ids)

    real, table.library = table.library, Counting()
    table.round_trip(["one two one", "two three", "one  two"])
    table.round_trip(["three two one"])
    assert sorted(Counting.calls) == [" two", "one", "three", "two"]


def test_a_model_that_lets_pieces_cross_is_given_whole_texts(model, library):
    table = sentence_pieces.Chunks(model)
    table.can_cut = False
    rows = ["", "two words", " and  more "]
    ids, decoded = table.round_trip(rows)
    assert ids.to_pylist() == library.encode(rows) and decoded.to_pylist() == library.decode(library.encode(rows))


def test_sentencepiece_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_sentencepiece_round_trip"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]])
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert row["decoded_sha256"] == sha(library.decode(ids))


def test_sentencepiece_odd_rows(spark, odd_docs, model, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "SLICE_CHARS", 50)
    both = sentence_pieces.round_trip(odd_docs, model)
    rows = both.collect()
    assert both.columns == ["doc_id", "ids", "decoded"] and len(rows) == odd_docs.count()
    again = sentence_pieces.decode(sentence_pieces.encode(odd_docs, model), model).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert all(r["ids"] == [] and r["decoded"] == "" for r in rows if r["doc_id"] in (2, 3))
    assert {len(r["ids"]) for r in rows if r["doc_id"] is None} > {0}
    assert sentence_pieces.encode(odd_docs.limit(0), model).count() == 0
    nothing = spark.createDataFrame([(1, None), (None, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in sentence_pieces.decode(nothing, model).collect()] == ["", ""]


# ---- Merkle manifest --------------------------------------------------------


def plain_manifest(rows: list[tuple], arity: int, told: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows (doc_id, lang, text)."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes):
        """The root, and per node its siblings (before, behind) on the way up."""
        ways = [[] for _ in nodes]
        owners = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            upper, upper_owners = [], []
            for at in range(0, len(nodes), arity):
                run = nodes[at : at + arity]
                for k in range(len(run)):
                    for i in owners[at + k]:
                        ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
                upper.append(sha("".join(run)))
                upper_owners.append([i for o in owners[at : at + arity] for i in o])
            nodes, owners = upper, upper_owners
        return nodes[0], ways

    groups: dict = {}
    for row, claim in zip(rows, told):
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), leaf(claim), row[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [climb([m[2] for m in sorted(groups[g])]) for g in names]
    root, high = climb([t[0] for t in trees])
    out = []
    for name, (subroot, ways), rest in zip(names, trees, high):
        for (_, _, digest, claim, doc), way in zip(sorted(groups[name]), ways):
            way = way + rest
            now = claim
            for before, behind in way:
                now = sha(before + now + behind)
            out.append((doc, digest, subroot, root, sha("".join(b + a for b, a in way)), now, now == root))
    return out


@pytest.mark.parametrize(("arity", "sizes"), [(8, (1, 8, 9, 70, 130)), (2, (1, 2, 5, 33)), (3, (28,)), (8, (1,))])
def test_manifest_equals_plain_one(spark, arity, sizes):
    names = [None, "", "é", "en", "z"]
    rows = [(i * 10 + len(str(size)), names[k], f"Text {i} Ünd") for k, size in enumerate(sizes) for i in range(size)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    claimed = {"text": F.when(F.col("doc_id") % 20 < 10, F.lower("text")).otherwise(F.col("text"))}
    proven = merkle.manifest(docs, ("doc_id", "lang", "text"), arity=arity, claimed=claimed)
    told = [(d, g, t.lower() if d % 20 < 10 else t) for d, g, t in rows]
    columns = ["doc_id", "leaf", "subroot", "root", merkle.proof_digest("path"), "folded_root", "verified"]
    got = list(map(tuple, proven.select(*columns).collect()))
    assert sorted(got) == sorted(plain_manifest(rows, arity, told))
    assert {r[-1] for r in got} <= {True, False} and any(not r[-1] for r in got)


def test_untouched_rows_are_verified_and_only_they(spark):
    docs = spark.createDataFrame([(i, "en" if i % 2 else None, f"text {i}") for i in range(100)], "doc_id long, lang string, text string")
    fields = ("doc_id", "lang", "text")
    assert merkle.manifest(docs, fields).filter("verified").count() == 100
    other = {"lang": F.when(F.col("doc_id") == 7, "de").otherwise(F.col("lang"))}
    assert [r["doc_id"] for r in merkle.manifest(docs, fields, claimed=other).filter("not verified").collect()] == [7]


def test_numbered_spreads_a_group_and_leaves_no_gap(spark):
    rows = spark.range(3000).select(F.lit("a").alias("g"), F.expr("id div 2").alias("k")).unionByName(spark.createDataFrame([("b", 1), ("b", None)], "g string, k long"))
    out = merkle.numbered(rows.repartition(6), "g", "k")
    got = out.orderBy("g", "i").collect()
    assert [r["i"] for r in got] == [*range(3000), 0, 1] and {(r["g"], r["n"]) for r in got} == {("a", 3000), ("b", 2)}
    assert [r["k"] for r in got] == sorted(r["k"] for r in got[:3000]) + [None, 1]


def test_manifest_odd_rows(spark, odd_docs):
    fields = ("doc_id", "other", "text")
    proven = merkle.manifest(odd_docs, fields, group_col="other").collect()
    rows = [(r["doc_id"], r["other"], r["text"]) for r in odd_docs.collect()]
    assert len(proven) == len(rows) and all(r["verified"] for r in proven)
    want = plain_manifest(rows, 8, rows)
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["folded_root"]) for r in proven) == sorted((str(w[0]), w[1], w[2], w[5]) for w in want)
    assert merkle.manifest(odd_docs.limit(0), fields, group_col="other").count() == 0


# ---- Periodic runs ----------------------------------------------------------


def plain_runs(words: list, least: int, times: int) -> list[tuple[int, int, int]]:
    found = {}
    n = len(words)
    for q in range(1, n // times + 1):
        start = 0
        while start + q < n:
            stop = start
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            if stop > start and stop - start + q >= max(least, times * q):
                found.setdefault((start, stop - start + q), q)
            start = stop + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def repetitive(r: random.Random) -> list[str]:
    words: list[str] = []
    for _ in range(r.randint(0, 6)):
        root = [r.choice("abc") for _ in range(r.randint(1, 9))]
        words += (root * r.randint(1, 12))[: r.randint(1, 60)]
        words += [r.choice("abcd") for _ in range(r.randint(0, 4))]
    return words


def test_runs_equal_plain_ones():
    r = random.Random(3)
    texts = [repetitive(r) for _ in range(400)]
    texts += [["a"] * 700, ["a", "b"] * 300 + ["a"], [], ["a"], list("abcabcab"), [f"w{i % 97}" for i in range(1000)]]
    for least, times in ((24, 3), (1, 3), (6, 4)):
        flat = [w for t in texts for w in t]
        names = {w: i for i, w in enumerate(sorted(set(flat)))}
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        found = periods.find_runs(np.array([names[w] for w in flat], np.int64), bounds, least, times)
        got: list[list] = [[] for _ in texts]
        for text, start, stop, period in found.tolist():
            got[text].append((start - int(bounds[text]), stop - start, period))
        assert [sorted(g) for g in got] == [plain_runs(t, least, times) for t in texts]
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(3, np.int64), np.array([0, 3]), 1, 2)


def test_collapsed_texts(spark, monkeypatch):
    monkeypatch.setattr(periods, "SLICE_BYTES", 500)
    r = random.Random(4)
    texts = [repetitive(r) for _ in range(100)]
    rows = [(i, r.choice([" ", "\n", " \t"]).join(t)) for i, t in enumerate(texts)]
    for row in periods.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        words = texts[row["doc_id"]]
        want = plain_runs(words, 24, 3)
        assert [tuple(x) for x in row["runs"]] == want and row["n_words"] == len(words)
        assert row["collapsed"] == " ".join(collapse(words, want))


def test_runs_query_equals_plain_one(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = queries.QUERIES["op13_periodic_runs"](spark, FOLDER).collect()
    assert len(got) == len(texts) and sum(r["n_runs"] > 0 for r in got) > 10
    for row in got:
        words = WORD.findall(texts[row["doc_id"]])
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        elif n > 2000:
            continue
        runs = plain_runs(words, 24, 3)
        assert row["n_runs"] == len(runs) and row["runs_sha256"] == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert row["collapsed_sha256"] == sha(" ".join(collapse(words, runs)))
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)


def test_runs_odd_rows(spark, odd_docs):
    out = periods.periodic_runs(odd_docs)
    rows = out.collect()
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"] and len(rows) == odd_docs.count()
    assert all(r["runs"] == [] and r["collapsed"] == "" for r in rows if r["doc_id"] in (2, 3, 7))
    assert periods.periodic_runs(odd_docs.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "x " * 200_000), (2, "a b c " * 50_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periods.periodic_runs(long).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 200_000, 1)] and got[1]["collapsed"] == "x"
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 150_000, 3)] and got[2]["collapsed"] == "a b c"
