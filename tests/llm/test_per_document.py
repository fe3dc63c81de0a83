"""Operators that judge each document by itself."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from sheafline.llm import bpe, chat, licenses, quality, queries, token_counts, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def some_texts(seed: int, alphabet: list[str], n: int = 300, longest: int = 60) -> list[str]:
    r = random.Random(seed)
    return ["", " ", *("".join(r.choice(alphabet) for _ in range(r.randint(0, longest))) for _ in range(n))]


# ---- BPE --------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


ODD = [*"abcdefghiklmnopqrstuvwxyz'0123.,!?- \n\t", "'s", "Σ", "İ", "e\u0301", "漢字", "😀", "<|endoftext|>", "</w>", "\xa0", "\x1c", "\x85", "²", "ß", "\x00"]


def test_bpe_equals_the_library_and_decodes_as_it_does(tokenizer):
    from tokenizers import Tokenizer

    library, own, table = Tokenizer.from_str(tokenizer), bpe.Bpe.of(tokenizer), bpe.Texts.of(tokenizer)
    vocabulary = [t.replace("</w>", "") for t in library.get_vocab()]
    r = random.Random(1)
    rows = some_texts(1, ODD) + some_texts(2, list("aehinorst"), 100, 300) + ["a" * 3000, "ha" * 2000, "!" * 2500]
    rows += ["".join(r.choice(vocabulary) for _ in range(r.randint(1, 4))) for _ in range(2000)]
    for text, want in zip(rows, library.encode_batch(rows, add_special_tokens=False)):
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want.ids
        assert table.decode(packed) == library.decode(want.ids, skip_special_tokens=False)


def test_bpe_tables_may_be_cleared_at_any_time(tokenizer, monkeypatch):
    own = bpe.Bpe(tokenizer)
    text = "the quick brown fox jumps over the lazy dog " * 3
    want = own.encode(text)
    monkeypatch.setattr(bpe, "WORDS_KEPT", 0)
    monkeypatch.setattr(bpe, "PAIRS_KEPT", 1)
    own.words.clear()
    assert own.encode(text) == want


def test_bpe_query_equals_the_library(spark, tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_bpe_round_trip"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_rows(spark, odd_docs, tokenizer):
    rows = bpe.decode(bpe.encode(odd_docs, tokenizer), tokenizer).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(map(str, rows)) == sorted(map(str, bpe.round_trip(odd_docs, tokenizer).collect()))
    assert all(len(r["ids"]) == 0 and r["decoded"] == "" for r in rows if r["doc_id"] in (2, 3, 7))
    assert bpe.encode(odd_docs.limit(0), tokenizer).count() == 0


# ---- token counts -----------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.mark.parametrize("size", [1, 3, 50, 4096])
def test_cut_texts_have_as_many_tokens(model, size):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), token_counts.Pieces.of(model)
    assert own.can_cut
    alphabet = ["a", "b", " ", "  ", "▁", "\n", "\r", "é", "漢", "\u3000", "{", "1", "x ", "<unk>", "<s>", "😀", "\x00"]
    rows = some_texts(3, alphabet, 800)
    assert own.counts(rows, size, 200).tolist() == [len(library.encode(t)) for t in rows]


def test_token_query_equals_the_library(spark, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in queries.QUERIES["op10_token_counts"](spark, FOLDER).collect():
        n = len(library.encode(texts[row["doc_id"]]))
        assert (row["n_tokens"], row["n_bytes"], row["over_limit"]) == (n, len(texts[row["doc_id"]].encode()), n > 4096)


def test_token_odd_rows(spark, odd_docs, model):
    rows = token_counts.token_counts(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["n_tokens"] == 0 and r["n_bytes"] == 0 for r in rows if r["doc_id"] in (2, 3))
    assert token_counts.token_counts(odd_docs.limit(0), model).count() == 0


# ---- URL filter -------------------------------------------------------------


def test_urls(spark):
    cases = {
        "https://A.Example.ORG/es/1?x": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/15#t": ("example.org", "/en/15", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://x.com/fr/porn": ("x.com", "/fr/porn", "com/fr/", "allow"),
        "http://x.com/de/1": ("x.com", "/de/1", "com/de/", "block"),
        "http://x.net/porn": ("x.net", "/porn", None, "block"),
        "http://x.net/pornography": ("x.net", "/pornography", None, "allow"),
        "http://x.net/free-free": ("x.net", "/free-free", None, "allow"),
        "http://x.net/free?a=Bonus": ("x.net", "/free", None, "block"),
        "http://example.org": ("example.org", "", None, "allow"),
        "no scheme/xxx": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "a://b.org/c://d": ("b.org", "/c://d", "org/", "allow"),
    }
    pages = spark.createDataFrame([(i, u, "t") for i, u in enumerate(cases)], "page_id long, url string, verdict string")
    rows = {r["page_id"]: r for r in url_filter.url_verdicts(pages).collect()}
    for i, want in enumerate(cases.values()):
        assert tuple(rows[i][c] for c in ("host", "path", "rule", "verdict")) == want
    assert url_filter.url_verdicts(pages.limit(0)).count() == 0
    assert url_filter.url_terms(pages, [], {}).filter("size(strict_terms) + size(soft_terms) > 0").count() == 0


def test_urls_with_weights_and_odd_rows(spark):
    soft = {"adult": 3, "win": 2, "free": 2, "best": 1, "sale": 1}
    assert max(url_filter.SOFT.values()) < url_filter.SOFT_LIMIT and set(url_filter.SOFT.values()) == {1, 2, 3}
    assert not set(url_filter.SOFT) & set(url_filter.STRICT)
    cases = [
        (1, "http://x.net/adult", 3, "allow"),  # no soft term alone
        (2, "http://x.net/adult/adult-adult", 3, "allow"),  # the same again is no further hit
        (3, "http://x.net/adult?best", 4, "block"),
        (4, "http://x.net/win/free", 4, "block"),
        (5, "http://x.net/win/best", 3, "allow"),
        (6, "http://x.net/win/best/sale", 4, "block"),
        (7, "http://x.net/wins/freely/bestow", 0, "allow"),  # parts of words
        (8, "http://x.net/" + "a/" * 200_000 + "adult-best", 4, "block"),
        (None, "http://x.net/win_free", 4, "block"),  # "_" ends a word
        (4, "http://x.net/win/free", 4, "block"),
    ]
    pages = spark.createDataFrame([(i, u, "other", 7) for i, u, _, _ in cases], "page_id long, url string, host string, soft_weight int")
    rows = url_filter.url_verdicts(pages, [], ["xxx"], soft, 4).collect()
    assert sorted((str(r["page_id"]), r["soft_weight"], r["verdict"]) for r in rows) == sorted((str(i), w, v) for i, _, w, v in cases)


# ---- quality ----------------------------------------------------------------


def plain_counts(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered, seen, repeats = Counter(runs), set(), set(), 0
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeats, len(covered)


def test_counts_equal_plain_ones(spark):
    rows = some_texts(4, ["a", "b", " ", "\n", "\n\n", "#", "é", "😀", "\r", "a b ", "|"], 2000)
    rows += [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = quality.Batch.of(rows).measures()
    assert list(zip(*(found[c].tolist() for c in quality.COLUMNS))) == [plain_counts(t) for t in rows]


def test_quality_query_equals_plain_counts_and_its_own_model(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.fit(docs, labels)
    got = queries.QUERIES["op5_quality_rules"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for row in got:
        counts = plain_counts(texts[row["doc_id"]])
        assert tuple(row[c] for c in quality.COLUMNS) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        [chance] = model.probability(quality.Batch.of([texts[row["doc_id"]]]))
        assert row["base_failed"] == failed and row["kept"] == (not failed and row["probability"] >= quality.KEEP_FROM)
        assert abs(chance - row["probability"]) < 1e-9
    assert {r["base_failed"] for r in got} == {r["kept"] for r in got} == {True, False}


def test_quality_model_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    first, rest = labels.filter("doc_id < 600"), labels.filter("doc_id >= 600")
    model = quality.fit(docs, first)
    judged = quality.judge(docs, model).join(rest.select("doc_id", "quality"), "doc_id").filter("NOT base_failed").collect()
    good = [r["kept"] for r in judged if r["quality"] == 1]
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_quality_odd_rows(spark, odd_docs):
    rows = quality.judge(odd_docs, None, carry=("row",)).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert row["base_failed"] == (row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"])
        assert row["kept"] == (not row["base_failed"]) and row["probability"] is None
    assert quality.judge(odd_docs.limit(0), None).count() == 0
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert quality.fit(odd_docs, none) is None
    one_kind = spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int")
    assert quality.fit(odd_docs, one_kind) is None


# ---- chat -------------------------------------------------------------------


def test_masks_hold_what_the_participant_says(spark):
    rows = [(1, 0, "ann", "hi é😀"), (1, 1, "bob", "hello"), (1, 1, "cem", "same turn"), (1, 2, "ann", None), (1, 2, "ann", None)]
    rows += [(2, None, None, "who"), (2, 5, "ann", "x"), (None, 0, "bob", "y")]
    rows += [(3, i, "ab"[i % 2], f"t{i}") for i in range(10)] + [(4, 7, "a", f"tie {i}") for i in range(5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "text AS participant", "1 AS block")
    found = chat.perspectives(turns, block_turns=4).collect()
    for row in found:
        said = "".join(row["text"][s["start"] : s["end"]] for s in row["spans"])
        own = [t for c, n, r, t in sorted(set(rows), key=str) if c == row["conv_id"] and (r or "unknown") == row["participant"]]
        assert row["n_own"] == len(row["spans"]) and all(p in own + [""] for p in said.split("<|im_end|>\n"))
        assert row["text"].count("<|im_start|>") == row["n_turns"] and row["n_turns"] <= 4
    whole = {}
    for row in sorted(found, key=lambda r: (r["block"], r["part"])):
        key = (row["conv_id"], row["participant"])
        whole[key] = whole.get(key, "") + row["text"]
    assert set(whole) == {(1, "ann"), (1, "bob"), (1, "cem"), (2, "unknown"), (2, "ann"), (None, "bob"), (3, "a"), (3, "b"), (4, "a")}
    assert whole[(1, "bob")] == (
        "<|im_start|>user name=ann\nhi é😀<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
        "<|im_start|>user name=cem\nsame turn<|im_end|>\n<|im_start|>user name=ann\n<|im_end|>\n"
    )
    assert [len(re.findall("t[0-9]", whole[(3, p)])) for p in "ab"] == [10, 10]
    assert chat.perspectives(turns.limit(0)).count() == 0


# ---- licenses ---------------------------------------------------------------


def test_license_odd_rows_and_thresholds(spark, odd_docs):
    rows = licenses.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[1]["first_word"], by_id[1]["last_word"], by_id[1]["labels"]) == (11, 11, "reserved")
    assert by_id[3]["first_word"] is None and by_id[3]["score"] == 0 and by_id[6]["n_words"] == 30_000
    lines = [
        (1, "released UNDER the mit licence"),  # 4 of 5 words
        (2, "released under that mit licence"),  # 3 of 5
        (3, "x\nlicense and mit in a long line under which all words of it stand, the last is released\ncc by cc by"),
        (4, "Released under\nthe MIT License."),
        (5, "license mit released the the MIT License under"),  # in a window of five words
    ]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(lines, "doc_id long, text string")).collect()}
    assert [found[i]["labels"] for i in range(1, 6)] == ["mit", "", "cc-by", "mit", "mit"]
    assert found[1]["score"] == 0.8 and found[3]["n_base"] == 2 and found[3]["blocks"] is None
    assert [(b["block"], b["containment"]) for b in found[4]["blocks"]] == [(0, 1.0), (1, 0.8)] and found[5]["score"] == 0.8
    assert licenses.scan(odd_docs.limit(0)).count() == 0


def test_license_windows_run_over_line_breaks(spark, odd_docs):
    mit = dict(licenses.TEMPLATES)["mit"]
    rows = [
        (1, "Some words before.\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files"),
        (2, "* Redistribution and use in source and binary forms, with or without\n* modification, are permitted provided that the following conditions are met"),
        (3, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0."),
        (4, "Released under\nthe MIT License."),
        (5, "released in a long line under which the words of mit stand far apart, and so does the license"),
        (6, "released under\n\nthat MIT licence"),  # 3 of 5
        (7, "License"),
        (8, "// Copyright 2020\n//\n" + "\n".join(f"// {line}" for line in mit.splitlines())),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(frame).collect()}
    assert [found[i]["labels"] for i in range(1, 9)] == ["mit", "bsd", "mpl-2.0", "mit", "", "", "", "mit"]
    assert [found[i]["score"] for i in range(1, 9)] == [1, 1, 1, 1, 0, 0, 0, 1]
    assert max(found[1]["blocks"], key=lambda b: b["containment"])["block"] == 3


def test_license_blocks_equal_plain_ones(spark):
    """All windows of texts made of template words, judged one by one."""
    templates = [("one", "a b c d e f"), ("two", "c c d x y"), ("two", "q"), ("three", "a b a b z")]
    r = random.Random(12)
    docs = [(i, " ".join(r.choice("aabbccddefxyzqmn") for _ in range(r.choice([0, 1, 4, 9, 40])))) for i in range(150)]
    want = set()
    for i, text in docs:
        words = text.split()
        for label, template in templates:
            parts = template.split()
            for at in range(len(words)):
                both = len(set(words[at : at + len(parts)]) & set(parts))
                if words[at] in parts and 10 * both >= 8 * len(set(parts)):
                    want.add((i, at, label, both / len(set(parts))))
    # Of several templates with one label the best counts.
    best = {}
    for i, at, label, share in want:
        best[i, at, label] = max(share, best.get((i, at, label), 0))
    rows = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"), templates, {}).collect()
    got = {(x["doc_id"], b["block"], b["label"]): b["containment"] for x in rows for b in x["blocks"] or []}
    assert got == best and len(best) > 100


def test_native_operators_run_no_python(spark, odd_docs):
    from sheafline.llm import decontamination

    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    turns = spark.createDataFrame([(1, 1, "a", "t")], "conv_id long, turn long, role string, text string")
    for frame in (licenses.scan(odd_docs), chat.perspectives(turns), decontamination.leaks(odd_docs, bench)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan
