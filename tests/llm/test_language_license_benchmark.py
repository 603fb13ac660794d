"""Language ID, license scan and decontamination."""

import random
import re
import zlib

import numpy as np
import pytest
from helpers import awkward_texts, sentence, table
from hypothesis import given, settings
from hypothesis import strategies as st

from tabready.llm import decontaminate as d, language_id as lang, license_scan as lic

TONGUES = {"xx": ["thor", "thing", "ered", "then", "with"], "yy": ["chen", "ung", "lich", "der", "schön"], "zz": ["ción", "los", "que", "mente", "ando"]}


def tongue_rows(n=240, first=0):
    rng = random.Random(6)
    return [(first + i, sentence(rng, rng.randint(5, 60), TONGUES[k]), k, "s", 1) for i in range(n) for k in [sorted(TONGUES)[i % 3]]]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS score", "2 AS id")


def test_held_out_accuracy(spark):
    docs = docs_of(spark, tongue_rows() + [(None, "thor", "xx", None, 1), (900, None, "xx", "s", 0), (901, "123 !", "yy", "s", 1), (902, "der", None, "s", 1)])
    model = lang.train(docs)
    rows = lang.predict_language(docs, model).collect()
    truth = {x.doc_id: x.lang for x in docs.collect()}
    import zlib

    for x in rows:
        if x.doc_id is not None:
            assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1)
        assert 0 <= x.score <= 1
    held = [x for x in rows if x.held_out and x.doc_id < 240]
    assert len(held) > 40 and np.mean([x.lang_pred == truth[x.doc_id] for x in held]) > 0.98
    by = {x.doc_id: x for x in rows}
    assert by[900].lang_pred == by[901].lang_pred == "und" and by[900].score == 0
    assert by[None].lang_pred == "xx" and not by[None].held_out and by[902].lang_pred == "yy"
    kept = lang.known_language(docs, model)
    assert kept.columns == docs.columns and not {900, 901} & {x.doc_id for x in kept.collect()}


def test_every_language_is_learned_from_a_bounded_sample(spark):
    rng = random.Random(8)
    nulls = [(None, sentence(rng, 8, TONGUES["xx"]) + f" {i}", "xx", "s", 1) for i in range(600)] + [(None, "thor ered", "xx", "s", 1)] * 300
    same = [(None, "los que mente", "zz", "s", 1)] * 3000 + [(3 * i, "12 34 !", "zz", "s", 1) for i in range(500)]
    docs = docs_of(spark, nulls + same + [t for t in tongue_rows() if t[2] == "yy"])
    sample = lang.training_sample(docs, per_language=5)
    assert {k: sum(r.lang == k for r in sample) for k in TONGUES} == {"xx": 5, "yy": 5, "zz": 1}
    assert lang.train(docs, per_language=5).languages == ["xx", "yy", "zz"]


def test_long_texts_are_learned_in_pieces(spark):
    rng = random.Random(9)
    long = ["1 " * 15_000 + sentence(rng, 9_000, TONGUES["yy"]), sentence(rng, 9_000, TONGUES["yy"]), "1 " * 15_000 + "der"]
    docs = docs_of(spark, [(None, t, "yy", "s", 1) for t in long] + [t for t in tongue_rows() if t[2] == "xx"])
    sample = [r.pieces for r in lang.training_sample(docs) if r.lang == "yy"]
    assert len(sample) == 3 and all(sum(map(len, p)) <= lang.MAX_TRAINING_CHARS and any(map(lang.words_of, p)) for p in sample)
    assert all(any(p in t for t in long) for p in sum(sample, []))
    assert lang.train(docs).predict([sentence(rng, 20, TONGUES["yy"])])[0][0] == "yy"


def test_documents_of_several_languages_are_kept(spark):
    rng = random.Random(10)
    model = lang.train(docs_of(spark, tongue_rows()))

    def mixed(*parts):
        return ". ".join(sentence(rng, n, TONGUES[k]) for k, n in parts)

    docs = docs_of(spark, [(i, t, None, "s", 1) for i, t in enumerate([
        mixed(("xx", 45), ("yy", 30), ("zz", 25)), mixed(("xx", 48), ("yy", 47), ("zz", 5)), mixed(("zz", 40)), "12 345 !", "", None])])
    rows = {r.doc_id: r for r in lang.predict_language(docs, model).collect()}
    assert all(rows[i].lang_pred != "und" and rows[i].score < 0.5 for i in (0, 1))
    assert {r.doc_id for r in lang.known_language(docs, model).collect()} == {0, 1, 2} == {i for i, r in rows.items() if r.lang_pred != "und"}


def test_code_switching():
    model = lang.Crf(["xx", "yy", "zz"]).fit(lang.spliced([(t.split(), "xyz".index(k[0])) for _, t, k, _, _ in tongue_rows()]))
    text = "thor with thing ered then, der lich ung schön chen"
    assert [text[a:b] for a, b, _ in model.runs(text)] == ["thor with thing ered then", "der lich ung schön chen"]


def test_forward_backward_matches_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    model = lang.Crf(["a", "b", "c"])
    model.transitions, model.start = rng.normal(size=(3, 3)), rng.normal(size=3)
    model.weights = rng.normal(size=model.weights.shape).astype(np.float32)
    texts = [["one", "two", "three", "two"], ["x"], [], ["one", "x"]]
    for words, got in zip(texts, model.posteriors(texts)):
        score = [model.weights[lang.word_features(w)].astype(float).sum(0) for w in words]
        want = np.zeros((len(words), 3))
        for path in itertools.product(range(3), repeat=len(words)):
            if path:
                s = model.start[path[0]] + sum(score[i][k] for i, k in enumerate(path)) + sum(model.transitions[a, b] for a, b in zip(path, path[1:]))
                for i, k in enumerate(path):
                    want[i, k] += np.exp(s)
        if len(words):
            assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-6)


def plain_features(word):
    fenced = f"^{word}$"
    names = [f"w{word}", *(f"p{word[:n]}" for n in (1, 2, 3, 4) if n <= len(word)), *(f"s{word[-n:]}" for n in (1, 2, 3, 4) if n <= len(word)),
             *(fenced[i:i + n] for n in (2, 3) for i in range(len(fenced) - n + 1))]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % lang.BUCKETS for x in names]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aeinß"), st.characters()), max_size=50), min_size=1, max_size=8))
def test_features_of_many_words_at_once(words):
    words = [*words, "\ud800x", "\U0001f600", "日本語", "x" * 40]
    flat, sizes = lang.hashed_features(words)
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [plain_features(w) for w in words]


def test_words_of_a_batch_are_learned_together(monkeypatch):
    """Not word by word nor text by text, which took most of the time; and in blocks of bounded size."""
    model = lang.Crf(["a", "b", "c"])
    model.weights = np.random.default_rng(5).normal(size=model.weights.shape).astype(np.float32)
    texts = [" ".join(f"w{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + (i * j) % 26)}" for i in range(200)) for j in range(40)]
    calls, hashed = [], lang.hashed_features
    monkeypatch.setattr(lang, "hashed_features", lambda words: calls.append(len(words)) or hashed(words))
    got = model.predict(texts)
    assert len(calls) == 1 and calls[0] == len({w for t in texts for w in t.split()})
    assert got == model.predict(texts) and len(calls) == 1
    alone = [model.predict([t])[0] for t in texts]
    assert [k for k, _ in got] == [k for k, _ in alone] and np.allclose([x for _, x in got], [x for _, x in alone])
    monkeypatch.setattr(lang, "FEATURE_WEIGHTS", 300)
    fresh = lang.Crf(["a", "b", "c"])
    fresh.weights = model.weights
    del calls[:]
    assert fresh.predict(texts) == got and max(calls) <= 10


def test_nothing_to_learn(spark):
    docs = docs_of(spark, [])
    model = lang.train(docs)
    assert lang.predict_language(docs, model).count() == 0
    assert model.predict(["text", None]) == [("und", 0.0)] * 2
    awkward = table(spark, awkward_texts())
    assert lang.predict_language(awkward, lang.train(awkward)).count() == awkward.count()


def brute_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for phrase, label in lic.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_licenses(spark):
    texts = awkward_texts() + [
        "All rights reserved. ALL RIGHTS, reserved\n all-rights reserved", "CC BY-NC 4.0 and cc  by x", "the GNU General Public License",
        "K general public licenSe İall rights reserved", "ſall rights reserved",
        "Intro words. Licensed under the Apache License, Version 2.0. More.",
        "Permission is hereby granted, free of charge, to any person obtaining one copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction", "Released under the MIT License." * 3]
    docs = table(spark, texts)
    rows = lic.scan_licenses(docs).collect()
    assert len(rows) == docs.count()
    by = {x.doc_id: x for x in rows}
    for i, t in enumerate(texts):
        x = by[10 + i]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == brute_license(t)
        assert set(x.base_labels.split(",")) - {""} <= set(x.labels.split(",")) and 0 <= x.score <= 1
    n = len(awkward_texts())
    assert by[10 + n + 5].labels == "apache-2.0" and by[10 + n + 6].labels == "mit" and by[10 + n + 7].labels == "mit"
    assert lic.scan_licenses(docs.where("false")).count() == 0


FREE = "is free software: you can redistribute it and/or modify it under the terms of the GNU%s General Public License as published by the Free Software Foundation"
NOTICES = {
    "under the terms of the GNU General Public License": set(),
    "This program " + FREE % "": {"gpl"},
    "This library " + FREE % " Lesser": {"lgpl"},
    "This program " + FREE % " Affero": {"agpl"},
    "This library " + FREE % " Library": set(),
    "This work is licensed under the GNU General Public License.": {"gpl"},
    "This work is licensed under the GNU Lesser General Public License.": set(),
    **{f"This work is licensed under a Creative Commons Attribution{kind} 4.0 International License.": want for kind, want in [
        ("", {"cc-by"}), ("-ShareAlike", {"cc-by-sa"}), ("-NonCommercial", {"cc-by-nc"}), ("-NoDerivatives", set()),
        ("-NonCommercial-ShareAlike", set())]},
    "Licensed under CC BY 4.0": {"cc-by"}, "Licensed under CC BY-SA 4.0": {"cc-by-sa"}, "Licensed under CC BY-NC 4.0": {"cc-by-nc"},
    "Available under the Apache License, Version 2.0": {"apache-2.0"}, "Licensed under the Apache License, Version 1.1": set(),
    "Licensed under the Educational Community License, Version 2.0": set()}


def test_notices_that_differ_by_a_word(spark):
    texts = [f"Some words first. {t} Some more, at the end." for t in NOTICES]
    rows = {x.doc_id: x for x in lic.scan_licenses(table(spark, texts)).collect() if x.doc_id is not None}
    for i, (t, want) in enumerate(NOTICES.items()):
        assert {s.label for s in rows[10 + i].spans or []} == want, t
        assert set(rows[10 + i].labels.split(",")) - {""} == want | set(brute_license(t)[4].split(",")) - {""}, t


def test_both_licenses_of_a_text_are_found(spark):
    text = f"Part one: this program {FREE % ''}. " + "x " * 30 + f"Part two: this library {FREE % ' Lesser'}."
    rows = lic.scan_licenses(table(spark, [text])).collect()
    assert all([s.label for s in x.spans] == ["gpl", "lgpl"] for x in rows)


def test_short_templates_are_an_error(spark):
    with pytest.raises(ValueError, match="less than 3 words"):
        lic.scan_licenses(table(spark, ["x"]), templates=[("mit", "MIT License")])


def test_license_plan_is_native(spark):
    plan = lic.scan_licenses(table(spark, ["x"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


def edits(a, b):
    """Least edits of ``a`` against any part of ``b``."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [row[0] + 1]
        for k, y in enumerate(b, 1):
            new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (x != y)))
        row = new
    return min(row)


def damaged(rng, text, n):
    out = list(text)
    for _ in range(n):
        k, how = rng.randrange(len(out)), rng.random()
        if how < 0.34:
            out[k] = "q"
        elif how < 0.67:
            del out[k]
        else:
            out.insert(k, "z")
    return "".join(out)


@pytest.mark.parametrize("extra", ["", "日本 "])
def test_passages_within_the_budget_are_found(extra):
    rng = random.Random(1)
    words = awkward_texts()[10].split()
    items = [(k, extra + sentence(rng, rng.randint(6, 40), words)) for k in range(30)]
    block = d.BenchmarkBlock(items)
    for k, text in items:
        budget = d.edit_budget(len(text), d.ERROR_RATE)
        for n in (0, budget // 2, budget):
            body = sentence(rng, 20, words) + " " + damaged(rng, text.upper().replace(" ", "\n"), n) + " " + sentence(rng, 20, words)
            own = [m for m in block.matches([body])[0] if m[0] == k]
            best = edits(d.characters(text).tolist(), d.characters(body).tolist())
            assert own and best <= own[0][3] <= budget
            assert edits(d.characters(text).tolist(), d.characters(body[own[0][1]:own[0][2]]).tolist()) <= own[0][3]
    clean = sentence(rng, 3000, [w[::-1] + "x" for w in words])
    assert block.matches([clean, None, ""]) == [[], [], []]


def test_frequent_grams_keep_every_match():
    rng = random.Random(2)
    items = [(k, "the same start of every item here " + sentence(rng, 12, awkward_texts()[10].split())) for k in range(120)]
    block = d.BenchmarkBlock(items)
    found = block.matches([t for _, t in items])
    assert all(k in {m[0] for m in ms} for (k, _), ms in zip(items, found))


def test_decontamination_tables(spark):
    texts = awkward_texts()
    docs = table(spark, texts)
    bench = spark.createDataFrame([(1, texts[10]), (2, None), (3, ""), (4, "tiny"), (6, texts[10]), (None, texts[7][:200])], "item_id long, text string")
    rows = d.find_benchmark_passages(docs, bench).collect()
    assert {x.item_id for x in rows if x.doc_id == 20} == {1, 6} and sum(x.doc_id == 20 for x in rows) == 2
    assert {x.doc_id for x in rows if x.item_id is None} == {17, 18, 19}
    assert all(x.edits == 0 and x.similarity == 1 for x in rows)
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {17, 18, 19, 20}.isdisjoint({x.doc_id for x in kept.collect()})
    assert kept.count() == docs.count() - 4
    assert d.find_benchmark_passages(docs, bench.where("false")).count() == 0
    assert d.find_benchmark_passages(docs.where("false"), bench).count() == 0
    assert d.drop_contaminated(docs, bench.where("false")).count() == docs.count()


def test_blocks_cover_all_items(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_CHARS", 100)
    bench = spark.createDataFrame([(k, "item %d " % k * 9) for k in range(20)], "item_id long, text string")
    parts = list(d.blocks(bench))
    assert len(parts) > 5 and sorted(k for p in parts for k, _ in p) == list(range(20))
    docs = table(spark, ["x " + "item 7 " * 9])
    assert 7 in {x.item_id for x in d.find_benchmark_passages(docs, bench).collect()}


def test_blocks_leave_the_plan(spark, monkeypatch):
    bench = spark.createDataFrame([(k, "item %d " % k * 9) for k in range(20)], "item_id long, text string")
    docs = table(spark, ["x " + "item 7 " * 9, None, "clean, clean, clean", "item 3 " * 9 + "item 11 " * 9])
    want = sorted(map(tuple, d.find_benchmark_passages(docs, bench).collect()), key=str)
    kept = sorted(map(tuple, d.drop_contaminated(docs, bench).collect()), key=str)
    monkeypatch.setattr(d, "BLOCK_CHARS", 500)
    found, left = d.find_benchmark_passages(docs, bench), d.drop_contaminated(docs, bench)
    assert sorted(map(tuple, found.collect()), key=str) == want and len({r[1] for r in want}) > 2
    assert sorted(map(tuple, left.collect()), key=str) == kept and left.columns == docs.columns
    for out in (found, left):
        assert "ArrowEval" not in out._jdf.queryExecution().executedPlan().toString()


def test_every_short_item_is_found_within_its_budget():
    """All items of 1-40 characters against all texts, by whole alignment."""
    rng = random.Random(12)
    letters = "abcdefgh "
    items = [(k, "".join(rng.choice(letters) for _ in range(1 + k % 40)).replace("  ", "ab")) for k in range(120)]
    texts = []
    for k, t in items:
        n = rng.randrange(d.edit_budget(len(t), d.ERROR_RATE) + 2)
        body = damaged(rng, t, n) if n else t
        texts.append("".join(rng.choice(letters) for _ in range(rng.randrange(60))) + body + "".join(rng.choice(letters) for _ in range(rng.randrange(60))))
    got = {(k, m[0]) for k, ms in enumerate(d.BenchmarkBlock(items).matches(texts)) for m in ms}
    want = {(k, i) for k, t in enumerate(texts) for i, item in items
            if edits(d.characters(item).tolist(), d.characters(t).tolist()) <= len(item) // 10}
    assert got == want and len(want) > 150


@pytest.mark.parametrize("item, text", [("The quick brown fox.", "see: The quikc brown fox. ok"), ("E = mc2", "so E = mc2 holds"),
                                        ("abcdefghij", "xx abcdefghj yy"), ("x" * 30, "x" * 27), ("日本語の文", "これは日本語の文です")])
def test_short_items(item, text):
    assert [m[0] for m in d.BenchmarkBlock([("i", item)]).matches([text, "clean words only"])[0]] == ["i"]


def test_positions_of_long_runs():
    assert lang.words_of("Ab" * 50) == ["ab" * 20, "ab" * 20, "ab" * 10]
    han = "中文字" * 40
    assert "".join(lang.words_of(han)) == han and max(map(len, lang.words_of(han))) == 2
    assert lang.words_of("日本語ひらがなカタカナhello") == ["日本", "語", "ひらがな", "カタカナ", "hello"]
    assert lang.words_of("приветworld naïve") == ["привет", "world", "naïve"]
    assert lang.words_of("e\u0301a\u0308x ไทยภาษา") == ["e\u0301a\u0308x", "ไทยภาษ", "า"]
    assert "".join(lang.words_of("ꦗꦮ한국어")) == "ꦗꦮ한국어" and lang.words_of("123 — …") == []


def test_a_switch_inside_a_run_is_seen():
    """Writing without spaces: the middle of a run counts as its ends do."""
    first, second = "山川水木日月", "愛夢空海星風"
    rng = random.Random(3)
    write = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    data = [(lang.words_of(write(first, 80)), 0) for _ in range(40)] + [(lang.words_of(write(second, 80)), 1) for _ in range(40)]
    model = lang.Crf(["a", "b"]).fit(lang.spliced(data))
    text = write(first, 30) + write(second, 300) + write(first, 30)
    assert model.predict([text])[0][0] == "b"
    runs = [r for r in model.runs(text) if r[1] - r[0] > 8]
    assert [r[2] for r in runs] == ["a", "b", "a"] and abs(runs[1][0] - 30) <= 4 and abs(runs[1][1] - 330) <= 4


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(lang, "MAX_LANGUAGES", 2)
    rows = [(i, "some words here", f"l{i}") for i in range(12)]
    with pytest.raises(ValueError, match="more than 2 languages"):
        lang.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
