"""Quality cascade, toxicity, language, licences: edge cases, order independence, accuracy on held-out rows."""

import math
import random
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kestrel.llm import langid, licenses, quality, toxicity
from kestrel.llm.queries import held_out, op5_toxicity, op9_language

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def base(text):
    """The base counts in plain Python."""
    text = text or ""
    ws = text.encode().split()
    windows = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    covered = {j for i in range(len(ws) - 4) if windows[tuple(ws[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(ws), sum(len(w.decode()) for w in ws), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered),
            len(ws) < 10 or 100 * len(covered) > 20 * len(ws))


def test_base_counts_match_plain_python(spark):
    rng = random.Random(3)
    texts = [None, "", " \n ", "a b c d e", "x " * 40, "a b c d e f a b c d e g h i j k l", "é|ñ <b> ## 100% \n\x0b\x0c words\x85here too", "l\nl\n\nl\n l\n"]
    texts += [" ".join(rng.choice(["a", "b", "cc", "é", "#", "\n"]) for _ in range(rng.randrange(0, 120))) for _ in range(120)]
    df = spark.createDataFrame([(i, t, 5, "q") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, kept string")
    for r in quality.judge(df).collect():
        assert tuple(r[c] for c in COUNTS[:-1]) == base(texts[r.doc_id]), texts[r.doc_id]


def test_order_of_rules_does_not_change_the_verdict(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rules = quality.default_rules()
    ordered = quality.order_rules(docs, rules)
    assert {r.name for r in ordered} == {r.name for r in rules}
    kept = lambda rs: quality.measure(docs).select("doc_id", quality.verdict(rs).isNull().alias("kept"))
    assert sorted(map(tuple, kept(ordered).collect())) == sorted(map(tuple, kept(rules[::-1]).collect()))


def test_selective_cheap_rules_come_first(spark):
    df = spark.createDataFrame([(i, f"{' '.join(f'#{j}w{i}' for j in range(30))} " if i % 2 else " ".join(f"word{i}x{j}" for j in range(30))) for i in range(200)], "doc_id long, text string")
    ordered = [r.name for r in quality.order_rules(df.withColumn("text", F.concat("text", F.lit(" one two three four five six seven eight nine"))), [
        quality.Rule("never", F.col("n_words") < 0), quality.Rule("half", F.col("n_symbols") > 20)])]
    assert ordered == ["half", "never"]


def test_quality_of_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.fixture(scope="module")
def mid_dir():
    return "/root/testdata/sf0.01"


def test_language_on_held_out_documents(spark, mid_dir):
    got = op9_language(spark, mid_dir).join(spark.read.parquet(f"{mid_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(spark):
    train = spark.createDataFrame([("aa bb ab ba", "x"), ("cc dd cd dc", "y"), ("zz", None), (None, "x")], "text string, lang string")
    model = langid.fit(train)
    assert [x for block in model.blocks() for x in block.languages] == ["x", "y"]
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "123 !?", "a"), (4, "AB BA", "a"), (5, "cd", "a"), (5, "cd", "a"), (None, "dc", "a")], "doc_id long, text string, score string")
    got = Counter(tuple(r)[:2] for r in langid.predict(df, model).collect())
    assert got == Counter({(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (4, "x"): 1, (5, "y"): 2, (None, "y"): 1})
    none = langid.fit(train.limit(0))
    assert langid.best(none, ["text"]) == [("und", 0.0)]
    assert [tuple(r) for r in langid.predict(df.where("doc_id = 4"), none).collect()] == [(4, "und", 0.0)]
    assert langid.predict(df.limit(0), model).collect() == []


def _bayes(train, texts):
    """Posteriors by plain counting of hashed n-grams."""
    seen = {}
    for text, lang in train:
        mine = seen.setdefault(lang, [Counter(), 0])
        mine[1] += 1
        for bins in langid.text_bins(text):
            mine[0].update(bins.tolist())
    out = []
    for text in texts:
        bins = [x for b in langid.text_bins(text) for x in b.tolist()]
        logs = {lang: math.log(n / len(train)) + sum(math.log((c[x] + 0.5) / (sum(c.values()) + 0.5 * langid.BINS)) for x in bins) for lang, (c, n) in sorted(seen.items())}
        best = max(logs, key=lambda k: logs[k])
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())) if bins else ("und", 0.0))
    return out


def test_languages_in_blocks_against_plain_bayes(spark, monkeypatch):
    rng = random.Random(6)
    letters = "abcdefghijklmnop"
    make = lambda k, n: " ".join("".join(rng.choices(letters[k:k + 5], k=4)) for _ in range(n))
    train = [(make(k, 20), f"l{k}") for k in range(8) for _ in range(1 + k % 3)]
    texts = [make(k % 10, n) for k in range(40) for n in (1, 6)] + ["", "12"]
    want = _bayes(train, texts)
    labelled = spark.createDataFrame(train, "text string, lang string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for most in (256, 3, 1):
        monkeypatch.setattr(langid, "MAX_LANGUAGES", most)
        got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, langid.fit(labelled)).collect()}
        assert [got[i][0] for i in range(len(texts))] == [lang for lang, _ in want]
        assert [got[i][1] for i in range(len(texts))] == pytest.approx([score for _, score in want], abs=1e-4)


def test_300_languages(spark):
    train = spark.createDataFrame([(f"{chr(0x4e00 + i) * 4} {chr(0x4e00 + i)}", f"l{i:03}") for i in range(300)], "text string, lang string")
    model = langid.fit(train)
    assert [len(b.languages) for b in model.blocks()] == [256, 44]
    df = spark.createDataFrame([(i, chr(0x4e00 + i) * 3) for i in range(0, 300, 7)], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()} == {i: f"l{i:03}" for i in range(0, 300, 7)}


def test_clashing_columns_of_the_stages(spark):
    import corpus_pipeline
    from kestrel.llm import decontaminate

    names = ["lang_pred", "lang_top", "lang_mass", "score", "__known", "__lettered", "__holds_item", "n_chars", "source"]
    docs = spark.createDataFrame([(i, "ein guter Text" if i % 2 else "a good text", "de" if i % 2 else "en", *range(9)) for i in range(12)],
                                 "doc_id long, text string, lang string, " + ", ".join(f"{n} int" for n in names))
    for df in (docs, docs.withColumn("lang", F.lit(None).cast("string"))):
        out = corpus_pipeline.language(spark, df, "")
        assert out.columns == docs.columns and out.count() == 12
    items = spark.createDataFrame([(1, "a good text")], "item_id long, text string")
    out = decontaminate.without_items(docs, items)
    assert out.columns == docs.columns and out.count() == 6


def test_long_texts_are_scored_like_short_ones(monkeypatch):
    text = "Ein langer Text, 12 Wörter  mit   Lücken... und ÄÖÜ! " * 5
    whole = sorted(x for bins in langid.text_bins(text) for x in bins.tolist())
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert sorted(x for bins in langid.text_bins(text) for x in bins.tolist()) == whole


def test_held_out_is_by_crc(spark):
    import zlib

    df = spark.range(200).select(F.col("id").alias("doc_id"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in df.select("doc_id", held_out().alias("h")).collect())


def test_toxicity_on_texts_it_was_not_fitted_on(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    model = toxicity.fit(docs, labels.where(half))
    truth = labels.where(~half).select("doc_id", F.col("toxic").alias("truth"))
    got = Counter((bool(r.truth), r.toxic) for r in toxicity.score(docs, model).join(truth, "doc_id").collect())
    assert got[True, True] >= 0.9 * (got[True, True] + got[True, False])
    assert got[False, True] <= 0.01 * (got[False, True] + got[False, False])
    assert all(a < b for a, b in zip(model.thresholds, model.thresholds[1:]))


def test_toxicity_edge_cases(spark, mid_dir):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (2, "", 9), (None, "word", 9)], "doc_id long, text string, severity int")
    labels = spark.createDataFrame([(1, None), (7, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert [(r.doc_id, r.grade, r.toxic) for r in toxicity.score(docs, model).collect()] == [(1, 0, False), (2, 0, False), (2, 0, False), (None, 0, False)]
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert op5_toxicity(spark, mid_dir).columns == ["doc_id", "severity", "grade", "toxic"]


def dice(a, b):
    x, y = licenses.bigrams(licenses.words(a)), licenses.bigrams(licenses.words(b))
    total = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / total if total else 0.0


def test_pruned_licence_scan_matches_full_comparison():
    rng = random.Random(2)
    matcher = licenses.Matcher(licenses.TEMPLATES, licenses.THRESHOLD)
    for _, template in licenses.TEMPLATES:
        for drop in (0, 0.05, 0.2):
            unit = " ".join(w for w in template.split() if rng.random() >= drop).upper()
            text = f"Some words before.\n{unit}\nSome words after it all."
            scores = [(max(dice(u, t) for u in (unit, text, "Some words before.", "Some words after it all.")), name) for name, t in licenses.TEMPLATES]
            top = max(s for s, _ in scores)
            want = (top, min(n for s, n in scores if s == top)) if top >= licenses.THRESHOLD else (0.0, None)
            assert matcher.scan(text) == want


def test_licence_edge_cases(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Released under the MIT License.", "x"), (3, "Released under the MIT License.", "x"),
                                (4, "word " * 50000 + "\n\nAll rights reserved.\n", "x")], "doc_id long, text string, licence string")
    assert [tuple(r) for r in licenses.scan(df).collect()] == [(1, None, 0.0), (2, None, 0.0), (3, "MIT", 1.0), (3, "MIT", 1.0), (4, "All-rights-reserved", 1.0)]
    assert licenses.scan(df.limit(0)).collect() == []


def test_complete_licences_and_runs_of_lines(spark):
    full = {name: t for name, t in licenses.all_templates()[len(licenses.TEMPLATES):][:len(licenses.TEXTS)]}
    wrap = lambda t: "\n\n".join("\n".join(textwrap.wrap(p, 72)) for p in t.split("\n\n"))
    article = "\n".join(f"Line {i} of an article about gardens and rivers." for i in range(40))
    notice = next(t for name, t in licenses.TEMPLATES if name == "Apache-2.0" and len(t) > 100)
    texts = [(name, f"Copyright (c) 2020 Some Holder\n\n{wrap(t)}") for name, t in full.items()]
    texts += [("MIT", f"{article}\n\n{full['MIT']}\n\n{article}"), ("BSD-3-Clause", f"{article}\n{wrap(full['BSD-3-Clause'])}\n{article}"),
              ("Apache-2.0", f"package a;\n{wrap(notice)}\nimport b;\n{article}")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)] + [(99, f"{article}\n{wrap(full['MIT'])}\n{article}\n{wrap(full['BSD-2-Clause'])}"), (100, article)], "doc_id long, text string")
    assert {r.doc_id: r.licence for r in licenses.scan(df).collect()} == {**{i: name for i, (name, _) in enumerate(texts)}, 99: "BSD-2-Clause", 100: None}
    every = {r.doc_id: [x.licence for x in r.licences] for r in licenses.every(df).collect()}
    assert every[99] == ["BSD-2-Clause", "MIT"] and every[100] == []
    assert [every[i] for i, (name, _) in enumerate(texts) if name == "BSD-3-Clause"] == [["BSD-3-Clause"]] * 2


def test_runs_of_lines_match_full_comparison():
    rng = random.Random(3)
    matcher = licenses.Matcher(licenses.TEMPLATES, licenses.THRESHOLD)
    for _ in range(40):
        ws = " ".join(rng.choice(licenses.TEMPLATES)[1] for _ in range(2)).split()
        lines = " ".join(w + ("\n" if rng.random() < 0.15 else "") for w in ws if rng.random() > 0.05).split("\n")
        units = ["\n".join(lines[i:j]) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1)]
        scores = [(-max(dice(u, t) for u in units), name) for name, t in licenses.TEMPLATES]
        best = min((s for s in scores if -s[0] >= licenses.THRESHOLD), default=(0.0, None))
        assert matcher.scan("\n".join(lines)) == (-best[0], best[1])
