import math

from conftest import rows
from kestrel.operators import sentiment as se


def _tokens(spark):
    data = [(1, 1, "good fun good"), (2, 1, "fun"), (3, 0, "bad dull"), (4, 0, "bad")]
    docs = spark.createDataFrame(data, "doc_id long, label int, text string")
    return se.words_long(docs, keep=("doc_id", "label")), docs


def test_nb_train_zero_count_becomes_one(spark):
    toks, _ = _tokens(spark)
    m = {r.word: r for r in se.nb_train(toks).collect()}
    # 4 positive tokens, 3 negative, 7 in all
    assert m["good"].c_neg == 0 and abs(m["good"].p_neg - 1 / 3) < 1e-12
    assert abs(m["good"].p_pos - 2 / 4) < 1e-12
    assert abs(m["bad"].p_word - (1 + 2) / 7) < 1e-12


def test_nb_score_log_space_and_prior(spark):
    toks, docs = _tokens(spark)
    model = se.nb_train(toks)
    new = spark.createDataFrame([(10, "good good bad"), (11, "unknown words only")], "doc_id long, text string")
    nt = se.words_long(new)
    s = {r.doc_id: r for r in se.nb_score(nt, model, new).collect()}
    lp = math.log(0.5) + 2 * math.log(2 / 4) + math.log(1 / 4)
    ln = math.log(0.5) + 2 * math.log(1 / 3) + math.log(2 / 3)
    assert abs(s[10].log_pos - lp) < 1e-12 and abs(s[10].log_neg - ln) < 1e-12
    assert s[10].predicted == int(lp > ln)
    assert s[11].prob == 0.5 and s[11].predicted == 0   # no known word: the prior, ties negative


def test_rules_weight_never_resets(spark):
    toks = spark.createDataFrame(
        [(1, 0, "not"), (1, 1, "good"), (1, 2, "very"), (1, 3, "good"), (2, 0, "GOOD")],
        "doc_id long, pos int, word string")
    lex = spark.createDataFrame([("good", 1)], "word string, polarity int")
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    s = dict(rows(se.lexicon_score_rules(toks, lex, docs, 0.0), "doc_id", "score"))
    # weights: not -> -1, good -1, very -> -2, good -2
    assert s == {1: -3.0, 2: 0.0}
    c = dict(rows(se.lexicon_score_rules(toks, lex, docs, 0.0, caps=True), "doc_id", "score"))
    assert c[2] == 2.0


def test_binary_report_zero_safe(spark):
    pred = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, predicted int")
    r = se.binary_report(pred).first()
    assert abs(r.precision_pos - 2 / 3) < 1e-12 and r.recall_pos == 1.0
    assert r.precision_neg == 0.0 and r.f1_neg == 0.0


def test_top_bottom_ties(spark):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.1), ("c", 0.9), ("d", 0.5)], "word string, power double")
    got = rows(se.top_bottom_n(df, "power", 1, "word"), "side", "word")
    assert got == [("head", "a"), ("tail", "c")]


def test_running_weight_blocks_agree(spark):
    import random

    rnd = random.Random(5)
    vocab = ["not", "very", "barely", "good", "bad", "x", "definitely", "somewhat"]
    data = [(d, p, rnd.choice(vocab)) for d in range(3) for p in range(40)]
    toks = spark.createDataFrame(data, "doc_id long, pos int, word string")
    one = rows(se.running_weight_product(toks), "doc_id", "pos", "weight")
    many = rows(se.running_weight_product(toks, block=7), "doc_id", "pos", "weight")
    assert one == many
    mods = {"not": -1.0, "very": 2.0, "definitely": 2.0, "barely": 0.5, "somewhat": 0.5}
    want = []
    for d in range(3):
        w = 1.0
        for dd, p, word in data:
            if dd == d:
                w *= mods.get(word, 1.0)
                want.append((d, p, w))
    assert one == sorted(want)


def test_many_modifiers_give_a_finite_weight(spark):
    words = ["very", "barely"] * 1200 + ["not", "good"]
    tokens = spark.createDataFrame([(1, i, w) for i, w in enumerate(words)], "doc_id long, pos int, word string")
    weights = [r.weight for r in se.running_weight_product(tokens).orderBy("pos").collect()]
    assert weights[:4] == [2.0, 1.0, 2.0, 1.0] and weights[-1] == -1.0
    assert all(1.0 <= abs(w) <= 2.0 for w in weights)
